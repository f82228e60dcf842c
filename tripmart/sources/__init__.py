"""Sources: table scans, landing CSV, file-arrival events, synthetic trips."""
