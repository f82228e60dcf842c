"""tripmart: layered trip analytics as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function (or returns a pair of
DataFrames) built from Spark SQL expressions, so Catalyst plans, prunes and
pushes down the whole pipeline.  Column names are parameters with the freight
names as defaults.
"""

__version__ = "0.1.0"
