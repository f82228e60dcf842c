"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine >= c are at squared distance <= 2 - 2c.  A fixed random
rotation spreads that distance over ``blocks`` blocks of coordinates; whatever
pair is that close has a block whose squared distance is at most its share of
the budget, in proportion to its width.  So every block is range-joined alone:
its first coordinates are cut into cells at least two radii wide, a vector is at
home in one cell and probes the later cells its ball touches, and crowded cells
are cut into parts of bounded size.  A task holds one part and streams its
probes.  Pairs within the block's budget are verified on whole vectors in double
precision, and a pair counts only in the first block that admits it, so the
union needs no duplicate removal.

Pairs never leave a task: it returns counts of links and a spanning forest.
Equal vectors collapse to one beforehand.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import components, local_roots, shuffle_partitions, stage

COSINE, BLOCKS, CELL_AXES, PART_ROWS = 0.9, 8, 3, 8192
_PROBE_ROWS = 256
_VERIFY = 50_000


@lru_cache(maxsize=8)
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    rng = np.random.Generator(np.random.PCG64(5))
    q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_edges(dims: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dims, min(blocks, dims) + 1).astype(int)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=1e-300)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _budgets(dims: int, blocks: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    edges = block_edges(dims, blocks)
    return edges, (2 - 2 * cosine) * np.diff(edges) / dims * (1 + 1e-9) + 1e-12


def _cells(classes: DataFrame, cosine: float, blocks: int, axes: int) -> DataFrame:
    """(dims, block, cell, role, id, size, vec): role 0 at home, 1 as a probe."""
    schema = "dims int, block int, cell long, role int, id long, size long, vec binary"

    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.cumsum(sizes) - sizes
            for dims in np.unique(sizes).tolist():
                mine = np.flatnonzero(sizes == dims)
                raw = flat[starts[mine][:, None] + np.arange(dims)]
                turned = unit(raw) @ rotation(dims)
                edges, budget = _budgets(dims, blocks, cosine)
                ids, count = batch.column("id").take(pa.array(mine)), batch.column("size").take(pa.array(mine))
                body = pa.array([x.tobytes() for x in raw], pa.binary())
                for b in range(len(edges) - 1):
                    radius = np.sqrt(budget[b])
                    used = turned[:, edges[b] : min(edges[b] + axes, edges[b + 1])]
                    side, fold = 2.5 * radius, 1 << 20
                    code = lambda x: sum((np.floor(x[:, k] / side).astype(np.int64) + (fold >> 1)) * fold**k for k in range(x.shape[1]))  # noqa: B023, E731
                    home = code(used)
                    some = [(0, home, np.arange(len(mine)))]
                    shifts = {tuple(s) for s in product((-radius, radius), repeat=used.shape[1])}
                    touched = np.unique(np.stack([np.r_[[code(used + np.array(s)) for s in shifts]].T.ravel(), np.repeat(np.arange(len(mine)), len(shifts))], 1), axis=0)
                    later = touched[touched[:, 0] > home[touched[:, 1]]]
                    some.append((1, later[:, 0], later[:, 1]))
                    for role, cell, at in some:
                        if len(at):
                            take = pa.array(at)
                            fixed = [pa.array(np.full(len(at), v, np.int32)) for v in (dims, b)]
                            yield pa.RecordBatch.from_arrays([*fixed, pa.array(cell), pa.array(np.full(len(at), role, np.int32)), ids.take(take), count.take(take), body.take(take)], names=["dims", "block", "cell", "role", "id", "size", "vec"])

    return classes.mapInArrow(run, schema)


class _Part:
    """One part of a cell: its vectors, and the links found among them and probes."""

    def __init__(self, dims: int, block: int, ids, sizes, raw, cosine: float, blocks: int):
        self.block, self.cosine = block, cosine
        self.edges, self.budget = _budgets(dims, blocks, cosine)
        self.ids, self.sizes, self.x = ids, sizes, unit(raw)
        self.t = self.x @ rotation(dims)
        self.own = slice(self.edges[block], self.edges[block + 1])
        self.side = self._screen(self.t, False)

    def _screen(self, turned: np.ndarray, probe: bool) -> np.ndarray:
        """Rows whose product with those of the other side is their squared distance
        in the block, in single precision."""
        own = turned[:, self.own]
        square, one = (own**2).sum(axis=1, keepdims=True), np.ones((len(own), 1))
        return np.hstack([-2 * own, one, square] if probe else [own, square, one]).astype(np.float32)

    def links(self, ids, sizes, raw, among_itself: bool) -> pa.RecordBatch | None:
        """Verified links of a batch with the part: (id, n, root)."""
        x = unit(raw)
        t = x @ rotation(x.shape[1])
        near = self._screen(t, True) @ self.side.T
        i, j = np.divmod(np.flatnonzero(near <= self.budget[self.block] + 1e-5), near.shape[1])
        if among_itself:
            before = ids[i] < self.ids[j]
            i, j = i[before], j[before]
        keep = []
        for a in range(0, len(i), _VERIFY):
            p, q = i[a : a + _VERIFY], j[a : a + _VERIFY]
            linked = np.einsum("ij,ij->i", x[p], self.x[q]) >= self.cosine
            p, q = p[linked], q[linked]
            shares = np.add.reduceat((t[p] - self.t[q]) ** 2, self.edges[:-1], axis=1) <= self.budget
            first = np.argmax(shares, axis=1) == self.block
            keep.append((p[first], q[first]))
        if not keep or not sum(len(p) for p, _ in keep):
            return None
        i, j = (np.concatenate(x) for x in zip(*keep))
        a, b = ids[i], self.ids[j]
        nodes, roots = local_roots(a, b)
        n = np.bincount(np.searchsorted(nodes, np.r_[a, b]), np.r_[self.sizes[j], sizes[i]].astype(float), len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(n.astype(np.int64)), pa.array(roots)], names=["id", "n", "root"])


def _join(dealt: DataFrame, kind: str, cosine: float, blocks: int) -> DataFrame:
    """Stream the sorted parts: homes first, then probes in small batches."""

    def run(batches):
        part, key, homes = None, None, []

        def close():
            if not homes:
                return None
            ids, sizes, raw = (np.concatenate(x) for x in zip(*homes))
            homes.clear()
            return _Part(key[0], key[1], ids, sizes, raw, cosine, blocks)

        def among():
            for a in range(0, len(part.ids), _PROBE_ROWS):
                z = slice(a, a + _PROBE_ROWS)
                yield part.links(part.ids[z], part.sizes[z], part.x[z], True)

        for batch in batches:
            cols = [batch.column(c).to_numpy() for c in ("dims", "block", "cell", "part", "role", "id", "size")]
            vec = batch.column("vec")
            change = np.flatnonzero(np.r_[True, np.any([c[1:] != c[:-1] for c in cols[:5]], axis=0)])
            for a, b in zip(change.tolist(), np.r_[change[1:], batch.num_rows].tolist()):
                mine = tuple(int(c[a]) for c in cols[:4])
                if mine != key:
                    if homes:
                        part = close()
                        yield from (x for x in among() if x is not None)
                    part, key = None, mine
                raw = np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in vec.slice(a, b - a)), kind).reshape(b - a, -1)
                if cols[4][a] == 0:
                    homes.append((cols[5][a:b], cols[6][a:b], raw))
                    continue
                if homes:
                    part = close()
                    yield from (x for x in among() if x is not None)
                for c in range(0, (b - a) if part else 0, _PROBE_ROWS):
                    z = slice(c, c + _PROBE_ROWS)
                    got = part.links(cols[5][a:b][z], cols[6][a:b][z], raw[z], False)
                    if got is not None:
                        yield got
        if homes:
            part = close()
            yield from (x for x in among() if x is not None)

    return dealt.mapInArrow(run, "id long, n long, root long")


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS, axes: int = CELL_AXES, part_rows: int = PART_ROWS,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components link
    with nothing, like rows without id; vectors of different length never link.
    Repeated rows link with each other.  An empty table gives an empty table; other
    columns are ignored, whatever their names.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("vector"))
    number = rows.schema["vector"].dataType.elementType.simpleString()
    kind, wide = ("<f4", "float") if number == "float" else ("<f8", "double")
    rows = rows.withColumn("vector", F.col("vector").cast(f"array<{wide}>"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = rows.filter(F.col("vec_id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda v: v != 0))
    classes = stage(usable.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("size")), "vectors")
    cells = stage(_cells(classes, cosine, blocks, axes), "cells")
    place = ["dims", "block", "cell"]
    parts = cells.filter("role = 0").groupBy(*place).agg(F.ceil(F.count("*") / F.lit(part_rows)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    met = F.when(F.col("role") == 0, F.sequence(own, F.col("parts") - 1)).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    spread = cells.join(parts, place).withColumn("_own", own).select(*place, "role", "id", "size", "vec", "_own", F.explode(met).alias("part"))
    # a vector is a probe in the later parts of its own cell
    dealt = spread.withColumn("role", F.when((F.col("role") == 0) & (F.col("part") == F.col("_own")), F.lit(0)).otherwise(F.lit(1))).drop("_own")
    dealt = dealt.repartition(shuffle_partitions(vectors.sparkSession), *place, "part").sortWithinPartitions(*place, "part", "role")
    found = stage(_join(dealt, kind, cosine, blocks), "vector-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    labels = classes.join(counts, "id", "left").join(roots, F.col("id") == F.col("node"), "left").select(
        F.col("vector").alias("_v"), (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "id").alias("root"))
    keyed = rows.withColumn("_id", F.col("vec_id")).join(labels, (rows.vector == labels._v) & rows.vec_id.isNotNull(), "left")
    component = F.coalesce("root", "vec_id")
    return keyed.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
