"""Embedding near-duplicates by lattice hashing: E8 cells of random projections, probed and verified.

Vectors of one label (and length) are scaled to length one.  Every table projects them to two
8-dimensional blocks and decodes each block to the nearest point of the E8 lattice; the two points
are the cell.  A vector is put into its own cell and into the cells where one block moves to one of
the ``probes`` lattice neighbours nearest to the residual.  Vectors that share a cell are verified by
cosine in double precision.  At the threshold (0.93) one table finds a pair with probability about
0.46, eight tables with 0.994; closer pairs more often.

Scale: identical vectors are one class first (a vector that fills a third of the table is one row).
Only (cell, class) pairs are counted; classes alone in their cells go no further, and cells with
the same members are verified once.  What leaves a cell is a star of verified links, not its pairs; in large
cells, vectors that link with the same pivots need no pairs (``graph.stars``).  Components come from those
stars, and links are counted exactly among all members of a component, in blocks (``graph.in_units``).

Defined results: a null, zero-length or zero vector, or one with null or non-finite components, or
a null label, links with nothing (0 links, its own component, kept).  Vectors of different lengths
never link.  Ties: the smallest vec_id is the component.  Repeated rows with one vec_id are one
vector, and each row is returned.  Empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import graph
from ledgerlens.llm import textkit as tk
from ledgerlens.session import materialize

TABLES, BLOCKS, PROBES, SCALE, BLOCK = 8, 2, 4, 1.5, 512


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even coordinate sum."""
    f = np.rint(x)
    rest = x - f
    odd = np.flatnonzero(f.sum(axis=1) % 2 != 0)
    k = np.abs(rest[odd]).argmax(axis=1)
    f[odd, k] += np.where(rest[odd, k] >= 0, 1.0, -1.0)
    return f


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points: the better of D8 and D8 shifted by one half."""
    a, b = decode_d8(x), decode_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(nearer[:, None], a, b)


_NEAR = minimal_vectors()
_CELL = tk.mix64(np.arange(1, 8 * BLOCKS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def cell_keys(points: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """64-bit keys of lattice points (doubled coordinates are integers)."""
    z = (2 * points).astype(np.int64).view(np.uint64)
    return tk.mix64((z * _CELL).sum(axis=-1, dtype=np.uint64) ^ salt)


def cells(x: np.ndarray, group: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """Cell keys of unit vectors: own cell and probed ones in every table, one row per vector."""
    out = []
    for t in range(tables):
        rng = np.random.default_rng([20, t, x.shape[1]])
        y = x @ rng.normal(size=(x.shape[1], 8 * BLOCKS)) * (scale / np.sqrt(8))
        parts = [y[:, 8 * k:8 * k + 8] for k in range(BLOCKS)]
        point = [decode_e8(p) for p in parts]
        salt = tk.mix64(group ^ np.uint64(t + 1))
        out.append(cell_keys(np.concatenate(point, axis=1), salt))
        for k in range(BLOCKS):
            order = np.argsort(-((parts[k] - point[k]) @ _NEAR.T), axis=1, kind="stable")[:, :probes]
            for p in range(probes):
                moved = [point[j] + _NEAR[order[:, p]] if j == k else point[j] for j in range(BLOCKS)]
                out.append(cell_keys(np.concatenate(moved, axis=1), salt))
    return np.stack(out, axis=1)


def unit_vectors(col) -> np.ndarray:
    """Rows of equal length as double-precision unit vectors."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    x = np.stack([np.asarray(v, np.float64) for v in col.to_numpy(zero_copy_only=False)])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _verify(threshold: float):
    def fn(t: pa.Table, lo: int, hi: int):
        if t.num_rows < 2:
            return None
        x = unit_vectors(t["embedding"])
        links = x @ x.T >= threshold
        root = graph.local_roots(links)
        at = np.flatnonzero(root != np.arange(len(root)))
        if not len(at):
            return None
        ids = t["cid"].to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[root[at]])], ["a", "b"])
    return fn


def _near(threshold: float):
    def near(values: pa.Array, pivots: pa.Array):
        c = unit_vectors(values) @ unit_vectors(pivots).T
        return c >= threshold, np.arccos(np.clip(c, -1, 1))  # angles are a metric, cosines are not
    return near


def _count(threshold: float):
    def fn(t: pa.Table, lo: int, hi: int):
        x, b, w = unit_vectors(t["embedding"]), t["_b"].to_numpy(), t["w"].to_numpy()
        links = x @ x.T >= threshold
        if lo != hi:
            links &= b[:, None] != b[None, :]
        np.fill_diagonal(links, False)
        return pa.RecordBatch.from_arrays([t["cid"].combine_chunks(), pa.array((links @ w).astype(np.int64))], ["cid", "n"])
    return fn


def link(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    d = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(d, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("embedding") > 0) & finite & F.exists(d, lambda v: v != 0), F.lit(False))
    keyed = vectors.select("vec_id", "label", F.when(usable, F.col("embedding")).alias("embedding"))
    keyed = keyed.withColumn("cid", F.when(F.col("embedding").isNotNull(), F.xxhash64("label", "embedding")))
    classes = materialize(keyed.where("cid IS NOT NULL").groupBy("cid")
                               .agg(F.min("vec_id").alias("first"), F.count_distinct("vec_id").alias("w"), F.first("embedding").alias("embedding"),
                                    F.first("label").alias("label")), "vec_classes")

    @tk.tidy
    def hashed(batches):
        for batch in batches:
            cid, group, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            for n in np.unique(size):
                m = np.flatnonzero(size == n)
                for lo in range(0, len(m), 1024):
                    some = m[lo:lo + 1024]
                    keys = cells(unit_vectors(batch.column(1).take(pa.array(some))), group[some].view(np.uint64))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(cid[some], keys.shape[1]))], ["cell", "cid"])

    placed = materialize(classes.select("cid", "embedding", F.xxhash64("label", F.size("embedding")).alias("g"), F.size("embedding").alias("size"))
                                .mapInArrow(hashed, "cell long, cid long"), "vec_cells")
    # cells with one member say nothing; of cells with the same members one is enough
    shared = (placed.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("who"))
                    .where("m > 1").groupBy("m", "who").agg(F.min("cell").alias("cell")).select("cell"))
    met = placed.join(shared, "cell").join(classes.select("cid", "embedding"), "cid")
    stars = graph.stars(materialize(met, "vec_met"), "cell", "cid", "embedding", BLOCK, _near(threshold), float(np.arccos(threshold)) + 1e-6, _verify(threshold))
    comp = graph.components(stars, "vec")
    member = materialize(classes.join(comp.withColumnRenamed("node", "cid"), "cid").select("cid", "component", "embedding", "w", "first"), "vec_members")
    counts = (graph.in_units(member.select("cid", "component", "embedding", "w"), "component", "cid", BLOCK, _count(threshold), "cid long, n long")
              .groupBy("cid").agg(F.sum("n").alias("n")))
    least = member.groupBy("component").agg(F.min("first").alias("component_id"))
    known = member.select("cid", "component").join(least, "component").join(counts, "cid").select("cid", "component_id", "n")
    table = classes.select("cid", "first", "w").join(known, "cid", "left")
    return (keyed.select("vec_id", "cid").join(table, "cid", "left")
                 .select("vec_id", F.coalesce(F.col("w") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
                         F.coalesce("component_id", "first", "vec_id").alias("component_id"))
                 .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
