"""N-gram Jaccard join: documents whose sets of five-word shingles have similarity 0.8 or more.

Chosen-path join.  A set is embedded as ``SKETCH`` MinHash tokens (coordinate, value), so two sets
share about J of them.  A run starts with all sets in one bucket and splits recursively: with the
bucket's path as seed, every set follows those of its tokens whose hash falls under
``1 / (threshold * SKETCH)``, 1 / threshold of them on average, so that similar sets stay together
somewhere and others part by a factor J / threshold per level.  Every run goes ``DEPTH`` levels;
buckets above ``SPLIT`` sets are split further, to ``DEEPEST`` levels; then buckets are compared by
brute force on the sketches.  The number of runs follows from the target recall: a pair at the
threshold survives a level with probability q' = 1 - (1 - q p)^shared, and runs repeat until
1 - (1 - q)^runs reaches it at ``DEEPEST`` levels.

Verification is exact: sketch links (estimate of ``LOOSE`` or more) form candidate groups, and inside a
group all sets are compared by their true shingle sets, in blocks.

Scale: texts with equal shingle sets are one class first, by partial aggregation.  The paths of a
set follow from its sketch alone, so the levels of all runs are one scan; what is shuffled are
(path, class) pairs.  Buckets with one class end there, and of buckets with the same classes one is
compared.  Buckets are needed for what they connect only: the first ``FIRST`` runs connect most of every large
group, and of the other runs only those buckets are taken whose classes are not yet all connected
(``connected``); in large ones, rows that link with the same pivots need no pairs (``graph.stars``).
Groups of any size go in blocks (``graph.in_units``): exact link counts need all their pairs.  What
leaves buckets and groups are stars and sums, never their pairs.

Words: runs of digits, letters (A-Z lowered) and non-ASCII characters.  Defined results: a text
with words but fewer than five is one shingle of all its words; a null text or one without words links
with nothing.  Repeated rows are links of each other (J = 1) and each is returned; null ids rank last.
Empty table: no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import graph
from ledgerlens.llm import textkit as tk
from ledgerlens.session import materialize

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.9995
SKETCH, DEPTH, DEEPEST, SPLIT, BLOCK, LOOSE, FIRST = 64, 3, 5, 1024, 512, 0.6, 4

_SEED = tk.mix64(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
_ODD = tk.mix64(_SEED) | np.uint64(1)
_COORD = np.arange(SKETCH, dtype=np.uint64) << np.uint64(32)


def runs_for(recall: float, threshold: float = THRESHOLD, depth: int = DEEPEST) -> int:
    """Runs until a pair at the threshold has met with probability ``recall``."""
    shared, p, q = math.floor(threshold * SKETCH), 1 / (threshold * SKETCH), 1.0
    for _ in range(depth):
        q = 1 - (1 - q * p) ** shared
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


# ------------------------------------------------------------------ sets and sketches
def batch_sets(texts):
    """(first row, row count, row, shingle) of a column of texts, a few megabytes at a time; rows count from the first."""
    buf, offs = tk.utf8(texts)
    for lo, hi in tk.row_chunks(offs, 2 << 20):
        _, _, r, h = tk.word_hashes(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], tk.ALNUM)
        yield lo, hi - lo, *tk.shingles(r, h, hi - lo, WORDS)


def sketch(g: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values (sets x SKETCH) of sets that begin at ``first``."""
    out = np.empty((len(first), SKETCH), np.uint32)
    for j in range(SKETCH):
        h = (((g ^ _SEED[j]) * _ODD[j]) >> np.uint64(32)).astype(np.uint32)
        out[:, j] = np.minimum.reduceat(h, first) if len(first) else 0
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, cid and cid2 (128-bit hash of the shingle set), sketch; null where there is no word."""
    @tk.tidy
    def step(batches):
        for batch in batches:
            for lo, n, rows, g in batch_sets(batch.column(1)):
                own, first = np.unique(rows, return_index=True)
                cid, cid2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                blobs: list = [None] * n
                if len(own):
                    cid[own], cid2[own] = np.add.reduceat(tk.mix64(g), first), np.add.reduceat(tk.mix64(g ^ np.uint64(0x3C6EF372FE94F82B)), first)
                    for i, s in zip(own.tolist(), sketch(g, first)):
                        blobs[i] = s.tobytes()
                none = np.ones(n, bool)
                none[own] = False
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(cid.view(np.int64), mask=none),
                                                  pa.array(cid2.view(np.int64), mask=none), pa.array(blobs, pa.binary())], ["doc_id", "cid", "cid2", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(step, "doc_id long, cid long, cid2 long, sketch binary")


# ------------------------------------------------------------------ chosen paths
def follow(tokens: np.ndarray, rows: np.ndarray, paths: np.ndarray, levels: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Paths of sets ``rows`` after more levels: (row, path)."""
    limit = np.uint64(min(int(2.0 ** 64 / (threshold * SKETCH)), 2 ** 64 - 1))
    for _ in range(levels):
        nxt_rows, nxt_paths = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for lo in range(0, len(rows), 4096):
            h = tk.mix64(tokens[rows[lo:lo + 4096]] ^ paths[lo:lo + 4096, None])
            i, j = np.nonzero(h < limit)
            nxt_rows.append(rows[lo:lo + 4096][i])
            nxt_paths.append(tk.mix64(h[i, j]))
        rows, paths = np.concatenate(nxt_rows), np.concatenate(nxt_paths)
    return rows, paths


def tokens_of(blobs: list) -> np.ndarray:
    v = np.frombuffer(b"".join(blobs), np.uint32).reshape(-1, SKETCH)
    return tk.mix64(v.astype(np.uint64) | _COORD)


def start_paths(classes: DataFrame, runs: range, threshold: float) -> DataFrame:
    """(path, cid, comp, size) of every class after ``DEPTH`` levels of every one of ``runs``."""
    @tk.tidy
    def step(batches):
        for batch in batches:
            cid, tokens = batch.column(0).to_numpy(), tokens_of(batch.column(1).to_pylist())
            for lo in range(0, len(cid), 2048):
                t = tokens[lo:lo + 2048]
                for run in runs:
                    seed = tk.mix64(np.full(len(t), run + 1, np.uint64))
                    r, p = follow(t, np.arange(len(t)), seed, DEPTH, threshold)
                    at = pa.array(lo + r)
                    yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), *(batch.column(i).take(at) for i in (0, 2, 3))], ["path", "cid", "comp", "size"])

    return classes.select("cid", "sketch", "comp", "size").mapInArrow(graph._merged(step, 1 << 16), "path long, cid long, comp long, size long")


def split_paths(held: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """One more level for the classes of large buckets."""
    @tk.tidy
    def step(batches):
        for batch in batches:
            path = batch.column(3).to_numpy().view(np.uint64)
            r, p = follow(tokens_of(batch.column(4).to_pylist()), np.arange(len(path)), path, 1, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(p.view(np.int64)), *(batch.column(i).take(pa.array(r)) for i in range(3))], ["path", "cid", "comp", "size"])

    return (held.join(classes.select("cid", "sketch"), "cid").select("cid", "comp", "size", "path", "sketch")
                .mapInArrow(step, "path long, cid long, comp long, size long"))


def buckets(classes: DataFrame, runs: range, threshold: float) -> DataFrame:
    """(path, cid, _closed, _n, _c) of the buckets of ``runs`` to compare: each set of classes once, none whose classes are connected.

    ``classes`` (cid, sketch, comp, size) names the component of those that are known to connect with others, and its size; else nulls.
    ``_closed`` marks the rows of a large bucket's one large component, which need no pairs among themselves; ``_n`` and
    ``_c`` count the bucket's open and closed rows.
    """
    done, paths = None, materialize(start_paths(classes, runs, threshold), "paths")
    comp, large = F.coalesce("comp", "cid"), F.when(F.col("size") > BLOCK, F.col("comp"))
    closed = F.when((F.col("m") > BLOCK) & (F.col("one") == F.col("last")), F.col("in_large")).otherwise(0)
    for depth in range(DEPTH, DEEPEST + 1):
        sizes = materialize(paths.groupBy("path").agg(F.count(F.lit(1)).alias("m"), F.sum(F.xxhash64("cid").cast("decimal(38,0)")).alias("who"),
                                                      F.min(comp).alias("least"), F.max(comp).alias("most"),
                                                      F.min(large).alias("one"), F.max(large).alias("last"), F.count(large).alias("in_large"))
                                 .where("least < most").select("path", "m", "who", "one", closed.alias("_c")), "path_sizes")
        ready = sizes if depth == DEEPEST else sizes.where(F.col("m") - F.col("_c") <= SPLIT)
        once = (ready.groupBy("m", "who").agg(F.min("path").alias("path"), F.first("one").alias("one"), F.first("_c").alias("_c"))
                     .select("path", "one", "_c", (F.col("m") - F.col("_c")).alias("_n")))
        part = paths.join(once, "path").select("path", "cid", F.coalesce((F.col("_c") > 0) & (F.col("comp") == F.col("one")), F.lit(False)).alias("_closed"), "_n", "_c")
        done = part if done is None else done.unionByName(part)
        split = sizes.where(F.col("m") - F.col("_c") > SPLIT).select("path")
        if depth == DEEPEST or split.isEmpty():
            return done
        paths = materialize(split_paths(paths.join(split, "path"), classes, threshold), "paths")
    return done


def connected(drawn: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(node, component) of the classes (cid, sketch) that sketch links connect in the buckets of all runs.

    The first runs' components come first: a bucket of the others whose classes are in one of them connects nothing more.
    """
    runs, none = runs_for(recall, threshold), F.lit(None).cast("long")
    first = _bucket_stars(drawn.select("cid", "sketch", none.alias("comp"), none.alias("size")), range(min(FIRST, runs)), threshold)
    known = graph.components(first, "loose_first")
    if runs <= FIRST:
        return known
    sizes = known.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    named = known.join(sizes, "component").select(F.col("node").alias("cid"), F.col("component").alias("comp"), "size")
    more = _bucket_stars(materialize(drawn.join(named, "cid", "left"), "loose_known"), range(FIRST, runs), threshold)
    return graph.components(more.unionByName(known.toDF("a", "b")), "loose")


def _bucket_stars(classes: DataFrame, runs: range, threshold: float) -> DataFrame:
    """Edges (a, b) that connect what sketch links connect in the buckets of ``runs``, beyond what ``classes`` names."""
    met = materialize(buckets(classes, runs, threshold).join(classes.select("cid", "sketch"), "cid"), "met")
    return graph.stars(met, "path", "cid", "sketch", BLOCK, _sketch_near(LOOSE), SKETCH * (1 - LOOSE) + 1e-6, _sketch_stars(LOOSE))


def _sketch_stars(loose: float):
    def fn(t: pa.Table, lo: int, hi: int):
        if t.num_rows < 2:
            return None
        v = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint32).reshape(-1, SKETCH)
        n = len(v)
        same = np.zeros((n, n), np.uint8)
        for j in range(SKETCH):
            same += v[:, j][:, None] == v[:, j][None, :]
        root = graph.local_roots(same >= loose * SKETCH)
        at = np.flatnonzero(root != np.arange(n))
        if not len(at):
            return None
        ids = t["cid"].to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[root[at]])], ["a", "b"])
    return fn


def _sketch_near(loose: float):
    def near(values: pa.Array, pivots: pa.Array):
        v, p = (np.frombuffer(b"".join(x.to_pylist()), np.uint32).reshape(-1, SKETCH) for x in (values, pivots))
        same = (v[:, None, :] == p[None, :, :]).sum(axis=2)
        return same >= loose * SKETCH, (SKETCH - same).astype(np.float64)
    return near


# ------------------------------------------------------------------ exact verification
def intersections(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted distinct arrays."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[col] > 1
    owner, col = owner[keep], (np.cumsum(count > 1) - 1)[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    out = np.zeros((n, n), np.float32)
    last = int(col[-1]) + 1 if len(col) else 0
    for lo in range(0, last, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((n, min(width, last - lo)), np.float32)
        m[owner[a:b], col[a:b] - lo] = 1
        out += m @ m.T
    return out


def _exact(threshold: float):
    def fn(t: pa.Table, lo: int, hi: int):
        cid, first = np.unique(t["cid"].to_numpy(), return_index=True)  # repeated rows of one text are one set
        sets = [np.frombuffer(t["grams"][int(i)].as_py(), np.uint64) for i in first]
        b, w = t["_b"].to_numpy()[first], t["w"].to_numpy()[first]
        size = np.array([len(s) for s in sets])
        inter = np.rint(intersections(sets)).astype(np.int64)
        union = size[:, None] + size[None, :] - inter
        # J >= threshold in integers (the threshold is a decimal with four places)
        links = inter * 10_000 >= round(threshold * 10_000) * union
        np.fill_diagonal(links, False)
        root = graph.local_roots(links)
        if lo != hi:
            links &= b[:, None] != b[None, :]
        return pa.RecordBatch.from_arrays([pa.array(cid), pa.array((links @ w).astype(np.int64)), pa.array(cid[root])], ["cid", "n", "root"])
    return fn


def candidate_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """cid (the key), grp, w, grams of one document of every wanted class (first, cid, key, grp, w)."""
    @tk.tidy
    def step(batches):
        for batch in batches:
            for lo, _, rows, g in batch_sets(batch.column(0)):
                own, first = np.unique(rows, return_index=True)
                if not len(own):
                    continue
                key = np.add.reduceat(tk.mix64(g), first).view(np.int64)
                ok = key == batch.column(1).to_numpy()[lo + own]
                ends = np.append(first[1:], len(g))
                keep = pa.array(lo + own[ok])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(keep) for i in (2, 3, 4)),
                                                  pa.array([g[a:b].tobytes() for a, b in zip(first[ok], ends[ok])], pa.binary())], ["cid", "grp", "w", "grams"])

    text = docs.select(F.col("doc_id").cast("long").alias("_id"), "text")
    return (text.join(wanted, F.col("_id").eqNullSafe(F.col("first"))).select("text", "cid", "key", "grp", "w")
                .mapInArrow(step, "cid long, grp long, w long, grams binary")
                .groupBy("cid").agg(F.first("grp").alias("grp"), F.first("w").alias("w"), F.first("grams").alias("grams")))


def keyed(classes: DataFrame) -> DataFrame:
    """``classes`` (cid, cid2) with ``key``, a long that no two of them share: half of their hash, or a
    hash of both halves where two classes share that half (a few times in 10^10 classes)."""
    key, salt = F.col("cid"), 0
    while not classes.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        salt += 1
        key = F.xxhash64("cid", "cid2", F.lit(salt))
    return classes.withColumn("key", key)


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest id of the group), n_links (other documents linked directly), kept.

    One row per row of ``docs`` (doc_id, text).
    """
    with tk.small_batches(docs.sparkSession):  # all that runs in Python is staged in here
        return _join(docs, threshold, recall)


def _join(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    sig = materialize(signatures(docs), "signatures")
    classes = materialize(sig.where("cid IS NOT NULL").groupBy("cid", "cid2")
                             .agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("w"), F.first("sketch").alias("sketch")), "set_classes")
    classes = keyed(classes)
    drawn = classes.select(F.col("key").alias("cid"), "sketch")
    loose = connected(drawn, threshold, recall)
    wanted = classes.select("cid", "key", "first", "w").join(loose.select(F.col("node").alias("key"), F.col("component").alias("grp")), "key")
    sets = materialize(candidate_sets(docs, wanted), "candidate_sets")
    exact = materialize(graph.in_units(sets, "grp", "cid", BLOCK, _exact(threshold), "cid long, n long, root long"), "exact")
    comp = graph.components(exact.select(F.col("cid").alias("a"), F.col("root").alias("b")), "exact")
    counts = exact.groupBy("cid").agg(F.sum("n").alias("n")).where("n > 0")
    named = classes.select(F.col("key").alias("cid"), "first").join(comp.withColumnRenamed("node", "cid"), "cid")
    least = named.groupBy("component").agg(F.min("first").alias("class_id"))
    linked = named.select("cid", "component").join(least, "component").join(counts, "cid").select("cid", "class_id", "n")
    table = classes.select("cid", "cid2", "key", "first", "w").join(linked.withColumnRenamed("cid", "key"), "key", "left")
    return (sig.select("doc_id", "cid", "cid2").join(table, ["cid", "cid2"], "left")
               .select("doc_id", F.coalesce("class_id", "first", "doc_id").alias("class_id"),
                       F.coalesce(F.col("w") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("n_links"))
               .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every group of near copies, the one with the smallest id.

    Rows that repeat an id and its text count as copies of each other.
    """
    kept, once = tk.fresh(docs, "_kept"), tk.fresh(docs, "_once")
    ids = join(docs).where("kept").select(F.col("doc_id").alias(kept)).distinct()
    return (docs.join(ids, F.col("doc_id").cast("long").eqNullSafe(F.col(kept)), "left_semi")
                .withColumn(once, F.coalesce(F.xxhash64("text"), F.lit(0))).dropDuplicates(["doc_id", once]).select(*docs.columns))
