"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of consecutive words with smallest period q and at least ``max(LEAST, POWER * q)`` words that no
neighbouring word extends keeping the period.  The texts of a batch become one array of word numbers with a different
stop after each text, so no repeat crosses texts.  Its suffix array, inverse (ISA) and LCP array come from prefix
doubling, which sorts only suffixes that still tie.  Every LCP interval is a range of the suffix array with a depth: no
tree is built.  For each interval, the suffixes i of all its children but the largest look up ISA[i + depth] and
ISA[i - depth]: inside the interval and in another child means a branching square, which a shift to the right breaks.
Rotating it to the left as far as letters agree (longest common suffixes from the ranks of the doubling) gives a
stretch of that period; equal stretches are merged, keeping the smallest period.  The small children hold n log n
suffixes at most, and they are taken ``SLICE`` at a time.

No shuffle: each task takes the rows it reads, ``CHUNK`` bytes of text at a time (a longer text alone).  Memory is about
300 bytes per word of a chunk.

Defined results: null and empty texts, and those of white space, have no words and no runs, and collapse to the
empty text; a very long text is taken whole, as one chunk; repeated rows and ids give one row each; an empty table gives
none; columns besides ``doc_id`` and ``text`` are ignored, whatever their names.  Runs are listed by start, then period,
which are never both equal.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk

LEAST, POWER = 6, 4
CHUNK = 2 << 20
SLICE = 1 << 20


def suffix_ranks(t: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and ranks by the first 1, 2, 4 ... symbols until all differ (the last is the inverse).

    A rank is the number of suffixes that are smaller; equal ranks mean equal prefixes.
    """
    n = len(t)
    sa = np.argsort(t, kind="stable")
    new = np.append(True, t[sa][1:] != t[sa][:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, n))
    rank = np.empty(n, np.int32)
    rank[sa] = np.repeat(head, size)
    levels, width = [rank], 1
    tied = sa[np.repeat(size > 1, size)]
    while len(tied):
        follow = tied + width
        key = rank[tied].astype(np.int64) * (n + 1) + np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        o = np.argsort(key, kind="stable")
        tied, key = tied[o], key[o]
        old = rank[tied]
        begin = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        base = np.repeat(begin, np.diff(np.append(begin, len(old))))
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(head, len(key)))
        sa[old + np.arange(len(old)) - base] = tied
        rank = rank.copy()
        rank[tied] = np.repeat(old[head] + head - base[head], size)
        levels.append(rank)
        tied = tied[np.repeat(size > 1, size)]
        width *= 2
    return sa, levels


def common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at ``a`` and ``b`` (``back``: common suffix of what stands before)."""
    a, b = a.copy(), b.copy()
    out = np.zeros(len(a), np.int64)
    n = len(levels[0])
    for k in range(len(levels) - 1, -1, -1):
        step = 1 << k
        x, y = (a - step, b - step) if back else (a, b)
        ok = (np.minimum(x, y) >= 0) & (np.maximum(x, y) < n)
        rank = levels[k]
        hit = ok & (rank[np.clip(x, 0, n - 1)] == rank[np.clip(y, 0, n - 1)])
        move = np.where(hit, step, 0)
        out += move
        a, b = (a - move, b - move) if back else (a + move, b + move)
    return out


def lcp_intervals(lcp: np.ndarray, deepest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries j between children (1 <= lcp[j] <= deepest), and first and last place of their interval.

    ``lcp[j]`` compares the suffixes at places j - 1 and j.
    """
    n = len(lcp)
    at = np.flatnonzero((lcp >= 1) & (lcp <= deepest))
    least = [lcp]
    while 2 << (len(least) - 1) <= n:
        w = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-w], least[-1][w:]))
    depth = lcp[at]
    left, right = at.copy(), at.copy()  # lcp >= depth on (left, at] and [at, right)
    for k in range(len(least) - 1, -1, -1):
        w, table = 1 << k, least[k]
        go = left - w >= 0
        go &= table[np.maximum(left - w, 0)] >= depth
        left = np.where(go, left - w, left)
        go = right + w <= n
        go &= table[np.minimum(right, n - w)] >= depth
        right = np.where(go, right + w, right)
    return at, left - 1, right - 1


def branching_squares(sa: np.ndarray, isa: np.ndarray, lcp: np.ndarray, deepest: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, half length) of the squares of half length 1..``deepest`` that a shift to the right breaks."""
    n = len(sa)
    at, lb, rb = lcp_intervals(lcp, deepest)
    if not len(at):
        return at, at
    key = lb * n + rb
    o = np.argsort(key, kind="stable")
    at, lb, rb, key = at[o], lb[o], rb[o], key[o]
    first = np.append(True, key[1:] != key[:-1])
    last = np.append(first[1:], True)
    depth = lcp[at].astype(np.int64)
    # children: left of every boundary, and right of the last one
    begin = np.concatenate([np.where(first, lb, np.append(0, at[:-1])), at[last]])
    end = np.concatenate([at, rb[last] + 1])
    of = np.concatenate([np.arange(len(at)), np.flatnonzero(last)])
    size = end - begin
    o = np.lexsort((size, key[of]))
    largest = np.append(key[of][o][1:] != key[of][o][:-1], True)
    small = o[~largest]
    begin, end, of, size = begin[small], end[small], of[small], size[small]
    starts, halves = [], []
    total = np.cumsum(size)
    lo = 0
    while lo < len(small):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + SLICE, "right")))
        n_of = size[lo:hi]
        own = np.repeat(np.arange(lo, hi), n_of)
        i = sa[begin[own] + np.arange(len(own)) - np.repeat(np.cumsum(n_of) - n_of, n_of)].astype(np.int64)
        d, a, b = depth[of[own]], lb[of[own]], rb[of[own]]
        for other, square in ((i + d, i), (i - d, i - d)):
            r = isa[np.clip(other, 0, n - 1)]
            hit = (other >= 0) & (other < n) & (r >= a) & (r <= b) & ((r < begin[own]) | (r >= end[own]))
            starts.append(square[hit])
            halves.append(d[hit])
        lo = hi
    code = np.unique(np.concatenate(starts) * (deepest + 1) + np.concatenate(halves))
    return code // (deepest + 1), code % (deepest + 1)


def runs_of(t: np.ndarray, deepest: int, least: int = LEAST, power: int = POWER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, smallest period) of all runs of an array of symbols, by start, then period."""
    if len(t) < least or deepest < 1:
        z = np.zeros(0, np.int64)
        return z, z, z
    sa, levels = suffix_ranks(t)
    lcp = np.zeros(len(t), np.int32)
    lcp[1:] = common(levels, sa[:-1], sa[1:])
    start, half = branching_squares(sa, levels[-1], lcp, deepest)
    end = start + 2 * half
    start = start - common(levels, start, start + half, back=True)
    o = np.lexsort((half, end, start))
    start, end, half = start[o], end[o], half[o]
    keep = np.ones(len(o), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])  # of equal stretches the smallest period
    keep &= end - start >= np.maximum(least, power * half)
    start, end, half = start[keep], end[keep], half[keep]
    o = np.lexsort((half, start))
    return start[o], end[o], half[o]


def _join_words(buf, starts, ends, rows, n) -> pa.Array:
    """Texts of the given words with one space between them."""
    size = ends - starts
    more = np.append(rows[1:] == rows[:-1], False) if len(rows) else np.zeros(0, bool)
    wide = size + more
    place = np.cumsum(wide) - wide
    out = np.full(int(wide.sum()), 0x20, np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(place, size) + inner] = buf[np.repeat(starts, size) + inner]
    offs = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(rows, weights=wide, minlength=n).astype(np.int64), out=offs[1:])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(offs), pa.py_buffer(out)])


def text_runs(buf: np.ndarray, offs: np.ndarray, least: int = LEAST, power: int = POWER) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Word counts, lists of runs and collapsed texts of a batch of texts."""
    n = len(offs) - 1
    starts, ends, rows = tk.word_spans(buf, offs, tk.NOT_SPACE)
    words = np.bincount(rows, minlength=n)
    size = ends - starts
    letters = np.append(0, np.cumsum(size)).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(letters), pa.py_buffer(buf[tk.NOT_SPACE[buf]].tobytes())]).dictionary_encode()
    place = np.arange(len(size)) + rows  # one stop after every text
    t = np.empty(len(size) + n, np.int64)
    t[place] = coded.indices.to_numpy(zero_copy_only=False)
    begin = np.cumsum(words) - words + np.arange(n)
    t[begin + words] = len(coded.dictionary) + np.arange(n)
    deepest = int(words.max(initial=0)) // power
    s, e, q = runs_of(t, deepest, least, power)
    own = np.searchsorted(begin, s, "right") - 1
    listed = pa.ListArray.from_arrays(np.append(0, np.cumsum(np.bincount(own, minlength=n))).astype(np.int32),
                                      pa.StructArray.from_arrays([pa.array(s - begin[own]), pa.array(e - s), pa.array(q)], ["start", "length", "period"]))
    depth = np.zeros(len(t) + 1, np.int64)
    np.add.at(depth, s + q, 1)
    np.add.at(depth, e, -1)
    keep = np.cumsum(depth)[place] == 0
    return words, listed, _join_words(buf, starts[keep], ends[keep], rows[keep], n)


def find_runs(docs: DataFrame, least: int = LEAST, power: int = POWER) -> DataFrame:
    """doc_id, n_words, runs (start, length, period), collapsed (the text without words after the first period of a run)."""
    @tk.tidy
    def step(batches):
        for batch in batches:
            buf, offs = tk.utf8(batch.column(1))
            for lo, hi in tk.row_chunks(offs, CHUNK):
                words, listed, texts = text_runs(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], least, power)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(words.astype(np.int64)), listed, texts.cast(pa.string())],
                                                 ["doc_id", "n_words", "runs", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        step, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def digest(found: DataFrame) -> DataFrame:
    """n_runs, the longest run (ties: smallest start, then period) and digests of the runs and the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return (found.withColumn("_best", best)
                 .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"),
                         (-F.col("_best.period")).alias("period"),
                         F.floor(F.expr("1000 * _best.length div -_best.period")).cast("long").alias("exponent_milli"),
                         F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def plant(docs: DataFrame) -> DataFrame:
    """doc_id and text with planted runs: by a hash of the id, a tenth of the texts repeat words from some place on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    word = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    df = docs.select("doc_id", "text", h.alias("_h")).withColumn("_w", F.when(F.col("_h") % 10 == 0, word))
    df = df.withColumn("_n", F.size("_w")).withColumn("_g", F.floor(F.col("_h") / 10)).withColumn("_a", (F.col("_g") % F.expr("nullif(_n, 0)")).cast("int"))
    df = df.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int"))
    again = "flatten(array_repeat(slice(_w, _a + 1, _p), cast(ceil((_n - _a) / _p) as int)))"
    made = F.expr(f"array_join(concat(slice(_w, 1, _a), slice({again}, 1, _n - _a)), ' ')")
    return df.select("doc_id", F.when(F.col("_n") > 0, made).otherwise(F.col("text")).alias("text"))
