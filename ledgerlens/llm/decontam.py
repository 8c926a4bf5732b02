"""Benchmark decontamination with a generalised suffix automaton over the test items.

Items are normalised (A-Z lowered, words are runs of digits, letters a-z and non-ASCII
characters) and indexed by one automaton per block of items.  Training texts stream through it:
the state is the longest suffix read so far that occurs in some item.  Where that length reaches
the window, the words of the window are hit.  An item shorter than a window counts when it occurs
as a whole.

Scale: documents are only scanned (no shuffle, no per-document join).  Items are dealt into
blocks of at most about ``block_bytes``; each block is collected, built on the driver and broadcast by itself.
The documents carry their partial hits from block to block and are staged after every ``GROUP`` blocks, so a
stage holds ``GROUP`` blocks of items at most.  Only runs of words whose neighbouring pairs occur
in items are walked; this is exact, since no match can extend past a pair no item has.

Defined results: null or empty text: no words, no hits.  Null item text: no windows.  Null item id:
the empty string.  Repeated item ids count once.  Repeated documents are judged each by itself.
Empty benchmark: nothing is hit.  Very long texts are walked whole; there are no ties.  Extra document columns pass
through, whatever their names, in ``decontaminate``; in ``match`` one with the name of an output column is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import textkit as tk
from ledgerlens.session import materialize

WINDOW = 10
GROUP = 4  # blocks of items that documents pass in one stage
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
STATE = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
                      T.StructField("longest_match", T.LongType()), T.StructField("hit_words", T.ArrayType(SPAN))])
OUTPUTS = ("n_words", "n_hit", "n_items", "items", "longest_match", "hit_words")


class SuffixAutomaton:
    """Generalised suffix automaton of word-id sequences, with the items of every window."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window, self.next, self.link, self.length = window, [{}], [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # the state of each length class that holds the window-long suffix
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.at_window = [0] * len(order)
        for s in order:
            if self.length[s] >= window:
                p = self.link[s]
                self.at_window[s] = self.at_window[p] if self.length[p] >= window else s
        self.items: dict[int, set[str]] = {}
        self.whole: dict[int, list[tuple[int, str]]] = {}
        own: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            s = 0
            for n, w in enumerate(words, 1):
                s = self.next[s][w]
                if n >= window:
                    self.items.setdefault(self.at_window[s], set()).add(name)
            if 0 < len(words) < window:
                own.setdefault(s, []).append((len(words), name))
        if own:
            for s in order:
                got = own.get(s, []) + (self.whole.get(self.link[s], []) if s else [])
                if got:
                    self.whole[s] = got

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return cur

    def _clone(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        c = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = c
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = c
            p = link[p]
        return c

    def walk(self, words: list[int], at: int, starts: list[int], ends: list[int], found: set[str]) -> int:
        """Stream words (positions from ``at``); add hit word spans and items; longest match."""
        s = n = best = 0
        for i, w in enumerate(words, at + 1):
            while s and w not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            s = self.next[s].get(w, 0)
            n = n + 1 if s else 0
            best = n if n > best else best
            if n >= self.window:
                starts.append(i - self.window)
                ends.append(i)
                found |= self.items[self.at_window[s]]
            for m, name in self.whole.get(s, ()):
                if m <= n:
                    starts.append(i - m)
                    ends.append(i)
                    found.add(name)
        return best


def build_block(rows: list[tuple[str, str]], window: int) -> dict:
    """Automaton, sorted vocabulary and known word pairs of one block of items."""
    col = pa.array([t or "" for _, t in rows], pa.string())
    buf, offs = tk.utf8(col)
    _, _, owner, h = tk.word_hashes(buf, offs, tk.ALNUM)
    vocab, ids = np.unique(h, return_inverse=True)
    cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
    items = [(name, ids[a:b].tolist()) for (name, _), a, b in zip(rows, cuts, cuts[1:])]
    same = owner[1:] == owner[:-1]
    pairs = np.unique(ids[:-1][same] * np.int64(len(vocab)) + ids[1:][same])
    shortest = min([window, *(len(w) for _, w in items if w)])
    return {"vocab": vocab, "pairs": pairs, "shortest": shortest, "auto": SuffixAutomaton(items, window)}


def _lookup(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Index of each value in a sorted array, -1 where absent."""
    if not len(sorted_values):
        return np.full(len(x), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return np.where(sorted_values[at] == x, at, -1)


def match_rows(block: dict, rows: np.ndarray, h: np.ndarray, n_rows: int) -> list[tuple[list, list, set, int]]:
    """Per row: hit spans in word positions, items found, longest match."""
    out: list = [([], [], set(), 0) for _ in range(n_rows)]
    ids = _lookup(block["vocab"], h)
    known = np.flatnonzero(ids >= 0)
    if not len(known):
        return out
    first = np.searchsorted(rows, np.arange(n_rows))
    k, r = ids[known], rows[known]
    joined = np.zeros(len(known), bool)  # the word continues the run of the word before
    near = (known[1:] == known[:-1] + 1) & (r[1:] == r[:-1])
    joined[1:][near] = _lookup(block["pairs"], k[:-1][near] * np.int64(len(block["vocab"])) + k[1:][near]) >= 0
    begin = np.flatnonzero(~joined)
    size = np.diff(np.append(begin, len(known)))
    for a, n in zip(begin[size >= block["shortest"]].tolist(), size[size >= block["shortest"]].tolist()):
        row = int(r[a])
        starts, ends, found, best = out[row]
        got = block["auto"].walk(k[a:a + n].tolist(), int(known[a] - first[row]), starts, ends, found)
        out[row] = (starts, ends, found, max(best, got))
    return out


def _merge_spans(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Blocks of (item id, text), one at a time on the driver, each near ``block_bytes``; and whether it is the last."""
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").alias("text"))
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = 1 + size // block_bytes
    for i in range(n):
        part = b.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) if n > 1 else b
        yield [(r["item"], r["text"]) for r in part.toLocalIterator()], i == n - 1


def _matched(docs: DataFrame, benchmark: DataFrame, window: int, block_bytes: int, cut: bool = False) -> DataFrame:
    """``doc`` (all columns) and ``state`` (n_words, items, longest_match, hit_words) of every document.

    With ``cut`` also ``text``, without the hit words, from the step of the last block.
    """
    spark = docs.sparkSession
    out = docs.select(F.struct("*").alias("doc"))
    schema = T.StructType([out.schema["doc"], T.StructField("state", STATE)])
    with_text = T.StructType([*schema.fields, T.StructField("text", T.StringType())])
    arrow_state = pa.struct([("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("longest_match", pa.int64()),
                             ("hit_words", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    for at, (rows, last) in enumerate(_blocks(benchmark, block_bytes)):
        if at and at % GROUP == 0:  # the blocks before are not held any longer
            out = materialize(out, "decontam")
        block = spark.sparkContext.broadcast(build_block(rows, window))

        @tk.tidy
        def step(batches, block=block, ends=cut and last):
            b = block.value
            for batch in batches:
                buf, offs = tk.utf8(pc.struct_field(batch.column(0), "text"))
                prior = batch.column(1).to_pylist() if batch.num_columns > 1 else None
                state = []
                for lo, hi in tk.row_chunks(offs):
                    _, _, r, h = tk.word_hashes(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], tk.ALNUM)
                    count = np.bincount(r, minlength=hi - lo)
                    for i, (s, e, found, best) in enumerate(match_rows(b, r, h, hi - lo)):
                        if prior:
                            p = prior[lo + i]
                            s = s + [x["start"] for x in p["hit_words"]]
                            e = e + [x["end"] for x in p["hit_words"]]
                            found, best = found | set(p["items"]), max(best, p["longest_match"])
                        state.append({"n_words": int(count[i]), "items": sorted(found), "longest_match": best,
                                      "hit_words": [{"start": x, "end": y} for x, y in _merge_spans(s, e)]})
                cols = [batch.column(0), pa.array(state, arrow_state)]
                if ends:
                    texts = pc.struct_field(batch.column(0), "text").to_pylist()
                    for i, s in enumerate(state):
                        if s["hit_words"]:
                            texts[i] = cut_words(texts[i], [(x["start"], x["end"]) for x in s["hit_words"]])
                    cols.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, ["doc", "state", "text"][:len(cols)])

        out = out.mapInArrow(step, with_text if cut and last else schema)
    return out


def _n_hit():
    return F.aggregate("state.hit_words", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])


def match(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = 1 << 20) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, items, longest_match, hit_words`` (hit word spans).

    ``items`` is sorted as strings; ``hit_words`` holds disjoint [start, end) word positions.
    """
    found = _matched(docs.drop(*OUTPUTS), benchmark, window, block_bytes)
    return found.select("doc.*", "state.n_words", _n_hit().alias("n_hit"), F.size("state.items").cast("long").alias("n_items"), "state.items",
                        "state.longest_match", "state.hit_words")


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words (and what stands between them) of the word spans."""
    buf = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = tk.word_spans(tk.LOWER[buf], np.array([0, len(buf)]), tk.ALNUM)
    out, at = [], 0
    for a, b in spans:
        out.append(buf[at:starts[a]].tobytes())
        at = int(ends[b - 1])
    out.append(buf[at:].tobytes())
    return b"".join(out).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.8, block_bytes: int = 1 << 20) -> DataFrame:
    """Remove matched spans from the texts; documents whose words are hit beyond ``max_coverage`` go.

    Returns the columns of ``docs`` (``n_chars``, when present, follows the new text).
    """
    found = _matched(docs, benchmark, window, block_bytes, cut=True)
    out = found.where(_n_hit() <= max_coverage * F.col("state.n_words"))
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(fresh.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """Per document: the counts and a digest of the items."""
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"), "longest_match")


