"""Token counts of whole texts by rank-synchronous array merging of byte-level BPE.

A batch of texts is cut into pre-tokens (the byte-level split pattern, evaluated on arrays of character
classes), and each distinct pre-token is merged once: all of them lie in one ragged array of symbols, every
step finds each sequence's lowest merge rank and applies that pair everywhere in its sequence at the same
time, and sequences without a pair left drop out with their number of surviving symbols.

Equal to merging one place at a time where every token has one merge and that merge comes after those of
its parts (checked when the vocabulary is read): then a merge never makes a pair of lower rank.  Places that
overlap (a run of one symbol) are taken from the left.  Other vocabularies apply the leftmost place only.  A
pre-token of more than ``LONG`` bytes is merged by a heap of places in the same order, since steps times
length would grow with its square.

Character classes come from the tokenizer itself, which is asked once per character met, so they follow the
library's version of Unicode.  Special strings in a text are one token, as the library has it by default; nothing
is added, cut or padded.

No shuffle: each task counts the rows it reads.  A text over ``PIECE`` bytes is taken in pieces cut before a
single space between two ASCII letters or digits, where a pre-token always begins, so memory follows ``PIECE`` and the
longest stretch without such a place, not the text.  The cache of counts holds ``CACHE`` short pre-tokens per worker.

Defined results: null and empty texts have 0 bytes and 0 tokens; very long texts are counted whole; repeated rows
and ids give one row each, in any order; an empty table gives none; columns besides ``doc_id`` and ``text``
are ignored, whatever their names; bytes that are not UTF-8 count as replacement characters in tokens and as
themselves in ``n_bytes``.  There are no ties: a split and a merge order are unique.
"""

from __future__ import annotations

import heapq
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ledgerlens.llm import textkit as tk

PIECE = 2 << 20
LONG = 1024
CACHE = 300_000
OTHER, LETTER, NUMBER, SPACE, UNKNOWN = range(5)
_NONE = np.int64(1) << 40  # no rank
_SAFE_CUT = re.compile(rb"[A-Za-z0-9] (?=[A-Za-z0-9])")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    extra = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(extra)) for b in range(256)]


class Merges:
    """Merge ranks of a byte-level BPE as sorted arrays."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.byte = np.array([vocab[c] for c in byte_symbols()], np.int64)
        self.width = max(vocab.values()) + 1
        left, right, made = (np.array([vocab[x] for x in part], np.int64)
                             for part in ([a for a, _ in merges], [b for _, b in merges], [a + b for a, b in merges]))
        key = left * self.width + right
        self.order = np.argsort(key)
        self.keys, self.made = key[self.order], made
        born = np.full(self.width, -1, np.int64)
        born[made] = np.arange(len(made))
        self.ordered = (len(np.unique(made)) == len(made) and not np.isin(made, self.byte).any()
                        and bool((np.maximum(born[left], born[right]) < np.arange(len(made))).all()))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], _NONE)

    def count(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Symbols left in each sequence of bytes ``buf[offs[i]:offs[i + 1]]``."""
        size = np.diff(offs)
        out = np.zeros(len(size), np.int64)
        for i in np.flatnonzero(size > LONG):
            out[i] = self._by_heap(self.byte[buf[offs[i]:offs[i + 1]]])
        name = np.flatnonzero((size > 0) & (size <= LONG))
        seq = np.repeat(np.arange(len(name)), size[name])
        sym = self.byte[buf[np.repeat(offs[name] - (np.cumsum(size[name]) - size[name]), size[name]) + np.arange(len(seq))]]
        while len(sym):
            first = np.flatnonzero(np.diff(seq, prepend=-1))
            rank = np.append(np.where(seq[1:] == seq[:-1], self.ranks(sym[:-1], sym[1:]), _NONE), _NONE)
            best = np.minimum.reduceat(rank, first)
            n = np.diff(np.append(first, len(seq)))
            done = best == _NONE
            out[name[seq[first[done]]]] = n[done]
            at = np.flatnonzero((rank == np.repeat(best, n)) & (rank < _NONE))
            if self.ordered:  # every other place of a run of overlapping ones, from its left
                run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
                at = at[(np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))) % 2 == 0]
            else:
                at = at[np.diff(seq[at], prepend=-1) != 0]
            sym[at] = self.made[rank[at]]
            keep = np.repeat(~done, n)
            keep[at + 1] = False
            sym, seq = sym[keep], seq[keep]
        return out

    def _by_heap(self, sym: np.ndarray) -> int:
        rank = self.ranks(sym[:-1], sym[1:])
        heap = [(int(rank[i]), int(i)) for i in np.flatnonzero(rank < _NONE)]
        heapq.heapify(heap)
        table = dict(zip(self.keys.tolist(), self.order.tolist()))
        made, width, value = self.made.tolist(), self.width, sym.tolist()
        after, before = list(range(1, len(value) + 1)), list(range(-1, len(value) - 1))
        left = len(value)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if value[i] < 0 or j >= len(value) or table.get(value[i] * width + value[j]) != r:
                continue  # one of the two has been merged since
            value[i], value[j] = made[r], -1
            after[i] = after[j]
            if after[j] < len(value):
                before[after[j]] = i
            left -= 1
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(value)
                if b < len(value) and (new := table.get(value[a] * width + value[b])) is not None:
                    heapq.heappush(heap, (new, a))
        return left


class Counter:
    """Counts of one tokenizer file, with the caches of this Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        known = (model["type"] == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
                 and not spec["normalizer"] and not model.get("dropout") and not model.get("ignore_merges"))
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
        if not (known and plain):
            raise ValueError(f"not a plain byte-level BPE: {path}")
        self.merges = Merges(model["vocab"], [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]])
        self.split = Tokenizer.from_file(path).pre_tokenizer
        self.special = [t["content"].encode() for t in spec["added_tokens"]]
        self.find = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.clear()

    def clear(self) -> None:
        self.cache = {s: 1 for s in self.special}

    def classify(self, points: np.ndarray) -> np.ndarray:
        """Class of every character, asking the tokenizer's split for those not met before."""
        out = self.classes[points]
        if (out == UNKNOWN).any():
            new = np.unique(points[out == UNKNOWN])
            for lo in range(0, len(new), 4096):
                some = new[lo:lo + 4096]
                probe = "".join(f"a{c}\n1{c}\n!{c}\n" for c in map(chr, some.tolist()))
                ends = {b for _, (_, b) in self.split.pre_tokenize_str(probe)}
                joined = np.array([[9 * i + 3 * k + 1 not in ends for k in range(3)] for i in range(len(some))])
                self.classes[some] = np.select([joined[:, 0], joined[:, 1], joined[:, 2]], [LETTER, NUMBER, OTHER], SPACE)
            out = self.classes[points]
        return out

    def starts(self, points: np.ndarray, edge: np.ndarray) -> np.ndarray:
        """Whether a pre-token begins at each character; ``edge`` marks where texts begin.

        Contractions, runs of letters, of numbers and of other signs, each with one space before, and white space.
        """
        kind, n = self.classify(points), len(points)
        space = kind == SPACE
        gap = np.append(False, space[:-1])
        prior = np.append(0, points[:-1])
        word = (gap & (prior != 32)) | (~gap & (kind != np.append(0, kind[:-1])))
        last = np.append(~space[1:] & ~edge[1:], False)  # the last of white space before a word
        out = edge | np.where(space, ~gap | last, word)
        at = np.flatnonzero((points == 39) & out)
        nxt = lambda k: np.where((at + k < n), points[np.minimum(at + k, n - 1)], 0)
        inside = lambda k: (at + k < n) & ~edge[np.minimum(at + k, n - 1)]
        one = inside(1) & np.isin(nxt(1), [ord(c) for c in "stmd"])
        pair = nxt(1) * 256 + nxt(2)
        two = inside(1) & inside(2) & np.isin(pair, [ord(a) * 256 + ord(b) for a, b in ("re", "ve", "ll")]) & (nxt(2) < 256)
        out[at[one | two] + 1] = False
        for hit, k in ((one, 2), (two, 3)):
            p = at[hit] + k
            out[p[p < n]] = True
        return out

    def count(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Tokens of each text of a batch."""
        data = buf.tobytes()
        try:
            text = data.decode()
        except UnicodeDecodeError:
            rows = [data[a:b].decode(errors="replace").encode() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
            offs = np.cumsum([0, *map(len, rows)])
            buf = np.frombuffer(data := b"".join(rows), np.uint8)
            text = data.decode()
        n = len(offs) - 1
        if not len(buf):
            return np.zeros(n, np.int64)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        lead = np.flatnonzero((buf & 0xC0) != 0x80)  # byte place of each character
        edge_at = [offs[:-1][np.diff(offs) > 0]]
        marks = []
        if self.find:
            spans = [m.span() for a, b in self._rows_with_mark(data, offs) for m in self.find.finditer(data, a, b)]
            marks = [(int(np.searchsorted(lead, a)), int(np.searchsorted(lead, b))) for a, b in spans]
            edge_at.append(np.array([x for s in spans for x in s if x < len(buf)], np.int64))
        edge = np.zeros(len(points), bool)
        edge[np.searchsorted(lead, np.concatenate(edge_at))] = True
        begin = self.starts(points, edge)
        for a, b in marks:
            begin[a], begin[a + 1:b] = True, False
        first = lead[begin]
        words = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(np.append(first, len(buf)).astype(np.int64)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        per = self._lengths(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
        return np.bincount(np.searchsorted(offs, first, "right") - 1, weights=per, minlength=n).astype(np.int64)

    def _rows_with_mark(self, data: bytes, offs: np.ndarray):
        hits = np.array([m.start() for m in self.find.finditer(data)], np.int64)
        for r in np.unique(np.searchsorted(offs, hits, "right") - 1).tolist():
            yield int(offs[r]), int(offs[r + 1])

    def _lengths(self, words: pa.Array) -> np.ndarray:
        """Tokens of distinct pre-tokens."""
        known = [self.cache.get(w, -1) for w in words.to_pylist()]
        out = np.array(known, np.int64)
        new = np.flatnonzero(out < 0)
        if len(new):
            some = words.take(pa.array(new))
            buf, offs = tk.utf8(some)
            out[new] = self.merges.count(buf, offs)
            if len(self.cache) > CACHE:
                self.clear()
            short = pc.less_equal(pc.binary_length(some), 48).to_numpy(zero_copy_only=False)
            self.cache.update((w, c) for w, c, s in zip(some.to_pylist(), out[new].tolist(), short.tolist()) if s)
        return out


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The counter of this Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def pieces(buf: np.ndarray, offs: np.ndarray, limit: int = PIECE):
    """(row, bytes, offsets) parts of a batch of texts near ``limit`` bytes; long texts in several parts."""
    for lo, hi in tk.row_chunks(offs, limit):
        a, b = int(offs[lo]), int(offs[hi])
        if hi - lo > 1 or b - a <= limit:
            yield lo, buf[a:b], offs[lo:hi + 1] - a
            continue
        data = buf[a:b].tobytes()
        at = 0
        while at < len(data):
            cut = _SAFE_CUT.search(data, at + limit)
            stop = cut.start() + 1 if cut else len(data)
            yield lo, buf[a + at:a + stop], np.array([0, stop - at])
            at = stop


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every text.

    ``tokenizer`` is the place of a byte-level BPE in the tokenizers library's JSON format.
    """
    @tk.tidy
    def step(batches):
        tok = counter(tokenizer)
        for batch in batches:
            buf, offs = tk.utf8(batch.column(1))
            n = np.zeros(len(batch), np.int64)
            for row, part, cut in pieces(buf, offs):
                n[row:row + len(cut) - 1] += tok.count(part, cut)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(step, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
