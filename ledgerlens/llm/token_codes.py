"""Token ids in directly addressable codes (DAC): any token is read without block decoding.

Each id is cut into 8-bit chunks.  Level 0 holds the low chunk of every id; a bitmap of level k
says which of its entries continue on level k + 1; a rank directory gives the number of set bits
before every 512-bit block, so the place of the next chunk is one directory read and the
popcount of at most 512 bits.  Ids below 256 cost 9 bits, ids below 65,536 18 bits.

File format (all integers little-endian).  A file is a sequence of segments, each followed by
``TRAILER``.  A segment: magic ``LLDAC01\\0``, then u64 header length, JSON header (n_docs, n,
levels, byte length of each section, crc32 of the sections), then the sections: doc ids (i64;
nulls flagged in a bitmap byte each), doc starts (u64, n_docs + 1, in tokens of the segment), per
level: chunks (u8), continuation bitmap (u64 words), rank directory (u64 per 512 bits).

Scale: texts are range-partitioned by doc id (one shuffle of the texts), each task encodes its
sorted run and emits segments of about ``segment_tokens`` tokens, and Spark's text writer stores
them (``TRAILER`` is its line separator), so commits are atomic and any store works.  The tokenizer
sees each distinct unit of text (a word without the signs after it) once per cache.  Global starts come from one row of
totals per file.

Defined results: null text is empty (only the end id); null doc ids come first; repeated doc ids
are kept, ordered by text hash; an empty table writes no segments.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.session import scratch_path

MAGIC = b"LLDAC01\0"
TRAILER = "\nLLDACEND\n"
BLOCK_BITS = 512


# ------------------------------------------------------------------ the code
def rank_directory(words: np.ndarray) -> np.ndarray:
    """Set bits before each 512-bit block of a bitmap of 64-bit words."""
    per = np.bitwise_count(words).astype(np.uint64)
    pad = np.zeros(-len(per) % 8, np.uint64)
    blocks = np.concatenate([per, pad]).reshape(-1, 8).sum(axis=1, dtype=np.uint64)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(blocks, dtype=np.uint64)])


def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, continuation bitmap, rank directory) per level of unsigned ids."""
    out, rest = [], ids.astype(np.uint64)
    while True:
        more = rest >> np.uint64(8)
        on = more > 0
        bits = np.packbits(on, bitorder="little")
        words = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view(np.uint64)
        out.append(((rest & np.uint64(255)).astype(np.uint8), words, rank_directory(words)))
        rest = more[on]
        if not len(rest):
            return out


def header(view: memoryview) -> tuple[dict, int]:
    """Header of a segment and where its sections begin."""
    if bytes(view[:8]) != MAGIC:
        raise ValueError("not a DAC segment")
    size = int.from_bytes(view[8:16], "little")
    return json.loads(bytes(view[16:16 + size])), 16 + size


class Segment:
    """A parsed segment; ``access`` reads single tokens, ``slice`` a run of them."""

    def __init__(self, blob):
        view = memoryview(blob)
        head, at = header(view)
        body = view[at:]
        if len(body) != sum(head["sections"]) or zlib.crc32(body) != head["crc32"]:
            raise ValueError("damaged DAC segment")
        parts, at = [], 0
        for n in head["sections"]:
            parts.append(body[at:at + n])
            at += n
        self.n, self.n_docs = head["n"], head["n_docs"]
        self.doc_ids = np.frombuffer(parts[0], np.int64)
        self.null = np.frombuffer(parts[1], np.uint8).astype(bool)
        self.starts = np.frombuffer(parts[2], np.uint64).astype(np.int64)
        self.levels = [(np.frombuffer(parts[i], np.uint8), np.frombuffer(parts[i + 1], np.uint64), np.frombuffer(parts[i + 2], np.uint64))
                       for i in range(3, len(parts), 3)]

    def access(self, i: int) -> int:
        """The token at position ``i``, from one chunk per level and a rank between them."""
        value, shift = 0, 0
        for chunks, words, ranks in self.levels:
            value |= int(chunks[i]) << shift
            w, b = i >> 6, i & 63
            if not (int(words[w]) >> b) & 1:
                return value
            first = w & ~7
            i = (int(ranks[w >> 3]) + int(np.bitwise_count(words[first:w]).sum())
                 + (int(words[w]) & ((1 << b) - 1)).bit_count())
            shift += 8
        raise ValueError("continuation beyond the last level")

    def _rank(self, level: int, i: int) -> int:
        _, words, ranks = self.levels[level]
        w, b = i >> 6, i & 63
        part = (int(words[w]) & ((1 << b) - 1)).bit_count() if b else 0
        return int(ranks[w >> 3]) + int(np.bitwise_count(words[w & ~7:w]).sum()) + part

    def slice(self, lo: int, hi: int) -> np.ndarray:
        """Tokens ``lo:hi``: on each level they are one run, found by two ranks."""
        out = np.zeros(hi - lo, np.uint32)
        where = np.arange(hi - lo)
        for k, (chunks, words, _) in enumerate(self.levels):
            if hi <= lo:
                break
            out[where] |= chunks[lo:hi].astype(np.uint32) << np.uint32(8 * k)
            bits = np.unpackbits(words[lo >> 6:((hi - 1) >> 6) + 1].view(np.uint8), bitorder="little")[lo & 63:(lo & 63) + hi - lo]
            where = where[bits.astype(bool)]
            lo, hi = (self._rank(k, lo), self._rank(k, hi)) if len(where) else (0, 0)
        return out


def segment(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    """Bytes of one segment."""
    starts = np.zeros(len(lengths) + 1, np.uint64)
    np.cumsum(np.asarray(lengths, np.uint64), out=starts[1:])
    sections = [np.array([0 if d is None else d for d in doc_ids], np.int64),
                np.array([d is None for d in doc_ids], np.uint8), starts]
    for level in encode_levels(ids):
        sections += level
    raw = [s.tobytes() for s in sections]
    crc = 0
    for r in raw:
        crc = zlib.crc32(r, crc)
    head = json.dumps({"n_docs": len(doc_ids), "n": len(ids), "levels": (len(raw) - 3) // 3,
                       "sections": [len(r) for r in raw], "crc32": crc}).encode()
    return b"".join([MAGIC, len(head).to_bytes(8, "little"), head, *raw])


def split_segments(data) -> list[memoryview]:
    """Segments of a file, by their own lengths."""
    view, at, out, end = memoryview(data), 0, [], len(TRAILER.encode())
    while at < len(view):
        head, begin = header(view[at:])
        stop = at + begin + sum(head["sections"])
        out.append(view[at:stop])
        at = stop + end
    return out


# ------------------------------------------------------------------ tokens of texts
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_OTHER = tk.NOT_SPACE & ~_LETTER
_OTHER[0x80:] = False


def units(buf: np.ndarray, offs: np.ndarray):
    """Runs of text whose ids do not depend on their surroundings: starts, ends, rows, bytes.

    The tokenizer lowers case, drops white space, and its pieces never go from a letter to a sign
    or digit, so words end there too and A-Z are lowered.  Where ``<|`` occurs (a special token may
    follow) texts are only split at white space.
    """
    if b"<|" in buf.tobytes():
        return *tk.word_spans(buf, offs, tk.NOT_SPACE), buf
    cut = np.zeros(len(buf), bool)
    cut[1:] = _LETTER[buf[:-1]] & _OTHER[buf[1:]]
    buf = tk.LOWER[buf]
    return *tk.word_spans(buf, offs, tk.NOT_SPACE, cut), buf


class WordTokenizer:
    """Ids of whole texts; each distinct unit of text is encoded once per cache.

    The cache holds sorted runs of word hashes, merged as they grow; beyond ``limit`` words it
    starts anew.
    """

    MARK = "<|endoftext|>"  # a special token: words on its two sides are encoded apart

    def __init__(self, path: str, limit: int = 1 << 20):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok, self.limit = Tokenizer.from_file(path), limit
        self.mark = self.tok.token_to_id(self.MARK)
        self.ends = np.zeros(self.tok.get_vocab_size(), bool)  # tokens that end a piece
        self.ends[[i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []
        self.ids, self.first = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _words(self, words: list[bytes]) -> None:
        """Encode new units, some hundreds at a time.

        Units of letters alone are one piece of the tokenizer each: joined by spaces, every one ends
        with its first word-end token.  Others have marks between them, or go alone.
        """
        texts = [w.decode() for w in words]
        plain = np.array([t.lower().isalpha() for t in texts], bool)
        odd = np.array(["<|" in t for t in texts], bool)
        ids, sizes = [], np.zeros(len(words), np.int64)
        for group, glue in ((np.flatnonzero(plain), " "), (np.flatnonzero(~plain & ~odd), self.MARK)):
            for lo in range(0, len(group), 500):
                some = group[lo:lo + 500]
                joined = glue.join([texts[i] for i in some]) + (glue if glue != " " else "")
                flat = np.array(self.tok.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
                stops = np.flatnonzero(self.ends[flat] if glue == " " else flat == self.mark)
                if len(stops) != len(some):
                    odd[some] = True
                    continue
                n = np.diff(stops, prepend=-1) - (glue != " ")
                ids.append((some, n, flat if glue == " " else flat[flat != self.mark]))
        for i in np.flatnonzero(odd):
            got = np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, np.int64)
            ids.append((np.array([i]), np.array([len(got)]), got))
        for some, n, _ in ids:
            sizes[some] = n
        first = np.cumsum(sizes) - sizes
        out = np.zeros(int(sizes.sum()), np.uint32)
        for some, n, flat in ids:
            out[np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(len(flat))] = flat
        self.ids = np.concatenate([self.ids, out])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sizes)])

    def _places(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        for known, place in self.runs:
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[at] == keys
            out[hit] = place[at[hit]]
        return out

    def _add(self, keys: np.ndarray, place: np.ndarray) -> None:
        self.runs.append((keys, place))
        while len(self.runs) > 1 and len(self.runs[-2][0]) < 2 * len(self.runs[-1][0]):
            (a, x), (b, y) = self.runs[-2:]
            k, v = np.concatenate([a, b]), np.concatenate([x, y])
            o = np.argsort(k, kind="stable")
            self.runs[-2:] = [(k[o], v[o])]

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each text."""
        starts, ends, rows, buf = units(buf, offs)
        h = tk.span_hashes(buf, starts, ends)
        uniq, where, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.first) + len(uniq) > self.limit:
            self.clear()
        place = self._places(uniq)
        new = np.flatnonzero(place < 0)
        if len(new):
            data = buf.tobytes()
            place[new] = len(self.first) - 1 + np.arange(len(new))
            self._words([data[a:b] for a, b in zip(starts[where[new]].tolist(), ends[where[new]].tolist())])
            self._add(uniq[new], place[new])
        place = place[inv]
        n = self.first[place + 1] - self.first[place]
        total = int(n.sum())
        begin = np.cumsum(n) - n
        ids = self.ids[np.arange(total) - np.repeat(begin - self.first[place], n)] if total else np.zeros(0, np.uint32)
        return ids, np.bincount(rows, weights=n, minlength=len(offs) - 1).astype(np.int64)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The tokenizer of this Python worker; its cache serves all tasks the worker runs."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def with_end(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """``end_id`` after the ids of every text."""
    out = np.full(len(ids) + len(lengths), end_id, np.uint32)
    stops = np.cumsum(lengths) + np.arange(len(lengths))
    keep = np.ones(len(out), bool)
    keep[stops] = False
    out[keep] = ids
    return out, lengths + 1


# ------------------------------------------------------------------ tables
def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, segment_tokens: int = 1 << 20) -> None:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order below ``path``."""
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                   .withColumn("_h", F.xxhash64("text"))
                   .repartitionByRange(_width(docs), F.col("doc_id").asc_nulls_first(), "_h")
                   .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h", "text")
                   .drop("_h"))

    @tk.tidy
    def encode(batches):
        tok = word_tokenizer(tokenizer)
        doc_ids, lengths, ids, held = [], [], [], 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            buf, offs = tk.utf8(batch.column(1))
            for lo, hi in tk.row_chunks(offs):
                got, n = tok.encode(buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                got, n = with_end(got, n, end_id)
                doc_ids += names[lo:hi]
                lengths += n.tolist()
                ids.append(got)
                held += len(got)
                if held >= segment_tokens:
                    yield pa.RecordBatch.from_arrays([pa.array([segment(doc_ids, lengths, np.concatenate(ids))], pa.binary())], ["segment"])
                    doc_ids, lengths, ids, held = [], [], [], 0
        if doc_ids:
            yield pa.RecordBatch.from_arrays([pa.array([segment(doc_ids, lengths, np.concatenate(ids))], pa.binary())], ["segment"])

    (ordered.mapInArrow(encode, "segment binary")
            .select(F.col("segment").cast("string").alias("value"))
            .write.option("lineSep", TRAILER).text(path))


def _width(docs: DataFrame) -> int:
    """Files to write: the shuffle width of the session."""
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def read(spark, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of the files below ``path``: doc_id, start, n_tokens, ids_crc32, ids_le32 (ids as 32-bit little-endian)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
                  .where("length > 0").select("path", "content"))

    @tk.tidy
    def decode(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                at = 0
                for blob in split_segments(data.as_buffer()):
                    seg = Segment(blob)
                    ids = memoryview(seg.slice(0, seg.n).astype("<u4").view(np.uint8))
                    runs = [ids[4 * a:4 * b] for a, b in zip(seg.starts[:-1].tolist(), seg.starts[1:].tolist())]
                    cols = {"file": pa.array([name] * seg.n_docs, pa.string()), "doc_id": pa.array(seg.doc_ids, mask=seg.null),
                            "local_start": pa.array(at + seg.starts[:-1]), "n_tokens": pa.array(np.diff(seg.starts)),
                            "ids_crc32": pa.array([zlib.crc32(r) for r in runs], pa.int64())}
                    if with_ids:
                        cols["ids_le32"] = pa.array([bytes(r) for r in runs], pa.binary())
                    yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
                    at += seg.n

    docs = files.mapInArrow(decode, "file string, doc_id long, local_start long, n_tokens long, ids_crc32 long" + ", ids_le32 binary" * with_ids)

    @tk.tidy
    def totals(batches):
        for batch in batches:
            n = [sum(header(blob)[0]["n"] for blob in split_segments(data.as_buffer())) for data in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["file", "total"])

    # one row per file; the writer numbers files as the doc id ranges they hold
    order = Window.orderBy(F.regexp_extract("file", r"part-(\d+)", 1).cast("long")).rowsBetween(Window.unboundedPreceding, -1)
    per_file = (files.mapInArrow(totals, "file string, total long")
                     .select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("before")))
    return (docs.join(F.broadcast(per_file), "file")
                .select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", *["ids_le32"] * with_ids))


def roundtrip(docs: DataFrame, tokenizer: str, end_id: int = 2, with_ids: bool = True) -> DataFrame:
    """Write ``docs`` under the shared checkpoint folder and read the files back."""
    path = scratch_path(docs.sparkSession, "token_codes")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path, with_ids)
