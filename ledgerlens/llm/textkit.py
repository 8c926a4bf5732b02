"""Vectorised text primitives used inside tasks: numpy over Arrow string buffers.

A column of texts is one byte buffer plus row offsets.  Words are found by a 256-entry byte
class table and hashed by prefix sums of ``table[byte] * base**i`` modulo the prime 2^31 - 1 for two bases, so a
whole batch of texts is tokenised and hashed without a Python loop over words.  Two different
words of n bytes share both sums with probability about (n / 2^31)^2 over the choice of bases; a power of two
as modulus would let whole families of words collide whatever the bases are.

Null texts are empty.  Memory is bounded by the batch: 64-bit temporaries are made for blocks
of ``BLOCK`` bytes (or one word, if a single word is longer).
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
U64 = np.uint64
_PRIME = U64((1 << 31) - 1)
_BASES = (0x2F0B4F47, 0x51A3C9D5)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply / xor-shift), vectorised."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_BYTE = mix64(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F)) % _PRIME

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: bytes that are part of a word: everything but ASCII white space
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 9, 10, 11, 12, 13]] = False
#: digits, lower-case a-z and every byte of a non-ASCII character (after A-Z are lowered)
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def release() -> None:
    """Give memory freed in this process back to the system (Python workers outlive their tasks)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it keeps its own policy


def tidy(fn):
    """A task function over record batches that releases memory when it ends."""
    @functools.wraps(fn)
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release()
    return run


@contextlib.contextmanager
def small_batches(spark, size: str = "8m"):
    """Arrow batches of ``size`` in the jobs run meanwhile, whose rows hold whole texts or sets; then the session's own again.

    Every concurrent task holds a batch on both sides of the pipe, in and out.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if own is None else spark.conf.set(name, own)


def fresh(df, name: str) -> str:
    """``name``, or the name with underscores added until ``df`` has no such column (in either case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (int64, n + 1) of an Arrow string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):  # an empty or still chunked column
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    offs = np.frombuffer(off, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def row_chunks(offs: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay near ``limit`` (a longer single row is a range of its own)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """``base**i`` modulo the prime for i < n."""
    if base not in _POW or len(_POW[base]) < n:
        out = np.ones(1, U64)
        while len(out) < max(n, BLOCK):
            out = np.concatenate([out, out * U64(pow(base, len(out), int(_PRIME))) % _PRIME])
        _POW[base] = out.astype(np.uint32)
    return _POW[base]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, code=None) -> np.ndarray:
    """64-bit hash of every span ``[start, end)``; spans are sorted by start and may overlap.

    ``buf`` holds bytes, or larger codes that ``code`` maps to 64 bits.
    """
    out = np.empty(len(starts), U64)
    lo = 0
    while lo < len(starts):
        a = int(starts[lo])
        hi = max(lo + 1, int(np.searchsorted(starts, a + BLOCK, "right")))
        b = int(ends[lo:hi].max())
        values = _BYTE[buf[a:b]] if code is None else code(buf[a:b]) % _PRIME
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        sums = np.zeros(b - a + 1, U64)
        got = (e - s).astype(U64)
        for base in _BASES:
            terms = values * _powers(base, b - a)[:b - a]
            np.cumsum((terms & _PRIME) + (terms >> U64(31)), out=sums[1:])  # terms under 2^32: no overflow
            back = _powers(pow(base, -1, int(_PRIME)), b - a)[s]
            got = (got << U64(31)) ^ ((sums[e] - sums[s]) % _PRIME * back % _PRIME)
        out[lo:hi] = got
        lo = hi
    return mix64(out)


def word_spans(buf: np.ndarray, offs: np.ndarray, table: np.ndarray, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes with ``table`` set, never across rows: starts, ends, row numbers.

    Runs also end before the bytes where ``cut`` is set.
    """
    m = table[buf]
    if not len(m):
        z = np.zeros(0, np.int64)
        return z, z, z
    edge = np.zeros(len(m) + 1, bool)
    edge[offs] = True
    if cut is not None:
        edge[:-1] |= cut
    before = np.empty_like(m)
    before[0], before[1:] = False, m[:-1]
    after = np.empty_like(m)
    after[-1], after[:-1] = False, m[1:]
    starts = np.flatnonzero(m & (~before | edge[:-1]))
    ends = np.flatnonzero(m & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def word_hashes(buf: np.ndarray, offs: np.ndarray, table: np.ndarray, lower: bool = True):
    """Starts, ends, rows and 64-bit hashes of the words of a batch of texts."""
    b = LOWER[buf] if lower else buf
    starts, ends, rows = word_spans(b, offs, table)
    return starts, ends, rows, span_hashes(b, starts, ends)


_ORDER = mix64(np.arange(1, 65, dtype=U64) * U64(0xE7037ED1A0B428DB)) | U64(1)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive items (len(h) - k + 1 of them, order matters)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out += h[j:j + n] * _ORDER[j]
    return mix64(out)


def shingles(rows: np.ndarray, h: np.ndarray, n_rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingles per row, as (row, hash) sorted by row then hash.

    A row with words but fewer than ``k`` of them has one shingle, all its words; a row without
    words has none.
    """
    g = gram_hashes(h, k)
    ok = rows[:len(g)] == rows[k - 1:] if len(g) else np.zeros(0, bool)
    r, g = rows[:len(g)][ok], g[ok]
    count = np.bincount(rows, minlength=n_rows)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        first = np.searchsorted(rows, short)
        extra = np.array([int(mix64(np.add.reduce(h[f:f + count[s]] * _ORDER[:count[s]], keepdims=True, dtype=U64))[0])
                          for f, s in zip(first, short)], U64)
        r, g = np.concatenate([r, short]), np.concatenate([g, extra])
    o = np.lexsort((g, r))
    r, g = r[o], g[o]
    if len(r):
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
        r, g = r[new], g[new]
    return r, g


def code_points(buf: np.ndarray) -> np.ndarray:
    """Number of characters before each byte position (len + 1 entries)."""
    out = np.zeros(len(buf) + 1, np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=out[1:])
    return out


def gram_blocks(buf: np.ndarray, offs: np.ndarray, order: int, pad: int, block: int = BLOCK):
    """(code, row) of the ``order``-gram of bytes that ends at every byte, in blocks of the buffer.

    The last byte is the lowest of the code; texts read as if ``pad`` bytes stood before them.
    """
    for lo in range(0, len(buf), block):
        hi = min(lo + block, len(buf))
        first = int(np.searchsorted(offs, lo, "right")) - 1
        last = int(np.searchsorted(offs, hi, "left"))
        rows = np.repeat(np.arange(first, last), np.diff(np.clip(offs[first:last + 1], lo, hi)))
        at = np.arange(lo, hi) - offs[rows]
        code = buf[lo:hi].astype(U64)
        for j in range(1, order):
            past = np.full(hi - lo, pad, U64)
            skip = max(0, j - lo)
            past[skip:] = buf[lo - j + skip:hi - j]
            past[at < j] = pad
            code |= past << U64(8 * j)
        yield code, rows
