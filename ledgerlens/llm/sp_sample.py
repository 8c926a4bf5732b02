"""SentencePiece encoding by Gumbel top-k sampling without replacement, and decoding.

The lattice of a text has an arc for every vocabulary piece at every place; a character without a
piece is an arc of its byte pieces.  Pieces of a BPE model carry merge ranks; an arc weighs
``alpha * -log(rank + 2.7)`` (normalised over the vocabulary), bytes weigh as the last rank.
Backward sums turn arc weights into conditional probabilities, so every segmentation has an
exact probability and the whole lattice has total 1.

Search: a perturbed A-star over regions of the lattice.  The root region (all segmentations) has a
Gumbel(0) value.  Popping a region with value G samples its best segmentation from the conditional
probabilities; that segmentation has perturbed log-probability G.  What is left of the region parts
into one sub-region per arc of the path (same arcs before, another arc here), whose value is a
Gumbel with the region's log-mass, truncated at G.  The bound of a region is its own value, so
popping the largest k times gives the k segmentations with the largest perturbed log-probabilities:
a sample of k distinct ones without replacement.  The next value is the threshold kappa, and
``log_inclusion`` is log(1 - exp(-exp(log_prob - kappa))), the probability that a segmentation
exceeds it.

Randomness is a hash of (row key, sample number, place), so results do not depend on batches.
No piece spans a boundary before a space mark or around a character that is no part of a longer
piece; lattices are built once per distinct word between boundaries, in numpy, for a batch at a time.

Decoding joins pieces, bytes and space marks; it inverts every segmentation exactly (a literal
U+2581 is spelled in bytes).  Defined results: null or empty text: one sample without ids, log-prob
0.  A text with fewer than k segmentations gives all of them.  Repeated rows give equal samples.  A
null row key is the key ``null``.  Extra columns are ignored by ``sample``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk

SPACE, LITERAL = 0x2581, 0x110000  # the space mark; a space mark that stood in the text itself
U = np.uint64


class Vocabulary:
    """Pieces of a SentencePiece model with lattice weights."""

    def __init__(self, path: str, alpha: float = 1.0):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.byte_id = np.zeros(256, np.int64)
        normal, rank = [], []
        for i in range(size):
            if sp.is_byte(i):
                self.byte_id[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append((i, sp.id_to_piece(i)))
                rank.append(-sp.get_score(i))
        rank = np.minimum(np.array(rank), size)
        weight = -np.log(np.append(rank, [float(size)] * 256) + 2.7) * alpha
        weight -= np.logaddexp.reduce(weight)
        self.byte_weight = float(weight[-1])
        self.pieces = {i: p for i, p in normal}
        self.text = [self.pieces[i].replace("▁", " ").encode() if i in self.pieces else b"" for i in range(size)]
        for b, i in enumerate(self.byte_id):
            self.text[int(i)] = bytes([b])
        self.text_bytes = np.frombuffer(b"".join(self.text), np.uint8)
        self.text_at = np.concatenate([[0], np.cumsum([len(x) for x in self.text])])
        # one open-addressing table of the pieces and their prefixes, by a rolling hash of the characters
        entries: dict[int, tuple[int, float]] = {}
        self.longest, inside = max(len(p) for _, p in normal), set()
        for (i, p), w in zip(normal, weight):
            h = 0
            for c in p:
                h = (h * int(_K) + int(_code(np.array([ord(c)]))[0])) & (2 ** 64 - 1)
                entries.setdefault(h, (-1, 0.0))
            entries[h] = (i, float(w))
            if len(p) > 1:
                inside |= set(p)
        self.alone = np.ones(LITERAL + 1, bool)  # characters that are no part of a longer piece
        self.alone[[ord(c) for c in inside]] = False
        self.bits = 20
        slot = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.array(list(entries), np.uint64)
        self.ids = np.array([i for i, _ in entries.values()], np.int64)
        self.weights = np.array([w for _, w in entries.values()])
        self.probes = 1
        for e, at in enumerate((self.keys >> U(64 - self.bits)).tolist()):
            steps = 1
            while slot[at] >= 0:
                at, steps = (at + 1) % len(slot), steps + 1
            slot[at] = e
            self.probes = max(self.probes, steps)
        self.slot = slot

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, -1 where it is neither a piece nor a prefix of one."""
        at = (h >> U(64 - self.bits)).astype(np.int64)
        out = self.slot[at]
        wrong = np.flatnonzero((out >= 0) & (self.keys[out] != h))
        for _ in range(self.probes):
            if not len(wrong):
                return out
            at[wrong] = (at[wrong] + 1) & (len(self.slot) - 1)
            out[wrong] = self.slot[at[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.keys[out[wrong]] != h[wrong])]
        out[wrong] = -1
        return out


_HASH = tk.mix64(np.arange(1, LITERAL + 2, dtype=np.uint64))  # of every character


def _code(chars: np.ndarray) -> np.ndarray:
    return _HASH[chars]


_K = U(0x9E3779B97F4A7C15)


def decode(vocab: Vocabulary, ids) -> str:
    """Text of a segmentation."""
    raw = b"".join(vocab.text[int(i)] for i in ids)
    return raw[1:].decode() if raw else ""


def decode_batch(vocab: Vocabulary, ids: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of many segmentations, each still with its first space, and their offsets."""
    n = vocab.text_at[ids + 1] - vocab.text_at[ids]
    at = _offsets(n)
    return vocab.text_bytes[np.arange(at[-1]) - np.repeat(at[:-1] - vocab.text_at[ids], n)], at[offs]


# ------------------------------------------------------------------ lattices of distinct words
LONG, SCALE = 48, 2.5  # words beyond LONG characters are summed in logs; SCALE: nats a character, against underflow


class Lattices:
    """Arcs of the lattices of words (character codes with spans), in flat arrays.

    Words are sorted by length, and nodes numbered by their distance to the word's end, so the
    backward sums of one distance are one slice.  Arcs are sorted by source node (``begin``); arc a
    has probability ``way[a] / beta[source]`` given its source, ``way`` being its weight times the
    sum of its target.
    """

    def __init__(self, vocab: Vocabulary, chars: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        size = ends - starts
        self.first = np.zeros(len(size), np.int64)
        parts, nodes, arcs = [], 0, 0
        for logs in (False, True):
            some = np.flatnonzero((size > LONG) == logs)
            if not len(some):
                continue
            first, begin, dst, piece, weight, beta, distance = self._build(vocab, chars, ends[some], size[some], logs)
            self.first[some] = first + nodes
            parts.append((begin[:-1] + arcs, dst + np.int32(nodes), piece, weight, beta, distance))
            nodes, arcs = nodes + len(beta), arcs + len(dst)
        if not parts:
            parts = [tuple(np.zeros(0, t) for t in (np.int64, np.int32, np.int32, np.float64, np.float64, np.int32))]
        begin, self.dst, self.piece, self.way, self.beta, self.distance = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))
        self.begin = np.append(begin, arcs)

    @staticmethod
    def _build(vocab: Vocabulary, chars: np.ndarray, ends: np.ndarray, size: np.ndarray, logs: bool):
        order = np.argsort(-size, kind="stable")
        most = int(size[order[0]])
        have = len(size) - np.searchsorted(np.sort(size), np.arange(most + 1))  # words with that distance
        off = _offsets(have)
        nodes = int(off[-1])
        distance = np.repeat(np.arange(most + 1, dtype=np.int32), have)
        rank_of = (np.arange(nodes) - off[distance]).astype(np.int32)
        place = ends[order][rank_of] - distance
        live = np.arange(int(off[1]), nodes)
        h = np.zeros(len(live), np.uint64)
        single = np.zeros(nodes, bool)
        filled = np.zeros(nodes, np.int64)
        src, rank, length, piece, weight = [], [], [], [], []

        def add(at, n, ids, w):
            src.append(at)
            rank.append(filled[at])
            filled[at] += 1
            length.append(np.full(len(at), n, np.int32))
            piece.append(ids)
            weight.append(w + SCALE * n if logs else np.exp(w + SCALE * n))

        for n in range(1, vocab.longest + 1):
            if n > 1:
                keep = distance[live] >= n
                live, h = live[keep], h[keep]
            if not len(live):
                break
            where = place[live] + (n - 1)
            h = h * _K + _code(chars[where])
            entry = vocab.find(h)
            keep = entry >= 0                             # no piece begins like the others
            live, h, entry = live[keep], h[keep], entry[keep]
            hit = vocab.ids[entry] >= 0
            add(live[hit], n, vocab.ids[entry[hit]].astype(np.int32), vocab.weights[entry[hit]])
            if n == 1:
                single[live[hit]] = True
        bare = np.flatnonzero(~single[int(off[1]):]) + int(off[1])  # characters spelled in bytes
        code = chars[place[bare]].astype(np.int64)
        n_bytes = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + ((code > 0xFFFF) & (code != LITERAL))
        add(bare, 1, (-1 - code).astype(np.int32), n_bytes * vocab.byte_weight)
        begin = _offsets(filled)
        src, rank, length, piece, weight = (np.concatenate(x) for x in (src, rank, length, piece, weight))
        at = begin[src] + rank
        dst, own, w = np.empty(len(src), np.int32), np.empty(len(src), np.int32), np.empty(len(src))
        dst[at] = off[distance[src] - length] + rank_of[src]
        own[at], w[at] = piece, weight
        beta = np.zeros(nodes)
        beta[:have[0]] = 0.0 if logs else 1.0
        total = np.logaddexp if logs else np.add
        for d in range(1, most + 1):
            lo, hi = int(off[d]), int(off[d + 1])
            a, b = int(begin[lo]), int(begin[hi])
            w[a:b] = w[a:b] + beta[dst[a:b]] if logs else w[a:b] * beta[dst[a:b]]
            beta[lo:hi] = total.reduceat(w[a:b], begin[lo:hi] - a)
        if logs:  # conditional probabilities, with all sums 1
            w = np.exp(w - np.repeat(beta, filled))
            beta = np.ones(nodes)
        first = np.empty(len(size), np.int64)
        first[order] = off[size[order]] + np.arange(len(size))
        return first, begin, dst, own, w, beta, distance

    def source(self, arc: int) -> int:
        return int(np.searchsorted(self.begin, arc, "right")) - 1


def streams(key: np.ndarray, number: int) -> np.ndarray:
    """Seeds of one stream of random numbers from row keys."""
    return tk.mix64(key + U(0x632BE59BD9B4E019 * number % 2 ** 64))


def uniform(seed: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from stream seeds and places."""
    h = tk.mix64(seed + place.astype(np.uint64) * _K)
    return ((h >> U(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def walk(lat: Lattices, node: np.ndarray, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sample on from each node to its word's end: (index of the start, arc, its probability), in order."""
    live = np.flatnonzero(lat.distance[node] > 0) if len(node) else np.zeros(0, np.int64)
    at, now = place[live], node[live]
    owner, arcs, probs = [], [], []
    while len(live):
        beta = lat.beta[now]
        rest = uniform(seed[live], at) * beta
        first, arc = lat.begin[now], lat.begin[now + 1] - 1
        way = lat.way[arc]
        on = np.flatnonzero((arc > first) & (rest >= way))
        while len(on):                                    # long pieces first: they are likely
            rest[on] -= way[on]
            arc[on] -= 1
            way[on] = lat.way[arc[on]]
            on = on[(arc[on] > first[on]) & (rest[on] >= way[on])]
        owner.append(live)
        arcs.append(arc)
        probs.append(way / beta)
        nxt = lat.dst[arc]
        left = lat.distance[nxt]
        keep = left > 0
        at = (at + (lat.distance[now] - left))[keep]
        live, now = live[keep], nxt[keep]
    if not owner:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    steps = np.repeat(np.arange(len(owner)), [len(x) for x in owner])
    owner, arcs, probs = np.concatenate(owner), np.concatenate(arcs), np.concatenate(probs)
    to = (_offsets(np.bincount(owner, minlength=len(node)))[owner] + steps)  # an owner is there until its word ends
    out = np.empty(len(owner), np.int64), np.empty(len(owner), np.int64), np.empty(len(owner))
    for x, y in zip(out, (owner, arcs, probs)):
        x[to] = y
    return out


def _offsets(n: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(n)])


def _first_in_row(values: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest value of every (possibly empty) run and where it is."""
    n = len(offs) - 1
    best, where = np.full(n, -np.inf), np.zeros(n, np.int64)
    full = np.flatnonzero(np.diff(offs) > 0)
    if len(full):
        best[full] = np.maximum.reduceat(values, offs[full])
        row = np.repeat(np.arange(n), np.diff(offs))
        hits = np.flatnonzero(values == best[row])
        r, f = np.unique(row[hits], return_index=True)
        where[r] = hits[f]
    return best, where


def region_values(before: np.ndarray, left: np.ndarray, seed: np.ndarray, row: np.ndarray, position: np.ndarray,
                  value: np.ndarray) -> np.ndarray:
    """Gumbels of log-mass ``before + log(left)``, truncated at the path's ``value``; -inf without mass.

    A value exceeds its log-mass by 37 at most (uniforms have 53 bits), so regions under -200 are
    only worked out for texts that have none above.
    """
    region = np.full(len(before), -np.inf)
    able = (left > 0) & np.isfinite(value)[row]

    def work(some: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            noise = -np.log(uniform(seed[row[some]], position[some]))
            mass = before[some] + np.log(left[some])
            region[some] = -np.log(np.exp(-value[row[some]]) + np.exp(-mass) * noise)

    near = able & (before > -200)
    work(np.flatnonzero(near))
    served = np.zeros(len(value), bool)
    served[row[region > -150]] = True
    far = np.flatnonzero(able & ~near & ~served[row])
    if len(far):
        work(far)
    return region


def top_k(lat: Lattices, word: np.ndarray, doc_words: np.ndarray, word_place: np.ndarray, key: np.ndarray, k: int) -> list[dict]:
    """k segmentations of every document without replacement.

    ``word[i]`` is the distinct word of occurrence i; ``doc_words`` the occurrence offsets of
    documents; ``word_place`` the character place in its document; ``key`` the documents' seeds.
    Returns per sample: arcs and their offsets, log_prob, perturbed (-inf: no such sample), and for
    the last one kappa.
    """
    n = len(key)
    doc_of = np.repeat(np.arange(n), np.diff(doc_words))
    start = lat.first[word]
    zero = np.zeros(n, np.int64)
    value = -np.log(-np.log(uniform(streams(key, 0), zero)))                       # Gumbel(0) of the root regions
    owner, arcs, prob = walk(lat, start, word_place, streams(key, 1)[doc_of])
    arc_doc = doc_of[owner]
    out: list[dict] = []
    fixed, banned = np.full(n, -1), [()] * n                              # the arc number with banned arcs, and those
    open_mass = np.zeros(n)                                               # what is left beside them
    offs = _offsets(np.bincount(arc_doc, minlength=n))
    occurrence = owner
    for r in range(1, k + 1):
        prob = np.minimum(prob, 1.0)
        log_q = np.log(prob)
        total = np.cumsum(log_q)
        base = np.concatenate([[0.0], total])
        before = base[:-1] - np.repeat(base[offs[:-1]], np.diff(offs))
        log_prob = base[offs[1:]] - base[offs[:-1]]
        left = 1.0 - prob                                                 # mass of the other arcs there; 0 for an only arc
        position = np.arange(len(arcs)) - np.repeat(offs[:-1], np.diff(offs))
        row = np.repeat(np.arange(n), np.diff(offs))
        if r > 1:
            left[position < fixed[row]] = 0.0                             # these regions stay with the earlier path
            for d in np.flatnonzero(fixed >= 0):
                i = offs[d] + fixed[d]
                left[i] = open_mass[d]
        region = region_values(before, left, streams(key, 1000 + r), row, position, value)
        out.append({"arcs": arcs, "offs": offs, "log_prob": log_prob, "perturbed": value, "region": region, "before": before,
                    "prob": prob, "fixed": fixed, "banned": banned, "occurrence": occurrence})
        # the best region of every document, over the paths so far
        best, path, where = np.full(n, -np.inf), zero.copy(), zero.copy()
        for j, o in enumerate(out):
            b, w = _first_in_row(o["region"], o["offs"])
            more = b > best
            best[more], path[more], where[more] = b[more], j, w[more]
        if r == k:
            out[-1]["kappa"] = best
            break
        value = best
        new_arcs, new_occ, new_prob, lens = [], [], [], np.zeros(n, np.int64)
        fixed, banned = np.full(n, -1), [()] * n
        node, at, cur = np.zeros(n, np.int64), zero.copy(), np.full(n, -1)
        heads: list = [None] * n
        draw = uniform(streams(key, 2000 + r), where - np.concatenate([o["offs"][:-1] for o in out]).reshape(len(out), n)[path, np.arange(n)])
        open_mass, pick_prob = np.zeros(n), np.zeros(n)
        for d in np.flatnonzero(np.isfinite(best)):
            o, i = out[path[d]], int(where[d])
            o["region"][i] = -np.inf
            t = i - int(o["offs"][d])
            arc = int(o["arcs"][i])
            no = o["banned"][d] if o["fixed"][d] == t else (arc,)
            src = lat.source(arc)
            lo, hi = int(lat.begin[src]), int(lat.begin[src + 1])
            open_ = [a for a in range(lo, hi) if a not in no]
            p = (lat.way[open_] / lat.beta[src]).tolist()
            u = float(draw[d]) * sum(p)
            j = 0
            while j < len(p) - 1 and u >= p[j]:
                u, j = u - p[j], j + 1
            pick = open_[j]
            open_mass[d], pick_prob[d] = sum(p) - p[j] if len(p) > 1 else 0.0, p[j]
            fixed[d], banned[d] = t, (*no, pick)
            occ = int(o["occurrence"][i])
            s = int(o["offs"][d])
            heads[d] = (o["arcs"][s:i], o["occurrence"][s:i], o["prob"][s:i], pick, occ)
            cur[d], node[d] = occ, lat.dst[pick]
            at[d] = word_place[occ] + (lat.distance[start[occ]] - lat.distance[lat.dst[pick]])
        # the rest of the current word, and all words after it, are sampled anew
        live = np.flatnonzero(cur >= 0)
        after = np.arange(len(word)) > cur[doc_of]
        after &= (cur >= 0)[doc_of]
        ids = np.concatenate([cur[live], np.flatnonzero(after)])
        nodes = np.concatenate([node[live], start[after]])
        places = np.concatenate([at[live], word_place[after]])
        order = np.argsort(ids, kind="stable")
        ids, nodes, places = ids[order], nodes[order], places[order]
        owner, tail, tail_prob = walk(lat, nodes, places, streams(key, r + 1)[doc_of[ids]])
        tail_occ = ids[owner]
        cut = np.searchsorted(doc_of[tail_occ], np.arange(n + 1))
        for d in range(n):
            if heads[d] is None:
                continue
            a, o, p, pick, occ = heads[d]
            new_arcs += [a, [pick], tail[cut[d]:cut[d + 1]]]
            new_occ += [o, [occ], tail_occ[cut[d]:cut[d + 1]]]
            new_prob += [p, [pick_prob[d]], tail_prob[cut[d]:cut[d + 1]]]
            lens[d] = len(a) + 1 + cut[d + 1] - cut[d]
        arcs = np.concatenate(new_arcs).astype(np.int64) if new_arcs else np.zeros(0, np.int64)
        occurrence = np.concatenate(new_occ).astype(np.int64) if new_occ else np.zeros(0, np.int64)
        prob = np.concatenate(new_prob) if new_prob else np.zeros(0)
        offs = _offsets(lens)
    return out


# ------------------------------------------------------------------ texts
def characters(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the texts of a batch, each non-empty one with a space mark before it, and offsets."""
    codes = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
    at = tk.code_points(buf)[offs]
    codes = np.where(codes == SPACE, np.uint32(LITERAL), codes)
    codes = np.where(codes == 0x20, np.uint32(SPACE), codes)
    n = np.diff(at)
    full = (n > 0).astype(np.int64)
    out = np.full(len(codes) + int(full.sum()), SPACE, np.uint32)
    keep = np.ones(len(out), bool)
    new = _offsets(n + full)
    keep[new[:-1][full > 0]] = False
    out[keep] = codes
    return out, new


def word_cuts(vocab: Vocabulary, chars: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words no piece spans, and their offsets per document."""
    mark = chars == SPACE
    alone = vocab.alone[chars]
    cut = np.zeros(len(chars) + 1, bool)
    cut[1:-1] = (mark[1:] & ~mark[:-1]) | alone[1:] | alone[:-1]
    cut[offs] = True
    edges = np.flatnonzero(cut)
    return edges[:-1], edges[1:], np.searchsorted(edges, offs)


def spell(vocab: Vocabulary, pieces: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of arcs' pieces, characters without a piece as their bytes; and new offsets."""
    bare = np.flatnonzero(pieces < 0)
    if not len(bare):
        return pieces, offs
    spelled = {}
    for c in np.unique(pieces[bare]).tolist():
        code = -1 - c
        spelled[c] = vocab.byte_id[list(chr(SPACE if code == LITERAL else code).encode())]
    n = np.ones(len(pieces), np.int64)
    n[bare] = [len(spelled[c]) for c in pieces[bare].tolist()]
    at = _offsets(n)
    out = np.repeat(pieces, n)
    for c, ids in spelled.items():
        where = at[bare[pieces[bare] == c]]
        for j, i in enumerate(ids):
            out[where + j] = i
    return out, at[offs]


def row_keys(keys: list) -> np.ndarray:
    col = pa.array(["null" if x is None else str(x) for x in keys], pa.string())
    buf, offs = tk.utf8(col)
    return tk.span_hashes(buf, offs[:-1], offs[1:]) if len(keys) else np.zeros(0, np.uint64)


def sample_texts(vocab: Vocabulary, buf: np.ndarray, offs: np.ndarray, key: np.ndarray, k: int) -> list[dict]:
    """Per sample number: ids, offsets, log_prob, perturbed, log_inclusion of a batch of texts."""
    chars, at = characters(buf, offs)
    starts, ends, doc_words = word_cuts(vocab, chars, at)
    h = tk.span_hashes(chars, starts, ends, _code)
    _, where, word = np.unique(h, return_index=True, return_inverse=True)
    lat = Lattices(vocab, chars, starts[where], ends[where])
    place = starts - np.repeat(at[:-1], np.diff(doc_words))
    found = top_k(lat, word, doc_words, place, key, k)
    kappa = found[-1]["kappa"]
    out = []
    for f in found:
        ids, cut = spell(vocab, lat.piece[f["arcs"]], f["offs"])
        gap = f["log_prob"] - kappa
        with np.errstate(over="ignore", divide="ignore"):
            inclusion = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(np.minimum(gap, 700)))))
        out.append({"ids": ids, "offs": cut, "log_prob": f["log_prob"], "perturbed": f["perturbed"],
                    "log_inclusion": np.where(np.isneginf(kappa), 0.0, inclusion)})
    return out


def same_texts(vocab: Vocabulary, ids: np.ndarray, offs: np.ndarray, buf: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Whether decoding each segmentation gives back its text."""
    got, at = decode_batch(vocab, ids, offs)
    size, want = np.diff(at), np.diff(cut)
    same = size == want + (want > 0)
    rows = np.flatnonzero(same & (want > 0))
    a = np.repeat(at[rows] + 1 - _offsets(want[rows])[:-1], want[rows]) + np.arange(int(want[rows].sum()))
    b = np.repeat(cut[rows] - _offsets(want[rows])[:-1], want[rows]) + np.arange(int(want[rows].sum()))
    wrong = np.flatnonzero(got[a] != buf[b])
    same[rows[np.searchsorted(_offsets(want[rows]), wrong, "right") - 1]] = False
    return same


def sample(docs: DataFrame, model: str, k: int = 2, alpha: float = 1.0, key: str = "doc_id") -> DataFrame:
    """doc_id, sample (1..k), ids, n_ids, log_prob, perturbed, log_inclusion, and whether decoding the ids gives the text."""
    @tk.tidy
    def step(batches):
        vocab = Vocabulary(model, alpha)
        for batch in batches:
            buf, offs = tk.utf8(batch.column(1))
            keys = row_keys(batch.column(0).to_pylist())
            for lo, hi in tk.row_chunks(offs, 1 << 19):
                part, cut = buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                for number, f in enumerate(sample_texts(vocab, part, cut, keys[lo:hi], k), 1):
                    use = np.flatnonzero(~np.isneginf(f["perturbed"]))
                    ids, at = f["ids"], f["offs"]
                    exact = same_texts(vocab, ids, at, part, cut)[use]
                    n = (at[1:] - at[:-1])[use]
                    keep = np.repeat(~np.isneginf(f["perturbed"]), np.diff(at))
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(lo, hi - lo).take(pa.array(use)), pa.array([number] * len(use), pa.int32()),
                        pa.ListArray.from_arrays(pa.array(_offsets(n), pa.int32()), pa.array(ids[keep], pa.int32())), pa.array(n, pa.int64()),
                        pa.array(f["log_prob"][use]), pa.array(f["perturbed"][use]), pa.array(f["log_inclusion"][use]), pa.array(exact)],
                        ["doc_id", "sample", "ids", "n_ids", "log_prob", "perturbed", "log_inclusion", "exact"])

    return docs.select(F.col(key).alias("doc_id"), "text").mapInArrow(
        step, f"doc_id {docs.schema[key].dataType.simpleString()}, sample int, ids array<int>, n_ids long, log_prob double, "
              "perturbed double, log_inclusion double, exact boolean")
