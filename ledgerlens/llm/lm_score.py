"""Language-model scores of documents from a weighted backoff automaton over word trigrams.

Tokens: words (A-Z lowered, split at ASCII white space) and one end token per document, after which
the next document starts.  States are histories: the root, one state per training word (that of the
end token is the start of a document), and one per training bigram that does not end a document.
A state has an arc for every n-gram that continues it in training, and a failure arc to the state
of its history without the oldest word:

    arc      log10 (c(hw) + m P'(w)) / (c(h) + m)      to the longest suffix of hw that is a state
    failure  log10        m          / (c(h) + m)      to the state one word shorter
    root     log10 P(w),  P(w) = (c(w) + 1/2) / (N + (V + 1) / 2)

with P' the probability of the shorter history and m one weight per order (Dirichlet smoothing: the
probabilities of a state sum to one, unseen words included).  A bucket's documents are one stream,
read once from left to right: the carried state takes the token's arc, or its failure arcs until a state
has one, and the weights add up.  After any two tokens the state no longer depends on where the reading
began, so the stream is read in lanes of ``LANE`` tokens side by side, each with a lead of two tokens
whose weights do not count.

Scale: counts are exact over all training documents.  They are gathered by ``shards``: every
bucket of documents sends its distinct words, bigrams and trigrams with its training counts to hash
shards, which add them up and answer with corpus totals; N and V are two sums over the shards.  The
bucket then holds the part of the automaton its texts can reach and traverses it.  No task or driver
holds the model.

Defined results: null or empty text is the end token alone.  A null doc_id counts as the text
``null`` for the fold.  Repeated rows each count and each get a score; there are no ties, every row has
its own score.  A very long text is a bucket of its own, read whole.  Columns besides doc_id and text are
not read, whatever their names.  Empty tables: no rows.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import shards as sh
from ledgerlens.llm import textkit as tk
from ledgerlens.session import materialize

END = tk.mix64(np.array([0x5E], tk.U64))[0]
MU = (1000.0, 5.0)  # weights of the shorter history after one word and after two: best of a grid on held-out texts
LANE = 256
ORDERS = ("words", "pairs", "triples")
ASKED = "bucket long, shard int, " + ", ".join(f"{k} binary, {k}_counts binary" for k in ORDERS)
ANSWER = "bucket long, shard int, blob binary, n_tokens long, n_types long"


def token_stream(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens with each document's end token, and document numbers."""
    _, _, rows, h = tk.word_hashes(buf, offs, tk.NOT_SPACE)
    n = len(offs) - 1
    count = np.bincount(rows, minlength=n)
    stops = np.cumsum(count) + np.arange(n)
    words = np.empty(len(h) + n, tk.U64)
    keep = np.ones(len(words), bool)
    keep[stops] = False
    words[keep], words[stops] = h, END
    return words, np.repeat(np.arange(n), count + 1)


def pair_keys(past: np.ndarray, words: np.ndarray) -> np.ndarray:
    return tk.mix64(past * tk.U64(0xBF58476D1CE4E5B9) + words)


def grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the bigram that ends at every token (an end token stands before the first), keys of the
    trigrams without an inner end token, and the places where those end."""
    past = np.empty_like(words)
    past[1:], past[:1] = words[:-1], END
    pairs = pair_keys(past, words)
    deep = np.flatnonzero(past != END)
    return pairs, pair_keys(pairs[deep - 1], words[deep]), deep


def in_training(doc_ids: list, parts: int, held: int) -> np.ndarray:
    return np.array([zlib.crc32(("null" if d is None else str(d)).encode()) % parts != held for d in doc_ids], bool)


def distinct(keys: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of their weights (0 or 1)."""
    o = np.argsort(keys)
    k = keys[o]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return k[at], np.add.reduceat(weight[o].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


def ask(docs: DataFrame, shards: int, parts: int, held: int) -> DataFrame:
    """Distinct words, bigrams and trigrams of every bucket, with training counts, dealt to shards."""
    @tk.tidy
    def step(batches):
        for bucket, got in sh.bucket_chunks(batches):
            buf, offs = sh.text_of(got)
            words, doc = token_stream(buf, offs)
            train = in_training([d for p in got for d in p.column(p.schema.get_field_index("doc_id")).to_pylist()], parts, held)[doc]
            pairs, triples, deep = grams(words)
            columns: list = []
            for keys, weight in ((words, train), (pairs, train), (triples, train[deep])):
                k, c = distinct(keys, weight)
                cut = sh.shard_cuts(k, shards)
                columns.append(pa.array([sh.pack_keys(k[cut[s]:cut[s + 1]]) for s in range(shards)], pa.binary()))
                columns.append(pa.array([sh.pack_counts(c[cut[s]:cut[s + 1]]) for s in range(shards)], pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array([bucket] * shards, pa.int64()), pa.array(range(shards), pa.int32()), *columns],
                                             ["bucket", "shard", *(n for k in ORDERS for n in (k, f"{k}_counts"))])

    return docs.select("_bucket", "doc_id", "text").mapInArrow(step, ASKED)


def total(table: pa.Table) -> pa.Table:
    """A shard: totals over all buckets, one answer for each; its first row also carries N and V."""
    buckets, owner = np.unique(table["bucket"].to_numpy(), return_inverse=True)
    sizes, answers = (0, 0), []
    for keys in ORDERS:
        k = [sh.unpack_keys(b) for b in table[keys].to_pylist()]
        c = np.concatenate([sh.unpack_counts(b) for b in table[f"{keys}_counts"].to_pylist()])
        every, where = np.unique(np.concatenate(k), return_inverse=True)
        sums = np.bincount(where, weights=c, minlength=len(every)).astype(np.int64)
        if not answers:
            sizes = int(sums.sum()), int((sums > 0).sum())
        ends = np.cumsum([len(x) for x in k])
        # a bucket read in several pieces is answered once, in the order of its distinct keys
        pieces: list[list[int]] = [[] for _ in buckets]
        for i, j in enumerate(owner.tolist()):
            pieces[j].append(i)
        asked = [[where[ends[i] - len(k[i]):ends[i]] for i in of] for of in pieces]
        answers.append([sh.pack_counts(sums[x[0] if len(x) == 1 else np.unique(np.concatenate(x))]) for x in asked])
    blobs = [b"".join(len(a).to_bytes(8, "little") + a for a in parts) for parts in zip(*answers)]
    rest = [0] * (len(blobs) - 1)
    return pa.table({"bucket": pa.array(buckets, pa.int64()), "shard": pa.array([table["shard"][0].as_py()] * len(buckets), pa.int32()),
                     "blob": pa.array(blobs, pa.binary()),
                     "n_tokens": pa.array([sizes[0], *rest], pa.int64()), "n_types": pa.array([sizes[1], *rest], pa.int64())})


def open_answers(answers: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """Totals of a bucket's distinct words, bigrams and trigrams, in the order of their keys."""
    out: list[list] = [[] for _ in ORDERS]
    for _, blob in sorted(answers):
        at = 0
        for held in out:
            n = int.from_bytes(blob[at:at + 8], "little")
            held.append(sh.unpack_counts(blob[at + 8:at + 8 + n]))
            at += 8 + n
    return [np.concatenate(x) for x in out]


class Automaton(NamedTuple):
    """The states and arcs that a bucket's texts can reach.

    States: 0 is the root, 1.. are the bucket's distinct words, ``first[2]``.. its distinct bigrams.  The
    arc by which a state of order k reads a token is the (k + 1)-gram that ends there; ``weight[k]`` and
    ``target[k]`` are in the order of the distinct (k + 1)-grams, then one entry "no arc" (NaN).
    """
    first: tuple[int, int, int]
    weight: list[np.ndarray]
    target: list[np.ndarray]
    fail_weight: np.ndarray
    fail_state: np.ndarray


def build(counts: list[np.ndarray], word_of_pair: np.ndarray, past_of_pair: np.ndarray, pair_of_triple: np.ndarray,
          past_of_triple: np.ndarray, end: int, n: int, v: int, mu: tuple[float, float]) -> Automaton:
    """Arcs and failure arcs from corpus totals; ``*_of_*`` name the last and the first shorter n-gram of each."""
    c1, c2, c3 = counts
    p1 = (c1 + 0.5) / (n + 0.5 * (v + 1))
    p2 = (c2 + mu[0] * p1[word_of_pair]) / (c1[past_of_pair] + mu[0])
    p3 = (c3 + mu[1] * p2[pair_of_triple]) / (c2[past_of_triple] + mu[1])
    words = np.where(c1 > 0, 1 + np.arange(len(c1)), 0)  # an unknown word leads to the root
    pairs = np.where(word_of_pair == end, words[end], 1 + len(c1) + np.arange(len(c2)))  # the end token to the start of a document
    weight = [np.append(np.log10(p1), np.nan), np.append(np.where(c2 > 0, np.log10(p2), np.nan), np.nan),
              np.append(np.where(c3 > 0, np.log10(p3), np.nan), np.nan)]
    target = [np.append(words, 0), np.append(pairs, 0), np.append(pairs[pair_of_triple], 0)]
    fail_weight = np.concatenate([[0.0], np.log10(mu[0] / (c1 + mu[0])), np.log10(mu[1] / (c2 + mu[1]))])
    fail_state = np.concatenate([np.zeros(1 + len(c1), np.int64), words[word_of_pair]])
    return Automaton((0, 1, 1 + len(c1)), weight, target, fail_weight, fail_state)


def walk(auto: Automaton, names: list[np.ndarray], end: int, lane: int = LANE) -> np.ndarray:
    """Log-probability of every token of a stream; ``names[k]`` numbers the (k + 1)-gram that ends at it (-1: none)."""
    n = len(names[0])
    lanes = -(-n // lane)
    # two end tokens before the stream put the first lane at the start of a document
    tape = [np.concatenate([np.full(2, fill), x, np.full(lanes * lane - n, fill)]) for x, fill in zip(names, (end, -1, -1))]
    state = np.zeros(lanes, np.int64)
    out = np.empty((lane, lanes))
    for i in range(lane + 2):
        token = [t[i:i + (lanes - 1) * lane + 1:lane] for t in tape]
        cost, goal, open_ = np.zeros(lanes), np.zeros(lanes, np.int64), np.ones(lanes, bool)
        for order in (2, 1, 0):
            here = open_ & (state >= auto.first[order])
            arc = np.where(here, token[order], -1)
            w = auto.weight[order][arc]
            none = np.isnan(w)
            cost += np.where(none, 0.0, w)
            goal = np.where(none, goal, auto.target[order][arc])
            open_ &= none
            fails = here & none
            cost += np.where(fails, auto.fail_weight[state], 0.0)
            state = np.where(fails, auto.fail_state[state], state)
        state = goal
        if i >= 2:
            out[i - 2] = cost
    return out.T.reshape(-1)[:n]


def traverse(texts: pa.Table, answers: list[tuple[int, bytes]], n: int, v: int, mu: tuple[float, float]) -> dict[str, np.ndarray]:
    """Scores of a bucket's documents from the totals of its n-grams (in shard order)."""
    buf, offs = tk.utf8(texts["text"].cast(pa.large_string()))
    words, doc = token_stream(buf, offs)
    n_docs = len(offs) - 1
    counts = open_answers(answers)
    pairs, triples, deep = grams(words)
    # answers hold counts in the order of the distinct keys, shard after shard
    numbered = [np.unique(x, return_index=True, return_inverse=True) for x in (words, pairs, triples)]
    if any(len(x[0]) != len(c) for x, c in zip(numbered, counts)):
        raise ValueError("answers do not fit the bucket")
    (known, _, word), (_, pair_at, pair), (_, triple_at, triple) = numbered
    end = int(np.searchsorted(known, END))
    before = np.concatenate([[end], word[:-1]])
    triple_at = deep[triple_at]
    auto = build(counts, word[pair_at], before[pair_at], pair[triple_at], pair[triple_at - 1], end, n, v, mu)
    third = np.full(len(words), -1)
    third[deep] = triple
    step = walk(auto, [word, pair, third], end)
    return {"n_tokens": np.bincount(doc, minlength=n_docs),
            "n_known": np.bincount(doc, weights=counts[0][word] > 0, minlength=n_docs).astype(np.int64),
            "base_score": np.bincount(doc, weights=auto.weight[0][word], minlength=n_docs),
            "score": np.bincount(doc, weights=step, minlength=n_docs)}


def score(docs: DataFrame, parts: int = 5, held: int = 1, mu: tuple[float, float] = MU) -> DataFrame:
    """Score every document of ``docs`` (doc_id, text); learn from ids with crc32 % parts != held.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, train_types, base_score, score.
    """
    spark = docs.sparkSession
    placed = sh.bucketed(docs.select("doc_id", "text"))
    asked = ask(placed, sh.n_shards(spark), parts, held)
    answers = materialize(asked.groupBy("shard").applyInArrow(total, ANSWER), "lm_counts")
    n, v = answers.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))).first()
    meet = sh.pack_texts(placed, ["doc_id"]).unionByName(answers.select("bucket", "shard", "blob"))

    def step(table: pa.Table) -> pa.Table:
        shard = table["shard"].to_pylist()
        blobs = table["blob"].to_pylist()
        texts = pa.concat_tables([sh.unpack_texts(b) for s, b in zip(shard, blobs) if s < 0])
        got = traverse(texts, [(s, b) for s, b in zip(shard, blobs) if s >= 0], n, v, mu)
        ids = texts["doc_id"].to_pylist()
        rows = len(ids)
        tk.release()
        return pa.table({"doc_id": texts["doc_id"].cast(pa.int64()), "held_out": pa.array(~in_training(ids, parts, held)),
                         "n_tokens": pa.array(got["n_tokens"].astype(np.int64)), "n_known": pa.array(got["n_known"]),
                         "train_tokens": pa.array([n] * rows, pa.int64()), "train_types": pa.array([v] * rows, pa.int64()),
                         "base_score": pa.array(got["base_score"]), "score": pa.array(got["score"])})

    return meet.groupBy("bucket").applyInArrow(step, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                                     "train_tokens long, train_types long, base_score double, score double")
