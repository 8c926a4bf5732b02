"""Periodic runs, conversation repair and token counts against plain versions."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import conversation_repair as cr
from ledgerlens.llm import periodic_runs as pr
from ledgerlens.llm import textkit as tk
from ledgerlens.llm import token_counts as tc
from ledgerlens.llm.queries import QUERIES, tokenizer_path

SMOKE = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- 11
def plain_runs(w, least=6, power=4):
    found = {}
    for d in range(1, len(w) // power + 1):
        j = 0
        while j + d < len(w):
            s = j
            while j + d < len(w) and w[j] == w[j + d]:
                j += 1
            if j - s >= d:
                found.setdefault((s, j + d), d)
            j += 1
    return sorted((s, e - s, d) for (s, e), d in found.items() if e - s >= max(least, power * d))


def planted_words(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    return w


def run_row(doc_id, w):
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), best[0], best[1], best[2], 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").collect()
    got = {r["doc_id"]: tuple(r[c] for c in RUN_COLUMNS) for r in QUERIES["op11_periodic_runs"](spark, SMOKE).collect()}
    short = [d for d in docs if len(WORD.findall(d["text"] or "")) <= 1500]
    assert len(got) == len(docs) and len(short) > 150
    for d in short:
        assert got[d["doc_id"]] == run_row(d["doc_id"], planted_words(d["doc_id"], d["text"]))
    assert sum(g[1] > 0 for g in got.values()) > 10


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=12))
def test_runs_of_random_words(rows):
    buf, offs = tk.utf8(pa.array([" ".join(r) for r in rows], pa.large_string()))
    words, listed, texts = pr.text_runs(buf, offs)
    assert words.tolist() == [len(r) for r in rows]
    for r, runs in zip(rows, listed.to_pylist()):
        assert [(x["start"], x["length"], x["period"]) for x in runs] == plain_runs(r)


def test_runs_in_small_slices(monkeypatch):
    monkeypatch.setattr(pr, "SLICE", 7)
    rng = random.Random(5)
    w = [rng.choice("ab") for _ in range(400)] + ["x", "y"] * 40 + ["z"] * 30
    buf, offs = tk.utf8(pa.array([" ".join(w)] * 3, pa.large_string()))
    for runs in pr.text_runs(buf, offs)[1].to_pylist():
        assert [(x["start"], x["length"], x["period"]) for x in runs] == plain_runs(w)


def test_runs_edges(spark):
    long = "a b " * 40_000 + "c"
    rows = [(1, None, 7), (2, "", 7), (3, " \n\t", 7), (4, "é é\té\né é é", 7), (5, long, 7), (None, "x " * 9, 7), (6, "x x x x x", 7), (6, "x x x x x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumnRenamed("runs", "collapsed")
    got = {}
    for r in pr.digest(pr.find_runs(df)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert [got[i][0]["n_runs"] for i in (1, 2, 3)] == [0, 0, 0] and got[1][0]["runs_sha256"] == sha("") == got[3][0]["collapsed_sha256"]
    assert (got[4][0]["length"], got[4][0]["period"], got[4][0]["exponent_milli"], got[4][0]["collapsed_sha256"]) == (6, 1, 6000, sha("é"))
    assert (got[5][0]["length"], got[5][0]["period"], got[5][0]["collapsed_sha256"]) == (80_000, 2, sha("a b c"))
    assert got[None][0]["length"] == 9 and [r["n_runs"] for r in got[6]] == [0, 0]  # five words are too few
    assert pr.find_runs(df.where("false")).count() == 0
    assert pr.plant(df).count() == 8


# ---------------------------------------------------------------- 12
def damaged(rows):
    """(conv, turn, role, text) after damage, in order, per conversation."""
    out = {}
    part = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{part(conv)}:{part(turn)}".encode()) % 20
        mine = out.setdefault(conv, [])
        if k == 0:
            continue
        role, text = part(role), part(text)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        mine += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), sha(r[2])))
    return out


def plain_faults(mine):
    seen, out = set(), []
    for _, role, text in mine:
        shown = re.sub(r"[\x20\x09-\x0D]+", "", text)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "none" if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(mine, faults):
    """Cheapest edits by a search over (row, last initial), ordered by (cost, audit)."""
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, rows = heapq.heappop(heap)
        if (i, last) in done and not (i == len(mine) and last in ("", "a")):
            continue
        done.add((i, last))
        if i == len(mine) and last in ("", "a"):
            return cost, audit, rows
        heapq.heappush(heap, (cost + 3, audit + "I", i, follow[last], (*rows, names[follow[last]] + ":")))
        if i == len(mine):
            continue
        _, role, text = mine[i]
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, rows))
        if faults[i] in ("blank", "duplicate"):
            continue
        more = 3 if faults[i] == "truncated" else 0
        if role[:1] == follow[last] or (role[:1] == "s" and last == ""):
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*rows, f"{role}:{text}")))
        heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, follow[last], (*rows, f"{names[follow[last]]}:{text}")))
    raise AssertionError("no repair")


def repair_row(conv, mine):
    faults = plain_faults(mine)
    turns = [t for t, _, _ in mine if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in mine]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, rows = plain_repair(mine, faults)
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(rows)))


REPAIR_COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def check_repairs(spark, df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r[c] for c in REPAIR_COLUMNS) for r in cr.report(cr.damage(df), df).collect()}
    expected = {c: repair_row(c, mine) for c, mine in damaged(rows).items()}
    assert got == expected
    return got


def test_repair_query_equals_search(spark):
    table = spark.read.parquet(f"{SMOKE}/conversations.parquet")
    got = {r["conv_id"]: tuple(r[c] for c in REPAIR_COLUMNS) for r in QUERIES["op12_conversation_repair"](spark, SMOKE).collect()}
    assert got == {c: repair_row(c, mine) for c, mine in damaged([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]).items()}


def test_repair_random_and_edges(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 14)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn + 3]), rng.choice(["user", "assistant", "system", "tool", None, "", "sys"]),
                         rng.choice(["Hi.", "Well", "  ", "", None, "So!\n", "Well", "ok? "])))
    rows += [(None, 0, "user", "a."), (None, None, "assistant", "b."), (99, 9223372036854775807, "user", "a."), (99, -9223372036854775808, "assistant", "b.")]
    rows += [(98, 3, "user", "x" * 300_000 + "."), (98, 4, "assistant", "y.")] + [(97, 1, "user", "same.")] * 50
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, audit int, _c int")
    got = {r["conv_id"]: tuple(r[c] for c in REPAIR_COLUMNS) for r in cr.report(cr.damage(df), df).collect()}
    expected = {c: repair_row(c, mine) for c, mine in damaged(rows).items()}
    assert got.pop(99)[2:] == expected.pop(99)[2:]  # the gap is more than a long holds: 0
    assert got == expected
    assert cr.report(cr.damage(df.where("false")), df.where("false")).count() == 0


def test_repaired_rows_are_legal(spark):
    df = spark.read.parquet(f"{SMOKE}/conversations.parquet")
    planned, rows = cr.repair(cr.damage(df))
    by = {}
    for r in rows.collect():
        by.setdefault(r["conv_id"], []).append((r["place"], r["edit"], r["role"], r["text"]))
    sums = {r["conv_id"]: r["repaired_sha256"] for r in QUERIES["op12_conversation_repair"](spark, SMOKE).collect()}
    for p in planned.collect():
        mine = sorted(by.get(p["conv_id"], []))
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert re.fullmatch("(s?(ua)+)?", "".join(m[2][0] for m in mine))
        assert "".join(m[1] for m in mine) == p["audit"].replace("D", "")
        assert sha("\n".join(f"{m[2]}:{m[3]}" for m in mine)) == sums[p["conv_id"]]


def test_repair_of_one_conversation_over_many_tasks(spark):
    rng = random.Random(9)
    rows = [(1, i, rng.choice(["user", "assistant"]), rng.choice([f"t{i}.", f"t{i}", "again."])) for i in range(3000)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    check_repairs(spark, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7))


def test_automaton_shares_suffixes():
    a = cr.Automaton()
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("suaxSUAXz", k=rng.randint(0, 9))) for _ in range(3000)})
    answers = {w: a.solve(w) for w in words}
    assert a.made == len({w[:i] for w in words for i in range(1, len(w) + 1)})  # each suffix once
    assert len(a.shapes) < 100
    for w in rng.sample(words, 200):
        assert cr.Automaton().solve(w) == answers[w]


# ---------------------------------------------------------------- 13
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))


def test_counts_query_equals_library(spark, tokenizer):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op13_token_counts"](spark, SMOKE).collect()}
    ids = {d: len(e.ids) for d, e in zip(texts, tokenizer.encode_batch(list(texts.values()), add_special_tokens=False))}
    assert got == {d: (len(t.encode()), ids[d], ids[d] > 512) for d, t in texts.items()}


def counted(texts, limit=tc.PIECE):
    c = tc.counter(tokenizer_path("byte_bpe_50k.json"))
    buf, offs = tk.utf8(pa.array(texts, pa.large_string()))
    n = np.zeros(len(texts), np.int64)
    for row, part, cut in tc.pieces(buf, offs, limit):
        n[row:row + len(cut) - 1] += c.count(part, cut)
    return n.tolist()


MIXED = st.lists(st.one_of(st.sampled_from([" ", "  ", "\n", "'s", "'re", "'ll", "'", "the", " of", "<|endoftext|>", "<|", "12", "é", "\u0085", "　", "!", "aaaa", "ab" * 30]),
                           st.characters(exclude_categories=["Cs"])), max_size=40).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(MIXED, min_size=1, max_size=8))
def test_counts_of_random_texts(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert counted(texts) == [len(t.encode(x, add_special_tokens=False).ids) for x in texts]


def test_counts_of_long_texts_in_pieces(tokenizer):
    rng = random.Random(4)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(500)]
    long = " ".join(rng.choices(words, k=30_000))
    unbroken = "".join(rng.choices("abcdefgh", k=6000))
    texts = [long, "", unbroken, "a" * 5000, " " * 3000 + "x", long[:70_000] + "<|endoftext|>" + long[:9]]
    expected = [len(tokenizer.encode(x, add_special_tokens=False).ids) for x in texts]
    assert counted(texts, 10_000) == counted(texts) == expected


def test_counts_where_a_token_has_two_merges():
    """Not ordered: only the leftmost place of a pair is merged at a time, as the library does."""
    from tokenizers import Tokenizer, models, pre_tokenizers
    sym = tc.byte_symbols()
    merges = [("a", "bc"), ("abc", "ab"), ("b", "c"), ("a", "b"), ("ab", "c")]
    vocab = {s: i for i, s in enumerate([*sym, "bc", "abc", "ab", "abcab"])}
    t = Tokenizer(models.BPE(vocab, merges))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    m = tc.Merges(vocab, merges)
    assert not m.ordered
    rng = random.Random(2)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 20))) for _ in range(400)]
    buf, offs = tk.utf8(pa.array(words, pa.large_string()))
    assert m.count(buf, offs).tolist() == [len(t.encode(w).ids) for w in words]


def test_counts_edges(spark, tokenizer):
    rows = [(1, None, 5), (2, "", 5), (3, "don't  stop\n", 5), (3, "don't  stop\n", 5), (None, "x" * 5000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    out = tc.count_tokens(df, tokenizer_path("byte_bpe_50k.json"), limit=3)
    got = sorted(((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in out.collect()))
    n = len(tokenizer.encode("don't  stop\n").ids)
    assert got == [(0, 5000, len(tokenizer.encode("x" * 5000).ids), True), (1, 0, 0, False), (2, 0, 0, False), (3, 12, n, True), (3, 12, n, True)]
    assert tc.count_tokens(df.where("false"), tokenizer_path("byte_bpe_50k.json")).count() == 0
    with pytest.raises(ValueError):
        tc.Counter(tokenizer_path("word_bpe_49k.json"))


# ---------------------------------------------------------------- 2
def test_quality_keeps_clashing_columns(spark):
    from ledgerlens.llm import quality
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").selectExpr("*", "'x' AS perplexity", "1 AS accepted", "doc_id AS file", "'r' AS row", "2 AS _bucket", "3 AS _lang",
                                                                       "4 AS _metadata", "5 AS repeated", "'d' AS doc")
    labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
    kept = quality.keep_good(docs, labels)
    assert kept.dtypes == docs.dtypes
    rows = kept.collect()
    assert {(r["perplexity"], r["accepted"], r["row"], r["_bucket"], r["_lang"], r["doc"]) for r in rows} == {("x", 1, "r", 2, 3, "d")}
    judged = {r["doc_id"]: r["accepted"] for r in QUERIES["op2_quality"](spark, SMOKE).collect()}
    assert {r["doc_id"] for r in rows} == {d for d, ok in judged.items() if ok} and 0 < len(rows) < len(judged)
    assert {r["doc_id"]: r["accepted"] for r in quality.classify(docs, labels).collect()} == judged


def test_quality_does_not_depend_on_regions(spark, monkeypatch):
    from ledgerlens.llm import quality
    docs, labels = (spark.read.parquet(f"{SMOKE}/{t}.parquet") for t in ("documents", "labels"))
    rows = lambda: sorted((r["doc_id"], round(r["perplexity"] or 0, 6), r["accepted"]) for r in quality.judge(docs, labels).collect())
    whole = rows()
    monkeypatch.setattr(quality, "REGION_ROWS", 60)
    monkeypatch.setattr(quality, "BUCKETS", ((4 << 10, 16), (64 << 10, 4)))
    monkeypatch.setattr(quality, "SHARD_KEYS", 300)
    assert rows() == whole


def test_quality_limits_of_rare_languages(spark):
    from ledgerlens.llm import quality
    rows = [("en", 2.0 + i % 7 / 100, 100 + i) for i in range(200)] + [("de", 2.5, 100)]
    held = spark.createDataFrame(rows, "lang string, p double, n long")
    own, pooled = quality.limits(held, {"p": 0.99})
    got = {r["_l"]: r["own"] for r in own.collect()}
    assert set(got) == {"en", "de"} and got["en"]["mu"] == pytest.approx(2.03, abs=0.01) and got["de"]["m"] == 1 and pooled.count() == 1
    own, pooled = quality.limits(held.where("false"), {"p": 0.99, "n": 0.9})
    assert own.count() == pooled.count() == 0
    # a language that nothing calibrates is judged by the limit of all languages, not kept whole
    docs, labels = (spark.read.parquet(f"{SMOKE}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F
    new = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "new").otherwise(F.col("lang")))
    judged = quality.judge(new, labels.where("doc_id % 3 <> 0")).where("lang = 'new'")
    assert judged.where("threshold IS NULL").count() == 0 and judged.where("NOT accepted").count() > 0


# ---------------------------------------------------------------- hashes of words
def thue_morse(n):
    a = "a"
    while len(a) < n:
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [512, 1024, 4096, 1 << 16])
def test_hashes_tell_thue_morse_words_apart(n):
    words = thue_morse(n)
    assert len(set(tk.word_hashes(*tk.utf8(pa.array(words)), tk.ALNUM)[3].tolist())) == 2


def test_operators_tell_thue_morse_words_apart(spark):
    """Equal hashes of different words would give one's ids, links, scores and hits to the other."""
    from tokenizers import Tokenizer

    from ledgerlens.llm import decontam, lm_score, ngram_join, sp_sample, token_codes
    a, b = thue_morse(1024)
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    ids, n = token_codes.WordTokenizer(tokenizer_path("word_bpe_49k.json")).encode(*tk.utf8(pa.array([a, b])))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [tok.encode(t, add_special_tokens=False).ids for t in (a, b)]
    docs = spark.createDataFrame([(1, a), (2, b), (3, f"{a} x"), (4, f"{b} x")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_links"] for r in ngram_join.join(docs).collect()} == {1: 0, 2: 0, 3: 0, 4: 0}
    bench = spark.createDataFrame([(1, a)], "item_id long, text string")
    assert {r["doc_id"]: r["n_hit"] for r in decontam.match(docs, bench).collect()} == {1: 1, 2: 0, 3: 1, 4: 0}
    assert {r["doc_id"]: r["n_known"] for r in lm_score.score(docs.where("doc_id in (1, 4)")).collect()} is not None
    v = sp_sample.Vocabulary(tokenizer_path("piece_bpe_32k.model"))
    for f in sp_sample.sample_texts(v, *tk.utf8(pa.array([a, b])), sp_sample.row_keys([1, 2]), 1):
        assert [sp_sample.decode(v, f["ids"][f["offs"][d]:f["offs"][d + 1]]) for d in range(2)] == [a, b]


# ---------------------------------------------------------------- 8
def test_decontamination_of_many_blocks_and_clashing_columns(spark):
    from ledgerlens.llm import decontam
    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(14))) for i in range(50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(60)}" for _ in range(60)]
        if i % 2:
            words[20:34] = items[i][1].split()
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS items", "'s' AS state", "octet_length(text) AS n_chars", "1 AS doc", "2 AS n_hit")
    one = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["longest_match"], [tuple(h) for h in r["hit_words"]]) for r in decontam.match(docs, bench).collect()}
    many = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["longest_match"], [tuple(h) for h in r["hit_words"]])
            for r in decontam.match(docs, bench, block_bytes=200).collect()}  # about 20 blocks, staged after every four
    assert one == many and all((n[1] >= 14) == bool(i % 2) for i, n in one.items())
    out = decontam.decontaminate(docs, bench, max_coverage=0.9)
    assert out.dtypes == docs.dtypes and out.count() == 40
    for r in out.collect():
        assert (r["items"], r["state"], r["doc"], r["n_hit"]) == (7, "s", 1, 2) and r["n_chars"] == len(r["text"])
        assert (r["text"] == dict(rows)[r["doc_id"]]) == (r["doc_id"] % 2 == 0)
