"""Conversation structure repair by a suffix-shared automaton of role/fault signatures.

A conversation is the list of its rows by turn (nulls first; ties by role, then SHA-256 of the text).  Each
row has a signature letter: its role's initial and its first fault (blank, duplicate of an earlier row, truncated).
The cheapest edits (keep, change role, delete, insert) that leave roles of the form ``(s?(ua)+)?`` depend only on the
letters from a row on and on the grammar state, so signatures are minimised from the end: a node stands for a suffix, and all
conversations that share it share the node.  Signatures are sorted by their reversal; neighbours then share their
longest common suffix, and one pass with a stack visits each node of a partition once, keeping per grammar state
the cost to go and the first edits of the best audit (ties: the ASCII-least; two different edits of a node start with
different letters, so no audits are compared).  An audit is read off the stack in one walk from the first row.

Spark's part: duplicates by one aggregate per (conversation, role, text digest); rows dealt by range of (conversation, turn, ...),
so that a conversation of any size is many tasks, each giving one piece of its signature; pieces joined per conversation
(one letter a row, no more than the audit itself); signatures dealt by range of (reversed suffix, conversation), so a
signature that a third of all conversations share is many tasks.  Only the last step needs a conversation's texts in one place,
because SHA-256 runs through them: audits and rows are sorted together and streamed, so a task holds a batch and one audit.

Defined results: a null role or text is one space (which is blank); a null conversation id is a conversation of its own; null
turns come first and do not count for gaps; a role without a character, or with an initial other than s, u or a, cannot be
kept; repeated rows are duplicates; very long texts are hashed whole and pass once; an empty table gives none;
columns besides ``conv_id``, ``turn``, ``role`` and ``text`` are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.session import materialize

KEEP, REROLE, DELETE, INSERT = "KRDI"
EDIT_COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3
START, SYSTEM, USER, ASSISTANT = range(4)  # grammar states: what was put out last
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
_NEXT = (USER, USER, ASSISTANT, USER)  # where a changed or inserted role leads
_ENDS = (True, False, False, True)
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: signature letters: role s, u, a or x (other) by fault: none, truncated (capital), duplicate and blank (any role)
_FAULTS = ("none", "truncated", "duplicate", "blank")
LETTERS = {(r, f): chr(ord("A") + 4 * i + j) for i, r in enumerate("suax") for j, f in enumerate(_FAULTS)}
MUST_GO = "z"  # duplicates and blanks of any role, for the automaton
SHARED = 48  # letters of a reversed signature that deal it to tasks


# ------------------------------------------------------------------ the automaton
_NEVER = 1 << 60


class Shape:
    """What nodes share: costs to go less their least, and best edits, per grammar state.

    ``first[s]`` is the edits from here until the next row begins (insertions, then one of K, R, D; at the end only
    insertions) and ``to[s]`` the state there.  ``before`` holds the (shape, least cost) of a row put in front, by its letter.
    """

    __slots__ = ("before", "cost", "first", "to")

    def __init__(self, own: list[tuple[int, str, int]]):
        """From each state's cheapest way (cost, edits, next state) without an insertion here."""
        best = list(own)
        # two insertions lead back, so one round from the untouched states is enough for user and assistant
        for s, t in ((USER, ASSISTANT), (ASSISTANT, USER)):
            best[s] = min(own[s], (own[t][0] + EDIT_COST[INSERT], INSERT + own[t][1], own[t][2]))
        for s in (START, SYSTEM):
            c, e, to = best[USER]
            best[s] = min(own[s], (c + EDIT_COST[INSERT], INSERT + e, to))
        self.cost, self.first, self.to = (tuple(b[i] for b in best) for i in range(3))
        self.before: dict[str, tuple[Shape, int]] = {}


def _ways(letter: str, cost: tuple) -> list[tuple[int, str, int]]:
    """The cheapest way to treat a row with this signature letter in each state, given the costs to go after it."""
    if letter == MUST_GO:
        return [(cost[s] + EDIT_COST[DELETE], DELETE, s) for s in range(4)]
    role, extra, out = letter.lower(), TRUNCATED_COST if letter.isupper() else 0, []
    for s in range(4):
        ways = [(cost[s] + EDIT_COST[DELETE], DELETE, s), (cost[_NEXT[s]] + EDIT_COST[REROLE] + extra, REROLE, _NEXT[s])]
        if (t := _KEPT.get(role, {}).get(s)) is not None:
            ways.append((cost[t] + extra, KEEP, t))
        out.append(min(ways))
    return out


class Automaton:
    """Nodes of the suffixes of the last signature; the next one reuses those of their common suffix.

    A node is a shape and its least cost; shapes are made once per pattern of costs and letter (costs of two states differ by
    a few edits at most, so there are few), and nodes once per suffix: ``made`` counts them.
    """

    def __init__(self):
        self.shapes: dict[tuple, Shape] = {}
        end, _ = self._shape([(0, "", s) if _ENDS[s] else (_NEVER, "", s) for s in range(4)])
        self.letters, self.nodes, self.least, self.made = "", [end], [0], 0

    def _shape(self, own: list) -> tuple[Shape, int]:
        new = Shape(own)
        least = min(new.cost)
        new.cost = tuple(c - least for c in new.cost)
        return self.shapes.setdefault((new.cost, new.first, new.to), new), least

    def solve(self, backwards: str) -> tuple[int, str]:
        """Cost and audit of a signature given from its end."""
        lo, hi = 0, min(len(backwards), len(self.letters)) + 1  # longest common prefix by halving
        while hi - lo > 1:
            mid = (lo + hi) // 2
            lo, hi = (mid, hi) if backwards[:mid] == self.letters[:mid] else (lo, mid)
        del self.nodes[lo + 1:], self.least[lo + 1:]
        for letter in backwards[lo:]:
            rest = self.nodes[-1]
            if letter not in rest.before:
                rest.before[letter] = self._shape(_ways(letter, rest.cost))
            shape, more = rest.before[letter]
            self.nodes.append(shape)
            self.least.append(self.least[-1] + more)
        self.made += len(backwards) - lo
        self.letters = backwards
        out, s = [], START
        for node in reversed(self.nodes):
            out.append(node.first[s])
            s = node.to[s]
        return self.least[-1] + self.nodes[-1].cost[START], "".join(out)


# ------------------------------------------------------------------ rows
def initial(role: Column) -> Column:
    one = F.substring(role, 1, 1)
    return F.when(one.isin("s", "u", "a"), one).otherwise("x")


def fault_rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, sha (of the text), initial, and fault of every row by itself (duplicates not seen)."""
    shown = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    return rows.select("conv_id", "turn", "role", F.sha2("text", 256).alias("sha"), initial(F.col("role")).alias("initial"),
                       F.when(shown == "", "blank").when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated").otherwise("none").alias("fault"))


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature (see ``LETTERS``) and gaps of every conversation with rows."""
    # rows alike in everything are one row with a number; their order among themselves cannot matter
    alike = fault_rows(rows).groupBy("conv_id", "turn", "role", "sha").agg(F.first("initial").alias("initial"), F.first("fault").alias("fault"), F.count(F.lit(1)).alias("n"))
    alike = materialize(alike, "repair_rows")
    # nulls come first in structs, as they do in conversations
    firsts = alike.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("sha").alias("_s")).agg(F.min(F.struct("turn")).alias("least"))
    later = ~F.col("turn").eqNullSafe(F.col("least.turn"))
    seen = (alike.join(firsts, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("sha") == F.col("_s")))
                 .select("conv_id", "turn", "role", "sha", "initial", "n", F.when((F.col("fault") != "blank") & later, "duplicate").otherwise(F.col("fault")).alias("fault")))
    seen = materialize(seen, "repair_seen")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "sha")]
    conv_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))

    @tk.tidy
    def letters(batches):
        conv = first = None
        part, size = [], 0
        for batch in batches:
            types = pa.struct([batch.schema.field(i) for i in (1, 2, 3)])

            def piece():
                return pa.RecordBatch.from_arrays([pa.array([conv], batch.column(0).type), pa.array([first], types), pa.array(["".join(part)])], ["conv_id", "first", "piece"])  # noqa: B023

            for c, turn, role, sha, ini, n, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if part and (c != conv or size >= 1 << 20):
                    yield piece()
                    part, size = [], 0
                if not part:
                    conv, first = c, {"turn": turn, "role": role, "sha": sha}
                part.append(LETTERS[ini, fault] + LETTERS[ini, "blank" if fault == "blank" else "duplicate"] * (n - 1))
                size += n
        if part:
            yield piece()

    pieces = (seen.repartitionByRange(*order).sortWithinPartitions(*order)
                  .mapInArrow(letters, f"conv_id {conv_type}, first struct<turn:{turn_type},role:string,sha:string>, piece string"))
    # a conversation's pieces hold one letter a row; one of many partitions has many pieces, in the order of their first rows
    whole = pieces.groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("first", "piece")))["piece"], "").alias("signature"))
    turns = alike.groupBy("conv_id", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv_id").alias("_c")).agg(
        F.expr("try_cast(cast(max(turn) as decimal(38,0)) - cast(min(turn) as decimal(38,0)) + 1 - count(turn) as bigint)").alias("gaps"))
    return (whole.join(turns, F.col("conv_id").eqNullSafe(F.col("_c")))
                 .select("conv_id", "signature", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps")))


_PLAIN = {letter: MUST_GO if f in ("duplicate", "blank") else (r.upper() if f == "truncated" else r) for (r, f), letter in LETTERS.items()}


def plan(signed: DataFrame) -> DataFrame:
    """``signed`` (conv_id, signature, gaps) with fault counts, ``cost`` and ``audit`` of the cheapest edits."""
    count = lambda fault: F.expr("length(signature) - length(translate(signature, '%s', ''))" % "".join(v for (_, f), v in LETTERS.items() if f == fault)).cast("long").alias(fault)
    plain = F.translate("signature", "".join(_PLAIN), "".join(_PLAIN.values()))
    df = signed.select("conv_id", "gaps", count("blank"), count("duplicate"), count("truncated"),
                       F.translate("signature", "".join(LETTERS.values()), "".join(r for r, _ in LETTERS)).alias("_roles"), F.reverse(plain).alias("_back"))
    legal = F.regexp_count("_roles", F.lit("s(?=u)|u(?=a)|a(?=u)"))
    df = df.withColumn("illegal", F.greatest(F.length("_roles") - 1 - legal, F.lit(0)).cast("long")).drop("_roles")
    dealt = df.repartitionByRange(F.substring("_back", 1, SHARED), "conv_id").sortWithinPartitions("_back")

    @tk.tidy
    def solve(batches):
        automaton, last, answer = Automaton(), None, None
        for batch in batches:
            costs, audits = [], []
            for back in batch.column(batch.schema.get_field_index("_back")).to_pylist():
                if back != last:
                    last, answer = back, automaton.solve(back)
                costs.append(answer[0])
                audits.append(answer[1])
            names = [n for n in batch.schema.names if n != "_back"]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + [pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
                                             [*names, "cost", "audit"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "_back")
    return dealt.mapInArrow(solve, f"{fields}, cost long, audit string")


# ------------------------------------------------------------------ repaired rows
def _walk(audit: str, state: int, at: int, role: str, text: str):
    """Repaired rows that the edits put out up to and with the next row's; then the state and place in the audit."""
    out = []
    while audit[at] == INSERT:
        state = _NEXT[state]
        out.append((INSERT, ROLE_OF[state], ""))
        at += 1
    edit = audit[at]
    if edit == KEEP:
        state = _KEPT[role[:1]][state]
        out.append((KEEP, role, text))
    elif edit == REROLE:
        state = _NEXT[state]
        out.append((REROLE, ROLE_OF[state], text))
    return out, state, at + 1


def _streamed(rows: DataFrame, planned: DataFrame, fn, schema: str) -> DataFrame:
    """``fn`` over batches of a conversation's audit (``kind`` 0) followed by its rows in order (``kind`` 1)."""
    turn, conv = rows.schema["turn"].dataType, rows.schema["conv_id"].dataType
    null = F.lit(None)
    both = (planned.select("conv_id", F.lit(0).alias("kind"), null.cast(turn).alias("turn"), null.cast("string").alias("role"), null.cast("string").alias("sha"), F.col("audit").alias("text"))
                   .unionByName(rows.select(F.col("conv_id").cast(conv), F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("sha"), "text")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "role", "sha")]
    return both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "kind", "role", "text").mapInArrow(fn, schema)


def _conversations(batches):
    """(new, conv_id, repaired rows) per sorted row; ``new`` marks a conversation's first item, and None ends one."""
    conv = audit = None
    state = at = 0
    open_ = False

    def tail():
        nonlocal state, at
        out = []
        while at < len(audit):  # insertions after the last row
            state = _NEXT[state]
            out.append((INSERT, ROLE_OF[state], ""))
            at += 1
        return out

    for batch in batches:
        for c, kind, role, text in zip(*(col.to_pylist() for col in batch.columns)):
            if kind == 0:
                if open_:
                    yield conv, tail(), True
                conv, audit, state, at, open_ = c, text, START, 0, True
            else:
                out, state, at = _walk(audit, state, at, role, text)
                yield conv, out, False
        yield None  # a batch ends
    if open_:
        yield conv, tail(), True


def repaired(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit, role, text."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()

    @tk.tidy
    def put(batches):
        held, place, kind = [], 0, None

        def batch_of():
            cols = list(zip(*held))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (kind, pa.int64(), pa.string(), pa.string(), pa.string()))],
                                              ["conv_id", "place", "edit", "role", "text"])

        def watched():
            nonlocal kind
            for b in batches:
                kind = b.column(0).type
                yield b

        for item in _conversations(watched()):
            if item is None:
                if held:
                    yield batch_of()
                    held = []
                continue
            conv, out, last = item
            for edit, role, text in out:
                held.append((conv, place, edit, role, text))
                place += 1
            if last:
                place = 0
        if held:
            yield batch_of()

    return _streamed(rows, planned, put, f"conv_id {conv_type}, place long, edit string, role string, text string")


def repaired_digests(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of its repaired ``role:text`` lines, joined by line ends."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()

    @tk.tidy
    def put(batches):
        ids, sums, kind = [], [], None
        hashed, some = hashlib.sha256(), False

        def watched():
            nonlocal kind
            for b in batches:
                kind = b.column(0).type
                yield b

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(sums, pa.string())], ["conv_id", "repaired_sha256"])

        for item in _conversations(watched()):
            if item is None:
                if ids:
                    yield batch_of()
                    ids, sums = [], []
                continue
            conv, out, last = item
            for _, role, text in out:
                hashed.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                some = True
            if last:
                ids.append(conv)
                sums.append(hashed.hexdigest())
                hashed, some = hashlib.sha256(), False
        if ids:
            yield batch_of()

    return _streamed(rows, planned, put, f"conv_id {conv_type}, repaired_sha256 string")


def filled(conversations: DataFrame) -> DataFrame:
    """The four columns of ``conversations``, null roles and texts as one space."""
    return conversations.select("conv_id", "turn", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")))


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The plan per conversation (gaps, faults, cost, audit) and the repaired rows."""
    rows = filled(conversations)
    planned = materialize(plan(signatures(rows)), "repair_plan")
    return planned, repaired(rows, planned)


def report(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``ids``: gaps, fault counts, illegal, cost, audit, repaired_sha256; zeros for those without rows."""
    planned = materialize(plan(signatures(rows)), "repair_plan")
    sums = repaired_digests(rows, planned).withColumnRenamed("conv_id", "_c")
    found = planned.join(sums, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c").withColumnRenamed("conv_id", "_c")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (ids.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
               .select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, chosen by a hash of (conversation, turn): dropped, emptied, cut, repeated, or another's role."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("_k")).where("_k <> 0")
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (rows.withColumn("_copy", F.explode(F.when(F.col("_k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
                .select("conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text")))
