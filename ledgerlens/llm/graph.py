"""Groups compared in blocks, and connected components, as Spark jobs.

``in_units`` deals the rows of each group into blocks and sends every pair of blocks to one unit of
work, so a group of any size is compared whole without a row per pair and without one task
holding the group: a group of n rows becomes n * ceil(n / block) rows.

``stars`` finds what links connect, not the links: rows of a large group that link with the same few
pivots are connected and need no pairs, so only those go to ``in_units`` that the pivots leave open.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import textkit as tk
from ledgerlens.llm.shards import runs
from ledgerlens.session import materialize

PIVOTS = 4

def deal(df: DataFrame, group: str, member: str, block: int) -> DataFrame:
    """``df`` with a row per unit of every row: its block ``_b``, the unit's blocks ``_lo`` and ``_hi``, and ``_unit``.

    Rows that a column ``_closed`` marks go in blocks of their own, after those of the open rows, and meet only the open ones.
    Columns ``_n`` and ``_c`` are the group's open and closed rows; without them the groups are counted and joined here.
    """
    closed = F.col("_closed") if "_closed" in df.columns else F.lit(False)
    if "_n" not in df.columns:
        df = df.join(df.groupBy(group).agg(F.count_if(~closed).alias("_n"), F.count_if(closed).alias("_c")).where("_n > 0"), group)
    opened, shut = F.ceil(F.col("_n") / block), F.ceil(F.col("_c") / block)
    place = F.when(closed, opened + F.pmod(F.xxhash64(member), F.greatest(shut, F.lit(1)))).otherwise(F.pmod(F.xxhash64(member), opened))
    return (df.withColumn("_b", place.cast("int"))
              .withColumn("_o", F.explode(F.sequence(F.lit(0), (F.when(closed, opened).otherwise(opened + shut) - 1).cast("int"))))
              .withColumn("_lo", F.least("_b", "_o")).withColumn("_hi", F.greatest("_b", "_o"))
              .withColumn("_unit", F.xxhash64(group, "_lo", "_hi")).drop("_o", "_n", "_c", "_closed"))


def in_units(df: DataFrame, group: str, member: str, block: int, fn, schema: str) -> DataFrame:
    """Apply ``fn(table, lo, hi)`` to every unit of ``deal``; ``table`` has the unit's rows and their block ``_b``.

    ``fn`` gets whole units: for ``lo == hi`` one block (compare all its rows), else two blocks
    (compare across).  It returns a record batch of ``schema`` or None.  ``df`` is read twice if it has no counts.
    """
    @tk.tidy
    def step(batches):
        held: list = []

        def whole(last: bool):
            nonlocal held
            t = pa.Table.from_batches(held).combine_chunks()
            unit = t["_unit"].to_numpy()
            spans = runs(unit)
            keep = None if last else spans.pop()
            lo, hi = t["_lo"].to_numpy(), t["_hi"].to_numpy()
            for a, b in spans:
                got = fn(t.slice(a, b - a), int(lo[a]), int(hi[a]))
                if got is not None:
                    yield got
            held = [] if keep is None else t.slice(keep[0]).to_batches()

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                unit = batch.column(batch.schema.get_field_index("_unit"))
                if unit[len(unit) - 1] != held[0].column(batch.schema.get_field_index("_unit"))[0]:  # a unit has ended
                    yield from whole(False)
        if held:
            yield from whole(True)

    return deal(df, group, member, block).repartition("_unit").sortWithinPartitions("_unit").mapInArrow(_merged(step), schema)


def stars(df: DataFrame, group: str, member: str, value: str, block: int, near, limit: float, fn) -> DataFrame:
    """Edges (a, b) of members that connect, in every group, all that links connect there.

    Groups of up to ``block`` rows are compared whole by ``fn`` (``in_units``).  Larger ones go through rounds: every
    row is compared with ``PIVOTS`` open rows, and rows that link with one pivot, or with pivots that a row
    links, are one cluster.  The largest cluster is closed: its rows need no pairs among themselves.  A
    row that links with no row of another cluster leaves: at some pivot its distance is further than ``limit`` from those
    of that cluster's rows.  A round follows while more than a block is open and a quarter less than before;
    then ``fn`` compares the open rows with each other and with the closed ones, so a group of n rows costs
    rows in proportion to n, but for groups whose rows hardly link.

    ``df`` may have the columns ``_closed``, ``_n`` and ``_c`` of ``deal``; its closed rows are of one component that is known.

    ``near(values, pivots)`` returns links and distances (rows x pivots) of two Arrow arrays of ``value``; the
    distance is a metric and no link is longer than ``limit``.
    """
    out, direct, edges, pivots, rows, schema = [], [], [], None, df, "a long, b long"
    if "_n" in df.columns:
        out = [in_units(df.where(F.col("_n") <= block).select(group, member, value, "_closed", "_n", "_c"), group, member, block, fn, schema)]
        rows = df.where(F.col("_n") > block)
    rows = rows.select(group, member, value, F.col("_closed") if "_closed" in df.columns else F.lit(False).alias("_closed"))
    while True:
        pivots = _pivots(rows, group, member, value, block, PIVOTS * len(edges), pivots)
        if pivots.isEmpty():
            break
        direct.append(rows.join(pivots.select(group), group, "left_anti"))
        placed, links = _pivot_round(rows, pivots, group, member, value, near)
        edges.append(links)
        rows = _open_rows(placed, group, member, value, limit)
    if edges or not out:
        direct = functools.reduce(DataFrame.unionByName, [*direct, rows])
        out.append(in_units(direct, group, member, block, fn, schema))
    return functools.reduce(DataFrame.unionByName, [*out, *edges])


def _pivots(rows: DataFrame, group: str, member: str, value: str, block: int, salt: int, last: DataFrame | None) -> DataFrame:
    """Pivots (members and values) of the groups that go through a round, and the number of their open rows."""
    drawn = (F.when(~F.col("_closed"), F.xxhash64(member, F.lit(salt + k))) for k in range(PIVOTS))
    chosen = (rows.groupBy(group).agg(F.count_if(~F.col("_closed")).alias("_n"), *(F.min_by(member, h).alias(f"_{k}") for k, h in enumerate(drawn)))
                  .where(F.col("_n") > block))
    if last is not None:
        chosen = chosen.join(last.select(group, F.col("_n").alias("_was")), group).where("_n <= 0.75 * _was")
    chosen = chosen.select(group, "_n", F.posexplode(F.array(*(f"_{k}" for k in range(PIVOTS)))).alias("_k", member))
    return materialize(rows.join(chosen, [group, member]).groupBy(group, "_k").agg(F.first("_n").alias("_n"), F.first(member).alias("_m"), F.first(value).alias("_v"))
                           .groupBy(group).agg(F.first("_n").alias("_n"), F.sort_array(F.collect_list(F.struct("_k", "_m", "_v"))).alias("_p"))
                           .select(group, "_n", F.col("_p._m").alias("_pivots"), F.col("_p._v").alias("_values")), "pivots")


def _pivot_round(rows: DataFrame, pivots: DataFrame, group: str, member: str, value: str, near) -> tuple[DataFrame, DataFrame]:
    """The rows of groups with pivots, with those they link with (``_mask``: a bit each, and one for closed rows; ``_to``: the first),
    their distances to them and whether they are a pivot; and the edges to pivots."""
    @tk.tidy
    def step(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, members = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            order = np.argsort(ids, kind="stable")
            mask = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int32) << PIVOTS
            far, own, to = np.zeros((len(ids), PIVOTS)), np.zeros(len(ids), bool), members.copy()
            for a, b in runs(ids[order]):
                at = order[a:b]
                links, far[at] = near(batch.column(2).take(pa.array(at)), batch.column(5)[int(at[0])].values)
                mask[at] |= (links @ (1 << np.arange(PIVOTS))).astype(np.int32)
                names = batch.column(4)[int(at[0])].values.to_numpy()
                own[at] = np.isin(members[at], names)
                to[at] = np.where(links.any(axis=1), names[links.argmax(axis=1)], members[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(mask), pa.array(own),
                                              *(pa.array(far[:, k].copy()) for k in range(PIVOTS)), pa.array(to)],
                                             [group, member, value, "_mask", "_own", *(f"_d{k}" for k in range(PIVOTS)), "_to"])

    kind = rows.schema[value].dataType.simpleString()
    schema = f"{group} long, {member} long, {value} {kind}, _mask int, _own boolean, " + ", ".join(f"_d{k} double" for k in range(PIVOTS)) + ", _to long"
    with tk.small_batches(rows.sparkSession):
        placed = materialize(rows.join(pivots, group).select(group, member, value, "_closed", "_pivots", "_values").mapInArrow(step, schema), "pivot_rows")
    met = F.expr("filter(_pivots, (p, i) -> shiftright(_mask, i) % 2 = 1)")
    met = placed.select(group, "_mask").distinct().join(pivots.select(group, "_pivots"), group).select(met.alias("_met"))
    links = placed.select(F.col(member).alias("a"), F.col("_to").alias("b")).unionByName(met.select(F.explode("_met").alias("a"), F.get("_met", F.lit(0)).alias("b")))
    return placed, links.where("a <> b")


def _open_rows(placed: DataFrame, group: str, member: str, value: str, limit: float) -> DataFrame:
    """The rows of ``_pivot_round`` that are no pivot and may link with another cluster, or have none; ``_closed`` in the largest cluster."""
    low, high = ([f(f"_d{k}").alias(f"{name}{k}") for k in range(PIVOTS)] for name, f in (("_lo", F.min), ("_hi", F.max)))
    seen = placed.groupBy(group, "_mask", "_own").agg(F.count(F.lit(1)).alias("n"), *low, *high)
    seen = seen.groupBy(group).agg(F.collect_list(F.struct(F.col("_mask").alias("mask"), F.col("_own").alias("own"), "n",
                                                           F.array(*(f"_lo{k}" for k in range(PIVOTS))).alias("lo"),
                                                           F.array(*(f"_hi{k}" for k in range(PIVOTS))).alias("hi"))).alias("_seen"))

    @tk.tidy
    def decide(batches):  # per group and mask: whether it is in the largest cluster, and the distances of the other clusters' rows
        for batch in batches:
            for g, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                cluster, count = clusters([s["mask"] for s in some]), {}
                for s in some:
                    count[cluster[s["mask"]]] = count.get(cluster[s["mask"]], 0) + s["n"]
                largest = max((c for c in count if c), key=lambda c: (count[c], c))
                others = [[x for s in some if not s["own"] and cluster[s["mask"]] != c for x in s["lo"] + s["hi"]] for c in cluster.values()]
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(cluster), pa.int64()), pa.array(list(cluster), pa.int32()),
                                                  pa.array([c == largest for c in cluster.values()]), pa.array(others, pa.list_(pa.float64()))],
                                                 [group, "_mask", "_closed", "_others"])

    @tk.tidy
    def step(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            mask = batch.column(3).to_numpy()
            far = np.stack([batch.column(5 + k).to_numpy() for k in range(PIVOTS)], axis=1)
            _, kind = np.unique(np.stack([batch.column(0).to_numpy(), mask], axis=1), axis=0, return_inverse=True)
            kind = kind.reshape(-1)
            order, left = np.argsort(kind, kind="stable"), mask == 0
            for a, b in runs(kind[order]):
                at = order[a:b]
                for box in batch.column(6 + PIVOTS)[int(at[0])].values.to_numpy().reshape(-1, 2, PIVOTS):
                    left[at] |= ((far[at] >= box[0] - limit) & (far[at] <= box[1] + limit)).all(axis=1)
            keep = pa.array(np.flatnonzero(left & ~batch.column(4).to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(keep) for i in (0, 1, 2, 5 + PIVOTS)], [group, member, value, "_closed"])

    seen = materialize(seen.mapInArrow(decide, f"{group} long, _mask int, _closed boolean, _others array<double>"), "clusters")
    told = placed.join(seen, [group, "_mask"]).select(group, member, value, "_mask", "_own", *(f"_d{k}" for k in range(PIVOTS)), "_closed", "_others")
    kind = placed.schema[value].dataType.simpleString()
    with tk.small_batches(placed.sparkSession):
        return materialize(told.mapInArrow(step, f"{group} long, {member} long, {value} {kind}, _closed boolean"), "open_rows")


def clusters(masks: list[int]) -> dict[int, int]:
    """Every mask's cluster: the union of the masks that shared bits connect with it; 0 for none."""
    out: list[int] = []
    for m in masks:
        if m:
            for c in [c for c in out if c & m]:
                out.remove(c)
                m |= c
            out.append(m)
    return {m: next((c for c in out if c & m), 0) for m in masks}


def _merged(step, rows: int = 4096):
    """Small record batches joined before they leave the task."""
    def run(batches):
        held, n = [], 0
        for got in step(batches):
            held.append(got)
            n += got.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return run


def local_roots(links: np.ndarray) -> np.ndarray:
    """Smallest reachable row for every row of a symmetric boolean matrix."""
    n = len(links)
    root = np.arange(n)
    while True:
        near = np.where(links, root[None, :], n).min(axis=1, initial=n)
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of ``edges`` (a, b).

    Rounds of contraction: every node takes its smallest neighbour as parent, parents are
    followed twice, and the edges between parents go to the next round; each round is staged.
    """
    e = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}_edges")
    own = None
    while not e.isEmpty():
        both = e.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(e.select(F.col("b").alias("x"), F.col("a").alias("y")))
        parent = materialize(both.groupBy("x").agg(F.min("y").alias("p")).select("x", F.least("x", "p").alias("p")), f"{name}_parent")
        for _ in range(2):
            up = parent.select(F.col("x").alias("_x"), F.col("p").alias("_p"))
            parent = parent.join(up, F.col("p") == F.col("_x")).select("x", F.col("_p").alias("p"))
        parent = materialize(parent, f"{name}_parent")
        if own is None:
            own = parent.select(F.col("x").alias("node"), F.col("p").alias("component"))
        else:
            own = materialize(own.join(parent, F.col("component") == F.col("x"), "left")
                                 .select("node", F.coalesce("p", "component").alias("component")), f"{name}_own")
        pa_, pb = (parent.select(F.col("x").alias(f"_{c}x"), F.col("p").alias(f"_{c}")) for c in "ab")
        e = materialize(e.join(pa_, F.col("a") == F.col("_ax")).join(pb, F.col("b") == F.col("_bx"))
                         .where("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), f"{name}_edges")
    if own is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return own
