"""fix_datetime: the notebook's three demo dates, hour 24, malformed text, and a property test
against a plain-Python reading of the rules."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions.datetime import fix_datetime


def _run(spark, texts, shift_all=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", fix_datetime("t", shift_all=shift_all).alias("ts")).orderBy("i").collect()
    return [r.ts for r in rows]


def py_fix(text, shift_all=False):
    """The rules in plain Python: two blank-separated parts, Y-m-d and H:M:S, hour 24 = next day 00."""
    if text is None:
        return None
    parts = text.split()
    if len(parts) != 2:
        return None
    d, t = parts[0].split("-"), parts[1].split(":")
    if len(d) != 3 or len(t) != 3 or not all(x.isdigit() for x in d + t) or len(d[0]) != 4:
        return None
    if any(len(x) > 2 for x in d[1:] + t):
        return None
    y, m, day, h, mi, s = map(int, d + t)
    try:
        if shift_all:
            return dt.datetime(y, m, day, 23 if h == 24 else h, mi, s) + dt.timedelta(hours=1)
        if h == 24:
            return dt.datetime(y, m, day, 0, mi, s) + dt.timedelta(days=1)
        return dt.datetime(y, m, day, h, mi, s)
    except ValueError:
        return None


def test_notebook_demo_dates(spark):
    out = _run(spark, ["2023-03-03 14:23:41", "2023-03-03 24:23:41", "23"])
    assert out == [dt.datetime(2023, 3, 3, 14, 23, 41), dt.datetime(2023, 3, 4, 0, 23, 41), None]


def test_shift_all_reproduces_the_original_job(spark):
    out = _run(spark, ["2023-03-03 14:23:41", "2023-03-03 24:23:41"], shift_all=True)
    assert out == [dt.datetime(2023, 3, 3, 15, 23, 41), dt.datetime(2023, 3, 4, 0, 23, 41)]


def test_malformed(spark):
    texts = ["2023-02-30 10:00:00", "2023-03-03 10:60:00", "2023-03-03 10:00:60", "2023-03-03", "",
             None, "2023-03-03T10:00:00", "2023/03/03 10:00:00", "2023-03-03 25:00:00", "  2023-03-03   7:03:09 "]
    out = _run(spark, texts)
    assert out[:9] == [None] * 9
    assert out[9] == dt.datetime(2023, 3, 3, 7, 3, 9)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1990, 2030), st.integers(0, 13), st.integers(0, 32), st.integers(0, 25),
                          st.integers(0, 61), st.integers(0, 61)), min_size=1, max_size=30))
def test_property_matches_python(spark, parts):
    texts = [f"{y}-{m}-{d} {h}:{mi:02d}:{s}" for y, m, d, h, mi, s in parts]
    assert _run(spark, texts) == [py_fix(t) for t in texts]


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([("2023-03-03 24:00:00",)], "t string").select(fix_datetime("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and F is not None
