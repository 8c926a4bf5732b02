"""The FIXTURES.md views written as DuckDB SQL (CTE bodies) for the oracle queries.

They follow the same rules as ``ledgerlens.sources.tables`` and share its constants, so
Spark and DuckDB start from identical inputs.
"""

from __future__ import annotations

from ledgerlens.sources.tables import (
    COUNTRIES, DEFECTS, DRIFT_FILE, N_FILES, SHIFT_SECONDS, SOURCES, TX_EPOCH, header_line,
)


def _d(name: str) -> str:
    m, r = DEFECTS[name]
    return f"(event_id % {m} = {r})"


SECS = f"((epoch_us(ts) - epoch_us(TIMESTAMP '{TX_EPOCH}')) // 1000000)"
FILE = f"('tx_' || (event_id % {N_FILES}) || '.txt')"

TX = f"""
SELECT event_id AS tranaction_id, ts AS tx_datetime, user_id AS customer_id,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS terminal_id, value AS tx_amount,
       CAST({SECS} AS DOUBLE) AS tx_time_seconds, CAST({SECS} // 86400 AS INTEGER) AS tx_time_days,
       CAST(event_type = 'error' AS INTEGER) AS tx_fraud,
       CAST(CASE WHEN event_type = 'error' THEN 1 + user_id % 3 ELSE 0 END AS INTEGER) AS tx_fraud_scenario,
       {FILE} AS source_file
FROM events
"""

_ID_TXT = f"CASE WHEN {_d('bad_id')} THEN 'x' || event_id ELSE CAST(event_id AS VARCHAR) END"
_CENTS = "CAST(round(value * 100) AS BIGINT)"
_DT_TXT = f"""CASE WHEN {_d('hour_only')} THEN strftime(ts, '%H')
     WHEN {_d('date_only')} THEN strftime(ts, '%Y-%m-%d')
     WHEN hour(ts) = 0 AND {_d('hour_24')} THEN strftime(CAST(ts AS DATE) - 1, '%Y-%m-%d') || ' 24:' || strftime(ts, '%M:%S')
     ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"""

TX_LINES = f"""
SELECT 'tx_' || k || '.txt' AS source_file,
       CASE WHEN k = {DRIFT_FILE} THEN '{header_line(True)}' ELSE '{header_line(False)}' END AS value
FROM (SELECT DISTINCT event_id % {N_FILES} AS k FROM events)
UNION ALL
SELECT {FILE} AS source_file,
  CASE WHEN {_d('sparse')} THEN ({_ID_TXT}) || ',,,,,,,,'
  ELSE concat_ws(',',
    {_ID_TXT},
    {_DT_TXT},
    CAST(user_id AS VARCHAR),
    json_extract_string(props, '$.k'),
    CASE WHEN {_d('blank_amount')} THEN '' ELSE CAST({_CENTS} // 100 AS VARCHAR) || '.' || lpad(CAST({_CENTS} % 100 AS VARCHAR), 2, '0') END,
    CAST({SECS} + CASE WHEN {_d('shifted')} THEN {SHIFT_SECONDS} ELSE 0 END AS VARCHAR),
    CAST({SECS} // 86400 AS VARCHAR),
    CAST(CAST(event_type = 'error' AS INTEGER) AS VARCHAR),
    CAST(CASE WHEN event_type = 'error' THEN 1 + user_id % 3 ELSE 0 END AS VARCHAR))
  END AS value
FROM events
"""

DT_RE = r"^(\d{4})-(\d{1,2})-(\d{1,2}) (\d{1,2}):(\d{1,2}):(\d{1,2})$"


def fix_datetime_sql(text: str) -> str:
    s = f"regexp_replace(trim({text}), '\\s+', ' ', 'g')"
    p = [f"TRY_CAST(regexp_extract({s}, '{DT_RE}', {i}) AS INTEGER)" for i in range(1, 7)]
    y, mo, d, h, mi, se = p
    return (f"CASE WHEN {se} < 60 THEN CASE WHEN {h} = 24 "
            f"THEN try(make_timestamp({y}, {mo}, {d}, 0, {mi}, {se})) + INTERVAL 1 DAY "
            f"ELSE try(make_timestamp({y}, {mo}, {d}, {h}, {mi}, {se})) END END")


def hour24_sql(text: str) -> str:
    s = f"regexp_replace(trim({text}), '\\s+', ' ', 'g')"
    return f"(TRY_CAST(regexp_extract({s}, '{DT_RE}', 4) AS INTEGER) = 24)"


TX_PARSED = f"""
SELECT TRY_CAST(trim(f[1]) AS BIGINT) AS tranaction_id,
       {fix_datetime_sql('f[2]')} AS tx_datetime,
       TRY_CAST(trim(f[3]) AS BIGINT) AS customer_id,
       TRY_CAST(trim(f[4]) AS BIGINT) AS terminal_id,
       TRY_CAST(trim(f[5]) AS DOUBLE) AS tx_amount,
       TRY_CAST(trim(f[6]) AS DOUBLE) AS tx_time_seconds,
       TRY_CAST(trim(f[7]) AS INTEGER) AS tx_time_days,
       TRY_CAST(trim(f[8]) AS INTEGER) AS tx_fraud,
       TRY_CAST(trim(f[9]) AS INTEGER) AS tx_fraud_scenario,
       source_file
FROM (SELECT source_file, string_split(value, ',') AS f FROM tx_lines WHERE NOT starts_with(value, '#'))
"""

_PRESENT = " + ".join(
    f"CAST({c} IS NOT NULL AS INTEGER)" if c not in ("tx_amount", "tx_time_seconds")
    else f"CAST({c} IS NOT NULL AND NOT isnan({c}) AS INTEGER)"
    for c in ("tranaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount", "tx_time_seconds",
              "tx_time_days", "tx_fraud", "tx_fraud_scenario"))


def clean_sql(src: str, cap: float = 131.45, n: float = 4.0, two_sided: bool = False, action: str = "replace") -> str:
    """CTE chain (as text) for incomplete -> cap -> time outliers over the CTE named ``src``."""
    beyond = f"abs(_res) >= {n} * _sd" if two_sided else f"_res > {n} * _sd"
    outl = f"coalesce(_sd > 0 AND {beyond}, FALSE)"
    cols = "tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_days, tx_fraud, tx_fraud_scenario, source_file"
    final = (f"SELECT {cols}, CASE WHEN {outl} THEN _pred ELSE tx_time_seconds END AS tx_time_seconds FROM c_res2"
             if action == "replace" else
             f"SELECT {cols}, tx_time_seconds FROM c_res2 WHERE NOT {outl}")
    return f"""
c_inc AS (SELECT * FROM {src} WHERE {_PRESENT} >= 2),
c_cap AS (SELECT * REPLACE (CASE WHEN tx_amount > {cap} THEN {cap} ELSE tx_amount END AS tx_amount) FROM c_inc),
c_x AS (SELECT *, CAST(epoch_us(tx_datetime) // 1000000 AS DOUBLE) AS _x FROM c_cap),
c_fit AS (SELECT source_file, regr_slope(tx_time_seconds, _x) AS _b, regr_avgx(tx_time_seconds, _x) AS _ax,
                 regr_avgy(tx_time_seconds, _x) AS _ay FROM c_x GROUP BY source_file),
c_res AS (SELECT c_x.*, _ay + _b * (_x - _ax) AS _pred, tx_time_seconds - (_ay + _b * (_x - _ax)) AS _res
          FROM c_x LEFT JOIN c_fit USING (source_file)),
c_sd AS (SELECT source_file, stddev_samp(_res) AS _sd FROM c_res GROUP BY source_file),
c_res2 AS (SELECT * FROM c_res LEFT JOIN c_sd USING (source_file)),
c_out AS ({final})"""


RV = f"""
SELECT o_orderkey AS id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS score, o_orderdate AS created_time,
       ['{"', '".join(COUNTRIES)}'][CAST(o_custkey % 3 + 1 AS INTEGER)] AS country,
       CASE WHEN o_custkey % 2 = 0 THEN '{SOURCES[0]}' ELSE '{SOURCES[1]}' END AS source,
       CASE o_orderstatus WHEN 'F' THEN 'NEGATIVE' WHEN 'O' THEN 'POSITIVE' ELSE 'NEUTRAL' END AS sentiment
FROM orders
"""

RT = """
SELECT avg(score) AS score, source, CAST(created_time AS DATE) AS dates, CAST(count(*) AS INTEGER) AS count
FROM rv GROUP BY source, CAST(created_time AS DATE)
"""

DOCS = "SELECT doc_id AS id, text AS content, lang AS country, source FROM documents"
EMB = "SELECT vec_id AS id, embedding AS embeddings, label FROM embeddings"


def with_views(*names: str) -> str:
    """``WITH`` prefix defining the named views (dependencies included, in order)."""
    bodies = {"tx": TX, "tx_lines": TX_LINES, "tx_parsed": TX_PARSED, "rv": RV, "rt": RT, "docs": DOCS, "emb": EMB}
    deps = {"tx_parsed": ["tx_lines"], "rt": ["rv"]}
    order: list[str] = []

    def add(n):
        for d in deps.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(f"{n} AS ({bodies[n]})" for n in order)
