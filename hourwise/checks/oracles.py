"""DuckDB oracle SQL for the registered queries (views: the provided tables)."""

from __future__ import annotations

def r6(expr: str, digits: int = 6) -> str:
    """Same rounding as the Spark side: snap at 9 decimals, then half-up at ``digits`` (exact decimal)."""
    return f"CAST(round(CAST(round({expr}, 9) AS DECIMAL(38, 9)), {digits}) AS DOUBLE)"


# The hourly stand-in series, as a CTE body.
H = """h AS (SELECT event_type AS series, date_trunc('hour', ts) AS "Timestamp", avg(value) AS "Load"
           FROM events GROUP BY 1, 2)"""

# Trailing / centred means with min_periods, as in the feature builder.
def _roll(n_back: int, n_ahead: int, mp: int, name: str, part: str = "series", order: str = '"Timestamp"', v: str = '"Load"') -> str:
    frame = f"PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n_back} PRECEDING AND {n_ahead} FOLLOWING"
    return r6(f"CASE WHEN count({v}) OVER ({frame}) >= {mp} THEN avg({v}) OVER ({frame}) END") + f' AS "{name}"'


FEATURES_SQL = f"""
WITH {H},
w AS (SELECT "Timestamp", "Load" AS "Temperature" FROM h WHERE series = 'view'),
j AS (SELECT h.*, w."Temperature" FROM h LEFT JOIN w USING ("Timestamp")),
f AS (
  SELECT series, "Timestamp", "Load", "Temperature",
    CASE WHEN "Temperature" > 20 THEN 1 ELSE 0 END AS "hotFlag",
    CASE WHEN "Temperature" < 9 THEN 1 ELSE 0 END AS "coldFlag",
    CAST("Timestamp" AS DATE) AS "Date",
    CAST(hour("Timestamp") AS INTEGER) AS "Hour",
    CASE WHEN isodow("Timestamp") >= 6 THEN 1 ELSE 0 END AS "IsWeekend",
    CAST(month("Timestamp") AS INTEGER) AS "Month",
    {_roll(0, 0, 1, "LoadTrailing1")},
    {_roll(1, 0, 2, "LoadTrailing2")},
    {_roll(2, 0, 1, "LoadTrailing3")},
    {_roll(6, 0, 1, "LoadTrailing7")},
    {_roll(1, 1, 1, "LoadCentered3")},
    {_roll(3, 3, 1, "LoadCentered7")},
    CAST(year("Timestamp") AS INTEGER) AS "Year",
    CAST(dayofyear("Timestamp") AS INTEGER) AS "DayOfYear",
    CAST(isodow("Timestamp") AS INTEGER) AS "DayOfWeek",
    CASE WHEN month("Timestamp") IN (12, 1, 2) THEN 1 WHEN month("Timestamp") IN (3, 4, 5) THEN 2
         WHEN month("Timestamp") IN (6, 7, 8) THEN 3 ELSE 4 END AS "seasonNum"
  FROM j),
d AS (SELECT series, CAST("Timestamp" AS DATE) AS "Date", avg("Load") AS dm FROM h GROUP BY 1, 2),
dl AS (SELECT series, "Date", lag(dm, 1) OVER (PARTITION BY series ORDER BY "Date") AS "1DayLag" FROM d)
SELECT f.series, f."Timestamp", {r6('f."Load"')} AS "Load", {r6('f."Temperature"')} AS "Temperature",
  "hotFlag", "coldFlag", f."Date", "Hour", "IsWeekend", "Month",
  "LoadTrailing1", "LoadTrailing2", "LoadTrailing3", "LoadTrailing7", "LoadCentered3", "LoadCentered7",
  {r6('dl."1DayLag"')} AS "1DayLag", "Year", "DayOfYear", "DayOfWeek", "seasonNum"
FROM f LEFT JOIN dl ON f.series = dl.series AND f."Date" = dl."Date"
"""

ORACLES: dict[str, str] = {
    "pipe_features": FEATURES_SQL,
}


# ---------------------------------------------------------------------------------------------- helpers

def _cols(*names_and_exprs: str) -> str:
    return ", ".join(names_and_exprs)


EVENTS_COLS = f'event_id, ts, user_id, event_type, {r6("value")} AS value, props'
ORDERS_COLS = f'o_orderkey, o_custkey, o_orderstatus, {r6("o_totalprice")} AS o_totalprice, o_orderdate, o_orderpriority'
CO = 'co AS (SELECT o_orderkey, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS "Date" FROM orders)'
SEASON = ('CASE WHEN month({d}) IN (12, 1, 2) THEN {w} WHEN month({d}) IN (3, 4, 5) THEN {sp} '
          'WHEN month({d}) IN (6, 7, 8) THEN {su} ELSE {f} END')


def season_name(d: str) -> str:
    return SEASON.format(d=d, w="'Winter'", sp="'Spring'", su="'Summer'", f="'Fall'")


def season_num(d: str) -> str:
    return SEASON.format(d=d, w=1, sp=2, su=3, f=4)


def nth_wd(y: str, m: int, wd: int, n: int) -> str:
    """n-th weekday (Monday = 0) of month m in year y, as DATE."""
    first = f"make_date(CAST({y} AS INTEGER), {m}, 1)"
    return f"({first} + CAST((({wd} - (isodow({first}) - 1)) % 7 + 7) % 7 + {7 * (n - 1)} AS INTEGER))"


def last_wd(y: str, m: int, wd: int) -> str:
    last = f"last_day(make_date(CAST({y} AS INTEGER), {m}, 1))"
    return f"({last} - CAST((((isodow({last}) - 1) - {wd}) % 7 + 7) % 7 AS INTEGER))"


def easter(y: str) -> str:
    """Gregorian Easter Sunday of year y (integer arithmetic)."""
    y = f"CAST({y} AS BIGINT)"
    a, b, c = f"({y} % 19)", f"({y} // 100)", f"({y} % 100)"
    d, e, f_ = f"({b} // 4)", f"({b} % 4)", f"(({b} + 8) // 25)"
    g = f"(({b} - {f_} + 1) // 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i, k = f"({c} // 4)", f"({c} % 4)"
    l = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {l}) // 451)"
    n = f"({h} + {l} - 7 * {m} + 114)"
    return f"make_date(CAST({y} AS INTEGER), CAST({n} // 31 AS INTEGER), CAST({n} % 31 + 1 AS INTEGER))"


def flag(cond: str, name: str) -> str:
    return f'CASE WHEN {cond} THEN 1 ELSE 0 END AS "{name}"'


def federal(d: str) -> list[str]:
    m, dd, dow = f"month({d})", f"day({d})", f"isodow({d})"
    return [
        flag(f"{m} = 1 AND {dd} = 1", "newYearsDay"),
        flag(f"({m} = 1 AND {dd} = 2 AND {dow} = 1) OR ({m} = 12 AND {dd} = 31 AND {dow} = 5)", "newYearsDayObserved"),
        flag(f"{m} = 1 AND {dow} = 1 AND {dd} BETWEEN 15 AND 21", "martinLutherKingJrDay"),
        flag(f"{m} = 2 AND {dow} = 1 AND {dd} BETWEEN 15 AND 21", "washingtonsBirthday"),
        flag(f"{m} = 5 AND {dow} = 1 AND {dd} >= 25", "memorialDay"),
        flag(f"{m} = 6 AND {dd} = 19 AND year({d}) >= 2021", "juneteenthNationalIndependenceDay"),
        flag(f"{m} = 7 AND {dd} = 4", "independenceDay"),
        flag(f"{m} = 9 AND {dow} = 1 AND {dd} <= 7", "laborDay"),
        flag(f"{m} = 10 AND {dow} = 1 AND {dd} BETWEEN 8 AND 14", "columbusDay"),
        flag(f"{m} = 11 AND (({dd} = 10 AND {dow} = 5) OR ({dd} = 12 AND {dow} = 1))", "veteransDayObserved"),
        flag(f"{m} = 11 AND {dd} = 11", "veteransDay"),
        flag(f"{m} = 11 AND {dow} = 4 AND {dd} BETWEEN 22 AND 28", "thanksgivingDay"),
        flag(f"{m} = 12 AND {dd} = 25", "christmasDay"),
    ]


def fixed(d: str) -> list[str]:
    return [flag(f"month({d}) = {mo} AND day({d}) = {dy}", n)
            for n, mo, dy in (("newYearsEve", 12, 31), ("christmasEve", 12, 24), ("valentinesDay", 2, 14), ("halloween", 10, 31))]


def tg_family(d: str) -> list[str]:
    tg = nth_wd(f"year({d})", 11, 3, 4)
    return [flag(f"{d} = {tg}", "thanksgiving"), flag(f"{d} = {tg} + 1", "blackFriday"), flag(f"{d} = {tg} + 4", "cyberMonday")]


def easter_flag(d: str) -> str:
    return flag(f"{d} = {easter(f'year({d})')}", "easter")


def _school_values() -> str:
    from ..functions.fixed_values import school_intervals
    return ", ".join(f"('{k}', '{s}', '{e}')" for k, s, e in school_intervals())


def school(d: str, src: str) -> list[str]:
    def ex(kind):
        return f"EXISTS (SELECT 1 FROM iv WHERE iv.kind = '{kind}' AND {src}.{d} BETWEEN iv.s AND iv.e)"
    return [
        f'CASE WHEN {ex("schoolYear")} THEN 0 ELSE 1 END AS "summerBreak"',
        flag(ex("schoolYear"), "schoolYear"), flag(ex("winterBreak"), "winterBreak"),
        flag(ex("midWinterBreak"), "midWinterBreak"), flag(ex("springBreak"), "springBreak"),
        flag(ex("thanksgivingBreak"), "thanksgivingBreak"),
    ]


IV = (f"iv AS (SELECT kind, CAST(strptime(s, '%m/%d/%Y') AS DATE) AS s, CAST(strptime(e, '%m/%d/%Y') AS DATE) AS e "
      f"FROM (VALUES {_school_values()}) t(kind, s, e))")

GRID = """b AS (SELECT series, min("Timestamp") AS lo, max("Timestamp") AS hi FROM h GROUP BY 1),
g AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS "Timestamp" FROM b),
m AS (SELECT g.series, g."Timestamp" FROM g WHERE NOT EXISTS
      (SELECT 1 FROM h WHERE h.series = g.series AND h."Timestamp" = g."Timestamp"))"""

LI = ("li AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
      "CASE WHEN l_discount <> 0 THEN l_discount END AS l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem)")
LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
          "l_returnflag", "l_linestatus", "l_shipdate"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CUST = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string")]

W = 'PARTITION BY series ORDER BY "Timestamp"'


def q(name: str) -> str:
    return f'"{name}"'


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _describe_num(col: str, src: str, digits: int = 4, with_text: bool = False) -> str:
    text = "CAST(NULL AS BIGINT) AS \"unique\", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, " if with_text else ""
    x = f"CAST({col} AS DOUBLE)"
    return (f"SELECT '{col}' AS \"column\", count({col}) AS \"count\", {text}{r6(f'avg({x})', digits)} AS mean, "
            f"{r6(f'stddev_samp({x})', digits)} AS std, {r6(f'min({x})', digits)} AS \"min\", "
            f"{r6(f'quantile_cont({x}, 0.25)', digits)} AS q25, {r6(f'quantile_cont({x}, 0.5)', digits)} AS q50, "
            f"{r6(f'quantile_cont({x}, 0.75)', digits)} AS q75, {r6(f'max({x})', digits)} AS \"max\" FROM {src}")


def _describe_text(col: str, src: str) -> str:
    top = f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} ASC LIMIT 1)"
    freq = f"(SELECT count(*) FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} ASC LIMIT 1)"
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {q(c)}" for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
    return (f"SELECT '{col}' AS \"column\", count({col}) AS \"count\", count(DISTINCT {col}) AS \"unique\", "
            f"{top} AS top, {freq} AS freq, {nulls} FROM {src}")


def _lag_cols(lags) -> str:
    return ", ".join(f'lag("Load", {k}) OVER ({W}) AS l{k}' for k in lags)


def _metrics(src: str, group: str) -> str:
    e = '("Load" - forecast)'
    return (f"SELECT {group}, count(*) AS n, {r6(f'avg({e} * {e})', 4)} AS mse, {r6(f'sqrt(avg({e} * {e}))', 4)} AS rmse, "
            f"{r6(f'avg(abs({e}))', 4)} AS mae, "
            f"{r6(f'avg(abs({e} / \"Load\")) FILTER (WHERE \"Load\" <> 0) * 100', 4)} AS mape, "
            f"count(*) FILTER (WHERE \"Load\" = 0) AS n_zero_actual "
            f"FROM {src} WHERE \"Load\" IS NOT NULL AND forecast IS NOT NULL GROUP BY {group}")


SNAIVE = """f AS (SELECT h.series, h."Timestamp", h."Load", p."Load" AS forecast FROM h LEFT JOIN h p
            ON p.series = h.series AND p."Timestamp" = h."Timestamp" - INTERVAL 24 HOUR)"""

_TZ = """o AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS l,
              CASE WHEN month(o_orderdate) BETWEEN 4 AND 10 THEN 'EDT' ELSE 'EST' END AS label FROM orders),
d AS (SELECT *, CAST(make_date(CAST(year(l) AS INTEGER), 4, 1) AS TIMESTAMP)
                + to_days(CAST((7 - isodow(make_date(CAST(year(l) AS INTEGER), 4, 1))) % 7 AS INTEGER)) AS s,
                CAST(make_date(CAST(year(l) AS INTEGER), 10, 31) AS TIMESTAMP)
                - to_days(CAST(isodow(make_date(CAST(year(l) AS INTEGER), 10, 31)) % 7 AS INTEGER)) AS e FROM o),
u AS (SELECT o_orderkey, l, label, l + to_hours(CASE
        WHEN l >= s + INTERVAL 2 HOUR AND l < s + INTERVAL 3 HOUR THEN CASE WHEN label = 'EDT' THEN 4 ELSE 5 END
        WHEN l >= e + INTERVAL 1 HOUR AND l < e + INTERVAL 2 HOUR THEN CASE WHEN label = 'EDT' THEN 4 ELSE 5 END
        WHEN l >= s + INTERVAL 3 HOUR AND l < e + INTERVAL 1 HOUR THEN 4 ELSE 5 END) AS utc FROM d)"""

_THRESH = """w AS (SELECT "Timestamp", "Load" AS "Temperature" FROM h WHERE series = 'view'),
d AS (SELECT p.series, p."Load" AS y, w."Temperature" AS t FROM h p LEFT JOIN w USING ("Timestamp")
      WHERE w."Temperature" IS NOT NULL AND p."Load" IS NOT NULL),
tot AS (SELECT series, count(*) AS "N", sum(y) AS "S", sum(y * y) AS "Q" FROM d GROUP BY series),
{side}"""


def _thresh_side(name: str, bexpr: str, order: str) -> str:
    return f"""{name}b AS (SELECT series, CAST({bexpr} AS BIGINT) AS b, count(*) AS n, sum(y) AS s, sum(y * y) AS qq FROM d GROUP BY 1, 2),
{name}c AS (SELECT series, b, sum(n) OVER (PARTITION BY series ORDER BY b {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n1,
                 sum(s) OVER (PARTITION BY series ORDER BY b {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s1,
                 sum(qq) OVER (PARTITION BY series ORDER BY b {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS q1 FROM {name}b),
{name}s AS (SELECT series, '{name}' AS flag, CAST(b AS DOUBLE) AS threshold,
    ("Q" - "S" * "S" / "N") - (q1 - s1 * s1 / n1)
    - CASE WHEN "N" - n1 > 0 THEN ("Q" - q1) - ("S" - s1) * ("S" - s1) / ("N" - n1) ELSE 0 END AS gain,
    CAST(n1 AS BIGINT) AS n_flagged FROM {name}c JOIN tot USING (series))"""


ORACLES.update({
    # sources / sinks
    "src_csv_roundtrip": f"SELECT c_custkey, c_name, c_nationkey, {r6('c_acctbal')} AS c_acctbal, c_mktsegment FROM customer",
    "sink_overwrite": f"SELECT {ORDERS_COLS} FROM orders",
    "set_union_months": f"SELECT {ORDERS_COLS} FROM orders",
    "src_month_partitions": """
WITH bo AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS TIMESTAMP) AS lo,
                   CAST(date_trunc('month', max(o_orderdate)) AS TIMESTAMP) AS hi FROM orders),
mo AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM bo),
c AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT strftime(mo.month_start, '%Y%m01') AS "partition", mo.month_start, coalesce(c.n_orders, 0) AS n_orders
FROM mo LEFT JOIN c ON mo.month_start = c.month_start""",
    "sink_append_month": "SELECT strftime(o_orderdate, '%Y%m') AS \"month\", count(*) AS n FROM orders GROUP BY 1",
    "sink_merge_month": f"""SELECT o_orderkey, o_orderstatus, o_orderdate, strftime(o_orderdate, '%Y%m') AS "month",
  {r6("o_totalprice + CASE WHEN o_orderstatus = 'F' AND year(o_orderdate) = 1996 THEN 1 ELSE 0 END")} AS o_totalprice FROM orders""",
    "src_zip_ingest": f"""SELECT o_orderkey, o_orderdate, {r6("o_totalprice")} AS o_totalprice, o_orderpriority,
  strftime(o_orderdate, '%Y%m') AS archive, 'orders-' || o_orderstatus || '.csv' AS member FROM orders""",
    "pipe_collect": """WITH mo AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-03-01', INTERVAL 1 MONTH)) AS DATE) AS month_start)
SELECT strftime(month_start, '%Y%m01') AS "partition", month_start FROM mo
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE month(o_orderdate) != 6 AND o_orderdate < TIMESTAMP '2001-01-01' AND date_trunc('month', o_orderdate) = month_start)""",
    "src_time_range_scan": f"""SELECT {EVENTS_COLS} FROM events
WHERE ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 23:59:59.999999'""",
    # projections / filters
    "flt_zone_eq": f"SELECT {EVENTS_COLS} FROM events WHERE event_type = 'click'",
    "flt_asof_date": f"SELECT {EVENTS_COLS} FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'",
    "str_incremental_ingest": f"SELECT {ORDERS_COLS} FROM orders",
    "flt_dropna": f"""SELECT {EVENTS_COLS} FROM (SELECT event_id, ts, user_id, event_type,
  CASE WHEN event_id % 20 = 0 THEN NULL ELSE value END AS value, props FROM events) WHERE value IS NOT NULL""",
    "prj_drop_rename": f"SELECT c_custkey, c_nationkey, {r6('c_acctbal')} AS balance, c_mktsegment AS segment FROM customer",
    "prj_numeric_cols": "SELECT l_partkey, l_suppkey, l_linenumber, " + ", ".join(
        f"{r6(c)} AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + " FROM lineitem",
    "prj_threshold_flags": f"""WITH {H}
SELECT "Timestamp", {r6('"Load"')} AS temp, CASE WHEN "Load" > 20 THEN 1 ELSE 0 END AS "hotFlag",
  CASE WHEN "Load" < 9 THEN 1 ELSE 0 END AS "coldFlag" FROM h WHERE series = 'view'""",
    "prj_mask_leaky": f"""WITH {H},
r AS (SELECT series, "Timestamp", "Load",
  avg("Load") OVER ({W} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS rolling,
  avg("Load") OVER ({W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS trl,
  row_number() OVER ({W}) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM h)
SELECT series, "Timestamp", {r6('"Load"')} AS "Load",
  {r6('CASE WHEN i >= floor(n * 0.8) THEN NULL ELSE rolling END')} AS "LoadRolling3",
  {r6('trl')} AS "LoadTrailing3", i >= floor(n * 0.8) AS is_test FROM r""",
    "prj_cast": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_text,
  CAST(strptime(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_ts,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_finished,
  CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents FROM orders""",
    # date / time
    "ts_local_to_utc": f"""WITH {_TZ}
SELECT o_orderkey, strftime(l, '%m/%d/%Y %H:%M:%S') AS local_text, label, utc,
  strftime(utc, '%Y-%m-%d %H:%M:%S') AS utc_text FROM u""",
    "ts_format": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%Y-%m-%d') AS date_text
FROM events""",
    "ts_date_hour": 'SELECT event_id, CAST(ts AS DATE) AS "Date", CAST(hour(ts) AS INTEGER) AS "Hour" FROM events',
    "ts_calendar_fields": f"""WITH {CO}
SELECT o_orderkey, "Date", dayname("Date") AS "Day", CASE WHEN isodow("Date") >= 6 THEN 1 ELSE 0 END AS "IsWeekend",
  CAST(month("Date") AS INTEGER) AS "Month", {season_name('"Date"')} AS "Season" FROM co""",
    "ts_numeric_date": f"""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS "Year",
  CAST(dayofyear(o_orderdate) AS INTEGER) AS "DayOfYear", CAST(isodow(o_orderdate) AS INTEGER) AS "DayOfWeek",
  {season_num('o_orderdate')} AS "seasonNum" FROM orders""",
    "ts_cyclical": f"""WITH {H}
SELECT series, "Timestamp",
  {r6('sin(2 * pi() / 24 * hour("Timestamp"))')} AS "hourSin", {r6('cos(2 * pi() / 24 * hour("Timestamp"))')} AS "hourCos",
  {r6('sin(2 * pi() / 7 * (isodow("Timestamp") - 1))')} AS "dowSin", {r6('cos(2 * pi() / 7 * (isodow("Timestamp") - 1))')} AS "dowCos",
  {r6('sin(2 * pi() / 12 * (month("Timestamp") - 1))')} AS "monthSin", {r6('cos(2 * pi() / 12 * (month("Timestamp") - 1))')} AS "monthCos"
FROM h""",
    # calendar
    "cal_nth_weekday": f"""WITH {CO}, y AS (SELECT DISTINCT CAST(year("Date") AS INTEGER) AS "Year" FROM co)
SELECT "Year", strftime({nth_wd('"Year"', 11, 3, 4)}, '%Y-%m-%d') AS thanksgiving,
  {nth_wd('"Year"', 1, 0, 3)} AS mlk_day, {nth_wd('"Year"', 9, 0, 1)} AS labor_day,
  {last_wd('"Year"', 5, 0)} AS memorial_day FROM y""",
    "cal_thanksgiving_family": f'WITH {CO} SELECT o_orderkey, "Date", {", ".join(tg_family(q("Date")))} FROM co',
    "cal_federal_flags": f'WITH {CO} SELECT o_orderkey, "Date", {", ".join(federal(q("Date")))} FROM co',
    "cal_fixed_dates": f'WITH {CO} SELECT o_orderkey, "Date", {", ".join(fixed(q("Date")))} FROM co',
    "cal_easter": f'WITH {CO} SELECT o_orderkey, "Date", {easter_flag(q("Date"))} FROM co',
    "cal_event_dates": f"""WITH {CO}, sb AS (SELECT CAST(d AS DATE) AS d FROM (VALUES {", ".join(
        f"('{d}')" for d in __import__('hourwise.functions.fixed_values', fromlist=['x']).date_list(
            __import__('hourwise.functions.fixed_values', fromlist=['x']).SUPER_BOWL_DATES))}) t(d))
SELECT o_orderkey, "Date", CASE WHEN "Date" IN (SELECT d FROM sb) THEN 1 ELSE 0 END AS "superBowl" FROM co""",
    "cal_interval_flags": f'WITH {CO}, {IV} SELECT o_orderkey, "Date", {", ".join(school(q("Date"), "co"))} FROM co',
    "pipe_calendar_features": f"""WITH {IV},
co AS (SELECT o_orderkey, o_totalprice AS "Load", CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS "Date" FROM orders)
SELECT o_orderkey, {r6('"Load"')} AS "Load", "Date", 0 AS "Hour", dayname("Date") AS "Day",
  CASE WHEN isodow("Date") >= 6 THEN 1 ELSE 0 END AS "IsWeekend", CAST(month("Date") AS INTEGER) AS "Month",
  {season_name('"Date"')} AS "Season", {", ".join(school(q("Date"), "co"))},
  {", ".join(federal(q("Date")))}, {", ".join(fixed(q("Date")))}, {", ".join(tg_family(q("Date")))}, {easter_flag(q("Date"))}
FROM co""",
    # joins, gaps, sets
    "join_left_temperature": f"""WITH {H}, w AS (SELECT "Timestamp", "Load" AS "Temperature" FROM h WHERE series = 'view')
SELECT h.series, h."Timestamp", {r6('h."Load"')} AS "Load", {r6('w."Temperature"')} AS "Temperature"
FROM h LEFT JOIN w ON h."Timestamp" = w."Timestamp\"""",
    "dq_missing_hours": f"WITH {H}, {GRID} SELECT series, \"Timestamp\" FROM m",
    "set_except_hours": f"WITH {H}, {GRID} SELECT series, \"Timestamp\" FROM g EXCEPT SELECT series, \"Timestamp\" FROM h",
    "dq_gap_report": f"""WITH {H}, {GRID},
bb AS (SELECT series, count(*) AS available_rows,
       CAST(date_diff('second', min("Timestamp"), max("Timestamp")) // 3600 + 1 AS BIGINT) AS expected_hours FROM h GROUP BY 1),
mc AS (SELECT series, count(*) AS missing_hours FROM m GROUP BY 1),
fm AS (SELECT series, string_agg(strftime("Timestamp", '%Y-%m-%d %H:%M:%S'), ',' ORDER BY "Timestamp") AS first_missing
       FROM (SELECT *, row_number() OVER (PARTITION BY series ORDER BY "Timestamp") AS rn FROM m) WHERE rn <= 10 GROUP BY 1)
SELECT bb.series, available_rows, expected_hours, coalesce(missing_hours, 0) AS missing_hours, first_missing
FROM bb LEFT JOIN mc ON bb.series = mc.series LEFT JOIN fm ON bb.series = fm.series""",
    # aggregates
    "agg_category_mean": f"""SELECT dayname(CAST(o_orderdate + INTERVAL 20 YEAR AS DATE)) AS "Day",
  {r6('avg(o_totalprice)', 4)} AS "mean_Load" FROM orders GROUP BY 1""",
    "agg_onehot_counts": union([f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} = 1) AS n_yes,
  count(*) FILTER (WHERE {c} = 0) AS n_no FROM labels""" for c in ("quality", "toxic")]),
    "agg_cond_mean": f"""SELECT {r6('avg(n_chars) FILTER (WHERE quality = 1)')} AS yes_mean,
  {r6('avg(n_chars) FILTER (WHERE quality = 0)')} AS no_mean FROM documents JOIN labels USING (doc_id)""",
    "agg_time_span": 'SELECT event_type, min(ts) AS "first", max(ts) AS "last" FROM events GROUP BY 1',
    "agg_scale_by_count": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load",
  {r6('"Load" / (SELECT count(*) FROM h)')} AS "Load_scaled" FROM h""",
    # profiles
    "prof_missing": f"WITH {LI} " + union([f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
  {r6(f'count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*)')} AS pct_missing FROM li""" for c in LI_ALL]),
    "prof_shape": """SELECT count(*) AS n_rows,
  (SELECT CAST(count(*) AS INTEGER) FROM (DESCRIBE SELECT * FROM lineitem)) AS n_cols FROM lineitem""",
    "prof_schema": union([f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM customer"
                          for i, (c, t) in enumerate(CUST)]),
    "prof_nunique": union([f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS nunique FROM customer" for c, _ in CUST]),
    "prof_value_counts": 'SELECT c_mktsegment, count(*) AS "count" FROM customer GROUP BY 1',
    "prof_moments": f"WITH {LI} " + union([f"""SELECT '{c}' AS "column", {r6(f'avg(CAST({c} AS DOUBLE))', 4)} AS mean,
  {r6(f'stddev_samp(CAST({c} AS DOUBLE))', 4)} AS std, {r6(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 4)} AS median FROM li"""
                                            for c in LI_NUM]),
    "prof_describe": f"WITH {LI} " + union([_describe_num(c, "li") for c in LI_NUM]),
    "prof_describe_all": union([_describe_num(c, "customer", with_text=True) if t != "string" else _describe_text(c, "customer")
                                for c, t in CUST]),
    "prof_corr_matrix": f"WITH {LI} " + union([
        f"SELECT '{a}' AS x, '{b}' AS y, {r6(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS r FROM li"
        for a in LI_NUM + ["l_linenumber"] for b in LI_NUM + ["l_linenumber"]]),
    # windows
    "win_trailing_mean": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load", {_roll(0, 0, 1, "LoadTrailing1")},
  {_roll(1, 0, 2, "LoadTrailing2")}, {_roll(2, 0, 1, "LoadTrailing3")}, {_roll(6, 0, 1, "LoadTrailing7")} FROM h""",
    "win_centered_mean": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load",
  {_roll(1, 1, 1, "LoadCentered3")}, {_roll(3, 3, 1, "LoadCentered7")} FROM h""",
    "win_rolling_pair": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load",
  {_roll(3, 3, 1, "LoadRolling3")}, {_roll(2, 0, 1, "LoadTrailing3")} FROM h""",
    "win_lead_target": f"""WITH {H} SELECT * FROM (SELECT series, "Timestamp", {r6('"Load"')} AS "Load",
  {r6(f'lead("Load", 7) OVER ({W})')} AS "Load_target" FROM h) WHERE "Load_target" IS NOT NULL""",
    "win_calendar_lead": f"""WITH {H} SELECT h.series, h."Timestamp", {r6('h."Load"')} AS "Load", {r6('a."Load"')} AS "Load_target"
FROM h LEFT JOIN h a ON a.series = h.series AND a."Timestamp" = h."Timestamp" + INTERVAL 7 HOUR""",
    "win_daily_lag_mean": f"""WITH {H},
dd AS (SELECT series, CAST("Timestamp" AS DATE) AS "Date", avg("Load") AS dm FROM h GROUP BY 1, 2),
dl AS (SELECT series, "Date", lag(dm, 1) OVER (PARTITION BY series ORDER BY "Date") AS lg FROM dd)
SELECT h.series, h."Timestamp", {r6('h."Load"')} AS "Load", CAST(h."Timestamp" AS DATE) AS "Date", {r6('dl.lg')} AS "1DayLag"
FROM h LEFT JOIN dl ON h.series = dl.series AND CAST(h."Timestamp" AS DATE) = dl."Date\"""",
    "win_chrono_split": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load", i >= floor(n * 0.8) AS is_test
FROM (SELECT *, row_number() OVER ({W}) - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM h)""",
    "win_position_slice": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load", position
FROM (SELECT *, row_number() OVER ({W}) - 1 AS position FROM h) WHERE position >= 100 AND position < 200""",
    "win_lags": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load", {r6(f'lag("Load", 24) OVER ({W})')} AS "LoadLag24",
  {r6(f'lag("Load", 168) OVER ({W})')} AS "LoadLag168" FROM h""",
    "win_rolling_std": f"""WITH {H} SELECT series, "Timestamp", {r6('"Load"')} AS "Load",
  {r6(f'CASE WHEN count("Load") OVER ({W} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) >= 2 THEN stddev_samp("Load") OVER ({W} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) END')} AS "LoadStd24" FROM h""",
    "sort_series": f'WITH {H} SELECT series, "Timestamp", {r6(q("Load"))} AS "Load" FROM h',
    "topk_first_n": f'WITH {H} SELECT series, "Timestamp", {r6(q("Load"))} AS "Load" FROM h ORDER BY series, "Timestamp" LIMIT 10',
    # samples and metrics
    "smp_hash_fraction": f"""SELECT {EVENTS_COLS} FROM (SELECT *, row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id) - 1 AS rn,
  count(*) OVER () AS n FROM events) WHERE rn < round(n * 0.05)""",
    "smp_random_split": """SELECT event_id, event_type, rn < ceil(n * 0.2) AS is_test FROM (SELECT event_id, event_type,
  row_number() OVER (ORDER BY md5(CAST(event_id AS VARCHAR) || ':42'), event_id) - 1 AS rn, count(*) OVER () AS n FROM events)""",
    "ml_seasonal_naive": f"""WITH {H}, {SNAIVE} SELECT series, "Timestamp", {r6(q("Load"))} AS "Load", {r6("forecast")} AS forecast FROM f""",
    "ml_error_metrics": f"WITH {H}, {SNAIVE} " + _metrics("f", "series"),
    "ml_walk_forward": f"""WITH {H}, {SNAIVE},
ff AS (SELECT f.*, CAST(date_trunc('day', "Timestamp") AS TIMESTAMP) AS fold FROM f),
fb AS (SELECT series, min(fold) AS first_fold FROM ff GROUP BY 1),
sc AS (SELECT ff.* FROM ff JOIN fb USING (series) WHERE fold >= first_fold + INTERVAL 1 DAY) """ + _metrics("sc", "series, fold"),
    # gap filling, exploration, monitoring
    "fill_linear_single": f"""WITH {H}, {GRID},
fl AS (SELECT m.series, m."Timestamp", (p."Load" + n."Load") / 2 AS "Load" FROM m
       JOIN h p ON p.series = m.series AND p."Timestamp" = m."Timestamp" - INTERVAL 1 HOUR
       JOIN h n ON n.series = m.series AND n."Timestamp" = m."Timestamp" + INTERVAL 1 HOUR)
SELECT series, "Timestamp", {r6(q("Load"))} AS "Load", false AS is_filled FROM h
UNION ALL SELECT series, "Timestamp", {r6(q("Load"))} AS "Load", true AS is_filled FROM fl""",
    "fill_pattern": f"""WITH {H}, {GRID},
pr AS (SELECT series, isodow("Timestamp") AS wd, hour("Timestamp") AS hr, avg("Load") AS pl FROM h GROUP BY 1, 2, 3),
fl AS (SELECT m.series, m."Timestamp", pr.pl AS "Load" FROM m JOIN pr
       ON pr.series = m.series AND pr.wd = isodow(m."Timestamp") AND pr.hr = hour(m."Timestamp"))
SELECT series, "Timestamp", {r6(q("Load"))} AS "Load", false AS is_filled FROM h
UNION ALL SELECT series, "Timestamp", {r6(q("Load"))} AS "Load", true AS is_filled FROM fl""",
    "dq_outliers_iqr": f"""WITH {H},
qq AS (SELECT series, quantile_cont("Load", 0.25) AS q1, quantile_cont("Load", 0.75) AS q3 FROM h GROUP BY 1),
fe AS (SELECT series, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM qq)
SELECT h.series, h."Timestamp", {r6('h."Load"')} AS "Load", {r6('lower')} AS lower, {r6('upper')} AS upper
FROM h JOIN fe ON h.series = fe.series WHERE h."Load" < lower OR h."Load" > upper""",
    "eda_seasonality": f"WITH {H} " + union([
        f"""SELECT series, '{p}' AS period, CAST({e} AS INTEGER) AS slot, {r6('avg("Load")')} AS "mean_Load",
  count("Load") AS n FROM h GROUP BY 1, 2, 3""" for p, e in (("hour", 'hour("Timestamp")'), ("weekday", 'isodow("Timestamp")'),
                                                           ("month", 'month("Timestamp")'))]),
    "eda_trend": f"""WITH {H}, x AS (SELECT series, "Load", CAST(date_diff('hour', TIMESTAMP '2000-01-01', "Timestamp") AS DOUBLE) AS x FROM h)
SELECT series, {r6('regr_slope("Load", x) * 24', 4)} AS slope_per_day, {r6('regr_intercept("Load", x)', 4)} AS intercept,
  CAST(regr_count("Load", x) AS BIGINT) AS n FROM x GROUP BY 1""",
    "eda_autocorr": f"WITH {H}, lg AS (SELECT series, \"Load\", {_lag_cols((1, 2, 3, 6, 12, 24))} FROM h) " + union([
        f"SELECT series, {k} AS lag, {r6(f'corr(\"Load\", l{k})')} AS acf FROM lg GROUP BY 1" for k in (1, 2, 3, 6, 12, 24)]),
    "mon_drift": f"""WITH {H},
d AS (SELECT series, CAST(date_trunc('week', "Timestamp") AS TIMESTAMP) AS period, "Load" AS v FROM h WHERE "Load" IS NOT NULL),
f0 AS (SELECT series, min(period) AS ref FROM d GROUP BY 1),
dr AS (SELECT d.*, f0.ref FROM d JOIN f0 ON d.series = f0.series),
rs AS (SELECT series, min(v) AS lo, max(v) AS hi, avg(v) AS ref_mean FROM dr WHERE period = ref GROUP BY 1),
bn AS (SELECT dr.*, rs.ref_mean, CAST(least(greatest(CASE WHEN hi - lo > 0 THEN floor((v - lo) / (hi - lo) * 10) + 1 ELSE 1 END, 1), 10) AS INTEGER) AS bin
       FROM dr JOIN rs ON dr.series = rs.series),
per AS (SELECT series, period, count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std, first(ref_mean) AS ref_mean, first(ref) AS ref
        FROM bn GROUP BY 1, 2),
cnt AS (SELECT series, period, bin, count(*) AS c FROM bn GROUP BY 1, 2, 3),
grid AS (SELECT series, period, n, ref, CAST(unnest(range(1, 11)) AS INTEGER) AS bin FROM per),
sh AS (SELECT grid.series, grid.period, grid.bin, grid.ref, greatest(coalesce(cnt.c, 0) / grid.n, 0.0001) AS share
       FROM grid LEFT JOIN cnt ON grid.series = cnt.series AND grid.period = cnt.period AND grid.bin = cnt.bin),
rsh AS (SELECT series, bin, share AS rshare FROM sh WHERE period = ref),
psi AS (SELECT sh.series, sh.period, sum((share - rshare) * ln(share / rshare)) AS psi FROM sh
        JOIN rsh ON sh.series = rsh.series AND sh.bin = rsh.bin GROUP BY 1, 2)
SELECT per.series, per.period, per.n, {r6('mean', 4)} AS mean, {r6('std', 4)} AS std, {r6('mean - ref_mean', 4)} AS mean_shift,
  {r6('psi.psi', 4)} AS psi FROM per JOIN psi ON per.series = psi.series AND per.period = psi.period""",
    "ml_threshold_search": f"WITH {H}, " + _THRESH.format(side=_thresh_side("hot", "ceil(t / 1.0) - 1", "DESC") + ",\n"
                                                          + _thresh_side("cold", "floor(t / 1.0) + 1", "ASC")) + f"""
SELECT series, flag, threshold, {r6('gain', 3)} AS gain, n_flagged FROM (
  SELECT *, row_number() OVER (PARTITION BY series, flag ORDER BY gain DESC, threshold ASC) AS rk
  FROM (SELECT * FROM hots UNION ALL SELECT * FROM colds)) WHERE rk = 1""",
})

# Feature SQL over another hourly table: rows without a load (03:00 UTC) are gone before the features are built.
_RAW_H = H.replace("h AS (", "h0 AS (", 1) + """,
h AS (SELECT * FROM h0 WHERE hour("Timestamp") <> 3)"""
_RAW_FEATURES = FEATURES_SQL.replace(H, _RAW_H).replace("FROM h WHERE series = 'view'", "FROM h0 WHERE series = 'view'")

# The as-of split: target 7 rows ahead, dates up to 2024-01-25, first 80 % of each series train, their last 10 % validate.
_SPLIT = f"""WITH {H},
t AS (SELECT *, lead("Load", 7) OVER (PARTITION BY series ORDER BY "Timestamp") AS target FROM h),
a AS (SELECT series, "Timestamp" FROM t WHERE target IS NOT NULL AND CAST("Timestamp" AS DATE) <= DATE '2024-01-25'),
n AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY "Timestamp") - 1 AS i, count(*) OVER (PARTITION BY series) AS n FROM a),
p AS (SELECT series, "Timestamp", CASE WHEN i >= floor(n * 0.8) THEN 'test' WHEN i >= floor(floor(n * 0.8) * CAST(0.9 AS DOUBLE)) THEN 'valid' ELSE 'train' END AS part FROM n)
SELECT part, count(*) AS n, min(CAST("Timestamp" AS DATE)) AS first_date, max(CAST("Timestamp" AS DATE)) AS last_date,
  14 AS n_features FROM p GROUP BY part"""

_TEST_ROWS = _SPLIT.replace("SELECT series, \"Timestamp\" FROM t", "SELECT series, \"Timestamp\", target FROM t").replace(
    "p AS (SELECT series, \"Timestamp\", CASE", "p AS (SELECT series, \"Timestamp\", target, CASE").split("SELECT part, count")[0]

_NULL_KEY = """h AS (SELECT CASE WHEN event_type <> 'view' THEN event_type END AS series, date_trunc('hour', ts) AS "Timestamp",
  avg(value) AS "Load" FROM events GROUP BY 1, 2)"""

_REFIT = """s AS (SELECT series, isodow("Timestamp") AS wd, hour("Timestamp") AS hr, CAST("Timestamp" AS DATE) AS fold, "Timestamp", "Load" FROM h),
o AS (SELECT series, min(fold) AS first_fold FROM s GROUP BY 1),
f AS (SELECT s.series, s.fold, s."Load", (SELECT avg(p."Load") FROM s p WHERE p.series = s.series AND p.wd = s.wd AND p.hr = s.hr AND p.fold < s.fold) AS forecast
  FROM s JOIN o USING (series) WHERE s.fold >= o.first_fold + 7) """



def _walk_regression(src: str, time: str, horizons: dict[str, int], group: str) -> str:
    """Every fold's model fitted anew on all earlier rows (two lags and an intercept, by their covariances)."""
    days = ", ".join(f"('{h}', {d})" for h, d in horizons.items())
    det = "(v0 * v1 - c01 * c01)"
    return f"""WITH {src},
z AS MATERIALIZED (SELECT series, horizon, d, {time} AS t, {time} - to_days(d) AS ta, {time} - to_days(d + 7) AS tb, "Load" AS y,
        CAST(floor(date_diff('day', DATE '1970-01-01', CAST({time} AS DATE)) / d) AS INTEGER) AS k FROM h CROSS JOIN (VALUES {days}) v(horizon, d)),
w AS MATERIALIZED (SELECT z.*, a."Load" AS x0 FROM z JOIN h a ON a.series = z.series AND a.{time} = z.ta),
l AS MATERIALIZED (SELECT w.*, b."Load" AS x1 FROM w JOIN h b ON b.series = w.series AND b.{time} = w.tb
      WHERE y IS NOT NULL AND x0 IS NOT NULL AND b."Load" IS NOT NULL),
k AS MATERIALIZED (SELECT DISTINCT series, horizon, k FROM l),
m AS (SELECT k.series, k.horizon, k.k, avg(y) AS my, avg(x0) AS m0, avg(x1) AS m1, var_pop(x0) AS v0, var_pop(x1) AS v1,
        covar_pop(x0, x1) AS c01, covar_pop(x0, y) AS c0, covar_pop(x1, y) AS c1
      FROM k JOIN l p ON p.series = k.series AND p.horizon = k.horizon AND p.k < k.k GROUP BY 1, 2, 3 HAVING count(*) >= 30),
s AS (SELECT l.*, DATE '1970-01-01' + l.k * l.d AS fold,
        my + (c0 * v1 - c1 * c01) / {det} * (x0 - m0) + (c1 * v0 - c0 * c01) / {det} * (x1 - m1) AS p
      FROM l JOIN m ON m.series = l.series AND m.horizon = l.horizon AND m.k = l.k
      WHERE v0 > 0 AND v1 > 0 AND 1 - abs(c01) / sqrt(v0 * v1) > 1e-9),
f AS (SELECT series, horizon, fold, 'forecast' AS model, y AS "Load", p AS forecast FROM s
      UNION ALL SELECT series, horizon, fold, 'naive' AS model, y AS "Load", x0 AS forecast FROM s) """ + _metrics("f", group)


_DAILY_ORDERS = """h AS (SELECT o_orderpriority AS series, CAST(CAST(o_orderdate AS DATE) + INTERVAL 240 MONTH AS DATE) AS "Date",
  sum(o_totalprice) / 1000 AS "Load" FROM orders GROUP BY 1, 2)"""

ORACLES.update({
    "ml_walk_forward_regression": _walk_regression(H, '"Timestamp"', {"day": 1, "week": 7}, "series, horizon, fold, model"),
    "ml_walk_forward_horizons": _walk_regression(_DAILY_ORDERS, '"Date"', {"day": 1, "week": 7, "month": 30}, "series, horizon, model"),
    "pipe_features_raw": _RAW_FEATURES,
    "fcst_split_report": _SPLIT,
    "fcst_rows": _TEST_ROWS + f"SELECT series, \"Timestamp\", {r6('target')} AS \"Load_target\", true AS has_prediction FROM p WHERE part = 'test'",
    "fcst_metrics": _TEST_ROWS + "SELECT count(*) AS n, count(*) FILTER (WHERE target = 0) AS n_zero_actual, true AS mse_ok, true AS rmse_ok, "
                    "true AS mae_ok, true AS mape_ok, true AS rmse_bounded FROM p WHERE part = 'test'",
    "ml_walk_forward_refit": f"WITH {H}, {_REFIT}" + _metrics("f", "series, fold"),
    "smp_split_null_ids": """SELECT event_id, event_type, CASE WHEN event_id % 10 <> 0 THEN event_id END AS maybe_id, rn < ceil(n * 0.2) AS is_test FROM (
  SELECT event_id, event_type, row_number() OVER (ORDER BY md5(CASE WHEN event_id % 10 <> 0 THEN CAST(event_id AS VARCHAR) ELSE chr(92) || 'N' END
    || ':' || CAST(event_id AS VARCHAR) || ':42'), event_id) - 1 AS rn, count(*) OVER () AS n FROM events)""",
    "dq_missing_hours_null_key": f"WITH {_NULL_KEY}, " + GRID.replace("h.series = g.series", "h.series IS NOT DISTINCT FROM g.series")
                                 + ' SELECT series, "Timestamp" FROM m',
    "ml_seasonal_naive_null_key": f"WITH {_NULL_KEY}, " + SNAIVE.replace("p.series = h.series", "p.series IS NOT DISTINCT FROM h.series")
                                  + f""" SELECT series, "Timestamp", {r6(q("Load"))} AS "Load", {r6("forecast")} AS forecast FROM f""",
    "rel_category_average": ORACLES["agg_category_mean"],
    "rel_one_hot": "SELECT count(*) FILTER (WHERE quality = 1) AS n_yes, count(*) FILTER (WHERE quality = 0) AS n_no FROM labels",
    "rel_one_hot_avg": ORACLES["agg_cond_mean"],
    "rel_scatter": f"SELECT {r6('l_quantity')} AS l_quantity, {r6('l_extendedprice')} AS l_extendedprice FROM lineitem WHERE l_quantity IS NOT NULL AND l_extendedprice IS NOT NULL",
})
