"""DuckDB oracle SQL, one statement per registered SQL-expressible query.

Written independently of the Spark code from the same rules (bridge rules in
``salescast.sources.bridge``; table semantics from the operator docstrings).
Money is exact DECIMAL and rounded once, exactly as on the Spark side.
"""

from __future__ import annotations

# -- building blocks (CTE bodies) --------------------------------------------
LINES = """
lines0 AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 4) AS DECIMAL(18,4)) AS amount,
         CAST(l_tax AS DECIMAL(18,2)) AS tax_rate,
         NOT (l_returnflag = 'R' AND l_linestatus = 'F') AND NOT (l_linenumber = 7) AS live
  FROM lineitem
),
lines AS (
  SELECT *,
         CAST(round(amount * tax_rate, 4) AS DECIMAL(18,4)) AS tax,
         CASE WHEN l_quantity >= 5 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) * 0.10 AS DECIMAL(18,4)) END AS tip,
         (l_partkey % 10 = 0) AND NOT (l_suppkey % 5 = 0) AS dfr
  FROM lines0
),
per_order AS (
  SELECT l_orderkey,
         count(*) AS n_checks,
         count(*) FILTER (WHERE live) AS n_live,
         coalesce(sum(amount) FILTER (WHERE live), 0) AS net,
         coalesce(sum(amount + tax) FILTER (WHERE live), 0) AS total,
         coalesce(sum(tax) FILTER (WHERE live), 0) AS tax,
         coalesce(sum(tip) FILTER (WHERE live), 0) AS tip,
         coalesce(sum(CASE WHEN dfr THEN 25.0 END) FILTER (WHERE live), 0) AS deferred
  FROM lines GROUP BY l_orderkey
)"""

FLAT = LINES + """,
landing AS (
  SELECT CAST(strftime(o.o_orderdate, '%Y%m%d') AS BIGINT) AS business_date,
         CAST(o.o_orderkey AS VARCHAR) AS order_guid,
         strftime(o.o_orderdate + to_hours(CAST(11 + o.o_orderkey % 10 AS INTEGER)), '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS opened_date,
         CASE WHEN o.o_orderstatus <> 'O'
              THEN strftime(o.o_orderdate + to_hours(CAST(12 + o.o_orderkey % 10 AS INTEGER)), '%Y-%m-%dT%H:%M:%S.%g') || '+0000' END AS closed_date,
         o.o_orderpriority AS source,
         CASE WHEN o.o_custkey % 10 <> 0 THEN 'do-' || CAST(o.o_custkey % 4 AS VARCHAR) END AS dining_option_guid,
         CASE WHEN o.o_orderkey % 10 <> 0 THEN o.o_custkey % 6 + 1 END AS num_guests,
         CAST(coalesce(p.n_checks, 0) AS BIGINT) AS num_checks,
         CAST(round(coalesce(p.net, 0), 4) AS DOUBLE) AS net_amount,
         CAST(round(coalesce(p.total, 0), 4) AS DOUBLE) AS total_amount,
         CAST(round(coalesce(p.tax, 0), 4) AS DOUBLE) AS tax_amount,
         CAST(round(coalesce(p.tip, 0), 4) AS DOUBLE) AS tip_amount,
         CAST(round(coalesce(p.deferred, 0), 4) AS DOUBLE) AS deferred_amount,
         o.o_orderkey % 17 = 0 AS voided,
         o.o_orderkey % 23 = 0 AS deleted,
         p.n_live AS n_live
  FROM orders o LEFT JOIN per_order p ON o.o_orderkey = p.l_orderkey
),
bronze AS (
  SELECT business_date, order_guid, opened_date, closed_date, source, dining_option_guid,
         CAST(num_guests AS INTEGER) AS num_guests, CAST(num_checks AS INTEGER) AS num_checks,
         net_amount, total_amount, tax_amount, tip_amount, deferred_amount, voided, deleted
  FROM landing
),
stg AS (
  SELECT CAST(business_date AS INTEGER) AS business_date, order_guid,
         CAST(opened_date AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS opened_at,
         source AS order_source, dining_option_guid, num_guests, num_checks,
         net_amount, total_amount, tax_amount, tip_amount, deferred_amount
  FROM bronze WHERE NOT voided AND NOT deleted
),
fct AS (
  SELECT business_date,
         count(*) AS order_count,
         CAST(sum(num_guests) AS BIGINT) AS guest_count,
         CAST(round(sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS net_sales,
         CAST(round(sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS deferred_revenue,
         CAST(round(sum(CAST(total_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS total_sales,
         CAST(round(sum(CAST(tax_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS tax,
         CAST(round(sum(CAST(tip_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS tips
  FROM stg GROUP BY business_date
)"""

LANDING_COLS = """business_date, order_guid, opened_date, closed_date, source, dining_option_guid,
  num_guests, num_checks, net_amount, total_amount, tax_amount, tip_amount, deferred_amount, voided, deleted"""


def with_flat(select: str) -> str:
    """Prefix a statement with the bridge CTEs; a statement that starts with
    ',' contributes further CTEs."""
    return "WITH " + FLAT + ("" if select.lstrip().startswith(",") else "\n") + select


SQL: dict[str, str] = {}

SQL["flatten_orders"] = with_flat(f"SELECT {LANDING_COLS} FROM landing")
SQL["pii_allowlist"] = SQL["flatten_orders"]
SQL["live_checks"] = with_flat(
    "SELECT order_guid, num_checks, CAST(coalesce(n_live, 0) AS BIGINT) AS num_live_checks FROM landing"
)
SQL["order_tips"] = with_flat("SELECT order_guid, tip_amount FROM landing")
SQL["order_deferred"] = with_flat("SELECT order_guid, deferred_amount FROM landing")
SQL["stg_orders"] = with_flat("SELECT * FROM stg")
SQL["live_orders"] = with_flat(
    """SELECT business_date, order_guid, opened_date, closed_date, source, dining_option_guid,
  num_guests, num_checks, net_amount, total_amount, tax_amount, tip_amount, deferred_amount, voided, deleted
  FROM bronze WHERE NOT voided AND NOT deleted"""
)
SQL["fct_daily_sales"] = with_flat("SELECT * FROM fct")
SQL["date_keys"] = with_flat(
    """SELECT CAST(business_date AS BIGINT) AS business_date,
  CAST(strptime(CAST(business_date AS VARCHAR), '%Y%m%d') AS DATE) AS date_day,
  CAST(strftime(CAST(strptime(CAST(business_date AS VARCHAR), '%Y%m%d') AS DATE), '%Y%m%d') AS BIGINT) AS round_trip
  FROM fct"""
)
SQL["local_business_day"] = with_flat(
    """, t AS (SELECT order_guid, (CAST(opened_date AS TIMESTAMPTZ) AT TIME ZONE 'UTC') + to_hours(CAST(CAST(order_guid AS BIGINT) % 24 - 12 AS INTEGER)) AS u FROM landing)
SELECT order_guid, u AS opened_at_utc, (u AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS opened_at_local,
  CAST(strftime((u AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago', '%Y%m%d') AS BIGINT) AS local_business_date
  FROM t"""
)


def all_sql() -> dict[str, str]:
    return dict(SQL)

# -- M2 load ------------------------------------------------------------------
STALE = """,
stale AS (
  SELECT * FROM bronze
  WHERE NOT (business_date % 7 = 0 AND CAST(order_guid AS BIGINT) % 13 = 0)
    AND business_date % 11 <> 0
),
disk_n AS (SELECT business_date, count(*) AS n FROM landing GROUP BY business_date),
bronze_n AS (SELECT business_date, count(*) AS n FROM stale GROUP BY business_date)"""


def with_stale(select: str) -> str:
    return "WITH " + FLAT + STALE + "\n" + select


SQL["cast_projection"] = with_flat("SELECT * FROM bronze")
SQL["day_counts"] = with_flat("SELECT business_date, count(*) AS n FROM bronze GROUP BY business_date")
SQL["landing_day_counts"] = with_flat("SELECT business_date, count(*) AS n FROM landing GROUP BY business_date")
SQL["scan_raw_orders"] = with_flat(f"SELECT {LANDING_COLS} FROM landing")
SQL["read_nested_orders"] = SQL["scan_raw_orders"]
SQL["days_needing_load"] = with_stale(
    """SELECT d.business_date FROM disk_n d LEFT JOIN bronze_n b USING (business_date)
  WHERE b.n IS NULL OR b.n <> d.n
  UNION
  SELECT business_date FROM (SELECT business_date FROM disk_n ORDER BY business_date DESC LIMIT 3)"""
)
SQL["missing_days"] = with_stale(
    "SELECT business_date FROM disk_n WHERE business_date NOT IN (SELECT business_date FROM bronze_n)"
)
SQL["recent_days"] = with_stale("SELECT business_date FROM disk_n ORDER BY business_date DESC LIMIT 3")
SQL["trailing_window"] = with_flat(
    f"""SELECT {LANDING_COLS} FROM landing
  WHERE business_date BETWEEN
    CAST(strftime(CAST(strptime(CAST((SELECT max(business_date) FROM landing) AS VARCHAR), '%Y%m%d') AS DATE) - 7, '%Y%m%d') AS BIGINT)
    AND CAST(strftime(CAST(strptime(CAST((SELECT max(business_date) FROM landing) AS VARCHAR), '%Y%m%d') AS DATE) - 1, '%Y%m%d') AS BIGINT)"""
)
SQL["refresh_landing"] = with_flat(
    """SELECT business_date, order_guid, opened_date, closed_date, source, dining_option_guid, num_guests, num_checks, net_amount, total_amount,
  tax_amount, CASE WHEN business_date >= CAST(strftime(CAST(strptime(CAST((SELECT max(business_date) FROM landing) AS VARCHAR), '%Y%m%d') AS DATE) - 6, '%Y%m%d') AS BIGINT)
    THEN tip_amount ELSE 0.0 END AS tip_amount, deferred_amount, voided, deleted FROM landing"""
)
SQL["rescue_good"] = with_flat(
    f"SELECT {LANDING_COLS} FROM landing WHERE CAST(order_guid AS BIGINT) % 37 <> 0 AND CAST(order_guid AS BIGINT) % 41 <> 0 AND CAST(order_guid AS BIGINT) % 43 <> 0"
)
SQL["rescue_quarantine"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS message_key,
       CASE WHEN o_orderkey % 37 = 0 THEN 'malformed' WHEN o_orderkey % 41 = 0 THEN 'mistyped' ELSE 'missing' END AS reason
FROM orders WHERE o_orderkey % 37 = 0 OR o_orderkey % 41 = 0 OR o_orderkey % 43 = 0"""
SQL["history_bounds"] = with_flat(
    """, b AS (
  SELECT DISTINCT business_date FROM landing
  WHERE business_date IS NOT NULL
)
SELECT min(business_date) AS first_day, max(business_date) AS last_day, count(*) AS days_with_data,
  CAST(date_diff('day', CAST(strptime(CAST(min(business_date) AS VARCHAR), '%Y%m%d') AS DATE),
                 CAST(strptime(CAST(max(business_date) AS VARCHAR), '%Y%m%d') AS DATE)) + 1 AS BIGINT) AS calendar_days
FROM b"""
)
SQL["replace_days"] = with_flat("SELECT * FROM bronze")

# -- M3 forecasting -------------------------------------------------------------
K = "c_mktsegment, n_regionkey"


def _kj(a: str, b: str) -> str:
    return f"{a}.c_mktsegment IS NOT DISTINCT FROM {b}.c_mktsegment AND {a}.n_regionkey IS NOT DISTINCT FROM {b}.n_regionkey"


SERIES = FLAT + f""",
okeys AS (
  SELECT CAST(o.o_orderkey AS VARCHAR) AS order_guid, c.c_mktsegment, n.n_regionkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
),
kstg AS (SELECT k.c_mktsegment, k.n_regionkey, s.* FROM stg s JOIN okeys k USING (order_guid)),
kdaily AS (
  SELECT {K}, business_date,
         CAST(round(sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS net_sales
  FROM kstg
  WHERE business_date IS NOT NULL /*HIST*/
  GROUP BY {K}, business_date
),
ser AS (SELECT {K}, CAST(strptime(CAST(business_date AS VARCHAR), '%Y%m%d') AS DATE) AS ds, CAST(net_sales AS DOUBLE) AS y FROM kdaily),
bounds AS (SELECT {K}, min(ds) AS ds0, max(ds) AS ds1 FROM ser GROUP BY {K}),
cal AS (SELECT {K}, ds0, CAST(unnest(generate_series(ds0, ds1, INTERVAL 1 DAY)) AS DATE) AS ds FROM bounds),
dense AS (
  SELECT c.c_mktsegment, c.n_regionkey, c.ds, coalesce(s.y, 0.0) AS y, c.ds0,
         row_number() OVER (PARTITION BY c.c_mktsegment, c.n_regionkey ORDER BY c.ds) AS rn,
         count(*) OVER (PARTITION BY c.c_mktsegment, c.n_regionkey) AS n
  FROM cal c LEFT JOIN ser s ON {_kj('c', 's')} AND c.ds = s.ds
),
heads AS (SELECT DISTINCT {K}, n, ds0 FROM dense),
origins AS (
  SELECT {K}, CAST(k AS INTEGER) AS fold, n - 14 - (7 - k) * 14 AS cutoff, ds0
  FROM heads, range(0, 8) r(k) WHERE n - 14 - (7 - k) * 14 >= 60
),
allorigins AS (SELECT * FROM origins UNION ALL SELECT {K}, -1 AS fold, n AS cutoff, ds0 FROM heads),
tg AS (
  SELECT o.c_mktsegment, o.n_regionkey, o.fold, o.cutoff, h, o.cutoff + h AS rn,
         CAST(o.ds0 + CAST(o.cutoff + h - 1 AS INTEGER) AS DATE) AS ds
  FROM allorigins o, range(1, 15) t(h)
),
naive AS (
  SELECT tg.c_mktsegment, tg.n_regionkey, tg.fold, tg.ds, d.y AS yhat,
         CAST(NULL AS DOUBLE) AS yhat_lower, CAST(NULL AS DOUBLE) AS yhat_upper, 'baseline' AS model
  FROM tg LEFT JOIN dense d ON {_kj('tg', 'd')}
   AND d.rn = CASE WHEN tg.cutoff >= 7 THEN tg.cutoff - 7 + 1 + (tg.h - 1) % 7 ELSE 1 + ((tg.h - 1) % 7) % tg.cutoff END
),
train AS (
  SELECT o.c_mktsegment, o.n_regionkey, o.fold, o.cutoff, d.rn, d.y, isodow(d.ds) - 1 AS wd
  FROM allorigins o JOIN dense d ON {_kj('o', 'd')} AND d.rn <= o.cutoff
),
fit0 AS (
  SELECT {K}, fold, cutoff, coalesce(regr_slope(y, rn), 0.0) AS b, avg(y) AS my, avg(rn) AS mt
  FROM train GROUP BY {K}, fold, cutoff
),
fit AS (SELECT *, my - b * mt AS a FROM fit0),
sse AS (
  SELECT t.c_mktsegment, t.n_regionkey, t.fold,
         sqrt(greatest(0.0, sum((t.y - f.a - f.b * t.rn) * (t.y - f.a - f.b * t.rn)) / f.cutoff)) AS sigma
  FROM train t JOIN fit f ON {_kj('t', 'f')} AND t.fold = f.fold
  GROUP BY t.c_mktsegment, t.n_regionkey, t.fold, f.cutoff
),
wdst AS (SELECT {K}, fold, wd, count(*) AS n_w, sum(rn) AS st_w, sum(y) AS sy_w FROM train GROUP BY {K}, fold, wd),
trend AS (
  SELECT tg.c_mktsegment, tg.n_regionkey, tg.fold, tg.ds, s.sigma,
         (f.a + f.b * tg.rn) * CASE WHEN f.a * w.n_w + f.b * w.st_w > 0 THEN w.sy_w / (f.a * w.n_w + f.b * w.st_w) ELSE 1.0 END AS raw
  FROM tg JOIN fit f ON {_kj('tg', 'f')} AND tg.fold = f.fold
  JOIN sse s ON {_kj('tg', 's')} AND tg.fold = s.fold
  LEFT JOIN wdst w ON {_kj('tg', 'w')} AND tg.fold = w.fold AND w.wd = isodow(tg.ds) - 1
),
tw AS (
  SELECT {K}, fold, ds, greatest(0.0, raw) AS yhat,
         greatest(0.0, raw - 1.2815515655446004 * sigma) AS yhat_lower,
         greatest(0.0, raw + 1.2815515655446004 * sigma) AS yhat_upper, 'trend_weekday' AS model
  FROM trend
),
preds AS (SELECT * FROM naive UNION ALL SELECT * FROM tw),
bt AS (
  SELECT p.c_mktsegment, p.n_regionkey, p.model, p.fold, p.ds, d.y, p.yhat, p.yhat_lower, p.yhat_upper
  FROM preds p JOIN dense d ON {_kj('p', 'd')} AND d.ds = p.ds WHERE p.fold >= 0
),
metrics AS (
  SELECT {K}, model,
         round(round(avg(abs(y - yhat)), 8), 4) AS mae,
         round(round(sqrt(avg((y - yhat) * (y - yhat))), 8), 4) AS rmse,
         round(round(avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100, 8), 4) AS mape,
         round(round(CASE WHEN sum(abs(y)) <> 0 THEN sum(abs(y - yhat)) / sum(abs(y)) * 100 END, 8), 4) AS wape,
         CAST(14 AS INTEGER) AS horizon, CAST(8 AS INTEGER) AS n_folds,
         TIMESTAMP '2001-08-02 06:00:00' AS run_ts
  FROM bt GROUP BY {K}, model
),
ranked AS (
  SELECT m.*, b.wape AS base_wape,
         row_number() OVER (PARTITION BY m.c_mktsegment, m.n_regionkey
           ORDER BY CASE WHEN b.wape IS NULL AND m.model <> 'baseline' THEN 1 ELSE 0 END,
                    CASE WHEN m.wape IS NULL THEN 1 ELSE 0 END, coalesce(m.wape, 0.0),
                    CASE m.model WHEN 'baseline' THEN 0 WHEN 'trend_weekday' THEN 1 ELSE 99 END) AS r
  FROM metrics m LEFT JOIN (SELECT {K}, wape FROM metrics WHERE model = 'baseline') b ON {_kj('m', 'b')}
),
champ AS (SELECT {K}, model FROM ranked WHERE r = 1),
cfc AS (
  SELECT p.c_mktsegment, p.n_regionkey, p.ds, round(p.yhat, 2) AS yhat, round(p.yhat_lower, 2) AS yhat_lower,
         round(p.yhat_upper, 2) AS yhat_upper, p.model
  FROM preds p JOIN champ c ON {_kj('p', 'c')} AND p.model = c.model WHERE p.fold = -1
)"""


ONE_SERIES = "SELECT CAST(o.o_orderkey AS VARCHAR) AS order_guid, 'all' AS c_mktsegment, 0 AS n_regionkey\n  FROM orders o"


def with_series(select: str, history_before_today: bool = False, one: bool = False, unnamed: str = "") -> str:
    """Bridge + keyed series CTEs; optionally only history before 'today'
    (the latest landed business day), as a nightly forecast would see it; all
    orders as one series; or one market segment without a name."""
    body = SERIES
    if one:
        start, end = body.index("  SELECT CAST(o.o_orderkey AS VARCHAR) AS order_guid, c.c_mktsegment"), body.index("),\nkstg AS")
        body = body[:start] + "  " + ONE_SERIES + "\n" + body[end:]
    if unnamed:
        body = body.replace("AS order_guid, c.c_mktsegment,", f"AS order_guid, nullif(c.c_mktsegment, '{unnamed}') AS c_mktsegment,")
    if history_before_today:
        body = body.replace("/*HIST*/", "AND business_date < (SELECT max(business_date) FROM landing)")
    return "WITH " + body + ("" if select.lstrip().startswith(",") else "\n") + select


SQL["load_daily_series"] = with_series("SELECT ds, y FROM dense", one=True)
SQL["densify_daily"] = with_series(f"SELECT {K}, ds, y FROM dense")
SQL["last_season"] = with_series(f"SELECT {K}, ds, y FROM dense WHERE rn > n - 7")
SQL["seasonal_naive"] = with_series(f"SELECT {K}, ds, yhat FROM naive WHERE fold = -1")
SQL["backtest_naive"] = with_series(f"SELECT {K}, model, fold, ds, y, yhat FROM bt WHERE model = 'baseline'")
for _m in ("mae", "rmse", "mape", "wape"):
    SQL[f"metric_{_m}"] = with_series(f"SELECT {K}, model, {_m} FROM metrics WHERE model = 'baseline'")
SQL["model_metrics"] = with_series("SELECT * FROM metrics")
SQL["champion"] = with_series("SELECT * FROM champ")
SQL["champion_forecast"] = with_series("SELECT * FROM cfc")
SQL["forecast_rows"] = with_series(
    f"""SELECT {K}, CAST(strftime(ds, '%Y%m%d') AS BIGINT) AS forecast_date, yhat, yhat_lower, yhat_upper, model,
  TIMESTAMP '2001-08-02 06:00:00' AS run_ts FROM cfc"""
)
SQL["backtest_rows"] = with_series(
    f"""SELECT {K}, CAST(strftime(ds, '%Y%m%d') AS BIGINT) AS forecast_date, round(yhat, 2) AS yhat, model, fold,
  TIMESTAMP '2001-08-02 06:00:00' AS run_ts FROM bt"""
)
SQL["history_plus_forecast"] = with_series(
    f"""SELECT d.c_mktsegment, d.n_regionkey, d.ds AS date, d.y AS net_sales_actual, CAST(NULL AS DOUBLE) AS yhat,
  CAST(NULL AS DOUBLE) AS yhat_lower, CAST(NULL AS DOUBLE) AS yhat_upper, c.model, false AS is_forecast
FROM dense d LEFT JOIN champ c ON {_kj('d', 'c')}
UNION ALL
SELECT {K}, ds AS date, CAST(NULL AS DOUBLE) AS net_sales_actual, yhat, yhat_lower, yhat_upper, model, true AS is_forecast FROM cfc"""
)
SQL["plugin_forecaster"] = SQL["backtest_naive"]
SQL["trend_weekday_forecast"] = with_series(
    f"SELECT {K}, fold, ds, round(yhat, 2) AS yhat, round(yhat_lower, 2) AS yhat_lower, round(yhat_upper, 2) AS yhat_upper FROM tw WHERE fold = -1"
)
SQL["backtest_trend_weekday"] = with_series(
    f"""SELECT {K}, model, fold, ds, y, round(yhat, 2) AS yhat, round(yhat_lower, 2) AS yhat_lower,
  round(yhat_upper, 2) AS yhat_upper FROM bt WHERE model = 'trend_weekday'"""
)

# -- M4 serving + quality ---------------------------------------------------------
SERVING = f""",
fcr AS (SELECT {K}, CAST(strftime(ds, '%Y%m%d') AS BIGINT) AS forecast_date, yhat, yhat_lower, yhat_upper, model,
               TIMESTAMP '2001-08-02 06:00:00' AS run_ts FROM cfc),
btr AS (SELECT {K}, CAST(strftime(ds, '%Y%m%d') AS BIGINT) AS forecast_date, round(yhat, 2) AS yhat, model, fold FROM bt),
win AS (SELECT {K}, max(model) AS model FROM fcr GROUP BY {K}),
cbt AS (SELECT b.c_mktsegment, b.n_regionkey, b.forecast_date AS business_date, b.yhat FROM btr b JOIN win w ON {_kj('b', 'w')} AND b.model = w.model),
act AS (SELECT {K}, CAST(business_date AS BIGINT) AS business_date, net_sales FROM kdaily),
fj AS (
  SELECT coalesce(a.c_mktsegment, f.c_mktsegment) AS c_mktsegment, coalesce(a.n_regionkey, f.n_regionkey) AS n_regionkey,
         coalesce(a.business_date, f.forecast_date) AS business_date, a.net_sales, a.business_date AS a_bd,
         f.forecast_date AS f_bd, f.yhat AS fy, f.yhat_lower, f.yhat_upper, f.model, f.run_ts
  FROM act a FULL OUTER JOIN fcr f ON {_kj('a', 'f')} AND a.business_date = f.forecast_date
),
fva AS (
  SELECT fj.c_mktsegment, fj.n_regionkey, fj.business_date,
         CAST(strptime(CAST(fj.business_date AS VARCHAR), '%Y%m%d') AS DATE) AS date_day,
         fj.net_sales AS net_sales_actual, coalesce(fj.fy, b.yhat) AS yhat, fj.yhat_lower, fj.yhat_upper, fj.model, fj.run_ts,
         (fj.a_bd IS NULL AND fj.f_bd IS NOT NULL) AS is_forecast,
         CASE WHEN fj.fy IS NOT NULL THEN 'forecast' WHEN b.yhat IS NOT NULL THEN 'backtest' END AS yhat_source
  FROM fj LEFT JOIN cbt b ON {_kj('fj', 'b')} AND fj.business_date = b.business_date
)"""

INTRADAY = f""",
today AS (SELECT max(business_date) AS d FROM landing),
tko AS (
  SELECT k.c_mktsegment, k.n_regionkey, count(*) AS order_count, CAST(sum(b.num_guests) AS BIGINT) AS guest_count,
         CAST(round(sum(CAST(b.net_amount AS DECIMAL(18,4))) - sum(CAST(b.deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS net_sales_so_far,
         max(CAST(b.opened_date AS TIMESTAMPTZ) AT TIME ZONE 'America/Chicago') AS last_order_opened_at
  FROM bronze b JOIN okeys k USING (order_guid)
  WHERE b.business_date = (SELECT d FROM today) AND NOT b.voided AND NOT b.deleted
  GROUP BY k.c_mktsegment, k.n_regionkey
),
anchor AS (SELECT DISTINCT {K}, (SELECT d FROM today) AS business_date FROM heads),
fct_today AS (SELECT * FROM cfc WHERE CAST(strftime(ds, '%Y%m%d') AS BIGINT) = (SELECT d FROM today)),
intraday AS (
  SELECT a.c_mktsegment, a.n_regionkey, a.business_date, coalesce(o.order_count, 0) AS order_count,
         coalesce(o.guest_count, 0) AS guest_count, coalesce(o.net_sales_so_far, 0.0) AS net_sales_so_far,
         o.last_order_opened_at, f.yhat AS forecast_total, f.yhat_lower, f.yhat_upper,
         CASE WHEN f.yhat > 0 THEN round(coalesce(o.net_sales_so_far, 0.0) / f.yhat * 100, 1) END AS pct_of_forecast
  FROM anchor a LEFT JOIN tko o ON {_kj('a', 'o')} LEFT JOIN fct_today f ON {_kj('a', 'f')}
)"""

SQL["forecast_vs_actuals"] = with_series(SERVING + "\nSELECT * FROM fva")
SQL["champion_backtest"] = with_series(SERVING + "\nSELECT * FROM cbt")
SQL["intraday_today"] = with_series(INTRADAY + "\nSELECT * FROM intraday", history_before_today=True)
SQL["hourly_net_sales"] = with_flat(
    """, hourly AS (
  SELECT business_date, CAST(hour(CAST(opened_at AS TIMESTAMPTZ) AT TIME ZONE 'America/Chicago') AS INTEGER) AS hr, count(*) AS order_count,
         sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))) AS net
  FROM (SELECT business_date, opened_at AT TIME ZONE 'UTC' AS opened_at, net_amount, deferred_amount FROM stg) s
  GROUP BY 1, 2
)
SELECT business_date, hr, order_count, CAST(round(net, 2) AS DOUBLE) AS net_sales,
       CAST(round(sum(net) OVER (PARTITION BY business_date ORDER BY hr ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS DOUBLE)
         AS cumulative_net_sales
FROM hourly"""
)
SQL["reconcile"] = with_flat(
    """, src AS (
  SELECT business_date,
         CAST(round(sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS net_sales
  FROM landing WHERE NOT voided GROUP BY business_date
)
SELECT CAST(f.business_date AS BIGINT) AS business_date, f.net_sales AS mart_net_sales, s.net_sales AS source_net_sales,
       round(f.net_sales - s.net_sales, 2) AS diff
FROM fct f JOIN src s ON CAST(f.business_date AS BIGINT) = s.business_date
WHERE abs(f.net_sales - s.net_sales) > 0.01"""
)


SQL["serve_views"] = SQL["forecast_vs_actuals"]
SQL["publish_serving"] = with_series(
    SERVING + """
SELECT coalesce(c_mktsegment, '') AS c_mktsegment, n_regionkey, business_date, coalesce(strftime(date_day, '%Y-%m-%d'), '') AS date_day,
       net_sales_actual, yhat, yhat_lower, yhat_upper, coalesce(model, '') AS model, coalesce(strftime(run_ts, '%Y-%m-%d %H:%M:%S'), '') AS run_ts,
       CASE WHEN is_forecast THEN 'True' WHEN NOT is_forecast THEN 'False' ELSE '' END AS is_forecast, coalesce(yhat_source, '') AS yhat_source
FROM fva"""
)
SQL["published_counts"] = with_series(
    SERVING + "\nSELECT 'forecast_vs_actuals' AS target, count(*) AS n FROM fva UNION ALL SELECT 'model_metrics', count(*) FROM metrics"
)
SQL["null_key_serving"] = with_series(SERVING + "\nSELECT * FROM fva", unnamed="BUILDING")
SQL["intraday_plan"] = with_series(
    INTRADAY + """
SELECT business_date, order_count, guest_count, net_sales_so_far, last_order_opened_at, forecast_total, yhat_lower, yhat_upper, pct_of_forecast
FROM intraday""", history_before_today=True, one=True
)
SQL["build_marts"] = with_flat(
    """, src AS (
  SELECT business_date, CAST(round(sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS net_sales
  FROM landing WHERE NOT voided GROUP BY business_date
)
SELECT 'stg_orders' AS model, 'order_guid' AS "column", 'not_null' AS test, count(*) FILTER (WHERE order_guid IS NULL) AS failures FROM stg
UNION ALL SELECT 'stg_orders', 'business_date', 'not_null', count(*) FILTER (WHERE business_date IS NULL) FROM stg
UNION ALL SELECT 'fct_daily_sales', 'business_date', 'not_null', count(*) FILTER (WHERE business_date IS NULL) FROM fct
UNION ALL SELECT 'fct_daily_sales', 'order_count', 'not_null', count(*) FILTER (WHERE order_count IS NULL) FROM fct
UNION ALL SELECT 'stg_orders', 'order_guid', 'unique', count(*) FROM (SELECT order_guid FROM stg GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'fct_daily_sales', 'business_date', 'unique', count(*) FROM (SELECT business_date FROM fct GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'fct_daily_sales', 'net_sales', 'non_negative', count(*) FROM fct WHERE net_sales < 0
UNION ALL SELECT 'fct_daily_sales', 'net_sales', 'reconcile', count(*) FROM fct f JOIN src s ON f.business_date = s.business_date WHERE abs(f.net_sales - s.net_sales) > 0.01"""
)
SQL["dq_not_null"] = with_series(
    SERVING + """
SELECT 'stg_orders' AS model, 'order_guid' AS "column", CAST(count(*) FILTER (WHERE order_guid IS NULL) AS BIGINT) AS failures FROM stg
UNION ALL SELECT 'stg_orders', 'business_date', CAST(count(*) FILTER (WHERE business_date IS NULL) AS BIGINT) FROM stg
UNION ALL SELECT 'fct_daily_sales', 'business_date', CAST(count(*) FILTER (WHERE business_date IS NULL) AS BIGINT) FROM fct
UNION ALL SELECT 'fct_daily_sales', 'order_count', CAST(count(*) FILTER (WHERE order_count IS NULL) AS BIGINT) FROM fct
UNION ALL SELECT 'forecast_vs_actuals', 'business_date', CAST(count(*) FILTER (WHERE business_date IS NULL) AS BIGINT) FROM fva
UNION ALL SELECT 'forecast_vs_actuals', 'net_sales_actual', CAST(count(*) FILTER (WHERE net_sales_actual IS NULL) AS BIGINT) FROM fva
UNION ALL SELECT 'forecast_vs_actuals', 'yhat', CAST(count(*) FILTER (WHERE yhat IS NULL) AS BIGINT) FROM fva
UNION ALL SELECT 'intraday_today', 'business_date', CAST(count(*) FILTER (WHERE business_date IS NULL) AS BIGINT)
  FROM (""" + SQL["intraday_today"] + ")"
)
SQL["dq_unique"] = with_series(
    SERVING + """
SELECT 'stg_orders' AS model, 'order_guid' AS "column", count(*) AS failures FROM (SELECT order_guid FROM stg GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'fct_daily_sales', 'business_date', count(*) FROM (SELECT business_date FROM fct GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'forecast_vs_actuals', 'c_mktsegment,n_regionkey,business_date', count(*)
  FROM (SELECT c_mktsegment, n_regionkey, business_date FROM fva GROUP BY 1, 2, 3 HAVING count(*) > 1)
UNION ALL SELECT 'order_versions', 'order_guid', count(*) FROM (
  SELECT order_guid FROM (SELECT order_guid FROM landing UNION ALL SELECT order_guid FROM landing WHERE CAST(order_guid AS BIGINT) % 11 = 0)
  GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'intraday_today', 'c_mktsegment,n_regionkey,business_date', count(*)
  FROM (SELECT c_mktsegment, n_regionkey, business_date FROM (""" + SQL["intraday_today"] + ") GROUP BY 1, 2, 3 HAVING count(*) > 1)"
)
SQL["dq_non_negative"] = with_series(f"SELECT {K}, business_date, net_sales FROM kdaily WHERE net_sales < 0")
SQL["dq_no_fanout"] = with_series(
    SERVING + f"""
, s AS (SELECT {K}, count(*) AS serving_rows FROM fva GROUP BY {K}),
m AS (SELECT {K}, count(*) AS mart_rows FROM kdaily GROUP BY {K})
SELECT coalesce(s.c_mktsegment, m.c_mktsegment) AS c_mktsegment, coalesce(s.n_regionkey, m.n_regionkey) AS n_regionkey,
       coalesce(s.serving_rows, 0) AS serving_rows, coalesce(m.mart_rows, 0) AS mart_rows,
       coalesce(s.serving_rows, 0) = coalesce(m.mart_rows, 0) + 14 AS ok
FROM s FULL OUTER JOIN m ON {_kj('s', 'm')}"""
)


def _bad(column: str, type_: str) -> str:
    return f"count(*) FILTER (WHERE {column} IS NOT NULL AND TRY_CAST({column} AS {type_}) IS NULL) AS bad_{column}"


SQL["drift_audit"] = with_flat(
    f""", texts AS (
  SELECT CASE WHEN CAST(order_guid AS BIGINT) % 83 = 0 THEN 'unknown' ELSE CAST(business_date AS VARCHAR) END AS business_date,
         CASE WHEN CAST(order_guid AS BIGINT) % 97 = 0 THEN 'two' ELSE CAST(num_guests AS VARCHAR) END AS num_guests,
         CASE WHEN CAST(order_guid AS BIGINT) % 89 = 0 THEN 'maybe' ELSE CAST(voided AS VARCHAR) END AS voided,
         CASE WHEN CAST(order_guid AS BIGINT) % 101 = 0 THEN '?' ELSE CAST(deleted AS VARCHAR) END AS deleted
  FROM landing
)
SELECT count(*) AS "rows", count(DISTINCT business_date) AS days, {_bad('business_date', 'BIGINT')}, {_bad('num_guests', 'BIGINT')},
  {_bad('voided', 'BOOLEAN')}, {_bad('deleted', 'BOOLEAN')} FROM texts"""
)
SQL["parity_by_day"] = with_stale(
    """, ln AS (
  SELECT business_date, CAST(round(sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS v
  FROM landing WHERE NOT voided AND NOT deleted GROUP BY 1
),
bn AS (
  SELECT business_date, CAST(round(sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS v
  FROM stale WHERE NOT voided AND NOT deleted GROUP BY 1
)
SELECT coalesce(l.business_date, b.business_date) AS business_date, l.v AS left_value, b.v AS right_value,
       round(coalesce(l.v, 0.0) - coalesce(b.v, 0.0), 2) AS diff
FROM ln l FULL OUTER JOIN bn b ON l.business_date = b.business_date
WHERE l.v IS NULL OR b.v IS NULL OR round(coalesce(l.v, 0.0) - coalesce(b.v, 0.0), 2) <> 0"""
)

# -- M5 regression family -------------------------------------------------------
SQL["fourier_features"] = with_series(
    "SELECT DISTINCT ds, "
    + ", ".join(
        f"round({fn}(2 * pi() * {k} / 365.25 * CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE)), 9) AS {fn}{k}"
        for k in (1, 2, 3) for fn in ("sin", "cos")
    )
    + " FROM dense"
)
_YEARS = "SELECT unnest(range(CAST(year((SELECT min(ds) FROM dense)) AS BIGINT), CAST(year((SELECT max(ds) FROM dense) + 14) AS BIGINT) + 2)) AS y"
_LAST = "(SELECT max(y) - 1 FROM yrs)"


def _nth(m: int, wd_iso: int, n: int) -> str:
    first = f"make_date(CAST(y AS INTEGER), {m}, 1)"
    if n > 0:
        return f"CAST({first} + CAST((({wd_iso} - isodow({first}) + 7) % 7) + 7 * {n - 1} AS INTEGER) AS DATE)"
    last = f"CAST(last_day({first}) AS DATE)"
    return f"CAST({last} - CAST(((isodow({last}) - {wd_iso} + 7) % 7) AS INTEGER) AS DATE)"


_FIXED = [(1, 1, "New Year''s Day", 0), (6, 19, "Juneteenth National Independence Day", 2021), (7, 4, "Independence Day", 0),
          (11, 11, "Veterans Day", 1938), (12, 25, "Christmas Day", 0)]
_HOL = [f"SELECT make_date(CAST(y AS INTEGER), {m}, {d}) AS ds, '{n}' AS holiday FROM yrs WHERE y >= {s}" for m, d, n, s in _FIXED]
_HOL += [
    f"SELECT CAST(x.ds + CASE isodow(x.ds) WHEN 6 THEN -1 ELSE 1 END AS DATE), '{n} (observed)' "
    f"FROM (SELECT make_date(CAST(y AS INTEGER), {m}, {d}) AS ds FROM yrs WHERE y >= {s}) x WHERE isodow(x.ds) >= 6"
    for m, d, n, s in _FIXED
]
_HOL += [
    f"SELECT {_nth(m, w, k)}, '{n}' FROM yrs"
    for m, w, k, n in [(1, 1, 3, "Martin Luther King Jr. Day"), (2, 1, 3, "Washington''s Birthday"), (5, 1, -1, "Memorial Day"),
                       (9, 1, 1, "Labor Day"), (10, 1, 2, "Columbus Day"), (11, 4, 4, "Thanksgiving")]
]
SQL["holiday_calendar"] = with_series(
    f", yrs AS ({_YEARS}), hol AS ({chr(10).join([' UNION ALL '.join(_HOL)])}) SELECT ds, holiday FROM hol WHERE year(ds) <= {_LAST}"
)
SQL["trend_fit"] = with_series(
    f"SELECT {K}, round(regr_slope(y, rn), 6) AS slope, round(regr_intercept(y, rn), 4) AS intercept, count(*) AS n FROM dense GROUP BY {K}"
)
SQL["weekday_index"] = with_series(
    f""", tf AS (SELECT {K}, regr_slope(y, rn) AS slope, regr_intercept(y, rn) AS intercept FROM dense GROUP BY {K})
SELECT d.c_mktsegment, d.n_regionkey, CAST(isodow(d.ds) - 1 AS INTEGER) AS wd,
       round(avg(d.y) / avg(t.intercept + t.slope * d.rn), 6) AS "index"
FROM dense d JOIN tf t ON {_kj('d', 't')}
GROUP BY d.c_mktsegment, d.n_regionkey, isodow(d.ds)"""
)

# -- M6 edits, conform, streaming ------------------------------------------------------
SQL["late_edits"] = with_flat(
    """SELECT business_date, order_guid, opened_date, closed_date, source, dining_option_guid, num_guests, num_checks,
  net_amount, total_amount, tax_amount,
  CASE WHEN CAST(order_guid AS BIGINT) % 11 = 0 THEN round(tip_amount + 1.0, 4) ELSE tip_amount END AS tip_amount,
  deferred_amount, voided, deleted,
  CAST(CASE WHEN CAST(order_guid AS BIGINT) % 11 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version
FROM landing"""
)
SQL["safe_cast"] = SQL["scan_raw_orders"]
SQL["conform_archive"] = SQL["scan_raw_orders"]
SQL["drift_report"] = with_flat("SELECT DISTINCT business_date, 'num_guests,num_checks' AS drifted FROM landing WHERE business_date % 10 = 3")
SQL["stream_bronze"] = with_flat(
    """SELECT business_date, order_guid, opened_date, closed_date, source, dining_option_guid, num_guests, num_checks,
  net_amount, total_amount, tax_amount,
  CASE WHEN CAST(order_guid AS BIGINT) % 11 = 0 AND n_live > 0 THEN CAST(round(CAST(tip_amount AS DECIMAL(18,4)) + 1.0, 4) AS DOUBLE)
       ELSE tip_amount END AS tip_amount,
  deferred_amount, voided, deleted,
  CAST(CASE WHEN CAST(order_guid AS BIGINT) % 11 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version
FROM (SELECT b.*, l.n_live FROM bronze b JOIN landing l USING (order_guid))"""
)
SQL["stream_today"] = with_flat(
    """SELECT business_date, count(*) AS order_count, CAST(sum(num_guests) AS BIGINT) AS guest_count,
  CAST(round(sum(CAST(net_amount AS DECIMAL(18,4))) - sum(CAST(deferred_amount AS DECIMAL(18,4))), 2) AS DOUBLE) AS net_sales_so_far,
  max(CAST(opened_date AS TIMESTAMPTZ) AT TIME ZONE 'America/Chicago') AS last_order_opened_at
FROM landing WHERE NOT voided AND NOT deleted GROUP BY business_date"""
)

# -- E6 and table writers -------------------------------------------------------------
SQL["clip_nonnegative"] = SQL["trend_weekday_forecast"]
SQL["write_latest"] = SQL["forecast_rows"]
SQL["write_backtest"] = SQL["backtest_rows"]
SQL["append_history"] = with_series(
    "SELECT * FROM metrics UNION ALL SELECT * REPLACE (run_ts + INTERVAL 1 DAY AS run_ts) FROM metrics"
)
SQL["export_csv"] = with_series("SELECT * FROM metrics")

# -- B8: what the documents of the bridge hold, counted from the tables ---------------
# (path, type, number of values in terms of the counts below, least and greatest list length)
_DOCUMENT = [
    ("guid", "str", "orders"), ("businessDate", "int", "orders"), ("numberOfGuests", "int", "guests"), ("openedDate", "str", "orders"),
    ("closedDate", "str", "closed"), ("source", "str", "sources"), ("voided", "bool", "orders"), ("deleted", "bool", "orders"),
    ("diningOption", "dict", "dining"), ("diningOption.guid", "str", "dining"), ("diningOption.entityType", "str", "dining"),
    ("deliveryInfo", "dict", "orders"), ("deliveryInfo.address1", "str", "orders"), ("deliveryInfo.city", "str", "orders"),
    ("deliveryInfo.zipCode", "str", "orders"), ("checks", "list", "with_checks", "least_checks", "most_checks"), ("checks[]", "dict", "lines"),
    *[(f"checks[].{k}", t, "lines") for k, t in [("guid", "str"), ("amount", "float"), ("totalAmount", "float"), ("taxAmount", "float"),
                                                 ("voided", "bool"), ("deleted", "bool"), ("customer", "dict")]],
    *[(f"checks[].customer.{k}", "str", "lines") for k in ("guid", "email", "firstName", "lastName", "phone")],
    ("checks[].payments", "list", "lines", "1", "1"), ("checks[].payments[]", "dict", "lines"), ("checks[].payments[].tipAmount", "float", "tips"),
    *[(f"checks[].payments[].{k}", t, "lines") for k, t in [("guid", "str"), ("amount", "float"), ("type", "str"), ("last4Digits", "str")]],
    ("checks[].selections", "list", "lines", "2", "2"), ("checks[].selections[]", "dict", "2 * lines"),
    *[(f"checks[].selections[].{k}", t, "2 * lines") for k, t in [("guid", "str"), ("displayName", "str"), ("quantity", "float"), ("price", "float"),
                                                                  ("deferred", "bool"), ("voided", "bool")]],
]
SQL["json_profile"] = """
WITH o AS (
  SELECT count(*) AS orders, count(*) FILTER (WHERE o_orderkey % 10 <> 0) AS guests, count(*) FILTER (WHERE o_orderstatus <> 'O') AS closed,
         count(o_orderpriority) AS sources, count(*) FILTER (WHERE o_custkey % 10 <> 0) AS dining FROM orders
), per AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY 1),
l AS (SELECT count(*) AS lines, count(*) FILTER (WHERE l_quantity >= 5) AS tips FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
p AS (SELECT count(*) AS with_checks, min(n) AS least_checks, max(n) AS most_checks FROM per),
c AS (SELECT * FROM o, l, p)
""" + " UNION ALL ".join(
    f"SELECT '{path}' AS path, '{kind}' AS type, CAST({n} AS BIGINT) AS n, CAST({lengths[0] if lengths else 'NULL'} AS INTEGER) AS min_length, "
    f"CAST({lengths[1] if lengths else 'NULL'} AS INTEGER) AS max_length FROM c WHERE {n} > 0"
    for path, kind, n, *lengths in _DOCUMENT
)
