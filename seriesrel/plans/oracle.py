"""Independent SQL twins of the catalogue queries (DuckDB dialect).

Each string runs on the driver tables registered as views. Doubles are
rounded to 6 places (``+ 0.0`` folds -0.0 into 0.0), counts are BIGINT, and
divisions are guarded with ``CASE`` because DuckDB returns inf/NaN where
Spark returns NULL.
"""

from __future__ import annotations

from ..config import WINDOWS

R = 6


def rnd(expr: str, alias: str) -> str:
    return f"round({expr}, {R}) + 0.0 AS {alias}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- fixtures --
LEAD = """lead AS (
  SELECT l_returnflag AS symbol, CAST(l_shipdate AS DATE) AS date,
         max(l_extendedprice) AS price
  FROM lineitem GROUP BY 1, 2)"""

REF = """ref AS (
  SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS rate
  FROM orders GROUP BY 1)"""

IS_HISTORY = """o_orderpriority < '4' AND CAST(o_orderdate AS DATE) <=
    (SELECT min(CAST(o_orderdate AS DATE)) + CAST(floor(0.7 * (max(CAST(o_orderdate AS DATE)) - min(CAST(o_orderdate AS DATE)))) AS INT) FROM orders)"""

RECENT = """recent AS (
  SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS rate
  FROM orders WHERE NOT (IS_HISTORY) GROUP BY 1)""".replace("IS_HISTORY", IS_HISTORY)

WS = "PARTITION BY symbol ORDER BY date"
RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

FILLED = f"""filled AS (
  SELECT l.symbol, l.date, l.price AS lead_price, r.rate AS ref_observed,
         last_value(r.rate IGNORE NULLS) OVER (PARTITION BY l.symbol ORDER BY l.date {RUN}) AS ref_rate
  FROM lead l LEFT JOIN ref r ON l.date = r.date)"""

RETURNS = f"""lagged AS (
  SELECT *, lag(lead_price) OVER ({WS}) AS lp, lag(ref_rate) OVER ({WS}) AS rp FROM filled),
rets AS (
  SELECT symbol, date, '1d' AS horizon, lead_price, CAST(0 AS SMALLINT) AS lead_quality,
         ref_rate, CAST(0 AS SMALLINT) AS ref_quality,
         CASE WHEN lp <> 0 AND lead_price / lp > 0 THEN ln(lead_price / lp) END AS lead_logret,
         CASE WHEN rp <> 0 AND ref_rate / rp > 0 THEN ln(ref_rate / rp) END AS ref_logret
  FROM lagged)"""

BARS = """bars AS (
  SELECT * FROM rets WHERE lead_logret IS NOT NULL AND ref_logret IS NOT NULL)"""

BAR_CTES = (LEAD, REF, FILLED, RETURNS, BARS)


def _metric_wide_cte() -> str:
    cols = []
    for h, n in WINDOWS.items():
        fr = f"(PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        mp = n // 2
        cnt = f"count(*) OVER {fr}"
        cov = f"covar_samp(ref_logret, lead_logret) OVER {fr}"
        sd_l = f"stddev_samp(lead_logret) OVER {fr}"
        sd_r = f"stddev_samp(ref_logret) OVER {fr}"
        var_l = f"var_samp(lead_logret) OVER {fr}"
        sp = "(lead_logret - ref_logret)"
        sp_m = f"avg{sp} OVER {fr}"
        sp_s = f"stddev_samp{sp} OVER {fr}"
        cols += [
            f"CASE WHEN {cnt} >= {mp} AND {sd_l} * {sd_r} <> 0 "
            f"THEN {cov} / ({sd_l} * {sd_r}) END AS pearson_corr_{h}",
            f"CASE WHEN {cnt} >= {mp} AND {var_l} <> 0 THEN {cov} / {var_l} END AS beta_{h}",
            f"CASE WHEN {cnt} >= {mp} AND {sp_s} <> 0 THEN ({sp} - {sp_m}) / {sp_s} END "
            f"AS spread_zscore_{h}",
        ]
    return "mw AS (\n  SELECT symbol, date,\n    " + ",\n    ".join(cols) + "\n  FROM bars)"


MW = _metric_wide_cte()


def _metric_long_cte() -> str:
    parts = []
    for h in WINDOWS:
        for m in ("pearson_corr", "beta", "spread_zscore"):
            parts.append(f"SELECT symbol, date, '{h}' AS horizon, '{m}' AS metric, "
                         f"{m}_{h} AS value FROM mw")
    return "ml AS (\n  SELECT * FROM (\n  " + "\n  UNION ALL ".join(parts) + \
        ") WHERE value IS NOT NULL)"


ML = _metric_long_cte()
METRIC_CTES = (*BAR_CTES, MW, ML)

SK = "PARTITION BY symbol, horizon ORDER BY date"
ACC = f"""zs AS (
  SELECT symbol, horizon, date, value FROM ml WHERE metric = 'spread_zscore'),
steps AS (
  SELECT *, CASE WHEN row_number() OVER ({SK}) = 1 THEN 0.0 ELSE abs(value) - 1.5 END AS step FROM zs),
psum AS (
  SELECT *, sum(step) OVER ({SK} {RUN}) AS p FROM steps),
acc AS (
  SELECT symbol, horizon, date, value, p - least(0.0, min(p) OVER ({SK} {RUN})) AS cusum FROM psum)"""

ALERTS = f"""marks AS (
  SELECT *, CASE WHEN cusum >= 4.0 THEN 1 WHEN cusum < 1.5 THEN 0 END AS mark FROM acc),
prevs AS (
  SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER
      ({SK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prev FROM marks),
alerts AS (
  SELECT CAST(date AS TIMESTAMP) AS fired_at, CAST(NULL AS TIMESTAMP) AS resolved_at,
         'cusum_zscore_breach' AS kind, 'warning' AS severity, symbol, horizon,
         printf('CUSUM accumulator reached %.2f on spread_zscore', cusum) AS description,
         CAST(NULL AS VARCHAR) AS payload
  FROM prevs WHERE mark = 1 AND prev = 0)"""

ALERT_CTES = (*METRIC_CTES, ACC, ALERTS)

BAR_SELECT = ("symbol, date, horizon, " + rnd("lead_price", "lead_price") +
              ", lead_quality, " + rnd("ref_rate", "ref_rate") + ", ref_quality, " +
              rnd("lead_logret", "lead_logret") + ", " + rnd("ref_logret", "ref_logret"))


def _wide_select(metric: str) -> str:
    return "symbol, date, " + ", ".join(rnd(f"{metric}_{h}", f"{metric}_{h}") for h in WINDOWS)


SQL: dict[str, str] = {
    "aligned_bars": with_(*BAR_CTES) + f"SELECT {BAR_SELECT} FROM bars",
    "forward_fill": with_(LEAD, REF, FILLED) +
        "SELECT symbol, date, " + rnd("lead_price", "lead_price") + ", " +
        rnd("ref_observed", "ref_observed") + ", " + rnd("ref_rate", "ref_rate") + " FROM filled",
    "log_returns": with_(LEAD, REF, FILLED, RETURNS) +
        "SELECT symbol, date, " + rnd("lead_logret", "lead_logret") + ", " +
        rnd("ref_logret", "ref_logret") + " FROM rets",
    "rolling_corr": with_(*BAR_CTES, MW) + f"SELECT {_wide_select('pearson_corr')} FROM mw",
    "rolling_beta": with_(*BAR_CTES, MW) + f"SELECT {_wide_select('beta')} FROM mw",
    "rolling_spread_zscore": with_(*BAR_CTES, MW) +
        f"SELECT {_wide_select('spread_zscore')} FROM mw",
    "metrics_long": with_(*METRIC_CTES) +
        "SELECT symbol, date, horizon, metric, " + rnd("value", "value") + " FROM ml",
    "metric_summary": with_(*METRIC_CTES) +
        "SELECT metric, symbol, horizon, " + rnd("avg(value)", "avg_value") + ", " +
        rnd("min(value)", "min_value") + ", " + rnd("max(value)", "max_value") +
        ", count(*) AS n_rows FROM ml GROUP BY GROUPING SETS "
        "((metric, symbol, horizon), (metric, symbol), (metric, horizon), (metric))",
    "anomaly_share": with_(*METRIC_CTES) +
        "SELECT symbol, horizon, " +
        rnd("avg(CASE WHEN abs(value) > 2.5 THEN 1.0 ELSE 0.0 END)", "anomalous_share") +
        ", CAST(sum(CASE WHEN abs(value) > 2.5 THEN 1 ELSE 0 END) AS BIGINT) AS n_anomalous"
        ", count(*) AS n_rows FROM ml WHERE metric = 'spread_zscore' GROUP BY symbol, horizon",
    "cusum_accumulator": with_(*METRIC_CTES, ACC) +
        "SELECT symbol, horizon, date, " + rnd("value", "value") + ", " +
        rnd("cusum", "cusum") + " FROM acc",
    "cusum_alerts": with_(*ALERT_CTES) + "SELECT * FROM alerts",
    "alert_counts_by_year": with_(*ALERT_CTES) +
        "SELECT CAST(year(fired_at) AS INTEGER) AS year, kind, count(*) AS n_alerts "
        "FROM alerts GROUP BY 1, 2",
}

# ---------------------------------------------------------------- features --
PIVOT_NAMES = [f"{m}_{h}" for m in ("pearson_corr", "beta", "spread_zscore") for h in WINDOWS]

FW = "fw AS (\n  SELECT symbol, date,\n    " + ",\n    ".join(
    f"avg(CASE WHEN metric || '_' || horizon = '{c}' THEN value END) AS {c}" for c in PIVOT_NAMES
) + "\n  FROM ml GROUP BY symbol, date)"

FEAT = f"""fj AS (
  SELECT b.symbol, b.date, b.lead_logret, b.ref_logret, {', '.join('fw.' + c for c in PIVOT_NAMES)}
  FROM bars b JOIN fw ON b.symbol = fw.symbol AND b.date = fw.date),
fl AS (
  SELECT *, lag(spread_zscore_30d, 1) OVER ({WS}) AS zscore_30d_lag1,
         lag(spread_zscore_30d, 2) OVER ({WS}) AS zscore_30d_lag2,
         spread_zscore_30d - lag(spread_zscore_30d, 1) OVER ({WS}) AS zscore_momentum,
         lead(spread_zscore_30d, 1) OVER ({WS}) AS target_zscore
  FROM fj),
feat AS (
  SELECT *, CAST(abs(target_zscore) > 2.5 AS INTEGER) AS target_anomaly FROM fl
  WHERE {' AND '.join(c + ' IS NOT NULL' for c in ['lead_logret', 'ref_logret', *PIVOT_NAMES, 'zscore_30d_lag1', 'zscore_30d_lag2', 'zscore_momentum', 'target_zscore'])})"""

FOLDS = f"""fr AS (
  SELECT *, CAST(row_number() OVER ({WS}) - 1 AS BIGINT) AS row_index,
         count(*) OVER (PARTITION BY symbol) AS n_ FROM feat),
fk AS (
  SELECT fr.*, k.fold,
         CASE WHEN row_index < n_ - (3 - k.fold) * (n_ // 4) THEN 'train'
              WHEN row_index < n_ - (3 - k.fold) * (n_ // 4) + (n_ // 4) THEN 'test' END AS role
  FROM fr, (VALUES (0), (1), (2)) k(fold)),
folded AS (SELECT * EXCLUDE (n_) FROM fk WHERE role IS NOT NULL)"""

FEATURE_CTES = (*METRIC_CTES, FW, FEAT)
FOLD_CTES = (*FEATURE_CTES, FOLDS)

FEATURE_SELECT = "symbol, date, " + ", ".join(
    rnd(c, c) for c in ["lead_logret", "ref_logret", *PIVOT_NAMES, "zscore_30d_lag1",
                        "zscore_30d_lag2", "zscore_momentum", "target_zscore"]) + ", target_anomaly"


def _report_sql(pred_expr: str) -> str:
    def ratio(a, b):
        return f"CASE WHEN ({b}) > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END"
    rows = []
    p0, r0, f0 = ratio("tn1", "tn1 + fn1"), ratio("tn1", "s0"), ratio("2 * tn1", "2 * tn1 + fn1 + fp1")
    p1, r1, f1 = ratio("tp1", "tp1 + fp1"), ratio("tp1", "s1"), ratio("2 * tp1", "2 * tp1 + fp1 + fn1")
    acc = ratio("tp1 + tn1", "s0 + s1")
    w = lambda a, b: ratio(f"({a}) * s0 + ({b}) * s1", "s0 + s1")
    spec = [("normal", p0, r0, f0, "s0"), ("anomalous", p1, r1, f1, "s1"),
            ("accuracy", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", acc, "s0 + s1"),
            ("macro avg", f"(({p0}) + ({p1})) / 2", f"(({r0}) + ({r1})) / 2", f"(({f0}) + ({f1})) / 2", "s0 + s1"),
            ("weighted avg", w(p0, p1), w(r0, r1), w(f0, f1), "s0 + s1")]
    for name, p, r, f, s in spec:
        rows.append(f"SELECT symbol, '{name}' AS label, {rnd(p, 'precision')}, {rnd(r, 'recall')}, "
                    f"{rnd(f, 'f1_score')}, CAST({s} AS BIGINT) AS support FROM cm")
    return with_(*FOLD_CTES, f"""lf AS (
  SELECT symbol, target_anomaly AS y, {pred_expr} AS p FROM folded WHERE fold = 2 AND role = 'test')""",
        """cn AS (
  SELECT symbol, sum(CASE WHEN y = 1 AND p = 1 THEN 1 ELSE 0 END) AS tp1,
         sum(CASE WHEN y = 0 AND p = 1 THEN 1 ELSE 0 END) AS fp1,
         sum(CASE WHEN y = 1 AND p = 0 THEN 1 ELSE 0 END) AS fn1,
         sum(CASE WHEN y = 0 AND p = 0 THEN 1 ELSE 0 END) AS tn1 FROM lf GROUP BY symbol)""",
        "cm AS (SELECT *, tp1 + fn1 AS s1, tn1 + fp1 AS s0 FROM cn)") + \
        "\nUNION ALL ".join(rows)


SQL.update({
    "features_wide": with_(*METRIC_CTES, FW) + "SELECT symbol, date, " +
        ", ".join(rnd(c, c) for c in PIVOT_NAMES) + " FROM fw",
    "features_lagged": with_(*FEATURE_CTES) + f"SELECT {FEATURE_SELECT} FROM feat",
    "features_joined": with_(*FEATURE_CTES) + f"SELECT {FEATURE_SELECT} FROM feat",
    "sample_count": with_(*FEATURE_CTES) + "SELECT symbol, count(*) AS n_samples FROM feat GROUP BY symbol",
    "time_folds": with_(*FOLD_CTES) + "SELECT symbol, date, row_index, fold, role FROM folded",
    "class_weights": with_(*FEATURE_CTES,
        "cc AS (SELECT symbol, target_anomaly, count(*) AS n_class FROM feat GROUP BY 1, 2)") +
        "SELECT symbol, target_anomaly, n_class, " +
        rnd("sum(n_class) OVER (PARTITION BY symbol) / (count(*) OVER (PARTITION BY symbol) * n_class)", "weight") +
        " FROM cc",
    "mae_by_fold": with_(*FOLD_CTES) +
        "SELECT symbol, fold, count(*) AS n_test, " +
        rnd("avg(abs(target_zscore - spread_zscore_30d))", "mae") + ", " +
        rnd("avg(avg(abs(target_zscore - spread_zscore_30d))) OVER (PARTITION BY symbol)", "mae_mean") +
        " FROM folded WHERE role = 'test' GROUP BY symbol, fold",
    "classification_report": _report_sql("CAST(abs(spread_zscore_30d) > 2.5 AS INTEGER)"),
})

# ------------------------------------------------------------------ ingest --
EV = """fields AS (
  SELECT event_id, event_type AS instrument_id, ts AS event_time_utc, value,
         ts + to_seconds(CASE WHEN event_id % 11 = 3 THEN -60 ELSE event_id % 7 END) AS ingest_time_utc,
         CASE WHEN event_id % 23 = 3 THEN NULL WHEN event_id % 17 = 2 THEN 0 ELSE 1 END AS sent_version,
         CASE WHEN event_id % 13 = 5 THEN '' ELSE 'events' END AS source,
         CASE WHEN event_id % 19 = 1 THEN NULL ELSE CAST(event_id % 5 AS INTEGER) END AS sent_flag FROM events),
checked AS (
  SELECT *, coalesce(sent_flag, 0) AS quality_flag,
         concat_ws(',', CASE WHEN coalesce(sent_version, 1) < 1 THEN 'schema_version_invalid' END,
                   CASE WHEN source = '' THEN 'source_empty' END,
                   CASE WHEN coalesce(sent_flag, 0) NOT BETWEEN 0 AND 3 THEN 'quality_flag_invalid' END,
                   CASE WHEN event_time_utc > ingest_time_utc THEN 'event_after_ingest' END) AS reasons FROM fields),
ev AS (SELECT *, reasons = '' AS is_valid FROM checked)"""
LEAD_TYPES = "('click', 'view', 'purchase')"

SQL.update({
    "envelope_decode": with_(EV) +
        "SELECT event_id, sent_version AS schema_version, source, instrument_id, event_time_utc, "
        "ingest_time_utc, sent_flag AS quality_flag, "
        "CASE WHEN instrument_id <> 'signup' THEN round(value, 6) + 0.0 END AS price, "
        "CASE WHEN instrument_id = 'signup' THEN round(value, 6) + 0.0 END AS rate FROM ev",
    "envelope_validate": with_(EV) +
        "SELECT event_id, instrument_id, is_valid, reasons FROM ev",
    "envelope_quarantine": with_(EV) +
        "SELECT event_id, reasons FROM ev WHERE NOT is_valid",
    "route_lead": with_(EV) +
        "SELECT event_id, event_time_utc, instrument_id, round(value, 6) + 0.0 AS price, "
        "'events' AS source, CAST(quality_flag AS SMALLINT) AS quality_flag, ingest_time_utc "
        f"FROM ev WHERE is_valid AND instrument_id IN {LEAD_TYPES}",
    "route_reference": with_(EV) +
        "SELECT event_id, event_time_utc, instrument_id, round(value, 6) + 0.0 AS rate, "
        "'events' AS source, CAST(quality_flag AS SMALLINT) AS quality_flag, ingest_time_utc "
        "FROM ev WHERE is_valid AND instrument_id = 'signup'",
    "ingest_lag": with_(EV) +
        "SELECT instrument_id, count(*) AS n_messages, "
        "round(avg((epoch_us(ingest_time_utc) - epoch_us(event_time_utc)) / 1e6), 6) + 0.0 AS avg_lag_s, "
        "round(max((epoch_us(ingest_time_utc) - epoch_us(event_time_utc)) / 1e6), 6) + 0.0 AS max_lag_s "
        "FROM ev WHERE is_valid GROUP BY instrument_id",
    "stream_ingest_lead": with_(EV) +
        "SELECT event_time_utc, instrument_id, round(value, 6) + 0.0 AS price, "
        "'events' AS source, CAST(quality_flag AS SMALLINT) AS quality_flag, ingest_time_utc "
        f"FROM ev WHERE is_valid AND instrument_id IN {LEAD_TYPES}",
    "stream_quarantine": with_(EV) +
        "SELECT instrument_id, CASE WHEN is_valid THEN 'unrouted_instrument' ELSE reasons END AS reasons, "
        f"count(*) AS n_messages FROM ev WHERE NOT is_valid OR instrument_id NOT IN {LEAD_TYPES} AND instrument_id <> 'signup' "
        "GROUP BY ALL",
    "stream_accounting": with_(EV) +
        "SELECT CASE WHEN NOT is_valid THEN reasons WHEN instrument_id = 'signup' THEN 'raw_reference' "
        f"WHEN instrument_id IN {LEAD_TYPES} THEN 'raw_lead' ELSE 'unrouted_instrument' END AS outcome, "
        "count(*) AS n_messages FROM ev GROUP BY 1",
    "insert_if_absent": SQL["aligned_bars"],
    "partitioned_roundtrip": with_(*METRIC_CTES) +
        "SELECT symbol, date, horizon, metric, " + rnd("value", "value") + " FROM ml "
        "WHERE metric = 'spread_zscore' AND horizon = '30d' "
        "AND date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'",
})

# ----------------------------------------------------------------- landing --
HIST = f"""hist AS (
  SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS rate
  FROM orders WHERE {IS_HISTORY} GROUP BY 1)"""
UNION_FW = """u AS (
  SELECT date, rate FROM hist
  UNION ALL SELECT date, rate FROM recent WHERE date NOT IN (SELECT date FROM hist))"""

SQL.update({
    "landed_json_series": with_(LEAD) + "SELECT symbol, date, round(price, 6) + 0.0 AS price FROM lead",
    "page_completeness": with_(LEAD) +
        "SELECT symbol AS product, count(*) AS n_rows, count(*) AS announced_total FROM lead GROUP BY symbol",
    "landed_csv_history": with_(REF, HIST) + "SELECT date, round(rate, 6) + 0.0 AS rate FROM hist",
    "landed_xml_rates": with_(RECENT) + "SELECT date, round(rate, 6) + 0.0 AS rate FROM recent",
    "series_union_first_wins": with_(REF, RECENT, HIST, UNION_FW) +
        "SELECT date, round(rate, 6) + 0.0 AS rate FROM u",
    "series_gap_range": with_(REF, RECENT, HIST) +
        "SELECT date, round(rate, 6) + 0.0 AS rate FROM recent WHERE date > (SELECT max(date) FROM hist)",
    "next_fetch_start": with_(REF, HIST) + "SELECT max(date) + 1 AS next_start FROM hist",
    "missing_days": with_(REF, RECENT, HIST, UNION_FW) +
        "SELECT CAST(d.generate_series AS DATE) AS date FROM generate_series("
        "(SELECT min(date) FROM u)::TIMESTAMP, (SELECT max(date) FROM u)::TIMESTAMP, INTERVAL 1 DAY) d "
        "WHERE CAST(d.generate_series AS DATE) NOT IN (SELECT date FROM u)",
    "high_water_mark": with_(LEAD) +
        "SELECT symbol AS product, max(date) AS latest_date, max(date) + 1 AS next_start FROM lead GROUP BY symbol",
    "latest_day_envelopes": with_(LEAD) +
        "SELECT symbol AS instrument_id, CAST(date AS TIMESTAMP) AS event_time_utc, "
        "round(price, 6) + 0.0 AS price FROM lead "
        "WHERE (symbol, date) IN (SELECT symbol, max(date) FROM lead GROUP BY symbol)",
    "corpus_roundtrip": with_(LEAD) +
        "SELECT symbol AS instrument_id, date, round(price, 6) + 0.0 AS price FROM lead",
})

# ------------------------------------------------------------------- serve --
RANGE = "date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'"


def _panel_sql(metric: str, horizon: str, alias: str) -> str:
    return (with_(*METRIC_CTES) + f"SELECT date AS time, round(value, 6) + 0.0 AS {alias} FROM ml "
            f"WHERE symbol = 'A' AND metric = '{metric}' AND horizon = '{horizon}' AND {RANGE}")


SQL.update({
    "panel_price": with_(*BAR_CTES) +
        f"SELECT date AS time, round(lead_price, 6) + 0.0 AS lead_price FROM bars WHERE symbol = 'A' AND {RANGE}",
    "panel_rate": with_(*BAR_CTES) +
        f"SELECT date AS time, round(ref_rate, 6) + 0.0 AS ref_rate FROM bars WHERE symbol = 'A' AND {RANGE}",
    "panel_corr_30d": _panel_sql("pearson_corr", "30d", "corr_30d"),
    "panel_corr_60d": _panel_sql("pearson_corr", "60d", "corr_60d"),
    "panel_zscore_30d": _panel_sql("spread_zscore", "30d", "zscore_30d"),
    "panel_zscore_60d": _panel_sql("spread_zscore", "60d", "zscore_60d"),
    "zscore_band": with_(*METRIC_CTES) +
        "SELECT date AS time, round(value, 6) + 0.0 AS zscore_30d FROM ml WHERE symbol = 'A' "
        f"AND metric = 'spread_zscore' AND horizon = '30d' AND {RANGE} AND abs(value) > 2.5",
    "latest_alerts": with_(*ALERT_CTES) +
        "SELECT fired_at, kind, severity, symbol, horizon, description FROM alerts "
        "ORDER BY fired_at DESC, kind, symbol, horizon LIMIT 50",
    "metric_series": with_(*METRIC_CTES) +
        "SELECT date AS time, round(value, 6) + 0.0 AS value FROM ml "
        "WHERE symbol = 'R' AND metric = 'spread_zscore' AND horizon = '30d'",
    "bars_for_metrics": with_(*BAR_CTES) +
        "SELECT date, round(lead_logret, 6) + 0.0 AS lead_logret, round(ref_logret, 6) + 0.0 AS ref_logret "
        "FROM bars WHERE symbol = 'R' AND horizon = '1d'",
    "metrics_for_features": with_(*METRIC_CTES) +
        "SELECT date, metric, horizon, round(value, 6) + 0.0 AS value FROM ml WHERE symbol = 'R'",
})

# The blocked forms must equal the plain ones exactly.
SQL.update({
    "aligned_bars_blocked": SQL["aligned_bars"],
    "metrics_long_blocked": SQL["metrics_long"],
    "metrics_long_merged": SQL["metrics_long"],
    "cusum_accumulator_blocked": SQL["cusum_accumulator"],
    "cusum_alerts_blocked": SQL["cusum_alerts"],
    "features_lagged_blocked": SQL["features_lagged"],
    "time_folds_blocked": SQL["time_folds"],
    "batch_alerts_table": SQL["cusum_alerts"],
})

SQL.update({
    "sql_panel_zscore_30d": SQL["panel_zscore_30d"],
    "sql_latest_alerts": SQL["latest_alerts"],
})

SQL["value_on_day"] = (with_(LEAD) + "SELECT symbol AS product, date, round(price, 6) + 0.0 AS price "
                       "FROM lead WHERE date = DATE '1998-06-15'")

SQL["stream_lag_monitor"] = with_(EV, """lagged AS (
  SELECT instrument_id, ingest_time_utc,
         (epoch_us(ingest_time_utc) - epoch_us(event_time_utc)) / 1e6 AS lag_s,
         time_bucket(INTERVAL 1 HOUR, ingest_time_utc) AS window_start
  FROM ev WHERE is_valid)""") + """
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, instrument_id,
       count(*) AS n_messages, round(avg(lag_s), 6) + 0.0 AS avg_lag_s,
       round(max(lag_s), 6) + 0.0 AS max_lag_s
FROM lagged GROUP BY window_start, instrument_id"""

# Bars from the streamed raw tables: same chain, daily closes of the events.
LEAD_FROM_EVENTS = f"""lead AS (
  SELECT instrument_id AS symbol, CAST(event_time_utc AS DATE) AS date,
         arg_max(value, event_time_utc) AS price
  FROM ev WHERE is_valid AND instrument_id IN {LEAD_TYPES} GROUP BY 1, 2)"""
REF_FROM_EVENTS = """ref AS (
  SELECT CAST(event_time_utc AS DATE) AS date, arg_max(value, event_time_utc) AS rate
  FROM ev WHERE is_valid AND instrument_id = 'signup' GROUP BY 1)"""
SQL["bars_from_stream"] = (with_(EV, LEAD_FROM_EVENTS, REF_FROM_EVENTS, FILLED, RETURNS, BARS)
                           + f"SELECT {BAR_SELECT} FROM bars")

SQL |= {"incremental_bars": SQL["aligned_bars"], "incremental_metrics": SQL["metrics_long"], "incremental_alerts": SQL["cusum_alerts"]}

SQL["missing_on_newest_day"] = with_(LEAD) + """SELECT symbol AS product, max(date) AS latest_date FROM lead GROUP BY symbol
HAVING max(date) < (SELECT max(date) FROM lead)"""
