"""The same results as independent SQL over the driver's tables."""

from __future__ import annotations

from catalog.fixture import TXN_SQL
from tidemark.schemas import DRIFT_NUMERIC

HOUR, DAY = 3_600_000_000, 86_400_000_000
TIES = "epoch_us(date_trunc('hour', trans_date_trans_time))"
THRESHOLDS = ", ".join(f"({i}, {t!r})" for i, t in enumerate((0.01 + 0.01 * k if k < 98 else 0.99 for k in range(99)), 1))


def history_sql(us: str = "us", spans: dict[str, int] | None = None, where: str = "TRUE", cap: int = 604800,
                source: str = "txn", key: str = "cc_num", id: str = "trans_num", amount: str = "amt") -> str:
    """Select list and windows of the history features over `source`."""
    spans = spans or {"1h": HOUR, "24h": DAY}
    frames = ", ".join(
        f"w{n} AS (PARTITION BY {key} ORDER BY {us} RANGE BETWEEN {size} PRECEDING AND 1 PRECEDING)"
        for n, size in spans.items()
    )
    columns = ", ".join(
        f"CAST(count({amount}) OVER w{n} AS DOUBLE) AS card_txn_count_{n}, "
        f"round(coalesce(sum({amount}) OVER w{n}, 0), 6) AS card_amt_sum_{n}"
        for n in spans
    )
    return f"""
    SELECT *, {columns},
      round(least(coalesce(({us} - lag({us}) OVER o) / 1000000.0::DOUBLE, {cap}), {cap}), 6) AS seconds_since_last_txn,
      round(coalesce({amount} / nullif(avg({amount}) OVER p, 0), 1.0), 6) AS amt_vs_card_mean
    FROM {source} WHERE {where}
    WINDOW {frames}, o AS (PARTITION BY {key} ORDER BY {us}, {id}),
           p AS (PARTITION BY {key} ORDER BY {us}, {id} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    """


HISTORY_COLUMNS = (
    "card_txn_count_1h, card_amt_sum_1h, card_txn_count_24h, card_amt_sum_24h, seconds_since_last_txn, amt_vs_card_mean"
)


def with_txn(body: str, *more: str) -> str:
    return "WITH " + ", ".join([TXN_SQL.strip(), *more]) + " " + body


def hist(us: str = "us") -> str:
    return with_txn(f"SELECT trans_num, cc_num, {HISTORY_COLUMNS} FROM ({history_sql(us)})")


ROW_SQL = """
  round(ln(1 + amt), 6) AS log_amt, CAST(hour(trans_date_trans_time) AS INTEGER) AS hour,
  CAST(hour(trans_date_trans_time) IN (22, 23, 0, 1, 2, 3) AS INTEGER) AS is_night,
  CAST(isodow(trans_date_trans_time) - 1 AS INTEGER) AS day_of_week,
  round(date_diff('day', dob, CAST(trans_date_trans_time AS DATE)) / 365.25::DOUBLE, 6) AS age_years,
  round(2 * 6371.0 * asin(sqrt(least(1.0, power(sin(radians(merch_lat - lat) / 2), 2)
     + cos(radians(lat)) * cos(radians(merch_lat)) * power(sin(radians(merch_long - long) / 2), 2)))), 6) AS distance_km,
  round(ln(1 + city_pop), 6) AS log_city_pop
"""

WEEK = "strftime(date_trunc('week', trans_date_trans_time - INTERVAL 1 DAY), '%Y-%m-%d')"

FEATURED = f"""
feat AS (SELECT *, {ROW_SQL}, {WEEK} AS week FROM ({history_sql()}))
"""

# Iso text of a naive time; the fraction is written only when it is not zero.
def iso(ts: str) -> str:
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
            f"ELSE '.' || lpad(CAST(epoch_us({ts}) % 1000000 AS VARCHAR), 6, '0') END)")


DIRTY = f"""
dirty AS (
  SELECT CAST(trans_num AS VARCHAR) AS transaction_id, trans_num AS n,
    CASE WHEN trans_num % 11 = 0 THEN '' ELSE cc_num END AS cc_num,
    CASE WHEN trans_num % 13 = 0 THEN -amt WHEN trans_num % 17 = 0 THEN 1000000.5 ELSE amt END AS amount,
    CASE WHEN trans_num % 19 = 0 THEN 'casino' ELSE category END AS category,
    trans_num % 23 = 0 AS bad_time, trans_num % 29 = 0 AS bad_dob, trans_num % 31 = 0 AS bad_lat,
    trans_num % 37 = 0 AS bad_long, CASE WHEN trans_num % 41 = 0 THEN NULL ELSE city_pop END AS city_pop,
    CAST(dob AS VARCHAR) AS dob
  FROM txn),
broken AS (
  SELECT transaction_id, list_filter([
    CASE WHEN cc_num = '' THEN 'cc_num' END,
    CASE WHEN NOT (amount > 0 AND amount <= 1000000) THEN 'amount' END,
    CASE WHEN category NOT IN ('click', 'error', 'purchase', 'signup', 'view') THEN 'category' END,
    CASE WHEN bad_time THEN 'timestamp' END, CASE WHEN bad_dob THEN 'customer_dob' END,
    CASE WHEN bad_lat THEN 'customer_lat' END, CASE WHEN bad_long THEN 'merchant_long' END,
    CASE WHEN city_pop IS NULL THEN 'city_pop' END], lambda x: x IS NOT NULL) AS violations
  FROM dirty)
"""

DECISION = "CASE WHEN score >= 0.8 THEN 'decline' WHEN score >= 0.5 THEN 'review' ELSE 'approve' END"


def metrics_sql(threshold: float, group: str | None = None, source: str = "txn", extra: str = "") -> str:
    """One row of ranking metrics per group, straight from the definitions."""
    g = group or "1"
    return f"""
    tie AS (SELECT {g} AS g, score, count(*) FILTER (is_fraud = 1) AS p, count(*) FILTER (is_fraud = 0) AS n
            FROM {source} GROUP BY ALL),
    curve AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER a AS allp, sum(n) OVER a AS alln
              FROM tie WINDOW w AS (PARTITION BY g ORDER BY score DESC), a AS (PARTITION BY g)),
    agg AS (SELECT g, max(allp) AS ap, max(alln) AS an,
              sum(p * tp::DOUBLE / (tp + fp)) / nullif(max(allp), 0) AS pr_auc,
              sum(n * (tp - p / 2.0::DOUBLE)) / nullif(max(allp)::DOUBLE * max(alln), 0) AS roc_auc,
              coalesce(max(tp) FILTER (fp::DOUBLE / nullif(alln, 0) <= 0.01), 0) / nullif(max(allp)::DOUBLE, 0) AS recall_fpr,
              coalesce(sum(p) FILTER (score >= {threshold}), 0) AS tp, coalesce(sum(n) FILTER (score >= {threshold}), 0) AS fp,
              coalesce(sum(p) FILTER (score < {threshold}), 0) AS fn, coalesce(sum(n) FILTER (score < {threshold}), 0) AS tn
            FROM curve GROUP BY g),
    metrics AS (SELECT g, CAST(ap AS BIGINT) AS positives, CAST(an AS BIGINT) AS negatives, CAST(tp AS BIGINT) AS tp,
              CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
              pr_auc, pr_auc / nullif(ap / (ap + an)::DOUBLE, 0) AS pr_auc_lift, roc_auc, recall_fpr AS recall_at_1pct_fpr,
              coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall,
              coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, ap / (ap + an)::DOUBLE AS base_rate FROM agg)
    """


METRIC_COLUMNS = ("pr_auc", "pr_auc_lift", "roc_auc", "recall_at_1pct_fpr", "precision", "recall", "f1", "base_rate")
METRIC_SELECT = "positives, negatives, tp, fp, fn, tn, " + ", ".join(f"round({m}, 6) AS {m}" for m in METRIC_COLUMNS)


def costs_sql(threshold: float, group: str = "1") -> str:
    return f"""
    costs AS (SELECT {group} AS cg, coalesce(sum(amt) FILTER (is_fraud = 1), 0) AS no_model_loss,
      coalesce(sum(amt) FILTER (is_fraud = 1 AND score < {threshold}), 0) AS missed_fraud_loss,
      10.0::DOUBLE * count(*) FILTER (is_fraud = 0 AND score >= {threshold}) AS false_alarm_cost FROM txn GROUP BY ALL)
    """


COST_SELECT = ("round(no_model_loss, 6) AS no_model_loss, round(missed_fraud_loss, 6) AS missed_fraud_loss, "
               "round(false_alarm_cost, 6) AS false_alarm_cost, round(missed_fraud_loss + false_alarm_cost, 6) AS total_cost")


def grid_sql(costs: str = "(10.0::DOUBLE)", group: str = "1") -> str:
    """Every threshold against every row."""
    return f"""
    steps(i, threshold) AS (VALUES {THRESHOLDS}), prices(fp_cost) AS (VALUES {costs}),
    cells AS (SELECT {group} AS g, threshold::DOUBLE AS threshold, count(*) FILTER (is_fraud = 1 AND score >= threshold::DOUBLE) AS tp,
        count(*) FILTER (is_fraud = 0 AND score >= threshold::DOUBLE) AS fp, count(*) FILTER (is_fraud = 1 AND score < threshold::DOUBLE) AS fn,
        coalesce(sum(amt) FILTER (is_fraud = 1 AND score < threshold::DOUBLE), 0) AS missed FROM txn, steps GROUP BY ALL),
    grid AS (SELECT g, fp_cost::DOUBLE AS fp_cost, threshold, tp, fp, fn, round(missed, 6) AS missed_fraud_loss,
        round(missed + fp_cost::DOUBLE * fp, 6) AS total_cost, round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
        round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall FROM cells, prices),
    best AS (SELECT * FROM grid QUALIFY row_number() OVER (PARTITION BY g, fp_cost ORDER BY total_cost, threshold) = 1)
    """


def describe_sql(value: str, source: str, group: str | None = None) -> str:
    head = f"{group}, " if group else ""
    return f"""
    SELECT {head}count({value}) AS count, round(avg({value}), 6) AS mean, round(stddev_samp({value}), 6) AS std,
      round(min({value}), 6)::DOUBLE AS min, round(quantile_cont({value}, 0.25), 6) AS p25,
      round(quantile_cont({value}, 0.5), 6) AS p50, round(quantile_cont({value}, 0.75), 6) AS p75,
      round(max({value}), 6)::DOUBLE AS max FROM {source} {f'GROUP BY {group}' if group else ''}
    """


def numeric_drift_sql(source: str, numeric: list[str], week: str = "week", is_ref: str = "split = 'train'") -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {is_ref} AS is_ref, {week} AS week FROM {source}" for f in numeric
    )
    return f"""
    long AS ({long}),
    weeks AS (SELECT DISTINCT {week} AS wk FROM {source} WHERE NOT ({is_ref})),
    pool AS (SELECT feature, wk, value, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
             FROM long, weeks WHERE is_ref OR week = wk GROUP BY ALL),
    walk AS (SELECT *, sum(r) OVER u / sum(r) OVER a::DOUBLE AS fr, sum(c) OVER u / sum(c) OVER a::DOUBLE AS fc,
                    lead(value) OVER u - value AS gap
             FROM pool WINDOW u AS (PARTITION BY feature, wk ORDER BY value), a AS (PARTITION BY feature, wk)),
    spread AS (SELECT feature, stddev_pop(value) FILTER (is_ref) AS s FROM long GROUP BY feature),
    numeric_drift AS (SELECT wk AS "window", w.feature, sum(abs(fr - fc) * coalesce(gap, 0)) / greatest(max(s), 0.001) AS distance
             FROM walk w JOIN spread USING (feature) GROUP BY ALL)
    """


def categorical_drift_sql(source: str, categorical: list[str], week: str = "week", is_ref: str = "split = 'train'") -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, {is_ref} AS is_ref, {week} AS week FROM {source}" for f in categorical
    )
    return f"""
    clong AS ({long}),
    cweeks AS (SELECT DISTINCT {week} AS wk FROM {source} WHERE NOT ({is_ref})),
    cpool AS (SELECT feature, wk, value, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c
             FROM clong, cweeks WHERE is_ref OR week = wk GROUP BY ALL),
    shares AS (SELECT feature, wk, r / sum(r) OVER a::DOUBLE AS p, c / sum(c) OVER a::DOUBLE AS q
             FROM cpool WINDOW a AS (PARTITION BY feature, wk)),
    categorical_drift AS (SELECT wk AS "window", feature, sqrt(greatest(0, sum(
              CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2)) AS distance
             FROM shares GROUP BY ALL)
    """


INJECTED = """
moved AS (SELECT * REPLACE (
    CASE WHEN hit THEN amt * 1.8 ELSE amt END AS amt, CASE WHEN hit THEN ln(1 + amt * 1.8) ELSE log_amt END AS log_amt,
    CASE WHEN hit THEN card_amt_sum_1h * 1.8 ELSE card_amt_sum_1h END AS card_amt_sum_1h,
    CASE WHEN hit THEN card_amt_sum_24h * 1.8 ELSE card_amt_sum_24h END AS card_amt_sum_24h)
  FROM (SELECT *, split <> 'train' AND trans_date_trans_time >= TIMESTAMP '2024-01-23' AS hit FROM feat))
"""
INJECT_ALL = INJECTED.replace("split <> 'train' AND ", "")

ALL_DISTANCES = "dist AS (SELECT * FROM numeric_drift UNION ALL SELECT * FROM categorical_drift)"
NIGHT_AND_CATEGORY = ["is_night", "category"]

REPORT = [
    TXN_SQL.strip(), FEATURED, INJECTED,
    "judged AS (SELECT week AS wk, count(*) AS transactions, avg(is_fraud) AS rate FROM moved WHERE split <> 'train' "
    "GROUP BY week HAVING count(*) >= 1000 AND sum(is_fraud) >= 5)",
    numeric_drift_sql("moved", [*DRIFT_NUMERIC, "score"]),
    categorical_drift_sql("moved", NIGHT_AND_CATEGORY),
    ALL_DISTANCES,
    "per AS (SELECT \"window\" AS wk, avg((distance >= 0.1)::INT) FILTER (feature <> 'score') AS share, "
    "max(distance) FILTER (feature = 'score') AS score_d, max(distance) FILTER (feature = 'amt') AS amt_d FROM dist GROUP BY ALL)",
    metrics_sql(0.5, "CASE WHEN split = 'train' THEN 'reference' ELSE week END", "moved"),
    "report AS (SELECT j.wk AS week, transactions, round(100 * rate, 2) AS fraud_rate_pct, round(m.pr_auc, 4) AS pr_auc, "
    "round(m.recall_at_1pct_fpr, 4) AS recall_at_1pct_fpr, CAST(round(100 * share) AS INTEGER) AS drifted_features_pct, "
    "round(amt_d, 3) AS amt_drift, round(score_d, 3) AS score_drift, "
    "coalesce(nullif(concat_ws(', ', CASE WHEN share >= 0.3 THEN 'DATA_DRIFT' END, CASE WHEN score_d >= 0.1 THEN 'PREDICTION_DRIFT' END, "
    "CASE WHEN 1 - m.recall_at_1pct_fpr / r.recall_at_1pct_fpr > 0.05 THEN 'RETRAIN' END), ''), '-') AS alerts "
    "FROM judged j JOIN per USING (wk) JOIN metrics m ON m.g = j.wk JOIN metrics r ON r.g = 'reference')",
]

DATASET_COLUMNS = (
    "round(amt, 6) AS amt, log_amt, hour, is_night, day_of_week, age_years, distance_km, log_city_pop, "
    + HISTORY_COLUMNS + ", category"
)

SHIPPED = ("shipped AS (SELECT *, year(l_shipdate) = 1995 AS ref, CAST(year(l_shipdate) AS VARCHAR) AS yr FROM lineitem)")

LAST = "last AS (SELECT cc_num AS k, max(us) AS last_us FROM txn WHERE split <> 'test' GROUP BY cc_num)"

ORACLES: dict[str, str] = {
    "card_history": hist(),
    "card_history_ties": hist(TIES),
    "card_history_hot_keys": hist(),
    "card_history_sliced_ties": hist(TIES),
    "card_history_custom_windows": with_txn(
        "SELECT trans_num, cc_num, card_txn_count_6h, card_amt_sum_6h, card_txn_count_3d, card_amt_sum_3d, "
        "card_txn_count_7d, card_amt_sum_7d, seconds_since_last_txn, amt_vs_card_mean FROM ("
        + history_sql(spans={"6h": 6 * HOUR, "3d": 3 * DAY, "7d": 7 * DAY}) + ")"
    ),
    "order_velocity": "SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice, card_txn_count_30d, card_amt_sum_30d, "
    "card_txn_count_365d, card_amt_sum_365d, seconds_since_last_txn, amt_vs_card_mean FROM ("
    + history_sql("epoch_us(o_orderdate)", {"30d": 30 * DAY, "365d": 365 * DAY}, cap=365 * 86400, source="orders",
                  key="o_custkey", id="o_orderkey", amount="o_totalprice") + ")",
    "txn_features": with_txn(f"SELECT trans_num, {ROW_SQL} FROM txn"),
    "clean_events": with_txn(
        "SELECT trans_num, regexp_replace(merchant, '^fraud_', '') AS merchant, "
        "'amt,category,cc_num,city_pop,dob,is_fraud,lat,long,merch_lat,merch_long,merchant,score,split,trans_date_trans_time,trans_num' "
        "AS columns_left FROM txn"
    ),
    "to_event": with_txn(
        f"SELECT CAST(trans_num AS VARCHAR) AS transaction_id, cc_num, round(amt, 6) AS amount, category, "
        f"{iso('trans_date_trans_time')} AS \"timestamp\", strftime(dob, '%Y-%m-%d') AS customer_dob, round(lat, 6) AS customer_lat, "
        "round(long, 6) AS customer_long, round(merch_lat, 6) AS merchant_lat, round(merch_long, 6) AS merchant_long, "
        "CAST(city_pop AS BIGINT) AS city_pop FROM txn"
    ),
    "to_label_event": with_txn("SELECT CAST(trans_num AS VARCHAR) AS transaction_id, is_fraud FROM txn"),
    "iso_round_trip": with_txn(
        f"SELECT trans_num, {iso('trans_date_trans_time')} AS iso, us, {iso('make_timestamp(us)')} AS iso_again FROM txn"
    ),
    "validate_rows": with_txn(
        "SELECT transaction_id, len(violations) = 0 AS valid, array_to_string(violations, ',') AS violations FROM broken", DIRTY
    ),
    "violation_counts": with_txn(
        "SELECT field, count(*) AS n FROM (SELECT unnest(violations) AS field FROM broken) GROUP BY field", DIRTY
    ),
    "mask_alerts": with_txn(
        f"SELECT trans_num, '...' || right('4000' || cc_num, 4) AS cc_num, round(score, 6) AS score, {DECISION} AS decision "
        f"FROM txn WHERE {DECISION} <> 'approve'"
    ),
    "decide": with_txn(f"SELECT trans_num, {DECISION} AS decision FROM txn"),
    "decision_counts": with_txn(f"SELECT {DECISION} AS decision, count(*) AS n FROM txn GROUP BY ALL"),
    "time_split_summary": with_txn(
        f"SELECT split, count(*) AS rows, round(avg(is_fraud), 6) AS fraud_rate, {iso('min(trans_date_trans_time)')} AS first_time, "
        f"{iso('max(trans_date_trans_time)')} AS last_time FROM txn GROUP BY split"
    ),
    "dataset_build": with_txn(f"SELECT trans_num, cc_num, {DATASET_COLUMNS}, is_fraud, split FROM feat", FEATURED),
    "feature_vector": with_txn(f"SELECT trans_num, {DATASET_COLUMNS} FROM feat", FEATURED),
    "label_balance": with_txn(
        "SELECT count(*) FILTER (is_fraud = 0) AS negatives, count(*) FILTER (is_fraud = 1) AS positives, "
        "round(avg(is_fraud), 6) AS fraud_rate, round(1 - avg(is_fraud), 6) AS always_negative_accuracy FROM txn"
    ),
    "rate_by_category": with_txn(
        "SELECT category, count(*) AS transactions, round(avg(is_fraud), 6) AS fraud_rate, "
        "round(100 * avg(is_fraud), 2) AS fraud_rate_pct FROM txn GROUP BY category"
    ),
    "rate_by_hour": with_txn(
        "SELECT CAST(hour(trans_date_trans_time) AS INTEGER) AS hour, count(*) AS transactions, round(avg(is_fraud), 6) AS fraud_rate, "
        "round(100 * avg(is_fraud), 2) AS fraud_rate_pct FROM txn GROUP BY ALL"
    ),
    "rate_by_month": """
        WITH kept AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m, (o_orderpriority = '1-URGENT')::INT AS y
                      FROM orders),
             cal AS (SELECT CAST(unnest(generate_series((SELECT min(m) FROM kept)::TIMESTAMP, (SELECT max(m) FROM kept)::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS m)
        SELECT CAST(cal.m AS VARCHAR) AS month, count(y) AS count, round(avg(y), 6) AS mean, round(100 * avg(y), 6) AS fraud_rate_pct
        FROM cal LEFT JOIN kept ON cal.m = kept.m GROUP BY cal.m""",
    "card_fraud_profile": with_txn(
        """SELECT (SELECT count(*) FROM cards) AS n_keys, (SELECT count(*) FROM cards WHERE f > 0) AS n_compromised,
           round((SELECT avg((f > 0)::INT) FROM cards), 6) AS share_compromised, count(f) AS count, round(avg(f), 6) AS mean,
           round(stddev_samp(f), 6) AS std, CAST(min(f) AS BIGINT) AS min, round(quantile_cont(f::DOUBLE, 0.25), 6) AS p25,
           round(quantile_cont(f::DOUBLE, 0.5), 6) AS p50, round(quantile_cont(f::DOUBLE, 0.75), 6) AS p75, CAST(max(f) AS BIGINT) AS max
           FROM cards WHERE f > 0""",
        "cards AS (SELECT cc_num, sum(is_fraud) AS f FROM txn GROUP BY cc_num)",
    ),
    "fraud_span": with_txn(
        "SELECT cc_num, round((max(us) - min(us)) / 1000000.0::DOUBLE, 6) AS span_seconds FROM txn WHERE is_fraud = 1 GROUP BY cc_num"
    ),
    "fraud_span_spread": with_txn(
        describe_sql("s", "spans"),
        "spans AS (SELECT (max(us) - min(us)) / 1000000.0::DOUBLE AS s FROM txn WHERE is_fraud = 1 GROUP BY cc_num)",
    ),
    "describe_by_label": with_txn(describe_sql("amt", "txn", "is_fraud")),
    "log_histogram": with_txn(
        """SELECT is_fraud, bin, round(low + bin * width, 6) AS log10_from, n, round(n / sum(n) OVER (PARTITION BY is_fraud)::DOUBLE / width, 6) AS density
           FROM counted""",
        "logs AS (SELECT is_fraud, log10(amt) AS x FROM txn WHERE amt > 0)",
        "span AS (SELECT min(x) AS low, (max(x) - min(x)) / 100.0::DOUBLE AS width FROM logs)",
        "counted AS (SELECT is_fraud, CAST(least(floor((x - low) / width), 99) AS INTEGER) AS bin, low, width, count(*) AS n FROM logs, span GROUP BY ALL)",
    ),
    "dq_profile": with_txn(
        """SELECT 'transaction_id' AS "column", 'string' AS type, 0::BIGINT AS nulls, count(*) AS rows FROM dirty
           UNION ALL SELECT 'amount', 'double', count(*) FILTER (amount IS NULL), count(*) FROM dirty
           UNION ALL SELECT 'city_pop', 'bigint', count(*) FILTER (city_pop IS NULL), count(*) FROM dirty
           UNION ALL SELECT 'customer_dob', 'string', count(*) FILTER (dob IS NULL), count(*) FROM dirty""",
        DIRTY,
    ),
    "feed_checks": with_txn(
        "SELECT round(avg((starts_with(merchant, 'fraud_'))::INT), 6) AS prefixed_share, min(us // 1000000 - unix_time) AS min_offset_s, "
        "max(us // 1000000 - unix_time) AS max_offset_s FROM txn"
    ),
    "distinct_cards": with_txn("SELECT count(DISTINCT cc_num) AS n_keys FROM txn"),
    "confusion": with_txn(
        "SELECT count(*) FILTER (is_fraud = 1 AND score >= 0.5) AS tp, count(*) FILTER (is_fraud = 0 AND score >= 0.5) AS fp, "
        "count(*) FILTER (is_fraud = 1 AND score < 0.5) AS fn, count(*) FILTER (is_fraud = 0 AND score < 0.5) AS tn FROM txn"
    ),
    "confusion_quality_labels": """
        SELECT lang, count(*) FILTER (quality = 1 AND n_chars >= 1000) AS tp, count(*) FILTER (quality = 0 AND n_chars >= 1000) AS fp,
          count(*) FILTER (quality = 1 AND n_chars < 1000) AS fn, count(*) FILTER (quality = 0 AND n_chars < 1000) AS tn
        FROM labels JOIN documents USING (doc_id) GROUP BY lang""",
    "pr_curve": with_txn(
        "SELECT round(score, 6) AS score, CAST(p AS BIGINT) AS pos, CAST(n AS BIGINT) AS neg, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM curve",
        metrics_sql(0.5),
    ),
    "evaluate": with_txn(f"SELECT {METRIC_SELECT} FROM metrics", metrics_sql(0.5)),
    "evaluate_by_category": with_txn(f"SELECT g AS category, {METRIC_SELECT} FROM metrics", metrics_sql(0.6, "category")),
    "evaluate_by_week": with_txn(f"SELECT g AS week, {METRIC_SELECT} FROM metrics", metrics_sql(0.5, WEEK)),
    "weeks_large_enough": with_txn(
        f"SELECT {WEEK} AS week, count(*) AS transactions, CAST(sum(is_fraud) AS BIGINT) AS frauds, round(avg(is_fraud), 6) AS fraud_rate "
        "FROM txn GROUP BY ALL HAVING count(*) >= 1000 AND sum(is_fraud) >= 5"
    ),
    "split_metrics": with_txn(
        f"SELECT g AS split, positives + negatives AS rows, positives AS frauds, tp, fn, fp, tn, "
        + ", ".join(f"round({m}, 6) AS {m}" for m in METRIC_COLUMNS) + f", {COST_SELECT}, "
        "round(fp::DOUBLE / (fp + tn), 6) AS false_alarm_rate, round(1 - (missed_fraud_loss + false_alarm_cost) / no_model_loss, 6) AS cost_reduction "
        "FROM metrics JOIN costs ON g = cg",
        metrics_sql(0.6, "split"), costs_sql(0.6, "split"),
    ),
    "final_summary": with_txn(
        "SELECT metric, round(max(v) FILTER (g = 'val'), 6) AS val, round(max(v) FILTER (g = 'test'), 6) AS test "
        "FROM (SELECT g, metric, v FROM wide UNPIVOT (v FOR metric IN (rows, frauds, tp, fn, fp, tn, "
        + ", ".join(METRIC_COLUMNS) + ", no_model_loss, missed_fraud_loss, false_alarm_cost, total_cost, false_alarm_rate, cost_reduction))) "
        "WHERE g <> 'train' GROUP BY metric",
        metrics_sql(0.6, "split"), costs_sql(0.6, "split"),
        "wide AS (SELECT g, (positives + negatives)::DOUBLE AS rows, positives::DOUBLE AS frauds, tp::DOUBLE AS tp, fn::DOUBLE AS fn, "
        "fp::DOUBLE AS fp, tn::DOUBLE AS tn, " + ", ".join(METRIC_COLUMNS) + ", no_model_loss, missed_fraud_loss, false_alarm_cost, "
        "missed_fraud_loss + false_alarm_cost AS total_cost, fp::DOUBLE / (fp + tn) AS false_alarm_rate, "
        "1 - (missed_fraud_loss + false_alarm_cost) / no_model_loss AS cost_reduction FROM metrics JOIN costs ON g = cg)",
    ),
    "business_cost": with_txn(f"SELECT {COST_SELECT} FROM costs", costs_sql(0.6)),
    "cost_curve": with_txn(
        "SELECT fp_cost, round(threshold, 6) AS threshold, tp, fp, fn, missed_fraud_loss, total_cost, precision, recall FROM grid", grid_sql()
    ),
    "cost_optimal_threshold": with_txn("SELECT round(threshold, 6) AS threshold, total_cost FROM best", grid_sql()),
    "cost_optimal_by_split": with_txn(
        "SELECT g AS split, round(threshold, 6) AS threshold, total_cost FROM best", grid_sql(group="split")
    ),
    "cost_sensitivity": with_txn(
        "SELECT fp_cost, round(threshold, 6) AS threshold, total_cost, precision, recall FROM best",
        grid_sql("(2.0::DOUBLE), (5.0::DOUBLE), (10.0::DOUBLE), (25.0::DOUBLE), (50.0::DOUBLE)"),
    ),
    "class_weight": with_txn(
        "SELECT round(count(*) FILTER (is_fraud = 0)::DOUBLE / count(*) FILTER (is_fraud = 1), 6) AS class_weight FROM txn"
    ),
    "latency_summary": with_txn(
        "SELECT category, max(n) AS n, round(max(amt) FILTER (r = n // 2), 6) AS p50, "
        "round(max(amt) FILTER (r = CAST(floor(n * 0.99::DOUBLE) AS BIGINT) - 1), 6) AS p99, "
        "round(count(*) / ((max(us) - min(us)) / 1000000.0::DOUBLE), 6) AS per_second FROM "
        "(SELECT category, amt, us, row_number() OVER (PARTITION BY category ORDER BY amt) - 1 AS r, count(*) OVER (PARTITION BY category) AS n FROM txn) "
        "GROUP BY category"
    ),
    "latency_sketch": with_txn(
        "SELECT category, count(*) AS n, count(DISTINCT trans_date_trans_time::DATE) AS parts, true AS p50_close, true AS p99_close "
        "FROM txn GROUP BY category"
    ),
    "busiest_card": with_txn(
        f"SELECT trans_num, cc_num, card_txn_count_24h FROM ({history_sql()}) ORDER BY card_txn_count_24h DESC, trans_num LIMIT 1"
    ),
    "skip_limit": with_txn(
        "SELECT trans_num, cc_num, round(amt, 6) AS amt FROM txn ORDER BY trans_date_trans_time, trans_num LIMIT 2000 OFFSET 1000"
    ),
    "skip_rest": with_txn(
        "SELECT trans_num, cc_num, round(amt, 6) AS amt FROM txn ORDER BY date_trunc('day', trans_date_trans_time), trans_num OFFSET 1000"
    ),
    "skip_limit_nulls": with_txn(
        "SELECT CAST(trans_num AS VARCHAR) AS trans_num, cc_num, round(amt, 6) AS amt FROM txn "
        "ORDER BY CASE WHEN trans_num % 3 <> 0 THEN trans_date_trans_time END NULLS FIRST, CAST(trans_num AS VARCHAR) LIMIT 1000 OFFSET 500"
    ),
    "skip_limit_one_time": with_txn("SELECT trans_num, cc_num, round(amt, 6) AS amt FROM txn ORDER BY trans_num LIMIT 2000 OFFSET 1000"),
    "state_totals": with_txn(
        "SELECT cc_num, max(us) AS last_us, count(*) AS total_count, round(sum(amt), 6) AS total_amount FROM txn "
        "WHERE split <> 'test' GROUP BY cc_num"
    ),
    "state_recent": with_txn(
        f"SELECT cc_num, us, trans_num AS id, round(amt, 6) AS amt FROM txn JOIN last ON cc_num = k WHERE split <> 'test' AND us >= last_us - {DAY}",
        LAST,
    ),
    "continued_history": with_txn(
        f"SELECT trans_num, cc_num, {HISTORY_COLUMNS} FROM ({history_sql()}) WHERE split = 'test'"
    ),
    "parity_report": with_txn(
        "SELECT unnest(['card_txn_count_1h', 'card_amt_sum_1h', 'card_txn_count_24h', 'card_amt_sum_24h', 'seconds_since_last_txn', "
        "'amt_vs_card_mean']) AS feature, compared, 0::BIGINT AS missing_offline, 0::BIGINT AS missing_online, true AS equal "
        "FROM (SELECT count(*) AS compared FROM txn WHERE split = 'test')"
    ),
    "label_join": """
        SELECT CAST(doc_id AS VARCHAR) AS transaction_id,
          CASE WHEN n_chars / (n_chars + 1000.0::DOUBLE) >= 0.9 THEN 'decline' WHEN n_chars / (n_chars + 1000.0::DOUBLE) >= 0.5 THEN 'review'
               ELSE 'approve' END AS decision, quality AS is_fraud
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "drift_numeric": with_txn(
        'SELECT "window", feature, round(distance, 6) AS distance FROM numeric_drift', FEATURED, numeric_drift_sql("feat", [*DRIFT_NUMERIC, "score"])
    ),
    "drift_categorical": with_txn(
        'SELECT "window", feature, round(distance, 6) AS distance FROM categorical_drift', FEATURED,
        categorical_drift_sql("feat", NIGHT_AND_CATEGORY),
    ),
    "drift_share": with_txn(
        'SELECT "window", round(avg((distance >= 0.1)::INT), 6) AS drift_share, '
        "coalesce(array_to_string(list_sort(list(feature) FILTER (distance >= 0.1)), ','), '') AS drifted_features FROM dist GROUP BY \"window\"",
        FEATURED, INJECTED, numeric_drift_sql("moved", DRIFT_NUMERIC), categorical_drift_sql("moved", NIGHT_AND_CATEGORY), ALL_DISTANCES,
    ),
    "drift_inject": with_txn(
        "SELECT trans_num, round(amt, 6) AS amt, round(log_amt, 6) AS log_amt, round(card_amt_sum_1h, 6) AS card_amt_sum_1h, "
        "round(card_amt_sum_24h, 6) AS card_amt_sum_24h, amt_vs_card_mean FROM moved",
        FEATURED, INJECT_ALL,
    ),
    "drift_lineitem": "WITH " + ", ".join([
        SHIPPED,
        numeric_drift_sql("shipped", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "yr", "ref"),
        categorical_drift_sql("shipped", ["l_returnflag", "l_linestatus"], "yr", "ref"),
        ALL_DISTANCES,
    ]) + ' SELECT "window", feature, round(distance, 6) AS distance FROM dist',
    "weekly_alerts": "WITH " + ", ".join(REPORT) + " SELECT * FROM report",
    "weekly_alert_summary": "WITH " + ", ".join(REPORT)
    + " SELECT count(*) FILTER (alerts <> '-') AS weeks_with_alerts, count(*) AS weeks FROM report",
}


# ---- streams: the batch result, because a stream has to reach the same rows

STREAM_TIES = history_sql(TIES, id="CAST(trans_num AS VARCHAR)")


def streamed(rows: str, where: str = "TRUE") -> str:
    return with_txn(
        f"SELECT CAST(trans_num AS VARCHAR) AS transaction_id, cc_num, {HISTORY_COLUMNS}, false AS late FROM ({rows}) WHERE {where}"
    )


HOUR_START = "date_trunc('hour', trans_date_trans_time)"

ORACLES |= {
    "stream_history": streamed(STREAM_TIES),
    "stream_history_state_store": streamed(STREAM_TIES),
    "backfill_stream": streamed(history_sql(), "split = 'test'"),
    "backfill_state_store": streamed(history_sql(), "split = 'test'"),
    "stream_scoring": with_txn(
        "SELECT count(*) AS scored_live, count(*) AS scored_offline, count(*) AS same_score, count(*) AS same_decision "
        "FROM txn WHERE split = 'test'"
    ),
    "stream_dead_letter": with_txn(
        """SELECT violations, count(*) AS n FROM (SELECT CASE trans_num % 10 WHEN 3 THEN 'amount' WHEN 7 THEN 'timestamp'
             WHEN 9 THEN 'transaction_id,cc_num,amount,category,timestamp,customer_dob,customer_lat,customer_long,merchant_lat,merchant_long,city_pop'
             END AS violations FROM txn) WHERE violations IS NOT NULL GROUP BY violations"""
    ),
    "live_decisions": with_txn(
        f"SELECT {iso(HOUR_START)} AS window_start, {DECISION} AS decision, count(*) AS n FROM txn GROUP BY ALL"
    ),
    "live_latency": with_txn(
        f"SELECT {DECISION} AS decision, count(*) AS events, count(*) AS n, round(count(*) / (SELECT "
        "(date_diff('day', min(trans_date_trans_time), max(trans_date_trans_time)) + 1) * 86400.0::DOUBLE FROM txn), 9) AS per_second, "
        "true AS p50_close, true AS p99_close FROM txn GROUP BY ALL"
    ),
    "label_join_stream": with_txn(
        "SELECT CAST(trans_num AS VARCHAR) AS transaction_id, CASE WHEN trans_num % 3 <> 0 THEN is_fraud END AS is_fraud FROM txn"
    ),
}

# ---- learning

TICKET = "(trans_num % 1000003) * 2654435761 % 4294967296"
PAIRS = """
vec AS (SELECT vec_id, embedding::DOUBLE[] AS x, (label = 0)::INT AS y, label FROM embeddings),
near AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, list_distance(a.x, b.x) AS distance, a.y AS ya, b.y AS yb,
           a.label % 2 AS pa, b.label % 2 AS pb FROM vec a JOIN vec b ON a.vec_id <> b.vec_id)
"""
LINKS = """
closest AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) = 1),
links AS (SELECT f.id AS a, f.neighbour AS b, round(f.distance, 6) AS distance FROM closest f JOIN closest g
            ON f.neighbour = g.id AND g.neighbour = f.id AND f.id < f.neighbour AND f.pa <> f.pb)
"""

ORACLES |= {
    "undersample": with_txn(
        f"SELECT trans_num, is_fraud FROM txn WHERE is_fraud = 1 UNION ALL SELECT trans_num, is_fraud FROM "
        f"(SELECT *, row_number() OVER (ORDER BY {TICKET}, trans_num) AS r FROM txn WHERE is_fraud = 0) "
        "WHERE r <= (SELECT floor(sum(is_fraud) / 0.1::DOUBLE) FROM txn)"
    ),
    "nearest_neighbours": f"WITH {PAIRS} SELECT id, neighbour, CAST(r AS INTEGER) AS rank, round(distance, 6) AS distance FROM "
    "(SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS r FROM near) WHERE r <= 5",
    "smote": f"""
        WITH {PAIRS},
        sizes AS (SELECT count(*) FILTER (y = 1) AS pos, CAST(floor(count(*) FILTER (y = 0) * 0.3::DOUBLE) AS BIGINT) - count(*) FILTER (y = 1) AS missing FROM vec),
        starts AS (SELECT vec_id AS id, x, missing // pos + (row_number() OVER (ORDER BY (vec_id % 1000003) * 2654435761 % 4294967296, vec_id) <= missing % pos)::INT AS copies
                   FROM vec, sizes WHERE y = 1),
        many AS (SELECT id, x, unnest(generate_series(1, copies)) AS copy FROM starts),
        near5 AS (SELECT id, neighbour, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS r FROM near WHERE ya = 1 AND yb = 1),
        made AS (SELECT list_transform(list_zip(m.x, v.x), lambda p: p[1] + (((m.id * 13 + m.copy * 29) % 100) / 100.0::DOUBLE) * (p[2] - p[1])) AS x
                 FROM many m JOIN near5 n ON n.id = m.id AND n.r = (m.id * 7 + m.copy * 3) % 5 + 1 JOIN vec v ON v.vec_id = n.neighbour),
        rows AS (SELECT vec_id, y, x FROM vec UNION ALL SELECT NULL, 1, x FROM made)
        SELECT vec_id, y, round(list_sum(x), 6) AS total, round(x[1], 6) AS x0, round(x[2], 6) AS x1 FROM rows""",
    "tomek": f"WITH {PAIRS}, {LINKS} SELECT a, b, distance FROM links",
    "tomek_removed": f"WITH {PAIRS}, {LINKS} SELECT vec_id, label % 2 AS y FROM vec "
    "WHERE vec_id NOT IN (SELECT a FROM links UNION SELECT b FROM links)",
    "promote": with_txn(
        "SELECT version, round(pr_auc, 6) AS val_pr_auc, CASE WHEN version = last THEN new WHEN old <> new THEN old END AS alias FROM ("
        "SELECT *, CASE WHEN version = best THEN 'champion' WHEN version = first THEN 'challenger' END AS old, "
        "CASE WHEN (SELECT pr_auc FROM known WHERE version = last) > (SELECT pr_auc FROM known WHERE version = best) "
        "THEN 'champion' ELSE 'challenger' END AS new FROM known, (SELECT min(version) AS first, max(version) AS last, "
        "arg_min(version, (-pr_auc, version)) FILTER (version < (SELECT max(version) FROM known)) AS best FROM known))",
        metrics_sql(0.5, "strftime(trans_date_trans_time, '%Y-%m-%d')"),
        "known AS (SELECT g AS version, pr_auc FROM metrics WHERE pr_auc IS NOT NULL)",
    ),
    "promotion_history": with_txn(
        "SELECT g AS version, round(pr_auc, 6) AS val_pr_auc, CASE WHEN best IS NULL OR pr_auc > best THEN 'champion' ELSE 'challenger' END AS alias "
        "FROM (SELECT *, max(pr_auc) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM metrics)",
        metrics_sql(0.5, "strftime(trans_date_trans_time, '%Y-%m-%d')"),
    ),
    "test_guard": with_txn(
        "SELECT strftime(trans_date_trans_time, '%Y-%m-%d') AS version FROM txn GROUP BY ALL HAVING sum(is_fraud) <= 18"
    ),
}
