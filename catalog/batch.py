"""Registered batch queries; each has its counterpart in `oracles`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.fixture import CATEGORIES, CUT_TEST, CUT_VALIDATION, table, transactions
from tidemark.columns import TxnColumns
from tidemark.functions.rules import alerts_feed, decide, with_violations
from tidemark.functions.scalars import add_transaction_features, epoch_us, from_epoch_us, iso_time, parse_iso
from tidemark.operators import profile
from tidemark.operators.clean import clean, in_time_order, tagged_union, time_split, to_event, to_label_event
from tidemark.operators.cost import business_cost, class_weight, cost_curve, cost_optimal, SENSITIVITY_COSTS
from tidemark.operators.drift import categorical_drift, drift_share, inject_drift, numeric_drift
from tidemark.operators.history import history_features
from tidemark.operators.labels import label_join
from tidemark.operators.parity import parity_report
from tidemark.operators.ranking import confusion, evaluate, ranking_curve
from tidemark.operators.sketch import merge_sketches, quantile_sketches, rank_error, sketch_quantiles
from tidemark.operators.state import snapshot
from tidemark.plans.dataset import build_dataset, model_input
from tidemark.plans.monitoring import alert_summary, drift_distances, large_enough, week_label, weekly_report
from tidemark.plans.summary import final_summary, summary_by_split
from tidemark.schemas import DRIFT_CATEGORICAL, DRIFT_NUMERIC, HISTORY_FEATURES
from tidemark.session import stored

Query = Callable[[SparkSession, str], DataFrame]

ROW_COLUMNS = ["trans_num", "log_amt", "hour", "is_night", "day_of_week", "age_years", "distance_km", "log_city_pop"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({name: F.round(F.col(name), digits) for name in doubles})


def _history(spark, sf_dir, truncate=None, **options):
    rows = transactions(spark, sf_dir, truncate).select("trans_num", "cc_num", "trans_date_trans_time", "amt")
    return rounded(history_features(rows, **options).select("trans_num", "cc_num", *_feature_names(options)))


def _feature_names(options):
    spans = options.get("windows")
    if spans is None:
        return HISTORY_FEATURES
    return [f"card_{kind}_{s}" for s in spans for kind in ("txn_count", "amt_sum")] + HISTORY_FEATURES[-2:]


def card_history(spark, sf_dir):
    return _history(spark, sf_dir)


def card_history_ties(spark, sf_dir):
    return _history(spark, sf_dir, truncate="hour")


def card_history_hot_keys(spark, sf_dir):
    """Every card with more than 50 rows takes the sliced route, the others the plain one."""
    return _history(spark, sf_dir, hot_rows=50)


def card_history_sliced_ties(spark, sf_dir):
    return _history(spark, sf_dir, truncate="hour", hot_rows=0)


def card_history_custom_windows(spark, sf_dir):
    return _history(spark, sf_dir, windows={"6h": 6 * 3600, "3d": 3 * 86400, "7d": 7 * 86400})


def order_velocity(spark, sf_dir):
    """Day-scale windows over customers' orders."""
    orders = table(spark, sf_dir, "orders")
    cols = TxnColumns(key="o_custkey", time="o_orderdate", id="o_orderkey", amount="o_totalprice")
    rows = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    out = history_features(rows, cols, windows={"30d": 30 * 86400, "365d": 365 * 86400}, max_gap=365 * 86400)
    return rounded(out.drop("o_orderdate"))


def txn_features(spark, sf_dir):
    return rounded(add_transaction_features(transactions(spark, sf_dir)).select(*ROW_COLUMNS))


def clean_events(spark, sf_dir):
    raw = transactions(spark, sf_dir).withColumns({"first": F.lit("x"), "zip": F.lit("0")})
    out = clean(raw)
    return out.select("trans_num", "merchant", F.lit(",".join(sorted(out.columns))).alias("columns_left"))


def to_event_rows(spark, sf_dir):
    return rounded(to_event(transactions(spark, sf_dir)))


def to_label_event_rows(spark, sf_dir):
    return to_label_event(transactions(spark, sf_dir))


def iso_round_trip(spark, sf_dir):
    """Event time to ISO text, back to a timestamp, to microseconds and back."""
    rows = transactions(spark, sf_dir).select("trans_num", iso_time(F.col("trans_date_trans_time")).alias("iso"))
    us = epoch_us(parse_iso(F.col("iso")))
    return rows.select("trans_num", "iso", us.alias("us"), iso_time(from_epoch_us(us)).alias("iso_again"))


def _dirty_events(spark, sf_dir):
    """Every rule of the contract is broken by some rows, chosen by arithmetic on the id."""
    n = F.col("transaction_id").cast("long")
    events = to_event(transactions(spark, sf_dir))

    def spoil(column, every, value):
        return F.when(n % every == 0, F.lit(value)).otherwise(F.col(column))

    return events.withColumns(
        {
            "cc_num": spoil("cc_num", 11, ""),
            "amount": F.when(n % 13 == 0, -F.col("amount")).when(n % 17 == 0, F.lit(1000000.5)).otherwise(F.col("amount")),
            "category": spoil("category", 19, "casino"),
            "timestamp": spoil("timestamp", 23, "soon"),
            "customer_dob": spoil("customer_dob", 29, "1985-13-45"),
            "customer_lat": spoil("customer_lat", 31, 200.0),
            "merchant_long": spoil("merchant_long", 37, -180.5),
            "city_pop": spoil("city_pop", 41, None),
        }
    )


def validate_rows(spark, sf_dir):
    checked = with_violations(_dirty_events(spark, sf_dir), CATEGORIES)
    return checked.select(
        "transaction_id",
        (F.size("violations") == 0).alias("valid"),
        F.array_join("violations", ",").alias("violations"),
    )


def violation_counts(spark, sf_dir):
    checked = with_violations(_dirty_events(spark, sf_dir), CATEGORIES)
    return checked.select(F.explode("violations").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def mask_alerts(spark, sf_dir):
    scored = transactions(spark, sf_dir).select(
        "trans_num", F.concat(F.lit("4000"), "cc_num").alias("cc_num"), "score", decide(F.col("score"), 0.5, 0.8).alias("decision")
    )
    return rounded(alerts_feed(scored, "cc_num"))


def decide_rows(spark, sf_dir):
    return transactions(spark, sf_dir).select("trans_num", decide(F.col("score"), 0.5, 0.8).alias("decision"))


def decision_counts(spark, sf_dir):
    return profile.decision_counts(decide_rows(spark, sf_dir))


def _sources(spark, sf_dir):
    rows = transactions(spark, sf_dir).drop("split", "score")
    cut = F.lit(CUT_TEST).cast("timestamp_ntz")
    time = F.col("trans_date_trans_time")
    return rows.where(time < cut), rows.where(time >= cut)


def time_split_summary(spark, sf_dir):
    train, test = _sources(spark, sf_dir)
    rows = time_split(tagged_union({"train": train, "test": test}), CUT_VALIDATION)
    out = profile.split_summary(rows)
    return rounded(
        out.withColumns({c: iso_time(F.col(c)) for c in ("first_time", "last_time")})
    )


def dataset_build(spark, sf_dir):
    return rounded(build_dataset(*_sources(spark, sf_dir), CUT_VALIDATION).drop("trans_date_trans_time"))


def feature_vector(spark, sf_dir):
    return rounded(model_input(build_dataset(*_sources(spark, sf_dir), CUT_VALIDATION), keep=("trans_num",)))


def label_balance(spark, sf_dir):
    return rounded(profile.label_balance(transactions(spark, sf_dir)))


def rate_by_category(spark, sf_dir):
    return rounded(profile.rate_by(transactions(spark, sf_dir), "category", "category"))


def rate_by_hour(spark, sf_dir):
    return rounded(profile.rate_by(transactions(spark, sf_dir), F.hour("trans_date_trans_time"), "hour"))


def rate_by_month(spark, sf_dir):
    """Share of urgent orders per month."""
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_orderdate").alias("trans_date_trans_time"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("is_fraud"),
    )
    out = profile.rate_by_month(rows)
    return rounded(out.withColumn("month", F.col("month").cast("string")))


def card_fraud_profile(spark, sf_dir):
    return rounded(profile.compromised_keys(transactions(spark, sf_dir)).withColumns(
        {"min": F.col("min").cast("long"), "max": F.col("max").cast("long")}))


def fraud_span(spark, sf_dir):
    return rounded(profile.label_span(transactions(spark, sf_dir)))


def fraud_span_spread(spark, sf_dir):
    return rounded(profile.describe(profile.label_span(transactions(spark, sf_dir)), "span_seconds"))


def describe_by_label(spark, sf_dir):
    return rounded(profile.describe(transactions(spark, sf_dir), "amt", ["is_fraud"]))


def log_histogram(spark, sf_dir):
    return rounded(profile.log_histogram(transactions(spark, sf_dir), "amt", "is_fraud"))


def dq_profile(spark, sf_dir):
    rows = _dirty_events(spark, sf_dir).select("transaction_id", "amount", "city_pop", "customer_dob")
    return profile.null_profile(rows)


def feed_checks(spark, sf_dir):
    return rounded(profile.feed_checks(transactions(spark, sf_dir), "trans_date_trans_time"))


def distinct_cards(spark, sf_dir):
    return profile.distinct_keys(transactions(spark, sf_dir), "cc_num")


def confusion_matrix(spark, sf_dir):
    return confusion(transactions(spark, sf_dir))


def confusion_quality_labels(spark, sf_dir):
    """Document length as a score for the quality label."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    scored = rows.select("lang", F.col("quality").alias("is_fraud"), (F.col("n_chars") / 1000.0).alias("score"))
    return confusion(scored, 1.0, by=["lang"])


def pr_curve(spark, sf_dir):
    curve = ranking_curve(transactions(spark, sf_dir))
    return rounded(curve.select("score", "pos", "neg", F.col("run_pos").alias("tp"), F.col("run_neg").alias("fp")))


def evaluate_all(spark, sf_dir):
    return rounded(evaluate(transactions(spark, sf_dir)))


def evaluate_by_category(spark, sf_dir):
    return rounded(evaluate(transactions(spark, sf_dir), 0.6, by=["category"]))


def evaluate_by_week(spark, sf_dir):
    rows = transactions(spark, sf_dir).withColumn("week", week_label(F.col("trans_date_trans_time")))
    return rounded(evaluate(rows, by=["week"]))


def weeks_large_enough(spark, sf_dir):
    rows = transactions(spark, sf_dir).withColumn("week", week_label(F.col("trans_date_trans_time")))
    return rounded(large_enough(rows, "week"))


def split_summary_metrics(spark, sf_dir):
    return rounded(summary_by_split(transactions(spark, sf_dir), 0.6))


def final_summary_table(spark, sf_dir):
    return rounded(final_summary(transactions(spark, sf_dir), 0.6))


def business_cost_row(spark, sf_dir):
    return rounded(business_cost(transactions(spark, sf_dir), 0.6))


def cost_curve_table(spark, sf_dir):
    return rounded(cost_curve(transactions(spark, sf_dir)))


def cost_optimal_threshold(spark, sf_dir):
    return rounded(cost_optimal(transactions(spark, sf_dir)).select("threshold", "total_cost"))


def cost_optimal_by_split(spark, sf_dir):
    return rounded(cost_optimal(transactions(spark, sf_dir), by=["split"]).select("split", "threshold", "total_cost"))


def cost_sensitivity(spark, sf_dir):
    out = cost_optimal(transactions(spark, sf_dir), SENSITIVITY_COSTS)
    return rounded(out.select("fp_cost", "threshold", "total_cost", "precision", "recall"))


def class_weight_row(spark, sf_dir):
    return rounded(class_weight(transactions(spark, sf_dir)))


def latency_summary(spark, sf_dir):
    return rounded(profile.latency_summary(transactions(spark, sf_dir), "amt", ["category"], time="trans_date_trans_time"))


def latency_sketch(spark, sf_dir):
    """Sketches by category and day, stored, merged to categories: are the ranks of their answers as close as stated?

    Three times the stated error, so that chance does not decide.
    """
    rows = transactions(spark, sf_dir).select("category", F.to_date("trans_date_trans_time").alias("day"), "amt")
    daily = stored(quantile_sketches(rows, "amt", ["category", "day"]), "sketches")
    shares = {"p50": 0.5, "p99": 0.99}
    answers = sketch_quantiles(merge_sketches(daily, ["category"]), shares)
    far = 3 * rank_error()
    both = rows.select("category", "amt").join(answers.select("category", *shares), "category").groupBy("category")
    within = []
    for name, share in shares.items():
        below, upto = F.avg((F.col("amt") < F.col(name)).cast("double")), F.avg((F.col("amt") <= F.col(name)).cast("double"))
        within.append(((below <= share + far) & (upto >= share - far)).alias(f"{name}_close"))
    return both.agg(*within).join(answers.select("category", "n", "parts"), "category")


def busiest_card(spark, sf_dir):
    return rounded(profile.busiest(_history(spark, sf_dir), "card_txn_count_24h", "trans_num").select(
        "trans_num", "cc_num", "card_txn_count_24h"))


def skip_limit(spark, sf_dir):
    return rounded(in_time_order(transactions(spark, sf_dir), skip=1000, limit=2000).select("trans_num", "cc_num", "amt"))


def skip_rest(spark, sf_dir):
    """Everything after the first thousand rows; the time is cut to the day, so the border falls into a tie."""
    rows = transactions(spark, sf_dir, "day")
    return rounded(in_time_order(rows, skip=1000).select("trans_num", "cc_num", "amt"))


def skip_limit_nulls(spark, sf_dir):
    """Every third row has no time and ids are texts; both borders fall into rows without a time."""
    rows = transactions(spark, sf_dir)
    time = F.when(F.col("trans_num") % 3 != 0, F.col("trans_date_trans_time"))
    rows = rows.withColumn("trans_date_trans_time", time).withColumn("trans_num", F.col("trans_num").cast("string"))
    return rounded(in_time_order(rows, skip=500, limit=1000).select("trans_num", "cc_num", "amt"))


def skip_limit_one_time(spark, sf_dir):
    """All rows at one time, so the ids alone decide."""
    rows = transactions(spark, sf_dir).withColumn("trans_date_trans_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    return rounded(in_time_order(rows, skip=1000, limit=2000).select("trans_num", "cc_num", "amt"))


def state_totals(spark, sf_dir):
    """Totals of every card after the train and validation periods."""
    return rounded(snapshot(_past(spark, sf_dir)).totals)


def state_recent(spark, sf_dir):
    return rounded(snapshot(_past(spark, sf_dir)).recent)


def _past(spark, sf_dir, truncate=None):
    return transactions(spark, sf_dir, truncate).where(F.col("split") != "test")


def _live(spark, sf_dir, truncate=None):
    rows = transactions(spark, sf_dir, truncate).where(F.col("split") == "test")
    return rows.select("trans_num", "cc_num", "trans_date_trans_time", "amt")


def continued_history(spark, sf_dir):
    """Features of the test period computed from the state left by the earlier periods."""
    state = snapshot(_past(spark, sf_dir))
    out = history_features(_live(spark, sf_dir), before=state)
    return rounded(out.select("trans_num", "cc_num", *HISTORY_FEATURES))


def parity(spark, sf_dir):
    """Continuing from a state against computing over everything at once."""
    state = snapshot(_past(spark, sf_dir, "hour"))
    online = history_features(_live(spark, sf_dir, "hour"), before=state)
    rows = transactions(spark, sf_dir, "hour").select("trans_num", "cc_num", "trans_date_trans_time", "amt", "split")
    offline = history_features(rows).where(F.col("split") == "test")
    report = parity_report(online, offline, "trans_num", HISTORY_FEATURES)
    return report.select("feature", "compared", "missing_offline", "missing_online", "equal")


def delayed_labels(spark, sf_dir):
    """Labels exist for two thirds of the documents that were scored."""
    scored = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("transaction_id"),
        decide(F.col("n_chars") / (F.col("n_chars") + 1000.0), 0.5).alias("decision"),
    )
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("transaction_id"), F.col("quality").alias("is_fraud")
    )
    return label_join(scored, labels)


def _featured(spark, sf_dir):
    """The prepared table, stored once because the drift reports read it several times."""
    rows = history_features(add_transaction_features(transactions(spark, sf_dir)))
    return stored(rows.withColumn("week", week_label(F.col("trans_date_trans_time"))), "featured")


def _period(df):
    return df.where("split = 'train'"), df.where("split <> 'train'")


def _weeks(current) -> list[str]:
    """Every week of the current period: one name per week, whatever the volume."""
    return sorted(r["week"] for r in current.select("week").distinct().collect())


def drift_numeric(spark, sf_dir):
    reference, current = _period(_featured(spark, sf_dir))
    return rounded(drift_distances(reference, current, "week", _weeks(current), [*DRIFT_NUMERIC, "score"], []))


def drift_categorical(spark, sf_dir):
    reference, current = _period(_featured(spark, sf_dir))
    return rounded(drift_distances(reference, current, "week", _weeks(current), [], DRIFT_CATEGORICAL))


def drift_share_by_week(spark, sf_dir):
    reference, current = _period(_featured(spark, sf_dir))
    moved = inject_drift(current, "trans_date_trans_time", "2024-01-23", 1.8)
    distances = drift_distances(reference, moved, "week", _weeks(moved), DRIFT_NUMERIC, DRIFT_CATEGORICAL)
    out = drift_share(distances)
    return rounded(out.withColumn("drifted_features", F.array_join("drifted_features", ",")))


def drift_inject(spark, sf_dir):
    moved = inject_drift(_featured(spark, sf_dir), "trans_date_trans_time", "2024-01-23", 1.8)
    return rounded(moved.select("trans_num", "amt", "log_amt", "card_amt_sum_1h", "card_amt_sum_24h", "amt_vs_card_mean"))


def drift_lineitem(spark, sf_dir):
    """Shipping years against the first one."""
    year = F.year("l_shipdate").cast("string")
    rows = table(spark, sf_dir, "lineitem").select(
        F.when(year != "1995", year).alias("year"), "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus",
    )
    years = [str(y) for y in range(1996, 2002)]
    numeric = numeric_drift(rows, "year", years, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(numeric.unionByName(categorical_drift(rows, "year", years, ["l_returnflag", "l_linestatus"])))


def weekly_alerts(spark, sf_dir):
    reference, current = _period(_featured(spark, sf_dir))
    moved = inject_drift(current, "trans_date_trans_time", "2024-01-23", 1.8)
    return weekly_report(reference, moved, DRIFT_NUMERIC, DRIFT_CATEGORICAL)


def weekly_alert_summary(spark, sf_dir):
    return alert_summary(weekly_alerts(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "card_history": card_history,
    "card_history_ties": card_history_ties,
    "card_history_hot_keys": card_history_hot_keys,
    "card_history_sliced_ties": card_history_sliced_ties,
    "card_history_custom_windows": card_history_custom_windows,
    "order_velocity": order_velocity,
    "txn_features": txn_features,
    "clean_events": clean_events,
    "to_event": to_event_rows,
    "to_label_event": to_label_event_rows,
    "iso_round_trip": iso_round_trip,
    "validate_rows": validate_rows,
    "violation_counts": violation_counts,
    "mask_alerts": mask_alerts,
    "decide": decide_rows,
    "decision_counts": decision_counts,
    "time_split_summary": time_split_summary,
    "dataset_build": dataset_build,
    "feature_vector": feature_vector,
    "label_balance": label_balance,
    "rate_by_category": rate_by_category,
    "rate_by_hour": rate_by_hour,
    "rate_by_month": rate_by_month,
    "card_fraud_profile": card_fraud_profile,
    "fraud_span": fraud_span,
    "fraud_span_spread": fraud_span_spread,
    "describe_by_label": describe_by_label,
    "log_histogram": log_histogram,
    "dq_profile": dq_profile,
    "feed_checks": feed_checks,
    "distinct_cards": distinct_cards,
    "confusion": confusion_matrix,
    "confusion_quality_labels": confusion_quality_labels,
    "pr_curve": pr_curve,
    "evaluate": evaluate_all,
    "evaluate_by_category": evaluate_by_category,
    "evaluate_by_week": evaluate_by_week,
    "weeks_large_enough": weeks_large_enough,
    "split_metrics": split_summary_metrics,
    "final_summary": final_summary_table,
    "business_cost": business_cost_row,
    "cost_curve": cost_curve_table,
    "cost_optimal_threshold": cost_optimal_threshold,
    "cost_optimal_by_split": cost_optimal_by_split,
    "cost_sensitivity": cost_sensitivity,
    "class_weight": class_weight_row,
    "latency_summary": latency_summary,
    "latency_sketch": latency_sketch,
    "busiest_card": busiest_card,
    "skip_limit": skip_limit,
    "skip_rest": skip_rest,
    "skip_limit_nulls": skip_limit_nulls,
    "skip_limit_one_time": skip_limit_one_time,
    "state_totals": state_totals,
    "state_recent": state_recent,
    "continued_history": continued_history,
    "parity_report": parity,
    "label_join": delayed_labels,
    "drift_numeric": drift_numeric,
    "drift_categorical": drift_categorical,
    "drift_share": drift_share_by_week,
    "drift_inject": drift_inject,
    "drift_lineitem": drift_lineitem,
    "weekly_alerts": weekly_alerts,
    "weekly_alert_summary": weekly_alert_summary,
}
