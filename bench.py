"""Seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)
# Python workers import the package too, from whatever folder this is started in.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from catalog import batch, learning, streams  # noqa: E402

HEADLINE = {
    "card_history": batch.card_history,
    "card_history_hot_keys": batch.card_history_hot_keys,
    "txn_features": batch.txn_features,
    "dataset_build": batch.dataset_build,
    "evaluate": batch.evaluate_all,
    "evaluate_by_week": batch.evaluate_by_week,
    "cost_curve": batch.cost_curve_table,
    "cost_sensitivity": batch.cost_sensitivity,
    "describe_by_label": batch.describe_by_label,
    "state_totals": batch.state_totals,
    "state_recent": batch.state_recent,
    "weekly_alerts": batch.weekly_alerts,
    "undersample": learning.undersample_rows,
    "skip_limit": batch.skip_limit,
    "nearest_neighbours": learning.neighbours,
    "smote": learning.smote_rows,
    "tomek": learning.tomek,
    "backfill_stream": streams.backfill_stream,
    "stream_scoring": streams.stream_scoring,
}


def consume(df) -> int:
    """Run the whole query; every column takes part and one number comes back."""
    return df.select(F.xxhash64(*df.columns).alias("h")).agg(F.count("h")).first()[0]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    consume(batch.card_history(spark, sf_dir.rsplit("/", 1)[0] + "/sf0.001"))
    seconds, rows = {}, {}
    for name, query in HEADLINE.items():
        started = time.perf_counter()
        rows[name] = consume(query(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
