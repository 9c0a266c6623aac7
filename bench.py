"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from promoledger.queries import registry  # noqa: E402
from promoledger.session import build_session  # noqa: E402

HEADLINE = [
    "monthly_sales",
    "conform_sales",
    "enrich_star",
    "master_restatement",
    "feed_distinct_clean",
    "harmonize_value",
    "loyalty_dedupe",
    "io_proportions",
    "category_share_unpivot",
    "on_invoice",
    "off_invoice_perstr",
    "off_invoice_other",
    "gift_value",
    "daily_promotions",
    "trailing_avg",
    "store_size_band",
    "monthly_on",
    "monthly_off_indicators",
    "control_total_recon",
    "multi_distributor_sites",
    "layer_recon_pct",
    "upsert",
    "restate_returns",
    "month_reload",
    "report_export_read",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "promoledger-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed scan starts the executor threads and the parquet reader.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    timings: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
