"""Time the headline shapes; prints one JSON line.

BENCH_SF_DIR  folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up, best counts (default 2)
BENCH_SHARED  folder for intermediate tables (default: a new temporary one)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cornerstore import queries as q  # noqa: E402
from cornerstore.operators import history, merge, metrics, star  # noqa: E402
from cornerstore.plans.inputs import order_lines, table  # noqa: E402
from cornerstore.session import build_session, drop_intermediate, write_and_reread  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "cornerstore-bench", f"local[{cpus}]", int(cpus),
        {
            "spark.driver.memory": "8g", "spark.log.level": "ERROR",
            "spark.checkpoint.dir": os.environ.get("BENCH_SHARED") or tempfile.mkdtemp(prefix="cornerstore-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    # Gold shapes start from stored Silver, as the pipeline does.
    silver = write_and_reread(q._silver(spark, folder), "bench-silver")
    lake = q._lake(spark, folder)
    target = write_and_reread(q._lake_latest(lake.filter("quantity >= 25")), "bench-target")
    source = write_and_reread(q._lake_latest(lake.filter("quantity < 25")), "bench-source")
    sales = write_and_reread(q._lake_latest(lake), "bench-sales")
    products = write_and_reread(metrics.product_sales(silver, q.stamp(), True), "bench-products")
    events = table(spark, folder, "events")
    shapes = {
        "raw_view": lambda: order_lines(spark, folder),
        "incremental_scan": lambda: q.incremental_scan(spark, folder),
        "silver": lambda: q.dedup_latest(spark, folder),
        "gold_category": lambda: metrics.category_sales(silver, q.stamp(), True),
        "gold_product": lambda: metrics.product_sales(silver, q.stamp(), True),
        "gold_customer": lambda: metrics.customer_sales(silver, q.stamp(), True),
        "gold_grouping_sets": lambda: metrics.kpis_in_one_pass(silver, q.stamp(), True),
        "rank_products": lambda: metrics.rank_products(products),
        "merge_upsert": lambda: merge.merge_newer(target, source, ["order_id"], ["updated_at"]),
        "scd2_events": lambda: history.scd2(events, ["user_id"], "ts", "event_type = 'error'"),
        "scd2_changes": lambda: q.scd2_history(spark, folder),
        "star_dimension": lambda: star.extend_dimension(
            None, star.members(sales, ["customer_name"]), "customer_id", ["customer_name"]
        ),
        "star_fact": lambda: q.star_fact(spark, folder),
        "dq_revenue": lambda: q.dq_revenue(spark, folder),
        "stream_upsert": lambda: q.stream_upsert(spark, folder),
        "cdc_history": lambda: q.stream_scd2(spark, folder),
        "bucket_upsert": lambda: q.bucket_upsert(spark, folder),
        "model_graph": lambda: q.model_graph(spark, folder),
    }
    seconds = {}
    for name, shape in shapes.items():
        times = []
        while len(times) < runs + 1:  # the first is a warm-up
            start = time.perf_counter()
            shape().write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:]), 3)
    drop_intermediate(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
