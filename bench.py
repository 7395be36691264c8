"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.  Names given on the
command line replace the headline list; ``all`` runs every registered query.
Loading the star that the reports read is timed first, as ``load_star``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tillweave.registered import QUERIES
from tillweave.registered.base import stored_star
from tillweave.session import build_session, clear_scratch

HEADLINE = (
    "clean_union",
    "dim_restaurants",
    "dim_products",
    "dim_customers",
    "surrogate_key",
    "star_load_counts",
    "feed_order_ids",
    "report_chain_comparison",
    "report_monthly_trend",
    "report_season_reindexed",
    "report_top_states",
    "report_products",
    "report_category",
    "report_method_share",
    "report_summary_stats",
    "dash_kpis",
    "dash_monthly",
    "dash_product_table",
    "dash_top_states",
    "report_states_per_chain",
    "fact_sheet",
    "fact_state_share",
    "qa_route",
    "qa_insight",
    "scenario_project",
    "scenario_star_counts",
    "scenario_totals",
    "forecast_predict",
    "forecast_summary",
    "profile_nulls",
    "clean_audit",
)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            # Set for one machine and small tables; a cluster keeps its own.
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()
    chosen = list(QUERIES) if names == ["all"] else names or list(HEADLINE)
    started = time.perf_counter()
    stored_star(spark, sf_dir)
    times = {"load_star": round(time.perf_counter() - started, 3)}
    for name in chosen:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    clear_scratch(spark)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
