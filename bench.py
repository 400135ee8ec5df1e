"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the given tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     set to time every registered query
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from canteiro import build_session  # noqa: E402
from canteiro.queries import REGISTRY  # noqa: E402

HEADLINE = (
    "supplier_metrics",
    "supplier_profile",
    "latest_name",
    "dedup_keep_first",
    "full_row_dedup",
    "upsert_merge",
    "nullable_fk",
    "semi_filter_sum",
    "coverage_by_source",
    "status_distribution",
    "money_parse",
    "date_parse",
    "tax_id_check",
    "fold_match",
    "page_text",
    "enrich_precedence",
    "dump_amendments",
    "current_panel",
    "legacy_panel",
    "map_markers",
    "works_consolidated",
    "contracts_structured",
    "structured_run",
    "features_per_work",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "canteiro-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(REGISTRY) if os.environ.get("BENCH_ALL") else list(HEADLINE)
    names = [name for name in names if name in REGISTRY]
    spark.read.parquet(f"{folder}/orders.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        REGISTRY[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    result = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).replace("sf", ""),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
