"""Benchmark: runs the headline queries over whole tables and prints one JSON line.

Every query is computed in full into Spark's ``noop`` sink. The time is the better of two
runs, as the first one also compiles the generated code.
"""

from __future__ import annotations

import json
import os
import sys
import time

from radiolith.plans.catalog import REGISTRY
from radiolith.session import build_session

HEADLINE = (
    "prj_base_metadata",
    "prj_nested_records",
    "prj_summary",
    "val_structural",
    "val_record",
    "val_split",
    "val_manifest",
    "deid_dataset",
    "deid_report",
    "deid_phi_inventory",
    "deid_audit",
    "pipeline_batch",
    "join_merge_metadata",
    "join_object_exists",
    "join_verify_transfer",
    "join_secure_grants",
    "join_pipeline_results",
    "agg_files_by_modality",
    "agg_manifests",
    "agg_manifest_documents",
    "agg_metric_rollup",
    "agg_phi_totals",
    "top_failed_operations",
    "run_list",
    "ret_storage_tiers",
    "src_dicom_headers",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
