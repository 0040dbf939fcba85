"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores; BENCH_QUERIES=all times
every registered query. Each query runs once unmeasured on the same data first."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from searchshift.plans.catalog import load_all  # noqa: E402
from searchshift.session import build_session  # noqa: E402

HEADLINE = (
    "detection_report", "conversion_plan", "plan_shards", "shard_gaps", "latest_commit",
    "live_files", "missing_files", "map_field_types", "build_mapping", "schema_fields",
    "issue_summary", "segment_health", "index_dirs", "shard_files", "meta_hash", "shard_rollup",
    "conversion_rollup", "repo_index_doc", "index_doc", "shard_snapshot_doc", "shard_index_doc",
    "count_all", "match_text", "term_keyword", "range_numeric", "range_date", "metric_aggs",
    "reconcile_counts", "reconcile_rows", "dataset_stats", "expected_matrix",
    "batch_records", "shard_leaders", "wait_outcome", "matrix_status",
    "write_repository", "copy_files", "verify_checksum", "convert_backups",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    registered = load_all()
    names = registered if os.environ.get("BENCH_QUERIES") == "all" else HEADLINE
    seconds = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            registered[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "headline queries, total time", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))[2:],
        "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
