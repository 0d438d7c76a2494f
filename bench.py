"""Time the headline queries on whole tables and print one JSON line.

Each given table is one Parquet row group, which Spark reads in one task. So the clock starts after the tables have been copied, row for row, into
files that all cores can read; large tables have many row groups by themselves.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.registry import QUERIES  # noqa: E402
from riskloom.session import build_session  # noqa: E402

HEADLINE = (
    "flagship_clean_profile", "prj_08_detect_language_scored", "fea_01_dangerous_counts", "fea_07_file_summary", "fea_08_family_counts",
    "fea_10_complexity", "rul_07_code_findings", "rul_09_decide", "jn_01_match_rules", "set_02_keep_first", "set_03_drop_leaked",
    "agg_01_source_profile", "agg_05_length_statistics", "agg_08_scan_summary", "spl_04_stratified_split", "spl_05_group_split",
    "txt_01_words", "txt_05_hashing_vectors", "txt_06_vocabulary", "txt_07_tfidf", "evl_03_roc_auc", "evl_07_segment_metrics",
    "evl_08_threshold_sweep", "evl_13_losses", "rul_13_validate_metrics",
)


def copied(spark, sf_dir: str, parts: int) -> str:
    """The same tables, each in ``parts`` files."""
    folder = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(parts).write.parquet(f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.log.level": "ERROR"},
    )
    data = copied(spark, sf_dir, 4 * int(cpus))
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, data).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{times[name]:8.2f}  {name}", file=sys.stderr, flush=True)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
