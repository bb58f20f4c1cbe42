"""Headline queries, timed: prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local threads), BENCH_RUNS
(timed runs per query, the best counts).
"""

from __future__ import annotations

import json
import os
import sys
import time

from ledgerloom.plans import CATALOG
from ledgerloom.session import build_session

HEADLINE = (
    "ingest_applications", "applications_validated", "successful_applications", "unsuccessful_applications",
    "rejection_histogram", "rejections_by_rule", "membership_id_collision_rows", "dedupe_members",
    "top10_members_by_spending", "top3_items_by_frequency", "transaction_totals", "incremental_totals",
    "totals_reconciliation", "fk_orphans", "pk_duplicates", "check_violations", "price_snapshot_lines",
    "weighted_sample_per_group", "assign_surrogate_ids", "dedupe_images", "latest_status_per_key",
    "uploads_per_hour", "daily_metrics", "retention_manifest", "stream_applications", "stream_uploads_per_hour",
)


def _timed(query, spark, folder: str) -> float:
    start = time.perf_counter()
    # The noop sink computes every row and column without collecting any.
    query.run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus,
                                                        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {n: round(min(_timed(CATALOG[n], spark, folder) for _ in range(runs)), 3) for n in names}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": folder.rsplit("/sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
