"""Headline queries, timed end to end; prints one JSON line.

Each query is built and its full result written to the no-op sink, so nothing is
pruned away and nothing is collected. A short warm-up keeps JVM start-up out.
"""

from __future__ import annotations

import json
import os
import time

from ledgerloom.plans.queries import QUERIES, table
from ledgerloom.session import build_session

HEADLINE = (
    "corpus_build", "canonical_records", "exact_dedup", "stratified_split", "turn_history",
    "rule_anomaly", "velocity_24h", "rule_policy", "rule_budget", "rule_batch_budget",
    "parse_response", "eval_by_category", "text_normalize", "prompt_text", "json_context",
    "scenario_generate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    table(spark, folder, "orders").groupBy("o_orderstatus").count().collect()
    spark.range(1000).selectExpr("md5(cast(id AS STRING)) AS h").groupBy("h").count().count()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    documents = table(spark, folder, "documents").count() + table(spark, folder, "conversations").count()
    report = {
        "metric": "headline queries, total seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")),
        "corpus_build_records_per_sec": round(documents / seconds["corpus_build"], 1),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
