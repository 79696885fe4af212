"""Time the headline queries and print one JSON line.

Data: ``$BENCH_SF_DIR``, cores: ``$BENCH_CPUS``. Every query runs in full into a sink
that discards rows, once to warm up and once for the time.
"""

from __future__ import annotations

import json
import os
import time

from docfacts.plans.catalog import QUERIES
from docfacts.session import local_session

HEADLINE = (
    "occurrences_by_region",
    "resolve_occurrences",
    "resolve_stats",
    "search_occurrences",
    "lookup_extraction",
    "intake_status",
    "intake_summary",
    "intake_registry",
    "chunk_documents",
    "vector_topk_global",
    "vector_topk_scoped",
    "retrieval_context",
    "validate_records",
    "parse_model_output",
    "retry_outcomes",
    "attempt_admission",
    "extraction_upsert",
    "eval_summary",
    "quality_score",
    "synth_reports",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "docfacts-bench")
    times = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
