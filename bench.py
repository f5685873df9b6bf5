"""Times queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every result is computed in full and thrown away (noop sink). Arguments name the queries to run; ``all``
runs every registered one.
"""

from __future__ import annotations

import importlib
import json
import os
import sys
import time

HEADLINE = [
    "postings", "term_statistics", "preset_text_en", "preset_text_en_splitting", "boolean_and", "phrase_match",
    "wildcard_match", "top_documents", "top_documents_bm25", "result_page", "facet_hits", "facet_fields", "facet_pivot",
    "field_stats_by_facet", "group_results", "drill_down", "document_index", "apply_changes", "deduplicate", "snippets",
    "more_like_this", "spelling", "cluster_phrases", "browse_list",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from lexshelf.session import local_session

    spark = local_session(cpus, "bench")
    queries = importlib.import_module("__spark_entry__").queries()
    names = list(queries) if sys.argv[1:] == ["all"] else (sys.argv[1:] or HEADLINE)
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
