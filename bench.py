"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``.  Every query is written to the noop
sink, so all of its rows and columns are computed.  Each runs twice and the
second run counts: the first one warms the JVM and its code cache.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = [
    "peer_funnel", "stage2_financial", "stage3_similarity", "stage4_requirements", "scenario_valuation",
    "income_verdict", "companies_by_code", "lookup_code", "keyword_industry", "distinct_peers", "expand_pool",
    "dedupe_first", "reference_prep", "section_ffill", "document_bundle", "table_text", "main_text", "page_elements",
    "validate_claims", "evidence_score", "funding_timeline", "merge_sections", "patch_merge", "schema_violations",
    "text_key", "clean_text", "format_statement", "amount_range",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from peerglass.plans import QUERIES
    from peerglass.session import build_session

    spark = build_session("peerglass-bench", master=f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    seconds = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
