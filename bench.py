"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from maskloom.plans import catalogue
from maskloom.session import local_session

HEADLINE = [
    "redact_documents", "pseudonymize_documents", "pii_rollup", "include_exclude_terms", "redact_pages",
    "pseudonymize_notes", "pseudonymize_turns", "correspondence_table", "restore_replies", "round_trip", "leak_scan",
    "dictionary_spans", "name_pseudonyms", "link_mentions", "restore_runs", "page_assemble",
    "job_summary", "job_keys", "dedupe_jobs", "match_slots", "latest_status", "job_watch", "page_usage",
    "call_log_summary", "safe_urls", "redirect_audit", "stream_redact",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    names = os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    # One small run starts the JVM's and the Python workers' machinery.
    catalogue.QUERIES["redact_documents"](spark, sf_dir).limit(10).collect()
    seconds, rates = {}, {}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in names:
        start = time.perf_counter()
        catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if name in ("redact_documents", "pseudonymize_documents", "round_trip"):
            rates[name] = round(docs / seconds[name], 1)
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "documents_per_sec": rates, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
