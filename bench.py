"""Time headline queries: one JSON line with seconds per query.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [--all]

Results are written to Spark's ``noop`` sink, so every row and column is
computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from garimpo.plans.queries import QUERIES
from garimpo.session import build_session

HEADLINE = [
    "ag_by_source", "ex_listing", "ex_jsonld_listing", "ex_regex_listing", "ex_ad_page_merge",
    "ex_cards_imovelweb", "ex_capture_ads", "ex_truncated_array", "ex_listing_links", "ex_anchors",
    "fn_visible_text", "fn_url_unwrap_redirect", "snk_listing_upsert", "jn_listing_upsert",
    "jn_links_new_only", "flt_pending_links", "ag_queue_stats", "ag_field_coverage",
    "ag_price_stats", "ag_top_cities", "wn_dedup_first_id", "wn_links_per_domain",
    "wn_new_links_per_page", "sl_recent_first", "so_consolidate", "snk_csv", "st_link_first_seen",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if "--all" in sys.argv else HEADLINE
    # Untimed: start-up, code generation and Python workers.
    for warm in ("ag_by_source", "ex_ad_page_merge"):
        QUERIES[warm](spark, folder.replace("sf0.1", "sf0.01")).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").split("sf")[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
