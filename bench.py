"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Each query is run once to warm up and then twice; the faster of the two counts. Every
row and column is produced. Time includes building the plan and storing what the
query itself stores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bellwire.plans.queries import QUERIES  # noqa: E402
from bellwire.session import build_session  # noqa: E402

HEADLINE = [
    "label_news_rows",
    "label_multi_horizon",
    "label_news_calendar",
    "asof_last_bar",
    "forward_k_bars",
    "range_window_bars",
    "expanding_volatility",
    "stock_mentions",
    "labelled_news_export",
    "link_writeback",
    "bow",
    "dictionary",
    "tfidf",
    "tokenize",
    "stream_clean_batch",
    "stream_dead_letter",
    "html_article_text",
    "html_links",
    "incremental_bars",
    "feed_cutoff",
    "feed_cap",
    "page_numbers",
    "min_news_gate",
    "keyed_update",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bellwire-bench",
        master=f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "20g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs[1:]), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
