"""URL rules with several hosts, judged as the query's SQL judges them."""

from __future__ import annotations

from bellwire.llm import url_rules


def test_advertising_hosts(spark):
    verdicts = {
        "http://ad.x.com/": "block",
        "http://ads.x.com/": "block",
        "http://adserver.x.com/y": "block",
        "http://TRACK.x.com": "block",
        "http://add.x.com/": "allow",
        "http://x.com/ad.track": "allow",
        "http://my.ads.x.com/": "allow",
    }
    df = spark.createDataFrame(list(enumerate(verdicts)), "page_id long, url string")
    assert {r["url"]: r["verdict"] for r in url_rules.judge(df).collect()} == verdicts
