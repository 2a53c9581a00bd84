"""SQL of what the sinks and streams must have stored."""

from __future__ import annotations

from bellwire.plans.oracles import ORACLES as BASE
from bellwire.plans.oracles import sql

# White space that is trimmed, as a character class.
BLANK = r"[\s　]"


def stripped(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{BLANK}+', ''), '{BLANK}+$', '')"


ORACLES = {
    # A stream stores what the batch form of its functions gives.
    "stream_ingest_table": BASE["stream_clean_batch"],
    "stream_dead_letter_table": BASE["stream_dead_letter"],
    "stream_offsets": """
SELECT CAST(doc_id % 4 AS INTEGER) AS topic_partition, min(doc_id) AS min_offset,
       max(doc_id) AS max_offset, count(*) AS n
FROM documents GROUP BY 1""",
    "stream_counters": f"""
SELECT CAST(n AS BIGINT) AS messages, n - r AS accepted, r AS refused, bad_json, not_object, missing_key, bad_type
FROM (SELECT count(*) AS r, count(*) FILTER (WHERE reason = 'bad_json') AS bad_json,
        count(*) FILTER (WHERE reason = 'not_object') AS not_object,
        count(*) FILTER (WHERE reason = 'missing_key') AS missing_key,
        count(*) FILTER (WHERE reason = 'bad_type') AS bad_type
      FROM ({BASE["stream_dead_letter"]})), (SELECT count(*) AS n FROM documents)""",
    "stream_high_water": sql(
        """SELECT doc_id, feed, news_time, CAST(doc_id % 2 AS INTEGER) AS batch_id
FROM feed_items LEFT JOIN marks USING (feed)
WHERE doc_id % 2 = 0 OR news_time = '' OR latest IS NULL OR news_time > latest""",
        "feed_items",
        """marks AS (SELECT feed, max(news_time) AS latest FROM feed_items
  WHERE doc_id % 2 = 0 AND news_time <> '' GROUP BY feed)""",
    ),
    "stream_daily_once": sql(
        "SELECT DISTINCT symbol, CAST(ts AS DATE) AS date, CAST(1 AS BIGINT) AS n FROM ticks", "ticks"
    ),
    "append_table": """
SELECT doc_id, lang, source, n_chars, (SELECT count(*) FROM documents) AS n_written FROM documents""",
    "write_once": sql("SELECT symbol, name, open, high, low, trade, volume FROM snapshot", "bars_ev", "snapshot"),
    "by_symbol_table": sql("SELECT news_id, news_time, symbol FROM news", "news"),
    "word_list": sql("SELECT name AS word FROM names", "bench_words", "names"),
    "csv_news": sql(
        """SELECT news_time, md5('"id", ' || CAST(doc_id AS VARCHAR) || chr(10) || news_article || chr(10) || '.') AS article_md5
FROM news_docs""",
        "news_docs",
    ),
    "strip_blank": sql(
        f"""SELECT doc_id, md5(bare) AS title_md5, bare = '' AS blank
FROM (SELECT doc_id, {stripped("' ' || chr(10) || news_title || chr(9) || ' '")} AS bare FROM news_docs)""",
        "news_docs",
    ),
    "model_reload": BASE["bar_feature_vectors"],
    "stored_update": sql(
        """SELECT doc_id, CASE WHEN toxic THEN 'toxic' ELSE feed END AS feed, CASE WHEN NOT toxic THEN news_time END AS news_time,
  md5(news_article) AS article_md5, codes
FROM (SELECT *, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM news_docs) LEFT JOIN linked USING (doc_id)""",
        "bench_words", "names", "stop_words", "news_docs", "pairs",
    ),
}
