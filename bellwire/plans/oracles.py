"""The same results in DuckDB SQL, written from the definitions, not from the plans."""

from __future__ import annotations

SEP = r"[^\p{L}\p{N}]+"

CTE = {
    "bars_ev": """
bars_ev AS (
  SELECT 'sh' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS symbol, CAST(ts AS DATE) AS date,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)""",
    "bars_li": """
li AS (
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
         l_extendedprice / l_quantity AS price, l_quantity,
         row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS k
  FROM lineitem JOIN part ON l_partkey = p_partkey),
bars_li AS (
  SELECT symbol, date, arg_min(price, k) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, k) AS close, CAST(sum(l_quantity) AS DOUBLE) AS volume
  FROM li GROUP BY 1, 2)""",
    "news": """
news AS (
  SELECT DISTINCT o_orderkey AS news_id,
         o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INTEGER)) AS news_time,
         p_brand AS symbol
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey)""",
    "news_docs": """
news_docs AS (
  SELECT doc_id, 'src' || CAST(doc_id % 3 AS VARCHAR) AS feed,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((doc_id * 37) % 43200 AS INTEGER)) AS news_time,
         split_part(text, chr(10), 1) AS news_title, text AS news_article
  FROM documents)""",
    "feed_items": """
feed_items AS (
  SELECT 'src' || CAST(doc_id % 3 AS VARCHAR) AS feed, -doc_id AS position, doc_id,
         CASE WHEN doc_id % 10 = 4 THEN ''
              ELSE strftime(TIMESTAMP '2024-01-01 00:00:00'
                   + to_minutes(CAST((doc_id * 37) % 43200 AS INTEGER)), '%Y-%m-%d %H:%M') END AS news_time
  FROM documents)""",
    "bench_words": f"""
bench_words AS (
  SELECT item_id, token FROM (
    SELECT item_id, unnest(string_split_regex(lower(text), '{SEP}')) AS token FROM benchmark)
  WHERE token <> '')""",
    "names": """
names AS (
  SELECT token AS name, 'sh' || lpad(CAST(max(item_id) AS VARCHAR), 6, '0') AS symbol
  FROM bench_words WHERE length(token) >= 3 GROUP BY token)""",
    "stop_words": """
stop_words AS (
  SELECT token AS word FROM bench_words GROUP BY token HAVING count(*) >= 10)""",
    "doc_tokens": f"""
doc_tokens AS (
  SELECT doc_id, token FROM (
    SELECT doc_id, unnest(string_split_regex(lower(text), '{SEP}')) AS token FROM documents)
  WHERE token <> '' AND token NOT IN (SELECT word FROM stop_words))""",
    "bow": """
bow AS (
  SELECT doc_id, token, count(*) AS tf FROM doc_tokens GROUP BY doc_id, token)""",
    "pairs": f"""
article_words AS (
  SELECT DISTINCT doc_id, token FROM (
    SELECT doc_id, unnest(string_split_regex(lower(news_title || ' ' || news_article), '{SEP}')) AS token
    FROM news_docs)
  WHERE length(token) >= 3 AND token NOT IN (SELECT word FROM stop_words)),
pairs AS (
  SELECT DISTINCT doc_id, symbol FROM article_words JOIN names ON token = name),
linked AS (
  SELECT doc_id, string_agg(symbol, ' ' ORDER BY symbol) AS codes FROM pairs GROUP BY doc_id)""",
    "page_urls": """
page_urls AS (
  SELECT page_id, html, CASE WHEN page_id % 2 = 0 THEN 'https://news.example.com/2024/11/'
      || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || lpad(CAST(page_id % 24 AS VARCHAR), 2, '0')
      || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || CAST(page_id AS VARCHAR) || '.shtml'
    ELSE url END AS url
  FROM pages)""",
    "messages": """
messages AS (
  SELECT doc_id, news_time, news_title, news_article, CASE doc_id % 10
      WHEN 0 THEN 'not json' WHEN 1 THEN '[1,2]'
      WHEN 2 THEN CAST(json_object('news_time', news_time, 'news_article', news_article) AS VARCHAR)
      WHEN 3 THEN CAST(json_object('news_time', news_time, 'news_title', NULL, 'news_article', news_article) AS VARCHAR)
      WHEN 4 THEN CAST(json_object('news_time', news_time, 'news_title', news_title, 'news_article', doc_id) AS VARCHAR)
      ELSE CAST(json_object('news_time', news_time, 'news_title', news_title, 'news_article', news_article) AS VARCHAR)
    END AS value
  FROM (SELECT doc_id, strftime(news_time, '%Y-%m-%d %H:%M') AS news_time, news_title, news_article
        FROM news_docs))""",
    "snapshot": """
snapshot AS (
  SELECT symbol, 'N' || symbol AS name, open, high, low, close AS trade, volume
  FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS back FROM bars_ev)
  WHERE back = 1)""",
    "trades": """
trades AS (
  SELECT o_orderkey AS news_id, 'sh' || lpad(CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey // 10 END AS VARCHAR), 6, '0') AS symbol,
         TIMESTAMP '2023-12-31 00:00:00' + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 32 AS INTEGER))
           + to_minutes(CAST(o_orderkey * 7 % 1440 AS INTEGER)) AS news_time
  FROM orders)""",
    "minute_ticks": """
minute_ticks AS (
  SELECT symbol, date_trunc('minute', ts) AS tick_time, value AS tick_value FROM ticks)""",
    "ticks": """
ticks AS (
  SELECT 'sh' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS symbol, ts, value, event_type FROM events)""",
}

# Bars in order with their returns and the statistics known after each.
STATS = """
ordered AS (
  SELECT symbol, date, close,
         row_number() OVER (PARTITION BY symbol ORDER BY date) AS idx,
         count(*) OVER (PARTITION BY symbol) AS n,
         ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS ret
  FROM {bars} WHERE close IS NOT NULL AND NOT isnan(close) AND close > 0),
stats AS (
  SELECT *, avg(ret) OVER w AS m, stddev_pop(ret) OVER w AS s_pop, stddev_samp(ret) OVER w AS s_samp
  FROM ordered
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

# News with the statistics before it and the bars from it on.
SEEN = """
seen AS (
  SELECT news_id, news_time, news.symbol, coalesce(stats.idx, 0) AS h, stats.m, stats.s_pop, stats.s_samp,
         stats.date AS bar_date, stats.close AS bar_close
  FROM news ASOF LEFT JOIN stats ON news.symbol = stats.symbol AND news.news_time > stats.date)"""

AHEAD = """
sizes AS (SELECT symbol, max(n) AS n FROM ordered GROUP BY symbol),
ahead AS (
  SELECT seen.*, horizon, coalesce(greatest(least(sizes.n - h, horizon + 1), 0), 0) AS bars_ahead,
         f.close AS first_close, l.close AS last_close
  FROM seen CROSS JOIN (SELECT unnest([{horizons}]) AS horizon)
  LEFT JOIN sizes ON seen.symbol = sizes.symbol
  LEFT JOIN ordered f ON seen.symbol = f.symbol AND f.idx = h + 1
  LEFT JOIN ordered l ON seen.symbol = l.symbol AND l.idx = least(h + 1 + horizon, sizes.n) AND sizes.n > h)"""

LABEL = """CASE WHEN bars_ahead < 2 OR h < 2 THEN 'neutral'
       WHEN ln(last_close / first_close) > m + s_pop THEN 'good'
       WHEN ln(last_close / first_close) < m - s_pop THEN 'bad' ELSE 'neutral' END AS label"""

WITHIN = """
within AS (
  SELECT seen.news_id, seen.symbol, seen.news_time, any_value(h) AS h, any_value(m) AS m,
         any_value(s_samp) AS s_samp, count(o.date) AS bars_ahead,
         arg_min(o.close, o.date) AS first_close, arg_max(o.close, o.date) AS last_close
  FROM seen LEFT JOIN ordered o ON seen.symbol = o.symbol
   AND o.date >= seen.news_time AND o.date < seen.news_time + INTERVAL 15 DAY
  GROUP BY 1, 2, 3)"""


def sql(body: str, *parts: str) -> str:
    """A query over named CTEs or CTE texts."""
    return "WITH " + ",".join(CTE.get(p, p) for p in parts) + "\n" + body


def r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"


def text_of(html: str, pattern: str) -> str:
    """Inside of the first match, comments and tags removed, entities decoded."""
    inside = f"regexp_extract({html}, '{pattern}', 1)"
    bare = f"regexp_replace(regexp_replace({inside}, '(?s)<!--.*?-->', '', 'g'), '<[^>]*>', '', 'g')"
    for entity, plain in (
        ("&nbsp;", "' '"), ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"),
        ("&#39;", "chr(39)"), ("&amp;", "'&'"),
    ):
        bare = f"replace({bare}, '{entity}', {plain})"
    return bare


LI_STATS = STATS.format(bars="bars_li")
EV_STATS = STATS.format(bars="bars_ev")
BAR = ["open", "high", "low", "close", "volume"]

HAN_WORDS = f"""
WITH RECURSIVE bench AS (
  SELECT DISTINCT token FROM (
    SELECT unnest(string_split_regex(lower(text), '{SEP}')) AS token FROM benchmark)
  WHERE regexp_full_match(token, '[a-z]{{2,}}')
), dict AS (
  SELECT DISTINCT translate(CASE WHEN length(token) <= 6 THEN token ELSE substr(token, 1, 3) END,
    'abcdefghijklmnopqrstuvwxyz', '的一是在不了有和人这中大为上个国我以要他时来用们生到') AS word
  FROM bench
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', '的一是在不了有和人这中大为上个国我以要他时来用们生到'), '[一-龥]+')) AS run FROM documents
), runs_ AS (SELECT DISTINCT run FROM runs
), places AS (
  SELECT run, unnest(range(1, length(run) + 1)) AS pos FROM runs_
), tried AS (
  SELECT run, pos, n FROM places, (SELECT DISTINCT length(word) AS n FROM dict) WHERE pos + n <= length(run) + 1
), best AS (
  SELECT places.run, places.pos, coalesce(max(n), 1) AS n
  FROM places LEFT JOIN (SELECT run, pos, n FROM tried JOIN dict ON substr(run, pos, n) = word) AS f
    ON places.run = f.run AND places.pos = f.pos
  GROUP BY 1, 2
), seg AS (
  SELECT run, CAST(1 AS BIGINT) AS pos FROM runs_
  UNION ALL
  SELECT seg.run, seg.pos + n FROM seg JOIN best ON seg.run = best.run AND seg.pos = best.pos WHERE seg.pos + n <= length(seg.run)
)
SELECT doc_id, substr(seg.run, seg.pos, n) AS word, count(*) AS n
FROM seg JOIN best ON seg.run = best.run AND seg.pos = best.pos JOIN runs ON runs.run = seg.run
GROUP BY 1, 2
"""

ORACLES: dict[str, str] = {
    "scan_filter_project": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_totalprice > 100000 ORDER BY o_orderkey LIMIT 1000""",
    "paged_scan_dropna": """
SELECT * FROM (
  SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
  WHERE lang = 'en' ORDER BY d.doc_id LIMIT 500 OFFSET 20)
WHERE quality IS NOT NULL""",
    "multi_source_union": """
SELECT doc_id AS item_id, lang, n_chars, 'articles' AS source, CAST(NULL AS BIGINT) AS turn,
       CAST(NULL AS VARCHAR) AS role, CAST(NULL AS VARCHAR) AS url FROM documents
UNION ALL SELECT conv_id, NULL, NULL, 'talks', turn, role, NULL FROM conversations
UNION ALL SELECT page_id, NULL, NULL, 'pages', NULL, NULL, url FROM pages""",
    "csv_bars": sql("SELECT symbol, date, open, high, low, close, volume FROM bars_ev", "bars_ev"),
    "naive_timestamp": "SELECT o_orderkey, o_orderdate AS date FROM orders",
    "keyed_update": """
SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NULL THEN d.source WHEN toxic = 1 THEN NULL
       ELSE 'checked' END AS source, d.n_chars, l.quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "to_json_payload": sql(
        """SELECT doc_id, strftime(news_time, '%Y-%m-%d %H:%M') AS news_time, news_title,
       md5(news_article) AS article_md5 FROM news_docs""",
        "news_docs",
    ),
    "snapshot_to_bar": sql(
        """SELECT symbol, DATE '2024-02-01' AS date, open, high, low, trade AS close, volume
FROM snapshot""",
        "bars_ev", "snapshot",
    ),
    "stock_dimension": sql("SELECT DISTINCT name, symbol FROM snapshot", "bars_ev", "snapshot"),
    "news_regex_search": sql(
        """SELECT doc_id, news_time, news_title FROM news_docs
WHERE regexp_matches(news_article, '(ing|tion)[^a-z]+the')""",
        "news_docs",
    ),
    "id_semi_join": """
SELECT doc_id, lang, source, n_chars FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "incremental_bars": sql(
        """SELECT b.symbol, b.date, open, high, low, close, volume FROM bars_ev b LEFT JOIN (
    SELECT symbol, max(CAST(ts AS DATE)) AS latest FROM ticks
    WHERE event_type = 'purchase' AND value > 50 GROUP BY 1) s ON b.symbol = s.symbol
WHERE coalesce(latest, DATE '2000-01-01') < DATE '2024-01-26'
  AND b.date > coalesce(latest, DATE '2000-01-01')""",
        "bars_ev", "ticks",
    ),
    "feed_cutoff": sql(
        """SELECT feed, position, doc_id, news_time FROM (
  SELECT *, sum(CASE WHEN news_time <> '' AND news_time <= '2024-01-10 00:00' THEN 1 ELSE 0 END)
         OVER (PARTITION BY feed ORDER BY position) AS stops FROM feed_items)
WHERE stops = 0""",
        "feed_items",
    ),
    "feed_cap": sql(
        """SELECT feed, news_id, symbol, news_time FROM (
  SELECT 'src' || CAST(news_id % 3 AS VARCHAR) AS feed, news_id, symbol, news_time,
         row_number() OVER (PARTITION BY news_id % 3 ORDER BY news_time DESC, news_id, symbol) AS r
  FROM news) WHERE r <= 10000""",
        "news",
    ),
    "after_close_snapshot": sql(
        """SELECT symbol, CAST(ts AS DATE) AS date, min(ts) AS ts, arg_min(value, ts) AS value
FROM ticks WHERE strftime(ts, '%H:%M:%S') >= '15:30:00' GROUP BY 1, 2""",
        "ticks",
    ),
    "tokens_no_stop": sql(
        """SELECT doc_id, CAST(count(*) AS BIGINT) AS n_tokens, count(DISTINCT token) AS n_distinct,
       min(token) AS first_token, max(token) AS last_token FROM doc_tokens GROUP BY doc_id""",
        "bench_words", "stop_words", "doc_tokens",
    ),
    "token_symbol_join": sql(
        f"""SELECT conv_id, turn, token, symbol, count(*) AS hits FROM (
    SELECT conv_id, turn, unnest(string_split_regex(lower(text), '{SEP}')) AS token
    FROM conversations) JOIN names ON token = name GROUP BY 1, 2, 3, 4""",
        "bench_words", "names",
    ),
    "stock_mentions": sql(
        "SELECT doc_id, codes FROM linked",
        "bench_words", "names", "stop_words", "news_docs", "pairs",
    ),
    "relevant_symbols": sql(
        """SELECT news_id AS doc_id, string_agg(symbol, ' ' ORDER BY symbol) AS codes
FROM news GROUP BY news_id""",
        "news",
    ),
    "link_writeback": sql(
        """SELECT d.doc_id, feed, news_time, codes, md5(news_article) AS article_md5
FROM news_docs d LEFT JOIN linked l ON d.doc_id = l.doc_id""",
        "bench_words", "names", "stop_words", "news_docs", "pairs",
    ),
    "news_for_symbol": sql(
        """SELECT d.doc_id, news_time, news_title, codes
FROM news_docs d JOIN linked l ON d.doc_id = l.doc_id
WHERE d.doc_id IN (SELECT doc_id FROM pairs WHERE symbol = 'sh000007')""",
        "bench_words", "names", "stop_words", "news_docs", "pairs",
    ),
    "news_symbol_fanout": sql(
        """SELECT doc_id, p.symbol, name, trade FROM pairs p JOIN snapshot s ON p.symbol = s.symbol""",
        "bench_words", "names", "stop_words", "news_docs", "pairs", "bars_ev", "snapshot",
    ),
    "asof_last_bar": sql(
        f"""SELECT news_id, symbol, news_time, bar_date, h AS history, bar_close
FROM seen""",
        "bars_li", "news", LI_STATS, SEEN,
    ),
    "forward_k_bars": sql(
        f"""SELECT news_id, symbol, news_time, bars_ahead, first_close,
       last_close FROM ahead""",
        "bars_li", "news", LI_STATS, SEEN, AHEAD.format(horizons="15"),
    ),
    "range_window_bars": sql(
        f"""SELECT news_id, symbol, news_time, bars_ahead, first_close,
       last_close FROM within""",
        "bars_li", "news", LI_STATS, SEEN, WITHIN,
    ),
    "asof_ticks": sql(
        """SELECT news_id, trades.symbol, news_time, tick_time, tick_value
FROM trades ASOF LEFT JOIN (
  SELECT symbol, tick_time, max(tick_value) AS tick_value FROM minute_ticks GROUP BY 1, 2) AS t
ON trades.symbol = t.symbol AND trades.news_time > t.tick_time""",
        "ticks", "trades", "minute_ticks",
    ),
    "interval_ticks": sql(
        """SELECT news_id, any_value(trades.symbol) AS symbol, count(tick_time) AS n_ticks,
  min({'t': tick_time, 'v': tick_value})['v'] AS first_value, max({'t': tick_time, 'v': tick_value})['v'] AS last_value
FROM trades LEFT JOIN minute_ticks ON trades.symbol = minute_ticks.symbol
  AND tick_time >= news_time AND tick_time < news_time + to_minutes(CAST(news_id % 600 + 1 AS INTEGER))
GROUP BY news_id""",
        "ticks", "trades", "minute_ticks",
    ),
    "distinct_values": """
SELECT DISTINCT 'o_orderstatus' AS tag, o_orderstatus AS value FROM orders WHERE o_orderstatus IS NOT NULL
UNION ALL SELECT DISTINCT 'o_orderpriority', o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL
UNION ALL SELECT DISTINCT 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey IS NOT NULL""",
    "bow": sql(
        "SELECT doc_id, token, tf FROM bow", "bench_words", "stop_words", "doc_tokens", "bow"
    ),
    "dictionary": sql(
        """SELECT token, row_number() OVER (ORDER BY first_doc, token) - 1 AS token_id, df, cf FROM (
  SELECT token, min(doc_id) AS first_doc, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf
  FROM bow GROUP BY token)""",
        "bench_words", "stop_words", "doc_tokens", "bow",
    ),
    "tfidf": sql(
        f"""SELECT doc_id, token, {r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight
FROM (SELECT doc_id, token, tf * idf AS w FROM bow JOIN (
        SELECT token, log2((SELECT count(*) FROM documents) / CAST(count(*) AS DOUBLE)) AS idf
        FROM bow GROUP BY token) USING (token)
      WHERE abs(idf) > 1e-12)
QUALIFY abs(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))) > 1e-12""",
        "bench_words", "stop_words", "doc_tokens", "bow",
    ),
    "standardize_bars": sql(
        "SELECT symbol, date, "
        + ", ".join(
            r6(f"({c} - (SELECT avg({c}) FROM bars_ev)) / (SELECT stddev_samp({c}) FROM bars_ev)")
            + f" AS {c}"
            for c in BAR
        )
        + " FROM bars_ev",
        "bars_ev",
    ),
    "mse_baseline": sql(
        f"""SELECT {r6('avg((close - guess) * (close - guess))')} AS mse, count(guess) AS n FROM (
  SELECT close, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS guess FROM ordered)""",
        "bars_ev", EV_STATS,
    ),
    "accuracy": f"""
SELECT {r6('avg(CASE WHEN (n_chars >= 1000) = (quality = 1) THEN 1.0 ELSE 0.0 END)')} AS accuracy,
       count(*) AS n
FROM documents JOIN labels USING (doc_id)""",
    "high_water": sql(
        """SELECT feed AS key, arg_min(news_time, position) AS latest FROM feed_items
WHERE news_time <> '' GROUP BY feed
UNION ALL SELECT symbol, strftime(max(date), '%Y-%m-%d') FROM bars_ev GROUP BY symbol""",
        "bars_ev", "feed_items",
    ),
    "news_count_by_symbol": sql(
        "SELECT symbol, count(*) AS n_news FROM news GROUP BY symbol", "news"
    ),
    "min_news_gate": sql(
        """SELECT news_id, news_time, symbol FROM news
WHERE symbol IN (SELECT symbol FROM news GROUP BY symbol HAVING count(*) >= 2200)""",
        "news",
    ),
    "log_returns": sql(
        f"SELECT symbol, date, idx, close, {r6('ret')} AS log_return FROM ordered",
        "bars_ev", EV_STATS,
    ),
    "expanding_volatility": sql(
        f"""SELECT symbol, date, idx, {r6('m')} AS mean_return, {r6('s_pop')} AS std_pop,
       {r6('s_samp')} AS std_samp FROM stats""",
        "bars_li", LI_STATS,
    ),
    "forward_return_rows": sql(
        f"""SELECT o.symbol, o.date,
       {r6('CASE WHEN o.n > o.idx THEN ln(l.close / o.close) END')} AS forward_return
FROM ordered o JOIN ordered l ON o.symbol = l.symbol AND l.idx = least(o.idx + 15, o.n)""",
        "bars_li", LI_STATS,
    ),
    "forward_return_range": sql(
        f"""SELECT o.symbol, o.date, count(*) AS bars_ahead,
       {r6('CASE WHEN count(*) >= 2 THEN ln(arg_max(l.close, l.date) / any_value(o.close)) END')} AS forward_return
FROM ordered o JOIN ordered l ON o.symbol = l.symbol AND l.date >= o.date
 AND l.date < o.date + INTERVAL 15 DAY GROUP BY 1, 2""",
        "bars_li", LI_STATS,
    ),
    "bar_features": sql(
        f"""SELECT symbol, date, {r6('high - low')} AS price_range,
       {r6('(close - open) / nullif(open, 0)')} AS price_change_percentage FROM bars_ev""",
        "bars_ev",
    ),
    "bar_feature_vectors": sql(
        "SELECT symbol, date, "
        + ", ".join(
            r6(f"({c} - (SELECT avg({c}) FROM bars_ev)) / (SELECT stddev_samp({c}) FROM bars_ev)")
            + f" AS f{i}"
            for i, c in enumerate(BAR)
        )
        + f""", {r6('high - low')} AS f5, {r6('(close - open) / open')} AS f6
FROM bars_ev WHERE open <> 0""",
        "bars_ev",
    ),
    "calendar_parts": sql(
        """SELECT symbol, date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(day(date) AS INTEGER) AS day FROM bars_ev""",
        "bars_ev",
    ),
    "daily_bar_dedup": sql(
        """SELECT symbol, CAST(ts AS DATE) AS date, arg_min(value, ts) AS value,
       count(*) - 1 AS dropped FROM ticks GROUP BY 1, 2""",
        "ticks",
    ),
    "page_numbers": """
SELECT o_orderkey, o_custkey,
       CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 3000 AS BIGINT) AS page FROM orders""",
    "url_time": sql(
        r"""SELECT page_id, CASE WHEN regexp_matches(url, '/\d{4}/\d{2}/\d{6}')
  THEN regexp_replace(regexp_extract(url, '/\d{4}/\d{2}/\d{6}'),
       '/(\d{4})/(\d{2})/(\d{2})(\d{2})(\d{2})', '\1-\2-\3 \4:\5') ELSE '' END AS news_time
FROM page_urls""",
        "page_urls",
    ),
    "date_parse_format": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M') AS minute_text,
       date_trunc('minute', o_orderdate) AS minute, CAST(o_orderdate AS DATE) AS day,
       strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day FROM orders""",
    "recent_weekday": """
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
  CAST(CAST(o_orderdate AS DATE) - CASE isodow(o_orderdate) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS DATE)
  AS weekday FROM orders""",
    "strip_newlines": """
SELECT doc_id, md5(replace(replace(text, chr(10), ''), chr(13), '')) AS flat_md5,
  CAST(length(replace(replace(text, chr(10), ''), chr(13), '')) AS INTEGER) AS n_chars FROM documents""",
    "contains_han": """
SELECT doc_id, regexp_matches(text || CASE WHEN doc_id % 7 = 0 THEN '股' ELSE '' END, '[一-龥]') AS han
FROM documents""",
    "html_article_text": sql(
        f"""SELECT page_id, CAST(length(t) AS INTEGER) AS n_chars, md5(t) AS text_md5 FROM (
  SELECT page_id, {text_of('html', '(?s)<article[^>]*>(.*?)</article>')} AS t FROM page_urls)""",
        "page_urls",
    ),
    "html_container_text": sql(
        f"""SELECT page_id, {text_of('html', '(?s)<div class="ad">(.*?)</div>')} AS text
FROM page_urls""",
        "page_urls",
    ),
    "html_links": """
SELECT page_id, CAST(i - 1 AS INTEGER) AS position, links[i] AS href FROM (
  SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM (
    SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages))""",
    "sparse_to_dense": sql(
        """SELECT symbol, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ' ' ORDER BY h) AS dense FROM (
    SELECT symbol, unnest(range(0, 24)) AS h FROM (SELECT DISTINCT symbol FROM ticks)) LEFT JOIN (
    SELECT symbol, hour(ts) AS h, count(*) AS n FROM ticks GROUP BY 1, 2) USING (symbol, h)
GROUP BY symbol""",
        "ticks",
    ),
    "tokenize": f"""
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS position, token
FROM (SELECT doc_id, words[i] AS token, i FROM (
        SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM (
          SELECT doc_id, string_split_regex(lower(text), '{SEP}') AS words FROM documents)))
WHERE token <> ''""",
    "han_words": HAN_WORDS,
    "han_words_batches": HAN_WORDS,
    "hash_split": """
SELECT doc_id, b AS bucket, CASE WHEN b < 80 THEN 'train' ELSE 'test' END AS part FROM (
  SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 AS b
  FROM documents)""",
    "stream_parse": sql(
        """SELECT doc_id, CASE WHEN k > 1 THEN news_time END AS news_time,
       CASE WHEN k > 3 THEN news_title END AS news_title,
       CASE WHEN k = 4 THEN md5(CAST(doc_id AS VARCHAR)) WHEN k > 1 THEN md5(news_article) END AS article_md5
FROM (SELECT *, doc_id % 10 AS k FROM messages)""",
        "news_docs", "messages",
    ),
    "stream_validate": sql(
        """SELECT doc_id, CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT'
  THEN len(list_intersect(json_keys(value), ['news_time', 'news_title', 'news_article'])) = 3
  ELSE false END AS shape_ok FROM messages""",
        "news_docs", "messages",
    ),
    "stream_clean_batch": sql(
        """SELECT doc_id, news_time, CASE WHEN doc_id % 10 <> 3 THEN news_title END AS news_title,
  md5(replace(replace(json_extract_string(value, '$.news_article'), chr(10), ''), chr(13), '')) AS article_md5
FROM messages WHERE CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT'
  THEN len(list_intersect(json_keys(value), ['news_time', 'news_title', 'news_article'])) = 3
   AND json_type(value, '$.news_article') = 'VARCHAR' ELSE false END""",
        "news_docs", "messages",
    ),
    "stream_dead_letter": sql(
        """SELECT doc_id, reason, CAST(length(value) AS INTEGER) AS n_chars FROM (
  SELECT doc_id, value, CASE WHEN NOT json_valid(value) THEN 'bad_json'
    WHEN json_type(value) <> 'OBJECT' THEN 'not_object'
    WHEN len(list_intersect(json_keys(value), ['news_time', 'news_title', 'news_article'])) < 3 THEN 'missing_key'
    WHEN json_type(value, '$.news_article') <> 'VARCHAR' THEN 'bad_type' END AS reason FROM messages)
WHERE reason IS NOT NULL""",
        "news_docs", "messages",
    ),
    "label_news_rows": sql(
        f"SELECT news_id, news_time, symbol, {LABEL} FROM ahead",
        "bars_li", "news", LI_STATS, SEEN, AHEAD.format(horizons="15"),
    ),
    "label_multi_horizon": sql(
        f"SELECT news_id, symbol, CAST(horizon AS INTEGER) AS horizon, {LABEL} FROM ahead",
        "bars_li", "news", LI_STATS, SEEN, AHEAD.format(horizons="3, 5, 10, 15, 30, 60"),
    ),
    "label_news_calendar": sql(
        """SELECT news_id, news_time, symbol, CASE WHEN h >= 2 AND bars_ahead >= 2
  AND ln(last_close / first_close) > m + s_samp THEN 1 ELSE 0 END AS label FROM within""",
        "bars_li", "news", LI_STATS, SEEN, WITHIN,
    ),
    "labelled_news_export": sql(
        f"""SELECT d.doc_id, a.symbol, d.news_time, news_title, md5(news_article) AS article_md5, {LABEL}
FROM ahead a JOIN news_docs d ON d.doc_id = a.news_id""",
        "bench_words", "names", "stop_words", "news_docs", "pairs", "bars_ev",
        "news AS (SELECT doc_id AS news_id, news_time, symbol FROM pairs JOIN news_docs USING (doc_id))",
        EV_STATS, SEEN, AHEAD.format(horizons="15"),
    ),
}
