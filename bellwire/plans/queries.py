"""The registered queries: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwire.functions import han
from bellwire.functions import html as H
from bellwire.functions import messages as M
from bellwire.functions import scalars as S
from bellwire.functions import text as T
from bellwire.operators import asof as A
from bellwire.operators import bars as B
from bellwire.operators import han_words as W
from bellwire.operators import labels as L
from bellwire.operators import linking as K
from bellwire.operators import models as P
from bellwire.operators import scans as C
from bellwire.operators import topics as Z
from bellwire.operators import vectors as V
from bellwire.plans import fixtures as X
from bellwire.session import scratch_path, settled, stored
from bellwire.sources import files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r6(c: str | Column) -> Column:
    """Six decimals, without a negative zero."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def rounded(df: DataFrame, plain: list[str], doubles: list[str]) -> DataFrame:
    return df.select(*plain, *[r6(c).alias(c) for c in doubles])


# --- scans and sinks -------------------------------------------------------


@query
def scan_filter_project(spark, d):
    return C.collection_scan(
        X.table(spark, d, "orders"),
        order="o_orderkey",
        where=F.col("o_totalprice") > 100000,
        keys=["o_orderkey", "o_custkey", "o_totalprice"],
        max_rows=1000,
    )


@query
def paged_scan_dropna(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "lang")
    rated = docs.join(X.table(spark, d, "labels"), "doc_id", "left")
    return C.paged_scan(
        rated, ["doc_id", "lang", "quality"], order="doc_id",
        where=F.col("lang") == "en", skip=20, limit=500,
    )


@query
def multi_source_union(spark, d):
    return C.union_sources(
        {
            "articles": X.table(spark, d, "documents").select(
                F.col("doc_id").alias("item_id"), "lang", "n_chars"
            ),
            "talks": X.table(spark, d, "conversations").select(
                F.col("conv_id").alias("item_id"), "turn", "role"
            ),
            "pages": X.table(spark, d, "pages").select(F.col("page_id").alias("item_id"), "url"),
        }
    )


@query
def naive_timestamp(spark, d):
    orders = X.table(spark, d, "orders")
    zone = F.when(F.col("o_orderkey") % 3 == 0, "+08:00").when(
        F.col("o_orderkey") % 3 == 1, "Z"
    ).otherwise("")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), zone)
    return orders.select("o_orderkey", S.naive_timestamp(text).alias("date"))


@query
def keyed_update(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    patch = X.table(spark, d, "labels").select(
        "doc_id",
        F.when(F.col("toxic") == 1, None).otherwise("checked").alias("source"),
        "quality",
    )
    return C.keyed_update(docs, patch, "doc_id")


@query
def to_json_payload(spark, d):
    news = X.news_docs(spark, d).select(
        F.date_format("news_time", "yyyy-MM-dd HH:mm").alias("news_time"),
        "news_title",
        "news_article",
        F.col("doc_id").cast("string").alias("id"),
    )
    sent = M.payload(news)
    fields = F.from_json("value", "id STRING, news_time STRING, news_title STRING, news_article STRING")
    return sent.select(fields.alias("m")).select(
        F.col("m.id").cast("bigint").alias("doc_id"),
        "m.news_time",
        "m.news_title",
        F.md5("m.news_article").alias("article_md5"),
    )


@query
def snapshot_to_bar(spark, d):
    return B.snapshot_to_bar(X.snapshot(spark, d), F.lit("2024-02-01").cast("date"))


@query
def stock_dimension(spark, d):
    return B.stock_dimension(X.snapshot(spark, d))


# --- predicates ------------------------------------------------------------


@query
def news_regex_search(spark, d):
    found = C.regex_search(X.news_docs(spark, d), "news_article", "(ing|tion)[^a-z]+the")
    return found.select("doc_id", "news_time", "news_title")


@query
def id_semi_join(spark, d):
    ids = X.table(spark, d, "labels").where("toxic = 1")
    docs = X.table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return C.members(docs, ids, "doc_id")


@query
def incremental_bars(spark, d):
    stored = X.ticks(spark, d).where(
        (F.col("event_type") == "purchase") & (F.col("value") > 50)
    ).select("symbol", F.to_date("ts").alias("date"))
    return bar_columns(
        B.incremental_bars(X.bars_ev(spark, d), stored, F.lit("2024-01-29").cast("date"))
    )


def bar_columns(bars: DataFrame) -> DataFrame:
    return bars.select("symbol", "date", "open", "high", "low", "close", "volume")


@query
def feed_cutoff(spark, d):
    return C.feed_cutoff(
        X.feed_items(spark, d), "feed", "position", "news_time", F.lit("2024-01-10 00:00")
    )


@query
def feed_cap(spark, d):
    items = X.news(spark, d).select(
        F.concat(F.lit("src"), (F.col("news_id") % 3).cast("string")).alias("feed"),
        "news_id",
        "symbol",
        "news_time",
    )
    newest = [F.col("news_time").desc(), F.col("news_id"), F.col("symbol")]
    return C.feed_cap(items, "feed", newest, cap=10_000)


@query
def after_close_snapshot(spark, d):
    return B.after_close_ticks(X.ticks(spark, d))


@query
def tokens_no_stop(spark, d):
    docs = X.documents(spark, d)
    bow = V.bag_of_words(docs, X.stop_words(spark, d))
    # Counts stand for the repeated tokens themselves.
    return bow.groupBy("doc_id").agg(
        F.sum("tf").alias("n_tokens"), F.count("*").alias("n_distinct"),
        F.min("token").alias("first_token"), F.max("token").alias("last_token"),
    )


# --- joins -----------------------------------------------------------------


@query
def token_symbol_join(spark, d):
    words = X.table(spark, d, "conversations").select(
        "conv_id", "turn", T.tokens(F.col("text")).alias("_words")
    )
    tokens = T.token_rows(words, "_words", "conv_id", "turn")
    return (
        K.token_symbols(tokens, X.names(spark, d))
        .groupBy("conv_id", "turn", "token", "symbol")
        .agg(F.count("*").alias("hits"))
    )


def doc_hits(spark, d, keep=("doc_id",)):
    return K.mention_hits(
        X.news_docs(spark, d), X.names(spark, d), X.stop_words(spark, d), list(keep)
    )


@query
def stock_mentions(spark, d):
    linked = K.relevant_symbols(doc_hits(spark, d))
    return linked.select("doc_id", K.joined_codes(F.col("relevant_symbols")).alias("codes"))


@query
def relevant_symbols(spark, d):
    """Distinct brands of each order."""
    pairs = X.news(spark, d).withColumnRenamed("news_id", "doc_id")
    linked = K.relevant_symbols(pairs)
    return linked.select("doc_id", K.joined_codes(F.col("relevant_symbols")).alias("codes"))


@query
def link_writeback(spark, d):
    docs = X.news_docs(spark, d)
    linked = K.relevant_symbols(doc_hits(spark, d)).select(
        "doc_id", K.joined_codes(F.col("relevant_symbols")).alias("codes")
    )
    written = K.link_writeback(docs, linked)
    return written.select(
        "doc_id", "feed", "news_time", "codes", F.md5("news_article").alias("article_md5")
    )


@query
def news_for_symbol(spark, d):
    linked = K.relevant_symbols(doc_hits(spark, d))
    one = K.news_for_symbol(linked, "sh000007")
    return X.news_docs(spark, d).join(one, "doc_id").select(
        "doc_id", "news_time", "news_title",
        K.joined_codes(F.col("relevant_symbols")).alias("codes"),
    )


@query
def news_symbol_fanout(spark, d):
    linked = K.relevant_symbols(doc_hits(spark, d))
    fanned = K.symbol_fanout(linked)
    return fanned.join(X.snapshot(spark, d), "symbol").select(
        "doc_id", "symbol", "name", "trade"
    )


@query
def asof_last_bar(spark, d):
    joined = A.asof_last_bar(X.news(spark, d), X.bars_li(spark, d))
    return joined.select("news_id", "symbol", "news_time", "bar_date", "history", "bar_close")


@query
def forward_k_bars(spark, d):
    joined = A.forward_k_bars(X.news(spark, d), X.bars_li(spark, d))
    return joined.select(
        "news_id", "symbol", "news_time", "bars_ahead", "first_close", "last_close"
    )


@query
def range_window_bars(spark, d):
    joined = A.range_window_bars(X.news(spark, d), X.bars_li(spark, d))
    return joined.select(
        "news_id", "symbol", "news_time", "bars_ahead", "first_close", "last_close"
    )


@query
def asof_ticks(spark, d):
    """The last tick before each trade, at any time of day; a tick of the same minute is not before it."""
    joined = A.asof_rows(
        X.trades(spark, d), X.minute_ticks(spark, d), "symbol", "news_time", "tick_time", ["tick_time", "tick_value"]
    )
    return joined.select("news_id", "symbol", "news_time", "tick_time", "tick_value")


@query
def interval_ticks(spark, d):
    """Ticks within 1 to 600 minutes from each trade on."""
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("news_id") % 600 + 1).cast("int"))
    asked = X.trades(spark, d).withColumn("until", F.col("news_time") + minutes)
    found = A.interval_stats(
        asked, X.minute_ticks(spark, d), "symbol", "news_time", "until", "tick_time", "tick_value", ["news_id"]
    )
    return found.select(
        "news_id", "symbol", F.col("n").alias("n_ticks"), F.col("first").alias("first_value"), F.col("last").alias("last_value")
    )


# --- aggregates ------------------------------------------------------------


@query
def distinct_values(spark, d):
    return C.distinct_values(
        X.table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"]
    )


@query
def bow(spark, d):
    docs = X.documents(spark, d)
    return V.bag_of_words(docs, X.stop_words(spark, d))


@query
def dictionary(spark, d):
    docs = X.documents(spark, d)
    return V.dictionary(V.bag_of_words(docs, X.stop_words(spark, d)))


@query
def tfidf(spark, d):
    docs = X.documents(spark, d)
    # Tokenising costs far more than reading counts back, and both steps need them.
    counts = stored(V.bag_of_words(docs, X.stop_words(spark, d)), "bow")
    weights = V.tfidf_weights(counts, V.inverse_frequencies(counts, docs))
    return rounded(weights, ["doc_id", "token"], ["weight"])


@query
def standardize_bars(spark, d):
    columns = ["open", "high", "low", "close", "volume"]
    return rounded(B.standardize(X.bars_ev(spark, d), columns), ["symbol", "date"], columns)


@query
def mse_baseline(spark, d):
    lagged = B.log_returns(X.bars_ev(spark, d)).withColumn(
        "guess", F.lag("close").over(B.by_date())
    )
    error = P.mse(lagged.where("guess IS NOT NULL"), "guess", "close")
    return lagged.agg(r6(F.lit(error)).alias("mse"), F.count("guess").alias("n"))


@query
def accuracy(spark, d):
    docs = X.table(spark, d, "documents").select("doc_id", "n_chars")
    guess = F.when(F.col("n_chars") >= 1000, 1).otherwise(0)
    judged = docs.join(X.table(spark, d, "labels"), "doc_id").select(
        guess.cast("double").alias("prediction"), F.col("quality").cast("double").alias("label")
    )
    return judged.agg(r6(F.lit(P.accuracy(judged))).alias("accuracy"), F.count("*").alias("n"))


@query
def high_water(spark, d):
    feeds = C.feed_high_water(X.feed_items(spark, d), "feed", "position", "news_time")
    dates = B.latest_dates(X.bars_ev(spark, d))
    return feeds.select(F.col("feed").alias("key"), "latest").unionByName(
        dates.select(F.col("symbol").alias("key"), F.date_format("latest", "yyyy-MM-dd").alias("latest"))
    )


@query
def news_count_by_symbol(spark, d):
    return X.news(spark, d).groupBy("symbol").agg(F.count("*").alias("n_news"))


@query
def min_news_gate(spark, d):
    return C.min_count_gate(X.news(spark, d), "symbol", 2200)


# --- windows over bars -----------------------------------------------------


@query
def log_returns(spark, d):
    return rounded(
        B.log_returns(X.bars_ev(spark, d)), ["symbol", "date", "idx", "close"], ["log_return"]
    )


@query
def expanding_volatility(spark, d):
    return rounded(
        B.expanding_volatility(X.bars_li(spark, d)),
        ["symbol", "date", "idx"],
        ["mean_return", "std_pop", "std_samp"],
    )


@query
def forward_return_rows(spark, d):
    return rounded(
        B.forward_return_rows(X.bars_li(spark, d)), ["symbol", "date"], ["forward_return"]
    )


@query
def forward_return_range(spark, d):
    return rounded(
        B.forward_return_range(X.bars_li(spark, d)),
        ["symbol", "date", "bars_ahead"],
        ["forward_return"],
    )


@query
def bar_features(spark, d):
    return rounded(
        B.bar_features(X.bars_ev(spark, d)),
        ["symbol", "date"],
        ["price_range", "price_change_percentage"],
    )


@query
def calendar_parts(spark, d):
    return B.calendar_parts(X.bars_ev(spark, d)).select(
        "symbol", "date", "year", "month", "day"
    )


@query
def daily_bar_dedup(spark, d):
    return B.first_per_day(X.ticks(spark, d))


@query
def page_numbers(spark, d):
    orders = X.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return C.page_numbers(orders, "o_orderkey")


# --- scalars ---------------------------------------------------------------


@query
def url_time(spark, d):
    return X.page_urls(spark, d).select("page_id", S.url_time(F.col("url")).alias("news_time"))


@query
def date_parse_format(spark, d):
    text = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm")
    parsed = F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm"))
    return X.table(spark, d, "orders").select(
        "o_orderkey",
        text.alias("minute_text"),
        parsed.alias("minute"),
        F.to_date(parsed).alias("day"),
        F.date_format(F.date_add(F.to_date(parsed), 1), "yyyy-MM-dd").alias("next_day"),
    )


@query
def recent_weekday(spark, d):
    days = X.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day"))
    return days.distinct().select("day", S.recent_weekday(F.col("day")).alias("weekday"))


@query
def strip_newlines(spark, d):
    flat = S.strip_newlines(F.col("text"))
    return X.table(spark, d, "documents").select(
        "doc_id", F.md5(flat).alias("flat_md5"), F.char_length(flat).alias("n_chars")
    )


@query
def contains_han(spark, d):
    text = F.concat("text", F.when(F.col("doc_id") % 7 == 0, "股").otherwise(""))
    return X.table(spark, d, "documents").select("doc_id", S.contains_han(text).alias("han"))


@query
def html_article_text(spark, d):
    pages = X.spread(X.page_urls(spark, d), "page_id")
    text = H.flat_text(F.col("html"), "article")
    return pages.select("page_id", F.char_length(text).alias("n_chars"), F.md5(text).alias("text_md5"))


@query
def html_container_text(spark, d):
    pages = X.spread(X.page_urls(spark, d), "page_id")
    return pages.select("page_id", H.nested_text(F.col("html"), "div", "ad").alias("text"))


@query
def html_links(spark, d):
    pages = X.page_urls(spark, d).select("page_id", H.link_targets(F.col("html"), None).alias("_links"))
    rows = pages.select("page_id", F.posexplode_outer("_links").alias("position", "href"))
    return T.outer_rows(rows, "href")


@query
def sparse_to_dense(spark, d):
    weights = X.ticks(spark, d).groupBy("symbol", F.hour("ts").alias("hour")).agg(
        F.count("*").alias("n")
    )
    dense = V.dense_rows(weights, "symbol", "hour", "n", 24)
    whole = F.transform("dense", lambda v: v.cast("int").cast("string"))
    return dense.select("symbol", F.array_join(whole, " ").alias("dense"))


@query
def tokenize(spark, d):
    docs = X.documents(spark, d).select("doc_id", T.tokens(F.col("text")).alias("_words"))
    rows = docs.select("doc_id", F.posexplode_outer("_words").alias("position", "token"))
    return T.outer_rows(rows, "token")


def word_totals(words: DataFrame) -> DataFrame:
    return words.groupBy("doc_id", "word").agg(F.count("*").alias("n"))


@query
def han_words(spark, d):
    """Chinese words of each document, found by joins with the dictionary."""
    return word_totals(W.han_words(X.han_docs(spark, d), X.han_dictionary(spark, d)))


@query
def han_words_batches(spark, d):
    """The same words, found batch by batch with a dictionary that tasks hold; other words are left out."""
    known = files.bounded_words(X.han_dictionary(spark, d))
    words = X.han_docs(spark, d).select("doc_id", han.segment(spark, F.col("text"), known).alias("_words"))
    return word_totals(
        T.token_rows(words, "_words", "doc_id").withColumnRenamed("token", "word").where(S.contains_han(F.col("word")))
    )


@query
def hash_split(spark, d):
    bucket = S.md5_number(F.col("doc_id")) % 100
    return X.table(spark, d, "documents").select(
        "doc_id", bucket.alias("bucket"),
        F.when(bucket < 80, "train").otherwise("test").alias("part"),
    )


# --- messages --------------------------------------------------------------


@query
def stream_parse(spark, d):
    fields = F.from_json("value", M.SCHEMA)
    parsed = X.messages(spark, d).select("doc_id", fields.alias("m"))
    return parsed.select(
        "doc_id", "m.news_time", "m.news_title", F.md5("m.news_article").alias("article_md5")
    )


@query
def stream_validate(spark, d):
    ok = F.coalesce(F.col("reason") == "bad_type", F.lit(True))
    return M.checked(X.messages(spark, d)).select("doc_id", ok.alias("shape_ok"))


@query
def stream_clean_batch(spark, d):
    return M.clean_news(X.messages(spark, d)).select(
        "doc_id", "news_time", "news_title", F.md5("news_article").alias("article_md5")
    )


@query
def stream_dead_letter(spark, d):
    return M.dead_letters(X.messages(spark, d)).select(
        "doc_id", "reason", F.char_length("value").alias("n_chars")
    )


# --- labels ----------------------------------------------------------------


@query
def label_news_rows(spark, d):
    labelled = L.label_news(X.news(spark, d), X.bars_li(spark, d))
    return labelled.select("news_id", "news_time", "symbol", "label")


@query
def label_multi_horizon(spark, d):
    labelled = L.label_news_horizons(X.news(spark, d), X.bars_li(spark, d))
    return labelled.select("news_id", "symbol", "horizon", "label")


@query
def label_news_calendar(spark, d):
    labelled = L.label_news_calendar(X.news(spark, d), X.bars_li(spark, d))
    return labelled.select("news_id", "news_time", "symbol", "label")


@query
def labelled_news_export(spark, d):
    exported = K.labelled_export(
        X.news_docs(spark, d), doc_hits(spark, d, ("doc_id", "news_time")), X.bars_ev(spark, d)
    )
    return exported.select(
        "doc_id", "symbol", "news_time", "news_title",
        F.md5("news_article").alias("article_md5"), "label",
    )


# --- files and models ------------------------------------------------------


@query
def csv_bars(spark, d):
    path = scratch_path(spark, "bars-csv")
    files.write_csv(X.bars_ev(spark, d), path)
    return files.read_bars_csv(spark, path)


@query
def bar_feature_vectors(spark, d):
    """The 7 features of each bar, from the fitted feature stages."""
    vectors = P.bar_vectors(X.bars_ev(spark, d))
    return vectors.select(
        "symbol", "date", *[r6(F.get("vector", i)).alias(f"f{i}") for i in range(7)]
    )


def word_counts(spark, d, docs: DataFrame) -> DataFrame:
    """Counts of all words but stop words, stored: the models read them in every round."""
    return stored(V.bag_of_words(docs, X.stop_words(spark, d)), "bow")


def as_weights(bow: DataFrame) -> DataFrame:
    return bow.select("doc_id", "token", F.col("tf").cast("double").alias("weight"))


def topic_columns(weighted: DataFrame, topics: int = Z.TOPICS, *plain: str) -> DataFrame:
    return weighted.select(
        "doc_id", *plain, *[r6(F.get("topic_weights", i)).alias(f"topic_{i}") for i in range(topics)]
    )


@query
def lda_topics(spark, d):
    docs = X.documents(spark, d)
    entries = as_weights(word_counts(spark, d, docs))
    return topic_columns(Z.fit_lda(entries).transform(entries, docs, minimum=Z.MIN_PROBABILITY))


@query
def lsi_topics(spark, d):
    docs = X.documents(spark, d)
    counts = word_counts(spark, d, docs)
    model = Z.fit_lsi(counts, docs)
    return topic_columns(model.transform(counts, docs), model.topics)


@query
def topics_reloaded(spark, d):
    """Models of the training documents, stored and loaded again, on the other documents."""
    docs = X.documents(spark, d).withColumn("part", P.split_part(F.col("doc_id"), P.TRAIN_TEST))
    train, test = docs.where("part = 'train'"), docs.where("part = 'test'")
    seen, new = word_counts(spark, d, train), word_counts(spark, d, test)
    paths = [scratch_path(spark, n) for n in ("lsi-model", "lda-model")]
    Z.fit_lsi(seen, train).save(paths[0])
    Z.fit_lda(as_weights(seen)).save(paths[1])
    lsi, lda = Z.LsiModel.load(spark, paths[0]), Z.LdaModel.load(spark, paths[1])
    places = topic_columns(lsi.transform(new, test), lsi.topics)
    shares = lda.transform(as_weights(new), test)
    return places.join(
        shares.select("doc_id", *[r6(F.get("topic_weights", i)).alias(f"share_{i}") for i in range(lda.topics)]),
        "doc_id",
    )


@query
def svm_predictions(spark, d):
    """Topics of rated documents, then a linear SVM on them; predictions of the test part."""
    rated = X.table(spark, d, "documents").join(X.table(spark, d, "labels"), "doc_id")
    docs = X.spread(rated, "doc_id").select(
        "doc_id", "text", F.col("quality").cast("double").alias("label"),
        P.split_part(F.col("doc_id"), P.TRAIN_TEST).alias("part"),
    )
    entries = as_weights(word_counts(spark, d, docs))
    train = docs.where("part = 'train'").select("doc_id")
    model = Z.fit_lda(stored(entries.join(train, "doc_id", "left_semi"), "train-entries"))
    topics = model.transform(entries, docs).withColumn("topics", array_to_vector("topic_weights"))
    # Topics are inferred once; training and testing read the stored rows.
    rows = settled(topics.join(docs.drop("text"), "doc_id").select("doc_id", "label", "part", "topics"))
    model = P.train_svm(rows.where("part = 'train'"), features="topics")
    tested = model.transform(rows.where("part = 'test'"))
    return tested.select("doc_id", "label", "prediction")


@query
def grid_scores(spark, d):
    """Weighted F1 of a linear classifier of ratings by fold and setting, every fit and score kept."""
    docs = X.table(spark, d, "documents").join(X.table(spark, d, "labels"), "doc_id")
    text = F.coalesce("text", F.lit(""))
    counts = [F.char_length(text), F.size(F.split(text, " ")), F.size(F.split(text, "\n")), F.regexp_count(text, F.lit("[#*$%&|<>]"))]
    rows = X.spread(docs, "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("label"),
        array_to_vector(F.array(*[F.log1p(c.cast("double")) for c in counts])).alias("features"),
    )
    machine = P.svm(features="features", iterations=10)
    grid = P.ParamGridBuilder().addGrid(machine.regParam, [0.001, 0.1]).build()
    folds = S.md5_number(F.col("doc_id")) % 3
    scored = P.weighted_f1(P.grid_predictions(rows, machine, grid, folds, 3), "fold", "params")
    return rounded(scored, ["fold", "params", "rows"], ["f1"])


@query
def price_forecast(spark, d):
    """Next close of the test bars, by both regressors."""
    rows = settled(P.forecast_rows(X.bars_ev(spark, d)))
    predicted = P.train_forecast(rows).transform(rows.where("part = 'test'"))
    return predicted.select(
        "symbol", "date", "label",
        r6("linear_prediction").alias("linear_prediction"),
        r6("boosted_prediction").alias("boosted_prediction"),
    )
