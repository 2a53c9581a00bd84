"""Scalar functions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and patterns that results depend on.
URL_TIME_PATTERN = r"/(\d{4})/(\d{2})/(\d{2})(\d{2})(\d{2})"
HAN_PATTERN = "[一-龥]"
MARKET_CLOSE = "15:30:00"
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
DAY_FORMAT = "yyyy-MM-dd"


def url_time(url: Column) -> Column:
    """Publication minute written in a URL path, ``''`` if it has none."""
    year, month, day, hour, minute = (
        F.regexp_extract(url, URL_TIME_PATTERN, i) for i in range(1, 6)
    )
    stamp = F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit(" "), hour, F.lit(":"), minute)
    return F.when(url.rlike(URL_TIME_PATTERN), stamp).otherwise(F.lit(""))


def contains_han(text: Column) -> Column:
    return text.rlike(HAN_PATTERN)


def strip_newlines(text: Column) -> Column:
    return F.translate(text, "\n\r", "")


def strip_blank(text: Column) -> Column:
    """Trim every kind of white space at both ends (``trim`` takes only spaces)."""
    return F.regexp_replace(F.regexp_replace(text, r"^[\s　]+", ""), r"[\s　]+$", "")


def recent_weekday(day: Column) -> Column:
    """The weekday before ``day``: Friday for Sunday and Monday, else the day before."""
    weekday = F.dayofweek(day)  # Sunday is 1
    back = F.when(weekday == 2, 3).when(weekday == 1, 2).otherwise(1)
    return F.date_sub(day, back)


def first_midnight(moment: Column) -> Column:
    """The first day whose midnight is not before ``moment``.

    Bars are stamped at midnight, so ``date < moment`` equals
    ``date < first_midnight(moment)`` and ``date >= moment`` equals
    ``date >= first_midnight(moment)``: every comparison of news with bars
    becomes one of days.
    """
    almost_a_day = F.make_dt_interval(F.lit(0), F.lit(23), F.lit(59), F.lit("59.999999").cast("decimal(8,6)"))
    return F.to_date(moment + almost_a_day)


def naive_timestamp(text: Column) -> Column:
    """Wall-clock time of a timestamp string; an offset, if any, is dropped."""
    plain = F.regexp_replace(text, r"\s*(Z|[+-]\d{2}:?\d{2})$", "")
    # A bare date must not lose its day to the offset pattern.
    whole = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).otherwise(plain)
    return whole.try_cast("timestamp_ntz")


def minute_text(moment: Column) -> Column:
    return F.date_format(moment, MINUTE_FORMAT)


def at_or_after_close(moment: Column, close: str = MARKET_CLOSE) -> Column:
    return F.date_format(moment, "HH:mm:ss") >= F.lit(close)


def title_and_article(title: Column, article: Column) -> Column:
    """Title, a space, article; a missing title is left out."""
    return F.concat_ws(" ", title, article)


def price_range(high: Column, low: Column) -> Column:
    return high - low


def price_change(open_: Column, close: Column) -> Column:
    """Move over the day as a ratio; null when the open is zero."""
    return F.try_divide(close - open_, open_)


def log_ratio(later: Column, earlier: Column) -> Column:
    """``ln(later / earlier)``, null unless both are positive."""
    return F.when((later > 0) & (earlier > 0), F.ln(later / earlier))


def md5_number(key: Column) -> Column:
    """A number in ``[0, 2**32)`` from the first 8 hex digits of the key's MD5."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def three_way_label(move: Column, mean: Column, std: Column) -> Column:
    """``good`` above mean + std, ``bad`` below mean - std, ``neutral`` otherwise or unknown."""
    return (
        F.when(move > mean + std, "good").when(move < mean - std, "bad").otherwise("neutral")
    )


def binary_label(move: Column, mean: Column, std: Column) -> Column:
    return F.when(move > mean + std, 1).otherwise(0)
