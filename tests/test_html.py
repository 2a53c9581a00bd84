from pyspark.sql import functions as F

from bellwire.functions import html as H


def one(spark, column, page):
    return spark.createDataFrame([(page,)], "html STRING").select(column.alias("r")).first()["r"]


NESTED = (
    '<html><div class="ad">buy</div><div id="x" class="big article_content">'
    "<div>inner &amp; <b>bold</b></div><!-- note --> tail</div>"
    '<div class="article_content">second</div></html>'
)


def test_nested_container(spark):
    assert one(spark, H.nested_text(F.col("html")), NESTED) == "inner & bold tail"
    assert one(spark, H.nested_text(F.col("html")), "<p>no container</p>") == ""
    assert one(spark, H.nested_text(F.col("html")), None) == ""


def test_flat_container(spark):
    page = '<p>x</p><article data-a="1"><h1>A&lt;B</h1> c&amp;lt;<!-- <b> --></article><article>2</article>'
    assert one(spark, H.flat_text(F.col("html"), "article"), page) == "A<B c&lt;"
    assert one(spark, H.flat_text(F.col("html"), "section"), page) == ""
    assert one(spark, H.flat_text(F.col("html"), "div", "ad"), NESTED) == "buy"


def test_links_of_a_class_in_order(spark):
    page = (
        '<a href="/1" class="news_item">1</a><a class="other" href="/2">2</a>'
        '<a class="hot news_item" title="t" href="/3">3</a><a class="news_item">4</a>'
        '<a class="news_items" href="/5">5</a>'
    )
    assert one(spark, H.link_targets(F.col("html")), page) == ["/1", "/3"]
    assert one(spark, H.link_targets(F.col("html"), None), page) == ["/1", "/2", "/3", "/5"]
