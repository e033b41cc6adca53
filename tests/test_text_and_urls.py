"""Functions on text and URLs against plain Python."""

import re
from urllib.parse import urljoin

from pyspark.sql import functions as F

from evigrade.functions import html as H
from evigrade.functions import text as T
from evigrade.functions import urls as U


def one(spark, expression, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expression.alias("x")).first()["x"]


def test_stable_ids(spark):
    rows = spark.createDataFrame([(" A/B #1 ", 3), ("", 4), (None, 5), ("--", 6)], "raw string, n int")
    assert [r[0] for r in rows.select(T.stable_id("raw", "n")).collect()] == ["A-B-1", "row_000004", "row_000005", "row_000006"]


def test_tri_state_and_numbers(spark):
    rows = spark.createDataFrame([(" Yes",), ("OFF",), ("",), (None,), ("maybe",)], "c string")
    assert [r[0] for r in rows.select(T.tri_state("c")).collect()] == [True, False, None, None, None]
    rows = spark.createDataFrame([("3.9",), ("-3.9",), ("nan",), ("inf",), ("x",), (None,), ("1e3",)], "c string")
    assert [r[0] for r in rows.select(T.int_or("c", 7)).collect()] == [3, -3, 7, 7, 7, 7, 1000]


def test_truncate_and_cells(spark):
    assert one(spark, T.truncate_marked("c", 3), c="abcdef") == "abc\n…[truncated, 3 more chars]"
    assert one(spark, T.truncate_marked("c", 3), c="abc") == "abc"
    assert one(spark, T.markdown_cell("c", 5), c=" a |  b\nc d e") == "a…" or len(one(spark, T.markdown_cell("c", 5), c="a b c d e f")) <= 5


def test_tokens_keep_order_and_drop_stop_words(spark):
    assert one(spark, T.business_tokens("c"), c="The red toy 12 1234 RED robot") == ["red", "1234", "robot"]
    assert one(spark, T.match_score("a", "b"), a="red robot arm", b="robot arm blue") == 0.667
    assert one(spark, T.hint_score(F.col("t"), "h", "e"), t="red robot 4001", h="robot blue", e="4001") == 23


def test_snippets(spark):
    assert one(spark, T.split_snippets("c"), c='["a", " b "]') == ["a", "b"]
    assert one(spark, T.split_snippets("c"), c="a\n\nb||c") == ["a", "b", "c"]


def test_url_parts(spark):
    url = "https://user@WWW.Shop.example.com:8080/a%20b/item-12345678?q=x#top"
    assert one(spark, U.domain("u"), u=url) == "shop.example.com"
    assert one(spark, U.slug("u"), u="https://x.de/a/b c/") == "x.de__a_b-c"
    assert one(spark, U.slug("u"), u="") == "root"
    assert one(spark, U.identifiers("u"), u=url) == ["12345678"]
    assert one(spark, U.has_search_key("u"), u=url) is True
    assert one(spark, U.has_search_key("u"), u="https://x.de/?q=") is False
    assert one(spark, U.is_category("u"), u="https://x.de/category/a") is True
    assert one(spark, U.join_url(F.col("b"), F.col("l")), b="https://x.de/a/b", l="../c.png") == urljoin("https://x.de/a/b", "../c.png")


def test_page_parser_finds_images_and_outer_tables():
    images, tables = H.extract_page(
        '<img src="/a.jpg" alt="A"><img data-src="b.png"><table><tr><td>1<table><tr><td>in</td></tr></table></td></tr></table>'
        '<table></table><table><caption> C </caption><tr><th>x|y</th></tr><tr><td>1</td><td>2</td></tr></table>',
        "https://x.de/p/",
    )
    assert [i["url"] for i in images] == ["https://x.de/a.jpg", "https://x.de/p/b.png"]
    assert [t["index"] for t in tables] == [1, 3]
    assert tables[1]["caption"] == "C" and tables[1]["n_columns"] == 2
    assert re.search(r"\| x\\\|y \|  \|", tables[1]["markdown"])


def test_bad_json_ld_gives_nothing(spark):
    pages = spark.createDataFrame([(1, '<script type="application/ld+json">{bad</script>'), (2, ""), (3, None)], "k int, html string")
    assert H.json_ld_products(pages, "k").count() == 0
