import os
import tempfile

from pyspark.sql import functions as F

from dealcast.operators import recommend as R
from dealcast.sources.html import extract_deals, listing_page
from dealcast.sources.panel import read_panel, write_panel
from dealcast.sources.posts import POSTS_SCHEMA, read_posts, write_posts


def test_recommend_messages(spark):
    rows = ([("a", d, 0.0, d == 3) for d in range(10)] +
            [("b", d, 0.3 if d in (4, 6) else (0.1 if d == 2 else 0.0), d == 0) for d in range(10)] +
            [("c", d, 0.2 if d == 0 else 0.0, False) for d in range(10)])
    df = spark.createDataFrame(rows, "brand string, day_ahead int, pred_discount double, pred_gwp boolean")
    out = {r.brand: r for r in R.recommend(df).collect()}
    a, b, c = out["a"], out["b"], out["c"]
    assert not a.has_discount_record and a.next_gwp_day == 3
    assert a.message == " ".join([R.MSG_NO_RECORD, R.MSG_GWP_ONLY, R.MSG_NEXT_GWP % 3])
    assert b.best_day == 4 and b.next_discount_day == 2 and abs(b.next_discount_pct - 10.0) < 1e-9
    assert b.message.startswith(R.MSG_GWP_TODAY) and "in 4 days!" in b.message and "30 % Off" in b.message
    assert c.discount_today and c.message.startswith(R.MSG_PCT_TODAY)
    assert R.horizon(df, 4).where("brand = 'b'").agg(F.max("day_ahead")).first()[0] == 2


LISTING_HTML = """<html><body>
<div class="mlist"><div class="r j-r"><a href="/s/1">Kiehl's</a> <span>3 days ago</span></div>
<div class="subtitle">20% Off + Free Gift</div><div class="stat-count"><i class="j-count">12</i><i class="j-count">20</i><i class="j-count">19</i></div>
</div>
</div>
<div class="mlist"><div class="r j-r"><a href="/s/2">Tatcha</a> <span>5 mins ago</span></div>
<div class="subtitle">Free Travel-Size Cream</div><div class="stat-count"><i class="j-count">7</i></div>
</div>
</div></body></html>"""


def test_extract_deals_from_listing(spark):
    pages = spark.createDataFrame([(1, "kiehls", LISTING_HTML)], "page_id long, brand string, html string")
    rows = extract_deals(pages, as_of="2020-06-21").collect()
    assert [(r.store, r.discount, r.posted_date, r.comments_count, r.bookmarks_count, r.shares_count) for r in rows] == [
        ("Kiehl's", "20% Off + Free Gift", "2020-06-18", 12, 20, 19),
        ("Tatcha", "Free Travel-Size Cream", "2020-06-21", 7, 0, 0)]


def test_listing_pages_of_any_nesting(spark):
    """Nested elements, empty counters, escapes, missing fields and digits too long for a counter."""
    rows = [("b", "A & B <x>", "5% Off", "2020-06-20", None, 7, 3), ("b", "S", 'say "hi"', None, 1, None, 10)]
    posts = spark.createDataFrame(rows, POSTS_SCHEMA).withColumn("posted_date", F.to_date("posted_date"))
    pages = posts.select("brand", F.lit(1).alias("page_id"), listing_page(posts, "2020-06-21").alias("html"))
    got = sorted(tuple(r) for r in extract_deals(pages, as_of="2020-06-21").collect())
    assert got == [("b", "A & B <x>", "5% Off", "2020-06-20", 0, 7, 3), ("b", "S", 'say "hi"', None, 1, 0, 10)]
    html = '<div class="mlist"><div><div class="subtitle">a</div></div></div><div class="mlist"><div class="stat-count"><b class="j-count">99999999999999999999</b></div></div>'
    two = extract_deals(spark.createDataFrame([(1, "b", html)], "page_id long, brand string, html string"), as_of="2020-06-21").collect()
    assert [(r.store, r.discount, r.comments_count, r.shares_count) for r in two] == [("", "a", 0, 0), ("", "", 0, 0)]


def test_posts_csv_and_panel_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="dealcast-test-")
    rows = [("kiehls", "Kiehl's", "20% Off", "6/20/2020", None, 7, 3), ("kiehls", "Kiehl's", "Gift, free", "2020-06-21", 4, 1, 0)]
    posts = spark.createDataFrame(rows, POSTS_SCHEMA)
    write_posts(posts, os.path.join(d, "posts"))
    back = read_posts(spark, os.path.join(d, "posts"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    panel = spark.createDataFrame([("a", "2020-01-01", 0.1), ("b", "2020-01-02", 0.2)], "brand string, posted_date string, x double") \
        .withColumn("posted_date", F.to_date("posted_date"))
    write_panel(panel, os.path.join(d, "panel"))
    got = read_panel(spark, os.path.join(d, "panel"), ["x"], brands=["b"]).collect()
    assert [(r.brand, r.x) for r in got] == [("b", 0.2)]


def test_conform_keeps_common_columns(spark):
    from dealcast.operators.features import conform
    a = spark.createDataFrame([(1, 2, 3)], "x int, y int, z int")
    b = spark.createDataFrame([(4, 5)], "z int, x int")
    a2, b2 = conform(a, b)
    assert a2.columns == ["x", "z"] and b2.columns == ["x", "z"]


def test_end_to_end_run(spark):
    from dealcast.plans.run import run
    out = tempfile.mkdtemp(prefix="dealcast-run-")
    run(spark, out, tables="/root/testdata/sf0.001")
    adv = spark.read.parquet(os.path.join(out, "advice")).collect()
    assert len(adv) == spark.read.parquet(os.path.join(out, "panel")).select("brand").distinct().count()
    assert all(r.message for r in adv)
    assert spark.read.parquet(os.path.join(out, "naive_scores")).count() > 0
