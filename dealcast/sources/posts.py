"""Raw deal posts: CSV scan/sink (I1, I2, I5) and the posts view over the shared tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealcast.sources.tables import table

# One row per scraped post. Dates stay text here: two formats occur and are
# parsed leniently downstream (functions.text.parse_posted_date).
POSTS_SCHEMA = T.StructType([
    T.StructField("brand", T.StringType(), True),
    T.StructField("store", T.StringType(), True),
    T.StructField("discount", T.StringType(), True),
    T.StructField("posted_date", T.StringType(), True),
    T.StructField("comments_count", T.LongType(), True),
    T.StructField("bookmarks_count", T.LongType(), True),
    T.StructField("shares_count", T.LongType(), True),
])

_CSV_HEADER = ["Brand", "Store", "Discount", "Posted_date",
               "Comments_count", "Bookmarks_count", "Shares_count"]


def read_posts(spark: SparkSession, path: str, brand: str | None = None) -> DataFrame:
    """Scan one or many post CSVs (a glob covers every brand in one pass).

    The header names of the scraper output are mapped onto POSTS_SCHEMA. When the
    files have no usable brand column, ``brand`` fills it, else the file name does.
    """
    raw = (spark.read.option("header", True).option("mode", "PERMISSIVE")
           .option("enforceSchema", True).schema(POSTS_SCHEMA).csv(path))
    if brand is not None:
        raw = raw.withColumn("brand", F.lit(brand))
    else:
        from_file = F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
        raw = raw.withColumn("brand", F.coalesce(F.col("brand"), F.lower(from_file)))
    return raw


def write_posts(posts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with the scraper's header; no row index column (Q23)."""
    (posts.select([F.col(c.name).alias(h) for c, h in zip(POSTS_SCHEMA.fields, _CSV_HEADER)])
     .write.mode(mode).option("header", True).csv(path))


def _us_date(c: Column) -> Column:
    return F.date_format(c, "M/d/yyyy")


def deals_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A posts-shaped table derived from lineitem x part x supplier.

    Each line number yields a different deal text, so every parsing rule fires:
    plain percent, "Up to" percent plus gift, full-size sample, BOGO, GWP, an ad
    line without percent and the spelled-out buy-one-get-one. Dates alternate
    between the two input formats and some are unparseable.

    Joins are plain equi joins: AQE broadcasts part/supplier only when their
    runtime size is under the broadcast threshold, else it sort-merges, and it
    splits skewed partkeys. Only the 5 lineitem columns used are scanned.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    j = (li.join(part, li.l_partkey == part.p_partkey)
           .join(supp, li.l_suppkey == supp.s_suppkey))
    pct = F.round(F.col("l_discount") * 100).cast("int")
    ln = F.col("l_linenumber")
    text = (F.when(ln == 1, F.concat(pct.cast("string"), F.lit("% Off")))
             .when(ln == 2, F.concat(F.lit("Up to "), (pct * 5).cast("string"), F.lit("% Off + Free Gift")))
             .when(ln == 3, F.lit("Free Full Size Sample"))
             .when(ln == 4, F.lit("BOGO"))
             .when(ln == 5, F.lit("GWP"))
             .when(ln == 6, F.lit("Dealmoon Exclusive! Starting From $52"))
             .otherwise(F.lit("Buy one get one free")))
    day = F.col("l_shipdate").cast("date")
    posted = (F.when((ln == 7) & (F.col("l_tax") == 0), F.lit("n/a"))
               .when(ln % 2 == 0, _us_date(day))
               .otherwise(F.date_format(day, "yyyy-MM-dd")))
    return j.select(
        F.col("p_brand").alias("brand"),
        F.col("s_name").alias("store"),
        text.alias("discount"),
        posted.alias("posted_date"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("bigint")).alias("comments_count"),
        ln.cast("bigint").alias("bookmarks_count"),
        (F.col("l_partkey") % 50).alias("shares_count"),
    )
