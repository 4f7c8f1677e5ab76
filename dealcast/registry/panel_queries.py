"""Registered queries: sources, parsing, descriptive aggregates, features, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealcast import sqltwins as T
from dealcast.functions.stats import sql_safe_corr
from dealcast.functions.text import age_to_date
from dealcast.operators import features as X
from dealcast.operators import rollup as A
from dealcast.operators import splits as S
from dealcast.operators.holidays import holidays_for_years
from dealcast.registry.base import D, register
from dealcast.registry.core import filled, panel, parsed, posts
from dealcast.sources import html as H
from dealcast.sources.tables import table


def _rd(df, cols):
    return df.withColumns({c: F.round(c, D) for c in cols})


# ---------------------------------------------------------------- sources
@register("i9_profile_shape", T.with_ctes(T.POSTS) + "SELECT count(*) AS n_rows, 7 AS n_cols FROM posts")
def q_profile(spark, sf):
    return A.profile_shape(posts(spark, sf))


@register("f14_dedup_posts", T.with_ctes(T.POSTS) + "SELECT DISTINCT * FROM posts")
def q_dedup(spark, sf):
    return A.dedup_posts(posts(spark, sf))


def _pages_sql(layout, with_fields):
    fields = ", ".join(f"regexp_extract(block, {T._q(p)}, 1) AS {n}" for n, p in with_fields.items())
    return f"""
SELECT page_id, CAST(pos AS INT) AS pos, {fields} FROM (
  SELECT page_id, generate_subscripts(m, 1) - 1 AS pos, unnest(m) AS block
  FROM (SELECT page_id, regexp_extract_all(html, {T._q(layout.block)}) AS m FROM pages))"""


@register("i8_extract_links", _pages_sql(H.LINKS, H.LINKS.texts))
def q_links(spark, sf):
    return H.extract_blocks(table(spark, sf, "pages"), H.LINKS)


@register("i8_extract_headings", _pages_sql(H.HEADINGS, H.HEADINGS.texts))
def q_headings(spark, sf):
    return H.extract_blocks(table(spark, sf, "pages"), H.HEADINGS)


# ---------------------------------------------------------------- scalar functions
AGE_AS_OF = "2002-01-01"


def _age_texts(li):
    n = F.date_diff(F.lit(AGE_AS_OF).cast("date"), F.col("l_shipdate").cast("date")).cast("string")
    ln = F.col("l_linenumber")
    return (F.when(ln <= 3, F.concat(n, F.lit(" days ago")))
             .when(ln == 4, F.lit("5 mins ago"))
             .when(ln == 5, F.lit("2 hrs ago"))
             .when(ln == 6, F.concat(F.lit("Posted "), n, F.lit(" day ago")))
             .otherwise(F.lit("unknown")))


@register("f2_age_to_date", f"""
WITH a AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber <= 3 THEN concat(CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '{AGE_AS_OF}') AS VARCHAR), ' days ago')
         WHEN l_linenumber = 4 THEN '5 mins ago' WHEN l_linenumber = 5 THEN '2 hrs ago'
         WHEN l_linenumber = 6 THEN concat('Posted ', CAST(date_diff('day', CAST(l_shipdate AS DATE), DATE '{AGE_AS_OF}') AS VARCHAR), ' day ago')
         ELSE 'unknown' END AS age_text
  FROM lineitem)
SELECT l_orderkey, l_linenumber, age_text,
  CASE WHEN regexp_matches(lower(age_text), '\\b(sec|secs|min|mins|hr|hrs)\\b') THEN DATE '{AGE_AS_OF}'
       WHEN regexp_extract(lower(age_text), '([0-9]+)', 1) <> ''
       THEN CAST(DATE '{AGE_AS_OF}' - CAST(regexp_extract(lower(age_text), '([0-9]+)', 1) AS INT) AS DATE) END AS posted_on
FROM a""")
def q_age(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    a = li.select("l_orderkey", "l_linenumber", _age_texts(li).alias("age_text"))
    return a.select("*", age_to_date("age_text", F.lit(AGE_AS_OF).cast("date")).alias("posted_on"))


@register("f10_holiday_table", f"""
WITH years AS (
  SELECT CAST(unnest(range(min(year(l_shipdate)) - 1, max(year(l_shipdate)) + 2)) AS INT) AS year FROM lineitem),
hol AS ({T._holiday_rows()})
SELECT holiday_date, holiday_name, kind FROM hol""")
def q_holidays(spark, sf):
    li = table(spark, sf, "lineitem")
    span = li.agg(F.min(F.year("l_shipdate")).alias("y0"), F.max(F.year("l_shipdate")).alias("y1"))
    years = span.select(F.explode(F.sequence(F.col("y0") - 1, F.col("y1") + 1)).alias("year"))
    return holidays_for_years(years)


# ---------------------------------------------------------------- aggregates
@register("a2_value_counts", T.with_ctes(T.POSTS) +
          "SELECT brand, discount, count(*) AS n FROM posts GROUP BY brand, discount")
def q_value_counts(spark, sf):
    return A.value_counts(posts(spark, sf), "discount", ["brand"])


@register("a3_series_bounds", T.with_ctes(T.POSTS, T.PARSED) + """
SELECT brand, min(posted_date) AS first_date, max(posted_date) AS last_date,
       CAST(year(min(posted_date)) AS INT) AS first_year
FROM parsed WHERE posted_date IS NOT NULL GROUP BY brand""")
def q_bounds(spark, sf):
    return A.series_bounds(parsed(spark, sf))


@register("a4_seasonality_month", T.BASE_FILLED + """
SELECT brand, CAST(month(posted_date) AS INT) AS month, count(*) AS n_days
FROM filled WHERE gwp OR discount_off <> 0 GROUP BY ALL""")
def q_month(spark, sf):
    return A.seasonality(filled(spark, sf), "month")


@register("a5_seasonality_weekday", T.BASE_FILLED + """
SELECT brand, CAST(isodow(posted_date) - 1 AS INT) AS weekday_no, dayname(posted_date) AS weekday, count(*) AS n_days
FROM filled WHERE gwp OR discount_off <> 0 GROUP BY ALL""")
def q_weekday(spark, sf):
    return A.seasonality(filled(spark, sf), "weekday")


@register("a6_year_over_year", T.BASE_FILLED + """
SELECT brand, CAST(year(posted_date) AS INT) AS year, posted_date,
  CAST(date_diff('day', min(posted_date) OVER (PARTITION BY brand, year(posted_date)), posted_date) AS INT) AS day_idx,
  discount_off
FROM filled""")
def q_yoy(spark, sf):
    return A.year_over_year(filled(spark, sf))


CORR_COLS = ["discount_off", "gwp", "n_posts", "comments_count", "bookmarks_count", "shares_count"]


def _corr_sql():
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            r = sql_safe_corr(f"CAST({a} AS DOUBLE)", f"CAST({b} AS DOUBLE)")
            parts.append(f"SELECT brand, '{a}' AS col_a, '{b}' AS col_b, round({r}, 6) AS r FROM filled GROUP BY brand")
    return T.BASE_FILLED + "\nUNION ALL ".join(parts)


@register("a7_corr_matrix", _corr_sql())
def q_corr(spark, sf):
    c = A.corr_matrix(filled(spark, sf), CORR_COLS, ["brand"])
    return c.withColumn("r", F.round("r", D))


@register("a8_engagement_by_type", T.with_ctes(T.POSTS, T.PARSED) + """
SELECT brand,
  CASE WHEN discount_off > 0 AND gwp THEN 'both' WHEN discount_off > 0 THEN 'pct_off' WHEN gwp THEN 'gwp' ELSE 'neither' END AS deal_type,
  count(*) AS n_posts,
  round(avg(comments_count), 6) AS avg_comments_count, round(avg(bookmarks_count), 6) AS avg_bookmarks_count,
  round(avg(shares_count), 6) AS avg_shares_count,
  CAST(coalesce(sum(comments_count), 0) AS BIGINT) AS sum_comments_count,
  CAST(coalesce(sum(bookmarks_count), 0) AS BIGINT) AS sum_bookmarks_count,
  CAST(coalesce(sum(shares_count), 0) AS BIGINT) AS sum_shares_count
FROM parsed GROUP BY ALL""")
def q_engagement(spark, sf):
    e = A.engagement_by_type(parsed(spark, sf))
    return _rd(e, [f"avg_{c}" for c in A.COUNTERS])


@register("t1_t3_panel_head", T.BASE_PANEL + """
SELECT brand, posted_date, discount_off, gwp, event_7days FROM panel ORDER BY brand, posted_date LIMIT 20""")
def q_head(spark, sf):
    p = panel(spark, sf).select("brand", "posted_date", "discount_off", "gwp", "event_7days")
    return p.orderBy("brand", "posted_date").limit(20)


# ---------------------------------------------------------------- features
def _feat_sql() -> str:
    cols = [f"coalesce(lag(discount_off, {k}) OVER w, 0.0) AS t_{k}" for k in X.LAGS_]
    for s, fn in (("mean", "avg"), ("max", "max"), ("sum", "sum")):
        for k in (1, 7, 14, 30):
            if k == 1:
                cols.append(f"coalesce(lag(discount_off, 1) OVER w, 0.0) AS {s}_1")
            else:
                agg = (f"{fn}(discount_off) OVER (PARTITION BY brand ORDER BY posted_date "
                       f"ROWS BETWEEN {2 * k - 1} PRECEDING AND {k} PRECEDING)")
                if s != "max":
                    agg = f"round({agg}, 9)"
                cols.append(f"coalesce(CASE WHEN rn >= {2 * k} THEN {agg} END, 0.0) AS {s}_{k}")
    return f""",
feat AS (
  SELECT brand, posted_date, rn, n, gwp, discount_off, {', '.join(cols)},
    year, month, day, weekend_flg, event_1day, event_7days AS event_7day, event_14days AS event_14day,
    event_1month AS event_month, discount_off AS label
  FROM panel WINDOW w AS (PARTITION BY brand ORDER BY posted_date)),
dd AS (SELECT *, CAST(gwp AS INT) AS y FROM feat WHERE gwp OR discount_off <> 0)
"""


FEAT_BASE = T.BASE_PANEL.rstrip() + _feat_sql()
ROUNDED = [f"{s}_{k}" for s in ("mean", "sum") for k in (7, 14, 30)]


def features(spark, sf):
    """The feature frame, with rolling values rounded as in the twins: exact bins and ranks follow."""
    return X.build_features(panel(spark, sf), digits=9)


def deal_days(spark, sf):
    return X.filter_deal_days(features(spark, sf)).withColumn("y", F.col("gwp").cast("int"))


def _sel_round(cols):
    return ", ".join(f"round({c}, 6) AS {c}" if c in ROUNDED else c for c in cols)


FEATURE_COLS = (["brand", "posted_date", "rn", "n", "gwp", "discount_off"] + X.LAG_FEATURES + X.ROLL_FEATURES
                + ["year", "month", "day", "weekend_flg"] + X.EVENT_FEATURES + ["label"])


@register("x1_features", FEAT_BASE + f"SELECT {_sel_round(FEATURE_COLS)} FROM feat")
def q_features(spark, sf):
    return _rd(features(spark, sf), ROUNDED)


def _onehot_sql():
    keep = [c for c in FEATURE_COLS if c not in ("event_1day", "event_7day", "event_14day", "event_month", "weekend_flg")]
    ind = []
    for name, src, v in X.one_hot_columns():
        lit = ("true" if v else "false") if isinstance(v, bool) else T._q(v)
        ind.append(f"CASE WHEN {src} = {lit} THEN 1 ELSE 0 END AS {name}")
    return FEAT_BASE + f"SELECT {_sel_round(keep)}, {', '.join(ind)} FROM feat WHERE gwp OR discount_off <> 0"


@register("p4_x2_deal_days_one_hot", _onehot_sql())
def q_one_hot(spark, sf):
    return _rd(X.one_hot(X.filter_deal_days(features(spark, sf))), ROUNDED)


@register("x3_label_encode", T.BASE_PANEL + """
SELECT event_7day, CAST(rank() OVER (ORDER BY event_7day) - 1 AS INT) AS event_7day_code, n FROM (
  SELECT event_7days AS event_7day, count(*) AS n FROM panel GROUP BY 1)""")
def q_label_encode(spark, sf):
    counts = panel(spark, sf).groupBy(F.col("event_7days").alias("event_7day")).agg(F.count(F.lit(1)).alias("n"))
    return X.label_encode(counts, "event_7day")


def _long_sql(feats):
    return " UNION ALL ".join(f"SELECT brand, y, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM dd" for f in feats)


FSEL = X.NUMERIC_FEATURES


def _freg_sql():
    return FEAT_BASE.rstrip() + f""",
lg AS ({_long_sql(FSEL)}),
fr AS (SELECT brand, feature, count(*) AS n, {sql_safe_corr('x', 'CAST(y AS DOUBLE)')} AS r FROM lg GROUP BY brand, feature),
fs AS (SELECT brand, feature, round(CASE WHEN 1 - r * r > 0 THEN r * r / (1 - r * r) * (n - 2) END, 6) AS f_score FROM fr)
"""


@register("x4_f_regression", _freg_sql() + "SELECT * FROM fs")
def q_freg(spark, sf):
    return X.f_regression(deal_days(spark, sf), FSEL, "y", ["brand"], digits=D)


@register("t2_select_k_best", _freg_sql() + """
SELECT brand, feature, f_score, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY brand ORDER BY f_score DESC NULLS LAST, feature) AS rank FROM fs)
WHERE rank <= 5""")
def q_kbest(spark, sf):
    return X.select_k_best(X.f_regression(deal_days(spark, sf), FSEL, "y", ["brand"], digits=D), 5, by=["brand"])


@register("x5_f_classif", FEAT_BASE.rstrip() + f""",
lg AS ({_long_sql(FSEL)}),
cls AS (SELECT brand, feature, y, count(*) AS nc, avg(x) AS m, var_pop(x) AS v FROM lg GROUP BY ALL),
g AS (SELECT brand, feature, sum(nc) AS n, count(*) AS k, sum(nc * m) / sum(nc) AS grand, sum(nc * v) AS ssw
      FROM cls GROUP BY ALL)
SELECT g.brand, g.feature,
  round(CASE WHEN g.ssw > 0 AND g.k > 1 THEN (sum(c.nc * (c.m - g.grand) * (c.m - g.grand)) / (g.k - 1)) / (g.ssw / (g.n - g.k)) END, 6) AS f_score
FROM g JOIN cls c ON g.brand = c.brand AND g.feature = c.feature
GROUP BY g.brand, g.feature, g.ssw, g.k, g.n""")
def q_fclassif(spark, sf):
    return X.f_classif(deal_days(spark, sf), FSEL, "y", ["brand"], digits=D)


@register("x6_mutual_info", FEAT_BASE.rstrip() + f""",
lg AS ({_long_sql(FSEL)}),
rg AS (SELECT brand, feature, quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM lg GROUP BY ALL),
bn AS (SELECT l.brand, l.feature, l.y, len(list_filter(r.cuts, lambda c: c < l.x)) AS bin
       FROM lg l JOIN rg r ON l.brand = r.brand AND l.feature = r.feature),
ct AS (SELECT brand, feature, bin, y, count(*) AS c FROM bn GROUP BY ALL),
pr AS (SELECT *, sum(c) OVER (PARTITION BY brand, feature) AS nn,
         sum(c) OVER (PARTITION BY brand, feature, bin) AS pb, sum(c) OVER (PARTITION BY brand, feature, y) AS py FROM ct)
SELECT brand, feature, round(sum((c / nn) * ln(c * nn / (pb * py))), 6) AS mi FROM pr GROUP BY ALL""")
def q_mi(spark, sf):
    return X.mutual_info(deal_days(spark, sf), FSEL, "y", 10, ["brand"], digits=D)


# ---------------------------------------------------------------- splits and folds
@register("s1_split_tail", T.BASE_FILLED + """
SELECT brand, split, count(*) AS n_days, min(posted_date) AS first_date, max(posted_date) AS last_date FROM (
  SELECT *, CASE WHEN rn = n THEN 'last' WHEN rn >= n - 364 THEN 'test' WHEN rn >= 7 THEN 'train' ELSE 'skip' END AS split
  FROM filled) GROUP BY ALL""")
def q_split_tail(spark, sf):
    p = S.split_tail(filled(spark, sf))
    return p.groupBy("brand", "split").agg(F.count(F.lit(1)).alias("n_days"), F.min("posted_date").alias("first_date"),
                                           F.max("posted_date").alias("last_date"))


def _draw_sql(seed, key):
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', CAST({key} AS VARCHAR))), 1, 8))::BIGINT / 4294967296.0)"


@register("s2_split_random", FEAT_BASE + f"""
SELECT brand, posted_date, CASE WHEN rk <= floor(cnt * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT brand, posted_date, row_number() OVER (PARTITION BY brand ORDER BY {_draw_sql(42, 'posted_date')}, posted_date) AS rk,
         count(*) OVER (PARTITION BY brand) AS cnt FROM dd)""")
def q_split_random(spark, sf):
    d = deal_days(spark, sf).select("brand", "posted_date")
    return S.split_random(d, ["posted_date"], 0.7, 42, ["brand"])


@register("s3_stratified_folds", FEAT_BASE + f"""
SELECT brand, posted_date, y,
  CAST((row_number() OVER (PARTITION BY brand, y ORDER BY {_draw_sql(2, 'posted_date')}, posted_date) - 1) % 10 AS INT) AS fold
FROM dd""")
def q_strat(spark, sf):
    d = deal_days(spark, sf).select("brand", "posted_date", "y")
    return S.stratified_folds(d, "y", ["posted_date"], 10, 2, ["brand"])


def _wf_sql(ksql: str, kmax: int) -> str:
    return T.BASE_FILLED + f"""
, tr AS (SELECT brand, rn - 7 AS pos, n - 371 AS n_rows, {ksql} AS k FROM filled WHERE rn >= 7 AND rn <= n - 365),
fs AS (SELECT brand, pos, n_rows, k, CAST(f.fold AS INT) AS fold, n_rows // (k + 1) AS ts FROM tr, range(0, {kmax}) f(fold) WHERE f.fold < k),
rl AS (SELECT brand, fold, pos,
         CASE WHEN ts <= 0 THEN NULL
              WHEN pos >= n_rows - ts * k + fold * ts AND pos < n_rows - ts * k + (fold + 1) * ts THEN 'test'
              WHEN pos < n_rows - ts * k + fold * ts THEN 'train' END AS role FROM fs)
SELECT brand, fold, role, count(*) AS n_rows, CAST(min(pos) AS INT) AS first_pos, CAST(max(pos) AS INT) AS last_pos
FROM rl WHERE role IS NOT NULL GROUP BY ALL"""


def _train_rows(spark, sf):
    p = S.split_tail(filled(spark, sf)).where(F.col("split") == "train")
    return p.select("brand", (F.col("rn") - 7).alias("pos"), (F.col("n") - 371).alias("n_rows"))


def _fold_summary(f):
    return f.groupBy("brand", "fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("pos").cast("int").alias("first_pos"),
        F.max("pos").cast("int").alias("last_pos"))


@register("s4_walk_forward_folds", _wf_sql("CASE WHEN n - 371 > 350 THEN 20 ELSE 5 END", 20))
def q_walk_forward(spark, sf):
    tr = _train_rows(spark, sf)
    k = F.when(F.col("n_rows") > 350, F.lit(20)).otherwise(F.lit(5))
    return _fold_summary(S.walk_forward_folds(tr, k))


@register("s5_time_series_split", _wf_sql("10", 10))
def q_tss(spark, sf):
    return _fold_summary(S.time_series_split(_train_rows(spark, sf), 10))


SCORE_FEATS = X.NUMERIC_FEATURES


@register("j4_scoring_frame", FEAT_BASE + "SELECT brand, posted_date, CAST(rn - (n - 364) AS INT) AS day_ahead, " + ", ".join(
    f"CAST(CASE WHEN gwp OR discount_off <> 0 THEN {f} ELSE 0 END AS DOUBLE) AS {f}" if f not in ROUNDED else
    f"round(CAST(CASE WHEN gwp OR discount_off <> 0 THEN {f} ELSE 0 END AS DOUBLE), 6) AS {f}" for f in SCORE_FEATS)
    + " FROM feat WHERE rn >= n - 364 AND rn < n")
def q_scoring(spark, sf):
    return _rd(X.scoring_frame(features(spark, sf), SCORE_FEATS), [f for f in SCORE_FEATS if f in ROUNDED])


@register("f9_date_delta", T.BASE_FILLED + """
SELECT brand, posted_date, CAST(date_diff('day', min(posted_date) OVER (PARTITION BY brand), posted_date) + 1 AS INT) AS date_delta
FROM filled""")
def q_date_delta(spark, sf):
    return A.add_date_delta(filled(spark, sf).select("brand", "posted_date"))
