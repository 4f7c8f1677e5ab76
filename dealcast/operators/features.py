"""Feature frame, one-hot encoding, label encoding and univariate feature scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.functions.stats import safe_corr
from dealcast.operators.ordered import quantiles
from dealcast.operators.holidays import FEDERAL_RULES, NORMAL, PARENT_RULES
from dealcast.operators.windows import lag_columns, rolling_columns

LAGS_ = (1, 7, 14, 30, 365)
LAG_FEATURES = [f"t_{k}" for k in LAGS_]
ROLL_FEATURES = [f"{s}_{k}" for s in ("mean", "max", "sum") for k in (1, 7, 14, 30)]
CAL_FEATURES = ["year", "month", "day", "weekend_flg"]
EVENT_FEATURES = ["event_1day", "event_7day", "event_14day", "event_month"]
NUMERIC_FEATURES = LAG_FEATURES + ROLL_FEATURES + ["year", "month", "day"]
# Category lists are fixed (not fitted per split), so every split has the same width.
EVENT_CATEGORIES = [NORMAL] + [r[0] for r in FEDERAL_RULES] + [r[0] for r in PARENT_RULES]
ONE_HOT_SOURCES = {"event_1day": EVENT_CATEGORIES, "event_7day": EVENT_CATEGORIES,
                   "weekend_flg": [False, True]}


def build_features(panel: DataFrame, y: str = "discount_off", fill_zero: bool = True,
                   digits: int | None = None) -> DataFrame:
    """The 25-column feature frame (X1): 5 lags, 12 rolling stats, calendar, 4 events.

    All lag/rolling columns share one window spec -> one exchange + one sort.
    Warm-up nulls become 0 (P6). The label is carried as ``label`` but is never
    part of a feature list (Q12). ``digits`` rounds the rolling means and sums.
    """
    cols = {**lag_columns(y), **rolling_columns(panel, y, digits=digits)}
    keep = [c for c in ["brand", "posted_date", "rn", "n", "gwp", "discount_off"] if c in panel.columns]
    out = panel.select(
        *keep, *[v.alias(k) for k, v in cols.items()],
        "year", "month", "day", "weekend_flg",
        F.col("event_1day"), F.col("event_7days").alias("event_7day"),
        F.col("event_14days").alias("event_14day"), F.col("event_1month").alias("event_month"),
        F.col(y).alias("label"))
    if fill_zero:
        out = out.fillna(0.0, subset=LAG_FEATURES + ROLL_FEATURES)
    return out


def filter_deal_days(df: DataFrame) -> DataFrame:
    """Deal days only: a gift or a non-zero discount (P4). Apply after lags so lags see all days."""
    return df.where(F.col("gwp") | (F.col("discount_off") != 0))


def _slug(v) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in str(v)).strip("_").lower()


def one_hot_columns(sources: dict = ONE_HOT_SOURCES) -> list[tuple[str, str, object]]:
    return [(f"{src}__{_slug(v)}", src, v) for src, cats in sources.items() for v in cats]


def one_hot(df: DataFrame, sources: dict = ONE_HOT_SOURCES,
            drop: tuple = ("event_1day", "event_7day", "event_14day", "event_month", "weekend_flg")) -> DataFrame:
    """0/1 indicator per fixed category (X2); drops the source columns as the reference does."""
    ind = [F.when(F.col(src) == F.lit(v), 1).otherwise(0).alias(name) for name, src, v in one_hot_columns(sources)]
    return df.select(*[c for c in df.columns if c not in drop], *ind)


def feature_names(sources: dict = ONE_HOT_SOURCES) -> list[str]:
    return NUMERIC_FEATURES + [n for n, _, _ in one_hot_columns(sources)]


def label_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Sorted distinct values -> 0..k-1 (X3), with MLlib's StringIndexer in
    alphabetical order (the category dictionary is fitted once, then applied
    row by row)."""
    from pyspark.ml.feature import StringIndexer
    out = out or f"{col}_code"
    ix = StringIndexer(inputCol=col, outputCol="_ix", stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    return ix.transform(df).withColumn(out, F.col("_ix").cast("int")).drop("_ix")


def conform(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep only the columns both frames have, in ``a``'s order (P8). Schema-only, no job."""
    common = [c for c in a.columns if c in set(b.columns)]
    return a.select(*common), b.select(*common)


def _unpivot_aggs(wide: DataFrame, by: list[str], names: list[str], value: str) -> DataFrame:
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr(*by, f"stack({len(names)}, {stack}) AS (feature, {value})")


def f_regression(df: DataFrame, feats: list[str], y: str, by: list[str] | None = None,
                 digits: int | None = None) -> DataFrame:
    """Univariate F score per feature (X4): r^2 / (1 - r^2) * (n - 2). One aggregation."""
    by = by or []
    aggs = [safe_corr(f, y).alias(f) for f in feats]
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *aggs)
    long = _unpivot_aggs(wide.withColumnRenamed("_n", "n_rows"), by + ["n_rows"], feats, "r")
    r2 = F.col("r") * F.col("r")
    f = F.when(1 - r2 > 0, r2 / (1 - r2) * (F.col("n_rows") - 2))
    fv = F.round(f, digits) if digits is not None else f
    return long.select(*by, "feature", fv.alias("f_score"))


def f_classif(df: DataFrame, feats: list[str], label: str, by: list[str] | None = None,
              digits: int | None = None) -> DataFrame:
    """One-way ANOVA F per feature for a class label (X5) from per-class moments.

    Per class: count, mean and population variance (numerically stable running
    moments). between = sum_c n_c (mean_c - mean)^2 / (k - 1);
    within = sum_c n_c var_c / (n - k). Null when within is 0.
    """
    by = by or []
    x = {f: F.col(f).cast("double") for f in feats}
    per = df.groupBy(*by, label).agg(
        F.count(F.lit(1)).alias("nc"),
        *[F.avg(x[f]).alias(f"m__{f}") for f in feats],
        *[F.var_pop(x[f]).alias(f"v__{f}") for f in feats])
    stack = ", ".join(f"'{f}', `m__{f}`, `v__{f}`" for f in feats)
    long = per.selectExpr(*by, label, "nc", f"stack({len(feats)}, {stack}) AS (feature, m, v)")
    g = long.groupBy(*by, "feature").agg(
        F.sum("nc").alias("n"), F.count(F.lit(1)).alias("k"),
        (F.sum(F.col("nc") * F.col("m")) / F.sum("nc")).alias("grand"),
        F.sum(F.col("nc") * F.col("v")).alias("ssw"),
        F.collect_list(F.struct("nc", "m")).alias("cls"))
    ssb = F.aggregate("cls", F.lit(0.0), lambda acc, c: acc + c["nc"] * (c["m"] - F.col("grand")) * (c["m"] - F.col("grand")))
    f = F.when((F.col("ssw") > 0) & (F.col("k") > 1),
               (ssb / (F.col("k") - 1)) / (F.col("ssw") / (F.col("n") - F.col("k"))))
    fv = F.round(f, digits) if digits is not None else f
    return g.select(*by, "feature", fv.alias("f_score"))


def mutual_info(df: DataFrame, feats: list[str], y: str, bins: int = 10, by: list[str] | None = None,
                digits: int | None = None) -> DataFrame:
    """Binned mutual information between each feature and a discrete label (X6), in nats.

    Features are cut into equal-frequency bins at their exact percentiles (a value on a
    cut belongs to the bin below; equal cuts leave fewer bins);
    MI = sum p(b, y) log(p(b, y) / (p(b) p(y))). The reference used a
    neighbour-based estimator, so values differ; the ranking is what is used.
    """
    by = by or []
    stack = ", ".join(f"'{f}', CAST(`{f}` AS DOUBLE)" for f in feats)
    long = df.withColumn("_y", F.col(y)).selectExpr(*by, "_y", f"stack({len(feats)}, {stack}) AS (feature, x)")
    # one row of cuts per group and feature, from range slices: no group's values are in one buffer
    cuts = quantiles(long, [*by, "feature"], "x", [i / bins for i in range(1, bins)]).drop("n")
    below = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("x"))), F.lit(0))
    long = long.join(cuts, [*by, "feature"], "left").select(*by, "feature", "_y", below.alias("bin"))
    cnt = long.groupBy(*by, "feature", "bin", "_y").agg(F.count(F.lit(1)).alias("c"))
    from pyspark.sql import Window
    wf = Window.partitionBy(*by, "feature")
    wb = Window.partitionBy(*by, "feature", "bin")
    wy = Window.partitionBy(*by, "feature", "_y")
    n = F.sum("c").over(wf)
    pb = F.sum("c").over(wb)
    py = F.sum("c").over(wy)
    term = (F.col("c") / n) * F.log(F.col("c") * n / (pb * py))
    mi = cnt.select(*by, "feature", term.alias("t")).groupBy(*by, "feature").agg(F.sum("t").alias("mi"))
    return mi.select(*by, "feature", (F.round("mi", digits) if digits is not None else F.col("mi")).alias("mi"))


def select_k_best(scores: DataFrame, k: int, score_col: str = "f_score", by: list[str] | None = None) -> DataFrame:
    """Top-k features by score (T2); ties broken by feature name. A limit that is the feature itself."""
    from pyspark.sql import Window
    by = by or []
    w = Window.partitionBy(*by).orderBy(F.desc_nulls_last(score_col), "feature")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def scoring_frame(features: DataFrame, feats: list[str], skip: int = 6, tail: int = 365) -> DataFrame:
    """Tail days to score (J4): positions [n - tail, n - 1) of each brand; deal
    days keep their features, other days get all-zero features -- what
    re-indexing the deal-day feature rows onto the tail calendar and filling
    zeros gives. Every day already has its features, so no join is needed."""
    rn, n = F.col("rn"), F.col("n")
    tail_days = features.where((rn >= n - (tail - 1)) & (rn < n))
    deal = F.col("gwp") | (F.col("discount_off") != 0)
    return tail_days.select("brand", "posted_date", (rn - (n - (tail - 1))).cast("int").alias("day_ahead"),
                            *[F.when(deal, F.col(f)).otherwise(F.lit(0)).cast("double").alias(f) for f in feats])
