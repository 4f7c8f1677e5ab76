"""Quality rules: base counts of every text and robust multivariate outliers.

For each (language, source) group the minimum covariance determinant is searched from
several starts: the group's medians and quartile spreads, and ``STARTS`` small sets of rows
drawn by hash. A concentration step takes distances under a start's centre and scatter, the
group's share ``CORE`` of rows nearest to the centre, and their mean and covariance. After
``SCREENING`` steps the ``BEST`` starts of least determinant go on, each until its
determinant stops falling, and the least one is the group's estimate. A document whose
Mahalanobis distance exceeds a chi-square cut-off is rejected. All steps are grouped sums
and quantile sketches over a narrow table of one row per document, so a group that holds a
third of all rows is pre-aggregated by every task; only group parameters move.

Defined cases: a null text has no words and fails the base rule; null languages and
sources are groups of their own; groups under ``MIN_ROWS`` documents use their language's
estimate, small languages that of all documents, and where even those are fewer no
document is rejected by distance. Other columns are kept untouched by ``screen``,
repeated rows are judged alike, and an empty table gives an empty result. Rows of a start
are drawn by a hash of their statistics, so repeated rows are drawn as one and ids and
partitions don't matter; equal determinants go to the first start.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealcast.llm.arrays import blank_words, following, let
from dealcast.llm.common import written

MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = r"[#*$%&|<>]"

#: Share of a group that the estimate rests on, and the accuracy of its edge's sketch.
CORE, ACCURACY = 0.75, 10_000
#: Starts drawn besides the medians, rows drawn for each, steps of all starts, and starts that go on.
STARTS, DRAWN, SCREENING, BEST = 6, 6, 2, 2
#: A determinant falls if its logarithm does by more than this.
FALL = 1e-3
#: Documents a group needs for an estimate of its own.
MIN_ROWS = 200
#: Share of ordinary documents that the cut-off may reject, were the statistics normal.
TAIL = 1e-6
#: Statistics and the standard deviation that is noise in each: mean word length (log),
#: symbols per word (log), share of repeated lines, share of repeated words.
NOISE = {"x_length": 0.12, "x_symbols": 0.05, "x_lines": 0.12, "x_words": 0.08}
X = list(NOISE)
#: Words of average length added to a text, so that short texts aren't outliers by chance.
PRIOR_WORDS, PRIOR_CHARS = 20, 5


def chi2_even(x: float, df: int) -> float:
    """Distribution function of chi-square with an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_even_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_even(mid, df) < p else (lo, mid)
    return hi


def repeated_words(w: Column, n: Column) -> Column:
    """Words in windows of WINDOW words that stand at least twice in the text.

    Window hashes tell the texts in which nothing repeats; in the others the windows
    themselves are sorted with their places, and neighbours compared.
    """
    def covered(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))

        def starts(s):
            pairs = F.zip_with(F.slice(s, F.lit(1), F.size(s) - 1), F.slice(s, F.lit(2), F.size(s) - 1),
                               lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
            return F.sort_array(F.array_distinct(F.flatten(pairs)))

        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        add = lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + WINDOW - F.greatest(a["end"] - i, F.lit(0))).alias("n"))
        return F.aggregate(let(placed, starts), zero, add, lambda a: a["n"])

    grams = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.array_join(F.slice(w, i, WINDOW), " "))
    hashes = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(n <= WINDOW, 0).otherwise(
        let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(grams))))


def base_counts(text: Column) -> Column:
    """One struct with the base counts of a whole text."""
    t = F.coalesce(text, F.lit(""))

    def counts(w: Column) -> Column:
        n = F.size(w)
        return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeated_words(w, n).cast("long").alias("n_repeat_words"))

    lines = F.filter(F.split(t, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    per_line = let(lines, lambda s: F.struct(F.size(s).cast("long").alias("n_lines"),
                                             (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines")))
    return let(F.struct(let(blank_words(t), counts).alias("w"), per_line.alias("l")), lambda c: F.struct(
        c["w"]["n_words"].alias("n_words"), c["w"]["word_chars"].alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"), c["l"]["n_lines"].alias("n_lines"),
        c["l"]["n_dup_lines"].alias("n_dup_lines"), c["w"]["n_repeat_words"].alias("n_repeat_words")))


def base_failed(c) -> Column:
    return (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > MAX_REPEATED_PERCENT * c("n_words"))


def statistics(c) -> dict[str, Column]:
    """Transformed statistics of a text with words."""
    return {
        "x_length": F.log((c("word_chars") + PRIOR_CHARS * PRIOR_WORDS) / (c("n_words") + PRIOR_WORDS)),
        "x_symbols": F.log1p(c("n_symbols") / c("n_words")),
        "x_lines": c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1)),
        "x_words": c("n_repeat_words") / c("n_words"),
    }


def moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance (with noise) of each group's rows under each start."""
    sums = [F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s_{x}") for x in X)]
    sums += [F.sum(F.col(a) * F.col(b)).alias(f"s_{a}{b}") for k, a in enumerate(X) for b in X[:k + 1]]
    m = rows.groupBy("grp", "start").agg(*sums)
    # The share CORE of normal rows nearest to the centre has this much less scatter.
    widen = CORE / chi2_even(chi2_even_quantile(CORE, len(X)), len(X) + 2)
    out = [F.col("grp"), F.col("start"), *((F.col(f"s_{x}") / F.col("n")).alias(f"m_{x}") for x in X)]
    for k, a in enumerate(X):
        for b in X[:k + 1]:
            cov = F.col(f"s_{a}{b}") / F.col("n") - F.col(f"s_{a}") * F.col(f"s_{b}") / F.col("n") / F.col("n")
            out.append((cov * widen + (NOISE[a] ** 2 if a == b else 0.0)).alias(f"c_{a}{b}"))
    return m.select(*out)


def factored(params: DataFrame) -> DataFrame:
    """The lower triangular (Cholesky) factor of each covariance, as columns l_*, and the logarithm of its determinant."""
    for k, a in enumerate(X):
        for j, b in enumerate(X[:k + 1]):
            rest = F.col(f"c_{a}{b}")
            for c in X[:j]:
                rest = rest - F.col(f"l_{a}{c}") * F.col(f"l_{b}{c}")
            value = F.sqrt(F.greatest(rest, F.lit(1e-9))) if a == b else rest / F.col(f"l_{b}{b}")
            params = params.withColumn(f"l_{a}{b}", value)
    logdet = 2 * sum((F.log(f"l_{x}{x}") for x in X[1:]), F.log(f"l_{X[0]}{X[0]}"))
    return params.select("grp", "start", logdet.alias("logdet"), *(f"m_{x}" for x in X), *(f"l_{a}{b}" for k, a in enumerate(X) for b in X[:k + 1]))


def distances(rows: DataFrame, params: DataFrame, more: tuple = ()) -> DataFrame:
    """``rows`` with d2, the squared Mahalanobis distance in their group, and columns ``more`` of the estimate."""
    out = rows.join(params, "grp", "left")
    for k, a in enumerate(X):
        rest = F.col(a) - F.col(f"m_{a}")
        for c in X[:k]:
            rest = rest - F.col(f"l_{a}{c}") * F.col(f"z_{c}")
        out = out.withColumn(f"z_{a}", rest / F.col(f"l_{a}{a}"))
    d2 = sum((F.col(f"z_{x}") * F.col(f"z_{x}") for x in X[1:]), F.col(f"z_{X[0]}") * F.col(f"z_{X[0]}"))
    return out.withColumn("d2", d2).select(*rows.columns, *more, "d2")


def with_groups(rows: DataFrame, min_rows: int) -> DataFrame:
    """``rows`` with grp, the group whose estimate judges them (null: none), and fits, the
    groups whose estimates they take part in: their own, and their language's or that of all
    documents where a smaller group needs it."""
    sizes = written(rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n")), "quality-groups")
    by_lang = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least")).alias("l")
    named = sizes.alias("s").join(by_lang, F.col("s.lang").eqNullSafe(F.col("l.lang"))).select("s.*", "l.n_lang", "l.least")
    whole = named.agg(F.sum("n").alias("n"), F.min("n_lang").alias("least")).first()
    n_all, least_lang = whole["n"] or 0, whole["least"] or 0
    own, lang, every = F.to_json(F.struct(F.lit(2).alias("by"), "lang", "source")), F.to_json(F.struct(F.lit(1).alias("by"), "lang")), F.lit("{}")
    grp = F.when(F.col("n") >= min_rows, own).when(F.col("n_lang") >= min_rows, lang).when(F.lit(n_all) >= min_rows, every)
    fits = F.array_compact(F.array(
        F.when(F.col("n") >= min_rows, own), F.when((F.col("n_lang") >= min_rows) & (F.col("least") < min_rows), lang),
        F.when(F.lit(n_all >= min_rows > least_lang), every)))
    named = written(named.select("lang", "source", grp.alias("grp"), fits.alias("fits")), "quality-groups").alias("g")
    on = F.col("r.lang").eqNullSafe(F.col("g.lang")) & F.col("r.source").eqNullSafe(F.col("g.source"))
    return rows.alias("r").join(named, on, "left").select("r.*", "g.grp", "g.fits")


def drawn(rows: DataFrame) -> DataFrame:
    """Rows of each drawn start (from 1): in each of ``DRAWN`` parts of a group, made by a hash, the row of least hash."""
    part = F.pmod(F.xxhash64(F.lit(0), *X), F.lit(DRAWN))
    least = [F.min(F.when(part == j, F.struct(F.xxhash64(F.lit(s), *X).alias("u"), *X))) for s in range(1, STARTS + 1) for j in range(DRAWN)]
    picks = F.array(*(F.struct(F.lit(1 + i // DRAWN).alias("start"), c.alias("row")) for i, c in enumerate(least)))
    one = rows.groupBy("grp").agg(picks.alias("picks")).select("grp", F.explode("picks").alias("p"))
    return one.where("p.row IS NOT NULL").select("grp", "p.start", *(F.col(f"p.row.{x}") for x in X))


def starts(rows: DataFrame) -> DataFrame:
    """The estimates that concentration begins with."""
    marks = rows.groupBy("grp").agg(*(F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.lit(1000)).alias(x) for x in X))
    middle = [F.col("grp"), F.lit(0).alias("start"), *(F.col(x)[1].alias(f"m_{x}") for x in X)]
    for k, a in enumerate(X):
        for b in X[:k + 1]:
            spread = (F.col(a)[2] - F.col(a)[0]) / 1.349
            middle.append((spread * spread + NOISE[a] ** 2 if a == b else F.lit(0.0)).alias(f"c_{a}{b}"))
    return factored(marks.select(*middle)).unionByName(factored(moments(drawn(rows))))


def concentrated(rows: DataFrame, params: DataFrame) -> DataFrame:
    """The estimates after one concentration step of each."""
    far = distances(rows, params, ("start",)).where(F.col("start").isNotNull())
    edge = written(far.groupBy("grp", "start").agg(F.percentile_approx("d2", F.lit(CORE), F.lit(ACCURACY)).alias("edge")), "quality-edge")
    core = far.join(edge, ["grp", "start"]).where(F.col("d2") <= F.col("edge"))
    return factored(moments(core))


def least(params: DataFrame, n: int) -> DataFrame:
    """The ``n`` estimates of least determinant of each group."""
    w = Window.partitionBy("grp").orderBy("logdet", "start")
    return params.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n).drop("_rk")


def fit(rows: DataFrame) -> DataFrame:
    """Centre and factored scatter of least determinant of each group of ``rows`` (fits and the statistics)."""
    rows = written(rows.select(F.explode("fits").alias("grp"), *X), "quality-stats")
    params = written(starts(rows), "quality-params")
    if params.isEmpty():
        return params
    for _ in range(SCREENING):
        params = written(concentrated(rows, params), "quality-params")
    params = least(params, BEST)
    falling = True
    while falling:
        # the lesser one of each estimate before and after a step, and how far it fell
        both = params.withColumn("_step", F.lit(0)).unionByName(concentrated(rows, params).withColumn("_step", F.lit(1)))
        kept = F.min_by(F.struct(*(F.col(c) for c in params.columns)), F.struct("logdet", "_step")).alias("p")
        fell = F.max(F.when(F.col("_step") == 0, F.col("logdet"))) - F.min("logdet")
        table = written(both.groupBy("grp", "start").agg(kept, fell.alias("fell")), "quality-params")
        falling = not table.where(F.col("fell") > FALL).isEmpty()
        params = table.select("p.*")
    return least(params, 1)


def screen(docs: DataFrame, keep_rows: bool = True, min_rows: int = MIN_ROWS) -> DataFrame:
    """Judge documents.

    Returns ``doc`` (the input row; only doc_id unless ``keep_rows``), ``counts`` (struct),
    ``base_failed``, ``d2`` and ``kept``.
    """
    doc = F.struct(*(F.col(f"`{c}`") for c in (docs.columns if keep_rows else ["doc_id"])))
    rows = docs.select(doc.alias("doc"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
                       base_counts(F.col("text")).alias("counts"))
    count = lambda c: F.col(f"counts.{c}")
    rows = rows.withColumn("base_failed", base_failed(count))
    for x, value in statistics(count).items():
        rows = rows.withColumn(x, F.when(~F.col("base_failed"), value))
    rows = written(rows, "quality-rows")
    rows = with_groups(rows, min_rows)
    params = fit(rows.where(~F.col("base_failed")))
    cut = chi2_even_quantile(1 - TAIL, len(X))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= cut, F.lit(True))
    return distances(rows, params.drop("start", "logdet")).select("doc", "counts", "base_failed", "d2", kept.alias("kept"))
