"""Class balance, class weights and SMOTE oversampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealcast.functions.draws import uniform_draw
from dealcast.operators.neighbours import knn_join
from dealcast.operators.ordered import running_sums


def class_balance(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Rows per class and share of the group (B2). The window runs on the
    aggregated counts (one row per class), not on the data."""
    by = by or []
    c = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    if not by:
        return c.withColumn("share", F.col("n") / F.lit(c.agg(F.sum("n")).first()[0]))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def class_weights(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Balanced class weight n / (k * n_c) per class."""
    by = by or []
    c = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n_c"))
    if not by:
        t = c.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k")).first()
        return c.withColumn("weight", F.lit(float(t["n"])) / (F.lit(t["k"]) * F.col("n_c")))
    w = Window.partitionBy(*by)
    return c.withColumn("weight", F.sum("n_c").over(w) / (F.count(F.lit(1)).over(w) * F.col("n_c")))


def with_class_weight(df: DataFrame, label: str, by: list[str] | None = None, out: str = "weight") -> DataFrame:
    """Attach the balanced weight to every row (for ``weightCol``); the per-class
    table is tiny and joined by class."""
    w = class_weights(df, label, by).select(*(by or []), label, F.col("weight").alias(out))
    return df.join(w, [*(by or []), label])


def smote(df: DataFrame, id_col: str, label: str, vec: str = "vec", k: int = 5, seed: int = 42,
          chunk: int = 10_000) -> DataFrame:
    """SMOTE: synthesise minority rows until every class has the majority's count (B1).

    * the need of class c is n_max - n_c; row r (1-based rank by id inside its
      class, from a distributed prefix count) makes q or q + 1 samples so the
      class total is exact (q, rem = divmod(need, n_c); rank <= rem gets one more)
    * sample s of row i takes neighbour number 1 + floor(n_nn * u1) of its k
      nearest same-class neighbours (exact, ``knn_join`` per class) and a gap u2
      in [0, 1): x_new = x + u2 * (x_nn - x); u1, u2 are md5 draws of (seed, id,
      s), so the result does not depend on partitioning or retries.

    Each source row first gets its vector and its k neighbours' vectors (one row
    per source point); its quota is then split into chunks of ``chunk`` samples
    that are hash-spread over tasks before the samples are generated from those
    arrays. A tiny class that must grow a million-fold is therefore generated
    by many tasks, with no join after the expansion.

    Output: synthetic rows (label, source id, s, neighbour id, gap, vec).
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    n_max = counts.agg(F.max("n_c")).first()[0] or 0  # one scalar
    need = counts.select(label, "n_c", (F.lit(n_max) - F.col("n_c")).alias("need"))
    ranked = running_sums(df.select(id_col, label).withColumn("_one", F.lit(1)), [label], id_col, ["_one"],
                          out_prefix="rank_", with_totals=False)
    alloc = ranked.join(need, label).select(
        id_col, label,
        (F.floor(F.col("need") / F.col("n_c")) + F.when(F.col("rank__one") <= F.pmod(F.col("need"), F.col("n_c")), 1).otherwise(0)).cast("long").alias("m_i"))
    alloc = alloc.where(F.col("m_i") > 0)
    # only classes that need rows are searched, for the rows that make samples
    lone = need.where((F.col("need") > 0) & (F.col("n_c") < 2)).select(label).limit(20).collect()
    if lone:
        raise ValueError(f"classes with a single row have no neighbours to draw from: {[r[0] for r in lone]}")
    points = df.select(id_col, label, vec).join(need.where(F.col("need") > 0).select(label), label, "left_semi")
    sources = points.join(alloc.select(id_col), id_col, "left_semi")
    nn = knn_join(sources, points, k, id_col, id_col, vec, by=[label], exclude_self=True)
    vecs = df.select(F.col(id_col).alias("nn_id"), F.col(vec).alias("_n"))
    nbrs = (nn.join(vecs, "nn_id").groupBy(id_col)
            .agg(F.array_sort(F.collect_list(F.struct("rank", "nn_id", "_n"))).alias("_nbrs")))  # k per id
    src = alloc.join(df.select(id_col, F.col(vec).alias("_x")), id_col).join(nbrs, id_col)
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (src.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("m_i") - 1) / chunk))).alias("_chunk"))
              .repartition(n_parts, id_col, "_chunk"))
    reps = chunks.select(
        "*", F.explode(F.sequence(F.col("_chunk") * chunk + 1,
                                  F.least(F.col("m_i"), (F.col("_chunk") + 1) * chunk))).alias("s"))
    n_nn = F.size("_nbrs")
    pick = F.element_at("_nbrs", (F.floor(uniform_draw(F.lit(seed), id_col, "s", F.lit("nn")) * n_nn) + 1).cast("int"))
    reps = reps.select(label, id_col, F.col("s").cast("int").alias("s"), "_x", pick.alias("_p"),
                       uniform_draw(F.lit(seed), id_col, "s", F.lit("gap")).alias("gap"))
    new = F.zip_with("_x", F.col("_p._n"),
                     lambda x, y: x.cast("double") + F.col("gap") * (y.cast("double") - x.cast("double")))
    return reps.select(label, id_col, "s", F.col("_p.nn_id").alias("nn_id"), "gap", new.alias(vec))
