"""Train/test splits and cross-validation folds (S1-S5), all as columns or exploded rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealcast.functions.draws import uniform_draw


def split_tail(panel: DataFrame, skip: int = 6, tail: int = 365) -> DataFrame:
    """Positional hold-out per brand (S1): positions [skip, n-tail) train,
    [n-tail, n-1) test, the very last day 'last', leading days 'skip' (Q16).

    Needs ``rn``/``n`` (1-based position, length) from ``fill_calendar``.
    """
    rn, n = F.col("rn"), F.col("n")
    split = (F.when(rn == n, "last")
              .when(rn >= n - (tail - 1), "test")
              .when(rn >= skip + 1, "train")
              .otherwise("skip"))
    return panel.withColumn("split", split)


def _ranked(df: DataFrame, groups: list[str], order, rank_col: str) -> DataFrame:
    """1-based rank within ``groups`` by ``order`` (unique within a group), from
    the distributed prefix count -- no single task sorts a whole group, even
    when one group holds a large share of the rows."""
    from dealcast.operators.ordered import running_sums
    base = df.withColumns({"_ord": order, "_one": F.lit(1)})
    r = running_sums(base, groups, "_ord", ["_one"], out_prefix="_r", with_totals=True)
    return r.withColumnsRenamed({"_r_one": rank_col, "tot__one": f"{rank_col}_n"}).drop("_ord", "_one")


def split_random(df: DataFrame, key_cols: list[str], train_frac: float = 0.7, seed: int = 42,
                 by: list[str] | None = None) -> DataFrame:
    """Seeded random split (S2): within each group, rows ordered by an md5 draw of
    (seed, key); the first floor(frac * n) are train (n * frac in double
    arithmetic, as a float train size gives)."""
    by = by or []
    order = F.struct(uniform_draw(F.lit(seed), *key_cols).alias("d"), *[F.col(c) for c in key_cols])
    r = _ranked(df, by, order, "_rk")
    out = r.withColumn("split", F.when(F.col("_rk") <= F.floor(F.col("_rk_n") * train_frac), "train").otherwise("test"))
    return out.drop("_rk", "_rk_n")


def split_random_bernoulli(df: DataFrame, key_cols: list[str], train_frac: float = 0.7, seed: int = 42) -> DataFrame:
    """Per-row independent split by the md5 draw: no ranking at all, any group size."""
    return df.withColumn("split", F.when(uniform_draw(F.lit(seed), *key_cols) < train_frac, "train").otherwise("test"))


def stratified_folds(df: DataFrame, label: str, key_cols: list[str], k: int = 10, seed: int = 2,
                     by: list[str] | None = None) -> DataFrame:
    """Stratified k-fold (S3): rows of each (group, class) ranked by md5 draw, fold = rank mod k.

    Every fold gets floor or ceil of n_class / k rows of each class.
    """
    by = by or []
    order = F.struct(uniform_draw(F.lit(seed), *key_cols).alias("d"), *[F.col(c) for c in key_cols])
    r = _ranked(df, [*by, label], order, "_rk")
    return r.withColumn("fold", F.pmod(F.col("_rk") - 1, F.lit(k)).cast("int")).drop("_rk", "_rk_n")


def walk_forward_folds(df: DataFrame, n_splits=20, test_size: int | None = None, gap: int = 0,
                       pos_col: str = "pos", n_col: str = "n_rows") -> DataFrame:
    """Expanding-window walk-forward folds (S4, S5) as (fold, role) rows.

    With n rows and ts = test_size or n // (n_splits + 1): fold i tests
    [n - (n_splits - i) * ts, n - (n_splits - i - 1) * ts) and trains on every
    earlier position up to ``gap`` before the test start. Each row is exploded to
    the folds it takes part in (at most n_splits copies); no join is needed.
    ``pos_col`` is 0-based within the group, ``n_col`` the group size;
    ``n_splits`` may be a column (e.g. 20 for long series, 5 for short ones).
    """
    k = n_splits if isinstance(n_splits, Column) else F.lit(n_splits)
    n, p = F.col(n_col), F.col(pos_col)
    ts = F.lit(test_size) if test_size else F.floor(n / (k + 1))
    first_test = n - ts * k
    own = F.when(p >= first_test, F.floor((p - first_test) / ts)).otherwise(F.lit(-1))
    # first fold i where p is train: first_test + i * ts - gap > p
    first_train = F.greatest(F.lit(0), F.floor((p + gap - first_test) / ts) + 1)
    ok = ts > 0
    train_folds = F.when(ok & (first_train <= k - 1), F.transform(
        F.sequence(first_train.cast("int"), (k - 1).cast("int")),
        lambda f: F.struct(f.alias("fold"), F.lit("train").alias("role"))))
    test_fold = F.when(ok & (own >= 0) & (own < k), F.array(
        F.struct(own.cast("int").alias("fold"), F.lit("test").alias("role"))))
    empty = F.array().cast("array<struct<fold:int,role:string>>")
    roles = F.concat(F.coalesce(train_folds, empty), F.coalesce(test_fold, empty))
    out = df.select("*", F.explode(roles).alias("_fr"))
    return out.select(*df.columns, "_fr.fold", "_fr.role")


def time_series_split(df: DataFrame, n_splits: int = 10, pos_col: str = "pos", n_col: str = "n_rows") -> DataFrame:
    """Equal-block time-series split (S5): ``walk_forward_folds`` with n // (n_splits + 1) test rows."""
    return walk_forward_folds(df, n_splits, None, 0, pos_col, n_col)
