"""Exact running sums over very large ordered groups, without one-task windows.

A plain ``sum(...) over (partition by g order by x)`` puts a whole group into
one task. Curves over scores need running counts over every distinct score of a
group, which at scale is far more than one task should sort. Here:

1. rows are range-partitioned on (group, order) into contiguous *slices*, and
   the slice id is materialised with a reliable checkpoint so every later
   branch sees identical slices (a recomputed range sample could differ);
2. a window partitioned by (group, slice) gives the running sums inside a slice;
3. slice totals (at most one row per slice and group) give each slice's offset.

Rows must be unique on (group, order) -- callers aggregate ties first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealcast.session import cut_lineage


def running_sums(df: DataFrame, by: list[str], order_col: str, value_cols: list[str],
                 descending: bool = False, out_prefix: str = "cum_", with_totals: bool = True,
                 num_slices: int | None = None, next_cols: list[str] | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` within ``by`` in ``order_col`` order.

    Adds ``{out_prefix}{c}`` and, with ``with_totals``, the group total ``tot_{c}``.
    ``next_cols`` adds ``next_{c}``: the value on the following row of the group
    (null on its last row), also across slice boundaries -- the first row of
    the group's next non-empty slice, found on the (slice x group) table.
    """
    spark = df.sparkSession
    n_slices = num_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = F.col(order_col).desc() if descending else F.col(order_col).asc()
    sliced = cut_lineage(df.repartitionByRange(n_slices, *[F.col(b) for b in by], o)
                         .withColumn("_slice", F.spark_partition_id()))
    w_in = Window.partitionBy(*by, "_slice").orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = sliced.withColumns({f"_loc_{c}": F.sum(c).over(w_in) for c in value_cols})
    tot = sliced.groupBy(*by, "_slice").agg(*[F.sum(c).alias(f"_t_{c}") for c in value_cols])
    w_prev = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*by)
    offs = {f"_off_{c}": F.coalesce(F.sum(f"_t_{c}").over(w_prev), F.lit(0)) for c in value_cols}
    if with_totals:
        offs.update({f"tot_{c}": F.sum(f"_t_{c}").over(w_all) for c in value_cols})
    nxt = next_cols or []
    if nxt:
        # first row of each (group, slice), handed to the group's previous slice
        pick = F.max_by if descending else F.min_by
        firsts = sliced.groupBy(*by, "_slice").agg(
            pick(F.struct(*[F.col(c) for c in nxt]), F.col(order_col)).alias("_first"))
        w_s = Window.partitionBy(*by).orderBy("_slice")
        follow = firsts.select(*by, "_slice", F.lead("_first").over(w_s).alias("_follow"))
        tot = tot.join(follow, [*by, "_slice"])
        offs.update({f"_follow_{c}": F.col(f"_follow.{c}") for c in nxt})
        local = local.withColumns({f"_ln_{c}": F.lead(c).over(Window.partitionBy(*by, "_slice").orderBy(o))
                                   for c in nxt})
    off = tot.select(*by, "_slice", *[v.alias(k) for k, v in offs.items()])
    j = local.join(off, [*by, "_slice"])
    outs = [(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"{out_prefix}{c}") for c in value_cols]
    if with_totals:
        outs += [F.col(f"tot_{c}") for c in value_cols]
    outs += [F.coalesce(F.col(f"_ln_{c}"), F.col(f"_follow_{c}")).alias(f"next_{c}") for c in nxt]
    return j.select(*df.columns, *outs)


def quantiles(df: DataFrame, by: list[str], value: str, shares: list[float], out: str = "cuts") -> DataFrame:
    """Exact quantiles of ``value`` per group as an array column: by, n, out.

    The value at share p lies at position p * (n - 1) of the sorted non-null values,
    interpolated between its neighbours. Values are counted once each, their running
    counts come from range slices, and a position's value is the least one whose running
    count passes it: no group is sorted or held by one task. A null key is a group of
    its own; a group without values gives no row.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    # nulls of a key and of another group must not meet in a join: keys travel as structs, which are never null
    counted = df.where(F.col(value).isNotNull()) \
        .groupBy(*[F.struct(F.col(b).alias("v")).alias(k) for b, k in zip(by, keys)], F.col(value).cast("double").alias("_v")) \
        .agg(F.count(F.lit(1)).alias("_c"))
    if not by:
        counted, keys = counted.withColumn("_all", F.lit(0)), ["_all"]
    run = running_sums(counted, keys, "_v", ["_c"])
    at = []
    for p in shares:
        h = (F.col("tot__c") - 1) * F.lit(float(p))
        low = F.floor(h)
        at += [F.min(F.when(F.col("cum__c") > low, F.col("_v"))), F.min(F.when(F.col("cum__c") > F.least(low + 1, F.col("tot__c") - 1), F.col("_v"))),
               F.max(h - low)]
    found = run.groupBy(*keys).agg(F.max("tot__c").alias("n"), *[c.alias(f"_a{i}") for i, c in enumerate(at)])
    cuts = [F.col(f"_a{i}") + (F.col(f"_a{i + 1}") - F.col(f"_a{i}")) * F.col(f"_a{i + 2}") for i in range(0, len(at), 3)]
    return found.select(*[F.col(k)["v"].alias(b) for b, k in zip(by, keys)], "n", F.array(*cuts).alias(out))
