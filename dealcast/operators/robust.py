"""Theil-Sen lines: the median of all pairwise slopes of a group, without making the pairs (M5).

For points in the order of x, a pair's slope is at most s exactly where the later point's
y - s * x is not above the earlier one's. So the number of slopes up to s is a number of inversions,
which sorting counts, and the median is the least s that enough slopes don't exceed. The search
tries ``WAYS`` values of s a round for all groups at once, between bounds that it narrows.

A group is cut into slices of ``SLICE`` points in the order of x. Inversions inside a slice are
counted by a merge sort in a task; those between slices level by level, where two neighbouring
runs of slices meet: a right point's partners are the left points not below it, a
running count over range slices (``ordered.running_sums``). No task holds a group.

Defined cases: rows with a null or NaN x or y take no part; pairs of equal x have no slope; a group
without a pair of different x gets a null line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.operators.ordered import quantiles, running_sums
from dealcast.session import cut_lineage

#: Points of a slice, slopes tried a round, and the width of the bounds (against the slope, or that of evenly spread points) at which the search ends.
SLICE, WAYS, WIDTH = 8192, 63, 1e-12
MAX_ROUNDS = 60


def not_above(z) -> int:
    """Pairs i < j with z[j] <= z[i]: merge sort, all blocks of a level at once."""
    import numpy as np
    n = len(z)
    if n < 2:
        return 0
    rank = np.unique(z, return_inverse=True)[1].astype(np.int64)
    size = 1 << (n - 1).bit_length()
    top = n + 1
    rows = np.concatenate([rank, np.full(size - n, n, np.int64)]).reshape(-1, 1)  # padding is above all, at the end
    total = 0
    while len(rows) > 1:
        left, right = rows[0::2], rows[1::2]
        shift = (np.arange(len(left)) * top)[:, None]
        below = np.searchsorted((left + shift).ravel(), (right + shift).ravel(), side="left") - np.repeat(np.arange(len(left)) * left.shape[1], right.shape[1])
        total += int((left.shape[1] - below)[right.ravel() < n].sum())  # padding is never left of a point
        rows = np.sort(np.concatenate([left, right], axis=1), axis=1)
    return total


def _sliced(points: DataFrame, by: list[str]) -> DataFrame:
    """by, slice, m (points), xs, ys: the points of a group in the order of (x, y), ``SLICE`` at a time."""
    ranked = running_sums(points.withColumns({"_at": F.struct("x", "y", "_row"), "_one": F.lit(1)}), by, "_at", ["_one"], with_totals=False)
    cut = ranked.withColumn("slice", F.floor((F.col("cum__one") - 1) / SLICE).cast("int"))
    got = cut.groupBy(*by, "slice").agg(F.count(F.lit(1)).alias("m"), F.array_sort(F.collect_list(F.struct("x", "y"))).alias("p"))
    return got.select(*by, "slice", "m", F.col("p.x").alias("xs"), F.col("p.y").alias("ys"))


def _inside(slices: DataFrame, tried: DataFrame, by: list[str]) -> DataFrame:
    """by, k (number of the slope tried), c: pairs up to it inside slices."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            rows = []
            for x, y, slopes in zip(*(b.column(c).to_pylist() for c in ("xs", "ys", "slopes"))):
                x, y = np.array(x), np.array(y)
                rows.append([not_above(y - s * x) for s in slopes])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in by), pa.array(rows, pa.list_(pa.int64()))], [*by, "counts"])

    joined = slices.join(tried, by).select(*by, "xs", "ys", "slopes")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slices.schema if f.name in by)
    return joined.mapInArrow(run, f"{kinds}, counts array<long>").select(*by, F.posexplode("counts").alias("k", "c"))


def _between(slices: DataFrame, tried: DataFrame, by: list[str], levels: int) -> DataFrame:
    """by, k, c: pairs up to each slope tried whose points lie in different slices."""
    each = slices.join(tried, by).select(*by, "slice", F.explode(F.arrays_zip("xs", "ys")).alias("p"), "slopes") \
        .select(*by, "slice", F.col("p.xs").alias("x"), F.col("p.ys").alias("y"), F.posexplode("slopes").alias("k", "s"))
    each = each.select(*by, "k", "slice", (F.col("y") - F.col("s") * F.col("x")).alias("z"), F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    # slices' rows with one z are one row each of the sort; the left ones come first among equals
    met = each.withColumns({"node": F.expr("shiftright(slice, level + 1)"), "right": F.expr("shiftright(slice, level) & 1")}) \
        .groupBy(*by, "k", "level", "node", "z").agg(F.sum(1 - F.col("right")).alias("lefts"), F.sum("right").alias("rights"))
    run = running_sums(met, [*by, "k", "level", "node"], "z", ["lefts"], descending=True, with_totals=False)
    return run.groupBy(*by, "k").agg(F.sum(F.col("cum_lefts") * F.col("rights")).alias("c"))


def theil_sen(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """by, slope, intercept: the median of all pairwise slopes, and the median of y - slope * x."""
    xx, yy = F.col(x).cast("double"), F.col(y).cast("double")
    points = cut_lineage(df.select(*by, xx.alias("x"), yy.alias("y")).where("x is not null and y is not null and not isnan(x) and not isnan(y)")
                         .withColumn("_row", F.monotonically_increasing_id()))
    slices = cut_lineage(_sliced(points, by))
    same_x = points.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("m")).groupBy(*by).agg(F.sum(F.expr("m * (m - 1) div 2")).alias("flat"))
    same = points.groupBy(*by, "x", "y").agg(F.count(F.lit(1)).alias("m")).groupBy(*by).agg(F.sum(F.expr("m * (m - 1) div 2")).alias("equal"))
    size = points.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.max("y") - F.min("y")).alias("dy"), (F.max("x") - F.min("x")).alias("dx"))
    pairs = F.expr("n * (n - 1) div 2") - F.col("flat")
    start = size.join(same_x, by).join(same, by).withColumn("pairs", pairs).where("pairs > 0")
    # the first bounds: the steepest slope if points were evenly spread; widened until they hold the median
    reach = F.col("dy") / F.col("dx") * F.col("n") + 1e-9
    state = start.select(*by, "equal", F.explode(F.array(F.expr("(pairs + 1) div 2"), F.expr("pairs div 2 + 1"))).alias("want"), reach.alias("reach"), (F.col("dy") / F.col("dx")).alias("even")) \
        .distinct().withColumns({"lo": -F.col("reach"), "hi": F.col("reach"), "sure": F.lit(False)})
    state = cut_lineage(state)
    most = slices.agg(F.max("slice").alias("s")).first()["s"]
    levels = int(most or 0).bit_length()
    several = slices.join(slices.where("slice > 0").select(*by).distinct(), by)
    grid = F.transform(F.sequence(F.lit(1), F.lit(WAYS)), lambda i: F.col("lo") + (F.col("hi") - F.col("lo")) * i / (WAYS + 1))
    open_ = ~F.col("sure") | ((F.col("hi") - F.col("lo")) > WIDTH * F.greatest(F.abs("lo"), F.abs("hi"), F.col("even")))
    for _ in range(MAX_ROUNDS):
        asked = state.where(open_).select(*by, F.concat(F.array("lo"), grid, F.array("hi")).alias("slopes"))
        if asked.isEmpty():
            break
        # a group's one or two searches try their slopes in one pass
        tried = asked.groupBy(*by).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("slopes")))).alias("slopes"))
        counts = _inside(slices, tried, by)
        if levels:
            counts = counts.unionByName(_between(several, tried, by, levels))
        counts = counts.groupBy(*by, "k").agg(F.sum("c").alias("c"))
        at = tried.select(*by, F.posexplode("slopes").alias("k", "s")).join(counts, [*by, "k"]).select(*by, "s", "c")
        upto = F.col("c") - F.col("equal")
        seen = state.join(at, by, "left").groupBy(*by, "want", "equal", "reach", "even", "lo", "hi", "sure").agg(
            F.max(F.when(upto < F.col("want"), F.col("s"))).alias("under"), F.min(F.when(upto >= F.col("want"), F.col("s"))).alias("over"))
        sure = F.col("sure") | (F.col("under").isNotNull() & F.col("over").isNotNull())
        wider = F.col("reach") * 1024
        state = cut_lineage(seen.select(
            *by, "want", "equal", F.when(sure, F.col("reach")).otherwise(wider).alias("reach"), "even",
            F.when(sure, F.greatest("lo", "under")).otherwise(-wider).alias("lo"), F.when(sure, F.least("hi", "over")).otherwise(wider).alias("hi"), sure.alias("sure")))
    slope = state.groupBy(*by).agg(F.avg("hi").alias("slope"))
    rest = points.join(slope, by).select(*by, (F.col("y") - F.col("slope") * F.col("x")).alias("r"))
    level = quantiles(rest, by, "r", [0.5]).select(*by, F.col("cuts")[0].alias("intercept"))
    return size.select(*by).join(slope, by, "left").join(level, by, "left")
