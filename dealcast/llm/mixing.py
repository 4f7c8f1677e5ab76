"""Mixing sources to target weights by Poisson replication.

A source with weight ``w`` of the mixture and ``n`` of the ``N`` documents repeats each of
its documents ``w * N / n`` times on average. Each document draws its count by inverting the
Poisson distribution function at a uniform number made from a hash of seed, doc_id, text and, where
several rows share both, the row's number, so rows without an id or under one id draw each for itself.
The draw needs no state and is the same after a retry; numbers are given once, to repeated rows alone, and
written with them.
Large rates are sums of draws with rates of at most ``PART``. Rows are exploded by
their counts and shuffled globally: dealt out and sorted by a hash of (seed, row, copy).
Source sizes are one pre-aggregated table; copies of a hot source spread over all tasks.

Defined cases: a null source is a source of its own; a source without a given weight has
weight zero and goes; a null id is hashed as the text "null", a null or missing text as the empty one; which
of several equal rows draws which count depends on the run; extra columns stay; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealcast.llm.common import written

SEED = 17
#: Largest rate of one draw, and terms of its distribution function that are added up.
PART, TERMS = 16, 90
#: Without given weights a source of n documents weighs n ** FLATTEN.
FLATTEN = 0.5


def uniform(*parts) -> Column:
    """A number in [0, 1) from the first 48 bits of a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 12), 16, 10).cast("double") / F.lit(2.0 ** 48)


def poisson(rate: Column, u: Column) -> Column:
    """The smallest count whose distribution function reaches u."""
    first = F.exp(-rate)
    zero = F.struct(first.alias("p"), first.alias("upto"), F.lit(0).alias("n"))

    def add(a, k):
        p = a["p"] * rate / k
        return F.struct(p.alias("p"), (a["upto"] + p).alias("upto"), (a["n"] + (a["upto"] < u).cast("int")).alias("n"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), zero, add, lambda a: a["n"])


def rates(docs: DataFrame, weights: dict[str, float] | None, total: float | None) -> DataFrame:
    """source, rate: mean repetitions of a source's documents."""
    sizes = written(docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(FLATTEN))
    else:
        pairs = [x for s, w in weights.items() for x in (F.lit(s), F.lit(float(w)))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source").cast("string")], F.lit(0.0))
    weighed = sizes.select("source", "n", weight.alias("w"))
    whole = weighed.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    if not whole["w"]:
        return weighed.select("source", F.lit(0.0).alias("rate"))
    rows = float(whole["n"] if total is None else total)
    return weighed.select("source", (F.lit(rows) * F.col("w") / F.lit(float(whole["w"])) / F.col("n")).alias("rate"))


def _named(docs: DataFrame, keep: list[str]) -> DataFrame:
    """doc (the input row), source, name: a text that no other row has, made from id, text and number."""
    text = F.col("text") if "text" in docs.columns else F.lit("")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("doc"), "source", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"),
                       F.md5(F.coalesce(text, F.lit("")).cast("binary")).alias("th"))
    again = written(rows.groupBy("id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", "th"), "mix-again")
    name = F.concat_ws(":", "id", "th", F.col("no").cast("string")).alias("name")
    if again.isEmpty():
        return rows.withColumn("no", F.lit(0)).select("doc", "source", name)
    alone = rows.join(again, ["id", "th"], "left_anti").withColumn("no", F.lit(0).cast("long"))
    repeated = written(rows.join(again, ["id", "th"], "left_semi").withColumn("no", F.monotonically_increasing_id() + 1), "mix-repeated")
    return alone.unionByName(repeated).select("doc", "source", name)


def mix(docs: DataFrame, weights: dict[str, float] | None = None, total: float | None = None, seed: int = SEED, keep: list[str] | None = None) -> DataFrame:
    """Replicated documents in global random order.

    Returns ``doc`` (the input row, or its columns ``keep``), ``rate``, ``copy`` (from 1) and ``order_key``; ``total``
    is the target number of rows (default: as many as there are).
    """
    r = written(rates(docs, weights, total), "mix-rates").alias("r")
    d = _named(docs, keep or docs.columns).alias("d")
    rows = d.join(r, F.col("d.source").eqNullSafe(F.col("r.source"))).select("d.doc", "d.name", "r.rate")
    parts = F.greatest(F.ceil(F.col("rate") / PART).cast("int"), F.lit(1))
    draw = lambda j: poisson(F.col("rate") / parts, uniform(F.lit(str(seed)), F.col("name"), j.cast("string")))
    count = F.when(F.col("rate") > 0, F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda a, j: a + draw(j))).otherwise(0)
    rows = rows.withColumn("count", count).where("count > 0") \
        .select("doc", "rate", "name", F.explode(F.sequence(F.lit(1), F.col("count"))).alias("copy"))
    key = F.md5(F.concat_ws(":", F.lit("order"), F.lit(str(seed)), F.col("name"), F.col("copy").cast("string")))
    rows = rows.select("doc", "rate", "copy", key.alias("order_key"))
    return rows.repartition("order_key").sortWithinPartitions("order_key")
