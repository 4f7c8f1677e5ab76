"""AdaBoost.R2 on weighted bootstrap samples (M7).

A round draws as many rows as there are, with replacement and by weight, grows a tree on them
(``trees.grown`` on feature bins), and lowers the weight of the rows that the tree predicts well. The
draws invert the running sums of the weights: every row ends at its share of the total, every draw is a
hashed position in [0, 1), and a draw belongs to the first row that ends behind it. Rows and draws are put
in one order and counted by ``ordered.running_sums``, so neither the rows nor the draws meet in one task,
and a row that is drawn very often is counted before it is shuffled.

The forecast is the weighted median of the trees. Nulls of a feature count as less than any number; rows
without a label are left out; without rows, or with one label only, the model is one constant tree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealcast.functions.draws import uniform_draw
from dealcast.operators.ordered import quantiles, running_sums
from dealcast.operators.trees import LOWEST, Trees, grown, predicted, reached
from dealcast.session import cut_lineage

BINS = 64


def position(*parts) -> Column:
    """A hashed position in [0, 1) with 53 bits: two draws of 32 bits, the second one after the first."""
    return uniform_draw(*parts) + uniform_draw(*parts, F.lit("low")) / F.lit(4294967296.0)


def weighted_bootstrap(rows: DataFrame, order: str, weight: str, draws: int, seed: int, sample: int = 0) -> DataFrame:
    """``rows`` with ``hits``: how often each is drawn by ``draws`` draws with replacement, by ``weight`` (0 or more).

    ``order`` must tell the rows apart; it alone (not partitions or retries) decides which row a draw falls on.
    """
    run = running_sums(rows.withColumn("_all", F.lit(0)), ["_all"], order, [weight])
    ends = run.select("_all", F.struct((F.col(f"cum_{weight}") / F.col(f"tot_{weight}")).alias("at"), F.lit(0).alias("draw"), F.col(order).alias("order")).alias("at"),
                      F.lit(1).alias("row"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("own"))
    like = ends.schema["at"].dataType["order"].dataType.simpleString()
    marks = rows.sparkSession.range(1, draws + 1).select(
        F.lit(0).alias("_all"), F.struct(position(F.lit(seed), F.lit(sample), "id").alias("at"), F.col("id").cast("int").alias("draw"), F.lit(None).cast(like).alias("order")).alias("at"),
        F.lit(0).alias("row"), F.lit(None).cast(ends.schema["own"].dataType).alias("own"))
    # a draw belongs to the next row; rounding can put the last row's end just before 1
    counted = running_sums(ends.unionByName(marks), ["_all"], "at", ["row"])
    owner = F.least(F.col("cum_row") + 1 - F.col("row"), F.col("tot_row"))
    return counted.groupBy(owner.alias("_owner")).agg(F.sum(1 - F.col("row")).alias("hits"), F.any_value("own", F.lit(True)).alias("own")) \
        .select("own.*", "hits")


def array_cuts(rows: DataFrame, x: str, width: int, bins: int = BINS) -> list[list[float]]:
    """Cuts of each slot of an array column at its exact quantiles, each value once."""
    long = rows.select(F.posexplode(x).alias("f", "v")).where(F.col("v") > LOWEST)
    got = {r["f"]: r["cuts"] for r in quantiles(long, ["f"], "v", [i / bins for i in range(1, bins)]).collect()}
    return [sorted(set(got.get(i, []))) for i in range(width)]


def array_bins(x: Column, cuts: list[list[float]]) -> Column:
    """For each slot, how many of its cuts lie below the value."""
    def below(i: int, own: list[float]) -> Column:
        if not own:
            return F.lit(0.0)
        return F.size(F.filter(F.array(*[F.lit(c) for c in own]), lambda c: c < F.get(x, F.lit(i)))).cast("double")

    return F.array(*[below(i, own) for i, own in enumerate(cuts)])


@dataclass
class AdaBoostR2:
    """Trees on bins, the logarithms of their inverse betas, and the average loss of every round (also of a last one that does not count)."""

    cuts: list[list[float]]
    rounds: list[Trees] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame, x: Column, out: str = "prediction") -> DataFrame:
        """``df`` with the weighted median of the trees: the least value that half of the weight doesn't exceed."""
        tables, weights = [m.tables()[0] for m in self.rounds], self.weights

        @F.pandas_udf("double")
        def median(rows: pd.Series) -> pd.Series:
            import numpy as np
            if rows.empty:
                return pd.Series([], dtype=float)
            xs = np.stack(rows)
            values = np.column_stack([t[4][reached(t, xs)] for t in tables])
            order = np.argsort(values, axis=1, kind="stable")
            upto = np.cumsum(np.asarray(weights)[order], axis=1)
            at = np.argmax(upto >= 0.5 * upto[:, -1:], axis=1)
            return pd.Series(values[np.arange(len(xs)), order[np.arange(len(xs)), at]])

        return df.withColumn(out, median(array_bins(x, self.cuts)))


def adaboost_r2(rows: DataFrame, n_rounds: int = 50, max_depth: int = 3, rate: float = 1.0, bins: int = BINS, seed: int = 7,
                keys: list[str] | None = None) -> AdaBoostR2:
    """rows: x (array of features), y -> AdaBoost.R2 with linear loss.

    A round stops the boosting if its tree fits every row, or if its average loss reaches a half (such a
    tree counts only if it is the first). ``keys`` order the rows for the draws (else features and label do).
    """
    first = rows.where(F.col("y").isNotNull()).select("x").first()
    if first is None:
        return AdaBoostR2([], [Trees(1, {}, {(0, 1): (0.0, 0)})], [1.0], [0.0])
    x = F.transform("x", lambda v: F.coalesce(v.cast("double"), F.lit(LOWEST)))
    named = [F.col(k) for k in keys] if keys else [F.col("x"), F.col("y")]
    base = cut_lineage(rows.where(F.col("y").isNotNull()).select(F.col("y").cast("double").alias("y"), x.alias("x"), F.struct(*named).alias("o")))
    model = AdaBoostR2(array_cuts(base, "x", len(first[0]), bins))
    # equal rows get numbers of their own from the checkpointed table
    here = cut_lineage(base.select("y", array_bins(F.col("x"), model.cuts).alias("x"), F.struct("o", F.monotonically_increasing_id().alias("i")).alias("o"), F.lit(1.0).alias("w")))
    n = here.count()
    for r in range(n_rounds):
        drawn = weighted_bootstrap(here, "o", "w", n, seed, r).where("hits > 0")
        tree = grown(drawn.select(F.lit(0).alias("tree"), F.col("hits").alias("h"), (F.col("hits") * F.col("y")).alias("g"), "x"), 1, max_depth, binned=True)
        seen = cut_lineage(predicted(here, tree, F.col("x"), "_v").withColumn("err", F.abs(F.col("_v") - F.col("y"))).drop("_v"))
        s = seen.agg(F.max("err").alias("worst"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("err")).alias("loss")).first()
        loss = s["loss"] / (s["w"] * s["worst"]) if s["worst"] else 0.0
        model.losses.append(loss)
        if loss >= 0.5 and model.rounds:
            break
        beta = loss / (1 - loss) if loss < 1 else 1.0
        done = loss <= 0 or loss >= 0.5
        model.rounds.append(tree)
        model.weights.append(1.0 if done else rate * math.log(1 / beta))
        if done:
            break
        here = seen.withColumn("w", F.col("w") / F.lit(s["w"]) * F.pow(F.lit(beta), F.lit(rate) * (1 - F.col("err") / F.lit(s["worst"])))).drop("err")
    return model
