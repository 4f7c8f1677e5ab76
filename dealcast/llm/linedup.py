"""Repeated line runs by prefix doubling over line-ID sequences.

A text is the sequence of its lines that hold a word. Suffixes of these sequences are
bucketed by distributed prefix doubling: a line's class is named by the class's first place
(document order, then line order), and the run of ``2**k`` lines at a place by the first
place of its pair of runs of ``2**(k-1)`` lines. Classes with one member are settled and
leave; each level is written to the shared folder. Two suffixes share a prefix of ``m``
lines, that is, lie in one longest-common-prefix interval of that depth, exactly if the runs
of ``2**k <= m`` lines at both ends of the prefix have the same names. Buckets are ordered by
first place rather than by line content, which changes no interval.

A run is repeated if an equal run stands earlier. Repeated runs of at least ``min_words``
words are deleted. It suffices to look at, for each line, the shortest run with that many
words which begins at it and the shortest which ends at it: any line of a maximal repeated
run lies in the first such run of it or in the one that ends at the line, so depths over
``min_words`` lines are never needed and the number of levels doesn't grow with the data.

Classes are counted by pre-aggregated tables that are joined back, so a line that a third
of all documents hold is a skewed join which adaptive execution splits. Line IDs are two
64-bit hashes with different seeds.

Defined cases: null and empty texts have no lines and stay as they are; lines without a word
are never deleted; equal lines are equal strings; rows with the same doc_id and text are one
document, of which no row counts as a later copy; null ids come first; extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealcast.llm.arrays import let
from dealcast.llm.common import dropped, written

#: Words that a repeated run needs to be deleted.
MIN_WORDS = 5
A_WORD = r"[^\x20\x09-\x0D]"


def _numbered(text: Column) -> Column:
    """Lines with a word, each with its number among all lines."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda s, i: F.struct(i.alias("line"), s.alias("s")))
    return F.filter(lines, lambda x: x["s"].rlike(A_WORD))


def _text_id() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")), F.lit(5)).alias("th")


def places(docs: DataFrame, min_words: int) -> DataFrame:
    """doc_id, th, i, words (at most ``min_words``) and the line ID of every line with a word."""
    rows = docs.select("doc_id", _text_id(), F.posexplode(_numbered(F.col("text"))).alias("i", "x"))
    words = F.least(F.regexp_count("x.s", F.lit(A_WORD + "+")), F.lit(min_words))
    return rows.select("doc_id", "th", "i", words.alias("words"),
                       F.xxhash64("x.s", F.lit(1)).alias("h1"), F.xxhash64("x.s", F.lit(2)).alias("h2"))


def _place() -> Column:
    return F.struct("doc_id", "th", "i")


def named_runs(docs: DataFrame, min_words: int) -> tuple[DataFrame, int]:
    """Places of repeated lines with c0, c1, ...: the names of the runs of 1, 2, 4, ... lines there."""
    base = written(places(docs, min_words), "lines-places")
    classes = written(base.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("c0")).where("n > 1").drop("n"), "lines-classes")
    rows = written(base.join(classes, ["h1", "h2"]).select("doc_id", "th", "i", "words", "c0").dropDuplicates(["doc_id", "th", "i"]), "lines-0")
    dropped(base)
    level = 0
    while 2 ** (level + 1) <= min_words:
        step = 2 ** level
        level += 1
        ahead = Window.partitionBy("doc_id", "th").orderBy("i").rangeBetween(step, step)
        pairs = written(rows.withColumn("nxt", F.first(f"c{level - 1}").over(ahead)), "lines-pairs")
        name = F.col(f"c{level - 1}").alias("left"), F.col("nxt").alias("right")
        runs = pairs.where(F.col("nxt").isNotNull() & F.col(f"c{level - 1}").isNotNull()).groupBy(*name) \
            .agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias(f"c{level}")).where("n > 1").drop("n")
        runs = written(runs, "lines-runs")
        after = written(pairs.join(runs, (pairs[f"c{level - 1}"] == runs["left"]) & (pairs["nxt"] == runs["right"]), "left")
                        .drop("nxt", "left", "right"), f"lines-{level}")
        dropped(rows)
        dropped(pairs)
        rows = after
    return rows, level


def _shortest(rows: DataFrame, level: int, min_words: int, forward: bool) -> DataFrame:
    """For each place, the shortest run of ``min_words`` words that begins (ends) there."""
    doc = Window.partitionBy("doc_id", "th").orderBy("i")
    found = []
    for m in range(1, min_words + 1):
        k = m.bit_length() - 1
        lo, hi = (0, m - 1) if forward else (1 - m, 0)
        here = doc.rangeBetween(lo, hi)
        at = lambda d: doc.rangeBetween(d, d)
        left, right = F.first(f"c{k}").over(at(lo)), F.first(f"c{k}").over(at(hi + 1 - 2 ** k))
        enough = (F.count(F.lit(1)).over(here) == m) & (F.sum("words").over(here) >= min_words)
        found.append(F.when(enough, F.struct(F.lit(m).alias("m"), left.alias("left"), right.alias("right"), (F.col("i") + lo).alias("start"))))
    runs = rows.select("doc_id", "th", F.coalesce(*found).alias("r")).where("r.left is not null and r.right is not null")
    return runs.select("doc_id", "th", F.col("r.start").alias("i"), "r.m", "r.left", "r.right")


def deleted_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th, gone: numbers (among the lines with a word) of the lines to delete."""
    rows, level = named_runs(docs, min_words)
    runs = written(_shortest(rows, level, min_words, True).unionByName(_shortest(rows, level, min_words, False)).distinct(), "lines-windows")
    dropped(rows)
    first = written(runs.groupBy("m", "left", "right").agg(F.count(F.lit(1)).alias("n"), F.min(_place()).alias("first"))
                    .where("n > 1").drop("n"), "lines-first")
    later = runs.join(first, ["m", "left", "right"]).where(_place() != F.col("first"))
    return later.select("doc_id", "th", F.explode(F.sequence(F.col("i"), F.col("i") + F.col("m") - 1)).alias("i")) \
        .groupBy("doc_id", "th").agg(F.collect_set("i").alias("gone"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents without later copies of line runs.

    Returns ``doc`` (the input row with its text shortened), ``n_lines`` and ``n_deleted``.
    """
    gone = written(deleted_lines(docs, min_words), "lines-gone").alias("g")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), "doc_id", _text_id(), "text").alias("d")
    rows = rows.join(gone, F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.th") == F.col("g.th")), "left")

    def shortened(lines: Column) -> Column:
        drop = let(_numbered(F.col("d.text")), lambda n: F.transform(F.col("g.gone"), lambda i: n[i]["line"]))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
        return F.array_join(F.transform(stay, lambda k: lines[k]), "\n")

    text = F.when(F.col("g.gone").isNull(), F.col("d.text")).otherwise(let(F.split("d.text", "\n"), shortened))
    doc = F.struct(*(text.alias("text") if c == "text" else F.col(f"d.doc.`{c}`").alias(c) for c in docs.columns))
    return rows.select(doc.alias("doc"), F.size(_numbered(F.col("d.text"))).cast("long").alias("n_lines"),
                       F.coalesce(F.size("g.gone"), F.lit(0)).cast("long").alias("n_deleted"))
