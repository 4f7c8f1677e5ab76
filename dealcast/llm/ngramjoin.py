"""N-gram Jaccard join with count-vector R-trees.

1. A document's set are the hashes of its distinct five-word shingles. Each hash falls into one
   of ``GROUPS`` groups, and the counts of the groups are the document's point: two sets share no
   more than the sum of the smaller counts. Documents with equal word sequences are one class.
2. The join is cut into buckets without losing a link: shingles have one global order (seldom
   groups of ``ORDER_GROUPS`` first, then the hash), and two sets of the threshold's similarity
   share one of the first ``n - ceil(t * n) + 1`` of either. All classes with such a shingle are
   its bucket. Frequent passages come last in that order, so they seldom make buckets; buckets with
   the same members are one.
3. A bucket's most central member (with most neighbours over all its buckets) is compared with
   all others by counts. What passes connects members for the time being, so a large group of near copies
   costs its star, not its pairs.
4. Members that aren't connected yet get an R-tree per bucket (per block of at most ``BLOCK`` of
   them on average, paired with every other block, where a bucket is larger), over the counts folded to
   ``GROUPS`` coordinates. Node pairs are left where the bound of their boxes, their sizes or one
   common component rule a new link out; pairs of points then meet the bound on their own, finer counts.
   Of those that pass, a spanning forest of each bucket is verified on the full sets, with the
   stars' pairs, and the confirmed links are contracted.
5. The trees are searched once more with the confirmed components, now for all pairs between different
   ones that were not tried yet (where every link of the forest held there are none), and these are
   verified too: no link between components is lost.

A single tree over all documents would have to be searched by every task, and its boxes of unlike
documents exclude next to nothing; hence the trees stand under the buckets. The verification is exact
but for collisions of 64-bit shingle hashes. No caps.

Defined cases: null, empty and blank texts have an empty set and link to nothing; fewer than five
words are one shingle; rows that share a doc_id are judged each by its text; null ids name no component
unless all its ids are null; repeated rows are copies; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.llm import near, rtree
from dealcast.llm.common import dropped, workers_ready, written
from dealcast.llm.components import components
from dealcast.llm.near import WordHashes, shingles, text_hash

#: Percent of the union that the intersection must reach.
THRESHOLD = 80
#: Fewest coordinates of a point (those of the trees), and groups that order the shingles.
GROUPS, ORDER_GROUPS = 64, 1 << 16
#: Members of a bucket in one block.
BLOCK = 1024


def point(hashes) -> bytes:
    """How many hashes fall into each group: a power of two of groups, once to twice the set's size, ``GROUPS`` at least."""
    import numpy as np
    groups = groups_of(len(hashes))
    counts = np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return counts.astype("<u1" if counts.max() < 256 else "<u4").tobytes()


def groups_of(n: int) -> int:
    return max(GROUPS, 1 << max(2 * n, 1).bit_length() - 1)


def unpacked(packed: bytes, n: int):
    import numpy as np
    return np.frombuffer(packed, "<u1" if len(packed) == groups_of(n) else "<u4")


def folded(counts, groups: int = GROUPS):
    """The counts of fewer groups (a power of two)."""
    import numpy as np
    return counts.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def most_shared(x, y) -> int:
    """The most elements that sets with these counts have in common."""
    import numpy as np
    if len(x) != len(y):
        groups = min(len(x), len(y))
        x, y = folded(x, groups), folded(y, groups)
    return int(np.minimum(x, y).sum(dtype=np.int64))


def order_group(hashes):
    import numpy as np
    return ((hashes >> np.uint64(32)) & np.uint64(ORDER_GROUPS - 1)).astype(np.int64)


def leading(hashes, totals, threshold: int):
    """The first shingles in the global order, one of which any set similar enough shares."""
    import numpy as np
    n = len(hashes)
    order = np.lexsort((hashes, totals[order_group(hashes)]))
    return hashes[order[:n + (-threshold * n // 100) + 1]] if n else hashes


def points(docs: DataFrame) -> DataFrame:
    """doc_id, th (text hash), key, n of every document, and a row with ``totals`` (of the order groups) of each task."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        near._setup()
        known, totals, kind = WordHashes(), np.zeros(ORDER_GROUPS, np.int64), None
        for b in batches:
            keys, sizes, seen, kind = [], [], [], b.column("doc_id").type
            for t in b.column("text").to_pylist():
                words = (t or b"").lower().split()
                s = shingles(words, known)
                keys.append(near._key(words) if words else None)
                sizes.append(len(s))
                seen.append(s)
            if seen:
                totals += np.bincount(order_group(np.concatenate(seen)), minlength=ORDER_GROUPS)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                                              pa.nulls(len(keys), pa.binary())], names)
        if kind is not None:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, kind), *(pa.nulls(1, t) for t in (pa.binary(), pa.binary(), pa.int64())),
                                              pa.array([totals.tobytes()], pa.binary())], names)

    names = ["doc_id", "th", "key", "n", "totals"]
    return docs.select("doc_id", text_hash().alias("th"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, th binary, key binary, n long, totals binary")


def group_totals(seen: DataFrame):
    """How many shingles of all documents each order group holds."""
    import numpy as np

    def run(batches):
        import pyarrow as pa
        sums = np.zeros(ORDER_GROUPS, np.int64)
        for b in batches:
            for t in b.column("totals").to_pylist():
                sums += np.frombuffer(t, np.int64)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(sums[some], pa.int64())], ["g", "n"])

    totals = np.zeros(ORDER_GROUPS, np.int64)
    for r in seen.where("totals is not null").select("totals").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        totals[r["g"]] = r["n"]
    return totals


def leading_rows(docs: DataFrame, totals, threshold: int) -> DataFrame:
    """key, n, tokens (the leading shingles), counts (the point) of every distinct word sequence."""
    def run(batches):
        import pyarrow as pa
        near._setup()
        known = WordHashes()
        for b in batches:
            rows = []
            for t in b.column("text").to_pylist():
                words = (t or b"").lower().split()
                if words:
                    s = shingles(words, known)
                    rows.append((near._key(words), len(s), leading(s, totals, threshold).view("int64"), point(s)))
            keys, n, tokens, counts = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(tokens, pa.list_(pa.int64())),
                                              pa.array(counts, pa.binary())], ["key", "n", "tokens", "counts"])

    return docs.select(F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "key binary, n long, tokens array<long>, counts binary").dropDuplicates(["key"])


def full_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """c, shingles (packed sorted hashes) of the classes in ``pairs``, from the text of each one's first row."""
    def run(batches):
        import pyarrow as pa
        near._setup()
        known = WordHashes()
        for b in batches:
            rows = [shingles((t or b"").lower().split(), known).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("c"), pa.array(rows, pa.binary())], ["c", "shingles"])

    nodes = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    wanted = written(classes.join(nodes, "c").select("c", "first.doc_id", "first.th"), "ngram-wanted")
    d = docs.select("doc_id", text_hash().alias("th"), F.col("text").cast("binary").alias("text")).alias("d")
    rows = d.join(wanted.hint("merge").alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th")))
    return rows.select("w.c", "d.text").mapInArrow(run, "c long, shingles binary").dropDuplicates(["c"])


def likely_stars(stars: DataFrame, leads: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose sizes and counts allow the threshold."""
    def bounded(batches):
        import pyarrow as pa
        for b in batches:
            c = [b.column(x).to_pylist() for x in ("counts_a", "n_a", "counts_b", "n_b")]
            on = [k for k, (x, n, y, m) in enumerate(zip(*c)) if rtree.enough(most_shared(unpacked(x, n), unpacked(y, m)), n + m, threshold)]
            yield b.select(["a", "b"]).take(pa.array(on, pa.int64()))

    def side(name, *columns):
        return leads.select(F.col("c").alias(name), *(F.col(x).alias(f"{x}_{name}") for x in columns))

    sized = stars.join(side("a", "n"), "a").join(side("b", "n"), "b").where(100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    return sized.join(side("a", "counts"), "a").join(side("b", "counts"), "b").mapInArrow(bounded, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    def exactly(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            on = []
            for k, (x, y) in enumerate(zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist())):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= threshold * (len(x) + len(y) - both):
                    on.append(k)
            yield b.select(["a", "b"]).take(pa.array(on, pa.int64()))

    full = written(full_sets(docs, classes, pairs), "ngram-sets")
    named = lambda n: full.select(F.col("c").alias(n), F.col("shingles").alias(f"set_{n}"))
    links = written(pairs.join(named("a"), "a").join(named("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(exactly, "a long, b long"), "ngram-links")
    dropped(full)
    return links


def forest(x, y, roots) -> list[int]:
    """Which of the pairs join two trees of those before them; points of one root are one tree."""
    up: dict = {}

    def top(v):
        while up.get(v, v) != v:
            v = up[v]
        return v

    on = []
    for k, (a, b) in enumerate(zip(roots[x].tolist(), roots[y].tolist())):
        a, b = top(a), top(b)
        if a != b:
            up[a] = b
            on.append(k)
    return on


def tree_pairs(members: DataFrame, threshold: int, spanning: bool) -> DataFrame:
    """Pairs (a, b), a > b, of different roots in a bucket that the bounds of trees and points leave.

    members: t (bucket), size, c, n, root, counts. A member goes to every pair of blocks that its own block
    takes part in; rows arrive sorted, so a task holds one pair of blocks at a time. ``spanning``: as
    many pairs as connect what all pairs of these blocks would, never more than it has members.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def found(t):
            block, i, j = t.column("block").to_numpy(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
            c, sizes, roots = (t.column(x).to_numpy() for x in ("c", "n", "root"))
            fine = [unpacked(p, n) for p, n in zip(t.column("counts").to_pylist(), sizes.tolist())]
            counts = np.stack([folded(p) for p in fine])
            sides = [rtree.grown(at, counts, sizes, roots) for at in ([np.flatnonzero(block == s) for s in dict.fromkeys((i, j))]) if len(at)]
            if len(sides) < (1 if i == j else 2):
                return
            x, y = rtree.pairs(sides[0], sides[-1], counts, sizes, roots, threshold)
            total = (sizes[x] + sizes[y]).tolist()
            on = [k for k, (a, b) in enumerate(zip(x.tolist(), y.tolist())) if rtree.enough(most_shared(fine[a], fine[b]), total[k], threshold)]
            x, y = x[on], y[on]
            if spanning:
                on = forest(x, y, roots)
                x, y = x[on], y[on]
            a, b = c[x], c[y]
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b), pa.int64()), pa.array(np.minimum(a, b), pa.int64())], ["a", "b"])

        pending = None
        for b in batches:
            t = pa.Table.from_batches([b]) if pending is None else pa.concat_tables([pending, pa.Table.from_batches([b])])
            if not t.num_rows:
                continue
            t = t.combine_chunks()
            keys = np.stack([t.column(x).to_numpy() for x in ("t", "i", "j")])
            starts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
            for lo, hi in zip(starts, starts[1:]):
                yield from found(t.slice(lo, hi - lo).combine_chunks())
            pending = t.slice(starts[-1])
        if pending is not None:
            yield from found(pending.combine_chunks())

    blocks = F.greatest(F.ceil(F.col("size") / BLOCK).cast("int"), F.lit(1))
    placed = members.withColumn("block", F.pmod(F.xxhash64("c", F.lit(11)), blocks).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .select("t", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "c", "n", "root", "counts")
    return placed.repartition("t", "i", "j").sortWithinPartitions("t", "i", "j").mapInArrow(run, "a long, b long").distinct()


def joined(docs: DataFrame, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(doc_id, th, key, n) of every row, and (key, first) of every key in a component of several rows."""
    workers_ready(docs.sparkSession)
    seen = written(points(docs), "ngram-points")
    totals = group_totals(seen)
    seen = seen.where("totals is null")
    grouped = seen.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    classes = written(grouped.withColumn("c", F.monotonically_increasing_id()), "ngram-classes")

    leads = written(leading_rows(docs, totals, threshold).join(classes.select("key", "c"), "key").select("c", "n", "tokens", "counts"), "ngram-leading")
    tokens = leads.select("c", F.explode("tokens").alias("t"))
    buckets = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("x"),
                                      F.bit_xor(F.xxhash64("c", F.lit(2))).alias("y")).where("size > 1")
    buckets = written(buckets.groupBy("size", "x", "y").agg(F.min("t").alias("t")).select("t", "size"), "ngram-buckets")
    members = written(tokens.join(buckets.hint("merge"), "t"), "ngram-members")
    central = written(members.groupBy("c").agg(F.sum("size").alias("met")), "ngram-central")
    leaders = written(members.join(central, "c").groupBy("t").agg(F.max(F.struct("met", "c")).getField("c").alias("leader")), "ngram-leaders")
    led = members.join(leaders, "t").where("c != leader")

    stars = written(led.select(F.greatest("leader", "c").alias("a"), F.least("leader", "c").alias("b")).distinct(), "ngram-stars")
    likely = written(likely_stars(stars, leads, threshold), "ngram-likely")
    points_of = leads.select("c", "n", "counts")

    def still_open(linked):
        rooted = written(members.where("size > 2").join(linked, F.col("c") == F.col("node"), "left")
                         .select("t", "size", "c", F.coalesce("root", "c").alias("root")), "ngram-rooted")
        open_ = written(rooted.groupBy("t").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("t"), "ngram-open")
        return rooted.join(open_, "t").join(points_of, "c")

    spans = written(tree_pairs(still_open(written(components(likely), "ngram-found")), threshold, spanning=True), "ngram-spans")
    tried = written(likely.unionByName(spans).distinct(), "ngram-tried")
    links = confirmed(tried, docs, classes, threshold)
    roots = written(components(links), "ngram-found")
    rest = written(tree_pairs(still_open(roots), threshold, spanning=False).join(tried, ["a", "b"], "left_anti"), "ngram-rest")
    if not rest.isEmpty():
        roots = written(components(links.unionByName(confirmed(rest, docs, classes, threshold))), "ngram-roots")
    for table in (leads, members):
        dropped(table)

    named = classes.join(roots, classes["c"] == roots["node"], "left") \
        .select("key", "first", "copies", F.coalesce("root", "c").alias("root"), F.col("root").isNotNull().alias("linked"))
    named = written(named.where("linked or copies > 1"), "ngram-named")
    least = written(named.groupBy("root").agg(F.min("first").alias("first")), "ngram-least")
    ids = written(named.select("key", "root").join(least, "root").select("key", "first"), "ngram-ids")
    return seen.select("doc_id", "th", "key", "n"), ids


def ngram_join(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text -> doc_id, n_shingles, component_id; one row per document."""
    seen, ids = joined(docs, threshold)
    return seen.join(ids, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("first.doc_id", "doc_id").alias("component_id"))
