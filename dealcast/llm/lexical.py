"""Ranked lexical search: MaxScore with joint bounds of term pairs.

1. Documents are read once, in the partitions they come in. Each run of at most ``DOCS``
   documents or ``TOKENS`` words becomes an index block: the documents' ids and lengths, and the
   postings (document, occurrences) of the terms that the items ask for. Counts of documents,
   words and documents per term come from all blocks.
2. A second pass turns occurrences into impacts and precomputes each block's bounds: the
   greatest impact of each term, and for each term pair of an item, over the intersection of the
   pair's lists, the greatest joint impact. A pair's bound is the largest of the two single maxima
   and the joint one; a document gets no more than that from the pair, and where the two terms
   never reach their maxima together it's well under the sum of these.
3. An item's pairs (its terms by descending weight, two by two) are worked off in a block by
   descending bound. While the bounds still to come reach the 20th best score so far, their
   documents enter; after that lists only complete documents that entered, and those that can't
   reach that score any more are let go. A block whose bounds all together don't reach it is skipped.
   The 20th best score is carried from block to block in a task, and from the first round (one
   eighth of the blocks) to the second (all others).

Items go in groups of bounded size through the driver to all tasks; documents never leave their
partition, and nothing is shuffled but each task's best rows.

Defined cases: null, empty and termless texts are found by no item and count in neither number;
an item without terms found anywhere gives no rows; rows that share an item_id and text are one
item, and different texts under one item_id are items of their own; repeated documents are
each found; a null doc_id comes last among equal scores; fewer than k documents with a score give
fewer rows; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import collections
import functools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealcast.llm.common import dropped, workers_ready, written

TOP = 20
#: Documents, and words, of an index block at most (one document's words may be more).
DOCS, TOKENS = 2048, 1 << 20
#: Items, and their terms with repeats, that go to the tasks at once.
ITEMS, ITEM_TERMS = 1024, 200_000
#: One block of so many is in the first round.
FIRST = 8
#: Parts that an item's rows are ranked in before they meet.
SALTS = 32
#: Maps bytes of UTF-8: A-Z lower-cased, ASCII letters, digits and all above kept, the others blank.
BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(BYTES).split()


def length_part(n, n_docs: int, n_terms: int):
    """A document's m: 75 and its length as a share of 25 of the mean length."""
    return 75 + (25 * n * n_docs) // n_terms


def impact(tf, m):
    """What one occurrence of an item's term of weight 1 adds."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def index_blocks(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """ids, sizes (words) and postings (term, document, occurrences; by term, then document) of blocks of documents."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def block(ids, sizes, found):
            lists = np.empty((0, 3), np.int32)
            if found:
                place = np.repeat(np.arange(len(found)), [len(f) for f in found])
                pairs, tf = np.unique(np.concatenate(found).astype(np.int64) << 32 | place, return_counts=True)
                lists = np.stack([pairs >> 32, pairs & 0xFFFFFFFF, tf], axis=1).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([np.array(sizes, np.int64).tobytes()], pa.binary()),
                 pa.array([lists.tobytes()], pa.binary())], ["ids", "sizes", "lists"])

        ids, sizes, found, tokens = [], [], [], 0
        for b in batches:
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                words = terms(text)
                if not words:
                    continue
                known = np.fromiter((vocabulary.get(w, -1) for w in words), np.int32, len(words))
                ids.append(d)
                sizes.append(len(words))
                found.append(known[known >= 0])
                tokens += len(words)
                if len(ids) >= DOCS or tokens >= TOKENS:
                    yield block(ids, sizes, found)
                    ids, sizes, found, tokens = [], [], [], 0
        if ids:
            yield block(ids, sizes, found)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "ids array<long>, sizes binary, lists binary")


def corpus_counts(blocks: DataFrame, n_vocabulary: int) -> tuple[int, int, dict[int, int]]:
    """N, L and the documents of each term, over all blocks."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        df, n_docs, n_terms = np.zeros(n_vocabulary, np.int64), 0, 0
        for b in batches:
            for sizes, lists in zip(b.column("sizes").to_pylist(), b.column("lists").to_pylist()):
                sizes = np.frombuffer(sizes, np.int64)
                n_docs, n_terms = n_docs + len(sizes), n_terms + int(sizes.sum())
                df += np.bincount(np.frombuffer(lists, np.int32).reshape(-1, 3)[:, 0], minlength=n_vocabulary)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *some.tolist()], pa.int32()),
                                          pa.array([n_docs, n_terms, *df[some].tolist()], pa.int64())], ["term", "n"])

    got = {r["term"]: r["n"] for r in blocks.select("sizes", "lists").mapInArrow(run, "term int, n long")
           .groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return got.pop(-1, 0), got.pop(-2, 0), got


def paired(counts: dict[int, int], weights: dict[int, int]) -> list[tuple[tuple[int, int], ...]]:
    """An item's (term, its weight with repeats), by descending weight, two by two."""
    rows = sorted(((t, q * weights[t]) for t, q in counts.items() if weights.get(t)), key=lambda r: (-r[1], r[0]))
    return [tuple(rows[k:k + 2]) for k in range(0, len(rows), 2)]


def weighed_blocks(blocks: DataFrame, items: list, n_docs: int, n_terms: int) -> DataFrame:
    """Blocks with impacts in place of occurrences, and the bounds of all items' pairs (in the items' order)."""
    pairs = list(dict.fromkeys(p for item in items for p in item))
    number = {p: k for k, p in enumerate(pairs)}
    at = [[number[p] for p in item] for item in items]

    def run(batches):
        import numpy as np
        import pyarrow as pa
        order = np.array([k for ks in at for k in ks], np.int64)
        for b in batches:
            for ids, sizes, lists in zip(b.column("ids"), b.column("sizes").to_pylist(), b.column("lists").to_pylist()):
                m = length_part(np.frombuffer(sizes, np.int64), n_docs, n_terms)
                post = np.frombuffer(lists, np.int32).reshape(-1, 3)
                got = impact(post[:, 2].astype(np.int64), m[post[:, 1]]).astype(np.int32)
                list_of = _lists(post[:, 0], post[:, 1], got)
                bound = np.zeros(len(pairs), np.int64)
                for k, pair in enumerate(pairs):
                    found = [(w, *list_of[t]) for t, w in pair if t in list_of]
                    if found:
                        bound[k] = max(w * int(g.max()) for w, _, g in found)
                    if len(found) == 2:
                        (v, x, g), (w, y, h) = found
                        _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
                        if len(i):
                            bound[k] = max(bound[k], int((v * g[i].astype(np.int64) + w * h[j].astype(np.int64)).max()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.as_py()], pa.list_(pa.int64())), pa.array([np.column_stack([post[:, :2], got]).astype(np.int32).tobytes()], pa.binary()),
                     pa.array([bound[order].tobytes()], pa.binary())], ["ids", "lists", "bounds"])

    return blocks.mapInArrow(run, "ids array<long>, lists binary, bounds binary")


def _lists(term, doc, value) -> dict:
    """term -> (documents, values) of postings sorted by term."""
    import numpy as np
    starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else []
    ends = [*starts[1:], len(term)]
    return {int(term[a]): (doc[a:b], value[a:b]) for a, b in zip(starts, ends)}


def scored(item: tuple, bounds, list_of: dict, size: int, least: int):
    """Documents of a block that reach ``least`` for an item, and their scores."""
    import numpy as np
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(-bounds, kind="stable")
    order = order[bounds[order] > 0]
    rest = np.concatenate([np.cumsum(bounds[order][::-1])[::-1], [0]])
    if rest[0] < max(least, 1):
        return none
    score, k = np.zeros(size, np.int64), 0
    while k < len(order) and rest[k] >= least:  # a document first met here may still reach it
        for term, weight in item[order[k]]:
            if term in list_of:
                docs, got = list_of[term]
                score[docs] += weight * got.astype(np.int64)
        k += 1
    on = np.flatnonzero(score)
    on = on[score[on] + rest[k] >= least]
    while k < len(order) and len(on):
        for term, weight in item[order[k]]:
            if term in list_of:
                docs, got = list_of[term]
                at = np.minimum(np.searchsorted(docs, on), len(docs) - 1)
                hit = docs[at] == on
                score[on[hit]] += weight * got[at[hit]].astype(np.int64)
        k += 1
        on = on[score[on] + rest[k] >= least]
    return on, score[on]


def best_rows(blocks: DataFrame, items: list, least: dict[int, int], top: int) -> DataFrame:
    """item, doc_id, score: each task's ``top`` best rows of every item that reach ``least``."""
    starts = [0]
    for item in items:
        starts.append(starts[-1] + len(item))

    def run(batches):
        import numpy as np
        import pyarrow as pa
        best: dict[int, list] = {}
        bar = dict(least)

        def order(r):
            return -r[0], r[1] is None, r[1] or 0

        for b in batches:
            for ids, lists, bounds in zip(b.column("ids"), b.column("lists").to_pylist(), b.column("bounds").to_pylist()):
                ids = ids.as_py()
                post, bounds = np.frombuffer(lists, np.int32).reshape(-1, 3), np.frombuffer(bounds, np.int64)
                list_of = _lists(post[:, 0], post[:, 1], post[:, 2])
                for k, item in enumerate(items):
                    on, score = scored(item, bounds[starts[k]:starts[k + 1]], list_of, len(ids), bar.get(k, 0))
                    if len(on) > top:  # the last of them may have equals, which the ids tell apart
                        keep = score >= np.partition(score, -top)[-top]
                        on, score = on[keep], score[keep]
                    if len(on):
                        mine = sorted([*best.get(k, []), *((int(s), ids[d]) for d, s in zip(on, score))], key=order)[:top]
                        best[k] = mine
                        if len(mine) == top:
                            bar[k] = max(bar.get(k, 0), mine[-1][0])
        rows = [(k, d, s) for k, mine in best.items() for s, d in mine]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.int64())], ["item", "doc_id", "score"])

    return blocks.mapInArrow(run, "item int, doc_id long, score long")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The ``top`` best rows of each item with their rank; an item's rows are cut down in parts first."""
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    inner = Window.partitionBy("item", "part").orderBy(*best)
    whole = Window.partitionBy("item").orderBy(*best)
    return parts.withColumn("rank", F.row_number().over(inner)).where(F.col("rank") <= top).drop("part") \
        .withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)


def _item_groups(items: DataFrame):
    """Lists of (item_id, terms with repeats) of bounded size."""
    group, n = [], 0
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).distinct()
    for r in rows.toLocalIterator():
        counts = collections.Counter(terms(r["text"] and bytes(r["text"])))
        if group and (len(group) >= ITEMS or n + len(counts) > ITEM_TERMS):
            yield group
            group, n = [], 0
        group.append((r["item_id"], counts))
        n += len(counts)
    if group:
        yield group


def _search(docs: DataFrame, group: list, top: int) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = {t: k for k, t in enumerate(sorted({t for _, counts in group for t in counts}))}
    blocks = written(index_blocks(docs, vocabulary), "lexical-blocks")
    n_docs, n_terms, df = corpus_counts(blocks, len(vocabulary))
    weights = {t: term_weight(n_docs, n) for t, n in df.items()}
    items = [paired({vocabulary[t]: q for t, q in counts.items()}, weights) for _, counts in group]
    if not any(items):
        dropped(blocks)
        return None
    weighed = written(weighed_blocks(blocks, items, n_docs, n_terms).withColumn("turn", F.pmod(F.xxhash64("lists"), F.lit(FIRST))), "lexical-impacts")
    dropped(blocks)
    first = written(best_rows(weighed.where("turn = 0").drop("turn"), items, {}, top), "lexical-first")
    least = {r["item"]: r["score"] for r in ranked(first, top).where(F.col("rank") == top).select("item", "score").collect()}
    rest = written(best_rows(weighed.where("turn > 0").drop("turn"), items, least, top), "lexical-rest")
    dropped(weighed)
    names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(group)], "item int, item_id long")
    return ranked(first.unionByName(rest), top).join(names, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """doc_id, text and item_id, text -> item_id, rank, doc_id, score: each item's ``top`` best documents."""
    workers_ready(docs.sparkSession)
    found = [written(f, "lexical-found") for f in (_search(docs, g, top) for g in _item_groups(items)) if f is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return functools.reduce(DataFrame.unionByName, found)
