"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass makes a document's set of distinct five-word shingles (as 64-bit hashes), its
   size, a signature of ``BANDS * ROWS`` minimum hashes and a 128-bit key of its whole word
   sequence. Equal keys are copies; only one representative of each goes on.
2. Representatives that agree in a band share a bucket. Each bucket's most central member
   (the one with most neighbours over all its buckets) is its leader. Leader-member pairs
   are compared by signature, one batch of hashes after the other: with ``m`` of ``k`` equal
   under a uniform prior, the posterior of the similarity is Beta(1+m, 1+k-m), and a pair is
   dropped when the threshold's posterior probability falls under ``MISS``. An odd sketch (the
   parities of the elements in each of ``PARITIES`` cells) then bounds the pair: differing
   parities never outnumber differing elements, so a pair with more of them than the
   threshold allows is dropped without error. Survivors are verified on their full shingle
   sets; confirmed links give components.
3. Members that are still in different components are compared with each other inside their
   buckets, in blocks of bounded size, by the same batches and the same exact check. A pair
   is compared only in the first band that it shares, and never with its own component,
   so a large group of near copies costs its leader's star and what the star doesn't reach.
4. Components are contracted from the links. No caps: every bucket is worked off whole.

A link of the threshold's own similarity is missed by all bands with probability
``(1 - t**ROWS) ** BANDS`` (under 1e-5 for 0.85) and by the batches with about ``MISS``.

Defined cases: null, empty and blank texts have no shingles and link to nothing; texts of
fewer than five words are one shingle; rows that share a doc_id are one document with that
id; null ids never name a component unless all its ids are null; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.llm.common import dropped, workers_ready, written
from dealcast.llm.components import components

WORDS = 5
BANDS, ROWS = 20, 5
#: Hashes compared in a batch, and the posterior probability of the threshold under which a pair is dropped.
BATCH, MISS = 20, 1e-7
#: Percent of the union that the intersection must reach.
THRESHOLD = 85
#: Members of a bucket in one block.
BLOCK = 256
HASHES = BANDS * ROWS
#: Cells of an odd sketch.
PARITIES = 2048
MEMO_WORDS = 300_000


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bounded number."""

    def __missing__(self, word):
        import xxhash
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x):
    """Finish 64-bit hashes so that all bits depend on all."""
    import numpy as np
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _odd_numbers(n: int, seed: int):
    import numpy as np
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: list[bytes], known: WordHashes):
    """Sorted distinct hashes of the five-word windows (of the whole, if it is shorter)."""
    import numpy as np
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    width = min(n, WORDS)
    factors = _FACTORS[width]
    x = h[:n - width + 1] * factors[0]
    for k in range(1, width):
        x = x + h[k:n - width + 1 + k] * factors[k]
    return np.unique(_mixed(x))


def signature(hashes):
    """Smallest value of each hash function over a set, its upper 32 bits."""
    import numpy as np
    least = None
    for at in range(0, len(hashes), 4096):
        part = np.multiply.outer(_FUNCTIONS, hashes[at:at + 4096]).min(axis=1)
        least = part if least is None else np.minimum(least, part)
    return (least >> np.uint64(32)).astype("<u4")


def odd_sketch(hashes):
    """Parity of the number of elements in each cell, packed."""
    import numpy as np
    cells = np.bincount((hashes & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((cells & 1).astype(np.uint8))


def _setup():
    """Constants of the workers, made once per process (numpy stays inside tasks)."""
    global _FACTORS, _FUNCTIONS
    if "_FACTORS" not in globals():
        _FACTORS = {w: _odd_numbers(w, 100 + w) for w in range(1, WORDS + 1)}
        _FUNCTIONS = _odd_numbers(HASHES, 7)


def _key(words: list[bytes]) -> bytes:
    import hashlib
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def text_hash(text="text"):
    """md5 of a text as it stands, made natively; with the id it names the rows of one document."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def prints(docs: DataFrame) -> DataFrame:
    """doc_id, th (text hash), key, n (size of the shingle set), sig and odd (its sketches) of every document."""
    def run(batches):
        import pyarrow as pa
        _setup()
        known = WordHashes()
        for b in batches:
            keys, sizes, sigs, odd = [], [], [], []
            for t in b.column("text").to_pylist():
                words = (t or b"").lower().split()
                s = shingles(words, known)
                keys.append(_key(words) if words else None)
                sizes.append(len(s))
                sigs.append(signature(s).tobytes() if words else None)
                odd.append(odd_sketch(s).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                                              pa.array(sigs, pa.binary()), pa.array(odd, pa.binary())], ["doc_id", "th", "key", "n", "sig", "odd"])

    return docs.select("doc_id", text_hash().alias("th"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, th binary, key binary, n long, sig binary, odd binary")


def sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, shingles (packed sorted hashes) of the wanted keys; wanted: doc_id, th, key, one row of each.

    Joined on id and text hash, so that rows of one id meet their own key alone.
    """
    def run(batches):
        import pyarrow as pa
        _setup()
        known = WordHashes()
        for b in batches:
            packed = [shingles((t or b"").lower().split(), known).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(packed, pa.binary())], ["key", "shingles"])

    d = docs.select("doc_id", text_hash().alias("th"), F.col("text").cast("binary").alias("text")).alias("d")
    w = wanted.alias("w")
    return d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th"))).select("d.text", "w.key") \
        .mapInArrow(run, "key binary, shingles binary")


def least_matches(threshold: int = THRESHOLD) -> list[int]:
    """For each number k of compared hashes: the fewest matches with which a pair goes on.

    P(Beta(1+m, 1+k-m) >= t) equals P(Binomial(k+1, t) <= m).
    """
    t, out = threshold / 100, []
    for k in range(HASHES + 1):
        total, m = 0.0, -1
        while total < MISS:
            m += 1
            total += math.comb(k + 1, m) * t ** m * (1 - t) ** (k + 1 - m)
        out.append(m)
    return out


def surviving(left, right, least: list[int]):
    """Which rows of two signature matrices go through all batches."""
    import numpy as np
    alive = np.arange(len(left))
    same = np.zeros(len(left), np.int32)
    for at in range(0, HASHES, BATCH):
        same = same + (left[alive, at:at + BATCH] == right[alive, at:at + BATCH]).sum(axis=1)
        on = same >= least[min(at + BATCH, HASHES)]
        alive, same = alive[on], same[on]
    return alive


def possible(left, right, n_left, n_right, threshold: int):
    """Which pairs of odd sketches differ in no more places than the threshold allows the sets to."""
    import numpy as np
    differ = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
    return differ * (100 + threshold) <= (n_left + n_right) * (100 - threshold)


def _matrix(column, kind="<u4", width=HASHES):
    import numpy as np
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _odd(column):
    return _matrix(column, "<u8", PARITIES // 64)


def verified(pairs: DataFrame, classes: DataFrame, full: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the threshold: batches first, then the full sets."""
    least = least_matches(threshold)

    def batches_of(batches):
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                on = surviving(_matrix(b.column("sig_a")), _matrix(b.column("sig_b")), least)
                n_a, n_b = b.column("n_a").to_numpy(), b.column("n_b").to_numpy()
                on = on[possible(_odd(b.column("odd_a"))[on], _odd(b.column("odd_b"))[on], n_a[on], n_b[on], threshold)]
                yield b.select(["a", "b"]).take(pa.array(on))

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

    def side(name):
        return classes.select(F.col("key").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("sig", "odd", "n")))

    near_size = (100 * F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    likely = pairs.join(side("a"), "a").join(side("b"), "b").where(near_size).mapInArrow(batches_of, "a binary, b binary")
    likely = written(likely, "near-likely")
    named = lambda n: full.select(F.col("key").alias(n), F.col("shingles").alias(f"set_{n}"))
    return likely.join(named("a"), "a").join(named("b"), "b").select("a", "b", "set_a", "set_b") \
        .mapInArrow(exactly, "a binary, b binary")


def blocked_pairs(members: DataFrame, threshold: int) -> DataFrame:
    """Likely pairs of different components inside buckets, compared block by block.

    members: band, h, key, sig, odd, n, root, size (members of the bucket). A member goes to every
    pair of blocks that its own block takes part in, so no group exceeds two blocks.
    """
    least = least_matches(threshold)

    def compare(table):
        import numpy as np
        import pyarrow as pa
        t = table.combine_chunks()
        band, i, j = t.column("band")[0].as_py(), t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sig, odd, n = _matrix(t.column("sig")), _odd(t.column("odd")), t.column("n").to_numpy()
        raw = t.column("key").to_pylist()
        root = np.unique(np.array([r.hex() for r in t.column("root").to_pylist()]), return_inverse=True)[1]
        block = t.column("block").to_numpy()
        left = np.flatnonzero(block == i)
        right = np.flatnonzero(block == j)
        apart = (root[left][:, None] != root[right][None, :]) \
            & (100 * np.minimum(n[left][:, None], n[right][None, :]) >= threshold * np.maximum(n[left][:, None], n[right][None, :]))
        if i == j:
            apart &= np.tri(len(left), k=-1, dtype=bool)
        bands = sig.reshape(-1, BANDS, ROWS)
        x, y = np.nonzero(apart)
        x, y = left[x], right[y]
        for k in range(band):  # met before
            first = ~(bands[x, k] == bands[y, k]).all(axis=1)
            x, y = x[first], y[first]
        on = surviving(sig[x], sig[y], least)
        x, y = x[on], y[on]
        on = possible(odd[x], odd[y], n[x], n[y], threshold)
        x, y = x[on], y[on]
        return pa.table({"a": pa.array([raw[k] for k in x], pa.binary()), "b": pa.array([raw[k] for k in y], pa.binary())})

    blocks = F.greatest(F.ceil(F.col("size") / BLOCK).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("key", F.lit(11)), blocks).cast("int")
    placed = members.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.select("band", "h", "key", "sig", "odd", "n", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return placed.groupBy("band", "h", "i", "j").applyInArrow(compare, "a binary, b binary")


def judged(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, th, key, n, first of every row; first (none, doc_id, th) is the row that stands for
    its component: the smallest id, then the smallest text hash. It is null for a sole row."""
    workers_ready(docs.sparkSession)
    seen = written(prints(docs), "near-prints")
    classes = written(seen.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"), F.max("n").alias("n"), F.max("sig").alias("sig"), F.max("odd").alias("odd"), F.count(F.lit(1)).alias("copies")), "near-classes")

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.struct(
        k.alias("band"), F.xxhash64(F.substring("sig", k * (4 * ROWS) + 1, F.lit(4 * ROWS))).alias("h")))
    banded = classes.select("key", F.explode(band).alias("x")).select("key", "x.band", "x.h")
    buckets = written(banded.groupBy("band", "h").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "near-buckets")
    members = written(banded.join(buckets, ["band", "h"]), "near-members")
    central = written(members.groupBy("key").agg(F.sum("size").alias("met")), "near-central")
    ranked = members.join(central, "key")
    leaders = written(ranked.groupBy("band", "h").agg(F.max(F.struct("met", "key")).getField("key").alias("leader")), "near-leaders")
    led = members.join(leaders, ["band", "h"]).where(F.col("key") != F.col("leader"))

    wanted = central.join(classes, "key").select("first.doc_id", "first.th", "key")
    full = written(sets(docs, wanted).dropDuplicates(["key"]), "near-sets")

    stars = led.select(F.col("leader").alias("a"), F.col("key").alias("b")).distinct()
    links = written(verified(stars, classes, full, threshold), "near-links")
    found = written(components(links), "near-found")

    # Members other than the leader that the stars left in different components.
    rooted = led.join(found, led["key"] == found["node"], "left") \
        .select("band", "h", "key", "size", F.coalesce("root", "key").alias("root"))
    rooted = written(rooted, "near-rooted")
    dropped(members)
    split = written(rooted.groupBy("band", "h").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                    .where("lo != hi").select("band", "h"), "near-split")
    open_ = rooted.join(split, ["band", "h"]).join(classes.select("key", "sig", "odd", "n"), "key")
    rest = written(blocked_pairs(open_, threshold), "near-rest")
    dropped(rooted)
    more = written(verified(rest, classes, full, threshold), "near-links")
    roots = written(components(links.unionByName(more)), "near-roots")
    dropped(full)

    # First row of each component; sole documents need no entry.
    named = classes.join(roots, classes["key"] == roots["node"], "left") \
        .select("key", "first", "copies", F.coalesce("root", "key").alias("root"), F.col("root").isNotNull().alias("linked"))
    named = written(named.where("linked or copies > 1"), "near-named")
    least = written(named.groupBy("root").agg(F.min("first").alias("first")), "near-least")
    ids = written(named.select("key", "root").join(least, "root").select("key", "first"), "near-ids")
    return seen.select("doc_id", "th", "key", "n").join(ids, "key", "left")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text -> doc_id, n_shingles, component_id, kept; one row per document."""
    component = F.coalesce("first.doc_id", "doc_id")
    return judged(docs, threshold).select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                                          F.col("doc_id").eqNullSafe(component).alias("kept"))
