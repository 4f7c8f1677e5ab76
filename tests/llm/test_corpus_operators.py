"""Near duplicates, line runs, mixing, nearest neighbours, classifiers and the pipeline."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dealcast.llm import common, knnvote, linedup, mixing, near, neighbours, toxicity
from dealcast.llm.components import components
from dealcast.llm.queries import OPS, SQL, tokenizer_path
from tests.conftest import SMALL
from tests.llm.test_text_operators import counts_row
from tools.check import TABLES, digest

MID = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    got = OPS[name](spark, SMALL)
    cur = con.execute(SQL[name])
    cols, rows = [d[0] for d in cur.description], cur.fetchall()
    mine = [tuple(r) for r in got.collect()]
    assert sorted(got.columns) == sorted(cols) and len(mine) == len(rows)
    assert digest(got.columns, mine)[0] == digest(cols, rows)[0]


# ---------------------------------------------------------------- near duplicates
def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows, threshold=85):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)]


def check_near(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, key string")
    got = near.near_duplicates(docs).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == collections.Counter(brute_components(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def edited(words, edits, rng):
    w = list(words)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(w)


def test_near_groups(spark):
    """A group whose members link through each other, copies, short, empty and null texts."""
    rng = random.Random(1)
    base = [f"b{k}" for k in range(120)]
    rows = [(100 + k, edited(base, k % 5, rng)) for k in range(150)]
    rows += [(500 + k, " ".join(f"u{k}x{j}" for j in range(60))) for k in range(40)]
    rows += [(700 + k, rows[160][1].upper().replace(" ", "\n\t")) for k in range(30)]
    rows += [(800, None), (801, ""), (802, "  \n"), (803, "a b"), (804, "A  b"), (805, "a b c d e"), (806, "a b c d"), (807, "long " * 20000), (808, "LONG " * 20001)]
    check_near(spark, rows)


def test_near_chain(spark):
    """Each text links to the next one only; the component is the whole chain."""
    words = [f"w{k}" for k in range(400)]
    check_near(spark, [(900 - k, " ".join(words[4 * k:4 * k + 120])) for k in range(40)])


def test_near_repeated_ids_and_empty(spark):
    check_near(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (3, "q w e r t y")])
    assert near.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_near_sets_of_a_hot_id(spark):
    """Rows under one id or none meet their own key alone."""
    rows = [(None if k % 2 else 7, f"alpha beta gamma delta w{k // 4} epsilon zeta eta w{k // 4}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = near.prints(docs)
    wanted = seen.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first")).select("first.doc_id", "first.th", "key")
    got = near.sets(docs, wanted).collect()
    assert len(got) == 200 and len({bytes(r.key) for r in got}) == 100


def test_batches_keep_what_reaches_the_threshold():
    """Over all numbers of equal hashes that a pair at the threshold is likely to have."""
    least = near.least_matches(85)
    for k in range(near.BATCH, near.HASHES + 1, near.BATCH):
        missed = sum(math.comb(k, m) * 0.85 ** m * 0.15 ** (k - m) for m in range(least[k]))
        assert missed < 1e-5 and least[k] > 0.3 * k


def test_odd_sketch_never_drops_a_link():
    near._setup()
    rng = np.random.default_rng(4)
    for n in (5, 50, 500, 5000):
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0.0, 0.02, 0.04, 0.08):
            y = x.copy()
            m = int(n * share)
            y[:m] = rng.integers(0, 1 << 63, m, dtype=np.uint64)
            both = n - m
            a, b = (near.odd_sketch(v).view("<u8")[None] for v in (x, y))
            if 100 * both >= 85 * (2 * n - both):
                assert near.possible(a, b, np.array([n]), np.array([n]), 85)[0]


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(1000, 1000 + k) for k in range(1, 60)] + [(5000 + k, 5001 + k) for k in range(70)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in links if a != b for n in (a, b)}


# ---------------------------------------------------------------- line runs
def brute_lines(rows, min_words):
    """Delete runs of at least min_words words that stand earlier, by comparing every pair of places."""
    docs = [(i, t, [x for x in (t or "").split("\n") if x.encode().split()]) for i, t in rows]
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is not None, docs[k][0] or 0))
    places = [(k, p) for k in order for p in range(len(docs[k][2]))]
    out = {}
    for at, (k, p) in enumerate(places):
        for j, q in places[:at]:
            a, b = docs[k][2], docs[j][2]
            m = 0
            while p + m < len(a) and q + m < len(b) and a[p + m] == b[q + m]:
                m += 1
            if sum(len(x.encode().split()) for x in a[p:p + m]) >= min_words:
                out.setdefault(k, set()).update(range(p, p + m))
    result = []
    for k, (i, t, lines) in enumerate(docs):
        gone, n, left = out.get(k, set()), -1, []
        for x in (t or "").split("\n"):
            n += bool(x.encode().split())
            if not (x.encode().split() and n in gone):
                left.append(x)
        result.append((i, t if not gone else "\n".join(left), len(lines), len(gone)))
    return result


@pytest.mark.parametrize("min_words", [1, 5, 12])
def test_lines(spark, min_words):
    rng = random.Random(min_words)
    line = lambda: " ".join(f"w{rng.randrange(6)}" for _ in range(rng.randrange(0, 5)))
    rows = [(k, "\n".join(line() for _ in range(rng.randrange(0, 9)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "\n \n"), (None, "w1 w2 w3 w4 w5 w6\nw1"), (103, "a b c d e f\n" * 30), (104, "a b c d e f\n\nx y\n" + "q r s t u v w\n" * 2)]
    docs = spark.createDataFrame([(i, t, "en", None, 7) for i, t in rows], DOCS).withColumn("n_lines", F.lit("mine"))
    got = linedup.dedup_lines(docs, min_words).collect()
    assert collections.Counter((r.doc.doc_id, r.doc.text, r.n_lines, r.n_deleted) for r in got) == collections.Counter(brute_lines(rows, min_words))
    assert {r.doc.n_lines for r in got} == {"mine"}


def test_lines_repeated_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f\ng", "", "", 1)] * 2 + [(2, "a b c d e f\nh", "", "", 1)], DOCS)
    assert sorted((r.doc.doc_id, r.doc.text) for r in linedup.dedup_lines(docs).collect()) == [(1, "a b c d e f\ng")] * 2 + [(2, "h")]
    assert linedup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0


# ---------------------------------------------------------------- mixing
def test_mixing_rates(spark):
    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20000, "a").when(F.col("id") < 29990, "b").alias("source"), F.lit(1).alias("rate"))
    got = mixing.mix(docs, {"a": 1.0, "b": 3.0}, total=20000)
    n = {r.source: r.n for r in got.groupBy("doc.source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(n["a"] - 5000) < 5 * 5000 ** 0.5 and abs(n["b"] - 15000) < 5 * 15000 ** 0.5 and None not in n
    rows = got.groupBy("doc.doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("copy").alias("top"))
    assert rows.where("n != top").count() == 0
    heavy = mixing.mix(docs.where("source is null"), total=10 * 100).count()
    assert abs(heavy - 1000) < 5 * 1000 ** 0.5


def test_mixing_is_poisson_and_order_is_mixed(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    n = collections.Counter(r["count"] for r in mixing.mix(docs, total=30000).groupBy("doc.doc_id").count().collect())
    for k in range(1, 5):
        want = 20000 * math.exp(-1.5) * 1.5 ** k / math.factorial(k)
        assert abs(n[k] - want) < 5 * want ** 0.5
    keys = [r.order_key for r in mixing.mix(docs).coalesce(1).select("order_key").limit(1000).collect()]
    assert keys[:200] == sorted(keys[:200])


@pytest.mark.parametrize("seed", [17, 18])
def test_mixing_rows_without_or_under_one_id(spark, seed):
    """Rows under null or one id, with unlike texts or wholly equal, keep their rate and spread."""
    rows = [(None, f"t{k}", "s") for k in range(1500)] + [(7, f"u{k}", "s") for k in range(1500)] + [(8, "same", "s") for _ in range(1500)] + [(None, None, "s") for _ in range(1500)]
    rows += [(100 + k, f"v{k}", "s") for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("a.b", F.lit(1)).repartition(5)
    got = mixing.mix(docs, total=len(rows), seed=seed).cache()
    kind = F.when(F.col("doc.doc_id").isNotNull(), F.least(F.col("doc.doc_id"), F.lit(100))).when(F.col("doc.text").isNull(), -1).otherwise(-2)
    counts = {r[0]: r[1] for r in got.groupBy(kind).count().collect()}
    assert len(counts) == 5 and all(abs(n - 1500) < 5 * 1500 ** 0.5 for n in counts.values()), counts
    sizes = sorted(r[0] for r in got.groupBy(F.pmod(F.xxhash64("order_key"), F.lit(8))).count().select("count").collect())
    assert sizes[-1] < 2 * sizes[4] and got.select("order_key").distinct().count() == got.count()


def test_mixing_empty_and_no_weight(spark):
    docs = spark.createDataFrame([(1, None, None, None, 1), (1, None, None, None, 1)], DOCS)
    assert mixing.mix(docs.where("false")).count() == 0 and mixing.mix(docs, {"z": 1.0}).count() == 0
    assert mixing.mix(docs).count() % 2 == 0


# ---------------------------------------------------------------- nearest neighbours
def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    good = list({(i, v.tobytes()): (i, v) for i, v in good}.values())
    out = {}
    for i, v in good:
        if i % 20 == 0:
            scored = []
            for j, w in good:
                if j != i and len(v) == len(w):
                    s = 0.0
                    for a, b in zip(v, w):
                        s += a * b
                    scored.append((-s, j))
            out.setdefault(i, []).extend(scored)
    return {(q, r + 1, j, -s) for q, scored in out.items() for r, (s, j) in enumerate(sorted(scored)[:k])}


def test_nearest(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), [float(np.float32(x)) for x in rng.normal(size=8) * (1 + k % 7)]) for k in range(400)]
    rows += [(1000 + k, rows[20][1]) for k in range(40)] + [(2000, None), (2020, [0.0] * 8), (2040, [1.0] * 7 + [None]), (2060, [float("nan")] * 8),
                                                             (2080, [1.0, 2.0]), (2100, [2.0, 1.0]), (None, [1.0] * 8), (40, rows[40][1])]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    got = neighbours.nearest(e, e.where(F.col("vec_id") % 20 == 0), shard=64)
    assert {tuple(r) for r in got.collect()} == brute_nearest(rows, 20)
    assert neighbours.nearest(e.where("false"), e.where("false")).count() == 0


def test_nearest_with_many_vectors_under_one_id(spark):
    rng = np.random.default_rng(4)
    rows = [(0 if k < 150 else int(k), [float(x) for x in rng.normal(size=4)]) for k in range(300)]
    e = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(e, e.where(F.col("vec_id") % 20 == 0), shard=32)
    want = brute_nearest(rows, 20)
    assert {(r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in got.collect()} == {(q, r, j, round(s, 9)) for q, r, j, s in want}


def test_nearest_relaxed_pruning_keeps_recall():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 4
    v = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 16)) * 0.3
    ids, q = np.arange(4000), np.arange(0, 4000, 20)
    top = np.linalg.norm(v, axis=1).max()
    want = neighbours.Tree(v, ids, top)
    _, exact = want.search(v[q], ids[q], 20, 1.0)
    tree = neighbours.Tree(v, ids, top)
    _, got = tree.search(v[q], ids[q], 20, 0.9)
    recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(exact, got)])
    assert recall >= 0.9 and tree.visited < want.visited < 0.9 * len(q) * len(ids), (recall, tree.visited, want.visited, len(q) * len(ids))


# ---------------------------------------------------------------- classifiers
@pytest.mark.parametrize("name, label, least", [("op4_toxicity", "toxic", 0.92), ("op10_quality_classifier", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    got = OPS[name](spark, MID)
    rows = got.join(spark.read.parquet(f"{MID}/labels.parquet"), "doc_id").where("held_out").select("predicted", "score", label).collect()
    assert len(rows) > 50 and sum(r.predicted == r[label] for r in rows) / len(rows) >= least
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert got.count() == spark.read.parquet(f"{MID}/documents.parquet").count()


@pytest.mark.parametrize("apply, label", [(toxicity.toxicity, "toxic"), (knnvote.quality, "quality")])
def test_classifier_edges(spark, apply, label):
    docs = spark.createDataFrame([(1, None, "", "", 1), (2, "", "", "", 1), (3, "x " * 30000, "", "", 1), (3, "x " * 30000, "", "", 1), (None, "a", "", "", 1)], DOCS)
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    rows = apply(docs.withColumn("score", F.lit("mine")), none).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and len({r.score for r in rows if r.doc_id == 3}) == 1
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (None, 0), (3, None)], f"doc_id long, {label} int")
    assert all(r.predicted == 1 for r in apply(docs, one).collect())
    assert apply(docs.where("false"), none).count() == 0


def test_labelled_sample_is_bounded(spark):
    """Repeated labels and one id of many texts don't crowd out others; rows and bytes are bounded."""
    hot = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = spark.range(100, 1100).select(F.col("id").alias("doc_id"), F.lit("plain text").alias("text")).union(hot)
    labels = spark.createDataFrame([(7, 1)] * 2000 + [(k, k % 2) for k in range(100, 1100)] * 2, "doc_id long, toxic int")
    everything = common.labelled_sample(docs, labels, "toxic", F.lit(True), 10_000)
    assert len(everything) == 4000 and sum(t == "plain text" for t, _ in everything) == 1000
    some = common.labelled_sample(docs, labels, "toxic", F.lit(True), 500)
    assert len(some) == 500 and {y for _, y in some} == {0, 1}
    small = common.labelled_sample(docs, labels, "toxic", F.lit(True), 500, bound_bytes=300)
    assert 20 < len(small) < 50 and sum(len(t) for t, _ in small) <= 300
    assert common.labelled_sample(docs, labels, "toxic", F.lit(True), 500, bound_bytes=1) == []


@pytest.mark.parametrize("apply, label, held", [(toxicity.toxicity, "toxic", True), (knnvote.quality, "quality", False)])
def test_rows_without_an_id_have_a_fold(spark, apply, label, held):
    docs = spark.createDataFrame([(None, "a text"), (4, "another")], "doc_id long, text string")
    got = {r.doc_id: r.held_out for r in apply(docs, spark.createDataFrame([], f"doc_id long, {label} int")).collect()}
    assert got[None] is held and got[4] is not None


def plain_votes(sample, texts):
    """The votes of the nearest labelled vectors in plain double precision."""
    project, known, y, share = knnvote.fit(sample)
    out = []
    for t in texts:
        z = np.log1p(knnvote.counts(t.encode()).astype(float)) @ project.astype(float)
        z = z / max(np.sqrt(z @ z), 1e-12)
        near = sorted(((-float(z @ k), i) for i, k in enumerate(known.astype(float))))[:knnvote.K]
        w = [max(-s, 0.0) ** knnvote.POWER for s, _ in near]
        out.append((sum(a * y[i] for a, (_, i) in zip(w, near)) + knnvote.PRIOR * share) / (sum(w) + knnvote.PRIOR))
    return out


def test_votes_equal_plain_votes(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    sample = [(t, label[i]) for i, t in docs if i in label]
    got = knnvote.score(spark.createDataFrame(docs, "doc_id long, text string"), knnvote.fit(sample)).collect()
    want = collections.defaultdict(list)
    for (i, _), s in zip(docs, plain_votes(sample, [t for _, t in docs])):
        want[i].append(s)
    assert all(min(abs(r.score - s) for s in want[r.doc_id]) < 1e-3 for r in got) and len(got) == len(docs)


def test_equal_neighbours_are_taken_in_order():
    similar = np.array([[0.5, 0.9, 0.5, 0.5, 0.5], [0.1, 0.1, 0.1, 0.1, 0.1], [0.0, 0.2, 0.3, 0.1, 0.3]], np.float32)
    assert knnvote.nearest(similar, 3).tolist() == [[0, 1, 2], [0, 1, 2], [1, 2, 4]]


def test_toxicity_equals_plain_compression(spark):
    """Features and score of a given model, from lengths that zstandard reports for each window."""
    import zstandard
    rng = random.Random(2)
    vocabulary = [f"word{k}" for k in range(300)]
    texts = [(k, " ".join(rng.choice(vocabulary[150 * (k // 2 % 2):][:200]) for _ in range(rng.randint(0, 120)))) for k in range(60)]
    model = toxicity.fit([(t, k // 2 % 2) for k, t in texts])
    packers = [zstandard.ZstdCompressor(level=toxicity.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                                        write_content_size=False, write_dict_id=False) for d in model[:2]]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    for k, t in texts:
        d = [len(packers[0].compress(w)) - len(packers[1].compress(w)) for w in toxicity.windows(t)]
        over = [sum(x >= e for x in d) for e in toxicity.THRESHOLDS]
        f = [1.0, sum(d) / len(d), max(d) / 10, math.log1p(sum(x - 1 for x in d if x > 1)), *(o / len(d) * 10 for o in over), *(math.log1p(o) for o in over)]
        assert abs(got[k] - 1 / (1 + math.exp(-max(-30, min(30, float(np.dot(f, model[2]))))))) < 1e-9


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.toxicity(docs, x).collect()) for x in (labels, turned))
    assert a == b


# ---------------------------------------------------------------- pipeline
def test_pipeline_stages_against_plain_versions(spark):
    """Line, near and token stages equal brute force on what the stage before them kept;
    the quality stage drops what the base rule fails and keeps its input's rows otherwise;
    the mixing stage repeats whole documents."""
    from tokenizers import Tokenizer
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen, rows = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in rows.collect()]
        rows = stage(spark, rows, SMALL).cache()
        seen[name] = (before, [tuple(r) for r in rows.collect()])
        if name != "bpe":
            assert rows.columns == docs.columns
    before, after = seen["quality_rules"]
    passed = {r for r in before if not counts_row(r[0], r[1])[6]}
    assert set(after) <= passed and len(after) >= 0.8 * len(passed)
    before, after = seen["line_dedup"]
    want = [(i, t) for i, t, n, gone in brute_lines([r[:2] for r in before], linedup.MIN_WORDS) if gone == 0 or gone < n]
    assert sorted(r[:2] for r in after) == sorted(want) and all(r[4] == len(r[1]) for r in after)
    before, after = seen["near_dedup"]
    assert sorted(r[0] for r in after) == sorted(i for i, _, c in brute_components([r[:2] for r in before]) if i == c)
    before, after = seen["mixing"]
    assert set(after) <= set(before) and len(after) > 0.5 * len(before)
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    before, after = seen["bpe"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = [(r[0], t.encode(r[1], add_special_tokens=False).ids) for r in before]
    assert sorted(after) == sorted((i, len(x), sha(" ".join(map(str, x))), sha(t.decode(x, skip_special_tokens=False))) for i, x in ids)


def test_pipeline_near_stage_keeps_one_of_each_group(spark):
    from dealcast.llm.stages import near_stage
    rows = [(3, "a b c d e f g", "en", "s", 1), (1, "A b c d e f g", "en", "s", 1), (1, "A b c d e f g", "en", "s", 1), (2, "other words stand here now", "en", "s", 1), (None, None, None, None, None)]
    got = near_stage(spark, spark.createDataFrame(rows, DOCS), "").collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in got) == [(False, 1), (False, 2), (True, None)]


def test_pipeline_near_stage_judges_rows_not_ids(spark):
    """Null ids and ids with several texts lose near copies only, and every text keeps one row."""
    from dealcast.llm.stages import near_stage
    rng = random.Random(5)
    base = [[f"{name}{k}" for k in range(120)] for name in "pqrs"]
    p, q, r, s = (" ".join(b) for b in base)
    p2, q2, s2 = (edited(base[k], 1, rng) for k in (0, 1, 3))
    rows = [(1, p), (2, p2), (2, "a text of its own under two"), (3, "first text under id three here"), (3, "second text under id three here"),
            (None, q), (None, q2), (None, q), (None, r), (None, p), (4, s), (4, s2), (4, s),
            (5, " "), (5, " "), (None, None), (None, "")]
    got = collections.Counter((x.doc_id, x.text) for x in near_stage(spark, spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS), "").collect())
    sure = [(1, p), (2, "a text of its own under two"), (3, "first text under id three here"), (3, "second text under id three here"), (None, r), (5, " "), (None, None), (None, "")]
    assert all(got.pop(x) == 1 for x in sure)
    assert len(got) == 2 and set(got.values()) == {1} and {i for i, _ in got} == {None, 4}
    assert {t for _, t in got} <= {q, q2, s, s2}


def test_pipeline_of_an_empty_table(spark):
    rows = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, "")
    assert rows.count() == 0


def test_stages_keep_columns_with_dots_and_clashing_names(spark):
    from dealcast.llm import stages
    rows = [(k, f"some words of text number {k} and a few more words so that none is short", "en", "s", 1, 2) for k in (1, 2, 3)]
    rows += [(4, rows[0][1], "en", "s", 1, 2), (None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `a.b` int, th int")
    for stage in (stages.quality_stage, stages.line_stage, stages.near_stage, stages.mixing_stage):
        got = stage(spark, docs, SMALL)
        assert got.columns == docs.columns and got.count() >= 0
    assert sorted(r.doc_id or 0 for r in stages.near_stage(spark, docs, SMALL).collect()) == [0, 1, 2, 3]
