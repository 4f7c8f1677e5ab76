"""Ranked search, n-gram join and fill-in-the-middle against plain Python versions."""

import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealcast.llm import fim, lexical, ngramjoin, rtree
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, n_chars long"
BENCH = "item_id long, text string"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---------------------------------------------------------------- fill-in-the-middle
PIECES = {"line": r"[^\n]*\n|[^\n]+", "word": r"[^\t-\r ]*[\t-\r ]|[^\t-\r ]+", "sentence": r"[^.!?\n]*[.!?\n]|[^.!?\n]+", "char": r"(?s:.)"}
FIM_EDGE = [(1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one line"), (6, "a\nb"), (7, "ends\n"), (8, "has <S> inside\nand more"), (9, "almost <S\n>P> <"),
            (None, "no id\nat all\n"), (None, "no id\nat all\n"), (10, "\U0001f600é\r\n x\n" * 5), (11, "a. b! c?\nd  e\t\n"), (12, "<\nS>\n<P\n>"),
            (13, "".join(random.Random(1).choice("ab .\n") for _ in range(40000))), (-5, "minus\n" * 70)]


def plain_fim(doc_id, text, unit, rate=100, spm=50):
    text = text or ""
    u = re.findall(PIECES[unit], text)
    d = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    out = ("spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else ("psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(u), *out


@pytest.mark.parametrize("unit", sorted(fim.UNITS))
def test_fim_equals_plain_cuts_and_restores(spark, unit):
    docs = spark.createDataFrame(FIM_EDGE, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("a.b", F.lit(1))
    real = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", F.lit("x").alias("n"), F.lit(2).alias("a.b"))
    docs = docs.unionByName(real)
    got = fim.fill_in_middle(docs, unit)
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(plain_fim(r.doc_id, r.text, unit) for r in docs.collect())
    back = got.select(fim.restored(F.col("output"), F.col("form")).alias("t")).collect()
    assert collections.Counter(r.t for r in back) == collections.Counter(r.text or "" for r in docs.collect())


def test_fim_rate_empty_table_and_unknown_unit(spark, empty):
    docs = spark.createDataFrame([(k, "x\ny\n") for k in range(400)], "doc_id long, text string")
    got = [tuple(r) for r in fim.fill_in_middle(docs, rate=30, suffix_first=80).collect()]
    assert collections.Counter(got) == collections.Counter(plain_fim(k, "x\ny\n", "line", 30, 80) for k in range(400))
    assert fim.fill_in_middle(empty).count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, "paragraph")


def test_wavelet_matrix_rank_and_select():
    rnd = random.Random(3)
    for size in (0, 1, 63, 64, 65, 500):
        symbols = np.array([rnd.choice([0, 1, 1, 2, 3]) for _ in range(size)], np.uint8)
        w = fim.WaveletMatrix(symbols)
        for c in range(4):
            places = np.flatnonzero(symbols == c)
            assert [w.rank(c, i) for i in range(size + 1)] == [int((symbols[:i] == c).sum()) for i in range(size + 1)]
            assert [w.select(c, k + 1) for k in range(len(places))] == places.tolist()


# ---------------------------------------------------------------- ranked search
def search_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top=20):
    counted = [(d, collections.Counter(search_terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    nd, nl = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        q = collections.Counter(search_terms(text))
        scores = []
        for d, c, n in counted:
            m = 75 + (25 * n * nd) // nl
            s = sum(k * math.floor(1000 * math.log((2 * nd + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m)) for t, k in q.items() if t in c)
            if s > 0:
                scores.append((-s, d is None, d))
        out += [(item, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scores, key=lambda r: (r[0], r[1], r[2] or 0))[:top])]
    return collections.Counter(out)


def search_rows():
    rnd = random.Random(5)
    words = ["The", "of", "alpha", "BETA", "gamma", "Été", "x1", "日本", "delta", "epsilon", "zeta", "eta"]
    texts = [" ".join(rnd.choices(words, weights=range(12, 0, -1), k=rnd.randint(1, 30))) for _ in range(300)]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(7, "alpha alpha"), (7, "alpha alpha"), (None, "alpha alpha"), (900, None), (901, ""), (902, " .,;[]{}~ "), (903, "zeta-eta " * 20000), (904, "ZETA[eta]")]
    rows += [(1000 + k, "the of the") for k in range(60)]
    items = [(0, "alpha zeta eta"), (0, "alpha zeta eta"), (0, "delta"), (1, None), (2, ""), (3, "nowhere found"), (4, "the of"), (5, "ALPHA alpha beta Été 日本 x1 x1 the"), (None, "epsilon the")]
    return rows, items


@pytest.mark.parametrize("docs_per_block", [lexical.DOCS, 16])
def test_search_equals_brute_force(spark, monkeypatch, docs_per_block):
    rows, items = search_rows()
    monkeypatch.setattr(lexical, "DOCS", docs_per_block)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).repartition(3)
    got = lexical.search(docs, spark.createDataFrame(items, BENCH))
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_search(rows, items)


def test_search_in_item_groups_and_empty_tables(spark, monkeypatch, empty):
    rows, items = search_rows()
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, BENCH)
    monkeypatch.setattr(lexical, "ITEMS", 2)
    assert collections.Counter(tuple(r) for r in lexical.search(docs, bench, 3).collect()) == plain_search(rows, items, 3)
    assert lexical.search(empty, bench).count() == 0
    assert lexical.search(docs, spark.createDataFrame([], BENCH)).count() == 0


def test_search_pair_bounds_are_bounds_and_skip():
    """A pair's joint bound is never below a document's score from it; a block under the bar isn't scored."""
    rnd = np.random.default_rng(2)
    lists = {t: (np.sort(rnd.choice(200, 40, replace=False)), rnd.integers(1, 900, 40)) for t in range(6)}
    item = (((0, 9), (1, 8)), ((2, 7), (3, 5)), ((4, 2), (5, 1)))
    score = np.zeros(200, np.int64)
    bounds = []
    for pair in item:
        part = np.zeros(200, np.int64)
        for t, w in pair:
            part[lists[t][0]] += w * lists[t][1]
        bounds.append(int(part.max()))
        score += part
    bounds = np.array(bounds)
    assert bounds.sum() < sum(int(w * lists[t][1].max()) for pair in item for t, w in pair)
    for least in (0, 1, *np.percentile(score, [50, 90, 99, 100]).astype(int).tolist()):
        on, got = lexical.scored(item, bounds, lists, 200, least)
        want = {int(d): int(score[d]) for d in np.flatnonzero(score) if score[d] >= least}
        assert dict(zip(on.tolist(), got.tolist())).items() >= want.items()
        assert all(score[d] == s for d, s in zip(on, got) if s >= least)
    assert len(lexical.scored(item, bounds, {}, 200, int(bounds.sum()) + 1)[0]) == 0


# ---------------------------------------------------------------- n-gram join
def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def plain_join(docs, threshold=80):
    sets = [shingle_set(t) for _, t in docs]
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for x, y in itertools.combinations(range(len(docs)), 2):
        both = len(sets[x] & sets[y])
        if both and 100 * both >= threshold * len(sets[x] | sets[y]):
            root[top(x)] = top(y)
    least = {}
    for k, (d, _) in enumerate(docs):
        if sets[k] and d is not None:
            least[top(k)] = min(d, least.get(top(k), d))
    return collections.Counter((d, len(sets[k]), least.get(top(k), d) if sets[k] else d) for k, (d, _) in enumerate(docs))


def join_rows():
    rnd = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    common = rnd.choices(words, k=60)
    rows = []
    for base in range(12):
        b = rnd.choices(words, k=rnd.randint(40, 160))
        for _ in range(rnd.randint(1, 9)):
            c = list(b)
            for _ in range(rnd.randint(0, 3)):
                c[rnd.randrange(len(c))] = rnd.choice(words)
            rows.append(" ".join(c))
    rows += [" ".join(rnd.choices(words, k=30) + common) for _ in range(40)]  # a passage that unlike texts share
    rows += ["one two", "ONE  two", "one two three", "a b c d e", "a b c d e", "A B\tC\nd e", "x " * 3000, "x " * 3001, "É é", "é é"]
    rows = [(k * 3 % 1000, t) for k, t in enumerate(rows)]
    return rows + [(2000, None), (2001, ""), (2002, " \t\n "), (None, rows[0][1]), (None, rows[30][1] + " tail"), (None, None), rows[5], rows[5], (2003, " ".join(common))]


@pytest.mark.parametrize("block", [ngramjoin.BLOCK, 8])
def test_join_equals_all_pairs(spark, monkeypatch, block):
    rows = join_rows()
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("c", F.lit("clash"))
    assert collections.Counter(tuple(r) for r in ngramjoin.ngram_join(docs).collect()) == plain_join(rows)


def test_join_at_a_lower_threshold_and_empty_table(spark, empty):
    rows = join_rows()
    got = ngramjoin.ngram_join(spark.createDataFrame(rows, "doc_id long, text string"), 50)
    assert collections.Counter(tuple(r) for r in got.collect()) == plain_join(rows, 50)
    assert ngramjoin.ngram_join(empty).count() == 0


def test_tree_pairs_are_all_pairs_that_pass_the_bound():
    rnd = np.random.default_rng(8)
    base = rnd.integers(0, 6, (20, 16))
    counts = np.abs(base[rnd.integers(0, 20, 300)] + rnd.integers(-1, 2, (300, 16)))
    counts[:, 0] += 1
    sizes, roots = counts.sum(axis=1), rnd.integers(0, 90, 300)
    left, right = np.arange(0, 180), np.arange(180, 300)
    a, b = (rtree.grown(at, counts, sizes, roots) for at in (left, right))

    def want(pairs):
        return {frozenset((x, y)) for x, y in pairs if roots[x] != roots[y] and 180 * np.minimum(counts[x], counts[y]).sum() >= 80 * (sizes[x] + sizes[y])
                and 100 * min(sizes[x], sizes[y]) >= 80 * max(sizes[x], sizes[y])}

    for got, pairs in ((rtree.pairs(a, a, counts, sizes, roots, 80), itertools.combinations(left, 2)), (rtree.pairs(a, b, counts, sizes, roots, 80), itertools.product(left, right))):
        rows = [frozenset((int(x), int(y))) for x, y in zip(*got)]
        assert len(rows) == len(set(rows)) and set(rows) == want(pairs) and rows
