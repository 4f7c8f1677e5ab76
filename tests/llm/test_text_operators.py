"""Licence scan, personal data, quality rules and BPE against plain Python versions."""

import collections
import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealcast.llm import bpe, licenses, pii, quality
from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [
    (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, " \n\t\n ", None, None, 5), (4, "x" * 30000, "en", "s", 30000),
    (5, "All rights reserved. all RIGHTS  reserved", "en", "s", 41), (5, "All rights reserved. all RIGHTS  reserved", "en", "s", 41),
    (6, "mail a.b@c.d_e@f.gh, call +1 (499) 555-6503 or 1.2.3.4.5.6.7.8 and 300.1.1.1", "en", "t", 9),
    (7, "4111 1111 1111 1111, 4111-1111-1111-1112 " + "7" * 12000, "de", "t", 9),
    (None, "Été CC BY 4.0 \U0001f600 a@b.co", "fr", None, 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SMALL}/documents.parquet")
    return real.unionByName(spark.createDataFrame(EDGE, DOCS)).withColumn("counts", F.lit(1)).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def same(rows, want):
    assert collections.Counter(rows) == collections.Counter(want)


# ---------------------------------------------------------------- licences
def licence_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def licence_row(doc_id, text):
    w, found = licence_words(text), []
    for t in licenses.templates():
        for p in range(len(w)):
            if w[p:p + len(t["key"])] == t["key"]:
                at = p - t["key_at"]
                cover = sum(0 <= at + k < len(w) and w[at + k] == x for k, x in enumerate(t["words"])) / len(t["words"])
                found.append((t["label"], t["base"], p, round(cover, 6)))
    return doc_id, len(w), tuple(sorted(found))


def test_licences(docs, texts):
    got = licenses.scan(docs).collect()
    same([(r.doc_id, r.n_words, tuple(sorted((m.label, m.base, m.start, round(m.cover, 6)) for m in r.matches))) for r in got], [licence_row(*x) for x in texts])


def test_licences_any_index_word_finds_all(docs, texts):
    """Whichever word of a key phrase is the rarest, no place is missed."""
    counts = {w: 1000 - k for k, w in enumerate(sorted({w for t in licenses.templates() for w in t["key"]}))}
    got = licenses.scan(docs, counts).collect()
    same([(r.doc_id, r.n_words, tuple(sorted((m.label, m.base, m.start, round(m.cover, 6)) for m in r.matches))) for r in got], [licence_row(*x) for x in texts])


@pytest.mark.parametrize("text, label", [
    ("MIT License", "mit"), ("Apache License 2.0", "apache"), ("Mozilla Public License 2.0", "mpl"), ("Creative Commons Attribution 4.0", "cc-by-4.0"),
    ("# SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("Released under the MIT License, later the MIT License again", "mit")])
def test_licence_short_forms(spark, text, label):
    """A verified key phrase is reported whatever stands around it."""
    [row] = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert {m.label for m in row.matches} == {label} and len(row.matches) == text.count("MIT License") or label != "mit"
    assert all(0 < m.cover <= 1 for m in row.matches)


def test_licences_empty(empty):
    assert licenses.scan(empty).count() == 0


# ---------------------------------------------------------------- personal data
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    d = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in value.split("."))
    if kind == "card":
        total = sum(x - 9 if x > 9 else x for x in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))))
        return 13 <= len(d) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def test_personal_data(docs, texts):
    got = [(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.base)) for r in pii.find(docs).collect()]
    same(got, [(i, tuple(plain_spans(t))) for i, t in texts])


def test_personal_data_odd_runs(spark):
    """Every split of runs that the plain patterns make, the stricter patterns make too."""
    odd = ["a@b.c@d.e@f", "x@y.z.@q.r", "1.2.3.4.5", "1.2.3.4.5.6.7.8.9", "12 34-56 78 90 12 34 56", "+1 2", "+1(2)3.4 5-6789+12345678901", "a..b@c-.d-", "4" * 13,
           "0000.0.0.000255", "1-" * 30 + "1", "+" + "1" * 20, "٣@x.y 1٣.1.1.1"]
    rows = [(k, t) for k, t in enumerate(odd)]
    got = [(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.base)) for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    same(got, [(i, tuple(plain_spans(t))) for i, t in rows])


def test_revealing_terms(spark):
    """A word that only stands with one person's address is removed with it; common words stay."""
    rows = [(k, f"note {k}: the captain zorblatt wrote from zor@ship.example about plan{k}") for k in range(6)]
    rows += [(100 + k, f"the captain of ship number{k} wrote about something") for k in range(200)]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k in range(6):
        words = {rows[k][1][s.start:s.end] for s in got[k].spans if s.kind == "term"}
        assert "zorblatt" in words and not words & {"the", "captain", "wrote", "about"}
        assert "[EMAIL]" in got[k].sanitised and "zorblatt" not in got[k].sanitised and "captain" in got[k].sanitised
    assert all(not got[100 + k].spans for k in range(200))


def test_copies_of_a_line_do_not_reveal(spark):
    rows = [(k, "zorblatt wrote from zor@ship.example") for k in range(9)]
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all([s.kind for s in r.spans] == ["email"] for r in got)


def revealed(spark, rows):
    """Documents, and their texts in term spans."""
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    text = dict(rows)
    return {r.doc_id: {text[r.doc_id][s.start:s.end].lower() for s in r.spans if s.kind == "term"} for r in got}


def test_name_in_the_address_reveals(spark):
    """The name is spelled out on some of the lines with the address; matches are no lines of the name."""
    rows = [(k, f"jane sent line w{k} from jane.doe@x.example" if k < 10 else f"ask jane.doe@x.example on day w{k}") for k in range(60)]
    rows += [(100 + k, f"others sent line and ask from home on day w{k}") for k in range(3000)]
    got = revealed(spark, rows)
    assert all("jane" in got[k] and not got[k] & {"sent", "ask", "from", "day"} for k in range(10)) and not any(got[100 + k] for k in range(3000))


def test_repeated_lines_reveal(spark):
    """Lines that a document repeats count once, on both sides."""
    log = "\n".join(f"zorblatt {x} zor@ship.example" for x in ("left", "met", "saw"))
    rows = [(1, "\n".join([log] * 20))] + [(100 + k, f"someone left then met and saw number{k}") for k in range(500)]
    got = revealed(spark, rows)
    assert "zorblatt" in got[1] and not got[1] & {"left", "met", "saw"}


def test_terms_on_the_next_line_and_in_few_lines(spark):
    """Contexts go beyond the line; one observation is enough where the entity's content is large."""
    rows = [(k, f"some text here\nzorblatt office\nzor@ship.example\nsome text there w{k}") for k in range(2)]
    rows += [(100, "\n".join(f"some text here or there, another office w{k}" for k in range(60000)))]
    got = revealed(spark, rows)
    assert all("zorblatt" in got[k] and not got[k] & {"some", "text", "office"} for k in range(2))


def test_equal_rows_count_on_both_sides(spark):
    rows = [(k // 3, f"zorblatt went w{'abcdefgh'[k // 3]} zor@ship.example") for k in range(18)] + [(100 + k, f"all went home w{k}") for k in range(500)]
    got = revealed(spark, rows)
    assert all("zorblatt" in got[k] and "went" not in got[k] for k in range(6))


def plain_terms(rows, disclosure=pii.DISCLOSURE, smoothing=pii.SMOOTHING):
    """Term spans of (doc_id, text) rows by plain counting of events."""
    def words(t):
        return {w for w in re.findall(r"[^\W\d_]+", t.lower())}

    def names(line):
        found = [(k, m[0]) for k, p in PLAIN.items() for m in re.finditer(p, line) if valid(k, m[0])]
        return {f"{k}:{re.sub('[^0-9]', '', v) if k in ('card', 'phone') else v.lower()}" for k, v in found}

    n_t, n_e, total = collections.Counter(), collections.Counter(), 0
    n_te, seen, of_row = collections.Counter(), collections.defaultdict(set), []
    for _, text in rows:
        lines = (text or "").split("\n")
        bare = [re.sub("|".join(PLAIN.values()), " ", x) for x in lines]
        around = ["\n".join(bare[max(0, i - 1):i + 2]) for i in range(len(bare))]
        held = collections.defaultdict(set)
        for i, x in enumerate(lines):
            for e in names(x):
                for j in (i - 1, i, i + 1):
                    if 0 <= j < len(lines):
                        held[e].add(around[j])
                for t in words(around[i]):
                    seen[e, t].add(around[i])
        for c in set(around):
            total += 1
            n_t.update(words(c))
        for e, cs in held.items():
            n_e[e] += len(cs)
            for c in cs:
                n_te.update((e, t) for t in words(c))
        of_row.append(set(held))
    told = set()
    for (e, t), cs in seen.items():
        if n_e[e] < total and math.log2(n_te[e, t] * total / (n_t[t] * (1 + smoothing / len(cs)) * n_e[e])) / math.log2(total / n_e[e]) >= disclosure:
            told.add((e, t))
    out = {}
    for (i, text), es in zip(rows, of_row):
        masked = re.sub(PLAIN["email"], lambda m: "\n" * len(m[0]), text or "")
        out[i] = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", masked) if any((e, m[0].lower()) in told for e in es)]
    return out


def test_terms_equal_plain_counts(spark):
    """Term spans of random texts against plain counting."""
    rng = random.Random(5)
    people = [(f"p{k}.x@mail{k}.example", f"name{'abcdefghij'[k]}", f"Ort{'abcdefghij'[k]}") for k in range(10)]
    rows = []
    for i in range(400):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = [rng.choice(["the", "a", "note", "from", "we", "Große", "met", f"w{rng.randint(0, 99)}"]) for _ in range(rng.randint(0, 6))]
            if rng.random() < 0.1:
                mail, name, place = rng.choice(people)
                line += [mail] * rng.randint(1, 2) + [name] * (rng.random() < 0.7) + [place] * (rng.random() < 0.4)
            rng.shuffle(line)
            lines.append(" ".join(line))
        rows.append((i, "\n".join(lines)))
    got = {r.doc_id: sorted((s.start, s.end) for s in r.spans if s.kind == "term") for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = plain_terms(rows)
    assert got == want and sum(map(len, want.values())) > 20


def test_one_line_of_many_addresses(spark):
    """The work is linear in a line's length."""
    text = " ".join(f"user{k}@mail{k}.example" for k in range(20_000))
    rows = [(1, text), (2, f"zorblatt {text} end"), (3, "nothing here")] + [(10 + k, "some other line of text") for k in range(50)]
    began = time.perf_counter()
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert time.perf_counter() - began < 20
    assert [(s.kind, s.start, s.end) for s in got[1].base] == plain_spans(text) and len(got[2].base) == 20_000
    assert got[1].sanitised == " ".join(["[EMAIL]"] * 20_000) and got[3].sanitised is None


def test_overlapping_spans_are_replaced_as_one(spark):
    rows = [(1, "\U0001f600 call +1 (499) 555-6503.1.2.3 é1.2.3.4 a@1.2.3.4 end"), (2, "1.1.1.1"), (3, "x 4111111111111111@b.co y")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want, at = [], 0
        for lo, hi, kind in sorted((s.start, s.end, s.kind) for s in got[i].spans):
            if lo >= at:
                want += [text[at:lo], f"[{kind.upper()}]"]
            at = max(at, hi)
        assert got[i].sanitised == "".join(want) + text[at:]


def test_personal_data_empty(empty):
    assert pii.find(empty).count() == 0


# ---------------------------------------------------------------- quality rules
def counts_row(doc_id, text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    again = {k + j for k in range(len(w) - 4) if grams[tuple(w[k:k + 5])] > 1 for j in range(5)}
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed


def test_quality_counts(docs, texts):
    got = quality.screen(docs, keep_rows=False)
    cols = [F.col(f"counts.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    same([tuple(r) for r in got.select("doc.doc_id", *cols, "base_failed").collect()], [counts_row(*x) for x in texts])


def test_quality_repeats(spark):
    rows = [(k, t) for k, t in enumerate(["a b c d e " * 3, "a " * 40, "p q r s t u p q r s t", "a b c d e", "a b c d e f a b c d x y", " a b c d e\ta b c d e "])]
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = quality.screen(docs, keep_rows=False).select("doc.doc_id", "counts.n_repeat_words").collect()
    same([tuple(r) for r in got], [(i, counts_row(i, t)[5]) for i, t in rows])


def test_quality_outliers(spark):
    """Texts full of symbols go from a group of ordinary ones, even at a fifth of it; ordinary ones stay."""
    plain = [(k, " ".join(f"w{k * 7 % 89}{'abcdefgh'[(k + j) % 8] * (3 + (k * j) % 4)}{j}" for j in range(40)), "en", "a") for k in range(300)]
    junk = [(1000 + k, " ".join(f"w{k}x{j}&&&" for j in range(40)), "en", "a") for k in range(80)]
    few = [(2000, junk[0][1], "xx", None)]
    docs = spark.createDataFrame(plain + junk + few, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.screen(docs, keep_rows=False, min_rows=50).select("doc.doc_id", "kept").collect()}
    assert all(kept[r[0]] for r in plain) and not any(kept[r[0]] for r in junk)
    assert not kept[2000]  # judged by all documents


def plain_determinant(x, tries=60):
    """Least log determinant over many random starts, each concentrated until nothing changes, in plain numpy."""
    rng, n, d = np.random.default_rng(1), len(x), x.shape[1]
    noise = np.diag([quality.NOISE[c] ** 2 for c in quality.X])
    widen = quality.CORE / quality.chi2_even(quality.chi2_even_quantile(quality.CORE, d), d + 2)
    best = np.inf
    for _ in range(tries):
        core = rng.choice(n, 6, replace=False)
        for _ in range(100):
            centre, scatter = x[core].mean(axis=0), np.cov(x[core].T, bias=True) * widen + noise
            far = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(scatter), x - centre)
            after = np.flatnonzero(far <= np.sort(far)[int(np.ceil(quality.CORE * n)) - 1])
            if len(after) == len(core) and (after == core).all():
                break
            core = after
        best = min(best, np.linalg.slogdet(scatter)[1])
    return best


def test_quality_estimate_has_the_least_determinant(spark):
    """Of groups with a fifth of outliers on one side, with two clusters, and with copies, as found by a plain search of many starts."""
    rng = np.random.default_rng(3)
    base = lambda n: rng.multivariate_normal([1.6, 0.1, 0.2, 0.1], np.diag([0.09, 0.02, 0.05, 0.04]), n)
    groups = {"side": np.vstack([base(240), base(60) + [0, 2.0, 0, 0]]), "two": np.vstack([base(220), base(80) * 0.3 + [1.5, 0, 1, 0]]),
              "copies": np.vstack([base(200), np.repeat(base(1), 100, axis=0)]), "plain": base(300)}
    rows = spark.createDataFrame([([g], *map(float, v)) for g, x in groups.items() for v in x], "fits array<string>, " + ", ".join(f"{c} double" for c in quality.X))
    got = {r.grp: r for r in quality.fit(rows.repartition(5)).collect()}
    assert set(got) == set(groups)
    for g, x in groups.items():
        assert got[g].logdet <= plain_determinant(x) + 1e-2, g
    again = {r.grp: r.logdet for r in quality.fit(rows.repartition(2)).collect()}
    assert all(abs(again[g] - got[g].logdet) < 1e-9 for g in groups)


def test_quality_small_or_empty_tables_reject_nothing_by_distance(spark, empty):
    assert quality.screen(empty).count() == 0
    docs = spark.createDataFrame([(1, "&&& " * 3 + " ".join(f"w{j}" for j in range(20)), None, None, 1)], DOCS)
    row = quality.screen(docs).first()
    assert row.kept and row.doc.n_chars == 1


# ---------------------------------------------------------------- BPE
@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return path, t


def test_bpe(docs, texts, tokenizer):
    path, t = tokenizer
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    same([tuple(r) for r in bpe.encode_digests(docs, path).collect()], want)


def test_bpe_ids_and_texts(docs, tokenizer):
    path, t = tokenizer
    for r in bpe.encode(docs.limit(20), path).collect():
        assert t.decode(r.ids, skip_special_tokens=False) == r.decoded


def test_bpe_random_texts(tokenizer):
    """Any text of characters that every Unicode version of the libraries knows, and any spelling made of vocabulary pieces."""
    import random
    import unicodedata
    path, t = tokenizer
    enc = bpe.PrefixBPE(bpe.vocabulary(path))
    rng = random.Random(5)
    pieces = sorted(t.get_vocab())
    chars = [c for c in map(chr, range(1, 0x3000)) if unicodedata.ucd_3_2_0.category(c) != "Cn"]
    made = ["".join(rng.choice(pieces) for _ in range(4)) for _ in range(1500)]
    made += ["".join(rng.choice(chars) for _ in range(12)) for _ in range(1500)]
    made += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz'. éΣ") for _ in range(30)) for _ in range(3000)]
    made += ["<|endoftext|>A<|startoftext|>b", "a\x1cb\x1d c", "ΣΑΣ", "y" * 4000, "ab" * 999]
    for s in made:
        ids = t.encode(s, add_special_tokens=False).ids
        assert enc.encode(s) == ids, s
        assert enc.decode(ids) == t.decode(ids, skip_special_tokens=False)


def test_bpe_empty(empty, tokenizer):
    assert bpe.encode_digests(empty, tokenizer[0]).count() == 0
