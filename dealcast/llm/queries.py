"""Registered queries of the document operators: thin contracts over ``dealcast.llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dealcast.sources.tables import table

OPS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def op(name: str, sql: str | None = None):
    def deco(fn):
        OPS[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@op("op2_bpe")
def op2(spark, sf):
    from dealcast.llm.bpe import encode_digests
    return encode_digests(table(spark, sf, "documents"), tokenizer_path())


@op("op8_quality_rules")
def op8(spark, sf):
    from pyspark.sql import functions as F

    from dealcast.llm.quality import screen
    got = screen(table(spark, sf, "documents"), keep_rows=False)
    return got.select("doc.doc_id", *(f"counts.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                      "base_failed", "kept", F.round("d2", 6).alias("distance2"))


@op("op6_minhash_near_dedup")
def op6(spark, sf):
    from dealcast.llm.near import near_duplicates
    return near_duplicates(table(spark, sf, "documents"))


OP3_SQL = """
WITH RECURSIVE sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
whole AS (SELECT sum(sqrt(n)) AS w, CAST(sum(n) AS DOUBLE) AS n FROM sizes),
rates AS (SELECT source, whole.n * sqrt(sizes.n) / whole.w / sizes.n AS rate FROM sizes, whole),
parts AS (SELECT source, rate, greatest(CAST(ceil(rate / 16) AS INT), 1) AS parts FROM rates),
terms AS (
  SELECT source, 0 AS k, exp(-rate / parts) AS p, exp(-rate / parts) AS upto FROM parts
  UNION ALL
  SELECT t.source, t.k + 1, t.p * (r.rate / r.parts) / (t.k + 1), t.upto + t.p * (r.rate / r.parts) / (t.k + 1)
  FROM terms t JOIN parts r ON t.source IS NOT DISTINCT FROM r.source WHERE t.k < 89),
draws AS (
  SELECT d.doc_id, d.name, d.source, p.rate, j, CAST('0x' || substr(md5('17:' || d.name || ':' || CAST(j AS VARCHAR)), 1, 12) AS BIGINT) / 281474976710656.0 AS u
  FROM (SELECT doc_id, source, coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, '')) || ':0' AS name FROM documents) d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.parts + 1)) AS x(j)),
counts AS (
  SELECT doc_id, name, source, any_value(rate) AS rate, CAST(sum((SELECT count(*) FROM terms t WHERE t.source IS NOT DISTINCT FROM draws.source AND t.upto < draws.u)) AS BIGINT) AS n
  FROM draws GROUP BY doc_id, name, source)
SELECT doc_id, source, round(rate, 6) AS rate, CAST(c AS INT) AS copy,
       md5('order:17:' || name || ':' || CAST(c AS VARCHAR)) AS order_key
FROM counts, unnest(range(1, n + 1)) AS x(c)
"""


@op("op3_mixing", OP3_SQL)
def op3(spark, sf):
    from pyspark.sql import functions as F

    from dealcast.llm.mixing import mix
    got = mix(table(spark, sf, "documents").select("doc_id", "source", "text"), keep=["doc_id", "source"])
    return got.select("doc.doc_id", "doc.source", F.round("rate", 6).alias("rate"), "copy", "order_key")


OP5_SQL = r"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
every AS (SELECT doc_id, text, unnest(ls) AS s, unnest(range(len(ls))) AS line FROM split),
seq AS (
  SELECT doc_id, text, s, line, row_number() OVER (PARTITION BY doc_id, text ORDER BY line) AS i,
    len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS w
  FROM every WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
cum AS (SELECT *, sum(w) OVER (PARTITION BY doc_id, text ORDER BY i) AS upto FROM seq),
ends AS (
  SELECT a.doc_id, a.text, a.i AS lo, min(b.i) AS hi FROM cum a JOIN cum b ON a.doc_id = b.doc_id AND a.text = b.text AND b.i >= a.i AND b.upto - a.upto + a.w >= 5
  GROUP BY ALL
  UNION
  SELECT b.doc_id, b.text, max(a.i) AS lo, b.i AS hi FROM cum a JOIN cum b ON a.doc_id = b.doc_id AND a.text = b.text AND b.i >= a.i AND b.upto - a.upto + a.w >= 5
  GROUP BY b.doc_id, b.text, b.i),
runs AS (
  SELECT e.doc_id, e.text, e.lo, e.hi, string_agg(c.s, chr(10) ORDER BY c.i) AS run
  FROM ends e JOIN cum c ON e.doc_id = c.doc_id AND e.text = c.text AND c.i BETWEEN e.lo AND e.hi GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, lo) AS rn FROM runs),
gone AS (SELECT DISTINCT r.doc_id, r.text, c.line FROM ranked r JOIN cum c ON r.rn > 1 AND r.doc_id = c.doc_id AND r.text = c.text AND c.i BETWEEN r.lo AND r.hi),
left_over AS (
  SELECT e.doc_id, string_agg(e.s, chr(10) ORDER BY e.line) FILTER (WHERE g.line IS NULL) AS text, count(g.line) AS n_deleted
  FROM every e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.text = g.text AND e.line = g.line GROUP BY e.doc_id),
counted AS (SELECT doc_id, count(*) AS n FROM seq GROUP BY doc_id)
SELECT l.doc_id, coalesce(c.n, 0) AS n_lines, l.n_deleted, sha256(coalesce(l.text, '')) AS text_sha256
FROM left_over l LEFT JOIN counted c USING (doc_id)
"""


@op("op5_line_dedup", OP5_SQL)
def op5(spark, sf):
    from pyspark.sql import functions as F

    from dealcast.llm.linedup import dedup_lines
    got = dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return got.select("doc.doc_id", "n_lines", "n_deleted", F.sha2(F.coalesce("doc.text", F.lit("")), 256).alias("text_sha256"))


OP7_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e)))
    AND list_bool_or(list_transform(embedding, lambda e: e <> 0))),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(list_zip(q.x, c.x), lambda z: z[1] * z[2])), lambda a, b: a + b) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20
"""


@op("op7_nearest_neighbours", OP7_SQL)
def op7(spark, sf):
    from pyspark.sql import functions as F

    from dealcast.llm.neighbours import nearest
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return nearest(e, e.where(F.col("vec_id") % 20 == 0))


def _op1_sql() -> str:
    from dealcast.llm.licenses import templates
    listed = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    rows = ",\n    ".join(f"({k}, '{t['label']}', {listed(t['words'])}, {listed(t['key'])}, {t['key_at']}, {str(t['base']).lower()})" for k, t in enumerate(templates()))
    return rf"""
WITH templates(t, label, words, key, key_at, base) AS (VALUES
    {rows}),
d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
places AS (SELECT r, unnest(range(len(w))) AS p FROM d WHERE len(w) > 0),
hits AS (SELECT d.r, t.label, t.base, p.p, t.words, t.key_at, d.w FROM places p JOIN d USING (r) JOIN templates t
  ON d.w[p.p + 1] = t.key[1] AND list_slice(d.w, p.p + 1, p.p + len(t.key)) = t.key),
scored AS (SELECT r, label, base, p,
    len(list_filter(range(len(words)), lambda k: p - key_at + k >= 0 AND coalesce(w[p - key_at + k + 1] = words[k + 1], false))) / len(words) AS cover FROM hits),
found AS (SELECT r, count(*) FILTER (WHERE base) AS n_base, min(p) FILTER (WHERE base) AS first_word, max(p) FILTER (WHERE base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE base)), ',') AS base_labels,
    array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(cover) AS score FROM scored GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(f.n_base, 0) AS n_base, f.first_word, f.last_word,
  coalesce(f.base_labels, '') AS base_labels, coalesce(f.labels, '') AS labels, round(coalesce(f.score, 0.0), 6) AS score
FROM d LEFT JOIN found f USING (r)
"""


@op("op1_license_scan", _op1_sql())
def op1(spark, sf):
    from pyspark.sql import functions as F

    from dealcast.llm.licenses import scan
    got = scan(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])
    names = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    score = F.coalesce(F.array_max(F.transform("matches", lambda m: m["cover"])), F.lit(0.0))
    return got.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
                      F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(F.col("matches")).alias("labels"),
                      F.round(score, 6).alias("score"))


@op("op9_pii")
def op9(spark, sf):
    from pyspark.sql import functions as F

    from dealcast.llm.pii import KINDS, find, joined
    got = find(table(spark, sf, "documents").select("doc_id", "text"))
    def of(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return got.select("doc_id", *map(of, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                      F.sha2("sanitised", 256).alias("sanitised_sha256"))


@op("op4_toxicity")
def op4(spark, sf):
    from dealcast.llm.toxicity import toxicity
    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@op("op10_quality_classifier")
def op10(spark, sf):
    from dealcast.llm.knnvote import quality
    return quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
sizes AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
whole AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nl FROM sizes),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) GROUP BY ALL),
q AS (SELECT item_id, t, count(*) AS q FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
weights AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tf WHERE t IN (SELECT t FROM q) GROUP BY t), whole),
scored AS (SELECT item_id, r, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nl)))) AS BIGINT) AS score
  FROM q JOIN weights USING (t) JOIN tf USING (t) JOIN sizes USING (r), whole GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@op("op11_ranked_search", OP11_SQL)
def op11(spark, sf):
    from dealcast.llm.lexical import search
    return search(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark").select("item_id", "text"))


def _join_sql(threshold: int, kept: bool = False) -> str:
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT r, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS s FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
links AS (
  SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS shared FROM sets x JOIN sets y ON x.s = y.s AND x.r < y.r GROUP BY ALL) p
  JOIN sizes m ON m.r = p.a JOIN sizes n ON n.r = p.b WHERE 100 * shared >= {threshold} * (m.n + n.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM sizes UNION SELECT reach.a, l.b FROM reach JOIN both_ways l ON reach.b = l.a),
least AS (SELECT a AS r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.b GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id{", d.doc_id IS NOT DISTINCT FROM coalesce(component_id, d.doc_id) AS kept" if kept else ""}
FROM d LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)
"""


SQL["op6_minhash_near_dedup"] = _join_sql(85, kept=True)


@op("op12_ngram_jaccard_join", _join_sql(80))
def op12(spark, sf):
    from dealcast.llm.ngramjoin import ngram_join
    return ngram_join(table(spark, sf, "documents").select("doc_id", "text"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
g AS (SELECT doc_id, t, u, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""


@op("op13_fill_in_middle", OP13_SQL)
def op13(spark, sf):
    from pyspark.sql import functions as F

    from dealcast.llm.fim import fill_in_middle, restored
    got = fill_in_middle(table(spark, sf, "documents").select("doc_id", "text"))
    return got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
