"""Registered queries: exact nearest neighbours, KNN vote, class balance, SMOTE (embeddings)."""

from __future__ import annotations

from pyspark.sql import functions as F

from dealcast.operators import balance as B
from dealcast.operators import neighbours as NB
from dealcast.registry.base import D, register
from dealcast.sources.tables import table


def emb(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").alias("vec"))


def _dist_sql(a: str, b: str) -> str:
    return (f"sqrt(list_reduce(list_transform(generate_series(1, len({a})), lambda i: "
            f"(CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE)) * (CAST({a}[i] AS DOUBLE) - CAST({b}[i] AS DOUBLE))), "
            f"lambda x, y: x + y))")


PAIRS_SQL = f"""
WITH pr AS (
  SELECT a.label, a.vec_id, b.vec_id AS nn_id, {_dist_sql('a.embedding', 'b.embedding')} AS dist
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id),
nn AS (SELECT label, vec_id, nn_id, CAST(row_number() OVER (PARTITION BY label, vec_id ORDER BY dist, nn_id) AS INT) AS rank, dist
       FROM pr)
"""


@register("j5_knn_pairs", PAIRS_SQL + "SELECT label, vec_id, nn_id, rank, round(dist, 6) AS dist FROM nn WHERE rank <= 5")
def q_knn(spark, sf):
    e = emb(spark, sf)
    nn = NB.knn_join(e, e, 5, "vec_id", "vec_id", "vec", by=["label"], exclude_self=True)
    return nn.withColumn("dist", F.round("dist", D))


@register("m13_knn_classifier", f"""
WITH pr AS (
  SELECT a.vec_id, b.label AS nl, {_dist_sql('a.embedding', 'b.embedding')} AS dist, b.vec_id AS nn_id
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, nn_id) AS rk FROM pr) WHERE rk <= 5),
votes AS (SELECT vec_id, nl, count(*) AS v FROM top GROUP BY ALL),
best AS (SELECT vec_id, nl AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY v DESC, nl) AS r FROM votes) WHERE r = 1)
SELECT e.vec_id, e.label, b.pred FROM embeddings e LEFT JOIN best b ON e.vec_id = b.vec_id""")
def q_knn_cls(spark, sf):
    e = emb(spark, sf)
    return NB.knn_classify(e, e, 5, "vec_id", "label", "vec", exclude_self=True)


@register("b2_class_balance", """
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM embeddings GROUP BY label""")
def q_balance(spark, sf):
    return B.class_balance(emb(spark, sf), "label").withColumn("share", F.round("share", D))


@register("b3_class_weights", """
SELECT label, count(*) AS n_c, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM embeddings GROUP BY label""")
def q_weights(spark, sf):
    return B.class_weights(emb(spark, sf), "label").withColumn("weight", F.round("weight", D))


def _draw(seed, tag):
    return (f"(('0x' || substr(md5(concat_ws('|', '{seed}', CAST(r.vec_id AS VARCHAR), CAST(r.s AS VARCHAR), '{tag}')), 1, 8))::BIGINT"
            f" / 4294967296.0)")


SMOTE_SQL = PAIRS_SQL.rstrip() + f""",
cnt AS (SELECT label, count(*) AS n_c FROM embeddings GROUP BY label),
need AS (SELECT label, n_c, max(n_c) OVER () - n_c AS need FROM cnt),
rk AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings),
alloc AS (SELECT rk.vec_id, rk.label,
            CAST(floor(need / n_c) + CASE WHEN r <= need % n_c THEN 1 ELSE 0 END AS INT) AS m_i
          FROM rk JOIN need ON rk.label = need.label),
reps AS (SELECT vec_id, label, CAST(unnest(range(1, m_i + 1)) AS INT) AS s FROM alloc WHERE m_i > 0),
k5 AS (SELECT * FROM nn WHERE rank <= 5),
nnn AS (SELECT vec_id, max(rank) AS n_nn FROM k5 GROUP BY vec_id),
pick AS (SELECT r.vec_id, r.label, r.s, CAST(floor({_draw(42, 'nn')} * q.n_nn) + 1 AS INT) AS rank,
           {_draw(42, 'gap')} AS gap
         FROM reps r JOIN nnn q ON r.vec_id = q.vec_id),
j AS (SELECT p.*, k5.nn_id FROM pick p JOIN k5 ON p.vec_id = k5.vec_id AND p.rank = k5.rank),
syn AS (SELECT j.label, j.vec_id, j.s, j.nn_id, j.gap,
          list_transform(generate_series(1, len(a.embedding)), lambda i:
            CAST(a.embedding[i] AS DOUBLE) + j.gap * (CAST(b.embedding[i] AS DOUBLE) - CAST(a.embedding[i] AS DOUBLE))) AS v
        FROM j JOIN embeddings a ON a.vec_id = j.vec_id JOIN embeddings b ON b.vec_id = j.nn_id)
"""


@register("b1_smote", SMOTE_SQL + """
SELECT label, vec_id, s, nn_id, round(gap, 9) AS gap, round(list_reduce(v, lambda x, y: x + y), 6) AS v_sum,
       round(list_reduce(list_transform(v, lambda x: x * x), lambda x, y: x + y), 6) AS v_sq FROM syn""")
def q_smote(spark, sf):
    s = B.smote(emb(spark, sf), "vec_id", "label", "vec", k=5, seed=42)
    v_sum = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    v_sq = F.aggregate(F.transform("vec", lambda x: x * x), F.lit(0.0), lambda a, x: a + x)
    return s.select("label", "vec_id", "s", "nn_id", F.round("gap", 9).alias("gap"),
                    F.round(v_sum, D).alias("v_sum"), F.round(v_sq, D).alias("v_sq"))


@register("b1_b2_balance_after_smote", SMOTE_SQL + """
SELECT label, count(*) AS n FROM (SELECT label FROM embeddings UNION ALL SELECT label FROM syn) GROUP BY label""")
def q_after(spark, sf):
    e = emb(spark, sf)
    syn = B.smote(e, "vec_id", "label", "vec", k=5, seed=42)
    return e.select("label").unionByName(syn.select("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
