"""Exact k-nearest neighbours (J5) and the KNN vote (M13), searched in blocks or on a grid.

Copies of a vector are collapsed first. Two searches run over the distinct vectors:

* ``blocks`` (default, any dimension): both sides are dealt to blocks of bounded size
  inside their group; a task takes one block of each, finds the pairs that may be nearest by
  inner products, computes their distances exactly and returns each query's few nearest, which a
  grouped top-k merges. No pair
  is ever a row: what is shuffled is each side once per block of the other. The
  distances computed are still all of a group, because in high dimension no exact bound
  excludes any (measured: 100 % of the pairs of the 64-d test vectors).
* ``grid`` (low dimension): every vector is projected on the m leading principal
  directions u_1..u_m (orthonormal, so the projections spread the points as far as
  possible). For any two points |u_i.x - u_i.q| <= ||x - q||, hence all points within
  distance h of a query lie in the cube |u_i.x - u_i.q| <= h (all i). Points are bucketed
  on an m-dimensional grid; a query visits the cells its cube touches, keeps the
  candidates inside the cube and computes true distances. A query is finished as soon as
  at least k candidates lie within distance h -- its k nearest are then certainly among
  them. The work is the cube contents, not all pairs of a group. Several directions
  matter when one direction is a coarse (discrete) coordinate that ties many points.
"""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealcast.session import cut_lineage


#: Blocks of one side before they get larger.
WIDE = 16


def sq_dist(a, b, dim: int | None = None) -> Column:
    """Squared Euclidean distance of two equal-length arrays, summed left to right.

    With ``dim`` known the expression is flat element arithmetic (whole-stage
    codegen); without it a higher-order ``aggregate`` is used (interpreted, slow).
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    if dim:
        acc = None
        for i in range(dim):
            t = (a[i].cast("double") - b[i].cast("double"))
            acc = t * t if acc is None else acc + t * t
        return acc
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def first_direction(points: DataFrame, vec: str) -> list[float]:
    """Unit first principal direction of the vectors (distributed Gramian; d x d on the driver)."""
    return principal_directions(points, vec, 1)[0]


def principal_directions(points: DataFrame, vec: str, m: int) -> list[list[float]]:
    """The m leading unit principal directions (MLlib PCA: distributed Gramian, d x d eigen on the driver)."""
    v = points.select(array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    d = len(points.select(vec).first()[0])
    m = max(1, min(m, d))
    pc = PCA(k=m, inputCol="_v").fit(v).pc.toArray()
    out = []
    for j in range(m):
        col = pc[:, j]
        norm = float((col ** 2).sum()) ** 0.5 or 1.0
        out.append([float(x) / norm for x in col])
    return out


def _project(df: DataFrame, vec: str, u: list[float]) -> Column:
    v = F.col(vec)
    acc = None
    for i, x in enumerate(u):
        t = v[i].cast("double") * F.lit(x)
        acc = t if acc is None else acc + t
    return acc


def _copy_groups(points: DataFrame, by: list[str], p_id: str, vec: str, need: int) -> DataFrame:
    """One row per distinct (block, vector): multiplicity, representative id
    (smallest) and the ``need`` smallest ids of the copies.

    Copies are counted with a partially aggregated group-by. Only the rows of
    vectors that have copies are ranked, by the distributed prefix count, so a
    group of copies holding a large share of all rows is never sorted by one
    task; unique vectors (the usual case) skip the ranking.
    """
    from dealcast.operators.ordered import running_sums
    pts = points.select(*by, F.col(p_id).alias("_id"), F.col(vec).alias("_v"))
    cnt = cut_lineage(pts.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("mult"), F.min("_id").alias("rep")))
    single = cnt.where(F.col("mult") == 1).select(*by, F.col("_v").alias("p_vec"), F.col("rep").alias("nn_rep"),
                                                  F.array("rep").alias("ids"), F.col("mult").cast("long").alias("mult"))
    multi_keys = cnt.where(F.col("mult") > 1).select(*by, "_v")
    if multi_keys.limit(1).count() == 0:  # no copies at all (one cheap job on the checkpoint)
        return single
    rows = pts.join(multi_keys, [*by, "_v"], "left_semi").withColumn("_one", F.lit(1))
    r = running_sums(rows, [*by, "_v"], "_id", ["_one"], out_prefix="_rk", with_totals=True)
    multi = (r.where(F.col("_rk_one") <= need).groupBy(*by, "_v")
             .agg(F.array_sort(F.collect_list("_id")).alias("ids"), F.first("tot__one").alias("mult")))
    multi = multi.select(*by, F.col("_v").alias("p_vec"), F.col("ids")[0].alias("nn_rep"), "ids",
                         F.col("mult").cast("long").alias("mult"))
    return single.unionByName(multi)


def _nearest(q, p, need: int):
    """Rows of q, rows of p and distances of each q's ``need`` nearest p, ties to the earlier row of p.

    Inner products give every squared distance up to a bound on their rounding; the pairs
    that may be among the nearest by it get the distance summed left to right, which decides.
    """
    import numpy as np
    dim = p.shape[1]
    with np.errstate(all="ignore"):
        pp, qq = (p * p).sum(axis=1), (q * q).sum(axis=1)
        slack = 32 * (dim + 8) * np.finfo(np.float64).eps * (qq + pp.max()) + 1e-300
    if len(p) > need and np.isfinite(slack).all():
        near = q @ p.T
        near *= -2
        near += pp
        least = np.partition(near, need - 1, axis=1)[:, need - 1]
        row, hit = np.nonzero(near <= (least + 2 * slack)[:, None])
    else:  # few points, or components that aren't finite
        row, hit = np.repeat(np.arange(len(q)), len(p)), np.tile(np.arange(len(p)), len(q))
    d2 = np.zeros(len(row))
    for i in range(dim):
        step = q[row, i] - p[hit, i]
        d2 += step * step
    dist = np.sqrt(d2)
    order = np.lexsort((hit, dist, row))
    row, hit, dist = row[order], hit[order], dist[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    return row[rank < need], hit[rank < need], dist[rank < need]


def _block_search(groups: DataFrame, qv: DataFrame, by: list[str], need: int, block: int) -> DataFrame:
    """(*by, q_key, nn_rep, ids, dist): the ``need`` nearest distinct vectors of every query
    vector by (distance, smallest id). Every vector has an id, so no id among the ``need``
    nearest ones belongs to a vector that is left out."""
    def top(mine, theirs):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def matrix(t, name):
            v = t.column(name).combine_chunks()
            return np.asarray(v.flatten(), np.float64).reshape(len(v), -1)

        mine = mine.take(pc.sort_indices(mine.column("nn_rep")))  # equal distances then stay in the order of ids
        out = [mine.schema.field(n) for n in ("nn_rep", "ids")]
        fields = pa.schema([*(theirs.schema.field(f"_q_{b}").with_name(b) for b in by), theirs.schema.field("q_key"), *out, pa.field("dist", pa.float64())])
        if not mine.num_rows or not theirs.num_rows:
            return fields.empty_table()
        p, q = matrix(mine, "p_vec"), matrix(theirs, "q_vec")
        rows, hits, dists = [], [], []
        for at in range(0, len(q), 256):
            row, hit, dist = _nearest(q[at:at + 256], p, need)
            rows.append(row + at)
            hits.append(hit)
            dists.append(dist)
        left, right = theirs.take(pa.array(np.concatenate(rows))), mine.take(pa.array(np.concatenate(hits)))
        return pa.table([*(left.column(f"_q_{b}") for b in by), left.column("q_key"), right.column("nn_rep"), right.column("ids"),
                         pa.array(np.concatenate(dists))], schema=fields)

    from pyspark.sql.types import DoubleType, StructField, StructType
    p = groups.select(*by, "nn_rep", "ids", F.col("p_vec").cast("array<double>").alias("p_vec")).where(F.col("p_vec").isNotNull())
    q = qv.select(*by, "q_key", F.col("q_vec").cast("array<double>").alias("q_vec")).where(F.col("q_vec").isNotNull())
    # every block of one side meets every block of the other: beyond WIDE blocks they get up to 4 times as large, not more
    blocks = lambda n: F.greatest(F.ceil(n / (4 * block)), F.least(F.ceil(n / block), F.lit(WIDE))).cast("int")
    count = lambda df, name: df.groupBy(*by).agg(blocks(F.count(F.lit(1))).alias(name))
    if by:  # one row per group; null groups have no neighbours
        sizes = cut_lineage(count(p, "_np").join(count(q, "_nq"), by))
        p, q = p.join(sizes, by), q.join(sizes, by)
    else:
        n_p, n_q = (df.agg(blocks(F.count(F.lit(1)))).first()[0] for df in (p, q))
        p, q = (df.withColumns({"_np": F.lit(n_p), "_nq": F.lit(n_q)}).where(F.lit(n_p > 0 and n_q > 0)) for df in (p, q))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    p = p.select(*by, "nn_rep", "ids", "p_vec", own("nn_rep", "_np").alias("_pb"), every("_nq").alias("_qb"))
    # both sides may come from one table: the queries' group columns get names of their own
    q = q.select(*(F.col(b).alias(f"_q_{b}") for b in by), "q_key", "q_vec", own("q_key", "_nq").alias("_qb"), every("_np").alias("_pb"))
    schema = StructType([*(p.schema[b] for b in by), q.schema["q_key"], p.schema["nn_rep"], p.schema["ids"], StructField("dist", DoubleType())])
    theirs = q.groupBy(*(f"_q_{b}" for b in by), "_pb", "_qb")
    found = p.groupBy(*by, "_pb", "_qb").cogroup(theirs).applyInArrow(top, schema)
    rank = F.row_number().over(Window.partitionBy(*by, "q_key").orderBy("dist", "nn_rep"))
    return found.withColumn("_rk", rank).where(F.col("_rk") <= need).drop("_rk")


def _grid_search(groups: DataFrame, qv: DataFrame, points: DataFrame, vec: str, by: list[str], k: int, need: int,
                 n_dirs: int, max_cells_per_dir: int) -> DataFrame:
    """(*by, q_key, nn_rep, ids, dist): the nearest distinct vectors whose copies reach ``need``.

    Every query vector carries its own search radius h_q. A round joins it with
    the distinct point vectors in the grid cells its cube (side 2 h_q in the
    ``n_dirs`` projected coordinates) touches, keeps those inside the cube and
    computes true distances. It is done when the copies within distance h_q
    number at least ``need``; it then keeps every candidate up to the distance where
    that count is reached. Otherwise its next radius is that distance when it is
    known -- an upper bound, so it finishes in the next round -- or a wider radius.
    Once h_q spans the projected range every point of the block is a candidate.
    """
    dirs = principal_directions(points, vec, n_dirs)
    m = len(dirs)
    dim = len(dirs[0])
    pc = [f"p_c{i}" for i in range(m)]
    qc = [f"q_c{i}" for i in range(m)]
    bc = [f"_b{i}" for i in range(m)]
    P = cut_lineage(groups.select(*by, "nn_rep", "p_vec", "mult", "ids",
                                  *[_project(groups, "p_vec", u).alias(c) for u, c in zip(dirs, pc)]))
    st = P.agg(*[F.min(c).alias(f"lo{i}") for i, c in enumerate(pc)],
               *[F.max(c).alias(f"hi{i}") for i, c in enumerate(pc)]).first()
    spans = [float((st[f"hi{i}"] or 0.0) - (st[f"lo{i}"] or 0.0)) for i in range(m)]
    span = max(spans) if spans else 0.0
    q0 = qv.select(*by, "q_key", "q_vec", *[_project(qv, "q_vec", u).alias(c) for u, c in zip(dirs, qc)])
    # initial radius from each block's own density: ~2k points of the block in the cube
    vol = None
    for c in pc:
        r = F.greatest(F.max(c) - F.min(c), F.lit(1e-12))
        vol = r if vol is None else vol * r
    h0 = 0.5 * F.pow(vol * (2.0 * k) / F.sum("mult"), 1.0 / m)
    if by:
        q0 = q0.join(P.groupBy(*by).agg(h0.alias("_h0")), by, "left")
    else:
        q0 = q0.withColumn("_h0", F.lit(P.agg(h0.alias("h")).first()["h"]))
    pending = cut_lineage(q0.select(*by, "q_key", "q_vec", *qc,
                                    F.greatest(F.coalesce(F.col("_h0"), F.lit(span)), F.lit(1e-12)).alias("_h")))
    a = pending.agg(F.percentile_approx("_h", 0.5).alias("med"), F.max("_h").alias("mx")).first()
    w = max(float(a["med"] or 1e-12), float(a["mx"] or 0.0) / max_cells_per_dir, 1e-12)
    done = None
    while True:  # every round at least doubles the radius of unfinished queries, up to the whole range
        pb = P.withColumns({b: F.floor(F.col(c) / w) for b, c in zip(bc, pc)})
        qb = pending
        for b, c in zip(bc, qc):
            qb = qb.select("*", F.explode(F.sequence(F.floor((F.col(c) - F.col("_h")) / w),
                                                     F.floor((F.col(c) + F.col("_h")) / w))).alias(b))
        inside = None
        for a_, b_ in zip(qc, pc):
            cond = F.abs(F.col(a_) - F.col(b_)) <= F.col("_h")
            inside = cond if inside is None else inside & cond
        c = (qb.join(pb, [*by, *bc]).where(inside)
             .select(*by, "q_key", "_h", "nn_rep", "mult", "ids", F.sqrt(sq_dist("q_vec", "p_vec", dim)).alias("dist")))
        wq = Window.partitionBy(*by, "q_key")
        cum = F.sum("mult").over(wq.orderBy("dist", "nn_rep").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        c = c.select("*", cum.alias("_cum"))
        # distance at which the copies reach `need` (null if they never do), and the count within h
        reach = F.min(F.when(F.col("_cum") >= need, F.col("dist"))).over(wq)
        within = F.sum(F.when(F.col("dist") <= F.col("_h"), F.col("mult")).otherwise(0)).over(wq)
        c = cut_lineage(c.select("*", reach.alias("_reach"), within.alias("_within"))
                        .where(F.col("_reach").isNull() | (F.col("dist") <= F.col("_reach"))))
        finished = (F.col("_within") >= need) | (F.col("_h") >= span)
        fin = c.where(finished).select(*by, "q_key", "nn_rep", "ids", "dist")
        done = fin if done is None else done.unionByName(fin)
        info = c.where(~finished).groupBy(*by, "q_key").agg(F.first("_reach").alias("_kd"),
                                                              F.max("_cum").alias("_cnt"))
        gone = c.where(finished).select(*by, "q_key").distinct()
        nxt = pending.join(gone, [*by, "q_key"], "left_anti").join(info, [*by, "q_key"], "left")
        grow = F.least(F.greatest(F.lit(2.0 * need) / F.greatest(F.coalesce(F.col("_cnt"), F.lit(0)), F.lit(1)),
                                  F.lit(2.0)), F.lit(64.0))
        # a query whose cube already spans everything and has no candidate has no neighbours
        nxt = nxt.where(F.col("_h") < span).select(
            *by, "q_key", "q_vec", *qc, F.coalesce(F.col("_kd"), F.col("_h") * grow).alias("_h"))
        pending = cut_lineage(nxt)
        agg = pending.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_h", 0.5).alias("med"),
                          F.max("_h").alias("mx")).first()
        if not agg["n"]:
            break
        w = max(float(agg["med"]), float(agg["mx"]) / max_cells_per_dir, 1e-12)
    return done


def knn_join(queries: DataFrame, points: DataFrame, k: int, q_id: str, p_id: str, vec: str = "vec",
             by: list[str] | None = None, exclude_self: bool = False, method: str = "blocks",
             block: int = 4096, n_dirs: int = 3, max_cells_per_dir: int = 10) -> DataFrame:
    """k nearest points for every query within the same ``by`` group (exact).

    Exact copies are collapsed first: the search runs over distinct vectors,
    each carrying its few smallest ids, so a large group of identical points costs
    one representative, not pairs among its copies. ``method`` is ``blocks`` (of
    ``block`` vectors on average) or ``grid`` (for vectors of few dimensions). Finally
    each query id takes the copies of its selected vectors, ranked by (distance, id),
    and keeps k.

    Output: (*by, q_id, ``nn_id``, ``rank`` 1..k, ``dist``); distance ties go to
    the smaller point id; ``exclude_self`` drops pairs with equal ids.
    """
    by = by or []
    need = k + (1 if exclude_self else 0)
    groups = _copy_groups(points, by, p_id, vec, need)
    # distinct query vectors, keyed by their smallest query id (an int key keeps
    # the windows and joins off the vector arrays); ids map back at the end
    qids = queries.select(*by, F.col(q_id).alias("_q"), F.col(vec).alias("q_vec"))
    qv = cut_lineage(qids.groupBy(*by, "q_vec").agg(F.min("_q").alias("q_key")))
    qmap = qids.join(qv, [*by, "q_vec"]).select(*by, "_q", "q_key")
    if method == "grid":
        done = _grid_search(groups, qv, points, vec, by, k, need, n_dirs, max_cells_per_dir)
    elif method == "blocks":
        done = _block_search(groups, qv, by, need, block)
    else:
        raise ValueError(f"method is blocks or grid, not {method!r}")
    # expand to query ids: the copies of every selected vector, ranked by (distance, id)
    sel = qmap.join(done, [*by, "q_key"]).select(*by, "_q", "dist", F.explode("ids").alias("nn_id"))
    if exclude_self:
        sel = sel.where(F.col("_q") != F.col("nn_id"))
    rk = F.row_number().over(Window.partitionBy(*by, "_q").orderBy("dist", "nn_id"))
    out = sel.select("*", rk.alias("rank")).where(F.col("rank") <= k)
    return out.select(*by, F.col("_q").alias(q_id), "nn_id", F.col("rank").cast("int").alias("rank"), "dist")


def knn_classify(queries: DataFrame, points: DataFrame, k: int, id_col: str, label: str, vec: str = "vec",
                 exclude_self: bool = True) -> DataFrame:
    """Majority vote of the k nearest labelled points (M13); count ties -> smallest label."""
    nn = knn_join(queries, points, k, id_col, id_col, vec, exclude_self=exclude_self)
    lab = points.select(F.col(id_col).alias("nn_id"), F.col(label).alias("_nl"))
    votes = nn.join(lab, "nn_id").groupBy(id_col, "_nl").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy(id_col).agg(F.min_by("_nl", F.struct((-F.col("votes")).alias("v"), F.col("_nl").alias("l"))).alias("pred"))
    return queries.select(id_col, label).join(best, id_col, "left")
