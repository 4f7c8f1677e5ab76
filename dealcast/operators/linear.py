"""Linear models on many features from one distributed Gramian (M2, M3, M4).

The rows are read once: each task keeps count, means and centred products per group (merged pairwise,
so no large sums of squares cancel), the partial matrices are merged in two levels, and every
model is then an iteration on a group's d x d matrix. A group's rows are never in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partial matrices of a group are merged in so many parts first.
PARTS = 32


def _merge(a, b):
    """Count, means and centred products of two sets of rows together."""
    import numpy as np
    if a is None:
        return b
    n = a[0] + b[0]
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def gramian(df: DataFrame, feats: list[str], y: str, by: list[str]) -> DataFrame:
    """by, n, mean (d + 1 values, the label's last), products ((d + 1) x (d + 1), by rows) per group.

    Rows with a null in a feature or the label take no part.
    """
    import pyarrow as pa
    cols, k = [*feats, y], len(feats) + 1
    kinds = ", ".join(f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by)
    stats = "n long, mean array<double>, products array<double>"

    def rows(found, like):
        keys = list(found)
        return pa.RecordBatch.from_arrays(
            [*(pa.array([key[i] for key in keys], like.field(b).type) for i, b in enumerate(by)), pa.array([found[key][0] for key in keys], pa.int64()),
             pa.array([found[key][1].tolist() for key in keys], pa.list_(pa.float64())),
             pa.array([found[key][2].ravel().tolist() for key in keys], pa.list_(pa.float64()))], [*by, "n", "mean", "products"])

    def partial(batches):
        import numpy as np
        found, like = {}, None
        for b in batches:
            like = b.schema
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols]) if b.num_rows else np.empty((0, k))
            at = {}
            for i, key in enumerate(zip(*(b.column(c).to_pylist() for c in by))):
                at.setdefault(key, []).append(i)
            for key, places in at.items():
                part = x[places]
                mean = part.mean(axis=0)
                found[key] = _merge(found.get(key), (len(part), mean, (part - mean).T @ (part - mean)))
        if found:
            yield rows(found, like)

    def merged(table):
        import numpy as np
        whole = None
        for n, mean, products in zip(*(table.column(c).to_pylist() for c in ("n", "mean", "products"))):
            whole = _merge(whole, (n, np.array(mean), np.array(products).reshape(k, k)))
        key = tuple(table.column(b)[0].as_py() for b in by)
        return pa.Table.from_batches([rows({key: whole}, table.schema)])

    x = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    parts = x.mapInArrow(partial, f"{kinds}, {stats}").withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))
    return parts.groupBy(*by, "_part").applyInArrow(merged, f"{kinds}, {stats}").groupBy(*by).applyInArrow(merged, f"{kinds}, {stats}")


def evidence(g, b, yy: float, n: int, ard: bool = False, n_iter: int = 300, tol: float = 1e-3, a1: float = 1e-6, a2: float = 1e-6,
             l1: float = 1e-6, l2: float = 1e-6, threshold: float = 1e4):
    """Evidence maximisation on centred products: coefficients, noise precision, weight precisions.

    One precision for all weights (Bayesian ridge), or one for each (ARD); a weight whose
    precision passes the threshold is pruned for good.
    """
    import numpy as np
    d = len(b)
    alpha, lam, coef = 1.0 / (yy / n + 1e-12), np.ones(d), np.zeros(d)
    kept = np.ones(d, bool)
    for i in range(n_iter):
        before = coef
        if ard:
            kept = kept & (lam <= threshold)
        coef = np.zeros(d)
        gamma = np.zeros(d)
        if kept.any():
            sigma = np.linalg.inv(np.diag(lam[kept]) + alpha * g[np.ix_(kept, kept)])
            coef[kept] = alpha * sigma @ b[kept]
            gamma[kept] = 1.0 - lam[kept] * np.diag(sigma)
        rss = yy - 2 * coef @ b + coef @ g @ coef
        if ard:
            lam = np.where(kept, (gamma + 2 * l1) / (coef ** 2 + 2 * l2), lam)
        else:
            lam = np.full(d, (gamma.sum() + 2 * l1) / (coef @ coef + 2 * l2))
        alpha = (n - gamma.sum() + 2 * a1) / (rss + 2 * a2)
        if i > 0 and np.abs(before - coef).sum() < tol:
            break
    return coef, float(alpha), lam


def lars(g, b, n: int, alpha: float):
    """Coefficients of (1/2n) |y - Xw|^2 + alpha |w|_1 by the least-angle path with drops, from products.

    All active features keep the same correlation with what is left, and it falls from its
    greatest value to ``alpha``; on the way a feature joins when its own reaches the others', and leaves
    when its coefficient passes zero.
    """
    import numpy as np
    g, c0 = g / n, b / n
    w = np.zeros(len(b))
    usable = np.diag(g) > 1e-14
    level = float(np.abs(c0[usable]).max(initial=0.0))
    if level <= alpha:
        return w
    active = [int(np.argmax(np.where(usable, np.abs(c0), -1.0)))]
    dropped = -1
    for _ in range(100 * len(b) + 100):
        c = c0 - g @ w
        sign = np.sign(c[active])
        step = np.linalg.lstsq(g[np.ix_(active, active)], sign, rcond=None)[0]
        move = g[:, active] @ step
        best, event = level - alpha, None
        for j in np.flatnonzero(usable):
            if j in active:
                continue
            for top, slope in ((level - c[j], 1.0 - move[j]), (level + c[j], 1.0 + move[j])):
                if j == dropped and abs(top) <= 1e-9 * level:
                    continue  # it has just left at this end
                if slope > 1e-12 and max(top, 0.0) / slope < best:
                    best, event = max(top, 0.0) / slope, ("join", int(j))
        for k, j in enumerate(active):
            if step[k] * w[j] < 0 and -w[j] / step[k] < best:
                best, event = -w[j] / step[k], ("drop", j)
        w[active] += best * step
        level -= best
        if event is None:
            return w
        dropped = -1
        if event[0] == "join":
            active.append(event[1])
        else:
            w[event[1]] = 0.0
            active.remove(event[1])
            dropped = event[1]
            if not active:
                active, dropped = [int(np.argmax(np.where(usable, np.abs(c0 - g @ w), -1.0)))], -1
    return w


MODELS = {"bayesian_ridge": lambda g, b, yy, n, alpha: evidence(g, b, yy, n)[0], "ard": lambda g, b, yy, n, alpha: evidence(g, b, yy, n, ard=True)[0],
          "lasso_lars": lambda g, b, yy, n, alpha: lars(g, b, n, alpha)}


def linear_fits(df: DataFrame, feats: list[str], y: str, by: list[str], models: list[str], alpha: float = 1.0, scaled: bool = False) -> DataFrame:
    """by, model, feature (null: the intercept), coef: the models of each group, all from one pass.

    ``scaled``: fit on features divided by their deviation; coefficients are those of the features as they are.
    A constant feature gets 0.
    """
    import pyarrow as pa
    k = len(feats)
    m = gramian(df, feats, y, by)
    kinds = ", ".join(f"`{b}` {df.schema[b].dataType.simpleString()}" for b in by)

    def run(batches):
        import numpy as np
        for t in batches:
            for i in range(t.num_rows):
                n = t.column("n")[i].as_py()
                mean, p = np.array(t.column("mean")[i].as_py()), np.array(t.column("products")[i].as_py()).reshape(k + 1, k + 1)
                size = np.sqrt(np.diag(p)[:k] / n) if scaled else np.ones(k)
                size = np.where(size > 0, size, 1.0)
                out = []
                for name in models:
                    coef = MODELS[name](p[:k, :k] / np.outer(size, size), p[:k, k] / size, float(p[k, k]), n, alpha) / size
                    out += [(name, f, float(c)) for f, c in zip([*feats, None], [*coef, mean[k] - mean[:k] @ coef])]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([t.column(b)[i].as_py()] * len(out), t.schema.field(b).type) for b in by), pa.array([r[0] for r in out], pa.string()),
                     pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.float64())], [*by, "model", "feature", "coef"])

    return m.mapInArrow(run, f"{kinds}, model string, feature string, coef double")


def newton_logit(df: DataFrame, feats: list[str], label: str, ridge: float = 1.0, max_steps: int = 50, tol: float = 1e-9) -> tuple[list[float], float]:
    """Logistic regression of a 0/1 label by Newton steps (M12): coefficients and intercept.

    Minimises the log loss plus ``ridge`` / 2 times the squared coefficients (not the intercept). Gradient and
    Hessian of a step are one aggregation; a step that raises the loss is halved, and the search ends where no
    part of a step lowers it any more. Rows with a null take no part. Rows of one class have no finite optimum (the intercept
    grows by about 1 a step): the result is then that of the last step.
    """
    import numpy as np
    import pyarrow as pa

    from dealcast.session import cut_lineage
    k = len(feats) + 1
    rows = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in [*feats, label]]).dropna())

    def sums(w):
        """Loss, gradient and Hessian at w, added up over the tasks' parts."""
        def run(batches):
            loss, g, h = 0.0, np.zeros(k), np.zeros((k, k))
            for b in batches:
                if b.num_rows:
                    x = np.column_stack([*(b.column(c).to_numpy() for c in feats), np.ones(b.num_rows)])
                    y, m = b.column(label).to_numpy(), x @ w
                    p = 1 / (1 + np.exp(-m))
                    # per class, as logaddexp(0, m) - m has no digits left for a large m
                    loss += float((y * np.logaddexp(0, -m) + (1 - y) * np.logaddexp(0, m)).sum())
                    g += x.T @ (p - y)
                    h += (x * (p * (1 - p))[:, None]).T @ x
            values = [loss, *g, *h.ravel()]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values, pa.float64())], ["i", "v"])

        got = rows.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
        v = np.zeros(1 + k + k * k)
        for r in got:
            v[r["i"]] = r["v"]
        pen = np.append(np.full(k - 1, ridge), 0.0)
        return v[0] + 0.5 * (pen * w) @ w, v[1:k + 1] + pen * w, v[k + 1:].reshape(k, k) + np.diag(pen)

    w = np.zeros(k)
    loss, g, h = sums(w)
    for _ in range(max_steps):
        step = np.linalg.lstsq(h, g, rcond=None)[0]
        if np.abs(step).max() < tol:
            break
        scale = 1.0
        while True:
            after = sums(w - scale * step)
            if after[0] <= loss + 1e-12 * abs(loss):
                break
            if scale < 1e-6:
                return w[:-1].tolist(), float(w[-1])
            scale /= 2
        w, (loss, g, h) = w - scale * step, after
    return w[:-1].tolist(), float(w[-1])
