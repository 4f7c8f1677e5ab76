"""Models on MLlib and on per-group moments.

Default is ONE pooled fit over all brands (brand one-hot + features); metrics
are then grouped by brand. Univariate trend models (the reference fits the
discount against the day number) need only six moments per brand, so they are
one aggregation, not a fit loop. Tree ensembles and boosting are distributed
MLlib fits; iterative procedures checkpoint between rounds.
"""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (OneHotEncoder, StringIndexer, StringIndexerModel,
                                UnivariateFeatureSelector, VectorAssembler, VectorSlicer)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealcast.functions.draws import uniform_draw
from dealcast.operators import boosting, trees
from dealcast.session import cut_lineage

# ----------------------------------------------------------------- matrices

def _matrix_input(df: DataFrame, feats: list[str], label: str, keep: list[str]) -> DataFrame:
    assert label not in feats, "label must not be a feature"
    carried = [c for c in dict.fromkeys(["brand", *keep]) if c in df.columns and c not in feats and c != label]
    return df.select(*carried, *[F.col(f).cast("double").alias(f) for f in feats], F.col(label).cast("double").alias("label"))


def fit_matrix(df: DataFrame, feats: list[str], label: str, with_brand: bool = True):
    """Fitted assembling pipeline of ``vector_frame``; give it to every frame of a model.

    Brands are numbered alphabetically, whatever their frequencies; brands that the
    fitted rows lack share one slot.
    """
    stages, vec_in = [], list(feats)
    if with_brand and "brand" in df.columns:
        stages += [StringIndexer(inputCol="brand", outputCol="_brand_ix", handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=["_brand_ix"], outputCols=["_brand_oh"], handleInvalid="keep")]
        vec_in.append("_brand_oh")
    stages.append(VectorAssembler(inputCols=vec_in, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(_matrix_input(df, feats, label, []))


def matrix_names(fitted, feats: list[str], width: int) -> list[str]:
    """Names of the vector's slots: the features, then one for each brand, then the unseen ones."""
    brands = [f"brand={b}" for s in fitted.stages if isinstance(s, StringIndexerModel) for b in s.labels]
    return ([*feats, *brands] + ["brand=(unseen)"] * width)[:width]


def vector_frame(df: DataFrame, feats: list[str], label: str, with_brand: bool = True,
                 keep: list[str] | None = None, fitted=None) -> tuple[DataFrame, list[str]]:
    """Assemble ``features`` (numeric feats [+ brand one-hot]) and ``label``.

    The brand dictionary is fitted by StringIndexer (a distributed distinct), or
    taken from ``fitted`` (``fit_matrix`` of the training rows): frames that one
    model trains on and scores must share it. Returns the frame and the feature
    names in vector order. The label column is never an input of the assembler (Q12).
    """
    keep = keep or []
    base = _matrix_input(df, feats, label, keep)
    model = fitted or fit_matrix(df, feats, label, with_brand)
    # materialised once: every MLlib fit makes several passes over its input,
    # which would otherwise re-run the whole feature lineage each time
    keys = [c for c in dict.fromkeys(["brand", *keep]) if c in base.columns]
    out = model.transform(base).drop("_brand_ix", "_brand_oh").select(*keys, "features", "label")
    names = matrix_names(model, feats, out.schema["features"].metadata["ml_attr"]["num_attrs"])
    # rows arrive from shuffles in fetch order and upstream partition bounds can
    # vary; hashing the row keys to a fixed partition count and sorting inside
    # each partition makes every pass (and MLlib's seeded sampling) see the same
    # rows in the same order, so a refit -- or a recomputation after a lost
    # executor -- gives the same model. One shuffle of a panel-sized frame.
    if keys:
        out = canonical(out, keys)
    return cut_lineage(out), names


def canonical(df: DataFrame, keys: list[str]) -> DataFrame:
    """Deterministic partition contents and row order for a (small) model input:
    hash the row keys to a fixed partition count, sort inside partitions."""
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n_parts, *keys).sortWithinPartitions(*keys)


# ----------------------------------------------------------------- trend models (moments)

def trend_moments(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """n, means and centred sums of squares/products per group, in one aggregation."""
    xx, yy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(xx).alias("mx"), F.avg(yy).alias("my"),
        (F.var_pop(xx) * F.count(F.lit(1))).alias("sxx"),
        (F.covar_pop(xx, yy) * F.count(F.lit(1))).alias("sxy"),
        (F.var_pop(yy) * F.count(F.lit(1))).alias("syy"))


def ols_trend(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """Least-squares line per group (M1, univariate): slope = Sxy / Sxx."""
    m = trend_moments(df, x, y, by)
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    return m.select(*by, slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"))


def lasso_trend(df: DataFrame, x: str, y: str, by: list[str], alpha: float = 1.0) -> DataFrame:
    """Lasso / LARS solution per group for one feature (M2): soft-threshold of the
    covariance, objective (1/2n)||y - a - bx||^2 + alpha |b|."""
    m = trend_moments(df, x, y, by)
    rho = F.col("sxy") / F.col("n")
    shrunk = F.signum(rho) * (F.abs(rho) - F.lit(alpha))
    slope = F.when(F.abs(rho) > alpha, F.try_divide(shrunk, F.col("sxx") / F.col("n"))).otherwise(F.lit(0.0))
    return m.select(*by, slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"))


def _evidence_1d(n, sxx, sxy, syy, ard=False, n_iter=300, tol=1e-3, a1=1e-6, a2=1e-6, l1=1e-6, l2=1e-6,
                 threshold_lambda=1e4):
    """Evidence maximisation for y = b x (centred), the Bayesian ridge / ARD updates."""
    var_y = syy / n if n else 0.0
    alpha = 1.0 / (var_y + 1e-12)
    lam = 1.0
    coef = 0.0
    for _ in range(n_iter):
        coef_old = coef
        coef = sxy / (sxx + lam / alpha) if (sxx + lam / alpha) else 0.0
        if ard and lam > threshold_lambda:  # pruned for good
            return 0.0, (n + 2 * a1) / (syy + 2 * a2), lam
        rss = syy - 2 * coef * sxy + coef * coef * sxx
        gamma = alpha * sxx / (lam + alpha * sxx) if (lam + alpha * sxx) else 0.0
        lam = (gamma + 2 * l1) / (coef * coef + 2 * l2)
        alpha = (n - gamma + 2 * a1) / (rss + 2 * a2)
        if abs(coef_old - coef) < tol and _ > 0:
            break
    return coef, alpha, lam


def bayes_trend(df: DataFrame, x: str, y: str, by: list[str], ard: bool = False) -> DataFrame:
    """Bayesian ridge (M3) or ARD (M4) line per group.

    One distributed aggregation gives the six moments per group; the evidence
    iteration then runs on each of these rows (mapInPandas over the moments
    table, one row per group, never the group's data, and no second shuffle).
    """
    m = trend_moments(df, x, y, by)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for r in pdf.itertuples(index=False):
            coef, alpha, lam = _evidence_1d(r.n, r.sxx, r.sxy, r.syy, ard=ard)
            rows.append({**{b: getattr(r, b) for b in by}, "slope": float(coef),
                         "intercept": float(r.my - coef * r.mx), "noise_precision": float(alpha),
                         "weight_precision": float(lam)})
        return pd.DataFrame(rows, columns=[*by, "slope", "intercept", "noise_precision", "weight_precision"])

    schema = ", ".join(f"{b} string" for b in by) + ", slope double, intercept double, noise_precision double, weight_precision double"
    return m.mapInPandas(lambda parts: map(fit, parts), schema)


def apply_trend(df: DataFrame, coefs: DataFrame, x: str, by: list[str], out: str = "yhat") -> DataFrame:
    return df.join(coefs.select(*by, "slope", "intercept"), by).withColumn(
        out, F.col("intercept") + F.col("slope") * F.col(x).cast("double"))


# ----------------------------------------------------------------- regressors / classifiers

REGRESSORS = {
    "decision_tree": lambda seed: DecisionTreeRegressor(maxDepth=5, seed=seed),                       # M6
    "bagging": lambda seed: RandomForestRegressor(numTrees=20, featureSubsetStrategy="all", seed=seed),  # M8
    "random_forest": lambda seed: RandomForestRegressor(numTrees=20, seed=seed),                     # M9
    "gradient_boosting": lambda seed: GBTRegressor(maxIter=20, seed=seed),                           # M10
    "linear": lambda seed: LinearRegression(solver="auto"),  # M1; normal equations up to 4096 slots, L-BFGS beyond
    "lasso": lambda seed: LinearRegression(elasticNetParam=1.0, regParam=0.001),                     # M2
}

CLASSIFIERS = {
    "logit": lambda seed: LogisticRegression(maxIter=100),                                            # M12
    "naive_bayes": lambda seed: NaiveBayes(modelType="gaussian"),                                     # M14
    "linear_svc": lambda seed: LinearSVC(maxIter=50),                                                 # M15
    "decision_tree": lambda seed: DecisionTreeClassifier(maxDepth=5, seed=seed),                      # M16
    "random_forest": lambda seed: RandomForestClassifier(numTrees=20, seed=seed),                     # M17
    "gradient_boosting": lambda seed: GBTClassifier(maxIter=20, seed=seed),                           # M18
    "xgb_like": lambda seed: GBTClassifier(maxIter=20, stepSize=0.3, subsamplingRate=0.8,             # M19
                                           featureSubsetStrategy="0.8", seed=seed),
}


def binary_label(df: DataFrame, col: str = "label") -> DataFrame:
    """``df`` with its label marked as one of two classes, whichever of them its rows hold.

    Without the mark MLlib counts the classes of the rows: with class 0 alone there
    is one, and a model's vectors have no slot for class 1.
    """
    return df.withMetadata(col, {"ml_attr": {"type": "binary", "name": col}})


def unmarked(df: DataFrame, col: str = "label") -> DataFrame:
    """Without the mark, for logistic regression: of rows of class 0 marked as one of two it makes class 1 certain."""
    return df.withMetadata(col, {})


def only_class(train: DataFrame) -> float | None:
    """The label of all rows, or None if they hold several (or there is none)."""
    r = train.agg(F.min("label").alias("lo"), F.max("label").alias("hi")).first()
    return r["lo"] if r["lo"] == r["hi"] else None


def one_class_predictions(test: DataFrame, label: float) -> DataFrame:
    """``test`` as any class model of rows of one class predicts it: that class, with probability 1."""
    certain = array_to_vector(F.array(F.lit(1.0 - label), F.lit(float(label))))
    return test.withColumns({"rawPrediction": certain, "probability": certain, "prediction": F.lit(float(label))})


def positive_score(pred: DataFrame, model_name: str) -> DataFrame:
    """Score of the positive class: probability[1] when the model has one, else the raw margin."""
    if "probability" in pred.columns:
        return pred.withColumn("score", vector_to_array("probability")[1])
    return pred.withColumn("score", vector_to_array("rawPrediction")[1])


def fit_predict(train: DataFrame, test: DataFrame, estimator) -> DataFrame:
    """``test`` with the predictions of the estimator fitted on ``train``.

    MLlib's naive Bayes numbers the classes that it meets from 0, so rows of one class
    (which need no densities) are predicted by that class.
    """
    if isinstance(estimator, NaiveBayes) and (label := only_class(train)) is not None:
        return one_class_predictions(test, label)
    if isinstance(estimator, LogisticRegression):
        train = unmarked(train)
    return estimator.fit(train).transform(test)


def kbest_logit(train: DataFrame, test: DataFrame, k: int = 5) -> DataFrame:
    """F-test top-k selection feeding a logistic regression (M12 pipeline).

    Between fewer than two classes no feature has an F value (MLlib's test fails): all tie,
    and the first k are taken.
    """
    if only_class(train) is not None:
        width = len(train.select("features").first()[0])
        sel = VectorSlicer(inputCol="features", outputCol="sel", indices=list(range(min(k, width))))
    else:
        sel = UnivariateFeatureSelector(featuresCol="features", outputCol="sel", labelCol="label",
                                        selectionMode="numTopFeatures").setFeatureType("continuous") \
            .setLabelType("categorical").setSelectionThreshold(k)
    lr = LogisticRegression(featuresCol="sel", labelCol="label")
    return Pipeline(stages=[sel, lr]).fit(unmarked(train)).transform(test)


# ----------------------------------------------------------------- AdaBoost.R2 (M7)

def adaboost_r2(train: DataFrame, test: DataFrame, n_estimators: int = 50, max_depth: int = 3, seed: int = 7,
                keys: list[str] | None = None) -> DataFrame:
    """``boosting.adaboost_r2`` on vector frames (``features``, ``label``): ``test`` with ``prediction``."""
    rows = train.select(vector_to_array("features").alias("x"), F.col("label").alias("y"), *(keys or []))
    model = boosting.adaboost_r2(rows, n_estimators, max_depth, seed=seed, keys=keys)
    return model.transform(test, vector_to_array("features"))


# ----------------------------------------------------------------- extra trees

class ExtraTreesRegressor(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    """Ensemble of trees over random thresholds (M11): one threshold per tree, node and slot of
    the vector, the best of them splits the node (``trees.random_grown``). The forecast is the mean of all trees.

    ``featureSubsetStrategy``: "all", "onethird" or "sqrt" of the slots are tried at a node. Rows are told apart, for the bootstrap,
    by their place in the checkpointed input.
    """

    numTrees = Param(Params._dummy(), "numTrees", "trees of the ensemble", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "greatest depth of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "fewest rows of a node", TypeConverters.toInt)
    bootstrap = Param(Params._dummy(), "bootstrap", "whether a tree sees a bootstrap sample", TypeConverters.toBoolean)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "slots tried at a node", TypeConverters.toString)

    def __init__(self, numTrees: int = 100, maxDepth: int = 10, minInstancesPerNode: int = 1, bootstrap: bool = False,
                 featureSubsetStrategy: str = "all", seed: int = 11):
        super().__init__()
        self._set(numTrees=numTrees, maxDepth=maxDepth, minInstancesPerNode=minInstancesPerNode, bootstrap=bootstrap,
                  featureSubsetStrategy=featureSubsetStrategy, seed=seed)

    def setParams(self, **values) -> "ExtraTreesRegressor":
        return self._set(**values)

    def _fit(self, dataset: DataFrame) -> "ExtraTreesModel":
        opt = {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}
        rows = dataset.select(F.monotonically_increasing_id().alias("row"), F.col(opt["labelCol"]).alias("y"), vector_to_array(opt["featuresCol"]).alias("x"))
        rows = cut_lineage(rows)
        width = len(rows.select("x").first()[0])
        tried = {"all": width, "onethird": math.ceil(width / 3), "sqrt": math.ceil(math.sqrt(width))}[opt["featureSubsetStrategy"]]
        model = trees.random_grown(rows, width, opt["numTrees"], opt["maxDepth"], opt["minInstancesPerNode"], tried, opt["bootstrap"], opt["seed"])
        return self._copyValues(ExtraTreesModel(model))


class ExtraTreesModel(Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    """The grown trees of an ``ExtraTreesRegressor``."""

    def __init__(self, grown: trees.Trees):
        super().__init__()
        self.grown = grown

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return trees.predicted(dataset, self.grown, vector_to_array(self.getOrDefault(self.featuresCol)), self.getOrDefault(self.predictionCol))


def extra_trees(train: DataFrame, test: DataFrame, feats: list[str], n_trees: int = 100, max_depth: int = 10,
                seed: int = 11, keys: list[str] | None = None) -> DataFrame:
    """``ExtraTreesRegressor`` on plain feature columns: ``test`` with ``prediction``."""
    asm = VectorAssembler(inputCols=feats, outputCol="_x", handleInvalid="keep")
    train = asm.transform(canonical(train, keys) if keys else train)
    est = ExtraTreesRegressor(numTrees=n_trees, maxDepth=max_depth, seed=seed).setParams(featuresCol="_x")
    return est.fit(train).transform(asm.transform(test)).drop("_x")


# ----------------------------------------------------------------- importance

def gain_importance(tree_model, feature_names: list[str], path: str) -> DataFrame:
    """Average gain per split for each feature, read from the saved tree table.

    The model is written to ``path`` (a shared folder) and its node table read
    back as a DataFrame; internal nodes carry (featureIndex, gain).
    """
    from pyspark.sql import SparkSession
    tree_model.write().overwrite().save(path)
    ss = SparkSession.getActiveSession()
    nodes = ss.read.parquet(f"{path}/data")
    # ensembles store (treeID, nodeData struct); a single tree stores the node fields flat
    nd = nodes.select("nodeData.*") if "nodeData" in nodes.columns else nodes
    nd = nd.select(F.col("gain"), F.col("split.featureIndex").alias("fi"), F.col("leftChild").alias("left"))
    g = nd.where(F.col("left") >= 0).groupBy("fi").agg(F.avg("gain").alias("avg_gain"), F.count(F.lit(1)).alias("n_splits"))
    names = ss.createDataFrame([(i, n) for i, n in enumerate(feature_names)], "fi int, feature string")
    return g.join(names, "fi", "left").select(F.coalesce("feature", F.concat(F.lit("f"), F.col("fi").cast("string"))).alias("feature"),
                                               "avg_gain", "n_splits")


# ----------------------------------------------------------------- Gaussian NB parameters

def gaussian_nb_params(df: DataFrame, feats: list[str], label: str, digits: int | None = None) -> DataFrame:
    """Class prior, per-feature mean and population variance per class: the
    parameters a Gaussian naive Bayes model consists of, from one aggregation."""
    x = {f: F.col(f).cast("double") for f in feats}
    per = df.groupBy(F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("nc"),
        *[F.avg(x[f]).alias(f"m__{f}") for f in feats], *[F.var_pop(x[f]).alias(f"v__{f}") for f in feats])
    stack = ", ".join(f"'{f}', `m__{f}`, `v__{f}`" for f in feats)
    long = per.selectExpr("class", "nc", f"stack({len(feats)}, {stack}) AS (feature, mean, var)")
    from pyspark.sql import Window
    prior = F.col("nc") / F.sum("nc").over(Window.partitionBy("feature"))  # <= n_classes rows per feature
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return long.select("class", "feature", r(prior).alias("prior"), r(F.col("mean")).alias("mean"),
                       r(F.col("var")).alias("var"))


# ----------------------------------------------------------------- model selection

def exact_auc_evaluator():
    """Area under ROC over all distinct thresholds (numBins=0: no down-sampling)."""
    return BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)


def ranked_by(evaluator, model, pred: DataFrame):
    """The evaluator on the column that ranks the rows of ``pred`` by class 1.

    Only margin models rank by ``rawPrediction``: a tree's holds the leaf's row counts and naive
    Bayes' the log density within each class, which say little before they are set against the other class's.
    """
    margins = not isinstance(model, Estimator) or isinstance(model, (LogisticRegression, LinearSVC, GBTClassifier))
    if not isinstance(evaluator, BinaryClassificationEvaluator) or margins or "probability" not in pred.columns:
        return evaluator
    return evaluator.copy({evaluator.rawPredictionCol: "probability"})


def nearest_votes(train: DataFrame, test: DataFrame, k: int = 5, id_col: str = "row_id") -> DataFrame:
    """``test`` with the share of label 1 among each row's k nearest training rows (M13) as ``rawPrediction``."""
    from dealcast.operators.neighbours import knn_join
    rows = [d.select(id_col, vector_to_array("features").alias("vec")) for d in (test, train)]
    near = knn_join(rows[0], rows[1], k, id_col, id_col).join(
        train.select(F.col(id_col).alias("nn_id"), F.col("label").alias("_near")), "nn_id")
    return test.join(near.groupBy(id_col).agg(F.avg("_near").alias("rawPrediction")), id_col)


def spot_check(frame: DataFrame, models: dict, folds: list, evaluator=None, metric: str = "roc_auc",
               parallelism: int = 4) -> DataFrame:
    """Every model on every fold (M21): long score table (model, fold, metric, value).

    ``models`` names estimators, or functions of (train, test) that return the test
    rows with predictions. ``folds`` are (train, test) pairs of conditions on the
    frame: ``column_folds`` or ``calendar_folds``. The frame is checkpointed once and
    every fold selects its rows from it; the fits are independent jobs submitted
    from ``parallelism`` driver threads. A fold whose test rows are of one class has no
    area under ROC: its value is null. The area is of the margins, or of the probabilities
    of models without one (``ranked_by``).
    """
    from concurrent.futures import ThreadPoolExecutor
    spark, frame = frame.sparkSession, cut_lineage(frame)
    ev = evaluator or exact_auc_evaluator()
    scored = [True] * len(folds)
    if isinstance(ev, BinaryClassificationEvaluator):
        label = ev.getLabelCol()
        ends = frame.agg(*[end(F.when(te, F.col(label))).alias(f"{end.__name__}{f}") for f, (_, te) in enumerate(folds) for end in (F.min, F.max)]).first()
        scored = [ends[f"min{f}"] != ends[f"max{f}"] for f in range(len(folds))]

    def run(task):
        name, f = task
        tr, te = (frame.where(side) for side in folds[f])
        model = models[name]
        pred = fit_predict(tr, te, model) if isinstance(model, Estimator) else model(tr, te)
        return name, f, metric, float(ranked_by(ev, model, pred).evaluate(pred)) if scored[f] else None

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        rows = list(pool.map(run, [(m, f) for m in models for f in range(len(folds))]))
    return spark.createDataFrame(rows, "model string, fold int, metric string, value double")


def spot_check_classifiers(seed: int = 7) -> dict:
    """The classifiers that the reference compares; the frame needs ``row_id`` for the nearest neighbours."""
    return {name: make(seed) for name, make in CLASSIFIERS.items()} | {"knn": nearest_votes}


def spot_check_regressors(seed: int = 7) -> dict:
    """The six regressors that the reference compares (by RMSE on 20 blocks of 84 days)."""
    mllib = {name: REGRESSORS[name](seed) for name in ("decision_tree", "bagging", "random_forest", "gradient_boosting")}
    return mllib | {"adaboost": adaboost_r2, "extra_trees": ExtraTreesRegressor()}


def column_folds(k: int, col: str = "fold") -> list:
    """(train, test) conditions of a fold column: the other folds, and the fold."""
    return [(F.col(col) != f, F.col(col) == f) for f in range(k)]


def calendar_folds(frame: DataFrame, n_splits: int = 20, test_days: int | None = None, col: str = "posted_date") -> list:
    """(train, test) conditions of expanding walk-forward folds with shared calendar cuts.

    The last ``n_splits`` blocks of ``test_days`` days (default: days // (n_splits + 1))
    are tested one by one, each by a fit on all earlier days. The cuts are dates, the
    same for every group, so a pooled fit never sees a day later than its test block
    starts, whichever group the day belongs to.
    """
    ends = frame.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    days = (ends["hi"] - ends["lo"]).days + 1
    size = test_days or days // (n_splits + 1)
    if size < 1 or size * n_splits >= days:
        raise ValueError(f"{days} days hold no training day before {n_splits} test blocks of {size} days")
    starts = [ends["hi"] - dt.timedelta(size * (n_splits - f) - 1) for f in range(n_splits)]
    return [(F.col(col) < F.lit(s), (F.col(col) >= F.lit(s)) & (F.col(col) < F.lit(s + dt.timedelta(size)))) for s in starts]


# The ranges that the reference's searches draw from. A pair is a
# half-open range (whole numbers, or real ones), a list a choice.
def rf_param_space(light: bool = False) -> dict:
    """Random-forest search space. Full: the reference's ranges (trees 150-999,
    depth 10..110 or unlimited -> capped at MLlib's 30, leaf 1/2/4, sqrt/auto
    features, bootstrap on/off). Light: small forests for quick runs."""
    if light:
        return {"numTrees": (10, 50), "maxDepth": [3, 5, 8], "minInstancesPerNode": [1, 2, 4],
                "featureSubsetStrategy": ["sqrt", "auto"], "bootstrap": [True, False]}
    return {"numTrees": (150, 1000), "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4],
            "featureSubsetStrategy": ["sqrt", "auto"], "bootstrap": [True, False]}


def boosted_param_space() -> dict:
    """Boosted-tree search space: rounds, step size, shares of rows and slots, depth, leaf size."""
    return {"maxIter": (150, 1000), "stepSize": (0.01, 0.61), "subsamplingRate": (0.3, 1.2),
            "maxDepth": [3, 4, 5, 6, 7, 8, 9], "featureSubsetStrategy": (0.5, 1.4), "minInstancesPerNode": [1, 2, 3, 4]}


def extra_trees_space() -> dict:
    """Extra-trees search space (the reference's second split criterion does not exist in MLlib)."""
    return {"numTrees": (10, 110), "bootstrap": [True, False]}


def drawn_columns(space: dict, seed: int, draw: str = "draw") -> list:
    """The parameters of a draw number (M22) as columns.

    A value is picked by the md5 draw of (seed, draw, parameter), so any engine draws
    the same sets. Shares above 1 become 1.
    """
    cols = []
    for name, values in space.items():
        u = uniform_draw(F.lit(seed), draw, F.lit(name))
        if isinstance(values, list):
            col = F.element_at(F.array(*[F.lit(v) for v in values]), F.floor(u * len(values)).cast("int") + 1)
        elif all(isinstance(v, int) for v in values):
            col = (F.lit(values[0]) + F.floor(u * (values[1] - values[0]))).cast("int")
        else:
            col = F.least(F.lit(values[0]) + u * (values[1] - values[0]), F.lit(1.0))
        cols.append(col.alias(name))
    return cols


def search_draws(spark, space: dict, n_iter: int, seed: int = 42) -> DataFrame:
    """``n_iter`` parameter draws, one row each."""
    return spark.range(n_iter).select(F.col("id").cast("int").alias("draw")).select("draw", *drawn_columns(space, seed))


def param_maps(estimator, draws: DataFrame) -> list[dict]:
    """The draws (one row each) as parameter maps of an estimator."""
    return [{estimator.getParam(k): str(v) if k == "featureSubsetStrategy" else v for k, v in r.asDict().items() if k != "draw"}
            for r in draws.orderBy("draw").collect()]


def random_search_classifier(folds: DataFrame, n_iter: int = 100, k: int = 10, seed: int = 42,
                             space: dict | None = None, parallelism: int = 4, scoring: str = "accuracy",
                             estimator=None):
    """Seeded random search with k-fold CV on a fold column (M22), then the best
    model refitted on all rows (M23).

    ``estimator``: a random forest by default; for boosted trees give a
    ``GBTClassifier``, ``boosted_param_space()`` and scoring "roc_auc". ``scoring``:
    "accuracy" (a classifier's default score, as in the reference's forest search) or
    "roc_auc". Returns (best_model, table of (draw, params, mean_score)).
    """
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator
    spark = folds.sparkSession
    est = estimator or RandomForestClassifier(seed=seed)
    maps = param_maps(est, search_draws(spark, space or rf_param_space(), n_iter, seed))
    ev = exact_auc_evaluator() if scoring == "roc_auc" else MulticlassClassificationEvaluator(metricName="accuracy")
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=ev, numFolds=k,
                        foldCol="fold", parallelism=parallelism, seed=seed)
    model = cv.fit(cut_lineage(folds))
    table = spark.createDataFrame(
        [(i, str({p.name: v for p, v in m.items()}), float(a)) for i, (m, a) in enumerate(zip(maps, model.avgMetrics))],
        "draw int, params string, mean_score double")
    return model.bestModel, table


def walk_forward_search(frame: DataFrame, estimator_maps: list, folds: list, parallelism: int = 4, scoring: str = "r2"):
    """Walk-forward model selection for regression (M22 regression branch).

    CrossValidator trains on all other folds; an expanding window must only
    train on the past, so every (estimator, parameter map) is a model of a
    ``spot_check`` on ``calendar_folds``. ``scoring``: "r2" (a regressor's default
    score, as in the reference's search; higher is better) or "rmse" (lower is
    better). Returns ((best index, best mean score), [(index, mean score), ...]).
    """
    from pyspark.ml.evaluation import RegressionEvaluator
    models = {str(i): est.copy(pm) for i, (est, pm) in enumerate(estimator_maps)}
    scores = spot_check(frame, models, folds, RegressionEvaluator(metricName=scoring), scoring, parallelism)
    mean = {r["model"]: r["v"] for r in scores.groupBy("model").agg(F.avg("value").alias("v")).collect()}
    results = [(i, mean[str(i)]) for i in range(len(estimator_maps))]
    return (max if scoring == "r2" else min)(results, key=lambda r: r[1]), results


def extra_trees_search(frame: DataFrame, folds: list, n_iter: int = 10, seed: int = 42, parallelism: int = 4):
    """The reference's regression search: ``n_iter`` draws of extra trees on walk-forward
    folds by R2; returns (best estimator, [(index, mean score), ...]), to be fitted again on all rows."""
    est = ExtraTreesRegressor(seed=seed)
    maps = param_maps(est, search_draws(frame.sparkSession, extra_trees_space(), n_iter, seed))
    best, results = walk_forward_search(frame, [(est, m) for m in maps], folds, parallelism)
    return est.copy(maps[best[0]]), results


def compare_feature_sets(train: DataFrame, test: DataFrame, k: int = 10, n_features: int | None = None) -> DataFrame:
    """Linear regression on all features vs the top-k by F score vs the top-k by
    mutual information (X7); RMSE per brand and feature set."""
    from dealcast.operators.features import mutual_info
    d = n_features or len(train.select("features").first()[0])
    fsel = UnivariateFeatureSelector(featuresCol="features", outputCol="sel", labelCol="label",
                                     selectionMode="numTopFeatures").setFeatureType("continuous") \
        .setLabelType("continuous").setSelectionThreshold(k).fit(train)
    arr = train.select("label", vector_to_array("features").alias("a"))
    cols = arr.select("label", *[F.col("a")[i].alias(f"f{i}") for i in range(d)])
    mi = mutual_info(cols, [f"f{i}" for i in range(d)], "label", bins=10)
    top = [int(r["feature"][1:]) for r in mi.orderBy(F.desc("mi"), "feature").limit(k).collect()]  # k indices
    sets = {"full": None, "f_regression": ("sel", fsel), "mutual_info": ("sel", VectorSlicer(
        inputCol="features", outputCol="sel", indices=sorted(top)))}
    out = None
    for name, sel in sets.items():
        tr, te, col = train, test, "features"
        if sel is not None:
            col, model = sel
            tr, te = model.transform(train), model.transform(test)
        p = LinearRegression(featuresCol=col, solver="auto").fit(tr).transform(te)
        e = F.col("prediction") - F.col("label")
        s = p.groupBy("brand").agg(F.round(F.sqrt(F.avg(e * e)), 6).alias("rmse")).withColumn("feature_set", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out
