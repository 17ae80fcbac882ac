"""Model-based selection, training, validation and scoring (SEL5-SEL9, MOD1-MOD4, SCO1).

Every fit is a distributed Spark ML estimator over the user rows; what reaches
the driver is per-feature (coefficients, importances: ten numbers) or
per-fold (four counts), never per-user.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.scalars import risk_level
from churnlens.operators import profile as P
from churnlens.operators.sampling import (
    apply_standard, fit_standard, hash_key, kfold_assignment, stratified_split,
)
from churnlens.operators.selection import filter_method
from churnlens.schemas import FEATURE_COLUMNS, FINAL_FEATURES, require_columns
from churnlens.session import materialize
from churnlens.sources.artefacts import Artefacts
from churnlens.sources.files import path_exists

SEED = 42
RF_TREES = 100
RF_MAX_DEPTH = 30       # trees grow without a depth bound; 30 is the most that Spark allows
DT_MAX_DEPTH = 5
MAX_BINS = 256          # bins per feature, for the tree and the forests alike
BIN_SAMPLE = 50_000     # rows (in expectation) whose values the bins are taken from
# A leaf of a forest's tree holds at least this share of the training weight, so a tree has at most 1 / share
# leaves however many rows there are, and the model in the driver does not grow with them.
LEAF_SHARE = 0.003
RFE_KEEP = 5
TOP_K = 5
FOLDS = 5
RF_PASS_MB = 256
PARALLEL_FITS = 3     # independent fits (folds, selection methods) submitted concurrently
# Rows that concurrent forests may hold in all: a fit keeps counts and node ids of 100 trees, some 1.8 KB a row.
FITTED_ROWS = 3_000_000
LAID_ROWS = 50_000    # a binned table of more rows is spread evenly over the cores, equal bins side by side
MOST_LAID_ROWS = 1_000_000


def _ranked(spark, values: dict[str, float], cols, score: str, rank: str) -> DataFrame:
    """Per-feature score table ranked descending, ties by feature ordinal."""
    order = sorted(range(len(cols)), key=lambda i: (-(values[cols[i]] or 0.0), i))
    rows = [(cols[i], i, float(values[cols[i]] or 0.0), r + 1) for r, i in enumerate(order)]
    return spark.createDataFrame(rows, f"feature string, ordinal int, {score} double, {rank} int")


def assembled(df: DataFrame, cols, out: str = "features_vec") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


def with_label(df: DataFrame, label: str = "churn") -> DataFrame:
    return df.withColumn("label", F.col(label).cast("double"))


# ------------------------------------------------------------------ logistic regression by Newton steps
NEWTON_STEPS = 50
NEWTON_TOL = 1e-9


def logistic_statistics(rows: DataFrame, cols, label: str, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient, Hessian and value of the summed log-loss at ``weights`` (intercept first), from one pass.

    Every task adds up its rows' statistics with matrix products and sends one row of (d+1)(d+2)/2 + d + 2
    numbers; Spark adds these up."""
    d = len(cols) + 1
    upper = np.triu_indices(d)
    names = [f"s{i}" for i in range(1 + d + len(upper[0]))]

    def run(batches):
        total = np.zeros(len(names))
        for batch in batches:
            n = batch.num_rows
            x = np.column_stack([np.ones(n), *[batch.column(c).to_numpy() for c in cols]])
            y = batch.column(label).to_numpy()
            z = x @ weights
            p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
            total[0] += float((np.logaddexp(0.0, z) - y * z).sum())
            total[1:1 + d] += (p - y) @ x
            total[1 + d:] += (x.T @ (x * (p * (1.0 - p))[:, None]))[upper]
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in total], names=names)

    parts = rows.select(label, *cols).mapInArrow(run, ", ".join(f"{n} double" for n in names))
    v = np.array([x or 0.0 for x in parts.agg(*[F.sum(n) for n in names]).first()])
    h = np.zeros((d, d))
    h[upper] = v[1 + d:]
    return v[1:1 + d], h + np.triu(h, 1).T, float(v[0])


def logistic_newton(rows: DataFrame, cols, label: str, start: np.ndarray | None = None, ridge: float = 1.0) -> np.ndarray:
    """Weights (intercept first) that minimise the summed log-loss plus ``ridge`` / 2 times the squared weights (not
    the intercept's), by Newton steps with one pass each; a step that does not lower the value is halved."""
    d = len(cols) + 1
    w = np.zeros(d) if start is None else start.copy()
    keep = np.full(d, ridge)
    keep[0] = 0.0

    def at(w):
        g, h, loss = logistic_statistics(rows, cols, label, w)
        return g + keep * w, h + np.diag(keep), loss + 0.5 * float(keep @ (w * w))

    g, h, value = at(w)
    for _ in range(NEWTON_STEPS):
        # a class that is absent leaves the intercept without curvature
        step = np.linalg.solve(h + 1e-12 * np.eye(d), g)
        while True:
            new = w - step
            g2, h2, value2 = at(new)
            if value2 <= value + 1e-9 * abs(value) or np.abs(step).max() < NEWTON_TOL:
                break
            step = step / 2
        w, g, h, value = new, g2, h2, value2
        if np.abs(step).max() < NEWTON_TOL:
            break
    return w


def rfe_ranking(train: DataFrame, cols=FEATURE_COLUMNS, n_keep: int = RFE_KEEP, label: str = "churn") -> DataFrame:
    """Recursive elimination with L2 logistic regression (unit inverse regularisation) on standardised data.

    One feature leaves per round: the smallest squared coefficient, to ten digits after the point, and of
    features that tie there the one with the lower ordinal.  Rank 1 = kept; the last one out gets 2, the
    first one out gets ``len(cols) - n_keep + 1``.  Each fit starts from the one before it.
    """
    spark = train.sparkSession
    cols = list(cols)
    data = with_label(train.select(label, *[F.col(c).cast("double").alias(c) for c in cols]), label)
    data = materialize(apply_standard(data, fit_standard(data, cols), keep=["label"]), "rfe-train")
    remaining, out_order, w = list(cols), [], None
    while len(remaining) > n_keep:
        w = logistic_newton(data, remaining, "label", w)
        loser = min(range(len(remaining)), key=lambda i: (round(float(w[i + 1]) ** 2, 10), i))
        out_order.append(remaining.pop(loser))
        w = np.delete(w, loser + 1)
    ranks = {c: 1 for c in remaining}
    for i, c in enumerate(reversed(out_order)):
        ranks[c] = i + 2
    rows = [(c, i, ranks[c], ranks[c] == 1) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "feature string, ordinal int, rfe_rank int, rfe_selected boolean")


def dt_importance(train: DataFrame, cols=FEATURE_COLUMNS, label: str = "churn",
                  max_depth: int = DT_MAX_DEPTH, seed: int = SEED) -> DataFrame:
    """Gini importances of one depth-limited tree, ranked."""
    cols = list(cols)
    data = assembled(with_label(train, label), cols)
    m = DecisionTreeClassifier(featuresCol="features_vec", labelCol="label", maxDepth=max_depth,
                               impurity="gini", maxBins=MAX_BINS, seed=seed).fit(data)
    imp = m.featureImportances.toArray()
    return _ranked(train.sparkSession, {c: float(imp[i]) for i, c in enumerate(cols)}, cols,
                   "dt_importance", "dt_rank")


# ------------------------------------------------------------------ forests on binned features
def bin_edges(values: np.ndarray, bins: int = MAX_BINS) -> list[float]:
    """Inner edges that cut a column into at most ``bins`` bins of about equal weight, each halfway between
    two neighbouring values; every value has its own bin if there are no more than ``bins``."""
    distinct, counts = np.unique(values, return_counts=True)
    if len(distinct) > bins:
        upto = np.cumsum(counts)
        wanted = upto[-1] * np.arange(1, bins) / bins
        last = np.unique(np.searchsorted(upto, wanted))  # a bin ends with one of these values
        last = last[last < len(distinct) - 1]
    else:
        last = np.arange(len(distinct) - 1)
    low, high = distinct[last], distinct[last + 1]
    edges = low + (high - low) / 2
    return np.where(edges > low, edges, high).tolist()  # a value at an edge lies above it


def fit_bins(df: DataFrame, cols, key: str = "username", seed: int = SEED, bins: int = MAX_BINS,
             sample: int = BIN_SAMPLE, n: int | None = None) -> Bucketizer:
    """The bins of each feature, from the values of about ``sample`` rows chosen by a hash of their key
    (``n``: the number of rows, if known)."""
    cols, rows = list(cols), df
    n = df.count() if n is None else n
    if n > sample:
        rows = df.where(hash_key(key, seed, 1) < F.lit(int(sample / n * 16 ** 13)))
    values = rows.select(*[F.col(c).cast("double").alias(c) for c in cols]).toPandas()
    inf = float("inf")
    splits = []
    for c in cols:
        v = values[c].dropna().to_numpy()
        edges = bin_edges(v, bins) if len(v) else []
        splits.append([-inf, *(edges or [float(v[0]) if len(v) else 0.0]), inf])
    return Bucketizer(inputCols=cols, outputCols=[f"{c}__bin" for c in cols], splitsArray=splits, handleInvalid="error")


def laid_out(binned: DataFrame, n: int, names) -> DataFrame:
    """``n`` binned rows in equal parts, one per core as long as a part has neither few nor very many rows, and
    in the order of their bins.  Neighbours then go the same way in most trees, so that a pass adds to
    counts that are still at hand.  A table of few rows stays as it is."""
    if n <= LAID_ROWS:
        return binned
    cores = binned.sparkSession.sparkContext.defaultParallelism
    parts = min(-(-n // LAID_ROWS), max(cores, -(-n // MOST_LAID_ROWS)))
    return binned.repartition(parts).sortWithinPartitions(*names)


class Binned:
    """A table whose features are binned once, for any number of forests on subsets of its rows.

    The written table holds the label, the bins as small integers, and the ``marks`` (split, fold) that
    choose the rows; ``counts`` are its rows by label and marks."""

    def __init__(self, df: DataFrame, cols, label: str = "churn", marks=(), keep=()):
        self.cols, self.label, self.marks = list(cols), label, list(marks)
        self.n = df.count()
        self.bucketizer = fit_bins(df, self.cols, n=self.n)
        names = self.bucketizer.getOutputCols()
        raw = with_label(df, label)
        raw = raw.select(*dict.fromkeys([*keep, label, "label", *self.marks]), *[F.col(c).cast("double").alias(c) for c in self.cols])
        out = self.bucketizer.transform(raw)
        out = out.select(*dict.fromkeys([*keep, label, "label", *self.marks]),
                         *[F.col(c).cast("smallint").alias(c) for c in names])
        self.table = materialize(laid_out(out, self.n, names), "binned")
        self.assembler = VectorAssembler(inputCols=names, outputCol="features_vec", handleInvalid="error")
        self.counts = self.table.groupBy(label, *self.marks).agg(F.count(F.lit(1)).alias("n")).collect()

    def weighted(self, where: Column, chosen) -> DataFrame:
        """The rows that ``where`` (a condition) and ``chosen`` (the same on a row of ``counts``) name, with
        balanced class weights."""
        by_class: dict = {}
        for r in self.counts:
            if chosen(r):
                by_class[r[self.label]] = by_class.get(r[self.label], 0) + r["n"]
        total, weight = sum(by_class.values()), F.lit(None).cast("double")
        for c, n in by_class.items():
            same = F.col(self.label).isNull() if c is None else F.col(self.label) == F.lit(c)
            weight = F.when(same, F.lit(total / (len(by_class) * n))).otherwise(weight)
        return self.table.where(where).withColumn("weight", weight)

    def fit(self, rows: DataFrame, seed: int = SEED, trees: int = RF_TREES, max_depth: int = RF_MAX_DEPTH,
            leaf_share: float = LEAF_SHARE) -> PipelineModel:
        """A class-balanced forest on binned rows, as a pipeline that takes the raw features."""
        # node ids cached per row: each pass reads the cached ids instead of re-walking every tree
        rf = RandomForestClassifier(featuresCol="features_vec", labelCol="label", weightCol="weight", numTrees=trees,
                                    maxDepth=max_depth, maxBins=MAX_BINS, featureSubsetStrategy="sqrt", seed=seed,
                                    minWeightFractionPerNode=leaf_share, maxMemoryInMB=RF_PASS_MB, cacheNodeIds=True,
                                    checkpointInterval=10)
        return PipelineModel(stages=[self.bucketizer, self.assembler, rf.fit(self.assembler.transform(rows))])

    def predict(self, model: PipelineModel, where: Column) -> DataFrame:
        """The model's predictions on binned rows: the binning is not done again."""
        return predict(PipelineModel(stages=model.stages[1:]), self.table.where(where))


def rf_importance(train: DataFrame, cols=FEATURE_COLUMNS, label: str = "churn", seed: int = SEED,
                  trees: int = RF_TREES, max_depth: int = RF_MAX_DEPTH) -> DataFrame:
    """Mean impurity importances of a class-balanced forest, ranked."""
    cols = list(cols)
    binned = Binned(train, cols, label)
    m = binned.fit(binned.weighted(F.lit(True), lambda r: True), seed, trees, max_depth)
    imp = m.stages[-1].featureImportances.toArray()
    return _ranked(train.sparkSession, {c: float(imp[i]) for i, c in enumerate(cols)}, cols,
                   "rf_importance", "rf_rank")


def comparison_table(filt: DataFrame, rfe: DataFrame, dt: DataFrame, rf: DataFrame,
                     filter_vote: str = "anova_top", top_k: int = TOP_K) -> DataFrame:
    """Vote table: ANOVA top-k (or the filter's final choice) + RFE kept + DT top-k + RF top-k.

    ≥ 3 votes Keep, 2 Optional, else Drop; a feature missing from a method gets rank 99.
    All inputs have one row per feature, so these joins are ten-row joins.
    """
    f = filt.select("feature", "ordinal", F.col("anova_rank").alias("filter_rank"),
                    F.col(filter_vote).alias("_fv"))
    t = (f.join(rfe.select("feature", "rfe_selected"), "feature", "left")
         .join(dt.select("feature", "dt_rank"), "feature", "left")
         .join(rf.select("feature", "rf_rank"), "feature", "left"))
    votes = (F.coalesce(F.col("_fv"), F.lit(False)).cast("int")
             + F.coalesce(F.col("rfe_selected"), F.lit(False)).cast("int")
             + (F.coalesce(F.col("dt_rank"), F.lit(99)) <= top_k).cast("int")
             + (F.coalesce(F.col("rf_rank"), F.lit(99)) <= top_k).cast("int"))
    return t.select(
        "feature", "ordinal", F.coalesce("filter_rank", F.lit(99)).alias("filter_rank"),
        F.coalesce("rfe_selected", F.lit(False)).alias("rfe_selected"),
        F.coalesce("dt_rank", F.lit(99)).alias("dt_rank"), F.coalesce("rf_rank", F.lit(99)).alias("rf_rank"),
        votes.alias("methods_agreeing"),
        F.when(votes >= 3, F.lit("Keep")).when(votes == 2, F.lit("Optional")).otherwise(F.lit("Drop")).alias("decision"))


def select_features(fx: DataFrame, cols=FEATURE_COLUMNS, label: str = "churn", filter_on: str = "all",
                    filter_vote: str = "anova_top") -> dict[str, DataFrame]:
    """Split, filters (on all rows by default), RFE / tree / forest on the training rows, vote table."""
    split = stratified_split(fx, label)
    train = split.where(~F.col("is_test"))
    # the four methods are independent: submit them together
    jobs = [lambda: materialize(filter_method(fx if filter_on == "all" else train, cols, label), "filter-table"),
            lambda: rfe_ranking(train, cols, RFE_KEEP, label),
            lambda: dt_importance(train, cols, label),
            lambda: rf_importance(train, cols, label)]
    filt, rfe, dt, rf = _concurrently(lambda f: f(), jobs)
    return {"filter": filt, "rfe": rfe, "dt": dt, "rf": rf, "split": split,
            "table": comparison_table(filt, rfe, dt, rf, filter_vote)}


def keep_list(table: DataFrame) -> list[str]:
    """Features marked Keep, in contract order (ten rows at most reach the driver)."""
    return [r["feature"] for r in table.where(F.col("decision") == "Keep").orderBy("ordinal").collect()]


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``prediction`` (int) and ``churn_probability`` (class-1 probability)."""
    out = model.transform(df)
    added = [c for s in model.stages if isinstance(s, Bucketizer) for c in s.getOutputCols()]
    return (out.withColumn("churn_probability", vector_to_array("probability")[1])
            .withColumn("prediction", F.col("prediction").cast("int"))
            .drop("features_vec", "rawPrediction", "probability", *added))


def _fits_at_once(n: int) -> int:
    """How many forests on tables of ``n`` rows are fitted concurrently: large ones keep all cores busy alone."""
    return max(1, min(PARALLEL_FITS, FITTED_ROWS // max(n, 1)))


def _fold_metrics(binned: Binned, folds: int, seed: int, trees: int, max_depth: int, also=()) -> tuple:
    """Averages over the folds of the metrics of one forest per fold, and the results of ``also``: functions
    without arguments that run in the same pool."""
    spark = binned.table.sparkSession

    def one(k):
        model = binned.fit(binned.weighted(F.col("fold") != k, lambda r: r["fold"] != k), seed, trees, max_depth)
        m = P.binary_metrics(binned.predict(model, F.col("fold") == k), binned.label, "prediction").first()
        return (k, m["accuracy"], m["precision"], m["recall"], m["f1"])

    jobs = [*also, *[lambda k=k: one(k) for k in range(folds)]]
    done = _concurrently(lambda f: f(), jobs, _fits_at_once(binned.n))
    results, rows = done[:len(also)], done[len(also):]
    per_fold = spark.createDataFrame(rows, "fold int, accuracy double, precision double, recall double, f1 double")
    return per_fold.agg(F.avg("accuracy").alias("cv_accuracy"), F.avg("precision").alias("cv_precision"),
                        F.avg("recall").alias("cv_recall"), F.avg("f1").alias("cv_f1")), results


def cv_metrics(fx: DataFrame, cols=FINAL_FEATURES, label: str = "churn", folds: int = FOLDS,
               seed: int = SEED, trees: int = RF_TREES, max_depth: int = RF_MAX_DEPTH) -> DataFrame:
    """Stratified k-fold accuracy / precision / recall / F1 (class 1), averaged over folds.

    Features are binned once for all folds.  One forest per fold; all four metrics come from that fold's
    confusion aggregate (the reference refits the same folds once per metric).
    """
    data = kfold_assignment(fx.select("username", label, *cols), folds, seed=seed, label=label)
    return _fold_metrics(Binned(data, cols, label, ["fold"]), folds, seed, trees, max_depth)[0]


def _concurrently(fn, items, at_once: int = PARALLEL_FITS):
    """Run independent fits from driver threads; Spark interleaves their jobs."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(items)))) as ex:
        return list(ex.map(fn, items))


def train_and_save(fx: DataFrame, selected=None, label: str = "churn", model_path: str | None = None,
                   seed: int = SEED, trees: int = RF_TREES, max_depth: int = RF_MAX_DEPTH, cv: bool = False,
                   store: Artefacts | None = None) -> dict:
    """Final forest on the stratified 80 %, hold-out metrics and report, optional save; with ``cv`` also
    the cross-validation figures of the same forest (``cv_metrics``, one row), on the same bins.

    ``model_path`` is written in place; with ``store`` the model is published as a part of its next version."""
    selected = list(selected or FINAL_FEATURES)
    require_columns(fx, selected, "selected features")
    split, marks = stratified_split(fx.select("username", label, *selected), label), ["is_test"]
    if cv:
        split, marks = kfold_assignment(split, FOLDS, seed=seed, label=label), ["is_test", "fold"]
    binned = Binned(split, selected, label, marks, keep=["username"])
    fit = lambda: binned.fit(binned.weighted(~F.col("is_test"), lambda r: not r["is_test"]), seed, trees, max_depth)
    # the final fit and the fold fits are independent: one bounded pool for all
    folds, (model,) = _fold_metrics(binned, FOLDS, seed, trees, max_depth, [fit]) if cv else (None, (fit(),))
    scored = binned.predict(model, F.col("is_test"))
    if model_path:
        model.write().overwrite().save(model_path)
    if store:
        store.publish({"model": lambda path: model.write().save(path)}, {"selected_features": selected})
    return {"model": model, "selected_features": selected,
            "metrics": P.binary_metrics(scored, label, "prediction"),
            "report": P.classification_report(scored, label, "prediction"),
            "test_predictions": scored,
            **({"cv_metrics": folds} if cv else {})}


def model_inputs(model: PipelineModel) -> list[str]:
    """Feature columns the fitted pipeline expects, in its order."""
    return list(model.stages[0].getInputCols())


def request_schema(model: PipelineModel):
    from pyspark.sql import types as T
    return T.StructType([T.StructField("request_id", T.StringType())] +
                        [T.StructField(c, T.DoubleType()) for c in model_inputs(model)])


def load_model(path: str, spark: SparkSession | None = None) -> PipelineModel:
    """A saved model from any file system (a path without a scheme lies on the session's default one), or the
    current model of a folder of versioned artefacts."""
    spark = spark or SparkSession.active()
    published = Artefacts(spark, path).current() if path else None
    if published and "model" in published.parts:
        path = published.parts["model"]
    if not path or not path_exists(spark, path):
        raise FileNotFoundError(f"no saved model at {path!r}; train and save one first")
    return PipelineModel.load(path)


def score_users(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring: class, churn probability (3 dp, half-even) and risk tier (unrounded p)."""
    out = predict(model, df)
    return out.select(*[c for c in df.columns],
                      (F.col("prediction") == 1).alias("churned"),
                      F.bround("churn_probability", 3).alias("churn_probability"),
                      risk_level("churn_probability").alias("risk_level"))


def model_comparison(fx: DataFrame, network: DataFrame | None = None, selected=None, label: str = "churn",
                     seed: int = SEED, trees: int = RF_TREES, max_depth: int = RF_MAX_DEPTH) -> DataFrame:
    """Hold-out F1 and CV F1 of the forest on three inputs: the selected
    features, PCA components reaching 90 % variance (fitted on each split's
    training rows), and all features plus the three network centralities."""
    from churnlens.operators.latent import fit_pca, pca_project
    spark = fx.sparkSession
    selected = list(selected or FINAL_FEATURES)

    def f1_of(binned, test, chosen):
        m = binned.fit(binned.weighted(~test, lambda r: not chosen(r)), seed, trees, max_depth)
        return P.binary_metrics(binned.predict(m, test), label, "prediction").first()["f1"]

    def fits(data, cols):
        """The hold-out fit and the fold fits of one set, as functions without arguments."""
        once = Binned(data, cols, label, parts) if cols else None

        def fit(task):
            test = F.col("is_test") if task == "holdout" else F.col("fold") == task
            binned = once
            if binned is None:  # components are fitted on this split's training rows alone
                pfit = fit_pca(data.where(~test))
                names = [f"pc{j + 1}" for j in range(pfit.n_for())]
                binned = Binned(pca_project(data, pfit, len(names), keep=("username", label, *parts)), names, label, parts)
            chosen = (lambda r: r["is_test"]) if task == "holdout" else (lambda r: r["fold"] == task)
            return len(binned.cols), f1_of(binned, test, chosen)

        return [lambda task=task: fit(task) for task in ["holdout", *range(FOLDS)]]

    # one table with everything, written once: features, centralities, split and folds
    parts, net_cols = ("is_test", "fold"), ["degree_centrality", "betweenness_centrality", "pagerank"]
    data = fx if network is None else fx.join(network.select("username", *net_cols), "username")
    data = materialize(kfold_assignment(stratified_split(data, label), FOLDS, seed=seed, label=label), "comparison")
    sets = {"selected": selected, "pca": None}
    if network is not None:
        sets["all_plus_network"] = list(FEATURE_COLUMNS) + net_cols
    # all fits of all sets are independent: one bounded pool
    jobs = [job for cols in sets.values() for job in fits(data, cols)]
    done = _concurrently(lambda f: f(), jobs, _fits_at_once(data.count()))
    rows = []
    for i, name in enumerate(sets):
        res = done[i * (FOLDS + 1):(i + 1) * (FOLDS + 1)]
        rows.append((name, res[0][0], float(res[0][1]), float(sum(f1 for _, f1 in res[1:]) / FOLDS)))
    return spark.createDataFrame(rows, "feature_set string, n_features int, holdout_f1 double, cv_f1 double")


def extended_importance(fx: DataFrame, network: DataFrame, label: str = "churn") -> DataFrame:
    """Forest importances over the ten features plus three centralities (training rows)."""
    net_cols = ["degree_centrality", "betweenness_centrality", "pagerank"]
    ext = materialize(fx.join(network.select("username", *net_cols), "username"), "extended")
    train = stratified_split(ext, label).where(~F.col("is_test"))
    cols = list(FEATURE_COLUMNS) + net_cols
    return rf_importance(train, cols, label).withColumn("is_network", F.col("feature").isin(net_cols))
