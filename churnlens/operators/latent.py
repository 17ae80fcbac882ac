"""PCA, truncated SVD, latent coordinates and gap recommendations (PCA1-3, REC1-4, WIN2, WIN4, WIN7).

Both decompositions need the triangular factor R of the matrix X = QR (d×d, d = number of
features, 10): every task factors its rows, and factors are merged pairwise in a tree, stacked
and factored again.  R has the singular values and right singular vectors of X to full
precision, which the Gram matrix XᵀX halves.  The last factor's SVD runs on the driver (size
independent of the user count); projections and reconstructions are then
linear column expressions evaluated per row, so no user data is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.scalars import percent_text
from churnlens.operators.sampling import apply_minmax, apply_standard, fit_minmax, fit_standard
from churnlens.schemas import FEATURE_COLUMNS
from churnlens.session import materialize

LATENT_FACTORS = 5
PCA_TARGET = 0.90
GATE = 0.5

# What each feature measures and which way is better: "lower" or "higher".
MEASURES = {
    "follower_ratio": ("followers for every account followed", "higher"),
    "engagement_ratio": ("social links for every public repository", "higher"),
    "days_since_last_activity": ("days since the profile last changed", "lower"),
    "account_age_days": ("days since the account was made", "higher"),
    "activity_frequency": ("public repositories for every year of membership", "higher"),
    "repos_per_year": ("public repositories for every year of membership", "higher"),
    "social_volume": ("followers, followed accounts and gists together", "higher"),
    "profile_completeness": ("how many of the four optional profile fields have text", "higher"),
    "has_no_repos": ("whether the account has no public repository", "lower"),
    "has_complete_profile": ("whether all four optional profile fields have text", "higher"),
}


def advice(feature: str) -> str:
    """One sentence of advice, made from what the feature measures."""
    what, better = MEASURES[feature]
    return f"{feature} counts {what}; a {better} value goes with staying, so bring it {'down' if better == 'lower' else 'up'}."


ADVICE = {f: advice(f) for f in MEASURES}
DEFAULT_ADVICE = "{feature} differs most from users who stay; move it their way."

# Response messages of the recommendation step.
MSG_NOT_AT_RISK = "User is not at risk. No intervention needed."
MSG_AT_RISK = "User is at risk ({pct}%). Top {n} re-engagement actions returned."


def _sign_fix(vecs: np.ndarray) -> np.ndarray:
    """Make the largest-magnitude entry of every column positive (the first of those that tie to nine digits)."""
    v = vecs.copy()
    for j in range(v.shape[1]):
        size = np.abs(v[:, j])
        i = int(np.argmax(size >= size.max() - 1e-9))
        if v[i, j] < 0:
            v[:, j] = -v[:, j]
    return v


#: Factors that one task of the tree merges.
MERGED_FACTORS = 64


def r_factor(df: DataFrame, cols) -> np.ndarray:
    """The d×d triangular factor of the matrix of ``cols`` (doubles), by a tree of small factorisations."""
    cols, d = list(cols), len(cols)
    names = [f"r{i}" for i in range(d * d)]
    schema = "level int, " + ", ".join(f"{n} double" for n in names)

    def merged(r, rows):
        return np.linalg.qr(np.vstack([r, rows]), mode="r")

    def batch_of(level, r):
        full = np.zeros((d, d))
        full[:len(r)] = r
        return pa.RecordBatch.from_arrays([pa.array([level], pa.int32()), *[pa.array([v]) for v in full.ravel()]],
                                          names=["level", *names])

    def leaf(batches):
        r = np.zeros((0, d))
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy() for c in cols]) if batch.num_rows else np.zeros((0, d))
            for s in range(0, len(x), 65536):
                r = merged(r, x[s:s + 65536])
        yield batch_of(TaskContext.get().partitionId(), r)

    def join(table: pa.Table) -> pa.Table:
        x = np.column_stack([table.column(n).to_numpy() for n in names]).reshape(-1, d)
        return pa.Table.from_batches([batch_of(table.column("level")[0].as_py(), np.linalg.qr(x, mode="r"))])

    factors = df.select(*cols).mapInArrow(leaf, schema)
    seats = (F.col("level") % F.lit(MERGED_FACTORS)).cast("int")
    rows = factors.withColumn("level", seats).groupBy("level").applyInArrow(join, schema).collect()  # so many d×d factors at most
    if not rows:
        return np.zeros((d, d))
    return np.linalg.qr(np.array([r[1:] for r in sorted(rows)]).reshape(-1, d), mode="r")


# ------------------------------------------------------------------ PCA
@dataclass
class PcaFit:
    cols: list
    stats: dict            # column → (mean, std) of the standard scaler
    ratios: np.ndarray     # explained variance ratio per component, descending
    components: np.ndarray  # d × d, column k = loading vector of component k+1

    def n_for(self, target: float = PCA_TARGET) -> int:
        cum = np.cumsum(self.ratios)
        return int(np.argmax(cum >= target - 1e-12) + 1)


def fit_pca(df: DataFrame, cols=FEATURE_COLUMNS) -> PcaFit:
    """PCA of standardised columns = SVD of their matrix; its squared singular values are the variances (times n)."""
    cols = list(cols)
    dbl = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    stats = fit_standard(dbl, cols)
    _, sigma, vt = np.linalg.svd(r_factor(apply_standard(dbl, stats), cols))
    vals, vecs = sigma ** 2, vt.T
    total = vals.sum()
    ratios = vals / total if total > 0 else np.zeros_like(vals)
    return PcaFit(cols, stats, ratios, _sign_fix(vecs))


def pca_variance(spark: SparkSession, fit: PcaFit, target: float = PCA_TARGET) -> DataFrame:
    """Per component: variance ratio, cumulative ratio, and the count needed for ``target``."""
    cum = np.cumsum(fit.ratios)
    n = fit.n_for(target)
    rows = [(k + 1, float(fit.ratios[k]), float(cum[k]), n) for k in range(len(fit.ratios))]
    return spark.createDataFrame(rows, "component int, variance_ratio double, cumulative double, n_for_target int")


def pca_loadings(spark: SparkSession, fit: PcaFit, k: int | None = None) -> DataFrame:
    k = k or len(fit.cols)
    rows = [(c, i, *[float(fit.components[i, j]) for j in range(k)]) for i, c in enumerate(fit.cols)]
    schema = "feature string, ordinal int, " + ", ".join(f"pc{j + 1} double" for j in range(k))
    return spark.createDataFrame(rows, schema)


def pca_project(df: DataFrame, fit: PcaFit, k: int, keep=("username",)) -> DataFrame:
    """Scores on the first k components as linear column expressions."""
    z = {c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in fit.stats.items()}
    out = [F.col(x) for x in keep if x in df.columns]
    for j in range(k):
        e = F.lit(0.0)
        for i, c in enumerate(fit.cols):
            e = e + z[c] * F.lit(float(fit.components[i, j]))
        out.append(e.alias(f"pc{j + 1}"))
    return df.select(*out)


# ------------------------------------------------------------------ truncated SVD
@dataclass
class SvdFit:
    cols: list
    bounds: dict          # column → (min, max) of the min-max scaler
    sigma: np.ndarray     # kept singular values, descending
    v: np.ndarray         # d × k right singular vectors (sign-fixed)
    trace: float          # Σ σ² over all d values (= ‖X‖²_F)


def fit_svd(df: DataFrame, cols=FEATURE_COLUMNS, k: int = LATENT_FACTORS) -> SvdFit:
    """Rank-k SVD of the min-max scaled matrix (not centred)."""
    cols = list(cols)
    dbl = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    bounds = fit_minmax(dbl, cols)
    _, sigma, vt = np.linalg.svd(r_factor(apply_minmax(dbl, bounds), cols))
    return SvdFit(cols, bounds, sigma[:k], _sign_fix(vt.T[:, :k]), float((sigma ** 2).sum()))


def _scaled_exprs(fit: SvdFit) -> list:
    out = []
    for c in fit.cols:
        lo, hi = fit.bounds[c]
        rng = (hi - lo) if (hi is not None and lo is not None and hi > lo) else 1.0
        out.append((F.col(c).cast("double") - F.lit(lo)) / F.lit(rng))
    return out


def svd_reconstruct(df: DataFrame, fit: SvdFit, keep=("username",), more=()) -> DataFrame:
    """The ``keep`` columns and ``more`` expressions with ``scaled`` and ``reconstructed`` arrays (x and x·V·Vᵀ)."""
    xs = _scaled_exprs(fit)
    proj = fit.v @ fit.v.T
    rec = []
    for j in range(len(fit.cols)):
        e = F.lit(0.0)
        for i in range(len(fit.cols)):
            if proj[i, j] != 0.0:
                e = e + xs[i] * F.lit(float(proj[i, j]))
        rec.append(e)
    out = [F.col(x) for x in keep if x in df.columns] + list(more)
    return df.select(*out, F.array(*xs).alias("scaled"), F.array(*rec).alias("reconstructed"))


def svd_coordinates(df: DataFrame, fit: SvdFit, factors: int = 2, keep=("username", "churn")) -> DataFrame:
    """Users' latent coordinates u_k = x·v_k / σ_k on the leading factors."""
    xs = _scaled_exprs(fit)
    out = [F.col(x) for x in keep if x in df.columns]
    for j in range(factors):
        e = F.lit(0.0)
        for i in range(len(fit.cols)):
            e = e + xs[i] * F.lit(float(fit.v[i, j]))
        s = float(fit.sigma[j]) if fit.sigma[j] > 0 else 1.0
        out.append((e / F.lit(s)).alias(f"factor{j + 1}"))
    return df.select(*out)


def svd_variance(spark: SparkSession, fit: SvdFit) -> DataFrame:
    """Per kept factor: σ, share of the kept σ² (the reference's figure) and of the whole ‖X‖²."""
    s2 = fit.sigma ** 2
    kept = s2.sum()
    cum = np.cumsum(s2 / kept) if kept > 0 else np.zeros_like(s2)
    rows = [(j + 1, float(fit.sigma[j]), float(s2[j] / kept) if kept > 0 else 0.0, float(cum[j]),
             float(s2[j] / fit.trace) if fit.trace > 0 else 0.0) for j in range(len(s2))]
    return spark.createDataFrame(
        rows, "factor int, singular_value double, share_of_kept double, cumulative_kept double, share_of_total double")


# ------------------------------------------------------------------ recommendations
def advice_expr(feature_col) -> F.Column:
    m = F.create_map(*[x for k, v in ADVICE.items() for x in (F.lit(k), F.lit(v))])
    head, tail = DEFAULT_ADVICE.split("{feature}")
    return F.coalesce(m[feature_col], F.concat(F.lit(head), feature_col, F.lit(tail)))


def top_gaps(cols, top_n, actual="scaled", rec="reconstructed", positive_only: bool = False) -> F.Column:
    """Top-n (feature, gap, advice) by gap = reconstructed − actual, descending.

    Ties put the later feature first.  The ten gaps live in the row, so this
    is an array sort, not a shuffle.
    """
    items = F.array(*[F.struct((F.col(rec)[i] - F.col(actual)[i]).alias("gap"), F.lit(i).alias("ordinal"),
                               F.lit(c).alias("feature")) for i, c in enumerate(cols)])
    if positive_only:
        items = F.filter(items, lambda s: s["gap"] > 0)
    ranked = F.slice(F.sort_array(items, asc=False), 1, top_n)
    return F.transform(ranked, lambda s: F.struct(s["feature"].alias("feature"),
                                                   F.bround(s["gap"], 4).alias("gap_score"),
                                                   advice_expr(s["feature"]).alias("action")))


def user_index(df: DataFrame, key: str = "username", name: str = "user_id") -> DataFrame:
    """Contiguous 0-based index in key order, computed JVM-side.

    Range-partition by key and sort inside partitions; a row's index is the
    number of rows in earlier partitions plus its position in its own.  The
    offsets table has one row per partition (bounded by the partition count),
    and the ordered frame is written once so both passes read the same values.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    o = materialize(df.repartitionByRange(parts, key).sortWithinPartitions(key)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()), "user-index")
    stats = sorted((r["_pid"], r["n"], r["m"]) for r in
                   o.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"), F.min("_mid").alias("m")).collect())
    rows, acc = [], 0
    for pid, n, m in stats:
        rows.append((pid, acc - m))
        acc += n
    offs = spark.createDataFrame(rows, "_pid int, _shift long")
    return (o.join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_mid") + F.col("_shift")).drop("_pid", "_mid", "_shift"))


def advise(rows: DataFrame, cols=FEATURE_COLUMNS, top_n: int | F.Column = 5, gate: float = GATE,
           positive_only: bool = False) -> DataFrame:
    """Per row (user_id, username, churn_probability, scaled, reconstructed): probability, at-risk flag and
    — only when at risk — the top-n gap advice.  One projection."""
    n = top_n if isinstance(top_n, F.Column) else F.lit(int(top_n))
    at_risk = F.col("churn_probability") >= F.lit(gate)
    empty = F.array().cast("array<struct<feature:string,gap_score:double,action:string>>")
    head, rest = MSG_AT_RISK.split("{pct}")
    mid, tail = rest.split("{n}")
    msg_risk = F.concat(F.lit(head), percent_text("churn_probability", with_sign=False),
                        F.lit(mid), n.cast("string"), F.lit(tail))
    return rows.select(
        "user_id", "username", F.bround("churn_probability", 3).alias("churn_probability"),
        at_risk.alias("at_risk"),
        F.when(at_risk, top_gaps(cols, n, positive_only=positive_only)).otherwise(empty).alias("recommendations"),
        F.when(at_risk, msg_risk).otherwise(F.lit(MSG_NOT_AT_RISK)).alias("message"))


def recommend(users: DataFrame, scores: DataFrame, latent: DataFrame, cols=FEATURE_COLUMNS,
              top_n: int | F.Column = 5, gate: float = GATE, positive_only: bool = False) -> DataFrame:
    """``advise`` over saved tables: ``users`` (username, user_id), ``scores`` (username, churn_probability) and
    ``latent`` (username, scaled, reconstructed), joined on username."""
    j = users.join(scores.select("username", "churn_probability"), "username").join(latent, "username")
    return advise(j, cols, top_n, gate, positive_only)


def recommend_users(fx: DataFrame, model, fit: SvdFit, cols=FEATURE_COLUMNS, top_n: int | F.Column = 5,
                    gate: float = GATE, positive_only: bool = False, scaled_scoring: bool = False) -> DataFrame:
    """Advice for every row of the feature table: score, latent arrays and gaps come from the same row, so the
    only shuffle is the range partitioning of the user index.

    ``scaled_scoring`` feeds the model min-max scaled inputs, as the service path does although
    the model is trained on raw values."""
    from churnlens.operators.models import model_inputs, predict
    inputs = model_inputs(model)
    scaled = dict(zip(fit.cols, _scaled_exprs(fit)))
    rows = svd_reconstruct(fx, fit, keep=("username", *inputs)) if not scaled_scoring else svd_reconstruct(
        fx, fit, keep=("username",), more=[scaled[c].alias(c) for c in inputs])
    scored = predict(model, rows).select("username", "churn_probability", "scaled", "reconstructed")
    return advise(user_index(scored), cols, top_n, gate, positive_only)
