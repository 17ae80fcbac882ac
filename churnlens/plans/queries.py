"""Registered queries.  Each takes (spark, sf_dir) and returns a DataFrame that
reads the driver tables at ``sf_dir`` in full."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlens.operators import labels as L
from churnlens.operators.features import generate_features
from churnlens.plans.registry import register, round_doubles
from churnlens.plans.sql_parts import features_sql, raw_users_sql, rounded, FEATURE_NAMES, DOUBLE_FEATURES
from churnlens.sources.demo import AS_OF, demo_profiles, demo_repos, load_tables


def base_frames(spark: SparkSession, sf_dir: str):
    t = load_tables(spark, sf_dir)
    return t, demo_profiles(spark, sf_dir, t), demo_repos(spark, sf_dir, t)


def raw_frame(spark, sf_dir, threshold=365):
    _, profiles, repos = base_frames(spark, sf_dir)
    return L.raw_users(profiles, repos, AS_OF, threshold)


def feature_frame(spark, sf_dir, threshold=365, raw=None):
    return generate_features(raw if raw is not None else raw_frame(spark, sf_dir, threshold), AS_OF)


def shared_raw(spark, sf_dir, threshold=365):
    """The raw-user table written once, for queries that read it more than once
    (the lineitem ⋈ orders build then runs a single time)."""
    from churnlens.session import materialize
    return materialize(raw_frame(spark, sf_dir, threshold), "raw-users")


@register("raw_users", sql=f"WITH {raw_users_sql()} SELECT * FROM raw_users")
def q_raw_users(spark, sf_dir) -> DataFrame:
    return raw_frame(spark, sf_dir)


@register("features", sql=f"""WITH {features_sql()}
SELECT username, {rounded(DOUBLE_FEATURES)}, has_no_repos, has_complete_profile, churn FROM features""")
def q_features(spark, sf_dir) -> DataFrame:
    return round_doubles(feature_frame(spark, sf_dir))


# ---------------------------------------------------------------- profiling
from pyspark.sql import functions as F  # noqa: E402

from churnlens.operators import profile as P  # noqa: E402
from churnlens.operators.features import raw_feature_frame  # noqa: E402
from churnlens.plans.sql_parts import (  # noqa: E402
    RAW_COLUMNS, RAW_NUMERIC, RAW_TYPES, describe_sql, histogram_sql,
)
from churnlens.schemas import FEATURE_COLUMNS  # noqa: E402


@register("churn_ratio", sql=f"""WITH {raw_users_sql()}
SELECT round(coalesce(avg(CAST(churn AS DOUBLE)), 0.0), 6) AS churn_ratio FROM raw_users""")
def q_churn_ratio(spark, sf_dir):
    return round_doubles(L.churn_ratio(raw_frame(spark, sf_dir)))


@register("label_summary", sql=f"""WITH {raw_users_sql()},
s AS (SELECT count(*) AS total, CAST(coalesce(sum(churn), 0) AS BIGINT) AS churned FROM raw_users)
SELECT total, churned, total - churned AS retained,
       round(CASE WHEN total > 0 THEN churned / total ELSE 0.0 END, 6) AS churned_share,
       round(CASE WHEN total > 0 THEN (total - churned) / total ELSE 0.0 END, 6) AS retained_share,
       (CASE WHEN total > 0 THEN churned / total ELSE 0.0 END) >= 0.1 AS passed
FROM s""")
def q_label_summary(spark, sf_dir):
    return round_doubles(L.label_summary(raw_frame(spark, sf_dir), 0.10))


@register("label_distribution", sql=f"""WITH {raw_users_sql()}
SELECT churn, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM raw_users GROUP BY churn""")
def q_label_distribution(spark, sf_dir):
    return round_doubles(L.label_distribution(raw_frame(spark, sf_dir)))


_NULL_PARTS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL) AS null_count, count(*) AS n FROM raw_users"
    for c in RAW_COLUMNS)


@register("null_profile", sql=f"""WITH {raw_users_sql()}, np AS ({_NULL_PARTS})
SELECT field, null_count, round(CASE WHEN n > 0 THEN null_count * 100.0 / n ELSE 0.0 END, 6) AS null_pct
FROM np WHERE null_count > 0""")
def q_null_profile(spark, sf_dir):
    return round_doubles(P.null_profile(raw_frame(spark, sf_dir)))


_COLPROF = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS field, '{RAW_TYPES[c]}' AS dtype, count({c}) AS non_null FROM raw_users" for c in RAW_COLUMNS)


@register("column_profile", sql=f"WITH {raw_users_sql()} {_COLPROF}")
def q_column_profile(spark, sf_dir):
    return P.column_profile(raw_frame(spark, sf_dir))


@register("describe_raw", sql=f"WITH {raw_users_sql()} {describe_sql('raw_users', RAW_NUMERIC)}")
def q_describe_raw(spark, sf_dir):
    from churnlens.session import materialize
    return round_doubles(P.describe(materialize(raw_frame(spark, sf_dir).select(*RAW_NUMERIC), "raw-numbers"), RAW_NUMERIC))


@register("describe_features", sql=f"WITH {features_sql()} {describe_sql('features', FEATURE_NAMES)}")
def q_describe_features(spark, sf_dir):
    return round_doubles(P.describe(feature_frame(spark, sf_dir), FEATURE_COLUMNS))


_MEANS = "\nUNION ALL\n".join(
    f"SELECT churn, '{c}' AS feature, round(avg({c}), 6) AS mean FROM features GROUP BY churn" for c in FEATURE_NAMES)


@register("feature_means_by_label", sql=f"WITH {features_sql()} {_MEANS}")
def q_feature_means_by_label(spark, sf_dir):
    return round_doubles(P.means_by_label(feature_frame(spark, sf_dir), FEATURE_COLUMNS))


_HIST_RAW = ["public_repos", "followers", "following", "days_since_update", "days_since_last_push", "public_gists"]


@register("histogram_raw", sql=f"WITH {raw_users_sql()}, {histogram_sql('raw_users', _HIST_RAW)}")
def q_histogram_raw(spark, sf_dir):
    from churnlens.session import materialize
    return round_doubles(P.histogram(materialize(raw_frame(spark, sf_dir).select(*_HIST_RAW), "raw-numbers"), _HIST_RAW, 40))


@register("inactivity_histogram_by_label",
          sql=f"WITH {raw_users_sql()}, {histogram_sql('raw_users', ['days_since_last_push'], by='churn')}")
def q_inactivity_histogram(spark, sf_dir):
    from churnlens.session import materialize
    raw = materialize(raw_frame(spark, sf_dir).select("churn", "days_since_last_push"), "raw-numbers")
    return round_doubles(P.histogram(raw, ["days_since_last_push"], 40, by="churn"))


_HEALTH = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, (SELECT count(*) FILTER (WHERE {c} IS NULL) FROM f0) AS missing_before_fill, "
    f"(SELECT count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) FROM features) AS nan_after, "
    f"(SELECT count(*) FILTER (WHERE isinf({c})) FROM features) AS inf_after"
    for c in FEATURE_NAMES)


@register("matrix_health", sql=f"WITH {features_sql()} {_HEALTH}")
def q_matrix_health(spark, sf_dir):
    raw = shared_raw(spark, sf_dir)
    pre = raw_feature_frame(raw, AS_OF)
    return P.matrix_health(pre, generate_features(raw, AS_OF), FEATURE_COLUMNS)


_SUMMARY = f"""ds AS ({describe_sql('features', FEATURE_NAMES)}), mh AS ({_HEALTH}),
ml AS ({_MEANS})
SELECT ds.field AS feature, ds.count, ds.mean, ds.std, ds.min, ds.p25, ds.p50, ds.p75, ds.max,
       mh.missing_before_fill, mh.nan_after, mh.inf_after,
       max(ml.mean) FILTER (WHERE churn = 0) AS mean_0, max(ml.mean) FILTER (WHERE churn = 1) AS mean_1
FROM ds JOIN mh ON mh.feature = ds.field JOIN ml ON ml.feature = ds.field GROUP BY ALL"""


@register("feature_summary", sql=f"WITH {features_sql()}, {_SUMMARY}")
def q_feature_summary(spark, sf_dir):
    raw = shared_raw(spark, sf_dir)
    return round_doubles(P.feature_summary(raw_feature_frame(raw, AS_OF), generate_features(raw, AS_OF), FEATURE_COLUMNS))


def _corr_long_sql(table_cte: str, cols) -> str:
    """CTEs ``cm`` (moments) and ``cl`` (a, b, ia, ib, r unrounded)."""
    aggs = []
    for i, a in enumerate(cols):
        aggs.append(f"stddev_pop({a}) AS s_{i}")
        for j in range(i, len(cols)):
            aggs.append(f"covar_pop({a}, {cols[j]}) AS c_{i}_{j}")
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS ia, {j} AS ib, "
                         f"(CASE WHEN s_{i} * s_{j} > 0 THEN c_{lo}_{hi} / (s_{i} * s_{j}) END) AS r FROM cm")
    return (f"cm AS (SELECT {', '.join(aggs)} FROM {table_cte}),\ncl AS (" + "\nUNION ALL\n".join(parts) + ")")


def _corr_sql(table_cte: str, cols) -> str:
    aggs = []
    for i, a in enumerate(cols):
        aggs.append(f"stddev_pop({a}) AS s_{i}")
        for j in range(i, len(cols)):
            aggs.append(f"covar_pop({a}, {cols[j]}) AS c_{i}_{j}")
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            r = f"(CASE WHEN s_{i} * s_{j} > 0 THEN c_{lo}_{hi} / (s_{i} * s_{j}) END)"
            parts.append(f"SELECT '{a}' AS a, '{b}' AS b, {i} AS ia, {j} AS ib, round({r}, 6) AS r, "
                         f"round(abs({r}), 6) AS abs_r FROM cm")
    return f"cm AS (SELECT {', '.join(aggs)} FROM {table_cte})\n" + "\nUNION ALL\n".join(parts)


@register("correlation_matrix", sql=f"WITH {features_sql()}, {_corr_sql('features', FEATURE_NAMES)}")
def q_correlation_matrix(spark, sf_dir):
    return round_doubles(P.correlation_matrix(feature_frame(spark, sf_dir), FEATURE_COLUMNS))


# A transparent rule stands in for a model where SQL has to reproduce the prediction.
_RULE = "days_since_last_activity > 365"


def _rule_frame(spark, sf_dir):
    return feature_frame(spark, sf_dir).withColumn("prediction", F.expr(_RULE).cast("int"))


@register("binary_metrics", sql=f"""WITH {features_sql()},
c AS (SELECT count(*) FILTER (WHERE churn = 1 AND {_RULE}) AS tp, count(*) FILTER (WHERE churn = 0 AND {_RULE}) AS fp,
             count(*) FILTER (WHERE churn = 0 AND NOT ({_RULE})) AS tn, count(*) FILTER (WHERE churn = 1 AND NOT ({_RULE})) AS fn
      FROM features)
SELECT tp, fp, tn, fn,
       round(CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / (tp + fp + tn + fn) ELSE 0.0 END, 6) AS accuracy,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END, 6) AS precision,
       round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END, 6) AS recall,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END, 6) AS f1
FROM c""")
def q_binary_metrics(spark, sf_dir):
    return round_doubles(P.binary_metrics(_rule_frame(spark, sf_dir)))


def _div(a, b):
    return f"(CASE WHEN ({b}) > 0 THEN ({a}) / ({b}) ELSE 0.0 END)"


_P1, _R1, _P0, _R0 = _div("tp", "tp + fp"), _div("tp", "tp + fn"), _div("tn", "tn + fn"), _div("tn", "tn + fp")
_F1, _F0 = _div("2 * tp", "2 * tp + fp + fn"), _div("2 * tn", "2 * tn + fn + fp")
_N = "(tp + fp + tn + fn)"


@register("classification_report", sql=f"""WITH {features_sql()},
c AS (SELECT CAST(count(*) FILTER (WHERE churn = 1 AND {_RULE}) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE churn = 0 AND {_RULE}) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE churn = 0 AND NOT ({_RULE})) AS DOUBLE) AS tn,
             CAST(count(*) FILTER (WHERE churn = 1 AND NOT ({_RULE})) AS DOUBLE) AS fn FROM features)
SELECT 'Retained' AS class, round({_P0}, 6) AS precision, round({_R0}, 6) AS recall, round({_F0}, 6) AS f1,
       CAST(tn + fp AS BIGINT) AS support FROM c
UNION ALL SELECT 'Churned', round({_P1}, 6), round({_R1}, 6), round({_F1}, 6), CAST(tp + fn AS BIGINT) FROM c
UNION ALL SELECT 'accuracy', NULL, NULL, round({_div("tp + tn", _N)}, 6), CAST({_N} AS BIGINT) FROM c
UNION ALL SELECT 'macro avg', round(({_P0} + {_P1}) / 2, 6), round(({_R0} + {_R1}) / 2, 6),
       round(({_F0} + {_F1}) / 2, 6), CAST({_N} AS BIGINT) FROM c
UNION ALL SELECT 'weighted avg', round({_div(f"{_P0} * (tn + fp) + {_P1} * (tp + fn)", _N)}, 6),
       round({_div(f"{_R0} * (tn + fp) + {_R1} * (tp + fn)", _N)}, 6),
       round({_div(f"{_F0} * (tn + fp) + {_F1} * (tp + fn)", _N)}, 6), CAST({_N} AS BIGINT) FROM c""")
def q_classification_report(spark, sf_dir):
    return round_doubles(P.classification_report(_rule_frame(spark, sf_dir)))


# ---------------------------------------------------------------- ingestion and balance
from churnlens.functions.scalars import iso_string  # noqa: E402
from churnlens.operators import ingest as I  # noqa: E402
from churnlens.plans.sql_parts import PROFILES, balance_sql, cohort_sql, collected_sql, days_sql  # noqa: E402


@register("user_accounts", sql=f"WITH {PROFILES} SELECT * FROM profiles WHERE type = 'User'")
def q_user_accounts(spark, sf_dir):
    _, profiles, _ = base_frames(spark, sf_dir)
    return L.user_accounts(profiles)


@register("cohort_active_lang", sql=f"WITH {PROFILES} SELECT login FROM profiles WHERE {cohort_sql(I.DEFAULT_COHORTS[0])}")
def q_cohort_active_lang(spark, sf_dir):
    _, profiles, repos = base_frames(spark, sf_dir)
    return I.cohort_members(profiles, repos, I.DEFAULT_COHORTS[0]).select("login")


@register("cohort_old_accounts", sql=f"WITH {PROFILES} SELECT login FROM profiles WHERE {cohort_sql(I.DEFAULT_COHORTS[2])}")
def q_cohort_old_accounts(spark, sf_dir):
    _, profiles, repos = base_frames(spark, sf_dir)
    return I.cohort_members(profiles, repos, I.DEFAULT_COHORTS[2]).select("login")


@register("candidate_users", sql=f"WITH {collected_sql(I.DEFAULT_COHORTS)} SELECT username FROM cand")
def q_candidate_users(spark, sf_dir):
    _, profiles, repos = base_frames(spark, sf_dir)
    return I.candidate_users(profiles, repos)


@register("recent_repos", sql=f"""WITH {PROFILES}
SELECT * FROM (
  SELECT owner, pushed_at, language,
         CAST(row_number() OVER (PARTITION BY owner ORDER BY try_cast(pushed_at AS TIMESTAMP) DESC NULLS LAST,
                                 pushed_at DESC NULLS LAST, language ASC NULLS LAST) AS INTEGER) AS recency_rank
  FROM repos) WHERE recency_rank <= 8""")
def q_recent_repos(spark, sf_dir):
    _, _, repos = base_frames(spark, sf_dir)
    """With a limit that owners of the driver tables exceed (the operator's default is 30)."""
    return I.recent_repos(repos, 8)


@register("last_push", sql=f"""WITH {PROFILES}
SELECT owner, strftime(max(try_cast(pushed_at AS TIMESTAMP)), '%Y-%m-%dT%H:%M:%SZ') AS last_pushed_at
FROM repos GROUP BY owner""")
def q_last_push(spark, sf_dir):
    _, _, repos = base_frames(spark, sf_dir)
    return L.last_push(repos).select("owner", iso_string("last_pushed_at").alias("last_pushed_at"))


@register("fresh_candidates", sql=f"""WITH {collected_sql(I.DEFAULT_COHORTS)}
SELECT login AS username FROM profiles WHERE {cohort_sql(I.INACTIVE_COHORTS[2])}
  AND login NOT IN (SELECT username FROM cand)""")
def q_fresh_candidates(spark, sf_dir):
    _, profiles, repos = base_frames(spark, sf_dir)
    inactive = I.cohort_members(profiles, None, I.INACTIVE_COHORTS[2]).select(F.col("login").alias("username"))
    return I.fresh_candidates(inactive, I.candidate_users(profiles, repos))


def _balanced(spark, sf_dir, min_ratio, cap=None):
    _, profiles, repos = base_frames(spark, sf_dir)
    collected = I.collect_dataset(profiles, repos, AS_OF)
    res = I.fix_low_churn_ratio(collected, profiles, AS_OF, 365, min_ratio, batch_cap=cap)
    return res.df.withColumn("balance_pass", F.lit(res.passes)).withColumn("threshold", F.lit(res.threshold))


for _name, _min in (("collect_dataset", 0.10), ("balance_pass1", 0.50), ("balance_pass2", 0.70)):
    register(_name, sql=f"WITH {balance_sql(I.DEFAULT_COHORTS, I.INACTIVE_COHORTS, _min)} SELECT * FROM final")(
        lambda spark, sf_dir, _m=_min: _balanced(spark, sf_dir, _m))


@register("balance_capped", sql=f"WITH {balance_sql(I.DEFAULT_COHORTS, I.INACTIVE_COHORTS, 0.70, cap=15)} SELECT * FROM final")
def q_balance_capped(spark, sf_dir):
    """At most 15 users of each inactivity cohort, as a collection under a quota takes them."""
    return _balanced(spark, sf_dir, 0.70, 15)


@register("collect_no_repos", sql=f"""WITH {raw_users_sql(repos=False)},
cand AS ({" UNION ".join(f"SELECT login AS username FROM profiles WHERE {cohort_sql(c)}" for c in I.DEFAULT_COHORTS)})
SELECT * FROM raw_users WHERE username IN (SELECT username FROM cand)""")
def q_collect_no_repos(spark, sf_dir):
    _, profiles, repos = base_frames(spark, sf_dir)
    return I.collect_dataset(profiles, repos, AS_OF, fetch_repos=False)


@register("collect_target", sql=f"WITH {collected_sql(I.DEFAULT_COHORTS)} SELECT * FROM base ORDER BY username LIMIT 40")
def q_collect_target(spark, sf_dir):
    """Collection that ends at a target number of records, in login order."""
    _, profiles, repos = base_frames(spark, sf_dir)
    return I.collect_dataset(profiles, repos, AS_OF, target_records=40)


# ---------------------------------------------------------------- scalars and labels
@register("parse_timestamps", sql="""
WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
s AS (SELECT o_orderkey, CASE o_orderkey % 10 WHEN 0 THEN d || 'T12:30:05Z' WHEN 1 THEN d || ' 06:07:08' WHEN 2 THEN d
        WHEN 3 THEN '12:30' WHEN 4 THEN 'T12:30:00' WHEN 5 THEN substr(d, 1, 4) WHEN 6 THEN 'not a date' WHEN 7 THEN ''
        WHEN 8 THEN substr(d, 1, 4) || '-1-1' ELSE NULL END AS stamp FROM o)
SELECT o_orderkey, stamp, CASE WHEN regexp_matches(stamp, '^[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN
         strftime(try_cast(stamp AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') END AS parsed FROM s""")
def q_parse_timestamps(spark, sf_dir):
    """Date strings in good and bad shapes, made from the orders' dates."""
    from churnlens.functions.scalars import parse_ts
    d = F.date_format("o_orderdate", "yyyy-MM-dd")
    shapes = [F.concat(d, F.lit("T12:30:05Z")), F.concat(d, F.lit(" 06:07:08")), d, F.lit("12:30"), F.lit("T12:30:00"),
              F.substring(d, 1, 4), F.lit("not a date"), F.lit(""), F.concat(F.substring(d, 1, 4), F.lit("-1-1")),
              F.lit(None).cast("string")]
    orders = load_tables(spark, sf_dir, ["orders"])["orders"]
    stamp = F.array(*shapes)[(F.col("o_orderkey") % 10).cast("int")]
    return orders.select("o_orderkey", stamp.alias("stamp")).withColumn("parsed", iso_string(parse_ts("stamp")))


@register("account_age", sql=f"""WITH {raw_users_sql()}, a AS (
  SELECT username, {days_sql("try_cast(created_at AS TIMESTAMP)")} AS age_days FROM raw_users)
SELECT username, age_days, round(CASE WHEN age_days IS NOT NULL THEN greatest(CAST(age_days AS DOUBLE), 1.0) / 365.25 END, 6)
  AS age_years FROM a""")
def q_account_age(spark, sf_dir):
    from churnlens.functions.scalars import days_since, parse_ts, safe_years
    aged = raw_frame(spark, sf_dir).select("username", days_since(parse_ts("created_at"), AS_OF).alias("age_days"))
    return round_doubles(aged.withColumn("age_years", safe_years("age_days")))


@register("labels", sql=f"""WITH {raw_users_sql()}
SELECT username, t.threshold, CASE WHEN coalesce(days_since_last_push, days_since_update) > t.threshold THEN 1 ELSE 0 END AS churn
FROM raw_users, (VALUES (90), (365), (1500), (2300)) AS t(threshold)""")
def q_labels(spark, sf_dir):
    """The label at several thresholds, from the same day counts."""
    raw = raw_frame(spark, sf_dir).drop("churn")
    out = F.array(*[F.struct(F.lit(t).alias("threshold"), L.churn_label(t).alias("churn")) for t in (90, 365, 1500, 2300)])
    return raw.select("username", F.inline(out))


_SHARE = "least(1.0, greatest(0.0, days_since_last_activity / 3000.0))"


@register("risk_tiers", sql=f"""WITH {features_sql()}, s AS (SELECT username, {_SHARE} AS p FROM features)
SELECT username, round(p, 6) AS p, CASE WHEN p < 0.3 THEN 'LOW' WHEN p < 0.6 THEN 'MEDIUM' WHEN p < 0.8 THEN 'HIGH'
       ELSE 'CRITICAL' END AS risk FROM s""")
def q_risk_tiers(spark, sf_dir):
    """Tiers of a probability that is a plain function of the activity recency."""
    from churnlens.functions.scalars import risk_level
    p = feature_frame(spark, sf_dir).select("username", F.expr(_SHARE).alias("p"))
    return round_doubles(p.withColumn("risk", risk_level("p")))


# ---------------------------------------------------------------- filter selection, scaling, sampling
from churnlens.operators import sampling as S  # noqa: E402
from churnlens.operators import selection as SEL  # noqa: E402

_VAR = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {i} AS ordinal, var_pop({c}) AS variance FROM features" for i, c in enumerate(FEATURE_NAMES))
_G = (f"g AS (SELECT churn, count(*) AS n, " + ", ".join(f"avg({c}) AS m_{c}, var_pop({c}) AS v_{c}" for c in FEATURE_NAMES)
      + " FROM features GROUP BY churn)")
_AN = "\nUNION ALL\n".join(f"""SELECT '{c}' AS feature, {i} AS ordinal,
  CASE WHEN ssw > 0 AND k > 1 AND n_all > k THEN (ssb / (k - 1)) / (ssw / (n_all - k)) END AS f_score
FROM (SELECT sum(n) AS n_all, count(*) AS k, sum(n * (m - grand) * (m - grand)) AS ssb, sum(n * v) AS ssw
      FROM (SELECT n, m_{c} AS m, v_{c} AS v, (SELECT sum(n * m_{c}) / sum(n) FROM g) AS grand FROM g))"""
    for i, c in enumerate(FEATURE_NAMES))
_SEL_CTES = f"""{features_sql()},
vr AS ({_VAR}),
{_G},
an0 AS ({_AN}),
an AS (SELECT *, CAST(row_number() OVER (ORDER BY f_score DESC NULLS LAST, ordinal) AS INTEGER) AS anova_rank FROM an0),
{_corr_long_sql('features', FEATURE_NAMES)},
surv AS (SELECT feature FROM vr WHERE coalesce(variance > {SEL.VARIANCE_THRESHOLD}, false)),
pairs AS (
  SELECT cl.a, cl.b, abs(cl.r) AS abs_r, fa.f_score AS f_a, fb.f_score AS f_b,
         CASE WHEN fa.f_score < fb.f_score THEN cl.a ELSE cl.b END AS dropped
  FROM cl JOIN an fa ON fa.feature = cl.a JOIN an fb ON fb.feature = cl.b
  WHERE cl.ia < cl.ib AND abs(cl.r) > {SEL.CORR_THRESHOLD}
    AND cl.a IN (SELECT feature FROM surv) AND cl.b IN (SELECT feature FROM surv))"""


@register("variance_filter", sql=f"""WITH {features_sql()}, vr AS ({_VAR})
SELECT feature, ordinal, round(variance, 6) AS variance, coalesce(variance > {SEL.VARIANCE_THRESHOLD}, false) AS variance_kept
FROM vr""")
def q_variance_filter(spark, sf_dir):
    return round_doubles(SEL.variance_filter(feature_frame(spark, sf_dir)))


@register("anova_ranking", sql=f"""WITH {_SEL_CTES}
SELECT feature, ordinal, round(f_score, 6) AS f_score, anova_rank FROM an""")
def q_anova_ranking(spark, sf_dir):
    return round_doubles(SEL.anova_scores(feature_frame(spark, sf_dir)))


@register("correlation_filter", sql=f"""WITH {_SEL_CTES}
SELECT a, b, round(abs_r, 6) AS abs_r, round(f_a, 6) AS f_a, round(f_b, 6) AS f_b, dropped FROM pairs""")
def q_correlation_filter(spark, sf_dir):
    fx = feature_frame(spark, sf_dir)
    scores = SEL.anova_scores(fx)
    surv = SEL.variance_filter(fx).where("variance_kept").select("feature")
    return round_doubles(SEL.correlation_pairs(fx, scores, surv))


@register("filter_selection", sql=f"""WITH {_SEL_CTES}
SELECT vr.feature, vr.ordinal, round(vr.variance, 6) AS variance,
       coalesce(vr.variance > {SEL.VARIANCE_THRESHOLD}, false) AS variance_kept,
       round(an.f_score, 6) AS f_score, an.anova_rank,
       coalesce(vr.variance > {SEL.VARIANCE_THRESHOLD}, false) AND vr.feature NOT IN (SELECT dropped FROM pairs) AS corr_kept,
       an.anova_rank <= {SEL.TOP_K} AS anova_top,
       coalesce(vr.variance > {SEL.VARIANCE_THRESHOLD}, false) AND vr.feature NOT IN (SELECT dropped FROM pairs)
         AND an.anova_rank <= {SEL.TOP_K} AS filter_final
FROM vr JOIN an ON an.feature = vr.feature""")
def q_filter_selection(spark, sf_dir):
    return round_doubles(SEL.filter_method(feature_frame(spark, sf_dir)))


@register("standardized_features", sql=f"""WITH {features_sql()},
st AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURE_NAMES)} FROM features)
SELECT username, {", ".join(f"round(({c} - (SELECT m_{c} FROM st)) / (SELECT CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END FROM st), 6) AS {c}" for c in FEATURE_NAMES)}
FROM features""")
def q_standardized_features(spark, sf_dir):
    fx = feature_frame(spark, sf_dir)
    cols = [c for c in FEATURE_COLUMNS]
    fx = fx.select("username", *[F.col(c).cast("double").alias(c) for c in cols])
    return round_doubles(S.apply_standard(fx, S.fit_standard(fx, cols), keep=["username"]))


@register("minmax_features", sql=f"""WITH {features_sql()},
st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURE_NAMES)} FROM features)
SELECT username, {", ".join(f"round(({c} - (SELECT lo_{c} FROM st)) / (SELECT CASE WHEN hi_{c} > lo_{c} THEN hi_{c} - lo_{c} ELSE 1 END FROM st), 6) AS {c}" for c in FEATURE_NAMES)}
FROM features""")
def q_minmax_features(spark, sf_dir):
    fx = feature_frame(spark, sf_dir)
    cols = list(FEATURE_COLUMNS)
    fx = fx.select("username", *[F.col(c).cast("double").alias(c) for c in cols])
    return round_doubles(S.apply_minmax(fx, S.fit_minmax(fx, cols), keep=["username"]))


_HASH_SQL = "CAST(('0x' || substr(md5('42:' || username), 1, 13)) AS BIGINT)"


_SPLIT_CTES = f"""hx AS (SELECT username, churn, {_HASH_SQL} AS h FROM features),
cc AS (SELECT churn, count(*) AS c FROM hx GROUP BY churn),
tot AS (SELECT sum(c) AS n, CAST(ceil(CAST(0.2 AS DOUBLE) * sum(c)) AS BIGINT) AS n_test FROM cc),
q1 AS (SELECT churn, c, (SELECT n - n_test FROM tot) AS n_train,
              floor((SELECT n - n_test FROM tot) * c / (SELECT n FROM tot)) AS fl,
              (SELECT n - n_test FROM tot) * c / (SELECT n FROM tot) - floor((SELECT n - n_test FROM tot) * c / (SELECT n FROM tot)) AS rem
       FROM cc),
q2 AS (SELECT churn, c, fl, n_train - sum(fl) OVER () AS need, row_number() OVER (ORDER BY rem DESC, churn) AS rk FROM q1),
quota AS (SELECT churn, c - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS t FROM q2),
split AS (SELECT username, churn, row_number() OVER (PARTITION BY hx.churn ORDER BY h, username) <= t AS is_test
          FROM hx JOIN quota USING (churn))"""


@register("stratified_split", sql=f"WITH {features_sql()}, {_SPLIT_CTES} SELECT username, churn, is_test FROM split")
def q_stratified_split(spark, sf_dir):
    return S.stratified_split(shared_raw(spark, sf_dir).select("username", "churn"))


@register("kfold_assignment", sql=f"""WITH {raw_users_sql()}
SELECT username, churn, CAST(floor((row_number() OVER (PARTITION BY churn ORDER BY {_HASH_SQL}, username) - 1) * 5
       / count(*) OVER (PARTITION BY churn)) AS INTEGER) AS fold FROM raw_users""")
def q_kfold_assignment(spark, sf_dir):
    return S.kfold_assignment(shared_raw(spark, sf_dir).select("username", "churn"))


@register("class_weights", sql=f"""WITH {raw_users_sql()}
SELECT churn, count(*) AS n_class, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) AS weight
FROM raw_users GROUP BY churn""")
def q_class_weights(spark, sf_dir):
    return round_doubles(S.class_weights(raw_frame(spark, sf_dir)))


# ---------------------------------------------------------------- graph
from churnlens.operators import graph as G  # noqa: E402
from churnlens.plans.sql_parts import (  # noqa: E402
    DEGREE_CTES, betweenness_ctes, graph_sql, network_ctes, pagerank_ctes,
)
from churnlens.session import materialize  # noqa: E402

def graph_frames(spark, sf_dir, raw=None):
    raw = raw if raw is not None else raw_frame(spark, sf_dir)
    nodes = materialize(G.graph_nodes(raw), "graph-nodes")  # read several times from here on
    return raw, nodes, materialize(G.follow_edges(nodes), "graph-edges")


@register("graph_nodes", sql=f"WITH {graph_sql()} SELECT * FROM nodes")
def q_graph_nodes(spark, sf_dir):
    return G.graph_nodes(raw_frame(spark, sf_dir))


@register("top_followed", sql=f"WITH {graph_sql()} SELECT dst, pos FROM top")
def q_top_followed(spark, sf_dir):
    return G.top_followed(G.graph_nodes(raw_frame(spark, sf_dir)))


@register("follow_edges", sql=f"WITH {graph_sql()} SELECT src, dst FROM edges")
def q_follow_edges(spark, sf_dir):
    _, _, edges = graph_frames(spark, sf_dir)
    return edges


@register("graph_density", sql=f"""WITH {graph_sql()}
SELECT n, m, round(CASE WHEN n > 1 THEN m / (n * (n - 1)) ELSE 0.0 END, 9) AS density
FROM (SELECT (SELECT count(*) FROM nodes) AS n, (SELECT count(*) FROM edges) AS m)""")
def q_graph_density(spark, sf_dir):
    _, nodes, edges = graph_frames(spark, sf_dir)
    return round_doubles(G.graph_density(nodes, edges), 9)


@register("degree_centrality", sql=f"""WITH {graph_sql()}, {DEGREE_CTES}
SELECT username, in_degree, out_degree, round(degree_centrality, 9) AS degree_centrality FROM dg""")
def q_degree_centrality(spark, sf_dir):
    _, nodes, edges = graph_frames(spark, sf_dir)
    return round_doubles(G.degree_centrality(nodes, edges), 9)


@register("pagerank", sql=f"WITH {graph_sql()}, {pagerank_ctes()} SELECT username, round(pagerank, 9) AS pagerank FROM pr")
def q_pagerank(spark, sf_dir):
    """Iterated to convergence, as the network features and the models use it."""
    _, nodes, edges = graph_frames(spark, sf_dir)
    return round_doubles(G.pagerank(nodes, edges), 9)


@register("betweenness", sql=f"""WITH {graph_sql()}, {betweenness_ctes()}
SELECT username, round(betweenness_centrality, 9) AS betweenness_centrality FROM bt""")
def q_betweenness(spark, sf_dir):
    _, nodes, edges = graph_frames(spark, sf_dir)
    return round_doubles(G.betweenness(nodes, edges, k=50), 9)


@register("subgraph", sql=f"""WITH {graph_sql()},
keep AS (SELECT username FROM nodes WHERE followers >= 5)
SELECT src, dst FROM edges WHERE src IN (SELECT username FROM keep) AND dst IN (SELECT username FROM keep)""")
def q_subgraph(spark, sf_dir):
    _, nodes, edges = graph_frames(spark, sf_dir)
    """Edges among the users with five followers or more."""
    return G.subgraph(nodes, edges, nodes.where("followers >= 5"))[1]


def network_frame(spark, sf_dir, raw=None):
    raw, nodes, edges = graph_frames(spark, sf_dir, raw)
    deg = G.degree_centrality(nodes, edges)
    graph = G.adjacency(nodes, edges)
    btw = G.betweenness(nodes, edges, k=50, graph=graph)
    pr = G.pagerank(nodes, edges, graph=graph)
    return materialize(G.network_features(nodes, deg, btw, pr), "network")


_NET = ["degree_centrality", "betweenness_centrality", "pagerank"]


@register("network_features", sql=f"""WITH {network_ctes()}
SELECT username, churn, followers, following, repos, {rounded(_NET, 9)} FROM net""")
def q_network_features(spark, sf_dir):
    return round_doubles(network_frame(spark, sf_dir), 9)


@register("network_means_by_label", sql=f"WITH {network_ctes()} " + " UNION ALL ".join(
    f"SELECT churn, '{c}' AS feature, round(avg({c}), 9) AS mean FROM net GROUP BY churn" for c in _NET))
def q_network_means_by_label(spark, sf_dir):
    nf = network_frame(spark, sf_dir)
    return round_doubles(P.means_by_label(nf, _NET), 9)


@register("network_describe", sql=f"WITH {network_ctes()} {describe_sql('net', [*_NET, 'churn'], 9)}")
def q_network_describe(spark, sf_dir):
    nf = network_frame(spark, sf_dir)
    return round_doubles(P.describe(nf, [*_NET, "churn"]), 9)


_NETC = network_ctes()
_NETC = _NETC[_NETC.index("nodes AS ("):]  # the raw users come with the features


@register("aligned_features", sql=f"""WITH {features_sql()}, {_NETC}
SELECT features.username, {rounded(DOUBLE_FEATURES, 9)}, has_no_repos, has_complete_profile, features.churn, {rounded(_NET, 9)}
FROM features JOIN net ON net.username = features.username""")
def q_aligned_features(spark, sf_dir):
    raw = shared_raw(spark, sf_dir)
    return round_doubles(G.aligned_features(feature_frame(spark, sf_dir, raw=raw),
                                            network_frame(spark, sf_dir, raw=raw)), 9)


# ---------------------------------------------------------------- models, PCA, SVD, recommendations
from churnlens.operators import latent as LT  # noqa: E402
from churnlens.operators import models as M  # noqa: E402
from churnlens.schemas import FINAL_FEATURES  # noqa: E402


def _train_split(fx):
    return S.stratified_split(fx).where(~F.col("is_test"))


def _rfe_sql(steps: int = 14, keep: int = 5) -> str:
    """Elimination by Newton steps: a recursive step adds up gradient and Hessian over the training rows (``it`` has
    one row) and solves for the step by elimination; after ``steps`` of them the weakest feature is masked."""
    d = len(FEATURE_NAMES) + 1
    z = ", ".join(f"({c} - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END)"
                  for c in FEATURE_NAMES)
    zeros, ones = ", ".join(["0.0::DOUBLE"] * d), ", ".join(["1.0::DOUBLE"] * d)
    pivots = ", ".join(f"[[{k}.0::DOUBLE]]" for k in range(1, d + 1))
    return f"""{features_sql()}, {_SPLIT_CTES},
tr AS (SELECT features.* FROM features JOIN split USING (username) WHERE NOT is_test),
z AS (SELECT CAST([1.0, {z}] AS DOUBLE[]) AS x, CAST(churn AS DOUBLE) AS y FROM tr),
it(r, t, w, mask, gone) AS (
  SELECT 1, 0, [{zeros}], [{ones}], CAST([] AS INTEGER[])
  UNION ALL
  SELECT CASE WHEN t = {steps - 1} THEN r + 1 ELSE r END, (t + 1) % {steps},
         CASE WHEN t = {steps - 1} THEN list_transform(nw, lambda v, i: CASE WHEN i = loser + 1 THEN 0.0 ELSE v END) ELSE nw END,
         CASE WHEN t = {steps - 1} THEN list_transform(mask, lambda v, i: CASE WHEN i = loser + 1 THEN 0.0 ELSE v END) ELSE mask END,
         CASE WHEN t = {steps - 1} THEN list_append(gone, loser) ELSE gone END
  FROM (SELECT *, CAST(list_position(imp, list_min(imp)) AS INTEGER) AS loser FROM (
    SELECT *, list_transform(nw[2:], lambda v, i: CASE WHEN mask[i + 1] = 0 THEN 1e300 ELSE round(v * v, 10) END) AS imp FROM (
    SELECT r, t, mask, gone, list_transform(w, lambda v, i: v - solved[i][{d + 1}]) AS nw FROM (
    SELECT r, t, w, mask, gone, list_reduce(list_prepend(list(hrow ORDER BY i), [{pivots}]), lambda m, k:
        list_transform(m, lambda row, i: CASE WHEN i = CAST(k[1][1] AS INTEGER)
          THEN list_transform(row, lambda v: v / m[CAST(k[1][1] AS INTEGER)][CAST(k[1][1] AS INTEGER)])
          ELSE list_transform(row, lambda v, j: v - row[CAST(k[1][1] AS INTEGER)] * m[CAST(k[1][1] AS INTEGER)][j]
                              / m[CAST(k[1][1] AS INTEGER)][CAST(k[1][1] AS INTEGER)]) END)) AS solved
    FROM (SELECT r, t, w, mask, gone, i, list_append(list(h ORDER BY j), any_value(g)) AS hrow
      FROM (SELECT r, t, w, mask, gone, i, j, sum(p * (1 - p) * x[i] * x[j]) * mask[i] * mask[j] + CASE WHEN i = j AND i > 1 THEN 1 ELSE 0 END AS h,
                   sum((p - y) * x[i]) * mask[i] + CASE WHEN i > 1 THEN w[i] ELSE 0 END AS g
            FROM (SELECT it.*, x, y, 1 / (1 + exp(-list_inner_product(x, w))) AS p FROM it, z WHERE r <= {d - 1 - keep}) s,
                 (SELECT unnest(range(1, {d + 1})) AS i) a, (SELECT unnest(range(1, {d + 1})) AS j) b
            GROUP BY r, t, w, mask, gone, i, j)
      GROUP BY r, t, w, mask, gone, i)
    GROUP BY r, t, w, mask, gone)))) ),
fin AS (SELECT gone FROM it WHERE r = {d - keep})
SELECT feature, CAST(o AS INTEGER) AS ordinal,
       CAST(CASE WHEN p > 0 THEN {d - keep} - p + 1 ELSE 1 END AS INTEGER) AS rfe_rank, p IS NULL OR p = 0 AS rfe_selected
FROM (SELECT feature, o, coalesce(list_position(gone, o + 1), 0) AS p
      FROM (SELECT unnest({_NAMES_LIST}) AS feature, unnest(range(0, {d - 1})) AS o) n, fin)"""


_NAMES_LIST = "[" + ", ".join(f"'{c}'" for c in FEATURE_NAMES) + "]"


@register("rfe_ranking", sql=f"WITH RECURSIVE {_rfe_sql()}")
def q_rfe_ranking(spark, sf_dir):
    return M.rfe_ranking(_train_split(feature_frame(spark, sf_dir)))


@register("dt_importance")
def q_dt_importance(spark, sf_dir):
    return round_doubles(M.dt_importance(_train_split(feature_frame(spark, sf_dir))))


@register("rf_importance")
def q_rf_importance(spark, sf_dir):
    return round_doubles(M.rf_importance(_train_split(feature_frame(spark, sf_dir))))


@register("selection_table")
def q_selection_table(spark, sf_dir):
    return M.select_features(feature_frame(spark, sf_dir))["table"]


@register("selection_table_final")
def q_selection_table_final(spark, sf_dir):
    """The variant whose filters see the training rows only and vote by their final choice."""
    return M.select_features(feature_frame(spark, sf_dir), filter_on="train", filter_vote="filter_final")["table"]


@register("cv_metrics")
def q_cv_metrics(spark, sf_dir):
    return round_doubles(M.cv_metrics(feature_frame(spark, sf_dir), FINAL_FEATURES))


@register("holdout_metrics")
def q_holdout_metrics(spark, sf_dir):
    return round_doubles(M.train_and_save(feature_frame(spark, sf_dir), FINAL_FEATURES)["metrics"])


@register("holdout_report")
def q_holdout_report(spark, sf_dir):
    return round_doubles(M.train_and_save(feature_frame(spark, sf_dir), FINAL_FEATURES)["report"])


@register("score_users")
def q_score_users(spark, sf_dir):
    fx = feature_frame(spark, sf_dir)
    model = M.train_and_save(fx, FINAL_FEATURES)["model"]
    return M.score_users(model, fx.select("username", *FINAL_FEATURES))


from churnlens.plans.sql_parts import eigen_ctes  # noqa: E402


def _pca_fit(spark, sf_dir):
    return LT.fit_pca(feature_frame(spark, sf_dir))


_Z = ", ".join(f"(CAST({c} AS DOUBLE) - avg({c}) OVER ()) / (CASE WHEN stddev_pop({c}) OVER () > 0 THEN stddev_pop({c}) OVER () ELSE 1 END) AS {c}"
               for c in FEATURE_NAMES)
_PCA_CTES = f"""{features_sql()}, zs AS (SELECT username, churn, {_Z} FROM features), {eigen_ctes("zs", FEATURE_NAMES)},
pcr AS (SELECT k, vec, greatest(value, 0) / sum(greatest(value, 0)) OVER () AS ratio FROM eig),
pcc AS (SELECT *, sum(ratio) OVER (ORDER BY k) AS cum FROM pcr)"""


@register("pca_variance", sql=f"""WITH RECURSIVE {_PCA_CTES}
SELECT CAST(k AS INTEGER) AS component, round(ratio, 6) AS variance_ratio, round(cum, 6) AS cumulative,
       CAST((SELECT min(k) FROM pcc WHERE cum >= 0.9 - 1e-12) AS INTEGER) AS n_for_target FROM pcc""")
def q_pca_variance(spark, sf_dir):
    return round_doubles(LT.pca_variance(spark, _pca_fit(spark, sf_dir)))


@register("pca_loadings", sql=f"""WITH RECURSIVE {_PCA_CTES}
SELECT feature, CAST(i - 1 AS INTEGER) AS ordinal, {", ".join(f"round((SELECT vec FROM eig WHERE k = {j})[i], 6) AS pc{j}" for j in range(1, 11))}
FROM (SELECT unnest({_NAMES_LIST}) AS feature, unnest(range(1, 11)) AS i)""")
def q_pca_loadings(spark, sf_dir):
    return round_doubles(LT.pca_loadings(spark, _pca_fit(spark, sf_dir)))


@register("pca_projection")
def q_pca_projection(spark, sf_dir):
    fx = feature_frame(spark, sf_dir)
    fit = LT.fit_pca(fx)
    return round_doubles(LT.pca_project(fx, fit, fit.n_for(), keep=("username", "churn")))


@register("pca_scores", sql=f"""WITH RECURSIVE {_PCA_CTES}
SELECT username, churn, {", ".join(f"round(list_inner_product([{', '.join(FEATURE_NAMES)}], (SELECT vec FROM eig WHERE k = {j})), 6) AS pc{j}" for j in range(1, 4))}
FROM zs""")
def q_pca_scores(spark, sf_dir):
    """Users on the first three components."""
    fx = feature_frame(spark, sf_dir)
    return round_doubles(LT.pca_project(fx, LT.fit_pca(fx), 3, keep=("username", "churn")))


_MM = ", ".join(
    f"({c} - (SELECT lo_{c} FROM st)) / (SELECT CASE WHEN hi_{c} > lo_{c} THEN hi_{c} - lo_{c} ELSE 1 END FROM st) AS {c}"
    for c in FEATURE_NAMES)
_GRAM = "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{FEATURE_NAMES[j]}' AS b, round(sum({a} * {FEATURE_NAMES[j]}), 6) AS g FROM mm"
    for i, a in enumerate(FEATURE_NAMES) for j in range(i, len(FEATURE_NAMES)))


@register("svd_gram", sql=f"""WITH {features_sql()},
st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURE_NAMES)} FROM features),
mm AS (SELECT {_MM} FROM features)
{_GRAM}""")
def q_svd_gram(spark, sf_dir):
    fx = feature_frame(spark, sf_dir)
    cols = list(FEATURE_COLUMNS)
    dbl = fx.select(*[F.col(c).cast("double").alias(c) for c in cols])
    x = S.apply_minmax(dbl, S.fit_minmax(dbl, cols))
    aggs = [F.struct(F.lit(a).alias("a"), F.lit(cols[j]).alias("b"), F.sum(F.col(a) * F.col(cols[j])).alias("g"))
            for i, a in enumerate(cols) for j in range(i, len(cols))]
    return round_doubles(x.agg(F.array(*aggs).alias("m")).select(F.inline("m")))


def _svd(spark, sf_dir):
    fx = feature_frame(spark, sf_dir)
    return fx, LT.fit_svd(fx)


_SVD_CTES = f"""{features_sql()},
st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURE_NAMES)} FROM features),
mm AS (SELECT username, churn, {_MM} FROM features), {eigen_ctes("mm", FEATURE_NAMES)},
sv AS (SELECT k, greatest(value, 0) AS s2, vec FROM eig)"""
_ROW = "CAST([" + ", ".join(FEATURE_NAMES) + "] AS DOUBLE[])"


@register("svd_variance", sql=f"""WITH RECURSIVE {_SVD_CTES}
SELECT CAST(k AS INTEGER) AS factor, round(sqrt(s2), 6) AS singular_value, round(s2 / sum(s2) OVER (), 6) AS share_of_kept,
       round(sum(s2) OVER (ORDER BY k) / sum(s2) OVER (), 6) AS cumulative_kept,
       round(s2 / (SELECT sum(s2) FROM sv), 6) AS share_of_total FROM sv WHERE k <= {LT.LATENT_FACTORS}""")
def q_svd_variance(spark, sf_dir):
    return round_doubles(LT.svd_variance(spark, _svd(spark, sf_dir)[1]))


@register("svd_reconstruction")
def q_svd_reconstruction(spark, sf_dir):
    fx, fit = _svd(spark, sf_dir)
    out = LT.svd_reconstruct(fx, fit)
    return out.select("username", F.transform("scaled", lambda v: F.round(v, 6)).alias("scaled"),
                      F.transform("reconstructed", lambda v: F.round(v, 6)).alias("reconstructed"))


_REC = [" + ".join(f"c{j} * (SELECT vec FROM sv WHERE k = {j})[{i}]" for j in range(1, LT.LATENT_FACTORS + 1))
        for i in range(1, len(FEATURE_NAMES) + 1)]


@register("svd_rest", sql=f"""WITH RECURSIVE {_SVD_CTES},
sr AS (SELECT username, {_ROW} AS x FROM mm),
co AS (SELECT username, x, {", ".join(f"list_inner_product(x, (SELECT vec FROM sv WHERE k = {j})) AS c{j}" for j in range(1, LT.LATENT_FACTORS + 1))} FROM sr)
SELECT username, {", ".join(f"round({e}, 6) AS {c}" for e, c in zip(_REC, FEATURE_NAMES))},
       round({" + ".join(f"(x[{i + 1}] - ({e})) * (x[{i + 1}] - ({e}))" for i, e in enumerate(_REC))}, 6) AS rest
FROM co""")
def q_svd_rest(spark, sf_dir):
    """The rank-5 reconstruction of each user's features, and its squared distance from them."""
    fx, fit = _svd(spark, sf_dir)
    out = LT.svd_reconstruct(fx, fit)
    rest = F.aggregate(F.zip_with("scaled", "reconstructed", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
    return round_doubles(out.select("username", *[F.col("reconstructed")[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)],
                                    rest.alias("rest")))


@register("svd_coordinates", sql=f"""WITH RECURSIVE {_SVD_CTES}
SELECT username, churn, {", ".join(f"round(list_inner_product({_ROW}, (SELECT vec FROM sv WHERE k = {j})) / (SELECT CASE WHEN s2 > 0 THEN sqrt(s2) ELSE 1 END FROM sv WHERE k = {j}), 6) AS factor{j}" for j in (1, 2))}
FROM mm""")
def q_svd_coordinates(spark, sf_dir):
    fx, fit = _svd(spark, sf_dir)
    return round_doubles(LT.svd_coordinates(fx, fit))


def recommend_frame(spark, sf_dir, top_n=5, scaled_scoring=False):
    """``scaled_scoring=True`` feeds the model min-max scaled inputs, as the
    reference's service does (the model was trained on raw values)."""
    fx = feature_frame(spark, sf_dir)
    model = M.train_and_save(fx, FINAL_FEATURES)["model"]
    return LT.recommend_users(fx, model, LT.fit_svd(fx), FEATURE_COLUMNS, top_n, scaled_scoring=scaled_scoring)


@register("recommend")
def q_recommend(spark, sf_dir):
    return recommend_frame(spark, sf_dir)


@register("recommend_scaled")
def q_recommend_scaled(spark, sf_dir):
    """The service path: the model is fed scaled inputs."""
    return recommend_frame(spark, sf_dir, scaled_scoring=True)


_REQ = list(FINAL_FEATURES)


def _minmax_sql(digits=6):
    return ", ".join(f"round((f.{c} - st.lo_{c}) / (CASE WHEN st.hi_{c} > st.lo_{c} THEN st.hi_{c} - st.lo_{c} ELSE 1 END), {digits})"
                     for c in FEATURE_NAMES)


_GAP_CTES = f"""{features_sql()},
st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURE_NAMES)} FROM features),
sc AS (SELECT f.username, f.days_since_last_activity, [{_minmax_sql()}] AS scaled FROM features f, st),
g AS (SELECT username, i, (CASE i WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 ELSE 0.75 END) - scaled[i] AS gap
      FROM (SELECT username, scaled, unnest(generate_series(1, {len(FEATURE_NAMES)})) AS i FROM sc)),
r AS (SELECT *, row_number() OVER (PARTITION BY username ORDER BY gap DESC, i DESC) AS k FROM g)"""
_NAMES_SQL = "[" + ", ".join(f"'{c}'" for c in FEATURE_NAMES) + "]"


def _gap_frame(spark, sf_dir):
    """Scaled features against a fixed target per feature, and a probability from the activity recency."""
    fx = feature_frame(spark, sf_dir)
    cols = list(FEATURE_COLUMNS)
    dbl = fx.select("username", F.expr(_SHARE).alias("churn_probability"), *[F.col(c).cast("double").alias(c) for c in cols])
    scaled = S.apply_minmax(dbl, S.fit_minmax(dbl, cols), keep=["username", "churn_probability"])
    target = [0.5, 0.25] + [0.75] * (len(cols) - 2)
    return scaled.select("username", "churn_probability", F.array(*[F.round(c, 6) for c in cols]).alias("scaled"),
                         F.array(*[F.lit(t) for t in target]).alias("reconstructed"))


@register("gap_topn", sql=f"""WITH {_GAP_CTES}
SELECT username, string_agg({_NAMES_SQL}[i], ',' ORDER BY k) AS features, round(sum(gap), 6) AS gap_sum
FROM r WHERE k <= 4 GROUP BY username""")
def q_gap_topn(spark, sf_dir):
    rows = _gap_frame(spark, sf_dir).select("username", LT.top_gaps(FEATURE_COLUMNS, F.lit(4)).alias("top"), "scaled", "reconstructed")
    gap = F.aggregate(F.slice(F.sort_array(F.transform(
        F.arrays_zip("reconstructed", "scaled"), lambda x: x["reconstructed"] - x["scaled"]), asc=False), 1, 4),
        F.lit(0.0), lambda a, x: a + x)
    return round_doubles(rows.select("username", F.array_join(F.transform("top", lambda s: s["feature"]), ",").alias("features"),
                                     gap.alias("gap_sum")))


@register("recommend_gate", sql=f"""WITH {_GAP_CTES}, p AS (SELECT username, {_SHARE} AS p FROM sc)
SELECT p.username, CAST(row_number() OVER (ORDER BY p.username) - 1 AS BIGINT) AS user_id, p >= 0.5 AS at_risk,
       CASE WHEN p >= 0.5 THEN (SELECT string_agg({_NAMES_SQL}[i], ',' ORDER BY k) FROM r WHERE k <= 5 AND r.username = p.username)
            ELSE '' END AS features FROM p""")
def q_recommend_gate(spark, sf_dir):
    """The recommendation rule on a given probability column: advice only at or above the gate."""
    rows = LT.advise(LT.user_index(_gap_frame(spark, sf_dir)))
    return rows.select("username", "user_id", "at_risk",
                       F.array_join(F.transform("recommendations", lambda s: s["feature"]), ",").alias("features"))


_ADVICE_SQL = "CASE {f} " + " ".join(f"WHEN '{f}' THEN '{t}'" for f, t in LT.ADVICE.items()) + " END"
_RISK_HEAD, _RISK_REST = LT.MSG_AT_RISK.split("{pct}")


@register("recommend_texts", sql=f"""WITH {_GAP_CTES}, p AS (SELECT username, {_SHARE} AS p FROM sc),
t AS (SELECT username, k, gap, {_NAMES_SQL}[i] AS feature FROM r WHERE k <= 3)
SELECT p.username, round(p, 3) AS churn_probability,
       CASE WHEN p >= 0.5 THEN concat('{_RISK_HEAD}', printf('%.1f', p * 100), '{_RISK_REST.replace("{n}", "3")}')
            ELSE '{LT.MSG_NOT_AT_RISK}' END AS message,
       CASE WHEN p >= 0.5 THEN (SELECT string_agg({_ADVICE_SQL.format(f="feature")}, ' | ' ORDER BY k) FROM t WHERE t.username = p.username)
            ELSE '' END AS actions,
       CASE WHEN p >= 0.5 THEN (SELECT round(sum(round(gap, 4)), 4) FROM t WHERE t.username = p.username) ELSE 0.0 END AS gap_sum
FROM p""")
def q_recommend_texts(spark, sf_dir):
    """What a user is told: the message with the probability in per cent, and the advice for the three widest gaps."""
    rows = LT.advise(LT.user_index(_gap_frame(spark, sf_dir)), top_n=3)
    gaps = F.aggregate("recommendations", F.lit(0.0), lambda a, x: a + x["gap_score"])
    return rows.select("username", "churn_probability", "message",
                       F.array_join(F.transform("recommendations", lambda x: x["action"]), " | ").alias("actions"),
                       F.round(gaps, 4).alias("gap_sum"))


@register("svd_trace", sql=f"""WITH {features_sql()},
st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURE_NAMES)} FROM features),
mm AS (SELECT {_MM} FROM features)
SELECT round(sum({" + ".join(f"{c} * {c}" for c in FEATURE_NAMES)}), 4) AS squared_norm FROM mm""")
def q_svd_trace(spark, sf_dir):
    """All squared singular values of the scaled matrix add up to its squared norm."""
    fit = LT.fit_svd(feature_frame(spark, sf_dir), k=len(FEATURE_COLUMNS))
    return round_doubles(spark.createDataFrame([(float((fit.sigma ** 2).sum()),)], "squared_norm double"), 4)


@register("svd_full_reconstruction", sql=f"""WITH {features_sql()},
st AS (SELECT {", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURE_NAMES)} FROM features)
SELECT f.username, list_sum([round(x, 6) FOR x IN [{_minmax_sql(12)}]]) AS total FROM features f, st""")
def q_svd_full_reconstruction(spark, sf_dir):
    """With all factors kept the reconstruction is the scaled matrix itself."""
    fx = feature_frame(spark, sf_dir)
    rec = LT.svd_reconstruct(fx, LT.fit_svd(fx, k=len(FEATURE_COLUMNS)))
    # -0.0 and rounding aside, each reconstructed value is its scaled one
    return rec.select("username", F.aggregate("reconstructed", F.lit(0.0), lambda a, x: a + F.round(x, 6)).alias("total"))


_VOTE_CTES = f"""{_SEL_CTES},
mv AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS ordinal, avg({c}) AS m FROM features" for i, c in enumerate(FEATURE_NAMES))}),
rk AS (SELECT an.feature, an.ordinal, an.anova_rank, row_number() OVER (ORDER BY vr.variance DESC, an.ordinal) AS by_var,
              row_number() OVER (ORDER BY mv.m DESC, an.ordinal) AS by_mean
       FROM an JOIN vr ON vr.feature = an.feature JOIN mv ON mv.feature = an.feature),
vt AS (SELECT *, CAST(anova_rank <= 5 AS INTEGER) + CAST(by_var <= 5 AS INTEGER) + CAST(by_mean <= 5 AS INTEGER)
              + CAST(CASE WHEN ordinal < 8 THEN by_var ELSE 99 END <= 5 AS INTEGER) AS votes FROM rk)"""


@register("vote_decision", sql=f"""WITH {_VOTE_CTES}
SELECT feature, ordinal, anova_rank AS filter_rank, by_var <= 5 AS rfe_selected, CAST(by_mean AS INTEGER) AS dt_rank,
       CAST(CASE WHEN ordinal < 8 THEN by_var ELSE 99 END AS INTEGER) AS rf_rank, votes AS methods_agreeing,
       CASE WHEN votes >= 3 THEN 'Keep' WHEN votes = 2 THEN 'Optional' ELSE 'Drop' END AS decision FROM vt""")
def q_vote_decision(spark, sf_dir):
    """The vote rule over rankings that SQL can make (variance and mean), with two features missing from one."""
    from pyspark.sql import Window
    fx = feature_frame(spark, sf_dir)
    filt = SEL.filter_method(fx)
    means = P.means_by_label(fx.withColumn("one", F.lit(1)), FEATURE_COLUMNS, "one").select("feature", "mean")
    rank = lambda c: F.row_number().over(Window.orderBy(F.desc(c), "ordinal")).cast("int")  # noqa: E731  ten rows
    t = filt.join(means, "feature").select("feature", "ordinal", rank("variance").alias("by_var"), rank("mean").alias("by_mean"))
    return M.comparison_table(filt, t.select("feature", (F.col("by_var") <= 5).alias("rfe_selected")),
                              t.select("feature", F.col("by_mean").alias("dt_rank")),
                              t.where("ordinal < 8").select("feature", F.col("by_var").alias("rf_rank")))


@register("keep_list", sql=f"""WITH {_VOTE_CTES}
SELECT feature, CAST(row_number() OVER (ORDER BY ordinal) - 1 AS BIGINT) AS place FROM vt WHERE votes >= 3""")
def q_keep_list(spark, sf_dir):
    """The features that training takes from the vote table, in contract order."""
    kept = M.keep_list(q_vote_decision(spark, sf_dir))
    return spark.createDataFrame([(f, i) for i, f in enumerate(kept)], "feature string, place bigint")


@register("training_result")
def q_training_result(spark, sf_dir):
    """The figures that training returns: hold-out and cross-validation side by side."""
    res = M.train_and_save(feature_frame(spark, sf_dir), FINAL_FEATURES, cv=True)
    holdout, folds = res["metrics"].first(), res["cv_metrics"].first()  # the test rows are scored once
    both = [(k, holdout[k], folds[f"cv_{k}"]) for k in ("accuracy", "precision", "recall", "f1")]
    return round_doubles(spark.createDataFrame(both, "metric string, holdout double, cv double"))


def _request_checks(sql: bool):
    """(condition, message) pairs, in order; the first failing one is reported."""
    out = []
    for c in _REQ:
        out.append((f"{c} IS NULL" if sql else F.col(c).isNull(), f"{c} is required"))
        bad = f"({c} < 0 OR isnan({c}) OR isinf({c}))"
        out.append((bad if sql else (F.col(c) < 0) | F.isnan(c) | (F.abs(c) == float("inf")), f"{c} must be >= 0"))
    return out


_REQ_CASE = "CASE " + " ".join(f"WHEN {c} THEN '{m}'" for c, m in _request_checks(True)) + " END"


@register("validate_requests", sql=f"""WITH {features_sql()},
rq AS (SELECT username, {", ".join(f"CASE WHEN profile_completeness = {i + 1} AND has_no_repos = 0 AND follower_ratio > 1 THEN CAST('{v}' AS DOUBLE) ELSE {c} END AS {c}" for i, (c, v) in enumerate(zip(_REQ, ("nan", "inf", "-1"))))} FROM f0)
SELECT username AS request_id, {", ".join(f"CASE WHEN isfinite({c}) THEN round({c}, 6) END AS {c}" for c in _REQ)},
       ({_REQ_CASE}) IS NULL AS valid, {_REQ_CASE} AS error
FROM rq""")
def q_validate_requests(spark, sf_dir):
    """Scoring requests built from each user's three model inputs before the median
    fill, so users with unknown dates arrive with missing fields and are rejected; some
    rows carry a NaN, an infinity or a negative number, which are rejected too."""
    from churnlens.operators.scoring import validate_score_requests
    pre = raw_feature_frame(raw_frame(spark, sf_dir), AS_OF)
    odd = lambda i: (F.col("profile_completeness") == i + 1) & (F.col("has_no_repos") == 0) & (F.col("follower_ratio") > 1)
    req = pre.select(F.col("username").alias("request_id"), *[
        F.when(odd(i), F.lit(v)).otherwise(F.col(c)).alias(c) for i, (c, v) in enumerate(zip(_REQ, (float("nan"), float("inf"), -1.0)))])
    out = validate_score_requests(req)
    finite = [F.when(~F.isnan(c) & (F.abs(c) != float("inf")), F.col(c)).alias(c) for c in _REQ]
    return round_doubles(out.select("request_id", *finite, "valid", "error"))


# ---------------------------------------------------------------- comparison, extended model, stream
from churnlens.session import scratch_path  # noqa: E402


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    raw = shared_raw(spark, sf_dir)
    return round_doubles(M.model_comparison(feature_frame(spark, sf_dir, raw=raw), network_frame(spark, sf_dir, raw=raw)))


@register("extended_importance")
def q_extended_importance(spark, sf_dir):
    raw = shared_raw(spark, sf_dir)
    return round_doubles(M.extended_importance(feature_frame(spark, sf_dir, raw=raw),
                                               network_frame(spark, sf_dir, raw=raw)))


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """Requests (each user's three inputs before the median fill) land as JSON
    files; the stream validates and scores them with the trained model."""
    from churnlens.streaming.scoring import start_scoring_stream
    raw = shared_raw(spark, sf_dir)
    fx = feature_frame(spark, sf_dir, raw=raw)
    model = M.train_and_save(fx, FINAL_FEATURES)["model"]
    pre = raw_feature_frame(raw, AS_OF)
    src, sink, ck = (scratch_path(spark, n, track=True) for n in ("requests", "scored", "stream-ckpt"))
    pre.select(F.col("username").alias("request_id"), *FINAL_FEATURES).write.json(src)
    start_scoring_stream(spark, model, src, sink, ck)
    scored = spark.read.parquet(f"{sink}/scored").select("request_id", "churned", "churn_probability", "risk_level")
    rejected = spark.read.parquet(f"{sink}/rejected").select(
        "request_id", F.lit(None).cast("boolean").alias("churned"), F.lit(None).cast("double").alias("churn_probability"),
        F.concat(F.lit("REJECTED: "), F.col("error")).alias("risk_level"))
    return scored.unionByName(rejected)


@register("label_sources", sql=f"""WITH {raw_users_sql()}
SELECT label_source, n, churned, round(n / sum(n) OVER (), 6) AS share FROM (
  SELECT CASE WHEN days_since_last_push IS NOT NULL THEN 'push'
              WHEN days_since_update IS NOT NULL THEN 'update' ELSE 'none' END AS label_source,
         count(*) AS n, CAST(coalesce(sum(churn), 0) AS BIGINT) AS churned
  FROM raw_users GROUP BY 1)""")
def q_label_sources(spark, sf_dir):
    return round_doubles(L.label_sources(raw_frame(spark, sf_dir)))


# ---------------------------------------------------------------- recommendation requests
from churnlens.operators import scoring as SC  # noqa: E402

_REC_ERR = """CASE WHEN rq.user_id IS NULL THEN 'user_id is required'
     WHEN rq.user_id < 0 THEN 'user_id must be >= 0'
     WHEN rq.top_n < 1 OR rq.top_n > 10 THEN 'top_n must be between 1 and 10'
     WHEN ux.username IS NULL THEN 'user_id not found' END"""


def _recommend_requests(spark, sf_dir):
    """Each event is a recommendation request for user ``user_id`` (index in login
    order) with ``top_n = floor(value) % 12`` — 0 and 11 fall outside 1..10."""
    fx = feature_frame(spark, sf_dir)
    users = LT.user_index(fx.select("username"))
    ev = load_tables(spark, sf_dir, ["events"])["events"]
    req = ev.select("event_id", "user_id", (F.floor("value").cast("int") % F.lit(12)).alias("top_n"))
    return fx, users, SC.validate_recommend_requests(req, users)


@register("recommend_request_validation", sql=f"""WITH {features_sql()},
ux AS (SELECT username, CAST(row_number() OVER (ORDER BY username) - 1 AS BIGINT) AS user_id FROM features),
rq AS (SELECT event_id, user_id, CAST(floor(value) AS INTEGER) % 12 AS top_n FROM events)
SELECT rq.user_id, rq.event_id, rq.top_n, ux.username, {_REC_ERR} AS error, ({_REC_ERR}) IS NULL AS valid
FROM rq LEFT JOIN ux ON ux.user_id = rq.user_id""")
def q_recommend_request_validation(spark, sf_dir):
    return _recommend_requests(spark, sf_dir)[2]


@register("recommend_requests")
def q_recommend_requests(spark, sf_dir):
    fx, users, checked = _recommend_requests(spark, sf_dir)
    model = M.train_and_save(fx, FINAL_FEATURES)["model"]
    per_user = LT.recommend_users(fx, model, LT.fit_svd(fx), FEATURE_COLUMNS, SC.TOP_N_MAX)
    return SC.answer_recommend_requests(checked, per_user)


# ---------------------------------------------------------------- file round trips
from churnlens.sources import files as FS  # noqa: E402
from churnlens.session import scratch_path as _scratch  # noqa: E402

_TEXT = ["username", "created_at", "updated_at", "bio", "blog", "company", "email"]
_TOKENS = ", ".join("'" + t.replace("'", "''") + "'" for t in FS.NULL_TOKENS)


@register("raw_users_csv_roundtrip", sql=f"""WITH {raw_users_sql()},
hard AS (SELECT * REPLACE (CASE WHEN bio = 'BUILDING' THEN 'line one' || chr(10) || 'line "two", end' ELSE bio END AS bio,
                           CASE WHEN company IS NOT NULL THEN 'a "' || company || '", ok' END AS company) FROM raw_users)
SELECT {", ".join(f"CASE WHEN {c} IN ({_TOKENS}) THEN NULL ELSE {c} END AS {c}" if c in _TEXT else c
                  for c in RAW_COLUMNS)}
FROM hard""")
def q_raw_users_csv_roundtrip(spark, sf_dir):
    """The raw table, with quotes, commas and line breaks in its texts, written as CSV and read back
    with the missing-token rules."""
    path = _scratch(spark, "raw-csv", track=True)
    hard = raw_frame(spark, sf_dir).withColumns({
        "bio": F.when(F.col("bio") == "BUILDING", F.lit('line one\nline "two", end')).otherwise(F.col("bio")),
        "company": F.concat(F.lit('a "'), F.col("company"), F.lit('", ok'))})
    FS.write_table(hard, path, fmt="csv")
    return FS.read_raw_users(spark, path)


@register("feature_table_roundtrip", sql=f"""WITH {features_sql()}
SELECT username, {rounded(DOUBLE_FEATURES)}, CAST(has_no_repos AS DOUBLE) AS has_no_repos,
       CAST(has_complete_profile AS DOUBLE) AS has_complete_profile, churn FROM features""")
def q_feature_table_roundtrip(spark, sf_dir):
    """The feature table written as CSV and loaded again."""
    path = _scratch(spark, "features-csv", track=True)
    FS.write_table(feature_frame(spark, sf_dir), path, fmt="csv")
    return round_doubles(FS.load_feature_matrix(spark, path, None, AS_OF))


@register("feature_matrix_from_raw", sql=f"""WITH {features_sql()}
SELECT username, {rounded(DOUBLE_FEATURES)}, has_no_repos, has_complete_profile, churn FROM features""")
def q_feature_matrix_from_raw(spark, sf_dir):
    """No feature table yet: the loader falls back to building features from the written raw table."""
    raw_path = _scratch(spark, "raw-parquet", track=True)
    FS.write_table(raw_frame(spark, sf_dir), raw_path)
    missing = _scratch(spark, "no-features")
    return round_doubles(FS.load_feature_matrix(spark, missing, raw_path, AS_OF))


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Train, save the pipeline to the shared folder, load it back and score every user with it."""
    fx = feature_frame(spark, sf_dir)
    path = _scratch(spark, "model", track=True)
    M.train_and_save(fx, FINAL_FEATURES, model_path=path)
    return M.score_users(M.load_model(path, spark), fx.select("username", *FINAL_FEATURES))


@register("latent_roundtrip")
def q_latent_roundtrip(spark, sf_dir):
    """Publish model and latent tables as one set of versioned artefacts, read the current set back and recommend from it."""
    from churnlens.sources.artefacts import Artefacts
    fx = feature_frame(spark, sf_dir)
    fit = LT.fit_svd(fx)
    store = Artefacts(spark, _scratch(spark, "artefacts", track=True))
    M.train_and_save(fx, FINAL_FEATURES, store=store)
    v_rows = spark.createDataFrame([(i, [float(x) for x in fit.v[i]]) for i in range(len(fit.cols))],
                                   "row int, v array<double>")
    FS.publish_latent(store, LT.svd_reconstruct(fx, fit), v_rows)
    latent, model = FS.load_latent(spark, store.root), M.load_model(store.root, spark)
    scores = M.predict(model, fx.select("username", *FINAL_FEATURES))
    return LT.recommend(LT.user_index(fx.select("username")), scores, latent, FEATURE_COLUMNS, 5)
