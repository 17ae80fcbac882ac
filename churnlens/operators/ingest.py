"""Collection over landed profile / repo tables (SRC4-SRC7, FIL2, SET1-3, JOIN1-2)
and class-balance repair (BAL1-BAL3).

The reference searches a remote API with query strings and fetches profiles one
by one.  Here the landed tables are the population: a cohort is a Column
predicate (plus a left-semi join for the repo-language filter), the candidate
set is a union + de-duplication, and "fetching" is a join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.scalars import as_of_lit, parse_ts
from churnlens.session import materialize
from churnlens.operators.labels import (
    DEFAULT_THRESHOLD, assign_labels, parse_users, user_accounts,
)


@dataclass(frozen=True)
class Cohort:
    """One search filter: closed numeric ranges, a creation bound, a repo language."""
    followers: tuple[int, int] | None = None
    repos: tuple[int, int] | None = None
    created_before: str | None = None
    language: str | None = None
    name: str = ""


# The four collection cohorts and the three inactivity cohorts,
# with dates and languages restated for the demo tables (orders span 1995-2001,
# languages are order priorities).
DEFAULT_COHORTS = [
    Cohort(followers=(1, 100), language="1-URGENT", name="active_lang_a"),
    Cohort(followers=(1, 50), language="2-HIGH", name="active_lang_b"),
    Cohort(created_before="1995-06-01", repos=(1, 8), name="old_accounts"),
    Cohort(created_before="1995-04-01", followers=(0, 10), name="old_low_followers"),
]
INACTIVE_COHORTS = [
    Cohort(followers=(0, 3), repos=(1, 3), created_before="1995-06-01", name="inactive_a"),
    Cohort(followers=(0, 5), repos=(0, 2), created_before="1995-03-01", name="inactive_b"),
    Cohort(repos=(0, 1), followers=(0, 0), created_before="1995-09-01", name="inactive_c"),
]
PASS1_STEP = 90
PASS1_FLOOR = 90


def _conditions(c: Cohort):
    """A cohort's ranges and creation bound, on profiles and raw users alike."""
    cond = F.lit(True)
    if c.followers is not None:
        cond = cond & F.coalesce(F.col("followers"), F.lit(0)).between(*c.followers)
    if c.repos is not None:
        cond = cond & F.coalesce(F.col("public_repos"), F.lit(0)).between(*c.repos)
    if c.created_before is not None:
        cond = cond & (parse_ts("created_at") < as_of_lit(c.created_before))
    return cond


def _predicate(c: Cohort, lang_col: str | None = None):
    """Column predicate of one cohort; the language test reads ``lang_col`` when given."""
    cond = (F.col("type") == "User") & _conditions(c)
    if c.language is not None and lang_col is not None:
        cond = cond & F.coalesce(F.col(lang_col), F.lit(False))
    return cond


def cohort_members(profiles: DataFrame, repos: DataFrame | None, cohort: Cohort) -> DataFrame:
    """Profiles matching one cohort (individual accounts only, as the filters say)."""
    out = profiles.where(_predicate(cohort))
    if cohort.language is not None:
        if repos is None:
            raise ValueError("a language cohort needs the repos table")
        langs = repos.where(F.col("language") == cohort.language).select(F.col("owner").alias("login"))
        out = out.join(langs, "login", "left_semi")
    return out


def cohort_flags(profiles: DataFrame, repos: DataFrame | None, cohorts=DEFAULT_COHORTS) -> DataFrame:
    """Profiles with one boolean column per cohort, in a single pass.

    Language filters become one aggregate over repos (per owner: does any repo
    use language X), joined once; the other filters are column predicates.
    """
    langs = sorted({c.language for c in cohorts if c.language is not None})
    p = profiles
    if langs:
        if repos is None:
            raise ValueError("a language cohort needs the repos table")
        per_owner = repos.groupBy(F.col("owner").alias("login")).agg(
            *[F.max((F.col("language") == F.lit(x)).cast("int")).cast("boolean").alias(f"_lang{i}")
              for i, x in enumerate(langs)])
        p = p.join(per_owner, "login", "left")
    flags = [_predicate(c, f"_lang{langs.index(c.language)}" if c.language is not None else None)
             .alias(f"cohort{i}") for i, c in enumerate(cohorts)]
    return p.select(*profiles.columns, *flags)


def candidate_users(profiles: DataFrame, repos: DataFrame | None, cohorts=DEFAULT_COHORTS) -> DataFrame:
    """Logins matching any cohort, one row per user (the union of the cohort results)."""
    f = cohort_flags(profiles, repos, cohorts)
    any_ = F.lit(False)
    for i in range(len(cohorts)):
        any_ = any_ | F.col(f"cohort{i}")
    return f.where(any_).select(F.col("login").alias("username")).distinct()


def recent_repos(repos: DataFrame, n: int = 30) -> DataFrame:
    """Newest ``n`` repos per owner by push date (NULL dates last).

    ``row_number() <= n`` is planned as a WindowGroupLimit, which trims every
    owner to ``n`` rows on the map side before the shuffle, so an owner with a
    third of all repos sends at most ``n`` rows per task.
    """
    w = Window.partitionBy("owner").orderBy(F.desc_nulls_last(parse_ts("pushed_at")),
                                            F.desc_nulls_last("pushed_at"), F.asc_nulls_last("language"))
    return repos.withColumn("recency_rank", F.row_number().over(w)).where(F.col("recency_rank") <= n)


def fresh_candidates(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates not already known (left anti join on the key)."""
    return candidates.join(known.select("username"), "username", "left_anti")


def collect_dataset(profiles: DataFrame, repos: DataFrame | None, as_of, cohorts=DEFAULT_COHORTS,
                    target_records: int | None = None, threshold_days: int = DEFAULT_THRESHOLD,
                    fetch_repos: bool = True) -> DataFrame:
    """Candidates → user profiles (optionally capped) → flat rows → labels.

    ``target_records`` caps the number of *user* profiles, taken in login order
    (a top-k, planned as TakeOrderedAndProject); None keeps every candidate.
    """
    f = cohort_flags(profiles, repos, cohorts)
    any_ = F.lit(False)
    for i in range(len(cohorts)):
        any_ = any_ | F.col(f"cohort{i}")
    users = user_accounts(f.where(any_).select(*profiles.columns).dropDuplicates(["login"]))
    if target_records is not None:
        users = users.orderBy("login").limit(int(target_records))
    return assign_labels(parse_users(users, repos if fetch_repos else None, as_of), threshold_days)


def _capped(extras: DataFrame, match: list, cap: int) -> DataFrame:
    """The first ``cap`` users, in login order, of each cohort in turn among those that no earlier batch took."""
    taken = extras.limit(0)
    for b, m in enumerate(match, start=1):
        here = extras.where(m).join(taken.select("username"), "username", "left_anti")
        taken = taken.unionByName(here.orderBy("username").limit(cap).withColumn("_batch", F.lit(b)))
    return taken


@dataclass
class BalanceResult:
    df: DataFrame
    ratio: float
    threshold: int
    passes: int


def fix_low_churn_ratio(df: DataFrame, profiles: DataFrame, as_of, current_threshold: int = DEFAULT_THRESHOLD,
                        min_churn_ratio: float = 0.10, inactive_cohorts=INACTIVE_COHORTS,
                        batch_cap: int | None = None) -> BalanceResult:
    """Three-pass repair of a low churned share.

    pass 0: accept when the share reaches the minimum;
    pass 1: relabel with the threshold lowered by 90 days (only if that stays ≥ 90);
    pass 2: append unseen users from each inactivity cohort in turn (all of them;
            the first ``batch_cap`` logins of each only if the caller asks for that),
            labelled from the update date only, and keep batches up to the first one
            after which the share reaches the minimum.
    The collected table is written once; one aggregate over it gives the shares at both
    thresholds.  Pass 2 marks each unseen user with the first cohort that matches it, in one plan with one
    anti-join, and reads one summary row per cohort.
    """
    adjusted = current_threshold - PASS1_STEP
    can_adjust = adjusted >= PASS1_FLOOR
    effective = adjusted if can_adjust else current_threshold
    base = materialize(df, "balance-base")
    relabelled = assign_labels(base.drop("churn"), effective) if can_adjust else base
    both = assign_labels(base.withColumnRenamed("churn", "_before"), effective) if can_adjust \
        else base.withColumn("_before", F.col("churn"))
    s = both.withColumnRenamed("churn", "_after").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_before"), F.lit(0)).alias("b"),
                 F.coalesce(F.sum("_after"), F.lit(0)).alias("a")).first()
    share = lambda c: c / s["n"] if s["n"] else 0.0
    if share(s["b"]) >= min_churn_ratio:
        return BalanceResult(base, share(s["b"]), current_threshold, 0)
    if can_adjust and share(s["a"]) >= min_churn_ratio:
        return BalanceResult(relabelled, share(s["a"]), adjusted, 1)
    base = relabelled
    if any(c.language is not None for c in inactive_cohorts):
        raise ValueError("an inactivity cohort has no language test")
    # all cohorts in one plan: the users that any of them matches and the base does not know, written once
    match = [_conditions(c) for c in inactive_cohorts]
    any_ = F.lit(False)
    for m in match:
        any_ = any_ | m
    fresh = user_accounts(profiles.where(any_)).join(base.select(F.col("username").alias("login")), "login", "left_anti")
    first = F.coalesce(*[F.when(m, F.lit(b)) for b, m in enumerate(match, start=1)], F.lit(None).cast("int"))
    extras = materialize(assign_labels(parse_users(fresh, None, as_of), effective).withColumn("_batch", first), "balance-extras")
    if batch_cap is not None:
        extras = _capped(extras, match, int(batch_cap))
    stats = {r["_batch"]: (r["n"], r["c"]) for r in
             extras.groupBy("_batch").agg(F.count(F.lit(1)).alias("n"), F.sum("churn").alias("c")).collect()}
    n, c = s["n"], s["a"]
    keep = len(inactive_cohorts)
    for b in range(1, len(inactive_cohorts) + 1):
        bn, bc = stats.get(b, (0, 0))
        n, c = n + bn, c + (bc or 0)
        if n > s["n"] and c / n >= min_churn_ratio:
            keep = b
            break
    out = base.unionByName(extras.where(F.col("_batch") <= keep).drop("_batch"))
    return BalanceResult(out, c / n if n else 0.0, effective, 2)
