"""SQL fragments (DuckDB dialect) that restate the demo mapping and base tables.

Each oracle query is ``WITH <fragments> SELECT ...``; the fragments are written
independently of the Spark code so the twin checks the DataFrame plan.
"""

from churnlens.schemas import FEATURE_COLUMNS

AS_OF_SQL = "TIMESTAMP '2002-01-01 00:00:00'"


def days_sql(ts: str) -> str:
    return f"CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us({ts})) / 86400000000.0) AS BIGINT)"


def present_sql(c: str) -> str:
    return f"(CASE WHEN {c} IS NOT NULL AND regexp_matches({c}, '[^\\s]') AND {c} <> 'None' THEN 1 ELSE 0 END)"


PROFILES = f"""
o_f AS (SELECT o_custkey AS custkey, min(o_orderdate) AS first_order,
               count(*) FILTER (WHERE o_orderstatus = 'F') AS finished
        FROM orders GROUP BY o_custkey),
l_f AS (SELECT o.o_custkey AS custkey, max(l.l_shipdate) AS last_ship,
               count(DISTINCT CASE WHEN l.l_returnflag = 'R' THEN l.l_suppkey END) AS following,
               count(*) FILTER (WHERE l.l_returnflag = 'R' AND l.l_linestatus = 'F') AS public_gists
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey),
ev AS (SELECT user_id AS custkey, count(*) AS followers FROM events GROUP BY user_id),
profiles AS (
  SELECT c.c_name AS login,
         CASE WHEN c.c_mktsegment = 'MACHINERY' THEN 'Organization' ELSE 'User' END AS type,
         CAST(coalesce(o_f.finished, 0) AS BIGINT) AS public_repos,
         CAST(l_f.public_gists AS BIGINT) AS public_gists,
         CAST(ev.followers AS BIGINT) AS followers,
         CAST(l_f.following AS BIGINT) AS following,
         strftime(o_f.first_order, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
         strftime(l_f.last_ship, '%Y-%m-%dT%H:%M:%SZ') AS updated_at,
         CASE c.c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN 'None'
              ELSE c.c_mktsegment END AS bio,
         d.source AS blog,
         CASE WHEN c.c_acctbal >= 0 THEN n.n_name END AS company,
         CAST(NULL AS VARCHAR) AS email,
         CAST(lb.quality AS BOOLEAN) AS hireable
  FROM customer c
  LEFT JOIN o_f ON o_f.custkey = c.c_custkey
  LEFT JOIN l_f ON l_f.custkey = c.c_custkey
  LEFT JOIN ev ON ev.custkey = c.c_custkey
  LEFT JOIN documents d ON d.doc_id = c.c_custkey
  LEFT JOIN labels lb ON lb.doc_id = c.c_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey),
repos AS (
  SELECT c.c_name AS owner, strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS pushed_at,
         o.o_orderpriority AS language
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey)"""


def raw_users_sql(threshold: int = 365, repos: bool = True) -> str:
    push = "days_since_last_push" if repos else "NULL"
    lp_join = "LEFT JOIN lp ON lp.username = p.login" if repos else ""
    push_col = days_sql("lp.last_pushed_at") if repos else "CAST(NULL AS BIGINT)"
    return f"""{PROFILES},
lp AS (SELECT owner AS username, max(try_cast(pushed_at AS TIMESTAMP)) AS last_pushed_at
       FROM repos GROUP BY owner),
parsed AS (
  SELECT p.login AS username, public_repos, public_gists, followers, following, created_at,
         updated_at, bio, blog, company, email, hireable,
         {days_sql("try_cast(updated_at AS TIMESTAMP)")} AS days_since_update,
         {push_col} AS days_since_last_push
  FROM profiles p {lp_join}
  WHERE p.type = 'User'),
raw_users AS (
  SELECT *, CASE WHEN coalesce({push}, days_since_update) > {int(threshold)} THEN 1 ELSE 0 END AS churn
  FROM parsed)"""


FEATURE_NAMES = list(FEATURE_COLUMNS)
DOUBLE_FEATURES = FEATURE_NAMES[:8]


def features_sql(threshold: int = 365) -> str:
    """CTEs ending in ``features`` (username, ten features, churn), medians filled."""
    comp = " + ".join([present_sql("bio"), present_sql("blog"), present_sql("company"),
                       "(CASE WHEN hireable IS NOT NULL THEN 1 ELSE 0 END)"])
    return f"""{raw_users_sql(threshold)},
fx AS (
  SELECT username, churn,
         greatest(coalesce(CAST(public_repos AS DOUBLE), 0.0), 0.0) AS pr,
         greatest(coalesce(CAST(followers AS DOUBLE), 0.0), 0.0) AS fo,
         greatest(coalesce(CAST(following AS DOUBLE), 0.0), 0.0) AS fi,
         greatest(coalesce(CAST(public_gists AS DOUBLE), 0.0), 0.0) AS gi,
         CAST({days_sql("try_cast(updated_at AS TIMESTAMP)")} AS DOUBLE) AS upd_days,
         CAST({days_sql("try_cast(created_at AS TIMESTAMP)")} AS DOUBLE) AS age_days,
         CAST({comp} AS DOUBLE) AS comp
  FROM raw_users),
f0 AS (
  SELECT username,
         fo / (fi + 1) AS follower_ratio,
         (fo + fi) / (pr + 1) AS engagement_ratio,
         upd_days AS days_since_last_activity,
         age_days AS account_age_days,
         CASE WHEN age_days IS NOT NULL THEN pr / (greatest(age_days, 1.0) / 365.25) END AS activity_frequency,
         CASE WHEN age_days IS NOT NULL THEN pr / (greatest(age_days, 1.0) / 365.25) END AS repos_per_year,
         ln(1 + fo + fi + gi) AS social_volume,
         comp AS profile_completeness,
         CAST(pr = 0 AS INTEGER) AS has_no_repos,
         CAST(comp = 4 AS INTEGER) AS has_complete_profile,
         churn
  FROM fx),
med AS (SELECT {", ".join(f"median({c}) AS m_{c}" for c in DOUBLE_FEATURES)} FROM f0),
features AS (
  SELECT username,
         {", ".join(f"coalesce({c}, m_{c}, 0.0) AS {c}" for c in DOUBLE_FEATURES)},
         has_no_repos, has_complete_profile, churn
  FROM f0, med)"""


def rounded(cols, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


RAW_NUMERIC = ["public_repos", "public_gists", "followers", "following", "days_since_update", "days_since_last_push"]
RAW_COLUMNS = ["username", "public_repos", "public_gists", "followers", "following", "created_at", "updated_at",
               "bio", "blog", "company", "email", "hireable", "days_since_update", "days_since_last_push", "churn"]
# Spark simpleString type names of the raw-user columns
RAW_TYPES = {"username": "string", "public_repos": "bigint", "public_gists": "bigint", "followers": "bigint",
             "following": "bigint", "created_at": "string", "updated_at": "string", "bio": "string",
             "blog": "string", "company": "string", "email": "string", "hireable": "boolean",
             "days_since_update": "bigint", "days_since_last_push": "bigint", "churn": "int"}


def describe_sql(table: str, cols, d: int = 6) -> str:
    parts = [f"""SELECT '{c}' AS field, count(v) AS count, round(avg(v), {d}) AS mean,
       round(stddev_samp(v), {d}) AS std, round(min(v), {d}) AS min, round(quantile_cont(v, 0.25), {d}) AS p25,
       round(quantile_cont(v, 0.5), {d}) AS p50, round(quantile_cont(v, 0.75), {d}) AS p75, round(max(v), {d}) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS v FROM {table})""" for c in cols]
    return "\nUNION ALL\n".join(parts)


def histogram_sql(table: str, cols, by: str | None = None, bins: int = 40) -> str:
    k = f"{by}, " if by else ""
    long = "\nUNION ALL\n".join(
        f"SELECT {k}'{c}' AS field, CAST({c} AS DOUBLE) AS v FROM {table} WHERE {c} IS NOT NULL" for c in cols)
    return f"""hl AS ({long}),
hr AS (SELECT {k}field, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
              CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi
       FROM hl GROUP BY {k}field),
hb AS (SELECT {k}field, lo, hi, CAST(least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin
       FROM hl JOIN hr USING ({k}field))
SELECT {k}field, bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_lo,
       round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS bin_hi, count(*) AS count
FROM hb GROUP BY {k}field, bin, lo, hi"""


def cohort_sql(c) -> str:
    """SQL predicate over ``profiles`` for one cohort (restated independently)."""
    parts = ["type = 'User'"]
    if c.followers is not None:
        parts.append(f"coalesce(followers, 0) BETWEEN {c.followers[0]} AND {c.followers[1]}")
    if c.repos is not None:
        parts.append(f"coalesce(public_repos, 0) BETWEEN {c.repos[0]} AND {c.repos[1]}")
    if c.created_before is not None:
        parts.append(f"try_cast(created_at AS TIMESTAMP) < TIMESTAMP '{c.created_before} 00:00:00'")
    if c.language is not None:
        parts.append(f"login IN (SELECT owner FROM repos WHERE language = '{c.language}')")
    return " AND ".join(parts)


PARSED_COLS = ("username, public_repos, public_gists, followers, following, created_at, updated_at, bio, blog, "
               "company, email, hireable, days_since_update, days_since_last_push")


def collected_sql(cohorts, threshold: int = 365) -> str:
    """CTEs ending in ``cand`` (candidate logins) and ``base`` (collected, labelled users)."""
    cand = "\n  UNION\n  ".join(f"SELECT login AS username FROM profiles WHERE {cohort_sql(c)}" for c in cohorts)
    return f"""{raw_users_sql(threshold)},
cand AS (
  {cand}),
base AS (SELECT * FROM raw_users WHERE username IN (SELECT username FROM cand))"""


def balance_sql(cohorts, inactive, min_ratio: float, threshold: int = 365, cap: int | None = None) -> str:
    adj = threshold - 90
    eff = adj if adj >= 90 else threshold
    batches = []
    seen = ["SELECT username FROM base"]
    for b, c in enumerate(inactive, start=1):
        excl = " AND ".join(f"login NOT IN ({s})" for s in seen)
        limit = "" if cap is None else f" ORDER BY login LIMIT {cap}"
        batches.append(f"b{b} AS (SELECT login FROM profiles WHERE {cohort_sql(c)} AND {excl}{limit})")
        seen.append(f"SELECT login FROM b{b}")
    bunion = " UNION ALL ".join(f"SELECT login, {b} AS batch FROM b{b}" for b in range(1, len(inactive) + 1))
    relabel_ok = "CASE WHEN adj_ok THEN 1 ELSE 0 END"
    return f"""{collected_sql(cohorts, threshold)},
r0 AS (SELECT coalesce(avg(CAST(churn AS DOUBLE)), 0.0) AS r, count(*) AS n0 FROM base),
relab AS (SELECT {PARSED_COLS},
          CASE WHEN coalesce(days_since_last_push, days_since_update) > {eff} THEN 1 ELSE 0 END AS churn FROM base),
r1 AS (SELECT coalesce(avg(CAST(churn AS DOUBLE)), 0.0) AS r, coalesce(sum(churn), 0) AS c0 FROM relab),
{", ".join(batches)},
bl AS ({bunion}),
extras AS (
  SELECT p.login AS username, public_repos, public_gists, followers, following, created_at, updated_at, bio,
         blog, company, email, hireable,
         {days_sql("try_cast(updated_at AS TIMESTAMP)")} AS days_since_update,
         CAST(NULL AS BIGINT) AS days_since_last_push,
         CASE WHEN {days_sql("try_cast(updated_at AS TIMESTAMP)")} > {eff} THEN 1 ELSE 0 END AS churn,
         bl.batch
  FROM profiles p JOIN bl ON bl.login = p.login WHERE p.type = 'User'),
bs AS (SELECT batch, count(*) AS n, sum(churn) AS c FROM extras GROUP BY batch),
cum AS (SELECT batch, (SELECT n0 FROM r0) + sum(n) OVER (ORDER BY batch) AS n,
               (SELECT c0 FROM r1) + sum(c) OVER (ORDER BY batch) AS c FROM bs),
keep AS (SELECT coalesce(min(batch) FILTER (WHERE c / n >= {min_ratio}), {len(inactive)}) AS k FROM cum),
final AS (
  SELECT {PARSED_COLS}, churn, 0 AS balance_pass, {threshold} AS threshold FROM base
  WHERE (SELECT r FROM r0) >= {min_ratio}
  UNION ALL
  SELECT {PARSED_COLS}, churn, 1, {eff} FROM relab
  WHERE (SELECT r FROM r0) < {min_ratio} AND {"TRUE" if adj >= 90 else "FALSE"} AND (SELECT r FROM r1) >= {min_ratio}
  UNION ALL
  SELECT {PARSED_COLS}, churn, 2, {eff} FROM {"relab" if adj >= 90 else "base"}
  WHERE (SELECT r FROM r0) < {min_ratio} AND NOT ({"TRUE" if adj >= 90 else "FALSE"} AND (SELECT r FROM r1) >= {min_ratio})
  UNION ALL
  SELECT {PARSED_COLS}, churn, 2, {eff} FROM extras
  WHERE (SELECT r FROM r0) < {min_ratio} AND NOT ({"TRUE" if adj >= 90 else "FALSE"} AND (SELECT r FROM r1) >= {min_ratio})
    AND batch <= (SELECT k FROM keep))"""


def graph_sql(threshold: int = 365, hubs: int = 5, skip_top: int = 1) -> str:
    """CTEs ``nodes``, ``top``, ``edges`` over the raw users."""
    return f"""{raw_users_sql(threshold)},
nodes AS (SELECT username, churn, CAST(coalesce(followers, 0) AS BIGINT) AS followers,
                 CAST(coalesce(following, 0) AS BIGINT) AS following,
                 CAST(coalesce(public_repos, 0) AS BIGINT) AS repos FROM raw_users),
top AS (SELECT username AS dst, CAST(row_number() OVER (ORDER BY followers DESC, username) - 1 AS INTEGER) AS pos
        FROM (SELECT * FROM nodes ORDER BY followers DESC, username LIMIT {skip_top + hubs})),
edges AS (SELECT DISTINCT n.username AS src, t.dst FROM nodes n JOIN top t
          ON n.following > 0 AND t.pos BETWEEN {skip_top} AND least(n.following, {hubs}) + {skip_top - 1}
          WHERE t.dst <> n.username)"""


PAGERANK_MAX, PAGERANK_TOL = 100, 1.0e-6


def pagerank_ctes(alpha: float = 0.85) -> str:
    """CTEs ending in ``pr``: every round up to the limit, and the first whose L1 change is below n · tol."""
    ctes = [f"""od AS MATERIALIZED (SELECT src, count(*) AS outdeg FROM edges GROUP BY src),
ew AS MATERIALIZED (SELECT e.src, e.dst, 1.0 / od.outdeg AS w FROM edges e JOIN od USING (src)),
nd AS MATERIALIZED (SELECT username, od.src IS NULL AS dangling FROM nodes LEFT JOIN od ON od.src = username),
nn AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes),
x0 AS MATERIALIZED (SELECT username, dangling, 1.0 / (SELECT n FROM nn) AS rank, CAST(NULL AS DOUBLE) AS old FROM nd)"""]
    for i in range(1, PAGERANK_MAX + 1):
        p = f"x{i - 1}"
        ctes.append(f"""x{i} AS MATERIALIZED (
  SELECT p.username, p.dangling,
         CAST({alpha} AS DOUBLE) * coalesce(c.c, 0.0)
         + (CAST({alpha} AS DOUBLE) * (SELECT coalesce(sum(rank), 0.0) FROM {p} WHERE dangling)
            / (SELECT n FROM nn) + (1.0 - CAST({alpha} AS DOUBLE)) / (SELECT n FROM nn)) AS rank, p.rank AS old
  FROM {p} p LEFT JOIN (SELECT ew.dst AS username, sum({p}.rank * ew.w) AS c
                        FROM ew JOIN {p} ON {p}.username = ew.src GROUP BY ew.dst) c USING (username))""")
    rounds = " UNION ALL ".join(f"SELECT {i} AS i, * FROM x{i}" for i in range(1, PAGERANK_MAX + 1))
    ctes.append(f"xs AS MATERIALIZED ({rounds})")
    ctes.append(f"""stop AS (SELECT min(i) AS i FROM (SELECT i, sum(abs(rank - old)) AS err FROM xs GROUP BY i)
         WHERE err < (SELECT n FROM nn) * {PAGERANK_TOL})""")
    ctes.append("pr AS (SELECT username, rank AS pagerank FROM xs WHERE i = (SELECT i FROM stop))")
    return ",\n".join(ctes)


DEGREE_CTES = """odg AS (SELECT src AS username, count(*) AS out_degree FROM edges GROUP BY src),
idg AS (SELECT dst AS username, count(*) AS in_degree FROM edges GROUP BY dst),
dg AS (SELECT username, coalesce(in_degree, 0) AS in_degree, coalesce(out_degree, 0) AS out_degree,
       (coalesce(in_degree, 0) + coalesce(out_degree, 0)) * (1.0 / ((SELECT count(*) FROM nodes) - 1)) AS degree_centrality
       FROM nodes LEFT JOIN odg USING (username) LEFT JOIN idg USING (username))"""


HASH_SQL = "CAST(('0x' || substr(md5('42:' || username), 1, 13)) AS BIGINT)"


def betweenness_ctes(k: int = 50, depth: int = 8) -> str:
    """CTEs ending in ``bt``: sampled-source Brandes, levels and backward sweep unrolled to ``depth`` levels."""
    ctes = [f"src AS (SELECT username AS source FROM nodes ORDER BY {HASH_SQL}, username LIMIT {k})",
            "L0 AS MATERIALIZED (SELECT source, source AS node, CAST(1.0 AS DOUBLE) AS sigma FROM src)",
            "V0 AS MATERIALIZED (SELECT source, node FROM L0)"]
    for d in range(1, depth + 1):
        ctes.append(f"""L{d} AS MATERIALIZED (
  SELECT l.source, e.dst AS node, sum(l.sigma) AS sigma
  FROM L{d - 1} l JOIN edges e ON e.src = l.node
  LEFT JOIN V{d - 1} v ON v.source = l.source AND v.node = e.dst
  WHERE v.node IS NULL GROUP BY l.source, e.dst)""")
        ctes.append(f"V{d} AS MATERIALIZED (SELECT source, node FROM V{d - 1} UNION ALL SELECT source, node FROM L{d})")
    ctes.append(f"D{depth} AS MATERIALIZED (SELECT source, node, sigma, CAST(0.0 AS DOUBLE) AS delta FROM L{depth})")
    for d in range(depth - 1, -1, -1):
        ctes.append(f"""D{d} AS MATERIALIZED (
  SELECT h.source, h.node, h.sigma, coalesce(c.delta, 0.0) AS delta
  FROM L{d} h LEFT JOIN (
    SELECT h.source, h.node, sum(h.sigma / w.sigma * (1 + w.delta)) AS delta
    FROM L{d} h JOIN edges e ON e.src = h.node JOIN D{d + 1} w ON w.source = h.source AND w.node = e.dst
    GROUP BY h.source, h.node) c ON c.source = h.source AND c.node = h.node)""")
    union = " UNION ALL ".join(f"SELECT source, node, delta FROM D{d}" for d in range(0, depth + 1))
    ctes.append(f"tot AS (SELECT node, sum(delta) AS b FROM ({union}) WHERE node <> source GROUP BY node)")
    ctes.append("bn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM nodes)")
    scale = (f"(CASE WHEN (SELECT n FROM bn) > 2 THEN 1.0 / (((SELECT n FROM bn) - 1) * ((SELECT n FROM bn) - 2)) "
             f"ELSE 1.0 END) * (CASE WHEN {k} < (SELECT n FROM bn) THEN (SELECT n FROM bn) / {k} ELSE 1.0 END)")
    ctes.append(f"""bt AS (SELECT n.username, coalesce(tot.b, 0.0) * {scale} AS betweenness_centrality
         FROM nodes n LEFT JOIN tot ON tot.node = n.username)""")
    return ",\n".join(ctes)


def network_ctes() -> str:
    """CTEs ending in ``net``: nodes with the three centralities."""
    return f"""{graph_sql()}, {DEGREE_CTES}, {pagerank_ctes()}, {betweenness_ctes()},
net AS MATERIALIZED (SELECT nodes.*, degree_centrality, betweenness_centrality, pagerank
        FROM nodes JOIN dg USING (username) JOIN bt USING (username) JOIN pr USING (username))"""


def eigen_ctes(table: str, cols, sweeps: int = 12) -> str:
    """CTEs ``gram`` (a: the matrix of sums of products of the columns of ``table``) and ``eig`` (k from 1, value,
    vec): its eigenvalues, largest first, and eigenvectors by cyclic Jacobi rotations, one a recursive step.
    The largest entry of a vector (the first of those that tie) is positive.  Needs WITH RECURSIVE."""
    d = len(cols)
    pairs = [(p, q) for p in range(1, d + 1) for q in range(p + 1, d + 1)]
    rows = ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in cols) + "]" for a in cols)
    unit = ", ".join("[" + ", ".join("1.0::DOUBLE" if i == j else "0.0::DOUBLE" for j in range(d)) + "]" for i in range(d))

    def columns(m):  # columns p and q of a matrix turned
        return (f"list_transform({m}, lambda row: list_transform(row, lambda x, j: CASE WHEN j = p THEN c * row[p] - s * row[q] "
                "WHEN j = q THEN s * row[p] + c * row[q] ELSE x END))")

    return f"""gram AS (SELECT CAST([{rows}] AS DOUBLE[][]) AS a FROM {table}),
turn AS (SELECT list_extract([{", ".join(str(p) for p, _ in pairs)}], n + 1) AS p,
                list_extract([{", ".join(str(q) for _, q in pairs)}], n + 1) AS q, n FROM (SELECT unnest(range(0, {len(pairs)})) AS n)),
jac(step, a, v) AS (
  SELECT 0, a, [{unit}] FROM gram
  UNION ALL
  SELECT step + 1, list_transform(b, lambda row, i: CASE WHEN i = p THEN list_transform(b[p], lambda x, j: c * x - s * b[q][j])
           WHEN i = q THEN list_transform(b[q], lambda x, j: s * b[p][j] + c * x) ELSE row END), w
  FROM (SELECT step, p, q, c, s, {columns("a")} AS b, {columns("v")} AS w
    FROM (SELECT *, t / sqrt(t * t + 1) AS s, 1 / sqrt(t * t + 1) AS c
      FROM (SELECT step, a, v, p, q, CASE WHEN abs(a[p][q]) < 1e-300 THEN 0.0 ELSE
              (CASE WHEN a[q][q] >= a[p][p] THEN 1.0 ELSE -1.0 END)
              / (abs(a[q][q] - a[p][p]) / (2 * abs(a[p][q])) + sqrt(1 + ((a[q][q] - a[p][p]) / (2 * a[p][q])) ** 2))
              * sign(a[p][q]) END AS t
            FROM jac JOIN turn ON turn.n = step % {len(pairs)} WHERE step < {sweeps * len(pairs)})))),
eig0 AS (SELECT i, a[i][i] AS value, [row[i] FOR row IN v] AS vec FROM jac, (SELECT unnest(range(1, {d + 1})) AS i) n
         WHERE step = {sweeps * len(pairs)}),
eig AS (SELECT row_number() OVER (ORDER BY value DESC) AS k, value,
               list_transform(vec, lambda x: x * sign(vec[list_position([abs(y) >= list_max([abs(z) FOR z IN vec]) - 1e-9 FOR y IN vec], true)])) AS vec
        FROM eig0)"""
