"""Driver tables → the landed ``profiles`` and ``repos`` tables.

The driver's TPC-H-like tables carry no user profiles, so a fixed mapping
supplies them (SURVEY §7.2).  Every field is an aggregate or lookup keyed by
customer, so the work grows with the tables:

* username = ``c_name``; type = Organization for the MACHINERY segment, else User
* repos = orders (owner = customer, pushed_at = order date, language = priority)
* public_repos = finished orders; followers = events of the user (NULL if none)
* following = distinct suppliers of returned lines; public_gists = returned
  and finished lines; created_at = first order; updated_at = last ship date
* bio by ``c_custkey % 5``: NULL, two spaces, 'None', segment, segment
* blog = document source, company = nation name when the balance is not
  negative, hireable = label quality
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.functions.scalars import iso_of
from churnlens.session import size_shuffle_partitions, table_path

# Reference instant for the demo data (after the last ship date).
AS_OF = "2002-01-01T00:00:00Z"

TABLES = ["customer", "orders", "lineitem", "events", "documents", "labels", "nation"]


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    paths = {n: table_path(sf_dir, n) for n in names}
    size_shuffle_partitions(spark, list(paths.values()))
    return {n: spark.read.parquet(p) for n, p in paths.items()}


def _line_facts(t) -> DataFrame:
    """Per customer: last ship date, returned+finished lines, distinct suppliers of returned lines.

    lineitem ⋈ orders on the order key (both sides shuffle on it, AQE splits a
    skewed key), then one aggregate by customer; the distinct count runs as a
    two-level aggregate, so a customer holding a third of all lines is split by
    supplier before its final count.
    """
    li = t["lineitem"].select("l_orderkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate")
    od = t["orders"].select("o_orderkey", "o_custkey")
    returned = F.col("l_returnflag") == "R"
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .groupBy(F.col("o_custkey").alias("custkey"))
            .agg(F.max("l_shipdate").alias("last_ship"),
                 F.count_distinct(F.when(returned, F.col("l_suppkey"))).alias("following"),
                 F.count_if(returned & (F.col("l_linestatus") == "F")).alias("public_gists")))


def _order_facts(t) -> DataFrame:
    return (t["orders"].groupBy(F.col("o_custkey").alias("custkey"))
            .agg(F.min("o_orderdate").alias("first_order"),
                 F.count_if(F.col("o_orderstatus") == "F").alias("finished")))


def demo_profiles(spark: SparkSession, sf_dir: str, tables: dict | None = None) -> DataFrame:
    """Profiles (FIXTURES §1.1 schema) derived from the driver tables."""
    t = tables or load_tables(spark, sf_dir)
    cust = t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    ev = t["events"].groupBy(F.col("user_id").alias("custkey")).agg(F.count(F.lit(1)).alias("followers"))
    docs = t["documents"].select(F.col("doc_id").alias("custkey"), F.col("source").alias("blog"))
    labs = t["labels"].select(F.col("doc_id").alias("custkey"), F.col("quality").cast("boolean").alias("hireable"))
    nat = t["nation"].select(F.col("n_nationkey").alias("c_nationkey"), "n_name")

    k = F.col("c_custkey") % 5
    bio = (F.when(k == 0, F.lit(None).cast("string"))
           .when(k == 1, F.lit("  "))
           .when(k == 2, F.lit("None"))
           .otherwise(F.col("c_mktsegment")))

    j = (cust.withColumnRenamed("c_custkey", "custkey")
         .join(_order_facts(t), "custkey", "left")
         .join(_line_facts(t), "custkey", "left")
         .join(ev, "custkey", "left")
         .join(docs, "custkey", "left")
         .join(labs, "custkey", "left")
         .join(nat, "c_nationkey", "left")
         .withColumn("c_custkey", F.col("custkey")))
    return j.select(
        F.col("c_name").alias("login"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("Organization")).otherwise(F.lit("User")).alias("type"),
        F.coalesce(F.col("finished"), F.lit(0)).cast("long").alias("public_repos"),
        F.col("public_gists").cast("long").alias("public_gists"),
        F.col("followers").cast("long").alias("followers"),
        F.col("following").cast("long").alias("following"),
        iso_of(j, "first_order").alias("created_at"),
        iso_of(j, "last_ship").alias("updated_at"),
        bio.alias("bio"),
        F.col("blog"),
        F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("company"),
        F.lit(None).cast("string").alias("email"),
        F.col("hireable"),
    )


def demo_repos(spark: SparkSession, sf_dir: str, tables: dict | None = None) -> DataFrame:
    """Repos (FIXTURES §1.2 schema): one per order, owned by the customer's login."""
    t = tables or load_tables(spark, sf_dir)
    cust = t["customer"].select("c_custkey", "c_name")
    od = t["orders"].select("o_custkey", "o_orderdate", "o_orderpriority")
    j = od.join(cust, od.o_custkey == cust.c_custkey)
    return (j.select(F.col("c_name").alias("owner"),
                    iso_of(j, "o_orderdate").alias("pushed_at"),
                    F.col("o_orderpriority").alias("language")))
