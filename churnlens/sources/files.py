"""File sources and sinks (SRC1, SRC2, SRC3 landing, SNK1-SNK4).

Explicit schemas everywhere (no inference); paths may be any Hadoop file
system, so existence checks go through the JVM file system API.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.schemas import FEATURE_COLUMNS, PROFILE, RAW_USERS, REPO
from churnlens.sources.artefacts import Artefacts, Version
from churnlens.sources.csv_records import read_quoted_csv

# Text tokens that a CSV reader treats as missing (pandas defaults).
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _typed(c: str, dtype: T.DataType) -> F.Column:
    """String cell → target type; missing tokens → NULL; '12.0' is accepted for integers."""
    s = F.when(F.col(c).isin(NULL_TOKENS), F.lit(None)).otherwise(F.col(c))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return s.try_cast("double").try_cast(dtype.simpleString())
    if isinstance(dtype, T.BooleanType):
        return s.try_cast("boolean")
    if isinstance(dtype, T.DoubleType):
        return s.try_cast("double")
    return s


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file, or of the first file of a folder."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV read as text, then typed column by column; extra columns are ignored.

    Quotes inside a quoted cell are doubled, and a quoted cell may hold commas and line breaks; a large
    file is read by many tasks all the same (:mod:`churnlens.sources.csv_records`)."""
    raw = read_quoted_csv(spark, path, _header(spark, path))
    cols = [(_typed(f.name, f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]
    return raw.select(*cols)  # absent optional columns arrive as NULL


def read_raw_users(spark: SparkSession, path: str) -> DataFrame:
    """The raw labelled user table from CSV (SRC1)."""
    return read_csv_table(spark, path, RAW_USERS)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Landed profile JSON lines with an explicit schema (SRC3)."""
    return spark.read.schema(PROFILE).json(path)


def read_repos(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REPO).json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    """Write a table (parent folders are created by the writer) (SNK1, SNK2)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        # keep text exactly (the writer trims by default); NULL is written as an empty field
        w = (w.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
             .option("ignoreTrailingWhiteSpace", False))
    w.format(fmt).save(path)
    return path


def is_csv(spark: SparkSession, path: str) -> bool:
    """Whether a file, or the files of a folder, are CSV by their names."""
    if path.rstrip("/").endswith(".csv"):
        return True
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]
    return any(".csv" in n for n in names)


def read_feature_table(spark: SparkSession, path: str, key: str = "username") -> DataFrame:
    """A feature table written as CSV: the key, the known features that it has, and the label."""
    names = _header(spark, path)
    kinds = {key: T.StringType(), "churn": T.IntegerType()} | {c: T.DoubleType() for c in FEATURE_COLUMNS}
    return read_csv_table(spark, path, T.StructType([T.StructField(c, kinds[c]) for c in names if c in kinds]))


def load_feature_matrix(spark: SparkSession, features_path: str | None, raw_path: str | None, as_of,
                        key: str = "username") -> DataFrame:
    """Feature table if present, else features generated from the raw table, else an error (SRC2).

    Returns key + the known feature columns present + churn (required).
    """
    from churnlens.operators.features import generate_features
    if features_path and path_exists(spark, features_path):
        df = read_feature_table(spark, features_path) if is_csv(spark, features_path) else spark.read.parquet(features_path)
    elif raw_path and path_exists(spark, raw_path):
        raw = read_raw_users(spark, raw_path) if is_csv(spark, raw_path) else spark.read.parquet(raw_path)
        df = generate_features(raw, as_of, key)
    else:
        raise FileNotFoundError(f"neither {features_path!r} nor {raw_path!r} exists; build the raw table first")
    if "churn" not in df.columns:
        raise ValueError("the dataset must contain a 'churn' column")
    cols = [c for c in FEATURE_COLUMNS if c in df.columns]
    return df.select(*([key] if key in df.columns else []), *cols, F.col("churn").cast("int").alias("churn"))


def save_latent(latent: DataFrame, v_rows: DataFrame, path: str) -> str:
    """Persist the per-user latent arrays and the factor matrix (SNK4)."""
    latent.write.mode("overwrite").parquet(f"{path}/users")
    v_rows.write.mode("overwrite").parquet(f"{path}/factors")
    return path


def publish_latent(store: Artefacts, latent: DataFrame, v_rows: DataFrame) -> Version:
    """The latent arrays and the factor matrix as parts of the store's next version."""
    return store.publish({"users": lambda path: latent.write.parquet(path), "factors": lambda path: v_rows.write.parquet(path)})


def load_latent(spark: SparkSession, path: str) -> DataFrame | None:
    """The saved per-user latent table, or None when absent (scoring still works without it); from a folder
    of versioned artefacts, that of the current version."""
    published = Artefacts(spark, path).table("users")
    if published is not None:
        return published
    p = f"{path}/users"
    return spark.read.parquet(p) if path_exists(spark, p) else None
