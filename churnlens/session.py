"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC instants, ANSI errors, AQE re-planning
# (coalescing small shuffles, splitting skewed join partitions, broadcast only
# after the runtime size of a side is known to be under the threshold).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_WRITTEN: list[str] = []
_LOCK = threading.Lock()


def get_session(master: str | None = None, app: str = "churnlens",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster, pass ``master=None`` and let the launcher decide; partitions
    default to Spark's value unless given.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if master and master.startswith("local") and "spark.driver.memory" not in (extra or {}):
        # local mode: the driver JVM is the executor, so cached blocks live in its heap
        b = b.config("spark.driver.memory", os.environ.get("CHURNLENS_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(master: str) -> bool:
    """One JVM on one machine (``local``, ``local[n]``), not ``local-cluster`` or a cluster."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str = "/tmp/churnlens-checkpoints") -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins; ``fallback`` is used only when the setting is
    absent and the master is ``local``: on a cluster a machine's own folder is not seen
    by the others, so a missing setting is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not is_local(spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        d = fallback
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str, track: bool = False) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables
    (``track=True``: deleted by :func:`release_scratch`)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if track:
        with _LOCK:
            _WRITTEN.append(path)
    return path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def materialize(df, name: str):
    """Write ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the input once (a
    reliable RDD checkpoint recomputes it to write the files), and the files
    survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name, track=True)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release_scratch(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far (call once their results are consumed)."""
    with _LOCK:
        paths, _WRITTEN[:] = list(_WRITTEN), []
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    return len(paths)


SPARK_DEFAULT_SHUFFLE_PARTITIONS = "200"
TARGET_SHUFFLE_BYTES = 128 * 1024 * 1024


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (Hadoop file system, any scheme)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        fs = hp.getFileSystem(conf)
        if fs.exists(hp):
            total += fs.getContentSummary(hp).getLength()
    return int(total)


def size_shuffle_partitions(spark: SparkSession, paths, target_bytes: int = TARGET_SHUFFLE_BYTES) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the input size, unless the user has set it.

    Roughly one partition per ``target_bytes`` of compressed input, never fewer
    than twice the default parallelism; AQE coalesces what turns out small.  The
    number is found anew for every input: a value set here earlier is replaced, any
    other explicit value (200 too) is left alone.
    """
    key, own = "spark.sql.shuffle.partitions", "churnlens.shuffle.partitions"
    cur, mine = spark.conf.get(key), spark.conf.get(own, None)
    if cur != mine and (cur != SPARK_DEFAULT_SHUFFLE_PARTITIONS or _is_set(spark, key)):
        return int(cur)
    n = int(max(-(-input_bytes(spark, paths) // target_bytes), 2 * spark.sparkContext.defaultParallelism))
    spark.conf.set(key, str(n))
    spark.conf.set(own, str(n))
    return n


def _is_set(spark: SparkSession, key: str) -> bool:
    """Whether a setting was given, in the session or at launch, rather than being the default."""
    return bool(spark.conf._jconf.contains(key)) or spark.sparkContext.getConf().contains(key)
