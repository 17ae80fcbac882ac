"""Session utilities: partition sizing and scratch tables."""

import os

from churnlens import session as SS


def test_partition_sizing_only_from_default(spark, tmp_path):
    (tmp_path / "f.bin").write_bytes(b"x" * 1000)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        assert SS.size_shuffle_partitions(spark, [str(tmp_path)]) == 37
        spark.conf.set("spark.sql.shuffle.partitions", SS.SPARK_DEFAULT_SHUFFLE_PARTITIONS)
        assert SS.size_shuffle_partitions(spark, [str(tmp_path)]) == 200  # set on purpose
        spark.conf.set("churnlens.shuffle.partitions", SS.SPARK_DEFAULT_SHUFFLE_PARTITIONS)
        n = SS.size_shuffle_partitions(spark, [str(tmp_path)], target_bytes=100)
        assert n == max(10, 2 * spark.sparkContext.defaultParallelism)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
        # sized anew for a larger input; no ceiling
        m = SS.size_shuffle_partitions(spark, [str(tmp_path)], target_bytes=1)
        assert m == 1000 and spark.conf.get("spark.sql.shuffle.partitions") == "1000"
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        assert SS.size_shuffle_partitions(spark, [str(tmp_path)], target_bytes=1) == 11
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("churnlens.shuffle.partitions")


def test_materialize_and_release(spark):
    SS.release_scratch(spark)          # start from a clean list
    df = spark.range(10).withColumnRenamed("id", "x")
    back = SS.materialize(df, "unit")
    assert sorted(r["x"] for r in back.collect()) == list(range(10))
    paths = list(SS._WRITTEN)
    assert paths and all(os.path.exists(p.replace("file:", "")) for p in paths)
    assert SS.release_scratch(spark) == len(paths)
    assert not any(os.path.exists(p.replace("file:", "")) for p in paths)


def test_cluster_needs_a_shared_folder():
    assert SS.is_local("local") and SS.is_local("local[4]")
    assert not any(map(SS.is_local, ("local-cluster[2,1,1024]", "yarn", "spark://h:7077", "k8s://x")))

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    import pytest
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        SS.ensure_checkpoint_dir(Session())
