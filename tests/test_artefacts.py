"""Versioned artefacts: readers see whole sets, jobs that race or fail do no harm."""

import pytest

from churnlens.operators import models as M
from churnlens.sources import files as FS
from churnlens.sources.artefacts import Artefacts, Version


def table(spark, n):
    return lambda path: spark.range(n).write.parquet(path)


def test_a_reader_during_a_publication_sees_the_old_pair(spark, tmp_path):
    store = Artefacts(spark, str(tmp_path / "store"))
    assert store.current() is None and store.table("users") is None
    store.publish({"users": table(spark, 1), "factors": table(spark, 1)}, {"cut": 1})
    seen = []

    def late(path):
        table(spark, 2)(path)
        reader = Artefacts(spark, store.root)
        seen.append((reader.table("users").count(), reader.table("factors").count()))

    made = store.publish({"users": table(spark, 2), "factors": late})
    assert seen == [(1, 1)] and made.number == 2 and made.facts == {"cut": 1}
    assert (store.table("users").count(), store.table("factors").count()) == (2, 2)
    # a reader that holds a version goes on with it
    assert store.table("users", store.version(1)).count() == 1


def test_a_lost_job_and_a_race(spark, tmp_path):
    store = Artefacts(spark, str(tmp_path / "store"))
    store.publish({"users": table(spark, 1)})

    def fails(path):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        store.publish({"users": table(spark, 5), "factors": fails})
    assert store.current().number == 1 and store.table("users").count() == 1

    def other_is_first(path):
        table(spark, 3)(path)
        Artefacts(spark, store.root).publish({"factors": table(spark, 4)})
    made = store.publish({"users": other_is_first})
    assert made.number == 3 and store.table("users").count() == 3 and store.table("factors").count() == 4
    assert not store._put(Version(3, {}))  # the number is taken
    assert store.current().number == 3


def test_prune_keeps_what_the_latest_versions_name(spark, tmp_path):
    store = Artefacts(spark, str(tmp_path / "store"))
    store.publish({"model": table(spark, 7)})
    for n in (1, 2, 3):
        store.publish({"users": table(spark, n)})
    assert store.prune(keep=2) == [1, 2]
    assert store.numbers() == [3, 4] and len(list((tmp_path / "store" / "parts").iterdir())) == 3
    assert store.table("model").count() == 7 and store.table("users", store.version(3)).count() == 2


def test_model_and_latent_tables_as_one_set(spark, tmp_path):
    rows = [(f"u{i}", float(i % 40) * 20, float(i % 7), int(i % 40 > 18)) for i in range(120)]
    fx = spark.createDataFrame(rows, "username string, a double, b double, churn int")
    store = Artefacts(spark, str(tmp_path / "store"))
    M.train_and_save(fx, ["a", "b"], trees=5, store=store)
    FS.publish_latent(store, spark.createDataFrame([("u0", [0.1], [0.2])], "username string, scaled array<double>, reconstructed array<double>"),
                      spark.createDataFrame([(0, [1.0])], "row int, v array<double>"))
    M.train_and_save(fx, ["a"], trees=5, store=store)
    now = store.current()
    assert now.number == 3 and set(now.parts) == {"model", "users", "factors"} and now.facts == {"selected_features": ["a"]}
    assert M.model_inputs(M.load_model(store.root, spark)) == ["a"]
    assert FS.load_latent(spark, store.root).count() == 1
