"""File sources and sinks: CSV null tokens, JSON profiles, feature-table fallback, latent artefact."""

import json

import pytest

from churnlens.operators import labels as L
from churnlens.sources import files as FS
from conftest import AS_OF

HEADER = ("username,public_repos,public_gists,followers,following,created_at,updated_at,bio,blog,company,"
          "email,hireable,days_since_update,days_since_last_push,churn,extra\n")


def test_raw_csv_tokens_and_types(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text(HEADER
                 + "alice,3.0,,12,NA,2020-01-01T00:00:00Z,2023-12-01T00:00:00Z,None,x.io,,,True,31,,0,z\n"
                 + "bob,0,1,null,2,not-a-date,,hello,NaN,acme,,False,400,500,1,z\n")
    df = FS.read_raw_users(spark, str(p))
    r = {x["username"]: x for x in df.collect()}
    assert r["alice"]["public_repos"] == 3 and r["alice"]["public_gists"] is None
    assert r["alice"]["following"] is None and r["alice"]["bio"] is None and r["alice"]["hireable"] is True
    assert r["bob"]["followers"] is None and r["bob"]["blog"] is None and r["bob"]["hireable"] is False
    assert "extra" not in df.columns and r["bob"]["churn"] == 1


def test_profiles_json(spark, tmp_path):
    p = tmp_path / "profiles.json"
    p.write_text("\n".join(json.dumps(x) for x in [
        {"login": "a", "type": "User", "followers": 2, "created_at": "2020-01-01T00:00:00Z"},
        {"login": "b", "type": "Organization"}]))
    prof = FS.read_profiles(spark, str(p))
    raw = L.raw_users(prof, None, AS_OF)
    assert [r["username"] for r in raw.collect()] == ["a"]


def test_feature_matrix_fallback(spark, tmp_path, profiles):
    raw = L.raw_users(profiles([{"login": f"u{i}", "followers": i} for i in range(6)]), None, AS_OF)
    raw_path = FS.write_table(raw, str(tmp_path / "raw"))
    fx = FS.load_feature_matrix(spark, str(tmp_path / "missing_features"), raw_path, AS_OF)
    assert fx.count() == 6 and "churn" in fx.columns and fx.columns[0] == "username"
    feat_path = FS.write_table(fx, str(tmp_path / "features"))
    again = FS.load_feature_matrix(spark, feat_path, None, AS_OF)
    assert sorted(again.collect()) == sorted(fx.collect())
    with pytest.raises(FileNotFoundError):
        FS.load_feature_matrix(spark, str(tmp_path / "no1"), str(tmp_path / "no2"), AS_OF)
    with pytest.raises(ValueError, match="churn"):
        FS.write_table(fx.drop("churn"), str(tmp_path / "nolabel"))
        FS.load_feature_matrix(spark, str(tmp_path / "nolabel"), None, AS_OF)


def test_latent_absent_then_present(spark, tmp_path):
    assert FS.load_latent(spark, str(tmp_path / "latent")) is None
    lat = spark.createDataFrame([("u", [0.1], [0.2])], "username string, scaled array<double>, reconstructed array<double>")
    v = spark.createDataFrame([(0, [1.0])], "row int, v array<double>")
    FS.save_latent(lat, v, str(tmp_path / "latent"))
    assert FS.load_latent(spark, str(tmp_path / "latent")).count() == 1


def test_csv_with_quotes_commas_and_line_breaks(spark, tmp_path, profiles):
    texts = ['says "hi", ok', "line one\nline two", 'a "quoted\nline", end', "back\\slash", " padded "]
    raw = L.raw_users(profiles([{"login": f"u{i}", "bio": t} for i, t in enumerate(texts)]), None, AS_OF)
    path = FS.write_table(raw, str(tmp_path / "raw-folder"), fmt="csv")
    got = {r["username"]: r["bio"] for r in FS.read_raw_users(spark, path).collect()}
    assert got == {f"u{i}": t for i, t in enumerate(texts)}
    import pandas as pd  # another reader sees the same cells
    frames = [pd.read_csv(f) for f in (tmp_path / "raw-folder").glob("*.csv")]
    assert sorted(pd.concat(frames)["bio"]) == sorted(texts)
    # a folder of CSV files needs no suffix of its own
    fx = FS.load_feature_matrix(spark, None, path, AS_OF)
    assert fx.count() == len(texts)
    again = FS.load_feature_matrix(spark, FS.write_table(fx, str(tmp_path / "fx"), fmt="csv"), None, AS_OF)
    assert again.columns == fx.columns and again.count() == len(texts)
