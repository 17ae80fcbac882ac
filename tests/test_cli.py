"""The command line over files: demo → collect → features → select → train → latent → score."""

import json

from churnlens import cli

SF = "/root/testdata/sf0.001"
AS_OF = "2002-01-01T00:00:00Z"


def test_cli_chain(spark, tmp_path, capsys):
    d = str(tmp_path)
    run = lambda *a: cli.main(list(a), stop=False)
    run("demo", "--sf-dir", SF, "--out", f"{d}/demo")
    run("collect", "--profiles", f"{d}/demo/profiles", "--repos", f"{d}/demo/repos", "--out", f"{d}/raw",
        "--as-of", AS_OF)
    run("features", "--raw", f"{d}/raw", "--out", f"{d}/features", "--as-of", AS_OF)
    run("select", "--features", f"{d}/features", "--out", f"{d}/sel")
    run("train", "--features", f"{d}/features", "--model", f"{d}/model", "--use-keep", f"{d}/sel")
    run("latent", "--features", f"{d}/features", "--out", f"{d}/latent")
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert out[0]["balance_pass"] == 0 and "keep" in out[1] and 0 <= out[2]["cv_f1"] <= 1
    trained = out[2]["selected_features"]
    req = spark.read.parquet(f"{d}/features").select("username", *trained).limit(5)
    req.withColumnRenamed("username", "request_id").write.json(f"{d}/req")
    run("score", "--model", f"{d}/model", "--requests", f"{d}/req", "--out", f"{d}/scores")
    assert spark.read.parquet(f"{d}/scores/scored").count() + spark.read.parquet(f"{d}/scores/rejected").count() == 5
    assert spark.read.parquet(f"{d}/latent/users").count() == spark.read.parquet(f"{d}/features").count()
