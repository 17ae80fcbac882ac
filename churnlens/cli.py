"""Command line: the batch steps as Spark jobs over files.

    python -m churnlens.cli collect  --profiles P.json --repos R.json --out raw/ [--as-of ...]
    python -m churnlens.cli features --raw raw/ --out features/ [--as-of ...]
    python -m churnlens.cli select   --features features/ --out selection/
    python -m churnlens.cli train    --features features/ --model model/ [--select a,b,c | --use-keep selection/]
    python -m churnlens.cli latent   --features features/ --out latent/
    python -m churnlens.cli score    --model model/ --requests req.json --out scores/
    python -m churnlens.cli stream   --model model/ --source dir/ --sink dir/ --checkpoint dir/
    python -m churnlens.cli demo     --sf-dir /root/testdata/sf0.01 --out demo/   (driver tables → profiles/repos)

``--master`` defaults to whatever the launcher provides (spark-submit on a cluster).
Inputs and outputs are folders (parquet) unless a path ends in .json / .csv.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import functions as F

from churnlens.schemas import FINAL_FEATURES


def _now_utc() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def _guess_format(spark, path: str) -> str:
    """json / csv / parquet from the path or, for a folder, its part files."""
    for ext in ("json", "csv", "parquet"):
        if path.endswith("." + ext):
            return ext
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and fs.getFileStatus(p).isDirectory():
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        for ext in ("json", "csv"):
            if any(n.endswith("." + ext) for n in names):
                return ext
    return "parquet"


def _read(spark, path, schema=None):
    fmt = _guess_format(spark, path)
    if fmt == "json":
        return spark.read.schema(schema).json(path) if schema is not None else spark.read.json(path)
    if fmt == "csv":
        from churnlens.sources.files import read_raw_users
        return read_raw_users(spark, path)
    return spark.read.parquet(path)


def main(argv=None, stop: bool = True) -> int:
    ap = argparse.ArgumentParser(prog="churnlens")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("collect")
    c.add_argument("--profiles", required=True)
    c.add_argument("--repos")
    c.add_argument("--out", required=True)
    c.add_argument("--as-of", default=None)
    c.add_argument("--threshold", type=int, default=365)
    c.add_argument("--min-ratio", type=float, default=0.10)
    c.add_argument("--target", type=int, default=None)
    f = sub.add_parser("features")
    f.add_argument("--raw", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--as-of", default=None)
    s = sub.add_parser("select")
    s.add_argument("--features", required=True)
    s.add_argument("--out", required=True)
    t = sub.add_parser("train")
    t.add_argument("--features", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--select", default=None, help="comma-separated feature list")
    t.add_argument("--use-keep", default=None, help="selection folder: train on its Keep features")
    t.add_argument("--metrics-out", default=None)
    t.add_argument("--versioned", action="store_true", help="publish under --model as the next version")
    la = sub.add_parser("latent")
    la.add_argument("--features", required=True)
    la.add_argument("--out", required=True)
    la.add_argument("--versioned", action="store_true", help="publish under --out as the next version")
    sc = sub.add_parser("score")
    sc.add_argument("--model", required=True)
    sc.add_argument("--requests", required=True)
    sc.add_argument("--out", required=True)
    st = sub.add_parser("stream")
    st.add_argument("--model", required=True)
    st.add_argument("--source", required=True)
    st.add_argument("--sink", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--continuous", action="store_true")
    de = sub.add_parser("demo")
    de.add_argument("--sf-dir", required=True)
    de.add_argument("--out", required=True)
    a = ap.parse_args(argv)

    from churnlens.session import get_session, release_scratch
    spark = get_session(a.master)
    try:
        _run(a, spark)
    finally:
        release_scratch(spark)  # the intermediate tables of this job
        if stop:
            spark.stop()
    return 0


def _run(a, spark) -> None:
    if a.cmd == "demo":
        from churnlens.sources.demo import demo_profiles, demo_repos, load_tables
        tb = load_tables(spark, a.sf_dir)
        demo_profiles(spark, a.sf_dir, tb).write.mode("overwrite").json(f"{a.out}/profiles")
        demo_repos(spark, a.sf_dir, tb).write.mode("overwrite").json(f"{a.out}/repos")
    elif a.cmd == "collect":
        from churnlens.operators import ingest as I
        from churnlens.schemas import PROFILE, REPO
        as_of = a.as_of or _now_utc()
        prof = _read(spark, a.profiles, PROFILE) if a.profiles.endswith(".json") else \
            spark.read.schema(PROFILE).json(a.profiles)
        repos = (spark.read.schema(REPO).json(a.repos)) if a.repos else None
        raw = I.collect_dataset(prof, repos, as_of, target_records=a.target, threshold_days=a.threshold,
                                fetch_repos=repos is not None)
        res = I.fix_low_churn_ratio(raw, prof, as_of, a.threshold, a.min_ratio)
        res.df.write.mode("overwrite").parquet(a.out)
        print(json.dumps({"churn_ratio": res.ratio, "threshold": res.threshold, "balance_pass": res.passes}))
    elif a.cmd == "features":
        from churnlens.operators.features import generate_features
        fx = generate_features(_read(spark, a.raw), a.as_of or _now_utc())
        fx.write.mode("overwrite").parquet(a.out)
    elif a.cmd == "select":
        from churnlens.operators import models as M
        res = M.select_features(spark.read.parquet(a.features))
        for k in ("table", "filter", "rfe", "dt", "rf"):
            res[k].write.mode("overwrite").parquet(f"{a.out}/{k}")
        print(json.dumps({"keep": M.keep_list(res["table"])}))
    elif a.cmd == "train":
        from churnlens.operators import models as M
        fx = spark.read.parquet(a.features)
        cols = a.select.split(",") if a.select else None
        if a.use_keep:
            cols = M.keep_list(spark.read.parquet(f"{a.use_keep}/table")) or None
        from churnlens.sources.artefacts import Artefacts
        where = {"store": Artefacts(spark, a.model)} if a.versioned else {"model_path": a.model}
        res = M.train_and_save(fx, cols or FINAL_FEATURES, cv=True, **where)
        out = {"selected_features": res["selected_features"], **res["cv_metrics"].first().asDict(),
               **res["metrics"].first().asDict()}
        if a.metrics_out:
            res["report"].write.mode("overwrite").parquet(a.metrics_out)
        print(json.dumps(out))
    elif a.cmd == "latent":
        from churnlens.operators import latent as LT
        from churnlens.sources.artefacts import Artefacts
        from churnlens.sources.files import publish_latent, save_latent
        fx = spark.read.parquet(a.features)
        fit = LT.fit_svd(fx)
        v_rows = spark.createDataFrame([(i, [float(x) for x in fit.v[i]]) for i in range(len(fit.cols))],
                                       "row int, v array<double>")
        latent = LT.svd_reconstruct(fx, fit)
        if a.versioned:
            publish_latent(Artefacts(spark, a.out), latent, v_rows)
        else:
            save_latent(latent, v_rows, a.out)
    elif a.cmd == "score":
        from churnlens.operators import models as M
        from churnlens.operators.scoring import validate_score_requests
        model = M.load_model(a.model, spark)
        fields = M.model_inputs(model)
        req = validate_score_requests(_read(spark, a.requests, M.request_schema(model)), fields)
        M.score_users(model, req.where("valid").select("request_id", *fields)) \
            .write.mode("overwrite").parquet(f"{a.out}/scored")
        req.where(~F.col("valid")).select("request_id", "error").write.mode("overwrite").parquet(f"{a.out}/rejected")
    elif a.cmd == "stream":
        from churnlens.operators import models as M
        from churnlens.streaming.scoring import start_scoring_stream
        model = M.load_model(a.model, spark)
        q = start_scoring_stream(spark, model, a.source, a.sink, a.checkpoint,
                                 available_now=not a.continuous, fields=M.model_inputs(model))
        if a.continuous:
            q.awaitTermination()



if __name__ == "__main__":
    raise SystemExit(main())
