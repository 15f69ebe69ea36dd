"""Sinks and sources: metrics JSON with NaN, stage reuse, malformed-line policy, archives."""

import io
import math
import os
import tempfile
import zipfile


from loglens.functions.logparse import parse_access_log
from loglens.sources import files, landing


def test_metrics_nan_stays_double(spark):
    path = tempfile.mkdtemp(prefix="loglens-m-") + "/m"
    df = spark.createDataFrame([(1.0, 2.0, 0.5, float("nan"))], "rmse double, mae double, r2 double, mape double")
    files.write_metrics(df, path)
    back = files.read_metrics(spark, path)
    assert dict(back.dtypes)["mape"] == "double"
    r = back.collect()[0]
    assert math.isnan(r["mape"]) and r["rmse"] == 1.0 and r["order"] is None


def test_materialize_reuses_and_forces(spark):
    path = tempfile.mkdtemp(prefix="loglens-s-") + "/stage"
    files.make_dirs(spark, path)
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    assert files.materialize(spark, make, path).count() == 3
    assert files.materialize(spark, make, path).count() == 3 and len(calls) == 1
    files.materialize(spark, make, path, force=True)
    assert len(calls) == 2


def test_drop_malformed(spark):
    df = spark.createDataFrame([("garbage 1",), ('1.2.3.4 - - [22/Jan/2019:03:56:16 +0330] "GET / HTTP/1.1" 200 1 '
                                                 '"-" "a" "-"',)], "value string")
    assert parse_access_log(df).count() == 2
    assert parse_access_log(df, on_malformed="drop").count() == 1


def test_archive_ingest_skips_dirs_and_uses_base_names(spark):
    root = tempfile.mkdtemp(prefix="loglens-z-")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("a/", b"")
        zf.writestr("a/b/x.log", b"l1\nl2\r\nl3")
        zf.writestr("y.txt", b"only\n")
    with open(os.path.join(root, "one.zip"), "wb") as fh:
        fh.write(buf.getvalue())
    full = landing.archive_ingest(spark, root + "/*.zip").collect()
    rows = sorted(tuple(r)[:4] for r in full)
    assert {r.member_path for r in full} == {"a/b/x.log", "y.txt"} and {r.archive_path[-8:] for r in full} == {"/one.zip"}
    assert rows == [("one.zip", "x.log", 1, "l1"), ("one.zip", "x.log", 2, "l2"), ("one.zip", "x.log", 3, "l3"),
                    ("one.zip", "y.txt", 1, "only")]


def test_landing_manifest_prunes_content(spark):
    root = tempfile.mkdtemp(prefix="loglens-l-")
    payload = b"landing check: " + b"x" * 41             # 56 bytes
    with open(os.path.join(root, "landed.txt"), "wb") as fh:
        fh.write(payload)
    m = landing.landing_manifest(spark, root)
    r = m.collect()[0]
    assert r["name"] == "landed.txt" and r["size_bytes"] == len(payload) == 56
    assert "content" not in m._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_reloaded_model_scores_identically(spark):
    from loglens.operators import linear
    from loglens.plans import model_queries
    from tests.conftest import SF_SMALL
    data, model = model_queries.lr_fit(spark, SF_SMALL)
    path = tempfile.mkdtemp(prefix="loglens-model-") + "/lr"
    files.save_model(model, path)
    files.save_model(model, path)                      # overwrite works
    test = data.filter("split = 'test'")
    a = linear.score(model, test).orderBy("hour_timestamp").collect()
    b = linear.score(files.load_model(path), test).orderBy("hour_timestamp").collect()
    assert a == b and len(a) > 0


def test_ship_package_zips_the_library_once(spark):
    from loglens import session
    session._SHIPPED.discard(spark.sparkContext.applicationId)
    path = session.ship_package(spark)
    assert path is not None and session.ship_package(spark) is None
    with zipfile.ZipFile(path[5:] if path.startswith("file:") else path) as zf:
        names = set(zf.namelist())
    assert {"loglens/__init__.py", "loglens/plans/registry.py", "loglens/operators/lsq.py"} <= names


def test_object_store_paths():
    from pyarrow import fs as pafs
    for scheme in ("s3a", "s3"):
        filesystem, inner = landing._arrow_fs(f"{scheme}://bucket/folder/x.zip?region=us-east-1")
        assert isinstance(filesystem, pafs.S3FileSystem) and inner == "bucket/folder/x.zip"


def test_rewritten_input_gets_a_new_stage(spark):
    from loglens.plans import common
    root = tempfile.mkdtemp(prefix="loglens-stage-")
    path = common.stage_path(spark, "parsed", root)
    spark.range(3).write.parquet(f"{root}/events.parquet")
    other = common.stage_path(spark, "parsed", root)
    assert path != other and other == common.stage_path(spark, "parsed", root)
