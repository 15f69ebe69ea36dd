"""Stream = batch in complete mode; append emits closed windows; late rows are dropped."""

import os
import tempfile

from loglens.plans import QUERIES, common
from loglens.sources import landing
from loglens.streaming import logstream
from tests.conftest import SF_SMALL


def _line(hhmm: str, n: int = 1) -> str:
    return f'10.0.0.{n} - - [01/Jan/2024:{hhmm}:00 +0000] "GET /x/{n} HTTP/1.1" 200 10 "-" "a" "-"'


def test_complete_mode_equals_batch(spark):
    s = QUERIES["stream_hourly_traffic"](spark, SF_SMALL)
    b = common.hourly(spark, SF_SMALL)
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_append_drops_late_rows(spark):
    root = tempfile.mkdtemp(prefix="loglens-late-")
    land, out, ckpt = (os.path.join(root, x) for x in ("land", "out", "ckpt"))
    os.makedirs(land)
    with open(os.path.join(land, "a.log"), "w") as fh:
        fh.write("\n".join(_line(t) for t in ["10:05", "10:30", "11:10", "12:20", "13:40"]) + "\n")
    agg = logstream.stream_hourly_traffic(landing.landing_stream(spark, land), "1 hour")
    logstream.drain(spark, agg, out, ckpt, "append")
    with open(os.path.join(land, "b.log"), "w") as fh:   # 10:50 is behind the 12:40 watermark
        fh.write("\n".join(_line(t) for t in ["10:50", "12:50", "15:30"]) + "\n")
    agg = logstream.stream_hourly_traffic(landing.landing_stream(spark, land), "1 hour")
    res = logstream.drain(spark, agg, out, ckpt, "append")
    got = {r.hour_timestamp.hour: r.request_count for r in res.collect()}
    assert got == {10: 2, 11: 1, 12: 2, 13: 1}


def _land(folder: str, name: str, times: list[str]) -> None:
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(_line(t) for t in times) + "\n")


def test_update_mode_over_many_batches(spark):
    """Six one-hour files, one per trigger, late rows within the delay: nothing is lost."""
    root = tempfile.mkdtemp(prefix="loglens-update-")
    land, out, ckpt = (os.path.join(root, x) for x in ("land", "out", "ckpt"))
    os.makedirs(land)
    for i in range(6):
        _land(land, f"{i}.log", [f"{10 + i}:05", f"{10 + i}:30", f"{max(10, 9 + i)}:50"])
        os.utime(os.path.join(land, f"{i}.log"), (1000 + i, 1000 + i))
    agg = logstream.stream_hourly_traffic(landing.landing_stream(spark, land, max_files_per_trigger=1), "3 hours")
    res = logstream.drain(spark, agg, out, ckpt, "update")
    want = {10: 4, 11: 3, 12: 3, 13: 3, 14: 3, 15: 2}
    assert {r.hour_timestamp.hour: r.request_count for r in res.collect()} == want
    batches = [n for n in os.listdir(out) if n.startswith("batch_id=")]
    assert len(batches) >= 6
    # nothing new has landed: a further run, with or without a trailing empty batch, changes nothing
    agg = logstream.stream_hourly_traffic(landing.landing_stream(spark, land, max_files_per_trigger=1), "3 hours")
    res = logstream.drain(spark, agg, out, ckpt, "update")
    assert {r.hour_timestamp.hour: r.request_count for r in res.collect()} == want


def test_repeated_and_unfinished_batches(spark):
    """A batch written again replaces itself; one without its success mark is not read."""
    root = tempfile.mkdtemp(prefix="loglens-repeat-")
    schema = "hour_timestamp int, request_count long"
    put = lambda i, rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{root}/batch_id={i}")
    put(0, [(1, 5), (2, 1)])
    put(1, [(2, 3)])
    put(1, [(2, 3)])
    put(10, [(2, 9), (3, 1)])
    put(11, [(1, 99)])
    os.remove(f"{root}/batch_id=11/_SUCCESS")
    typed = spark.createDataFrame([], schema).schema
    assert sorted(map(tuple, logstream.read_table(spark, root, "update", typed).collect())) == [(1, 5), (2, 9), (3, 1)]
    assert sorted(map(tuple, logstream.read_table(spark, root, "complete", typed).collect())) == [(2, 9), (3, 1)]
    assert logstream.read_table(spark, f"{root}/none", "update", typed).count() == 0
