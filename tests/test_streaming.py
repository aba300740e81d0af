import datetime as dt

from pyspark.sql import functions as F

from blattwerk.streaming import progress as P

EVENTS = ['{"typ":"start","seiten":3}', '{"typ":"seite","nr":1,"von":3,"sekunden":1.5,"herkunft":"ocr","neu":1}', "kein json", '{"typ":"fremd"}', '{"type":"page","nr":2,"of":3,"seconds":2.0,"derailed":true}', '{"typ":"fertig"}']


def test_progress_stream_equals_replay(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text("\n".join(EVENTS[:3]) + "\n")
    (src / "b.jsonl").write_text("\n".join(EVENTS[3:]))
    got = P.drain(P.progress_totals(P.progress_events(P.event_stream(spark, str(src)))), "totals", str(tmp_path / "ck"), "complete").collect()
    want = P.progress_totals(P.progress_events(spark.createDataFrame([(e,) for e in EVENTS], "value string"))).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] == [(2, 1, 3.5, 3)]


def _events(spark):
    t = dt.datetime(2025, 1, 1)
    rows = [("a", 0), ("a", 300), ("a", 2000), ("b", 100), ("a", 2100)]
    return spark.createDataFrame([(k, t + dt.timedelta(milliseconds=m), m) for k, m in rows], "k string, ts timestamp, m int")


def test_bursts(spark):
    got = sorted((r.k, r.events) for r in P.debounced(_events(spark), "ts", "k").collect())
    assert got == [("a", 2), ("a", 2), ("b", 1)]


def test_windows_on_a_stream(spark, tmp_path):
    e = _events(spark)
    e.write.parquet(str(tmp_path / "in"))
    s = P.windowed(P.table_stream(spark, str(tmp_path / "in"), e), "ts", "1 second")
    got = P.drain(s, "windows", str(tmp_path / "ck"), "complete")
    assert sorted(r.events for r in got.collect()) == sorted(r.events for r in P.windowed(e, "ts", "1 second").collect()) == [2, 3]


def test_latest_is_kept_over_batches(spark, tmp_path):
    e = _events(spark)
    write = P.keep_latest(str(tmp_path / "state"), "k", "ts")
    write(e.where("m < 1000"), 0)
    write(e.where("m >= 1000"), 1)
    write(e.where("m >= 1000"), 1)  # a replayed batch
    assert sorted((r.k, r.m) for r in P.current(spark, str(tmp_path / "state"), "k", "ts").collect()) == [("a", 2100), ("b", 100)]
    assert sorted((r.k, r.m) for r in P.latest_wins(e, "k", "ts", "m").collect()) == [("a", 2100), ("b", 100)]


def test_cancel_leaves_the_pages_before(spark):
    e = _events(spark)
    assert sorted(r.m for r in P.until_cancelled(e, "k", "ts", F.col("m") == 2000).collect()) == [0, 100, 300]
    assert sorted(r.m for r in P.last_lines(e, "k", "ts", 2).collect()) == [100, 2000, 2100]
