import random

from blattwerk.operators.history import OPEN_END, canonical_instant, canonical_status, manifest_versions
from pyspark.sql import functions as F

SCHEMA = "name string, status string, previous struct<status:string,decided:string,ocr_date:string>, ocr_timestamp string, decided string, updated string, loaded_at timestamp, valid_from string, state string"


def _rows(spark, rows):
    import datetime as dt

    return spark.createDataFrame([(n, s, p, o, d, u, None if l is None else dt.datetime(2025, 1, 1) + dt.timedelta(hours=l), "x", "y") for n, s, p, o, d, u, l in rows], SCHEMA)


def _versions(df):
    return sorted((r.name, r.valid_from, r.valid_to) for r in manifest_versions(df).collect())


def test_spellings_are_no_change(spark):
    rows = [
        ("a", "offen", None, "2025-01-01T00:00:00", "", "2025-01-02T00:00:00", 1),
        ("a", "open", (None, None, None), "2025-01-01 00:00:00", None, "2025-01-03T00:00:00", 2),
        ("a", "accepted", None, "2025-01-01T00:00:00", "2025-01-04T01:00:00+01:00", "2025-01-04T00:00:01", 3),
        ("a", "akzeptiert", None, "2025-01-01T00:00:00Z", "2025-01-04T00:00:00.000Z", "2025-01-05T00:00:00", 4),
        ("a", "open", None, "2025-01-01T00:00:00", None, "2025-01-06T00:00:00", 5),
    ]
    assert _versions(_rows(spark, rows)) == [
        ("a", "2025-01-02T00:00:00", "2025-01-04T00:00:01"),
        ("a", "2025-01-04T00:00:01", "2025-01-06T00:00:00"),
        ("a", "2025-01-06T00:00:00", OPEN_END),
    ]


def test_later_delivery_holds_and_null_time_loads_first(spark):
    t = "2025-01-02T00:00:00"
    rows = [("a", "rejected", None, None, None, t, None), ("a", "open", None, None, None, t, 1), ("a", "open", None, None, None, "2025-01-03T00:00:00", 9)]
    assert _versions(_rows(spark, rows)) == [("a", t, OPEN_END)]


def test_odd_rows(spark):
    rows = [(None, "open", None, None, None, "2025-01-02T00:00:00", 1), ("a", "open", None, None, None, None, 1), ("a", None, None, None, None, " ", 1)]
    assert _versions(_rows(spark, rows)) == []
    assert _versions(_rows(spark, []).where("false")) == []
    one = [("b", None, None, None, None, "2025-01-02T00:00:00", 1)] * 3
    assert _versions(_rows(spark, one)) == [("b", "2025-01-02T00:00:00", OPEN_END)]


def test_equals_brute_force_with_a_hot_entry(spark):
    rng = random.Random(4)
    rows, held = [], {}
    for i in range(1500):
        name = "hot" if i % 3 == 0 else f"n{rng.randrange(40)}"
        at = f"2025-{rng.randrange(1, 4):02d}-{rng.randrange(1, 28):02d}T{rng.randrange(24):02d}:00:00"
        status = rng.choice(["open", "offen", "accepted", "rejected"])
        rows.append((name, status, None, None, None, at, i))
        held[name, at] = {"offen": "open"}.get(status, status)
    want = []
    for name in {n for n, _ in held}:
        runs = []
        for at in sorted(a for n, a in held if n == name):
            if not runs or runs[-1][1] != held[name, at]:
                runs.append((at, held[name, at]))
        want += [(name, a, runs[i + 1][0] if i + 1 < len(runs) else OPEN_END) for i, (a, _) in enumerate(runs)]
    assert _versions(_rows(spark, rows)) == sorted(want)


def test_canonical_values(spark):
    df = spark.createDataFrame([(x,) for x in ("2025-01-01T01:00:00+01:00", "2025-01-01T00:00:00", "2025-01-01 00:00:00.000Z", "bald", "", None)], "v string")
    a = [r[0] for r in df.select(canonical_instant(F.col("v"))).collect()]
    assert a[0] == a[1] == a[2] and a[3:] == ["bald", None, None]
    assert [r[0] for r in df.select(canonical_status(F.lit("uebernommen"))).distinct().collect()] == ["adopted"]
