import pytest
from pyspark.sql import functions as F

from blattwerk.operators import paragraphs as P
from blattwerk.operators import review as R
from blattwerk.sources import files


def test_catalogue_and_benchmark(spark, tmp_path):
    (tmp_path / "pages.json").write_text('[{"pdf": "a.pdf", "page": 3, "chars": 1800, "more": 1}, {"pdf": "b.pdf", "page": "x"}]')
    rows = files.catalogue(spark, str(tmp_path / "pages.json")).collect()
    assert [(r.pdf, r.page, r.chars) for r in rows] == [("a.pdf", 3, 1800), ("b.pdf", None, None)]
    folder = str(tmp_path / "bench")
    row = spark.createDataFrame([("r1", "m", 3, 1.5, 0.5, 10, 0.9, None)], files.BENCHMARK)
    files.append_benchmark(row, folder)
    files.append_benchmark(row.withColumn("run", F.lit("r2")), folder)
    assert sorted((r.run, r.seconds, r.citation_accuracy) for r in files.benchmark_rows(spark, folder).collect()) == [("r1", 1.5, None), ("r2", 1.5, None)]
    files.write_report(row, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report")).first().word_accuracy == 0.9


def test_word_lists(spark, tmp_path):
    (tmp_path / "de_AT.dic").write_bytes("2\nHaus/ES\nTür\n".encode("iso-8859-1"))
    (tmp_path / "de_AT.aff").write_text("# Kopf\nSET ISO8859-1\n")
    (tmp_path / "eigen.txt").write_text("# nein\nGarten\tx\nhaus\n")
    assert sorted(r.word for r in files.word_lists(spark, places=[str(tmp_path / "leer"), str(tmp_path)]).collect()) == ["haus", "tür"]
    assert sorted(r.word for r in files.word_lists(spark, [str(tmp_path / "eigen.txt")], str(tmp_path / "de_AT.dic")).collect()) == ["garten", "haus", "tür"]
    assert files.word_lists(spark).count() == 0
    with pytest.raises(FileNotFoundError, match="no such word list"):
        files.word_lists(spark, ["/nirgends.dic"])


def test_results_replace_others_only_if_good(spark, tmp_path):
    target = str(tmp_path / "out")
    before = spark.createDataFrame([(1, "ein ganzer Text"), (2, "noch einer")], "id int, t string")
    assert files.replace_if_good(before, target, lambda d: d.count() == 2)
    cut_ = before.withColumn("t", F.substring("t", 1, 3))
    good = lambda d: files.lost_letters(before, d, "id", "t").agg(F.max("lost")).first()[0] < 0.1
    assert not files.replace_if_good(cut_, target, good)
    assert sorted(map(tuple, spark.read.parquet(target).collect())) == sorted(map(tuple, before.collect()))
    assert spark.read.parquet(target + "_FAILED").count() == 2
    assert files.replace_if_good(before.withColumn("t", F.upper("t")), target, good)
    assert spark.read.parquet(target).where("t = upper(t)").count() == 2


def test_names_that_are_free(spark):
    wanted = spark.createDataFrame([("x", "2024", i) for i in range(4)] + [("y", None, 0), ("x-2024", "2", 0)], "stem string, date string, i int")
    taken = spark.createDataFrame([("x-2024",), ("x-2024-2",), ("x-2024-4",), ("x-2024-02",), (None,)], "target string")
    got = sorted((r.stem, r.i, r.target) for r in R.free_names(wanted, taken, "stem", "date").collect())
    assert got == [("x", 0, "x-2024-3"), ("x", 1, "x-2024-5"), ("x", 2, "x-2024-6"), ("x", 3, "x-2024-7"), ("x-2024", 0, "x-2024-2-2"), ("y", 0, "y-old")]
    assert R.free_names(wanted.where("false"), taken, "stem", "date").count() == 0
    s = spark.createDataFrame([("open",), ("rejected",), ("adopted",), (None,)], "s string")
    assert [r[0] for r in s.select(R.folder_of(F.col("s"), "o", "a", "r")).collect()] == ["o", "r", None, None]


def test_seams_are_cut(spark):
    tail = "wer das prüft, der findet am Ende auch die richtige Lösung im Gesetz"
    df = spark.createDataFrame([("d", 1, "Anfang " + tail), ("d", 2, "– " + tail.replace(",", "") + ".\nund  weiter"), ("d", 3, "etwas anderes"), ("d", 4, None), (None, 1, "x")], "k string, o int, t string")
    got = {(r.k, r.o): r.t for r in P.trim_seams(df, "k", "o", "t").collect()}
    assert got[("d", 2)] == "und  weiter" and got[("d", 3)] == "etwas anderes" and got[("d", 4)] is None and got[(None, 1)] == "x" and len(got) == 5
