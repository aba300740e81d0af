from collections import defaultdict

from pyspark.sql import functions as F

from blattwerk.llm import boilerplate as B

SCHEMA = "block_id bigint, source_pdf string, markdown string, line_no int, keys string, source string"


def _blocks(spark, rows):
    return spark.createDataFrame([(*r, 0, "x", "y") for r in rows], SCHEMA)


def _found(df):
    return sorted((r.block_id, r.line_no) for r in B.source_lines(df).collect())


def _corpus():
    rows = []
    for s in range(6):
        for b in range(10):
            text = [f"Absatz {chr(97 + b)}{chr(97 + s)} handelt von Sache {chr(97 + (b * 7 + s) % 26)}x und mehr", "", "Eigene Zeile"]
            if b < 3 + s:
                text.append(f"**Alle Rechte bei Verlag {'akpxzg'[s] * 3}, Seite {b}**")
            rows.append((s * 100 + b, f"quelle{s}", "\n".join(text)))
    return rows


def test_lines_of_at_least_four_blocks_and_a_fifth_of_the_source(spark):
    got = _found(_blocks(spark, _corpus()))
    by_source = defaultdict(int)
    for block, line in got:
        by_source[block // 100] += line == 4
    assert dict(by_source) == {s: 3 + s for s in range(1, 6)}


def test_repeated_and_null_rows(spark):
    rows = _corpus()
    odd = [*rows, *rows[:20], (900, None, "Alle Rechte bei Verlag aaa"), (None, "quelle1", "x"), (901, "quelle1", None), (902, "quelle1", ""), (903, "quelle1", "Wort " * 200_000)]
    df = _blocks(spark, odd)
    # the three more blocks make the notice of source 1 four of thirteen: still a case
    assert _found(df) == _found(_blocks(spark, rows))


def test_lines_that_other_sources_share_are_in_excess_too(spark):
    own = lambda s, b: f"Satz {chr(97 + b % 26)}{chr(97 + b // 26)} von {chr(97 + s)}x allein"
    rows = [(s * 100 + b, f"q{s}", own(s, b) + ("\nBitte nicht ohne Erlaubnis weitergeben" if b < (4 if s == 0 else 2) else "")) for s in range(8) for b in range(20)]
    assert _found(_blocks(spark, rows)) == [(b, 2) for b in range(4)]


def test_chance_does_not_pass_among_many_lines(spark, monkeypatch):
    # 4 of 20 blocks against the background are not enough among 4,000 lines of which next to none is in excess
    monkeypatch.setattr(B, "MIN_SHARE", 0.004)
    lines = [f"Zeile {''.join('akpxzgjs'[i >> 3 * k & 7] for k in range(4))} im Buch" for i in range(4000)]
    rows = [(b, "gross", "\n".join(lines[(b * 20 + j) % 4000] for j in range(20))) for b in range(1000)]
    rows += [(5000 + b, f"k{b % 40}", f"Anders {chr(97 + b % 26)}{chr(97 + b // 26)} gesagt worden") for b in range(400)]
    assert _found(_blocks(spark, rows)) == []


def test_misread_and_spaced_copies_count(spark):
    rows = [(i, "q", f"Text {chr(97 + i)}{chr(98 + i)}{chr(99 + i)} eigen hier\n" + t) for i, t in enumerate(["Bitte im Forum fragen", "BITTE IM FORUM FRAGEN.", "Bitte  im  Forurn fragen", "*Bitte im Forum frageu*", "x", "y"])]
    other = [(100 + i, "r", f"Ganz anderer Inhalt {chr(97 + i)}{chr(105 - i)}") for i in range(8)]
    assert _found(_blocks(spark, rows + other)) == [(i, 2) for i in range(4)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert _found(empty) == []
    assert B.without_source_lines(empty).count() == 0


def test_blocks_come_out_without_their_lines(spark):
    rows = {r.block_id: r for r in B.without_source_lines(_blocks(spark, [*_corpus(), (900, None, "bleibt"), (901, "quelle0", None)])).collect()}
    assert rows[500].removed == 1 and "Rechte" not in rows[500].markdown and rows[500].markdown.endswith("Eigene Zeile")
    assert rows[0].removed == 0 and "Rechte" in rows[0].markdown
    assert rows[900].markdown == "bleibt" and rows[901].markdown is None


def test_step_up_is_benjamini_hochberg():
    import numpy as np

    rng = np.random.default_rng(1)
    minus_ln_p = np.concatenate([rng.exponential(1, 500), rng.uniform(5, 40, 60)])
    bins = {}
    for x in minus_ln_p.astype(int):
        bins[int(x)] = bins.get(int(x), 0) + 1
    worst = B._step_up(bins)
    p = np.sort(np.exp(-minus_ln_p.astype(int).astype(float)))
    k = np.max(np.flatnonzero(p <= B.FDR * np.arange(1, len(p) + 1) / len(p)))
    assert np.isclose(np.exp(-float(worst)), p[k])


def test_hot_source_is_no_hot_task(spark):
    df = spark.range(3000).select(F.col("id").alias("block_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 50).cast("string"))).alias("source_pdf"), F.concat(F.lit("Zeile von "), F.translate(F.conv(F.col("id").cast("string"), 10, 8), "01234567", "akpxzgjs"), F.lit(" allein hier\nHinweis des Hauses dazu")).alias("markdown"))
    hot = df.withColumn("markdown", F.when(F.col("source_pdf") == "hot", F.col("markdown")).otherwise(F.substring_index("markdown", "\n", 1)))
    assert B.source_lines(hot).count() == 1000
