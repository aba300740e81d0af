import random

import numpy as np

from blattwerk.llm import repetition as R
from blattwerk.llm.textkernel import tokens

WORDS = ["haus", "garten", "strasse", "vertrag", "klage", "frist", "antrag", "gericht", "kaufen", "mieten", "hafen", "lager", "wasser", "bruecke", "zahlung", "recht", "pflicht", "schaden"]


def _text(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "en", "ung", "lich"]) + rng.choice("xyzk") for _ in range(n))


def _brute(words, n=R.PASSAGE):
    seen, cover = set(), set()
    for i in range(len(words) - n + 1):
        g = tuple(words[i : i + n])
        if g in seen:
            cover.update(range(i, i + n))
        seen.add(g)
    return len(cover) / len(words) if words else 0.0


def _corpus():
    rng = random.Random(5)
    out = []
    for i in range(120):
        t = _text(rng, 80)
        if i % 4 == 0:
            p = " ".join(t.split()[: 8 + i % 11])
            t = t + "\n" + "\n".join([p] * (1 + i % 6))
        out.append((i, t))
    return out


def test_share_equals_brute_force(spark):
    rows = _corpus()
    got = {r.id: r for r in R.repetition(spark.createDataFrame(rows, "id bigint, text string"), "id", "text").collect()}
    for i, t in rows:
        assert np.isclose(got[i].repeated_share, _brute(tokens([t], True).h.tolist())), i


def test_share_does_not_depend_on_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(R, "threshold", lambda ratios: -1e9)  # every text lies above it
    rows = _corpus()
    got = {r.id: r.repeated_share for r in R.repetition(spark.createDataFrame(rows, "id bigint, text string"), "id", "text").collect()}
    want = {i: _brute(tokens([t], True).h.tolist()) for i, t in rows}
    assert any(0 < x < R.MIN_SHARE for x in want.values())
    for i in want:
        assert np.isclose(got[i], want[i]), i


def test_threshold_loses_no_case(spark):
    rows = _corpus()
    df = spark.createDataFrame(rows, "id bigint, text string")
    ratios = R.log_ratios(R.measured(df, None).select("features"))
    at_most = R.threshold(ratios)
    llr = {r.id: r.llr for r in R.repetition(df, "id", "text").collect()}
    for i, t in rows:
        if _brute(tokens([t], True).h.tolist()) >= R.MIN_SHARE:
            assert llr[i] <= at_most


def test_lines_that_come_back_in_the_preview_are_no_own_words(spark, monkeypatch):
    monkeypatch.setattr(R, "fit_on_sample", lambda blocks: None)
    title = "Zwirbelkunde Quastenheim Ollrich Wumpe Trallerbach Hunnig Pleustadt Grimmel"
    rng = random.Random(3)
    rows = [(i, "eigen", f"{title}\n{_text(rng, 12)}\n{title}") for i in range(20)]
    got = R.block_repetition(spark.createDataFrame(rows, "block_id bigint, name string, markdown string")).collect()
    assert len(got) == 20 and {r.repeated_share for r in got} == {0.0}


def test_copies_may_differ_in_case_numbers_breaks_and_glyphs():
    p = "Der Vertrag vom 12. Mai wurde nach langer Zeit endlich geprüft und genehmigt"
    q = "DER Verfrag vom 99. Mai wurde nach lan-\nger Zeit endlich geprüft und genehrnigt!"
    t = tokens([p + "\n" + q], True)
    assert R.repeated_words(t).mean() >= 0.45


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "a b c", 5), (3, "wort", 5), (4, "x " * 10, 5), (5, "gleiche worte " * 100_000, 5), (5, "gleiche worte " * 100_000, 5)], "id bigint, text string, llr int")
    got = sorted((r.id, round(r.repeated_share, 2)) for r in R.repetition(df, "id", "text").collect())
    assert got == [(1, 0.0), (2, 0.0), (3, 0.0), (4, 0.0), (5, 1.0), (5, 1.0)]
    assert R.repetition(df.where("false"), "id", "text").count() == 0


def test_registered_blocks(spark, data):
    b = spark.read.parquet(f"{data}/page_block.parquet")
    found = {r.block_id for r in R.repeated_blocks(b).collect()}
    twice = {r.block_id for r in R.repeated_blocks(b.unionByName(b)).collect()}
    assert found and found == twice
