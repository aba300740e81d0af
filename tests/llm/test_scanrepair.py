import numpy as np
import pytest

from blattwerk.llm import scanrepair as S
from blattwerk.llm.furniture import BUCKETS, UNSEEN, LineModel

SCHEMA = "block_id bigint, name string, origin string, markdown string, word string, kind string"
CLEAN = "Der Vertrag wurde geprüft und die Genehmigung erteilt. Die Zustimmung des Gerichts fehlt, weil nichts bestimmt war."
SCAN = "Der Verfrag wurde geprüft und die Geneh-\nmigung erteilt. Die Zustimrnung des\nSeite l4\nGerichts fehlt, weil nichts be¬\nstimmt war. Kauf-\nund Mietrecht gelten.\n– 3 –"


def _df(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def _rows(scan=SCAN, origin="ocr"):
    return [*((i, f"klar{i}", "textlayer", CLEAN + f" Kauf und Mietrecht gelten {i}.") for i in range(12)), (100, "scan", origin, scan)]


def _found(df):
    return sorted((r.block_id, r.line_no, r.kind, r.word) for r in S.found_defects(df).collect())


WANT = [
    (100, 1, "break", "Genehmigung"),
    (100, 1, "misread", "Vertrag"),
    (100, 2, "misread", "Zustimmung"),
    (100, 3, "furniture", ""),
    (100, 4, "break", "bestimmt"),
    (100, 7, "furniture", ""),
]


def test_breaks_misreads_and_page_numbers(spark):
    assert _found(_df(spark, _rows())) == WANT


def test_repeated_and_odd_rows(spark):
    odd = [(100, "scan", "ocr", SCAN), (None, "scan", "ocr", SCAN), (101, "scan", "ocr", None), (102, "scan", "ocr", ""), (103, None, None, None)]
    assert _found(_df(spark, _rows() + odd)) == WANT
    assert _found(_df(spark, [])) == []


def test_unknown_origin_is_told_by_its_lines(spark):
    assert _found(_df(spark, _rows(origin=None))) == WANT
    long = [(200, "klar2", None, (CLEAN + " ") * 4 + "Verfrag")]
    assert [f for f in _found(_df(spark, _rows() + long)) if f[0] == 200] == []


@pytest.mark.parametrize("text", ["% $ ~ ^^ °° ¦¦ e\n»« ## ++ == ~~ \\ || a\n** // °° ^^ 0 1", "S p e i c h e r p f l i c h t\nB e w e i s m a n g e l a u f\nR ü c k g a b e k l a g e", "Eins ....... 12\nZwei ........ 14\nDrei ...... 20"])
def test_junk_holds_nothing(text):
    assert S.is_junk(text.split("\n"))


def test_prose_and_tables_are_no_junk():
    assert not S.is_junk(SCAN.split("\n"))
    assert not S.is_junk(["| a | b |", "| --- | --- |", "| Kauf | 3 |"])


def _spelling(spark, rows):
    df = spark.createDataFrame(rows, "form string, trusted bigint, other bigint")
    return {r.form: {o.right for o in r.options} for r in S.spelling(df).collect()}


def test_right_form_is_supported_and_nearest(spark):
    rows = [("nach", 900, 900), ("noch", 200, 200), ("uoch", 0, 2), ("nacb", 0, 3), ("Nacb", 0, 1), ("Nach", 50, 60)]
    assert _spelling(spark, rows) == {"uoch": {"noch"}, "nacb": {"nach"}, "Nacb": {"Nach"}}
    assert _spelling(spark, [*rows, ("n0ch", 0, 1)])["n0ch"] == {"nach", "noch"}


def test_capitals_and_long_forms(spark):
    long = "Donau" * 14 + "haftung"
    rows = [("Genehmigung", 50, 10), ("GENEHM1GUNG", 0, 1), ("lll", 40, 0), ("III", 0, 2), (long, 9, 0), (long.replace("f", "t"), 0, 1), (None, 1, 1)]
    assert _spelling(spark, [r for r in rows if r[0]]) == {"GENEHM1GUNG": {"GENEHMIGUNG"}, long.replace("f", "t"): {long}}


def test_a_skeleton_with_thousands_of_forms(spark):
    import itertools

    forms = ["".join(p) for p in itertools.product("lir1", repeat=5)]
    rows = [("lilli", 500, 0), *((f, 0, 1) for f in forms if f != "lilli")]
    got = _spelling(spark, rows)
    assert set().union(*got.values()) == {"lilli"} and len(got) > 100


def test_filter_holds_every_form(spark):
    forms = [f"wort{i}ä" for i in range(5000)]
    maybe = S._Maybe(S.form_filter(spark.createDataFrame([(f,) for f in forms], "form string")))
    assert all(maybe[f] for f in forms)
    assert sum(maybe[f"anders{i}"] for i in range(5000)) < 100


def test_neighbours_decide_between_right_forms(spark):
    clean = [(i, f"k{i}", "textlayer", t) for i, t in enumerate(["Er kommt nach Hause und fragt.", "Sie ist weder hier noch dort zu sehen."] * 6)]
    scan = [(100, "scan", "ocr", "Er kommt n0ch Hause und\nist weder hier n0ch dort.")]
    assert _found(_df(spark, clean + scan)) == [(100, 1, "misread", "nach"), (100, 2, "misread", "noch")]


def test_misread_words_of_aligned_tables_are_found(spark):
    table = "Verfrag" + " " * 60 + "Frist\nGenehmigung" + " " * 60 + "Gericht\nZustimmung" + " " * 60 + "Vertrag"
    assert not S.is_junk(table.split("\n"))
    rows = [*_rows()[:-1], (400, "tafel", "ocr", table)]
    assert _found(_df(spark, rows)) == [(400, 1, "misread", "Vertrag")]


def test_lines_that_come_back_are_stamped_whatever_the_sample_holds(spark, monkeypatch):
    monkeypatch.setattr(S, "fit_on_sample", lambda blocks: LineModel(np.full(BUCKETS, UNSEEN, np.float32), -1.0))
    pages = [(200 + i, "eigen", "ocr", f"Zwirbelkunde Quastenheim Ollrich Wumpe {i}\nAuf dieser Seite steht ein Satz {'pxzjk'[i % 5]}{'aegb'[i // 5]}sk allein.") for i in range(20)]
    other = [(300 + i, f"fremd{i}", "ocr", "Zwirbelkunde Quastenheim Ollrich Wumpe 7") for i in range(2)]
    found = [f for f in _found(_df(spark, pages + pages[:5] + other)) if f[2] == "furniture"]
    assert found == [(200 + i, 1, "furniture", "") for i in range(20)]


def test_repaired_paragraphs(spark):
    got = {r.block_id: r.paragraphs for r in S.repaired(_df(spark, _rows())).collect()}
    assert got[100] == ["Der Vertrag wurde geprüft und die Genehmigung erteilt. Die Zustimmung des Gerichts fehlt, weil nichts bestimmt war. Kauf- und Mietrecht gelten."]


def test_repair_keeps_to_the_token(spark):
    clean = [(i, f"k{i}", "textlayer", "Die edle Frau und die alte Mühle. Er las die Zeitung.") for i in range(40)]
    scan = [(100, "scan", "ocr", "Eine dle edle Frau, dle-dle und die alte\nMühle. Er las dle Zeitung.\n\nDie edle dle Mühle")]
    rows = clean + scan + scan
    want = ["Eine die edle Frau, die-die und die alte Mühle. Er las die Zeitung.", "Die edle die Mühle"]
    assert {r.block_id: r.paragraphs for r in S.repaired(_df(spark, rows)).collect()} == {100: want}


def _noisy(rng, text, width=40):
    """Printed lines of a text with parted and misread words, a running header and a page number."""
    lines, now = [], ""
    for w in text.split():
        if rng.random() < 0.06 and len(w) > 5:
            w = w.replace("rn", "m", 1) if "rn" in w else w.replace("h", "b", 1) if "h" in w[1:] else w
        if len(now) + len(w) + 1 > width:
            if len(w) > 9 and w.isalpha() and w[5].islower() and rng.random() < 0.7:
                lines.append((now + " " + w[:5] + "-").strip())
                now = w[5:]
                continue
            lines.append(now)
            now = w
        else:
            now = (now + " " + w).strip()
    return [*lines, now]


def test_planted_noise_is_undone(spark):
    import random

    rng = random.Random(11)
    words = "Genehmigung Lieferung Verwaltung geprüft erteilt Zustimmung Gerichts Vertragspartner behauptet Versicherung gehört scheinbar Nachbarschaft erhebliche Lagerhaus Wahrheit".split()
    texts = [" ".join(rng.choice(words) for _ in range(60)).capitalize() + "." for _ in range(30)]
    clean = [(i, f"klar{i}", "textlayer", t) for i, t in enumerate(texts * 3)]
    scans = []
    for i in range(12):
        lines = _noisy(rng, texts[i])
        scans.append((500 + i, "band", "ocr", "\n".join([f"Handbuch der Hafenkunde Band {i + 1}", *lines, f"– {i + 7} –"])))
    got = {r.block_id: r.paragraphs for r in S.repaired(_df(spark, clean + scans)).collect()}
    right = sum(got[500 + i] == [texts[i]] for i in range(12))
    assert right >= 11
