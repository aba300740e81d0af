import pytest
from pyspark.sql import functions as F

from blattwerk.operators import documents as D
from blattwerk.operators import paragraphs as P
from blattwerk.operators import review as R
from blattwerk.sources import parse

DOC = """---
titel: "Fall 1"
quelle-pdf: "raw/a.pdf"
seiten: 3
titel: zuletzt
---
Quelle: [[raw/a.pdf]]
Vorwort

%% S. 1 | textlayer %%

Text eins
```
%% S. 9 %%
```
%% p. 2 | ocr | zweispaltig, senkrecht @48% %%
Text zwei[^1]

%% S. 3 | seltsam %%
"""


def _doc(spark, text=DOC):
    return spark.createDataFrame([("d", text)], "name string, t string")


def test_blocks_fences_and_fields(spark):
    rows = {r.block: r for r in parse.preview_blocks(_doc(spark), "name", "t").collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert rows[0].markdown == "Vorwort"
    assert "%% S. 9 %%" in rows[1].markdown and (rows[1].page, rows[1].origin) == (1, "textlayer")
    assert (rows[2].page, rows[2].origin, rows[2].layout) == (2, "ocr", "zweispaltig, senkrecht @48%")
    assert (rows[3].page, rows[3].origin, rows[3].layout, rows[3].markdown) == (3, None, "seltsam", "")


def test_head(spark):
    df = _doc(spark)
    assert df.select(parse.head(F.col("t")).alias("h")).first()["h"] == {"titel": "zuletzt", "quelle-pdf": "raw/a.pdf", "seiten": "3"}
    assert df.select(parse.source_link(F.col("t")).alias("l")).first()["l"] == "raw/a.pdf"
    open_head = _doc(spark, "---\na: b\nText")
    assert open_head.select(parse.head(F.col("t")).alias("h")).first()["h"] == {}


def test_round_trip(spark):
    pages = spark.createDataFrame([("d", i, o, l, f"Text {i}\n\n```\n%% S. 7 %%\n```") for i, o, l in ((1, "ocr", "ganz"), (2, "textlayer", None), (3, "diagram", None))], "name string, page_no int, origin string, layout string, markdown string")
    back = parse.preview_blocks(D.build(pages, "name"), "name", "document").where("block > 0").select("name", F.col("page").alias("page_no"), "origin", "layout", "markdown")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pages.collect()))
    assert parse.plain_pages(D.build(pages, "name", last_page=F.lit(2)), "name", "document").count() == 2


def test_head_leaves_out_what_says_nothing(spark):
    df = spark.createDataFrame([("Fall", 'a "b".pdf', 3, 0, None)], "title string, source_pdf string, pages int, pages_diagram int, aborted string")
    h = df.select(D.head(df.columns).alias("h")).first()["h"]
    assert h == '---\ntitel: Fall\nquelle-pdf: "a \\"b\\".pdf"\nseiten: 3\nvorschau-format: 1\n---\n'


def test_tagged_lines_and_word_boxes(spark):
    t = "".join(f"<|LOC_{n}|>" for n in (10, 20, 90, 20, 90, 40, 10, 40)) + "Text\n\n<|LOC_1|>Rest\n   "
    rows = parse.tagged_lines(_doc(spark, t), "name", "t").orderBy("seq").collect()
    assert [(r.text, r.box and tuple(r.box)) for r in rows] == [("Text", (10, 20, 90, 40)), ("Rest", None)]
    w = parse.word_boxes(_doc(spark, '<page width="595.0" height="842"><word xMin="1.5" yMin="2" xMax="3" yMax="4.25">a</word>'), "name", "t").collect()
    assert [(r.page_width, r.x_min, r.y_min, r.x_max, r.y_max) for r in w] == [(595.0, 1.5, 2.0, 3.0, 4.25)]


def test_form_feeds_and_word_lists(spark):
    assert [r.text for r in parse.form_feed_pages(_doc(spark, "a\fb\f \n"), "name", "t").orderBy("page_no").collect()] == ["a", "b"]
    df = spark.createDataFrame([("3",), ("Haus/ESm",), ("# nein",), ("Garten\tx",), ("haus",), ("",)], "value string")
    assert sorted(r.word for r in parse.dictionary_words(df).collect()) == ["garten", "haus"]


@pytest.mark.parametrize(("text", "want"), [("1,3-5,8", [1, 3, 4, 5, 8]), ("2-2", [2]), ("7-12", [7, 8, 9, 10]), ("", [])])
def test_page_selection(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse.page_selection(F.col("t"), F.lit(10), strict=False).alias("p")).first()["p"] == want


def test_strict_selection_raises(spark):
    df = spark.createDataFrame([("1,99",)], "t string")
    with pytest.raises(Exception, match="no such pages"):
        df.select(parse.page_selection(F.col("t"), F.lit(10), strict=True).alias("p")).collect()


LINES = "page int, seq int, text string, x0 int, y0 int, x1 int, y1 int, marker string"


def _assembled(spark, rows):
    df = spark.createDataFrame([(1, i, t, x0, y0, x1, y0 + 14, m) for i, (t, x0, y0, x1, m) in enumerate(rows)], LINES)
    return [r.text for r in P.assemble(df, "page").orderBy("par_no").collect()]


def test_paragraphs(spark):
    rows = [("Der Vertrag ist wirk-", 80, 100, 900, None), ("sam geschlossen, weil", 80, 120, 900, None), ("beide zustimmten.", 80, 140, 500, None), ("Ein neuer Gedanke.", 80, 220, 900, None), ("– 3 –", 480, 960, 520, None)]
    assert _assembled(spark, rows) == ["Der Vertrag ist wirksam geschlossen, weil beide zustimmten.", "Ein neuer Gedanke."]


def test_headings_and_items_open_paragraphs(spark):
    rows = [("I. Anspruch", 80, 100, 300, None), ("Der Text dazu folgt", 80, 120, 900, None), ("- ein Punkt", 80, 140, 500, None), ("im Kasten", 80, 160, 500, "kasten0")]
    assert _assembled(spark, rows) == ["### I. Anspruch", "Der Text dazu folgt", "- ein Punkt", "im Kasten"]


def test_repetitions():
    assert P.trim_line("a b c d " * 30 + "ende") == "a b c d a b c d ende"
    assert P.trim_line(" ".join(["x"] * 40)) == "x x"
    assert P.trim_line(" ".join(f"({i})" for i in range(100))) == "(0) (1)"
    assert P.trim_line("ein ganz normaler Satz ohne Wiederholung") == "ein ganz normaler Satz ohne Wiederholung"


def test_seams(spark):
    tail = "wer das prüft der findet am Ende auch die richtige Lösung im Gesetz"
    df = spark.createDataFrame([("d", 1, "Anfang " + tail), ("d", 2, tail + " und weiter"), ("d", 3, "etwas anderes ganz")], "k string, o int, t string")
    assert {r.o: r.cut for r in P.seam_overlaps(df, "k", "o", "t").collect()} == {2: 13, 3: 0}


def test_footnotes(spark):
    rows = ["Das gilt.1 Nach § 2 auch hier2 so.", "| 1 | Tabelle |", "1 Erste Note.", "**2 Zweite** Note. 3 Dritte Note.", "Vgl. Abs.1 und x1 sowie x1; y3"]
    df = spark.createDataFrame([("p", i, t) for i, t in enumerate(rows)] + [("q", 0, "ohne1 Note"), ("q", 1, None)], "page string, par_no int, text string")
    got = {}
    for r in P.footnotes(df, "page").orderBy("page", "par_no").collect():
        got.setdefault(r.page, []).append(r.text)
    assert got["p"] == ["Das gilt.[^1] Nach § 2 auch hier[^2] so.", "| 1 | Tabelle |", "Vgl. Abs.1 und x[^1] sowie x1; y[^3]", "", "[^1]: Erste Note.", "[^2]: Zweite Note.", "[^3]: Dritte Note."]
    assert got["q"] == ["ohne1 Note", ""]


def test_tables_are_paragraphs_of_their_own(spark):
    rows = [("Davor steht ein Satz und", 80, 100, 900, None), ("| a | b |\n| 1 | 2 |", 80, 120, 900, "tabelle"), ("| c | d |", 80, 140, 900, "tabelle"), ("danach geht es weiter.", 80, 200, 500, None)]
    assert _assembled(spark, rows) == ["Davor steht ein Satz und", "| a | b |\n| 1 | 2 |", "| c | d |", "danach geht es weiter."]


def test_lines_without_a_place_and_running_lines_of_their_document(spark):
    text = [("Der Satz beginnt hier und", 100), ("geht ohne Platz weiter", None), ("bis zu seinem Ende.", 140), ("Kopf der Zeitschrift", 20), ("Neuer Satz nach der Lücke.", 300)]
    rows = [(d, p, i, t, None if y is None else 80, y, None if y is None else 900, None if y is None else y + 14, None) for d, p in (("a", 1), ("b", 2)) for i, (t, y) in enumerate(text)]
    df = spark.createDataFrame(rows, "doc string, page int, seq int, text string, x0 int, y0 int, x1 int, y1 int, marker string")
    running = spark.createDataFrame([("a", "Kopf der Zeitschrift")], "doc string, line string")
    got = {}
    for r in P.assemble(df, "page", running, "doc").orderBy("page", "par_no").collect():
        got.setdefault(r.page, []).append(r.text)
    assert got[1] == ["Der Satz beginnt hier und geht ohne Platz weiter bis zu seinem Ende.", "Neuer Satz nach der Lücke."]
    assert got[2] == ["Der Satz beginnt hier und geht ohne Platz weiter bis zu seinem Ende.", "Kopf der Zeitschrift", "Neuer Satz nach der Lücke."]
    assert P.assemble(df.where("false"), "page", running, "doc").count() == 0


def test_labels_and_notes_take_their_place(spark):
    body = [(f"zeile {i} des Textes", 130, 60 + 20 * i, 900, None) for i in range(5)]
    rows = [*body[:3], ("**Hinweis:**", 80, 120, 110, None), *body[3:], ("1", 60, 940, 70, None), ("Vgl. dazu oben.", 90, 942, 900, None)]
    got = _assembled(spark, rows)
    assert got[0].startswith("**Hinweis:**") and got[-1] == "[^1]: Vgl. dazu oben." and got[-2] == ""


def _sequential(lines):
    """Boundaries one line after the other, from the same flags."""
    begins, first, cover, bold = [], None, 0, True
    for i, r in enumerate(lines):
        if r["free"]:
            b = True
        elif r["joins"]:
            b = False
        else:
            p = lines[i - 1]
            title = (p["heading"] and begins[-1] and not p["full"]) or (p["short"] and first["level"] is not None and (cover <= 90 or bold))
            inside = r["x0"] is not None and first["x0"] is not None and r["x0"] > first["x0"] + 8
            b = r["parts"] or (r["heading"] and not (r["goes_on"] or inside)) or title or r["otherwise"]
        begins.append(b)
        if b:
            first, cover, bold = r, r["chars"], r["bold"]
        else:
            cover, bold = cover + r["cover"], bold and r["bold"]
    return begins


def test_boundaries_equal_one_line_after_the_other(spark):
    import random

    rng = random.Random(4)
    flag = lambda p: rng.random() < p
    rows = []
    for page in range(60):
        for at in range(rng.randrange(1, 40)):
            heading = flag(0.5)
            rows.append((page, at, at == 0 or flag(0.03), flag(0.1), flag(0.1), heading, flag(0.3), flag(0.3), rng.choice([None, 80, 85, 100]), flag(0.5), rng.choice([None, None, 2, 4]), rng.randrange(5, 60), heading or flag(0.1), flag(0.2), 0))
    cols = "page int, at int, free boolean, joins boolean, parts boolean, heading boolean, goes_on boolean, otherwise boolean, x0 int, short boolean, level int, chars int, bold boolean, full boolean, cover int"
    df = spark.createDataFrame(rows, cols).withColumn("cover", F.when(F.col("joins"), F.col("chars") - 1).otherwise(F.col("chars") + 1)).withColumn("parts", F.col("parts") | F.col("free"))
    pages = {}
    for r in P.boundaries(df, "page").orderBy("page", "at").collect():
        pages.setdefault(r.page, []).append(r.asDict())
    assert len(pages) == 60
    for lines in pages.values():
        assert [r["begins"] for r in lines] == _sequential(lines)


FILES = "name string, path string, location string, frontmatter map<string,string>"
STATES = "name string, status string, path string, ocr_date string, ocr_timestamp string, decided string"


@pytest.mark.parametrize(
    ("files", "state", "want"),
    [
        ([("accepted", None)], None, ("accepted", "new")),
        ([("open", "D1")], ("accepted", "D1"), ("open", "corrected")),
        ([("accepted", None)], ("open", None), ("accepted", "corrected")),
        ([("open", "D2"), ("accepted", "D1")], ("accepted", "D1"), ("re-created", "re-created")),
        ([("open", "D2")], ("rejected", "D1"), ("re-created", "re-created")),
        ([("open", "D2")], ("re-created", "D2"), ("re-created", "kept")),
        ([], ("accepted", "D1"), ("adopted", "adopted")),
    ],
)
def test_reconcile(spark, files, state, want):
    f = spark.createDataFrame([("n", f"{loc}/n.md", loc, {"ocr-datum": d} if d else None) for loc, d in files], FILES)
    s = spark.createDataFrame([("n", state[0], "alt/n.md", state[1], None, "2025")] if state else [], STATES)
    there = spark.createDataFrame([("alt/n.md",)], "path string")
    r = R.reconcile(f, s, there).first()
    assert (r.status, r.action) == want
    if not files:
        assert R.reconcile(f, s).count() == 0


def test_each_block_once(spark):
    from blattwerk.sources.pages import once

    rows = [(1, 5, "a"), (1, 7, "a"), (2, 1, "b"), (None, 1, "c"), (None, 1, "c")]
    df = spark.createDataFrame(rows, "k int, t int, x string")
    assert sorted(map(str, once(df, "k", "t").collect())) == sorted(map(str, df.where("NOT (k <=> 1 AND t = 7)").collect()))
    alike = df.unionByName(df.where("k = 2"))
    assert once(alike, "k", "t").where("k = 2").count() == 1 and once(alike, "k", "t").count() == 4
    assert once(df.where("false"), "k", "t").count() == 0
