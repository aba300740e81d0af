import random

import pytest
from pyspark.sql import functions as F

from blattwerk.operators import layout as L

LINE = "page int, seq int, text string, x0 int, y0 int, x1 int, y1 int"


def _lines(spark, rows):
    return spark.createDataFrame([(1, i, t, x0, y0, x1, y0 + 14) for i, (t, x0, y0, x1) in enumerate(rows)], LINE)


def test_gutter(spark):
    ink = [40.0] * 1000
    for x in range(480, 520):
        ink[x] = 0.0
    ink[500] = 30.0  # a speck does not part it
    df = spark.createDataFrame([(1, x, v) for x, v in enumerate(ink)] + [(2, x, 40.0) for x in range(1000)], "page int, x int, ink double")
    r = L.gutter(df, "page", 1000).collect()
    assert [(x.page, x.center, x.wide) for x in r] == [(1, 0.5, 0.04)]


def _brute_columns(rs, width=1000):
    if len(rs) < 2:
        return None
    span = max(b for _, b in rs) - min(a for a, _ in rs)
    n = [(a, b) for a, b in rs if b - a <= 0.6 * span]
    if span <= 0 or len(n) < 2:
        return None
    taken = {i for a, b in n for i in range(int(a), int(b))}
    best, run = (0, None), []
    for i in [*range(300, 700), None]:
        if i is not None and i not in taken:
            run.append(i)
            continue
        if len(run) > best[0]:
            best = (len(run), (run[0] + run[-1] + 1) // 2)
        run = []
    if best[0] < 15:
        return None
    left, right = sum(b <= best[1] for _, b in n), sum(a >= best[1] for a, _ in n)
    return best[1] / 1000 if min(left, right) / len(n) >= 0.25 else None


def test_region_columns_equal_a_bitmap(spark):
    rng = random.Random(7)
    pages = {p: [(a, min(1000, a + rng.randrange(40, 480))) for a in (rng.choice([60, 80, 520, 540, rng.randrange(900)]) for _ in range(rng.randrange(1, 9)))] for p in range(150)}
    df = spark.createDataFrame([(p, "text", float(a), float(b)) for p, rs in pages.items() for a, b in rs], "page int, class string, x0 double, x1 double")
    got = {r.page: r.gutter for r in L.region_columns(df, "page", ["text"]).collect()}
    assert got == {p: _brute_columns(rs) for p, rs in pages.items()}
    assert any(got.values())


def test_reading_order_of_two_columns(spark):
    rows = [("kopf", 80, 20, 920)] + [(f"{'lr'[i % 2]}{i // 2}", 80 + 450 * (i % 2), 60 + 20 * (i // 2), 440 + 450 * (i % 2)) for i in range(12)] + [("fuß", 80, 400, 920)]
    got = [r.text for r in L.reading_order(_lines(spark, rows), "page").orderBy("ord").collect()]
    assert got == ["kopf", *(f"l{i}" for i in range(6)), *(f"r{i}" for i in range(6)), "fuß"]


def test_reading_order_keeps_every_line(spark):
    rng = random.Random(1)
    rows = [(f"t{i}", rng.randrange(600), rng.randrange(900), rng.randrange(600, 1000)) for i in range(40)]
    got = L.reading_order(_lines(spark, rows), "page").collect()
    assert sorted(r.ord for r in got) == list(range(1, 41)) and sorted(r.text for r in got) == sorted(t for t, *_ in rows)


def test_boxes(spark):
    box = lambda rows: spark.createDataFrame([(1, *r) for r in rows], "page int, x0 int, y0 int, x1 int, y1 int")
    kept = L.distinct_boxes(box([(0, 0, 100, 100), (3, 3, 103, 103), (0, 0, 50, 50)]), "page")
    assert sorted(tuple(r)[1:] for r in kept.collect()) == [(0, 0, 50, 50), (0, 0, 100, 100)] or kept.count() == 2
    stacked = L.stacked_boxes(box([(0, 0, 100, 20), (0, 22, 100, 40), (0, 60, 100, 80)]), "page")
    assert sorted(tuple(r)[1:] for r in stacked.collect()) == [(0, 0, 100, 40), (0, 60, 100, 80)]


def test_bold_by_ink(spark):
    rows = [(f"zeile {i}", 80, 60 + 20 * i, 900 if i else 400) for i in range(8)]
    df = _lines(spark, rows).withColumns({"density": F.when(F.col("seq") == 0, 0.5).otherwise(0.2), "height": F.lit(14)})
    assert [r.text for r in L.bold_lines(df, "page").orderBy("seq").collect()][:2] == ["**zeile 0**", "zeile 1"]


def test_ruled_tables(spark):
    cells = [(1, 0, 0, "Kopf", True), (1, 0, 1, "", False), (1, 0, 2, "B", False), (1, 1, 0, "a-\nb", False), (1, 1, 1, None, False), (1, 1, 2, "c|d", False), (1, 2, 0, "", False), (1, 2, 1, "", False), (1, 2, 2, " ", False), (2, 0, 0, "x", False), (2, 1, 0, "y", False)]
    r = L.ruled_tables(spark.createDataFrame(cells, "t int, row int, col int, text string, bold boolean"), ["t"]).collect()
    assert [(x.t, x.markdown) for x in r] == [(1, "| **Kopf** | B |\n| --- | --- |\n| ab | c\\|d |")]


def _grid(n=5, ask="?"):
    left = [(f"{i}. Frage {i}", 80, 60 + 60 * i, 400) for i in range(1, n + 1)] + [(f"weiter{ask}", 80, 80 + 60 * i, 400) for i in range(1, n + 1)]
    right = [(f"Antwort {i}", 520, 60 + 60 * i, 900) for i in range(1, n + 1)] + [("mit Text", 520, 80 + 60 * i, 900) for i in range(1, n + 1)]
    return [(*r, "l") for r in left] + [(*r, "r") for r in right]


@pytest.mark.parametrize(("ask", "head"), [("?", "| Frage | Antwort |"), (".", "|  |  |")])
def test_answers_become_tables(spark, ask, head):
    rows = [(1, i, t, x0, y0, x1, y0 + 14, s) for i, (t, x0, y0, x1, s) in enumerate(_grid(ask=ask))]
    got = L.answer_tables(spark.createDataFrame(rows, LINE + ", side string"), "page").collect()
    assert len(got) == 1
    assert got[0].text.split("\n")[0] == head and got[0].text.split("\n")[2] == f"| 1. Frage 1 weiter{ask} | Antwort 1 mit Text |"
    assert L.answer_tables(spark.createDataFrame(rows[:9], LINE + ", side string"), "page").count() == 0


def test_marks_join_what_follows(spark):
    got = L.joined_fragments(_lines(spark, [("1.", 80, 100, 95), ("Text", 110, 102, 400), ("fern", 800, 100, 900), ("unten", 80, 130, 300)]), "page", 1000.0)
    assert [r.text for r in got.orderBy("i").collect()] == ["1. Text", "fern", "unten"]


def test_note_numbers_join_their_text(spark):
    got = L.numbered_notes(_lines(spark, [("Text", 80, 100, 900), ("3", 60, 920, 70), ("Vgl. dazu", 90, 922, 900), ("4", 60, 100, 70), ("Oben", 90, 100, 900)]), "page")
    assert [r.text for r in got.orderBy("seq").collect()] == ["Text", "3 Vgl. dazu", "4", "Oben"]


def test_margin_labels_move_before_their_block(spark):
    rows = [(f"zeile {i}", 130, 60 + 20 * i, 900) for i in range(6)]
    rows[3:3] = [("**Hinweis:**", 80, 120, 120)]
    got = [r.seq for r in L.margin_labels_first(_lines(spark, rows), "page").orderBy("ord").collect()]
    assert got[0] == 3 and sorted(got) == list(range(7))
    same = [(t, 130, y, x1) for t, _, y, x1 in rows]
    assert [r.seq for r in L.margin_labels_first(_lines(spark, same), "page").orderBy("ord").collect()] == list(range(7))


def test_failing_rows_are_tried_again(spark):
    work = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    seen = []

    def attempt(df, n):
        seen.append(sorted(r.id for r in df.collect()))
        return df.select("id", F.lit(n).alias("n"), F.when((F.col("id") == 2) & (F.lit(n) == 0), 9.0).when(F.col("id") == 3, 5.0 + n).otherwise(0.0).alias("p"))

    got = L.retried(work, attempt, F.col("p") > 1, "id", "p")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 0.0), (2, 1, 0.0), (3, 0, 5.0)]
    assert seen == [[1, 2, 3], [2, 3]]


def _bands(rows, reach):
    """Lines on one baseline, one after the other, and marks joined from left to right."""
    bands = []
    for t, x0, y0, x1, y1 in sorted(rows, key=lambda r: r[2]):
        last = bands[-1] if bands else None
        if last and min(max(r[4] for r in last), y1) - y0 > 0.5 * (min(max(r[4] for r in last) - min(r[2] for r in last), y1 - y0) or 1):
            last.append((t, x0, y0, x1, y1))
        else:
            bands.append([(t, x0, y0, x1, y1)])
    out = []
    for b in bands:
        b = sorted(b, key=lambda r: (r[1], r[2]))
        while b:
            r = b.pop(0)
            if b and r[0] in ("1.", "a)", "-") and 0 <= b[0][1] - r[3] < reach:
                n = b.pop(0)
                r = (f"{r[0]} {n[0]}", r[1], min(r[2], n[2]), n[3], max(r[4], n[4]))
            out.append(r)
    return out


def test_marks_and_bands_equal_a_walk(spark):
    rng = random.Random(8)
    pages = {}
    for p in range(40):
        rows, seen = [], set()
        for _ in range(25):
            x0, y0 = rng.randrange(0, 300), rng.randrange(0, 150)
            if (x0, y0) not in seen and y0 not in {y for _, y in seen}:
                seen.add((x0, y0))
                rows.append((rng.choice(["1.", "a)", "-", "Text", "Wort"]), x0, y0, x0 + rng.randrange(5, 80), y0 + rng.randrange(1, 20)))
        pages[p] = rows
    df = spark.createDataFrame([(p, i, *r) for p, rows in pages.items() for i, r in enumerate(rows)], "page int, seq int, text string, x0 int, y0 int, x1 int, y1 int")
    got = {}
    for r in L.joined_fragments(df, "page", 1000.0).orderBy("page", "i").collect():
        got.setdefault(r.page, []).append((r.text, r.x0, r.y0, r.x1, r.y1))
    assert got == {p: _bands(rows, 60) for p, rows in pages.items()}


def test_stacked_boxes_equal_a_walk(spark):
    rng = random.Random(9)
    pages = {p: [(rng.choice([0, 2, 4, 6, 9]), y := rng.randrange(0, 200), 100 + rng.choice([0, 3, 6]), y + rng.randrange(5, 30)) for _ in range(20)] for p in range(40)}
    want = {}
    for p, rows in pages.items():
        out = []
        for x0, y0, x1, y1 in sorted(rows, key=lambda r: (r[0], r[2], r[1], r[3])):
            if out and abs(out[-1][0] - x0) <= 4 and abs(out[-1][2] - x1) <= 4 and y0 - out[-1][3] <= 5:
                out[-1] = (out[-1][0], min(out[-1][1], y0), out[-1][2], max(out[-1][3], y1))
            else:
                out.append((x0, y0, x1, y1))
        want[p] = sorted(out)
    df = spark.createDataFrame([(p, *r) for p, rows in pages.items() for r in rows], "page int, x0 int, y0 int, x1 int, y1 int")
    got = {}
    for r in L.stacked_boxes(df, "page").collect():
        got.setdefault(r.page, []).append((r.x0, r.y0, r.x1, r.y1))
    assert {p: sorted(v) for p, v in got.items()} == want


def test_lines_of_a_text_layer(spark):
    rows = [
        (1, 0, 0, "Der", "Times", 0, False, 60.0, 100.0, 300.0, 112.0), (1, 0, 1, " Kläger ", "Times-Bold", 0, False, 60.0, 100.0, 300.0, 112.0), (1, 0, 2, " siegt", "Times", 16, False, 60.0, 100.0, 300.0, 112.0),
        (1, 1, 0, "o", "Courier", 0, False, 60.0, 130.0, 66.0, 142.0), (1, 2, 0, "Punkt", "Times", 0, False, 80.0, 130.0, 200.0, 142.0),
        (1, 3, 0, "in der Tabelle", "Times", 0, False, 100.0, 410.0, 200.0, 422.0), (1, 4, 0, "Rand", "Times", 0, True, 10.0, 50.0, 20.0, 200.0), (1, 5, 0, "  ", "Times", 16, False, 60.0, 300.0, 61.0, 312.0), (1, 6, 0, None, None, None, None, 1.0, 1.0, 1.0, 1.0),
    ]
    spans = spark.createDataFrame(rows, "page int, line int, span int, text string, font string, flags int, upright boolean, x0 double, y0 double, x1 double, y1 double")
    tables = spark.createDataFrame([(1, "| a | b |", 90.0, 400.0, 500.0, 500.0)], "page int, markdown string, x0 double, y0 double, x1 double, y1 double")
    got = [(r.text, r.marker, r.x0, r.y0) for r in L.text_lines(spans, "page", tables).orderBy("seq").collect()]
    assert got == [("| a | b |", "tabelle", 151, 475), ("Der **Kläger** **siegt**", None, 100, 118), ("- Punkt", None, 100, 154), ("Rand", None, 16, 59)]
    assert L.text_lines(spans.where("false"), "page").count() == 0
