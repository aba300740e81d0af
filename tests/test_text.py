import pytest
from pyspark.sql import functions as F

from blattwerk.functions import measures as M
from blattwerk.functions import text as T
from blattwerk.operators import boilerplate, gate, outline, vocabulary


def _one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (T.clean_line, r"\(\underline{\text{Fall}}\) a $\rightarrow$ b", "Fall a → b"), (T.clean_line, "§ § 929, 930", "§§ 929, 930"), (T.clean_line, "$5 BGB  ", "§ 5 BGB"), (T.clean_line, "siehe^{3}", "siehe[^3]"),
        (T.clean_line, "§ 823 | BGB", "§ 823 I BGB"), (T.clean_line, " Punkt ", "• Punkt ▪"), (T.balance_bold, "**a** b **c", "**a** b c"), (T.balance_bold, "**a**", "**a**"),
        (T.clean_cell, " Ver-\n trag | x\n y", "Vertrag \\| x y"), (T.seam_key, "Ab-1 Ä!", "ab1ä"), (T.blind_digits, "a12b3", "a#b#"), (T.plain_text, "%% S. 1 %%\n# A\n> **b** | [^2]", "A b 2"),
        (T.natural_key, "img10", "img0000000010"), (outline.format_heading, "I. Anspruch", "### I. Anspruch"), (outline.format_heading, "a) Das ist ein Satz, der endet.", "**a)** Das ist ein Satz, der endet."),
    ],
)
def test_texts(spark, f, text, want):
    assert _one(spark, text, f) == want


@pytest.mark.parametrize(("text", "want"), [("(1) eins", 6), ("aa) zwei", 6), ("b) drei", 5), ("2. vier", 4), ("IV. fünf", 3), ("C. sechs", 2), ("B. G. B.", None), ("Text", None)])
def test_levels(spark, text, want):
    assert _one(spark, text, outline.level) == want


@pytest.mark.parametrize(
    ("text", "y", "want"),
    [("– 4 –", 500, True), ("hemmer", None, True), ("Seite 3", 500, True), ("12", 960, True), ("12", 500, False), ("Berlin - Bonn - Köln", 400, True), ("Der Anspruch besteht.", 960, False), ("", 10, False)],
)
def test_boilerplate(spark, text, y, want):
    df = spark.createDataFrame([(text, y)], "t string, y int")
    assert df.select(boilerplate.boilerplate(F.col("t"), F.col("y")).alias("b")).first()["b"] is want


@pytest.mark.parametrize(("text", "want"), [("eins zwei drei vier fünf " * 30, 30), (" ".join(f"({i})" for i in range(1982, 2260)), 274), ("nur ein Satz ohne jede Wiederholung in zehn Worten hier", 1), ("kurz", 0), ("", 0)])
def test_loops(spark, text, want):
    assert _one(spark, text, gate.loop_length) == want


def test_verdicts(spark):
    df = spark.createDataFrame([(9, 500, 500.0), (1, 100, 500.0), (1, 2000, 500.0), (1, 100, 200.0), (1, 500, None)], "l int, c int, e double")
    assert [r[0] for r in df.select(M.derailment(F.col("l"), F.col("c"), F.col("e"))).collect()] == ["loop", "cut short", "too long", None, None]
    assert [r[0] for r in df.select(M.token_budget(F.col("e"))).collect()] == [1024, 1024, 1024, 8192, 8192]


def test_hyphens(spark):
    df = spark.createDataFrame([("Ver-", "trag"), ("Kauf-", "und"), ("Kai-", "Vertrag"), ("a", "b")], "a string, b string")
    assert [r[0] for r in df.select(T.join_hyphen(F.col("a"), F.col("b"))).collect()] == ["Vertrag", "Kauf- und", "Kai- Vertrag", "a b"]


VOCAB = {"vertrag", "kaufen", "kauf", "haftung", "einigen", "erklären", "ordnung", "recht", "möglich", "liegen"}


def _vocab(spark, words=VOCAB):
    return spark.createDataFrame([(w,) for w in sorted(words)], "word string")


def test_inflection_and_compounds(spark):
    want = {"Vertrag": True, "liegt": True, "Kaufvertrag": True, "Rechtsordnung": True, "unmöglich": True, "Unvertrag": True, "Vertrogs": False, "Kaufvertrages": True, "qwertz": False, "ab": False, "Kaufrechtsordnung": True}
    words = spark.createDataFrame([(w,) for w in [*want, *want, None]], "word string")
    got = {r.word: r for r in vocabulary.known_forms(words, _vocab(spark)).collect()}
    assert {w: r.known for w, r in got.items()} == want
    assert got["liegt"].direct and not got["Kaufvertrag"].direct and not got["unmöglich"].direct
    assert vocabulary.known_forms(words.where("false"), _vocab(spark)).count() == 0


def test_compounds_equal_a_search(spark):
    import itertools
    import random

    rng = random.Random(3)
    vocab = {"".join(rng.choice("abn") for _ in range(rng.randrange(3, 6))) for _ in range(25)}
    words = sorted({"".join(rng.choice("abn") for _ in range(rng.randrange(1, 16))) for _ in range(250)} | {"".join(p) + x for p in itertools.product(sorted(vocab)[:5], repeat=3) for x in ("", "s", "en")} | {"un" + v for v in vocab})
    stems = lambda w: {w[: len(w) - len(e)] for e in vocabulary.ENDINGS if w.endswith(e) and len(w) - len(e) >= 3}

    def base(w):
        once = stems(w)
        return w in vocab or any(s + x in vocab for s in once | {t for o in once for t in stems(o)} for x in ("", "en", "n"))

    def whole(w):
        # every way to part a word into one to three heads and a rest
        for k in (1, 2, 3):
            for cuts in itertools.combinations(range(4, len(w) - 2), k):
                heads = [w[a:b] for a, b in zip((0, *cuts), cuts, strict=False)]
                if base(w[cuts[-1] :]) and all(any(h.endswith(j) and len(h) - len(j) >= 4 and base(h[: len(h) - len(j)]) for j in vocabulary.JOINTS) for h in heads):
                    return True
        return base(w)

    want = {w: whole(w) or (w.startswith("un") and len(w) >= 6 and whole(w[2:])) for w in words}
    got = {r.word: r.known for r in vocabulary.known_forms(spark.createDataFrame([(w,) for w in words], "word string"), _vocab(spark, vocab)).collect()}
    assert got == want and 20 < sum(want.values()) < len(want)


def test_text_is_checked_and_mended(spark):
    text = "Der Verfrag nach § Verfrag 12 liegt [[Verfrag]] `Verfrag` im Kaufverfrag. Verfr. und HGBVerfrag,\nein Verfrag1 unmöqlich"
    df = spark.createDataFrame([(1, text), (2, "| Verfrag |"), (3, None), (4, ""), (5, "Vertrag")], "id int, t string")
    assert "".join(x.before + x.word for x in df.where("id = 1").select(vocabulary.text_words(F.col("t"))).first()[0]) == text
    found, fixed = vocabulary.checked_text(df, "id", "t", _vocab(spark))
    assert {(r.word, r["count"], r.suggestion) for r in found.collect()} == {("Verfrag", 2, "Vertrag"), ("Kaufverfrag", 1, "Kaufvertrag"), ("unmöqlich", 1, "unmöglich"), ("nach", 1, None)}
    got = {r.id: r.t for r in fixed.collect()}
    assert got[1] == "Der Vertrag nach § Vertrag 12 liegt [[Verfrag]] `Verfrag` im Kaufvertrag. Verfr. und HGBVerfrag,\nein Verfrag1 unmöglich"
    assert got[2] == "| Verfrag |" and got[3] is None and got[4] == "" and got[5] == "Vertrag"


def test_unique_correction(spark):
    words = spark.createDataFrame([("Vcrtrag", 2), ("Rccht", 1), ("vertrag", 1)], "word string, count bigint")
    vocab = spark.createDataFrame([("vertrag",), ("recht",)], "word string")
    got = {r.word: r.suggestion for r in vocabulary.corrections(words, vocab).collect()}
    assert got == {"Vcrtrag": "Vertrag", "Rccht": "Recht"}
    assert {r.word: r.known for r in vocabulary.known_forms(words, vocab).collect()} == {"Vcrtrag": False, "Rccht": False, "vertrag": True}


def test_gate_of_null_and_empty_text(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "aB1 " * 60), (4, "gutes Wort " * 40)], "id int, t string")
    assert {r.id: r.passed for r in gate.garbage_gate(df, "id", "t").collect()} == {1: True, 2: True, 3: False, 4: True}


def test_citations_with_their_statute(spark):
    text = "Nach § 823 Abs. 1 BGB und §§ 946, 947 II BGB sowie Art. 14 GG, aber § 12 Eser und § 123 I Der; § 5a  Abs. 2  S. 1 StGB."
    df = spark.createDataFrame([(text,), (None,)], "t string")
    got = [r[0] for r in df.select(T.named_citations(F.col("t"))).collect()]
    assert got == [["§ 823 Abs. 1 BGB", "§§ 946, 947 II BGB", "Art. 14 GG", "§ 12", "§ 123 I", "§ 5a Abs. 2 S. 1 StGB"], []]
