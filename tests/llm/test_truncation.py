import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blattwerk.llm import truncation as T

SCHEMA = "doc_id bigint, text string, source string, declared_bytes bigint, word string, how string"
SENTENCE = "Die Regeln über den Hafen gelten auch für das Lager, soweit nichts anderes bestimmt ist."


@pytest.mark.parametrize(
    ("text", "how"),
    [
        (SENTENCE, T.WHOLE), ("", T.WHOLE), ("   ", T.WHOLE), (SENTENCE[:40], T.CUT), (SENTENCE[:57], T.CUT), (SENTENCE[:60] + "…", T.CUT), (SENTENCE[:60] + " [...]", T.CUT),
        (SENTENCE[:60] + " (mehr", T.CUT), (SENTENCE + "\n\nVgl. § 12 Abs. 3 HafO", T.WHOLE), (SENTENCE + "\n\nVgl. § 12 Abs.", T.CUT), (SENTENCE + " „Die Lösung hängt davon ab, wie ...“", T.WHOLE),
        (SENTENCE + " „Die Lösung hängt davon", T.CUT), (SENTENCE + "\n\n**III. Hafenrecht des", T.CUT), ("| a | b |\n| --- | --- |\n| eins | zwei |", T.WHOLE), ("| a | b |\n| eins | zw", T.CUT),
        (SENTENCE + "\n\ngez. Redaktion Hafen", T.WHOLE), ("- Hafen\n- Lager des", T.CUT), ("Kauf\t§ 3 HafO\tja\nMiete\t§ 852 UfG\t–", T.WHOLE), ("Kauf      § 3 HafO    nein\nMiete     § 4 HafO    nein", T.OPEN), ("Kauf\tja\nMiete\t§ 852 Abs", T.CUT), ("- Hafen\n- Lager\n- Wasserrecht", T.OPEN), (SENTENCE + " Das Wort f�", T.CUT), ("Wer es prüft, der.", T.CUT),
    ],
)
def test_endings(text, how):
    assert T.ending(text)[0] == how


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_lengths_are_those_of_the_encodings(text):
    n = dict(zip(T.ENCODINGS, T.lengths(text), strict=True))
    assert n["utf8"] == len(text.encode("utf-8", "replace"))
    assert n["utf8_crlf"] == len(text.replace("\n", "\r\n").encode("utf-8", "replace"))
    assert T.ending(text)[0] in (T.WHOLE, T.CUT, T.OPEN)


def test_escaped_lengths():
    text = 'a "b" <c> & ä§\n'
    n = dict(zip(T.ENCODINGS, T.lengths(text), strict=True))
    assert n["json_ascii"] == len(json.dumps(text)) - 2
    assert n["json"] == len(json.dumps(text, ensure_ascii=False)) - 2
    assert n["html"] == len(text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;"))
    assert n["numeric_entities"] == len(text.encode("ascii", "xmlcharrefreplace"))


def _corpus():
    body = " ".join(f"Im Fall {chr(97 + i % 26)}{chr(97 + i // 26)} hat die Klage Erfolg, weil der Anspruch auf Lagerung besteht." for i in range(60))
    rows = []
    for i in range(40):  # a field of 300 bytes
        t = body[i * 7 :][: 250 + 13 * (i % 9)]
        b = t.encode()[:300]
        rows.append((i, b.decode("utf-8", "ignore"), "Enge ", None))
    for i in range(40):
        rows.append((100 + i, f"- Hafensache {i}\n- Lagerung\n- Anspruch", "listen", None))
    return rows


def _df(spark, rows):
    return spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)


def test_limits_are_found_and_lists_left_alone(spark):
    df = _df(spark, _corpus())
    j = {r.doc_id: r for r in T.judged(df).collect()}
    assert all(j[i].truncated for i in range(40))
    assert any(j[i].at_limit for i in range(40))
    assert not any(j[100 + i].truncated for i in range(40))
    rates = {r.source: r for r in T.truncation_rates(df).collect()}
    assert rates["enge"].share == 1.0 and rates["listen"].truncated == 0


def test_odd_rows(spark):
    rows = [*_corpus(), (900, None, None, None), (901, "", "x", 5), (None, "abc", "x", 1), (0, *_corpus()[0][1:]), (902, "wort " * 100_000, None, None)]
    got = {r.doc_id for r in T.truncated_documents(_df(spark, rows)).collect()}
    assert 0 in got and 902 in got and not got & {900, 901}
    assert T.truncated_documents(_df(spark, [])).count() == 0


def test_fragment_of_a_longer_word(spark):
    rows = [(i, "Die Hafenbehörde entscheidet über den Lagerantrag.", "a", None) for i in range(5)] + [(10, "- Kauf\n- Miete\n- Hafenbeh", "a", None), (11, "- Kauf\n- Miete\n- Lagerantrag", "a", None)]
    assert [r.doc_id for r in T.truncated_documents(_df(spark, rows)).collect()] == [10]


def test_lengths_decide_what_endings_leave_open(spark):
    # lists in a field of 200 characters: some are cut within a word that is also a word by itself, and look whole
    items = ["Hafen", "Lager", "Hafenrecht", "Lagerhaus", "Wasserrecht", "Wasser"]
    rows = [(i, "\n".join(f"- {items[(i + 2 * j) % 6]}" for j in range(40))[: 120 + 3 * i], "frei", None) for i in range(60)]
    full = ["\n".join(f"- {items[(i + j * (1 + i % 3)) % 6]}{'x' * (i % 4)}" for j in range(40)) for i in range(40)]
    rows += [(100 + i, t[:200], "eng", None) for i, t in enumerate(full)]
    j = {r.doc_id: r for r in T.judged(_df(spark, rows)).collect()}
    opened = [j[i] for i in range(100, 140) if j[i].how == T.OPEN and j[i].begins and not j[i].fragment]
    assert opened and all(r.at_limit and r.truncated for r in opened)
    # the same ending in a source without a limit stays open
    assert not any(r.truncated for i, r in j.items() if i < 60 and r.how == T.OPEN and not r.fragment)


def test_announced_sizes_decide_what_endings_leave_open(spark):
    text = lambda i: "\n".join(f"- {w}" for w in ("Hafen", "Lager", "Wasserrecht")[: 1 + i % 3])
    rows = [(i, text(i), "meldet", len(text(i).encode()) + (400 if i < 3 else 0)) for i in range(30)]
    assert {r.doc_id for r in T.truncated_documents(_df(spark, rows)).collect()} == {0, 1, 2}
    r = T.truncation_rates(_df(spark, rows)).first()
    assert (r.truncated, r.short, r.by_length, r.ending_only) == (3, 3, 3, 0)


def test_a_pile_counts_in_its_best_encoding_only(spark):
    rows = [(i, ("Der Käufer trägt die Gefahr, soweit " * 9)[: 200 + i % 9], "eng", None) for i in range(40)]
    rows += [(100 + i, "Ä" * (i % 7) + "x" * (300 - 2 * (i % 7)), "bytes", None) for i in range(40)]
    df = _df(spark, rows).select("doc_id", F.col("source"), F.lit(T.CUT).alias("how"), "text")
    sized = df.select("doc_id", "source", "how", *[F.udf(lambda t, i=i: T.lengths(t)[i], "bigint")("text").alias(e) for i, e in enumerate(T.ENCODINGS)])
    found = {(r.source, r.encoding, r.length) for r in T.storage_limits(sized).collect() if r.source == "bytes"}
    assert found == {("bytes", "utf8", 300)}


def test_fragments_by_ratio_and_words_by_use(spark):
    # a fragment that other texts hold as well stays one, as long as longer words are far more frequent
    many = [(i, "Die Hafenbehörde prüft den Antrag. " * 50, "a", None) for i in range(60)]
    rows = [*many, (100, "Die Hafenbeh und der Rest.", "a", None), (101, "- Kauf\n- Miete\n- Hafenbeh", "a", None)]
    assert [r.doc_id for r in T.truncated_documents(_df(spark, rows)).collect()] == [101]
    words = T.word_counts(_df(spark, many).select("text"))
    uses = T.word_uses(words)
    assert {"die", "den", "prüft", "hafenbehörde"} <= uses.leading and "antrag" not in uses.leading and "the" in uses.leading
    assert {(r.word, r.n) for r in words.collect() if r.word == "Hafenbehörde"} == {("Hafenbehörde", 3000)}


def test_begun_words_equal_a_search(spark):
    import itertools
    import random

    rng = random.Random(5)
    texts = [" ".join("".join(rng.choice("abü") for _ in range(rng.randrange(1, 7))) for _ in range(300)) for _ in range(5)]
    words = T.word_counts(spark.createDataFrame([(t,) for t in texts], "text string"))
    n = {r.word: r.n for r in words.collect()}
    asked = ["".join(p) for k in range(1, 5) for p in itertools.product("abü", repeat=k)]
    got = {r.word: r.fragment for r in T.word_beginnings(spark.createDataFrame([(w,) for w in asked], "word string"), words).collect()}
    want = {}
    for w in asked:
        longer = sum(c for x, c in n.items() if len(x) > 3 and x.startswith(w) and x[len(w) :] not in ("", *T.INFLECTION))
        if longer:
            want[w] = n.get(w, 0) <= T.ALONE * longer
    assert got == want
