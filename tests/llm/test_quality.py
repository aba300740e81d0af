import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blattwerk.llm import quality as Q
from blattwerk.llm.textkernel import prepare, word_hash

PROSE = "Der Kläger hat den Vertrag nach der Übergabe geprüft. Weil die Frist nicht gewahrt war, ist die Klage ohne Erfolg geblieben, und das Gericht hat sie mit Recht zurückgewiesen."
LIST = "\n".join(["- Kaufvertrag", "- Mietsache", "- Lagerhaftung – fällig", "- Werkmangel, § 12 Abs. 3 HafO", "- Pfandrecht", "- Deichfrist"])
VOCAB = [(w, i + 1) for i, w in enumerate("der die das den und hat nach weil nicht war ist ohne mit sie".split())] + [("selten", 3000), ("leer", None)]


def _vocab(spark):
    return spark.createDataFrame(VOCAB, "word string, freq_rank int")


def _counts(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id bigint, text string, words int, chunk int")
    return {r.id: r for r in Q.text_quality(df, "id", "text", _vocab(spark), **kw).collect()}


def test_prose_and_list_differ(spark):
    r = _counts(spark, [(1, PROSE, 0, 0), (2, LIST, 0, 0)])
    assert r[1].common_share > 0.3 > 0.05 > r[2].common_share
    assert r[1].words == len(PROSE.split()) and r[1].lines == 1 and r[1].lines_punct == 1 and r[1].sentence_ends == 2
    w, c = Q.fit_rule([], [])
    score = lambda x: sum(a * b for a, b in zip(w, [getattr(x, n) for n in Q.RATIOS], strict=True)) + c
    assert score(r[1]) > 0 > score(r[2])


COMMON = (np.zeros(0, np.int64), np.array([word_hash("der"), word_hash("nach")], np.int64))


def _text(rng, words, lines):
    """Lines of words with hyphens at their ends, repeated passages, blank lines and lines beyond any bound."""
    out = []
    for i in range(lines):
        kind = rng.random()
        if kind < 0.2 and out:
            out.append(rng.choice(out))
        elif kind < 0.25:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randrange(300, 900))) + rng.choice(["", "."]))
        else:
            out.append(" ".join(rng.choice(words) for _ in range(rng.randrange(0, 20))) + rng.choice(["", ".", "-", " Nr. 7", "! "]))
    return "\n".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_counts_are_the_same_for_every_size_of_a_chunk(seed):
    rng = random.Random(seed)
    text = _text(rng, [*PROSE.split(), "x", "§", "[^1]:", "café", "Übergabe"], 80)
    whole = Q.partial_counts([text], None, *COMMON)[0]
    assert whole[0] > 500
    for size in (60, 61, 300, 1_000, 2_500, 10_000, 64_000, 10**6):
        assert (Q.chunk_counts(text, None, *COMMON, size).sum(axis=0) == whole).all(), size


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab c\n.-\x01ä1", max_size=200), st.integers(1, 40))
def test_chunks_add_up(text, size):
    assert (Q.chunk_counts(text, None, *COMMON, size).sum(axis=0) == Q.partial_counts([text], None, *COMMON)[0]).all()
    prepared = prepare([text], True, None, 30)
    assert "".join(Q.chunks(prepared, size)) == prepared


def test_huge_text_in_one_row(spark):
    text = (PROSE + " ") * 4_000 + "\n" + "\n".join(f"Nach der Prüfung Nr. {i} wurde der {i}. Antrag gestellt" for i in range(2_000))
    whole, parts = (_counts(spark, [(1, text, 0, 0)], chunk=c)[1] for c in (10**7, 64_000))
    assert whole.asDict() == parts.asDict() and whole.lines < 20


def test_letters_of_all_scripts():
    c = dict(zip(Q.COUNTS, Q.partial_counts(["café naïve garçon", "Привет мир", "日本語 の文", "e\u0301te\u0301 là"], None, *COMMON).T, strict=True))
    assert c["words"].tolist() == [3, 2, 2, 2]
    assert c["symbols"].tolist() == [0, 0, 0, 0]
    assert c["letters"].tolist() == [15, 9, 5, 5]


def test_plain_statistics(spark):
    rows = [(1, "Der Kläger hat – mit Recht – verloren.\n\n- Liste\nEnde:", 0, 0), (2, None, 0, 0), (3, "", 0, 0), (None, "x", 0, 0), (3, "", 0, 0)]
    df = spark.createDataFrame(rows, "id bigint, text string, words int, lines int")
    r = {x.id: x for x in Q.plain_statistics(df, "id", "text", _vocab(spark)).collect()}
    assert set(r) == {1, 2, 3}
    assert (r[1].words, r[1].letters, r[1].common, r[1].symbols, r[1].lines, r[1].lines_punct) == (8, 37, 3, 2, 3, 2)
    assert r[2].word_length == r[3].punct_share == 0.0


def test_weights_tell_prose_from_noise():
    w = Q.prose_weights([PROSE, LIST, "\n".join([PROSE] * 20), "", "123 456 ||| 78"], *COMMON[:1], np.array([word_hash(x) for x, _ in VOCAB[:15]], np.int64))
    assert w[0] > 0.8 and w[1] < 0.4 and w[2] < 0.2 and w[3] == 0 and w[4] < 0.1


def test_repetition_is_judged_once(spark):
    p = "Nach der Prüfung hat das Gericht den Antrag mit guten Gründen abgelehnt."
    r = _counts(spark, [(1, p, 0, 0), (2, "\n".join([p] * 30), 0, 0)])
    assert r[2].words <= r[1].words + Q.COMMON_RANKS and r[2].lines <= 2


def test_odd_rows(spark):
    r = _counts(spark, [(1, None, 0, 0), (2, "", 0, 0), (None, "x", 0, 0), (3, "wort", 0, 0), (3, "wort", 0, 0), (4, "z" * 200_000, 0, 0), (5, " \n\t\n", 0, 0)])
    assert set(r) == {1, 2, 3, 4, 5}
    assert r[1].words == r[2].words == r[5].words == 0 and r[1].word_length == 0.0
    assert r[3].words == 1 and r[4].words == 1
    empty = spark.createDataFrame([], "id bigint, text string")
    assert Q.text_quality(empty, "id", "text", _vocab(spark)).count() == 0


def test_rule_learns_from_labels():
    rng = np.random.default_rng(0)
    good = np.column_stack([rng.normal(0.2, 0.03, 300), rng.normal(0.2, 0.03, 300), *[np.zeros(300)] * 6])
    bad = np.column_stack([rng.normal(0.03, 0.03, 300), rng.normal(0.1, 0.05, 300), *[np.zeros(300)] * 6])
    w, c = Q.fit_rule(np.vstack([good, bad]), [True] * 300 + [False] * 300)
    assert ((np.vstack([good, bad]) @ w + c > 0) == np.array([True] * 300 + [False] * 300)).mean() > 0.97


def test_held_out_accuracy(spark, data):
    d = data.replace("sf0.001", "sf0.1")
    t = {n: spark.read.parquet(f"{d}/{n}.parquet") for n in ("page_block", "vocab", "page_kind")}
    kinds = t["page_kind"]
    train, held = kinds.where("block_id % 2 = 0"), kinds.where("block_id % 2 = 1")
    q = Q.block_quality(t["page_block"].join(kinds.select("block_id").distinct(), "block_id", "left_semi"), t["vocab"])
    judged = Q.judged_blocks(q, train).join(Q.rated(held), "block_id").where("words > 0")
    n, wrong = judged.count(), judged.where("prose = not_prose").count()
    assert n > 400 and wrong / n < 0.06
