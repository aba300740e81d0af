import random

import numpy as np

from blattwerk.llm import furniture as U
from blattwerk.llm import quality as Q

LETTERS = "cfnlgobsvp"  # of different glyph classes


def _word(number, ending):
    return "".join(LETTERS[int(d)] for d in f"{number:06d}") + ending


def _words(spark, rows):
    vocab = spark.createDataFrame([("der", 1)], "word string, freq_rank int")
    blocks = spark.createDataFrame(rows, "block_id bigint, name string, markdown string")
    return {r.block_id: r.words for r in Q.block_quality(blocks, vocab).collect()}


def test_stamped_lines_are_learned_from_long_texts(spark):
    rng = random.Random(1)
    body = lambda: "\n".join(" ".join(_word(rng.randrange(10**6), "x") for _ in range(8)) for _ in range(90))
    title = "Zwirbelkunde Quastenheim Ollrich Wumpe"
    rows = [(i, "a", f"{title} {i}\n{body()}") for i in range(5)]
    assert min(len(m) for _, _, m in rows) > 4_000
    got = _words(spark, [*rows, (9, "b", f"{title} Anlage"), (10, "c", "Knolle Pfaffe Zunge Jacke")])
    assert got[9] == 0 and got[10] == 4


def test_stamped_lines_are_learned_from_all_previews(spark):
    n, rows = 8_000, []
    for i in range(n):
        title = " ".join(_word(i, x) for x in "xzjk")
        rows += [(4 * i + k, f"a{i}", f"{title}\nder {_word(4 * i + k, 'jxj')} und die Anlage") for k in range(3)]
        rows.append((4 * i + 3, f"b{i}", f"{title} Anlage"))
    got = _words(spark, rows)
    assert len(got) == 4 * n
    assert {got[4 * i + 3] for i in range(n)} == {0} and got[0] == 5


def test_a_line_counts_once_however_the_texts_are_spread(spark):
    rng = random.Random(2)
    lines = [" ".join(_word(rng.randrange(30), "x") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    rows = [(i, f"p{i % 7}", "\n".join([lines[i % 7], *rng.choices(lines, k=4)])) for i in range(70)]
    blocks = spark.createDataFrame(rows, "block_id bigint, name string, markdown string")

    def fitted(df):
        read = U.read_lines(df)
        return U.fit_on_lines(U.distinct_lines(read, U.recurring_lines(read)))

    one = fitted(blocks.coalesce(1))
    assert (one.weights > 0).any() and (one.weights == U.UNSEEN).any()
    for df in (blocks.repartition(7), blocks.unionByName(blocks.where("block_id % 3 = 0")).repartition(5)):
        other = fitted(df)
        assert np.array_equal(one.weights, other.weights) and one.bias == other.bias
    nothing = fitted(blocks.where("false"))
    assert not nothing.weights.any() and nothing.bias == -1.0


def test_the_rule_is_fitted_on_all_rated_blocks(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0.2, 0.1, (12_000, len(Q.RATIOS)))
    prose = x[:, 0] + x[:, 1] + rng.normal(0, 0.1, len(x)) > 0.4
    counts = ("words", "numbers", "single_letters", "symbols")
    schema = ", ".join(["block_id bigint", *(f"{c} bigint" for c in counts), *(f"{c} double" for c in Q.RATIOS)])
    quality = spark.createDataFrame([(i, 9, 0, 0, 0, *map(float, r)) for i, r in enumerate(x)], schema)
    kinds = spark.createDataFrame([(i, "prose" if p else "list") for i, p in enumerate(prose)], "block_id bigint, kind string")
    weights, constant = Q.fit_rule(x, prose)
    got = {r.block_id: r.prose_score for r in Q.judged_blocks(quality, kinds).select("block_id", "prose_score").collect()}
    assert np.allclose([got[i] for i in range(len(x))], x @ weights + constant, atol=1e-6)
