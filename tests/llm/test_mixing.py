import math

from blattwerk.llm import mixing as M
from blattwerk.llm import sizes as Z
from blattwerk.plans import cut

TARGET = "mix_name string, source string, target_share double, max_repeats int, tokens int"


def _sizes(spark):
    rows = [(i, "gross", 10 + i % 7, 1.0) for i in range(3000)] + [(10_000 + i, "klein", 20, 1.0) for i in range(20)] + [(20_000 + i, "fremd", 5, 1.0) for i in range(50)]
    return cut(spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint, weight double"))


def _target(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], TARGET)


def test_shares_within_what_repeats_allow(spark):
    t = _target(spark, [("m", " GROSS", 0.9, 4), ("m", "klein", 0.1, 3), ("m", "leer", 0.0, 3)])
    r = {x.source: x for x in M.shares(_sizes(spark), t, total_tokens=20_000).collect()}
    assert abs(r["gross"].tokens - 18_000) <= 16
    assert r["klein"].tokens == 3 * 400 and r["klein"].capped and r["klein"].most_copies == 3
    assert math.isclose(sum(x.reached_share for x in r.values()), 1.0)


def test_fitting_total_meets_all_shares(spark):
    t = _target(spark, [("m", "gross", 0.6, 1), ("m", "klein", 0.2, 3), ("m", "fremd", 0.1, 9), ("m", "leer", 0.1, 2)])
    fit, held = ({x.source: x for x in M.shares(_sizes(spark), t, total_tokens=n).collect()} for n in (M.FITTING, M.HELD))
    # klein holds 400 tokens, so three times that is a fifth of the total
    assert fit["klein"].tokens == 1200 and [s for s, x in fit.items() if x.capped] == ["leer"]
    for s, want in (("gross", 0.6), ("klein", 0.2), ("fremd", 0.1)):
        assert abs(fit[s].reached_share - want / 0.9) < 0.002
    assert held["klein"].capped and held["klein"].reached_share < 0.1


def test_faults_are_seen(spark):
    t = _target(spark, [("m", "klein", 1.0, 2)])
    sizes = _sizes(spark)
    made = cut(M.mix(sizes, t, total_tokens=600))
    assert [tuple(r) for r in M.faults(sizes, t, made).collect()] == [("m", "klein", 0, 0, False)]
    from pyspark.sql import functions as F

    worse = made.withColumn("copies", F.when(F.col("doc_id") == 10_003, 5).otherwise(F.col("copies"))).withColumn("doc_id", F.when(F.col("doc_id") == 10_004, 7).otherwise(F.col("doc_id")))
    assert [tuple(r) for r in M.faults(sizes, t, worse).collect()] == [("m", "klein", 1, 1, True)]


def test_complete_epochs_precede_the_draw(spark):
    t = _target(spark, [("m", "klein", 1.0, 5)])
    rows = M.mix(_sizes(spark), t, total_tokens=1000).collect()
    copies = [r.copies for r in rows]
    assert len(rows) == 20 and set(copies) == {2, 3} and sum(copies) == 50


def test_draw_is_the_prefix_of_the_exponential_keys(spark):
    from pyspark.sql import functions as F

    sizes = _sizes(spark)
    got = {r.doc_id for r in M.mix(sizes, _target(spark, [("m", "gross", 1.0, 1)]), total_tokens=5000).collect()}
    u = (F.pmod(F.xxhash64("doc_id", F.lit(M.SEED)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = sorted(sizes.where("source = 'gross'").select("doc_id", "tokens", (-F.ln(u) / F.col("weight")).alias("k")).collect(), key=lambda r: (r.k, r.doc_id))
    want, total = set(), 0
    for r in rows:
        total += r.tokens
        if total - r.tokens / 2 <= 5000:
            want.add(r.doc_id)
    assert got == want


def test_heavier_documents_are_drawn_more_often(spark):
    rows = [(i, "s", 10, 1.0 if i % 2 else 0.1) for i in range(4000)]
    sizes = cut(spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint, weight double"))
    got = [r.doc_id % 2 for r in M.mix(sizes, _target(spark, [("m", "s", 1.0, 1)]), total_tokens=10_000).collect()]
    assert sum(got) / len(got) > 0.8


def test_missing_sources_and_empty_tables(spark):
    t = _target(spark, [("m", "nirgends", 0.5, 2), ("m", None, 0.5, None), (None, "gross", 1.0, 1)])
    assert M.mix(_sizes(spark), t, 100).count() == 0
    assert [(r.tokens, r.reached_share) for r in M.shares(_sizes(spark), t, 100).collect()] == [(0, 0.0)] * 2
    assert M.mix(_sizes(spark), t.where("false")).count() == 0
    assert M.mix(cut(_sizes(spark).where("false")), _target(spark, [("m", "gross", 1.0, 1)])).count() == 0


def test_sizes_of_odd_texts(spark):
    df = spark.createDataFrame([(1, None, " A "), (2, "", None), (None, "x", "a"), (3, "ein Wort mehr", "A"), (3, "ein Wort mehr", "A"), (4, "lang " * 100_000, "a")], "doc_id bigint, text string, source string")
    rows = sorted((r.doc_id, r.source, r.tokens) for r in Z.token_sizes(df, vocab=spark.createDataFrame([('und', 1), (None, 2)], 'word string, freq_rank int')).collect())
    assert rows[0] == (1, "a", 0) and rows[1] == (2, "", 0) and rows[2] == rows[3] and rows[4][2] > 100_000


def test_parts_keep_the_number_of_tokens():
    import base64

    import tiktoken

    with open(Z.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
    e = tiktoken.Encoding("own", pat_str=Z.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = ("Die Klage ist zulässig;  sie hat\n\nErfolg, weil § 3 HafO gilt. " * 40).strip()
    assert "".join(Z.parts(text, 50)) == text
    assert sum(len(e.encode_ordinary(p)) for p in Z.parts(text, 50)) == len(e.encode_ordinary(text))
