from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from blattwerk.llm import packing as P
from blattwerk.plans import cut

SPEC = "container_kind string, capacity_tokens int, tokens int"


def _check(capacity, sizes, made):
    place, n = made
    held = np.bincount(place, weights=sizes, minlength=n)
    assert len(held) == n and (held <= capacity).all() and (n == 0 or held.min() > 0)
    return n


def _longest_first(x, capacity):
    return np.sort(np.clip(np.asarray(x, np.int64), 1, capacity))[::-1].copy()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_plan_places_every_item_once_within_the_capacity(items):
    sizes = _longest_first(items, 64)
    n = _check(64, sizes, P.plan(64, sizes))
    least = -(-int(sizes.sum()) // 64)
    assert least <= n <= 2 * least + 1


def _plain_best_fit_decreasing(capacity, sizes):
    rooms = []
    for s in sizes.tolist():
        fit = [r for r in rooms if r >= s]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=80), st.integers(50, 60))
def test_runs_of_containers_are_best_fit(items, capacity):
    sizes = _longest_first(items, capacity)
    assert _check(capacity, sizes, P.best_fit(capacity, sizes, np.zeros(0, np.int64))) == _plain_best_fit_decreasing(capacity, sizes)


@pytest.mark.parametrize("capacity", [256, 4096, 131_072])
@pytest.mark.parametrize("kind", ["lognormal", "uniform", "thirds"])
def test_never_more_containers_than_best_fit_decreasing(capacity, kind):
    rng = np.random.default_rng(3)
    x = {"lognormal": rng.lognormal(-2, 0.8, 4000), "uniform": rng.random(4000), "thirds": np.where(rng.random(4000) < 0.5, rng.uniform(0.26, 0.3, 4000), rng.uniform(0.36, 0.4, 4000))}[kind]
    sizes = _longest_first(x * capacity, capacity)
    n, bfd = _check(capacity, sizes, P.plan(capacity, sizes)), _plain_best_fit_decreasing(capacity, sizes)
    assert n <= bfd
    if kind == "thirds":  # no two of one sort fill a container: here the configurations are worth their price
        assert n < 0.95 * bfd
    _check(capacity, sizes, P.grouped_fit(capacity, sizes))


def test_configurations_fill_what_can_be_filled():
    made = P.configurations(100, np.array([60, 40, 25]), np.array([10, 10, 40]))
    assert sum(t for _, t in made) == 20
    assert (sum(take * t for take, t in made) == [10, 10, 40]).all()


def test_a_thousand_kinds_and_a_capacity_beyond_all_items(spark):
    items = [(i, 1 + 37 * i % 900) for i in range(40)]
    sizes = cut(spark.createDataFrame(items, "doc_id bigint, tokens bigint"))
    kinds = [(f"k{i}", 131_072, 0) for i in range(1000)]
    n = P.pack(sizes, spark.createDataFrame(kinds, SPEC)).groupBy("container_kind").count().where("count = 40").count()
    assert n == 1000
    huge = P.pack(sizes, spark.createDataFrame([("huge", 2_000_000_000, 0)], SPEC)).select("container_id").distinct().count()
    assert huge == 1


def test_shards_keep_every_item(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 300)
    items = [(i, 1 + 37 * i % 900) for i in range(2000)]
    sizes = cut(spark.createDataFrame(items, "doc_id bigint, tokens bigint"))
    spec = spark.createDataFrame([("k", 512, 0)], SPEC)
    packed = cut(P.pack(sizes, spec))
    f = P.faults(sizes, packed, spec).collect()
    assert [(r.documents, r.incomplete, r.split, r.overfull) for r in f] == [(2000, 0, 0, 0)]
    assert P.fill_rates(packed, spec).first().fill > 0.97


def test_pack_splits_only_what_is_too_large(spark):
    items = [(1, 700), (2, 256), (3, 100), (4, 100), (5, 56), (6, 0), (7, 30), (7, 30)]
    sizes = cut(spark.createDataFrame(items, "doc_id bigint, tokens bigint"))
    spec = spark.createDataFrame([("k", 256, 0), ("g", 1024, 0), ("none", 0, 0), (None, 5, 0)], SPEC)
    rows = P.pack(sizes, spec).collect()
    for kind, cap in (("k", 256), ("g", 1024)):
        own = [r for r in rows if r.container_kind == kind]
        load, docs = defaultdict(int), defaultdict(list)
        for r in own:
            load[r.container_id] += r.tokens
            docs[r.doc_id].append((r.start_token, r.tokens))
        assert max(load.values()) <= cap
        assert sum(load.values()) == sum(n for _, n in items)
        assert len(docs[7]) == 2
        assert all(len(v) == 1 for k, v in docs.items() if k not in (1, 7))
    assert sorted(r.tokens for r in rows if r.doc_id == 1 and r.container_kind == "k") == [188, 256, 256]
    assert {r.container_kind for r in rows} == {"k", "g"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, tokens bigint")
    spec = spark.createDataFrame([("k", 256, 0)], SPEC)
    assert P.pack(cut(none), spec).count() == 0
    assert P.pack(cut(spark.createDataFrame([(1, 5)], "doc_id bigint, tokens bigint")), spec.where("false")).count() == 0


def test_many_items_of_one_size(spark):
    sizes = cut(spark.range(5000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 100 ELSE 1 + id % 256 END AS tokens"))
    rows = P.pack(sizes, spark.createDataFrame([("k", 256, 0)], SPEC))
    over = rows.groupBy("container_id").sum("tokens").where("`sum(tokens)` > 256").count()
    assert over == 0 and rows.count() == 5000 and rows.select("doc_id").distinct().count() == 5000
