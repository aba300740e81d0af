"""Items of varying length in containers of fixed capacity.

Items longer than the capacity are split into full pieces and a rest. The pieces of
each kind of container are dealt at random to shards of about ``SHARD`` pieces, and
each shard is planned in one task:

* long pieces are ranked by length and grouped linearly (equal cardinality), each
  counting as the longest of its group;
* the configurations of these few sizes are optimised: the linear program over all
  configurations, solved by column generation, whole multiples of it taken;
* actual pieces replace the rounded ones, rank by rank, and what is left, the short
  pieces above all, goes, longest first, to the container with the least room that
  takes it (best fit).

A shard for which best-fit decreasing alone needs fewer containers is packed that
way, so the plan is never worse. No plan leaves its task: nothing but the row counts
of the kinds reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blattwerk.llm.sizes import TOKENIZER, token_sizes
from blattwerk.plans import cut

#: Groups of long pieces, and the share of the capacity above which a piece is long.
GROUPS, LONG = 64, 0.125
#: Pieces that a shard holds on average. All containers of a shard but a few are full, whatever the others hold.
SHARD = 500_000
SEED = 20_240_301
#: Units in which configurations are measured; lengths are rounded up to them.
UNITS = 4_096
#: Exchanges of a configuration after which the program is good enough; what it leaves is packed by best fit.
EXCHANGES = 600
PACKED = "container_kind string, container_id bigint, doc_id bigint, piece_no int, start_token bigint, tokens bigint"


class _Rooms:
    """Containers by the room they have left, as runs ``(first, number)``; finds the least room that is at least a size.

    Rooms are kept in a tree of bit sets of 1,024 places, so neither memory nor time depends on the capacity.
    """

    def __init__(self, capacity: int):
        self.runs: dict[int, list[tuple[int, int]]] = {}
        self.levels: list[dict[int, int]] = [{}]
        while capacity >> (10 * len(self.levels)):
            self.levels.append({})

    def add(self, room: int, first: int, number: int) -> None:
        runs = self.runs.setdefault(room, [])
        runs.append((first, number))
        if len(runs) == 1:
            for level in self.levels:
                bits = level.get(room >> 10, 0)
                level[room >> 10] = bits | 1 << (room & 1023)
                if bits:
                    break
                room >>= 10

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            for level in self.levels:
                level[room >> 10] ^= 1 << (room & 1023)
                if level[room >> 10]:
                    break
                room >>= 10
        return run

    def least(self, size: int) -> int:
        """The least room of ``size`` or more, -1 if there is none."""
        for depth, level in enumerate(self.levels):
            bits = level.get(size >> 10, 0) >> (size & 1023)
            if bits:
                at = size + (bits & -bits).bit_length() - 1
                for lower in reversed(self.levels[:depth]):
                    bits = lower[at]
                    at = (at << 10) + (bits & -bits).bit_length() - 1
                return at
            size = (size >> 10) + 1
        return -1


def best_fit(capacity: int, sizes: np.ndarray, rooms: np.ndarray) -> tuple[np.ndarray, int]:
    """Container of each of ``sizes`` (longest first) by best fit, and the number of containers; ``rooms``
    (least first) is what is left in those that are there already."""
    state = _Rooms(capacity)
    values, firsts, numbers = np.unique(rooms, return_index=True, return_counts=True)
    for r, a, n in zip(values.tolist(), firsts.tolist(), numbers.tolist(), strict=True):
        state.add(r, a, n)
    containers = len(rooms)
    place = np.zeros(len(sizes), np.int64)
    distinct, first, number = np.unique(-sizes, return_index=True, return_counts=True)
    for s, at, need in zip((-distinct).tolist(), first.tolist(), number.tolist(), strict=True):
        while need:
            room = state.least(s)
            if room < 0:
                n = -(-need // (capacity // s))
                state.add(capacity, containers, n)
                containers += n
                continue
            a, n = state.take(room)
            if need < n:
                state.add(room, a + need, n - need)
                n = need
            # what still fits these containers fits none better
            times = min(need // n, room // s)
            place[at : at + n * times] = np.tile(np.arange(a, a + n), times)
            state.add(room - times * s, a, n)
            at, need = at + n * times, need - n * times
    return place, containers


def _best_configuration(room: int, sizes: np.ndarray, worth: np.ndarray) -> np.ndarray:
    """How many of each size are worth most within ``room``."""
    value, chosen = np.zeros(room + 1), np.full(room + 1, -1)
    for g, (s, w) in enumerate(zip(sizes.tolist(), worth.tolist(), strict=True)):
        if w <= 0:
            continue
        for _ in range(room // s):
            more = value[:-s] + w
            better = np.flatnonzero(more > value[s:] + 1e-12)
            if not len(better):
                break
            value[better + s], chosen[better + s] = more[better], g
    take, at = np.zeros(len(sizes), np.int64), int(np.argmax(value))
    while at > 0 and chosen[at] >= 0:
        take[chosen[at]] += 1
        at -= int(sizes[chosen[at]])
    return take


def configurations(capacity: int, sizes: np.ndarray, demand: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """Configurations (pieces of each size) and how often each is used, at most as often as ``demand`` lets it.

    The relaxed program has a column for every configuration; the ones that lower its value are found by a
    knapsack over the dual prices.
    """
    unit = -(-capacity // UNITS)
    room = capacity // unit
    width = np.minimum(-(-sizes // unit), room)
    basis = np.diag((room // width).astype(float))
    demand_f, ones = demand.astype(float), np.ones(len(sizes))
    used = np.linalg.solve(basis, demand_f)
    for _ in range(EXCHANGES):
        prices = np.linalg.solve(basis.T, ones)
        column = _best_configuration(room, width, prices)
        if column @ prices <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(step > 1e-9, used / np.maximum(step, 1e-9), np.inf)
        basis[:, int(np.argmin(ratio))] = column
        used = np.maximum(np.linalg.solve(basis, demand_f), 0)
    left, out = demand.copy(), []
    for j in np.argsort(-used):
        take = basis[:, j].astype(np.int64)
        some = take > 0
        times = int(min(np.floor(used[j] + 1e-6), (left[some] // take[some]).min()))
        if times > 0:
            left -= times * take
            out.append((take, times))
    return out


def grouped_fit(capacity: int, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """Container of each of ``sizes`` (longest first) by linear grouping, and the number of containers."""
    n_long = int(np.searchsorted(-sizes, -LONG * capacity))
    place = np.full(len(sizes), -1, np.int64)
    rooms = np.zeros(0, np.int64)
    if n_long:
        starts = np.flatnonzero(np.append(True, sizes[1:n_long] != sizes[: n_long - 1]))
        if len(starts) > GROUPS:
            starts = np.unique(np.arange(GROUPS) * n_long // GROUPS)
            starts = starts[np.append(True, sizes[starts[1:]] != sizes[starts[:-1]])]
        ends = np.append(starts[1:], n_long)
        at, containers, held = starts.copy(), 0, []
        for take, times in configurations(capacity, sizes[starts], ends - starts):
            full = np.zeros(times, np.int64)
            for k, g in enumerate(np.repeat(np.arange(len(starts)), take)):
                rows = np.arange(at[g], at[g] + times)[:: -1 if k % 2 else 1]  # the longer of one group beside the shorter of another
                place[rows] = containers + np.arange(times)
                full += sizes[rows]
                at[g] += times
            held.append(full)
            containers += times
        if containers:
            rooms = capacity - np.concatenate(held)
            order = np.argsort(rooms, kind="stable")
            number = np.empty_like(order)
            number[order] = np.arange(containers)
            rooms, placed = rooms[order], place >= 0
            place[placed] = number[place[placed]]
    rest = np.flatnonzero(place < 0)
    place[rest], containers = best_fit(capacity, sizes[rest], rooms)
    return place, containers


def plan(capacity: int, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """Container (from 0) of each of ``sizes``, which are from 1 to ``capacity``, longest first, and the number of containers."""
    plain, grouped = best_fit(capacity, sizes, np.zeros(0, np.int64)), grouped_fit(capacity, sizes)
    return grouped if grouped[1] <= plain[1] else plain


def _packer(kinds: list[tuple[str, int, int]]) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        kind, capacity, shards = kinds[key[0].as_py()]
        rows = rows.sort_by([("tokens", "descending"), ("doc_id", "ascending"), ("piece_no", "ascending")])
        sizes = rows["tokens"].to_numpy()
        some = int(np.searchsorted(-sizes, 0))
        place = np.zeros(len(sizes), np.int64)
        place[:some] = plan(capacity, sizes[:some])[0]
        number = pa.array(place * shards + key[1].as_py() + 1)
        kept = [rows[c] for c in ("doc_id", "piece_no", "start_token", "tokens")]
        return pa.table([pa.array([kind] * len(sizes), pa.string()), number, *kept], ["container_kind", "container_id", "doc_id", "piece_no", "start_token", "tokens"])

    return run


def pack(sizes: DataFrame, spec: DataFrame) -> DataFrame:
    """``container_kind, container_id, doc_id, piece_no, start_token, tokens`` of every piece.

    ``sizes`` has ``doc_id, tokens`` (cut beforehand: it is read twice, and pieces are dealt by their place in
    it), ``spec`` has ``container_kind, capacity_tokens`` and is a parameter: its rows go to the driver. Kinds
    without a positive capacity are left out, of a kind given twice the greater capacity holds. Items without
    tokens go to the first container of their shard. Repeated rows are items of their own. Without items or
    kinds the result is empty. Ids are positive and distinct within a kind, without gaps if it has one shard.
    """
    spark = sizes.sparkSession
    wanted = spec.where("capacity_tokens > 0 AND container_kind IS NOT NULL").groupBy(F.col("container_kind").alias("k")).agg(F.max("capacity_tokens").cast("bigint").alias("c"))
    given = [(r["k"], r["c"]) for r in wanted.orderBy("k").collect()]
    if not given:
        return spark.createDataFrame([], PACKED)

    def per_kind(*values: list[int]) -> DataFrame:
        names = ("kind_no", "capacity", "shards")
        kind = [F.struct(*[F.lit(x).cast("bigint").alias(n) for n, x in zip(names, v, strict=False)]) for v in zip(range(len(given)), [c for _, c in given], *values, strict=True)]
        return sizes.select("doc_id", "tokens", F.explode(F.array(*kind)).alias("kind")).select("doc_id", "tokens", "kind.*")

    n, c = F.col("tokens"), F.col("capacity")
    counted = per_kind().groupBy("kind_no").agg(F.sum(F.greatest(F.ceil(n / c), F.lit(1))).alias("pieces")).collect()
    shards = [1] * len(given)
    for r in counted:
        shards[r["kind_no"]] = -(-r["pieces"] // SHARD)
    i = F.col("piece_no")
    pieces = (
        per_kind(shards)
        .withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(n / c) - 1, F.lit(0)).cast("int"))))
        .select("kind_no", F.floor(F.rand(SEED) * F.col("shards")).alias("shard"), "doc_id", "piece_no", (i * c).alias("start_token"), F.least(c, n - i * c).alias("tokens"))
    )
    kinds = [(k, cap, s) for (k, cap), s in zip(given, shards, strict=True)]
    return pieces.groupBy("kind_no", "shard").applyInArrow(_packer(kinds), PACKED)


def pack_documents(documents: DataFrame, spec: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    return pack(cut(token_sizes(documents, tokenizer).select("doc_id", "tokens")), spec)


def fill_rates(packed: DataFrame, spec: DataFrame) -> DataFrame:
    """``container_kind, capacity_tokens, containers, tokens, least_containers, fill`` of each kind."""
    used = packed.groupBy("container_kind").agg(F.countDistinct("container_id").alias("containers"), F.sum("tokens").alias("tokens"))
    cap = spec.groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    return used.join(cap, "container_kind").select(
        "container_kind",
        "capacity_tokens",
        "containers",
        "tokens",
        F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least_containers"),
        (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"),
    )


def faults(sizes: DataFrame, packed: DataFrame, spec: DataFrame) -> DataFrame:
    """``container_kind, documents, incomplete, split, overfull`` of each kind: documents in containers, those whose
    pieces are not the whole text one after the other, those split though they fit, and containers that hold too much."""
    cap = spec.where("capacity_tokens > 0 AND container_kind IS NOT NULL").groupBy("container_kind").agg(F.max("capacity_tokens").cast("bigint").alias("capacity"))
    per_container = packed.groupBy("container_kind", "container_id").agg(F.sum("tokens").alias("held")).join(cap, "container_kind")
    over = per_container.groupBy("container_kind").agg(F.count_if(F.col("held") > F.col("capacity")).alias("overfull"))
    last = F.col("start_token") + F.col("tokens")
    per_doc = packed.groupBy("container_kind", "doc_id").agg(F.sum("tokens").alias("held"), F.max(last).alias("last"), F.count(F.lit(1)).alias("pieces"))
    whole = sizes.groupBy("doc_id").agg(F.sum("tokens").alias("tokens"), F.max("tokens").alias("longest"), F.count(F.lit(1)).alias("times"))
    d = per_doc.join(whole, "doc_id").join(cap, "container_kind")
    broken = (F.col("held") != F.col("tokens")) | (F.col("last") != F.col("longest"))
    split = (F.col("pieces") > F.col("times")) & (F.col("longest") <= F.col("capacity"))
    per_kind = d.groupBy("container_kind").agg(F.count(F.lit(1)).alias("documents"), F.count_if(broken).alias("incomplete"), F.count_if(split).alias("split"))
    return per_kind.join(over, "container_kind")


def document_faults(documents: DataFrame, spec: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    sizes = cut(token_sizes(documents, tokenizer).select("doc_id", "tokens"))
    return faults(sizes, cut(pack(sizes, spec)), spec)
