"""Best-fit packing of token pieces into sequences of a fixed capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plaza.llm.common import gathered, pieces, small_batches
from plaza.llm.tokens import encoder, tokenizer_file
from plaza.session import stage

BATCH_BYTES = 4 << 20

# A configuration: how often it is used, and (length, how many, place of the first) for its pieces.
Configuration = tuple[int, list[tuple[int, int, int]]]


class Solution:
    """(uses, configuration) pairs. Only the lengths that a configuration holds are kept, as it has few of them.

    A configuration is read as the number of its pieces of every length, made when it is looked at.
    """

    def __init__(self, capacity: int):
        self.capacity, self.kept = capacity, []

    def add(self, times: int, config: dict[int, int]) -> None:
        self.kept.append((times, tuple(config.items())))

    def __len__(self) -> int:
        return len(self.kept)

    def __iter__(self) -> Iterator[tuple[int, np.ndarray]]:
        for times, held in self.kept:
            config = np.zeros(self.capacity + 1, np.int64)
            for length, many in held:
                config[length] = many
            yield times, config


def cut_documents(
    docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Token pieces of at most ``capacity``: (doc_id, piece, start, length, ids_crc32[, ids], slice, nth).

    Every document ends with ``end_id``; only a longer one is cut, and its first piece is the short
    one. ``slice`` and ``nth`` number the pieces of a length within the task that made them. A NULL
    text is an empty one. The result is not stable across runs of a task: write it before use.
    """
    small_batches(docs.sparkSession)
    spec = tokenizer_file(tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(spec), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in pieces(gathered(batches, "text", BATCH_BYTES // 2), "text", BATCH_BYTES):
            rows: list[tuple] = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode.ids(batch.column("text")), strict=True):
                ids = np.append(ids.astype("<u4"), np.uint32(end_id))
                first = len(ids) % capacity or min(capacity, len(ids))
                starts = [0, *range(first, len(ids), capacity)]
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
                    own = ids[a:b].tobytes()
                    rows.append((doc, k, a, b - a, zlib.crc32(own), *([own] if with_ids else []), part, int(seen[b - a])))
                    seen[b - a] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    id_type = docs.select(id_col).schema[0].dataType
    fields = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    fields += [("ids", pa.binary())] * with_ids + [("slice", pa.int32()), ("nth", pa.int64())]
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("doc_id", to_arrow_type(id_type)), *fields])
    ddl = "piece int, start long, length long, ids_crc32 long, " + "ids binary, " * with_ids + "slice int, nth long"
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return given.mapInArrow(cut, f"doc_id {id_type.simpleString()}, {ddl}")


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack for every room up to the capacity: the highest price, and a piece that gets it (0: leave one free)."""
    own = np.where(prices > 0, prices, -np.inf)[1 : capacity + 1]
    values, choice = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for room in range(1, capacity + 1):
        found = values[room - 1 :: -1] + own[:room]
        k = int(found.argmax())
        values[room] = values[room - 1]
        if found[k] > values[room]:
            values[room], choice[room] = found[k], k + 1
    return values, choice


def best_fill(prices: np.ndarray, capacity: int) -> np.ndarray:
    """How many pieces of each length have the highest price within the capacity."""
    choice = knapsack(prices, capacity)[1].tolist()
    used, room = np.zeros(capacity + 1, np.int64), capacity
    while room > 0:
        if choice[room]:
            used[choice[room]] += 1
        room -= choice[room] or 1
    return used


def solve(counts: np.ndarray, capacity: int, within: int, step: float = 0.34, rate: float = 0.3) -> Solution:
    """The configuration program by multiplicative weights: (uses, configuration) pairs within the demand.

    A round prices all lengths that are left and solves one knapsack, which gives for every length the
    best configuration that holds it. From the best on, each that leaves at most 1/``within`` of the capacity
    free is used: as often as the share ``step`` of what is left of its lengths allows, rounded down, and
    at least once. Then the price of a length that is covered less than the others rises, and falls for one
    that is covered more, by a factor exponential in the difference. Ends when no such configuration is left.
    """
    lengths, demand = np.arange(capacity + 1), np.maximum(counts, 1)
    # Longer pieces are harder to place, so they start a little dearer than their length.
    base, weights = lengths * (1 + lengths / capacity / 8), np.ones(capacity + 1)
    rest = counts.astype(np.int64).tolist()
    solved = Solution(capacity)
    while True:
        left = np.array(rest)
        prices = np.where(left > 0, base * weights, 0.0)
        values, choice = knapsack(prices, capacity)
        ways, filled = choice.tolist(), [0] * (capacity + 1)
        for room in range(1, capacity + 1):
            filled[room] = ways[room] + filled[room - ways[room]] if ways[room] else filled[room - 1]
        full = (left > 0) & (lengths + np.array(filled[::-1]) >= capacity - capacity // within)
        offered = np.flatnonzero(full)
        worth = np.round(prices[offered] + values[capacity - offered], 9)
        share = [max(1, int(step * n)) for n in rest]
        found = 0
        for first in offered[np.lexsort((-offered, -worth))].tolist():
            config, room = {first: 1}, capacity - first
            while room > 0:
                if ways[room]:
                    config[ways[room]] = config.get(ways[room], 0) + 1
                room -= ways[room] or 1
            if any(rest[length] < many or share[length] < 1 for length, many in config.items()):
                continue
            times = max(1, min(share[length] // many for length, many in config.items()))
            for length, many in config.items():
                rest[length] -= times * many
                share[length] -= times * many
            solved.add(times, config)
            found += times
        if not found:
            return solved
        open_ = np.array(rest) / demand
        if (left := open_ > 0).any():
            weights = np.exp(rate * (open_ - open_[left].mean()))


def best_fit(counts: np.ndarray, capacity: int) -> Solution:
    """Fill sequence by sequence with the longest piece that fits, equal sequences together."""
    rest, chosen = counts.astype(np.int64).copy(), Solution(capacity)
    while rest.any():
        config, room = np.zeros(capacity + 1, np.int64), capacity
        while room and len(fitting := np.flatnonzero((rest[: room + 1] - config[: room + 1]) > 0)):
            length = int(fitting[-1])
            many = min(int(rest[length] - config[length]), room // length)
            config[length] += many
            room -= many * length
        used = np.flatnonzero(config)
        times = int((rest[used] // config[used]).min())
        rest -= times * config
        chosen.add(times, {int(x): int(config[x]) for x in used})
    return chosen


def rounded(counts: np.ndarray, solved: Solution, capacity: int) -> list[Configuration]:
    """The solution's configurations and the rest by best fit; best fit alone in the rare case that it needs fewer sequences."""
    rest = counts.astype(np.int64)
    for times, held in solved.kept:
        for length, many in held:
            rest[length] -= times * many
    chosen = [*solved.kept, *best_fit(rest, capacity).kept]
    alone = best_fit(counts, capacity).kept
    if sum(times for times, _ in alone) < sum(times for times, _ in chosen):
        chosen = alone
    plan = []
    for times, held in chosen:
        items, place = [], 0
        for length, many in sorted(held, reverse=True):
            items.append((length, many, place))
            place += length * many
        plan.append((times, items))
    return plan


def slots(plan: list[Configuration], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length the ranks at which its configurations begin, and what a rank maps to."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks, sequence = np.zeros(capacity + 1, np.int64), 0
    for times, items in plan:
        for length, many, place in items:
            found.setdefault(length, []).append((int(ranks[length]), sequence, many, place))
            ranks[length] += times * many
        sequence += times
    return {length: tuple(np.array(x, np.int64) for x in zip(*rows, strict=True)) for length, rows in found.items()}


def pack_documents(
    docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, within: int = 1000,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Place every piece of every document: the columns of cut_documents, ``sequence_id``, ``offset``.

    The driver sees the number of pieces per length, at most ``capacity`` rows, and solves the packing
    for lengths up to 1/``within`` of a sequence; pieces then find their place by their rank among those of their length. The rank is
    a sum over tasks and the number within a task, so no length gathers in one place. NULL texts are
    documents with the end id alone; repeated rows and ids are separate documents; an empty table
    gives an empty one.
    """
    cut = stage(cut_documents(docs, tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col, with_ids=with_ids), "pieces")
    tallied = stage(cut.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in tallied.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[row["length"]] = row["n"]
    table = slots(rounded(counts, solve(counts, capacity, within), capacity), capacity)
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = tallied.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column("length").to_numpy(zero_copy_only=False)
            ranks = batch.column("_rank").to_numpy(zero_copy_only=False)
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                first, at, many, start = table[int(length)]
                k = np.searchsorted(first, ranks[own], side="right") - 1
                nth = ranks[own] - first[k]
                sequence[own] = at[k] + nth // many[k]
                offset[own] = start[k] + nth % many[k] * length
            kept = batch.select([n for n in batch.schema.names if n != "_rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset)], names=[*kept.schema.names, "sequence_id", "offset"]
            )

    ranked = cut.join(bases, ["length", "slice"]).withColumn("_rank", F.col("nth") + F.col("_before"))
    shown = [c for c in cut.columns if c not in ("slice", "nth")]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*shown).schema)
    return ranked.select(*shown, "_rank").mapInArrow(place, f"{types}, sequence_id long, offset long")
