"""Near duplicates among embeddings by an epsilon grid order join."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import Scratch, small_batches
from plaza.llm.components import connected_components

LEAST = 0.93
GRID = 6  # leading principal dimensions whose cells order the vectors
BOX = 16  # leading principal dimensions of the boxes around intervals
BLOCK = 4096  # vectors of an interval that is joined in one task
PIECE = 256  # intervals up to this are compared by one product
SLACK = 1e-9


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector may link: labelled, not empty, without NULL or non-finite parts, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    long = F.aggregate(vector, F.lit(0.0), lambda total, x: total + F.abs(x.cast("double")))
    return F.coalesce(label.isNotNull() & vector.isNotNull() & ~bad & (long > 0), F.lit(False))


def _rows(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum([0, *pc.list_value_length(column).to_pylist()])
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _units(data: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(data), np.float64).reshape(-1, dim)


def numbered(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Per usable vector: a number, its id and label, length, a digest and the vector of length one."""
    small_batches(vectors.sparkSession)
    id_type, label_type = (vectors.select(c).schema[0].dataType.simpleString() for c in (id_col, label_col))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            own = _rows(batch.column("vector"))
            units = []
            for x in own:
                x = x / np.abs(x).max()  # else squares of very large or small parts are lost
                units.append((x / math.sqrt(float(x @ x))).tobytes())
            digests = [hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest() for x in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + len(own)), pa.int64()), batch.column("vec_id"), batch.column("label"),
                 pa.array([len(x) for x in own], pa.int32()), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
                names=["row", "vec_id", "label", "dim", "sig", "unit"],
            )
            row += len(own)

    given = vectors.filter(usable(F.col(vector_col), F.col(label_col))).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")
    )
    return given.mapInArrow(number, f"row long, vec_id {id_type}, label {label_type}, dim int, sig binary, unit binary")


def principal_axes(points: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length the principal axes of all vectors, from sums of products made in the tasks."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = _units([x for x, d in zip(batch.column("unit").to_pylist(), dims, strict=True) if d == dim], dim)
                own = np.hstack((own, np.ones((len(own), 1))))
                sums[dim] = sums.get(dim, 0) + own.T @ own
        for dim, total in sums.items():
            i, j = np.triu_indices(dim + 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim, np.int32)), pa.array(i), pa.array(j), pa.array(total[i, j])], names=["dim", "i", "j", "s"])

    # One row for each pair of dimensions.
    found = points.select("dim", "unit").mapInArrow(products, "dim int, i long, j long, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s")).toArrow()
    axes = {}
    dims = found["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        i, j, s = (found[c].to_numpy()[dims == dim] for c in ("i", "j", "s"))
        total = np.zeros((dim + 1, dim + 1))
        total[i, j] = total[j, i] = s
        mean = total[:dim, dim] / total[dim, dim]
        _, vectors = np.linalg.eigh(total[:dim, :dim] / total[dim, dim] - np.outer(mean, mean))
        axes[dim] = vectors[:, ::-1].copy()
    return axes


def _box(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[:, :BOX].min(axis=0), x[:, :BOX].max(axis=0)


def _apart(a: tuple, b: tuple) -> float:
    """The squared distance between two boxes."""
    gap = np.maximum(np.maximum(a[0] - b[1], b[0] - a[1]), 0.0)
    return float(gap @ gap)


def interval_join(a: np.ndarray, b: np.ndarray, least: float, same: bool) -> Iterator[tuple[int, int, np.ndarray]]:
    """Join two intervals of the grid order: (start in a, start in b, matrix of links) of the pieces that may link.

    Intervals are halved until they are small, and pairs of intervals whose boxes lie further apart
    than linking vectors can are skipped. With ``same`` the intervals are one, and pairs come once.
    """
    most = 2 - 2 * least + SLACK
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and a0 > b0:
            continue
        if _apart(_box(a[a0:a1]), _box(b[b0:b1])) > most:
            continue
        if max(a1 - a0, b1 - b0) <= PIECE:
            links = a[a0:a1] @ b[b0:b1].T >= least
            if same and a0 == b0:
                links &= np.triu(np.ones(links.shape, bool), 1)
            if links.any():
                yield a0, b0, links
            continue
        am, bm = (a0 + a1) // 2, (b0 + b1) // 2
        if same and (a0, a1) == (b0, b1):
            todo += [(a0, am, a0, am), (a0, am, am, a1), (am, a1, am, a1)]
        else:
            halves_a = [(a0, am), (am, a1)] if a1 - a0 > PIECE else [(a0, a1)]
            halves_b = [(b0, bm), (bm, b1)] if b1 - b0 > PIECE else [(b0, b1)]
            todo += [(*x, *y) for x in halves_a for y in halves_b]


def _forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a matrix of links, the least row that each is connected to; -1 for none."""
    n = len(links)
    far = np.iinfo(np.int64).max
    rows = np.where(links.any(axis=1), np.arange(n), far)
    while True:
        columns = np.where(links, rows[:, None], far).min(axis=0)
        now = np.minimum(rows, np.where(links, columns[None, :], far).min(axis=1))
        if (now == rows).all():
            break
        rows = now
    return np.where(rows == far, -1, rows), np.where(columns == far, -1, columns)


def near_duplicates(
    vectors: DataFrame, *, least: float = LEAST, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector.

    Vectors of one label and length link when their cosine is at least ``least``. Equal vectors are one
    point with a weight. Points are sorted by label and grid cells of side epsilon, the distance of
    linking vectors of length one, and cut into intervals; intervals meet if their first cells are
    neighbours and their boxes near enough. A task returns weights and a spanning forest instead of
    all links. Vectors that may not link (see usable) are alone; repeated rows link with each other;
    a NULL id is never the smallest and not kept, unless it is alone, which leaves ``kept`` NULL.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    reach = math.sqrt(2 - 2 * least + SLACK)
    known = scratch.write(numbered(vectors, id_col, vector_col, label_col), "vectors")
    classes = known.groupBy("label", "dim", "sig").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"))
    members = scratch.write(known.drop("unit").join(classes, ["label", "dim", "sig"]).select("row", "vec_id", "node", "weight"), "members")
    points = known.join(members.filter("row = node").select("row", "weight"), "row").select(
        F.col("row").alias("node"), "label", "dim", "weight", "unit"
    )
    points = scratch.write(points, "points")
    axes = principal_axes(points)
    label_type = known.schema["label"].dataType.simpleString()

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, turned = [], []
            for dim, unit in zip(batch.column("dim").to_pylist(), batch.column("unit").to_pylist(), strict=True):
                x = np.frombuffer(unit) @ axes[dim]
                cells.append((np.floor(np.append(x[:GRID], np.zeros(max(0, GRID - dim))) / reach)).astype(np.int32).tolist())
                turned.append(x.tobytes())
            kept = batch.select(["node", "label", "dim", "weight"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(cells, pa.list_(pa.int32())), pa.array(turned, pa.binary())], names=[*kept.schema.names, "cells", "unit"])

    turned = points.mapInArrow(turn, f"node long, label {label_type}, dim int, weight long, cells array<int>, unit binary")
    turned = scratch.write(turned, "turned")
    order = ["label", "dim", *[F.col("cells")[k] for k in range(GRID)], "node"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, group = TaskContext.get().partitionId() << 32, [], None

        def interval() -> pa.RecordBatch:
            x = _units([r["unit"] for r in held], group[1])
            low, high = _box(x)
            first = [r["cells"][0] for r in held]
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([group[0]], held_type), pa.array([group[1]], pa.int32()),
                 pa.array([min(first)], pa.int32()), pa.array([max(first)], pa.int32()), pa.array([low.tolist()]), pa.array([high.tolist()]),
                 pa.array([[r["node"] for r in held]]), pa.array([[r["weight"] for r in held]]), pa.array([x.tobytes()], pa.binary())],
                names=["block", "label", "dim", "c0", "c1", "low", "high", "nodes", "weights", "units"],
            )

        for batch in batches:
            held_type = batch.schema.field("label").type
            for row in batch.to_pylist():
                if held and (group != (row["label"], row["dim"]) or len(held) >= BLOCK):
                    yield interval()
                    block, held = block + 1, []
                group = (row["label"], row["dim"])
                held.append(row)
        if held:
            yield interval()

    schema = f"block long, label {label_type}, dim int, c0 int, c1 int, low array<double>, high array<double>, nodes array<long>, weights array<long>, units binary"
    blocks = turned.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(cut, schema)
    blocks = scratch.write(blocks, "blocks")
    scratch.drop("turned", "points")

    # Pairs of intervals of neighbouring first cells whose boxes are near enough.
    sides = blocks.select("block", "label", "dim", "c0", "c1", "low", "high")
    left = sides.withColumn("cell", F.explode(F.sequence("c0", "c1"))).select("label", "dim", "cell", *[F.col(c).alias(f"a_{c}") for c in ("block", "low", "high")])
    right = sides.withColumn("cell", F.explode(F.sequence(F.col("c0") - 1, F.col("c1") + 1))).select("label", "dim", "cell", *[F.col(c).alias(f"b_{c}") for c in ("block", "low", "high")])
    gaps = F.zip_with(
        F.zip_with("a_low", "b_high", lambda x, y: x - y), F.zip_with("b_low", "a_high", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x)
    met = left.join(right, ["label", "dim", "cell"]).filter(F.col("a_block") <= F.col("b_block")).filter(apart <= reach * reach + SLACK)
    pairs = scratch.write(met.select("a_block", "b_block").distinct(), "block-pairs")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a row holds two intervals
    a = blocks.select(F.col("block").alias("a_block"), "dim", F.col("nodes").alias("a_nodes"), F.col("weights").alias("a_weights"), F.col("units").alias("a_units"))
    b = blocks.select(F.col("block").alias("b_block"), F.col("nodes").alias("b_nodes"), F.col("weights").alias("b_weights"), F.col("units").alias("b_units"))
    work = pairs.join(a, "a_block").join(b, "b_block")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                same = row["a_block"] == row["b_block"]
                x, y = _units([row["a_units"]], row["dim"]), _units([row["b_units"]], row["dim"])
                nodes = np.concatenate((np.array(row["a_nodes"]), np.array(row["b_nodes"])))
                wa, wb = np.array(row["a_weights"]), np.array(row["b_weights"])
                links, ties = np.zeros(len(nodes), np.int64), [np.zeros((2, 0), np.int64)]
                for i, j, found in interval_join(x, y, least, same):
                    n, m = found.shape
                    links[i : i + n] += found @ wb[j : j + m]
                    links[len(x) + j : len(x) + j + m] += wa[i : i + n] @ found
                    rows, columns = _forest(found)
                    own = np.concatenate((nodes[i : i + n], nodes[len(x) + j : len(x) + j + m]))
                    to = np.concatenate((rows, columns))
                    ties.append(np.stack((own[to >= 0], nodes[i + to[to >= 0]])))
                tied = np.unique(np.concatenate(ties, axis=1), axis=1)
                tied = tied[:, tied[0] != tied[1]]
                seen = np.flatnonzero(links)
                none = pa.nulls(len(seen), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(nodes[seen]), pa.array(links[seen]), none], names=["node", "links", "tie"])
                yield pa.RecordBatch.from_arrays([pa.array(tied[0]), pa.nulls(tied.shape[1], pa.int64()), pa.array(tied[1])], names=["node", "links", "tie"])

    found = scratch.write(work.select("dim", *[c for c in work.columns if c != "dim"]).mapInArrow(join, "node long, links long, tie long"), "found")
    scratch.drop("block-pairs", "blocks")
    small_batches(spark)
    sums = found.filter("links is not null").groupBy("node").agg(F.sum("links").alias("links"))
    linked = connected_components(found.filter("tie is not null"), "node", "tie")
    rooted = members.join(sums, "node", "left").join(linked, "node", "left").withColumn("root", F.coalesce("component", "node"))
    names = rooted.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    shown = rooted.join(names, "root").select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    alone = vectors.filter(~usable(F.col(vector_col), F.col(label_col))).select(F.col(id_col).alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return shown.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
sums AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(s.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l ON e.vec_id = l.a LEFT JOIN sums s ON s.a = e.vec_id
"""
