"""Token files: blocks coded by a static range asymmetric numeral system.

The file format is a folder with two Parquet tables. ``table`` has the frequency of each token id,
which sum to 2**scale and are shared by all blocks. ``blocks`` has one row per block of whole
documents: their ids and lengths, the place of the block, and the coded ids. A block is coded in
LANES interleaved streams, token i in stream i % LANES; ``states`` and ``places`` hold the streams'
states and the place in ``words`` at every CHECK-th row of tokens, so decoding can begin at any of
them, and ``check_crc32`` the checksum of the ids from each to the next; ``ids_crc32`` checks the
block and ``table_crc32`` that it goes with the table.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plaza.llm.common import ROWS, Scratch, gathered, pieces, small_batches
from plaza.llm.tokens import encoder, tokenizer_file

SCALE = 20  # frequencies sum to 2**SCALE
LANES = 2048
CHECK = 128  # rows of LANES tokens between checkpoints
BLOCK = 1 << 20  # tokens after which a block ends with its document
# States stay in [2**20, 2**52), so that doubles hold them and quotients exactly; words of 32 bits go out and in.
LOW, WORD = 2.0**20, 2.0**32
BATCH_BYTES = 4 << 20
BLOCK_ROWS = "8"  # blocks in an Arrow batch
CHUNK = 8192  # ids whose counts are summed as one row
END = 2

RAW_SCHEMA = "part int, block int, start_in_part long, n_tokens long, doc_ids array<{id}>, lengths array<long>, ids binary, counts array<binary>"
BLOCK_SCHEMA = (
    "part int, block int, start_in_part long, n_tokens long, doc_ids array<{id}>, lengths array<long>, "
    "words binary, states binary, places array<long>, check_crc32 array<long>, ids_crc32 long, table_crc32 long"
)


def quantised(counts: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Frequencies of at least 1 for every id that occurs, which sum to 2**scale."""
    total, size = int(counts.sum()), 1 << scale
    seen = np.flatnonzero(counts)
    if len(seen) > size:
        raise ValueError("more ids than the frequency table has room for")
    freq = np.zeros(len(counts), np.int64)
    if total:
        freq[seen] = np.maximum(1, np.floor(counts[seen] * (size / total))).astype(np.int64)
        spare = size - int(freq.sum())
        by_count = seen[np.argsort(-counts[seen], kind="stable")]
        if spare > 0:
            freq[by_count[0]] += spare
        for k in by_count:
            if spare >= 0:
                break
            taken = min(int(freq[k]) // 2, -spare)
            freq[k] -= taken
            spare += taken
    return freq


class Coder:
    """Codes and decodes arrays of ids with one frequency table, all streams of a row at once."""

    def __init__(self, freq: np.ndarray, scale: int = SCALE):
        self.size = float(1 << scale)
        self.freq = freq.astype(np.float64)
        self.begin = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.float64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint16 if len(freq) <= 1 << 16 else np.uint32), freq)
        self.crc = zlib.crc32(freq.astype("<u8").tobytes())

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, list[int]]:
        """(words, states, places): states and places are those a decoder has at each checkpoint."""
        x = np.full(LANES, LOW)
        out: list[np.ndarray] = []
        states, places, written = [], [], 0
        span = LANES * CHECK
        for first in range((len(ids) - 1) // span * span, -1, -span):
            part = ids[first : first + span]
            freqs, begins = self.freq[part], self.begin[part]
            most, gain = freqs * (WORD * LOW / self.size), self.size - freqs
            for at in range((len(part) - 1) // LANES * LANES, -1, -LANES):
                row = slice(at, at + LANES)
                now = x[: len(freqs[row])]
                full = np.flatnonzero(now >= most[row])
                over = now[full]
                high = np.floor(over * (1 / WORD))
                out.append((over - high * WORD).astype("<u4"))
                written += len(full)
                now[full] = high
                now += np.floor(now / freqs[row]) * gain[row] + begins[row]
            states.append(x.astype("<u8").tobytes())
            places.append(written)
        # The decoder reads backwards: row by row from the last one written.
        data = np.concatenate(out[::-1]).tobytes() if out else b""
        return data, b"".join(states[::-1]), [written - p for p in places[::-1]]

    def decode(self, words: bytes, states: bytes, places: list[int], n: int, segment: int | None = None) -> np.ndarray:
        """All ids, or those from one checkpoint to the next."""
        rows = -(-n // LANES)
        first, last = (0, rows) if segment is None else (segment * CHECK, min(rows, (segment + 1) * CHECK))
        found = np.empty(max(0, min(n, last * LANES) - first * LANES), np.uint32)
        if not len(found):
            return found
        start = first // CHECK
        x = np.frombuffer(states, "<u8")[start * LANES : (start + 1) * LANES].astype(np.float64)
        data, place = np.frombuffer(words, "<u4"), places[start]
        for row in range(first, last):
            now = x[: min(LANES, n - row * LANES)]
            high = np.floor(now * (1 / self.size))
            slot = now - high * self.size
            own = self.symbol[slot.astype(np.intp)].astype(np.intp)
            found[(row - first) * LANES : (row - first) * LANES + len(now)] = own
            now[:] = self.freq[own] * high + (slot - self.begin[own])
            low = np.flatnonzero(now < LOW)
            now[low] = now[low] * WORD + data[place : place + len(low)]
            place += len(low)
        if segment is None and (x != LOW).any():
            raise ValueError("a block's states do not end where they began")
        return found


@functools.lru_cache(maxsize=2)
def _coder(freq: bytes) -> Coder:
    """One coder for all tasks of a Python worker."""
    return Coder(np.frombuffer(freq, "<i8"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def write_token_files(
    docs: DataFrame, tokenizer: str, path: str, *, end_id: int = END, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode every text, in ascending order of its id, into token files under ``path``.

    Texts are sorted by a range shuffle; a pass over them makes blocks of plain ids and counts the
    ids of its task, and a second one codes the blocks where they lie. NULL and empty texts are the
    end id alone. NULL ids come first; rows with one id are separate documents, ordered by a hash of
    their text. An empty table gives files without blocks. Spark's writer commits the files, so a
    lost task leaves nothing behind.
    """
    spark = docs.sparkSession
    before = spark.conf.get(ROWS)
    spec = tokenizer_file(tokenizer)
    id_ddl = docs.select(id_col).schema[0].dataType.simpleString()
    raw_ddl, block_ddl = RAW_SCHEMA.format(id=id_ddl), BLOCK_SCHEMA.format(id=id_ddl)
    raw_schema, block_schema = _arrow(spark, raw_ddl), _arrow(spark, block_ddl)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(spec), TaskContext.get().partitionId()
        end = np.array([end_id], encode.dtype)
        counts = np.zeros(end_id + 1, np.int64)
        names, held, lengths, size, number, start = [], [], [], 0, 0, 0

        def block() -> pa.RecordBatch:
            nonlocal counts
            ids = np.concatenate(held)
            own = np.bincount(ids, minlength=len(counts))
            own[: len(counts)] += counts
            counts = own
            return _batch([(part, number, start, size, names, lengths, ids.tobytes(), None)], raw_schema)

        for batch in pieces(gathered(batches, "text", BATCH_BYTES // 2), "text", BATCH_BYTES):
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode.ids(batch.column("text")), strict=True):
                names.append(doc)
                held += [ids, end]
                lengths.append(len(ids) + 1)
                size += len(ids) + 1
                if size >= BLOCK:
                    yield block()
                    number, start = number + 1, start + size
                    names, held, lengths, size = [], [], [], 0
        if held:
            yield block()
        if counts.any():
            chunks = [counts[at : at + CHUNK].astype("<i8").tobytes() for at in range(0, len(counts), CHUNK)]
            yield _batch([(part, *[None] * 6, chunks)], raw_schema)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                own = sums.setdefault(chunk, np.zeros(CHUNK, np.int64))
                own[: len(data) // 8] += np.frombuffer(data, "<i8")
        for chunk, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([own.tobytes()])], names=["chunk", "counts"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text"))
    ordered = given.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    scratch = Scratch(spark)
    try:
        small_batches(spark)
        raw = scratch.write(ordered.select("doc_id", "text").mapInArrow(tokens, raw_ddl), "token-ids")

        each = raw.filter("counts is not null").select("part", F.posexplode("counts").alias("chunk", "counts"))
        for keys in (["chunk", F.col("part") % 64], ["chunk"]):  # many tasks' counts of one chunk meet in two steps
            each = each.repartition(*keys).select("chunk", "counts").mapInArrow(summed, "chunk int, counts binary")
        totals = {r["chunk"]: np.frombuffer(r["counts"], "<i8") for r in each.collect()}  # as long as the vocabulary
        counts = np.concatenate([totals[chunk] for chunk in sorted(totals)] or [np.zeros(1, np.int64)])
        counts = counts[: 1 + np.flatnonzero(counts).max(initial=0)]
        freq = quantised(counts)
        seen = np.flatnonzero(freq)
        table = pa.table({"token": pa.array(seen, pa.int64()), "freq": pa.array(freq[seen], pa.int64())})
        spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(f"{path}/table")
        shared = freq.astype("<i8").tobytes()

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            coder, span = _coder(shared), 4 * LANES * CHECK
            for batch in batches:
                for k in range(batch.num_rows):
                    *place, data = batch.slice(k, 1).to_pylist()[0].values()
                    ids = np.frombuffer(data, f"<u{len(data) // place[3]}")
                    plain = memoryview(ids.astype("<u4")).cast("B")
                    checks = [zlib.crc32(plain[at : at + span]) for at in range(0, len(plain), span)]
                    yield _batch([(*place, *coder.encode(ids), checks, zlib.crc32(plain), coder.crc)], block_schema)

        spark.conf.set(ROWS, BLOCK_ROWS)
        coded = raw.filter("counts is null").drop("counts").mapInArrow(blocks, block_ddl)
        coded.write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")
        scratch.drop("token-ids")
    finally:
        spark.conf.set(ROWS, before)


def _stored(spark: SparkSession, path: str) -> tuple[bytes, DataFrame]:
    """The frequency table, and the blocks with ``base``, the number of ids in all parts before theirs."""
    table = spark.read.parquet(f"{path}/table").toArrow()  # one row per id of the vocabulary
    token = table.column("token").to_numpy()
    freq = np.zeros(1 + token.max(initial=0), "<i8")
    freq[token] = table.column("freq").to_numpy()
    stored = spark.read.parquet(f"{path}/blocks")
    sums = stored.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return freq.tobytes(), stored.join(F.broadcast(bases), "part")  # one row per part of the files


def read_token_files(spark: SparkSession, path: str, *, with_ids: bool = False) -> DataFrame:
    """Per document (doc_id, start, n_tokens, ids_crc32[, ids]); a block that fails its checks is an error.

    ``start`` counts the ids of all documents before. Blocks are decoded independently; where a part
    of the files begins is a running sum over one row per part.
    """
    spark.conf.set(ROWS, BLOCK_ROWS)  # a row is a block, and the frame is evaluated later
    shared, placed = _stored(spark, path)
    id_ddl = placed.schema["doc_ids"].dataType.elementType.simpleString()
    ddl = f"doc_id {id_ddl}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    schema = _arrow(spark, ddl)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared)
        for batch in batches:
            for k in range(batch.num_rows):
                block = batch.slice(k, 1).to_pylist()[0]
                ids = coder.decode(block["words"], block["states"], block["places"], block["n_tokens"]).astype("<u4")
                plain = memoryview(ids).cast("B")
                if coder.crc != block["table_crc32"] or zlib.crc32(plain) != block["ids_crc32"]:
                    raise ValueError(f"block {block['block']} of part {block['part']} is damaged")
                rows, at, base = [], 0, block["base"] + block["start_in_part"]
                for doc, n in zip(block["doc_ids"], block["lengths"], strict=True):
                    own = plain[4 * at : 4 * (at + n)]
                    rows.append((doc, base + at, n, zlib.crc32(own), *([bytes(own)] if with_ids else [])))
                    at += n
                yield _batch(rows, schema)

    used = ("part", "block", "base", "start_in_part", "n_tokens", "doc_ids", "lengths", "words", "states", "places", "ids_crc32", "table_crc32")
    return placed.select(*used).mapInArrow(decode, ddl)


def read_segments(spark: SparkSession, path: str, first: int = 0, last: int | None = None) -> DataFrame:
    """(start, ids, task) per stretch of ids between two checkpoints that meets the places from ``first`` up to ``last``.

    ``start`` counts the ids before in all files, ``ids`` are little-endian unsigned 32-bit integers,
    and ``task`` is the partition that decoded them. Stretches of one block are cut out by Spark and
    dealt to different tasks, which begin at the stored states; other stretches are not decoded. One
    that fails its checksum is an error.
    """
    spark.conf.set(ROWS, BLOCK_ROWS)
    shared, placed = _stored(spark, path)
    span, lanes = LANES * CHECK, LANES
    begin = F.col("base") + F.col("start_in_part") + F.col("k") * span
    many = F.least(F.lit(span), F.col("n_tokens") - F.col("k") * span)
    till = F.coalesce(F.get("places", F.col("k") + 1), F.octet_length("words") / 4).cast("int")
    cut = placed.select("*", F.posexplode("places").alias("k", "place")).select(
        begin.alias("start"), many.alias("n"), "table_crc32", F.get("check_crc32", F.col("k")).alias("crc32"),
        F.substring("words", F.col("place").cast("int") * 4 + 1, (till - F.col("place").cast("int")) * 4).alias("words"),
        F.substring("states", F.col("k") * (8 * lanes) + 1, F.lit(8 * lanes)).alias("states"),
    ).filter(F.col("start") + F.col("n") > first)
    if last is not None:
        cut = cut.filter(F.col("start") < last)
    ddl = "start long, ids binary, task int"
    schema = _arrow(spark, ddl)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = _coder(shared), TaskContext.get().partitionId()
        for batch in batches:
            for row in batch.to_pylist():
                ids = coder.decode(row["words"], row["states"], [0], row["n"], 0).astype("<u4").tobytes()
                if coder.crc != row["table_crc32"] or zlib.crc32(ids) != row["crc32"]:
                    raise ValueError(f"the stretch at {row['start']} is damaged")
                yield _batch([(row["start"], ids, task)], schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(parts, "start").mapInArrow(decode, ddl)
