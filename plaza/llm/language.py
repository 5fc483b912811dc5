"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import pieces, small_batches

BITS = 16  # n-grams are hashed to 2**BITS buckets
ORDERS = (1, 2, 3)
BATCH_BYTES = 1 << 20
SLICE = 1 << 19  # characters that are hashed at once
PER_LANGUAGE = 4000  # documents to learn a language from, in expectation
MOST_LANGUAGES = 500  # more distinct labels are an error: the matrix would not be small any more
UNKNOWN = "und"

# Fixed odd multipliers that spread the characters of an n-gram.
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    log_probs: np.ndarray  # languages x buckets
    log_priors: np.ndarray


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _characters(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, other runs as one space, and the text each comes from."""
    found, owner = [], []
    for k, text in enumerate(texts):
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters()[codes]
        codes = np.where(letter, codes, 32)
        codes = codes[letter | np.concatenate(([True], letter[:-1]))] if len(codes) else codes
        found.append(codes)
        owner.append(np.full(len(codes), k, np.int32))
    return np.concatenate(found).astype(np.uint32), np.concatenate(owner)


def buckets(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of all n-grams, a bounded slice at a time; an n-gram has a letter and stays in its text."""
    codes, owner = _characters(texts)
    longest = max(ORDERS)
    for start in range(0, len(codes), SLICE):
        part, own = codes[start : start + SLICE + longest - 1], owner[start : start + SLICE + longest - 1]
        hashed = np.zeros(len(part), np.uint32)
        for n in range(1, longest + 1):
            size = min(len(part) - n + 1, SLICE)
            if size <= 0:
                break
            with np.errstate(over="ignore"):
                hashed = (hashed[:size] ^ part[n - 1 : n - 1 + size]) * np.uint32(MULTIPLIERS[(n - 1) % 3]) + np.uint32(n)
                hashed ^= hashed >> np.uint32(15)
            whole = own[:size] == own[n - 1 : n - 1 + size]
            if n == 1:
                whole &= part[:size] != 32
            if n in ORDERS:
                yield own[:size][whole], ((hashed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS))[whole]


def held_out(id_col: str) -> Column:
    """Documents that are never learned from; a NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train_language_model(
    docs: DataFrame, *, per_language: int = PER_LANGUAGE, smoothing: float = 0.5, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> LanguageModel:
    """Learn from the labelled documents that are not held out.

    The priors count all of them. N-grams are counted over a sample chosen by a hash of the id, of
    about ``per_language`` documents of each language, whole texts. NULL labels and texts teach
    nothing; without labelled documents the model knows no language.
    """
    small_batches(docs.sparkSession)
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = sorted(sizes)
    size = 1 << BITS
    if not languages:
        return LanguageModel([], np.zeros((0, size)), np.zeros(0))
    share = F.lit(0.0)
    for name in languages:
        share = F.when(F.col("lang") == name, F.lit(min(1.0, per_language / sizes[name]))).otherwise(share)
    point = F.pmod(F.xxhash64(F.lit(29), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {name: k for k, name in enumerate(languages)}
        counts = np.zeros((len(languages), size), np.int64)
        for batch in pieces(batches, "text", BATCH_BYTES):
            own = np.array([number[x] for x in batch.column("lang").to_pylist()])
            for owner, found in buckets(batch.column("text").to_pylist()):
                counts += np.bincount(own[owner] * size + found, minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(counts[lang, bucket])], names=["lang", "bucket", "n"])

    learned = known.filter(point < share).select("text", "lang").mapInArrow(count, "lang long, bucket long, n long")
    counts = np.zeros((len(languages), size))
    # At most one row per language and bucket.
    table = learned.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts[table["lang"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    probs = (counts + smoothing) / (counts + smoothing).sum(axis=1, keepdims=True)
    priors = np.array([sizes[name] for name in languages], float)
    return LanguageModel(languages, np.log(probs), np.log(priors / priors.sum()))


def score_texts(model: LanguageModel, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
    """Most probable language and its posterior probability; the first of equals."""
    given = [text or "" for text in texts]
    sums = np.tile(model.log_priors, (len(given), 1))
    lettered = np.zeros(len(given), bool)
    for owner, found in buckets(given) if given else ():
        lettered |= np.bincount(owner, minlength=len(given)) > 0
        for k, column in enumerate(model.log_probs):
            sums[:, k] += np.bincount(owner, weights=column[found], minlength=len(given))
    if not model.languages:
        return [UNKNOWN] * len(given), [0.0] * len(given)
    best = sums.argmax(axis=1)
    posterior = 1.0 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, lettered, strict=True)]
    return names, np.where(lettered, posterior, 0.0).tolist()


def predict_language(docs: DataFrame, model: LanguageModel, *, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score``, one row each, without a shuffle.

    A text that is NULL, empty or without a letter gets ``und`` and 0. Only the text is looked at.
    Columns named lang_pred or score are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("lang_pred", "score")
    names = docs.columns

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col, BATCH_BYTES):
            langs, scores = score_texts(model, batch.column(text_col).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, "lang_pred", "score"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(predict, f"{types}, lang_pred string, score double")


def identify_language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from ``docs`` and predict all of them: (doc_id, held_out, lang_pred, score)."""
    model = train_language_model(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    given = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict_language(given, model).drop("text")


def keep_identified(docs: DataFrame, *, least_score: float = 0.5) -> DataFrame:
    """The documents whose language is known: the same columns; texts without a letter go."""
    model = train_language_model(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    judged = predict_language(docs, model)
    return judged.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select(*docs.columns)
