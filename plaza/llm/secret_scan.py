"""Secret scans: patterns propose candidates, a random forest removes false positives."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaza.llm.common import pieces, small_batches
from plaza.session import stage

BATCH_BYTES = 4 << 20
MOST_LABELS = 10_000  # findings that the labels at sight, or the reviewed ones, weigh as much as at most
MOST_WORDS = 20_000  # of the dictionary
TASK_LABELS = 50_000  # findings that a task of the fit holds

# Formats that providers document. The first group is the secret.
FORMATS = {
    "aws key": ("AKIA ASIA", r"\b((?:AKIA|ASIA)[A-Z0-9]{16})\b"),
    "github token": ("ghp_ gho_ ghu_ ghs_ ghr_ github_pat_", r"\b(gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,})\b"),
    "slack token": ("xox", r"\b(xox[abeprs]-[A-Za-z0-9-]{10,})"),
    "stripe key": ("k_live_ k_test_", r"\b([rs]k_(?:live|test)_[A-Za-z0-9]{16,})\b"),
    "google key": ("AIza", r"\b(AIza[A-Za-z0-9_-]{35})"),
    "web token": ("eyJ", r"\b(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*)"),
    "private key": ("PRIVATE KEY-----", r"(-----(?:BEGIN|END) [A-Z ]{0,30}PRIVATE KEY-----)"),  # the marks; see _private_keys
}
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "accesskey", "credential", "private_key", "auth_key")
ASSIGNED = re.compile(
    r"(?i)[\w.-]{0,40}(?:" + "|".join(KEYWORDS) + r""")[\w.-]{0,40}["']?\s{0,3}(?::=|=>|=|:)\s{0,3}["'`]?([^\s"'`,;<>(){}\[\]]{6,})"""
)
# What follows the first mark of a private key whose last one is missing: headers, then lines or long runs of base64.
REST_OF_KEY = re.compile(
    r"(?:(?:\s|\\[rn])*+[A-Z][A-Za-z-]+: [^\r\n\\]*+)*+"
    r"(?:(?:\s|\\[rn])*+(?:[A-Za-z0-9+/=]{16,}+|(?<=[\s\\nr-])[A-Za-z0-9+/=]++(?=[ \t]*(?:[\r\n]|\\[rn]|\Z))))*+"
)
# Any run of key letters that has a digit and a letter and is long enough.
RUN = re.compile(r"[A-Za-z0-9+/_=.~-]*[0-9][A-Za-z0-9+/_=.~-]*")
LEAST_RUN = 12
LONG = 256  # characters of a value that is no placeholder

# Well-known harmless formats, and words that tell what a value next to them is.
HARMLESS = (
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}", r"[0-9][0-9.,:/_+-]*", r"\d{4}-\d\d-\d\d[T_ ]?[\d:.]*Z?",
    r"v?\d+(\.\d+)+[\w.-]*", r"[\w.+-]+@[\w.-]+", r"(https?:/)?/?[\w.-]+\.(com|org|net|html?|php|png|jpe?g|gif|pdf|js|css)([/?#].*)?", r"(.)\1+",
)
PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|xxxx|\*\*\*\*|<.*>|\$\{|redacted|0123456789|abcdef(?!\d)|test[_-]?(?:key|token|password)")
GOOD_WORDS = frozenset("password passwd pwd secret token key apikey api credential credentials auth bearer access private login".split())
BAD_WORDS = frozenset("sha sha1 sha256 md5 hash commit checksum digest uuid guid id isbn doi phone tel call fax ip card visa order invoice version page chapter mail email".split())

_HARMLESS = re.compile("|".join(f"(?:{x})" for x in HARMLESS))
_FORMATS = {name: (tuple(hints.split(" ")) if name != "private key" else (hints,), re.compile(pattern)) for name, (hints, pattern) in FORMATS.items()}
_WORDS = re.compile(r"[^\W\d_]+")
FEATURES = (
    "length", "digits", "upper", "lower", "other", "transitions", "entropy", "longest_run", "hex", "distinct", "dictionary",
    "slashes", "in_url", "has_at", "placeholder", "quoted", "assigned", "good_near", "bad_near", "words_before", "formatted",
)


@dataclass(frozen=True)
class Finding:
    start: int
    end: int
    detector: str


def candidates(text: str) -> list[Finding]:
    """Places that may hold a secret, by the strongest detector; they don't overlap.

    Places that overlap are one, from the first to the last character of any, so no rest of a secret stays
    behind. A key-like run adds only what follows the others: before them it holds a name or a path.
    """
    found: list[Finding] = []
    for name, (hints, pattern) in _FORMATS.items():
        if any(hint in text for hint in hints):
            found += _private_keys(text) if name == "private key" else [Finding(*m.span(1), name) for m in pattern.finditer(text)]
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        found += [Finding(*m.span(1), "assignment") for m in ASSIGNED.finditer(text)]
    strength = {name: k for k, name in enumerate([*FORMATS, "assignment", "key-like"])}
    chosen: list[Finding] = []
    for one in sorted(found, key=lambda f: f.start):
        if chosen and one.start < chosen[-1].end:
            last = chosen.pop()
            one = Finding(last.start, max(last.end, one.end), min(last.detector, one.detector, key=strength.__getitem__))
        chosen.append(one)
    runs: list[Finding] = []
    if any(digit in text for digit in "0123456789"):
        for m in re.finditer(r"\S*\d\S*", text) if len(text) < 64 else _digit_runs(text):
            for run in RUN.finditer(m[0] if isinstance(m, re.Match) else text[m[0] : m[1]]):
                base = m.start() if isinstance(m, re.Match) else m[0]
                if len(run[0]) >= LEAST_RUN:
                    runs.append(Finding(base + run.start(), base + run.end(), "key-like"))
    starts, alone = [one.start for one in chosen], []
    for run in runs:
        place = bisect_left(starts, run.end) - 1  # the last place that begins before the run ends
        if place < 0 or chosen[place].end <= run.start:
            alone.append(run)
            continue
        rest = text[chosen[place].end : run.end].rstrip("+/_.~-")
        if any(c.isalnum() for c in rest):
            chosen[place] = replace(chosen[place], end=chosen[place].end + len(rest))
    return sorted(chosen + alone, key=lambda f: f.start)


def _private_keys(text: str) -> Iterator[Finding]:
    """From each first mark to the next last one, whatever its length; without one, what looks like the key."""
    marks = list(_FORMATS["private key"][1].finditer(text))
    for mark, after in zip(marks, [*marks[1:], None], strict=True):
        if mark[1].startswith("-----BEGIN"):
            whole = after is not None and after[1].startswith("-----END")
            yield Finding(mark.start(), after.end() if whole else REST_OF_KEY.match(text, mark.end()).end(), "private key")


_DIGIT = re.compile(r"[0-9]")
_SPACE = re.compile(r"\s")


def _digit_runs(text: str) -> Iterator[tuple[int, int]]:
    """The words that hold a digit: found from the digits, which are rare, instead of from all words."""
    at = 0
    while digit := _DIGIT.search(text, at):
        start = digit.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, digit.end())
        at = space.start() if space else len(text)
        yield start, at


def _placeholder(value: str) -> bool:
    """A long value is none: random letters hold 'xxxx' somewhere if there are enough of them."""
    return len(value) < LONG and bool(PLACEHOLDER.search(value))


def features(text: str, one: Finding, words: frozenset[str]) -> list[float]:
    """What the forest sees of a candidate, in the order of FEATURES."""
    value = text[one.start : one.end]
    n = max(1, len(value))
    kinds = "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value)
    runs = [len(m[0]) for m in re.finditer(r"(.)\1*", kinds)]
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    known = sum(len(w) for w in _WORDS.findall(value.lower()) if w in words)
    before, after = text[max(0, one.start - 80) : one.start], text[one.end : one.end + 40]
    near = [w.lower() for w in _WORDS.findall(before)[-4:] + _WORDS.findall(after)[:1]]
    left = before.rstrip().rstrip("\"'`").rstrip()
    head = before.rsplit(None, 1)[-1] if before and not before[-1].isspace() else ""
    return [float(x) for x in (
        len(value), kinds.count("d") / n, kinds.count("u") / n, kinds.count("l") / n, kinds.count("o") / n, (len(runs) - 1) / n, entropy,
        max(runs, default=0) / n, all(c in "0123456789abcdefABCDEF" for c in value), len(counts) / n, known / n, value.count("/") / n,
        "://" in head or "://" in value or head.startswith(("www.", "/")), "@" in value or after.startswith("@"), _placeholder(value),
        before[-1:] in "\"'`" if before else False, left.endswith(("=", ":", "=>")), not GOOD_WORDS.isdisjoint(near), not BAD_WORDS.isdisjoint(near),
        sum(w in words for w in near), one.detector in FORMATS,
    )]


def certain(value: str, one: Finding) -> bool:
    return one.detector in FORMATS and not _placeholder(value)


def audited(value: str, one: Finding) -> float | None:
    """A label for findings that a reviewer would settle at sight: documented formats and harmless ones; else None."""
    if _placeholder(value):
        return 0.0
    if certain(value, one):
        return 1.0
    if _HARMLESS.fullmatch(value):
        return 0.0
    if one.detector == "assignment":
        return 1.0 if len(set(value)) >= 6 and any(c.isdigit() for c in value) else 0.0 if value.isalpha() and len(value) < 8 else None
    return None


@dataclass(frozen=True)
class SecretModel:
    """The trees as arrays (feature, threshold, left, right, probability), leaves with feature -1, and the dictionary."""

    trees: list[tuple[np.ndarray, ...]]
    words: frozenset[str]

    def score(self, rows: Sequence[Sequence[float]], found: Sequence[Finding]) -> list[float]:
        if not rows:
            return []
        if not self.trees:  # nothing was learned: only documented formats are certain
            return [1.0 if one.detector in FORMATS else 0.0 for one in found]
        x, total = np.array(rows), np.zeros(len(rows))
        for feature, threshold, left, right, probability in self.trees:
            at = np.zeros(len(rows), np.int64)
            while (feature[at] >= 0).any():
                inner = feature[at] >= 0
                go = x[np.arange(len(rows)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += probability[at]
        return (total / len(self.trees)).tolist()


def _trees(model) -> list[tuple[np.ndarray, ...]]:
    """A fitted forest as arrays, so that tasks can apply it where they read the texts."""
    found = []
    for tree in model.trees:
        rows: list[list[float]] = []

        def add(node, rows=rows) -> int:
            place = len(rows)
            rows.append([])
            if node.subtreeDepth() == 0:
                stats = list(node.impurityStats().stats())
                total = sum(stats)
                rows[place] = [-1, 0.0, 0, 0, stats[1] / total if len(stats) > 1 and total else 0.0]
            else:
                split = node.split()
                left = add(node.leftChild())
                rows[place] = [split.featureIndex(), split.threshold(), left, add(node.rightChild()), 0.0]
            return place

        add(tree._call_java("rootNode"))
        columns = np.array(rows, float).T
        found.append((columns[0].astype(np.int64), columns[1], columns[2].astype(np.int64), columns[3].astype(np.int64), columns[4]))
    return found


def _most_frequent(counts: DataFrame, most: int) -> frozenset[str]:
    """The ``most`` words with the highest n, ties to the smaller word.

    The least n comes from the list of distinct ones, so that tasks don't send ``most`` words each.
    """
    left, least = most, 0
    for n, words in counts.groupBy("n").agg(F.count(F.lit(1))).orderBy(F.desc("n")).toLocalIterator():
        if words > left:
            least = n
            break
        left -= words
    found = counts.filter(F.col("n") > least).select("word")
    ties = counts.filter(F.col("n") == least).select("word").orderBy("word").limit(left)
    return frozenset(r["word"] for r in found.unionByName(ties).collect())  # at most ``most``


def train_secret_model(
    docs: DataFrame, labelled: DataFrame | None = None, *, sample: int | None = None, most_labels: int = MOST_LABELS, id_col: str = "doc_id",
    text_col: str = "text", seed: int = 11,
) -> SecretModel:
    """Fit the forest on all findings of all documents that have a label.

    ``labelled`` (id, start, label) gives reviewed findings; the rest get a label where one is certain at sight.
    Labels weigh alike, however rare one is; of a label, the reviewed findings and the others weigh as much as
    they are, but at most as ``most_labels``, so that many of one do not drown the other. The dictionary is the
    most frequent words that several documents share: of all, or of about ``sample`` if that is asked for. Both
    sides of the label are needed; without them only documented formats are trusted.
    """
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    read = given
    if sample is not None:
        point = F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(1 << 30)) / float(1 << 30)
        read = given.filter(point < min(1.0, sample / max(1, given.count())))
    counts = (
        read.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\b([\p{L}]{3,16})\b"), 1))).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter("n >= 3")
    )
    dictionary = _most_frequent(stage(counts, "words"), MOST_WORDS)
    if labelled is None:
        given = given.withColumn("reviewed", F.lit(None).cast("array<struct<start:long,label:double>>"))
    else:
        reviewed = labelled.select(F.col(labelled.columns[0]).cast("string").alias("id"), F.col("start").cast("long"), F.col("label").cast("double"))
        reviewed = reviewed.dropna().groupBy("id", "start").agg(F.max("label").alias("label")).groupBy("id").agg(F.collect_list(F.struct("start", "label")).alias("reviewed"))
        given = given.join(reviewed, "id", "left").select("id", "text", "reviewed")

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[str | None, str, Finding, float, int, float]]]:
        """Per batch the findings with a label: id, text, finding, label, kind (label, reviewed or not), place by a hash."""
        for batch in pieces(batches, "text", BATCH_BYTES):
            rows = []
            for key, text, given_labels in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "reviewed")), strict=True):
                own = {r["start"]: r["label"] for r in given_labels or ()}
                for one in candidates(text):
                    value = text[one.start : one.end]
                    label = own.get(one.start, audited(value, one))
                    if label is not None:
                        digest = hashlib.blake2b(f"{seed}:{key}:{one.start}:{value}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
                        rows.append((key, text, one, label, 2 * int(label) + (one.start in own), int.from_bytes(digest) / 2.0**64))
            yield rows

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in settled(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[5] for r in rows], pa.float64()), pa.array([r[4] for r in rows], pa.int32()),
                    pa.array([r[3] for r in rows], pa.float64()), pa.array([features(r[1], r[2], dictionary) for r in rows], pa.list_(pa.float64())),
                ],
                names=["place", "kind", "label", "features"],
            )

    found = given.mapInArrow(learned, "place double, kind int, label double, features array<double>")
    # Copies of a document give one place, so they count once.
    known = stage(found.groupBy("place", "kind", "label").agg(F.min("features").alias("features")), "secret-labels")
    many = {(r["label"], r["kind"]): r["n"] for r in known.groupBy("label", "kind").agg(F.count(F.lit(1)).alias("n")).collect()}  # four rows
    share = {group: min(1.0, most_labels / n) for group, n in many.items()}
    mass = {label: sum(share[g] * n for g, n in many.items() if g[0] == label) for label, _ in many}
    if len(mass) < 2:
        return SecretModel([], dictionary)
    # A label weighs half of all.
    weights = {group: share[group] * sum(mass.values()) / (2.0 * mass[group[0]]) for group in many}
    weight = F.coalesce(*[F.when((F.col("label") == label) & (F.col("kind") == kind), value) for (label, kind), value in weights.items()])
    # Dealt by a hash and sorted, findings give the same forest in every run, however they were read.
    known = known.repartition(math.ceil(sum(many.values()) / TASK_LABELS), "place").sortWithinPartitions("place", "kind", "label")
    # The detector's name settles the label of the certain ones: the forest must see the value itself.
    vectors = known.select("label", weight.alias("weight"), array_to_vector(F.transform("features", lambda x, k: F.when(k == len(FEATURES) - 1, 0.0).otherwise(x))).alias("features"))
    forest = RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed, featuresCol="features", labelCol="label", weightCol="weight")
    return SecretModel(_trees(forest.fit(vectors)), dictionary)


def judge_text(text: str, model: SecretModel, least: float = 0.5) -> list[tuple[Finding, float, bool]]:
    found = candidates(text)
    rows = [features(text, one, model.words) for one in found]
    for row in rows:
        row[-1] = 0.0
    # The forest does not overrule a documented format.
    scores = [1.0 if certain(text[one.start : one.end], one) else score for one, score in zip(found, model.score(rows, found), strict=True)]
    return [(one, score, score >= least) for one, score in zip(found, scores, strict=True)]


def scan_secrets(docs: DataFrame, model: SecretModel | None = None, *, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, detector, score, is_secret) of every candidate, in characters of the whole text.

    NULL and empty texts have none; repeated rows give their findings again; an empty table gives none.
    """
    small_batches(docs.sparkSession)
    model = model or train_secret_model(docs, id_col=id_col, text_col=text_col)
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", BATCH_BYTES):
            rows = []
            for k, text in enumerate(batch.column("text").to_pylist()):
                rows += [(k, one.start, one.end - one.start, one.detector, score, secret) for one, score, secret in judge_text(text or "", model, least)]
            if rows:
                place, *columns = zip(*rows, strict=True)
                types = (pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.bool_())
                ids = batch.column("doc_id").take(pa.array(place, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names=["doc_id", "start", "length", "detector", "score", "is_secret"])

    return given.mapInArrow(scan, f"doc_id {id_type}, start long, length long, detector string, score double, is_secret boolean")


def remove_secrets(docs: DataFrame, model: SecretModel | None = None, *, least: float = 0.5, mark: str = "[SECRET]", id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The same rows and columns with secrets replaced by ``mark``; all other texts stay as they are.

    ``size_col``, if there is one, is set to the length of a text that changed.
    """
    small_batches(docs.sparkSession)
    model = model or train_secret_model(docs, id_col=id_col, text_col=text_col)
    names = docs.columns

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text_col, BATCH_BYTES):
            texts = batch.column(text_col).to_pylist()
            sizes = batch.column(size_col).to_pylist() if size_col in names else [None] * len(texts)
            for k, text in enumerate(texts):
                secrets = [one for one, _, secret in judge_text(text or "", model, least) if secret]
                for one in reversed(secrets):
                    text = text[: one.start] + mark + text[one.end :]
                if secrets:
                    texts[k], sizes[k] = text, len(text)
            new = {text_col: texts} | ({size_col: sizes} if size_col in names else {})
            columns = [pa.array(new[n], batch.schema.field(n).type) if n in new else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(mask, docs.schema)
