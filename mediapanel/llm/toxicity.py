"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic
text. Every window of ``WINDOW`` words is compressed with both; the ordinary
length minus the toxic length says how much of the window only the toxic
dictionary knows. How many windows of a document pass each of a row of
thresholds, in number and as a share, is calibrated to a probability by
logistic regression on labelled documents that trained neither dictionary.

A window is compressed behind ``BALLAST``, a string both dictionaries end
with: one match whose cost is the same, without which zstandard stores windows
of a single match as they are and their lengths tell nothing.

The ordinary dictionary comes from zstandard's own trainer over windows of
ordinary documents. That trainer prefers what is frequent, and nearly all text
of a toxic document is ordinary; so the toxic dictionary is the ordinary
content followed by the words whose share of toxic documents exceeds their
share of ordinary ones beyond chance (likelihood ratio), strongest last, where
offsets are shortest; of a few sizes the one that calibrates best is kept.
Text is reduced to lower-case words of ``MIN_WORD``
letters or more, so punctuation and casing carry no weight.

Learning uses at most about ``MAX_DOCS`` labelled documents per class, whole,
chosen by a hash of their id; classes are weighted back to their full counts.
Dictionaries and weights are of fixed size, whatever the input. Null and empty
texts have no windows and get the score of a document without any finding.
Without labels of both classes every score is the share of label 1 (0 without
labels).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediapanel.llm.common import fold, text_or_empty

WINDOW = 5
MIN_WORD = 4
LEVEL = 7
BALLAST = bytes(range(33, 97))  # no lower-case letter among them
MAX_DOCS = 12_000
ORDINARY_BYTES = 2048
TOXIC_BYTES = (200, 400, 800, 1600)  # sizes tried; more words lengthen the offsets of the strong ones
ORDINARY_WINDOWS = 20_000
LEAST_DOCS, LEAST_RATIO, LEAST_G2 = 3, 4.0, 12.0
THRESHOLDS = (1, 2, 3, 4, 5, 6, 8)

SLICE = 256  # rows scored at once

NOT_LETTERS = re.compile(r"[\W\d_]+")


def words_of(text: str) -> list[str]:
    return [w for w in NOT_LETTERS.sub(" ", text.lower()).split() if len(w) >= MIN_WORD]


def windows_of(words: list[str]) -> list[bytes]:
    return [(" " + " ".join(words[i:i + WINDOW]) + " ").encode("utf-8", "replace")
            for i in range(0, len(words), WINDOW)]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the constant
    prior: float | None = None  # the score of all, if there was nothing to learn


class Distance:
    def __init__(self, ordinary: bytes, toxic: bytes):
        self.compress = [self._compressor(d) for d in (ordinary, toxic)]

    @staticmethod
    def _compressor(content: bytes):
        import zstandard
        d = zstandard.ZstdCompressionDict(content + BALLAST, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False,
                                        write_content_size=False, write_dict_id=False).compress

    def features(self, text: str) -> list[float]:
        windows = windows_of(words_of(text))
        if not windows:
            return [0.0] * (3 + 2 * len(THRESHOLDS))
        a, b = self.compress
        windows = [BALLAST + w for w in windows]
        d = np.array([len(a(w)) - len(b(w)) for w in windows])
        counts = [int((d >= k).sum()) for k in THRESHOLDS]
        return [float(d.mean()), float(np.log(len(d))), float(d.max()),
                *[c / len(d) for c in counts], *[float(np.log1p(c)) for c in counts]]


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int, max_docs: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, toxic, part) of about ``max_docs`` documents per class
    outside fold 0, distinct texts only, and the full count per class. The ids
    chosen are of bounded number and go by broadcast."""
    known = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != 0))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    totals = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    draw = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), 11) / float(2 ** 53)
    share = F.when(F.col("toxic") == 1, F.lit(min(1.0, max_docs / totals.get(1, 1)))).otherwise(
        F.lit(min(1.0, max_docs / totals.get(0, 1))))
    chosen = known.where(draw < share)
    part = (F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / folds) % 2).cast("int")
    sample = (docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
              .join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("text"))
              .dropDuplicates(["h", "toxic"]).select("text", "toxic", part.alias("part")))
    return sample, totals


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, ordinary): documents of each class that hold the word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()
        for batch in batches:
            for t, y in zip(batch.column("text"), batch.column("toxic")):
                counts[y.as_py()].update(set(words_of(t.as_py())))
        words = list(counts[0].keys() | counts[1].keys())
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.string()), pa.array([counts[1][w] for w in part], pa.int64()),
                 pa.array([counts[0][w] for w in part], pa.int64())], names=["word", "toxic", "ordinary"])

    return (sample.select("text", "toxic").mapInArrow(run, "word string, toxic long, ordinary long")
            .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")))


def toxic_words(counts: DataFrame, n_toxic: int, n_ordinary: int, room: int = max(TOXIC_BYTES)) -> list[str]:
    """Words typical of toxic documents, weakest first, as many as fit."""
    def part(k, n, p):
        p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.log(p) + (n - k) * F.log(1 - p)

    a, b, na, nb = F.col("toxic"), F.col("ordinary"), F.lit(float(n_toxic)), F.lit(float(n_ordinary))
    both = (a + b) / (na + nb)
    g2 = 2 * (part(a, na, a / na) + part(b, nb, b / nb) - part(a, na, both) - part(b, nb, both))
    best = (counts.where((a >= LEAST_DOCS) & (a / na > LEAST_RATIO * b / nb))
            .withColumn("g2", g2).where(F.col("g2") > LEAST_G2)
            .orderBy(F.desc("g2"), "word").limit(room // MIN_WORD).collect())
    words, size = [], 1
    for r in best:
        size += len(r["word"].encode("utf-8")) + 1
        if size > room:
            break
        words.append(r["word"])
    return words[::-1]


def ordinary_dictionary(sample: DataFrame) -> bytes:
    """zstandard's trainer over a bounded number of windows of ordinary text."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                for i, w in enumerate(windows_of(words_of(t.as_py()))):
                    if i % 8 == 0:
                        yield pa.RecordBatch.from_arrays([pa.array([w], pa.binary())], names=["w"])

    rows = (sample.where("toxic = 0").select("text").mapInArrow(run, "w binary")
            .withColumn("h", F.xxhash64("w")).orderBy("h").limit(ORDINARY_WINDOWS).select("w").toArrow())
    windows = [w.as_py() for w in rows.column(0)]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, windows).as_bytes()
    except zstandard.ZstdError:  # the trainer refuses a few windows; they are then the dictionary
        return b"".join(windows)[-ORDINARY_BYTES:]


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted logistic regression by Newton steps on standardised features."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    penalty = np.full(z.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z.T * (weight * p * (1 - p) + 1e-9)) @ z + np.diag(penalty)
        step = np.linalg.solve(h, z.T @ (weight * (y - p)) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, max_docs: int = MAX_DOCS) -> Model:
    """The driver gets counts, a bounded list of words and windows, and one row
    of features per calibration document of the bounded sample."""
    none = np.zeros(0)
    sample, totals = labelled_sample(docs, labels, folds, max_docs)
    seen = {(r[0], r[1]): r[2] for r in sample.groupBy("part", "toxic").count().collect()}
    if any(not seen.get((p, y)) for p in (0, 1) for y in (0, 1)):
        n = sum(totals.values())
        return Model(b"", b"", none, none, none, totals.get(1, 0) / n if n else 0.0)
    teach, check = sample.where("part = 0"), sample.where("part = 1")
    ordinary = ordinary_dictionary(teach)
    words = toxic_words(word_counts(teach), seen[0, 1], seen[0, 0])
    content = (" " + " ".join(words) + " ").encode("utf-8", "replace")
    tried = [ordinary + content[-size:] for size in TOXIC_BYTES]
    n_features = 3 + 2 * len(THRESHOLDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distances = [Distance(ordinary, toxic) for toxic in tried]
        for batch in batches:
            f = [[x for d in distances for x in d.features(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(f, pa.list_(pa.float64()))],
                                             names=["toxic", "f"])

    rows = check.select("text", "toxic").mapInArrow(run, "toxic int, f array<double>").toArrow()
    y = rows.column("toxic").to_numpy().astype(float)
    every = np.array(rows.column("f").to_pylist(), float).reshape(len(y), len(tried), n_features)
    order = np.lexsort(np.c_[every.reshape(len(y), -1), y].T)  # the same sums whatever order the rows came in
    every, y = every[order], y[order]
    weight = np.where(y == 1, totals[1] / max(1, y.sum()), totals[0] / max(1, (1 - y).sum()))
    weight /= weight.mean()
    best: tuple[float, Model] | None = None
    for i, toxic in enumerate(tried):
        x = every[:, i]
        mean, scale, w = _fit(x, y, weight)
        z = np.clip((x - mean) / scale @ w[:-1] + w[-1], -30, 30)
        loss = float((weight * np.logaddexp(0, np.where(y == 1, -z, z))).sum())
        if best is None or loss < best[0]:
            best = loss, Model(ordinary, toxic, mean, scale, w)
    return best[1]


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` plus ``score`` and ``predicted``; only ``text`` is looked at."""
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    if model.prior is not None:
        return docs.select(*kept, F.lit(float(model.prior)).alias("score"),
                           F.lit(int(model.prior >= 0.5)).alias("predicted"))
    src = docs.select(*kept, text_or_empty(F.col(text)).alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["score double", "predicted int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model.ordinary, model.toxic)
        for batch in (whole.slice(i, SLICE) for whole in batches for i in range(0, whole.num_rows, SLICE)):
            x = np.array([distance.features(t.as_py()) for t in batch.column(batch.num_columns - 1)])
            z = (x.reshape(batch.num_rows, -1) - model.mean) / model.scale @ model.weights[:-1] + model.weights[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(batch.num_columns - 1)]
                + [pa.array(p, pa.float64()), pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                names=kept + ["score", "predicted"])

    return src.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Learn outside fold 0, score every document."""
    model = train(docs, labels, folds)
    held = (fold(F.col("doc_id"), folds) == 0).alias("held_out")
    return (score(docs.select("doc_id", held, "text"), model)
            .select("doc_id", "held_out", "score", "predicted"))
