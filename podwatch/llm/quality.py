"""Quality scores of documents: ridge regression on random Fourier features, with isotonic calibration.

Statistics of each whole text are standardised, mapped to random cosines that approximate a Gaussian kernel,
and fitted by ridge regression. Each partition of labelled rows sums its own normal equations; these are added a few
at a time until one small matrix is left, which the driver solves. Scores of labelled rows that the fit did not see are
binned by Spark, and an isotonic curve through the bins turns scores into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podwatch.llm.memory import released
from podwatch.llm.scratch import Scratch, bounded_batches
from podwatch.llm.tree import PART, combined, one_part, summed

FEATURES = 256
RIDGE = 1e-3  # of the number of rows
SEED = 20_240_131
BROADCAST_LABELS = 2_000_000  # labels that are sent to every executor, some 100 MB there; beyond, a join shuffles
BINS = 400
BLOCK = 1_000  # rows whose features are in memory at a time
REJECT_BELOW = 0.3

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n",
    "stop": b".,;:'\"()-",
    "loud": b"!?",
    "sign": b"#$%&*+=<>@^~_\\/",
    "bar": b"|[]{}",
}
_OTHER = ["log_bytes", "log_words", "word_length", "word_spread", "distinct_words", "distinct_pairs", "same_as_last", "ends_in_letter", "distinct_lines", "line_words"]
STATISTICS = ["wide", *_CLASSES, *_OTHER]
_TO_CLASS = np.zeros((256, len(_CLASSES) + 1))
_TO_CLASS[128:, 0] = 1
for _k, _chars in enumerate(_CLASSES.values()):
    _TO_CLASS[list(_chars), _k + 1] = 1
_LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.,") | frozenset(range(128, 256))


def statistics(text: bytes) -> np.ndarray:
    """STATISTICS of one text; an empty text has zeros."""
    out = np.zeros(len(STATISTICS))
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    out[: _TO_CLASS.shape[1]] = counts @ _TO_CLASS / len(text)
    words = text.split()
    n = len(words)
    at = _TO_CLASS.shape[1]
    out[at] = np.log1p(len(text))
    out[at + 1] = np.log1p(n)
    if n:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
        out[at + 2] = np.log1p(lengths.mean())
        out[at + 3] = np.log1p(lengths.std())
        out[at + 4] = len(set(words)) / n
        out[at + 5] = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
        out[at + 6] = sum(x == y for x, y in zip(words, words[1:], strict=False)) / n
        out[at + 7] = sum(w[-1] in _LETTERS for w in words) / n
        lines = text.split(b"\n")
        out[at + 8] = len(set(lines)) / len(lines)
        out[at + 9] = np.log1p(n / len(lines))
    return out


def _of_texts(batch: pa.RecordBatch) -> np.ndarray:
    texts = batch.column("text").cast(pa.binary())
    return np.array([statistics(x.as_py() or b"") for x in texts]).reshape(-1, len(STATISTICS))


@released
def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _of_texts(batch)
        values = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(STATISTICS)).cast(pa.list_(pa.float64()))
        yield batch.drop_columns(["text"]).append_column("x", values)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with x, the statistics, in place of text."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.mapInArrow(_measured, f"{schema}, x array<double>")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    @staticmethod
    def directions() -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(SEED)
        width = np.sqrt(len(STATISTICS))
        return random.normal(size=(len(STATISTICS), FEATURES)) / width, random.uniform(0, 2 * np.pi, FEATURES)

    @classmethod
    def features(cls, x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        w, b = cls.directions()
        z = np.clip((x - mean) / scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ w + b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def isotonic(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The non-decreasing levels closest to good / total, weighted, by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for n, g in zip(total, good, strict=True):
        blocks.append([g, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), g / n) for g, n, k in blocks])


def fit(rows: DataFrame, scratch: Scratch) -> Model | None:
    """The model of labelled rows (doc_id, x, y); None if there are none.

    Rows whose crc32 of the doc_id's text leaves 4 modulo 5 are kept for calibration; if they or the others
    are fewer than 50, all rows serve both.
    """
    moments = rows.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    if not moments:
        return None
    mean, scale = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    for r in moments:
        mean[r["k"]], scale[r["k"]] = r["m"], max(r["s"] or 0.0, 1e-6)
    later = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 4
    kept, all_rows = rows.agg(F.count_if(later), F.count("*")).first()
    fitted, calibrated = (rows.where(~later), rows.where(later)) if min(kept, all_rows - kept) >= 50 else (rows, rows)

    size = FEATURES + 1

    @released
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in _blocks(batches):
            features = Model.features(_matrix(batch), mean, scale)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total += features.T @ np.column_stack([features, y])
        yield one_part(total.tobytes())

    # A matrix of half a megabyte for each partition of rows, added up a few at a time.
    found = combined(fitted.select("x", "y").mapInArrow(sums, PART), summed, scratch, "equations")
    total = np.frombuffer(found).reshape(size, size + 1)
    count = max(1.0, total[-1, size - 1])
    penalty = RIDGE * count * np.eye(size)
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(total[:, :size] + penalty, total[:, size])
    blank = Model(mean, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            at = np.clip((blank.raw(_matrix(batch)) + 0.5) * BINS / 2, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], ["bin", "y"])

    # A row a bin, BINS at most.
    found = calibrated.select("x", "y").mapInArrow(binned, "bin long, y double")
    found = sorted((r["bin"], r["n"], r["g"]) for r in found.groupBy("bin").agg(F.count("*").alias("n"), F.sum("y").alias("g")).collect())
    at, n, good = (np.array(c, dtype=float) for c in zip(*found, strict=True))
    return Model(mean, scale, weights, (at + 0.5) * 2 / BINS - 0.5, isotonic(n, good))


def held_out(doc_id: F.Column) -> F.Column:
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def quality_scores(docs: DataFrame, labels: DataFrame, keep_text: bool = False) -> DataFrame:
    """``docs`` with held_out, score and predicted, and without text unless ``keep_text``; clashing columns are replaced.

    Learns ``labels.quality`` (doc_id, quality) from rows that are not held out; a document with several
    labels counts with the largest. A NULL or empty text is scored like any other. A NULL doc_id is held out.
    Without labelled rows nothing speaks against a document: every score is 1. Empty tables give an empty
    result. With ``keep_text`` statistics are computed of labelled rows first, and of all rows with their score.
    """
    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "quality")
    docs = docs.drop("held_out", "score", "predicted", "x")
    known = None if keep_text else scratch.written(measured(docs), "statistics")
    marks = labels.where("quality is not null").groupBy(F.col("doc_id").alias("of")).agg(F.max("quality").cast("double").alias("y"))
    if keep_text:  # texts stay where they are unless labels are many
        marks = scratch.written(marks, "labels")
        marks = F.broadcast(marks) if marks.count() <= BROADCAST_LABELS else marks
        texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
        rows = measured(texts.join(marks, texts["doc_id"] == marks["of"]).select("doc_id", "text", "y"))
    else:
        rows = known.join(marks, known["doc_id"] == marks["of"]).where(~held_out(known["doc_id"]))
    model = fit(scratch.written(rows.select("doc_id", "x", "y"), "labelled"), scratch)

    @released
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            score = np.ones(batch.num_rows)
            if model is not None and batch.num_rows:
                score = model.score(_matrix(batch) if "x" in batch.schema.names else _of_texts(batch))
            rest = batch.drop_columns(["x"]) if "x" in batch.schema.names else batch
            yield rest.append_column("score", pa.array(score))

    source = docs if keep_text else known
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "x")
    out = source.mapInArrow(scored, f"{schema}, score double")
    return out.withColumn("held_out", held_out(F.col("doc_id"))).withColumn("predicted", (F.col("score") >= REJECT_BELOW).cast("int"))
