"""Lempel-Ziv phrase fingerprints of documents and of their edited neighbours.

A text is parsed from left to right into the shortest phrases not yet in its dictionary. The set of phrases
is hashed; two texts that compress well together share many phrases. The fingerprint is a one-permutation
minimum-hash signature of the set with 8 bits a bin, in hexadecimal; likeness is the share of equal bins
less what chance makes equal. Equal texts have equal fingerprints. The empty text's is the empty string.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podwatch.llm.minhash import mixed, one_permutation
from podwatch.llm.scratch import partitions

BINS = 128
_CHANCE = 1 / 256


def _parse(text: str, phrases: set[str], phrase: str, log: list[str]) -> str:
    """Adds the new phrases of ``text``, which goes on after ``phrase``; returns the open last phrase."""
    for c in text:
        phrase += c
        if phrase not in phrases:
            phrases.add(phrase)
            log.append(phrase)
            phrase = ""
    return phrase


def _signature(phrases: list[str]) -> np.ndarray:
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, phrases), dtype=np.uint64, count=len(phrases))
    return (mixed(one_permutation(np.unique(hashes), BINS)) & np.uint64(255)).astype(np.uint8)


def _two(text: str, cut: int, tail: str) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of ``text`` and of ``text[:cut] + tail``; the common beginning is parsed once."""
    phrases: set[str] = set()
    head: list[str] = []
    phrase = _parse(text[:cut], phrases, "", head)
    ends = []
    for rest in (text[cut:], tail):
        more: list[str] = []
        open_ = _parse(rest, phrases, phrase, more)
        phrases.difference_update(more)
        # An open phrase is one that the dictionary already has, or nothing.
        ends.append(_signature(head + more) if head or more else np.zeros(0, dtype=np.uint8))
        del open_
    return ends[0], ends[1]


def likeness(x: np.ndarray, y: np.ndarray) -> float:
    """Estimated similarity of two phrase sets, 0 to 1; two empty texts are alike, an empty and another are not."""
    if not len(x) or not len(y):
        return float(len(x) == len(y))
    return float(max(0.0, (np.mean(x == y) - _CHANCE) / (1 - _CHANCE)))


def _edited(text: str, following: str) -> tuple[int, str]:
    k = len(text) // 3
    return len(text) - k, following[:k]


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _bucket_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, int | None, str]]:
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("bucket", "ghost", "doc_id", "text")), strict=True):
            bucket, ghost, doc_id, text = (x.as_py() for x in row)
            yield bucket, ghost, doc_id, text or ""


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    out: list[tuple] = []
    held = None  # the row before, waiting for its next document's signature

    def finish(own: np.ndarray) -> None:
        bucket, doc_id, text, signature, edited, sha = held
        out.append((doc_id, len(text), sha, signature.tobytes().hex(), edited.tobytes().hex(), likeness(signature, edited), likeness(signature, own)))

    rows = _bucket_runs(batches)
    current = next(rows, None)
    while current is not None:
        bucket, ghost, doc_id, text = current
        following = next(rows, None)
        if ghost:
            # The first document of the bucket after this one; only the first ghost is wanted.
            if held is not None:
                finish(_two(text, len(text), "")[0])
                held = None
        else:
            cut, tail = _edited(text, following[3] if following else text)
            own, edited = _two(text, cut, tail)
            if held is not None:
                finish(own)
            held = (bucket, doc_id, text, own, edited, hashlib.sha256((text[:cut] + tail).encode()).hexdigest())
        if len(out) >= 2000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
            out.clear()
        current = following
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The columns of SCHEMA for every row of ``docs``; reads doc_id and text.

    The next document is that of the next smaller doc_id, and after the smallest the largest. Rows that repeat
    a doc_id follow one another by text; rows without one come last, by text. A NULL text is empty. A single
    document is its own next. An empty table gives an empty result.

    There is no global sort into one task: doc_ids are cut into ranges at approximate quantiles, each range is
    sorted by itself, and the first document of every range is copied to the end of the one before. What the
    driver holds is one id for each range.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ids = docs.where("doc_id is not null")
    n = 4 * partitions(spark)
    bounds = sorted({int(x) for x in ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 1 / (4 * n))})

    def bucket_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Larger ids first: bucket 0 is above the last bound; rows without an id are the last bucket.
            at = [len(bounds) + 1 if x is None else len(bounds) - bisect_left(bounds, x) for x in batch.column("doc_id").to_pylist()]
            yield batch.append_column("bucket", pa.array(at, pa.int32()))

    named = ids.select("doc_id").mapInArrow(bucket_of, "doc_id long, bucket int")
    # One row a bucket, and there are at most n + 1.
    firsts = [(r["bucket"], r["first"]) for r in named.groupBy("bucket").agg(F.max("doc_id").alias("first")).collect()]
    if docs.where("doc_id is null").limit(1).count():
        firsts.append((len(bounds) + 1, None))
    firsts.sort()
    # The first document of each bucket is wanted at the end of the bucket before, the very first at the end of the last.
    before = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bucket_of(batches):
            ids = batch.column("doc_id").to_pylist()
            copies = [k for k, x in enumerate(ids) if x in before]
            yield batch.append_column("ghost", pa.array([False] * len(ids)))
            if copies:
                again = batch.take(pa.array(copies))
                to = pa.array([before[ids[k]] for k in copies], pa.int32())
                yield pa.RecordBatch.from_arrays([again.column(0), again.column(1), to, pa.array([True] * len(copies))], ["doc_id", "text", "bucket", "ghost"])

    rows = docs.mapInArrow(dealt, "doc_id long, text string, bucket int, ghost boolean")
    rows = rows.repartition(partitions(spark), "bucket")
    rows = rows.sortWithinPartitions("bucket", "ghost", F.col("doc_id").desc_nulls_last(), "text")
    return rows.mapInArrow(_fingerprinted, SCHEMA)
