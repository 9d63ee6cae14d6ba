"""Near-duplicate groups of documents by one-permutation minimum hashing.

Signatures: one permutation of ``bins`` bins with optimal densification, ``rows`` bins to a band. A pair of
similarity J shares at least one band with probability 1 - (1 - J^rows)^(bins / rows): 0.999996 at 0.75 with
the defaults while bins are independent. Buckets give stars, not pairs: every member points to a centre. A
comparison first looks at sizes and sketches, then at the full shingle sets. Sets of fewer than SMALL
shingles have parity sketches, which refuse no link; larger sets have one-bit sketches, which refuse a pair at
0.75 with odds of about 5 in a million. A small and a large set go to the full sets without a look at sketches.

Every member of a bucket is compared with its centre, a document with each centre once. A bucket whose members
are not all in one component then is open, and members of different components still have to be compared. Most
of that is settled by the metric: 1 - J is a distance, so of two members, one linked with the centre (at most 0.25 from it)
and one far from it (over 0.5), neither can be a link. What is left are the members that are not linked with the
centre, among themselves, and those of them that are near it with the linked ones. These are compared by bits inside a
join on the bucket; nothing is capped, and only pairs that their bits do not refuse leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podwatch.llm.components import connected_components
from podwatch.llm.memory import released
from podwatch.llm.minhash import bands, mixed, multipliers, one_bit_sketch, one_permutation, parity_sketch
from podwatch.llm.scratch import Scratch

WORDS = 5
THRESHOLD = 75  # percent
BINS, ROWS = 384, 6
SKETCH_BINS = 1536
SKETCH = [f"s{i}" for i in range(SKETCH_BINS // 64)]
# Ids that are sent to every executor instead of shuffling the texts; some 100 MB there. Beyond, a join shuffles.
BROADCAST_IDS = 2_000_000
SMALL = 1024  # shingles; a parity sketch of fewer still tells sets apart that are not alike
# Bits in which two one-bit sketches may differ: the mean at the threshold and 4.5 standard deviations.
_UNLIKE = (1 - THRESHOLD / 100) / 2
SKETCH_BITS = int(SKETCH_BINS * _UNLIKE + 4.5 * (SKETCH_BINS * _UNLIKE * (1 - _UNLIKE)) ** 0.5)
# The same at twice the distance of the threshold: sets whose bits differ in more are further apart.
_FAR = 2 * _UNLIKE
FAR_BITS = int(SKETCH_BINS * _FAR + 4.5 * (SKETCH_BINS * _FAR * (1 - _FAR)) ** 0.5)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; ``bytes.lower`` and ``bytes.split`` are ASCII only."""
    tokens = text.lower().split()
    n = len(tokens)
    if not n:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=n)
    width = min(words, n)
    total = np.zeros(n - width + 1, dtype=np.uint64)
    for k, m in enumerate(multipliers(words)[:width]):
        total += mixed(hashes[k : n - width + 1 + k] + m) * m
    return np.unique(mixed(total + np.uint64(width)))


def sketch(found: np.ndarray) -> np.ndarray:
    if len(found) < SMALL:
        return parity_sketch(found, SKETCH_BINS)
    return one_bit_sketch(one_permutation(found, SKETCH_BINS))


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    for x in batch.column(name).cast(pa.binary()):
        yield x.as_py() or b""


@released
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, digests, keys, sketches = [], [], [], []
        for text in _texts(batch, "text"):
            found = shingles(text)
            n.append(len(found))
            if len(found):
                signature = one_permutation(found, BINS)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                keys.append(bands(signature, ROWS).view(np.int64))
                sketches.append(sketch(found))
            else:
                digests.append(None)
                keys.append(None)
                sketches.append(np.zeros(len(SKETCH), dtype=np.int64))
        columns = [
            batch.column("doc_id"),
            pa.array(n, pa.int64()),
            pa.array(digests, pa.binary()),
            pa.array(keys, pa.list_(pa.int64())),
            *(pa.array(c) for c in (np.array(sketches).T if n else np.zeros((len(SKETCH), 0), dtype=np.int64))),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "bands", *SKETCH])


@released
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(x).tobytes() for x in _texts(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "found"])


@released
def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("found_a"), batch.column("found_b"), strict=True):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            if len(x) > len(y):
                x, y = y, x
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            keep.append(100 * both >= THRESHOLD * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _apart(x: str, y: str) -> F.Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.col(f"{x}{s}").bitwiseXOR(F.col(f"{y}{s}"))) for s in SKETCH), F.lit(0))


def _alike(x: str, y: str) -> F.Column:
    """Sizes and sketches leave room for a link."""
    return _within(x, y, THRESHOLD, SKETCH_BITS)


def _near(x: str, y: str) -> F.Column:
    """Sizes and sketches leave room for at most twice the distance of a link."""
    return _within(x, y, 2 * THRESHOLD - 100, FAR_BITS)


def _within(x: str, y: str, percent: int, bits: int) -> F.Column:
    nx, ny = F.col(f"{x}n"), F.col(f"{y}n")
    # Sets of similarity T have at most (nx + ny) (1 - T) / (1 + T) shingles in one of them only.
    small = _apart(x, y) * (100 + percent) <= (nx + ny) * (100 - percent)
    room = F.when(F.greatest(nx, ny) < SMALL, small).when(F.least(nx, ny) >= SMALL, _apart(x, y) <= bits).otherwise(True)
    return (F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent) & room


def _named(df: DataFrame, prefix: str) -> list[F.Column]:
    return [F.col(c).alias(f"{prefix}{c}") for c in ("n", *SKETCH)]


def _confirm(docs: DataFrame, pairs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    ids = scratch.written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    found = docs.join(ids, "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, found binary")
    found = scratch.written(found, f"{name}-sets")
    both = pairs.join(found.select(F.col("doc_id").alias("a"), F.col("found").alias("found_a")), "a")
    both = both.join(found.select(F.col("doc_id").alias("b"), F.col("found").alias("found_b")), "b")
    links = both.select("a", "b", "found_a", "found_b").mapInArrow(_confirmed, "a long, b long")
    links = scratch.written(links.distinct(), f"{name}-confirmed")
    scratch.drop(f"{name}-sets")
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Reads doc_id and text; other columns may be there and are left alone. A text without words, empty or
    NULL, has no shingles and is in no group but its own. A NULL doc_id is linked with nothing, has a NULL
    component_id and is kept. Rows that repeat a doc_id are one document: a link of either holds for both.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kinds = ", ".join(f"{s} long" for s in SKETCH)
    signed = docs.mapInArrow(_signatures, f"doc_id long, n_shingles long, digest binary, bands array<long>, {kinds}")
    signed = scratch.written(signed.withColumn("row", F.monotonically_increasing_id()), "signed")

    # Equal sets first: one row of their smallest document stands for all of them.
    usable = signed.where("digest is not null and doc_id is not null")
    groups = usable.groupBy("digest").agg(F.min(F.struct("doc_id", "row")).alias("rep"), F.count("*").alias("copies"))
    groups = groups.where("copies > 1").select("digest", F.col("rep.doc_id").alias("rep"), F.col("rep.row").alias("rep_row"))
    copies = usable.select("doc_id", "digest", "row").join(groups, "digest")
    copies = scratch.written(copies.where("row <> rep_row").select("doc_id", "rep", "row"), "copies")
    unique = usable.join(copies.select("row"), "row", "left_anti")
    # A document with several texts has several rows in there.
    several = not unique.groupBy("doc_id").count().where("count > 1").isEmpty()
    sketches = unique.select("doc_id", F.col("n_shingles").alias("n"), *SKETCH)

    members = unique.select("doc_id", F.explode("bands").alias("key"))
    members = members.distinct() if several else members
    buckets = members.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last"), F.count("*").alias("size"))
    buckets = scratch.written(buckets.where("centre <> last"), "buckets")
    spokes = members.join(buckets.select("key", "centre"), "key").select("key", "doc_id", "centre")
    spokes = scratch.written(spokes, "spokes")
    left = sketches.select(F.col("doc_id").alias("a"), *_named(sketches, "x"))
    right = sketches.select(F.col("doc_id").alias("b"), *_named(sketches, "y"))
    stars = spokes.where("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = stars.join(left, "a").join(right, "b").where(_near("x", "y")).select("a", "b", _alike("x", "y").alias("alike"))
    # A document with several texts is near if one of them is.
    stars = scratch.written(stars.groupBy("a", "b").agg(F.max("alike").alias("alike")) if several else stars, "near")
    same = copies.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    linked = _confirm(docs, stars.where("alike").select("a", "b"), scratch, "stars")
    comps = scratch.written(connected_components(linked.union(same), scratch, "star"), "components-0")

    named = spokes.join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    named = scratch.written(named.withColumn("component", F.coalesce("component", "doc_id")), "memberships")
    unsettled = named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    # Of each membership: whether the document is linked with the centre, and if not, whether it is near it.
    how = stars.select("a", "b").join(linked.withColumn("linked", F.lit(True)), ["a", "b"], "left").withColumnsRenamed({"a": "centre", "b": "doc_id"})
    rest = named.join(unsettled, "key").join(how.withColumn("near", F.lit(True)), ["centre", "doc_id"], "left")
    is_centre = F.col("doc_id") == F.col("centre")
    rest = rest.select("key", "doc_id", "component", (is_centre | F.coalesce("linked", F.lit(False))).alias("linked"), F.coalesce("near", F.lit(False)).alias("near"))
    rest = scratch.written(rest, "open")
    full = rest.join(sketches, "doc_id")
    # A document with several texts keeps all of them apart from the metric.
    full = full.withColumn("linked", F.lit(False)) if several else full
    x = full.where("not linked").select("key", F.col("doc_id").alias("a"), F.col("component").alias("c"), "near", *_named(full, "x"))
    y = full.select("key", F.col("doc_id").alias("b"), F.col("component").alias("d"), F.col("linked").alias("by"), *_named(full, "y"))
    once = F.when(F.col("by"), F.col("near")).otherwise(F.col("a") < F.col("b"))
    pairs = x.join(y, "key").where((F.col("c") != F.col("d")) & once & _alike("x", "y"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = scratch.written(pairs.join(stars.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    if not pairs.isEmpty():
        comps = _joined(comps, _confirm(docs, pairs, scratch, "open"), scratch)

    named = signed.select("doc_id", "n_shingles").join(comps.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    named = named.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return named.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def _joined(comps: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """The components after more links: links between components are solved, then every node is renamed."""
    of_a = comps.select(F.col("node").alias("a"), F.col("component").alias("x"))
    of_b = comps.select(F.col("node").alias("b"), F.col("component").alias("y"))
    found = links.join(of_a, "a", "left").join(of_b, "b", "left")
    between = found.select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    renamed = connected_components(between, scratch, "open").select("node", F.col("component").alias("new"))
    nodes = comps.join(renamed.withColumnRenamed("node", "component"), "component", "left")
    nodes = nodes.select("node", F.coalesce("new", "component").alias("component"))
    single = renamed.join(comps, "node", "left_anti").select("node", F.col("new").alias("component"))
    return scratch.written(nodes.union(single), "components-1")
