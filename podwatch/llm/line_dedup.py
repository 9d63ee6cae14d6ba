"""Removal of lines that many documents share, by probing a sharded minimal perfect hash.

1. Every document gives its distinct line keys as 128-bit hashes; they are counted with map-side sums, so
   a line of every document is one row a task.
2. Hashes that reach the document count are dealt to shards. A shard is a minimal perfect hash over its
   hashes with a fingerprint, a count and the keeping document for each. Rarer hashes can't lose a line,
   so the index leaves them out: a probe for one fails the fingerprint.
3. Probes (hash and doc_id only, no text) go to (shard, part) cells. A shard is copied to as many parts as
   its lines need, counted in step 1, so that a shard with a very common line is as even as the others.
4. What has to go comes back as one list a document; documents are read again and cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from podwatch.llm import perfect_hash
from podwatch.llm.memory import released
from podwatch.llm.minhash import mixed
from podwatch.llm.scratch import Scratch, bounded_batches, partitions

MIN_CHARS, MIN_DOCS = 40, 5
SHARD_KEYS = 65_536
MAX_SHARDS = 4_096  # bounds the driver's list of parts; shards grow beyond SHARD_KEYS after that
CELL_PROBES = 200_000
# Hashes to drop that are sent to every executor instead of shuffling the texts, some 100 MB there. Beyond, a join shuffles.
BROADCAST_HITS = 2_000_000


def _key(line: bytes) -> bytes | None:
    """The line's key if it is long enough: ``strip`` and ``lower`` of bytes know ASCII only."""
    key = line.strip().lower()
    if len(key) < MIN_CHARS or (not key.isascii() and len(key.decode()) < MIN_CHARS):
        return None
    return key


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Row number and 128-bit hash (two columns) of each distinct line key of each row with a doc_id."""
    rows, found = [], []
    texts = batch.column("text").cast(pa.binary())
    for i, (doc_id, text) in enumerate(zip(batch.column("doc_id"), texts, strict=True)):
        if doc_id.is_valid and text.is_valid:
            keys = {k for line in text.as_py().split(b"\n") if (k := _key(line)) is not None}
            found.extend(map(xxhash.xxh3_128_digest, keys))
            rows.append((i, len(keys)))
    at = np.repeat([r for r, _ in rows], [n for _, n in rows]).astype(np.int64) if rows else np.zeros(0, dtype=np.int64)
    return at, np.frombuffer(b"".join(found), dtype="<u8").reshape(-1, 2)


@released
def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, h = _hashed(batch)
        columns = [pa.array(h[:, 0].view(np.int64)), pa.array(h[:, 1].view(np.int64)), batch.column("doc_id").take(pa.array(at))]
        yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "doc_id"])


def _shard_of(h1: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(h1.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def _part_of(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    return (mixed(ids.astype(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)


def _built(shard: pd.DataFrame) -> pd.DataFrame:
    keys, which = np.unique(shard["h1"].to_numpy().view(np.uint64), return_inverse=True)
    sizes, bits, index = perfect_hash.build(keys)
    # Hashes that agree in h1 share a slot; a second table of them would be empty in practice, so all
    # their entries follow one another in ``order`` and ``starts`` says where a slot's entries begin.
    slot = index[which]
    order = np.argsort(slot, kind="stable")
    starts = np.searchsorted(slot[order], np.arange(len(keys) + 1))
    columns = {
        "sizes": sizes.tobytes(),
        "bits": bits.tobytes(),
        "starts": starts.astype(np.int64).tobytes(),
        "fingerprints": shard["h2"].to_numpy()[order].tobytes(),
        "counts": np.minimum(shard["docs"].to_numpy()[order], 2**32 - 1).astype(np.uint32).tobytes(),
        "keepers": shard["keeper"].to_numpy()[order].tobytes(),
    }
    return pd.DataFrame([{"shard": shard["shard"].iloc[0], "n": len(shard), "lines": int(shard["docs"].sum()), **columns}])


def _probed(probes: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    """The probes whose line has to go from their document."""
    if arrays.empty or probes.empty:
        return probes[["doc_id", "h1", "h2"]].iloc[:0]
    index = arrays.iloc[0]
    starts = np.frombuffer(index["starts"], dtype=np.int64)
    fingerprints = np.frombuffer(index["fingerprints"], dtype=np.int64)
    counts = np.frombuffer(index["counts"], dtype=np.uint32)
    keepers = np.frombuffer(index["keepers"], dtype=np.int64)
    h1, h2, ids = (probes[c].to_numpy() for c in ("h1", "h2", "doc_id"))
    slot = perfect_hash.lookup(
        h1.view(np.uint64), np.frombuffer(index["sizes"], dtype=np.int64), np.frombuffer(index["bits"], dtype=np.uint8)
    )
    goes = np.zeros(len(probes), dtype=bool)
    known = slot >= 0
    begin, end = np.where(known, starts[slot], 0), np.where(known, starts[slot + 1], 0)
    while (more := begin < end).any():
        at = begin[more]
        goes[more] |= (fingerprints[at] == h2[more]) & (counts[at] >= MIN_DOCS) & (keepers[at] != ids[more])
        begin = begin + 1
    return probes.loc[goes, ["doc_id", "h1", "h2"]]


@released
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, dropped, texts = [], [], []
        for text, gone in zip(batch.column("text").cast(pa.binary()), batch.column("gone"), strict=True):
            lines = (text.as_py() or b"").split(b"\n")
            kept = lines
            if gone.is_valid:
                drop = {(g["h1"], g["h2"]) for g in gone.as_py()}
                kept = [x for x in lines if (k := _key(x)) is None or tuple(np.frombuffer(xxhash.xxh3_128_digest(k), dtype="<i8").tolist()) not in drop]
            total.append(len(lines))
            dropped.append(len(lines) - len(kept))
            texts.append(b"\n".join(kept))
        columns = {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()), "kept_text": pa.array(texts, pa.binary()).cast(pa.string())}
        for name, column in columns.items():
            batch = batch.append_column(name, column)
        yield batch.drop_columns(["gone"])


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with n_lines, n_dropped and kept_text; columns of these names that were there are replaced.

    Lines are split at the line feed; a NULL or empty text is one empty line. Rows that repeat a doc_id are one
    document: a line counts once for them, and all of them keep what the largest doc_id keeps. A row with a NULL doc_id
    is not counted and loses nothing. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark, "line-dedup")
    docs = docs.drop("n_lines", "n_dropped", "kept_text", "gone")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lines = narrow.mapInArrow(_lines, "h1 long, h2 long, doc_id long")
    # Rows have each line once; documents too, unless rows repeat a doc_id.
    if not narrow.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        lines = lines.distinct()
    seen = Observation()
    counted = lines.groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper"))
    counted = counted.observe(seen, F.sum("docs").alias("lines"), F.sum(F.when(F.col("docs") >= MIN_DOCS, 1).otherwise(0)).alias("keys"))
    counted = scratch.written(counted.where(F.col("docs") >= MIN_DOCS), "counted")
    probes_all, keys = (seen.get[c] or 0 for c in ("lines", "keys"))

    shards = min(MAX_SHARDS, max(1, -(-keys // SHARD_KEYS)))
    index = counted.mapInPandas(lambda it: (x.assign(shard=_shard_of(x["h1"].to_numpy(), shards)) for x in it), "h1 long, h2 long, docs long, keeper long, shard long")
    index = index.groupBy("shard").applyInPandas(
        _built, "shard long, n long, lines long, sizes binary, bits binary, starts binary, fingerprints binary, counts binary, keepers binary"
    )
    index = scratch.written(index, "index")
    # A row a shard, MAX_SHARDS at most.
    held = {r["shard"]: r["lines"] for r in index.select("shard", "lines").collect()}
    least = -(-4 * partitions(spark) // shards)
    rare = probes_all / shards
    parts = np.array([max(least, int((held.get(s, 0) + rare) // CELL_PROBES) + 1) for s in range(shards)])

    @released
    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, h = _hashed(batch)
            ids = batch.column("doc_id").take(pa.array(at))
            s = _shard_of(h[:, 0], shards)
            p = _part_of(ids.to_numpy(zero_copy_only=False).astype(np.int64), parts[s])
            columns = [pa.array(s), pa.array(p), pa.array(h[:, 0].view(np.int64)), pa.array(h[:, 1].view(np.int64)), ids]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "part", "h1", "h2", "doc_id"])

    asked = narrow.mapInArrow(probes, "shard long, part long, h1 long, h2 long, doc_id long")
    copies = index.mapInPandas(
        lambda it: (x.loc[x.index.repeat(parts[x["shard"]])].assign(part=np.concatenate([np.arange(parts[s]) for s in x["shard"]])) for x in it if len(x)),
        f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in index.schema)}, part long",
    )
    gone = asked.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInPandas(_probed, "doc_id long, h1 long, h2 long")
    gone = gone.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("h1", "h2")).alias("gone"))
    gone = scratch.written(gone.withColumnRenamed("doc_id", "gone_id"), "gone")
    if (gone.agg(F.sum(F.size("gone"))).first()[0] or 0) <= BROADCAST_HITS:
        gone = F.broadcast(gone)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    both = docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left").drop("gone_id")
    return both.mapInArrow(_cut, f"{schema}, n_lines long, n_dropped long, kept_text string")
