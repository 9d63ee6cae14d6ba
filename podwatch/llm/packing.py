"""Packing of tokenised documents into sequences of several context sizes.

A document goes to the smallest context size (tier) that holds it; what exceeds the largest is cut into whole
windows first. Tiers are packed from the largest down. A sequence takes the longest waiting document, then
the longest shorter ones that still fit, and closes its last gap with a cut of the shortest that is
longer than the gap; the rest of that one waits on. So every sequence is full but the last of a partition,
and its tokens become sequences of smaller powers of two, which need no padding either. Sequences of a tier are dealt
to step groups of equal tokens by falling attention cost, back and forth.

A partition packs its own documents in blocks of bounded size, and what a block leaves waits for the next,
so nothing is shuffled and a lost task is repeated alone, with the same result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from podwatch.llm.memory import released
from podwatch.llm.scratch import bounded_batches
from podwatch.llm.tokens import SLICE_CHARS, added_tokens, byte_level_slices, id_pieces, ids_of_slices

TIERS = (128, 256, 512, 1024)
END_ID = 0
STEP_TOKENS = 16_384
BLOCK_TOKENS = 2_000_000
HELD_CHARS = 1 << 20  # of text whose pieces are looked up at a time
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

Piece = tuple[int, int, int]  # document of the block, first token, tokens


class Pool:
    """Waiting pieces by length; the lengths that are there are the bits of one integer."""

    def __init__(self) -> None:
        self.stacks: dict[int, list[Piece]] = defaultdict(list)
        self.there = 0

    def put(self, piece: Piece) -> None:
        if piece[2]:
            self.stacks[piece[2]].append(piece)
            self.there |= 1 << piece[2]

    def take(self, length: int) -> Piece:
        stack = self.stacks[length]
        piece = stack.pop()
        if not stack:
            self.there &= ~(1 << length)
        return piece

    def longest(self, most: int) -> int:
        """The largest length up to ``most``, 0 if none."""
        return max(0, (self.there & ((2 << most) - 1)).bit_length() - 1)

    def shortest_over(self, length: int) -> int:
        over = self.there >> (length + 1)
        return length + (over & -over).bit_length() if over else 0


def pack(pool: Pool, tiers: tuple[int, ...]) -> tuple[list[tuple[int, list[Piece]]], list[Piece]]:
    """Full sequences as (tier, pieces), and the pieces of the one that stayed short."""
    sequences = []
    for tier in reversed(tiers):
        below = max((t for t in tiers if t < tier), default=0)
        while (length := pool.longest(tier)) > below:
            sequence, gap = [pool.take(length)], tier - length
            while gap:
                if length := pool.longest(gap):
                    sequence.append(pool.take(length))
                    gap -= length
                elif length := pool.shortest_over(gap):
                    doc, start, length = pool.take(length)
                    sequence.append((doc, start, gap))
                    pool.put((doc, start + gap, length - gap))
                    gap = 0
                else:
                    return sequences, sequence
            sequences.append((tier, sequence))
    return sequences, []


def _powers(pieces: list[Piece]) -> list[tuple[int, list[Piece]]]:
    """The pieces, in order, as sequences whose sizes are falling powers of two."""
    total, out, waiting = sum(p[2] for p in pieces), [], list(reversed(pieces))
    while total:
        size = 1 << (total.bit_length() - 1)
        sequence, gap = [], size
        while gap:
            doc, start, length = waiting.pop()
            used = min(gap, length)
            sequence.append((doc, start, used))
            if used < length:
                waiting.append((doc, start + used, length - used))
            gap -= used
        out.append((size, sequence))
        total -= size
    return out


def _groups(sequences: list[tuple[int, list[Piece]]], first: int) -> tuple[list[int], int]:
    """Step group of each sequence, and the next free number."""
    by_size, out = defaultdict(list), [0] * len(sequences)
    for k, (size, _) in enumerate(sequences):
        by_size[size].append(k)
    for size, members in by_size.items():
        members.sort(key=lambda k: (-sum(p[2] ** 2 for p in sequences[k][1]), k))
        n = -(-len(members) * size // STEP_TOKENS)
        for at, k in enumerate(members):
            turn, place = divmod(at, n)
            out[k] = first + (n - 1 - place if turn % 2 else place)
        first += n
    return out, first


def _tokenised(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """Ids of each text in order; some HELD_CHARS of text are in pieces at a time, also of one long text."""
    known, added = id_pieces(path), added_tokens(path)
    end = np.array([END_ID], dtype="<u4")

    def encoded(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        """(row, ids of a part of its text); a row has one part at least."""
        rows: list[int] = []
        waiting: list[str | list[str | bytes]] = []
        held = 0
        for row, text in enumerate(batch.column("text")):
            text = text.as_py() or ""
            for part in byte_level_slices(text, added):
                rows.append(row)
                waiting.append(part)
                held += min(len(text), SLICE_CHARS)
                if held >= HELD_CHARS:
                    yield from zip(rows, ids_of_slices(known, waiting), strict=True)
                    rows, waiting, held = [], [], 0
        yield from zip(rows, ids_of_slices(known, waiting), strict=True)

    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        for row, parts in groupby(encoded(batch), key=itemgetter(0)):
            yield ids[row], np.concatenate([*(part for _, part in parts), end])


def packed(docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset, tier, step_group.

    A document's tokens are its text's ids and END_ID; a NULL or empty text is END_ID alone. Reads doc_id and
    text only. Rows that repeat a doc_id, or have none, are documents of their own. ``tiers`` are powers of
    two. ``tokenizer_path`` is the file of a byte-level tokenizer, readable on every executor. An empty
    table gives an empty result. ``sequence_id`` and ``step_group`` carry the partition in their high bits.
    """
    largest = tiers[-1]

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high = TaskContext.get().partitionId() << 32
        pool, docs_of, held = Pool(), [], 0
        next_sequence = next_group = 0

        def emit(sequences: list[tuple[int, list[Piece]]]) -> pa.RecordBatch:
            nonlocal next_sequence, next_group
            groups, next_group = _groups(sequences, next_group)
            rows = []
            for (size, pieces), group in zip(sequences, groups, strict=True):
                offset = 0
                for doc, start, length in pieces:
                    doc_id, ids = docs_of[doc]
                    rows.append((doc_id, start, length, ids[start : start + length].tobytes(), len(ids), high + next_sequence, offset, size, high + group))
                    offset += length
                next_sequence += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SCHEMA.split(", ")])

        windows: list[tuple[int, list[Piece]]] = []
        for doc_id, ids in _tokenised(batches, tokenizer_path):
            docs_of.append((doc_id, ids))
            whole = len(ids) // largest * largest
            windows += [(largest, [(len(docs_of) - 1, s, largest)]) for s in range(0, whole, largest)]
            pool.put((len(docs_of) - 1, whole, len(ids) - whole))
            held += len(ids)
            if held >= BLOCK_TOKENS:
                full, short = pack(pool, tiers)
                yield emit(windows + full)
                # Only the documents of the short sequence wait on.
                docs_of = [docs_of[p[0]] for p in short]
                pool, windows, held = Pool(), [], 0
                for k, (_, start, length) in enumerate(short):
                    pool.put((k, start, length))
        full, short = pack(pool, tiers)
        if windows or full or short:
            yield emit(windows + full + _powers(short))

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
