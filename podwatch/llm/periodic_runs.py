"""Maximal periodic runs of words, by a branching-tandem test on an enhanced suffix array.

For each LCP interval of depth q the suffixes of all children but the largest look up, by the inverse suffix
array, whether the suffix q words further or q words before lies in the same interval, in another child:
then the two are a square that cannot be moved one word to the right. Squares are rotated to the left as far as
words agree, which gives a run; several squares of one run fall together.

Texts of a block are told apart by their words' numbers and share one suffix array. A text longer than a
block is one by itself: its arrays need some 100 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from podwatch.llm.suffixes import Suffixes

LEAST_WORDS, LEAST_PERIODS = 6, 4
BLOCK_WORDS = 200_000
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def squares(index: Suffixes, starts: np.ndarray, ends: np.ndarray, periods: int) -> tuple[np.ndarray, np.ndarray]:
    """(place after the last word, period) of squares with ``periods`` periods before that place that do not move right.

    ``starts`` and ``ends`` give for every place the bounds of its text. Only intervals that could hold so many
    suffixes one period apart are looked at.
    """
    first, last, depth, borders = index.intervals(periods)
    none = np.empty(0, dtype=np.int64)
    if not len(first):
        return none, none
    room = depth * periods <= (ends - starts)[index.sa[first]]
    # Children: one from the first suffix of the interval, one from each border.
    owner = np.concatenate([np.arange(len(first)), borders[:, 0]])
    begin = np.concatenate([first, borders[:, 1]])
    order = np.argsort(owner * (len(index.sa) + 1) + begin)
    owner, begin = owner[order], begin[order]
    end = np.append(begin[1:], 0)
    closing = np.append(owner[1:] != owner[:-1], True)
    end[closing] = last[owner[closing]] + 1
    size = end - begin
    # The largest child is left out, the first of them if several are.
    by_size = np.lexsort((begin, -size, owner))
    largest = by_size[np.append(True, owner[by_size][1:] != owner[by_size][:-1])]
    looked = room[owner]
    looked[largest] = False
    owner, begin, size = owner[looked], begin[looked], size[looked]
    if not len(owner):
        return none, none
    total = np.cumsum(size)
    k = np.arange(total[-1]) - np.repeat(total - size, size) + np.repeat(begin, size)
    i, of = index.sa[k], np.repeat(owner, size)
    low, high, q = first[of], last[of], depth[of]

    def within(place: np.ndarray, which: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        rank = index.isa[np.where(which, place, 0)]
        return which & (rank >= low) & (rank <= high)

    found = []
    for left in (i, i - q):  # the suffix is the first half of a square, or the second
        right = left + q
        right_of = starts[i] <= left
        both = right_of & (right + q <= ends[i])
        hit = within(left, both, low, high) & within(np.minimum(right, len(index.isa) - 1), both, low, high)
        at = np.flatnonzero(hit)
        after, p = right[at], q[at]
        differs = index.symbols[after] != index.symbols[np.minimum(after + p, len(index.symbols) - 1)]
        at = at[differs]
        # As many periods before: each of them begins with the same words.
        for back in range(1, periods - 1):
            place = left[at] - back * q[at]
            at = at[within(place, place >= starts[i[at]], low[at], high[at])]
        found.append((left[at] + 2 * q[at], q[at]))
    end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    pairs = np.unique(np.stack([end, period], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _rotated(symbols: np.ndarray, start: int, end: int, period: int) -> int:
    """The first place of the run that ends before ``end``: as far left as words a period apart agree."""
    at, width = end - 2 * period, 256
    while at > start:
        low = max(start, at - width)
        apart = np.flatnonzero(symbols[low:at] != symbols[low + period : at + period])
        if len(apart):
            return low + int(apart[-1]) + 1
        at, width = low, width * 4
    return at


def runs_of(texts: list[np.ndarray], words: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, in that order. A text is an array of numbers, equal for equal words."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not lengths.sum():
        return out
    numbers = np.concatenate(texts)
    number = np.repeat(np.arange(len(texts)), lengths + 1)
    closes = np.cumsum(lengths + 1) - 1
    highest = int(numbers.max()) + 2
    symbols = np.zeros(len(number), dtype=np.int64)
    words_at = np.ones(len(number), dtype=bool)
    words_at[closes] = False
    symbols[words_at] = numbers + 1
    symbols += number * highest
    ends = closes[number]
    starts = ends - lengths[number]
    end, period = squares(Suffixes(symbols), starts, ends, periods)
    # Smallest period first; what a run explains as a multiple of its period goes with it.
    held: dict[int, list[tuple[int, int]]] = {}
    for e, q in zip(end.tolist(), period.tolist(), strict=True):
        inside = held.setdefault(e, [])
        if any(q % p == 0 and e - s >= 2 * q for s, p in inside):
            continue
        text = int(number[e - 1])
        first = int(starts[e - 1])
        s = _rotated(symbols, first, e, q)
        inside.append((s, q))
        if e - s >= max(words, periods * q):
            out[text].append((s - first, e - s, q))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([words[k] for k in np.flatnonzero(~gone)])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs``: its runs by start and period, and the text without repeats.

    A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, of at
    least LEAST_PERIODS periods and LEAST_WORDS words; words are what stands between ASCII white space, compared byte by byte.
    ``collapsed`` keeps of each run its first q words, unless another run drops them, and joins words by one space.
    Reads doc_id and text. A NULL or empty text has no words, no runs and an empty collapsed text. Rows that
    repeat a doc_id, or have none, are texts of their own. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text").cast(pa.binary())
            block: list[list[bytes]] = []
            held = begun = 0
            for row in range(batch.num_rows):
                words = (texts[row].as_py() or b"").split()
                if block and held + len(words) > BLOCK_WORDS:
                    yield emit(ids.slice(begun, len(block)), block)
                    block, held, begun = [], 0, row
                block.append(words)
                held += len(words)
            if block:
                yield emit(ids.slice(begun, len(block)), block)

    def emit(ids: pa.Array, block: list[list[bytes]]) -> pa.RecordBatch:
        known: dict[bytes, int] = {}
        number = known.setdefault
        found = runs_of([np.fromiter((number(w, len(known)) for w in words), dtype=np.int64, count=len(words)) for words in block])
        named = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
        columns = [
            ids,
            pa.array([len(words) for words in block], pa.int64()),
            pa.array(named, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
            pa.array([_kept(*x) for x in zip(block, found, strict=True)], pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    docs = docs.selectExpr("CAST(doc_id AS long) AS doc_id", "text")
    return docs.mapInArrow(run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")
