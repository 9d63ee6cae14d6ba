"""Continuous detection: each poll's counts, once the watermark has passed the poll."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from podwatch import fixed_values as fv
from podwatch.operators.detect import over_threshold, swap_legs
from podwatch.rules import RULES, Rule

# Spark's windows hold their start and not their end, polls the other way round.
JUST_BEFORE = "INTERVAL '0.000001' SECOND"
MINUTE_US = 60_000_000
# Traders, and tokens, share state by hash in so many groups. Fixed for the life of a checkpoint.
GROUPS = 256
TRADER_COLUMNS = ("tick", "side_number", "hash_0", "hash_1")
PACKED_ROWS = 1_000_000
ENTRY_COLUMNS = ("poll", "side", "gap", "traders")


def instant_before(tick: int) -> datetime:
    """The event time of a poll given in microseconds."""
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=tick - 1)


def _count_columns(rules: Sequence[Rule]) -> list[str]:
    return [f"{side}_{i}" for i in range(len(rules)) for side in ("buy", "sell")]


def frame_of(rows: Iterator[Row], columns: Sequence[str]) -> pd.DataFrame:
    """Rows of a token and ``columns`` in one text."""
    found = [(row["token"], row["numbers"]) for row in rows]
    numbers = np.array(",".join(n for _, n in found).split(","), dtype=object).astype(np.int64)
    return pd.DataFrame(numbers.reshape(len(found), -1), columns=list(columns)).assign(token=[token for token, _ in found])


def rows_by_poll(ticks: np.ndarray, columns: Sequence[np.ndarray], row: Row) -> Iterator[Row]:
    """A row a poll, its event time and each column as an array: far fewer rows to hand over than one for each token."""
    order = np.argsort(ticks, kind="stable")
    ticks, columns = ticks[order], [c[order] for c in columns]
    ends = np.append(np.flatnonzero(np.diff(ticks)) + 1, len(ticks)).tolist() if len(ticks) else []
    for start, end in zip([0, *ends], ends, strict=False):
        yield row(instant_before(int(ticks[start])), *(c[start:end].tolist() for c in columns))


def unrolled(by_poll: DataFrame, *columns: str) -> DataFrame:
    """A row a token again; the event time keeps its watermark."""
    return by_poll.select("at", F.inline(F.arrays_zip(*columns)))


def text_of(values: pa.Array) -> tuple[memoryview, np.ndarray]:
    """Texts one after the other as bytes, and where each begins; the last ends at the last entry."""
    values = values.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64, count=len(values) + 1 + values.offset)[values.offset :]
    return memoryview(values.buffers()[2] or b""), offsets


def texts(lengths: np.ndarray, text: bytes) -> np.ndarray:
    """The texts again."""
    offsets = np.append(0, np.cumsum(lengths))
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(text)).to_numpy(zero_copy_only=False)


def packed(batches: Iterator[pa.RecordBatch], poll_us: int) -> Iterator[pa.RecordBatch]:
    """Legs as one row a group of traders and poll period: the newest event time, and numbers and tokens of the legs as bytes.

    Repeats of a trader inside a period are dropped. Legs are packed PACKED_ROWS at a time, so memory does not grow with a task.
    """
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= PACKED_ROWS:
            yield _packed(pa.Table.from_batches(held), poll_us)
            held, rows = [], 0
    if rows:
        yield _packed(pa.Table.from_batches(held), poll_us)


def _packed(legs: pa.Table, poll_us: int) -> pa.RecordBatch:
    at, side, hash_0, hash_1, group = (legs[c].to_numpy() for c in ("micros", *TRADER_COLUMNS[1:], "traders"))
    period = at // poll_us
    span = period.max() - period.min() + 1
    cell = group * span + period - period.min()
    order = np.lexsort((hash_1, hash_0, cell))
    cell, hash_0, hash_1 = cell[order], hash_0[order], hash_1[order]
    new_cell = np.append(True, cell[1:] != cell[:-1])
    new_trader = new_cell | np.append(True, (hash_0[1:] != hash_0[:-1]) | (hash_1[1:] != hash_1[:-1]))
    cells, kept = np.flatnonzero(new_cell), order[new_trader]
    text, offsets = text_of(pa.concat_arrays(legs["token"].cast(pa.large_binary()).take(pa.array(kept)).chunks))
    numbers = np.stack([side[kept], hash_0[new_trader], hash_1[new_trader], np.diff(offsets)], axis=1)
    starts = np.flatnonzero(new_cell[new_trader]).tolist()
    bounds = list(zip(starts, [*starts[1:], len(kept)], strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.maximum.reduceat(at[order], cells), pa.int64()),
            pa.array(group[order][cells], pa.int64()),
            pa.array([numbers[a:b].tobytes() for a, b in bounds], pa.binary()),
            pa.array([bytes(text[offsets[a] : offsets[b]]) for a, b in bounds], pa.binary()),
        ],
        names=["micros", "traders", "numbers", "tokens"],
    )


def unpacked(numbers: Sequence[bytes], tokens: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Legs that were packed: side, both halves of the hash as rows of numbers, and tokens."""
    found = np.frombuffer(b"".join(numbers), dtype=np.int64).reshape(-1, 4)
    return found[:, :3].T, texts(found[:, 3], b"".join(tokens))


class TraderChanges(StatefulProcessor):
    """What the traders of a group change in the counts of tokens, from the polls at which they swapped.

    State is one value a group: each trader's 128-bit hash and last such poll, as long as a window can hold them. At a poll a trader
    comes into every window that no longer held them, and is announced to leave it one length later; if they were still inside, the
    leaving announced before is taken back. A row is the changes of a token at one poll to come, so nothing ever has to be emitted by a
    timer; timers only end the state once the longest window has passed. State is asked for once a group and batch, not once a trader,
    as each call crosses to the JVM and back. ``TraderGaps`` says the same in one entry a swap, for streams of any size.
    """

    def __init__(self, lengths: Sequence[int], recent_us: int, poll_us: int, columns: Sequence[str]) -> None:
        self.lengths, self.recent_us, self.poll_us, self.columns = tuple(lengths), recent_us, poll_us, list(columns)
        self.row = Row("at", "token", "recent", *columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last_polls = handle.getValueState("last_polls", "traders binary")

    def _known(self) -> np.ndarray:
        """Rows: two halves of the hash, last poll."""
        known = self.last_polls.get()
        return np.frombuffer(known[0] if known else b"", dtype=np.int64).reshape(3, -1)

    def _remember(self, traders: np.ndarray, timer: bool) -> None:
        if traders.size:
            self.last_polls.update((traders.tobytes(),))
            if timer:
                self.handle.registerTimer(int(traders[2].max() + max(self.lengths)) // 1000)
        else:
            self.last_polls.clear()

    def _met(self, new: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each counted row: whether its trader is known, the last poll before, its own poll, its place in ``new``; the state then has them."""
        tick, side = new["tick"].to_numpy(np.int64), new["side_number"].to_numpy(np.int64)
        counted = np.flatnonzero(side >= 0)
        known = self._known()
        traders = np.hstack([known, np.stack([new["hash_0"].to_numpy(np.int64)[counted], new["hash_1"].to_numpy(np.int64)[counted], tick[counted]])])
        source = np.concatenate([np.full(known.shape[1], -1), counted])
        order = np.lexsort(traders[::-1])
        traders, source = traders[:, order], source[order]
        pairs = again_pairs(traders)
        again, final = np.append(False, pairs)[: len(source)], np.append(~pairs, True)[: len(source)]
        last = np.append(0, traders[2, :-1])[: len(source)]
        here = source >= 0

        # Later batches have later polls only, so no window of theirs reaches back to what goes here.
        kept = traders[:, final & (traders[2] + max(self.lengths) > tick.max())]
        if kept.size or known.size:
            self._remember(kept, timer=not known.size)
        return again[here], last[here], traders[2, here], source[here]

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        new = frame_of(rows, TRADER_COLUMNS)
        tick, side = new["tick"].to_numpy(np.int64), new["side_number"].to_numpy(np.int64)
        codes, tokens = pd.factorize(new["token"])
        again, last, now, source = self._met(new)

        # (token, poll, column, change) in parallel arrays; what makes a token recent has no column.
        events = [(codes, tick + later, None, 0) for later in range(0, self.recent_us, self.poll_us)]
        for i, length in enumerate(self.lengths):
            column = 2 * i + side[source]
            inside = again & (now - last < length)
            events += [(codes[source], np.where(inside, last + length, now), column, 1), (codes[source], now + length, column, -1)]
        polls = np.concatenate([at for _, at, _, _ in events]) // self.poll_us
        first, span = polls.min(), polls.max() - polls.min() + 1
        places, place_of = np.unique(np.concatenate([token for token, _, _, _ in events]) * span + polls - first, return_inverse=True)
        recent = np.zeros(len(places), dtype=bool)
        changes = np.zeros(len(places) * len(self.columns), dtype=np.int64)
        start = 0
        for token, _, column, change in events:
            place = place_of[start : start + len(token)]
            start += len(token)
            if column is None:
                recent[place] = True
            else:
                changes += change * np.bincount(place * len(self.columns) + column, minlength=len(changes))

        changes = changes.reshape(len(places), len(self.columns))
        told = recent | changes.any(axis=1)
        ticks = (places[told] % span + first) * self.poll_us
        yield from rows_by_poll(ticks, [np.asarray(tokens, dtype=object)[places[told] // span], recent[told], *changes[told].T], self.row)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        known = self._known()
        if known.size:
            self._remember(known[:, (known[2] + max(self.lengths)) // 1000 > expiredTimerInfo.getExpiryTimeInMs()], timer=True)
        yield from ()

    def close(self) -> None:
        pass


def again_pairs(traders: np.ndarray) -> np.ndarray:
    """Of sorted traders, whether each is followed by itself; one fewer than there are."""
    return (traders[:2, 1:] == traders[:2, :-1]).all(axis=0)


class TraderGaps(TraderChanges):
    """The traders of a group as ``TraderChanges``, a trader's swap as one entry: (token, poll, side, gap to their last poll before, traders).

    Gaps are in polls, 0 if no window holds the last poll. All that a swap changes at polls to come follows from its entry, so nothing is
    announced or taken back. Rows in hold a poll period of the group, rows out the entries of the batch for one group of tokens: rows are
    handed over one by one, so there must be few.
    """

    def __init__(self, lengths: Sequence[int], recent_us: int, poll_us: int, columns: Sequence[str]) -> None:
        super().__init__(lengths, recent_us, poll_us, columns)
        self.row = Row("at", "tokens", "numbers", "token")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        read = [(r["tick"], r["numbers"], r["token"]) for r in rows]
        legs, token = unpacked([x for _, cells, _ in read for x in cells], [x for _, _, cells in read for x in cells])
        new = pd.DataFrame(dict(zip(TRADER_COLUMNS[1:], legs, strict=True)))
        new["tick"] = np.repeat([tick for tick, _, _ in read], [sum(len(x) for x in cells) // 32 for _, cells, _ in read])
        codes, tokens = pd.factorize(token)
        again, last, now, source = self._met(new)
        gap = np.where(again & (now - last < max(self.lengths)), now - last, 0)
        first_time = ~again | (now > last)
        uncounted = np.flatnonzero(new["side_number"].to_numpy(np.int64) < 0)
        source = np.append(source[first_time], uncounted)
        gap = np.append(gap[first_time], np.zeros(len(uncounted), dtype=np.int64)) // self.poll_us
        poll, side = new["tick"].to_numpy(np.int64)[source] // self.poll_us, new["side_number"].to_numpy(np.int64)[source]

        first, gaps = poll.min(), max(self.lengths) // self.poll_us
        span = poll.max() - first + 1
        entries, traders = np.unique(((codes[source] * span + poll - first) * 3 + side + 1) * gaps + gap, return_counts=True)
        rest, gap = np.divmod(entries, gaps)
        rest, side = np.divmod(rest, 3)
        code, poll = np.divmod(rest, span)
        group = group_of(tokens)[code]
        order = np.argsort(group, kind="stable")
        group, code, poll = group[order], code[order], poll[order] + first
        text, offsets = text_of(pa.array(np.asarray(tokens, dtype=object)[code], pa.large_string()))
        numbers = np.stack([poll, side[order] - 1, gap[order], traders[order], np.diff(offsets)], axis=1)
        starts = np.flatnonzero(np.append(True, np.diff(group) != 0))
        newest = np.maximum.reduceat(poll, starts) * self.poll_us
        for a, b, at in zip(starts.tolist(), [*starts[1:].tolist(), len(group)], newest.tolist(), strict=True):
            yield self.row(instant_before(at), int(group[a]), numbers[a:b].tobytes(), bytes(text[offsets[a] : offsets[b]]))


def group_of(tokens: np.ndarray) -> np.ndarray:
    """The group whose state a token is in; the same in every process."""
    return (pd.util.hash_array(np.asarray(tokens, dtype=object), categorize=False) % GROUPS).astype(np.int64)


def events_until(places: np.ndarray, weights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each of ``at`` the weight of all places up to it."""
    order = np.argsort(places, kind="stable")
    return np.append(0, np.cumsum(weights[order]))[np.searchsorted(places[order], at, side="right")]


class RunningCounts(StatefulProcessor):
    """Counts of the tokens of a group at every closed poll at which they are recent and some rule counts enough.

    State is one value a group: the entries of traders as long as a window holds them, and the last poll that was told. Entries come with
    the poll that closes; a poll at which a token is recent without a swap of its own is told once it is closed too, by a timer if
    no other swap of the group comes. A trader's entry counts from its poll until a length after it; one with a gap takes the trader's entry
    before back where both would count.
    """

    def __init__(self, lengths: Sequence[int], thresholds: Sequence[int], recent_us: int, poll_us: int, columns: Sequence[str]) -> None:
        self.lengths, self.thresholds, self.columns = [n // poll_us for n in lengths], list(thresholds), list(columns)
        self.recent, self.poll_us = recent_us // poll_us, poll_us
        self.row = Row("at", "token", "tick", *columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.inside = handle.getValueState("inside", "entries binary, told bigint, timer bigint")

    def _set_timer(self, before: int | None, wanted: int | None) -> None:
        if before != wanted:
            if before is not None:
                self.handle.deleteTimer(before)
            if wanted is not None:
                self.handle.registerTimer(wanted)

    def _advance(self, rows: Iterator[Row], timerValues: object, expired: int | None) -> Iterator[Row]:
        closed = timerValues.getCurrentWatermarkInMs() * 1000 // self.poll_us
        known = self.inside.get()
        told, timer = known[1:] if known else (np.iinfo(np.int64).min, None)
        parts, named = [], []
        if known:
            table = pa.ipc.open_stream(known[0]).read_all().combine_chunks()
            held = table["token"].combine_chunks()
            named.append(held.dictionary.to_numpy(zero_copy_only=False))
            parts.append(np.stack([held.indices.to_numpy(), *(table[c].to_numpy() for c in ENTRY_COLUMNS)]).astype(np.int64))
        new = [(r["numbers"], r["token"]) for r in rows]
        if new:
            numbers = np.frombuffer(b"".join(n for n, _ in new), dtype=np.int64).reshape(-1, len(ENTRY_COLUMNS) + 1).T
            named.append(texts(numbers[-1], b"".join(t for _, t in new)))
            parts.append(np.vstack([np.zeros(numbers.shape[1], dtype=np.int64), numbers[:-1]]))
        if not parts:
            return
        # Tokens in the state differ from each other, so their codes are their places.
        codes, tokens = pd.factorize(np.concatenate(named))
        entries = np.hstack(parts)
        if new:
            entries[0, -len(named[-1]) :] = codes[len(codes) - len(named[-1]) :]

        later = np.concatenate([entries[:2] + [[0], [k]] for k in range(self.recent)], axis=1)
        later = later[:, later[1] > told]
        ready = later[:, later[1] <= closed]
        if ready.size:
            yield from self._told(entries, tokens, ready)

        kept = entries[:, entries[1] + max(self.lengths) > closed + 1]
        waiting = later[1][later[1] > closed]
        if not kept.size and not waiting.size:
            self._set_timer(None if timer == expired else timer, None)
            self.inside.clear()
            return
        if waiting.size and not kept.size:
            kept = entries[:, entries[1] + self.recent > closed + 1]
        # A timer ends just before or at its time; if just before, the poll itself is waited for.
        period = self.poll_us // 1000
        wanted = (int(waiting.min()) if waiting.size else int(kept[1].max()) + max(self.lengths)) * period - 1
        wanted += wanted == expired
        self._set_timer(None if timer == expired else timer, wanted)
        self.inside.update((self._written(kept, tokens), int(closed), wanted))

    def _written(self, entries: np.ndarray, tokens: np.ndarray) -> bytes:
        used, codes = np.unique(entries[0], return_inverse=True)
        token = pa.DictionaryArray.from_arrays(pa.array(codes, pa.int32()), pa.array(np.asarray(tokens, dtype=object)[used], pa.string()))
        table = pa.table([token, *(pa.array(e) for e in entries[1:])], names=["token", *ENTRY_COLUMNS])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return sink.getvalue().to_pybytes()

    def _told(self, entries: np.ndarray, tokens: np.ndarray, ready: np.ndarray) -> Iterator[Row]:
        code, poll, side, gap, traders = entries
        longest = max(self.lengths)
        first = min(poll.min(), ready[1].min()) - longest - 1
        span = max(poll.max(), ready[1].max()) + longest + 1 - first
        at = np.unique(ready[0] * span + ready[1] - first)
        own = code * span + poll - first
        counts = []
        for length in self.lengths:
            for k in (0, 1):
                mine = side == k
                places, weights = own[mine], traders[mine]
                inside = events_until(places, weights, at) - events_until(places, weights, at - length)
                twice = mine & (gap > 0) & (gap < length)
                if twice.any():
                    places, weights = own[twice], traders[twice]
                    inside -= events_until(places, weights, at) - events_until(places - gap[twice] + length, weights, at)
                counts.append(inside)
        over = np.zeros(len(at), dtype=bool)
        for i, threshold in enumerate(self.thresholds):
            over |= (counts[2 * i] > threshold) | (counts[2 * i + 1] > threshold)
        ticks = (at[over] % span + first) * self.poll_us
        yield from rows_by_poll(ticks, [np.asarray(tokens, dtype=object)[at[over] // span], ticks, *(n[over] for n in counts)], self.row)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        yield from self._advance(rows, timerValues, None)

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[Row]:
        yield from self._advance(iter(()), timerValues, expiredTimerInfo.getExpiryTimeInMs())

    def close(self) -> None:
        pass


def per_rule(rules: Sequence[Rule]) -> Column:
    """The counts of each rule as an array of rows."""
    return F.array(
        *(
            F.struct(
                F.lit(r.label).alias("time_interval"),
                F.col(f"buy_{i}").alias("num_users_bought"),
                F.col(f"sell_{i}").alias("num_users_sold"),
                F.lit(r.threshold).alias("threshold"),
            )
            for i, r in enumerate(rules)
        )
    )


def stream_candidates(
    swaps: DataFrame,
    lateness: str = "10 minutes",
    rules: Sequence[Rule] = RULES,
    recent_minutes: int = fv.RECENT_MINUTES,
    poll_minutes: int = fv.POLL_MINUTES,
) -> DataFrame:
    """Candidates (timestamp, token, time_interval, counts) of every closed poll, for append output.

    Four steps: swaps are packed by group of traders and poll period; periods wait until they are closed; each trader's last poll says how long before they swapped;
    these entries, added up per token and poll, give a token's counts. A trader is 24 bytes of state however long the
    windows are; state lies by hash in GROUPS values, the open periods too, and a batch reads and writes the values whose traders or tokens
    it has, so no swap is a row of the state store or of what is handed to Python. Every step but the
    last is spread over traders. Needs the RocksDB state store, numpy, pandas and pyarrow. Swaps later than ``lateness`` behind the newest are dropped.

    Watermarks need an instant, so timestamps come out as one.
    """
    if any(r.length_minutes % poll_minutes for r in rules) or recent_minutes % poll_minutes:
        raise ValueError("window lengths must be multiples of the poll period")
    columns = _count_columns(rules)
    lengths, recent_us, poll_us = [r.length_minutes * MINUTE_US for r in rules], recent_minutes * MINUTE_US, poll_minutes * MINUTE_US
    event_time = F.col("timestamp").cast("timestamp") - F.expr(JUST_BEFORE)
    legs = swap_legs(swaps.withColumn("timestamp", event_time).where("timestamp IS NOT NULL"))
    trader = [F.col(c) for c in ("token", "side", "user_address")]
    legs = legs.select(
        F.unix_micros("timestamp").alias("micros"), "token",
        F.when(F.col("side") == "buy", 0).when(F.col("side") == "sell", 1).otherwise(-1).cast("bigint").alias("side_number"),
        F.xxhash64(*trader).alias("hash_0"), F.xxhash64(F.lit(1), *trader).alias("hash_1"),
        F.pmod(F.xxhash64(F.lit(2), *trader), F.lit(GROUPS)).alias("traders"),
    )
    legs = legs.mapInArrow(lambda batches: packed(batches, poll_us), "micros bigint, traders bigint, numbers binary, tokens binary")
    legs = legs.select(F.timestamp_micros("micros").alias("timestamp"), "traders", "numbers", "tokens").withWatermark("timestamp", lateness)
    period = F.window("timestamp", f"{poll_minutes} minutes").alias("period")
    ticks = legs.groupBy(period, "traders").agg(F.collect_list(F.struct("numbers", "tokens")).alias("legs"))
    ticks = ticks.select(
        "traders", F.window_time("period").alias("at"), F.unix_micros("period.end").alias("tick"), F.col("legs.numbers").alias("numbers"), F.col("legs.tokens").alias("token")
    )
    gaps = ticks.groupBy("traders").transformWithState(
        statefulProcessor=TraderGaps(lengths, recent_us, poll_us, columns),
        outputStructType="at timestamp, tokens bigint, numbers binary, token binary",
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="at",
    )
    counts = gaps.groupBy("tokens").transformWithState(
        statefulProcessor=RunningCounts(lengths, [r.threshold for r in rules], recent_us, poll_us, columns),
        outputStructType=f"at timestamp, token array<string>, tick array<bigint>, {', '.join(f'{c} array<bigint>' for c in columns)}",
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="at",
    )
    counts = unrolled(counts, "token", "tick", *columns)
    found = counts.select("at", F.timestamp_micros("tick").alias("timestamp"), "token", F.inline(per_rule(rules)))
    return found.where(over_threshold()).drop("threshold")
