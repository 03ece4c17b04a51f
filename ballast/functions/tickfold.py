"""The fold of percentage ticks over sorted Arrow batches, run inside tasks.

Each tick depends on the price before it, yet no tick is a Python step of its own: runs of
ticks are cut into segments that are folded side by side, one numpy step for the n-th tick
of all of them. Where a segment opens is first estimated. Then every segment is folded from
a bracket of neighbouring openings at once, which gives it as a table from opening to
closing price, and the tables are chained. A price outside its bracket, or figures beyond
64 bits, are folded one by one instead; the result is the same.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Tasks get these functions by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Batches = Iterator[pa.RecordBatch]

LISTING = ["asset_id", "exch_code", "curr_code"]
CARRIED = [*LISTING, "event_id", "ts"]

# The first whole number of millionths, and the first percentage,
# that do not fit decimal(20,6).
PRICE_LIMIT = 10**20
VARIANCE_LIMIT = 10**14


def next_price(price: int, variance: int) -> int | None:
    """Price in millionths after one tick, half away from zero; None if the
    percentage or the result does not fit."""
    moved = price * (100 + variance)
    after = (abs(moved) + 50) // 100
    if after >= PRICE_LIMIT or abs(variance) >= VARIANCE_LIMIT:
        return None
    return after if moved >= 0 else -after


_WHOLE = pa.decimal128(38, 0)


def _runs(batch: pa.RecordBatch) -> list[int]:
    """Where a sorted batch changes to another listing, with both ends."""
    n = batch.num_rows
    changes: set[int] = set()
    for name in LISTING:
        column = batch.column(name)
        differs = pc.not_equal(column.slice(1), column.slice(0, n - 1))
        changes.update(pc.indices_nonzero(differs).to_pylist())
    return [0, *(i + 1 for i in sorted(changes)), n]


def _key(batch: pa.RecordBatch, row: int) -> tuple:
    return tuple(batch.column(name)[row].as_py() for name in LISTING)


class _TooLarge(Exception):
    """Figures may not fit 64 bits."""


# Openings on either side of the expected one that a piece or segment is folded from.
BRACKET = 64
WIDEST = 4096
SAFE = 1 << 62


def _steps(prices: np.ndarray, ticks: np.ndarray, trace: np.ndarray | None = None) -> np.ndarray:
    """Prices after all ``ticks``, a row per step and a column per segment; ``prices`` has
    a row per segment and may have a column per opening. ``trace`` takes the prices before
    each step."""
    limit = SAFE // (100 + int(np.abs(ticks).max(initial=0)))
    wide = prices.ndim > 1
    for n, variance in enumerate(ticks):
        if np.abs(prices).max(initial=0) > limit:
            raise _TooLarge
        if trace is not None:
            trace[n] = prices
        moved = prices * (100 + (variance[:, None] if wide else variance))
        after = (np.abs(moved) + 50) // 100
        prices = np.where(moved < 0, -after, after)
    return prices


def _closing(price: int, variances: list[int]) -> int:
    for variance in variances:
        moved = next_price(price, variance)
        price = price if moved is None else moved
    return price


class _Segments:
    """Ticks of several runs, cut into segments of one length; zeros fill up the last."""

    def __init__(self, sizes: np.ndarray, variances: np.ndarray):
        n = len(variances)
        self.length = max(1, int(min(sizes.max(initial=1), max(32, n**0.5))))
        self.counts = -(-sizes // self.length)
        self.first = np.cumsum(self.counts) - self.counts
        place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.row = np.repeat(self.first, sizes) + place // self.length
        self.column = place % self.length
        grid = np.zeros((int(self.counts.sum()), self.length), np.int64)
        grid[self.row, self.column] = variances
        self.grid, self.ticks = grid, np.ascontiguousarray(grid.T)

    def expected(self, openings: list[int]) -> np.ndarray:
        """About where each segment opens: by ratios first, corrected by one fold."""
        ratio = np.prod(1 + self.grid / 100, axis=1)
        starts = dict(zip(self.first.tolist(), openings))

        def chained(step) -> np.ndarray:
            out, price = [], 0
            for s in range(len(self.grid)):
                price = starts[s] if s in starts else step(s - 1, price)
                if not abs(price) < SAFE:
                    raise _TooLarge
                out.append(round(price))
                price = out[-1]
            return np.array(out, np.int64)

        about = chained(lambda s, price: price * ratio[s])
        closed = _steps(about, self.ticks)
        return chained(lambda s, price: int(closed[s]) + ratio[s] * (price - int(about[s])))

    def tables(self, expected: np.ndarray, width: int) -> np.ndarray:
        """Closing prices of each segment for the openings around the expected one."""
        return _steps(expected[:, None] + np.arange(-width, width + 1), self.ticks)

    def openings(self, given: list[int]) -> np.ndarray:
        """Where each segment opens, exactly."""
        if any(abs(price) >= SAFE for price in given):
            raise _TooLarge
        if (self.counts <= 1).all():
            return np.array(given, np.int64)[self.counts > 0]
        width = 8 + 2 * int(self.counts.max() ** 0.5)
        expected = self.expected(given)
        closings = self.tables(expected, width)
        starts = dict(zip(self.first.tolist(), given))
        out, price = [], 0
        for s in range(len(self.grid)):
            price = starts.get(s, price)
            out.append(price)
            at = price - int(expected[s]) + width
            if 0 <= at <= 2 * width:
                price = int(closings[s, at])
            else:
                price = _closing(price, self.grid[s].tolist())
        return np.array(out, np.int64)


def fold_runs(openings: list[int], sizes: np.ndarray, variances: np.ndarray) -> tuple[list, list, list]:
    """Prices before and after each tick, and each run's closing price. Ticks of a
    percentage or price that does not fit have no price after them."""
    try:
        bad = np.abs(variances) >= VARIANCE_LIMIT
        cut = _Segments(sizes, np.where(bad, 0, variances))
        trace = np.empty_like(cut.ticks)
        closed = _steps(cut.openings(openings), cut.ticks, trace)
        before = trace[cut.column, cut.row]
        after = np.vstack([trace[1:], closed])[cut.column, cut.row]
        ends = [int(closed[f + c - 1]) for f, c in zip(cut.first, cut.counts)]
        return before.tolist(), np.where(bad, None, after).tolist() if bad.any() else after.tolist(), ends
    except (_TooLarge, OverflowError):
        before, after, ends = [], [], []
        bounds = np.cumsum(sizes)
        for price, end, size in zip(openings, bounds.tolist(), sizes.tolist()):
            for variance in variances[end - size : end].tolist():
                before.append(price)
                moved = next_price(price, variance)
                after.append(moved)
                price = price if moved is None else moved
            ends.append(price)
        return before, after, ends


def _walk(batches: Batches, opening: int | None = None):
    """Fold sorted batches: yields (batch, before, after, last closing price).
    ``opening`` replaces the stored price for the partition's first listing."""
    key = price = None
    for batch in batches:
        if not batch.num_rows:
            continue
        runs = _runs(batch)
        openings = []
        for start in runs[:-1]:
            this = _key(batch, start)
            if this == key:
                openings.append(price)
                continue
            first, key = key is None, this
            stored = int(batch.column("opening")[start].as_py())
            openings.append(opening if first and opening is not None else stored)
        variances = batch.column("variance").to_numpy(zero_copy_only=False).astype(np.int64)
        before, after, ends = fold_runs(openings, np.diff(runs), variances)
        price = ends[-1]
        yield batch, before, after, price


def _whole(values: list) -> pa.Array:
    """Integers as decimals; by way of 64 bits where they fit, which is faster."""
    try:
        return pa.array(values, pa.int64()).cast(_WHOLE)
    except (pa.ArrowInvalid, OverflowError):
        return pa.array(values, _WHOLE)


def _result(batch: pa.RecordBatch, before: list, after: list) -> pa.RecordBatch:
    kept = [batch.column(name) for name in CARRIED]
    return pa.RecordBatch.from_arrays(
        [*kept, _whole(before), _whole(after)], names=[*CARRIED, "pre", "post"]
    )


def fold(batches: Batches) -> Batches:
    """All ticks of a partition, each listing from its stored price."""
    for batch, before, after, _ in _walk(batches):
        yield _result(batch, before, after)


def _piece(batches: Batches) -> tuple[int | None, Batches]:
    """The piece number of a partition and its non-empty batches."""
    full = (batch for batch in batches if batch.num_rows)
    head = next(full, None)
    if head is None:
        return None, iter(())

    def every() -> Batches:
        yield head
        yield from full

    return head.column("piece")[0].as_py(), every()


def map_run(prices: list[int | None], variances: np.ndarray) -> list[int | None]:
    """Where a run of ticks takes neighbouring prices, the middle one expected; none where
    a price leaves the bracket on the way. The middle one is always known."""
    middle = len(prices) // 2
    try:
        bad = np.abs(variances) >= VARIANCE_LIMIT
        cut = _Segments(np.array([len(variances)]), np.where(bad, 0, variances))
        if not abs(prices[middle]) < SAFE:
            raise _TooLarge
        expected = cut.expected([prices[middle]])
        known = np.array([p is not None for p in prices])
        now = np.array([p if p is not None else prices[middle] for p in prices], np.int64)
        # Neighbours drift apart as the price grows.
        reach = int(np.abs(now - now[middle]).max()) * np.abs(expected).max() / max(1, abs(prices[middle]))
        width = int(min(WIDEST, 1.5 * reach + 16 + 2 * len(expected) ** 0.5))
        closings = cut.tables(expected, width)
        for s in range(len(expected)):
            at = now - int(expected[s]) + width
            inside = (at >= 0) & (at <= 2 * width)
            kept = _closing(int(now[middle]), cut.grid[s].tolist()) if not inside[middle] else None
            now = closings[s, np.clip(at, 0, 2 * width)]
            known &= inside
            if kept is not None:
                now[middle], known[middle] = kept, True
        return [int(p) if k else None for p, k in zip(now, known)]
    except (_TooLarge, OverflowError):
        out: list[int | None] = [None] * len(prices)
        out[middle] = _closing(prices[middle], variances.tolist())
        return out


def piece_maps(expected: dict[int, int], bracket: int) -> Callable[[Batches], Batches]:
    """One row per piece: its first and last listing, the price stored for the first, the
    opening prices it was folded from (from ``low`` on, around the expected one) and the
    closing prices that its last listing has for each. The latter is one price where the
    last listing begins in the piece."""

    def run(batches: Batches) -> Batches:
        piece, full = _piece(batches)
        if piece is None:
            return
        first = last = stored = low = None
        prices: list[int | None] = []
        for batch in full:
            runs = _runs(batch)
            variances = batch.column("variance").to_numpy(zero_copy_only=False).astype(np.int64)
            for start, end in zip(runs, runs[1:]):
                this = _key(batch, start)
                if this != last:
                    opening = int(batch.column("opening")[start].as_py())
                    if first is None:
                        first, stored = this, opening
                        opening = expected.get(piece, opening)
                        low = opening - bracket
                        prices = list(range(low, opening + bracket + 1))
                    else:
                        prices = [opening]
                    last = this
                prices = map_run(prices, variances[start:end])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([piece], pa.int32()),
                pa.array([repr(first)]),
                pa.array([repr(last)]),
                pa.array([stored], _WHOLE),
                pa.array([low], _WHOLE),
                pa.array([prices], pa.list_(_WHOLE)),
            ],
            names=["piece", "first", "last", "stored", "low", "closings"],
        )

    return run


def fold_piece(opened: dict[int, int]) -> Callable[[Batches], Batches]:
    """The fold of a piece that opens at its agreed price."""

    def run(batches: Batches) -> Batches:
        piece, full = _piece(batches)
        for batch, before, after, _ in _walk(full, opened.get(piece)):
            yield _result(batch, before, after)

    return run


def fold_arrivals(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The ticks of one listing in a micro-batch, from the price kept as state;
    ``step`` counts them in the order they were applied. Ticks of a listing without a price
    come back without prices, and leave no state.

    A micro-batch is bounded by the stream's trigger options, so is this group.
    """
    ticks = pd.concat(list(frames), ignore_index=True).sort_values(["ts", "event_id"])
    if not state.exists and ticks["opening"].iloc[0] is None:
        none = pd.Series([None] * len(ticks), index=ticks.index, dtype=object)
        yield ticks[CARRIED].assign(pre=none, post=none, step=range(1, 1 + len(ticks)))
        return
    price, step = state.get if state.exists else (ticks["opening"].iloc[0], 0)
    variances = ticks["variance"].to_numpy().astype(np.int64)
    before, after, ends = fold_runs([int(price)], np.array([len(ticks)]), variances)
    steps = range(step + 1, step + 1 + len(ticks))
    state.update((str(ends[0]), step + len(ticks)))
    yield ticks[CARRIED].assign(
        pre=[Decimal(p) for p in before],
        post=[None if p is None else Decimal(p) for p in after],
        step=steps,
    )
