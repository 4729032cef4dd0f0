"""Periodic runs of words by an enhanced suffix array and the branching-tandem test.

A run is a stretch of consecutive words whose smallest period is ``q`` words, of at least
``least_words`` and at least ``least_periods * q`` words, that no neighbouring word extends.

Many texts are indexed at once; a word's symbol carries its text, so nothing is ever shared
between texts. Suffixes are ranked by prefix doubling, at each step only those that are not
alone in their rank. The ranks of all steps give the longest common extension of any two
places, and with it the LCP array. An LCP interval of depth ``d`` is known by its bounds in the
array, found by pointer jumping to the nearest smaller values; no tree is built. Of every
interval the suffixes of all children but the largest are tested: a suffix at ``i`` with
``ISA[i + d]`` or ``ISA[i - d]`` inside the interval, but outside its own child, is one half of
a square of period ``d`` that cannot be rotated to the right. Such squares are rotated to the left
as far as they go, by common extensions backwards, and become runs; of stretches alike the
least period is the true one, since the others are its multiples.

Words are compared by 64-bit hashes. A text is worked on as a whole by one task: about 300 bytes
of memory a word, and four more for every doubling that its longest repeat asks for.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.store import extended
from folioflow.llm.words import WordHasher, slices

LEAST_WORDS, LEAST_PERIODS = 24, 3
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FIELDS = "runs array<struct<start:bigint,length:bigint,period:bigint>>, strongest struct<start:bigint,length:bigint,period:bigint>, collapsed string"


def ranks(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array and, per step k, every place's rank by its first 2^k symbols.

    Equal ranks mean equal symbols; the rank is the first index of the group. A suffix that
    ends early ranks before all that go on. The last ranks are the inverse suffix array.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    head = np.concatenate([[True], sorted_symbols[1:] != sorted_symbols[:-1]])
    groups = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = groups
    steps, width = [rank], 1
    while True:
        head = np.concatenate([head, [True]])
        active = np.flatnonzero(~(head[:-1] & head[1:]))  # slots of groups of several
        head = head[:-1]
        if not len(active):
            return order, steps
        places = order[active]
        ahead = places + width
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        sort = np.lexsort((second, rank[places]))
        places, second = places[sort], second[sort]
        first = rank[places]
        order[active] = places
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        head = head.copy()
        head[active] = new
        rank = rank.copy()
        rank[places] = np.maximum.accumulate(np.where(new, active, 0))
        steps.append(rank)
        width *= 2


def extension(steps: list[np.ndarray], left: np.ndarray, right: np.ndarray, forwards: bool) -> np.ndarray:
    """How many symbols two places have in common, from them on or just before them."""
    n = len(steps[0])
    left, right, length = left.copy(), right.copy(), np.zeros(len(left), np.int64)
    live = np.arange(len(left))
    for k in range(len(steps) - 1, -1, -1):
        size = 1 << k
        a, b = (left, right) if forwards else (left - size, right - size)
        room = (np.maximum(a, b) < n) & (np.minimum(a, b) >= 0)
        live = np.flatnonzero(room)
        same = live[steps[k][a[live]] == steps[k][b[live]]]
        move = size if forwards else -size
        left[same] += move
        right[same] += move
        length[same] += size
    return length


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """For each index the last one before it with a smaller value; index 0 holds the least."""
    pointer = np.arange(len(values)) - 1
    pointer[0] = 0
    open_ = np.flatnonzero(values[pointer] >= values)
    open_ = open_[open_ > 0]
    while len(open_):
        pointer[open_] = pointer[pointer[open_]]
        open_ = open_[values[pointer[open_]] >= values[open_]]
    return pointer


def tandems(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Start and half length of every square that no rotation to the right continues, and the ranks."""
    n = len(symbols)
    order, steps = ranks(symbols)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none, steps
    inverse = steps[-1]
    near = np.flatnonzero(steps[0][order[1:]] == steps[0][order[:-1]]) + 1
    lcp = np.zeros(n + 1, np.int64)
    lcp[0] = lcp[n] = -1
    lcp[near] = extension(steps, order[near - 1], order[near], True)
    low = nearest_smaller(lcp[:n])[near]
    high = n - nearest_smaller(lcp[:0:-1])[n - near]  # one beyond the interval
    # one row a child: children of an interval lie between its least values
    sort = np.lexsort((near, lcp[near], low))
    cut, low, high, depth = near[sort], low[sort], high[sort], lcp[near][sort]
    first = np.concatenate([[True], (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])]) if len(cut) else np.zeros(0, bool)
    begin = np.concatenate([low[first], cut])
    own = np.concatenate([np.flatnonzero(first), np.arange(len(cut))])  # the row whose interval it is
    last = np.concatenate([first[1:], [True]]) if len(cut) else first
    end = np.concatenate([cut[first], np.where(last, high, np.concatenate([cut[1:], [0]]) if len(cut) else cut)])
    interval = np.cumsum(first)[own]
    size = end - begin
    biggest = np.lexsort((begin, -size, interval))
    skip = biggest[np.concatenate([[True], interval[biggest][1:] != interval[biggest][:-1]])] if len(cut) else biggest
    small = np.ones(len(begin), bool)
    small[skip] = False
    begin, end, own, size = begin[small], end[small], own[small], size[small]
    child = np.repeat(np.arange(len(begin)), size)
    slot = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + begin[child]
    place, d = order[slot], depth[own][child]
    found = []
    for other, start in ((place + d, place), (place - d, place - d)):
        ok = np.flatnonzero((other >= 0) & (other < n))
        at = inverse[other[ok]]
        row = child[ok]
        inside = (at >= low[own][row]) & (at < high[own][row]) & ~((at >= begin[row]) & (at < end[row]))
        found.append((start[ok][inside], d[ok][inside]))
    return np.concatenate([found[0][0], found[1][0]]), np.concatenate([found[0][1], found[1][1]]), steps


def periodic_runs(symbols: np.ndarray, least_words: int, least_periods: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, by start, then period."""
    start, period, steps = tandems(symbols)
    end = start + 2 * period
    start = start - extension(steps, start, start + period, False)
    keep = (end - start >= least_words) & (end - start >= least_periods * period)
    start, end, period = start[keep], end[keep], period[keep]
    # a stretch found by multiples of its period is found by the period as well
    sort = np.lexsort((period, end, start))
    start, end, period = start[sort], end[sort], period[sort]
    new = np.concatenate([[True], (start[1:] != start[:-1]) | (end[1:] != end[:-1])])[:len(start)]
    start, end, period = start[new], end[new], period[new]
    sort = np.lexsort((period, start))
    return start[sort], end[sort], period[sort]


def marked(texts: pa.Array, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[pa.Array]:
    """Runs, the strongest run and the collapsed text of every text."""
    hasher = WordHasher()
    runs, strongest, collapsed = [], [], []
    for _, _, data, bounds in slices(texts):
        starts, ends, words = hasher.spans(data, bounds)
        hashes = hasher.hashes(data, starts, ends)
        count = len(words) - 1
        text = np.repeat(np.arange(count), np.diff(words))
        sort = np.lexsort((hashes, text))
        fresh = np.concatenate([[True], (hashes[sort][1:] != hashes[sort][:-1]) | (text[sort][1:] != text[sort][:-1])])[:len(sort)]
        symbols = np.empty(len(sort), np.int64)
        symbols[sort] = np.cumsum(fresh)
        start, end, period = periodic_runs(symbols, least_words, least_periods)
        change = np.zeros(len(starts) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        kept = np.cumsum(change)[:-1] == 0
        at = np.searchsorted(start, words)
        raw = data.tobytes()
        for row in range(count):
            first = int(words[row])
            own = [
                {"start": s - first, "length": e - s, "period": q}
                for s, e, q in zip(*(x[at[row]:at[row + 1]].tolist() for x in (start, end, period)), strict=True)
            ]
            runs.append(own)
            strongest.append(max(own, key=lambda r: (Fraction(r["length"], r["period"]), -r["start"], -r["period"]), default=None))
            some = np.flatnonzero(kept[first:words[row + 1]]) + first
            collapsed.append(b" ".join([raw[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist(), strict=True)]).decode("utf-8", "replace"))
    return [pa.array(runs, pa.list_(RUN)), pa.array(strongest, RUN), pa.array(collapsed, pa.string())]


def find_runs(rows: DataFrame, text: str, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> DataFrame:
    """All rows with their text's ``runs`` (by start, then period), ``strongest`` and ``collapsed``.

    ``strongest`` is the run of most periods (the earliest, then of the least period, among
    equal ones), NULL without runs. ``collapsed`` joins by single spaces the words that no run
    holds beyond its first period. NULL and blank texts have no runs and collapse to an empty
    text. Columns of the same names are replaced. No shuffle; a row is worked on by itself.
    """
    plain = rows.drop("runs", "strongest", "collapsed").drop(text)
    names = plain.columns

    def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            yield pa.RecordBatch.from_arrays(
                [*(batch[k] for k in range(len(names))), *marked(batch[len(names)], least_words, least_periods)],
                names=[*names, "runs", "strongest", "collapsed"],
            )

    return rows.select(*names, F.col(text).alias("_text")).mapInArrow(batches, extended(plain.schema, FIELDS))


def run_digest(runs: Column) -> Column:
    """SHA-256 of ``start,length,period`` and a line feed for every run, in order."""
    line = F.transform(runs, lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size(runs) > 0, "\n").otherwise("")).cast("binary"), 256)
