"""Periodic runs: stretches of words that repeat themselves at least three times.

A run is a maximal stretch of consecutive words with smallest period q and a
length of at least ``max(24, 3 * q)``. Short periods are found by comparing
the words with themselves at each lag. For longer ones there is a row of scales.
A scale covers the periods of (w, 1.25 * w]; it hashes all stretches of g = 1.25 * w
words and takes the minimum of every window of 0.75 * w of them.

- A stretch as long as a period occurs in a run at distances of whole periods
  only, as its period is the smallest: the next equal one is one period away.
- A window and the one a period later have equal stretches, so their minima are
  one period apart. Both lie in the run, as 0.75 * w + 1.25 * w + q is less than 3 * q.

So two minima of equal hash, neighbours among all of that hash, at a distance
that the scale covers, are a seed of every run. A seed is extended word by word to both sides, which
is also the proof: hashes that collide give no run. Equal stretches always
have equal hashes, so none is missed.

Texts are independent: a task works on its own rows, about a million characters
at a time, with arrays of a few numbers a word; scales only look at the texts that
are long enough for three of their periods.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, slices

SHORTEST = 24
REPEATS = 3
#: Periods up to this are found by direct comparison at each lag.
LAGS = 12
#: Each scale covers periods up to this many times the last one's.
RATIO = 1.25

RUN = "struct<start:long,length:long,period:long>"
Run = tuple[int, int, int]  # start, period, length


def least(period: int) -> int:
    return max(SHORTEST, REPEATS * period)


def _primitive(ids: np.ndarray, start: int, period: int) -> bool:
    """Whether a run of the period has no smaller one (a smaller one would divide it)."""
    rest, factor = period, 2
    while rest > 1:
        if factor * factor > rest:
            factor = rest
        if rest % factor == 0:
            small = period // factor
            if (ids[start: start + period - small] == ids[start + small: start + period]).all():
                return False
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return True


def _short(ids: np.ndarray) -> Iterator[Run]:
    """Runs of periods up to :data:`LAGS`: long stretches of words equal to the ones a lag later."""
    for period in range(1, min(LAGS, len(ids) // REPEATS) + 1):
        breaks = np.flatnonzero(ids[:-period] != ids[period:])
        edges = np.concatenate(([-1], breaks, [len(ids) - period]))
        equal = np.diff(edges) - 1
        for at in np.flatnonzero(equal >= least(period) - period):
            start = int(edges[at]) + 1
            if _primitive(ids, start, period):
                yield start, period, int(equal[at]) + period


def _matched(left: np.ndarray, right: np.ndarray) -> int:
    """How many elements agree from the start, looked for in steps that double."""
    most, done, step = min(len(left), len(right)), 0, 64
    while done < most:
        end = min(done + step, most)
        bad = left[done:end] != right[done:end]
        if bad.any():
            return done + int(bad.argmax())
        done, step = end, 2 * step
    return most


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    both = left * np.uint64(0x9E3779B97F4A7C15) + right
    return both ^ (both >> np.uint64(32))


def _stretches(powers: dict[int, np.ndarray], n: int, length: int) -> np.ndarray:
    """A hash of each stretch of ``length`` of the first ``n`` words, put together of stretches of powers of two."""
    out, covered, k = None, 0, 1
    while k <= length:
        if k not in powers:
            half = powers[k // 2]
            powers[k] = _joined(half[: len(half) - k // 2], half[k // 2:])
        if length & k:
            held = n - covered - k + 1
            part = powers[k][covered: covered + held]
            out = part if out is None else _joined(out[:held], part)
            covered += k
        k *= 2
    return out


def _minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Places of the leftmost minimum of every window, each once."""
    best, at, width = hashes.copy(), np.arange(len(hashes)), 1
    while width < window:
        step = min(width, window - width)
        n = len(best) - step
        later = best[step:] < best[:n]
        at = np.where(later, at[step:], at[:n])
        best = np.where(later, best[step:], best[:n])
        width += step
    return np.unique(at)


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Numbers of words spread over 64 bits."""
    z = ids.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(27))


def _long(ids: np.ndarray, reach: np.ndarray) -> Iterator[Run]:
    """Runs of periods beyond :data:`LAGS`, one scale after another; ``reach[n]`` words hold all texts of n words and more."""
    powers = {1: _mixed(ids)}
    low = LAGS
    while REPEATS * (low + 1) < len(reach):
        n = int(reach[REPEATS * (low + 1)])
        high = max(int(low * RATIO), low + 1)
        # high + window - 1 + period <= 3 * period for every period of the scale
        window = max(1, 2 * (low + 1) - high + 1)
        hashes = _stretches(powers, n, high)
        at = _minima(hashes, window)
        at = at[np.argsort(hashes[at], kind="stable")]
        ahead = at[1:] - at[:-1]
        seeds = np.flatnonzero((hashes[at[1:]] == hashes[at[:-1]]) & (ahead > low) & (ahead <= high))
        reached: dict[int, int] = {}
        for start, period in sorted(zip(at[seeds].tolist(), ahead[seeds].tolist())):
            if start < reached.get(period, 0):
                continue  # in a stretch that was extended before
            after = _matched(ids[start:], ids[start + period:])
            before = _matched(ids[:start][::-1], ids[: start + period][::-1])
            begin, length = start - before, before + after + period
            reached[period] = start + after
            if length >= least(period) and _primitive(ids, begin, period):
                yield begin, period, length
        low = high


def runs_of(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each sequence of numbers (none negative), by start, then period.

    The sequences are laid out in one array, the longest first, so that those
    which are long enough for a period are its beginning; a number that occurs
    nowhere else ends each, and no run goes beyond it.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    order = order[: next((k for k, i in enumerate(order) if len(texts[i]) < SHORTEST), len(order))]
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not order:
        return found
    sizes = np.array([len(texts[i]) for i in order])
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    ids = np.concatenate([np.array([*texts[i], -1 - k], np.int64) for k, i in enumerate(order)])
    # begins of the first text that is shorter than n, for every n up to the longest
    reach = begins[np.searchsorted(-sizes, -np.arange(sizes[0] + 1), side="right")]
    for start, period, length in sorted({*_short(ids), *_long(ids, reach)}):
        k = int(np.searchsorted(begins, start, side="right")) - 1
        found[order[k]].append((start - int(begins[k]), length, period))
    return found


def find(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, runs, best, n_dropped, collapsed) of every row, beside the columns of ``also``.

    ``runs`` are by start, then period; ``best`` is the run of greatest length
    / period (as a fraction; ties to the smallest start, then period), null
    where there is none. ``collapsed`` has the words that no run contains
    after its first period, joined by one space. Null and empty texts, and
    texts of white space, have no words, no run and an empty ``collapsed``.
    Each row gives one row, whatever its id; rows do not look at each other.
    """
    table = pick(docs, id=doc_id, text=text, **{f"also{i}": c for i, c in enumerate(also)})
    rest = [c for c in table.columns if c != "text"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
        for batch in batches:
            for part, texts in slices(batch, "text"):
                known: dict[bytes, int] = {}
                split = [text.encode().split() for text in texts]  # at ASCII white space
                numbers = [[known.setdefault(w, len(known)) for w in words] for words in split]
                counts, found, best, dropped, collapsed = [], [], [], [], []
                for words, runs in zip(split, runs_of(numbers)):
                    edge = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in runs:
                        edge[start + period] += 1
                        edge[start + length] -= 1
                    keep = np.cumsum(edge[:-1]) == 0
                    rows = [{"start": s, "length": n, "period": q} for s, n, q in runs]
                    counts.append(len(words))
                    found.append(rows)
                    # the first of the greatest, as runs are by start, then period
                    best.append(max(rows, key=lambda r: Fraction(r["length"], r["period"]), default=None))
                    dropped.append(int(len(words) - keep.sum()))
                    collapsed.append(b" ".join(words if not runs else [w for w, k in zip(words, keep.tolist()) if k]).decode())
                columns = [part.column(part.schema.get_field_index(c)) for c in rest]
                columns += [pa.array(counts, pa.int64()), pa.array(found, pa.list_(kind)), pa.array(best, kind)]
                columns += [pa.array(dropped, pa.int64()), pa.array(collapsed, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*rest, "n_words", "runs", "best", "n_dropped", "collapsed"])

    kinds = ", ".join(f"{c} {table.schema[c].dataType.simpleString()}" for c in rest)
    out = table.mapInArrow(search, f"{kinds}, n_words long, runs array<{RUN}>, best {RUN}, n_dropped long, collapsed string")
    back = [F.col("id").alias(doc_id), *(F.col(f"also{i}").alias(c) for i, c in enumerate(also))]
    return out.select(*back, "n_words", "runs", "best", "n_dropped", "collapsed")
