"""Periodic runs: stretches of words that repeat themselves at least three times.

A run is a stretch whose smallest period is q, which holds at least ``LEAST``
words and at least ``TIMES`` periods, and which no neighbouring word extends
keeping that period. Runs are found per document in two steps.

Recursive frequency splitting. A word of a run stands in it at least ``TIMES``
times, so a word that is rarer than that in a segment is in none of its runs:
the segment is split there. In the parts other words have become rare, so they
are split again, until no word of a segment is rare or it is too short. Of the
parts of a segment the largest goes on with the counts of the whole less those
of the others, so the work is that of the smaller parts: n log n in all.

Lag scan. In what survives, every lag q up to a third of the segment is tried.
A run of period q holds a block of q words at a multiple of q that equals the
next block; these pairs are compared by sums of word hashes, m / q of them for
a lag, m log m in all. Where they agree the stretch is followed word by word to
both sides, so a hash decides nothing alone. Lags that are multiples of a known
run's period inside of it give the same stretch and are left out; they always
lie in a later doubling of the lag, so one look before each doubling is enough.

Documents are independent: one pass, no shuffle, and memory follows the longest
text. Null and blank texts have no words and no runs; repeated rows are handled
each; a null doc_id is kept and its text is not changed by ``changed_words``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillgrid.llm.common import Batches, batch_of, blended, in_batches

LEAST, TIMES = 24, 3
ODD = 0x9E3779B97F4A7C15


def numbers_of(words: list[bytes]) -> np.ndarray:
    """Words as numbers from 0; equal words have equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


class _Labelled:
    """A stretch of words renumbered from 0, where each of them stands, and how often it does."""

    def __init__(self, words: np.ndarray, offset: int):
        _, self.words = np.unique(words, return_inverse=True)
        self.offset = offset
        self.counts = np.bincount(self.words)
        self.order = np.argsort(self.words, kind="stable")
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def places(self, rare: np.ndarray, start: int, end: int) -> np.ndarray:
        """Ascending places of some words from start to end."""
        found = np.concatenate([self.order[self.first[w] : self.first[w + 1]] for w in rare.tolist()])
        found.sort()
        return found[np.searchsorted(found, start) : np.searchsorted(found, end)]


def segments(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """(start, end) of the segments in which no word is rarer than ``times``, by recursive splitting."""
    done: list[tuple[int, int]] = []
    open_parts = [(0, len(words))]
    while open_parts:
        begin, stop = open_parts.pop()
        if stop - begin < least:
            continue
        own = _Labelled(words[begin:stop], begin)
        start, end, suspects = 0, stop - begin, np.arange(len(own.counts))
        while True:  # goes on with the largest part
            rare = suspects[(own.counts[suspects] < times) & (own.counts[suspects] > 0)]
            if not len(rare):
                if end - start >= least:
                    done.append((begin + start, begin + end))
                break
            cuts = own.places(rare, start, end)
            starts, ends = np.concatenate([[start], cuts + 1]), np.concatenate([cuts, [end]])
            largest = int(np.argmax(ends - starts))
            keep_start, keep_end = int(starts[largest]), int(ends[largest])
            open_parts += [(begin + a, begin + b) for a, b in zip(starts.tolist(), ends.tolist()) if b - a >= least and a != keep_start]
            if keep_end - keep_start < least:
                break
            gone = np.concatenate([own.words[start:keep_start], own.words[keep_end:end]])
            suspects, less = np.unique(gone, return_counts=True)
            own.counts[suspects] -= less
            start, end = keep_start, keep_end
    return sorted(done)


def _stretch(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The largest (start, end) around ``at`` in which each word equals the one a lag further."""
    start, end, step, last = at, at, 64, len(words) - lag
    while end < last:
        stop = min(end + step, last)
        unlike = words[end:stop] != words[end + lag : stop + lag]
        if unlike.any():
            end += int(unlike.argmax())
            break
        end, step = stop, 2 * step
    step = 64
    while start:
        stop = max(start - step, 0)
        unlike = (words[stop:start] != words[stop + lag : start + lag])[::-1]
        if unlike.any():
            start -= int(unlike.argmax())
            break
        start, step = stop, 2 * step
    return start, end


def _unknown(lag: np.ndarray, at: np.ndarray, known: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of blocks that lie in no stretch whose period divides their lag."""
    if not known or not len(lag):
        return lag, at
    by_place = np.argsort(at, kind="stable")
    lag, at = lag[by_place], at[by_place]
    new = np.ones(len(lag), bool)
    edges = np.array([(start, end) for start, end, _ in known])
    for (start, end, period), low, high in zip(known, *np.searchsorted(at, edges).T.tolist()):
        if low < high:
            new[low:high] &= (lag[low:high] % period != 0) | (at[low:high] + 2 * lag[low:high] > end)
    lag, at = lag[new], at[new]
    by_lag = np.lexsort((at, lag))
    return lag[by_lag], at[by_lag]


def lag_scan(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a segment, by start and period."""
    m = len(words)
    powers = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(m, ODD, np.uint64)]))
    sums = np.zeros(m + 1, np.uint64)
    np.cumsum(blended(words.astype(np.uint64) + np.uint64(ODD)) * powers[:m], out=sums[1:])
    known: list[tuple[int, int, int]] = []  # start, end, period of stretches with at least two periods
    least_lag = 1
    while times * least_lag <= m:
        lags = np.arange(least_lag, min(2 * least_lag, m // times + 1))
        blocks = m // lags - 1
        lag = np.repeat(lags, blocks)
        at = (np.arange(len(lag)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * lag
        equal = (sums[at + lag] - sums[at]) * powers[lag] == sums[at + 2 * lag] - sums[at + lag]
        lag, at = lag[equal], at[equal]
        lag, at = _unknown(lag, at, [k for k in known if k[1] - k[0] >= 2 * least_lag])
        before = (0, 0)  # lag and end of the last stretch
        for q, i in zip(lag.tolist(), at.tolist()):
            if before[0] == q and i + 2 * q <= before[1]:
                continue
            start, end = _stretch(words, i, q)
            before = (q, end + q)
            if end - start >= q:
                known.append((start, end + q, q))
        least_lag *= 2
    runs = {}  # of equal intervals the smallest period, which was met first
    for start, end, period in known:
        if end - start >= max(least, times * period):
            runs.setdefault((start, end), period)
    return sorted((start, end - start, period) for (start, end), period in runs.items())


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    return [
        (begin + start, length, period)
        for begin, end in segments(words, least, times)
        for start, length, period in lag_scan(words[begin:end], least, times)
    ]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those that any run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the most periods; of equals the first, then that with the smallest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def changed_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth document (by checksum of its id) end in a repetition; others stay as they are."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]


FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()),
    ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()),
])
FOUND_COLUMNS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)

Change = Callable[[int | None, list[bytes]], list[bytes]]


def words_and_runs(doc_id: int | None, text: str | None, change: Change | None) -> tuple[list[bytes], list[tuple[int, int, int]]]:
    words = text.encode().split() if text else []  # bytes are parted at ASCII blanks
    if change:
        words = change(doc_id, words)
    return words, runs_of(numbers_of(words)) if len(words) >= LEAST else []


def periodic_runs(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """Per document the number of runs, the strongest one, and digests of all runs and of the collapsed text.

    ``change`` may replace a document's words before.
    """

    def digest(doc_id, text):
        words, runs = words_and_runs(doc_id, text, change)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        best = strongest(runs)
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        return doc_id, len(runs), *shown, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [digest(*pair) for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield batch_of(FOUND, list(map(list, zip(*rows))) if rows else [[]] * len(FOUND))

    return in_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, FOUND_COLUMNS)


RUN_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
TEXT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def all_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, start, length, period``: every run of every document, places in words."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(i, *r) for i, t in zip(ids, texts) for r in words_and_runs(i, t, None)[1]]
            yield batch_of(RUN_SCHEMA, list(map(list, zip(*rows))) if rows else [[]] * len(RUN_SCHEMA))

    return in_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, "doc_id long, start long, length long, period long")


def collapse(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: texts without the repetitions of their runs; texts without runs stay as they are, white space included."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, runs = words_and_runs(doc_id, text, None)
                out.append(b" ".join(collapsed(words, runs)).decode() if runs else text)
            yield batch_of(TEXT_SCHEMA, [batch.column(0), out])

    return in_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, "doc_id long, text string")
