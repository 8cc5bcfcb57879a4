"""Periodic runs of words by an online, sparse dynamic program over the diagonals of a text against itself.

A diagonal is a lag; its match length says how many words up to the current one equal
the word one lag earlier. Going through the words once, earlier occurrences of the
word add to the match lengths of their lags, and a diagonal that ends with a
sufficient length emits its run at once.

Not every earlier occurrence has to be followed. For lags in (g/2, g], g a power of two,
the latest earlier occurrence of the last g words is enough: were there a nearer one
inside a run of period q <= g, the run would have both periods over g + lag >= q + lag
words, and so a smaller common one. So a word follows one lag per power of two at most,
and words whose last g words occur only once follow none. The work is O(n log n) for any
text, also for one word repeated a million times.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cornerstore.llm.frames import map_columns

MIN_WORDS = 24
MIN_EXPONENT = 3
Run = tuple[int, int, int]  # start, length, period in words
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def _lags(ids: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """g, positions and lags: the latest earlier occurrence of the g words that end at a position, for g = least, 2 least, ..."""
    count = len(ids)
    rank = np.where(np.bincount(ids)[ids] > 1, ids, -1)  # equal g words, equal rank; -1: they occur once
    at, g = np.flatnonzero(rank >= 0), 1
    while len(at):
        if g >= least:
            order = np.argsort(rank[at], kind="stable")
            place, name = at[order], rank[at][order]
            again = np.flatnonzero(name[1:] == name[:-1]) + 1
            ends, lags = place[again], place[again] - place[again - 1]
            wanted = (lags <= g) & (lags > (0 if g == least else g // 2))
            yield g, ends[wanted], lags[wanted]
        at = at[at >= g]
        at = at[rank[at - g] >= 0]
        _, inverse, counts = np.unique(rank[at - g] * (count + 1) + rank[at], return_inverse=True, return_counts=True)
        repeated = counts[inverse] > 1
        at = at[repeated]
        rank = np.full(count, -1, np.int64)
        rank[at] = inverse[repeated]
        g *= 2


def word_runs(words: list[bytes], min_words: int = MIN_WORDS, min_exponent: int = MIN_EXPONENT) -> list[Run]:
    """Maximal runs with at least ``min_words`` words and ``min_exponent`` (3 or more) periods, by start and period."""
    if min_exponent < 3 or min_words < 1:
        raise ValueError("runs have three periods at least, and one word")
    if len(words) < max(min_words, min_exponent):
        return []
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    # The longest context that every run of up to that period still holds one period later.
    least = 1 << max(1, 2 * min_words // 3).bit_length() - 1
    steps = [(end, lag, np.full(len(end), g)) for g, end, lag in _lags(ids, least) if len(end)]
    if not steps:
        return []
    end, lag, context = (np.concatenate(part) for part in zip(*steps))
    order = np.argsort(end, kind="stable")

    found: list[Run] = []
    active: dict[int, tuple[int, int]] = {}  # lag: its last word, its match length

    def close(lag: int) -> None:
        last, matched = active.pop(lag)
        length = matched + lag
        if length >= min_words and length >= min_exponent * lag:
            found.append((last + 1 - length, length, lag))

    for i, d, g in zip(end[order].tolist(), lag[order].tolist(), context[order].tolist()):
        for ended in [other for other, (last, _) in active.items() if last < i - 1]:
            close(ended)
        active[d] = (i, active[d][1] + 1 if d in active else g)
    for ended in list(active):
        close(ended)
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run with the most periods, exactly compared; ties go to the smallest start, then period."""
    return min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2]), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run has after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(kept).tolist()]


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words whose tail is made periodic where 10 divides the crc32 of the doc_id; rows without one stay."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    start = g % len(words)
    rest = len(words) - start
    period = 1 + rest // (3 + g % 8)
    return words[:start] + [words[start + k % period] for k in range(rest)]


def periodic_runs(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_exponent: int = MIN_EXPONENT,
    rewrite: Rewrite | None = None,
) -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period), strongest, and the text with each run cut to one period.

    Words are split at ASCII white space and numbered from 0; ``rewrite(doc_id, words)``
    may change them first. Kept words are joined by one space. One result row per row:
    NULL and empty texts have no words, no runs and an empty text; rows that repeat a
    doc_id or have none are texts of their own; an empty table gives an empty result.
    Other columns are ignored.
    """
    def each(ids: list[int | None], texts: list[bytes | None]) -> Iterator[tuple]:
        for doc_id, text in zip(ids, texts):
            words = (text or b"").split()  # bytes: at ASCII white space only
            if rewrite:
                words = rewrite(doc_id, words)
            runs = word_runs(words, min_words, min_exponent)
            yield (
                len(words), [_named(run) for run in runs], _named(strongest(runs)),
                b" ".join(collapsed(words, runs)).decode("utf-8"),
            )

    run = "struct<start: long, length: long, period: long>"
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = f"doc_id long, n_words long, runs array<{run}>, strongest {run}, text string"
    numbered = given.select("doc_id", F.col("doc_id").alias("_id"), "text")
    return map_columns(numbered, ["_id", "text"], each, schema, keep=("doc_id",))


def _named(run: Run | None) -> dict[str, int] | None:
    return run and dict(zip(("start", "length", "period"), run))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document: number of runs, the strongest run, and digests of all runs and of the text left."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(best[name].alias(name) for name in ("start", "length", "period")),
        F.expr("strongest.length * 1000 div strongest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )
