"""Spelling variants of a corpus's words: Bloom-guided search of one-edit neighbourhoods.

The edits of every vocabulary word are generated and probed against blocked Bloom
filters, one shard per word length. Only edits that a filter lets through are
shuffled, to an exact join with the vocabulary that removes the false positives.
A deletion that gives another word is an insertion seen from that word, and of two
words that differ in one place only the one with the smaller code point there
generates the other, so deletions and upward replacements reach every pair once.

Filters are broadcast. Shards go into rounds of at most ``FILTER_BYTES`` together; a
longer vocabulary takes more rounds, each over the words that can reach its shards.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cornerstore.llm.frames import ship
from cornerstore.session import write_and_reread

RUN = re.compile("[a-zÀ-ÿ]+")  # after A-Z are lower-cased
#: What a run is made of.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
MIN_LENGTH = 5
MIN_COUNT = 3
FILTER_BYTES = 16 << 20
BITS_PER_WORD = 16
_KEPT_WORDS = 200_000  # a task's counts are passed on beyond so many distinct words
_EDITS = 1 << 18  # edits that are hashed together
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PROBES = 4

Alter = Callable[[int | None, str], str]


def damaged(doc_id: int | None, run: str) -> str:
    """The run without one code point where 97 divides the crc32 of ``doc_id:run``; no doc_id is the empty text."""
    h = zlib.crc32(run.encode(), zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id))
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(
    docs: DataFrame, alter: Alter | None = None, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """word, n of the words of all whole texts with enough code points and occurrences.

    Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF; only A-Z are
    lower-cased. ``alter(doc_id, run)`` may shorten a run. A task counts before the
    shuffle and holds a bounded number of distinct words. NULL and empty texts have no
    words; rows that repeat a doc_id or have none count as any other; an empty table
    gives an empty vocabulary; other columns are ignored.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def passed_on(counts: Counter) -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=schema)
        counts.clear()
        return batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = Counter(RUN.findall((text.as_py() or b"").lower().decode("utf-8")))  # bytes: A-Z only
                for word, n in runs.items():
                    if len(word) >= min_length:
                        if alter:
                            word = alter(doc_id, word)
                            if len(word) < min_length:
                                continue
                        counts[word] += n
                if len(counts) > _KEPT_WORDS:
                    yield passed_on(counts)
        if counts:
            yield passed_on(counts)

    ship(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = given.filter("text is not null").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _codes(words: list[str], length: int) -> np.ndarray:
    """Code points, a row per word of that length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    powers = np.ones(length, np.uint64)
    powers[1:] = _BASE
    return np.multiply.accumulate(powers)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each row: an edit changes it by a term or two."""
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class BlockedFilter:
    """Bloom filter whose bits of one word lie in one block of 64 bits."""

    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks

    @staticmethod
    def places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        h = _mixed(hashes)
        bits = np.zeros(len(h), np.uint64)
        for k in range(_PROBES):
            bits |= np.uint64(1) << (h >> np.uint64(6 * k) & np.uint64(63))
        return (h >> np.uint64(24)) % np.uint64(size), bits

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at, bits = self.places(hashes, len(self.blocks))
        return self.blocks[at] & bits == bits


def filter_size(words: int) -> int:
    """Blocks of a shard of so many words."""
    return max(1, words * BITS_PER_WORD // 64)


def rounds_of(sizes: dict[int, int], bound: int) -> list[list[tuple[int, int, int]]]:
    """Rounds of (length, part, parts) whose filters take ``bound`` bytes at most.

    A length with more words than one round holds is split by the words' hashes.
    """
    rounds, left = [], 0
    for length, words in sorted(sizes.items()):
        parts = -(-8 * filter_size(words) // bound)
        share = 8 * filter_size(-(-words // parts))
        for part in range(parts):
            if not rounds or share > left:
                rounds.append([])
                left = bound
            rounds[-1].append((length, part, parts))
            left -= share
    return rounds


def _part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return _mixed(hashes ^ _BASE) % np.uint64(parts)


def build_filters(words: DataFrame, sizes: dict[int, int], shards: list[tuple[int, int, int]]) -> dict[tuple[int, int], BlockedFilter]:
    """The filters of a round, by length and part.

    Tasks send (shard, block, bits), OR-ed together by block before the driver puts
    the blocks in place: it gets the filters' own size, which the round bounds.
    """
    size = {(length, part): filter_size(-(-sizes[length] // parts)) for length, part, parts in shards}
    parts_of = {length: parts for length, _, parts in shards}
    schema = pa.schema([("length", pa.int32()), ("part", pa.int32()), ("block", pa.int64()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, group in _by_length(batch.column(0).to_pylist()).items():
                if length not in parts_of:
                    continue
                hashes = np.concatenate([word_hashes(_codes(some, length)) for some in _slices(group, length)])
                part = _part_of(hashes, parts_of[length])
                for p in np.unique(part).tolist():
                    if (length, p) in size:
                        at, bits = BlockedFilter.places(hashes[part == p], size[length, p])
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, length), pa.int32()), pa.array(np.full(n, p), pa.int32()),
                             pa.array(at.astype(np.int64)), pa.array(bits.view(np.int64))], schema=schema,
                        )

    ship(words.sparkSession)
    made = words.filter(F.length("word").isin(sorted(parts_of))).select("word").mapInArrow(run, "length int, part int, block long, bits long")
    blocks = {shard: np.zeros(n, np.uint64) for shard, n in size.items()}
    joined = made.groupBy("length", "part", "block").agg(F.bit_or("bits").alias("bits"))
    table = joined.toArrow()
    length, part, block, bits = (table.column(k).to_numpy() for k in range(4))
    for shard, own in blocks.items():
        mine = (length == shard[0]) & (part == shard[1])
        own[block[mine]] = bits[mine].view(np.uint64)
    return {shard: BlockedFilter(own) for shard, own in blocks.items()}


def _by_length(words: list[str]) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    return groups


def _slices(words: list[str], length: int) -> Iterator[list[str]]:
    step = max(1, _EDITS // max(length, len(ALPHABET)))
    for k in range(0, len(words), step):
        yield words[k:k + step]


def _probe(h: np.ndarray, filters: dict[tuple[int, int], BlockedFilter], parts_of: dict[int, int], length: int) -> np.ndarray:
    """Places in ``h`` that the round's filters of a length let through."""
    parts = parts_of.get(length)
    if not parts:
        return np.zeros(0, np.int64)
    if parts == 1:
        return np.flatnonzero(filters[length, 0].holds(h))
    part, found = _part_of(h, parts), []
    for p in range(parts):
        if (length, p) in filters:
            mine = np.flatnonzero(part == p)
            found.append(mine[filters[length, p].holds(h[mine])])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _edits(words: list[str], length: int, filters: dict, parts_of: dict[int, int]) -> Iterator[tuple[int, str]]:
    """(index, edit) of the deletions and upward replacements of words of one length that the filters let through."""
    codes, powers = _codes(words, length), _powers(length)
    terms = codes * powers
    total = terms.sum(axis=1, dtype=np.uint64)
    if length - 1 in parts_of:
        before = np.cumsum(terms, axis=1, dtype=np.uint64)  # up to and with each place
        made = before - terms + (total[:, None] - before) * _BACK
        first = np.ones(codes.shape, bool)  # of equal neighbours one deletion is enough
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        row, at = np.nonzero(first)
        for k in _probe(made[row, at], filters, parts_of, length - 1).tolist():
            word, i = words[row[k]], at[k]
            yield row[k], word[:i] + word[i + 1:]
    if length in parts_of:
        step = max(1, _EDITS // (len(words) * len(ALPHABET)))
        for start in range(0, length, step):  # a few places at a time, for all words
            some = slice(start, start + step)
            row, at, letter = np.nonzero(ALPHABET > codes[:, some, None])
            place = at + start
            made = total[row] + (ALPHABET[letter] - codes[row, place]) * powers[place]
            for k in _probe(made, filters, parts_of, length).tolist():
                word, i = words[row[k]], place[k]
                yield row[k], word[:i] + chr(int(ALPHABET[letter[k]])) + word[i + 1:]


def near_pairs(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """a, n_a, b, n_b: every pair of words one edit apart, once. ``words`` (word, n) is read several times.

    Letters beyond ``ALPHABET`` cannot be inserted or put in; ``vocabulary`` gives none.
    """
    spark = words.sparkSession
    # One row per length: lengths are few, or the words themselves are very long.
    sizes = {row["length"]: row["words"] for row in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words")).collect()}
    schema = pa.schema([("a", pa.string()), ("n_a", pa.int64()), ("edit", pa.string())])
    ship(spark)
    found = None
    for shards in rounds_of(sizes, filter_bytes):
        parts_of = {length: parts for length, _, parts in shards}
        filters = spark.sparkContext.broadcast({k: f.blocks for k, f in build_filters(words, sizes, shards).items()})
        reach = sorted({length + more for length in parts_of for more in (0, 1)})

        def run(batches: Iterator[pa.RecordBatch], filters=filters, parts_of=parts_of) -> Iterator[pa.RecordBatch]:
            held = {k: BlockedFilter(blocks) for k, blocks in filters.value.items()}
            for batch in batches:
                counts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                for length, group in _by_length(list(counts)).items():
                    for some in _slices(group, length):
                        rows = [(some[k], counts[some[k]], edit) for k, edit in _edits(some, length, held, parts_of)]
                        if rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

        near = words.filter(F.length("word").isin(reach)).select("word", "n").mapInArrow(run, "a string, n_a long, edit string")
        found = near if found is None else found.unionByName(near)
    if found is None:
        return spark.createDataFrame([], "a string, n_a long, b string, n_b long")
    return found.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), F.col("edit") == F.col("b")).select("a", "n_a", "b", "n_b")


def follow(links: DataFrame) -> DataFrame:
    """word, root: where the chain that starts with each ``word`` of (word, form) ends.

    The distance looked ahead doubles every round, so a chain of k links takes about
    log2 k rounds. A word that has reached its end joins no further round, so the many
    words of one large tree do not meet at its root again and again. Each round is
    written to the shared folder.
    """
    ahead = write_and_reread(links.select("word", F.col("form").alias("root"), F.lit(False).alias("ended")), "spelling-links")
    while not ahead.filter("not ended").isEmpty():
        jump = ahead.select(F.col("word").alias("_at"), F.col("root").alias("_root"), F.col("ended").alias("_ended"))
        moved = ahead.filter("not ended").join(jump, F.col("root") == F.col("_at"), "left")
        moved = moved.select("word", F.coalesce("_root", "root").alias("root"), F.coalesce("_ended", F.lit(True)).alias("ended"))
        ahead = write_and_reread(ahead.filter("ended").unionByName(moved), "spelling-links")
    return ahead.select("word", "root")


def variants(words: DataFrame, filter_bytes: int = FILTER_BYTES, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``words`` (word, n; each word once).

    Two words are near if one inserted, deleted or replaced code point makes one of
    the other. A word's form is its near word with the largest n, ties to the
    smallest in code-point order, if that is ``factor`` times the word's own n at least; else
    there is none. The root is where following forms ends, the word itself without
    one. An empty vocabulary gives an empty result.
    """
    words = write_and_reread(words.select("word", "n"), "spelling-words")
    pairs = near_pairs(words, filter_bytes)
    ends = F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")),
                             F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("m"))))
    seen = pairs.select(ends.alias("e")).select("e.*")
    best = seen.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("_best"))
    best = best.select("word", "n_near", F.col("_best.near").alias("_near"), (-F.col("_best.less")).alias("_m"))
    enough = F.col("_m") >= factor * F.col("n")
    judged = write_and_reread(
        words.join(best, "word", "left").select(
            "word", F.when(enough, F.col("_near")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(enough, F.col("_m")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = follow(judged.filter("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
