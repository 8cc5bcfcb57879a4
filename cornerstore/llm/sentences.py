"""Substring dedup over sliding runs of consecutive sentences.

From every sentence on, and back from every sentence, the shortest run of several
sentences that reaches ``min_words`` words is hashed. Runs are joined over the
whole corpus, and every sentence that a repeated run covers at any place but the
first (smallest doc_id, then position) is removed. A passage of ``min_words`` words
or more that starts and ends with a sentence is covered from end to end; of one that
starts or ends inside a sentence, the whole sentences are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cornerstore.llm.frames import ship

MIN_WORDS = 10
LONG_SENTENCE = 50
MIN_SENTENCES = 2
_BREAK = re.compile(r"[.!?]+\s+|[。！？]+\s*|\n\s*")
_BATCH = 100_000


def sentence_bounds(text: str) -> tuple[list[int], list[int], list[bytes]]:
    """Edges of the sentences, their word counts, and their lower-cased words joined by one space.

    The sentences tile the text; a piece without words belongs to the one before it.
    """
    edges, counts, texts = [0], [], []
    start = 0
    for end in [*(m.end() for m in _BREAK.finditer(text)), len(text)]:
        words = text[start:end].lower().split()
        if words:
            if counts:
                edges.append(start)
            counts.append(len(words))
            texts.append(" ".join(words).encode("utf-8", "surrogatepass"))
        start = end
    return ([*edges, len(text)] if counts else []), counts, texts


def runs(counts: list[int], min_words: int, min_sentences: int, long_sentence: int) -> list[tuple[int, int]]:
    """(first, end) of the shortest sufficient run from each sentence on, and back from each."""
    n = len(counts)
    words = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(n)
    alone = np.diff(words) >= max(long_sentence, min_words)
    least = np.where(alone, 1, min_sentences)
    ahead = np.maximum(np.searchsorted(words, words[:-1] + min_words), at + least)
    back = np.minimum(np.searchsorted(words, words[1:] - min_words, side="right") - 1, at + 1 - least)
    found = [(int(a), int(b)) for a, b in zip(at, ahead) if b <= n]
    found += [(int(a), int(b)) for a, b in zip(back, at + 1) if a >= 0]
    return sorted(set(found))


def _hashes(text: str, limits: tuple[int, int, int]) -> tuple[list[int], list[tuple[int, int, int, int]]]:
    """Edges of the sentences, and (hash, check, first, end) of every run."""
    edges, counts, texts = sentence_bounds(text)
    if not counts:
        return edges, []
    each = b"".join(map(xxhash.xxh3_64_digest, texts))
    out = []
    for first, end in runs(counts, *limits):
        both = xxhash.xxh3_128_intdigest(each[8 * first:8 * end])
        low, high = both & (1 << 64) - 1, both >> 64 & (1 << 31) - 1
        out.append((low - (1 << 64) if low >> 63 else low, high, first, end))
    return edges, out


def sentence_runs(docs: DataFrame, limits: tuple[int, int, int]) -> DataFrame:
    """h, h2, doc_id, first, last+1 of every run of every whole text."""
    schema = pa.schema(
        [("h", pa.int64()), ("h2", pa.int32()), ("doc_id", pa.int64()), ("first", pa.int32()), ("end", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = _hashes(text.as_py() or "", limits)[1]
                rows += [(h, h2, doc_id, first, end) for h, h2, first, end in found]
                if len(rows) >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    ship(docs.sparkSession)
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    return wanted.mapInArrow(run, "h long, h2 int, doc_id long, first int, end int")


def repeated_runs(docs: DataFrame, limits: tuple[int, int, int]) -> DataFrame:
    """doc_id, cuts (array of first, end, h) of the runs that repeat an earlier place.

    A run that very many documents share is one row per task before the first
    shuffle, and the join on its hash is one that Spark can split.
    """
    spans = sentence_runs(docs, limits)
    place = F.struct("doc_id", "first", "h2")
    firsts = spans.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("p")).filter("n > 1")
    firsts = firsts.select("h", F.col("p.doc_id").alias("doc0"), F.col("p.first").alias("at0"), F.col("p.h2").alias("check0"))
    later = spans.join(firsts, "h").filter("h2 = check0 and (doc_id <> doc0 or first <> at0)")
    return later.groupBy("doc_id").agg(F.collect_set(F.struct("first", "end", "h")).alias("cuts"))


def dedup_sentences(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_sentences: int = MIN_SENTENCES,
    long_sentence: int = LONG_SENTENCE,
) -> DataFrame:
    """doc_id, text (without repeated runs), n_sentences, n_removed of every document.

    A sentence with ``long_sentence`` words or more is a run by itself. Words are
    compared in lower case with one space between them; what stays is the text as
    it was. Repeats inside one document count too. NULL texts stay NULL with no
    sentences. Rows without doc_id are neither searched nor changed. Rows that repeat
    a doc_id are one document: the same run at the same place is no repeat. An empty
    table gives an empty result; other columns are ignored.
    """
    cut = cut_documents(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), min_words, min_sentences, long_sentence)
    return cut.select("doc_id", "text", F.col("_sentences").alias("n_sentences"), F.col("_removed").alias("n_removed"))


def cut_documents(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    min_sentences: int = MIN_SENTENCES,
    long_sentence: int = LONG_SENTENCE,
) -> DataFrame:
    """All columns of ``docs`` with the texts cut, and _sentences, _removed (int)."""
    limits = (min_words, min_sentences, long_sentence)
    cuts = repeated_runs(docs, limits).withColumnRenamed("doc_id", "_cut_id")
    places = [F.col(f"cuts.{c}").alias(f"_{c}") for c in ("first", "end", "h")]
    both = docs.join(cuts, docs["doc_id"].cast("long") == F.col("_cut_id"), "left").select(
        *(docs[c] for c in docs.columns), *places
    )
    at, width = docs.columns.index("text"), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            for text, first, end, h in zip(batch.column(at), *(batch.column(width + k) for k in range(3))):
                text = text.as_py()
                if text is None or not first.is_valid:
                    texts.append(text)
                    counts.append(len(sentence_bounds(text or "")[1]))
                    removed.append(0)
                    continue
                edges, found = _hashes(text, limits)
                there = {(a, b, value) for value, _, a, b in found}
                marked = zip(first.as_py(), end.as_py(), h.as_py())
                gone = {k for a, b, value in marked if (a, b, value) in there for k in range(a, b)}
                count = max(0, len(edges) - 1)
                texts.append("".join(text[edges[k]:edges[k + 1]] for k in range(count) if k not in gone))
                counts.append(count)
                removed.append(len(gone))
            columns = [batch.column(k) for k in range(width)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(counts, pa.int32()), pa.array(removed, pa.int32())],
                names=[*batch.schema.names[:width], "_sentences", "_removed"],
            )

    schema = StructType([*docs.schema.fields, StructField("_sentences", IntegerType()), StructField("_removed", IntegerType())])
    return both.mapInArrow(run, schema)


def drop_repeated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages cut out and n_chars, if there, brought up to date.

    Documents of which no word is left go; documents that nothing was cut from stay as they were.
    """
    cut = cut_documents(docs).filter((F.col("_removed") == 0) | (F.length(F.trim("text")) > 0))
    if "n_chars" in docs.columns:
        now = F.when(F.col("_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", now.cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)
