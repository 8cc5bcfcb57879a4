"""Token-id shards: ids of documents in ascending doc_id order, in range-coded files.

A shard file holds blocks of ids, each coded on its own (rangecoder) with a checksum,
and a footer with the blocks and the documents:

    magic, blocks..., footer, footer length (8 bytes), magic
    footer: counts (3 x u32: blocks, documents, block size), block lengths, payload lengths,
            payload checksums, id checksums (u32 each), doc_ids (i64), doc_id there (u8),
            tokens per document (u32), checksum of the footer (u32)

Tasks write shards under names of their own and report them; only reported files are
part of the set, so a task that is run again does no harm.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cornerstore.llm.bpe import ByteBpe, _Words, byte_alphabet
from cornerstore.llm.frames import ship
from cornerstore.llm.rangecoder import decode_blocks, encode_blocks
from cornerstore.session import shared_folder, write_and_reread

MAGIC = b"TOKIDS02"
BLOCK_IDS = 2048
BLOCKS_AT_ONCE = 4096
TEXT_AT_ONCE = 16 << 20
PARTS_AT_ONCE = 1 << 14
BYTES_AT_ONCE = 1 << 16


class LibraryBpe(ByteBpe):
    """Encodes with the tokenizers library, word by word: each different word is asked for once.

    The library splits a text into words first and merges inside a word only, so the
    ids of a text are those of its words. Its model is asked without its own word cache,
    which takes longer to fill than new words take to merge.
    """

    def __init__(self, path: str, most_words: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers.models import BPE

        super().__init__(path, most_words)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)["model"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec.pop("merges")]
        options = {name: value for name, value in spec.items() if name not in ("type", "vocab") and value is not None}
        self._model = BPE(vocab=spec["vocab"], merges=merges, cache_capacity=0, **options)
        self._shown = {byte: shown for shown, byte in byte_alphabet().items()}
        self._words = _Words(self._ask, most_words)

    def _ask(self, word: bytes) -> list[int]:
        return [token.id for token in self._model.tokenize("".join([self._shown[byte] for byte in word]))]

    def _new(self, part: str) -> bytes:
        if not (part.isascii() and part[part[0] == " ":].isalpha()):
            return self.encode(part)
        if ids := self._words.before.get(part):
            return self._words.keep(part, ids)
        tokens = self._model.tokenize(part.replace(" ", self._shown[32]))
        return self._words.keep(part, array("I", [token.id for token in tokens]).tobytes())

    def encode_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order; NULL counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)
        start = 0
        while start < len(texts):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + TEXT_AT_ONCE, side="right")))
            yield from self._encode_some(texts[start:stop])
            start = stop

    def _encode_some(self, texts: pa.Array) -> list[np.ndarray]:
        """Encodes each different part of the texts once; texts with special tokens on their own."""
        rows = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        text = np.frombuffer(data or b"", np.uint8)[rows[0]:rows[-1]]
        rows = rows - rows[0]
        begins = part_starts(text, rows)
        offsets = np.append(begins, len(text)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(text)).dictionary_encode()
        known = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        coded = [self._words.get(part) or self._new(part) for part in known]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) >> 2
        begin, pool = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(coded), "<u4")
        which = parts.indices.to_numpy()
        after = np.append(0, np.cumsum(sizes[which]))
        ids = np.empty(after[-1], "<u4")
        for at in range(0, len(which), PARTS_AT_ONCE):
            some = which[at:at + PARTS_AT_ONCE]
            ends = after[at:at + len(some) + 1]
            where = np.repeat(begin[some] - ends[:-1], sizes[some])
            where += np.arange(ends[0], ends[-1])
            ids[ends[0]:ends[-1]] = pool.take(where)
        out = np.split(ids, after[np.searchsorted(begins, rows[1:-1])])
        for special in self.special:
            for row in np.flatnonzero(pc.match_substring(texts, special).to_numpy(zero_copy_only=False)).tolist():
                out[row] = np.frombuffer(self.encode(texts[row].as_py()), "<u4")
        return out


def part_starts(text: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where parts of UTF-8 text begin whose words do not depend on the other parts.

    Every row begins a part, and so does what no word goes on with: an ASCII character that is
    no letter behind a letter, ASCII white space behind a visible ASCII character, and a letter
    behind such white space of one character other than a space. What follows a run of white
    space decides where it is split, so a part ends in none of more than one character.
    """
    cut = np.zeros(len(text), dtype=bool)
    for at in range(0, len(text), BYTES_AT_ONCE):
        # With the two bytes before, which end the window before this one.
        some = text[max(0, at - 2):at + BYTES_AT_ONCE]
        letter = ((some | 32) - np.uint8(97)) < 26
        ends = letter.copy()
        # Latin-1 letters are 0xC3 and one byte, but for the signs of multiplication and division.
        ends[1:] |= (some[:-1] == 0xC3) & (some[1:] != 0x97) & (some[1:] != 0xB7)
        visible = (some - np.uint8(33)) < 94
        space = (some == 32) | ((some - np.uint8(9)) < 5)
        found = ends[:-1] & (some[1:] < 128) & ~letter[1:] | visible[:-1] & space[1:]
        alone = space[1:-1] & (some[1:-1] != 32) & visible[:-2]
        found[1:] |= alone & letter[2:]
        first = max(at, 1)
        last = min(at + BYTES_AT_ONCE, len(text))
        cut[first:last] = found[len(found) - (last - first):]
    cut[rows[:-1][rows[:-1] < len(text)]] = True
    return np.flatnonzero(cut)


@lru_cache(maxsize=4)
def library(path: str) -> LibraryBpe:
    return LibraryBpe(path)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ShardWriter:
    """Writes one shard; ids are held back until ``BLOCKS_AT_ONCE`` blocks are full."""

    def __init__(self, path: str, block_ids: int = BLOCK_IDS):
        system, name = _open(path)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.file = system.open_output_stream(name)
        self.file.write(MAGIC)
        self.block_ids, self.held, self.size = block_ids, [], 0
        self.blocks: list[tuple[int, int, int, int]] = []
        self.docs: list[int] = []
        self.there: list[bool] = []
        self.tokens: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.there.append(doc_id is not None)
        self.tokens.append(len(ids))
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.block_ids * BLOCKS_AT_ONCE:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, dtype="<u4")
        whole = len(ids) // self.block_ids
        used = len(ids) if last else whole * self.block_ids
        part, rest = ids[:used], ids[used:]
        count = -(-used // self.block_ids)
        lengths = np.full(count, self.block_ids)
        if count and used % self.block_ids:
            lengths[-1] = used % self.block_ids
        rows = np.zeros(count * self.block_ids, dtype="<u4")
        rows[:used] = part
        rows = rows.reshape(count, self.block_ids)
        for start in range(0, count, BLOCKS_AT_ONCE):
            many = slice(start, start + BLOCKS_AT_ONCE)
            for row, length, payload in zip(rows[many], lengths[many], encode_blocks(rows[many], lengths[many])):
                self.file.write(payload)
                check = zlib.crc32(row[:length])
                self.blocks.append((int(length), len(payload), zlib.crc32(payload), check))
        self.held, self.size = [rest], len(rest)

    def close(self) -> tuple[int, int]:
        self._flush(True)
        numbers = np.array(self.blocks, dtype="<u4").reshape(-1, 4)
        footer = b"".join(
            [
                np.array([len(self.blocks), len(self.docs), self.block_ids], "<u4").tobytes(),
                *(numbers[:, k].tobytes() for k in range(4)),
                np.array(self.docs, "<i8").tobytes(), np.array(self.there, "u1").tobytes(),
                np.array(self.tokens, "<u4").tobytes(),
            ]
        )
        footer += zlib.crc32(footer).to_bytes(4, "little")
        self.file.write(footer + len(footer).to_bytes(8, "little") + MAGIC)
        self.file.close()
        return len(self.docs), sum(self.tokens)


@dataclass
class Shard:
    blocks: np.ndarray
    docs: list[int | None]
    tokens: np.ndarray


def read_footer(file, size: int) -> Shard:
    file.seek(size - 16)
    tail = file.read(16)
    length = int.from_bytes(tail[:8], "little")
    file.seek(0)
    if tail[8:] != MAGIC or file.read(8) != MAGIC or length > size - 24:
        raise ValueError("not a token-id shard, or cut short")
    file.seek(size - 16 - length)
    footer = file.read(length)
    if zlib.crc32(footer[:-4]) != int.from_bytes(footer[-4:], "little"):
        raise ValueError("the footer of a token-id shard is damaged")
    blocks, docs, _ = np.frombuffer(footer, "<u4", 3).tolist()
    at = 12
    numbers = np.frombuffer(footer, "<u4", 4 * blocks, at).reshape(4, blocks).T.astype(np.int64)
    at += 16 * blocks
    ids, there = np.frombuffer(footer, "<i8", docs, at), np.frombuffer(footer, "u1", docs, at + 8 * docs)
    tokens = np.frombuffer(footer, "<u4", docs, at + 9 * docs).astype(np.int64)
    return Shard(numbers, [i if t else None for i, t in zip(ids.tolist(), there.tolist())], tokens)


def read_shard(path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """doc_id and ids of every document of a shard, in order; raises ValueError where a checksum fails."""
    system, name = _open(path)
    size = system.get_file_info(name).size
    with system.open_input_file(name) as file:
        shard = read_footer(file, size)
        file.seek(8)
        held, doc = np.zeros(0, dtype="<u4"), 0
        for start in range(0, len(shard.blocks), BLOCKS_AT_ONCE):
            many = shard.blocks[start:start + BLOCKS_AT_ONCE]
            payloads = [file.read(int(n)) for n in many[:, 1]]
            if [zlib.crc32(p) for p in payloads] != many[:, 2].tolist():
                raise ValueError(f"a block of {path} is damaged")
            rows = decode_blocks(payloads, many[:, 0])
            ids = [row[:n] for row, n in zip(rows, many[:, 0])]
            if [zlib.crc32(i) for i in ids] != many[:, 3].tolist():
                raise ValueError(f"a block of {path} does not decode to its ids")
            held, at = np.concatenate([held, *ids]), 0
            while doc < len(shard.docs) and at + shard.tokens[doc] <= len(held):
                yield shard.docs[doc], held[at:at + shard.tokens[doc]]
                at += int(shard.tokens[doc])
                doc += 1
            held = held[at:]
        while doc < len(shard.docs):
            if shard.tokens[doc] or len(held):
                raise ValueError(f"{path} has fewer ids than its footer says")
            yield shard.docs[doc], held
            doc += 1


def write_shards(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> DataFrame:
    """shard, path, n_docs, n_tokens of the files written under ``folder``, in ascending doc_id order over the shards.

    Documents are dealt out and sorted by doc_id (rows without one first), equal ids by
    the text's hash. NULL texts count as empty; every document ends with ``end_id``.
    """
    ship(docs.sparkSession)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        path = f"{folder}/shard-{number:06d}-{uuid4().hex}.ids"
        encoder, end, writer = library(tokenizer), np.array([end_id], "<u4"), None
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode_column(batch.column(1))):
                writer = writer or ShardWriter(path, block_ids)
                writer.add(doc_id, np.concatenate([ids, end]))
        if writer:
            n_docs, n_tokens = writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": number, "path": path, "n_docs": n_docs, "n_tokens": n_tokens}],
                pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    written = ordered.mapInArrow(run, "shard int, path string, n_docs long, n_tokens long")
    # Written down at once: the files must not be made again when the list is read twice.
    return write_and_reread(written, "shard-list")


def read_shards(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """doc_id, start, ids_crc32, n_tokens of every document in the files of ``shards``.

    The list of shards has a row per file; its running sum gives each file's first
    position. One task reads one file at a time, a few thousand blocks together.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    ship(spark)
    listed = sorted(shards.collect(), key=lambda r: r["shard"])
    if not listed:
        return spark.createDataFrame([], schema)
    starts = np.concatenate([[0], np.cumsum([r["n_tokens"] for r in listed])]).tolist()
    rows = [(r["path"], start) for r, start in zip(listed, starts)]
    files = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), "path string, start long")
    arrow = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                made: list[tuple] = []
                for doc_id, ids in read_shard(path):
                    made.append((doc_id, start, len(ids), zlib.crc32(ids)))
                    start += len(ids)
                    if len(made) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], schema=arrow)
                        made = []
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], schema=arrow)

    return files.mapInArrow(run, schema)


def token_positions(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` and read them back: doc_id, start, n_tokens, ids_crc32.

    An empty table gives no shard and an empty result. Rows that repeat a doc_id are
    documents of their own, next to each other. Other columns are ignored.
    """
    spark = docs.sparkSession
    return read_shards(spark, write_shards(docs, tokenizer, folder or shared_folder(spark, "token-ids")))
