"""Byte-level BPE over whole texts, from the file of a public tokenizer.

Short words are merged in a contiguous rank array: the part boundaries of the
word and the rank of every pair of neighbours. The smallest rank is searched,
its inner boundary deleted and the two neighbouring ranks refreshed, until no
pair has a rank. Long words use a heap over the same boundaries, because
repeated scans take quadratic time there. Both give the leftmost of equal ranks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame

from cornerstore.llm.frames import map_columns

NO_RANK = 1 << 40
SHORT_WORD = 128

# The word pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# The classes of PATTERN for texts that have Latin-1 characters only.
_LETTERS, _NUMBERS, _SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", " \\t\\n\\r\\x0b\\x0c\\x85\\xa0"
LATIN_PATTERN = (
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)


def byte_alphabet() -> dict[str, int]:
    """Which byte each character of a vocabulary file stands for."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class _Words(dict):
    """Word -> its ids as little-endian unsigned 32-bit integers, filled on demand.

    The table starts anew when it holds half of ``most`` words, which bounds memory. Until
    the next time the words before are taken over when they come again.
    """

    def __init__(self, encode, most: int):
        super().__init__()
        self._encode, self._most = encode, most
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        return self.keep(word, ids or array("I", self._encode(word.encode("utf-8"))).tobytes())

    def keep(self, word: str, ids: bytes) -> bytes:
        if 2 * len(self) >= self._most:
            self.before = dict(self)
            self.clear()
        if len(ids) <= 4 * SHORT_WORD:
            self[word] = ids
        return ids


class ByteBpe:
    """Encoder and decoder of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str, most_words: int = 300_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before, model = spec["pre_tokenizer"], spec["model"]
        if (
            model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"]
            or not before.get("use_regex", True) or spec["normalizer"] is not None
        ):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        of = byte_alphabet()
        as_bytes = lambda token: bytes(of[c] for c in token)
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items()}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(as_bytes(a), as_bytes(b)): rank for rank, (a, b) in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} has added tokens that take neighbours with them")
        self.pieces = [b""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for token, i in self.ids.items():
            self.pieces[i] = token
        for token, i in self.special.items():
            self.pieces[i] = token.encode("utf-8")
        self._split = regex.compile(PATTERN).findall
        self._split_latin = re.compile(LATIN_PATTERN).findall
        texts = sorted(self.special, key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(map(re.escape, texts))})").split if texts else None
        self._words = _Words(self.word_ids, most_words)

    def word_ids(self, word: bytes) -> list[int]:
        bounds = self._merge(word) if len(word) <= SHORT_WORD else self._merge_long(word)
        return [self.ids[word[a:b]] for a, b in zip(bounds, bounds[1:])]

    def _merge(self, word: bytes) -> list[int]:
        rank = self.ranks.get
        bounds = list(range(len(word) + 1))
        ranks = [rank((word[i:i + 1], word[i + 1:i + 2]), NO_RANK) for i in range(len(word) - 1)]
        while ranks and (least := min(ranks)) < NO_RANK:
            at = ranks.index(least)
            del bounds[at + 1], ranks[at]
            if at:
                a, b, c = bounds[at - 1:at + 2]
                ranks[at - 1] = rank((word[a:b], word[b:c]), NO_RANK)
            if at < len(ranks):
                a, b, c = bounds[at:at + 3]
                ranks[at] = rank((word[a:b], word[b:c]), NO_RANK)
        return bounds

    def _merge_long(self, word: bytes) -> list[int]:
        size, rank = len(word), self.ranks.get
        end, before = list(range(1, size + 1)), list(range(-1, size - 1))
        now = [NO_RANK] * size  # rank of the part that starts here with the next one
        heap: list[tuple[int, int]] = []

        def refresh(at: int) -> None:
            mid = end[at]
            now[at] = NO_RANK if mid >= size else rank((word[at:mid], word[mid:end[mid]]), NO_RANK)
            if now[at] < NO_RANK:
                heapq.heappush(heap, (now[at], at))

        for at in range(size):
            refresh(at)
        while heap:
            least, at = heapq.heappop(heap)
            if now[at] != least:
                continue
            gone = end[at]
            now[gone], end[at] = NO_RANK, end[gone]
            if end[at] < size:
                before[end[at]] = at
            refresh(at)
            if before[at] >= 0:
                refresh(before[at])
        bounds = [0]
        while bounds[-1] < size:
            bounds.append(end[bounds[-1]])
        return bounds

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers; NULL counts as empty."""
        parts: list[bytes] = []
        for piece in self._special(text or "") if self._special else [text or ""]:
            if piece in self.special:
                parts.append(array("I", [self.special[piece]]).tobytes())
            elif piece:
                try:
                    piece.encode("latin-1")
                    words = self._split_latin(piece)
                except UnicodeEncodeError:
                    words = self._split(piece)
                parts += map(self._words.__getitem__, words)
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, "<u4").tolist()
        return b"".join(map(self.pieces.__getitem__, numbers)).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> ByteBpe:
    """One codec per worker process and file."""
    return ByteBpe(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (array of int) of every whole text.

    NULL texts count as empty and give an empty array. Rows that repeat and rows
    without doc_id are encoded like any other. Other columns are ignored.
    """
    def run(texts):
        for text in texts:
            yield (np.frombuffer(codec(path).encode(text), "<i4"),)

    return map_columns(docs, ["text"], run, "doc_id long, ids array<int>", ("doc_id",))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text from doc_id, ids. NULL ids count as none."""
    def run(rows):
        for ids in rows:
            yield (codec(path).decode(np.array(ids or [], "<u4").tobytes()),)

    return map_columns(encoded, ["ids"], run, "doc_id long, text string", ("doc_id",))


def round_trip(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text in one pass, and return digests of both.

    doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit
    integers), decoded_sha256 (of the decoded text in UTF-8), and ids (array of int)
    if asked for. NULL texts count as empty; no shuffle, memory bounded by a batch
    and the word table. Rows that repeat and rows without doc_id are treated alike.
    """
    def run(texts):
        own = codec(path)
        for text in texts:
            ids = own.encode(text)
            decoded = own.decode(ids).encode("utf-8")
            row = len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()
            yield (*row, np.frombuffer(ids, "<i4")) if with_ids else row

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_columns(docs, ["text"], run, schema + ", ids array<int>" * with_ids, ("doc_id",))
