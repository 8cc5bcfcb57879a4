"""Language identification of words by a linear-chain conditional random field.

Every word is scored per language by its affixes, letter n-grams and the word itself
if it is in the learned lexicon; learned transitions say how often a language goes on.
Forward-backward over the whole text gives the probability of every language at every
word, so code-switched texts are labelled word by word, and a document by the sum.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cornerstore.llm.frames import hash_part, map_columns, sample_of_labels

TRAIN_ROWS = 4_000
TRAIN_WORDS = 400
MOST_LANGUAGES = 64
FEATURES = 1 << 16
LEXICON = 20_000
SEQUENCE = 64
ROUNDS = 80
STEP_WORDS = 400_000
KNOWN_WORDS = 400_000
_WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"


def words_of(text: str | None) -> list[str]:
    """The words of a text in lower case; none if it has no letter."""
    words = _WORD.findall((text or "").lower())
    return words if any(any(map(str.isalpha, word)) for word in words) else []


class _Numbers(dict):
    """Feature name -> its number; n-grams recur, so each is hashed once per process."""

    def __missing__(self, name: str) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        self[name] = number = xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) % FEATURES
        return number


_numbers = _Numbers()


def word_features(word: str, lexicon: frozenset[str]) -> list[int]:
    """Numbers of the word's affixes and n-grams (edges marked) and of its lexicon entry."""
    edged = f"<{word}>"
    names = {edged[i:i + 2] for i in range(len(edged) - 1)}
    names.update(edged[i:i + 3] for i in range(len(edged) - 2))
    names.update((edged[:4], edged[-4:]))
    if word in lexicon:
        names.add("w:" + word)
    return [_numbers[n] for n in names]


@dataclass
class LanguageModel:
    """Weights (FEATURES x languages), transitions (from, to), lexicon. Bounded in size."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: frozenset[str]


class Emissions:
    """Word -> row of a table of emission scores that grows with the words seen, up to a bound."""

    def __init__(self, model: LanguageModel):
        self.model, self.rows = model, {}
        self.table = np.zeros((1024, len(model.languages)), dtype=np.float32)

    def of(self, words: list[str]) -> np.ndarray:
        if len(self.rows) > KNOWN_WORDS:
            self.rows = {}
        known = self.rows
        new = list(set(words).difference(known))
        for start in range(0, len(new), 10_000):
            part = new[start:start + 10_000]
            found = [word_features(w, self.model.lexicon) for w in part]
            sizes = np.array([len(f) for f in found])
            flat = np.fromiter((n for f in found for n in f), dtype=np.int64, count=int(sizes.sum()))
            scores = np.add.reduceat(self.model.weights[flat], np.concatenate([[0], np.cumsum(sizes)])[:-1], axis=0)
            at = len(known)
            while at + len(part) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[at:at + len(part)] = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -30))
            known.update(zip(part, range(at, at + len(part))))
        return self.table[np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))]


def marginals(
    lengths: np.ndarray, emissions: np.ndarray, transitions: np.ndarray, with_filtered: bool = False
) -> np.ndarray | tuple[np.ndarray, np.ndarray]:
    """P(language) of every word by forward-backward, for sequences that stand one after the other.

    With ``with_filtered``, also P(language) given the words up to this one only.

    ``emissions`` are positive factors, not logarithms. All sequences step together,
    the longest first, and leave when they end.
    """
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    steps = int(size[0]) if len(size) else 0
    active = len(size) - np.searchsorted(size[::-1], np.arange(steps), side="right")
    begin = np.concatenate([[0], np.cumsum(active)])
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
    ranks = np.concatenate([np.arange(a) for a in active]) if steps else np.zeros(0, dtype=np.int64)
    place = starts[ranks] + np.repeat(np.arange(steps), active)  # by step, then by sequence
    e = emissions[place].astype(np.float64)
    move = np.exp(transitions - transitions.max())
    forward = np.empty_like(e)
    for t in range(steps):
        now = e[begin[t]:begin[t + 1]]
        a = now if t == 0 else (forward[begin[t - 1]:begin[t - 1] + active[t]] @ move) * now
        forward[begin[t]:begin[t + 1]] = a / a.sum(axis=1, keepdims=True)
    out = np.empty_like(e)
    filtered = np.empty_like(e) if with_filtered else None
    if with_filtered:
        filtered[place] = forward
    backward = np.ones((0, e.shape[1]))
    for t in range(steps - 1, -1, -1):
        here = np.ones((active[t], e.shape[1]))
        if len(backward):
            b = (backward * e[begin[t + 1]:begin[t + 2]]) @ move.T
            here[:len(b)] = b / b.sum(axis=1, keepdims=True)
        backward = here
        forward[begin[t]:begin[t + 1]] *= here
    out[place] = forward / forward.sum(axis=1, keepdims=True)
    return (out, filtered) if with_filtered else out


def train(texts: list[list[str]], labels: list[int], languages: list[str], seed: int = 11) -> LanguageModel:
    """Fit weights and transitions to label every word with the language of its document.

    Sequences are put together from pieces of 4 to 40 words of documents drawn at
    random, so that switches inside a sequence are seen and can be learned.
    """
    random = np.random.default_rng(seed)
    k = len(languages)
    counts = Counter(w for words in texts for w in set(words))
    lexicon = frozenset(w for w, n in counts.most_common(LEXICON) if n > 1)
    by_language = [[words for words, label in zip(texts, labels) if label == i and words] for i in range(k)]
    present = [i for i in range(k) if by_language[i]]
    words, gold = [], []
    total = SEQUENCE * 3000
    while present and len(words) < total:
        # A piece goes on in the same language half of the time.
        language = gold[-1] if gold and random.random() < 0.5 else present[random.integers(len(present))]
        source = by_language[language][random.integers(len(by_language[language]))]
        size = int(random.integers(4, 41))
        at = int(random.integers(max(1, len(source) - size + 1)))
        piece = source[at:at + size]
        words += piece
        gold += [language] * len(piece)
    used = len(words) // SEQUENCE * SEQUENCE
    weights, transitions = np.zeros((FEATURES, k)), np.eye(k)
    if not used:
        return LanguageModel(languages, weights.astype(np.float32), transitions, lexicon)
    gold = np.array(gold[:used])
    different = sorted(set(words[:used]))
    number = {w: i for i, w in enumerate(different)}
    ids = np.array([number[w] for w in words[:used]])
    found = [word_features(w[:200], lexicon) for w in different]
    sizes = np.array([len(f) for f in found])
    columns = np.concatenate([np.array(f) for f in found])
    edges = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    owner = np.repeat(np.arange(len(different)), sizes)
    lengths = np.full(used // SEQUENCE, SEQUENCE)
    inner = (np.arange(used) % SEQUENCE) != SEQUENCE - 1
    pairs = np.flatnonzero(inner)
    seen_moves = np.zeros((k, k))
    np.add.at(seen_moves, (gold[pairs], gold[pairs + 1]), 1)
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    right = np.zeros((len(different), k))
    np.add.at(right, (ids, gold), 1)
    touched = np.unique(columns)
    for r in range(1, ROUNDS + 1):
        scores = np.add.reduceat(weights[columns], edges, axis=0)
        factors = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -30))
        p, filtered = marginals(lengths, factors[ids], transitions, with_filtered=True)
        believed = np.stack([np.bincount(ids, p[:, i], minlength=len(different)) for i in range(k)], axis=1)
        error = (believed - right) / used
        slope = np.stack([np.bincount(columns, error[owner, i], minlength=FEATURES) for i in range(k)], axis=1)
        slope[touched] += 1e-7 * weights[touched]
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope * slope
        weights -= 0.05 * (m / (1 - 0.9**r)) / (np.sqrt(v / (1 - 0.99**r)) + 1e-8)
        # Expected moves: P(from | to, words so far) x P(to | all words).
        move = np.exp(transitions - transitions.max())
        reach = filtered[pairs] @ move
        joint = filtered[pairs].T @ (p[pairs + 1] / reach) * move
        transitions += 2.0 * (seen_moves - joint) / len(pairs)
    return LanguageModel(languages, weights.astype(np.float32), transitions, lexicon)


def fit_languages(docs: DataFrame, rows: int = TRAIN_ROWS) -> LanguageModel:
    """A model from text and lang of documents whose crc32(doc_id) mod 5 is not 0.

    About ``rows`` of them, a quarter of an even part or all rows of every language
    (1.25 x ``rows`` at most), and TRAIN_WORDS consecutive words of each from a place that
    a hash of the text names, teach the model, each word with 200 letters at most. Rows
    that repeat count once. More than MOST_LANGUAGES languages raise a ValueError.
    """
    known = docs.filter("lang is not null and text is not null").filter(hash_part("doc_id", 5) != 0)
    known = known.select("doc_id", "text", "lang")
    counted = known.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counted) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = {r["lang"]: r["n"] for r in sorted(counted)}
    sample = sample_of_labels(known, "lang", ("doc_id", "text"), rows, counts)

    def run(texts, langs):
        for text, lang in zip(texts, langs):
            words = words_of(text)
            at = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) % max(1, len(words) - TRAIN_WORDS + 1)
            yield lang, [w[:200] for w in words[at:at + TRAIN_WORDS]]

    seen = map_columns(sample, ["text", "lang"], run, "lang string, words array<string>").collect()
    languages = sorted({r["lang"] for r in seen})
    seen.sort(key=lambda r: (r["lang"], r["words"]))
    return train([r["words"] for r in seen], [languages.index(r["lang"]) for r in seen], languages)


def label_documents(docs: DataFrame, model: LanguageModel, with_spans: bool = False) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_words, n_switches of every whole text, and spans if asked for.

    lang_pred has the largest mean probability over the words, which is score; ties go
    to the first in alphabetical order. NULL texts and texts without a letter are
    ``und`` with score 0, and so is everything if there was nothing to learn from.
    ``spans`` are (first word, end, lang) of every run of words in one language.
    Rows that repeat or lack a doc_id are labelled like any other.
    """
    def run(texts):
        look = Emissions(model)
        block: list[list[str]] = []
        size = 0
        for text in texts:
            block.append(words_of(text) if model.languages else [])
            size += len(block[-1])
            if size >= STEP_WORDS:
                yield from judge(look, block)
                block, size = [], 0
        yield from judge(look, block)

    def judge(look, block):
        lengths = np.array([len(words) for words in block if words], dtype=np.int64)
        edges = np.concatenate([[0], np.cumsum(lengths)])
        if len(lengths):
            emissions = np.concatenate([look.of(words) for words in block if words])
            p = marginals(lengths, emissions, model.transitions)
            means = np.add.reduceat(p, edges[:-1], axis=0) / lengths[:, None]
            label = p.argmax(axis=1)
        at = 0
        for words in block:
            if not words:
                row = UNKNOWN, 0.0, 0, 0
                yield (*row, []) if with_spans else row
                continue
            own = label[edges[at]:edges[at + 1]]
            turns = np.flatnonzero(np.diff(own)) + 1
            best = int(means[at].argmax())
            row = model.languages[best], float(min(1.0, means[at][best])), len(words), len(turns)
            at += 1
            if with_spans:
                cuts = [0, *turns.tolist(), len(words)]
                spans = [{"first": a, "end": b, "lang": model.languages[own[a]]} for a, b in zip(cuts, cuts[1:])]
                row = (*row, spans)
            yield row

    schema = "doc_id long, lang_pred string, score double, n_words int, n_switches int"
    schema += ", spans array<struct<first:int,end:int,lang:string>>" * with_spans
    made = map_columns(docs, ["text"], run, schema, ("doc_id",))
    held_out = (hash_part("doc_id", 5) == 0).alias("held_out")
    return made.select("doc_id", held_out, *(c for c in made.columns if c != "doc_id"))
