"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. The
patterns of votes are counted over the whole corpus, and expectation-maximisation on
these counts estimates how often each labeller is right. The posterior labels then
train a linear scorer on hashed words and word shapes, which scores whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cornerstore.llm.frames import bounded_sample, map_columns
from cornerstore.llm.linear import sigmoid, train_logistic

TRAIN_ROWS = 6_000
HASHES = 1 << 15
KEEP = 0.5
KNOWN_WORDS = 400_000
LONG_WORD = 200
_SYMBOLS = "#*$%&|<>{}[]\\^~="
_DROP_SYMBOLS = str.maketrans("", "", _SYMBOLS)
_ENDS = re.compile(r"[.!?]+(?=\s|$)")
LABELLERS = (
    "length", "symbols", "word_length", "repeated_words", "capitals", "repeated_lines", "sentences", "variety",
    "shouting", "bars", "plain_words",
)


def _vote(value: float, good: tuple[float, float], fair: tuple[float, float]) -> int:
    """1 within ``good``, -1 outside ``fair``, 0 between the two."""
    return 1 if good[0] <= value <= good[1] else 0 if fair[0] <= value <= fair[1] else -1


def votes(text: str | None) -> list[int]:
    """1 (good), -1 (bad) or 0 (silent) of each labeller on a whole text."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [-1] + [0] * (len(LABELLERS) - 1)
    size = sum(map(len, words))
    different = len(set(words))
    runs = len(words) - 2
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / runs if runs > 0 else 0.0
    lines = [line for line in text.split("\n") if line.strip()]
    capitals = sum(map(str.isupper, words)) / n
    ends = len(_ENDS.findall(text))
    signs = (len(text) - len(text.translate(_DROP_SYMBOLS))) / n
    bars = sum(w in ("|", "-", "*", "•") for w in words) / n
    shouts = sum(w.endswith(("!!", "??")) for w in words) / n
    plain = sum(w.strip(".,;:!?\"'()").isalnum() for w in words) / n
    return [
        _vote(n, (80, 1e9), (3, 1e9)),
        _vote(signs, (0, 0.02), (0, 0.1)),
        _vote(size / n, (3, 10), (2, 15)),
        0 if runs < 20 else _vote(repeated, (0, 0.05), (0, 0.3)),
        0 if n < 10 else _vote(capitals, (0, 0.15), (0, 0.4)),
        0 if len(lines) < 4 else _vote(1 - len(set(lines)) / len(lines), (0, 0.1), (0, 0.3)),
        0 if n < 40 else _vote(n / max(ends, 1), (3, 40), (2, 120)),
        0 if n < 50 else _vote(different / n * min(1.0, (n / 300) ** 0.5), (0.08, 1), (0.03, 1)),
        0 if n < 10 else _vote(shouts, (0, 0.02), (0, 0.2)),
        0 if n < 10 else _vote(bars, (0, 0.02), (0, 0.15)),
        0 if n < 10 else _vote(plain, (0.85, 1), (0.6, 1)),
    ]


def fit_labellers(
    patterns: np.ndarray, counts: np.ndarray, assumed_bad: float = 0.99, assumed_good: float = 0.92, rounds: int = 200
) -> tuple[np.ndarray, dict]:
    """Posterior of good per vote pattern, and the labellers' accuracies, by expectation-maximisation.

    ``patterns`` holds votes (1, -1, 0), ``counts`` how many documents have each. The
    accuracies are P(bad | bad vote) and P(good | good vote) of each labeller. What is
    assumed of them before anything is seen weighs as much as its votes, since a fault
    that only one labeller sees would else count as that labeller's error. Silence says
    nothing about the class.
    """
    counts = counts.astype(float)
    total = counts.sum()
    bad, good = (patterns < 0).astype(float), (patterns > 0).astype(float)
    n_bad, n_good = counts @ bad, counts @ good
    trust_bad, trust_good = np.maximum(n_bad, 20), np.maximum(n_good, 20)
    belief = np.where(bad.any(axis=1), 0.1, 0.95)
    share = 0.8
    for _ in range(rounds):
        share = float(np.clip((counts @ belief + 8) / (total + 10), 0.01, 0.99))
        right_bad = ((counts * (1 - belief)) @ bad + trust_bad * assumed_bad) / (n_bad + trust_bad)
        right_good = ((counts * belief) @ good + trust_good * assumed_good) / (n_good + trust_good)
        # Chance of a bad vote in either class, among the documents that the labeller speaks on.
        if_bad = (right_bad * n_bad + 0.5) / (right_bad * n_bad + (1 - right_good) * n_good + 1)
        if_good = ((1 - right_bad) * n_bad + 0.5) / ((1 - right_bad) * n_bad + right_good * n_good + 1)
        logit = np.log(share / (1 - share))
        logit = logit + bad @ np.log(if_good / if_bad) + good @ np.log((1 - if_good) / (1 - if_bad))
        after = sigmoid(logit)
        done = np.abs(after - belief).max() < 1e-6
        belief = after
        if done:
            break
    return belief, {"good_vote": right_good, "bad_vote": right_bad, "share": share}


def shape(word: str) -> str:
    """Upper and lower case letters and digits as X, x, 9, other signs as they are, without repeats."""
    out = []
    for c in word:
        kind = ("X" if c.isupper() else "x") if c.isalpha() else "9" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class _Hashes(dict):
    """Word -> hashed numbers of the whole word in lower case and of its shape. Long words are not held."""

    def __missing__(self, word: str) -> tuple[int, int]:
        names = ("w:" + word.lower(), "s:" + shape(word))
        both = tuple(xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass")) % HASHES for n in names)
        if len(word) <= LONG_WORD:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = both
        return both


_hashes = _Hashes()


def hashed(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of a whole text's features; the squares of the values add up to 1."""
    words = Counter((text or "").split())
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    both = np.array([_hashes[w] for w in words])
    weight = np.fromiter(words.values(), dtype=np.float64, count=len(words))
    total = np.bincount(both[:, 0], weight) if len(both) else np.zeros(0)
    numbers = np.flatnonzero(total)
    values = np.log1p(total[numbers])
    shapes = np.bincount(both[:, 1], weight)
    marks = np.flatnonzero(shapes)
    # The shares of the shapes count as much as all words together.
    values = values / np.sqrt((values * values).sum()) * 0.7
    shares = shapes[marks] / weight.sum()
    shares = shares / np.sqrt((shares * shares).sum()) * 0.7
    return np.concatenate([numbers, marks]), np.concatenate([values, shares])


@dataclass
class QualityModel:
    """Weights of HASHES features and a bias; the labellers' accuracies for reference."""

    weights: np.ndarray
    bias: float
    accuracy: dict

    def score(self, text: str | None) -> float:
        numbers, values = hashed(text)
        return float(sigmoid(self.bias + (self.weights[numbers] * values).sum()))


def fit_quality(docs: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel:
    """Accuracies from all documents, and a scorer from at most about ``rows`` of them. No given label is used.

    Rows that repeat (doc_id and text) count once in the scorer's sample, so that its
    size holds however often they do.
    """
    def vote(texts):
        for text in texts:
            yield ("".join("-0+"[v + 1] for v in votes(text)),)

    # At most 3 ** labellers patterns exist; few do.
    counted = map_columns(docs, ["text"], vote, "pattern string").groupBy("pattern").agg(F.count("*").alias("n")).collect()
    if not counted:
        return QualityModel(np.zeros(HASHES), 0.0, {})
    counted.sort(key=lambda r: r["pattern"])
    patterns = np.array([["-0+".index(c) - 1 for c in r["pattern"]] for r in counted])
    counts = np.array([r["n"] for r in counted])
    belief, found = fit_labellers(patterns, counts)
    posterior = {r["pattern"]: float(b) for r, b in zip(counted, belief)}
    sample = bounded_sample(docs.select("doc_id", "text"), ("doc_id", "text"), rows, int(counts.sum())).distinct()

    def features(texts):
        for text in texts:
            numbers, values = hashed(text)
            pattern = "".join("-0+"[v + 1] for v in votes(text))
            yield posterior[pattern], numbers.astype("<i4").tobytes(), values.astype("<f4").tobytes()

    seen = map_columns(sample, ["text"], features, "p double, numbers binary, weights binary").collect()
    numbers = [np.frombuffer(r["numbers"], "<i4") for r in seen]
    values = [np.frombuffer(r["weights"], "<f4") for r in seen]
    target = np.array([r["p"] for r in seen])
    if not len(seen):
        return QualityModel(np.zeros(HASHES), float(np.log(found["share"] / (1 - found["share"]))), found)
    lengths = np.array([len(x) for x in numbers])
    weights, bias = train_logistic(
        lengths, np.concatenate(numbers).astype(np.int64), np.concatenate(values).astype(np.float64), target, HASHES, l2=0.05,
    )
    return QualityModel(weights, bias, found)


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id, score (0 to 1), kept (score at least 0.5) of every whole text.

    NULL and empty texts have no feature; their score is that of the bias alone, but
    they are never kept. Rows that repeat or lack a doc_id are scored like any other.
    An empty table gives an empty result; extra columns play no part.
    """
    def run(texts):
        for text in texts:
            value = model.score(text)
            yield value, bool(value >= KEEP and text and not text.isspace())

    return map_columns(docs, ["text"], run, "doc_id long, score double, kept boolean", ("doc_id",))

