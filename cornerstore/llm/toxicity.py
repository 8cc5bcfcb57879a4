"""Toxicity by weak supervision.

Many voters look at a text: lexicon voters (one word each) and pattern voters (a
word stem, shouting, disguised spelling, no hit at all). Words and stems come from
labelled training rows. A generative model, fitted by expectation-maximisation
without labels, estimates how often each voter speaks given the class and how
voters are correlated beyond the class; correlated voters share their weight. A
linear classifier is trained on the posterior labels and scores whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cornerstore.llm.frames import bounded_sample, hash_part, map_columns, ship
from cornerstore.llm.linear import sigmoid, train_logistic
from cornerstore.session import write_and_reread

TRAIN_ROWS = 12_000
MOST_VOTERS = 96
MOST_FEATURES = 4_000
LEAST_ROWS = 4
LEAST_ODDS = 3.0
LEAST_EVIDENCE = 40.0  # likelihood-ratio statistic; among a million rare words chance reaches about 30
LEAST_CORRELATION = 0.2
THRESHOLD = 0.3
# Common insults that vote from the start, whether or not labelled rows have them.
SEEDS = (
    "idiot idiots moron morons stupid dumb loser losers trash garbage scum pathetic worthless disgusting clown "
    "fool fools vermin filth freak creep coward imbecile jerk bastard crap retard shut screw hate kill"
).split()
_WORD = re.compile(r"[^\W\d_]+")
_DISGUISED = re.compile(r"[^\W_]*[0-9@$!|][^\W_][\w@$!|]*")
_PLAIN = str.maketrans("013457@$!|", "oleastasil")


def words_of(text: str | None) -> set[str]:
    """The different words of a whole text in lower case, and marks of its form that start with #."""
    text = text or ""
    found = set(_WORD.findall(text.lower()))
    if sum(len(w) > 2 and w.isupper() for w in set(_WORD.findall(text))) * 2 > len(found):
        found.add("#shout")
    return found


def disguised(text: str | None, lexicon: frozenset[str]) -> bool:
    """Whether a word is one of ``lexicon`` once digits and signs stand for letters."""
    return any(w.lower().translate(_PLAIN) in lexicon for w in _DISGUISED.findall(text or ""))


def stems(word: str) -> list[str]:
    return [word[:k] + "*" for k in (4, 5, 6) if len(word) > k and word[0] != "#"]


def _sketches(text: str) -> list[int]:
    """Three smallest hashes of three words in a row, by three orders: near copies mostly share each."""
    words = text.lower().split()
    runs = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
    hashes = np.array([xxhash.xxh64_intdigest(" ".join(r).encode("utf-8", "surrogatepass")) for r in runs], dtype=np.uint64)
    return [int((hashes * np.uint64(m)).min() >> np.uint64(1)) for m in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]


@dataclass
class ToxicityModel:
    """Weights of words, stems (ending in *) and marks (starting with #), and a bias. Bounded in size."""

    weights: dict[str, float]
    bias: float
    lexicon: frozenset[str]

    def scorer(self):
        own = self.weights

        class Known(dict):
            def __missing__(self, word):
                found = tuple(f for f in (word, *stems(word)) if f in own)
                if len(self) >= 400_000:
                    self.clear()
                self[word] = found
                return found

        known = Known()

        def score(text: str | None) -> float:
            found = set()
            for hit in map(known.__getitem__, words_of(text)):
                if hit:
                    found.update(hit)
            if "#disguise" in own and disguised(text, self.lexicon):
                found.add("#disguise")
            return float(sigmoid(self.bias + sum(own[f] for f in sorted(found))))

        return score


def label_model(votes: np.ndarray, assumed: float = 0.98, rounds: int = 60) -> tuple[np.ndarray, dict]:
    """Posterior of class 1 per row of ``votes`` (rows x voters of 1, -1 or 0 = silent).

    Expectation-maximisation over the share of class 1 and P(vote | class) of every
    voter. Each round, the correlation of every two voters that the class does not
    explain is measured, and a voter's log-odds count 1 / (1 + sum of its
    correlations), so that ten forms of one rule don't count ten times. Voters are
    ``assumed`` to be right as often before anything is seen, which weighs as much as
    their votes: else voters of different languages, which never speak together, would
    pass for different classes.
    """
    rows, voters = votes.shape
    fires = votes != 0
    sign = np.where((votes < 0).any(axis=0), -1, 1)
    spoke = fires.sum(axis=0).astype(float)
    trust = np.maximum(spoke, 20.0)
    belief = np.where((votes > 0).any(axis=1), 0.9, 0.02)
    for _ in range(rounds):
        one, zero = belief.sum(), (1 - belief).sum()
        prior = float(np.clip(one / rows, 0.5 / rows, 0.5))
        right = np.where(sign > 0, belief @ fires, (1 - belief) @ fires)
        accuracy = np.clip((right + trust * assumed) / (spoke + trust), 0.5, 0.995)
        of_one = np.where(sign > 0, accuracy, 1 - accuracy) * spoke
        rate1 = np.clip((of_one + 0.1) / (one + 0.2), 1e-5, 1 - 1e-5)
        rate0 = np.clip((spoke - of_one + 0.1) / (zero + 0.2), 1e-5, 1 - 1e-5)
        expected = np.outer(belief, rate1) + np.outer(1 - belief, rate0)
        rest = fires - expected
        spread = np.sqrt((rest * rest).mean(axis=0)) + 1e-6
        correlation = (rest.T @ rest) / rows / np.outer(spread, spread)
        np.fill_diagonal(correlation, 0)
        share = 1 / (1 + np.where(correlation >= LEAST_CORRELATION, correlation, 0).sum(axis=1))
        spoken = np.log(rate1 / rate0) * share
        silent = np.log((1 - rate1) / (1 - rate0)) * share
        logit = np.log(prior / (1 - prior)) + fires @ spoken + (~fires) @ silent
        after = sigmoid(logit)
        if np.abs(after - belief).max() < 1e-4:
            belief = after
            break
        belief = after
    return belief, {"accuracy": accuracy, "correlation": correlation, "share": share}


def _training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """words (distinct), disguise candidates, toxic of a bounded sample of labelled training rows.

    Near copies (equal sketches) count once, since their words all look alike: of them
    the smallest doc_id stays. Of texts that share a doc_id the one with the least hash is taken.
    """
    known = labels.filter("toxic is not null and doc_id is not null").filter(hash_part("doc_id", 4) != 2)
    known = known.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = bounded_sample(known, "_id", rows, known.count())
    # At most about ``rows`` rows of two numbers: small enough to send to every executor.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id")).groupBy("_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.min("toxic").alias("toxic")
    )

    def run(texts, toxic):
        for text, mark in zip(texts, toxic):
            odd = sorted(set(_DISGUISED.findall((text or "").lower())))
            yield *_sketches(text or ""), mark, sorted(words_of(text)), odd

    columns = ["_id", "s1", "s2", "s3", "toxic", "words", "odd"]
    schema = "_id long, s1 long, s2 long, s3 long, toxic int, words array<string>, odd array<string>"
    sample = map_columns(texts.withColumn("_id", F.col("_id").cast("long")), ["text", "toxic"], run, schema, ("_id",))
    for sketch in ("s1", "s2", "s3"):
        sample = sample.groupBy(sketch).agg(F.min(F.struct(*columns)).alias("r")).select("r.*")
    return write_and_reread(sample.drop("_id"), "toxicity-sample")


def _features(sample: DataFrame) -> DataFrame:
    """f, toxic (rows with it), plain (rows without a toxic label with it)."""
    def cut(k: int):
        long = F.filter("words", lambda w: (F.length(w) > k) & ~w.startswith("#"))
        return F.transform(long, lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))

    made = F.concat(F.col("words"), *(cut(k) for k in (4, 5, 6)))
    each = sample.select("toxic", F.explode(F.array_distinct(made)).alias("f"))
    return each.groupBy("f").agg(
        F.sum("toxic").cast("long").alias("toxic"), F.sum(1 - F.col("toxic")).cast("long").alias("plain")
    )


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """A model from the labelled rows whose crc32(doc_id) mod 4 is not 2, at most about ``rows`` of them."""
    sample = _training_rows(docs, labels, rows)
    total, positive = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not positive or positive == total:
        return ToxicityModel({}, float("-inf") if not positive else float("inf"), frozenset())
    features = _features(sample).filter(F.col("toxic") + F.col("plain") >= LEAST_ROWS)
    odds = F.log((F.col("toxic") + 0.5) / (positive + 1)) - F.log((F.col("plain") + 0.5) / (total - positive + 1))
    seen, part = F.col("toxic") + F.col("plain"), positive / total
    evidence = 2 * (
        F.when(F.col("toxic") > 0, F.col("toxic") * F.log(F.col("toxic") / (seen * part))).otherwise(0)
        + F.when(F.col("plain") > 0, F.col("plain") * F.log(F.col("plain") / (seen * (1 - part)))).otherwise(0)
    )
    ranked = features.select("f", "toxic", odds.alias("odds"), evidence.alias("evidence"))
    ranked = ranked.filter(F.col("evidence") >= LEAST_EVIDENCE)
    # A bounded number of features: the ones that tell the classes apart best.
    chosen = ranked.orderBy(F.desc("evidence"), "f").limit(MOST_FEATURES).collect()
    strong = [r for r in chosen if r["odds"] >= LEAST_ODDS and not r["f"].startswith("#")]
    # Of a word and its stems the one with the most evidence votes; of equal ones the longest.
    strong.sort(key=lambda r: (-round(r["evidence"], 6), -len(r["f"]), r["f"]))
    voters: list[str] = []

    def related(a: str, b: str) -> bool:
        a, b = sorted((a.rstrip("*"), b.rstrip("*")), key=len)
        return b.startswith(a)

    for r in strong:
        if len(voters) < MOST_VOTERS and not any(related(r["f"], v) for v in voters):
            voters.append(r["f"])
    voters += [w for w in SEEDS if not any(w == v or (v.endswith("*") and w.startswith(v[:-1])) for v in voters)]
    lexicon = frozenset(v for v in voters if not v.endswith("*")) | frozenset(SEEDS)
    other = [r["f"] for r in chosen if r["odds"] < 0 or r["f"].startswith("#")]
    index = {f: i for i, f in enumerate(dict.fromkeys([*other, *voters, "#disguise"]))}
    number = {v: i for i, v in enumerate(voters)}
    nothing, shout, disguise = len(voters), len(voters) + 1, len(voters) + 2

    def look(words, odd):
        for own, strange in zip(words, odd):
            found = {f for w in own for f in (w, *stems(w))}
            votes = sorted(number[f] for f in found if f in number)
            if not votes:
                votes.append(nothing)
            if "#shout" in found:
                votes.append(shout)
            if any(w.translate(_PLAIN) in lexicon for w in strange):
                votes.append(disguise)
                found.add("#disguise")
            yield sorted(index[f] for f in found if f in index), votes

    seen = map_columns(sample, ["words", "odd"], look, "has array<int>, votes array<int>").collect()
    votes = np.zeros((len(seen), len(voters) + 3), dtype=np.int8)
    for i, r in enumerate(seen):
        votes[i, r["votes"]] = 1
    votes[:, nothing] *= -1
    belief, found = label_model(votes)
    # Each toxic voter also teaches the classifier on its own, as a text that has no other sign.
    rows = [r["has"] for r in seen] + [[index[v]] for v in voters]
    target = np.concatenate([belief, found["accuracy"][:len(voters)]])
    lengths = np.array([len(r) for r in rows])
    columns = np.fromiter((c for r in rows for c in r), dtype=np.int64, count=int(lengths.sum()))
    weights, bias = train_logistic(lengths, columns, np.ones(len(columns)), target, len(index), l2=0.03, rounds=300)
    return ToxicityModel({f: float(weights[i]) for f, i in index.items() if abs(weights[i]) > 1e-3}, bias, lexicon)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text.

    NULL and empty texts have no word and get the score of a text without any
    sign. Without labels of both classes every score is 0 (or 1, if all training
    labels are toxic). Rows that repeat or lack a doc_id are scored like any
    other; extra columns, and documents without label, play no part.
    """
    def run(texts):
        score = model.scorer()
        for text in texts:
            value = score(text)
            yield value, int(value >= THRESHOLD)

    scored = map_columns(docs, ["text"], run, "doc_id long, score double, predicted int", ("doc_id",))
    return scored.select("doc_id", (hash_part("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``docs`` without the texts that are scored as toxic; no shuffle, all columns as they were."""
    ship(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            kept = [score(text.as_py()) < THRESHOLD for text in batch.column(at)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
