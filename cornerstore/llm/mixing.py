"""Mixing to target weights with soft domain membership, in DataFrame functions only.

A naive Bayes table (hashed word, log-probability per domain), counted on labelled
rows, is joined to the words of every document and gives domain posteriors. Then
projected-gradient least squares fits a nonnegative rate per document so that the
expected tokens per domain, sum of rate x tokens x posterior, match the targets.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cornerstore.llm.frames import bounded_sample
from cornerstore.session import write_and_reread

BUCKETS = 1 << 14
LABELLED_ROWS = 20_000
MOST_DOMAINS = 64
EVIDENCE = 8
TOLERANCE = 1e-3
CUT_LINEAGE = 10


def _words(text: Column) -> Column:
    """The words of a whole text in lower case; NULL has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _bucketed(docs: DataFrame, *keep: str) -> DataFrame:
    words = docs.select(*keep, F.explode(_words(F.col("text"))).alias("_word"))
    return words.select(*keep, F.pmod(F.xxhash64("_word"), F.lit(BUCKETS)).cast("int").alias("_bucket"))


def domain_table(labelled: DataFrame, rows: int = LABELLED_ROWS) -> tuple[DataFrame, list[str], list[float]]:
    """(table of _bucket and one log-likelihood column per domain, the domains, their log priors).

    ``labelled`` has doc_id, text, domain. The table is counted on at most about
    ``rows`` labelled rows and has at most BUCKETS rows.
    """
    known = labelled.filter("domain is not null")
    sample = bounded_sample(known, "doc_id", rows, known.count())
    counts = _bucketed(sample, "domain").groupBy("_bucket", "domain").agg(F.count("*").alias("n"))
    counts = write_and_reread(counts, "mixing-counts")
    totals = {r["domain"]: r["n"] for r in counts.groupBy("domain").agg(F.sum("n").alias("n")).limit(MOST_DOMAINS + 1).collect()}
    if len(totals) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    domains = sorted(totals)
    if not domains:
        return counts.select("_bucket"), [], []
    smooth = 0.5
    columns = [
        F.log(
            (F.coalesce(F.sum(F.when(F.col("domain") == d, F.col("n"))), F.lit(0)) + smooth)
            / (totals[d] + smooth * BUCKETS)
        ).alias(f"_l{k}")
        for k, d in enumerate(domains)
    ]
    everything = sum(totals.values())
    return counts.groupBy("_bucket").agg(*columns), domains, [math.log(totals[d] / everything) for d in domains]


def posteriors(docs: DataFrame, model: DataFrame, domains: list[str], priors: list[float]) -> DataFrame:
    """doc_id, n_tokens, p0, p1, ... (one posterior per domain) of every document.

    A document counts as at most EVIDENCE words of evidence, which keeps the
    memberships of long texts soft. Texts without words have the priors.
    """
    each = range(len(domains))
    # A word whose bucket no labelled row has says nothing about the domain.
    known = _bucketed(docs, "doc_id").join(F.broadcast(model), "_bucket", "left")
    sums = known.groupBy("doc_id").agg(
        F.count("*").alias("n_tokens"), *(F.sum(F.coalesce(f"_l{k}", F.lit(0.0))).alias(f"_s{k}") for k in each)
    )
    everyone = docs.groupBy("doc_id").agg(F.count("*").alias("_rows"))
    all_docs = everyone.join(sums.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    scale = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.col("n_tokens"))
    logits = [F.coalesce(F.col(f"_s{k}") * scale, F.lit(0.0)) + priors[k] for k in each]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    scored = all_docs.select("doc_id", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), *(x.alias(f"_z{k}") for k, x in enumerate(logits)), top.alias("_top"))
    weights = scored.select("doc_id", "n_tokens", *(F.exp(F.col(f"_z{k}") - F.col("_top")).alias(f"_w{k}") for k in each))
    total = sum((F.col(f"_w{k}") for k in each), F.lit(0.0))
    return weights.select("doc_id", "n_tokens", *((F.col(f"_w{k}") / total).alias(f"p{k}") for k in each))


def fit_rates(
    members: DataFrame, weights: list[float | None], total_tokens: float | None = None, most_rounds: int = 100
) -> tuple[DataFrame, dict]:
    """``members`` with rate (double), and the achieved against the target totals.

    Minimises the squared distance of the expected domain totals to ``weights`` x
    ``total_tokens`` by projected gradient in the metric of the documents' tokens,
    from rate 1 on. One small sum per round reaches the driver. A weight of None is the
    domain's share of the tokens as they are; the others divide the rest.

    With ``total_tokens``, or with a weight of 0, rates are at least 0. Else no rate is
    below 1, and the total is the smallest at which rates that are a mean of one
    number per domain, weighed by the document's posteriors, meet the targets without
    one of these numbers below 1. Where there is no such total, the smallest at which
    no domain has to shrink is taken, and the targets are met as nearly as rates from 1 on allow.

    The rounds end when the totals are within ``TOLERANCE`` of the targets, or stand
    still; the report has the rounds and the largest gap as a share of the total.
    """
    k = range(len(weights))
    given = np.array([0.0 if w is None else w for w in weights], dtype=float)
    natural_share = np.array([w is None for w in weights], dtype=bool)
    if len(given) == 0 or (given < 0).any() or (given.sum() <= 0 and not natural_share.any()):
        raise ValueError("target weights must be nonnegative and not all zero")
    least = 1.0 if total_tokens is None and (natural_share | (given > 0)).all() else 0.0
    pairs = [(i, j) for i in k for j in k if i <= j]
    first = members.agg(
        F.sum("n_tokens").alias("n"),
        *(F.sum(F.col("n_tokens") * F.col(f"p{i}")).alias(f"s{i}") for i in k),
        *(F.sum(F.col("n_tokens") * F.col(f"p{i}") * F.col(f"p{j}")).alias(f"m{i}_{j}") for i, j in pairs),
    ).first()
    tokens = float(first["n"] or 0)
    state = members.withColumn("rate", F.lit(1.0))
    if not tokens:
        return state, {"achieved": [0.0 for _ in k], "target": [0.0 for _ in k], "rounds": 0}
    natural = np.array([first[f"s{i}"] for i in k]) / tokens
    goal = np.where(natural_share, natural, 0.0)
    if given.sum() > 0:
        goal += given / given.sum() * natural[~natural_share].sum()
    goal = goal / goal.sum()
    gram = np.array([[first[f"m{min(i, j)}_{max(i, j)}"] for j in k] for i in k]) / tokens
    # Rates sum_i c_i p_i have the totals gram @ c; c = 1 gives the totals as they are.
    per_domain = np.linalg.lstsq(gram, goal, rcond=None)[0]
    if total_tokens is not None:
        size = total_tokens / tokens
    elif least and per_domain.min() > 0 and np.abs(gram @ per_domain - goal).max() <= TOLERANCE:
        size = max(1.0, 1 / per_domain.min())
    else:
        size = max([natural[i] / goal[i] for i in k if goal[i] > 0])
    target = goal * size
    step = 1.8 / float(np.linalg.eigvalsh(gram)[-1])
    achieved, rounds, gaps = natural, 0, [np.abs(natural - target).max()]
    while gaps[-1] > TOLERANCE * size and rounds < most_rounds and not _still(gaps):
        slope = step * (achieved - target)
        move = sum((F.col(f"p{i}") * float(slope[i]) for i in k), F.lit(0.0))
        state = state.withColumn("rate", F.greatest(F.lit(least), F.col("rate") - move))
        rounds += 1
        if rounds % CUT_LINEAGE == 0:
            state = write_and_reread(state, "mixing-rates")
        sums = state.agg(*(F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p{i}")) for i in k)).first()
        achieved = np.array(sums, dtype=float) / tokens
        gaps.append(np.abs(achieved - target).max())
    return state, {
        "achieved": (achieved * tokens).tolist(), "target": (target * tokens).tolist(), "rounds": rounds,
        "gap": float(gaps[-1] / size),
    }


def _still(gaps: list[float], rounds: int = 10, share: float = 0.01) -> bool:
    """Whether the largest gap has not shrunk by that share over the last rounds."""
    return len(gaps) > rounds and min(gaps[-rounds:]) > (1 - share) * min(gaps[:-rounds])


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    total_tokens: float | None = None,
    labelled_rows: int = LABELLED_ROWS,
) -> DataFrame:
    """doc_id, n_tokens, domain, posteriors (map), rate, copies of every doc_id.

    ``labelled`` (doc_id, text, domain) teaches the domains, ``targets`` weighs
    them; a target that no labelled row has raises ValueError. A domain without a
    target has weight 0 if there is a total, else its natural share. Without a total
    and a target of 0, no rate is below 1, so that no document is lost. ``copies`` is the rate rounded up or down by a hash of
    doc_id, so that its mean over documents is the rate. Rows that share a doc_id,
    and rows without one, are weighed together as one document. Texts that are NULL
    or have no word have 0 tokens, the priors as posteriors, and a rate that no
    total depends on. No labelled row: every rate is 1, domain NULL.
    """
    model, domains, priors = domain_table(labelled, labelled_rows)
    if not domains:
        return docs.groupBy("doc_id").agg(
            F.sum(F.size(_words(F.col("text")))).cast("long").alias("n_tokens"),
            F.lit(None).cast("string").alias("domain"), F.lit(None).cast("map<string,double>").alias("posteriors"),
            F.lit(1.0).alias("rate"), F.lit(1).alias("copies"),
        )
    if unknown := sorted(set(targets) - set(domains)):
        raise ValueError(f"no labelled rows for {unknown}")
    members = write_and_reread(posteriors(docs, model, domains, priors), "mixing-members")
    untold = None if total_tokens is None else 0.0
    rated, _ = fit_rates(members, [targets.get(d, untold) for d in domains], total_tokens)
    each = range(len(domains))
    best = F.greatest(*(F.col(f"p{k}") for k in each)) if len(domains) > 1 else F.col("p0")
    domain = F.coalesce(*(F.when(F.col(f"p{k}") == best, F.lit(d)) for k, d in enumerate(domains)))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    entries = [x for k, d in enumerate(domains) for x in (F.lit(d), F.col(f"p{k}"))]
    return rated.select(
        "doc_id", "n_tokens", domain.alias("domain"), F.create_map(*entries).alias("posteriors"), "rate",
        F.floor(F.col("rate") + chance).cast("int").alias("copies"),
    )


def known_targets(labelled: DataFrame, targets: dict[str, float]) -> dict[str, float]:
    """The targets whose domain occurs in ``labelled``."""
    found = labelled.filter(F.col("domain").isin(*targets)).select("domain").distinct().collect()
    return {r["domain"]: targets[r["domain"]] for r in found}


def apply_mix(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``docs`` with every row as often as its document has copies."""
    times = mixed.filter("copies <> 1").select(F.col("doc_id").alias("_mix_id"), F.col("copies").alias("_copies"))
    joined = docs.join(times, F.col("doc_id").eqNullSafe(F.col("_mix_id")), "left")
    repeat = F.explode(F.when(F.coalesce("_copies", F.lit(1)) > 0, F.sequence(F.lit(1), F.coalesce("_copies", F.lit(1)))))
    return joined.select(*(docs[c] for c in docs.columns), repeat.alias("_copy")).drop("_copy")
