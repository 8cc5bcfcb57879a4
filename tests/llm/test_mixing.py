import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cornerstore.llm import mixing, queries


def labelled(docs):
    return docs.select("doc_id", "text", F.col("lang").alias("domain"))


def test_targets_are_met_over_the_whole_table(spark, small):
    rows = queries.op1_mixing_sources(spark, small).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == 1000
    goal = queries.MIX_TARGETS
    totals = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in rows) for d in goal}
    size = sum(totals.values())
    assert all(abs(totals[d] / size - goal[d]) < 3e-3 for d in goal)
    assert all(r.rate >= 0 and math.isclose(sum(r[f"p_{d}"] for d in goal), 1, rel_tol=1e-9) for r in rows)
    assert all(r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) for r in rows)


def test_domains_are_recognised(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = queries.op1_mixing_sources(spark, small).join(docs.select("doc_id", "lang"), "doc_id")
    right, all_rows = found.agg(F.sum((F.col("domain") == F.col("lang")).cast("int")), F.count("*")).first()
    assert right > 0.98 * all_rows


def test_posteriors_equal_a_plain_classifier(spark):
    rows = [(k, t, d) for k, (t, d) in enumerate([("a a b", "x"), ("a c", "x"), ("c c d", "y"), ("", "y"), (None, "x"), ("zz", None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    model, domains, priors = mixing.domain_table(docs)
    assert domains == ["x", "y"] and np.allclose(priors, np.log([5 / 8, 3 / 8]))
    counts = {"x": {"a": 3, "b": 1, "c": 1}, "y": {"c": 2, "d": 1}}
    total = {d: sum(c.values()) for d, c in counts.items()}
    likely = lambda w, d: math.log((counts[d].get(w, 0) + 0.5) / (total[d] + 0.5 * mixing.BUCKETS))
    found = {r.doc_id: (r.n_tokens, r.p0) for r in mixing.posteriors(docs, model, domains, priors).collect()}
    for k, text, _ in rows:
        words = (text or "").split()
        known = [w for w in words if w in "abcd"]
        scale = min(1, mixing.EVIDENCE / max(1, len(words)))
        z = [p + scale * sum(likely(w, d) for w in known) for p, d in zip(priors, domains)]
        assert found[k][0] == len(words)
        assert math.isclose(found[k][1], 1 / (1 + math.exp(z[1] - z[0])), rel_tol=1e-9)


def test_rates_minimise_the_distance(spark):
    """Projected gradient comes as near as a plain solver that tries rates per document."""
    random = np.random.default_rng(1)
    p = random.dirichlet([0.3, 0.3, 0.3], 80)
    n = random.integers(1, 50, 80)
    rows = [(k, int(n[k]), *map(float, p[k])) for k in range(80)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    rated, told = mixing.fit_rates(members, [0.7, 0.3, 0.0], total_tokens=float(n.sum()))
    rates = np.array([r.rate for r in rated.orderBy("doc_id").collect()])
    assert (rates >= 0).all() and (rates == 0).any()
    reached = (rates * n) @ p
    assert np.allclose(reached, told["achieved"])
    plain = np.ones(80)
    for _ in range(20_000):
        plain = np.maximum(0, plain - 0.5 * p @ (((plain * n) @ p - np.array([0.7, 0.3, 0.0]) * n.sum()) / n.sum()))
    best = np.abs((plain * n) @ p - np.array(told["target"])).max()
    assert np.abs(reached - told["target"]).max() <= best + 0.02 * n.sum()


def test_no_domain_shrinks_without_a_total(spark):
    members = spark.createDataFrame([(1, 90, 1.0, 0.0), (2, 10, 0.0, 1.0)], "doc_id long, n_tokens long, p0 double, p1 double")
    rated, _ = mixing.fit_rates(members, [0.5, 0.5])
    rates = {r.doc_id: r.rate for r in rated.collect()}
    assert rates[1] == pytest.approx(1, abs=0.01) and rates[2] == pytest.approx(9, abs=0.1)


def test_edge_rows(spark, edge_docs, no_docs):
    mixed = mixing.mix(edge_docs, labelled(edge_docs), {"en": 0.6, "de": 0.4})
    rows = {r.doc_id: r for r in mixed.collect()}
    assert set(rows) == {r.doc_id for r in edge_docs.collect()}
    assert rows[1].n_tokens == rows[2].n_tokens == rows[3].n_tokens == 0 and rows[5].n_tokens == 20_000
    assert rows[7].n_tokens == 240
    again = mixing.apply_mix(edge_docs, mixed)
    assert again.schema == edge_docs.schema
    counts = {r.doc_id: r["count"] for r in again.groupBy("doc_id").count().collect()}
    given = {r.doc_id: r["count"] for r in edge_docs.groupBy("doc_id").count().collect()}
    assert counts == {i: n * rows[i].copies for i, n in given.items() if rows[i].copies}
    assert mixing.mix(no_docs, labelled(no_docs), {"en": 1.0}).count() == 0
    unlabelled = mixing.mix(edge_docs, labelled(no_docs), {})
    assert {r.rate for r in unlabelled.collect()} == {1.0}
    with pytest.raises(ValueError):
        mixing.mix(edge_docs, labelled(edge_docs), {"xx": 1.0})
    assert mixing.known_targets(labelled(edge_docs), {"en": 0.5, "xx": 0.5}) == {"en": 0.5}


def test_copies_average_to_the_rate(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'a b c' as text", "if(id % 4 = 0, 'x', 'y') as domain")
    mixed = mixing.mix(docs.selectExpr("doc_id", "if(domain = 'x', 'a b c', 'd e f') as text"),
                       docs.selectExpr("doc_id", "if(domain = 'x', 'a b c', 'd e f') as text", "domain"), {"x": 0.5, "y": 0.5})
    x = mixed.filter("domain = 'x'").agg(F.avg("rate"), F.avg("copies")).first()
    assert x[0] == pytest.approx(3, abs=0.05) and x[1] == pytest.approx(x[0], abs=0.1)


def test_main_path_has_no_python(spark, small):
    plan = queries.op1_mixing_sources(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_no_rate_below_one_without_a_total(spark):
    """Soft members of a tight domain keep rate 1 while those of the rarer domain are raised."""
    random = np.random.default_rng(4)
    p = np.concatenate([random.dirichlet([9, 1, 1], 60), random.dirichlet([1, 6, 1], 30), random.dirichlet([1, 1, 6], 10)])
    rows = [(k, int(random.integers(5, 50)), *map(float, p[k])) for k in range(100)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double")
    rates = [r.rate for r in mixing.fit_rates(members, [0.4, 0.3, 0.3])[0].collect()]
    assert min(rates) >= 1 and max(rates) > 1.5
    _, told = mixing.fit_rates(members, [0.6, 0.4, None])
    goal = np.array(told["target"]) / sum(told["target"])
    n = np.array([r[1] for r in rows])
    assert goal[2] == pytest.approx((n * p[:, 2]).sum() / n.sum()) and goal[0] == pytest.approx(1.5 * goal[1])


def test_pipeline_keeps_languages_without_a_target(spark):
    import corpus_pipeline

    texts = {"en": "the a of", "de": "der die das", "it": "il lo gli", "zz": "qu xu vu"}
    rows = [(k, f"{texts[d]} {texts[d]} {texts[d]}", d) for k, d in enumerate(["en"] * 400 + ["de"] * 60 + ["it"] * 40 + ["zz"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id: r["count"] for r in corpus_pipeline.mixed(spark, docs, "").groupBy("doc_id").count().collect()}
    assert set(kept) == set(range(503)) and sum(kept[k] for k in range(400, 460)) > 70
    others = docs.filter("lang in ('it', 'zz')")
    assert corpus_pipeline.mixed(spark, others, "").count() == 43


def test_targets_are_met_by_soft_members(spark):
    """Memberships that are a few per cent soft: the total rises until rates from 1 on meet the targets."""
    random = np.random.default_rng(6)
    own = random.choice(4, 3000, p=[0.7, 0.15, 0.1, 0.05])
    p = np.eye(4)[own] * 0.97 + random.dirichlet([0.3] * 4, 3000) * 0.03
    n = random.integers(1, 300, 3000)
    rows = [(k, int(n[k]), *map(float, p[k])) for k in range(3000)]
    members = spark.createDataFrame(rows, "doc_id long, n_tokens long, p0 double, p1 double, p2 double, p3 double")
    rated, told = mixing.fit_rates(members, [0.4, 0.2, 0.2, 0.2])
    rates = np.array([r.rate for r in rated.orderBy("doc_id").collect()])
    reached = (rates * n) @ p
    assert rates.min() >= 1 and told["rounds"] < 60 and told["gap"] <= mixing.TOLERANCE
    assert np.allclose(reached / reached.sum(), [0.4, 0.2, 0.2, 0.2], atol=3e-3) and np.allclose(reached, told["achieved"])


def test_targets_out_of_reach_are_reported(spark):
    """All documents are alike, so no rates move the shares: the rounds stop, and the gap says so."""
    members = spark.createDataFrame([(k, 10, 0.5, 0.5) for k in range(20)], "doc_id long, n_tokens long, p0 double, p1 double")
    rated, told = mixing.fit_rates(members, [0.9, 0.1])
    assert told["gap"] > 0.2 and told["rounds"] < 40 and rated.agg(F.min("rate")).first()[0] >= 1


def test_query_without_one_of_its_languages(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").filter("lang <> 'es'")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op1_mixing_sources(spark, str(tmp_path))
    assert found.count() == docs.count() and found.filter("p_es is not null").isEmpty()
