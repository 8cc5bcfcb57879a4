"""Toxicity, quality and languages: held-out accuracy, and defined results for awkward rows."""

import itertools
import zlib

import numpy as np
import pytest
from conftest import prose

from cornerstore.llm import langid, quality, queries, toxicity
from cornerstore.llm.frames import sample_of_labels, table


def part(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_toxicity_on_held_out_labels(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    rows = {r.doc_id: r for r in queries.op4_toxicity(spark, small).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (part(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows.values())
    assert all(r.predicted == int(r.score >= 0.3) for r in rows.values())
    texts = {r.doc_id: r.text.lower() for r in docs.collect()}
    held = [(rows[r.doc_id].predicted, r.toxic, texts[r.doc_id]) for r in labels.collect() if rows[r.doc_id].held_out]
    assert sum(p for p, t, _ in held if not t) <= 0.02 * sum(1 for _, t, _ in held if not t)
    # Toxic labels without any sign in the text can't be found; those with an insult are.
    insulted = [p for p, t, text in held if t and set(toxicity.SEEDS) & toxicity.words_of(text)]
    assert insulted and all(insulted)


def test_labels_of_held_out_rows_change_nothing(spark, tiny):
    docs, labels = table(spark, tiny, "documents"), table(spark, tiny, "labels")
    turned = labels.selectExpr(
        "doc_id", "quality", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - toxic, toxic) as toxic"
    )
    a, b = toxicity.fit_toxicity(docs, labels), toxicity.fit_toxicity(docs, turned)
    assert a.weights == b.weights and a.bias == b.bias


def test_stems_are_learned_from_labels(spark):
    ends = ["", "in", "an", "et", "ola", "umi", "orth"]
    rows, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        rows.append((i, prose(i, 40) + (f" zorgat{ends[i // 6 % 7]} " if bad else " ") + prose(i + 999, 20)))
        labels.append((i, int(bad)))
    rows.append((10_001, prose(5, 30) + " zorgatessi. " + prose(6, 9)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    found = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model).collect()}
    assert found[10_001] == 1 and [found[i] for i, _ in labels] == [t for _, t in labels]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, t in labels if not t]


def test_label_model_finds_accuracies_and_correlations():
    random = np.random.default_rng(0)
    truth = random.random(4000) < 0.15
    def voter(hit, miss):
        return (random.random(4000) < np.where(truth, hit, miss)).astype(np.int8)

    one = voter(0.6, 0.01)
    votes = np.stack([one, one, one, voter(0.5, 0.01), voter(0.5, 0.02), -voter(0.02, 0.8)], axis=1)
    belief, found = toxicity.label_model(votes)
    assert ((belief > 0.5) == truth).mean() > 0.95
    assert found["correlation"][0, 1] > 0.8 > 0.2 > abs(found["correlation"][3, 4])
    assert found["share"][0] < 0.5 < found["share"][3]


def test_toxicity_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, "x"), (7, 0, "y"), (7, 0, "z"), (None, 1, "x"), (8, None, "x")], "doc_id long, toxic int, text string")
    model = toxicity.fit_toxicity(edge_docs, labels)
    rows = toxicity.score_toxicity(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (1, 2, 3)}
    assert len(empty) == 1
    nothing = toxicity.fit_toxicity(edge_docs, labels.filter("false"))
    assert {r.score for r in toxicity.score_toxicity(edge_docs, nothing).collect()} == {float(1 / (1 + np.exp(30)))}
    assert toxicity.score_toxicity(no_docs, model).count() == 0
    assert toxicity.fit_toxicity(no_docs, labels).weights == {}


def test_training_rows_are_the_same_each_time(spark):
    """Of near copies the smallest doc_id, of a repeated doc_id one text; whole texts are looked at."""
    same, other = prose(1, 60), prose(2, 60)
    late = " ".join(f"a{k}1b" for k in range(3_000)) + " m0r0n"
    rows = [(9, same), (3, same), (4, other), (4, prose(3, 60)), (5, prose(4, 60) + late), (6, None)] + [(7, other + "!")] * 50
    labels = [(9, 1), (3, 0), (4, 0), (5, 1), (6, 0), (7, 0)]
    labels = [(i, t) for i, t in labels if part(i, 4) != 2]
    found = []
    for turned in (rows, rows[::-1]):
        docs = spark.createDataFrame(turned, "doc_id long, text string").repartition(5)
        sample = toxicity._training_rows(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), 100)
        found.append(sorted((r.s1, r.toxic, r.words, r.odd) for r in sample.collect()))
    assert found[0] == found[1] and len(found[0]) <= len(labels)
    if part(5, 4) != 2:
        assert any("m0r0n" in odd and len(odd) > 2_000 for *_, odd in found[0])
    if part(3, 4) != 2:
        assert [t for s, t, *_ in found[0] if s == toxicity._sketches(same)[0]] == [0]


def test_quality_hashes_whole_words(spark):
    """Words without a space for long count with all their signs, and are not held."""
    start = "好" * 300
    a, b = quality._hashes["x" * 250 + "a"], quality._hashes["x" * 250 + "b"]
    assert a[0] != b[0] and a[1] == b[1]
    assert quality.shape(start + "Ab9") == "xXx9" and quality._hashes[start + "1"][1] != quality._hashes[start][1]
    assert quality._hashes["short"] and max(map(len, quality._hashes)) <= quality.LONG_WORD
    # A row that comes very often is one row of the scorer's sample.
    docs = spark.createDataFrame([(None, prose(1, 90))] * 3_000 + [(k, prose(k, 90)) for k in range(200)], "doc_id long, text string")
    model = quality.fit_quality(docs, rows=50)
    assert quality.score_quality(docs, model).filter("kept").count() == 3_200


def test_rare_languages_are_learned_at_every_size(spark):
    """Each language has rows in the bounded sample, and rows that repeat count once."""
    rows = [(k, prose(k, 30), "aa") for k in range(4_000)] + [(5_000 + k, prose(k, 30), "zz") for k in range(6)]
    rows += [(None, "same", "aa")] * 2_000
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = sample_of_labels(known, "lang", ("doc_id", "text"), 400, {"aa": 6_000, "zz": 6}).collect()
    assert sum(r.lang == "zz" for r in found) == 6
    assert 150 < len(found) < 600 and sum(r.doc_id is None for r in found) <= 1
    assert langid.fit_languages(known, rows=100).languages == ["aa", "zz"]


def test_quality_against_given_labels(spark, small):
    rows = {r.doc_id: r for r in queries.op2_quality_classifier(spark, small).collect()}
    labels = table(spark, small, "labels").collect()
    good = [rows[r.doc_id].score for r in labels if r.quality == 1]
    bad = [rows[r.doc_id].score for r in labels if r.quality == 0]
    assert np.mean([g > b for g, b in itertools.product(good, bad)]) > 0.95
    assert np.mean([rows[r.doc_id].kept for r in labels if r.quality == 1]) > 0.97
    assert len(rows) == table(spark, small, "documents").count()


def test_labellers_accuracies_are_estimated():
    random = np.random.default_rng(1)
    truth = random.random(6000) < 0.85
    right = [0.95, 0.9, 0.85, 0.8]
    votes = np.stack([np.where(random.random(6000) < 0.2, 0, np.where(random.random(6000) < a, 1, -1) * np.where(truth, 1, -1)) for a in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    belief, found = quality.fit_labellers(patterns, counts)
    assert (np.diff(found["good_vote"]) < 0.02).all()
    of = {tuple(p): b for p, b in zip(patterns, belief)}
    assert np.mean([(of[tuple(v)] > 0.5) == t for v, t in zip(votes, truth)]) > 0.93


def test_quality_edge_rows(spark, edge_docs, no_docs):
    model = quality.fit_quality(edge_docs)
    rows = quality.score_quality(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert not any(r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert quality.score_quality(no_docs, quality.fit_quality(no_docs)).count() == 0


def test_languages_on_held_out_documents(spark, small):
    rows = queries.op6_language_id(spark, small).collect()
    langs = {r.doc_id: r.lang for r in table(spark, small, "documents").collect()}
    assert len(rows) == len(langs)
    assert all(r.held_out == (part(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert np.mean(held) > 0.97


def test_marginals_equal_a_sum_over_all_label_sequences():
    random = np.random.default_rng(0)
    moves = random.standard_normal((3, 3))
    lengths = np.array([4, 1, 6, 3])
    factors = random.random((14, 3)) + 0.05
    found = langid.marginals(lengths, factors, moves)
    at = 0
    for n in lengths:
        e, want = factors[at:at + n], np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.prod([e[i, k] for i, k in enumerate(path)]) * np.exp(sum(moves[a, b] for a, b in zip(path, path[1:])))
            for i, k in enumerate(path):
                want[i, k] += weight
        assert np.allclose(found[at:at + n], want / want.sum(axis=1, keepdims=True))
        at += n


@pytest.fixture(scope="module")
def two_languages():
    a = [prose(k, 60).lower().replace(".", "").split() for k in range(40)]
    b = [prose(k, 60, "ostra velmi nadra tulku sjera plova hranic".split()).lower().replace(".", "").split() for k in range(40)]
    return langid.train(a + b, [0] * 40 + [1] * 40, ["aa", "bb"])


def test_switches_inside_a_text_are_found(spark, two_languages):
    first, second = prose(100, 25), prose(101, 30, "ostra velmi nadra tulku sjera plova hranic".split())
    docs = spark.createDataFrame([(1, first + second), (2, first), (3, second)], "doc_id long, text string")
    rows = {r.doc_id: r for r in langid.label_documents(docs, two_languages, with_spans=True).collect()}
    assert [(s.first, s.end, s.lang) for s in rows[1].spans] == [(0, 25, "aa"), (25, 55, "bb")]
    assert (rows[1].lang_pred, rows[2].lang_pred, rows[3].lang_pred) == ("bb", "aa", "bb")
    assert rows[1].n_switches == 1 and rows[2].n_switches == 0


def test_language_edge_rows(spark, edge_docs, no_docs, two_languages):
    rows = langid.label_documents(edge_docs, two_languages).collect()
    assert len(rows) == edge_docs.count()
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3)} == {("und", 0.0)}
    assert {r.lang_pred for r in rows if r.doc_id == 5} == {"aa"}
    numbers = spark.createDataFrame([(1, "12 ² ¼ __ !!")], "doc_id long, text string")
    assert langid.label_documents(numbers, two_languages).first().lang_pred == "und"
    unlearned = langid.fit_languages(no_docs)
    assert {r.lang_pred for r in langid.label_documents(edge_docs, unlearned).collect()} == {"und"}
    assert langid.label_documents(no_docs, two_languages).count() == 0
    assert langid.fit_languages(edge_docs).languages == ["de", "en"]


def test_letters_beside_other_signs_have_a_language(spark, small):
    """und is for texts without a letter alone; very long words are scored whole."""
    assert langid.words_of("m²") == ["m²"] and langid.words_of("½a x²") and langid.words_of("½ ² 12 _") == []
    model = langid.LanguageModel(["a", "b"], np.zeros((langid.FEATURES, 2), np.float32), np.zeros((2, 2)), frozenset())
    model.weights[langid.word_features("zzz", frozenset()), 1] = 5
    docs = spark.createDataFrame([(1, "m²"), (2, "½ ²"), (3, "q" * 300 + "zzz"), (4, None)], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in langid.label_documents(docs, model).collect()}
    assert found[1] in ("a", "b") and found[2] == found[4] == "und" and found[3] == "b"
