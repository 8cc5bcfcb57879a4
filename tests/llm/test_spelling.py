import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cornerstore.llm import queries, spelling
from cornerstore.llm.frames import table

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def plain_counts(docs, least=3):
    """The contract's words, run by run."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= least}


def plain_variants(counts):
    """All edits of every word, insertions and replacements by any letter included, looked up one by one."""
    rows, forms = {}, {}
    for word, n in counts.items():
        edits = {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in ["", *LETTERS]}
        edits |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in LETTERS}
        near = (edits - {word}) & counts.keys()
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[word] = best
        rows[word] = len(near)
    out = []
    for word, n_near in rows.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.append((word, form, root, counts[word], n_near, counts[form] if form else None))
    return sorted(out)


def rows_of(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


def words_of(spark, counts):
    return spark.createDataFrame([*counts.items()], "word string, n long")


def some_words(seed, count, letters="abcdé", lengths=(5, 8)):
    made = random.Random(seed)
    return {"".join(made.choice(letters) for _ in range(made.randint(*lengths))): made.choice([3, 4, 6, 8, 16, 40]) for _ in range(count)}


@pytest.mark.parametrize("filter_bytes", [1 << 20, 64])
def test_dense_vocabulary_equals_brute_force(spark, filter_bytes):
    """With 64 bytes of filter a round, lengths are split into parts and take many rounds."""
    counts = some_words(1, 600)
    if filter_bytes == 64:
        counts = dict(sorted(counts.items())[:150])
        sizes = Counter(map(len, counts))
        assert len(spelling.rounds_of(sizes, 64)) > 4 and any(parts > 1 for r in spelling.rounds_of(sizes, 64) for _, _, parts in r)
    assert rows_of(spelling.variants(words_of(spark, counts), filter_bytes)) == plain_variants(counts)


def test_long_chains_and_hot_roots(spark):
    """A chain over eleven doublings, and many words with one root."""
    chain = {"a" * 30 + "b" * k: 3 * 2 ** (12 - k) for k in range(12)}
    hub = {"z" * k + c + "z" * (9 - k): 5 for k in range(10) for c in LETTERS if c != "z"} | {"z" * 10: 1000}
    counts = chain | hub
    found = rows_of(spelling.variants(words_of(spark, counts)))
    assert found == plain_variants(counts)
    roots = Counter(row[2] for row in found)
    assert roots["a" * 30] == 12 and roots["z" * 10] == len(hub)


def test_hashes_follow_edits():
    """Filters have no false negatives: the hash of an edit is that of the edited word."""
    for length in (5, 9):
        words = sorted({w for w in some_words(length, 300, lengths=(length, length))})
        at, bits = spelling.BlockedFilter.places(spelling.word_hashes(spelling._codes(words, length)), 40)
        blocks = np.zeros(40, np.uint64)
        np.bitwise_or.at(blocks, at, bits)
        held = {(length, 0): spelling.BlockedFilter(blocks)}
        longer = sorted({w[:2] + "x" + w[2:] for w in words})
        shorter = {e for _, e in spelling._edits(longer, length + 1, held, {length: 1})}
        assert set(words) <= shorter
        raised = {e for _, e in spelling._edits(["a" + w[1:] for w in words], length, held, {length: 1})}
        assert {w for w in words if w[0] != "a"} <= raised


def test_edge_rows_equal_brute_force(spark, edge_docs, no_docs):
    given = [(r.doc_id, r.text) for r in edge_docs.collect()]
    found = rows_of(spelling.variants(spelling.vocabulary(edge_docs, spelling.damaged)))
    assert found == plain_variants(plain_counts(given)) and len(found) > 20
    assert spelling.variants(spelling.vocabulary(no_docs, spelling.damaged)).count() == 0


def test_letters_case_and_very_long_words(spark):
    rows = [
        (1, "Éclair éclair ECLAIR eclair×x ½½½½½½ naïve123naïve NAÏVE ſtraße"),
        (2, "x" * 3000 + " " + "x" * 2999 + "y " + "x" * 2999),
    ] * 4
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(spelling.variants(spelling.vocabulary(docs)))
    words = {row[0]: row for row in found}
    assert {"éclair", "Éclair", "eclair", "eclair×x", "naïve", "naÏve", "traße", "x" * 3000} <= set(words)
    assert words["eclair"][4] == 2 and words["x" * 2999][4] == 2 and words["x" * 3000][4] == 2
    short = {row[0]: row[3] for row in found if len(row[0]) < 99}
    assert [row for row in found if len(row[0]) < 99] == plain_variants(short)


def test_query_equals_brute_force_over_the_whole_table(spark, tiny):
    docs = [(r.doc_id, r.text) for r in table(spark, tiny, "documents").collect()]
    found = rows_of(queries.op12_spelling_variants(spark, tiny))
    assert found == plain_variants(plain_counts(docs))
    assert sum(row[1] is not None for row in found) > 20
