import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from conftest import prose
from hypothesis import given, settings
from hypothesis import strategies as st

from cornerstore.llm import periodic, queries
from cornerstore.llm.frames import table

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in SPACE:
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    return words


def plain_runs(words, least=24, exponent=3):
    """Every lag's maximal stretches of equal words; of those over the same words only the smallest lag counts."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = first - q, i - first + q
            stretch = words[start:start + length]
            if length >= max(least, exponent * q) and not any(
                all(stretch[k] == stretch[k - p] for k in range(p, length)) for p in range(1, q)
            ):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for k, w in enumerate(words) if k not in gone)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=9), st.integers(1, 12)), max_size=8), st.integers(3, 40), st.integers(3, 5))
def test_runs_equal_brute_force(parts, least, exponent):
    words = [c.encode() for part, times in parts for c in part * times]
    assert periodic.word_runs(words, least, exponent) == plain_runs(words, least, exponent)


def test_nested_and_touching_runs():
    made = random.Random(5)
    for _ in range(150):
        unit = [made.choice("abc") for _ in range(made.randrange(1, 20))]
        inner = unit * made.randrange(1, 9) + [made.choice("abcx") for _ in range(made.randrange(0, 4))]
        words = inner * made.randrange(1, 6) + unit * made.randrange(0, 5)
        assert periodic.word_runs([w.encode() for w in words]) == plain_runs(words)


def test_one_word_a_million_times():
    assert periodic.word_runs([b"x"] * 1_000_000) == [(0, 1_000_000, 1)]
    block = [b"x"] * 999 + [b"y"]
    runs = periodic.word_runs(block * 300)
    assert runs[0] == (0, 999, 1) and (0, 300_000, 1000) in runs and len(runs) == 301


def test_bounds_are_checked():
    with pytest.raises(ValueError):
        periodic.word_runs([b"x"] * 30, min_exponent=2)


def test_edge_rows_equal_brute_force(spark, edge_docs, no_docs):
    # The two texts of 20,000 words are left to the next test: brute force is quadratic.
    docs = edge_docs.filter("doc_id is null or doc_id not in (5, 6)")
    found = periodic.run_digests(periodic.periodic_runs(docs, rewrite=periodic.planted))
    assert rows_of(found) == sorted((plain_row(r.doc_id, r.text) for r in docs.collect()), key=str)
    assert periodic.run_digests(periodic.periodic_runs(no_docs)).count() == 0


def test_very_long_texts(spark):
    text = prose(2, 20_000)
    rows = [(1, text), (2, text + "end of line " * 100_000), (3, "same line again\n" * 40_000), (3, None)]
    got = {(r.doc_id, r.n_words): r for r in periodic.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1, 20_000].runs == [] and got[1, 20_000].text == " ".join(text.split())
    longest = got[2, 320_000].runs[-1]
    assert (longest.period, longest.start + longest.length) == (3, 320_000) and longest.start in range(19_998, 20_001)
    assert [tuple(r) for r in got[3, 120_000].runs] == [(0, 120_000, 3)] and got[3, 120_000].text == "same line again"
    assert got[3, 0].runs == [] and got[3, 0].text == "" and got[3, 0].strongest is None


def test_query_equals_brute_force_over_the_whole_table(spark, tiny):
    docs = table(spark, tiny, "documents").collect()
    expected = sorted((plain_row(r.doc_id, r.text) for r in docs if len(split(r.text)) < 3000), key=str)
    found = rows_of(queries.op13_periodic_runs(spark, tiny))
    assert len(found) == len(docs)
    wanted = {row[0] for row in expected}
    assert [row for row in found if row[0] in wanted] == expected
    assert sum(row[1] > 0 for row in found) >= len(docs) // 20
