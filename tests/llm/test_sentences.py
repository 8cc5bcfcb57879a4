import random

from conftest import prose

from cornerstore.llm import queries, sentences
from cornerstore.llm.frames import table

LIMITS = (sentences.MIN_WORDS, sentences.MIN_SENTENCES, sentences.LONG_SENTENCE)


def plain_sentences(text):
    """(start, end, words) of the sentences, sign by sign, without the operator's pattern."""
    pieces, start, i = [], 0, 0
    while i < len(text):
        j = i
        if text[i] in ".!?":
            while j < len(text) and text[j] in ".!?":
                j += 1
            k = j
            while k < len(text) and text[k].isspace():
                k += 1
            i, ends = (k, True) if k > j else (j, False)
        elif text[i] in "。！？":
            while j < len(text) and text[j] in "。！？":
                j += 1
            while j < len(text) and text[j].isspace():
                j += 1
            i, ends = j, True
        elif text[i] == "\n":
            while j < len(text) and text[j].isspace():
                j += 1
            i, ends = j, True
        else:
            i, ends = i + 1, False
        if ends:
            pieces.append((start, i))
            start = i
    pieces.append((start, len(text)))
    out = []
    for a, b in pieces:
        words = text[a:b].lower().split()
        if words:
            out.append([a, b, words])
        elif out:
            out[-1][1] = b
    if out:
        out[0][0], out[-1][1] = 0, len(text)
    return out


def brute_force(docs, min_words=10, min_sentences=2, long_sentence=50):
    """Text and removed sentences per row, from all runs of all documents compared as tuples of words."""
    def cut(text):
        found = plain_sentences(text or "")
        edges = [s[0] for s in found] + [found[-1][1]] if found else []
        return edges, [len(s[2]) for s in found], [" ".join(s[2]) for s in found]

    def sufficient(counts, a, b):
        n = b - a
        words = sum(counts[a:b])
        return words >= min_words and (n >= min_sentences or (n == 1 and words >= long_sentence))

    places, parts = {}, {}
    for i, text in docs:
        if i is None or text is None:
            continue
        edges, counts, texts = cut(text)
        n = len(counts)
        found = set()
        for a in range(n):
            found.update([next(((a, b) for b in range(a + 1, n + 1) if sufficient(counts, a, b)), None)])
            found.update([next(((b, a + 1) for b in range(a, -1, -1) if sufficient(counts, b, a + 1)), None)])
        parts[(i, text)] = found = {tuple(texts[a:b]): [] for a, b in ()} | {f: tuple(texts[f[0]:f[1]]) for f in found if f}
        for (a, b), run in found.items():
            places.setdefault(run, set()).add((i, a))
    out = []
    for i, text in docs:
        edges, counts, _ = cut(text)
        gone = set()
        for (a, b), run in parts.get((i, text), {}).items():
            if (i, a) != min(places[run]):
                gone.update(range(a, b))
        kept = None if text is None else "".join(text[edges[k]:edges[k + 1]] for k in range(len(counts)) if k not in gone) if gone else text
        out.append((str(i), kept, len(counts), len(gone)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((str(r.doc_id), r.text, r.n_sentences, r.n_removed) for r in df.collect()), key=str)


def test_sentences_tile_the_text():
    for text in ("A b. C d!  \n\n e? f", "\n\n x.\ny", "one", "a.b.c. d", "你好。世界。 x", "!!! ?\n."):
        edges, counts, _ = sentences.sentence_bounds(text)
        assert edges[0] == 0 and edges[-1] == len(text) and len(edges) == len(counts) + 1
        assert counts == [len(text[a:b].split()) for a, b in zip(edges, edges[1:])] and all(counts)
    assert sentences.sentence_bounds(" \n ") == ([], [], [])


def test_edge_rows_equal_brute_force(spark, edge_docs, no_docs):
    # The 20,000 words of documents 5 and 6 are left to the next test: brute force is quadratic.
    docs = edge_docs.filter("doc_id is null or doc_id not in (5, 6)")
    given = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(sentences.dedup_sentences(docs)) == brute_force(given)
    assert sentences.dedup_sentences(no_docs).count() == 0


def test_a_long_copy_goes_whole(spark, edge_docs):
    found = {r.doc_id: r for r in sentences.dedup_sentences(edge_docs.filter("doc_id in (5, 6)")).collect()}
    assert found[6].text == "" and found[6].n_removed == found[6].n_sentences > 1000
    assert found[5].n_removed < found[5].n_sentences


def test_planted_passages(spark):
    """Passages of 50 words and more go from all documents but the first; nothing else changes."""
    made = random.Random(3)
    word = lambda: "".join(made.choice("abcdefgh") for _ in range(6))

    def text(words):
        out = []
        while len(out) < words:
            n = made.randrange(3, 25)
            out += [word() for _ in range(n - 1)] + [word() + "."]
        return " ".join(out)

    passages = [text(50 + 10 * k) for k in range(5)]
    rows, clean = [], {}
    for i in range(60):
        own = [text(60), text(60)]
        if i % 2:
            clean[i] = "\n".join(own)
            rows.append((i, clean[i]))
        else:
            rows.append((i, "\n".join([own[0], passages[i // 2 % 5], own[1]])))
    found = {r.doc_id: r.text for r in sentences.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == t for i, t in clean.items())
    for k, passage in enumerate(passages):
        holders = [i for i, t in rows if passage in t]
        assert [i for i in holders if passage in found[i]] == holders[:1]
        assert all(found[i] == dict(rows)[i].replace(passage + "\n", "") for i in holders[1:])


def test_ties_and_repeats_inside_a_document(spark):
    block = prose(4, 45)
    rows = [(2, f"{block}\n{block}\nEnd of it."), (1, f"{block}\nOther end."), (1, f"{block}\nOther end.")]
    assert rows_of(sentences.dedup_sentences(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_force(rows)


def test_stage_keeps_columns_and_drops_emptied_documents(spark, edge_docs):
    kept = sentences.drop_repeated(edge_docs)
    assert kept.schema == edge_docs.schema
    rows = kept.collect()
    ids = [r.doc_id for r in rows]
    assert 6 not in ids and 5 in ids and ids.count(None) == 2 and ids.count(7) == 2
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows)


def test_query_equals_brute_force_over_the_whole_table(spark, tiny):
    given = [(r.doc_id, r.text) for r in table(spark, tiny, "documents").collect()]
    assert rows_of(queries.op9_substring_dedup(spark, tiny)) == brute_force(given)


def test_passages_glued_into_sentences(spark):
    """Of a passage that starts and ends inside sentences, the whole sentences go from all documents but the first."""
    made = random.Random(8)
    word = lambda: "".join(made.choice("abcdefgh") for _ in range(7))
    say = lambda n: " ".join(word() for _ in range(n))
    middle = [f"{say(9)}. {say(9)}. {say(10)}. ", f"{say(6)}. {say(5)}. ", f"{say(19)}. {say(19)}. "]
    passages = [(say((53 - len(m.split())) // 2), m, say((54 - len(m.split())) // 2)) for m in middle]
    assert all(len(" ".join(p).split()) > 50 for p in passages)
    rows = [(i, f"{say(30)} {head}. {m}{tail} {say(30)}.", None) for i in range(9) for head, m, tail in [passages[i % 3]]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {r.doc_id: r.text for r in sentences.drop_repeated(docs).collect()}
    for i, text, _ in rows:
        assert found[i] == (text if i < 3 else text.replace(passages[i % 3][1], ""))
