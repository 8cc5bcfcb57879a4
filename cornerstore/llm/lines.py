"""Quality rules over words and cross-document line frequency, in SQL functions only.

Every line is normalised (lower case, one space between words) and hashed. The
distinct documents of a host that have a line are counted, lines above the limits
are removed, and documents that lose too much are rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The white space between words, and the characters that count as symbols.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
LINE_DOCUMENTS = 10
LINE_SHARE = 0.0
LEAST_LEFT_PERCENT = 50


def word_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every whole text.

    Repeated three-word windows are found by sorting the hashes of one text's
    windows. No row leaves its partition, and a text costs n log n of its words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    start = docs.select(
        *keep, text.alias("_text"),
        F.expr(rf"transform(filter(split(coalesce(text, ''), r'{SPACES}'), w -> w <> ''), w -> xxhash64(w))").alias("_h"),
        F.expr(rf"filter(split(coalesce(text, ''), '\n'), x -> translate(x, '{SPACE_CHARACTERS}', '') <> '')").alias("_lines"),
    )
    counted = start.select(
        *keep, "_h", F.size("_h").alias("_n"),
        F.length(F.translate("_text", SPACE_CHARACTERS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    rest = ["word_chars", "n_symbols", "n_dup_lines"]
    windows = counted.select(
        *keep, "_n", *rest,
        F.expr(
            "CASE WHEN _n >= 3 THEN zip_with(zip_with(slice(_h, 1, _n - 2), slice(_h, 2, _n - 2), (a, b) -> xxhash64(a, b)),"
            " slice(_h, 3, _n - 2), (a, b) -> xxhash64(a, b)) ELSE array() END"
        ).alias("_w"),
    )
    # Only texts with a repeated window go on: hash and place of every window, sorted.
    ordered = windows.select(
        *keep, "_n", *rest,
        F.expr(
            "CASE WHEN size(array_distinct(_w)) < size(_w)"
            " THEN sort_array(transform(_w, (x, i) -> named_struct('h', x, 'i', i))) END"
        ).alias("_s"),
    )
    same = ordered.select(
        *keep, "_n", *rest, "_s",
        F.expr("zip_with(_s, slice(_s, 2, greatest(size(_s) - 1, 0)), (a, b) -> coalesce(a.h = b.h, false))").alias("_e"),
    )
    places = same.select(
        *keep, "_n", *rest,
        F.expr(
            "sort_array(array_compact(zip_with(_s, zip_with(_e, concat(array(false), slice(_e, 1, greatest(size(_e) - 1, 0))),"
            " (a, b) -> a OR b), (x, f) -> CASE WHEN f THEN x.i END)))"
        ).alias("_p"),
    )
    repeated = F.expr(
        "coalesce(aggregate(zip_with(_p, slice(_p, 2, greatest(size(_p) - 1, 0)), (a, b) -> least(3, coalesce(b - a, 3))),"
        " 0L, (x, y) -> x + y), 0L)"
    )
    return places.select(*keep, F.col("_n").cast("long").alias("n_words"), *rest, repeated.alias("n_repeat_words"))


def frequent_line_words(
    docs: DataFrame, host: str, most_documents: int = LINE_DOCUMENTS, most_share: float = LINE_SHARE
) -> DataFrame:
    """doc_id, n_removed_words: the words in lines that too many documents of a host share.

    A line is removed if more than ``most_documents`` distinct documents of the host
    have it, however large the host is. With a ``most_share`` they must be more than
    that share of the host's documents, too. Counts are summed before each shuffle; the
    join on a frequent line can be split.
    """
    one_space = rf"regexp_replace(x, r'{SPACES}', ' ')"
    lines = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").alias("_doc"), F.coalesce(F.col(host), F.lit("")).alias("_host"),
        F.explode(F.expr(rf"filter(transform(split(lower(text), '\n'), x -> trim({one_space})), x -> x <> '')")).alias("_line"),
    )
    words = F.length("_line") - F.length(F.translate("_line", " ", "")) + 1
    each = lines.groupBy("_host", "_doc", F.xxhash64("_line").alias("_h")).agg(F.sum(words).alias("_words"))
    common = each.groupBy("_host", "_h").agg(F.count("*").alias("_docs")).filter(F.col("_docs") > most_documents)
    if most_share:
        sizes = docs.filter("doc_id is not null").groupBy(F.coalesce(F.col(host), F.lit("")).alias("_of")).agg(
            F.countDistinct("doc_id").alias("_size")
        )
        common = common.join(sizes, F.col("_host") == F.col("_of")).filter(F.col("_docs") > most_share * F.col("_size"))
    found = each.join(common.select("_host", "_h"), ["_host", "_h"])
    return found.groupBy(F.col("_doc").alias("doc_id")).agg(F.sum("_words").alias("n_removed_words"))


def quality_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, the counts of ``word_statistics``, base_failed, n_removed_words, kept of every document.

    base_failed: fewer than 50 words, or more than half of them in repeated three-word
    windows. kept: not base_failed, and at least half of all words are left once the
    frequent lines are gone. NULL texts have no words and fail. A NULL host
    is a host of its own. Rows without doc_id have their counts, but no line is counted
    for or taken from them; rows that repeat a doc_id count as one document per line.
    """
    counts = word_statistics(docs, ["doc_id"])
    removed = frequent_line_words(docs, host).withColumnRenamed("doc_id", "_id")
    both = counts.join(removed, F.col("doc_id") == F.col("_id"), "left").withColumn(
        "n_removed_words", F.coalesce("n_removed_words", F.lit(0).cast("long"))
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = 100 * left < LEAST_LEFT_PERCENT * F.col("n_words")
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "n_removed_words", (~failed & ~depleted).alias("kept"),
    )


QUALITY_RULES_SQL = r"""
with docs as (
  select doc_id, coalesce(source, '') as host, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
  from documents),
base as (
  select doc_id, len(words) as n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols
  from docs),
lines as (
  select doc_id, host, unnest(string_split(text, chr(10))) as line from docs),
filled as (select * from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
dups as (select doc_id, count(*) - count(distinct line) as n_dup_lines from filled group by doc_id),
placed as (
  select doc_id, unnest(range(1, len(words) - 1)) as i, words from docs where len(words) >= 3),
windows as (select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w from placed),
twice as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as n from windows) where n > 1),
covered as (
  select doc_id, count(distinct i + k) as n_repeat_words from twice, (select unnest([0, 1, 2]) as k) group by doc_id),
normal as (
  select doc_id, host, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) as line from filled),
each as (
  select host, doc_id, line, sum(length(line) - length(replace(line, ' ', '')) + 1) as words from normal group by all),
common as (select host, line from each group by host, line having count(*) > 10),
removed as (
  select doc_id, sum(words) as n_removed_words from each join common using (host, line) group by doc_id),
everything as (
  select doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words,
    cast(coalesce(n_removed_words, 0) as bigint) as n_removed_words
  from base left join dups using (doc_id) left join covered using (doc_id) left join removed using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    100 * (n_words - n_removed_words) < 50 * n_words as depleted
  from everything)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
  not base_failed and not depleted as kept
from judged
"""
