"""Operator 3: line-first quality rules, as built-in expressions only.

Every line of a text is judged by rules on its punctuation, on navigation and on
boilerplate.  Lines that fail are removed, and a document is rejected when too much of its
text goes with them.  Everything is an expression over the one text column: a document is
judged where it is scanned, nothing is shuffled, and no key can be hot.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import WORD, let, words

SYMBOLS = "#*$%&|<>"
TERMINAL = r"[.!?…:;。！？][\"'”’»)\]*]*[\x20\x09-\x0D]*$"
ENDS = tuple(".!?…:;。！？")
#: A mark at the end of a word: what prose has inside a line, and lists of entries have not.
INSIDE = r"[.!?…,;:][\"'”’»)\]]*[\x20\x09-\x0D]"
MARKS = r"[#*$%&|<>!?»›•·→]"
SHOUTS = r"!{2,}|\?{2,}"
SEPARATORS = "|»›•·→"

#: Phrases of page furniture, matched without regard to case.
BOILERPLATE = (
    "enable javascript", "requires javascript", "accept all cookies", "we use cookies",
    "cookie policy", "privacy policy", "terms of use", "terms of service",
    "all rights reserved", "lorem ipsum", "click here", "subscribe to our newsletter",
    "sign up for our newsletter", "log in to comment", "skip to content", "back to top",
    "share on facebook", "share on twitter", "follow us on",
)


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the rejection."""

    symbols_per_100_chars: int = 10
    shouts_per_100_words: int = 30
    separators_per_100_words: int = 25
    least_separators: int = 2
    running_words: int = 8
    lost_per_100_chars: int = 30


def word_chars(text: Column) -> Column:
    return F.length(F.array_join(words(text), ""))


def symbols(text: Column) -> Column:
    """Symbols of a text; one without any, the usual case, is only searched."""
    counted = F.length(text) - F.length(F.translate(text, SYMBOLS, ""))
    return F.when(text.rlike(f"[{SYMBOLS}]"), counted).otherwise(0)


def is_good_line(line: Column, rules: LineRules = LineRules()) -> Column:
    """Whether a line passes, boilerplate apart; a line without a word passes.

    Punctuation: it ends like a sentence, or runs on with marks inside (prose whose last
    sentence is unfinished), has few symbols and is not shouted.
    Navigation: it is not a row of entries between separators.
    """
    ends = F.substring(line, -1, 1).isin(*ENDS) | line.rlike(TERMINAL)
    n_words = F.regexp_count(line, F.lit(WORD))
    separators = F.length(line) - F.length(F.translate(line, SEPARATORS, ""))
    menu = (separators >= rules.least_separators) & (
        separators * 100 >= n_words * rules.separators_per_100_words
    )
    calm = F.regexp_count(line, F.lit(SHOUTS)) * 100 <= n_words * rules.shouts_per_100_words
    plain = symbols(line) * 100 <= word_chars(line) * rules.symbols_per_100_chars
    prose = ends | ((n_words >= rules.running_words) & line.rlike(INSIDE))
    return ~line.rlike(WORD) | (prose & (~line.rlike(MARKS) | (plain & calm & ~menu)))


def has_furniture(text: Column) -> Column:
    return let(F.lower(text), lambda low: reduce(or_, [low.contains(p) for p in BOILERPLATE]))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def cleaned(text: Column, rules: LineRules = LineRules()) -> Column:
    """The text without its failed lines; a NULL text is empty.

    Phrases of page furniture are sought line by line only where the text has one.
    """
    whole = F.coalesce(text, F.lit(""))
    kept = let(
        has_furniture(whole),
        lambda furnished: F.filter(
            lines(whole),
            lambda line: is_good_line(line, rules) & (~furnished | ~has_furniture(line)),
        ),
    )
    return F.array_join(kept, "\n")


def loses_little(
    text: Column, chars: Column, rules: LineRules = LineRules()
) -> Column:
    """Whether at most the allowed share of the word characters goes with failed lines."""

    def judged(clean: Column) -> Column:
        lost = chars - word_chars(clean)
        return (clean == text) | (lost * 100 <= chars * rules.lost_per_100_chars)

    return let(cleaned(text, rules), judged)


def repeated_words(text_words: Column) -> Column:
    """Number of words that lie in a 3-word window found twice or more in the text.

    A text whose windows have distinct hashes is done at once.  Otherwise the windows
    with a repeated hash are sorted as text with their positions, so that equal ones are
    neighbours; the sorted positions of those with an equal neighbour then give the words
    that they cover together.  With many repeated hashes all windows are sorted, which
    gives the same number in n log n.
    """

    def hashes(w: Column) -> Column:
        return F.transform(
            F.slice(w, 1, F.size(w) - 2),
            lambda first, i: F.struct(
                F.xxhash64(first, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")
            ),
        )

    def suspects(hashed: Column) -> Column:
        """Positions of the windows whose hash may occur twice."""
        twice = let(
            F.sort_array(hashed["h"]),
            lambda s: F.array_distinct(F.filter(s, lambda h, i: h == F.get(s, i - 1))),
        )
        return let(
            twice,
            lambda t: F.filter(hashed, lambda e: (F.size(t) > 50) | F.array_contains(t, e["h"])),
        )["p"]

    def covered(w: Column, positions: Column) -> Column:
        return let(
            F.sort_array(
                F.transform(
                    positions,
                    lambda p: F.struct(
                        F.concat_ws(" ", F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("w"),
                        p.alias("p"),
                    ),
                )
            ),
            lambda s: let(
                F.sort_array(
                    F.filter(
                        s,
                        lambda e, i: F.coalesce(e["w"] == F.get(s, i - 1)["w"], F.lit(False))
                        | F.coalesce(e["w"] == F.get(s, i + 1)["w"], F.lit(False)),
                    )["p"]
                ),
                lambda p: F.aggregate(
                    F.transform(p, lambda at, i: F.least(F.lit(3), F.get(p, i + 1) - at)),
                    F.lit(0),
                    lambda total, step: total + step,
                ),
            ),
        )

    def counted(w: Column) -> Column:
        return let(
            hashes(w),
            lambda h: F.when(F.size(F.array_distinct(h["h"])) == F.size(h), 0).otherwise(
                covered(w, suspects(h))
            ),
        )

    return let(text_words, lambda w: F.when(F.size(w) < 4, 0).otherwise(counted(w)))


def repeated_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    spoken = F.filter(lines(text), lambda line: line.rlike(WORD))
    return let(spoken, lambda s: F.size(s) - F.size(F.array_distinct(s)))


def quality_figures(
    documents: DataFrame, rules: LineRules = LineRules(),
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Figures and verdict of every document.

    NULL and empty texts have no words and fail the base rule; repeated rows are judged
    one by one; NULL ids are kept; other columns are not looked at, so their names may
    be anything; an empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    measured = documents.select(
        F.col(doc_id).alias("doc_id"), whole.alias("text"), words(whole).alias("words")
    ).withColumn("word_chars", F.length(F.array_join("words", "")))
    counted = measured.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        symbols(F.col("text")).cast("long").alias("n_symbols"),
        repeated_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        loses_little(F.col("text"), F.col("word_chars"), rules).alias("_good"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("_good")).alias("kept"),
    )


def passes(text: Column, rules: LineRules = LineRules()) -> Column:
    """The verdict alone, as one condition on a text column."""
    whole = F.coalesce(text, F.lit(""))
    verdict = let(
        words(whole),
        lambda w: (F.size(w) >= 50) & (repeated_words(w) * 100 <= F.size(w) * 50),
    )
    return verdict & loses_little(whole, word_chars(whole), rules)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars
  FROM d
), l AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), m AS (
  SELECT r, line, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    len(regexp_extract_all(line, '[|»›•·→]')) AS seps,
    len(regexp_extract_all(line, '!{2,}|\?{2,}')) AS shouts,
    length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS syms
  FROM l
), k AS (
  SELECT r,
    count(*) FILTER (chars > 0) - count(DISTINCT line) FILTER (chars > 0) AS dup,
    coalesce(sum(chars) FILTER (chars > 0 AND NOT (
      (regexp_matches(line, '[.!?…:;。！？]["''”’»)\]*]*[\x20\x09-\x0D]*$')
        OR (n >= 8 AND regexp_matches(line, '[.!?…,;:]["''”’»)\]]*[\x20\x09-\x0D]')))
      AND shouts * 100 <= n * 30 AND syms * 100 <= chars * 10
      AND NOT (seps >= 2 AND seps * 100 >= n * 25)
      AND NOT regexp_matches(line, '(?i)BOILERPLATE')
    )), 0) AS lost
  FROM m GROUP BY r
), x AS (
  SELECT r, unnest(list_transform(range(1, len(w) - 1),
    lambda i: {'p': i, 'k': concat_ws(' ', w[i], w[i + 1], w[i + 2])}), recursive := true)
  FROM w WHERE len(w) > 3
), q AS (
  SELECT r, p FROM x QUALIFY count(*) OVER (PARTITION BY r, k) > 1
), s AS (
  SELECT r, least(3, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p) - p, 3)) AS step FROM q
), t AS (
  SELECT r, sum(step) AS n FROM s GROUP BY r
), f AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, dup, lost,
    coalesce(t.n, 0)::BIGINT AS n_repeat_words
  FROM w JOIN k USING (r) LEFT JOIN t USING (r)
)
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  dup::BIGINT AS n_dup_lines, n_repeat_words,
  (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AS base_failed,
  (n_words >= 50 AND n_repeat_words * 100 <= n_words * 50 AND lost * 100 <= word_chars * 30) AS kept
FROM f
""".replace("BOILERPLATE", "|".join(BOILERPLATE))
