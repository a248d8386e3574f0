"""Line-first cleaning with DataFrame functions only.

Every line is judged alone; failing lines go, and a document that loses too much text goes too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import BLANK_RUN, BLANKS

# Characters that count as symbols, line ends that count as punctuation, and phrases of boilerplate.
SYMBOLS = "#*$%&|<>"
STOPS = [".", "!", "?", ":", ";", '"', "'", ")", "…", "。"]
PHRASES = ["licensed under", "all rights reserved", "privacy policy", "terms of service", "terms of use", "accept cookies", "click here", "sign up for"]

#: Words in a repeated window; least words; most percent of words in repeated windows.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: One navigation bar per so many characters, one symbol per so many, one exclamation mark per so many fail a line.
BAR_EVERY, SYMBOL_EVERY, SHOUT_EVERY = 20, 10, 8
#: A line of fewer words without punctuation at its end fails.
FRAGMENT_WORDS = 3
#: Least percent of the word characters that must stand in passing lines.
LEAST_LEFT = 50


def _solid(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def line_facts(text: Column) -> Column:
    """The lines that hold a word, as structs of what the rules ask: each is worked out once a line."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("line"), _solid(x).alias("solid")))
    lines = F.filter(lines, lambda x: x["solid"] != "")
    return F.transform(
        lines,
        lambda x: F.struct(
            x["line"].alias("line"),
            F.length(x["solid"]).alias("chars"),
            (F.length(x["solid"]) - F.length(F.translate(x["solid"], SYMBOLS, ""))).alias("symbols"),
            (F.length(x["solid"]) - F.length(F.replace(x["solid"], F.lit("|")))).alias("bars"),
            (F.length(x["solid"]) - F.length(F.replace(x["solid"], F.lit("!")))).alias("shouts"),
            F.substring(x["solid"], -1, 1).alias("last"),
            F.lower(x["line"]).alias("low"),
        ),
    )


def passes(x: Column) -> Column:
    """Whether one line of line_facts passes all rules."""
    navigation = x["bars"] * BAR_EVERY >= x["chars"]
    symbols = x["symbols"] * SYMBOL_EVERY >= x["chars"]
    shouting = x["shouts"] * SHOUT_EVERY >= x["chars"]
    short = (x["chars"] < 40 * FRAGMENT_WORDS) & ~x["last"].isin(STOPS)
    fragment = short & x["line"].rlike(r"^[ \t-\r]*([^ \t-\r]+[ \t-\r]*){1,%d}$" % (FRAGMENT_WORDS - 1))
    boilerplate = F.lit(False)
    for phrase in PHRASES:
        boilerplate = boilerplate | F.contains(x["low"], F.lit(phrase))
    return ~(navigation | symbols | shouting | fragment | boilerplate)


def repeated_words(words: str) -> tuple[dict[str, Column], dict[str, Column], dict[str, Column], Column]:
    """Three layers of columns and the count of words in WINDOW-word windows found twice or more."""
    n = F.size(words)
    hashes = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("_wh"), i + k) for k in range(WINDOW)])),
    )
    first = {"_wh": F.transform(words, lambda w: F.xxhash64(w))}
    second = {"_win": hashes}
    # Only documents that hold a repeat pay for the sort of (hash, position).
    third = {
        "_pairs": F.when(
            F.size(F.array_distinct("_win")) < F.size("_win"),
            F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        )
    }
    same = lambda i, h: F.coalesce(F.get(F.col("_pairs"), i)["h"] == h, F.lit(False))
    at = F.sort_array(F.transform(F.filter("_pairs", lambda x, i: same(i - 1, x["h"]) | same(i + 1, x["h"])), lambda x: x["i"]))
    return first, second, third, at


def line_first_clean(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, n_bad_lines.

    Rows in = rows out, repeated ids and null ids included; a null or empty text has zero counts and
    fails for its word count. Columns other than doc_id and text are not looked at. Word positions are
    judged inside each text alone, so no row meets another and nothing is shuffled.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_t"))
    base = base.withColumn("_trim", F.trim("_t", F.lit(BLANKS)))
    base = base.select(
        "doc_id",
        F.when(F.col("_trim") != "", F.split("_trim", BLANK_RUN)).otherwise(F.array().cast("array<string>")).alias("_words"),
        line_facts(F.col("_t")).alias("_lines"),
    )
    first, second, third, at = repeated_words("_words")
    out = base.withColumns(first).withColumns(second).withColumns(third).withColumn("_at", at)
    steps = F.transform("_at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_at"), i + 1), p + WINDOW) - p))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    out = out.select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        total(F.col("_lines.chars")).alias("word_chars"),
        total(F.col("_lines.symbols")).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct(F.col("_lines.line")))).cast("long").alias("n_dup_lines"),
        F.coalesce(total(steps), F.lit(0).cast("long")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.filter("_lines", passes).getField("chars").alias("_good"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    left = total(F.col("_good"))
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (100 * left >= LEAST_LEFT * F.col("word_chars"))).alias("kept"),
        "n_lines",
        (F.col("n_lines") - F.size("_good")).alias("n_bad_lines"),
    )


def cleaned_text(docs: DataFrame) -> DataFrame:
    """docs with the text reduced to its passing lines; blank lines go.

    A null text stays null and an empty one empty; a text all of whose lines fail becomes empty.  Repeated rows and
    null ids stay, other columns are as they were, an empty table gives none.
    """
    lines = F.filter(line_facts(F.col("text")), passes).getField("line")
    return docs.withColumn("text", F.array_join(lines, "\n"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS p, ws FROM w WHERE len(ws) >= 5),
h AS (SELECT doc_id, p, list_slice(ws, p, p + 4) AS k FROM g),
r AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, k) AS n FROM h),
c AS (SELECT doc_id, count(DISTINCT q) AS n_repeat FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM r WHERE n > 1) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(ls) AS x FROM w),
s AS (SELECT doc_id, x, regexp_replace(x, '[\x20\x09-\x0D]', '', 'g') AS y FROM l),
v AS (SELECT doc_id, length(y) AS n,
             (length(y) - length(replace(y, '|', ''))) * 20 >= length(y)
             OR length(regexp_replace(y, '[^#*$%&|<>]', '', 'g')) * 10 >= length(y)
             OR (length(y) - length(replace(y, '!', ''))) * 8 >= length(y)
             OR (right(y, 1) NOT IN ('.', '!', '?', ':', ';', '"', '''', ')', '…', '。') AND length(y) < 120
                 AND len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda z: z <> '')) <= 2)
             OR regexp_matches(lower(x), 'licensed under|all rights reserved|privacy policy|terms of service|terms of use|accept cookies|click here|sign up for') AS bad
      FROM s),
a AS (SELECT doc_id, count(*) AS n_lines, sum(CASE WHEN bad THEN 1 ELSE 0 END) AS n_bad, sum(CASE WHEN bad THEN 0 ELSE n END) AS left_chars FROM v GROUP BY doc_id),
o AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_bad, 0) AS BIGINT) AS n_bad_lines, coalesce(left_chars, 0) AS left_chars
      FROM w LEFT JOIN c USING (doc_id) LEFT JOIN a USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * left_chars >= 50 * word_chars AS kept, n_lines, n_bad_lines
FROM o
"""
