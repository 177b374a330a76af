"""Quality rules as a short-circuit cascade.

Each rule is a condition over a text's words and lines. On a sample every
rule's cost (seconds a row) and selectivity (share of rows that it rejects) are
measured, and the rules are put in order of rejection per cost, so that later,
dearer rules run only on what the earlier ones left. All rules must pass, so
the order changes the time and never the verdict.

A rule's cost is that of a job which evaluates it ``REPEATS`` times on each row
of the stored sample, less that of the same job with a condition that reads one
number, so that what a job costs by itself cancels out; the median of some tries
counts. Rules that reject nothing in the sample come last, the cheaper first.

Only DataFrame operations are used. Repeated windows are found within a row:
hashes of a text's windows are compared as a set first, and only texts that
repeat one sort them by hash to find the places.

Defined results: a null or empty text has no words, counts of zero, and fails
the base rule on the number of words. Repeated rows each get a row, an empty table
gives an empty result, other columns are not read. A text's words, lines and
windows are arrays of one row, so a text must fit a row several times over.
"""

from __future__ import annotations

import time
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.words import SPACE, stored

SAMPLE_ROWS = 2000
REPEATS = 16  # evaluations of a rule on each row of the sample
TRIES = 3
LEAST = 1e-8  # seconds a row that any rule costs
RUN = 5  # words in a window that counts as repeated
SYMBOLS = "[#*$%&|<>]"

# Conditions that a text passes, over the columns of measures().
RULES = {
    "few_symbols": "10 * n_symbols <= n_words",
    "few_repeated_lines": "10 * n_dup_lines <= 3 * n_lines",
    "word_length": "word_chars between 3 * n_words and 7 * n_words",
    "not_shouting": "2 * size(filter(words, w -> w rlike '^[^a-z]*[A-Z][^a-z]*$')) <= n_words",
    "words_have_letters": "10 * size(filter(words, w -> w rlike '[A-Za-z]|[^ -~]')) >= 8 * n_words",
    "vocabulary": "10 * size(array_distinct(words)) >= n_words",
}
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"


def measures(docs: DataFrame) -> DataFrame:
    """(doc_id, words, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words) of whole texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select("doc_id", "text",
                       F.expr(f"filter(split(text, '[{SPACE}]+'), w -> w != '')".replace("\\", "\\\\")).alias("words"),
                       F.expr(f"filter(split(text, '\\n'), l -> l rlike '[^{SPACE}]')".replace("\\", "\\\\")).alias("lines"))
    window = ", ".join(f"get(words, i + {j})" for j in range(RUN))
    rows = rows.select("doc_id", "text", "words", "lines", F.expr(
        f"case when size(words) >= {RUN} then transform(sequence(0, size(words) - {RUN}), i -> xxhash64({window}))"
        " else array() end").alias("hashes"))
    rows = rows.select("doc_id", "text", "words", "lines", F.expr(
        "case when size(array_distinct(hashes)) < size(hashes)"
        " then sort_array(transform(hashes, (h, i) -> struct(h, i))) end").alias("found"))
    rows = rows.select("doc_id", "text", "words", "lines", F.expr(
        "sort_array(transform(filter(found, (x, j) -> get(found, j - 1).h <=> x.h or get(found, j + 1).h <=> x.h),"
        " x -> x.i))").alias("places"))
    covered = F.expr(f"aggregate(transform(places, (p, j) -> least({RUN}, coalesce(get(places, j + 1) - p, {RUN}))),"
                     " 0L, (a, n) -> a + n)")
    return rows.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _seconds(rows: DataFrame, condition: str) -> float:
    """Median time of a job that evaluates a condition on every row."""
    took = []
    for _ in range(TRIES):
        began = time.perf_counter()
        rows.agg(F.count_if(F.expr(condition))).first()
        took.append(time.perf_counter() - began)
    return median(took)


def measured(docs: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS
             ) -> dict[str, tuple[float, float]]:
    """(seconds a row, share of rows rejected) of each rule on a sample."""
    rows = docs.count()
    part = docs.select("doc_id", "text").sample(min(1.0, sample_rows / max(rows, 1)), seed=1)
    # Stored before it is filtered: a condition on the measures would be pushed
    # below them, and so into the functions over each text's words.
    part = stored(measures(part), "quality-sample").filter(f"not ({BASE_FAILED})")
    counts = part.agg(F.count(F.lit(1)), *[F.count_if(F.expr(f"not ({r})")) for r in rules.values()]).first()
    again = part.select("*", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("again"))
    idle = _seconds(again, "n_words >= 0")
    evaluations = max(1, counts[0]) * REPEATS
    return {name: (max((_seconds(again, rule) - idle) / evaluations, LEAST), counts[i + 1] / max(1, counts[0]))
            for i, (name, rule) in enumerate(rules.items())}


def ordered(docs: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules, most rejections for a second of work first."""
    found = measured(docs, rules, sample_rows)
    return sorted(rules, key=lambda n: (-found[n][1] / found[n][0], found[n][0]))


def cascade(order: list[str], rules: dict[str, str] = RULES) -> Column:
    """True where all rules pass; a rule is evaluated if those before passed."""
    steps = " ".join(f"when not ({rules[n]}) then false" for n in order)
    return F.expr(f"case when {BASE_FAILED} then false {steps} else true end")


def judged(docs: DataFrame, rules: dict[str, str] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The measures with ``base_failed`` and ``kept``, as a stored table."""
    order = ordered(docs, rules, sample_rows)
    found = measures(docs).withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", cascade(order, rules))
    return stored(found.drop("words"), "quality")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (
  SELECT r, i, words[i:i + 4] AS win
  FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)),
p AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM w) WHERE n > 1),
c AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM p) GROUP BY r),
m AS (
  SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN c USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 3 * n_lines
       AND word_chars BETWEEN 3 * n_words AND 7 * n_words
       AND 2 * len(list_filter(words, lambda x: regexp_matches(x, '^[^a-z]*[A-Z][^a-z]*$'))) <= n_words
       AND 10 * len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^ -~]'))) >= 8 * n_words
       AND 10 * len(list_distinct(words)) >= n_words AS kept
FROM b
"""
