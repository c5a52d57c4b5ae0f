"""Quality rules: a threshold table compiled into one projection of built-in functions.

Every measure is an expression over a text's words and lines; a rule gives the range in which a measure of a good text
lies. Nothing is shuffled, and no user function runs: a text's windows of eight words are hashed into one array, and
only where an array holds a hash twice are its windows sorted, to find which words they cover.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terraflux.llm.common import WHITE, table, text_or_empty

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = """a and are as at be by for from in is it of on that the this to was with
als auf das dem den der des die ein eine en er für im ist mit nicht sich und von zu
au avec dans de des du elle est et il la le les par pas pour que qui sur un une
al con del el es las lo los no para por se su una y""".split()
SPACES = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8


class Rule(NamedTuple):
    """A text is good if least <= measure <= most; None sets no bound."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: The base rules come first: their failure is base_failed.
BASE = (Rule("few_words", "n_words", least=20), Rule("repeated_windows", "repeat_percent", most=30))
RULES = (
    *BASE,
    Rule("word_length", "mean_word_length", least=3, most=12),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("wordless", "letter_words", least=0.7),
    Rule("no_prose", "stop_words", least=0.02),
    Rule("bullets", "bullet_lines", most=0.9),
    Rule("cut_off", "ellipsis_lines", most=0.3),
    Rule("repeated_lines", "dup_lines", most=0.5),
)

#: Measures by name, as SQL over the counts of measured(); the ratios of an empty text are 0.
MEASURES = {
    "n_words": "n_words",
    "repeat_percent": "100 * n_repeat_words / CAST(greatest(n_words, 1) AS double)",
    "mean_word_length": "word_chars / CAST(greatest(n_words, 1) AS double)",
    "symbols_per_word": "n_symbols / CAST(greatest(n_words, 1) AS double)",
    "letter_words": "n_letter_words / CAST(greatest(n_words, 1) AS double)",
    "stop_words": "n_stop_words / CAST(greatest(n_words, 1) AS double)",
    "bullet_lines": "n_bullet_lines / CAST(greatest(n_lines, 1) AS double)",
    "ellipsis_lines": "n_ellipsis_lines / CAST(greatest(n_lines, 1) AS double)",
    "dup_lines": "n_dup_lines / CAST(greatest(n_lines, 1) AS double)",
}
_BULLET, _ELLIPSIS = r"^[\x20\t]*([-*+•‣◦·–]|[0-9]{1,3}[.)])[\x20\t]", r"(\.\.\.|…)[\x20\t\r]*$"
_LETTERS = r"[A-Za-z\x{80}-\x{10FFFF}]"


def _bound(value: Column, body) -> Column:  # noqa: ANN001
    """body(value) with value worked out once, though a lambda inside body uses it for every element."""
    return F.transform(F.array(value), body)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash is found twice or more: windows in the order of their hash, those that are equal to
    a neighbour back in text order, and of each the words that the one before has not covered."""
    sorted_ = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    equal = lambda p, x, i: (F.get(p, i - 1)["h"].eqNullSafe(x["h"]) & (i > 0)) | F.get(p, i + 1)["h"].eqNullSafe(x["h"])
    starts = _bound(sorted_, lambda p: F.filter(F.transform(p, lambda x, i: F.when(equal(p, x, i), x["i"])), lambda i: i.isNotNull()))
    step = lambda to, i: F.struct((to["n"] + F.least(F.lit(WINDOW), i - to["last"])).alias("n"), i.alias("last"))
    return F.aggregate(F.sort_array(starts), F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), step, lambda to: to["n"])


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' struct `row` and the counts of each text: n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_bullet_lines, n_ellipsis_lines, n_letter_words, n_stop_words, n_repeat_words, all long.

    Windows are told apart by a 64-bit hash: in a text of a million words two of them share one with a chance of 3e-8.
    """
    body = text_or_empty(text)
    raw = docs.select(F.struct("*").alias("row"), body.alias("text"), F.trim(body, F.lit(SPACES)).alias("trimmed"))
    split = raw.select(
        "row", "text",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("trimmed", f"{WHITE}+")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "").alias("lines"),
    )
    n = F.size("words")
    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW)))
    hashed = split.select("*", F.when(n >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("hashes"))
    lower = F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))
    counts = {
        "n_words": n,
        "word_chars": F.length(F.array_join("words", "")),
        "n_symbols": F.length(F.regexp_replace("text", SYMBOLS.replace("[", "[^") + "+", "")),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_bullet_lines": F.size(F.filter("lines", lambda x: x.rlike(_BULLET))),
        "n_ellipsis_lines": F.size(F.filter("lines", lambda x: x.rlike(_ELLIPSIS))),
        "n_letter_words": F.size(F.filter("words", lambda w: w.rlike(_LETTERS))),
        "n_stop_words": F.size(lower),
        "n_repeat_words": F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), _covered(F.col("hashes"))).otherwise(0),
    }
    return hashed.select("row", *[c.cast("long").alias(name) for name, c in counts.items()])


def _fails(rule: Rule) -> str:
    """SQL: the measure lies outside the rule's range."""
    sides = [f"({MEASURES[rule.measure]}) {op} {bound}" for op, bound in (("<", rule.least), (">", rule.most)) if bound is not None]
    return f"({' OR '.join(sides) or 'false'})"


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """docs' struct `row`, the counts of measured(), failed array<string>: the names of the rules that the text breaks.

    A null text is an empty one, without words; repeated rows are judged alike; an empty table gives an empty result.
    Columns of docs travel in `row`, so that their names cannot clash.
    """
    unknown = {r.measure for r in rules} - MEASURES.keys()
    if unknown:
        raise ValueError(f"no such measures: {sorted(unknown)}")
    failed = F.array_compact(F.array(*[F.when(F.expr(_fails(r)), F.lit(r.name)) for r in rules]).cast("array<string>"))
    return measured(docs, text).withColumn("failed", failed)


def drop_by_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that break no rule."""
    return judge(docs, rules, text).filter(F.size("failed") == 0).select("row.*")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.arrays_overlap("failed", F.array(*[F.lit(r.name) for r in BASE]))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (F.size("failed") == 0).alias("kept"), F.array_join("failed", ",").alias("failed"),
    )


OP13_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, list_slice(words, i, i + {WINDOW - 1}) AS w FROM s, unnest(range(1, len(words) - {WINDOW - 2})) AS u(i)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
), covered AS (
  SELECT r, sum(least({WINDOW}, coalesce(i - before, {WINDOW}))) AS n FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM twice) GROUP BY r
), counts AS (
  SELECT doc_id, CAST(len(words) AS bigint) AS n_words, CAST(length(array_to_string(words, '')) AS bigint) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS bigint) AS n_symbols, len(lines) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '{_BULLET}'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '{_ELLIPSIS}'))) AS n_ellipsis_lines,
         len(list_filter(words, lambda x: regexp_matches(x, '{_LETTERS}'))) AS n_letter_words,
         len(list_filter(words, lambda x: lower(x) IN ({', '.join(f"'{w}'" for w in STOP_WORDS)}))) AS n_stop_words,
         CAST(coalesce(n, 0) AS bigint) AS n_repeat_words
  FROM s LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, array_to_string(list_filter([{', '.join(f"CASE WHEN {_fails(r)} THEN '{r.name}' END" for r in RULES)}], lambda x: x IS NOT NULL), ',') AS failed,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed = '' AS kept, failed FROM judged
"""
