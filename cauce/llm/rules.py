"""Quality rules: one table of thresholds, compiled into one projection of native expressions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cauce.llm.registry import query, table

WORD_BREAK = "[ \\t-\\r]+"
#: The symbol characters of the contract.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "are", "with", "this", "from", "by", "a",
    "der", "die", "das", "und", "zu", "den", "ist", "von", "für", "mit", "auf", "dem", "nicht", "ein", "eine",
    "le", "la", "les", "et", "des", "est", "un", "une", "du", "que", "en", "dans", "pour", "sur", "au", "par",
    "el", "los", "las", "una", "se", "del", "no", "por", "su", "y", "es", "como", "más", "así",
)


class Rule(NamedTuple):
    """A document fails if ``measure`` lies outside ``least .. most`` (either may be open)."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


#: Ratios are of whole documents; a document that the base rules reject is not kept either.
RULES: tuple[Rule, ...] = (
    Rule("few_words", "n_words", least=50),
    Rule("repeated_words", "repeat_ratio", most=0.5),
    Rule("word_length", "mean_word_chars", least=1.5, most=20.0),
    Rule("symbols", "symbols_per_word", most=0.1),
    Rule("stop_words", "stop_word_ratio", least=0.03),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
)
BASE_RULES = ("few_words", "repeated_words")


def _let(value: Column, use) -> Column:
    """Bind ``value`` once and use it any number of times; a lambda variable is never inlined."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeat_words(words: Column) -> Column:
    """Words lying in a three-word window whose words occur at two or more places of the text.

    Windows are compared by their 64-bit hash: equal neighbours after sorting show whether any
    repeats at all; only then are places sorted along and the covered words counted from the
    gaps between marked windows.
    """
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(
            F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)))

    def covered(h: Column) -> Column:
        places = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def marked(s: Column) -> Column:
            n = F.size(s)
            return F.filter(s, lambda x, j: F.when(
                j > 0, F.get(s, j - 1)["h"] == x["h"]).otherwise(False) | F.when(
                j + 1 < n, F.get(s, j + 1)["h"] == x["h"]).otherwise(False))

        def spread(at: Column) -> Column:
            gaps = F.transform(at, lambda p, j: F.when(j == 0, F.lit(3)).otherwise(
                F.least(F.lit(3), p - F.get(at, j - 1))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)

        return _let(places, lambda s: _let(F.array_sort(F.transform(marked(s), lambda x: x["i"])), spread))

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(windows(words), counted))


def _measures(text: Column, stop_words: Sequence[str]) -> Column:
    def of(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\r\x0b\x0c", "") != "")
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _let(lines, lambda x: F.struct(
                F.size(x).cast("long").alias("n"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup"))).alias("lines"),
            _repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*stop_words))).cast("long").alias("n_stop_words"),
        )

    return _let(F.filter(F.split(text, WORD_BREAK), lambda w: w != ""), of)


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
                  stop_words: Sequence[str] = STOP_WORDS, out: str = "quality") -> DataFrame:
    """Add one struct column ``out``: the counts, the ratios, each rule's verdict, ``base_failed`` and ``kept``.

    One projection, no shuffle, no function of Python. All columns of ``docs`` stay, also ones
    named like a measure, since the results live inside the struct; a column named ``out`` is
    replaced. NULL and empty texts have no words: all counts are 0, ratios 0, and the rules
    decide. Repeated rows are judged alike; an empty table gives an empty table.
    """
    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    def verdicts(m: Column) -> Column:
        ratios = {
            "n_words": m["n_words"].cast("double"),
            "repeat_ratio": ratio(m["n_repeat_words"], m["n_words"]),
            "mean_word_chars": ratio(m["word_chars"], m["n_words"]),
            "symbols_per_word": ratio(m["n_symbols"], m["n_words"]),
            "stop_word_ratio": ratio(m["n_stop_words"], m["n_words"]),
            "dup_line_ratio": ratio(m["lines"]["n_dup"], m["lines"]["n"]),
        }
        failed = {}
        for rule in rules:
            bad = F.lit(False)
            if rule.least is not None:
                bad = bad | (ratios[rule.measure] < rule.least)
            if rule.most is not None:
                bad = bad | (ratios[rule.measure] > rule.most)
            failed[rule.name] = bad
        base = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        rejected = base
        for bad in failed.values():
            rejected = rejected | bad
        return F.struct(
            *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_repeat_words", "n_stop_words")],
            m["lines"]["n_dup"].alias("n_dup_lines"),
            *[ratios[c].alias(c) for c in list(ratios)[1:]],
            *[bad.alias(f"failed_{name}") for name, bad in failed.items()],
            base.alias("base_failed"), (~rejected).alias("kept"))

    return docs.withColumn(out, _let(_measures(F.coalesce(F.col(text), F.lit("")), stop_words), verdicts))


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
_SQL = f"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS w FROM documents
), grams AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM words WHERE len(w) >= 3
), spelled AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM grams
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM spelled) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), counts AS (
  SELECT doc_id, len(w) AS n_words, length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS word_chars,
    length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines,
    coalesce(n, 0) AS n_repeat_words, len(list_filter(w, lambda x: lower(x) IN ({_STOP_SQL}))) AS n_stop
  FROM words LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT (base_failed OR word_chars / n_words < 1.5 OR word_chars / n_words > 20.0 OR n_symbols / n_words > 0.1
       OR n_stop / n_words < 0.03 OR coalesce(n_dup_lines / nullif(len(lines), 0), 0) > 0.5) AS kept
FROM judged
"""


@query("op9_quality_rules", _SQL)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])
