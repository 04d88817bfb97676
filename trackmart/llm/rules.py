"""Quality rules: one table of thresholds compiled into one projection.

Contract: a null text counts as empty; an empty text has no words and fails the base rule;
repeated rows are judged alike; an empty table gives an empty result; of the input only
``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import texts

SPACE = "[\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in is that for it was on with as be by this are from at or an have not a "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que est pour qui dans par sur au pas "
    "que el en y a los del se las por con no una su para es al"
).split()


@dataclass(frozen=True)
class Rule:
    """A document fails if ``numerator`` is not within [low, high] times ``denominator``."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 0.1),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 0.02, None),
    Rule("shouted_ratio", "n_shouted", "n_words", None, 0.5),
    Rule("stutter_ratio", "n_stutters", "n_words", None, 0.3),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 0.5),
    Rule("ellipsis_line_ratio", "n_ellipsis_lines", "n_lines", None, 0.3),
    Rule("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 0.9),
)


def _length_without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeated(windows: Column, n: Column) -> Column:
    """Words covered by windows that occur twice or more; ``windows`` holds (hash, place)."""
    again = F.filter(
        windows,
        lambda w, i: ((i > 0) & (F.get(windows, i - 1)["h"] == w["h"])) | ((i < n - 1) & (F.get(windows, i + 1)["h"] == w["h"])),
    )
    return F.sort_array(F.transform(again, lambda w: w["i"]))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the counts that the rules use, by built-in functions only.

    Windows of eight words are compared by 64-bit hashes within one text.
    """
    return _measured(texts(docs), "doc_id")


def _measured(source: DataFrame, carried: str) -> DataFrame:
    """The column ``carried`` with the counts of ``text``."""
    text = F.col("text")
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    blank = "\t\x0b\x0c\r"
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.trim(F.translate(x, blank, " " * len(blank)))) > 0)
    stop = F.array(*[F.lit(w) for w in dict.fromkeys(STOP_WORDS)])
    counted = source.select(
        carried,
        words.alias("words"),
        lines.alias("lines"),
        _length_without(text, SPACE_CHARS).cast("long").alias("word_chars"),
        (F.length(text) - _length_without(text, SYMBOLS)).cast("long").alias("n_symbols"),
    )
    n_words = F.size("words")
    hashed = counted.select(
        carried,
        "word_chars",
        "n_symbols",
        n_words.cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
        F.size(F.filter("words", lambda w: F.array_contains(stop, F.lower(F.rtrim(F.translate(w, ".,;:!?", "      ")))))).cast("long").alias("n_stop_words"),
        F.size(F.filter("words", lambda w: w.rlike("^\\p{Lu}{2}[^\\p{Ll}]*\\z"))).cast("long").alias("n_shouted"),
        F.size(F.filter("words", lambda w, i: (i > 0) & (F.get("words", i - 1) == w))).cast("long").alias("n_stutters"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.endswith("...") | x.endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("lines", lambda x: x.rlike("^[ \\t]*[-*•]"))).cast("long").alias("n_bullet_lines"),
    )
    starts = F.when(F.col("n_words") >= WINDOW, F.sequence(F.lit(1), (F.col("n_words") - (WINDOW - 1)).cast("int"))).otherwise(F.array().cast("array<int>"))
    windows = hashed.withColumn("windows", F.transform(starts, lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))).drop("hashes")
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    ranked = windows.withColumn(
        "ranked",
        F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    ).drop("windows")
    places = ranked.withColumn("places", _repeated(F.col("ranked"), F.size("ranked"))).drop("ranked")
    covered = F.aggregate(
        F.transform("places", lambda p, i: F.when(i == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), p - F.get("places", i - 1)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    return places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("places")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """All rules as one condition: true if a document passes."""
    passed = F.lit(True)
    for rule in rules:
        value, base = F.col(rule.numerator).cast("double"), F.col(rule.denominator).cast("double")
        if rule.low is not None:
            passed = passed & (value >= rule.low * base)
        if rule.high is not None:
            passed = passed & (value <= rule.high * base)
    return passed


def oracle_sql(rules: tuple[Rule, ...] = RULES, min_words: int = 20, repeat_percent: int = 30) -> str:
    """The same projection for DuckDB, over its view ``documents``."""
    checks = [f"n_words < {min_words} OR 100 * n_repeat_words > {repeat_percent} * n_words"]
    for rule in rules:
        for bound, sign in ((rule.low, ">="), (rule.high, "<=")):
            if bound is not None:
                checks.append(f"{rule.numerator}::DOUBLE {sign} {bound}::DOUBLE * {rule.denominator}::DOUBLE")
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
    shouted = r"^\p{Lu}{2}[^\p{Ll}]*\z"
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    return f"""
    WITH rows_ AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
    split AS (
        SELECT *, regexp_extract_all(text, '{word}+') AS words,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines
        FROM rows_),
    windows AS (
        SELECT row_id, unnest(range(1, len(words) - {WINDOW - 2})) AS i,
               unnest(list_transform(range(1, len(words) - {WINDOW - 2}), lambda i: array_to_string(words[i:i + {WINDOW - 1}], ' '))) AS w
        FROM split),
    again AS (SELECT row_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY row_id, w) > 1),
    covered AS (
        SELECT row_id, count(DISTINCT place) AS n_repeat_words
        FROM (SELECT row_id, unnest(range(i, i + {WINDOW})) AS place FROM again) GROUP BY row_id),
    counted AS (
        SELECT doc_id, length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
               length(text) - length(regexp_replace(text, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
               len(words)::BIGINT AS n_words,
               len(list_filter(words, lambda w: list_contains([{stop}], lower(rtrim(translate(w, '.,;:!?', '      ')))))) AS n_stop_words,
               len(list_filter(words, lambda w: regexp_matches(w, '{shouted}'))) AS n_shouted,
               len(list_filter(words, lambda w, i: i > 1 AND words[i - 1] = w)) AS n_stutters,
               len(lines)::BIGINT AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
               len(list_filter(lines, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipsis_lines,
               len(list_filter(lines, lambda x: regexp_matches(x, '^[ \\t]*[-*•]'))) AS n_bullet_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM split LEFT JOIN covered USING (row_id))
    SELECT *, ({checks[0]}) AS base_failed, NOT ({checks[0]}) AND {" AND ".join(checks[1:])} AS kept FROM counted"""


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """Counts, ``base_failed`` and ``kept`` for every document."""
    return _judged(measures(docs), rules, min_words, repeat_percent)


def _judged(measured: DataFrame, rules: tuple[Rule, ...], min_words: int, repeat_percent: int) -> DataFrame:
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    judged = measured.withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & verdict(rules))


def keep_passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    source = docs.select(F.struct("*").alias("document"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    judged = _judged(_measured(source, "document"), rules, min_words, repeat_percent)
    # Not a filter: that would be moved below the projections, with all their expressions in it.
    return judged.select(F.inline(F.when(F.col("kept"), F.array("document"))))
