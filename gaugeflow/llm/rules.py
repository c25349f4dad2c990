"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.arrays import once

#: White space between words, and characters that count as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it with as was for be by on are this an at from or have not "
    "le la les de des du et un une est que qui dans pour par en au il elle "
    "der die das und ist zu ein eine mit von den auf nicht sich auch im "
    "el los las y por una para con no se del al su lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= feature <= high``; a bound of None is not tested."""

    feature: str
    low: float | None = None
    high: float | None = None


#: The thresholds, on the features of :data:`FEATURES`.
RULES = (
    Rule("n_words", low=50),
    Rule("mean_word_length", low=2.0, high=15.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.02),
    Rule("dup_line_ratio", high=0.5),
    Rule("repeat_word_ratio", high=0.5),
    Rule("bullet_line_ratio", high=0.9),
)

#: SQL of the features over the counts of :func:`count_text`; each is 0 for a text without words.
FEATURES = {
    "n_words": "n_words",
    "mean_word_length": "word_chars / greatest(n_words, 1)",
    "symbol_ratio": "n_symbols / greatest(word_chars, 1)",
    "stop_word_ratio": "n_stop_words / greatest(n_words, 1)",
    "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_word_ratio": "n_repeat_words / greatest(n_words, 1)",
    "bullet_line_ratio": "n_bullet_lines / greatest(n_lines, 1)",
}

#: A text fails whatever the rules say if this holds.
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _length_without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character))
    return F.length(text)


def _windows() -> Column:
    """64-bit hashes of the windows of three words."""
    pairs = "zip_with(words, slice(words, 2, size(words)), (a, b) -> xxhash64(a, b))"
    triples = f"zip_with({pairs}, slice(words, 3, size(words)), (a, b) -> xxhash64(a, b))"
    return F.expr(f"slice({triples}, 1, greatest(size(words) - 2, 0))")


def _repeat_words() -> Column:
    """Words in windows of three that the text has twice or more.

    Windows are compared by their hashes; two of a million windows of one text agree by chance once
    in 40 million such texts. Most texts have no repeated window. Else the hashes are sorted, so that
    equal ones are neighbours; the starts of those with an equal neighbour are put in order, and each
    adds the words up to the next one's.
    """
    repeated = """
        transform(
          filter(
            zip_with(
              zip_with(sorted, slice(sorted, 2, size(sorted)), (a, b) ->
                struct(a.i AS i, a.w AS w, coalesce(a.w = b.w, false) AS eq)),
              concat(array(cast(NULL AS struct<w:bigint,i:int>)), sorted), (a, b) ->
                struct(a.i AS i, a.eq OR coalesce(a.w = b.w, false) AS eq)),
            x -> x.i IS NOT NULL AND x.eq),
          x -> x.i)"""
    return F.expr(f"""
        CASE WHEN size(hashes) = size(array_distinct(hashes)) THEN 0L ELSE
          aggregate(
            array_sort(transform(
              array(array_sort(transform(hashes, (w, i) -> struct(w, i)))),
              sorted -> {repeated})[0]),
            struct(0L AS n, -3 AS last),
            (s, i) -> struct(s.n + least(3, i - s.last) AS n, i AS last),
            s -> s.n)
        END""")


def count_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every ``text``: words, characters, symbols, lines, repeats."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = once(
        rows,
        words=F.expr(r"filter(split(text, '[ \\x09-\\x0D]+'), w -> w <> '')"),
        lines=F.expr(r"filter(split(text, '\n', -1), l -> l rlike '[^ \\x09-\\x0D]')"),
    )
    rows = once(rows, hashes=_windows())
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _length_without(F.col("text"), SPACES).cast("long").alias("word_chars"),
        (F.length("text") - _length_without(F.col("text"), SYMBOLS))
        .cast("long")
        .alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words().alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS)))
        .cast("long")
        .alias("n_stop_words"),
        F.size(F.filter("lines", lambda line: line.rlike(r"^\s*[-*•]")))
        .cast("long")
        .alias("n_bullet_lines"),
    )


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table of thresholds as one boolean expression over the counts."""
    tests = [f"NOT ({BASE_FAILED})"]
    for rule in rules:
        value = f"({FEATURES[rule.feature]})"
        tests += [f"{value} >= {rule.low}"] * (rule.low is not None)
        tests += [f"{value} <= {rule.high}"] * (rule.high is not None)
    return F.expr(" AND ".join(f"({t})" for t in tests))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The counts of every text with ``base_failed`` and ``kept``.

    One row per row of ``docs``, repeated rows and null ids included; other columns are not read. A
    null text counts as one without words, fails and is not kept. An empty table gives no rows.
    """
    return count_text(docs).withColumns(
        {"base_failed": F.expr(BASE_FAILED), "kept": verdict(rules)}
    )
