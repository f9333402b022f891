"""Quality rules, line first, in built-in functions only.

Each line is judged by itself: punctuation runs and symbols, navigation, boilerplate,
stutter.
Lines that fail are taken out, and a document that loses too much of its text that way
is rejected. Documents that are too short or repeat themselves are rejected outright.
Everything happens within a row, so there is no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions.once import compute_once
from orderlake.llm.text import SPACE_CLASS, count_of, let, words_of

# Characters and patterns that the rules look for.
SYMBOLS = "[#*$%&|<>]"
CRIES = "[!?]{2,}"
BARS = "[|»›•]"
END_MARK = "[.!?:;,)\"'…]$"
NAVIGATION = (
    "(?i)\\b(home|menu|login|log in|sign in|sign up|search|next|previous|share|subscribe"
    "|contact us|about us|sitemap|back to top|read more|skip to content)\\b"
)
BOILERPLATE = (
    "(?i)(cookie policy|uses cookies|privacy policy|terms of (use|service)"
    "|enable javascript|lorem ipsum|subscribe to our newsletter|click here to)"
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules; a line or document at a limit passes."""

    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    #: Of a line's characters, and how many symbols are tolerated in any line.
    max_symbol_percent: int = 10
    tolerated: int = 2
    #: Words of a line for each run of !! or ??, and for each bar between menu items.
    words_per_cry: int = 5
    words_per_bar: int = 3
    menu_words: int = 4
    #: A line of at least so many words stutters if each of them comes so often on average.
    stutter_words: int = 12
    stutter_times: int = 4
    #: Of a document's characters, white space aside.
    max_lost_percent: int = 30


def _bare_length(text: Column) -> Column:
    return F.length(F.regexp_replace(text, f"[{SPACE_CLASS}]+", ""))


def _line_fails(line: Column, chars: Column, rules: LineRules) -> Column:
    return let(words_of(line), lambda words: _words_fail(line, words, chars, rules))


def _words_fail(line: Column, line_words: Column, chars: Column, rules: LineRules) -> Column:
    words = F.size(line_words)
    symbols = count_of(line, SYMBOLS)
    cries = count_of(line, CRIES)
    bars = count_of(line, BARS)
    punctuation = (
        (symbols > rules.tolerated) & (100 * symbols > rules.max_symbol_percent * chars)
    ) | ((cries > rules.tolerated) & (rules.words_per_cry * cries >= words))
    navigation = ((bars > rules.tolerated) & (rules.words_per_bar * bars >= words)) | (
        line.rlike(NAVIGATION) & (words <= rules.menu_words) & ~line.rlike(END_MARK)
    )
    stutter = (words >= rules.stutter_words) & (
        rules.stutter_times * F.size(F.array_distinct(line_words)) <= words
    )
    return (chars > 0) & (punctuation | navigation | stutter | line.rlike(BOILERPLATE))


def _lines(text: Column, rules: LineRules) -> Column:
    """Struct of what the line rules find in a document."""
    judged = F.transform(
        F.split(text, "\n"),
        lambda line: let(
            _bare_length(line),
            lambda chars: F.struct(
                line.alias("line"),
                chars.alias("chars"),
                _line_fails(line, chars, rules).alias("fails"),
            ),
        ),
    )

    def total(judged: Column, count: Column | None) -> Column:
        return F.aggregate(
            judged,
            F.lit(0).cast("bigint"),
            lambda n, x: n + F.when(x["fails"], x["chars"] if count is None else count)
            .otherwise(0)
            .cast("bigint"),
        )

    def found(judged: Column) -> Column:
        worded = F.transform(F.filter(judged, lambda x: x["chars"] > 0), lambda x: x["line"])
        return F.struct(
            let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w)))
            .cast("bigint")
            .alias("n_dup_lines"),
            total(judged, F.lit(1)).alias("n_lines_removed"),
            total(judged, None).alias("lost_chars"),
            F.array_join(
                F.transform(F.filter(judged, lambda x: ~x["fails"]), lambda x: x["line"]), "\n"
            ).alias("clean_text"),
        )

    return let(judged, found)


def _repeat_words(words: Column, window: int) -> Column:
    """Words that lie in a window of words found at least twice in the document.

    Windows are compared by 64-bit hashes of their words; within one document two
    different windows do not share one by any realistic chance.
    """
    zero = F.lit(0).cast("bigint")

    def covered(starts: Column) -> Column:
        first = F.struct(F.lit(-window).alias("last"), zero.alias("n"))
        return F.aggregate(
            starts,
            first,
            lambda a, p: F.struct(
                p.alias("last"),
                (a["n"] + F.least(F.lit(window), p - a["last"]).cast("bigint")).alias("n"),
            ),
            lambda a: a["n"],
        )

    def starts(by_hash: Column) -> Column:
        again = F.filter(
            by_hash,
            lambda x, i: (F.get(by_hash, i - 1)["h"] == x["h"]).eqNullSafe(True)
            | (F.get(by_hash, i + 1)["h"] == x["h"]).eqNullSafe(True),
        )
        return F.array_sort(F.transform(again, lambda x: x["p"]))

    def counted(hashes: Column) -> Column:
        by_hash = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))
        )
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            let(by_hash, lambda s: covered(starts(s))),
        ).otherwise(zero)

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (window - 1)),
        lambda i: F.xxhash64(F.slice(words, i, window)),
    )
    return F.when(F.size(words) > window, let(hashes, counted)).otherwise(zero)


def _counts(text: Column, rules: LineRules) -> Column:
    return let(
        words_of(text),
        lambda words: F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            _repeat_words(words, rules.window).alias("n_repeat_words"),
        ),
    )


#: Columns that the rules add, in this order.
RULE_COLUMNS = (
    "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed "
    "n_lines_removed lost_chars clean_text kept"
).split()


def apply_rules(
    docs: DataFrame, text_col: str = "text", rules: LineRules | None = None
) -> DataFrame:
    """All rows and columns of ``docs`` with RULE_COLUMNS behind them.

    ``clean_text`` is the text without the lines that failed. ``kept`` says whether the
    document passes: ``base_failed`` (too few words, or too many of them in repeated
    windows) rejects it, and so does losing more than ``max_lost_percent`` of its
    characters with its lines.

    A null text counts as an empty one (its ``clean_text`` is empty) and is rejected
    for its few words. Rows that repeat are judged one by one; keys are not looked at.
    A column of ``docs`` that bears the name of a rule column gives way to it.
    """
    rules = rules or LineRules()
    passed = docs.drop(*[c for c in RULE_COLUMNS if c != text_col])
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = compute_once(
        passed,
        _counts=_counts(text, rules),
        _lines=_lines(text, rules),
        _symbols=count_of(text, SYMBOLS).cast("bigint"),
    )
    n_words, repeated = F.col("_counts.n_words"), F.col("_counts.n_repeat_words")
    base_failed = (n_words < rules.min_words) | (
        100 * repeated > rules.max_repeat_percent * n_words
    )
    lost = 100 * F.col("_lines.lost_chars") > rules.max_lost_percent * F.col("_counts.word_chars")
    return found.select(
        *passed.columns,
        n_words.alias("n_words"),
        F.col("_counts.word_chars").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        F.col("_lines.n_dup_lines").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        base_failed.alias("base_failed"),
        F.col("_lines.n_lines_removed").alias("n_lines_removed"),
        F.col("_lines.lost_chars").alias("lost_chars"),
        F.col("_lines.clean_text").alias("clean_text"),
        (~base_failed & ~lost).alias("kept"),
    )
