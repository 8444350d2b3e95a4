"""Quality rules: a threshold table compiled into one projection of text measures.

Everything is built from Spark's own functions. Words are ``[^\\x20\\x09-\\x0D]+``.

Defined cases: a null text has no words; a text without words fails
(``n_words`` is below the least number); repeated rows are judged each on its
own; an empty table gives an empty result; other columns are not read by
:func:`judged` and pass unchanged through :func:`keep_good`, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from playlake.llm.rows import SPACES

SYMBOLS = "#*$%&|<>"

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was with as be by on this are at from or an have not "
    "der die das und den von zu mit sich des ein eine nicht im dem auf ist als auch es "
    "le la les de du des et un une en que qui dans pour par sur au avec est pas "
    "el los las del y por con para una su al lo como más se no"
).split()


@dataclass(frozen=True)
class Rule:
    """Keep texts whose ``measure`` lies between ``least`` and ``most``."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def passes(self) -> Column:
        value, tests = F.col(self.measure), []
        if self.least is not None:
            tests.append(value >= self.least)
        if self.most is not None:
            tests.append(value <= self.most)
        return F.coalesce(tests[0] if len(tests) == 1 else tests[0] & tests[1], F.lit(False))


#: Beyond the base rules; ratios are per word or per line with a word.
RULES = (
    Rule("mean_word_length", "mean_word", 2.0, 20.0),
    Rule("symbols", "symbol_ratio", most=0.1),
    Rule("stop_words", "stop_ratio", least=0.02),
    Rule("repeated_lines", "dup_line_ratio", most=0.5),
    Rule("marked_lines", "marked_line_ratio", most=0.9),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def measured(table: DataFrame, keep: Column) -> DataFrame:
    """``keep`` and the measures of ``text``: three projections over the scan.

    Repeated windows: the windows of a text are sorted with their places, so equal
    ones stand side by side; each repeated place then covers three words, less
    what the next one covers. Texts without a repeated window skip the sort.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    first = table.select(
        keep.alias("kept_row"),
        _words(text).alias("words"),
        F.filter(
            F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0
        ).alias("lines"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    starts = F.slice("words", 1, F.greatest(F.size("words") - 2, F.lit(0)))
    second = first.select(
        "*",
        F.transform(
            starts,
            lambda w, i: F.concat(
                w, F.lit(" "), F.get("words", i + 1), F.lit(" "), F.get("words", i + 2)
            ),
        ).alias("windows"),
    )
    third = second.select(
        "*",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(
                F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))
            ),
        ).alias("sorted"),
    )
    same = lambda s, k: F.coalesce(F.get("sorted", k)["w"] == s["w"], F.lit(False))
    fourth = third.select(
        "*",
        F.sort_array(
            F.transform(
                F.filter(
                    "sorted", lambda s, k: F.when(k > 0, same(s, k - 1)).otherwise(False) | same(s, k + 1)
                ),
                lambda s: s["i"],
            )
        ).alias("places"),
    )
    covered = F.aggregate(
        F.transform(
            "places", lambda p, k: F.least(F.coalesce(F.get("places", k + 1) - p, F.lit(3)), F.lit(3))
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    words, lines = F.size("words"), F.size("lines")
    marks = ("-", "*", "•", "...", "…")
    marked = lambda x: F.trim(x).startswith(marks[0]) | F.trim(x).startswith(marks[1]) | F.trim(
        x
    ).startswith(marks[2]) | x.endswith(marks[3]) | x.endswith(marks[4])
    return fourth.select(
        "kept_row",
        # Not deterministic for Spark, so a filter that reads it stays above this
        # projection instead of repeating its expressions below.
        F.monotonically_increasing_id().alias("place"),
        words.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (lines - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.when(words > 0, F.col("word_chars") / words).alias("mean_word"),
        F.when(words > 0, F.col("n_symbols") / words).alias("symbol_ratio"),
        F.when(
            words > 0, F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))) / words
        ).alias("stop_ratio"),
        F.when(lines > 0, 1 - F.size(F.array_distinct("lines")) / lines).alias("dup_line_ratio"),
        F.when(lines > 0, F.size(F.filter("lines", marked)) / lines).alias("marked_line_ratio"),
    )


def _verdicts() -> tuple[Column, Column]:
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    kept = ~failed
    for rule in RULES:
        kept = kept & rule.passes()
    return failed, kept


def judged(table: DataFrame) -> DataFrame:
    """One row per text: the base measures, ``base_failed``, ``kept`` and the ratios."""
    measures = measured(table, F.col("doc_id"))
    failed, kept = _verdicts()
    return measures.select(
        F.col("kept_row").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        kept.alias("kept"),
    )


def keep_good(table: DataFrame) -> DataFrame:
    """The rows of ``table`` that pass, with their columns as they were."""
    measures = measured(table, F.struct(*[F.col(f"`{c}`") for c in table.columns]))
    good = _verdicts()[1] & (F.col("place") >= 0)  # see ``place``: always true
    return measures.filter(good).select("kept_row.*")
