"""Quality rules: a table of thresholds compiled into one projection.

Every measure is a Spark expression over the text, so the whole table becomes one
projection over the scan: no user function, no shuffle, nothing gathered.

Edge cases: a null or empty text has no words and fails. Very long texts are measured
whole, in n log n steps. Rows are judged alone, so ties and repeated rows are judged
alike and an empty table gives an empty result. Input columns are never added to by
``kept_only``, so no name can clash; ``measured`` returns its own columns only.
"""

from __future__ import annotations

from typing import NamedTuple

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame

from rampline.llm.common import BLANK_RUN, BLANKS, let, words_of

SYMBOLS = "#*$%&|<>"

# Common function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this at from are or an "
    "der die das und ist nicht ein eine zu den mit von im auf für des sich dem er es "
    "le la les et est des un une que en du il pour dans au ce pas sur qui ne "
    "el los las de que y en un una por con del se lo para su al no"
).split()


class Rule(NamedTuple):
    """A text passes when ``low <= measure <= high``; None leaves a side open."""

    name: str
    measure: str
    low: float | None
    high: float | None


RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols", "symbols_per_word", None, 0.3),
    # One more stop word than found: a short text may well have none.
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
)

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def _repeat_words(words: Column) -> Column:
    """Words that lie in a window of five words found at least twice in the text.

    Windows are compared by their 64-bit hashes. Only where two are equal are they
    sorted with their places; covered words then follow from the gaps between places.
    """
    hashes = F.when(
        F.size(words) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(found: Column) -> Column:
        places = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(
            places,
            lambda p: F.array_sort(
                F.transform(
                    F.filter(
                        F.transform(
                            p,
                            lambda at, k: F.struct(
                                at["i"].alias("i"),
                                (
                                    F.coalesce(F.get(p, k - 1)["h"] == at["h"], F.lit(False))
                                    | F.coalesce(F.get(p, k + 1)["h"] == at["h"], F.lit(False))
                                ).alias("twice"),
                            ),
                        ),
                        lambda at: at["twice"],
                    ),
                    lambda at: at["i"],
                )
            ),
        )
        return let(
            repeated,
            lambda at: F.aggregate(
                F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)))),
                F.lit(0),
                lambda total, step: total + step,
            ),
        )

    return let(
        hashes, lambda found: F.when(F.size(F.array_distinct(found)) < F.size(found), covered(found)).otherwise(F.lit(0))
    )


def measures(text: Column) -> Column:
    """All measures of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    counted = let(
        words_of(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        ),
    )
    lines = let(
        F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0),
        lambda filled: F.struct(
            F.size(filled).cast("long").alias("n_lines"),
            (F.size(filled) - F.size(F.array_distinct(filled))).cast("long").alias("n_dup_lines"),
        ),
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.when(whole > 0, whole), F.lit(0.0))

    def complete(found: Column) -> Column:
        words, line = found["words"], found["lines"]
        return F.struct(
            words["n_words"].alias("n_words"),
            found["word_chars"].alias("word_chars"),
            found["n_symbols"].alias("n_symbols"),
            line["n_dup_lines"].alias("n_dup_lines"),
            words["n_repeat_words"].alias("n_repeat_words"),
            ratio(found["word_chars"], words["n_words"]).alias("mean_word_chars"),
            ratio(found["n_symbols"], words["n_words"]).alias("symbols_per_word"),
            ratio(words["n_stop_words"] + 1, words["n_words"]).alias("stop_word_ratio"),
            ratio(line["n_dup_lines"], line["n_lines"]).alias("dup_line_ratio"),
        )

    return let(
        F.struct(
            counted.alias("words"),
            lines.alias("lines"),
            F.length(F.regexp_replace(text, BLANK_RUN, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        ),
        complete,
    )


def judged(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The measures of a text, ``base_failed``, the names of the rules it breaks, and ``kept``."""

    def compiled(found: Column) -> Column:
        base_failed = (found["n_words"] < MIN_WORDS) | (
            100 * found["n_repeat_words"] > MAX_REPEAT_PERCENT * found["n_words"]
        )
        broken = [
            F.when(
                (F.lit(False) if rule.low is None else found[rule.measure] < rule.low)
                | (F.lit(False) if rule.high is None else found[rule.measure] > rule.high),
                F.lit(rule.name),
            )
            for rule in rules
        ]
        return F.struct(
            found.alias("measures"),
            base_failed.alias("base_failed"),
            F.array_compact(F.array(F.lit(None).cast("string"), *broken)).alias("broken"),
        )

    return let(
        let(measures(text), compiled),
        lambda v: F.struct(
            v["measures"].alias("measures"),
            v["base_failed"].alias("base_failed"),
            v["broken"].alias("broken"),
            (~v["base_failed"] & (F.size(v["broken"]) == 0)).alias("kept"),
        ),
    )


MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document its measures, ``base_failed``, ``kept`` and the broken rules."""
    found = docs.select(F.col("doc_id"), judged(F.col("text"), rules).alias("v"))
    return found.select(
        "doc_id",
        *[F.col(f"v.measures.{name}").alias(name) for name in MEASURED],
        F.col("v.base_failed").alias("base_failed"),
        F.col("v.kept").alias("kept"),
        F.col("v.broken").alias("broken"),
    )


def kept_only(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their columns as they are."""
    return docs.where(judged(docs["text"], rules)["kept"])
