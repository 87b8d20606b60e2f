"""Quality rules: a table of thresholds compiled into one projection of Spark expressions.

Measures are plain columns over the text; a rule is ``(name, numerator, denominator, lowest,
highest)``, and a document is kept if every ratio lies within its bounds.  No user functions, no
shuffle: each row is judged alone, so a hot source, copies and lost executors do not matter.

Null text counts as empty: no words, fails the word count.  Repeated rows are judged alike, extra
columns pass through untouched (the measures are added under names of their own).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import BLANKS, whole_text, words_of

WINDOW = 8

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that for it was with as on be by this are from at or an not have which "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch er "
    "de la le les et des en un une du que qui dans est pour pas au sur avec ce par plus il "
    "el los las y una por con para del se no al lo como más su es"
)


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; a zero denominator passes."""

    name: str
    numerator: str
    denominator: str | None
    low: float | None
    high: float | None


#: The threshold table.  Word windows said twice are a rule of the contract, the rest follows the
#: usual filters of web corpora, set wide enough to leave ordinary prose of any language alone.
RULES = (
    Rule("few_words", "n_words", None, 20, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 0.30),
    Rule("word_length", "word_chars", "n_words", 1.5, 25.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.50),
    Rule("capitals", "n_capitals", "word_chars", None, 0.60),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, None),
)
BASE = ("few_words", "repeated_words")


def passes(rule: Rule) -> Column:
    """The rule as a comparison of integers scaled by 10,000, so that no rounding decides."""
    top, scale = F.col(rule.numerator), 10_000
    bottom = F.lit(1) if rule.denominator is None else F.col(rule.denominator)
    checks = []
    if rule.low is not None:
        checks.append(top * scale >= bottom * round(rule.low * scale))
    if rule.high is not None:
        checks.append(top * scale <= bottom * round(rule.high * scale))
    ok = checks[0] if len(checks) == 1 else checks[0] & checks[1]
    return ok if rule.denominator is None else (bottom == 0) | ok


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measures the rules name; the helper columns are dropped again."""
    body = whole_text(text)
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    words, grams = F.col("_words"), F.col("_grams")
    gram = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    # Pairs (hash, start) in order: equal windows are neighbours then.
    paired = F.sort_array(
        F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("i")))
    )
    pairs = F.col("_pairs")
    same = lambda i, j: F.coalesce(
        F.get(pairs, i)["h"] == F.get(pairs, j)["h"], F.lit(False)
    )
    twice = F.sort_array(
        F.transform(
            F.filter(pairs, lambda _, i: same(i, i - 1) | same(i, i + 1)), lambda x: x["i"]
        )
    )
    starts = F.col("_starts")
    steps = F.zip_with(
        F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))),
        F.slice(starts, 1, F.greatest(F.size(starts) - 1, F.lit(0))),
        lambda b, a: F.least(b - a, F.lit(WINDOW)),
    )
    covered = F.aggregate(steps, F.lit(WINDOW), lambda total, step: total + step)
    # A filter on these measures would be moved below the projection, with each of them written out
    # in full inside it, lambdas in lambdas; it stays above a column that numbers rows.
    nothing = F.least(F.lit(0).cast("long"), F.monotonically_increasing_id())
    stop = sorted({w for s in STOP_WORDS.split() for w in (s, s.capitalize())})
    return (
        docs.withColumns({"_words": words_of(body), "_lines": lines})
        .withColumn(
            "_grams",
            F.when(
                F.size("_words") >= WINDOW,
                F.transform(F.sequence(F.lit(0), F.size("_words") - WINDOW), gram),
            ),
        )
        .withColumn("_pairs", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), paired))
        .withColumn("_starts", F.when(F.col("_pairs").isNotNull(), twice))
        .withColumns(
            {
                "n_words": F.size("_words") + nothing,
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_symbols": (
                    F.length(body) - F.length(F.regexp_replace(body, "[#*$%&|<>]", ""))
                ).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": F.when(F.col("_starts").isNotNull(), covered)
                .otherwise(0)
                .cast("long"),
                "n_capitals": (
                    F.length(body) - F.length(F.regexp_replace(body, "[A-Z]", ""))
                ).cast("long"),
                "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(stop))).cast("long"),
            }
        )
        .drop("_words", "_lines", "_grams", "_pairs", "_starts")
    )


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Measures, ``failed`` (names of the rules that fail, in table order), ``base_failed``, ``kept``."""
    failed = F.filter(
        F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
    base = [~passes(r) for r in rules if r.name in BASE]
    any_base = base[0]
    for one in base[1:]:
        any_base = any_base | one
    every = passes(rules[0])
    for rule in rules[1:]:
        every = every & passes(rule)
    return measures(docs, text).withColumns(
        {"failed": failed, "base_failed": any_base, "kept": every}
    )


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only.

    Measured beside the row in a struct, so that a column of ``docs`` may bear any name.
    """
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                        F.col(f"`{text}`").alias("_text"))
    return judge(inner, rules, "_text").where("kept").select("_row.*")
