"""Quality rules: a table of thresholds compiled into one Spark projection.

Defined results: a NULL or empty text has no words, fails the base rule and is
not kept; repeated rows are judged one by one; an empty table gives no rows;
columns of the input whose names clash with a metric are left out of the
computation (metrics live in one struct) and `filter_quality` returns the
input's columns unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import table

WINDOW = 8

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as by this are or from at "
    "de la le les et des un une en que qui du pour dans est sur au par pas avec "
    "el los las y del se por con su para al lo como no "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine"
).split()


@dataclass(frozen=True)
class Rule:
    """A metric must lie in [low, high]; None leaves a side open."""

    metric: str
    low: float | None = None
    high: float | None = None


RULES = (
    Rule("n_words", low=20),
    Rule("mean_word_chars", low=2.0, high=15.0),
    Rule("symbols_per_word", high=0.3),
    Rule("marks_per_word", high=0.5),
    Rule("capitals_share", high=0.5),
    Rule("stop_word_share", low=0.02),
    Rule("dup_line_share", high=0.5),
    Rule("echo_word_share", high=0.3),
    Rule("repeat_word_share", high=0.3),
)

_SPACES = " \t\n\x0b\f\r"


def _words(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(_SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[ \t\n\x0B\f\r]+"))


def _without(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def _window_hashes(word_hashes: Column) -> Column:
    size = F.size(word_hashes)
    return F.when(
        size >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), size - WINDOW),
            lambda i: F.xxhash64(*[F.get(word_hashes, i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _sorted_windows(words: Column) -> Column:
    """All word windows with their starts, in the order of their text."""
    return F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.struct(F.concat_ws(" ", F.slice(words, i + 1, WINDOW)).alias("k"), i.alias("i")),
        )
    )


def _repeated_starts(windows: Column) -> Column:
    """Starts, ascending, of the windows whose text occurs twice or more."""

    def same(i: Column, j: Column) -> Column:
        return F.coalesce(F.get(windows, i)["k"] == F.get(windows, j)["k"], F.lit(False))

    places = F.filter(
        F.sequence(F.lit(0), F.size(windows) - 1),
        lambda j: same(j, j + 1) | ((j > 0) & same(j, F.greatest(j - 1, F.lit(0)))),
    )
    return F.array_sort(F.transform(places, lambda j: F.get(windows, j)["i"]))


def _covered(starts: Column) -> Column:
    """Words covered by windows at these ascending starts."""
    steps = F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def with_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` packed into column `_row`, with struct `_m` of all metrics.

    The projections are stacked so that the word and hash arrays are built once
    per row; nothing is shuffled.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.struct("*").alias("_row"), whole.alias("_t")).select("*", _words(F.col("_t")).alias("_w"))
    rows = rows.select("*", F.transform("_w", lambda w: F.xxhash64(w)).alias("_wh"))
    rows = rows.select("*", _window_hashes(F.col("_wh")).alias("_h"))
    suspect = F.size(F.array_distinct("_h")) < F.size("_h")
    rows = rows.select("*", F.when(suspect, _sorted_windows(F.col("_w"))).alias("_s"))
    rows = rows.select("*", F.when(F.col("_s").isNotNull(), _repeated_starts(F.col("_s"))).alias("_p"))
    lines = F.filter(F.split("_t", "\n", -1), lambda line: F.trim(line, F.lit(_SPACES)) != "")
    rows = rows.select(
        "_row",
        "_t",
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_t") - _without(F.col("_t"), r"[^ \t\n\x0B\f\r]+")).cast("long").alias("word_chars"),
        _without(F.col("_t"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _without(F.col("_t"), r"[^!?]+").alias("n_marks"),
        _without(F.col("_t"), r"[^A-Z]+").alias("n_capitals"),
        _without(F.col("_t"), r"[^A-Za-z]+").alias("n_letters"),
        F.size(F.filter("_w", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_wh", lambda h, i: (i > 0) & (h == F.get("_wh", i - 1)))).cast("long").alias("n_echo_words"),
        lines.alias("_l"),
        F.when(F.col("_p").isNotNull(), _covered(F.col("_p"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
    )

    def share(a: str | Column, b: str) -> Column:
        return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))

    rows = rows.select("*", F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"))
    metrics = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word_chars"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_marks", "n_words").alias("marks_per_word"),
        share("n_capitals", "n_letters").alias("capitals_share"),
        share("n_stop_words", "n_words").alias("stop_word_share"),
        share("n_echo_words", "n_words").alias("echo_word_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_word_share"),
    ]
    return rows.select("_row", F.struct(*metrics).alias("_m"), F.spark_partition_id().alias("_part"))


def compiled(rules: tuple[Rule, ...], metrics: Column) -> Column:
    """The rule table as one boolean expression."""
    verdict = F.lit(True)
    for rule in rules:
        value = metrics[rule.metric]
        if rule.low is not None:
            verdict = verdict & (value >= rule.low)
        if rule.high is not None:
            verdict = verdict & (value <= rule.high)
    return verdict


def base_failed(metrics: Column) -> Column:
    return (metrics["n_words"] < 20) | (100 * metrics["n_repeat_words"] > 30 * metrics["n_words"])


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """`_row`, metrics `_m`, `_part`, `base_failed` and `kept` for every row."""
    rows = with_metrics(docs, text).withColumn("base_failed", base_failed(F.col("_m")))
    return rows.withColumn("kept", ~F.col("base_failed") & compiled(rules, F.col("_m")))


def filter_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """The rows that pass, with the input's own columns.

    The condition also names `_part`, which is not deterministic: else the filter
    would be pushed below the stacked projections and compute every array anew
    at each of its uses.
    """
    return judged(docs, rules, text).where(F.col("kept") & (F.col("_part") >= 0)).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    extra = ("mean_word_chars", "symbols_per_word", "stop_word_share")
    return judged(table(spark, sf_dir, "documents")).select(
        F.col("_row.doc_id").alias("doc_id"),
        *[F.col(f"_m.{m}").alias(m) for m in metrics],
        "base_failed",
        "kept",
        *[F.round(F.col(f"_m.{m}"), 6).alias(m) for m in extra],
    )
