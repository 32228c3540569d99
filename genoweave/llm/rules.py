"""Quality rules: one table of thresholds compiled into one projection of built-in functions.

`RULES` is data: a ratio of two measures and the range it may take. `compile_rules` turns it into
one boolean column, and `measure` makes the measures; no user function, no shuffle, every text whole.

A null text counts as empty. No words: every ratio with a zero divisor is 0, and the base rule (at
least ten words) rejects the row. Very long texts are judged whole. Repeated rows are judged each. An empty table gives no rows.
Columns of `docs` that are not named below are handed through where the caller asks for them.

The rules are for English, German, French and Spanish. Texts of 50 words or more in other languages mostly lack
the stop words and are rejected, and so are those written without spaces, for their mean word length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of four languages.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from or an have not".split(),
    "de": "der die und in den von zu das mit sich des für auf im ist nicht dem eine ein als".split(),
    "fr": "de la le et les des en un du une est que pour qui dans par au pas sur avec".split(),
    "es": "de la que el en y los del se un las por con una para no su al lo como".split(),
}

#: (measure, divisor, least, most, words): a document of at least `words` words is kept when every
#: ratio lies in its range. Few words say nothing about function words.
RULES: list[tuple[str, str | None, float | None, float | None, int]] = [
    ("n_words", None, 10, None, 0),
    ("word_chars", "n_words", 2.0, 15.0, 0),
    ("n_symbols", "n_words", None, 0.25, 0),
    ("n_stop_words", "n_words", 0.005, None, 50),
    ("n_dup_lines", "n_lines", None, 0.5, 0),
    ("n_repeat_words", "n_words", None, 0.2, 0),
]

MEASURES = "n_words word_chars n_symbols n_lines n_dup_lines n_stop_words n_repeat_words".split()
SPACE = r"[\x20\x09-\x0D]+"
WORD_RUN = 5


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """Columns to `keep` (a measure of the same name replaces one) and the measures: `n_words`, `word_chars`, `n_symbols`, `n_lines`, `n_dup_lines`,
    `n_stop_words`, `n_repeat_words`."""
    keep = tuple(x for x in keep if x not in MEASURES)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*[F.col(x) for x in keep], text.alias("_text"))
    words = F.filter(F.split("_text", SPACE), lambda x: x != "")
    rows = rows.withColumn("_words", words)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    stop = sorted({y for z in STOP_WORDS.values() for y in z})
    # The hash of every run of five words, in order.
    runs = F.expr(
        f"transform(sequence(0, size(_words) - {WORD_RUN}), i -> xxhash64("
        + ", ".join(f"_words[i + {k}]" for k in range(WORD_RUN))
        + "))"
    )
    rows = rows.withColumn("_lines", lines).withColumn(
        "_runs", F.when(F.size("_words") >= WORD_RUN, runs).otherwise(F.expr("array()").cast("array<bigint>"))
    )
    # Runs found twice or more, by position: neighbours in the order of (hash, position) that agree.
    # Most texts have none, and are spared the sort.
    ordered = "array_sort(transform(_runs, (h, i) -> struct(h, i)))"
    starts = F.expr(
        f"""transform(array(named_struct('o', {ordered})), s ->
              array_sort(transform(filter(sequence(0, size(s.o) - 1), k ->
                  (k > 0 and s.o[k - 1].h = s.o[k].h) or (k < size(s.o) - 1 and s.o[k + 1].h = s.o[k].h)),
                k -> s.o[k].i)))[0]"""
    )
    covered = f"""aggregate(transform(sequence(0, size(p) - 1),
                 k -> if(k + 1 < size(p), least({WORD_RUN}, p[k + 1] - p[k]), {WORD_RUN})),
               0, (a, x) -> a + x)"""
    rows = rows.withColumn(
        "_starts",
        F.when(F.size(F.array_distinct("_runs")) < F.size("_runs"), starts).otherwise(F.expr("array()").cast("array<int>")),
    )
    measures = [
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
        F.char_length(F.regexp_replace("_text", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_words", lambda x: F.lower(x).isin(stop))).cast("long").alias("n_stop_words"),
        F.when(F.size("_starts") > 0, F.expr(f"transform(array(_starts), p -> {covered})[0]"))
        .otherwise(0)
        .cast("long")
        .alias("n_repeat_words"),
    ]
    # Out of a one-element array: a filter on a measure then stays above, where the planner would
    # otherwise repeat the whole expression for each use of the measure.
    rows = rows.select(*[F.col(x) for x in keep], F.explode(F.array(F.struct(*measures))).alias("_measures"))
    return rows.select(*keep, "_measures.*")


def ratio(measure: str, divisor: str | None) -> Column:
    if divisor is None:
        return F.col(measure)
    return F.when(F.col(divisor) > 0, F.col(measure) / F.col(divisor)).otherwise(F.lit(0.0))


def compile_rules(rules=RULES) -> Column:
    """One boolean column over the measures: every ratio lies in its range."""
    kept = F.lit(True)
    for measure, divisor, least, most, words in rules:
        value = ratio(measure, divisor)
        inside = F.lit(True)
        if least is not None:
            inside = inside & (value >= least)
        if most is not None:
            inside = inside & (value <= most)
        kept = kept & (inside if not words else inside | (F.col("n_words") < words))
    return kept


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(docs: DataFrame, *keep: str) -> DataFrame:
    """The measures, `base_failed` and `kept`."""
    rows = measure(docs, *keep)
    return rows.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & compile_rules()})
