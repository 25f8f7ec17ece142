"""Quality rules whose cutoffs come with a bound on false rejections.

For each stratum and rule, cutoffs of a fixed grid are tested on labelled good documents: a cutoff is
accepted if the exact binomial test rejects "it loses a share of ``risk`` or more", at a level divided by
the number of tests (strata x rules x cutoffs). The strictest accepted cutoff counts; where none is
accepted, the rule rejects nothing in that stratum. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.common import staged, text_or_empty

SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8

# Scores by rule (a high score is bad) and the cutoffs that are tested for each.
SCORES: dict[str, str] = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
    "long_words": "word_chars / greatest(n_words, 1)",
    "short_text": "1 / greatest(n_words, 1)",
}
GRID: dict[str, tuple[float, ...]] = {
    "symbols": (0.01, 0.02, 0.03, 0.05, 0.1, 0.2),
    "dup_lines": (0.05, 0.1, 0.2, 0.3, 0.5),
    "repeats": (0.02, 0.05, 0.1, 0.15, 0.2, 0.25),
    "long_words": (8.0, 9.0, 10.0, 12.0, 15.0, 20.0),
    "short_text": (0.02, 0.03, 0.04),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words covered by windows of eight words that occur twice or more in the text."""
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    def twice(pairs: Column) -> Column:
        """Start of each window whose hash has an equal neighbour in the sorted array."""
        found = F.filter(
            pairs,
            lambda x, i: F.get(pairs, i - 1)["h"].eqNullSafe(x["h"])
            | F.get(pairs, i + 1)["h"].eqNullSafe(x["h"]),
        )
        return F.array_sort(F.transform(found, lambda x: x["i"]))

    def of_hashes(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(let(pairs, twice), covered)
        )

    windows = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) >= 2 * 1 + WINDOW - 1, let(windows, of_hashes)).otherwise(F.lit(0).cast("long"))


def measures(text_col: str = "text") -> Column:
    """Struct of the base measures of a whole text; a null text has no words, lines or symbols."""
    text = text_or_empty(text_col)

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        )

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            repeated_words(words).alias("n_repeat_words"),
        )

    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"[{SPACE}]+", -1)
    )
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    return F.struct(
        let(words, of_words).alias("w"),
        let(lines, of_lines).alias("l"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )


def with_measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and a struct column ``_m`` of all measures, base verdict included."""
    found = docs.withColumn("_m", let(measures(text_col), lambda m: F.struct(
        m["w"]["n_words"].alias("n_words"),
        m["w"]["word_chars"].alias("word_chars"),
        m["n_symbols"].alias("n_symbols"),
        m["l"]["n_lines"].alias("n_lines"),
        m["l"]["n_dup_lines"].alias("n_dup_lines"),
        m["w"]["n_repeat_words"].alias("n_repeat_words"),
        ((m["w"]["n_words"] < 20) | (100 * m["w"]["n_repeat_words"] > 30 * m["w"]["n_words"])).alias("base_failed"),
    )))
    return found


def log_factorial(n: Column) -> Column:
    """ln n!: a sum up to 255, beyond it Stirling's series, whose error is below 1e-14 there."""
    x = n.cast("double")
    series = (
        x * F.log(x) - x + 0.5 * F.log(F.lit(2.0) * F.pi() * x) + 1 / (12 * x) - 1 / (360 * x * x * x)
    )
    small = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.least(n, F.lit(255))),
        F.lit(0.0),
        lambda s, i: s + F.log(i.cast("double")),
    )
    return F.when(n < 2, F.lit(0.0)).when(n <= 255, small).otherwise(series)


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(X <= k) for X binomial with ``n`` draws and chance ``risk``; 1 where k is not below the mean.

    Terms are summed downwards from k, where they are largest; 40 standard deviations hold all that a
    double can tell.
    """
    n_, k_ = n.cast("double"), k.cast("double")
    top = (
        log_factorial(n) - log_factorial(k) - log_factorial(n - k)
        + k_ * F.log(F.lit(risk)) + (n_ - k_) * F.log(F.lit(1 - risk))
    )
    steps = F.least(k, F.ceil(40 * F.sqrt(n_) + 200).cast("long"))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(state: Column, step: Column) -> Column:
        i = k_ - step + 1
        term = state["term"] * i / (n_ - i + 1) * F.lit((1 - risk) / risk)
        return F.struct(term.alias("term"), (state["total"] + term).alias("total"))

    total = F.aggregate(
        F.filter(F.sequence(F.lit(0).cast("long"), steps), lambda s: s > 0), start, add, lambda s: s["total"]
    )
    return F.when(k_ >= n_ * risk, F.lit(1.0)).otherwise(F.exp(top) * total)


def cutoffs(
    measured: DataFrame,
    good: DataFrame,
    stratum: str = "lang",
    id_col: str = "doc_id",
    risk: float = 0.01,
    level: float = 0.05,
    grid: Mapping[str, Sequence[float]] = GRID,
) -> DataFrame:
    """Accepted cutoff by stratum and rule: ``stratum``, and ``cut_<rule>`` (null: rejects nothing).

    ``measured`` has id, stratum and ``_m``; ``good`` the ids of labelled good documents (repeats and
    nulls count once or not at all). Documents that fail the base rules are left out, since they are
    rejected without a cutoff. ``risk`` is the largest share of good documents a rule may lose in a
    stratum and ``level`` the chance that any of the bounds is wrong.
    """
    marked = measured.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(stratum), F.lit("")).alias("stratum"), "_m"
    ).select("_id", "stratum", "_m.*")
    held_out = marked.where("NOT base_failed").join(
        good.select(F.col(good.columns[0]).alias("_id")).distinct(), "_id", "left_semi"
    )
    tests = [(rule, cut) for rule in grid for cut in grid[rule]]
    lost = [
        F.count_if(F.expr(SCORES[rule]) > cut).alias(f"lost_{i}") for i, (rule, cut) in enumerate(tests)
    ]
    counted = staged(held_out.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *lost), "risk-counts")
    each_level = level / max(1, counted.count() * len(tests))
    chosen = []
    for rule in grid:
        accepted = [
            F.when(binomial_tail(F.col("n"), F.col(f"lost_{i}"), risk) <= each_level, F.lit(cut))
            for i, (name, cut) in enumerate(tests)
            if name == rule
        ]
        chosen.append(F.array_min(F.array(*accepted)).alias(f"cut_{rule}"))
    return staged(counted.select("stratum", *chosen), "risk-cutoffs")


def judged(measured: DataFrame, cuts: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``kept``: not failed by the base rules, and no score above its cutoff.

    A stratum without labelled documents has no cutoffs and loses only what fails the base rules.
    """
    joined = measured.withColumn("_s", F.coalesce(F.col(stratum), F.lit(""))).join(
        cuts.withColumnRenamed("stratum", "_s"), "_s", "left"
    )
    kept = ~F.col("_m.base_failed")
    for rule, score in SCORES.items():
        value = F.expr(
            score.replace("n_", "_m.n_").replace("word_chars", "_m.word_chars")
        )
        kept = kept & F.coalesce(value <= F.col(f"cut_{rule}"), F.lit(True))
    return joined.select(*(F.col(c) for c in measured.columns), kept.alias("kept"))


def good_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents labelled good and never bad; rows without id or label do not count."""
    return (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.min("quality").alias("quality"))
        .where("quality = 1")
        .select(id_col)
    )


def quality_report(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang"
) -> DataFrame:
    """Measures and verdict of each row: id, the base measures, ``base_failed``, ``kept``.

    A null or empty text has no words and fails. Null strata are one stratum. Repeated rows are judged
    alike; an empty table gives no rows; without labels only the base rules reject. Other columns are
    not read.
    """
    slim = docs.select(
        F.col(id_col).alias("_id"), F.col(stratum).cast("string").alias("_stratum"), F.col(text_col).alias("text")
    )
    measured = staged(with_measures(slim).drop("text"), "quality-measures")
    cuts = cutoffs(measured, good_ids(labels, id_col), "_stratum", "_id")
    return judged(measured, cuts, "_stratum").select(F.col("_id").alias(id_col), "_m.*", "kept")


def kept_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: str = "lang"
) -> DataFrame:
    """Rows of ``docs`` that the rules keep, with all their columns, whatever their names.

    Cases are those of :func:`quality_report`.
    """
    packed = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns))).alias("_row")
    slim = docs.select(
        packed, F.col(id_col).alias("_id"), F.col(stratum).cast("string").alias("_stratum"), F.col(text_col).alias("_text")
    )
    measured = staged(with_measures(slim, "_text").drop("_text"), "quality-documents")
    cuts = cutoffs(measured, good_ids(labels, id_col), "_stratum", "_id")
    kept = judged(measured, cuts, "_stratum").where("kept")
    return kept.select(*(F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)))
