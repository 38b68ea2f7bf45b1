"""Quality rules whose cutoffs are chosen with a guarantee on false rejection. Built-in functions only.

A ladder of rule sets runs from lenient to strict. For each stratum (language), the labelled
documents of good quality are a holdout: the ladder is fixed, so no label is used to
make it. Level by level the exact binomial tail of the rejected good documents is
tested against the allowed rate; the walk stops at the first level that fails (fixed-
sequence testing needs no further correction inside a stratum), and the error level is
divided by the number of strata (Bonferroni). The strictest level passed is in force.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimspark.llm.common import WORD_SPLIT, keep

#: Production parameters. Each level: a document is rejected where a value reaches its cutoff:
#: symbols per 1000 words, word characters per 100 words, repeated lines per 1000 lines,
#: repeated words per 1000 words.
LADDER = [
    (2000, 1200, 900, 495),
    (1000, 1000, 800, 490),
    (500, 900, 700, 480),
    (300, 850, 600, 470),
    (200, 800, 550, 460),
    (100, 750, 500, 450),
    (50, 720, 450, 440),
    (20, 700, 400, 430),
]
#: Largest share of good documents that may be rejected, and the chance that a cutoff breaks it.
RATE, RISK = 0.03, 0.05
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"]


def with_statistics(df: DataFrame) -> DataFrame:
    """df with the columns of STATS (long) for its column text; clashing columns are replaced.

    Words are runs outside blank, \\t, \\n, \\v, \\f and \\r. ``word_chars`` counts their code
    points, ``n_lines`` the lines with a word, ``n_dup_lines`` those equal to an earlier one,
    ``n_repeat_words`` the words in 3-word windows found twice or more. Null text: all 0.

    Steps are separate columns so that no array is worked out again for each element.
    """
    columns = [c for c in df.columns if c not in STATS]
    text = F.coalesce(F.col("text"), F.lit(""))
    blanks = " \t\n\x0b\f\r"
    w = df.select(*columns, text.alias("_t"), F.btrim(text, F.lit(blanks)).alias("_trimmed"))
    w = w.select(
        *columns,
        "_t",
        F.when(F.col("_trimmed") == "", F.array().cast("array<string>")).otherwise(F.split("_trimmed", WORD_SPLIT)).alias("_w"),
        F.expr(f"filter(split(_t, '\n'), x -> btrim(x, '{blanks}') != '')").alias("_lines"),
    )
    # the last two places hold windows that run over the end: they are cut off
    window = F.transform("_w", lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)))
    w = w.withColumn("_h", F.slice(window, 1, F.greatest(F.size("_w") - 2, F.lit(0))))
    w = w.select(
        *columns,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.col("_h")).alias("_h"),
    )
    # equal windows are neighbours once sorted; a text without repeated windows has a null here
    w = w.withColumn("_s", F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))))

    def repeated(x: Column, j: Column) -> Column:
        return (x["h"] == F.coalesce(F.get("_s", j + 1)["h"], F.bitwise_not(x["h"]))) | ((j > 0) & (x["h"] == F.coalesce(F.get("_s", j - 1)["h"], F.bitwise_not(x["h"]))))

    def cover(x: Column) -> Column:
        return F.array(x["i"], x["i"] + 1, x["i"] + 2)

    w = w.withColumn("_p", F.filter("_s", repeated))
    words = F.size(F.array_distinct(F.flatten(F.transform("_p", cover))))
    return w.select(*columns, *STATS[:-1], F.when(F.col("_h").isNull(), 0).otherwise(words).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def tripped(cutoffs: tuple[int, int, int, int]) -> Column:
    """Any rule of a level rejects; needs the columns of STATS."""
    symbols, chars, lines, words = cutoffs
    return (
        (F.col("n_symbols") * 1000 >= F.col("n_words") * symbols)
        | (F.col("word_chars") * 100 >= F.col("n_words") * chars)
        | (F.col("n_dup_lines") * 1000 >= F.greatest(F.col("n_lines"), F.lit(1)) * lines)
        | (F.col("n_repeat_words") * 1000 >= F.col("n_words") * words)
    )


def strictness() -> Column:
    """First (most lenient) level that rejects, or the number of levels."""
    out = F.lit(len(LADDER))
    for level in reversed(range(len(LADDER))):
        out = F.when(tripped(LADDER[level]), level).otherwise(out)
    return out


def log_gamma(x: Column) -> Column:
    """Natural logarithm of the gamma function for x >= 1 (Stirling's series at x + 8)."""
    y = x + 8.0
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    shift = sum((F.log(x + float(i)) for i in range(1, 8)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - shift


def log_binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """log P(Binomial(n, rate) <= k), exact; summed from k downwards, each term from the one above.

    Below the mean m = n * rate, i steps down shrink a term by exp(-i / m) at least, so J steps by exp(-J^2 / 2m). With
    J = 10 sqrt(m) + 100 that is 2e-22, and all terms further down together are under 1e-16 of the sum for m up to 10^12.
    """
    head = log_gamma(n + 1.0) - log_gamma(k + 1.0) - log_gamma(n - k + 1.0)
    head = head + k * math.log(rate) + (n - k) * math.log1p(-rate)
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))
    odds = (1 - rate) / rate

    def step(a: Column, i: Column) -> Column:  # term of i - 1 from that of i
        t = a["t"] * i / (n - i + 1.0) * odds
        return F.struct(t.alias("t"), (a["s"] + t).alias("s"))

    mean = n * rate
    low = F.least(k, mean) - 10 * F.sqrt(mean) - 100
    down = F.when(k >= 1, F.sequence(k.cast("long"), F.greatest(low, F.lit(1.0)).cast("long"), F.lit(-1).cast("long")))
    total = F.aggregate(down, start, step, lambda a: a["s"])
    return head + F.log(F.coalesce(total, F.lit(1.0)))


def certified_levels(judged: DataFrame, labels: DataFrame) -> DataFrame:
    """(stratum, level): the strictest level in force, for strata with one.

    judged: (doc_id, stratum, strict, base_failed). labels: (doc_id, quality). A document with
    several labels is good if one of them is; null labels, strata and ids do not count.
    """
    good = labels.where("quality = 1").select("doc_id").distinct()
    held = judged.where("not base_failed and stratum is not null").join(good, "doc_id", "left_semi")
    counts = held.groupBy("stratum").agg(
        F.count("*").cast("double").alias("n"),
        F.array(*[F.sum((F.col("strict") <= level).cast("double")) for level in range(len(LADDER))]).alias("rejected"),
    )
    counts = keep(counts)
    strata = counts.agg(F.count("*").cast("double").alias("strata"))  # one row
    tests = counts.select("stratum", "n", F.posexplode("rejected").alias("level", "k")).join(F.broadcast(strata))
    # a rate at or over the allowed one fails without a sum
    passed = F.when(F.col("k") < F.col("n") * RATE, log_binomial_tail(F.col("k"), F.col("n"), RATE) <= F.log(RISK / F.col("strata")))
    tests = tests.withColumn("passed", F.coalesce(passed, F.lit(False)))
    upto = Window.partitionBy("stratum").orderBy("level")
    tests = tests.withColumn("all_passed", F.min(F.col("passed").cast("int")).over(upto))
    return tests.where("all_passed = 1").groupBy("stratum").agg(F.max("level").alias("level"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base rule and verdict for each row of docs (doc_id, text, lang).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, level. Strata are values of lang; a null one, or one without enough labels, has the base
    rule alone (level null). Null text: no words, so the base rule rejects. Repeated rows and
    ids are judged one by one. Empty labels: base rule alone. No rows: no rows.
    """
    stats = with_statistics(docs.select("doc_id", "text", F.col("lang").alias("stratum"))).drop("text")
    judged = keep(stats.withColumn("base_failed", base_failed()).withColumn("strict", strictness()))
    levels = keep(certified_levels(judged, labels))
    return judged.join(levels, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", verdict().alias("kept"), "level"
    )


def verdict() -> Column:
    return ~F.col("base_failed") & F.coalesce(F.col("strict") > F.col("level"), F.lit(True))


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, all columns unchanged. Cases as in ``quality``.

    Rows are kept in the shared folder beside their statistics: those are worked out once.
    """
    row = F.struct(*docs.columns).alias("_row")
    rows = with_statistics(docs.select(row, "doc_id", "text", F.col("lang").alias("stratum"))).drop("text")
    rows = keep(rows.select("_row", "doc_id", "stratum", base_failed().alias("base_failed"), strictness().alias("strict")))
    levels = keep(certified_levels(rows, labels))
    return rows.join(levels, "stratum", "left").where(verdict()).select("_row.*")
