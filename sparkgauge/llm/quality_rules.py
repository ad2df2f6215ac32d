"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every text gets counts (words, characters, symbols, repeated lines and words) and from
these a few ratios between 0 and 1. A rule rejects a text whose ratio reaches a cutoff.
Which cutoffs may be used is decided per stratum on labelled texts: with n good texts of
which f would be rejected, a cutoff is certified if the exact binomial bound says that
its true rate of false rejection is at most the rule's share of the allowed risk, that is
P(Binomial(n, risk) <= f) <= delta / (number of tests). Dividing by all tests (strata x
rules x cutoffs) corrects for multiple testing, so with probability 1 - delta no stratum
loses more good texts than allowed, whichever certified cutoff is taken. Of the certified
ones a rule takes the one that separates labelled bad from good texts best (the most
lenient of equals); a rule without one stays off in that stratum.

All counts are worked out inside the row of the text; only labelled rows are shuffled, as
counts per (stratum, rule, bin).

Defined results
  - null, empty or blank texts have no words: all counts 0, base_failed;
  - a null stratum is a stratum of its own; strata without labels have no certified cutoff,
    so only the base rules reject there;
  - labels without a text and null labels count nowhere; repeated label rows count once if
    equal; an id labelled good and bad counts in both groups;
  - repeated rows are judged row by row; empty tables give an empty result;
  - other columns of the inputs are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkgauge.llm.common import small, store

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"  # what is not a symbol
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

RULES = ("symbols", "capitals", "repeated_lines", "repeated_words")
CUTOFFS = 20  # a ratio falls in one of so many bins; cutoffs are the bins' lower ends but 0
RISK = 0.08  # rate of false rejection that all rules together may have in a stratum
DELTA = 0.05  # probability that the bound fails anywhere


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum: Column | None = None) -> DataFrame:
    """One row per text: doc_id, stratum, n_words, word_chars, n_symbols, n_capitals, n_lines, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(stratum if stratum is not None else F.lit(""), F.lit("")).alias("stratum"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)).alias("lines"),
    )
    rows = rows.select(
        "doc_id",
        "stratum",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("_h"),
    )
    return _repeated_words(rows)


def _repeated_words(rows: DataFrame) -> DataFrame:
    """n_repeat_words from the word hashes _h, which are dropped.

    A 3-word window becomes its whole hash with its position. Sorted, equal windows are
    neighbours; the positions of windows with an equal neighbour, sorted again, say how many
    words they cover.
    """
    hashed = rows.withColumn(
        "_t",
        F.expr(
            "CASE WHEN size(_h) > 2 THEN transform(sequence(0, size(_h) - 3),"
            " i -> xxhash64(get(_h, i), get(_h, i + 1), get(_h, i + 2))) ELSE CAST(array() AS array<bigint>) END"
        ),
    )
    ordered = hashed.withColumn("_s", F.expr("sort_array(transform(_t, (h, i) -> named_struct('h', h, 'i', CAST(i AS BIGINT))))"))
    twice = ordered.withColumn(
        "_p",
        F.expr(
            "sort_array(transform(filter(_s, (x, i) ->"
            " coalesce(x.h = get(_s, i - 1).h, false) OR coalesce(x.h = get(_s, i + 1).h, false)),"
            " x -> x.i))"
        ),
    )
    covered = "aggregate(transform(_p, (p, i) -> least(3L, coalesce(get(_p, i + 1) - p, 3L))), 0L, (a, x) -> a + x)"
    return twice.withColumn("n_repeat_words", F.expr(covered)).drop("_h", "_t", "_s", "_p")


def ratios() -> dict[str, Column]:
    """The ratio of every rule from the counts."""
    one = F.lit(1)
    return {
        "symbols": F.col("n_symbols") / F.greatest("word_chars", one),
        "capitals": F.col("n_capitals") / F.greatest("word_chars", one),
        "repeated_lines": F.col("n_dup_lines") / F.greatest("n_lines", one),
        "repeated_words": F.col("n_repeat_words") / F.greatest("n_words", one),
    }


def bin_of(ratio: Column) -> Column:
    return F.least(F.floor(ratio * CUTOFFS), F.lit(CUTOFFS - 1)).cast("int")


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x >= 1 by Stirling's series at x + 8, exact to about 1e-14."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, F.lit(3))) + 1 / (1260 * F.pow(z, F.lit(5))) - 1 / (1680 * F.pow(z, F.lit(7)))
    shift = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return (z - 0.5) * F.log(z) - z + 0.9189385332046727 + series - shift


def binomial_cdf(n: Column, f: Column, p: Column) -> Column:
    """P(Binomial(n, p) <= f), exact: the terms from f downward until they no longer count.

    Below the mean the terms shrink at least as fast as a normal tail, so 40 standard
    deviations and 100 terms are all that a double can hold.
    """
    top = F.exp(log_gamma(n + 1.0) - log_gamma(f + 1.0) - log_gamma(n - f + 1.0) + f * F.log(p) + (n - f) * F.log(1 - p))
    terms = F.least(f, F.ceil(F.sqrt(n * p * (1 - p)) * 40 + 100)).cast("long")
    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), terms),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, i: F.struct(
            (a["sum"] + a["term"]).alias("sum"),
            (a["term"] * (f - i) * (1 - p) / ((n - f + i + 1) * p)).alias("term"),
        ),
        lambda a: a["sum"],
    )
    return F.when(f >= n, F.lit(1.0)).otherwise(F.least(F.lit(1.0), top * total))


def certified_cutoffs(counts: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """The cutoff bin of every rule that is on: stratum, rule, cutoff, n_good, false_rejections, bound."""
    marks = (
        labels.select(F.col("doc_id"), (F.col("quality") == 1).alias("good"))
        .filter("doc_id IS NOT NULL AND good IS NOT NULL")
        .distinct()
    )
    stack = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), bin_of(x).alias("bin")) for r, x in ratios().items()]))
    bins = (
        counts.join(marks, "doc_id")
        .select("stratum", "good", stack.alias("x"))
        .groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.bin").alias("bin"))
        .agg(F.count_if("good").alias("g"), F.count_if(~F.col("good")).alias("b"))
    )
    # A row for every bin of every stratum that has labels; from here on rows are strata x rules x bins.
    bins = store(bins, "bins")
    grid = bins.select("stratum", "rule").distinct().select("stratum", "rule", F.explode(F.sequence(F.lit(0), F.lit(CUTOFFS - 1))).alias("bin"))
    up = Window.partitionBy("stratum", "rule").orderBy(F.col("bin").desc())
    every = Window.partitionBy("stratum", "rule")
    strata = bins.select("stratum").distinct().count()
    at = (
        grid.join(bins, ["stratum", "rule", "bin"], "left")
        .na.fill(0, ["g", "b"])
        .select(
            "stratum",
            "rule",
            F.col("bin").alias("cutoff"),
            F.sum("g").over(every).alias("n_good"),
            F.sum("b").over(every).alias("n_bad"),
            F.sum("g").over(up).alias("false_rejections"),
            F.sum("b").over(up).alias("caught"),
        )
        .filter("cutoff > 0 AND caught > 0 AND n_good > 0")
        .withColumn("bound", binomial_cdf(F.col("n_good"), F.col("false_rejections"), F.lit(risk / len(RULES))))
        .filter(F.col("bound") <= delta / max(1, strata * len(RULES) * (CUTOFFS - 1)))
        .withColumn("gain", F.round(F.col("caught") / F.col("n_bad") - F.col("false_rejections") / F.col("n_good"), 9))
    )
    best = Window.partitionBy("stratum", "rule").orderBy(F.col("gain").desc(), F.col("cutoff").desc())
    return (
        at.withColumn("_r", F.row_number().over(best))
        .filter("_r = 1 AND gain > 0")
        .select("stratum", "rule", "cutoff", "n_good", "false_rejections", "bound")
    )


def quality_rules(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, stratum_col: str = "lang") -> DataFrame:
    """Per text: doc_id, the counts, base_failed, n_rules_hit, kept."""
    counts = store(text_counts(docs, stratum=F.col(stratum_col).cast("string")), "text-counts")
    cutoffs = certified_cutoffs(counts, labels, risk, delta)
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    hit = sum(
        (F.coalesce(bin_of(x) >= F.col("cutoffs")[r], F.lit(False)).cast("int") for r, x in ratios().items()), F.lit(0)
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        counts.join(small(store(by_stratum, "cutoffs")), "stratum", "left")
        .withColumn("base_failed", base_failed)
        .withColumn("n_rules_hit", hit)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "n_rules_hit",
            (~F.col("base_failed") & (F.col("n_rules_hit") == 0)).alias("kept"),
        )
    )
