"""Quality rules whose cutoffs are chosen under control of the risk of rejecting good documents.

Each rule rejects a text whose measure is above a cutoff, and a text goes if any rule rejects it. What is
controlled is the risk of all rules together. The rules' cutoffs are tightened along one path that is fixed
beforehand (PATH), one cutoff a step. For each stratum (language) and step, the labelled good documents say
how many of them the joint cutoffs would reject; the exact binomial tail is the p-value of the claim that
they reject more than `risk` of all good documents of that stratum. Steps are tested in the path's order
until one can't be certified (so the order needs no correction), at a level divided by the number of strata
(Bonferroni). So with probability 1 - `error` the rules together reject no more than `risk` of the good
documents of any stratum; good documents are here those that pass the base rules. Of the certified steps the one that rejects most labelled bad documents is taken,
of equals the loosest. A stratum needs ln(error / strata) / ln(1 - risk) labelled good documents that pass the
base rules: with `error` 0.05 and four strata 437 at a risk of 1 %, 86 at 5 %. One with fewer gets no
cutoff, and keeps what the base rules keep.

Everything is DataFrame functions: no Python runs on the executors. Null and empty texts have no
words and fail the base rules. Null languages are a stratum of their own. If an id has several labels, the
least counts. Repeated rows get the same verdict. Without rows the result is empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import SPACES, unique_name, whole_text, written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
RISK = 0.01
ERROR = 0.05
# Cutoffs of each rule, fixed beforehand, from the loosest to the tightest.
CUTOFFS = {
    "symbol_share": [0.5, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "repeat_share": [0.3, 0.25, 0.2, 0.15, 0.1, 0.05],
    "word_length": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 10.0],
}
# The joint path: every cutoff in its turn, all rules going through their lists at the same pace.
PATH = [
    (rule, cutoff)
    for _, _, rule, cutoff in sorted(
        ((i + 1) / len(cutoffs), n, rule, cutoff)
        for n, (rule, cutoffs) in enumerate(CUTOFFS.items())
        for i, cutoff in enumerate(cutoffs)
    )
]
BLANKS = " \t\n\x0b\x0c\r"
STEPS = 300
SMALL = 10_000


def with_counts(docs: DataFrame, text: Column) -> DataFrame:
    """`docs` with _n_words, _word_chars, _n_symbols, _n_lines, _n_dup_lines and _n_repeat_words."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    long = lambda c: c.cast("bigint")
    out = docs.select(
        *docs.columns,
        F.transform(words, lambda w: F.xxhash64(w)).alias("_hashes"),
        lines.alias("_lines"),
        long(F.length(F.regexp_replace(text, SPACES, ""))).alias("_word_chars"),
        long(F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))).alias("_n_symbols"),
    ).select(
        *docs.columns,
        "_word_chars",
        "_n_symbols",
        long(F.size("_hashes")).alias("_n_words"),
        long(F.size("_lines")).alias("_n_lines"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("_n_dup_lines"),
        F.when(
            F.size("_hashes") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("_hashes") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("_hashes", i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    kept = [c for c in out.columns if c != "_windows"]
    # Only texts in which some window comes twice pay for finding where.
    twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    out = out.select(*kept, F.when(twice, F.array_sort(placed)).alias("_sorted"))

    def same(place: Column, window: Column) -> Column:
        return F.coalesce(F.get("_sorted", place)["h"] == window["h"], F.lit(False))

    repeated = F.filter("_sorted", lambda w, j: same(j - 1, w) | same(j + 1, w))
    starts = F.array_sort(F.transform(repeated, lambda w: w["i"]))
    # A window adds the words that the window before it doesn't cover.
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda seen, start: F.struct(
            (seen["n"] + F.least(F.lit(WINDOW), start - seen["last"])).alias("n"), start.alias("last")
        ),
        lambda seen: seen["n"],
    )
    return out.select(*kept, F.coalesce(covered, F.lit(0)).cast("bigint").alias("_n_repeat_words"))


def base_failed() -> Column:
    return (F.col("_n_words") < MIN_WORDS) | (
        100 * F.col("_n_repeat_words") > MAX_REPEATED_PERCENT * F.col("_n_words")
    )


def measures() -> dict[str, Column]:
    share = lambda part, whole: F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)
    return {
        "symbol_share": share("_n_symbols", "_word_chars"),
        "dup_line_share": share("_n_dup_lines", "_n_lines"),
        "repeat_share": share("_n_repeat_words", "_n_words"),
        "word_length": share("_word_chars", "_n_words"),
    }


def log_gamma(x: Column) -> Column:
    """For x >= 1: Stirling's series at x + 8, brought back by the recurrence."""
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * F.pow(z, 3)) + 1 / (1260 * F.pow(z, 5))
    back = F.ln(x)
    for i in range(1, 8):
        back = back + F.ln(x + i)
    return (z - 0.5) * F.ln(z) - z + 0.5 * math.log(2 * math.pi) + series - back


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's method."""

    def term(j: Column) -> Column:
        m = F.floor(j / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(j % 2 == 0, even).otherwise(odd)

    def step(state: Column, j: Column) -> Column:
        d = 1 / (1 + term(j) * state["d"])
        c = 1 + term(j) / state["c"]
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    first = 1 / (1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    return F.aggregate(F.sequence(F.lit(2), F.lit(STEPS)), start, step, lambda s: s["h"])


def binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """P(X <= k) of a binomial variable: the regularised incomplete beta at 1 - p."""
    n, k = n.cast("double"), k.cast("double")
    a, b, x = n - k, k + 1, 1 - p
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.ln(x) + b * F.ln(1 - x))
    direct = front * _beta_fraction(a, b, x) / a
    other = 1 - front * _beta_fraction(b, a, 1 - x) / b
    return F.when(k >= n, 1.0).when(x < (a + 1) / (a + b + 2), direct).otherwise(other)


def first_rejected() -> Column:
    """The first step of the path at which any rule rejects the row; null where none ever does."""
    steps = [F.when(F.col(rule) > cutoff, F.lit(nth)) for nth, (rule, cutoff) in enumerate(PATH)]
    return F.coalesce(*steps)


def cutoffs_at(nth: int) -> dict[str, float]:
    """The cutoffs in force after a step; a rule whose turn hasn't come has none."""
    return dict(PATH[: nth + 1])


def chosen_cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """stratum and the chosen cutoff (or null) of each rule; `labelled` has _stratum, _label and a
    column for each measure."""
    counts = labelled.groupBy("_stratum", first_rejected().alias("first")).agg(
        F.count_if(F.col("_label") == 1).alias("good"), F.count_if(F.col("_label") == 0).alias("bad")
    )
    # Every step in every stratum, with or without rows there.
    grid = F.array(
        *[
            F.struct(F.lit(i).alias("nth"), *[F.lit(cutoffs_at(i).get(r)).cast("double").alias(r) for r in CUTOFFS])
            for i in range(len(PATH))
        ]
    )
    strata = labelled.select("_stratum").distinct()
    tests = strata.select("_stratum", F.inline(grid)).join(counts, "_stratum", "left")
    rejected = F.coalesce(F.col("first") <= F.col("nth"), F.lit(False))
    tests = tests.groupBy("_stratum", "nth", *CUTOFFS).agg(
        F.coalesce(F.sum("good"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(rejected, F.col("good"))), F.lit(0)).alias("k"),
        F.coalesce(F.sum(F.when(rejected, F.col("bad"))), F.lit(0)).alias("caught"),
    )
    number = strata.agg(F.count(F.lit(1))).scalar()
    p = F.when(F.col("n") > 0, binomial_tail(F.col("k"), F.col("n"), F.lit(risk))).otherwise(1.0)
    looser = Window.partitionBy("_stratum").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    certified = tests.withColumn("p", F.max(p).over(looser)).filter(F.col("p") <= error / number)
    best = F.max(F.struct("caught", (-F.col("nth")).alias("loose"), *CUTOFFS)).alias("best")
    return certified.groupBy("_stratum").agg(best).select("_stratum", *[F.col(f"best.{r}").alias(r) for r in CUTOFFS])


def judged(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang",
    label: str = "quality", risk: float = RISK,
) -> DataFrame:
    """One row for each row of `docs`: _id, _content (text hash), the counts, base_failed and kept."""
    rows = docs.select(
        F.col(doc_id).alias("_id"), F.coalesce(F.col(stratum), F.lit("")).alias("_stratum"), whole_text(text).alias("_text")
    )
    counted = with_counts(rows, F.col("_text"))
    counted = counted.withColumn("_content", F.xxhash64("_text")).drop("_text")
    # Written, as the counts cost a pass over all texts and are needed twice.
    counted = written(counted.withColumns({"base_failed": base_failed(), **measures()}), "counts")
    known = labels.select(F.col(doc_id).alias("_own"), F.col(label).alias("_label")).dropna()
    known = known.groupBy("_own").agg(F.min("_label").alias("_label"))
    labelled = counted.filter(~F.col("base_failed")).join(known, F.col("_id") == F.col("_own"))
    cutoffs = chosen_cutoffs(labelled, risk)
    limits = cutoffs.select("_stratum", *[F.col(r).alias(f"_max_{r}") for r in CUTOFFS])
    # One row a stratum with labels enough: sent to all where it is small, else joined by shuffle.
    limits = written(limits, "cutoffs")
    if limits.count() <= SMALL:
        limits = F.broadcast(limits)
    passes = F.lit(True)
    for rule in CUTOFFS:
        passes = passes & F.coalesce(F.col(rule) <= F.col(f"_max_{rule}"), F.lit(True))
    return counted.join(limits, "_stratum", "left").withColumn("kept", ~F.col("base_failed") & passes)


def verdicts(docs: DataFrame, labels: DataFrame, risk: float = RISK) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the measures of every row."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged(docs, labels, risk=risk).select(
        F.col("_id").alias("doc_id"), *[F.col(f"_{n}").alias(n) for n in names], "base_failed", "kept", *CUTOFFS
    )


def kept_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that the rules keep."""
    own, hashed = unique_name(docs, "_own"), unique_name(docs, "_content")
    gone = judged(docs, labels, doc_id, text).filter(~F.col("kept"))
    gone = gone.select(F.col("_id").alias(own), F.col("_content").alias(hashed)).distinct()
    on = F.col(doc_id).eqNullSafe(F.col(own)) & (F.xxhash64(whole_text(text)) == F.col(hashed))
    return docs.join(gone, on, "left_anti")
