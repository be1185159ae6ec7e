"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact cuts.

Each source gets a share of all words by its weight, but no more than three times its own; what lies above
is shared anew by weight until nothing is. Within a source, rows are ordered by a hash of id and text. The
mix takes a source whole as often as its budget (the target, rounded) allows, and then its first rows until
the budget is met: the row at the cut gives only the words that are still wanted, so budgets are met exactly.

Rows are range-sorted by source and hash, so a source may lie in any number of tasks. Prefix sums come from
each partition's total and a running sum inside the partition. The same is done to the sources, which
therefore may be as many as one likes.

Null texts, empty ones and those of white space only have no words and give none; a null source is a source
of its own, the last. Rows without an id are ordered by their text. Repeated rows are rows of their own and
alike: which of them is cut makes no difference to the result. Reruns agree. Very long texts are rows like
others; only their numbers are shuffled. Other columns, whatever their names, are left aside. Without rows
the result is empty; without any words all targets are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import SPACES, unique_name, whole_text, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20_261_130


def with_sums_before(rows: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """`rows` with, for each (new column: whole-number column) of `sums`, the sum over all rows before.

    Rows that `order` doesn't tell apart must be alike.
    """
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(*order, "_salt").sortWithinPartitions(*order, "_salt").drop("_salt")
    # The number keeps partition (upper bits) and place in it. Written, so that it stays.
    ranged = written(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_part").agg(*[F.sum(v).alias(f"_all_{n}") for n, v in sums.items()])
    # One row a partition, so this window is as small as the list of partitions.
    starts = totals.select("_part", *[F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_from_{n}") for n in sums])
    above = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({f"_in_{n}": F.coalesce(F.sum(v).over(above), F.lit(0)) for n, v in sums.items()})
    return inside.join(starts, "_part").select(
        *rows.columns, *[(F.col(f"_from_{n}") + F.col(f"_in_{n}")).alias(n) for n in sums]
    )


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`sizes` (source, source_size; one row a source) with `before` (all words of the sources ahead)
    and `target`. Sources take the weights in turn, ordered by code point, null last."""
    one = sizes.withColumn("one", F.lit(1).cast("bigint"))
    ranked = with_sums_before(one, [F.col("source").asc_nulls_last()], {"rank": "one", "before": "source_size"})
    turn = F.array(*[F.lit(w).cast("bigint") for w in weights])
    ranked = ranked.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * most)
    # Whoever reaches the cap first comes first: the level (words a unit of weight) that fills a source.
    full = F.col("cap").cast("decimal(38,12)") / F.col("weight")
    filled = with_sums_before(
        ranked.withColumn("full", full), [F.col("full"), F.col("source").asc_nulls_last()],
        {"caps": "cap", "weights": "weight"},
    )
    whole = filled.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("all_weights"))
    # If all sources before this one are full, the rest is shared at this level.
    level = (F.col("words") - F.col("caps")) / (F.col("all_weights") - F.col("weights"))
    levels = filled.crossJoin(F.broadcast(whole)).withColumn("level", level)
    # The first source that isn't full at its level sets it. One number.
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    final = F.broadcast(levels.agg(F.min_by("level", F.when(fits, F.col("caps"))).alias("final")))
    target = F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight"))
    return filled.crossJoin(final).select("source", "source_size", "before", target.alias("target"))


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """doc_id, source, content (a hash of id and text), size, source_size, target and taken of each row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("content"),
        F.regexp_count(whole_text(text), F.lit(WORD)).cast("bigint").alias("size"),
    )
    order = [F.col("source").asc_nulls_last(), F.col("content"), F.col("doc_id"), F.col("size")]
    placed = with_sums_before(rows, order, {"ahead": "size"})
    sizes = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "of")
    found = placed.join(targets, F.col("source").eqNullSafe(F.col("of")))
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    once = F.greatest(F.col("source_size"), F.lit(1))
    epochs = F.floor(budget / once).cast("bigint")
    rest = budget - epochs * once
    cut = F.greatest(F.least(rest - (F.col("ahead") - F.col("before")), F.col("size")), F.lit(0))
    taken = (epochs * F.col("size") + cut).cast("bigint")
    return found.select("doc_id", "source", "content", "size", "source_size", "target", taken.alias("taken"))


def mixture(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, **how) -> DataFrame:
    """The mix itself: `docs` with each row as often as it is taken. A row at a cut comes with its first
    words only, joined by single spaces; of rows that are alike the mix takes the sum."""
    own, words, times, rest, copy = (unique_name(docs, n) for n in ("_content", "_words", "_times", "_rest", "_copy"))
    decided = mixed(docs, doc_id=doc_id, text=text, seed=seed, **how)
    decided = decided.groupBy("content", "source").agg(F.first("size").alias("size"), F.sum("taken").alias("taken"))
    decided = decided.filter("taken > 0").select(
        F.col("content").alias(own),
        F.col("source").alias(words),
        F.expr("cast(taken div size as int)").alias(times),
        F.expr("cast(taken % size as int)").alias(rest),
    )
    content = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    source = how.get("source", "source")
    alike = docs.withColumn(copy, content).dropDuplicates([copy, source])
    chosen = alike.join(decided, (F.col(copy) == F.col(own)) & F.col(source).eqNullSafe(F.col(words)))
    first_words = F.array_join(F.slice(F.split(F.regexp_replace(F.col(text), f"^{SPACES}", ""), SPACES), 1, F.col(rest)), " ")
    copies = F.concat(
        F.array_repeat(F.col(text), F.col(times)),
        F.when(F.col(rest) > 0, F.array(first_words)).otherwise(F.array().cast("array<string>")),
    )
    others = [c for c in docs.columns if c != text]
    out = chosen.select(*others, F.explode(copies).alias(text))
    return out.select(*docs.columns)
