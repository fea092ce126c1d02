"""Mixing sources to target weights.

Sources get a budget of words each. A source's documents are put in a random
order that depends on their ids alone, and are taken in that order, over and
over, until the budget is used up: whole epochs first, then a prefix whose end
is found with prefix sums.

The order of a source is cut into 4,096 cells by the first digits of the random
key. Sums per cell and their running totals give every cell the words that stand
before it; a window then runs inside each cell only, so a source with most of
the rows is spread over thousands of groups.

Rows with a NULL source form a source of their own, last in order. A NULL text
has size 0. Rows with equal id and size are interchangeable: how many copies
each gets may differ, as a set they don't. Documents of size 0 are taken once
per begun epoch. An empty table mixes to an empty table. The columns of
the input are kept; the added ones are prefixed with ``mix_``.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored, word_count

#: Hex digits of the key that name a cell.
CELL_DIGITS = 3
BIG = "decimal(38,0)"


def random_key(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _ranked(sources: DataFrame) -> DataFrame:
    """Position of each source by code point, NULL last, without a single-task sort."""
    order = F.col("source").asc_nulls_last()
    spread = stored(sources.orderBy(order).withColumn("part", F.spark_partition_id()))
    sizes = spread.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part")) - F.col("n")  # one row per partition
    offsets = sizes.select("part", before.alias("offset"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return spread.withColumn("within", within).join(offsets, "part").select(
        "source", "source_key", "source_size", (F.col("offset") + F.col("within")).alias("rank")
    )


def _water_level(sources: DataFrame, total: int, share: Fraction) -> Fraction:
    """Words per unit of weight, at which the capped targets add up to the budget.

    Each round fixes the sources above their cap and shares the rest again. One
    row comes to the driver per round.
    """
    level = Fraction(0)
    budget = share * total
    while True:
        over = F.lit(level.numerator).cast(BIG) * F.col("weight") > (
            F.col("cap").cast(BIG) * F.lit(level.denominator).cast(BIG)
        )
        row = sources.agg(
            F.sum(F.when(over, F.col("cap")).otherwise(0).cast(BIG)).alias("capped"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            return level
        found = (budget - int(row["capped"])) / row["weight"]
        if found <= level:
            return level
        level = found


def targets(
    cells: DataFrame, weights: tuple[int, ...], share: Fraction, most_epochs: int
) -> DataFrame:
    """source_key, source_size, target, whole epochs and the rest of each source."""
    sources = cells.groupBy("source", "source_key").agg(
        F.sum("cell_size").alias("source_size")
    )
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = stored(
        _ranked(sources)
        .withColumn("weight", cycle[(F.col("rank") % len(weights)).cast("int")])
        .withColumn("cap", F.col("source_size") * most_epochs)
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = _water_level(ranked, total, share)
    num, den = F.lit(level.numerator).cast(BIG), F.lit(level.denominator).cast(BIG)
    wanted = num * F.col("weight")
    capped = wanted >= F.col("cap").cast(BIG) * den
    per_unit = F.lit(float(level.numerator)) / F.lit(float(level.denominator))
    target = F.when(capped, F.col("cap").cast("double")).otherwise(per_unit * F.col("weight"))
    epochs = F.when(capped, F.lit(most_epochs))
    for n in range(most_epochs - 1, 0, -1):
        epochs = epochs.when(wanted >= F.col("source_size").cast(BIG) * n * den, F.lit(n))
    return ranked.withColumns(
        {"target": target, "epochs": epochs.otherwise(F.lit(0))}
    ).select(
        "source_key", "source_size", "target", "epochs",
        F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0)).alias(
            "rest"
        ),
    )


def _placed(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: Fraction = Fraction(3, 2),
    most_epochs: int = 2,
    seed: str = "mix",
    keep: list[str] | None = None,
) -> DataFrame:
    """``row``, a struct of the input's columns, with mix_size, mix_source_size, mix_target and mix_copies."""
    carried = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        "source",
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), "source")).alias(
            "source_key"
        ),
        word_count(F.col("text")).alias("size"),
        random_key(F.col("doc_id"), seed).alias("key"),
    ).withColumn("cell", F.substring("key", 1, CELL_DIGITS))
    rows = stored(rows)
    cells = rows.groupBy("source", "source_key", "cell").agg(F.sum("size").alias("cell_size"))
    cells = stored(cells)
    in_order = Window.partitionBy("source_key").orderBy("cell")
    plan = cells.withColumn(
        "cell_before", F.sum("cell_size").over(in_order) - F.col("cell_size")
    ).join(targets(cells, weights, share, most_epochs), "source_key")
    plan = plan.select(
        "source_key", "cell", "cell_before", "source_size", "target", "epochs", "rest"
    )
    in_cell = (
        Window.partitionBy("source_key", "cell")
        .orderBy("key", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = rows.join(plan, ["source_key", "cell"]).withColumn(
        "before", F.col("cell_before") + F.sum("size").over(in_cell) - F.col("size")
    )
    # The document at the cut is taken if that brings the sum nearer to the budget.
    nearer = (F.col("rest") > 0) & (2 * F.col("before") + F.col("size") <= 2 * F.col("rest"))
    return placed.select(
        "row",
        F.col("size").alias("mix_size"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
        (F.col("epochs") + nearer.cast("int")).alias("mix_copies"),
    )


def mix(docs: DataFrame, keep: list[str] | None = None, **options) -> DataFrame:
    """Every row of ``docs`` (doc_id, source, text) with its part in the mix.

    Adds mix_size, mix_source_size, mix_target and mix_copies (how often the
    document is taken). ``keep`` names the input columns to carry on, all by
    default; fewer columns make the shuffle smaller. ``options`` are weights, share, most_epochs and seed.
    """
    placed = _placed(docs, keep=keep, **options)
    return placed.select("row.*", *placed.columns[1:])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns of any names."""
    taken = _placed(docs, **options).where("mix_copies > 0")
    copies = F.explode(F.sequence(F.lit(1), F.col("mix_copies"))).alias("copy")
    return taken.select("row", copies).select("row.*")
