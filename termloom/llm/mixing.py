"""Mixing sources to target weights by thresholds on a hash of each document.

Every document has a place in [0, 2**48) that its hash fixes. A source takes whole passes
over its documents, and of one more pass those before a threshold. The threshold comes
from histograms: sizes are summed by source and the first bits of the place, the cell in
which the budget ends is found from running sums, and only that cell is cut again by the
next bits, until places themselves are told apart. Documents are filtered, never sorted,
and a larger budget takes all that a smaller one took.

Tables of one row per source, or per source and cell, are all that passes through single
tasks; documents are summed before they are shuffled, so a hot source does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.words import WORD_PATTERN
from termloom.session import staged

PLACE_BITS = 48
LEVEL_BITS = 12
WEIGHTS = (5, 2, 1)
CAP = 3


def word_count(text: str = "text") -> Column:
    """The size of a document; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def place(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Of id and text, so that rows without an id still differ. Equal rows share a place."""
    of = F.concat(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.md5(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))
    )
    return F.conv(F.substring(F.md5(of), 1, PLACE_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Sources by code point, null last, take the weights in turn. They share the sum of all
    sizes; where a share is above ``cap`` times the source, the rest goes to the others by
    weight. All shares are then ``least(cap * size, level * weight)`` for one level, which
    is read off the sources in the order in which they reach their cap.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    most = cap * F.col("source_size").cast("double")
    table = sizes.withColumn("weight", weight).withColumn("most", most)
    full = F.col("most") / F.col("weight")
    by_cap = Window.orderBy(full, F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("most").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(every)
    table = table.withColumn("level", (total - before) / left).withColumn("number", F.row_number().over(by_cap))
    reached = F.when(F.col("level") <= full, F.struct("number", "level"))
    level = F.min(reached).over(every)["level"]
    return table.select(
        "source", "source_size", F.coalesce(F.least("most", level * F.col("weight")), "most").alias("target")
    )


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source of ``(source, size, place)``: target, whole passes and threshold.

    A document is in the last, partial pass when its place is under ``threshold``. The
    document in which the budget ends is taken when that brings the sum nearer to the
    target. An empty table has an empty plan; sources without words take nothing.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = staged(
        targets(sizes, weights, cap)
        .withColumn("passes", passes.cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")),
        "mix-goals",
    )
    # Of each source the cell in which the rest ends, and the sum before it.
    edge = goals.select("source", "rest", F.lit(0).cast("long").alias("cell"), F.lit(0).cast("long").alias("before"))
    for shift in range(PLACE_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        outer, inner = F.shiftright("place", shift + LEVEL_BITS), F.shiftright("place", shift)
        e = edge.select(F.col("source").alias("e_source"), "rest", F.col("cell").alias("e_cell"), "before")
        within = docs.join(e, docs["source"].eqNullSafe(e["e_source"]) & (outer == e["e_cell"]))
        cells = within.groupBy("source", inner.alias("cell")).agg(
            F.sum("size").alias("cell_size"), F.first("rest").alias("rest"), F.first("before").alias("before")
        )
        running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("before", F.col("before") + F.coalesce(F.sum("cell_size").over(running), F.lit(0)))
        ends = (F.col("before") < F.col("rest")) & (F.col("rest") <= F.col("before") + F.col("cell_size"))
        edge = staged(cells.filter(ends).select("source", "rest", "cell", "before", "cell_size"), "mix-edge")
    over = F.col("before") + F.col("cell_size") - F.col("rest")
    threshold = F.col("cell") + (over < F.col("rest") - F.col("before")).cast("long")
    e = edge.select(F.col("source").alias("e_source"), threshold.alias("threshold"))
    plan = goals.join(e, goals["source"].eqNullSafe(e["e_source"]), "left")
    plan = plan.select("source", "source_size", "target", "passes", F.coalesce("threshold", F.lit(0)).alias("threshold"))
    # As a table its size is known: Spark sends a small one to all tasks, so that no text is shuffled for it.
    return staged(plan, "mix-plan")


def mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` and ``copies``, how often the mix takes the row.

    ``docs`` has ``source`` and ``place``; columns named as those of the result are replaced.
    """
    added = ("source_size", "target", "copies")
    docs = docs.drop(*added)
    p = plan.select(*[F.col(c).alias(f"__{c}") for c in ("source", "source_size", "target", "passes", "threshold")])
    joined = docs.join(p, docs["source"].eqNullSafe(p["__source"]))
    copies = F.col("__passes") + (F.col("place") < F.col("__threshold")).cast("long")
    return joined.select(
        *[f"`{c}`" for c in docs.columns],
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        copies.alias("copies"),
    )
