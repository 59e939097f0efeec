"""Extension: titles that stand for other titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions import pages
from termloom.session import Staging, staged


def read_redirects(raw_pages: DataFrame) -> DataFrame:
    """``(title, target)`` of pages with a redirect element, both in lower case."""
    page = F.col("page")
    target = pages.redirect_target(page)
    return raw_pages.filter(target != "").select(F.lower(pages.page_title(page)).alias("title"), F.lower(target).alias("target"))


def resolve_redirects(links: DataFrame) -> DataFrame:
    """``(title, target, steps)``: where each title leads in the end, and over how many links.

    Every pointer takes on the target of its target in each round, so that chains halve and
    log n rounds do. What still moves after as many links as there are titles is in a cycle
    or leads into one; such titles have a null target and null steps. Of several links of a
    title the least target counts; rows without a title or a target are none. Each round is
    written to the shared folder.
    """
    staging = Staging(links.sparkSession)
    known = links.filter("title IS NOT NULL AND target IS NOT NULL").groupBy("title").agg(F.min("target").alias("target"))
    known = staged(known, "links")
    total = known.count()
    onward = known.select(F.col("title").alias("target"), F.lit(False).alias("arrived"))
    state = known.join(onward, "target", "left").select(
        "title", "target", F.lit(1).cast("bigint").alias("steps"), F.col("arrived").isNull().alias("arrived")
    )
    state = staging.keep("round-0", state)
    number = 0
    while 1 << number <= total and not state.filter("NOT arrived").isEmpty():
        nexts = state.select(
            F.col("title").alias("target"), F.col("target").alias("next"), F.col("steps").alias("more"), F.col("arrived").alias("ends")
        )
        moved = state.filter("NOT arrived").join(nexts, "target").select(
            "title", F.col("next").alias("target"), (F.col("steps") + F.col("more")).alias("steps"), F.col("ends").alias("arrived")
        )
        number += 1
        state = staging.keep(f"round-{number}", state.filter("arrived").unionByName(moved))
        staging.drop(f"round-{number - 1}")
    return state.select("title", *[F.when(F.col("arrived"), F.col(c)).alias(c) for c in ("target", "steps")])


def follow_titles(rows: DataFrame, resolved: DataFrame, title: str = "title") -> DataFrame:
    """``rows`` with ``resolved_title``: what a title leads to, or itself. A title in a cycle has none."""
    leads = resolved.select(F.col("title").alias(title), "target", F.lit(True).alias("_leads"))
    joined = rows.join(leads, title, "left")
    led = F.when(F.col("_leads"), F.col("target")).otherwise(F.col(title))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], led.alias("resolved_title"))
