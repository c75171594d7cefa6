"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadevents.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """cls and comp, the smallest class it is connected to, for every class in a link.

    Links (a, b) are rewritten until all point to the smallest class of their component:
    in turn each class tells its larger neighbours, then its smaller ones, of the smallest
    it knows. The number of rounds grows with the logarithm of the longest chain. A class
    with very many links is split over tasks, as only minima are grouped.
    """
    now = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, before, number = scratch.write(now.where("u != v").distinct(), f"{name}-0"), None, 0
    while True:
        state = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            return now.select(F.col("u").alias("cls"), F.col("v").alias("comp")).unionByName(
                now.select(F.col("v").alias("cls"), F.col("v").alias("comp")).distinct()
            )
        before, number = state, number + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.write(large.where("u != v").distinct(), f"{name}-{number}-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = scratch.write(small, f"{name}-{number}")
        scratch.drop(f"{name}-{number - 1}", f"{name}-{number}-large")
