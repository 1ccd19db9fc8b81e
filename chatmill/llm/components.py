"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmill.operators.staging import stage

# Rounds after which the job fails rather than return components that are not whole.
MOST_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): for every id that has a link, the smallest id reachable from it.

    Each round hangs every id's larger neighbours on its smallest neighbour, then its smaller ones; the table of links never
    grows, paths halve, and the end is one star for each component. A table per round is written to the shared folder, so
    a lost executor costs one round. An id with many links is one row after the partial aggregation, and its links are
    read by a join whose sides Spark can split. Links with a null end or from an id to itself are no links.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    stars = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    last = None
    for _ in range(MOST_ROUNDS):
        state = stars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == last or state["n"] == 0:
            return stars.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(stars.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        last = state
        # Larger neighbours (a > b in every row, so those of b) go to the smallest neighbour of b, b itself included.
        low = stars.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("least"))
        large = stars.join(low, "b", "left").select("a", F.coalesce("least", "b").alias("b")).distinct()
        # Smaller neighbours of a, and a, go to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("l")).select("l.*")
        stars = stage(small.filter("a <> b").distinct(), "links")
    raise RuntimeError(f"components are not whole after {MOST_ROUNDS} rounds")
