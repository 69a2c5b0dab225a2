"""Connected components of a graph given as links, by joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesops.session import materialize


def _stars(links: DataFrame) -> DataFrame:
    """One round: every node hands its larger neighbours, then its smaller ones, to the smallest."""
    both = links.unionByName(links.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    least = least.select(F.col("high").alias("node"), F.least("high", "least").alias("least"))
    large = (
        both.where("low > high")
        .join(least, F.col("high") == F.col("node"))
        .select(F.col("low").alias("high"), F.col("least").alias("low"))
        .where("high <> low")
        .distinct()
    )
    least = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("least"))
    small = large.join(least, F.col("high") == F.col("node")).select("node", "low", "least")
    return (
        small.select(F.col("node").alias("high"), F.col("least").alias("low"))
        .unionByName(small.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low")))
        .distinct()
    )


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def contracted(links: DataFrame, rounds: int) -> DataFrame:
    """Links that connect the same nodes after some rounds; stored. Nodes lie nearer to the smallest by each."""
    links, most = links.where("high <> low").distinct(), links.count()
    for _ in range(rounds):
        most *= 2  # a round hands each link on twice at most
        links = materialize(_stars(links), most_rows=most)
    return links


def nearest_roots(links: DataFrame) -> DataFrame:
    """Per node with a smaller neighbour, ``high`` and the smallest, ``low``: of one component, if not always its root."""
    return links.groupBy("high").agg(F.min("low").alias("low"))


def components(links: DataFrame) -> DataFrame:
    """From links (``high``, ``low``; high > low): per node that has any but is not the smallest of its
    component, ``high`` (the node) and ``low`` (the smallest).

    Rounds go on until the links no longer change, some log2 of the longest path;
    each is stored, so that a lost executor costs one round.
    """
    links = materialize(links.where("high <> low").distinct(), most_rows=links.count())
    state = _state(links)
    while state[0]:
        links = materialize(_stars(links), most_rows=2 * state[0])
        before, state = state, _state(links)
        if state == before:
            break
    return links
