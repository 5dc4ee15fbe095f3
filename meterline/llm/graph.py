"""Lookups that survive hot keys, and connected components, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import SALTS, salt_of, settle


def salted_lookup(
    left: DataFrame, right: DataFrame, key: str, by: str, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """``left`` joined with ``right``, which has one row per key, however hot a key of ``left`` is.

    The rows of a key are dealt to ``salts`` parts by the column ``by``; each part that occurs gets
    a copy of the key's row, at most ``salts`` of them.
    """
    dealt = left.withColumn("_salt", salt_of(F.col(by), salts))
    parts = dealt.select(key, "_salt").distinct()  # collapses before it is shuffled
    return dealt.join(parts.join(right, key), [key, "_salt"], how).drop("_salt")


#: Rows of a key that meet those of another block of it in one task.
BLOCK = 1024


def pairs_within(rows: DataFrame, key: str, size: str, fits: Column) -> DataFrame:
    """Distinct (a, b), a < b: the nodes of all rows x and y that agree on ``key`` and meet ``fits``.

    The rows of a key are dealt to blocks of about ``BLOCK`` by their node, and each pair of blocks
    meets on its own, so no task holds a key. ``size`` is the number of the key's rows or more.
    ``fits`` is a condition on x and y, tested inside the join, so only pairs that meet it are rows.
    """
    parts = F.ceil(F.col(size) / BLOCK).cast("int")
    dealt = rows.withColumn("_parts", parts).withColumn(
        "_part", F.pmod(F.xxhash64("node", F.lit(1)), F.col("_parts")).cast("int")
    )
    x = dealt.withColumnRenamed("_part", "_i").withColumn("_j", F.explode(F.sequence("_i", F.col("_parts") - 1)))
    y = dealt.withColumnRenamed("_part", "_j").withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_j"))))
    x, y = x.alias("x"), y.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in (key, "_i", "_j")]
    # a pair of one block meets in both orders, one of two blocks in one
    once = (F.col("x._i") < F.col("x._j")) | (F.col("x.node") < F.col("y.node"))
    met = x.join(y, same[0] & same[1] & same[2] & once & (F.col("x.node") != F.col("y.node")) & fits)
    return met.select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")
    ).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b); a component is its least node.

    Each round takes the least label among the neighbours, then the label of that label, so the
    number of rounds follows the logarithm of the longest path. Labels are written each round.
    """
    pairs = edges.select("a", "b").where("a != b")
    both = settle(
        pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        f"{name}-edges",
    )
    labels = settle(
        both.groupBy("a")
        .agg(F.min("b").alias("least"))
        .select(F.col("a").alias("node"), F.least("a", "least").alias("component")),
        f"{name}-labels",
    )
    while True:
        around = salted_lookup(both, labels.withColumnRenamed("node", "b"), "b", "a")
        least = around.groupBy("a").agg(F.min("component").alias("near"))
        nearer = labels.join(least.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("jumped"))
        moved = settle(
            salted_lookup(nearer, jump, "next", "node").select(
                "node", "old", F.least("next", "jumped").alias("component")
            ),
            f"{name}-labels",
        )
        labels = moved.select("node", "component")
        if moved.where("old != component").isEmpty():
            return labels
