"""Exact-size samples that depend only on the data and the seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.columns import md5_key

TOP_K_LIMIT = 100_000
_DIGITS, _LENGTH = 4, 48


def sample_n(
    df: DataFrame, n: int, key: Sequence[str], seed: int = 42, top_k_limit: int = TOP_K_LIMIT
) -> DataFrame:
    """The n rows with the smallest digest of (key, seed); all rows when there are fewer.

    A small n is a top-k. For a large n the digest that cuts the table is located by counting
    digest prefixes, so whole prefixes are taken by a filter and only the last one is ordered.
    """
    # rows with the same key are told apart by a hash of the whole row
    row_hash = F.lpad(F.hex(F.xxhash64(*[F.col(c) for c in df.columns])), 16, "0")
    keyed = df.withColumn("_digest", F.concat(md5_key(key, seed), row_hash))
    if n <= top_k_limit:
        return keyed.orderBy("_digest").limit(n).drop("_digest")

    prefix, need = "", n
    while len(prefix) < _LENGTH:
        width = len(prefix) + _DIGITS
        inside = keyed.filter(F.col("_digest").startswith(prefix)) if prefix else keyed
        counts = sorted(
            (r["p"], r["rows"])
            for r in inside.groupBy(F.substring("_digest", 1, width).alias("p"))
            .agg(F.count("*").alias("rows"))
            .collect()  # at most 16^4 rows
        )
        cut = None
        for p, rows in counts:
            if rows >= need:
                cut = (p, rows)
                break
            need -= rows
        if cut is None:
            return df
        prefix = cut[0]
        if cut[1] <= top_k_limit:
            break

    whole = keyed.filter(F.substring("_digest", 1, len(prefix)) < prefix)
    edge = keyed.filter(F.col("_digest").startswith(prefix))
    # equal rows share the digest: count them once, then hand out as many copies as are needed
    order = Window.orderBy("_digest")
    before = F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_copies")
    partly = (
        edge.groupBy(*edge.columns)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_take", F.least(F.col("_copies"), F.lit(need) - before))
        .filter(F.col("_take") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take"))))
    )
    return whole.select(*df.columns).unionAll(partly.select(*df.columns))
