"""Exact interpolated quantiles by distributed rank selection.

Every wanted rank starts with its column's range as bracket. A pass cuts each bracket into equal
parts, counts the values by (bracket, part) with map-side counters, and follows the part that holds
the rank; that part's least and largest value are the next bracket, until they are equal. No
task sees more than its rows, and the driver at most ``CELLS`` counts a pass, whatever the table.

Parts are equal in the value on one pass and in its logarithm on the next, so neither outliers nor
values over many magnitudes keep a bracket wide. Null and NaN don't count; infinities do.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.columns import quoted

#: Counts that one pass brings to the driver, and parts of a bracket at most.
CELLS = 32_768
PARTS = 1_024


@dataclass
class _Bracket:
    """A range of one column, the number of values below it, and the ranks inside it."""

    low: float
    high: float
    below: int
    ranks: list[tuple[str, int]] = field(default_factory=list)


@dataclass
class _Range:
    count: int
    lowest: int
    highest: int
    low: float | None
    high: float | None


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, _Range]:
    """Number of values, of negative and positive infinities, and the finite range per column."""
    cells = []
    for i, c in enumerate(columns):
        x = f"nanvl(CAST({quoted(c)} AS DOUBLE), NULL)"
        finite = f"CASE WHEN abs({x}) < double('Infinity') THEN {x} END"
        cells += [
            F.expr(f"count({x}) AS n{i}"),
            F.expr(f"count_if({x} = double('-Infinity')) AS b{i}"),
            F.expr(f"count_if({x} = double('Infinity')) AS t{i}"),
            F.expr(f"min({finite}) AS l{i}"),
            F.expr(f"max({finite}) AS h{i}"),
        ]
    row = df.agg(*cells).first()
    return {
        c: _Range(*[row[f"{letter}{i}"] for letter in "nbtlh"]) for i, c in enumerate(columns)
    }


def _scaled(value: Column, logarithm: bool) -> Column:
    # halves, so that a bracket as wide as the numbers go has a finite width
    return F.signum(value) * F.log1p(F.abs(value)) if logarithm else value * 0.5


def _part(parts: int, logarithm: bool) -> Column:
    low, high = _scaled(F.col("low"), logarithm), _scaled(F.col("high"), logarithm)
    at = F.try_divide(_scaled(F.col("x"), logarithm) - low, high - low)
    part = F.floor(F.coalesce(at, F.lit(0.0)) * parts)
    return F.least(F.greatest(part, F.lit(0)), F.lit(parts - 1)).cast("int")


def _select(
    df: DataFrame, wanted: dict[str, set[int]], ranges: dict[str, _Range], slack: float = 0.0
) -> dict[tuple[str, int], float]:
    """The value at each 0-based rank; within ``slack`` of the column's count if that is given."""
    spark = df.sparkSession
    columns = sorted(wanted)
    found: dict[tuple[str, int], float] = {}
    brackets: dict[int, _Bracket] = {}
    for i, c in enumerate(columns):
        r = ranges[c]
        for rank in wanted[c]:
            if rank < r.lowest:
                found[c, rank] = -math.inf
            elif rank >= r.count - r.highest:
                found[c, rank] = math.inf
            elif r.low == r.high:
                found[c, rank] = r.low
            else:
                held = brackets.setdefault(i, _Bracket(r.low, r.high, r.lowest))
                held.ranks.append((c, rank))
    if not brackets:
        return found
    pairs = ", ".join(
        f"struct({i} AS path, CAST({quoted(columns[i])} AS DOUBLE) AS x)" for i in brackets
    )
    values = df.select(F.inline(F.expr(f"array({pairs})"))).where("abs(x) < double('Infinity')")
    start = [(i, b.low, b.high) for i, b in brackets.items()]
    # one row per column, later one per wanted rank
    values = values.join(F.broadcast(spark.createDataFrame(start, "path int, low double, high double")), "path")
    logarithm = False
    while brackets:
        parts = max(2, min(PARTS, CELLS // len(brackets)))
        state = values.withColumn("part", _part(parts, logarithm))
        cells = defaultdict(list)
        counted = state.groupBy("path", "part").agg(
            F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
        )
        for row in counted.collect():
            cells[row["path"]].append((row["part"], row["n"], row["low"], row["high"]))
        following: dict[tuple[int, int], _Bracket] = {}
        for path, bracket in brackets.items():
            ordered = sorted(cells[path])
            for c, rank in bracket.ranks:
                below = bracket.below
                for part, n, low, high in ordered:
                    if rank < below + n:
                        break
                    below += n
                if low == high or n <= slack * ranges[c].count:
                    found[c, rank] = low
                else:
                    held = following.setdefault((path, part), _Bracket(low, high, below))
                    held.ranks.append((c, rank))
        if not following:
            break
        kept = [
            (path, part, i, b.low, b.high) for i, ((path, part), b) in enumerate(following.items())
        ]
        schema = "path int, part int, next int, next_low double, next_high double"
        values = state.join(F.broadcast(spark.createDataFrame(kept, schema)), ["path", "part"]).select(
            F.col("next").alias("path"),
            "x",
            F.col("next_low").alias("low"),
            F.col("next_high").alias("high"),
        )
        brackets = dict(enumerate(following.values()))
        logarithm = not logarithm
    return found


def quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; None for a column without values."""
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    ranges = _ranges(df, columns)

    def place(c: str, p: float) -> tuple[int, int, float]:
        at = float(p) * (ranges[c].count - 1)
        return math.floor(at), math.ceil(at), at - math.floor(at)

    filled = [c for c in columns if ranges[c].count]
    wanted = {c: {r for p in probs for r in place(c, p)[:2]} for c in filled}
    found = _select(df, wanted, ranges)

    def value(c: str, p: float) -> float | None:
        if c not in wanted:
            return None
        first, second, share = place(c, p)
        a, b = found[c, first], found[c, second]
        return a if share == 0 or a == b else (1 - share) * a + share * b

    return {c: [value(c, p) for p in probs] for c in columns}


def approx_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """Elements whose rank is within 1 / ``accuracy`` of the wanted one, in fewer passes."""
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    ranges = _ranges(df, columns)

    def rank(c: str, p: float) -> int:
        return max(0, math.ceil(float(p) * ranges[c].count) - 1)

    wanted = {c: {rank(c, p) for p in probs} for c in columns if ranges[c].count}
    found = _select(df, wanted, ranges, 1 / accuracy)
    return {c: [found.get((c, rank(c, p))) for p in probs] for c in columns}


def iqr_fences(
    df: DataFrame, columns: Sequence[str], factor: float = 1.5, approx: bool = False
) -> dict[str, tuple[float, float] | None]:
    """Q1 - factor * IQR and Q3 + factor * IQR per column; None without values."""
    find = approx_quantiles if approx else quantiles
    fences = {}
    for c, (q1, q3) in find(df, columns, (0.25, 0.75)).items() if columns else ():
        fences[c] = None if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return fences
