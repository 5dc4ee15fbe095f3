"""Benchmark items inside documents: size-partitioned MinHash containment search.

A short item and a long document have a tiny Jaccard similarity however completely the one lies in
the other, so both sides are cut to comparable size. Items are partitioned by their number of
word shingles, class k holding 2^k .. 2^(k+1)-1; for class k every document is seen as windows of
2^(k+2) shingles, each starting 2^(k+1) after the one before. Wherever an item stands, one window holds
it whole, at a Jaccard similarity of a quarter at least, and one of ``HASHES`` equal minima makes
(window, item) a candidate. For items that stand with the share ``THRESHOLD`` only, the similarity is
0.19 at least, and a candidate is missed with probability 0.81 ** 32, about one in a thousand (one in
ten thousand for whole items). Candidates are verified by exact containment: the share of the item's distinct shingles that
the document has.

The benchmark is a stated query set. It is taken in blocks of bounded size (``BLOCK_SHINGLES``), each
held by all tasks while the documents pass once; documents are never shuffled or paired.

Defined results: texts of fewer than five words are one shingle of all their words; an item without
words matches nothing; null texts count as empty; items with equal texts match alike, each under its
own id; repeated documents are searched one by one; extra columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import filter_batches, map_batches, strings
from meterline.llm.shingles import Hashes, mix, shingle_hashes, shingles_of, word_hashes

HASHES = 32
THRESHOLD = 0.8

#: Distinct shingles of items that one pass holds (16 bytes each, and 1 KB per item).
BLOCK_SHINGLES = 500_000

SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _scrambled(x: np.ndarray, seed: np.uint64) -> np.ndarray:
    """A cheap permutation per seed: shingle hashes are well mixed already."""
    return (x ^ seed) * (seed | np.uint64(1))


@dataclass
class Block:
    """Items that one pass searches for."""

    ids: list
    sets: list[np.ndarray]
    #: by size class: (sorted minima, item numbers), one pair per hash function
    classes: dict[int, list[tuple[np.ndarray, np.ndarray]]]


def make_block(ids: list, texts: list[str]) -> Block:
    sets = [np.unique(shingles_of(t)) for t in texts]
    members: dict[int, list[int]] = defaultdict(list)
    for k, s in enumerate(sets):
        if len(s):
            members[len(s).bit_length() - 1].append(k)
    classes = {}
    for size, numbers in members.items():
        pairs = []
        for seed in SEEDS:
            minima = np.array([_scrambled(sets[k], seed).min() for k in numbers], np.uint64)
            order = np.argsort(minima, kind="stable")
            pairs.append((minima[order], np.array(numbers)[order]))
        classes[size] = pairs
    return Block(ids, sets, classes)


def candidates(shingles: Hashes, block: Block) -> set[tuple[int, int]]:
    """(text, item) where the item shares a minimum with a window of its size class."""
    values, offsets = shingles.values, shingles.offsets
    counts = np.diff(offsets)
    if not len(values):
        return set()
    grids = {}
    for size in block.classes:
        stride = 2 << size
        parts = -(-counts // stride)  # none for an empty text
        text = np.repeat(np.arange(len(counts)), parts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        grids[size] = offsets[text] + within * stride, text, text[1:] == text[:-1]
    found: set[tuple[int, int]] = set()
    for k, seed in enumerate(SEEDS):
        permuted = _scrambled(values, seed)
        for size, pairs in block.classes.items():
            minima, numbers = pairs[k]
            starts, text, joined = grids[size]
            low = np.minimum.reduceat(permuted, starts)
            # a window is two parts of the grid, so only its smaller minimum counts
            low[:-1][joined] = np.minimum(low[:-1], low[1:])[joined]
            left = np.searchsorted(minima, low, "left")
            hits = np.flatnonzero(minima[np.minimum(left, len(minima) - 1)] == low)
            for at in hits:
                end = np.searchsorted(minima, low[at], "right")
                found.update((int(text[at]), int(i)) for i in numbers[left[at] : end])
    return found


class _Search:
    def __init__(self, broadcast, threshold: float, id_column: str):
        self.broadcast, self.threshold, self.id_column = broadcast, threshold, id_column

    def __call__(self, batch: pa.RecordBatch) -> dict:
        block = self.broadcast.value
        rows, items, shares, sizes = [], [], [], []
        for chunk in word_hashes(strings(batch, "text")):
            shingles = shingle_hashes(chunk)
            last, own = -1, None
            for k, item in sorted(candidates(shingles, block)):
                if k != last:
                    last, own = k, np.unique(shingles.of(k))
                want = block.sets[item]
                at = np.minimum(np.searchsorted(own, want), len(own) - 1)
                hit = int(np.count_nonzero(own[at] == want))
                if hit >= self.threshold * len(want):
                    rows.append(chunk.first + k)
                    items.append(block.ids[item])
                    shares.append(hit / len(want))
                    sizes.append(len(want))
        ids = batch.column(self.id_column).take(pa.array(rows, pa.int64()))
        return {self.id_column: ids, "item_id": items, "containment": shares, "n_shingles": sizes}


def blocks(items: DataFrame, limit: int = BLOCK_SHINGLES):
    """The items in blocks of about ``limit`` words, each collected on its own."""
    items = items.select("item_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).head()[0] or 0
    parts = 1 + total // (4 * limit)  # four characters a word at the least guess
    for part in range(parts):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        rows = block.collect()  # bounded by the block size
        if rows:
            yield make_block([r["item_id"] for r in rows], [r["text"] for r in rows])


def find_items(
    spark: SparkSession,
    docs: DataFrame,
    items: DataFrame,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
) -> DataFrame:
    """One row per (document, item) with containment of ``threshold`` or more."""
    kind, item_kind = dict(docs.dtypes)[id_column], dict(items.dtypes)["item_id"]
    schema = f"{id_column} {kind}, item_id {item_kind}, containment double, n_shingles int"
    narrow = docs.select(id_column, F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], schema)
    for block in blocks(items):
        held = spark.sparkContext.broadcast(block)
        found = found.unionByName(
            map_batches(narrow, _Search(held, threshold, id_column), schema)
        )
    return found


class _Clean:
    """Which rows of a batch hold no item of the block."""

    def __init__(self, search: _Search):
        self.search = search

    def __call__(self, batch: pa.RecordBatch) -> list[bool]:
        rows = pa.array(range(batch.num_rows), pa.int64())
        numbered = pa.RecordBatch.from_arrays([rows, batch.column("text")], ["row", "text"])
        hit = set(self.search(numbered)["row"].to_pylist())
        return [i not in hit for i in range(batch.num_rows)]


def remove_contaminated(
    spark: SparkSession, docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns unchanged, no join."""
    for block in blocks(items):
        held = spark.sparkContext.broadcast(block)
        docs = filter_batches(docs, _Clean(_Search(held, threshold, "row")))
    return docs
