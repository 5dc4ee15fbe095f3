"""Near-duplicates by order MinHash, verified by a banded alignment.

A text is its sequence of five-word shingles, each with its occurrence number, so that all are
different. A sketch takes the ``KEEP`` shingles of least hash and keeps them in the order of the text;
two texts share it with a probability that follows their edit similarity, which plain MinHash
doesn't see. Texts that share a run of three of their ``SKETCHES`` sketches meet in a bucket.

A bucket compares its members with its leader, never all pairs; those unlike it are compared with the
member most like the leader too, which finds the original that all edited copies are like. In a bucket
of ``SMALL`` others or fewer, the unlike ones are compared with every other. If a larger bucket still
holds unlike ones, all its members, like or not, form new, finer buckets with more sketches in the
key and another leader (``DEPTHS``), until none is left over or the whole signature agrees, so unlike
texts that share a passage don't hide a pair. A finer bucket without unlike ones is done, and no pair
is aligned twice under one leader.

Finer buckets can part a pair. So the texts of all large buckets that held unlike ones are joined exactly
at the end: texts that can reach the threshold share one of their rarest shingles, a fifth of them
and one more (prefix filter, rarest first by the number of those texts that hold it). Pairs of different classes that do
are compared, first one pair of each text with each other class, then all that still lie apart.

The verification aligns the shingle sequences inside the diagonal band that the threshold allows. The
sequences have no repeats, so the best alignment is the longest increasing run of matched
positions. Similarity is matched / (all - matched), ``THRESHOLD`` or more is a link: never more than
the Jaccard similarity of the shingles, and equal to it unless passages changed places.

Equal texts are one node from the start. Classes are the connected components of the links.

Defined results: null texts, empty ones and those without a word are classes of their own; a text of
fewer than five words is one shingle; rows with a null id take part, and a class is named by its
least id (null if it has none); repeated rows are in the same class; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import map_batches, marks, quoted, settle, strings, with_mark
from meterline.llm.graph import components, pairs_within, salted_lookup
from meterline.llm.shingles import Hashes, mix, shingle_hashes, shingles_of, word_hashes

SKETCHES = 24
KEEP = 2
THRESHOLD = 0.8
#: Sketches in a bucket's key, round by round; the last is all of them. At similarity 0.8 a sketch agrees
#: with probability 0.64, three with 0.26, and a pair misses all 24 runs of three with about 0.001.
DEPTHS = (3, 5, 8, 13, SKETCHES)
#: Members besides the leader up to which a bucket with unlike ones compares them with all.
SMALL = 8
GOLD = np.uint64(0x9E3779B97F4A7C15)
SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * GOLD + np.uint64(3))
LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)


def occurrence_labelled(shingles: Hashes) -> np.ndarray:
    """The values, made different where one stands several times in the same text."""
    counts = np.diff(shingles.offsets)
    text = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = mix(shingles.values ^ mix((text + np.uint64(1)) * GOLD))
    ordered = np.sort(key)
    if not (ordered[1:] == ordered[:-1]).any():
        return mix(shingles.values)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    begins = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    at = np.arange(len(key))
    number = np.empty(len(key), np.uint64)
    number[order] = (at - np.maximum.accumulate(np.where(begins, at, 0))).astype(np.uint64)
    return mix(shingles.values + number * GOLD)


def sketches(shingles: Hashes) -> np.ndarray:
    """Texts x ``SKETCHES``; rows of texts without shingles mean nothing."""
    counts = np.diff(shingles.offsets)
    out = np.zeros((len(counts), SKETCHES), np.int64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    values, starts, counts = occurrence_labelled(shingles), shingles.offsets[full], counts[full]
    for j, seed in enumerate(SEEDS):
        hashed = (values ^ seed) * (seed | np.uint64(1))
        picked = []
        for _ in range(KEEP):
            least = np.repeat(np.minimum.reduceat(hashed, starts), counts)
            at = np.flatnonzero(hashed == least)
            # a text with fewer shingles than KEEP has none left: its last pick stands again
            first = at[np.searchsorted(at, starts)]
            picked.append(first)
            hashed[first] = LARGEST
        sketch = np.full(len(full), j, np.uint64)
        for place in np.sort(np.stack(picked), axis=0):
            sketch = mix(sketch * GOLD + values[place])
        out[full, j] = sketch.view(np.int64)
    return out


def longest_increasing(values: np.ndarray) -> int:
    if len(values) < 2 or (values[1:] > values[:-1]).all():
        return len(values)
    tails: list[int] = []
    for v in values.tolist():
        at = bisect_left(tails, v)
        if at == len(tails):
            tails.append(v)
        else:
            tails[at] = v
    return len(tails)


def alignment(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two sequences without repeats; 0 if it can't reach ``threshold``."""
    total = len(a) + len(b)
    band = total * (1 - threshold) / (1 + threshold) + 1e-9
    if not total or abs(len(a) - len(b)) > band:
        return 0.0
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    mine = np.flatnonzero(b[order[at]] == a)
    theirs = order[at[mine]]
    theirs = theirs[np.abs(theirs - mine) <= band]
    if total - 2 * len(theirs) > band:
        return 0.0
    matched = longest_increasing(theirs)
    return matched / (total - matched)


def sequence(text: str) -> np.ndarray:
    for words in word_hashes([text]):
        return occurrence_labelled(shingle_hashes(words))
    return np.zeros(0, np.uint64)


class _Sketch:
    def __init__(self, kept: tuple[str, ...]):
        self.kept = kept

    def __call__(self, batch: pa.RecordBatch) -> dict:
        counts, rows = [], []
        for words in word_hashes(strings(batch, "text")):
            shingles = shingle_hashes(words)
            counts.append(np.diff(shingles.offsets))
            rows.append(sketches(shingles))
        flat = np.concatenate(rows)
        ends = np.arange(len(flat) + 1, dtype=np.int32) * SKETCHES
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel()))
        return {
            **{c: batch.column(c) for c in self.kept},
            "n": pa.array(np.concatenate(counts).astype(np.int64)),
            "sketches": lists,
        }


class _Verify:
    def __init__(self, threshold: float):
        self.threshold = threshold

    def __call__(self, batch: pa.RecordBatch) -> dict:
        held: dict[int, np.ndarray] = {}
        scores = []
        leaders = batch.column("leader").to_pylist()
        for i, leader in enumerate(leaders):
            if leader not in held:
                if len(held) >= 64:
                    held.clear()
                held[leader] = sequence(strings(batch.slice(i, 1), "leader_text")[0])
            own = sequence(strings(batch.slice(i, 1), "text")[0])
            scores.append(alignment(held[leader], own, self.threshold))
        return {
            "leader": batch.column("leader"),
            "node": batch.column("node"),
            "similarity": scores,
        }


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(leader, node, similarity) of distinct pairs; ``texts`` has one (node, text) per node."""
    own = pairs.select("leader", "node").distinct().join(texts, "node")
    leaders = texts.select(F.col("node").alias("leader"), F.col("text").alias("leader_text"))
    joined = salted_lookup(own, leaders, "leader", "node")
    return map_batches(
        joined.select("leader", "node", "text", "leader_text"),
        _Verify(threshold),
        "leader long, node long, similarity double",
    )


def _good(judged: DataFrame, threshold: float) -> DataFrame:
    return judged.where(F.col("similarity") >= threshold).select(
        F.col("leader").alias("a"), F.col("node").alias("b"), "similarity"
    )


def _pairs_of_small(state: DataFrame, keys: DataFrame, like: Column) -> DataFrame:
    """(leader, node): pairs of the buckets of ``keys`` of which at least one is unlike the leader."""
    one = F.struct("node", like.alias("like"))
    listed = state.join(keys, "key").groupBy("key").agg(F.collect_list(one).alias("all"))
    first = listed.select("all", F.explode("all").alias("x"))
    both = first.select("x", F.explode("all").alias("y"))
    return both.where("x.node < y.node AND NOT (x.like AND y.like)").select(
        F.col("x.node").alias("leader"), F.col("y.node").alias("node")
    )


def _run_of_sketches(begin: int, end: int) -> list[Column]:
    """The sketches from ``begin`` to ``end`` after the place ``j``, in a ring."""
    return [F.element_at("sketches", F.pmod(F.col("j") + i, F.lit(SKETCHES)) + 1) for i in range(begin, end)]


def _stars(rows: DataFrame, order: Column) -> DataFrame:
    """(key, node, leader, j) of buckets with an ``open`` member; the leader is the first in ``order``."""
    leaders = (
        rows.groupBy("key")
        .agg(
            F.min(F.struct(order.alias("order"), "node")).alias("first"),
            F.min("node").alias("least"),
            F.max("node").alias("last"),
            F.max("open").alias("any"),
        )
        .where("least < last AND any")
        .select("key", F.col("first.node").alias("leader"))
    )
    members = salted_lookup(rows.drop("open"), leaders, "key", "node")
    return members.where("node != leader")


class _Shingles:
    def __call__(self, batch: pa.RecordBatch) -> dict:
        held = [sequence(t) for t in strings(batch, "text")]
        ends = np.cumsum([0, *map(len, held)]).astype(np.int32)
        flat = np.concatenate(held).view(np.int64)
        return {
            "node": batch.column("node"),
            "n": pa.array(np.diff(ends).astype(np.int64)),
            "shingles": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
        }


def _prefixes(texts: DataFrame, threshold: float) -> DataFrame:
    """(node, n, shingle, often, left): of each text its rarest shingles, of which alike texts share one.

    ``often`` is the number of the texts that hold the shingle; those of a single text are left out.
    ``left`` counts the text's shingles from this one on.
    """
    listed = settle(map_batches(texts, _Shingles(), "node long, n long, shingles array<long>"), "near-shingles")
    each = listed.select("node", F.explode("shingles").alias("shingle"))
    shared = settle(
        each.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "near-shared"
    )
    found = salted_lookup(each, shared, "shingle", "node")
    # sequences have no repeats; shingles that are not shared come first and need no row
    own = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("own"))
    least = F.ceil(F.col("n") * threshold - 1e-6)
    room = (F.col("n") - least + 1) - (F.col("n") - F.size("own"))
    ready = listed.select("node", "n").join(own, "node").withColumn("room", room.cast("int")).where("room > 0")
    first = ready.select(
        "node", "n", F.size("own").alias("size"), F.posexplode(F.slice("own", F.lit(1), F.col("room"))).alias("at", "s")
    )
    return first.select("node", "n", "s.shingle", "s.often", (F.col("size") - F.col("at")).alias("left"))


def _rest(texts: DataFrame, whole: DataFrame, seen: DataFrame, threshold: float) -> DataFrame:
    """(leader, node, similarity) of the texts ``whole`` (node, open): each pair with an open one that may be alike.

    Pairs of one class are not compared: their link would join nothing.
    """
    prefixes = settle(_prefixes(texts.join(whole.select("node"), "node"), threshold), "near-prefixes")
    judged = seen
    pairs = None
    for best_only in (True, False):
        groups = components(_good(judged, threshold), "near-rest")
        placed = whole.join(groups, "node", "left").select(
            "node", "open", F.coalesce("component", "node").alias("component")
        )
        if pairs is None:
            # from their first common shingle on, both must hold as many as have to match
            must = (F.col("x.n") + F.col("y.n")) * (threshold / (1 + threshold)) - 1e-6
            fits = (
                (F.col("x.component") != F.col("y.component"))
                & (F.col("x.open") | F.col("y.open"))
                & (F.least("x.left", "y.left") >= must)
            )
            rows = prefixes.join(placed, "node")
            pairs = settle(
                pairs_within(rows, "shingle", "often", fits)
                .select(F.col("a").alias("leader"), F.col("b").alias("node"))
                .join(seen, ["leader", "node"], "left_anti")
                .join(seen.select(F.col("node").alias("leader"), F.col("leader").alias("node")), ["leader", "node"], "left_anti"),
                "near-rest-pairs",
            )
            if pairs.isEmpty():
                break
        named = salted_lookup(pairs, placed.select("node", F.col("component").alias("mine")), "node", "leader")
        other = placed.select(F.col("node").alias("leader"), F.col("component").alias("theirs"))
        apart = salted_lookup(named, other, "leader", "node").where("mine != theirs")
        if best_only:
            apart = apart.groupBy("node", "theirs").agg(F.min("leader").alias("leader"))
        new = apart.select("leader", "node").join(judged, ["leader", "node"], "left_anti")
        judged = judged.unionByName(settle(verify(new, texts, threshold), "near-judged"))
    return judged


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of ``nodes``; a bitmap lets all other texts pass by before any is shuffled."""
    here = with_mark(docs.select("node", "text"), marks(nodes, "node"), "node").where("_marked")
    # copies collapse in the task that read them, so a hot text isn't shuffled as such
    return here.groupBy("node").agg(F.first("text").alias("text")).join(nodes, "node")


def links(docs: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified (a, b, similarity). ``nodes``: (node, sketches), ``docs``: (node, text)."""
    spark = docs.sparkSession
    places = F.posexplode("sketches").alias("j", "sketch")
    rows = nodes.select("node", "sketches", places).select(
        F.xxhash64("j", *_run_of_sketches(0, DEPTHS[0])).alias("key"), "node", "j", F.lit(True).alias("open")
    )
    like = F.col("similarity") >= threshold
    texts = seen = unsettled = None
    for depth, following in zip(DEPTHS, (*DEPTHS[1:], None), strict=True):
        # another order of the nodes each round, so that finer buckets get new leaders
        members = settle(_stars(rows, F.xxhash64("node", F.lit(depth))), "near-members")
        if members.isEmpty():
            break
        pairs = members.select("leader", "node").distinct()
        if texts is None:
            met = members.select("node").union(members.select("leader")).distinct()
            texts = settle(_texts_of(docs, met), "near-texts")
            seen = settle(verify(pairs, texts, threshold), "near-judged")
        else:
            new = pairs.join(seen, ["leader", "node"], "left_anti")
            seen = seen.unionByName(settle(verify(new, texts, threshold), "near-judged"))
        state = settle(members.join(seen, ["leader", "node"]), "near-state")
        still_open = settle(
            state.groupBy("key", "leader", "j")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("similarity").alias("worst"),
                F.max(F.when(like, F.struct("similarity", "node"))).alias("nearest"),
            )
            .where(F.col("worst") < threshold)
            .select("key", "leader", "j", "n", F.col("nearest.node").alias("nearest")),
            "near-open",
        )
        if still_open.isEmpty():
            break
        small = _pairs_of_small(state, still_open.where(F.col("n") <= SMALL).select("key"), like)
        large = still_open.where(F.col("n") > SMALL)
        apart = salted_lookup(
            state.where(~like).select("key", "node"), large.select("key", "nearest"), "key", "node"
        )
        second = apart.where("nearest IS NOT NULL").select(F.col("nearest").alias("leader"), "node")
        new = small.unionByName(second).distinct().join(seen, ["leader", "node"], "left_anti")
        seen = seen.unionByName(settle(verify(new, texts, threshold), "near-judged"))
        if following is None:
            break
        # a bucket with members unlike both goes on whole, and also shares the next sketches
        joined = seen.where(like).select(F.col("leader").alias("nearest"), "node")
        left = settle(
            apart.join(joined, ["nearest", "node"], "left_anti").select("key", "node"), "near-left"
        )
        if left.isEmpty():
            break
        live = large.join(left.select("key").distinct(), "key", "left_semi")
        whole = salted_lookup(state.select("key", "node", "j"), live.select("key"), "key", "node")
        whole = whole.unionByName(live.select("key", F.col("leader").alias("node"), "j"))
        if unsettled is None:  # the buckets of later rounds are parts of these
            marked = left.groupBy("node").agg(F.lit(True).alias("unlike"))
            unsettled = whole.select("node").distinct().join(marked, "node", "left")
            unsettled = settle(
                unsettled.select("node", F.coalesce("unlike", F.lit(False)).alias("open")), "near-unsettled"
            )
        flagged = whole.join(left.withColumn("unlike", F.lit(True)), ["key", "node"], "left")
        rows = flagged.join(nodes, "node").select(
            F.xxhash64("key", *_run_of_sketches(depth, following)).alias("key"),
            "node",
            "j",
            F.coalesce("unlike", F.lit(False)).alias("open"),
        )
    if seen is None:
        return spark.createDataFrame([], "a long, b long, similarity double")
    if unsettled is not None:
        seen = _rest(texts, unsettled, seen, threshold)
    return _good(seen, threshold)


def classes(
    docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id"
) -> DataFrame:
    """(id, node, class_id, class_size) of every row; rows without words have a null node.

    ``node`` is the 64-bit hash of the text, equal for equal texts.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_column).alias("id"), text.alias("text")).select(
        "id", F.xxhash64("text").alias("node"), "text"
    )
    kind = dict(docs.dtypes)[id_column]
    signed = settle(
        map_batches(
            keyed, _Sketch(("id", "node")), f"id {kind}, node long, n long, sketches array<long>"
        ),
        "near-sketches",
    )
    worded = signed.where("n > 0")
    nodes = settle(
        worded.groupBy("node").agg(
            F.first("sketches").alias("sketches"), F.min("id").alias("least"), F.count("*").alias("rows")
        ),
        "near-nodes",
    )
    linked = links(keyed.select("node", "text"), nodes.select("node", "sketches"), threshold)
    groups = components(linked, "near")
    placed = (
        nodes.select("node", "least", "rows")
        .join(groups, "node", "left")
        .select("node", "least", "rows", F.coalesce("component", "node").alias("component"))
    )
    named = placed.groupBy("component").agg(
        F.min("least").alias("class_id"), F.sum("rows").alias("class_size")
    )
    by_node = salted_lookup(placed.select("node", "component"), named, "component", "node")
    together = salted_lookup(worded.select("id", "node"), by_node, "node", "id")
    alone = signed.where("n = 0").select(
        "id",
        "node",
        F.lit(None).cast("long").alias("component"),
        F.col("id").alias("class_id"),
        F.lit(1).cast("long").alias("class_size"),
    )
    columns = ("id", "node", "component", "class_id", "class_size")
    return together.select(*columns).unionByName(alone).withColumnRenamed("id", id_column)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row of the least id.

    Rows that agree on id and text are copies, of which one stays; among texts of one id, and in a
    class without ids, the text of least hash stays. Rows without words all stay.
    """
    found = settle(classes(docs, threshold), "near-classes")
    worded = found.where("component IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "node")
    chosen = worded.groupBy("component").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("_id"), F.col("first.node").alias("_node")
    )
    copies = settle(
        worded.groupBy(F.col("doc_id").alias("_id2"), F.col("node").alias("_node2"))
        .count()
        .where("count > 1"),
        "near-copies",
    )
    same = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_node") == F.col("_node2"))
    staying = chosen.join(copies, same, "left").select(
        "_id", "_node", F.col("count").isNotNull().alias("_copied")
    )
    wordless = found.where("component IS NULL").select(
        F.col("doc_id").alias("_id"), F.col("node").alias("_node"), F.lit(False).alias("_copied")
    )
    staying = staying.unionByName(wordless.distinct())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # columns of any name: the work is done under names of its own
    plain = [f"_p{i}" for i in range(len(docs.columns))]
    rows = docs.select(
        *[c.alias(p) for c, p in zip(quoted(docs.columns), plain, strict=True)],
        F.col("doc_id").alias("_id3"),
        F.xxhash64(text).alias("_node3"),
    )
    here = F.col("_id3").eqNullSafe(F.col("_id")) & (F.col("_node3") == F.col("_node"))
    kept = rows.join(staying, here)
    once = kept.where(~F.col("_copied")).select(*plain)
    if not copies.isEmpty():
        twice = kept.where("_copied").dropDuplicates(["_id3", "_node3"]).select(*plain)
        once = once.unionByName(twice)
    return once.toDF(*docs.columns)
