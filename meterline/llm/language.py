"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text's subwords are its runs of one to four characters inside and at the edges of words, hashed into
``BUCKETS``; its vector is the mean of their embeddings. Embeddings and softmax are trained together
by stochastic gradient descent on a bounded sample of labelled rows (``SAMPLE`` documents over all
languages, taken by a hash of the id), each as a whole and as one short span, so short texts are
learnt too. A fifth of the sample sets a temperature, which makes the score a probability, and the
rejection limit: the least score at which the accepted part is right to ``PRECISION``.

For prediction embeddings and softmax fold into one table of bucket by language, and a text's
logits are the mean of its rows. Only the text is an input.

Defined results: null texts and texts without a letter are ``und`` with score 0; equal logits go to
the language first by name; without any labelled row all are ``und``; repeated rows are predicted each;
extra columns are ignored. Text only reaches the driver as bucket counts of the sample.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import map_batches, strings
from meterline.llm.shingles import code_points, mix, tables

UNDETERMINED = "und"
BITS = 14
BUCKETS = 1 << BITS
ORDERS = (1, 2, 3, 4)
#: Labelled documents that the model is fitted on, over all languages.
SAMPLE = 2400
SPAN = 60
PRECISION = 0.995
CHUNK = 300_000


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0


class _Letters:
    """Letters by code point, per worker process."""

    table: np.ndarray | None = None

    @classmethod
    def of(cls, points: np.ndarray) -> np.ndarray:
        if cls.table is None:
            known = tables().is_word
            cls.table = known.copy()
            for c in np.flatnonzero(known):
                cls.table[c] = chr(c).isalpha()
        return cls.table[points]


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of every subword, offsets by text, and which texts have a letter."""
    joined = "\n" + "\n".join(t.lower() for t in texts) + "\n"
    points = code_points(joined)
    letter = _Letters.of(points)
    lengths = np.array([len(t.lower()) + 1 for t in texts])
    text_of = np.repeat(np.arange(len(texts)), lengths)
    text_of = np.concatenate([[0], text_of])
    value = np.where(letter, tables().value[points], np.uint64(1))
    ids, owners = [], []
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            continue
        rolled = np.full(n, order, np.uint64)
        for k in range(order):
            rolled = (rolled + value[k : k + n]) * np.uint64(0xD1342543DE82EF95)
            rolled ^= rolled >> np.uint64(32)
        inner = letter[:n] if order == 1 else np.ones(n, bool)
        for k in range(1, order - 1):
            inner &= letter[k : k + n]
        if order == 2:
            inner &= letter[:n] | letter[1 : 1 + n]
        at = np.flatnonzero(inner)
        ids.append((mix(rolled[at]) >> np.uint64(64 - BITS)).astype(np.int32))
        # a run belongs to the text of its second character: line ends open and close texts
        owners.append(text_of[np.minimum(at + (order > 1), len(points) - 1)])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    offsets = np.searchsorted(owner[order], np.arange(len(texts) + 1))
    has = np.bincount(text_of[letter], minlength=len(texts)) > 0
    return np.concatenate(ids)[order], offsets, has


def chunks(texts: list[str], most: int = CHUNK):
    start = 0
    while start < len(texts):
        end, size = start, 0
        while end < len(texts) and (end == start or size + len(texts[end]) <= most):
            size += len(texts[end])
            end += 1
        yield start, texts[start:end]
        start = end


def predict(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = [], []
    k = len(model.languages)
    for _, part in chunks(texts):
        if not k:
            names += [UNDETERMINED] * len(part)
            scores.append(np.zeros(len(part)))
            continue
        ids, offsets, has = subwords(part)
        counts = np.diff(offsets)
        logits = np.zeros((len(part), k))
        full = np.flatnonzero(counts > 0)
        if len(full):
            for j in range(k):
                sums = np.add.reduceat(model.table[:, j][ids], offsets[full])
                logits[full, j] = sums / counts[full]
        probability = softmax((logits + model.bias) / model.temperature)
        best = probability.argmax(axis=1)
        names += [model.languages[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)]
        scores.append(np.where(has, probability.max(axis=1), 0.0))
    return names, np.concatenate(scores) if scores else np.zeros(0)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class _Features:
    """Bucket counts of whole texts and of one short span of each."""

    def __call__(self, batch: pa.RecordBatch) -> dict:
        texts, langs = strings(batch, "text"), batch.column("lang").to_pylist()
        spans = []
        for t in texts:
            room = max(1, len(t) - SPAN)
            at = zlib.crc32(t.encode("utf-8", "replace")) % room
            spans.append(t[at : at + SPAN])
        out: dict[str, list] = {"lang": [], "ids": [], "counts": [], "part": []}
        for kind, rows in (("whole", texts), ("span", spans)):
            for start, part in chunks(rows):
                ids, offsets, has = subwords(part)
                for i in np.flatnonzero(has):
                    own, n = np.unique(ids[offsets[i] : offsets[i + 1]], return_counts=True)
                    out["lang"].append(langs[start + i])
                    out["ids"].append(own)
                    out["counts"].append(n)
                    out["part"].append(kind)
        return out


def sample(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """About ``size`` labelled rows, as many of each language as there are."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, size / len(counts) / n))).otherwise(share)
    draw = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return known.where(draw < share)


def fit(docs: DataFrame, size: int = SAMPLE, dim: int = 16, epochs: int = 6) -> Model:
    """A model of the languages of ``docs``, rows with a null ``lang`` aside."""
    found = map_batches(
        sample(docs.select("doc_id", "text", "lang"), size),
        _Features(),
        "lang string, ids array<int>, counts array<int>, part string",
    ).toArrow()
    langs = found.column("lang").to_pylist()
    languages = sorted(set(langs))
    rows = [
        (np.asarray(i, np.int64), np.asarray(c, np.float64) / sum(c), languages.index(lang))
        for i, c, lang in zip(
            found.column("ids").to_pylist(), found.column("counts").to_pylist(), langs, strict=True
        )
    ]
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tolist()[:8]))  # whatever order tasks end in
    k = len(languages)
    if not k:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    random = np.random.default_rng(7)
    shuffled = random.permutation(len(rows))
    cut = max(1, len(rows) // 5) if len(rows) >= 10 else 0
    checked, learnt = shuffled[:cut], shuffled[cut:]
    embedding = random.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    weights, bias = random.uniform(-0.1, 0.1, (k, dim)), np.zeros(k)
    total = max(1, epochs * len(learnt))
    step = 0
    for _ in range(epochs):
        for r in random.permutation(learnt):
            ids, share, y = rows[r]
            rate = 0.5 * (1 - step / total)
            step += 1
            mean = share @ embedding[ids]
            error = softmax(weights @ mean + bias)
            error[y] -= 1
            back = weights.T @ error
            weights -= rate * np.outer(error, mean)
            bias -= rate * 0.1 * error
            embedding[ids] -= rate * 20 * share[:, None] * back
    model = Model(languages, (embedding @ weights.T).astype(np.float32), bias)
    if cut:
        calibrate(model, [rows[r] for r in checked])
    return model


def calibrate(model: Model, rows: list) -> None:
    """Temperature of the least log loss, and the limit below which predictions are rejected."""
    logits = np.array([share @ model.table[ids] for ids, share, _ in rows]) + model.bias
    truth = np.array([y for _, _, y in rows])
    grid = np.geomspace(0.1, 10, 81)
    losses = [
        -np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid
    ]
    model.temperature = float(grid[int(np.argmin(losses))])
    probability = softmax(logits / model.temperature)
    score, right = probability.max(axis=1), probability.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    precision = np.cumsum(right[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(precision >= PRECISION)
    model.reject_below = float(score[order[good[-1]]]) if len(good) else 1.0


class _Predict:
    def __init__(self, broadcast, id_column: str):
        self.broadcast, self.id_column = broadcast, id_column

    def __call__(self, batch: pa.RecordBatch) -> dict:
        model = self.broadcast.value
        names, scores = predict(strings(batch, "text"), model)
        limit = model.reject_below
        return {
            self.id_column: batch.column(self.id_column),
            "lang_pred": names,
            "score": scores.tolist(),
            "rejected": [
                n == UNDETERMINED or s < limit for n, s in zip(names, scores.tolist(), strict=True)
            ],
        }


def identify(docs: DataFrame, model: Model, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: language, probability, and whether it is too low to trust."""
    kind = dict(docs.dtypes)[id_column]
    held = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages
    narrow = docs.select(id_column, F.col("text").cast("string").alias("text"))
    schema = f"{id_column} {kind}, lang_pred string, score double, rejected boolean"
    return map_batches(narrow, _Predict(held, id_column), schema)


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds
