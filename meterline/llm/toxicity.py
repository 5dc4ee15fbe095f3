"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters look at a text and vote or abstain: short lexicons and patterns written down here, and lexicons
mined from a bounded sample of labelled rows (words and word beginnings that are much commoner in
toxic rows, dealt to ``MINED_VOTERS`` voters by their first letters, sure words apart from others). The label model takes each voter as a
noisy view of one hidden label. From how often voters agree over all documents it estimates their rates
in toxic and in clean texts (a rank-one fit of the covariances off the diagonal), and their correlations (what the
fit leaves); correlated voters share their weight. Its posterior labels, not the given ones, train a
logistic classifier on the presence of the mined words and the votes.

Texts are read once for all documents: the hits of a text are written as a narrow table, from which the
agreements are counted and the scores computed. Only the text is an input of a score.

Defined results: null and empty texts have no hits and get the score of no evidence; a document
with several label rows is toxic if one says so; rows without a label teach nothing; without
toxic or without clean labelled rows the score is the share of toxic rows; repeated rows are scored
each; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import map_batches, strings
from meterline.sources.staging import stage

#: Labelled rows of each class that the lexicons are mined from and the classifier is fitted on.
SAMPLE = 3000
#: Mined words and beginnings at most, the strongest first.
LEXICON = 2000
MINED_VOTERS = 8
#: Share of the toxic sample that a mined word stands in at least.
LEAST_SHARE = 0.01
BEGINNINGS = (4, 5, 6, 7)

# Small lexicons by kind, and patterns.
LEXICONS = {
    "insult": "idiot moron loser clown fool jerk dumb imbecile cretin halfwit",
    "contempt": "stupid pathetic worthless disgusting useless ridiculous despicable",
    "dehumanising": "scum trash vermin filth parasite garbage maggot",
    "profanity": "damn crap bastard bullshit asshole bitch",
    "german": "idiot dummkopf abschaum versager arschloch",
    "french": "imbécile crétin connard ordure abruti",
    "spanish": "imbécil idiota basura estúpido escoria",
}
PATTERNS = {
    "address": r"\byou(?:'re| are)? (?:a |an |such a )?(?:idiot|moron|loser|fool|clown|stupid|scum)",
    "threat": r"\b(?:kill|hurt|destroy|beat) you\b",
    "silence": r"\bshut up\b|\bget lost\b|\bgo to hell\b",
    "outcry": r"!!!|\?!",
}

_WORD = re.compile(r"[^\W\d_]+")
_LEXICONS = {name: frozenset(words.split()) for name, words in LEXICONS.items()}
_PATTERNS = {name: re.compile(p) for name, p in PATTERNS.items()}
FIXED = [*LEXICONS, *PATTERNS]
VOTERS = len(FIXED) + MINED_VOTERS


def evidence(text: str) -> tuple[set[str], str]:
    """Words and word beginnings (with a hyphen) of a text, and its lower case."""
    low = text.lower()
    found = set(_WORD.findall(low))
    out = set(found)
    for n in BEGINNINGS:
        out.update([w[:n] + "-" for w in found if len(w) > n])
    return out, low


def mined_voter(word: str, strong: bool) -> int:
    """Words with one beginning share a voter; sure words and doubtful ones have voters apart."""
    half = MINED_VOTERS // 2
    return (0 if strong else half) + zlib.crc32(word[: min(BEGINNINGS)].encode()) % half


@dataclass
class Lexicon:
    """Mined words by number; ``strong`` ones hardly stand in clean texts."""

    words: list[str]
    strong: list[bool]
    number: dict[str, int] = field(init=False)
    voters: list[int] = field(init=False)

    def __post_init__(self):
        self.number = {w: i for i, w in enumerate(self.words)}
        self.voters = [
            len(FIXED) + mined_voter(w, s) for w, s in zip(self.words, self.strong, strict=True)
        ]

    def look(self, text: str) -> tuple[list[int], list[int]]:
        """(numbers of the mined words present, voters that vote)."""
        found, low = evidence(text)
        hits = sorted(self.number[w] for w in found.intersection(self.number))
        votes = {self.voters[h] for h in hits}
        for i, words in enumerate(_LEXICONS.values()):
            if not words.isdisjoint(found):
                votes.add(i)
        for i, pattern in enumerate(_PATTERNS.values(), len(_LEXICONS)):
            if pattern.search(low):
                votes.add(i)
        return hits, sorted(votes)


class _WordCounts:
    def __call__(self, batch: pa.RecordBatch) -> dict:
        counts: dict[tuple[str, int], int] = defaultdict(int)
        for text, toxic in zip(
            strings(batch, "text"), batch.column("toxic").to_pylist(), strict=True
        ):
            for w in evidence(text)[0]:
                counts[w, toxic] += 1
        return {
            "word": [w for w, _ in counts],
            "toxic": [n * t for (_, t), n in counts.items()],
            "clean": [n * (1 - t) for (_, t), n in counts.items()],
        }


def labelled_sample(labels: DataFrame, size: int = SAMPLE) -> tuple[DataFrame, dict[int, int]]:
    """Up to about ``size`` (doc_id, toxic) of each class, and how many there are of each."""
    one = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in one.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("toxic") == 1, min(1.0, size / max(1, counts.get(1, 0)))).otherwise(
        min(1.0, size / max(1, counts.get(0, 0)))
    )
    return one.where(draw < share), counts


def mine(sampled: DataFrame, limit: int = LEXICON) -> Lexicon:
    """The words and beginnings that speak most for a toxic text, by log-odds."""
    rows = map_batches(sampled, _WordCounts(), "word string, toxic long, clean long")
    toxic, clean = F.col("toxic"), F.col("clean")
    size = [n or 0 for n in sampled.agg(F.sum("toxic"), F.sum(1 - toxic)).head()]
    odds = F.log((toxic + 0.5) / (size[0] + 1)) - F.log((clean + 0.5) / (size[1] + 1))
    best = (
        rows.groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        # rarer ones are chance finds
        .where(toxic >= max(4.0, LEAST_SHARE * size[0]))
        .withColumn("odds", odds)
        .where("odds >= 3")
        .withColumn("weight", F.round(F.col("odds") * F.sqrt(toxic), 6))
        .orderBy(F.desc("weight"), "word")
        .limit(limit)  # a top-k report: the lexicon's documented size
    )
    found = best.collect()
    # at most one clean row in twenty
    return Lexicon([r["word"] for r in found], [20 * r["clean"] <= r["toxic"] for r in found])


class _Look:
    def __init__(self, broadcast, kept: tuple[str, ...]):
        self.broadcast, self.kept = broadcast, kept

    def __call__(self, batch: pa.RecordBatch) -> dict:
        lexicon = self.broadcast.value
        found = [lexicon.look(t) for t in strings(batch, "text")]
        return {
            "hits": [h for h, _ in found],
            "votes": [v for _, v in found],
            **{c: batch.column(c) for c in self.kept},
        }


def look(docs: DataFrame, lexicon: Lexicon, *kept: str) -> DataFrame:
    """Hits and votes of each text, beside the columns ``kept``."""
    held = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most LEXICON words
    kinds = dict(docs.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in kept] + ["hits array<int>", "votes array<int>"])
    narrow = docs.select(*kept, F.col("text").cast("string").alias("text"))
    return map_batches(narrow, _Look(held, kept), schema)


def agreements(looked: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and how many have the votes of both i and j."""
    total = looked.count()
    pairs = (
        looked.where(F.size("votes") > 0)
        .groupBy("votes")  # equal vote sets collapse before they are paired
        .count()
        .select("count", "votes", F.explode("votes").alias("i"))
        .select("count", "i", F.explode("votes").alias("j"))
        .groupBy("i", "j")
        .agg(F.sum("count").alias("n"))
    )
    both = np.zeros((VOTERS, VOTERS))
    for r in pairs.collect():  # voters x voters
        both[r["i"], r["j"]] = r["n"]
    return total, both


@dataclass
class LabelModel:
    prior: float
    in_toxic: np.ndarray
    in_clean: np.ndarray
    correlation: np.ndarray
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of a toxic text for each row of 0/1 votes.

        A voter that doesn't vote abstains: a lexicon of one language says nothing about another.
        """
        yes = np.log(self.in_toxic / self.in_clean) * self.weight
        odds = np.log(self.prior / (1 - self.prior)) + votes @ yes
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_label_model(
    total: int, both: np.ndarray, prior: float, start: np.ndarray, rounds: int = 4
) -> LabelModel:
    """Rates and correlations from the agreements; ``start``: a first guess of each voter's gap."""
    n = len(both)
    rate = np.diag(both) / max(1, total)
    cov = both / max(1, total) - np.outer(rate, rate)
    spread = prior * (1 - prior)
    used = np.diag(cov) > 1e-9
    free = np.outer(used, used) & ~np.eye(n, dtype=bool)
    u = np.where(used, start * np.sqrt(spread), 0.0)
    corr = np.zeros((n, n))
    for _ in range(rounds):
        for _ in range(60):
            norm = free @ (u * u)
            new = np.where(norm > 1e-12, (free * cov) @ u / np.maximum(norm, 1e-12), u)
            u = 0.5 * u + 0.5 * np.where(used, new, 0.0)
            u = np.clip(u, -np.sqrt(np.maximum(np.diag(cov), 0)), np.sqrt(np.maximum(np.diag(cov), 0)))
        rest = np.maximum(np.diag(cov) - u * u, 1e-9)
        corr = np.clip((cov - np.outer(u, u)) / np.sqrt(np.outer(rest, rest)), -1, 1)
        np.fill_diagonal(corr, 0)
        corr[~np.outer(used, used)] = 0
        strong = np.abs(corr) > 0.3
        free = np.outer(used, used) & ~np.eye(n, dtype=bool) & ~strong
    gap = u / np.sqrt(spread)
    clip = lambda x: np.clip(x, 1e-4, 1 - 1e-4)
    weight = np.where(used, 1 / (1 + np.where(np.abs(corr) > 0.3, np.abs(corr), 0).sum(axis=1)), 0)
    return LabelModel(
        prior, clip(rate + (1 - prior) * gap), clip(rate - prior * gap), corr, weight
    )


@dataclass
class Classifier:
    bias: float
    words: np.ndarray
    votes: np.ndarray

    def scores(self, hits: list[list[int]], votes: list[list[int]]) -> list[float]:
        out = []
        for h, v in zip(hits, votes, strict=True):
            odds = self.bias + self.words[h].sum() + self.votes[v].sum()
            out.append(float(1 / (1 + np.exp(-np.clip(odds, -40, 40)))))
        return out


def matrix(rows: list[list[int]], width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.float32)
    for i, row in enumerate(rows):
        out[i, row] = 1
    return out


def fit_classifier(
    hits: list, votes: list, target: np.ndarray, weight: np.ndarray, size: int, steps: int = 300
) -> Classifier:
    """Weighted logistic regression on soft labels, with a small ridge."""
    x = np.hstack([matrix(hits, size), matrix(votes, VOTERS), np.ones((len(hits), 1), np.float32)])
    weight = (weight / weight.sum()).astype(np.float32)
    theta = np.zeros(x.shape[1], np.float32)
    speed = np.zeros_like(theta)
    base = float(np.clip((weight * target).sum(), 1e-4, 1 - 1e-4))
    theta[-1] = np.log(base / (1 - base))
    scale = 1 / np.sqrt(1e-3 + (weight[:, None] * x).sum(axis=0))  # rare words learn as fast
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (weight * (p - target)) + 1e-4 * np.append(theta[:-1], 0)
        speed = 0.9 * speed - 0.3 * scale * grad
        theta = theta + speed
    return Classifier(
        float(theta[-1]), theta[:size].astype(float), theta[size:-1].astype(float)
    )


class _Score:
    def __init__(self, broadcast, kept: tuple[str, ...]):
        self.broadcast, self.kept = broadcast, kept

    def __call__(self, batch: pa.RecordBatch) -> dict:
        scores = self.broadcast.value.scores(
            batch.column("hits").to_pylist(), batch.column("votes").to_pylist()
        )
        return {
            **{c: batch.column(c) for c in self.kept},
            "score": scores,
            "predicted": [int(s >= 0.5) for s in scores],
        }


def score(docs: DataFrame, labels: DataFrame, *kept: str, id_column: str = "doc_id") -> DataFrame:
    """Score and prediction of every row of ``docs``; ``labels`` are the rows to learn from."""
    spark = docs.sparkSession
    kept = (id_column, *kept)
    sampled, counts = labelled_sample(labels.select("doc_id", "toxic"))
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most about 2 * SAMPLE rows of two numbers, so the broadcast has a proven bound
    sampled = stage(texts.join(F.broadcast(sampled), "doc_id"), "toxic-sample")
    lexicon = mine(sampled)
    looked = stage(look(docs, lexicon, *kept), "toxic-hits")
    total, both = agreements(looked)
    learnt = look(sampled, lexicon, "toxic").toArrow()
    toxic = np.array(learnt.column("toxic").to_pylist(), np.float64)
    n_toxic, n_clean = counts.get(1, 0), counts.get(0, 0)
    prior = n_toxic / max(1, n_toxic + n_clean)
    hits, votes = learnt.column("hits").to_pylist(), learnt.column("votes").to_pylist()
    if not toxic.any() or toxic.all():
        share = float(np.clip(prior, 1e-4, 1 - 1e-4))
        model = Classifier(
            float(np.log(share / (1 - share))), np.zeros(len(lexicon.words)), np.zeros(VOTERS)
        )
    else:
        cast = matrix(votes, VOTERS).astype(np.float64)
        gap = cast[toxic == 1].mean(axis=0) - cast[toxic == 0].mean(axis=0)
        prior = float(np.clip(prior, 1e-4, 1 - 1e-4))
        labeller = fit_label_model(total, both, prior, gap)
        weight = np.where(toxic == 1, n_toxic / toxic.sum(), n_clean / (1 - toxic).sum())
        model = fit_classifier(hits, votes, labeller.posterior(cast), weight, len(lexicon.words))
    held = spark.sparkContext.broadcast(model)
    kinds = dict(looked.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", score double, predicted int"
    return map_batches(looked, _Score(held, kept), schema)
