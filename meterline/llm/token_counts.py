"""Token counts of a unigram vocabulary without making the tokens.

An Aho-Corasick automaton enumerates, at every end position, the pieces that end there; dynamic
programming carries the best score and the number of pieces on the best path, nothing else. Ties are
broken as the unigram tokenizer does: among paths of equal score to one place the piece that starts
first wins, a character without a piece of its own costs ``UNKNOWN_COST`` more than the worst piece and
is considered last, and it counts as its UTF-8 bytes.

The text is cut before every space, which becomes the mark that begins a piece; pieces hold that
mark at their start only, so a word's count doesn't depend on its neighbours and is kept per worker.

The vocabulary is the file's pieces in the file's order; their log-probabilities follow Zipf's law by
rank (the file has merge ranks, which aren't probabilities). ``reference_tokenizer`` is the same
vocabulary in the public tokenizer library, which the counts must equal.

Defined results: a null or empty text has no tokens and score 0; repeated rows are counted each;
extra columns are ignored.
"""

from __future__ import annotations

import math

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import map_batches, strings

MARK = "▁"
UNKNOWN_COST = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, log-probability) by rank."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    total = math.log(sum(1 / (rank + 1) for rank in range(len(pieces))))
    special = {i for i in range(len(pieces)) if model.is_control(i) or model.is_unknown(i)}
    bytes_ = {i for i in range(len(pieces)) if model.is_byte(i)}
    ranks, rank = [], 0
    for i in range(len(pieces)):
        late = i in special or i in bytes_
        ranks.append(len(pieces) - 1 if late else rank)  # never likelier than a piece of text
        rank += not late
    return [(p, -math.log(r + 1) - total) for p, r in zip(pieces, ranks, strict=True)]


def reference_tokenizer(path: str):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = vocabulary(path)
    unknown = next(i for i, (p, _) in enumerate(pieces) if p == "<unk>")
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(MARK, prepend_scheme="always", split=True)
    return tokenizer


class Counter:
    """(pieces, score) of words under one vocabulary; forgets all once ``most`` are known."""

    def __init__(self, path: str, most: int = 600_000):
        pieces = vocabulary(path)
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in pieces) - UNKNOWN_COST
        self.most, self.known = most, {}

    def word(self, text: str) -> tuple[int, float]:
        n = len(text)
        ending: list[list] = [[] for _ in range(n)]
        for last, piece in self.automaton.iter(text):
            ending[last].append(piece)  # the longest first
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            top, least, length = None, 0, 0
            for length, score in ending[end - 1]:
                score += best[end - length]
                if top is None or score > top:
                    top, least = score, count[end - length] + 1
            if length != 1:
                score = best[end - 1] + self.unknown
                if top is None or score > top:
                    size = len(text[end - 1].encode("utf-8", "surrogatepass"))
                    top, least = score, count[end - 1] + size
            best[end], count[end] = top, least
        return count[n], best[n]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        marked = text.replace(" ", MARK)
        words = marked.split(MARK)
        if marked[0] == MARK:
            words = words[1:]
        known = self.known
        if len(known) > self.most:
            known.clear()
        found = list(map(known.get, words))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            word = words[at]
            if (value := known.get(word)) is None:
                value = known[word] = self.word(MARK + word)
            found[at] = value
        counts, scores = zip(*found, strict=True)
        return sum(counts), math.fsum(scores)


_COUNTERS: dict[str, Counter] = {}


class _Count:
    def __init__(self, path: str, id_column: str):
        self.path, self.id_column = path, id_column

    def __call__(self, batch: pa.RecordBatch) -> dict:
        if self.path not in _COUNTERS:  # one per worker process: words stay known
            _COUNTERS[self.path] = Counter(self.path)
        counter = _COUNTERS[self.path]
        pairs = [counter.text(t) for t in strings(batch, "text")]
        return {
            self.id_column: batch.column(self.id_column),
            "n_tokens": [n for n, _ in pairs],
            "log_prob": [s for _, s in pairs],
        }


def count_tokens(docs: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: number of tokens and score of the best segmentation."""
    kind = dict(docs.dtypes)[id_column]
    narrow = docs.select(id_column, F.col("text").cast("string").alias("text"))
    return map_batches(
        narrow, _Count(path, id_column), f"{id_column} {kind}, n_tokens long, log_prob double"
    )
