"""Quality rules from compression: repetitive text packs too well, noise hardly at all.

Every text is compressed whole and in fixed chunks with zstandard. The ratio raw / packed grows
with length even for clean prose, so both limits depend on the length; a text is rejected when its
whole ratio leaves the band of its length, or when more than ``chunk_share`` of its chunks leave
the band of a chunk. Simple word counts are found in the same pass.

Defined results: a null text counts as empty; an empty text has ratio 0, no words, and fails the
base rule. Repeated rows are judged one by one. Extra columns are ignored by ``measure`` and kept by
``keep_good``, which needs no join: the verdict is found beside the row.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import filter_batches, map_batches, utf8

SPACES = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
WINDOW = 8

#: (length in bytes from, least ratio, largest ratio). Prose keeps well inside; a text that repeats
#: itself passes the upper limit, and random or encoded bytes stay under the lower one.
BANDS = (
    (0, 0.0, 2.2),
    (100, 0.75, 2.3),
    (200, 0.9, 2.4),
    (400, 1.1, 2.9),
    (800, 1.25, 3.6),
    (3200, 1.35, 4.2),
    (12800, 1.4, 5.0),
    (51200, 1.45, 6.0),
)


@dataclass(frozen=True)
class Rules:
    level: int = 3
    chunk_bytes: int = 4096
    chunk_share: float = 0.3
    least_words: int = 20
    repeat_percent: int = 30
    bands: tuple[tuple[int, float, float], ...] = BANDS


DEFAULT = Rules()

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bytes long, ratio double, n_chunks long, n_chunks_repetitive long, n_chunks_noisy long, "
    "base_failed boolean, verdict string, kept boolean"
)


def repeated_words(words: list[bytes]) -> int:
    """Words inside an 8-word window that the text holds twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    number = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words))
    number = (number + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    number ^= number >> np.uint64(29)
    mixed = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        mixed = mixed * np.uint64(0xD6E8FEB86659FD93) + number[k : k + n]
    ordered = np.sort(mixed)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    starts = np.flatnonzero(np.isin(mixed, twice))
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def _outside(ratio: float, size: int, bands) -> int:
    low, high = 0.0, np.inf
    for start, least, most in bands:
        if size >= start:
            low, high = least, most
    return -1 if ratio < low else int(ratio > high)


def _ratio(packer: zstandard.ZstdCompressor, data: bytes) -> float:
    return len(data) / len(packer.compress(data)) if data else 0.0


def judge(data: bytes, packer: zstandard.ZstdCompressor, rules: Rules = DEFAULT) -> tuple:
    """One text's row of ``SCHEMA``."""
    words = data.split()
    spaces = len(data) - len(data.translate(None, SPACES))
    points = len(data.translate(None, CONTINUATION))
    lines = Counter(line for line in data.split(b"\n") if line.strip())
    repeats = repeated_words(words)
    failed = len(words) < rules.least_words or 100 * repeats > rules.repeat_percent * len(words)
    ratio = _ratio(packer, data)
    step = rules.chunk_bytes
    chunks = [data[i : i + step] for i in range(0, len(data), step)]
    sides = [_outside(_ratio(packer, c), len(c), rules.bands) for c in chunks]
    high, low = sides.count(1), sides.count(-1)
    side = _outside(ratio, len(data), rules.bands)
    if side > 0 or high > rules.chunk_share * len(chunks):
        verdict = "repetitive"
    elif side < 0 or low > rules.chunk_share * len(chunks):
        verdict = "incompressible"
    else:
        verdict = "good"
    dup_lines = sum(lines.values()) - len(lines)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    head = (len(words), points - spaces, symbols, dup_lines, repeats)
    body = (len(data), ratio, len(chunks), high, low)
    return (*head, *body, failed, verdict, not failed and verdict == "good")


class _Judge:
    def __init__(self, rules: Rules, id_column: str):
        self.rules, self.id_column = rules, id_column

    def rows(self, batch: pa.RecordBatch) -> list[tuple]:
        packer = zstandard.ZstdCompressor(level=self.rules.level)
        return [judge(data, packer, self.rules) for data in utf8(batch, "text")]

    def __call__(self, batch: pa.RecordBatch) -> dict:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        out = dict(zip(names, map(list, zip(*self.rows(batch), strict=True)), strict=True))
        return out | {self.id_column: batch.column(self.id_column)}

    def kept(self, batch: pa.RecordBatch) -> list[bool]:
        return [r[-1] for r in self.rows(batch)]


def measure(docs: DataFrame, rules: Rules = DEFAULT, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its id, counts, ratios and verdict."""
    kind = dict(docs.dtypes)[id_column]
    narrow = docs.select(id_column, F.col("text").cast("string").alias("text"))
    return map_batches(narrow, _Judge(rules, id_column), f"{id_column} {kind}, {SCHEMA}")


def keep_good(docs: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns unchanged."""
    return filter_batches(docs, _Judge(rules, "doc_id").kept)
