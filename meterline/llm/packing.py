"""Sum-of-squares packing of tokenised documents into windows of a fixed length.

A document longer than a window fills whole windows first. What is left of it, of size s, goes
where the sum over levels h of N(h)^2 grows least, N(h) being the number of open windows filled up to
h: into some open window of level h (N(h) falls, N(h + s) rises), or into a new one. The counts are an
array over the levels, so a placement is one vector step over the window length. A full window is written
out at once and its tokens are let go.

Every task packs the rows of its own partition; nothing is shuffled. When a task ends, its open
windows are closed: pieces of the emptiest are cut to fill the fullest, which leaves one partial
window, and that is cut into sequences whose lengths are powers of two, which need no padding.
``sequence_id`` holds the partition in its upper bits. Read the documents from a file or a written table:
then a lost task is packed again in the same way.

Defined results: a null text is an empty one, an empty document is its end id alone; repeated rows
are packed each; null ids are kept; extra columns are ignored; an empty table gives no sequences.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from meterline.llm.common import as_batch, map_partitions, utf8

LENGTH = 2048
END_ID = 1


# Bytes that byte-level vocabularies spell as themselves; the others follow from 256.
_AS_IS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [b for b in range(256) if b not in _AS_IS]
SPELLED = {b: chr(256 + i) for i, b in enumerate(_OTHERS)}


class WordTokenizer:
    """Ids of a tokenizer whose pieces never cross its own word split, with known words kept.

    The file lower-cases and splits each text into words, never across white space, and merges
    inside a word only. A text of Latin-1 letters is therefore a join of its runs between ASCII white
    space, where a full stop or comma beside letters counts as a run of its own. A run is looked up;
    a new one is split, and its words go through the tokenizer's own merges. Other texts go by
    their runs too, and runs beyond Latin-1 and texts that spell out a special token go through
    the tokenizer.
    """

    # fixed value: the file's own split pattern, and below it the same for lower-case Latin-1
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    LATIN = re.compile(
        "[a-zªµºß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9²³¹¼½¾]|[^a-zªµºß-öø-ÿ0-9²³¹¼½¾\t-\r \x85\xa0]+"
    )

    #: a stop or comma that touches another sign, with which it would make one word
    TOUCHING = re.compile("[^a-zªµºß-öø-ÿ0-9²³¹¼½¾\\t-\\r ][.,]|[.,][^a-zªµºß-öø-ÿ0-9²³¹¼½¾\\t-\\r ]")

    def __init__(self, path: str, most: int = 1_000_000):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.by_word = split == self.SPLIT and spec["model"]["end_of_word_suffix"] == "</w>"
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.most, self.known = most, {}

    def whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, text: str) -> bytes:
        """Ids of one word of the split: its bytes, spelled as the file does, go to the merges."""
        plain = text.isascii() and text.isprintable()
        spelled = text if plain else text.encode().decode("latin-1").translate(SPELLED)
        return _packed([t.id for t in self.model.tokenize(spelled)])

    def run(self, text: str) -> bytes:
        """Ids of a new run; Latin-1 runs are lower case already."""
        if not _is_latin(text):
            return self.whole(text)
        words = self.LATIN.findall(text)
        return self.word(text) if words == [text] else b"".join(map(self.word, words))

    def ids(self, runs: list[str]) -> np.ndarray:
        known = self.known
        out = list(map(known.get, runs))
        at = -1
        for _ in range(out.count(None)):
            at = out.index(None, at + 1)
            run = runs[at]
            if (ids := known.get(run)) is None:
                ids = known[run] = self.run(run)
            out[at] = ids
        return np.frombuffer(b"".join(out), "<u4")

    def __call__(self, data: bytes) -> np.ndarray:
        text = data.decode("utf-8", "replace")
        if len(self.known) > self.most:
            self.known.clear()
        if not self.by_word or any(s in text for s in self.special):
            return np.frombuffer(self.whole(text), "<u4")
        if not _is_latin(text):
            runs = (run.decode() for run in data.split())
            return self.ids([run.lower() if _is_latin(run) else run for run in runs])
        text = text.lower()
        if self.TOUCHING.search(text):
            return self.ids(self.LATIN.findall(text))
        # white space beyond ASCII stays inside a run, and splits it when it is new
        apart = text.replace(".", " . ").replace(",", " , ").encode().split()
        return self.ids(b" ".join(apart).decode().split(" ") if apart else [])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Packer:
    """Open windows of one task. A piece is (row key, start, ids, document's length)."""

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.counts = np.zeros(length + 1, np.int64)  # windows open at each level, 1..length-1
        self.open: dict[int, list[list]] = defaultdict(list)

    def level_for(self, size: int) -> int:
        """The level to place ``size`` on (0: a new window), at the least sum of squares."""
        n, top = self.counts, self.length - size
        # h -> h + size: N(h) falls by one and N(h + size) rises by one; a full window isn't counted
        best, grown = 0, 2 * int(n[size]) + 1 if size < self.length else 0
        if top >= 1:
            rise = 2 * n[1 + size : self.length + 1] + 1
            rise[-1] = 0
            cost = rise - 2 * n[1 : top + 1] + 1
            cost[n[1 : top + 1] == 0] = np.iinfo(np.int64).max
            at = len(cost) - 1 - int(np.argmin(cost[::-1]))  # ties: the fullest window
            if cost[at] <= grown and n[at + 1]:
                best = at + 1
        return best

    def add(self, key, ids: np.ndarray) -> list[list]:
        """Windows that a document completes, each a list of pieces."""
        full, n, start = [], len(ids), 0
        while n - start >= self.length:
            full.append([(key, start, ids[start : start + self.length], n)])
            start += self.length
        if start < n:
            piece = (key, start, ids[start:], n)
            size = n - start
            level = self.level_for(size)
            window = self.open[level].pop() if level else []
            if level:
                self.counts[level] -= 1
            window.append(piece)
            if level + size == self.length:
                full.append(window)
            else:
                self.counts[level + size] += 1
                self.open[level + size].append(window)
        return full

    def close(self) -> list[list]:
        """The open windows, with pieces moved so that all are full but the last, which is cut."""
        rest = [w for level in sorted(self.open) for w in self.open[level]]  # emptiest first
        self.open.clear()
        self.counts[:] = 0
        done, low, spare = [], 0, []
        for high in range(len(rest) - 1, -1, -1):
            if high < low:
                break
            window = list(rest[high])
            gap = self.length - sum(len(p[2]) for p in window)
            while gap:
                if not spare:
                    if low >= high:
                        break
                    spare, low = list(rest[low]), low + 1
                key, start, ids, n = spare.pop()
                if len(ids) > gap:
                    spare.append((key, start, ids[:-gap], n))
                    key, start, ids = key, start + len(ids) - gap, ids[-gap:]
                window.append((key, start, ids, n))
                gap -= len(ids)
            if gap and window:
                spare = window  # the last one: nothing is left to fill it
                break
            done.append(window)
        return done + self.powers(spare)

    def powers(self, pieces: list) -> list[list]:
        """Pieces of less than a window cut into sequences of lengths 2^k, the longest first."""
        out, left = [], sum(len(p[2]) for p in pieces)
        pieces = list(pieces)[::-1]
        while left:
            want = 1 << (left.bit_length() - 1)
            left -= want
            window = []
            while want:
                key, start, ids, n = pieces.pop()
                if len(ids) > want:
                    pieces.append((key, start + want, ids[want:], n))
                    ids = ids[:want]
                window.append((key, start, ids, n))
                want -= len(ids)
            out.append(window)
        return out


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that words stay known from task to task."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


class _Pack:
    def __init__(self, path: str, length: int, end_id: int, kind, id_column: str):
        self.path, self.length, self.end_id = path, length, end_id
        self.kind, self.id_column = kind, id_column

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = tokenizer(self.path), Packer(self.length)
        schema = to_arrow_schema(self.kind)
        first, number = TaskContext.get().partitionId() << 33, 0

        def rows(windows: list[list]) -> pa.RecordBatch | None:
            nonlocal number
            out: dict[str, list] = {name: [] for name in schema.names}
            for window in windows:
                offset = 0
                for key, start, ids, n in window:
                    out[self.id_column].append(key)
                    out["start"].append(start)
                    out["length"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(np.ascontiguousarray(ids, "<u4")))
                    out["doc_tokens"].append(n)
                    out["sequence_id"].append(first + number)
                    out["offset"].append(offset)
                    if "ids" in out:
                        out["ids"].append(ids.astype(np.int32))
                    offset += len(ids)
                number += 1
            return as_batch(out, schema) if windows else None

        for batch in batches:
            full = []
            for key, text in zip(
                batch.column(self.id_column).to_pylist(), utf8(batch, "text"), strict=True
            ):
                ids = np.append(tokens(text), np.uint32(self.end_id)).astype("<u4")
                full += packer.add(key, ids)
            if (out := rows(full)) is not None:
                yield out
        if (out := rows(packer.close())) is not None:
            yield out


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: its document, place there, sequence, place there, and its ids."""
    kind = dict(docs.dtypes)[id_column]
    schema = (
        f"{id_column} {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + ", ids array<int>" * with_ids
    )
    parsed = StructType.fromDDL(schema)
    narrow = docs.select(id_column, F.col("text").cast("string").alias("text"))
    return map_partitions(
        narrow, _Pack(tokenizer_path, length, end_id, parsed, id_column), parsed
    )
