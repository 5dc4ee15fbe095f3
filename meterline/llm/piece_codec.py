"""Exact encoding and decoding under a merge vocabulary of the SentencePiece kind.

The encoder doesn't replay merges over the text. A text's prefix has one encoding, so it has one last
token; the prefix table keeps that token for every prefix. An Aho-Corasick automaton lists the pieces
that end at a place, longest first, and a piece is the last token of the prefix when it fits behind the
last token of the shorter prefix before it: the merges of the two together never cross their seam.
Ids are then read backwards from the end of the text.

Whether two pieces fit is found by undoing their merges from the latest on. That is right when every
merge made of a piece scores below the merges inside it (``Piece.orderly``); a few pieces, such as runs of
spaces, are not of that kind, and pairs with one of them replay the merges of the two pieces.
Equal scores go to the leftmost pair, as in the library.

Texts are cut before a run of spaces where no piece crosses that place (checked when the vocabulary is
read). Stretches of at most ``SHORT`` characters are remembered per worker in two generations: ``KNOWN``
of them make the next older one, and what is met there again comes back.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows are encoded
each; characters without a piece become their UTF-8 bytes; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import map_batches, strings

MARK = "▁"
KNOWN, SHORT, PAIRS = 200_000, 48, 1_000_000


class Piece(NamedTuple):
    """How the merges make a piece: ``whole`` if they do, from ``left`` and ``right`` at the end."""

    whole: bool
    orderly: bool
    left: str
    right: str


#: A piece, its length, what is known of the pieces that fit behind it, its id.
Token = tuple[str, int, dict[str, bool], int]


class Vocabulary:
    """Pieces, scores and special ids of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        kinds = range(len(self.pieces))
        self.control = {i for i in kinds if model.is_control(i)}
        self.unknown = model.unk_id()
        self.byte_of = {i: int(self.pieces[i][3:5], 16) for i in kinds if model.is_byte(i)}
        plain = [i for i in kinds if i not in self.control | self.byte_of.keys() | {self.unknown}]
        if len(self.byte_of) != 256 or any(model.is_unused(i) for i in plain):
            raise ValueError("the vocabulary needs all bytes and no unused pieces")
        self.bytes = {b: i for i, b in self.byte_of.items()}
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: model.get_score(i) for i in plain}
        #: characters that stand side by side in some piece
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        #: no piece holds a space behind another character: texts may be cut before runs of spaces
        self.cut = not any(MARK in p.lstrip(MARK) for p in self.ids)


class Codec:
    """Encodes and decodes under one vocabulary."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.ids, self.scores = self.vocabulary.ids, self.vocabulary.scores
        self.tokens: dict[str, Token] = {p: (p, len(p), {}, i) for p, i in self.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, self.tokens[piece])
        self.automaton.make_automaton()
        self.made = functools.lru_cache(maxsize=200_000)(self._made)
        self.judged = 0
        self.known: dict[str, tuple[int, str, str]] = {}
        self.earlier: dict[str, tuple[int, str, str]] = {}
        special = {*self.vocabulary.control, *self.vocabulary.byte_of, self.vocabulary.unknown}
        self.shown = {i: p for i, p in enumerate(self.vocabulary.pieces) if i not in special}

    def merge(self, text: str, seam: int = -1) -> list[str] | None:
        """The pieces that merging ``text`` ends with; None as soon as a merge crosses ``seam``."""
        parts, starts = list(text), list(range(len(text)))
        while True:
            best = None
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = score, i
            if best is None:
                return parts
            i = best[1]
            if starts[i + 1] == seam:
                return None
            parts[i] += parts.pop(i + 1)
            starts.pop(i + 1)

    def _made(self, piece: str) -> Piece:
        if len(piece) == 1:
            return Piece(True, True, piece, "")
        parts, starts = list(piece), None
        while len(parts) > 1:
            scored = [
                (self.scores.get(parts[i] + parts[i + 1], -float("inf")), -i)
                for i in range(len(parts) - 1)
            ]
            score, i = max(scored)
            if score == -float("inf"):
                return Piece(False, False, piece, "")
            starts = parts
            parts = [*parts[: -i], parts[-i] + parts[-i + 1], *parts[-i + 2 :]]
        left, right = starts
        ahead = [self.made(p) for p in (left, right)]
        orderly = all(
            part.orderly and (not part.right or self.scores[whole] > self.scores[piece])
            for part, whole in zip(ahead, (left, right), strict=True)
        )
        return Piece(True, orderly, left, right)

    def fits(self, a: str, b: str) -> bool:
        """Merging ``a + b`` ends with exactly these two pieces."""
        first, second = self.made(a), self.made(b)
        if not (first.whole and second.whole):
            return False
        if not (first.orderly and second.orderly):
            return self.merge(a + b, seam=len(a)) is not None
        scores = self.scores
        if a + b in scores:
            return False
        while first.right or second.right:
            # the later of the two merges at the seam is undone; of equals, the right one
            if second.right and (not first.right or scores[b] <= scores[a]):
                limit, b = scores[b], second.left
                second = self.made(b)
                across = scores.get(a + b)
                if across is not None and across >= limit:  # it lies left of the undone merge
                    return False
            else:
                limit, a = scores[a], first.right
                first = self.made(a)
                across = scores.get(a + b)
                if across is not None and across > limit:
                    return False
        return True

    def last_tokens(self, marked: str) -> list[Token | None]:
        """By length of the prefix, the token that ends it; None for a character without a piece."""
        if self.judged > PAIRS:
            for token in self.tokens.values():
                token[2].clear()
            self.judged = 0
        last: list[Token | None] = [None] * (len(marked) + 1)
        for place, token in self.automaton.iter(marked):  # at each place the longest first
            end = place + 1
            if last[end] is not None:
                continue
            piece, size, _, _ = token
            if size == end:
                fit = self.made(piece).whole
            elif (before := last[end - size]) is None:
                fit = self.fits(marked[end - size - 1], piece)
            elif (fit := before[2].get(piece)) is None:
                fit = before[2][piece] = self.fits(before[0], piece)
                self.judged += 1
            if fit:
                last[end] = token
        return last

    def stretch_ids(self, marked: str) -> list[int]:
        """The ids of a stretch in which spaces are marks, read backwards from its end."""
        last, out, end = self.last_tokens(marked), [], len(marked)
        while end:
            if (token := last[end]) is not None:
                out.append(token[3])
                end -= token[1]
            else:
                end -= 1
                held = marked[end].encode("utf-8", "replace")
                out.extend(self.vocabulary.bytes[b] for b in reversed(held))
        out.reverse()
        return out

    def segments(self, stretch: str) -> list[str]:
        """Cut where no piece holds the two characters side by side, so that no merge crosses."""
        joined, out, start = self.vocabulary.joined, [], 0
        for i in range(1, len(stretch)):
            if stretch[i - 1 : i + 1] not in joined:
                out.append(stretch[start:i])
                start = i
        out.append(stretch[start:])
        return out

    def stretches(self, text: str) -> list[str]:
        """The marked text, cut before each run of marks."""
        marked = MARK + text.replace(" ", MARK)
        if not self.vocabulary.cut:
            return [marked]
        if MARK + MARK in marked:
            return re.findall(f"{MARK}+[^{MARK}]*", marked)
        return [MARK + word for word in marked[1:].split(MARK)]

    def encode(self, text: str | None) -> list[int]:
        return list(map(int, self.digest(text)[1].split(","))) if text else []

    def surface(self, ids: list[int]) -> str:
        """The text of ids with every mark as a space; runs of bytes are read as UTF-8."""
        out: list[str] = []
        held = bytearray()
        for i in [*ids, -1]:
            if (byte := self.vocabulary.byte_of.get(i)) is not None:
                held.append(byte)
                continue
            if held:
                out.append(_from_bytes(bytes(held)))
                held.clear()
            if i == self.vocabulary.unknown:
                out.append(" ⁇ ")
            elif i >= 0 and i not in self.vocabulary.control:
                out.append(self.vocabulary.pieces[i].replace(MARK, " "))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space that encoding put in front goes."""
        first = next((i for i in ids if i not in self.vocabulary.control), None)
        text = self.surface(ids)
        marked = first in self.ids.values() and self.vocabulary.pieces[first].startswith(MARK)
        return text[1:] if marked else text

    def learn(self, stretch: str) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, and the text of the ids with marks for spaces."""
        if (value := self.earlier.pop(stretch, None)) is None:
            segments = self.segments(stretch)
            if len(segments) > 1:
                found = [self.known.get(s) or self.learn(s) for s in segments]
                counts, numbers, texts = zip(*found, strict=True)
                size, number, text = sum(counts), ",".join(numbers), "".join(texts)
            else:
                ids = self.stretch_ids(stretch)
                size, number = len(ids), ",".join(map(str, ids))
                if None in (parts := list(map(self.shown.get, ids))):
                    text = self.surface(ids).replace(" ", MARK)
                else:
                    text = "".join(parts)
            # one object for both where they agree, as they nearly always do
            value = size, number, stretch if text == stretch else text
        if len(stretch) <= SHORT:
            self.known[stretch] = value
        return value

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by commas, and the text decoded from them."""
        if not text:
            return 0, "", ""
        if len(self.known) > KNOWN:
            self.known, self.earlier = {}, self.known
        known, stretches = self.known, self.stretches(text)
        found = list(map(known.get, stretches))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            found[at] = known.get(stretches[at]) or self.learn(stretches[at])
        counts, numbers, texts = zip(*found, strict=True)
        return sum(counts), ",".join(numbers), "".join(texts).replace(MARK, " ")[1:]


def _from_bytes(held: bytes) -> str:
    """UTF-8 of a run of byte pieces; each byte that is part of no character becomes U+FFFD."""
    out, at = [], 0
    while at < len(held):
        for size in (1, 2, 3, 4):
            try:
                out.append(held[at : at + size].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            size = 1
        at += size
    return "".join(out)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per worker process, so that stretches and pairs stay known."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


class _Encode:
    def __init__(self, path: str, id_column: str, with_ids: bool):
        self.path, self.id_column, self.with_ids = path, id_column, with_ids

    def __call__(self, batch: pa.RecordBatch) -> dict:
        own = codec(self.path)
        out: dict[str, list] = {
            n: [] for n in ("n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded")
        }
        for text in strings(batch, "_text"):
            n, numbers, decoded = own.digest(text)
            out["n_tokens"].append(n)
            out["ids_sha256"].append(hashlib.sha256(numbers.encode("ascii")).hexdigest())
            out["decoded_sha256"].append(
                hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest()
            )
            if self.with_ids:
                out["ids"].append([int(i) for i in numbers.split(",")] if n else [])
                out["decoded"].append(decoded)
        return {self.id_column: batch.column(0), **out}


def encode(
    docs: DataFrame, path: str, id_column: str = "doc_id", with_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs``: number of ids, digests, and with ``with_ids`` ids and decoded text."""
    kind = dict(docs.dtypes)[id_column]
    narrow = docs.select(
        F.col(id_column).alias("_id"), F.col("text").cast("string").alias("_text")
    )
    schema = f"`{id_column}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"
    return map_batches(narrow, _Encode(path, id_column, with_ids), schema)


class _Decode:
    def __init__(self, path: str, id_column: str):
        self.path, self.id_column = path, id_column

    def __call__(self, batch: pa.RecordBatch) -> dict:
        own = codec(self.path)
        lists = [[i for i in ids or () if i is not None] for ids in batch.column(1).to_pylist()]
        return {self.id_column: batch.column(0), "text": [own.decode(ids) for ids in lists]}


def decode(encoded: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """(id, text) of rows with a column ``ids``; null lists and null ids count as none."""
    kind = dict(encoded.dtypes)[id_column]
    narrow = encoded.select(
        F.col(id_column).alias("_id"), F.col("ids").cast("array<int>").alias("_ids")
    )
    return map_batches(narrow, _Decode(path, id_column), f"`{id_column}` {kind}, text string")
