"""Quality, licences, token counts, packing and WARC against plain brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from meterline.llm import (
    license_scan,
    packing,
    piece_codec,
    quality,
    queries,
    token_counts,
    warc,
)
from meterline.llm.common import table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LICENCE_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def plain_quality(text):
    words = WORDS.findall(text)
    where = defaultdict(list)
    for i in range(len(words) - 7):
        where[tuple(words[i : i + 8])].append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_quality_counts(spark, sf_dir, texts):
    got = queries.op4_quality(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        have = (*[r[n] for n in names], r["base_failed"])
        assert have == plain_quality(texts[r["doc_id"]])
        assert not (r["kept"] and r["base_failed"])


def test_quality_bands():
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    rng = random.Random(3)
    noise = base64.b64encode(rng.randbytes(6000)) + b" a" * 30
    assert quality.judge(noise, packer)[-2] == "incompressible"
    assert quality.judge(b"buy this now and save big " * 300, packer)[-2] == "repetitive"
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    prose = " ".join(rng.choice(words) for _ in range(1500)).encode()
    assert quality.judge(prose, packer)[-1]
    half = prose + b"again and again " * 2000
    assert not quality.judge(half, packer)[-1]


def plain_places(text):
    words = LICENCE_WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    found = []
    for t in license_scan.BASE:
        want = t.text.split()
        found += [(i, t.label) for i in range(len(words)) if words[i : i + len(want)] == want]
    return words, found


def check_licence(r, text):
    words, found = plain_places(text)
    assert r["n_words"] == len(words)
    assert r["n_base"] == len(found)
    assert r["first_word"] == min((i for i, _ in found), default=None)
    assert r["last_word"] == max((i for i, _ in found), default=None)
    assert r["base_labels"] == ",".join(sorted({label for _, label in found}))
    assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_licences(spark, sf_dir, texts):
    for r in queries.op5_license(spark, sf_dir).collect():
        check_licence(r, texts[r["doc_id"]])


def test_licence_corners(spark):
    cases = [
        "Under the MIT license, under THE mit-License; under the mit licenses",
        "CC-BY-NC cc by nc cc by cc by nc",
        "apache license version 2.0 apache License, Version 22 apache license version 2",
        license_scan.MORE[0].text + " x " + license_scan.MORE[0].text.replace("charge", "cost"),
        "mit " * 50,
        "license under the mit",
    ]
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    for i, text in enumerate(cases):
        check_licence(got[i], text)
    assert got[3]["labels"] == "mit" and got[3]["n_places"] == 2
    assert got[4]["labels"] == "" and got[5]["labels"] == ""


# The sentences as their licences are published, with the line breaks and signs of the originals.
PUBLISHED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""",
    "apache-2": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.""",
    "gpl": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or""",
    "lgpl": """    This library is free software; you can redistribute it and/or
    modify it under the terms of the GNU Lesser General Public
    License as published by the Free Software Foundation; either""",
    "mpl-2": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc-by": "Creative Commons Attribution 4.0 International Public License",
    "cc0": "CC0 1.0 Universal",
}


def test_published_licences(spark):
    docs = spark.createDataFrame(
        [(k, "/*\n * " + t.replace("\n", "\n * ") + "\n */\nint main() {}") for k, t in PUBLISHED.items()],
        "doc_id string, text string",
    )
    got = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert {k: r["labels"] for k, r in got.items()} == {k: k for k in PUBLISHED}
    assert all(r["score"] == 1.0 for r in got.values())


def test_token_counts_equal_the_library(texts):
    library, counter = token_counts.reference_tokenizer(queries.PIECES), token_counts.Counter(queries.PIECES)
    rng = random.Random(5)
    pool = "aeinrst thTHE ▁é日🙂\n\t0<x>\x00ﬁ"
    odd = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    for text in [*odd, *list(texts.values())[:120], " lead", "two  spaces ", ""]:
        assert counter.text(text)[0] == len(library.encode(text, add_special_tokens=False).ids), text


def test_token_ties_take_the_earlier_start():
    counter = token_counts.Counter(queries.PIECES)
    import ahocorasick

    counter.automaton = ahocorasick.Automaton()
    for piece in ("ab", "c", "a", "bc"):
        counter.automaton.add_word(piece, (len(piece), -1.0))
    counter.automaton.make_automaton()
    assert counter.word("abc") == (2, -2.0)


def test_word_tokenizer_equals_the_library():
    whole = Tokenizer.from_file(queries.WORD_BPE)
    quick = packing.WordTokenizer(queries.WORD_BPE)
    rng = random.Random(1)
    pools = ["aAbB '’sStTreveLLdD09½ǅßẞİıσςΣά́̈ﬁ中한🙂\t\n \x85\x1c-.,!?_٣Ⅷ", "".join(map(chr, range(256)))]
    for pool in pools:
        for _ in range(3000):
            text = "".join(rng.choice(pool) for _ in range(rng.randint(0, 14)))
            want = whole.encode(text, add_special_tokens=False).ids
            assert quick(text.encode()).tolist() == want, text
    text = "a <|endoftext|> b"
    assert quick(text.encode()).tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packing_is_gapless_and_tight(spark, sf_dir, texts):
    whole = Tokenizer.from_file(queries.WORD_BPE)
    docs, windows = defaultdict(list), defaultdict(list)
    for r in queries.op1_packing(spark, sf_dir).collect():
        docs[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    assert set(docs) == set(texts)
    for doc_id, pieces in docs.items():
        ids = np.array(whole.encode(texts[doc_id], add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : at].tobytes())
        assert at == len(ids)
    for pieces in windows.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.LENGTH and at & (at - 1) == 0


def test_sum_of_squares_placement():
    packer = packing.Packer(10)
    for level in (3, 3, 4):
        packer.counts[level] += 1
        packer.open[level].append([("x", 0, np.zeros(level, "<u4"), level)])
    # on a 4 it closes a window: the sum falls by 1; on one of two 3s it makes a 9: 4 -> 1, 0 -> 1
    assert packer.level_for(6) == 3
    packer.counts[3] = 1
    assert packer.level_for(6) == 4
    for size in range(1, 11):
        brute = []
        for h in [0, *[h for h in range(1, 11 - size) if packer.counts[h]]]:
            after = packer.counts.copy()
            after[h] -= h > 0
            if h + size < 10:
                after[h + size] += 1
            brute.append((int((after[1:10] ** 2).sum()), -h))
        assert packer.level_for(size) == -min(brute)[1]


def test_archives_round_trip(spark, tmp_path):
    rng = random.Random(2)
    page = ["", "a", "é" * 50, None, "<html>\r\n\r\n" + "x" * 3000, "".join(map(chr, range(1, 200)))]
    rows = [(i, f"http://x/{i}\r\né", rng.choice(page)) for i in range(400)]
    rows += [(None, None, "a"), (None, "u", "only me"), (7, "http://again", rows[7][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    files = spark.createDataFrame(warc.write_archives(pages, str(tmp_path)).collect(), warc.MANIFEST)
    want = Counter()
    top = {}
    for i, _, html in rows:
        if i is not None:
            top[html or ""] = max(i, top.get(html or "", -1))
    for i, _, html in rows:
        data = (html or "").encode()
        best = top.get(html or "")
        first = best is None or i == best
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want[i, len(data), digest, "response" if first else "revisit", None if first else best, True] += 1
    for split in (97, 1000, 1 << 20):  # splits inside headers, members and magic bytes
        got = warc.page_records(warc.read_archives(files, split)).collect()
        assert Counter(tuple(r) for r in got) == want
    listed = warc.archive_files(spark, str(tmp_path))
    assert listed.count() == files.count()


def test_reader_skips_broken_members(spark, tmp_path):
    good = [warc.record_bytes(i, "u", b"payload %d" % i, None) for i in range(5)]
    broken = bytearray(good[2])
    broken[30] ^= 0xFF
    data = good[0] + good[1] + bytes(broken) + b"\x1f\x8b\x08junk" + good[3] + good[4][:-9]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    files = spark.createDataFrame([(str(path), len(data))], "path string, bytes long")
    for split in (50, 1 << 20):
        got = warc.page_records(warc.read_archives(files, split)).collect()
        assert sorted(r["page_id"] for r in got) == [0, 1, 3]


def own_and_library():
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    return piece_codec.codec(queries.PIECES), library


def test_pieces_equal_the_library(texts):
    own, library = own_and_library()
    for text in texts.values():
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.digest(text) == (len(ids), ",".join(map(str, ids)), library.decode(ids))


def test_pieces_of_odd_texts_equal_the_library(monkeypatch):
    own, library = own_and_library()
    rng = random.Random(8)
    odd = ["", " ", "  a  b ", "a▁b", " ▁ ▁▁ x", "\t\n x", "a\0b", "<s> </s> <0x0A>", " " * 37, "e\u0301"]
    odd += ["a" * 99, "x" + " " * 23 + "y", "日本語テキスト", "😀😀 é", "\n\n   def f():\n\t\treturn"]
    for alphabet in ("ab  ethn▁\nréß日1", "  tea", "the in", "aA.,-_/\\$"):
        odd += ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(700)]
    ranges = ((32, 126), (160, 0x500), (0x4E00, 0x4F00), (0x1F600, 0x1F640))
    odd += ["".join(chr(rng.randint(*rng.choice(ranges))) for _ in range(40)) for _ in range(700)]
    for known in (piece_codec.KNOWN, 5):  # forgetting changes nothing
        monkeypatch.setattr(piece_codec, "KNOWN", known)
        monkeypatch.setattr(piece_codec, "PAIRS", known)
        for text in odd:
            ids = library.encode(text)
            assert own.digest(text) == (len(ids), ",".join(map(str, ids)), library.decode(ids))


def test_any_ids_decode_as_in_the_library():
    own, library = own_and_library()
    rng = random.Random(9)
    for _ in range(4000):
        kinds = (rng.randint(0, 31999), rng.randint(0, 300), rng.randint(259, 262))
        ids = [rng.choice(kinds) for _ in range(rng.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids)


def test_prefix_tables_equal_merging():
    own, _ = own_and_library()
    rng = random.Random(10)
    for _ in range(1500):
        stretch = "▁" + "".join(rng.choices("etainosh▁", k=rng.randint(0, 20)))
        pieces = [own.vocabulary.pieces[i] for i in own.stretch_ids(stretch)]
        assert pieces == own.merge(stretch)
        last = own.last_tokens(stretch)
        for end in range(1, len(stretch) + 1):  # of every prefix, not only of the whole
            assert last[end][0] == own.merge(stretch[:end])[-1]


def test_codec_operator(spark):
    rows = [(1, "a  text"), (1, "a  text"), (None, "x"), (2, None), (3, ""), (4, "日本\n" * 9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    odd = df.selectExpr("*", "1 AS ids", "2 AS _id", "3 AS _text", "4 AS decoded", "5 AS `a.b`")
    _, library = own_and_library()
    got = piece_codec.encode(odd, queries.PIECES)
    for r in got.collect():
        text = dict(rows)[r.doc_id] or ""
        ids = library.encode(text)
        assert (r.n_tokens, r.ids, r.decoded) == (len(ids), ids, library.decode(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert got.count() == 6
    back = piece_codec.decode(got.drop("decoded"), queries.PIECES)
    assert sorted(map(repr, back.collect())) == sorted(
        repr(r) for r in df.fillna("", "text").select("doc_id", "text").collect()
    )
    assert piece_codec.encode(odd.limit(0), queries.PIECES).count() == 0
    none = spark.createDataFrame([(1, None), (2, [None, 264])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in piece_codec.decode(none, queries.PIECES).collect()} == {1: "", 2: "a"}
