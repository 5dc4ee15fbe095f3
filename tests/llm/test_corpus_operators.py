"""Near-duplicates, lines, decontamination, language, toxicity and the pipeline by brute force."""

import random

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import (
    decontaminate,
    graph,
    language,
    line_dedup,
    near_dedup,
    quality,
    queries,
    shingles,
    toxicity,
)
from meterline.llm.common import table


def pool(rng, n=4000):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def edited(rng, words, vocabulary, edits):
    out = list(words)
    for _ in range(edits):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.6:
            out[at] = rng.choice(vocabulary)
        elif kind < 0.8:
            out.insert(at, rng.choice(vocabulary))
        else:
            del out[at]
    return out


def components_of(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


@pytest.fixture(scope="module")
def corpus():
    """Families of copies, light and heavy edits, a passage in many texts, unrelated texts."""
    rng = random.Random(11)
    vocabulary = pool(rng)
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, number = {}, 0
    for family in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 500))]
        if family % 3 == 0:
            base = base[:80] + passage
        for copy in range(rng.randint(1, 5)):
            edits = 0 if copy == 1 else int(len(base) * rng.choice([0, 0.005, 0.01, 0.04, 0.1]))
            rows[number] = " ".join(edited(rng, base, vocabulary, edits) if copy else base)
            number += 1
    return rows


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a = rng.sample(range(60), rng.randint(20, 40))
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            if rng.random() < 0.5:
                del b[rng.randrange(len(b))]
            else:
                b.insert(rng.randrange(len(b)), 1000 + rng.randint(0, 10**6))
        if rng.random() < 0.3:
            b[:4], b[-4:] = b[-4:], b[:4]
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + (x == y))
        want = best[-1, -1] / (len(a) + len(b) - best[-1, -1])
        got = near_dedup.alignment(np.array(a, np.uint64), np.array(b, np.uint64), 0.5)
        assert got == want or (got == 0 and want < 0.5)


def test_near_duplicates_equal_all_pairs(spark, corpus):
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
    sequences = {k: near_dedup.sequence(t) for k, t in corpus.items()}
    ids = sorted(corpus)
    pairs = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and near_dedup.alignment(sequences[a], sequences[b]) >= near_dedup.THRESHOLD
    ]
    want = components_of(pairs, ids)
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == want
    assert len(set(want.values())) < len(ids)
    kept = {r["doc_id"] for r in near_dedup.keep_one(docs).collect()}
    assert kept == set(want.values())


def test_links_have_the_jaccard_similarity(corpus):
    def plain(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    ids = sorted(corpus)
    for a in ids:
        for b in ids:
            if a < b:
                x, y = plain(corpus[a]), plain(corpus[b])
                jaccard = len(x & y) / len(x | y)
                mine = near_dedup.alignment(
                    near_dedup.sequence(corpus[a]), near_dedup.sequence(corpus[b])
                )
                assert mine <= jaccard + 0.02
                if jaccard >= 0.82:
                    assert mine >= 0.8


def test_unlike_texts_of_one_bucket_hide_no_pair(spark):
    """All texts begin with a long passage; pairs differ in the rest."""
    rng = random.Random(8)
    vocabulary = pool(rng)
    passage = " ".join(rng.choice(vocabulary) for _ in range(200))
    rows = []
    for k in range(30):
        rest = [rng.choice(vocabulary) for _ in range(80)]
        rows += [(2 * k, passage + " " + " ".join(rest)), (2 * k + 1, passage + " " + " ".join(rest[:-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert all(got[2 * k] == got[2 * k + 1] == 2 * k for k in range(30))


def test_pairs_parted_by_finer_buckets_are_found(spark):
    """All texts share most of their words; pairs, all of which meet in a first bucket, are barely alike."""
    rng = random.Random(13)
    vocabulary = pool(rng)
    passage = [rng.choice(vocabulary) for _ in range(214)]
    rows = []
    for k in range(150):
        text = passage + [rng.choice(vocabulary) for _ in range(36)]
        other = list(text)
        for at in rng.sample(range(5, 245), 5):
            other[at] = rng.choice(vocabulary)
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(other))]
    sequences = [near_dedup.sequence(t) for _, t in rows]
    ids = range(len(rows))
    pairs = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and near_dedup.alignment(sequences[a], sequences[b]) >= near_dedup.THRESHOLD
    ]
    assert len(pairs) > 100
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == components_of(pairs, ids)


def test_edited_copies_meet_their_original(spark):
    """One original and 200 copies, each 0.8 to 0.85 like it and below 0.8 to the others."""
    rng = random.Random(5)
    vocabulary = pool(rng)
    base = [rng.choice(vocabulary) for _ in range(300)]
    rows = [(0, " ".join(base))]
    while len(rows) <= 200:
        copy = list(base)
        for at in rng.sample(range(5, 295), rng.choice([5, 6])):
            copy[at] = rng.choice(vocabulary)
        rows.append((len(rows), " ".join(copy)))
    sequences = {k: near_dedup.sequence(t) for k, t in rows}
    ids = sorted(sequences)
    pairs = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and near_dedup.alignment(sequences[a], sequences[b]) >= near_dedup.THRESHOLD
    ]
    assert len(pairs) < 4 * len(ids)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()}
    assert got == components_of(pairs, ids)


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 300)]
    edges += [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(120)]
    edges = [(a, b) for a, b in edges if a != b]
    frame = spark.createDataFrame(edges, "a long, b long")
    nodes = {n for e in edges for n in e}
    got = {r["node"]: r["component"] for r in graph.components(frame, "test").collect()}
    assert got == components_of(edges, nodes)
    none = spark.createDataFrame([], "a long, b long")
    assert graph.components(none, "test").collect() == []


def plain_simhash(words, hashes):
    """Majority bits of the first words by length class and hash, from hashes of the words."""
    ranked = sorted({(max(7 - len(w), 0) << 60) | (hashes[w] >> 4) for w in words})[:31]
    return sum((2 * sum(r >> bit & 1 for r in ranked) > len(ranked)) << bit for bit in range(60))


def test_simhash_counts_bits(spark):
    rng = random.Random(9)
    vocabulary = pool(rng, 300)
    lines = [[rng.choice(vocabulary) for _ in range(n)] for n in (1, 2, 3, 10, 30, 31, 32, 128, 700)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(lines)], "doc_id long, text string")
    hashed = spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.xxhash64("w"))
    hashes = {r[0]: r[1] & (2**64 - 1) for r in hashed.collect()}
    got = {r["doc_id"]: r["simhash"] for r in line_dedup.lines_of(docs).collect()}
    assert got == {i: plain_simhash(w, hashes) for i, w in enumerate(lines)}


def test_block_keys_meet_within_one_bit(spark):
    rng = random.Random(13)
    rows = []
    for i in range(200):
        x = rng.getrandbits(60)
        rows.append((i, x, x ^ (1 << rng.randrange(60)) if i % 2 else x))
    frame = spark.createDataFrame(rows, "i long, x long, y long")
    keys = lambda c: F.array(*line_dedup.block_keys(F.col(c), F.lit(7)))
    met = frame.select(F.arrays_overlap(keys("x"), keys("y")).alias("m")).collect()
    assert all(r["m"] for r in met)


def test_marks_miss_no_document(spark):
    rng = random.Random(14)
    keys = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)]
    wanted = spark.createDataFrame([(k,) for k in keys[:1000]], "doc long")
    docs = spark.createDataFrame([(k,) for k in keys], "_doc long")
    marked = line_dedup.with_mark(docs, line_dedup.marks(wanted)).where("_marked").collect()
    found = {r["_doc"] for r in marked}
    assert set(keys[:1000]) <= found and len(found) < 1010


def test_lines(spark):
    rng = random.Random(10)
    vocabulary = pool(rng)
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared, long = line(12), line(120)
    near = long.split()
    near[60] = "changed"
    rows = [
        (1, "\n".join([shared, line(20), "", "too short"])),
        (2, "\n".join([line(9), shared.upper() + "!!", "", "too short"])),
        (3, "\n".join([long, line(15), long])),
        (4, "\n".join([" ".join(near), line(30)])),
        (5, shared),
        (6, "only two"),
        (None, shared + "\n" + line(14)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in line_dedup.drop_duplicate_lines(docs).collect()}
    text = dict(rows)
    assert out[1]["text"] == text[1] and out[1]["n_lines_dropped"] == 0
    assert out[2]["text"].split("\n") == [text[2].split("\n")[0], ""]
    assert out[3]["text"].split("\n") == text[3].split("\n")[:2]
    assert out[4]["text"] == text[4].split("\n")[1]
    assert 5 not in out and out[6]["text"] == "only two"
    assert out[None]["text"] == text[None].split("\n")[1]


def edit_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def alike(a, b):
    """The operator's definition: enough of the longer line agrees."""
    longer = max(len(a), len(b))
    return edit_distance(a, b) <= int(longer * (1 - line_dedup.SIMILARITY))


def recall_of_pairs(spark, lines):
    """The share of the pairs (2 k, 2 k + 1) that are alike which are candidates, and their number."""
    docs = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "doc_id long, text string")
    found = line_dedup.lines_of(docs)
    node = {r["doc_id"]: r["node"] for r in found.select("doc_id", "node").collect()}
    got = {frozenset(r) for r in line_dedup.candidates(line_dedup.nodes_of(found)).collect()}
    near = [
        frozenset((node[i], node[i + 1]))
        for i in range(0, len(lines), 2)
        if alike(lines[i], lines[i + 1])
    ]
    return sum(pair in got for pair in near) / len(near), len(near)


@pytest.mark.parametrize(("length", "changed"), [(8, 1), (10, 2), (20, 3), (26, 4), (50, 8), (100, 15)])
def test_lines_meet_at_the_similarity_asked_for(spark, length, changed):
    """Pairs of 0.8 to 0.9 edit similarity, over all that Levenshtein puts at 0.8 or more."""
    rng = random.Random(length)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    lines = []
    for _ in range(120):
        line = [rng.choice(vocabulary) for _ in range(length)]
        other = list(line)
        for i in rng.sample(range(length), changed):
            other[i] = rng.choice(vocabulary)
        lines += [" ".join(line), " ".join(other)]
    share, pairs = recall_of_pairs(spark, lines)
    assert pairs >= 20 and share >= 0.9


def test_large_buckets_hide_no_line(spark):
    """Lines of one template share most words; pairs of them differ in one word."""
    rng = random.Random(9)
    vocabulary, lines = pool(rng), []
    shared = [rng.choice(vocabulary) for _ in range(48)]
    for _ in range(1000):
        line = shared + [rng.choice(vocabulary) for _ in range(12)]
        other = list(line)
        other[rng.randrange(60)] = rng.choice(vocabulary)
        lines += [" ".join(line), " ".join(other)]
    assert recall_of_pairs(spark, lines)[0] >= 0.9


def test_large_buckets_lose_no_link(spark):
    """Lines of one template; pairs of them differ in six words, so few share a word of every finer bucket."""
    rng = random.Random(10)
    vocabulary, lines = pool(rng), []
    shared = [rng.choice(vocabulary) for _ in range(30)]
    for _ in range(150):
        line = shared + [rng.choice(vocabulary) for _ in range(14)]
        other = list(line)
        for i in rng.sample(range(44), 6):
            other[i] = rng.choice(vocabulary)
        lines += [" ".join(line), " ".join(other)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    nodes = line_dedup.nodes_of(line_dedup.lines_of(docs))
    facts = {r["first"]["doc_id"]: r for r in nodes.collect()}
    pairs = [
        (i, i + 1)
        for i in range(0, len(lines), 2)
        if alike(lines[i], lines[i + 1])
        and (facts[i]["simhash"] ^ facts[i + 1]["simhash"]).bit_count() <= line_dedup.BITS_APART
        and len(set(facts[i]["sketch"][: line_dedup.FIRST]) & set(facts[i + 1]["sketch"][: line_dedup.FIRST])) > 1
    ]
    assert len(pairs) > 30
    kept = {r["doc_id"] for r in line_dedup.drop_duplicate_lines(docs).collect()}
    assert not [p for p in pairs if kept >= set(p)]


def test_numbers_and_short_lines(spark):
    rows = [
        (1, "total revenue for the year 2019: 4512\nab\n12 34 56\n---"),
        (2, "total revenue for the year 2020: 987"),
        (3, "Total revenue for the year 2020: 987.\nab\n12 34 57\n---"),
        (4, "ab\n12  34 56"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in line_dedup.drop_duplicate_lines(docs).collect()}
    assert out == {1: rows[0][1], 2: rows[1][1], 3: "12 34 57\n---"}


def test_lines_against_all_pairs(spark):
    """Each group of brute force, by edit distance over all pairs, leaves its first line only."""
    rng = random.Random(21)
    vocabulary = pool(rng)
    texts, base = [], [[rng.choice(vocabulary) for _ in range(rng.randint(5, 30))] for _ in range(25)]
    for _ in range(60):
        lines = []
        for _ in range(3):
            line = list(rng.choice(base))
            for i in rng.sample(range(len(line)), rng.randint(0, len(line) // 5)):
                line[i] = rng.choice(vocabulary)
            lines.append(" ".join(line) + rng.choice(["", ".", "!"]))
        texts.append("\n".join(lines))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    places = [(d, i) for d, t in enumerate(texts) for i in range(3)]
    norm = {(d, i): texts[d].split("\n")[i].strip(".!") for d, i in places}
    pairs = [
        (p, q) for n, p in enumerate(places) for q in places[n + 1 :]
        if abs(len(norm[p]) - len(norm[q])) <= 0.2 * max(len(norm[p]), len(norm[q])) and alike(norm[p], norm[q])
    ]
    group = components_of(pairs, places)
    want = {d: [texts[d].split("\n")[i] for i in range(3) if group[d, i] == (d, i)] for d in range(60)}
    got = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.drop_duplicate_lines(docs).collect()}
    assert all(set(want[d]) <= set(got.get(d, [])) for d in want)  # nothing goes that brute force keeps
    gone = len(places) - sum(map(len, want.values()))
    assert len(places) - sum(map(len, got.values())) >= 0.98 * gone


def plain_shingles(text):
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_matches(docs, items):
    own = {d: plain_shingles(t) for d, t in docs.items()}
    found = {}
    for k, text in items.items():
        want = plain_shingles(text)
        for d, have in own.items():
            if want and len(want & have) >= 0.8 * len(want):
                found[d, k] = len(want & have) / len(want)
    return found


def test_decontamination_equals_all_pairs(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    items = {r["item_id"]: r["text"] for r in table(spark, sf_dir, "benchmark").collect()}
    got = queries.op10_decontamination(spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]): r["containment"] for r in got} == plain_matches(docs, items)


def test_parts_of_items_are_found(spark):
    rng = random.Random(13)
    vocabulary = pool(rng)
    items = {k: " ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 300))) for k in range(60)}
    docs = {}
    for k, text in items.items():
        words = text.split()
        part = words[: int(len(words) * rng.choice([0.7, 0.85, 0.95, 1]))]
        around = [rng.choice(vocabulary) for _ in range(rng.randint(0, 3000))]
        at = rng.randint(0, len(around))
        docs[k] = " ".join(around[:at] + part + around[at:])
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = decontaminate.find_items(spark, frame, bench).collect()
    want = plain_matches(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in got} == set(want)
    kept = {r["doc_id"] for r in decontaminate.remove_contaminated(spark, frame, bench).collect()}
    assert kept == set(docs) - {d for d, _ in want}


def test_blocks_hold_all_items(spark, monkeypatch):
    items = spark.createDataFrame([(i, f"item {i} has its own words here") for i in range(50)], "item_id long, text string")
    ids = [k for block in decontaminate.blocks(items, 20) for k in block.ids]
    assert len(list(decontaminate.blocks(items, 20))) > 5 and sorted(ids) == list(range(50))


def test_word_hashes_follow_words():
    texts = ["A b-c ünï 12", "", "...", "a", "B C a"]
    found = {}
    for h in shingles.word_hashes(texts, 5):
        for k in range(len(h)):
            words = "".join(c if c.isalnum() else " " for c in texts[h.first + k].lower()).split()
            assert len(words) == len(h.of(k))
            for w, v in zip(words, h.of(k).tolist(), strict=True):
                assert found.setdefault(w, v) == v
    assert len(set(found.values())) == len(found)


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in table(spark, sf, "documents").collect()}
    got = queries.op2_language(spark, sf).collect()
    held = [r for r in got if r["held_out"]]
    right = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_subwords_of_a_text_don_t_depend_on_its_neighbours():
    alone = [np.sort(language.subwords([t])[0]) for t in ("abc déf", "", "x")]
    ids, offsets, has = language.subwords(["abc déf", "", "x"])
    for k, want in enumerate(alone):
        assert (np.sort(ids[offsets[k] : offsets[k + 1]]) == want).all()
    assert has.tolist() == [True, False, True]


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf, "labels").collect()}
    got = queries.op3_toxicity(spark, sf).collect()
    held = [(r["predicted"], labels[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in labels]
    hit = sum(p and t for p, t in held)
    # 86 of 97 were found when this was written: few toxic rows in four languages to learn from
    assert hit >= 0.85 * sum(t for _, t in held)
    assert hit >= 0.9 * sum(p for p, _ in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)


def test_label_model_finds_rates():
    rng = np.random.default_rng(5)
    n, rates1, rates0 = 200_000, np.zeros(toxicity.VOTERS), np.zeros(toxicity.VOTERS)
    rates1[:8], rates0[:8] = rng.uniform(0.3, 0.8, 8), rng.uniform(0.0, 0.1, 8)
    y = rng.random(n) < 0.1
    votes = rng.random((n, toxicity.VOTERS)) < np.where(y[:, None], rates1, rates0)
    votes[:, 8] = votes[:, 0] ^ (rng.random(n) < 0.01)  # a copy of the first voter
    both = votes.T.astype(float) @ votes
    model = toxicity.fit_label_model(n, both, 0.1, np.full(toxicity.VOTERS, 0.3))
    assert np.abs(model.in_toxic[1:8] - rates1[1:8]).max() < 0.1
    assert np.abs(model.in_clean[1:8] - rates0[1:8]).max() < 0.02
    assert model.correlation[0, 8] > 0.5 and model.weight[8] < 0.75


def plain_line(line):
    """The normal form: lower-case words of letters, marks and digits."""
    return " ".join(regex.findall(r"[\p{L}\p{M}\p{N}]+", line.lower()))


def test_pipeline_against_its_stages(spark, sf_dir):
    """Each stage's decisions, from its own input, and the ids that reach the end."""
    docs = table(spark, sf_dir, "documents")
    items = {r["item_id"]: r["text"] for r in table(spark, sf_dir, "benchmark").collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality rules":
            assert after == {k: t for k, t in rows.items() if quality.judge((t or "").encode(), packer)[-1]}
        elif name == "line dedup":
            assert set(after) <= set(rows)
            first = {}
            for k in sorted(rows):
                for line in rows[k].split("\n"):
                    first.setdefault(plain_line(line), k)
            for k, t in rows.items():
                left = after.get(k, "").split("\n")
                lines = iter(t.split("\n"))
                assert k not in after or all(line in lines for line in left)
                # an equal line stays once at most, where it stands first
                assert all(first[plain_line(x)] == k for x in left if plain_line(x))
        elif name == "near-duplicates":
            ids = sorted(rows)
            seq = {k: near_dedup.sequence(rows[k]) for k in ids}
            pairs = [
                (a, b)
                for i, a in enumerate(ids)
                for b in ids[i + 1 :]
                if len(seq[a]) and len(seq[b]) and near_dedup.alignment(seq[a], seq[b]) >= 0.8
            ]
            assert set(after) == set(components_of(pairs, ids).values())
        else:
            bad = {d for d, _ in plain_matches(rows, items)}
            assert set(after) == set(rows) - bad
        rows = after
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == set(rows)
