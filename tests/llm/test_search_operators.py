"""Suffix dedup, Jaccard join, decontamination: against plain versions, also on hard rows."""

import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pandas as pd
import pytest
from hard_rows import SF_DIR, empty, hard  # noqa: F401

from occrisk.llm import components, op5_suffix, op7_jaccard, op10_decontamination


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_suffixes(spark, documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in op5_suffix.query(spark, SF_DIR).collect()}
    want = {d: (n, gone, runs, brute.sha(kept)) for d, (n, gone, runs, kept) in zip(documents, brute.suffixes(list(documents.values())))}
    assert got == want and sum(w[1] for w in want.values()) > 0


def _prose(rng, n):
    return "".join(rng.choice("abcdefgh é") for _ in range(n))


def _passages(seed):
    """Texts that share passages around the length that counts, within and across texts, periodic ones too."""
    rng = random.Random(seed)
    shared = [_prose(rng, n) for n in (398, 399, 400, 401, 430, 700)]
    texts = [_prose(rng, rng.randrange(50)) + rng.choice(shared) + _prose(rng, rng.randrange(900)) + rng.choice(shared)[rng.randrange(60) :] for _ in range(40)]
    edited = []
    for t in texts[:15]:
        letters = list(t)
        for _ in range(3):
            letters[rng.randrange(len(letters))] = "#"
        edited.append("".join(letters))
    return texts + edited + ["ab" * 400, "x" * 450, "x" * 399, "", texts[0], texts[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_suffixes_of_edited_passages(spark, seed):
    texts = _passages(seed)
    got = {r["doc_id"]: tuple(r)[1:] for r in op5_suffix.summary(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert got == {d: (n, gone, runs, brute.sha(kept)) for d, (n, gone, runs, kept) in enumerate(brute.suffixes(texts))}


def test_suffixes_hard(hard, empty):
    rows = hard.collect()
    want = Counter((r["doc_id"], n, gone, runs, brute.sha(kept)) for r, (n, gone, runs, kept) in zip(rows, brute.suffixes([r["text"] for r in rows])))
    assert Counter(map(tuple, op5_suffix.summary(hard).collect())) == want
    out = op5_suffix.deduplicated(hard)
    assert out.schema == hard.schema and out.count() == len(rows)
    assert op5_suffix.summary(empty).collect() == []
    assert op5_suffix.deduplicated(empty).collect() == []


def test_family_levels_merge_geometrically(spark):
    family = op5_suffix.Family()
    sizes = []
    for n in range(4):
        family.add(spark.createDataFrame([(10 * n + k,) for k in range(3)] + [(7,)], "key bigint"))
        sizes.append([size for size, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4]]
    assert [r["key"] for r in family.repeated().collect()] == [7]


def test_jaccard(spark, documents):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in op7_jaccard.query(spark, SF_DIR).collect()}
    assert got == brute.jaccard(documents)


def test_jaccard_of_large_groups(spark, monkeypatch):
    """A group of near copies and a group of copies, both cut into blocks."""
    monkeypatch.setattr(op7_jaccard, "BLOCK", 16)
    rng = random.Random(4)
    stem = [f"v{rng.randrange(10**6)}" for _ in range(300)]
    texts = {}
    for d in range(90):
        words = list(stem)
        for _ in range(rng.randrange(9)):
            words[rng.randrange(300)] = f"n{rng.randrange(10**6)}"
        texts[d] = " ".join(words)
    texts |= {100 + d: " \n".join(stem[:40]) for d in range(50)}
    texts |= {200 + d: " ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) + " common line that everyone has at the end" for d in range(60)}
    rows = op7_jaccard.classes(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"))
    got = {r["_row"]["doc_id"]: (r["class_id"], r["n_links"]) for r in rows.collect()}
    assert got == brute.jaccard(texts)


def test_jaccard_hard(hard, empty):
    got = op7_jaccard.classes(hard).select("_row.doc_id", "_row.text", "class_id", "class_size", "n_links").collect()
    assert len(got) == hard.count()
    by = {(r["doc_id"], r["text"]): r for r in got}
    assert by[(1, None)]["class_id"] == 1 and by[(2, "")]["n_links"] == 0
    assert {by[k]["class_id"] for k in by if k[0] in (7, 8)} == {7}
    assert next(r for r in got if r["doc_id"] == 5)["n_links"] == 1
    kept = op7_jaccard.deduplicated(hard)
    assert kept.schema == hard.schema
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([1, 2, 3, 4, 5, None, None, 7, 9, 10, 11, 12])
    assert op7_jaccard.classes(empty).collect() == [] and op7_jaccard.deduplicated(empty).collect() == []


def test_pruning_keeps_pairs_at_the_threshold():
    least = op7_jaccard.least_matches()
    rng = np.random.default_rng(5)
    kept = 0
    for _ in range(400):
        same = rng.random(op7_jaccard.BANDS * op7_jaccard.ROWS) < 0.8
        matched = np.concatenate([[0], np.cumsum(same.reshape(-1, op7_jaccard.STEP).sum(axis=1))])
        kept += (matched >= least).all()
    assert kept >= 396
    assert least[-1] > 0.55 * op7_jaccard.BANDS * op7_jaccard.ROWS


def test_components(spark):
    rng = random.Random(6)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for n in got} and len(got) >= len({n for a, b in edges if a != b for n in (a, b)})


def test_leaks(spark, documents):
    """Every document against every item: the least edit distance of any window."""
    items = {r["item_id"]: op10_decontamination.normal(r["text"]).decode() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    word = re.compile(r"[0-9a-z\x80-\U0010ffff]+")
    items = {i: word.findall(t) for i, t in items.items()}
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in op10_decontamination.query(spark, SF_DIR).collect()}
    want = {}
    for d, t in documents.items():
        words = word.findall(op10_decontamination.normal(t).decode())
        held = Counter(words)
        for i, item in items.items():
            k = op10_decontamination.edits(len(item))
            if sum((Counter(item) & held).values()) < len(item) - k:
                continue
            ends = [
                brute.edit_distance(item, words[s : s + n])
                for s in range(len(words)) if words[s] in set(item) and len(set(item) & set(words[s : s + len(item) + k])) * 2 > len(set(item))
                for n in range(len(item) - k, len(item) + k + 1)
            ]
            if ends and min(ends) <= k:
                want[(d, i)] = min(ends)
    assert got == want and want


def test_leak_recall_at_the_limit(spark):
    """Items with as many random edits as are allowed, in other words of the benchmark."""
    rng = random.Random(8)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    index = op10_decontamination.Index(list(range(len(texts))), [op10_decontamination.normal(t) for t in texts])
    vocabulary = [w for t in texts for w in t.lower().split()]
    queries = []
    for n, text in enumerate(texts):
        for _ in range(5):
            words = re.findall(r"\w+", text.lower())
            for _ in range(op10_decontamination.edits(len(words))):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = [f"z{rng.randrange(10**6)}"] * rng.randrange(2)
            queries.append((n, " ".join([*rng.choices(vocabulary, k=50), *words, *rng.choices(vocabulary, k=50)]).encode()))
    found = {(q, item) for q, item, *_ in index.search([t for _, t in queries])}
    assert np.mean([(q, n) in found for q, (n, _) in enumerate(queries)]) >= 0.97


def test_leaks_hard(spark, hard, empty, monkeypatch):
    items = [(1, None), (2, ""), (3, "too few"), (4, "here stands an item of some words nobody else has"), (None, "a b c d e f g h i j"), (4, "here stands an item of some words nobody else has")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    extra = hard.limit(1).selectExpr("cast(50 as bigint) as doc_id", "'x y HERE stands; an item of strange words nobody else has z' as text", *[c for c in hard.columns if c not in ("doc_id", "text")])
    docs = hard.unionByName(extra)
    whole = op10_decontamination.leaks(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["edits"]) for r in whole} == {(50, 4, 1), (7, None, 0), (8, None, 0)}
    monkeypatch.setattr(op10_decontamination, "SLICE_WORDS", 8)
    assert Counter(map(tuple, op10_decontamination.leaks(docs, benchmark).collect())) == Counter(map(tuple, whole))
    kept = op10_decontamination.decontaminated(docs, benchmark)
    assert kept.schema == docs.schema
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in hard.collect() if r["doc_id"] not in (7, 8))
    assert op10_decontamination.leaks(empty, benchmark).collect() == []
    assert op10_decontamination.leaks(docs, benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("similarity", [0.8, 0.81, 0.82, 0.9])
def test_pruning_loses_no_more_than_the_bands(similarity):
    """Exact probability that a pair is dropped by some step, and that it is missed at all."""
    step, rows = op7_jaccard.STEP, op7_jaccard.ROWS
    agree = similarity + (1 - similarity) / 256
    one = [math.comb(step, n) * agree**n * (1 - agree) ** (step - n) for n in range(step + 1)]
    stay = np.ones(1)
    for least in op7_jaccard.least_matches()[1:]:
        stay = np.convolve(stay, one)
        stay[:least] = 0
    pruned, unbanded = 1 - stay.sum(), (1 - 0.8**rows) ** op7_jaccard.BANDS
    assert pruned <= unbanded and pruned + unbanded <= 4.0e-6


def test_buckets_prune_at_the_join_s_threshold():
    """A pair of similarity 0.5 stays a candidate where the threshold is 0.4."""
    sketch = np.zeros((2, op7_jaccard.BANDS * op7_jaccard.ROWS), np.uint8)
    sketch[1, ::2] = 1
    rows = pd.DataFrame({"bucket": [1, 1], "x": [0, 0], "y": [0, 0], "side": [0, 0], "node": [b"a", b"b"], "n": [50, 50], "sketch": [r.tobytes() for r in sketch]})
    for threshold, edges in ((0.4, 1), (0.8, 0)):
        assert sum(len(out) for out in op7_jaccard._bucket_edges(threshold)(iter([rows]))) == edges


@pytest.mark.parametrize("kind", ["cut", "replaced"])
@pytest.mark.parametrize("place", ["front", "middle", "end"])
@pytest.mark.parametrize("opening", [False, True])
def test_leak_recall_of_gathered_edits_amid_foreign_words(kind, place, opening):
    """All allowed edits in one place of the item; the words around it stand in no item, or the item opens the text."""
    rng = random.Random(3)
    items = [[f"v{rng.randrange(4000)}" for _ in range(size)] for size in (15, 30, 50) for _ in range(20)]
    index = op10_decontamination.Index(list(range(len(items))), [" ".join(i).encode() for i in items])
    texts = []
    for item in items:
        k = op10_decontamination.edits(len(item))
        at = {"front": 0, "middle": (len(item) - k) // 2, "end": len(item) - k}[place]
        new = [f"z{rng.randrange(10**6)}" for _ in range(k if kind == "replaced" else 0)]
        foreign = [f"y{rng.randrange(10**6)}" for _ in range(40)]
        texts.append(" ".join([*([] if opening else foreign), *item[:at], *new, *item[at + k :], *foreign]).encode())
    found = {q: (item, first, length, edits) for q, item, first, length, edits in index.search(texts) if q == item}
    assert len(found) >= 0.97 * len(items)
    for q, (item, first, length, edits) in found.items():
        window = texts[q].decode().split()[first : first + length]
        assert window[0] in items[item] and brute.edit_distance(items[item], window) == edits
