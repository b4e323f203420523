"""Token counts, hard negatives and the Merkle manifest against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hard_rows import HARD, SF_DIR, empty, hard  # noqa: F401

from occrisk.llm import op11_counts, op12_negatives, op13_merkle

BIG = 2**53


# ---------------------------------------------------------------- token counts


@pytest.fixture(scope="module")
def library():
    return op11_counts.Speller(op11_counts.vocabulary_path()).library


def _lengths(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def _counted(df):
    return Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect())


def test_counts_of_all_documents(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    want = Counter((d["doc_id"], len((d["text"] or "").encode()), n, n > 1024) for d, n in zip(docs, _lengths(library, [d["text"] for d in docs])))
    assert _counted(op11_counts.query(spark, SF_DIR)) == want


SIGNS = ["a", "B", "é", "漢", " ", "  ", "\n", "\t", "\x85", "\xa0", "'s", "'", "12", "!", "<|endoftext|>", "<|endof", "text|>", "\x1c", "😀", chr(0x200B), chr(0x3000), chr(0x301), chr(0x180E)]


def test_units_spell_like_whole_texts(library):
    own, pick = op11_counts.Speller(op11_counts.vocabulary_path()), random.Random(3)
    texts = ["".join(pick.choices(SIGNS, k=pick.randrange(60))) for _ in range(2000)]
    assert own.counts(texts) == _lengths(library, texts)


def test_counts_of_spliced_texts(spark, library):
    """Cuts fall into words, characters, special strings, white space and pieces longer than overlaps."""
    pick = random.Random(5)
    texts = ["".join(pick.choices(SIGNS, k=pick.randrange(20, 900))) for _ in range(150)]
    texts += ["x" * 900, "漢" * 700, " " * 800, "\n" * 500 + "a", "a" * 300 + " b" * 200 + "9" * 500, "<|endoftext|>" * 60, ("z" * 150 + " ") * 6, "<|endoftext|" * 50, "word " * 400]
    texts += [texts[0], None, ""]
    rows = [(n if n % 5 else (None if n % 2 else BIG + 1 + n), t) for n, t in enumerate(texts)] + [(1, texts[1])]
    got = op11_counts.token_counts(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3), chunk=160, overlap=32, limit=100)
    want = Counter((i, len((t or "").encode()), n, n > 100) for (i, t), n in zip(rows, _lengths(library, [t for _, t in rows])))
    assert _counted(got) == want


def test_counts_of_hard_rows(hard, empty, library):  # noqa: F811
    want = Counter((i, len((t or "").encode()), n, n > 1024) for (i, t), n in zip(HARD, _lengths(library, [t for _, t in HARD])))
    assert _counted(op11_counts.token_counts(hard)) == want
    assert op11_counts.token_counts(empty).collect() == []


def test_short_chunks_are_refused(empty):  # noqa: F811
    with pytest.raises(ValueError, match="overlaps"):
        op11_counts.token_counts(empty, chunk=100, overlap=50)


# ---------------------------------------------------------------- hard negatives


def _mined(rows):
    """Plain version over (vec_id, embedding, label)."""
    kept = []
    for n, (i, v, y) in enumerate(rows):
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        if sum(x * x for x in whole) < 2**62:
            kept.append((n, i, (y + 1) % 10 if i % 7 == 0 else y, whole))
    out = []
    for n, i, y, v in kept:
        if i % 50:
            continue
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for m, j, z, w in kept if m != n)
        for s, j, _ in [x for x in scores if x[2] == y][:5]:
            near = [(-t, k) for t, k, z in scores if z != y and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(i, j, r, k, -s, t) for r, (t, k) in enumerate(near, 1)]
    return Counter(out)


def _triples(df):
    return Counter((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank int"


def test_negatives_of_all_vectors(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert _triples(op12_negatives.query(spark, SF_DIR)) == _mined(rows)


def test_negatives_of_hard_rows(spark):
    """Ties, clusters, zero vectors, repeated rows, odd lengths, NULLs, large components and ids."""
    pick = np.random.default_rng(1)
    centres = pick.normal(size=(4, 6))
    rows = [(int(k * 5 + BIG + 8 if k % 9 == 0 else k * 5), (centres[k % 4] + 0.1 * pick.normal(size=6)).tolist(), int(k % 3)) for k in range(150)]
    rows += [(50, [0.0] * 6, 1), (100, rows[3][1], 2), (100, rows[3][1], 2), (200, [], 0), (250, [1.0, 2.0], 0), (300, [1.0] * 9, 1), (301, [1.0] * 9, 1), (302, [0.6] * 9, 2)]
    rows += [(350, None, 1), (400, [1.0, None], 1), (450, [float("nan")], 1), (500, [float("inf")], 1), (None, [1.0], 1), (550, [1.0], None), (600, [1e30], 1)]
    rows += [(700, [3e6] * 6, 1), (701, [2.9e6] * 6, 1), (702, [2.0e6] * 6, 2), (50000, [1e6] * 6, 2), (50001, [1e6] * 6, 2)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA).repartition(3)
    got = op12_negatives.hard_negatives(df, row_block=40, anchor_block=7, references=3)
    want = _mined(rows)
    assert len(want) > 100
    assert _triples(got) == want
    assert op12_negatives.hard_negatives(df.where("false")).collect() == []


def test_bounds_hold_every_score():
    pick = np.random.default_rng(2)
    v = np.concatenate([pick.integers(-300, 300, (300, 16)), np.zeros((2, 16), int), pick.integers(-2, 3, (50, 16))])
    v = np.concatenate([v, v[:20], -v[:20], 3 * v[:20]])
    norms = np.sqrt((v.astype(float) ** 2).sum(axis=1))
    directions = v[[0, 5, 310]] / norms[[0, 5, 310], None]
    block = op12_negatives.Block.__new__(op12_negatives.Block)
    block.n, block.norms, block.v = len(v), norms, v
    block.angles = op12_negatives._angles(v, norms, directions)
    exact = v @ v.T
    for n in range(len(v)):
        low, high = op12_negatives.bounds(block, n, block)
        assert (low <= exact[n]).all() and (exact[n] <= high).all()
    low, high = op12_negatives.bounds(block, 0, block)  # a reference itself: its interval is a point
    assert (high - low <= 2 + 1e-4 * norms[0] * norms).all()


# ---------------------------------------------------------------- manifest


def _sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def _manifest(rows):
    """Plain version over (doc_id, source, lang, n_chars, text)."""

    def field(x):
        return "-" if x is None else f"{len(str(x).encode())}:{x}"

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([_sha("".join(out[-1][k : k + 2])) for k in range(0, len(out[-1]), 2)])
        return out

    def path(tree, at):
        steps = []
        for level in tree[:-1]:
            steps.append((at % 2, level[at ^ 1] if at ^ 1 < len(level) else None))
            at //= 2
        return steps

    groups = {}
    for r in rows:
        leaf = _sha("".join(map(field, r)))
        i, source, lang, n, text = r
        bad = i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0
        groups.setdefault(lang, []).append((i is not None, i or 0, leaf, _sha("".join(map(field, (i, source, lang, n + 1, text)))) if bad else leaf, i))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: levels([x[2] for x in sorted(groups[lang])]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for at, (_, _, leaf, value, i) in enumerate(sorted(groups[lang])):
            steps = path(trees[lang], at) + path(top, n)
            for right, sibling in steps:
                value = _sha(value) if sibling is None else _sha(sibling + value if right else value + sibling)
            out.append((i, leaf, trees[lang][-1][0], top[-1][0], _sha("".join(s for _, s in steps if s)), value, value == top[-1][0]))
    return Counter(out)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PROVEN = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def _proven(df):
    return Counter(map(tuple, df.select(*PROVEN).collect()))


def test_manifest_of_all_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select(*FIELDS).collect()]
    got = _proven(op13_merkle.query(spark, SF_DIR))
    assert got == _manifest(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("levels", [1, 2, 5])
def test_manifest_over_many_sweeps(spark, levels):
    langs = ["en"] * 3 + [None, "é", "z", "", "zz"]
    rows = [(None if k % 31 == 0 else BIG + k if k % 3 else k // 2, "s" if k % 4 else None, langs[k % 8], None if k % 6 == 0 else 2**63 - 1 if k % 5 == 0 else k, None if k % 7 == 0 else "ü" * (k % 9)) for k in range(230)]
    rows += [(5, "a", "alone", 1, "x"), *[(9, "same", "en", 7, "row")] * 40]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, tree string, at int").repartition(5)
    assert _proven(op13_merkle.manifest(df, levels)) == _manifest(rows)


@pytest.mark.parametrize("count", [1, 2, 3])
def test_manifest_of_few_rows(spark, count):
    rows = [(k, "s", "en", 3, "abc") for k in range(count)]
    assert _proven(op13_merkle.manifest(spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string"))) == _manifest(rows)


def test_manifest_of_hard_rows(hard, empty):  # noqa: F811
    """Columns that the input lacks count as NULL."""
    assert _proven(op13_merkle.manifest(hard)) == _manifest([(i, None, None, None, t) for i, t in HARD])
    assert op13_merkle.manifest(empty).collect() == []
