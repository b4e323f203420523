"""License scan, quality rules, scores, shards: whole small tables against plain versions."""

import math
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hard_rows import SF_DIR, empty, hard  # noqa: F401

from occrisk.llm import attention, op1_license, op2_lm, op3_quality, op4_tokens


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_licenses(spark, documents):
    got = {r["doc_id"]: tuple(r)[1:8] for r in op1_license.query(spark, SF_DIR).collect()}
    assert got == {d: brute.licence(t, op1_license.PHRASES, op1_license.TEMPLATES, op1_license.THRESHOLD) for d, t in documents.items()}


def test_licenses_hard(hard, empty):
    got = op1_license.scan(hard).select("_row.doc_id", "_row.text", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()
    assert len(got) == hard.count()
    for r in got:
        assert tuple(r)[2:] == brute.licence(r["text"], op1_license.PHRASES, op1_license.TEMPLATES, op1_license.THRESHOLD)
    assert op1_license.scan(empty).count() == 0


def test_license_threshold_is_inclusive(spark):
    templates = (("t", "alpha beta gamma delta"),)
    rows = [(1, "alpha beta gamma"), (2, "alpha beta"), (3, "DELTA x gamma y BETA"), (4, "alpha\nbeta gamma")]
    found = op1_license.matches(spark.createDataFrame(rows, "doc_id int, text string"), templates, 0.75)
    assert sorted((r["containment"], r["blocks"]) for r in found.collect()) == [(0.75, 1)] * 3


def test_words_far_apart_are_no_notice(spark):
    """A block is bounded by its template, however long the line."""
    filler = "and so it went on by the shore " * 500
    bsd = "redistribution and use in source and binary forms with or without modification are permitted".split()
    rows = [
        (1, "The license of the harbor was released in May; under MIT rules " + filler),
        (2, filler.join(f" {w} " for w in bsd)),
        (3, filler + "Released, finally, under the MIT license. " + filler),
        (4, filler + " ".join(bsd[:-1]) + " " + filler + " ".join(bsd) + "\n" + " ".join(bsd)),
    ]
    got = {r["_row"]["doc_id"]: (r["labels"], r["n_blocks"]) for r in op1_license.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {1: ("", 0), 2: ("", 0), 3: ("mit", 1), 4: ("bsd", 3)}


def test_quality(spark, documents):
    got = {r["doc_id"]: tuple(r)[1:7] for r in op3_quality.query(spark, SF_DIR).collect()}
    assert got == {d: brute.quality(t) for d, t in documents.items()}


def test_quality_hard(hard, empty):
    got = op3_quality.judged(hard).select("_row.text", "_m", "base_failed", "kept").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for r in got:
        assert (*(r["_m"][n] for n in names), r["base_failed"]) == brute.quality(r["text"])
        assert not (r["base_failed"] and r["kept"])
    kept = op3_quality.filter_quality(hard)
    assert kept.schema == hard.schema
    assert kept.count() == sum(r["kept"] for r in got)
    assert op3_quality.filter_quality(empty).collect() == []


def test_quality_follows_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    got = [r for r in op3_quality.query(spark, SF_DIR).collect() if r["doc_id"] in labels and not r["base_failed"]]
    agree = sum(r["kept"] == (labels[r["doc_id"]] == 1) for r in got)
    assert agree >= 0.95 * len(got)


def test_scores(spark, documents):
    got = {r["doc_id"]: r for r in op2_lm.query(spark, SF_DIR).collect()}
    want = brute.unigrams(list(documents.items()), op2_lm.words)
    assert set(got) == set(want)
    for d, (held, n, known, total, base) in want.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_scores_hard(hard, empty):
    got = op2_lm.scores(hard).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(len(op2_lm.words(r["text"])) + 1 for r in hard.collect())
    assert op2_lm.scores(empty).collect() == []


def test_attention_is_a_distribution_and_causal():
    random = np.random.default_rng(1)
    weights = attention.initial(7)
    weights["bigram"] = random.standard_normal((7, 7)).astype(np.float32)
    x = random.integers(0, 7, (2, attention.WINDOW))
    z, norm = attention.forward(weights, x)
    assert np.allclose(np.exp(z - norm[:, :, None]).sum(axis=2), 1, atol=1e-4)
    later = x.copy()
    later[:, 20:] = 3
    z2, norm2 = attention.forward(weights, later)
    assert np.allclose((z - norm[:, :, None])[:, :20], (z2 - norm2[:, :, None])[:, :20], atol=1e-5)


def test_attention_gradients():
    random = np.random.default_rng(2)
    weights = {n: v.astype(np.float64) for n, v in attention.initial(5).items()}
    x, y = random.integers(0, 5, (3, attention.WINDOW)), random.integers(0, 5, (3, attention.WINDOW))
    use = random.random(x.shape) < 0.7
    g, loss = attention.gradients(weights, x, y, use)
    for name in attention.NAMES:
        at = tuple(0 for _ in weights[name].shape)
        moved = {n: v.copy() for n, v in weights.items()}
        moved[name][at] += 1e-4
        assert (attention.gradients(moved, x, y, use)[1] - loss) / 1e-4 == pytest.approx(g[name][at], rel=2e-2, abs=2e-4)


@pytest.mark.parametrize("count", [1, 31, 32, 33, 56, 57, 200])
def test_every_id_is_scored_once(count):
    classes = np.arange(count + 40)
    _, targets, use, text = attention.windows(classes, np.array([count, 40]))
    assert sorted(targets[use].tolist()) == list(range(count + 40))
    assert set(targets[text == 0][use[text == 0]].tolist()) == set(range(count))


def _ids(text, tokenizer):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, op4_tokens.END_ID]


def _checked(rows, got):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(op4_tokens.default_vocabulary())
    start, want = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = _ids(text, tokenizer)
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_shards(spark, documents):
    _checked(list(documents.items()), op4_tokens.query(spark, SF_DIR).collect())


def test_shards_hard(spark, hard, empty, tmp_path):
    for name, rows in (("hard", hard), ("empty", empty)):
        op4_tokens.write_shards(rows, str(tmp_path / name), shard_ids=500)
        _checked([(r["doc_id"], r["text"]) for r in rows.collect()], op4_tokens.read_documents(spark, str(tmp_path / name)).collect())


def test_shard_random_access():
    random = np.random.default_rng(3)
    docs = [np.append(random.integers(2, 30, n) % 9 + 2, 1).astype(np.uint32) for n in (0, 1, 4000, 20_000, 7)]
    blob = op4_tokens.pack([5, None, 7, 8, 9], docs)
    assert len(blob) < 0.75 * 4 * sum(map(len, docs))
    shard = op4_tokens.ShardReader(blob)
    whole = np.concatenate(docs)
    assert shard.doc_ids == [5, None, 7, 8, 9] and len(shard.rules) > 0
    assert all((shard.document(n) == d).all() for n, d in enumerate(docs))
    for a, b in [(0, 0), (0, 1), (3, 4), (100, 9000), (24_000, whole.size)]:
        assert (shard.ids(a, b) == whole[a:b]).all()
    with pytest.raises(ValueError):
        op4_tokens.ShardReader(blob[:-1] + b"\x00" + blob[-1:])


def test_licenses_count_blocks_of_equal_texts_once(spark):
    text = "All rights reserved.\nReleased under the MIT License."
    rows = op1_license.scan(spark.createDataFrame([(1, text), (2, text), (3, text + "\n" + text)], "doc_id bigint, text string"))
    assert {r["_row"]["doc_id"]: r["n_blocks"] for r in rows.collect()} == {1: 2, 2: 2, 3: 4}


def test_attention_learns_from_every_training_text(spark):
    """Texts that a sample of one in 16 by hash would leave out teach the order of their words."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(n, "red blue " * 9000) for n in range(40)], "doc_id bigint, text string")
    rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(16)) != 0).limit(6)
    got = op2_lm.scores(rows).collect()
    assert len(got) == 6 and all(r["score"] / r["n_tokens"] > -0.2 for r in got)  # -0.3 without the order


def test_training_passes_once_over_all_batches(monkeypatch):
    """Windows seen are those of all texts, whatever a task holds at a time."""
    import pyarrow as pa

    class Shared:
        def __init__(self, value):
            self.value = value

    texts = [" ".join(f"w{n % 7}" for n in range(size)) for size in (0, 5, 40, 300, 1000)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[a : a + 2])], names=["text"]) for a in (0, 2, 4)]
    classes = np.full(op2_lm.IDS + 1, op2_lm.END_CLASS)
    want = len(attention.windows(np.zeros(sum(len(t.split()) + 1 for t in texts), int), np.array([len(t.split()) + 1 for t in texts]))[0])
    for size in (16, 1 << 17):
        monkeypatch.setattr(op2_lm, "BUFFER", size)
        (out,) = op2_lm._train(None, Shared(classes), Shared(attention.initial(op2_lm.CLASSES)))(iter(batches))
        assert set(out.column(2).to_pylist()) == {float(want)}


def test_wrapped_notices(spark):
    """A notice broken over lines is labelled, and is one block; a notice on one line stays one block among others."""
    gpl = "This work is licensed under the GNU General Public License, version 3"
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted"
    prose = "Some line that stands before or after the notice and says nothing of it."
    rows = [
        (1, f"{prose}\n" + gpl.replace("General ", "General\n") + f".\n{prose}"),
        (2, f"{prose}\n# " + bsd.replace("without ", "without\r\n# ") + f".\n{prose}"),
        (3, gpl.replace(" ", "\n")),
        (4, f"{prose}\n{gpl}\n{prose}\n{prose}"),
        (5, "all rights\n" + f"{prose}\n" * 9 + "reserved"),
        (6, "licensed under the\napache license,\nversion 2.0" + f"\n{prose}" * 9 + "\nReleased under\nthe MIT license"),
    ]
    got = {r["_row"]["doc_id"]: (r["labels"], r["score"], r["n_blocks"]) for r in op1_license.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {
        1: ("gpl,gpl-3.0", 1.0, 1), 2: ("bsd", 1.0, 1), 3: ("gpl,gpl-3.0", 1.0, 1),
        4: ("gpl,gpl-3.0", 1.0, 1), 5: ("", 0.0, 0), 6: ("apache-2.0,mit", 1.0, 2),
    }


def test_attention_reads_every_subword_id(spark):
    """Words that share their first id tell by a later one which word follows."""
    own = op4_tokens.encoder(op4_tokens.default_vocabulary())
    assert own[b"w0"][:4] == own[b"w3"][:4] and own[b"w0"] != own[b"w3"]
    random = np.random.default_rng(5)
    follows = {"w0": "red", "w3": "blue"}
    texts = [" ".join(f"{w} {follows[w]}" for w in random.choice(["w0", "w3"], 4000)) for _ in range(12)]
    got = op2_lm.scores(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)).collect()
    assert all(r["score"] / r["n_tokens"] > -0.25 for r in got)  # -0.30 if what follows were as open as the word before


def test_ids_have_a_distribution_and_its_gradients():
    """Class and forks give probabilities that add up to one over all ids; gradients are those of differences."""
    random = np.random.default_rng(4)
    classes = np.array([0, 1, 1, 1, 2, 2, 3, 1, 3])
    tree = attention.Tree(classes, random.integers(0, 50, 9).astype(float))
    weights = {n: v.astype(np.float64) + 0.3 * random.standard_normal(v.shape) for n, v in attention.initial(4, 9, tree).items()}
    ids = random.integers(0, 9, 20)
    # another text ends in the id that is read before every text
    each = [attention.log_probabilities(weights, np.concatenate([ids, [i], [8]]), np.array([21, 1]), tree)[20] for i in range(9)]
    assert np.exp(each).sum() == pytest.approx(1, abs=1e-5)
    x, y = random.integers(0, 9, (3, attention.WINDOW)), random.integers(0, 9, (3, attention.WINDOW))
    use = random.random(x.shape) < 0.7
    g, loss = attention.gradients(weights, x, y, use, tree)
    for name, value in weights.items():
        for at in (tuple(0 for _ in value.shape), tuple(n - 1 for n in value.shape)):
            moved = {n: v.copy() for n, v in weights.items()}
            moved[name][at] += 1e-4
            assert (attention.gradients(moved, x, y, use, tree)[1] - loss) / 1e-4 == pytest.approx(g[name][at], rel=2e-2, abs=2e-4)


def test_encoder_parts_words_as_the_library_does():
    """One entry for a word, however it is written and whatever stop follows; the library's ids for any text."""
    from tokenizers import Tokenizer

    path = op4_tokens.default_vocabulary()
    own = op4_tokens.WordEncoder(path)
    own.ids("Harbour harbour. HARBOUR, harbour... Müller, müller.")
    assert set(own.known) == {b"harbour", "müller".encode(), b".", b",", b"..."}
    tokenizer = Tokenizer.from_file(path)
    pieces = (
        "It's don't. 'tis, We'll. A.B. a.b, 3.14. x9., \"So.\" so.' ». à. Œuvre. œil, ÀÉß. ÷. ÿ., µ. ª, İx. ıx. J̌. İ, é. K. …. 漢字. "
        "<|endoftext|> <|ENDOFTEXT|>. <|EndOfText|> ., .. , \u0085x. \x1cy, \ny.\tz,\x0b q.\r\n É. é,É. á. ÷, -. ***, no,yes. Ⱥ. ſ."
    ).split(" ")
    random = np.random.default_rng(6)
    texts = [*pieces, *(" ".join(random.choice(pieces[:n], 9)) for n in (18, len(pieces)) for _ in range(300)), None, "", " . ", ","]
    for text in texts:
        assert own.ids(text).tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_large_batches_are_read_in_slices():
    """Spark hands over thousands of rows at once: what a task holds besides them does not follow their number."""
    sizes = np.array([0, 5, op2_lm.BUFFER, op2_lm.BUFFER + 1, 1, op2_lm.BUFFER - 1, 1, 3])
    assert list(op2_lm._slices(sizes)) == [(0, 2), (2, 3), (3, 4), (4, 6), (6, 8)]
    random = np.random.default_rng(8)
    rank = SimpleNamespace(value=random.permutation(op2_lm.IDS + 1))
    ids = [random.integers(0, op2_lm.IDS + 1, n).astype("<u2") for n in (3000, 1, 200_000, *[2000] * 3000)]
    batch = pa.RecordBatch.from_arrays([pa.array([i.tobytes() for i in ids], pa.binary())], names=["ids"])
    tracemalloc.start()
    (got,) = op2_lm._contexts(rank)(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6  # 72 MB if all were read at once
    place = rank.value[np.concatenate(ids)]
    want = np.zeros((op2_lm.CLUSTERED, op2_lm.SINGLES + 1))
    met = 1 + np.flatnonzero((place[1:] >= op2_lm.SINGLES) & (place[1:] < op2_lm.SINGLES + op2_lm.CLUSTERED))
    np.add.at(want, (place[met] - op2_lm.SINGLES, np.minimum(place[met - 1], op2_lm.SINGLES)), 1)
    found = np.zeros(want.size)
    found[got.column(0).to_numpy()] = got.column(1).to_numpy()
    assert np.array_equal(found, want.ravel())


def test_attention_works_on_places_in_use_only():
    """Places that are only looked back to are not queried; states, paths and sums of rows are those of plain loops."""
    random = np.random.default_rng(9)
    weights = {n: v.astype(np.float64) for n, v in attention.initial(6).items()}
    cut = attention.WINDOW - attention.STRIDE
    use = random.random((9, attention.WINDOW)) < 0.6
    use[:7, :cut], use[8, cut:] = False, False
    x = random.integers(0, 6, use.shape)
    h, used, (*_, blocks) = attention._attended(weights, x, use)
    assert sum(a.shape[0] * a.shape[1] for *_, a in blocks) == 8 * attention.STRIDE + 2 * cut
    assert sorted(used) == np.flatnonzero(use).tolist() and (np.diff(x.ravel()[used]) >= 0).all()
    for state, at in zip(h, used.tolist()):
        n, i = divmod(at, attention.WINDOW)
        e = weights["emb"][x[n, : i + 1]] + weights["pos"][: i + 1]
        a = np.exp((e[i] @ weights["wq"]) @ (e @ weights["wk"]).T / np.sqrt(attention.WIDTH))
        assert state == pytest.approx(e[i] + (a / a.sum()) @ (e @ weights["wv"]) @ weights["wo"], abs=1e-6)
    classes = np.array([0, 1, 1, 1, 2, 2, 3, 1, 3])
    tree = attention.Tree(classes, random.integers(0, 50, 9).astype(float))
    ids = random.integers(0, 9, 40)
    has, sizes, path, forks, _ = tree.paths(ids)
    assert sorted(has) == np.flatnonzero(np.bincount(classes)[classes[ids]] > 1).tolist()
    values = random.standard_normal((forks.size, 3))
    want = np.zeros((40, 3))
    for level, m in enumerate(sizes):
        begin = sum(sizes[:level])
        assert (forks[begin : begin + m] == tree.forks[tree.begin[ids[has[:m]]] + level]).all()
        assert path[begin : begin + m].tolist() == list(range(m))
        np.add.at(want, has[:m], values[begin : begin + m])
    assert attention._over_levels(values, sizes) == pytest.approx(want[has])
    order = np.argsort(forks, kind="stable")
    at, sums = attention._summed(forks[order], values[order])
    want = np.zeros((tree.biases.size, 3))
    np.add.at(want, forks, values)
    assert sums == pytest.approx(want[at]) and at.tolist() == np.unique(forks).tolist()


def test_words_are_added_up_in_buckets(monkeypatch):
    """A part hands over a row for each bucket; every part gets counts and ids of all its words, and each word comes once without a part."""
    own = op4_tokens.encoder(op4_tokens.default_vocabulary())
    random = np.random.default_rng(10)
    vocabulary = [*(f"w{n}" for n in range(9000)), "é", "\u0001", "x" * 3000, "漢字."]
    parts = [[" ".join(random.choice(vocabulary, 4000)) for _ in range(5)] + [None, ""] for _ in range(3)]
    indexed = []
    for k, texts in enumerate(parts):
        monkeypatch.setattr(op2_lm.TaskContext, "get", lambda k=k: SimpleNamespace(partitionId=lambda: k))
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
        indexed += list(op2_lm._index(iter([batch])))
    rows = pa.Table.from_batches(indexed).select(["part", "bucket", "words", "number", "n"])
    rows = rows.filter(pc.is_valid(rows.column("bucket"))).sort_by("bucket").combine_chunks()
    assert rows.num_rows <= 3 * op2_lm.BUCKETS < sum(len({w for t in texts for w in op2_lm.words(t)}) for texts in parts)
    monkeypatch.setattr(op2_lm, "BUFFER", 1000)  # several tables of whole buckets
    found = pa.Table.from_batches(op2_lm._spell(None)(iter(rows.to_batches(max_chunksize=700))))
    want = Counter(w for texts in parts for n, t in enumerate(texts) if not op2_lm._held(n) for w in op2_lm.words(t))
    for k, texts in enumerate(parts):
        at = found.filter(pc.equal(found.column("part"), k << 32))
        number, c, sizes = (op2_lm._joined(at.column(name), kind) for name, kind in (("number", "<i4"), ("c", "<i8"), ("sizes", "<i4")))
        words = list(dict.fromkeys(w for t in texts for w in op2_lm.words(t)))
        assert sorted(number) == list(range(len(words))) and [want[words[n]] for n in number] == c.tolist()
        spelled = [np.frombuffer(own[words[n]], "<u4") for n in number]
        assert sizes.tolist() == [s.size for s in spelled]
        assert (op2_lm._joined(at.column("ids"), "<u2") == np.concatenate(spelled)).all()
    whole = found.filter(pc.is_null(found.column("part")))
    assert whole.num_rows > 3 and sum(op2_lm._joined(whole.column("c"), "<i8")) == sum(want.values())
    (cells,) = op2_lm._letters(iter(whole.select(["c", "sizes", "ids"]).to_batches()))
    letters = np.zeros(4 * (op2_lm.IDS + 1) + 2)
    letters[cells.column(0).to_numpy()] = cells.column(1).to_numpy()
    assert letters[-2:].tolist() == [sum(want.values()), sum(n > 0 for n in want.values())]
    assert letters[: op2_lm.IDS + 1].sum() == sum(n * len(own[w]) // 4 for w, n in want.items())
