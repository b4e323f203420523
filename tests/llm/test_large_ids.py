"""Ids above 2^53 beside NULL ids keep their values everywhere."""

import random
import zlib
from collections import Counter

import brute
import pytest

import corpus_pipeline
from occrisk.llm import op4_tokens, op5_suffix, op7_jaccard, op8_packing, op9_chat, op10_decontamination, op11_counts

BIG = 2**53
IDS = [BIG + 1, BIG + 3, None, BIG + 5, BIG + 7]


def _prose(seed, n=120):
    pick = random.Random(seed)
    return " ".join("".join(pick.choices("abcdefghij", k=pick.randrange(2, 9))) for _ in range(n)) + "."


@pytest.fixture()
def docs(spark):
    rows = [(i, _prose(n), "en", "s", 1) for n, i in enumerate(IDS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(1)


def _ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_ids_of_operators(spark, docs, tmp_path):
    assert {(r["class_id"], r["_row"]["doc_id"]) for r in op7_jaccard.classes(docs).collect()} == {(i, i) for i in IDS}
    assert _ids(op7_jaccard.deduplicated(docs)) == Counter(IDS)
    assert _ids(op8_packing.pack_documents(docs)) == Counter(IDS)
    assert _ids(op5_suffix.summary(docs)) == _ids(op5_suffix.deduplicated(docs)) == Counter(IDS)
    assert _ids(op11_counts.token_counts(docs)) == Counter(IDS)
    items = docs.where("doc_id = 9007199254740997").selectExpr("1 as item_id", "text")
    assert _ids(op10_decontamination.leaks(docs, items)) == Counter([BIG + 5])
    op4_tokens.write_shards(docs, str(tmp_path / "shards"))
    assert _ids(op4_tokens.read_documents(spark, str(tmp_path / "shards"))) == Counter(IDS)


def test_ids_of_conversations(spark):
    rows = [(i, BIG + 9, "user", "Who is there?") for i in IDS] + [(i, None, "user", "And now?") for i in IDS]
    lines = op9_chat.with_features(op9_chat.transcripts(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").coalesce(1)))
    got = op9_chat.parse(lines.drop(*op9_chat.FEATURES), op9_chat.fit(lines)).collect()
    assert Counter((r["conv_id"], r["turn"]) for r in got) == Counter((i, t) for i in IDS for t in (BIG + 9, None))


def test_ids_of_the_pipeline(spark, docs, tmp_path):
    folder = tmp_path / "in"
    docs.write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([(1, "an item of the benchmark with some words of its own in it here")], "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))
    kept = Counter(i for n, i in enumerate(IDS) if dict(corpus_pipeline.STAGES))
    out = docs
    for name, stage in corpus_pipeline.STAGES[1:]:  # invented words pass no rule of quality
        out = stage(spark, out, str(folder)).cache()
        assert _ids(out) == kept, name


def test_empty_pipeline(spark, docs, tmp_path):
    folder = tmp_path / "in"
    docs.limit(0).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(folder)).collect() == []


def test_order_of_repeated_ids(spark, tmp_path):
    """One id on most rows falls into many ranges; positions stay whole."""
    rows = [(7, f"word number{n % 13} stands here") for n in range(300)] + [(n, "other words") for n in range(20)] + [(None, "none")]
    op4_tokens.write_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "shards"), shard_ids=200)
    got = sorted(op4_tokens.read_documents(spark, str(tmp_path / "shards")).collect(), key=lambda r: r["start"])
    own = op4_tokens.encoder(op4_tokens.default_vocabulary())
    texts = Counter((i, zlib.crc32(own.ids(t).tobytes() + (1).to_bytes(4, "little"))) for i, t in rows)
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == texts
    assert [r["start"] for r in got] == [sum(q["n_tokens"] for q in got[:k]) for k in range(len(got))]
    assert [r["doc_id"] is not None and r["doc_id"] for r in got] == sorted(r["doc_id"] is not None and r["doc_id"] for r in got)


def test_copies_of_a_row_are_listed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(op8_packing, "COPIES", 3)
    df = spark.createDataFrame([(1, "a b")] * 10 + [(2, "a")], "doc_id bigint, text string")
    assert Counter((r["doc_id"], r["copy"]) for r in op8_packing.pack_documents(df).collect()) == Counter([(1, k) for k in range(10)] + [(2, 0)])


@pytest.mark.parametrize("length", [200, 61])
def test_passages_of_other_lengths(spark, length):
    shared = [_prose(1, 40), _prose(2, 15)]
    texts = [_prose(k + 10, 20) + shared[k % 2] + _prose(k + 20, 30) for k in range(6)] + ["é" * 250, "é" * 90]
    got = {r["doc_id"]: tuple(r)[1:] for r in op5_suffix.summary(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), length, 24).collect()}
    assert got == {d: (n, gone, runs, brute.sha(kept)) for d, (n, gone, runs, kept) in enumerate(brute.suffixes(texts, length))}
