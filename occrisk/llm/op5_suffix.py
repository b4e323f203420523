"""Exact removal of repeated passages with a logarithmic family of suffix fingerprints.

A byte goes if some string of `length` bytes that covers it also starts elsewhere.

* Suffixes are sampled: of the GRAM-byte strings in each window of `length` bytes the
  one of least hash (the leftmost, on ties) is the window's anchor.  Equal
  windows have equal anchors at equal offsets, so the sample misses no match.
* Batches of documents arrive one after the other.  A batch gets the table
  of its sampled suffixes, by fingerprint of their first GRAM bytes; it is
  merged against every level for suffixes met before and becomes a level; two
  levels of equal size merge into one of twice the size (`Family`).
* Windows around anchors met twice are settled in blocks of BLOCK starts: what
  all windows of a block share must repeat (else none does); if what they cover
  together repeats, all do.  The few blocks that neither settles are compared
  start by start on 128-bit fingerprints.

All of it is counting by fingerprint with aggregation before each shuffle; no
task holds the places of one passage, however often it repeats.  Levels and
intermediate tables lie in the shared folder.

Defined results: a NULL text is empty; texts under `length` bytes stay whole;
equal rows of `length` bytes or more repeat each other and lose everything; rows with
a NULL or repeated doc_id are told apart by their text; an empty table gives no
rows; other columns are ignored or, in `deduplicated`, kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import shipped, stored, table
from occrisk.llm.shingles import chunks, prefix_hash, span_hash

# A repeated string of so many bytes goes; anchors are picked by so many bytes.
LENGTH, GRAM = 400, 64
# The same for passages of prose: 51 words of four bytes with their gaps are longer.
PASSAGE, PASSAGE_GRAM = 200, 48
BLOCK = 16
BATCHES = 4
CHUNK = 1 << 19

KEY = ["_id", "_h"]
_KEY_SCHEMA = "_id bigint, _h bigint"


def keyed(docs: DataFrame) -> DataFrame:
    """`docs` packed in `_row`, with `_id`, `_h`, `_text`: rows of one key have the same text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))


# ---------------------------------------------------------------- anchors (numpy, on many texts at once)


class Chunk:
    """Texts in a row, with their anchors: anchor `at` serves the window starts [first, last]."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.begins = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.prefix = prefix_hash(self.data)
        n, width = self.data.size, length - gram + 1
        empty = np.empty(0, np.int64)
        self.at, self.first, self.last, self.text, self.key = empty, empty, empty, empty, empty
        if n < length:
            return
        grams = np.arange(n - gram + 1)
        hashes = span_hash(self.prefix, grams, grams + gram)
        # 32 bits of hash above, the place below: the least is the leftmost of the least hashes
        bits = np.uint64(32)
        packed = ((hashes >> bits) << bits) | grams.astype(np.uint64)
        blocks = -(-packed.size // width)
        full = np.full(blocks * width, ~np.uint64(0))
        full[: packed.size] = packed
        full = full.reshape(blocks, width)
        ahead = np.minimum.accumulate(full, axis=1).ravel()
        behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = np.arange(n - length + 1)
        least = np.minimum(behind[starts], ahead[starts + width - 1])
        text = np.repeat(np.arange(len(texts)), np.diff(self.begins))[starts]
        inside = starts + length <= self.begins[text + 1]
        starts, text = starts[inside], text[inside]
        anchor = (least[inside] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        if not starts.size:
            return
        change = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(text) != 0)) + 1
        runs = np.concatenate([[0], change])
        ends = np.concatenate([change, [starts.size]]) - 1
        self.at, self.first, self.last, self.text = anchor[runs], starts[runs], starts[ends], text[runs]
        self.key = hashes[self.at].view(np.int64)


def _encoded(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column(batch.schema.get_field_index("_text")).cast(pa.binary()).to_pylist()


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values, np.int64))


def _lists(values: np.ndarray, text: np.ndarray, n: int, kind=pa.int64()) -> pa.Array:
    """One list per text, from values that come in the order of texts."""
    cuts = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(values).cast(kind))


def _anchors(length: int, gram: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _encoded(batch)
            for a, b in chunks(texts, CHUNK):
                own = Chunk(texts[a:b], length, gram)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(batch.schema.get_field_index(k)).slice(a, b - a) for k in KEY],
                        _longs([len(t) for t in texts[a:b]]),
                        pa.array([hashlib.sha256(t).hexdigest() for t in texts[a:b]]),
                        _lists((own.at - own.begins[own.text]), own.text, b - a, pa.int32()),
                        _lists(own.key, own.text, b - a),
                    ],
                    names=[*KEY, "n_bytes", "sha256", "places", "keys"],
                )

    return apply


def sampled(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: size, checksum, and places and fingerprints of its sampled suffixes."""
    schema = f"{_KEY_SCHEMA}, n_bytes bigint, sha256 string, places array<int>, keys array<bigint>"
    return docs.select(*KEY, "_text").mapInArrow(_anchors(length, gram), schema)


# ---------------------------------------------------------------- the family of suffix arrays


class Family:
    """Levels of sorted suffix fingerprints, of sizes 1, 2, 4, ... batches."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame]] = []
        self.met: list[DataFrame] = []

    @staticmethod
    def _array(rows: DataFrame) -> DataFrame:
        return stored(rows.groupBy("key").agg(F.sum("n").alias("n")).sortWithinPartitions("key"), "suffixes")

    def add(self, suffixes: DataFrame) -> None:
        """Insert a batch; `suffixes` has one `key` per sampled suffix."""
        fresh = self._array(suffixes.select("key", F.lit(1).cast("long").alias("n")))
        self.met.append(fresh.where("n > 1").select("key"))
        for _, level in self.levels:
            self.met.append(fresh.join(level.select("key"), "key").select("key"))
        size, rows = 1, fresh
        while self.levels and self.levels[-1][0] == size:
            _, level = self.levels.pop()
            size, rows = 2 * size, self._array(rows.unionByName(level))
        self.levels.append((size, rows))

    def repeated(self) -> DataFrame:
        """Fingerprints met more than once, each once."""
        rows = self.met[0]
        for more in self.met[1:]:
            rows = rows.unionByName(more)
        return stored(rows.distinct(), "repeated")


# ---------------------------------------------------------------- blocks of windows


def _ladder(length: int, gram: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _encoded(batch)
            places = batch.column(batch.schema.get_field_index("places"))
            keys = [np.asarray(batch.column(batch.schema.get_field_index(k))) for k in KEY]
            for a, b in chunks(texts, CHUNK):
                own = Chunk(texts[a:b], length, gram)
                part = places.slice(a, b - a)
                wanted = np.asarray(part.flatten(), np.int64) + np.repeat(own.begins[:-1], np.asarray(part.value_lengths().fill_null(0)))
                chosen = np.isin(own.at, wanted)
                at, first, last, text = own.at[chosen], own.first[chosen], own.last[chosen], own.text[chosen]
                low, high = (at - last) // BLOCK, (at - first) // BLOCK
                number = high - low + 1
                step = np.repeat(low - np.cumsum(number) + number, number) + np.arange(number.sum())
                at, first, last, text = (np.repeat(x, number) for x in (at, first, last, text))
                top, bottom = at - BLOCK * step, at - BLOCK * step - BLOCK + 1
                begin, end = own.begins[text], own.begins[text + 1]
                core = span_hash(own.prefix, top, bottom + length) + step.astype(np.uint64)
                whole = (bottom >= begin) & (top + length <= end)
                both = span_hash(own.prefix, np.where(whole, bottom, begin), np.where(whole, top + length, begin)) + step.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[_longs(k[a:b][text]) for k in keys],
                        _longs(core.view(np.int64)),
                        pa.array(both.view(np.int64), mask=~whole),
                        pa.array((np.maximum(bottom, first) - begin).astype(np.int32)),
                        pa.array((np.minimum(top, last) - begin).astype(np.int32)),
                    ],
                    names=[*KEY, "core", "both", "first", "last"],
                )

    return apply


def _dense(length: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _encoded(batch)
            ranges = batch.column(batch.schema.get_field_index("ranges")).to_pylist()
            keys = [np.asarray(batch.column(batch.schema.get_field_index(k))) for k in KEY]
            for a, b in chunks(texts, CHUNK):
                data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
                begins = np.concatenate([[0], np.cumsum([len(t) for t in texts[a:b]])])
                starts, text = [], []
                for n, own in enumerate(ranges[a:b]):
                    at = np.unique(np.concatenate([np.arange(r["first"], r["last"] + 1) for r in own]))
                    starts.append(at + begins[n])
                    text.append(np.full(at.size, n))
                at, text = np.concatenate(starts), np.concatenate(text)
                marks = [span_hash(prefix_hash(data, kind), at, at + length, kind).view(np.int64) for kind in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*[_longs(k[a:b][text]) for k in keys], *map(_longs, marks), pa.array((at - begins[text]).astype(np.int32))], names=[*KEY, "h1", "h2", "first"]
                )

    return apply


def repeated_windows(docs: DataFrame, suffixes: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(texts with repeated suffixes, windows that repeat: key, first and last start)."""
    places = suffixes.select(*KEY, F.explode(F.arrays_zip("places", "keys")).alias("s")).select(*KEY, F.col("s.places").alias("place"), F.col("s.keys").alias("key"))
    family = Family()
    for n in range(BATCHES):
        family.add(places.where(F.pmod(F.xxhash64(*KEY), F.lit(BATCHES)) == n).select("key"))
    flagged = places.join(family.repeated(), "key", "left_semi").groupBy(*KEY).agg(F.collect_set("place").alias("places"))
    texts = stored(docs.select(*KEY, "_text").join(flagged, KEY), "texts")

    blocks = stored(texts.mapInArrow(_ladder(length, gram), f"{_KEY_SCHEMA}, core bigint, both bigint, first int, last int"), "blocks")
    pairs = stored(blocks.groupBy("core", "both").agg(F.count("*").alias("n")), "pairs")
    all_repeat = (F.col("n") > 1) & F.col("both").isNotNull()
    cores = pairs.groupBy("core").agg(F.sum("n").alias("met"), F.min(all_repeat).alias("plain")).where("met > 1").select(F.col("core").alias("_core"), "plain")
    settled = pairs.join(cores, F.col("core") == F.col("_core")).select(F.col("core").alias("_c"), F.col("both").alias("_b"), all_repeat.alias("all"), "plain")
    found = stored(
        blocks.join(settled, (F.col("core") == F.col("_c")) & F.col("both").eqNullSafe(F.col("_b"))).select(*KEY, "core", "both", "first", "last", "all", "plain"), "settled"
    )

    # an open block may repeat part of a settled one: one of each kind of these takes part
    others = found.where("all and not plain").dropDuplicates(["core", "both"])
    open_ = found.where("not all").unionByName(others)
    ranges = open_.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    one_each = texts.select(*KEY, "_text").join(ranges, KEY)
    windows = stored(one_each.mapInArrow(_dense(length), f"{_KEY_SCHEMA}, h1 bigint, h2 bigint, first int"), "windows")
    twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    single = windows.join(twice, ["h1", "h2"], "left_semi").select(*KEY, "first", F.col("first").alias("last"))
    return texts, found.where("all").select(*KEY, "first", "last").unionByName(single)


def removed_ranges(docs: DataFrame, suffixes: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(texts, key and `windows`, the set of repeated window ranges of each text that has any)."""
    texts, windows = repeated_windows(docs, suffixes, length, gram)
    return texts, stored(windows.groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("windows")), "ranges")


def cut(text: bytes, windows: list[dict], length: int = LENGTH) -> tuple[bytes, int]:
    """What is left of a text, and the number of removed runs."""
    kept, at, runs = [], 0, 0
    for first, last in sorted((w["first"], w["last"] + length) for w in windows):
        if first > at or not runs:
            kept.append(text[at:first])
            runs += 1
        at = max(at, last)
    kept.append(text[at:])
    return b"".join(kept), runs


# ---------------------------------------------------------------- results


def _summary(length: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _encoded(batch)
            done = [cut(t, w, length) for t, w in zip(texts, batch.column(batch.schema.get_field_index("windows")).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(k)) for k in KEY],
                    _longs([len(t) - len(k) for t, (k, _) in zip(texts, done)]),
                    _longs([runs for _, runs in done]),
                    pa.array([hashlib.sha256(k).hexdigest() for k, _ in done], pa.string()),
                ],
                names=[*KEY, "n_removed", "n_spans", "kept"],
            )

    return apply


def summary(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    shipped(docs.sparkSession)
    rows = keyed(docs.select("doc_id", "text"))
    suffixes = stored(sampled(rows, length, gram), "sampled")
    texts, ranges = removed_ranges(rows, suffixes, length, gram)
    cuts = texts.select(*KEY, "_text").join(ranges, KEY).mapInArrow(_summary(length), f"{_KEY_SCHEMA}, n_removed bigint, n_spans bigint, kept string")
    cuts = cuts.dropDuplicates(KEY)  # equal rows give equal cuts
    sizes = suffixes.select(*KEY, "n_bytes", "sha256").dropDuplicates(KEY)
    zero = F.lit(0).cast("long")
    return (
        docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
        .select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), F.xxhash64("_t").alias("_h"))
        .join(sizes, KEY)
        .join(cuts, KEY, "left")
        .select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept", "sha256").alias("kept_sha256"))
    )


def _cutter(position: int, length: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, windows = batch.column(0), batch.column(1).to_pylist()
            columns = row.flatten()
            # bytes of a character that was cut through go with it
            texts = columns[position].cast(pa.binary()).to_pylist()
            left = [t if w is None else cut(t, w, length)[0].decode("utf-8", "ignore").encode() for t, w in zip(texts, windows)]
            columns[position] = pa.array(left, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in row.type])

    return apply


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The documents without their repeated passages, with the input's columns."""
    shipped(docs.sparkSession)
    rows = keyed(docs)
    _, ranges = removed_ranges(rows, stored(sampled(rows, length, gram), "sampled"), length, gram)
    joined = rows.join(ranges, KEY, "left").select("_row", "windows")
    return joined.mapInArrow(_cutter(docs.columns.index("text"), length), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents"))
