"""Token counts of whole documents, huge ones in overlapping chunks that are spliced where both agree.

The splitting rule of the byte-level vocabulary reads left to right and keeps no
state: where two readings of a text both begin a piece at the same byte, they
agree from there on, until the shorter one comes near its end.

* White space that follows a character which is certainly no white space always
  begins a piece.  Between two such places stands a *unit*; its tokens do not
  depend on what surrounds it, so a task asks the library once per distinct unit
  (a plain word is one piece: its merges only) and adds up.  Special strings hold no white space and lie inside one unit.
* A document above CHUNK bytes is cut into chunks that share OVERLAP bytes, each
  a row of its own, dealt over all tasks.  A chunk reports its tokens, and inside
  both overlaps every byte offset at which a piece begins, with the tokens ahead
  of it.  Places nearer to a cut than the longest special string do not count.
* The first offset that two neighbours share is the splice: the earlier chunk
  loses its tokens from there on, the later one those before it.  A document's
  count is the sum of its chunks' tokens less the sum of what splices take off,
  so nothing but sums meets at a document.
* Neighbours without a common offset (a piece as long as the overlap) are joined
  into one chunk, which widens their overlap to both of them, and encoded again;
  this repeats until every pair is spliced.

Defined results: a NULL or empty text has 0 bytes and 0 tokens; every row gives one
row, also rows with a NULL or repeated doc_id and equal rows; an empty table gives
none; other columns are ignored.  One piece (a run of letters, say) is encoded
in one call of the library, however long it is.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from occrisk.llm.common import shipped, stored, table

VOCABULARY = "byte_bpe_50k.json"
CHUNK = 1 << 14
OVERLAP = 1 << 9
LIMIT = 1024
# A task's table of unit lengths starts anew beyond so many entries; longer units are not kept.
MEMO_UNITS, MEMO_CHARS = 400_000, 64

# Any Unicode version calls the first white space; the second holds all that one may call so.
_SPACE = r" \t\n\r\x0b\x0c"
_DOUBTFUL = "".join(f"{chr(a)}-{chr(b)}" for a, b in [(0, 0x20), (0x7F, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E), (0x2000, 0x200F), (0x2028, 0x202F), (0x205F, 0x206F), (0x3000, 0x3000), (0xFEFF, 0xFEFF)])
UNIT = re.compile(rf"[{_SPACE}]*[^{_SPACE}]*(?:(?<=[{_DOUBTFUL}])[{_SPACE}]+[^{_SPACE}]*)*")

# One piece of Latin letters with at most one blank ahead, and the stops behind it, another piece.
WORD = re.compile(f"( ?[A-Za-z{chr(0xC0)}-{chr(0xD6)}{chr(0xD8)}-{chr(0xF6)}{chr(0xF8)}-{chr(0x17F)}]+)([.,;:!?]*)")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---------------------------------------------------------------- the library, on units


class Speller:
    """Token counts by unit, and the pieces of a stretch of text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        special = self.library.get_added_tokens_decoder()
        self.margin = max([len(t.content.encode()) for t in special.values()], default=0) + 1
        # a token of the byte-level vocabulary has one character per byte; a special one stands for itself
        self.width = {i: len(s) for s, i in self.library.get_vocab(with_added_tokens=False).items()}
        self.width |= {i: len(t.content.encode()) for i, t in special.items()}
        self.known: dict[str, int] = {"": 0}
        # how the byte-level vocabulary writes bytes that are no printable sign
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.signs = {b: b for b in printable} | {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in printable)}

    def _piece(self, text: str) -> int:
        """Tokens of one piece, given to the merges without the splitting rule."""
        n = self.known.get(text)
        if n is None:
            n = self.known[text] = len(self.library.model.tokenize(text.encode().decode("latin-1").translate(self.signs)))
        return n

    def _unit(self, unit: str) -> int:
        if word := WORD.fullmatch(unit):
            return self._piece(word[1]) + (self._piece(word[2]) if word[2] else 0)
        return len(self.library.encode(unit, add_special_tokens=False))

    def _sum(self, units: list[str]) -> int:
        if len(self.known) > MEMO_UNITS:
            self.known = {"": 0}
        known, long = self.known, []
        for u in set(units):
            if u not in known:
                known[u] = self._unit(u)
                if len(u) > MEMO_CHARS:
                    long.append(u)
        n = sum(map(known.__getitem__, units))
        for u in long:
            del known[u]
        return n

    def counts(self, texts: list[str]) -> list[int]:
        return [self._sum(UNIT.findall(t)) for t in texts]

    def pieces(self, text: str) -> tuple[list[int], list[int], int]:
        """Byte offsets at which pieces begin, the tokens ahead of each, and all tokens."""
        code = self.library.encode(text, add_special_tokens=False)
        offsets, ahead, at, last = [], [], 0, None
        for n, (token, word) in enumerate(zip(code.ids, code.word_ids)):
            if word != last:
                offsets.append(at)
                ahead.append(n)
                last = word
            at += self.width[token]
        return offsets, ahead, len(code.ids)

    def chunk(self, text: str, overlap: int) -> tuple[int, list, list]:
        """Tokens of a chunk, and (offset, tokens ahead) of the pieces in its first and last ``overlap`` bytes.

        Offsets of the second list count from the chunk's end, backwards.
        """
        units, total = UNIT.findall(text), len(text.encode())
        head, before, tail, after = 0, 0, len(units), 0
        while before < overlap and head < len(units):  # units that reach into the first overlap
            before += len(units[head].encode())
            head += 1
        while after < overlap and tail:
            tail -= 1
            after += len(units[tail].encode())
        if tail < head:  # one stretch serves both
            offsets, ahead, n = self.pieces(text)
            pairs = list(zip(offsets, ahead))
            return n, [p for p in pairs if p[0] < overlap], [(total - o, a) for o, a in pairs if o >= total - overlap]
        first, first_ahead, first_n = self.pieces("".join(units[:head]))
        last, last_ahead, last_n = self.pieces("".join(units[tail:]))
        middle = first_n + self._sum(units[head:tail])
        return (
            middle + last_n,
            [(o, a) for o, a in zip(first, first_ahead) if o < overlap],
            [(after - o, middle + a) for o, a in zip(last, last_ahead) if after - o <= overlap],
        )


@lru_cache(maxsize=2)
def speller(path: str) -> Speller:
    return Speller(path)


# ---------------------------------------------------------------- chunks


def cut_places(size: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    """Byte ranges of a text's chunks: neighbours share ``overlap`` bytes."""
    step, out, at = chunk - overlap, [], 0
    while at + chunk < size:
        out.append((at, at + chunk))
        at += step
    return [*out, (at, size)]


def _snapped(data: bytes, at: int) -> int:
    """The first character begin at or after a byte."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


_CHUNK_SCHEMA = "_id bigint, _h bigint, n_bytes bigint, first bigint, last bigint, begin bigint, part string"


def _cutter(chunk: int, overlap: int):
    """Rows (_id, _h, _text[, spans]) to chunks; ``spans`` names runs of chunks to give as one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes, texts = (batch.column(batch.schema.get_field_index(k)).to_pylist() for k in ("_id", "_h", "_text"))
            wanted = batch.column(batch.schema.get_field_index("spans")).to_pylist() if "spans" in batch.schema.names else [None] * len(ids)
            for key, h, text, spans in zip(ids, hashes, texts, wanted):
                data = text.encode()
                places = cut_places(len(data), chunk, overlap)
                runs = [(n, n) for n in range(len(places))] if spans is None else [(s["first"], s["last"]) for s in spans]
                cuts = [(a, b, _snapped(data, places[a][0]), _snapped(data, places[b][1])) for a, b in runs]
                for at in range(0, len(cuts), 256):
                    some = cuts[at : at + 256]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * len(some), pa.int64()),
                            pa.array([h] * len(some), pa.int64()),
                            pa.array([len(data)] * len(some), pa.int64()),
                            pa.array([a for a, *_ in some], pa.int64()),
                            pa.array([b for _, b, *_ in some], pa.int64()),
                            pa.array([x for *_, x, _ in some], pa.int64()),
                            pa.array([data[x:y].decode() for *_, x, y in some]),
                        ],
                        names=["_id", "_h", "n_bytes", "first", "last", "begin", "part"],
                    )

    return cut


_SIDES = ["left", "left_ahead", "right", "right_ahead"]
_ENCODED_SCHEMA = "_id bigint, _h bigint, n_bytes bigint, first bigint, last bigint, n bigint, " + ", ".join(f"{c} array<bigint>" for c in _SIDES)


def _encoder(path: str, overlap: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = speller(path)
        for batch in batches:
            begins, parts, sizes = (batch.column(batch.schema.get_field_index(k)).to_pylist() for k in ("begin", "part", "n_bytes"))
            totals, lefts, rights = [], [], []
            for begin, part, size in zip(begins, parts, sizes):
                n, left, right = own.chunk(part, overlap)
                end = begin + len(part.encode())
                # a special string that a cut runs through may hide what follows, or show what is not there
                totals.append(n)
                lefts.append([(begin + o, a) for o, a in left if o >= own.margin] if begin else [])
                rights.append([(end - o, a) for o, a in right if o >= own.margin] if end < size else [])
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(batch.schema.get_field_index(k)) for k in ("_id", "_h", "n_bytes", "first", "last")],
                    pa.array(totals, pa.int64()),
                    *[pa.array([[p[k] for p in x] for x in side], pa.list_(pa.int64())) for side in (lefts, rights) for k in (0, 1)],
                ],
                names=["_id", "_h", "n_bytes", "first", "last", "n", *_SIDES],
            )

    return encode


KEY = ["_id", "_h"]


def _encoded(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    parts = rows.mapInArrow(_cutter(chunk, overlap), _CHUNK_SCHEMA).repartition(*KEY, "first")
    return stored(parts.mapInArrow(_encoder(path, overlap), _ENCODED_SCHEMA), "chunks")


def _splices(chunks: DataFrame) -> DataFrame:
    """Per cut between neighbours (numbered by the earlier one's last chunk): what it takes off, NULL if they share no place."""
    none = F.lit(None).cast("array<bigint>")
    ends = chunks.select(*KEY, F.col("last").alias("cut"), "n", "right", "right_ahead", none.alias("left"), none.alias("left_ahead"))
    begins = chunks.where("first > 0").select(*KEY, (F.col("first") - 1).alias("cut"), F.lit(None).cast("bigint").alias("n"), none.alias("right"), none.alias("right_ahead"), "left", "left_ahead")
    # two rows at most meet at a cut
    sides = [F.flatten(F.collect_list(c)).alias(c) for c in _SIDES]
    meet = ends.unionByName(begins).groupBy(*KEY, "cut").agg(F.max("n").alias("n"), F.count("left").alias("later"), *sides).where("later > 0")
    at = F.array_min(F.array_intersect("right", "left"))
    ahead = {c: F.get(f"{c}_ahead", (F.array_position(c, F.col("at")) - 1).cast("int")) for c in ("left", "right")}
    return meet.withColumn("at", at).select(*KEY, "cut", (F.col("n") - ahead["right"] + ahead["left"]).alias("off"))


def _islands(chunks: DataFrame, failed: DataFrame) -> DataFrame:
    """Runs of chunks that failed cuts tie together: per key, spans of first and last chunk."""
    earlier = chunks.select(*KEY, F.col("last").alias("cut"), F.col("first"))
    later = chunks.select(*KEY, (F.col("first") - 1).alias("cut"), F.col("last"))
    sides = failed.select(*KEY, "cut").join(earlier, [*KEY, "cut"]).join(later, [*KEY, "cut"])
    by = Window.partitionBy(*KEY).orderBy("cut")
    fresh = F.coalesce(F.lag("last").over(by) < F.col("first"), F.lit(True))
    runs = sides.withColumn("run", F.sum(fresh.cast("int")).over(by)).groupBy(*KEY, "run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def spliced(rows: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(_id, _h, n_bytes, n_tokens) of long texts, one row per key."""
    one = F.col("first")
    chunks = _encoded(rows, path, chunk, overlap).dropDuplicates([*KEY, "first"])
    chunks = stored(chunks, "chunks")
    while True:
        cuts = stored(_splices(chunks), "splices")
        failed = cuts.where("off IS NULL")
        if failed.isEmpty():
            break
        spans = stored(_islands(chunks, failed), "spans")
        again = rows.join(spans, KEY)
        wider = _encoded(again, path, chunk, overlap).dropDuplicates([*KEY, "first"])
        inside = spans.select(*KEY, F.explode("spans").alias("s")).select(*KEY, F.col("s.first").alias("f"), F.col("s.last").alias("l"))
        kept = chunks.join(inside, [chunks[k] == inside[k] for k in KEY] + [one.between(F.col("f"), F.col("l"))], "left_anti")
        chunks = stored(kept.unionByName(wider), "chunks")
    off = cuts.groupBy(*KEY).agg(F.sum("off").alias("off"))
    sums = chunks.groupBy(*KEY).agg(F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n"))
    return sums.join(off, KEY, "left").select(*KEY, "n_bytes", (F.col("n") - F.coalesce("off", F.lit(0))).alias("n_tokens"))


# ---------------------------------------------------------------- documents


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = speller(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(part.schema.get_field_index("_text")).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index("doc_id")), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(own.counts(texts), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return count


def token_counts(docs: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""
    if chunk < 4 * overlap:
        raise ValueError("a chunk must be four overlaps long at least")
    shipped(docs.sparkSession)
    path = path or vocabulary_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    long = F.octet_length("_text") > chunk
    short = rows.where(~long).mapInArrow(_counter(path), "doc_id bigint, n_bytes bigint, n_tokens bigint")
    keyed = rows.where(long).select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64("_text").alias("_h"), "_text")
    counts = spliced(keyed.drop("doc_id"), path, chunk, overlap)
    whole = keyed.select("doc_id", *KEY).join(counts, KEY).select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(whole).withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
