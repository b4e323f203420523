"""Benchmark decontamination: edit distance by CGK embedding and bit-sampling LSH.

Words are runs of ASCII letters, digits and other characters outside ASCII, in
lower case.  A document leaks an item of L words if some window of its words is
within floor((1 - SIMILARITY) L) word edits of the item.

* The CGK random walk copies the word under its pointer and advances by a
  random bit of (step, word).  Strings at small edit distance fall into step
  again, so the walks agree at many steps.
* A table samples SAMPLES steps of one walk; a window and an item that agree on
  them are candidates.  WALKS walks with TABLES_PER_WALK tables each are
  repeated until the target recall is reached (tested at the threshold).
* Windows are of the size of the items: lengths are put in classes of ratio
  GROWTH, each with its own windows, walks and tables.  After k edits a window
  still holds m of any k + m places of its item.  Only windows that hold m =
  RARE_HELD of the k + m places whose words are rarest in the texts at hand are
  embedded; whatever counts as rare, this loses nothing.  Any place may start a
  window, whatever its word, and up to k places before a document's first word
  may too: where an item's front is cut or replaced, the walks fall into step
  from the place where its first word would stand.
* Every candidate is verified by the exact edit distance; the window may then
  start up to k words before or after the candidate's start, at a benchmark word.

Items are taken in slices of at most SLICE_WORDS words, so that what a task
holds is bounded whatever the size of the benchmark; every slice sees all
documents.  Documents are neither shuffled nor cut.

Defined results: a NULL or empty text leaks nothing; items with a NULL text or
fewer than MIN_WORDS words cannot mark a passage and are left out; equal items
are reported one by one, equal rows too; empty tables give no hits; other
columns are ignored or, in `decontaminated`, kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import mix64, shipped, table
from occrisk.llm.shingles import chunks, words_of

SIMILARITY = 0.8
MIN_WORDS = 5
GROWTH = 1.25
WALKS = 8
TABLES_PER_WALK = 16
SAMPLES = 2
RARE_HELD = 3
STEPS = 1.6  # of a walk, per word of the shortest item of its class
SLICE_WORDS = 500_000
WALK_BYTES = 1 << 23

_GAP = np.array([not (chr(b).isascii() and chr(b).isalnum() or b >= 128) for b in range(256)])


def normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def edits(words: int, similarity: float = SIMILARITY) -> int:
    return math.floor((1 - similarity) * words + 1e-9)


@dataclass
class LengthClass:
    """Items of similar length: windows, random walks and the tables of their samples."""

    items: list[int]
    bits: np.ndarray  # advance of a walk: (walk, step, word)
    samples: np.ndarray  # (walk, table, sample): steps
    keys: np.ndarray  # of all items in all tables, ascending
    owners: np.ndarray


class Index:
    """A slice of the benchmark, ready for search."""

    def __init__(self, names: list, texts: list[bytes], similarity: float = SIMILARITY):
        hashes, counts = words_of(texts, _GAP) if texts else (np.empty(0, np.uint64), np.empty(0, np.int64))
        parts = np.split(hashes, np.cumsum(counts)[:-1]) if texts else []
        chosen = [n for n, part in enumerate(parts) if part.size >= MIN_WORDS]
        self.names = [names[n] for n in chosen]
        self.vocabulary = np.unique(np.concatenate([parts[n] for n in chosen])) if chosen else np.empty(0, np.uint64)
        self.items = [np.searchsorted(self.vocabulary, parts[n]).astype(np.int32) for n in chosen]
        self.edits = [edits(item.size, similarity) for item in self.items]
        by_class: dict[int, list[int]] = {}
        for n, item in enumerate(self.items):
            by_class.setdefault(int(math.log(item.size) / math.log(GROWTH) + 1e-9), []).append(n)
        self.classes = [self._class(number, members) for number, members in sorted(by_class.items())]

    def _class(self, number: int, members: list[int]) -> LengthClass:
        shortest = min(self.items[n].size for n in members)
        steps = max(SAMPLES, math.ceil(STEPS * shortest))
        random = np.random.default_rng(1000 + number)  # the same on every machine
        bits = random.integers(0, 2, (WALKS, steps, self.vocabulary.size + 1), dtype=np.int8)
        samples = np.sort(np.argsort(random.random((WALKS, TABLES_PER_WALK, steps)), axis=2)[:, :, :SAMPLES], axis=2)
        own = LengthClass(
            items=members, bits=bits, samples=samples, keys=np.empty(0, np.uint64), owners=np.empty(0, np.int64),
        )
        words = np.concatenate([np.append(self.items[n], -1) for n in members]).astype(np.int32)
        sizes = np.array([self.items[n].size + 1 for n in members])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        keys, owners = [], []
        for key, valid in self.table_keys(own, words, starts, starts, starts + sizes - 1):
            keys.append(key[valid])
            owners.append(np.asarray(members)[valid])
        own.keys, own.owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(own.keys, kind="stable")
        own.keys, own.owners = own.keys[order], own.owners[order]
        return own

    @staticmethod
    def table_keys(own: LengthClass, words: np.ndarray, starts: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per table the sampled words of every window as one key, and whether all of them are benchmark words.

        `words` holds vocabulary places, -1 for other words and at every end; places
        before `begins` are other words.
        """
        for walk in range(WALKS):
            wanted = {int(step) for step in own.samples[walk].ravel()}
            at, seen = starts.copy(), {}
            for step in range(own.bits.shape[1]):
                word = np.where((at >= begins) & (at < ends), words[at], -1)
                if step in wanted:
                    seen[step] = word
                at += own.bits[walk, step][word]  # the last column serves words that are not in the vocabulary
                np.minimum(at, ends, out=at)
            for table_, steps in enumerate(own.samples[walk].tolist()):
                key = np.full(starts.size, 1 + walk * TABLES_PER_WALK + table_, np.uint64)
                valid = np.ones(starts.size, bool)
                for step in steps:
                    key = mix64(key) + (seen[step].astype(np.int64) + 2).astype(np.uint64)
                    valid &= seen[step] >= 0
                yield mix64(key), valid

    def search(self, texts: list[bytes]) -> list[tuple[int, object, int, int, int]]:
        """(text, item, first word, words, edits) of the best window per text and item."""
        hits: list[tuple[int, object, int, int, int]] = []
        for a, b in chunks(texts, WALK_BYTES):
            hits += [(a + n, *rest) for n, *rest in self._search_chunk(texts[a:b])]
        return hits

    def _places(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        parts, counts = [], []
        for a, b in chunks(texts):
            hashes, sizes = words_of(texts[a:b], _GAP)
            place = np.minimum(np.searchsorted(self.vocabulary, hashes), self.vocabulary.size - 1)
            parts.append(np.where(self.vocabulary[place] == hashes, place, -1).astype(np.int32))
            counts.append(sizes)
        return np.concatenate([*parts, np.array([-1], np.int32)]), np.concatenate(counts)

    def _search_chunk(self, texts: list[bytes]) -> list[tuple[int, object, int, int, int]]:
        if not self.vocabulary.size or not texts:
            return []
        words, counts = self._places(texts)
        front = max(self.edits)  # places before the first text
        words = np.concatenate([np.full(front, -1, np.int32), words])
        bounds = front + np.concatenate([[0], np.cumsum(counts)])
        filled = np.flatnonzero(counts)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        regions = self._regions(words)
        for own in self.classes:
            marks = np.zeros(words.size + 1, np.int32)
            for n in own.items:
                low, high = regions[n]
                np.add.at(marks, low, 1)
                np.add.at(marks, high + 1, -1)
            if not marks.any():
                continue
            near = np.cumsum(marks[:-1]) > 0
            starts = np.flatnonzero(near[:-1])
            starts = starts[starts >= front]
            owner = np.searchsorted(bounds, starts, side="right") - 1
            before = np.arange(1, max(self.edits[n] for n in own.items) + 1)
            lead = (bounds[filled][:, None] - before[None, :]).ravel()
            own_lead = np.repeat(filled, before.size)
            starts, owner = np.concatenate([starts, lead[near[lead]]]), np.concatenate([owner, own_lead[near[lead]]])
            if not starts.size:
                continue
            begins, ends = bounds[owner], bounds[owner + 1]
            pairs = []
            for key, valid in self.table_keys(own, words, starts, begins, ends):
                at = np.flatnonzero(valid)
                low = np.searchsorted(own.keys, key[at], side="left")
                number = np.searchsorted(own.keys, key[at], side="right") - low
                at, low, number = at[number > 0], low[number > 0], number[number > 0]
                entry = np.repeat(low - np.cumsum(number) + number, number) + np.arange(number.sum())
                pairs.append(np.repeat(at, number) * len(self.items) + own.owners[entry])
            for n, group in self._by_item(np.unique(np.concatenate(pairs))):
                group = group[self._shared(n, words, starts[group], begins[group], ends[group]) >= self.items[n].size - self.edits[n]]
                if not group.size:
                    continue
                distance, first, length = self._verify(n, words, starts[group], begins[group], ends[group])
                for k in np.flatnonzero(distance <= self.edits[n]).tolist():
                    where = (int(owner[group[k]]), n)
                    found = (int(distance[k]), int(first[k] - bounds[where[0]]), int(length[k]))
                    best[where] = min(best.get(where, found), found)
        return [(t, self.names[n], start, length, distance) for (t, n), (distance, start, length) in sorted(best.items())]

    def _regions(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per item the ranges (first, last) of window starts that hold enough of its rarest words."""
        frequency = np.bincount(words + 1, minlength=self.vocabulary.size + 1)[1:]
        rarest = []
        wanted = np.zeros(self.vocabulary.size + 1, bool)
        for item, k in zip(self.items, self.edits):
            places = np.argsort(frequency[item], kind="stable")[: k + RARE_HELD]
            rarest.append(np.unique(item[places]))
            wanted[rarest[-1]] = True
        wanted[-1] = False
        at = np.flatnonzero(wanted[words])
        order = np.argsort(words[at], kind="stable")
        at = at[order]
        cuts = np.searchsorted(words[at], np.arange(self.vocabulary.size + 1))
        out = []
        for item, k, own in zip(self.items, self.edits, rarest):
            places = np.sort(np.concatenate([at[cuts[w] : cuts[w + 1]] for w in own.tolist()]))
            span = item.size + k
            low, high = places[RARE_HELD - 1 :] - span + 1, places[: max(0, places.size - RARE_HELD + 1)]
            near = low <= high
            out.append((np.maximum(low[near], 0), high[near]))
        return out

    def _by_item(self, pairs: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        item, window = pairs % len(self.items), pairs // len(self.items)
        order = np.argsort(item, kind="stable")
        item, window = item[order], window[order]
        cuts = np.flatnonzero(np.diff(item)) + 1
        for group in np.split(np.arange(item.size), cuts):
            if group.size:
                yield int(item[group[0]]), window[group]

    def _shared(self, n: int, words: np.ndarray, starts: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words of each window that are words of item n: edits cannot be fewer than the rest."""
        member = np.zeros(self.vocabulary.size + 1, bool)
        member[self.items[n]] = True
        at = starts[:, None] + np.arange(self.items[n].size + self.edits[n])[None, :]
        return (member[words[np.minimum(at, words.size - 1)]] & (at >= begins[:, None]) & (at < ends[:, None])).sum(axis=1)

    def _verify(self, n: int, words: np.ndarray, starts: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Least edit distance between item n and a window that starts at a benchmark word up to k places from each start,
        and that window's first place and length; a band of the table suffices."""
        item, k = self.items[n], self.edits[n]
        far = np.int64(1 << 40)
        shift = np.int64(1 << 20)
        # a cell is edits * shift + offset of the window's start; column d stands for text place start + i + d - k
        offsets = np.arange(-k, k + 1)
        at = starts[:, None] + offsets[None, :]
        free = (at >= begins[:, None]) & (at < ends[:, None]) & (words[np.clip(at, 0, words.size - 1)] >= 0)
        row = np.where(free, (offsets + k)[None, :], far).astype(np.int64)
        for i, word in enumerate(item.tolist(), 1):
            place = starts[:, None] + (i + offsets)[None, :]
            inside = (place > begins[:, None]) & (place <= ends[:, None])
            same = (words[np.clip(place - 1, 0, words.size - 1)] == word) & inside
            fresh = np.where(inside, row + np.where(same, 0, shift), far)
            # the item's word has no counterpart: same place in the text
            fresh[:, :-1] = np.minimum(fresh[:, :-1], row[:, 1:] + shift)
            for d in range(1, 2 * k + 1):
                fresh[:, d] = np.where(inside[:, d], np.minimum(fresh[:, d], fresh[:, d - 1] + shift), fresh[:, d])
            row = fresh
        best = row.argmin(axis=1)
        value = row[np.arange(starts.size), best]
        first = starts + value % shift - k
        return value // shift, first, starts + item.size + best - k - first


# ---------------------------------------------------------------- Spark


def slices(benchmark: DataFrame, similarity: float) -> Iterator[Index]:
    """Indexes over all items, each over at most about SLICE_WORDS words."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    words = items.agg(F.sum(F.size(F.split("text", r"\s+"))).alias("n")).first()["n"] or 0
    number = max(1, math.ceil(words / SLICE_WORDS))
    for n in range(number):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(number)) == n).collect()
        rows.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"]))
        yield Index([r["item_id"] for r in rows], [normal(r["text"]) for r in rows], similarity)


def _texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    return [normal(t) for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def _finder(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["item_id", "first_word", "n_words", "edits"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = index.value.search(_texts(batch, "text"))
            ids = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[h[0]] for h in hits], pa.int64()), *[pa.array([h[k] for h in hits], pa.int64()) for k in range(1, 5)]], names=["doc_id", *names]
            )

    return find


def _filter(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = np.ones(batch.num_rows, bool)
            stay[[h[0] for h in index.value.search(_texts(batch, "text"))]] = False
            yield batch.filter(pa.array(stay))

    return clean


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, edits): each document and item, at their best window."""
    spark = shipped(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for index in slices(benchmark, similarity):
        part = rows.mapInArrow(_finder(spark.sparkContext.broadcast(index)), "doc_id bigint, item_id bigint, first_word bigint, n_words bigint, edits bigint")
        found = part if found is None else found.unionByName(part)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents that leak no item, with the input's columns; no join, no shuffle."""
    spark = shipped(docs.sparkSession)
    for index in slices(benchmark, similarity):
        docs = docs.mapInArrow(_filter(spark.sparkContext.broadcast(index)), docs.schema)
    return docs


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
