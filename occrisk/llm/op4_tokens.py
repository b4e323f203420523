"""Token ids in binary shards, compressed by Re-Pair, with random access by document.

Documents are range-partitioned by id, so that shards hold ascending ids, and
encoded inside tasks.  A shard replaces its frequent neighbouring id pairs by
nonterminals, round after round, until no pair is frequent; pairs never touch
the end id, so each document starts at a symbol of its own.  A shard stores
rules and the length each symbol expands to, which lets a reader find and
expand any range of positions without the rest (`ShardReader.ids`).

Shards are the rows of a Parquet table (part, shard, first_start, n_ids, blob):
Spark's committer makes the writing safe against lost executors on any file
system.  The number of documents in a shard follows from SHARD_IDS.

Defined results: a NULL or empty text is the end id alone; rows with a NULL id
come first; rows with equal ids follow by a hash of their texts, a NULL text
first; an empty table gives no shards; other columns are ignored.
"""

from __future__ import annotations

import codecs
import re
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import shared_folder, shipped, table

END_ID = 1
SHARD_IDS = 1 << 20
MIN_COUNT = 64
RULES_PER_ROUND = 1024
CACHED_WORDS = 600_000

_MAGIC = b"RPG1"
_HEAD = struct.Struct("<4s6I")

SHARD_SCHEMA = "part int, shard int, first_start bigint, n_ids bigint, blob binary"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# ---------------------------------------------------------------- encoding


class Known(dict):
    """Words met so far; another one is spelled when it is asked for."""

    def __init__(self, spell: Callable[[bytes], bytes]):
        self.spell = spell

    def __missing__(self, word: bytes) -> bytes:
        found = self.spell(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found
        return found


# Words of small Latin-1 letters in UTF-8, and stops behind one at the end of a word: no token holds letters and stops
_LATIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_STOPS = re.compile(rb"[.,](?:(?<=[a-z].)|(?<=\xc3[\x9f-\xb6\xb8-\xbf].))[.,]*(?=\s|\Z)")


class WordEncoder:
    """Ids of a text, word by word: white space always separates this vocabulary's tokens.

    Words of Latin letters go to the library's BPE model directly, all others
    through its whole pipeline; both are remembered in a bounded table.  Latin-1
    texts are first put in lower case and their words parted from the stops
    behind them, which the library does too, so that the table holds each word once.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Known(self.word)
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        letters = {b: b for b in printable} | {b: 256 + n for n, b in enumerate(rest)}
        self.letters = "".join(chr(letters[b]) for b in range(256))

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _merged(self, spelled: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def word(self, word: bytes) -> bytes:
        if word.isalpha() and word.islower():  # of bytes: ASCII letters only
            return self._merged(word.decode())
        if _LATIN.fullmatch(word):
            return self._merged(codecs.charmap_decode(word, "strict", self.letters)[0])
        text = word.decode("utf-8")
        core = text.rstrip(".,")
        plain = unicodedata.normalize("NFC", core).lower()
        if plain.isalpha() and max(plain) < "\u0250" and "İ" not in core:
            if plain != text:  # its letters in lower case, then its stops
                return self[plain.encode()] + (self[text[len(core) :].encode()] if len(core) < len(text) else b"")
            return self._merged(plain if plain.isascii() else codecs.charmap_decode(plain.encode(), "strict", self.letters)[0])
        return array("I", self._whole(text)).tobytes()

    def __getitem__(self, word: bytes) -> bytes:
        return self.known[word]

    def plain(self, text: str) -> bytes:
        """A text of the same ids with fewer different words; a special string is only one as it is written."""
        low = text.lower()
        try:
            low.encode("latin-1"), text.encode("latin-1")
        except UnicodeEncodeError:
            return text.encode("utf-8", "surrogatepass")
        if any(s in low for s in self.special):
            return text.encode()
        return _STOPS.sub(rb" \g<0>", low.encode())

    def ids(self, text: str | None) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.plain(text or "").split())), "=u4")


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process, kept over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ---------------------------------------------------------------- Re-Pair


def _frequent_pairs(symbols: np.ndarray, barrier: int, n_symbols: int) -> np.ndarray:
    """Keys left * 2^32 + right of the most frequent neighbouring pairs, most frequent first."""
    left, right = symbols[:-1], symbols[1:]
    free = (left != barrier) & (right != barrier)
    # A hash count first, so that only pairs in well filled buckets are sorted.
    bucket = ((left * np.uint32(2654435761) + right * np.uint32(2246822519)) >> np.uint32(15)).astype(np.intp)
    filled = np.bincount(bucket, weights=None, minlength=1 << 17) >= MIN_COUNT
    at = np.flatnonzero(filled[bucket] & free)
    if not at.size:
        return np.empty(0, np.uint64)
    keys, counts = np.unique((left[at].astype(np.uint64) << np.uint64(32)) | right[at], return_counts=True)
    # neighbours that overlap (a pair of equal symbols) may halve the count later; that only costs size
    best = np.argsort(-counts, kind="stable")[:RULES_PER_ROUND]
    return keys[best[counts[best] >= MIN_COUNT]]


def _replace(symbols: np.ndarray, pairs: np.ndarray, first: int, barrier: int) -> np.ndarray:
    """Replace pairs by symbols first, first + 1, ...; overlapping places are taken from the left, every other one."""
    order = np.argsort(pairs)
    ranked = pairs[order]
    starts, ends = np.zeros((2, int(symbols.max()) + 1), bool)
    starts[(ranked >> np.uint64(32)).astype(np.int64)] = True
    ends[(ranked & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    places = symbols.astype(np.intp)
    at = np.flatnonzero(starts[places[:-1]] & ends[places[1:]])
    keys = (symbols[at].astype(np.uint64) << np.uint64(32)) | symbols[at + 1]
    where = np.minimum(np.searchsorted(ranked, keys), len(ranked) - 1)
    hit = ranked[where] == keys
    at, names = at[hit], order[where[hit]]
    if not at.size:
        return symbols
    fresh = np.ones(at.size, bool)
    fresh[1:] = np.diff(at) != 1
    run_start = np.maximum.accumulate(np.where(fresh, np.arange(at.size), 0))
    take = (np.arange(at.size) - run_start) % 2 == 0
    at, names = at[take], names[take]
    out = symbols.copy()
    out[at] = (first + names).astype(np.uint32)
    keep = np.ones(symbols.size, bool)
    keep[at + 1] = False
    return out[keep]


def compress(ids: np.ndarray, barrier_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(terminal ids, rules, symbols): symbols below len(terminals) are terminals, the others rules in order."""
    # ids are places in a vocabulary: a table of it tells which occur, without a sort
    used = np.zeros(int(ids.max(initial=0)) + 1, bool)
    used[ids] = True
    terminals = np.flatnonzero(used)
    names = np.zeros(used.size, np.uint32)
    names[terminals] = np.arange(terminals.size, dtype=np.uint32)
    symbols = names[ids]
    place = int(np.searchsorted(terminals, barrier_id))
    barrier = place if place < terminals.size and terminals[place] == barrier_id else (1 << 32) - 1
    rules, n = [], terminals.size
    while symbols.size > 1:
        pairs = _frequent_pairs(symbols, barrier, n)
        if not pairs.size:
            break
        symbols = _replace(symbols, pairs, n, barrier)
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        n += pairs.size
    return terminals.astype(np.uint32), np.concatenate(rules) if rules else np.empty((0, 2), np.uint32), symbols


def pack(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    """One shard: header, ids, rules, expansion lengths, symbols, checksum.  Every document ends in END_ID."""
    ids = np.concatenate(docs) if docs else np.empty(0, np.uint32)
    terminals, rules, symbols = compress(ids, END_ID)
    lengths = np.ones(terminals.size + len(rules), np.uint32)
    for n, (a, b) in enumerate(rules.tolist()):
        lengths[terminals.size + n] = lengths[a] + lengths[b]
    wide = np.dtype("<u2") if lengths.size <= 1 << 16 else np.dtype("<u4")
    body = b"".join(
        [
            np.array([d if d is not None else 0 for d in doc_ids], "<i8").tobytes(),
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.array([d.size for d in docs], "<u4").tobytes(),
            terminals.astype("<u4").tobytes(),
            rules.astype("<u4").tobytes(),
            lengths.astype("<u4").tobytes(),
            symbols.astype(wide).tobytes(),
        ]
    )
    head = _HEAD.pack(_MAGIC, len(docs), terminals.size, len(rules), symbols.size, wide.itemsize, zlib.crc32(body))
    return head + body


class ShardReader:
    """Reads a shard; expands whole shards or any range of positions."""

    def __init__(self, blob: bytes):
        magic, n_docs, n_terminals, n_rules, n_symbols, width, check = _HEAD.unpack_from(blob)
        body = memoryview(blob)[_HEAD.size :]
        if magic != _MAGIC or zlib.crc32(body) != check:
            raise ValueError("not a shard, or a damaged one")
        at = 0

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(body, kind, n, at)
            at += part.nbytes
            return part

        ids, nulls = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if gone else int(d) for d, gone in zip(ids, nulls)]
        self.sizes = take("<u4", n_docs).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.terminals = take("<u4", n_terminals)
        self.rules = take("<u4", 2 * n_rules).reshape(n_rules, 2)
        self.lengths = take("<u4", n_terminals + n_rules).astype(np.int64)
        self.symbols = take(f"<u{width}", n_symbols)
        self.ends = np.cumsum(self.lengths[self.symbols])
        self._expanded: tuple[np.ndarray, np.ndarray] | None = None

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All symbols written out, one after the other, and where each begins."""
        if self._expanded is None:
            begins = np.concatenate([[0], np.cumsum(self.lengths)])
            flat = np.empty(int(begins[-1]), np.uint32)
            n = self.terminals.size
            flat[:n] = self.terminals
            for k, (a, b) in enumerate(self.rules.tolist()):
                to = begins[n + k]
                flat[to : to + self.lengths[a]] = flat[begins[a] : begins[a + 1]]
                flat[to + self.lengths[a] : begins[n + k + 1]] = flat[begins[b] : begins[b + 1]]
            self._expanded = flat, begins
        return self._expanded

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids at positions [start, end) of the shard; only the symbols that cover them are expanded."""
        first, last = np.searchsorted(self.ends, [start, end - 1], side="right") if end > start else (0, -1)
        part = self.symbols[first : last + 1]
        if not part.size:
            return np.empty(0, np.uint32)
        flat, begins = self._expansions()
        lengths = self.lengths[part]
        offsets = np.cumsum(lengths) - lengths
        out = flat[np.repeat(begins[part] - offsets, lengths) + np.arange(int(lengths.sum()))]
        skip = start - int(self.ends[first] - lengths[0])
        return out[skip : skip + end - start]

    def document(self, n: int) -> np.ndarray:
        return self.ids(int(self.starts[n]), int(self.starts[n + 1]))


# ---------------------------------------------------------------- Spark


def _shard_writer(path: str | None, shard_ids: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path or default_vocabulary())
        part, shard, start, held = TaskContext.get().partitionId(), 0, 0, 0
        names: list[int | None] = []
        docs: list[np.ndarray] = []
        end = np.array([END_ID], np.uint32)

        def flush() -> pd.DataFrame:
            return pd.DataFrame({"part": [part], "shard": [shard], "first_start": [start], "n_ids": [held], "blob": [pack(names, docs)]})

        for batch in batches:
            for name, text in zip(batch["doc_id"], batch["text"]):
                ids = np.concatenate([own.ids(text), end])
                names.append(None if name is None else int(name))
                docs.append(ids)
                held += ids.size
                if held >= shard_ids:
                    yield flush()
                    shard, start, held, names, docs = shard + 1, start + held, 0, [], []
        if docs:
            yield flush()

    return write


def write_shards(docs: DataFrame, path: str, vocabulary: str | None = None, shard_ids: int = SHARD_IDS) -> None:
    """Encode `text`, ordered by `doc_id`, into shards below `path`."""
    spark = shipped(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # ids fall into ranges of similar numbers of rows, which a repeated or NULL id does not stop;
    # the order of shards is the order of ids
    order = ["doc_id", "hash", "salt"]
    rows = rows.withColumns({"hash": F.when(F.col("text").isNotNull(), F.xxhash64("text")), "salt": F.monotonically_increasing_id()})
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # ids pass pandas as strings: beside a NULL it would turn integers into doubles
    ranged = ranged.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    ranged.mapInPandas(_shard_writer(vocabulary, shard_ids), SHARD_SCHEMA).write.parquet(path)


def part_offsets(shards: DataFrame) -> dict[int, int]:
    """Ids before each part; one row per write task."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    offsets, before = {}, 0
    for row in totals:
        offsets[row["part"]] = before
        before += row["n"]
    return offsets


def _reader(offsets: dict[int, int]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, first, blob in zip(batch["part"], batch["first_start"], batch["blob"]):
                shard = ShardReader(blob)
                begin = offsets[int(part)] + int(first)
                whole = shard.ids(0, int(shard.starts[-1])).astype("<u4")  # expanded once, as all documents are wanted
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(shard.doc_ids, dtype="Int64"),
                        "start": begin + shard.starts[:-1],
                        "n_tokens": shard.sizes,
                        "ids_crc32": [zlib.crc32(whole[a:b].tobytes()) for a, b in zip(shard.starts[:-1], shard.starts[1:])],
                    }
                )

    return read


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the shards: global start, number of ids, checksum of the ids."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return shards.select("part", "first_start", "blob").mapInPandas(_reader(part_offsets(shards)), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/token-shards-{uuid.uuid4().hex}"
    write_shards(table(spark, sf_dir, "documents"), path)
    return read_documents(spark, path)
