"""Merkle manifest of a dataset: one tree per language, one tree above them, a proof per document.

Nodes are labelled by the last leaf below them and their level, so a child's label
lies before its parent's.  Time-forward processing visits the nodes in that order:
a priority queue ordered by label holds the digests that children have sent to
parents not yet reached.  The queue is external: a task only works on one
block of 2^LEVELS neighbouring nodes at a time, with at most LEVELS messages open
per block; what a block sends beyond its top goes into a stored table, which
Spark sorts by (tree, block, place) for the next sweep.  Every sweep takes LEVELS
levels, so 10^11 leaves need four.

A reversed sweep then visits the nodes from the last label to the first.  Each node
hands its children the proof of its own place, with the child's sibling ahead of it;
between blocks only the proof of a block's top travels, never one per leaf.

Leaves' places in their tree come from ranges that Spark draws by (lang, doc_id,
leaf) and one count per range, so a language of any size, or one repeated doc_id,
spreads over all tasks.  Digests of texts are taken where the texts are read.

Defined results: NULLs count as `-`, in `lang` they are a tree of their own ahead of
all others; rows with a NULL doc_id stand first and are never tampered with; rows
with equal doc_ids stand by leaf, equal rows take neighbouring places with proofs
of their own; a column that the input lacks counts as NULL; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from occrisk.llm.common import shipped, stored, table

LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- leaves


def _leaf(values: list[Column]) -> Column:
    shown = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*shown), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, tampered): digests of the rows; `tampered` only where the row is tampered with.

    `tree` sorts like lang: NULL first, then bytewise.
    """
    named = [F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string") for c in FIELDS]
    rows = docs.select(*[c.alias(f) for c, f in zip(named, FIELDS)])
    more = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")
    struck = (F.crc32("doc_id") % 7 == 0) & F.col("n_chars").isNotNull()
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("tree"),
        _leaf([F.col(f) for f in FIELDS]).alias("digest"),
        F.when(struck, _leaf([more if f == "n_chars" else F.col(f) for f in FIELDS])).alias("tampered"),
        F.monotonically_increasing_id().alias("salt"),
    )


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tree, with their range and their place in its part of the tree."""
    part, tree, at = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        places = []
        for t in batch.column(batch.schema.get_field_index("tree")).to_pylist():
            at = at + 1 if t == tree else 0
            tree = t
            places.append(at)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64())], names=[*batch.schema.names, "range", "inside"])


def placed(nodes: DataFrame, *order: str) -> DataFrame:
    """Add `at`, the place of each row in its tree, from 0, and `size`, the number of the tree's rows."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = nodes.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
    numbered = stored(ranged.mapInArrow(_number, f"{schema}, range int, inside bigint"), "ranged")
    whole = Window.partitionBy("tree")
    ahead = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy("tree", "range").agg((F.max("inside") + 1).alias("n"))
    counts = counts.select("tree", "range", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"), F.sum("n").over(whole).alias("size"))
    return numbered.join(counts, ["tree", "range"]).withColumn("at", F.col("ahead") + F.col("inside")).drop("range", "inside", "ahead")


# ---------------------------------------------------------------- one block, with its queues


def height(size: int, levels: int) -> int:
    """Levels that a sweep takes in a tree of so many nodes."""
    return min(levels, max(0, size - 1).bit_length())


class Block:
    """Neighbouring nodes of a tree, given in order, and what lies above them up to the block's top."""

    def __init__(self, levels: int, keep: bool):
        self.levels, self.keep = levels, keep
        self.queue: list[tuple[int, int, int, str]] = []  # (last leaf, level, side, digest)
        self.known: dict[tuple[int, int], str] = {}
        self.count, self.top = 0, ""

    def _send(self, level: int, node: int, value: str) -> None:
        if self.keep:
            self.known[level, node] = value
        if level == self.levels:
            self.top = value
        else:
            parent = node >> 1
            heapq.heappush(self.queue, ((parent + 1) << (level + 1), level + 1, node & 1, value))

    def _forward(self, before: int | None) -> None:
        """Visit the parents whose last leaf has come (all, at the end)."""
        while self.queue and (before is None or self.queue[0][0] <= before):
            last, level, _, value = heapq.heappop(self.queue)
            if self.queue and self.queue[0][:2] == (last, level):
                value += heapq.heappop(self.queue)[3]
            self._send(level, (last >> level) - 1, digest(value))

    def add(self, value: str) -> None:
        self._forward(self.count)
        self._send(0, self.count, value)
        self.count += 1

    def close(self) -> str:
        self._forward(None)
        return self.top

    def proofs(self, above: tuple | None) -> Iterator[tuple[int, tuple | None]]:
        """Nodes of the lowest level, last first, each with its proof: linked (side of the sibling, digest, rest)."""
        if not self.count:
            return
        queue = [(-((1 << self.levels)), -self.levels, above)]
        while queue:
            last, level, proof = heapq.heappop(queue)
            level, node = -level, (-last >> -level) - 1
            if level == 0:
                yield node, proof
                continue
            left, right = 2 * node, 2 * node + 1
            low, high = self.known[level - 1, left], self.known.get((level - 1, right))
            for child, side, sibling in ((left, "r", high), (right, "l", low)):
                if (level - 1, child) in self.known:
                    step = ("-", "", proof) if sibling is None else (side, sibling, proof)
                    heapq.heappush(queue, (-((child + 1) << (level - 1)), -(level - 1), step))


def written(proof: tuple | None) -> str:
    """Steps from the lowest up, each `l` or `r` and the sibling's digest, or `-`."""
    out = []
    while proof is not None:
        out.append(proof[0] + proof[1])
        proof = proof[2]
    return "".join(out)


def read(text: str) -> tuple | None:
    steps, at = [], 0
    while at < len(text):
        end = at + (1 if text[at] == "-" else 65)
        steps.append((text[at], text[at + 1 : end]))
        at = end
    proof = None
    for side, sibling in reversed(steps):
        proof = (side, sibling, proof)
    return proof


def checked(value: str, proof: tuple | None) -> tuple[str, str]:
    """(digest of the siblings in order, root that the value folds to)."""
    siblings = []
    while proof is not None:
        side, sibling, proof = proof
        siblings.append(sibling)
        value = digest(value + sibling if side == "r" else sibling + value)
    return digest("".join(siblings)), value


# ---------------------------------------------------------------- sweeps


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            yield dict(zip(names, values))


def _sent(rows: Iterator[tuple], schema: pa.Schema, size: int = 5000) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)


def _dealt(nodes: DataFrame, levels: int) -> DataFrame:
    """Blocks of neighbours together, in order."""
    return nodes.withColumn("block", F.shiftright("at", levels)).repartition("tree", "block").sortWithinPartitions("tree", "block", "at")


_NODE = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("digest", pa.string())])


def _upward(levels: int):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[tuple]:
            for (tree, block), rows in groupby(_rows(batches), key=lambda r: (r["tree"], r["block"])):
                own = None
                for r in rows:
                    size = r["size"]
                    own = own or Block(height(size, levels), keep=False)
                    own.add(r["digest"])
                yield tree, block, -(-size >> levels), own.close()

        return _sent(tops(), _NODE)

    return sweep


def forward(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """(tree, at, size, digest) of the given nodes, then of the tops of their blocks, and so on up to one node per tree."""
    sweeps = [nodes]
    while (sweeps[-1].agg(F.max("size")).first()[0] or 0) > 1:
        below = _dealt(sweeps[-1].select("tree", "at", "size", "digest"), levels)
        sweeps.append(stored(below.mapInArrow(_upward(levels), "tree string, at bigint, size bigint, digest string"), "nodes"))
    return sweeps


_HEAD = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("proof", pa.string()), ("subroot", pa.string()), ("root", pa.string())])
_LEAF = pa.schema([(n, pa.int64() if n == "doc_id" else pa.bool_() if n == "verified" else pa.string()) for n in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")])
_HEAD_SCHEMA = "tree string, block bigint, proof string, subroot string, root string"
_LEAF_SCHEMA = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _downward(levels: int, leaf: bool):
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lower() -> Iterator[tuple]:
            for (tree, _), rows in groupby(_rows(batches), key=lambda r: (r["tree"], r["block"])):
                head = next(rows)  # the block's own proof sorts ahead of its nodes
                own, given = None, []
                for r in rows:
                    own = own or Block(height(r["size"], levels), keep=True)
                    own.add(r["digest"])
                    given.append(r)
                if own is None:
                    continue
                own.close()
                for n, proof in own.proofs(read(head["proof"])):
                    r = given[n]
                    if not leaf:
                        yield tree, r["at"], written(proof), head["subroot"], head["root"]
                        continue
                    proof_digest, folded = checked(r["tampered"] or r["digest"], proof)
                    yield r["doc_id"], r["digest"], head["subroot"], head["root"], proof_digest, folded, folded == head["root"]

        return _sent(lower(), _LEAF if leaf else _HEAD)

    return sweep


def backward(sweeps: list[DataFrame], heads: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Proofs of the lowest nodes, from the heads (tree, block, proof, subroot, root) of the topmost blocks."""
    for n in range(len(sweeps) - 1, -1, -1):
        nodes = sweeps[n]
        with_block = nodes.withColumn("block", F.shiftright("at", levels))
        both = with_block.unionByName(heads.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
        dealt = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
        last = n == 0
        out = dealt.mapInArrow(_downward(levels, last and "tampered" in nodes.columns), _LEAF_SCHEMA if last and "tampered" in nodes.columns else _HEAD_SCHEMA)
        if last:
            return out
        heads = stored(out, "proofs")
    raise AssertionError


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    shipped(docs.sparkSession)
    own = stored(leaves(docs), "leaves")
    trees = forward(stored(placed(own, "doc_id", "digest", "salt").drop("salt"), "placed"), levels)
    subroots = trees[-1].select("tree", "digest")
    # the tree above: its leaves are the subroots in order of language
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest")
    top = forward(stored(placed(named, "of"), "placed"), levels)
    root = top[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit("").alias("proof"), F.lit("").alias("subroot"), F.col("digest").alias("root"))
    # proofs of the subroots, found again by their places in the tree above
    proofs = backward(top, root, levels).select(F.col("block").alias("at"), "proof", "root")
    heads = top[0].select("at", "of", "digest").join(proofs, "at")
    heads = stored(heads.select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("block"), "proof", F.col("digest").alias("subroot"), "root"), "heads")
    return backward(trees, heads, levels)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
