"""Jaccard join on word 5-grams with Bayesian pruning of candidates.

1. Texts with equal word sequences are one node, weighted by its copies.
2. A node's MinHash values are cut into BANDS bands of ROWS values; nodes that
   share a band are candidates.
3. Candidate pairs compare their MinHash values (8 bits of each) STEP at a
   time.  After each step the posterior probability that the similarity reaches
   the threshold is looked up; below TOLERANCE the pair is dropped.
4. Pairs that stay tie nodes into clusters; inside a cluster every pair is
   verified exactly on the shingle sets.

Pairs never become rows: a task compares one block of a bucket or cluster with
another and returns, per node, the number of links and one edge to the least
node it found.  Buckets and clusters of any size are cut into blocks of BLOCK
nodes, so no group is held by one task.  A pair at a threshold of 0.8 shares no
band with probability (1 - 0.8^ROWS)^BANDS = 3.2e-6, and is pruned, by steps 3
and 4 alike, with probability 7.5e-7: it is missed with 4.0e-6 at most, less
above the threshold.

Defined results: a text of one to four words is one shingle; a NULL or empty
text, or one of white space, has no words and no links and is a class of its
own; rows with a NULL doc_id are nodes like others, and name no class; equal
rows are copies; an empty table gives no rows; other columns are ignored or, in
`deduplicated`, kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import mix64, shipped, stored, table
from occrisk.llm.components import components
from occrisk.llm.shingles import chunks, grouped, powers, shingles_of, words_of

WIDTH = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 4
STEP = 16
TOLERANCE = 1e-7
BLOCK = 512


# ---------------------------------------------------------------- nodes


def node_key(text: Column) -> Column:
    """128-bit key of the word sequence; NULL where there are no words."""
    words = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " "))
    return F.when(words != "", F.unhex(F.md5(F.encode(words, "UTF-8"))))


@lru_cache(1)
def _multipliers() -> np.ndarray:
    return mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """MinHash values, one row per text; every text has at least one shingle."""
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.empty((sizes.size, BANDS * ROWS), np.uint32)
    for k, a in enumerate(_multipliers()):
        out[:, k] = np.minimum.reduceat((shingles * a) >> np.uint64(32), starts)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    banded = signature.astype(np.uint64).reshape(len(signature), BANDS, ROWS)
    keys = (banded * powers(ROWS + 1)[1:]).sum(axis=2, dtype=np.uint64)
    return mix64(keys + mix64(np.arange(7, BANDS + 7, dtype=np.uint64))).view(np.int64)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [t.encode("utf-8", "surrogatepass") for t in batch["text"]]
        for a, b in chunks(texts):
            words, counts = words_of(texts[a:b])
            shingles, sizes = shingles_of(words, counts, WIDTH)
            signature = signatures(shingles, sizes)
            rows = batch.iloc[a:b]
            yield pd.DataFrame(
                {
                    "doc_id": rows["doc_id"],
                    "node": rows["node"],
                    "n": sizes,
                    "sketch": [row.tobytes() for row in (signature & np.uint32(0xFF)).astype(np.uint8)],
                    "bands": list(band_keys(signature)),
                }
            )


def nodes(docs: DataFrame) -> DataFrame:
    """(node, doc_id, copies, n, sketch, bands): one row per distinct word sequence."""
    # ids pass pandas as strings: beside a NULL it would turn integers into doubles
    own = F.col("doc_id").cast("long")
    rows = docs.select(own.cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"), node_key(F.col("text")).alias("node"))
    sketches = rows.where("node is not null").mapInPandas(_sketch, "doc_id string, node binary, n bigint, sketch binary, bands array<bigint>")
    sketches = sketches.withColumn("doc_id", own)
    # min over a struct keeps one row's values together
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "n", "sketch", "bands")).alias("one")
    return sketches.groupBy("node").agg(one, F.count("*").alias("copies")).select("node", "one.doc_id", "copies", "one.n", "one.sketch", "one.bands")


# ---------------------------------------------------------------- Bayesian pruning


@lru_cache(4)
def least_matches(threshold: float = THRESHOLD) -> np.ndarray:
    """For 0, STEP, 2 STEP, ... values compared: the fewest matches at which the pair may stay.

    The prior is uniform on [0, 1]; values of 8 bits agree by chance once in 256.
    """
    grid = (np.arange(4000) + 0.5) / 4000
    agree = grid + (1 - grid) / 256
    out = [0]
    for compared in range(STEP, BANDS * ROWS + 1, STEP):
        needed = compared + 1
        for matched in range(compared + 1):
            weight = matched * np.log(agree) + (compared - matched) * np.log1p(-agree)
            likely = np.exp(weight - weight.max())
            if likely[grid >= threshold].sum() / likely.sum() >= TOLERANCE:
                needed = matched
                break
        out.append(needed)
    return np.array(out)


def survivors(sketches: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that no step drops."""
    fits = np.minimum(sizes[left], sizes[right]) >= threshold * np.maximum(sizes[left], sizes[right]) - 1e-9
    left, right = left[fits], right[fits]
    matched = np.zeros(left.size, np.int64)
    for step, least in enumerate(least_matches(threshold)[1:]):
        part = slice(step * STEP, (step + 1) * STEP)
        matched += (sketches[left, part] == sketches[right, part]).sum(axis=1)
        stay = matched >= least
        left, right, matched = left[stay], right[stay], matched[stay]
    return left, right


# ---------------------------------------------------------------- blocks of a group


def blocked(members: DataFrame, group: str, sizes: DataFrame) -> DataFrame:
    """Members dealt to (group, x, y): blocks x <= y to compare; `side` is the block of the member.

    A group of up to BLOCK members is the one pair (0, 0).
    """
    rows = members.join(sizes.select(group, F.ceil(F.col("size") / BLOCK).alias("n_blocks")), group)
    side = F.pmod(F.xxhash64("node"), F.col("n_blocks")).cast("int")
    rows = rows.select("*", side.alias("side"))
    other = F.explode(F.sequence(F.lit(0), (F.col("n_blocks") - 1).cast("int"))).alias("other")
    rows = rows.select("*", other)
    return rows.select("*", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y")).drop("other", "n_blocks")


def together(rows: DataFrame, group: str) -> DataFrame:
    return rows.repartition(group, "x", "y").sortWithinPartitions(group, "x", "y")


def block_pairs(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one (group, x, y)."""
    side = rows["side"].to_numpy()
    x, y = rows["x"].iloc[0], rows["y"].iloc[0]
    if x == y:
        return np.triu_indices(len(rows), 1)
    a, b = np.flatnonzero(side == x), np.flatnonzero(side == y)
    return np.repeat(a, b.size), np.tile(b, a.size)


def least_of(n: int, left: np.ndarray, right: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each of n nodes the node of least `order` that it reaches over these pairs."""
    root = np.arange(n)
    while True:
        best = root.copy()
        a, b = root[left], root[right]
        lower = np.where(order[a] <= order[b], a, b)
        for ends in (left, right):
            at = np.argsort(-order[lower], kind="stable")
            # the last write wins: the one of least order
            better = lower[at]
            target = ends[at]
            keep = order[better] < order[best[target]]
            best[target[keep]] = better[keep]
        best = best[best]
        if (best == root).all():
            return root
        root = best


def _bucket_edges(threshold: float):
    def edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, roots = [], []
        for rows in grouped(batches, ["bucket", "x", "y"]):
            if len(rows) < 2:
                continue
            sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
            left, right = survivors(sketches, rows["n"].to_numpy(), *block_pairs(rows), threshold)
            if not left.size:
                continue
            node = rows["node"].to_numpy()
            order = np.argsort(np.argsort(node))
            root = least_of(len(rows), left, right, order)
            for n in np.flatnonzero(root != np.arange(len(rows))).tolist():
                keys.append(node[n])
                roots.append(node[root[n]])
            if len(keys) > 20_000:
                yield pd.DataFrame({"a": keys, "b": roots})
                keys, roots = [], []
        yield pd.DataFrame({"a": keys, "b": roots})

    return edges


def _exact(shingles: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs reach the threshold."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    if left.size <= 16:
        common = np.array([np.intersect1d(shingles[starts[i] : starts[i + 1]], shingles[starts[j] : starts[j + 1]], assume_unique=True).size for i, j in zip(left, right)])
    else:
        _, column = np.unique(shingles, return_inverse=True)
        row = np.repeat(np.arange(sizes.size), sizes)
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        product = np.zeros((sizes.size, sizes.size), np.float32)
        width = 4096
        edges = np.searchsorted(column, np.arange(0, int(column[-1]) + width, width)) if column.size else np.zeros(1, np.int64)
        for k, (a, b) in enumerate(zip(edges, [*edges[1:], column.size])):
            if a < b:
                held = np.zeros((sizes.size, width), np.float32)
                held[row[a:b], column[a:b] - k * width] = 1.0
                product += held @ held.T
        common = product[left, right].astype(np.int64)
    # counts are whole numbers: common >= t (a + b - common)
    return common * (1 + threshold) >= threshold * (sizes[left] + sizes[right]) - 1e-6


def _verify(threshold: float):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for rows in grouped(batches, ["root", "x", "y"]):
            if len(rows) < 2:
                continue
            sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
            left, right = survivors(sketches, rows["n"].to_numpy(), *block_pairs(rows), threshold)
            if not left.size:
                continue
            words, counts = words_of([t.encode("utf-8", "surrogatepass") for t in rows["text"]])
            shingles, sizes = shingles_of(words, counts, WIDTH)
            linked = _exact(shingles, sizes, left, right, threshold)
            left, right = left[linked], right[linked]
            if not left.size:
                continue
            node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
            order = np.argsort(np.argsort(node))
            root = least_of(len(rows), left, right, order)
            texts = np.bincount(left, minlength=len(rows)) + np.bincount(right, minlength=len(rows))
            links = np.bincount(left, copies[right], len(rows)) + np.bincount(right, copies[left], len(rows))
            out += [(node[n], node[root[n]], int(texts[n]), int(links[n])) for n in np.flatnonzero(texts).tolist()]
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["a", "b", "texts", "links"])
                out = []
        yield pd.DataFrame(out, columns=["a", "b", "texts", "links"])

    return verify


# ---------------------------------------------------------------- the join


def candidate_clusters(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root): nodes tied by pairs that survive the Bayesian comparison."""
    members = found.select("node", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    dealt = blocked(members, "bucket", sizes).join(found.select("node", "n", "sketch"), "node")
    pairs = together(dealt, "bucket").mapInPandas(_bucket_edges(threshold), "a binary, b binary")
    return components(pairs)


def links(docs: DataFrame, found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, texts, links) per compared block: node, least node it reaches, linked texts and their copies."""
    clusters = stored(candidate_clusters(found, threshold), "clusters")
    sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    wanted = clusters.join(found.select("node", "doc_id", "copies", "n", "sketch"), "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id"))).where(node_key(F.col("text")) == F.col("node")).dropDuplicates(["node"])
    dealt = blocked(texts.select("root", "node", "copies", "n", "sketch", "text"), "root", sizes)
    return together(dealt, "root").mapInPandas(_verify(threshold), "a binary, b binary, texts bigint, links bigint")


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, root, doc_id, copies, texts, links): classes of distinct texts.

    `links` counts the documents of other texts at or above the threshold,
    `texts` those texts; `root` names the class.
    """
    shipped(docs.sparkSession)
    found = stored(nodes(docs), "nodes")
    verified = stored(links(docs, found, threshold), "links")
    roots = stored(components(verified.select("a", "b")), "classes")
    counts = verified.groupBy(F.col("a").alias("node")).agg(F.sum("texts").alias("texts"), F.sum("links").alias("links"))
    zero = F.lit(0).cast("long")
    return (
        found.select("node", "doc_id", "copies")
        .join(roots, "node", "left")
        .join(counts, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"), "doc_id", "copies", F.coalesce("texts", zero).alias("texts"), F.coalesce("links", zero).alias("links"))
    )


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document (packed in `_row`): class id (its least doc_id), class size, links, linked texts."""
    joined = stored(join(docs, threshold), "joined")
    named = joined.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    per_node = joined.join(named, "root").select("node", "class_id", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("texts").alias("n_linked_texts"))
    rows = docs.select(F.struct("*").alias("_row"), node_key(F.col("text")).alias("node"))
    # most rows have a text of their own; equal keys beyond that are split by the adaptive join
    return rows.join(per_node, "node", "left").select(
        "_row",
        F.when(F.col("node").isNull(), F.col("_row.doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("n_linked_texts", F.lit(0).cast("long")).alias("n_linked_texts"),
    )


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one of least doc_id, with the input's columns.

    Only ids take part in the last join.  Rows without words, or without an id, stay.
    """
    joined = stored(join(docs, threshold), "joined")
    lowest = joined.groupBy("root").agg(F.min(F.struct("doc_id", "node")).alias("one")).select("one.*")
    lowest = lowest.where("doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("node").alias("_node"))
    twice = docs.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.count("*").alias("n")).where("n > 1").select("_id", F.lit(True).alias("_twice"))
    kept = lowest.join(twice, "_id", "left").select("_id", "_node", F.coalesce("_twice", F.lit(False)).alias("_twice"))
    # the row is one struct here, so none of its columns can clash with a helper's
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_own"), node_key(F.col("text")).alias("_key"))
    free = rows.where(F.col("_key").isNull() | F.col("_own").isNull()).select("_row.*")
    chosen = rows.join(kept, (F.col("_own") == F.col("_id")) & (F.col("_key") == F.col("_node")))
    once = chosen.where(~F.col("_twice")).select("_row.*")
    # rows that repeat an id and a text: one of them
    repeated = chosen.where("_twice").dropDuplicates(["_id", "_node"]).select("_row.*")
    return once.unionByName(repeated).unionByName(free)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select(F.col("_row.doc_id").alias("doc_id"), "class_id", "class_size", "n_links", "n_linked_texts")
