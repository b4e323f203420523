"""Best-fit packing of documents into sequences of several permitted lengths.

Each shard is packed by best-fit decreasing.  A piece goes to the open bin it
fills best; if none has room, the size is opened whose cost per token is least,
counting on the pieces still to come that could fill the rest.  At the end
every bin shrinks to the smallest permitted length that holds its contents.

Documents longer than the largest length are cut into consecutive pieces;
nothing is dropped.  Only ids and lengths are shuffled.  Shards have a bounded
expected number of pieces whatever the input's size; equal rows are counted
first and dealt out by copy number, so they spread over shards.

Defined results: a NULL or empty text is one token (its end); rows with a NULL
id are packed like others; equal rows are packed as often as they occur; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import shipped, stored, table

LENGTHS = (256, 512, 1024, 2048, 4096)
SHARD_PIECES = 8192

SCHEMA = "shard bigint, bin bigint, capacity int, used int, offset int, doc_id string, copy bigint, start bigint, n_tokens int"
COPIES = 1 << 16  # copies of one row that one array lists


def cost(length: int) -> float:
    """Of one sequence: linear and attention work, and a fixed part."""
    return 16.0 + length * (1.0 + length / 16384.0)


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int]]:
    """Bin of every piece, and the final capacity of every bin; sizes must not increase."""
    lengths = tuple(sorted(lengths))
    after = np.concatenate([np.cumsum(np.asarray(sizes, np.int64)[::-1])[::-1], [0]]).tolist()
    falling = [-s for s in sizes]
    costs = {c: cost(c) for c in lengths}
    room: dict[int, list[int]] = {}  # bins by what is left in them
    left: list[int] = []  # the keys of `room`, ascending
    used: list[int] = []
    limit: list[int] = []
    places = []
    for n, size in enumerate(sizes):
        at = bisect_left(left, size)
        if at < len(left):
            rest = left[at]
            bin_ = room[rest].pop()
            if not room[rest]:
                del room[rest], left[at]
        else:
            def per_token(c: int) -> float:
                rest = c - size
                still = after[max(n + 1, bisect_left(falling, -rest))] if rest else 0
                return costs[c] / (size + min(rest, still))

            bin_ = len(used)
            limit.append(min((c for c in lengths if c >= size), key=per_token))
            used.append(0)
        used[bin_] += size
        places.append(bin_)
        rest = limit[bin_] - used[bin_]
        if rest:
            if rest not in room:
                room[rest] = []
                insort(left, rest)
            room[rest].append(bin_)
    return places, [lengths[bisect_left(lengths, u)] for u in used]


def _pack_shard(lengths: tuple[int, ...]):
    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        # ids come as strings, as pandas would turn integers beside a NULL into doubles
        ids = rows["doc_id"].notna()
        rows = rows.assign(named=ids, number=rows["doc_id"].where(ids, "0").astype("int64"))
        rows = rows.sort_values(["n_tokens", "named", "number", "copy", "start"], ascending=[False, True, True, True, True], kind="stable")
        places, capacities = pack(rows["n_tokens"].tolist(), lengths)
        offsets, filled = [], [0] * len(capacities)
        for bin_, size in zip(places, rows["n_tokens"].tolist()):
            offsets.append(filled[bin_])
            filled[bin_] += size
        return rows.assign(bin=places, capacity=[capacities[b] for b in places], used=[filled[b] for b in places], offset=offsets)[
            [c.split()[0] for c in SCHEMA.split(", ")]
        ]

    return packed


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+"), F.lit(0)))


def pack_documents(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, n_tokens: Column | None = None) -> DataFrame:
    """One row per piece: its bin (shard, bin), the bin's final capacity and use, its place in bin and document.

    `n_tokens` counts a document's tokens, by default its words and one end.
    """
    spark = shipped(docs.sparkSession)
    count = n_tokens if n_tokens is not None else n_words(F.col("text")) + 1
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), count.cast("long").alias("length"))
    sized = stored(sized.groupBy("doc_id", "length").agg(F.count("*").alias("copies")), "lengths")
    longest = max(lengths)
    cuts = F.ceil(F.col("length") / longest)
    total = sized.agg(F.sum(cuts * F.col("copies")).alias("n")).first()["n"] or 0
    shards = max(1, math.ceil(total / SHARD_PIECES))
    # copies in two steps, so that no array grows with their number
    runs = sized.select("doc_id", "length", "copies", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))).alias("first"))
    runs = runs.repartition("doc_id", "length", "first")
    copies = runs.select("doc_id", "length", F.explode(F.sequence("first", F.least(F.col("first") + COPIES, "copies") - 1)).alias("copy"))
    pieces = copies.select("doc_id", "length", "copy", F.explode(F.sequence(F.lit(0).cast("long"), cuts - 1)).alias("cut"))
    pieces = pieces.select(
        F.pmod(F.xxhash64("doc_id", "copy", "cut"), F.lit(shards)).alias("shard"),
        "doc_id",
        "copy",
        (F.col("cut") * longest).alias("start"),
        F.least(F.lit(longest), F.col("length") - F.col("cut") * longest).cast("int").alias("n_tokens"),
    )
    pieces = pieces.withColumn("doc_id", F.col("doc_id").cast("string"))
    return pieces.groupBy("shard").applyInPandas(_pack_shard(lengths), SCHEMA).withColumn("doc_id", F.col("doc_id").cast("long"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
