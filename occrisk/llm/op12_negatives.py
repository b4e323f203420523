"""Hard negatives by exact integer scores, with angles to reference directions deciding what is scored.

* Every vector becomes integers, with its norm and its angles to a few reference
  directions stored beside it.  Two vectors' angle lies between the difference and
  the sum of their angles to any one reference, so the references together give an
  interval for their cosine; times the norms, and widened by what rounding can
  do, an interval for their score.
* Rows and anchors are dealt into blocks by a hash.  A block of anchors meets
  every block of rows; a cell of that grid is one row, so no task holds more than
  a few blocks.
* First sweep: per anchor and cell, rows of its label whose upper bound reaches
  the N-th best lower bound are scored; the N best of all cells are its positives.
* Second sweep: the positives give windows of scores.  Per cell, rows of other
  labels whose interval overlaps a window are scored; the first few inside each
  window go on, and the first few of all cells are the result.

The bounds only save work; every returned score is an integer inner product and
results are exact.  The references are REFERENCES rows with the least hash.

Defined results: rows with a NULL label, vec_id or vector, or with a component
that is NULL or not finite take no part, nor do rows whose integer norm squared
reaches 2^62 (their scores fit no long); vectors of different length are compared
over the shorter; repeated rows are rows of their own; ties go by vec_id; anchors
without a positive, and positives without a negative, give no row; an empty table
gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm.common import shipped, stored, table
from occrisk.operators.ranking import top_n

REFERENCES = 8
ROW_BLOCK = 4096
ANCHOR_BLOCK = 512
POSITIVES, NEGATIVES = 5, 3
# A negative's score times 100 lies between these multiples of its positive's.
LOW, HIGH = 50, 95
# Radians and share of a score by which angles and bounds are widened: 32-bit angles are right to 3e-7.
ANGLE_SLACK, SCORE_SLACK = 2e-6, 1e-9
_LIMIT = float(2**62)


def prepared(vectors: DataFrame) -> DataFrame:
    """(row, vec_id, label, v): rows that take part, with integer components."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + F.pow(F.floor(F.lit(256.0) * x.cast("double")).cast("double"), F.lit(2.0)))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    label, vec_id = F.col("label").cast("long"), F.col("vec_id").cast("long")
    usable = vec_id.isNotNull() & label.isNotNull() & F.coalesce(finite, F.lit(False))
    kept = vectors.select(vec_id.alias("vec_id"), label.alias("label"), "embedding").where(usable).where(squares < _LIMIT)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", moved.alias("label"), whole.alias("v"))


# ---------------------------------------------------------------- blocks


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists as rows of a matrix, short ones filled with zeros."""
    sizes = np.asarray(lists.value_lengths())
    flat = np.asarray(lists.flatten(), np.int64)
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _angles(v: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of each row to each reference; a quarter turn for zero vectors, whose score bounds are zero anyway."""
    width = max(v.shape[1], references.shape[1])
    wide = np.zeros((len(v), width))
    wide[:, : v.shape[1]] = v
    out = np.zeros((references.shape[0], width))
    out[:, : references.shape[1]] = references
    cosines = wide @ out.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1)).astype(np.float32)


_BLOCK_FIELDS = ["n", "rows", "ids", "labels", "norms", "angles", "kind", "v"]
_BLOCK_SCHEMA = "n int, rows binary, ids binary, labels binary, norms binary, angles binary, kind string, v binary"


def _packer(references: np.ndarray) -> Callable:
    def pack(group: pa.Table) -> pa.Table:
        own = group.combine_chunks().sort_by("row")
        v = _matrix(own["v"].combine_chunks())
        norms = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        most = int(np.abs(v).max(initial=0))
        kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
        column = lambda name: np.asarray(own[name], np.int64).tobytes()
        values = [len(v), column("row"), column("vec_id"), column("label"), norms.tobytes(), _angles(v, norms, references).tobytes(), np.dtype(kind).str, v.astype(kind).tobytes()]
        out = {"block": pa.array([own["block"][0].as_py()], pa.int64())} | dict(zip(_BLOCK_FIELDS, ([x] for x in values)))
        if "positives" in own.schema.names:
            scores = np.full((len(v), POSITIVES), np.iinfo(np.int64).min)
            ids = np.zeros((len(v), POSITIVES), np.int64)
            for n, found in enumerate(own["positives"].to_pylist()):
                for p in found or []:
                    scores[n, p["rank"] - 1], ids[n, p["rank"] - 1] = p["score"], p["id"]
            out |= {"scores": [scores.tobytes()], "positive_ids": [ids.tobytes()]}
        return pa.table(out).cast(pa.schema([("block", pa.int64()), ("n", pa.int32()), *[(f, pa.string() if f == "kind" else pa.binary()) for f in list(out)[2:]]]))

    return pack


def _blocks(rows: DataFrame, size: int, count: int, references: np.ndarray, label: str) -> tuple[DataFrame, int]:
    """Rows in blocks of about ``size``, dealt by a hash of the row; one row per block."""
    number = max(1, -(-count // size))
    schema = f"block bigint, {_BLOCK_SCHEMA}" + (", scores binary, positive_ids binary" if "positives" in rows.columns else "")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(number)))
    return stored(dealt.groupBy("block").applyInArrow(_packer(references), schema), label), number


def _cells(anchors: DataFrame, rows: DataFrame, number: int) -> DataFrame:
    """Every block of anchors beside every block of rows, one cell a row."""
    far = rows.select(*[F.col(c).alias(f"r_{c}") for c in rows.columns])
    near = anchors.select(*[F.col(c).alias(f"a_{c}") for c in anchors.columns])
    grid = anchors.select(F.col("block").alias("g_a"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(number - 1).cast("long"))).alias("g_r"))
    cells = grid.join(far, F.col("g_r") == F.col("r_block")).join(near, F.col("g_a") == F.col("a_block"))
    return cells.repartition("g_a", "g_r")


class Block:
    """One side of a cell."""

    def __init__(self, cell: dict, side: str):
        get = lambda name, kind: np.frombuffer(cell[f"{side}_{name}"], kind)
        self.n = cell[f"{side}_n"]
        self.rows, self.ids, self.labels = (get(x, np.int64) for x in ("rows", "ids", "labels"))
        self.norms = get("norms", np.float64)
        self.angles = get("angles", np.float32).reshape(self.n, -1)
        self.v = get("v", np.dtype(cell[f"{side}_kind"])).reshape(self.n, -1)
        if f"{side}_scores" in cell:
            self.scores, self.positive_ids = (get(x, np.int64).reshape(self.n, -1) for x in ("scores", "positive_ids"))


def bounds(anchor: Block, n: int, rows: Block) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that the stored angles leave between an anchor and each row."""
    low, high = np.zeros(rows.n, np.float32), np.full(rows.n, np.pi, np.float32)
    for own, other in zip(anchor.angles[n], rows.angles.T):
        np.maximum(low, np.abs(other - own), out=low)
        both = other + own
        np.minimum(high, np.minimum(both, np.float32(2 * np.pi) - both), out=high)
    least, most = np.cos(np.minimum(high + ANGLE_SLACK, np.pi)), np.cos(np.maximum(low - ANGLE_SLACK, 0))
    scale = anchor.norms[n] * rows.norms
    slack = 1 + scale * (SCORE_SLACK + 3e-7)  # cosines have 32 bits too
    return scale * least - slack, scale * most + slack


def scored(anchor: Block, n: int, rows: Block, chosen: np.ndarray) -> np.ndarray:
    """Integer scores of chosen rows; in doubles where these hold every partial sum exactly."""
    width = min(anchor.v.shape[1], rows.v.shape[1])
    exact = anchor.norms[n] * rows.norms.max(initial=0) < 2**52
    kind = np.float64 if exact else np.int64
    own, other = anchor.v[n, :width].astype(kind), rows.v[chosen, :width].astype(kind)
    return (other @ own).astype(np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores; ties by id, then row."""
    if scores.size > n:
        least = np.partition(scores, -n)[-n]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(scores.size)
    return near[np.lexsort((rows[near], ids[near], -scores[near]))][:n]


_POSITIVE_SCHEMA = "anchor bigint, anchor_id bigint, id bigint, row bigint, score bigint"
_NEGATIVE_SCHEMA = "anchor bigint, anchor_id bigint, positive_rank int, positive_id bigint, positive_score bigint, negative_id bigint, negative_row bigint, negative_score bigint"


def _batch(parts: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = zip(*parts) if parts else [[] for _ in fields]
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.empty(0), kinds[k]) for c, (_, k) in zip(map(list, columns), fields)], names=[f for f, _ in fields])


def _positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            cell = batch.slice(k, 1).to_pylist()[0]
            anchors, rows, parts = Block(cell, "a"), Block(cell, "r"), []
            for n in range(anchors.n):
                same = np.flatnonzero((rows.labels == anchors.labels[n]) & (rows.rows != anchors.rows[n]))
                if not same.size:
                    continue
                low, high = bounds(anchors, n, rows)
                least = np.partition(low[same], -POSITIVES)[-POSITIVES] if same.size > POSITIVES else -np.inf
                chosen = same[high[same] >= least]
                scores = scored(anchors, n, rows, chosen)
                best = _first(scores, rows.ids[chosen], rows.rows[chosen], POSITIVES)
                at = chosen[best]
                parts.append((np.full(at.size, anchors.rows[n]), np.full(at.size, anchors.ids[n]), rows.ids[at], rows.rows[at], scores[best]))
            yield _batch(parts, _POSITIVE_SCHEMA)


def _negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            cell = batch.slice(k, 1).to_pylist()[0]
            anchors, rows, parts = Block(cell, "a"), Block(cell, "r"), []
            for n in range(anchors.n):
                # a window from LOW to HIGH percent holds scores of positives at or above zero only
                windows = [(p, int(s)) for p, s in enumerate(anchors.scores[n]) if s >= 0]
                other = np.flatnonzero(rows.labels != anchors.labels[n])
                if not windows or not other.size:
                    continue
                low, high = bounds(anchors, n, rows)
                low, high = low[other], high[other]
                overlap = np.zeros(other.size, bool)
                for _, s in windows:
                    overlap |= (100 * high >= LOW * s) & (100 * low <= HIGH * s)
                chosen = other[overlap]
                scores = scored(anchors, n, rows, chosen)
                for p, s in windows:
                    # whole scores inside the window, without products that pass 64 bits
                    inside = np.flatnonzero((scores >= -(-LOW * s // 100)) & (scores <= HIGH * s // 100))
                    best = inside[_first(scores[inside], rows.ids[chosen[inside]], rows.rows[chosen[inside]], NEGATIVES)]
                    at, full = chosen[best], lambda x, size=best.size: np.full(size, x)
                    parts.append((full(anchors.rows[n]), full(anchors.ids[n]), full(p + 1), full(anchors.positive_ids[n, p]), full(s), rows.ids[at], rows.rows[at], scores[best]))
            yield _batch(parts, _NEGATIVE_SCHEMA)


# ---------------------------------------------------------------- results


def _references(rows: DataFrame, number: int) -> np.ndarray:
    """Unit vectors of the rows with the least hash of their components: a fit on a fixed number of rows."""
    few = rows.where(F.exists("v", lambda x: x != 0)).orderBy(F.xxhash64("v"), "row").limit(number).select("v").collect()
    width = max([len(r["v"]) for r in few], default=1)
    out = np.zeros((max(1, len(few)), width))
    for n, r in enumerate(few):
        out[n, : len(r["v"])] = r["v"]
    out[:, 0] += (out == 0).all(axis=1)
    return out / np.sqrt((out**2).sum(axis=1))[:, None]


def hard_negatives(vectors: DataFrame, is_anchor: Column | None = None, row_block: int = ROW_BLOCK, anchor_block: int = ANCHOR_BLOCK, references: int = REFERENCES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank.

    ``is_anchor`` tells the query set by ``vec_id`` and ``label``.
    """
    shipped(vectors.sparkSession)
    is_anchor = F.col("vec_id") % 50 == 0 if is_anchor is None else is_anchor
    rows = stored(prepared(vectors), "vectors")
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors")).first()
    directions = _references(rows, references)
    blocks, number = _blocks(rows, row_block, counts["rows"], directions, "row-blocks")
    anchors = rows.where(is_anchor)
    first, _ = _blocks(anchors, anchor_block, counts["anchors"], directions, "anchor-blocks")
    near = _cells(first, blocks, number).mapInArrow(_positives, _POSITIVE_SCHEMA)
    positives = stored(top_n(near, ["anchor"], [F.desc("score"), F.asc("id"), F.asc("row")], POSITIVES, "rank"), "positives")
    windows = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct(F.col("rank").cast("int").alias("rank"), "id", "score")).alias("positives"))
    second, _ = _blocks(anchors.join(windows, "row"), anchor_block, counts["anchors"], directions, "anchor-windows")
    found = _cells(second, blocks, number).mapInArrow(_negatives, _NEGATIVE_SCHEMA)
    order = [F.desc("negative_score"), F.asc("negative_id"), F.asc("negative_row")]
    best = top_n(found, ["anchor", "positive_rank"], order, NEGATIVES, "rank")
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score", "positive_rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))
