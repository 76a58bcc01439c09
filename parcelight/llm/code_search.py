"""Exact nearest binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension: set where the value is above zero. Codes
are cut into segments of 16 bits and indexed by each of them. A query looks up its own segments
first, then segments one bit away, two bits, and so on. A code at distance d has a
segment within floor(d / segments) bits of the query's, so after radius s every code
closer than segments * (s + 1) has been seen; the search of a query ends when its
k-th verified distance lies below that.

Rows are dealt into blocks of at most about ``BLOCK_ROWS``, queries into blocks of
``BLOCK_QUERIES``, and each pair of blocks is one task's work with an index over
every row of its block; per query k candidates leave it, and the best k of all blocks are
the answer. Nothing is sampled and equal distances are ordered by id.

Defined cases: a null vector has no code, neither searches nor is found; a null or NaN
value is a clear bit, vectors shorter than the code too; longer ones are cut to
its width, the width of the table's longest vector; repeated ids are rows of their
own, found and asking: each asking row has a list; with fewer than k rows all are returned; an empty table gives an empty result.
A query row finds itself like any other row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelight.llm.common import store

SEGMENT_BITS = 16
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4_096


def _masks() -> list[np.ndarray]:
    """Segment differences by number of set bits."""
    every = np.arange(1 << SEGMENT_BITS, dtype=np.uint32)
    weight = np.bitwise_count(every)
    return [every[weight == w] for w in range(SEGMENT_BITS + 1)]


class MultiIndex:
    """Codes, as (n, segments) of 16-bit numbers, sorted by each segment."""

    masks: list[np.ndarray] | None = None

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        if MultiIndex.masks is None:
            MultiIndex.masks = _masks()
        self.codes, self.ids = codes, ids
        self.rows, self.starts = [], []
        for s in range(codes.shape[1]):
            order = np.argsort(codes[:, s], kind="stable")
            bounds = np.zeros((1 << SEGMENT_BITS) + 1, dtype=np.int64)
            np.cumsum(np.bincount(codes[:, s], minlength=1 << SEGMENT_BITS), out=bounds[1:])
            self.rows.append(order)
            self.starts.append(bounds)

    def nearest(self, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k nearest, by distance and id."""
        segments = self.codes.shape[1]
        found = np.zeros(len(self.codes), dtype=bool)
        rows = np.zeros(0, dtype=np.int64)
        distances = np.zeros(0, dtype=np.int64)
        for radius in range(SEGMENT_BITS + 1):
            fresh = []
            for s in range(segments):
                values = MultiIndex.masks[radius] ^ np.uint32(code[s])
                begin, end = self.starts[s][values], self.starts[s][values + 1]
                sizes = end - begin
                before = np.cumsum(sizes) - sizes
                places = np.repeat(begin - before, sizes) + np.arange(sizes.sum())
                fresh.append(self.rows[s][places])
            seen = np.zeros(len(self.codes), dtype=bool)
            seen[np.concatenate(fresh)] = True
            new = np.flatnonzero(seen & ~found)
            if len(new):
                found |= seen
                differing = np.bitwise_count(self.codes[new] ^ code).sum(axis=1, dtype=np.int64)
                rows, distances = np.r_[rows, new], np.r_[distances, differing]
            if len(rows) >= k:
                order = np.lexsort((self.ids[rows], distances))[:k]
                rows_k, distances_k = rows[order], distances[order]
                if distances_k[-1] < segments * (radius + 1) or len(rows) == len(self.codes):
                    return rows_k, distances_k
        order = np.lexsort((self.ids[rows], distances))[:k]
        return rows[order], distances[order]


def codes_of(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Segments of the code as an array of 16-bit numbers."""

    def segment(at: int):
        bits = [
            F.when(F.coalesce(F.get(F.col(vector), F.lit(at + b)), F.lit(0.0)) > 0, F.lit(1 << b))
            .otherwise(F.lit(0))
            for b in range(min(SEGMENT_BITS, width - at))
        ]
        return sum(bits[1:], bits[0])

    return F.array(*[segment(at) for at in range(0, width, SEGMENT_BITS)])


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10,
    id_column: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, id, distance): the k rows of ``vectors`` nearest to each row
    of ``queries`` by Hamming distance; equal distances by id."""

    def coded(df: DataFrame, width: int) -> DataFrame:
        value = F.col(vector)
        clean = F.transform(value, lambda x: F.when(F.isnan(x), F.lit(0.0)).otherwise(x))
        given = df.where(value.isNotNull() & F.col(id_column).isNotNull()).select(
            F.col(id_column).cast("long").alias("_id"), clean.alias("_v")
        )
        return given.select("_id", codes_of(given, "_v", width).alias("_code"))

    measured = vectors.agg(
        F.max(F.size(vector)).alias("width"), F.count(vector).alias("rows")
    ).first()
    asked = queries.count()
    width = max(1, measured.width or 1)
    row_blocks = max(1, -(-measured.rows // block_rows))
    query_blocks = max(1, -(-asked // block_queries))
    every_query_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    every_row_block = F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))

    def dealt(blocks: int):
        return F.pmod(F.xxhash64("_id", "_code"), F.lit(blocks)).cast("int")

    rows = coded(vectors, width).withColumn("_rb", dealt(row_blocks)).withColumn(
        "_qb", every_query_block
    )
    asking = coded(queries, width).withColumn("_qb", dealt(query_blocks)).withColumn(
        "_rb", every_row_block
    )

    def tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        parts: list[tuple[int, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            codes = np.array(left["_code"].tolist(), dtype=np.uint16)
            ids = left["_id"].to_numpy()
            index = MultiIndex(codes, ids)
            asked_codes = np.array(right["_code"].tolist(), dtype=np.uint16)
            for query, asked_as, times, code in zip(
                right["_id"], right["_asked"], right["_times"], asked_codes
            ):
                found, distances = index.nearest(code, k)
                parts.append((query, asked_as, times, ids[found], distances))
        counts = [len(p[3]) for p in parts]
        whole = np.zeros(0, dtype=np.int64)
        return pd.DataFrame({
            "query_id": np.repeat(np.array([p[0] for p in parts], dtype=np.int64), counts),
            "asked": np.repeat(np.array([p[1] for p in parts], dtype=object), counts),
            "times": np.repeat(np.array([p[2] for p in parts], dtype=np.int64), counts),
            "id": np.concatenate([p[3] for p in parts]) if parts else whole,
            "distance": np.concatenate([p[4] for p in parts]) if parts else whole,
        })

    # A pair of blocks is little data and much work: as many tasks as pairs,
    # whatever their bytes.
    pairs = row_blocks * query_blocks
    # Queries that repeat are searched once and answered as often as they occur; a
    # query is its id and its code, so equal ids with other codes stay apart.
    asking = asking.groupBy("_rb", "_qb", "_id", "_code").agg(
        F.count(F.lit(1)).alias("_times")
    ).withColumn("_asked", F.array_join(F.col("_code").cast("array<string>"), ","))
    near = (
        asking.repartition(pairs, "_rb", "_qb").groupBy("_rb", "_qb")
        .cogroup(rows.repartition(pairs, "_rb", "_qb").groupBy("_rb", "_qb"))
        .applyInPandas(
            lambda right, left: tile(left, right),
            "query_id long, asked string, times long, id long, distance long",
        )
    )
    # k rows per query and block of rows meet here.
    best = Window.partitionBy("query_id", "asked").orderBy("distance", "id")
    return (
        near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
        .select("query_id", "rank", "id", "distance")
    )
