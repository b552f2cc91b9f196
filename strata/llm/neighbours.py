"""Approximate nearest neighbours of a stated query set, over all rows of a table of vectors.

Queries go to the executors in blocks of at most ``QUERY_BLOCK``, whatever their number. For each
block, every task searches all of its vectors, chunk by chunk (see ``collision_search``; a chunk's sorted
arrays are built again for each block, which takes a small part of the time of its search), and keeps
the ``k`` nearest of each chunk; these are merged per query. No row is left out of the search, and no
pairs are formed beyond a query's own candidates.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components take no part;
a query is compared with vectors of its own length; rows with the query's own id are not its
neighbours; ties go to the smaller id; a query with fewer than ``k`` candidates gets all of them; repeated
rows are candidates each, and queries that repeat an id are answered each; vectors may be of any length,
long texts there are none; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import folders
from strata.llm.collision_search import Chunk, Settings

QUERY_BLOCK = 2_048
CHUNK_VECTORS = 16_384

_FOUND = "block int, query int, query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _search(queries, number: int, k: int, settings: Settings, chunk_vectors: int):
    names = ["block", "query", "query_id", "vec_id", "score"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for length, ids, vectors in _by_length(batch):
                parts = held.setdefault(length, [])
                parts.append((ids, vectors))
                if sum(len(x) for x, _ in parts) >= chunk_vectors:
                    yield from answers(held.pop(length))
        for parts in held.values():
            yield from answers(parts)

    def answers(parts: list) -> Iterator[pa.RecordBatch]:
        ids, vectors = np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])
        chunk, rows = Chunk(ids, vectors, settings), []
        for i, (query_id, query) in enumerate(queries.value):
            if len(query) == vectors.shape[1]:
                near, score = chunk.nearest(query_id, query, k)
                rows += zip([number] * len(near), [i] * len(near), [query_id] * len(near), near, score)
        columns = list(zip(*rows)) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return search


def _by_length(batch: pa.RecordBatch):
    """Ids and matrices of the vectors of a batch, by their length."""
    lists = batch.column(1)
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        place = (ends[at] - length)[:, None] + np.arange(length)
        yield int(length), ids[at], values[place]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 10,
    settings: Settings = Settings(),
    query_block: int = QUERY_BLOCK,
    chunk_vectors: int = CHUNK_VECTORS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's nearest vectors."""
    spark = vectors.sparkSession
    rows = vectors.withColumn("__is_query", is_query).select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"), "__is_query",
    ).filter(F.col("id").isNotNull() & usable(F.col("vector")))
    asked = rows.filter("__is_query").select("id", "vector")
    n_blocks = -(-asked.count() // query_block)
    path = folders.scratch(spark)
    spark.createDataFrame([], _FOUND).write.parquet(path)
    of_block = F.pmod(F.xxhash64("id", "vector"), F.lit(max(1, n_blocks)))
    for number in range(n_blocks):
        block = asked.filter(of_block == number).orderBy("id", "vector").collect()
        shared = spark.sparkContext.broadcast([(x.id, np.array(x.vector)) for x in block])
        search = _search(shared, number, k, settings, chunk_vectors)
        rows.select("id", "vector").mapInArrow(search, _FOUND).write.mode("append").parquet(path)
    found = spark.read.schema(_FOUND).parquet(path)
    order = Window.partitionBy("block", "query").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
