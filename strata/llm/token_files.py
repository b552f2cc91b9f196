"""Token files: ids of whole documents in blocks, in ascending order of document id.

Documents are range-partitioned by id, encoded and written block by block (see ``context_coder``).
A block holds whole documents; it is closed at ``BLOCK_IDS`` ids, so that a longer document is a
block of its own. A file is what Spark's parquet writer makes of the blocks: one row per block with
its partition, its place in it and its bytes. Each block is coded, checked and read by itself, so a
lost executor costs the blocks of its tasks.

Defined cases: a null text counts as empty, which is the end id alone; null ids come first; equal
ids and repeated rows are kept each, ordered by their text's hash; very long texts are taken whole, as a
block each; an empty table makes no block; other columns are
never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import context_coder, pretokens
from strata.llm.batch_encoder import batch_encoder
from strata.llm.packing import part_starts

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK_IDS = 1 << 22

_BLOCK = "part int, block int, at long, n_documents int, n long, data binary"


def write_token_files(
    documents: DataFrame,
    path: str,
    *,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    name = tokenizer or pretokens.public(TOKENIZER)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, end = batch_encoder(name), np.array([end_id], np.uint32)
        vocabulary = max(encoder.encoder.tokenizer.get_vocab_size(), end_id + 1)
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        names = ["part", "block", "at", "n_documents", "n", "data"]
        block, held, n, at = 0, [], 0, 0

        def closed() -> pa.RecordBatch:
            data = context_coder.pack_block(held, vocabulary)
            row = (part, block, at, len(held), n, data)
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

        for batch in batches:
            texts = encoder.encode([x or "" for x in batch.column(1).to_pylist()])
            for i, ids in zip(batch.column(0).to_pylist(), texts):
                ids = np.concatenate([ids, end])
                if held and n + len(ids) > block_ids:
                    yield closed()
                    block, held, n, at = block + 1, [], 0, at + n
                held.append((i, ids))
                n += len(ids)
        if held:
            yield closed()

    rows = documents.select(
        F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")
    )
    order = [F.asc_nulls_first("id"), F.xxhash64("text")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows.mapInArrow(encode, _BLOCK).write.parquet(path, compression="none")


def read_token_files(spark: SparkSession, path: str, *, id_column: str = "doc_id") -> DataFrame:
    """One row per document: id, ``start`` (ids before it), ``n_tokens`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    blocks = spark.read.schema(_BLOCK).parquet(path)
    starts = spark.sparkContext.broadcast(part_starts(blocks.select("part", "n")))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, at, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = context_coder.unpack_block(data)
                lengths = np.array([len(x) for _, x in found], np.int64)
                first = starts.value[part] + at + np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, _ in found], pa.int64()), pa.array(first), pa.array(lengths),
                    pa.array([x.astype("<u4").tobytes() for _, x in found], pa.binary()),
                ], [id_column, "start", "n_tokens", "ids"])

    return blocks.select("part", "at", "data").mapInArrow(
        decode, f"`{id_column}` long, start long, n_tokens long, ids binary"
    )
