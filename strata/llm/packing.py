"""Packing by concatenation: documents become one stream of ids, cut into windows of equal size.

1. Every task encodes its documents, ends each with the end id, and notes where the document starts
   among the ids of its own partition. The ids are written to the shared folder, so they are
   computed once.
2. The partitions' totals, one number each, give every partition its place in the stream by a
   prefix sum. A document then knows its place without any shuffle, and is cut at the window
   borders: a document that lies across borders gives one piece per window.

Only the last window of the whole stream is padded. Defined cases: a null text counts as empty, and
an empty text is the end id alone; texts are taken whole, however many windows they fill; repeated
rows and equal ids are packed each; an empty table gives no piece; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import pretokens
from strata.llm.batch_encoder import batch_encoder
from strata.llm.common import lean, text_chunks, written

TOKENIZER = "word_bpe_49k.json"
WINDOW = 4096
END_ID = 2
ROWS_AT_ONCE = 1000


def encoded(
    documents: DataFrame, path: str, *, id_column: str, text_column: str, end_id: int
) -> DataFrame:
    """``part``, ``at`` (ids of the partition before it), ``id``, ``n`` and ``ids`` of each document."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = batch_encoder(path), np.array([end_id], np.uint32)
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for begin, texts in text_chunks(batch.column(1)):
                starts, counts, ids = [], [], []
                for found in encoder.encode([x or "" for x in texts]):
                    found = np.concatenate([found, end])
                    narrow = found.astype("<u2" if found.max() < 1 << 16 else "<u4")
                    starts.append(at)
                    counts.append(len(found))
                    ids.append(narrow.tobytes())
                    at += len(found)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(texts), pa.int32()), pa.array(starts, pa.int64()),
                    batch.column(0).slice(begin, len(texts)), pa.array(counts, pa.int64()),
                    pa.array(ids, pa.binary()),
                ], ["part", "at", "id", "n", "ids"])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(lean(encode), f"part int, at long, id {kind}, n long, ids binary")


def part_starts(totals: DataFrame) -> dict[int, int]:
    """Where each partition starts, from ``part`` and its ``n``: one number per partition."""
    starts, at = {}, 0
    for part, n in sorted(map(tuple, totals.groupBy("part").agg(F.sum("n")).collect())):
        starts[part] = at
        at += n
    return starts


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows, which become Python's one after the other."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(at, ROWS_AT_ONCE)


def packed(
    documents: DataFrame,
    *,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``doc_tokens``, ``sequence_id``, ``offset``, ``ids``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    path = tokenizer or pretokens.public(TOKENIZER)
    rows = written(encoded(
        documents, path, id_column=id_column, text_column=text_column, end_id=end_id
    ))
    starts = documents.sparkSession.sparkContext.broadcast(part_starts(rows.select("part", "n")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        for batch in chain.from_iterable(map(_slices, batches)):
            columns = [[] for _ in names]
            part, at, n, ids = (batch.column(x).to_pylist() for x in ("part", "at", "n", "ids"))
            for i in range(batch.num_rows):
                first = starts.value[part[i]] + at[i]
                of = np.frombuffer(ids[i], "<u2" if len(ids[i]) == 2 * n[i] else "<u4").astype("<u4")
                a = first
                while a < first + n[i]:
                    b = min(first + n[i], (a // window + 1) * window)
                    piece = of[a - first:b - first].tobytes()
                    for column, x in zip(columns, (i, a - first, b - a, n[i], a // window, a % window, piece)):
                        column.append(x)
                    a = b
            kinds = [pa.int64()] * 6 + [pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            arrays[0] = batch.column("id").take(arrays[0])
            yield pa.RecordBatch.from_arrays(arrays, [id_column, *names[1:]])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        lean(cut), f"`{id_column}` {kind}, start long, length long, doc_tokens long, sequence_id long, "
        "offset long, ids binary",
    )
