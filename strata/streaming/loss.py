"""Lost offsets, found before a micro-batch is committed."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strata.operators.tail import TOPIC_PARTITION

if TYPE_CHECKING:
    import pandas as pd
    import pyarrow as pa

_RUNS = "topic string, partition int, low long, high long"


def guarded(rows: DataFrame, log: DataFrame, *, accept: bool = False) -> DataFrame:
    """The stream ``rows`` made from the stream ``log``, failing where the log leaves offsets out.

    A second branch over the topic, partition and offset of the same micro-batch adds no row. Each
    task reduces its offsets to runs, so that a topic partition that holds most of the log sends a
    few rows per task. The last offset of every topic partition is state of the stream: it is kept
    by batch in the checkpoint, and a batch that is done again sees what it saw before. A gap fails
    the batch's job, and the sink commits nothing of the batch.

    The batch fails again until the gap is accepted: with ``accept`` gaps are passed over. Offsets
    before the last one, as of records read again, are no gap. A stream keeps the check, with or
    without ``accept``, or does without it: its checkpoint holds the state. Offsets that a log
    leaves unused count as gaps: for a Kafka topic, ``failOnDataLoss`` decides instead.
    """
    offsets = log.select(
        log["topic"].cast("string"), log["partition"].cast("int"), log["offset"].cast("long")
    ).dropna()
    runs = offsets.mapInArrow(_runs, _RUNS)

    def check(key: tuple, found: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        last, gap = _follow(last, found)
        if gap and not accept:
            raise RuntimeError(f"{key[0]}, partition {key[1]}: nothing between the offsets {gap[0]} and {gap[1]}")
        state.update((last,))
        return iter(())

    checked = runs.groupBy(*TOPIC_PARTITION).applyInPandasWithState(
        check, rows.schema, "last long", "append", GroupStateTimeout.NoTimeout
    )
    return rows.unionByName(checked)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of consecutive offsets of each topic partition that a task reads."""
    import numpy as np
    import pyarrow as pa

    open_runs: dict[tuple[str, int], tuple[int, int]] = {}

    def made(runs: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*runs)) or [()] * 4
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["topic", "partition", "low", "high"])

    for batch in batches:
        topics = batch.column(0).dictionary_encode()
        topic, partition = topics.indices.to_numpy(), batch.column(1).to_numpy()
        offset, done = batch.column(2).to_numpy(), []
        order = np.lexsort((offset, partition, topic))
        topic, partition, offset = topic[order], partition[order], offset[order]
        breaks = (np.diff(topic) != 0) | (np.diff(partition) != 0) | (np.diff(offset) > 1)
        begins = np.flatnonzero(np.append(True, breaks)) if len(offset) else []
        ends = np.append(np.flatnonzero(breaks), len(offset) - 1)
        for begin, end in zip(begins, ends):
            key = topics.dictionary[int(topic[begin])].as_py(), int(partition[begin])
            low, high = int(offset[begin]), int(offset[end])
            known = open_runs.get(key)
            if known and known[0] <= low <= known[1] + 1:
                low, high = known[0], max(high, known[1])
            elif known:
                done.append((*key, *known))
            open_runs[key] = low, high
        if done:
            yield made(done)
    yield made([(*key, *run) for key, run in open_runs.items()])


def _follow(
    last: int | None, found: Iterator[pd.DataFrame]
) -> tuple[int | None, tuple[int, int] | None]:
    """The last offset after some runs, and the first two that have nothing in between."""
    import numpy as np

    frames = [(x["low"].to_numpy(), x["high"].to_numpy()) for x in found]
    low, high = (np.concatenate([x[i] for x in frames]) for i in (0, 1))
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    if last is not None:
        high = np.maximum(high, last)
    before = np.append(low[0] - 1 if last is None else last, high[:-1])
    gaps = np.flatnonzero(low > before + 1)
    gap = (int(before[gaps[0]]), int(low[gaps[0]])) if len(gaps) else None
    return int(high[-1]), gap
