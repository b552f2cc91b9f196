"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import os
import string
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import folders


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other letter as it is; null counts as empty.

    ``lower`` folds A-Z only where a text is plain ASCII, and is much faster than ``translate``.
    """
    text = F.coalesce(text, F.lit(""))
    folded = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def written(rows: DataFrame) -> DataFrame:
    """The rows as a table in the folder that the cluster shares: cuts lineage, survives executors."""
    spark = rows.sparkSession
    path = folders.scratch(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def small(rows: DataFrame, most: int) -> DataFrame:
    """Marked for broadcast if there are at most ``most`` rows, which are counted; else as it is."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, unless it is installed.

    On a cluster the package goes along with the job, as by ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def free_name(columns: list[str], wish: str) -> str:
    """A name that none of the columns has, in any case."""
    taken = {x.lower() for x in columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


_TABLES: dict[str, dict] = {}


def worker_tables(owner: str) -> dict:
    """What a module keeps in a Python worker from task to task."""
    return _TABLES.setdefault(owner, {})


def drop_tables() -> None:
    for tables in _TABLES.values():
        tables.clear()


def lean(function: Callable, *, alone: bool = False) -> Callable:
    """A function over Arrow batches that gives freed memory back to the system after each of them.

    A Python worker outlives its task and waits for others. What its allocators keep meanwhile would
    stand beside what the executor needs for stages without Python. ``alone`` is for functions that
    use none of the worker's tables: those that operators before have left are dropped first.
    """

    def each(batches: Iterator) -> Iterator:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def run(batches: Iterator) -> Iterator:
        if alone:
            drop_tables()
            give_back()
        yield from function(each(batches))
        give_back()

    return run


def give_back() -> None:
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL(None)
    except (OSError, TypeError):
        return None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_chunks(column, size: int = 1 << 20) -> Iterator[tuple[int, list[str | None]]]:
    """Parts of an Arrow column of texts, with where they begin; a long text is one of its own.

    Only a part's texts become Python's at a time.
    """
    import pyarrow.compute as pc

    yield from _chunks(column, pc.binary_length(column), size)


def character_chunks(column, size: int) -> Iterator[tuple[int, list[str | None]]]:
    """As ``text_chunks``, by characters."""
    import pyarrow.compute as pc

    yield from _chunks(column, pc.utf8_length(column), size)


def _chunks(column, lengths, size: int) -> Iterator[tuple[int, list[str | None]]]:
    import numpy as np
    import pyarrow.compute as pc

    upto = np.cumsum(pc.fill_null(lengths, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(upto):
        before = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + size, "right")))
        yield begin, column.slice(begin, end - begin).to_pylist()
        begin = end
