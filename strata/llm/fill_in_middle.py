"""Fill-in-middle documents by rotating blocks in place.

A text is cut into prefix, middle and suffix, and its parts are put into another order, each behind
its sentinel: ``psm`` is prefix, suffix, middle, ``spm`` is suffix, prefix, middle. ``plain`` texts
stay as they are. One buffer per text:

1. Its code points are scanned once for the bytes at which the cuts lie.
2. The sentinels are inserted where their parts begin: prefix, middle, suffix, in the text's order.
3. Neighbouring blocks change places by a rotation: each is reversed, then both together. Middle and
   suffix change places for both forms, prefix and suffix then for ``spm``.

``restored`` undoes the rotations in the opposite order and takes the sentinels out again. It needs
nothing but the output and its form.

The cuts and the form come from a hash of seed and id alone, so reruns and other partitionings agree.
Documents are independent of each other: nothing is shuffled or gathered. Defined cases: a null text
counts as empty; empty texts, and texts that hold a sentinel, are plain; a null id counts as an empty
string in the hash and stays null; equal cuts leave the middle empty; long texts are taken whole;
repeated rows give the same output; an empty table gives none; columns other than id and text are
never read, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SENTINELS = ("<P>", "<S>", "<M>")
PERCENT = 90      # of the texts are transformed
SPM_PERCENT = 20  # of these have the suffix first
SEED = 1
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(seed: int, key: object) -> tuple[int, int, int, int]:
    """Four unsigned 32-bit integers from seed and id."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digest[i:i + 8], 16) for i in range(0, 32, 8))


def exchange(buffer: bytearray, begin: int, middle: int, end: int) -> None:
    """Let buffer[begin:middle] and buffer[middle:end] change places, by three reversals."""
    _reverse(buffer, begin, middle)
    _reverse(buffer, middle, end)
    _reverse(buffer, begin, end)


def _reverse(buffer: bytearray, begin: int, end: int) -> None:
    block = np.frombuffer(buffer, np.uint8)[begin:end]
    half = len(block) // 2
    # The halves trade places, so that no more than one of them is copied.
    first = block[:half].copy()
    block[:half] = block[:len(block) - half - 1:-1]
    block[len(block) - half:] = first[::-1]


def _byte_of(data: bytes, points: list[int]) -> list[int]:
    """Where the code points begin, of which there are as many as bytes that continue none."""
    if max(points) == 0 or data.isascii():
        return points
    begins = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.append(begins, len(data))[points].tolist()


def cut(n: int, seed: int, key: object, percent: int, spm_percent: int) -> tuple[str, int, int]:
    """Form, begin and end of the middle of a text of ``n`` code points."""
    h1, h2, h3, h4 = draws(seed, key)
    if n == 0 or h3 % 100 >= percent:
        return PLAIN, 0, 0
    begin, end = sorted((h1 % (n + 1), h2 % (n + 1)))
    return SPM if h4 % 100 < spm_percent else PSM, begin, end


def rearranged(data: bytes, form: str, begin: int, end: int, sentinels: tuple[bytes, bytes, bytes]) -> bytes:
    """The text, cut at two of its bytes, in the order of the form."""
    prefix, suffix, middle = sentinels
    buffer = bytearray(data)
    buffer[end:end] = suffix
    buffer[begin:begin] = middle
    buffer[0:0] = prefix
    of_middle = begin + len(prefix)
    of_suffix = end + len(prefix) + len(middle)
    exchange(buffer, of_middle, of_suffix, len(buffer))
    if form == SPM:
        exchange(buffer, 0, of_middle, of_middle + len(buffer) - of_suffix)
    return bytes(buffer)


def put_back(output: bytes, form: str, sentinels: tuple[bytes, bytes, bytes]) -> bytes:
    """The text of an output."""
    if form == PLAIN:
        return output
    prefix, suffix, middle = sentinels
    buffer = bytearray(output)
    of_middle = output.index(middle)
    if form == SPM:
        second = output.index(prefix)
        exchange(buffer, 0, second, of_middle)
        of_suffix = of_middle - second
    else:
        of_suffix = output.index(suffix)
    exchange(buffer, of_suffix, of_middle, len(buffer))
    of_suffix += len(buffer) - of_middle
    of_middle = of_suffix - (len(buffer) - of_middle)
    del buffer[of_suffix:of_suffix + len(suffix)]
    del buffer[of_middle:of_middle + len(middle)]
    del buffer[:len(prefix)]
    return bytes(buffer)


def _checked(sentinels: tuple[str, str, str]) -> tuple[tuple[bytes, bytes, bytes], re.Pattern]:
    """The sentinels as bytes; none may lie in another, nor begin in one and end beyond it."""
    for x in sentinels:
        for y in sentinels:
            overlapping = any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y))))
            if not x or (x is not y and x in y) or overlapping or len(set(sentinels)) < 3:
                raise ValueError(f"sentinels must be told apart: {sentinels}")
    return tuple(x.encode("utf-8") for x in sentinels), re.compile("|".join(map(re.escape, sentinels)))


def fill_in_middle(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = SEED,
    percent: int = PERCENT,
    spm_percent: int = SPM_PERCENT,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """One row per row: id, ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    ``n`` counts the text's code points; the two others are null for plain texts. ``sentinels`` are
    those of prefix, suffix and middle.
    """
    marks, sentinel = _checked(sentinels)
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [[] for _ in names[1:]]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                form, begin, end = cut(len(text), seed, key, percent, spm_percent)
                if form == PLAIN or sentinel.search(text):
                    row = len(text), PLAIN, None, None, text
                else:
                    data = text.encode("utf-8", "surrogatepass")
                    made = rearranged(data, form, *_byte_of(data, [begin, end]), marks)
                    row = len(text), form, begin, end - begin, made.decode("utf-8", "surrogatepass")
                for column, x in zip(columns, row):
                    column.append(x)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns, kinds)], names
            )

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    made = rows.mapInArrow(
        transform, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    )
    return made.withColumnRenamed("id", id_column)


def restored(made: DataFrame, *, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """The rows with ``restored``, the text that ``output`` was made from, told by it and ``form``."""
    marks, _ = _checked(sentinels)
    schema = made.withColumn("restored", F.lit("")).schema

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("output").to_pylist(), batch.column("form").to_pylist())
            texts = [
                put_back(output.encode("utf-8", "surrogatepass"), form, marks).decode("utf-8", "surrogatepass")
                for output, form in pairs
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], schema.names
            )

    return made.mapInArrow(restore, schema)
