"""Token counts by a map-side lookup in two tiers.

A byte-level BPE splits a text into pre-tokens (words, numbers, runs of signs or of blanks) and
merges within each of them, so a text has as many tokens as its pre-tokens have together.

- Tier 1 is one hash table for all workers: the token counts of the most frequent pre-tokens of the
  corpus, at most ``TABLE_SIZE`` of them, by their hashes.
- Tier 2 is a table in each worker. The library encodes what tier 1 lacks, once as long as the table
  remembers it; it is bounded and starts over when full.

Pre-tokens are never shuffled. Their frequencies are added up over all rows in each task, in a bounded
table that drops the rarest when it is full; of these, a task hands on its ``SUMMARY`` most frequent as
one packed row. The rows are merged ``FAN`` at a time until the driver takes at most ``FAN`` of them.
Frequencies decide how fast a pre-token is found, never a count.

Both passes find and look up the pre-tokens of many texts at once. Defined cases: a null text counts
as empty and has no tokens; texts are taken whole, also very long ones; of equally frequent pre-tokens
the first in byte order are broadcast, and the counts are the same either way; a null id stays null; repeated rows are counted each;
an empty table gives an empty result; columns other than id and text are never read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import pretokens
from strata.llm.batch_encoder import BatchEncoder
from strata.llm.common import lean, written
from strata.llm.hash_index import HashIndex, checks_of
from strata.llm.shingles import hash_spans

TABLE_SIZE = 32_768
CACHE_SIZE = 500_000
HELD = 1 << 18  # different pre-tokens that a task counts
SUMMARY = 4_096
FAN = 64
TOKENIZER = "byte_bpe_50k.json"

_PACKED = "part long, pieces binary, lengths binary, counts binary"


class Frequencies:
    """How often pre-tokens occur, in a bounded table; the rarest go when it is full."""

    def __init__(self, held: int):
        self.index = HashIndex(held.bit_length() + 1)
        self.keys = np.zeros(self.index.room, np.uint64)
        self.checks = np.zeros(self.index.room, np.int64)
        self.counts = np.zeros(self.index.room, np.int64)
        self.pieces: list[bytes] = []

    def add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        if not len(starts):
            return
        # The distinct pre-tokens of the chunk, with one place of each.
        keys, first, times = np.unique(hash_spans(data, starts, ends), return_index=True, return_counts=True)
        starts, ends = starts[first], ends[first]
        checks = checks_of(data, starts, ends)
        while len(keys):
            known = self.index.find(keys, checks)
            new = np.flatnonzero(known < 0)[:self.index.room // 2]
            if self.index.size + len(new) > self.index.room:
                self._drop_rarest()
                continue
            whole = data.tobytes()
            at = np.arange(self.index.size, self.index.size + len(new))
            self.keys[at], self.checks[at], self.counts[at] = keys[new], checks[new], 0
            self.pieces += [whole[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            self.index.add(keys[new], checks[new])
            known[new] = at
            here = np.flatnonzero(known >= 0)
            self.counts[known[here]] += times[here]
            left = np.flatnonzero(known < 0)
            keys, checks, times, starts, ends = (x[left] for x in (keys, checks, times, starts, ends))

    def most(self, n: int) -> np.ndarray:
        return np.argsort(-self.counts[:self.index.size], kind="stable")[:n]

    def _drop_rarest(self) -> None:
        kept = self.most(self.index.room // 4)
        self.pieces = [self.pieces[i] for i in kept.tolist()]
        self.index.clear()
        for column in (self.keys, self.checks, self.counts):
            column[:len(kept)] = column[kept]
        self.index.add(self.keys[:len(kept)], self.checks[:len(kept)])

    def top(self, n: int) -> Counter:
        return Counter({self.pieces[i]: int(self.counts[i]) for i in self.most(n).tolist()})


def _packed(part: int, counts: Counter, n: int) -> pa.RecordBatch:
    most = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]
    columns = (
        b"".join(x for x, _ in most), np.array([len(x) for x, _ in most], "<u4").tobytes(),
        np.array([x for _, x in most], "<i8").tobytes(),
    )
    arrays = [pa.array([part], pa.int64()), *(pa.array([x], pa.binary()) for x in columns)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "pieces", "lengths", "counts"])


def _unpacked(rows: list[tuple[bytes, bytes, bytes]]) -> Counter:
    found: Counter = Counter()
    for pieces, lengths, counts in rows:
        at = 0
        for length, n in zip(np.frombuffer(lengths, "<u4").tolist(), np.frombuffer(counts, "<i8").tolist()):
            found[bytes(pieces[at:at + length])] += n
            at += length
    return found


def frequent_pretokens(
    documents: DataFrame, path: str, *, text_column: str, table_size: int, held: int = HELD, summary: int = SUMMARY,
    fan: int = FAN,
) -> list[bytes]:
    """The most frequent pre-tokens of all rows, as the tasks' summaries tell."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        finder, seen = _finder(path), Frequencies(held)

        def other(i: int, text: str) -> None:
            pieces = [x.encode("utf-8", "surrogatepass") for y in finder.encoder.parts(text) for x in finder.encoder.pieces(y)]
            ends = np.cumsum([len(x) for x in pieces], dtype=np.int64)
            seen.add(np.frombuffer(b"".join(pieces), np.uint8), np.append(0, ends[:-1]) if pieces else ends, ends)

        for batch in batches:
            for chunk in finder.chunks([x or "" for x in batch.column(0).to_pylist()], other):
                data, _, starts, ends = finder.spans(chunk)
                seen.add(data, starts, ends)
        yield _packed(TaskContext.get().partitionId(), seen.top(summary), summary)

    def merge(rows: pa.Table) -> pa.Table:
        columns = [rows.column(x).to_pylist() for x in ("part", "pieces", "lengths", "counts")]
        return pa.Table.from_batches([_packed(columns[0][0] // fan, _unpacked(zip(*columns[1:])), summary)])

    texts = documents.select(F.col(text_column).alias("text"))
    found = written(texts.mapInArrow(lean(count), _PACKED))
    while found.count() > fan:
        found = written(found.groupBy(F.expr(f"part div {fan}")).applyInArrow(merge, _PACKED))
    counts = _unpacked([tuple(x) for x in found.select("pieces", "lengths", "counts").collect()])
    return [x for x, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:table_size]]


class Counts(HashIndex):
    """Token counts of pre-tokens, by their hashes."""

    def __init__(self, size: int):
        super().__init__(max(1, size).bit_length() + 1)
        self.counts = np.zeros(self.room, np.uint32)

    def learn(self, keys: np.ndarray, checks: np.ndarray, counts: np.ndarray) -> None:
        self.counts[self.size:self.size + len(keys)] = counts
        self.add(keys, checks)


class TwoTiers(BatchEncoder):
    """Tier 1, with tier 2 behind it for what it lacks."""

    def __init__(self, path: str, frequent: Counts, cache_size: int):
        super().__init__(path, table_bits=2)
        self.frequent, self.cache = frequent, Counts(cache_size)

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        found = np.zeros(len(texts), np.int64)

        def other(i: int, text: str) -> None:
            found[i] = len(self.single.encode(text)) // 4

        for held in self.chunks(texts, other):
            data, cuts, starts, ends = self.spans(held)
            if len(starts):
                upto = np.concatenate(([0], np.cumsum(self._counts(data, starts, ends))))
                found[[i for i, _ in held]] = np.diff(upto[np.searchsorted(starts, cuts)])
        return found

    def _counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        keys, checks = hash_spans(data, starts, ends), checks_of(data, starts, ends)
        entries = self.frequent.find(keys, checks)
        found = self.frequent.counts[entries].astype(np.int64)
        rest = np.flatnonzero(entries < 0)
        found[rest] = self._cached(data, keys[rest], checks[rest], starts[rest], ends[rest])
        return found

    def _cached(self, data, keys, checks, starts, ends) -> np.ndarray:
        entries = self.cache.find(keys, checks)
        missing = np.flatnonzero(entries < 0)
        if self.cache.size + len(missing) > self.cache.room:
            self.cache.clear()
            if len(keys) > self.cache.room:
                self.cache = Counts(len(keys))
            missing = np.arange(len(keys))
        while len(missing):  # more than once only where two pre-tokens share a hash
            _, first = np.unique(keys[missing], return_index=True)
            new = missing[first]
            made = self.merged(data, starts[new], ends[new])
            self.cache.learn(keys[new], checks[new], np.fromiter(map(len, made), np.uint32, len(new)))
            entries[missing] = self.cache.find(keys[missing], checks[missing])
            missing = missing[entries[missing] < 0]
        return self.cache.counts[entries]


_WORKER: dict[tuple, object] = {}


def _finder(path: str) -> BatchEncoder:
    if ("finder", path) not in _WORKER:
        _WORKER["finder", path] = BatchEncoder(path, table_bits=2)
    return _WORKER["finder", path]


def _tiers(frequent, path: str, cache_size: int) -> TwoTiers:
    key = (frequent.id, path, cache_size)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TwoTiers(path, frequent.value, cache_size)
    return _WORKER[key]


class _Shared:
    """A broadcast table with a name that workers know it by."""

    def __init__(self, spark, table: Counts):
        self._broadcast = spark.sparkContext.broadcast(table)
        self.id = self._broadcast._jbroadcast.id()

    def __getstate__(self):
        return {"_broadcast": self._broadcast, "id": self.id}

    @property
    def value(self) -> Counts:
        return self._broadcast.value


def _table(pieces: list[bytes], path: str) -> Counts:
    """Tier 1: the library's counts of the pre-tokens."""
    found = Counts(len(pieces))
    if pieces:
        data, ends = np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([len(x) for x in pieces])
        starts = np.append(0, ends[:-1])
        keys, checks = hash_spans(data, starts, ends), checks_of(data, starts, ends)
        _, first = np.unique(keys, return_index=True)
        counts = np.fromiter(map(len, _finder(path).merged(data, starts, ends)), np.uint32, len(pieces))
        found.learn(keys[first], checks[first], counts[first])
    return found


def token_counts(
    documents: DataFrame,
    *,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 1024,
    table_size: int = TABLE_SIZE,
    cache_size: int = CACHE_SIZE,
) -> DataFrame:
    """One row per row: id, ``n_bytes``, ``n_tokens`` and whether they exceed ``limit``."""
    path = tokenizer or pretokens.public(TOKENIZER)
    pieces = frequent_pretokens(documents, path, text_column=text_column, table_size=table_size)
    frequent = _Shared(documents.sparkSession, _table(pieces, path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiers = _tiers(frequent, path, cache_size)
        for batch in batches:
            n_bytes = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).cast(pa.int64())
            n_tokens = tiers.count([x or "" for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), n_bytes, pa.array(n_tokens, pa.int64())], [id_column, "n_bytes", "n_tokens"]
            )

    rows = documents.select(F.col(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    counted = rows.mapInArrow(lean(count), f"`{id_column}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
