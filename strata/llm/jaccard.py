"""Jaccard join of word shingles with filters under several global orders.

Two sets of similarity ``t`` or more share an element among the first ``n - ceil(t n) + 1`` of each,
whatever global order the elements are taken in. Candidates must do so under three orders: rare
shingles first, and two random orders. Only then are sets compared.

1. *Sets.* One row per document with the size and a 128-bit digest of its set. Equal sets are one
   class from here on; copies are not compared.
2. *Frequencies.* Each task packs the distinct shingles of its documents into one row per range of
   hashes. Ranges are added up, and what comes back to the documents are their shingles that two
   or more of them hold. A shingle that many documents of a task hold is sent once, so a common
   passage costs one entry per task. A document with too many shingles of its own cannot be
   similar to any other and goes no further: most of a corpus ends here.
3. *Candidates.* Documents meet by the shingles of their prefix under the first order. In each such
   bucket all are first compared with one of them, the one with the commonest shingles. What this
   links into one component is settled; the rest of a bucket is compared across components, each
   pair once, at its first common shingle, if it passes the other orders.
4. *Verification* is exact on the shingles' hashes, on sorted arrays. Links join components, and each document gets the
   smallest id in its component.

Nothing is capped: the buckets that are left after step 3 are compared in full.

Defined cases: texts without words (null, empty, blank) have an empty set and their own id as
component; fewer words than a shingle form one shingle; repeated rows and equal ids keep a row
each; a null id is ignored in the smallest id; very long texts are taken whole; an empty table gives an empty
result; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import give_back, lean, written
from strata.llm.components import components
from strata.llm.shingles import mix, shingle_sets

WIDTH = 4
PERCENT = 85
RANGE_SHINGLES = 1 << 22  # shingles of a range, on average
LEAST_RANGES = 1024
CHUNK_SHINGLES = 1 << 22  # shingles that a task packs at once
CHUNK_ROWS = 10_000
ROUNDS = 2

_LOW_BITS = 40  # of a hash are sent beside its range
_MANY = 0xFFFF
_ORDER_SEEDS = (101, 202, 303)
_PARITY_SEED, _PARITY_WORDS = 404, 16


def _digest(found: np.ndarray) -> tuple[int, int]:
    first, second = mix(found, 11), mix(found, 12)
    with np.errstate(over="ignore"):
        return int(first.sum().view(np.int64)), int(second.sum().view(np.int64))


def _needed(n, percent: int):
    """Smallest intersection of sets of sizes ``n`` and more that reaches ``percent``."""
    return (percent * n + 99) // 100


def shingle_digests(documents: DataFrame, id_column: str, text_column: str, width: int) -> DataFrame:
    """id, ``n`` and the digest ``v`` of each document's set."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _chunks(batch):
                sets = shingle_sets(rows.column(1).to_pylist(), width)
                pairs = [_digest(x) for x in sets]
                yield pa.RecordBatch.from_arrays([
                    rows.column(0), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([x[0] for x in pairs], pa.int64()),
                    pa.array([x[1] for x in pairs], pa.int64()),
                ], ["id", "n", "s1", "s2"])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    found = rows.mapInArrow(lean(digest, alone=True), f"id {kind}, n long, s1 long, s2 long")
    return found.select("id", "n", F.when(F.col("n") > 0, F.struct("s1", "s2")).alias("v"))


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with bounded numbers of rows and bytes; a long text is one of its own."""
    lengths = pa.compute.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy()
    at = 0
    while at < batch.num_rows:
        total = np.cumsum(lengths[at:at + CHUNK_ROWS])
        size = max(1, int(np.searchsorted(total, 6 * CHUNK_SHINGLES, "right")))
        yield batch.slice(at, size)
        at += size


def _low_bytes(tokens: np.ndarray) -> bytes:
    """The low 5 bytes of each hash."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_low(data: bytes) -> np.ndarray:
    low = np.frombuffer(data, np.uint8).reshape(-1, 5)
    whole = np.zeros((len(low), 8), np.uint8)
    whole[:, :5] = low
    return whole.view("<u8").ravel()


_PACKED = "key long, batch long, kind int, a binary, b binary, c binary"
_PACKED_NAMES = ["key", "batch", "kind", "a", "b", "c"]


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _PACKED_NAMES)


def _token(shingles: np.ndarray, range_bits: int) -> np.ndarray:
    """What stands for a shingle: its range and the low bits."""
    low = shingles & np.uint64((1 << _LOW_BITS) - 1)
    return ((shingles >> np.uint64(64 - range_bits)) << np.uint64(_LOW_BITS)) | low


def _pack(width: int, range_bits: int):
    """Shingles of a task's documents: kind 0 by range, kind 1 straight to the batch's own group."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in _chunks(batch):
                sets, seen = [], {}
                for x in shingle_sets(rows.column(0).to_pylist(), width):
                    if len(x) and (digest := _digest(x)) not in seen:
                        seen[digest] = len(x)
                        sets.append(_token(x, range_bits))
                if not sets:
                    continue
                yield _packed(list(_pack_chunk(sets, seen, number)))
                number += 1

    def _pack_chunk(sets, seen, number):
        tokens = np.concatenate(sets)
        of = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
        order = np.argsort(tokens, kind="stable")
        tokens, of = tokens[order], of[order]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        counts = np.diff(np.append(starts, len(tokens)))
        many = np.repeat(counts > 1, counts)
        info = np.array([(*digest, n) for digest, n in seen.items()], np.int64)
        yield -1 - number, number, 1, info.tobytes(), tokens[many].tobytes(), of[many].tobytes()
        distinct, counts, first = tokens[starts], counts, of[starts]
        cuts = np.searchsorted(
            distinct >> np.uint64(_LOW_BITS), np.arange((1 << range_bits) + 1, dtype=np.uint64)
        )
        filled = np.flatnonzero(np.diff(cuts))
        for key in filled:
            part = slice(cuts[key], cuts[key + 1])
            single = counts[part] == 1
            yield (
                int(key), number, 0, _low_bytes(distinct[part][single]), first[part][single].tobytes(),
                _low_bytes(distinct[part][~single]) + counts[part][~single].astype("<u4").tobytes(),
            )

    return pack


def _count_range(key: tuple, rows: pa.Table) -> pa.Table:
    """Kind 2: for each batch, its shingles of the range that others hold too, with frequencies."""
    number = key[0].as_py()
    if number < 0:
        return rows
    lows, docs, weights, sizes = [], [], [], []
    for a, b, c in zip(*(rows.column(x).to_pylist() for x in ("a", "b", "c"))):
        n_many = len(c) // 9
        lows += [_from_low(a), _from_low(c[:5 * n_many])]
        docs += [np.frombuffer(b, np.uint16), np.full(n_many, _MANY, np.uint16)]
        weights += [np.ones(len(a) // 5, np.uint32), np.frombuffer(c[5 * n_many:], "<u4")]
        sizes.append(len(a) // 5 + n_many)
    low, of, weight = np.concatenate(lows), np.concatenate(docs), np.concatenate(weights)
    del lows, docs, weights
    order = np.argsort(low, kind="stable")
    starts = np.flatnonzero(np.concatenate(([True], low[order][1:] != low[order][:-1])))
    totals = np.add.reduceat(weight[order], starts).astype(np.uint32)
    frequency = np.empty(len(low), np.uint32)
    frequency[order] = np.repeat(totals, np.diff(np.append(starts, len(low))))
    token = low | (np.uint64(number) << np.uint64(_LOW_BITS))
    found, at = [], 0
    for batch, size in zip(rows.column("batch").to_pylist(), sizes):
        shared = at + np.flatnonzero(frequency[at:at + size] > 1)
        at += size
        if len(shared):
            found.append((number, batch, 2, token[shared].tobytes(), of[shared].tobytes(),
                          frequency[shared].tobytes()))
    give_back()
    return pa.Table.from_batches([_packed(found)])


_SHARED = "s1 long, s2 long, n long, n_prefix int, weight double, shingles array<long>, parity array<long>"


def _shared_sets(percent: int):
    """Documents that may have a partner, with their shared shingles, the rarest first."""

    def assemble(rows: pa.Table) -> pa.Table:
        own = rows.filter(pa.compute.equal(rows.column("kind"), 1)).to_pylist()[0]
        info = np.frombuffer(own["a"], np.int64).reshape(-1, 3)
        many, of_many = np.frombuffer(own["b"], np.uint64), np.frombuffer(own["c"], np.uint16)
        replies = rows.filter(pa.compute.equal(rows.column("kind"), 2))
        read = lambda name, kind: [np.frombuffer(x, kind) for x in replies.column(name).to_pylist()]
        none = np.zeros(0, np.uint64)
        token = np.concatenate([none, *read("a", np.uint64)])
        of = np.concatenate([none.astype(np.uint16), *read("b", np.uint16)])
        frequency = np.concatenate([none.astype(np.uint32), *read("c", np.uint32)])
        order = np.argsort(token)
        repeated = frequency[order][np.searchsorted(token[order], many)] if len(many) else none
        single = np.isin(token, many, invert=True)
        token = np.concatenate([token[single], many])
        of = np.concatenate([of[single], of_many])
        frequency = np.concatenate([frequency[single], repeated.astype(np.uint32)])
        order = np.lexsort((mix(token, _ORDER_SEEDS[0]), frequency, of))
        token, of, frequency = token[order], of[order], frequency[order]
        cuts = np.searchsorted(of, np.arange(len(info) + 1))
        found = []
        for i, (s1, s2, n) in enumerate(info.tolist()):
            part = slice(cuts[i], cuts[i + 1])
            n_shared, needed = cuts[i + 1] - cuts[i], _needed(n, percent)
            if n_shared >= needed:
                weight = float(np.log(frequency[part]).sum()) / n
                found.append((
                    s1, s2, n, int(n_shared - needed + 1), weight, token[part].view(np.int64),
                    _parity(token[part]),
                ))
        columns, longs = list(zip(*found)) if found else [[]] * 7, pa.list_(pa.int64())
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64(), longs, longs]
        return pa.Table.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["s1", "s2", "n", "n_prefix", "weight", "shingles", "parity"],
        )

    return assemble


def _parity(tokens: np.ndarray) -> np.ndarray:
    """Whether each class of a hash holds an odd number of the set's elements, as bits.

    Two sets differ in at least as many elements as their bits differ in.
    """
    classes = mix(tokens, _PARITY_SEED) % np.uint64(64 * _PARITY_WORDS)
    odd = np.bincount(classes.astype(np.int64), minlength=64 * _PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _prefixes(shingles: np.ndarray, n_prefix: int) -> list[np.ndarray]:
    """Under the orders other than the first; shingles without a partner come before all."""
    shingles = shingles.view(np.uint64)
    return [
        shingles[np.argpartition(mix(shingles, seed), n_prefix - 1)[:n_prefix]]
        if n_prefix < len(shingles) else shingles
        for seed in _ORDER_SEEDS[1:]
    ]


def _verifier(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("l"), batch.column("r")
            sides = []
            for side in (left, right):
                lists, n_prefix = side.field("shingles"), side.field("n_prefix").to_pylist()
                values = [x.values.to_numpy() for x in lists]
                sides.append((values, n_prefix, side.field("n").to_pylist()))
            keep, last = [], (None, None)
            for i in range(batch.num_rows):
                (a, pa_, na), (b, pb, nb) = ((x[0][i], x[1][i], x[2][i]) for x in sides)
                if last[0] is not a:
                    last = (a, _prefixes(a, pa_))
                passed = all(
                    np.isin(x, y, assume_unique=True).any() for x, y in zip(last[1], _prefixes(b, pb))
                )
                common = len(np.intersect1d(a, b, assume_unique=True)) if passed else 0
                keep.append(100 * common >= percent * (na + nb - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    return verify


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a`` and ``b`` that are similar enough. ``a`` may be very frequent."""
    side = lambda name: F.struct("n", "n_prefix", "shingles").alias(name)
    left = sets.select(F.col("v").alias("a"), side("l"))
    right = sets.select(F.col("v").alias("b"), side("r"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "l", "r")
    v = "struct<s1:bigint,s2:bigint>"
    return written(both.mapInArrow(lean(_verifier(percent), alone=True), f"a {v}, b {v}"))


def shared_sets(
    documents: DataFrame, total: int, *, text_column: str, width: int, percent: int
) -> DataFrame:
    """One row per class of documents that may have a partner; see step 2."""
    ranges = max(LEAST_RANGES, total // RANGE_SHINGLES)
    range_bits = min(64 - _LOW_BITS, (ranges - 1).bit_length())
    texts = documents.select(F.col(text_column).alias("text"))
    packed = texts.mapInArrow(lean(_pack(width, range_bits), alone=True), _PACKED)
    counted = packed.groupBy("key").applyInArrow(_count_range, _PACKED)
    found = counted.groupBy("batch").applyInArrow(_shared_sets(percent), _SHARED)
    found = found.select(F.struct("s1", "s2").alias("v"), "n", "n_prefix", "weight", "shingles", "parity")
    return written(found.dropDuplicates(["v"]))


def _may_reach(n_a: str, n_b: str, apart: Column, percent: int) -> Column:
    """Whether sets of these sizes may be similar if ``apart`` elements, of both, have no partner."""
    low, high, both = F.least(n_a, n_b), F.greatest(n_a, n_b), F.col(n_a) + F.col(n_b)
    common = F.ceil(percent * both / (100 + percent) - 1e-9)
    return (100 * low >= percent * high) & (apart + 2 * common <= both)


def similar_components(sets: DataFrame, percent: int) -> DataFrame:
    """``vertex`` and ``root`` for the classes in ``sets`` that are linked to a smaller one."""
    # ``alone`` shingles of a set are no other's. They come first, so a shingle's place counts them.
    alone = F.col("n") - F.size("shingles")
    prefix = F.slice("shingles", F.lit(1), F.col("n_prefix"))
    postings = sets.select(
        "v", "n", "weight", alone.alias("alone"), F.posexplode(prefix).alias("place", "shingle")
    ).withColumn("place", F.col("place") + F.col("alone"))
    found = None
    links = []
    for _ in range(ROUNDS):
        # The commonest set of each bucket, leaving out what the round before has settled.
        if found is None:
            open_rows = postings.withColumn("root", F.col("v"))
        else:
            open_rows = _across(postings, found)
        lead = open_rows.groupBy("shingle").agg(
            F.max(F.struct("weight", "v", "n", "alone", "root")).alias("lead"), F.count("*").alias("size")
        ).filter("size > 1").select(
            "shingle", F.col("lead.v").alias("a"), F.col("lead.n").alias("n_a"),
            F.col("lead.alone").alias("alone_a"), F.col("lead.root").alias("root_a"),
        )
        pairs = open_rows.join(lead, "shingle").filter(
            (F.col("root") != F.col("root_a"))
            & _may_reach("n", "n_a", F.col("alone") + F.col("alone_a"), percent)
        ).select("a", F.col("v").alias("b")).distinct()
        links.append(_verified(written(pairs), sets, percent))
        found = written(components(_all(links, found)))
    rest = _across(postings, found).select("shingle", "place", "v", "root")
    # Pairs across components, each at its first common shingle under the first order. What lies
    # before it in either set has no partner, nor have shingles whose parities differ, which leaves
    # few pairs. The prefixes under the second order must meet, too.
    second = F.slice(F.transform(F.array_sort(F.transform(
        "shingles", lambda x: F.struct(F.xxhash64(x).alias("h"), x.alias("x"))
    )), lambda s: s["x"]), F.lit(1), F.col("n_prefix"))
    prefixes = sets.select(
        "v", "n", alone.alias("alone"), "parity", prefix.alias("first"), second.alias("second")
    )
    rest = written(rest.join(prefixes, "v"))
    l, r = rest.alias("l"), rest.alias("r")
    differing = F.col("l.alone") + F.col("r.alone")
    for i in range(_PARITY_WORDS):
        word = lambda side: F.get(f"{side}.parity", F.lit(i))
        differing = differing + F.bit_count(word("l").bitwiseXOR(word("r")))
    pairs = l.join(
        r,
        (F.col("l.shingle") == F.col("r.shingle"))
        & (F.col("l.v") < F.col("r.v"))
        & (F.col("l.root") != F.col("r.root"))
        & _may_reach("l.n", "r.n", F.col("l.place") + F.col("r.place"), percent)
        & _may_reach("l.n", "r.n", differing, percent)
        & (F.array_intersect("l.first", "r.first")[0] == F.col("l.shingle"))
        & F.arrays_overlap("l.second", "r.second"),
    ).select(F.col("l.v").alias("a"), F.col("r.v").alias("b"))
    links.append(_verified(written(pairs), sets, percent))
    return components(_all(links[-1:], found))


def _all(links: list[DataFrame], found: DataFrame | None) -> DataFrame:
    rows = links[0]
    for more in links[1:]:
        rows = rows.unionByName(more)
    if found is not None:
        rows = rows.unionByName(found.select(F.col("vertex").alias("a"), F.col("root").alias("b")))
    return rows


def _across(postings: DataFrame, found: DataFrame) -> DataFrame:
    """Postings with the root of their component, of buckets that hold more than one component."""
    rooted = postings.join(found.withColumnRenamed("vertex", "v"), "v", "left").withColumn(
        "root", F.coalesce("root", "v")
    )
    split = rooted.groupBy("shingle").agg(F.min("root").alias("x"), F.max("root").alias("y"))
    return rooted.join(split.filter("x <> y").select("shingle"), "shingle", "left_semi")


def similar_documents(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row: id, ``n_shingles`` and ``component_id``."""
    digests = written(shingle_digests(documents, id_column, text_column, width))
    total = digests.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    sets = shared_sets(documents, total, text_column=text_column, width=width, percent=percent)
    found = written(similar_components(sets, percent).select(F.col("vertex").alias("v"), "root"))
    rooted = digests.join(found, "v", "left").withColumn("root", F.coalesce("root", "v"))
    least = rooted.filter("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    result = rooted.join(written(least), "root", "left")
    return result.select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )
