"""Alignment of two tokenizers' ids for the same text, by merging the ends of their tokens.

Both vocabularies cut the same bytes, so their tokens are two sorted lists of ends. Merging the lists
cuts the bytes into *overlaps*: each lies in one token of A and one of B. Where both end, a *group*
ends: the fewest tokens of A and of B that cover the same bytes. The last token of A and the last of
B in a group are *linked*.

- The merge is divided as a path: equally spaced diagonals of the grid of both lists are searched by
  bisection, all at once, for the place where the path crosses them. The pieces between two of these
  places have equal work and are merged independently, however the tokens of the two sides are
  spread and however long a text is.
- Each piece emits its overlaps, one step each: A ends, B ends or both. A pair of equal ends that a
  diagonal has torn apart is put together again, and a group that begins in one piece goes on in the
  next, since groups are told from the joined steps.

The steps and ids are written once. Links are counted over the whole corpus, combined in each task
before the shuffle. The counts go back to the documents in slices of whole B ids, each of at most
``MOST_PAIRS`` pairs and broadcast; the documents' links are read once per slice. A slice is enough
for as many pairs, and the vocabularies bound their number. Nothing else is broadcast or collected
than a slice, and one number per B id.

Defined cases: texts that are null or empty, and those that either vocabulary does not give back byte
by byte, have no tokens, no group and no link; special strings are plain text; very long texts are
taken whole, their segments are encoded and merged in pieces; ties in counts are all highest; a null
id stays null; repeated rows are aligned and counted each; an empty table gives none; columns other
than id and text are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import pretokens
from strata.llm.batch_encoder import _SIGNS, BatchEncoder
from strata.llm.common import lean, text_chunks, written
from strata.llm.piece_encoder import piece_encoder

A_TOKENIZER = "byte_bpe_50k.json"
B_TOKENIZER = "piece_bpe_32k.model"
PIECE = 1 << 16  # steps of a piece
MOST_TOKENS = 1 << 20  # of rows that are counted together
MOST_PAIRS = 2_000_000
HELD_PAIRS = 1 << 19  # distinct pairs that a task adds up before it hands them on

A_ENDS, B_ENDS, BOTH_END = 1, 2, 3


def crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many ends of ``a`` are among the first ``diagonals`` of the merged ends; A's go first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (low < high).any():
        at = (low + high) // 2
        of_b = diagonals - at
        # Still to the left while A's next end is not behind the last one of B that is taken.
        inside = (at < high) & (of_b > 0)
        further = np.zeros(len(at), bool)
        further[inside] = a[at[inside]] <= b[of_b[inside] - 1]
        low, high = np.where(further, at + 1, low), np.where(further, high, at)
    return low


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The steps of one piece: which side ends at each of the ends of both."""
    steps = np.empty(len(a) + len(b), np.uint8)
    steps[np.arange(len(a)) + np.searchsorted(b, a, "left")] = A_ENDS
    at = np.arange(len(b)) + np.searchsorted(a, b, "right")
    steps[at] = B_ENDS
    if not len(a):
        return steps
    same = at[a[np.maximum(np.searchsorted(a, b, "right") - 1, 0)] == b]
    steps[same] = BOTH_END
    keep = np.ones(len(steps), bool)
    keep[same - 1] = False
    return steps[keep]


def merged(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> np.ndarray:
    """The steps of two sorted lists of ends, from independent pieces of equal work."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, piece), total)
    of_a = crossings(a, b, diagonals)
    of_b = diagonals - of_a
    pieces = [
        overlaps(a[i:k], b[j:m]) for i, k, j, m in zip(of_a[:-1], of_a[1:], of_b[:-1], of_b[1:])
    ]
    for n in range(1, len(pieces)):
        i, j = of_a[n], of_b[n]
        if i and j < len(b) and a[i - 1] == b[j]:  # A's end is the last step before, B's the first one here
            pieces[n - 1] = pieces[n - 1][:-1]
            pieces[n][0] = BOTH_END
    return np.concatenate(pieces) if pieces else np.zeros(0, np.uint8)


class _Side:
    """One vocabulary: ids of texts, and the bytes of ids."""

    def __init__(self, path: str):
        if path.endswith(".json"):
            encoder = plain_encoder(path)
            self.encode = lambda texts: encoder.encode([" " + x for x in texts])
            token_bytes = _decoded(encoder)
        else:
            encoder = piece_encoder(path)
            self.encode, token_bytes = encoder.encode, encoder.token_bytes()
        self.table = np.array(token_bytes, object)
        self.lengths = np.array([len(x) for x in token_bytes], np.int64)

    def gives_back(self, ids: np.ndarray, data: bytes) -> bool:
        return b"".join(self.table[ids].tolist()) == data


class PlainEncoder(BatchEncoder):
    """Takes special strings for ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.encoder = pretokens.Encoder(path)
        self.encoder.tokenizer.encode_special_tokens = True
        self.encoder.special, self.encoder._special = {}, None
        self.single = pretokens.CachedIds(self.encoder, 10_000)


def _decoded(encoder: BatchEncoder) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary, whose entries write bytes as signs."""
    byte_of = {chr(sign): byte for byte, sign in enumerate(_SIGNS.tolist())}
    tokenizer = encoder.encoder.tokenizer
    names = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [
        bytes(byte_of[c] for c in x) if all(c in byte_of for c in x) else x.encode("utf-8") for x in names
    ]


_WORKER: dict[str, object] = {}


def plain_encoder(path: str) -> PlainEncoder:
    if path not in _WORKER:
        _WORKER[path] = PlainEncoder(path)
    return _WORKER[path]


def _side(path: str) -> _Side:
    if ("side", path) not in _WORKER:
        _WORKER["side", path] = _Side(path)
    return _WORKER["side", path]


def _narrow(ids: np.ndarray) -> bytes:
    return ids.astype("<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u4" if len(data) == 4 * n and n else "<u2").astype(np.int64)


def _ends(ids: list[np.ndarray], side: _Side) -> np.ndarray:
    """The ends of all tokens, in the bytes of all texts one behind the other."""
    return np.cumsum(side.lengths[np.concatenate([np.zeros(0, np.int64), *ids])])


def align_texts(texts: list[str | None], a_side: _Side, b_side: _Side, piece: int = PIECE) -> list[tuple]:
    """(ids of A, ids of B, steps) of each text."""
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8))
    found: list[tuple] = [nothing] * len(texts)
    known = [i for i, text in enumerate(texts) if text]
    plain = [texts[i] for i in known]
    held = []
    for i, a, b in zip(known, a_side.encode(plain), b_side.encode(plain)):
        data = b" " + texts[i].encode("utf-8", "surrogatepass")
        if a_side.gives_back(a, data) and b_side.gives_back(b, data):
            held.append((i, a, b))
    a_ends, b_ends = _ends([x[1] for x in held], a_side), _ends([x[2] for x in held], b_side)
    steps = merged(a_ends, b_ends, piece)
    # Each text ends with a step in which both end.
    of_a = np.cumsum([len(x[1]) for x in held], dtype=np.int64)
    cuts = np.searchsorted(np.cumsum(steps & A_ENDS, dtype=np.int64), of_a[:-1]) + 1
    for (i, a, b), part in zip(held, np.split(steps, cuts)):
        found[i] = a, b, part
    return found


def aligned(
    documents: DataFrame,
    *,
    a_tokenizer: str | None = None,
    b_tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    piece: int = PIECE,
) -> DataFrame:
    """One row per row: ``id``, ``n_a``, ``n_b``, ``a_ids``, ``b_ids`` and ``steps``.

    Ids are little-endian unsigned integers of two bytes, or four where one needs them. A step is one
    byte per overlap: 1 where a token of A ends, 2 where one of B does, 3 where both do.
    """
    a_path = a_tokenizer or pretokens.public(A_TOKENIZER)
    b_path = b_tokenizer or pretokens.public(B_TOKENIZER)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = _side(a_path), _side(b_path)
        for batch in batches:
            for begin, texts in text_chunks(batch.column(1)):
                found = align_texts(texts, a_side, b_side, piece)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(begin, len(texts)),
                    pa.array([len(a) for a, _, _ in found], pa.int64()),
                    pa.array([len(b) for _, b, _ in found], pa.int64()),
                    pa.array([_narrow(a) for a, _, _ in found], pa.binary()),
                    pa.array([_narrow(b) for _, b, _ in found], pa.binary()),
                    pa.array([steps.tobytes() for _, _, steps in found], pa.binary()),
                ], ["id", "n_a", "n_b", "a_ids", "b_ids", "steps"])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(lean(align), f"id {kind}, n_a long, n_b long, a_ids binary, b_ids binary, steps binary")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a bounded number of tokens together; one of more tokens stands alone."""
    for batch in batches:
        upto = np.cumsum(batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy())
        begin = 0
        while begin < batch.num_rows:
            before = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, before + MOST_TOKENS, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


class _Batch:
    """Rows of an aligned table, their tokens one behind the other."""

    def __init__(self, batch: pa.RecordBatch):
        columns = {x: batch.column(x).to_pylist() for x in ("n_a", "n_b", "a_ids", "b_ids", "steps")}
        self.n_a, self.n_b = (np.array(columns[x], np.int64) for x in ("n_a", "n_b"))
        none = np.zeros(0, np.int64)
        self.a = np.concatenate([none, *map(_wide, columns["a_ids"], columns["n_a"])])
        self.b = np.concatenate([none, *map(_wide, columns["b_ids"], columns["n_b"])])
        steps = np.frombuffer(b"".join(columns["steps"]), np.uint8)
        sizes = np.array([len(x) for x in columns["steps"]], np.int64)
        both = np.flatnonzero(steps == BOTH_END)
        # The tokens that end a group, and the number of groups of each row.
        self.a_last = np.cumsum(steps & A_ENDS, dtype=np.int64)[both] - 1
        self.b_last = np.cumsum(steps >> 1, dtype=np.int64)[both] - 1
        self.n_groups = np.diff(np.searchsorted(both, np.concatenate(([0], np.cumsum(sizes)))))

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The linked ids."""
        return self.a[self.a_last], self.b[self.b_last]

    def group_texts(self) -> list[bytes]:
        """Each row's groups as ``a1,a2|b1;a3|b2,b3``."""
        comma, bar, semicolon = _names(max(self.a.max(initial=0), self.b.max(initial=0)))
        a_at, b_at = np.arange(len(self.a)), np.arange(len(self.b))
        # A's tokens stand behind those of B in earlier groups, B's behind those of A in theirs, too.
        b_before, a_upto = np.append(0, self.b_last + 1), np.append(self.a_last + 1, len(self.a))
        signs = np.empty(len(self.a) + len(self.b), object)
        of_a, of_b = comma[self.a], comma[self.b]
        of_a[self.a_last], of_b[self.b_last] = bar[self.a[self.a_last]], semicolon[self.b[self.b_last]]
        signs[a_at + b_before[np.searchsorted(self.a_last, a_at)]] = of_a
        signs[b_at + a_upto[np.searchsorted(self.b_last, b_at)]] = of_b
        signs = signs.tolist()
        cuts = np.append(0, np.cumsum(self.n_a + self.n_b)).tolist()
        return [b"".join(signs[x:y])[:-1] for x, y in zip(cuts, cuts[1:])]


def _names(most: int) -> tuple:
    """Ids up to ``most`` as text, with what follows them."""
    size = 1 << int(most).bit_length()
    if ("names", size) not in _WORKER:
        _WORKER["names", size] = tuple(
            np.array([f"{i}{sign}".encode() for i in range(size)], object) for sign in ",|;"
        )
    return _WORKER["names", size]


def _keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (b.astype(np.uint64) << np.uint64(32)) | a.astype(np.uint64)


def pair_counts(alignments: DataFrame) -> DataFrame:
    """How many links hold each pair of ids: ``a``, ``b``, ``n``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def made() -> pa.RecordBatch:
            arrays = [held & np.uint64(0xFFFFFFFF), held >> np.uint64(32), sums]
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], ["a", "b", "n"])

        for batch in _pieces(batches):
            a, b = _Batch(batch).links()
            keys = np.concatenate([held, _keys(a, b)])
            weights = np.concatenate([sums, np.ones(len(a), np.int64)])
            held, at = np.unique(keys, return_inverse=True)
            sums = np.zeros(len(held), np.int64)
            np.add.at(sums, at, weights)
            if len(held) > HELD_PAIRS:
                yield made()
                held, sums = held[:0], sums[:0]
        yield made()

    columns = alignments.select("n_a", "n_b", "a_ids", "b_ids", "steps")
    return columns.mapInArrow(lean(count), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _slices(pairs: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of B ids with at most ``most`` pairs each, or one B id; one row per B id is collected."""
    ranges, size = [], 0
    for b, n in sorted(map(tuple, pairs.groupBy("b").agg(F.count("*")).collect())):
        if ranges and size + n <= most:
            ranges[-1] = ranges[-1][0], b
            size += n
        else:
            ranges.append((b, b))
            size = n
    return ranges


def _packed(pairs: DataFrame, first: int, last: int) -> tuple:
    """The pairs of some B ids in order, their counts, and whether these are the highest of the B id."""
    found = pairs.filter(F.col("b").between(first, last)).select("a", "b", "n").toArrow()
    a, b, n = (found.column(x).to_numpy() for x in ("a", "b", "n"))
    order = np.lexsort((a, b))
    a, b, n = a[order], b[order], n[order]
    begins = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
    highest = np.repeat(np.maximum.reduceat(n, begins), np.diff(np.append(begins, len(b))))
    return _keys(a, b), n, n == highest


def _add(rows: DataFrame, slice_of_pairs: tuple | None, first: int, last: int, final: bool) -> DataFrame:
    """Add what a slice of the pairs tells to ``n_best`` and ``count_sum``.

    The ``final`` pass puts ``n_groups`` and ``groups_sha256`` in place of ids and steps.
    """
    shared = rows.sparkSession.sparkContext.broadcast(slice_of_pairs)
    kept = ["id", "n_a", "n_b"] if final else ["id", "n_a", "n_b", "a_ids", "b_ids", "steps"]
    names = [*kept, "n_best", "count_sum", *(["n_groups", "groups_sha256"] if final else [])]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            of = _Batch(batch)
            a, b = of.links()
            counts, bests = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
            if shared.value is not None:
                keys, n, best = shared.value
                mine = np.flatnonzero((b >= first) & (b <= last))
                at = np.searchsorted(keys, _keys(a[mine], b[mine]))
                counts[mine], bests[mine] = n[at], best[at]
            cuts = np.append(0, np.cumsum(of.n_groups))
            arrays = [batch.column(x) for x in kept]
            for name, values in (("n_best", bests), ("count_sum", counts)):
                sums = np.append(0, np.cumsum(values))[cuts]
                arrays.append(pa.array(batch.column(name).to_numpy() + sums[1:] - sums[:-1]))
            if final:
                digests = [hashlib.sha256(x).hexdigest() if x else "" for x in of.group_texts()]
                arrays += [pa.array(of.n_groups, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = {x.name: x.dataType.simpleString() for x in rows.schema}
    kinds |= {"n_groups": "long", "groups_sha256": "string"}
    return rows.mapInArrow(lean(add), ", ".join(f"{x} {kinds[x]}" for x in names))


def scored(alignments: DataFrame, *, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """One row per row of an aligned table, which is read several times and should be written.

    ``id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose count is the highest
    of their B id), ``count_sum`` and ``groups_sha256``.
    """
    pairs = written(pair_counts(alignments))
    ranges = _slices(pairs, most_pairs)
    rows = alignments.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for first, last in ranges[:-1]:
        rows = written(_add(rows, _packed(pairs, first, last), first, last, final=False))
    if ranges:
        rows = _add(rows, _packed(pairs, *ranges[-1]), *ranges[-1], final=True)
    else:
        rows = _add(rows, None, 0, 0, final=True)
    return rows.withColumn("n_links", F.col("n_groups"))
