"""Quality rules by what public tokenizers make of a text.

A vocabulary that was trained on ordinary text needs few tokens for such text, hardly ever falls back
to bytes, and its tokens vary. Capitals, signs between words, noise and repetition show in:

- ``chars_per_token`` and ``chars_per_piece``: code points per token of a byte-level vocabulary and of
  one with byte fallback;
- ``byte_share``: the share of the latter's tokens that stand for single bytes, without those for line
  breaks and tabs, for which it has no other token;
- ``entropy``: bits per token of the latter, with the Miller-Madow correction for short texts.

What is ordinary differs between languages and scripts, so each has its bands. They are fitted on all
rows that pass the base rules: histograms of each measure, combined in each task before the shuffle,
give the quartiles; a band reaches ``SPREADS`` times the distance of the quartiles to both sides of the
median, and a documented share of the median at least, so that many copies of one text don't make it
narrow. A row is judged by the band of its language and script; by that of its script if it has no
language or that pair has fewer than ``LEAST_ROWS`` rows; and by the fixed ``WIDEST`` band of its script
if the script has fewer, too. The script is that of most letters of the text.

Base rules, before the bands: at least 50 words, and at most half of them in three-word windows that
the text repeats. Defined cases: a null text has no words and fails; texts are measured whole, long ones
in parts; on a tie of scripts the first in the table counts; a text without letters is of script
``none``; a null id stays null; repeated rows are measured and counted each; an empty table gives none;
columns other than id, text and language are never read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import pretokens
from strata.llm.alignment import plain_encoder
from strata.llm.common import lean, small, text_chunks, written
from strata.llm.piece_encoder import piece_encoder

A_TOKENIZER = "byte_bpe_50k.json"
B_TOKENIZER = "piece_bpe_32k.model"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
LEAST_ROWS = 50     # of a group, for a band of its own
MOST_GROUPS = 50_000  # broadcast up to that number
CHUNK_CHARACTERS = 1 << 20

# Measure: steps of its histogram per unit, highest step, spreads and least share of the median.
SPREADS = {
    "chars_per_token": (128, 4096, 5.0, 0.08),
    "chars_per_piece": (128, 4096, 5.0, 0.08),
    "byte_share": (1024, 1024, 5.0, 0.08),
    "entropy": (128, 4096, 3.0, 0.06),
}
BYTE_SHARE_ROOM = 0.05  # a byte share up to that is ordinary everywhere

# Scripts by their ranges of code points.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x531, 0x58A)],
    "hebrew": [(0x591, 0x5F4)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x323AF)],
}
NO_SCRIPT = "none"
# Bands for scripts of too few rows. Characters per token and piece, byte share, entropy.
WIDEST = {"latin": ((1.0, 8.0), (1.0, 8.0), (0.0, 0.5), (2.0, 16.0))}
WIDEST_ELSEWHERE = ((0.2, 8.0), (0.2, 8.0), (0.0, 1.0), (2.0, 16.0))

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLANK = re.compile(r"[\x20\x09-\x0D]")
_BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
_SYMBOLS = "#*$%&|<>"
_RANGES = sorted((a, b + 1, i) for i, x in enumerate(SCRIPTS.values()) for a, b in x)
_EDGES = np.array([x for a, b, _ in _RANGES for x in (a, b)], np.uint32)
_OF_EDGE = np.array([-1] + [x for _, _, i in _RANGES for x in (i, -1)])


class _Numbers(dict):
    """Words by their number, in order of appearance."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _word_numbers(text: str) -> tuple[np.ndarray, int]:
    """The number of each word, and the code points of all words; a long text is read in parts."""
    known, found, characters, at = _Numbers(), [], 0, 0
    while at < len(text):
        cut = _BLANK.search(text, at + CHUNK_CHARACTERS) if len(text) - at > CHUNK_CHARACTERS else None
        end = cut.start() if cut else len(text)
        words = _WORD.findall(text, at, end)
        characters += sum(map(len, words))
        found.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        at = end
    return np.concatenate([np.zeros(0, np.int64), *found]), characters


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the pairs, the same for the same pair."""
    return np.unique((a << 32) | b, return_inverse=True)[1]


def n_repeated(words: np.ndarray) -> int:
    """Words in three-word windows that occur twice or more, all of these counted."""
    if len(words) < 4:
        return 0
    windows = _pairs(_pairs(words[:-2], words[1:-1]), words[2:])
    twice = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= twice
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words``."""
    words, characters = _word_numbers(text)
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    symbols = sum(map(text.count, _SYMBOLS))
    return len(words), characters, symbols, len(lines) - len(set(lines)), n_repeated(words)


def script_of(text: str) -> str:
    """The script of most letters."""
    if pretokens.is_plain(text):
        return "latin" if any(map(str.isalpha, text)) else NO_SCRIPT
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    of = _OF_EDGE[np.searchsorted(_EDGES, points, "right")]
    counts = np.bincount(of[of >= 0], minlength=len(SCRIPTS))
    return list(SCRIPTS)[int(counts.argmax())] if counts.any() else NO_SCRIPT


def entropy(ids: np.ndarray) -> float:
    """Bits per token, with the correction for the number of different tokens seen."""
    if not len(ids):
        return 0.0
    counts = np.unique(ids, return_counts=True)[1]
    shares = counts / len(ids)
    return float(-(shares * np.log2(shares)).sum() + (len(counts) - 1) / (2 * np.log(2) * len(ids)))


def measured(
    documents: DataFrame,
    *,
    a_tokenizer: str | None = None,
    b_tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str | None = "lang",
) -> DataFrame:
    """One row per row: id, ``lang``, ``script``, the base counts and the measures.

    Texts that fail the base rules are not encoded; their measures are null.
    """
    a_path = a_tokenizer or pretokens.public(A_TOKENIZER)
    b_path = b_tokenizer or pretokens.public(B_TOKENIZER)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["id", "lang", "script", *counts, *SPREADS]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bytes, by_pieces = plain_encoder(a_path), piece_encoder(b_path)
        blanks = by_pieces.library.piece_to_id(["<0x09>", "<0x0A>", "<0x0B>", "<0x0C>", "<0x0D>"])
        is_byte = by_pieces.is_byte.copy()
        is_byte[blanks] = False
        for batch in batches:
            for begin, texts in text_chunks(batch.column(1)):
                texts = [x or "" for x in texts]
                found = [base_counts(x) for x in texts]
                measures: list[tuple] = [(None,) * len(SPREADS)] * len(texts)
                passed = [i for i, x in enumerate(found) if not fails_base(x[0], x[4])]
                plain = [texts[i] for i in passed]
                for i, a, b in zip(passed, by_bytes.encode(plain), by_pieces.encode(plain)):
                    n = len(texts[i])
                    measures[i] = n / len(a), n / len(b), float(is_byte[b].mean()), entropy(b)
                arrays = [batch.column(i).slice(begin, len(texts)) for i in (0, 2)]
                arrays.append(pa.array([script_of(x) for x in texts], pa.string()))
                arrays += [pa.array([x[k] for x in found], pa.int64()) for k in range(len(counts))]
                arrays += [pa.array([x[k] for x in measures], pa.float64()) for k in range(len(SPREADS))]
                yield pa.RecordBatch.from_arrays(arrays, names)

    lang = F.lit(None).cast("string") if lang_column is None else F.col(lang_column).cast("string")
    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), lang.alias("lang"))
    kinds = [rows.schema[0].dataType.simpleString(), "string", "string", *["long"] * 5, *["double"] * 4]
    made = rows.mapInArrow(lean(measure), ", ".join(map(" ".join, zip(names, kinds))))
    return made.withColumnRenamed("id", id_column)


def fails_base(n_words, n_repeat_words):
    """The base rules, on numbers or columns."""
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def fit_bands(rows: DataFrame, *, least_rows: int = LEAST_ROWS) -> DataFrame:
    """``script``, ``lang`` and the ends of the bands, ``low_...`` and ``high_...``, of each measure.

    A row with a null ``lang`` is the band of the whole script.
    """
    passed = rows.filter(~fails_base(F.col("n_words"), F.col("n_repeat_words")))
    steps = [
        F.struct(
            F.lit(name).alias("measure"),
            F.least(F.floor(F.col(name) * per_unit), F.lit(highest)).alias("step"),
            F.lit(per_unit).alias("per_unit"),
        )
        for name, (per_unit, highest, _, _) in SPREADS.items()
    ]
    by_step = (
        passed.select("script", "lang", F.inline(F.array(*steps)))
        .groupBy("script", "lang", "measure", "per_unit", "step").agg(F.count("*").alias("n"))
    )
    # The whole script, and each of its languages.
    both = F.array(F.struct(F.col("lang")), F.struct(F.lit(None).cast("string").alias("lang")))
    levels = F.when(F.col("lang").isNull(), F.slice(both, 2, 1)).otherwise(both)
    by_step = (
        by_step.withColumn("level", F.explode(levels))
        .groupBy("script", F.col("level.lang").alias("lang"), "measure", "per_unit", "step")
        .agg(F.sum("n").alias("n"))
    )
    # A histogram has a bounded number of steps.
    group = Window.partitionBy("script", "lang", "measure")
    upto = F.sum("n").over(group.orderBy("step")).alias("upto")
    sums = by_step.select("*", upto, F.sum("n").over(group).alias("n_rows")).filter(F.col("n_rows") >= least_rows)
    middle = (F.col("step") + 0.5) / F.col("per_unit")

    def quantile(share: float) -> Column:
        return F.min(F.when(F.col("upto") >= share * F.col("n_rows"), middle))

    quartiles = sums.groupBy("script", "lang", "measure").agg(
        quantile(0.25).alias("lower"), quantile(0.5).alias("median"), quantile(0.75).alias("upper")
    )

    def of(name: str, column: Column) -> Column:
        return F.first(F.when(F.col("measure") == name, column), ignorenulls=True)

    ends = []
    for name, (_, _, spreads, share) in SPREADS.items():
        room = F.greatest(spreads * (F.col("upper") - F.col("lower")), share * F.col("median"))
        if name == "byte_share":
            room = F.greatest(room, F.lit(BYTE_SHARE_ROOM))
        ends += [
            of(name, F.col("median") - room).alias(f"low_{name}"),
            of(name, F.col("median") + room).alias(f"high_{name}"),
        ]
    return quartiles.groupBy("script", "lang").agg(*ends)


def _widest(script: Column, measure: int, end: int) -> Column:
    found = F.lit(WIDEST_ELSEWHERE[measure][end])
    for name, bands in WIDEST.items():
        found = F.when(script == name, F.lit(bands[measure][end])).otherwise(found)
    return found


def judged(rows: DataFrame, bands: DataFrame) -> DataFrame:
    """The rows with ``base_failed``, ``failed`` (the measures beyond their bands) and ``kept``."""
    ends = [f"{end}_{name}" for name in SPREADS for end in ("low", "high")]
    whole = bands.filter("lang IS NULL").select(
        F.col("script").alias("of_script"), *[F.col(x).alias(f"script_{x}") for x in ends]
    )
    own = bands.filter("lang IS NOT NULL").select(
        F.col("script").alias("own_script"), F.col("lang").alias("own_lang"), *[F.col(x).alias(f"own_{x}") for x in ends]
    )
    found = (
        rows.join(small(own, MOST_GROUPS), (F.col("script") == F.col("own_script")) & (F.col("lang") == F.col("own_lang")), "left")
        .join(F.broadcast(whole), F.col("script") == F.col("of_script"), "left")  # one row per script
    )

    def end_of(name: str, at: int, end: int) -> Column:
        x = f"{('low', 'high')[end]}_{name}"
        return F.coalesce(F.col(f"own_{x}"), F.col(f"script_{x}"), _widest(F.col("script"), at, end))

    outside = F.array_compact(F.array(*[
        F.when(
            (F.col(name) < end_of(name, at, 0)) & F.lit(name != "byte_share") | (F.col(name) > end_of(name, at, 1)),
            F.lit(name),
        )
        for at, name in enumerate(SPREADS)
    ]))
    base_failed = fails_base(F.col("n_words"), F.col("n_repeat_words"))
    return found.select(
        *rows.columns, base_failed.alias("base_failed"), outside.alias("failed"),
        (~base_failed & (F.size(outside) == 0)).alias("kept"),
    )


def quality(documents: DataFrame, *, least_rows: int = LEAST_ROWS, **options: str | None) -> DataFrame:
    """Measure all rows, fit the bands on them, and judge each; options are those of ``measured``."""
    rows = written(measured(documents, **options))
    return judged(rows, written(fit_bands(rows, least_rows=least_rows)))
