"""Language identification by a conditional random field over the words of a text.

The model is fitted on a bounded sample of labelled rows: ``ROWS_PER_LANGUAGE`` rows of each of the
``MOST_LANGUAGES`` languages that have most rows, ``SPAN_CHARACTERS`` characters from a random place
of each; none of them is held out. Rows are drawn, not ids, so repeated ids count as often as they occur.
Predictions read every text as a whole and nothing but the text: each word is labelled, and the
language of the text is the one with the largest share of its words, by their marginals.

Held out are rows whose ``crc32`` of the id, as text, is divisible by 5. Defined cases: a text that
is null or has no letter is ``und`` with score 0, as is every text when there is nothing to learn
from; equal shares go to the first language in alphabetical order; null labels teach nothing; a
null id counts as an empty text and is held out; very long texts are read as a whole; rows are kept one
for one, repeated ones, too; an empty table gives an empty result; other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm import word_crf
from strata.llm.common import character_chunks, lean

ROWS_PER_LANGUAGE = 400
SPAN_CHARACTERS = 3_000
MOST_LANGUAGES = 200
FOLDS = 5
UNKNOWN = "und"
CHUNK_CHARACTERS = 1 << 19


def is_held_out(of: Column) -> Column:
    text = F.coalesce(of.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def fit(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
    span_characters: int = SPAN_CHARACTERS,
    most_languages: int = MOST_LANGUAGES,
) -> word_crf.Model:
    """The model, learned from a sample whose size does not grow with the corpus."""
    rows = documents.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(lang_column).alias("lang")
    ).filter(F.col("lang").isNotNull() & ~is_held_out(F.col("id"))).drop("id")
    n_rows = rows.groupBy("lang").agg(F.count("*").alias("n_rows"))
    n_rows = n_rows.orderBy(F.desc("n_rows"), "lang").limit(most_languages)
    # Each task cuts the spans out of about three times as many rows as are wanted of each language;
    # only those are put in order. A language may hold most of the corpus.
    room = F.greatest(F.length("text") - span_characters, F.lit(1))
    span = F.col("text").substr((F.rand(3) * room).cast("int") + 1, F.lit(span_characters))
    near = rows.select("lang", "text", F.rand(1).alias("place")).join(F.broadcast(n_rows), "lang").filter(
        F.col("place") * F.col("n_rows") < 3 * rows_per_language
    ).select("lang", "place", span.alias("text"))
    order = Window.partitionBy("lang").orderBy("place", "text")
    drawn = near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= rows_per_language)
    spans: dict[str, list[str]] = {}
    for row in sorted(drawn.collect(), key=lambda x: (x.lang, x.nth)):
        spans.setdefault(row.lang, []).append(row.text)
    return word_crf.fit(spans)


def identify(
    documents: DataFrame, model: word_crf.Model, *, id_column: str = "doc_id", text_column: str = "text",
    spans: bool = False,
) -> DataFrame:
    """id, ``held_out``, ``lang_pred`` and ``score`` of each row.

    With ``spans``, also the runs of words with one language, as (``lang``, ``first``, ``n``).
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    kind_of_spans = "array<struct<lang:string,first:bigint,n:bigint>>"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = known.languages
        for batch in batches:
            for at, part in character_chunks(batch.column(1), CHUNK_CHARACTERS):
                found = known.label(word_crf.words_of(part))
                shares = [x.mean(0) if len(x) else None for x in found]
                best = [None if x is None else int(np.argmax(x)) for x in shares]
                columns = [
                    batch.column(0).slice(at, len(part)),
                    pa.array([UNKNOWN if b is None else names[b] for b in best], pa.string()),
                    pa.array([0.0 if b is None else min(1.0, float(x[b])) for b, x in zip(best, shares)]),
                ]
                if spans:
                    columns.append(pa.array([_runs(x, names) for x in found], pa.list_(pa.struct(
                        [("lang", pa.string()), ("first", pa.int64()), ("n", pa.int64())]
                    ))))
                yield pa.RecordBatch.from_arrays(columns, ["id", "lang_pred", "score", "spans"][:len(columns)])

    rows = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    schema = f"id {kind}, lang_pred string, score double" + (f", spans {kind_of_spans}" if spans else "")
    found = rows.mapInArrow(lean(predict, alone=True), schema)
    more = ["spans"] if spans else []
    return found.select(
        F.col("id").alias(id_column), is_held_out(F.col("id")).alias("held_out"), "lang_pred", "score", *more
    )


def _runs(marginals: np.ndarray, names: list[str]) -> list[dict]:
    if not len(marginals):
        return []
    best = marginals.argmax(1)
    starts = np.flatnonzero(np.append(True, best[1:] != best[:-1]))
    sizes = np.diff(np.append(starts, len(best)))
    return [{"lang": names[best[a]], "first": int(a), "n": int(n)} for a, n in zip(starts, sizes)]
