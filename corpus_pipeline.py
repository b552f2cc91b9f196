"""The corpus pipeline: language ID, exact and near duplicates, source mix, packed sequences.

Each stage takes what the one before kept, as a table of documents, and returns what it keeps, with
the columns of ``documents``; the last one returns the pieces of packed sequences. A document that
the mix takes more than once is there once per draw from then on.

Rows are told apart by id and text, as in exact deduplication: a null id or an id that other rows
share is no reason to drop a row or to keep it. An empty table passes all stages, with no piece at the
end; other columns go along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import language_id
from strata.llm.common import free_name, importable, table, written
from strata.llm.exact_dedup import deduplicated
from strata.llm.jaccard import similar_documents
from strata.llm.mixing import mixed
from strata.llm.packing import packed

LEAST_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters, or undecided, go.

    The language is that of a text, so equal rows go or stay alike.
    """
    importable(spark)
    keyed, key = _keyed(docs)
    found = language_id.identify(keyed, language_id.fit(docs), id_column=key)
    told = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return _without(docs, written(found.filter(~told).select(F.col(key).alias("gone")).distinct()))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar documents, that with the smallest id.

    Similar is what ``op9_ngram_jaccard_join`` calls so, of which this is the stage: sets of four
    words, 85 per cent. With five words and 80 per cent some other pairs would be near copies.

    Null ids come last; of texts with the same id, the one with the smallest digest stays, and of
    rows with the same id and text any one. Texts without words are like no other and all stay.
    """
    importable(spark)
    keyed, key = _keyed(docs)
    found = similar_documents(keyed, id_column=key).withColumnRenamed(key, "row")
    keys = found.groupBy("row").agg(
        F.first(F.col("row") != F.col("component_id")).alias("goes"),
        F.first("n_shingles").alias("n_shingles"), F.count("*").alias("n_rows"),
    )
    marked = written(keys.filter("goes OR (n_rows > 1 AND n_shingles > 0)"))
    repeated = marked.filter("NOT goes").select(F.col("row").alias(key))
    kept = _without(docs, marked.select(F.col("row").alias("gone")))
    if repeated.isEmpty():
        return kept
    names = [F.col(f"`{x}`") for x in docs.columns]
    once = keyed.join(repeated, key, "left_semi").dropDuplicates([key])
    return kept.unionByName(once.select(*names))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, shard by shard."""
    return mixed(docs, draw_columns=False)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    importable(spark)
    return packed(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset",
    )


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column more, which tells them apart and orders them: id, null last, and text."""
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), digest.alias("digest"))
    name = free_name(docs.columns, "row_key")
    return docs.withColumn(name, key), name


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose key is not among those ``gone``; Spark broadcasts these while they are few."""
    keyed, key = _keyed(docs)
    kept = keyed.join(gone.withColumnRenamed("gone", key), key, "left_anti")
    return kept.select(*[F.col(f"`{x}`") for x in docs.columns])


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

ORACLE_SQL = None  # language ID, the mix's draws and tokens are beyond SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
