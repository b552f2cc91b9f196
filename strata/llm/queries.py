"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import folders
from strata.llm import alignment, fertility, language_id, licenses, mixing, warc
from strata.llm.common import table, written
from strata.llm.exact_dedup import duplicate_groups
from strata.llm.fill_in_middle import fill_in_middle, restored
from strata.llm.jaccard import similar_documents
from strata.llm.neighbours import nearest_neighbours
from strata.llm.packing import packed
from strata.llm.token_counts import token_counts
from strata.llm.token_files import read_token_files, write_token_files


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language_id.identify(documents, language_id.fit(documents))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folders.scratch(spark)
    write_token_files(table(spark, sf_dir, "documents"), path)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.drawn(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.size("draws")).alias("taken")
    return found.select("doc_id", "size", "source_size", "target", taken, "draws")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents"))


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to WARC files of responses, which are read, converted, written and read again."""
    root = folders.scratch(spark)
    warc.write_warc(warc.responses(table(spark, sf_dir, "pages")), f"{root}/responses", **warc.FAST_GZIP)
    found = warc.derivatives(warc.read_warc(spark, f"{root}/responses"))
    warc.write_warc(found, f"{root}/derived", **warc.FAST_GZIP)
    return warc.read_warc(spark, f"{root}/derived").select(
        F.nullif("source_key", F.lit("")).cast("long").alias("page_id"), "warc_type", "record_id", "refers_to",
        "concurrent_to", "target_uri", "content_type", "payload_digest",
        F.octet_length("payload").cast("long").alias("n_bytes"),
    )


def op11_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.scored(written(alignment.aligned(table(spark, sf_dir, "documents"))))
    return found.select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


def op13_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "script", *fertility.SPREADS, "failed",
    )


QUERIES = {
    x.__name__: x
    for x in (
        op1_exact_dedup,
        op2_nearest_neighbours,
        op3_token_counts,
        op4_pack,
        op5_language_id,
        op6_token_files,
        op7_mix_sources,
        op8_license_scan,
        op9_ngram_jaccard_join,
        op10_warc_derivatives,
        op11_align_tokens,
        op12_fill_in_middle,
        op13_fertility_rules,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op12_fill_in_middle": """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS p1, ('0x' || h[9:16])::BIGINT % (n + 1) AS p2,
    ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM cut),
formed AS (
  SELECT *, least(p1, p2) AS a, greatest(p1, p2) AS b,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
      WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, substring(t, 1, a) AS prefix, substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix
  FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts""",
    "op10_warc_derivatives": warc.oracle_sql(),
    "op1_exact_dedup": f"""
WITH lowered AS (SELECT doc_id, {_LOWER} AS content FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
FROM lowered WINDOW same AS (PARTITION BY content)""",
    "op8_license_scan": licenses.oracle_sql(),
    "op9_ngram_jaccard_join": f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')))
    END AS shingles FROM split),
grams AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b USING (shingle)
  WHERE a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, least AS component_id
FROM sets JOIN (SELECT x, min(y) AS least FROM reach GROUP BY x) ON x = doc_id""",
}
