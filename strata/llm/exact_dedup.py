"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Texts are equal when they are identical after lower-casing A-Z. Of equal texts the row with the
largest id stays. The rows are combined in three stages, each of which compares whole texts:

1. Every task reduces its own rows to one per text, before anything is shuffled (the map side
   of the first aggregation).
2. These rows meet by digest, text and a salt taken from the task that made them, so that a
   text that many tasks hold is spread over ``salts`` tasks.
3. The at most ``salts`` winners of each text meet by digest, where texts that share a digest
   would show as more than one row.

The decision then goes back to the rows by their digest. A text whose digest is not its own is
joined by the text itself.

Defined cases: a null text counts as empty; a null id is smaller than any other; repeated rows,
which share both id and text, are marked alike, and :func:`deduplicated` returns one of them; very long texts are
compared as a whole; an empty table gives an empty result. Other columns are kept by
:func:`deduplicated` and never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower, free_name, written

SALTS = 32


def sha256(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def duplicate_groups(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = SALTS,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    content = ascii_lower(F.col(text_column))
    rows = documents.select(F.col(id_column).alias("id"), content.alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))

    salt = (F.spark_partition_id() % salts).alias("salt")
    salted = rows.groupBy("digest", "content", salt).agg(
        F.max("id").alias("keep_id"), F.count("*").alias("group_size")
    )
    texts = salted.repartition("digest").groupBy("digest", "content").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    digests = written(texts.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.count("*").alias("n_texts"),
    ))
    own = digests.filter("n_texts = 1").drop("n_texts")
    marked = rows.select("id", "digest").join(own, "digest")
    shared = digests.filter("n_texts > 1").select("digest")
    if not shared.isEmpty():
        of_text = texts.join(shared, "digest", "left_semi")
        rest = rows.join(of_text, ["digest", "content"])
        marked = marked.select("id", "digest", "keep_id", "group_size").unionByName(
            rest.select("id", "digest", "keep_id", "group_size")
        )
    return marked.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def deduplicated(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows that stay, with all their columns.

    The rows that go are the smaller part, and only they are looked up: by their ids where no id is
    shared, else by id and text.
    """
    groups = duplicate_groups(documents, id_column=id_column, text_column=text_column)
    marks = written(groups.select(F.col(id_column).alias("id"), F.col("text_sha256").alias("digest"), "kept"))
    names = [F.col(f"`{x}`") for x in documents.columns]
    own, other = free_name(documents.columns, "id_of_row"), free_name(documents.columns, "id_that_goes")
    if marks.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        gone = marks.filter("NOT kept").select(F.col("id").alias(other))
        rows = documents.withColumn(own, F.col(f"`{id_column}`"))
        return rows.join(gone, F.col(own).eqNullSafe(F.col(other)), "left_anti").select(*names)

    def key(digest: Column, of: Column) -> Column:
        return F.struct(of.isNull().alias("no_id"), of.alias("id"), digest.alias("digest"))

    keys = marks.select(key(F.col("digest"), F.col("id")).alias(other), "kept")
    found = keys.groupBy(other).agg(F.first("kept").alias("kept"), F.count("*").alias("n"))
    found = written(found.filter("NOT kept OR n > 1"))
    digest = sha256(ascii_lower(F.col(f"`{text_column}`")))
    rows = documents.withColumn(own, key(digest, F.col(f"`{id_column}`")))
    stay = rows.join(found.select(other), F.col(own) == F.col(other), "left_anti").select(*names)
    repeated = found.filter("kept").select(other)
    once = rows.join(repeated, F.col(own) == F.col(other), "left_semi").dropDuplicates([own])
    return stay.unionByName(once.select(*names))
