"""License scans by diagonal voting, in DataFrame operations only.

All rolling pairs of words of a text are joined to the pairs of the templates by hash, and
compared word for word where the hashes meet. A pair at word ``p`` of the text and word ``t`` of
a template votes for the diagonal ``p - t``. A phrase that stands in the text word for word gives
all votes of a template to one diagonal. A longer notice that was edited splits into neighbouring
diagonals; these are merged into spans. A notice is accepted when enough of the template's pairs are
in any run of a span's diagonals that is not much longer than the template, so common pairs beside
it do not void it. The score is the coverage of the best span, however long that is.

Templates may be of any length, such as whole licences. A pair of a template counts once in a run. To
count all runs of a span in one pass, each vote is turned into the stretch of starts for which it is the
first of its pair in the run: from behind the vote before it for the same pair, or from where the run
just reaches it, to its own diagonal. The number of stretches over a start, a running sum of their
begins and ends, is what the run from there covers.

Base phrases are found exactly, at every place. Defined cases: a null text counts as empty, has
no words and no label; very long texts are scanned whole; of runs that cover as much any one counts; rows are told apart by id and text, and equal rows each give one row; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower

# Phrases and labels to be found word for word.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Sentences of well-known notices, found with edits.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without "
    "restriction": "mit-notice",
    "licensed under the apache license version 2 0 the license you may not use this file except "
    "in compliance with the license": "apache-notice",
    "this program is free software you can redistribute it and or modify it under the terms of "
    "the gnu general public license as published by the free software foundation": "gpl-notice",
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met": "bsd-notice",
    "this work is licensed under a creative commons attribution 4 0 international "
    "license": "cc-by-notice",
    "to the extent possible under law the author has waived all copyright and related or "
    "neighboring rights to this work": "cc0-notice",
    "this source code form is subject to the terms of the mozilla public license v 2 "
    "0": "mpl-notice",
    "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted": "isc-notice",
    "this work is licensed under the": "license-grant",
    "released under the terms of the": "license-grant",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MOST_TEMPLATES = 10_000
MOST_PAIRS = 1_000_000  # of all templates, which are broadcast
GAP = 3  # words between diagonals that belong together
COVERAGE = 0.7
STRETCH = 1.5


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(f"({WORD})"), F.lit(1))


def pairs(of: Column) -> Column:
    """Each word with the next one; the last has none."""
    following = F.slice(of, F.lit(2), F.size(of))
    return F.zip_with(of, following, lambda a, b: F.struct(
        F.xxhash64(a, b).alias("hash"), a.alias("first"), b.alias("second")
    ))


def templates(spark: SparkSession, base: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """One row per pair of words of a template."""
    known = [(x, label, True) for x, label in base.items()]
    known += [(x, label, False) for x, label in notices.items()]
    if len(known) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    for phrase, _, _ in known:
        if len(phrase.split()) < 2:
            raise ValueError(f"a template has 2 words or more: {phrase}")
    if sum(len(phrase.split()) for phrase, _, _ in known) > MOST_PAIRS:
        raise ValueError(f"templates of more than {MOST_PAIRS} words together")
    each = F.explode(F.array(*[
        F.struct(F.lit(i).alias("template"), F.lit(x).alias("phrase"), F.lit(label).alias("label"),
                 F.lit(is_base).alias("is_base"))
        for i, (x, label, is_base) in enumerate(known)
    ]))
    rows = spark.range(1).select(each.alias("t")).select("t.*")
    of = words(F.col("phrase"))
    rows = rows.select(
        "template", "label", "is_base", (F.size(of) - 1).alias("n_pairs"),
        F.posexplode(F.slice(pairs(of), F.lit(1), F.size(of) - 1)).alias("at", "pair"),
    )
    return rows.select("template", "label", "is_base", "n_pairs", "at", "pair.*")


def license_scan(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    base: dict[str, str] = BASE_PHRASES,
    notices: dict[str, str] = NOTICES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per row: places of the base phrases, labels, and the best coverage as score."""
    text = F.col(text_column)
    rows = documents.select(
        F.col(id_column).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"),
        words(text).alias("words"),
    )
    # Element 0 stands for the document itself, so that one without any hit keeps a row.
    none = F.struct(
        F.lit(None).cast("long").alias("hash"), F.lit(None).cast("string").alias("first"),
        F.lit(None).cast("string").alias("second"),
    )
    grams = rows.select(
        "id", "key", F.size("words").alias("n_words"),
        F.posexplode(F.concat(F.array(none), pairs(F.col("words")))).alias("place", "pair"),
    )
    known = F.broadcast(templates(documents.sparkSession, base, notices))
    hits = grams.join(
        known,
        (F.col("pair.hash") == known["hash"])
        & (F.col("pair.first") == known["first"])
        & (F.col("pair.second") == known["second"]),
        "left",
    ).filter(F.col("at").isNotNull() | (F.col("place") == 0))

    doc = ["id", "key", "n_words"]
    template = ["template", "label", "is_base", "n_pairs"]
    diagonal = (F.col("place") - 1 - F.col("at")).alias("diagonal")
    votes = hits.groupBy(*doc, *template, diagonal, "at").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(*doc, "template").orderBy("diagonal", "at")
    upto = Window.partitionBy(*doc, "template").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(before) > GAP, 1).otherwise(0)
    # Of a base phrase, each diagonal stands alone.
    votes = votes.withColumn("apart", apart).withColumn(
        "part", F.when(F.col("is_base"), F.col("diagonal")).otherwise(F.sum("apart").over(upto))
    )
    same_pair = Window.partitionBy(*doc, "template", "part", "at").orderBy("diagonal")
    reach = F.floor((STRETCH - 1) * F.col("n_pairs"))
    begin = F.greatest(F.col("diagonal") - reach, F.col("last") + 1)
    votes = votes.withColumn("last", F.lag("diagonal").over(same_pair))
    event = lambda start, change: F.struct(start.cast("long").alias("start"), F.lit(change).alias("change"))
    stretches = votes.withColumn("event", F.explode(
        F.when(F.col("is_base"), F.array(event(F.col("diagonal"), 1)))
        .when(F.col("template").isNull(), F.array(event(F.lit(None), 0)))
        .otherwise(F.array(event(begin, 1), event(F.col("diagonal") + 1, -1)))
    ))
    run = Window.partitionBy(*doc, "template", "part").orderBy("event.start")
    runs = stretches.withColumn("run_pairs", F.sum("event.change").over(run))
    distinct = F.count(F.when(F.col("last").isNull() & (F.col("event.change") > 0), 1))
    spans = runs.groupBy(*doc, *template, "part").agg(
        F.max("rows").alias("rows"), F.min("diagonal").alias("start"), (distinct / F.first("n_pairs")).alias("covered"),
        (F.max("run_pairs") / F.first("n_pairs")).alias("run_covered"),
    )
    is_base = F.col("is_base") & (F.col("covered") == 1.0)
    is_notice = ~F.col("is_base") & (F.col("run_covered") >= coverage)
    joined = lambda test: F.array_join(F.array_sort(F.collect_set(F.when(test, F.col("label")))), ",")
    found = spans.groupBy(*doc).agg(
        F.max(F.when(F.col("template").isNull(), F.col("rows"))).alias("copies"),
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).cast("long").alias("last_word"),
        joined(is_base).alias("base_labels"),
        joined(is_base | is_notice).alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"),
    )
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.select(
        F.col("id").alias(id_column), F.col("n_words").cast("long").alias("n_words"), "n_base",
        "first_word", "last_word", "base_labels", "labels", "score",
    )


def oracle_sql() -> str:
    """The scan of ``documents`` in DuckDB's SQL."""
    known = [(x, label, "true") for x, label in BASE_PHRASES.items()]
    known += [(x, label, "false") for x, label in NOTICES.items()]
    values = ", ".join(f"({i}, '{x}', '{label}', {b})" for i, (x, label, b) in enumerate(known))
    return rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{WORD}') AS ws FROM documents),
grams AS (
  SELECT doc_id, z[1] AS a, z[2] AS b, z[3] - 1 AS place FROM (
    SELECT doc_id, unnest(list_zip(ws[:-2], ws[2:], range(1, len(ws)))) AS z FROM docs
    WHERE len(ws) > 1)),
phrases(template, phrase, label, is_base) AS (VALUES {values}),
split AS (SELECT *, string_split(phrase, ' ') AS ws FROM phrases),
known AS (
  SELECT template, label, is_base, len(ws) - 1 AS n_pairs, z[1] AS a, z[2] AS b, z[3] - 1 AS pos FROM (
    SELECT *, unnest(list_zip(ws[:-2], ws[2:], range(1, len(ws)))) AS z FROM split)),
voted AS (
  SELECT doc_id, template, label, is_base, n_pairs, place - pos AS diagonal,
    bit_or(1::BIGINT << pos::INT) AS votes
  FROM grams JOIN known USING (a, b) GROUP BY ALL),
steps AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w > {GAP} THEN 1 ELSE 0 END AS apart,
    row_number() OVER w AS place
  FROM voted WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
parts AS (
  SELECT *, CASE WHEN is_base THEN place ELSE sum(apart) OVER
    (PARTITION BY doc_id, template ORDER BY diagonal) END AS part FROM steps),
runs AS (
  SELECT *, bit_count(bit_or(votes) OVER (
      PARTITION BY doc_id, template, part ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND reach FOLLOWING
    )) AS run_pairs
  FROM (SELECT *, floor({STRETCH - 1} * n_pairs)::BIGINT AS reach FROM parts)),
spans AS (
  SELECT doc_id, label, is_base, min(diagonal) AS start, bit_count(bit_or(votes)) / n_pairs AS covered,
    max(run_pairs) / n_pairs AS run_covered
  FROM runs GROUP BY doc_id, template, label, is_base, n_pairs, part),
judged AS (
  SELECT *, is_base AND covered = 1 AS base_hit, NOT is_base AND run_covered >= {COVERAGE} AS notice_hit
  FROM spans),
found AS (
  SELECT doc_id, count(*) FILTER (base_hit) AS n_base, min(start) FILTER (base_hit) AS first_word,
    max(start) FILTER (base_hit) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base_hit) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base_hit OR notice_hit) AS labels,
    max(covered) AS score FROM judged GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN found USING (doc_id)"""
