"""Tasks that fail and are run again must not change any result."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm.exact_dedup import duplicate_groups
from strata.llm.jaccard import similar_documents
from strata.llm.mixing import drawn
from strata.llm.packing import packed
from strata.llm.token_files import read_token_files, write_token_files
from tests.llm.cases import documents
from tests.llm.test_jaccard import brute_force, near_copies

ROWS = near_copies(120, 7)


@pytest.fixture
def flaky(spark, tmp_path):
    """Documents whose every task fails once, in the middle of its rows."""
    seen = str(tmp_path / "seen")
    os.mkdir(seen)
    docs = documents(spark, ROWS).repartition(4, "doc_id")
    docs.write.parquet(str(tmp_path / "docs"))

    @F.udf("boolean")
    def true(task, doc_id):
        if doc_id % 20 == 7:
            try:
                os.mkdir(f"{seen}/{task}")
            except FileExistsError:
                return True
            raise RuntimeError("lost")
        return True

    rows = spark.read.parquet(str(tmp_path / "docs")).withColumn("task", F.spark_partition_id())
    yield rows.filter(true("task", "doc_id")).drop("task")
    assert os.listdir(seen)


def test_jaccard_join(flaky):
    assert Counter(map(tuple, similar_documents(flaky).collect())) == brute_force(ROWS)


def test_exact_dedup(flaky):
    found = duplicate_groups(flaky).collect()
    assert sum(x.kept for x in found) == len({x[1] for x in ROWS}) and len(found) == len(ROWS)


def test_mix(spark, flaky):
    key = lambda x: (x.doc_id, x.draws)
    assert sorted(map(key, drawn(flaky).collect())) == sorted(map(key, drawn(documents(spark, ROWS)).collect()))


def test_packing(flaky):
    pieces = sorted(packed(flaky, window=100).collect(), key=lambda x: (x.sequence_id, x.offset))
    at = 0
    for x in pieces:
        assert x.sequence_id * 100 + x.offset == at
        at += x.length
    assert sum(x.length for x in pieces) == sum({x.doc_id: x.doc_tokens for x in pieces}.values())


def test_token_files(spark, flaky, tmp_path):
    write_token_files(flaky, str(tmp_path / "files"), block_ids=500)
    found = sorted(read_token_files(spark, str(tmp_path / "files")).collect(), key=lambda x: x.start)
    assert [x.doc_id for x in found] == sorted(x[0] for x in ROWS)
