import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from strata import folders, layers
from strata.operators import envelope
from strata.schemas import BRONZE, LOG, SILVER
from strata.sources import read_current, read_file_log, read_raw
from strata.streaming import run_bronze, run_silver, silver


@pytest.fixture
def root(spark):
    return folders.scratch(spark)


def _payload(key, name, second):
    return json.dumps({"meta": {"id": key}, "title": name, "timestamp": second})


def _append(spark, root, first, texts):
    """Append records with the offsets from ``first`` on, as one file."""
    rows = spark.createDataFrame([(first + i, text) for i, text in enumerate(texts)], "offset bigint, text string")
    rows.coalesce(1).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), "offset",
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("offset") * 40_000).alias("timestamp"),
        F.col("text").cast("binary").alias("value"),
    ).select(*LOG.names).write.mode("append").parquet(f"{root}/log")


def _bronze(spark, root, **limits):
    run_bronze(read_file_log(spark, f"{root}/log", **limits), f"{root}/bronze", f"{root}/bronze_checkpoint")


def _silver(spark, root, **limits):
    return run_silver(read_raw(spark, f"{root}/bronze", **limits), f"{root}/silver", f"{root}/silver_checkpoint")


def _titles(spark, root):
    return {r.meta_id: r.title for r in read_current(spark, f"{root}/silver").collect()}


def test_bronze_appends_only_what_is_new(spark, root):
    _append(spark, root, 0, ["a", "b"])
    _bronze(spark, root)
    _bronze(spark, root)
    _append(spark, root, 2, ["c"])
    _bronze(spark, root)
    rows = spark.read.schema(BRONZE).parquet(f"{root}/bronze").orderBy("offset").collect()
    assert [(r.offset, r.raw_values) for r in rows] == [(0, "a"), (1, "b"), (2, "c")]
    days = [name for name in os.listdir(f"{root}/bronze") if name.startswith("kafka_date=2023-11-1")]
    files = [name for day in days for name in os.listdir(f"{root}/bronze/{day}") if name[0] != "."]
    assert files and all(name.endswith(".zstd.parquet") for name in files)


def test_bronze_does_not_depend_on_the_split_and_equals_the_batch(spark, root):
    for first in range(0, 12, 3):
        _append(spark, root, first, [f"r{first + i}" for i in range(3)])
    _bronze(spark, root, max_files=1)
    stored = [n for n in BRONZE.names if n != "igs_timestamp"]
    landed = spark.read.schema(BRONZE).parquet(f"{root}/bronze").select(*stored)
    batch = envelope(read_file_log(spark, f"{root}/log", stream=False)).select(*stored)
    assert sorted(landed.collect()) == sorted(batch.collect())
    assert landed.count() == 12


def test_silver_keeps_the_newest_in_a_batch_and_the_last_batch_across(spark, root):
    _append(spark, root, 0, [_payload("a", "newer", 200), _payload("a", "older", 100), "junk"])
    _bronze(spark, root)
    _silver(spark, root)
    assert _titles(spark, root) == {"a": "newer"}
    _append(spark, root, 3, [_payload("a", "late", 50), _payload("b", "b", 10)])
    _bronze(spark, root)
    _silver(spark, root)
    assert _titles(spark, root) == {"a": "late", "b": "b"}
    _silver(spark, root)
    assert _titles(spark, root) == {"a": "late", "b": "b"}


@pytest.mark.parametrize("limit", [{"max_files": 1}, {"max_bytes": 1}])
def test_silver_drains_many_batches_and_compacts(spark, root, limit):
    for i in range(5):
        _append(spark, root, i, [_payload("a", f"t{i}", 100 - i)])
        _bronze(spark, root)
    _silver(spark, root, **limit)
    assert _titles(spark, root) == {"a": "t4"}
    assert len(layers.live(spark, f"{root}/silver")) < 5


def test_long_backlog_is_folded_on_the_way(spark, root, monkeypatch):
    for i in range(5):
        _append(spark, root, i, [_payload("a", f"t{i}", 100 - i), _payload(f"k{i}", f"t{i}", 1)])
        _bronze(spark, root)
    folds = []
    real = silver.compact

    def counted(spark, table, **options):
        folds.append(len(layers.live(spark, table)))
        return real(spark, table, **options)

    monkeypatch.setattr(silver, "compact", counted)
    run_silver(
        read_raw(spark, f"{root}/bronze", max_files=1), f"{root}/silver", f"{root}/silver_checkpoint", fold_every=2
    )
    assert len(folds) >= 3 and max(folds) <= 4
    assert _titles(spark, root) == {"a": "t4", **{f"k{i}": f"t{i}" for i in range(5)}}


def test_silver_columns(spark, root):
    _append(spark, root, 0, [_payload("a", "t", 1)])
    _bronze(spark, root)
    _silver(spark, root)
    assert read_current(spark, f"{root}/silver").schema == SILVER


def test_only_rejects_write_nothing(spark, root):
    _append(spark, root, 0, ["junk", "", '{"meta":{}}'])
    _bronze(spark, root)
    _silver(spark, root)
    assert layers.live(spark, f"{root}/silver") == []
    assert read_current(spark, f"{root}/silver").schema == SILVER


@pytest.mark.parametrize("when", ["before the write", "after the write"])
def test_failed_batch_ends_the_stream_and_is_redone(spark, root, monkeypatch, when):
    _append(spark, root, 0, [_payload("a", "one", 1), _payload("b", "one", 1)])
    _bronze(spark, root)
    real = silver.upsert

    def failing(batch, table, **place):
        if when == "after the write":
            real(batch, table, **place)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(silver, "upsert", failing)
        with pytest.raises(StreamingQueryException):
            _silver(spark, root)
    assert bool(_titles(spark, root)) == (when == "after the write")

    _append(spark, root, 2, [_payload("b", "two", 1)])
    _bronze(spark, root)
    _silver(spark, root)
    assert _titles(spark, root) == {"a": "one", "b": "two"}


def test_failed_compaction_is_only_logged(spark, root, monkeypatch, caplog):
    def failing(*_, **__):
        raise OSError("full")

    monkeypatch.setattr(silver, "compact", failing)
    _append(spark, root, 0, [_payload("a", "t", 1)])
    _bronze(spark, root)
    _silver(spark, root)
    assert _titles(spark, root) == {"a": "t"}
    assert "compaction" in caplog.text


def test_silver_with_a_new_checkpoint_reads_all_again(spark, root):
    _append(spark, root, 0, [_payload("a", "t", 1)])
    _bronze(spark, root)
    _silver(spark, root)
    run_silver(read_raw(spark, f"{root}/bronze"), f"{root}/silver", f"{root}/another_checkpoint")
    assert _titles(spark, root) == {"a": "t"}


def test_envelope_of_a_kafka_record(spark):
    record = spark.sql(
        "SELECT CAST('k' AS BINARY) AS key, CAST('{\"é\":1}' AS BINARY) AS value, 't' AS topic, 3 AS partition, "
        "9L AS offset, TIMESTAMP'2024-02-29 23:59:59' AS timestamp, 0 AS timestampType, array() AS headers"
    )
    rows = envelope(record)
    assert rows.columns == BRONZE.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in BRONZE]
    row = rows.first()
    assert (row.topic, row.partition, row.offset, row.raw_values) == ("t", 3, 9, '{"é":1}')
    assert str(row.kafka_date) == "2024-02-29" and row.igs_timestamp > row.kafka_timestamp


def test_nothing_to_read(spark, root):
    folders.make(spark, f"{root}/log")
    _bronze(spark, root)
    _silver(spark, root)
    assert _titles(spark, root) == {}


records = st.tuples(
    st.sampled_from(["a", "b", "c", ""]),
    st.sampled_from([1, 2, 3, "2", "2.9", "abc", None]),
    st.sampled_from(["fine", "fine", "fine", "cut", "no key", "blank", "null"]),
)


def _record_text(offset, key, second, kind):
    payload = {"meta": {"id": key}, "title": f"t{offset}", "timestamp": second}
    if kind == "no key":
        del payload["meta"]
    text = json.dumps(payload)
    return {"cut": text[:-5], "blank": " ", "null": None}.get(kind, text)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(records, min_size=1, max_size=12), min_size=1, max_size=3))
def test_any_log_equals_a_dict(spark, batches):
    root = folders.scratch(spark)
    expected, offset = {}, 0
    for batch in batches:
        _append(spark, root, offset, [_record_text(offset + i, *r) for i, r in enumerate(batch)])
        newest = {}
        for at, (key, second, kind) in enumerate(batch, offset):
            time = {"2": 2, "2.9": 2, "abc": -1, None: -1}.get(second, second)
            if kind == "fine" and (time, at) > newest.get(key, (-2, -1)):
                newest[key] = (time, at)
        expected |= {key: f"t{at}" for key, (_, at) in newest.items()}
        offset += len(batch)
        _bronze(spark, root)
        _silver(spark, root)
    assert _titles(spark, root) == expected
