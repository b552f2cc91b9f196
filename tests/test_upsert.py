import os
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import folders, layers
from strata.operators import compact, upsert
from strata.sources import read_current

SCHEMA = T.StructType([
    T.StructField("meta_id", T.StringType()),
    T.StructField("v", T.IntegerType()),
    T.StructField("kafka_date", T.DateType()),
])
D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


def _batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _state(spark, table):
    rows = [tuple(r) for r in read_current(spark, table, schema=SCHEMA).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def _put(spark, table, rows, batch_id, writer="w"):
    return upsert(_batch(spark, rows), table, writer=writer, batch_id=batch_id)


@pytest.fixture
def table(spark):
    return folders.scratch(spark)


def _fold(spark, table, min_share=0.0, note_from=0):
    return compact(spark, table, min_share=min_share, note_from=note_from)


def test_missing_table_is_empty(spark, table):
    assert _state(spark, table) == {}
    with pytest.raises(FileNotFoundError):
        read_current(spark, table, schema=None)


def test_update_insert_and_move_to_another_date(spark, table):
    _put(spark, table, [("a", 1, D1), ("b", 1, D1), ("n", 1, None)], 0)
    _put(spark, table, [("a", 2, D2), ("c", 2, D2)], 1)
    expected = {"a": (2, D2), "b": (1, D1), "n": (1, None), "c": (2, D2)}
    assert _state(spark, table) == expected
    assert _fold(spark, table)
    assert len(layers.live(spark, table)) == 1
    assert _state(spark, table) == expected


def test_last_processed_batch_wins(spark, table):
    for batch_id in range(12):
        _put(spark, table, [("a", batch_id, D1)], batch_id)
    assert _state(spark, table) == {"a": (11, D1)}


def test_redelivery_changes_nothing(spark, table):
    assert _put(spark, table, [("a", 1, D1)], 0)
    assert _put(spark, table, [("a", 2, D1)], 1)
    assert not _put(spark, table, [("a", 1, D1)], 0)
    assert _state(spark, table) == {"a": (2, D1)}
    assert len(layers.live(spark, table)) == 2


def _uncommit(table, batch_id):
    name = next(n for n in os.listdir(table) if n.endswith(f"-{batch_id}-w"))
    os.unlink(f"{table}/{name}/_SUCCESS")
    return name


def test_half_written_batch_is_not_read_and_can_be_written_again(spark, table):
    _put(spark, table, [("a", 1, D1)], 0)
    _put(spark, table, [("a", 2, D1), ("b", 2, D2)], 1)
    half = _uncommit(table, 1)
    assert _state(spark, table) == {"a": (1, D1)}
    assert _put(spark, table, [("a", 3, D1)], 1)
    assert _state(spark, table) == {"a": (3, D1)}
    assert os.path.exists(f"{table}/{half}/_SUCCESS")


def test_half_written_batch_overtaken_by_another_goes_last(spark, table):
    _put(spark, table, [("a", 1, D1)], 0)
    _uncommit(table, 0)
    _put(spark, table, [("a", 5, D1)], 0, writer="other")
    _put(spark, table, [("a", 1, D1)], 0)
    assert _state(spark, table) == {"a": (1, D1)}


def test_new_checkpoint_does_not_overwrite(spark, table):
    first = layers.writer_of(spark, f"{table}_c1")
    assert layers.writer_of(spark, f"{table}_c1") == first
    second = layers.writer_of(spark, f"{table}_c2")
    assert first != second
    _put(spark, table, [("a", 1, D1), ("b", 1, D1)], 0, writer=first)
    _put(spark, table, [("a", 2, D1)], 0, writer=second)
    assert _state(spark, table) == {"a": (2, D1), "b": (1, D1)}


def test_half_written_fold_is_ignored(spark, table):
    _put(spark, table, [("a", 1, D1)], 0)
    _put(spark, table, [("a", 2, D1)], 1)
    fold = layers.fold_of(layers.live(spark, table))
    _batch(spark, [("wrong", 0, D1)]).write.partitionBy("kafka_date").parquet(fold.path(table))
    os.unlink(f"{fold.path(table)}/_SUCCESS")
    assert _state(spark, table) == {"a": (2, D1)}
    assert _fold(spark, table)
    assert _state(spark, table) == {"a": (2, D1)}


def test_small_changes_do_not_rewrite_a_large_folder(spark, table):
    _put(spark, table, [(str(i), i, D1) for i in range(200_000)], 0)
    _put(spark, table, [("1", -1, D1)], 1)
    _put(spark, table, [("1", -2, D1)], 2)
    assert _fold(spark, table, min_share=0.25)
    newest, oldest = layers.live(spark, table)
    assert (newest.first, newest.last, oldest.last) == (2, 3, 1)
    assert read_current(spark, table, schema=SCHEMA).filter("meta_id = '1'").first().v == -2
    assert not _fold(spark, table, min_share=0.25)


def test_compacted_table_is_read_without_a_shuffle(spark, table):
    _put(spark, table, [("a", 1, D1)], 0)
    _put(spark, table, [("a", 2, D1), ("b", 2, D2)], 1)
    _fold(spark, table)
    plan = read_current(spark, table, schema=SCHEMA).filter(F.col("kafka_date") == D2)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Join" not in text
    assert "PartitionFilters: [isnotnull(kafka_date" in text
    assert [r.meta_id for r in plan.collect()] == ["b"]


def test_hot_date_is_split_and_small_dates_are_one_file(spark, table):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        rows = spark.range(60_000).select(
            F.sha2(F.col("id").cast("string"), 256).alias("meta_id"),
            F.col("id").cast("int").alias("v"),
            F.when(F.col("id") % 50 == 0, F.lit(D2)).otherwise(F.lit(D1)).alias("kafka_date"),
        )
        upsert(rows.repartition(16), table, writer="w", batch_id=0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    folder = layers.live(spark, table)[0].path(table)

    def files(day):
        return [n for n in os.listdir(f"{folder}/kafka_date={day}") if n.endswith(".parquet")]

    assert len(files(D1)) > 1
    assert len(files(D2)) == 1


def test_added_column(spark, table):
    _put(spark, table, [("a", 1, D1), ("b", 1, D1)], 0)
    more = _batch(spark, [("a", 2, D1)]).withColumn("extra", F.lit("x"))
    upsert(more, table, writer="w", batch_id=1)

    def rows():
        got = read_current(spark, table, schema=None).collect()
        return {r.meta_id: (r.v, r.kafka_date, r.extra) for r in got}

    assert rows() == {"a": (2, D1, "x"), "b": (1, D1, None)}
    assert _fold(spark, table)
    assert rows() == {"a": (2, D1, "x"), "b": (1, D1, None)}


def test_column_that_a_batch_lacks_keeps_its_values(spark, table):
    first = _batch(spark, [("a", 1, D1), ("b", 1, D1)]).withColumn("extra", F.col("meta_id"))
    upsert(first, table, writer="w", batch_id=0)
    _put(spark, table, [("a", 2, D2), ("c", 2, D1)], 1)
    _put(spark, table, [("a", 2, D2), ("c", 2, D1)], 1)  # delivered again

    def rows():
        got = read_current(spark, table, schema=SCHEMA)
        assert got.columns == [*SCHEMA.names, "extra"]
        return {r.meta_id: (r.v, r.kafka_date, r.extra) for r in got.collect()}

    expected = {"a": (2, D2, "a"), "b": (1, D1, "b"), "c": (2, D1, None)}
    assert rows() == expected
    _put(spark, table, [("b", 3, D1)], 2)
    expected["b"] = (3, D1, "b")
    assert rows() == expected
    assert _fold(spark, table)
    assert rows() == expected
    upsert(_batch(spark, [("c", 4, D1)]).withColumn("extra", F.lit("y")), table, writer="w", batch_id=3)
    _put(spark, table, [("c", 5, D1)], 4)
    assert rows() == expected | {"c": (5, D1, "y")}


def test_wide_updates_are_folded_and_not_noted(spark, table):
    limit = 100_000
    keys = F.col("id").cast("string").alias("meta_id")
    for batch_id, share in enumerate((1_200_000, 1_000_000, 10)):
        rows = spark.range(share).select(keys, F.lit(batch_id).alias("v"), F.lit(D1).alias("kafka_date"))
        upsert(rows, table, writer="w", batch_id=batch_id)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(limit))
    try:
        assert compact(spark, table, min_share=float("inf"), note_from=0)
        assert len(layers.live(spark, table)) == 2
        read = read_current(spark, table, schema=SCHEMA)
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        got = {r.v: r["count"] for r in read.groupBy("v").count().collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {2: 10, 1: 1_000_000 - 10, 0: 200_000}


def test_only_rows_without_a_date(spark, table):
    _put(spark, table, [("a", 1, None)], 0)
    _put(spark, table, [("b", 2, None)], 1)
    assert _fold(spark, table)
    assert _state(spark, table) == {"a": (1, None), "b": (2, None)}
    assert read_current(spark, table, schema=None).schema["kafka_date"].dataType == T.DateType()


def test_batch_without_rows(spark, table):
    _put(spark, table, [("a", 1, D1)], 0)
    _put(spark, table, [], 1)
    _put(spark, table, [("b", 1, D1)], 2)
    expected = {"a": (1, D1), "b": (1, D1)}
    assert _state(spark, table) == expected
    assert read_current(spark, table, schema=None).count() == 2
    assert _fold(spark, table)
    assert _state(spark, table) == expected


def test_far_dates_survive(spark, table):
    far = spark.createDataFrame([("a",), ("b",)], "meta_id string").select(
        "meta_id", F.lit(1).alias("v"),
        F.to_date(F.timestamp_seconds(F.when(F.col("meta_id") == "a", 1_700_000_000_000).otherwise(-99_999_999_999)))
        .alias("kafka_date"),
    )
    upsert(far, table, writer="w", batch_id=0)
    _put(spark, table, [("c", 1, D1)], 1)
    assert _fold(spark, table)
    rows = read_current(spark, table, schema=SCHEMA).select("meta_id", F.col("kafka_date").cast("string")).collect()
    assert sorted(tuple(r) for r in rows) == [("a", "+55840-11-08"), ("b", "-1199-02-15"), ("c", "2024-01-01")]


def test_settings_do_not_hide_a_batch(spark, table):
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        _put(spark, table, [("a", 1, D1)], 0)
        _put(spark, table, [("a", 2, D2), ("b", 2, D1)], 1)
        _uncommit(table, 1)
        _put(spark, table, [("a", 3, D2)], 1)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert _state(spark, table) == {"a": (3, D2)}


@pytest.mark.parametrize("writer", ["fold", "a-b", ""])
def test_names_that_folders_cannot_carry(spark, table, writer):
    with pytest.raises(ValueError):
        _put(spark, table, [("a", 1, D1)], 0, writer=writer)


def test_trailing_slash(spark, table):
    _put(spark, f"{table}/", [("a", 1, D1)], 0)
    _put(spark, f"{table}/", [("a", 2, D1)], 1)
    assert _state(spark, f"{table}/") == _state(spark, table) == {"a": (2, D1)}


def test_readers_compare_only_noted_updates(spark, table):
    _put(spark, table, [(f"old{i}", 0, D1) for i in range(5000)], 0)
    _put(spark, table, [("old7", 1, D2), ("new1", 1, D2)], 1)
    _put(spark, table, [("old7", 2, D2), ("old8", 2, D1), ("new2", 2, D2)], 2)
    assert _fold(spark, table, min_share=0.9)
    newest, oldest = layers.live(spark, table)
    noted = spark.read.parquet(newest.updates(table)).collect()
    assert sorted(r.meta_id for r in noted) == ["old7", "old8"]

    rows = read_current(spark, table, schema=SCHEMA)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_updates" in plan and "hashpartitioning" not in plan
    changed = {r.meta_id: r.v for r in rows.filter("v > 0").collect()}
    assert changed == {"old7": 2, "old8": 2, "new1": 1, "new2": 2}
    assert rows.count() == 5002

    _put(spark, table, [("new1", 3, D1), ("old9", 3, D1)], 3)
    got = _state(spark, table)
    assert (got["new1"], got["old9"], got["old8"], len(got)) == ((3, D1), (3, D1), (2, D1), 5002)


def test_half_written_note_is_ignored(spark, table):
    _put(spark, table, [(f"k{i}", 0, D1) for i in range(5000)], 0)
    _put(spark, table, [("k1", 1, D1)], 1)
    _fold(spark, table, min_share=0.9)
    newest = layers.live(spark, table)[0]
    os.unlink(f"{newest.updates(table)}/_SUCCESS")
    assert _state(spark, table)["k1"] == (1, D1)


steps = st.lists(
    st.one_of(
        st.dictionaries(st.sampled_from("abcde"), st.integers(0, 9), min_size=1, max_size=5),
        st.sampled_from(["fold", "fold all", "redeliver", "half"]),
    ),
    min_size=1, max_size=7,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(sequence=steps, note_from=st.sampled_from([0, 1 << 40]))
def test_any_sequence_equals_a_dict(spark, sequence, note_from):
    table = folders.scratch(spark)
    expected, batch_id, last = {}, 0, None
    for step in sequence:
        if isinstance(step, dict):
            last = [(k, v, date(2024, 1, 1 + v)) for k, v in step.items()]
            _put(spark, table, last, batch_id)
            expected |= {k: (v, d) for k, v, d in last}
            batch_id += 1
        elif step == "redeliver" and last:
            _put(spark, table, last, batch_id - 1)
        elif step == "half" and last:
            _put(spark, table, [("a", 99, D1)], batch_id)
            _uncommit(table, batch_id)
        elif step.startswith("fold"):
            _fold(spark, table, 0.0 if step == "fold all" else 0.25, note_from)
    assert _state(spark, table) == expected
