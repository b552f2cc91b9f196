"""Batches whose columns, types or keys conflict with the table, and lookups of few keys."""

import glob
import hashlib
import importlib
import os
import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import folders, layers
from strata.operators import compact, upsert
from strata.operators.evolve import SchemaConflict, common_type
from strata.operators.merged import columns_of, read_layers, with_keys
from strata.sources import read_current

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)


@pytest.fixture
def table(spark):
    return folders.scratch(spark)


def put(spark, table, rows, kind, batch_id, name="v", **options):
    batch = spark.createDataFrame(rows, f"meta_id string, `{name}` {kind}, kafka_date date")
    return upsert(batch, table, writer="w", batch_id=batch_id, **options)


def values(spark, table, name="v"):
    return {r.meta_id: r[name] for r in read_current(spark, table, schema=None).collect()}


def tree(table):
    return sorted(x for x in glob.glob(f"{table}/**", recursive=True, include_hidden=True) if os.path.isfile(x))


PAIRS = [
    ("tinyint", 7, "smallint", 300, "smallint"), ("smallint", 7, "int", 70_000, "int"),
    ("int", 7, "bigint", 1 << 40, "bigint"), ("float", 0.5, "double", 0.1, "double"), ("int", 7, "double", 0.1, "double"),
    ("int", 7, "decimal(5,2)", Decimal("1.25"), "decimal(12,2)"),
    ("bigint", 1 << 60, "decimal(5,2)", Decimal("1.25"), "decimal(22,2)"),
    ("decimal(5,2)", Decimal("1.25"), "decimal(9,4)", Decimal("1.1250"), "decimal(9,4)"),
    ("date", D1, "timestamp_ntz", datetime(2024, 1, 1, 5), "timestamp_ntz"),
    ("array<int>", [1], "array<bigint>", [1 << 40], "array<bigint>"),
    ("struct<x:int,y:string>", (1, "s"), "struct<x:bigint,y:string>", (1 << 40, "t"), "struct<x:bigint,y:string>"),
    ("map<string,float>", {"k": 0.5}, "map<string,double>", {"k": 0.1}, "map<string,double>"),
]


@pytest.mark.parametrize("narrow, a, wide, b, both", PAIRS)
@pytest.mark.parametrize("narrow_first", [True, False])
def test_types_become_the_wider_one(spark, table, narrow, a, wide, b, both, narrow_first):
    batches = [("n", a, narrow), ("w", b, wide)]
    for batch_id, (key, value, kind) in enumerate(batches if narrow_first else batches[::-1]):
        put(spark, table, [(key, value, D1), (f"null {key}", None, D1)], kind, batch_id)
    found = read_current(spark, table, schema=None)
    assert found.schema["v"].dataType.simpleString() == both
    want = spark.createDataFrame([(a,)], f"v {narrow}").select(F.col("v").cast(both)).first().v
    for _ in range(2):
        got = values(spark, table)
        assert got == {"n": want, "w": b, "null n": None, "null w": None}
        compact(spark, table, min_share=0)
    put(spark, table, [("n", a, D2)], narrow, 9)
    assert values(spark, table)["n"] == want


CONFLICTS = [
    ("int", "string"), ("string", "int"), ("bigint", "double"), ("double", "bigint"), ("timestamp", "date"), ("boolean", "int"),
    ("date", "timestamp"), ("bigint", "decimal(38,30)"), ("binary", "string"), ("array<int>", "int"),
    ("struct<x:int>", "struct<y:int>"), ("struct<x:int>", "struct<x:string>"), ("map<string,int>", "map<int,int>"),
]


@pytest.mark.parametrize("old, new", CONFLICTS)
def test_an_incompatible_type_leaves_the_table_as_it_was(spark, table, old, new):
    put(spark, table, [("a", None, D1)], old, 0)
    before = tree(table)
    with pytest.raises(SchemaConflict, match="column v is"):
        put(spark, table, [("a", None, D2)], new, 1)
    assert tree(table) == before
    assert values(spark, table) == {"a": None}
    put(spark, table, [("a", None, D2)], old, 1)
    assert len(layers.live(spark, table)) == 2


def test_names_that_differ_in_case_only_are_refused(spark, table):
    put(spark, table, [("a", 1, D1)], "int", 0)
    before = tree(table)
    with pytest.raises(SchemaConflict, match="case"):
        put(spark, table, [("a", 1, D1)], "int", 1, name="V")
    assert tree(table) == before


def test_repeated_names_and_columns_without_a_type_are_refused(spark, table):
    batch = spark.createDataFrame([("a", 1, D1)], "meta_id string, v int, kafka_date date")
    for wrong in (batch.withColumn("w", F.lit(None)), batch.select("*", F.lit(1).alias("v"))):
        with pytest.raises(SchemaConflict):
            upsert(wrong, table, writer="w", batch_id=0)
    assert not tree(table)
    upsert(batch, table, writer="w", batch_id=0)
    upsert(batch.withColumn("v", F.lit(None)), table, writer="w", batch_id=1)
    assert values(spark, table) == {"a": None}


def test_the_partition_keeps_its_type(spark, table):
    put(spark, table, [("a", 1, D1)], "int", 0)
    batch = spark.createDataFrame([("a", 1, datetime(2024, 1, 1, 5))], "meta_id string, v int, kafka_date timestamp_ntz")
    with pytest.raises(SchemaConflict, match="kafka_date"):
        upsert(batch, table, writer="w", batch_id=1)


def test_keys_become_wider(spark, table):
    for batch_id, (kind, key) in enumerate([("int", 1), ("bigint", 1 << 40), ("int", 1)]):
        batch = spark.createDataFrame([(key, batch_id, D1), (2, batch_id, D1)], f"k {kind}, v int, kafka_date date")
        upsert(batch, table, writer="w", batch_id=batch_id, key="k")
    got = {r.k: r.v for r in read_current(spark, table, key="k", schema=None).collect()}
    assert got == {1: 2, 2: 2, 1 << 40: 1}
    compact(spark, table, key="k", min_share=float("inf"), note_from=0)
    got = {r.k: r.v for r in read_current(spark, table, key="k", schema=None).collect()}
    assert got == {1: 2, 2: 2, 1 << 40: 1}


def test_declared_types_follow_the_table(spark, table):
    put(spark, table, [("a", 1 << 40, D1)], "bigint", 0)
    declared = T.StructType([T.StructField("meta_id", T.StringType()), T.StructField("v", T.IntegerType())])
    assert read_current(spark, table, schema=declared).first().v == 1 << 40
    declared.fields[1].dataType = T.DecimalType(30, 2)
    assert read_current(spark, table, schema=declared).first().v == 1 << 40
    declared.fields[1].dataType = T.StringType()
    with pytest.raises(SchemaConflict):
        read_current(spark, table, schema=declared)


@pytest.mark.parametrize("a, b, both", [
    (T.ByteType(), T.LongType(), T.LongType()), (T.LongType(), T.FloatType(), None), (T.NullType(), T.DateType(), T.DateType()),
    (T.FloatType(), T.IntegerType(), None), (T.DecimalType(38, 0), T.DecimalType(38, 1), None),
    (T.DecimalType(10, 4), T.DecimalType(10, 0), T.DecimalType(14, 4)), (T.TimestampType(), T.TimestampNTZType(), None),
])
def test_common_types(a, b, both):
    assert common_type(a, b) == common_type(b, a) == both


# One row per key


@pytest.mark.parametrize("rows, says", [
    ([("a", 1, D1), ("b", 1, D1), ("a", 2, D2)], "several rows of one meta_id: a"),
    ([("a", 1, D1), (None, 1, D1)], "without meta_id"),
    ([(None, 1, D1), (None, 2, D1)], "without meta_id"),
    ([("hot", i, D1) for i in range(3000)] + [("b", 1, D1)], "several rows of one meta_id: hot"),
])
def test_a_repeated_or_null_key_leaves_the_table_as_it_was(spark, table, rows, says):
    put(spark, table, [("a", 0, D1)], "int", 0)
    before = tree(table)
    with pytest.raises(Exception, match=says):
        put(spark, table, rows, "int", 1)
    assert tree(table) == before
    assert len([x for x in os.listdir(table) if x.startswith("layer=")]) == 1
    assert values(spark, table) == {"a": 0}
    put(spark, table, [("a", 1, D1), ("b", 1, D1)], "int", 1)
    assert values(spark, table) == {"a": 1, "b": 1}


def test_the_guard_sends_two_rows_of_a_key_and_task(spark):
    from strata.operators.upsert import one_row_per_key

    rows = spark.range(0, 1000, 1, 4).select((F.col("id") % 2).alias("meta_id"), F.col("id").alias("v"))
    plan = one_row_per_key(rows, "meta_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "WindowGroupLimit" in plan


def test_vouched_keys_are_not_looked_at(spark, table, monkeypatch):
    code = importlib.import_module("strata.operators.upsert")
    monkeypatch.setattr(code, "one_row_per_key", lambda *_: pytest.fail("looked at"))
    put(spark, table, [("a", 1, D1)], "int", 0, distinct_keys=True)
    assert values(spark, table) == {"a": 1}


# Lookups


def wide_table(spark, table, n=60_000, files=6):
    """Keys of all ranges in each file, so that only a bloom filter tells where one is."""
    rows = spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("meta_id"), F.col("id").alias("v"),
        F.concat(F.lit("x"), F.col("id").cast("string")).alias("extra"),
        F.date_add(F.lit(D1), (F.col("id") % files).cast("int")).alias("kafka_date"),
    )
    upsert(rows, table, writer="w", batch_id=0, distinct_keys=True)


def key_of(i):
    return hashlib.sha256(str(i).encode()).hexdigest()


def scanned(df):
    """Rows that the file scans of an executed DataFrame gave."""
    def walk(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            yield from walk(plan.executedPlan())
        if name.startswith(("ShuffleQueryStage", "BroadcastQueryStage")):
            yield from walk(plan.plan())
        if name.startswith("Scan parquet"):
            yield plan.metrics().apply("numOutputRows").value()
        children = plan.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    return sum(walk(df._jdf.queryExecution().executedPlan()))


def test_few_keys_skip_row_groups(spark, table):
    wide_table(spark, table)
    live = layers.live(spark, table)
    keys = spark.createDataFrame([(key_of(i),) for i in (3, 9, 15)], "meta_id string")  # all of one date
    schema = columns_of(spark, table, live)
    found = read_layers(spark, table, live, "meta_id", schema, wanted=with_keys(keys))
    assert sorted(r.v for r in found.collect()) == [3, 9, 15]
    assert scanned(found) == 10_000
    many = spark.createDataFrame([(key_of(i),) for i in range(0, 60_000, 100)], "meta_id string")
    found = read_layers(spark, table, live, "meta_id", schema, wanted=with_keys(many))
    assert found.count() == 600
    assert "left_semi" in found._jdf.queryExecution().toString().lower().replace("leftsemi", "left_semi")


def test_bloom_filters_are_small_where_files_are(spark, table):
    put(spark, table, [(key_of(i), i, D1) for i in range(50)], "int", 0)
    assert folders.size(spark, table) < 12_000


def test_a_batch_that_lacks_columns_neither_shuffles_nor_broadcasts_the_table(spark, table, monkeypatch):
    wide_table(spark, table)
    code = importlib.import_module("strata.operators.upsert")
    plans = []
    write = code.write_layer

    def seen(rows, path, partition, key):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, path, partition, key)

    monkeypatch.setattr(code, "write_layer", seen)
    put(spark, table, [(key_of(i), -i, D2) for i in range(5)], "bigint", 1)
    (plan,) = plans
    # The scan of the table carries the keys; what is left of it is joined to the batch.
    assert "In(meta_id, [" in plan
    got = {r.meta_id: (r.v, r.extra) for r in read_current(spark, table, schema=None).filter("v <= 0").collect()}
    assert got == {key_of(i): (-i, f"x{i}") for i in range(5)}
    put(spark, table, [(key_of(i), -i, D2) for i in range(0, 3000)], "bigint", 2)
    assert "LeftSemi" in plans[1] and plans[1].count("hashpartitioning") == 0
    got = {r.meta_id: (r.v, r.extra) for r in read_current(spark, table, schema=None).filter("v <= 0").collect()}
    assert got == {key_of(i): (-i, f"x{i}") for i in range(3000)}
    assert not glob.glob(f"{table}/_staged/*")


# The newer row wins


def test_newer_rows_win_in_any_order(spark, table):
    batches = [
        [("a", 1, 5, D1), ("b", 1, 1, D1), ("c", 1, None, D1)],
        [("a", 2, 3, D2), ("b", 2, 9, D2), ("c", 2, 0, D2), ("d", 2, 1, D1)],
        [("a", 3, 5, D2), ("b", 3, 8, D2), ("c", 3, None, D2), ("d", 3, None, D2)],
    ]
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        place = f"{table}/{''.join(map(str, order))}"
        for batch_id, n in enumerate(order):
            batch = spark.createDataFrame(batches[n], "meta_id string, v int, t int, kafka_date date")
            upsert(batch, place, writer="w", batch_id=batch_id, newer_by=["t", "v"])
        for _ in range(2):
            assert values(spark, place) == {"a": 3, "b": 2, "c": 2, "d": 2}
            compact(spark, place, min_share=0)


def test_rows_without_the_order_are_the_oldest(spark, table):
    put(spark, table, [("a", 1, D1), ("b", 1, D1)], "int", 0)
    batch = spark.createDataFrame([("a", 2, 0, D1), ("c", 2, 0, D1)], "meta_id string, v int, t int, kafka_date date")
    upsert(batch, table, writer="w", batch_id=1, newer_by=["t"])
    assert values(spark, table) == {"a": 2, "b": 1, "c": 2}


# Notes by date


def test_one_date_opens_its_own_notes(spark, table):
    days = [date(2024, 1, 1 + i) for i in range(4)]
    put(spark, table, [(f"k{i}", 0, days[i % 4]) for i in range(4000)], "int", 0)
    put(spark, table, [(f"k{i}", 1, days[3]) for i in range(0, 4000, 40)] + [("new", 1, days[0])], "int", 1)
    put(spark, table, [("k0", 2, days[1]), ("k2", 2, None)], "int", 2)
    assert compact(spark, table, min_share=0.9, note_from=0)
    newest, _ = layers.live(spark, table)
    noted = spark.read.parquet(newest.updates(table))
    assert {str(r.kafka_date) for r in noted.select("kafka_date").distinct().collect()} == {"2024-01-01", "2024-01-03"}
    for day in days:
        found = read_current(spark, table, schema=None).filter(F.col("kafka_date") == day)
        plan = found._jdf.queryExecution()
        got = {r.meta_id: r.v for r in found.collect()}
        want = {f"k{i}": 0 for i in range(4000) if days[i % 4] == day and i % 40 and i != 2}
        if day == days[3]:
            want |= {f"k{i}": 1 for i in range(40, 4000, 40)}
        if day == days[0]:
            want["new"] = 1
        if day == days[1]:
            want["k0"] = 2
        assert got == want
        text = re.sub(r"#\d+", "", plan.executedPlan().toString())
        filters = re.findall(r"PartitionFilters: (\[.*?\]), PushedFilters", text)
        assert sorted(set(filters)) == [
            f"[(kafka_date = {day}), isnotnull(kafka_date), isnotnull(layer)]",  # notes of that date
            f"[isnotnull(kafka_date), (kafka_date = {day})]",
            "[isnull(kafka_date), isnotnull(layer)]",  # of rows without a date
        ]
    assert values(spark, table)["k2"] == 2


def test_rows_without_a_date_are_replaced_by_noted_folders(spark, table):
    put(spark, table, [(f"k{i}", 0, None if i % 2 else D1) for i in range(3000)], "int", 0)
    put(spark, table, [("k1", 1, D1), ("k2", 1, None), ("k3", 1, None)], "int", 1)
    compact(spark, table, min_share=0.9, note_from=0)
    newest, _ = layers.live(spark, table)
    assert folders.is_complete(spark, newest.updates(table))
    got = values(spark, table)
    assert len(got) == 3000 and [got[f"k{i}"] for i in range(5)] == [0, 1, 1, 1, 0]
