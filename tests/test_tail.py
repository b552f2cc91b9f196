from strata.operators import end_offsets, tail_after

SCHEMA = "topic string, partition int, offset bigint"


def _log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


SEEN = [("t", 0, 0), ("t", 0, 4), ("t", 1, 7)]
ALL = [*SEEN, ("t", 0, 5), ("t", 0, 3), ("t", 1, 8), ("t", 2, 0), ("u", 0, 0)]
NEW = {("t", 0, 5), ("t", 1, 8), ("t", 2, 0), ("u", 0, 0)}


def _tail(spark):
    got = tail_after(_log(spark, ALL), end_offsets(_log(spark, SEEN)))
    assert got.columns == ["topic", "partition", "offset"]
    return [tuple(r) for r in got.collect()]


def test_records_after_the_marks(spark):
    got = _tail(spark)
    assert set(got) == NEW and len(got) == len(NEW)


def test_many_topic_partitions(spark):
    seen = [("t", p, 10 + p) for p in range(600)]
    log = seen + [("t", p, 11 + p) for p in range(600)] + [("t", 600, 0)]
    got = tail_after(_log(spark, log), end_offsets(_log(spark, seen))).collect()
    assert len(got) == 601 and all(r.offset == 11 + r.partition or r.partition == 600 for r in got)


def test_a_partition_between_marked_ones_is_read_whole(spark):
    got = tail_after(_log(spark, [("t", 1, 0), ("t", 2, 9)]), end_offsets(_log(spark, [("t", 0, 5), ("t", 2, 8)])))
    assert sorted(tuple(r) for r in got.collect()) == [("t", 1, 0), ("t", 2, 9)]


def test_without_marks_the_log_is_read_whole(spark):
    assert tail_after(_log(spark, ALL), end_offsets(_log(spark, []))).count() == len(ALL)


def test_marks_reach_the_scan(spark, tmp_path):
    _log(spark, ALL).write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    plan = tail_after(log, end_offsets(_log(spark, SEEN)))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThan(offset,4)" in pushed
