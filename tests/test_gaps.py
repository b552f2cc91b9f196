from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators import offset_gaps

SCHEMA = "topic string, partition int, offset bigint"


def _brute(rows):
    expected = set()
    for place in {row[:2] for row in rows}:
        offsets = sorted({row[2] for row in rows if row[:2] == place})
        expected |= {(*place, a, b) for a, b in zip(offsets, offsets[1:], strict=False) if b - a > 1}
    return expected


def _check(spark, rows):
    got = [tuple(r) for r in offset_gaps(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(set(got))
    assert set(got) == _brute(rows)


def test_dense_log_has_no_gap(spark):
    _check(spark, [("t", p, o) for p in range(3) for o in range(1000)])


def test_ends_are_no_gaps(spark):
    _check(spark, [("t", 0, 70), ("t", 0, 71), ("t", 1, 0)])


def test_gaps_at_every_level(spark):
    _check(spark, [("t", 0, o) for o in (
        0, 1, 3, 31, 32, 34, 64, 2**25 - 1, 2**25, 2**25 + 1, 2**46, 2**62, 2**63 - 2, 2**63 - 1
    )])


def test_repeated_records_do_not_hide_a_gap(spark):
    _check(spark, [("t", 0, 0), ("t", 0, 0), ("t", 0, 2), ("t", 0, 2)])


offsets = st.one_of(st.integers(0, 200), st.integers(2**25 - 50, 2**25 + 50), st.integers(0, 2**63 - 1))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["t", "u"]), st.integers(0, 2), offsets), min_size=1, max_size=120))
def test_any_log(spark, rows):
    _check(spark, rows)


def test_the_log_is_read_once(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([("t", p, o) for p in range(3) for o in range(0, 500, 3)], SCHEMA).write.parquet(path)
    gaps = offset_gaps(spark.read.parquet(path))
    assert len(gaps.collect()) == 3 * 166
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert final.count("FileScan") == 1
    assert "partial_bit_or" in final and "HashAggregate" in final
