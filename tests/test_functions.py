import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import epoch_text_to_timestamp, is_json

EPOCHS = [
    ("1700000000", 1700000000),
    (" 1700000000\n", 1700000000),
    ("+5", 5),
    ("-5", -5),
    ("1700000000.7", 1700000000),
    ("1.9999999999", 1),
    ("17.", 17),
    ("1.7e9", None),
    ("1.7000000007E9", None),
    ("abc", None),
    ("17.abc", None),
    ("", None),
    (None, None),
    ("99999999999999999999", None),
    ("9223372036854775807", None),
    ("1700000000000", 1700000000000),
    # The two instants of a repeated hour in New York.
    ("1699162200", 1699162200),
    ("1699165800", 1699165800),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_epoch_text(spark, ansi, zone):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(EPOCHS)], "i int, text string")
        got = rows.select("i", F.unix_seconds(epoch_text_to_timestamp(F.col("text"))).alias("s"))
        assert [r.s for r in got.orderBy("i").collect()] == [seconds for _, seconds in EPOCHS]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.session.timeZone", "UTC")


JSON_TEXTS = [
    '{"a":1}', ' {"a":1}\t', "[1]", "5", "null", '"x"', '{"a":{"b":[1,2,{"c":null}]}}',
    '{"a":1,"a":2}', '{"a":{"b":1,"b":2}}', '{"a":NaN}', '{"a":"\\u00e9"}', '{"a":"é"}',
    '{"a":1} xx', '{"a":1}}', '{"a":1}]', '{"a":1},{"b":2}', '{"a":1},"k":2', "1} xx", "1] xx",
    '{"a":1,"a":2} xx', '{"a":1,"a":2}]', "{'a':1}", '{"a":01}', '{"a":1,}', '{"a":1 "b":2}',
    "{bad", "", "  ", '{"a":', '{"a":tru}', '{"a":"x\ny"}',
]


def _reads(text):
    try:
        json.loads(text)
    except ValueError:
        return False
    return True


def _is_json(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.ok for r in rows.select("i", is_json(F.col("text")).alias("ok")).orderBy("i").collect()]


def test_is_json_agrees_with_json_reader(spark):
    assert _is_json(spark, JSON_TEXTS) == [_reads(text) for text in JSON_TEXTS]


def test_null_is_no_json(spark):
    assert _is_json(spark, [None]) == [False]


_objects = st.dictionaries(
    st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=5),
    st.recursive(
        st.none() | st.booleans() | st.integers(-(10**12), 10**12) | st.text(st.characters(codec="utf-8"), max_size=5),
        lambda inner: st.lists(inner, max_size=3),
        max_leaves=5,
    ),
    max_size=4,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(_objects, min_size=1, max_size=20),
    cut=st.integers(1, 10),
    tail=st.sampled_from(["}", "]", ",", "x", "{}"]),
)
def test_is_json_on_whole_cut_and_extended_objects(spark, values, cut, tail):
    whole = [json.dumps(v, ensure_ascii=False) for v in values]
    texts = whole + [t[:-cut] for t in whole] + [t + tail for t in whole]
    assert _is_json(spark, texts) == [_reads(text) for text in texts]
