import hashlib
from collections import Counter

from pyspark.sql import functions as F

from strata.llm.exact_dedup import deduplicated, duplicate_groups
from tests.llm.cases import AWKWARD, ascii_lower, documents


def brute_force(rows):
    found = []
    for i, text, *_ in rows:
        same = [r[0] for r in rows if ascii_lower(r[1]) == ascii_lower(text)]
        keep = max((x for x in same if x is not None), default=None)
        digest = hashlib.sha256(ascii_lower(text).encode()).hexdigest()
        found.append((i, keep, len(same), i == keep, digest))
    return Counter(found)


def test_awkward_rows(spark):
    assert Counter(map(tuple, duplicate_groups(documents(spark)).collect())) == brute_force(AWKWARD)


def test_texts_that_share_a_digest_are_compared_in_full(spark):
    weak = lambda content: F.substring(content, 1, 1)
    rows = [(i, f"{'xy'[i % 2]}{i % 5}", "en", "a") for i in range(40)]
    found = duplicate_groups(documents(spark, rows), digest=weak).select("doc_id", "keep_id", "group_size")
    assert Counter(map(tuple, found.collect())) == Counter(x[:3] for x in brute_force(rows))


def test_one_row_of_each_text_stays_with_its_columns(spark):
    docs = documents(spark)
    kept = deduplicated(docs)
    assert kept.columns == docs.columns
    found = [(x.doc_id, x.text) for x in kept.collect()]
    assert len({ascii_lower(t) for _, t in found}) == len(found)
    assert {ascii_lower(t) for _, t in found} == {ascii_lower(x[1]) for x in AWKWARD}
    assert (4, "a bC") in found and (6, AWKWARD[5][1]) in found


def test_distinct_ids_take_the_short_way(spark):
    rows = [(i, f"text {i % 3}", "en", "a") for i in range(9)]
    assert sorted(x.doc_id for x in deduplicated(documents(spark, rows)).collect()) == [6, 7, 8]


def test_empty_table(spark):
    assert duplicate_groups(documents(spark, [])).count() == 0
    assert deduplicated(documents(spark, [])).count() == 0


def test_plan_stays_native(spark):
    plan = duplicate_groups(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
