import random
import re
from collections import Counter

import duckdb
import pytest

from strata.llm import licenses
from tests.llm.cases import AWKWARD, ascii_lower, documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_force(text):
    words = WORD.findall(ascii_lower(text))
    places = [
        (i, label) for phrase, label in licenses.BASE_PHRASES.items() for i in range(len(words))
        if words[i:i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    labels = ",".join(sorted({x for _, x in places}))
    return len(words), len(at), min(at, default=None), max(at, default=None), labels


def test_base_phrases(spark):
    rows = AWKWARD + [
        (20, "mit license " * 300 + "cc-by", "en", "a"), (21, "mit", "en", "a"), (22, "license mit", "en", "a"),
        (23, "GNU GENERAL GNU general public license apache license cc bye", "en", "a"), (24, "ccby cc by", "en", "a"),
    ]
    found = licenses.license_scan(documents(spark, rows))
    got = Counter((x.doc_id, x.n_words, x.n_base, x.first_word, x.last_word, x.base_labels) for x in found.collect())
    assert got == Counter((x[0], *brute_force(x[1])) for x in rows)
    assert all(0 <= x.score <= 1 for x in found.collect())


def test_edited_notices(spark):
    notice = next(iter(licenses.NOTICES)).split()
    edited = notice[:8] + ["quite", "another"] + notice[8:15] + notice[16:]
    rows = [
        (1, " ".join(["before"] * 30 + notice + ["after"]), "en", "a"), (2, " ".join(edited), "en", "a"),
        (3, " ".join(notice[:10]), "en", "a"), (4, " ".join(sorted(notice)), "en", "a"),
        (5, " filler words here ".join(notice), "en", "a"),
    ]
    found = {x.doc_id: x for x in licenses.license_scan(documents(spark, rows)).collect()}
    assert [found[i].labels for i in range(1, 6)] == ["mit-notice", "mit-notice", "", "", ""]
    assert found[1].score == 1 and 0.7 <= found[2].score < 1 and found[3].score < 0.7
    assert all(x.base_labels == "" and x.n_base == 0 for x in found.values())


def runs_brute_force(text, notices=licenses.NOTICES):
    """Labels of notices, by trying each run of each span's diagonals."""
    words, labels = WORD.findall(ascii_lower(text)), set()
    for phrase, label in notices.items():
        known, votes = phrase.split(), {}
        for p in range(len(words) - 1):
            for t in range(len(known) - 1):
                if words[p:p + 2] == known[t:t + 2]:
                    votes.setdefault(p - t, set()).add(t)
        n, order = len(known) - 1, sorted(votes)
        for i in range(len(order)):
            held = set()
            for j in range(i, len(order)):
                if j > i and order[j] - order[j - 1] > licenses.GAP:
                    break
                if order[j] - order[i] + n <= licenses.STRETCH * n:
                    held |= votes[order[j]]
            if len(held) >= licenses.COVERAGE * n:
                labels.add(label)
    return ",".join(sorted(labels))


def test_common_pairs_beside_a_notice(spark):
    notices = list(licenses.NOTICES)
    texts = [
        "released under the terms of the license of the project",
        "this work is licensed under the license of the owner and under the law",
        *[f"{x} of the under the license of the terms of the license of the software" for x in notices],
        *[f"of the under the license of the {x}" for x in notices],
        "under the terms of the license of the terms of the", "of the license " * 40, "this work is",
    ]
    rows = [(i, x, "en", "a") for i, x in enumerate(texts)]
    found = {x.doc_id: x for x in licenses.license_scan(documents(spark, rows), base={"no such phrase": "x"}).collect()}
    assert [found[0].labels, found[1].labels] == ["license-grant", "license-grant"]
    assert {i: x.labels for i, x in found.items()} == {i: runs_brute_force(t) for i, t in enumerate(texts)}


def test_sql_finds_a_notice_beside_common_pairs(spark, tmp_path):
    texts = [
        "released under the terms of the license of the project",  # judged as one span, it is too long
        "this work is licensed under the license of the owner and under the law", "of the license " * 40, "MIT license", "", None,
        *[f"{x} of the under the license of the terms of the" for x in licenses.NOTICES],
    ]
    docs = documents(spark, [(i, x, "en", "a") for i, x in enumerate(texts)])
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    result = con.execute(licenses.oracle_sql())
    names = [x[0] for x in result.description]
    assert Counter(result.fetchall()) == Counter(map(tuple, licenses.license_scan(docs).select(*names).collect()))
    assert "license-grant" in {x.labels for x in licenses.license_scan(docs).collect()}


def test_templates_of_any_length(spark):
    rng = random.Random(3)
    whole = [rng.choice(["of", "the", "license", "software", "shall", "you", "may", "not"]) if i % 3 else f"term{i}" for i in range(900)]
    short = " ".join(whole[:30])
    edited = list(whole)
    for i in range(0, 900, 40):
        edited[i] = "other"
    del edited[500:520]
    edited[200:200] = ["inserted"] * 15
    texts = [
        " ".join(["before"] * 500 + whole + ["after"] * 500), " ".join(edited), " ".join(whole[:600]), " ".join(whole[:700]),
        " ".join(sorted(whole)), "of the license " * 300, " ".join(whole + whole), short, None, " ".join(whole[450:] + whole[:450]),
    ]
    notices = {" ".join(whole): "whole", short: "short"}
    rows = [(i, x, "en", "a") for i, x in enumerate(texts)]
    found = licenses.license_scan(documents(spark, rows), base={"the license": "x"}, notices=notices).collect()
    got = {x.doc_id: {y for y in x.labels.split(",") if y and y != "x"} for x in found}
    assert got == {i: {x for x in runs_brute_force(t, notices).split(",") if x} for i, t in enumerate(texts)}
    assert got[0] >= {"whole"} and got[1] >= {"whole"} and "whole" not in got[2] and "whole" in got[3]
    assert {x.doc_id: x.score for x in found}[0] == 1
    with pytest.raises(ValueError):
        licenses.templates(spark, {"word": "x"}, {})


def test_empty_table(spark):
    assert licenses.license_scan(documents(spark, [])).count() == 0


def test_plan_stays_native(spark):
    plan = licenses.license_scan(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
