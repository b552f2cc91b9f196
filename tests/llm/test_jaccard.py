import random
import re
from collections import Counter

import numpy as np
import pytest

from strata.llm import jaccard, shingles
from strata.llm.components import components
from strata.llm.jaccard import similar_documents
from tests.llm.cases import AWKWARD, ascii_lower, blank_words, documents


def shingle_set(text):
    words = blank_words(ascii_lower(text))
    return frozenset(tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute_force(rows):
    sets = [shingle_set(x[1]) for x in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 85 * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    found = []
    for i, row in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        found.append((row[0], len(sets[i]), min(ids, default=None) if sets[i] else row[0]))
    return Counter(found)


def near_copies(n, seed):
    """Chains of edited copies, a passage that many documents share, and exact copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    texts, made = [], []
    while len(texts) < n:
        if made and rng.random() < 0.6:
            text = list(rng.choice(made))
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = word()
        else:
            text = [word() for _ in range(rng.randrange(3, 160))]
            if rng.random() < 0.5:
                text[1:1] = passage
        made.append(text)
        texts.append(" ".join(text))
    return [(i, t, "en", "a") for i, t in enumerate(texts)]


def test_awkward_rows(spark):
    assert Counter(map(tuple, similar_documents(documents(spark)).collect())) == brute_force(AWKWARD)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies(spark, seed, monkeypatch):
    # Small chunks, so that documents meet across tasks; one round, so that the last step has work.
    monkeypatch.setattr(jaccard, "CHUNK_ROWS", 17)
    monkeypatch.setattr(jaccard, "ROUNDS", seed)
    rows = near_copies(250, seed)
    docs = documents(spark, rows).repartition(3)
    found = Counter(map(tuple, similar_documents(docs).collect()))
    assert found == brute_force(rows)
    assert len({x[2] for x in found}) < 200


def test_empty_tables(spark):
    assert similar_documents(documents(spark, [])).count() == 0
    blank = [(1, None, "en", "a"), (2, " ", "en", "a")]
    assert sorted(map(tuple, similar_documents(documents(spark, blank)).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    roots = {}
    for a, b in links:
        ra, rb = roots.get(a, {a}), roots.get(b, {b})
        for x in ra | rb:
            roots[x] = ra | rb
    found = {x.vertex: x.root for x in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: min(s) for x, s in roots.items() if min(s) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_tell_texts_apart(monkeypatch):
    texts = ["a b c d", "A B\tc\n d", "a b c", "ab c d", "a bc d", "a b cd", "", " ", None, "é É", "b c d a b c d e", "É é"]
    texts += [x[1] for x in AWKWARD]
    want = [shingle_set(x) for x in texts]
    for chunk in (1, 10, 1 << 20):
        monkeypatch.setattr(shingles, "_CHUNK", chunk)
        found = [frozenset(x.tolist()) for x in shingles.shingle_sets(texts, 4)]
        assert list(map(len, found)) == list(map(len, want))
        assert all((found[i] == found[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))
    assert not re.search("[A-Z]", ascii_lower("ABZ")) and np.uint64(1) == 1
