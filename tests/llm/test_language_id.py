import itertools
import re
import zlib

import numpy as np
import pytest

from strata.llm import language_id, word_crf
from tests.llm.cases import AWKWARD, documents


def test_marginals_equal_all_paths(monkeypatch):
    rng = np.random.default_rng(0)
    k = 3
    transition, start = rng.normal(size=(k, k)), rng.normal(size=k)
    lengths = [1, 2, 5, 7, 1, 6]
    emission = rng.normal(size=(sum(lengths), k)) * 2
    starts = np.cumsum(lengths) - lengths
    want, pairs = [], []
    for at, n in zip(starts, lengths):
        e, p, j, total = emission[at:at + n], np.zeros((n, k)), np.zeros((k, k)), 0
        for y in itertools.product(range(k), repeat=n):
            w = np.exp(start[y[0]] + sum(e[i, y[i]] for i in range(n)) + sum(transition[a, b] for a, b in zip(y, y[1:])))
            total += w
            p[np.arange(n), y] += w
            np.add.at(j, (y[:-1], y[1:]), w)
        want.append(p / total)
        pairs.append(j / total)
    for segment in (1, 2, 64):
        monkeypatch.setattr(word_crf, "SEGMENT", segment)
        found = word_crf.marginals(emission, starts, transition, start)
        assert np.allclose(found, np.concatenate(want))
    assert np.allclose(word_crf._pair_marginals(emission[3:8], want[2], transition, 1, 5), pairs[2], atol=1e-6)


def test_words_and_features():
    texts = ["Ab c'd 12 e_f", None, "É日本 \u0663x", "", "İß—Ω", "a" * 3000]
    words = word_crf.words_of(texts)
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends)]
    want = [re.findall(r"[^\W\d_]+", (t or "").lower()) for t in texts]
    assert found == [w for t in want for w in t] and words.counts.tolist() == list(map(len, want))
    lexicon = np.sort(word_crf.hash_spans(words.data, words.starts[:1], words.ends[:1]))
    flat, counts = word_crf.features(words.data, words.starts, words.ends, lexicon)
    for i, word in enumerate(found):
        n = len(word.encode())
        grams = sum(max(0, n + 3 - g) for g in word_crf.NGRAMS)
        affixes = 2 * sum(n >= a for a in word_crf.AFFIXES)
        assert counts[i] == grams + affixes + (word == "ab")
        alone = word_crf.features(words.data, words.starts[i:i + 1], words.ends[i:i + 1], lexicon)[0]
        assert sorted(alone) == sorted(flat[counts[:i].sum():counts[:i + 1].sum()])


def corpus(n=240):
    words = {"en": "the of and to in is that with", "de": "der und das ist nicht ein mit von", "fr": "le de un et est pour dans que"}
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        lang = sorted(words)[i % 3]
        rows.append((i, " ".join(rng.choice(words[lang].split(), 12)), lang, "a"))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    docs = documents(spark, rows)
    found = {x.doc_id: x for x in language_id.identify(docs, language_id.fit(docs)).collect()}
    assert len(found) == len(rows)
    for i, _, lang, _ in rows:
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= found[i].score <= 1
    held = [(found[i].lang_pred, lang) for i, _, lang, _ in rows if found[i].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) > 0


def test_prediction_uses_the_text_alone(spark):
    rows = corpus()
    model = language_id.fit(documents(spark, rows))
    text = "the of and to der und das ist"
    docs = documents(spark, [(0, text, "xx", "z"), (11, text, None, None), (None, text, "fr", "a")])
    found = language_id.identify(docs, model).collect()
    assert len({(x.lang_pred, x.score) for x in found}) == 1
    # Held-out rows teach nothing.
    changed = [(i, t, "fr" if zlib.crc32(str(i).encode()) % 5 == 0 else lang, s) for i, t, lang, s in rows]
    again = language_id.fit(documents(spark, changed))
    assert np.array_equal(model.weights, again.weights)


def test_code_switched_words(spark):
    model = language_id.fit(documents(spark, corpus()))
    text = " ".join(["the of and to in is"] * 2 + ["der und das ist nicht ein"] * 2)
    row = language_id.identify(documents(spark, [(1, text, None, None)]), model, spans=True).first()
    assert [(x.lang, x.first, x.n) for x in row.spans] == [("en", 0, 12), ("de", 12, 12)]


def test_awkward_rows(spark):
    model = language_id.fit(documents(spark, corpus()))
    model.table_bits = 3
    found = language_id.identify(documents(spark), model, spans=True).collect()
    assert len(found) == len(AWKWARD)
    blank = [x for x in found if x.lang_pred == "und"]
    assert len(blank) == 4 and all(x.score == 0 and not x.spans for x in blank)


@pytest.mark.parametrize("rows", [[], [(1, "some text", None, "a"), (2, None, "en", "a")]])
def test_nothing_to_learn_from(spark, rows):
    docs = documents(spark, rows)
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    assert [x.lang_pred for x in found] == ["und"] * len(rows)


def drawn_spans(docs, monkeypatch, **options):
    kept = {}
    monkeypatch.setattr(word_crf, "fit", lambda spans: kept.update(spans))
    language_id.fit(docs, **options)
    return kept


def test_rows_are_drawn_and_not_ids(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(3, text, "en", "a")] * 5000 + [(i, "der und das", "de", "a") for i in range(900, 960)]
    assert zlib.crc32(b"3") % 5
    spans = drawn_spans(documents(spark, rows).repartition(8), monkeypatch, rows_per_language=40, span_characters=100)
    held = sum(zlib.crc32(str(i).encode()) % 5 == 0 for i in range(900, 960))
    assert len(spans["en"]) == 40 and len(spans["de"]) == min(40, 60 - held)
    assert all(len(x) == 100 and x in text for x in spans["en"]) and len(set(spans["en"])) > 20


def test_the_commonest_languages_are_learned(spark, monkeypatch):
    rows = [(i, "some text", lang, "a") for i, lang in enumerate(["a"] * 30 + ["b"] * 20 + ["c"] * 25)]
    assert set(drawn_spans(documents(spark, rows), monkeypatch, most_languages=2)) == {"a", "c"}


def test_one_pass_sends_spans_and_no_documents(spark, monkeypatch):
    plans, kind = [], type(documents(spark))
    collect = kind.collect

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return collect(df)

    monkeypatch.setattr(kind, "collect", seen)
    language_id.fit(documents(spark, corpus(30)))
    (plan,) = plans
    # Rows reach the exchange by language with their spans, at most so many of each task and language.
    before = plan[plan.index("hashpartitioning(lang"):]
    assert "substr" in before and "WindowGroupLimit" in before
