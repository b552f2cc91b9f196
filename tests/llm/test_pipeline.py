import pyarrow as pa
import pytest

import corpus_pipeline
from strata.llm import batch_encoder, packing, pretokens
from strata.llm.common import character_chunks, lean, written
from tests.llm.cases import AWKWARD, ascii_lower, documents
from tests.llm.test_jaccard import brute_force, near_copies
from tests.llm.test_language_id import corpus


def labelled(n):
    """Documents of known languages, copies, near copies, and texts without letters."""
    rows = [(i, f"{t} " * 3 + f"number {i}", lang, s) for i, t, lang, s in corpus(n)]
    at = len(rows)
    rows += [(at + i, t.upper(), lang, "b") for i, (_, t, lang, _) in enumerate(rows[:20])]
    rows += [(2 * at + i, "the of and to in is that with " + t, "en", "c") for i, t, _, _ in near_copies(60, 5)]
    return rows + [(3 * at, "123 456", "en", "b"), (3 * at + 1, None, "de", None)]


def test_stages_take_effect(spark):
    rows = labelled(90)
    docs = written(documents(spark, rows))
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(written(stage(spark, kept[-1], "")))
        assert kept[-1].columns == docs.columns
    texts = [{x.doc_id: x.text for x in k.select("doc_id", "text").collect()} for k in kept]
    lettered = {i for i, t in texts[0].items() if any(c.isalpha() for c in t or "")}
    assert texts[1].keys() <= lettered and len(texts[1]) >= 0.9 * len(lettered)
    by_text = {}
    for i, t in texts[1].items():
        by_text[ascii_lower(t)] = max(i, by_text.get(ascii_lower(t), -1))
    assert texts[2].keys() == set(by_text.values())
    near = brute_force([(i, t) for i, t in texts[2].items()])
    assert texts[3].keys() == {x[0] for x in near if x[0] == x[2]}
    assert texts[4].keys() <= texts[3].keys()
    assert kept[4].count() > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept[4], "").collect()
    assert len([x for x in pieces if x.start == 0]) == kept[4].count()


@pytest.mark.parametrize("rows", [[], AWKWARD])
def test_awkward_tables_pass_each_stage(spark, rows):
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        found = written(stage(spark, docs, ""))
        assert name == "pack" or found.columns == docs.columns


def test_language_is_decided_row_by_row(spark):
    rows = corpus(60)
    clean = [x[1] for x in rows[:4]]
    added = [(None, clean[0], "en", "a"), (None, None, "en", "a"), (None, "123", "en", "a"), (9_000, clean[1], "en", "a"),
             (9_000, "123 456", "en", "a"), (9_000, None, "en", "a"), (9_001, clean[2], "en", "a"), (9_001, clean[2], "en", "a")]
    kept = corpus_pipeline.keep_known_languages(spark, written(documents(spark, rows + added)), "")
    found = [(x.doc_id, x.text) for x in kept.collect() if x.doc_id is None or x.doc_id >= 9_000]
    want = [(None, clean[0]), (9_000, clean[1]), (9_001, clean[2]), (9_001, clean[2])]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_one_row_of_each_group_of_near_copies(spark):
    text = lambda name, end="": " ".join(f"{name}{i}" for i in range(100)) + f" {end}"
    rows = [
        (None, text("a", "x"), "en", "a"), (None, text("a", "y"), "en", "a"),  # only null ids
        (None, text("b", "x"), "en", "a"), (7, text("b", "y"), "en", "a"), (8, text("b", "z"), "en", "a"),
        (3, text("c", "x"), "en", "a"), (3, text("c", "y"), "en", "a"), (4, text("c", "z"), "en", "a"),
        (5, text("d"), "en", "a"), (5, text("d"), "en", "a"), (6, text("d", "x"), "en", "a"),
        (5, text("e"), "en", "a"), (None, text("f"), "en", "a"), (None, text("f"), "en", "b"),
        (1, None, "en", "a"), (1, "", "en", "a"), (None, None, "en", "a"), (None, None, "en", "a"),
    ]
    docs = written(documents(spark, rows))
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    found = [(x.doc_id, (x.text or "")[:1]) for x in kept.collect()]
    want = [(None, "a"), (7, "b"), (3, "c"), (5, "d"), (5, "e"), (None, "f"), (1, ""), (1, ""), (None, ""), (None, "")]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_a_stage_without_tokens_drops_the_tables_of_the_stage_before():
    path = pretokens.public(packing.TOKENIZER)
    encoder = batch_encoder.batch_encoder(path)
    batch = pa.RecordBatch.from_arrays([pa.array(["a b"])], ["text"])
    assert list(lean(lambda batches: batches)(iter([batch]))) == [batch]
    assert batch_encoder.batch_encoder(path) is encoder
    assert list(lean(lambda batches: batches, alone=True)(iter([batch]))) == [batch]
    assert not batch_encoder._ENCODERS and not pretokens._ENCODERS


def test_texts_become_python_ones_part_by_part():
    texts = ["ab", None, "\u00e9" * 2, "", "x" * 9, "y"]
    parts = list(character_chunks(pa.array(texts), 4))
    assert parts == [(0, texts[:4]), (4, texts[4:5]), (5, texts[5:])]
    assert not list(character_chunks(pa.array([], pa.string()), 4))
    batch = pa.RecordBatch.from_arrays([pa.array(range(2 * packing.ROWS_AT_ONCE + 1))], ["row"])
    slices = list(packing._slices(batch))
    assert max(x.num_rows for x in slices) == packing.ROWS_AT_ONCE
    assert [x for part in slices for x in part.column(0).to_pylist()] == batch.column(0).to_pylist()
