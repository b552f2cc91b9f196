import random
import zlib
from collections import Counter
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import batch_encoder, context_coder, pretokens
from strata.llm import token_counts as token_counts_module
from strata.llm.batch_encoder import BatchEncoder
from strata.llm.hash_index import HashIndex
from strata.llm.packing import packed
from strata.llm.token_counts import token_counts
from strata.llm.token_files import read_token_files, write_token_files
from tests.llm.cases import AWKWARD, LONG, documents

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]


def encode(name, text):
    return pretokens.encoder(pretokens.public(name)).tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(
    st.sampled_from(list(" \n\t'sStTrRdDabcéÉßñ019.,!-<|>İΣ  \x1c")), st.characters(exclude_categories=["Cs"]),
)))
def test_pieces_give_the_ids_of_the_library(name, text):
    single = pretokens.CachedIds(pretokens.encoder(pretokens.public(name)), 50)
    texts = [text, f"{text}<|endoftext|>{text}"]
    for whole in texts:
        assert np.frombuffer(single.encode(whole), "<u4").tolist() == encode(name, whole)
    assert [x.tolist() for x in batched(name).encode(texts)] == [encode(name, x) for x in texts]


@cache
def batched(name):
    return BatchEncoder(pretokens.public(name), table_bits=4)


@pytest.mark.parametrize("name", FILES)
def test_batches_of_plain_texts(name, monkeypatch):
    monkeypatch.setattr(batch_encoder, "CHUNK_BYTES", 200)
    rng = random.Random(2)
    signs = "abcsStTrReEvVlLmMdD'''   \n\n\t09.,!éÉßÿÀ"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(5000)] + [LONG]
    assert [x.tolist() for x in batched(name).encode(texts)] == [encode(name, x) for x in texts]


def test_token_counts(spark):
    want = Counter(
        (i, len((t or "").encode()), len(encode(FILES[0], t)), len(encode(FILES[0], t)) > 1024)
        for i, t, *_ in AWKWARD
    )
    for table_size, cache_size in ((100, 10), (1, 1)):
        found = token_counts(documents(spark), table_size=table_size, cache_size=cache_size)
        assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
        assert Counter(map(tuple, found.collect())) == want
    assert token_counts(documents(spark, [])).count() == 0


def test_frequencies_are_those_of_all_rows(spark):
    texts = [" ".join(f"w{i % k}" for i in range(300)) + " é日 <|endoftext|>x" for k in range(1, 30)]
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).repartition(13)
    path = pretokens.public(FILES[0])
    want = Counter()
    for text in texts:
        encoder = pretokens.encoder(path)
        want.update(x.encode() for part in encoder.parts(text) for x in encoder.pieces(part))
    most = sorted(want.items(), key=lambda x: (-x[1], x[0]))
    for fan in (2, 64):
        found = token_counts_module.frequent_pretokens(docs, path, text_column="text", table_size=12, fan=fan)
        assert found == [x for x, _ in most[:12]]
    # A table that is full drops the rarest.
    few = token_counts_module.frequent_pretokens(docs.coalesce(1), path, text_column="text", table_size=1, held=4, summary=3)
    assert few == [most[0][0]]


def test_pretokens_are_never_shuffled(spark, monkeypatch):
    plans = []
    keep = token_counts_module.written

    def seen(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return keep(rows)

    monkeypatch.setattr(token_counts_module, "written", seen)
    found = token_counts(documents(spark))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and not any("Exchange" in x for x in plans)


def test_a_full_table_of_frequencies_keeps_the_frequent():
    seen = token_counts_module.Frequencies(8)
    for i in range(500):
        data = f"often{i:04d}often".encode()
        seen.add(np.frombuffer(data, np.uint8), np.array([0, 5, 9]), np.array([5, 9, 14]))
    assert seen.top(1) == {b"often": 1000} and len(seen.pieces) <= seen.index.room


@pytest.mark.parametrize("window", [7, 4096])
def test_packing(spark, window):
    pieces = packed(documents(spark), window=window).toPandas()
    want = Counter((i if i is not None else -1, tuple(encode(FILES[1], t)) + (2,)) for i, t, *_ in AWKWARD)
    pieces = pieces.sort_values(["sequence_id", "offset"])
    by_sequence = pieces.groupby("sequence_id")
    assert (pieces["offset"] == by_sequence["length"].cumsum() - pieces["length"]).all()
    assert (by_sequence["length"].sum().iloc[:-1] == window).all()
    # The stream, cut at the documents' starts, gives the documents back.
    found, ids = Counter(), []
    for x in pieces.itertuples():
        ids += np.frombuffer(x.ids, "<u4").tolist()
        assert len(x.ids) == 4 * x.length
        if x.start + x.length == x.doc_tokens:
            found[(-1 if np.isnan(x.doc_id) else int(x.doc_id), tuple(ids))] += 1
            ids = []
        else:
            assert x.offset + x.length == window
    assert found == want and not ids
    assert packed(documents(spark, [])).count() == 0


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 20])
def test_token_files_round_trip(spark, tmp_path, block_ids):
    path = str(tmp_path / "files")
    write_token_files(documents(spark), path, block_ids=block_ids)
    found = sorted(read_token_files(spark, path).collect(), key=lambda x: x.start)
    assert [x.start for x in found] == np.cumsum([0] + [x.n_tokens for x in found[:-1]]).tolist()
    keys = [-1 if x.doc_id is None else x.doc_id for x in found]
    assert keys == sorted(keys)
    got = Counter((x.doc_id, np.frombuffer(x.ids, "<u4").astype(int).tobytes()) for x in found)
    assert got == Counter(
        (i, np.array(encode(FILES[0], t) + [2]).tobytes()) for i, t, *_ in AWKWARD
    )


def test_empty_token_file(spark, tmp_path):
    write_token_files(documents(spark, []), str(tmp_path / "none"))
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_coder_round_trip_and_size():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 255, 256, 5000, 70_000):
        for ids in (rng.integers(0, 50_257, n), rng.zipf(1.3, n) % 50_257, np.full(n, 50_256)):
            assert (context_coder.decode(context_coder.encode(ids, 50_257)) == ids).all()
    repeated = np.tile(rng.integers(0, 50_257, 300), 200)
    assert len(context_coder.encode(repeated, 50_257)) < len(repeated) / 4


def test_blocks_are_independent_and_checked():
    block = context_coder.pack_block([(None, np.arange(5)), (7, np.arange(0)), (8, np.arange(900))], 50_257)
    (a, x), (b, y), (c, z) = context_coder.unpack_block(block)
    assert (a, b, c) == (None, 7, 8) and (len(x), len(y), z[-1]) == (5, 0, 899)
    for at in (0, 20, len(block) // 2, len(block) - 1):
        damaged = bytearray(block)
        damaged[at] ^= 1
        with pytest.raises(ValueError):
            context_coder.unpack_block(bytes(damaged))
    assert zlib.crc32(block[:-4]) == int.from_bytes(block[-4:], "little")


def test_weights_learn_from_every_step():
    mixer = context_coder._Mixer(50, 5)
    before = mixer.hits.sum()
    for step in range(6):
        mixer.predict()
        mixer.learn(np.arange(5) + step)
        assert mixer.hits.sum() - before == 5 * (step + 1)


def test_coded_bytes_stay_the_same():
    # Files written by earlier versions stay readable: rows, digest and size as those gave them.
    ids = (np.arange(300_000, dtype=np.uint64) ** 2 % 50_021 % 3_001).astype(np.uint32)
    coded = context_coder.encode(ids, 50_000)
    assert (zlib.crc32(coded), len(coded)) == (3447325839, 164048)


def test_writing_looks_up_each_id_once_and_builds_nothing_for_reading():
    looked_up = []

    class Spans(np.ndarray):
        def take(self, at, **more):
            looked_up.append(np.size(at))
            return np.asarray(self).take(at, **more)

    mixer = context_coder._Mixer(50, 5)
    ids = np.arange(5)
    mixer.predict()
    assert not hasattr(mixer, "slots")
    mixer.spans = mixer.spans.view(Spans)
    start, size = mixer.interval(ids)
    assert looked_up == [5]
    mixer.learn(ids)
    assert looked_up == [5] and (size > 0).all()
    reader = context_coder._Mixer(50, 5, reading=True)
    reader.predict()
    assert (reader.find(start) == ids).all() and (reader.find(start + size - np.uint64(1)) == ids).all()


def test_ids_are_counted_and_searched_at_a_refresh_only():
    mixer = context_coder._Mixer(50, 5)
    known = []
    for step in range(25):
        mixer.predict()
        known.append(mixer.known)
        mixer.learn(np.arange(5) + 40 * (step >= 16))
        assert mixer.seen.sum() == 5 * (step // 8 * 8 if step >= 8 else (0, 1, 2, 2, 4, 4, 4, 4)[step])
    assert known[1].tolist() == [0, 1, 2, 3, 4] and known[16] is known[1]
    assert known[24].tolist() == [0, 1, 2, 3, 4, 40, 41, 42, 43, 44]


def test_larger_blocks_learn_in_more_steps():
    sizes = [*range(0, 1 << 21, 999), 1 << 21, 2_700_000, 3_000_000, 1 << 22, 1 << 24]
    lanes = [context_coder._lanes(n) for n in sizes]
    # Up to 2**21 ids as earlier versions, with 512 steps in the largest; then never fewer.
    assert lanes[:-4] == [max(1, min(4096, n // 256)) for n in sizes[:-4]]
    assert all(n // x >= 640 for n, x in zip(sizes[-4:], lanes[-4:]))
    assert lanes[-2:] == [6144, 6144]


def test_coder_refuses_ids_beyond_the_vocabulary():
    with pytest.raises(IndexError):
        context_coder.encode(np.array([1, 50, 2]), 50)


def test_reading_long_blocks_of_vocabularies_of_any_size():
    rng = np.random.default_rng(3)
    for vocabulary in (1, 2, 1 << 16, (1 << 16) + 1, 70_000):
        ids = np.append(rng.zipf(1.2, 20_000) % vocabulary, np.full(700, vocabulary - 1))
        assert (context_coder.decode(context_coder.encode(ids, vocabulary)) == ids).all()


@pytest.mark.parametrize("name", FILES)
def test_pieces_of_a_chunk_are_those_of_the_pattern(name, monkeypatch):
    # Classes come from a table of bytes at once, not by one look-up for each run of signs.
    monkeypatch.setattr(batch_encoder, "_CLASS", None)
    rng, encoder = random.Random(4), batched(name)
    for _ in range(500):
        texts = ["".join(rng.choice("abSsTtvVrReElLmd''  \n\t09.,éÉ") for _ in range(rng.randrange(12))) for _ in range(4)]
        data, cuts, starts, ends = encoder.spans([(i, x.encode()) for i, x in enumerate(texts)])
        found = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
        assert found == [x for text in texts for x in encoder.encoder.pieces(text)]


def test_look_ups_of_keys_that_share_slots():
    index = HashIndex(4)
    keys, checks = np.array([3, 19, 35, 4, 15, 31], np.uint64), np.arange(6)
    index.add(keys, checks)
    assert (index.find(keys, checks) == np.arange(6)).all()
    assert (index.find(keys[::-1], checks[::-1]) == np.arange(6)[::-1]).all()
    assert (index.find(keys, checks + 1) == -1).all() and (index.find(keys + np.uint64(64), checks) == -1).all()
    assert not len(index.find(keys[:0], checks[:0]))
