import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import documents, frame
from tokenizers import Tokenizer

from pitstop.llm import wavelet

PATH = public_tokenizers.path("byte_bpe_50k.json")


def matrix(ids, monkeypatch=None):
    return wavelet.WaveletMatrix(wavelet.pack_matrix(np.array(ids, np.uint32), [1], [len(ids)]))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000) | st.integers(0, 3), max_size=300), st.randoms())
def test_access_rank_and_select_equal_a_list(ids, rng):
    m = matrix(ids)
    assert m.ids().tolist() == ids
    at = [rng.randrange(len(ids)) for _ in range(20)] if ids else []
    assert m.access(at).tolist() == [ids[i] for i in at]
    for token in [*ids[:5], 0, 2, 123_456, -1]:
        low, high = sorted((rng.randint(0, len(ids)), rng.randint(0, len(ids))))
        assert m.count(token) == ids.count(token) and m.count(token, low, high) == ids[low:high].count(token)
        assert m.occurrences(token, low, high).tolist() == [i for i in range(low, high) if ids[i] == token]


def test_across_blocks(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 64)
    monkeypatch.setattr(wavelet, "OPEN_BLOCKS", 3)
    for n in (63, 64, 65, 1000):
        ids = [random.Random(n).choice([0, 1, 5, 50_256, 70_001]) for _ in range(n)]
        m = matrix(ids)
        assert m.ids().tolist() == ids and m.access(range(n)).tolist() == ids
        for token in set(ids):
            assert m.occurrences(token).tolist() == [i for i, x in enumerate(ids) if x == token]
            assert m.count(token, 10, n - 10) == ids[10:n - 10].count(token)
    with pytest.raises(IndexError):
        m.access([n])


def test_damage_is_noticed():
    content = wavelet.pack_matrix(np.arange(1000, dtype=np.uint32), [1], [1000])
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix(b"x" + content[1:])
    with pytest.raises(ValueError):
        wavelet.WaveletMatrix(content[:-3])


def brute(rows, end=2):
    plain = Tokenizer.from_file(PATH)
    return [(i, plain.encode(t or "", add_special_tokens=False).ids + [end]) for i, t, *_ in rows]


@pytest.mark.parametrize("shard_ids", [wavelet.SHARD_IDS, 300])
def test_documents_come_back_from_the_files(spark, shard_ids):
    rows = documents()
    df = frame(spark, rows)
    got = wavelet.encode_and_read(df, PATH, shard_ids=shard_ids).collect()
    want = brute(rows)
    digest = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x), digest(x)) for i, x in want)
    at, last = 0, None
    for r in sorted(got, key=lambda r: r.start):           # gapless, in ascending id order, null last
        assert r.start == at
        key = (r.doc_id is None, r.doc_id or 0)
        assert last is None or key >= last
        at, last = at + r.n_tokens, key
    once = [r for r in rows if r[0] not in (None, 46)]
    starts = {r.doc_id: r.start for r in wavelet.encode_and_read(frame(spark, once, clash=False), PATH).collect()}
    at = 0
    for i, x in sorted(brute(once)):
        assert starts[i] == at
        at += len(x)


def test_lookup_in_the_files(spark, tmp_path):
    rows = [r for r in documents() if r[0] not in (None, 46)]
    folder, want = str(tmp_path / "wave"), brute(rows)
    manifest = wavelet.write_shards(frame(spark, rows), folder, PATH, shard_ids=2000)
    assert manifest.agg({"docs": "sum", "ids": "sum"}).first()[0:2] == (len(rows), sum(len(x) for _, x in want))
    assert manifest.count() > 3
    tokens = [2, want[0][1][0], want[3][1][5], 50_255]
    found = {(r.token, r.doc_id, r.position) for r in wavelet.find_tokens(spark, folder, tokens).collect()}
    assert found == {(t, i, k) for i, x in want for k, t in enumerate(x) if t in tokens}
    counts = {r.token: r.n for r in wavelet.count_tokens(spark, folder, tokens).collect()}
    assert counts == {t: sum(x.count(t) for _, x in want) for t in tokens}
    ids = {r.doc_id: r.ids for r in wavelet.read_shards(spark, folder, with_ids=True).collect()}
    assert ids == dict(want)


def test_no_documents(spark):
    assert wavelet.encode_and_read(frame(spark, []), PATH).collect() == []
    assert [(r.start, r.n_tokens) for r in wavelet.encode_and_read(frame(spark, [(7, None, None, None, None)]), PATH).collect()] == [(0, 1)]
