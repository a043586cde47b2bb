import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tables import documents, frame
from tokenizers import Tokenizer

from pitstop.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in bins if r >= n]
        if fit:
            bins.remove(min(fit))
            bins.append(min(fit) - n)
        else:
            bins.append(capacity - n)
    return sorted(bins)


def test_runs_equal_best_fit_decreasing():
    rng = random.Random(4)
    for capacity in (10, 16, 37):
        for _ in range(60):
            lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 70))]
            runs, n = packing.plan_runs(Counter(lengths), capacity)
            end = Counter()
            for length, a, b, first, per, offset in runs:
                for k in range(a, b + 1):
                    bin_ = first + (k - a) // per
                    assert end[bin_] == offset + (k - a) % per * length
                    end[bin_] += length
            assert len(end) == n and sorted(capacity - x for x in end.values()) == best_fit(lengths, capacity)


def test_packed_documents(spark):
    rows = documents()
    got = packing.pack_documents(frame(spark, rows), PATH, with_ids=True).collect()
    plain = Tokenizer.from_file(PATH)
    want = Counter((i, tuple(plain.encode(t or "", add_special_tokens=False).ids) + (2,)) for i, t, *_ in rows)
    found, by_doc, places = Counter(), {}, {}
    for r in got:
        assert len(r.ids) == r.length <= 1024
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for place in places.values():
        at = 0
        for offset, length in sorted(place):
            assert offset == at
            at += length
        assert at <= 1024
    for doc, parts in by_doc.items():
        if doc in (None, 46):
            continue                      # several documents of one id
        parts.sort(key=lambda r: r.piece)
        ids = tuple(x for r in parts for x in r.ids)
        found[(doc, ids)] += 1
        assert [r.start for r in parts] == list(np.cumsum([0, *[r.length for r in parts[:-1]]]))
        assert [r.piece for r in parts] == list(range(len(parts))) and all(r.length == 1024 for r in parts[1:])
    assert found == Counter({k: v for k, v in want.items() if k[0] not in (None, 46)})
    assert sum(r.length for r in got) == sum(len(k[1]) * v for k, v in want.items())
    assert len(places) == len(best_fit([r.length for r in got], 1024))
    assert packing.pack_documents(frame(spark, []), PATH).collect() == []


def test_chunks_give_the_tokenizers_ids():
    import pyarrow as pa

    from pitstop.llm.text import slices
    rng, plain = random.Random(9), Tokenizer.from_file(PATH)
    texts = ["", " ", "a  b\n\n c", "x<|endoftext|> y<|endoftext|>", "it's, isn't it?! #a <b"]
    for signs in (" \n\t\x1c　 \xa0\x85abe1'!s<|>.", " \nabcE1'!,.;é日"):
        texts += ["".join(rng.choice(signs) for _ in range(40)) for _ in range(300)]
    encoder, got = packing.encoder(PATH), []
    for s in slices(pa.array(texts), 2000):
        ids, bounds = encoder.slice_ids(s)
        got += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_places_need_no_python_worker(spark):
    rows = [(1, "one two"), (2, "three"), (None, None)]
    parts = packing.stage(packing.pieces(spark.createDataFrame(rows, "doc_id long, text string"), PATH), "test-pieces")
    placed = packing.pack(parts)
    plan = placed._jdf.queryExecution().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan and "InArrow" not in plan
    assert placed.count() == 3
