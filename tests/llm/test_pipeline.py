"""The whole pipeline, from documents to pieces, against plain Python."""

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tables import CLASH, DOCS, shingles, words
from test_mixing_sharding import targets
from test_packing import best_fit
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from pitstop.llm import langid  # noqa: E402

LETTERS = {"xx": "abcdefgh", "yy": "klmnopqr"}


def corpus():
    """Two languages that are told apart surely; copies, near copies, a shared
    passage, repeated rows, and texts that no language can be told of."""
    rng, rows = random.Random(12), []

    def sentence(lang, n):
        return " ".join("".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(3, 8))) for _ in range(n)) + "."

    def prose(lang, n):
        return "\n".join(sentence(lang, 12) for _ in range(n))

    def add(i, text, lang, source):
        rows.append((i, text, lang, source, None if text is None else len(text)))

    for i in range(160):
        add(i, prose(lang := rng.choice(["xx", "yy"]), rng.randint(6, 30)), lang, rng.choice(["a", "b", "b", None]))
    base = prose("xx", 12)
    add(160, base, "xx", "a")
    add(161, base, "xx", "b")
    add(162, base.replace(base.split()[40], "aaaa", 1), "xx", "a")
    passage = sentence("yy", 60)
    for i in (163, 164, 165):
        add(i, prose("yy", 9) + "\n" + passage + "\n" + prose("yy", 9), "yy", "b")
    once = prose("xx", 20)
    for _ in range(5):
        add(166, once, "xx", "a")                       # a row that comes again
    add(167, None, None, "a")
    add(168, "", None, "a")
    add(169, "12345 678", None, "b")
    add(170, prose("xx", 400), "xx", None)              # very long
    add(None, prose("yy", 10), "yy", "a")
    return rows, passage


def expected(rows, accepted, passage):
    """(id, text) rows of the mixture: near copies and the later passages gone, then taken by weight."""
    kept = []
    for i, text, _, source, _ in sorted((r for r in rows if (r[0], r[1]) in accepted), key=lambda r: (r[0] is None, r[0] or 0)):
        mine = shingles(text)
        if any(100 * len(mine & s) >= 80 * len(mine | s) for _, _, _, s in kept):
            continue
        kept.append((i, text, source, mine))
    holders = [k for k in kept if passage in k[1]]
    texts = [(i, t if (i, t) == holders[0][:2] else t.replace(passage + "\n", ""), s) for i, t, s, _ in kept]
    sizes = defaultdict(int)
    for _, t, s in texts:
        sizes[s] += len(words(t))
    out = []
    for s, target in targets(sizes).items():
        budget = int(target + 1e-6)
        epochs, rest = divmod(budget, sizes[s])
        order = sorted((t for t in texts if t[2] == s), key=lambda t: hashlib.md5(f"17:{'null' if t[0] is None else t[0]}".encode()).hexdigest())
        for i, t, _ in order:
            n = len(words(t))
            out += [(i, t)] * epochs
            if rest >= n:
                out.append((i, t))
            elif rest > 0:
                out.append((i, " ".join(words(t)[:rest])))
            rest = max(0, rest - n)
    return out


@pytest.fixture(scope="module")
def written(tmp_path_factory):
    return tmp_path_factory.mktemp("corpus")


def test_documents_to_pieces(spark, written):
    rows, passage = corpus()
    docs = spark.createDataFrame(rows, DOCS)
    for c in CLASH.split(", "):
        name, kind = c.split(" ")
        docs = docs.selectExpr("*", f"cast(null as {kind}) as `{name}`")
    docs.repartition(3).write.parquet(str(written / "documents.parquet"))
    # What the model takes in is a matter of its own; the other stages are held against it.
    accepted = {(r.doc_id, r.text) for r in langid.accepted_rows(spark.read.parquet(str(written / "documents.parquet"))).collect()}
    unknown = {(i, t) for i, t, *_ in rows} - accepted
    assert unknown >= {(167, None), (168, ""), (169, "12345 678")} and len(unknown) < 6
    got = corpus_pipeline.run(spark, str(written)).collect()
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in expected(rows, accepted, passage):
        want[i, " ".join(words(text))] += 1
    # pieces of one row put together again
    rows_of = defaultdict(list)
    for r in got:
        assert 4 * r.length == len(r.ids_bytes) <= 4096
        rows_of[r.doc_row].append(r)
    assert len(rows_of) == sum(want.values())
    texts, lengths = Counter(), []
    for parts in rows_of.values():
        parts.sort(key=lambda r: r.piece)
        ids = [x for r in parts for x in np.frombuffer(r.ids_bytes, "<u4").tolist()]
        assert [r.piece for r in parts] == list(range(len(parts))) and [r.start for r in parts] == list(np.cumsum([0] + [r.length for r in parts[:-1]]))
        assert ids[-1] == 2 and all(r.length == 1024 for r in parts[1:])
        text = plain.decode(ids[:-1])
        assert plain.encode(text, add_special_tokens=False).ids == ids[:-1]
        texts[parts[0].doc_id, " ".join(words(text))] += 1
        lengths += [r.length for r in parts]
    assert texts == want
    # sequences without gaps, as few as best fit makes
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(sequences) == len(best_fit(lengths, 1024))


def test_stages_keep_the_columns_of_documents(spark, written):
    docs = spark.read.parquet(str(written / "documents.parquet"))
    nothing = docs.limit(0)
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, nothing, str(written))
        assert out.schema == docs.schema and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, str(written)).count() == 0


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_workers_of_the_stages_give_memory_back(spark, written):
    nothing = spark.read.parquet(str(written / "documents.parquet")).limit(0)
    corpus_pipeline.STAGES[-1][1](spark, nothing, str(written))       # what a stage asks for its workers holds from here on

    def work(batches):
        """What stays of 64 MB that are freed, while small arrays behind them are kept."""
        import pyarrow as pa

        def anonymous():
            with open("/proc/self/status") as f:
                return next(int(x.split()[1]) for x in f if x.startswith("RssAnon")) // 1024

        for _ in batches:
            np.ones(30 << 17)                               # 30 MB, freed at once
            before = anonymous()
            arrays = [np.ones(3 << 16) for _ in range(43)]  # 1.5 MB each
            stays = [np.ones(1000) for _ in range(200)]
            del arrays
            yield pa.RecordBatch.from_arrays([pa.array([anonymous() - before])], ["mb"])
            del stays

    assert spark.range(1).coalesce(1).mapInArrow(work, "mb long").first().mb < 16
