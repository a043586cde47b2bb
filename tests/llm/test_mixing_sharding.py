from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from tables import documents, frame, words

from pitstop.llm import mixing, sharding


def targets(sizes, weights=(3, 1, 2), share=1.5):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, out = set(), {}
    while True:
        left = share * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        out = {s: 2 * sizes[s] for s in capped} | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if out[s] > 2 * sizes[s]}
        if not over:
            return out
        capped |= over


def test_mix(spark):
    rows = documents()
    got = mixing.mix(frame(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in got) == sorted(
        (i is None, i or 0, len(words(t))) for i, t, *_ in rows)
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    want, taken = targets(sizes), Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert taken[s] == int(t + 1e-6)
    again = mixing.mix(frame(spark, rows, clash=False)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_rows_take_what_the_mix_says(spark):
    rows = [r for r in documents() if r[0] is not None and r[0] != 46]
    df = frame(spark, rows)
    plan = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    out = mixing.mixed_rows(df)
    assert out.schema == df.schema
    taken, texts = Counter(), {r[0]: r[1] for r in rows}
    for r in out.collect():
        taken[r.doc_id] += len(words(r.text))
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert {k: v for k, v in plan.items() if v} == dict(taken)


@pytest.mark.parametrize("repeats", [40, 9000])
def test_repeated_rows_do_not_overshoot(spark, repeats):
    """Sources that are one row, many times; the cut goes through the group."""
    text = " ".join(f"w{k}" for k in range(100))
    rows = [(k, text if s != "b" else text + " x", "xx", s, 1) for s, k in (("a", 1), ("b", None), (None, 3)) for _ in range(repeats)]
    df = frame(spark, rows)
    sizes = {"a": 100 * repeats, "b": 101 * repeats, None: 100 * repeats}
    taken = {r.source: r.taken for r in mixing.mix(df).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    out = {r.source: r.n for r in mixing.mixed_rows(df).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()}
    assert out == taken == {s: int(t + 1e-6) for s, t in targets(sizes).items()}
    assert mixing.mix(df).count() == 3 * repeats


def test_rows_with_one_id_and_size_but_other_texts(spark):
    rows = [(1, f"t{k} a b c", "xx", "a", 1) for k in range(7)] + [(2, "x y", "xx", "b", 3)] * 3
    df = frame(spark, rows)
    plan, out = mixing.mix(df).collect(), mixing.mixed_rows(df).collect()
    assert sum(len(words(r.text)) for r in out) == sum(r.taken for r in plan)
    most = Counter(r.text for r in out)
    assert all(n <= 2 for t, n in most.items() if t.startswith("t")) and len({r.text for r in out if len(words(r.text)) == 4}) == 7


def test_mix_of_nothing(spark):
    empty = frame(spark, [])
    assert mixing.mix(empty).collect() == [] and mixing.mixed_rows(empty).collect() == []
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None, None, None, None)])).collect()] == [0]


@pytest.mark.parametrize("bucket_bytes", [sharding.BUCKET_BYTES, 500])
def test_shards(spark, bucket_bytes):
    rows = documents() + [(7, "copy", "xx", "a", 4)] * 40
    got = sharding.shard(frame(spark, rows), bucket_bytes=bucket_bytes).collect()
    counts = Counter(r.shard for r in got)
    assert len(got) == len(rows) and max(counts.values()) - min(counts[s] for s in range(8)) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, len((t or "").encode()) + 1) for i, t, *_ in rows)
    assert sorted(map(str, got)) == sorted(map(str, sharding.shard(frame(spark, rows), bucket_bytes=bucket_bytes).collect()))
    order = [r.doc_id for r in sorted(got, key=lambda r: (r.shard, r.slot)) if r.doc_id is not None]
    assert order != sorted(order)
    assert sharding.shard(frame(spark, [])).collect() == []


def test_written_shards_keep_rows(spark, tmp_path):
    df = frame(spark, documents())
    sharding.write_shards(df, str(tmp_path / "s"), shards=3)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(str, back.select("row.*").collect())) == sorted(map(str, df.collect()))
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2}


def test_digest_comes_from_written_rows(spark, monkeypatch):
    df, written = frame(spark, documents()), []
    write = sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda docs, path, *a, **k: (written.append(path), write(docs, path, *a, **k)))
    got = sharding.write_and_read(df)
    digest = lambda rows: sorted(map(str, ((r.doc_id, r.size, r.text_crc32, r.law) for r in rows)))
    plain = sharding.shard(df)
    assert got.dtypes == plain.dtypes and digest(got.collect()) == digest(plain.collect())
    back = spark.read.parquet(written[0])
    text = lambda rows: sorted(map(str, rows))
    assert text(r.row for r in back.select("row").collect()) == text(df.collect())
    for _, slots in got.groupBy("shard").agg(F.collect_list("slot")).collect():
        assert sorted(slots) == list(range(len(slots)))
