import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tables import documents, frame, shingles, words

from pitstop.llm import ngram_join, sentence_spans
from pitstop.llm.components import connected

SPACE = " \t\n\x0b\x0c\r"


def components(rows, groups_alone=False):
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and sets[j] and 100 * common >= 80 * len(a | sets[j]):
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    if groups_alone:
        return len({find(i) for i, s in enumerate(sets) if s})
    links = [sum(1 for j, b in enumerate(sets) if i != j and s and b and 100 * len(s & b) >= 80 * len(s | b)) for i, s in enumerate(sets)]
    return [(n, *x) for n, x in zip(links, [(len(s), min((x for x in groups[find(i)] if x is not None), default=None) if s else rows[i][0]) for i, s in enumerate(sets)])]


def family(rng, n, words_, edits):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words_)]
    for _ in range(n):
        text = list(base)
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(10**6)}"
        yield " ".join(text)


def check(spark, rows):
    got = ngram_join.join(frame(spark, rows)).members.collect()
    want = components(rows)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.n_links, r.n_shingles, r.component_id) for r in got), key=key) == sorted(
        ((i, *w) for (i, *_), w in zip(rows, want)), key=key)


def test_join_equals_all_pairs(spark):
    check(spark, documents())


@pytest.mark.parametrize("block,merged", [(2000, 10**9), (600, 0)])
def test_join_of_families_at_the_threshold(spark, monkeypatch, block, merged):
    for name, value in (("BLOCK_SHINGLES", block), ("FLUSH", 3000), ("SUBLIST", 5), ("SEEN", 10), ("MERGED", merged)):
        monkeypatch.setattr(ngram_join, name, value)         # many blocks, dealt lists, repeated emits
    rng, rows = random.Random(2), []
    for n, length, edits in ((60, 60, 4), (40, 150, 8), (3, 12, 1), (2, 400, 9), (5, 4, 1)):
        for text in family(rng, n, length, edits):
            rows.append((len(rows), text, "xx", "a", len(text)))
    check(spark, rows)


def test_every_link_of_a_family_counts(spark):
    rows = [(i, t, "xx", "a", 1) for i, t in enumerate(family(random.Random(6), 30, 200, 2))]
    got = {r.doc_id: r.n_links for r in ngram_join.join(frame(spark, rows)).members.collect()}
    assert sum(got.values()) == 2 * 435


def test_nothing_to_join(spark):
    assert ngram_join.join(frame(spark, [])).members.collect() == []
    assert ngram_join.first_of_each(frame(spark, [])).collect() == []
    check(spark, [(1, None, None, None, None), (2, "", None, None, 0)])


def test_first_of_each(spark):
    rows = documents()
    df = frame(spark, rows)
    out = ngram_join.first_of_each(df)
    assert out.schema == df.schema
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len([g for g in got if not words(g[1])]) == len([r for r in rows if not words(r[1])])
    with_set = [g for g in got if words(g[1])]
    assert len(with_set) == components(rows, groups_alone=True)     # texts of one id that are not alike are two groups
    assert sum(g[0] == 46 for g in with_set) == 2
    assert len(set(with_set)) == len(with_set) and (31, rows[31][1]) not in got


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(5)
    for _ in range(30):
        base = rng.integers(0, 2**63, 60, dtype=np.uint64)
        sets = []
        for _ in range(40):
            s = base.copy()
            at = rng.choice(60, rng.integers(0, 20), replace=False)
            s[at] = rng.integers(0, 2**63, len(at), dtype=np.uint64)
            sets.append(np.unique(s[:rng.integers(40, 61)]))
        lists, query = ngram_join.InvertedLists(sets), sets[0]
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(query, s)) >= 80 * len(np.union1d(query, s))]
        assert sorted(lists.search(query, np.ones(40, bool))) == want


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    least = {x: x for pair in links for x in pair}
    for _ in range(100):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == {k: v for k, v in least.items() if k in got} and {k for a, b in links if a != b for k in (a, b)} == set(got)


def sentences(text):
    parts, start = [], 0
    for i, c in enumerate(text):
        if c == "\n" or c in "。！？" or c in ".!?" and text[i + 1:i + 2] and text[i + 1] in SPACE:
            parts.append(text[start:i + 1])
            start = i + 1
    parts.append(text[start:])
    out, lead = [], ""
    for p in parts:
        body = p.lstrip(SPACE)
        if not words(p):
            if out:
                out[-1] += p
            else:
                lead += p
            continue
        if out:
            out[-1] += p[:len(p) - len(body)]
            out.append(body)
        else:
            out.append(lead + p)
    return out


def without_repeats(rows):
    """What stays of each text, by brute force; ids must be unique."""
    first, gone, split = {}, {i: set() for i, *_ in rows}, {}
    for i, text, *_ in sorted(rows, key=lambda r: r[0]):
        s = split[i] = sentences(text or "")
        n, runs = [len(words(x)) for x in s], set()
        for a in range(len(s)):
            for step in (1, -1):
                b, total = a, n[a]
                while total < sentence_spans.MIN_WORDS and 0 <= b + step < len(s):
                    b += step
                    total += n[b]
                if total >= sentence_spans.MIN_WORDS:
                    runs.add((min(a, b), max(a, b) + 1))
        for a, b in sorted(runs):
            span = tuple(w for x in s[a:b] for w in words(x))
            if span in first:
                gone[i] |= set(range(a, b))
            else:
                first[span] = i
    return {i: text if not gone[i] else "".join(x for k, x in enumerate(split[i]) if k not in gone[i]).rstrip(SPACE)
            for i, text, *_ in rows}


def test_repeats_equal_brute_force(spark, monkeypatch):
    rows = [r for r in documents() if r[0] not in (None, 46)]
    rows.append((60, rows[0][1] + "\n" + rows[20][1] + " " + rows[20][1], "xx", "a", 9))
    want = without_repeats(rows)
    assert sum(want[i] != t for i, t, *_ in rows) > 5
    for flush in (sentence_spans.FLUSH, 20):
        monkeypatch.setattr(sentence_spans, "FLUSH", flush)
        got = sentence_spans.remove_repeats(frame(spark, rows)).select("row.doc_id", "text", "n_removed").collect()
        assert {r.doc_id: r.text for r in got} == want
        assert all((r.n_removed > 0) == (dict((i, t) for i, t, *_ in rows)[r.doc_id] != r.text) for r in got)


def test_without_repeats_keeps_rows_and_columns(spark):
    df = frame(spark, documents())
    out = sentence_spans.without_repeats(df)
    assert out.schema == df.schema and out.filter(F.col("n_chars") != F.length("text")).count() == 0
    left = [(r.doc_id, r.text) for r in out.collect()]
    assert (39, None) in left and (40, "") in left and all(i != 31 for i, _ in left)     # 31 copies 30
    assert sentence_spans.without_repeats(frame(spark, [])).collect() == []


def test_a_passage_of_51_words_goes_whatever_its_sentences(spark):
    rng, rows = random.Random(3), []
    for k, cuts in enumerate(([], [50], [1], [10, 20, 30, 40], [25, 49], list(range(1, 51)))):
        passage = " ".join(f"p{k}w{j}" + ("." if j + 1 in cuts else "") for j in range(51)) + "."
        for _ in range(2):
            own = " ".join(f"o{rng.randrange(10**9)}" for _ in range(20)) + "."
            rows.append((len(rows), f"{own}\n{passage}\n{own[::-1]}", "xx", "a", 1))
    got = {r.doc_id: r.text for r in sentence_spans.remove_repeats(frame(spark, rows)).select("row.doc_id", "text").collect()}
    for i, text, *_ in rows:
        assert bool(re.search(r"p\d+w", got[i])) == (i % 2 == 0) and got[i].startswith(text.split("\n")[0])


def test_a_passage_of_51_words_between_words_of_other_sentences_goes(spark):
    rng, rows = random.Random(4), []

    def own(n):
        return " ".join(f"o{rng.randrange(10**9)}" for _ in range(n))

    for k, stops in enumerate(([], [3], [25], [48], [4, 50], [10, 20, 30, 40], [24, 26])):
        passage = " ".join(f"p{k}w{j}" + "." * (j in stops) for j in range(51))
        for n in (4, 7):
            rows.append((len(rows), f"{own(30)}. {own(n)} {passage} {own(n)}. {own(20)}.", "xx", "a", 1))
        rows.append((len(rows), f"{own(3)}. {own(60)} {passage} {own(70)} {passage} {own(3)}", "xx", "a", 1))     # one text, twice
    shorter = " ".join(f"q{j}" for j in range(49))
    rows += [(100 + i, f"{own(9)} {shorter} {own(9)}.", "xx", "a", 1) for i in range(3)]
    got = {r.doc_id: r for r in sentence_spans.remove_repeats(frame(spark, rows), within=True).select("row.doc_id", "text", "n_removed").collect()}
    for i, text, *_ in rows:
        if i >= 100 or i % 3 == 0:
            assert (got[i].text, got[i].n_removed) == (text, 0)
        else:
            assert words(got[i].text) == [w for w in words(text) if not w.startswith("p")] and got[i].n_removed > 0


def test_a_passage_twice_in_one_text_goes_once(spark):
    passage = " ".join(f"w{j}" for j in range(60))
    rows = [(1, f"a b c {passage} d {passage} e f", "xx", "a", 1), (2, "ha " * 120, "xx", "a", 1), (3, "ho " * 60, "xx", "a", 1)]
    got = {r.doc_id: r.text for r in sentence_spans.remove_repeats(frame(spark, rows), within=True).select("row.doc_id", "text").collect()}
    assert got == {1: f"a b c {passage} d e f", 2: ("ha " * 50).strip(), 3: rows[2][1]}
