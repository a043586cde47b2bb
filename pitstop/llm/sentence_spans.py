"""Substring dedup by sliding sentence spans.

Spans are the shortest runs of consecutive sentences that hold MIN_WORDS words
or more, one from each sentence on and one back from each, so that a repeated
passage of that length is covered by its spans to both ends.  Spans are hashed
by their words and joined over all documents; a sentence goes if it lies in
any occurrence of a span that is not the span's first.

A passage that begins or ends within a sentence may hold MIN_WORDS words with
fewer in whole sentences.  In what the spans leave, every window of MIN_WORDS
words is named by the smallest hash of its half as long runs, so that equal
windows have equal names; windows whose name comes again are hashed whole and
joined, and the words of all but the first go, wherever sentences end."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitstop.llm.scratch import stage
from pitstop.llm.text import Slice, _BASE, _INVERSE, _power, is_space, mix64, segment_hash, slices

MIN_WORDS = 50
FLUSH = 1 << 19               # spans a task gathers before it emits
BUCKET_BYTES = 32 << 20       # text whose spans make a bucket, about
FILTER_BITS = 1 << 25         # of the filter for repeated spans: 4 MB whatever the corpus
STRETCH = 4096                # words in which the ranges of a text begin that are merged at a time
LAST = 2**63 - 1              # place of a null id: behind all others
SPAN = [("h", "<u8"), ("lo", "<i8"), ("many", "?")]
PLACED = [("h", "<u8"), ("a", "<i4"), ("b", "<i4")]     # a hash, and the windows [a, b) of a text that have it


def sentence_starts(s: Slice) -> None:
    """Sets s.first_word (index of the first word of every sentence of the
    slice), s.sentences (the sentences of text i are [i], [i + 1]).  A
    sentence ends behind . ! ? before white space (or their full-width forms)
    and at a line's end; one without a word is part of that before it."""
    data, n = s.data, len(s.data)
    mark = (data == 46) | (data == 33) | (data == 63)
    stop = np.zeros(n, bool)
    if n:
        stop[:-1] = mark[:-1] & is_space(data[1:])
        stop |= data == 10
        wide = np.flatnonzero((data[:-2] == 0xE3) & (data[1:-1] == 0x80) & (data[2:] == 0x82)
                              | (data[:-2] == 0xEF) & (data[1:-1] == 0xBC) & ((data[2:] == 0x81) | (data[2:] == 0x9F)))
        stop[wide + 2] = True
    stops = np.flatnonzero(stop)
    begins = np.zeros(len(s.starts) + 1, bool)
    begins[np.searchsorted(s.starts, stops, side="right")] = True      # the first word behind a stop
    begins[s.bounds[:-1]] = True
    s.first_word = np.flatnonzero(begins[:len(s.starts)])
    s.sentences = np.searchsorted(s.first_word, s.bounds)


def spans(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text of the slice, first word, behind the last word) of each
    span of the slice's texts; words count from the start of the slice."""
    count = len(s.first_word)
    if not count:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    edges = np.append(s.first_word, len(s.starts))
    doc = s.doc[s.first_word]
    until = np.searchsorted(edges, edges[:-1] + MIN_WORDS)              # first sentence behind a run from each
    on = np.flatnonzero(until <= s.sentences[doc + 1])
    since = np.searchsorted(edges, edges[1:] - MIN_WORDS, side="right") - 1
    back = np.flatnonzero(since >= s.sentences[doc])
    pairs = np.unique(np.concatenate([on * (count + 1) + until[on], since[back] * (count + 1) + back + 1]))
    first, behind = edges[pairs // (count + 1)], edges[pairs % (count + 1)]
    words = segment_hash(s.data, s.starts, s.ends)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _power(_BASE, len(words)), out=sums[1:])
    hashes = mix64((sums[behind] - sums[first]) * _power(_INVERSE, len(words) + 1)[first] + (behind - first).astype(np.uint64))
    return hashes, s.doc[first], first, behind


def windows(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, hash, first word) of every window of MIN_WORDS words within a
    text of the slice; the name is the smallest hash of its runs of half the
    length, which neighbouring windows mostly share."""
    half, last = MIN_WORDS // 2, len(s.starts) - MIN_WORDS
    if last < 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = segment_hash(s.data, s.starts, s.ends)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _power(_BASE, len(words)), out=sums[1:])
    scale = _power(_INVERSE, len(words) + 1)

    def runs(n):
        return mix64((sums[n:] - sums[:-n]) * scale[:len(sums) - n] + np.uint64(n))

    least, width, want = runs(half), 1, MIN_WORDS - half + 1
    while width < want:                                                 # smallest of so many neighbours
        step = min(width, want - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    first = np.flatnonzero(s.doc[:last + 1] == s.doc[MIN_WORDS - 1:])
    return least[first], runs(MIN_WORDS)[first], first


def _prepared(column: pa.Array) -> Iterator[Slice]:
    for s in slices(column):
        s.words()
        sentence_starts(s)
        yield s


def repeated(docs: DataFrame, buckets: int) -> DataFrame:
    """(h, first) of every span that more than one id has: its hash and the
    smallest id.  ``docs`` has id and text.  A task gives a span once for all
    its occurrences in about half a million, so a hot one is pre-aggregated."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def packed():
            h, d = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            rows = np.empty(len(first), SPAN)
            rows["h"], rows["lo"] = h[first], d[first]
            rows["many"] = d[np.append(first[1:], len(h)) - 1] != d[first]
            where = (rows["h"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            names, starts = np.unique(where[order], return_index=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([x.tobytes() for x in np.split(rows[order], starts[1:])], pa.binary())], ["bucket", "body"])

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for s in _prepared(batch.column(1)):
                h, text, _, _ = spans(s)
                parts.append((h, ids[s.first + text]))
                held += len(h)
                if held >= FLUSH:
                    yield packed()
                    parts, held = [], 0
        if held:
            yield packed()

    def meet(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(b, SPAN) for b in table.column("body").to_pylist()])
        rows = rows[np.lexsort((rows["lo"], rows["h"]))]
        first = np.flatnonzero(np.append(True, rows["h"][1:] != rows["h"][:-1]))
        last = np.append(first[1:], len(rows)) - 1
        many = (rows["lo"][first] != rows["lo"][last]) | np.logical_or.reduceat(rows["many"], first)
        return pa.table([pa.array(rows["h"][first[many]].view(np.int64)), pa.array(rows["lo"][first[many]])], names=["h", "first"])

    return (docs.select("id", "text").mapInArrow(emit, "bucket long, body binary").groupBy("bucket")
            .applyInArrow(meet, "h long, first long"))


def bitmap(again: DataFrame) -> np.ndarray:
    """A bitmap of the hashes h, of fixed size: it spares the others a shuffle; a join decides."""
    bit = F.pmod("h", F.lit(FILTER_BITS))
    found = (again.select(bit.alias("_b")).groupBy((F.col("_b") / 64).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_b % 64 as int))")).alias("m"))).toArrow()
    maybe = np.zeros(FILTER_BITS // 64, np.uint64)
    maybe[found.column("w").to_numpy()] = found.column("m").to_numpy().view(np.uint64)
    return maybe


def passes(maybe: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = h % np.uint64(FILTER_BITS)
    return ((maybe[(at // np.uint64(64)).astype(np.int64)] >> (at % np.uint64(64))) & np.uint64(1)).astype(bool)


def occurrences(docs: DataFrame, again: DataFrame) -> DataFrame:
    """(id, mark, first, last): word ranges of ``docs`` (id, mark, text) that
    are an occurrence of a repeated span, but the first."""
    maybe = bitmap(again)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for s in _prepared(batch.column(2)):
                h, text, first, behind = spans(s)
                order = np.lexsort((first, h, text))                    # a text's later occurrences go anyway
                h, text, first, behind = (x[order] for x in (h, text, first, behind))
                own = np.append(False, (h[1:] == h[:-1]) & (text[1:] == text[:-1]))[:len(h)]
                keep = own | passes(maybe, h)
                h, text, first, behind, own = (x[keep] for x in (h, text, first, behind, own))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(ids[s.first + text]), pa.array(marks[s.first + text]),
                     *[pa.array((x - s.bounds[text]).astype(np.int32)) for x in (first, behind)], pa.array(own)],
                    ["h", "id", "mark", "first", "last", "own"])

    places = docs.select("id", "mark", "text").mapInArrow(
        emit, "h long, id long, mark long, first int, last int, own boolean")
    place = ["id", "mark", "first", "last"]
    other = (places.join(again.withColumnRenamed("first", "_f"), "h").filter(~F.col("own") & (F.col("id") != F.col("_f"))).select(*place))
    return other.union(places.filter("own").select(*place))


def _open(rows: np.ndarray, ranges: list | None) -> np.ndarray:
    """How many windows of each of ``rows`` (PLACED) hold no word of the ranges."""
    n = int(rows["b"].max())
    shut = np.zeros(n + 1, np.int64)
    for r in ranges or ():
        shut[min(n, max(0, r["first"] - MIN_WORDS + 1))] += 1
        shut[min(n, r["last"])] -= 1
    free = np.append(0, np.cumsum(np.cumsum(shut[:-1]) == 0))
    return free[rows["b"]] - free[rows["a"]]


def _placed(docs: DataFrame, cuts: DataFrame, maybe: np.ndarray | None) -> DataFrame:
    """(h, id, mark, first, own): of the windows that hold no word of ``cuts``
    (_id, _mark, cuts) the names, or the hashes of those whose name is in
    ``maybe``.  own: the text has it before, without a word in both."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for s in slices(batch.column(2)):
                s.words()
                name, whole, first = windows(s)
                doc = s.doc[first]
                if maybe is None:
                    starts = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (doc[1:] != doc[:-1]))[:len(name)])
                    h, begin, doc = name[starts], first[starts], doc[starts]
                    behind = first[np.append(starts[1:], len(name)) - 1] + 1 if len(starts) else begin
                else:
                    keep = passes(maybe, name)
                    h, begin, doc = whole[keep], first[keep], doc[keep]
                    behind = begin + 1
                rows = np.empty(len(h), PLACED)
                rows["h"], rows["a"], rows["b"] = h, begin - s.bounds[doc], behind - s.bounds[doc]
                texts, at = np.unique(doc, return_index=True)
                bodies = [x.tobytes() for x in np.split(rows, at[1:])] if len(texts) else []
                yield pa.RecordBatch.from_arrays([pa.array(ids[s.first + texts]), pa.array(marks[s.first + texts]),
                                                  pa.array(bodies, pa.binary())], ["id", "mark", "body"])

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, mark, body, ranges in zip(*(batch.column(k) for k in range(4))):
                rows = np.frombuffer(body.as_py(), PLACED)
                rows = rows[_open(rows, ranges.as_py()) > 0]
                if not len(rows):
                    continue
                order = np.lexsort((rows["a"], rows["h"]))
                rows = rows[order]
                new = np.append(True, rows["h"][1:] != rows["h"][:-1])
                if maybe is None:           # windows of one name may be far from each other
                    own = ~new | (rows["b"] - rows["a"] > MIN_WORDS)
                else:
                    start = np.flatnonzero(new)
                    own = rows["a"] - np.repeat(rows["a"][start], np.diff(np.append(start, len(rows)))) >= MIN_WORDS
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["h"].copy().view(np.int64)),
                     pa.array(np.full(n, i.as_py(), np.int64)), pa.array(np.full(n, mark.as_py(), np.int64)),
                     pa.array(rows["a"].copy()), pa.array(own)], ["h", "id", "mark", "first", "own"])

    packed = docs.select("id", "mark", "text").mapInArrow(emit, "id long, mark long, body binary")
    told = packed.join(cuts.hint("merge"), (F.col("id") == F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return told.select("id", "mark", "body", "cuts").mapInArrow(open_, "h long, id long, mark long, first int, own boolean")


def passages(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """(id, mark, first, last): word ranges of ``docs`` (id, mark, text) outside
    of ``cuts`` that come again after their first occurrence, staged."""
    many = (F.min("id") != F.max("id")) | F.max("own")
    names = _placed(docs, cuts, None).groupBy("h").agg(many.alias("many")).filter("many").select("h")
    found = stage(_placed(docs, cuts, bitmap(names)), "spans-windows")
    firsts = (found.groupBy("h").agg(F.min("id").alias("_f"), F.max("id").alias("_l")).filter("_f <> _l")
              .select(F.col("h").alias("_h"), "_f"))
    other = found.join(firsts, (F.col("h") == F.col("_h")) & (F.col("id") != F.col("_f")))
    place = ["id", "mark", "first", (F.col("first") + MIN_WORDS).alias("last")]
    return stage(other.filter("not own").select(*place).union(found.filter("own").select(*place)), "spans-passages")


def by_text(ranges: DataFrame) -> DataFrame:
    """(id, mark, cuts): the word ranges of each text.  Those that begin in one
    stretch of STRETCH words are merged where they meet before a text's are
    gathered, so a long text that repeats throughout has few."""
    last = "get(a, size(a) - 1)"
    joined = f"concat(slice(a, 1, size(a) - 1), array(named_struct('first', {last}.first, 'last', greatest({last}.last, x.last))))"
    merged = ("aggregate(sort_array(_all), CAST(array() AS array<struct<first:int,last:int>>), (a, x) -> "
              f"CASE WHEN x.first <= {last}.last THEN {joined} ELSE concat(a, array(x)) END)")
    stretches = (ranges.groupBy("id", "mark", F.expr(f"first div {STRETCH}").alias("_stretch"))
                 .agg(F.collect_set(F.struct(F.col("first").cast("int").alias("first"), F.col("last").cast("int").alias("last"))).alias("_all")))
    return (stretches.select("id", "mark", F.expr(merged).alias("_merged"))
            .groupBy("id", "mark").agg(F.flatten(F.collect_list("_merged")).alias("cuts")))


def remove_repeats(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text"), within: bool = False) -> DataFrame:
    """(row, text, n_sentences, n_removed) for every document: ``row`` is the
    row as it was, text what stays of it, n_removed the sentences that lose words.

    Spans of whole sentences go; ``within``: so do the passages that begin or
    end within a sentence (the query and the pipeline have it so).

    The first occurrence of a span is that in the smallest id (null last), at
    the earliest place.  A text that loses nothing stays as it is, a null text
    null; one that loses words loses the white space behind them and at its
    end too.  Rows with equal ids count as one place: what they share is
    not repeated for that.  No rows give no rows; other columns may have any
    name."""
    doc_id, text = columns
    row = docs.select(F.struct("*").alias("row"))
    id_, mark = F.coalesce(F.col(f"row.{doc_id}").cast("long"), F.lit(LAST)), F.xxhash64(F.col(f"row.{text}"))
    plain = row.select(id_.alias("id"), mark.alias("mark"), F.col(f"row.{text}").alias("text"))
    volume = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    again = stage(repeated(plain, max(64, math.ceil(volume / BUCKET_BYTES))), "spans-repeated")
    named = [F.col("id").alias("_id"), F.col("mark").alias("_mark"), "cuts"]
    whole = stage(by_text(occurrences(plain, again)), "spans-cuts")
    cuts = whole.select(*named)
    if within:
        ranges = whole.select("id", "mark", F.explode("cuts").alias("c")).select("id", "mark", "c.first", "c.last")
        cuts = stage(by_text(ranges.union(passages(plain, cuts))), "spans-all-cuts").select(*named)
    keyed = row.select("row", id_.alias("_i"), mark.alias("_m"))
    place = docs.columns.index(text)
    # A merge join whatever the size: the ranges grow with the corpus.
    joined = keyed.join(cuts.hint("merge"), (F.col("_i") == F.col("_id")) & (F.col("_m") == F.col("_mark")), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ranges = batch.column(0), batch.column(1)
            for s in _prepared(rows.field(place)):
                kept: list = [None] * s.n          # the texts that lose something; others are in their rows
                removed = np.zeros(s.n, np.int64)
                mine = ranges.slice(s.first, s.n)
                for i in np.flatnonzero(mine.is_valid().to_numpy(zero_copy_only=False)):
                    begin, end = s.bounds[i], s.bounds[i + 1]
                    gone = np.zeros(end - begin + 1, np.int64)
                    for r in mine[int(i)].as_py():
                        gone[r["first"]] += 1
                        gone[r["last"]] -= 1
                    gone = np.cumsum(gone[:-1]) > 0
                    turns = np.flatnonzero(np.append(True, gone[1:] != gone[:-1]))        # words where a run begins
                    edges = [s.offsets[i], *s.starts[begin + turns[1:]], s.offsets[i + 1]]
                    left = b"".join(s.data[a:b].tobytes() for a, b, g in zip(edges, edges[1:], gone[turns]) if not g)
                    kept[i] = left.rstrip(b" \t\n\x0b\x0c\r").decode()
                    first = s.first_word[s.sentences[i]:s.sentences[i + 1]] - begin
                    removed[i] = np.logical_or.reduceat(gone, first).sum()
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(s.first, s.n), pa.array(kept, pa.string()), pa.array(np.diff(s.sentences)), pa.array(removed)],
                    ["row", "_cut", "n_sentences", "n_removed"])

    schema = row.schema.add("_cut", "string").add("n_sentences", "long").add("n_removed", "long")
    return joined.select("row", "cuts").mapInArrow(cut, schema).select(
        "row", F.coalesce("_cut", F.col(f"row.{text}")).alias("text"), "n_sentences", "n_removed")


def without_repeats(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """The rows of ``docs``, all columns, with what stays of their texts
    (n_chars follows); a document that loses all its sentences goes."""
    text = columns[1]
    left = remove_repeats(docs, columns, within=True).filter((F.col("n_removed") == 0) | (F.col("text") != ""))
    new = {text: F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(
        F.col("row.n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return left.select(*[new.get(c, F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
