"""Best-fit packing of token sequences.

Documents are tokenised and cut inside tasks.  What best-fit decreasing does
depends on the pieces' lengths alone, so it runs once over the histogram of
lengths (one row a length, whatever the corpus): a segment tree over the
remaining capacities finds the tightest open bin, and all pieces of a length
that meet the same kind of bin are placed as one run.  Tasks number their
pieces of each length, Spark adds the tasks up, and every piece finds its run."""

from __future__ import annotations

import os
import struct
import zlib
from collections import defaultdict, deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitstop.llm.scratch import stage
from pitstop.llm.text import Slice, is_space, segment_hash, slices

CAPACITY = 1024
END_ID = 2
CACHE_IDS = 4_000_000         # ids of chunks that a worker keeps: about 55 MB with their hashes

# No token of the tokenizer's pattern crosses from another character into
# white space or from an ASCII letter into a punctuation mark, so texts can be
# encoded in chunks that begin there.
# What the pattern takes for white space beside the six of ASCII (UTF-8).
_OTHER_SPACES = [int.from_bytes(c.encode().ljust(3, b"\0"), "big") for c in
                 "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
                 "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"]
_BYTE_SIGNS = {}     # the printable sign that byte-level BPE has for each byte
_shift = 256
for _b in range(256):
    if 33 <= _b <= 126 or 161 <= _b <= 172 or 174 <= _b:
        _BYTE_SIGNS[_b] = chr(_b)
    else:
        _BYTE_SIGNS[_b] = chr(_shift)
        _shift += 1
_LETTERS, _PUNCTUATION = np.zeros(256, bool), np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION[[*b"!\"#$%&'()*+,-./:;=?@[]^_`{|}~"]] = True       # without <, which begins <|endoftext|>


class Encoder:
    """A worker's tokenizer and the ids of the chunks it has met, by hash.  A
    chunk of letters, perhaps with a space before, is one match of the
    tokenizer's pattern and goes to its model at once; others go through the
    whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.names = np.zeros(0, np.uint64)          # of the chunks met, sorted; their ids lie in flat
        self.where = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def encode(self, chunk: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not (chunk[1:] if chunk[0] == " " else chunk).isalpha():
            return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        found = self.model.tokenize(chunk.encode().decode("latin-1").translate(_BYTE_SIGNS))
        return struct.pack("<%dI" % len(found), *[t.id for t in found])

    def slice_ids(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a slice, and where each text's begin."""
        space = is_space(s.data)
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[1:] |= _PUNCTUATION[s.data[1:]] & _LETTERS[s.data[:-1]]
        edges = s.offsets[:-1][np.diff(s.offsets) > 0]
        begins[edges] = True
        # A text with other white space is one chunk: the tokenizer sees it whole.
        odd = np.zeros(s.n, bool)
        lead = np.flatnonzero((s.data == 0xC2) | ((s.data >= 0xE1) & (s.data <= 0xE3)))
        rest = [np.where(lead + j < len(s.data), s.data[np.minimum(lead + j, len(s.data) - 1)], 0).astype(np.int64) for j in (1, 2)]
        code = (s.data[lead].astype(np.int64) << 16) + (rest[0] << 8) + np.where(s.data[lead] == 0xC2, 0, rest[1])
        odd[np.searchsorted(s.offsets, lead[np.isin(code, _OTHER_SPACES)], side="right") - 1] = True
        for i in np.flatnonzero(odd):
            begins[s.offsets[i] + 1:s.offsets[i + 1]] = False
        for at in np.flatnonzero((s.data[:-1] == 60) & (s.data[1:] == 124)):    # "<|": whole, for the special token
            i = np.searchsorted(s.offsets, at, side="right") - 1
            begins[s.offsets[i] + 1:s.offsets[i + 1]] = False
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(s.data))
        names, first, which = np.unique(segment_hash(s.data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.names, names)
        known = np.append(self.names, 0)[at] == names
        known &= at < len(self.names)
        fresh = [self.encode(s.data[starts[i]:ends[i]].tobytes().decode()) for i in first[~known]]
        more = np.fromiter(map(len, fresh), np.int64, len(fresh)) // 4
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(fresh), "<u4")])
        where, sizes = np.empty((2, len(names)), np.int64)
        where[known], sizes[known] = self.where[at[known]], self.sizes[at[known]]
        where[~known], sizes[~known] = len(self.flat) + np.cumsum(more) - more, more
        if len(flat) <= CACHE_IDS:
            self.names = np.insert(self.names, at[~known], names[~known])
            self.where = np.insert(self.where, at[~known], where[~known])
            self.sizes = np.insert(self.sizes, at[~known], more)
            self.flat = flat
        else:
            self.forget()
        counts = sizes[which]
        before = np.append(0, np.cumsum(counts))
        ids = flat[np.repeat(where[which] - before[:-1], counts) + np.arange(before[-1])]
        return ids, before[np.searchsorted(starts, s.offsets)]


_workers: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _workers:
        _workers[path] = Encoder(path)
    return _workers[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           columns: Sequence[str] = ("doc_id", "text"), with_ids: bool = False, with_rows: bool = False,
           with_bytes: bool = False) -> DataFrame:
    """part, nth, doc_id, piece, start, length, ids_crc32 of every piece: the
    ids of the text, then ``end_id``; nth counts the pieces of its length in
    its task, ``part``.  On demand also ids, an array; doc_row, a number that
    tells rows with one id apart; and ids_bytes, the ids as little-endian
    unsigned 32-bit integers, which cost Spark far less than an array.  A document beyond the capacity is cut into full pieces
    behind a first one of the rest.  A null text counts as empty and gives one
    piece of length 1.  The numbers hold for one run: stage the result."""
    end = np.array([end_id], "<u4").tobytes()
    schema = ("part long, nth long, doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
              + ", doc_row long" * with_rows + ", ids_bytes binary" * with_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, met = encoder(tokenizer_path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            ids_column = batch.column(0).to_pylist()
            row_column = batch.column(2).to_pylist() if with_rows else None
            for s in slices(batch.column(1), 1 << 20):
                out: list[list] = [[], [], [], [], [], [], [], [], []]
                all_ids, bounds_of = tokens.slice_ids(s)
                for nth, (low, high) in enumerate(zip(bounds_of, bounds_of[1:]), s.first):
                    doc = ids_column[nth]
                    ids = all_ids[low:high].tobytes() + end
                    n = len(ids) // 4
                    bounds = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
                        body = ids[4 * a:4 * b]
                        for column, value in zip(out, (met[b - a], doc, k, a, b - a, zlib.crc32(body),
                                                       np.frombuffer(body, "<u4").astype(np.int32) if with_ids else None,
                                                       row_column[nth] if with_rows else None, body if with_bytes else None)):
                            column.append(value)
                        met[b - a] += 1
                arrays = [pa.array(np.full(len(out[0]), part)), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                          pa.array(out[2], pa.int32()), *[pa.array(c, pa.int64()) for c in out[3:6]]]
                names = ["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(out[6], pa.list_(pa.int32())))
                    names.append("ids")
                if with_rows:
                    arrays.append(pa.array(out[7], pa.int64()))
                    names.append("doc_row")
                if with_bytes:
                    arrays.append(pa.array(out[8], pa.binary()))
                    names.append("ids_bytes")
                yield pa.RecordBatch.from_arrays(arrays, names)

    doc_id, text = columns
    rows = [F.monotonically_increasing_id()] if with_rows else []
    return docs.select(F.col(doc_id).cast("long"), F.col(text), *rows).mapInArrow(cut, schema)


class SegmentTree:
    """Open bins by remaining capacity; finds the tightest that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.leaves
        while i:
            self.counts[i] += n
            i //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that has a bin."""
        i = least + self.leaves
        if self.counts[i]:
            return least
        while i > 1:
            if not i % 2 and self.counts[i + 1]:   # a right sibling with bins: go down its left edge
                i += 1
                while i < self.leaves:
                    i = 2 * i + (not self.counts[2 * i])
                return i - self.leaves
            i //= 2
        return None


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Best-fit decreasing over {length: count}.  Returns the runs (length,
    first, last, bin, per_bin, offset): pieces first..last of that length go
    to consecutive bins from ``bin``, ``per_bin`` to each, from ``offset`` on;
    and the number of bins.  Equal to placing the pieces one by one: after a
    piece its bin is the tightest for the next of that length while it fits."""
    tree, bins = SegmentTree(capacity), defaultdict(deque)   # remaining capacity -> runs of bins [first, count]
    runs, opened = [], 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            bins[left].append([first, n])
            tree.add(left, n)

    for length in sorted(histogram, reverse=True):
        done, count = 0, histogram[length]
        while done < count:
            left = tree.tightest(length)
            if left is None:
                left, take = capacity, -(-(count - done) // (capacity // length))
                first, opened = opened, opened + take
            else:
                run = bins[left][0]
                take = min(run[1], -(-(count - done) // (left // length)))
                first = run[0]
                run[0] += take
                run[1] -= take
                if not run[1]:
                    bins[left].popleft()
                tree.add(left, -take)
            per = left // length
            full, rest = divmod(min(count - done, take * per), per)
            if full:
                runs.append((length, done, done + full * per - 1, first, per, capacity - left))
                put(left - per * length, first, full)
                done += full * per
            if rest:
                runs.append((length, done, done + rest - 1, first + full, rest, capacity - left))
                put(left - rest * length, first + full, 1)
                done += rest
    return runs, opened


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (rows of :func:`pieces`) with sequence_id and offset in place
    of part and nth.  Needs a table that gives the same rows whenever it is
    read, such as a staged one.

    Pieces of equal length are alike to the method.  A piece's rank among them
    is its number in its task and the counts of the tasks before, a row a task
    and length; pieces are not shuffled for it, so neither copies nor a length
    that a third of all pieces have gather anywhere.  No rows give no rows."""
    spark = parts.sparkSession
    counts = parts.groupBy("part", "length").agg(F.count("*").alias("_n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("_n")).collect()}   # at most `capacity` rows
    runs, _ = plan_runs(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A table: while it is small the planner sees so and broadcasts it, and no piece travels.
    starts = stage(counts.select("part", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_from")), "pack-starts")
    ranked = parts.join(starts, ["part", "length"]).withColumn("_rank", F.col("_from") + F.col("nth"))
    names = ["_length", "_first", "_last", "_bin", "_per", "_offset"]
    # Runs of at most `capacity` lengths.  As an Arrow table they need no Python worker, which a list of rows would start.
    plan = F.broadcast(spark.createDataFrame(pa.table([pa.array([r[i] for r in runs], pa.int64()) for i in range(len(names))], names)))
    k = F.col("_rank") - F.col("_first")
    kept = [c for c in parts.columns if c not in ("part", "nth")]
    return (ranked.join(plan, (F.col("length") == F.col("_length")) & F.col("_rank").between(F.col("_first"), F.col("_last")))
            .select(*kept, (F.col("_bin") + F.floor(k / F.col("_per"))).cast("long").alias("sequence_id"),
                    (F.col("_offset") + k % F.col("_per") * F.col("length")).cast("long").alias("offset")))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   columns: Sequence[str] = ("doc_id", "text"), **carried: bool) -> DataFrame:
    """Every piece of every document with its place: see :func:`pieces` (also
    for what can be ``carried``) and :func:`pack`.  Documents with equal ids
    are packed each for itself."""
    return pack(stage(pieces(docs, tokenizer_path, capacity, end_id, columns, **carried), "pack-pieces"), capacity)
