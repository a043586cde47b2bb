"""N-gram Jaccard join: T-occurrence search with DivideSkip.

A document is its set of word 5-shingles (64-bit hashes).  Documents with
equal sets are one class.  Two classes link when 100 * intersection >= 80 *
union, so a query class of n shingles needs T = ceil(4 (n + m) / 9) common
ones with a class of m.

Candidates: in one global order, two linked sets share at least l of their
first n - ceil(0.8 n) + l shingles, for any l; l = 1 + n / 10 is taken.  These
prefixes go to inverted lists in hash buckets.  Very frequent shingles come
last in the order, so lists stay short (the order is a matter of speed alone:
any order gives the same links).  A class of which fewer than l prefix shingles
(the l of its smallest partner) are in a list with another class of a size in
reach cannot link and is left out; that takes one pass over the lists.  Lists
with the same smallest class make one group; the lists of a family of near
copies nearly all have, so a class is in few groups.

Search: the classes of a group meet in blocks of bounded size, two parts of
the group in each; a group too large for one block is first split by size, as
linked sets differ by a quarter at most.  Over the inverted lists of a block
the shortest are merged and the longest are probed (DivideSkip), and every
class that reaches T is a link.  A pair that meets in several groups counts in
the one with the smallest name.  A block gives its classes' numbers of links,
and of the links themselves those that connect, fewer than it has classes."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitstop.llm.components import connected
from pitstop.llm.scratch import stage
from pitstop.llm.text import mix64, slices

SHINGLE = 5
HOT_SHINGLES = 1 << 16        # so many of the most frequent shingles come last; a bound on the ordering hint alone
FLUSH = 1 << 19               # shingles a task gathers before it emits
BUCKET_POSTINGS = 1 << 20     # postings of an inverted-list bucket, about
SUBLIST = 50_000              # a hot shingle's list is dealt over so many classes each
BLOCK_SHINGLES = 1 << 20      # shingles of a part of a group in a search block, about
MERGED = 64                   # entries of short lists that go through a heap; more are merged as sorted runs
FILTER_BITS = 1 << 24         # of the filter that says which sets are needed: 2 MB whatever the corpus
SEEN = 200_000                # digests a task remembers, to emit copies once


def needed(n, m):
    """Common shingles that classes of n and m need: ceil(80 (n + m) / 180)."""
    return (4 * (n + m) + 8) // 9


def prefix_length(n: int) -> int:
    """How many first shingles of a set go to the lists."""
    return n - -(-4 * n // 5) + 1 + n // 10


#: Prefix shingles that a class needs to share: those of its smallest partner, of ceil(0.8 n).
SHARED = "1 + ((4 * n + 4) div 5) div 10"


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.uint64, np.uint64]]:
    """(row, sorted set, digest, second digest) of every text of a batch; the
    set of a text of 1 to 4 words is its whole sequence."""
    for s in slices(column):
        s.words()
        hashes, first = s.shingles(SHINGLE, lower=True, short=True)
        bounds = np.searchsorted(first, s.bounds)
        for i in range(s.n):
            found = np.unique(hashes[bounds[i]:bounds[i + 1]])
            yield s.first + i, found, mix64(found).sum(dtype=np.uint64), mix64(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)


def class_key(found: np.ndarray, one: np.uint64, two: np.uint64) -> int:
    """One signed 64-bit name of a set; empty sets have name 0."""
    if not len(found):
        return 0
    name = (int(one) + 3 * int(two) + len(found)) % 2**64
    return (name - 2**64 if name >= 2**63 else name) or 1


def described(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Staged (hot, id, n, key): a row a document (its set size and class), and
    rows (hot) of shingles that are frequent among the classes of a task, with
    their count there in n."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, held_n, classes = [], 0, 0

        def frequent():
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= max(4, classes // 250)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(often.sum(), bool)), pa.array(tokens[often].view(np.int64)),
                 pa.array(counts[often].astype(np.int64)), pa.nulls(int(often.sum()), pa.int64())], ["hot", "id", "n", "key"])

        for batch in batches:
            sizes, keys = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for row, found, one, two in shingle_sets(batch.column(1)):
                sizes[row], keys[row] = len(found), class_key(found, one, two)
                if len(found) and keys[row] not in seen:
                    if len(seen) < SEEN:
                        seen.add(int(keys[row]))
                    held.append(found)
                    held_n, classes = held_n + len(found), classes + 1
                    if held_n >= 2 * FLUSH:
                        yield frequent()
                        held, held_n, classes = [], 0, 0
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(batch), bool)), batch.column(0), pa.array(sizes), pa.array(keys)],
                                             ["hot", "id", "n", "key"])
        if held:
            yield frequent()

    return stage(docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text)).mapInArrow(
        describe, "hot boolean, id long, n long, key long"), "ngram-classes")


def postings(docs: DataFrame, text: str, hot: np.ndarray, salts: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, body): packed postings (shingle, class, size; whether the list is
    dealt, and whether the shortest prefix has it) of every class's prefix (see :func:`prefix_length`).  ``hot`` holds the frequent shingles, sorted, ``salts`` over how
    many buckets each one's list is dealt."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts, held = [], 0

        def packed():
            tokens, keys, sizes, where, meets = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(where, kind="stable")
            rows = np.empty(len(order), POSTING)
            rows["t"], rows["k"], rows["n"], rows["m"] = tokens[order], keys[order], sizes[order], meets[order]
            rows["s"] = np.isin(rows["t"], hot[salts > 1]) if len(hot) else False
            names, starts = np.unique(where[order], return_index=True)
            bodies = [x.tobytes() for x in np.split(rows, starts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(bodies, pa.binary())], ["bucket", "body"])

        for batch in batches:
            for _, found, one, two in shingle_sets(batch.column(0)):
                n, key = len(found), class_key(found, one, two)
                if not n or key in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(key)
                take = prefix_length(n)
                deal = np.zeros(n, np.uint64)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, found), len(hot) - 1)
                    often = hot[at] == found
                    deal[often] = np.uint64(key & (2**63 - 1)) % salts[at[often]].astype(np.uint64)
                    order = np.concatenate([np.flatnonzero(~often), np.flatnonzero(often)])[:take]
                else:
                    order = np.arange(take)
                prefix = found[order]
                where = (mix64(prefix + deal[order] * np.uint64(0x2545F4914F6CDD1D)) % np.uint64(buckets)).astype(np.int64)
                parts.append((prefix, np.full(take, key), np.full(take, n), where, np.arange(take) < take - n // 10))
                held += take
                if held >= FLUSH:
                    yield packed()
                    parts, held = [], 0
        if parts:
            yield packed()

    return docs.select(F.col(text)).mapInArrow(emit, "bucket long, body binary")


POSTING = [("t", "<u8"), ("k", "<i8"), ("n", "<u4"), ("s", "?"), ("m", "?")]


def _with_near(rows: np.ndarray) -> np.ndarray:
    """Of postings by (shingle, size), those of classes that have another of a
    size in reach in the list; of dealt lists all."""
    n = rows["n"].astype(np.int64)
    near = (rows["t"][1:] == rows["t"][:-1]) & (4 * n[1:] <= 5 * n[:-1])
    keep = rows["s"].copy()
    keep[1:] |= near
    keep[:-1] |= near
    return rows[keep]


def read_lists(table: pa.Table) -> pa.Table:
    """A bucket's inverted lists.  (null, key, n, c): c lists hold the class and
    another of a size in reach.  (id, key, n, 0): members of groups by the
    shortest prefixes; a list's group is its smallest class, the parts of a
    list that is dealt over several buckets have its shingle for a group."""
    rows = np.concatenate([np.frombuffer(b, POSTING) for b in table.column("body").to_pylist()])
    rows = rows[np.lexsort((rows["k"], rows["t"]))]
    keep = np.append(True, (rows["t"][1:] != rows["t"][:-1]) | (rows["k"][1:] != rows["k"][:-1]))       # copies from several tasks
    rows = rows[keep]
    rows = _with_near(rows[np.lexsort((rows["n"], rows["t"]))])
    keys, first, counts = np.unique(rows["k"], return_index=True, return_counts=True)
    out = [(np.zeros(len(keys), np.int64), keys, rows["n"][first].astype(np.int64), counts)]
    rows = _with_near(rows[rows["m"]])
    if len(rows):
        starts = np.flatnonzero(np.append(True, rows["t"][1:] != rows["t"][:-1]))
        group = np.where(rows["s"][starts], rows["t"][starts].view(np.int64), np.minimum.reduceat(rows["k"], starts))
        group = np.repeat(group, np.diff(np.append(starts, len(rows))))
        order = np.lexsort((rows["k"], group))
        group, rows = group[order], rows[order]
        first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (rows["k"][1:] != rows["k"][:-1])))
        out.append((group[first], rows["k"][first].copy(), rows["n"][first].astype(np.int64), np.zeros(len(first), np.int64)))
    ids, keys, sizes, counts = (np.concatenate(x) for x in zip(*out))
    return pa.table([pa.array(ids, mask=counts > 0), pa.array(keys), pa.array(sizes), pa.array(counts)], names=["id", "key", "n", "c"])


class InvertedLists:
    """The inverted lists of some sets: for each element, which sets have it."""

    def __init__(self, sets: Sequence[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], np.int64)
        body = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(body, kind="stable")                        # owners rise within a list
        body = body[order]
        self.owner = owner[order]
        self.starts = np.flatnonzero(np.append(True, body[1:] != body[:-1]))
        self.elements = body[self.starts]
        self.ends = np.append(self.starts[1:], len(body))
        self._mark = np.zeros(len(sets), bool)

    def search(self, query: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Which sets, of those with a ``wanted`` flag, share needed(len(query),
        len(set)) elements with the query: T-occurrence search by DivideSkip.
        Of the query's lists the T - 1 longest are left out of the merge; a
        set that the short ones hold often enough is looked up in them."""
        n, none = len(query), np.zeros(0, np.int64)
        near = wanted & (5 * self.sizes >= 4 * n) & (4 * self.sizes <= 5 * n)
        if not near.any():
            return none
        least = needed(n, self.sizes)
        threshold = int(least[near].min())
        at = np.minimum(np.searchsorted(self.elements, query), len(self.elements) - 1)
        hit = at[self.elements[at] == query]
        if len(hit) < threshold:
            return none
        hit = hit[np.argsort(self.ends[hit] - self.starts[hit], kind="stable")]
        lists = list(zip(self.starts[hit].tolist(), self.ends[hit].tolist()))
        short, long = lists[:len(lists) - threshold + 1], lists[len(lists) - threshold + 1:]
        runs = [x[near[x]] for x in (self.owner[a:b] for a, b in short)]
        if sum(map(len, runs)) <= MERGED:
            merged = np.fromiter(heapq.merge(*[x.tolist() for x in runs]), np.int64)
        else:
            merged = np.sort(np.concatenate(runs), kind="stable")          # merges the sorted runs
        found = merged[np.append(True, merged[1:] != merged[:-1])] if len(merged) else merged
        count = np.diff(np.append(np.searchsorted(merged, found), len(merged)))
        for left, (a, b) in zip(range(len(long), 0, -1), long):            # the shorter lists first
            if left % 16 == 0 or left == len(long):
                open_ = count + left >= least[found]
                found, count = found[open_], count[open_]
                if not len(found):
                    return none
            entries = self.owner[a:b]
            if 16 * len(found) < b - a:                                    # binary probes, or a mark for each entry
                j = np.minimum(np.searchsorted(entries, found), b - a - 1)
                count += entries[j] == found
            else:
                self._mark[entries] = True
                count += self._mark[found]
                self._mark[entries] = False
        return found[count >= least[found]]


def search_block(keys: Sequence[int], sets: Sequence[np.ndarray], side: np.ndarray, docs: np.ndarray,
                 group: int, groups: Sequence[Sequence[int]]) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(links that connect what is connected among the classes of a block, how
    many documents each class links with by pairs that count here).  ``side``
    says which part of the group each is of: with two parts, only classes of
    different parts are compared here.  ``groups`` are all groups of a class: a
    pair that shares one of a smaller name than ``group`` counts there."""
    lists = InvertedLists(sets)
    root, counts = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    crossed, links = side.min() != side.max(), []
    members: dict[int, list[int]] = {}
    for i, names in enumerate(groups):
        for g in names:
            if g < group:
                members.setdefault(g, []).append(i)
    earlier = {g: np.array(x) for g, x in members.items() if len(x) > 1}
    del members
    for q in range(len(keys)):
        if crossed and side[q] != side.min():
            continue
        wanted = side != side[q] if crossed else np.arange(len(keys)) > q
        found = lists.search(sets[q], wanted) if wanted.any() else ()
        if not len(found):
            continue
        new = np.ones(len(found), bool)
        for g in groups[q]:
            if g in earlier:
                new &= ~np.isin(found, earlier[g])
        counts[q] += docs[found[new]].sum()
        counts[found[new]] += docs[q]
        for i in found[root[found] != root[q]].tolist():
            if root[i] != root[q]:
                root[root == root[i]] = root[q]
                links.append((keys[q], keys[i]))
    return links, counts


def _search(table: pa.Table) -> pa.Table:
    keys, first = np.unique(table.column("key").to_numpy(), return_index=True)   # copies from several tasks
    first = first[np.argsort(-table.column("n").to_numpy()[first], kind="stable")]
    pick = table.take(pa.array(first))
    sets = [np.frombuffer(x.as_buffer(), "<u8") for c in pick.column("body").chunks for x in c]
    keys = pick.column("key").to_pylist()
    links, counts = search_block(keys, sets, pick.column("part").to_numpy(), pick.column("docs").to_numpy(),
                                 pick.column("id")[0].as_py(), pick.column("groups").to_pylist())
    some = np.flatnonzero(counts)
    return pa.table([pa.array([x[0] for x in links] + [keys[i] for i in some], pa.int64()),
                     pa.array([x[1] for x in links] + [None] * len(some), pa.int64()),
                     pa.array([None] * len(links) + counts[some].tolist(), pa.int64())], names=["a", "b", "c"])


def by_size(members: DataFrame) -> DataFrame:
    """``members`` (id, key, n) by groups of different classes, without those of
    one, and with groups beyond a block split by size: a class goes to its own
    band of sizes and to the next, so two that can link (a quarter apart at
    most) meet in the band of the larger one."""
    weights = (members.groupBy("id").agg(F.count("*").alias("_m"), F.sum("n").alias("_w"), F.bit_xor(F.xxhash64("key")).alias("_x"),
                                         F.bit_xor(F.xxhash64("key", F.lit(1))).alias("_y")).filter("_m > 1"))
    band = F.floor(F.log("n") / math.log(1.25))
    split = F.array(F.xxhash64("id", band), F.xxhash64("id", band + 1))
    return (members.join(weights, "id")
            .select(F.explode(F.when(F.col("_w") > 2 * BLOCK_SHINGLES, split)
                              .otherwise(F.array(F.xxhash64("_m", "_x", "_y")))).alias("id"), "key", "n").distinct())


def dealt(members: DataFrame) -> DataFrame:
    """``members`` (id, key, n) in blocks (id, low, high): a group is cut into
    ``parts`` of about BLOCK_SHINGLES, with a block for every two of them and
    for each alone; a class is in as many as there are parts."""
    groups = (members.groupBy("id").agg(F.count("*").alias("_m"), F.sum("n").alias("_w")).filter("_m > 1")
              .select("id", F.ceil(F.col("_w") / float(BLOCK_SHINGLES)).cast("int").alias("parts")))
    part = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    each = members.join(groups, "id").select("id", "key", "n", "parts", part.alias("part"))
    return (each.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("_o"))
            .select("id", "key", "n", "part", F.least("part", "_o").alias("low"), F.greatest("part", "_o").alias("high")))


def searched(docs: DataFrame, text: str, members: DataFrame, classes: DataFrame) -> DataFrame:
    """Staged rows of the groups of ``members`` (id, key, n): links (a, b) that
    connect, and (a, c): class a links with c documents by pairs of one block."""
    met = stage(dealt(stage(by_size(members), "ngram-sized")), "ngram-blocks")
    named = met.groupBy("key").agg(F.sort_array(F.collect_set("id")).alias("groups"))   # at most one a shingle of the prefix
    blocks = met.join(named, "key").join(classes.select("key", "docs"), "key")
    # A bitmap of the classes needed, of fixed size: it spares the other sets a shuffle; the join decides.
    words = (met.select(F.pmod("key", F.lit(FILTER_BITS)).alias("_b"))          # keys are hashes
             .groupBy((F.col("_b") / 32).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(_b % 32 as int))")).alias("m"))).toArrow()
    wanted = np.zeros(FILTER_BITS // 32, np.int64)
    wanted[words.column("w").to_numpy()] = words.column("m").to_numpy()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, bodies, held = [], [], 0
        for batch in batches:
            for _, found, one, two in shingle_sets(batch.column(0)):
                key = class_key(found, one, two)
                if not len(found) or key in seen or not wanted[key % FILTER_BITS // 32] >> key % 32 & 1:
                    continue
                if len(seen) < SEEN:
                    seen.add(key)
                keys.append(key)
                bodies.append(found.tobytes())
                held += len(found)
                if held >= FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(bodies, pa.binary())], ["key", "body"])
                    keys, bodies, held = [], [], 0
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(bodies, pa.binary())], ["key", "body"])

    sets = docs.select(F.col(text)).mapInArrow(emit, "key long, body binary")
    return stage(sets.join(blocks, "key").groupBy("id", "low", "high").applyInArrow(_search, "a long, b long, c long"), "ngram-links")


@dataclass
class Joined:
    """members: doc_id, n_shingles, component_id, n_links (documents that it
    links with, those of its own class among them), key (its class), label
    (the smallest class of its component; null without a set) for every
    document; links: pairs of classes (a, b: keys) that link, enough to
    connect all that are connected."""
    members: DataFrame
    links: DataFrame


def join(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text")) -> Joined:
    """All documents by what they link with.

    component_id is the smallest doc_id that links reach, the document's own
    included; n_links counts every document it links with.  Documents with equal sets are linked.  A null, empty or blank
    text has no set and links with nothing: its component is its own id.  A
    null id is larger than any; rows with equal ids are documents of their
    own, and link by their texts.  No rows give no rows."""
    doc_id, text = columns
    found = described(docs, doc_id, text)
    rows = found.filter("not hot").drop("hot")
    classes = stage(rows.filter("n > 0").groupBy("key").agg(F.max("n").alias("n"), F.min("id").alias("rep"),
                                                              F.count("*").alias("docs")), "ngram-keys")
    top = (found.filter("hot").groupBy("id").agg(F.sum("n").alias("c")).orderBy(F.desc("c"), "id")
           .limit(HOT_SHINGLES).toArrow())
    hot, counts = top.column("id").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.argsort(hot)
    hot, salts = hot[order], -(-counts[order] // SUBLIST)
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(64, math.ceil(total / 5 / BUCKET_POSTINGS))
    lists = stage(postings(docs, text, hot, salts, buckets).groupBy("bucket")
                  .applyInArrow(read_lists, "id long, key long, n long, c long"), "ngram-lists")
    can = lists.filter("id is null").groupBy("key").agg(F.sum("c").alias("_c"), F.max("n").alias("n")).filter(f"_c >= {SHARED}").select("key")
    members = stage(lists.filter("id is not null").select("id", "key", "n").distinct().join(can, "key", "left_semi"), "ngram-groups")
    found = searched(docs, text, members, classes)
    links = found.filter("b is not null").select("a", "b").distinct()
    labels = connected(links)
    counts = found.filter("b is null").groupBy(F.col("a").alias("key")).agg(F.sum("c").alias("n_links"))
    named = classes.join(counts, "key", "left").join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    smallest = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    linked = (F.coalesce("n_links", F.lit(0)) + F.col("docs") - 1).alias("n_links")
    of_class = stage(named.join(smallest, "label").select("key", "component_id", "label", linked), "ngram-components")
    # Texts without a set are one class, perhaps a large one, and meet nothing.
    alone = rows.filter("n = 0").select("*", *[F.lit(None).cast("long").alias(c) for c in ("component_id", "label", "n_links")])
    whole = rows.filter("n > 0").join(of_class, "key").unionByName(alone)
    return Joined(whole.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                               F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                               F.coalesce("n_links", F.lit(0)).alias("n_links"), "key", "label"), links)


def first_of_each(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """The rows of ``docs``, all columns, but one document of each component:
    that with the smallest id, null last, and among equal ids that of the
    smallest class.  Documents without a set all stay."""
    doc_id, text = columns
    joined = join(docs, columns).members
    joined = joined.filter("n_shingles > 0").groupBy("label", "doc_id", "key").agg(F.count("*").alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "copies")).alias("k")
    kept = stage(joined.groupBy("label").agg(first).select(F.col("k.doc_id").alias("_id"), F.col("k.key").alias("_key"), "k.copies"),
                 "ngram-kept")
    at = docs.columns.index(text)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            keys = [class_key(*x[1:]) for x in shingle_sets(row.field(at))]
            yield pa.RecordBatch.from_arrays([row, pa.array(keys, pa.int64())], ["row", "key"])

    schema = docs.select(F.struct("*").alias("row")).schema.add("key", "long")
    keyed = docs.select(F.struct("*").alias("row")).mapInArrow(named, schema)
    chosen = (keyed.join(kept, (F.col("key") == F.col("_key")) & F.col(f"row.{doc_id}").eqNullSafe(F.col("_id")), "left")
              .filter("key = 0 or _key is not null"))
    if kept.filter("copies > 1").isEmpty():
        return chosen.select("row.*")
    # Repeated rows: one of each (id, class).
    nth = F.row_number().over(Window.partitionBy("_id", "_key").orderBy(F.col(f"row.{text}")))
    one = chosen.filter("copies > 1").withColumn("_nth", nth).filter("_nth = 1").select("row")
    return chosen.filter("copies is null or copies = 1").select("row").union(one).select("row.*")
