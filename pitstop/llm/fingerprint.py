"""Document fingerprints by one-permutation MinHash, with DataFrame functions.

Word 5-shingles are hashed once; a hash's high bits choose one of BINS bins
and the bin keeps its smallest.  An empty bin takes the value of another by
optimal densification: a random sequence of bins, its own for every bin and
the same for all texts, until one is not empty.  The low BITS bits of each bin
are packed into a string of hex digits; as unequal values agree in them by
chance once in 2^BITS, likeness corrects for that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitstop.llm.scratch import ordered_blocks, stage

BINS, BITS, SHINGLE = 256, 4, 5
PROBES = 8                    # bins that densification tries one by one; after them the ranks of all are compared
_SHIFT = 63 - (BINS - 1).bit_length()
_NONE = (1 << _SHIFT) - 1     # low part of the value of an empty bin
FIRST = -2**63                # place of a null id: before all others

def fingerprint(text: Column) -> Column:
    """BINS hex digits; '' for a text without a word (or null).  A text of
    fewer than SHINGLE words has its whole sequence for a shingle."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def let(value: Column, body) -> Column:          # binds a value that is used more than once
        return F.get(F.transform(F.array(value), body), F.lit(0))

    def hashes(w: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE),
                           lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
        return F.when(F.size(w) >= SHINGLE, runs).when(F.size(w) > 0, F.array(F.xxhash64(F.lit(-1), w)))

    # The greatest value of every bin marks the empty ones; after sorting, the first of each bin is its value.
    ends = F.expr("transform(sequence(0L, %dL), j -> shiftleft(j, %d) | %dL)" % (BINS - 1, _SHIFT, _NONE))
    ordered = F.sort_array(F.concat(F.transform(let(words, hashes), lambda h: F.shiftrightunsigned(h, 1)), ends))

    def of(x: Column) -> Column:
        return F.shiftright(x, _SHIFT)

    def full(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_NONE)) != _NONE

    def minima(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (of(x) != of(F.get(s, i - 1))))

    def densified(d: Column) -> Column:
        def filled(some: Column) -> Column:
            def value(x: Column, j: Column) -> Column:
                tries = [let(F.get(d, F.pmod(F.xxhash64(F.lit(t), j), F.lit(BINS)).cast("int")), lambda y: F.when(full(y), y))
                         for t in range(PROBES)]
                ranked = F.array_min(F.transform(some, lambda y: F.struct(F.xxhash64(j, of(y)).alias("rank"), y.alias("y"))))
                return F.when(full(x), x).otherwise(F.coalesce(*tries, ranked["y"]))
            return F.transform(d, value)
        return let(F.filter(d, full), filled)

    digits = F.transform(let(let(ordered, minima), densified),
                         lambda x: F.substring(F.lit("0123456789abcdef"), (x.bitwiseAND(F.lit(2**BITS - 1)) + 1).cast("int"), F.lit(1)))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1; equal ones
    have 1, a text without words 0 with all others."""
    def packed(x: Column, g: Column) -> Column:
        return F.conv(F.substring(x, g * 16 + 1, F.lit(16)), 16, -10).cast("long")

    def differing(g: Column) -> Column:
        x = packed(a, g).bitwiseXOR(packed(b, g))
        pairs = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(pairs.bitwiseOR(F.shiftrightunsigned(pairs, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    unlike = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(BINS // 16 - 1)), differing), F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    estimate = ((F.lit(BINS) - unlike) / float(BINS) - chance) / (1 - chance)
    return (F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0)
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), estimate))))


def neighbours(docs: DataFrame) -> DataFrame:
    """(k, prev_k, prev_n) for every id of ``docs`` (k, n): the id before it,
    the last one's for the first, and its largest n.  Ids are ordered in range
    blocks; only a block's ends meet those of the next."""
    ids = docs.groupBy("k").agg(F.max("n").alias("n"))
    blocked = ordered_blocks(ids, ["k"], "fingerprint-order")
    lasts = blocked.groupBy("_blk").agg(F.max(F.struct("k", "n")).alias("last"))      # a row a partition
    whole = Window.orderBy("_blk")
    before = F.coalesce(F.lag("last").over(whole), F.last("last").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    edges = lasts.select("_blk", before.alias("_edge"))
    inside = Window.partitionBy("_blk").orderBy("k")
    own = F.lag(F.struct("k", "n")).over(inside)
    joined = blocked.withColumn("_own", own).join(F.broadcast(edges), "_blk")
    prev = F.coalesce("_own", "_edge")
    return joined.select("k", prev["k"].alias("prev_k"), prev["n"].alias("prev_n"))


def fingerprints(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text")) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next for every document.

    The edited text has its last quarter replaced by as many code points (or
    all) from the start of the document with the next larger id, the last
    one's by the first's; of rows with one id, that with the smallest text
    hash is the next document.  A null text counts as empty, a null id comes
    before all others; a single document is next to itself.  No rows give no
    rows; other columns may have any name."""
    doc_id, text = columns
    body = F.coalesce(F.col(text), F.lit(""))
    plain = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(FIRST)).alias("k"), body.alias("text"))
    order = neighbours(plain.select("k", F.length("text").cast("long").alias("n")))
    # The print of every text is made once; from here on (k, hash of the text) stands for it.
    named = plain.withColumn("h", F.xxhash64("text"))
    prints = stage(named.select("k", "h", fingerprint(F.col("text")).alias("fingerprint")), "fingerprint-prints").distinct()
    placed = named.join(order, "k")
    # Each document sends its start, as long as the one before may need, there.
    starts = (placed.select(F.col("prev_k").alias("_k"), F.struct(
                  "h", F.substring(F.col("text"), F.lit(1), F.floor(F.col("prev_n") / 4).cast("int")).alias("start"), "k").alias("s"))
              .groupBy("_k").agg(F.min("s").alias("next")))
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next.start"), F.lit(1), cut))
    joined = (placed.drop("prev_k", "prev_n").join(starts, F.col("k") == F.col("_k"))
              .select("k", "h", n.cast("long").alias("n_chars"), edited.alias("edited"), F.col("next.k").alias("_nk"), F.col("next.h").alias("_nh")))
    narrow = joined.select("k", "h", "n_chars", "_nk", "_nh", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
                           fingerprint(F.col("edited")).alias("edited_fingerprint"))
    both = (narrow.join(prints, ["k", "h"])
            .join(prints.select(F.col("k").alias("_nk"), F.col("h").alias("_nh"), F.col("fingerprint").alias("_next")), ["_nk", "_nh"]))
    return both.select(F.nullif(F.col("k"), F.lit(FIRST)).alias("doc_id"), "n_chars", "edited_sha256", "fingerprint",
                       "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"))
