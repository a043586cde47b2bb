"""Host-level quality rules.

Word, line and symbol figures come from vectorised passes over the bytes of
each text.  Every document is put to a few rules; the failures are summed by
host (here: the source), each host's rate is shrunk towards the mean of all
hosts with a beta prior fitted to the hosts' own spread, and the verdict on
the host is joined back to its documents."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitstop.llm.scratch import stage
from pitstop.llm.text import code_points, per_text, segment_hash, slices

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
OUTLYING = 4.0                  # standard deviations of the prior above its mean that a failing host's rate has,
MAJORITY, NEARLY_ALL = 0.5, 0.9 # but no host fails below the one rate, and every host does above the other
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _repeats(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each item, whether an equal one of the same owner comes before it,
    and whether any other is equal: two rows of flags."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    o, h = owner[order], hashes[order]
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = (o[1:] == o[:-1]) & (h[1:] == h[:-1])
    flags = np.zeros((2, len(h)), bool)
    flags[0, order] = same[:-1]
    flags[1, order] = same[:-1] | same[1:]
    return flags


def _figures(s) -> list[np.ndarray]:
    """The STATS of each text of a slice."""
    s.words()
    in_word = np.zeros(len(s.data) + 1, np.int8)
    np.add.at(in_word, s.starts, 1)
    np.add.at(in_word, s.ends, -1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)
    # Lines: each text begins one and so does what follows a \n.
    breaks = np.flatnonzero(s.data == 10)
    starts = np.sort(np.concatenate([s.offsets[:-1], breaks + 1]))
    text_of_break = np.searchsorted(s.offsets[1:], breaks, side="right")
    owner = np.sort(np.concatenate([np.arange(s.n), text_of_break]))
    ends = np.append(starts[1:], len(s.data))
    last = np.append(owner[1:] != owner[:-1], True)       # a text's last line ends with the text
    ends = np.where(last, s.offsets[owner + 1], ends - 1)
    words_before = np.searchsorted(s.starts, np.stack([starts, ends]))
    full = words_before[1] > words_before[0]
    starts, ends, owner = starts[full], ends[full], owner[full]
    dup_lines = _repeats(owner, segment_hash(s.data, starts, ends))[0]
    hashes, first = s.shingles(3)
    again = first[_repeats(s.doc[first], hashes)[1]]
    covered = np.zeros(len(s.doc) + 2, bool)
    for j in range(3):
        covered[again + j] = True
    return [s.counts, per_text(in_word & code_points(s.data), s.offsets), per_text(_IS_SYMBOL[s.data], s.offsets),
            np.bincount(owner[dup_lines], minlength=s.n), np.bincount(s.doc[covered[:len(s.doc)]], minlength=s.n)]


def text_figures(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text", "source")) -> DataFrame:
    """doc_id, source and STATS of every document; a null text counts as empty."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(2)):
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(s.first, s.n) for i in (0, 1)],
                     *[pa.array(x.astype(np.int64)) for x in _figures(s)]], ["doc_id", "source", *STATS])

    doc_id, text, source = columns
    return (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.col(text))
            .mapInArrow(measure, "doc_id long, source string, " + ", ".join(f"{c} long" for c in STATS)))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def rules() -> dict[str, Column]:
    """What a document can fail, beside the base rules: each is counted by host."""
    n = F.col("n_words")
    return {"base": base_failed(),
            "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 12 * n),
            "symbols": 10 * F.col("n_symbols") > 3 * n,
            "dup_lines": 20 * F.col("n_dup_lines") > n}


def host_rates(figures: DataFrame) -> DataFrame:
    """source, rule, n, failed, rate (shrunk), limit: one row a host and rule.

    The prior is beta(p * m, (1 - p) * m): p is the rule's failure rate over
    all documents; m follows from the spread of the hosts' rates beyond what
    chance alone gives hosts of their sizes, so hosts that differ wildly are
    hardly shrunk and hosts that differ by chance are taken for alike.  The
    limit is where the prior calls a rate outlying (OUTLYING of its standard
    deviations above p), held between MAJORITY and NEARLY_ALL: an odd host
    stays while most of its documents are sound, and one that has hardly any
    sound ones goes however much hosts differ."""
    checks = rules()
    by_host = figures.groupBy("source").agg(
        F.count("*").alias("n"), *[F.sum(check.cast("long")).alias(rule) for rule, check in checks.items()])
    long = by_host.select("source", "n", F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("failed")) for rule in checks])).alias("_f")
    ).select("source", "n", "_f.*")
    # sum n (r - p)^2 = sum f^2 / n - p^2 sum n, so one pass gives all moments.
    moments = long.groupBy("rule").agg(F.sum("n").alias("_n"), F.sum("failed").alias("_f"), F.count("*").alias("_hosts"),
                                       F.sum(F.col("failed") * F.col("failed") / F.col("n")).alias("_ff"))
    p = F.col("_f") / F.col("_n")
    spread = F.greatest(F.col("_ff") / F.col("_n") - p * p - p * (1 - p) * F.col("_hosts") / F.col("_n"), F.lit(1e-12))
    priors = moments.select("rule", p.alias("_p"), F.greatest(F.lit(0.0), p * (1 - p) / spread - 1).alias("_m"))   # a row a rule
    outlying = F.col("_p") + OUTLYING * F.sqrt(F.col("_p") * (1 - F.col("_p")) / (F.col("_m") + 1))
    limit = F.least(F.lit(NEARLY_ALL), F.greatest(F.lit(MAJORITY), outlying))
    return long.join(F.broadcast(priors), "rule").select(
        "source", "rule", "n", "failed",
        ((F.col("failed") + F.col("_p") * F.col("_m")) / (F.col("n") + F.col("_m"))).alias("rate"), limit.alias("limit"))


def judge(docs: DataFrame, columns: Sequence[str] = ("doc_id", "text", "source")) -> DataFrame:
    """doc_id, STATS, base_failed, kept, host_failed for every document.

    A host fails if the shrunk rate of any rule is above its limit; its
    documents are not kept, nor are those that fail a base rule.  A null
    source is a host; a null or empty text has no words and fails; rows with
    equal ids are judged each for itself; no rows give no rows.  Only failed
    hosts are joined back, so sound ones, however large, meet in no key."""
    figures = stage(text_figures(docs, columns), "quality-figures")
    failed = (host_rates(figures).filter("rate > limit").select(F.col("source").alias("_host"), F.lit(True).alias("_failed")).distinct())
    return (figures.join(failed, F.col("source").eqNullSafe(F.col("_host")), "left")
            .withColumn("host_failed", F.coalesce("_failed", F.lit(False)))
            .select("doc_id", *STATS, base_failed().alias("base_failed"),
                    (~base_failed() & ~F.col("host_failed")).alias("kept"), "host_failed"))
