"""Mixing sources to target weights.

Every document gets a hash-random key.  Each source is sorted by it in ranges
of the key, distributed prefix sums of the word counts run over the ranges,
and the source is cut exactly at its budget, after as many whole epochs as
the budget holds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitstop.llm.scratch import numbered_copies, running_sums, stage
from pitstop.llm.text import WORD

ROWS_PER_RANGE = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                   max_epochs: float = 2) -> DataFrame:
    """``totals`` (source, source_size) with weight and target.

    Sources in code point order, null last, take ``weights`` in turn; they
    share ``share`` of all words by weight.  A target stops at ``max_epochs``
    times its source's size and the excess is shared anew by weight among the
    others until none is above (water filling: in the order of cap / weight,
    the level before a source decides it and all that follow)."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("_nth") % len(weights) + 1).cast("int"))
    numbered = running_sums(totals.withColumn("_one", F.lit(1)),
                            [F.col("source").asc_nulls_last()], {"_nth": "_one"}, "mix-sources")
    cap = F.col("source_size") * float(max_epochs)
    capped = numbered.select("source", "source_size", w.alias("weight"), cap.alias("_cap"), (cap / w).alias("_ratio"))
    filled = running_sums(capped, [F.col("_ratio"), F.col("source").asc_nulls_last()],
                          {"_caps": "_cap", "_weights": "weight"}, "mix-levels")
    weight, words = capped.agg(F.sum("weight"), F.sum("source_size")).first()
    levels = filled.withColumn("_level", (F.lit((words or 0) * float(share)) - F.col("_caps"))
                               / (F.lit(weight or 0.0) - F.col("_weights")))
    level = (levels.filter(F.col("_ratio") > F.col("_level"))
             .agg(F.min_by("_level", F.struct("_ratio", F.col("source").isNull(), "source"))).first()[0])
    return levels.select("source", "source_size", "weight",
                         F.when(F.col("_ratio") > F.col("_level"), F.col("weight") * F.lit(level))
                         .otherwise(F.col("_cap")).alias("target"))


def planned(docs: DataFrame, weights: Sequence[float], share: float, max_epochs: int, seed: int,
            columns: Sequence[str]) -> DataFrame:
    """doc_id, source, size, n, source_size, target, epochs, left of every group
    of rows with one id, source and size, ``n`` of them: each is taken
    ``epochs`` times whole, and the words ``left`` go to them one after another.

    Groups are pre-aggregated, so rows with equal or null ids do not gather in
    a window."""
    doc_id, text, source = columns
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    groups = stage(narrow.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n")).withColumn("_key", key), "mix-sizes")
    words = F.col("size") * F.col("n")
    totals = groups.groupBy("source").agg(F.sum(words).alias("source_size"), F.count("*").alias("_n"))
    rows = totals.agg(F.max("_n")).first()[0] or 0
    digits = max(2, math.ceil(math.log(max(1, rows / ROWS_PER_RANGE), 16)))   # 256 ranges at least
    targets = source_targets(totals.select("source", "source_size"), weights, share, max_epochs)
    ranged = groups.withColumn("_range", F.substring("_key", 1, digits))
    parts = ranged.groupBy("source", "_range").agg(F.sum(words).alias("_part"))
    earlier = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    heads = (parts.withColumn("_off", F.coalesce(F.sum("_part").over(earlier), F.lit(0)))
             .join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
             .select(F.col("source").alias("_source"), F.col("_range").alias("_r"), "_off", "source_size", "target",
                     epochs.alias("epochs"), (budget - epochs * F.col("source_size")).alias("_rest")))
    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumn("_in", F.coalesce(F.sum(words).over(inside), F.lit(0)))
              .join(heads, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r"))))
    return placed.select("doc_id", "source", "size", "n", "source_size", "target", "epochs",
                         (F.col("_rest") - F.col("_off") - F.col("_in")).alias("left"))


def _partial(number: Column) -> Column:
    """Words that the row of this number in its group takes of ``left``."""
    return F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - number * F.col("size")))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2,
        seed: int = 17, columns: Sequence[str] = ("doc_id", "text", "source")) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for every document.

    ``columns`` names the id, text and source columns; others are ignored, so
    they may have any name.  taken: the words the mix takes, whole epochs
    first, then the documents before the cut in key order; the document on the
    cut gives the words up to it, so a source's taken words are its target
    rounded down.  A null text has size 0 and gives nothing; a null source is
    a source; rows with equal id and text are taken like different documents.
    An empty table gives an empty result."""
    plan = planned(docs, weights, share, max_epochs, seed, columns)
    taken = (F.col("epochs") * F.col("size") + _partial(F.col("_number"))).cast("long").alias("taken")
    return numbered_copies(plan, "n", "_number").select("doc_id", "size", "source_size", "target", taken, "source")


def mixed_rows(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_epochs: int = 2,
               seed: int = 17) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a document comes once for
    each epoch that takes it whole, and once more with its first words if the
    cut goes through it.  A document without words has nothing to take and
    goes.  Needs doc_id, text, source and n_chars; a null doc_id is an id, a
    null source a source, extra columns may have any name.  Rows with equal
    id, source and size are taken one after another, so a source gives its
    target exactly; an empty table gives no rows.

    Rows of a group are alike to the mix but where the cut goes through it:
    only those few groups are counted by their whole rows and numbered."""
    plan = stage(planned(docs.select("doc_id", "text", "source"), weights, share, max_epochs, seed, ("doc_id", "text", "source"))
                 .withColumn("cut", (F.col("left") > 0) & (F.col("left") < F.col("size") * F.col("n")) & (F.col("n") > 1))
                 .select(F.col("doc_id").alias("_id"), F.col("source").alias("_src"), "size", "epochs", "left", "cut"), "mix-plan")
    row = docs.select(F.struct("*").alias("row"), word_count(F.col("text")).alias("_size"))
    joined = row.join(plan, F.col("row.doc_id").eqNullSafe(F.col("_id")) & F.col("row.source").eqNullSafe(F.col("_src"))
                      & (F.col("_size") == F.col("size"))).filter("size > 0")
    first = F.lit(0).cast("long")
    taking = ["row", "epochs", F.least(F.col("size"), _partial(first)).alias("words"), "size"]
    chosen = joined.filter("not cut").select(*taking)
    if not plan.filter("cut").isEmpty():                     # at most one group a source
        kinds = joined.filter("cut").groupBy("row", "epochs", "left", "size").agg(F.count("*").alias("_n"))
        before = Window.partitionBy("row.doc_id", "row.source", "size").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
        numbered = numbered_copies(kinds.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0))), "_n", "_number")
        chosen = chosen.unionByName(numbered.select("row", "epochs", _partial(F.col("_from") + F.col("_number")).alias("words"), "size"))
    whole = (F.col("epochs") + (F.col("words") == F.col("size")).cast("int")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(None).cast("int"), whole),
                      F.when((F.col("words") > 0) & (F.col("words") < F.col("size")), F.array(F.col("words").cast("int")))
                      .otherwise(F.array().cast("array<int>")))
    each = chosen.select("row", F.explode(copies).alias("_left"))
    words = F.split(F.col("row.text"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.when(F.col("_left").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.slice(words, 1, F.col("_left")), ""))
    out = {"text": cut, "n_chars": F.when(F.col("_left").isNull(), F.col("row.n_chars")).otherwise(F.length(cut))}
    return each.select(*[out.get(c, F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
