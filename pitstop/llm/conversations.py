"""Repair of conversation structure by Knuth's lightest derivation.

A sound conversation's role initials read ``(s?(ua)+)?``.  An item (i, state)
says that the first i rows are edited and what they give leads the automaton
to that state.  A deduction joins it with one edit of the next row, or with an
inserted turn; its weight function (cost, audit) -> (cost + d, audit + letter)
is superior, and monotone: an item's audits hold one letter a row beside the
inserted ones, so of equal cost none begins another.  So the agenda finalises
an item when it pops it first, until the goal is popped.

A conversation of any length is worked off in segments of ``SEGMENT`` rows: the
few items at a segment's end are the axioms of the next one."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
SOUND = (START, ASSISTANT)
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: From any state the rest costs at most 5 more than from any other one: a
#: system turn to delete and an answer to insert.
APART = 5
SEGMENT = 512
KIND = ("", "blank", "duplicate", "truncated")


def initial(role: str) -> str:
    return role[:1]


def edits(role: str, fault: str) -> dict[str, tuple[int, str]]:
    """What a row can give (an initial, or nothing) and the lightest edit that does."""
    out = {"": (DELETE, "D")}
    if fault not in ("blank", "duplicate"):
        extra = TRUNCATED * (fault == "truncated")
        for weight, given in ((extra + REROLE, "R"), "u"), ((extra + REROLE, "R"), "a"), ((extra, "K"), initial(role)):
            if given and weight < out.get(given, (DELETE + REROLE, "")):
                out[given] = weight
    return out


def derive(axioms: dict[int, tuple[int, str]], rows: Sequence[tuple[str, str]], last: bool) -> dict[int, tuple[int, str, int]]:
    """The lightest (cost, audit, axiom) of the items behind ``rows`` (role,
    fault), by state.  ``last``: of the goal alone, the lightest sound state.
    Otherwise the items that a lightest whole derivation can still go through."""
    choices = [edits(*row) for row in rows]
    agenda = [(cost, audit, 0, state, state) for state, (cost, audit) in axioms.items()]
    heapq.heapify(agenda)
    done, found, limit = set(), {}, None
    while agenda:
        cost, audit, i, state, axiom = heapq.heappop(agenda)
        if (i, state) in done:
            continue
        if limit is not None and cost > limit:
            break
        done.add((i, state))
        if i == len(rows):
            if last and state in SOUND:
                return {state: (cost, audit, axiom)}
            if not last:
                found[state] = cost, audit, axiom
                limit = cost + APART if limit is None else limit
        else:
            for given, (more, letter) in choices[i].items():
                to = STEPS.get((state, given)) if given else state
                if to is not None and (i + 1, to) not in done:
                    heapq.heappush(agenda, (cost + more, audit + letter, i + 1, to, axiom))
        for given in ROLES:
            to = STEPS.get((state, given))
            if to is not None and (i, to) not in done:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", i, to, axiom))
    return found


def replay(state: int, audit: str, rows: Sequence[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The (role, text) that ``audit`` makes of ``rows``, from ``state`` on."""
    at = iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(at)
        if letter == "D":
            continue
        if letter != "K":
            role = ROLES["a" if state == USER else "u"]
        state = STEPS[state, initial(role)]
        yield role, text


class Repair:
    """One conversation, fed row by row in its order."""

    def __init__(self, segment: int = SEGMENT):
        self.segment, self.rows = segment, []
        self.count, self.illegal, self.role = dict.fromkeys(KIND, 0), 0, None
        self.first = self.turn = None
        self.distinct = 0
        self.audit: list[str] = []                       # what all items have in common
        self.items = {START: (0, "", hashlib.sha256())}  # state -> cost, rest of the audit, hash of what it gives

    def add(self, turn: int | None, role: str, text: str, duplicate: bool) -> None:
        body = text.rstrip(SPACE)
        fault = "blank" if not body else "duplicate" if duplicate else "truncated" if body[-1] not in ".!?" else ""
        self.count[fault] += 1
        if self.role is not None:
            self.illegal += initial(self.role) + initial(role) not in ("su", "ua", "au")
        self.role = role
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.distinct = turn, self.distinct + 1
        if len(self.rows) == self.segment:
            self.close(False)
        self.rows.append((role, text, fault))

    def close(self, last: bool) -> None:
        found = derive({s: (cost, audit) for s, (cost, audit, _) in self.items.items()},
                       [(role, fault) for role, _, fault in self.rows], last)
        items = {}
        for state, (cost, audit, axiom) in found.items():
            hashed, empty = self.items[axiom][2].copy(), axiom == START
            for role, text in replay(axiom, audit[len(self.items[axiom][1]):], [r[:2] for r in self.rows]):
                hashed.update((("" if empty else "\n") + role + ":" + text).encode())
                empty = False
            items[state] = cost, audit, hashed
        common = len(commonprefix([audit for _, audit, _ in items.values()]))
        self.audit.append(next(iter(items.values()))[1][:common])
        self.items = {s: (cost, audit[common:], hashed) for s, (cost, audit, hashed) in items.items()}
        self.rows = []

    def result(self) -> tuple:
        self.close(True)
        cost, _, hashed = next(iter(self.items.values()))
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.distinct
        return (gaps if gaps < 2**63 else None, *[self.count[k] for k in KIND[1:]], self.illegal, cost,
                "".join(self.audit), hashed.hexdigest())


SCHEMA = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def or_space(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(rows: DataFrame, columns: Sequence[str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """conv_id, turn, role, text, lost: the rows (null role and text: one
    space) with the fault that crc32 of ``conv_id:turn`` (nulls: one space)
    modulo 20 gives them.  0: the row is lost (it stays, marked, without
    text); 1: empty text; 2: without its ``.!?``; 3: twice; 4: role user."""
    conv_id, turn, role, text = columns
    fault = F.crc32(F.concat(or_space(conv_id), F.lit(":"), or_space(turn)).cast("binary")) % 20
    named = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                        or_space(role).alias("role"), or_space(text).alias("text"), fault.alias("_fault"))
    changed = (F.when(F.col("_fault").isin(0, 1), F.lit(""))
               .when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    times = F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1))
    return (named.withColumn("_time", F.explode(times))
            .select("conv_id", "turn", F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                    changed.alias("text"), (F.col("_fault") == 0).alias("lost")))


def _in_order(rows: DataFrame) -> DataFrame:
    """Every conversation whole and in order, in one task's stream; the one
    shuffle of the rows.  A repeat of (role, text) is found by sorting, so no
    task holds a conversation's texts."""
    named = rows.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"),
                        F.coalesce(F.col("lost"), F.lit(False)).alias("lost") if "lost" in rows.columns
                        else F.lit(False).alias("lost"))
    same = Window.partitionBy("conv_id", "lost", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    return (named.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
            .sortWithinPartitions("conv_id", "lost", F.col("turn").asc_nulls_first(), "role", "text", "again"))


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id and the columns of ``SCHEMA`` for every conversation of ``rows``
    (conv_id, turn, role, text, and lost if there is such a column; lost rows
    only keep their conversation in the result).

    Rows are taken by turn, null first; of equal turns by role, then text.  A
    null conv_id is a conversation; a null role or text is one space; an empty
    role has no initial, so it can only be given another or go.  A conversation
    without rows has zeros, an empty audit and the hash of nothing; an empty
    table has none.  gaps is null beyond the range of long.  Other columns are
    not read.

    The hash of a repaired conversation is one chain over its whole text, so a
    conversation stays in one task, which streams it: it holds a segment's
    rows, at most four items and the audit, whatever the length."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, out = None, None, []

        def table():
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

        schema = pa.schema([("conv_id", pa.int64()), *[(c.split(" ")[0], pa.string() if c.endswith("string") else pa.int64())
                                                       for c in SCHEMA.split(", ")]])
        for batch in batches:
            for conv, turn, role, text, lost, again in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != current:
                    if state is not None:
                        out.append((current, *state.result()))
                    current, state = conv, Repair(segment)
                if not lost:
                    state.add(turn, role, text, again)
            if len(out) >= 2000:
                yield table()
                out = []
        if state is not None:
            out.append((current, *state.result()))
        yield table()

    return _in_order(rows).mapInArrow(work, "conv_id long, " + SCHEMA)


def repaired_rows(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """conv_id, position (from 0), role, text, edit of the repaired
    conversations: every audit is dealt out, a letter a row, and meets the
    rows by their number; nulls and ties as in :func:`repair`."""
    live = rows.filter(~F.coalesce(F.col("lost"), F.lit(False))) if "lost" in rows.columns else rows
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = (live.select("conv_id", "turn", or_space("role").alias("role"), or_space("text").alias("text"))
                .withColumn("_row", F.row_number().over(order))
                .select(F.col("conv_id").alias("_conv"), "_row", F.col("role").alias("_role"), F.col("text").alias("_text")))
    letters = repair(rows, segment).select("conv_id", F.posexplode(F.split("audit", "")).alias("_at", "edit"))
    so_far = Window.partitionBy("conv_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (letters.filter("edit <> ''").withColumn("_row", F.count_if(F.col("edit") != "I").over(so_far))
              .withColumn("position", F.count_if(F.col("edit") != "D").over(so_far) - 1).filter("edit <> 'D'"))
    joined = placed.join(numbered, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("edit") != "I")
                         & (placed["_row"] == numbered["_row"]), "left")
    system = F.max(F.when(F.col("position") == 0, (F.substring("_role", 1, 1) == "s") & (F.col("edit") == "K"))).over(
        Window.partitionBy("conv_id"))
    turn = F.when((F.col("position") - system.cast("int")) % 2 == 0, "user").otherwise("assistant")
    return joined.select("conv_id", F.col("position").cast("long"),
                         F.when(F.col("edit") == "K", F.col("_role")).otherwise(turn).alias("role"),
                         F.when(F.col("edit") == "I", "").otherwise(F.col("_text")).alias("text"), "edit")
