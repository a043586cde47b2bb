import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from pitstop.llm import conversations as cv

SCHEMA = "conv_id long, turn long, role string, text string"
SOUND = re.compile("(s?(ua)+)?")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Every way to edit, with up to two turns inserted anywhere."""
    fills = [[], ["user"], ["assistant"], ["user", "assistant"], ["assistant", "user"]]
    best = None
    ways = []
    for (_, _, role, text), fault in zip(rows, found):
        extra = fault == "truncated"
        way = [(3, "D", None)]
        if fault not in ("blank", "duplicate"):
            way += [(0 + extra, "K", (role, text)), (2 + extra, "R", ("user", text)), (2 + extra, "R", ("assistant", text))]
        ways.append(way)
    for edits in itertools.product(*ways):
        for gaps in itertools.product(fills, repeat=len(rows) + 1):
            cost = sum(e[0] for e in edits) + 2 * sum(map(len, gaps))
            if best is not None and cost > best[0]:
                continue
            turns, audit = [(r, "") for r in gaps[0]], "I" * len(gaps[0])
            for (_, letter, turn), gap in zip(edits, gaps[1:]):
                turns += [turn] * (turn is not None) + [(r, "") for r in gap]
                audit += letter + "I" * len(gap)
            if any(not r for r, _ in turns) or not SOUND.fullmatch("".join(r[0] for r, _ in turns)):
                continue
            if best is None or (cost, audit) < best[:2]:
                best = cost, audit, turns
    return best


def brute(rows):
    groups = defaultdict(list)
    for r in damaged(rows):
        groups[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(groups[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        found, turns = faults(mine), [r[1] for r in mine if r[1] is not None]
        cost, audit, made = cheapest(mine, found)
        signs = [r[2][:1] for r in mine]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *[found.count(k) for k in ("blank", "duplicate", "truncated")],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(signs, signs[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(), made)
    return out


def rows_of(seed, convs, most):
    rng, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        for _ in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([None, *range(6)]), rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "unser"]),
                         rng.choice(["Yes.", "Yes.", "no end", " \n", "", None, "What?", "x" * 300 + "!  ", "é…", "Good. "])))
    return rows


def got_rows(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("segment", [cv.SEGMENT, 2])
def test_repair_equals_every_way_to_edit(spark, segment):
    rows = rows_of(3, 50, 4) + [(900, 2**63 - 1, "user", "a."), (900, -2**63, "assistant", "b."), (901, 5, "system", "s.")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "cast(1 as int) as again", "'x' as audit").repartition(3)
    got, want = got_rows(cv.repair(cv.damage(df), segment)), brute(rows)
    assert set(got) == set(want)
    for conv, w in want.items():
        assert got[conv] == (w[0] if w[0] < 2**63 else None, *w[1:-1]), conv
    assert "I" in "".join(w[6] for w in want.values()) and any(not w[6] for w in want.values())
    out = defaultdict(list)
    for r in cv.repaired_rows(cv.damage(df), segment).orderBy("position").collect():
        out[r.conv_id].append((r.role, r.text))
    assert dict(out) == {c: w[-1] for c, w in want.items() if w[-1]}


def test_segments_make_no_difference(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["system", "user", "assistant", "assistant"]), rng.choice(["a.", "b", f"{t}.", f"{t}"]))
            for c in range(8) for t in range(rng.choice([1, 60, 700]))]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = got_rows(cv.repair(df, 10_000))
    assert whole == got_rows(cv.repair(df, 7)) == got_rows(cv.repair(df, 1)) and max(w[5] for w in whole.values()) > 100


def test_a_long_conversation_keeps_little():
    repair = cv.Repair(64)
    for t in range(20_000):
        repair.add(t, ("user", "assistant", "assistant")[t % 3], f"text {t}.", False)
        assert len(repair.rows) <= 64 and sum(len(a) for _, a, _ in repair.items.values()) < 1000
    assert repair.result()[5] > 0


def test_no_conversations(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cv.repair(cv.damage(empty)).collect() == [] and cv.repaired_rows(cv.damage(empty)).collect() == []
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    gone = got_rows(cv.repair(cv.damage(spark.createDataFrame([(lost, 0, "user", "a.")], SCHEMA))))
    assert gone == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
