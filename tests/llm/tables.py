"""Small tables with nulls, ties, copies, long texts and clashing names."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("size long, key string, row string, id string, n long, label string, bucket long, target double, "
         "_blk int, _key string, h long, first int, path string, host string, html_ string, digest string, k long, part int")


def prose(rng, n):
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + (". " if i % 9 == 8 else ".\n" if i % 31 == 30 else " "))
    return "".join(out).strip()


def documents(seed=1):
    """(doc_id, text, lang, source, n_chars) rows."""
    rng = random.Random(seed)
    base, passage = prose(rng, 160), prose(rng, 70)
    rows = []

    def add(i, text, source="a", lang="xx"):
        rows.append((i, text, lang, source, None if text is None else len(text)))

    for i in range(30):
        add(i, prose(rng, rng.randint(5, 220)), source=rng.choice("abc"), lang=rng.choice(["xx", "yy"]))
    for i in range(30, 36):                        # exact and near copies
        words = base.split(" ")
        if i > 31:
            words[rng.randrange(len(words))] = "changed"
        add(i, " ".join(words), source="b")
    for i in range(36, 39):                        # a shared passage
        add(i, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 30), source="c")
    add(39, None)
    add(40, "")
    add(41, " \n\t ")
    add(42, "one two three")
    add(43, "One TWO three", source=None)
    add(44, "12345 ### 999 ...")
    add(45, prose(rng, 20_000), source=None)       # very long
    add(46, "x" * 50_000)
    add(46, "x" * 50_000)                          # a repeated row
    add(46, "another text with the same id as those before it")
    add(None, "a text without an id that has some words in it")
    add(None, None, source=None, lang=None)
    add(47, "é à ü 日本語。 ok\x85no\xa0yes <|endoftext|> it's", lang="yy")
    return rows


def frame(spark, rows, clash=True):
    df = spark.createDataFrame(rows, DOCS)
    if clash:
        for c in CLASH.split(", "):
            name, kind = c.split(" ")
            df = df.selectExpr("*", f"cast(null as {kind}) as `{name}`")
    return df.repartition(3)


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
