"""Main text of web pages by consensus host paths.

Every page is walked once and its containers are scored by the text they hold
outside of menus, notices and the like.  The page votes for its best container,
as a path of tags and classes with the digits taken out; Spark counts the votes
by host, and the texts are taken from the host's winning path.

A page takes time and memory in proportion to its length, however deep its
elements lie: a container is known by a hash of its parent's and its own name,
and sums over containers are handed up from child to parent."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitstop.llm.scratch import stage

HEAVY = 1000          # hosts with more than this part of all pages, fewer than so many, are told apart from the others

# Names of HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes", "noembed"}
DROPPED = {"head", "nav", "footer", "aside", "form", "svg", "template", "select", "button", "menu", "dialog",
           "object", "canvas", "audio", "video"} | RAW
VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "area", "base", "col", "embed", "param", "source", "track"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
          "ruby", "rb", "rt", "rp", "nobr", "wbr", "picture", "img", "label", "math", "map"}
LEAF = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "pre", "figcaption", "caption", "summary", "address"}
CELLS = {"td", "th", "li"}      # of the leaves, those that can hold a whole part of a page
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SEMANTIC = {"article", "main"}
NEVER_NAMED = SEMANTIC | {"html", "body"}      # whatever their class, id and role
# Words in class, id and role that name what is not the article,
# words that may stand beside them, and those of adverts.
BOILERPLATE = frozenset("""
ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner banners breadcrumb breadcrumbs
captcha comment comments commentlist complementary consent contentinfo cookie cookies dialog discussion disqus donate
footer gdpr hidden login masthead menu menus modal nav navbar navigation newsletter notice notices notification
pager pagination paywall popup promo promos promotion recommended recommendations related replies reply respond
search share sharing sidebar sidebars signin signup skip social sponsor sponsored sponsors subscribe subscription
tagcloud teaser toolbar topbar tracking widget widgets""".split())
BESIDE = frozenset("area bar block bottom box container inner left list outer right section site top wrap wrapper".split())
ADVERTS = frozenset("ad ads adv advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors".split())
LANDMARKS = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())

_TAG = re.compile(r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|/?[a-zA-Z][^>]*+(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?=[\s=]|\Z)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_WORDS = re.compile(r"[a-z]+")
_PARTS = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


def path_key(path: str) -> bytes:
    """The key that :class:`Page` gives a container of this path."""
    key = b""
    for name in path.split(">"):
        key = _child(key, name)
    return key


def _child(parent: bytes, name: str) -> bytes:
    return blake2b(parent + name.encode(), digest_size=12).digest()


class Page:
    """Containers (name, parent, key of the path, whether in article or main)
    and blocks (container, text, characters in links) of a page, in its order."""

    def __init__(self, html: str):
        self.names, self.parents, self.keys = ["#"], [-1], [_child(b"", "#")]
        self.mains, self.inside, self.named = [], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []
        self.walk(html)
        self.drop_named()

    def walk(self, html: str) -> None:
        stack = [("#", 0, False, False)]        # tag, container, dropped, headings alone are kept
        open_tags: Counter = Counter()
        text, links, linked, at, heading = [], 0, False, 0, False

        def flush():
            nonlocal text, links
            if text:
                block = " ".join("".join(text).split())
                if block:
                    self.blocks.append((stack[-1][1], block, min(links, len(block))))
                text, links = [], 0

        def add(raw):
            nonlocal links
            _, _, dropped, only_headings = stack[-1]
            if raw and not dropped and (heading or not only_headings):
                words = unescape(raw)
                text.append(words)
                if linked:
                    links += len(words)

        def close():
            open_tags[stack.pop()[0]] -= 1

        while True:
            m = _TAG.search(html, at)
            if m is None:
                add(html[at:])
                break
            add(html[at:m.start()])
            at = m.end()
            name = m[2]
            if name is None:
                continue
            tag = name.lower()
            if m[1]:
                if tag == "a":
                    linked = False
                elif tag not in INLINE or any(x[0] == tag for x in stack[-3:]):
                    flush()
                    if tag in HEADINGS:
                        heading = False
                    if open_tags[tag]:
                        while stack[-1][0] != tag:
                            close()
                        close()
                continue
            attributes = m[3]
            classes, gone, named, advert = self._names(attributes) if attributes and not attributes.isspace() else ((), False, False, False)
            if tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
                continue
            if tag == "br":
                add(" ")
            if tag in VOID:
                if tag == "hr":
                    flush()
                continue
            if tag == "a":
                linked = True
            inline = tag in INLINE
            drop = tag in DROPPED or gone or advert and (inline or tag in LEAF)
            if inline and not drop:
                continue
            if not inline:
                flush()
                # A block closes an open p; a list item, row or cell closes the one before it.
                while len(stack) > 1 and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in LEAF):
                    close()
                if tag == "body":
                    while len(stack) > 1 + (len(stack) > 1 and stack[1][0] == "html"):
                        close()
                heading = tag in HEADINGS or heading and tag in INLINE
            _, container, dropped, only_headings = stack[-1]
            inside = self.inside[container]
            if tag == "header" or "header" in classes or "head" in classes:
                drop, only_headings = drop or not inside, True
            if tag in LEAF and not drop and not (named and tag in CELLS):
                continue
            if not drop and not inline:
                # Names do not speak against the page itself, articles, or sections of one.
                named = named and tag not in NEVER_NAMED and not (inside and tag == "section")
                full = tag + "".join(f".{c}" for c in sorted(set(classes)))
                self.names.append(full)
                self.parents.append(container)
                self.keys.append(_child(self.keys[container], full))
                self.inside.append(inside or tag in SEMANTIC)
                self.named.append(named)
                container = len(self.names) - 1
                if tag == "main":
                    self.mains.append(container)
            stack.append((tag, container, dropped or drop, only_headings))
            open_tags[tag] += 1
        flush()

    def drop_named(self) -> None:
        """Drops the blocks in containers whose names are not the article's,
        if any are left then."""
        if any(self.named):
            gone = self.named[:]
            for c in range(1, len(gone)):               # parents come before their children
                gone[c] = gone[c] or gone[self.parents[c]]
            self.blocks = [b for b in self.blocks if not gone[b[0]]] or self.blocks

    @staticmethod
    def _names(attributes: str) -> tuple[list[str], bool, bool, bool]:
        """Class names without digits; whether the element is hidden; whether a
        whole name of it is not the article's, or an advert's."""
        classes, gone, named, advert = [], False, False, False
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                gone = True
            elif key == "style":
                gone |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
            elif key == "role":
                named |= value.strip().lower() in LANDMARKS
            elif key in ("class", "id"):
                for name in value.split():
                    parts = {x.lower() for x in _PARTS.split(name)} - {""}
                    if parts & BOILERPLATE and parts <= BOILERPLATE | BESIDE:
                        named = True
                        advert |= bool(parts & ADVERTS)
                    if key == "class":
                        classes.append("-".join(_WORDS.findall(name.lower())))
        return [c for c in classes if c], gone, named, advert

    def scores(self) -> list[int]:
        """The characters of text outside of links that each container holds."""
        score = [0] * len(self.names)
        for container, block, links in self.blocks:
            score[container] += max(0, len(block) - 2 * links)
        for c in range(len(score) - 1, 0, -1):          # children come after their parents
            score[self.parents[c]] += score[c]
        return score

    def path(self, container: int) -> str:
        names = []
        while container >= 0:
            names.append(self.names[container])
            container = self.parents[container]
        return ">".join(reversed(names))

    def best(self) -> tuple[str, int] | None:
        """The path of the container that stands for the page, and its score:
        main, if there is one with text; else the deepest container that holds
        all the text there is outside of links, but none inside of an article."""
        score = self.scores()
        if not score[0]:
            return None
        at = max((c for c in self.mains if score[c]), key=lambda c: score[c], default=0)
        if not at:
            for c in range(1, len(score)):              # parents come before their children
                if self.parents[c] == at and score[c] == score[0] and not self.inside[at]:
                    at = c
        return self.path(at), score[at]

    def text(self, path: str | None) -> str | None:
        """The blocks inside the containers of that path; None if there are none."""
        if path is None:
            return None
        key = path_key(path)
        inside = [k == key for k in self.keys]
        for c in range(1, len(inside)):
            inside[c] = inside[c] or inside[self.parents[c]]
        return "\n".join(block for c, block, _ in self.blocks if inside[c]) if any(inside) else None


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes): the path most pages of a host vote for, of equals
    that with the higher score, then the smaller path, and the votes that the
    host has in all.  ``pages`` has host and html."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [Page(h.as_py()).best() for h in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b and b[0] for b in best], pa.string()), pa.array([b and b[1] for b in best], pa.int64())],
                ["host", "path", "score"])

    votes = (pages.select("host", "html").mapInArrow(vote, "host string, path string, score long").filter("path is not null")
             .groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score")))
    return (votes.groupBy("host").agg(F.min(F.struct(-F.col("n"), -F.col("score"), "path")).alias("w"), F.sum("n").alias("votes"))
            .select("host", "w.path", "votes"))


def extract(pages: DataFrame, columns: Sequence[str] = ("page_id", "url", "html")) -> DataFrame:
    """page_id, url, text, n_chars, path for every page.

    The text is taken from the containers with the host's winning path; a page
    that has none gives its own best container.  A null html, and one without
    text outside of what is dropped, gives an empty text.  A null or odd url
    has the host ''.  Rows with equal ids are pages of their own."""
    page_id, url, html = columns
    host = F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("HOST")), F.lit("")))
    row = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                       F.coalesce(F.col(html), F.lit("")).alias("html"), host.alias("host"))
    winners = stage(host_paths(row), "html-paths")
    # A host with more than a thousandth of the votes is one of fewer than a thousand: those travel to the
    # pages.  Every other host has few enough pages for a join; a heavy one's pages are dealt out meanwhile.
    total = winners.agg(F.sum("votes")).first()[0] or 0
    heavy = F.broadcast(winners.filter(F.col("votes") * HEAVY > total).select(F.col("host").alias("_heavy"), F.col("path").alias("_path")))
    light = winners.filter(F.col("votes") * HEAVY <= total).select(F.col("host").alias("_light"), F.col("path").alias("_other"))
    apart = F.concat(F.lit("/"), F.xxhash64("page_id", "url", "html").cast("string"))       # no host has a /
    told = (row.join(heavy, F.col("host") == F.col("_heavy"), "left")
            .withColumn("_by", F.when(F.col("_heavy").isNull(), F.col("host")).otherwise(apart))
            .join(light, F.col("_by") == F.col("_light"), "left").withColumn("path", F.coalesce("_path", "_other")))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths = [], []
            for body, path in zip(batch.column(2), batch.column(3).to_pylist()):
                page = Page(body.as_py())
                text = page.text(path)
                if not text:
                    own = page.best()
                    path = own and own[0]
                    text = page.text(path) or ""
                texts.append(text)
                paths.append(path)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array(paths, pa.string())], ["page_id", "url", "text", "n_chars", "path"])

    return told.select("page_id", "url", "html", "path").mapInArrow(
        take, "page_id long, url string, text string, n_chars long, path string")
