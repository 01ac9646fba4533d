"""Main text of web pages, by container paths that a host's pages agree on.

A page is read tag by tag into blocks of text, each in its nearest container (body,
div, section, article, ...). What lies in menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts and styles, by tag, role or class name, is left out.

1. Every page scores its containers: a block counts fully for its container, and 0.8
   times as much for each container further out; text in links doesn't count; article
   and main elements and content-like classes weigh more.
2. Every page votes for the paths of its best containers. A path is the tags and
   classes from the root, digits generalised to ``#``. Spark adds the votes up by host
   and path and takes each host's best path.
3. Every page is read again, and the text of the containers on its host's path is
   taken. Pages without such a container (or with nothing in it) use their own best.

Votes are added up within a task first, so a host with a third of all pages sends few
rows. Host paths are joined to pages on (host, salt): Spark broadcasts them while they
are small; where it has to shuffle, a hot host is dealt over ``SALTS`` tasks' keys.

White space of a block becomes one space, blocks are trimmed and joined by a space.

Defined results: a null or empty page has the empty text; so has a page with nothing
but left-out parts (read once more without class names before that is decided). A
null or unusual url belongs to the host ''. Rows with one page_id are pages of their
own. Whole pages are read, however long. An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from shoplens.llm.tables import prepare, written

# Element names and words of class names.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "svg", "math", "object", "select"}
LEFT_OUT = {"nav", "header", "footer", "aside", "form", "button", "menu", "dialog", "head", "fieldset", "label", "datalist"}
LEFT_OUT_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog",
                  "form", "menu", "menubar", "toolbar"}
LEFT_OUT_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "banners", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "menus", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup", "promo", "related", "replies",
    "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar",
    "widget", "widgets",
}
NEGATING = {"no", "with", "has", "without"}
CONTAINERS = {"body", "div", "section", "article", "main", "td", "center", "details"}
BLOCKS = CONTAINERS | {
    "address", "blockquote", "caption", "dd", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html",
    "li", "ol", "p", "pre", "summary", "table", "tbody", "tfoot", "th", "thead", "tr", "ul",
}
EMPTY = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
# what an opening tag closes, up to the given elements
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
CONTENT_WORDS = {"article", "body", "content", "entry", "main", "post", "story", "text"}

OUTWARDS = 0.8
WEIGHT = {"article": 2.0, "main": 1.6, "body": 0.4}
CONTENT_WEIGHT = 1.3
VOTES = 3
SALTS = 16
# containers nested deeper belong to the one around them (a path grows with its depth)
MAX_DEPTH = 200

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*>)""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_DIGITS = re.compile(r"\d+")


def _attributes(text: str) -> dict[str, str]:
    if len(text) < 4:
        return {}
    # the value of another attribute may hold one of the names: its quotes come first
    plain = re.sub(r"""\b(?!class\b|id\b|role\b|aria-hidden\b)([a-zA-Z_:][-\w:.]*)\s*=\s*("[^"]*"|'[^']*')""", " ", text, flags=re.I)
    return {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(plain)}


def _left_out_name(name: str) -> bool:
    words = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    return bool(words) and words[0] not in NEGATING and (words[0] in LEFT_OUT_WORDS or words[-1] in LEFT_OUT_WORDS)


class Page:
    """Blocks of text by container. ``containers``: (parent, path, weight) in page order;
    ``blocks``: (container, text, characters outside links)."""

    def __init__(self, source: str, by_name: bool = True):
        self.containers = [(-1, "", WEIGHT["body"])]
        self._depth = [0]
        self.blocks: list[tuple[int, str, int]] = []
        self._by_name = by_name
        self._last_end: dict[str, int] = {}
        self._read(source)

    def _is_left_out(self, tag: str, attributes: dict[str, str], source: str, at: int) -> bool:
        if tag in LEFT_OUT:
            if tag not in self._last_end:
                self._last_end[tag] = source.rfind(f"</{tag}")
            return at < self._last_end[tag]  # one that is never closed can't take the rest of the page
        if tag in ("html", "body", "main") or not attributes:
            return False
        if "hidden" in attributes or attributes.get("aria-hidden") == "true":
            return True
        if attributes.get("role", "").lower() in LEFT_OUT_ROLES:
            return True
        return self._by_name and any(_left_out_name(n) for n in f"{attributes.get('class', '')} {attributes.get('id', '')}".split())

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, bool]] = []  # tag, container before it, in a left-out part before it
        opened: Counter = Counter()  # of the tags in the stack
        here, out, linked = 0, False, False
        pieces: list[str] = []
        outside = 0

        def flush():
            nonlocal outside
            text = " ".join("".join(pieces).split())
            if text:
                self.blocks.append((here, text, outside))
            pieces.clear()
            outside = 0

        def text_until(end):
            nonlocal outside
            if end > at and not out:
                text = source[at:end]
                if "&" in text:
                    text = entities.unescape(text)
                pieces.append(text)
                if not linked:
                    outside += len(text)

        def close(depth):
            """Close the open elements from ``depth`` on."""
            nonlocal here, out, linked
            flush()
            linked = False
            _, here, out = stack[depth]
            opened.subtract(tag for tag, _, _ in stack[depth:])
            del stack[depth:]

        def push(tag):
            stack.append((tag, here, out))
            opened[tag] += 1

        at, length = 0, len(source)
        while at < length:
            m = _TAG.search(source, at)
            if m is None:
                text_until(length)
                break
            text_until(m.start())
            at = m.end()
            if m[2] is None:
                continue
            ending, tag = m[1], m[2].lower()
            if ending:
                if tag == "a":
                    linked = False
                elif opened[tag] > 0:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
                elif tag in BLOCKS and not out:
                    flush()
                continue
            if tag in RAW:
                end = re.compile(f"</{re.escape(tag)}\\b[^>]*>", re.I).search(source, at)
                at = end.end() if end else length
                continue
            if tag == "br":
                if not out:
                    pieces.append(" ")
                continue
            if tag == "a":
                linked = True
                continue
            block = tag in BLOCKS
            inline = not block and tag not in LEFT_OUT
            if inline and out and tag not in EMPTY:
                push(tag)
            if inline and (out or len(m[3]) < 6):
                continue  # nothing that could leave it out
            attributes = _attributes(m[3])
            left = not out and self._is_left_out(tag, attributes, source, at)
            if inline and not left:
                continue
            if tag in EMPTY:
                if block:
                    flush()
                continue
            # a block closes an open paragraph, an item the one before it
            closed, until = CLOSES.get(tag, ({"p"}, CONTAINERS))
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in closed:
                    close(depth)
                    break
                if stack[depth][0] in until or stack[depth][0] in CONTAINERS:
                    break
            flush()
            linked = False
            push(tag)
            if left:
                out = True
            elif not out and tag in CONTAINERS and self._depth[here] < MAX_DEPTH:
                self._open(tag, attributes, here)
                here = len(self.containers) - 1
        flush()

    def _open(self, tag: str, attributes: dict[str, str], parent: int) -> None:
        classes = sorted({_DIGITS.sub("#", c) for c in attributes.get("class", "").lower().split()})
        weight = WEIGHT.get(tag, 1.0)
        if weight == 1.0 and CONTENT_WORDS.intersection(re.split(r"[^a-z]+", " ".join([*classes, attributes.get("id", "").lower()]))):
            weight = CONTENT_WEIGHT
        self.containers.append((parent, ".".join([f"{self.containers[parent][1]}/{tag}", *classes]), weight))
        self._depth.append(self._depth[parent] + 1)

    def scores(self) -> dict[str, float]:
        """Score of every path: text outside links, inner containers' counting less."""
        own = [0.0] * len(self.containers)
        for container, _, outside in self.blocks:
            own[container] += outside
        for i in range(len(own) - 1, 0, -1):  # children come after their parents
            own[self.containers[i][0]] += OUTWARDS * own[i]
        found: Counter = Counter()
        for (_, path, weight), score in zip(self.containers, own):
            found[path] += weight * score
        return found

    def best(self) -> list[tuple[str, float]]:
        return sorted(self.scores().items(), key=lambda x: (-x[1], x[0]))[:VOTES]

    def text(self, path: str | None) -> str | None:
        """Text of the containers on ``path``, those inside them included; None without one."""
        inside, found = [], False
        for parent, own, _ in self.containers:
            inside.append(own == path or (parent >= 0 and inside[parent]))
            found = found or own == path
        return " ".join(text for container, text, _ in self.blocks if inside[container]) if found else None


def _read(source: str | None) -> Page:
    page = Page(source or "")
    return page if page.blocks else Page(source or "", by_name=False)


def main_text(source: str | None, path: str | None = None) -> tuple[str, bool]:
    """The text on ``path``, or of the page's best container; and whether it is the former."""
    page = _read(source)
    text = page.text(path) if path is not None else None
    if text:
        return text, True
    best = page.best()
    return (page.text(best[0][0]) or "" if best else ""), False


def _vote_batches(batches):
    votes: Counter = Counter()
    for b in batches:
        for host, source in zip(b.column("host").to_pylist(), b.column("html")):
            best = _read(source.as_py()).best()
            total = sum(score for _, score in best)
            for path, score in best:
                if score > 0:
                    votes[host, path] += int(1000 * score / total)
    if votes:
        hosts, paths = zip(*votes)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                          pa.array(list(votes.values()), pa.int64())], names=["host", "path", "votes"])


def _with_host(pages: DataFrame) -> DataFrame:
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return pages.select("page_id", "url", "html", F.lower(host).alias("host"))


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes): the container path that each host's pages vote for."""
    prepare(pages.sparkSession)
    votes = (_with_host(pages).select("host", "html").mapInArrow(_vote_batches, "host string, path string, votes bigint")
             .groupBy("host", "path").agg(F.sum("votes").alias("votes")))
    first = F.min(F.struct((-F.col("votes")).alias("minus"), "path")).alias("first")
    return votes.groupBy("host").agg(first).select("host", "first.path", (-F.col("first.minus")).alias("votes"))


def _extract_batches(batches):
    for b in batches:
        texts, by_host = [], []
        for source, path in zip(b.column("html"), b.column("path")):
            text, agreed = main_text(source.as_py(), path.as_py())
            texts.append(text)
            by_host.append(agreed)
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64()), pa.array(by_host, pa.bool_())],
            names=["page_id", "url", "text", "n_chars", "by_host"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, by_host (the host's path was used)."""
    chosen = written(host_paths(pages), "html", "hosts").select("host", "path")
    salted = chosen.select("host", "path", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = _with_host(pages).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return (rows.join(salted, ["host", "salt"], "left").select("page_id", "url", "html", "path")
            .mapInArrow(_extract_batches, "page_id bigint, url string, text string, n_chars bigint, by_host boolean"))
