"""Main text of web pages by consensus of a host's pages.

1. Each page's containers are scored: the share of the page's prose they hold,
   squared, times the share of prose in their text (menus, adverts, footers and
   the like inside a container lower it).
2. Pages vote: a container's generalised path (tags and classes from the body
   down, digits and element order left out) gets its score, the page's second best
   half of its own, and so on; votes are summed per host in Spark, and the best path of each host wins.
3. Each page is read again and the text of the elements on its host's winning path
   is taken; a page without such an element, or without a host, uses its own best
   container.

The text is that of the container without navigation, headers, footers, asides,
forms, scripts, styles, hidden elements, lists of links, and elements whose class,
id or role names them as one of these, as notice, advert or reader comments. A
header inside ``article`` or ``main`` stays. White space inside a block (no-break
spaces included) becomes one space; blocks are joined by one space in page order.

Null or empty html, and pages without text, give an empty text. Rows stay one to
one with the input, repeated rows and null ids included; other columns are ignored.
Broken markup is read as browsers do in the common cases: unclosed paragraphs, cells
and items end where the next begins, stray end tags are ignored, an unclosed comment
or script runs to the end.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.common import python_stage, stored

#: Shares of a host's winning path over which its pages are dealt: a host may own
#: a third of all pages.
SALTS = 64
#: Containers of a page that get its votes.
VOTES = 5

# --- fixed values: element names of HTML, and names sites give to what is not the article ---
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q
    s samp small span strike strong sub sup time tt u var wbr""".split())
CONTAINERS = frozenset("body main article section div td center table".split())
IN_HEAD = frozenset("title meta link style script base noscript template".split())
DROPPED = frozenset("""head nav footer aside menu dialog noscript template button select datalist option object
    svg canvas audio video script style textarea title xmp iframe noembed noframes""".split())
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
        "option": ({"option"}, {"select"})}
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense adslot banner banners promo promos
    promotion sponsor sponsored nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead topbar
    footer foot copyright colophon sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice
    notices notification notifications disclaimer alert alerts popup modal overlay newsletter subscribe subscription
    signup login signin share shares sharing sharebar social related recommended recommendations readmore pager
    pagination toolbar search searchbox""".split())
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply discussion feedback reviews".split())
HEADERS = frozenset("header headers".split())
ARTICLE_NAMES = frozenset("article entry post story".split())
LISTS = frozenset("ul ol dl div table section p".split())
#: Before such a name these words make it a property of a page part, not its kind.
PROPERTY = frozenset("has with without no is show hide".split())
# --- end of fixed values ---

TOKEN = re.compile(r"""<!--(?:-?>|.*?-->|.*)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>?", re.I) for t in RAW}
NAME = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
DIGITS = re.compile(r"[-_]*\d+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Elements in page order (so a subtree is a range) and blocks of text."""

    def __init__(self, source: str):
        self.tags, self.parents, self.ends, self.paths, self.skip = ["body"], [-1], [0], ["body"], [False]
        self.why = [""]  # why an element is no part of the article: "kind", "name" or neither
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        self._stack, self._text, self._hidden, self._links = [0], [], False, Counter()
        self._read(source)
        self._flush()
        self._close(1)
        self.ends[0] = len(self.tags)
        self._settle()

    # -- reading

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        find = TOKEN.search
        while at < end:
            m = find(source, at)
            if m is None:
                self._put(source[at:])
                break
            if m.start() > at:
                self._put(source[at:m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            name = name.lower()
            if m[1] or m[4]:
                self._end(name)
                continue
            self._start(name, m[3] or m[6] or "")
            if name in RAW:
                stop = RAW_END[name].search(source, at)
                at = stop.end() if stop else end
                self._end(name)

    def _put(self, text: str) -> None:
        top = self._stack[-1]
        if self.tags[top] in ("head", "html"):
            if text.isspace():
                return
            self._close_tag("head")
            top = self._stack[-1]
        if self._text and self.skip[top] != self._hidden:  # a dropped phrase inside a block
            self._flush()
        self._hidden = self.skip[top]
        element = top if self._hidden else self._block_element()
        self._text.append((element, text, any(self.tags[e] == "a" for e in self._stack)))

    def _block_element(self) -> int:
        for e in reversed(self._stack):
            if self.tags[e] not in INLINE:
                return e
        return 0

    def _flush(self) -> None:
        if self._text:
            joined = "".join(t for _, t, _ in self._text)
            text = " ".join((entities.unescape(joined) if "&" in joined else joined).split())
            if text:
                linked = sum(len(t.strip()) for _, t, a in self._text if a)
                self.blocks.append((self._text[0][0], text, min(linked, len(text))))
            self._text = []

    def _close(self, depth: int) -> None:
        for e in self._stack[depth:]:
            self.ends[e] = len(self.tags)
        del self._stack[depth:]

    def _close_tag(self, *names: str) -> None:
        for depth in range(len(self._stack) - 1, 0, -1):
            if self.tags[self._stack[depth]] in names:
                self._close(depth)
                return

    def _start(self, name: str, rest: str) -> None:
        if name in ("html", "body"):
            self._close_tag("head")
            return
        if name not in INLINE:
            self._flush()
        if name not in IN_HEAD and name != "head":
            self._close_tag("head")
        if name not in INLINE and name not in VOID:
            for depth in range(len(self._stack) - 1, 0, -1):  # an open paragraph ends at the next block
                tag = self.tags[self._stack[depth]]
                if tag == "p":
                    self._close(depth)
                    break
                if tag not in INLINE:
                    break
        if name in ENDS:
            own, scope = ENDS[name]
            for depth in range(len(self._stack) - 1, 0, -1):
                tag = self.tags[self._stack[depth]]
                if tag in scope:
                    break
                if tag in own:
                    self._close(depth)
                    if name != "tr" or tag == "tr":
                        break
        if name in VOID:
            return
        parent = self._stack[-1]
        e = len(self.tags)
        attributes = {}
        if rest:
            for k, *v in ATTRIBUTE.findall(rest):
                attributes.setdefault(k.lower(), v[0] or v[1] or v[2])
        self.tags.append(name)
        self.parents.append(parent)
        self.ends.append(e + 1)
        self.paths.append(self.paths[parent] if name in INLINE else f"{self.paths[parent]}>{label(name, attributes)}")
        why = self._why(name, attributes)
        self.why.append(why)
        self.skip.append(self.skip[parent] or why != "")
        if name == "a":
            self._links[parent] += 1
        self._stack.append(e)

    def _end(self, name: str) -> None:
        if name not in INLINE:
            self._flush()
        for depth in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[depth]]
            if tag == name:
                self._close(depth)
                return
            if name in INLINE and tag not in INLINE:
                return
            if tag in ("td", "th", "table") and name not in ("td", "th", "tr", "table", "tbody", "thead", "tfoot"):
                return

    # -- what is not the article

    def _why(self, name: str, attributes: dict) -> str:
        if name in DROPPED:
            return "kind"
        framed = name == "header" and not self._in_article()
        if framed or not attributes:
            return "kind" if framed else "name" if name == "form" else ""
        if attributes.get("role", "").lower() in ROLES or "hidden" in attributes or \
                attributes.get("aria-hidden", "").lower() == "true" or HIDDEN.search(attributes.get("style", "")):
            return "kind"
        if name == "form":
            return "name"
        for part in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
            names = NAME.findall(CAMEL.sub("-", part).lower())
            if not names or names[0] in PROPERTY:
                continue
            if not COMMENTS.isdisjoint(names) and "count" not in names:
                return "kind"
            if name not in ("article", "main") and not NAMES.isdisjoint(names):
                return "name"
            if not HEADERS.isdisjoint(names) and not self._in_article() and ARTICLE_NAMES.isdisjoint(names):
                return "name"
        return ""

    def _in_article(self) -> bool:
        return any(self.tags[e] in ("article", "main") for e in self._stack)

    def _settle(self) -> None:
        """Lists of links go. Where names leave under a tenth of the text, named elements
        that hold an article, a main element, a top heading or a form's paragraphs stay."""
        self._sum()
        if 10 * self.prose[0] < self.all[0]:
            for e, why in enumerate(self.why):
                inside = self.tags[e:self.ends[e]]
                held = any(x in ("article", "main", "h1") for x in inside) or self.tags[e] == "form" and inside.count("p") >= 3
                if why == "name" and held:
                    self.why[e] = ""
                if e:
                    self.skip[e] = self.skip[self.parents[e]] or self.why[e] != ""
            self._sum()
        links = [0] * len(self.tags)
        for e, k in self._links.items():
            links[e] = k
        for e in range(len(self.tags) - 1, 0, -1):
            links[self.parents[e]] += links[e]
        menus = [e for e in range(1, len(self.tags)) if self.tags[e] in LISTS and not self.skip[e]
                 and links[e] >= 3 and 10 * self.linked[e] >= 8 * self.good[e] > 0]
        for e in menus:
            self.skip[e:self.ends[e]] = [True] * (self.ends[e] - e)
        if menus:
            self._sum()

    def _sum(self) -> None:
        n = len(self.tags)
        self.good, self.linked, self.prose, self.all = [0] * n, [0] * n, [0] * n, [0] * n
        for e, text, linked in self.blocks:
            self.all[e] += len(text)
            if self.skip[e]:
                continue
            self.good[e] += len(text)
            self.linked[e] += linked
            if 2 * linked < len(text) and (len(text) >= 25 or self.tags[e] in ("p", "pre", "blockquote", "h1", "h2")):
                self.prose[e] += len(text)
        for e in range(n - 1, 0, -1):
            p = self.parents[e]
            for sums in (self.good, self.linked, self.prose, self.all):
                sums[p] += sums[e]

    # -- containers

    def containers(self) -> list[tuple[int, int]]:
        """``(score, element)``, best first; scores are whole ten-thousandths."""
        total = self.prose[0]
        if not total:
            return []
        out = []
        for e, tag in enumerate(self.tags):
            if tag in CONTAINERS and not self.skip[e] and 10 * self.prose[e] >= total:
                score = (self.prose[e] / total) ** 2 * self.prose[e] / self.all[e]
                out.append((round(10_000 * score * (1.1 if tag in ("article", "main") else 1)), e))
        return sorted(out, key=lambda x: (-x[0], -x[1]))

    def text_of(self, elements: list[int]) -> str:
        taken, stop = [], -1
        for e in elements:  # in page order; an element inside another is part of it
            if e >= stop:
                stop = self.ends[e]
                taken += [t for x, t, _ in self.blocks if e <= x < stop and not self.skip[x]]
        return " ".join(taken)


def label(name: str, attributes: dict) -> str:
    """An element's tag and classes (its id where it has none), without digits."""
    words = sorted({w for w in (DIGITS.sub("", c) for c in attributes.get("class", "").lower().split()) if w})
    if words:
        return name + "." + ".".join(words)
    own = DIGITS.sub("", attributes.get("id", "").lower()).strip()
    return f"{name}#{own}" if own else name


def vote(source: str | None) -> list[tuple[str, int]]:
    """``(path, vote)`` of the page's best containers, one per path: the best with its
    score, each next with half the weight of the one before."""
    page = Page(source or "")
    best: dict[str, int] = {}
    for score, e in page.containers():
        best.setdefault(page.paths[e], score)
    return [(path, score >> rank) for rank, (path, score) in enumerate(list(best.items())[:VOTES])]


def extract(source: str | None, path: str | None = None) -> str:
    """The main text of a page by ``path``, else by its own best container."""
    page = Page(source or "")
    if path is not None:
        on = [e for e, p in enumerate(page.paths)
              if p == path and page.tags[e] not in INLINE and not page.skip[e] and page.prose[e]]
        if on:
            return page.text_of(on)
    own = page.containers()
    return page.text_of([own[0][1] if own else 0])


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("score", pa.int64())])
    for batch in batches:
        held: Counter = Counter()
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for path, score in vote(source):
                held[host, path] += score
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()),
                                          pa.array(list(held.values()), pa.int64())], schema=schema)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("path", pa.string())])
    for batch in batches:
        page_id, url, source, path = (batch.column(c) for c in ("page_id", "url", "html", "path"))
        texts = [extract(s, p) for s, p in zip(source.to_pylist(), path.to_pylist())]
        yield pa.RecordBatch.from_arrays([page_id.cast(pa.int64()), url.cast(pa.string()), pa.array(texts, pa.string()),
                                          path.cast(pa.string())], schema=schema)


def with_host(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host"))


def host_paths(pages: DataFrame) -> DataFrame:
    """``host``, ``path``, ``score``: each host's winning path (ties: the longer, then the
    first by name). Pages without a host do not vote."""
    python_stage(pages.sparkSession)
    votes = (with_host(pages).filter("host is not null").select("host", "html")
             .mapInArrow(_votes, "host string, path string, score long")
             .groupBy("host", "path").agg(F.sum("score").alias("score")))
    best = F.max_by(F.struct("path", "score"), F.struct(F.col("score"), F.length("path"), F.col("path")))
    return votes.groupBy("host").agg(best.alias("best")).select("host", "best.path", "best.score")


def main_text(pages: DataFrame, paths: DataFrame | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``path`` (the host's winning path) of every page. Pages meet
    their host's path by (host, share), so no host is one task's."""
    python_stage(pages.sparkSession)
    paths = paths if paths is not None else stored(host_paths(pages), "host-paths")
    shares = paths.select(F.col("host").alias("of_host"), "path", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("share"))
    rows = with_host(pages).withColumn("of", F.pmod(F.xxhash64("page_id", "url", F.length("html")), F.lit(SALTS)).cast("int"))
    met = rows.join(shares, (F.col("host") == F.col("of_host")) & (F.col("of") == F.col("share")), "left")
    return met.select("page_id", "url", "html", "path").mapInArrow(_texts, "page_id long, url string, text string, path string")
