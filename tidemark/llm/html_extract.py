"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing and threshold clustering.

The standard library's streaming parser turns a page into lines, one for each block of text, with the number of tags seen
since the line before. Text-to-tag ratios are smoothed with a Gaussian kernel and cut at a threshold; runs of lines above it
are the content clusters, and a container's mass is the number of characters of the clusters in it. From the page downwards,
the region is the container that still holds nearly all of the mass: 95 % of it, or 80 % if the container is an article or
main part. Several articles that together hold it are the region together. All lines of the region are the main text, short
ones included, and a page title (h1) just before it.

Scripts, styles, form controls, menus, footers, sidebars and hidden parts, by element, role or attribute, never become lines. A
class or id that names such a part (adverts, notices and so on) takes the part out only while the clusters bear it out: a part
named so outright stays out while a tenth of the mass is elsewhere, one that has such a word in its name while half of the
mass is. Reader comments stay out whatever their mass, unless they hold the page's only h1 or no cluster of LEAST characters
is elsewhere. A form stays only if it wraps nearly all of the page's text. Of a header inside the content only headings stay.

Defined cases: a null or empty page, or one with no text outside those parts, gives an empty text; a page cut off in the
middle gives what came before; markup that isn't closed is closed where the next block or the parent ends, a head where its
content can't stand in one, and a menu or sidebar that would hide all that follows where main text is likely to begin; a tag or
comment that never ends takes the rest of the page; repeated rows give the same text. Other columns pass through, one named like the output as `<name>_input`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, set_aside

#: Element and class names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset("head title nav footer aside script style noscript template svg math iframe object canvas audio video select textarea button label legend option optgroup dialog menu map datalist".split())
#: What may stand in a head; anything else ends one whose end tag is left out.
HEAD = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
#: Elements inside which a head's content is not judged.
RAW = ("noscript", "template", "script", "style", "title")
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices popup modal newsletter subscribe subscription signup comment comments discussion disqus replies responses respond share sharing social related recommended widget toolbar pagination pager login search skip alert alerts toast paywall overlay lightbox dropdown copyright disclaimer teaser teasers commentlist".split()
)
COMMENTS = frozenset("comment comments discussion disqus replies responses respond commentlist".split())
HEADS = frozenset("header topbar".split())
OPEN_NAMES = frozenset("with has no without".split())
#: Words beside such a name that don't change what it says.
NEUTRAL = frozenset("area block bottom box button container content inner item left list main outer page right row section site top wrap wrapper".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article main div section td body header form".split())
#: Start tags that end a part to leave out that never closes, a menu or another one: main text is likely to begin there.
ENDS_MENU = frozenset("main article section div p table blockquote pre figure hr".split()) | HEADINGS
ENDS_PART = frozenset("main article section div h1".split())
#: Least characters of clusters outside a part of reader comments that take it out (a tenth of all, if that is less), and inside a form that lets it stay.
LEAST = 80
#: A start tag on the left closes an open one of the same group, up to the nearest boundary.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BOUNDS = frozenset("ul ol dl table article main section div body td th blockquote aside nav".split())
_SPLIT = re.compile("[^a-z0-9]+")
_UNFINISHED = re.compile(r"<(?:[a-zA-Z/!?])")
_CUT_OFF = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?$")


@lru_cache(maxsize=4096)
def _named(value: str, names: frozenset[str] = NAMES) -> int:
    """Does a class or id name one of the parts to leave out? 4 if reader comments, 2 if outright (`ad-box`), 1 if among other words (`ad-free-content`), 0 if not (`has-sidebar`)."""
    found = 0
    for name in value.lower().split():
        parts = [x for x in _SPLIT.split(name) if x]
        if names is NAMES and COMMENTS.intersection(parts) and not OPEN_NAMES & {*parts[:-1]}:
            return 4
        if parts and (parts[0] in names or parts[-1] in names) and not OPEN_NAMES & {*parts[:-1]}:
            found = max(found, 2 if all(x in names or x in NEUTRAL or x.isdigit() for x in parts) else 1)
    return found


class _Lines(HTMLParser):
    """Collects lines as (text, tags before it, container, heading or not); a container is (parent, kind, strength of its name)."""

    def __init__(self, unclosed: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.unclosed = unclosed  # start tags, by number, of parts to leave out that never close
        self.starts = 0
        self.swallowed: set[int] = set()
        self.roots: list[tuple[int, int, bool]] = []  # hidden parts that are open: place on the stack, number, menu or not
        self.lines: list[tuple[str, int, int, str]] = []
        self.containers: list[tuple[int, str, int]] = [(-1, "html", 0)]
        self.stack: list[tuple[str, int, int, bool, str]] = []
        self.open: Counter[str] = Counter()
        self.hidden = 0  # depth of the stack at which a part to leave out began
        self.buffer: list[str] = []
        self.tags = 0
        self.at = 0  # innermost container
        self.inside = False  # an article or main part is open
        self.heading = ""

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.lines.append((text, self.tags, self.at, self.heading))
                self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        self.starts += 1
        if self.open["head"] and tag not in HEAD and not any(self.open[x] for x in RAW):
            self.pop_to(next(i for i, x in enumerate(self.stack) if x[0] == "head"))
        if self.roots:
            at, number, menu = self.roots[-1]
            if tag == "main" and self.stack[at][0] in ("nav", "aside", "footer", "header") or number in self.unclosed and tag in (ENDS_MENU if menu else ENDS_PART):
                self.pop_to(at)
        if tag in VOID:
            if tag == "br" or tag == "hr":
                self.buffer.append(" ") if tag == "br" else self.flush()
            return
        closed = CLOSES.get(tag) or (("p",) if tag in BLOCK else ())  # a block ends an open paragraph
        if any(self.open[x] for x in closed):
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in closed:
                    self.pop_to(i)
                    break
                if self.stack[i][0] in BOUNDS:
                    break
        if tag in BLOCK:
            self.flush()
        self.stack.append((tag, self.hidden, self.at, self.inside, self.heading))
        self.open[tag] += 1
        if self.hidden:
            return
        if tag in HEADINGS:
            self.heading = tag
        strength = self.strength(tag, attrs) if attrs else 0
        if tag in DROPPED or strength == 3 or tag == "header" and not self.inside:
            self.hidden = len(self.stack)
            if tag in BLOCK:
                self.roots.append((self.hidden - 1, self.starts, tag == "nav"))
        elif strength or tag in CONTAINERS:
            kind = "main" if ("role", "main") in attrs else "article" if ("role", "article") in attrs else tag
            if kind in ("div", "section", "header") and self.inside and (kind == "header" or any(k in ("class", "id") and v and _named(v, HEADS) == 2 for k, v in attrs)):
                kind = "header"
            self.containers.append((self.at, kind, strength or 5 * (tag == "form")))
            self.at = len(self.containers) - 1
            self.inside = self.inside or kind in ("article", "main")

    def strength(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        """3 for a part that is left out in any case, else what its class and id say."""
        found = 0
        for k, v in attrs:
            if k in ("class", "id"):
                if v and tag not in ("body", "html", "main"):
                    found = max(found, _named(v), 0 if self.inside else _named(v, HEADS))
            elif k == "role":
                if v in ROLES:
                    return 3
            elif k == "hidden" or k == "aria-hidden" and v == "true" or k == "style" and v and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", v):
                return 3
        return found

    def pop_to(self, i: int, ended: str = "") -> None:
        """Close all from place i of the stack on; `ended` is the element whose end tag came, if one."""
        while self.roots and self.roots[-1][0] >= i:
            if ended in ("body", "html"):
                self.swallowed.add(self.roots[-1][1])
            self.roots.pop()
        if any(x[0] in BLOCK for x in self.stack[i:]):
            self.flush()
        for x in self.stack[i:]:
            self.open[x[0]] -= 1
        _, self.hidden, self.at, self.inside, self.heading = self.stack[i]
        del self.stack[i:]

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self.pop_to(i, tag)
                return
            if tag not in BLOCK and tag not in DROPPED and self.stack[i][0] in BLOCK:
                return  # an inline end tag doesn't close a block

    def handle_data(self, data: str) -> None:
        if self.open["head"] and self.stack[-1][0] == "head" and not data.isspace():
            self.pop_to(len(self.stack) - 1)
        if not self.hidden:
            self.buffer.append(data)


def smooth(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing with a kernel of radius 2 sigma, renormalised at the ends."""
    r = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-k * k / (2 * sigma * sigma)) for k in range(r + 1)]
    n, out = len(values), []
    for i in range(n):
        total = weight = 0.0
        for j in range(max(0, i - r), min(n, i + r + 1)):
            w = kernel[abs(i - j)]
            total += w * values[j]
            weight += w
        out.append(total / weight)
    return out


def content_lines(lines: list[tuple[str, int, int, str]], sigma: float = 1.0, cut: float = 0.5) -> list[bool]:
    """True for lines whose smoothed text-to-tag ratio reaches `cut` standard deviations of the smoothed ratios."""
    ratios = smooth([len(line[0]) / max(1, line[1]) for line in lines], sigma)
    mean = sum(ratios) / len(ratios)
    limit = min(cut * math.sqrt(sum((x - mean) ** 2 for x in ratios) / len(ratios)), max(ratios))
    return [x >= limit for x in ratios]


def _masses(lines: list[tuple[str, int, int, str]], good: list[bool], containers: list[tuple[int, str, int]], out: list[bool]) -> list[int]:
    """Characters of the clusters in each container, without those of parts left out. Parents come before children."""
    mass = [0] * len(containers)
    for (text, _, at, _), ok in zip(lines, good, strict=True):
        if ok and not out[at]:
            mass[at] += len(text)
    for i in range(len(containers) - 1, 0, -1):
        mass[containers[i][0]] += mass[i]
    return mass


def _below(containers: list[tuple[int, str, int]], marked: list[bool]) -> list[bool]:
    """Containers inside a marked one."""
    found = [False] * len(containers)
    for i, (parent, _, _) in enumerate(containers):
        found[i] = parent >= 0 and (found[parent] or marked[parent])
    return found


def _left_out(containers: list[tuple[int, str, int]], mass: list[int], titles: list[int]) -> list[bool]:
    """Containers whose names take them out, where the clusters bear it out, with all that they hold; titles are the containers of the page's h1 if it is alone."""
    out, gone = [False] * len(containers), 0
    titled = [False] * len(containers)  # holds the page's title, as reader comments never do
    for i in titles:
        while i >= 0 and not titled[i]:
            titled[i] = True
            i = containers[i][0]
    said = [strength == 4 and not titled[i] for i, (_, _, strength) in enumerate(containers)]
    outer = [s and not any_above for s, any_above in zip(said, _below(containers, said), strict=True)]
    others = mass[0] - sum(m for m, o in zip(mass, outer, strict=True) if o)
    for i, (parent, _, strength) in enumerate(containers):
        if i and out[parent]:
            out[i] = True
        elif said[i]:
            if others >= min(LEAST, mass[0] / 10):
                out[i] = True
                gone += mass[i]
        elif strength == 5:
            if mass[i] < LEAST or 10 * (mass[0] - gone - mass[i]) >= mass[0]:
                out[i] = True
                gone += mass[i]
        elif strength in (1, 2) and (2 * mass[i] <= mass[0] if strength == 1 else 10 * (mass[0] - gone - mass[i]) >= mass[0]):
            out[i] = True
            gone += mass[i]
    return out


def _region(containers: list[tuple[int, str, int]], mass: list[int]) -> set[int]:
    children: dict[int, list[int]] = {}
    for i, (parent, _, _) in enumerate(containers):
        if mass[i]:
            children.setdefault(parent, []).append(i)
    at = 0
    while own := children.get(at):
        best = max(own, key=mass.__getitem__)
        if mass[best] * 100 < mass[0] * (80 if containers[best][1] in ("article", "main") else 95):
            articles = [i for i in own if containers[i][1] == "article"]
            return set(articles) if sum(mass[i] for i in articles) * 100 >= mass[0] * 95 else {at}
        at = best
    return {at}


def _parsed(html: str, unclosed: frozenset[int] = frozenset()) -> _Lines:
    parser = _Lines(unclosed)
    parser.feed(_CUT_OFF.sub("", html))
    if _UNFINISHED.match(parser.rawdata):
        parser.rawdata = ""  # a tag or comment that never ends takes all that follows, as in browsers; close() would look for its end from each "<"
    parser.close()
    parser.flush()
    parser.swallowed.update(number for _, number, _ in parser.roots)
    return parser


def extract(html: str | None, sigma: float = 1.0, cut: float = 0.5) -> str:
    """The main text of a page: the blocks of its content region, joined by an empty line."""
    if not html:
        return ""
    parser = _parsed(html)
    if parser.swallowed:  # parts that hide all to the end of the page: read again with these ended where main text is likely to begin
        parser = _parsed(html, frozenset(parser.swallowed))
    lines, containers = parser.lines, parser.containers
    if not lines:
        return ""
    good = content_lines(lines, sigma, cut)
    heads = [at for _, _, at, heading in lines if heading == "h1"]
    out = _left_out(containers, _masses(lines, good, containers, [False] * len(containers)), heads if len(heads) == 1 else [])
    mass = _masses(lines, good, containers, out)
    roots = _region(containers, mass)
    within, header = [False] * len(containers), [False] * len(containers)
    for i, (parent, kind, _) in enumerate(containers):
        within[i] = i in roots or parent >= 0 and within[parent]
        header[i] = kind == "header" or parent >= 0 and header[parent]
    chosen = [k for k, (_, _, at, heading) in enumerate(lines) if within[at] and not out[at] and (heading or not header[at])]
    titles = [k for k, (_, _, at, heading) in enumerate(lines) if heading == "h1" and not out[at]]
    if len(titles) == 1 and chosen and titles[0] < chosen[0]:
        chosen = titles + chosen
    return "\n\n".join(lines[k][0] for k in chosen)


def extract_main_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Replace the column html by the main text in a column `out`; all other columns pass through."""
    pages = pages if out == html else set_aside(pages, out)
    rest = [c for c in pages.columns if c != html]
    schema = pages.select(*rest, F.lit("").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages_ in blocks(batches, html):
            columns = [batch.column(batch.schema.names.index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([extract(x) for x in pages_], pa.string())], names=[*rest, out])

    return pages.select(*rest, html).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_main_text(pages).withColumn("n_chars", F.length("text").cast("long")).select("page_id", "url", "text", "n_chars")
