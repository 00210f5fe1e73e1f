"""Main text of HTML pages by tag-path ratios (operator 1).

Each block of text has a root-to-leaf tag path. Text length (without links) and punctuation
are summed per path and divided by the path's blocks; both ratios are smoothed along the
page, fused by their product, and weighed by a prior: names, roles and tags of page
furniture (menus, headers, footers, sidebars, notices, adverts, forms, reader comments)
lower it, ``article`` and ``main`` raise it. Paths over the threshold are content. Their
blocks vote for the container that holds the article; its blocks are the text, so that
headings and short paragraphs stay with the long ones around them. Inside it, blocks with a
low prior and runs of links stay only where the ratios chose them, or where a run of links
stands between chosen blocks. Scripts, styles, form controls and hidden elements have no text.

A prior never outvotes the text. Names are read as a whole: ``related-posts`` is furniture,
``has-share``, ``comments-open`` and ``promo-effects`` say nothing. Names of an ``article`` or
``main`` don't count, and one with most of the page's text counts as such wherever it stands.
Any other element with nearly all of the text (a form around the page) isn't furniture.
Inside an article most names only raise doubt, so that a paragraph like its neighbours stays.

Null and empty pages, and pages without text, give an empty text. Markup may be broken: tags
may be left open, closed twice or cut off; of an element without text that is never closed,
scripts, styles and comments apart, only the tag is dropped. Each row is judged alone, so
repeated rows give equal results; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import arrow_map

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math object select option button canvas audio video".split())
_NEVER = frozenset(("script", "style"))  # without an end they go on to the end of the page
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
_BOX = frozenset("html body article main section div td th table aside header footer nav center dd li blockquote".split())
_ALONE = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUT_TAG = frozenset("nav footer aside form dialog menu head".split())
_OUT_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_OUT_NAME = re.compile(
    r"ads?|advert\w*|adsense|adbox|sponsor\w*|promo\w*|sidebar\w*|menus?|nav|navbar|navigation|topnav|breadcrumbs?|footer|masthead|topbar"
    r"|comments?|commentlist|replies|reply|respond|disqus|cookies?|consent|gdpr|newsletter|subscribe|subscription|signup|popup|modal|overlay"
    r"|share|sharing|social|related|recommended|recommendations|widgets?|pagination|pager|paging|toolbar|login|searchbox|taglist|readmore"
)
#: Those that aren't part of an article even where it holds them.
_NEVER_NAME = re.compile(r"ads?|advert\w*|adsense|adbox|sponsor\w*|comments?|commentlist|replies|reply|respond|disqus|cookies?|consent|gdpr|newsletter|subscribe|subscription|signup|popup|modal|overlay")
#: Names that parts of an article may have as well: there they count for less.
_MAYBE_NAME = re.compile(r"banner|side|aside|foot|header|commentary|discussion|notices?|alerts?|warning|search|form|skip|copyright|legal|disclaimer|hidden|tags")
#: What may stand beside a name of furniture without changing what it says.
_BESIDE_NAME = re.compile(r"\d+|site|page|main|global|top|bottom|left|right|primary|secondary|box|bar|block|section|area|wrap|wrapper|container|inner|outer|list|items?|links?|buttons?|posts?|articles?|stories|content|text|the|user|reader|in|slot|unit|panel|row|col|column|module|component|region|group|js|fixed|sticky")
_SPLIT_NAME = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z])(?=[A-Z])")
_POINT = re.compile(r"[.,;:!?…、。¿¡]")
#: A block's score must reach this share of the page's mean score, over characters.
THRESHOLD = 0.35
#: The article is the innermost container with this share of the selected text.
SHARE = 0.7
#: An article or main part is one wherever it stands, and any other element isn't furniture, with this share of the page's text outside links.
MOSTLY, NEARLY_ALL = 0.5, 0.85
#: Priors: page furniture, its like inside an article, and article or main.
FURNITURE, DOUBTFUL, ARTICLE = 0.05, 0.4, 2.0


@dataclass(slots=True)
class _Open:
    tag: str
    out: bool
    inner: bool  # in an article or main part
    link: bool
    path: int
    box: int


@dataclass(slots=True)
class Block:
    """A block of text."""

    text: str
    path: int
    box: int
    linked: int
    prior: float
    heads: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)} if raw.strip(" /") else {}


def _hidden(attrs: dict[str, str]) -> bool:
    return "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")))


def _named(attrs: dict[str, str], pattern: re.Pattern[str]) -> bool:
    """Whether a class or the id is a name of ``pattern``, alone or beside words that don't change what it says."""
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
        words = [x.lower() for x in _SPLIT_NAME.split(name) if x]
        hit = [bool(pattern.fullmatch(x)) for x in words]
        if any(hit) and all(yes or _BESIDE_NAME.fullmatch(x) or _OUT_NAME.fullmatch(x) or _MAYBE_NAME.fullmatch(x) for x, yes in zip(words, hit, strict=True)):
            return True
    return False


def _prior(tag: str, attrs: dict[str, str], inner: bool) -> float:
    """How likely the element is to hold the article, from its tag, role and names alone."""
    if tag in _OUT_TAG or (tag == "header" and not inner) or attrs.get("role", "").lower() in _OUT_ROLE:
        return FURNITURE
    if attrs and tag not in ("html", "body", "main", "article"):
        if _named(attrs, _OUT_NAME):
            return DOUBTFUL if inner and not _named(attrs, _NEVER_NAME) else FURNITURE
        if _named(attrs, _MAYBE_NAME):
            return DOUBTFUL if inner else FURNITURE
    return ARTICLE if tag in ("article", "main") and not inner else 1.0


def _weighed(blocks: list[Block], boxes: list[tuple[str, int, float]]) -> list[tuple[str, int, float]]:
    """Sets the blocks' priors and gives the containers theirs, from the factors of their elements and where the text stands."""
    text = [0] * len(boxes)
    for b in blocks:
        if b.box >= 0:
            text[b.box] += len(b.text) - b.linked
    for x in range(len(boxes) - 1, 0, -1):  # a parent has a smaller number than its children
        if boxes[x][1] >= 0:
            text[boxes[x][1]] += text[x]
    total = sum(len(b.text) - b.linked for b in blocks)
    out: list[tuple[str, int, float]] = []
    for (tag, up, factor), n in zip(boxes, text, strict=True):
        prior = out[up][2] if up >= 0 else 1.0
        if factor < 1 and n >= NEARLY_ALL * total:
            factor = 1.0
        if tag in ("article", "main") and n > MOSTLY * total:
            prior, factor = max(prior, ARTICLE), 1.0
        out.append((tag, up, max(prior * factor, 1e-9)))
    for b in blocks:
        b.prior = out[b.box][2] if b.box >= 0 else 1.0
    return out


def blocks_of(page: str) -> tuple[list[Block], list[tuple[str, int, float]]]:
    """(blocks of text in page order, tag, parent and prior of each container by number).

    A path is a number, too: that of its parent path and last name, inline tags left out.
    """
    stack = [_Open("#root", False, False, False, 0, -1)]
    unclosed: set[str] = set()
    paths: dict[tuple[int, str], int] = {}
    open_tags: Counter[str] = Counter()
    boxes: list[tuple[str, int, float]] = []
    out: list[Block] = []
    held: list[str] = []
    linked, where = 0, None

    def flush() -> None:
        nonlocal linked, where
        text = " ".join("".join(held).split())
        if text and where is not None:
            out.append(Block(text, where.path, where.box, linked, 1.0, where.tag in _HEADS))
        held.clear()
        linked, where = 0, None

    def say(raw: str) -> None:
        nonlocal linked, where
        top = stack[-1]
        if not raw or top.out:
            return
        text = html.unescape(raw) if "&" in raw else raw
        held.append(text)
        if text.strip():
            if where is None:
                where = top
            if top.link:
                linked += len(text.strip())

    def close_to(i: int) -> None:
        if any(x.tag not in _INLINE for x in stack[i:]):
            flush()
        open_tags.subtract(x.tag for x in stack[i:])
        del stack[i:]

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                say(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        if m[1] or m[4]:  # a closing tag
            if not open_tags[tag]:
                if tag not in _INLINE:
                    flush()
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close_to(i)
                    break
                if tag in _INLINE and stack[i].tag not in _INLINE:
                    break
                if stack[i].tag in ("td", "th", "article", "main", "body") and tag not in ("table", "tr", "tbody", "html", "body", "article", "main", "section", "div"):
                    break
            continue
        if tag in _RAW:
            if m[0].endswith("/>") and tag not in _NEVER:
                continue
            edge = None if tag in unclosed else (re.compile(rf"</{tag}\s*>", re.I) if tag in _NEVER else re.compile(rf"<(/?){tag}(?![\w-])[^<>]*>?", re.I)).search(page, at)
            if edge is None:
                unclosed.add(tag)
                at = n if tag in _NEVER else at
            elif tag in _NEVER or edge[1]:
                at = edge.end()
            elif tag in ("option", "title"):  # not closed: its text ends at the next tag
                at = edge.start()
            continue
        if tag in _VOID:
            if tag == "br":
                say(" ")
            elif tag not in _INLINE:
                flush()
            continue
        same = _ALONE.get(tag, {"p"} if tag in _ENDS_P else ())
        for i in range(len(stack) - 1, 0, -1) if any(open_tags[x] for x in same) else ():
            if stack[i].tag in same:
                close_to(i)
                break
            if stack[i].tag in _BOX and stack[i].tag not in same or stack[i].tag in ("ul", "ol", "dl", "table"):
                break
        if tag not in _INLINE:
            flush()
        top = stack[-1]
        attrs = _attributes(m[3] if m[2] else m[6])
        if m[0].endswith("/>") and tag in _INLINE:
            continue
        inner = top.inner or tag in ("article", "main")
        gone = top.out or _hidden(attrs)
        factor = _prior(tag, attrs, top.inner)
        name = tag + "".join("." + c for c in attrs.get("class", "").split()[:2]) if tag in _BOX else tag
        path, box = top.path, top.box
        if tag not in _INLINE:
            path = paths.setdefault((path, name), len(paths) + 1)
        if tag in _BOX or factor < 1:
            boxes.append((tag, box, factor))
            box = len(boxes) - 1
        stack.append(_Open(tag, gone, inner, top.link or tag == "a", path, box))
        open_tags[tag] += 1
    flush()
    return out, _weighed(out, boxes)


def _smooth(x: list[float]) -> list[float]:
    """Weighted mean of each value and its neighbours."""
    out = []
    for i, mid in enumerate(x):
        low, high = x[max(i - 1, 0)], x[min(i + 1, len(x) - 1)]
        out.append((low + 2 * mid + high) / 4)
    return out


def select(blocks: list[Block]) -> tuple[list[bool], list[bool]]:
    """Which blocks the tag-path ratios take for content: with the ratios smoothed, and by their own path alone."""
    length: Counter[int] = Counter()
    points: Counter[int] = Counter()
    count: Counter[int] = Counter()
    leaf = [b.path for b in blocks]
    for p, b in zip(leaf, blocks, strict=True):
        length[p] += max(len(b.text) - b.linked, 0)
        points[p] += len(_POINT.findall(b.text))
        count[p] += 1
    text = [length[p] / count[p] for p in leaf]
    point = [points[p] / count[p] for p in leaf]
    size = [len(b.text) * b.prior for b in blocks]
    out = []
    for t, q in ((_smooth(text), _smooth(point)), (text, point)):
        fused = [x * (1.0 + y) * b.prior for x, y, b in zip(t, q, blocks, strict=True)]
        bar = THRESHOLD * sum(f * n for f, n in zip(fused, size, strict=True)) / max(sum(size), 1e-12)
        out.append([f >= bar and b.linked * 2 <= len(b.text) for f, b in zip(fused, blocks, strict=True)])
    return out[0], out[1]


def _home(blocks: list[Block], boxes: list[tuple[str, int, float]], chosen: list[bool], sure: list[bool]) -> int:
    """The container of the article, by the votes of the chosen blocks; -1 is the page."""
    vote, text, good = ([0] * len(boxes) for _ in range(3))
    total = 0
    for b, yes, own in zip(blocks, chosen, sure, strict=True):
        n = len(b.text)
        total += n * yes
        if b.box >= 0:
            vote[b.box] += n * yes
            text[b.box] += n * (not b.heads)
            good[b.box] += n * (own and not b.heads)
    for x in range(len(boxes) - 1, 0, -1):  # a parent has a smaller number than its children
        up = boxes[x][1]
        if up >= 0:
            vote[up], text[up], good[up] = vote[up] + vote[x], text[up] + text[x], good[up] + good[x]
    home = max((x for x in range(len(boxes)) if vote[x] >= SHARE * total), default=-1)
    at = home
    while at >= 0:  # the part of an article stands for the article
        if boxes[at][0] in ("article", "main"):
            home = at
            break
        at = boxes[at][1]
    while home >= 0 and boxes[home][1] >= 0:  # what stands beside it belongs to it if it is mostly content, or headings
        up = boxes[home][1]
        if 2 * (good[up] - good[home]) < text[up] - text[home] or boxes[up][0] == "html":
            break
        home = up
    return home


def main_text(page: str) -> str:
    """The article's blocks in page order, joined by line breaks."""
    blocks, boxes = blocks_of(page)
    if not blocks:
        return ""
    chosen, sure = select(blocks)
    if not any(chosen):
        chosen = sure = [True] * len(blocks)
    home = _home(blocks, boxes, chosen, sure)
    inside = []
    for x, (_, up, _) in enumerate(boxes):
        inside.append(x == home or home < 0 or (up >= 0 and inside[up]))
    here = [(b, yes) for b, yes in zip(blocks, chosen, strict=True) if home < 0 or (b.box >= 0 and inside[b.box])]
    doubt = DOUBTFUL * (boxes[home][2] if home >= 0 else 1.0)
    linked = [b.linked * 2 > len(b.text) for b, _ in here]
    ahead = [i for i, (_, yes) in enumerate(here) if yes]
    out = []
    for i, (b, yes) in enumerate(here):
        listed = linked[i] and any(all(linked[k : k + 3]) for k in range(max(i - 2, 0), min(i, len(here) - 3) + 1))
        amid = bool(ahead) and ahead[0] < i < ahead[-1]  # links between paragraphs are the article's own
        if yes or not (listed and not amid or b.prior <= doubt):
            out.append(b.text)
    return "\n".join(out)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""

    def work(part: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
        found = [main_text(t.decode("utf-8", "replace")) for t in texts]
        return pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    return arrow_map(rows, work, "page_id long, url string, text string, n_chars long", "html")
