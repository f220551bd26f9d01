"""Operator 8: main text of HTML pages by consensus of each host's pages.

A host's pages mostly share one template, so the place of the article is
decided by the host, not page by page:

1. Every page is parsed; each container element has a path of tags and
   classes from the root, with digits generalised and numbered, tag or
   one-off classes dropped. A path's score on a page grows with the part of the
   page's clean text (not in links, menus, forms, adverts, comments, ...) that
   lies in its elements, and with its depth, as
   far as no text of the container around is lost.
2. Scores are summed per (host, path) in Spark; the best path of a host wins.
3. Pages are parsed again and the text of the elements on the winning path is
   taken, if it is half of the page's clean text. Otherwise another path with
   half of it is taken, unless the host speaks against that path (it holds
   half on fewer than half of the host's pages that have it); where text
   beside the winning path and such paths makes up half, the next container
   around the winning path; else the winning path. A page without the winning
   path uses its own best path, and one without containers its whole clean text.

Class, id and role words mark noise, but not against the page's text: an
element so marked that holds most of the page's text is kept, unless an
article stands outside it or, where it is no article and holds none, a tenth
as much text does. A page whose text would be empty is read without these words.

Votes are partially aggregated and one row per host joins back, so a host
with a third of all pages is no hot group. Pages are parsed one at a time.

Defined cases. NULL or empty html: the empty text. NULL or unreadable url:
each page decides alone. A ``hidden`` attribute hides, whatever its value. Broken markup: unclosed and stray tags are accepted,
a tag cut off at the end is dropped; an unclosed script or style reaches to
the end, any other element of raw text is dropped up to its start tag's end. Ties between paths: the greater path
string. Repeated rows vote and are returned each. Empty table: no rows.
Nothing is capped. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Votes are whole numbers, so that sums do not depend on their order.
VOTE = 1_000_000
DEPTH_BONUS = 0.1
#: Added to the score of paths through an article element, or through a
#: class or id with one of these words; depth counts up to that step.
ARTICLE_BONUS, WORD_BONUS = 0.5, 0.3
ARTICLE_WORDS = frozenset("article articlebody post entry story content body text".split())

# Tag names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table "
                  "tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article body div main section td".split())
NOISE_TAGS = frozenset("nav footer aside form button select option input label fieldset head menu dialog canvas object "
                       "audio video".split()) | RAW
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}

#: Words in class, id or role that mark what is not the article.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promos promotion "
    "banner banners sidebar sidebars aside rail nav navs navbar navigation menu menus submenu breadcrumb breadcrumbs "
    "footer footers foot masthead topbar topnav header headers toolbar cookie cookies consent gdpr privacy notice notices "
    "alert alerts popup popups modal overlay newsletter subscribe subscription signup login search share sharing social "
    "related recommended recommendations trending popular widget widgets comment comments commentlist respond reply "
    "replies disqus discussion pagination pager skip hidden complementary contentinfo".split())

#: First words of classes that say what a container has or lacks, not what it is.
MODIFIERS = frozenset("has no with without".split())
#: A noisily named container that is no article may leave out so much text for each character it holds.
OUTSIDE = 0.1

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<script>script|style)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:(?<=/)>|>.*?(?:</(?P=script)(?=[\s/>])[^>]*>|\Z))"
    r"|<(?P<raw>" + "|".join(sorted(RAW - {"script", "style"})) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
    r"(?:(?<=/)>|>(?:.*?</(?P=raw)(?=[\s/>])[^>]*>)?)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _noisy(name: str, article: bool) -> bool:
    """Whether a class, id or role marks noise; on an article by its first word only (tags are in its classes)."""
    words = [w.lower() for w in _PARTS.findall(name)]
    if not words or words[0] in MODIFIERS:
        return False
    return words[0] in NOISE_WORDS if article else any(w in NOISE_WORDS for w in words)


def _read_attributes(attrs: str, article: bool = False) -> tuple[list[str], bool, bool]:
    """Classes (and the id, with #), whether they mark noise, and whether the element is hidden."""
    names, noise, hidden = [], False, False
    for m in _ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            hidden = True
        elif key in ("class", "id", "role"):
            for c in value.split():
                noise = noise or _noisy(c, article)
                if key == "class":
                    names.append(c)
                elif key == "id":
                    names.append("#" + c)
    return names, noise, hidden


def _step(tag: str, names: list[str]) -> str:
    """A path step: digits generalised, names with several numbers dropped."""
    kept = sorted({re.sub(r"\d+", "0", n.lower()) for n in names if len(re.findall(r"\d+", n)) < 2 and len(n) <= 40
                   and not n.lower().startswith(("tag-", "category-"))})
    return ".".join([tag, *kept])


class _Element:
    __slots__ = ("tag", "path", "noise", "hard", "link", "chars", "inside", "named", "article")

    def __init__(self, tag: str, path: str, noise: bool, hard: bool, link: bool, inside: bool, named, article: int):
        self.tag, self.path, self.noise, self.hard, self.link, self.inside, self.chars = tag, path, noise, hard, link, inside, 0
        self.named, self.article = named, article


class _Named:
    """A noisily named element: its number, the one around it, the articles
    open at its start, and its own text by article (0: in none)."""
    __slots__ = ("number", "around", "articles", "container", "article", "own")

    def __init__(self, number: int, around, articles: frozenset[int], container: bool, article: bool):
        self.number, self.around, self.articles, self.container, self.article = number, around, articles, container, article
        self.own: dict[int, int] = defaultdict(int)


def _dominant(named: list[_Named]) -> frozenset[int]:
    """Numbers of the noisily named elements that the page's text says to keep."""
    whole = [sum(e.own.values()) for e in named]
    for e in reversed(named[1:]):  # inner ones stand later
        whole[e.around.number] += whole[e.number]
        e.around.article = e.around.article or e.article
    kept = {0}
    outside = dict(named[0].own)
    for e in named[1:]:  # those with over half of the text lie in each other
        if 2 * whole[e.number] <= whole[0] or e.around.number not in kept or not e.container:
            continue
        if any(n for a, n in outside.items() if a and a not in e.articles):
            continue
        if not e.article and sum(outside.values()) > OUTSIDE * whole[e.number]:
            continue
        kept.add(e.number)
        for a, n in e.own.items():
            outside[a] = outside.get(a, 0) + n
    return frozenset(kept - {0})


def parse(page: str, target: str | None = None, names: bool = True) -> tuple[dict[str, int], list[str]]:
    """(characters of clean text by container path, blocks of the elements at
    path ``target``; an empty target takes all clean text). Without ``names``
    class, id and role words mark nothing."""
    found, blocks, kept = _parse(page, target, None if not names else frozenset())
    return _parse(page, target, kept)[:2] if kept else (found, blocks)


def _parse(page: str, target: str | None, kept: frozenset[int] | None) -> tuple[dict[str, int], list[str], frozenset[int]]:
    """``parse`` with the noisily named elements of the numbers ``kept`` taken
    as clean (None: all), and the numbers that should be."""
    found: dict[str, int] = defaultdict(int)
    blocks: list[str] = []
    block: list[str] = []
    whole = target == ""
    named = [_Named(0, None, frozenset(), True, False)]
    articles = 0
    stack = [_Element("", "", False, False, False, whole, named[0], 0)]

    def flush() -> None:
        text = " ".join("".join(block).split())
        if text:
            blocks.append(text)
        block.clear()

    def pop() -> None:
        e = stack.pop()
        stack[-1].chars += e.chars
        if e.tag in CONTAINER and not e.noise:
            found[e.path] += e.chars
        if e.tag in BLOCK:
            flush()

    def close(tags: tuple[str, ...], stop: frozenset[str] | tuple[str, ...]) -> None:
        """Close the nearest open element of ``tags``, unless one of ``stop`` is nearer."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                while len(stack) > i:
                    pop()
                return
            if stack[i].tag in stop:
                return

    for m in _TOKEN.finditer(page):
        kind = m.lastgroup
        if kind == "text":
            top = stack[-1]
            if not top.hard:
                text = entities.unescape(m["text"])
                if not top.link:
                    top.named.own[top.article] += len(text) - text.count(" ")
                if top.noise:
                    continue
                if not top.link:
                    top.chars += len(text) - text.count(" ")
                if top.inside:
                    block.append(text)
        elif m["tag"]:
            tag = m["tag"].lower()
            if m["end"]:
                close((tag,), () if tag in BLOCK else CONTAINER)
                continue
            if tag == "br":
                block.append(" ")
                continue
            if tag in BLOCK:
                close(("p",), CONTAINER)  # a block ends an open paragraph
                close(CLOSES.get(tag, ()), ("ul", "ol", "dl", "table", "select"))
                flush()
            if tag in VOID or m["attrs"].endswith("/") and tag not in BLOCK:
                continue
            parent = stack[-1]
            article = tag in ("article", "main")
            names, noise, hard = _read_attributes(m["attrs"], article) if m["attrs"] else ([], False, False)
            if tag in ("html", "body"):
                noise = hard = False
            hard = parent.hard or hard or tag in NOISE_TAGS or (
                tag == "header" and not any(e.tag in ("article", "main") for e in stack))
            own = parent.named
            if noise and not hard and kept is not None:
                own = _Named(len(named), own, frozenset(e.article for e in stack if e.article), tag in CONTAINER, article)
                named.append(own)
                noise = own.number not in kept
            elif article:
                parent.named.article = parent.named.article or own.number > 0
                noise = False
            else:
                noise = False
            noise = parent.noise or hard or noise
            if article:
                articles += 1
            path = f"{parent.path}>{_step(tag, names)}" if tag in CONTAINER or tag in BLOCK else parent.path
            inside = not noise and (parent.inside or whole or target is not None and tag in CONTAINER and path == target)
            stack.append(_Element(tag, path, noise, hard, parent.link or tag == "a", inside, own, articles if article else parent.article))
    while len(stack) > 1:
        pop()
    flush()
    return found, blocks, _dominant(named) if not kept and len(named) > 1 else frozenset()


def lossless_depth(path: str, found: dict[str, int]) -> int:
    """Steps of a path, without those into a container with less text than
    the one around it (main elements apart)."""
    depth, pending, around, at = 0, 0, None, ""
    for step in path.split(">")[1:]:
        at += ">" + step
        pending += 1
        if at in found:
            if around is None or found[at] >= around or step.split(".")[0] == "main":
                depth += pending
            pending, around = 0, found[at]
    return depth


def weight(path: str, found: dict[str, int]) -> float:
    """What a path's place and names add to its part of the text."""
    steps = path.split(">")[1:]
    article = next((i for i, x in enumerate(steps) if x.split(".")[0] == "article"), None)
    if article is not None:
        return 1 + DEPTH_BONUS * (article + 1) + ARTICLE_BONUS
    named = next((i for i, x in enumerate(steps) if any(
        w in ARTICLE_WORDS for n in x.split(".")[1:] for w in _PARTS.findall(n))), None)
    if named is not None:
        return 1 + DEPTH_BONUS * (named + 1) + WORD_BONUS
    return 1 + DEPTH_BONUS * lossless_depth(path, found)


def votes(found: dict[str, int]) -> dict[str, int]:
    """Whole-number score of every container path of a page."""
    most = max(found.values(), default=0)
    return {p: round(VOTE * (c / most) ** 2 * weight(p, found)) for p, c in found.items() if c} if most else {}


def best(scores: dict[str, int]) -> str:
    return max(scores, key=lambda p: (scores[p], p), default="")


def page_path(found: dict[str, int], path: str, small: list[str]) -> str:
    """The path to read on a page that has its host's ``path``; ``small`` are
    the paths that the host speaks against."""
    most = max(found.values())
    if 2 * found[path] >= most:
        return path
    around = [p for p in found if path.startswith(p + ">")]
    against = [p for p in small if p in found and p not in around and not p.startswith(path + ">")]
    under = lambda p: any(p == x or p.startswith(x + ">") for x in against)
    scores = votes(found)
    other = {p: s for p, s in scores.items() if 2 * found[p] >= most and p not in around and p != path and not under(p)}
    if other:
        return best(other)
    aside = sum(found[p] for p in against if not any(p.startswith(x + ">") for x in against))
    if 2 * (most - found[path] - aside) >= most:
        return max((p for p in around if 2 * found[p] >= most), key=len, default=path)
    return path


def extract(page: str, path: str | None, small: list[str] | None = None) -> str:
    """The text at ``path``, or at the page's own best path."""
    if path:
        found, blocks = parse(page, path)
        if found.get(path):
            own = page_path(found, path, small or [])
            return "\n\n".join(blocks if own == path else parse(page, own)[1])
    else:
        found, _ = parse(page)
    text = "\n\n".join(parse(page, best(votes(found)))[1])
    if not text and page:
        found, _ = parse(page, None, False)
        text = "\n\n".join(parse(page, best(votes(found)), False)[1])
    return text


def host_of(url: str):
    """Lower-case host of a url column; NULL where there is none."""
    host = F.lower(F.regexp_extract(F.col(url), r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/@?#]*@)?([^/:?#\s]+)", 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, small): the winning container path of each host, and the
    paths that hold half of the text on some of its pages, but on fewer than
    half of the pages that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0, 0])
                for host, page in zip(part.column("host").to_pylist(), part.column("html")):
                    found = parse(page.as_py() or "")[0]
                    most = max(found.values(), default=0)
                    for path, score in votes(found).items():
                        own = sums[host, path]
                        own[0] += score
                        own[1] += 1
                        own[2] += 2 * found[path] >= most
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in sums], pa.string()), pa.array([k[1] for k in sums], pa.string()),
                     *(pa.array([v[i] for v in sums.values()], pa.int64()) for i in range(3))],
                    names=["host", "path", "score", "n", "big"])

    p = pages.select(host_of(url).alias("host"), F.col(html).alias("html")).filter("host IS NOT NULL")
    summed = (p.mapInArrow(run, "host string, path string, score long, n long, big long").groupBy("host", "path")
              .agg(F.sum("score").alias("score"), F.sum("n").alias("n"), F.sum("big").alias("big")))
    # stored, so that the join sees its real size: one that may be broadcast leaves the pages in place
    return stored(summed.groupBy("host").agg(
        F.max_by("path", F.struct("score", "path")).alias("path"),
        F.collect_list(F.when(F.expr("big > 0 AND 2 * big < n"), F.col("path"))).alias("small")), "paths")


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    paths = host_paths(pages, url, html).withColumnRenamed("host", "w_host")
    p = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(url).alias("host"))
    joined = p.join(paths, F.col("host") == F.col("w_host"), "left").select("page_id", "url", "html", "path", "small")
    kind = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [extract(page.as_py() or "", path, small) for page, path, small in
                         zip(part.column("html"), part.column("path").to_pylist(), part.column("small").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
