"""Main text of web pages by container paths that the pages of a host agree on (operator 8)."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattfold.llm.common import stash

SHARE = 0.7  # of a page's weighed text that its main container holds

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>",
    re.S,
)
_ATTR = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = {"base", "link", "meta", "noscript", "script", "style", "template", "title"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "center", "#page"}
BLOCKS = CONTAINERS | HEADINGS | set(
    "address aside blockquote caption dd details dialog dl dt fieldset figcaption figure footer form "
    "header hgroup hr legend li nav ol p pre summary table tbody tfoot th thead tr ul".split()
)
# An opening tag ends an open one of these, looking no further out than the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "body": ({"head"}, set()),
}
# What is never main text: by tag and by role. Words of class or id only make it suspect.
OUT_TAGS = RAW | set(
    "nav header footer aside form template button select option datalist svg math canvas object "
    "audio video map dialog menu head".split()
)
OUT_ROLES = {"navigation", "complementary", "banner", "contentinfo", "search", "form", "menu", "menubar", "dialog", "alert"}
OUT_WORDS = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter "
    "subscribe subscription signup login share sharing social related recommended recommendations "
    "sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager "
    "comment comments reply replies respond disqus discussion footer header masthead topbar toolbar "
    "widget widgets search skip".split()
)
# A name of class or id is suspect where its other words are of these: not has-sidebar or search-engines.
FRAME_WORDS = set(
    "area bar block bottom box button buttons col column container form global group icon icons inner item "
    "items left link links list main message mobile outer panel posts primary right row secondary section "
    "site slot sticky tags text title top unit wrap wrapper".split()
)


@dataclass
class Block:
    """One block of text: the containers round it, from the outermost, and its linked characters."""

    within: tuple[int, ...]
    text: str
    linked: int


@dataclass
class Page:
    """Text blocks in page order, and each container's generalised tag-class path, tag and parent."""

    blocks: list[Block] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)
    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    suspects: dict[str, bool] = field(default_factory=dict)  # by path, whether it holds most of the text

    def open(self, path: str, tag: str, parent: int) -> int:
        self.paths.append(path)
        self.tags.append(tag)
        self.parents.append(parent)
        return len(self.paths) - 1

    def chain(self, container: int) -> list[int]:
        """The containers from the outermost to ``container``."""
        out = [container]
        while out[-1]:
            out.append(self.parents[out[-1]])
        return out[::-1]


@dataclass
class _Open:
    tag: str
    out: bool  # nothing in here is main text
    link: bool
    within: tuple[int, ...]
    suspects: tuple[str, ...] = ()  # paths of the suspect elements round it, and its own


def _label(tag: str, names: str) -> str:
    """``tag.class.class`` with classes in order and digits written as #."""
    return ".".join([tag, *sorted({re.sub(r"\d+", "#", n) for n in names.split()})])


def _is_out(tag: str, attrs: dict[str, str]) -> bool:
    if tag in OUT_TAGS or attrs.get("role", "").lower() in OUT_ROLES:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "").lower()):
        return True
    return False


def _is_suspect(tag: str, attrs: dict[str, str]) -> bool:
    """Whether a whole name of class or id says that this is no main text."""
    if tag in ("html", "body", "main", "article"):
        return False
    names = attrs.get("class", "").split() + ([] if tag in HEADINGS else attrs.get("id", "").split())
    words = [{w.lower() for w in _WORDS.findall(name)} for name in names]
    return any(w & OUT_WORDS and w <= OUT_WORDS | FRAME_WORDS for w in words)


def read_page(source: str, verdicts: dict[str, bool] | None = None) -> Page:
    """One pass over the markup; unclosed and stray tags are mended as browsers do.

    Suspect elements stay if they hold most of the page's unlinked text; ``verdicts`` says
    by path which stay whatever they hold here.
    """
    page, stack = Page(), [_Open("#page", False, False, (0,))]
    page.open("#page", "#page", 0)
    parts: list[tuple[str, bool, tuple[str, ...]]] = []
    raw: list[tuple[tuple[int, ...], list[tuple[str, bool, tuple[str, ...]]]]] = []

    def flush() -> None:
        if any(not piece.isspace() for piece, _, _ in parts):
            # A page's own title may link to itself.
            title = any(o.tag == "h1" for o in stack)
            raw.append((stack[-1].within, [(t, link and not title, s) for t, link, s in parts]))
        parts.clear()

    def text(piece: str) -> None:
        if piece and not stack[-1].out:
            piece = entities.unescape(piece) if "&" in piece else piece
            parts.append((piece, stack[-1].link, stack[-1].suspects))

    def close(depth: int) -> None:
        if any(o.tag in BLOCKS for o in stack[depth:]):
            flush()
        del stack[depth:]

    def find(tags: set[str], barrier: set[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in barrier:
                break
        return 0

    at, end = 0, len(source)
    while at < end:
        found = _MARKUP.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at : found.start()])
        at = found.end()
        if not found["tag"]:
            continue
        tag = found["tag"].lower()
        if found["end"]:
            depth = find({tag}, set())
            if depth:
                close(depth)
            elif tag in BLOCKS or tag == "p":
                flush()
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag in BLOCKS:
            if depth := find({"p"}, CONTAINERS | {"li", "table"}):
                close(depth)
            if tag in CLOSES and (depth := find(*CLOSES[tag])):
                close(depth)
            flush()
        elif tag == "br":
            text(" ")
        if tag in VOID or found["attrs"].endswith("/") and tag not in BLOCKS:
            continue
        attrs = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(found["attrs"])}
        top, within = stack[-1], stack[-1].within
        if tag in CONTAINERS and not top.out:
            path = f"{page.paths[within[-1]]}>{_label(tag, attrs.get('class', ''))}"
            within = (*within, page.open(path, tag, within[-1]))
        out = top.out or _is_out(tag, attrs)
        if tag in HEADINGS and top.out and top.tag in ("header", "hgroup"):
            # A title in an article's own header belongs to the article.
            out = not any(o.tag in ("article", "main") for o in stack)
        suspects = top.suspects
        if not out and _is_suspect(tag, attrs):
            name = f"{_label(tag, attrs.get('class', ''))}#{_label('', attrs.get('id', ''))}"
            suspects = (*suspects, f"{page.paths[within[-1]]}>{name}")
        stack.append(_Open(tag, out, top.link or tag == "a", within, suspects))
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            at = stop.start() if stop else end
    flush()
    held: dict[str | None, int] = {}
    for _, pieces in raw:
        chars = {None: [0, 0]}
        for piece, link, suspects in pieces:
            size = len(" ".join(piece.split()))
            for s in (None, *set(suspects)):
                sums = chars.setdefault(s, [0, 0])
                sums[0] += size
                sums[1] += size if link else 0
        for s, (size, linked) in chars.items():
            held[s] = held.get(s, 0) + max(0, size - 2 * linked)
    total = held.pop(None, 0)
    page.suspects = {s: 2 * n > total for s, n in held.items()}
    stay = page.suspects if verdicts is None else page.suspects | verdicts
    for within, pieces in raw:
        kept = [(t, link) for t, link, suspects in pieces if all(stay[s] for s in suspects)]
        joined = " ".join("".join(t for t, _ in kept).split())
        if joined:
            linked = sum(len(t) for t, link in kept if link)
            page.blocks.append(Block(within, joined, min(linked, len(joined))))
    return page


def weights(page: Page, blocks: list[Block] | None = None) -> dict[int, int]:
    """Each container's characters of text in blocks, links counting against it."""
    out: dict[int, int] = {}
    for b in page.blocks if blocks is None else blocks:
        for c in b.within:
            out[c] = out.get(c, 0) + max(0, len(b.text) - 2 * b.linked)
    return out


def main_container(page: Page, scores: dict[int, int]) -> int:
    """The innermost container that holds ``SHARE`` of the weighed text, or the article or main
    element round it."""
    total = scores.get(0, 0)
    best = max((c for c, s in scores.items() if s >= SHARE * total), default=0) if total else 0
    return next((c for c in page.chain(best) if page.tags[c] in ("article", "main")), best)


def _beside(page: Page, core: int, blocks: list[Block]) -> dict[int, list[tuple[bool, list[int]]]]:
    """What stands outside ``core``: by the depth of the container round both, units of block
    numbers, and whether they are links for the most part.

    A unit is all of a neighbouring container, or a single block that is in none.
    """
    chain, units = page.chain(core), {}
    for i, b in enumerate(blocks):
        depth = 0
        while depth < min(len(chain), len(b.within)) and b.within[depth] == chain[depth]:
            depth += 1
        if depth < len(chain):
            unit = b.within[depth] if depth < len(b.within) else ~i
            units.setdefault((depth - 1, unit), []).append(i)
    out: dict[int, list[tuple[bool, list[int]]]] = {}
    for (depth, _), at in units.items():
        links = 2 * sum(blocks[i].linked for i in at) > sum(len(blocks[i].text) for i in at)
        out.setdefault(depth, []).append((links, at))
    return out


def whole_container(page: Page, core: int) -> int:
    """The outermost container that adds text to ``core`` before one adds nothing but links.

    Wrappers that add nothing count as well, short of the body: a title or an intro may
    stand there on other pages of the host.
    """
    chain, beside, best = page.chain(core), _beside(page, core, page.blocks), core
    for depth in range(len(chain) - 2, -1, -1):
        added = beside.get(depth)
        if added and all(links for links, _ in added):
            break
        if added or page.tags[chain[depth]] not in ("body", "html", "#page"):
            best = chain[depth]
    return best


def page_text(page: Page, *containers: int) -> str:
    """Blocks of all ``containers`` in page order, without the links beside their main part."""
    blocks = [b for b in page.blocks if any(c in b.within for c in containers)]
    core = main_container(page, weights(page, blocks))
    beside = _beside(page, core, blocks).values()
    out = {i for units in beside for links, at in units if links for i in at}
    return "\n".join(b.text for i, b in enumerate(blocks) if i not in out)


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``pages`` (html dropped) with ``text`` and ``n_chars``, by two passes over the pages.

    First every page scores its containers and names the tag-class path of the one that holds
    its main one and the text round it; votes are summed per host and path, map-side first, so a host with a third of the pages
    is a few rows a task. Then each page is read again and all containers on its host's
    winning path give the text, in page order; where the page has no text there, its own
    container does. The winners are a small table that
    Spark broadcasts if its files are under the session's threshold and otherwise joins by
    shuffle.

    Elements whose class or id only hints at boilerplate are voted on as well: a page is for
    keeping one that holds most of its unlinked text, and where the pages of a host differ,
    the greater number settles it for all of them.

    A null page is empty; an empty page has empty text; a null url is a host of its own.
    Repeated rows are kept. ``text`` and ``n_chars`` replace columns of those names.
    """
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    host = F.coalesce(
        F.lower(F.regexp_extract(F.col(f"`{url_col}`"), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)),
        F.lit(""),
    )
    rows = pages.select(
        *[F.col(f"`{c}`") for c in keep],
        host.alias("__host"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("__html"),
    )

    def ballots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cast = []
            for name, source in zip(pdf["__host"], pdf["__html"]):
                page = read_page(source)
                scores = weights(page)
                best = whole_container(page, main_container(page, scores))
                if scores.get(best):
                    cast.append((name, page.paths[best], scores[best], False))
                cast += [(name, path, 1 if stays else -1, True) for path, stays in page.suspects.items()]
            yield pd.DataFrame(cast, columns=["__host", "path", "chars", "suspect"])

    votes = rows.select("__host", "__html").mapInPandas(
        ballots, "__host string, path string, chars long, suspect boolean"
    )
    suspect = F.col("suspect")
    split = suspect & (F.abs("chars") < F.col("votes"))  # pages of the host differ
    winners = stash(
        votes.groupBy("__host", "path", "suspect")
        .agg(F.count("*").alias("votes"), F.sum("chars").alias("chars"))
        .groupBy("__host")
        .agg(
            F.max_by("path", F.when(~suspect, F.struct("votes", "chars", "path"))).alias("__path"),
            F.collect_list(F.when(split & (F.col("chars") >= 0), F.col("path"))).alias("__stay"),
            F.collect_list(F.when(split & (F.col("chars") < 0), F.col("path"))).alias("__go"),
        ),
        "host-paths",
    )
    schema = T.StructType([pages.schema[c] for c in keep]).add("text", "string")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            given = (batch.column(c).to_pylist() for c in ("__html", "__path", "__stay", "__go"))
            for source, path, stay, go in zip(*given):
                page = read_page(source, dict.fromkeys(stay or (), True) | dict.fromkeys(go or (), False))
                if not page.blocks and go:
                    page = read_page(source)
                scores = weights(page)
                on_path = [c for c in scores if page.paths[c] == path]
                texts.append(page_text(page, *(on_path or [whole_container(page, main_container(page, scores))])))
            columns = [*(batch.column(c) for c in keep), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text"])

    return (
        rows.join(winners, "__host", "left")
        .select(*[F.col(f"`{c}`") for c in keep], "__html", "__path", "__stay", "__go")
        .mapInArrow(read, schema)
        .withColumn("n_chars", F.char_length("text").cast("bigint"))
    )
