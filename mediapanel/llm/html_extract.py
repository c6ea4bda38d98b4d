"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Blocks inside navigation,
headers, footers, sidebars, forms, adverts, notices and reader comments (by
tag, role, or a word of class or id) are decided: not content. The first pass
classifies the others by link density, length and stop-word density as
content, boilerplate, or ambiguous (short, or in between). Forms and containers
known by a hint that wrappers of whole pages carry too (``WRAPPER_HINTS``, as in
``main-menu-open``) are only presumed out: if no block outside of them is content, or
if the one ``article`` or ``main`` with content is in them, the outermost that has most
content is opened, until content is found; what is out inside it for a reason of its
own stays out. Links reach over the blocks inside them. In the second pass
an ambiguous block inherits the label of its nearest decided neighbour; with
one on each side, equally far and of different labels, the stop-word density
decides. An ``article`` or ``main`` element is a region: neighbours outside it
count only if it holds no decided block, and its own blocks are boilerplate
only by links. If nothing is decided, blocks in a region are content, others
are not.

Character references are decoded, white space inside a block becomes one
space, blocks are joined by two line feeds. Nothing is cut off or capped. Null
or empty html gives the empty text. Every row is judged alone: repeated rows give
repeated results, other columns than ``keep`` are left out, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Common function words of the four languages.
STOP_WORDS = frozenset("""
the of and to a in is it that for was on are as with he they be at this have from or had by not but what all
were we when your can there an which their if will would about her him has more no
der die das und ist in zu den mit von für auf nicht ein eine als auch es an dem des sich im war bei aus nach
wie über wird sie er wir
le la les de des du et un une est que qui dans pour pas sur au avec ce il elle ne par plus ont sont se
el los las y en del por con para una su al lo como más pero sus
""".split())

# Names of elements and hints.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol
p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea select button iframe svg math canvas object title".split())
OUT_TAGS = frozenset("nav footer aside form menu dialog".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
OUT_HINTS = frozenset("""ad ads advert advertisement advertising adsense sponsor sponsored promo promotion cookie
cookies consent gdpr notice notification alert banner popup modal newsletter subscribe subscription signup login
sidebar widget related recommended share sharing social breadcrumb breadcrumbs menu nav navbar navigation footer
comment comments disqus replies pagination masthead toolbar""".split())
WRAPPER_HINTS = frozenset("""menu nav navbar navigation sidebar banner popup modal widget share sharing social
toolbar masthead login signup search notification alert""".split())

SHORT, LONG, DENSITY_LOW, DENSITY_HIGH, LINKS = 70, 200, 0.12, 0.25, 0.4

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)
    |<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>
    |<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S | re.X)
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HINT_WORDS = re.compile(r"[a-z]+")
WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    out: bool
    region: int  # 0: outside article and main
    inside: tuple[int, ...] = ()  # the containers presumed out, outermost first, if nothing else puts it out
    label: bool | None = None  # content, boilerplate, or not decided


def _is_out(name: str, attrs: str, in_region: bool) -> tuple[bool, bool]:
    """Whether the element is out, and whether that is only presumed."""
    presumed = name == "form"
    if not presumed and name in OUT_TAGS or (name == "header" and not in_region):
        return True, False
    for m in ATTR.finditer(attrs) if attrs else ():
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value.strip() in OUT_ROLES:
                return True, False
        elif name not in ("body", "html", "main"):
            hints = OUT_HINTS.intersection(HINT_WORDS.findall(value))
            if not hints <= WRAPPER_HINTS:
                return True, False
            presumed = presumed or bool(hints)
    return presumed, presumed


def blocks_of(page: str) -> list[Block]:
    """Blocks in page order; scripts, styles, comments and the head are gone."""
    blocks: list[Block] = []
    stack: list[tuple[str, bool, int, tuple[int, ...]]] = []  # open block elements: tag, out, region, presumed out
    parts: list[str] = []
    regions, containers, linked, pos, n = 0, 0, 0, 0, len(page)
    in_link = -1  # how many elements were open where the link began

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out, region, inside = stack[-1][1:] if stack else (False, 0, ())
                blocks.append(Block(text, min(linked, len(text)), out or bool(inside), region, () if out else inside))
            parts.clear()
        linked = 0

    while pos < n:
        m = TAG.search(page, pos)
        raw = page[pos:m.start() if m else n]
        if raw:
            raw = html.unescape(raw)
            parts.append(raw)
            if in_link >= 0:
                linked += len(raw.strip())
        if m is None:
            break
        pos = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        ends, attrs = bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if name in RAW_TAGS or name == "head":
            if not ends and not attrs.endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*>" if name != "head" else r"</head\b[^>]*>|(?=<body\b)", re.I)
                found = stop.search(page, pos)
                if found is None and name == "head":
                    continue
                pos = found.end() if found else n
            parts.append(" ")
        elif name == "a":
            in_link = -1 if ends else len(stack)
        elif name == "br":
            parts.append(" ")
        elif name in BLOCK_TAGS:
            close()
            if ends:
                if any(t[0] == name for t in stack):
                    while stack.pop()[0] != name:
                        pass
            else:
                while stack and stack[-1][0] == "p":
                    stack.pop()
                if name in ("li", "dt", "dd", "tr", "td", "th") and stack and stack[-1][0] == name:
                    stack.pop()
                out, region, inside = stack[-1][1:] if stack else (False, 0, ())
                here, presumed = _is_out(name, attrs, region > 0)
                if presumed:
                    containers += 1
                    inside += (containers,)
                out = out or here and not presumed
                if name in ("article", "main") and not out and not region:
                    regions += 1
                    region = regions
                if name not in VOID_TAGS:
                    stack.append((name, out, region, inside))
            if len(stack) < in_link:  # the element around the link has ended
                in_link = -1
    close()
    open_wrappers(blocks)
    return blocks


def open_wrappers(blocks: list[Block]) -> None:
    """Take containers presumed out for what they hold where that is the content."""
    if not any(b.inside for b in blocks):
        return
    good = [b for b in blocks if len(b.text) >= SHORT and b.linked <= LINKS * len(b.text)
            and (b.inside or not b.out) and _density(b.text) >= (DENSITY_LOW if len(b.text) > LONG else DENSITY_HIGH)]
    while not any(not b.out and (b.region or not any(g.region for g in good)) for b in good):
        held: dict[int, int] = {}
        for b in good:
            if b.inside and (b.region or not any(g.region for g in good)):
                held[b.inside[0]] = held.get(b.inside[0], 0) + len(b.text)
        if not held:
            return
        most = max(held, key=lambda c: (held[c], -c))
        for b in blocks:
            if b.inside and b.inside[0] == most:
                b.inside = b.inside[1:]
                b.out = bool(b.inside)


def _density(text: str) -> float:
    words = WORDS.findall(text.lower())
    return sum([w in STOP_WORDS for w in words]) / len(words) if words else 0.0


def classify(blocks: list[Block]) -> list[bool]:
    """True for each block that is content."""
    density = [0.0 if b.out else _density(b.text) for b in blocks]
    for b, d in zip(blocks, density):
        if b.out or b.linked > LINKS * len(b.text):
            b.label = False
        elif len(b.text) < SHORT:
            b.label = None
        elif d >= DENSITY_HIGH or (d >= DENSITY_LOW and len(b.text) > LONG):
            b.label = True
        elif d < DENSITY_LOW and not b.region:
            b.label = False
    has_own = {b.region for b in blocks if b.label is not None and b.region and not b.out}

    def nearest(order) -> list[tuple[int, bool] | None]:
        """Distance and label of the closest decided block on one side."""
        seen: list[tuple[int, bool] | None] = [None] * len(blocks)
        last: dict[int, tuple[int, bool]] = {}  # by region; -1: any
        for i in order:
            b = blocks[i]
            key = b.region if b.region in has_own and not b.out else -1
            if key in last:
                seen[i] = (abs(i - last[key][0]), last[key][1])
            if b.label is not None:
                last[-1] = (i, b.label)
                if not b.out:
                    last[b.region] = (i, b.label)
        return seen

    before, after = nearest(range(len(blocks))), nearest(range(len(blocks) - 1, -1, -1))
    out = []
    for i, b in enumerate(blocks):
        if b.label is not None:
            out.append(b.label)
            continue
        sides = [x for x in (before[i], after[i]) if x is not None]
        if b.region and b.region not in has_own or not sides:
            out.append(b.region > 0)
        elif len(sides) == 2 and sides[0][0] == sides[1][0] and sides[0][1] != sides[1][1]:
            out.append(density[i] >= DENSITY_HIGH)
        else:
            out.append(min(sides)[1])
    return out


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    return "\n\n".join([b.text for b, keep in zip(blocks, classify(blocks)) if keep])


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and its length ``n_chars`` per row."""
    src = pages.select(*[F.col(c) for c in keep], F.col(html_col).cast("string").alias("__html"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]]
                       + ["text string", "n_chars long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = [main_text(h.as_py()) for h in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns - 1)]
                    + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*keep, "text", "n_chars"])

    return src.mapInArrow(run, schema)
