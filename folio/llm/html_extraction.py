"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass classifies each
block by itself: by the share of its characters inside links, its length and
the density of stop words, and by what encloses it (menus, footers, notices,
adverts, forms and comments are never text).  Short, middling and thin blocks
stay undecided.  The second pass gives each of those the label of its nearest
decided neighbour on either side within the same part of the page.

An article element is such a part if densities find running text in it, and then
decides for its blocks without a neighbour; one without is judged like the rest
of the page.  Long blocks of many stop words are text wherever they stand;
undecided ones outside are dropped if articles hold most of the running text.  A
compound name (``no-sidebar``) rejects its element only if that encloses less
than most of it; a name such as ``related`` inside an article leaves the verdict
to the densities.  A page with next to no stop words at all is in another
language: then length and links alone decide.

Defined cases: null and empty pages give an empty text; unclosed tags end with
their container; references are decoded, white space in a block becomes one
space, blocks are joined by an empty line; repeated rows are extracted alike; an
empty table gives an empty result; other columns than id and url are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the languages that pages are written in.
STOP_WORDS = frozenset(
    """a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their there they this to was we were which with you
    au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous
    aber als am auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer es für hat ich im in ist mit nach nicht noch nur oder sich sie sind so über um und von vor war wie wird wir zu zum zur
    al como con del el ella ellos era es esta este está hay la las lo los más me mi muy no nos o para pero por que se sin sobre su sus también un una unos y ya""".split()
)
STOP_WORDS_HIGH, STOP_WORDS_LOW = 0.30, 0.12
MAX_LINK_DENSITY = 0.33
#: Least share of stop words in all of a page's longer blocks; below it the page's language is not one of those.
COVERED = 0.03
SHORT, LONG = 70, 200

BLOCK_TAGS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose ends matter, since what is inside is classified by them.
CONTAINERS = frozenset("article aside details dialog div dl fieldset figure footer form header main menu nav ol section span table tbody td tr ul".split())
SKIPPED = frozenset("button canvas datalist head iframe map noframes noscript object option script select style svg template textarea title".split())
NEVER_TEXT = frozenset("aside dialog footer form menu nav".split())
#: Words of class, id and role values that name what is not the text.
BOILERPLATE = frozenset(
    """ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs byline-share comment commentlist comments complementary consent contentinfo cookie cookies copyright disclaimer discussion
    disqus footer gdpr legal login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pagination pager popup promo promoted recommended related replies reply respond search
    share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription tagcloud toolbar topbar widget widgets""".split()
)
#: Of those, words that also name parts of a text: inside an article such a part's blocks are judged, and stay if they are running text.
DOUBTED = frozenset("disclaimer discussion legal notice notices promoted recommended related respond search share sharing social widget widgets".split())
#: Of those, words that a page's own header goes by; inside an article they name the headline.
HEADERS = frozenset("header masthead topbar".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:\s|^)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none|visibility\s*:\s*hidden""", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """Text of a block with what the rules look at."""

    parts: list[str] = field(default_factory=list)
    linked: int = 0
    boilerplate: bool = False
    region: int = 0
    heading: bool = False
    text: str = ""
    label: str = ""
    named: tuple[int, ...] = ()
    doubted: bool = False


def _boilerplate_names(values: list[tuple[str, ...]], names: frozenset[str]) -> tuple[bool, bool]:
    """Whether a value names boilerplate: by a word of its own, or at least as a part of a compound."""
    whole = part = False
    for value in "\n".join(map("".join, values)).lower().split():
        words = {w for w in re.split(r"[^a-z]+", value) if w}
        whole, part = whole or bool(words) and words <= names, part or bool(words & names)
    return whole, part


def blocks_of(html: str, pardoned: frozenset[int] = frozenset()) -> list[Block]:
    """``pardoned``: places of start tags whose compound names don't reject."""
    found: list[Block] = []
    open_tags: list[tuple[str, bool, int, tuple[int, ...], bool]] = []  # name, whether boilerplate from here on, region, places of compound names, whether doubted
    region, regions, in_link, skipping, heading = 0, 0, 0, "", False
    block = Block()
    at = 0

    def end(now: str = "") -> None:
        nonlocal block
        block.text = " ".join(unescape("".join(block.parts)).split())
        if block.text:
            found.append(block)
        block = Block(boilerplate=bool(open_tags) and open_tags[-1][1], region=open_tags[-1][2] if open_tags else 0, heading=heading, named=open_tags[-1][3] if open_tags else (), doubted=bool(open_tags) and open_tags[-1][4])

    def add(text: str) -> None:
        block.parts.append(text)
        if in_link:
            block.linked += len("".join(unescape(text).split()))

    for m in _TOKEN.finditer(html):
        if m.start() < at:
            continue
        if m.start() > at:
            add(html[at : m.start()])
        at = m.end()
        if m[1] is None:
            continue
        name, closing = m[1].lower(), html[m.start() + 1] == "/"
        if name in SKIPPED:
            if not closing and not m[2].endswith("/"):
                stop = re.compile(r"<body\b|</head\s*>" if name == "head" else rf"</{re.escape(name)}\b[^>]*>?", re.I).search(html, at)
                if name == "head":
                    at = at if stop is None else stop.start() if stop[0].lower().startswith("<body") else stop.end()
                else:
                    at = len(html) if stop is None else stop.end()
            continue
        if name == "a":
            in_link = 0 if closing else 1
            continue
        if name == "br":
            block.parts.append(" ")
            continue
        if name in CONTAINERS:
            if closing:
                depth = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name), None)
                if depth is not None:
                    del open_tags[depth:]
            else:
                bad, own, named, doubted = open_tags[-1][1:] if open_tags else (False, 0, (), False)
                values = _NAMES.findall(m[2])
                whole, part = _boilerplate_names(values, BOILERPLATE if not own else BOILERPLATE - HEADERS - DOUBTED)
                doubted = doubted or bool(own) and any(_boilerplate_names(values, DOUBTED))
                hard = name in NEVER_TEXT or (name == "header" and not own) or whole or bool(_HIDDEN.search(m[2]))
                if part and not hard and not bad and m.start() not in pardoned:
                    named = (*named, m.start())
                bad = bad or hard or (part and m.start() not in pardoned)
                if hard:
                    named = ()
                if name in ("article", "main") and not bad and not own:
                    regions += 1
                    own = regions
                open_tags.append((name, bad, own, named, doubted))
        if name in BLOCK_TAGS:
            heading = not closing and len(name) == 2 and name[0] == "h" and name != "hr"
            end()
            in_link = 0
        elif name in CONTAINERS and open_tags and (open_tags[-1][1] != block.boilerplate or open_tags[-1][4] != block.doubted):
            end()
    if at < len(html):
        add(html[at:])
    end()
    return found


def _stop_words(block: Block) -> tuple[int, int]:
    words = _WORD.findall(block.text.lower())
    return sum(w in STOP_WORDS for w in words), len(words)


def _first_pass(block: Block, covered: bool = True) -> str:
    """good, bad, near (middling), short, or thin: long enough, but next to no stop words."""
    if block.boilerplate:
        return "bad"
    size = max(1, len("".join(block.text.split())))
    linked = block.linked / size
    if linked > (MAX_LINK_DENSITY if not block.region else 0.5):
        return "bad"
    if len(block.text) < SHORT:
        return "bad" if block.doubted or block.linked and not block.region else "short"
    if covered:
        found, words = _stop_words(block)
        density = found / max(1, words)
        label = ("good" if len(block.text) >= LONG else "near") if density >= STOP_WORDS_HIGH else "near" if density >= STOP_WORDS_LOW else "thin"
    else:  # no stop words to go by: length alone, after links
        label = "good" if len(block.text) >= LONG else "thin"
    return "bad" if block.doubted and label == "thin" else label


def _is_covered(blocks: list[Block]) -> bool:
    counts = [_stop_words(b) for b in blocks if not b.boilerplate and len(b.text) >= SHORT]
    return sum(n for n, _ in counts) >= COVERED * sum(n for _, n in counts) if counts else True


def _sweep(first: list[str], blocks: list[Block], decided: tuple[str, ...]) -> list[tuple[str, int]]:
    """For each block the label of the last decided one before it in its part of the page, and how far back that is."""
    out, label, at = [], "", 0
    for i, block in enumerate(blocks):
        if i and (block.region, block.boilerplate) != (blocks[i - 1].region, blocks[i - 1].boilerplate):
            label = ""
        out.append((label, i - at) if label else ("", len(blocks)))
        if first[i] in decided:
            label, at = ("bad" if first[i] == "bad" else "good"), i
    return out


def classify(blocks: list[Block]) -> list[Block]:
    """Labels good and bad, in two passes."""
    covered = _is_covered(blocks)
    first = [_first_pass(b, covered) for b in blocks]
    # an article's blocks stand together only if they hold running text, or nothing long enough to tell
    longer = {b.region for b, x in zip(blocks, first, strict=True) if b.region and x in ("good", "near", "thin")}
    confirmed = {b.region for b, x in zip(blocks, first, strict=True) if b.region and (x in ("good", "near") or b.region not in longer)}
    running = [(len(b.text), b.region in confirmed) for b, x in zip(blocks, first, strict=True) if x in ("good", "near")]
    articles = bool(confirmed) and 2 * sum(n for n, inside in running if inside) >= sum(n for n, _ in running)
    first = ["bad" if x == "thin" and b.region not in confirmed else x for b, x in zip(blocks, first, strict=True)]
    sides = {}
    for kinds in (("good", "bad"), ("good", "bad", "near")):
        after = _sweep(first[::-1], blocks[::-1], kinds)[::-1]
        sides[kinds] = list(zip(_sweep(first, blocks, kinds), after, strict=True))
    for i, block in enumerate(blocks):
        label = first[i]
        if label in ("near", "short", "thin"):
            (before, near), (after, far) = sides["good", "bad"][i] if label == "near" else sides["good", "bad", "near"][i]
            if block.region in confirmed:  # an article's part is text unless both its sides aren't
                label = "bad" if before == after == "bad" else "good"
            elif articles:
                label = "bad"
            elif not before and not after:
                label = "good" if label == "near" else "bad"
            elif before and after and before != after:
                label = "good" if first[i] == "near" else (before if near < far else after if far < near else "good" if block.heading and after == "good" else "bad")
            else:
                label = before or after
        block.label = label
    return blocks


def _whole_page(html: str) -> list[Block]:
    """The page's blocks, compound names pardoned where they enclose most of its running text."""
    pardoned: frozenset[int] = frozenset()
    while True:
        blocks, inside, total = blocks_of(html, pardoned), {}, 0
        if not any(b.named for b in blocks):
            return blocks
        for b in blocks:
            if (b.named or not b.boilerplate) and _first_pass(replace(b, boilerplate=False)) in ("good", "near"):
                total += len(b.text)
                for place in b.named:
                    inside[place] = inside.get(place, 0) + len(b.text)
        most = frozenset(place for place, n in inside.items() if 2 * n > total) - pardoned
        if not most:
            return blocks
        pardoned |= most


def main_text(html: str | None) -> str:
    return "\n\n".join(b.text for b in classify(_whole_page(html)) if b.label == "good") if html else ""


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars of every page."""
    schema = pa.schema([(id_col, pa.int64()), (url_col, pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema=schema)

    source = df.select(F.col(id_col).cast("long").alias(id_col), F.col(url_col).cast("string").alias(url_col), html_col)
    return source.mapInArrow(work, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")
