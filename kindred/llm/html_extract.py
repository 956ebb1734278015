"""Main text of web pages: flat text blocks, classified by a small decision tree.

A page is cut into blocks of text at every block-level tag. A block is described by its words, its
share of linked words, the same of the blocks before and after it, and by where it stands (inside an
article or main element, inside an element whose tag, class or id speaks of page furniture). A decision
tree, trained on the labelled pages below, keeps or drops it. What a wrapper around the first article or
main element is called says nothing about the article, nor do the article's own names.

Defined cases: a NULL or empty page has the empty text; broken markup (unclosed elements, a tag cut off
at the end, stray ``<``) is read as browsers do, as far as it matters for text; NULL urls stay NULL;
repeated rows are extracted one by one; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.texts import map_texts

INLINE = frozenset(
    """a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span
    strike strong sub sup time tt u var wbr math mfrac mi mn mo mover mroot mrow ms mspace msqrt msub msubsup msup mtext munder
    object label picture output""".split()
)
SKIPPED = frozenset("script style noscript template textarea select option button iframe svg title canvas".split())
# Their content is plain text up to their own end tag, whatever it holds.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.IGNORECASE) for tag in "script style noscript textarea iframe title".split()}
FURNITURE = frozenset("head nav header footer aside form dialog menu".split())
BODY = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# These close by themselves, so an open one says nothing about what follows.
LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot html body h1 h2 h3 h4 h5 h6".split())
HINT = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|byline-links|comments?|cookies?|consent|disclaimer|footer|form|header|"
    r"login|masthead|menu|modal|nav\w*|newsletter|notice|pagination|popup|promo\w*|related|reply|replies|share|sharing|sidebar|"
    r"signup|social|sponsor\w*|subscribe|tags|teasers?|toolbar|widgets?)(?=$|[\s_-])",
    re.IGNORECASE,
)
# "with-sidebar" and "no-menu" tell how a page is laid out, not what an element holds.
LAYOUT = re.compile(r"(?:with|without|no|has|is|not|hide|show|js)[_-]", re.IGNORECASE)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+[^>]*)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    body: bool
    furniture: bool
    heading: bool


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; one pass over its tokens."""
    out: list[Block] = []
    text: list[str] = []
    linked: list[str] = []
    open_tags: list[tuple[str, bool, bool]] = []  # tag, body so far, furniture so far
    link = heading = seen_body = False
    skip = ""

    def close() -> None:
        whole = " ".join(html.unescape("".join(text)).split())
        if whole:
            _, body, furniture = open_tags[-1] if open_tags else ("", False, False)
            inside = len(html.unescape(" ".join(linked)).split())
            out.append(Block(whole, whole.count(" ") + 1, inside, body, furniture, heading))
        text.clear()
        linked.clear()

    inside_option: list[str] = []
    for token in _tokens(page):
        tag = token["tag"]
        if tag is None:
            piece = token.group()
            if not skip and not piece.startswith(("<!", "<?")):
                text.append(piece)
                if link:
                    linked.append(piece)
            continue
        tag = tag.lower()
        ends = bool(token["end"])
        if skip:
            if ends and tag == skip:
                skip = ""
                continue
            if skip != "option" or not _leaves_option(inside_option, tag, ends):
                continue
            skip = ""
        if tag in SKIPPED and not ends:
            skip = "" if token["rest"].endswith("/") else tag
            inside_option.clear()
            text.append(" ")
        elif tag in INLINE:
            if tag == "a":
                link = not ends
            elif tag in ("br", "img"):
                text.append(" ")
        else:
            close()
            link = False
            heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6") and not ends
            if ends:
                _pop(open_tags, tag)
            elif tag not in VOID and tag not in LOOSE and not token["rest"].endswith("/"):
                _, body, furniture = open_tags[-1] if open_tags else ("", False, False)
                if tag in BODY:
                    # Wrappers of the first one are the page; later ones may stand among comments or teasers.
                    furniture = furniture and seen_body
                    body = seen_body = True
                else:
                    furniture = furniture or (tag in FURNITURE and not (tag == "header" and body)) or _hinted(token["rest"])
                open_tags.append((tag, body, furniture))
            elif tag in LOOSE:
                if tag == "body":
                    _pop(open_tags, "head")
    close()
    return out


def _hinted(attributes: str) -> bool:
    """Whether a class, id or role names page furniture."""
    names = " ".join(m.group(1).strip("\"'") for m in _NAMED.finditer(attributes)).split()
    return any(HINT.search(name) and not LAYOUT.match(name) for name in names)


def _tokens(page: str) -> Iterator[re.Match]:
    """The tokens of a page; after the start tag of a raw-text element its end tag comes next, or the end of the page."""
    at, foreign = 0, ""
    while at < len(page):
        for token in _TOKEN.finditer(page, at):
            yield token
            at = token.end()
            tag = (token["tag"] or "").lower()
            if tag in ("svg", "math"):
                if token["end"]:
                    foreign = "" if tag == foreign else foreign
                elif not foreign and not token["rest"].endswith("/"):
                    foreign = tag
            if tag in RAW and not token["end"] and not token["rest"].endswith("/") and not foreign:
                end = RAW[tag].search(page, at)
                at = end.start() if end else len(page)
                break


def _leaves_option(inside: list[str], tag: str, ends: bool) -> bool:
    """Whether a tag ends an open option, whose end tag may be left out: the end of an element around it does."""
    if not ends:
        if tag not in VOID:
            inside.append(tag)
    elif tag in inside:
        del inside[len(inside) - 1 - inside[::-1].index(tag) :]
    else:
        return True
    return False


def _pop(open_tags: list[tuple[str, bool, bool]], tag: str) -> None:
    for place in range(len(open_tags) - 1, -1, -1):
        if open_tags[place][0] == tag:
            del open_tags[place:]
            return


FEATURES = [
    "words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "place", "furniture",
    "heading",
]


def features(found: list[Block]) -> np.ndarray:
    """One row per block. ``place``: 1 in an article, 0 if the page has none, -1 outside of the page's article."""
    n = len(found)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    words = np.array([b.words for b in found], dtype=float)
    density = np.array([b.linked for b in found]) / words
    out[:, 0], out[:, 1] = words, density
    out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
    body = np.array([b.body for b in found])
    out[:, 6] = np.where(body, 1, -1 if body.any() else 0)
    out[:, 7] = [b.furniture for b in found]
    out[:, 8] = [b.heading for b in found]
    return out


# The labelled table: small pages, the blocks to keep start with "+".
LABELLED = [
    """<body><nav><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></nav><article><h1>+River trails</h1>
    <p>+The path follows the water for nine miles and ends near the old mill by the bridge.</p><p>+Bring water.</p></article>
    <footer>Copyright River Club, all pages may be printed for private use only.</footer></body>""",
    """<body><div class="ad">Buy two boats today and get the third one free of any charge, only this week.</div>
    <article><h1>+Boats</h1><p>+Short.</p><p>+Wooden boats need paint every spring, and a dry place over the winter.</p></article>
    <aside>Other readers liked these five stories about boats and rivers.</aside></body>""",
    """<body><header><p>The Daily Paper, founded in the last century by four friends</p></header><main>
    <p>+The council met on Monday to talk about the new bridge and its cost for the town.</p><p>+It ended late.</p></main>
    <div class="comments"><p>I think the bridge is far too expensive for such a small town as ours.</p></div></body>""",
    """<body><div id="menu"><a href=1>Start</a> <a href=2>About us</a> <a href=3>Contact</a></div>
    <div><h2>+Soup</h2><p>+Cut the onions, fry them in butter until they are golden, add water, salt and the herbs.</p>
    <p>+Let it simmer for an hour on a low flame and stir it from time to time.</p></div>
    <div><a href=4>Imprint</a> <a href=5>Terms</a></div></body>""",
    """<body><p><a href=1>Log in</a></p><p>+Stars are born in clouds of dust and gas, and the largest of them live short lives.</p>
    <p>+Our own sun is of a middle size and has burned for some five billion years so far.</p>
    <p><a href=2>Next page</a> <a href=3>Last page</a></p><form><p>Your name and your mail address, please, to write to us.</p>
    </form></body>""",
    """<body><div class="cookie-notice">We use cookies to make this site work and to count our visitors, do you agree?</div>
    <main><article><h1>+Clocks</h1><p>+A clock counts swings.</p><ul><li>+springs</li><li>+wheels</li></ul>
    <div class="share"><a href=1>Share</a></div></article></main><footer>All about clocks, since long ago.</footer></body>""",
    """<body><div>Sponsored links</div><article><p>+Birds fly south when the days get shorter and the nights colder.</p>
    <p>+See <a href=1>the map</a> of their routes over the sea and the mountains.</p></article>
    <div>More from this site: weather, sports, and letters that our readers sent us this month</div></body>""",
    """<body><table><tr><td><a href=1>One</a></td><td><a href=2>Two</a></td></tr></table><div><p>+Every lake has a story, and
    this one is told by the people who live on its northern shore.</p></div><div><p>+It begins in spring, when the ice breaks
    and the first boats go out to fish at dawn.</p></div><div><a href=3>Page 3</a></div></body>""",
    """<body><article><p>+No.</p><p>+Yes, and then some more words about it.</p><div class="newsletter">Get our letter every
    week, free of charge and without adverts in it.</div><p>+End.</p></article><p>Printed from our site, see there.</p></body>""",
    """<body><article class="story"><h1>+Tea</h1><p>+Tea <a href=1>grows on hills</a>.</p><p><a href=2>Read more stories here</a></p>
    <p>+It needs rain.</p></article><div id="sidebar"><p>The ten stories most read by our visitors in the last month</p></div></body>""",
    """<body><nav><a href=1>Home</a></nav><article><h1>+Salt</h1><p>+Salt was once worth as much as gold.</p><p>+So they say.</p>""",
    """<p>+A page of one block, with no markup around it but the paragraph itself.</p>""",
    """<body><h1>+Bread</h1><p>+Mix flour, water, salt and yeast, let the dough rest, and bake it hot.</p><p>+Done.</p></body>""",
    """<body><article><p>+First.</p></article><div>Page 1 of 9</div></body>""",
    """<body><article><p>+Wind</p><p>+It blows.</p></article><article><p>+Rain</p></article><p>Older stories are kept in the cellar</p></body>""",
    """<body><div><a href=1>All</a> <a href=2>New</a> <a href=3>Best</a></div><div>+Iron rusts where water and air can reach it.</div></body>""",
    """<body><article><h1>+Glass</h1><p>+Sand, soda and lime are melted at a great heat until they flow like honey, and then the maker
    takes up a lump of it on a long pipe and blows.</p><p>+Hot work.</p><p>+The bubble is turned, pressed and cut while it glows,
    and it must cool for a whole day in a second and milder oven so that it does not crack.</p><p>+Slowly.</p></article></body>""",
    """<body><main><p>+Old maps show the coast as it was, with villages that the sea has taken since, one after the other, in storms
    whose dates the parish books still hold.</p><p>+Few remain.</p><p>+Divers who go down on calm days find walls, wells and once
    even the bell of a church, green with age, under three feet of sand.</p><p>+It rang.</p></main><footer>Sea Club</footer></body>""",
    """<body><div class="promo">Sale!</div><article><p>+Owls hear a mouse under the snow from the far side of a field and strike it
    without ever having seen it, in full darkness, on silent wings.</p><p>+Yes.</p><p>+No bird is better made for the night than
    the owl, whose feathers have soft edges that break up the rush of the air.</p><p>+Listen.</p></article></body>""",
    # Lines of links inside an article say nothing about its paragraphs.
    """<body><article><h1>+Slate</h1><p><a href=1>Part one</a> <a href=2>Part two</a></p><p>+Slate splits along planes that were pressed
    into it when the mountains rose, and a skilled hand gets forty sheets from a block.</p><p><a href=3>Read more about quarries</a></p>
    <p>+Roofs laid with it have lasted five hundred years and more in the wet valleys of the west.</p></article><p><a href=4>Top</a></p></body>""",
    """<body><main><p><a href=1>Overview</a></p><p>+Dew.</p><p><a href=2>Figure</a></p><p>+It settles on clear nights.</p><p><a href=3>Table</a></p>
    <p>+Grass loses its warmth to the open sky and cools below the air around it until water gathers on every blade.</p></main></body>""",
    """<body><article><p><a href=1>First chapter</a></p><p>+Oak.</p></article><div><a href=2>Next</a></div></body>""",
    """<body><article><h1>+Ice</h1><p>+It floats on water.</p></article></body>""",
    """<h1>+Tin</h1><p>+It melts early.</p>""",
    """<body><article><h1>+A walk</h1><p>+Rain.</p></article></body>""",
    # Pages without an article or a telling name: a short block goes with the blocks around it.
    """<body><div><a href=1>Home</a> <a href=2>News</a> <a href=3>Map</a></div><div>Sections</div><div><a href=4>Sport</a>
    <a href=5>Arts</a></div><div><h1>+Peat</h1><p>+Peat forms where moss dies faster than it rots, a few feet in a thousand years.</p>
    <p>+It burns.</p><p>+Cut into bricks and dried by the wind it has warmed the houses of the north since the bronze age.</p></div>
    <div><a href=6>Imprint</a></div><div>Follow us</div><div><a href=7>Letters</a> <a href=8>Contact</a></div></body>""",
    """<body><div><a href=1>All</a></div><div>Page tools</div><div><a href=2>Print</a> <a href=3>Mail</a></div><div><p>+Cork is the
    bark of an oak that grows it anew after each harvest, which comes every nine years.</p><p>+No tree is felled.</p><p>+The plates are
    boiled, pressed flat, sorted by hand and punched into stoppers along the grain.</p></div><div><a href=4>Top</a></div>
    <div>Copyright 2019</div></body>""",
    """<body><div><a href=1>Shop</a> <a href=2>Cart</a></div><div>Welcome back</div><div><a href=3>Leave</a></div>
    <div><p>+Amber is resin that has lain in the ground for forty million years or more.</p><p>+Some holds flies.</p><p>+The sea washes
    it up after autumn storms, and people walk the beaches at dawn to look for it.</p><p>+Good luck.</p></div></body>""",
    """<body><div>Main menu</div><div><a href=1>One</a> <a href=2>Two</a></div><p>+Frost splits rock because water grows as it
    freezes, and does so again every winter.</p><p>+It takes time.</p><p>+What falls from the cliff is carried off by the stream below and
    ends as sand on a far shore.</p><div><a href=3>Back</a></div><div>Search</div></body>""",
    """<body><div class="wrap"><p>+Chalk is made of shells too small to see, laid down grain by grain in a warm sea.</p><p>+White cliffs.</p>
    <p>+Rain goes through it, so rivers are rare there and the wells are deep.</p></div><div>Our partners</div>
    <div><a href=1>Mill</a> <a href=2>Quarry</a></div><div>More topics</div><div><a href=3>Clay</a> <a href=4>Slate</a></div></body>""",
    """<body class="layout with-sidebar"><form id="page"><article class="post social tags"><h1>+Felt</h1><p>+Wool that is wetted, rubbed and pressed
    turns into felt, the oldest cloth there is.</p><p>+No loom.</p><p>+Herders still make their tents of it and carry them along.</p></article>
    <p>Your mail address</p></form></body>""",
    """<body><article><h2>+Rope</h2><p>+Hemp was spun into yarn, yarn into strands, and three strands laid into a rope on a walk that
    was as long as the rope was to be, often more than a quarter of a mile.</p><p>+Men walked it backwards.</p></article></body>""",
]
DEPTH = 8


def _labelled() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in LABELLED:
        found = blocks(page)
        rows.append(features(found))
        labels += [b.text.startswith("+") for b in found]
    return np.vstack(rows), np.array(labels)


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = DEPTH) -> tuple:
    """A tree as nested tuples: ``(feature, threshold, low, high)``, leaves are the share of kept blocks."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0):
        return (share,)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            low = rows[:, feature] <= threshold
            cost = sum(m.sum() * labels[m].mean() * (1 - labels[m].mean()) for m in (low, ~low))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, feature, threshold, low)
    if best is None:
        return (share,)
    _, feature, threshold, low = best
    return (feature, float(threshold), grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1))


@lru_cache(maxsize=1)
def trained() -> tuple:
    return grow(*_labelled())


def keep(tree: tuple, rows: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(rows), tree[0] >= 0.5)
    feature, threshold, low, high = tree
    return np.where(rows[:, feature] <= threshold, keep(low, rows), keep(high, rows))


def main_text(page: str | None, tree: tuple) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n\n".join(b.text for b, kept in zip(found, keep(tree, features(found)), strict=True) if kept)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` per page. One map pass, no shuffle."""
    rows = pages.select(F.col(key).alias("_key"), F.col(url).alias("_url"), F.col(body).alias("_html"))
    tree = trained()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page.as_py(), tree) for page in batch.column("_html")]
        return pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("_url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["_key", "url", "text", "n_chars"],
        )

    kind = rows.schema["_key"].dataType.simpleString()
    return map_texts(rows, run, f"_key {kind}, url string, text string, n_chars long").withColumnRenamed("_key", key)
