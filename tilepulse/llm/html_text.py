"""Main text of web pages by two-pass block rules (operator 3).

A page is cut into blocks at block-level tags. Each block has its length in words (in scripts
without blanks two characters count as a word), the share of it inside links, the share of stop
words (there: of function characters), and whether it lies in an article (``article`` or
``main``) or in boilerplate: a tag such as ``nav``, ``footer``, ``aside`` or ``form``, or a
class or id naming a menu, header, sidebar, notice, advert or comments. Some names are a hint
only: ids of headings say nothing; inside an article, ids and classes of several words (slugs
such as ``related-work``, ``section-header``) and single words that articles use too, but not
compounds whose head names furniture (``user-comments``, ``cookie-notice``) or that say of which
furniture they are the list, box or section (``related-posts``, ``comments-section``); outside
one, ids of sections and paragraphs, unless they name page furniture outright.

Pass 1: boilerplate and link-heavy blocks are bad; long blocks dense in stop words are good;
headings and short blocks are undecided, and so are blocks of an article that are poor in stop
words (tables of names, foreign words) and what has a hint, unless long and dense in stop words
(good) or link-heavy (bad, but for paragraphs); outside an article long blocks without stop words
are bad. Pass 2: an undecided block is good if its nearest decided neighbours are, bad if a side is
bad. Where one side has none, the other decides for paragraphs and inside an article; a heading
goes with what follows; without any, a block is good inside an article or a paragraph.
Neighbours count within the block's own region only (one article, or what is outside). Blocks of
boilerplate elements, and link lists inside an article, are no neighbours: an advert between two
paragraphs says nothing about them.

Character references are decoded, white space in a block becomes one space, blocks keep page
order, two are joined by an empty line (two newlines).

Defined cases: null or empty html gives an empty text; null ids and urls stay null; repeated
rows give repeated results; other columns are not read; unclosed tags end with their parent or
the page; an unclosed script, style or comment runs to the page's end. Time is linear in the
page, whatever its tags.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

LONG_WORDS, STOP_DENSITY, LINK_DENSITY = 12, 0.15, 0.34

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+|[^<>]*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"(?i)\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
RAW = frozenset("script style noscript template textarea title svg math iframe object select xmp".split())
#: Of these, an unclosed one hides the rest of the page; others end with their parent.
TO_THE_END = frozenset(("script", "style"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset(("article", "main"))
BAD_TAG = frozenset("nav footer aside form button menu dialog head fieldset label input header".split())
BAD_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
BAD_NAME = re.compile(
    r"(?i)(?:^|[\s_-])(?<!has[-_])(?<!with[-_])(?<!no[-_])(?:ads?|adverts?|advert(?:isement|ising)|sponsor(?:ed)?|promo(?:tion)?s?|banner|nav|navbar|navigation|menu|"
    r"breadcrumbs?|header|masthead|footer|sidebar|widget|related|recommended|share|sharing|social|comments?|"
    r"commentlist|respond|replies|reply|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|search|pagination|pager|copyright|legal|disclaimer|skip|toolbar)(?:$|[\s_-]|\d)"
)
#: Whole classes and ids that name page furniture and adverts, inside an article too.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promos promotion promotions banner nav "
    "navbar navigation menu breadcrumb breadcrumbs masthead footer sidebar widget share social comments commentlist "
    "respond replies cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login pagination "
    "pager toolbar skip".split()
)
#: Last words of compound classes (and, of these, of ids) that name furniture inside an article.
HEADS = frozenset(
    "ad ads advert adverts advertisement advertisements banner comments replies respond cookie cookies consent notice "
    "notices popup modal overlay newsletter subscribe signup login share sharing social sidebar footer nav navbar "
    "navigation menu breadcrumb breadcrumbs pagination pager promo promos promotion sponsor sponsored widget toolbar".split()
)
ID_HEADS = frozenset("comments replies respond newsletter popup modal sidebar breadcrumbs pagination navbar".split())
#: First and last words of compounds that name a list, box or section of furniture.
OWNERS = frozenset(
    "related recommended share sharing social comment comments cookie cookies ad ads advert newsletter sponsor sponsored "
    "promo nav menu sidebar subscribe signup popup".split()
)
PLACES = frozenset(
    "posts articles stories links section list lists area box block wrapper container wrap bar buttons button form thread "
    "items panel row inner outer holder slot unit".split()
)
ARTICLE_HEADER = re.compile(r"(?i)article|entry|post|story|content")
# Common stop words of the four languages.
STOP = frozenset(
    "the of and to in is that it for was on are as with they be at this have from or by not but what all were we when "
    "your can there an which their if will he she you his her its a "
    "de la le et les des en un une du que est pour qui dans par plus pas au sur ne se ce il elle sont avec ou aux son "
    "der die und das den von zu mit sich des auf ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
    "nach wird bei einer um am sind noch wie einem über el y los las del con no por su para al lo como más o pero sus "
    "le ha si sin sobre este ya entre cuando muy".split()
)
# Characters of Chinese and Japanese function words.
STOP_CHARACTERS = frozenset("的了是在不和有这那我他她们也就都与及之而为于以对の に は を が で と も た て し れ さ ま す な い る".replace(" ", ""))
CHARACTER_DENSITY = 0.08
NO_BLANKS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
PUNCTUATION = ".,;:!?\"'()[]{}#*$%&|<>-/"


class _Block:
    __slots__ = ("parts", "link_chars", "chars", "tag", "bad", "region", "hint")

    def __init__(self, tag: str, bad: bool, region: int, hint: bool):
        self.parts, self.link_chars, self.chars = [], 0, 0
        self.tag, self.bad, self.region, self.hint = tag, bad, region, hint

    @property
    def heading(self) -> bool:
        return self.tag in HEADING


def _is_bad(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is boilerplate, and whether a name hints at it. A header inside an
    article is the article's own heading."""
    if tag in BAD_TAG and not (tag == "header" and in_article):
        return True, False
    hint = False
    if not attributes or attributes.isspace():
        return False, hint
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True, hint
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, hint
        if name == "role" and value.lower() in BAD_ROLE:
            return True, hint
        if name in ("class", "id") and tag not in ("html", "body", *HEADING) and _compound(name, value):
            if in_article or name == "class":
                return True, hint
        if name in ("class", "id") and tag not in ("html", "body") and BAD_NAME.search(value):
            if ARTICLE_HEADER.search(value) and "header" in value.lower():  # the text's own heading
                continue
            if name == "id" and tag in HEADING:
                continue
            weak = in_article or name == "id" and tag in ("section", "p")
            if not weak or not FURNITURE.isdisjoint(value.lower().split()):
                return True, hint
            hint = True
    return False, hint


def _compound(name: str, value: str) -> bool:
    """Whether a class or id of several words names furniture by its head, or by what it is the
    list, box or section of."""
    for token in value.split():
        words = [w.lower() for w in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", token) if w]
        if len(words) > 1 and words[0] not in ("has", "with", "no"):
            if words[-1] in (ID_HEADS if name == "id" else HEADS):
                return True
            if words[-1] in PLACES and not OWNERS.isdisjoint(words[:-1]):
                return True
    return False


class _Open:
    """The open elements: (tag, bad, region, hint, links, mute), and how many there are of each tag,
    in all and since the last block-level one, so that an end tag without a start costs nothing."""

    def __init__(self):
        self.stack: list[tuple] = [("", False, 0, False, 0, False)]
        self.count: Counter = Counter()
        self.inline: list[Counter] = [Counter()]

    @property
    def top(self) -> tuple:
        return self.stack[-1]

    def push(self, element: tuple) -> None:
        self.stack.append(element)
        if element[0] in BLOCK:
            self.count[element[0]] += 1
            self.inline.append(Counter())
        else:
            self.inline[-1][element[0]] += 1

    def pop(self) -> str:
        tag = self.stack.pop()[0]
        if tag in BLOCK:
            self.count[tag] -= 1
            self.inline.pop()
        else:
            self.inline[-1][tag] -= 1
        return tag

    def close(self, tag: str) -> None:
        """End the innermost element of the tag and all inside it; an inline one only if no block
        has begun in it."""
        if (self.count if tag in BLOCK else self.inline[-1])[tag]:
            while self.pop() != tag:
                pass


class _Ends:
    """Where the next end tag of a name is; looked for once per place, so in linear time."""

    def __init__(self, page: str):
        self.page, self.at = page, {}

    def next(self, tag: str, start: int) -> re.Match | None:
        held = self.at.get(tag, False)
        if held is False or held is not None and held.start() < start:
            held = self.at[tag] = re.compile(rf"(?i)</{re.escape(tag)}\s*>").search(self.page, start)
        return held


def blocks(page: str) -> list[_Block]:
    """The page's blocks, in order."""
    out: list[_Block] = []
    open_, ends = _Open(), _Ends(page)
    regions, at = 0, 0
    now = _Block("", False, 0, False)

    def cut() -> None:
        nonlocal now
        if now.chars:
            out.append(now)
        now = _Block(*open_.top[:4])

    def add(text: str) -> None:
        if open_.top[5]:
            return
        n = len(text) - text.count(" ")
        now.parts.append(text)
        if n and not text.isspace():
            now.chars += n
            if open_.top[4]:
                now.link_chars += n

    m = TOKEN.search(page)
    while m:
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        muted = open_.top[5]
        if tag and not m[1]:
            if tag in RAW and not m[3].rstrip().endswith("/"):
                close = ends.next(tag, at)
                parent = None if tag in TO_THE_END else ends.next(open_.top[0] or "body", at)
                if close and not (parent and parent.start() < close.start()):
                    at = close.end()
                elif tag in TO_THE_END:
                    at = len(page)
                else:  # not closed within its parent: hidden up to the parent's end
                    open_.push((tag, *open_.top[1:5], True))
            elif tag in ("br", "hr"):
                if tag == "hr" and not muted:
                    cut()
                elif not muted:
                    now.parts.append(" ")
            elif tag == "body":  # ends whatever the head left open
                while len(open_.stack) > 1 and open_.top[0] != "html":
                    open_.pop()
                _, bad, region, hint, links, mute = open_.top
                own, named = _is_bad(tag, m[3], False)
                open_.push((tag, bad or own, region, hint or named, links, mute))
                cut()
            elif tag not in VOID:
                if tag == "p" and any(x[0] == "p" for x in open_.stack[-3:]):
                    while open_.pop() != "p":
                        pass
                if tag in ("li", "dt", "dd", "td", "th", "tr", "option") and open_.top[0] == tag:
                    open_.pop()
                _, bad, region, hint, links, mute = open_.top
                own, named = _is_bad(tag, m[3], region > 0)
                bad, hint = bad or own, hint or named
                if tag in ARTICLE and not bad and not region:
                    regions += 1
                    region = regions
                open_.push((tag, bad, region, hint, links + (tag == "a"), mute))
                if tag in BLOCK and not mute:
                    cut()
        elif tag:
            open_.close(tag)
            if tag in BLOCK and not open_.top[5]:
                cut()
        m = TOKEN.search(page, at)
    if at < len(page):
        add(page[at:])
    cut()
    return out


def _measure(text: str) -> tuple[int, bool]:
    """A block's length in words, and whether it is dense in stop words (both by characters where
    most of it is in a script without blanks)."""
    unspaced = len(NO_BLANKS.findall(text))
    words = text.lower().split(" ")
    if 2 * unspaced > len(text):
        return len(words) + unspaced // 2, sum(c in STOP_CHARACTERS for c in text) >= CHARACTER_DENSITY * unspaced
    return len(words), sum(w.strip(PUNCTUATION) in STOP for w in words) >= STOP_DENSITY * len(words)


def main_text(page: str) -> str:
    """The page's main text (see the module's text)."""
    found = []
    for b in blocks(page):
        text = "".join(b.parts)
        text = " ".join((_html.unescape(text) if "&" in text else text).split())
        if text:
            found.append((b, text))
    labels: list[bool | None] = []
    for b, text in found:
        length, dense = _measure(text)
        if b.bad:
            labels.append(False)
        elif b.link_chars > LINK_DENSITY * b.chars:
            labels.append(None if b.region and not b.hint and (length < LONG_WORDS or b.tag == "p") else False)
        elif b.heading or length < LONG_WORDS:
            labels.append(None)
        elif dense:
            labels.append(True)
        else:
            labels.append(None if b.region else False)
    return "\n\n".join(text for (_, text), good in zip(found, _inherited(found, labels), strict=True) if good)


def _inherited(found: list, labels: list[bool | None]) -> list[bool]:
    """Pass 2, linear: the nearest decided label before and after, within the region."""

    def nearest(order) -> list[bool | None]:
        last: dict[int, bool] = {}
        got: list[bool | None] = [None] * len(found)
        for i in order:
            b = found[i][0]
            got[i] = last.get(b.region)
            if labels[i] is not None and not b.bad and (labels[i] or not b.region):
                last[b.region] = labels[i]
        return got

    before, after = nearest(range(len(found))), nearest(range(len(found) - 1, -1, -1))
    out = []
    for (b, _), own, x, y in zip(found, labels, before, after, strict=True):
        if b.heading:
            x = y
        if own is not None:
            out.append(own)
        elif x is None and y is None:
            out.append(b.region > 0 or b.tag == "p")
        elif x is None or y is None:
            out.append(bool(x or y) and (b.region > 0 or b.tag == "p"))
        else:
            out.append(x and y)
    return out


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars`` (its code points)."""
    small_batches(pages.sparkSession)
    schema = pages.select(F.col(id_col), F.col(url_col)).schema

    def run(batches):
        for b in batches:
            texts = [main_text(h or "") for h in b.column(2).to_pylist()]
            counts = pa.array([len(t) for t in texts], pa.int64())
            cols = [b.column(0), b.column(1), pa.array(texts, pa.string()), counts]
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, url_col, "text", "n_chars"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(run, f"{kept}, text string, n_chars bigint")
