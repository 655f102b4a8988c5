"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. What stands in menus, footers,
sidebars, notices, adverts, forms and comments, told by tag, role, class or id,
is no block at all. A form that holds the article, or long text rich in stop
words, is part of the page and only its controls go. A menu or the like that is
never closed ends where an article begins, and a link that is never closed ends
with the block it is in. The first pass decides a block by its length, its
density of stop words and its density of links:

- in the page's article: content when it is long, has stop words or is a
  paragraph of links; a short list item of links is boilerplate;
- many linked characters or a copyright mark elsewhere: boilerplate;
- outside an article: content when it is long and rich in stop words, else
  boilerplate when it is long and poor in them;
- short blocks are left open.

The second pass gives an open block the label of the nearest decided neighbour
(the earlier one where two are as near) in the same part of the page; without
one, a block of an article is content and any other is boilerplate.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by a line feed. Nothing is cut or capped.

Defined cases: a null or empty page has an empty text; a page without an end or
with unclosed tags is read as far as it goes; every input row gives a row;
other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINKED = 0.4
SHORT, LONG = 70, 200
LOW, HIGH = 0.15, 0.30

# Common words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
a an and are as at be been but by can for from had has have he her his i in is it its not of on or
she that the their them they this to was we were which who will with you
aber als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer es
für hat ich im in ist mit nach nicht noch nur oder sein sich sie sind so über um und von vor war wie
wird zu zum zur
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on
ou où par pas plus pour qu que qui sa se ses son sont sur un une vous été être
al como con de del desde donde el ella en entre era es esta este fue ha hay la las lo los más muy no
nos o para pero por que se ser si sin sobre su sus también un una uno y ya
""".split())

SILENT = frozenset("""script style noscript template svg math iframe object embed canvas video audio
select option button textarea title head map""".split())
RAW = frozenset(["script", "style", "textarea", "title", "noscript", "iframe", "template"])
BOILERPLATE = frozenset(["nav", "footer", "aside", "dialog", "menu"])
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
MAIN = frozenset(["article", "main"])
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark
q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img""".split())
ROLES = frozenset("""navigation banner contentinfo complementary search form menu menubar alert
dialog alertdialog""".split())
# Words of class and id that name what is not the article.
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor
sponsored promo promos promotion promoted banner banners cookie cookies consent gdpr notice notices
alert popup modal overlay newsletter subscribe subscription signup sidebar sidebars aside widget
widgets menu menus nav navbar navigation breadcrumb breadcrumbs masthead topbar footer comment comments
commentlist disqus respond reply replies share sharing social related recommended recommendations
trending popular pagination pager toolbar login search copyright legal disclaimer outbrain taboola
""".split())
KEPT_NAMES = frozenset("article content main post entry story body page container wrapper".split())
# These count also beside the names above; in headings and inside a line only adverts do.
ADVERTS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor
sponsored outbrain taboola""".split())
STRONG_NAMES = ADVERTS | frozenset("""comment comments commentlist disqus respond reply replies sidebar
sidebars cookie cookies consent gdpr nav navbar navigation menu menus breadcrumb breadcrumbs footer
newsletter popup modal pagination pager login""".split())
# A word of these makes a class say what the page has or lacks, not what the element is.
LAYOUT_NAMES = frozenset("no has have with without hide is layout".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[A-Za-z!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[^\W\d_]+")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """A block of text, the characters of it in links, and the part of the page it is in."""

    text: str
    linked: int
    part: int
    main: bool
    tag: str = ""
    form: int = 0


@dataclass
class _Open:
    name: str
    drops: bool = False
    part: int = 0
    main: bool = False
    form: int = 0


@dataclass
class _Reader:
    """Reads the tags of a page into blocks."""

    html: str = ""
    blocks: list[Block] = field(default_factory=list)
    stack: list[_Open] = field(default_factory=lambda: [_Open("")])
    parts: int = 0
    forms: int = 0
    # Forms that hold an article of the page.
    holding: set[int] = field(default_factory=set)
    # Open links: how deep the stack and in which paragraph each began.
    links: list[tuple[int, int]] = field(default_factory=list)
    paragraph: int = 0
    tag: str = ""
    texts: list[tuple[str, bool]] = field(default_factory=list)
    _marks: dict[str, tuple[list[int], list[int]]] = field(default_factory=dict)

    def flush(self) -> None:
        pieces, self.texts = self.texts, []
        text = " ".join(unescape("".join(p for p, _ in pieces)).split())
        if text:
            linked = sum(len("".join(unescape(p).split())) for p, link in pieces if link)
            top = self.stack[-1]
            self.blocks.append(Block(text, linked, top.part, top.main, self.tag or top.name, top.form))

    def start(self, name: str, rest: str, at: int) -> None:
        if name == "a" and not self.stack[-1].drops:
            if re.search(r"\bhref\b", rest, re.I):
                self.links.append((len(self.stack), self.paragraph))
            if not self._drops_inline(rest):
                return
        if name == "br":
            self.texts.append((" ", False))
        if name in VOID or name in INLINE:
            top = self.stack[-1]
            if name == "hr":
                self.flush()
            elif name not in VOID and (rest and self._drops_inline(rest) or top.drops and top.name == name):
                self.stack.append(_Open(name, True, top.part, top.main, top.form))
            return
        if self.stack[-1].name == "p":
            # A dropped paragraph ends where a block begins.
            self.stack.pop()
        if not self.stack[-1].drops:
            self.flush()
        if name in MAIN:
            self._close_forgotten(at)
        top = self.stack[-1]
        if name == "p":
            self._next_paragraph()
            self.tag = "p"
            if not top.drops and self._drops(name, rest, top.main):
                self.stack.append(_Open(name, True, top.part, top.main, top.form))
            return
        self.tag = ""
        new = _Open(name, top.drops or self._drops(name, rest, top.main), top.part, top.main, top.form)
        if name == "form" and not new.drops:
            # Inside an article a form is none of it.
            self.forms += 1
            new.drops, new.form = top.main, self.forms
        if name in MAIN and not top.main and not new.drops:
            self.parts += 1
            new.part, new.main = self.parts, True
            self.holding |= {entry.form for entry in self.stack if entry.form}
        if not rest.rstrip().endswith("/"):
            self.stack.append(new)

    def end(self, name: str) -> None:
        if name == "a" and self.stack[-1].name != "a":
            if self.links:
                self.links.pop()
            return
        if name not in INLINE and not self.stack[-1].drops:
            self.flush()
        if name == "p":
            self._next_paragraph()
        if name not in INLINE:
            self.tag = ""
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at].name == name:
                del self.stack[at:]
                self.links = [link for link in self.links if link[0] <= at]
                return

    def _next_paragraph(self) -> None:
        """Links that began in the paragraph that ends here end with it."""
        self.links = [link for link in self.links if link[1] != self.paragraph or not self.tag]
        self.paragraph += 1

    def _close_forgotten(self, at: int) -> None:
        """Close what drops an article that begins here, if it is never closed itself."""
        for place in range(1, len(self.stack)):
            if self.stack[place].drops:
                name = self.stack[place].name
                if name not in self._marks:
                    found = [(m.start(), m[1] == "/") for m in re.finditer(rf"<(/?){re.escape(name)}\b", self.html, re.I)]
                    self._marks[name] = [p for p, end in found if not end], [p for p, end in found if end]
                opens, ends = self._marks[name]
                if len(ends) - bisect(ends, at) <= len(opens) - bisect(opens, at):
                    del self.stack[place:]
                    self.links = [link for link in self.links if link[0] <= place]
                return

    def _hidden(self, rest: str) -> bool:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
        style = found.get("style", "").replace(" ", "").lower()
        return "hidden" in found or "display:none" in style or found.get("aria-hidden") == "true"

    def _names(self, rest: str) -> list[set[str]]:
        """The words of each class and of the id."""
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
        return [{w.lower() for w in NAME_PARTS.findall(token)}
                for key in ("class", "id") for token in found.get(key, "").split()]

    def _drops_inline(self, rest: str) -> bool:
        return bool(rest) and (self._hidden(rest) or any(words & ADVERTS for words in self._names(rest)))

    def _drops(self, name: str, rest: str, main: bool) -> bool:
        if name in BOILERPLATE or name in SILENT or name == "header" and not main:
            return True
        if not rest or name in ("html", "body"):
            return False
        if self._hidden(rest):
            return True
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
        if found.get("role", "").lower() in ROLES and name != "form":
            return True
        tokens = [words for words in self._names(rest) if not words & LAYOUT_NAMES]
        words = set().union(*tokens)
        if name == "main" or name == "article" and not words & {"comment", "comments", "ad", "promo"}:
            return False
        if name in HEADINGS and main:
            return bool(words & ADVERTS)
        if words & STRONG_NAMES:
            return True
        return bool(words & NAMES) and not words & KEPT_NAMES - {"post", "body", "content"} or (
            "header" in words and not main)


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page, without what its tags tell to be no part of the article."""
    reader = _Reader(html)
    at = 0
    while True:
        found = TOKEN.search(html, at)
        text = html[at:found.start() if found else len(html)]
        if text and not reader.stack[-1].drops:
            reader.texts.append((text, bool(reader.links)))
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["close"]:
            reader.end(name)
            continue
        if name in RAW:
            # Until its own end tag, nothing in it is a tag.
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(html, at)
            at = close.end() if close else len(html)
            continue
        reader.start(name, found["rest"] or "", at)
    reader.flush()
    holding = reader.holding | {
        b.form for b in reader.blocks if b.form and len(b.text) >= LONG and first_pass(b)}
    return [b for b in reader.blocks if not b.form or b.form in holding]


def first_pass(block: Block) -> bool | None:
    """Content, boilerplate, or None for open."""
    length = len(block.text)
    if block.main and block.linked > LINKED * length:
        return not (block.tag in ("li", "td", "dd", "dt") and length < SHORT)
    if not block.main and (block.linked > LINKED * length or "©" in block.text and length < LONG):
        return False
    words = WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    if block.main:
        return True if length >= SHORT or stops >= LOW else None
    if length < SHORT:
        return None
    if stops >= HIGH or length >= LONG and stops >= LOW:
        return True
    return False if stops < LOW else None


def labels(blocks: list[Block]) -> list[bool]:
    """Content or not, after both passes."""
    decided = [first_pass(b) for b in blocks]
    near: list[tuple[int, bool] | None] = [None] * len(blocks)
    for order in (range(len(blocks)), range(len(blocks) - 1, -1, -1)):
        last: dict[int, tuple[int, bool]] = {}
        for at in order:
            part = blocks[at].part
            if decided[at] is not None:
                last[part] = at, decided[at]
            elif part in last:
                where, label = last[part]
                if near[at] is None or abs(where - at) < near[at][0]:
                    near[at] = abs(where - at), label
    return [d if d is not None else n[1] if n else b.main
            for d, n, b in zip(decided, near, blocks)]


def main_text(html: str | None) -> str:
    """The main text of a page; empty if none."""
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, keep in zip(blocks, labels(blocks)) if keep)


def extract(pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: id, url, text and n_chars, its code points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id, "url": url})
