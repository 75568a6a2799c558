"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks. Each block has its word count and
link density, those of its neighbours, and marks of the elements around it. A
decision tree, trained on a small table of labelled blocks, says which blocks
are main text; those are joined in page order.

The labelled blocks come from ``training_pages``: short pages written by rule, with
and without elements that name the article. Where a page marks its article, the
marks lead and the neighbours tell a menu in it from a line with a link; where it
does not, words and links of a block and its neighbours decide: a short line between
long paragraphs or on top of one is main, one behind the last is not.

Reading a page takes time in proportion to its length, whatever its markup.

Defined results: a null or empty page, or one without main blocks, gives an empty
text; null ids and urls pass through; repeated rows give a row each. Elements left
open end where an enclosing one closes; a mark without an end, in a page without any
``>`` behind it, is text; an attribute's quote without an end is an ordinary letter;
unknown character references stay as they are.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import add_columns

# Elements of the markup language.
SKIPPED = {"script", "style", "noscript", "template", "svg", "math", "head", "iframe", "object", "canvas", "audio",
           "video", "select", "textarea", "button"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template"}  # up to their own end mark
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "address", "fieldset"}
MAIN = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ITEMS = {"li", "dt", "dd", "td", "th"}
# Words in class and id that name parts which aren't the article, and parts that are; words for a
# container, which leave the naming to the word before; first words of a name that says what is beside or missing.
SIDE_WORDS = set("ad ads advert advertisement banner breadcrumb breadcrumbs byline comment comments cookie cookies consent "
                 "copyright disqus footer form header links login masthead menu meta nav navbar navigation newsletter "
                 "notice pager pagination popup promo related reply replies rss share sharing sidebar signup social "
                 "sponsor sponsored subscribe tags teaser toolbar widget".split())
MAIN_WORDS = set("article content entry main post story text body".split())
CONTAINERS = set("area articles bar block box button buttons container group inner item items list links panel posts row "
                 "section stories widget wrap wrapper".split())
BESIDE = set("has no with without is in hide show".split())

ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?|[\s/=]+")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STYLED = re.compile(r"display\s*:\s*none", re.I)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\s]+")
SPACE = re.compile(r"\s+")


def part_named(value: str) -> int:
    """1 if a class, id or role names the article, -1 if it names another part, else 0.

    Of a compound name the last word counts, or the one before a container's; a name
    of the article wins over others beside it.
    """
    found = 0
    for token in value.lower().split():
        words = [w for w in re.split(r"[^a-z]+", token) if w]
        if not words or words[0] in BESIDE:
            continue
        if len(words) > 1 and words[-1] == "header" and words[-2] in MAIN_WORDS:
            continue  # the title's own part of the article
        while len(words) > 1 and words[-1] in CONTAINERS:
            words.pop()
        if words[-1] in MAIN_WORDS:
            return 1
        found = -1 if words[-1] in SIDE_WORDS else found
    return found


class Block:
    __slots__ = ("text", "words", "linked", "side", "main", "heading", "item")

    def __init__(self, text, words, linked, side, main, heading, item):
        self.text, self.words, self.linked = text, words, linked
        self.side, self.main, self.heading, self.item = side, main, heading, item


class _Open:
    """An open element: its name, kind of part, and whether it is a link or hidden."""

    __slots__ = ("name", "kind", "link", "skipped")

    def __init__(self, name, kind, link, skipped):
        self.name, self.kind, self.link, self.skipped = name, kind, link, skipped


class _Reader:
    """Collects a page's blocks. Counts of what is open stand beside the stack, so no step walks it."""

    def __init__(self):
        self.out, self.parts, self.linked = [], [], 0
        self.stack: list[_Open] = []
        self.at: dict[str, list[int]] = {}  # depths at which elements of a name are open
        self.blocks: list[int] = []  # depths of the elements that aren't inline
        self.side = self.main = self.link = self.skipped = self.heading = self.item = 0

    def count(self, e: _Open, by: int) -> None:
        self.side += by * (e.kind == -1)
        self.main += by * (e.kind == 1)
        self.link += by * e.link
        self.skipped += by * e.skipped
        self.heading += by * (e.name in HEADINGS)
        self.item += by * (e.name in ITEMS)

    def push(self, e: _Open) -> None:
        self.at.setdefault(e.name, []).append(len(self.stack))
        if e.name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(e)
        self.count(e, 1)

    def pop(self) -> None:
        e = self.stack.pop()
        self.at[e.name].pop()
        if e.name not in INLINE:
            self.blocks.pop()
        self.count(e, -1)

    def flush(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                self.out.append(Block(text, len(WORD.findall(text)), self.linked, self.side > 0, self.main > 0, self.heading > 0, self.item > 0))
        self.parts, self.linked = [], 0

    def text(self, text: str) -> None:
        if text and not self.skipped:
            self.parts.append(text)
            if self.link:
                self.linked += len(WORD.findall(html.unescape(text)))

    def end(self, name: str) -> None:
        depths = self.at.get(name)
        # an inline end mark doesn't close the blocks around what it names
        if depths and (name not in INLINE or not self.blocks or self.blocks[-1] < depths[-1]):
            depth = depths[-1]
            while len(self.stack) > depth:
                self.pop()

    def start(self, name: str, attributes: list[tuple[str, str]]) -> None:
        if name not in INLINE:  # a new block ends inline elements, and a paragraph or item its like
            while self.stack and ((last := self.stack[-1].name) in INLINE or last == "p" or last == name and name in ITEMS | {"tr", "option"}):
                self.pop()
        kind = 1 if name in MAIN else -1 if name in ASIDE else 0
        skipped = name in SKIPPED
        if name not in ("html", "body"):
            names = " ".join(v for a, v in attributes if a in ("class", "id", "role"))
            named = part_named(names)
            # an element of the article stays one; its own header, if nothing else is said, is part of it
            kind = kind if kind == 1 else named or kind
            if name == "header" and self.main and not names:
                kind = 0
            skipped = skipped or any(a == "hidden" or a == "aria-hidden" and v.strip().lower() == "true" or a == "style" and STYLED.search(v)
                                     for a, v in attributes)
        self.push(_Open(name, kind, name == "a", skipped))


def blocks_of(page: str | None) -> list[Block]:
    """The flat text blocks of a whole page, in page order."""
    if not page:
        return []
    read, at, n = _Reader(), 0, len(page)
    last_end = page.rfind(">")  # behind it no mark ends
    while at < n:
        mark = page.find("<", at)
        if mark < 0 or mark > last_end:
            read.text(page[at:])
            break
        read.text(page[at:mark])
        at = mark + 1
        if page.startswith("!--", at):
            end = page.find("-->", at + 3)
            at = end + 3 if end >= 0 else n
            continue
        if page.startswith("![CDATA[", at):
            end = page.find("]]>", at)
            read.text(html.escape(page[at + 8:end if end >= 0 else n]))
            at = end + 3 if end >= 0 else n
            continue
        if page[at] in "!?":
            at = page.find(">", at) + 1
            continue
        closing = page[at] == "/"
        found = NAME.match(page, at + closing)
        if not found:
            read.text("<")
            continue
        name, attributes, at, last = found[0].lower(), [], found.end(), ""
        while at < n and page[at] != ">":
            a = ATTRIBUTE.match(page, at)
            at, last = a.end(), a[0][-1]
            if a[1]:
                attributes.append((a[1].lower(), a[2] or a[3] or a[4] or ""))
        at += 1
        if name not in INLINE:
            read.flush()
        elif name == "br":
            read.text(" ")
        if closing:
            read.end(name)
        elif name in RAW and last != "/":
            end = re.compile(f"</{re.escape(name)}\\s*>", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and last != "/":
            read.start(name, attributes)
    read.flush()
    return read.out


FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", "prose_before", "prose_after",
            "side", "main", "marked", "heading", "item"]
#: Blocks on either side among which the longest prose is looked for.
NEAR = 4


def features_of(blocks: list[Block]) -> np.ndarray:
    """One row per block: words and link density of it and its neighbours, the longest prose near it, and its place.

    ``prose_before`` and ``prose_after``: most words without links of ``NEAR`` blocks before and after;
    ``marked``: some block of the page lies in an element that names the article.
    """
    n = len(blocks)
    out = np.zeros((n, len(FEATURES)))
    if n:
        words = np.array([b.words for b in blocks], float)
        linked = np.array([b.linked for b in blocks], float)
        density = linked / np.maximum(words, 1)
        prose = np.where([b.side for b in blocks], 0, words - linked)
        out[:, 0], out[:, 1] = words, density
        out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
        out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
        for k in range(1, min(NEAR, n - 1) + 1):
            out[k:, 6] = np.maximum(out[k:, 6], prose[:-k])
            out[:-k, 7] = np.maximum(out[:-k, 7], prose[k:])
        out[:, 8:] = [[b.side, b.main, False, b.heading, b.item] for b in blocks]
        out[:, 10] = any(b.main and not b.side for b in blocks)
    return out


def training_pages() -> list[tuple[str, set[str]]]:
    """Small pages by rule, with the texts that are main: the labelled table's source."""
    pages = []
    prose = lambda k, n: " ".join(f"{'abcdefgh'[k % 8]}{i}" for i in range(n))
    links = lambda k, n: "".join(f"<li><a href='/{i}'>{prose(k, 1 + i % 3)}x{i}</a></li>" for i in range(n))
    row = lambda k: "<div>" + " | ".join(f"<a href='/{i}'>{prose(k, 1 + (k + i) % 2)}r{i}</a>" for i in range(1 + k % 5)) + "</div>"
    sides = ("<nav><ul>{l}</ul></nav>", "<div class='ad'>{t}</div>", "<aside><p>{t}</p></aside>", "<footer>{t}</footer>",
             "<div class='cookie-notice'><p>{t}</p></div>", "<section id='comments'><p>{t}</p></section>",
             "<div class='comment-list'><article><p>{t}</p></article></div>", "<form><p>{t}</p></form>", "<div class='sidebar'><ul>{l}</ul></div>", "<header><p>{t}</p></header>")
    holders = ("<article>{}</article>", "<main>{}</main>", "<div class='entry-content'>{}</div>", "<article class='post share'>{}</article>")
    for k in range(150):  # pages that name the article
        rng = random.Random(k)
        size = lambda rng=rng: rng.choice((rng.randint(1, 8), rng.randint(1, 30), rng.randint(20, 160)))
        text = lambda n, salt, k=k: f"{prose(k, n - 1)} z{k}{salt}".strip()
        before, after, between = (sides[(k + i) % len(sides)].format(l=links(k, 2 + k % 5), t=text(size(), f"s{i}")) for i in (0, 3, 5))
        main = [text(1 + k % 9, "h"), *[text(size(), f"m{i}") for i in range(1 + k % 7)]]
        inside = sides[(k + 7) % len(sides)].format(l=links(k, 4), t=text(size(), "i")) if k % 2 else ""
        if k % 4 == 0:
            main.insert(1 + k % len(main), "* * *")
        body = [f"<p>{t}</p>" for t in main[1:]]
        if k % 5 == 0:  # a line that is a link, and a menu without a name
            main += [text(1 + k % 4, "k"), text(size(), "e")]
            body += [f"<p><a href='#'>{main[-2]}</a></p>", f"<p>{main[-1]}</p>", f"<ul>{links(k, 5)}</ul>"]
        stray = f"<p>{text(size(), 'o')}</p>" if k % 3 == 0 else ""
        pages.append((f"{before}{stray}{holders[k % 4].format(f'<h1>{main[0]}</h1>' + inside + ''.join(body))}{between}{stray}{after}{row(k) if k % 3 else ''}", set(main)))
    shorts = (2, 1, 6, 3, 9, 4)
    for k in range(90):  # pages of plain elements
        text = lambda n, salt, k=k: f"{prose(k, n - 1)} y{k}{salt}".strip()
        wrap = ("<div>{}</div>", "<p>{}</p>", "<td>{}</td>")[k % 3]
        title = text(shorts[k % 6] + 1, "t")
        body, main = [], {title}
        for i in range(2 + k % 4):  # long paragraphs, with up to two short ones between
            body.append(text(18 + (k * 13 + i * 29) % 70, f"p{i}"))
            if i < 1 + k % 4:
                body += [text(shorts[(k + i + j) % 6], f"q{i}{j}") for j in range((k + i) % 3)]
        main |= set(body)
        top = ("", f"<ul>{links(k, 3 + k % 5)}</ul>", row(k), row(k) + f"<ul>{links(k, 4)}</ul>")[k % 4]
        heading = f"<h1>{title}</h1>" if k % 2 else wrap.format(title)
        tail = [text((6, 5, 3, 8, 2)[(k + i) % 5], f"f{i}") for i in range(k % 4)]
        middle = f"<ul>{links(k, 4)}</ul>" if k % 3 == 0 else ""
        pages.append((f"<body>{top}{heading}{''.join(map(wrap.format, body))}{middle}{''.join(map(wrap.format, tail))}</body>", main))
    return pages


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page, main in training_pages():
        blocks = blocks_of(page)
        x.append(features_of(blocks))
        y += [b.text in main for b in blocks]
    return np.vstack(x), np.array(y)


class Tree:
    """Binary decision tree by Gini impurity; ``predict`` walks all rows at once."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 9, least: int = 2):
        self.left = self.right = None
        self.value = bool(2 * y.sum() > len(y))
        if depth == 0 or y.all() or not y.any():
            return
        best = (self._impurity(y) - 1e-9, None, None)
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, j] <= cut
                if least <= low.sum() <= len(y) - least:
                    score = (self._impurity(y[low]) * low.sum() + self._impurity(y[~low]) * (~low).sum()) / len(y)
                    if score < best[0]:
                        best = (score, j, cut)
        _, self.feature, self.cut = best
        if self.feature is not None:
            low = x[:, self.feature] <= self.cut
            self.left = Tree(x[low], y[low], depth - 1, least)
            self.right = Tree(x[~low], y[~low], depth - 1, least)

    @staticmethod
    def _impurity(y: np.ndarray) -> float:
        p = y.mean()
        return 2 * p * (1 - p)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.left is None:
            return np.full(len(x), self.value)
        low = x[:, self.feature] <= self.cut
        out = np.empty(len(x), bool)
        out[low], out[~low] = self.left.predict(x[low]), self.right.predict(x[~low])
        return out


def train_tree() -> Tree:
    return Tree(*labelled_table())


def main_text(page: str | None, tree: Tree) -> str:
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, keep in zip(blocks, tree.predict(features_of(blocks))) if keep)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; columns of these names are replaced."""
    tree = train_tree()

    def make():
        def run(column):
            texts = [main_text(p, tree) for p in column.to_pylist()]
            return [texts, [len(t) for t in texts]]
        return run

    return add_columns(pages, [html_col], [("text", T.StringType()), ("n_chars", T.LongType())], make)


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", "n_chars")
