"""Main text of web pages: flat text blocks, their neighbours' measures, and a decision tree."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from uptake.llm.common import chunks

# What the tags mean.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style head noscript template svg math iframe object select textarea canvas audio video".split())
RAW = frozenset("script style textarea title noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset("article main".split())
BESIDE = frozenset("nav aside footer form menu dialog button fieldset".split())
# Names that put an element beside the main text, whatever it holds.
STRONG_NAMES = frozenset("ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus gdpr masthead menu modal nav navbar navigation newsletter pagination popup promo related replies share sharing sidebar social sponsor sponsored subscribe toolbar".split())
# Names that do so unless the article itself lies inside; as part of a longer name only at its end.
WEAK_NAMES = frozenset("discussion foot footer form header notice promotion reply respond side widget".split())
# Endings that say nothing of their own, and what a header of the article itself starts with.
PLAIN_ENDS = frozenset("area bar block box container content inner list outer section wrap wrapper".split())
TITLE_STARTS = frozenset("article entry post story".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
_BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
# Comments, or a tag with its attributes; a quoted attribute may hold ">".
_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z|[\"'][^>]*(?:>|\Z))|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NAME_PARTS = re.compile(r"[-_]+|(?<=[a-z])(?=[A-Z])")
_GAP = re.compile(r"\s+")


@dataclass
class Block:
    """A flat run of text between block-level tags. ``where``: its place."""

    text: str
    words: int
    linked: int
    where: int
    heading: bool

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


#: Places: the main part, unknown, beside it unless the article lies inside, beside it for certain.
INSIDE, UNKNOWN, BESIDE_WEAKLY, BESIDE_SURELY = 1, 0, -1, -2


def _named(value: str) -> int:
    """The place that a class or id tells of. Names count as whole tokens, by their first and last parts, never inside a word."""
    place = UNKNOWN
    for token in value.split():
        parts = [part.lower() for part in _NAME_PARTS.split(token) if part]
        while len(parts) > 1 and parts[-1] in PLAIN_ENDS:
            parts.pop()
        if not parts or parts[0] in ("has", "no", "with", "without") or parts[0] in TITLE_STARTS and parts[-1] in ("content", "header"):
            continue
        if parts[0] in STRONG_NAMES or parts[-1] in STRONG_NAMES:
            return BESIDE_SURELY
        if parts[-1] in WEAK_NAMES:
            place = BESIDE_WEAKLY
    return place


def _place(name: str, rest: str, around: int) -> int:
    """The place of an element: the least that its tag, names, role and attributes tell, else as around it.

    The outermost article or main part is inside even where weakly named wrappers enclose it.
    """
    told = UNKNOWN
    if name in BESIDE or name == "header" and around != INSIDE:
        told = BESIDE_WEAKLY if name == "form" else BESIDE_SURELY
    main = name in MAIN
    for key, value in _ATTRIBUTE.findall(rest) if rest else ():
        key, value = key.lower(), value.strip("\"'")
        if key in ("class", "id") and name not in ("body", "html", "main"):
            found = _named(value)
            # An article of a weak name is an article still.
            told = min(told, found if name != "article" or found == BESIDE_SURELY else UNKNOWN)
        value = value.lower()
        if key == "hidden" or key == "role" and value in _BESIDE_ROLES or key == "aria-hidden" and value == "true":
            told = BESIDE_SURELY
        if key == "style" and "display:none" in value.replace(" ", ""):
            told = BESIDE_SURELY
        main |= key == "role" and value in ("main", "article")
    if told < UNKNOWN:
        return min(told, around)
    return INSIDE if main and around != BESIDE_SURELY else around


def blocks(html: str) -> list[Block]:
    """The page's text blocks in order, character references decoded and white space made one space."""
    out: list[Block] = []
    open_tags: list[tuple[str, int]] = []
    # How many open tags have each name, so that an end tag without a start costs nothing.
    open_names: Counter[str] = Counter()
    parts: list[tuple[str, bool]] = []
    # ``hidden`` counts the open elements of the name ``unseen``, whose text nobody sees.
    where, link, heading, unseen, hidden = UNKNOWN, 0, 0, "", 0

    def close() -> None:
        text = _GAP.sub(" ", unescape("".join(p for p, _ in parts))).strip()
        if text:
            linked = sum(len(unescape(p).split()) for p, a in parts if a)
            out.append(Block(text, len(text.split()), linked, where, heading > 0))
        parts.clear()

    at = 0
    while m := _MARKUP.search(html, at):
        if unseen == "head" and not html[at : m.start()].isspace() and m.start() > at:
            unseen = ""
        if not unseen and m.start() > at:
            parts.append((html[at : m.start()], link > 0))
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in RAW and not m["end"]:
            # Their content is no markup: on to the end tag.
            if not unseen and name not in INLINE:
                close()
            end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            continue
        if unseen == "head":
            # An end tag closes it, or any tag that can't stand in it.
            if m["end"] or name in IN_HEAD:
                unseen = "" if m["end"] and name in ("head", "html", "body") else unseen
                continue
            unseen = ""
        elif unseen:
            if name == unseen and not m["rest"].endswith("/"):
                hidden += -1 if m["end"] else 1
                unseen = unseen if hidden else ""
            continue
        if name == "br":
            parts.append((" ", False))
            continue
        if name not in INLINE:
            close()
        if m["end"]:
            if open_names[name]:
                depth = next(k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == name)
                where = open_tags[depth][1]
                gone = [t for t, _ in open_tags[depth:]]
                del open_tags[depth:]
                open_names.subtract(gone)
                link -= gone.count("a")
                heading -= sum(len(t) == 2 and t[0] == "h" and t[1].isdigit() for t in gone)
        elif name in UNSEEN and not m["rest"].endswith("/"):
            unseen, hidden = name, 1
        elif name not in VOID and not m["rest"].endswith("/"):
            if name in ("p", "li") and any(t == name for t, _ in open_tags[-1:]):
                where = open_tags.pop()[1]
                open_names[name] -= 1
            open_tags.append((name, where))
            open_names[name] += 1
            link += name == "a"
            heading += len(name) == 2 and name[0] == "h" and name[1].isdigit()
            where = _place(name, m["rest"], where)
    if not unseen or unseen == "head" and html[at:].strip():
        parts.append((html[at:], link > 0))
    close()
    return out


FEATURES = ("where", "heading", "main_seen", "main_passed", "words", "density", "density_beside", "words_before", "density_before", "words_after", "density_after")


def measures(found: list[Block]) -> np.ndarray:
    """A row for each block: word count and link density of it and its neighbours, its place, and whether the page marks a main part at all and has shown some of it.

    Neighbours are the adjacent blocks in the same place; at the edge of a place a block has none. ``density_beside`` is the greater of
    theirs: a list of links has it, a paragraph that is one link hasn't.
    """
    main = float(any(b.where == INSIDE for b in found))
    edge = Block("", 0, 0, UNKNOWN, False)
    rows, passed = [], False
    for around_before, b, around_after in zip([edge, *found[:-1]], found, [*found[1:], edge], strict=True):
        before, after = (n if n.where == b.where else edge for n in (around_before, around_after))
        beside = max(before.density, after.density)
        rows.append((b.where, b.heading, main, passed, b.words, b.density, beside, before.words, before.density, after.words, after.density))
        passed |= b.where == INSIDE
    return np.array(rows, float).reshape(len(found), len(FEATURES))


# ---- the tree and its labelled table ----------------------------------------------------

#: The labelled table. Each page is a list of (markup, 1 if its text belongs to the article). ``W`` stands for a word; ``W*n`` for n of them.
LABELLED = (
    [("<nav><ul><li><a href=x>W</a></li>", 0), ("<li><a href=x>W*2</a></li></ul></nav>", 0), ("<div class=ad>W*8</div>", 0),
     ("<article><h1>W*6</h1>", 1), ("<p>W*60</p>", 1), ("<p>W*2</p>", 1), ("<p>W*30</p></article>", 1), ("<footer>W*9</footer>", 0)],
    [("<header><a href=x>W</a></header>", 0), ("<main><h1>W*4</h1>", 1), ("<p>W*9 <a href=x>W*2</a></p>", 1), ("<p>W</p>", 1),
     ("<aside>W*40</aside>", 0), ("<p>W*80</p></main>", 1), ("<div class=comments><p>W*50</p></div>", 0), ("<footer><p>W*30</p></footer>", 0)],
    [("<div id=menu><a href=x>W*2</a></div>", 0), ("<div class=cookie-notice>W*25</div>", 0), ("<div><h2>W*5</h2></div>", 1),
     ("<div><p>W*45</p></div>", 1), ("<div><p>W*12</p></div>", 1), ("<div><p>W*70</p></div>", 1), ("<p><a href=x>W*3</a></p>", 0),
     ("<p>W*4</p>", 0), ("<form>W*6</form>", 0)],
    [("<article><p>W*2</p>", 1), ("<p>W</p>", 1), ("<p>W</p></article>", 1), ("<div><a href=x>W*2</a></div>", 0)],
    [("<article><p>W*4</p></article>", 1), ("<p>W*7</p>", 0)],
    [("<article><p>W*40</p>", 1), ("<p>W*3 <a href=x>W</a></p></article>", 1)],
    [("<main><p><a href=x>W*3</a></p></main>", 1), ("<p>W*30</p>", 0)],
    [("<article><p><a href=x>W*3</a></p>", 1), ("<p>W*3</p></article>", 1), ("<nav><a href=x>W</a></nav>", 0)],
    [("<p><a href=x>W*3</a> <a href=x>W*4</a></p>", 0), ("<h1>W*7</h1>", 1), ("<p>W*35</p>", 1), ("<p>W*3</p>", 1), ("<p>W*28 <a href=x>W*2</a></p>", 1),
     ("<ul><li><a href=x>W*5</a></li>", 0), ("<li><a href=x>W*6</a></li></ul>", 0), ("<p>W*5</p>", 0)],
    [("<article><header><h1>W*9</h1></header>", 1), ("<p>W</p>", 1), ("<p><a href=x>W*4</a></p>", 1), ("<p>W*200</p>", 1), ("<ul><li>W*3</li>", 1), ("<li>W*4</li></ul>", 1),
     ("<section class=comments><p>W*90</p></section></article>", 0), ("<aside><p>W*3</p></aside>", 0), ("<div>W*2</div>", 0)],
    [("<nav>W*20</nav>", 0), ("<div>W*30</div>", 0), ("<article><p>W*3</p>", 1), ("<p>W*2</p></article>", 1), ("<div>W*50</div>", 0), ("<p><a href=x>W*2</a></p>", 0)],
    [("<div class=sidebar><p>W*60</p></div>", 0), ("<p>W*50</p>", 1), ("<p>W*22</p>", 1), ("<p>W*14</p>", 1), ("<p>W*90</p>", 1), ("<div><a href=x>W*9</a></div>", 0)],
    # Without a marked main part: titles and short first paragraphs, then footers, comments and notices after long paragraphs.
    [("<h1>W*6</h1>", 1), ("<p>W*8</p>", 1), ("<p>W*70</p>", 1), ("<p>W*55</p>", 1), ("<footer>W*41</footer>", 0), ("<div class=cookie-notice>W*33</div>", 0)],
    [("<nav><a href=x>W*2</a></nav>", 0), ("<h1>W*4</h1>", 1), ("<p>W*5</p>", 1), ("<p>W*12</p>", 1), ("<p>W*64</p>", 1), ("<p>W*120</p>", 1),
     ("<div class=comments><p>W*30</p>", 0), ("<p>W*48</p></div>", 0), ("<footer><p>W*26</p></footer>", 0)],
    [("<div class=header>W*3</div>", 0), ("<h2>W*9</h2>", 1), ("<p>W*14</p>", 1), ("<p>W*90</p>", 1), ("<div id=comments>W*75</div>", 0), ("<div class=notice>W*95</div>", 0),
     ("<div class=footer>W*110</div>", 0)],
    [("<h1>W*3</h1>", 1), ("<p>W*26</p>", 1), ("<p>W*7</p>", 1), ("<p>W*44</p>", 1), ("<ul><li><a href=x>W*3</a></li>", 0), ("<li><a href=x>W*4</a></li>", 0), ("<li><a href=x>W*2</a></li></ul>", 0)],
    [("<header><a href=x>W*2</a></header>", 0), ("<h1>W*11</h1>", 1), ("<p>W*18</p>", 1), ("<p>W*31 <a href=x>W*3</a></p>", 1), ("<p>W*6</p>", 1), ("<p>W*52</p>", 1), ("<form>W*20</form>", 0)],
    [("<p>W*15</p>", 1), ("<p>W*9</p>", 1), ("<p>W*40</p>", 1)],
    [("<p>W*3</p>", 1)],
    [("<p>W*250</p>", 1)],
    [("<h1>W*5</h1>", 1), ("<p>W*2</p>", 1)],
    [("<div><a href=x>W</a> <a href=x>W*2</a></div>", 0), ("<p>W*25</p>", 1), ("<p>W*80</p>", 1), ("<ul><li><a href=x>W*3</a></li>", 0), ("<li><a href=x>W*2</a></li></ul>", 0), ("<p>W*35</p>", 1),
     ("<p>W*12</p>", 1)],
    [("<nav><ul><li><a href=x>W*3</a></li>", 0), ("<li><a href=x>W*6</a></li></ul></nav>", 0), ("<h1>W*4</h1>", 1), ("<p>W*5</p>", 1), ("<p>W*50</p>", 1)],
    [("<nav><a href=x>W*8</a></nav>", 0), ("<p>W*4</p>", 1), ("<p>W*70</p>", 1), ("<ul><li><a href=x>W*4</a></li>", 0), ("<li><a href=x>W*5</a></li></ul>", 0), ("<p>W*3</p>", 0)],
    # With one: link lists inside it, the title above it, boxes around it.
    [("<h1>W*7</h1>", 1), ("<article><p>W*66</p>", 1), ("<ul><li><a href=x>W*4</a></li>", 0), ("<li><a href=x>W*5</a></li>", 0), ("<li><a href=x>W*3</a></li></ul>", 0), ("<p>W*38</p></article>", 1),
     ("<h2>W*2</h2>", 0), ("<p>W*12</p>", 0), ("<footer>W*41</footer>", 0)],
    [("<h1>W*10</h1>", 1), ("<main><p>W*24</p>", 1), ("<p>W*80</p>", 1), ("<ul><li><a href=x>W*2</a></li>", 0), ("<li><a href=x>W*6</a></li>", 0), ("<li><a href=x>W*2</a></li>", 0),
     ("<li><a href=x>W*7</a></li></ul></main>", 0), ("<h3>W*3</h3>", 0), ("<div>W*35</div>", 0)],
    # A linked paragraph among others belongs to the article, a list of links doesn't; boxes without a name before it don't either.
    [("<article><p>W*30</p>", 1), ("<p><a href=x>W*5</a></p>", 1), ("<p>W*18</p>", 1), ("<p><a href=x>W*9</a></p>", 1), ("<p>W*45</p></article>", 1)],
    [("<div>W*14</div>", 0), ("<article><h1>W*5</h1>", 1), ("<p><a href=x>W*2</a></p>", 1), ("<p>W*70</p>", 1), ("<p><a href=x>W*12</a></p></article>", 1)],
    [("<div>W*5</div>", 0), ("<div>W*44</div>", 0), ("<main><p>W*22</p>", 1), ("<p>W*16</p>", 1), ("<p><a href=x>W*3</a></p>", 1), ("<p>W*90</p></main>", 1), ("<div>W*60</div>", 0), ("<p>W*9</p>", 0)],
    [("<p>W*21</p>", 0), ("<p>W*3</p>", 0), ("<div>W*80</div>", 0), ("<article><h2>W*3</h2>", 1), ("<p>W*11</p>", 1), ("<ul><li><a href=x>W*8</a></li>", 0), ("<li><a href=x>W*9</a></li></ul>", 0), ("<p>W*40</p></article>", 1)],
    [("<div>W*2</div>", 0), ("<div>W*10</div>", 0), ("<h1>W*8</h1>", 1), ("<article><p>W*33</p>", 1), ("<p>W*6</p>", 1), ("<ul><li><a href=x>W</a></li>", 0), ("<li><a href=x>W*4</a></li>", 0), ("<li><a href=x>W*2</a></li></ul></article>", 0)],
    [("<article><p><a href=x>W*7</a></p>", 1), ("<p>W*10</p>", 1), ("<p><a href=x>W*2</a></p>", 1), ("<p>W*3</p>", 1), ("<p><a href=x>W*15</a></p>", 1), ("<p>W*60</p>", 1), ("<p><a href=x>W</a></p>", 1),
     ("<p>W*20</p>", 1), ("<p><a href=x>W*6</a></p></article>", 1)],
    [("<main><p>W*4</p>", 1), ("<p><a href=x>W*10</a></p>", 1), ("<p>W*100</p>", 1), ("<p><a href=x>W*4</a></p>", 1), ("<p>W*14</p>", 1), ("<p><a href=x>W*8</a></p>", 1), ("<p>W*6</p></main>", 1)],
    [("<article><p>W*50</p>", 1), ("<ul><li><a href=x>W*11</a></li>", 0), ("<li><a href=x>W*14</a></li>", 0), ("<li><a href=x>W*16</a></li>", 0), ("<li><a href=x>W*13</a></li></ul>", 0), ("<p>W*8</p>", 1),
     ("<ul><li><a href=x>W*20</a></li>", 0), ("<li><a href=x>W*18</a></li></ul>", 0), ("<p>W*30</p></article>", 1)],
    [("<h1>W*4</h1>", 1), ("<article><p>W*5</p>", 1), ("<ul><li>W*6</li>", 1), ("<li>W*4 <a href=x>W</a></li></ul>", 1), ("<p>W*29</p></article>", 1), ("<h2>W*4</h2>", 0), ("<p><a href=x>W*6</a></p>", 0)],
)


@dataclass
class Tree:
    """Inner nodes ask whether a measure is at most ``limit``; a leaf has a label."""

    label: int = 0
    measure: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def labels(self, rows: np.ndarray) -> np.ndarray:
        if self.measure < 0:
            return np.full(len(rows), self.label)
        small = rows[:, self.measure] <= self.limit
        out = np.empty(len(rows), int)
        out[small], out[~small] = self.low.labels(rows[small]), self.high.labels(rows[~small])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 9) -> Tree:
    """A tree by least Gini impurity; ties go to the measure named first and the smaller limit."""
    share = labels.mean()
    leaf = Tree(label=int(share >= 0.5))
    if depth == 0 or share in (0, 1):
        return leaf
    best = (2 * share * (1 - share) - 1e-9, -1, 0.0)
    for j in range(rows.shape[1]):
        values = np.unique(rows[:, j])
        for limit in (values[1:] + values[:-1]) / 2:
            small = rows[:, j] <= limit
            p, q, w = labels[small].mean(), labels[~small].mean(), small.mean()
            gini = w * 2 * p * (1 - p) + (1 - w) * 2 * q * (1 - q)
            if gini < best[0] - 1e-12:
                best = (gini, j, float(limit))
    if best[1] < 0:
        return leaf
    small = rows[:, best[1]] <= best[2]
    return Tree(leaf.label, best[1], best[2], grow(rows[small], labels[small], depth - 1), grow(rows[~small], labels[~small], depth - 1))


def labelled_rows() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in LABELLED:
        html = "".join(re.sub(r"W(?:\*(\d+))?", lambda m: " ".join(["w"] * int(m[1] or 1)), markup) for markup, _ in page)
        found = blocks(html)
        assert len(found) == len(page), [b.text for b in found]
        rows.append(measures(found))
        labels += [label for _, label in page]
    return np.concatenate(rows), np.array(labels)


@cache
def tree() -> Tree:
    return grow(*labelled_rows())


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, tree().labels(measures(found)), strict=True) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``: the article's blocks in page order, one line each.

    Defined cases: a null or empty page has empty text, as has one without article blocks; broken markup is read as far as it goes, unclosed tags end with
    what encloses them; rows that repeat are extracted each; other columns are ignored.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(rows, kind)
