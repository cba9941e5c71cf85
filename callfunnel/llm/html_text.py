"""Main text of web pages by tree scoring.

A page is read once into a tree of elements and a list of text blocks. Each block gives points for
its length and its commas to the elements around it, fewer the further up; an element's points are
discounted by its link density. The best container is kept, with siblings that score well too.
Menus, headers, footers, forms, scripts and styles are left out by element, role or because they are
hidden; sidebars, notices, adverts and reader comments by a class or id that says so as a whole
(`sidebar`, `cookie-notice`, not `has-sidebar`), and then only where the element holds no article
or main and not most of the page's text. Within article or main a class marks containers only
(not tables, figures, headings, paragraphs, inline elements, or sections that start with a heading),
an id nothing but reader comments and advert slots, and formulas, labels, legends, objects and dialogs stay.

A block's text has its character references decoded and its white space made one space; blocks
stand in page order with an empty line between them. Markup may be broken or cut off anywhere.
Null and empty pages, and pages without text, have an empty text. Null or repeated ids keep their
rows; columns other than id, url and html are not read. Reading is linear in the page's length.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|[^<]++|<""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe xmp noembed noframes".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
PARAGRAPH = set("p pre blockquote li td th dd dt h1 h2 h3 h4 h5 h6 figcaption caption summary".split())
#: an open element of these closes when another of its group starts
ALIKE = {t: g for g in ({"li"}, {"dd", "dt"}, {"td", "th"}, {"tr"}, {"option"}) for t in g}
LISTS = {"li": {"ul", "ol", "menu", "dir"}, "dd": {"dl"}, "dt": {"dl"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "option": {"select"}}
#: elements that only make sense as a part of what is around them
INNER = set("li ul ol dl dd dt tr td th tbody thead tfoot table blockquote p pre h1 h2 h3 h4 h5 h6 hgroup caption figcaption figure".split())
DROPPED = set("nav footer aside form script style noscript template button select option textarea input title iframe svg math object embed audio "
              "video canvas menu dialog map datalist fieldset legend label".split())
#: of these, what is text of an article when it stands within one
KEPT_INSIDE = set("math label legend object dialog fieldset".split())
#: elements within an article that a class can mark as something else
CONTAINERS = set("div section ul ol dl center details".split())
#: marks that no part of an article bears: they count for sections with a heading, and as ids of div and lists, as well
SURE = set("comments commentlist disqus adsense adslot".split())
HEADING = re.compile(r"\s*+(?:<!--.*?-->\s*+)*+<(?:h[1-6]|hgroup|header)\b", re.I | re.S)
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form status".split())
#: Words of a class or id that mark what isn't the article.
MARKS = set("ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion nav navbar navigation menu menubar "
            "breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer foot masthead topbar toolbar cookie cookies consent gdpr "
            "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist "
            "respond reply replies disqus discussion share sharing social related recommended recommendations pagination pager skip search "
            "hidden copyright".split())
#: what may stand beside marks in one class or id, such as `site-footer` or `ad-slot`
GENERIC = set("site page box block slot unit area bar wrap wrapper container inner outer list item items panel links link top bottom left right global "
              "primary secondary section sticky message policy form button buttons icons post posts article articles bbs user".split())
GOOD = set("article content entry main post story text body".split())


def attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(raw)} if raw.strip() else {}


def words_of(attrs: dict[str, str], names: tuple[str, ...] = ("class", "id")) -> set[str]:
    return {w.lower() for k in names for w in PARTS.findall(attrs.get(k, ""))}


def marks_of(attrs: dict[str, str], names: tuple[str, ...] = ("class", "id")) -> set[str]:
    """The marks of classes and ids that are nothing but marks and generic words."""
    out: set[str] = set()
    for name in names:
        for token in attrs.get(name, "").split():
            words = {w.lower() for w in PARTS.findall(token)}
            if words <= MARKS | GENERIC | {"header"}:
                out |= words & (MARKS | {"header"})
    return out


def beside(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    """Whether the element is something other than article text, by its kind, its role or because it is hidden."""
    if (tag in DROPPED and not (in_article and tag in KEPT_INSIDE)) or (tag == "header" and not in_article):
        return True
    if not attrs:
        return False
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role", "").lower() in ROLES:
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", "")):
        return True
    return False


def marked(tag: str, attrs: dict[str, str], in_article: bool, headed: Callable[[], bool] = lambda: False) -> bool:
    """Whether a class or id says that the element isn't article text; `headed` tells whether it starts with a heading."""
    if not attrs or tag in ("html", "body"):
        return False
    if in_article:
        marks = marks_of(attrs, ("class",)) & MARKS if tag in CONTAINERS else set()
        return bool(marks) and (tag != "section" or not marks.isdisjoint(SURE) or not headed()) or (
            tag in ("div", "ul", "ol") and not marks_of(attrs, ("id",)).isdisjoint(SURE))
    marks = marks_of(attrs)
    return tag not in ("article", "main") and not marks.isdisjoint(MARKS) or "header" in marks and tag != "h1"


class Page:
    """Elements in document order (a child's number is larger than its parent's) and text blocks."""

    def __init__(self, source: str):
        self.tag, self.parent, self.good, self.has_blocks = ["#root"], [-1], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.stack = [0]
        self.marked: list[int] = []  # elements that their class or id marks
        self.dropping = 0  # height of the stack at which a left-out element stands; 0: none
        self.open: dict[str, int] = {}
        self.paragraphs: list[int] = []  # heights of the stack at which p elements stand
        self.text: list[str] = []
        self.linked = 0
        self.read(source)
        self.close(1)

    def read(self, source: str) -> None:
        at, lower = 0, None
        while at < len(source):
            m = TOKEN.match(source, at)
            at = m.end()
            tag = m[2] or m[5]
            if not tag:
                if not self.dropping and m[0][:2] not in ("<!", "<?"):
                    self.text.append(m[0])
                    if self.open.get("a"):
                        self.linked += len(m[0].strip())
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self.end(tag)
            else:
                self.start(tag, m[3] or m[6] or "", lambda: bool(HEADING.match(source, at)))
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
                    at = end.start() if end else len(source)

    def start(self, tag: str, raw: str, headed: Callable[[], bool]) -> None:
        if tag in BLOCK:
            self.flush()
            if self.open.get("p"):
                self.end_to(self.paragraphs[-1])
        if tag == "br":
            self.text.append(" ")
        if tag in ALIKE:
            self.close_alike(tag)
        if tag in VOID or (raw.rstrip().endswith("/") and tag in ("svg", "path", "use")):
            return
        node = len(self.tag)
        parent = self.stack[-1]
        attrs = attributes(raw)
        self.tag.append(tag)
        self.parent.append(parent)
        self.good.append(tag in ("article", "main") or bool(attrs) and not words_of(attrs).isdisjoint(GOOD))
        self.has_blocks.append(False)
        if tag in BLOCK:
            self.has_blocks[parent] = True
        if tag == "p":
            self.paragraphs.append(len(self.stack))
        self.stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1
        if self.dropping:
            return
        inside = bool(self.open.get("article") or self.open.get("main"))
        said = marked(tag, attrs, inside, headed)
        if said and tag in BLOCK:
            self.marked.append(node)
        if said and tag not in BLOCK or beside(tag, attrs, inside):
            self.flush()
            self.dropping = len(self.stack)

    def close_alike(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.tag[self.stack[i]]
            if t in ALIKE[tag]:
                self.end_to(i)
                return
            if t in LISTS[tag] or t in ("article", "section", "div", "main", "body"):
                return

    def end(self, tag: str) -> None:
        if not self.open.get(tag):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.tag[self.stack[i]]
            if t == tag:
                self.end_to(i)
                return
            if tag not in BLOCK and t in BLOCK:  # an inline end tag doesn't close blocks
                return

    def end_to(self, height: int) -> None:
        """Close the elements from that height of the stack on."""
        if any(self.tag[n] in BLOCK for n in self.stack[height:]):
            self.flush()
        for n in self.stack[height:]:
            self.open[self.tag[n]] -= 1
        del self.stack[height:]
        while self.paragraphs and self.paragraphs[-1] >= height:
            self.paragraphs.pop()
        if self.dropping > len(self.stack):
            self.text.clear()
            self.linked, self.dropping = 0, 0

    def close(self, height: int) -> None:
        self.flush()
        del self.stack[height:]

    def flush(self) -> None:
        """What has been read since the last block border becomes a block of the innermost block element."""
        if self.text and not self.dropping:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                owner = next(n for n in reversed(self.stack) if n == 0 or self.tag[n] in BLOCK)
                self.blocks.append((owner, text, min(self.linked, len(text))))
        self.text.clear()
        self.linked = 0

    def leave_out(self) -> None:
        """Drop the blocks of marked elements that hold no article or main and not most of the text."""
        n = len(self.tag)
        size, holds = [0] * n, [t in ("article", "main") for t in self.tag]
        for owner, text, _ in self.blocks:
            size[owner] += len(text)
        for node in range(n - 1, 0, -1):
            size[self.parent[node]] += size[node]
            holds[self.parent[node]] |= holds[node]
        out = [False] * n
        for node in self.marked:
            out[node] = not holds[node] and 2 * size[node] <= size[0]
        for node in range(1, n):
            out[node] |= out[self.parent[node]]
        self.blocks = [b for b in self.blocks if not out[b[0]]]

    def main_blocks(self) -> list[str]:
        """The texts of the blocks in the best container and its good siblings."""
        if self.marked:
            self.leave_out()
        if not self.blocks:
            return []
        n = len(self.tag)
        points, size, linked = [0.0] * n, [0] * n, [0] * n
        for owner, text, links in self.blocks:
            size[owner] += len(text)
            linked[owner] += links
            given = 1 + text.count(",") + min(len(text) / 100, 3)
            at = owner if self.tag[owner] not in PARAGRAPH and (self.has_blocks[owner] or owner == 0) else self.parent[owner]
            for level in range(5):
                if at < 0:
                    break
                points[at] += given / (1 if level == 0 else 2 if level == 1 else 3 * level)
                at = self.parent[at]
        for node in range(n - 1, 0, -1):
            size[self.parent[node]] += size[node]
            linked[self.parent[node]] += linked[node]
        dense = [k / s if s else 0.0 for k, s in zip(linked, size)]
        score = [(p + (25 if g and p else 0)) * (1 - d) for p, g, d in zip(points, self.good, dense)]
        best = max(range(n), key=lambda i: (score[i], -i))
        at = best
        while at > 0:
            if self.tag[at] == "article" or at == best and self.tag[at] in INNER:
                best = at if self.tag[at] == "article" else self.parent[at]
            at = self.parent[at]
        kept = {best}
        if self.tag[best] not in ("article", "main", "body", "html", "#root"):
            kept |= {s for s in range(1, n) if self.parent[s] == self.parent[best] and size[s] and dense[s] < 0.25 and (
                self.tag[s] in PARAGRAPH or score[s] >= 0.2 * score[best])}
        elif self.tag[best] == "article":
            kept |= {s for s in range(1, n) if self.tag[s] == "article" and self.parent[s] == self.parent[best] and score[s] >= 0.2 * score[best]}
        inside = [i in kept for i in range(n)]
        for node in range(1, n):
            inside[node] = inside[node] or inside[self.parent[node]]
        return [text for owner, text, _ in self.blocks if inside[owner]]


def main_text(source: str | None) -> str:
    return "\n\n".join(Page(source).main_blocks()) if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 ["page_id", "url", "text", "n_chars"])

    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]
    return pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].cast("string").alias("html")).mapInArrow(
        run, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
