"""Main text of web pages by tree scoring.

A page becomes a tree. Paragraphs pass points, for their length and their commas, to their
ancestors: all to the parent, half to the grandparent, a third and less above. A node's points are
discounted by its link density. The best node is the container of the main text. If it stands in an article, or else in
a main element, all of that is kept, since a text may lie in several containers with a header, lists and small
headings beside them. Siblings of what is kept that score well, are plain paragraphs, or share a container below the body and are no lists
of links, are kept as well. What no article consists of (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments) is cut off the tree before. An element or a
name does not decide that alone: what holds the page's article, or most of its words where no article or main element
is marked, stays, names such as `has-sidebar` speak of another part, and a paragraph is cut only if its name is
the word itself. Reader comments go by any name with the word in it, however long they are.

Very long pages are read whole, one at a time. A null page counts as empty; an empty page, or one without text, gives the empty string. Markup that
is never closed is closed where its parent ends. Repeated rows are extracted each; an empty table gives no
rows. Columns other than `page_id`, `url` and `html` are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import slices

#: Names of HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
NEVER = frozenset(
    "script style noscript template textarea title xmp iframe noembed noframes object embed canvas svg head button select "
    "option input".split()
)
#: Parts beside the text, unless they hold it.
ASIDE = frozenset("nav footer aside form fieldset menu dialog".split())
PARAGRAPH = frozenset("p pre td blockquote li dd h2 h3 h4 h5 h6".split())
#: Open elements that a start tag ends, and the elements the search for them stops at.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body table ul ol dl article section div main aside nav td th blockquote form header footer".split())

#: Words in a class or id that mark what is beside the main text.
BESIDE = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|adverts|banner|sponsor|sponsored|promo|cookie|cookies|consent|notice|"
    r"alert|popup|modal|newsletter|subscribe|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumb|breadcrumbs|"
    r"header|masthead|footer|comment|comments|disqus|respond|share|sharing|social|related|recommended|widget|"
    r"pagination|pager|login|signup|toolbar|skip)(?:$|[\s_-])",
    re.I,
)
#: Names of reader comments, wherever the word stands in a name.
COMMENTS = re.compile(r"comment(?!ar)|repl(?:y|ies)(?:$|[\s_-])|disqus|(?:^|[\s_-])(?:respond|responses|discussion|guestbook)(?:$|[\s_-])", re.I)
#: A name that speaks of another part, such as `has-sidebar`.
OF_OTHERS = re.compile(r"(?<![^\s_-])(?:has|with|without|no|hide|show)[_-]?(?:\w+[_-])?(?:side-?bar|menu|nav|header|footer|banner|widgets?|comments?)(?![^\s])", re.I)
#: Of these, what belongs to the text inside an article: its title block, and notes.
WITHIN = re.compile(r"(?<![^\s_-])(?:header|notice|alert)(?![^\s_-])", re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
MARK = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.I)


class Tree:
    """Nodes by number; a parent has a smaller number than its children."""

    def __init__(self):
        self.tag, self.parent, self.attrs, self.children = ["#root"], [-1], [""], [[]]
        self.blocks: list[tuple[int, str, int]] = []  # (node, text, characters in links)

    def add(self, tag: str, parent: int, attrs: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attrs.append(attrs)
        self.children.append([])
        self.children[parent].append(len(self.tag) - 1)
        return len(self.tag) - 1


def parse(page: str) -> Tree:
    tree, stack, at, size = Tree(), [0], 0, len(page)
    pieces: list[str] = []
    owner, links, depth = 0, 0, 0

    def flush() -> None:
        nonlocal links
        text = " ".join("".join(pieces).split())
        if text:
            tree.blocks.append((owner, text, min(links, len(text))))
        pieces.clear()
        links = 0

    def close(to: int) -> None:
        nonlocal depth
        for node in stack[to:]:
            if tree.tag[node] == "a":
                depth -= 1
        del stack[to:]

    def put(text: str) -> None:
        nonlocal owner, links
        if not pieces:
            owner = stack[-1]
        text = html.unescape(text)
        pieces.append(text)
        if depth:
            links += len(text.strip())

    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            put(page[at:])
            break
        if begin > at:
            put(page[at:begin])
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), begin):
            end = page.find(">", begin)
            at = size if end < 0 else end + 1
            continue
        found = TAG.match(page, begin)
        if not found:
            if begin + 1 < size and (page[begin + 1].isalpha() or page[begin + 1] == "/"):
                end = page.find(">", begin)  # a tag with a stray quote, or one cut off
                at = size if end < 0 else end + 1
            else:
                put("<")
                at = begin + 1
            continue
        closing, tag, attrs = found[1], found[2].lower(), found[3]
        at = found.end()
        if tag in BLOCK:
            flush()
        elif tag == "br":
            put("\n")
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if tree.tag[stack[k]] == tag:
                    close(k)
                    break
                if tag not in BLOCK and tree.tag[stack[k]] in SCOPE:
                    break  # an inline end tag doesn't end a container
            continue
        ends = ENDS.get(tag, {"p"} if tag in BLOCK else set())
        if tag in BLOCK:
            ends = ends | {"p"}
        for k in range(len(stack) - 1, 0, -1):
            if tree.tag[stack[k]] in ends:
                close(k)
                break
            if tree.tag[stack[k]] in SCOPE:
                break
        if tag in VOID:
            continue
        node = tree.add(tag, stack[-1], attrs)
        if tag in RAW:
            end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            at = size if not end else end.start()
            if end:
                at = page.find(">", end.start()) + 1 or size
            continue
        if not attrs.rstrip().endswith("/") or tag in BLOCK:
            stack.append(node)
            depth += tag == "a"
    flush()
    return tree


def _beside(tag: str, names: str, article: bool, inside: bool, title: bool) -> bool:
    """True if a class, id or role names a part beside the text."""
    names = OF_OTHERS.sub("", names)
    if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") or tag not in BLOCK:
        # A paragraph's name has to be the word itself: a share price is no share button.
        return any(BESIDE.fullmatch(x) for x in names.split() if not (article and WITHIN.fullmatch(x)))
    if article:
        names = WITHIN.sub("", names)
    elif inside and title:
        names = re.sub("header", "", names, flags=re.I)
    return bool(BESIDE.search(names))


def main_blocks(tree: Tree) -> list[str]:
    """The blocks of the best container and of the siblings that belong to it, in page order."""
    count = len(tree.tag)
    holds = [False] * count  # an article or main element is below
    for node in range(count - 1, 0, -1):
        if holds[node] or tree.tag[node] in ("article", "main"):
            holds[tree.parent[node]] = True
    size, in_links, title = [0] * count, [0] * count, [False] * count
    for node, text, links in tree.blocks:
        while node >= 0:
            size[node] += len(text)
            in_links[node] += links
            node = tree.parent[node]
    for node in range(count - 1, 0, -1):
        if tree.tag[node] == "h1" or title[node]:
            title[node] = title[tree.parent[node]] = True
    marked = any(tree.tag[node] in ("article", "main") and size[node] for node in range(count))

    def holds_text(node: int) -> bool:
        """True if the page's text is here: no article stands elsewhere, and most of the words, few of them links, are in `node`."""
        return holds[node] or not marked and 2 * size[node] > size[0] and 2 * in_links[node] < size[node]

    cut, inside, article = [False] * count, [False] * count, [False] * count
    for node in range(1, count):
        up, tag, attrs = tree.parent[node], tree.tag[node], tree.attrs[node]
        inside[node] = inside[up] or tag in ("article", "main")
        article[node] = article[up] or tag == "article"
        # A header inside a container of the page that bears the title is the text's own.
        own = title[node] and tree.tag[up] not in ("body", "html", "#root") and 2 * in_links[node] < size[node]
        beside = tag in ASIDE or tag == "header" and not inside[node] and not own
        cut[node] = cut[up] or tag in NEVER or beside and not holds_text(node)
        if attrs and not cut[node] and tag not in ("article", "main", "body", "html"):
            names = " ".join(filter(None, (x for m in MARK.findall(attrs) for x in m)))
            comments = tag in BLOCK and bool(COMMENTS.search(OF_OTHERS.sub("", names))) and not holds[node] and not title[node]
            named = comments or _beside(tag, names, article[node], inside[node], title[node]) and not holds_text(node)
            cut[node] = bool(HIDDEN.search(attrs)) or named
    blocks = [x for x in tree.blocks if not cut[x[0]]]
    if not blocks:
        return []

    points, chars, linked = [0.0] * count, [0] * count, [0] * count
    for node, text, in_links in blocks:
        up = node
        while up >= 0:
            chars[up] += len(text)
            linked[up] += in_links
            up = tree.parent[up]
        # Text of an inline element belongs to the paragraph or container it stands in.
        while tree.tag[node] not in BLOCK and tree.parent[node] > 0:
            node = tree.parent[node]
        given = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - in_links / len(text))
        up, share = (tree.parent[node] if tree.tag[node] in PARAGRAPH else node), 0
        while up >= 0:
            points[up] += given / (1, 2)[share] if share < 2 else given / (share * 3)
            up, share = tree.parent[up], share + 1

    def score(node: int) -> float:
        return points[node] * (1 - linked[node] / chars[node]) if chars[node] else 0.0

    best = max(range(count), key=lambda x: (score(x), -x))
    top, around = score(best), best
    while around > 0 and tree.tag[around] != "article":
        around = tree.parent[around]
    if around <= 0:
        around = best
        while around > 0 and tree.tag[around] != "main":
            around = tree.parent[around]
    best = around if around > 0 else best
    kept = {best}
    # In a container of their own, siblings are parts of one text; in the body they may be anything.
    own = best > 0 and tree.tag[tree.parent[best]] not in ("body", "html", "main", "#root")
    for node in tree.children[tree.parent[best]] if best else ():
        if cut[node] or not chars[node]:
            continue
        density = linked[node] / chars[node]
        plain = tree.tag[node] in ("p", "h1", "h2", "pre", "blockquote") and density < 0.25
        if score(node) >= max(3, 0.2 * top) and density < 0.5 or plain or own and density < 0.25:
            kept.add(node)
    below = [False] * count
    for node in range(count):
        below[node] = node in kept or node > 0 and below[tree.parent[node]]
    return [text for node, text, _ in blocks if below[node]]


def main_text(page: str) -> str:
    return "\n".join(main_blocks(parse(page)))


def extract(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
