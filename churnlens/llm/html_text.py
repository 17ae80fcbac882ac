"""Main text of web pages by composite text density.

A page becomes a small DOM.  Every node gets its composite density: characters per
tag, adjusted by the characters and tags that are links, so that prose scores high
and menus low.  A node's density sum adds its children's densities, and the subtree
with the largest sum is the article.  The least density on the path from it to the
body is the threshold.  An article element around that subtree is taken as it is; without
one the selection is lifted to the ancestor that holds every other part of the article: any
subtree with prose that reaches the threshold, and headings, paragraphs, sections and blocks
like the selected one that stand beside it.  Nodes that are no article text by their nature (menus, page headers and
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) are
cut before the densities are computed and again from what is selected.
"""

from __future__ import annotations

import html as _html
import re
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard: void elements, elements whose content is not markup, elements that
# end an open paragraph, and which open elements a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements of running text: beside the densest subtree they belong to it however short they are.
FLOW = frozenset("p section blockquote pre ul ol dl li dt dd table figure".split())
INLINE = frozenset("a abbr b bdi bdo cite code em i mark q s small span strong sub sup time u".split())
#: Inside these an open paragraph of the outside is not closed by a block.
SCOPE = frozenset("html body table td th caption button object template".split())

# What is no article text, by element and by words of class, id, role or label.
CUT_TAGS = frozenset("""head script style noscript template iframe object embed svg canvas nav footer aside form button
select textarea input label fieldset dialog menu noembed noframes xmp title""".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
# whole words with the endings that furniture has: "share" and "sharebar", but not "shareholders"
_PIECE = "s|bars?|box|boxes|lists?|links?|posts?|articles?|buttons?|btns?|icons?|forms?|areas?|sections?|wrap|wrapper|containers?|blocks?|menus?|items?"
CUT_WORDS = re.compile(rf"""(?:^|[\s_-])(?:
    (?:ad|advert|banner|sponsor|promo|nav|menu|sidebar|footer|breadcrumb|cookie|consent|notice|popup|modal|overlay|subscribe|
    newsletter|share|social|related|recommended|comment|widget)(?:{_PIECE})?|
    adverti[sz]ing|adverti[sz]ements?|adsense|adsbygoogle|sponsored|promotions?|promoted|navigations?|submenus?|header|masthead|
    side|gdpr|subscriptions?|subscribers?|signup|login|sharing|sharethis|sharedaddy|addthis|socialmedia|relatedcontent|
    recommendations?|commenters?|commenting|commentlist|disqus|disqus_thread|repl(?:y|ies)|discussion|respond|pagination|pager|
    skip|skiplinks?|toolbars?|toc)(?=$|[\s_-])""", re.I | re.X)
#: Furniture words that are as often what a part of an article is about, and words that say nothing beside them.
TOPICS = frozenset("discussion recommendation recommendations".split())
_PLAIN = re.compile(rf"""\d+|{_PIECE}|site|page|main|top|bottom|left|right|primary|secondary|inner|outer|global|slot|unit|count|thread|
    media|entry|content|story|blog|user|reader|inline|mobile|desktop|gpt|div|wp|js|module|component|sticky|more|the|this|to|of|and|for|a""",
                    re.I | re.X)
#: What these are named is a link target or a subject, rarely a kind of furniture.
TEXT_TAGS = HEADINGS | FLOW | INLINE | {"figcaption", "tr"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|
    <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)(?:>|\Z)""", re.S | re.X)
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Cut by what a class or id says, which may be a layout name of the part that holds the article.
NAMED = 2
#: Cut as a form, which on some sites is wrapped around the whole page.
FORM = 3
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "name", "kids", "parent", "cut", "chars", "tags", "link_chars", "link_tags", "density", "total", "prose")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.name, self.parent, self.kids, self.cut = tag, "", parent, [], False
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.prose = False


def _attributes(raw: str) -> dict[str, str]:
    """Attributes of a start tag by name; of a repeated name the first counts, a bare one has an empty value."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(raw):
        value = a or b or c
        out.setdefault(name.lower(), _html.unescape(value) if "&" in value else value)
    return out


def _is_cut(tag: str, attrs: dict[str, str], parent: Node) -> bool | int:
    if tag in CUT_TAGS and tag != "form" or tag == "header" and not _inside(parent, "article"):
        return True
    if tag in ("html", "body"):
        return False
    role = attrs.get("role", "").strip().lower()
    if "hidden" in attrs or attrs.get("aria-hidden", "").strip().lower() == "true" or role in CUT_ROLES and role != "form":
        return True
    if tag == "form" or role == "form":
        return FORM
    if tag in ("article", "main"):
        return False
    for name in ("class", "id", "aria-label"):
        found = _furniture(attrs.get(name, ""))
        if not found:
            continue
        within = _inside(parent, "article") or _inside(parent, "main")
        if found <= {"header"} and (within or tag in HEADINGS):
            continue
        # a division that says it is a section is one
        text = tag in TEXT_TAGS or tag == "div" and "section" in attrs.get("class", "").lower().split()
        if within or text and (tag in HEADINGS or tag in ("p", "section", "span", "div")):
            # an id may be a link target; other names count if they say nothing but furniture
            if name == "id" and text and (within or tag in HEADINGS or tag == "p"):
                continue
            names = [attrs[name]] if name == "aria-label" else attrs[name].split()
            if not any(_furniture_only(v, TOPICS if text else ()) for v in names):
                continue
        return NAMED
    return False


def _furniture(value: str) -> set[str]:
    """Words of a class, id or label that name furniture."""
    return {m.strip(" _-\t\r\n\f").lower() for m in CUT_WORDS.findall(value)} if value else set()


def _furniture_only(value: str, but) -> bool:
    words = [w for w in re.split(r"[\s_-]+", value.lower()) if w and not _PLAIN.fullmatch(w)]
    return bool(words) and all(w not in but and _furniture(w) for w in words)


def _inside(node: Node | None, tag: str) -> bool:
    while node is not None:
        if node.tag == tag:
            return True
        node = node.parent
    return False


def parse(page: str) -> Node:
    """DOM of a page; kids are nodes or text.  Missing end tags are closed as a browser closes them."""
    root = Node("html", None)
    here, at, n = root, 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            here.kids.append(page[at:])
            break
        if m.start() > at:
            here.kids.append(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if name is None:
            if m.group(0).startswith("<![CDATA["):
                here.kids.append(_html.escape(m.group(0)[9:].removesuffix("]]>"), quote=False))
            continue
        name = name.lower()
        if m.group(1):
            here = _close(here, name)
            continue
        here = _open(here, name, m.group(3) or "", root)
        if name in VOID or m.group(3) and m.group(3).endswith("/") and name in ("svg", "path", "use"):
            here = here.parent
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            here.kids.append(page[at:end.start() if end else n])
            at = end.end() if end else n
            here = here.parent
    return root


def _open(here: Node, name: str, attrs: str, root: Node) -> Node:
    if name in ("html", "body"):
        if name == "html" or _inside(here, "body"):
            return here if name == "body" else root if here is root else here
        here = root  # an unclosed head ends here
    if name in BLOCKS and name not in ("html", "body", "head"):
        p = here
        while p is not None and p.tag not in SCOPE and p.tag != "p":
            p = p.parent
        if p is not None and p.tag == "p":
            here = p.parent
    if name in CLOSES:
        ends, until = CLOSES[name]
        p, last = here, None
        while p is not None and p.tag not in until:
            if p.tag in ends:
                last = p
            p = p.parent
        if last is not None and p is not None:
            here = last.parent
    node = Node(name, here)
    named = _attributes(attrs) if attrs.strip(" /") else {}
    node.name = named.get("class", "").strip() or named.get("id", "") and "#" + named["id"]
    node.cut = _is_cut(name, named, here)
    here.kids.append(node)
    return node


def _close(here: Node, name: str) -> Node:
    p = here
    while p is not None and p.tag != name:
        # a stray end tag of an inline element does not close blocks around it
        if name not in BLOCKS and p.tag in BLOCKS:
            return here
        p = p.parent
    return p.parent if p is not None and p.parent is not None else here


def _rescue(root: Node) -> None:
    """Undo cuts by name and of forms around an article or main element and, where the page has none, around most
    of its text; a form with most of the text is kept on every page."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(k for k in node.kids if isinstance(k, Node) and k.cut is not True)
    if not any(node.cut for node in order):
        return
    chars, holds = {}, set()
    for node in reversed(order):
        inner = [k for k in node.kids if isinstance(k, Node) and k.cut is not True]
        chars[id(node)] = sum(len(k.strip()) for k in node.kids if isinstance(k, str)) + sum(chars[id(k)] for k in inner)
        if node.tag in ("article", "main") or any(id(k) in holds for k in inner):
            holds.add(id(node))
    stack = [root]
    while stack:
        node = stack.pop()
        if node.cut:
            if id(node) not in holds and (holds and node.cut != FORM or 2 * chars[id(node)] <= chars[id(root)]):
                continue
            node.cut = False
        stack.extend(k for k in node.kids if isinstance(k, Node) and k.cut is not True)


def _measure(root: Node) -> None:
    """Characters, tags, link characters and link tags of every kept node, children first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(k for k in node.kids if isinstance(k, Node) and not k.cut)
    for node in reversed(order):
        for k in node.kids:
            if isinstance(k, str):
                size = len(_SPACE.sub("", k))
                node.chars += size
                node.prose |= size > 0 and (node.tag == "p" or size > 40)
            elif not k.cut:
                node.chars += k.chars
                node.tags += k.tags + 1
                node.link_chars += k.link_chars
                node.link_tags += k.link_tags + (k.tag == "a")
                node.prose |= k.prose
        if node.tag == "a":
            node.link_chars = node.chars
    whole = max(root.chars, 1)
    for node in order:
        node.density = composite_density(node.chars, node.tags, node.link_chars, node.link_tags,
                                         root.link_chars / whole)
    for node in order:
        node.total = sum(k.density for k in node.kids if isinstance(k, Node) and not k.cut)


def composite_density(c: int, t: int, lc: int, lt: int, ratio: float) -> float:
    """(C/T) · log of (C·T)/(LC·LT), to the base ln(C·LC/¬LC + LC_body·C/C_body + e); 0 for no text."""
    if c == 0:
        return 0.0
    t, lt, rest = max(t, 1), max(lt, 1), max(c - lc, 1)
    base = log(c * lc / rest + ratio * c + e)
    return c / t * log(max(c / max(lc, 1) * t / lt, 1.0) + 1e-9) / log(max(base, 1.0) + 1.0) if lc < c else 0.0


def select(root: Node) -> list[Node]:
    """Subtrees of the page that are the article, in page order."""
    body = next((k for k in root.kids if isinstance(k, Node) and k.tag == "body"), root)
    best, stack = body, [body]
    marked = []
    while stack:
        node = stack.pop()
        if node.total > best.total:
            best = node
        if node.tag in ("article", "main") and node.chars:
            marked.append(node)
        stack.extend(k for k in node.kids if isinstance(k, Node) and not k.cut)
    if best is body and not best.chars:
        return []
    threshold, node = best.density, best
    while node is not None and node is not body:
        threshold = min(threshold, node.density)
        node = node.parent
    # an article element that holds the densest subtree is the article as a whole
    around = best
    node = best
    while node is not None and node is not body:
        if node.tag in ("article", "main") and node.chars:
            around = node
            break
        node = node.parent
    while around is not body and around.tag in INLINE:
        around = around.parent
    if around.tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and around.parent is not None and around is not body:
        around = around.parent
    parent = around.parent
    if around is body or parent is None:
        return [around]
    if around.tag in ("article", "main"):
        return [k for k in _kept(parent) if k is around or k.tag == around.tag and k.prose]
    return [_lift(around, body, threshold)]


def _kept(node: Node) -> list[Node]:
    return [k for k in node.kids if isinstance(k, Node) and not k.cut]


def _linked(node: Node) -> bool:
    return node.link_chars * 2 >= node.chars


def _lift(best: Node, body: Node, threshold: float) -> Node:
    """The lowest node around ``best`` that holds every part of the article; what stands between and beside
    the parts and is none (menus, teasers) is cut."""
    order, stack = [], [body]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(_kept(node))
    dense, headed = set(), set()  # nodes that are, or hold, a subtree over the threshold; a heading
    for node in reversed(order):
        inner = _kept(node)
        if node.prose and node.density >= threshold > 0 and not _linked(node) or any(id(k) in dense for k in inner):
            dense.add(id(node))
        if node.tag in HEADINGS and node.chars or any(id(k) in headed for k in inner):
            headed.add(id(node))

    def is_part(k: Node, beside: Node | None) -> bool:
        if not k.chars or k.tag in HEADINGS or id(k) in dense:
            return k.chars > 0
        alike = beside is not None and (k.tag, k.name) == (beside.tag, beside.name) and (k.name or k.parent is not body)
        return k.prose and not _linked(k) and bool(
            k.tag in FLOW or id(k) in headed or alike or 10 * (k.chars - k.link_chars) >= best.chars)

    def running(node: Node) -> bool:
        return any(isinstance(k, str) and len(_SPACE.sub("", k)) > 40 for k in node.kids)

    def trim(node: Node, path: Node | None) -> None:
        """Cut the children that are neither parts nor stand between two of them as text."""
        text = running(node)
        part = [isinstance(k, Node) and not k.cut and (k is path or is_part(k, path)) for k in node.kids]
        if node is not body and any(p and k is not path and (k.tag in FLOW or k.tag in HEADINGS)
                                    for k, p in zip(node.kids, part)):  # text runs here, so its short blocks are text too
            part = [p or isinstance(k, Node) and not k.cut and k.prose and not _linked(k) for k, p in zip(node.kids, part)]
        places = [i for i, p in enumerate(part) if p]
        for i, k in enumerate(node.kids):
            if isinstance(k, str) or k.cut or not k.chars:
                continue
            between = places and places[0] < i < places[-1]
            if not (part[i] or text and k.tag in INLINE or between and (k.tag == "p" or not _linked(k))):
                k.cut = True
            elif k is not path and _linked(k) and id(k) in dense:
                todo.append(k)
        # separators of links that are gone
        gone = [isinstance(k, Node) and k.cut for k in node.kids] + [False]
        node.kids = [" " if isinstance(k, str) and (gone[i - 1] or gone[i + 1]) and not any(c.isalnum() for c in _html.unescape(k))
                     else k for i, k in enumerate(node.kids)]

    top = node = best
    while node is not body:
        if running(node.parent) or any(k is not node and is_part(k, node) for k in _kept(node.parent)):
            top = node.parent
        node = node.parent
    todo: list[Node] = []
    node = best
    while node is not top:
        trim(node.parent, node)
        node = node.parent
    while todo:
        trim(todo.pop(), None)
    return top


def blocks(nodes: list[Node]) -> list[str]:
    """Text blocks in page order: references decoded, white space one blank, trimmed, empty ones left out."""
    out: list[str] = []
    piece: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(piece)).strip()
        if text:
            out.append(text)
        piece.clear()

    for top in nodes:
        stack: list = [(top, 0)]
        if top.tag in BLOCKS:
            flush()
        while stack:
            node, i = stack.pop()
            if i < len(node.kids):
                stack.append((node, i + 1))
                k = node.kids[i]
                if isinstance(k, str):
                    piece.append(_html.unescape(k) if "&" in k else k)
                elif not k.cut:
                    if k.tag in BLOCKS:
                        flush()
                    elif k.tag == "br":
                        piece.append(" ")
                    stack.append((k, 0))
            elif node.tag in BLOCKS:
                flush()
        flush()
    return out


def main_text(page: str | None) -> str:
    """The main text of a page, blocks joined by one line break; empty for none."""
    if not page:
        return ""
    root = parse(page)
    _rescue(root)
    _measure(root)
    return "\n".join(blocks(select(root)))


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, ``text`` and ``n_chars`` (its code points).

    Null and empty pages give an empty text; repeated rows and null ids a row each; other columns are
    not read.  Each page is parsed where it lies (no shuffle), in time and memory linear in its length."""
    types = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def run(batches):
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column("_html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string())], names=["_id", "_url", "text"])

    got = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).alias("_html")) \
        .mapInArrow(run, f"_id {types[0]}, _url {types[1]}, text string")
    return got.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text",
                      F.length("text").cast("bigint").alias("n_chars"))
