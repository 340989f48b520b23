"""Main text of web pages by wrappers inferred for each host (operator 1).

A wrapper is a union-free regular expression over a page's token stream: elements in sequence,
each exactly once, optional (``?``), repeated (``+``) or both (``*``), with text slots that are
constant (template text) or open.  One page alone gives a wrapper by folding repeats; two are
aligned element by element, and every mismatch becomes an optional element, a repeated group or
an open slot.  Pages of a host are aligned where they are read, and the partial wrappers of a
host are aligned with each other in two steps, so no host's pages meet in one task.

The wrapper names the region that holds the article: its text is then read off every page.
"""

from __future__ import annotations

import html
import json
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_keyed, stored, text_batches

#: Partial wrappers of a host are aligned in so many groups first.
PARTS = 16
#: Longest repeated group of different elements that is looked for.
LONGEST_GROUP = 3
#: Children of one element that are aligned; more are first merged by name, in order.
MOST_CHILDREN = 150
#: Letters of pages after which a task passes on its partial wrappers (they are no larger than their pages).
PASS_ON_CHARS = 1 << 26

# Element names by role, and class, id or role words of page furniture and of articles.
CONTAINERS = frozenset("html body div section main article center table tbody tr td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|iframe|textarea|title|noembed|noframes|xmp"
EMBEDDED = frozenset("svg math canvas object audio video select template".split())
FOREIGN = frozenset(("svg", "math"))
BLOCK = frozenset("""address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 head header hr html li main nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
ENDS_P = BLOCK - frozenset("html head body td th tr tbody thead tfoot option".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
          "th": ("td", "th"), "option": ("option",)}
KEEPS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"),
         "option": ("select",)}
FURNITURE_TAGS = frozenset("head nav footer aside form button dialog menu label input".split())
FURNITURE_WORDS = frozenset("""ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent
    cookie cookies dialog disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice pagination popup
    promo promotion recommended related replies reply respond search share sharing sidebar social sponsor sponsored subscribe
    toolbar widget complementary contentinfo""".split())
#: Words that may stand beside a furniture word in a name of furniture (site-footer, share-buttons).
LAYOUT_WORDS = frozenset("""area article bar block bottom box button buttons container content entry form global group icons inner item items left
    link links list main outer page panel post primary right secondary section site top unit wrap wrapper""".split())
#: Elements that a class, id or role never makes furniture.
NEVER_FURNITURE = frozenset("html body main article".split())
ARTICLE_WORDS = frozenset("article articlebody content entry main maincontent post postbody story".split())

#: Elements that end an open svg or math element, and those inside which they do not.
ENDS_FOREIGN = BLOCK | frozenset("b big br center code em embed i img listing meta nobr ruby s small span strong strike sub sup tt u var".split())
HOLDS_HTML = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
#: Elements that a paragraph cannot be closed across, beside blocks.
KEEPS_P = BLOCK | HOLDS_HTML | frozenset("object template button".split())

# A quote opens a value only directly after an equals sign; a slash counts as the end only directly before ">".
ATTRIBUTES = r"""(?:\s++|/(?!>)|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+"""
TOKEN = re.compile(rf"""<!--(?:-?>|.*?(?:--!?>|\Z))|
    <(?P<raw>{RAW})(?=[\s/>]){ATTRIBUTES}(?:/>|>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z))|
    <(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{ATTRIBUTES})(?P<empty>/?)>|
    <[a-zA-Z!?/][^>]*+(?:>|\Z)|(?P<text>[^<]+|<)""", re.S | re.X | re.I)
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+)""")
NAMES = frozenset(("class", "id", "role"))
WORDS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
HOST = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    __slots__ = ("key", "tag", "children")

    def __init__(self, key: str, tag: str):
        self.key, self.tag, self.children = key, tag, []


def _key(tag: str, attrs: str) -> str:
    """Name of an element in a wrapper: its tag and the names in its class, id and role, each cut to
    its words (``div.has-sidebar.post`` of class "post-12 has_sidebar")."""
    tag = tag.replace(".", "-")
    if "=" not in attrs:
        return tag
    names = {"-".join(WORDS.findall(name)) for a, value in ATTRIBUTE.findall(attrs) if a.lower() in NAMES
             for name in value.strip("\"'").lower().split()} - {""}
    return f"{tag}.{'.'.join(sorted(names))}" if names else tag


def parse(page: str) -> Node:
    """Tree of a page; end tags that are left out are implied, those that match nothing ignored.

    Embedded elements (drawings, players, selections) are left out.  One without an end tag holds
    nothing: what follows it belongs to its parent.
    """
    root = Node("", "")
    stack = [root]
    for m in TOKEN.finditer(page):
        text = m["text"]
        if text is not None:
            inner = stack[-1].children
            if inner and isinstance(inner[-1], str):
                inner[-1] += text
            else:
                inner.append(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    _close(stack, k, ended=True)
                    break
            continue
        if tag in ENDS_FOREIGN:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in FOREIGN:
                    _close(stack, k)
                    break
                if stack[k].tag in ENDS_FOREIGN or stack[k].tag in HOLDS_HTML:
                    break
        _imply_ends(stack, tag)
        node = Node(_key(tag, m["attrs"]), tag)
        if tag not in EMBEDDED:
            stack[-1].children.append(node)
        if tag not in VOID and not m["empty"]:
            stack.append(node)
    _close(stack, 1)
    return root


def _close(stack: list[Node], k: int, ended: bool = False) -> None:
    """Close the open elements from the ``k``-th on; ``ended``: that one by its own end tag."""
    for at in range(len(stack) - 1, k - 1, -1):
        node = stack[at]
        if node.tag in EMBEDDED and node.tag not in FOREIGN and not (ended and at == k):
            stack[at - 1].children += node.children
    del stack[k:]


def _imply_ends(stack: list[Node], tag: str) -> None:
    if tag in CLOSES:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in KEEPS[tag]:
                break
            if stack[k].tag in CLOSES[tag]:
                _close(stack, k)
                break
    if tag in ENDS_P:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                _close(stack, k)
                break
            if stack[k].tag in KEEPS_P:
                break


# A wrapper element is [key, quantifier, children, chars, pages]; a text slot is ["#", quantifier,
# its constant text or None, chars, pages].  chars: text below it, summed over the pages seen.
#
# Pages may nest without bound, so nothing here recurses.  Elements are merged at once but for their
# children, whose alignment waits in a queue: (list to fill, children of one, children of the other).
# Both lists are full when their turn comes, since what fills them was queued before.
def wrapper_of(node: Node, pages: int = 1) -> list:
    """The wrapper of one page's element: children in sequence, repeats folded."""
    later: deque = deque()
    top: list = []
    todo: list[tuple] = [(node, None, top)]  # element, its children's wrappers once they are made, where its own goes
    while todo:
        node, made, into = todo.pop()
        if made is None:
            made = []
            todo.append((node, made, into))
            for child in reversed(node.children):
                slot: list = []
                made.append(slot)
                if isinstance(child, str):
                    text = SPACE.sub(" ", child).strip()
                    if text:
                        slot.append(["#", "", text if len(text) <= 200 else None, len(text), pages])
                else:
                    todo.append((child, None, slot))
            made.reverse()
        else:
            children = [slot[0] for slot in made if slot]
            into.append([node.key, "", _folded(children, later), sum(c[3] for c in children), pages])
    _finish(later)
    return top[0]


def _finish(later: deque) -> None:
    while later:
        into, a, b = later.popleft()
        into += _aligned(a, b, later)


def merged(a: list, b: list) -> list:
    """Two wrappers of one element as one."""
    later: deque = deque()
    out = _merged(a, b, later)
    _finish(later)
    return out


def _quantifier(a: str, b: str) -> str:
    optional, repeated = a in "?*" and a != "" or b in "?*" and b != "", a in "+*" and a != "" or b in "+*" and b != ""
    return "*" if optional and repeated else "+" if repeated else "?" if optional else ""


def _merged(a: list, b: list, later: deque, repeat: bool = False) -> list:
    """Two elements or slots of one name as one; ``repeat``: they follow each other on a page."""
    quantifier = _quantifier(_quantifier(a[1], b[1]), "+" if repeat else "")
    pages = max(a[4], b[4]) if repeat else a[4] + b[4]
    if a[0] == "#":
        return ["#", quantifier, a[2] if a[2] == b[2] else None, a[3] + b[3], pages]
    children: list = []
    later.append((children, a[2], b[2]))
    return [a[0], quantifier, children, a[3] + b[3], pages]


def _folded(children: list, later: deque) -> list:
    """A sequence with its adjacent repeats, of one element or a group of several, merged."""
    out: list = []
    for child in children:
        out.append(child)
        for size in range(1, LONGEST_GROUP + 1):
            if len(out) < 2 * size or any(out[k - 2 * size][0] != out[k - size][0] for k in range(size)):
                continue
            if size == 1 and child[0] == "#" and child[1] == "" and out[-2][1] == "":
                continue
            tail, head = out[-size:], out[-2 * size:-size]
            out[-2 * size:] = [_merged(x, y, later, repeat=True) for x, y in zip(head, tail, strict=True)]
            break
    if len(out) > MOST_CHILDREN:
        by_name: dict = {}
        for child in out:
            by_name[child[0]] = _merged(by_name[child[0]], child, later, repeat=True) if child[0] in by_name else child
        out = list(by_name.values())
    return out


def _optional(x: list) -> list:
    return [x[0], _quantifier(x[1], "?"), *x[2:]]


def _aligned(a: list, b: list, later: deque) -> list:
    """Two sequences as one: what matches in order is merged, what does not becomes optional."""
    if len(a) == len(b) and all(x[0] == y[0] for x, y in zip(a, b, strict=True)):
        return [_merged(x, y, later) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if a[i][0] == b[j][0] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if a[i][0] == b[j][0]:
            out.append(_merged(a[i], b[j], later))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return _folded(out + [_optional(x) for x in a[i:]] + [_optional(x) for x in b[j:]], later)


def is_furniture(key: str, kept: frozenset[str] = frozenset()) -> bool:
    """Whether an element's subtree is page furniture: by its tag, or by a name that says so as a whole.

    A name of one furniture word decides.  One beside layout words (share-buttons, content-sidebar),
    beside a name of an article, or ``widget`` does so unless the wrapper speaks against it (``kept``).
    Names with any other word (has-sidebar, social-science) say nothing.
    """
    tag, *names = key.split(".")
    if tag in FURNITURE_TAGS:
        return True
    if not names or tag in NEVER_FURNITURE:
        return False
    if any(n in FURNITURE_WORDS and n != "widget" for n in names) and not any(n in ARTICLE_WORDS for n in names):
        return True
    return key not in kept and any(map(_names_furniture, names))


def _names_furniture(name: str) -> bool:
    words = set(name.split("-"))
    if "header" in words and words & ARTICLE_WORDS:  # the header of an entry holds its title
        return False
    return bool(words & FURNITURE_WORDS) and words <= FURNITURE_WORDS | LAYOUT_WORDS


def _names_article(key: str) -> bool:
    tag, *names = key.split(".")
    return tag in ("article", "main") or any(w in ARTICLE_WORDS for n in names for w in n.split("-"))


def text_holders(wrapper: list) -> frozenset[str]:
    """Names of elements that hold at least half of the wrapper's open text (of all, if none is open)."""
    order, todo = [], [(-1, wrapper)]
    while todo:  # parents before their children
        up, node = todo.pop()
        order.append((up, node))
        todo += [(len(order) - 1, child) for child in node[2] if child[0] != "#"]

    def sizes(constants: bool) -> list[int]:
        below = [sum(c[3] for c in node[2] if c[0] == "#" and (constants or c[2] is None)) for _, node in order]
        for k in range(len(order) - 1, 0, -1):
            below[order[k][0]] += below[k]
        return below

    held = sizes(False)
    if not held[0]:
        held = sizes(True)
    return frozenset(node[0] for (_, node), n in zip(order, held, strict=True) if held[0] and 2 * n >= held[0])


def region(wrapper: list) -> tuple[list[str], frozenset[str]]:
    """Path of names to the element that holds the article, and the names that are no furniture
    since they hold most of the text.

    An article or main element, or one that its class, id or role names so, if it holds text; the
    one with most.  Otherwise the way down from the root is taken as long as one child, a container
    that is no furniture, holds most of the text.
    """
    found: list[tuple[int, tuple]] = []
    kept = text_holders(wrapper)

    todo: list[tuple[list, tuple]] = [(wrapper, ())]
    while todo:  # in page order; a path is a chain of (chain above, name)
        node, path = todo.pop()
        if path and node[3] and _names_article(node[0]):
            found.append((node[3] * (2 if node[0].split(".")[0] == "article" else 1), path))
        todo += [(child, (path, child[0])) for child in reversed(node[2]) if child[0] != "#" and not is_furniture(child[0], kept)]
    if found:
        _, chain = max(found, key=lambda x: x[0])
        path = []
        while chain:
            chain, key = chain
            path.append(key)
        path.reverse()
    else:
        path, node = [], wrapper
        while True:
            inner = [c for c in node[2] if c[0] != "#" and not is_furniture(c[0], kept)]
            own = sum(c[3] for c in inner) + sum(c[3] for c in node[2] if c[0] == "#")
            big = max(inner, key=lambda c: c[3], default=None)
            if big is None or big[3] * 5 < own * 3 or big[0].split(".")[0] not in CONTAINERS or big[1] in ("+", "*"):
                break
            path.append(big[0])
            node = big
    return path, kept


def blocks(node: Node, kept: frozenset[str]) -> list[str]:
    """Texts of the blocks below an element, without furniture, in page order.

    Text that all pages of a host agree on stays: it may as well be a subhead as a notice, and
    only an element's tag and names tell which.
    """
    out: list[str] = []
    pieces: list[str] = []

    def close() -> None:
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text:
                out.append(text)
            pieces.clear()

    todo: list = [iter(node.children)]
    inside: list[bool] = []  # whether each open element below the first is a block
    while todo:
        child = next(todo[-1], None)
        if child is None:
            todo.pop()
            if inside and inside.pop():
                close()
        elif isinstance(child, str):
            pieces.append(child)
        elif child.tag == "br":
            pieces.append(" ")
        elif not is_furniture(child.key, kept):
            block = child.tag in BLOCK
            if block:
                close()
            inside.append(block)
            todo.append(iter(child.children))
    close()
    return out


def article(page: str | None, path: list[str], kept: frozenset[str]) -> str:
    """Main text of a page by its host's region; by its own wrapper if it lacks that region."""
    if not page:
        return ""
    root = parse(page)
    for attempt in range(2):
        level = [root]
        for key in path:
            level = [c for n in level for c in n.children if not isinstance(c, str) and c.key == key]
        texts = [t for n in level for t in blocks(n, kept)]
        if texts or attempt:
            return "\n".join(texts)
        path, kept = region(wrapper_of(root))
    return ""


def _dump(wrapper: list) -> str:
    """A wrapper as JSON: its elements in page order, each with its depth."""
    rows, todo = [], [(0, wrapper)]
    while todo:
        depth, x = todo.pop()
        if x[0] == "#":
            rows.append([depth, *x])
        else:
            rows.append([depth, x[0], x[1], None, x[3], x[4]])
            todo += [(depth + 1, child) for child in reversed(x[2])]
    return json.dumps(rows, ensure_ascii=False, separators=(",", ":"))


def _load(text: str) -> list:
    above: list[list] = [[]]  # children of the open element of each depth
    for depth, name, quantifier, constant, chars, pages in json.loads(text):
        del above[depth + 1:]
        children: list = []
        above[depth].append([name, quantifier, constant if name == "#" else children, chars, pages])
        above.append(children)
    return above[0][0]


def _inferred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial wrapper for each host among a task's pages."""
    known: dict[str, list] = {}
    chars = 0
    for batch in batches:
        for host, page in zip(batch.column(0), batch.column(1), strict=True):
            host, page = host.as_py(), page.as_py()
            if page:
                w = wrapper_of(parse(page))
                known[host] = merged(known[host], w) if host in known else w
                chars += len(page)
                if chars >= PASS_ON_CHARS:  # pass on what there is; it is aligned again below
                    yield _rows(known)
                    known, chars = {}, 0
    yield _rows(known)


def _rows(known: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(known), pa.string()), pa.array([_dump(w) for w in known.values()], pa.string())],
                                      names=["host", "wrapper"])


def _aligned_group(table: pa.Table) -> pa.Table:
    wrapper = None
    for text in sorted(table.column("wrapper").to_pylist()):
        wrapper = merged(wrapper, _load(text)) if wrapper is not None else _load(text)
    return pa.table({"host": pa.array([table.column("host")[0].as_py()], pa.string()), "wrapper": pa.array([_dump(wrapper)], pa.string())})


def host_of(url: str):
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def infer(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, wrapper)``: the wrapper of all pages of each host, as JSON."""
    partial = text_batches(pages).select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).mapInArrow(_inferred, "host string, wrapper string")
    schema = "host string, wrapper string"
    some = partial.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS))).groupBy("host", "part").applyInArrow(_aligned_group, schema)
    return some.groupBy("host").applyInArrow(_aligned_group, schema)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text)`` of every page: the article's blocks, joined by newlines.

    Null or empty html gives empty text; pages without a host share one; repeated rows and rows with
    a null id are pages of their own.  Columns of other names are not read.
    """
    known = stored(infer(pages, url_col, html_col))
    known = known.withColumn("n_pages", F.get_json_object("wrapper", "$[0][5]").cast("long"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    total = known.agg(F.sum("n_pages")).first()[0] or 0
    # a host with more than a thousandth of all pages gets its wrapper by broadcast, any other by a shuffle
    joined = join_keyed(rows, known, "host", "n_pages", total, "left").select("id", "url", "html", "wrapper")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regions: dict[str, tuple] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column(2), batch.column(3), strict=True):
                w = wrapper.as_py()
                if w not in regions:
                    if len(regions) > 5000:
                        regions.clear()
                    regions[w] = region(_load(w)) if w else ([], frozenset())
                texts.append(article(page.as_py(), *regions[w]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_col, url_col, "text"])

    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    return joined.mapInArrow(read, f"`{id_col}` {id_type}, `{url_col}` {url_type}, text string")
