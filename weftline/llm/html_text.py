"""Main text of web pages by wrapper induction.

Some pages of each host are parsed and aligned by simple tree matching: text that stands at the same place in all of
them is template, text that varies marks a slot.  The wrapper also says where the content is: from the root down, the
element in which most of the varying text of all aligned pages lies, whatever its tag or class.  Every page of the host
is then aligned with that wrapper; the slots inside the element that is paired with the content are the main text, less
what the markup itself declares to be menus, adverts and the like.  Where layouts differ, a wrapper has several trees,
and text that is constant in one of them is template.  A host with one distinct page has no wrapper; there the page's
own text, outside what is declared, says where the content is.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, table

#: Distinct pages of a host to learn its wrapper from, those of the least hashes; CELLS share the search for them.
REFERENCES, CELLS = 4, 256
#: Pages that share so much with the first of the text that varies among the references are copies of it.
COPY_SHARE = 0.9
#: Inside the article, constant text counts as template only if so many references agree; outside it, so
#: many make it constant where others lack it.
SURE = 3
#: Elements nested deeper are attached at this depth; child lists with more pairs than this are aligned by halves.
DEPTH, PAIRS = 150, 4_000_000

#: The content lies in the child that has at least this share of the text, as long as there is one.
DOMINANT = 0.6

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe".split())
SKIP = frozenset("script style textarea title noscript xmp iframe head nav footer aside form button select option template svg canvas object video audio dialog menu".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Words in class or id, or values of role, that declare a part other than the article.
DECLARED = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget complementary contentinfo search".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements that never hold text for readers; elements that are always looked into; elements that can hold an article.
HARD = frozenset("script style textarea title noscript xmp iframe head template svg canvas object video audio option select".split())
OPEN = frozenset("#root html body main article".split())
HOLDS = frozenset("#root html body main article div section center form table tbody tr td".split())
_KEEPS_P_OPEN = frozenset("td th body html table button object".split())

_TAG = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")

# A node is [tag, names, children, declared]; a text is ["#", raw, normalised, template].


def parse(page: str) -> list:
    """A tree of elements and texts; unclosed and stray tags are tolerated, a tag cut off at the end is dropped."""
    root = ["#root", "", [], False]
    stack, at, end = [root], 0, len(page)

    def text(raw: str) -> None:
        if raw:
            raw = entities.unescape(raw)
            stack[-1][2].append(["#", raw, _SPACE.sub(" ", raw).strip(), False])

    while at < end:
        m = _TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        slash, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name or (m[0][-1] != ">"):
            continue
        tag = name.lower()
        if slash:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in _KEEPS_P_OPEN or stack[i][0] in BLOCK:
                    break
        if tag in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in CLOSES[tag]:
                    del stack[i:]
                    break
                if stack[i][0] in ("ul", "ol", "dl", "table", "select"):
                    break
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attrs)).lower() if "=" in attrs else ""
        inner = any(x[0] in ("article", "main") for x in stack)  # a section of an article may well be called related-work
        declared = tag not in OPEN and (tag in SKIP or bool(names and not DECLARED.isdisjoint(names.split() if inner else re.split(r"[\s_-]+", names))))
        node = [tag, names, [], declared]
        stack[-1][2].append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not attrs.endswith("/"):
            if len(stack) < DEPTH:
                stack.append(node)
    _settle(root)
    return root


def _settle(root: list) -> None:
    """Take back what is declared of elements around an article, or around nearly all of the page's text."""
    sums: dict[int, tuple[int, bool, bool]] = {}  # characters, whether there is an article and a paragraph
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        if x[0] != "#" and x[0] not in HARD:
            order.append(x)
            stack.extend(x[2])
    for x in reversed(order):
        size, article, p = 0, x[0] in ("article", "main"), x[0] == "p"
        for c in x[2]:
            if c[0] == "#":
                size += len(c[2])
            elif c[0] not in HARD:
                n, a, q = sums[id(c)]
                size, article, p = size + n, article or a, p or q
        sums[id(x)] = (size, article, p)
    total = sums[id(root)][0]
    for x in order:
        size, article, p = sums[id(x)]
        if x[3] and (article or (p and size > 0.8 * total)):
            x[3] = False


def _masses(root: list, template: set[int] | None = None) -> dict[int, int]:
    """Characters of text below each element, without what is declared to be something else and without template."""
    out: dict[int, int] = {}
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        if x[0] != "#" and not x[3]:
            order.append(x)
            stack.extend(x[2])
    for x in reversed(order):
        out[id(x)] = sum((0 if c[3] or (template and id(c) in template) else len(c[2])) if c[0] == "#" else out.get(id(c), 0) for c in x[2])
    return out


def _content(root: list, mass: dict[int, int]) -> list:
    """The deepest element that can hold an article and has most of the text of each one around it."""
    at = root
    while True:
        inner = [c for c in at[2] if c[0] in HOLDS and mass.get(id(c), 0) >= DOMINANT * mass.get(id(at), 0) > 0]
        if not inner:
            return at
        at = inner[0]


def _alike(a: list, b: list) -> bool:
    return a[0] == b[0] and (a[0] == "#" or a[1] == b[1])


def _weight(a: list, b: list, memo: dict) -> int:
    """Nodes that simple tree matching pairs below two nodes, these included; 0 if they differ themselves."""
    if not _alike(a, b):
        return 0
    if a[0] == "#":
        return 1 + (a[2] == b[2])
    key = (id(a), id(b))
    if key not in memo:
        x, y = a[2], b[2]
        row = [0] * (len(y) + 1)
        for p in x:
            new = [0]
            for j, q in enumerate(y):
                best = row[j + 1] if row[j + 1] > new[j] else new[j]
                w = row[j] + _weight(p, q, memo) if p[0] == q[0] else 0
                new.append(w if w > best else best)
            row = new
        memo[key] = 1 + row[-1]
    return memo[key]


def _equal(a: list, b: list) -> bool:
    """The same subtree, texts included; a slot equals nothing."""
    if a[0] == "#" or b[0] == "#":
        return a[0] == b[0] and a[2] is not None and a[2] == b[2]
    return _alike(a, b) and len(a[2]) == len(b[2]) and all(map(_equal, a[2], b[2]))


def _row(u: list, v: list) -> list[int]:
    """Weight of the best matching of all of u with each prefix of v."""
    row = [0] * (len(v) + 1)
    for p in u:
        memo: dict = {}
        new = [0]
        for j, q in enumerate(v):
            s = _weight(p, q, memo)
            new.append(max(row[j + 1], new[j], row[j] + s if s else 0))
        row = new
    return row


def _match(u: list, v: list, memo: dict) -> list[tuple[list, list]]:
    """The pairs of the best matching in order; above PAIRS by halves (Hirschberg), which takes a row of memory only."""
    if not u or not v:
        return []
    if len(u) > 1 and len(u) * len(v) > PAIRS:
        half = len(u) // 2
        before, after = _row(u[:half], v), _row(u[:half - 1 : -1], v[::-1])
        cut = max(range(len(v) + 1), key=lambda j: before[j] + after[len(v) - j])
        return _match(u[:half], v[:cut], memo) + _match(u[half:], v[cut:], memo)
    w = [[0] * (len(v) + 1) for _ in range(len(u) + 1)]
    for i in range(len(u) - 1, -1, -1):
        for j in range(len(v) - 1, -1, -1):
            s = _weight(u[i], v[j], memo)
            w[i][j] = max(w[i + 1][j], w[i][j + 1], s + w[i + 1][j + 1] if s else 0)
    out = []
    i = j = 0
    while i < len(u) and j < len(v):
        s = _weight(u[i], v[j], memo)
        if s and w[i][j] == s + w[i + 1][j + 1]:
            out.append((u[i], v[j]))
            i, j = i + 1, j + 1
        elif w[i][j] == w[i + 1][j]:
            i += 1
        else:
            j += 1
    return out


def align(a: list, b: list, pair, memo: dict | None = None, elements=None) -> None:
    """Call pair(x, y) for the texts of the two trees that simple tree matching pairs, and elements(x, y) for elements.

    Only equal subtrees at both ends are paired beforehand, which is never worse than another matching.
    """
    memo = {} if memo is None else memo
    x, y = a[2], b[2]
    lo = hi = 0
    least = min(len(x), len(y))
    while lo < least and _equal(x[lo], y[lo]):
        lo += 1
    while hi < least - lo and _equal(x[-1 - hi], y[-1 - hi]):
        hi += 1
    both = [(x[i], y[i]) for i in range(lo)] + [(x[-i], y[-i]) for i in range(1, hi + 1)]
    for p, q in both + _match(x[lo : len(x) - hi], y[lo : len(y) - hi], memo):
        if p[0] == "#":
            pair(p, q)
        else:
            if elements:
                elements(p, q)
            align(p, q, pair, memo, elements)


def _texts(node: list) -> Iterator[list]:
    stack = [node]
    while stack:
        x = stack.pop()
        if x[0] == "#":
            yield x
        else:
            stack.extend(x[2])


def induce(pages: list[str]) -> str | None:
    """The wrapper of some pages of a host as JSON: the first page's tree and those of others that know more template;
    None if no page differs from another in more than a few of the texts that vary."""
    roots = [_without_blank(parse(p)) for p in pages]
    trees: list = []
    known: set[str] = set()
    for i, root in enumerate(roots):
        found = _induce(root, roots[:i] + roots[i + 1 :])
        if found and (not trees or found[2] - known):
            trees.append(found[:2])
            known |= found[2]
    return json.dumps(trees, ensure_ascii=False) if trees else None


def _induce(first: list, others: list[list]) -> tuple[int, list, set[str]] | None:
    """The number of pages that agree, the first page's tree, [tag, names, children, whether it is the content], with
    constant texts as strings and slots as null, and the constant texts: those of all pages and, outside articles, of
    SURE that are no copies."""
    texts = list(_texts(first))
    constant = {id(t) for t in texts}
    shared: list[set[int]] = []
    equal: list[tuple[int, int]] = []  # texts of the first page and their equals
    met: list[tuple[int, int, int]] = []  # an element of the first page, its pair, and the pair's page
    for i, other in enumerate(others):
        same: set[int] = set()

        def pair(a: list, b: list, same=same) -> None:
            if a[2] == b[2]:
                same.add(id(a))
                equal.append((id(a), id(b)))

        align(first, other, pair, elements=lambda a, b, i=i: met.append((id(a), id(b), i)))
        if len(same) < len(texts) or len(same) < sum(1 for _ in _texts(other)):
            shared.append(same)
            constant &= same
    varying = sum(len(t[2]) for t in texts if id(t) not in constant)
    apart = [same for same in shared if not sum(len(t[2]) for t in texts if id(t) in same - constant) >= COPY_SHARE * varying > 0]
    agree = 1 + len(apart)
    if agree < 2:
        return None
    known = constant | {b for a, b in equal if a in constant}
    mass, of = _masses(first, known), [_masses(other, known) for other in others]
    for a, b, i in met:
        if a in mass:
            mass[a] += of[i].get(b, 0)
    mass[id(first)] += sum(m[id(other)] for m, other in zip(of, others, strict=True))
    content = _content(first, mass)
    inner = {id(t) for top in _articles(first) for t in _texts(top)}  # copied passages are common there
    constant |= {id(t) for t in texts if id(t) not in inner and sum(id(t) in same for same in apart) >= SURE - 1}

    def dump(x: list):
        return (x[2] if id(x) in constant else None) if x[0] == "#" else [x[0], x[1], [dump(c) for c in x[2]], x is content and x is not first]

    return agree, dump(first), {t[2] for t in texts if id(t) in constant}


def load(wrapper: str) -> list[tuple[int, list]]:
    def tree(x):
        return ["#", x, x, False] if x is None or isinstance(x, str) else [x[0], x[1], [tree(c) for c in x[2]], x[3]]

    return [(agree, tree(root)) for agree, root in json.loads(wrapper)]


def _articles(root: list) -> list[list]:
    """The outermost article or main elements that nothing around them declares to be something else."""
    found, stack = [], [root]
    while stack:
        x = stack.pop()
        if x[0] == "#" or x[3]:
            continue
        if x[0] in ("article", "main"):
            found.append(x)
        else:
            stack.extend(reversed(x[2]))
    return found


def extract(page: str, wrapper: list[tuple[int, list]] | None) -> str:
    """The page's main text: blocks in page order, white space inside one made single, joined by blank lines."""
    root = parse(page)
    top = None
    if wrapper:
        seen, back = _without_blank(root), {}
        _places(root, seen, back)
        template: list[tuple[int, list]] = []

        def mark(a: list, b: list) -> None:
            if a[2] is not None and a[2] == b[2]:
                template.append((agree, b))

        def found(a: list, b: list) -> None:
            nonlocal top
            if a[3] and top is None and not b[3]:
                top = back[id(b)]

        for agree, tree in wrapper:
            align(tree, seen, mark, elements=found)
        # Two pages that agree don't make a passage of an article template: it may be copied.
        inner = {id(t) for x in _articles(root) for t in _texts(x)}
        for agree, b in template:
            if agree >= SURE or id(b) not in inner:
                b[3] = True
    if top is None:
        # Without a wrapper that knows, articles are the content if most of the page's text is theirs.
        mass, tops = _masses(root), _articles(root)
        if not sum(mass.get(id(x), 0) for x in tops) >= 0.5 * mass[id(root)]:
            tops = []
        top = ["#content", "", tops, False] if tops else _content(root, mass)
    inside = top is not root
    blocks: list[str] = []
    line: list[tuple[str, bool]] = []

    def flush() -> None:
        """A block is template only if all its texts are: a constant word inside a varying paragraph is content."""
        if not all(constant for raw, constant in line if raw.strip()):
            blocks.append(_SPACE.sub(" ", "".join(raw for raw, _ in line)).strip())
        line.clear()

    def walk(x: list) -> None:
        for c in x[2]:
            if c[0] == "#":
                line.append((c[1], c[3]))
            elif c[0] == "br":
                line.append((" ", True))
            elif c[3] or (c[0] == "header" and not inside):
                flush()
            elif c[0] in BLOCK:
                flush()
                walk(c)
                flush()
            else:
                walk(c)

    walk(top)
    flush()
    return "\n\n".join(blocks)


def _without_blank(x: list) -> list:
    """The same nodes without texts of white space, for the alignment."""
    return x if x[0] == "#" else [x[0], x[1], [_without_blank(c) for c in x[2] if c[0] != "#" or c[2]], x[3]]


def _places(x: list, y: list, back: dict[int, list]) -> None:
    """back: the element of x for each of y, which is x without blank texts."""
    stack = [(x, y)]
    while stack:
        x, y = stack.pop()
        back[id(y)] = x
        stack.extend((c, d) for c, d in zip((c for c in x[2] if c[0] != "#"), (d for d in y[2] if d[0] != "#"), strict=True))


def _wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        made = [(h, induce(pages)) for h, pages in zip(b.column("host").to_pylist(), b.column("pages").to_pylist(), strict=True)]
        made = [x for x in made if x[1]]
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in made], pa.string()) for i in (0, 1)], names=["host", "wrapper"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: tuple = (None, None)
    for b in batches:
        out = []
        for page, wrapper in zip(b.column("html").to_pylist(), b.column("wrapper").to_pylist(), strict=True):
            if wrapper is not None and wrapper != last[0]:
                last = (wrapper, load(wrapper))
            out.append(extract(page or "", last[1] if wrapper is not None else None))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages.

    Null or empty html gives the empty text.  A null url, or one without a host, is of the host ''.  Rows that repeat a
    page are each extracted, with equal results; copies among a host's references teach nothing.  An empty table gives
    no rows, and other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    least = lambda c: F.slice(F.array_sort(c), 1, REFERENCES)
    some = rows.where("html is not null").withColumn("h", F.xxhash64("html"))
    cells = some.select("host", "h").distinct().groupBy("host", F.pmod("h", F.lit(CELLS))).agg(least(F.collect_list("h")).alias("hs"))
    chosen = materialize(cells.groupBy("host").agg(least(F.flatten(F.collect_list("hs"))).alias("hs")).where("size(hs) > 1").select("host", F.explode("hs").alias("h")), "references")
    found = some.join(chosen, ["host", "h"]).groupBy("host", "h").agg(F.min("html").alias("html"))
    samples = found.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("h", "html"))).alias("m")).select("host", F.transform("m", lambda x: x["html"]).alias("pages"))  # REFERENCES at most
    wrappers = materialize(samples.where(F.size("pages") > 1).mapInArrow(_wrap, "host string, wrapper string"), "wrappers")
    text = rows.join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper").mapInArrow(_read, "page_id bigint, url string, text string")
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
