"""Main text of web pages by union-free wrappers.

Every host gets one wrapper, a union-free regular expression over its pages' block elements: the block streams of its pages
are aligned one after the other by longest common subsequences of blocks that are alike, like neighbours become a repeated group, blocks that one side lacks become optional, and texts that differ become slots while
texts that stay the same, single ones and those at either end of a repeated group, are constants of the template. Blocks are
alike if their labels are equal (tag and classes, digits masked) and, where no class without digits tells more, so are the
labels inside them, two levels deep; so menus, bodies and footers stay apart on hosts without classes, too.

A page's own wrapper is a shape (labels and groups) and statistics that add up, so pages of one shape are one row however
many there are, and shapes are aligned in the order of their hashes, in a tree of bounded steps: the wrapper of a host does
not depend on how its pages lie in partitions, and no task holds more than a bounded number of shapes.

The wrapper decides. The main element is the one with most varying prose, or the one around many such: text in slots, not in links, and
little of it in records (repeated groups that begin with a short field, such as comments and teasers, but interviews and steps as
well). Outside the main element records go with all else; inside it they stay, unless every item holds the same link (to answer, say). Tags and classes that mean an article, or menus,
notices and so on, only weigh in, by 1 + 16 / pages: on a host with few pages they matter most. Within the main element
constants (up to 40 characters for each page that has them; on fewer than five pages only while they are a small share of the element, for such
pages may be copies), lists of links, template slots outside the flow of paragraphs and what tags and classes exclude go. A
heading of first level before the main element belongs to it. A page that lacks the host's main element is read by the
wrapper of its own, in the same way.

Null or empty html, or none but excluded parts: empty text. Unclosed and misnested tags, cut-off pages, any depth, long
attributes and texts, and markup inside scripts are read whole. Null urls form one host. Rows with equal html on one host
get equal text, rows that repeat an id stay rows; extra columns are ignored; an empty table gives none. A wrapper of more
than ``NODES`` blocks sheds its rarest optional ones; pages that have them read these by the rules for unknown blocks, and
where the shed text outweighs the main element the host's pages are read by wrappers of their own.
"""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections.abc import Generator, Iterator
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrata.functions.shipping import ship_package
from narrata.llm.common import cut, partitions, table

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|iframe|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*+"|'[^']*+'|["'])*?)(?:>|\Z)|([^<]+|<)""",
    re.S | re.I,
)
_MARKS = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: What a start tag closes if it is open nearest (within the same holder).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDERS = frozenset("ul ol menu dl table select article section div body html main nav aside header footer form".split())
NOT_TEXT_TAGS = frozenset("head nav footer aside form button select menu dialog object canvas audio video label input".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising alert banner breadcrumb breadcrumbs byline-share comment comments complementary consent contentinfo cookie cookies copyright disqus footer gdpr header "
    "masthead menu modal nav navbar navigation newsletter notice notification outbrain pager pagination popup promo promoted promotion related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription taboola toolbar widget".split()
)
MAIN_TAGS, MAIN_WORDS = ("article", "main"), frozenset(("articlebody", "main"))
#: Tags whose texts count for the element around them; inline tags that mark words up and do not make a field of a record.
THROUGH = frozenset("ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption center details summary address".split())
MARKUP = frozenset("b strong em i u code mark sub sup small q br".split())
HOLDS = frozenset("#root div section article main td center form fieldset li details".split())
RECORDS = frozenset("div li section article ul dl details".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
SPACES = frozenset(("br", "hr"))
#: Lengths of a prose text, a short field and a record; blocks of a wrapper; shapes aligned in one task; statistics of a block.
PROSE, FIELD, RECORD, NODES, FAN, STATISTICS = 40, 40, 200, 4000, 64, 9
#: How like the insides of two blocks without classes have to be to fold as neighbours, and to be one block of two pages.
FOLD, PAIR = 0.5, 0.3
#: Share of the main element that may be constant for its constants to be the template's, by the number of pages (more: any share).
#: A constant may be FIELD characters long for each page that has it; longer ones are more likely shared text.
CONSTANT_SHARE = {1: 0.0, 2: 0.2, 3: 0.35, 4: 0.5}
SMALL_TABLE = 32 << 20
HELD_SHAPES = 4000


class Element:
    __slots__ = ("children", "inner", "label", "parts", "tag", "words")

    def __init__(self, tag: str, marks: str = ""):
        found = [(k.lower(), a or b or c) for k, a, b, c in _MARKS.findall(marks)] if marks else []
        self.tag, self.children, self.inner = tag, [], False
        self.words = {w.lower() for _, v in found for w in v.split()} if found else frozenset()
        self.parts = {part for w in self.words for part in re.split(r"[-_:]+", w)} if found else frozenset()
        classes = {re.sub(r"\d+", "0", w.lower()) for k, v in found if k == "class" for w in v.split()}
        known = {w for k, v in found if k != "class" for w in v.lower().split() if w in NOT_TEXT_WORDS or w in MAIN_WORDS}
        self.label = ".".join([tag, *sorted(classes | known)]) if found else tag


def parse(page: str) -> Element:
    """The page's tree; texts are plain strings among the children."""
    root = Element("#root")
    root.inner = True
    stack = [root]
    for m in _TOKEN.finditer(page):
        tag = m[3]
        if m[5] is not None:
            stack[-1].children.append(m[5])
        elif tag is None:
            continue
        elif not m[2]:
            tag = tag.lower()
            block = tag in BLOCK
            if block or tag in CLOSES:
                for at in range(len(stack) - 1, 0, -1):
                    held = stack[at].tag
                    if held in CLOSES.get(tag, ()) or (held == "p" and block and tag != "br"):
                        del stack[at:]
                        break
                    if held in HOLDERS or held in ("td", "th"):
                        break
            node = Element(tag, m[4])
            stack[-1].children.append(node)
            if block and tag not in SPACES:
                for over in reversed(stack):
                    if over.inner:
                        break
                    over.inner = True
            if tag not in VOID and not m[4].endswith("/"):
                stack.append(node)
        else:
            tag = tag.lower()
            for at in range(len(stack) - 1, 0, -1):
                if stack[at].tag == tag:
                    del stack[at:]
                    break
                if stack[at].tag in HOLDERS and tag not in HOLDERS:
                    break
    return root


def _hash(text: str) -> int | None:
    return zlib.crc32(text.encode("utf-8", "replace")) if text else None


class Block:
    """A block of a page or of a wrapper.

    ``n`` times seen, on ``pages`` pages; a leaf has the sums of its texts' lengths, of the parts in links and of a leading
    field (-1: not in all), and the hashes of its text, of the first and of the last of a group and of the words in its links
    beside other text, where they are always equal.
    """

    __slots__ = ("_inside", "chars", "const", "first", "kids", "label", "last", "lead", "linked", "links", "n", "of", "pages", "repeated", "text")

    def __init__(self, label: str, of: Element | None = None, text: str = "", links: int = 0, lead: int = -1, linked: str = ""):
        self.label, self.of, self.text, self.kids, self.n, self.pages, self.repeated, self._inside = label, of, text, [], 1, 1, False, None
        self.chars, self.links, self.lead = len(text), links, lead
        self.const = self.first = self.last = _hash(text)
        self.linked = _hash(linked) if 0 < links < len(text) else None

    def inside(self) -> frozenset[str]:
        """Labels of the blocks inside, two levels deep; empty for a leaf."""
        if self._inside is None:
            self._inside = frozenset({k.label for k in self.kids} | {f"{k.label}>{g.label}" for k in self.kids for g in k.kids})
        return self._inside


def _unwanted(node: Element) -> bool:
    """Inline: by tag or whole word."""
    return node.tag in NOT_TEXT_TAGS or not NOT_TEXT_WORDS.isdisjoint(node.words)


def _leaf(label: str, of: Element | None, run: list) -> Block:
    """A block without blocks inside; excluded inline elements are no part of its text."""
    out, links, lead, steady, anchors = [], 0, -1, True, []
    markup = MARKUP if of is None or of.tag != "div" else ("br",)
    stack = [(child, False, 0) for child in reversed(run)]
    while stack:
        child, linked, depth = stack.pop()
        if isinstance(child, str):
            text = entities.unescape(child) if "&" in child else child
            out.append(text)
            full = len(" ".join(text.split())) if linked or (depth and steady) or not text.isspace() else 0
            if linked:
                links += full
                anchors.append(text)
            if full and steady:
                steady = depth > 0
                if steady:
                    lead = max(lead, 0) + full
        elif child.tag in SPACES:
            out.append(" ")
        elif not _unwanted(child):
            first = depth == 0 and steady and lead < 0 and child.tag not in markup
            steady = steady and (first or depth > 0)
            stack += [(c, linked or child.tag == "a", 1 if first or depth else 0) for c in reversed(child.children)]
    return Block(label, of, " ".join("".join(out).split()), links, lead, " ".join("".join(anchors).split()))


def _label(node: Element) -> str:
    """Paragraphs and lower headings without classes are of one label each."""
    if node.label in ("h2", "h3", "h4", "h5", "h6"):
        return "h"
    return "p" if node.label in ("p", "blockquote", "pre") and not node.inner else node.label


def blocks(root: Element) -> Block:
    """The page's tree of blocks; html and body are seen through."""
    top = Block("#root", root)
    stack = [(top, iter(root.children), [])]
    while stack:
        over, rest, run = stack[-1]
        for child in rest:
            if isinstance(child, Element) and (child.inner or (child.tag in BLOCK and child.tag not in SPACES)):
                _flush(over, run)
                if child.tag in ("html", "body"):
                    stack.append((over, iter(child.children), []))
                    break
                if child.inner:
                    node = Block(_label(child), child)
                    over.kids.append(node)
                    stack.append((node, iter(child.children), []))
                    break
                leaf = _leaf(_label(child), child, child.children)
                if leaf.text or child.tag in MAIN_TAGS:
                    over.kids.append(leaf)
            else:
                run.append(child)
        else:
            _flush(over, run)
            stack.pop()
    return top


def _flush(over: Block, run: list) -> None:
    if run and (leaf := _leaf("#", None, run)).text:
        over.kids.append(leaf)
    run.clear()


# Alignment recurses by generators that yield the calls they wait for, so that no depth of a page is too deep.


def _run(call: Generator):
    stack, value = [call], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as done:
            stack.pop()
            value = done.value
    return value


def _summed(a: Block, b: Block, within: bool) -> Block:
    """One leaf, or one block still without its inside, for two of the same label, of one page or of two."""
    out = Block(a.label)
    out.n, out.chars, out.links, out.repeated = a.n + b.n, a.chars + b.chars, a.links + b.links, a.repeated or b.repeated or within
    out.pages = max(a.pages, b.pages) if within else a.pages + b.pages
    out.lead = -1 if a.lead < 0 or b.lead < 0 else a.lead + b.lead
    same = lambda x, y: x if x == y else None
    out.const, out.linked = same(a.const, b.const), same(a.linked, b.linked)
    out.first, out.last = (a.first, b.last) if within else (same(a.first, b.first), same(a.last, b.last))
    return out


def _aligned(a: Block, b: Block, within: bool) -> Generator:
    out = _summed(a, b, within)
    if a.kids and b.kids:
        out.kids = yield _sequence(a.kids, b.kids)
    else:
        out.kids = a.kids or b.kids
    return out


@lru_cache(maxsize=1 << 16)
def _telling(label: str) -> bool:
    """Has it a class without digits (which are masked as 0)?"""
    return any("0" not in word for word in label.split(".")[1:])


def _alike(a: Block, b: Block, least: float) -> bool:
    """One block of the template? Labels are equal; where no class without digits tells more, the insides are alike as well."""
    if a.label != b.label:
        return False
    if not (a.kids or b.kids) or _telling(a.label):
        return True
    x, y = a.inside(), b.inside()
    return len(x & y) > least * len(x | y) if x and y else False


def _pairs(a: list[Block], b: list[Block]) -> Iterator[tuple[Block | None, Block | None]]:
    """Two sequences side by side, along a longest common subsequence of blocks that are alike.

    Its lengths are kept as bits of whole numbers, a row for each of ``a``, so long lists are aligned exactly as well.
    """
    head = 0
    while head < min(len(a), len(b)) and _alike(a[head], b[head], PAIR):
        yield a[head], b[head]
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and _alike(a[-1 - tail], b[-1 - tail], PAIR):
        tail += 1
    x, y = a[head : len(a) - tail], b[head : len(b) - tail]
    full = (1 << len(y)) - 1
    kinds: dict[tuple, list] = {}
    for j, node in enumerate(y):
        held = kinds.setdefault((node.label, None if _telling(node.label) else node.inside()), [node, 0])
        held[1] |= 1 << j
    fits: dict[tuple, int] = {}
    rows = [full]  # bit j of row i is 0 where the longest for the first i of x grows with the jth of y
    for node in x:
        kind = node.label, None if _telling(node.label) else node.inside()
        if kind not in fits:
            fits[kind] = sum(bits for other, bits in kinds.values() if _alike(node, other, PAIR))
        held = rows[-1] & fits[kind]
        rows.append(((rows[-1] + held) | (rows[-1] - held)) & full)
    longest = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    i, j, matched = len(x), len(y), []
    while i or j:
        if i and j and longest(i - 1, j) < longest(i, j) and longest(i, j - 1) < longest(i, j):
            i, j = i - 1, j - 1
            matched.append((x[i], y[j]))
        elif j and (not i or longest(i, j - 1) == longest(i, j)):
            j -= 1
            matched.append((None, y[j]))
        else:
            i -= 1
            matched.append((x[i], None))
    yield from reversed(matched)
    yield from zip(a[len(a) - tail :], b[len(b) - tail :], strict=True)


def _sequence(a: list[Block], b: list[Block]) -> Generator:
    out = []
    for x, y in _pairs(a, b):
        if x is None or y is None:
            out.append(x or y)
        elif x.kids or y.kids:
            out.append((yield _aligned(x, y, False)))
        else:
            out.append(_summed(x, y, False))
    return (yield _folded(out))


def _folded(nodes: list[Block]) -> Generator:
    """Neighbours that are alike become one repeated block; so do like pairs of neighbours (term and description, say)."""
    out: list[Block] = []
    for node in nodes:
        if out and _alike(out[-1], node, FOLD):
            out[-1] = (yield _aligned(out[-1], node, True)) if node.kids or out[-1].kids else _summed(out[-1], node, True)
        elif len(out) > 2 and _alike(out[-2], node, FOLD) and _alike(out[-3], out[-1], FOLD):
            last = out.pop()
            out[-2] = yield _aligned(out[-2], last, True)
            out[-1] = yield _aligned(out[-1], node, True)
        else:
            out.append(node)
    return out


def _wrapped(top: Block) -> Generator:
    out = _summed_alone(top)
    inside = []
    for kid in top.kids:
        inside.append((yield _wrapped(kid)) if kid.kids else kid)
    out.kids = yield _folded(inside)
    return out


def _summed_alone(node: Block) -> Block:
    out = Block(node.label)
    out.chars, out.links, out.lead, out.const, out.first, out.last, out.linked = node.chars, node.links, node.lead, node.const, node.first, node.last, node.linked
    return out


def wrapper_of(top: Block) -> Block:
    """The wrapper of one page alone."""
    return _run(_wrapped(top))


def preorder(top: Block) -> list[tuple[Block, int]]:
    """Blocks in page order, each with the place of the block around it."""
    out, stack = [], [(top, -1)]
    while stack:
        node, over = stack.pop()
        out.append((node, over))
        at = len(out) - 1
        stack += [(kid, at) for kid in reversed(node.kids)]
    return out


def _thinned(top: Block) -> Block:
    """``top`` with its rarest blocks folded into a star while it has more than ``NODES``."""
    rare = 1
    while len(listed := preorder(top)) > NODES and rare < top.n:
        for node, _ in listed:
            gone = [k for k in node.kids if k.label == "*" or k.pages <= rare]
            if len(gone) > 1:
                star = Block("*")
                star.n, star.pages, star.const, star.chars = sum(k.n for k in gone), max(k.pages for k in gone), None, 0
                for k in gone:
                    star.chars += sum(x.chars for x, _ in preorder(k))
                node.kids = [*[k for k in node.kids if k.label != "*" and k.pages > rare], star]
        rare *= 2
    return top


def joined(a: Block, b: Block) -> Block:
    """The wrapper of both."""
    return _thinned(_run(_aligned(a, b, False)))


def shape(top: Block) -> tuple[str, list[int]]:
    """A wrapper as its shape, by which equal ones are found, and its statistics (-1: none, for hashes)."""
    labels, sums = [], []
    for node, _ in preorder(top):
        labels.append([node.label, int(node.repeated), len(node.kids)])
        hashes = [-1 if h is None else h for h in (node.const, node.first, node.last, node.linked)]
        sums += [node.n, node.pages, node.chars, node.links, node.lead, *hashes]
    return json.dumps(labels, separators=(",", ":"), ensure_ascii=False), sums


def added(a: list[int], b: list[int]) -> list[int]:
    """The statistics of two wrappers of one shape."""
    out = [x + y for x, y in zip(a, b, strict=True)]
    for at in range(0, len(out), STATISTICS):
        if a[at + 4] < 0 or b[at + 4] < 0:
            out[at + 4] = -1
        for k in range(at + 5, at + STATISTICS):
            out[k] = a[k] if a[k] == b[k] else -1
    return out


def unshaped(labels: str, sums: list[int]) -> Block:
    made, open_ = [], []
    for k, (label, repeated, kids) in enumerate(json.loads(labels)):
        node = Block(label)
        node.repeated = bool(repeated)
        node.n, node.pages, node.chars, node.links, node.lead, *hashes = (int(x) for x in sums[STATISTICS * k : STATISTICS * (k + 1)])
        node.const, node.first, node.last, node.linked = (None if h == -1 else h for h in hashes)
        if open_:
            open_[-1][0].kids.append(node)
            open_[-1][1] -= 1
            if not open_[-1][1]:
                open_.pop()
        if kids:
            open_.append([node, kids])
        made.append(node)
    return made[0]


def _words(label: str) -> tuple[str, set[str]]:
    tag, *words = label.split(".")
    return tag, set(words)


def decide(top: Block) -> list | None:
    """What to read on pages of this wrapper, as nested lists: label, which of its siblings of this label, how many those
    are, action, hashes, inner ones. Actions: "" look inside, main, keep, drop, const (drop what has this hash), ends."""
    listed = preorder(top)
    count, pages = len(listed), top.n
    node = [x for x, _ in listed]
    over = [o for _, o in listed]
    named = [_words(x.label) for x in node]
    leaf = [not x.kids for x in node]
    kids_at: list[list[int]] = [[] for _ in range(count)]
    for i in range(1, count):
        kids_at[over[i]].append(i)
    grown = pages >= 2 and any(f and x.const is None and x.chars for x, f in zip(node, leaf, strict=True))
    prior = 1 + 16 / pages
    constant = [grown and f and x.const is not None and 2 * x.n >= pages for x, f in zip(node, leaf, strict=True)]
    out = [t in NOT_TEXT_TAGS or not NOT_TEXT_WORDS.isdisjoint(w) for t, w in named]
    whole, links, prose, below, record = [0] * count, [0] * count, [0.0] * count, [0.0] * count, [False] * count
    for i in range(count - 1, -1, -1):
        x, (tag, _) = node[i], named[i]
        if leaf[i]:
            whole[i], links[i] = x.chars, x.links
            record[i] = x.repeated and tag in RECORDS and x.lead > 0 and x.lead <= FIELD * x.n and x.lead < 0.6 * x.chars
            if not constant[i] and x.label != "*" and 2 * x.links <= x.chars:
                prose[i] = (x.chars - x.links) * min(1.0, x.chars / x.n / PROSE)
        elif x.repeated and tag in RECORDS and all(not k.kids and k.n <= x.n for k in x.kids) and len(x.kids) > 1:
            first = x.kids[0]
            headed = first.label.split(".")[0] in ("h", *HEADINGS)
            record[i] = first.n >= x.n and first.chars <= FIELD * first.n and (not headed or whole[i] <= RECORD * x.n)
        less = (0.1 if record[i] else 1) * (0.1 / prior if out[i] else 1)
        weight = prose[i] * less
        below[i] = prose[i] if leaf[i] else below[i]
        if over[i] >= 0:
            below[over[i]] += below[i] * less
            whole[over[i]] += whole[i]
            links[over[i]] += links[i]
            if leaf[i]:
                prose[over[i]] += weight * (0.5 if tag in HOLDS and not x.repeated and tag != "li" else 1)
            elif tag in THROUGH or x.repeated:
                prose[over[i]] += weight
    factor, main, aside = [1.0] * count, [False] * count, [False] * count
    best, most = 0, -1.0
    for i in range(count):
        tag, words = named[i]
        factor[i] = (factor[over[i]] if i else 1.0) * (0.1 / prior if out[i] else 1) * (0.1 if record[i] else 1)
        aside[i] = out[i] or record[i] or (i > 0 and aside[over[i]])
        own = (tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words)) and not out[i]
        main[i] = own or (i > 0 and main[over[i]])
        score = prose[i] * factor[i] * (prior if main[i] else 1)
        if tag in HOLDS and score > most:
            best, most = i, score
    if sum(x.chars for x in node if x.label == "*") > max(most, 0):
        return None
    while best > 0 and not main[best] and prose[best] < 0.4 * below[over[best]]:  # one of many blocks that hold the text
        best = over[best]
    plain = [prose[i] if leaf[i] and not aside[i] else 0.0 for i in range(count)]
    for i in range(count - 1, 0, -1):
        plain[over[i]] += plain[i]
    at, found = best, not main[best]
    while found:  # down to the block that holds all prose but that of records and excluded parts
        at = next((j for j in kids_at[at] if plain[j] >= 0.99 * plain[best] > 0 and not aside[j]), -1)
        found = at >= 0 and not leaf[at]
        if found and named[at][0] in HOLDS:
            best = at
    at = best
    while at > 0:  # up to the nearest single article around it
        tag, words = named[at]
        if (tag in MAIN_TAGS or not MAIN_WORDS.isdisjoint(words)) and not out[at] and (at == best or not node[at].repeated):
            best = at
            break
        at = over[at]
    inside = lambda i, j: i == j or (i > j and inside_of[i])
    inside_of = [False] * count
    for i in range(count):
        inside_of[i] = i == best or (i > 0 and inside_of[over[i]])
    act: list[tuple] = [("",)] * count
    useful = [False] * count
    act[best], useful[best] = ("main",), True
    fixed = sum(node[i].chars for i in range(best, count) if inside(i, best) and constant[i])
    certain = fixed <= CONSTANT_SHARE.get(pages, 1.0) * whole[best]
    # talk inside the main element: items that all hold the same link, to answer say
    stamped = [record[i] and pages >= 2 and node[i].pages >= 2 and (node[i].linked is not None if leaf[i] else any(constant[j] and node[j].links for j in kids_at[i])) for i in range(count)]
    flow = sum(node[i].chars for i in range(best, count) if inside(i, best) and leaf[i] and named[i][0] in ("p", "h", "li", "td", "th", "dd", "dt", "figcaption", *HEADINGS))
    kept = [0] * count
    for i in range(count - 1, best - 1, -1):
        if not inside(i, best):
            continue
        x, (tag, words) = node[i], named[i]
        if i != best:
            ends = grown and certain and leaf[i] and x.repeated and (x.first is not None or x.last is not None) and x.const is None
            if stamped[i]:
                act[i] = ("drop",)
            elif constant[i] and certain and x.chars <= FIELD * pages * x.n and tag != "h1":
                act[i] = ("const", x.const)
            elif (tag in ("ul", "ol", "div", "section", "table", "dl") or (tag == "td" and whole[i] >= FIELD * x.n)) and whole[i] and links[i] >= 0.6 * whole[i]:
                act[i] = ("drop",)
            elif grown and pages >= 5 and leaf[i] and tag in ("div", "section") and not x.repeated and 2 * x.pages >= pages and flow >= 0.8 * whole[best]:
                act[i] = ("drop",)
            elif ends:
                act[i] = ("ends", x.first, x.last, FIELD * pages)
            elif not leaf[i] and kept[i] < 0.3 * whole[i] and tag not in ("td", "tr"):
                act[i] = ("drop",)
            useful[i] = useful[i] or act[i] != ("",)
            if act[i][0] in ("", "ends") and not out[i]:
                kept[over[i]] += whole[i] if leaf[i] else kept[i]
            useful[over[i]] = useful[over[i]] or useful[i]
        elif leaf[i]:
            kept[i] = whole[i]
    if not any(inside(i, best) and named[i][0] == "h1" for i in range(best, count)):
        for i in range(best - 1, 0, -1):
            if named[i][0] == "h1" and leaf[i] and not constant[i] and factor[i] == factor[over[i]] and factor[i] >= 1 and i != best:
                act[i], useful[i] = ("keep",), True
                break
    for i in range(count - 1, 0, -1):
        useful[over[i]] = useful[over[i]] or useful[i]
    for i in range(1, count):  # of like siblings all are told, so that a page's can be told apart
        if useful[i] and not _telling(node[i].label):
            for j in kids_at[over[i]]:
                useful[j] = useful[j] or node[j].label == node[i].label
    told: dict[int, list] = {}
    for i in range(count):
        if not useful[i] and i:
            continue
        kin = [k for k in node[over[i]].kids if k.label == node[i].label] if i else [top]
        inner = sorted(node[i].inside()) if len(kin) > 1 and not _telling(node[i].label) else []
        told[i] = [node[i].label, next(k for k, x in enumerate(kin) if x is node[i]), len(kin), act[i][0], list(act[i][1:]), [], inner]
        if i:
            told[over[i]][5].append(told[i])
    return told[0]


def _matched(kids: list[Block], known: list[list]) -> list[list | None]:
    """Which known block each of a page's blocks is: by label and, where siblings share it, by runs of like blocks in their order."""
    by: dict[str, list[list]] = {}
    for d in known:
        by.setdefault(d[0], []).append(d)
    runs: dict[str, list[list[int]]] = {}
    for at, kid in enumerate(kids):
        if kid.label in by:
            own = runs.setdefault(kid.label, [])
            if own and own[-1][-1] == at - 1 and _alike(kids[own[-1][0]], kid, FOLD):
                own[-1].append(at)
            else:
                own.append([at])
    out: list[list | None] = [None] * len(kids)
    for label, own in runs.items():
        for run, d in zip(own, _placed([kids[run[0]] for run in own], by[label]), strict=True):
            for at in run:
                out[at] = d
    return out


def _placed(first: list[Block], known: list[list]) -> list[list | None]:
    """Runs of one label at the wrapper's blocks of that label, in order, by the likeness of their insides."""
    count = known[0][2]
    if count == 1 or _telling(known[0][0]) or len(known) < count or len(first) * count > 10_000:
        return [next((d for d in known if d[1] == min(k, count - 1)), None) for k in range(len(first))]

    def like(x: frozenset, d: list) -> float:
        y = frozenset(d[6])
        return 1.0 if not x and not y else len(x & y) / min(len(x), len(y)) + len(x & y) / len(x | y) if x and y else 0.0

    # best[i][k]: the likeness of the runs from i on with the blocks from k on, where several runs may be one block
    best = [[0.0] * (count + 1) for _ in range(len(first) + 1)]
    score = [[like(x.inside(), d) for d in known] for x in first]
    for i in range(len(first) - 1, -1, -1):
        for k in range(count - 1, -1, -1):
            best[i][k] = max(best[i][k + 1], best[i + 1][k], score[i][k] + max(best[i + 1][k + 1], 0.5 * best[i + 1][k]))
    out, i, k = [], 0, 0
    while i < len(first):
        if k < count and score[i][k] > 0 and best[i][k] == score[i][k] + max(best[i + 1][k + 1], 0.5 * best[i + 1][k]):
            out.append(known[k])
            k += best[i + 1][k + 1] >= 0.5 * best[i + 1][k]
            i += 1
        elif k < count and best[i][k] == best[i][k + 1]:
            k += 1
        else:
            out.append(None)
            i += 1
    return out


def _kept(node: Block, heading_only: bool) -> tuple[bool, bool]:
    """Whether a block in the main element is read, and whether only headings in it are: by its tag and words."""
    of = node.of
    if of is None:
        return not heading_only, heading_only
    headed = of.tag in HEADINGS
    if of.tag == "header" or (of.tag in ("div", "section") and not {"header", "masthead"}.isdisjoint(of.parts)):
        return bool(node.kids), True
    if _unwanted(of) or (of.tag in ("div", "ul", "ol", "section", "table", "dl") and not NOT_TEXT_WORDS.isdisjoint(of.parts)):
        return False, heading_only
    return headed or not heading_only or bool(node.kids), heading_only and not headed


def _found(top: Block, decision: list) -> tuple[list, bool]:
    """Blocks to read with what is known of them, in page order, and whether the main element is among them."""
    out, stack, whole = [], [(top, decision)], False
    while stack:
        node, d = stack.pop()
        if d[3] == "main" or d[3] == "keep":
            out.append((node, d))
            whole = whole or d[3] == "main"
        elif d[5]:
            stack += [(kid, k) for kid, k in reversed(list(zip(node.kids, _matched(node.kids, d[5]), strict=True))) if k is not None]
    return out, whole


def _read(region: Block, d: list, out: list[str]) -> None:
    stack = [(region, d, d[3] == "keep", True)]
    while stack:
        node, d, heading_only, first = stack.pop()
        if not first:
            read, heading_only = _kept(node, heading_only)
            if not read or (d and (d[3] == "drop" or (d[3] == "const" and node.const == d[4][0]))):
                continue
        if not node.kids:
            out.append(node.text)
            continue
        known = _matched(node.kids, d[5]) if d and d[5] else [None] * len(node.kids)
        parts = list(zip(node.kids, known, strict=True))
        same = lambda i, j: 0 <= j < len(parts) and parts[j][0].label == parts[i][0].label
        parts = [p for i, p in enumerate(parts) if not (p[1] and p[1][3] == "ends" and len(p[0].text) <= p[1][4][2] and ((not same(i, i - 1) and p[0].const == p[1][4][0]) or (not same(i, i + 1) and p[0].const == p[1][4][1])))]
        stack += [(kid, k, heading_only, False) for kid, k in reversed(parts)]


def main_text(page: str | None, decision: list | None) -> str:
    """The page's main text, blocks joined by one space; without a decision, or where it doesn't fit, by a wrapper of the page."""
    if not page:
        return ""
    top = blocks(parse(page))
    regions, whole = _found(top, decision) if decision else ([], False)
    if not whole:
        regions, _ = _found(top, decide(wrapper_of(top)))
    out: list[str] = []
    for node, d in regions:
        _read(node, d, out)
    return " ".join(" ".join(out).split())


def _wrap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[tuple, list[int]] = {}
    for batch in batches:
        for host, page in zip(batch["host"], batch["html"], strict=True):
            labels, sums = shape(wrapper_of(blocks(parse(page))))
            held[host, labels] = added(held[host, labels], sums) if (host, labels) in held else sums
            if len(held) >= HELD_SHAPES:
                yield _rows(held)
                held = {}
    if held:
        yield _rows(held)


def _rows(held: dict[tuple, list[int]]) -> pd.DataFrame:
    return pd.DataFrame({"host": [h for h, _ in held], "shape": [s for _, s in held], "sums": list(held.values())})


def _same_shapes(group: pd.DataFrame) -> dict[str, list[int]]:
    held: dict[str, list[int]] = {}
    for labels, sums in zip(group["shape"], group["sums"], strict=True):
        sums = [int(x) for x in sums]
        held[labels] = added(held[labels], sums) if labels in held else sums
    return held


def _gather(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    held = _same_shapes(group)
    return pd.DataFrame({"host": key[0], "bucket": key[1], "shape": list(held), "sums": list(held.values())})


def _merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """All wrappers of a bucket as one, in an order that only their contents fix."""
    held = _same_shapes(group)
    parts = [_thinned(unshaped(labels, held[labels])) for labels in sorted(held, key=lambda s: (zlib.crc32(s.encode()), s))]
    labels, sums = shape(reduce(joined, parts))
    return pd.DataFrame({"host": [key[0]], "bucket": [key[1] // FAN], "shape": [labels], "sums": [sums]})


def _decided(wrappers: pd.DataFrame) -> pd.Series:
    decided = [decide(unshaped(labels, sums)) for labels, sums in zip(wrappers["shape"], wrappers["sums"], strict=True)]
    return pd.Series([None if d is None else _encoded(d) for d in decided], dtype=object)


def _encoded(decision: list) -> str:
    """Nested lists of any depth as flat JSON."""
    flat, stack = [], [decision]
    while stack:
        d = stack.pop()
        flat.append([*d[:5], d[6], len(d[5])])
        stack += reversed(d[5])
    return json.dumps(flat, separators=(",", ":"))


def _decoded(text: str) -> list:
    top, open_ = None, []
    for *d, inner, kids in json.loads(text):
        d += [[], inner]
        if open_:
            open_[-1][0][5].append(d)
            open_[-1][1] -= 1
            if not open_[-1][1]:
                open_.pop()
        else:
            top = d
        if kids:
            open_.append([d, kids])
    return top


def wrappers(pages: DataFrame) -> DataFrame:
    """host, shape, sums: one union-free wrapper for each host of ``pages`` (host, html)."""
    ship_package(pages.sparkSession)
    kind = "host string, shape string, sums array<long>"
    rows = cut(pages.where("html <> ''").select("host", "html").mapInPandas(_wrap, kind))
    buckets = rows.groupBy(F.col("host").alias("of")).agg(F.ceil(F.countDistinct(F.xxhash64("shape")) / FAN).alias("n"))
    name = F.pmod(F.xxhash64("shape"), F.col("n")).cast("long")
    dealt = rows.join(buckets, F.col("host") == F.col("of")).select("host", name.alias("bucket"), "shape", "sums", F.pmod(F.xxhash64("sums"), F.lit(partitions(pages.sparkSession))).alias("salt"))
    kind = "host string, bucket long, shape string, sums array<long>"
    fewer = dealt.groupBy("host", "bucket", "salt").applyInPandas(_gather, kind)
    merged = cut(fewer.groupBy("host", "bucket").applyInPandas(_merge, kind))
    while merged.groupBy("host").count().where("count > 1").limit(1).count():
        merged = cut(merged.groupBy("host", "bucket").applyInPandas(_merge, kind))
    return merged.select("host", "shape", "sums")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars."""
    url = F.col(url_col).cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1)), F.lit(""))
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).cast("string").alias("html"))
    decisions = cut(wrappers(given).select(F.col("host").alias("of"), F.pandas_udf(_decided, "string")(F.struct("shape", "sums")).alias("decision")))
    size = decisions.agg(F.sum(F.length("decision") + F.length("of") + 64)).first()[0] or 0
    joined = given.join(F.broadcast(decisions) if size <= SMALL_TABLE else decisions, F.col("host") == F.col("of"), "left")

    def run(htmls: pd.Series, decisions: pd.Series) -> pd.Series:
        known: dict[str | None, list | None] = {None: None}
        out = []
        for page, d in zip(htmls, decisions, strict=True):
            if d not in known:
                known[d] = _decoded(d)
            out.append(main_text(page, known[d]))
        return pd.Series(out, dtype=object)

    text = F.pandas_udf(run, "string")("html", "decision")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
