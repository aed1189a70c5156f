"""Main text of web pages by wrapper induction: trees of a host's pages are aligned, constant nodes are template."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import stage
from .common import fresh

# Names of HTML elements by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math object canvas audio video select".split())
BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
            "thead tr ul".split())
LEAF = set("p pre h1 h2 h3 h4 h5 h6 li td th dt dd figcaption caption summary".split())
BOILERPLATE_TAGS = set("nav footer aside menu dialog button head fieldset legend option".split())
BOILERPLATE_ROLES = set("navigation banner contentinfo search complementary dialog alertdialog alert menu menubar toolbar".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
          "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"})}
# Words of class names and ids that say what an element is: never the article, or not if it holds most of the page.
NEVER = set("ad ads advert adverts advertisement advertisements advertising adsense adslot adbox sponsor sponsored sponsors promo promoted nav navbar navigation "
            "menu menus breadcrumb breadcrumbs sidebar sidebars aside footer masthead cookie cookies consent gdpr newsletter subscribe signup login share "
            "sharing social comment comments commentlist disqus replies respond pagination pager copyright teaser teasers hidden".split())
SELDOM = set("banner notice notices notification alert popup modal overlay topbar toolbar header related recommended recommendations widget widgets reply "
             "discussion search searchbox skip legal disclaimer promotion subscription".split())
_PREFIXES = {"has", "with", "no", "without", "category", "tag", "type", "is"}

MAX_DEPTH = 64
MAX_SIBLINGS = 200
TREES_AT_ONCE = 64
_TOKEN = re.compile(
    r"""([^<]*+)(?:(<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z))
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|(<)|\Z)""", re.S | re.X)
_NESTED = {tag: re.compile(rf"<(/?){tag}(?=[\s/>])|<(?:script|style|!--)", re.I) for tag in ("nav", "footer", "aside", "menu", "dialog", "button")}
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_TELLING = re.compile(r"\b(?:class|id|role|hidden|style|itemprop)\b|aria-hidden", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDES = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_HOST = re.compile(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#\s]*)", re.I)


def host_of(url: str | None) -> str:
    """The host a URL names, in lower case; empty where there is none."""
    found = _HOST.match(url or "")
    return found.group(1).lower().rstrip(".") if found else ""


def _attributes(text: str) -> dict[str, str]:
    return {name.lower(): unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(text)} if _TELLING.search(text) else {}


def _says(attributes: dict[str, str]) -> int:
    """2 where class names or the id say that an element is never the article, 1 where seldom, else 0."""
    says = 0
    for name in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[0] not in _PREFIXES:
            says = max(says, *(2 if w in NEVER else 1 if w in SELDOM else 0 for w in words))
    return says


class Page:
    """Block elements of a page, and its blocks of text: (slot of the folded tree, text, characters in links).

    The folded tree has one node for all siblings of a kind (element and class names without digits), so lists and
    paragraphs are one repeated node, as long as a template is. Elements that say themselves that they are
    not the article (by name, role, class or id, or hidden) are left out with all they hold.
    """

    def __init__(self, html: str | None):
        self.parent, self.tag, self.label, self.says, self.main = [-1], ["html"], ["html"], [0], [False]
        self._runs: list[list[tuple[int, str, bool]]] = []
        self._read(html or "")
        self._fold()

    # A stack entry is (element, node, inside a link).
    def _read(self, html: str) -> None:
        self._stack, self._run = [("html", 0, False)], []
        open_, at, size, skips = {"html": 1}, 0, len(html), True

        def push(tag, node, link):
            self._stack.append((tag, node, link))
            open_[tag] = open_.get(tag, 0) + 1

        def pop_to(depth):
            for tag, _, _ in self._stack[depth:]:
                open_[tag] -= 1
            del self._stack[depth:]

        while at < size:
            found = _TOKEN.match(html, at)
            at = found.end()
            text, _, closes, tag, attributes, closes_, tag_, attributes_, lone = found.groups()
            if text or lone:
                self._text(f"{text}{lone or ''}")
            if tag is None:
                if tag_ is None:
                    continue
                closes, tag, attributes = closes_, tag_, attributes_
            tag = tag.lower()
            if closes:
                if tag in BLOCK:
                    self._end_block()
                if open_.get(tag) and tag != "html":
                    for depth in range(len(self._stack) - 1, 0, -1):
                        name = self._stack[depth][0]
                        if name == tag:
                            pop_to(depth)
                            break
                        if tag not in BLOCK and name in BLOCK:
                            break
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    self._text(" ") if tag == "br" else self._end_block()
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
                at = end.start() if end else size
                push(tag, self._stack[-1][1], False)
                continue
            if tag in _NESTED and skips:
                end = self._past(html, at, tag)
                skips = end > 0  # one look ahead in vain is enough for a page
                if skips:
                    self._end_block()
                    at = end
                    continue
            said = _attributes(attributes) if attributes else {}
            if tag in BLOCK:
                self._end_block()
                if open_.get("p"):
                    depth = len(self._stack) - 1
                    while self._stack[depth][0] not in BLOCK:
                        depth -= 1
                    if self._stack[depth][0] == "p":
                        pop_to(depth)
                if tag in CLOSES:
                    closed, scope = CLOSES[tag]
                    last, depth = None, len(self._stack) - 1
                    while depth > 0 and self._stack[depth][0] not in scope and self._stack[depth][0] not in ("div", "article", "section"):
                        last = depth if self._stack[depth][0] in closed else last
                        depth -= 1
                    if last is not None:
                        pop_to(last)
                if tag in ("html", "body") and not said:
                    push(tag, self._stack[-1][1], False)
                    continue
                push(tag, self._node(tag, said), self._stack[-1][2])
            else:
                hides = said and (_says(said) == 2 or self._hidden(said))
                node = self._node(tag, said) if hides else self._stack[-1][1]
                push(tag, node, self._stack[-1][2] or tag == "a")
        self._end_block()
        del self._stack, self._run

    @staticmethod
    def _past(html: str, at: int, tag: str) -> int:
        """Where an element ends whose content is left out anyway; 0 where that takes a full reading."""
        depth = 1
        for found in _NESTED[tag].finditer(html, at):
            if found.group(1) is None:
                return 0
            depth += -1 if found.group(1) else 1
            if not depth:
                end = html.find(">", found.end())
                return end + 1 if end >= 0 else 0
        return 0

    @staticmethod
    def _hidden(said: dict) -> bool:
        return "hidden" in said or said.get("aria-hidden", "").lower() == "true" or bool(_HIDES.search(said.get("style", "")))

    def _node(self, tag: str, said: dict) -> int:
        parent = self._stack[-1][1]
        if not said:
            self.parent.append(parent)
            self.tag.append(tag)
            self.label.append(tag)
            self.says.append(2 if tag in BOILERPLATE_TAGS else 1 if tag in ("header", "form") else 0)
            self.main.append(tag in ("article", "main"))
            return len(self.parent) - 1
        role = said.get("role", "").lower()
        kind = "article" if said.get("itemprop", "").lower() == "articlebody" else "main" if role == "main" else tag
        says = 2 if tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or self._hidden(said) else _says(said)
        if tag in ("html", "body"):
            says = 0
        if tag in ("header", "form"):
            says = max(says, 1)
        classes = sorted({re.sub(r"\d+", "", c.lower()) for c in said.get("class", "").split()})
        self.parent.append(parent)
        self.tag.append(kind)
        self.label.append(f"{kind}.{'.'.join(classes)}" if classes else kind)
        self.says.append(says)
        self.main.append(kind in ("article", "main") and says < 2)
        return len(self.parent) - 1

    def _text(self, text: str) -> None:
        self._run.append((self._stack[-1][1], unescape(text) if "&" in text else text, self._stack[-1][2]))

    def _end_block(self) -> None:
        if self._run:
            self._runs.append(self._run)
            self._run = []

    def _fold(self) -> None:
        """Decides what is left out and numbers the rest by slots."""
        n = len(self.parent)
        held = [0] * n
        for run in self._runs:
            for node, text, _ in run:
                held[node] += len(text)
        mains, inside = [0] * n, [False] * n
        for i in range(n - 1, 0, -1):
            held[self.parent[i]] += held[i]
            mains[self.parent[i]] += mains[i] + self.main[i]
        total, out = held[0], [False] * n
        for i in range(1, n):
            up = self.parent[i]
            inside[i] = inside[up] or self.main[up]
            # What holds all elements marked as article is no boilerplate, whatever its class names say.
            around = mains[i] and mains[i] == mains[0] and not inside[i]
            gone = self.says[i] == 2 and not (around and self.tag[i] not in BOILERPLATE_TAGS)
            if self.says[i] == 1 and not around and not self.main[i]:
                gone = 2 * held[i] <= total and not (self.tag[i] == "header" and inside[i])
            out[i] = out[up] or gone
        slots, slot_of, depth, width = {}, [0] * n, [0], [0]
        self.slots: list[tuple[int, str]] = [(-1, "html")]
        for i in range(1, n):
            if out[i]:
                continue
            up = slot_of[self.parent[i]]
            if depth[up] >= MAX_DEPTH:
                slot_of[i] = up
                continue
            label = self.label[i] if (up, self.label[i]) in slots or width[up] < MAX_SIBLINGS else self.tag[i]
            if (up, label) not in slots:
                slots[up, label] = len(self.slots)
                self.slots.append((up, label))
                depth.append(depth[up] + 1)
                width.append(0)
                width[up] += 1
            slot_of[i] = slots[up, label]
        self.blocks: list[tuple[int, str, int]] = []
        for run in self._runs:
            # Inline elements that are left out share their block with text that stays.
            stays = [part for part in run if not out[part[0]]]
            text = " ".join("".join(part[1] for part in stays).split())
            if text:
                links = sum(len(part[1]) for part in stays if part[2])
                self.blocks.append((slot_of[stays[0][0]], text, links))
        del self._runs

    def shape(self) -> str:
        return json.dumps(self.slots, ensure_ascii=False, separators=(",", ":"))


# --- simple tree matching --------------------------------------------------------------------------------------------

class Tree:
    """An ordered tree of labels; node 0 is the root."""

    def __init__(self, nodes: list):
        self.labels = [label for _, label in nodes]
        self.children: list[list[int]] = [[] for _ in nodes]
        for i, (parent, _) in enumerate(nodes):
            if parent >= 0:
                self.children[parent].append(i)

    def nodes(self) -> tuple[list[tuple[int, str]], list[int]]:
        """Nodes in document order, and the new number of each."""
        out, number, waiting = [], [0] * len(self.labels), [(0, -1)]
        while waiting:
            node, parent = waiting.pop()
            number[node] = len(out)
            out.append((parent, self.labels[node]))
            waiting.extend((c, number[node]) for c in reversed(self.children[node]))
        return out, number


def _tag(label: str) -> str:
    return label.split(".", 1)[0]


def match_trees(a: Tree, b: Tree) -> dict[int, int]:
    """Simple tree matching: the largest mapping of nodes of ``b`` to nodes of ``a`` that keeps parents and order.

    Nodes match by label; those that differ in class names alone match where at least half of what the smaller one holds does.
    """
    sizes = [[1] * len(t.labels) for t in (a, b)]
    for tree, size in zip((a, b), sizes):
        for i in range(len(tree.labels) - 1, -1, -1):
            size[i] = 1 + sum(size[c] for c in tree.children[i])
    scores: dict[tuple[int, int], tuple[int, list]] = {}

    def score(x: int, y: int) -> int:
        if (x, y) in scores:
            return scores[x, y][0]
        if _tag(a.labels[x]) != _tag(b.labels[y]):
            return 0
        left, right = a.children[x], b.children[y]
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, u in enumerate(left, 1):
            row, above = best[i], best[i - 1]
            for j, v in enumerate(right, 1):
                row[j] = max(above[j], row[j - 1], above[j - 1] + score(u, v))
        held = best[-1][-1]
        alike = a.labels[x] == b.labels[y]
        if not alike and 4 * held < min(sizes[0][x], sizes[1][y]) - 1 or not alike and not held:
            scores[x, y] = (0, best)
        else:
            scores[x, y] = (held + (2 if alike else 1), best)
        return scores[x, y][0]

    score(0, 0)
    pairs, waiting = {0: 0}, [(0, 0)]
    while waiting:
        x, y = waiting.pop()
        best, left, right = scores[x, y][1], a.children[x], b.children[y]
        i, j = len(left), len(right)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs[right[j]] = left[i]
                waiting.append((left[i], right[j]))
    return pairs


def merge_trees(shapes: list[str]) -> tuple[str, list[list[int]]]:
    """One wrapper for all trees, in their order, and where each tree's nodes are in it."""
    wrapper, maps = Tree(json.loads(shapes[0])), []
    maps.append(list(range(len(wrapper.labels))))
    for shape in shapes[1:]:
        tree = Tree(json.loads(shape))
        pairs = match_trees(wrapper, tree)
        to = [-1] * len(tree.labels)
        waiting = [0]
        while waiting:
            y = waiting.pop()
            x = to[y] = pairs.get(y, to[y])
            if wrapper.labels[x] != tree.labels[y]:
                wrapper.labels[x] = _tag(wrapper.labels[x])
            place = 0
            for c in tree.children[y]:
                if c in pairs:
                    place = wrapper.children[x].index(pairs[c]) + 1
                    continue
                kind = tree.labels[c] if len(wrapper.children[x]) < MAX_SIBLINGS else _tag(tree.labels[c])
                same = [w for w in wrapper.children[x] if wrapper.labels[w] == kind] if kind != tree.labels[c] else []
                if same:
                    to[c] = same[0]
                    continue
                to[c] = len(wrapper.labels)
                wrapper.labels.append(kind)
                wrapper.children.append([])
                wrapper.children[x].insert(place, to[c])
                place += 1
            waiting.extend(tree.children[y])
        maps.append(to)
    nodes, number = wrapper.nodes()
    return json.dumps(nodes, ensure_ascii=False, separators=(",", ":")), [[number[i] for i in m] for m in maps]


# --- template and content of a host ----------------------------------------------------------------------------------

def choose(shape: str, evidence: dict[int, tuple[int, int, bool]]) -> list[list[int]]:
    """Slots of the wrapper to take a page's text from: the first list that has some is taken.

    ``evidence`` has (characters, of them in links, is constant) by slot. The content is what varies inside the elements
    that are marked as article (or as main), else inside the smallest element that holds three fifths of all
    varying text outside links; a constant slot is taken only where a page has nothing else.
    """
    nodes = json.loads(shape)
    mass = [0] * len(nodes)
    for slot, (chars, links, constant) in evidence.items():
        mass[slot] = 0 if constant else max(0, chars - links)
    under: list[set[int]] = [{i} for i in range(len(nodes))]
    weight = list(mass)
    for i in range(len(nodes) - 1, 0, -1):
        weight[nodes[i][0]] += weight[i]
        under[nodes[i][0]] |= under[i]
    prose = {s for s, (chars, links, _) in evidence.items() if 2 * links <= chars}
    varies = {s for s, (_, _, constant) in evidence.items() if not constant}
    marked: set[int] = set()
    for tag in ("article", "main"):
        if not marked & set(evidence):
            marked = set().union(*(under[i] for i, (_, label) in enumerate(nodes) if _tag(label) == tag))
    rest = [weight[i] - sum(mass[s] for s in under[i] & marked) for i in range(len(nodes))]
    node = 0
    while _tag(nodes[node][1]) not in LEAF:
        inner = [i for i, (parent, _) in enumerate(nodes) if parent == node]
        best = max(inner, key=lambda i: rest[i], default=None)
        if best is None or not rest[best] or 5 * rest[best] < 3 * rest[node] or _tag(nodes[best][1]) in LEAF:
            break
        node = best
    induced = under[node] - marked
    return [sorted(x) for x in (marked & varies, marked & set(evidence), induced & varies & prose, induced & prose, prose, set(evidence))]


def _align(shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One wrapper a host, from (host, shape): (host, wrapper), and (host, shape, map of the shape's slots to the wrapper's).

    Trees meet in groups of bounded size, whose wrappers meet again, until each host has one.
    """
    trees = stage(shapes.select("host", F.col("shape").alias("tree")), "trees")
    maps = trees.select("host", F.col("tree").alias("shape"), "tree", F.lit(None).cast("array<int>").alias("map"))

    def merged(group: pa.Table) -> pa.Table:
        rows = sorted(group.select(["host", "tree"]).to_pylist(), key=lambda r: (len(r["tree"]), r["tree"]))
        wrapper, steps = merge_trees([r["tree"] for r in rows])
        return pa.table({"host": pa.array([r["host"] for r in rows]), "tree": pa.array([r["tree"] for r in rows]),
                         "wrapper": pa.array([wrapper] * len(rows)), "step": pa.array(steps, pa.list_(pa.int32()))})

    while True:
        count = trees.groupBy("host").agg(F.count("*").alias("n"))
        most = count.agg(F.max("n").alias("n")).first().n or 0
        dealt = trees.join(count, "host").select("host", "tree", F.pmod(F.xxhash64("tree"), F.ceil(F.col("n") / TREES_AT_ONCE)).alias("bucket"))
        steps = stage(dealt.groupBy("host", "bucket").applyInArrow(merged, "host string, tree string, wrapper string, step array<int>"), "wrappers")
        moved = F.when(F.col("map").isNull(), F.col("step")).otherwise(F.transform("map", lambda x: F.col("step")[x]))
        maps = stage(maps.join(steps, ["host", "tree"]).select("host", "shape", F.col("wrapper").alias("tree"), moved.alias("map")), "maps")
        trees = stage(maps.select("host", "tree").distinct(), "trees")
        if most <= TREES_AT_ONCE:
            return trees, maps


def extract(pages: DataFrame, html: str = "html", url: str = "url", text: str = "text") -> DataFrame:
    """``pages`` with ``text``, the article of each page, in place of ``html``: its blocks joined by one space.

    1. Every page is read into its blocks of text and its folded tree (``Page``); only the trees and hashes of the
       texts by node travel on, summed up by host and tree before the shuffle.
    2. The distinct trees of a host are aligned by simple tree matching into one wrapper, in groups of bounded size.
    3. A node that has the same text on all pages of the host that have it, which differ otherwise, is template; other nodes
       are slots. ``choose`` says which slots are the content.
    4. Pages are read again and meet the choice of their host and tree; a host that holds a third of all pages is a
       skewed join that Spark splits, and no page is read beside another one.

    At least five different pages must agree for a template, so small hosts keep what they have, and copies of one page
    make none. Pages without a host in their URL are one group. Null and empty pages, and those without an article,
    have an empty text. Repeated rows are answered alike; an empty table gives an empty result. Other columns pass
    through; one named as ``text`` is replaced. A page is read as a whole, however long. Elements nested deeper than 64, and siblings
    of over 200 kinds, keep their text but share a slot.
    """
    keep = [c for c in pages.columns if c not in (html, text)]
    k, parts, host, shape = (fresh(pages, n) for n in ("_key", "_blocks", "_host", "_shape"))
    same = pages.select(F.col(url).alias("url"), F.col(html).alias("html"))

    def key_of(host_, shape_):
        return xxhash.xxh3_128_digest(f"{host_}\0{shape_}".encode("utf-8", "surrogatepass"))

    def outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for address, content in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                page = Page(content)
                by_slot: dict[int, tuple] = {}
                body = xxhash.xxh3_64()
                for slot, block, links in page.blocks:
                    coded = block.encode("utf-8", "surrogatepass")
                    body.update(coded + b"\n")
                    digest, chars, linked = by_slot.get(slot) or (xxhash.xxh3_64(), 0, 0)
                    digest.update(coded + b"\n")
                    by_slot[slot] = (digest, chars + len(block), linked + links)
                if by_slot:
                    slots = [{"slot": s, "hash": d.intdigest() - 2**63, "chars": c, "links": x} for s, (d, c, x) in by_slot.items()]
                    out.append((host_of(address), page.shape(), body.intdigest() & 63, slots))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 4, outline_types)],
                                             names=["host", "shape", "body", "slots"])

    outline_types = (pa.string(), pa.string(), pa.int32(), pa.list_(pa.struct(
        [("slot", pa.int32()), ("hash", pa.int64()), ("chars", pa.int64()), ("links", pa.int64())])))
    seen = same.mapInArrow(outlines, "host string, shape string, body int, slots array<struct<slot:int,hash:bigint,chars:bigint,links:bigint>>")
    # Different pages are counted by their hash modulo 64: never more than there are.
    evidence = seen.select("host", "shape", "body", F.explode("slots").alias("s")).groupBy("host", "shape", "s.slot").agg(
        F.min("s.hash").alias("low"), F.max("s.hash").alias("high"), F.bit_or(F.expr("shiftleft(1L, body)")).alias("bodies"),
        F.sum("s.chars").alias("chars"), F.sum("s.links").alias("links"))
    evidence = stage(evidence, "evidence")
    wrappers, maps = _align(evidence.select("host", "shape").distinct())
    in_wrapper = evidence.join(maps.withColumnRenamed("tree", "wrapper"), ["host", "shape"]).groupBy("host", F.col("map")[F.col("slot")].alias("slot")).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.bit_or("bodies").alias("bodies"), F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    constant = (F.col("low") == F.col("high")) & (F.bit_count("bodies") >= 5)
    by_host = in_wrapper.groupBy("host").agg(F.collect_list(F.struct("slot", "chars", "links", constant.alias("constant"))).alias("slots"))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = [choose(r["tree"], {s["slot"]: (s["chars"], s["links"], s["constant"]) for s in r["slots"]}) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(levels, pa.list_(pa.list_(pa.int32())))], names=["host", "levels"])

    levels = wrappers.join(by_host, "host").select("host", "tree", "slots").mapInArrow(chosen, "host string, levels array<array<int>>")
    mapped = F.transform("levels", lambda level: F.transform(
        F.filter(F.sequence(F.lit(0), F.size("map") - 1), lambda s: F.array_contains(level, F.col("map")[s])), lambda s: s.cast("int")))
    verdict = maps.join(levels, "host").select("host", "shape", mapped.alias("levels"))

    def with_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [key_of(h, s) for h, s in zip(batch.column("host").to_pylist(), batch.column("shape").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("levels")], names=["verdict_key", "levels"])

    verdict = stage(verdict.mapInArrow(with_keys, "verdict_key binary, levels array<array<int>>"), "verdicts")
    block_type = "array<struct<slot:int,text:string>>"
    fields = [pages.schema[c] for c in keep]
    schema = T.StructType([*fields, T.StructField(k, T.BinaryType()), T.StructField(parts, T._parse_datatype_string(block_type))])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = [], []
            for address, content in zip(batch.column(host).to_pylist(), batch.column(shape).to_pylist()):
                page = Page(content)
                keys.append(key_of(host_of(address), page.shape()) if page.blocks else None)
                texts.append([{"slot": s, "text": x} for s, x, _ in page.blocks])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(keys, pa.binary()), pa.array(texts, pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())])))],
                names=[*keep, k, parts])

    read = pages.select(*keep, F.col(url).alias(host), F.col(html).alias(shape)).mapInArrow(blocks, schema)

    def joined(level: int) -> Column:
        wanted = F.filter(F.col(parts), lambda b: F.array_contains(F.col("levels")[level], b["slot"]))
        return F.nullif(F.array_join(F.transform(wanted, lambda b: b["text"]), " "), F.lit(""))

    answer = F.coalesce(*[joined(i) for i in range(6)], F.lit(""))
    out = read.join(verdict, F.col(k) == F.col("verdict_key"), "left")
    return out.select(*[F.col(c) for c in keep], answer.alias(text))
