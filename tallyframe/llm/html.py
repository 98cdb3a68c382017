"""HTML extraction with a tree-structured graphical model.

A page becomes a tree of elements; runs of text between block boundaries are its leaves. Every node is
content or not. A node has a potential from its own features (tag, words of class, id and role, length of
text, share of link text, punctuation), and every edge one from its kind. Messages go up the tree and
down again (sum-product), which gives the exact marginal of each node; runs of text whose marginal is at
least one half are the main text.

The potentials are counted from labelled pages: pages laid out here from whole paragraphs of a bounded
sample of texts, in several layouts with menus, headers, sidebars, adverts, notices, forms, comments and
footers, where each run of text is known to belong to the article or not.

Defined results: a null html is an empty page, whose text is empty; unclosed, stray and truncated tags are
read as HTML does; a page without markup is one run of text; text of script, style and other elements that
are not shown is never a run; pages of any length and depth are read whole; repeated rows stay; an empty
table gives an empty result; other columns are not read."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from random import Random

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without an end tag, elements that are not shown, inline elements,
# and the elements whose start ends an open paragraph
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template noscript head title iframe object svg canvas textarea select option "
                   "datalist audio video mphantom annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr br img output ruby rt rp nobr math semantics maction "
                   "menclose merror mfrac mi mmultiscripts mn mo mover mpadded mprescripts mroot mrow ms mspace msqrt "
                   "mstyle msub msubsup msup mtable mtd mtext mtr munder munderover".split())
# What may stand in a head; anything else ends one that is open. In formulas, elements that set text apart,
# and hidden ones, which the slash of an empty tag ends
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
APART = frozenset("br img mspace mtd mtr".split())
EMPTY_IN_MATH = frozenset("mphantom annotation annotation-xml".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption "
                           "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search "
                           "section summary table ul".split())
CLOSES_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                 "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "p": ("p",)}
SCOPES = frozenset("ul ol dl table div section article aside main body html nav form fieldset td th header "
                   "footer blockquote figure".split())
# Words of class, id and role names, by what they usually mark
MARKS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc skip",
    "side": "sidebar aside rail related recommended recommendation popular trending widget more teaser links tags",
    "top": "header masthead banner topbar toolbar logo brand site",
    "foot": "footer foot copyright legal credits colophon bottom contentinfo",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion promoted commercial outbrain "
              "taboola affiliate",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog newsletter subscribe "
              "subscription signup paywall complementary disclaimer",
    "form": "form search login register input button share sharing social toolbar",
    "reader": "comment comments reply replies discussion disqus respond reviews responses",
    "body": "article content body entry post story main text prose markdown maincontent articlebody",
}
_MARK_OF = {w: kind for kind, names in MARKS.items() for w in names.split()}
LISTS = frozenset("ul ol dl table thead tbody tfoot tr blockquote figure p".split())
CLUTTER_TAGS = frozenset("nav header footer aside form".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"[\t-\r \x85\xa0  -     　]+")
SMOOTHING = 0.5
TRAINING_PAGES = 600
SAMPLE_PAGES = 300


class Node:
    __slots__ = ("tag", "marks", "parent", "text", "chars", "linked", "in_link", "label", "features")

    def __init__(self, tag: str, parent: int, marks: frozenset = frozenset(), text: str = "", label: int = 0):
        self.tag, self.parent, self.marks, self.text, self.label = tag, parent, marks, text, label
        self.chars = self.linked = 0
        self.features: tuple = ()


class Tree(HTMLParser):
    """Nodes in document order, parents first; inline elements are not nodes."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1)]
        self.open = [(0, "#page")]  # (node, tag) of open block elements
        self.hidden: list[str] = []
        self.past_head = False
        self.links = 0
        self.label = 0
        self._start_run()

    def _start_run(self) -> None:
        self.run: list[str] = []
        self.run_chars = self.run_linked = 0

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.run)).strip(" ")
        if text:
            node = Node("#text", self.open[-1][0], text=text, label=self.label)
            node.chars = len(text)
            node.linked = round(len(text) * self.run_linked / max(1, self.run_chars))
            self.nodes.append(node)
        self._start_run()

    def _close(self, depth: int) -> None:
        self.flush()
        del self.open[depth:]

    def _close_implied(self, tag: str) -> None:
        closes = CLOSES_ITSELF.get(tag, ())
        if tag in ENDS_PARAGRAPH:
            closes = (*closes, "p")
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth][1]
            if name in closes:
                self._close(depth)
                if tag != "tr":
                    return
            elif name in SCOPES or name not in CLOSES_ITSELF:
                return

    def _end_head(self) -> None:
        """A head without an end tag ends at the first thing that may not stand in it."""
        if self.hidden == ["head"]:
            self.hidden = []
        if not self.hidden:
            self.past_head = True

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag not in IN_HEAD:
            self._end_head()
        if self.hidden:
            if tag not in VOID and (tag not in ("head", "html") or self.hidden != ["head"]):
                self.hidden.append(tag)
            return
        if tag == "head" and self.past_head:
            return
        if tag in HIDDEN:
            if tag not in VOID:
                self.hidden.append(tag)
            return
        if tag == "a":
            self.links = 1
        if tag in INLINE:
            if tag in APART:
                self.run.append(" ")
            return
        if tag == "input":
            return
        self._close_implied(tag)
        self.flush()
        if tag in VOID or tag in ("html", "body") and any(t == tag for _, t in self.open):
            return
        self.links = 0
        names = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
        marks = frozenset(_MARK_OF[w] for w in map(str.lower, _NAME.findall(names)) if w in _MARK_OF)
        if any(k in ("hidden",) for k, _ in attrs) or ("aria-hidden", "true") in attrs:
            marks |= {"notice"}
        self.nodes.append(Node(tag, self.open[-1][0], marks))
        self.open.append((len(self.nodes) - 1, tag))

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag == "svg" or "svg" in self.hidden:  # there the slash ends the element
            self._end_head()
        elif tag not in EMPTY_IN_MATH:
            self.handle_starttag(tag, attrs)  # the slash means nothing on elements of HTML

    def handle_endtag(self, tag: str) -> None:
        if tag in ("head", "body", "html", "br"):
            self._end_head()
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
            return
        if tag == "a":
            self.links = 0
        if tag in INLINE:
            return
        if tag == "head":
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][1] == tag:
                self._close(depth)
                return
        if tag in ENDS_PARAGRAPH:
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.past_head and data.strip("\t\n\f\r "):
            self._end_head()
        if not self.hidden:
            self.run.append(data)
            self.run_chars += len(data)
            if self.links:
                self.run_linked += len(data)

    def unknown_decl(self, data: str) -> None:
        pass


def parse(html: str) -> list[Node]:
    tree = Tree()
    tree.feed(html)
    tree.close()
    tree.flush()
    _describe(tree.nodes)
    return tree.nodes


def _bucket(n: int) -> int:
    return min(8, n.bit_length())


def _describe(nodes: list[Node]) -> None:
    """Features of each node, from its own tag and marks and from the text below it."""
    children = [0] * len(nodes)
    for node in reversed(nodes):
        if node.parent >= 0:
            up = nodes[node.parent]
            up.chars += node.chars
            up.linked += node.linked
            children[node.parent] += 1
    for node in nodes:
        share = 0 if not node.chars else min(4, 4 * node.linked // node.chars)
        found = [("tag", node.tag), ("links", node.tag == "#text", share)]
        found += [("mark", m) for m in node.marks]
        if node.tag == "#text":
            ends = node.text[-1] in ".!?…\"'”»:;)。"
            found += [("length", _bucket(node.chars)), ("ends", ends)]
        node.features = tuple(found)


def _edge(nodes: list[Node], at: int) -> str:
    """Kind of the edge above a node, by what the parent calls itself: what lies below a menu or a list of
    comments follows it more closely than what lies below a plain container."""
    if nodes[at].tag == "#text":
        return "text"
    parent = nodes[nodes[at].parent]
    if parent.tag in LISTS:
        return "list"
    if parent.tag in CLUTTER_TAGS or parent.marks - {"body"}:
        return "clutter"
    if parent.tag in ("#page", "html", "body"):
        return "page"
    return "article" if parent.tag in ("article", "main") or parent.marks else "plain"


EDGES = ("text", "list", "clutter", "page", "article", "plain")


class Model:
    """Potentials: log odds of each feature, and 2 x 2 log potentials of each kind of edge."""

    def __init__(self, prior: float, odds: dict, edges: dict):
        self.prior, self.odds, self.edges = prior, odds, edges

        self.exps = {k: [[math.exp(x) for x in row] for row in e] for k, e in edges.items()}

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of each node: messages up to the root, then down. All in log odds."""
        exp, log, get = math.exp, math.log, self.odds.get
        # potential of each node, to which the messages from below are added
        own = [sum([get(f, 0.0) for f in node.features]) for node in nodes]
        n = len(nodes)
        up = [0.0] * n
        tables = [None, *[self.exps[_edge(nodes, i)] for i in range(1, n)]]
        parents = [node.parent for node in nodes]
        for i in range(n - 1, 0, -1):
            odds = own[i]
            (a, b), (c, d) = tables[i]
            one = exp(odds) if odds < 60.0 else exp(60.0)
            up[i] = log((c + d * one) / (a + b * one))
            own[parents[i]] += up[i]
        own[0] += self.prior
        for i in range(1, n):
            odds = own[parents[i]] - up[i]
            (a, b), (c, d) = tables[i]
            one = exp(odds) if odds < 60.0 else exp(60.0)
            own[i] += log((b + d * one) / (a + c * one))
        return [1.0 / (1.0 + exp(-max(-60.0, min(60.0, b)))) for b in own]


def learn(pages: list[list[Node]]) -> Model:
    """Count potentials from pages whose runs of text are labelled; an element is content if most of the
    text below it is."""
    seen: list[Counter] = [Counter(), Counter()]
    total = [0, 0]
    edges: dict[str, list[list[float]]] = {k: [[1.0, 1.0], [1.0, 1.0]] for k in EDGES}
    for nodes in pages:
        good = [0] * len(nodes)
        for i in range(len(nodes) - 1, -1, -1):
            node = nodes[i]
            if node.tag == "#text":
                good[i] = node.chars if node.label else 0
            else:
                node.label = int(2 * good[i] > node.chars)
            if node.parent >= 0:
                good[node.parent] += good[i]
        for i, node in enumerate(nodes):
            total[node.label] += 1
            seen[node.label].update(node.features)
            if i:
                edges[_edge(nodes, i)][nodes[node.parent].label][node.label] += 1
    odds = {}
    for f in set(seen[0]) | set(seen[1]):
        odds[f] = (math.log((seen[1][f] + SMOOTHING) / (total[1] + 2 * SMOOTHING))
                   - math.log((seen[0][f] + SMOOTHING) / (total[0] + 2 * SMOOTHING)))
    potentials = {kind: [[math.log(x / sum(row)) for x in row] for row in table] for kind, table in edges.items()}
    return Model(math.log((total[1] + 1) / (total[0] + 1)), odds, potentials)


def labelled_page(rng: Random, texts: list[str]) -> list[Node]:
    """A page laid out at random, with the label of each run of text."""
    tree = Tree()

    def put(markup: str, label: int = 0) -> None:
        tree.flush()
        tree.label = label
        tree.feed(markup)

    def say(limit: int = 10 ** 9) -> str:
        lines = [x for x in rng.choice(texts).split("\n") if x.strip()] or ["Untitled."]
        text = rng.choice(lines)[:limit]
        return text.replace("&", "&amp;").replace("<", "&lt;")

    def links(tag: str, n: int) -> str:
        items = [f'<a href="/{i}">{rng.choice(say().split()) if rng.random() < .7 else say(40)}</a>' for i in range(n)]
        if tag == "ul":
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " | ".join(items)

    def wrapped(tags: str, names: str, inner: str) -> str:
        tag, name = rng.choice(tags.split()), rng.choice(names.split())
        how = f' {rng.choice(("class", "id"))}="{name}"' if rng.random() < .8 or tag == "div" else ""
        return f"<{tag}{how}>{inner}</{tag}>"

    clutter = [
        lambda: wrapped("nav nav div ul", "menu nav main-menu navbar breadcrumb", links("ul", rng.randint(2, 12))),
        lambda: wrapped("header header div", "header masthead site-header banner",
                        f"<div>{say(50)}</div>" + links("p", rng.randint(0, 5))),
        lambda: wrapped("aside aside div", "sidebar related widget popular", f"<h3>{say(30)}</h3>"
                        + (links("ul", rng.randint(2, 8)) if rng.random() < .6 else f"<p>{say()}</p>")),
        lambda: wrapped("div div section aside", "ad ads advert sponsored promo", say()),
        lambda: wrapped("div div section", "cookie-notice consent newsletter alert popup notice", f"<p>{say()}</p>"),
        lambda: f'<form action="/"><label>{say(30)}</label><input name="q"><button>{say(15)}</button></form>',
        lambda: wrapped("div div ul", "share social share-buttons", links("p", rng.randint(2, 6))),
    ]
    comments = lambda: wrapped("section div div ol", "comments comment-list discussion reader-comments", "".join(
        wrapped("div div li article", "comment reply", f"<p>{say()}</p>") for _ in range(rng.randint(1, 5))))
    footer = lambda: wrapped("footer footer div", "footer site-footer copyright", rng.choice((
        f"&copy; site.example &middot; {say()}", f"<p>{say()}</p>" + links("p", 4), links("ul", 5))))

    put("<html><head><title>x</title></head><body>")
    for _ in range(rng.randint(0, 4)):
        put(rng.choice(clutter)())
    outer = rng.choice(("<main>", '<div id="content">', '<div class="wrap">', ""))
    put(outer)
    if rng.random() < .3:
        put(rng.choice(clutter)())
    body, end = rng.choice((("<article>", "</article>"),) * 3 + (
        ('<div class="post-content">', "</div>"), ('<section class="entry">', "</section>"), ("<main>", "</main>"),
        ('<div class="text">', "</div>")))
    put(body)
    if rng.random() < .8:
        put(f"<h1>{say(60)}</h1>", 1)
    lines = [x for x in rng.choice(texts).split("\n") if x.strip()] or ["Untitled."]
    for k, line in enumerate(lines):
        line = line.replace("&", "&amp;").replace("<", "&lt;")
        kind = rng.random()
        if kind < .03:
            put(rng.choice(clutter)())
        if kind < .75:
            put(f"<p>{line}</p>" if rng.random() < .8 else f"<p><b>{line}<br>", 1)
        elif kind < .8:
            put(f"<h2>{line[:60]}</h2>", 1)
        elif kind < .85:
            put(f"<blockquote><p>{line}</p></blockquote>", 1)
        elif kind < .9:
            put("<ul>" + "".join(f"<li>{x}</li>" for x in line.split(",")) + "</ul>", 1)
        elif kind < .93:
            put(f"<table><tr><td>{line[:40]}</td><td>{line[-40:]}</td></tr></table>", 1)
        elif kind < .96:
            put(f"<pre>{line}</pre>", 1)
        else:
            put(f'<p>{line[:len(line) // 2]} <a href="/x">{line[len(line) // 2:][:30]}</a></p>', 1)
    put(end)
    for _ in range(rng.randint(0, 2)):
        put(rng.choice(clutter)())
    if rng.random() < .5:
        put(comments())
    put({"<main>": "</main>", "": ""}.get(outer, "</div>"))
    if rng.random() < .9:
        put(footer())
    tree.close()
    tree.flush()
    _describe(tree.nodes)
    return tree.nodes


def sample_texts(pages: DataFrame, n: int = SAMPLE_PAGES) -> list[str]:
    """The longer runs of text of at most n pages, those whose id has the least hash: the bounded sample
    that training pages are laid out from."""
    ids = (pages.where("page_id is not null and html is not null").select("page_id").distinct()
           .orderBy(F.xxhash64("page_id")).limit(n).collect())
    rows = pages.where(F.col("page_id").isin([r["page_id"] for r in ids])).select("page_id", "html").dropDuplicates(
        ["page_id"]).orderBy("page_id").limit(n).collect()
    runs = [[node.text for node in parse(r["html"] or "") if node.tag == "#text" and node.chars >= 25] for r in rows]
    return ["\n".join(found) for found in runs if found]


def fit(texts: list[str], pages: int = TRAINING_PAGES, seed: int = 11) -> Model:
    rng = Random(seed)
    texts = [t for t in texts if t.strip()] or ["One short text.\nAnother line of it, a little longer."]
    return learn([labelled_page(rng, texts) for _ in range(pages)])


def main_text(html: str, model: Model) -> str:
    nodes = parse(html)
    return "\n\n".join([node.text for node, p in zip(nodes, model.marginals(nodes))
                        if node.tag == "#text" and p >= 0.5])


def extracted(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text (runs of the main text, joined by two line feeds), n_chars per row."""
    shared = pages.sparkSession.sparkContext.broadcast((model.prior, model.odds, model.edges))

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Model(*shared.value)
        for htmls in batches:
            yield pd.Series([main_text(h or "", own) for h in htmls], dtype=object)

    return (pages.select("page_id", "url", extract("html").alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
