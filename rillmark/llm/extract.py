"""The main text of web pages, chosen among the nodes of the page by boosted trees.

A page is read into a tree of its block elements; text that stands directly in one of them, inline elements included, makes a block of text. Every node has
features of its own (tag, words of its class, id and role, depth), of the text below it (amount, density, links, sentences) and of its siblings.
Gradient-boosted trees give the odds that a node belongs to the article. They are learnt from a bounded sample of different pages, whose nodes are
labelled by what their tags and attributes say outright, or, if no page of the table does, from built-in pages; to learn more than these names, the sampled pages are also rewritten: the same texts in other
layouts, with names dropped or changed, and with menus, notices, forms, side columns and comments made of the pages' own words. A choice for all nodes of
a page is then made from the root down: a node can be in only if its parent is, and the choice with the greatest sum of log-odds is taken.

Defined cases: a null or empty page, or one without an article, has an empty text; text and elements outside of any body stand in an implied one, what follows its end tag still in it; unclosed
and wrongly closed elements end where an enclosing one does; every row stands for itself, so repeated rows and null ids change nothing; an empty table
gives no rows and no trees; other columns play no part.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_frames, staged

# Comments, declarations, tags, and a tag that the page ends in. A quote is one only at the start of a value.
TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>]*+))?+)*+)>|<(?=[a-zA-Z/]).*\Z""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PARTS = re.compile(r"[a-z]+")
SPACES = re.compile(r"\s+")

# Fixed values of the page language: elements without content, elements whose content is not text, and elements that make blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe object svg math canvas textarea select title head button".split())
BLOCKS = set(
    "html body main article section nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption"
    " blockquote pre figure figcaption form fieldset address details summary dialog hgroup menu search center".split()
)
# Of elements whose content is skipped, those in which nothing but their own end tag is markup.
UNMARKED = set("script style textarea title iframe".split())
CLOSES_P = BLOCKS - set("html body".split())
# A new element ends an open one of these kinds, up to the element in which it stands.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table thead tbody tfoot"), "td": ("td th", "tr"), "th": ("td th", "tr")}
ENDS = {k: (set(a.split()), set(b.split())) for k, (a, b) in ENDS.items()}

# Words of names that tell what a node is for.
GOOD = set("article main content post story entry body text".split())
BAD = set(
    "nav menu navbar navigation breadcrumb breadcrumbs header masthead footer bottom sidebar side aside rail widget ad ads advert adverts advertisement banner promo sponsor sponsored"
    " notice cookie cookies consent popup modal overlay alert subscribe newsletter signup login search form comment comments reply replies discussion disqus"
    " share social related recommended recommend more tags pagination pager toolbar skip copyright".split()
)
# Elements that hold a whole article, and names by which such an element is something else all the same.
HOLDERS = set("html body main article".split())
APART = set("comment comments reply replies discussion disqus related recommended recommend advert advertisement promo sponsored widget".split())
BAD_TAGS = set("nav header footer aside form dialog menu search fieldset".split())
TAGS = ["p", "div", "section", "article", "main", "ul", "li", "table", "td", "blockquote", "pre", "figure"]


class Node:
    __slots__ = ("tag", "names", "parent", "children", "depth", "own", "chars", "links", "words", "stops", "commas", "blocks", "tags", "paragraphs", "end")

    def __init__(self, tag, names, parent):
        self.tag, self.names, self.parent, self.children = tag, names, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.own = 0  # characters of blocks directly in this node
        self.chars = self.links = self.words = self.stops = self.commas = self.blocks = self.tags = self.paragraphs = 0


def skipped_to(name: str, page: str, at: int) -> int | None:
    """Where an element ends whose content is skipped; None if it is not closed, or not before another of a kind that holds none of its own."""
    if name == "head":
        end = re.compile(r"</head(?=[\s/>])[^>]*>|(?=<body(?=[\s/>]))", re.I).search(page, at)
    elif name in ("button", "select"):
        end = re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>", re.I).search(page, at)
        end = end if end and end.group(1) else None
    else:
        end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
    return end.end() if end else None


def parse(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes in page order, the root first, and the blocks of text with the number of the node that each stands in."""
    root = Node("root", (), None)
    nodes, open_nodes, number = [root], [root], {id(root): 0}
    blocks: list[tuple[int, str]] = []
    pieces: list[str] = []
    link, linked = 0, 0
    at, page = 0, page or ""

    def enter(name, names):
        node = Node(name, names, open_nodes[-1])
        open_nodes[-1].children.append(node)
        open_nodes.append(node)
        number[id(node)] = len(nodes)
        nodes.append(node)

    def flush():
        nonlocal linked
        if pieces:
            text = SPACES.sub(" ", entities.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                if len(open_nodes) == 1:
                    enter("body", ())
                node = open_nodes[-1]
                node.own += len(text)
                node.chars += len(text)
                node.links += min(linked, len(text))
                node.words += text.count(" ") + 1
                node.stops += text.count(".") + text.count("!") + text.count("?")
                node.commas += text.count(",")
                node.blocks += 1
                node.paragraphs += node.tag == "p"
                blocks.append((number[id(node)], text))
        linked = 0

    def close(k):
        flush()
        del open_nodes[k:]

    endless: set[str] = set()  # skipped elements that no end tag follows
    while m := TOKEN.search(page, at):
        if m.start() > at:
            text = page[at : m.start()]
            pieces.append(text)
            if link:
                linked += len(text)
        at = m.end()
        name = m.group(2)
        if name is None:
            continue
        name, closing = name.lower(), m.group(1)
        open_nodes[-1].tags += 1
        if name in RAW:
            if not closing and not (name in ("svg", "math") and m.group(3).endswith("/")):
                # What these elements hold is skipped as a whole. If one is not closed, only unmarked text goes on to the end of the page.
                end = None if name in endless else skipped_to(name, page, at)
                if end is None and name not in ("button", "select"):
                    endless.add(name)
                if end is not None:
                    at = end
                elif name in UNMARKED and not m.group(3).endswith("/"):
                    at = len(page)
            continue
        if name in VOID:
            if name in ("br", "hr"):
                pieces.append(" ")
            continue
        if name == "a":
            link = 0 if closing else 1
            continue
        if name not in BLOCKS:
            continue
        if closing:
            for k in range(len(open_nodes) - 1, 0, -1):
                if name in ("html", "body") and open_nodes[k].tag in ("html", "body"):
                    close(k + 1)
                    break
                if open_nodes[k].tag == name:
                    close(k)
                    break
            continue
        flush()
        if len(open_nodes) == 1 and name not in ("html", "body"):
            enter("body", ())
        if name in CLOSES_P:
            for k in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[k].tag == "p":
                    close(k)
                    break
                if open_nodes[k].tag in ("td", "th", "li", "table", "article", "div", "section"):
                    break
        if name in ENDS:
            ends, within = ENDS[name]
            for k in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[k].tag in ends:
                    close(k)
                    break
                if open_nodes[k].tag in within:
                    break
        if name in ("html", "body") and any(x.tag in (name, "body") for x in open_nodes):
            continue
        names = ()
        if m.group(3):
            names = tuple(PARTS.findall(" ".join((a or b or c) for _, a, b, c in ATTRIBUTE.findall(m.group(3))).lower()))
        enter(name, names)
    if at < len(page):
        pieces.append(page[at:])
    flush()
    for node in reversed(nodes):  # sums over what is below
        if node.parent:
            p = node.parent
            p.chars += node.chars
            p.links += node.links
            p.words += node.words
            p.stops += node.stops
            p.commas += node.commas
            p.blocks += node.blocks
            p.tags += node.tags
            p.paragraphs += node.paragraphs
    return nodes, blocks


def named(node: Node, names: set[str]) -> bool:
    return any(w in names for w in node.names)


def disclaimed(node: Node) -> bool:
    """Whether tag or names say that a node is no article; what holds a page's article has other names too, as of its topics, and few that count."""
    return node.tag in BAD_TAGS or named(node, APART if node.tag in HOLDERS else BAD)


FEATURES = 25 + len(TAGS)


def features(nodes: list[Node]) -> np.ndarray:
    out = np.zeros((len(nodes), FEATURES))
    total = max(1, nodes[0].chars)
    bad_above, good_above, seen = {}, {}, 0
    same = {id(n): Counter(x.tag for x in n.children) for n in nodes}
    for i, n in enumerate(nodes):
        up = n.parent
        key = id(n)
        bad, good = disclaimed(n), n.tag in ("article", "main") or named(n, GOOD)
        bad_above[key] = (bad_above.get(id(up), 0) if up else 0) + bad
        good_above[key] = (good_above.get(id(up), 0) if up else 0) + good
        chars, words = n.chars, max(1, n.words)
        if up:
            siblings = len(up.children)
            around = up.chars - chars
            alike = same[id(up)][n.tag]
        else:
            siblings, around, alike = 1, 0, 1
        out[i, :25] = (
            bad, good, bad_above[key] - bad > 0, good_above[key] - good > 0, n.depth, np.log1p(chars), np.log1p(n.own), chars / total, chars / (n.tags + 1),
            n.links / max(1, chars), n.links / max(1, n.chars) > 0.5, n.stops / words, n.commas / words, words / max(1, n.blocks), np.log1p(n.blocks), np.log1p(n.paragraphs),
            n.paragraphs / max(1, n.blocks), siblings, alike / siblings, np.log1p(around), around / max(1, siblings - 1) / (chars + 1) if siblings > 1 else 0, seen / total,
            n.tag in BAD_TAGS, n.tag[0] == "h" and n.tag[1:].isdigit(), len(n.children),
        )
        if n.tag in TAGS:
            out[i, 25 + TAGS.index(n.tag)] = 1
        seen += n.own
    return out


def outright(nodes: list[Node]) -> np.ndarray | None:
    """Labels by what tags and names say: the share of a node's text that is in an article or main element, and not in a part of it that is named as
    something else. None if the page has no such element."""
    inside, article = {}, False
    for n in nodes:
        up = inside.get(id(n.parent)) if n.parent else False
        if disclaimed(n):
            inside[id(n)] = False
        else:
            inside[id(n)] = up or n.tag in ("article", "main")
            article = article or inside[id(n)]
    if not article:
        return None
    kept = {id(n): n.own * inside[id(n)] for n in nodes}
    for n in reversed(nodes):
        if n.parent:
            kept[id(n.parent)] += kept[id(n)]
    return np.array([kept[id(n)] > 0 and 2 * kept[id(n)] >= min(n.chars, 2 * kept[id(n)]) and kept[id(n)] >= 0.3 * n.chars for n in nodes])


def rewritten(page: str, draw: random.Random) -> list[tuple[str, str]]:
    """Other layouts of a page's own texts: (page, the same page with parts of the article in ``main`` and all else in ``aside``)."""
    nodes, blocks = parse(page)
    labels = outright(nodes)
    if labels is None:
        return []
    inside = [t for k, t in blocks if labels[k]]
    outside = [t for k, t in blocks if not labels[k]] or ["x"]
    if not inside:
        return []
    some = " ".join(inside).split()

    def words(a, b):
        n = draw.randint(a, b)
        k = draw.randrange(max(1, len(some) - n))
        return " ".join(some[k : k + n])

    def quoted(x):
        return entities.escape(x)

    def name(kind):
        if draw.random() < 0.4:
            return ""
        return f' {draw.choice(["class", "id"])}="{draw.choice(kind)}"'

    def links(n):
        return "".join(f"<li><a href='#'>{quoted(words(1, 3))}</a></li>" for _ in range(n))

    def extra():
        kind = draw.randrange(8)
        if kind == 0:
            return f"<{(t := draw.choice(['nav', 'div', 'ul']))}{name(['menu', 'navbar', 'breadcrumb'])}><ul>{links(draw.randint(3, 10))}</ul></{t}>"
        if kind == 1:
            return f"<{(t := draw.choice(['aside', 'div', 'section']))}{name(['sidebar', 'related', 'widget'])}><h3>{quoted(words(1, 3))}</h3><ul>{links(draw.randint(3, 8))}</ul><p>{quoted(words(3, 12))}</p></{t}>"
        if kind == 2:
            said = "".join(f"<div{name(['comment', 'reply'])}><b>{quoted(words(1, 2))}</b><p>{quoted(words(4, 40))}</p></div>" for _ in range(draw.randint(1, 5)))
            return f"<{(t := draw.choice(['div', 'section']))} {draw.choice(['class', 'id'])}=\"{draw.choice(['comments', 'discussion', 'replies'])}\"><h2>{quoted(words(1, 3))}</h2>{said}</{t}>"
        if kind == 3:
            return f"<div{name(['cookie notice', 'banner', 'consent'])}>{quoted(words(5, 25))} <a href='#'>{quoted(words(1, 2))}</a></div>"
        if kind == 4:
            return f"<form{name(['newsletter', 'login', 'search'])}><label>{quoted(words(1, 4))}</label><input name='q'><p>{quoted(words(2, 15))}</p></form>"
        if kind == 5:
            return f"<div class='{draw.choice(['ad', 'advert', 'promo', 'sponsored'])}'>{quoted(words(5, 30))}</div>"
        if kind == 6:
            return f"<footer>&copy; {quoted(draw.choice(outside))}</footer>" if draw.random() < 0.5 else f"<div{name(['footer', 'copyright'])}>&copy; {quoted(words(3, 12))}</div>"
        return f"<header{name(['header', 'masthead'])}><p>{quoted(words(1, 6))}</p></header>"

    def block(k, text):
        tag = "h1" if k == 0 and draw.random() < 0.7 else draw.choice(["p", "p", "p", "p", "p", "h2", "blockquote", "div"])
        return f"<{tag}>{quoted(text)}</{tag}>"

    def small():
        """What articles hold besides long texts: headings, tables of data, lists."""
        kind = draw.randrange(4)
        if kind < 2:
            return f"<{(t := draw.choice(['h1', 'h2', 'h2', 'h3']))}>{quoted(words(1, 8))}</{t}>"
        if kind == 2:
            wide, cell = draw.randint(2, 4), draw.choice(["td", "td", "th"])
            return "<table>" + "".join("<tr>" + "".join(f"<{cell}>{quoted(words(1, 3))}</{cell}>" for _ in range(wide)) + "</tr>" for _ in range(draw.randint(2, 6))) + "</table>"
        return f"<{(t := draw.choice(['ul', 'ol']))}>" + "".join(f"<li>{quoted(words(2, 12))}</li>" for _ in range(draw.randint(2, 6))) + f"</{t}>"

    out = []
    for _ in range(2):
        shown = inside[: draw.randint(1, len(inside))]
        before, after, within = ([extra() for _ in range(draw.randint(0, n))] for n in (3, 4, 1))
        body = [("in", block(k, t)) for k, t in enumerate(shown)]
        for _ in range(draw.randint(0, 3)):
            body.insert(draw.randint(0, len(body)), ("in", small()))
        for x in within:
            body.insert(draw.randint(0, len(body)), ("out", x))
        tag = draw.choice(["article", "main", "div", "div", "section"])
        wrap = name(["content", "post", "story", "entry", "c1"]) if tag in ("div", "section") else name(["c2", "post"])
        wide = draw.random() < 0.5
        page = [f"<html><head><title>x</title></head><body>{'<div>' if wide else ''}", *before, f"<{tag}{wrap}>", *(x for _, x in body), f"</{tag}>", *after, "</body></html>"]
        told = [f"<html><body>{'<div>' if wide else ''}", *(f"<!--out-->{x}<!--/out-->" for x in before), f"<{tag}{wrap}>"]
        told += [x if side == "in" else f"<!--out-->{x}<!--/out-->" for side, x in body] + [f"</{tag}>", *(f"<!--out-->{x}<!--/out-->" for x in after), "</body></html>"]
        out.append(("".join(page), "".join(told)))
    # Without any element of its own: plain text, inline markup and line breaks, alone or with the rest of a page around it.
    shown = inside[: draw.randint(1, len(inside))]
    text = draw.choice(["\n", " <br> ", "<br><br>"]).join(draw.choice(["{}", "{}", "<b>{}</b>", "<span>{}</span>"]).format(quoted(t)) for t in shown)
    if draw.random() < 0.4:
        out.append((text, text))
    else:
        before, after = ([extra() for _ in range(draw.randint(0, n))] for n in (2, 2))
        out.append((f"<html><body>{''.join(before)}{text}{''.join(after)}</body></html>", "<html><body>" + "".join(f"<!--out-->{x}<!--/out-->" for x in before) + text + "".join(f"<!--out-->{x}<!--/out-->" for x in after) + "</body></html>"))
    return out


def told_labels(told: str) -> tuple[list[Node], np.ndarray]:
    """Nodes of a rewritten page and their labels, from the comments that enclose what is no article."""
    spans = [(m.start(), m.end()) for m in re.finditer(r"<!--out-->.*?<!--/out-->", told, re.S)]
    nodes, _ = parse(told)
    # Text below a node that is not in any span: parse once more without the spans' texts, node by node.
    hidden = told
    for a, b in reversed(spans):
        hidden = hidden[:a] + re.sub(r">[^<]+<", "><", hidden[a:b]) + hidden[b:]
    bare, _ = parse(hidden)
    return nodes, np.array([b.chars > 0 and b.chars >= 0.3 * n.chars for n, b in zip(nodes, bare)])


LABELLED = r"(?i)<(article|main)"


def least_hashes(pages: DataFrame, most: int) -> DataFrame:
    """At most ``most`` different pages (html, h), those with the least hashes; of a page that many rows repeat each task hands on one."""
    least = F.broadcast(pages.select("h").distinct().orderBy("h").limit(most))

    def firsts(batches):
        seen = set()
        for pdf in batches:
            new = [x not in seen and not seen.add(x) for x in pdf["html"]]
            yield pdf[np.array(new, bool)]

    once = pages.join(least, "h", "left_semi").select("html", "h").mapInPandas(firsts, "html string, h long")
    return once.dropDuplicates(["html"]).orderBy("h", "html").limit(most)


def sampled(pages: DataFrame, html: str, most: int) -> DataFrame:
    """At most ``most`` different pages whose tags say outright what their article is, wherever in the table they are."""
    rows = pages.where(F.length(html) > 0).select(F.col(html).alias("html"), F.xxhash64(html).alias("h"))
    rows = rows.where(F.col("html").rlike(LABELLED))

    def labelled(batches):
        for pdf in batches:
            yield pdf[np.array([outright(parse(x)[0]) is not None for x in pdf["html"]], bool)]

    found = staged(least_hashes(rows, most), "sample")
    told = found.mapInPandas(labelled, "html string, h long")
    if told.count() < found.count():
        # Some of the elements are comments, cards or the like: look at all pages that have any.
        told = staged(least_hashes(rows.mapInPandas(labelled, "html string, h long"), most), "sample")
    return told.select("html")


def built_in(pages: int = 150) -> list[str]:
    """Labelled pages of invented text for tables in which no page is labelled: a menu, an article of a heading and some paragraphs, and a footer."""
    words = "the of and to in a is that for it as was with be by on not river stone winter market letter garden engine harbour paper music road teacher island bread window history"
    words, draw = words.split(), random.Random(5)

    def text(a, b):
        return " ".join(draw.choices(words, k=draw.randint(a, b))).capitalize()

    out = []
    for _ in range(pages):
        menu = "".join(f"<li><a href='#'>{text(1, 2)}</a></li>" for _ in range(draw.randint(3, 9)))
        parts = "".join("<p>" + " ".join(f"{text(5, 9)}, {draw.choice(words)} {draw.choice(words)}." for _ in range(draw.randint(1, 9))) + "</p>" for _ in range(draw.randint(1, 9)))
        advert = f"<div class='ad'>{text(4, 15)}.</div>" if draw.random() < 0.5 else ""
        out.append(f"<html><head><title>x</title></head><body><nav><ul>{menu}</ul></nav>{advert}<article><h1>{text(3, 9)}</h1>{parts}</article><footer>&copy; {text(3, 9)}.</footer></body></html>")
    return out


def training_nodes(sample: DataFrame) -> DataFrame:
    """Features and labels of the nodes of labelled pages and of their rewritten forms."""

    def run(batches):
        for pdf in batches:
            rows, labels = [], []
            for page in pdf["html"]:
                nodes, _ = parse(page)
                rows.append(features(nodes))
                labels.append(outright(nodes))
                for _, told in rewritten(page, random.Random(page[:2000] + str(len(page)))):
                    nodes, own = told_labels(told)
                    rows.append(features(nodes))
                    labels.append(own)
            if rows:
                yield pd.DataFrame({"features": list(np.concatenate(rows)), "label": np.concatenate(labels).astype(float)})

    return sample.repartition(4).mapInPandas(run, "features array<double>, label double")


class Trees:
    """Boosted trees as arrays, worked out for many nodes at once."""

    def __init__(self, trees: list[tuple[list, list, list, list, list]], weights: list[float]):
        self.trees = [tuple(np.array(x) for x in t) for t in trees]
        self.weights = weights

    @classmethod
    def of(cls, model) -> Trees:
        def walk(node, out) -> int:
            k = len(out)
            out.append(None)
            if node.getClass().getSimpleName() == "InternalNode":
                split = node.split()
                out[k] = (split.featureIndex(), split.threshold(), walk(node.leftChild(), out), walk(node.rightChild(), out), 0.0)
            else:
                out[k] = (-1, 0.0, k, k, node.prediction())
            return k

        trees = []
        for tree in model.trees:
            out: list = []
            walk(tree._call_java("rootNode"), out)
            trees.append(tuple(map(list, zip(*out))))
        return cls(trees, list(model.treeWeights))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for (feature, threshold, left, right, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            while (feature[at] >= 0).any():
                own = feature[at]
                at = np.where(own < 0, at, np.where(x[rows, np.maximum(own, 0)] <= threshold[at], left[at], right[at]))
            total += weight * value[at]
        return 2 * total


def learn(pages: DataFrame, html: str = "html", most: int = 300, trees: int = 15, depth: int = 4) -> Trees | None:
    """Trees learnt from at most ``most`` pages, or from the built-in ones where no page says outright what its article is; None without any page."""
    if pages.where(F.length(html) > 0).isEmpty():
        return None
    spark = pages.sparkSession
    for sample in (lambda: sampled(pages, html, most), lambda: spark.createDataFrame([(x,) for x in built_in()], "html string")):
        nodes = training_nodes(sample()).withColumn("features", array_to_vector("features")).persist()
        try:
            if nodes.select("label").distinct().count() == 2:
                return Trees.of(GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, maxBins=32).fit(nodes))
        finally:
            nodes.unpersist()


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """The choice of nodes with the greatest sum of log-odds in which every chosen node's parent is chosen too; the root always is.

    A node counts by the text in it alone, a little for each node, so that long blocks decide about what they stand in.
    """
    weight = np.array([1.0 + np.log1p(n.own) for n in nodes])
    gain = weight * np.clip(odds, -4, 4)
    place = {id(n): k for k, n in enumerate(nodes)}
    best = gain.copy()
    for k in range(len(nodes) - 1, 0, -1):
        if best[k] > 0:
            best[place[id(nodes[k].parent)]] += best[k]
    chosen = np.zeros(len(nodes), bool)
    chosen[0] = True
    for k in range(1, len(nodes)):
        chosen[k] = best[k] > 0 and chosen[place[id(nodes[k].parent)]]
    return chosen


def main_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html", model: Trees | None = None, most: int = 300) -> DataFrame:
    """Per row the id, the url and the ``text``: the article's blocks in page order, joined by an empty line. ``model`` spares learning one."""
    trees = model or learn(pages, html, most)

    def run(batches):
        for pdf in batches:
            texts = []
            for a in range(0, len(pdf), 500):
                parsed = [parse(x) for x in pdf["html"].iloc[a : a + 500]]
                if trees is None:
                    texts += [""] * len(parsed)
                    continue
                odds = trees.log_odds(np.concatenate([features(nodes) for nodes, _ in parsed]))
                at = 0
                for nodes, blocks in parsed:
                    chosen = decode(nodes, odds[at : at + len(nodes)])
                    at += len(nodes)
                    texts.append("\n\n".join(t for k, t in blocks if chosen[k]))
            yield pdf[["id", "url"]].assign(text=texts)

    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return map_frames(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, url string, text string").select(F.col("id").alias(id), F.col("url").alias(url), "text")
