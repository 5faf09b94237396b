"""Main text of HTML pages: gradient-boosted trees over DOM nodes, decoded down the tree.

A page becomes a tree of its block elements; inline elements belong to the block around them. Each
node is described by its tag, its attribute tokens and those above it, its subtree's density of text, links
and punctuation, its depth, and its place among its siblings. Boosted trees give each node the
log-odds of being content. Decoding keeps the set of nodes of the largest total in which a node is kept only if its
parent is: a dropped ancestor never has a kept descendant.

The trees are fitted on labelled pages made by a generator and on a bounded sample of the
table's own pages, whose nodes are labelled where semantic elements or attribute tokens tell.
"""

from __future__ import annotations

import random
import re
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .boosting import Trees, fit_trees
from .common import broadcast_value, first_by_hash, table, without
from .words import slices

#: Pages of the table that are learned from, at most; generated pages.
SAMPLE, GENERATED = 300, 400
ROWS = 256
OUTPUTS = ["text", "n_chars"]

# HTML element names.
INLINE = set(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
             "math mi mo mn ms mtext mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mmultiscripts mtable mtr mtd mstyle mspace mpadded mphantom menclose merror semantics").split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NO_TEXT = set("script style title template noscript svg annotation annotation-xml iframe object select textarea canvas video audio datalist".split())
RAW = {"script", "style", "title", "textarea"}  # nothing but their own end tag ends them
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSED_BY_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
TAGS = [{"article"}, {"main"}, {"section"}, {"div"}, {"p"}, {"h1"}, {"h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "menu"}, {"li", "dt", "dd"}, {"nav"}, {"header", "hgroup"}, {"footer"},
        {"aside"}, {"form", "fieldset", "button", "legend", "input"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"figure", "figcaption"}, {"blockquote", "pre", "address"}, {"details", "summary", "dialog"}]
TAG_GROUP = {t: i for i, g in enumerate(TAGS) for t in g}
# Tokens of class, id and role attributes.
TOKENS = [set("article content post entry story main body text prose page blog".split()), set("nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs".split()),
          set("header masthead topbar banner logo hero branding".split()), set("footer copyright colophon legal bottom".split()), set("sidebar aside widget rail related recommended complementary trending popular tags".split()),
          set("notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription paywall message toast warning signup".split()), set("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted adsbygoogle".split()),
          set("form login search register contact".split()), set("comment comments reply replies respond disqus discussion reader".split()), set("share sharing social follow tools toolbar buttons".split())]
TOKEN_GROUP = {t: i for i, g in enumerate(TOKENS) for t in g}
_GROUPS = len(TAGS)
MARK = "data-content"  # set by the generator; never a feature


@lru_cache(maxsize=1 << 14)
def _token_mask(text: str) -> int:
    mask, word = 0, ""
    for c in text + " ":
        if c.isalpha():
            if c.isupper() and word and word[-1].islower():
                mask |= 1 << TOKEN_GROUP[word.lower()] if word.lower() in TOKEN_GROUP else 0
                word = ""
            word += c
        elif word:
            mask |= 1 << TOKEN_GROUP[word.lower()] if word.lower() in TOKEN_GROUP else 0
            word = ""
    return mask


def _value_mask(value: str) -> int:
    """Of the whole value; only short ones are remembered."""
    return _token_mask(value) if len(value) <= 400 else _token_mask.__wrapped__(value)


class Dom(HTMLParser):
    """Block elements as parallel lists, and runs of text in page order."""

    def __init__(self, ends: dict[str, int] | None = None):
        super().__init__(convert_charrefs=True)
        self.ends = ends or {}  # of elements without text: end tags still to come less start tags still to come
        self.parent, self.tag, self.mask, self.mark = [-1], ["#page"], [0], [None]
        self.runs: list[tuple[int, str, int]] = []  # node, text, characters in links
        self.open = [0]
        self.buffer: list[str] = []
        self.in_link = self.linked = 0
        self.silent: list[str] = []  # an open element without text and the elements open in it

    def flush(self):
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.runs.append((self.open[-1], text, min(self.linked, len(text))))
            self.buffer = []
        self.linked = self.in_link = 0

    def _pop(self, names: set[str], scope: set[str]):
        for i in range(len(self.open) - 1, 0, -1):
            t = self.tag[self.open[i]]
            if t in names:
                self.flush()
                del self.open[i:]
                return
            if t in scope:
                return

    def handle_starttag(self, tag, attrs):
        if self.silent and self.silent[-1] not in RAW and "svg" in self.silent and tag in CLOSES_P and not {"foreignobject", "desc"} & set(self.silent):
            del self.silent[self.silent.index("svg"):]  # a block is never inside a drawing
        if tag in NO_TEXT:
            self.ends[tag] = self.ends.get(tag, 0) + 1
        if tag in NO_TEXT or self.silent:
            if tag not in VOID:
                self.silent.append(tag)
            return
        if tag in VOID:
            if tag == "hr":
                self._pop({"p"}, CLOSES_P - {"p"})
                self.flush()
            elif tag == "br":
                self.buffer.append(" ")
            return
        if tag in INLINE:
            if tag == "a":
                self.in_link = 1
            return
        if tag in CLOSES_P:
            self._pop({"p"}, CLOSES_P - {"p"})
        if tag in CLOSED_BY_SAME:
            self._pop(CLOSED_BY_SAME[tag], SCOPE.get(tag, set()))
        self.flush()
        tokens, mark = 0, None
        for k, v in attrs:
            if v and k in ("class", "id", "role", "aria-label"):
                tokens |= _value_mask(v)
            elif k == MARK:
                mark = v == "1"
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.mask.append(tokens)
        self.mark.append(mark)
        self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        if tag in NO_TEXT:
            self.ends[tag] = self.ends.get(tag, 0) + 1
        elif not self.silent:
            self.handle_starttag(tag, attrs)
            if tag not in VOID:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in NO_TEXT:
            self.ends[tag] = self.ends.get(tag, 0) - 1
        if self.silent:
            if tag in self.silent:  # with those left open in it
                del self.silent[len(self.silent) - 1 - self.silent[::-1].index(tag):]
                return
            if tag in NO_TEXT or tag in ("p", "li") or RAW & set(self.silent) or self.ends[self.silent[0]] > 0 or all(self.tag[i] != tag for i in self.open[1:]):
                return
            self.silent.clear()  # the end of an element around one that is never closed
        if tag in NO_TEXT:
            return
        if tag == "a":
            self.in_link = 0
        elif tag not in INLINE and tag not in VOID:
            self._pop({tag}, {"article", "main"} if tag in ("p", "li", "span") else set())

    def handle_data(self, data):
        if not self.silent:
            self.buffer.append(data)
            if self.in_link:
                self.linked += len(data)


_SILENT_TAG = re.compile(rf"<(/?)({'|'.join(sorted(NO_TEXT, key=len, reverse=True))})(?=[\s/>])", re.IGNORECASE)


def parse(html: str) -> Dom:
    ends: dict[str, int] = {}
    for slash, tag in _SILENT_TAG.findall(html):
        ends[tag.lower()] = ends.get(tag.lower(), 0) + (1 if slash else -1)
    dom = Dom(ends)
    dom.feed(html)
    dom.close()
    dom.flush()
    return dom


class Nodes:
    """The nodes of several pages: tree arrays, features and runs."""

    def __init__(self, pages: list[Dom]):
        sizes = [len(d.tag) for d in pages]
        self.first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        page = np.repeat(np.arange(len(pages)), sizes)
        parent = np.array([p + a if p >= 0 else -1 for d, a in zip(pages, self.first.tolist()) for p in d.parent], np.int64)
        n = len(parent)
        group = np.array([TAG_GROUP.get(t, -1) for d in pages for t in d.tag], np.int64)
        mask = np.array([m for d in pages for m in d.mask], np.int64)
        depth = np.zeros(n, np.int64)
        for i in range(n):  # parents come before children
            if parent[i] >= 0:
                depth[i] = depth[parent[i]] + 1
        self.parent, self.depth, self.levels = parent, depth, int(depth.max(initial=0))
        self.run_node = np.array([r[0] + a for d, a in zip(pages, self.first.tolist()) for r in d.runs], np.int64)
        self.texts = [r[1] for d in pages for r in d.runs]
        self.run_page = np.repeat(np.arange(len(pages)), [len(d.runs) for d in pages])
        chars = np.array([len(t) for t in self.texts], np.float64)
        own = {"chars": chars, "links": np.array([r[2] for d in pages for r in d.runs], np.float64),
               "words": np.array([t.count(" ") + 1 for t in self.texts], np.float64),
               "marks": np.array([t.count(".") + t.count(",") for t in self.texts], np.float64), "runs": np.ones(len(chars))}
        own = {k: np.bincount(self.run_node, v, n) if len(v) else np.zeros(n) for k, v in own.items()}
        below = {k: self.up(v) for k, v in own.items()}
        below["nodes"] = self.up(np.ones(n))
        inherited_tag, inherited_mask = self.down(np.where(group >= 0, 1 << np.maximum(group, 0), 0)), self.down(mask)
        order = np.arange(n)
        kids = np.bincount(parent[parent >= 0], minlength=n)
        rank = np.zeros(n)
        by_parent = np.lexsort((order, parent))
        starts = np.ones(n, bool)
        starts[1:] = parent[by_parent][1:] != parent[by_parent][:-1]
        position = order - np.maximum.accumulate(np.where(starts, order, 0))
        rank[by_parent] = position
        siblings = np.where(parent >= 0, kids[np.maximum(parent, 0)], 1)
        like = np.unique(parent * 64 + group, return_inverse=True, return_counts=True)
        page_chars = np.maximum(below["chars"][self.first[:-1]], 1)[page] if n else np.zeros(0)
        started = np.cumsum(own["chars"]) - own["chars"]
        started -= started[self.first[:-1]][page] if n else 0
        some = np.maximum(below["chars"], 1)
        bits = lambda m, k: ((m[:, None] >> np.arange(k)) & 1).astype(np.float64)
        up = np.maximum(parent, 0)
        self.x = np.hstack([
            bits(np.where(group >= 0, 1 << np.maximum(group, 0), 0), _GROUPS), bits(mask, len(TOKENS)),
            bits(np.where(parent >= 0, inherited_tag[up], 0), _GROUPS), bits(np.where(parent >= 0, inherited_mask[up], 0), len(TOKENS)),
            np.stack([depth, kids, rank, siblings, rank / np.maximum(siblings, 1), like[2][like[1]],
                      np.log1p(own["chars"]), np.log1p(below["chars"]), np.log1p(below["nodes"]), below["chars"] / below["nodes"],
                      below["links"] / some, below["marks"] / some, below["words"] / np.maximum(below["runs"], 1), below["chars"] / page_chars,
                      started / page_chars, (below["links"] / some)[up]], axis=1)]) if n else np.zeros((0, 1))
        self.weight = 1 + np.log1p(own["chars"])

    def up(self, v: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        v = v.astype(np.float64).copy()
        for d in range(self.levels, 0, -1):
            at = np.flatnonzero(self.depth == d)
            np.add.at(v, self.parent[at], v[at])
        return v

    def down(self, v: np.ndarray) -> np.ndarray:
        """Bits of a node and all above it."""
        v = v.copy()
        for d in range(1, self.levels + 1):
            at = np.flatnonzero(self.depth == d)
            v[at] |= v[self.parent[at]]
        return v

    def decode(self, log_odds: np.ndarray) -> np.ndarray:
        """The kept nodes: the closed set under parents with the largest total."""
        best = log_odds * self.weight
        for d in range(self.levels, 0, -1):
            at = np.flatnonzero(self.depth == d)
            np.add.at(best, self.parent[at], np.maximum(best[at], 0))
        keep = best > 0
        for d in range(1, self.levels + 1):
            at = np.flatnonzero(self.depth == d)
            keep[at] &= keep[self.parent[at]]
        return keep


def extract(pages: list[str], model: Trees) -> list[str]:
    nodes = Nodes([parse(h) for h in pages])
    keep = nodes.decode(model.log_odds(nodes.x)) if len(nodes.x) else np.zeros(0, bool)
    out: list[list[str]] = [[] for _ in pages]
    for page, node, text in zip(nodes.run_page.tolist(), nodes.run_node.tolist(), nodes.texts):
        if keep[node]:
            out[page].append(text)
    return ["\n".join(t) for t in out]


# -- labelled pages -----------------------------------------------------------------

#: Content whose attributes name other things, as many templates write it.
MISLEADING = [("article", ' class="post comments-open"'), ("article", ' class="post comments-open sidebar-right"'), ("article", ' class="post tag-popular category-discussion"'),
              ("article", ' class="hentry has-sidebar no-share footer-fixed"'), ("main", ' class="page nav-open ads-off"'), ("article", ' class="promo-none login-optional search-result"')]


def generate(rng: random.Random) -> str:
    """A page whose content is marked."""
    word = lambda: "".join(rng.choice(["an", "re", "sto", "li", "en", "the", "du", "ka"]) for _ in range(rng.randint(1, 4)))
    prose = lambda a, b: " ".join(word() + rng.choice(["", "", "", ".", ","]) for _ in range(rng.randint(a, b)))
    link = lambda: f'<a href="/{word()}">{prose(1, 3)}</a>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 9))) + "</ul>"

    def paragraph():
        long = rng.choice([(1, 4), (5, 30), (30, 120)])
        text = prose(*long)
        if rng.random() < 0.2:
            text = f"{text} {link()} {prose(2, 20)}"
        return rng.choice([f"<p>{text}</p>"] * 6 + [f"<p><b>{text}<br>", f"<h2>{prose(2, 6)}</h2><p>{text}", f"<ul><li>{prose(3, 15)}</li><li>{prose(3, 15)}</li></ul>", f"<blockquote><p>{text}</p></blockquote>",
                           f"<table><tr><td>{prose(1, 4)}</td><td>{prose(1, 4)}</td></tr></table>", f"<figure><img src=x><figcaption>{prose(3, 12)}</figcaption></figure>", f"<pre>{text}</pre>", f"<noscript><div><img src=x><p>{prose(1, 4)}</p></div></noscript><p>{text}</p>"])

    heading = rng.choice([f"<h1>{prose(2, 9)}</h1>", f"<header><h1>{prose(2, 9)}</h1></header>", ""])
    inside = heading + "".join(paragraph() for _ in range(rng.choice([1, 1, 2, 4, 8, 20])))
    left, right = rng.choice([("article", ""), ("article", ' class="post"'), ("main", ""), ("div", ' class="post-content"'), ("div", ' id="content"'), ("section", ' class="story-body"'), ("div", ' class="entry"'), ("article", ""), *MISLEADING]), None
    out = lambda tag, token: rng.choice([tag, f'div class="{token}"', f'div id="{token}"', f'section class="{token}"'])

    def boiler(kind: str) -> str:
        short = prose(1, rng.choice([5, 15, 40]))
        start, body = {
            "nav": (out("nav", "menu"), links()), "crumbs": (out("nav", "breadcrumb"), link() + " / " + link()), "header": (out("header", "masthead"), f"<p>{short}</p>" + rng.choice([links(), ""])),
            "footer": (out("footer", "footer"), rng.choice([f"&copy; {short}", links() + f"<p>{short}</p>"])), "side": (out("aside", "sidebar"), rng.choice([links(), f"<h3>{prose(1, 3)}</h3><p>{short}</p>"])),
            "notice": (out('div class="notice"', "cookie-notice"), rng.choice([short, f"<p>{short}</p><button>{word()}</button>"])), "ad": (out('div class="ad"', "advert"), rng.choice([short, f"<p>{short}</p>", link(), f"<noscript><div><a href=x>{short}</a></div></noscript><p>{short}</p>"])),
            "form": (out('form action="/s"', "search-form"), f"<label>{short}</label><input name=q><button>{word()}</button>"), "news": (out('form class="newsletter"', "newsletter-signup"), f"<p>{short}</p><input name=e>"),
            "comments": (out('section id="comments"', "comments"), "".join(rng.choice([f'<div class="comment"><p>{prose(2, 40)}</p></div>', f'<article class="comment"><h4>{word()}</h4><p>{prose(2, 40)}</p></article>', f'<li class="comment">{prose(2, 40)}</li>']) for _ in range(rng.randint(1, 6)))),
            "share": (out('div class="share"', "social-share"), links()), "related": (out("aside", "related"), f"<h3>{prose(1, 3)}</h3>" + links()), "bare": (rng.choice(["div", 'div class="block-3"']), links())}[kind]
        return f'<{start} {MARK}="0">{body}</{start.split()[0]}>'

    pick = lambda kinds, most: "".join(boiler(rng.choice(kinds)) for _ in range(rng.randint(0, most)))
    if rng.random() < 0.3:
        inside += pick(["ad", "share", "related", "news", "comments", "footer"], 2)
    content = f'<{left[0]}{left[1]} {MARK}="1">{inside}</{left[0]}>'
    if rng.random() < 0.3:
        content = f'<main {MARK}="1">{content}</main>' if left[0] != "main" else content
    body = pick(["nav", "header", "crumbs", "notice", "ad", "form", "bare"], 3) + content + pick(["comments", "related", "side", "ad", "news", "share", "footer", "nav", "form", "bare"], 4)
    if rng.random() < 0.4:
        body = f'<div class="{rng.choice(["wrapper", "container", "page", "site"])}">{body}</div>'
    return f"<!DOCTYPE html><html><head><title>{prose(1, 6)}</title><style>p{{}}</style></head><body>{body}</body></html>"


MAIN_SHARE = 0.4  # of a page's text that an article holds, to be content by that alone
BAD_TAGS = set("nav footer aside form fieldset button dialog".split())


def _labels(dom: Dom, generated: bool) -> list[int | None]:
    """1, 0 or unknown for each node. Nodes above content count as content."""
    own: list[int | None] = []
    below = [0] * len(dom.tag)
    for node, text, _ in dom.runs:
        below[node] += len(text)
    for i in range(len(below) - 1, 0, -1):
        below[dom.parent[i]] += below[i]
    for p, tag, mask, mark in zip(dom.parent, dom.tag, dom.mask, dom.mark):
        above = own[p] if p >= 0 else None
        if generated:
            y = int(mark) if mark is not None else above
        elif above == 0 or tag in BAD_TAGS or (tag == "header" and above != 1):
            y = 0
        elif tag in ("article", "main") and below[len(own)] >= MAIN_SHARE * below[0]:
            y = 1  # it holds the page's text, whatever its attributes say
        else:
            y = 0 if mask >> 1 else 1 if tag in ("article", "main") else above
        own.append(y)
    for i in range(len(own) - 1, 0, -1):
        if own[i] == 1 and own[dom.parent[i]] is None:
            own[dom.parent[i]] = 1
    return own


def fit(pages: list[str], generated: int = GENERATED) -> Trees:
    """Trees from a bounded list of the table's pages and from generated ones."""
    rng = random.Random(11)
    made = [parse(generate(rng)) for _ in range(generated)]
    real = [d for d in map(parse, pages) if {"article", "main"} & set(d.tag)]
    nodes = Nodes([*made, *real])
    y = [v for i, d in enumerate([*made, *real]) for v in _labels(d, i < len(made))]
    known = np.array([v is not None for v in y])
    y = np.array([v or 0 for v in y], float)
    return fit_trees(nodes.x[known], y[known], nodes.weight[known])


def extract_text(pages: DataFrame, model: Trees, html: str = "html") -> DataFrame:
    """``pages`` plus ``text``, the main text with its blocks joined by line ends, and ``n_chars``, its code points.

    Null, empty and text-free pages: empty text, 0. Repeated rows get the same text. Empty table: no
    rows. Input columns named like an output are replaced."""
    keep = without(pages, OUTPUTS)
    shared = broadcast_value(pages.sparkSession, model)  # bounded: trees x nodes

    def run(batches):
        for batch in batches:
            for a, b in slices(batch.column("__html"), rows=ROWS):
                part = batch.slice(a, b - a)
                texts = extract([h or "" for h in part.column("__html").to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*keep, *OUTPUTS])

    fields = [*pages.select(*keep).schema.fields, StructField("text", StringType()), StructField("n_chars", LongType())]
    return pages.select(*keep, F.col(html).alias("__html")).mapInArrow(run, StructType(fields))


def fit_on(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> Trees:
    """The first ``sample`` pages by a hash of their html, at most 100,000 characters long each."""
    some = pages.where((F.length(html) > 0) & (F.length(html) <= 100_000)).select(F.col(html).alias("h"))
    return fit([r["h"] for r in first_by_hash(some, "h", sample, some.count()).collect()])


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages.select("page_id", "url", "html"), fit_on(pages)).select("page_id", "url", "text", "n_chars")
