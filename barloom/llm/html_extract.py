"""Main text of web pages by a linear-chain CRF over DOM leaf blocks."""

from __future__ import annotations

import html
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.arrow import with_columns

# Pages of the table that the CRF is fitted on, in the order of a hash of their ids, beside as many
# pages laid out here; both are labelled by where a block stands.
SAMPLE_PAGES = 300
LAID_OUT_PAGES = 300
EPOCHS, RATE, DECAY = 12, 0.2, 1e-4

# How HTML names its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "q s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset(["script", "style"])
# Elements whose text is not the page's: up to their end, that of their parent, or at once for <.../>.
DROPPED = frozenset("noscript template iframe svg object canvas".split())
# Elements that end an open svg, unless they stand in its foreignObject.
BREAKOUT = frozenset("blockquote body center dd div dl dt h1 h2 h3 h4 h5 h6 head hr img li menu ol p pre "
                     "ruby table ul".split())

_OPEN = re.compile(r"<(?:!--|[!?]|/?[a-z]|/)", re.IGNORECASE)
_NAME = re.compile(r"[^\s/>]*")
# A quote opens a value only after an equals sign.
_STOP = re.compile(r"""=\s*["']|>""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""",
                    re.IGNORECASE)


@dataclass
class Block:
    """A run of text between block boundaries, under its ancestors' features."""

    text: str
    above: tuple[str, ...]
    linked: int
    chain: tuple[tuple[str, ...], ...] = ()  # features of each ancestor, outermost first


def tags(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of each piece of markup, in order and never overlapping.

    Comments and declarations have no name; the contents of scripts and styles belong to their tag. A
    tag, comment or raw element that never ends takes the rest of the page, as in a browser; a quote
    that is never closed is an ordinary character. No part of the page is read more than a few times.
    """
    at, n = 0, len(page)
    closed = {q: page.rfind(q) for q in "\"'"}
    while (found := _OPEN.search(page, at)) is not None:
        start, head = found.start(), found.group()
        if head == "<!--":
            end = page.find("-->", start + 2)
            at = n if end < 0 else end + 3
            yield start, at, "", False, ""
            continue
        if head in ("<!", "<?", "</"):
            end = page.find(">", start)
            at = n if end < 0 else end + 1
            yield start, at, "", False, ""
            continue
        closing = head[1] == "/"
        named = _NAME.match(page, start + 2 if closing else start + 1)
        at, name = named.end(), named.group().lower()
        while (stop := _STOP.search(page, at)) is not None and stop.group() != ">":
            quote = stop.group()[-1]
            at = page.index(quote, stop.end()) + 1 if closed[quote] >= stop.end() else stop.end()
        end = n if stop is None else stop.end()
        attributes = page[named.end():n if stop is None else stop.start()]
        at = end
        if name in RAW and not closing:
            last = _RAW_END[name].search(page, end)
            at = n if last is None else page.find(">", last.end()) + 1 or n
            name = ""
        yield start, at, name, closing, attributes


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order: references decoded, white space folded and trimmed."""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    state = {"linked": 0, "in_link": 0, "dropped": False}

    def close() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            above = tuple(sorted({f for _, names in stack for f in names}))
            found.append(Block(text, above, min(state["linked"], len(text)),
                               tuple(names for _, names in stack)))
        parts.clear()
        state["linked"] = 0

    def take(text: str) -> None:
        if state["dropped"]:
            return
        parts.append(text)
        if state["in_link"]:
            state["linked"] += len(text.strip())

    at = 0
    page = page or ""
    for start, end, name, ends, attributes in tags(page):
        if start > at:
            take(page[at:start])
        at = end
        if not name:
            continue
        if name in BREAKOUT and not ends and state["dropped"]:
            names = [n for n, _ in stack]
            if "svg" in names and "foreignobject" not in names:
                del stack[names.index("svg"):]
                state["dropped"] = any(n in DROPPED for n, _ in stack)
        if name in INLINE:
            if name == "a" and not state["dropped"]:
                state["in_link"] = 0 if ends else 1
            continue
        if ends:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            outer = k is not None and not any(n in DROPPED for n, _ in stack[:k + 1])
            if outer or not state["dropped"] and name not in DROPPED:
                close()
            if k is not None:
                del stack[k:]
                state["dropped"] = state["dropped"] and any(n in DROPPED for n, _ in stack)
        elif name in DROPPED or state["dropped"]:
            if name not in VOID and not attributes.rstrip().endswith("/"):
                stack.append((name, ()))
                state["dropped"] = True
        else:
            close()
            if name not in VOID:
                # A new paragraph, item or cell ends an open one.
                if stack and stack[-1][0] == name and name in ("p", "li", "option", "td", "tr", "dd"):
                    stack.pop()
                # What a page's body is named says nothing of a block.
                words = set() if name in ("html", "body") else {
                    w for m in _NAMES.findall(attributes) for n in m
                    for w in re.findall(r"[a-z]+", n.lower())}
                stack.append((name, (f"tag:{name}", *(f"name:{w}" for w in sorted(words)))))
    if at < len(page):
        take(page[at:])
    close()
    return found


def features(block: Block) -> tuple[str, ...]:
    size = len(block.text)
    near = next((c for c in reversed(block.chain) if _marks(c)), ())
    return (*block.above, *(f"near:{f}" for f in near or ("none",)), f"size:{min(int(math.log2(size + 1)), 10)}",
            f"links:{round(4 * block.linked / size)}",
            f"ends:{block.text[-1] if block.text[-1] in '.!?:' else 'other'}",
            f"marks:{min(block.text.count('.') + block.text.count(','), 4)}", "any")


@dataclass
class Crf:
    """Two labels, 1 for main text: a weight per feature for label 1, and one per transition."""

    weights: dict[str, float] = field(default_factory=dict)
    moves: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def evidence(self, page: list[Block]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in features(b)) for b in page]

    def decode(self, page: list[Block]) -> list[int]:
        """The most probable label sequence (Viterbi); ties go to label 0."""
        best, back = [0.0, 0.0], []
        for k, e in enumerate(self.evidence(page)):
            if not k:
                best = [0.0, e]
                continue
            came = [int(best[1] + self.moves[1][y] > best[0] + self.moves[0][y]) for y in (0, 1)]
            best = [best[came[y]] + self.moves[came[y]][y] + (e if y else 0.0) for y in (0, 1)]
            back.append(came)
        label = int(best[1] > best[0])
        out = [label] if page else []
        for came in reversed(back):
            label = came[label]
            out.append(label)
        return out[::-1]

    def update(self, page: list[Block], gold: list[int], rate: float) -> None:
        """One step along the gradient of the log-likelihood, by forward-backward."""
        e, n = self.evidence(page), len(page)
        moves = np.array(self.moves)
        node = np.zeros((n, 2))
        node[:, 1] = e
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = node[0]
        for k in range(1, n):
            ahead[k] = node[k] + np.logaddexp.reduce(ahead[k - 1][:, None] + moves, axis=0)
        for k in range(n - 2, -1, -1):
            behind[k] = np.logaddexp.reduce(moves + (node[k + 1] + behind[k + 1])[None], axis=1)
        total = np.logaddexp.reduce(ahead[-1])
        expected = np.exp(ahead + behind - total)
        for k, block in enumerate(page):
            step = rate * (gold[k] - expected[k, 1])
            for f in features(block):
                w = self.weights.get(f, 0.0)
                self.weights[f] = w + step - rate * DECAY * w
        for k in range(1, n):
            both = np.exp(ahead[k - 1][:, None] + moves + (node[k] + behind[k])[None] - total)
            for y in (0, 1):
                for z in (0, 1):
                    self.moves[y][z] += rate * ((gold[k - 1] == y and gold[k] == z) - both[y, z])


# Where main text stands and where it does not: element and names of a container.
MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "article body"),
        ("div", "post entry"), ("section", "story text")]
OTHER = [("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""), ("div", "ad"),
         ("div", "ads advert"), ("div", "sidebar"), ("div", "menu"), ("div", "notice"),
         ("div", "cookie banner"), ("section", "comments"), ("div", "comment"), ("ol", "commentlist"),
         ("div", "related"), ("div", "share social"), ("div", "newsletter signup"),
         ("ul", "breadcrumb"), ("div", "promo sponsored"), ("dialog", ""), ("div", "popup modal"),
         ("div", "footer"), ("div", "header"), ("div", "navigation"), ("div", "login"),
         ("button", ""), ("select", ""), ("textarea", ""), ("div", "disqus replies")]
_OTHER_TAGS = {f"tag:{t}" for t, names in OTHER if not names} | {"tag:title", "tag:head"}
_OTHER_NAMES = {f"name:{w}" for _, names in OTHER for w in names.split()}
_MAIN_MARKS = {"tag:article", "tag:main"} | {
    f"name:{w}" for _, names in MAIN for w in names.split()}
_OTHER_MARKS = _OTHER_TAGS | _OTHER_NAMES
_ALL_MARKS = _MAIN_MARKS | _OTHER_MARKS
# Wrappers that do not mark main text; the first is none at all.
UNMARKED = ["", '<div id="page">', '<div class="wrapper">', '<div class="container">', "<div>",
            '<div id="root">', "<section>"]
WRAPPERS = ["header", "menu", "ad", "sidebar", "related", "notice"]


def _marks(names: tuple[str, ...]) -> bool:
    return not _ALL_MARKS.isdisjoint(names)


def place_label(block: Block) -> int:
    """1 for a block whose nearest marked ancestor is a container of main text.

    One that only its names mark must not stand in any of the others; what stands around an article
    or main element, such as a wrapper named menu, does not matter.
    """
    named = 0
    for names in reversed(block.chain):
        if not _OTHER_MARKS.isdisjoint(names):
            return 0
        if "tag:article" in names or "tag:main" in names:
            return 1
        named = named or int(not _MAIN_MARKS.isdisjoint(names))
    return named


def laid_out_page(rng: random.Random) -> str:
    """A page of the usual parts in random order and nesting."""
    def words(low: int, high: int) -> str:
        text = " ".join("".join(rng.choice("aeioulnrstd") for _ in range(rng.randint(2, 8)))
                        for _ in range(rng.randint(low, high)))
        return text + rng.choice([".", ".", "", "!", "?"])

    def held(tag: str, names: str, inner: str) -> str:
        name = f' {rng.choice(["class", "id"])}="{names}"' if names else ""
        return f"<{tag}{name}>{inner}</{tag}>"

    def other() -> str:
        tag, names = rng.choice(OTHER)
        kind = rng.random()
        inner = words(1, 8) if kind < 0.3 else "".join(
            f"<li><a href='/x'>{words(1, 2)}</a>" for _ in range(rng.randint(1, 6))) \
            if kind < 0.6 else "".join(f"<p>{words(1, 60)}</p>" for _ in range(rng.randint(1, 3)))
        return held(tag, names, inner)

    body = [f"<h1>{words(2, 9)}</h1>"] + [
        other() if rng.random() < 0.15 else held(rng.choice(["p", "p", "p", "h2", "li", "blockquote"]),
                                                 "", words(1, 90))
        for _ in range(rng.randint(1, 9))]
    parts = [other() for _ in range(rng.randint(0, 3))] + [held(*rng.choice(MAIN), "".join(body))] + [
        other() for _ in range(rng.randint(0, 3))]
    return f"<html><head><title>{words(2, 8)}</title></head><body>{''.join(parts)}</body></html>"


def unmarked_page(rng: random.Random) -> tuple[list[Block], list[int]]:
    """Blocks and labels of a page whose main text no name marks, or one in a misnamed wrapper.

    The labels are those of the same page with its main text in an article, block by block.
    """
    page, tag = "", ""
    while not tag:
        page = laid_out_page(rng)
        tag = "article" if page.count("<article>") == 1 else ""
    gold = [place_label(b) for b in blocks(page)]
    if rng.random() < 0.3:
        around = f'<div class="{rng.choice(WRAPPERS)}">'
        page = page.replace("<body>", f"<body>{around}").replace("</body>", "</div></body>")
    else:
        around = rng.choice(UNMARKED)
        page = page.replace("<article>", around).replace(
            "</article>", around and f"</{around[1:].split()[0].rstrip('>')}>")
    cut = blocks(page)
    return (cut, gold) if len(cut) == len(gold) else unmarked_page(rng)


def fit(pages: list[str], seed: int = 11) -> Crf:
    """A CRF fitted on ``pages`` and on laid out ones.

    Labels come from ``place_label``, but for the pages without marked main text: given ones teach
    nothing, as theirs is not known, and laid out ones (as many again) know theirs.
    """
    rng, model = random.Random(seed), Crf()
    cut = [blocks(p) for p in [*pages, *(laid_out_page(rng) for _ in range(LAID_OUT_PAGES))]]
    known = [(page, [place_label(b) for b in page]) for page in cut]
    known = [(page, gold) for page, gold in known if any(gold)]
    known += [unmarked_page(rng) for _ in range(LAID_OUT_PAGES)]
    for epoch in range(EPOCHS):
        rng.shuffle(known)
        for page, gold in known:
            model.update(page, gold, RATE / (1 + epoch))
    return model


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> Crf:
    """Fit on a bounded sample of the pages (SAMPLE_PAGES ids, a page each); without any, on laid out ones."""
    known = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")) \
        .filter("html IS NOT NULL AND id IS NOT NULL")
    # Ids first: a partition's candidates are numbers, and whole pages leave only the chosen ones.
    chosen = known.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PAGES).collect()
    sample = known.filter(F.col("id").isin([r["id"] for r in chosen])) \
        .groupBy("id").agg(F.min("html").alias("html")).orderBy(F.xxhash64("id"), "id").collect()
    return fit([r["html"] for r in sample])


def main_text(page: str | None, model: Crf) -> str:
    cut = blocks(page)
    return " ".join(b.text for b, label in zip(cut, model.decode(cut)) if label)


def extract(pages: DataFrame, model: Crf, html_col: str = "html",
            text_col: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in ``text_col``.

    The texts of the blocks labelled main, joined by a space in page order; empty where there are
    none, and for null and empty pages. Unclosed elements, stray end tags and broken markup are
    read as far as they go. All rows and other columns stay; a column named ``text_col`` is replaced.
    """
    held = pages.sparkSession.sparkContext.broadcast(model)

    def start():
        known = held.value
        return lambda page: (main_text(page, known),)
    return with_columns(pages, html_col, [T.StructField(text_col, T.StringType())], start)
