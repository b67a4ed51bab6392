"""Main text of web pages by boosted trees over DOM nodes.

A page becomes a tree of block elements with its runs of text as leaves.  Every
node has features: text and tag density of its subtree, share of links, depth,
place and weight among its siblings, and how tags and attribute words on it and
above it have turned out in training.  Gradient-boosted trees score each node;
decoding picks the most likely labels under which a kept node has only kept
ancestors and a kept element has something kept below it.

Training uses a bounded sample of pages (``SAMPLE``).  Text inside ``article`` or
``main`` is content, the rest is not; as real pages vary more than their
semantics, each sampled page is also laid out anew a few times, its blocks in
other containers, with boilerplate of known place, and labelled accordingly.

Inputs and results that need saying: null or empty html, and a page without
kept text, gives the empty string and 0 characters; broken markup is closed as
browsers do for paragraphs and list items, stray ends are ignored, an open script
or comment lasts to the end, an svg that is empty or has no end hides nothing;
equal rows give equal results; without any
``article`` or ``main`` in the sample the layouts alone are learnt from; an empty
table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import html as entities
import pickle
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.texts import hashed_sample, steps

SAMPLE = 200  # pages that training uses, chosen by hash
LAYOUTS = 4  # further layouts of each
TREES, DEPTH, RATE, BINS = 40, 4, 0.25, 24

_WHITE = r"[ \t\n\f\r]"
# The rest of a tag after its name: quotes delimit only what follows an equals sign.
_REST = rf"""(?=[ \t\n\f\r/>])((?:[ \t\n\f\r/]++|[^ \t\n\f\r/>][^ \t\n\f\r/>=]*+(?:{_WHITE}*+={_WHITE}*+(?:"[^"]*"|'[^']*'|[^ \t\n\f\r>"'][^ \t\n\f\r>]*+)?+)?+)*+)>"""
_TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|<(/?)([a-zA-Z][^ \t\n\f\r/>]*+){_REST}", re.S)
_SKIPPED = "script style noscript template title iframe svg textarea select".split()
_ENDS = {name: re.compile(rf"</{name}{_REST}", re.I) for name in _SKIPPED}
_ATTRIBUTE = re.compile(r"\b(class|id|role|data-layout-mark)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var label wbr img br".split()
)
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_LISTS = frozenset("ul ol dl table nav section article div main body".split())


class Page:
    """A parsed page: nodes in page order, parents before children; leaves hold text."""

    def __init__(self, source: str):
        self.parent, self.tag, self.words, self.text, self.linked, self.label = [-1], ["body"], [()], [""], [0], [None]
        stack, run, links, in_link = [0], [], 0, False

        def close_run():
            nonlocal run, links
            text = " ".join("".join(run).split())
            if text:
                self._add(stack[-1], "#text", (), text, min(links, len(text)), None)
            run, links = [], 0

        def pop_to(index):
            close_run()
            del stack[index:]

        at, open_svg = 0, False
        while token := _TOKEN.search(source, at):
            if token.start() > at:
                piece = entities.unescape(source[at : token.start()])
                run.append(piece)
                links += len(piece.strip()) if in_link else 0
            at = token.end()
            if token[2] is None:
                continue
            name, ending = token[2].lower(), bool(token[1])
            if name in _ENDS and not ending:
                if name == "svg" and (open_svg or token[3].endswith("/")):
                    continue
                end = _ENDS[name].search(source, at)
                if end:
                    at = end.end()
                elif name == "svg":
                    open_svg = True
                else:
                    at = len(source)
                continue
            if name in _INLINE:
                if name == "a":
                    in_link = not ending
                elif name == "br":
                    run.append(" ")
                continue
            if name in ("html", "body", "head"):
                close_run()
                continue
            if ending:
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] == name:
                        pop_to(i)
                        break
                else:
                    close_run()
                in_link = False
                continue
            in_link = False
            if self.tag[stack[-1]] == "p":
                pop_to(len(stack) - 1)
            elif name in _CLOSES:
                for i in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[i]] in _CLOSES[name]:
                        pop_to(i)
                        break
                    if self.tag[stack[i]] in _LISTS:
                        break
            close_run()
            if name in _VOID:
                continue
            label, words = None, []
            for found in _ATTRIBUTE.finditer(token[3]):
                value = found[2] or found[3] or found[4] or ""
                if found[1].lower() == "data-layout-mark":
                    label = {"0": 0, "1": 1}.get(value)
                else:
                    words += re.findall(r"[a-z]+", value.lower())
            stack.append(self._add(stack[-1], name, tuple(words), "", 0, label))
        run.append(entities.unescape(source[at:]))
        close_run()

    def _add(self, parent, tag, words, text, linked, label) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.words.append(words)
        self.text.append(text)
        self.linked.append(linked)
        self.label.append(label)
        return len(self.parent) - 1


def node_labels(page: Page) -> np.ndarray:
    """1 for nodes with content below: by the layout's marks, else by what stands in article or main."""
    n, parent = len(page.parent), page.parent
    inside = [0] * n
    marked = any(x is not None for x in page.label)
    for i in range(1, n):
        inside[i] = inside[parent[i]]
        if marked:
            if page.label[i] is not None:
                inside[i] = page.label[i]
        elif page.tag[i] in ("article", "main"):
            inside[i] = 1
        elif page.tag[i] in ("nav", "aside", "footer", "form"):
            inside[i] = 0
    labels = np.zeros(n, dtype=np.int64)
    for i in range(n - 1, 0, -1):
        if page.tag[i] == "#text" and inside[i]:
            labels[i] = 1
        if labels[i]:
            labels[parent[i]] = 1
    return labels


class Meanings:
    """Log odds of content for tags and attribute words, as seen in training."""

    def __init__(self, pages: list[Page], labels: list[np.ndarray]):
        counts: dict[str, list[float]] = {}
        for page, y in zip(pages, labels):
            for i in range(1, len(page.parent)):
                for name in (f"<{page.tag[i]}>", *page.words[i]):
                    counts.setdefault(name, [1.0, 1.0])[y[i]] += 1
        self.odds = {k: float(np.clip(np.log(b / a), -4, 4)) for k, (a, b) in counts.items() if a + b >= 7}

    def of(self, tag: str, words: tuple) -> tuple[float, float]:
        found = [self.odds[w] for w in words if w in self.odds]
        return self.odds.get(f"<{tag}>", 0.0), min(found, key=lambda x: (-abs(x), x)) if found else 0.0


def node_features(page: Page, meanings: Meanings) -> np.ndarray:
    """One row of features for each node."""
    n = len(page.parent)
    parent = np.array(page.parent)
    own = np.array([len(t) for t in page.text], dtype=float)
    chars, links = own.copy(), np.array(page.linked, dtype=float)
    stops = np.array([sum(t.count(c) for c in ".!?;,") for t in page.text], dtype=float)
    nodes, leaves = np.ones(n), (own > 0).astype(float)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        stops[p] += stops[i]
        nodes[p] += nodes[i]
        leaves[p] += leaves[i]
    depth, place, tag, word = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    worst_tag, worst_word, best_tag, best_word = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    children, before = np.zeros(n), np.zeros(n)
    seen = np.zeros(n)
    for i in range(n):
        p = parent[i]
        tag[i], word[i] = meanings.of(page.tag[i], page.words[i]) if i else (0.0, 0.0)
        if i:
            depth[i], place[i], before[i] = depth[p] + 1, children[p], seen[p]
            children[p] += 1
            seen[p] += chars[i]
            worst_tag[i], best_tag[i] = min(worst_tag[p], tag[i]), max(best_tag[p], tag[i])
            worst_word[i], best_word[i] = min(worst_word[p], word[i]), max(best_word[p], word[i])
    up = np.maximum(parent, 0)
    total = max(chars[0], 1.0)
    columns = [
        np.log1p(chars), chars / total, links / np.maximum(chars, 1), chars / nodes, chars / np.maximum(leaves, 1), np.log1p(nodes),
        stops / np.maximum(chars, 1), depth, place, children[up], before / np.maximum(chars[up], 1), chars / np.maximum(chars[up], 1),
        links[up] / np.maximum(chars[up], 1), chars[up] / nodes[up], tag, word, tag[up], word[up], worst_tag, worst_word, best_tag, best_word,
    ]
    return np.stack(columns, axis=1)


class Trees:
    """Gradient-boosted trees of fixed depth on binned features, for the logistic loss."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = self._binned(x)
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score, self.trees = np.full(len(y), self.base), []
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            slope, bend = y - p, p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            feature, cut = np.zeros(2**DEPTH - 1, dtype=np.int64), np.full(2**DEPTH - 1, BINS, dtype=np.int64)
            for level in range(DEPTH):
                width, first = 2**level, 2**level - 1
                gain = np.zeros((width, x.shape[1], BINS))
                for f in range(x.shape[1]):
                    slot = (node - first) * BINS + binned[:, f]
                    g = np.bincount(slot, slope, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    h = np.bincount(slot, bend, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    g0, h0 = g[:, -1:], h[:, -1:]
                    gain[:, f] = g**2 / (h + 1) + (g0 - g) ** 2 / (h0 - h + 1) - g0**2 / (h0 + 1)
                best = gain.reshape(width, -1).argmax(axis=1)
                useful = gain.reshape(width, -1).max(axis=1) > 1e-3
                feature[first : first + width] = np.where(useful, best // BINS, 0)
                cut[first : first + width] = np.where(useful, best % BINS, BINS)
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[node])
            leaf = node - (2**DEPTH - 1)
            value = np.bincount(leaf, slope, 2**DEPTH) / (np.bincount(leaf, bend, 2**DEPTH) + 1)
            score += RATE * value[leaf]
            self.trees.append((feature, cut, RATE * value))

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            total += value[node - (2**DEPTH - 1)]
        return total


def decode(page: Page, logits: np.ndarray) -> np.ndarray:
    """The best labels: kept nodes have kept parents, kept elements something kept below."""
    n, parent = len(page.parent), page.parent
    yes = np.zeros(n)  # gain of keeping a node, its subtree decided best, over dropping all of it
    rest = np.zeros(n)  # what its children add if only those with a gain are kept
    best = np.full(n, -np.inf)
    leaf = np.array([t == "#text" for t in page.tag])
    for i in range(n - 1, -1, -1):
        if leaf[i]:
            yes[i] = logits[i]
        else:
            yes[i] = logits[i] + (rest[i] if rest[i] > 0 else best[i])
        if i:
            p = parent[i]
            rest[p] += max(yes[i], 0)
            best[p] = max(best[p], yes[i])
    kept = np.zeros(n, dtype=bool)
    kept[0] = yes[0] > 0
    for i in range(1, n):
        p = parent[i]
        kept[i] = kept[p] and (yes[i] > 0 or (rest[p] <= 0 and yes[i] == best[p]))
    return kept


_CONTENT = ["article", "main", "div class=content", "div class=post-body", "section class=entry-content", "div id=main-content",
            "div class=article-text", "div class=story", "div role=main", "section", "div"]
_AROUND = ["nav", "nav class=menu", "ul class=menu", "div class=navbar", "header", "header class=site-header", "div id=header",
           "footer", "div class=footer", "aside", "aside class=sidebar", "div class=sidebar", "div class=widget", "div class=ad",
           "div class=advert", "div class=promo", "div class=banner", "div class=cookie-notice", "div class=notice", "div class=consent",
           "form", "form class=search", "form class=newsletter", "section class=comments", "div id=comments", "div class=comment",
           "ol class=comment-list", "div class=related", "div class=share", "div class=breadcrumb", "div class=popup"]


def _element(kind: str, mark: int, inner: str) -> str:
    name, _, attribute = kind.partition(" ")
    if attribute:
        key, _, value = attribute.partition("=")
        attribute = f' {key}="{value}"'
    return f"<{name}{attribute} data-layout-mark={mark}>{inner}</{name}>"


def _layout(blocks: list[tuple[str, str]], strange: list[str], random: np.random.Generator) -> str:
    """The content blocks in a layout of containers, with boilerplate around and between."""

    def boilerplate() -> str:
        kind = _AROUND[random.integers(len(_AROUND))]
        texts = [strange[random.integers(len(strange))] for _ in range(random.integers(1, 6))]
        style = random.integers(4)
        if style == 0 or "menu" in kind or kind == "nav":
            inner = "".join(f'<li><a href="#">{" ".join(t.split()[:3])}</a></li>' for t in texts)
            inner = inner if kind.startswith(("ul", "ol")) else f"<ul>{inner}</ul>"
        elif style == 1:
            inner = "".join(f"<p>{t}</p>" for t in texts)
        elif style == 2:
            inner = "".join(f"<div><p>{t}</p></div>" for t in texts)
        else:
            inner = texts[0]
        return _element(kind, 0, inner)

    parts = []
    for tag, text in blocks:
        parts.append(f"<{tag}>{text}</{tag}>")
        if random.random() < 0.12:
            parts.append(boilerplate())
    content = "".join(parts)
    for _ in range(random.integers(0, 3)):
        content = f"<div>{content}</div>"
    content = _element(_CONTENT[random.integers(len(_CONTENT))], 1, content)
    for _ in range(random.integers(0, 2)):
        content = f"<div>{content}</div>"
    top = "".join(boilerplate() for _ in range(random.integers(1, 4)))
    bottom = "".join(boilerplate() for _ in range(random.integers(1, 5)))
    return f"<html><body>{top}{content}{bottom}</body></html>"


class Extractor:
    """The fitted model."""

    def __init__(self, pages: list[str], layouts: int = LAYOUTS, seed: int = 5):
        random = np.random.default_rng(seed)
        parsed = [Page(p) for p in pages]
        known = [p for p in parsed if any(t in ("article", "main") for t in p.tag)]
        strange = [entities.escape(t) for p in parsed for t in p.text if t] or ["menu", "Some text of a page."]
        made = []
        for page in known or parsed:
            labels = node_labels(page)
            blocks = [
                (tag if (tag := page.tag[page.parent[i]]) in ("h1", "h2", "h3", "li", "blockquote", "pre") else "p", entities.escape(page.text[i]))
                for i in range(len(labels))
                if page.text[i] and (labels[i] or not known)
            ]
            made += [Page(_layout(blocks, strange, random)) for _ in range(layouts) if blocks]
        every = known + made
        labels = [node_labels(p) for p in every]
        self.meanings = Meanings(every, labels)
        self.trees = None
        if every:
            x = np.concatenate([node_features(p, self.meanings) for p in every])
            self.trees = Trees(x, np.concatenate(labels).astype(float))

    def extract(self, sources: list[str]) -> list[str]:
        pages = [Page(s) for s in sources]
        if self.trees is None or not pages:
            return ["" for _ in pages]
        features = [node_features(p, self.meanings) for p in pages]
        logits = self.trees.score(np.concatenate(features))
        out, at = [], 0
        for page in pages:
            n = len(page.parent)
            kept = decode(page, logits[at : at + n])
            at += n
            out.append("\n".join(t for t, k in zip(page.text, kept) if k and t))
        return out


@lru_cache(maxsize=1)
def _extractor(model: bytes) -> Extractor:
    return pickle.loads(model)


def fit(pages: DataFrame, sample: int = SAMPLE, key: str = "page_id", source: str = "html") -> Extractor:
    """The extractor trained on at most ``sample`` pages."""
    filled = pages.where(F.length(source) > 0).select(F.col(key).alias("key"), F.col(source).alias("source"))
    some = hashed_sample(filled, 2 * sample, filled.count(), "key", "source").collect()  # twice the sample, within chance
    some = sorted(some, key=lambda r: zlib.crc32(r["source"].encode()))[:sample]
    return Extractor([r["source"] for r in some])


def extract(pages: DataFrame, model: Extractor, keep: tuple[str, ...] = ("page_id", "url"), source: str = "html") -> DataFrame:
    """The columns ``keep`` with the main text and its number of characters."""
    shared = pages.sparkSession.sparkContext.broadcast(pickle.dumps(model))  # trees and words: their number is fixed
    columns = [f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep]

    def work(batches):
        extractor = _extractor(shared.value)
        for batch in batches:
            for first, sources in steps(batch, source):
                texts = extractor.extract(sources)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(first, len(texts)) for c in keep], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[*keep, "text", "n_chars"],
                )

    return pages.select(*dict.fromkeys([*keep, source])).mapInArrow(work, ", ".join([*columns, "text string", "n_chars bigint"]))
