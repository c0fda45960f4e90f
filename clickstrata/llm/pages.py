"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A page is cut into blocks, the runs of text between the tags of block elements.
A block is seen as the hashed names on its tag path (elements with their class,
id and role words), its hashed words and a few numbers (length, share of links,
place). The network reads all blocks of a page in both directions and decides
for each one whether it is part of the article. Nothing else decides; what is never shown
as text (scripts, styles, the title, form controls) is no block.

It is fitted on a bounded sample: ``SAMPLE_PAGES`` pages of at most ``SAMPLE_CHARS`` characters, in
the order of a hash. Where such a page says itself what its article is
(``article`` or ``main``, without the navigation, forms and the like in it), its blocks are
labelled so. The text of these blocks is also dressed in other layouts, with the menus,
notices, sidebars and comments of ``BOILERPLATE`` around and within it, so that
the network does not depend on one site's markup. The fit is repeatable.

White space in a block becomes one space, blocks are trimmed and joined by a blank line. A
null or empty page has no text. Every row gives one row, in an empty table none.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

SAMPLE_PAGES = 300
SAMPLE_CHARS = 20_000
DRESSED = 600
EPOCHS = 8
BATCH = 32
RATE = 0.01
NAMES, NAME_SIZE = 1024, 16
TERMS, TERM_SIZE = 512, 8
NUMBERS = 4
HIDDEN = 16
INPUT = NAME_SIZE + TERM_SIZE + NUMBERS
CELLS = 50_000  # blocks of a batch, with padding
PATH_ENDS = 8  # elements seen from either end of a long path

# Fixed values of HTML: elements within a line of text, without an end tag, and without text to be read.
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_ELEMENTS = set("audio button canvas iframe noscript object script select style svg template textarea title video".split())
CLOSED_BY_BLOCK = {"p"}
CLOSED_BY_SAME = set("li dt dd tr td th option p".split())
ARTICLE = {"article", "main"}
NOT_ARTICLE = set("nav aside footer form".split())

BOILERPLATE = {
    "menu": (["nav", "div.menu", "ul.nav", "div#navigation", "div@navigation", "div.navbar", "div.breadcrumb", "ul.menu-items", "div.topnav"], ["Home", "About us", "Contact", "News", "Products", "Login", "Next", "Archive"]),
    "header": (["header", "div.header", "div#masthead", "div@banner", "div.site-header", "div.top-bar"], ["Welcome to our site", "The Daily Example", "Sign in or register", "Search this site"]),
    "footer": (["footer", "div.footer", "div#footer", "div.copyright", "div@contentinfo", "div.site-footer", "div.legal"], ["© 2020 Example. All rights reserved.", "Privacy policy · Terms of use", "Imprint"]),
    "sidebar": (["aside", "div.sidebar", "div.related", "div.widget", "div@complementary", "div#sidebar", "section.recommended", "div.side-bar", "div.share"], ["Most read", "Related stories", "You may also like", "Share this", "Tags"]),
    "notice": (["div.cookie", "div.notice", "div.alert", "div.consent", "div@alert", "div.cookie-banner", "div#gdpr", "div.popup", "div.notification", "div.modal", "div@dialog"], ["We use cookies to improve your visit. Accept all.", "This site needs JavaScript.", "Your session has expired."]),
    "advert": (["div.ad", "div.ads", "div.advert", "div.sponsored", "div.promo", "aside.ad", "div#ad", "div.advertisement", "div.ad-slot", "div.banner"], ["Advertisement", "Buy now and save half", "Sponsored content"]),
    "form": (["form", "div.newsletter", "div.subscribe", "form.search", "div.signup", "form.login", "fieldset"], ["Your name", "Enter your email to subscribe", "Send", "Search"]),
    "comments": (["section.comments", "div#comments", "ol.comment-list", "div.comment", "div.comments", "div.replies", "section#comments", "div.comment-body", "section.responses", "div.discussion"], ["3 comments", "Reply", "Anna says: I agree with this.", "Great article, thank you!"]),
}
MAIN = ["article", "main", "div.content", "div.article", "div.post", "section.entry", "div@main", "div.story", "div#main", "div#content", "div.article-body", "div.entry-content", "article.post", "main#content", "div.text", "section", "div", ""]
_NAME_WORDS = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    text: str
    names: tuple[int, ...]
    linked: int  # characters inside of links
    article: bool  # whether the page itself says so


@lru_cache(1 << 16)
def _name(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % NAMES


@lru_cache(1 << 14)
def _element(tag: str, attributes: str) -> tuple[int, ...]:
    return (_name(tag), *(_name(f".{w}") for w in dict.fromkeys(_NAME_WORDS.findall(attributes.lower()))))


class Blocks(HTMLParser):
    """The blocks of one page."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, tuple[int, ...]]] = []
        self.open: Counter[str] = Counter()
        self.kinds: Counter[str] = Counter()
        self.pieces: list[str] = []
        self.linked = 0
        self.feed(page)
        self.close()
        self._end_block()

    def _end_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            path = self.stack if len(self.stack) <= 2 * PATH_ENDS else self.stack[:PATH_ENDS] + self.stack[-PATH_ENDS:]
            last = next((tag for tag, _ in reversed(path) if tag not in INLINE), "")
            names = [n for _, own in path for n in own]
            article = any(self.open[t] for t in ARTICLE) and not any(self.open[t] for t in NOT_ARTICLE)
            self.blocks.append(Block(text, (*dict.fromkeys(names), _name(f">{last}")), min(self.linked, len(text)), article))
        self.pieces, self.linked = [], 0

    def _pop(self) -> str:
        tag = self.stack.pop()[0]
        self.open[tag] -= 1
        return tag

    def _close(self, tag: str) -> None:
        if self.open[tag]:
            while self._pop() != tag:
                pass

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.pieces.append(" ")
        if tag not in INLINE:
            self._end_block()
            while self.stack and (self.stack[-1][0] in CLOSED_BY_BLOCK or self.stack[-1][0] == tag in CLOSED_BY_SAME or self.stack[-1][0] in INLINE and self.open["p"]):
                self._pop()
        if tag not in VOID:
            self.stack.append((tag, _element(tag, " ".join(v for k, v in attrs if v and k in ("class", "id", "role")))))
            self.open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML, but for drawings
        if tag in HIDDEN_ELEMENTS:
            self._close(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._end_block()
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if not any(self.open[t] for t in HIDDEN_ELEMENTS if t in self.open):
            self.pieces.append(data)
            if self.open["a"]:
                self.linked += len(data.strip())


def blocks_of(page: str | None) -> list[Block]:
    return Blocks(page).blocks if page else []


@dataclass
class Seen:
    """What the network sees of a run of blocks: names and words with where each block's begin, and numbers."""

    names: np.ndarray
    first_name: np.ndarray
    terms: np.ndarray
    first_term: np.ndarray
    numbers: np.ndarray


def see(pages: list[list[Block]]) -> Seen:
    blocks = [b for page in pages for b in page]
    found = W.words_of(pa.array([b.text for b in blocks], pa.string()), W.ALPHANUMERIC)
    names = [b.names for b in blocks]
    place = np.concatenate([np.arange(len(p)) / max(1, len(p) - 1) for p in pages]) if pages else np.empty(0)
    chars = np.array([len(b.text) for b in blocks], float)
    linked = np.array([b.linked for b in blocks], float)
    numbers = np.stack([np.log1p(chars) / 5, linked / np.maximum(chars, 1), place, np.ones(len(blocks))], 1)
    flat = np.array([n for own in names for n in own], np.int64)
    return Seen(flat, np.cumsum([0, *map(len, names)]), (found.hashes % np.uint64(TERMS)).astype(np.int64), found.first, numbers)


def _sums(table: np.ndarray, values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros((len(first) - 1, table.shape[1]))
    some = np.flatnonzero(np.diff(first))
    if len(some):
        out[some] = np.add.reduceat(table[values], first[some])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, seed: int) -> Network:
        r = np.random.default_rng(seed)
        shapes = {"names": (NAMES, NAME_SIZE), "terms": (TERMS, TERM_SIZE), "out": (2 * HIDDEN + 1, 1)}
        shapes |= {w: (INPUT + HIDDEN, 4 * HIDDEN) for w in ("ahead", "back")}
        weights = {k: r.normal(0, 0.2, s) for k, s in shapes.items()}
        for w in ("ahead", "back"):
            weights[f"{w}_bias"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return cls(weights)

    def inputs(self, seen: Seen) -> np.ndarray:
        words = _sums(self.weights["terms"], seen.terms, seen.first_term) / np.maximum(np.diff(seen.first_term), 1)[:, None]
        return np.concatenate([_sums(self.weights["names"], seen.names, seen.first_name), words, seen.numbers], 1)

    def _read(self, x: np.ndarray, mask: np.ndarray, which: str, keep: bool = False) -> tuple[np.ndarray, list]:
        """States after each block, in the given direction; ``x`` is blocks x pages x inputs."""
        w, bias = self.weights[which], self.weights[f"{which}_bias"]
        h = c = np.zeros((x.shape[1], HIDDEN))
        out, kept = np.empty((*x.shape[:2], HIDDEN)), []
        steps = range(len(x)) if which == "ahead" else range(len(x) - 1, -1, -1)
        given = x @ w[:INPUT] + bias
        for t in steps:
            z = given[t] + h @ w[INPUT:]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g, m = np.tanh(z[:, 3 * HIDDEN :]), mask[t][:, None]
            new_c = (f * c + i * g) * m
            squashed = np.tanh(new_c)
            if keep:
                kept.append((t, h, c, i, f, o, g, squashed, m))
            h, c = o * squashed * m, new_c
            out[t] = h
        return out, kept

    def _unread(self, x: np.ndarray, d_out: np.ndarray, kept: list, which: str, grads: dict) -> np.ndarray:
        """Gradients of what ``_read`` did; returns that of its input."""
        w = self.weights[which]
        d_x = np.empty_like(x)
        d_w, d_b = np.zeros_like(w), np.zeros(4 * HIDDEN)
        d_h = d_c = np.zeros(d_out.shape[1:])
        for t, h, c, i, f, o, g, squashed, m in reversed(kept):
            d_h = (d_h + d_out[t]) * m
            d_state = (d_c + d_h * o * (1 - squashed**2)) * m
            d_z = np.concatenate([d_state * g * i * (1 - i), d_state * c * f * (1 - f), d_h * squashed * o * (1 - o), d_state * i * (1 - g**2)], 1)
            d_w += np.concatenate([x[t], h], 1).T @ d_z
            d_b += d_z.sum(0)
            back = d_z @ w.T
            d_x[t], d_h, d_c = back[:, :INPUT], back[:, INPUT:], d_state * f
        grads[which], grads[f"{which}_bias"] = d_w, d_b
        return d_x

    def scores(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Probability of each block of each page to be of the article."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            stop = at + 1
            while stop < len(order) and (stop + 1 - at) * len(pages[order[stop]]) <= CELLS:
                stop += 1
            group = [pages[k] for k in order[at:stop]]
            x, mask, _ = self._padded(group, self.inputs(see(group)))
            states = np.concatenate([self._read(x, mask, "ahead")[0], self._read(x, mask, "back")[0], mask[..., None]], 2)
            p = _sigmoid(states @ self.weights["out"])[..., 0]
            for column, k in enumerate(order[at:stop]):
                out[k] = p[: len(pages[k]), column]
            at = stop
        return out

    @staticmethod
    def _padded(group: list[list[Block]], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
        sizes = np.array([len(p) for p in group])
        column = np.repeat(np.arange(len(group)), sizes)
        row = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        x, mask = np.zeros((sizes.max(), len(group), flat.shape[1])), np.zeros((sizes.max(), len(group)))
        x[row, column], mask[row, column] = flat, 1
        return x, mask, (row, column)

    def gradients(self, group: list[list[Block]], labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss and its gradients; ``labels`` are those of all blocks, end to end."""
        seen = see(group)
        x, mask, cells = self._padded(group, self.inputs(seen))
        ahead, kept_ahead = self._read(x, mask, "ahead", keep=True)
        back, kept_back = self._read(x, mask, "back", keep=True)
        states = np.concatenate([ahead, back, mask[..., None]], 2)
        p = _sigmoid(states @ self.weights["out"])[..., 0]
        wanted = np.zeros_like(p)
        wanted[cells] = labels
        d = (p - wanted) * mask / mask.sum()
        loss = -float(np.log(np.where(labels > 0, p[cells], 1 - p[cells]) + 1e-12).mean())
        grads = {"out": (states * d[..., None]).sum((0, 1))[:, None]}
        d_states = d[..., None] * self.weights["out"][:, 0]
        d_x = self._unread(x, d_states[..., :HIDDEN], kept_ahead, "ahead", grads)
        d_x += self._unread(x, d_states[..., HIDDEN : 2 * HIDDEN], kept_back, "back", grads)
        flat = d_x[cells]
        grads["names"], grads["terms"] = np.zeros((NAMES, NAME_SIZE)), np.zeros((TERMS, TERM_SIZE))
        np.add.at(grads["names"], seen.names, np.repeat(flat[:, :NAME_SIZE], np.diff(seen.first_name), 0))
        n_terms = np.diff(seen.first_term)
        each = flat[:, NAME_SIZE : NAME_SIZE + TERM_SIZE] / np.maximum(n_terms, 1)[:, None]
        np.add.at(grads["terms"], seen.terms, np.repeat(each, n_terms, 0))
        return loss, grads


def train(examples: list[tuple[list[Block], list[bool]]], *, epochs: int = EPOCHS, seed: int = 1) -> Network:
    """Adam over shuffled batches of pages of similar length."""
    network, r = Network.new(seed), random.Random(seed)
    examples = sorted((e for e in examples if e[0]), key=lambda e: len(e[0]))
    batches = [examples[k : k + BATCH] for k in range(0, len(examples), BATCH)]
    mean = {k: np.zeros_like(w) for k, w in network.weights.items()}
    square = {k: np.zeros_like(w) for k, w in network.weights.items()}
    step = 0
    for epoch in range(epochs):
        r.shuffle(batches)
        for batch in batches:
            step += 1
            _, grads = network.gradients([p for p, _ in batch], np.array([x for _, own in batch for x in own], float))
            for k, g in grads.items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                rate = RATE * (0.2 if epoch >= epochs - 2 else 1)
                network.weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return network


def _open(element: str) -> tuple[str, str]:
    if not element:
        return "", ""
    tag, mark, value = re.fullmatch(r"(\w+)([.#@]?)(.*)", element).groups()
    attribute = {".": "class", "#": "id", "@": "role", "": ""}[mark]
    return (f'<{tag} {attribute}="{value}">' if attribute else f"<{tag}>"), f"</{tag}>"


def dress(paragraphs: Sequence[str], r: random.Random) -> str:
    """A page around the paragraphs in a random layout; texts of its article begin with ``+``, others with ``-``."""
    escape = lambda t: t.replace("&", "&amp;").replace("<", "&lt;")

    def text(own: Sequence[str]) -> str:
        if paragraphs and r.random() < 0.6:  # boilerplate may read like anything
            words = r.choice(paragraphs).split()
            at = r.randrange(max(1, len(words)))
            return escape(" ".join(words[at : at + r.randint(1, 14)])) or r.choice(own)
        return r.choice(own)

    def other(kind: str) -> str:
        elements, own = BOILERPLATE[kind]
        start, end = _open(r.choice(elements))
        n = r.randint(1, 6)
        form = r.choice(["<li><a href='#'>-{}</a></li>", "<a href='#'>-{}</a>"] if kind == "menu" else ["<p>-{}</p>", "<div>-{}</div>", "-{}<br>", "<li>-{}</li>", "<h3>-{}</h3>"])
        return start + "\n".join(form.format(text(own)) for _ in range(n if kind in ("menu", "comments", "sidebar") else 1 + n // 4)) + end

    start, end = _open(r.choice(MAIN))
    shown = []
    for k, p in enumerate(paragraphs):
        p = "+" + escape(p)
        element = ("header.entry-header" if r.random() < 0.1 and start.startswith("<article") else "h1") if k == 0 and r.random() < 0.7 else r.choice(["p"] * 8 + ["li", "blockquote", "h2", "div", "td"])
        if element.startswith("header"):
            p = f"<h1>{p}</h1>"
        a, b = _open(element)
        shown.append(a + (f"<b>{p}</b>" if r.random() < 0.1 else p) + b)
        if r.random() < 0.06:
            shown.append(other(r.choice(["advert", "sidebar", "form", "notice"])))
    if r.random() < 0.15:
        shown.append(other("comments"))
    before = "".join(other(k) for k in ("notice", "header", "menu", "advert", "sidebar") if r.random() < 0.5)
    after = "".join(other(k) for k in ("comments", "sidebar", "advert", "form", "menu", "footer") if r.random() < 0.5)
    return f"<html><body>{before}{start}{''.join(shown)}{end}{after}</body></html>"


def examples(pages: list[list[Block]], dressed: int = DRESSED, seed: int = 2) -> list[tuple[list[Block], list[bool]]]:
    """Labelled pages: those that mark their article themselves, and the same texts in other layouts."""
    r = random.Random(seed)
    marked = [(page, [b.article for b in page]) for page in pages if any(b.article for b in page)]
    texts = [[b.text for b in page if b.article] for page, _ in marked] or [[b.text for b in page if len(b.text) > 80] for page in pages]
    texts = [own[:12] for own in texts if own] or [["A paragraph of plain text without anything around it."]]
    for _ in range(dressed):
        own = r.choice(texts)
        page = blocks_of(dress(own[: r.randint(1, 12)], r))
        labels = [b.text.startswith("+") for b in page]
        for b in page:
            b.text = b.text.lstrip("+-") or b.text
        marked.append((page, labels))
    return marked


def fit(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS) -> Network:
    """Trained on at most ``sample_pages`` pages of at most ``sample_chars`` characters."""
    fitting = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).where(F.length("html").between(1, sample_chars))
    rows = fitting.orderBy(F.xxhash64("id"), "id", F.xxhash64("html")).limit(sample_pages).collect()
    return train(examples([blocks_of(row["html"]) for row in rows]))


def extract(pages: DataFrame, *, network: Network | None = None, carry: Sequence[str] = ("page_id", "url"), html_col: str = "html", **options) -> DataFrame:
    """(carried, text, n_blocks, n_kept) per page row; ``carried`` holds the columns named in ``carry``."""
    network = network or fit(pages, html_col=html_col, **options)
    rows = pages.select(F.struct(*carry).alias("carried"), F.col(html_col).alias("html"))
    sent = pages.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.slices(batches, "html"):
            found = [blocks_of(page) for page in part.column("html").to_pylist()]
            kept = [[b.text for b, p in zip(own, scores, strict=True) if p >= 0.5] for own, scores in zip(found, sent.value.scores(found), strict=True)]
            counts = [pa.array([len(own) for own in x], pa.int64()) for x in (found, kept)]
            yield pa.RecordBatch.from_arrays([part.column("carried"), pa.array(["\n\n".join(own) for own in kept], pa.string()), *counts], ["carried", "text", "n_blocks", "n_kept"])

    return rows.mapInArrow(run, f"carried {rows.schema['carried'].dataType.simpleString()}, text string, n_blocks long, n_kept long")
