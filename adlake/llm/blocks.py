"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read as a tree; its leaf blocks are the runs of text that no block-level tag
interrupts. Every block is described by the tags and the words of the class and id
attributes above it and by its text, and a chain of two labels (text, chrome) runs over
the blocks in page order. The weights are learned from labelled pages by the gradient of
the likelihood (forward and backward sums), and the best chain is found by Viterbi.

The labelled pages are made by ``training_pages``: layouts drawn by a seeded rule, in
which every element says whether it is the article's. Pages labelled by hand can be given
instead.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import map_arrow

# Names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var del".split()
)
HIDDEN = frozenset("script style noscript template svg math iframe object canvas select datalist head title textarea button".split())
# Tags that a start tag of a key ends where they are still open.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
CLOSE_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul li".split()
)
# Tags that leave an open head open.
HEAD = frozenset("html head title meta link script style base noscript template".split())
MARK = "data-main"

PAGES, ROUNDS, RATE, DECAY = 600, 120, 0.15, 1e-4
CHROME, TEXT = 0, 1


class Block:
    """A run of text, the names above it, and what part of it is links."""

    __slots__ = ("main", "names", "parts", "linked", "near")

    def __init__(self, names: tuple, near: str, main: bool) -> None:
        self.names, self.near, self.main, self.parts, self.linked = names, near, main, [], 0


# Words of class and id attributes: letters only, so that numbers and separators do not count.
_WORD = re.compile(r"[a-z]+")
_SECTIONS = frozenset("article main section nav header footer aside form body div td".split())


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # (tag, names above and of it, nearest section, links, hidden, marked)
        self.open: list[tuple] = [("", frozenset(), "", 0, 0, False)]
        self.opened: dict[str, int] = {}
        self.blocks: list[Block] = []
        self.current: Block | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in INLINE:
            self.current = None
        if tag in VOID:
            return
        if tag not in HEAD:
            self._end(("head",), ())
        if tag in CLOSE_P:
            self._end(("p",), ("button", "table", "div", "article", "section", "li", "td"))
        if tag in ENDS:
            self._end(ENDS[tag], ("ul", "ol", "dl", "table", "select"))
        _, names, near, links, hidden, marked = self.open[-1]
        given = dict(attrs)
        words = _WORD.findall(f"{given.get('class') or ''} {given.get('id') or ''} {given.get('role') or ''}".lower())
        added = {f"<{tag}>", *(f".{w}" for w in words)}
        if tag in _SECTIONS:
            near = words[0] if words else tag
        if tag not in INLINE:
            names = names | added
        marked = given[MARK] == "1" if MARK in given else marked
        self.opened[tag] = self.opened.get(tag, 0) + 1
        self.open.append((tag, names, near, links + (tag == "a"), hidden + (tag in HIDDEN), marked))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def _cut(self, at: int) -> None:
        for tag, *_ in self.open[at:]:
            self.opened[tag] -= 1
        del self.open[at:]

    def _end(self, tags: tuple, walls: tuple) -> None:
        """Closes the innermost of ``tags`` that no wall encloses, and what is open inside it."""
        if not any(self.opened.get(t) for t in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] in tags:
                self._cut(at)
                return
            if self.open[at][0] in walls:
                return

    def handle_endtag(self, tag: str) -> None:
        # What was never opened ends nothing, but for </p>, which is an empty paragraph.
        if tag not in INLINE and (self.opened.get(tag) or tag in ("p", "br")):
            self.current = None
        if not self.opened.get(tag):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] == tag:
                if tag in INLINE and any(o[0] not in INLINE for o in self.open[at + 1 :]):
                    # Inline markup does not end the blocks that were opened inside it.
                    return
                self._cut(at)
                return

    def handle_data(self, data: str) -> None:
        _, names, near, links, hidden, marked = self.open[-1]
        if hidden:
            return
        if self.current is None or self.current.names != names:
            self.current = Block(names, near, marked)
            self.blocks.append(self.current)
        self.current.parts.append(data)
        if links:
            self.current.linked += len(data.strip())


def read_blocks(html: str | None) -> list[tuple[str, Block]]:
    """(text, block) of every leaf block with text, in page order; white space is one space."""
    reader = _Reader()
    reader.feed(html or "")
    # A tag or comment that the page ends in is no text.
    if not re.match(r"<[a-zA-Z/!?]", reader.rawdata):
        reader.close()
    texts = ((" ".join("".join(b.parts).split()), b) for b in reader.blocks)
    return [(text, block) for text, block in texts if text]


def features(blocks: Sequence[tuple[str, Block]]) -> list[list[str]]:
    out = []
    for at, (text, block) in enumerate(blocks):
        words = text.count(" ") + 1
        linked = block.linked / len(text)
        found = [
            "any",
            f"in:{block.near}",
            f"words:{min(words, 64).bit_length()}",
            f"linked:{0 if linked == 0 else 1 if linked < 0.5 else 2}",
            f"ends:{text[-1] if text[-1] in '.!?:…|©' else 'other'}",
        ]
        if "©" in text:
            found.append("copyright")
        if at == 0:
            found.append("first")
        if at == len(blocks) - 1:
            found.append("last")
        out.append(found + sorted(block.names))
    return out


# --- labelled pages -------------------------------------------------------------------

_ARTICLE = ("content", "post", "entry", "story", "text", "article-body", "post-content", "entry-content", "page-content")
_CHROME = {
    "nav": ("menu", "navigation", "navbar", "breadcrumb", "breadcrumbs", "pagination", "topnav", "nav"),
    "header": ("header", "site-header", "masthead", "branding", "top"),
    "footer": ("footer", "site-footer", "legal", "copyright", "bottom", "colophon"),
    "aside": ("sidebar", "widget", "related", "recommended", "popular", "trending", "aside", "more"),
    "ad": ("ad", "ads", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion"),
    "notice": ("notice", "cookie", "cookies", "consent", "gdpr", "alert", "disclaimer", "popup", "modal", "newsletter", "subscribe"),
    "form": ("form", "search", "login", "signup", "contact"),
    "comments": ("comments", "comment", "replies", "discussion", "respond", "disqus", "reader-comments"),
    "social": ("share", "social", "sharing", "follow", "tags", "meta", "byline"),
}
_OWN_TAG = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}


class _Maker:
    """One page of a drawn layout, with its article marked."""

    def __init__(self, rng: random.Random) -> None:
        self.rng = rng
        self.syllables = ["".join(rng.choice("bdfghklmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 2))) for _ in range(40)]

    def words(self, low: int, high: int) -> str:
        n = self.rng.randint(low, high)
        return " ".join("".join(self.rng.choices(self.syllables, k=self.rng.randint(1, 3))) for _ in range(n))

    def sentence(self, low: int = 1, high: int = 30) -> str:
        stop = self.rng.choices((".", "!", "?", ":", "", " |"), (60, 5, 5, 3, 15, 12))[0]
        return self.words(low, high).capitalize() + stop

    def prose(self) -> str:
        most = self.rng.choice((1, 1, 2, 4, 8))
        return " ".join(self.sentence() for _ in range(self.rng.randint(1, most)))

    def links(self) -> str:
        n = self.rng.randint(1, 7)
        if self.rng.random() < 0.6:
            return "<ul>" + "".join(f'<li><a href="/x">{self.words(1, 4)}</a></li>' for _ in range(n)) + "</ul>"
        return " | ".join(f'<a href="/x">{self.words(1, 3)}</a>' for _ in range(n))

    def chrome(self, kind: str) -> str:
        rng = self.rng
        name = rng.choice(_CHROME[kind])
        tag = _OWN_TAG.get(kind, "div")
        if rng.random() < 0.45:
            tag = "div"
        given = f' {rng.choice(("class", "id"))}="{name}"' if tag in ("div", "section") or rng.random() < 0.4 else ""
        body = {
            "nav": self.links,
            "header": lambda: rng.choice((self.links(), f"<h2>{self.words(1, 4)}</h2>", self.sentence(1, 9))),
            "footer": lambda: f"&copy; {self.words(1, 3)} &middot; {self.prose()}",
            "aside": lambda: f"<h3>{self.words(1, 3)}</h3>" + rng.choice((self.links(), f"<p>{self.prose()}</p>")),
            "ad": lambda: rng.choice((self.prose(), f"<p>{self.prose()}</p>", f'<a href="/x">{self.sentence()}</a>')),
            "notice": lambda: rng.choice((self.prose(), f"<p>{self.prose()}</p>")) + f"<button>{self.words(1, 2)}</button>",
            "form": lambda: f"<label>{self.words(1, 3)}</label><input type=text><p>{self.sentence(1, 8)}</p>",
            "comments": lambda: f"<h3>{self.words(1, 2)}</h3>" + "".join(
                f'<div class="{rng.choice(("comment", "reply", "body"))}"><p>{self.prose()}</p></div>' for _ in range(rng.randint(1, 4))
            ),
            "social": lambda: rng.choice((self.links(), self.words(1, 5))),
        }[kind]()
        return f'<{tag}{given} {MARK}="0">{body}</{tag}>'

    def paragraph(self) -> str:
        rng, text = self.rng, self.prose()
        roll = rng.random()
        if roll < 0.06:
            return f"<h2>{self.words(1, 8)}</h2>"
        if roll < 0.12:
            return "<ul>" + "".join(f"<li>{self.sentence()}</li>" for _ in range(rng.randint(1, 5))) + "</ul>"
        if roll < 0.16:
            return f"<blockquote>{text}</blockquote>"
        if roll < 0.19:
            return f"<pre>{text}</pre>"
        if roll < 0.22:
            return f"<table><tr><td>{self.words(1, 4)}<td>{self.words(1, 4)}</table>"
        if roll < 0.32:
            text = f"{text} <a href='/x'>{self.words(1, 4)}</a> {self.sentence()}"
        if roll < 0.4:
            text = f"<b>{text}"
            return f"<p>{text}<br>"
        return f"<p>{text}</p>" if rng.random() < 0.85 else f"<p>{text}"

    def article(self) -> str:
        rng = self.rng
        parts = [self.paragraph() for _ in range(rng.randint(1, 12))]
        title = self.words(1, 12)
        head = f"<h1>{title}</h1>"
        roll = rng.random()
        if roll < 0.15:
            head = f"<header>{head}</header>"
        elif roll < 0.35:
            head = ""
        for kind in ("ad", "aside", "form", "social", "notice", "nav"):
            if rng.random() < 0.08:
                parts.insert(rng.randint(0, len(parts)), self.chrome(kind))
        if rng.random() < 0.1:
            parts.append(self.chrome("comments"))
        name = rng.choice(_ARTICLE)
        tag, given = rng.choices(
            (("article", ""), ("article", f' class="{name}"'), ("main", ""), ("div", f' class="{name}"'), ("div", f' id="{name}"'), ("section", f' class="{name}"')),
            (40, 15, 10, 15, 10, 10),
        )[0]
        out = f'<{tag}{given} {MARK}="1">{head}{"".join(parts)}</{tag}>'
        if rng.random() < 0.2 and tag != "main":
            out = f"<main>{out}</main>"
        return out

    def page(self) -> str:
        rng = self.rng
        before = [k for k in ("header", "nav", "notice", "ad", "form", "social") if rng.random() < 0.4]
        after = [k for k in ("aside", "comments", "ad", "social", "nav", "footer", "notice") if rng.random() < 0.4]
        if rng.random() < 0.15:
            before, after = [], []
        rng.shuffle(before)
        body = "".join(map(self.chrome, before)) + self.article() + "".join(map(self.chrome, after))
        if rng.random() < 0.3:
            body = f'<div class="{rng.choice(("wrapper", "container", "page", "layout"))}">{body}</div>'
        return f"<html><head><title>{self.words(1, 6)}</title></head><body>{body}</body></html>"


def training_pages(n: int = PAGES, seed: int = 42) -> list[str]:
    """Pages whose elements carry ``data-main`` (1 the article, 0 what is not of it)."""
    rng = random.Random(seed)
    return [_Maker(rng).page() for _ in range(n)]


# --- the field ------------------------------------------------------------------------


class Field:
    """Weights per feature and label, between neighbouring labels, and of the first label."""

    def __init__(self, index: dict[str, int], emit: np.ndarray, step: np.ndarray, first: np.ndarray) -> None:
        self.index, self.emit, self.step, self.first = index, emit, step, first

    def scores(self, described: list[list[str]]) -> np.ndarray:
        """(blocks, labels); names that were not learned count nothing."""
        out = np.zeros((len(described), 2))
        for at, names in enumerate(described):
            known = [self.index[n] for n in names if n in self.index]
            out[at] = self.emit[known].sum(axis=0)
        return out

    def decode(self, described: list[list[str]]) -> np.ndarray:
        """The likeliest labels (Viterbi); ties go to chrome."""
        scores = self.scores(described)
        n = len(scores)
        if not n:
            return np.zeros(0, int)
        best, back = self.first + scores[0], np.zeros((n, 2), int)
        for at in range(1, n):
            ways = best[:, None] + self.step
            back[at] = ways.argmax(axis=0)
            best = ways.max(axis=0) + scores[at]
        labels = np.zeros(n, int)
        labels[-1] = int(best.argmax())
        for at in range(n - 1, 0, -1):
            labels[at - 1] = back[at, labels[at]]
        return labels


def likelihood(scores: np.ndarray, labels: np.ndarray, mask: np.ndarray, step: np.ndarray, first: np.ndarray):
    """Log-likelihood of padded chains, and its gradient by scores, steps and first labels.

    ``scores`` is (pages, blocks, 2); ``labels`` and ``mask`` are (pages, blocks).
    """
    pages, longest, _ = scores.shape
    rows = np.arange(pages)
    alpha = np.zeros_like(scores)
    alpha[:, 0] = first + scores[:, 0]
    for t in range(1, longest):
        ways = np.logaddexp(alpha[:, t - 1, 0, None] + step[0], alpha[:, t - 1, 1, None] + step[1])
        alpha[:, t] = np.where(mask[:, t, None], ways + scores[:, t], alpha[:, t - 1])
    total = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    beta = np.zeros_like(scores)
    for t in range(longest - 2, -1, -1):
        ahead = scores[:, t + 1] + beta[:, t + 1]
        ways = np.logaddexp(step[:, 0] + ahead[:, :1], step[:, 1] + ahead[:, 1:])
        beta[:, t] = np.where(mask[:, t + 1, None], ways, beta[:, t + 1])
    shown = np.eye(2)[labels] * mask[..., None]
    by_score = shown - np.exp(alpha + beta - total[:, None, None]) * mask[..., None]
    both = mask[:, 1:] & mask[:, :-1]
    pairs = alpha[:, :-1, :, None] + step + (scores + beta)[:, 1:, None, :] - total[:, None, None, None]
    by_step = -(np.exp(pairs) * both[..., None, None]).sum(axis=(0, 1))
    np.add.at(by_step, (labels[:, :-1][both], labels[:, 1:][both]), 1.0)
    value = (scores * shown).sum() + first[labels[:, 0]].sum() - total.sum()
    value += step[labels[:, :-1][both], labels[:, 1:][both]].sum()
    by_first = shown[rows, 0] - np.exp(alpha[:, 0] + beta[:, 0] - total[:, None])
    return value, by_score, by_step, by_first.sum(axis=0)


def fit(pages: Sequence[str], rounds: int = ROUNDS) -> Field:
    """The field of labelled pages (see ``training_pages``); names seen on one page only are left out."""
    read = [read_blocks(p) for p in pages]
    read = [blocks for blocks in read if blocks]
    described = [features(blocks) for blocks in read]
    seen: dict[str, int] = {}
    for page in described:
        for name in {n for names in page for n in names}:
            seen[name] = seen.get(name, 0) + 1
    index = {name: i for i, name in enumerate(sorted(n for n, times in seen.items() if times > 1))}
    longest = max(map(len, read))
    labels = np.zeros((len(read), longest), int)
    mask = np.zeros((len(read), longest), bool)
    place, name_of = [], []
    for p, (blocks, names) in enumerate(zip(read, described)):
        mask[p, : len(blocks)] = True
        labels[p, : len(blocks)] = [TEXT if b.main else CHROME for _, b in blocks]
        for t, found in enumerate(names):
            for n in found:
                if n in index:
                    place.append(p * longest + t)
                    name_of.append(index[n])
    place, name_of = np.array(place), np.array(name_of)
    weights = [np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)]
    means, squares = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for number in range(1, rounds + 1):
        summed = [np.bincount(place, weights[0][name_of, label], len(read) * longest) for label in (CHROME, TEXT)]
        scores = np.stack(summed, axis=1).reshape(len(read), longest, 2)
        _, by_score, by_step, by_first = likelihood(scores, labels, mask, weights[1], weights[2])
        shares = by_score.reshape(-1, 2)[place]
        by_emit = np.stack([np.bincount(name_of, shares[:, label], len(index)) for label in (CHROME, TEXT)], axis=1)
        for i, gradient in enumerate((by_emit, by_step, by_first)):
            gradient = gradient / len(read) - DECAY * weights[i]
            means[i] = 0.9 * means[i] + 0.1 * gradient
            squares[i] = 0.99 * squares[i] + 0.01 * gradient**2
            rise = means[i] / (1 - 0.9**number)
            weights[i] = weights[i] + RATE * rise / (np.sqrt(squares[i] / (1 - 0.99**number)) + 1e-8)
    return Field(index, *weights)


@lru_cache(maxsize=1)
def default_field() -> Field:
    """The field of the default training pages: always the same, as these are."""
    return fit(training_pages())


def main_text(html: str | None, field: Field) -> str:
    blocks = read_blocks(html)
    labels = field.decode(features(blocks))
    return " ".join(text for (text, _), label in zip(blocks, labels) if label == TEXT)


def _extracted(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), field) for html in batch.column("html")]
            rest = [c for c in batch.schema.names if c != "html"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(texts, pa.string())], [*rest, "text"]
            )

    return run


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row of ``pages``, whole.

    Character references are decoded, white space inside a block becomes one space, blocks
    are joined by one space. Null and empty pages, and pages without text, give an empty
    text; plain text without markup is one block. Broken markup is read as far as it goes.
    Repeated rows give repeated results, null ids and urls stay; other columns are left
    out. Empty input, empty result.
    """
    field = field or default_field()
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    found = map_arrow(pages.select("page_id", "url", "html"), _extracted(field), f"{schema}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
