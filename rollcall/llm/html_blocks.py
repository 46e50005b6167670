"""Main-text extraction by a recurrent block labeller (operator 1).

A page becomes its sequence of leaf blocks. A block is described by its tag path
(tags and words of class and id, hashed), its words (hashed) and a few figures.
A bidirectional LSTM in numpy reads the whole sequence, so that each block is
classified in the context of the document, and the blocks it calls article text
are joined.

The labeller is trained here: the blocks of a bounded sample of pages
(``TRAINING_PAGES``) are put into pages of many layouts, whose labels are known.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import sampled_texts

TRAINING_PAGES = 120
LAYOUTS = 1600  # pages made up from them
TAGS, WORDS, FIGURES = 1024, 64, 8
HIDDEN = 16
EPOCHS = 16
BATCH = 64
SEED = 5

# Elements that begin and end blocks, elements without content, elements whose content is no text, elements
# whose content stands in for something not shown, and what neither a button nor a list of choices can hold.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_CONTENT = frozenset(
    "script style template svg iframe select button textarea option datalist title annotation annotation-xml".split()
)
FALLBACKS = frozenset("noscript object canvas audio video".split())
CHOICES = frozenset("select button option datalist".split())
ENDS_CHOICES = frozenset(
    "article aside blockquote footer form h1 h2 h3 h4 h5 h6 header main nav ol p pre section table ul".split()
)
RAW = frozenset("script style textarea title iframe".split())

# By the rules of HTML: a quote opens a string only as the first character of a value, elsewhere it is a character like others.
_NAMED = r"""[^\s/>][^\s/>=]*+"""
_VALUE = r"""\s*+=\s*+(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*+|(?=>))"""
_TAG = re.compile(rf"""<!--(?:-?>|.*?(?:--!?>|$))|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|{_NAMED}(?:{_VALUE})?+)*+)(>|$)""", re.DOTALL)
_ATTRIBUTE = re.compile(rf"""({_NAMED})((?:{_VALUE})?+)""")
_PATH_ATTRIBUTES = frozenset(("class", "id", "role", "hidden", "style"))
_NAME = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: float  # share of its characters that stand in links


def _names(tag: str, attributes: str) -> tuple[str, ...]:
    """What a tag says on the path: its name and the words of class, id and role."""
    words = [tag]
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip().removeprefix("=").strip().strip("\"'").lower()
        if key not in _PATH_ATTRIBUTES:
            continue
        if key == "hidden" or (key == "style" and "display:none" in value.replace(" ", "")):
            words.append("@hidden")
        elif key != "style":
            words += ["." + w for w in _NAME.findall(value)]
    return tuple(words)


@dataclass
class _Within:
    """An open element that is hidden (no ``outer``) or a fallback (with what it interrupts)."""

    name: str
    depth: int  # it ends when fewer elements than these are open
    outer: tuple | None = None


class _Leaves:
    """Collects the runs of text between the beginnings and ends of block elements.

    Fallback content (``FALLBACKS``) makes blocks of its own, which follow the block
    they stand in and leave it whole. Hidden and fallback content ends with its
    parent at the latest, a button or list of choices at the next of its kind or at
    an element it cannot hold.
    """

    def __init__(self) -> None:
        self.open: list[tuple[str, tuple[str, ...]]] = []
        self.within: list[_Within] = []
        self.hidden = self.links = 0
        self._fresh()

    def _fresh(self) -> None:
        self.blocks: list[Block] = []
        self.after: list[Block] = []  # fallbacks of the running block
        self.text: list[str] = []
        self.linked = 0

    def add(self, piece: str) -> None:
        if piece and not self.hidden:
            self.text.append(piece)
            if self.links:
                self.linked += len(piece)

    def flush(self) -> None:
        joined = " ".join(html.unescape("".join(self.text)).split()) if self.text else ""
        if joined:
            path = tuple(dict.fromkeys(w for _, words in self.open for w in words))
            last = "^" + (self.open[-1][0] if self.open else "")
            self.blocks.append(Block((*path, last), joined, min(1.0, self.linked / len(joined))))
        self.blocks += self.after
        self.text, self.after, self.linked = [], [], 0

    def _leave(self) -> None:
        one = self.within.pop()
        if one.outer is None:
            self.hidden -= 1
            del self.open[one.depth :]
            return
        self.flush()
        found = self.blocks
        self.blocks, self.after, self.text, self.linked = one.outer
        self.after += found
        del self.open[one.depth - 1 :]

    def leave(self, names: Iterable[str]) -> None:
        """End the elements from the outermost of the innermost run of ``names`` on, if one is open."""
        at = len(self.within)
        while at and self.within[at - 1].name in names:
            at -= 1
        while len(self.within) > at:
            self._leave()

    def _break(self) -> None:
        """A block begins or ends here; what is hidden breaks nothing."""
        if not self.hidden:
            self.flush()

    def start(self, name: str, attributes: str) -> None:
        if name in HIDDEN_CONTENT or name in FALLBACKS:
            if name in CHOICES:
                self._next_choice(name)
            if attributes.rstrip().endswith("/"):
                return
            if name in HIDDEN_CONTENT:
                self.within.append(_Within(name, len(self.open)))
                self.hidden += 1
            else:
                outer = (self.blocks, self.after, self.text, self.linked)
                self._fresh()
                self.open.append((name, _names(name, attributes)))
                self.within.append(_Within(name, len(self.open), outer))
            return
        if name in ENDS_CHOICES:
            self.leave(CHOICES)
        if name not in BLOCKS:
            return
        self._break()
        if name in VOID:
            return
        floor = self.within[-1].depth if self.within else 0
        if len(self.open) > floor:
            last = self.open[-1][0]
            if last == "p" or (name in ("li", "dt", "dd", "tr", "td", "th") and last == name):
                self.open.pop()
        self.open.append((name, _names(name, attributes)))

    def _next_choice(self, name: str) -> None:
        """A button ends an open button, an option an open option."""
        if self.within and self.within[-1].name == name:
            self._leave()

    def end(self, name: str) -> None:
        if name in HIDDEN_CONTENT or name in FALLBACKS:
            if any(one.name == name for one in self.within):
                while self.within[-1].name != name:
                    self._leave()
                self._leave()
        elif name in BLOCKS:
            self._break()
            places = [k for k, (open_, _) in enumerate(self.open) if open_ == name]
            if places:
                while self.within and self.within[-1].depth > places[-1]:
                    self._leave()
                self._break()
                del self.open[places[-1] :]

    def finish(self) -> list[Block]:
        while self.within:
            self._leave()
        self.flush()
        return self.blocks


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks. ``head`` and ``body`` need not be marked: text stands in the body wherever it is met."""
    leaves = _Leaves()
    at, size = 0, len(page)
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            leaves.add(page[at:])
            break
        leaves.add(page[at:tag])
        found = _TAG.match(page, tag)
        if not found:
            leaves.add("<")
            at = tag + 1
            continue
        at = found.end()
        closing, name, attributes, end = found.groups()
        if name is None:
            continue
        if not end:
            # A string that is never closed, or closed by a quote of the text, ends with its tag.
            stop = page.find(">", tag)
            if stop < 0:
                break  # the page ends within a tag
            attributes, at = page[found.start(3) : stop], stop + 1
        name = name.lower()
        if not closing and name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            at = stop.start() if stop else size
            if stop:
                at = page.find(">", at) + 1 or size
        elif name == "br":
            leaves.add(" ")
        elif name == "a":
            leaves.links = 0 if closing else 1
        elif closing:
            leaves.end(name)
        else:
            leaves.start(name, attributes)
    return leaves.finish()


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: hashed path, hashed words (length one), figures."""
    out = np.zeros((len(blocks), TAGS + WORDS + FIGURES), np.float32)
    for row, block in enumerate(blocks):
        out[row, [zlib.crc32(w.encode()) % TAGS for w in block.path]] = 1
        words = block.text.lower().split()
        counts = np.bincount([zlib.crc32(w.encode("utf-8", "replace")) % WORDS for w in words], minlength=WORDS)
        out[row, TAGS : TAGS + WORDS] = counts / np.sqrt((counts * counts).sum())
        out[row, TAGS + WORDS :] = (
            np.log1p(len(words)) / 5,
            np.log1p(len(block.text)) / 7,
            block.linked,
            block.text[-1] in ".!?:;\"'…",
            row / max(len(blocks) - 1, 1),
            np.log1p(len(blocks)) / 5,
            "©" in block.text,
            len(block.path) / 10,
        )
    return out


# ---- the network ------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def parameters(rng: np.random.Generator) -> dict[str, np.ndarray]:
    inputs = TAGS + WORDS + FIGURES
    weights = {"out": rng.normal(0, 0.3, 2 * HIDDEN), "direct": np.zeros(inputs), "bias": np.zeros(1)}
    for way in ("f", "b"):
        weights |= {
            f"x{way}": rng.normal(0, 0.1, (inputs, 4 * HIDDEN)),
            f"h{way}": rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
            f"c{way}": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]),
        }
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _run(weights: dict, way: str, x: np.ndarray, mask: np.ndarray, tape: list | None = None) -> np.ndarray:
    """States of one direction, time first; masked steps leave the state alone."""
    steps, pages, _ = x.shape
    into = x @ weights[f"x{way}"] + weights[f"c{way}"]
    h = c = np.zeros((pages, HIDDEN), np.float32)
    out = np.zeros((steps, pages, HIDDEN), np.float32)
    for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
        gates = into[t] + h @ weights[f"h{way}"]
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        m = mask[t][:, None]
        new = f * c + i * g
        squashed = np.tanh(new)
        if tape is not None:
            tape.append((t, i, f, o, g, c, squashed, h, m))
        c, h = m * new + (1 - m) * c, m * (o * squashed) + (1 - m) * h
        out[t] = h
    return out


def scores(weights: dict, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Log odds of being article text; ``x`` is (blocks, pages, features)."""
    states = np.concatenate([_run(weights, "f", x, mask), _run(weights, "b", x, mask)], axis=2)
    return states @ weights["out"] + x @ weights["direct"] + weights["bias"][0]


def _gradients(weights: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    tapes: dict[str, list] = {"f": [], "b": []}
    states = {way: _run(weights, way, x, mask, tapes[way]) for way in tapes}
    both = np.concatenate([states["f"], states["b"]], axis=2)
    logits = both @ weights["out"] + x @ weights["direct"] + weights["bias"][0]
    error = (_sigmoid(logits) - y) * mask / mask.sum()
    grads = {
        "out": np.einsum("tp,tph->h", error, both),
        "direct": np.einsum("tp,tpd->d", error, x),
        "bias": np.array([error.sum()]),
    }
    for n, way in enumerate(("f", "b")):
        recurrent = weights[f"h{way}"]
        d_state = error[:, :, None] * weights["out"][n * HIDDEN : (n + 1) * HIDDEN]
        d_into = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        d_recurrent = np.zeros_like(recurrent)
        dh_next = dc_next = np.zeros((x.shape[1], HIDDEN), np.float32)
        for t, i, f, o, g, c, squashed, h, m in reversed(tapes[way]):
            dh = d_state[t] + dh_next
            through, kept = m * dh, (1 - m) * dh
            dc = m * dc_next + through * o * (1 - squashed**2)
            gates = np.concatenate(
                [dc * g * i * (1 - i), dc * c * f * (1 - f), through * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1
            )
            d_into[t] = gates
            d_recurrent += h.T @ gates
            dh_next = kept + gates @ recurrent.T
            dc_next = dc * f + (1 - m) * dc_next
        grads[f"x{way}"] = np.tensordot(x, d_into, axes=([0, 1], [0, 1]))
        grads[f"h{way}"], grads[f"c{way}"] = d_recurrent, d_into.sum((0, 1))
    return grads


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max((len(p) for p in pages), default=0)
    x = np.zeros((steps, len(pages), TAGS + WORDS + FIGURES), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, 1
    return x, mask


def fit(pages: list[tuple[list[Block], list[int]]], seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights fitted to labelled pages (Adam, a fixed number of rounds)."""
    rng = np.random.default_rng(seed)
    weights = parameters(rng)
    described = [(features(blocks), np.array(labels, np.float32)) for blocks, labels in pages if blocks]
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    step = 0
    for epoch in range(EPOCHS):
        # Pages of like length share a batch, to keep the padding small.
        order = np.argsort([len(x) + rng.uniform(0, 4) for x, _ in described])
        batches = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for k in rng.permutation(len(batches)):
            x, mask = padded([described[i][0] for i in batches[k]])
            # Names that a layout happens to use must not decide alone, nor a text's words and figures.
            x[:, :, :TAGS] *= rng.random((1, x.shape[1], TAGS)) > 0.05
            x[:, :, TAGS : TAGS + WORDS] *= rng.random((*x.shape[:2], 1)) > 0.4
            x[:, :, TAGS + WORDS :] *= rng.random((*x.shape[:2], FIGURES)) > 0.2
            y = np.zeros_like(mask)
            for j, i in enumerate(batches[k]):
                y[: len(described[i][1]), j] = described[i][1]
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS) + 0.001
            for key, grad in _gradients(weights, x, mask, y).items():
                first[key] = 0.9 * first[key] + 0.1 * grad
                second[key] = 0.99 * second[key] + 0.01 * grad * grad
                change = rate * (first[key] / (1 - 0.9**step)) / (np.sqrt(second[key] / (1 - 0.99**step)) + 1e-8)
                weights[key] = (weights[key] - change).astype(np.float32)
    return weights


# ---- training pages ---------------------------------------------------------------

# How pages name their parts; each line is one kind of part.
MAIN = "article content post entry story main text body article-body entry-content post-content page-content post-body"
PARTS = {
    "nav": "nav navbar menu navigation breadcrumb breadcrumbs main-menu topnav skip",
    "header": "header masthead site-header page-header top topbar branding logo",
    "aside": "sidebar side rail related widget widgets recommended more-stories popular trending secondary",
    "footer": "footer site-footer bottom copyright legal colophon credits",
    "ad": "ad ads advert advertisement adsense sponsored sponsor promo banner promotion affiliate",
    "notice": "cookie cookies notice consent gdpr alert popup modal newsletter subscribe paywall message warning disclaimer",
    "form": "form search login signup subscribe-form contact-form poll register",
    "comments": "comments comment responses discussion replies comment-list commentlist disqus reader-comments reactions",
    "share": "share social sharing tags pagination pager author-bio toolbar meta byline",
}
NATIVE = {"nav": "nav", "header": "header", "aside": "aside", "footer": "footer", "form": "form"}
PHRASES = {
    "notice": ("We use cookies to improve this site.", "Accept all", "This site uses cookies.", "Sign up for our newsletter"),
    "form": ("Your name", "E-mail address", "Search", "Password", "Send"),
    "comments": ("Comments", "Reply", "Leave a comment", "3 replies", "Great post, thanks!", "I do not agree."),
    "ad": ("Advertisement", "Sponsored", "Buy now and save", "Special offer"),
    "share": ("Share this", "Next page", "Tags:", "Follow us"),
    "aside": ("Related articles", "Most read", "Popular"),
    "footer": ("© Example", "All rights reserved", "Privacy", "Terms of use", "Imprint"),
}
STAND_INS = ("Please turn on JavaScript.", "Your browser cannot play this video.", "Your browser does not support this element.")


class Layouts:
    """Makes pages of known labels from the sentences of sampled pages."""

    def __init__(self, sentences: list[str], seed: int = SEED):
        self.rng, self.other = np.random.default_rng([seed, 1]), np.random.default_rng([seed, 2])
        self.sentences = sentences or ["Nothing to read here."]

    def _one(self, values) -> str:
        return values[int(self.rng.integers(len(values)))]

    def _flip(self, share: float) -> bool:
        return bool(self.rng.random() < share)

    def _sentence(self) -> str:
        words = self._one(self.sentences).split()
        if self._flip(0.4):
            words = words[: int(self.rng.integers(1, 12))]
        return " ".join(words)

    def _attribute(self, words: str) -> str:
        key = "id" if self._flip(0.3) else "class"
        more = f" {self._one(('box', 'row', 'col', 'wide', 'clearfix', 'block', 'inner'))}" if self._flip(0.3) else ""
        return f' {key}="{self._one(words.split())}{more}"'

    def _part(self, kind: str) -> list[tuple[str, int]]:
        """A part that is not article text, as markup pieces with labels (-1: no block)."""
        native = kind in NATIVE and self._flip(0.6)
        tag = NATIVE[kind] if native else self._one(("div", "div", "section", "ul" if kind in ("nav", "share") else "div", "aside" if kind == "ad" else "div"))
        named = "" if native and self._flip(0.6) else self._attribute(PARTS[kind])
        out = [(f"<{tag}{named}>", -1)]
        linked = kind in ("nav", "share") or (kind in ("aside", "footer") and self._flip(0.5))
        for _ in range(int(self.rng.integers(1, 7 if kind != "ad" else 3))):
            text = self._one(PHRASES[kind]) if kind in PHRASES and self._flip(0.35) else self._sentence()
            inner = "li" if linked and self._flip(0.7) else self._one(("p", "div", "p", "span", "li", "h3", "label" if kind == "form" else "p"))
            classes = self._attribute(PARTS[kind]) if self._flip(0.2) else ""
            content = f'<a href="/x">{html.escape(text)}</a>' if linked else html.escape(text)
            if inner in ("span", "label"):
                out += [(f"<div><{inner}{classes}>", -1), (content, 0), (f"</{inner}></div>", -1)]
            else:
                out += [(f"<{inner}{classes}>", -1), (content, 0), (f"</{inner}>", -1)]
        return [*out, (f"</{tag}>", -1)]

    def _body(self) -> list[tuple[str, int]]:
        """Article blocks, with adverts, notices or sharing links strewn in."""
        out: list[tuple[str, int]] = []
        if self._flip(0.85):
            level = self._one(("h1", "h1", "h2"))
            out += [(f"<{level}>", -1), (html.escape(self._sentence()), 1), (f"</{level}>", -1)]
        for _ in range(int(self.rng.integers(0, 14))):
            draw = self.rng.random()
            text = html.escape(self._sentence())
            if self._flip(0.15):
                text = f'{text} <a href="/y">{html.escape(self._sentence()[:40])}</a>'
            if draw < 0.08:
                out += self._part(self._one(("ad", "notice", "share", "aside", "form")))
            elif draw < 0.14:
                out += [("<div>", -1), (text, 1), ("</div>", -1)]
            elif draw < 0.72:
                close = "" if self._flip(0.15) else "</p>"
                out += [("<p><b>" if self._flip(0.15) else "<p>", -1), (text, 1), (close, -1)]
            elif draw < 0.80:
                out += [(f"<{(level := self._one(('h2', 'h3', 'h4')))}>", -1), (text, 1), (f"</{level}>", -1)]
            elif draw < 0.87:
                out.append(("<ul>", -1))
                for _ in range(int(self.rng.integers(1, 4))):
                    out += [("<li>", -1), (html.escape(self._sentence()), 1), ("</li>", -1)]
                out.append(("</ul>", -1))
            elif draw < 0.91:
                out += [("<blockquote><p>", -1), (text, 1), ("</p></blockquote>", -1)]
            elif draw < 0.94:
                out += [("<pre>", -1), (text, 1), ("</pre>", -1)]
            elif draw < 0.97:
                out += [("<table><tr><td>", -1), (text, 1), ("</td><td>", -1), (html.escape(self._sentence()), 1), ("</td></tr></table>", -1)]
            else:
                out += [("<figure><figcaption>", -1), (text, 1), ("</figcaption></figure>", -1)]
        return out

    def page(self) -> tuple[list[Block], list[int]]:
        container = self.rng.random()
        if container < 0.40:
            head, tail = "<article>" if self._flip(0.7) else f"<article{self._attribute(MAIN)}>", "</article>"
        elif container < 0.55:
            head, tail = "<main>", "</main>"
        elif container < 0.88:
            head, tail = f"<div{self._attribute(MAIN)}>", "</div>"
        elif container < 0.94:
            head, tail = f"<section{self._attribute(MAIN)}>", "</section>"
        else:
            head, tail = "", ""
        if self._flip(0.15):
            head, tail = "<main>" + head, tail + "</main>"
        if self._flip(0.25):
            head, tail = '<div class="container">' + head, tail + "</div>"
        before = [k for k in ("notice", "header", "nav", "ad", "aside", "share") if self._flip(0.35)]
        within = [k for k in ("comments", "share", "ad", "form", "footer") if self._flip(0.1)]
        after = [k for k in ("share", "comments", "aside", "form", "ad", "notice", "footer") if self._flip(0.3)]
        if self._flip(0.5):
            before, after = ["nav", "ad"], ["footer"]
        pieces = [p for k in before for p in self._part(k)] + [(head, -1), *self._body()]
        pieces += [p for k in within for p in self._part(k)] + [(tail, -1)]
        pieces += [p for k in after for p in self._part(k)]
        if self._flip(0.15):  # nothing but text, with hardly any markup
            text = html.escape(self._sentence())
            body = [(head, -1), *self._body(), (tail, -1)]
            pieces = [(text, 1)] if self._flip(0.25) else [("<p>", -1), (text, 1), ("</p>", -1)] if self._flip(0.2) else body
        if self._flip(0.1):
            pieces = pieces[: int(self.rng.integers(1, len(pieces) + 1))]
        if self.other.random() < 0.1:
            tag = sorted(FALLBACKS)[int(self.other.integers(len(FALLBACKS)))]
            text = STAND_INS[int(self.other.integers(len(STAND_INS)))]
            place = int(self.other.integers(len(pieces) + 1))
            pieces[place:place] = [(f"<{tag}>", -1), (text, 0), (f"</{tag}>", -1)]
        # Each block's label is found by a mark that no page holds.
        marked = "".join(f"\x00{label}\x00{piece}" if label >= 0 else piece for piece, label in pieces)
        blocks, labels = [], []
        for block in leaf_blocks(f"<html><head><title>x</title></head><body>{marked}"):
            found = re.match(r"\x00(\d)\x00 ?", block.text)
            text = re.sub(r"\x00\d\x00", "", block.text).strip()
            if found and text:
                blocks.append(Block(block.path, text, block.linked))
                labels.append(int(found[1]))
        return blocks, labels


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = TRAINING_PAGES) -> dict[str, np.ndarray]:
    """Weights of the labeller, from the sentences of ``sample`` pages at most (least hash of the id)."""
    texts = sampled_texts(pages, id_col, html_col, sample)
    sentences = sorted({b.text for page in texts for b in leaf_blocks(page)})
    layouts = Layouts(sentences)
    return fit([layouts.page() for _ in range(LAYOUTS)])


# ---- extraction -------------------------------------------------------------------


def extract(pages: list[str], weights: dict[str, np.ndarray]) -> list[str]:
    """Main texts; pages of like length are run together."""
    parsed = [leaf_blocks(page) if page else [] for page in pages]
    texts = [""] * len(pages)
    order = sorted((k for k, blocks in enumerate(parsed) if blocks), key=lambda k: len(parsed[k]))
    at = 0
    while at < len(order):
        # A page with very many blocks is run alone.
        width = max(1, min(BATCH, 8192 // len(parsed[order[min(at + BATCH, len(order)) - 1]])))
        group = order[at : at + width]
        at += len(group)
        x, mask = padded([features(parsed[k]) for k in group])
        good = scores(weights, x, mask) > 0
        for j, k in enumerate(group):
            texts[k] = "\n".join(b.text for t, b in enumerate(parsed[k]) if good[t, j])
    return texts


def extractor(weights: dict[str, np.ndarray]):
    """Column function: html -> main text."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out: list[str] = []
            for begin in range(0, len(batch), 256):
                out += extract(batch.slice(begin, 256).to_pylist(), weights)
            yield pa.array(out, pa.string())

    return run


def main_text(page: Column, weights: dict[str, np.ndarray]) -> Column:
    """The page's main text; empty for a null, empty or text-less page. Never null."""
    return extractor(weights)(page.cast("string"))
