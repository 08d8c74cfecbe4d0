"""Main text of web pages: a recurrent labeller reads the page's leaf blocks in both directions and tells for each,
from the context of the whole page, whether it is main text.

A block is a vector of its hashed tag path, its hashed words and a few measures. The network is a bidirectional LSTM
in numpy; it is trained here, on pages made by a generator of layouts (``TRAIN_PAGES`` of them, with fixed seed), and
its weights, some hundred kB, are sent to the executors. Pages are labelled whole, however long.
"""

from __future__ import annotations

import functools
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platework.llm import blocks
from platework.llm.common import in_batches

PATH_DIMS, WORD_DIMS, MEASURES = 192, 48, 6
DIMS, HIDDEN = PATH_DIMS + WORD_DIMS + MEASURES, 24
TRAIN_PAGES, EPOCHS, SEED = 2_000, 8, 7
#: Share of the training pages whose names tell nothing, and of those that are bare text.
UNTELLING, BARE = 0.4, 0.03
#: Blocks of the pages that are run through the network together.
STEP_BLOCKS = 20_000

_WORDS = re.compile(r"\w+")


class Features:
    """Vectors of blocks; hashed places of marks and words are remembered, up to a bound."""

    def __init__(self):
        self.marks: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def places(self, marks: tuple[str, ...]) -> np.ndarray:
        found = self.marks.get(marks)
        if found is None:
            if len(self.marks) > 20_000:
                self.marks.clear()
            found = self.marks[marks] = np.array([crc32(m.encode()) % PATH_DIMS for m in marks])
        return found

    def path(self, node: blocks.Node | None) -> np.ndarray:
        """The marks on the way to a block. They are kept with its element and the one around it, which other blocks
        share, and with no others."""
        way = []
        while node is not None and node.vector is None:
            way.append(node)
            node = node.parent
        found = np.zeros(PATH_DIMS, bool) if node is None else node.vector.copy() if way else node.vector
        for step in reversed(way):
            found[self.places(step.marks)] = True
            if step in way[:2]:
                step.vector = found.copy()
        return found

    def word(self, word: str) -> int:
        found = self.words.get(word)
        if found is None:
            if len(self.words) > 300_000:
                self.words.clear()
            found = self.words[word] = crc32(word.encode()) % WORD_DIMS
        return found

    def of(self, page: list[blocks.Block]) -> np.ndarray:
        out = np.zeros((len(page), DIMS), np.float32)
        word = self.word
        for k, b in enumerate(page):
            out[k, :PATH_DIMS] = self.path(b.node)
            words = b.text.lower().split()
            found = np.bincount([word(w) for w in words], minlength=WORD_DIMS)
            out[k, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.sqrt(found / len(words))
            out[k, PATH_DIMS + WORD_DIMS :] = (
                np.log1p(len(words)) / 4, b.linked / max(len(b.text), b.linked, 1), b.text[-1:] in ".!?:;\"»",
                b.text.count(",") / len(words), k / len(page), len(page) < 4)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Bidirectional LSTM with one output per block. Pages are padded to the longest of a batch: steps x pages."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.weights = {}
        for d in "fb":
            self.weights |= {f"W{d}": draw(DIMS, 4 * HIDDEN), f"U{d}": draw(HIDDEN, 4 * HIDDEN),
                             f"b{d}": np.zeros(4 * HIDDEN, np.float32)}
            self.weights[f"b{d}"][HIDDEN : 2 * HIDDEN] = 1.0  # begin by remembering
        self.weights |= {"V": draw(2 * HIDDEN, 1), "c": np.zeros(1, np.float32)}

    def _direction(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        steps, pages, _ = x.shape
        into = (x.reshape(steps * pages, -1) @ self.weights[f"W{d}"] + self.weights[f"b{d}"]).reshape(steps, pages, -1)
        h, c = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
        out, kept, H = np.zeros((steps, pages, HIDDEN), np.float32), {}, HIDDEN
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = into[t] + h @ self.weights[f"U{d}"]
            gates, g = _sigmoid(z[:, : 3 * H]), np.tanh(z[:, 3 * H :])
            i, f, o = gates[:, :H], gates[:, H : 2 * H], gates[:, 2 * H :]
            m = mask[t][:, None]
            new = f * c + i * g
            squashed = np.tanh(new)
            if keep:
                kept[t] = (h, c, i, f, o, g, squashed)
            c, h = m * new + (1 - m) * c, m * o * squashed + (1 - m) * h
            out[t] = h
        return out, kept

    def scores(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, kf = self._direction("f", x, mask, keep)
        b, kb = self._direction("b", x, mask, keep)
        both = np.concatenate([f, b], axis=2)
        return _sigmoid((both @ self.weights["V"])[:, :, 0] + self.weights["c"]), both, {"f": kf, "b": kb}

    def gradients(self, x: np.ndarray, mask: np.ndarray, truth: np.ndarray):
        p, both, kept = self.scores(x, mask, keep=True)
        dz = (p - truth) * mask / mask.sum()
        out = {"V": np.einsum("tph,tp->h", both, dz)[:, None], "c": dz.sum(keepdims=True)[0]}
        dboth = dz[:, :, None] * self.weights["V"][:, 0]
        H = HIDDEN
        for k, d in enumerate("fb"):
            dout, U = dboth[:, :, k * H : (k + 1) * H], self.weights[f"U{d}"]
            into, dU = np.zeros((*x.shape[:2], 4 * H), np.float32), np.zeros_like(U)
            dh, dc = np.zeros(dout.shape[1:], np.float32), np.zeros(dout.shape[1:], np.float32)
            steps = range(len(x))
            for t in reversed(steps) if d == "f" else steps:
                h, c, i, f, o, g, squashed = kept[d][t]
                m = mask[t][:, None]
                dh = dh + dout[t]
                inner = dc * m + dh * m * o * (1 - squashed**2)
                dgate = np.concatenate([
                    inner * g * i * (1 - i), inner * c * f * (1 - f), dh * m * squashed * o * (1 - o),
                    inner * i * (1 - g**2)], axis=1)
                into[t] = dgate
                dU += h.T @ dgate
                dh, dc = dh * (1 - m) + dgate @ U.T, dc * (1 - m) + inner * f
            flat = into.reshape(-1, 4 * H)
            out |= {f"W{d}": x.reshape(-1, DIMS).T @ flat, f"U{d}": dU, f"b{d}": flat.sum(axis=0)}
        return out

    def train(self, pages: list[np.ndarray], truths: list[np.ndarray], epochs: int, seed: int, size: int = 24) -> Network:
        rng = np.random.default_rng(seed)
        first, second, step = {}, {}, 0
        for epoch in range(epochs):
            for at in np.array_split(rng.permutation(len(pages)), -(-len(pages) // size)):
                x, mask = padded([pages[k] for k in at])
                truth = np.zeros(mask.shape, np.float32)
                for column, k in enumerate(at):
                    truth[: len(truths[k]), column] = truths[k]
                step += 1
                rate = 0.01 * (0.6**epoch)
                for name, g in self.gradients(x, mask, truth).items():
                    g = np.clip(g, -1, 1)
                    first[name] = 0.9 * first.get(name, 0) + 0.1 * g
                    second[name] = 0.99 * second.get(name, 0) + 0.01 * g * g
                    move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
                    self.weights[name] = (self.weights[name] - rate * move).astype(np.float32)
        return self

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length are run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            to = at + 1
            while to < len(order) and len(pages[order[to]]) * (to + 1 - at) <= STEP_BLOCKS:
                to += 1
            x, mask = padded([pages[k] for k in order[at:to]])
            p = self.scores(x, mask)[0]
            for column, k in enumerate(order[at:to]):
                out[k] = p[: len(pages[k]), column] >= 0.5
            at = to
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((steps, len(pages), DIMS), np.float32)
    mask = np.zeros((steps, len(pages)), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k], mask[: len(page), k] = page, 1.0
    return x, mask


# --- pages to learn from

#: Names that sites give to what is not main text, and to what is.
OUTER = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs tabs".split(),
    "header": "header masthead topbar site-header branding logo banner".split(),
    "footer": "footer site-footer bottom copyright legal colophon".split(),
    "sidebar": "sidebar aside widget related recommended popular rail tags share social".split(),
    "notice": "cookie consent notice gdpr alert popup modal privacy newsletter paywall".split(),
    "advert": "ad ads advert advertisement sponsored promo promotion adsbox banner-ad adslot".split(),
    "form": "search login signup subscribe contact form".split(),
    "comments": "comments comment commentlist replies respond discussion reviews thread".split(),
}
INNER = "content article post entry story main body text post-content article-body entry-content page-content".split()
OUTER_WORDS = {
    "menu": "home about contact news sport products services blog help".split(),
    "header": "home welcome sign in menu".split(),
    "footer": "copyright © all rights reserved terms privacy imprint contact ·".split(),
    "sidebar": "related popular latest more read tags share recommended".split(),
    "notice": "we use cookies accept decline settings agree privacy sign up our newsletter subscribe".split(),
    "advert": "advertisement buy now offer sponsored sale click".split(),
    "form": "email name password submit search send subscribe".split(),
    "comments": "says reply wrote comment ago like report".split(),
}
_SYLLABLES = "the an er on re ti es or te in at le de la que ment ción ung sch ein ou ai né ra do so mi ka lo".split()


class Layouts:
    """Random pages as (source, is it main text) parts."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.vocabulary = ["".join(self.rng.choices(_SYLLABLES, k=self.rng.choice((1, 1, 2, 2, 3, 4)))) for _ in range(4_000)]
        self.untelling = False

    def words(self, low: int, high: int) -> str:
        return " ".join(self.rng.choices(self.vocabulary, k=self.rng.randint(low, high)))

    def sentence(self, low: int = 3, high: int = 30) -> str:
        return self.words(low, high).capitalize() + self.rng.choice((".", ".", ".", "!", "?", ""))

    def prose(self, many: int = 5) -> str:
        found = " ".join(self.sentence() for _ in range(self.rng.randint(1, many)))
        if self.rng.random() < 0.3:
            word = self.rng.choice(self.vocabulary)
            found += f" <{(t := self.rng.choice(('a href=x', 'b', 'em', 'span', 'i')))}>{word}</{t.split()[0]}>."
        return found if self.rng.random() < 0.9 else found.replace(" ", "*** ").replace(". ", "%%% ")

    def tag(self, name: str, named: str | None) -> str:
        if self.untelling and named is not None:  # made-up names, or none
            named = None if self.rng.random() < 0.5 else self.rng.choice(
                ("css-", "sc-", "x", "")) + self.words(1, 1) + self.rng.choice(("", "1", "-2", "_a"))
        if named is None:
            return f"<{name}>"
        if self.rng.random() < 0.3:
            named += " " + self.rng.choice(("clearfix", "box", "col-md", "wrap", "inner", "block"))
        return f'<{name} {self.rng.choice(("class", "class", "class", "id"))}="{named}">'

    def outer(self, kind: str) -> str:
        """A part that is not main text."""
        r = self.rng
        if self.untelling and kind in ("notice", "advert") and r.random() < 0.4:
            text = " ".join(r.sample(OUTER_WORDS[kind], r.randint(2, 6))).capitalize()
            return f"<{(t := r.choice(('p', 'div', 'li')))}>{text}</{t}>"
        own = {"menu": ("nav", "ul", "div"), "header": ("header", "div"), "footer": ("footer", "div"),
               "sidebar": ("aside", "div", "section"), "notice": ("div", "section"), "advert": ("div", "div", "aside", "section"),
               "form": ("form", "div"), "comments": ("section", "div", "ol")}[kind]
        name = r.choice(own)
        telling = name in ("nav", "header", "footer", "aside", "form")
        opened = self.tag(name, None if telling and r.random() < 0.6 else r.choice(OUTER[kind]))
        text = lambda: " ".join(r.sample(OUTER_WORDS[kind], 2)) if r.random() < 0.4 else self.words(1, 5)
        if kind in ("menu", "sidebar") and r.random() < 0.85:
            inner = "".join(f'<li><a href="/x">{text()}</a></li>' for _ in range(r.randint(2, 9)))
            inner = inner if name == "ul" else f"<ul>{inner}</ul>"
            if kind == "sidebar":
                inner = f"<h3>{text()}</h3>{inner}"
        elif kind == "comments":
            each = lambda: f'<{(t := r.choice(("p", "div", "li")))}>{self.prose(3)}</{t}>'
            inner = f"<h3>{text()}</h3>" + "".join(f'<div class="comment"><span>{text()}</span>{each()}</div>' for _ in range(r.randint(1, 6)))
        elif kind == "form":
            inner = f"<label>{text()}</label><input name=x><select><option>{text()}</option><option>{text()}</option></select><button>{text()}</button>"
            inner = inner if name == "form" else f"<form>{inner}</form>"
        elif kind == "footer":
            inner = r.choice((f"<p>&copy; {text()} {self.sentence(2, 9)}</p>", f"&copy; {text()} &middot; {self.prose(2)}"))
        elif kind == "header":
            inner = f"<h1>{self.words(1, 4)}</h1><p>{self.words(2, 6)}</p>" if r.random() < 0.5 else f'<a href="/">{self.words(1, 3)}</a>'
        else:
            inner = r.choice((f"<p>{text()} {self.prose(3)}</p>", self.prose(3), f"{text()} <a href=x>{text()}</a>"))
        return f"{opened}{inner}</{name}>"

    def main(self) -> list[tuple[str, bool]]:
        r = self.rng
        name = r.choice(("div", "div", "div", "section", "article", "main") if self.untelling else (
            "article", "article", "main", "div", "div", "section"))
        block = r.choice(("p", "p", "div")) if self.untelling else "p"
        opened = self.tag(name, None if name in ("article", "main") and r.random() < 0.6 else r.choice(INNER))
        title = self.sentence(1, 12)
        out = [(f"{opened}<{(h := r.choice(('h1', 'h1', 'h2')))}>{title}</{h}>", True)] if r.random() < 0.9 else [(opened, True)]
        for _ in range(r.choice((1, 2, 3, 5, 8, 13, 20))):
            kind = r.random()
            if kind < 0.74:
                out.append((f"<{block}>{self.prose(r.choice((1, 3, 8)))}</{block}>", True))
            elif kind < 0.77:
                out.append((self.listed(), True))
            elif kind < 0.80:
                out.append((f"<p><b>{self.prose(2)}<br>", True))
            elif kind < 0.86:
                out.append((f"<h2>{self.words(1, 7)}</h2>", True))
            elif kind < 0.91:
                out.append(("<ul>" + "".join(f"<li>{self.prose(1)}</li>" for _ in range(r.randint(2, 5))) + "</ul>", True))
            elif kind < 0.94:
                out.append((f"<blockquote>{self.prose(2)}</blockquote>", True))
            elif kind < 0.96:
                cells = "".join(f"<td>{self.words(1, 3)}</td>" for _ in range(3))
                out.append((f"<table><tr>{cells}</tr><tr>{cells}</tr></table>", True))
            else:
                out.append((self.outer(r.choice(("advert", "sidebar", "form", "notice"))), False))
        if r.random() < 0.1:
            out.append((self.outer("comments"), False))
        return [*out, (f"</{name}>", True)]

    def listed(self) -> str:
        """Main text in other elements than paragraphs."""
        r, many = self.rng, range(self.rng.randint(1, 5))
        kind = r.choice(("ol", "dl", "pre", "figure", "table", "br"))
        if kind == "ol":
            return "<ol>" + "".join(f"<li>{self.prose(2)}</li>" for _ in many) + "</ol>"
        if kind == "dl":
            return "<dl>" + "".join(f"<dt>{self.words(1, 4)}</dt><dd>{self.prose(2)}</dd>" for _ in many) + "</dl>"
        if kind == "pre":
            return "<pre><code>" + "\n".join(f"{self.words(1, 2)} = {self.words(1, 3)};" for _ in many) + "</code></pre>"
        if kind == "figure":
            return f"<figure><img src=x><figcaption>{self.sentence(4, 14)}</figcaption></figure>"
        if kind == "table":
            rows = "".join(f"<tr><th>{self.words(1, 2)}</th><td>{self.sentence(2, 12)}</td></tr>" for _ in many)
            return f"<table>{rows}</table>"
        return "<div>" + "<br><br>".join(self.prose(3) for _ in many) + "</div>"

    def page(self) -> list[tuple[str, bool]]:
        r = self.rng
        if r.random() < BARE:
            return [("\n".join(self.prose(6) for _ in range(r.randint(1, 4))), True)]
        self.untelling = r.random() < UNTELLING
        wrap = self.tag("div", r.choice(("page", "wrapper", "container", "layout", "root"))) if r.random() < 0.5 else ""
        pick = lambda kinds, share: [(self.outer(k), False) for k in kinds if r.random() < share]
        head = f"<html><head><title>{self.sentence(1, 12)}</title><script>var t='<p>x</p>';</script></head><body>{wrap}"
        before = pick(["notice", "header", "menu", "advert", "form", "sidebar", "advert"], 0.4)
        after = pick(["comments", "sidebar", "advert", "form", "notice", "footer", "menu"], 0.4)
        if r.random() < 0.35:  # the plainest of layouts
            before = [(self.outer("menu"), False), (self.outer("advert"), False)]
            after = [(self.outer("footer"), False)]
        body = self.main() if r.random() < 0.97 else []
        return [(head, False), *before, *body, *after, ("</div></body></html>" if r.random() < 0.9 else "", False)]


def labelled(seed: int, pages: int) -> list[tuple[list[blocks.Block], np.ndarray]]:
    """Pages with the truth for each of their blocks."""
    layouts, out = Layouts(seed), []
    while len(out) < pages:
        parts = layouts.page()
        starts = np.cumsum([0, *[len(source) for source, _ in parts]])
        found = blocks.split("".join(source for source, _ in parts))
        truth = [parts[int(np.searchsorted(starts, b.at, side="right")) - 1][1] for b in found]
        if found:
            out.append((found, np.array(truth, np.float32)))
    return out


@functools.lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Network:
    features = Features()
    known = labelled(seed, pages)
    return Network(seed).train([features.of(p) for p, _ in known], [t for _, t in known], epochs, seed)


# --- operator

def main_text(
    df: DataFrame, network: Network | None = None, id_column: str = "page_id", text_column: str = "html",
    keep: tuple[str, ...] = ("url",),
) -> DataFrame:
    """Per page: the id, the columns ``keep``, ``text`` (main blocks joined by one space), ``n_chars`` (code points),
    ``n_blocks`` and ``n_main``.

    A null, empty or textless page gives the empty text. Rows that repeat or share an id are labelled each by itself;
    an empty table gives an empty result; other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(network or trained())
    features, known = Features(), {}

    def run(batch):
        pages = [blocks.split(t, known) if t else [] for t in batch["__html"].to_pylist()]
        main = shared.value.label([features.of(p) for p in pages])
        texts = [" ".join(b.text for b, m in zip(p, ms, strict=True) if m) for p, ms in zip(pages, main, strict=True)]
        return {c: batch[c] for c in (id_column, *keep)} | {
            "text": pa.array(texts, pa.string()), "n_chars": np.array([len(t) for t in texts], np.int64),
            "n_blocks": np.array([len(p) for p in pages], np.int32), "n_main": np.array([m.sum() for m in main], np.int32)}

    kept = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (id_column, *keep))
    rows = df.select(id_column, *keep, F.col(text_column).alias("__html"))
    return in_batches(rows, run, f"{kept}, text string, n_chars long, n_blocks int, n_main int")
