"""Main text of web pages: a recurrent labeller reads a page's blocks in both directions and marks each."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import mapped, sampled
from millrace.llm.html_blocks import PATH_BUCKETS, Block, Element, blocks, bucket

WORD_BUCKETS = 64
HIDDEN = 24
NUMBERS = 8
WIDTH = PATH_BUCKETS + WORD_BUCKETS + NUMBERS
SAMPLE_PAGES = 240       # pages that the labeller is trained on
RELAID = 3               # layouts that each of them is set in, besides its own
EPOCHS = 6
BATCH = 24
RATE = 0.01

# The rule that labels the sampled pages: text inside these is the article ...
_MAIN = {"article", "main"}
# ... unless it stands inside one of these.
_ASIDE = {"nav", "aside", "footer", "form", "header", "button", "select", "dialog", ".comments", ".comment", ".ad",
          ".ads", ".advert", ".sidebar", ".related", ".share", ".cookie", ".newsletter", ".notice", ".banner"}


def _path_bits(block: Block) -> np.ndarray:
    """Buckets of the names on a block's path, and of the two nearest ones by how near they stand."""
    bits = 0
    if block.at:
        bits = block.at.hashed
        for depth, name in enumerate(reversed(block.at.last)):
            bits |= bucket(f"{depth}{name}")
    return np.unpackbits(np.frombuffer(bits.to_bytes(PATH_BUCKETS // 8, "little"), np.uint8), bitorder="little")


def vector(block: Block, place: float) -> np.ndarray:
    """A block's input: hashed tags and names of its path, hashed words, and a few numbers."""
    x = np.zeros(WIDTH, np.float32)
    x[:PATH_BUCKETS] = _path_bits(block)
    words = block.text.lower().encode().split()
    counts = np.bincount(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % WORD_BUCKETS,
                         minlength=WORD_BUCKETS)
    x[PATH_BUCKETS:-NUMBERS] = counts / max(1.0, float(counts @ counts) ** 0.5)
    n = len(block.text)
    signs = sum(map(block.text.count, ".,;:!?"))
    x[-NUMBERS:] = (np.log1p(n) / 8, np.log1p(len(words)) / 6, block.linked / n, min(1.0, 10 * signs / n),
                    block.text[-1] in ".!?", block.text[0].isupper(), place,
                    (block.at.depth if block.at else 0) / 10)
    return x


def vectors(page: list[Block]) -> np.ndarray:
    return np.array([vector(b, i / len(page)) for i, b in enumerate(page)], np.float32).reshape(len(page), WIDTH)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Direction:
    """One LSTM over padded sequences (time, page, input), with its backward pass."""

    def __init__(self, rng: np.random.Generator):
        scale = HIDDEN ** -0.5
        self.w = rng.uniform(-scale, scale, (WIDTH, 4 * HIDDEN)).astype(np.float32)
        self.u = rng.uniform(-scale, scale, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN:2 * HIDDEN] = 1  # remember at first

    def forward(self, x: np.ndarray, real: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        time, pages, _ = x.shape
        h = c = np.zeros((pages, HIDDEN), np.float32)
        given = x.reshape(-1, WIDTH) @ self.w + self.b
        given = given.reshape(time, pages, -1)
        out, kept = np.zeros((time, pages, HIDDEN), np.float32), []
        for t in range(time):
            z = given[t] + h @ self.u
            gates, g = _sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            i, f, o = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
            new_c = f * c + i * g
            new_h = o * np.tanh(new_c)
            on = real[t][:, None]
            if keep:
                kept.append((i, f, o, g, h, c, new_c, on))
            h, c = np.where(on, new_h, h), np.where(on, new_c, c)
            out[t] = h
        return out, kept

    def backward(self, x: np.ndarray, kept: list, dout: np.ndarray) -> list[np.ndarray]:
        dw, du, db = (np.zeros_like(p) for p in (self.w, self.u, self.b))
        dh = dc = np.zeros(dout.shape[1:], np.float32)
        for t in range(len(kept) - 1, -1, -1):
            i, f, o, g, h, c, new_c, on = kept[t]
            dh = dh + dout[t]
            live = np.where(on, dh, 0)
            tanh = np.tanh(new_c)
            dnew = live * o * (1 - tanh ** 2) + np.where(on, dc, 0)
            dz = np.concatenate([dnew * g * i * (1 - i), dnew * c * f * (1 - f), live * tanh * o * (1 - o),
                                 dnew * i * (1 - g ** 2)], axis=1)
            dw += x[t].T @ dz
            du += h.T @ dz
            db += dz.sum(axis=0)
            dh = np.where(on, dz @ self.u.T, dh)
            dc = np.where(on, dnew * f, dc)
        return [dw, du, db]


@dataclass
class Labeller:
    """Two directions over a page's blocks and a weight for each of their outputs."""

    ahead: Direction
    back: Direction
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 3) -> Labeller:
        rng = np.random.default_rng(seed)
        return cls(Direction(rng), Direction(rng), rng.normal(0, 0.1, 2 * HIDDEN).astype(np.float32),
                   np.zeros(1, np.float32))

    def _run(self, pages: list[np.ndarray], keep: bool = False):
        most = max(map(len, pages))
        x = np.zeros((most, len(pages), WIDTH), np.float32)
        real = np.zeros((most, len(pages)), bool)
        for k, page in enumerate(pages):
            x[:len(page), k], real[:len(page), k] = page, True
        # Backwards the padding comes first; it leaves the state untouched.
        one, kept_one = self.ahead.forward(x, real, keep)
        two, kept_two = self.back.forward(x[::-1], real[::-1], keep)
        both = np.concatenate([one, two[::-1]], axis=2)
        return x, real, both, _sigmoid(both @ self.out + self.bias), kept_one, kept_two

    def chances(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For every page, the chance of each of its blocks to be main text."""
        found: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        at = 0
        while at < len(order):
            # As many pages together as keep the padded block count small.
            until = at + 1
            while until < len(order) and until - at < 256 and len(pages[order[until]]) * (until - at + 1) <= 16384:
                until += 1
            chosen = order[at:until]
            chance = self._run([pages[k] for k in chosen])[3]
            for column, k in enumerate(chosen):
                found[k] = chance[:len(pages[k]), column]
            at = until
        return found

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray]) -> None:
        rng = np.random.default_rng(5)
        params = [self.ahead.w, self.ahead.u, self.ahead.b, self.back.w, self.back.u, self.back.b, self.out, self.bias]
        first, second = ([np.zeros_like(p) for p in params] for _ in range(2))
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), BATCH):
                chosen = order[at:at + BATCH]
                x, real, both, chance, kept_one, kept_two = self._run([pages[k] for k in chosen], True)
                wanted = np.zeros_like(chance)
                for column, k in enumerate(chosen):
                    wanted[:len(labels[k]), column] = labels[k]
                error = np.where(real, chance - wanted, 0) / real.sum()
                dboth = error[:, :, None] * self.out
                grads = [*self.ahead.backward(x, kept_one, dboth[:, :, :HIDDEN]),
                         *self.back.backward(x[::-1], kept_two, dboth[::-1, :, HIDDEN:]),
                         (error[:, :, None] * both).sum(axis=(0, 1)), np.array([error.sum()], np.float32)]
                step += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)


def _inside(page: list[Block], names: set[str]) -> np.ndarray:
    """Which blocks stand inside an element with one of the names; every element is looked at once."""
    known: dict[Element | None, bool] = {None: False}
    for block in page:
        above, e = [], block.at
        while e not in known:
            above.append(e)
            e = e.up
        for e in reversed(above):
            known[e] = known[e.up] or not names.isdisjoint(e.own)
    return np.array([known[b.at] for b in page], bool)


def ruled(page: list[Block]) -> np.ndarray | None:
    """Labels by the page's own article or main element; None if it has none."""
    main = _inside(page, _MAIN)
    return (main & ~_inside(page, _ASIDE)).astype(np.float32) if main.any() else None


_HOLDERS = [("article", ""), ("main", ""), ("div", "content"), ("div", "main-content"), ("div", "post-body"),
            ("div", "entry-content"), ("section", "story"), ("div", "article-body"), ("td", "text"), ("div", "page body")]


def relaid(main: list[str], other: list[str], rng: np.random.Generator) -> tuple[str, list[bool]]:
    """A page that sets the given texts in another layout, and which of its blocks are main text."""
    html: list[str] = []
    labels: list[bool] = []

    def put(tag: str, names: str, texts: list[str], inner: str = "p", is_main: bool = False, link: bool = False) -> None:
        kind = "id" if rng.random() < 0.3 else "class"
        html.append(f"<{tag} {kind}=\"{names}\">" if names else f"<{tag}>")
        for text in texts:
            words = escape(text)
            words = f'<a href="/x">{words}</a>' if link else words
            html.append(f"<{inner}>{words}</{inner}>")
            labels.append(is_main)
        html.append(f"</{tag}>")

    def some(n: int) -> list[str]:
        return [other[k] for k in rng.integers(0, len(other), int(n))] if other else []

    def prose(n: int) -> list[str]:
        """Text that reads like an article's, for what stands beside one."""
        return [main[k] for k in rng.integers(0, len(main), int(n))] if main else []

    def maybe(chance: float) -> bool:
        return bool(rng.random() < chance)

    one = lambda *options: options[rng.integers(len(options))]
    if maybe(0.5):
        put(one("header", "div"), one("header", "top", "masthead", "logo"), some(1 + rng.integers(2)), "div")
    if maybe(0.8):
        put(one("nav", "ul", "div"), one("", "menu", "nav", "navbar", "breadcrumb"), some(2 + rng.integers(6)), "li", link=True)
    if maybe(0.4):
        put("div", one("cookie-notice", "notice", "consent banner", "alert"), [*prose(maybe(0.3)), *some(1)])
    if maybe(0.4):
        put(one("div", "aside"), one("ad", "advert", "sponsored", "promo banner"), [*prose(maybe(0.6)), *some(1)])
    if maybe(0.3):
        put("aside", one("sidebar", "widget", ""), [*prose(maybe(0.5)), *some(2)], one("p", "li"))
    tag, names = _HOLDERS[rng.integers(len(_HOLDERS))]
    wrap = maybe(0.3)
    if wrap:
        html.append(one("<main>", "<div class=\"wrapper\">", "<div id=\"container\">"))
    if maybe(0.6) and main:
        html.append(f"<{tag} class=\"{names}\">" if names else f"<{tag}>")
        html.append(f"<h1>{escape(main[0][:60])}</h1>")
        labels.append(bool(main[0][:60].strip()))
        for k, text in enumerate(main):
            html.append(f"<p>{escape(text)}</p>")
            labels.append(True)
            if maybe(0.1):
                put("div", one("ad", "share", "related", "newsletter"), some(1))
        html.append(f"</{tag}>")
    else:
        put(tag, names, main, one("p", "p", "div", "li"), True)
    if maybe(0.3):
        put(one("div", "section"), one("related", "share", "tags", "author-bio"), some(2 + rng.integers(3)), "li", link=True)
    if maybe(0.4):
        put(one("div", "section", "ol"), one("comments", "comment-list", "responses", "discussion"),
            [*prose(1 + rng.integers(3)), *some(1)], one("p", "li", "div"))
    if maybe(0.3):
        put("form", one("newsletter", "search", "login", "contact"), some(1 + rng.integers(2)), one("label", "button", "p"))
    if wrap:
        html.append("</div>")
    if maybe(0.3):
        put(one("aside", "div"), one("sidebar", "widget", "recent"), [*prose(maybe(0.5)), *some(2)], one("p", "li"))
    if maybe(0.8):
        put(one("footer", "div"), one("", "footer", "legal", "copyright"), some(1 + rng.integers(2)))
    return "".join(html), labels


def fit(pages: DataFrame, key: str = "page_id", html: str = "html", sample_pages: int = SAMPLE_PAGES) -> Labeller:
    """A labeller trained on at most ``sample_pages`` pages, those with the smallest hash of their key.

    They are labelled by their own article or main element.  Each is also set in
    RELAID other layouts, so that the labeller reads classes, order and text and
    not one site's template.  A page without such an element lends its longer
    unlinked blocks as main text to the layouts only.
    """
    keys = sampled(pages.select(F.col(key).alias("key"), F.lit("page").alias("kind")), "kind", "key", sample_pages).select("key")
    sample = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).join(F.broadcast(keys), "key")
    rows = sorted({(r["key"], r["html"] or "") for r in sample.distinct().collect()})
    inputs, labels, rng = [], [], np.random.default_rng(11)
    for _, source in rows:
        page = blocks(source)
        marks = ruled(page)
        if marks is not None:
            inputs.append(vectors(page))
            labels.append(marks)
            is_main = marks > 0
        else:
            is_main = np.array([len(b.text.split()) >= 10 and b.linked * 2 < len(b.text) for b in page], bool)
        main = [b.text for b, m in zip(page, is_main) if m]
        other = [b.text for b, m in zip(page, is_main) if not m]
        for _ in range(RELAID if main else 0):
            layout, known = relaid(main, other, rng)
            again = blocks(layout)
            if len(again) == len(known):
                inputs.append(vectors(again))
                labels.append(np.array(known, np.float32))
    labeller = Labeller.fresh()
    if inputs:
        labeller.train(inputs, labels)
    return labeller


def extract(pages: DataFrame, labeller: Labeller, key: str = "page_id", html: str = "html",
            also: list[str] | None = None) -> DataFrame:
    """(key, also..., text, n_chars): the main text of every page, its blocks joined by one blank.

    Every row gives a row, also a repeated one and one with a null key.  Null and
    empty pages, and pages without main text, give an empty text.  Nothing is
    cut, whatever a page's length, depth or broken markup.
    """
    names = [key, *(also or [])]
    source = pages.select(*(F.col(n).alias(f"k{i}") for i, n in enumerate(names)), F.col(html).alias("html"))
    kinds = dict(source.dtypes)
    shared = pages.sparkSession.sparkContext.broadcast(labeller)
    keys = [f"k{i}" for i in range(len(names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [blocks(h) for h in part.column("html").to_pylist()]
                chances = known.chances([vectors(page) for page in found])
                texts = [" ".join(b.text for b, c in zip(page, chance) if c >= 0.5)
                         for page, chance in zip(found, chances)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keys), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], [*keys, "text", "n_chars"])

    schema = ", ".join([*(f"{k} {kinds[k]}" for k in keys), "text string", "n_chars bigint"])
    return mapped(source, run, schema).toDF(*names, "text", "n_chars")
