"""Main text of web pages: a bidirectional LSTM (numpy) labels every text block of a page from the whole page.

A page becomes its sequence of text blocks, each with a tag path (open elements with their class and id words) and its
words. A block's input is its hashed path, its hashed words and its length and link share; the network reads the sequence both ways and
gives each block the probability of being main text. Blocks at 0.5 or more are joined in page order. Long pages go through the
network in chunks that carry its state, so memory does not grow with a page.

There are no labelled pages, so the network is trained here on a bounded sample (``max_pages`` pages of smallest id hash, ``max_blocks``
blocks around the article of each, labelled before the cut) whose
blocks are labelled by the meaning of their elements, and on variants of it: other names for the article's container, its blocks in every
other element that main text uses (lists, tables, quotations, code, captions, headings, an article's own header),
and inserted sidebars, comments, notices, adverts, forms, headers and footers whose words come from the sample's own blocks.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineage_spark.llm.common import hash_sample

TRAIN_PAGES = 160
TRAIN_BLOCKS = 200  # of a training page; scoring reads whole pages
VARIANTS, EPOCHS = 6, 12
PATH_DIMS, LAST_DIMS, WORD_DIMS, HIDDEN = 256, 64, 256, 16
DIMS = PATH_DIMS + LAST_DIMS + WORD_DIMS + 3
THRESHOLD = 0.5
BATCH_CELLS = 60_000  # blocks, padding included, that go through the network at once
CHUNK = 4096  # blocks of a page that go through the network in one piece
CACHED = 50_000

# fixed values: HTML element names by role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr br img".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre section table ul".split())
CLOSES_OWN = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
NEVER_TEXT = frozenset("head title option select button textarea svg object iframe".split())
# fixed values: words of element names, classes, ids and roles that say what an element holds
MAIN_WORDS = frozenset("article main articlebody content post entry story".split())
OTHER_WORDS = frozenset(
    "nav navigation menu footer aside sidebar form ad ads advert advertisement adsbygoogle sponsor sponsored promo banner "
    "comment comments reply replies cookie cookies consent notice notices alert newsletter subscribe signup related recommended "
    "share sharing social breadcrumb breadcrumbs pagination popup modal widget masthead topbar login search toolbar copyright "
    "complementary contentinfo".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b.*?(?:</\1\s*>|\Z)"
    r"|<[/a-zA-Z!?][^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*>|<[/a-zA-Z!?][^>]*(?:>|\Z)", re.S | re.I)
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_LETTERS = re.compile(r"[a-z]+")


_MAIN, _OTHER, _HEADER, _ARTICLE = 1, 2, 4, 8


class Path:
    """An open element and those around it: the slots of all their words as bits of a number, and what the words say.

    A path shares its outer part with its neighbours, so a page nested to any depth costs the same for each element.
    """

    __slots__ = ("outer", "words", "slots", "said")

    def __init__(self, outer: Path | None, words: tuple[str, ...]):
        self.outer, self.words = outer, words
        slots, said = (outer.slots, outer.said) if outer else (0, 0)
        for w in words:
            slots |= 1 << xxhash.xxh32_intdigest(w) % PATH_DIMS
            name = w.lstrip(".")
            said |= (name in MAIN_WORDS) * _MAIN | (name in OTHER_WORDS) * _OTHER | (name == "header") * _HEADER | (name in ("article", "main")) * _ARTICLE
        self.slots, self.said = slots, said

    def all_words(self) -> tuple[str, ...]:
        parts, at = [], self
        while at:
            parts.append(at.words)
            at = at.outer
        return tuple(w for p in reversed(parts) for w in p)


ROOT = Path(None, ())


@dataclass
class Block:
    """A block of text: words of its path (element, class and id names), the innermost element, text and link share."""

    path: Path
    last: str
    text: str
    links: float


def blocks_of(page: str | None) -> list[Block]:
    """The text blocks of a page in order; scripts, styles, comments and the head have none."""
    out: list[Block] = []
    # open elements: (name, path, hides text); how many of a name are open
    stack: list[tuple[str, Path, bool]] = []
    opened: Counter = Counter()
    parts: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text and not (stack and stack[-1][2]):
            last, path = (stack[-1][0], stack[-1][1]) if stack else ("", ROOT)  # inline elements are not on the stack
            out.append(Block(path, last, text, min(1.0, linked / len(text))))
        parts.clear()
        linked = 0

    def close(names: str) -> None:
        wanted = names.split()
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in wanted:
                opened.subtract(s[0] for s in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in ("table", "ul", "ol", "div", "article", "section", "main", "body"):
                return

    page, at = page or "", 0
    for m in _TAG.finditer(page):
        if m.start() > at:
            parts.append(page[at:m.start()])
            if in_link:
                linked += m.start() - at
        at = m.end()
        if m[1] or m[0].startswith(("<!", "<?")):
            continue
        name = _NAME.match(m[0])
        if not name:
            continue
        tag, closing = name[1].lower(), m[0][1] == "/"
        if tag == "a":
            in_link = 0 if closing else 1
        if tag in INLINE:
            if tag in ("br", "img"):
                parts.append(" ")
            continue  # inline elements neither end a block nor belong to its path
        flush()
        if closing:
            if opened[tag] > 0:
                while True:
                    name = stack.pop()[0]
                    opened[name] -= 1
                    if name == tag:
                        break
            continue
        if tag in CLOSES_P:
            if opened["p"] > 0:
                close("p")
        elif tag in CLOSES_OWN:
            close(CLOSES_OWN[tag])
        if tag in VOID or m[0].endswith("/>"):
            continue
        if tag == "body" and opened["head"] > 0:
            stack = [s for s in stack if s[0] != "head"]
            opened["head"] = 0
        said = [w for a in _ATTRIBUTE.finditer(m[0]) for w in _LETTERS.findall(a[2].lower())]
        before = stack[-1][1] if stack else ROOT
        stack.append((tag, Path(before, (tag, *("." + w for w in said))), tag in NEVER_TEXT or bool(stack and stack[-1][2])))
        opened[tag] += 1
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def meaning(path: Path) -> int | None:
    """1: inside an article or main element, 0: inside a menu, advert, form and the like, None: not said."""
    if path.said & _OTHER or path.said & _HEADER and not path.said & _ARTICLE:
        return 0
    return 1 if path.said & _MAIN else None


def weak_labels(blocks: list[Block]) -> np.ndarray:
    """Labels by the meaning of the elements; without any container of main text, the unmarked blocks are main text."""
    said = [meaning(b.path) for b in blocks]
    rest = 0 if 1 in said else 1
    return np.array([rest if s is None else s for s in said], np.float64)


class _Features:
    """Block -> input vector, with caches of the hashed path and words."""

    def __init__(self):
        self.paths: dict[tuple[int, str], np.ndarray] = {}
        self.slots: dict[str, int] = {}

    def _path(self, path: Path, last: str) -> np.ndarray:
        v = self.paths.get((path.slots, last))
        if v is None:
            if len(self.paths) >= CACHED:
                self.paths.clear()
            v = np.zeros(PATH_DIMS + LAST_DIMS, np.float32)
            v[:PATH_DIMS] = np.unpackbits(np.frombuffer(path.slots.to_bytes(PATH_DIMS // 8, "little"), np.uint8), bitorder="little")
            v[PATH_DIMS + xxhash.xxh32_intdigest(last, seed=1) % LAST_DIMS] = 1.0
            self.paths[path.slots, last] = v
        return v

    def _slots(self, words: list[str]) -> list[int]:
        known = self.slots
        try:
            return [known[w] for w in words]
        except KeyError:
            if len(known) > CACHED:
                known.clear()
            return [known.setdefault(w, xxhash.xxh32_intdigest(w, seed=2) % WORD_DIMS) if len(w) < 40 else xxhash.xxh32_intdigest(w, seed=2) % WORD_DIMS
                    for w in words]

    def __call__(self, blocks: list[Block]) -> np.ndarray:
        x = np.zeros((len(blocks), DIMS), np.float32)
        for i, b in enumerate(blocks):
            x[i, :PATH_DIMS + LAST_DIMS] = self._path(b.path, b.last)
            words = b.text.split()
            x[i, PATH_DIMS + LAST_DIMS:-3] = np.bincount(self._slots(words), minlength=WORD_DIMS) / len(words)
            x[i, -3:] = (np.log1p(len(words)) / 5.0, b.links, 1.0)
        return x


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def _forward(x: np.ndarray, mask: np.ndarray, wx: np.ndarray, wh: np.ndarray, keep: bool = False, state: list | None = None):
    """An LSTM over (pages, blocks, dims); masked steps leave the state as it is. A given ``state`` is gone on with and left as it is at the end."""
    pages, steps, _ = x.shape
    n = wh.shape[0]
    h, c = state or (np.zeros((pages, n), x.dtype), np.zeros((pages, n), x.dtype))
    inputs = x @ wx
    out, tape = np.zeros((pages, steps, n), x.dtype), []
    for t in range(steps):
        z = inputs[:, t] + h @ wh
        i, f, o, g = _sigmoid(z[:, :n]), _sigmoid(z[:, n:2 * n] + 1.0), _sigmoid(z[:, 2 * n:3 * n]), np.tanh(z[:, 3 * n:])
        m = mask[:, t, None]
        c_new = f * c + i * g
        th = np.tanh(c_new)
        if keep:
            tape.append((h, c, i, f, o, g, th, m))
        h, c = m * (o * th) + (1 - m) * h, m * c_new + (1 - m) * c
        out[:, t] = h
    if state is not None:
        state[:] = h, c
    return out, tape


def _backward(x: np.ndarray, tape: list, wx: np.ndarray, wh: np.ndarray, d_out: np.ndarray):
    n = wh.shape[0]
    d_wx, d_wh = np.zeros_like(wx), np.zeros_like(wh)
    dh, dc = np.zeros_like(d_out[:, 0]), np.zeros_like(d_out[:, 0])
    for t in range(x.shape[1] - 1, -1, -1):
        h0, c0, i, f, o, g, th, m = tape[t]
        dh = dh + d_out[:, t]
        dh_in, dc_in = dh * m, dc * m
        dc_new = dc_in + dh_in * o * (1 - th * th)
        dz = np.concatenate([dc_new * g * i * (1 - i), dc_new * c0 * f * (1 - f), dh_in * th * o * (1 - o), dc_new * i * (1 - g * g)], axis=1)
        d_wx += x[:, t].T @ dz
        d_wh += h0.T @ dz
        dh = dz @ wh.T + dh * (1 - m)
        dc = dc_new * f + dc * (1 - m)
    return d_wx, d_wh


class Labeller:
    """The network: two LSTMs and a logistic output over both states and the block's own input."""

    NAMES = ("fx", "fh", "bx", "bh", "ow", "oh")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def fresh(seed: int = 9) -> "Labeller":
        r = np.random.default_rng(seed)
        shapes = {"fx": (DIMS, 4 * HIDDEN), "fh": (HIDDEN, 4 * HIDDEN), "bx": (DIMS, 4 * HIDDEN), "bh": (HIDDEN, 4 * HIDDEN),
                  "ow": (DIMS, 1), "oh": (2 * HIDDEN, 1)}
        return Labeller({k: r.standard_normal(s) * (0.5 / np.sqrt(s[0])) for k, s in shapes.items()})

    def _logits(self, x, mask, keep=False):
        w = self.w
        f, tf = _forward(x, mask, w["fx"], w["fh"], keep)
        b, tb = _forward(x[:, ::-1], mask[:, ::-1], w["bx"], w["bh"], keep)
        h = np.concatenate([f, b[:, ::-1]], axis=2)
        return (x @ w["ow"] + h @ w["oh"])[..., 0], h, tf, tb

    def gradients(self, x, mask, y) -> dict[str, np.ndarray]:
        z, h, tf, tb = self._logits(x, mask, True)
        d = ((_sigmoid(z) - y) * mask / mask.sum())[..., None]
        dh = d @ self.w["oh"].T
        fx, fh = _backward(x, tf, self.w["fx"], self.w["fh"], dh[..., :HIDDEN])
        bx, bh = _backward(x[:, ::-1], tb, self.w["bx"], self.w["bh"], dh[:, ::-1, HIDDEN:])
        return {"fx": fx, "fh": fh, "bx": bx, "bh": bh, "ow": np.einsum("ptd,pto->do", x, d), "oh": np.einsum("ptd,pto->do", h, d)}

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 9, rate: float = 0.02) -> "Labeller":
        """Adam on batches of pages of similar length."""
        r, step = np.random.default_rng(seed), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.w.items()} for _ in range(2))
        order = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        batches = [order[i:i + 16] for i in range(0, len(order), 16)]
        for _ in range(epochs):
            for b in r.permutation(len(batches)):
                x, mask, y = _padded([pages[i][0] for i in batches[b]], [pages[i][1] for i in batches[b]])
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.w[k] -= rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        return self

    def probabilities(self, pages: list[list[Block]], features: _Features) -> list[np.ndarray]:
        """One array per page; pages of similar length share a batch of bounded size, longer ones are read in chunks."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
        while order and len(pages[order[-1]]) > CHUNK:
            i = order.pop()
            out[i] = self._in_chunks(pages[i], features)
        while order:
            take = max(1, min(len(order), BATCH_CELLS // len(pages[order[-1]])))
            some, order = order[-take:], order[:-take]
            x, mask, _ = _padded([features(pages[i]) for i in some], None, np.float32)
            p = _sigmoid(self._logits(x, mask)[0])
            for row, i in enumerate(some):
                out[i] = p[row, :len(pages[i])]
        return out

    def _in_chunks(self, blocks: list[Block], features: _Features) -> np.ndarray:
        w, n = {k: v.astype(np.float32) for k, v in self.w.items()}, len(blocks)
        starts, z = range(0, n, CHUNK), np.zeros(n, np.float32)
        for (wx, wh, half), back in ((("fx", "fh", slice(0, HIDDEN)), False), (("bx", "bh", slice(HIDDEN, None)), True)):
            state = [np.zeros((1, HIDDEN), np.float32), np.zeros((1, HIDDEN), np.float32)]
            for at in reversed(starts) if back else starts:
                x = features(blocks[at:at + CHUNK])
                read = x[None, ::-1] if back else x[None]
                h = _forward(read, np.ones(read.shape[:2], np.float32), w[wx], w[wh], state=state)[0][0]
                z[at:at + CHUNK] += ((h[::-1] if back else h) @ w["oh"][half])[:, 0]
                if not back:
                    z[at:at + CHUNK] += (x @ w["ow"])[:, 0]
        return _sigmoid(z)

    def packed(self) -> bytes:
        return b"".join(self.w[k].astype(np.float32).tobytes() for k in self.NAMES)

    @staticmethod
    def unpacked(raw: bytes) -> "Labeller":
        flat, at, out = np.frombuffer(raw, np.float32), 0, {}
        for k, v in Labeller.fresh().w.items():
            out[k] = flat[at:at + v.size].reshape(v.shape)
            at += v.size
        return Labeller(out)


def _padded(xs: list[np.ndarray], ys: list[np.ndarray] | None, kind=np.float64):
    steps = max(len(x) for x in xs)
    x, mask, y = np.zeros((len(xs), steps, DIMS), kind), np.zeros((len(xs), steps), kind), np.zeros((len(xs), steps), kind)
    for i, a in enumerate(xs):
        x[i, :len(a)], mask[i, :len(a)] = a, 1.0
        if ys is not None:
            y[i, :len(a)] = ys[i]
    return x, mask, y


# fixed values: wrappers of inserted blocks (label 0) and containers of the article (label 1), as path words
_INSERTED = tuple(tuple(w.split()) for w in (
    "aside p", "aside .sidebar div p", "div .sidebar ul li", "div .sidebar p", "section .comments div .comment p",
    "div .comments p", "ol .comment .list li p", "ul .comments li", "section #comments p", "article .comment p", "div .reply p",
    "div .cookie .notice p", "div .cookie .banner", "div .notice", "div .alert p", "div .notices p", "form label", "form p",
    "form .newsletter p", "div .subscribe p", "header h1", "header div", "header .site .header p", "div .menu ul li", "nav p",
    "nav div", "div .nav li", "div .related ul li", "div .recommended p", "div .share p", "div .social li", "footer p", "footer ul li",
    "div .footer p", "div .ad p", "div .ads", "div .advert", "div .advertisement p", "ins .adsbygoogle", "div .promo p",
    "div .sponsored p", "div .banner", "div .breadcrumbs li", "div .popup p", "div .modal p", "div .widget p", "div .copyright"))
_CONTAINERS = tuple(tuple(w.split()) for w in (
    "article", "main", "main article", "div .content", "div .post .content", "section .entry", "div .article .body", "div .story",
    "div .post", "div .main", "section .article", "div .page .content"))


# fixed values: elements in which an article's own text stands, below its container
_ELEMENTS = tuple(tuple(w.split()) for w in (
    "p", "p", "ul li", "ul li", "ul li p", "ol li", "ol li p", "ul li ul li", "div ul li", "section ul li", "blockquote", "blockquote p", "pre",
    "div pre", "figure figcaption", "figure pre", "table tr td", "table tbody tr td", "table thead tr th", "table caption", "h1", "h2", "h3", "h4",
    "dl dt", "dl dd", "section p", "section h2", "section section p", "div p", "div div p", "div", "header h1", "header p", "header div p", "details summary",
    "details p", "div h2", "div table tr td", "address"))


def variants(blocks: list[Block], labels: np.ndarray, pool: list[str], own: list[str], r: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A page with another container for its article, its text in other elements, and some inserted blocks that are no main text.

    ``pool`` holds texts of any block, ``own`` texts of main blocks.
    """
    inner = Path(Path(ROOT, ("html",)), ("body",))
    where = Path(inner, _CONTAINERS[r.integers(len(_CONTAINERS))] if r.random() < 0.6 else ("article",))
    element = lambda words: next((w for w in reversed(words) if w[0] != "."), "p")
    share = r.random() if r.random() < 0.7 else 0.0  # of the article's runs that stand in another element
    out, y = [], []

    def insert(inside: bool) -> None:
        path = tuple("." + w[1:] if w[0] == "#" else w for w in _INSERTED[r.integers(len(_INSERTED))])
        at = Path(where if inside else inner, path)
        for _ in range(int(r.integers(1, 7))):
            text = pool[r.integers(len(pool))]
            if r.random() < 0.3:  # short ones too, as the items of menus are
                text = " ".join(text.split()[:int(r.integers(1, 6))])
            out.append(Block(at, element(path), text, float(r.random() < 0.3)))
            y.append(0.0)

    def add(path: tuple[str, ...], text: str, links: float) -> None:
        out.append(Block(Path(where, path), element(path), text, links))
        y.append(1.0)

    run, form = 0, ()
    for b, label in zip(blocks, labels):
        if r.random() < 0.08:
            insert(bool(label))
        words = b.path.all_words() if label else ()
        if label and "article" in words:
            if not run:
                run, form = int(r.integers(1, 6)), _ELEMENTS[r.integers(len(_ELEMENTS))] if r.random() < share else ()
            run -= 1
            if form:
                pieces = b.text.split()
                while pieces and r.random() < 0.7:  # items are short, and there are many
                    n = int(r.integers(1, 14))
                    add(form, " ".join(pieces[:n]), b.links)
                    pieces = pieces[n:]
                if pieces:
                    add(form, " ".join(pieces), b.links)
            else:
                add(words[words.index("article") + 1:] or ("p",), b.text, b.links)
            if r.random() < 0.1:
                extra = _ELEMENTS[r.integers(len(_ELEMENTS))]
                for _ in range(int(r.integers(1, 8))):
                    add(extra, " ".join(own[r.integers(len(own))].split()[:int(r.integers(1, 30))]), float(r.random() < 0.1))
        else:
            out.append(b)
            y.append(float(label))
    insert(False)
    return out, np.array(y)


_PLAIN_PAGE = ("<html><body><nav><ul><li><a>Menu</a></li></ul></nav><article><h1>Title of a text</h1><p>First words of the text.</p>"
               "<p>More words of the text.</p></article><footer>End</footer></body></html>")


def _around_article(blocks: list[Block], labels: np.ndarray, n: int) -> tuple[list[Block], np.ndarray]:
    """``n`` blocks of a labelled page, a quarter of them before its main text."""
    first = int(np.argmax(labels)) if labels.any() else 0
    at = max(0, min(first - n // 4, len(blocks) - n))
    return blocks[at:at + n], labels[at:at + n]


def fit_pages(pages: list[str | None], max_blocks: int = TRAIN_BLOCKS) -> Labeller:
    """Train on the pages and their variants; of a page, ``max_blocks`` labelled blocks around its article are used."""
    r, features = np.random.default_rng(5), _Features()
    parsed = [b for b in map(blocks_of, pages) if b]
    labelled = [_around_article(b, weak_labels(b), max_blocks) for b in parsed]
    plain = blocks_of(_PLAIN_PAGE)
    labelled += [(plain, weak_labels(plain))] * max(0, 16 - len(labelled))  # few pages to learn from: variants of a plain one
    pool = [b.text for p, _ in labelled for b in p]
    own = [b.text for p, y in labelled for b, label in zip(p, y) if label] or pool
    rows = []
    for b, y in labelled:
        rows.append((features(b), y))
        for _ in range(VARIANTS):
            vb, vy = variants(b, y, pool, own, r)
            x = features(vb)
            x[r.random(len(vb)) < 0.3, PATH_DIMS + LAST_DIMS:-3] = 0.0  # the place must tell without the words
            rows.append((x, vy))
    return Labeller.fresh().fit(rows)


def train(pages: DataFrame, page: str = "html", key: str = "page_id", max_pages: int = TRAIN_PAGES, max_blocks: int = TRAIN_BLOCKS) -> Labeller:
    """Fit on at most ``max_pages`` pages, those of smallest id hash, and ``max_blocks`` blocks around the article of each, in one task."""
    sample = hash_sample(pages.select(pages[key].alias("key"), pages[page].alias("html")), max_pages, F.col("key"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        order = sorted(zip(rows["key"].astype(str), rows["html"].fillna("")))
        return pd.DataFrame({"weights": [fit_pages([h for _, h in order], max_blocks).packed()]})

    fitted = sample.groupBy(F.lit(1).alias("one")).applyInPandas(fit, "weights binary").collect()  # one row of weights
    return Labeller.unpacked(bytes(fitted[0]["weights"])) if fitted else fit_pages([])


def main_texts(pages: list[str | None], labeller: Labeller, features: _Features) -> list[str]:
    parsed = [blocks_of(p) for p in pages]
    found = labeller.probabilities(parsed, features)
    return [" ".join(b.text for b, p in zip(blocks, probs) if p >= THRESHOLD) for blocks, probs in zip(parsed, found)]


def extracted(pages: DataFrame, labeller: Labeller, page: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with column ``out``: the main text, empty where there is none (null, empty or menu-only pages).

    Character references are decoded, white space inside a block is one space, blocks are joined by one space. A column
    already named ``out`` is replaced.
    """
    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = _Features()
        for some in batches:
            rows = some.tolist()
            texts = []
            for lo in range(0, len(rows), 256):
                texts += main_texts(rows[lo:lo + 256], labeller, features)
            yield pd.Series(texts, dtype="object")

    return pages.withColumn(out, text_of(pages[page]))
