"""Main text of web pages: leaf blocks labelled by a bidirectional LSTM."""

from __future__ import annotations

import html
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements of HTML by how they break text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
# an open element of the key is closed by the start of one of the values
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
             "th": {"td", "th", "tr"}, "option": {"option"}, "head": {"body"}}
SCOPES = frozenset("table ul ol dl select html body".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                 r"""|<(/?)([a-zA-Z][\w:-]*+)([^>]*)>|<[!?/][^>]*>|<[!?/a-zA-Z][^>]*\Z""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WHITE = re.compile(r"[\x20\x09-\x0D]+")

#: Rows of the two hashed tables, their widths, numeric inputs and units per direction.
PATHS, WORDS, PATH_DIM, WORD_DIM, NUMBERS, UNITS = 2_048, 1_024, 24, 6, 7, 24
#: Pages the labeller is trained on, and passes over them.
TRAIN_PAGES, EPOCHS = 900, 6


@dataclass
class Block:
    """A leaf block: its text, what its tag path says, and the share of its text in links."""
    text: str
    path: tuple[int, ...]
    own: str
    linked: int
    at: int


def _tokens(tag: str, attributes: str) -> list[int]:
    names = [tag]
    for _, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        names += ["." + n.lower() for n in NAME.findall("".join(values))]
    return [zlib.crc32(n.encode()) % PATHS for n in names]


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order: runs of text between block-level tags, character references
    decoded, white space turned into one space. Scripts, styles, comments and other raw elements hold no
    text; open elements that HTML closes by itself are closed."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...]]] = [("", ())]
    parts: list[str] = []
    linked = links = 0
    first: tuple[tuple[int, ...], str, int] | None = None

    def flush() -> None:
        nonlocal first, linked
        if first:
            text = WHITE.sub(" ", "".join(parts)).strip(" ")
            if text:
                out.append(Block(text, first[0], first[1], linked, first[2]))
        parts.clear()
        first, linked = None, 0

    def say(raw: str, at: int) -> None:
        nonlocal first, linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if not first and not text.isspace():
            own = next((t for t, _ in reversed(stack) if t in BLOCK_TAGS), "")
            first = stack[-1][1], own, at
        if links:
            linked += len(text)

    at = 0
    while at < len(page):
        m = TAG.search(page, at)
        if not m:
            say(page[at:], at)
            break
        if m.start() > at:
            say(page[at:m.start()], at)
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCK_TAGS:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if tag not in BLOCK_TAGS and stack[k][0] in BLOCK_TAGS:
                    break
            continue
        if tag in BLOCK_TAGS:
            flush()
            for k in range(len(stack) - 1, 0, -1):
                name = stack[k][0]
                if name == "p" or tag in CLOSED_BY.get(name, ()):
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    if name != "p":
                        break
                elif name in SCOPES or name in BLOCK_TAGS and name not in CLOSED_BY:
                    break
        elif tag == "br":
            parts.append(" ")
        if tag in RAW_TAGS:
            end = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID_TAGS:
            continue
        above = stack[-1][1]
        fresh = [t for t in _tokens(tag, attributes) if t not in above]
        stack.append((tag, above + tuple(dict.fromkeys(fresh)) if fresh else above))
        links += tag == "a"
    flush()
    return out


class WordCodes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = code = zlib.crc32(word.encode()) % WORDS
        return code


def inputs_of(blocks: list[Block], codes: WordCodes) -> tuple[list[tuple[int, ...]], list[np.ndarray], np.ndarray]:
    """Path codes, word codes and numbers of each block."""
    numbers = np.empty((len(blocks), NUMBERS), np.float32)
    words = []
    for k, b in enumerate(blocks):
        own = b.text.lower().split(" ")
        words.append(np.fromiter(map(codes.__getitem__, own), np.int64, len(own)))
        size = len(b.text)
        stops = sum(map(b.text.count, ".!?;,"))
        numbers[k] = (np.log1p(len(own)) / 3, np.log1p(size) / 5, min(b.linked / size, 1.0), stops / len(own),
                      k / len(blocks), b.own in ("h1", "h2", "h3", "h4", "h5", "h6"), b.own in ("li", "option", "td"))
    return [b.path for b in blocks], words, numbers


class Labeller:
    """Hashed embeddings, an LSTM in each direction and a logistic output, in numpy."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        d = PATH_DIM + WORD_DIM + NUMBERS
        s = 1 / np.sqrt(UNITS)
        self.p: dict[str, np.ndarray] = {
            "paths": rng.normal(0, 0.3, (PATHS, PATH_DIM)), "words": rng.normal(0, 0.1, (WORDS, WORD_DIM)),
            "out": rng.uniform(-s, s, (2 * UNITS + d, 1)), "bias": np.zeros(1)}
        for way in "fb":
            self.p["x" + way] = rng.uniform(-s, s, (d, 4 * UNITS))
            self.p["h" + way] = rng.uniform(-s, s, (UNITS, 4 * UNITS))
            self.p["c" + way] = np.concatenate([np.ones(UNITS), np.zeros(3 * UNITS)])
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def inputs(self, paths, words, numbers) -> np.ndarray:
        """The vector of every block of a page."""
        def pooled(table, lists, mean):
            sizes = np.array([len(x) for x in lists])
            flat = np.concatenate([*map(np.asarray, lists), np.empty(0, np.int64)]).astype(np.int64)
            total = np.zeros((len(lists), table.shape[1]), np.float32)
            some = np.flatnonzero(sizes)
            if len(some):
                total[some] = np.add.reduceat(table[flat], (np.cumsum(sizes) - sizes)[some], axis=0)
            return total / np.maximum(sizes, 1)[:, None] if mean else total
        return np.hstack([pooled(self.p["paths"], paths, False), pooled(self.p["words"], words, True), numbers])

    def run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool = False):
        """One direction over (time, batch, input); ``keep`` returns what the backward pass needs."""
        steps, batch, _ = x.shape
        wx, wh, b = self.p["x" + way], self.p["h" + way], self.p["c" + way]
        pre = x @ wx + b
        h = np.zeros((batch, UNITS), np.float32)
        c = np.zeros((batch, UNITS), np.float32)
        out = np.zeros((steps, batch, UNITS), np.float32)
        tape = []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ wh
            gates = 1 / (1 + np.exp(-np.clip(z[:, :3 * UNITS], -30, 30)))
            f, i, o = gates[:, :UNITS], gates[:, UNITS:2 * UNITS], gates[:, 2 * UNITS:]
            g = np.tanh(z[:, 3 * UNITS:])
            m = mask[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            h2 = o * tc
            if keep:
                tape.append((t, h, c, f, i, o, g, tc, m))
            c = np.where(m, c2, c)
            h = np.where(m, h2, h)
            out[t] = h
        return (out, tape) if keep else out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.run(x, mask, "f"), self.run(x, mask, "b"), x], axis=2)
        return (both @ self.p["out"])[:, :, 0] + self.p["bias"][0]

    def gradients(self, x, mask, y) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the summed log loss for the weights, and for the inputs."""
        grad: dict[str, np.ndarray] = {}
        fwd, tape_f = self.run(x, mask, "f", True)
        bwd, tape_b = self.run(x, mask, "b", True)
        both = np.concatenate([fwd, bwd, x], axis=2)
        s = (both @ self.p["out"])[:, :, 0] + self.p["bias"][0]
        err = ((1 / (1 + np.exp(-np.clip(s, -30, 30))) - y) * mask)[:, :, None].astype(np.float32)
        grad["out"] = np.einsum("tbi,tbj->ij", both, err)
        grad["bias"] = err.sum((0, 1))
        back = err @ self.p["out"].T
        dx = back[:, :, 2 * UNITS:].copy()
        for way, tape, dout in (("f", tape_f, back[:, :, :UNITS]), ("b", tape_b, back[:, :, UNITS:2 * UNITS])):
            wx, wh = self.p["x" + way], self.p["h" + way]
            gx, gh, gb = np.zeros_like(wx), np.zeros_like(wh), np.zeros_like(self.p["c" + way])
            dh = np.zeros((x.shape[1], UNITS), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, f, i, o, g, tc, m in reversed(tape):
                dh = dh + dout[t]
                dc2 = dc + dh * o * (1 - tc * tc)
                dz = np.hstack([dc2 * c * f * (1 - f), dc2 * g * i * (1 - i), dh * tc * o * (1 - o),
                                dc2 * i * (1 - g * g)]) * m
                gx += x[t].T @ dz
                gh += h.T @ dz
                gb += dz.sum(0)
                dx[t] += dz @ wx.T
                dh = np.where(m, dz @ wh.T, dh)
                dc = np.where(m, dc2 * f, dc)
            grad["x" + way], grad["h" + way], grad["c" + way] = gx, gh, gb
        return grad, dx

    def label(self, pages: list[tuple]) -> list[np.ndarray]:
        """Probability of main text for the blocks of each page; pages of like length run together."""
        out: list[np.ndarray] = [np.empty(0)] * len(pages)
        order = sorted((k for k, p in enumerate(pages) if len(p[2])), key=lambda k: len(pages[k][2]))
        while order:
            longest = len(pages[order[-1]][2])
            group = [order.pop() for _ in range(min(len(order), max(1, 16_384 // longest)))]
            x, mask, _ = self.padded([pages[k] for k in group])
            p = 1 / (1 + np.exp(-np.clip(self.scores(x, mask), -30, 30)))
            for col, k in enumerate(group):
                out[k] = p[:len(pages[k][2]), col]
        return out

    def padded(self, pages: list[tuple]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        vectors = [self.inputs(*p[:3]) for p in pages]
        steps = max(len(v) for v in vectors)
        x = np.zeros((steps, len(pages), vectors[0].shape[1]), np.float32)
        mask = np.zeros((steps, len(pages)), bool)
        for k, v in enumerate(vectors):
            x[:len(v), k] = v
            mask[:len(v), k] = True
        return x, mask, vectors

    def fit(self, pages: list[tuple], epochs: int, batch: int = 24, rate: float = 0.01, seed: int = 4) -> None:
        """Adam on the log loss of ``pages`` (paths, words, numbers, labels)."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), batch):
                group = [pages[k] for k in order[at:at + batch]]
                x, mask, _ = self.padded(group)
                y = np.zeros(mask.shape, np.float32)
                for col, p in enumerate(group):
                    y[:len(p[3]), col] = p[3]
                grad, dx = self.gradients(x, mask, y)
                gp, gw = np.zeros_like(self.p["paths"]), np.zeros_like(self.p["words"])
                for col, p in enumerate(group):
                    for t, (path, words) in enumerate(zip(p[0], p[1])):
                        gp[list(path)] += dx[t, col, :PATH_DIM]
                        np.add.at(gw, words, dx[t, col, PATH_DIM:PATH_DIM + WORD_DIM] / len(words))
                grad["paths"], grad["words"] = gp, gw
                step += 1
                speed = rate * (1 - epoch / epochs)
                for k, g in grad.items():
                    g = g / mask.sum()
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.99 * v2[k] + 0.01 * g * g
                    self.p[k] = self.p[k] - (speed * (m[k] / (1 - 0.9 ** step))
                                             / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)


# ---------------------------------------------------------------------------
# Training pages, drawn from a grammar of layouts
# ---------------------------------------------------------------------------

# Names that page layouts commonly use.
MAIN_NAMES = ("article content post entry story main-content article-body post-content entry-content story-body text "
              "page-content news-article blog-post").split()
PLAIN_NAMES = "wrapper container row page site inner column layout grid col-md-8 box block section".split()
EXTRA_NAMES = {
    "ad": "ad ads advert advertisement ad-banner sponsored promo google-ad sponsor banner-ad adbox".split(),
    "menu": "menu nav navbar navigation main-menu topnav breadcrumbs breadcrumb pagination tabs toc".split(),
    "header": "header masthead site-header top-bar topbar branding logo site-title".split(),
    "footer": "footer site-footer bottom copyright foot legal colophon".split(),
    "sidebar": "sidebar side widget related related-posts recommended trending most-read popular tags categories".split(),
    "notice": "notice cookie cookie-banner consent gdpr alert message popup modal newsletter subscribe paywall".split(),
    "share": "share social social-links follow sharing byline meta post-meta author-box".split(),
    "comments": "comments comment comment-list disqus responses replies discussion comment-body reply".split(),
}
SEMANTIC = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "ad": "aside", "notice": "dialog"}
EXTRA_WORDS = {
    "ad": "advertisement sponsored buy now shop sale offer", "menu": "home about contact products news login",
    "header": "welcome search sign in menu", "footer": "copyright all rights reserved privacy terms contact",
    "sidebar": "related popular read more latest articles tags", "notice": "we use cookies accept subscribe newsletter",
    "share": "share tweet facebook posted by on", "comments": "reply says comment posted ago like report"}


class PageGrammar:
    """Draws pages with their main text's character ranges."""

    def __init__(self, rng: random.Random):
        self.rng = rng
        self.parts: list[str] = []
        self.size = 0
        self.main: list[tuple[int, int]] = []
        letters = rng.choice(["aeiounrtls", "aeiouthndsrl", "eniräöüstch", "éèaeiouqurts"])
        self.stock = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(150)]

    def put(self, text: str, label: bool = False) -> None:
        if label:
            self.main.append((self.size, self.size + len(text)))
        self.parts.append(text)
        self.size += len(text)

    def words(self, low: int, high: int) -> str:
        rng = self.rng
        text = " ".join(rng.choice(self.stock) for _ in range(rng.randint(low, high)))
        style = rng.random()
        if style < 0.08:
            text = " ".join(w + rng.choice(["***", "%%%", "$$$", "###", "&amp;&amp;"]) for w in text.split())
        elif style < 0.12:
            text = " | ".join(text.split())
        elif style < 0.16:
            text = text.upper().replace(" ", "!! ")
        elif style < 0.7:
            text = re.sub(r"(\w+ \w+ \w+ \w+)", r"\1.", text).capitalize() + "."
        return text

    def named(self, names: list[str], tag: str = "div") -> str:
        rng = self.rng
        kind = rng.choice(["class", "class", "id"])
        extra = " " + rng.choice(PLAIN_NAMES) if rng.random() < 0.3 else ""
        return f'<{tag} {kind}="{rng.choice(names)}{extra}">'

    def links(self, n: int, words: str) -> None:
        rng = self.rng
        if rng.random() < 0.7:
            self.put("<ul>" + "".join(f'<li><a href="/{k}">{rng.choice(words.split() + self.stock)}</a></li>'
                                      for k in range(n)) + "</ul>")
        else:
            self.put(" | ".join(f'<a href="/{k}">{self.words(1, 3)}</a>' for k in range(n)))

    def extra(self, kind: str) -> None:
        """One piece of boilerplate; its text has no label."""
        rng = self.rng
        semantic = kind in SEMANTIC and rng.random() < 0.5
        tag = SEMANTIC[kind] if semantic else rng.choice(["div", "div", "section", "ul" if kind == "menu" else "div"])
        bare = semantic and rng.random() < 0.6
        self.put(f"<{tag}>" if bare else self.named(EXTRA_NAMES[kind], tag))
        stock = EXTRA_WORDS[kind].split()
        lead = " ".join(rng.choice(stock) for _ in range(rng.randint(0, 4)))
        if kind != "menu" and rng.random() < 0.35:
            tag_h = rng.choice(["h1", "h2", "h3", "h4"]) if kind == "header" else rng.choice(["h2", "h3", "h4"])
            self.put(f"<{tag_h}>{lead} {self.words(1, 5)}</{tag_h}>")
        if kind == "menu":
            self.links(rng.randint(2, 9), EXTRA_WORDS[kind])
        elif kind == "comments":
            for _ in range(rng.randint(1, 5)):
                self.put((self.named(EXTRA_NAMES[kind]) if rng.random() < 0.6 else "<div>")
                         + f"<p>{lead} {self.words(2, 50)}</p></div>")
        elif kind == "notice" and rng.random() < 0.5 or kind == "header" and rng.random() < 0.3:
            self.put(f'<form action="/"><label>{lead} {self.words(1, 4)}</label><input name="q">'
                     f"<button>{self.words(1, 2)}</button></form>")
        elif kind == "footer":
            self.put(f"&copy; {rng.choice(self.stock)}.example.com &middot; {lead} {self.words(1, 12)}")
        else:
            if rng.random() < 0.4:
                self.links(rng.randint(1, 5), EXTRA_WORDS[kind])
            body = self.words(1, rng.choice([5, 15, 40]))
            self.put(f"<p>{lead} {body}</p>" if rng.random() < 0.6 else f"{lead} {body}")
        self.put(f"</{tag}>")

    def body(self) -> None:
        """The article: headings, paragraphs and lists are main text; what stands between may not be."""
        rng = self.rng
        if rng.random() < 0.8:
            self.put("<h1>")
            self.put(self.words(1, 12), True)
            self.put("</h1>")
        if rng.random() < 0.15:
            self.extra("share")
        for _ in range(rng.choice([1, 2, 4, 8, 14, 25])):
            kind = rng.random()
            if kind < 0.72:
                self.put(rng.choice(["<p>", "<p>", "<p>", "<p><b>", '<p class="lead">', '<p class="text">', "<div>"])
                         if rng.random() < 0.95 else "<br>")
                opened = self.parts[-1]
                self.put(self.words(1, rng.choice([1, 4, 15, 60, 120])), True)
                self.put({"<div>": "</div>", "<br>": "<br>", "<p><b>": rng.choice(["<br>", "</b></p>"])}.get(
                    opened, rng.choice(["</p>", "</p>", "</p>", ""])))
            elif kind < 0.8:
                tag = rng.choice(["h2", "h3", "blockquote", "pre", "figcaption"])
                self.put(f"<{tag}>")
                self.put(self.words(1, 9), True)
                self.put(f"</{tag}>")
            elif kind < 0.9:
                tag = rng.choice(["ul", "ol"])
                self.put(f"<{tag}>")
                for _ in range(rng.randint(1, 5)):
                    self.put("<li>")
                    self.put(self.words(1, 20), True)
                    self.put("</li>")
                self.put(f"</{tag}>")
            elif kind < 0.94:
                self.put("<table><tr>")
                for _ in range(rng.randint(1, 4)):
                    self.put("<td>")
                    self.put(self.words(1, 8), True)
                    self.put("</td>")
                self.put("</tr></table>")
            else:
                self.extra(rng.choice(["ad", "share", "sidebar", "notice"]))

    def page(self) -> tuple[str, list[tuple[int, int]]]:
        rng = self.rng
        self.put(f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style>"
                 f"<script>var t=1;</script></head><body>")
        wrap = rng.random() < 0.4
        if wrap:
            self.put(self.named(PLAIN_NAMES))
        for kind in ("notice", "header", "menu", "menu", "ad", "sidebar"):
            if rng.random() < {"menu": 0.6, "header": 0.5, "ad": 0.4}.get(kind, 0.2):
                self.extra(kind)
        shape = rng.random()
        if shape < 0.45:
            open_, close = "<article>", "</article>"
        elif shape < 0.6:
            open_, close = "<main>", "</main>"
        elif shape < 0.9:
            open_, close = self.named(MAIN_NAMES, rng.choice(["div", "section", "article"])), None
            close = f"</{open_[1:].split()[0]}>"
        else:
            open_, close = "", ""
        self.put(open_)
        self.body()
        inside = rng.random() < 0.4
        if not inside:
            self.put(close)
        for kind in ("share", "ad", "sidebar", "comments"):
            if rng.random() < 0.3:
                self.extra(kind)
        if inside:
            self.put(close)
        for kind in ("sidebar", "ad", "footer", "notice"):
            if rng.random() < {"footer": 0.8}.get(kind, 0.2):
                self.extra(kind)
        if wrap:
            self.put("</div>")
        if rng.random() < 0.9:
            self.put("</body></html>")
        return "".join(self.parts), self.main


def train(pages: int = TRAIN_PAGES, epochs: int = EPOCHS, seed: int = 11) -> Labeller:
    """A labeller trained on ``pages`` pages drawn from the grammar of layouts. No labelled web pages are
    given; the drawn ones know which text is the article. The result depends on the seed only."""
    codes = WordCodes()
    drawn = []
    for k in range(pages):
        page, main = PageGrammar(random.Random(seed * 100_003 + k)).page()
        blocks = blocks_of(page)
        labels = np.array([any(a <= b.at < z for a, z in main) for b in blocks], np.float32)
        if blocks:
            drawn.append((*inputs_of(blocks, codes), labels))
    model = Labeller()
    model.fit(drawn, epochs)
    return model


def extract(pages: DataFrame, model: Labeller, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
            ) -> DataFrame:
    """``page_id, url, text, n_chars`` per input row: the blocks labelled main text, joined by a space.

    Every block of the whole page is labelled with the whole page as context. Null or empty pages give
    empty text; repeated rows and null identifiers are kept; an empty table gives no rows. A very
    long page is one sequence and bounds a task's memory.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = WordCodes()
        for batch in batches:
            texts = []
            for at in range(0, len(batch), 256):
                found = [blocks_of(h) if h else [] for h in batch["html"].iloc[at:at + 256]]
                labels = model.label([inputs_of(b, codes) for b in found])
                texts += [" ".join(x.text for x, p in zip(b, label) if p >= 0.5) for b, label in zip(found, labels)]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts,
                                "n_chars": [len(t) for t in texts]})

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = pages.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars long")
