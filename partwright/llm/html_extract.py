"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks, the texts between block-level tags.  A bidirectional
LSTM reads the blocks of a page in order, each as a vector of its tag path (tags, classes,
ids, roles), of hashed words and of a few measures, and says of each whether it is main
text, so every decision sees the whole page.  The network is trained in some seconds on
pages generated from a grammar of layouts, with the same seed on every run; its weights
are of fixed size and go to the tasks with the function.
"""

from __future__ import annotations

import functools
import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partwright.llm.common import byte_slices, quoted, set_aside

PATH_DIMS, WORD_DIMS, MEASURES = 160, 48, 8
HIDDEN = 20
TRAINING_PAGES = 1400
EPOCHS = 13
SLICE_BYTES = 4 << 20
# Blocks labelled at a time; a longer page is labelled alone.
BATCH_BLOCKS = 8192

INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr"
    # formulas are read as part of their sentence
    " math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle"
    " msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Code, up to the end tag whatever stands in between.
RAW = frozenset("script style".split())
# Not shown as text of the page, up to the end tag.  One that is never closed ends at the next block-level tag.
SKIPPED = frozenset("noscript template textarea title iframe svg object select annotation annotation-xml".split())
NESTING = frozenset("template svg object".split())
# These stand within a sentence.
WITHIN = frozenset("annotation annotation-xml".split())
# A start tag of the key ends an open element of the values.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}

_TAG = re.compile(
    r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)(?:>|[^>]*(?:>|\Z)))",
    re.DOTALL,
)
_SKIPPED = re.compile(rf"<(/?)({'|'.join(sorted(SKIPPED, key=len, reverse=True))})(?=[\s/>])[^>]*>?", re.IGNORECASE)
_BLOCK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|center|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form"
    r"|h[1-6]|header|hr|html|li|main|menu|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)(?=[\s/>])",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")
_WORDS = re.compile(r"\w+")
_STOPS = re.compile(r"[.!?,;:]")


@functools.lru_cache(maxsize=20_000)
def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    """What a tag adds to the path."""
    out = [f"t:{tag}"]
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        out += [f"c:{w}" for w in _PART.findall((a or b or c).lower())]
    if _HIDDEN.search(attributes):
        out.append("c:hidden")
    return tuple(out)


def _closed(page: str) -> dict[int, int]:
    """Start of each element of SKIPPED that is closed, and the end of its end tag; one pass over the page."""
    ends: dict[int, int] = {}
    waiting: dict[str, list[int]] = {}
    for tag in _SKIPPED.finditer(page):
        name = tag[2].lower()
        starts = waiting.setdefault(name, [])
        if tag[1]:
            if starts:
                ends[starts.pop()] = tag.end()
        elif not tag[0].endswith("/>"):
            if name not in NESTING:
                starts.clear()  # a second start tag: the first was never closed
            starts.append(tag.start())
    return ends


def leaf_blocks(page: str) -> list[tuple[str, tuple, int]]:
    """(text, path marks, characters in links) of the leaf blocks of a page, in order.

    Character references are decoded and white space is one space; blocks without text are left out.
    What is not shown (SKIPPED) is left out up to its end tag; where that is missing, up to the next
    block-level tag, so a page with an unclosed element loses none of its blocks.
    """
    blocks: list[tuple[str, tuple, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    text: list[str] = []
    linked, links, at, end = 0, 0, 0, len(page)
    closed: dict[int, int] | None = None
    more_blocks = True

    def close():
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                blocks.append((joined, tuple(m for t, ms in stack for m in ms if t not in INLINE), linked))
            text.clear()
        linked = 0

    while at < end:
        found = _TAG.search(page, at)
        chunk = page[at : found.start() if found else end]
        if chunk:
            chunk = html.unescape(chunk) if "&" in chunk else chunk
            text.append(chunk)
            if links:
                linked += len(chunk.strip())
        if not found:
            break
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            elif tag == "a":
                links = 0 if found[1] else 1
            continue
        if tag not in WITHIN:
            close()
        if found[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    links = 0
                    break
        elif tag in RAW:
            if not found[3].rstrip().endswith("/"):
                ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = ended.end() if ended else end
        elif tag in SKIPPED and not found[3].rstrip().endswith("/"):
            closed = _closed(page) if closed is None else closed
            stop = closed.get(found.start())
            if stop is None and more_blocks:
                block = _BLOCK.search(page, at)
                stop, more_blocks = (block.start(), True) if block else (None, False)
            if stop is None:
                stack.append((tag, _marks(tag, found[3])))
            else:
                at = max(at, stop)
        elif tag not in VOID:
            shut = CLOSES.get(tag, ())
            if stack and (stack[-1][0] == "p" or stack[-1][0] in shut):
                stack.pop()
            stack.append((tag, _marks(tag, found[3])))
    close()
    return blocks


@functools.lru_cache(maxsize=50_000)
def _path_buckets(path: tuple[str, ...]) -> np.ndarray:
    marks = set(path)
    if path:
        marks.add("last " + next((m for m in reversed(path) if m[0] == "t"), ""))
    return np.array(sorted({zlib.crc32(m.encode()) % PATH_DIMS for m in marks}), np.int64)


@functools.lru_cache(maxsize=200_000)
def _word_bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % WORD_DIMS


def block_vectors(blocks: list[tuple[str, tuple, int]], first: int = 0, total: int | None = None) -> np.ndarray:
    """One row for each block; ``first`` and ``total`` place a piece within its page."""
    total = len(blocks) if total is None else total
    out = np.zeros((len(blocks), PATH_DIMS + WORD_DIMS + MEASURES), np.float32)
    for i, (text, path, linked) in enumerate(blocks):
        out[i, _path_buckets(path)] = 1.0
        words = _WORDS.findall(text.lower())
        if words:
            counts = np.bincount([_word_bucket(w) for w in words], minlength=WORD_DIMS)
            out[i, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.sqrt(counts / len(words))
        size = len(text)
        out[i, PATH_DIMS + WORD_DIMS :] = (
            np.log1p(size) / 8,
            np.log1p(len(words)) / 6,
            min(1.0, linked / size),
            min(1.0, 10 * len(_STOPS.findall(text)) / size),
            float(text[-1] in ".!?\"'”’)"),
            float("©" in text),
            (first + i) / total,
            min(1.0, len(path) / 16),
        )
    return out


# ---------------------------------------------------------------- network


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _direction(x, mask, wx, wh, b, keep: bool):
    """LSTM states over (time, batch, dims); padded steps leave the state as it is."""
    steps, batch, _ = x.shape
    n = wh.shape[0]
    h, c = np.zeros((batch, n), x.dtype), np.zeros((batch, n), x.dtype)
    gates = (x.reshape(steps * batch, -1) @ wx + b).reshape(steps, batch, 4 * n)
    out, kept = np.zeros((steps, batch, n), x.dtype), []
    for t in range(steps):
        z = gates[t] + h @ wh
        i, f, o = (_sigmoid(z[:, k * n : (k + 1) * n]) for k in range(3))
        g = np.tanh(z[:, 3 * n :])
        m = mask[t][:, None]
        new_c = f * c + i * g
        tanh_c = np.tanh(new_c)
        if keep:
            kept.append((h, c, i, f, o, g, tanh_c, m))
        h = m * (o * tanh_c) + (1 - m) * h
        c = m * new_c + (1 - m) * c
        out[t] = h
    return out, kept


def _direction_back(x, d_out, kept, wx, wh):
    steps, batch, dims = x.shape
    n = wh.shape[0]
    dz_all = np.zeros((steps, batch, 4 * n), x.dtype)
    dh, dc = np.zeros((batch, n), x.dtype), np.zeros((batch, n), x.dtype)
    d_wh = np.zeros_like(wh)
    for t in reversed(range(steps)):
        h, c, i, f, o, g, tanh_c, m = kept[t]
        dh = dh + d_out[t]
        go = m * dh
        d_new = m * dc + go * o * (1 - tanh_c**2)
        dz = np.concatenate(
            [d_new * g * i * (1 - i), d_new * c * f * (1 - f), go * tanh_c * o * (1 - o), d_new * i * (1 - g**2)], axis=1
        )
        dz_all[t] = dz
        d_wh += h.T @ dz
        dh, dc = (1 - m) * dh + dz @ wh.T, (1 - m) * dc + d_new * f
    flat = dz_all.reshape(steps * batch, 4 * n)
    return x.reshape(steps * batch, dims).T @ flat, d_wh, flat.sum(axis=0)


def _forward(x, mask, p, keep=False):
    ahead, kept_a = _direction(x, mask, p["wx0"], p["wh0"], p["b0"], keep)
    back, kept_b = _direction(x[::-1], mask[::-1], p["wx1"], p["wh1"], p["b1"], keep)
    both = np.concatenate([ahead, back[::-1]], axis=2)
    return both @ p["wo"] + p["bo"], both, kept_a, kept_b


def _padded(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(v) for v in vectors)
    x = np.zeros((steps, len(vectors), vectors[0].shape[1]), np.float32)
    mask = np.zeros((steps, len(vectors)), np.float32)
    for k, v in enumerate(vectors):
        x[: len(v), k] = v
        mask[: len(v), k] = 1
    return x, mask


def label_blocks(pages: list[np.ndarray], weights: dict) -> list[np.ndarray]:
    """Probability of main text for each block of each page."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
    while order:
        longest, batch = 0, []
        while order and (not batch or len(pages[order[0]]) * (len(batch) + 1) <= BATCH_BLOCKS):
            batch.append(order.pop(0))
            longest = len(pages[batch[-1]])
        x, mask = _padded([pages[k] for k in batch])
        logits = _forward(x, mask, weights)[0]
        for column, k in enumerate(batch):
            out[k] = _sigmoid(logits[: len(pages[k]), column])
    return out


def _states(x: np.ndarray, wx, wh, b, state):
    """Hidden states of one direction over one piece of a page, and the state to go on with."""
    n = wh.shape[0]
    h, c = state
    gates, out = x @ wx + b, np.zeros((len(x), n), x.dtype)
    for t in range(len(x)):
        z = gates[t] + h @ wh
        i, f, o = (_sigmoid(z[k * n : (k + 1) * n]) for k in range(3))
        c = f * c + i * np.tanh(z[3 * n :])
        h = o * np.tanh(c)
        out[t] = h
    return out, (h, c)


def label_long_page(blocks: list[tuple[str, tuple, int]], weights: dict, piece: int = BATCH_BLOCKS) -> np.ndarray:
    """Probabilities as :func:`label_blocks` gives them, with the vectors of one piece of the page at a time.

    The states pass from piece to piece, ahead and then back, so every decision sees the whole page.
    """
    n, hidden = len(blocks), weights["wh0"].shape[0]
    logits = np.full(n, weights["bo"][0], np.float32)
    cuts = [(a, min(n, a + piece)) for a in range(0, n, piece)]
    zero = (np.zeros(hidden, np.float32), np.zeros(hidden, np.float32))
    state = zero
    for a, b in cuts:
        x = block_vectors(blocks[a:b], a, n)
        out, state = _states(x, weights["wx0"], weights["wh0"], weights["b0"], state)
        logits[a:b] += out @ weights["wo"][:hidden]
    state = zero
    for a, b in reversed(cuts):
        x = block_vectors(blocks[a:b], a, n)[::-1]
        out, state = _states(x, weights["wx1"], weights["wh1"], weights["b1"], state)
        logits[a:b] += (out @ weights["wo"][hidden:])[::-1]
    return _sigmoid(logits)


def labelled(pages: list[list[tuple[str, tuple, int]]], weights: dict) -> list[np.ndarray]:
    """Probabilities for the blocks of each page; holds the vectors of a few thousand blocks at a time."""
    out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
    group: list[int] = []
    held = 0

    def flush():
        for k, p in zip(group, label_blocks([block_vectors(pages[k]) for k in group], weights), strict=True):
            out[k] = p
        group.clear()

    for k, page in enumerate(pages):
        if len(page) > BATCH_BLOCKS:
            out[k] = label_long_page(page, weights)
            continue
        group.append(k)
        held += len(page)
        if held > 4 * BATCH_BLOCKS:
            flush()
            held = 0
    flush()
    return out


def train_network(pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 7) -> dict:
    """Weights after Adam steps on the mean cross-entropy of (vectors, labels) pages."""
    rng = np.random.default_rng(seed)
    dims = pages[0][0].shape[1]
    p = {}
    for k in (0, 1):
        p[f"wx{k}"] = rng.normal(0, 0.15, (dims, 4 * HIDDEN)).astype(np.float32)
        p[f"wh{k}"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
        p[f"b{k}"] = np.zeros(4 * HIDDEN, np.float32)
        p[f"b{k}"][HIDDEN : 2 * HIDDEN] = 1.0
    p["wo"], p["bo"] = rng.normal(0, 0.2, 2 * HIDDEN).astype(np.float32), np.zeros(1, np.float32)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step, batch = 0, 28
    for epoch in range(epochs):
        order = sorted(rng.permutation(len(pages)), key=lambda k: len(pages[k][0]) // 6)
        batches = [order[a : a + batch] for a in range(0, len(order), batch)]
        for k in rng.permutation(len(batches)):
            chosen = [pages[j] for j in batches[k]]
            x, mask = _padded([v for v, _ in chosen])
            y = np.zeros_like(mask)
            for c, (_, labels) in enumerate(chosen):
                y[: len(labels), c] = labels
            # Words and marks are dropped at random, so that no single one decides.
            x = x * (rng.random(x.shape[1:])[None] > 0.08) * (mask[..., None])
            x = x.astype(np.float32)
            logits, both, kept_a, kept_b = _forward(x, mask, p, keep=True)
            error = ((_sigmoid(logits) - y) * mask / mask.sum()).astype(np.float32)
            grads = {"wo": np.einsum("tb,tbh->h", error, both), "bo": error.sum(keepdims=True).ravel()}
            d_both = error[..., None] * p["wo"]
            grads["wx0"], grads["wh0"], grads["b0"] = _direction_back(x, d_both[..., :HIDDEN], kept_a, p["wx0"], p["wh0"])
            grads["wx1"], grads["wh1"], grads["b1"] = _direction_back(
                x[::-1], d_both[::-1, :, HIDDEN:], kept_b, p["wx1"], p["wh1"]
            )
            step += 1
            rate = 0.01 * (0.3 if epoch >= epochs - 3 else 1.0)
            for name, g in grads.items():
                g = np.clip(g, -1, 1)
                first[name] = 0.9 * first[name] + 0.1 * g
                second[name] = 0.99 * second[name] + 0.01 * g * g
                p[name] = p[name] - (
                    rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7)
                ).astype(np.float32)
    return p


# ---------------------------------------------------------------- training pages

_MAIN = "\x02"  # marks main text in generated pages
_SYLLABLES = "an be co da en fi go ha il ju ka le mo na on pe qui ra so tu un ve wi xo ya zu ßer éan ción üng".split()
_SITE_WORDS = (
    "home about contact login register subscribe newsletter privacy terms cookies accept share tweet follow related"
    " popular next previous menu search sitemap archive category tags copyright rights reserved advertisement sponsored"
    " promoted comments reply comment posted sign up more read"
).split()


class _PageMaker:
    """Random pages from a grammar of layouts."""

    def __init__(self, seed: int):
        self.rng = np.random.default_rng(seed)

    def pick(self, *options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int, site: float = 0.0) -> str:
        out = []
        for _ in range(int(self.rng.integers(low, high + 1))):
            if self.rng.random() < site:
                out.append(self.pick(*_SITE_WORDS))
            else:
                out.append("".join(self.pick(*_SYLLABLES) for _ in range(int(self.rng.integers(1, 4)))))
        return " ".join(out)

    def sentences(self, low: int, high: int) -> str:
        n = int(self.rng.integers(low, high + 1))
        return " ".join(self.words(2, 14).capitalize() + self.pick(".", ".", ".", "?", "!", ", &amp; so.") for _ in range(n))

    def attribute(self, *names: str) -> str:
        name = self.pick(*names)
        if self.chance(0.2):
            name += self.pick(" box", " row", " clearfix", "-wrapper", " c12", " grid", "-inner", " module")
        kind = self.pick("class", "class", "id")
        return f' {kind}="{name}"'

    def items(self, tag: str, low: int, high: int, site: float) -> str:
        n = int(self.rng.integers(low, high + 1))
        link = self.chance(0.8)
        return "".join(
            f"<{tag}>" + (f'<a href="/x{k}">{self.words(1, 3, site)}</a>' if link else self.words(1, 3, site)) + f"</{tag}>"
            for k in range(n)
        )

    # Parts that are not main text.

    def menu(self) -> str:
        body = f"<ul>{self.items('li', 2, 9, 0.4)}</ul>" if self.chance(0.8) else self.items("a", 2, 7, 0.4).replace("</a><a", "</a> <a")
        if self.chance(0.6):
            return f"<nav{self.pick('', self.attribute('menu', 'main-nav', 'topnav'))}>{body}</nav>"
        return f"<div{self.attribute('menu', 'nav', 'navbar', 'navigation', 'main-menu', 'breadcrumb', 'breadcrumbs', 'topbar')}>{body}</div>"

    def header(self) -> str:
        inside = self.pick(f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(2, 8, 0.2)}</p>", f"<div>{self.words(1, 5, 0.2)}</div>", f"<h2>{self.words(1, 4)}</h2>")
        inside += self.pick("", self.menu(), f"<p>{self.words(3, 9)}</p>", self.form())
        if self.chance(0.6):
            return f"<header>{inside}</header>"
        return f"<div{self.attribute('header', 'site-header', 'masthead', 'page-header', 'top', 'branding', 'logo')}>{inside}</div>"

    def footer(self) -> str:
        inside = self.pick("", "&copy; ", "© ", "Copyright ") + self.pick("www.", "") + self.words(1, 2).replace(" ", "") + ".example.com &middot; " + self.sentences(1, 2)
        inside = self.pick(inside, f"<p>{inside}</p>", f"<p>{inside}</p><ul>{self.items('li', 2, 6, 0.5)}</ul>", f"<p>{inside}</p><p>{self.sentences(1, 3)}</p>")
        if self.chance(0.7):
            return f"<footer>{inside}</footer>"
        return f"<div{self.attribute('footer', 'site-footer', 'page-footer', 'bottom', 'copyright', 'foot')}>{inside}</div>"

    def sidebar(self) -> str:
        inside = "".join(
            self.pick(
                f"<h3>{self.words(1, 3, 0.4)}</h3><ul>{self.items('li', 2, 7, 0.2)}</ul>",
                f"<p>{self.sentences(1, 3)}</p>",
                f"<div><h4>{self.words(1, 3)}</h4><p>{self.sentences(1, 2)}</p></div>",
                f"{self.sentences(1, 3)}",
            )
            for _ in range(int(self.rng.integers(1, 4)))
        )
        if self.chance(0.5):
            return f"<aside{self.pick('', self.attribute('sidebar', 'widget'))}>{inside}</aside>"
        return f"<div{self.attribute('sidebar', 'side', 'widget', 'widgets', 'related', 'related-posts', 'recommended', 'rail', 'popular', 'trending')}>{inside}</div>"

    def advert(self) -> str:
        inside = self.pick(self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>", f'<a href="/ad">{self.words(2, 8, 0.2)}</a>', f"<h3>{self.words(1, 4)}</h3><p>{self.sentences(1, 2)}</p>")
        tag = self.pick("div", "div", "div", "section", "aside", "p")
        return f"<{tag}{self.attribute('ad', 'ads', 'advert', 'advertisement', 'ad-slot', 'banner-ad', 'sponsored', 'sponsor', 'promo', 'promotion', 'banner')}>{inside}</{tag}>"

    def notice(self) -> str:
        inside = self.pick(self.sentences(1, 3), f"<p>{self.sentences(1, 3)}</p>", f"<p>{self.sentences(1, 2)}</p><button>{self.words(1, 2, 0.8)}</button>")
        tag = self.pick("div", "div", "div", "section", "p", "aside")
        role = self.pick("", "", ' role="alert"', ' role="dialog"')
        return f"<{tag}{self.attribute('notice', 'cookie', 'cookie-notice', 'cookie-banner', 'cookies', 'consent', 'alert', 'warning', 'popup', 'modal', 'gdpr', 'paywall', 'newsletter', 'subscribe', 'overlay', 'message')}{role}>{inside}</{tag}>"

    def form(self) -> str:
        return f"<form{self.pick('', self.attribute('search', 'login', 'signup', 'contact-form'))}><label>{self.words(1, 3, 0.5)}</label><input name=q>{self.pick('', f'<p>{self.sentences(1, 1)}</p>', f'<select><option>{self.words(1, 2)}</option></select>')}<button>{self.words(1, 2, 0.8)}</button></form>"

    def share(self) -> str:
        tag = self.pick("div", "ul", "p", "section")
        item = "li" if tag == "ul" else "span"
        return f"<{tag}{self.attribute('share', 'social', 'sharing', 'share-buttons', 'tags', 'pagination', 'pager', 'meta', 'author-box', 'tools', 'toolbar')}>{self.items(item, 1, 5, 0.5)}</{tag}>"

    def comments(self) -> str:
        one = lambda: self.pick(
            f"<p>{self.sentences(1, 4)}</p>",
            f"<b>{self.words(1, 2)}</b><p>{self.sentences(1, 4)}</p>",
            f"<div>{self.words(1, 2)}</div><div>{self.sentences(1, 3)}</div>",
            self.sentences(1, 4),
        )
        n = int(self.rng.integers(1, 6))
        tag = self.pick("li", "div", "div", "article", "p")
        mark = self.pick("", self.attribute("comment", "comment-body", "reply", "review"))
        inside = "".join(f"<{tag}{mark}>{one()}</{tag}>" for _ in range(n))
        title = self.pick("", f"<h2>{self.words(1, 3, 0.6)}</h2>", f"<h3>{self.words(1, 3, 0.6)}</h3>")
        outer = self.pick("div", "section", "section", "ul", "ol", "aside") if tag == "li" else self.pick("div", "section", "section", "aside")
        return f"<{outer}{self.attribute('comments', 'comment-list', 'comment-section', 'discussion', 'disqus', 'responses', 'replies', 'reviews', 'reader-comments', 'user-comments')}>{title}{inside}</{outer}>"

    # Main text.

    def odd_text(self) -> str:
        """What real articles hold besides sentences: single words, repetition, capitals, tables in text, long runs."""
        style = int(self.rng.integers(8))
        if style == 0:
            return self.words(1, 2)
        if style == 1:
            return " ".join([self.words(1, 1).capitalize()] * int(self.rng.integers(5, 400)))
        if style == 2:
            return self.words(2, 60).upper().replace(" ", "!! ") + "!!"
        if style == 3:
            return self.words(3, 60).replace(" ", " | ")
        if style == 4:
            return " ".join(w + self.pick("%%%", "&amp;&amp;&amp;", "###", "***", "$$$") for w in self.words(2, 60).split())
        if style == 5:
            return self.sentences(20, 60)
        if style == 6:
            return self.words(2, 8) + f" +1 ({int(self.rng.integers(1000))}) 555-{int(self.rng.integers(10000))} &quot;{self.words(1, 1)}&quot; = {int(self.rng.integers(1 << 40))}"
        return self.pick("-", "* ", "1. ", "&mdash; ") + self.words(1, 6) + self.pick("", ".", ":")

    def paragraph(self) -> str:
        text = _MAIN + self.odd_text() if self.chance(0.18) else _MAIN + self.sentences(1, 9)
        style = self.rng.random()
        if style < 0.06:
            return f"<p><b>{text}<br><p>"
        if style < 0.12:
            return f"<p>{text}"
        if style < 0.2:
            return f'<p>{text} <a href="/l">{self.words(1, 3)}</a> <em>{self.words(1, 3)}</em>.</p>'
        if style < 0.24:
            return f"<p>{_MAIN}{self.words(1, 3).capitalize()}.</p>"
        return f"<p>{text}</p>"

    def main_part(self) -> str:
        style = self.rng.random()
        if style < 0.72:
            return self.paragraph()
        if style < 0.82:
            tag = self.pick("h2", "h2", "h3", "h4")
            return f"<{tag}>{_MAIN}{self.words(1, 9)}</{tag}>" + self.paragraph()
        if style < 0.9:
            tag = self.pick("ul", "ol")
            return f"<{tag}>" + "".join(f"<li>{_MAIN}{self.sentences(1, 2)}</li>" for _ in range(int(self.rng.integers(2, 6)))) + f"</{tag}>"
        if style < 0.94:
            return f"<blockquote>{self.pick('<p>', '')}{_MAIN}{self.sentences(1, 4)}</blockquote>"
        if style < 0.97:
            return "<table>" + "".join(f"<tr><td>{_MAIN}{self.words(1, 3)}</td><td>{_MAIN}{self.words(1, 4)}</td></tr>" for _ in range(2)) + "</table>"
        return f"<div>{_MAIN}{self.sentences(1, 6)}</div>"

    def article(self) -> str:
        title = f"<h1>{_MAIN}{self.words(1, 12)}</h1>"
        parts = [self.main_part() for _ in range(int(self.rng.choice([1, 2, 3, 4, 6, 9, 14])))]
        if self.chance(0.25):
            at = int(self.rng.integers(len(parts) + 1))
            parts.insert(at, self.pick(self.advert, self.notice, self.share, self.form, self.sidebar)())
        if self.chance(0.15):  # a short last paragraph after a long one
            parts += [f"<p>{_MAIN}{self.odd_text()}</p>", f"<p>{_MAIN}{self.sentences(1, 1)}</p>"]
        text = self.pick("", title, title, title, title) + "".join(parts)
        if self.chance(0.15):
            text = f"<header>{title}</header>" + "".join(parts)
        if self.chance(0.12):
            text += self.pick(self.comments, self.share, self.sidebar, self.form, self.advert)()
        style = self.rng.random()
        if style < 0.04:
            return text
        if style < 0.1:
            return f"<div>{text}</div>"
        if style < 0.55:
            return f"<article{self.pick('', '', self.attribute('post', 'story', 'entry'))}>{text}</article>"
        if style < 0.67:
            return f"<main>{text}</main>"
        if style < 0.74:
            return f"<main><article>{text}</article></main>"
        tag = self.pick("div", "div", "section")
        return f"<{tag}{self.attribute('content', 'main', 'main-content', 'article', 'article-body', 'post', 'post-content', 'entry', 'entry-content', 'story', 'text', 'body')}>{text}</{tag}>"

    def page(self) -> str:
        before = [part() for part, p in ((self.notice, 0.2), (self.header, 0.4), (self.menu, 0.75), (self.advert, 0.45), (self.form, 0.15), (self.sidebar, 0.2)) if self.chance(p)]
        after = [part() for part, p in ((self.share, 0.15), (self.comments, 0.4), (self.sidebar, 0.3), (self.advert, 0.2), (self.form, 0.1), (self.footer, 0.8), (self.notice, 0.12)) if self.chance(p)]
        if self.chance(0.3):
            self.rng.shuffle(before)
        inside = "".join(before) + self.article() + "".join(after)
        if self.chance(0.25):
            inside = f"<div{self.attribute('page', 'wrapper', 'container', 'site', 'layout')}>{inside}</div>"
        return (
            f"<!DOCTYPE html><html><head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head><body>"
            f"<script>var t='</p>';</script><!-- ad -->{inside}" + self.pick("</body></html>", "")
        )


def training_page(maker: _PageMaker) -> tuple[np.ndarray, np.ndarray]:
    blocks = leaf_blocks(maker.page())
    labels = np.array([b[0].startswith(_MAIN) for b in blocks], np.float32)
    return block_vectors([(t.replace(_MAIN, "") or " ", p, n) for t, p, n in blocks]), labels


@functools.lru_cache(maxsize=2)
def default_network(pages: int = TRAINING_PAGES, seed: int = 11) -> dict:
    maker = _PageMaker(seed)
    return train_network([training_page(maker) for _ in range(pages)])


# ---------------------------------------------------------------- operator


def main_text(
    df: DataFrame, html_col: str = "html", weights: dict | None = None, keep_at: float = 0.5, text_as: str = "text"
) -> DataFrame:
    """``df`` with the main text of each page (column ``text_as``) and its n_chars.

    The text holds the blocks labelled main text in page order, joined by one space.  Null and
    empty pages, and pages without such blocks, have an empty text.  Whole pages are read,
    whatever their length.  Columns named like the new ones are replaced, others pass
    through; an empty table gives an empty result; repeated rows are treated alike.
    """
    weights = default_network() if weights is None else weights
    kept, inner, back = set_aside(df, (text_as, "n_chars", *(() if html_col == text_as else (html_col,))))
    slim = df.select(*inner, quoted(html_col).alias("html"))
    passed = [f"in_{k}" for k in range(len(kept))]

    def extract(batches):
        for batch in batches:
            for part in byte_slices(batch, "html", SLICE_BYTES):
                pages = [leaf_blocks(page) if page else [] for page in part.column("html").to_pylist()]
                texts = [
                    " ".join(b[0] for b, main in zip(p, label >= keep_at, strict=True) if main)
                    for p, label in zip(pages, labelled(pages, weights), strict=True)
                ]
                yield pa.record_batch(
                    [*[part.column(c) for c in passed], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*passed, "text", "n_chars"],
                )

    fields = [T.StructField(p, df.schema[c].dataType) for p, c in zip(passed, kept, strict=True)]
    made = slim.mapInArrow(extract, T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]))
    return made.select(*back, F.col("text").alias(text_as), "n_chars")
