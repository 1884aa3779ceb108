"""Main-text extraction with a recurrent block labeller.

A page becomes the sequence of its text blocks (leaves).  Each leaf is a
vector: its tag path with class, id and role words (hashed), its words
(hashed, signed) and a few counts.  A bidirectional LSTM in numpy reads the
whole sequence and labels every block, so a block is judged by all of its page.

The model is trained here, on at most ``max_pages`` pages of the given table
(those of least hash; long ones in windows of ``max_leaves`` blocks).  Labels come
from page structure: the article or main element, else a container with an
article's name, else the innermost element that holds most of the text, each
without the parts beside it; a page that gives no label is left out, and a table
that gives none is labelled by this rule alone.  Every page is also seen in variants with other containers, names and extra parts
(menus, notices, forms, sidebars, reader comments), so that the labels must be
learnt from path, words and context together.

Text: character references decoded, white space inside a block turned into one
space, trimmed, blocks in page order joined by an empty line.  Scripts, styles,
comments and markup never become leaves.

Defined cases: null or empty html gives an empty text; broken markup is read
as far as it goes (unclosed comments and scripts run to the end of the page, an
unclosed quote is none, an unclosed last tag is text), in one pass however deep;
repeated rows are each extracted; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import random
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: element names of HTML
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre
search section select summary table tbody td template textarea tfoot th thead title tr ul""".split())
RAW = frozenset(("script", "style"))
VOID = frozenset(("hr", "br", "img", "input", "meta", "link", "wbr", "col", "area", "base", "embed", "source", "track"))
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}}
INSIDE = frozenset(("ul", "ol", "table", "dl", "select", "article", "section", "div", "body"))

_NAME_AT = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[\"'>]")
_ATTR = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME = re.compile(r"[a-z]+|[0-9]+")


# --- fixed values: parts of a page that hold no article
_OUT = frozenset(("nav", "aside", "footer", "form", "head", "button", "select", "dialog", "fieldset", "menu", "noscript", "template", "textarea", "title"))
_BOX = frozenset(("article", "main"))

# ------------------------------------------------------------------ features
PATH, WORDS, NUMS = 192, 24, 8
WIDTH = PATH + WORDS + NUMS


class Path:
    """An element and, linked, those around it.  What the labeller needs of the
    whole path is kept per element, so deep pages cost no more than flat ones."""

    __slots__ = ("names", "parent", "bits", "box", "out", "chars")

    def __init__(self, names: tuple[str, ...], parent: "Path | None"):
        self.names, self.parent = names, parent
        self.bits = parent.bits if parent else 0                 # hashed names of the whole path
        for n in names:
            self.bits |= 1 << zlib.crc32(n.encode("utf-8", "surrogatepass")) % (PATH // 2)
        tag, rest = names[0], names[1:]
        self.box = tag in _BOX or bool(parent and parent.box)
        self.out = (tag in _OUT or "!hidden" in rest or not _SPOTS.isdisjoint(rest)) or bool(parent and parent.out)
        self.chars = 0


def chain(elements) -> Path | None:
    """The linked path of a sequence of elements, outermost first."""
    at = None
    for names in elements:
        at = Path(names, at)
    return at


@dataclass(slots=True)
class Leaf:
    path: Path | None
    text: str
    linked: int          # characters inside links


def _names(tag: str, attrs: str) -> tuple[str, ...]:
    out = [tag]
    if attrs:
        for k, a, b, c in _ATTR.findall(attrs):
            v, k = (a or b or c).lower(), k.lower()
            if k in ("class", "id", "role"):
                out.extend("." + w for w in _NAME.findall(v))
            elif k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and re.search(r"display\s*:\s*none", v)):
                out.append("!hidden")
    return tuple(out)


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Place of the ``>`` that ends the tag open at ``at``, quoted ones passed
    over; a quote that never closes is no quote.  ``last`` holds the last place
    of each mark, so no search runs to the end of the page in vain."""
    p = at
    while p <= last[">"]:
        m = _STOP.search(page, p)
        if m is None:
            break
        q, p = m.group(), m.start()
        if q == ">":
            return p
        if p >= last[q]:
            break
        p = page.find(q, p + 1) + 1
    return page.find(">", at) if at <= last[">"] else -1


def leaves(page: str) -> list[Leaf]:
    """Blocks of text in page order, in one pass over the page."""
    out: list[Leaf] = []
    stack: list[tuple[str, Path]] = []
    opened: dict[str, int] = {}                # open elements by tag
    text: list[str] = []
    state = {"link": False, "linked": 0}
    last = {c: page.rfind(c) for c in "\"'>"}

    def flush():
        if text:
            s = " ".join(_html.unescape("".join(text)).split())
            if s:
                out.append(Leaf(stack[-1][1] if stack else None, s, min(state["linked"], len(s))))
            text.clear()
        state["linked"] = 0

    def take(part: str):
        if part:
            text.append(part)
            if state["link"]:
                state["linked"] += len(part)

    def cut(i: int):
        for tag, _ in stack[i:]:
            opened[tag] -= 1
        del stack[i:]

    pos, end = 0, len(page)
    while pos < end:
        at = page.find("<", pos)
        if at < 0:
            take(page[pos:])
            break
        take(page[pos:at])
        if page.startswith("<!--", at):
            e = page.find("-->", at + 4)
            pos = e + 3 if e >= 0 else end
            continue
        if page.startswith(("<!", "<?"), at):
            e = page.find(">", at) if at <= last[">"] else -1
            if e < 0:
                take(page[at:])                  # nothing closes any more: the rest is text
                break
            pos = e + 1
            continue
        m = _NAME_AT.match(page, at)
        if not m:
            take("<")
            pos = at + 1
            continue
        e = _tag_end(page, m.end(), last)
        if e < 0:
            take(page[at:])
            break
        pos = e + 1
        tag, closing, attrs = m.group(2).lower(), bool(m.group(1)), page[m.end():e]
        if tag in RAW and not closing:
            f = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(page, pos) if pos <= last[">"] else None
            pos = f.end() if f else end
        elif tag == "a":
            state["link"] = not closing
        elif tag == "br":
            text.append("\n")
        elif tag in BLOCKS:
            flush()
            if tag in VOID:
                continue
            if closing:
                if opened.get(tag):
                    i = len(stack) - 1
                    while stack[i][0] != tag:
                        i -= 1
                    cut(i)
                continue
            if stack and stack[-1][0] == "p":
                cut(len(stack) - 1)
            shut = CLOSES.get(tag)
            if shut and any(opened.get(t) for t in shut):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in shut:
                        cut(i)
                        break
                    if stack[i][0] in INSIDE:
                        break
            stack.append((tag, Path(_names(tag, attrs), stack[-1][1] if stack else None)))
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out


class Featurizer:
    def __init__(self):
        self.paths: dict[tuple, np.ndarray] = {}
        self.words: dict[str, tuple[int, int]] = {}

    def _path(self, path: Path | None) -> np.ndarray:
        """Hashed names of the whole path, and of the nearest two elements once more by place."""
        near, around = (path.names, path.parent.names if path.parent else None) if path else (None, None)
        key = (path.bits if path else 0, near, around)
        v = self.paths.get(key)
        if v is None:
            v = np.zeros(PATH, dtype=np.float32)
            for k in range(PATH // 2):
                v[k] = key[0] >> k & 1
            for depth, names in enumerate((near, around)):
                for n in names or ():
                    v[PATH // 2 + zlib.crc32(f"{depth}{n}".encode("utf-8", "surrogatepass")) % (PATH // 2)] = 1.0
            if len(self.paths) > 50_000:
                self.paths.clear()
            self.paths[key] = v
        return v

    def __call__(self, page: list[Leaf], first: int = 0, stop: int | None = None) -> np.ndarray:
        """Vectors of the leaves from ``first`` to ``stop``."""
        stop = len(page) if stop is None else stop
        x = np.zeros((stop - first, WIDTH), dtype=np.float32)
        if len(self.words) > 300_000:
            self.words.clear()
        known = self.words
        for j in range(first, stop):
            i, leaf = j - first, page[j]
            x[i, :PATH] = self._path(leaf.path)
            words = leaf.text.lower().split()
            for w in words:
                h = known.get(w)
                if h is None:
                    c = zlib.crc32(w.encode("utf-8", "surrogatepass"))
                    h = known[w] = (PATH + c % WORDS, 1 if c >> 16 & 1 else -1)
                x[i, h[0]] += h[1]
            x[i, PATH:PATH + WORDS] /= max(len(words), 1) ** 0.5 * 4
            n = len(leaf.text)
            x[i, PATH + WORDS:] = (np.log1p(n) / 8, leaf.linked / n, np.log1p(len(words)) / 6, leaf.text[-1] in ".!?:;\"'", "©" in leaf.text,
                                   (j + 1) / (len(page) + 1), leaf.text.count(",") / (len(words) + 1), j == 0)
        return x


# ------------------------------------------------------------------ the model
class BiLSTM:
    """One layer each way; numpy; trained by backpropagation through time."""

    def __init__(self, hidden: int = 16, seed: int = 11):
        g = np.random.default_rng(seed)
        self.h = hidden
        self.p = {}
        for d in "fb":
            self.p["wx" + d] = (g.standard_normal((WIDTH, 4 * hidden)) * 0.1).astype(np.float32)
            self.p["wh" + d] = (g.standard_normal((hidden, 4 * hidden)) * 0.1).astype(np.float32)
            self.p["b" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
        self.p["wo"] = (g.standard_normal(2 * hidden) * 0.1).astype(np.float32)
        self.p["bo"] = np.zeros(1, np.float32)

    def _run(self, x, mask, d, keep=None, state=None):
        """x (T, B, D) in reading order of direction d -> h (T, B, H).  ``state``
        (h, c) is where a part of a longer page goes on; it is moved on."""
        t_max, b, _ = x.shape
        h, c = state or (np.zeros((b, self.h), np.float32), np.zeros((b, self.h), np.float32))
        out = np.zeros((t_max, b, self.h), np.float32)
        z_all = x.reshape(-1, x.shape[2]) @ self.p["wx" + d] + self.p["b" + d]
        z_all = z_all.reshape(t_max, b, -1)
        n = self.h
        for t in (range(t_max) if d == "f" else range(t_max - 1, -1, -1)):
            z = z_all[t] + h @ self.p["wh" + d]
            s = 1 / (1 + np.exp(-np.clip(z[:, :3 * n], -30, 30)))
            i, f, o, u = s[:, :n], s[:, n:2 * n], s[:, 2 * n:], np.tanh(z[:, 3 * n:])
            m = mask[t][:, None]
            c_new = m * (f * c + i * u) + (1 - m) * c
            th = np.tanh(c_new)
            h_new = m * (o * th) + (1 - m) * h
            if keep is not None:
                keep.append((t, h, c, i, f, o, u, th, m))
            h, c = h_new, c_new
            out[t] = h
        if state is not None:
            state[:] = h, c
        return out

    def scores(self, x, mask):
        hf, hb = self._run(x, mask, "f"), self._run(x, mask, "b")
        return np.concatenate([hf, hb], axis=2) @ self.p["wo"] + self.p["bo"][0]

    def long_scores(self, page: list[Leaf], feat: "Featurizer", part: int) -> np.ndarray:
        """Scores of one page read in parts, each direction carrying its state on."""
        cuts = [(s, min(len(page), s + part)) for s in range(0, len(page), part)]
        z = np.full(len(page), self.p["bo"][0], np.float32)
        for k, d in enumerate("fb"):
            state = [np.zeros((1, self.h), np.float32), np.zeros((1, self.h), np.float32)]
            for s, e in cuts if d == "f" else reversed(cuts):
                h = self._run(feat(page, s, e)[:, None, :], np.ones((e - s, 1), np.float32), d, state=state)
                z[s:e] += h[:, 0] @ self.p["wo"][k * self.h:(k + 1) * self.h]
        return z

    def gradients(self, x, mask, y):
        kept = {"f": [], "b": []}
        hs = {d: self._run(x, mask, d, kept[d]) for d in "fb"}
        both = np.concatenate([hs["f"], hs["b"]], axis=2)
        z = both @ self.p["wo"] + self.p["bo"][0]
        prob = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        total = max(float(mask.sum()), 1.0)
        dz = (prob - y) * mask / total
        g = {"wo": np.einsum("tb,tbh->h", dz, both), "bo": np.array([dz.sum()])}
        n = self.h
        for k, d in enumerate("fb"):
            wo = self.p["wo"][k * n:(k + 1) * n]
            dwh = np.zeros_like(self.p["wh" + d])
            dzx = np.zeros((*x.shape[:2], 4 * n), np.float32)
            dh = np.zeros((x.shape[1], n), np.float32)
            dc = np.zeros_like(dh)
            for t, h0, c0, i, f, o, u, th, m in reversed(kept[d]):
                dh = dh + dz[t][:, None] * wo
                dcn = dc + m * dh * o * (1 - th * th)
                dg = np.concatenate([dcn * u * i * (1 - i), dcn * c0 * f * (1 - f), dh * th * o * (1 - o), dcn * i * (1 - u * u)], axis=1) * m
                dzx[t] = dg
                dwh += h0.T @ dg
                dh = (1 - m) * dh + dg @ self.p["wh" + d].T
                dc = m * dcn * f + (1 - m) * dc
            flat = dzx.reshape(-1, 4 * n)
            g["wx" + d], g["wh" + d], g["b" + d] = x.reshape(-1, x.shape[2]).T @ flat, dwh, flat.sum(axis=0)
        loss = -(y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9)) * mask
        return float(loss.sum()) / total, g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 5, batch: int = 24, rate: float = 0.01, seed: int = 5):
        g1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        g2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        rng, step = np.random.default_rng(seed), 0
        by_len = sorted(range(len(pages)), key=lambda i: len(pages[i][1]))
        groups = [by_len[i:i + batch] for i in range(0, len(by_len), batch)]
        for _ in range(epochs):
            for gi in rng.permutation(len(groups)):
                x, mask, y = padded([pages[i][0] for i in groups[gi]], [pages[i][1] for i in groups[gi]])
                _, g = self.gradients(x, mask, y)
                norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                step += 1
                for k, v in g.items():
                    v = v * min(1.0, 1.0 / (norm + 1e-9))
                    g1[k] = 0.9 * g1[k] + 0.1 * v
                    g2[k] = 0.99 * g2[k] + 0.01 * v * v
                    self.p[k] = (self.p[k] - rate * (g1[k] / (1 - 0.9 ** step)) / (np.sqrt(g2[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return self


def padded(xs, ys=None):
    t = max(len(x) for x in xs)
    x = np.zeros((t, len(xs), WIDTH), np.float32)
    mask = np.zeros((t, len(xs)), np.float32)
    y = np.zeros((t, len(xs)), np.float32)
    for j, v in enumerate(xs):
        x[:len(v), j], mask[:len(v), j] = v, 1
        if ys is not None:
            y[:len(v), j] = ys[j]
    return x, mask, y


# ------------------------------------------------------------------ training pages
# --- fixed values: names that sites give to the parts of a page
_ARTICLE = ["article", "main", "section.post", "div.content", "div#content", "div.article-body", "div.post-content", "div.entry-content",
            "div#main", "div.story", "section.text", "div.main-content", "article.post", "div.page"]
_SIDE = {"nav": ["nav", "ul.menu", "div.menu", "div#nav", "div.navbar", "div.breadcrumb", "ul.navigation"],
         "head": ["header", "div#header", "div.header", "div.masthead", "div.top-bar", "header.site-header"],
         "foot": ["footer", "div#footer", "div.footer", "div.copyright", "footer.site-footer"],
         "aside": ["aside", "div.sidebar", "div#sidebar", "div.related", "aside.widget", "div.related-posts", "section.recommended"],
         "ad": ["div.ad", "div.ads", "div.advert", "div.sponsored", "div.promo", "div.banner", "aside.advertisement", "div#ad-1"],
         "note": ["div.cookie-notice", "div.notice", "div#cookies", "div.alert", "div.consent", "div.popup", "div.newsletter", "p.notice",
                  "div.cookie-banner", "dialog"],
         "form": ["form", "form.search", "form.newsletter", "fieldset", "form.comment-form", "div.subscribe", "form.login"],
         "share": ["div.share", "ul.social", "div.tags", "div.author-box", "div.meta-share"],
         "talk": ["section.comments", "div.comments", "div#comments", "ol.comment-list", "div.discussion", "section#comments", "div.comment-thread"]}
_BEFORE, _AFTER, _WITHIN = ["nav", "head", "ad", "note", "aside", "form"], ["foot", "aside", "ad", "note", "form", "share", "talk"], ["ad", "share", "aside", "note", "form", "talk", "nav"]


def _element(spec: str) -> tuple[str, ...]:
    m = re.match(r"(\w+)(?:([.#])(.+))?", spec)
    return (m[1], *("." + w for w in _NAME.findall(m[3] or "")))


_SPOTS = frozenset(w for specs in _SIDE.values() for s in specs for w in _element(s)[1:])
_NAMED = [(e[0], frozenset(e[1:])) for e in map(_element, _ARTICLE)]


def _part(kind: str, words: list[str], r: random.Random, around: tuple) -> list[Leaf]:
    """Leaves of one part of the kind, of the page's own words."""
    path = (*around, _element(r.choice(_SIDE[kind])))
    say = lambda a, b: " ".join(r.choices(words, k=r.randint(a, b)))
    out = []
    for _ in range(r.randint(2, 8) if kind in ("nav", "talk", "share") else r.randint(1, 3)):
        if kind in ("nav", "share"):
            s = say(1, 3)
            out.append(Leaf(chain((*path, *((("ul",),) if path[-1][0] != "ul" and r.random() < 0.6 else ()), ("li",)) if r.random() < 0.8 else path), s, len(s)))
        elif kind == "talk":
            inner = r.choice([(("p",),), (("div", ".comment"),), (("div", ".comment"), ("p",)), (("li",),), (("article", ".comment"), ("p",)), ()])
            out.append(Leaf(chain((*path, *inner)), say(3, 60), 0))
        else:
            s = say(2, 40)
            inner = r.choice([(), (("p",),), (("p",),), (("div",),), (("h3",),), (("button",),), (("label",),) if kind == "form" else (("li",),)])
            if kind == "foot" and r.random() < 0.5:
                s = "© " + s
            out.append(Leaf(chain((*path, *inner)), s, len(s) if r.random() < 0.3 else 0))
    return out


def variant(page: list[Leaf], own: list[bool], r: random.Random) -> tuple[list[Leaf], list[bool]]:
    """The page with its article in another container and other parts around and inside it."""
    words = [w for leaf in page for w in leaf.text.split()] or ["x"]
    root = (("html",), ("body",), *((("div", *r.choice([(), (".wrapper",), (".container",), (".page",)])),) if r.random() < 0.6 else ()))
    box = (*root, *((("main",),) if r.random() < 0.3 else ()), _element(r.choice(_ARTICLE)))
    out = [Leaf(chain((("html",), ("head",), ("title",))), " ".join(words[:6]), 0)] if r.random() < 0.8 else []
    lab = [False] * len(out)

    def add(kind, around):
        p = _part(kind, words, r, around)
        out.extend(p)
        lab.extend([False] * len(p))
    for k in r.sample(_BEFORE, r.randint(0, 4)):
        add(k, root)
    body = [leaf for leaf, o in zip(page, own) if o]
    run, last = 0, ()
    for i, leaf in enumerate(body):
        if i and r.random() < 0.05:
            add(r.choice(_WITHIN), box)
        inner = (leaf.path.names,) if leaf.path and leaf.path.names[0] not in ("article", "main") else (("p",),)
        if run:                                        # more items of the same list
            run, inner = run - 1, last
        elif r.random() < 0.12:
            run = r.choice([0, 0, 1, 3, 5])
            inner = r.choice([(("ul",), ("li",)), (("blockquote",),), (("blockquote",), ("p",)), (("h2",),), (("pre",),), (("section",), ("p",)), (("ol",), ("li",)),
                              (("table",), ("tr",), ("td",)), (("figure",), ("figcaption",)), (("div",),), (("header",), ("h1",))])
        last = inner
        text = leaf.text if r.random() < 0.8 else " ".join(leaf.text.split()[:r.randint(1, 6)])     # short blocks too
        out.append(Leaf(chain((*box, *inner)), text, leaf.linked))
        lab.append(True)
    for k in r.sample(_WITHIN, r.randint(0, 2)):
        add(k, box)
    for k in r.sample(_AFTER, r.randint(0, 5)):
        add(k, root)
    return out, lab


def _in_named_box(path: Path | None) -> bool:
    while path is not None:
        names = set(path.names[1:])
        if any(path.names[0] == tag and words and words <= names for tag, words in _NAMED):
            return True
        path = path.parent
    return False


def structural(page: list[Leaf]) -> list[bool]:
    """Training labels: leaves inside the article, outside of parts with the tag or
    name of something else.  The article is an article or main element; without
    one, an element with the name of an article's container; without that, the
    innermost element that holds most of the page's other text."""
    fit = [leaf.path is not None and not leaf.path.out for leaf in page]
    for inside in (lambda p: p.box, _in_named_box):
        found = [f and inside(leaf.path) for f, leaf in zip(fit, page)]
        if any(found):
            return found
    total, held, order = 0, {}, {}
    for leaf, f in zip(page, fit):
        if f:
            total += len(leaf.text)
            held[id(leaf.path)] = held.get(id(leaf.path), 0) + len(leaf.text)
            order[id(leaf.path)] = leaf.path
    # sums from the inside out: an element after all elements within it
    depth: dict[int, int] = {}

    def deep(p: Path) -> int:
        way = []
        while p is not None and id(p) not in depth:
            way.append(p)
            p = p.parent
        d = depth[id(p)] if p is not None else 0
        for x in reversed(way):
            d += 1
            depth[id(x)] = d
            order[id(x)] = x
            held.setdefault(id(x), 0)
        return d
    for p in list(order.values()):
        deep(p)
    best = None
    for p in sorted(order.values(), key=lambda p: -depth[id(p)]):
        if p.parent is not None:
            held[id(p.parent)] += held[id(p)]
        if best is None and held[id(p)] > 0.5 * total and depth[id(p)] < 10_000:
            best = p
    if best is None:
        return [False] * len(page)
    # the text's own element is no container: take the one around it
    if best.names[0] in ("p", "li", "h1", "h2", "h3", "blockquote", "pre", "td") and best.parent is not None:
        best = best.parent
    inside = {id(best)}
    for p in sorted(order.values(), key=lambda p: depth[id(p)]):
        if p.parent is not None and id(p.parent) in inside:
            inside.add(id(p))
    return [f and id(leaf.path) in inside for f, leaf in zip(fit, page)]


def _windows(n: int, size: int, most: int) -> list[tuple[int, int]]:
    """At most ``most`` windows of ``size`` leaves, evenly spaced over ``n``."""
    if n <= size:
        return [(0, n)]
    k = min(most, -(-n // size))
    return [(s, s + size) for s in (round(i * (n - size) / max(k - 1, 1)) for i in range(k))]


def train(pages: list[str], variants: int = 8, max_leaves: int = 150, max_windows: int = 4, seed: int = 3) -> BiLSTM | None:
    """A labeller, or None if no page gives a label.  Long pages are seen in
    windows of ``max_leaves`` blocks."""
    r, feat, rows = random.Random(seed), Featurizer(), []
    for page in pages:
        whole = leaves(page or "")
        labels = structural(whole)
        if not any(labels):
            continue
        for s, e in _windows(len(whole), max_leaves, max_windows):
            seq, own = whole[s:e], labels[s:e]
            rows.append((feat(whole, s, e), np.array(own, np.float32)))
            if any(own):
                for _ in range(variants):
                    v, lab = variant(seq, own, r)
                    rows.append((feat(v), np.array(lab, np.float32)))
    return BiLSTM().fit(rows) if rows else None


def label_pages(model: BiLSTM | None, pages: list[list[Leaf]], feat: Featurizer, batch: int = 64,
                longest: int = 20_000) -> list[np.ndarray]:
    """Content or not, per leaf; pages of like length go together, pages of over
    ``longest`` leaves alone and in parts."""
    out: list = [np.zeros(0, bool)] * len(pages)
    if model is None:
        return [np.array(structural(p), bool) for p in pages]
    order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
    while order and len(pages[order[-1]]) > longest:
        i = order.pop()
        out[i] = model.long_scores(pages[i], feat, longest) > 0
    at = 0
    while at < len(order):
        top = batch
        while top > 1 and len(pages[order[min(at + top, len(order)) - 1]]) * top > longest:    # bound the padded matrix
            top //= 2
        part = order[at:at + top]
        at += len(part)
        x, mask, _ = padded([feat(pages[i]) for i in part])
        z = model.scores(x, mask)
        for j, i in enumerate(part):
            out[i] = z[:len(pages[i]), j] > 0
    return out


def fit_labeller(pages: DataFrame, html_col: str = "html", max_pages: int = 150, max_leaves: int = 150) -> BiLSTM | None:
    h = F.col(html_col).cast("string")
    keys = pages.select(F.xxhash64(h).alias("k")).where("k is not null").distinct().orderBy("k").limit(max_pages)
    rows = pages.select(h.alias("html"), F.xxhash64(h).alias("k")).join(F.broadcast(keys), "k").dropDuplicates(["k"]).orderBy("k")
    return train([r.html for r in rows.select("html").limit(max_pages).collect()], max_leaves=max_leaves)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            model: BiLSTM | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) per page."""
    model = model or fit_labeller(pages, html_col)
    shared = pages.sparkSession.sparkContext.broadcast(model and model.p)        # fixed size
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                       F.col(html_col).cast("string").alias("html"))

    def run(batches):
        m, feat = BiLSTM() if shared.value else None, Featurizer()
        if m:
            m.p = shared.value
        for b in batches:
            for c in range(0, b.num_rows, 200):
                part = b.slice(c, 200)
                seqs = [leaves(h or "") for h in part.column(2).to_pylist()]
                texts = ["\n\n".join(leaf.text for leaf, ok in zip(s, keep) if ok) for s, keep in zip(seqs, label_pages(m, seqs, feat))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")
