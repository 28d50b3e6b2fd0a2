"""Main text of web pages: a recurrent network labels every block of a page with the whole page in view.

A page is cut into leaf blocks (text between the borders of block elements). A block enters the network as the sum of
learned vectors of its hashed tag path (each open element, with classes and id), the mean of learned vectors of its
hashed words, and a few measures. A bidirectional LSTM in numpy reads the blocks in page order, and a logistic unit
over both states labels each as main text or not.

There are no labelled pages, so the network is fitted to what page authors mark: FIT_PAGES pages, chosen by a hash of
the id among those, of any length, whose article or main element is the main text; of a page with more than FIT_BLOCKS
blocks it is shown those around both ends of the main text. Where no page has such marks, a stated rule over the names of
elements and the measures of blocks labels them. So that it does not hang on those names alone, every page is also shown
in a disguise: elements of each role are renamed, and sidebars, comments, notices and forms with other pages' sentences
are put around the text and inside its element. Fitting runs on the driver on that bounded sample, labelling on the
executors.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldhouse.llm.common import saved, small_batches
from fieldhouse.llm.kernels import U, flat, word_hashes

FIT_PAGES, FIT_BLOCKS, PASSES = 240, 600, 8
PATHS, WORDS, PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 1 << 12, 1 << 13, 12, 8, 5, 10
STEPS = 240
"""Gradient steps at least, of 16 pages each; few pages are shown more often."""
CELLS = 20_000
"""Blocks, with padding, that run through the network together."""

BREAKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 "
    "h2 h3 h4 h5 h6 header hgroup hr html iframe legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea "
    "tfoot th thead tr ul".split())
SILENT = frozenset("head noframes noscript script style svg template title".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dd", "dt", "p"}, "dd": {"dd", "dt", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
"""Fixed values of the format: elements that end a block, that hold no text, that have no content, and what an element ends."""
HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
LEAVES_SVG = BREAKS | frozenset("b big body br code em embed font head i img meta nobr ruby s small span strong strike sub sup tt u var".split())
INSIDE_SVG = frozenset("desc foreignobject".split())
"""Start tags that head can hold, those that end an open svg, and elements of svg that hold ordinary ones."""
KEEPERS, OTHERS = frozenset(["article", "main"]), frozenset(["aside", "footer", "form", "header", "nav"])


class Blocks(HTMLParser):
    """Leaf blocks of a page: (path of open elements, text with white space made single, characters inside links).

    As tags may be left out, text or a start tag that head cannot hold ends head, and an ordinary element ends an svg. A
    noscript or template whose end tag never comes (`ends` counts those of the page) hides nothing.
    """

    def __init__(self, ends: dict[str, int] | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.ends = ends or {}
        self.open: list[tuple[str, str]] = []  # (element, element with classes and id)
        self.blocks: list[tuple[tuple[str, ...], str, int]] = []
        self.text: list[str] = []
        self.silent, self.links, self.linked = 0, 0, 0

    def end_block(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((tuple(name for _, name in self.open), text, self.linked))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            self.end_silent(tag)
        if tag in SILENT:
            if tag not in EMPTY and self.ends.get(tag, 1) > 0:
                self.silent += 1
                self.open.append((tag, tag))
            return
        if self.silent and tag in INSIDE_SVG:
            self.open.append((tag, tag))
            return
        if tag == "body":
            self.close_silent("head")
            if any(name == "body" for name, _ in self.open):
                return
        if tag == "a":
            self.links += 1
        if tag == "br":
            self.text.append(" ")
        if tag not in BREAKS:
            return
        self.end_block()
        ends = CLOSES.get(tag) or ({"p"} if tag not in ("td", "th") else set())
        while self.open and self.open[-1][0] in ends:
            self.open.pop()
        self.links = 0
        if tag not in EMPTY:
            given = dict(attrs)
            marks = sorted(set(f"{given.get('class') or ''} {given.get('id') or ''}".lower().split()))
            self.open.append((tag, ".".join([tag, *marks])))

    def end_silent(self, tag: str) -> None:
        """End the head or svg that cannot hold a start tag (text: the empty tag)."""
        inner = next((name for name, _ in reversed(self.open) if name in SILENT or name in INSIDE_SVG), "")
        if inner == "svg" and tag in LEAVES_SVG:
            self.close_silent("svg")
            inner = next((name for name, _ in reversed(self.open) if name in SILENT or name in INSIDE_SVG), "")
        if inner == "head" and tag not in HEAD:
            self.close_silent("head")
            if tag not in ("body", "frameset"):
                self.open.append(("body", "body"))

    def close_silent(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.silent -= sum(name in SILENT for name, _ in self.open[i:])
                del self.open[i:]
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in self.ends:
            self.ends[tag] -= 1
        if tag in SILENT or tag in INSIDE_SVG:
            self.close_silent(tag)
        elif tag == "a":
            self.links = max(0, self.links - 1)
        elif tag in BREAKS:
            self.end_block()
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == tag:
                    self.silent -= sum(name in SILENT for name, _ in self.open[i:])
                    del self.open[i:]
                    break

    def handle_data(self, data: str) -> None:
        if self.silent and self.open[-1][0] == "head" and data.strip():
            self.end_silent("")
        if not self.silent:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def blocks_of(html: str) -> list[tuple[tuple[str, ...], str, int]]:
    """All leaf blocks of a page, in order."""
    low = html.lower()
    parser = Blocks({tag: low.count(f"</{tag}") for tag in ("noscript", "template")})
    cut = html.rfind("<")
    broken = cut >= 0 and ">" not in html[cut:] and (html[cut + 1:cut + 2].isalpha() or html[cut + 1:cut + 2] in ("/", "!"))
    parser.feed(html[:cut] if broken else html)  # a tag that the page's end cuts off is no text
    parser.close()
    parser.end_block()
    return parser.blocks


def marked(path: tuple[str, ...]) -> bool:
    """Whether the author's elements say that a block is main text: the innermost telling element decides."""
    for name in reversed(path):
        tag = name.split(".")[0]
        if tag in KEEPERS:
            return True
        if tag in OTHERS:
            return False
    return False


def path_features(path: tuple[str, ...]) -> list[int]:
    """Buckets of the element itself, of each element around it, and of their classes and ids."""
    names = {f"at:{path[-1].split('.')[0]}"} if path else {"at:"}
    for name in path:
        tag, *marks = name.split(".")
        if tag not in ("html", "body"):
            names |= {f"in:{tag}", *(f"mark:{m}" for m in marks)}
    return sorted(zlib.crc32(n.encode()) % PATHS for n in names)


class Features:
    """Numbers of many blocks: path buckets and word buckets as flat lists with the block of each, and measures."""

    def __init__(self, pages: list[list[tuple[tuple[str, ...], str, int]]]) -> None:
        every = [b for page in pages for b in page]
        self.size = np.array([len(p) for p in pages], np.int64)
        known: dict[tuple[str, ...], list[int]] = {}
        paths = [known.get(p) or known.setdefault(p, path_features(p)) for p, _, _ in every]
        self.path = np.array([x for p in paths for x in p], np.int64)
        self.path_of = np.repeat(np.arange(len(every)), [len(p) for p in paths]) if every else np.zeros(0, np.int64)
        data, offsets = flat(pa.array([t for _, t, _ in every], pa.string()))
        h, self.word_of = word_hashes(data, offsets, low=True)
        self.word = (h % U(WORDS)).astype(np.int64)
        chars = np.array([len(t) for _, t, _ in every], float)
        linked = np.array([n for _, _, n in every], float)
        ends = np.array([sum(t.count(c) for c in ".!?,;") for _, t, _ in every], float)
        spot = np.concatenate([np.arange(n) / max(n - 1, 1) for n in self.size]) if every else np.zeros(0)
        self.measures = np.column_stack([
            np.log1p(chars) / 8, np.minimum(linked / np.maximum(chars, 1), 1), np.minimum(20 * ends / np.maximum(chars, 1), 2), spot,
            np.minimum(np.bincount(self.word_of, minlength=len(every)) / 100, 2)]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Labeller:
    """Bidirectional LSTM over the blocks of pages."""

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s, by: (rng.standard_normal(s) * by).astype(np.float32)
        wide, h = PATH_DIM + WORD_DIM + MEASURES, HIDDEN
        self.p = {"path": draw(PATHS, PATH_DIM, by=0.1), "word": draw(WORDS, WORD_DIM, by=0.1), "out": draw(2 * h, by=0.3), "out_b": np.zeros(1, np.float32)}
        for d in "fb":
            bias = np.zeros(4 * h, np.float32)
            bias[h:2 * h] = 1.0  # cells remember at first
            self.p |= {f"w{d}": draw(wide, 4 * h, by=wide ** -0.5), f"u{d}": draw(h, 4 * h, by=h ** -0.5), f"b{d}": bias}

    def inputs(self, f: Features) -> np.ndarray:
        n = len(f.measures)
        path, word = np.zeros((n, PATH_DIM), np.float32), np.zeros((n, WORD_DIM), np.float32)
        np.add.at(path, f.path_of, self.p["path"][f.path])
        np.add.at(word, f.word_of, self.p["word"][f.word])
        count = np.bincount(f.word_of, minlength=n)
        return np.concatenate([path, word / np.maximum(count, 1)[:, None].astype(np.float32), f.measures], axis=1)

    def _run(self, gate: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States of one direction, (pages, blocks, HIDDEN); past the end of a page they stay."""
        n, steps, h, u = *mask.shape, HIDDEN, self.p[f"u{d}"]
        state, cell, out = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32), np.zeros((n, steps, h), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = gate[:, t] + state @ u
            s = _sigmoid(a[:, :3 * h])
            i, f, o, g = s[:, :h], s[:, h:2 * h], s[:, 2 * h:], np.tanh(a[:, 3 * h:])
            m = mask[:, t, None]
            new = f * cell + i * g
            tanh = np.tanh(new)
            if keep is not None:
                keep.append((t, state, cell, i, f, o, g, tanh))
            cell = np.where(m, new, cell)
            state = np.where(m, o * tanh, state)
            out[:, t] = state
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        p = self.p
        kf, kb = ([], []) if keep is not None else (None, None)
        states = np.concatenate([self._run(x @ p["wf"] + p["bf"], mask, "f", kf), self._run(x @ p["wb"] + p["bb"], mask, "b", kb)], axis=2)
        if keep is not None:
            keep |= {"f": kf, "b": kb, "states": states}
        return states @ p["out"] + p["out_b"][0]

    def gradients(self, f: Features, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over all blocks."""
        p, h, keep = self.p, HIDDEN, {}
        flat_x, (place, mask) = self.inputs(f), padded(f.size)
        x = flat_x[place]
        d = np.where(mask, _sigmoid(self.forward(x, mask, keep)) - label[place], 0).astype(np.float32) / max(1, len(label))
        g = {"out": np.einsum("nth,nt->h", keep["states"], d), "out_b": d.sum(keepdims=True).reshape(1)}
        d_states, d_x = d[:, :, None] * p["out"], np.zeros_like(x)
        for k, side in (("f", slice(0, h)), ("b", slice(h, 2 * h))):
            u, d_u = p[f"u{k}"], np.zeros_like(p[f"u{k}"])
            d_gate = np.zeros((*mask.shape, 4 * h), np.float32)
            d_state, d_cell = np.zeros((len(mask), h), np.float32), np.zeros((len(mask), h), np.float32)
            for t, state, cell, i, fg, o, gg, tanh in reversed(keep[k]):
                m = mask[:, t, None]
                d_out = d_states[:, t, side] + d_state
                d_new = np.where(m, d_cell + d_out * o * (1 - tanh ** 2), 0)
                a = np.concatenate([d_new * gg * i * (1 - i), d_new * cell * fg * (1 - fg), np.where(m, d_out * tanh, 0) * o * (1 - o), d_new * i * (1 - gg ** 2)], axis=1)
                d_gate[:, t] = a
                d_u += state.T @ a
                d_state = a @ u.T + np.where(m, 0, d_out)
                d_cell = np.where(m, d_new * fg, d_cell)
            g[f"u{k}"], g[f"w{k}"], g[f"b{k}"] = d_u, np.einsum("nti,ntj->ij", x, d_gate), d_gate.sum(axis=(0, 1))
            d_x += d_gate @ p[f"w{k}"].T
        d_flat = np.zeros_like(flat_x)
        d_flat[place[mask]] = d_x[mask]
        count = np.maximum(np.bincount(f.word_of, minlength=len(flat_x)), 1)[:, None]
        g["path"], g["word"] = np.zeros_like(p["path"]), np.zeros_like(p["word"])
        np.add.at(g["path"], f.path, d_flat[:, :PATH_DIM][f.path_of])
        np.add.at(g["word"], f.word, (d_flat[:, PATH_DIM:PATH_DIM + WORD_DIM] / count)[f.word_of])
        return g

    def label(self, pages: list[list[tuple[tuple[str, ...], str, int]]]) -> list[np.ndarray]:
        """Whether each block of each page is main text."""
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        group: list[int] = []
        for n, i in enumerate(order):
            group.append(i)
            following = len(pages[order[n + 1]]) if n + 1 < len(order) else 0
            if not following or following * (len(group) + 1) > CELLS:
                f = Features([pages[k] for k in group])
                if f.size.sum():
                    place, mask = padded(f.size)
                    logit = self.forward(self.inputs(f)[place], mask)
                    for k, row, size in zip(group, logit, f.size):
                        out[k] = row[:size] > 0
                group = []
        return out


def padded(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block numbers, which are there), pages x blocks of the longest."""
    step = np.arange(max(1, int(size.max())))
    mask = step < size[:, None]
    place = np.where(mask, (np.cumsum(size) - size)[:, None] + step, 0)
    return place, mask


ROLES = {
    "main": ["article", "main", "div.content", "div.post", "section.entry-content", "div.article-body", "div.story", "div.main-text"],
    "other": ["nav", "header", "div.menu", "ul.navigation", "footer", "div.footer", "div.ad", "div.advert", "aside", "div.sidebar", "div.related",
              "section.comments", "div.comment", "div.comments", "div.cookie-notice", "div.banner", "form", "form.newsletter", "div.share", "div.sponsor"]}
"""Names that elements of either role are given in disguises."""


def disguised(page: list, texts: list[str], rng: random.Random) -> tuple[list, list[bool]]:
    """A page with its elements renamed and foreign blocks put around its main text; and the labels of its blocks."""
    names = {True: rng.choice(ROLES["main"]), False: rng.choice(ROLES["other"])}
    kept = [(("html", "body", names[k], *b[0][3:]) if len(b[0]) > 2 else b[0], b[1], b[2], k) for b in page for k in [marked(b[0])]]
    out: list = []
    main = [i for i, b in enumerate(kept) if b[3]]
    spots = sorted(rng.choice([0, main[0] if main else 0, (main[-1] + 1) if main else 0, len(kept)]) for _ in range(rng.randrange(1, 4)))
    for i, b in enumerate([*kept, None]):
        while spots and spots[0] == i:
            spots.pop(0)
            name, leaf = rng.choice(ROLES["other"]), rng.choice([("p",), ("div",), ("li",), ()])
            inside = rng.random() < 0.3
            for _ in range(rng.randrange(1, 5)):
                words = rng.choice(texts).split()
                text = " ".join(words[:rng.randrange(1, 60)])
                around = ("html", "body", names[True]) if inside else ("html", "body")
                out.append(((*around, name, *leaf), text, len(text) if rng.random() < 0.3 else 0, False))
        if b:
            out.append(b)
    return [b[:3] for b in out], [b[3] for b in out]


def shown(page: list) -> list:
    """The blocks of a page that a network is fitted to: all, or FIT_BLOCKS around the first and the last of the main text."""
    if len(page) <= FIT_BLOCKS:
        return page
    main = [i for i, b in enumerate(page) if marked(b[0])] or [0]
    part = FIT_BLOCKS // 4
    near = {i for edge in (main[0], main[-1] + 1) for i in range(edge - part, edge + part)}
    return [page[i] for i in sorted(near) if 0 <= i < len(page)]


def fit(htmls: list[str], seed: int = 5) -> Labeller | None:
    """A network fitted to pages whose authors mark their main text; None if there are none."""
    return fit_blocks([shown(blocks_of(h)) for h in htmls], seed)


def fit_blocks(pages: list[list], seed: int = 5) -> Labeller | None:
    """The same from the blocks of pages."""
    pages = [p for p in pages if any(marked(b[0]) for b in p)]
    if not pages:
        return None
    rng, net, memory, t = random.Random(seed), Labeller(seed), {}, 0
    texts = [b[1] for p in pages for b in p]
    for _ in range(max(PASSES, -(-STEPS // -(-len(pages) // 8)))):
        both = [(p, [marked(b[0]) for b in p]) for p in pages] + [disguised(p, texts, rng) for p in pages]
        both.sort(key=lambda x: len(x[0]))
        groups = [both[i:i + 16] for i in range(0, len(both), 16)]
        rng.shuffle(groups)
        for group in groups:
            g = net.gradients(Features([p for p, _ in group]), np.array([y for _, label in group for y in label], np.float32))
            t += 1
            for k, v in g.items():
                m, s = memory.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
                m += 0.1 * (v - m)
                s += 0.01 * (v * v - s)
                net.p[k] -= 0.01 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-6)
    return net


NAMED = {mark: role == "main" for role, names in ROLES.items() for name in names for mark in (name.split(".")[1:] or [name])}
"""Roles that the names in ROLES tell: a class or id, or the element where it has none."""
SENTENCE, ENDS = 40, tuple(".!?\u2026\u3002\uff01\uff1f")


def by_rule(page: list[tuple[tuple[str, ...], str, int]]) -> list[bool]:
    """Labels without a network: what the author marks, and on a page without marks a rule.

    The innermost element whose name, class or id is in NAMED decides. Where none is, a block is main text if at most a
    third of its characters are links and it has SENTENCE characters or ends like a sentence; a heading is if the
    following block is.
    """
    if any(marked(b[0]) for b in page):
        return [marked(b[0]) for b in page]
    roles = [next((NAMED[m] for name in reversed(path) for m in name.split(".") if m in NAMED), None) for path, _, _ in page]
    out, following = [], False
    for (path, text, linked), role in zip(reversed(page), reversed(roles)):
        heading = bool(path) and path[-1].split(".")[0] in ("h1", "h2", "h3", "h4", "h5", "h6")
        following = role if role is not None else 3 * linked <= len(text) and (
            following if heading else len(text) >= SENTENCE or text.endswith(ENDS))
        out.append(following)
    return out[::-1]


def main_text(net: Labeller | None, htmls: list[str]) -> list[str]:
    """Blocks labelled as main text, one to a line. Without a network, those that `by_rule` labels."""
    pages = [blocks_of(h) for h in htmls]
    labels = net.label(pages) if net else [by_rule(p) for p in pages]
    return ["\n".join(b[1] for b, k in zip(p, label) if k) for p, label in zip(pages, labels)]


def with_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages with a block that its author marks as main text."""
    for b in batches:
        yield b.filter(pa.array([any(marked(x[0]) for x in blocks_of(h)) for h in b.column("html").to_pylist()], pa.bool_()))


def sample_of(pages: DataFrame) -> DataFrame:
    """(mark, page_id, html) of the FIT_PAGES different pages with the smallest hashes, among those whose authors mark main text.

    Only hashes are ordered; the pages are then fetched by them, so no task or driver gets more than the sample. Pages
    where an article or main tag is written are drawn first; only if one of these turns out to mark nothing (a tag in a
    comment, an empty element) are all of them parsed for the draw.
    """
    likely = pages.where(F.col("html").rlike(r"(?i)<(article|main)[\t\n\r\f />]")).select(
        F.xxhash64("page_id", "html").alias("mark"), "page_id", "html")

    def drawn(of: DataFrame) -> DataFrame:
        least = of.select("mark").distinct().orderBy("mark").limit(FIT_PAGES)
        return saved(likely.join(F.broadcast(least), "mark").dropDuplicates(), "page-sample")

    first = drawn(likely)
    if first.mapInArrow(with_marks, first.schema).count() == first.count():
        return first
    return drawn(likely.mapInArrow(with_marks, likely.schema))


def sample_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: what `shown` keeps of each page."""
    kind = pa.list_(pa.struct([("path", pa.list_(pa.string())), ("text", pa.string()), ("linked", pa.int32())]))
    for b in batches:
        rows = [[{"path": list(p), "text": t, "linked": n} for p, t, n in shown(blocks_of(h))] for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("html"), pa.array(rows, kind)], ["html", "blocks"])


SAMPLE = "html string, blocks array<struct<path:array<string>,text:string,linked:int>>"


def extracted(pages: DataFrame) -> DataFrame:
    """Per row of `pages`: row (its columns other than html, as a struct), and text.

    Character references are decoded, white space in a block (no-break space included) becomes one space, and the blocks
    of the main text are joined in page order by a line feed. A null or empty page, and one without main text, gives the
    empty text. Pages of any length are read whole. Repeated rows get equal texts; an empty table gives an empty result.
    Other columns are carried unread, whatever their names.
    """
    small_batches(pages.sparkSession, 256)
    drawn = sample_of(pages).select("mark", "html").dropDuplicates().orderBy("mark").select("html").mapInArrow(sample_blocks, SAMPLE).select("blocks")
    net = fit_blocks([[(tuple(b["path"]), b["text"], b["linked"]) for b in r["blocks"]] for r in drawn.collect()])  # FIT_PAGES rows

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = main_text(net, [h or "" for h in b.column("html").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    rows = pages.select("html", F.struct(*[c for c in pages.columns if c != "html"]).alias("row"))
    return rows.mapInArrow(label, f"row {rows.schema['row'].dataType.simpleString()}, text string")
