"""HTML extraction: a recurrent network labels every block of a page as main text or not.

A page becomes its sequence of leaf blocks. Each block is a vector of its hashed tag path (tags, classes and ids of all elements
around it), the hashed counts of all its words, scaled to one length, and a few measures. A bidirectional LSTM in numpy reads the
sequence, so a label rests on the whole page. The network is trained here on invented pages (html_pages); scripts, styles and
markup never become blocks.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .html_pages import page

#: A prime number of buckets: lengths of a power of two let frequent tags and names meet.
PATH, WORDS, MEASURES = 521, 32, 11
SIZE = PATH + WORDS + MEASURES
HIDDEN = 16
PAGES, EPOCHS, BATCH, RATE = 2200, 12, 24, 0.01
#: Blocks in one padded batch of pages; blocks whose whole vectors are there at once.
BLOCKS_AT_ONCE, VECTORS_AT_ONCE = 20_000, 4096

_RAW = frozenset("script style noscript template textarea svg math iframe object select title head".split())
_TEXT_ONLY = frozenset("script style textarea title".split())
_BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html img "
    "input ins label legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul video audio".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES_P = _BLOCK - frozenset("br button body html img input ins label option".split())
#: A tag that ends an open one of its own name, unless one of these is open inside that.
_SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
#: An end tag doesn't reach over these, but for their own and the page's.
_WALLS, _OVER = ("table", "article", "body"), frozenset(("article", "body", "html"))
_MARK = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z]+")


def _hash(token: str, size: int, seen: dict[str, int] = {}) -> int:  # noqa: B006
    found = seen.get(token)
    if found is None:
        if len(seen) > 100_000:
            seen.clear()
        found = seen[token] = zlib.crc32(token.encode("utf-8", "replace"))
    return found % size


class _Open:
    """The elements that are open, and what a block needs to know of them, kept up as elements come and go: nothing walks over them."""

    def __init__(self):
        self.stack: list[tuple[str, tuple[int, ...]]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.path: dict[int, int] = {}

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a name, or -1."""
        found = self.places.get(tag)
        return found[-1] if found else -1

    def push(self, tag: str, path: tuple[int, ...]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in _BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append((tag, path))
        for x in path:
            self.path[x] = self.path.get(x, 0) + 1

    def cut(self, place: int) -> None:
        """Ends the element at a place, and all inside it."""
        while len(self.stack) > place:
            tag, path = self.stack.pop()
            self.places[tag].pop()
            if tag in _BLOCK:
                self.blocks.pop()
            for x in path:
                if self.path[x] == 1:
                    del self.path[x]
                else:
                    self.path[x] -= 1

    def end(self, tag: str) -> None:
        """An end tag: nothing, if no such element is open or a wall stands inside it."""
        place = self.last(tag)
        if place >= 0 and (tag in _OVER or place >= max(map(self.last, _WALLS))):
            self.cut(place)

    def begin(self, tag: str) -> None:
        """What a start tag ends: a paragraph that is the innermost block, and an open sibling."""
        if tag in _CLOSES_P and self.blocks and self.stack[self.blocks[-1]][0] == "p":
            self.cut(self.blocks[-1])
        if tag in _SIBLINGS:
            place = self.last(tag)
            if place > max(map(self.last, _SIBLINGS[tag])):
                self.cut(place)

    @property
    def leaf(self) -> str:
        return self.stack[self.blocks[-1]][0] if self.blocks else ""


class Blocks:
    """The leaf blocks of a page: texts, and a vector each. The time is linear in the page, however its tags nest."""

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.paths: list[tuple[int, ...]] = []
        self.leaves: list[tuple[str, int, int]] = []
        open_, never = _Open(), set()
        text: list[str] = []
        linked = 0

        def end_block() -> None:
            nonlocal linked
            if text:
                whole = " ".join("".join(text).split())
                if whole:
                    self.texts.append(whole)
                    self.paths.append(tuple(open_.path))
                    self.leaves.append((open_.leaf, linked, len(open_.stack)))
                text.clear()
            linked = 0

        def add(piece: str) -> None:
            nonlocal linked
            if piece:
                piece = entities.unescape(piece) if "&" in piece else piece
                text.append(piece)
                if open_.last("a") >= 0:
                    linked += len(piece)

        at, end, last = 0, len(source), source.rfind(">")
        while at < end:
            m = _MARK.search(source, at, last + 1) if at <= last else None
            if m is None:
                rest = source.find("<!--", at)
                add(source[at : rest if rest >= 0 else end])
                break
            add(source[at : m.start()])
            at = m.end() if m[0][:4] != "<!--" or m[0].endswith("-->") else end
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            closing, attrs = (m[1], m[3]) if m[2] else (m[4], m[6])
            if closing:
                if tag in _BLOCK:
                    end_block()
                open_.end(tag)
                continue
            if tag in _RAW:
                done = None if tag in never else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if done:
                    at = done.end()
                else:
                    never.add(tag)  # nor is there one further on
                    at = end if tag in _TEXT_ONLY else at
                continue
            if tag in _BLOCK:
                end_block()
            open_.begin(tag)
            if tag not in _VOID and not attrs.rstrip().endswith("/"):
                tokens = [f"<{tag}"]
                for found in _NAMED.finditer(attrs):
                    tokens += [f".{x}" for x in _PART.findall((found[1] or found[2] or found[3] or "").lower())]
                open_.push(tag, tuple({_hash(x, PATH) for x in tokens}))
        end_block()

    def vectors(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The vectors of blocks first to last; of all unless told."""
        n = len(self.texts)
        last = n if last is None else min(n, last)
        out = np.zeros((last - first, SIZE), np.float32)
        for i in range(first, last):
            text, path, (leaf, linked, depth), row = self.texts[i], self.paths[i], self.leaves[i], out[i - first]
            row[list(path)] = 1
            row[_hash(f"leaf {leaf}", PATH)] += 1
            words = text.lower().split()
            counts = np.bincount([_hash(w.strip(".,!?:;"), WORDS) for w in words], minlength=WORDS)
            row[PATH : PATH + WORDS] = 2 * counts / np.sqrt(counts @ counts)
            size = len(text)
            row[PATH + WORDS :] = (
                min(np.log1p(size) / 6, 2), min(np.log1p(len(words)) / 5, 2), min(1.0, linked / size), i / max(1, n - 1), min(depth / 10, 2), text[-1] in ".!?",
                leaf == "p", leaf in ("h1", "h2", "h3"), leaf == "li", min(1.0, 4 * sum(map(text.count, ".,;")) / (1 + len(words))), text[:1] == "©",
            )
        return out


class Labeller:
    """A bidirectional LSTM and a logistic output on both states."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {}
        for d in "fb":
            self.p |= {f"x{d}": draw(SIZE, 4 * HIDDEN), f"h{d}": draw(HIDDEN, 4 * HIDDEN), f"c{d}": np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])}
        self.p |= {"o": draw(2 * HIDDEN, 1)[:, 0], "k": np.zeros(1)}

    @staticmethod
    def _sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def given(self, x: np.ndarray, d: str) -> np.ndarray:
        """What vectors (..., SIZE) give to the gates of one direction."""
        return x @ self.p[f"x{d}"] + self.p[f"c{d}"]

    def _scan(self, given: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """States (time, page, HIDDEN) of one direction over padded inputs (time, page, 4 HIDDEN)."""
        steps, pages, _ = given.shape
        h = c = np.zeros((pages, HIDDEN), given.dtype)
        states, kept = np.zeros((steps, pages, HIDDEN), given.dtype), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = given[t] + h @ self.p[f"h{d}"]
            gates = self._sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            top = np.tanh(new)
            if keep:
                kept.append((t, h, c, i, f, o, g, top, m))
            c = np.where(m, new, c)
            h = np.where(m, o * top, h)
            states[t] = h
        return states, kept

    def read(self, given: dict[str, np.ndarray], mask: np.ndarray) -> np.ndarray:
        """Probabilities from what given() makes of either direction's vectors."""
        both = np.concatenate([self._scan(given[d], mask, d, False)[0] for d in "fb"], axis=2)
        return self._sigmoid(both @ self.p["o"] + self.p["k"])

    def probabilities(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self.read({d: self.given(x, d) for d in "fb"}, mask)

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        scans = {d: self._scan(self.given(x, d), mask, d, True) for d in "fb"}
        both = np.concatenate([scans[d][0] for d in "fb"], axis=2)
        error = (self._sigmoid(both @ self.p["o"] + self.p["k"]) - y) * mask / max(1, mask.sum())
        out = {"o": (both * error[:, :, None]).sum(axis=(0, 1)), "k": np.array([error.sum()])}
        for n, d in enumerate("fb"):
            own = error[:, :, None] * self.p["o"][n * HIDDEN : (n + 1) * HIDDEN]
            dz = np.zeros((*x.shape[:2], 4 * HIDDEN))
            back_h = np.zeros((HIDDEN, 4 * HIDDEN))
            dh = dc = np.zeros((x.shape[1], HIDDEN))
            for t, h, c, i, f, o, g, top, m in reversed(scans[d][1]):
                dh = dh + own[t]
                inner = np.where(m, dc + dh * o * (1 - top * top), 0)
                z = np.concatenate([inner * g * i * (1 - i), inner * c * f * (1 - f), np.where(m, dh * top, 0) * o * (1 - o), inner * i * (1 - g * g)], axis=1)
                dz[t] = z
                back_h += h.T @ z
                dh = np.where(m, z @ self.p[f"h{d}"].T, dh)
                dc = np.where(m, inner * f, dc)
            flat = dz.reshape(-1, 4 * HIDDEN)
            out |= {f"x{d}": x.reshape(-1, SIZE).T @ flat, f"h{d}": back_h, f"c{d}": flat.sum(axis=0)}
        return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((steps, len(rows), SIZE), np.float32), np.zeros((steps, len(rows)), bool)
    for i, r in enumerate(rows):
        x[: len(r), i] = r
        mask[: len(r), i] = True
    return x, mask


_NUMBER = re.compile("(\\d+)")


def labelled(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and labels of an invented page's blocks; a block of several parts has the first one's label."""
    source, labels = page(seed)
    found = Blocks(source)
    y = []
    for i, text in enumerate(found.texts):
        m = _NUMBER.search(text)
        y.append(labels[int(m[1])] if m else 0)
        found.texts[i] = _NUMBER.sub("", text).strip() or "-"
    return found.vectors(), np.array(y, float)


def train(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 7) -> Labeller:
    """Adam on invented pages, batches of similar lengths; the same result each time."""
    made = [p for p in map(labelled, range(pages)) if len(p[1])]
    made.sort(key=lambda p: len(p[1]))
    batches = [made[i : i + BATCH] for i in range(0, len(made), BATCH)]
    net, rng = Labeller(seed), np.random.default_rng(seed)
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for b in rng.permutation(len(batches)):
            x, mask = _padded([p[0] for p in batches[b]])
            y = np.zeros(mask.shape)
            for i, (_, labels) in enumerate(batches[b]):
                y[: len(labels), i] = labels
            step += 1
            for k, g in net.gradients(x, mask, y).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    net.p = {k: v.astype(np.float32) for k, v in net.p.items()}
    return net


@lru_cache(maxsize=1)
def trained() -> Labeller:
    return train()


def main_texts(net: Labeller, sources: list[str | None]) -> list[str]:
    """The main text of each page: its blocks labelled so, in order, joined by a space."""
    parsed = [Blocks(s or "") for s in sources]
    out = [""] * len(sources)
    order = sorted((i for i, p in enumerate(parsed) if p.texts), key=lambda i: len(parsed[i].texts))
    at = 0
    while at < len(order):
        lot = [order[at]]
        while at + len(lot) < len(order) and len(parsed[order[at + len(lot)]].texts) * (len(lot) + 1) <= BLOCKS_AT_ONCE:
            lot.append(order[at + len(lot)])
        steps = len(parsed[lot[-1]].texts)
        given, mask = {d: np.zeros((steps, len(lot), 4 * HIDDEN), np.float32) for d in "fb"}, np.zeros((steps, len(lot)), bool)
        for k, i in enumerate(lot):
            mask[: len(parsed[i].texts), k] = True
            for first in range(0, len(parsed[i].texts), VECTORS_AT_ONCE):
                x = parsed[i].vectors(first, first + VECTORS_AT_ONCE)
                for d in "fb":
                    given[d][first : first + len(x), k] = net.given(x, d)
        keep = net.read(given, mask) >= 0.5
        for k, i in enumerate(lot):
            out[i] = " ".join(t for t, yes in zip(parsed[i].texts, keep[:, k], strict=False) if yes)
        at += len(lot)
    return out


def extract(pages: DataFrame, net: Labeller | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each input row: the id, url, text, n_chars.

    Null and empty pages, and those without main text, have an empty text. Repeated rows give repeated rows; an empty table
    none; other columns are ignored. Pages of any length are read whole.
    """
    small_batches(pages.sparkSession)
    net = net or trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = main_texts(net, some.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kind = source.schema["page_id"].dataType.simpleString()
    found = source.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
    return found.select(F.col("page_id").alias(id_col), F.col("url").alias(url_col), "text", "n_chars")
