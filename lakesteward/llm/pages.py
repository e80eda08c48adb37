"""The main text of web pages: every block is labelled by a bidirectional LSTM over the page's blocks.

A page is read into leaf blocks: runs of text between block-level tags. Each block becomes a vector of
hashed tag-path parts (tags, classes and ids of its ancestors), hashed words and a few measures. The network reads
the page's blocks forwards and backwards, so each label depends on the whole page.

It is trained here, in numpy, on a sample of TRAIN_PAGES pages, the first by a hash of the id; of a page of more than
TRAIN_CHARS characters the blocks of its beginning and its end train, about so many characters. Labels come from the innermost container with a telling name; the
same texts are also laid out in other containers, in other orders, and with comments,
forms, notices and sidebars around them, so that more kinds of pages are known than the sample has.

Defined results: a null or empty page gives an empty text and 0 characters; a page cut off in the middle is read up
to there; a block's path is its MAX_PATH innermost elements and before them as many outer ones with a telling name; stray quotes in a tag end nothing and hide nothing; repeated pages get equal rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as html_module
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 192
TRAIN_CHARS = 60_000
LAYOUTS = 4
PATH_BITS, NEAR_BITS, WORD_BITS, MEASURES = 512, 128, 32, 6
WIDTH = PATH_BITS + NEAR_BITS + WORD_BITS + MEASURES
HIDDEN = 16
EPOCHS, RATE, BATCH = 14, 0.02, 32
MAX_PATH = 24
CELLS = 8192

# Elements of HTML by their role in the text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
UNSHOWN = set("select button template svg noscript datalist audio video canvas object".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img input br".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
LIMITS = set("ul ol dl table body html article section div main aside nav header footer form".split())

# Names of containers, for the labels of the training pages.
MAIN_NAMES = set("article main content post entry story text body-text articlebody maincontent entrycontent postcontent".split())
OTHER_NAMES = set(
    "nav menu navigation navbar header masthead footer aside sidebar widget ad ads advert advertisement banner promo sponsored "
    "cookie cookies notice consent gdpr popup modal overlay form newsletter subscribe signup login search comment comments "
    "discussion replies respond disqus related recommended share social breadcrumb breadcrumbs pagination pager tags toc alert".split()
)

# As in HTML, quotes enclose a value only right after the '=' of an attribute; elsewhere they are ordinary characters.
TAG = re.compile(
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]++|(?=>)))?+)*+)>"""
)
# For what follows a tag that quoted values carry to the end of the page.
SHORT_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
NAME = re.compile(r"[A-Za-z]+")


@dataclass
class Block:
    """A leaf block: the name parts of its ancestors, outermost first, its text and how much of it is links."""

    path: list[tuple[str, ...]]
    text: str
    linked: int = 0
    label: int = 0


@dataclass
class _Reader:
    """Blocks of one page. Open elements are a stack; every block-level tag ends the current block."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    telling: list[int] = field(default_factory=list)
    open: dict[str, int] = field(default_factory=dict)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    hidden: int = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(self.path(), text, min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def path(self) -> list[tuple[str, ...]]:
        """Names of the MAX_PATH innermost elements, and before them those of as many outer ones that tell their role."""
        inner = max(0, len(self.stack) - MAX_PATH)
        outer = [i for i in self.telling[-2 * MAX_PATH:] if i < inner][-MAX_PATH:] if inner else []
        return [self.stack[i][1] for i in outer] + [names for _, names in self.stack[inner:]]

    def add(self, raw: str) -> None:
        if raw and not self.hidden:
            text = html_module.unescape(raw) if "&" in raw else raw
            self.parts.append(text)
            if self.open.get("a"):
                self.linked += len(text)

    def pop(self) -> None:
        name, _ = self.stack.pop()
        if self.telling and self.telling[-1] == len(self.stack):
            self.telling.pop()
        self.open[name] -= 1
        self.hidden -= name in UNSHOWN

    def close(self, names: set[str], limits: set[str]) -> None:
        """Closes the innermost of the named elements, unless a limit stands in between."""
        if not any(self.open.get(n) for n in names):
            return
        for depth in range(len(self.stack) - 1, -1, -1):
            name = self.stack[depth][0]
            if name in names:
                while len(self.stack) > depth:
                    self.pop()
                return
            if name in limits:
                return

    def start(self, name: str, attributes: str) -> None:
        if name not in INLINE:
            self.flush()
            self.close({"p"}, LIMITS - {"div"} | {"div", "td", "th", "li"})
        elif name == "br":
            self.parts.append(" ")
        if name in CLOSES:
            self.close(CLOSES[name], LIMITS - CLOSES[name])
        if name in VOID:
            return
        names = (name,)
        if attributes and "=" in attributes:
            values = [v.strip("\"'") for v in ATTRIBUTE.findall(attributes)]
            names += tuple(dict.fromkeys(w.lower() for v in values for w in NAME.findall(v)))
        if not MAIN_NAMES.isdisjoint(names) or not OTHER_NAMES.isdisjoint(names):
            self.telling.append(len(self.stack))
        self.stack.append((name, names))
        self.open[name] = self.open.get(name, 0) + 1
        self.hidden += name in UNSHOWN

    def end(self, name: str) -> None:
        if name in INLINE:
            if self.open.get(name) and any(n not in INLINE for n, _ in self.stack[-64:]):
                for depth in range(len(self.stack) - 1, -1, -1):
                    if self.stack[depth][0] == name:
                        while len(self.stack) > depth:
                            self.pop()
                        return
                    if self.stack[depth][0] not in INLINE:
                        return
            return
        self.flush()
        if self.open.get(name):
            while self.stack[-1][0] != name:
                self.pop()
            self.pop()


def read_blocks(page: str) -> list[Block]:
    """Leaf blocks of a page, in page order. Every character is looked at a bounded number of times."""
    reader, at, size, tags = _Reader(), 0, len(page), TAG
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            reader.add(page[at:])
            break
        reader.add(page[at:tag])
        follows = page[tag + 1:tag + 2]
        letter = page[tag + 2:tag + 3] if follows == "/" else follows
        if letter.isascii() and letter.isalpha():
            m = tags.match(page, tag)
            if not m and tags is TAG:
                # No '>' outside quoted values follows: from here on any '>' ends a tag, and the text between is kept.
                tags = SHORT_TAG
                m = tags.match(page, tag)
            if not m:
                break
            name, at = m[2].lower(), m.end()
            if m[1]:
                reader.end(name)
            elif name in RAW:
                reader.flush()
                stop = re.compile(rf"</{re.escape(name)}[\s/>]", re.IGNORECASE).search(page, at)
                if not stop:
                    break
                close = page.find(">", stop.start())
                at = size if close < 0 else close + 1
            else:
                reader.start(name, m[3])
        elif page.startswith("<!--", tag):
            stop = page.find("-->", tag + 2)
            at = size if stop < 0 else stop + 3
        elif follows in ("!", "?", "/"):
            stop = page.find(">", tag)
            at = size if stop < 0 else stop + 1
        else:
            reader.add("<")
            at = tag + 1
    reader.flush()
    return reader.blocks


# --- features ----------------------------------------------------------------

_slots: dict[tuple[str, int, str], int] = {}


def _slot(word: str, width: int, kind: str) -> int:
    key = (word, width, kind)
    place = _slots.get(key)
    if place is None:
        if len(_slots) > 200_000:
            _slots.clear()
        place = _slots[key] = zlib.crc32(f"{kind}:{word}".encode("utf-8", "surrogatepass")) % width
    return place


def features(blocks: list[Block]) -> np.ndarray:
    x = np.zeros((len(blocks), WIDTH), np.float32)
    for i, block in enumerate(blocks):
        row = x[i]
        for up, names in enumerate(reversed(block.path)):
            for name in names:
                row[_slot(name, PATH_BITS, "path")] = 1
                if up < 2:
                    row[PATH_BITS + _slot(name, NEAR_BITS, "near")] = 1
        words = block.text.lower().split()
        bag = np.bincount([_slot(w, WORD_BITS, "word") for w in words], minlength=WORD_BITS)
        row[PATH_BITS + NEAR_BITS:-MEASURES] = bag / len(words)
        last = block.text[-1]
        row[-MEASURES:] = (
            np.log1p(len(words)) / 5, block.linked / len(block.text), last in ".!?", len(words) < 4,
            sum(map(len, words)) / len(words) / 10, 1.0,
        )
    return x


# --- network -----------------------------------------------------------------

def new_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    weights = {"out": normal(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for way in ("forth", "back"):
        weights[f"x_{way}"] = normal(WIDTH, 4 * HIDDEN, scale=0.1)
        weights[f"h_{way}"] = normal(HIDDEN, 4 * HIDDEN, scale=0.2)
        weights[f"b_{way}"] = np.zeros(4 * HIDDEN, np.float32)
    return weights


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(gates_in: np.ndarray, recurrent: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """One direction of the LSTM over (pages, blocks, 4 * HIDDEN); padding carries the state on."""
    pages, length, _ = gates_in.shape
    h = np.zeros((pages, HIDDEN), np.float32)
    c = np.zeros_like(h)
    out = np.zeros((pages, length, HIDDEN), np.float32)
    for t in range(length):
        a = gates_in[:, t] + h @ recurrent
        i, f, o = (_sigmoid(a[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(a[:, 3 * HIDDEN:])
        m = mask[:, t, None]
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        h_new = o * tc
        if keep is not None:
            keep.append((h, c, i, f, o, g, tc))
        c = m * c_new + (1 - m) * c
        h = m * h_new + (1 - m) * h
        out[:, t] = h
    return out


def _run_back(keep: list, recurrent: np.ndarray, mask: np.ndarray, d_out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the gate inputs and of the recurrent weights."""
    pages, length, _ = d_out.shape
    d_gates = np.zeros((pages, length, 4 * HIDDEN), np.float32)
    d_rec = np.zeros_like(recurrent)
    dh = np.zeros((pages, HIDDEN), np.float32)
    dc = np.zeros_like(dh)
    for t in range(length - 1, -1, -1):
        h, c, i, f, o, g, tc = keep[t]
        m = mask[:, t, None]
        dh = dh + d_out[:, t]
        dh_new, dc_new = m * dh, m * dc
        dc_new = dc_new + dh_new * o * (1 - tc * tc)
        a = np.concatenate((
            dc_new * g * i * (1 - i), dc_new * c * f * (1 - f), dh_new * tc * o * (1 - o), dc_new * i * (1 - g * g)
        ), axis=1)
        d_gates[:, t] = a
        d_rec += h.T @ a
        dh = (1 - m) * dh + a @ recurrent.T
        dc = (1 - m) * dc + dc_new * f
    return d_gates, d_rec


def _reverse(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each page's blocks in reverse, padding where it was."""
    at = np.arange(x.shape[1])[None, :]
    order = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
    return np.take_along_axis(x, order.reshape(order.shape + (1,) * (x.ndim - 2)), axis=1)


def _padded(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for p in parts])
    out = np.zeros((len(parts), lengths.max(), *parts[0].shape[1:]), np.float32)
    for i, part in enumerate(parts):
        out[i, :len(part)] = part
    return out, lengths, (np.arange(out.shape[1])[None, :] < lengths[:, None]).astype(np.float32)


def train(pages: list[list[Block]], seed: int = 7) -> dict[str, np.ndarray]:
    """Weights from labelled pages, by Adam on the cross-entropy of all blocks."""
    rng = np.random.default_rng(seed)
    weights = new_weights(rng)
    pages = sorted((p for p in pages if p), key=len)
    data = [(features(p), np.array([b.label for b in p], np.float32)) for p in pages]
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    groups = [data[i:i + BATCH] for i in range(0, len(data), BATCH)]
    step = 0
    for epoch in range(EPOCHS):
        for g in rng.permutation(len(groups)):
            x, lengths, mask = _padded([f for f, _ in groups[g]])
            y, _, _ = _padded([label for _, label in groups[g]])
            keeps: dict[str, list] = {"forth": [], "back": []}
            inputs = {"forth": x, "back": _reverse(x, lengths)}
            states = {
                w: _run(inputs[w] @ weights[f"x_{w}"] + weights[f"b_{w}"], weights[f"h_{w}"], mask, keeps[w]) for w in inputs
            }
            both = np.concatenate((states["forth"], _reverse(states["back"], lengths)), axis=2)
            guess = _sigmoid(both @ weights["out"] + weights["bias"])
            d = (guess - y) * mask / mask.sum()
            grads = {"out": np.einsum("pt,pth->h", d, both), "bias": np.array([d.sum()], np.float32)}
            d_both = d[:, :, None] * weights["out"]
            d_state = {"forth": d_both[:, :, :HIDDEN], "back": _reverse(np.ascontiguousarray(d_both[:, :, HIDDEN:]), lengths)}
            for w in inputs:
                gates, grads[f"h_{w}"] = _run_back(keeps[w], weights[f"h_{w}"], mask, d_state[w])
                grads[f"x_{w}"] = np.tensordot(inputs[w], gates, axes=((0, 1), (0, 1)))
                grads[f"b_{w}"] = gates.sum(axis=(0, 1))
            step += 1
            rate = RATE * (1 - 0.9 * epoch / EPOCHS)
            for k, grad in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.99 * second[k] + 0.01 * grad * grad
                scale = np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6
                weights[k] = (weights[k] - rate * first[k] / (1 - 0.9 ** step) / scale).astype(np.float32)
    return weights


def label(weights: dict[str, np.ndarray], pages: list[list[Block]]) -> list[np.ndarray]:
    """For every page which of its blocks are main text. Pages of like length go through the network together."""
    result: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop + 1 - at) * len(pages[order[stop]]) <= CELLS:
            stop += 1
        group = [pages[i] for i in order[at:stop]]
        gates = [_gates(weights, blocks) for blocks in group]
        scores = []
        for k, way in enumerate(("forth", "back")):
            x, lengths, mask = _padded([g[k] for g in gates])
            if way == "back":
                x = _reverse(x, lengths)
            state = _run(x, weights[f"h_{way}"], mask)
            scores.append(_reverse(state, lengths) if way == "back" else state)
        guess = np.concatenate(scores, axis=2) @ weights["out"] + weights["bias"]
        for i, row in zip(order[at:stop], guess):
            result[i] = row[:len(pages[i])] > 0
        at = stop
    return result


def _gates(weights: dict[str, np.ndarray], blocks: list[Block]) -> tuple[np.ndarray, np.ndarray]:
    """Gate inputs of both directions, built some blocks at a time."""
    parts: tuple[list, list] = ([], [])
    for low in range(0, len(blocks), 2048):
        x = features(blocks[low:low + 2048])
        for k, way in enumerate(("forth", "back")):
            parts[k].append(x @ weights[f"x_{way}"] + weights[f"b_{way}"])
    return np.concatenate(parts[0]), np.concatenate(parts[1])


# --- training pages ----------------------------------------------------------

def container_label(path: list[tuple[str, ...]]) -> int:
    """1 if the innermost telling container is one of main text. A header inside main text counts as such."""
    inside = 0
    for names in path:
        kinds = set(names)
        if kinds & OTHER_NAMES and not (inside and kinds == {"header"}):
            inside = 0
        elif kinds & MAIN_NAMES:
            inside = 1
    return inside


_MAIN = (("article",), ("main",), ("div", "content"), ("div", "post"), ("div", "entry", "content"), ("section", "story"),
         ("div", "article", "body"), ("article", "post", "hentry"), ("div", "main", "text"), ("div", "article"))
_BEFORE = (("nav",), ("header",), ("div", "header"), ("div", "menu"), ("ul", "navbar"), ("div", "ad"), ("div", "banner"),
           ("div", "cookie", "notice"), ("div", "consent"), ("ul", "breadcrumb"), ("aside",), ("div", "sidebar"), ("form", "search"),
           ("div", "alert"), ("div", "popup"), ("header", "masthead"), ("div", "top", "navigation"), ("div", "gdpr"))
_AFTER = (("footer",), ("div", "footer"), ("section", "comments"), ("div", "comments"), ("div", "comment"), ("ol", "comment", "list"),
          ("aside",), ("div", "sidebar"), ("div", "related"), ("div", "share"), ("form", "newsletter"), ("div", "subscribe"), ("form",),
          ("div", "ad"), ("div", "advert"), ("div", "promo"), ("div", "social"), ("div", "widget"), ("div", "sponsored"),
          ("section", "discussion"), ("div", "login"), ("ul", "pagination"), ("div", "replies"), ("div", "ads"), ("div", "advertisement"),
          ("div", "recommended"), ("div", "modal"), ("section", "related"))
_WITHIN = (("div", "ad"), ("aside",), ("div", "share"), ("div", "newsletter"), ("div", "related"), ("div", "promo"), ("form",), ("div", "advert"))
_INNER = (("p",), ("p",), ("p",), ("p",), ("h2",), ("li",), ("blockquote",), ("td",), ("figcaption",), ("pre",), ("h3",), ("div",))


def laid_out(rng: np.random.Generator, prose: list[str], short: list[str]) -> list[Block]:
    """A page of given texts in containers drawn at random."""
    outer = [("html",), ("body",)] + [("div",), ("div", "page"), ("div", "wrapper"), ("div", "container")][:rng.integers(0, 2)]

    def pick(values):
        return values[rng.integers(len(values))]

    def other(names: tuple[str, ...]) -> list[Block]:
        blocks = []
        for _ in range(rng.integers(1, 6)):
            linked = rng.random() < 0.4
            text = pick(short) if linked or rng.random() < 0.4 else pick(prose)
            inner = [("ul",), ("li",), ("a",)] if linked else [pick([("p",), ("div",), ("span",), ("li",), ("h3",)])]
            blocks.append(Block(outer + [names] + inner, text, len(text) if linked else 0, 0))
        return blocks

    page: list[Block] = []
    for _ in range(rng.integers(0, 4)):
        page += other(pick(_BEFORE))
    main = pick(_MAIN)
    inside = outer + [main]
    title = [("header",), ("h1",)] if rng.random() < 0.3 else [("h1",)]
    page.append(Block(inside + title, pick(short), 0, 1))
    for _ in range(rng.integers(1, 14)):
        inner = pick(_INNER)
        path = [("ul",), inner] if inner[0] == "li" else [("table",), ("tr",), inner] if inner[0] == "td" else [inner]
        text = pick(short) if rng.random() < 0.3 else pick(prose)
        page.append(Block(inside + path, text, 0, 1))
        if rng.random() < 0.12:
            page += [Block(inside + b.path[len(outer):], b.text, b.linked, 0) for b in other(pick(_WITHIN))]
    for _ in range(rng.integers(0, 5)):
        page += other(pick(_AFTER))
    return page


def training_pages(pages: list[str] | list[list[Block]], seed: int = 11) -> list[list[Block]]:
    """The pages with labels by container, and LAYOUTS further layouts for each, of their own texts."""
    rng = np.random.default_rng(seed)
    read = [read_blocks(p) if isinstance(p, str) else p for p in pages]
    for blocks in read:
        for block in blocks:
            block.label = container_label(block.path)
    texts = [b.text for blocks in read for b in blocks]
    prose = [t for t in texts if len(t) > 60] or texts
    short = [t for t in texts if len(t) <= 60] or texts
    if not texts:
        return []
    return read + [laid_out(rng, prose, short) for _ in range(LAYOUTS * len(read))]


def sample_blocks(page: str) -> list[Block]:
    """A page's blocks for training: all of them, or those of its beginning and its end, about TRAIN_CHARS characters with their paths."""
    blocks = read_blocks(page)
    sizes = np.cumsum([min(len(b.text), TRAIN_CHARS // 2) + 32 for b in blocks])
    if len(page) <= TRAIN_CHARS or not blocks or sizes[-1] <= TRAIN_CHARS:
        return blocks
    head = max(1, int(np.searchsorted(sizes, TRAIN_CHARS // 2)))
    tail = max(head, min(len(blocks) - 1, int(np.searchsorted(sizes, sizes[-1] - TRAIN_CHARS // 2)) + 1))
    most = TRAIN_CHARS // 2
    return [Block(b.path, b.text[:most], min(b.linked, most)) for b in blocks[:head] + blocks[tail:]]


def trained(pages: DataFrame) -> dict[str, np.ndarray] | None:
    """Weights from a bounded sample of the table: TRAIN_PAGES pages of any length, TRAIN_CHARS characters of each; None if no page has text."""
    usable = pages.where("html is not null")
    # The bound comes first, from hashes alone, so that only blocks of the sample leave the tasks.
    order = F.xxhash64("page_id")
    first = [row[0] for row in usable.select(order.alias("h")).orderBy("h").limit(TRAIN_PAGES).collect()]
    if not first:
        return None
    sample = usable.where(order <= first[-1]).orderBy(F.xxhash64("page_id"), F.length("html"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0).to_pylist():
                held = [[b.path, b.text, b.linked] for b in sample_blocks(page)]
                yield pa.RecordBatch.from_pydict({"blocks": pa.array([json.dumps(held)])})

    rows = sample.limit(TRAIN_PAGES).select("html").mapInArrow(read, "blocks string").collect()
    held = [[Block([tuple(names) for names in path], text, linked) for path, text, linked in json.loads(row[0])] for row in rows]
    labelled = training_pages(held)
    return train(labelled) if labelled else None


def main_text(pages: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks`` of each page."""
    weights = trained(pages) if weights is None else weights
    sent = pages.sparkSession.sparkContext.broadcast(weights)
    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                read = [read_blocks(page or "") for page in part.column(2).to_pylist()]
                chosen = label(sent.value, read) if sent.value else [np.ones(len(b), bool) for b in read]
                texts = ["\n".join(b.text for b, keep in zip(blocks, keeps) if keep) for blocks, keeps in zip(read, chosen)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([len(b) for b in read], pa.int64())],
                    names=["page_id", "url", "text", "n_chars", "n_blocks"],
                )

    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long, n_blocks long"
    return pages.select("page_id", "url", "html").mapInArrow(extract, schema)
