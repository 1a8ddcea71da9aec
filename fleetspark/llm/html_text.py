"""Main text of web pages by a recurrent block labeller.

A page is cut into its leaf blocks: the runs of text between block-level tags,
each with the path of open elements (names, classes and ids). Scripts, styles
and the like are no text. A bidirectional LSTM reads the sequence of blocks, each as

* the mean vector of its hashed path entries and the vector of its innermost element,
* the mean vector of its hashed words,
* numbers: length, share of link text, punctuation, place in the page,

and decides for every block, in the context of the whole page, whether it is
main text. The kept blocks, with character references decoded and white space
turned into single spaces, are joined by one newline.

Training (numpy, one task) uses about ``TRAIN_PAGES`` pages, at most twice as many, chosen by a hash.
Pages carry no labels, so the lessons are made: a page that marks its article
or main element teaches by its marks, and the same blocks are dressed again in
other layouts (containers and boilerplate drawn from the lists below), where
every block's part is known.

Every open element describes a block, whatever the depth: the sums of path
vectors are carried from an element to those inside it, so a page costs its size.

Defined results: a null or empty page gives the empty text; markup that is never
closed ends with the page; a tag that the page's end cuts off is dropped; no page is cut
short and no block is dropped for its size; an empty table gives no rows;
repeated rows each get their result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.llm.common import hash_sample, map_arrow, map_texts, utf8
from fleetspark.llm.gru import Adam, sigmoid, sum_rows
from fleetspark.llm.hashing import U, Words
from fleetspark.llm.lstm import lstm_backward, lstm_forward

PATH_ROWS, WORD_ROWS = 1 << 11, 1 << 12
VECTOR, STATE, NUMBERS = 12, 16, 6
TRAIN_PAGES, DRESSED, EPOCHS, BATCH, RATE = 1200, 2, 4, 24, 0.01
#: Lessons gone over at least (small samples are gone over more often).
LEAST_SEEN = 12_000

# Fixed values of HTML: elements that break a run of text, and elements whose content is no text.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search
section select summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = frozenset("script style title textarea template noscript iframe object svg math audio video canvas".split())
#: Those of them that hold no markup: only their own end tag ends them.
RAW_TAGS = frozenset("script style title textarea iframe".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
#: Elements that an implied end tag does not reach beyond.
SCOPE = frozenset("table ul ol dl select body html article section div main nav aside header footer form".split())

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^<>])*+)>|<[!?][^<>]*+>""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^<>]*+>", re.I) for name in RAW_TAGS}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_CUT = re.compile(r"<(?:[a-zA-Z/!?][^<>]*)?\Z")


class Element:
    """An open element: its path entries, those around it, and whether they mark main text or boilerplate."""

    __slots__ = ("name", "names", "parent", "depth", "entries", "main", "other")

    def __init__(self, name: str, names: tuple, parent: Element | None = None):
        self.name, self.names, self.parent = name, names, parent
        self.depth = parent.depth + 1 if parent else 0
        self.entries = len(names) + (parent.entries if parent else 0)
        self.main = bool(parent and parent.main) or not MAIN.isdisjoint(names)
        self.other = bool(parent and parent.other) or not BOILERPLATE.isdisjoint(names)


@dataclass
class Block:
    text: str
    place: Element
    linked: int = 0

    @property
    def path(self) -> tuple:
        """Entries of all open elements, outermost first."""
        out, e = [], self.place
        while e is not None:
            out.append(e.names)
            e = e.parent
        return tuple(n for names in reversed(out) for n in names)


@dataclass
class _Run:
    pieces: list = field(default_factory=list)
    linked: int = 0


class _Stack:
    """Open elements, with what is asked of them kept up to date: every step costs the elements it opens or closes."""

    def __init__(self):
        self.root = Element("", ())
        self.open: list[Element] = []
        self.places: dict[str, list[int]] = {}
        #: Within each open scope, places by name.
        self.scopes: list[dict[str, list[int]]] = [{}]

    @property
    def top(self) -> Element:
        return self.open[-1] if self.open else self.root

    def push(self, name: str, names: tuple) -> None:
        at = len(self.open)
        self.scopes[-1].setdefault(name, []).append(at)
        self.places.setdefault(name, []).append(at)
        if name in SCOPE:
            self.scopes.append({})
        self.open.append(Element(name, names, self.top))

    def pop(self) -> Element:
        e = self.open.pop()
        if e.name in SCOPE:
            self.scopes.pop()
        self.scopes[-1][e.name].pop()
        self.places[e.name].pop()
        return e

    def innermost(self, name: str) -> int | None:
        found = self.places.get(name)
        return found[-1] if found else None

    def outermost_in_scope(self, names: set) -> int | None:
        return min((found[0] for found in map(self.scopes[-1].get, names) if found), default=None)


def _entries(name: str, attributes: str) -> tuple:
    """Path entries of an element: its name, and the words of its class, id and role."""
    if not attributes or "=" not in attributes:
        return (name,)
    words = (w for m in _NAMES.finditer(attributes) for w in re.split(r"[^a-z0-9]+", (m[1] or m[2] or m[3] or "").lower()))
    return (name, *("." + w for w in words if w))


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order."""
    out: list[Block] = []
    stack = _Stack()
    run = _Run()
    links = 0

    def flush():
        nonlocal run
        if run.pieces:
            text = " ".join(html.unescape("".join(run.pieces)).split())
            if text:
                out.append(Block(text, stack.top, min(run.linked, len(text))))
            run = _Run()

    def close(upto: int):
        nonlocal links
        if any(e.name in BLOCK_TAGS for e in stack.open[upto:]):
            flush()
        while len(stack.open) > upto:
            links -= stack.pop().name == "a"

    def say(text: str):
        if text:
            run.pieces.append(text)
            if links:
                run.linked += len(text)

    at, silent = 0, None
    while m := _TOKEN.search(page, at):
        if silent is None:
            say(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if name in RAW_TAGS and not m[1] and not m[3].endswith("/"):
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if silent is not None:
            if m[1] and name == silent:
                silent = None
            continue
        if not name:
            continue
        if m[1]:
            k = stack.innermost(name)
            if k is not None:
                close(k)
            continue
        if name in SILENT_TAGS:
            if not m[3].endswith("/"):
                silent = name
            continue
        if name in BLOCK_TAGS:
            last = stack.outermost_in_scope(CLOSED_BY.get(name, set()) | {"p"})
            flush()
            if last is not None:
                close(last)
        if name in VOID_TAGS:
            if name == "br":
                run.pieces.append(" ")
            continue
        stack.push(name, _entries(name, m[3]))
        links += name == "a"
    if silent is None:
        say(_CUT.sub("", page[at:]))
    flush()
    return out


# --- lessons -----------------------------------------------------------------------------------------------------

MAIN = {"article", "main", ".article", ".main"}
BOILERPLATE = {"nav", "aside", "footer", "form", "menu", "dialog", "button", "select", ".ad", ".ads", ".advert", ".nav", ".menu", ".sidebar",
               ".footer", ".comments", ".comment", ".cookie", ".notice", ".promo", ".sponsored", ".related"}


def _marked(place: Element) -> float:
    return float(place.main and not place.other)


_BODY = ("html", "body")
MAIN_LAYOUTS = ["article", "main", "main article", "div .content", "div .main .content", "div .post section", "div .entry .content", "article .post",
                "div .article .body", "div .story", "section .text", "div .page div .content", "article div .body", "main section"]
#: Boilerplate layouts by place: before, inside, after the main text.
BEFORE = ["header h1", "header .site .header p", "div .header div", "nav ul li a", "div .menu ul li a", "ul .nav li a", "div .breadcrumb a",
          "div .cookie .notice p", "div .banner p", "div .notice p", "form input", "form .search label", "div .ad", "div .advert p", "div .topbar span"]
INSIDE = ["div .ad", "div .ads p", "aside p", "aside .sidebar ul li a", "div .promo p", "div .sponsored div", "form .newsletter p", "div .share ul li a",
          "div .related ul li a", "div .notice p", "figure .ad figcaption", "nav .toc ul li a"]
AFTER = ["div .comments p", "section .comments div .comment p", "ol .commentlist li p", "div .comment div .body p", "ul .comments li", "article .comment p",
         "section .reader .comments article p", "aside p", "div .sidebar p", "aside .sidebar h3", "div .related ul li a", "footer", "footer p", "div .footer p",
         "div .copyright", "form .login label", "form p", "div .widget ul li a", "div .ad"]


def _dress(main: list[Block], other: list[str], rnd: np.random.Generator) -> tuple[list[Block], list[float]]:
    """The main blocks in another layout, among boilerplate whose words come from links, notices and prose of other pages."""
    out, part = [], []

    def add(layout: str, wrap: tuple = ()):
        path = tuple(layout.split())
        many = int(rnd.integers(2, 7)) if path[-1] in ("a", "li") else int(rnd.integers(1, 4))
        for _ in range(many):
            text = other[int(rnd.integers(len(other)))]
            if path[-1] in ("a", "li"):
                text = " ".join(text.split()[:int(rnd.integers(1, 4))]) or text
            out.append(Block(text, Element("", _BODY + wrap + path), len(text) if path[-1] == "a" else 0))
            part.append(0.0)

    layout = tuple(MAIN_LAYOUTS[int(rnd.integers(len(MAIN_LAYOUTS)))].split())
    for k in rnd.permutation(len(BEFORE))[:int(rnd.integers(1, 4))]:
        add(BEFORE[k])
    for i, b in enumerate(main):
        inner = ("h1",) if i == 0 and rnd.random() < 0.7 else ("h2",) if rnd.random() < 0.05 else ("p", "b") if b.place.names == ("b",) else ("p",)
        inner = ("li",) if len(b.text) < 60 and rnd.random() < 0.05 else inner
        out.append(Block(b.text, Element("", _BODY + layout + inner), 0))
        part.append(1.0)
        if rnd.random() < 0.05:
            add(INSIDE[int(rnd.integers(len(INSIDE)))], layout)
    for k in rnd.permutation(len(AFTER))[:int(rnd.integers(1, 4))]:
        add(AFTER[k], layout if rnd.random() < 0.3 else ())
    return out, part


def lessons(pages: list[str], seed: int = 3) -> list[tuple[list[Block], np.ndarray]]:
    rnd = np.random.default_rng(seed)
    cut = [b for b in map(blocks, pages) if b]
    texts = [x.text for b in cut for x in b]
    out = []
    for b in cut:
        part = np.array([_marked(x.place) for x in b], np.float32)
        if not part.any():
            continue
        out.append((b, part))
        main = [x for x, y in zip(b, part) if y]
        for _ in range(DRESSED):
            made, y = _dress(main, texts, rnd)
            out.append((made, np.array(y, np.float32)))
    return out


# --- network -----------------------------------------------------------------------------------------------------

_PUNCTUATION = re.compile(r"[.,;:!?]")
_ROWS: dict[str, int] = {}


def _path_row(entry: str) -> int:
    row = _ROWS.get(entry)
    if row is None:
        if len(_ROWS) > 100_000:
            _ROWS.clear()
        row = _ROWS[entry] = zlib.crc32(entry.encode()) % PATH_ROWS
    return row


class Inputs:
    """Features of the blocks of a batch of pages, flat, and each block's place in a padded (T, B) grid."""

    def __init__(self, pages: list[list[Block]]):
        flat = [b for p in pages for b in p]
        n = np.array([len(p) for p in pages], np.int64)
        self.page = np.repeat(np.arange(len(pages)), n)
        self.step = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
        self.shape = (int(n.max(initial=0)), len(pages))
        # the elements around the blocks, each once, by depth: an element's sum is its parent's and its own entries
        held: dict[int, Element] = {}
        for b in flat:
            e = b.place
            while e is not None and id(e) not in held:
                held[id(e)] = e
                e = e.parent
        elements = sorted(held.values(), key=lambda e: e.depth)
        number = {id(e): i for i, e in enumerate(elements)}
        self.parent = np.array([number[id(e.parent)] if e.parent else -1 for e in elements], np.int64)
        depth = np.array([e.depth for e in elements], np.int64)
        self.levels = np.searchsorted(depth, np.arange(depth[-1] + 2)).tolist() if elements else []
        self.entry = np.array([_path_row(n) for e in elements for n in e.names], np.int64)
        self.entry_n = np.array([len(e.names) for e in elements], np.int64)
        self.place = np.array([number[id(b.place)] for b in flat], np.int64)
        self.path_n = np.array([b.place.entries for b in flat], np.int64)
        self.leaf = np.array([_path_row(b.place.names[-1] if b.place.names else "") for b in flat], np.int64)
        words = Words([b.text.lower().encode() for b in flat])
        self.word = (words.hash >> U(20)).astype(np.int64) % WORD_ROWS
        self.word_n = np.diff(words.first)
        size = np.array([len(b.text) for b in flat], np.float32)
        self.numbers = np.stack([
            np.log1p(size) / 8, np.array([b.linked for b in flat], np.float32) / np.maximum(size, 1),
            np.array([len(_PUNCTUATION.findall(b.text)) for b in flat], np.float32) / np.maximum(self.word_n, 1),
            self.step / np.maximum(n[self.page], 1), 1 / (1 + self.step), 1 / (n[self.page] - self.step).clip(1),
        ], axis=1).astype(np.float32) if flat else np.zeros((0, NUMBERS), np.float32)


def _sum(table: np.ndarray, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sum of each run of ``n`` rows of the table."""
    out = np.zeros((len(n), table.shape[1]), np.float32)
    some = np.flatnonzero(n)
    if len(some):
        out[some] = np.add.reduceat(table[rows], (np.cumsum(n) - n)[some], axis=0)
    return out


def _mean(table: np.ndarray, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    return _sum(table, rows, n) / np.maximum(n, 1)[:, None].astype(np.float32)


def _path_means(table: np.ndarray, x: Inputs) -> np.ndarray:
    """Mean vector of all entries around each block."""
    total = _sum(table, x.entry, x.entry_n)
    for a, b in zip(x.levels[1:], x.levels[2:]):
        total[a:b] += total[x.parent[a:b]]
    return total[x.place] / np.maximum(x.path_n, 1)[:, None].astype(np.float32)


def _path_gradient(d: np.ndarray, x: Inputs) -> np.ndarray:
    """Gradient of the path table, from that of the blocks' means."""
    total = sum_rows(x.place, d / np.maximum(x.path_n, 1)[:, None].astype(np.float32), len(x.parent))
    for a, b in reversed(list(zip(x.levels[1:], x.levels[2:]))):
        np.add.at(total, x.parent[a:b], total[a:b])
    return sum_rows(x.entry, np.repeat(total, x.entry_n, axis=0), PATH_ROWS)


class Network:
    def __init__(self, seed: int = 1):
        rnd, f32 = np.random.default_rng(seed), np.float32
        self.weights = {
            "path": rnd.normal(0, 0.3, (PATH_ROWS, VECTOR)).astype(f32), "leaf": rnd.normal(0, 0.3, (PATH_ROWS, VECTOR)).astype(f32),
            "word": rnd.normal(0, 0.1, (WORD_ROWS, VECTOR)).astype(f32), "x": rnd.normal(0, 0.2, (3 * VECTOR + NUMBERS, 8 * STATE)).astype(f32),
            "b": np.zeros((1, 8 * STATE), f32), "u1": rnd.normal(0, 0.2, (STATE, 4 * STATE)).astype(f32),
            "u2": rnd.normal(0, 0.2, (STATE, 4 * STATE)).astype(f32), "o": rnd.normal(0, 0.2, (2 * STATE, 1)).astype(f32), "c": np.zeros((1, 1), f32),
        }

    def forward(self, x: Inputs, keep: bool = False):
        """Logit of each block."""
        w = self.weights
        v = np.concatenate([_path_means(w["path"], x), w["leaf"][x.leaf], _mean(w["word"], x.word, x.word_n), x.numbers], axis=1)
        p = np.zeros((*x.shape, 8 * STATE), np.float32)
        p[x.step, x.page] = v @ w["x"] + w["b"]
        real = np.zeros(x.shape, np.float32)
        real[x.step, x.page] = 1
        f = lstm_forward(p[:, :, :4 * STATE], w["u1"], real, keep)
        g = lstm_forward(p[::-1, :, 4 * STATE:], w["u2"], real[::-1], keep)
        (f, kept1), (g, kept2) = (f, g) if keep else ((f, None), (g, None))
        h = np.concatenate([f, g[::-1]], axis=2)[x.step, x.page]
        logit = (h @ w["o"])[:, 0] + w["c"][0, 0]
        return (logit, (v, h, real, kept1, kept2)) if keep else logit

    def gradients(self, x: Inputs, kept: tuple, d: np.ndarray) -> dict:
        w = self.weights
        v, h, real, kept1, kept2 = kept
        g = {"o": h.T @ d[:, None], "c": d.sum().reshape(1, 1)}
        d_h = np.zeros((*x.shape, 2 * STATE), np.float32)
        d_h[x.step, x.page] = d[:, None] * w["o"][:, 0]
        d1, g["u1"] = lstm_backward(d_h[:, :, :STATE], w["u1"], kept1, real)
        d2, g["u2"] = lstm_backward(d_h[::-1, :, STATE:], w["u2"], kept2, real[::-1])
        d_p = np.concatenate([d1, d2[::-1]], axis=2)[x.step, x.page]
        g["x"], g["b"] = v.T @ d_p, d_p.sum(axis=0, keepdims=True)
        d_v = d_p @ w["x"].T
        spread = lambda part, n: np.repeat(part / np.maximum(n, 1)[:, None].astype(np.float32), n, axis=0)
        g["path"] = _path_gradient(d_v[:, :VECTOR], x)
        g["leaf"] = sum_rows(x.leaf, d_v[:, VECTOR:2 * VECTOR], PATH_ROWS)
        g["word"] = sum_rows(x.word, spread(d_v[:, 2 * VECTOR:3 * VECTOR], x.word_n), WORD_ROWS)
        return g

    def fit(self, taught: list[tuple[list[Block], np.ndarray]], epochs: int | None = None) -> None:
        optimizer, rnd = Adam(self.weights, RATE), np.random.default_rng(4)
        epochs = epochs or max(EPOCHS, LEAST_SEEN // max(1, len(taught)))
        for epoch in range(epochs):
            optimizer.rate = RATE * (1 - 0.9 * epoch / epochs)
            order = rnd.permutation(len(taught))
            for k in range(0, len(order), BATCH):
                mine = [taught[i] for i in order[k:k + BATCH]]
                x = Inputs([b for b, _ in mine])
                y = np.concatenate([p for _, p in mine])
                logit, kept = self.forward(x, keep=True)
                optimizer.step(self.gradients(x, kept, (sigmoid(logit) - y) / np.float32(len(y))))


def train(pages: DataFrame, html_col: str = "html", id_cols: list[str] | None = None) -> Network:
    """Fit on a bounded sample of pages, chosen by a hash of id and page, in one task."""
    full = pages.where(F.length(html_col) > 0)
    draw = F.xxhash64(*(id_cols or []), html_col)
    sample = hash_sample(full.select(draw.alias("draw"), utf8(html_col).alias("raw")), F.col("draw"), TRAIN_PAGES, full.count())

    def fit(batches):
        rows = sorted((x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("draw", "raw")))), key=lambda x: x[0])
        net = Network()
        net.fit(lessons([raw.decode("utf-8", "replace") for _, raw in rows]))
        yield pa.RecordBatch.from_pydict({"name": pa.array(list(net.weights)), "weights": pa.array([v.tobytes() for v in net.weights.values()], pa.binary())})

    net = Network()
    for row in map_arrow(sample.repartition(1), fit, "name string, weights binary").collect():
        net.weights[row["name"]] = np.frombuffer(row["weights"], np.float32).reshape(net.weights[row["name"]].shape).copy()
    return net


def main_texts(net: Network, pages: list[str]) -> list[str]:
    cut = [blocks(p) for p in pages]
    # pages of like length together, so that little of the grid is padding
    order = sorted(range(len(cut)), key=lambda i: len(cut[i]))
    out = [""] * len(cut)
    for k in range(0, len(order), 128):
        mine = order[k:k + 128]
        x = Inputs([cut[i] for i in mine])
        if not x.shape[0]:
            continue
        keep = net.forward(x) > 0
        for j, i in enumerate(mine):
            out[i] = "\n".join([b.text for b, ok in zip(cut[i], keep[x.page == j]) if ok])
    return out


def extract_text(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """One row per input row: ``keep`` columns, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(train(pages, html_col, keep))
    src = pages.select(*[F.col(c) for c in keep], utf8(html_col).alias("raw"))

    def step(part: pa.RecordBatch) -> dict:
        texts = main_texts(shared.value, [r.decode("utf-8", "replace") for r in part.column("raw").to_pylist()])
        return {c: part.column(c) for c in keep} | {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return map_texts(src, step, f"{schema}, text string, n_chars long")
