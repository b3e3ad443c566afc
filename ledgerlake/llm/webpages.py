"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks (text between block-level tags, script, style and comments left out). Each
block is a vector: hashed elements of its tag path (tags, classes, ids, neighbouring pairs), hashed words, and a few
numbers (length, share of linked text, place). A bidirectional LSTM in numpy reads the whole sequence and labels every
block, so a block is judged with all others of its page in view.

The network is trained here, on a bounded sample of pages: blocks inside ``article`` or ``main`` elements (not in
a nested menu, form, sidebar or the like, nor in a part whose class or id names an advert, comments, a notice) are text,
others are not. Pages carry few layouts, so each sampled page is also
laid out anew: its own text in other containers, with menus, headers, sidebars, notices, adverts, forms and comments of other
classes around it, labels known by construction.

Text: character references decoded, white space inside a block one blank, blocks joined by newlines; nothing is
cut. NULL and empty pages have no blocks and an empty text. Repeated rows are labelled one by one. Without any sampled
page that has an article, the rule itself gives the text.
"""

from __future__ import annotations

import html as _html
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import arrow_map, held, share, text_chunks

SAMPLE = 400
SAMPLE_BYTES = 200_000
HIDDEN = 16
PATH_DIM, WORD_DIM = 48, 16
#: Blocks of one slice that the network holds at a time.
CHUNK = 200_000

# Fixed values of the HTML standard.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is no markup and, without an end tag, runs to the end of the page.
RAW_TAGS = "script|style|textarea|title"
#: Elements whose blocks are left out. One without its own end tag ends with its parent, and its blocks stay.
OMITTED = frozenset("noscript template svg math select option button iframe object".split())
CLOSES_P = BLOCK_TAGS - OMITTED - {"body", "html", "head", "optgroup", "title"}
#: An opening tag of the key ends an open element of the same group in the nearest list or table.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol menu dl table tbody thead tfoot article section div main body nav aside".split())
#: Words of classes and ids of parts inside an article that are not its text.
NOT_TEXT_NAMES = frozenset(
    "ad ads adsbygoogle advert adverts advertisement banner breadcrumb breadcrumbs comment commentlist comments consent cookie disqus "
    "menu navbar newsletter notice pagination promo related share sharing sidebar social sponsored subscribe".split()
)
NOT_TEXT = frozenset("nav aside footer header form menu search dialog".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW_TAGS})(?:/>|(?=[\s/>])(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>)"
    r"(?:(?<=[\s\"']/>)|.*?(?:</\1(?=[\s/>])[^>]*+(?:>|\Z)|\Z)))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[\s_-]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, with their tag paths (``tag``, ``tag.class`` and ``tag#id`` parts)."""
    out: list[Block] = []
    names: list[str] = []
    marks: list[tuple[str, ...]] = []
    parts: list[str] = []
    linked = links = 0
    path: tuple[str, ...] = ()
    omitted: list[tuple[int, int, tuple[str, ...]]] = []  # open ones: place in names, blocks before, path before

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(_html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, path, linked))
            parts.clear()
        linked = 0

    def drop(to: int, own_end: bool = False) -> None:
        nonlocal links, path
        while omitted and omitted[-1][0] >= to:
            close()
            place, before, path = omitted.pop()
            if names[place] == "option" or own_end and place == to:  # the end tag of an option is optional
                del out[before:]
        links -= sum(1 for n in names[to:] if n == "a")
        del names[to:], marks[to:]

    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() > at:
            parts.append(page[at : found.start()])
            if links:
                linked += found.start() - at
        at = found.end()
        raw, end, name, attrs, end2, name2, attrs2 = found.groups()
        if raw is not None:
            close()
            continue
        name, end, attrs = (name, end, attrs) if name is not None else (name2, end2, attrs2)
        if name is None:
            continue
        name = name.lower()
        block = name in BLOCK_TAGS
        if block:
            close()
        elif name == "br" or name == "img":
            parts.append(" ")
        if name in OMITTED:
            close()
        if end:
            # a paragraph around an omitted element is not ended in it
            if name in names[omitted[-1][0] + 1 if omitted and name == "p" else 0 :]:
                drop(len(names) - 1 - names[::-1].index(name), True)
        elif name not in VOID_TAGS and not attrs.endswith("/"):
            if block and omitted and names[omitted[-1][0]] == "option":
                drop(omitted[-1][0])
            if name == "button" and name in names:  # the open one has no end tag; what it holds goes on
                i = len(names) - 1 - names[::-1].index(name)
                del names[i], marks[i]
                omitted = [(o[0] - (o[0] > i), *o[1:]) for o in omitted if o[0] != i]
            inner = omitted[-1][0] + 1 if omitted else 0
            if name in CLOSES_P and "p" in names[inner:]:
                drop(len(names) - 1 - names[::-1].index("p"))
            for i in range(len(names) - 1, inner - 1, -1) if name in SIBLINGS else ():
                if names[i] in SIBLINGS[name]:
                    drop(i)
                    break
                if names[i] in SCOPES:
                    break
            own = [name]
            if attrs:
                for kind, *values in _NAMES.findall(attrs):
                    sign = "#" if kind.lower() == "id" else "."
                    own += [f"{sign}{w}" for w in _SPLIT.split("".join(values).lower()) if w]
            if name in OMITTED:
                omitted.append((len(names), len(out), path))
            names.append(name)
            marks.append(tuple(own))
            links += name == "a"
        if block and name not in OMITTED or not end and omitted and omitted[-1][0] == len(names) - 1:
            path = tuple(m for own in marks for m in (*own, "/"))
    if at < len(page):
        parts.append(page[at:])
    close()
    if omitted and names[omitted[-1][0]] == "option":
        drop(omitted[-1][0])
    return out


def is_text(path: tuple[str, ...]) -> bool:
    """The rule behind the training labels: inside article or main, and in no part that is never text by tag or by name."""
    inside = max((i for i, m in enumerate(path) if m in ("article", "main")), default=-1)
    return inside >= 0 and not any(m in NOT_TEXT or m[0] in ".#" and m[1:] in NOT_TEXT_NAMES for m in path[inside:])


def _vector(key: str, size: int) -> np.ndarray:
    """A fixed random sign vector of a string."""
    bits = xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))
    return np.unpackbits(np.frombuffer(bits, dtype=np.uint8))[:size].astype(np.float32) * 2 - 1


def path_vector(path: tuple[str, ...], known: dict) -> np.ndarray:
    """Classes and ids, tags, and pairs of nested tags, the innermost with more weight."""
    got = known.get(path)
    if got is None:
        got = np.zeros(PATH_DIM, dtype=np.float32)
        tags = [m for i, m in enumerate(path) if i == 0 or path[i - 1] == "/"]
        for m in path:
            if m != "/" and m not in ("html", "body"):
                got += _vector(m, PATH_DIM)
        for a, b in zip(tags, tags[1:]):
            got += 0.5 * _vector(f"{a}>{b}", PATH_DIM)
        got /= math.sqrt(1 + len(path) / 2)
        if len(known) < 50_000:
            known[path] = got
    return got


class Words(dict):
    """First letters of a word -> row of a growing table of fixed random vectors."""

    def __init__(self):
        super().__init__()
        self.rows: list[np.ndarray] = []

    def __missing__(self, start: str) -> int:
        self[start] = at = len(self.rows)
        self.rows.append(_vector(start, WORD_DIM))
        return at


def features(pages: list[list[Block]], known: dict) -> list[np.ndarray]:
    """One row for each block of each page."""
    words = Words()
    get = words.__getitem__
    flat = [b for page in pages for b in page]
    if not flat:
        return [np.zeros((0, PATH_DIM + WORD_DIM + 7), dtype=np.float32) for _ in pages]
    ids: list[int] = []
    ends = []
    for b in flat:
        ids.extend([get(w[:6]) for w in b.text.lower().split()])
        ends.append(len(ids))
    stop = np.array(ends)
    counts = np.diff(stop, prepend=0)  # at least one: a block has a word
    out = np.empty((len(flat), PATH_DIM + WORD_DIM + 7), dtype=np.float32)
    for i, b in enumerate(flat):
        out[i, :PATH_DIM] = path_vector(b.path, known)
    table, at = np.array(words.rows, dtype=np.float32), np.array(ids)
    first = 0
    while first < len(flat):  # vectors of about a million words at a time
        last = max(first + 1, int(np.searchsorted(stop, (stop[first - 1] if first else 0) + 1_000_000)))
        low = stop[first] - counts[first]
        sums = np.add.reduceat(table[at[low : stop[last - 1]]], (stop - counts)[first:last] - low, axis=0)
        out[first:last, PATH_DIM:-7] = sums / (counts[first:last, None] + 4)
        first = last
    size = np.array([len(b.text) for b in flat], dtype=np.float64)
    per_page = np.array([len(p) for p in pages])
    page = np.repeat(np.arange(len(pages)), per_page)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(per_page) - per_page, per_page)
    out[:, -7] = np.log1p(size) / 5
    out[:, -6] = np.minimum(1.0, np.array([b.linked for b in flat]) / size)
    out[:, -5] = size / np.bincount(page, weights=size, minlength=len(pages))[page]
    out[:, -4] = place / per_page[page]
    out[:, -3] = np.log1p(per_page[page]) / 5
    out[:, -2] = np.array([b.text.count(".") + b.text.count(",") + b.text.count(";") for b in flat]) / (counts + 1)
    out[:, -1] = 1.0
    return np.split(out, np.cumsum(per_page)[:-1])


@dataclass
class Net:
    """Two LSTM directions and a logistic output. Gates in order: input, forget, output, candidate."""

    wx: list[np.ndarray]
    wh: list[np.ndarray]
    out: np.ndarray


def new_net(size: int, hidden: int, seed: int) -> Net:
    rng = np.random.default_rng(seed)
    wx = [rng.normal(0, 1 / math.sqrt(size), (size, 4 * hidden)).astype(np.float32) for _ in range(2)]
    for w in wx:
        w[-1, hidden : 2 * hidden] += 1.0  # the last input is constant: the forget gate starts open
    wh = [rng.normal(0, 1 / math.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32) for _ in range(2)]
    return Net(wx, wh, rng.normal(0, 0.1, (2 * hidden + 1,)).astype(np.float32))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def run_direction(wx, wh, x, active, keep: bool):
    """x: time-major inputs (steps x pages x size) padded, pages longest first; ``active``: pages at each step."""
    steps, pages, _ = x.shape
    size = wh.shape[0]
    gates_in = x @ wx
    h, c = np.zeros((pages, size), np.float32), np.zeros((pages, size), np.float32)
    hs = np.zeros((steps, pages, size), np.float32)
    kept = []
    for t in range(steps):
        n = active[t]
        z = gates_in[t, :n] + h[:n] @ wh
        g = _sigmoid(z[:, : 3 * size])
        i, f, o = g[:, :size], g[:, size : 2 * size], g[:, 2 * size :]
        u = np.tanh(z[:, 3 * size :])
        before = c[:n].copy()
        c[:n] = f * before + i * u
        tc = np.tanh(c[:n])
        last = h[:n].copy()
        h[:n] = o * tc
        hs[t, :n] = h[:n]
        if keep:
            kept.append((i, f, o, u, before, tc, last))
    return hs, kept


def padded(vectors: list[np.ndarray]):
    """Time-major inputs in both directions; pages must come longest first."""
    lengths = np.array([len(v) for v in vectors])
    steps = int(lengths[0])
    x = np.zeros((steps, len(vectors), vectors[0].shape[1]), np.float32)
    back = np.zeros_like(x)
    for j, v in enumerate(vectors):
        x[: len(v), j] = v
        back[: len(v), j] = v[::-1]
    return x, back, lengths, [int((lengths > t).sum()) for t in range(steps)]


def unreversed(hs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    out = np.zeros_like(hs)
    for j, n in enumerate(lengths):
        out[:n, j] = hs[:n, j][::-1]
    return out


def read_rows(wx, wh, rows, active, first):
    """Hidden states for time-major rows without padding (``first``: where each step begins)."""
    size = wh.shape[0]
    gates_in = rows @ wx
    h, c = np.zeros((active[0], size), np.float32), np.zeros((active[0], size), np.float32)
    hs = np.empty((len(rows), size), np.float32)
    for t, n in enumerate(active):
        z = gates_in[first[t] : first[t] + n] + h[:n] @ wh
        g = _sigmoid(z[:, : 3 * size])
        c = g[:, size : 2 * size] * c[:n] + g[:, :size] * np.tanh(z[:, 3 * size :])
        h = g[:, 2 * size :] * np.tanh(c)
        hs[first[t] : first[t] + n] = h
    return hs


def probabilities(net: Net, vectors: list[np.ndarray]) -> list[np.ndarray]:
    """Per page the probability of each block to be text, in the given order."""
    result: list[np.ndarray] = [np.zeros(0)] * len(vectors)
    order = sorted((i for i in range(len(vectors)) if len(vectors[i])), key=lambda i: -len(vectors[i]))
    start = 0
    while start < len(order):
        stop, total = start, 0
        while stop < len(order) and (total == 0 or total + len(vectors[order[stop]]) <= CHUNK):
            total += len(vectors[order[stop]])
            stop += 1
        chosen = order[start:stop]
        flat = np.concatenate([vectors[i] for i in chosen])
        lengths = np.array([len(vectors[i]) for i in chosen])
        active = len(chosen) - np.cumsum(np.bincount(lengths, minlength=int(lengths[0]) + 1))[:-1]
        first = np.cumsum(active) - active
        rank = np.repeat(np.arange(len(chosen)), lengths)
        place = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ahead = first[place] + rank  # where a block stands in each direction's order
        behind = first[np.repeat(lengths, lengths) - 1 - place] + rank
        z = np.full(total, net.out[-1])
        half = len(net.wh[0])
        for k, at in enumerate((ahead, behind)):
            rows = np.empty_like(flat)
            rows[at] = flat
            z += (read_rows(net.wx[k], net.wh[k], rows, active.tolist(), first.tolist()) @ net.out[k * half : (k + 1) * half])[at]
        p = _sigmoid(z)
        for i, own in zip(chosen, np.split(p, np.cumsum(lengths)[:-1])):
            result[i] = own
        start = stop
    return result


def gradient(wh, x, active, kept, dhs):
    """Back-propagation through time of one direction: gradients of wx and wh."""
    size = wh.shape[0]
    dwx, dwh = np.zeros((x.shape[2], 4 * size), np.float32), np.zeros_like(wh)
    dh, dc = np.zeros((x.shape[1], size), np.float32), np.zeros((x.shape[1], size), np.float32)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        i, f, o, u, before, tc, last = kept[t]
        d = dh[:n] + dhs[t, :n]
        cell = dc[:n] + d * o * (1 - tc * tc)
        dz = np.concatenate(
            [cell * u * i * (1 - i), cell * before * f * (1 - f), d * tc * o * (1 - o), cell * i * (1 - u * u)], axis=1
        )
        dwx += x[t, :n].T @ dz
        dwh += last.T @ dz
        dh[:n], dc[:n] = dz @ wh.T, cell * f
    return dwx, dwh


def fit(pages: list[tuple[np.ndarray, np.ndarray]], hidden: int = HIDDEN, epochs: int = 12, rate: float = 0.01, seed: int = 5) -> Net:
    """Train on (features, labels) of whole pages by mini-batches with Adam."""
    net = new_net(pages[0][0].shape[1], hidden, seed)
    params = [*net.wx, *net.wh, net.out]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rng = np.random.default_rng(seed)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(pages))
        for start in range(0, len(order), 32):
            chosen = sorted(order[start : start + 32], key=lambda k: -len(pages[k][0]))
            x, back, lengths, active = padded([pages[k][0] for k in chosen])
            ahead, kept0 = run_direction(net.wx[0], net.wh[0], x, active, True)
            behind, kept1 = run_direction(net.wx[1], net.wh[1], back, active, True)
            both = np.concatenate([ahead, unreversed(behind, lengths)], axis=2)
            p = _sigmoid(both @ net.out[:-1] + net.out[-1])
            err = np.zeros_like(p)
            for j, k in enumerate(chosen):
                err[: lengths[j], j] = p[: lengths[j], j] - pages[k][1]
            err /= lengths.sum()
            d_both = err[:, :, None] * net.out[:-1]
            d_out = np.append(np.einsum("tp,tph->h", err, both), err.sum()).astype(np.float32)
            g0 = gradient(net.wh[0], x, active, kept0, d_both[:, :, :hidden])
            g1 = gradient(net.wh[1], back, active, kept1, unreversed(d_both[:, :, hidden:], lengths))
            step += 1
            for k, g in enumerate([g0[0], g1[0], g0[1], g1[1], d_out]):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                params[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)
    return net


# Containers for pages laid out anew: text, and parts that are not text.
TEXT_BOXES = (
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="content">', "</div>"),
    ('<div class="post">', "</div>"), ('<div class="entry article-body">', "</div>"), ('<main><article class="story">', "</article></main>"),
    ('<section class="main text">', "</section>"), ("", ""), ('<div id="main"><div class="post-content">', "</div></div>"),
)
OTHER_BOXES = (
    '<nav><ul>{links}</ul></nav>', '<ul class="menu">{links}</ul>', '<div id="nav">{links}</div>', '<div class="navbar">{links}</div>',
    '<header><p>{text}</p></header>', '<header class="site-header">{links}</header>', '<div class="header">{text}</div>',
    '<div class="masthead"><p>{text}</p></div>', '<aside><p>{text}</p></aside>', '<div class="sidebar"><ul>{links}</ul></div>',
    '<div id="sidebar"><p>{text}</p></div>', '<aside class="related">{links}</aside>', '<div class="notice">{text}</div>',
    '<div class="cookie-notice"><p>{text}</p></div>', '<div class="cookie banner">{text}</div>', '<div class="alert">{text}</div>',
    '<div class="ad">{text}</div>', '<div class="ads">{text}</div>', '<div class="advert"><p>{text}</p></div>',
    '<div class="sponsored promo">{text}</div>', '<ins class="adsbygoogle">{text}</ins>', '<form><label>{text}</label></form>',
    '<form class="search"><p>{text}</p></form>', '<div class="newsletter subscribe"><p>{text}</p></div>',
    '<section class="comments"><p>{text}</p><p>{more}</p></section>', '<div id="comments"><div class="comment">{text}</div></div>',
    '<ol class="commentlist"><li class="comment">{text}</li><li>{more}</li></ol>', '<div class="comment">{text}</div>',
    '<footer>{text}</footer>', '<footer><p>{text}</p></footer>', '<div class="footer">{text}</div>', '<div id="footer"><p>{text}</p></div>',
    '<div class="share social">{links}</div>', '<div class="breadcrumb">{links}</div>', '<div class="pagination">{links}</div>',
    '<div class="author-bio"><p>{text}</p></div>',
)


def laid_out_anew(text: list[str], other: list[str], rng) -> tuple[str, list[int]]:
    """A page of the given text blocks in a container with parts around it; and the label of each block."""
    escape = _html.escape

    def part() -> tuple[str, int]:
        pick = lambda: other[rng.integers(len(other))] if rng.random() < 0.5 or not text else text[rng.integers(len(text))]
        n = int(rng.integers(2, 7))
        links = "".join(f'<li><a href="#">{escape(w)}</a></li>' for w in [pick().split()[0] for _ in range(n)])
        made = OTHER_BOXES[rng.integers(len(OTHER_BOXES))].format(links=links, text=escape(pick()), more=escape(pick()))
        return made, len(blocks(made))

    if text and rng.random() < 0.03:  # no markup at all
        return escape(" ".join(text[:3])), [1]
    page, labels = [], []
    for _ in range(rng.integers(0, 5)):
        made, n = part()
        page.append(made)
        labels += [0] * n
    opening, closing = TEXT_BOXES[rng.integers(len(TEXT_BOXES))]
    page.append(opening)
    inner = rng.random() < 0.5
    for k, block in enumerate(text):
        tag = ("h1" if rng.random() < 0.7 else "h2") if k == 0 else ("p", "p", "p", "p", "blockquote", "li", "h2", "pre", "div")[rng.integers(9)]
        page.append(f"<{tag}>{escape(block)}</{tag}>")
        labels.append(1)
        if inner and rng.random() < 0.3:
            made, n = part()
            page.append(made)
            labels += [0] * n
    page.append(closing)
    for _ in range(rng.integers(0, 5)):
        made, n = part()
        page.append(made)
        labels += [0] * n
    return "".join(["<html><body>", *page, "</body></html>"] if rng.random() < 0.9 else page), labels


def train(pages: DataFrame, html: str = "html", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, seed: int = 9) -> Net | None:
    """Fit on ``sample`` different pages of at most ``sample_bytes``, those with the smallest hash; None if none has an article."""
    column = F.col(f"`{html}`")
    order = F.xxhash64(column, F.lit(9))
    keys = pages.where(column.isNotNull() & (F.octet_length(column) <= sample_bytes)).select(order.alias("h")).distinct().orderBy("h").limit(sample)
    chosen = pages.select(order.alias("h"), column.alias("page")).join(F.broadcast(keys), "h").where(
        F.octet_length("page") <= sample_bytes
    ).groupBy("h").agg(F.min("page").alias("page")).orderBy("h")
    return fit_pages([r["page"] for r in chosen.select("page").collect()], seed)


def fit_pages(sampled: list[str], seed: int = 9) -> Net | None:
    rng = np.random.default_rng(seed)
    known: dict = {}
    found_pages, labelled = [], []
    for page in sampled:
        found = blocks(page)
        labels = [int(is_text(b.path)) for b in found]
        text = [b.text for b, y in zip(found, labels) if y]
        other = [b.text for b, y in zip(found, labels) if not y] or text
        if not text:
            continue
        found_pages.append(found)
        labelled.append(np.array(labels, dtype=np.float32))
        for _ in range(4):
            made, marks = laid_out_anew(text[: int(rng.integers(1, 30))], other, rng)
            again = blocks(made)
            if len(again) == len(marks):
                found_pages.append(again)
                labelled.append(np.array(marks, dtype=np.float32))
    return fit(list(zip(features(found_pages, known), labelled)), seed=seed) if labelled else None


def extract(net: Net | None, pages: list[str], known: dict) -> list[str]:
    found = [blocks(p) for p in pages]
    if net is None:
        return ["\n".join(b.text for b in page if is_text(b.path)) for page in found]
    marks = probabilities(net, features(found, known))
    return ["\n".join(b.text for b, p in zip(page, ps) if p >= 0.5) for page, ps in zip(found, marks)]


def main_text(pages: DataFrame, net: Net | None, html: str = "html", out: str = "text") -> DataFrame:
    """All columns of ``pages`` but the html, and the main text."""
    shared = share(pages, net)
    rest = [c for c in pages.columns if c not in (html, out)]
    base = pages.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{html}`").alias("_html"))

    def run(batches):
        model = held(shared)
        known: dict = {}
        for batch in batches:
            for part, raw in text_chunks(batch, "_html"):
                texts = extract(model, [r.decode() for r in raw], known)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*rest, out])

    return arrow_map(base, run, T.StructType([*[base.schema[c] for c in rest], T.StructField(out, T.StringType())]))
