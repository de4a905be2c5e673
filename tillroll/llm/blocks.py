"""Main text of HTML pages by a recurrent block labeller.

1. *Leaves.* A page is read tag by tag into text blocks in page order, each with
   the path of elements around it. Scripts, styles, svg graphics and other raw
   elements have no leaves; inline markup, formulas among it, doesn't end a
   block; unclosed and stray tags are taken as browsers do for paragraphs, list
   items and svg. A script or style without an end tag goes to the page's end, as
   in browsers; other raw elements without one are read on as text. Character
   references are decoded, white space becomes one blank.
2. *Vectors.* A leaf's vector is the mean of learnt rows for its hashed path
   parts (tag, class, id and role of each ancestor), the mean of learnt rows for
   its hashed words, and five numbers (length, link share, place, ...).
3. *Labels.* A bidirectional LSTM (numpy) reads the vectors of a whole page in
   both directions, so each block is classified with the document's context.
   Blocks labelled as main text are joined by line feeds.

The network is trained here, on a bounded sample: the ``MAX_TRAIN`` pages with
the smallest hash of their id, of those that have an article or main element.
Their labels come from page structure alone (inside such an element, and in no
navigation, notice, form, advert, comment ... element). Each page is read a
second time with plain div elements in place of its main ones and the same
labels, so the network carries them over to pages without such elements by
their words, paths and neighbours. If no page has one, all blocks outside
navigation, notices ... are taken for main text. One task trains the network;
its weights have a fixed size.

Defined results: a null or empty page, or one without a main block, has the
empty text; repeated rows are read each on their own; an empty table gives an
empty result. Only page_id, url and html are read. Pages of any length are read
whole, one list of pages of about ``BATCH_CHARS`` at a time.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.hashing import Rolling, batches

MAX_TRAIN = 384
EPOCHS = 12
PATH_SLOTS, WORD_SLOTS, WIDTH, NUMBERS, HIDDEN = 1024, 4096, 12, 5, 12
RATE = 0.02
#: Leaves of a training page that are read at a time.
TRAIN_STEPS = 96
BATCH_CHARS = 1 << 19
#: Pages that the network reads in step.
LANES = 64
#: Steps of all lanes together; a page of more has a lane alone.
CELLS = 1 << 14

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<([!?])[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = frozenset("script style noscript template textarea title iframe".split())
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
#: The source of a formula, which browsers don't show; it ends with the formula.
UNSHOWN = frozenset({"annotation", "annotation-xml"})
_UNSHOWN_END = re.compile(r"</annotation(?:-xml)?\s*>|(?=</(?:semantics|math)\b|<annotation\b|</?(?:article|div|h[1-6]|li|main|ol|p|section|table|ul)\b)", re.I)
#: Start tags that end an svg without its end tag.
SVG_ENDS = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr "
    "math maction maligngroup malignmark menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded "
    "mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none "
    "semantics".split()
)
#: An element that begins ends these, if they are open directly around it.
CLOSES = {"li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
MAIN_PARTS = frozenset({"article", "main", "role.main", "role.article"})
OTHER_PARTS = frozenset("nav aside header footer form button option menu dialog head".split())
#: Whole class names, ids and roles.
_OTHER_NAME = re.compile(
    r"(?:class|id|role)\.(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|footer|header|menu|nav\w*|newsletter|"
    r"notice|promo\w*|related|share|sidebar|social|sponsor\w*|subscribe|widget)"
)
_HAS_MAIN = r"(?i)<(article|main)\b|\brole\s*=\s*[\x22']?\s*(article|main)\b"

Leaf = tuple[str, tuple[str, ...], float]


def _svg_end(page: str, at: int, around: set[str]) -> int:
    """Where an svg that began before ``at`` ends: after its end tag or, without
    one, before the first tag that cannot be in it; ``around`` are the elements
    open around it."""
    depth, held = 1, 0  # open svgs; open foreign objects, which may hold any tag
    for tag in _TAG.finditer(page, at):
        name = (tag[3] or "").lower()
        if tag[2]:
            if name == "svg":
                depth, held = depth - 1, 0
                if not depth:
                    return tag.end()
            elif name == "foreignobject":
                held = max(0, held - 1)
            elif not held and (name in ("p", "br") or name in around):
                return tag.start()
        elif (tag[4] or "").endswith("/"):
            continue
        elif name == "svg":
            depth += 1
        elif name == "foreignobject":
            held += 1
        elif name in SVG_ENDS and not held:
            return tag.start()
    return len(page)


def leaves(page: str) -> list[Leaf]:
    """(text, path parts, share of its characters in links) of each block."""
    out: list[Leaf] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    path: tuple[str, ...] = ()
    words: list[str] = []
    linked = in_link = 0
    unclosed: set[str] = set()

    def flush() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(words)).split())
        if text:
            out.append((text, path, min(1.0, linked / len(text))))
        words.clear()
        linked = 0

    def pop(to: int) -> None:
        nonlocal path
        del stack[to:]
        path = stack[-1][1] if stack else ()

    at, size = 0, len(page)
    while at < size:
        tag = _TAG.search(page, at)
        stop = tag.start() if tag else size
        if stop > at:
            words.append(page[at:stop])
            linked += (stop - at) if in_link else 0
        if not tag:
            break
        at = tag.end()
        name = (tag[3] or "").lower()
        if not name:
            continue
        if tag[2]:  # an end tag
            if name in INLINE:
                in_link = 0 if name == "a" else in_link
                continue
            flush()
            open_at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if open_at is not None:
                pop(open_at)
            continue
        if name in RAW:
            end = None if name in unclosed else _RAW_END[name].search(page, at)
            if end:
                at = end.end()
            elif name in ("script", "style"):
                at = size
            else:
                unclosed.add(name)
            continue
        if name == "svg" or name in UNSHOWN:
            if not (tag[4] or "").endswith("/"):
                end = _UNSHOWN_END.search(page, at) if name in UNSHOWN else None
                at = _svg_end(page, at, {x[0] for x in stack}) if name == "svg" else end.end() if end else at
            continue
        if name in INLINE:
            in_link = 1 if name == "a" else in_link
            if name in ("br", "mtr", "mtd"):
                words.append(" ")
            continue
        flush()
        if name in VOID:
            continue
        for closed in CLOSES.get(name, "").split():
            if stack and stack[-1][0] == closed:
                pop(len(stack) - 1)
        # A block ends an open paragraph or choice; these two may be in a paragraph.
        if stack and stack[-1][0] in ("p", "option") and name not in ("object", "select"):
            pop(len(stack) - 1)
        parts = [name]
        for kind, *values in _NAMES.findall(tag[4] or ""):
            parts += [f"{kind.lower()}.{v}" for v in " ".join(values).lower().split()]
        path = (*path, *parts)
        stack.append((name, path))
    flush()
    return out


def is_other(path: tuple[str, ...]) -> bool:
    """Whether a block is in a navigation, notice, form ... element. The names
    of the html and body elements speak of the page, not of its blocks."""
    below = 0
    while below < len(path) and (path[below] in ("html", "body") or (below and "." in path[below])):
        below += 1
    return any(p in OTHER_PARTS or _OTHER_NAME.fullmatch(p) for p in path[below:])


def has_main(page: list[Leaf]) -> bool:
    return any(p in MAIN_PARTS for leaf in page for p in leaf[1])


def weak_label(path: tuple[str, ...]) -> int:
    """What page structure says about a block."""
    return int(not is_other(path) and any(p in MAIN_PARTS for p in path))


def without_main(page: list[Leaf]) -> list[Leaf]:
    """A page with plain elements in place of its main ones."""
    return [(text, tuple("div" if p in ("article", "main") else p for p in path if p not in ("role.main", "role.article")), share) for text, path, share in page]


class Vectors:
    """Sparse inputs of some pages' leaves, page after page."""

    def __init__(self, pages: list[list[Leaf]], path_slots: dict[str, int]):
        flat = [leaf for page in pages for leaf in page]
        self.lengths = np.array([len(p) for p in pages])
        raw = np.frombuffer("\n".join(x[0] for x in flat).lower().encode() + b"\n", np.uint8)
        space = (raw == 32) | (raw == 10)
        start = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        end = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
        self.word = (Rolling(raw).names(start, end) % np.uint64(WORD_SLOTS)).astype(np.int64) if flat else np.empty(0, np.int64)
        breaks = np.flatnonzero(raw == 10)
        self.word_leaf = np.searchsorted(breaks, start)
        slots, owner = [], []
        for i, (_, path, _) in enumerate(flat):
            for p in path or ("",):
                if p not in path_slots:
                    name = np.frombuffer(p.encode() + b"\0", np.uint8)
                    path_slots[p] = int(Rolling(name, 3).names(np.array([0]), np.array([len(name)]))[0] % np.uint64(PATH_SLOTS))
                slots.append(path_slots[p])
                owner.append(i)
        self.path, self.path_leaf = np.array(slots, np.int64), np.array(owner, np.int64)
        chars = np.array([len(x[0]) for x in flat], np.float64)
        place = np.concatenate([np.arange(n) / max(1, n) for n in self.lengths]) if flat else np.empty(0)
        marks = np.array([x[0].count(".") + x[0].count(",") for x in flat], np.float64)
        self.numbers = np.stack(
            [np.log1p(chars) / 6, np.array([x[2] for x in flat], np.float64), place, np.minimum(1, 10 * marks / np.maximum(1, chars)), np.ones(len(flat))], 1
        ).reshape(-1, NUMBERS)

    def means(self, net: dict) -> np.ndarray:
        n = len(self.numbers)
        out = []
        for table, slot, leaf in ((net["path"], self.path, self.path_leaf), (net["words"], self.word, self.word_leaf)):
            total = np.zeros((n, WIDTH))
            if len(leaf):
                first = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
                total[leaf[first]] = np.add.reduceat(table[slot], first, axis=0)
            out.append(total / np.maximum(1, np.bincount(leaf, minlength=n))[:, None])
        return np.concatenate([*out, self.numbers], axis=1)


def new_net(seed: int = 7) -> dict:
    rng, inputs = np.random.default_rng(seed), 2 * WIDTH + NUMBERS
    net = {"path": rng.normal(0, 0.3, (PATH_SLOTS, WIDTH)), "words": rng.normal(0, 0.1, (WORD_SLOTS, WIDTH))}
    for side in "fb":
        net[f"x{side}"] = rng.normal(0, 0.2, (inputs, 4 * HIDDEN))
        net[f"h{side}"] = rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN))
        net[f"b{side}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        net[f"o{side}"] = rng.normal(0, 0.2, HIDDEN)
    net["o"] = np.zeros(1)
    return net


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(net: dict, side: str, x: np.ndarray, keep: bool = False):
    """Hidden states of one direction over x (steps, lanes, inputs)."""
    steps, lanes, _ = x.shape
    pre = x @ net[f"x{side}"] + net[f"b{side}"]
    h, c = np.zeros((lanes, HIDDEN)), np.zeros((lanes, HIDDEN))
    hidden, saved = np.zeros((steps, lanes, HIDDEN)), []
    for t in range(steps):
        gates = pre[t] + h @ net[f"h{side}"]
        ifo = _sigmoid(gates[:, : 3 * HIDDEN])
        g = np.tanh(gates[:, 3 * HIDDEN :])
        i, f, o = ifo[:, :HIDDEN], ifo[:, HIDDEN : 2 * HIDDEN], ifo[:, 2 * HIDDEN :]
        before, h_before = c, h
        c = f * c + i * g
        bent = np.tanh(c)
        h = o * bent
        hidden[t] = h
        if keep:
            saved.append((i, f, o, g, before, bent, h_before))
    return hidden, saved


def _lstm_back(net: dict, grad: dict, side: str, x: np.ndarray, saved: list, d_hidden: np.ndarray) -> np.ndarray:
    dx = np.zeros_like(x)
    dh = np.zeros(d_hidden.shape[1:])
    dc = np.zeros_like(dh)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before, bent, h_before = saved[t]
        dh = dh + d_hidden[t]
        dc = dc + dh * o * (1 - bent**2)
        gates = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * bent * o * (1 - o), dc * i * (1 - g**2)], 1)
        grad[f"x{side}"] += x[t].T @ gates
        grad[f"h{side}"] += h_before.T @ gates
        grad[f"b{side}"] += gates.sum(axis=0)
        dx[t] = gates @ net[f"x{side}"].T
        dh = gates @ net[f"h{side}"].T
        dc = dc * f
    return dx


def _lanes(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Step and lane of each leaf, forwards, and backwards."""
    lane = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.repeat(np.cumsum(lengths) - lengths, lengths)
    step = np.arange(int(lengths.sum())) - begin
    return step, lane, np.repeat(lengths, lengths) - 1 - step, lane


def _run(net: dict, vectors: Vectors, keep: bool = False):
    flat, n = vectors.means(net), vectors.lengths
    step, lane, back, _ = _lanes(n)
    shape = (int(n.max(initial=0)), len(n))
    score = np.full(len(flat), net["o"][0])
    state = {}
    for side, at in (("f", step), ("b", back)):
        x = np.zeros((*shape, flat.shape[1]))
        x[at, lane] = flat
        hidden, saved = _lstm(net, side, x, keep)
        score += hidden[at, lane] @ net[f"o{side}"]
        state[side] = (at, x, hidden, saved)
    return score, lane, state


def scores(net: dict, vectors: Vectors) -> np.ndarray:
    """The probability of main text of each leaf."""
    return _sigmoid(_run(net, vectors)[0])


def train(pages: list[list[Leaf]]) -> dict:
    net, slots = new_net(), {}
    labelled = [(p, [weak_label(x[1]) for x in p]) for p in pages if has_main(p)]
    if labelled:
        labelled += [(without_main(p), label) for p, label in labelled]
    else:
        labelled = [(p, [int(not is_other(x[1])) for x in p]) for p in pages]
    pieces = [(p[a : a + TRAIN_STEPS], label[a : a + TRAIN_STEPS]) for p, label in labelled for a in range(0, len(p), TRAIN_STEPS)]
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    rng, step = np.random.default_rng(11), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(pieces))
        for lo in range(0, len(order), 32):
            part = [pieces[i] for i in order[lo : lo + 32]]
            vectors = Vectors([page for page, _ in part], slots)
            want = np.array([x for _, label in part for x in label], np.float64)
            score, lane, state = _run(net, vectors, keep=True)
            d_score = (_sigmoid(score) - want) / len(want)
            grad = {k: np.zeros_like(v) for k, v in net.items()}
            grad["o"][0] = d_score.sum()
            d_flat = np.zeros((len(want), 2 * WIDTH + NUMBERS))
            for side, (at, x, hidden, saved) in state.items():
                grad[f"o{side}"] = d_score @ hidden[at, lane]
                d_hidden = np.zeros_like(hidden)
                d_hidden[at, lane] = d_score[:, None] * net[f"o{side}"]
                d_flat += _lstm_back(net, grad, side, x, saved, d_hidden)[at, lane]
            for k, name, slot, leaf in ((0, "path", vectors.path, vectors.path_leaf), (1, "words", vectors.word, vectors.word_leaf)):
                share = d_flat[:, k * WIDTH : (k + 1) * WIDTH] / np.maximum(1, np.bincount(leaf, minlength=len(want)))[:, None]
                np.add.at(grad[name], slot, share[leaf])
            step += 1
            for k, g in grad.items():  # Adam
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net[k] = net[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def fit(pages: DataFrame) -> dict:
    """Train on the bounded sample, in one task; fixed-size weights return."""
    plain = F.min(~F.coalesce(F.col("html").rlike(_HAS_MAIN), F.lit(False))).alias("plain")
    found = pages.where("page_id is not null").groupBy(F.col("page_id").alias("_id")).agg(plain)
    chosen = found.select(F.xxhash64("_id").alias("place"), "_id", "plain").orderBy("plain", "place", "_id").limit(MAX_TRAIN)
    sample = pages.join(chosen, pages["page_id"] == chosen["_id"]).groupBy("place").agg(F.min("html").alias("html"))
    shapes = {k: v.shape for k, v in new_net().items()}

    def learn(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted({(p, h) for part in parts for p, h in zip(part.column(0).to_pylist(), part.column(1).to_pylist()) if h})
        found = [x for x in (leaves(h) for _, h in rows) if x]
        net = train(found) if found else new_net()
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([net[k].ravel() for k in shapes]).astype("<f8").tobytes()])], ["net"])

    learnt = sample.repartition(1).mapInArrow(learn, "net binary").collect()
    if not learnt:  # no rows, no task
        return new_net()
    flat = np.frombuffer(learnt[0]["net"], "<f8")
    net, at = {}, 0
    for k, shape in shapes.items():
        size = int(np.prod(shape))
        net[k], at = flat[at : at + size].reshape(shape), at + size
    return net


def extract(pages: list[str], net: dict) -> list[str]:
    """The main text of each page."""
    found = [leaves(p) for p in pages]
    texts, slots = [""] * len(pages), {}
    order = sorted((i for i, x in enumerate(found) if x), key=lambda i: len(found[i]))
    while order:
        # The longest page sets the steps of all lanes beside it.
        n = 1
        while n < min(LANES, len(order)) and (n + 1) * len(found[order[n]]) <= CELLS:
            n += 1
        part, order = order[:n], order[n:]
        main = scores(net, Vectors([found[i] for i in part], slots)) >= 0.5
        at = 0
        for i in part:
            page = found[i]
            texts[i] = "\n".join(leaf[0] for leaf, keep in zip(page, main[at : at + len(page)]) if keep)
            at += len(page)
    return texts


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    net_of = pages.sparkSession.sparkContext.broadcast(fit(pages))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            source = [h or "" for h in part.column(2).to_pylist()]
            texts = [t for a, b in batches([len(h) for h in source], BATCH_CHARS) for t in extract(source[a:b], net_of.value)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
