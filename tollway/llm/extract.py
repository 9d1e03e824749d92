"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks (text between block-level tags); each has features of its ancestors' tags and names,
of its text and its neighbours', and of its container: the text that is not in links is summed up the tree, and tells
the part of the page with most of it from what stands beside it. So pages whose names say nothing are read by place
and text. The field has two labels, article and other, is trained by gradient ascent on labelled pages (made from
layouts, PAGES of them, at the driver), and is decoded by Viterbi. Article blocks are joined in order.

A null or blank page gives an empty text. Pages of any length are read whole, in linear time: tags that never end
take the rest of the page, and only names that the field knows are kept. Equal rows get equal results; extra columns
are not read."""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollway.llm import pages, rolling
from tollway.llm.common import small_batches

#: Labelled pages that the field is trained on, and passes over them.
PAGES, PASSES, RATE, DECAY = 800, 250, 0.1, 1e-4
#: Pages that a feature must stand on to be learnt.
RARE = 4

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(script|style|textarea|title)(?=[\s/>]).*?(?:</\1\s*>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*)/?>|(noscript|template|svg|select|iframe)(?=[\s/>]))""", re.DOTALL | re.IGNORECASE)
#: Elements that are skipped up to their closing tag, if there is one; of TAG's own, bare text, an unclosed one takes the rest of the page.
SKIPPED = {x: re.compile(rf"</{x}\s*>", re.IGNORECASE) for x in ("noscript", "template", "svg", "select", "iframe")}
# Block-level elements, and those that can't hold others.
BLOCKS = set("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: An opening tag that ends an open element of the same kind.
CLOSES = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "tr": ("tr", "td", "th", "p")}
#: Elements that stand beside an article.
SIDE = {"<nav", "<header", "<footer", "<aside", "<form"}
NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PART = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


class Block(NamedTuple):
    text: str
    #: features of the ancestors
    names: frozenset[str]
    #: characters within links
    linked: int
    #: the nearest element, and the nearest container's number
    tag: str
    box: int


#: Elements that hold a piece of text rather than a part of a page.
PIECES = set("address blockquote button caption dd dl dt figcaption h1 h2 h3 h4 h5 h6 hr label legend li ol p pre summary tbody tfoot thead th tr ul".split())


def blocks(page: str, known: frozenset[str] | None = None) -> tuple[list[Block], list[int]]:
    """Each leaf block that has text, and the parent of each container. Of the ancestors' features those in `known` are kept."""
    found: list[Block] = []
    stack: list[tuple[str, frozenset[str], int]] = []
    open_: dict[str, int] = {}
    boxes = [0]
    text: list[str] = []
    linked = anchors = 0
    names: frozenset[str] = frozenset()

    def end():
        nonlocal linked
        if text:
            clean = SPACE.sub(" ", html.unescape("".join(text))).strip()
            if clean:
                found.append(Block(clean, names, linked, stack[-1][0] if stack else "", stack[-1][2] if stack else 0))
            text.clear()
        linked = 0

    def push(tag: str, rest: str):
        nonlocal names
        own = {"<" + tag}
        for m in NAME.finditer(rest) if rest else ():
            own.update("." + x for x in PART.findall((m[1] or m[2] or m[3] or "").lower()))
        box = stack[-1][2] if stack else 0
        if tag not in PIECES:
            boxes.append(box)
            box = len(boxes) - 1
        stack.append((tag, names, box))
        open_[tag] = open_.get(tag, 0) + 1
        names = names | own if known is None else names | (own & known)

    def pop(to: int):
        nonlocal names
        names = stack[to][1]
        for tag, *_ in stack[to:]:
            open_[tag] -= 1
        # what stands above in the stack keeps its container
        del stack[to:]

    at, endless = 0, set()
    while m := TAG.search(page, at):
        if m.start() > at:
            piece = page[at : m.start()]
            text.append(piece)
            linked += len(piece) if anchors else 0
        at = m.end()
        tag = (m[3] or m[5] or "").lower()
        if not tag:
            continue
        if tag in SKIPPED:
            if not m[2] and tag not in endless and not (tag == "svg" and m[0].endswith("/>")):
                if close := SKIPPED[tag].search(page, at):
                    at = close.end()
                else:
                    endless.add(tag)
            continue
        if tag == "br":
            text.append(" ")
        elif tag == "a":
            anchors = 0 if m[2] else 1
        elif tag in BLOCKS:
            end()
            anchors = 0
            if m[2]:
                if open_.get(tag):
                    i = len(stack) - 1
                    while stack[i][0] != tag:
                        i -= 1
                    pop(i)
            else:
                for other in CLOSES.get(tag, ()):
                    if stack and stack[-1][0] == other:
                        pop(len(stack) - 1)
                if tag not in VOID:
                    push(tag, m[4])
    if at < len(page):
        text.append(page[at:])
    end()
    return found, boxes


def weighed(page: list[Block], boxes: list[int]) -> tuple[list[int], set[int]]:
    """Unlinked characters in sentences, of each container by itself; and the containers within the smallest one that has MOST of all."""
    own = [0] * len(boxes)
    for x in page:
        n = len(x.text) - x.linked
        own[x.box] += n if n > 60 or x.text[-1] in ENDS else n // 8
    below = list(own)
    for i in range(len(boxes) - 1, 0, -1):
        below[boxes[i]] += below[i]
    main = max((i for i in range(len(boxes)) if below[i] >= MOST * below[0]), default=0)
    inside = {main}
    for i in range(main + 1, len(boxes)):
        if boxes[i] in inside:
            inside.add(i)
    return own, inside


#: Share of a page's text that its main part has.
MOST = 0.6
ENDS = ".!?:…"
# Words in the headings of reader comments, and beginnings of lines about an author or a date.
REPLIES = re.compile(r"(?i)\b(comments?|repl(?:y|ies)|responses|discussion|kommentare?|commentaires?|comentarios)\b")
BYLINE = re.compile(r"(?i)(?:(?:posted|written|published|updated|veröffentlicht|publié|publicado) (?:by|on|at|in|von|am|par|le|por|el)\b|(?:by|von|par|por) \S+(?: \S+){0,5}$)")


def features(page: list[Block], boxes: list[int]) -> list[list[str]]:
    """Names of the features of each block."""
    out = []
    weight, inside = weighed(page, boxes)
    most, replies = max(weight), False
    size = ["edge", *(f"{min(len(x.text).bit_length(), 9) // 2}{'linked' if 2 * x.linked > len(x.text) else ''}" for x in page), "edge"]
    for i, (text, names, linked, tag, box) in enumerate(page):
        own = ["bias", *names, "own " + tag, "before " + size[i], "after " + size[i + 2]]
        n = len(text)
        own.append(f"length{min(n.bit_length(), 10)}")
        own.append("linked" if 2 * linked > n else "unlinked")
        if text[-1] in ENDS:
            own.append("sentence")
        if "©" in text or "copyright" in text.lower():
            own.append("rights")
        if i == len(page) - 1:
            own.append("last")
            if own[-2] == "rights":
                own.append("last rights")
        named = any(x[0] == "." for x in names)
        if not ({"<article", "<main"} & names):
            own.append("outside" if named or SIDE & names else "bare")
        if "<article" in names and not named:
            own.append("plain article")
        own.append("heaviest" if weight[box] == most else "heavy" if 4 * weight[box] >= most else "light")
        own.append("within" if box in inside else "beside")
        heading = tag in HEADINGS
        if heading:
            own.append("heading")
        if n < 60 and REPLIES.search(text) and (heading or not replies):
            replies = True
        if replies:
            own.append("replies")
        if n < 80 and text[-1] not in ENDS and BYLINE.match(text):
            own.append("byline")
        out.append(own)
    return out


HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


class Field:
    """Weights of features for the label 1, and of label pairs."""

    def __init__(self, weights: dict[str, float], pairs: np.ndarray):
        self.weights, self.pairs = weights, pairs
        self.known = frozenset(x for x in weights if x[0] in "<.")

    def scores(self, page: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(f, 0.0) for f in own) for own in page]

    def decode(self, scores: list[float]) -> list[int]:
        """The best labels by Viterbi."""
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b, back = 0.0, scores[0] if scores else 0.0, []
        for s in scores[1:]:
            x, y = a + p00 >= b + p10, a + p01 >= b + p11
            back.append((0 if x else 1, 0 if y else 1))
            a, b = (a + p00 if x else b + p10), (a + p01 if y else b + p11) + s
        label = int(b > a)
        out = [label] if scores else []
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def train(labelled: list[tuple[list[list[str]], list[int]]], passes: int = PASSES) -> Field:
    """Ascends the mean log-likelihood, over all pages at once, with forward-backward in probabilities (Adam steps)."""
    labelled = [x for x in labelled if x[1]]
    seen_on = Counter(f for page, _ in labelled for f in {f for own in page for f in own})
    index = {f: i for i, f in enumerate(f for f, n in seen_on.items() if n >= min(RARE, len(labelled)))}
    size, steps = len(labelled), max(len(y) for _, y in labelled)
    cell, feature = [], []
    real, gold = np.zeros((size, steps), bool), np.zeros((size, steps), np.int64)
    for i, (page, y) in enumerate(labelled):
        real[i, : len(y)], gold[i, : len(y)] = True, y
        for j, own in enumerate(page):
            own = [index[f] for f in own if f in index]
            cell += [i * steps + j] * len(own)
            feature += own
    cell, feature = np.array(cell), np.array(feature)
    w = np.zeros(len(index) + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    blocks_ = real.sum()
    both = real[:, 1:]
    seen = np.array([[(both & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    for step in range(1, passes + 1):
        score = np.bincount(cell, w[:-4][feature], size * steps).reshape(size, steps)
        emit = np.exp(np.stack([np.zeros_like(score), np.clip(score, -30, 30)], 2))
        move = np.exp(w[-4:].reshape(2, 2))
        forward, backward = np.ones((size, steps, 2)), np.ones((size, steps, 2))
        forward[:, 0] = emit[:, 0]
        forward[:, 0] /= forward[:, 0].sum(1, keepdims=True)
        for t in range(1, steps):
            f = (forward[:, t - 1] @ move) * emit[:, t]
            forward[:, t] = np.where(real[:, t, None], f / f.sum(1, keepdims=True), forward[:, t - 1])
        for t in range(steps - 2, -1, -1):
            b = (emit[:, t + 1] * backward[:, t + 1]) @ move.T
            backward[:, t] = np.where(real[:, t + 1, None], b / b.sum(1, keepdims=True), 1.0)
        p = forward * backward
        p = p[..., 1] / p.sum(2)
        pair = forward[:, :-1, :, None] * move * (emit * backward)[:, 1:, None, :]
        pair = (pair / pair.sum((2, 3), keepdims=True) * both[..., None, None]).sum((0, 1))
        grad = np.r_[np.bincount(feature, ((gold - p) * real).ravel()[cell], len(index)), (seen - pair).ravel()] / blocks_ - DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        w += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field({f: float(w[i]) for f, i in index.items()}, w[-4:].reshape(2, 2))


@cache
def field(n: int = PAGES, passes: int = PASSES) -> Field:
    """The field trained on pages 0 to n - 1; the same each time."""
    made = [pages.Page(i) for i in range(n)]
    return train([(features(*blocks("".join(x.html))), [y for _, y in x.blocks]) for x in made], passes)


def main_text(page: str, model: Field) -> str:
    found, boxes = blocks(page, model.known)
    labels = model.decode(model.scores(features(found, boxes)))
    return "\n\n".join(x.text for x, y in zip(found, labels, strict=True) if y)


def extract(rows: DataFrame, model: Field | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    model = rows.sparkSession.sparkContext.broadcast(model or field())

    def run(batches):
        for batch in rolling.chunks(batches, "html"):
            text = [main_text(x or "", model.value) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(x) for x in text], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    small_batches(rows.sparkSession)
    return rows.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
