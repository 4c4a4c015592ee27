"""Main text of HTML pages: a linear-chain conditional random field over the leaf
blocks of the DOM.

A page becomes its sequence of leaf blocks (runs of text between block-level
tags). Features of a block are its tag, its ancestors' tags and class or id words,
and properties of its text. The field is trained with numpy on pages whose markup
says which block is what (one article or main element, boilerplate in its own
elements), together with copies of them in which that markup is renamed or dropped
and further boilerplate is put in; Viterbi decoding gives each block its label.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from sentinela.llm.common import add_columns

#: Pages that the field is fitted on, at most.
MAX_PAGES = 300

_TOKEN = re.compile(
    r"<!--(?:.*?)-->|<!--.*|<[!?][^>]*>"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|textarea|title)(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.I | re.S,
)
_CLOSED = re.compile(r"(?:-->|</[a-z]+\s*>)$", re.I)
_ATTR = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+")

#: Elements that do not end a block.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a new element of the first kind closes.
_CLOSES = {
    **{t: ("p",) for t in "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()},
    "li": ("p", "li"), "dt": ("p", "dt", "dd"), "dd": ("p", "dt", "dd"), "tr": ("p", "tr", "td", "th"), "td": ("p", "td", "th"),
    "th": ("p", "td", "th"), "option": ("option",), "body": ("head", "p"),
}
_SCOPE = frozenset("ul ol dl table td th div article section main aside nav body blockquote form".split())

_MAIN_TAGS = frozenset(("article", "main"))
_SIDE_TAGS = frozenset("nav header footer aside form head menu dialog button select option fieldset".split())
#: Class and id words of boilerplate, and of main content, for labels and for the made copies.
_SIDE_WORDS = {
    "menu": ["nav", "menu", "navbar", "navigation", "breadcrumb"], "header": ["header", "masthead", "topbar"],
    "footer": ["footer", "copyright", "bottom"], "sidebar": ["sidebar", "aside", "widget", "related", "share", "social", "tags"],
    "notice": ["notice", "cookie", "consent", "banner", "alert", "gdpr", "popup", "modal", "newsletter", "subscribe"],
    "advert": ["ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo"],
    "form": ["form", "login", "search", "signup"], "comments": ["comment", "comments", "disqus", "reply", "respond"],
}
_MAIN_WORDS = ["content", "post", "entry", "story", "text", "body", "page"]
_ALL_SIDE = frozenset(w for ws in _SIDE_WORDS.values() for w in ws)


@dataclass
class Block:
    text: str
    tag: str
    path: tuple[str, ...]  # ancestors' tags, outermost first, the block's own last
    words: frozenset[str]  # class, id and role words of all of them
    link: float  # share of the characters inside links


def leaf_blocks(page: str | None) -> list[Block]:
    """Leaf blocks with text, in page order; character references decoded, white
    space (line breaks included) as one space. Scripts, styles, comments and the
    like are markup and give none."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    parts: list[str] = []
    linked = total = depth = at = 0

    def flush() -> None:
        nonlocal linked, total, depth
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                path = tuple(t for t, _ in stack)
                words = frozenset().union(*(w for _, w in stack)) if stack else frozenset()
                out.append(Block(text, path[-1] if path else "", path, words, linked / max(1, total)))
            parts.clear()
        linked = total = depth = 0

    def add(raw: str) -> None:
        nonlocal linked, total
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            total += len(text)
            if depth:
                linked += len(text)

    page = page or ""
    end = page.rfind(">") + 1
    if (never := page.find("<!--", end)) >= 0:
        page = page[:never]
    for m in _TOKEN.finditer(page, 0, end):
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if m.end() == end and (m["raw"] or m[0].startswith("<!--")) and not _CLOSED.search(m[0]):
                at = len(page)  # never closed: all the rest is markup
            if m["raw"] and m["raw"].lower() not in ("svg",):
                flush()
            continue
        tag = tag.lower()
        if tag in _INLINE:
            if tag == "a":
                depth = 0 if m["end"] else 1
            elif tag == "br":
                parts.append(" ")
            continue
        flush()
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        for closed in (True,) * 3:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in _CLOSES.get(tag, ()):
                    del stack[i:]
                    break
                if stack[i][0] in _SCOPE and not (tag == "body" and stack[i][0] == "head"):
                    closed = False
                    break
            else:
                closed = False
            if not closed:
                break
        if tag not in _VOID and not m["attrs"].endswith("/"):
            words = [w for a in _ATTR.findall(m["attrs"]) for w in _PART.findall(" ".join(a[1:]).lower())] if m["attrs"] else ()
            stack.append((tag, frozenset(words)))
    add(page[at:])
    flush()
    return out


_ENDS = re.compile(r"[.!?…][\"'”»)\]*%&$#]*$")


def text_features(b: Block) -> list[str]:
    words = b.text.count(" ") + 1
    size = min(words.bit_length(), 8)
    link = 0 if b.link == 0 else 1 if b.link < 0.34 else 2 if b.link < 0.8 else 3
    out = [f"size={size}", f"link={link}", f"size,link={size},{link}"]
    if _ENDS.search(b.text):
        out.append(f"ends,size={min(size, 4)}")
    if b.text[0] in "©®" or "©" in b.text:
        out.append("copyright")
    if sum(map(str.isdigit, b.text[:200])) * 5 > min(len(b.text), 200):
        out.append("digits")
    return out


def path_features(path: Sequence[str], words: frozenset[str]) -> list[str]:
    out = [f"tag={path[-1]}" if path else "tag="] + [f"in={t}" for t in set(path)]
    out += [f"word={w}" for w in words]
    if words & _ALL_SIDE:
        out.append("side word")
    return out


def told_label(b: Block) -> int:
    """What the markup says of a block: 1 for main text."""
    inside = [i for i, t in enumerate(b.path) if t in _MAIN_TAGS]
    if not inside or b.words & _ALL_SIDE:
        return 0
    return int(not any(t in _SIDE_TAGS for t in b.path[inside[0] :]))


def is_labelled(page: str | None) -> bool:
    """One article or main element only: its markup is taken as labels."""
    return page is not None and len(re.findall(r"<(?:article|main)[\s>]", page, re.I)) == 1


Example = tuple[list[list[str]], list[int]]


def examples(page: str, seed: int) -> list[Example]:
    """The page with its told labels, and three copies with other markup."""
    blocks = leaf_blocks(page)
    if not blocks:
        return []
    labels, rng = [told_label(b) for b in blocks], random.Random(seed)
    texts = [text_features(b) for b in blocks]
    out = [([path_features(b.path, b.words) + t for b, t in zip(blocks, texts)], labels)]
    for _ in range(3):
        main = rng.choice(["article", "main", "section", "div"])
        word = rng.choice([None, *_MAIN_WORDS])
        rename = {t: rng.choice([t, "div", "section"]) for t in ("nav", "footer", "aside", "header")}
        seq, y = [], []

        def side(kind: str, inside: bool) -> None:
            tags = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
            named = rng.random() < 0.75
            tag = tags.get(kind, "div") if rng.random() < 0.5 else "div"
            if tag == "div":
                named = True
            base = ["html", "body"] + ([main] if inside else []) + [tag]
            words = frozenset([rng.choice(_SIDE_WORDS[kind])] if named else []) | (frozenset([word]) if inside and word else frozenset())
            for _ in range(rng.randint(1, 3)):
                shape = rng.choice(texts) if kind in ("comments", "sidebar") else rng.choice([["size=3", "link=0", "size,link=3,0"], ["size=2", "link=3", "size,link=2,3"], ["size=4", "link=1", "size,link=4,1"]])
                leaf = rng.choice(["p", "div", "li", "h3"])
                seq.append(path_features([*base, leaf], words) + shape)
                y.append(0)

        for kind in rng.sample(["menu", "header", "notice", "advert"], 2):
            side(kind, False)
        for i, (b, t, label) in enumerate(zip(blocks, texts, labels)):
            if label:
                path = ["html", "body", main, *[x for x in b.path if x not in _MAIN_TAGS and x not in ("html", "body")]]
                seq.append(path_features(path, frozenset([word] if word else [])) + t)
                y.append(1)
                if rng.random() < 0.08:
                    side(rng.choice(["advert", "notice", "form"]), True)
            else:
                path = [rename.get(x, x) for x in b.path]
                known = next((k for x in b.path for k, tg in (("menu", "nav"), ("footer", "footer"), ("sidebar", "aside"), ("header", "header")) if x == tg), None)
                words = b.words | frozenset([rng.choice(_SIDE_WORDS[known])] if known and known not in path else [])
                seq.append(path_features(path, words) + t)
                y.append(0)
        for kind in rng.sample(["comments", "sidebar", "footer", "form"], 2):
            side(kind, rng.random() < 0.3)
        out.append((seq, y))
    return out


@dataclass
class Field:
    """Linear-chain field with labels 0 (other) and 1 (main text)."""

    index: dict[str, int]
    unary: np.ndarray  # features x 2
    step: np.ndarray  # from label x to label
    first: np.ndarray

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """Viterbi: the most likely labels of one page's blocks."""
        if not sequence:
            return []
        unary, get = self.unary, self.index.get
        (s00, s01), (s10, s11) = self.step.tolist()
        a, b = self.first.tolist()
        back = []
        for i, features in enumerate(sequence):
            rows = [r for f in features if (r := get(f)) is not None]
            e0, e1 = unary[rows].sum(0).tolist() if rows else (0.0, 0.0)
            if i:
                from0, from1 = (a + s00, b + s10), (a + s01, b + s11)
                back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
                a, b = max(from0), max(from1)
            a, b = a + e0, b + e1
        label = int(b > a)
        out = [label]
        for pair in reversed(back):
            label = pair[label]
            out.append(label)
        return out[::-1]


def log_likelihood(e: np.ndarray, y: np.ndarray, mask: np.ndarray, step: np.ndarray, first: np.ndarray):
    """Of padded sequences (pages x length x 2): value, and node and edge
    marginals by forward-backward."""
    n, t, _ = e.shape
    alpha = np.zeros_like(e)
    alpha[:, 0] = first + e[:, 0]
    for i in range(1, t):
        new = np.logaddexp(alpha[:, i - 1, 0, None] + step[0], alpha[:, i - 1, 1, None] + step[1]) + e[:, i]
        alpha[:, i] = np.where(mask[:, i, None], new, alpha[:, i - 1])
    z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
    beta, edges = np.zeros_like(e), np.zeros((2, 2))
    for i in range(t - 2, -1, -1):
        nxt = e[:, i + 1] + beta[:, i + 1]
        new = np.logaddexp(step[:, 0] + nxt[:, 0, None], step[:, 1] + nxt[:, 1, None])
        live = mask[:, i + 1]
        beta[:, i] = np.where(live[:, None], new, beta[:, i + 1])
        pair = alpha[live, i, :, None] + step + nxt[live, None, :] - z[live, None, None]
        edges += np.exp(pair).sum(0)
    nodes = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
    gold = np.take_along_axis(e, y[..., None], 2)[..., 0]
    both = mask[:, 1:]
    value = (gold * mask).sum() + first[y[:, 0]].sum() + (step[y[:, :-1], y[:, 1:]] * both).sum() - z.sum()
    return value, nodes, edges


def fit_field(data: Sequence[Example], steps: int = 120, rate: float = 0.15, decay: float = 1e-3) -> Field:
    """Maximum likelihood with Adam on all sequences."""
    data = [d for d in data if d[0]]
    names = sorted({f for seq, _ in data for fs in seq for f in fs})
    index = {f: i for i, f in enumerate(names)}
    n, t = len(data), max((len(y) for _, y in data), default=1)
    mask, y = np.zeros((n, t), bool), np.zeros((n, t), np.int64)
    rows, cols = [], []
    for i, (seq, labels) in enumerate(data):
        mask[i, : len(labels)], y[i, : len(labels)] = True, labels
        for j, fs in enumerate(seq):
            rows += [i * t + j] * len(fs)
            cols += [index[f] for f in fs]
    rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
    params = [np.zeros((len(names), 2)), np.zeros((2, 2)), np.zeros(2)]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    one_hot = np.eye(2)[y] * mask[..., None]
    gold_edges = np.zeros((2, 2))
    np.add.at(gold_edges, (y[:, :-1][mask[:, 1:]], y[:, 1:][mask[:, 1:]]), 1)
    size = max(1, int(mask.sum()))
    for k in range(1, steps + 1 if n else 1):
        e = np.stack([np.bincount(rows, params[0][cols, c], n * t) for c in (0, 1)], -1).reshape(n, t, 2)
        _, nodes, edges = log_likelihood(e, y, mask, params[1], params[2])
        diff = (one_hot - nodes).reshape(n * t, 2)
        g0 = np.stack([np.bincount(cols, diff[rows, c], len(names)) for c in (0, 1)], -1)
        grads = [g0, gold_edges - edges, (one_hot[:, 0] - nodes[:, 0]).sum(0)]
        for p, g, m in zip(params, grads, moments):
            g = g / size - decay * p
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            p += rate * (m[0] / (1 - 0.9**k)) / (np.sqrt(m[1] / (1 - 0.999**k)) + 1e-8)
    return Field(index, *params)


def labelled_examples(spark: SparkSession, pages: DataFrame, page_id: str, page: str, max_pages: int) -> list[Example]:
    """Examples of at most ``max_pages`` labelled pages, those with the smallest
    hashes; only they come to the driver, as features."""
    import pyarrow as pa

    told = pages.select(F.col(f"`{page_id}`").alias("i"), F.col(f"`{page}`").alias("h")).where(
        F.size(F.regexp_extract_all(F.col("h"), F.lit("(?i)<(?:article|main)[\\s>]"), F.lit(0))) == 1
    )
    order = (F.xxhash64(F.col("i").cast("string")), "i")
    ids = told.where("i IS NOT NULL").select("i").distinct().orderBy(*order).limit(max_pages)
    chosen = told.join(F.broadcast(ids), "i").dropDuplicates(["i"])

    def run(batches):
        import json

        for b in batches:
            out = [json.dumps(examples(h, i)) for i, h in enumerate(b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["e"])

    import json

    rows = chosen.select(F.coalesce("h", F.lit("")).alias("h")).mapInArrow(run, "e string").collect()
    return [(seq, y) for r in rows for seq, y in json.loads(r.e)]


def extract(field: Field | None, page: str | None) -> str:
    """Main text of one page: its blocks with label 1, one line each."""
    blocks = leaf_blocks(page)
    if field is None:
        labels = [told_label(b) for b in blocks]
    else:
        labels = field.decode([path_features(b.path, b.words) + text_features(b) for b in blocks])
    return "\n".join(b.text for b, keep in zip(blocks, labels) if keep)


def main_text(
    spark: SparkSession,
    pages: DataFrame,
    page_id: str = "page_id",
    page: str = "html",
    keep: list[str] | None = None,
    max_pages: int = MAX_PAGES,
) -> DataFrame:
    """``pages`` with ``text`` (main text, blocks joined by one line break, empty
    if there is none) and ``n_chars`` (its code points).

    The field is fitted once on at most ``max_pages`` labelled pages; without a
    labelled page nothing can be learnt and the markup's own labels are taken.
    Null and empty pages give empty text; repeated rows and null ids are decoded
    like any other; input columns named like an output column are replaced.
    """
    data = labelled_examples(spark, pages, page_id, page, max_pages)
    fitted = fit_field(data) if data else None
    # plain data: a broadcast stores objects of our classes by name, which workers without the package cannot load
    shared = spark.sparkContext.broadcast(fitted and (fitted.index, fitted.unary, fitted.step, fitted.first))

    def compute(texts: list) -> list:
        field = Field(*shared.value) if shared.value else None
        out = [extract(field, t) for t in texts]
        return [out, [len(t) for t in out]]

    return add_columns(pages, page, [StructField("text", StringType()), StructField("n_chars", LongType())], compute, keep)
