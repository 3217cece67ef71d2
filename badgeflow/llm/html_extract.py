"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

Each block is described by its ancestors' tags and names, and by its text; the chain
adds that main text and surroundings each come in runs. The field is trained on
labelled pages: a bounded sample of the table's own pages whose markup says where the
article is, and the same texts set anew into other layouts, with navigation, notices,
adverts, forms, sidebars and comments of known place (see ``layouts``). Viterbi
decoding then keeps the blocks of the most likely labelling.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from badgeflow.llm.common import table
from badgeflow.llm.dom import Block, leaf_blocks
from badgeflow.llm.layouts import set_anew

# Labelled pages: those with the smallest hash of page_id, of at most so many characters
# (they come to the driver).
TRAINING_PAGES = 300
TRAINING_CHARS = 50_000
# With fewer pages whose markup states labels, texts are guessed for the made layouts.
STATED_PAGES = 20
# What a guessed article consists of: blocks of so many words, hardly any of them in links.
GUESSED_WORDS = 8
# For a table without any text of that kind: fixed values.
SENTENCES = [
    "The river had risen again during the night, and nobody in the village had slept.",
    "When the engineers came back in the morning, they found that the second gate was stuck.",
    "It took them most of the day, two pumps and a good deal of patience to move it.",
    "By the evening the water stood a hand lower, and the first people went home.",
]
OTHER_WORDS = ["Home", "News and more", "About us", "Contact", "All rights reserved", "Read our terms", "Log in"]

# What names of elements tell, by the beginnings of their parts; whole parts for short ones.
NAME_GROUPS = {
    "nav": ("nav", "menu", "breadcrumb", "pager", "paginat", "toolbar", "tab"),
    "head": ("header", "masthead", "topbar", "logo", "brand", "banner"),
    "foot": ("foot", "copyright", "legal", "colophon", "bottom"),
    "side": ("side", "aside", "widget", "rail", "relat", "recommend", "trend", "popular", "toc", "complementary"),
    "ad": ("ad", "ads", "advert", "sponsor", "promo", "commercial"),
    "note": ("cookie", "consent", "gdpr", "notice", "notif", "alert", "popup", "modal", "overlay", "paywall", "toast", "dialog", "privacy"),
    "form": ("form", "login", "signup", "search", "subscri", "newsletter", "contact", "register", "input"),
    "talk": ("comment", "repl", "respon", "discuss", "disqus", "thread", "feedback", "guestbook", "review"),
    "share": ("share", "sharing", "social", "follow", "tags", "byline", "meta", "author"),
    "main": ("article", "content", "post", "entry", "story", "main", "body", "text", "prose"),
}
WHOLE = frozenset({"ad", "ads", "tab", "toc", "nav", "rail", "side"})
TAG_GROUPS = {
    "nav": "nav", "menu": "nav", "header": "head", "footer": "foot", "aside": "side", "form": "form",
    "fieldset": "form", "dialog": "note", "article": "main", "main": "main",
}


@lru_cache(maxsize=100_000)
def name_groups(tag: str, names: tuple[str, ...]) -> tuple[str, ...]:
    groups = [TAG_GROUPS[tag]] if tag in TAG_GROUPS else []
    for part in names:
        groups += [g for g, starts in NAME_GROUPS.items() if any(part == s if s in WHOLE else part.startswith(s) for s in starts)]
    return tuple(dict.fromkeys(groups))


@lru_cache(maxsize=100_000)
def path_features(path: tuple[tuple[str, tuple[str, ...]], ...]) -> tuple[str, ...]:
    out = [f"tag={path[-1][0] if path else ''}"]
    out += {f"in={tag}" for tag, _ in path}
    groups = [g for tag, names in path for g in name_groups(tag, names)]
    out += {f"any={g}" for g in groups}
    bad = [g for g in groups if g != "main"]
    out.append(f"near={groups[-1] if groups else 'none'}")
    out.append(f"worst={bad[-1] if bad else 'none'}")
    # Something else inside the article, and an article inside something else.
    if "main" in groups and bad:
        out.append("inside=" + ("main" if groups.index("main") < groups.index(bad[-1]) else bad[-1]))
    return tuple(sorted(set(out)))


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features that hold, for each block of a page."""
    out, n = [], len(blocks)
    for at, block in enumerate(blocks):
        text, words = block.text, block.text.count(" ") + 1
        size = min(7, words.bit_length())
        linked = block.link_chars / len(text)
        link = 0 if linked == 0 else 1 if linked < 0.3 else 2 if linked < 0.8 else 3
        own = [
            "bias",
            f"words={size}",
            f"link={link}",
            f"end={text[-1] in '.!?'}",
            f"commas={min(3, text.count(','))}",
            f"bars={min(2, text.count('|'))}",
            f"link,words={link},{size}",
            f"place={'first' if at == 0 else 'last' if at == n - 1 else 'middle'}",
        ]
        if "©" in text:
            own.append("copyright")
        own += path_features(block.path)
        out.append(own)
    return out


@dataclass
class Field:
    """Weights for the label 1 (main text) against 0, and between neighbours."""

    weights: dict[str, float]
    step: np.ndarray  # step[a, b]: from label a to the next block's label b
    first: np.ndarray

    def decode(self, blocks: list[Block]) -> list[int]:
        """The most likely labels (Viterbi); of equal ones, main text."""
        get = self.weights.get
        (s00, s01), (s10, s11) = self.step.tolist()
        zero, one = self.first.tolist()
        back = []
        for at, own in enumerate(features(blocks)):
            emit = sum(get(f, 0.0) for f in own)
            if at:
                from_zero, from_one = (zero + s00 > one + s10), (zero + s01 > one + s11)
                back.append((0 if from_zero else 1, 0 if from_one else 1))
                zero, one = max(zero + s00, one + s10), max(zero + s01, one + s11)
            one += emit
        if not blocks:
            return []
        label = 0 if zero > one else 1
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]


def fit(pages: list[tuple[list[Block], list[int]]], rounds: int = 150, decay: float = 1e-3) -> Field:
    """Maximum likelihood with squared weights held down, by gradient steps over all
    pages at once (forward and backward sums in log space, padded to one length)."""
    pages = [(b, y) for b, y in pages if b]
    names: dict[str, int] = {}
    cells, rows = [], []
    longest = max((len(b) for b, _ in pages), default=0)
    mask, truth = np.zeros((len(pages), longest), bool), np.zeros((len(pages), longest), int)
    for p, (blocks, labels) in enumerate(pages):
        mask[p, : len(blocks)], truth[p, : len(blocks)] = True, labels
        for t, own in enumerate(features(blocks)):
            cells += [names.setdefault(f, len(names)) for f in own]
            rows += [p * longest + t] * len(own)
    cells, rows = np.array(cells, int), np.array(rows, int)
    theta = np.zeros(len(names) + 6)
    if not pages:
        return Field({}, np.zeros((2, 2)), np.zeros(2))
    moment, square = np.zeros_like(theta), np.zeros_like(theta)
    ends = mask.sum(axis=1) - 1
    every = np.arange(len(pages))
    log_sum = lambda a, b: np.logaddexp(a, b)
    for turn in range(1, rounds + 1):
        w, step, first = theta[:-6], theta[-6:-2].reshape(2, 2), theta[-2:]
        emit = np.zeros((len(pages), longest, 2))
        emit[:, :, 1] = np.bincount(rows, w[cells], mask.size).reshape(mask.shape)
        ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
        ahead[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            moved = log_sum(ahead[:, t - 1, :1] + step[0], ahead[:, t - 1, 1:] + step[1]) + emit[:, t]
            ahead[:, t] = np.where(mask[:, t, None], moved, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            later = emit[:, t + 1] + behind[:, t + 1]
            moved = log_sum(step[:, 0] + later[:, :1], step[:, 1] + later[:, 1:])
            behind[:, t] = np.where(mask[:, t + 1, None], moved, 0)
        norm = np.logaddexp.reduce(ahead[every, ends], axis=1)
        single = np.exp(ahead + behind - norm[:, None, None]) * mask[:, :, None]
        grad = np.zeros_like(theta)
        grad[:-6] = np.bincount(cells, ((truth == 1) * mask - single[:, :, 1]).ravel()[rows], len(names))
        both = mask[:, 1:]
        for a in range(2):
            for b in range(2):
                joint = np.exp(ahead[:, :-1, a] + step[a, b] + emit[:, 1:, b] + behind[:, 1:, b] - norm[:, None]) * both
                grad[len(names) + 2 * a + b] = ((truth[:, :-1] == a) & (truth[:, 1:] == b) & both).sum() - joint.sum()
        grad[-2:] = [(truth[:, 0] == a).sum() - single[:, 0, a].sum() for a in range(2)]
        grad = grad / len(pages) - decay * theta
        moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta += 0.1 * (moment / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    return Field(dict(zip(names, theta[:-6].tolist())), theta[-6:-2].reshape(2, 2), theta[-2:])


def stated(blocks: list[Block]) -> list[int] | None:
    """Labels that the markup states: blocks in <article> or <main>, but in no nearer
    element of another kind. None where it has neither."""
    if not any(tag in ("article", "main") for b in blocks for tag, _ in b.path):
        return None
    labels = []
    for block in blocks:
        groups = [g for tag, names in block.path for g in name_groups(tag, names)]
        labels.append(int(bool(groups) and groups[-1] == "main"))
    return labels


def guessed(blocks: list[Block]) -> tuple[list[str], list[str]]:
    """Texts that may be an article's, and others: only their words are used, in made
    layouts; nothing of the page is labelled by it."""
    long = [b for b in blocks if b.text.count(" ") + 1 >= GUESSED_WORDS and b.link_chars < 0.3 * len(b.text)]
    return [b.text for b in long], [b.text for b in blocks if b not in long]


def labelled_pages(htmls: list[str]) -> list[tuple[list[Block], list[int]]]:
    """Pages whose markup states the labels, as they are and in other layouts; with few of
    them, other pages' texts in such layouts as well."""
    parsed = [leaf_blocks(html) for html in htmls]
    plain = [(b, y) for b in parsed if (y := stated(b)) is not None]
    articles = [[b.text for b, label in zip(*page) if label] for page in plain]
    others = [b.text for page in plain for b, label in zip(*page) if not label]
    if len(plain) < STATED_PAGES:
        texts = [guessed(b) for b in parsed if stated(b) is None]
        articles += [own for own, _ in texts] + [SENTENCES] * STATED_PAGES
        others += [text for _, rest in texts for text in rest] + OTHER_WORDS
    again = [leaf_blocks(html) for html in set_anew([a for a in articles if a], others)]
    return plain + [(b, [x.label or 0 for x in b]) for b in again]


def train(pages: DataFrame, rows: int = TRAINING_PAGES, chars: int = TRAINING_CHARS) -> Field:
    """From a bounded sample of the pages: at most ``rows`` of at most ``chars`` characters.

    A table without pages that state labels, or without any pages, is trained on made
    layouts, so that what is main text never depends on there being such pages.
    """
    short = pages.where(F.length("html").between(1, chars))
    order = F.xxhash64("page_id", "url")
    ids = short.select(order.alias("order")).orderBy("order").limit(rows)
    last = ids.agg(F.max("order")).first()[0]
    if last is None:
        return fit(labelled_pages([]))
    found = short.select(order.alias("order"), "html").where(F.col("order") <= last).orderBy("order", "html").limit(rows)
    return fit(labelled_pages([r.html for r in found.collect()]))


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """(page_id, url, text) of every page: its main blocks, joined by \\n.

    NULL and empty html, and pages without main text, give an empty text. Repeated
    rows each give a row; NULL ids and urls stay NULL; an empty table gives an empty one,
    and other columns are not read. A page of any length is read whole; an element that is
    never closed ends with the one around it.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html in batch[2]:
                blocks = leaf_blocks(html.as_py())
                texts.append("\n".join(b.text for b, label in zip(blocks, shared.value.decode(blocks)) if label))
            yield pa.RecordBatch.from_arrays([batch[0], batch[1], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id bigint, url string, text string")


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages)).withColumn("n_chars", F.length("text").cast("long"))
