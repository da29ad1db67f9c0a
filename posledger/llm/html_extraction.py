"""Main-text extraction: gradient-boosted trees over DOM-node features, decoded over the tree.

Every element that is not plain inline markup gets features: its depth, the size, text density, link density and
punctuation of its subtree, what its tag and its class, id and role tokens say (on itself, above and below), and how it
compares with its siblings and the page. Boosted trees, trained with MLlib, give each the probability that its subtree
holds main text.

Decoding. An element may be kept only if its parent is. Bottom-up, the best log-likelihood of an element's subtree is
the better of dropping it whole and of keeping it with the best choices below; top-down the winners are read off. So no
element is kept below a dropped one, whatever the single probabilities say.

Training. Pages have no labels, so a bounded sample (``TRAIN_PAGES`` with the smallest hash of id and url) is labelled by
its own semantic markup: elements within an article or main element, and those around it, hold main text, except those
whose tag or tokens name furniture, and all below them. Every sampled page is used twice, once as it is and once with
the names of article and main elements hidden, so that the model also serves pages that lack them.

Defined results: a null html is empty and has empty text. Without a labelled sample everything but furniture is kept.
Repeated rows are extracted alike. Pages are read whole. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from posledger.llm import dom
from posledger.llm.common import text_of
from posledger.sources.tables import stage

#: What tags and attribute tokens say.
FURNITURE_TAGS = frozenset("nav header footer aside form button select dialog menu input svg canvas audio video object "
                           "head link fieldset".split())
MAIN_TAGS = frozenset(("article", "main"))
FURNITURE_TOKENS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside header masthead footer comment comments respond reply discussion disqus cookie cookies "
    "consent gdpr notice notification alert popup modal overlay share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login search pagination pager widget toolbar copyright legal skip "
    "complementary contentinfo form".split())
MAIN_TOKENS = frozenset("article content main post entry story body text".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
MARKS = ".!?…;:,"

TRAIN_PAGES = 300
#: Pages that may label themselves.
LABELLED = r"(?i)<(?:main|article)[\s>]"
TREES = 15
DEPTH = 4
GROUP_CHARS = 1 << 20

FEATURES = (
    "depth", "log_chars", "log_elements", "density", "link_share", "marks_rate", "word_length", "furniture_tag",
    "main_tag", "furniture_tokens", "main_tokens", "in_furniture", "in_main", "holds_main", "furniture_share", "paragraph",
    "heading", "item", "siblings", "sibling_place", "sibling_size", "page_share")


class Trees(NamedTuple):
    """Boosted trees as arrays; a leaf leads to itself."""

    weights: list[float]
    feature: list[np.ndarray]
    threshold: list[np.ndarray]
    left: list[np.ndarray]
    right: list[np.ndarray]
    value: list[np.ndarray]

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin, rows = np.zeros(len(x)), np.arange(len(x))
        for weight, feature, threshold, left, right, value in zip(*self):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH + 1):
                at = np.where(x[rows, feature[at]] <= threshold[at], left[at], right[at])
            margin += weight * value[at]
        return 1 / (1 + np.exp(-2 * margin))


class Elements(NamedTuple):
    """The elements of several pages, numbered through; levels has the numbers by depth."""

    parent: np.ndarray
    levels: list[np.ndarray]
    features: np.ndarray
    furniture: np.ndarray
    starts: list[int]


# features -----------------------------------------------------------------------------------------------------

def elements_of(pages: list[dom.Page], hide_main: bool = False) -> Elements:
    starts, n = [], 0
    for page in pages:
        starts.append(n)
        n += len(page.tags)
    parent = np.concatenate([np.array(p.parents) + s for p, s in zip(pages, starts)])
    parent[starts] = starts
    depth = np.concatenate([p.depths for p in pages])
    tags = [t for p in pages for t in p.tags]
    main_names = frozenset() if hide_main else MAIN_TAGS
    flag = lambda names: np.array([t in names for t in tags], float)
    hits = lambda names: np.array([sum(t in names for t in ts) for p in pages for ts in p.tokens], float)
    furniture_tag, main_tag = flag(FURNITURE_TAGS), flag(main_names)
    furniture_tokens, main_tokens = hits(FURNITURE_TOKENS), hits(MAIN_TOKENS)
    chars, linked, marks, words = (np.zeros(n) for _ in range(4))
    for page, start in zip(pages, starts):
        for _, element, link, text in page.pieces:
            size = len(text) - text.count(" ")
            chars[start + element] += size
            linked[start + element] += size * link
            marks[start + element] += sum(map(text.count, MARKS))
            words[start + element] += text.count(" ") + 1
    count = np.ones(n)
    own_furniture = ((furniture_tag > 0) | (furniture_tokens > 0)) & (main_tag == 0)
    furniture_chars, holds_main = np.zeros(n), main_tag.copy()
    own_children = np.zeros(n)
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
    for level in reversed(levels[1:]):
        furniture_chars[level] = np.where(own_furniture[level], chars[level], furniture_chars[level])
        for total in (chars, linked, marks, words, count, furniture_chars):
            np.add.at(total, parent[level], total[level])
        np.maximum.at(holds_main, parent[level], holds_main[level])
        np.add.at(own_children, parent[level], 1)
    in_furniture, in_main = own_furniture.astype(float), main_tag.copy()
    place, seen, largest = np.zeros(n), np.zeros(n), np.zeros(n)
    for level in levels[1:]:
        in_furniture[level] = np.maximum(in_furniture[level], in_furniture[parent[level]])
        in_main[level] = np.maximum(in_main[level], in_main[parent[level]])
        np.maximum.at(largest, parent[level], chars[level])
    for i, p in enumerate(parent):
        place[i] = seen[p]
        seen[p] += 1
    page_chars = np.repeat(chars[starts], [len(p.tags) for p in pages])
    some = np.maximum(chars, 1)
    columns = {
        "depth": depth, "log_chars": np.log1p(chars), "log_elements": np.log(count), "density": chars / count,
        "link_share": linked / some, "marks_rate": marks / np.maximum(words, 1), "word_length": chars / np.maximum(words, 1),
        "furniture_tag": furniture_tag, "main_tag": main_tag, "furniture_tokens": furniture_tokens,
        "main_tokens": main_tokens, "in_furniture": in_furniture, "in_main": in_main, "holds_main": holds_main,
        "furniture_share": furniture_chars / some, "paragraph": flag(frozenset(("p", "pre", "blockquote"))),
        "heading": flag(HEADINGS), "item": flag(frozenset(("li", "td", "th", "dt", "dd"))),
        "siblings": own_children[parent], "sibling_place": place / np.maximum(own_children[parent], 1),
        "sibling_size": chars / np.maximum(largest[parent], 1), "page_share": chars / np.maximum(page_chars, 1)}
    return Elements(parent, levels, np.column_stack([columns[f] for f in FEATURES]), own_furniture, starts)


def weak_labels(elements: Elements) -> np.ndarray:
    """What the page's own markup says: within or around a main element and not within furniture."""
    at = FEATURES.index
    x = elements.features
    return ((x[:, at("in_main")] > 0) | (x[:, at("holds_main")] > 0)) & (x[:, at("in_furniture")] == 0)


# training -----------------------------------------------------------------------------------------------------

@arrow_udf(T.ArrayType(T.StructType([
    T.StructField("label", T.DoubleType()), T.StructField("x", T.ArrayType(T.DoubleType()))])))
def _labelled(sources: pa.Array) -> pa.Array:
    out = []
    for source in sources:
        pages = [dom.read(source.as_py())]
        seen, hidden = elements_of(pages), elements_of(pages, hide_main=True)
        label = weak_labels(seen)
        rows = []
        if label[seen.features[:, FEATURES.index("in_main")] > 0].any():
            rows = [{"label": float(y), "x": x.tolist()} for e in (seen, hidden) for y, x in zip(label, e.features)]
        out.append(rows)
    return pa.array(out, pa.list_(pa.struct([("label", pa.float64()), ("x", pa.list_(pa.float64()))])))


def _exported(model) -> Trees:
    """The arrays of an MLlib model."""
    parts: list[list] = [[] for _ in range(5)]
    for tree in model.trees:
        feature, threshold, left, right, value = [], [], [], [], []

        def walk(node) -> int:
            nr = len(value)
            inner = node.getClass().getSimpleName() == "InternalNode"
            feature.append(node.split().featureIndex() if inner else 0)
            threshold.append(node.split().threshold() if inner else 0.0)
            left.append(nr), right.append(nr), value.append(node.prediction())
            if inner:
                left[nr], right[nr] = walk(node.leftChild()), walk(node.rightChild())
            return nr

        walk(tree._call_java("rootNode"))
        for part, made in zip(parts, (feature, threshold, left, right, value)):
            part.append(np.array(made))
    return Trees(list(model.treeWeights), *parts)


def train(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          sample: int = TRAIN_PAGES) -> Trees | None:
    """Boosted trees from a bounded sample of the pages that label themselves; None if there are none.

    Pages without an article or main element give no labels and never take a place in the sample; of pages with equal
    html one counts. The sample's keys are ``sample`` hashes at most, which bounds what is broadcast.
    """
    labelled = pages.select(text_of(html).alias("html")).where(F.col("html").rlike(LABELLED)).withColumn("key", F.xxhash64("html"))
    keys = stage(labelled.select("key").distinct().orderBy("key").limit(sample), "dom-sample")
    chosen = labelled.join(F.broadcast(keys), "key").dropDuplicates(["key"]).select("html")
    nodes = chosen.select(F.explode(_labelled(F.col("html"))).alias("n"))
    nodes = stage(nodes.select(F.col("n.label").alias("label"), F.col("n.x").alias("x")), "dom-training")
    if nodes.select("label").distinct().count() < 2:
        return None
    rows = nodes.select("label", array_to_vector("x").alias("features")).coalesce(2)
    return _exported(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(rows))


# decoding -----------------------------------------------------------------------------------------------------

def decode(elements: Elements, probability: np.ndarray) -> np.ndarray:
    """Whether each element is kept: the most likely labelling in which what is below a dropped one is dropped."""
    p = np.clip(probability, 1e-6, 1 - 1e-6)
    keep, drop = np.log(p), np.log(1 - p)
    for level in reversed(elements.levels):
        kept_wins = keep[level] >= drop[level]
        if level is not elements.levels[0]:
            np.add.at(keep, elements.parent[level], np.where(kept_wins, keep[level], drop[level]))
            np.add.at(drop, elements.parent[level], drop[level])
    kept = keep >= drop
    for level in elements.levels[1:]:
        kept[level] &= kept[elements.parent[level]]
    return kept


def extract_pages(sources: list[str], trees: Trees | None) -> list[str]:
    pages = [dom.read(s) for s in sources]
    if not pages:
        return []
    elements = elements_of(pages)
    if trees is None:
        chance = np.where(elements.furniture, 0.0, 1.0)
    else:
        chance = trees.probability(elements.features)
    kept = decode(elements, chance)
    return [dom.joined(page, kept[start:start + len(page.tags)]) for page, start in zip(pages, elements.starts)]


def _groups(sources: pa.Array) -> Iterator[list[str]]:
    group, size = [], 0
    for source in sources:
        group.append(source.as_py())
        size += len(group[-1])
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


def main_text(html: Column, trees: Trees | None) -> Column:
    @arrow_udf(T.StringType())
    def extract(sources: pa.Array) -> pa.Array:
        return pa.array([text for group in _groups(sources) for text in extract_pages(group, trees)], pa.string())

    return extract(text_of(html))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text."""
    trees = train(pages, page_id, url, html)
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                        main_text(F.col(html), trees).alias("text"))
