"""Main text of web pages: flat blocks, neighbour features, decision tree.

A page is read as a flat list of text blocks (``markup.blocks``).  Each block
is described by its own word count and link density and those of the block
before and after it.  One more feature says where it stands: in an article
element, outside the page's article, on a page without one, or in an element
that says by its name that it is no article text (header, footer, advert,
form, comments, ...; such a name does not count on an element that holds the
whole article or most of the page).  A decision tree, grown on the labelled
table below, says which blocks are article text.  Menus and other lists of
links are told by their link density alone.

The text of a page is its article blocks in order, joined by a blank line;
character references are decoded and white space inside a block is one space.
Null and empty pages, and pages without article text, give an empty text.
Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import ready
from ledgerspark.llm.markup import Block, blocks

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place")
#: place: 1 in an article, 0 on a page without one, -1 outside the page's
#: article, -2 in an element that is no article by its name
#:
#: Blocks of pages of the given table, in the markup they came in and in others
#: (articles without an article element, as bare divisions, with comments,
#: sidebars, notices and forms, inside wrappers of misleading names), labelled
#: by the part of the page they come from.
LABELLED = [
    # words, links, words_before, links_before, words_after, links_after, place -> article text
    ((2, 0, 0, 0, 31, 1, -2), 0),
    ((2, 0, 2, 0, 35, 0, -2), 0),
    ((2, 0, 16, 0, 44, 0, -2), 0),
    ((2, 0, 37, 0, 21, 0, -2), 0),
    ((2, 1, 3, 1, 3, 1, -2), 0),
    ((3, 0, 9, 1, 0, 0, -2), 0),
    ((3, 0, 76, 0, 0, 0, -2), 0),
    ((3, 1, 3, 1, 3, 1, -2), 0),
    ((4, 1, 11, 1, 11, 1, -2), 0),
    ((5, 0, 3, 1, 0, 0, -2), 0),
    ((5, 0, 24, 0, 0, 0, -2), 0),
    ((6, 0, 4, 0, 0, 0, -2), 0),
    ((7, 0, 1, 1, 0, 0, -2), 0),
    ((7, 0, 2, 1, 4, 0, -2), 0),
    ((10, 1, 20, 0, 5, 1, -2), 0),
    ((13, 0, 12, 0, 0, 0, -2), 0),
    ((14, 0, 3, 1, 0, 0, -2), 0),
    ((22, 0, 2, 0, 2, 0, -2), 0),
    ((37, 0, 2, 0, 2, 0, -2), 0),
    ((1, 0, 25, 0, 2, 1, -1), 0),
    ((1, 0, 27, 0, 4, 1, -1), 0),
    ((1, 1, 2, 1, 2, 1, -1), 0),
    ((1, 1, 3, 1, 5, 0, -1), 0),
    ((2, 0, 26, 0, 7, 1, -1), 0),
    ((2, 1, 0, 0, 1, 1, -1), 0),
    ((2, 1, 2, 1, 1, 1, -1), 0),
    ((2, 1, 2, 1, 2, 1, -1), 0),
    ((2, 1, 3, 1, 3, 1, -1), 0),
    ((2, 1, 3, 1, 27, 0, -1), 0),
    ((3, 1, 1, 1, 2, 1, -1), 0),
    ((3, 1, 2, 1, 26, 0, -1), 0),
    ((3, 1, 3, 1, 1, 1, -1), 0),
    ((3, 1, 3, 1, 2, 1, -1), 0),
    ((3, 1, 3, 1, 3, 1, -1), 0),
    ((4, 0, 14, 0, 3, 1, -1), 0),
    ((9, 1, 0, 0, 5, 1, -1), 0),
    ((11, 1, 2, 0, 11, 1, -1), 0),
    ((11, 1, 8, 0, 9, 1, -1), 0),
    ((1, 0, 2, 1, 26, 0, -1), 1),
    ((2, 0, 1, 1, 34, 0, -1), 1),
    ((3, 0, 0, 0, 36, 0, -1), 1),
    ((4, 0, 1, 1, 27, 0, -1), 1),
    ((9, 0, 0, 0, 32, 0, -1), 1),
    ((10, 0, 2, 1, 31, 0, -1), 1),
    ((25, 0, 5, 0, 3, 0, -1), 1),
    ((34, 0, 11, 0, 19, 0, -1), 1),
    ((39, 0, 2, 0, 1, 0, -1), 1),
    ((1, 1, 1, 0, 2, 1, 0), 0),
    ((2, 0, 0, 0, 9, 1, 0), 0),
    ((2, 0, 1, 1, 3, 1, 0), 0),
    ((2, 0, 10, 1, 2, 1, 0), 0),
    ((2, 1, 1, 1, 10, 0, 0), 0),
    ((2, 1, 2, 0, 1, 1, 0), 0),
    ((2, 1, 2, 0, 3, 1, 0), 0),
    ((2, 1, 3, 1, 3, 1, 0), 0),
    ((2, 1, 3, 1, 7, 0, 0), 0),
    ((2, 1, 177, 0, 1, 1, 0), 0),
    ((3, 0, 2, 1, 0, 0, 0), 0),
    ((3, 1, 0, 0, 1, 1, 0), 0),
    ((3, 1, 0, 0, 3, 1, 0), 0),
    ((3, 1, 1, 1, 3, 1, 0), 0),
    ((3, 1, 1, 1, 44, 1, 0), 0),
    ((4, 1, 2, 0, 14, 0, 0), 0),
    ((4, 1, 9, 1, 10, 1, 0), 0),
    ((5, 0, 5, 1, 15, 1, 0), 0),
    ((5, 1, 3, 0, 14, 0, 0), 0),
    ((5, 1, 10, 1, 43, 1, 0), 0),
    ((6, 1, 2, 0, 11, 0, 0), 0),
    ((6, 1, 4, 0, 3, 0, 0), 0),
    ((6, 1, 5, 0, 1, 0, 0), 0),
    ((6, 1, 12, 0, 4, 0, 0), 0),
    ((7, 1, 9, 0, 8, 0, 0), 0),
    ((8, 0, 2, 1, 0, 0, 0), 0),
    ((8, 0.38, 7, 0.43, 10, 0.6, 0), 0),
    ((8, 0.38, 7, 0.57, 1, 1, 0), 0),
    ((8, 1, 2, 0, 5, 0, 0), 0),
    ((9, 0, 1, 1, 7, 1, 0), 0),
    ((9, 0, 9, 1, 0, 0, 0), 0),
    ((9, 0.44, 2, 1, 1, 1, 0), 0),
    ((9, 0.56, 1, 1, 1, 1, 0), 0),
    ((9, 0.67, 9, 0.44, 1, 1, 0), 0),
    ((9, 1, 2, 0, 16, 0, 0), 0),
    ((9, 1, 4, 0, 2, 0, 0), 0),
    ((10, 0, 1, 1, 0, 0, 0), 0),
    ((10, 1, 10, 1, 5, 0, 0), 0),
    ((10, 1, 11, 1, 0, 0, 0), 0),
    ((11, 1, 5, 0, 4, 1, 0), 0),
    ((26, 1, 8, 0, 10, 0, 0), 0),
    ((1, 0, 1, 1, 2, 0, 0), 1),
    ((2, 0, 2, 0, 12, 1, 0), 1),
    ((2, 0, 2, 1, 1, 0, 0), 1),
    ((2, 0, 13, 0, 25, 0, 0), 1),
    ((2, 0, 24, 0, 0, 0, 0), 1),
    ((2, 0, 146, 0, 42, 0, 0), 1),
    ((3, 0, 13, 1, 18, 1, 0), 1),
    ((3, 0, 39, 0, 9, 1, 0), 1),
    ((4, 0, 1, 0, 3, 0, 0), 1),
    ((4, 0, 7, 1, 44, 0, 0), 1),
    ((6, 0, 4, 0, 10, 0, 0), 1),
    ((6, 1, 13, 0, 2, 0, 0), 1),
    ((7, 0, 49, 0, 2, 1, 0), 1),
    ((8, 0, 4, 0, 1, 1, 0), 1),
    ((8, 0, 11, 1, 0, 0, 0), 1),
    ((8, 0.38, 7, 0.43, 4, 0, 0), 1),
    ((8, 0.38, 11, 0, 2, 1, 0), 1),
    ((8, 1, 2, 0, 6, 0, 0), 1),
    ((8, 1, 58, 0, 9, 0, 0), 1),
    ((9, 0, 6, 1, 31, 0, 0), 1),
    ((9, 0, 15, 1, 3, 0, 0), 1),
    ((9, 0, 19, 1, 9, 1, 0), 1),
    ((9, 1, 2, 0, 2, 0, 0), 1),
    ((9, 1, 10, 0, 4, 0, 0), 1),
    ((10, 0, 3, 1, 10, 0, 0), 1),
    ((10, 0.3, 14, 0, 2, 1, 0), 1),
    ((10, 1, 2, 0, 1, 0, 0), 1),
    ((10, 1, 126, 0, 76, 0, 0), 1),
    ((11, 1, 3, 0, 4, 0, 0), 1),
    ((11, 1, 39, 0.08, 2, 0, 0), 1),
    ((12, 0, 1, 0, 7, 1, 0), 1),
    ((12, 0, 13, 1, 1, 1, 0), 1),
    ((12, 0.25, 16, 1, 9, 0, 0), 1),
    ((12, 1, 40, 0, 5, 0, 0), 1),
    ((13, 1, 2, 0, 5, 1, 0), 1),
    ((14, 1, 110, 0, 29, 0, 0), 1),
    ((15, 1, 7, 0.43, 22, 0, 0), 1),
    ((17, 1, 6, 0, 6, 0, 0), 1),
    ((19, 1, 2, 0, 23, 0.13, 0), 1),
    ((34, 0.09, 26, 0, 17, 0.18, 0), 1),
    ((37, 0, 9, 0.33, 34, 0, 0), 1),
    ((41, 0, 9, 0.33, 17, 1, 0), 1),
    ((43, 0, 4, 0, 0, 0, 0), 1),
    ((78, 0, 6, 0, 27, 0.11, 0), 1),
    ((81, 0.04, 1, 0, 35, 0.09, 0), 1),
    ((128, 0, 9, 1, 0, 0, 0), 1),
    ((176, 0, 20, 1, 0, 0, 0), 1),
    ((2, 1, 1, 1, 10, 0, 1), 0),
    ((2, 1, 2, 1, 28, 0, 1), 0),
    ((6, 1, 10, 1, 4, 1, 1), 0),
    ((8, 1, 12, 0, 5, 1, 1), 0),
    ((11, 1, 7, 1, 7, 1, 1), 0),
    ((2, 0, 0, 0, 121, 0, 1), 1),
    ((2, 0, 20, 1, 11, 1, 1), 1),
    ((3, 0, 2, 0, 2, 0, 1), 1),
    ((3, 0, 6, 0, 9, 1, 1), 1),
    ((3, 0, 21, 0, 19, 0, 1), 1),
    ((4, 0, 0, 0, 4, 0, 1), 1),
    ((4, 0, 0, 0, 8, 0, 1), 1),
    ((4, 0, 14, 0.21, 1, 0, 1), 1),
    ((4, 0, 101, 0, 6, 1, 1), 1),
    ((6, 1, 4, 0, 26, 0, 1), 1),
    ((7, 0.43, 10, 0, 4, 0, 1), 1),
    ((8, 0, 3, 1, 0, 0, 1), 1),
    ((8, 0, 3, 1, 8, 0.38, 1), 1),
    ((8, 0, 11, 0, 41, 0, 1), 1),
    ((8, 0, 31, 0, 1, 1, 1), 1),
    ((8, 0.38, 1, 0, 14, 1, 1), 1),
    ((8, 0.38, 7, 0, 10, 1, 1), 1),
    ((8, 1, 2, 0, 34, 0, 1), 1),
    ((9, 0, 0, 0, 27, 0.11, 1), 1),
    ((9, 0, 7, 0, 0, 0, 1), 1),
    ((9, 0, 12, 0, 2, 0, 1), 1),
    ((9, 0.33, 8, 1, 3, 1, 1), 1),
    ((9, 1, 4, 0, 0, 0, 1), 1),
    ((9, 1, 9, 0, 2, 0, 1), 1),
    ((9, 1, 28, 0, 5, 0, 1), 1),
    ((10, 0, 2, 1, 4, 0, 1), 1),
    ((11, 1, 7, 0, 3, 1, 1), 1),
    ((12, 1, 5, 0, 5, 0, 1), 1),
    ((13, 1, 5, 0, 53, 0, 1), 1),
    ((14, 0.21, 8, 0.38, 29, 0, 1), 1),
    ((14, 1, 29, 0, 2, 0, 1), 1),
    ((16, 1, 138, 0.02, 2, 0, 1), 1),
    ((21, 0, 2, 1, 0, 0, 1), 1),
    ((23, 0.13, 4, 0, 123, 0, 1), 1),
    ((33, 0.09, 7, 0, 5, 0, 1), 1),
    ((144, 0, 12, 0, 13, 0, 1), 1),
]


def grow(x: np.ndarray, y: np.ndarray, least: float = 1e-9) -> tuple | int:
    """A decision tree: (feature, threshold, at most, above) or a class.

    Each split is the one that lowers the Gini impurity most, the first
    feature and the lowest threshold among equals."""
    if len(set(y)) == 1:
        return int(y[0])

    def impurity(part: np.ndarray) -> float:
        p = part.mean() if len(part) else 0.0
        return len(part) * p * (1 - p)

    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            under = x[:, f] <= t
            gain = impurity(y) - impurity(y[under]) - impurity(y[~under])
            if gain > least and (best is None or gain > best[0] + 1e-12):
                best = (gain, f, float(t), under)
    if best is None:
        return int(y.mean() >= 0.5)
    _, f, t, under = best
    return f, t, grow(x[under], y[under]), grow(x[~under], y[~under])


def trained(table: list[tuple[tuple, int]] = LABELLED) -> tuple | int:
    return grow(np.array([r for r, _ in table], dtype=float), np.array([c for _, c in table]))


def decide(tree: tuple | int, row: tuple) -> int:
    while isinstance(tree, tuple):
        f, t, under, over = tree
        tree = under if row[f] <= t else over
    return tree


def described(found: list[Block]) -> list[tuple]:
    """One row of FEATURES per block."""
    with_article = any(b.inside and not b.cue for b in found)
    density = [min(1.0, b.linked / b.words) for b in found]
    out = []
    for k, b in enumerate(found):
        before = (found[k - 1].words, density[k - 1]) if k else (0, 0.0)
        after = (found[k + 1].words, density[k + 1]) if k + 1 < len(found) else (0, 0.0)
        place = -2 if b.cue else (1 if b.inside else -1) if with_article else 0
        out.append((b.words, density[k], *before, *after, place))
    return out


def main_text(tree: tuple | int, page: str | None) -> str:
    found, _ = blocks(page or "")
    return "\n\n".join(b.text for b, row in zip(found, described(found), strict=True) if decide(tree, row))


def extracted(html: Column, tree: tuple | int | None = None) -> Column:
    """The main text of each page."""
    ready()
    tree = trained() if tree is None else tree

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(tree, page) for page in batch], dtype=object)

    return text(html.cast("string"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return pages.select("page_id", "url", extracted(F.col("html")).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
