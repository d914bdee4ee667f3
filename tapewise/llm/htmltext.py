"""Main text of HTML pages: a linear-chain conditional random field over leaf blocks.

A page becomes its leaf blocks (text between block-level tags) with features
of their ancestor tags and names and of their text.  The field is trained on
labelled pages and decoded by Viterbi; the text is the blocks labelled as
content, in page order, joined by line ends.

Labelled pages are made from the table itself: the paragraphs, menus and
notices of at most ``SAMPLE_PAGES`` pages (chosen by a hash of the url) are set
into varied page layouts (``layouts``), in which every block's label is known
by construction.  Nothing else is learned from, and every page of the table is
then decoded whole.

Nulls: a null or empty page has the text "" and 0 characters; null ids and
urls are carried.  Repeated rows are decoded each.  An empty table gives no
rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewise.llm import crf, layouts
from tapewise.llm.blocks import features, leaf_blocks
from tapewise.llm.common import by_value, text_or_empty

SAMPLE_PAGES = 300


def training_pages(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, seed: int = 5) -> list:
    """(features, labels) of labelled pages set from a bounded sample of the table's texts."""
    html = pages.select(F.xxhash64(F.lit(seed), "url", "html").alias("h"), F.substring(text_or_empty("html"), 1, 20_000).alias("html"))
    sample = [r["html"] for r in html.orderBy("h", "html").limit(sample_pages).collect()]
    texts = [[b.text for b in leaf_blocks(s)] for s in sample]
    made = layouts.labelled_pages([t for t in texts if t], seed)
    out = []
    for page, labels in made:
        blocks = leaf_blocks(page)
        if len(blocks) != len(labels):
            raise ValueError("a layout's labels do not match its blocks")
        out.append((features(blocks), labels))
    return out


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> crf.Chain:
    return crf.train(training_pages(pages, sample_pages))


def main_text(page: str, chain: crf.Chain) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, chain.decode(features(blocks))) if y)


def _extract(batches, chain: crf.Chain):
    for batch in batches:
        texts = [main_text(x.as_py(), chain) if len(x.as_py()) else "" for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                         names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, chain: crf.Chain) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"))
    return rows.mapInArrow(lambda b: _extract(b, chain), "page_id long, url string, text string, n_chars long")


by_value(__name__)
