"""Main text of web pages by a recurrent block labeller."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daystream.llm import block_lstm as L
from daystream.llm.html_blocks import Block, blocks
from daystream.llm.page_makes import MARK, Maker

#: Pages whose texts fill the training pages, and training pages, at most.
SAMPLE, MADE = 200, 900


def fit(pool: list[str], made: int = MADE, seed: int = 5):
    """Weights of the labeller, trained on ``made`` pages filled with the texts of ``pool``."""
    maker = Maker(pool or ["lorem ipsum dolor sit amet consectetur adipiscing elit"], seed)
    x, y = [], []
    for _ in range(made):
        page = blocks(maker.page())
        if not page:
            continue
        y.append(np.array([MARK in b.text for b in page], np.float32))
        clean = [Block(b.text.replace(MARK, "") or "-", b.path, b.linked) for b in page]
        x.append(L.inputs(clean))
    return L.train(x, y)


def pool_of(pages: DataFrame, sample: int = SAMPLE) -> list[str]:
    """Texts to fill training pages with: the blocks of a bounded sample of pages, chosen by a hash of the page."""
    rows = pages.select(F.xxhash64("html").alias("h"), F.col("html").cast("string").alias("html")).filter("length(html) > 0")
    # the smallest hashes first, without the pages; then one page of each
    low = rows.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    rows = rows.filter(F.col("h") <= F.lit(low)).groupBy("h").agg(F.first("html").alias("html"))
    return sorted({b.text for r in rows.collect() for b in blocks(r["html"]) if len(b.text) > 20})


def extract(pages: DataFrame, threshold: float = 0.5, sample: int = SAMPLE, model=None) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A page is cut into its blocks; a bidirectional LSTM reads, for each, the
    hashed parts of its tag path, hashed words and a few measures, and labels
    all of them with the whole page as context. Blocks from ``threshold`` on
    are joined by a line feed, in page order. n_chars counts code points.

    The labeller (``model``, or :func:`fit`) is trained on made-up pages whose
    main text is known, filled with the texts of at most ``sample`` pages; its
    weights are about 100 KB. Null and empty pages, and pages without a block,
    give an empty text. Repeated rows and null ids or urls are kept as they are;
    other columns are not read. An empty table gives an empty result. The
    memory of a task follows its longest page.
    """
    w = model if model is not None else fit(pool_of(pages, sample))

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                parsed = [blocks(h) for h in part.column("html").to_pylist()]
                p = L.predict(w, [L.inputs(x) for x in parsed])
                text = ["\n".join(x.text for x, q in zip(page, prob) if q >= threshold) for page, prob in zip(parsed, p)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(text, pa.string()),
                                                  pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_extract(spark, sf_dir: str) -> DataFrame:
    from daystream.session import read_table
    return extract(read_table(spark, sf_dir, "pages"))
