"""Benchmark decontamination by greedy string tiling.

Texts are read as lower-cased words without punctuation.  Karp-Rabin hashes of
every run of ``SEED`` words are the shared-token seeds: a document's seeds meet
the benchmark's in a join, and a match of any length of at least ``SEED``
words shows as a diagonal of seed hits.  For each (document, item) pair the
longest match that touches no marked word is marked, again and again, so
passages are found in whatever order their parts come.  An item whose marked
words reach ``COVERAGE`` of its length contaminates the document.

A fixed-size bit table of the benchmark's seeds drops most document seeds
before the shuffle; it only saves work, at any benchmark size.

Edge cases: null or empty texts, and items under ``SEED`` words, match
nothing; rows that repeat an id count as one document or item; empty tables
give no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import save, table

SEED = 5
COVERAGE = 0.5
FILTER_BITS = 1 << 22


def _seeds(rows: DataFrame, key: str, size: int, packed: Broadcast | None = None) -> DataFrame:
    """``key, seed, place`` of every run of ``size`` words (whose bit is set); ``n_words`` of the text."""
    schema = f"{key} long, seed long, place int, n_words int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if packed is None else np.unpackbits(packed.value).astype(bool)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for at, _, w in tokens.words_of(batch.column(1), tokens.IS_LETTER_WORD, tokens.LOWER):
                h, place = tokens.windows(w.hash, w.first, size)
                if bits is not None:
                    ok = bits[h & np.uint64(FILTER_BITS - 1)]
                    h, place = h[ok], place[ok]
                text = np.searchsorted(w.first, place, "right") - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[at + text].astype(np.int64)), pa.array(h.view(np.int64)),
                    pa.array((place - w.first[text]).astype(np.int32)),
                    pa.array(np.diff(w.first)[text].astype(np.int32))], [key, "seed", "place", "n_words"])

    known = rows.select(rows[key].cast("long").alias(key), rows["text"].alias("text")).filter(F.col(key).isNotNull())
    return known.mapInArrow(run, schema)


def tile(doc: np.ndarray, item: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seed hits (places in the document and the item): (doc, item, words) of each tile.

    Longest first; ties go to the smallest place in the item, then in the document.
    """
    order = np.lexsort((doc, doc - item))
    doc, item = doc[order], item[order]
    cut = np.flatnonzero((np.diff(doc - item) != 0) | (np.diff(doc) != 1)) + 1
    heap = []
    for a, b in zip([0, *cut], [*cut, len(doc)], strict=True):
        heap.append((-(b - a + size - 1), int(item[a]), int(doc[a])))
    heapq.heapify(heap)
    in_doc: set[int] = set()
    in_item: set[int] = set()
    tiles = []
    while heap:
        n, q, p = heapq.heappop(heap)
        n = -n
        free = [p + k not in in_doc and q + k not in in_item for k in range(n)]
        if all(free):
            tiles.append((p, q, n))
            in_doc.update(range(p, p + n))
            in_item.update(range(q, q + n))
            continue
        k = 0
        while k < n:  # what is left of it between marked words competes again
            if not free[k]:
                k += 1
                continue
            end = k
            while end < n and free[end]:
                end += 1
            if end - k >= size:
                heapq.heappush(heap, (-(end - k), q + k, p + k))
            k = end
    return tiles


def matches(docs: DataFrame, benchmark: DataFrame, size: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """``doc_id, item_id, n_words, n_covered, n_tiles, longest, coverage`` of each contaminated pair."""
    spark = docs.sparkSession
    bench = save(_seeds(benchmark, "item_id", size).dropDuplicates(["item_id", "seed", "place"]))
    # bounded: at most FILTER_BITS numbers reach the driver, whatever the benchmark's size
    found = bench.select(F.col("seed").bitwiseAND(FILTER_BITS - 1).alias("bit")).distinct().toArrow()
    bits = np.zeros(FILTER_BITS, bool)
    bits[found.column("bit").to_numpy()] = True
    packed = spark.sparkContext.broadcast(np.packbits(bits))

    left = _seeds(docs, "doc_id", size, packed).select("doc_id", "seed", F.col("place").alias("p"))
    right = bench.select("item_id", "seed", F.col("place").alias("q"), "n_words")
    pairs = left.join(right, "seed").select("doc_id", "item_id", "n_words", "p", "q")
    schema = "doc_id long, item_id long, n_words long, n_covered long, n_tiles long, longest long, coverage double"

    def cover(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["p", "q"])
        n = int(pdf["n_words"].max())
        if pdf["q"].nunique() * size >= coverage * n:  # else even tiles of one seed each could not reach it
            tiles = tile(pdf["p"].to_numpy(), pdf["q"].to_numpy(), size)
            total = sum(x[2] for x in tiles)
            if total >= coverage * n:
                return pd.DataFrame([(pdf["doc_id"].iloc[0], pdf["item_id"].iloc[0], n, total, len(tiles),
                                      max(x[2] for x in tiles), total / n)], columns=[
                    "doc_id", "item_id", "n_words", "n_covered", "n_tiles", "longest", "coverage"])
        return pd.DataFrame({"doc_id": pd.Series(dtype="int64"), "item_id": pd.Series(dtype="int64"),
                             "n_words": pd.Series(dtype="int64"), "n_covered": pd.Series(dtype="int64"),
                             "n_tiles": pd.Series(dtype="int64"), "longest": pd.Series(dtype="int64"),
                             "coverage": pd.Series(dtype="float64")})

    return pairs.groupBy("doc_id", "item_id").applyInPandas(cover, schema)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    bad = save(matches(docs, benchmark).select("doc_id").distinct())
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)


def op4_benchmark_overlap(spark, sf_dir):
    """Registered query: every contaminated (document, item) pair."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
