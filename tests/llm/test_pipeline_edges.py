"""The whole pipeline over nulls, empty and blank texts, repeated rows and ids, ties, extra columns and empty tables."""

import os
import sys

import corpus_pipeline
import pandas as pd

sys.path.insert(0, os.path.dirname(__file__))
from test_edges import CLASHES, LONG, SCHEMA, TEXTS  # noqa: E402


def folder(spark, scratch, rows):
    full = [(i, t, len(t) if t else 0, *CLASHES) for i, t in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(os.path.join(scratch, "documents.parquet"))
    bench = [(0, " ".join(f"w{i % 97}x{i}" for i in range(60))), (1, None), (2, "")]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(os.path.join(scratch, "benchmark.parquet"))
    return scratch


def test_pipeline_over_odd_rows(spark, scratch):
    rows = list(enumerate(TEXTS)) + [(3, "word"), (None, None), (None, LONG), (5, "quite another text of the same id " * 4)]
    got = corpus_pipeline.run(spark, folder(spark, scratch, rows)).toPandas()
    # every piece is packed once, its sequence is gapless and within the capacity
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 1024
    ids = set(got["doc_id"].dropna().astype(int))
    assert ids <= {i for i, _ in rows if i is not None}
    assert not ids & {0, 1, 2, 3, 4}  # no words, or fewer than ten: the quality rules drop them


def test_pipeline_over_empty_tables(spark, scratch):
    got = corpus_pipeline.run(spark, folder(spark, scratch, []))
    assert got.count() == 0 and "sequence_id" in got.columns


def test_stages_of_the_pipeline_keep_repeated_rows_apart(spark, scratch):
    """Rows that repeat an id with other text stand or fall by their own text in the quality stage."""
    good = " ".join(f"token{i}" for i in range(40)) + "."
    docs = spark.createDataFrame([(1, good), (1, "short"), (2, good + " more")], "doc_id long, text string")
    kept = corpus_pipeline.quality_rules(spark, docs, scratch).toPandas()
    assert "short" not in set(kept["text"]) and isinstance(kept, pd.DataFrame)
