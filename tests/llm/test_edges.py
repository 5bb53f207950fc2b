"""Nulls, empty and very long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import os
import sys

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(__file__))
from test_text_oracle import duck, longs, same  # noqa: E402

from keyflow.llm import (align, decontaminate, html_text, licenses, line_dedup, lm_score, near_dup, packing, quality,  # noqa: E402
                         spelling, substring_dedup, toxicity, word_bpe)
from keyflow.llm.common import save  # noqa: E402

PROSE = " ".join(f"w{i % 97}x{i}" for i in range(60))
LONG = " ".join(f"long{i % 5000}" for i in range(30_000))
TEXTS = [None, "", "   \n\t ", "word", "two words", PROSE, PROSE, PROSE + " tail", "a " * 200, LONG,
         "line one of four words here\nline one of four words here\nsomething else\n",
         "Released under the MIT License and the mit license.", "é ü 日本語 words\x0bwith\x0cspaces\r\n#*$"]
#: names that operators use for columns of their own
CLASHES = ("id", "n", "w", "h", "key", "rank", "row", "tokens", "lines", "token", "votes", "kept", "length", "x", "y", "a")
SCHEMA = "doc_id long, text string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)


def frame(spark, rows):
    full = [(i, t, len(t) if t else 0, *CLASHES) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, list(enumerate(TEXTS)))


@pytest.fixture(scope="module")
def plain():
    return pd.DataFrame({"doc_id": range(len(TEXTS)), "text": pd.array(TEXTS, dtype="string")})


def packed(d):
    return packing.pack(d, packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("byte_bpe_50k.tiktoken"))


def tox(d):
    labels = d.sparkSession.createDataFrame([(1, 1, 1), (5, 1, None), (None, 1, 1), (6, 0, 0), (6, 0, 1)],
                                            "doc_id long, quality int, toxic int")
    return toxicity.score(d, *toxicity.train(d, labels))


def overlap(d):
    bench = d.sparkSession.createDataFrame([(0, PROSE[:200]), (1, None), (2, ""), (3, "word")], "item_id long, text string")
    return decontaminate.matches(d, bench)


def aligned(d):
    paths = [packing.tokenizer_path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")]
    return align.weigh(save(align.align(d, *paths)), align.pair(*paths))


OPERATORS = {
    "licenses": licenses.scan, "quality": quality.score_quality, "lines": line_dedup.removed_lines,
    "overlap": overlap, "packing": packed, "toxicity": tox, "substrings": substring_dedup.remove_repeats,
    "near": near_dup.near_duplicates, "lm": lm_score.score, "alignment": aligned,
    "word bpe": lambda d: word_bpe.digests(d, packing.tokenizer_path("word_bpe_49k.json")), "spelling": spelling.variants,
}
PER_ROW = ("licenses", "quality", "toxicity", "substrings", "near", "lm", "alignment", "word bpe")


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](frame(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_repeated_rows_and_null_ids(spark, docs, name):
    twice = docs.union(docs).union(frame(spark, [(None, PROSE), (None, None)]))
    out = OPERATORS[name](twice).toPandas()
    if name in PER_ROW:
        assert len(out) == 2 * len(TEXTS) + 2
        ids = out[out["doc_id"].notna()].sort_values("doc_id")
        assert (ids.groupby("doc_id").size() == 2).all()


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_all_null(spark, name):
    out = OPERATORS[name](frame(spark, [(None, None)] * 3)).toPandas()
    assert len(out) == (3 if name in (*PER_ROW, "packing") else 0)


def test_stages_keep_the_columns(spark, docs):
    bench = spark.createDataFrame([(0, PROSE[:200])], "item_id long, text string")
    for f in (quality.keep_good, line_dedup.remove_lines, near_dup.keep_one, lambda d: decontaminate.remove_contaminated(d, bench)):
        assert f(docs).columns == docs.columns


@pytest.mark.parametrize("operator, sql, columns", [
    (licenses.scan, licenses.oracle(), None),
    (lambda d: quality.score_quality(d), quality.oracle(), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]),
    (lambda d: near_dup.near_duplicates(d, 3, 85), near_dup.oracle(), None),
])
def test_edge_texts_equal_sql(docs, plain, operator, sql, columns):
    got, want = operator(docs).toPandas(), duck(sql, documents=plain)
    columns = columns or list(want.columns)
    assert same(longs(got[columns]), longs(want[columns]))


def test_substring_edges_equal_sql(docs, plain):
    got = substring_dedup.remove_repeats(docs, chunk=500).toPandas()
    want = duck(substring_dedup.oracle(), documents=plain)
    both = got.merge(want, on="doc_id")
    assert (both["n_words_x"] == both["n_words_y"]).all() and (both["n_removed_x"] == both["n_removed_y"]).all()


def test_line_edges_equal_sql(docs, plain):
    got = {r["doc_id"]: ",".join(map(str, r["lines"])) for r in line_dedup.removed_lines(docs).collect()}
    want = duck(line_dedup.oracle(), documents=plain)
    assert got == {r.doc_id: r.removed_lines for r in want.itertuples() if r.removed_lines}


def test_html_edges(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a", "x"), (2, "u", "<p>" + "b " * 200_000, "x")],
                                  "page_id long, url string, html string, text string")
    out = html_text.extract(pages).toPandas()
    assert len(out) == 4 and sorted(out["n_chars"]) == [0, 0, 1, 399_999]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_rows_that_repeat_an_id_are_scored_by_their_own_text(spark, monkeypatch):
    import math
    import zlib
    from collections import Counter
    monkeypatch.setattr(lm_score, "FREQUENT", 5)
    monkeypatch.setattr(lm_score, "VOCABULARY", 5)
    rows = [(i, "a b c d e " * 3 + f"rare{i // 2} zz") for i in range(60)]
    rows += [(100, "zz rare1"), (100, "qq a b c d e"), (None, "rare3 zz"), (100, "zz rare1")]
    train = [t for i, t in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in [*t.split(), None])
    most = sum(counts.values()) + 1 * (len(counts) + 1)

    def base(text):
        words = [*text.split(), None]
        return len(words), sum(counts[w] > 0 for w in words), round(sum(math.log10((counts[w] + 1) / most) for w in words), 6)

    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    told = sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got)
    assert told == sorted((i or -1, *base(t)) for i, t in rows)


def test_rows_that_repeat_an_id_join_their_components(spark):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "red green blue black white")
    rows = [(3, a), (7, a), (7, b), (9, b), (7, ""), (12, c), (12, c), (None, a), (20, c + " x"), (20, None), (2, "")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    told = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0, r["kept"]) for r in got)
    assert told == sorted([(3, 4, 3, True), (7, 4, 3, False), (7, 4, 3, False), (9, 4, 3, False), (7, 0, 7, True), (12, 3, 12, True),
                           (12, 3, 12, True), (0, 4, 0, True), (20, 4, 20, True), (20, 0, 20, True), (2, 0, 2, True)])
