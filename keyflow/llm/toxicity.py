"""Toxicity: a counterfactual-regularised linear classifier of whole texts.

A logistic regression over the words of a text and their first letters.  Every labelled text that
names an identity group is paired with its counterfactual, the same text with
the group's terms swapped; the loss adds the squared difference of both
scores, so a group's mere mention moves the score as little as possible.

The classifier is fitted on at most ``MAX_ROWS`` labelled rows (those of the
smallest hashed ids), which bounds what the driver holds; every row of the
table is scored on its whole text.  Only the text makes the score: labels,
language, source and id are no inputs.

Edge cases: null and empty texts have no words and get the score of the bias;
rows without a label, or held out, take no part in training; a row with
several labels counts as toxic if one says so; without any labelled row the
score is the smoothed prior; repeated rows are scored one by one; a score of
exactly one half counts as toxic; texts of any length are scored whole; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: labelled rows used at most, words kept at most, texts a word must stand in, and standard
#: deviations by which its toxic share must differ from the mean
MAX_ROWS, MAX_WORDS, LEAST_TEXTS, LEAST_SURE = 40_000, 4_000, 5, 5.0
#: lengths of word beginnings that are features besides the words, so that inflected forms share one
STEMS = (5, 6, 7)
FOLDS, HELD_OUT = 5, 0
RIDGE, FAIRNESS, STEPS, RATE = 1e-4, 1.0, 400, 0.1

#: fixed values: terms swapped with each other, group by group and in the order given
IDENTITY_TERMS = [
    ("women", "men"), ("woman", "man"), ("girl", "boy"), ("girls", "boys"), ("female", "male"), ("mother", "father"),
    ("muslim", "christian"), ("muslims", "christians"), ("islam", "christianity"), ("jewish", "hindu"), ("jews", "hindus"),
    ("black", "white"), ("african", "european"), ("asian", "american"), ("latino", "anglo"), ("mexican", "canadian"),
    ("gay", "straight"), ("lesbian", "heterosexual"), ("homosexual", "bisexual"), ("transgender", "cisgender"),
    ("immigrant", "citizen"), ("immigrants", "citizens"), ("refugee", "resident"), ("refugees", "residents"),
    ("blind", "sighted"), ("deaf", "hearing"), ("disabled", "able"), ("old", "young"), ("elderly", "youthful"),
]
SWAP = {a: b for pair in IDENTITY_TERMS for a, b in (pair, pair[::-1])}

NO_LETTER = "[\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
WORD = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT


def _stems(words: str, size: int) -> Column:
    long = F.filter(words, lambda w: F.length(w) >= size)
    return F.transform(long, lambda w: F.concat(F.substring(w, 1, size), F.lit("*")))


def _features(words: str) -> Column:
    return F.array_distinct(F.concat(words, *[_stems(words, k) for k in STEMS]))


def _swapped(words: str) -> Column:
    """The words with the identity terms swapped; null where they name no group."""
    terms = F.array(*[F.lit(w) for w in SWAP])
    others = F.create_map(*[F.lit(w) for pair in SWAP.items() for w in pair])
    named = F.array_intersect(words, terms)
    other = F.array_union(F.array_except(words, terms), F.transform(named, lambda w: F.element_at(others, w)))
    return F.when(F.size(named) > 0, other)


def training_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, toxic, words, other`` of at most ``max_rows`` labelled rows outside the held-out fold.

    ``words`` are the distinct words and their beginnings; ``other`` those of the
    counterfactual, null where the text names no group.
    """
    known = labels.select(labels["doc_id"].alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # bounded, so broadcast is safe
    texts = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    words = F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), NO_LETTER)), "")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", words.alias("words"))
    rows = rows.withColumn("other", _swapped("words"))
    return rows.select("doc_id", "toxic", _features("words").alias("words"), _features("other").alias("other"))


def vocabulary(sample: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST_TEXTS) -> dict[str, int]:
    """The words whose share among toxic texts differs most surely from their share elsewhere; all identity terms."""
    n = sample.agg(F.sum("toxic").alias("pos"), F.count("*").alias("n")).first()
    pos, total = n["pos"] or 0, n["n"]
    seen = sample.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("p"), F.count("*").alias("n")).filter(F.col("n") >= least)
    share = F.lit(pos / total if total else 0.0)
    surely = F.abs(F.col("p") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share) + 1e-9)
    top = seen.filter(surely >= LEAST_SURE).orderBy(surely.desc(), "word").limit(max_words).collect()  # bounded by max_words
    return {w: i for i, w in enumerate(sorted({r["word"] for r in top} | set(SWAP)))}


def fit(rows: list[list[int]], swapped: list[list[int]], y: np.ndarray, n_words: int, ridge: float = RIDGE,
        fairness: float = FAIRNESS, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias.  ``swapped`` is the counterfactual of each row (the row itself if it names no group)."""
    n, pos = len(rows), float(y.sum())
    bias = math.log((pos + 0.5) / (n - pos + 1.5))
    w = np.zeros(n_words)
    if not n:
        return w, bias

    def sparse(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return (np.repeat(np.arange(len(lists)), [len(x) for x in lists]),
                np.fromiter((i for x in lists for i in x), dtype=np.int64))

    pairs = [k for k in range(n) if rows[k] != swapped[k]]
    (r, c), (ra, ca), (rb, cb) = sparse(rows), sparse([rows[k] for k in pairs]), sparse([swapped[k] for k in pairs])
    m1, m2, b1, b2 = np.zeros(n_words), np.zeros(n_words), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(r, w[c], n) + bias
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / n
        gw = np.bincount(c, g[r], n_words) + ridge * w
        gb = g.sum()
        if pairs:
            d = np.bincount(ra, w[ca], len(pairs)) - np.bincount(rb, w[cb], len(pairs))
            d *= 2 * fairness / len(pairs)
            gw += np.bincount(ca, d[ra], n_words) - np.bincount(cb, d[rb], n_words)
        m1, m2, b1, b2 = 0.9 * m1 + 0.1 * gw, 0.999 * m2 + 0.001 * gw * gw, 0.9 * b1 + 0.1 * gb, 0.999 * b2 + 0.001 * gb * gb
        a = RATE * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
        w -= a * m1 / (np.sqrt(m2) + 1e-8)
        bias -= a * b1 / (math.sqrt(b2) + 1e-8)
    return w, bias


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """Word weights and bias, learnt outside the held-out fold."""
    sample = training_sample(docs, labels)
    names = vocabulary(sample)
    spark = docs.sparkSession
    index = F.broadcast(spark.createDataFrame(sorted(names), "string").withColumnRenamed("value", "word"))
    sides = F.array(F.struct(F.lit(False).alias("swapped"), F.col("words").alias("words")),
                    F.struct(F.lit(True).alias("swapped"), F.col("other").alias("words")))
    both = sample.select("doc_id", "toxic", F.col("other").isNotNull().alias("named"), F.explode(sides).alias("side"))
    both = both.filter(F.col("named") | ~F.col("side.swapped"))
    hits = both.select("doc_id", "toxic", "named", "side.swapped", F.explode_outer("side.words").alias("word"))
    hits = hits.join(index.withColumn("known", F.lit(True)), "word", "left")
    chosen = lambda side: F.array_sort(F.collect_set(F.when(F.col("known") & side, F.col("word"))))
    hits = hits.groupBy("doc_id", "toxic").agg(
        chosen(~F.col("swapped")).alias("words"), chosen(F.col("swapped")).alias("other"), F.max("named").alias("named"))
    found = sorted(hits.toArrow().to_pylist(), key=lambda x: (x["doc_id"], x["toxic"]))  # bounded: sample rows, chosen words
    rows = [sorted(names[w] for w in x["words"]) for x in found]
    other = [sorted(names[w] for w in x["other"]) if x["named"] else r for x, r in zip(found, rows, strict=True)]
    w, bias = fit(rows, other, np.array([x["toxic"] for x in found], dtype=float), len(names))
    return {name: float(w[i]) for name, i in names.items() if w[i]}, float(bias)


def score(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row.  Narrow: no shuffle; the model's size is bounded."""

    whole = weights.keys()
    stems = [(k, {w for w in whole if w.endswith("*") and len(w) == k + 1}) for k in STEMS]
    stems = [(k, {w[:-1] for w in found}) for k, found in stems if found]

    def hits(text: str | None) -> float:
        names = set(WORD.findall(text.lower())) if text else set()
        found = names & whole
        for k, known in stems:
            found.update(w + "*" for w in {w[:k] for w in names} & known)
        return math.fsum(weights[w] for w in found)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            z = np.array([bias + hits(t) for t in pdf["text"].tolist()], dtype=float)
            s = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": s,
                                "predicted": (s >= 0.5).astype("int32")})

    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"),
                       F.coalesce(held_out(docs["doc_id"]), F.lit(False)).alias("held_out"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double, predicted int")


def op6_toxicity(spark, sf_dir):
    """Registered query: train on the labelled rows, score all documents."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, *train(docs, table(spark, sf_dir, "labels")))
