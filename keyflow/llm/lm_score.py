"""Language-model scores of whole documents, against a unigram base.

1. Tokens (lower-cased words, and one end per document) of all training
   documents are counted; each task adds up its own before the shuffle.
2. A gated recurrent model (``gru``) learns the ``VOCABULARY`` most frequent
   tokens, all others as one symbol.  Every training document takes part once:
   in each round every task trains a copy on its documents of that round, and
   the copies are averaged in groups, over as many levels as needed.
3. Every document is read whole by the model.  A token outside its
   vocabulary costs the model's price of the rare symbol, and its smoothed
   share among the rare tokens.
4. Counts of the ``FREQUENT`` most frequent tokens, a bounded table, are at
   hand in every task; those of all others come by a join on the token.

Edge cases: a null, empty or blank text is its end alone; without training
documents all counts are 0 and the model stays at its start; rows without an id
are not held out; each row of a repeated id is scored by its own text; an empty
table gives no rows; texts of any length are read whole; tokens of equal count
enter the vocabulary by their hash; extra columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import gru, tokens
from .common import save, table

FOLDS, HELD_OUT = 7, 2
VOCABULARY, FREQUENT = 1_025, 100_000
#: share of the training documents in each round, and its learning rate
ROUNDS = ((1, 0.01), (7, 0.005))
GROUP = 64
#: texts that advance together in training, at most
TRAIN_LANES = 384
#: tokens a task gathers before it counts, trains or scores
TOKENS = 3_000_000
END = np.uint64(0x5EED0F7E87C0DE01)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"),
                       held_out(docs["doc_id"]).alias("held_out"))


def _tokens(batches: Iterator[pa.RecordBatch], limit: int = TOKENS) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, their tokens end to end, and how many each row has; about ``limit`` tokens at a time."""
    rows, flat, sizes, n = [], [], [], 0
    for batch in batches:
        column = batch.schema.get_field_index("text")
        for at, to, w in tokens.words_of(batch.column(column), tokens.IS_SPACE_WORD, tokens.LOWER):
            count = np.diff(w.first)
            all_ = np.full(len(w.hash) + len(count), END)
            all_[np.arange(len(w.hash)) + w.text_of()] = w.hash
            rows.append(batch.slice(at, to - at))
            flat.append(all_)
            sizes.append(count + 1)
            n += len(all_)
            if n >= limit:
                yield pa.Table.from_batches(rows).combine_chunks(), np.concatenate(flat), np.concatenate(sizes)
                rows, flat, sizes, n = [], [], [], 0
    if rows:
        yield pa.Table.from_batches(rows).combine_chunks(), np.concatenate(flat), np.concatenate(sizes)


def token_counts(docs: DataFrame) -> DataFrame:
    """``token, c`` over all training documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, _ in _tokens(batches, 2 * TOKENS):
            found, c = np.unique(flat, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(c.astype(np.int64))], ["token", "c"])

    rows = _texts(docs).filter(~F.col("held_out")).select("text")
    return rows.mapInArrow(run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _pack(params: gru.Params) -> bytes:
    out = io.BytesIO()
    np.savez(out, **params)
    return out.getvalue()


def _unpack(data: bytes) -> gru.Params:
    with np.load(io.BytesIO(data)) as f:
        return dict(f)


class Model:
    """Vocabulary (sorted token hashes, symbols from 1; 0 is every other token), counts and parameters."""

    def __init__(self, vocabulary: np.ndarray, counts: np.ndarray):
        order = np.argsort(vocabulary)
        self.vocabulary, self.counts = vocabulary[order], np.concatenate((counts[:1], counts[1:][order]))
        self.layout = gru.Layout(self.counts)
        self.params = self.layout.start(self.counts)
        self.end = int(self.symbols(np.array([END]))[0])

    def symbols(self, found: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == found, at + 1, 0)


def train(docs: DataFrame, model: Model) -> gru.Params:
    """Average of copies that tasks train on their own documents, round by round."""
    spark = docs.sparkSession
    shares = np.cumsum([0] + [s for s, _ in ROUNDS])
    part = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(int(shares[-1])))
    rows = _texts(docs).filter(~F.col("held_out")).withColumn("part", part)
    params = model.params
    for k, (_, rate) in enumerate(ROUNDS):
        sent = spark.sparkContext.broadcast((model, _pack(params)))  # bounded by the vocabulary and the hidden size

        def run(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> Iterator[pa.RecordBatch]:
            shared, packed = sent.value
            trainer, weight = gru.Trainer(_unpack(packed), shared.layout, rate), 0
            for _, flat, sizes in _tokens(batches):
                trainer.texts(shared.symbols(flat), sizes, shared.end, TRAIN_LANES)
                weight += len(flat)
            if weight:
                yield pa.RecordBatch.from_arrays([pa.array([float(weight)]), pa.array([_pack(trainer.p)], pa.binary())], ["weight", "params"])

        mine = rows.filter((F.col("part") >= int(shares[k])) & (F.col("part") < int(shares[k + 1]))).select("text")
        copies = save(mine.mapInArrow(run, "weight double, params binary"))
        while (n := copies.count()) > 1:
            copies = save(_averaged(copies, -(-n // GROUP)))
        first = copies.first()
        params = _unpack(bytes(first["params"])) if first else params
        sent.unpersist()
    return params


def _averaged(copies: DataFrame, groups: int) -> DataFrame:
    """One weighted average for each group of copies; a task holds a running sum, not the group."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, weight = None, 0.0
        for pdf in frames:
            for w, data in zip(pdf["weight"], pdf["params"], strict=True):
                p = {k: v.astype(np.float64) * w for k, v in _unpack(bytes(data)).items()}
                total = p if total is None else {k: total[k] + p[k] for k in p}
                weight += w
        if total is not None:
            mean = {k: (v / weight).astype(np.float32) for k, v in total.items()}
            yield pd.DataFrame({"weight": [weight], "params": [_pack(mean)]})

    return copies.repartition(groups).mapInPandas(run, "weight double, params binary")


def rare_tokens(flat: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens of each text, how often each stands in it, and where each text's begin."""
    order = np.lexsort((flat, text))
    text, flat = text[order], flat[order]
    new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (flat[1:] != flat[:-1])))) if len(flat) else np.empty(0, int)
    ends = np.searchsorted(text[new], np.arange(n_texts + 1)).astype(np.int32)
    return flat[new], np.diff(np.append(new, len(flat))), ends


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``."""
    spark = docs.sparkSession
    counts = save(token_counts(docs))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = int(total["n"]), int(total["v"])
    top = counts.orderBy(F.desc("c"), "token").limit(FREQUENT).toArrow()  # bounded by FREQUENT
    known = top.column("token").to_numpy().view(np.uint64)
    c = top.column("c").to_numpy()
    chosen = known[:VOCABULARY - 2]
    if END not in chosen:
        chosen = np.append(chosen, END)
    of = dict(zip(known.tolist(), c.tolist(), strict=True))
    chosen_c = np.array([of.get(t, 0) for t in chosen.tolist()], dtype=np.float64)
    n_rare, v_rare = n_all - int(chosen_c.sum()), v_all - int((chosen_c > 0).sum())
    model = Model(chosen, np.concatenate(([float(n_rare)], chosen_c)))
    model.params = train(docs, model)

    order = np.argsort(known)
    sent = spark.sparkContext.broadcast((model, known[order], c[order]))  # bounded by FREQUENT and VOCABULARY
    base_of, rare_of = n_all + v_all + 1, n_rare + v_rare + 1

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, names, c_of = sent.value
        for rows, flat, sizes in _tokens(batches):
            symbol = shared.symbols(flat)
            at = np.minimum(np.searchsorted(names, flat), max(0, len(names) - 1))
            frequent = names[at] == flat if len(names) else np.zeros(len(flat), bool)
            n = np.where(frequent, c_of[at] if len(names) else 0, 0)
            text = np.repeat(np.arange(len(sizes)), sizes)
            base = np.where(frequent, np.log10((n + 1) / base_of), 0.0)
            rare = np.where(frequent & (symbol == 0), np.log10((n + 1) / rare_of), 0.0)
            model_part = gru.score(shared.params, shared.layout, symbol, sizes, shared.end)
            names_, tf, ends = rare_tokens(flat[~frequent], text[~frequent], len(sizes))
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id").combine_chunks(), rows.column("held_out").combine_chunks(), pa.array(sizes.astype(np.int64)),
                pa.array(np.bincount(text, frequent, len(sizes)).astype(np.int64)),
                pa.array(np.bincount(text, base, len(sizes))),
                pa.array(np.bincount(text, rare, len(sizes)) + model_part),
                pa.ListArray.from_arrays(ends, names_.view(np.int64)), pa.ListArray.from_arrays(ends, tf.astype(np.int32))],
                ["doc_id", "held_out", "n_tokens", "known", "base", "score", "tokens", "tf"])

    # written once with each row's rare tokens: the texts are not cut again for them, and row numbers stay the same
    out = save(_texts(docs).mapInArrow(
        read, "doc_id long, held_out boolean, n_tokens long, known long, base double, score double, tokens array<long>, tf array<int>"
    ).withColumn("row", F.monotonically_increasing_id()))
    rare = out.select("row", F.explode(F.arrays_zip("tokens", "tf")).alias("z")).select("row", F.col("z.tokens").alias("token"), F.col("z.tf").alias("tf"))
    n = F.coalesce("c", F.lit(0))
    rare = rare.join(counts, "token", "left").groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("tf")).otherwise(0)).alias("more_known"),
        F.sum(F.col("tf") * F.log10((n + 1) / F.lit(float(base_of)))).alias("more_base"),
        F.sum(F.col("tf") * F.log10((n + 1) / F.lit(float(rare_of)))).alias("more_score"))
    out = out.join(rare, "row", "left")
    more = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + more("more_known")).cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base") + more("more_base")).alias("base_score"),
        (F.col("score") + more("more_score")).alias("score"))


def op10_lm_score(spark, sf_dir):
    """Registered query: ``score`` over all documents."""
    return score(table(spark, sf_dir, "documents"))
