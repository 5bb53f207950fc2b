"""Best-fit packing of whole documents into sequences, by large-item matching.

Tokens are made by the public tokenizer, inside tasks.  Packing itself works
on the histogram of piece lengths, which has at most ``capacity`` rows at any
corpus size: pieces above a third of the capacity are matched greedily, at
most two to a sequence; smaller ones go, longest first, to the tightest gap
that holds them.  The plan says how many sequences get which lengths; Spark
then hands the pieces of each length out by rank.

Edge cases: a null or empty text is the closing id alone; repeated rows are
packed as often as they occur; which of equally long pieces goes where is
arbitrary; texts of any length are cut into pieces whole; an empty table gives no
rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save, table

CAPACITY = 1024
END_ID = 2
#: words whose ids a worker keeps; beyond it the memory starts anew (speed only)
CACHE_WORDS = 300_000
#: characters encoded at a time
BATCH_CHARS = 8_000_000
#: pieces of one length ranked in one task
RANK_ROWS = 500

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts, as the ``tokenizers`` library gives them for ``path``.

    A byte-level tokenizer always starts a token at a single space between two
    other characters, so a text is the sum of its space-led chunks.  A batch is
    cut and its chunks numbered column-wise; only chunks that this worker has not
    met are encoded.  Those of plain characters go through the same
    vocabulary as ranks (``ranks``), which gives the same ids faster; all
    others, and whole texts with a space next to other white space or with an
    added token, through ``path``.
    """

    BLANK = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
    TOUCHING = f" {BLANK}|{BLANK} "
    PLAIN = re.compile("[\n -~\u00a1-\u00ac\u00ae-\u024f]*")

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        #: contents of added tokens (such as the end of a text), which are cut out of a text before all else
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.fast = self._ranked(ranks) if ranks else None
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _ranked(path: str):
        import base64

        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=found, special_tokens={})

    def _encode(self, chunks: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.tok.encode_batch(chunks, add_special_tokens=False)]

    def _fetch(self, chunks: list[str]) -> list[bytes]:
        """Ids of distinct chunks, from the cache or made now."""
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        cache, rest = self.cache, []
        for c in chunks:
            if c not in cache:
                if self.fast is not None and self.PLAIN.fullmatch(c):
                    cache[c] = array("I", self.fast.encode_ordinary(c)).tobytes()
                else:
                    rest.append(c)
        cache.update(zip(rest, self._encode(rest), strict=True))
        return [cache[c] for c in chunks]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        column = pa.array(texts, pa.large_string())
        whole = pc.match_substring_regex(column, self.TOUCHING).to_numpy(zero_copy_only=False)
        for token in self.added:
            whole = whole | pc.match_substring(column, token).to_numpy(zero_copy_only=False)
        plain = np.flatnonzero(~whole)
        out: list = [None] * len(texts)
        for i, b in zip(np.flatnonzero(whole), self._encode([texts[i] for i in np.flatnonzero(whole)]), strict=True):
            out[i] = np.frombuffer(b, "<u4")
        if len(plain):
            cut = pc.split_pattern(column.take(pa.array(plain)), " ")
            starts = cut.offsets.to_numpy()
            numbered = cut.flatten().dictionary_encode()
            codes = numbered.indices.to_numpy().astype(np.int64)
            names = numbered.dictionary.to_pylist()
            firsts = {c: len(names) + k for k, c in enumerate(dict.fromkeys(names[c] for c in codes[starts[:-1]]))}
            codes[starts[:-1]] = [firsts[names[c]] for c in codes[starts[:-1]]]  # no space before a text's first chunk
            made = self._fetch([" " + c for c in names] + list(firsts))
            sizes = np.array([len(b) // 4 for b in made], dtype=np.int64)
            places = np.concatenate(([0], np.cumsum(sizes)))
            n = sizes[codes]
            ends = np.concatenate(([0], np.cumsum(n)))
            flat = np.frombuffer(b"".join(made), "<u4")[np.repeat(places[codes] - ends[:-1], n) + np.arange(ends[-1])]
            for k, i in enumerate(plain):
                out[i] = flat[ends[starts[k]]:ends[starts[k + 1]]]
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, ranks: str | None) -> Encoder:
    return Encoder(path, ranks)


def _batches(pdf: pd.DataFrame) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of at most ``BATCH_CHARS`` characters at a time (or one longer text)."""
    docs, texts, size = [], [], 0
    for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
        text = "" if text is None else text
        if docs and size + len(text) > BATCH_CHARS:
            yield docs, texts
            docs, texts, size = [], [], 0
        docs.append(doc)
        texts.append(text)
        size += len(text)
    if docs:
        yield docs, texts


def pieces(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """A row for each piece: place, length and checksum of its ids.  Narrow: no shuffle."""
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(path, ranks)
        for pdf in frames:
            for docs_, texts in _batches(pdf):
                rows = []
                for doc, found in zip(docs_, enc.ids(texts), strict=True):
                    ids = found.tobytes() + end
                    n = len(ids) // 4
                    start, length = 0, n % capacity or capacity
                    for k in range(-(-n // capacity)):
                        rows.append((doc, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)])))
                        start, length = start + length, capacity
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInPandas(cut, PIECES)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Groups of alike sequences: (how many, {length: pieces of it in each}).

    Both steps work on counts, so the cost depends on the capacity, not on
    the number of pieces.  At most about ``2 * capacity`` groups come out.
    """
    left = {k: v for k, v in histogram.items() if v > 0}
    if any(k < 1 or k > capacity for k in left):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    large = capacity // 3 + 1
    groups: dict[int, list[tuple[int, dict[int, int]]]] = {}  # by gap

    def add(count: int, what: dict[int, int]) -> None:
        if count:
            gap = capacity - sum(k * v for k, v in what.items())
            groups.setdefault(gap, []).append((count, what))

    for size in range(capacity, large - 1, -1):
        partner = min(size, capacity - size)
        while left.get(size, 0):
            while partner >= large and not left.get(partner, 0):
                partner -= 1
            n = left[size]
            if partner < large:
                add(n, {size: 1})
                left[size] = 0
            elif partner == size:
                add(n // 2, {size: 2})
                left[size] = n % 2
                partner -= 1
            else:
                m = min(n, left[partner])
                add(m, {size: 1, partner: 1})
                left[size] -= m
                left[partner] -= m
    for size in range(large - 1, 0, -1):
        n = left.get(size, 0)
        for gap in [g for g in sorted(groups) if g >= size] if n else []:
            each, todo = gap // size, groups.pop(gap)
            for count, what in todo:
                full = min(count, n // each)
                add(full, what | {size: each})
                n -= full * each
                count -= full
                if count and n:
                    add(1, what | {size: n})
                    n, count = 0, count - 1
                add(count, what)
            if not n:
                break
        each = capacity // size
        add(n // each, {size: each})
        add(1 if n % each else 0, {size: n % each})
    return [g for gap in sorted(groups) for g in groups[gap]]


def plan_rows(groups: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, pieces a sequence, first sequence, first offset) of each hand-out."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for count, what in groups:
        offset = 0
        for length in sorted(what, reverse=True):
            each = what[length]
            at = taken.get(length, 0)
            taken[length] = at + count * each
            rows.append((length, at, at + count * each, each, sequence, offset))
            offset += each * length
        sequence += count
    return rows


def ranked(df: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``df`` with ``rank``, from 0, among the rows of its ``length``.

    One length may hold most rows, so each is ranked in hashed blocks of about
    ``RANK_ROWS`` rows; the blocks' sizes, one row each, give the offsets.
    """
    blocks = [(length, max(1, -(-n // RANK_ROWS))) for length, n in sorted(histogram.items())]
    blocks = df.sparkSession.createDataFrame(blocks, "length long, blocks long")  # bounded: a row for each length
    df = df.join(F.broadcast(blocks), "length")
    df = df.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.col("blocks"))).drop("blocks")
    sizes = df.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "start", "ids_crc32")
    out = df.withColumn("at", F.row_number().over(inside) - 1).join(sizes, ["length", "block"])
    return out.withColumn("rank", F.col("before") + F.col("at")).drop("block", "before", "at")


def pack(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``.

    ``path`` is the tokenizer; ``ranks``, if given, the same vocabulary as ranks.
    """
    spark = docs.sparkSession
    cut = save(pieces(docs, path, ranks, capacity, end_id))
    # bounded: at most ``capacity`` lengths reach the driver, at any corpus size
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan_rows(plan(histogram, capacity))
    handed = spark.createDataFrame(
        rows, "length long, low long, high long, each long, sequence long, first long")
    df = ranked(cut, histogram).alias("r")
    # bounded: the plan's size depends on the capacity alone
    h = F.broadcast(handed.alias("h"))
    out = df.join(h, (F.col("r.length") == F.col("h.length")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    at = F.col("rank") - F.col("low")
    return out.select(
        "doc_id", "piece", "start", "r.length", "ids_crc32",
        (F.col("sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("first") + F.pmod(at, F.col("each")) * F.col("r.length")).cast("long").alias("offset"))


def op5_best_fit_packing(spark, sf_dir):
    """Registered query: ``pack`` over all documents."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))
