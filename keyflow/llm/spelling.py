"""Spelling variants of the words of a corpus: words that differ by one inserted, deleted or replaced code point.

Two words are one edit apart if their common prefix and common suffix together
reach the longer length less one.  Words meet in groups that such a pair must
share: the longer word (of length ``m``) is parted into ``PARTS`` stretches,
and the one edit lies in one of them, so all code points before and after that
stretch agree.  A word therefore stands, for every stretch, in the group of its
own length and (as the shorter word of an insertion) of the next length.

Groups are dealt as tiles: a group's members are numbered in blocks, and two
blocks of a group are one tile, so that a group of any size is compared in many
tasks.  A task packs the words of its tiles into padded code-point matrices and
compares the blocks of a tile row against row.  A pair is counted in the first
stretch that its edit can lie in, hence once, and a tile gives one partial row
per word (near words counted, the best kept), never its pairs.

The chain of forms is followed by pointer doubling; every step of it raises the
count tenfold, so five rounds cover all counts of 64 bits.

Edge cases: null, empty or wordless texts give nothing; repeated rows count as
often as they occur; ties go to the smallest word in code-point order; an empty
table gives no rows; runs and texts of any length are read whole (a tile of
long words has fewer rows); only ``doc_id`` and ``text`` are read.  A null
``doc_id`` stands in the checksum as an empty string.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import text_slices
from .common import UPPER, save, table

#: stretches of a word, one of which holds the edit
PARTS = 4
#: words of a block, and the code points its matrix holds at most (or one longer word)
BLOCK_ROWS = 512
BLOCK_CELLS = 262_144
#: cells of a comparison at a time
CELLS = 4_000_000
#: distinct words that a task counts before it hands them on
COUNTED = 500_000
MIN_LENGTH, MIN_COUNT, FORM_TIMES, SLIP = 7, 2, 10, 31

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans(UPPER, UPPER.lower())


def _slipped(doc: int | None, run: str) -> str:
    """The run, less one code point where its checksum with the document's id says so."""
    h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words(docs: DataFrame) -> DataFrame:
    """``word, n``: all words of at least ``MIN_LENGTH`` code points with ``MIN_COUNT`` occurrences."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for batch in batches:
            for doc, texts in text_slices(batch):
                for d, text in zip(doc.to_pylist(), texts.to_pylist(), strict=True):
                    for run, n in Counter(RUN.findall(text.translate(_LOWER))).items():
                        if len(run) >= MIN_LENGTH and len(word := _slipped(d, run)) >= MIN_LENGTH:
                            found[word] += n
                    if len(found) > COUNTED:
                        yield _counts(found)
                        found.clear()
        if found:
            yield _counts(found)

    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return (read.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= MIN_COUNT))


def _counts(found: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                                      ["word", "n"])


def _stretch(m: Column, part: Column | int) -> Column:
    """Where stretch ``part`` of a word of length ``m`` begins."""
    return F.floor(m * part / PARTS).cast("int")


def _blocks(n: Column, m: Column) -> Column:
    """How many blocks ``n`` words of length ``m`` fill."""
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_CELLS) / m)))
    return F.ceil(n / rows).cast("int")


def tiles(counted: DataFrame) -> DataFrame:
    """``m, part, key, i, j, left``: every word in every tile it is compared in, as of its left or right block."""
    size = F.char_length("word")
    placed = counted.select("word", "n", size.alias("size"), F.explode(F.array(size, size + 1)).alias("m"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    after = F.col("m") - _stretch(F.col("m"), F.col("part") + 1)
    placed = placed.select("word", "n", "m", "part", F.xxhash64(
        F.substring("word", F.lit(1), _stretch(F.col("m"), F.col("part"))),
        F.when(after > 0, F.substring("word", -after, after)).otherwise("")).alias("key"),
        (F.col("size") == F.col("m")).alias("long"))
    group = ["m", "part", "key"]
    # groups without a longer word, or of one word, hold no pair
    sizes = placed.groupBy(*group).agg(F.count(F.lit(1)).alias("members"), F.max("long").alias("some"))
    sizes = sizes.where((F.col("members") > 1) & F.col("some")).select(*group, _blocks(F.col("members"), F.col("m")).alias("blocks"))
    met = placed.join(sizes, group).withColumn("block", F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = met.select("word", "n", *group, "block", F.explode(every).alias("other"))
    return met.select("word", "n", *group, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                      (F.col("block") <= F.col("other")).alias("left"))


def _matrix(names: list[str], sizes: np.ndarray, width: int, back: bool) -> np.ndarray:
    """Code points of the words, forwards or backwards, padded with 0 on the right."""
    out = np.zeros((len(names), width), np.uint32)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer(
        "".join([w[::-1] for w in names] if back else names).encode("utf-32-le"), np.uint32)
    return out


def _run(same: np.ndarray) -> np.ndarray:
    """How many leading columns of every row are true."""
    stop = np.argmin(same, axis=1)
    return np.where(same[np.arange(len(same)), stop], same.shape[1], stop)


class Tiles:
    """Whole tiles, one after the other; rows of a tile's left block stand before those of its right block."""

    def __init__(self, names: list[str], m: np.ndarray, part: np.ndarray, tile: np.ndarray, mixed: np.ndarray,
                 left: np.ndarray):
        """``tile``: number of each row's tile; ``mixed``: its tile is of two blocks; ``left``: row of the left block."""
        self.m, self.part = m, part
        self.sizes = np.array([len(w) for w in names], np.int64)
        width = int(m.max())
        self.ahead, self.back = (_matrix(names, self.sizes, width, b) for b in (False, True))
        at = np.arange(len(names))
        head = np.concatenate(([True], tile[1:] != tile[:-1]))
        number = np.cumsum(head) - 1
        ends = np.append(np.flatnonzero(head)[1:], len(names))[number]
        lefts = np.add.reduceat(left.astype(np.int64), np.flatnonzero(head))[number]
        # a row of a left block meets the tile's right block, or the rows after it in its own
        self.first = np.where(mixed, np.flatnonzero(head)[number] + lefts, at + 1)
        self.partners = np.where(left, ends - self.first, 0)

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows one edit apart whose edit is first found in the tile's stretch, some cells at a time."""
        ends = np.cumsum(self.partners)
        step = max(1, CELLS // self.ahead.shape[1])
        for at in range(0, int(ends[-1]), step):
            pair = np.arange(at, min(at + step, int(ends[-1])))
            x = np.searchsorted(ends, pair, "right")
            y = self.first[x] + pair - (ends[x] - self.partners[x])
            m = self.m[x]
            longer = np.maximum(self.sizes[x], self.sizes[y]) == m
            x, y, m = x[longer], y[longer], m[longer]
            prefix = _run(self.ahead[x] == self.ahead[y])
            suffix = _run(self.back[x] == self.back[y])
            first = m - 1 - suffix  # the first place the edit can have
            part = self.part[x]
            hit = (prefix + suffix >= m - 1) & (first >= m * part // PARTS) & (first < m * (part + 1) // PARTS)
            yield x[hit], y[hit]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial row per word and run of tiles: near words counted, the best of them kept."""
    rest = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        rest = now if rest is None else pa.concat_tables([rest, now])
        tile = _tile_numbers(rest)
        done = int(np.searchsorted(tile, tile[-1])) if len(tile) else 0  # the last tile may go on
        if done:
            yield from _partials(rest.slice(0, done), tile[:done])
            rest = rest.slice(done)
    if rest is not None and rest.num_rows:
        yield from _partials(rest, _tile_numbers(rest))


def _tile_numbers(rows: pa.Table) -> np.ndarray:
    same = np.ones(max(0, rows.num_rows - 1), bool)
    for c in ("m", "part", "key", "i", "j"):
        v = rows.column(c).to_numpy()
        same &= v[1:] == v[:-1]
    return np.concatenate(([0], np.cumsum(~same))) if rows.num_rows else np.empty(0, np.int64)


def _partials(rows: pa.Table, tile: np.ndarray) -> Iterator[pa.RecordBatch]:
    m = rows.column("m").to_numpy().astype(np.int64)
    cells = np.cumsum(m)
    at = 0
    while at < len(tile):  # whole tiles of at most so many cells, or one tile
        last = tile[min(int(np.searchsorted(cells, cells[at] + CELLS)), len(tile) - 1)]
        to = int(np.searchsorted(tile, max(last, tile[at] + 1)))
        part = rows.slice(at, to - at)
        names, n = part.column("word").to_pylist(), part.column("n").to_pylist()
        both = Tiles(names, m[at:to], part.column("part").to_numpy().astype(np.int64), tile[at:to],
                     part.column("i").to_numpy() != part.column("j").to_numpy(),
                     part.column("left").to_numpy(zero_copy_only=False))
        near: Counter[str] = Counter()
        best: dict[str, tuple[int, str]] = {}
        for x, y in both.near():
            for a, b in zip(x.tolist(), y.tolist(), strict=True):
                for word, other, k in ((names[a], names[b], n[b]), (names[b], names[a], n[a])):
                    near[word] += 1
                    found = (-k, other)
                    if word not in best or found < best[word]:
                        best[word] = found
        if near:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(near), pa.string()), pa.array(list(near.values()), pa.int64()),
                 pa.array([best[w][0] for w in near], pa.int64()), pa.array([best[w][1] for w in near], pa.string())],
                ["word", "n_near", "less_n", "form"])
        at = to


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: forms followed to the last, by pointer doubling."""
    now = save(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        if now.join(step, now["root"] == step["via"], "left_semi").isEmpty():
            return now
        now = save(now.join(step, now["root"] == step["via"], "left").select(
            "word", F.coalesce("further", "root").alias("root")))


def variants(docs: DataFrame) -> DataFrame:
    """Every word with its near words, its form and the last of its chain of forms."""
    counted = save(words(docs))
    order = ["m", "part", "key", "i", "j"]
    met = tiles(counted).repartition(*order).sortWithinPartitions(*order, F.desc("left"))
    near = met.mapInArrow(_compare, "word string, n_near long, less_n long, form string")
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less_n", "form")).alias("best"))
    found = -F.col("best.less_n")
    good = found >= FORM_TIMES * F.col("n")
    told = save(counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(good, F.col("best.form")).alias("form"), F.when(good, found).alias("form_n")))
    ends = roots(told.where(F.col("form").isNotNull()).select("word", "form"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
