"""Substring dedup by recompression.

Removes every word covered by a window of ``WINDOW`` words whose word sequence
also starts earlier in the corpus.

Recompression parses each text in rounds: runs of one word get a name, then
neighbouring symbols pair up where the left one's name falls into one half of
all names and the right one's into the other.  A name is a 64-bit hash of what
it stands for, so all tasks of all Spark stages name alike without exchanging
a dictionary.  How a symbol came about depends on a few words around it only;
these words are kept along.  A symbol whose words all lie in a window is the
same in every copy of that window, wherever the copy stands: equal windows hold
equal interior symbols.

1. Each window is filed under the smallest key of its interior symbols
   (neighbours mostly share it).  Neighbouring windows under one key form a
   segment, known by the hash of its whole stretch of words.  A task drops
   windows that it has itself seen earlier.
2. Segments meet by key.  Equal stretches: all but the earliest are repeats.
   A key with one stretch only, once, holds no repeat.
3. Keys with different stretches are verified window by window: their first
   stretches' windows meet by a 128-bit hash, and the earliest stays.
4. The covered words are cut from the texts.

Edge cases: null, empty and blank texts have no words; texts under ``WINDOW``
words lose nothing; rows that repeat an id count as one document (their texts
lose the same places); rows without an id lose nothing; of equal windows the
earliest stays, so there are no ties; texts of any length are read whole; empty
tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import save, table

WINDOW, ROUNDS = 20, 2
#: bytes of text within which a task drops windows it has seen
CHUNK_BYTES = 4_000_000
#: bytes of text hashed and parsed at a time (or one longer text)
PART_BYTES = 500_000
#: cells of the table that tells which documents have places at all; bounded, so it is broadcast
CELLS = 1 << 18

_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def symbols(w: tokens.Words, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Name, first word, first and last+1 word that it depends on, text; of every symbol after the last round.

    A symbol that depends on where its text begins or ends reaches beyond it.
    """
    name, doc = w.hash, w.text_of()
    n = len(name)
    start, end = np.arange(n), np.arange(1, n + 1)
    lo, hi = start, end
    if not n:
        return name, start, lo, hi, doc

    # runs of one word; to know one, the words on both sides must be seen
    new = np.concatenate(([True], (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])))
    a = np.flatnonzero(new)
    b = np.concatenate((a[1:], [n]))
    size = (b - a).astype(_U)
    name = np.where(size > 1, tokens.mix(name[a] ^ size * _U(0x9FB21C651E98DF25)), name[a])
    doc = doc[a]
    lo, hi, start, end = a - 1, b + 1, a, b

    for r in range(rounds):
        left = (tokens.mix(name + _U(0xA0761D6478BD642F * (r + 1) & 0xFFFFFFFFFFFFFFFF)) & _U(1)).astype(bool)
        same = doc[1:] == doc[:-1]
        pair = np.concatenate((left[:-1] & ~left[1:] & same, [False]))
        after = np.concatenate((same, [False]))
        before = np.concatenate(([False], same))
        right = np.concatenate((np.arange(1, len(name)), [0]))
        # a paired symbol ends with its partner; a lone one has seen that its neighbour is no partner
        new_hi = np.where(pair, hi[right], np.where(left, np.where(after, np.maximum(hi, hi[right]), end + 1), hi))
        prev = np.concatenate(([0], np.arange(len(name) - 1)))
        new_lo = np.where(pair | left, lo, np.where(before, np.minimum(lo, lo[prev]), start - 1))
        new_end = np.where(pair, end[right], end)
        new_name = np.where(pair, tokens.mix(name * _U(0xE7037ED1A0B428DB) + name[right] * _U(0x8EBC6AF09C88C6E3) + _U(r)), name)
        head = ~np.concatenate(([False], pair[:-1]))
        name, start, end, lo, hi, doc = new_name[head], start[head], new_end[head], new_lo[head], new_hi[head], doc[head]
    return name, start, lo, hi, doc


def window_keys(w: tokens.Words, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key, hash and place of every window: the key is the smallest of its interior symbols, else its own hash."""
    h, at = tokens.windows(w.hash, w.first, size)
    if not len(h):
        return h, h, at
    name, start, lo, hi, doc = symbols(w)
    begin, stop = w.first[doc], w.first[doc + 1]
    ok = (lo >= begin) & (hi <= stop) & (hi - lo <= size)
    name, start, lo, hi, begin, stop = name[ok], start[ok], lo[ok], hi[ok], begin[ok], stop[ok]
    key = tokens.runs(w.hash, lo, hi) ^ tokens.mix(name + (start - lo).astype(_U))
    order = np.argsort(hi - lo, kind="stable")
    key, lo, span, begin, stop = key[order], lo[order], (hi - lo)[order], begin[order], stop[order]
    best = np.full(len(w.hash), _NONE)
    for back in range(size):  # windows that start so many words before the symbol's first
        n = np.searchsorted(span, size - back, "right")
        i = lo[:n] - back
        inside = (i >= begin[:n]) & (i + size <= stop[:n])
        np.minimum.at(best, i[inside], key[:n][inside])
    key = best[at]
    return np.where(key == _NONE, tokens.mix(h ^ _U(0x1D8E4E27C47D124F)), key), h, at


def _seen(h: np.ndarray, at: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Windows of this chunk that start earlier in it (by id, then place)."""
    out = np.zeros(len(h), bool)
    s = np.sort(h)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    if len(twice):
        k = np.searchsorted(twice, h)
        k[k == len(twice)] = 0
        some = np.flatnonzero(twice[k] == h)
        some = some[np.lexsort((place[some], ids[some], h[some]))]
        first = np.concatenate(([True], h[some][1:] != h[some][:-1]))
        head = some[np.maximum.accumulate(np.where(first, np.arange(len(some)), 0))]
        out[some] = (ids[some] != ids[head]) | (place[some] != place[head])
    return out


def _keyed(data: np.ndarray, edges: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Word hashes of a chunk of texts, where each text's words begin; key, hash and place of its windows.

    The texts are hashed and parsed ``PART_BYTES`` at a time: their words and
    windows take little room, but the work on every byte of them much more.
    """
    hashes, begin, windows = [np.empty(0, _U)], [np.zeros(1, np.int64)], [(np.empty(0, _U), np.empty(0, _U), np.empty(0, np.int64))]
    at = words = 0
    while at < len(edges) - 1:
        to = max(at + 1, int(np.searchsorted(edges, edges[at] + PART_BYTES, "right")) - 1)
        w = tokens.Words(data[edges[at]:edges[to]], edges[at:to + 1] - edges[at], tokens.IS_SPACE_WORD, tokens.SAME)
        key, h, place = window_keys(w, size)
        hashes.append(w.hash)
        begin.append(w.first[1:] + words)
        windows.append((key, h, place + words))
        words += len(w.hash)
        at = to
    return (np.concatenate(hashes), np.concatenate(begin), *(np.concatenate(x) for x in zip(*windows, strict=True)))


def _stretches(at: np.ndarray, text: np.ndarray, key: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Positions, in the arrays, of the first and last of each run of neighbouring windows under one key."""
    new = (np.diff(at) != 1) | (np.diff(text) != 0)
    if key is not None:
        new |= key[1:] != key[:-1]
    cut = np.flatnonzero(new) + 1
    return np.concatenate(([0], cut)), np.concatenate((cut, [len(at)])) - 1


def segments(docs: DataFrame, size: int = WINDOW, chunk: int = CHUNK_BYTES) -> DataFrame:
    """``key, stretch, doc_id, start, n``: neighbouring windows under one key; null keys are known repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, _, data, edges in tokens.parts(batch.column(1), chunk):
                hashes, begin, key, h, at = _keyed(data, edges, size)
                if not len(at):
                    continue
                text = np.searchsorted(begin, at, "right") - 1
                place = at - begin[text]
                doc = ids[first + text]
                gone = _seen(h, at, doc, place)
                for part, known in ((gone, True), (~gone, False)):
                    p = np.flatnonzero(part)
                    if not len(p):
                        continue
                    a, b = _stretches(at[p], text[p], None if known else key[p])
                    a, b = p[a], p[b]
                    n = at[b] - at[a] + 1
                    nulls = np.full(len(a), known)
                    stretch = tokens.runs(hashes, at[a], at[b] + size, seed=2)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key[a].view(np.int64), mask=nulls), pa.array(stretch.view(np.int64), mask=nulls),
                        pa.array(doc[a].astype(np.int64)), pa.array(place[a].astype(np.int32)),
                        pa.array(n.astype(np.int32))], ["key", "stretch", "doc_id", "start", "n"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).filter("doc_id IS NOT NULL")
    return rows.mapInArrow(run, "key long, stretch long, doc_id long, start int, n int")


def _with_places(docs: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (``doc_id, text``) joined with the places of each, and the other documents, which have none.

    A table of ``CELLS`` hashed cells, broadcast, keeps most documents without
    places out of the join's shuffle; the join decides.
    """
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).alias("cell")
    cells = F.broadcast(save(places.select(cell).distinct()))  # bounded: at most CELLS rows
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    keyed = docs.withColumn("cell", F.when(F.col("doc_id").isNull(), -1).otherwise(cell))
    each = places.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("places"))
    some = keyed.join(cells, "cell", "left_semi").drop("cell").join(each, "doc_id", "left")
    return some, keyed.join(cells, "cell", "left_anti").drop("cell")


def _marks(places, n: int) -> np.ndarray:
    """True at the starts that the places (start, length) hold."""
    out = np.zeros(n + 1, np.int64)
    for p in places or ():
        if p["start"] < n:
            out[p["start"]] += 1
            out[min(n, p["start"] + p["n"])] -= 1
    return np.cumsum(out)[:n] > 0


def repeats(docs: DataFrame, size: int = WINDOW, chunk: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, start, n``: runs of windows that start earlier in the corpus."""
    found = save(segments(docs, size, chunk))
    by_key = Window.partitionBy("key")
    here = F.struct("doc_id", "start")
    met = found.filter(F.col("key").isNotNull())
    met = met.withColumn("first", F.min(here).over(Window.partitionBy("key", "stretch", "n")))
    met = met.withColumn("mixed", F.min(F.struct("stretch", "n")).over(by_key) != F.max(F.struct("stretch", "n")).over(by_key))
    met = met.select("doc_id", "start", "n", (here != F.col("first")).alias("again"), "mixed")
    met = save(met.filter(F.col("again") | F.col("mixed")))

    some, _ = _with_places(docs, met.filter(~F.col("again")).select("doc_id", "start", "n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(2).to_pylist()
            ids = batch.column(0).to_numpy()
            for first, _, w in tokens.words_of(batch.column(1), limit=PART_BYTES):
                h, at = tokens.windows(w.hash, w.first, size, seed=3)
                g, _ = tokens.windows(w.hash, w.first, size, seed=4)
                text = np.searchsorted(w.first, at, "right") - 1
                n = np.diff(w.first)
                wanted = np.concatenate([np.zeros(0, bool)] + [_marks(places[first + k], n[k]) for k in range(len(w))])
                ok = wanted[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(h[ok].view(np.int64)), pa.array(tokens.mix(g[ok] * _U(3)).view(np.int64)),
                    pa.array(ids[first + text[ok]].astype(np.int64)),
                    pa.array((at - w.first[text])[ok].astype(np.int32))], ["a", "b", "doc_id", "start"])

    single = some.filter(F.col("places").isNotNull()).mapInArrow(run, "a long, b long, doc_id long, start int")
    single = single.withColumn("first", F.min(here).over(Window.partitionBy("a", "b")))
    single = single.filter(here != F.col("first")).select("doc_id", "start", F.lit(1).alias("n"))
    return met.filter("again").select("doc_id", "start", "n").union(
        found.filter(F.col("key").isNull()).select("doc_id", "start", "n")).union(single)


def remove_repeats(docs: DataFrame, size: int = WINDOW, chunk: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, n_words, n_removed, text`` of every row; the kept words are joined by single spaces."""
    schema = "doc_id long, n_words long, n_removed long, text string"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, out = [], [], []
            for text, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found = (text or "").encode().split()
                starts = np.flatnonzero(_marks(places, len(found)))
                covered = _marks([{"start": int(s), "n": size} for s in _spaced(starts, size)], len(found)) if len(starts) else ()
                kept = [x for x, c in zip(found, covered, strict=True) if not c] if len(starts) else found
                total.append(len(found))
                removed.append(len(found) - len(kept))
                out.append(b" ".join(kept).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                                              pa.array(out, pa.string())], ["doc_id", "n_words", "n_removed", "text"])

    some, rest = _with_places(docs, save(repeats(docs, size, chunk)))
    none = F.lit(None).cast("array<struct<start:int,n:int>>").alias("places")
    return some.select("doc_id", "text", "places").mapInArrow(cut, schema).union(
        rest.select("doc_id", "text", none).mapInArrow(cut, schema))


def _spaced(starts: np.ndarray, size: int) -> np.ndarray:
    """Starts that suffice to cover what all ascending ``starts`` cover: the ends of neighbouring runs, and every ``size``-th."""
    run = np.concatenate(([0], np.cumsum(np.diff(starts) != 1)))
    first = np.concatenate(([True], run[1:] != run[:-1]))
    last = np.concatenate((run[1:] != run[:-1], [True]))
    since = starts - starts[np.maximum.accumulate(np.where(first, np.arange(len(starts)), 0))]
    return starts[first | last | (since % size == 0)]


def op7_substring_dedup(spark, sf_dir):
    """Registered query: digests of what ``remove_repeats`` leaves of every document."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def oracle(size: int = WINDOW) -> str:
    """The same in DuckDB: every window spelled out."""
    return f"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {size - 1}), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - {size - 2})) AS i FROM w WHERE len(w) >= {size})),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM g) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT i + k) AS gone FROM again, range({size}) AS r(k) GROUP BY doc_id),
k AS (SELECT doc_id, w, CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(gone, i)), lambda i: w[i]) END AS kept
      FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""
