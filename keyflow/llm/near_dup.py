"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct word shingles.  Each shingle hash falls
into one of ``BUCKETS`` buckets; a bucket's register keeps of its smallest hash
only the count of leading zeros and ``MANTISSA`` bits after them.  Bands of
``BAND`` registers make the join keys.  At the threshold of 0.85 a pair shares
none of the 32 bands with a chance of about 5e-11 (at 0.8, 6e-9).

1. Equal sets form a class; only a class's smallest id goes on.
2. In each band key every class is held against the key's smallest one:
   candidates grow with the members, not with their square.  Links are
   confirmed on the full sets, and components joined.
3. Keys whose members still lie in several components are searched through:
   pairs across components (never within one) whose register estimate,
   corrected for chance collisions, comes within five standard errors of the
   threshold are confirmed too.  Large keys are compared block by block
   inside tasks, also by the lower bits of their full sets, so that only pairs
   that are almost surely links are laid out as rows.

Edge cases: null, empty or blank texts have an empty set and are linked with
nothing; texts shorter than a shingle are one shingle as a whole; rows that
repeat an id share their links, also where their texts differ; rows without an
id are linked with nothing; the smallest id names a component, so there are no
ties; texts of any length are read whole; empty tables give empty results;
extra columns are kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .chunks import gather
from .common import forget, save, save_bucketed, table
from .graph import components

BUCKETS, BAND, MANTISSA = 128, 4, 10
EMPTY = -1
#: a band key with more members is compared inside tasks, in blocks of about so many
FEW, BLOCK = 32, 1000
#: parts, a power of two, of the band keys that are searched through; the rows of one part are on disk at a time
PARTS = 4
STANDARD_ERRORS = 5.0
FILTER_BITS = 1 << 22
#: bytes of text hashed at a time (or one longer text); a worker holds some hundred bytes for each
CHUNK_BYTES = 250_000


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``from, to`` of a text column with the distinct shingles of its texts: text, hash, in this order."""
    for at, to, w in tokens.words_of(column, tokens.IS_SPACE_WORD, tokens.LOWER, CHUNK_BYTES):
        h, place = tokens.windows(w.hash, w.first, size)
        text = np.searchsorted(w.first, place, "right") - 1
        n = np.diff(w.first)
        short = np.flatnonzero((n > 0) & (n < size))
        if len(short):
            h = np.concatenate([h, tokens.runs(w.hash, w.first[short], w.first[short + 1], seed=1)])
            text = np.concatenate([text, short])
        order = np.lexsort((h, text))
        h, text = h[order], text[order]
        if len(h):
            new = np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])))
            h, text = h[new], text[new]
        yield at, to, text, h


def registers(text: np.ndarray, h: np.ndarray, n_texts: int) -> np.ndarray:
    """A row of ``BUCKETS`` registers for each text; hashes come sorted within a text."""
    out = np.full((n_texts, BUCKETS), EMPTY, np.int16)
    if not len(h):
        return out
    bits = BUCKETS.bit_length() - 1
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    least = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])))
    text, bucket, v = text[least], bucket[least], h[least] << np.uint64(bits)
    zeros = np.minimum(53 - np.frexp((v >> np.uint64(11)).astype(np.float64))[1], 31).astype(np.uint64)
    mantissa = (v << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out[text, bucket] = ((zeros << np.uint64(MANTISSA)) | mantissa).astype(np.int16)
    return out


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n, a, b, regs``: set size, set identity (128 bits, order-free) and registers of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, text, h in shingle_sets(batch.column(1), size):
                n = np.bincount(text, minlength=to - at)
                ends = np.concatenate(([0], np.cumsum(n)))
                ids = []
                for seed in (0x51ED270B, 0xB492B66F):
                    s = np.concatenate(([np.uint64(0)], np.cumsum(tokens.mix(h ^ np.uint64(seed)))))
                    ids.append((s[ends[1:]] - s[ends[:-1]]).view(np.int64))
                regs = registers(text, h, to - at)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, to - at), pa.array(n.astype(np.int64)), pa.array(ids[0]), pa.array(ids[1]),
                    pa.ListArray.from_arrays(np.arange(0, regs.size + 1, BUCKETS, dtype=np.int32), regs.reshape(-1))],
                    ["doc_id", "n", "a", "b", "regs"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, a long, b long, regs array<short>")


def _full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``id, hashes`` of the documents in ``ids``.

    A bit table of fixed size drops most other documents before their sets
    are shipped; the join decides.
    """
    bit = F.xxhash64("id").bitwiseAND(FILTER_BITS - 1).alias("bit")
    found = ids.select(bit).distinct().toArrow()  # bounded: at most FILTER_BITS numbers
    bits = np.zeros(FILTER_BITS, bool)
    bits[found.column("bit").to_numpy()] = True
    packed: Broadcast = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(packed.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(wanted[batch.column(2).to_numpy()]))
            for at, to, text, h in shingle_sets(batch.column(1), size):
                ends = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=to - at)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, to - at), pa.ListArray.from_arrays(ends, h.view(np.int64))], ["id", "hashes"])

    rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text")).filter("id IS NOT NULL")
    sets = rows.select("id", "text", bit).mapInArrow(run, "id long, hashes array<long>")
    return sets.join(ids, "id", "left_semi").dropDuplicates(["id"])


def _low(hashes: str) -> Column:
    """The distinct lower 16 bits of the hashes."""
    return F.array_distinct(F.transform(hashes, lambda h: F.shiftright(F.shiftleft(h, 48), 48).cast("short")))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``x, y`` whose full sets are alike enough.

    First by the hashes' lower bits: common hashes have common lower bits, and
    only as many can share them as a set has more hashes than lower bits.  The
    few pairs that this leaves are looked at in full.
    """
    def with_both(pairs: DataFrame, *cols: str) -> DataFrame:
        for side in ("x", "y"):
            pairs = pairs.join(sets.select(F.col("id").alias(side), *[F.col(c).alias(side + c) for c in cols]), side)
        return pairs

    most = F.size(F.array_intersect("xlow", "ylow")) + F.least(F.col("xn") - F.size("xlow"), F.col("yn") - F.size("ylow"))
    able = with_both(pairs, "n", "low").filter(100 * most >= percent * (F.col("xn") + F.col("yn") - most)).select("x", "y")
    inter = F.size(F.array_intersect("xhashes", "yhashes"))
    union = F.size("xhashes") + F.size("yhashes") - inter
    return with_both(able, "hashes").filter(100 * inter >= percent * union).select("x", "y")


def _sizes_fit(a: str, b: str, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _estimate(a: Column, b: Column) -> tuple[Column, Column]:
    """Jaccard estimate from registers, less chance collisions; and how many registers it rests on."""
    used = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != EMPTY) | (y != EMPTY)), lambda t: t))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != EMPTY)), lambda t: t))
    chance = 0.4 / (1 << MANTISSA)  # equal zeros by chance, then equal mantissas
    return (same / used - chance) / (1 - chance), used


def _first_band(a: Column, b: Column) -> Column:
    """The first band, not all empty, in which two register rows agree."""
    def agrees(i: Column) -> Column:
        x = F.slice(a, i * BAND + 1, BAND)
        return (x == F.slice(b, i * BAND + 1, BAND)) & F.exists(x, lambda v: v != EMPTY)

    return F.array_position(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS // BAND - 1)), agrees), True) - 1


def _across(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs between components of the same band key.

    ``members``: ``key, band, many, id, component, n``, of keys with several
    components.  A pair is taken up in the first band that it shares only.
    """
    t = percent / 100
    regs = classes.select("id", "regs")
    few = members.filter(F.col("many") <= FEW).join(regs, "id")
    cols = ("id", "component", "n", "regs")
    n_bands = BUCKETS // BAND
    x = few.select("key", "band", *[F.col(c).alias(f"x{c}") for c in cols])
    y = few.select("key", *[F.col(c).alias(f"y{c}") for c in cols])
    estimate, used = _estimate(F.col("xregs"), F.col("yregs"))
    pairs = x.join(y, "key").filter((F.col("xid") > F.col("yid")) & (F.col("xcomponent") != F.col("ycomponent"))
                                    & _sizes_fit("xn", "yn", percent)
                                    & (estimate >= t - STANDARD_ERRORS * F.sqrt(t * (1 - t) / used))
                                    & (_first_band(F.col("xregs"), F.col("yregs")) == F.col("band")))
    pairs = pairs.select(F.col("xid").alias("x"), F.col("yid").alias("y"))

    # larger keys: members dealt over blocks by a hash; every pair of blocks is one group
    blocks = F.ceil(F.col("many") / BLOCK).cast("int")
    many = members.filter(F.col("many") > FEW).join(regs, "id").join(sets.select("id", "low"), "id")
    many = many.select("key", "band", *cols, "low", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("block"),
                       F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    many = many.select("key", "band", *cols, "low", F.least("block", "other").alias("i"),
                       F.greatest("block", "other").alias("j"), "block")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        a = pdf[pdf["block"] == pdf["i"].iloc[0]]
        b = pdf[pdf["block"] == pdf["j"].iloc[0]]
        out = []
        if len(a) and len(b):
            rb, band = np.stack(b["regs"].to_list()), int(pdf["band"].iloc[0])
            ids, components_, m = (b[c].to_numpy() for c in ("id", "component", "n"))
            low = np.concatenate(b["low"].to_list()).view(np.uint16)
            size = b["low"].str.len().to_numpy()
            start = np.cumsum(size) - size
            mine = np.zeros(1 << 16, bool)
            for id_, comp, n, regs, own in zip(a["id"], a["component"], a["n"], a["regs"], a["low"], strict=True):
                k = np.flatnonzero((components_ != comp) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
                regs, rk = np.asarray(regs), rb[k]
                used_ = np.maximum(1, ((rk != EMPTY) | (regs != EMPTY)).sum(axis=1))
                same = ((rk == regs) & (regs != EMPTY)).sum(axis=1)
                chance = 0.4 / (1 << MANTISSA)
                ok = (same / used_ - chance) / (1 - chance) >= t - STANDARD_ERRORS * np.sqrt(t * (1 - t) / used_)
                bands = ((rk == regs).reshape(len(rk), n_bands, BAND).all(axis=2)
                         & (regs != EMPTY).reshape(n_bands, BAND).any(axis=1))
                k = k[ok & (bands.argmax(axis=1) == band)]
                # the most hashes that both can hold, as in _confirmed
                mine[own.view(np.uint16)] = True
                hits = np.concatenate(([0], np.cumsum(mine[gather(low, start[k], size[k])])))
                mine[own.view(np.uint16)] = False
                ends = np.cumsum(size[k])
                most = hits[ends] - hits[ends - size[k]] + np.minimum(n - len(own), m[k] - size[k])
                k = k[100 * most >= percent * (n + m[k] - most)]
                out += [(max(id_, y), min(id_, y)) for y in ids[k]]
        return pd.DataFrame(sorted(set(out)), columns=["x", "y"]).astype("int64")

    blocks = many.groupBy("key", "i", "j").applyInPandas(compare, "x long, y long")
    return pairs.union(blocks).distinct()


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    rows = save(sketches(docs, size))
    known = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    if not known.select("doc_id", "a", "b", "n").distinct().groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _by_row(docs, rows, size, percent)
    classes = save(known.groupBy("a", "b", "n").agg(F.min("doc_id").alias("id"), F.first("regs").alias("regs")))
    n_bands = BUCKETS // BAND
    bands = F.filter(F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda i: F.struct(
        i.alias("i"), F.slice("regs", i * BAND + 1, BAND).alias("r"))),
        lambda s: F.exists(s["r"], lambda v: v != EMPTY))
    keys = classes.select("id", "n", F.explode(bands).alias("b")).select(
        "id", "n", F.col("b.i").alias("band"), F.xxhash64("b.i", "b.r").alias("key"))
    heads = keys.groupBy("key").agg(F.count("*").alias("many"), F.min(F.struct("id", "n")).alias("head")).filter("many > 1")
    shared = save(keys.join(heads, "key").select(
        "key", "band", "many", "id", "n", F.col("head.id").alias("head"), F.col("head.n").alias("head_n")))

    sets = _full_sets(docs, shared.select("id").distinct(), size)
    sets = save_bucketed(sets.select("id", "hashes", F.size("hashes").alias("n"), _low("hashes").alias("low")), "id")
    stars = shared.filter((F.col("id") != F.col("head")) & _sizes_fit("n", "head_n", percent)).select(
        F.col("id").alias("x"), F.col("head").alias("y")).distinct()
    links = save(_confirmed(stars, sets, percent))
    first = components(links)

    found = []
    for part in range(PARTS):
        some = shared.filter(F.col("key").bitwiseAND(PARTS - 1) == part).select("key", "band", "many", "id", "n")
        placed = some.join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
        open_keys = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
        found.append(save(_across(placed.join(open_keys.select("key"), "key", "left_semi"), classes, sets, percent)))
    across = reduce(DataFrame.union, found).distinct()
    every = save(links.union(_confirmed(across, sets, percent)))
    forget(shared, sets, *found)
    final = components(every)
    forget(every)

    placed = classes.select("a", "b", "n", "id").join(final, "id", "left").select(
        "a", "b", "n", F.coalesce("component", "id").alias("component"))
    out = rows.select("doc_id", "n", "a", "b").join(placed, ["a", "b", "n"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def _by_row(docs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """``near_duplicates`` where an id has several texts: rows are linked first, then those that share an id."""
    own = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text")).filter("id IS NOT NULL")
    own = save(own.withColumn("row", F.monotonically_increasing_id()))
    found = near_duplicates(own.select(F.col("row").alias("doc_id"), "text"), size, percent)
    found = save(found.join(own.select("id", F.col("row").alias("doc_id")), "doc_id").select(
        "id", "n_shingles", F.col("component_id").alias("group")))
    linked = found.filter("n_shingles > 0")
    least = linked.groupBy("id").agg(F.min("group").alias("y"))
    joined = components(linked.select("id", F.col("group").alias("x")).join(least, "id").select("x", "y").distinct())
    groups = linked.join(joined.select(F.col("id").alias("group"), "component"), "group", "left").select(
        "id", "group", F.coalesce("component", "group").alias("whole"))
    names = groups.groupBy("whole").agg(F.min("id").alias("component_id"))
    names = groups.select("group", "whole").distinct().join(names, "whole").select("group", "component_id")
    told = linked.join(names, "group").select("id", "n_shingles", "component_id").unionByName(
        found.filter("n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id")))
    told = told.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
    nobody = rows.filter("doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"),
                                                  F.lit(True).alias("kept"))
    return told.unionByName(nobody)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` less all but the smallest id of each component."""
    gone = save(near_duplicates(docs, size, percent).filter(~F.col("kept")).select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def op8_near_duplicates(spark, sf_dir):
    """Registered query: 3-word shingles, links at a Jaccard similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def oracle(size: int = 3, percent: int = 85) -> str:
    """The same in DuckDB: all pairs that share a shingle, components by recursion to the smallest id."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(CASE WHEN len(w) >= {size} THEN list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(list_slice(w, i, i + {size} - 1), ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
c AS MATERIALIZED (SELECT list_sort(s) AS s, min(doc_id) AS id, len(any_value(s)) AS n FROM s WHERE len(s) > 0 GROUP BY list_sort(s)),
t AS MATERIALIZED (SELECT id, n, unnest(s) AS x FROM c),
l AS MATERIALIZED (SELECT a.id AS u, b.id AS v FROM t a JOIN t b ON a.x = b.x AND a.id <> b.id GROUP BY a.id, b.id, a.n, b.n
      HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
r(id, component) AS (SELECT id, id FROM c UNION SELECT l.v, r.component FROM r JOIN l ON l.u = r.id WHERE r.component < l.v),
m AS (SELECT id, min(component) AS component FROM r GROUP BY id),
d AS (SELECT s.doc_id, len(s.s) AS n, coalesce(m.component, s.doc_id) AS component
      FROM s LEFT JOIN c ON list_sort(s.s) = c.s LEFT JOIN m USING (id))
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component AS component_id, doc_id = component AS kept FROM d"""
