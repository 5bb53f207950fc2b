"""Line dedup: an exact set-similarity join over all lines of all documents.

A line is the set of its white-space words.  Two lines match when their sets'
Jaccard similarity is 0.8 or more; a line is removed when an earlier line of
the corpus (smaller doc_id, or same document and smaller line number) matches
it.  Matches are judged on the input, not on what is left.

1. Words are ordered by rarity: counts over all lines, in a fixed number of
   hashed cells, so the table every task needs has one size at any scale.  A
   word becomes a 32-bit token, led by its rarity.
2. Lines with equal sets form a class, kept by its earliest line.
3. Prefix filter: sets that match share one of their rarest tokens, so classes
   meet in a join on prefix tokens only, the smaller set by fewer of them, under
   the length and positional filters and 192 parities of each set, which bound
   how many tokens they share.
4. Copies and near copies make long posting lists.  So each class is first
   held against the head of each of its tokens' lists, from the earliest document; only classes that
   this does not remove meet all earlier classes of their tokens.  That is
   exact, and a group of near copies costs its size, not its square.  Posting
   lists are never written whole: they are shuffled ``PARTS`` times, each time
   those of some tokens.
5. Candidates are verified on the full sets.

Column expressions only.  Lines without words, and rows without an id, are
never removed; null and empty texts have one empty line; rows that repeat an
id count as one document; of equal lines the earliest (id, then line) stays; texts
and lines of any length are read whole; an empty table gives an empty result;
extra columns are kept by ``remove_lines``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, forget, save, save_bucketed, table

#: Jaccard threshold as a fraction
OVER, UNDER = 4, 5
#: cells of the rarity table
CELL_BITS = 16
#: parts, a power of two, of the posting lists, by token; one part is on disk at a time
PARTS = 4
#: longs of 64 parities each that posting lists carry
LONGS = 3


def _spaced(text: Column) -> Column:
    """The text with spaces for all other white space within lines, so that words are cut without a regular expression."""
    return F.when(text.rlike("[\\t\\x0B\\f\\r]"), F.translate(text, "\t\x0b\f\r", "    ")).otherwise(text)


def _lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line_no, line`` of every line that has a word, of documents with an id; words are parted by spaces."""
    rows = docs.select(docs["doc_id"].alias("doc_id"), _spaced(docs["text"]).alias("t")).filter("doc_id IS NOT NULL")
    rows = rows.select("doc_id", F.posexplode(F.split("t", "\n")).alias("line_no", "line"))
    return rows.filter(F.trim("line") != "")


def _rarity(docs: DataFrame) -> Column:
    """Rank of every cell by the occurrences of its words, as the constant array of the highest bits of their tokens.

    Bounded: ``2 ** CELL_BITS`` counts reach the driver, at any corpus size.
    """
    spaced = F.replace(_spaced(docs["text"]), F.lit("\n"), F.lit(" "))
    word = docs.select(F.explode(F.split(spaced, " ")).alias("w")).filter("w <> ''")
    cell = F.xxhash64("w").bitwiseAND((1 << CELL_BITS) - 1).cast("int").alias("cell")
    counts = word.select(cell).groupBy("cell").agg(F.count("*").alias("n")).collect()
    n = {r["cell"]: r["n"] for r in counts}
    rank = [0] * (1 << CELL_BITS)
    for k, c in enumerate(sorted(range(len(rank)), key=lambda c: (n.get(c, 0), c))):
        rank[c] = (k - (1 << (CELL_BITS - 1))) << (64 - CELL_BITS)
    return F.expr(f"cast(split('{','.join(map(str, rank))}', ',') as array<bigint>)")


def _ordered(rank: Column, h: Column) -> Column:
    """A word's hash, one to one, led by its rarity rank: rarer words are smaller."""
    return F.get(rank, h.bitwiseAND((1 << CELL_BITS) - 1).cast("int")) + F.shiftrightunsigned(h, CELL_BITS)


def classes(docs: DataFrame) -> DataFrame:
    """``id, doc_id, line_no, n, tokens``: each distinct set with its earliest line."""
    rank = _rarity(docs)
    # cutting at single spaces leaves empty words
    hashes = F.array_except(F.transform(F.split("line", " "), lambda x: F.xxhash64(x)), F.array(F.xxhash64(F.lit(""))))
    rows = _lines(docs).select("doc_id", "line_no", F.sort_array(F.transform(hashes, lambda h: _ordered(rank, h))).alias("s"))
    # the set's name is a hash of all 64 bits of its words; its tokens are their upper halves
    rows = rows.select(F.xxhash64("s").alias("id"), F.struct("doc_id", "line_no").alias("at"),
                       F.transform("s", lambda x: F.shiftright(x, 32).cast("int")).alias("tokens"))
    found = rows.groupBy("id").agg(F.min("at").alias("at"), F.first("tokens").alias("tokens"))
    return save_bucketed(found.select("id", "at.doc_id", "at.line_no", F.size("tokens").alias("n"), "tokens"), "id")


def _parities(sets: DataFrame) -> DataFrame:
    """``id, b0, b1, ...``: for each of 64 cells a long, whether an odd number of the set's tokens fall into it."""
    one = sets.select("id", F.explode("tokens").alias("t"))
    which, bit = F.pmod(F.shiftright("t", 6), F.lit(LONGS)), F.expr("shiftleft(1L, t & 63)")
    return one.groupBy("id").agg(*[F.bit_xor(F.when(which == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"b{k}")
                                   for k in range(LONGS)])


def _prefix(n: Column) -> Column:
    """How many of the rarest tokens of a set of ``n`` hold one that it shares with any match."""
    return n - F.ceil(n * OVER / UNDER).cast("int") + 1


def _short(n: Column) -> Column:
    """The same for matches that are no smaller: they share eight ninths of ``n`` tokens."""
    return n - F.ceil(n * 2 * OVER / (OVER + UNDER)).cast("int") + 1


def _filed(sets: DataFrame) -> DataFrame:
    """``id, doc_id, n, tokens, b0, b1, ...``: what posting lists need of a class; of its tokens the prefix only."""
    # both sides lie bucketed by id, so nothing moves
    rows = sets.select("id", "doc_id", "n", F.slice("tokens", F.lit(1), _prefix(F.col("n"))).alias("tokens"))
    return save_bucketed(rows.join(_parities(sets).hint("shuffle_hash"), "id"), "id")


def _can_match(x: str, y: str, before: Column) -> Column:
    """Length, positional and parity filter for rows of two posting lists, by the prefix of their columns.

    ``before``: how many tokens they may share ahead of this one.  Sets of ``a`` and ``b`` tokens
    that match differ in at most a ninth of ``a + b`` tokens; each bit in which their parities
    differ takes one.
    """
    a, i, b, j = F.col(f"{x}n"), F.col(f"{x}p"), F.col(f"{y}n"), F.col(f"{y}p")
    length = (UNDER * a >= OVER * b) & (UNDER * b >= OVER * a)
    position = (OVER + UNDER) * (before + 1 + F.least(a - 1 - i, b - 1 - j)) >= OVER * (a + b)
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{x}b{k}").bitwiseXOR(F.col(f"{y}b{k}"))) for k in range(LONGS)])
    return length & position & ((OVER + UNDER) * differ <= (UNDER - OVER) * (a + b))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Ids ``x``: of each pair of classes whose full sets match, the one of the later line."""
    cols = ("id", "doc_id", "line_no", "tokens")
    a = sets.select(*[F.col(c).alias(f"x{c}") for c in cols]).withColumnRenamed("xid", "x")
    b = sets.select(*[F.col(c).alias(f"y{c}") for c in cols]).withColumnRenamed("yid", "y")
    # the classes lie bucketed by id and are read through; only pairs move and are hashed
    both = a.join(b.join(pairs.distinct().hint("shuffle_hash"), "y").hint("shuffle_hash"), "x")
    inter = F.size(F.array_intersect("xtokens", "ytokens"))
    both = both.filter(UNDER * inter >= OVER * (F.size("xtokens") + F.size("ytokens") - inter))
    later = F.struct("ydoc_id", "yline_no") < F.struct("xdoc_id", "xline_no")
    return both.select(F.when(later, F.col("x")).otherwise(F.col("y")).alias("x")).distinct()


def _posted(sets: DataFrame, part: int, *cols: str, length: Callable[[Column], Column] = _prefix) -> DataFrame:
    """A row for each prefix token of each class, of the tokens of one part."""
    prefix = F.slice("tokens", F.lit(1), length(F.col("n")))
    rows = sets.select("id", "doc_id", "n", *cols, F.posexplode(prefix).alias("p", "token"))
    return rows.filter(F.col("token").bitwiseAND(PARTS - 1) == part)


#: names of the parities
BITS = [f"b{k}" for k in range(LONGS)]


def _head_pairs(filed: DataFrame, part: int) -> DataFrame:
    """``x, y``: classes and the heads of their tokens' lists, if they can match."""
    cols = ("id", "n", "p", *BITS)
    by_token = Window.partitionBy("token").orderBy("doc_id", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = _posted(filed, part, *BITS, length=_short).withColumn("head", F.first(F.struct(*cols)).over(by_token))
    rows = rows.select(*cols, *[F.col(f"head.{c}").alias(f"head_{c}") for c in cols])
    rows = rows.filter((F.col("id") != F.col("head_id")) & _can_match("", "head_", F.least("p", "head_p")))
    return rows.select(F.col("id").alias("x"), F.col("head_id").alias("y"))


def _list_pairs(filed: DataFrame, part: int) -> DataFrame:
    """``x, y``: classes that share a token, ``x`` the larger set, if they can match and the later one is open.

    A pair that matches passes at the first token that its sets share.
    """
    cols = ("id", "doc_id", "n", "p", "open", *BITS)
    x = _posted(filed, part, "open", *BITS).select("token", *[F.col(c).alias(f"x{c}") for c in cols])
    y = _posted(filed, part, "open", *BITS, length=_short).select("token", *[F.col(c).alias(f"y{c}") for c in cols])
    larger = (F.col("xn") > F.col("yn")) | ((F.col("xn") == F.col("yn")) & (F.col("xid") < F.col("yid")))
    later = (F.col("xopen") & (F.col("ydoc_id") <= F.col("xdoc_id"))) | (F.col("yopen") & (F.col("xdoc_id") <= F.col("ydoc_id")))
    pairs = x.join(y, "token").filter(larger & later & _can_match("x", "y", F.lit(0)))
    return pairs.select(F.col("xid").alias("x"), F.col("yid").alias("y"))


def removed_classes(sets: DataFrame) -> DataFrame:
    """``x``: the id of every class whose earliest line matches an earlier line."""
    # one part of the posting lists at a time, as a shuffle that is freed before the next; all heads come before all lists
    filed = _filed(sets)
    heads = [save(_head_pairs(filed, part)) for part in range(PARTS)]
    early = save(_verified(reduce(DataFrame.union, heads), sets))
    forget(*heads)
    # the classes lie bucketed by id, so this moves the removed ids only
    gone = early.select(F.col("x").alias("id"), F.lit(True).alias("gone")).hint("shuffle_hash")
    marked = filed.join(gone, "id", "left").withColumn("open", F.col("gone").isNull())
    lists = [save(_list_pairs(marked, part)) for part in range(PARTS)]
    out = save(early.union(_verified(reduce(DataFrame.union, lists), sets)).distinct())
    forget(filed, early, *lists)
    return out


def removed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, lines``: the numbers, from 0, of each document's removed lines (documents that lose any)."""
    sets = classes(docs)
    dead = removed_classes(sets).withColumnRenamed("x", "id").hint("shuffle_hash")
    kept = sets.select("id", "doc_id", "line_no").join(dead, "id", "left_anti")
    # dealt by document first: its lines lie apart, so there is nothing to gather before
    kept = kept.select("doc_id", "line_no").repartition("doc_id").groupBy("doc_id").agg(F.collect_list("line_no").alias("kept"))
    full = F.array_compact(F.transform(F.split("t", "\n"), lambda x, i: F.when(F.trim(x, F.lit(SPACE)) != "", i)))
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("t")).filter("doc_id IS NOT NULL")
    rows = rows.groupBy("doc_id").agg(F.flatten(F.collect_set(full)).alias("full"))
    gone = F.array_sort(F.array_except("full", F.coalesce("kept", F.array().cast("array<int>"))))
    return rows.join(kept, "doc_id", "left").select("doc_id", gone.alias("lines")).filter(F.size("lines") > 0)


def remove_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less its removed lines (and ``n_chars`` to match, if there)."""
    gone = removed_lines(docs).select(F.col("doc_id").alias("__id"), F.col("lines").alias("__lines"))
    kept = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("__lines", i)), "\n")
    out = docs.join(gone, docs["doc_id"] == gone["__id"], "left")
    out = out.withColumn("text", F.when(F.col("__lines").isNull(), F.col("text")).otherwise(kept))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__lines").isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(docs.columns)


def op1_line_dedup(spark, sf_dir):
    """Registered query: per document its lines, how many are removed, and which."""
    docs = table(spark, sf_dir, "documents")
    n = docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"))
    out = n.join(removed_lines(docs), "doc_id", "left")
    return out.select("doc_id", "n_lines", F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce(F.array_join("lines", ","), F.lit("")).alias("removed_lines"))


def oracle() -> str:
    """The same in DuckDB: prefix filter by exact counts, overlaps by a join on all tokens."""
    return f"""
WITH l AS (SELECT doc_id, i - 1 AS line_no, list_sort(list_distinct(regexp_extract_all(lines[i], '[^\\x20\\x09-\\x0D]+'))) AS w
      FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
s AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id, line_no) AS pos, doc_id, line_no, w, len(w) AS n FROM l WHERE len(w) > 0),
c AS MATERIALIZED (SELECT w, min(pos) AS id, any_value(n) AS n FROM s GROUP BY w),
t AS MATERIALIZED (SELECT id, n, unnest(w) AS token FROM c),
f AS (SELECT token, count(*) AS df FROM t GROUP BY token),
p AS MATERIALIZED (SELECT id, n, token FROM (SELECT id, n, token, row_number() OVER (PARTITION BY id ORDER BY df, token) AS r FROM t JOIN f USING (token))
      WHERE r <= n - ceil(n * {OVER} / {UNDER}.0) + 1),
k AS (SELECT DISTINCT a.id AS x, b.id AS y FROM p a JOIN p b ON a.token = b.token AND b.id < a.id
      WHERE {UNDER} * a.n >= {OVER} * b.n AND {UNDER} * b.n >= {OVER} * a.n),
v AS (SELECT x, y, count(*) AS o FROM k JOIN t a ON a.id = x JOIN t b ON b.id = y AND a.token = b.token GROUP BY x, y),
dead AS (SELECT DISTINCT x FROM v JOIN c a ON a.id = x JOIN c b ON b.id = y WHERE {UNDER} * o >= {OVER} * (a.n + b.n - o)),
gone AS (SELECT doc_id, line_no FROM s JOIN c USING (w) WHERE s.pos <> c.id OR c.id IN (SELECT x FROM dead)),
g AS (SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS lines FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed,
  coalesce(g.lines, '') AS removed_lines FROM documents d LEFT JOIN g USING (doc_id)"""
