"""License scan: ordered signature rules with keyword gates, on whole texts.

Only texts that hold a gate word at all are cut into words; of their rules only
those whose gate word is among the words run.  Every hit is an interval of
words.  A hit that lies inside a hit of better priority, or inside a longer or
earlier one of its own priority, is suppressed.  Base phrases are counted in
all their places and keep their labels whatever the rules say.

All of it is column expressions on the row itself: no shuffle, no Python.
Rows come out one for one, so repeated ids are safe.  A null or empty text has
no words, no hits and score 0; of hits with the same words and priority the
earlier rule's stays; texts of any length are scanned whole; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, table
from .license_rules import BASE, CC_GATE, CONFIDENCE, RAW_GATES, rules

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: what parts words, before lower-casing
NO_WORD = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hits(norm: Column, pattern: Column) -> Column:
    """Word intervals ``[start, end)`` of all matches; every word of ``norm`` has two spaces."""
    n_words = lambda c: ((F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))) / 2).cast("int")
    found, between = F.regexp_extract_all(norm, pattern, F.lit(0)), F.split(norm, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("hits"))
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(
        n_words(b).alias("skip"), n_words(m).alias("n")))
    return F.aggregate(pairs, start, lambda a, x: F.struct(
        (a["at"] + x["skip"] + x["n"]).alias("at"),
        F.concat(a["hits"], F.array(F.struct((a["at"] + x["skip"]).alias("start"),
                                             (a["at"] + x["skip"] + x["n"]).alias("end")))).alias("hits")),
        lambda a: a["hits"])


def _base_hits(norm: Column, label: str, phrase: str) -> Column:
    hits = _hits(norm, F.lit(" " + phrase.replace(" ", "  ") + " "))
    return F.transform(hits, lambda h: F.struct(h["start"].alias("start"), F.lit(label).alias("label")))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: ``n_words``, base counts and labels, method ``labels``, ``n_hits`` kept and ``score``."""
    all_rules = rules()
    gates = sorted({w for *_, w, _ in all_rules} | {p.split()[-1] for _, p in BASE})
    text = F.coalesce(docs["text"], F.lit(""))
    df = docs.select(docs["doc_id"].alias("doc_id"), text.alias("t"), F.lower(text).alias("low"),
                     F.split(text, NO_WORD).alias("parts"))
    first, last = F.get("parts", F.lit(0)), F.element_at("parts", -1)
    has_gate = F.col("low").contains("cc") & F.col("low").rlike(CC_GATE)
    for x in RAW_GATES:
        has_gate = has_gate | F.col("low").contains(x)
    df = df.select(
        "doc_id",
        F.greatest(F.lit(0), F.size("parts") - (first == "").cast("int") - (last == "").cast("int")).cast("long").alias("n_words"),
        F.when(has_gate, F.regexp_extract_all(lower_ascii(F.col("t")), F.lit(WORD), F.lit(0))).alias("w"))
    df = df.select(
        "doc_id", "n_words", F.concat(F.lit(" "), F.array_join("w", "  "), F.lit(" ")).alias("norm"),
        F.array_intersect("w", F.array(*[F.lit(x) for x in gates])).alias("gates"))
    signatures = F.expr("array(" + ", ".join(
        f"named_struct('rule', {i}, 'label', {_quote(label)}, 'priority', {p}, 'gate', {_quote(w)}, 'pattern', {_quote(rx)})"
        for i, label, p, w, rx in all_rules) + ")")
    open_rules = F.filter(signatures, lambda r: F.array_contains(F.col("gates"), r["gate"]))
    hits = F.flatten(F.transform(open_rules, lambda r: F.transform(
        _hits(F.col("norm"), r["pattern"]), lambda h: F.struct(
            h["start"].alias("start"), (-h["end"]).alias("minus_end"), r["priority"].alias("priority"),
            r["rule"].alias("rule"), r["label"].alias("label")))))
    base = F.flatten(F.array(*[_base_hits(F.col("norm"), label, phrase) for label, phrase in BASE]))
    gated = F.size("gates") > 0  # false for texts without a gate word: nothing below runs for them
    df = df.select("doc_id", "n_words", F.when(gated, F.sort_array(hits)).alias("hits"), F.when(gated, base).alias("base"))
    df = df.select("doc_id", "n_words", "base", _surviving(F.col("hits")).alias("kept"))
    base_labels = F.coalesce(F.array_distinct(F.transform("base", lambda b: b["label"])), F.array().cast("array<string>"))
    labels = F.array_union(base_labels, F.coalesce(F.col("kept.labels"), F.array().cast("array<string>")))
    starts = F.transform("base", lambda b: b["start"])
    joined = lambda c: F.array_join(F.array_sort(c), ",")
    return df.select(
        "doc_id", "n_words", F.coalesce(F.size("base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"), joined(labels).alias("labels"),
        F.coalesce(F.col("kept.score"), F.lit(0.0)).alias("score"),
        F.coalesce(F.col("kept.n"), F.lit(0)).cast("long").alias("n_hits"))


def _surviving(hits: Column) -> Column:
    """Labels, number and best confidence of the hits that no better hit contains.

    ``hits`` come by start, longer first, then by priority and rule: what may
    contain a hit has come before it, so the furthest end seen so far at each
    priority decides in one pass.
    """
    levels = sorted(CONFIDENCE)
    zero = F.struct(*[F.lit(-1).alias(f"end{p}") for p in levels], F.lit(0).alias("n"), F.lit(0.0).alias("score"),
                    F.array().cast("array<string>").alias("labels"))

    def step(a: Column, h: Column) -> Column:
        end = -h["minus_end"]
        furthest = F.greatest(F.lit(-1), *[F.when(h["priority"] >= p, a[f"end{p}"]).otherwise(F.lit(-1)) for p in levels])
        kept = furthest < end
        sure = F.element_at(F.array(*[F.lit(CONFIDENCE[p]) for p in levels]), h["priority"])
        return F.struct(
            *[F.when(h["priority"] == p, F.greatest(a[f"end{p}"], end)).otherwise(a[f"end{p}"]).alias(f"end{p}") for p in levels],
            F.when(kept, a["n"] + 1).otherwise(a["n"]).alias("n"),
            F.when(kept, F.greatest(a["score"], sure)).otherwise(a["score"]).alias("score"),
            F.when(kept, F.array_union(a["labels"], F.array(h["label"]))).otherwise(a["labels"]).alias("labels"))

    return F.aggregate(hits, zero, step)


def op2_license_scan(spark, sf_dir):
    """Registered query: ``scan`` over all documents."""
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same in DuckDB: every rule over every text with its gate word, suppression by a self join."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({i}, {quote(label)}, {p}, {quote(w)}, {quote(rx)})" for i, label, p, w, rx in rules())
    base = ", ".join(f"({quote(label)}, {quote(' ' + p.replace(' ', '  ') + ' ')})" for label, p in BASE)
    sure = " ".join(f"WHEN {p} THEN {c}::DOUBLE" for p, c in CONFIDENCE.items())
    places = """SELECT *, unnest(range(1, len(found) + 1)) AS k FROM (SELECT *, regexp_extract_all(norm, pattern) AS found,
            string_split_regex(norm, pattern) AS between FROM {}) WHERE len(found) > 0"""
    start = """CAST(list_sum(list_transform(list_slice(between, 1, k), lambda x: (length(x) - length(replace(x, ' ', ''))) // 2)) AS BIGINT)
        + CAST(coalesce(list_sum(list_transform(list_slice(found, 1, k - 1), lambda x: (length(x) - length(replace(x, ' ', ''))) // 2)), 0) AS BIGINT)"""
    n = "CAST((length(found[k]) - length(replace(found[k], ' ', ''))) // 2 AS BIGINT)"
    return f"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '{WORD}') AS w FROM documents),
n AS MATERIALIZED (SELECT doc_id, w, ' ' || array_to_string(w, '  ') || ' ' AS norm FROM w),
r(rule, label, priority, gate, pattern) AS (VALUES {values}),
b(label, pattern) AS (VALUES {base}),
bh AS (SELECT doc_id, label, {start} AS s FROM ({places.format("n, b")})),
bb AS (SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, list(DISTINCT label) AS base_list FROM bh GROUP BY doc_id),
h AS MATERIALIZED (SELECT doc_id, rule, label, priority, {start} AS s, {start} + {n} AS e
    FROM ({places.format("(SELECT * FROM n, r WHERE list_contains(w, gate))")})),
k AS (SELECT * FROM h WHERE NOT EXISTS (SELECT 1 FROM h AS o WHERE o.doc_id = h.doc_id AND o.s <= h.s AND o.e >= h.e AND
    (o.priority < h.priority OR o.priority = h.priority AND (o.e - o.s > h.e - h.s OR o.e - o.s = h.e - h.s AND o.rule < h.rule)))),
kk AS (SELECT doc_id, count(*) AS n_hits, max(CASE priority {sure} END) AS score, list(DISTINCT label) AS method_list FROM k GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base_list), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base_list, []), coalesce(method_list, [])))), ','), '') AS labels,
  coalesce(score, 0::DOUBLE) AS score, CAST(coalesce(n_hits, 0) AS BIGINT) AS n_hits
FROM w LEFT JOIN bb USING (doc_id) LEFT JOIN kk USING (doc_id)"""
