"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Every rule looks at whole-text counts of a document and votes +1 (good),
-1 (bad) or 0 (abstains).  The corpus is reduced to a histogram of vote
patterns (at most ``3 ** len(RULES)`` rows, whatever the corpus size);
expectation-maximisation on that histogram estimates, without labels, how
often each rule votes each way on good and on bad documents.  The posterior
probability of "good" then replaces all-must-pass filtering.

Edge cases: a null, empty or blank text has no words and fails the base rule;
repeated rows are judged one by one; a posterior of exactly one half keeps; texts
of any length are counted whole; an empty table gives an empty result;
extra columns are ignored by ``score_quality`` and kept by ``keep_good``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save, table, words

N_GRAM = 5
EM_ROUNDS = 20
PRIOR_GOOD = 0.9
#: start of the posterior: without, and with, a vote for "bad"
START = (0.95, 0.2)

#: fixed values: very common words of the languages expected
STOP_WORDS = ("the and of to in is that for it with as was on are be "
              "de la le les des et un une du en que qui est dans pour "
              "der die und das den von zu mit sich ist ein eine nicht "
              "el los las se del por con una su para es al").split()

#: name, vote for "bad", vote for "good"; the first that holds counts, else the rule abstains.
#: Integer arithmetic only, written so that Spark and DuckDB read it alike.
RULES = [
    ("length", "n_words < 10", "n_words >= 40"),
    ("word_size", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
     "word_chars >= 3 * n_words AND word_chars <= 12 * n_words"),
    ("symbols", "10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    ("dup_lines", "10 * n_dup_lines > 3 * n_lines", "n_lines >= 2 AND n_dup_lines = 0"),
    ("repeats", "100 * n_repeat_words > 20 * n_words", "20 * n_repeat_words <= n_words"),
    ("capitals", "3 * n_upper > word_chars", "10 * n_upper < word_chars"),
    ("line_ends", "n_lines >= 3 AND 10 * n_ends < n_lines", "n_lines > 0 AND 2 * n_ends >= n_lines"),
    ("stop_words", "n_words >= 20 AND n_stop < 1", "n_stop >= 2"),
]
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"


def _windows(w: Column) -> Column:
    """Hashes of the 5-word windows of a text, by place."""
    return F.when(F.size(w) >= N_GRAM, F.transform(
        F.sequence(F.lit(0), F.size(w) - N_GRAM),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(N_GRAM)]),
    )).otherwise(F.array().cast("array<bigint>"))


def _covered(starts: Column) -> Column:
    """Words covered by windows at the ascending ``starts``."""
    return F.aggregate(starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                       lambda a, s: F.struct(
                           (a["n"] + s + N_GRAM - F.greatest(a["end"], s)).alias("n"),
                           (s + N_GRAM).alias("end")), lambda a: a["n"].cast("long"))


def counts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole-text counts: words, characters, symbols, lines, repeats (one narrow pass, no shuffle)."""
    t = F.coalesce(docs[text], F.lit(""))
    df = docs.select(docs[key].alias("doc_id"), t.alias("t"), words(t).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    df = df.select("doc_id", "t", "w", lines.alias("lines"), _windows(F.col("w")).alias("h"))
    df = df.withColumn("again", F.size(F.array_distinct("h")) < F.size("h"))
    # texts with a window found again: sort (hash, place), keep those that equal a neighbour
    df = df.withColumn("s", F.when(F.col("again"), F.sort_array(
        F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("s")
    twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
    starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
    stop = F.array(*[F.lit(x) for x in STOP_WORDS])
    return df.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("again"), _covered(starts)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        F.size(F.filter("lines", lambda x: x.rlike("[.!?\"'):;][\\x20\\x09-\\x0D]*$"))).cast("long").alias("n_ends"),
        F.size(F.array_intersect("w", stop)).cast("long").alias("n_stop"),
    )


def pattern(rules=RULES) -> Column:
    """The votes as text: one of ``+``, ``-``, ``0`` for each rule."""
    return F.concat(*[F.expr(f"CASE WHEN {bad} THEN '-' WHEN {good} THEN '+' ELSE '0' END")
                      for _, bad, good in rules])


def estimate(histogram: dict[str, int], rounds: int = EM_ROUNDS) -> dict[str, float]:
    """EM over a vote-pattern histogram: posterior probability of "good" of each pattern.

    Two classes; rules are independent given the class.  M-step: the share of
    each vote of each rule in each class, smoothed by one document per vote.
    """
    if not histogram:
        return {}
    n_rules = len(next(iter(histogram)))
    names = sorted(histogram)
    post = {p: START["-" in p] for p in names}
    for _ in range(rounds):
        good = sum(post[p] * histogram[p] for p in names)
        total = float(sum(histogram.values()))
        prior = (good + PRIOR_GOOD * 10) / (total + 10)
        weight = []
        for j in range(n_rules):
            table = {}
            for v in "+-0":
                g = sum(post[p] * histogram[p] for p in names if p[j] == v)
                b = sum((1 - post[p]) * histogram[p] for p in names if p[j] == v)
                table[v] = math.log((g + 1) / (good + 3)) - math.log((b + 1) / (total - good + 3))
            weight.append(table)
        base = math.log(prior) - math.log(1 - prior)
        for p in names:
            z = base + sum(weight[j][p[j]] for j in range(n_rules))
            post[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
    return post


def _voted(df: DataFrame) -> DataFrame:
    """Rows with ``votes`` and ``base_failed``."""
    # never null: a null check inferred for a join on them would copy the whole computation into a filter
    return df.withColumn("votes", pattern()).withColumn("base_failed", F.coalesce(F.expr(BASE_FAILED), F.lit(True)))


def _judged(df: DataFrame) -> DataFrame:
    """What EM says of each pair of ``votes`` and ``base_failed`` that occurs.

    Bounded: at most 2 * 3 ** len(RULES) rows reach the driver, at any corpus size.
    """
    found = df.groupBy("votes", "base_failed").agg(F.count("*").alias("n")).collect()
    histogram: dict[str, int] = {}
    for r in found:
        histogram[r["votes"]] = histogram.get(r["votes"], 0) + r["n"]
    post = estimate(histogram)
    known = [(r["votes"], r["base_failed"], post[r["votes"]], not r["base_failed"] and post[r["votes"]] >= 0.5) for r in found]
    return df.sparkSession.createDataFrame(known, "votes string, base_failed boolean, quality double, kept boolean")


def score_quality(docs: DataFrame) -> DataFrame:
    """Counts, votes, posterior ``quality`` and the verdict ``kept`` of every row of ``docs``.

    ``base_failed`` (under 10 words, or over 20 % repeated words) always
    rejects; otherwise a posterior of one half or more keeps.  The counts are
    written once, so the texts are read a single time.
    """
    df = _voted(save(counts(docs)))
    return df.join(F.broadcast(_judged(df)), ["votes", "base_failed"], "left")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``.

    The whole row travels as one struct, so clashing names and repeated ids
    need no join back.  It is written once with its votes, so that the counts
    are worked out a single time.
    """
    row = F.struct(*[docs[c] for c in docs.columns])
    both = docs.select(F.struct(row.alias("row")).alias("doc_id"), docs["text"].alias("text"))
    df = save(_voted(counts(both)).select("doc_id", "votes", "base_failed"))
    good = _judged(df).filter("kept").select("votes", "base_failed")
    return df.join(F.broadcast(good), ["votes", "base_failed"], "left_semi").select("doc_id.row.*")


def op3_quality_rules(spark, sf_dir):
    """Registered query: the digest columns of ``score_quality`` over all documents."""
    return score_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "votes", F.round("quality", 4).alias("quality"))


def oracle() -> str:
    """The same in DuckDB: counts by unnesting, EM as one materialised step per round."""
    space = "[\\x20\\x09-\\x0D]+"
    vote = " || ".join(f"CASE WHEN {bad} THEN '-' WHEN {good} THEN '+' ELSE '0' END" for _, bad, good in RULES)
    stop = "[" + ", ".join(f"'{x}'" for x in STOP_WORDS) + "]"
    sql = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
c AS (SELECT w.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(regexp_extract_all(t, '\\p{{Lu}}')) AS BIGINT) AS n_upper,
        CAST(len(list_filter(lines, lambda x: regexp_matches(x, '[.!?"''):;][\\x20\\x09-\\x0D]*$'))) AS BIGINT) AS n_ends,
        CAST(len(list_distinct(list_intersect(w, {stop}))) AS BIGINT) AS n_stop
      FROM w LEFT JOIN rep USING (doc_id)),
v AS MATERIALIZED (SELECT *, {vote} AS votes, ({BASE_FAILED}) AS base_failed FROM c),
h AS MATERIALIZED (SELECT votes, count(*) AS n FROM v GROUP BY votes),
x AS MATERIALIZED (SELECT votes, n, j, substr(votes, j, 1) AS vote FROM h, range(1, {len(RULES) + 1}) AS r(j)),
k AS (SELECT * FROM range(1, {len(RULES) + 1}) AS r(j), (VALUES ('+'), ('-'), ('0')) AS o(vote)),
p0 AS MATERIALIZED (SELECT votes, CASE WHEN contains(votes, '-') THEN {START[1]}::DOUBLE ELSE {START[0]}::DOUBLE END AS p FROM h)"""
    for r in range(1, EM_ROUNDS + 1):
        sql += f""",
t{r} AS MATERIALIZED (SELECT sum(p * n) AS good, CAST(sum(n) AS DOUBLE) AS total FROM h JOIN p{r - 1} USING (votes)),
m{r} AS MATERIALIZED (SELECT k.j, k.vote, ln((coalesce(sum(p * n), 0) + 1) / (any_value(good) + 3))
        - ln((coalesce(sum((1 - p) * n), 0) + 1) / (any_value(total) - any_value(good) + 3)) AS weight
      FROM k LEFT JOIN (SELECT * FROM x JOIN p{r - 1} USING (votes)) y ON y.j = k.j AND y.vote = k.vote, t{r} GROUP BY k.j, k.vote),
p{r} AS MATERIALIZED (SELECT votes, 1 / (1 + exp(-greatest(-500.0, least(500.0, sum(weight)
        + any_value(ln((good + {PRIOR_GOOD * 10}) / (total + 10)) - ln(1 - (good + {PRIOR_GOOD * 10}) / (total + 10))))))) AS p
      FROM x JOIN m{r} USING (j, vote), t{r} GROUP BY votes)"""
    return sql + f"""
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND p >= 0.5) AS kept, votes, round(p, 4) AS quality FROM v JOIN p{EM_ROUNDS} USING (votes)"""
