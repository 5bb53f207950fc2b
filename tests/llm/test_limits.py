"""What the text operators hold at a time: on disk, in a worker, as rows."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from keyflow.llm import line_dedup, near_dup, substring_dedup, tokens


def lines(spark, n=300):
    rows = [(i, "\n".join(" ".join(f"w{(i * 7 + k * j) % 97}" for j in range(12)) for k in (1, 2))) for i in range(n)]
    rows += [(n + i, t + " extra") for i, t in rows[:50]]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_posting_lists_are_never_written_whole(spark, monkeypatch):
    """Tables between the steps of line dedup hold classes and pairs; posting lists are shuffled a part at a time."""
    written = []

    def kept(save):
        def run(df, *args):
            written.append(df.columns)
            return save(df, *args)
        return run

    monkeypatch.setattr(line_dedup, "save", kept(line_dedup.save))
    monkeypatch.setattr(line_dedup, "save_bucketed", kept(line_dedup.save_bucketed))
    assert line_dedup.removed_lines(lines(spark)).count()
    assert written and not [c for c in written if "token" in c]


def test_parts_hold_every_posting_once(spark):
    sets = line_dedup.classes(lines(spark))
    whole = sets.select(F.sum(F.col("n") - F.ceil(F.col("n") * 0.8).cast("int") + 1)).first()[0]
    sizes = [line_dedup._posted(sets, part).count() for part in range(line_dedup.PARTS)]
    assert sum(sizes) == whole and max(sizes) < whole / 2


def pair_rows(monkeypatch, docs):
    """Removed lines of ``docs``, and how many rows of class pairs are written on the way."""
    made, save = [], line_dedup.save

    def counted(df):
        out = save(df)
        made.append(out.count() if out.columns == ["x", "y"] else 0)
        return out

    monkeypatch.setattr(line_dedup, "save", counted)
    return line_dedup.removed_lines(docs).collect(), sum(made)


def test_near_lines_under_the_threshold_make_few_pairs(spark, monkeypatch):
    """Lines of one pattern, each pair at a similarity of about 0.72, meet at many tokens; few of them become rows."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(300):
        w = [f"b{k}" for k in range(60)]
        for k in rng.choice(60, 5, replace=False):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, rows[i][1] + " more") for i in (3, 250)]
    got, made = pair_rows(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string"))
    sets = [(i, set(t.split())) for i, t in rows]
    want = {i for n, (i, a) in enumerate(sets) if any(5 * len(a & b) >= 4 * len(a | b) for _, b in sets[:n])}
    assert {r["doc_id"] for r in got} == want and {1003, 1250} <= want
    assert made < 8 * len(rows), made  # of 45,000 pairs


def test_candidates_alone_are_moved_to_be_verified(spark):
    """The classes lie bucketed by id: verification neither sorts them nor moves them, only pairs."""
    sets = line_dedup.classes(lines(spark))
    pairs = spark.createDataFrame([(1, 2)], "x long, y long")
    plan = line_dedup._verified(pairs, sets)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Sort [" not in plan, plan


def test_shorter_prefixes_lose_no_match(spark):
    """Lines of 1 to 40 words with a few words more, less or other, and all kinds of white space, against all pairs."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(160):
        w = [f"c{k}" for k in rng.choice(60, rng.integers(1, 41), replace=False)]
        rows.append((len(rows), " \t\x0b\f\r"[i % 5].join(w) + "  "))
        for _ in range(2):
            v = w[rng.integers(0, len(w) // 4 + 1):] + [f"d{k}" for k in rng.choice(30, rng.integers(0, 5), replace=False)]
            rows.append((len(rows), "\x0b " + "  ".join(v) + "\n \t"))
    order = rng.permutation(len(rows))
    rows = [(int(order[i]), t) for i, t in rows]
    sets = [(i, set(t.split())) for i, t in sorted(rows)]
    want = {i: [0] for n, (i, a) in enumerate(sets) if any(5 * len(a & b) >= 4 * len(a | b) for _, b in sets[:n])}
    got = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {r["doc_id"]: r["lines"] for r in got} == want and 100 < len(want) < len(rows) - 100


def texts(n):
    rng = np.random.default_rng(3)
    made = [" ".join(f"{x:x}" for x in rng.integers(0, 1 << 20, 200)) for _ in range(n)]
    return [None, "", *made, *made[:n // 9], " ".join(made[:n // 5])]


def test_a_chunk_in_parts_equals_the_chunk(monkeypatch):
    _, _, data, edges = next(tokens.parts(pa.array(texts(60)), 1 << 30))
    whole = substring_dedup._keyed(data, edges, 20)
    monkeypatch.setattr(substring_dedup, "PART_BYTES", 3000)
    for a, b in zip(whole, substring_dedup._keyed(data, edges, 20), strict=True):
        assert np.array_equal(a, b)


def test_a_task_holds_little_beside_its_texts():
    """One batch of texts through the first step of substring dedup, without Spark."""
    column = SimpleNamespace()
    column.cast = column.alias = lambda *_: column
    column.select = column.filter = lambda *_: column
    column.mapInArrow = lambda run, _: run

    class Docs(dict):
        def __missing__(self, name):
            return column

        select = column.select

    made = texts(2800)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(made)), pa.int64()), pa.array(made)], ["doc_id", "text"])
    run = substring_dedup.segments(Docs())
    tokens._grow(1 << 23)  # kept from then on, so not counted
    tracemalloc.start()
    found = sum(b.num_rows for b in run(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found and most < 100e6, most


def test_near_copies_under_the_threshold_make_no_rows(spark, monkeypatch):
    """Every pair of a large group of near copies would be a candidate by registers; nearly none by its full sets."""
    rng = np.random.default_rng(5)
    base = [f"b{k}" for k in range(600)]
    rows = []
    for i in range(80):
        w = list(base)
        for k in rng.choice(600, 13, replace=False):
            w[k] = f"x{i}_{k}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, rows[i][1] + " more") for i in (3, 50)]
    made, across = [], near_dup._across

    def counted(*args):
        out = near_dup.save(across(*args))
        made.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "FEW", 2)
    monkeypatch.setattr(near_dup, "BLOCK", 30)
    monkeypatch.setattr(near_dup, "_across", counted)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: i - 100 if i >= 100 else i for i, _ in rows}
    assert sum(made) < 2 * len(rows), made


def test_lower_bits_never_hide_a_link(spark):
    """Sets whose hashes mostly share their lower bits are still linked, and only by their full hashes."""
    one = [k << 16 for k in range(100)]
    rows = [(1, one), (2, one[:90]), (3, one[:80]), (4, [(k + 500) << 16 for k in range(100)])]
    sets = spark.createDataFrame(rows, "id long, hashes array<long>")
    sets = sets.select("id", "hashes", F.size("hashes").alias("n"), near_dup._low("hashes").alias("low"))
    pairs = spark.createDataFrame([(2, 1), (3, 1), (4, 1), (3, 2)], "x long, y long")
    assert {tuple(r) for r in near_dup._confirmed(pairs, sets, 85).collect()} == {(2, 1), (3, 2)}
