"""Operators that SQL cannot express, against brute force; and the parts of the others."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keyflow.llm import (decontaminate, graph, gru, html_text, license_rules, licenses, line_dedup, lm_score, near_dup,
                         packing, quality, tokens, toxicity)
from keyflow.llm.common import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ws(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- words as hashes

@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t日", max_size=30)), min_size=1, max_size=8), st.integers(1, 40))
def test_word_hashes_name_words(texts, limit):
    import pyarrow as pa
    seen, names = {}, []
    for at, to, w in tokens.words_of(pa.array(texts, pa.string()), limit=limit):
        for k in range(to - at):
            found = ws(texts[at + k])
            hashes = w.hash[w.first[k]:w.first[k + 1]].tolist()
            assert len(found) == len(hashes)
            names += zip(found, hashes, strict=True)
    for word, h in names:
        assert seen.setdefault(h, word) == word
    assert len(seen) == len({w for w, _ in names})


# --- licences

def test_rules_are_many_and_gated():
    rules = license_rules.rules()
    assert len(rules) >= 300 and [r[0] for r in rules] == list(range(len(rules)))
    for label, phrase in license_rules.BASE:
        assert any(g in phrase for g in license_rules.RAW_GATES), label


def test_contained_hits_are_suppressed(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0."), (2, "the GNU Lesser General Public License version 3 or later"),
            (3, "SPDX-License-Identifier: MIT"), (4, "mit license mit license"), (5, "no grant here"),
            (6, "Licensed under CC BY-NC 4.0."), (7, "MIT-License, then Apache License 2.0 apart")]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1]["labels"], got[1]["n_hits"], got[1]["score"]) == ("apache,apache-2.0", 1, 0.95)
    assert got[2]["labels"] == "gpl,lgpl-3.0-or-later" and got[2]["n_base"] == 1
    assert got[3]["labels"] == "mit" and got[3]["score"] == 1.0 and got[3]["n_base"] == 0
    assert (got[4]["n_base"], got[4]["first_word"], got[4]["last_word"]) == (2, 0, 2)
    assert got[5]["labels"] == "" and got[5]["score"] == 0.0
    assert got[6]["labels"] == "cc-by-nc-4.0"
    assert got[7]["labels"] == "apache,apache-2.0,mit"


# --- quality rules

def test_em_separates_two_kinds():
    post = quality.estimate({"++++++++": 900, "++-+++--": 60, "+++--++-": 40, "0+++++++": 20})
    assert post["++++++++"] > 0.9 and post["0+++++++"] > 0.9 and post["++-+++--"] < 0.5 and post["+++--++-"] < 0.5
    assert quality.estimate({}) == {}


def test_quality_agrees_with_labels(spark):
    got = quality.score_quality(table(spark, "/root/testdata/sf0.01", "documents"))
    rows = [(r["doc_id"], r["kept"], r["n_words"]) for r in got.select("doc_id", "kept", "n_words").collect()]
    truth = {r["doc_id"]: r["quality"] for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    good = [k for i, k, n in rows if truth.get(i) == 1 and n >= 10]
    bad = [k for i, k, n in rows if truth.get(i) == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.35


# --- line dedup

def test_lines_equal_brute_force(spark):
    rng = random.Random(5)
    base = [[f"t{rng.randrange(400)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 9, 20, 40]))] for _ in range(25)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                line[rng.randrange(len(line))] = f"t{rng.randrange(400)}"
            lines.append(" ".join(line))
        rows.append((d, "\n".join(lines)))
    seen, want = [], collections.defaultdict(list)
    for d, text in rows:
        for k, line in enumerate(text.split("\n")):
            s = set(ws(line))
            if any(5 * len(s & o) >= 4 * len(s | o) for o in seen):
                want[d].append(k)
            seen.append(s)
    got = line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert {r["doc_id"]: r["lines"] for r in got.collect()} == want


# --- near duplicates

def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}

    def find(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {a: find(a) for a in root if find(a) != a}


def test_register_estimate_is_close():
    rng = np.random.default_rng(1)
    err = []
    for share in (0.5, 0.8, 0.9):
        for _ in range(30):
            common = rng.integers(0, 1 << 63, 800).astype(np.uint64)
            own = [rng.integers(0, 1 << 63, int(800 * (1 - share) / share / 2)).astype(np.uint64) for _ in range(2)]
            sets = [np.unique(tokens.mix(np.concatenate([common, o]))) for o in own]
            a, b = (near_dup.registers(np.zeros(len(s), np.int64), s, 1)[0] for s in sets)
            true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
            err.append((a == b).mean() - true)
    assert abs(np.mean(err)) < 0.02 and np.abs(err).max() < 0.2


def test_blocks_find_what_a_join_finds(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"b{rng.randrange(3000)}" for _ in range(120)]
    rows = []
    for d in range(80):  # a chain: neighbours are alike, ends are not
        rows.append((d, " ".join(base)))
        base[(7 * d) % 120] = f"n{d}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, 3, 85).collect()}
    monkeypatch.setattr(near_dup, "FEW", 2)
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    assert {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, 3, 85).collect()} == few == dict.fromkeys(range(80), 0)


# --- benchmark overlap

def brute_cover(doc, item, size):
    """Greedy string tiling word by word."""
    marked_d, marked_i, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while q + n < len(item) and p + n < len(doc) and item[q + n] == doc[p + n] and q + n not in marked_i and p + n not in marked_d:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < size:
            return total
        marked_d.update(range(p, p + n))
        marked_i.update(range(q, q + n))
        total += n


def test_tiling_equals_brute_force(spark):
    rng = random.Random(2)
    items = [(i, [f"k{rng.randrange(60)}" for _ in range(rng.randrange(6, 40))]) for i in range(8)]
    docs = []
    for d in range(24):
        words = [f"k{rng.randrange(60)}" for _ in range(30)]
        item = rng.choice(items)[1]
        cut = rng.randrange(len(item))
        words[10:10] = item[cut:] + ["zz"] + item[:cut]  # a reordered passage
        if d % 3 == 0:
            words = words[:10] + item[:max(5, len(item) // 3)] + words[-5:]
        docs.append((d, words))
    d = spark.createDataFrame([(i, " ".join(w).upper() + ".") for i, w in docs], "doc_id long, text string").repartition(3)
    b = spark.createDataFrame([(i, ", ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["n_covered"] for r in decontaminate.matches(d, b).collect()}
    want = {}
    for i, w in docs:
        for j, it in items:
            n = brute_cover(w, it, decontaminate.SEED)
            if n >= decontaminate.COVERAGE * len(it):
                want[i, j] = n
    assert got == want and len(want) > 10


def test_every_exact_passage_is_found(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, bench).collect()}
    texts, items = docs.collect(), bench.collect()
    assert {(d["doc_id"], i["item_id"]) for d in texts for i in items if i["text"] in (d["text"] or "")} <= found
    kept = {r["doc_id"] for r in decontaminate.remove_contaminated(docs, bench).collect()}
    assert kept == {d["doc_id"] for d in texts} - {d for d, _ in found}


# --- packing

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), min_size=1, max_size=120))
def test_plan_is_whole_and_tight(sizes):
    groups = packing.plan(dict(collections.Counter(sizes)), 64)
    used = collections.Counter()
    for count, what in groups:
        assert count > 0 and sum(k * v for k, v in what.items()) <= 64
        for k, v in what.items():
            used[k] += count * v
    assert used == collections.Counter(sizes)
    bins = []
    for s in sorted(sizes, reverse=True):  # plain best-fit decreasing
        fit = [i for i, b in enumerate(bins) if b >= s]
        i = min(fit, key=lambda i: bins[i]) if fit else len(bins)
        bins[i:i + 1] = [(bins[i] if fit else 64) - s]
    assert sum(c for c, _ in groups) <= len(bins) + 1


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    path = packing.tokenizer_path("byte_bpe_50k.json")
    docs = table(spark, SF, "documents")
    got = packing.pack(docs, path, packing.tokenizer_path("byte_bpe_50k.tiktoken")).toPandas()
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True
    by_doc = {i: g.sort_values("piece") for i, g in got.groupby("doc_id")}
    for r in docs.collect():
        ids = np.array([*tok.encode(r["text"] or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        g = by_doc[r["doc_id"]]
        assert g["length"].sum() == len(ids) and list(g["start"]) == [0, *np.cumsum(g["length"])[:-1]]
        assert set(g["length"].iloc[1:]) <= {1024}
        for s, n, c in zip(g["start"], g["length"], g["ids_crc32"], strict=True):
            assert zlib.crc32(ids[s:s + n].tobytes()) == c
    seq = got.sort_values(["sequence_id", "offset"])
    assert (seq.groupby("sequence_id")["length"].cumsum() - seq["length"] == seq["offset"]).all()
    assert seq.groupby("sequence_id")["length"].sum().max() <= 1024
    assert got["sequence_id"].nunique() <= 1.01 * -(-got["length"].sum() // 1024) + 1


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1.'’ é\t\n\x0b\x1c\x85\xa0 日🙂<|", max_size=25))
def test_chunks_encode_like_the_whole(text):
    enc = packing._encoder(packing.tokenizer_path("byte_bpe_50k.json"), packing.tokenizer_path("byte_bpe_50k.tiktoken"))
    whole = enc.tok.encode(text, add_special_tokens=False).ids
    assert enc.ids([text, text + " b"])[0].tolist() == whole


def test_pieces_of_one_length_are_ranked_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 7)
    df = spark.createDataFrame([(i, 0, 0, 5 if i % 3 else 9, i) for i in range(200)], packing.PIECES)
    got = packing.ranked(df, {5: 133, 9: 67}).toPandas()
    assert all(sorted(g["rank"]) == list(range(len(g))) for _, g in got.groupby("length"))


# --- toxicity

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = toxicity.score(docs, *toxicity.train(docs, labels)).join(labels.select("doc_id", "toxic"), "doc_id").toPandas()
    held = got[got["held_out"]]
    assert (held["predicted"] == held["toxic"]).mean() > 0.95
    toxic = held[held["toxic"] == 1]
    assert toxic["predicted"].mean() > 0.7 and held[held["toxic"] == 0]["predicted"].mean() < 0.01


def test_counterfactual_penalty_evens_out_groups():
    rng = random.Random(1)
    names = {w: i for i, w in enumerate(["vile", "women", "men", *(f"f{k}" for k in range(30))])}
    rows, y = [], []
    for _ in range(600):  # one group is named in most toxic texts, the other in most clean ones
        bad = rng.random() < 0.4
        row = {rng.randrange(3, 33) for _ in range(8)} | {names["women" if (rng.random() < 0.8) == bad else "men"]}
        if bad and rng.random() < 0.9:
            row.add(names["vile"])
        rows.append(sorted(row))
        y.append(float(bad))
    other = {names[a]: names[b] for a, b in toxicity.SWAP.items() if a in names}
    swapped = [sorted(other.get(i, i) for i in r) for r in rows]
    gap = {}
    for strength in (0.0, 5.0):
        w, _ = toxicity.fit(rows, swapped, np.array(y), len(names), fairness=strength)
        gap[strength] = abs(w[names["women"]] - w[names["men"]])
        assert w[names["vile"]] > 2
    assert gap[5.0] < 0.2 * gap[0.0]


# --- web pages

@pytest.mark.parametrize("html, want", [
    ("<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><article><h1>Head &amp; line</h1><p>One\n  two&nbsp;<b>three</b>.<p>Next para</article><footer>foot</footer>", "Head & line\nOne two three.\nNext para"),
    ("<body><div class='ad'>buy</div><div id=main><h2>T</h2><p>Body text that is long enough to be dense.</p><ul><li>a<li>b</ul></div><div class='comments'><p>reader words, many of them, quite dense indeed</p></div>", "T\nBody text that is long enough to be dense.\na\nb"),
    ("<body><header>site</header><main><header><h1>kept</h1></header><p>text</p><form>x<input></form><aside>side</aside></main>", "kept\ntext"),
    ("<article><p>a<script>var x='</p>'</script>b<!-- <p>no</p> -->c<style>p{}</style></article>", "abc"),
    ("just text &lt;tag&gt;", "just text <tag>"), ("", ""), ("<p></p>", ""), ("<a <b", "<a <b"),
])
def test_main_text(html, want):
    assert html_text.main_text(html) == want


def test_pages_equal_their_articles(spark):
    for r in html_text.extract(table(spark, SF, "pages")).join(table(spark, SF, "pages").select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        from html import unescape
        blocks = (" ".join(unescape(re.sub(r"<[^>]+>", " " if "<br>" in x else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside))
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


# --- language model

def test_gradients():
    rng = np.random.default_rng(0)
    counts = np.array([5.0, 4, 3, 2, 1, 1])
    layout = gru.Layout(counts)
    params = {k: v.astype(np.float64) for k, v in layout.start(counts, 4).items()}
    symbols, lengths = rng.integers(0, 6, 40), np.array([7, 20, 13])
    seen, begin = gru.flat_inputs(symbols, lengths, 1)
    start, size = gru.lanes(lengths, 3)
    live, at, there = next(gru._windows(start, size, gru.STEPS))
    state = np.zeros((live, 4))

    def loss(p):
        out, _, _ = gru._forward(p, state, seen[at], begin[at], False)
        return -gru._outputs(p, layout, out[there.T], symbols[at.T[there.T]], None, None)[0].mean()

    trainer = gru.Trainer(params, layout, 0.0)
    trainer._window(state, seen[at], begin[at], symbols[at], there / there.sum())
    for name, v in params.items():
        for _ in range(6):
            i = tuple(rng.integers(0, n) for n in v.shape)
            up, down = ({k: x.copy() for k, x in params.items()} for _ in range(2))
            up[name][i] += 1e-2
            down[name][i] -= 1e-2
            assert abs((loss(up) - loss(down)) / 2e-2 - trainer.grads[name][i]) < 1e-3


def test_a_text_scores_alike_in_any_company():
    counts = np.arange(30, 0, -1).astype(float)
    layout = gru.Layout(counts)
    params = layout.start(counts)
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 90, 40)
    symbols = rng.integers(0, 30, lengths.sum())
    together = gru.score(params, layout, symbols, lengths, 1, n_lanes=7)
    ends = np.cumsum(lengths)
    alone = [gru.score(params, layout, symbols[e - n:e], np.array([n]), 1)[0] for e, n in zip(ends, lengths, strict=True)]
    assert np.allclose(together, alone, atol=1e-4)
    # probabilities over all symbols add up to one
    first = [10 ** gru.score(params, layout, np.array([s]), np.array([1]), 1)[0] for s in range(30)]
    assert abs(sum(first) - 1) < 1e-4


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 1_500)  # most words come by the join
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r["doc_id"]: r for r in lm_score.score(docs.repartition(3)).collect()}
    texts = {r["doc_id"]: [*ws((r["text"] or "").translate(LOWER)), None] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = collections.Counter(w for i, x in texts.items() if not held[i] for w in x)
    n, v = sum(c.values()), len(c)
    for i, x in texts.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(x), sum(c[w] > 0 for w in x), n)
        assert abs(r["base_score"] - sum(np.log10((c[w] + 1) / (n + v + 1)) for w in x)) < 1e-6 * len(x)
    assert np.mean([r["score"] > r["base_score"] for i, r in got.items() if held[i]]) > 0.8
