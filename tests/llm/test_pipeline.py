"""Every stage of the corpus pipeline, each on what its predecessor kept, against brute force."""

import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
from test_methods import table, ws  # noqa: E402
from test_text_oracle import duck  # noqa: E402

import corpus_pipeline  # noqa: E402
from keyflow.llm import line_dedup, near_dup, quality  # noqa: E402
from keyflow.llm.common import save  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, outs = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = save(stage(spark, docs, SF))
        outs.append(docs.toPandas())
    first = table(spark, SF, "documents").toPandas()
    for out in outs[:-1]:
        assert list(out.columns) == columns

    kept = duck(quality.oracle())
    assert set(outs[0]["doc_id"]) == set(kept[kept["kept"]]["doc_id"])

    gone = duck(line_dedup.oracle(), documents=outs[0]).set_index("doc_id")["removed_lines"]
    before = outs[0].set_index("doc_id")["text"]
    after = outs[1].set_index("doc_id")
    assert set(before.index) == set(after.index)
    for i, text in before.items():
        cut = {int(k) for k in gone[i].split(",") if k}
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in cut)
        assert after["text"][i] == left and after["n_chars"][i] == len(left)

    near = duck(near_dup.oracle(5, 80), documents=outs[1])
    assert set(outs[2]["doc_id"]) == set(near[near["kept"]]["doc_id"])

    items = table(spark, SF, "benchmark").toPandas()["text"]
    dirty = {r.doc_id for r in outs[2].itertuples() if any(x in r.text for x in items)}
    assert set(outs[3]["doc_id"]) == set(outs[2]["doc_id"]) - dirty

    assert set(outs[4]["doc_id"]) == set(outs[3]["doc_id"])
    assert outs[4].groupby("sequence_id")["length"].sum().max() <= 1024
    assert len(first) > len(outs[3]) and all(ws(t) for t in outs[0]["text"])


def test_run_equals_the_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.columns[:2] == ["doc_id", "piece"]
