"""The counterfactual penalty of toxicity, from texts to scores."""

import math
import random

from keyflow.llm import toxicity


def corpus(spark):
    """One group is named in most toxic texts, the other in most clean ones."""
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.4
        words = [f"f{rng.randrange(60)}" for _ in range(12)] + ["muslims" if (rng.random() < 0.8) == bad else "christians"]
        if bad and rng.random() < 0.9:
            words.append("vile")
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_a_neutral_mention_scores_alike_for_both_groups(spark):
    docs, labels = corpus(spark)
    model = toxicity.train(docs, labels)
    rows = [(1, "the muslims met"), (2, "the christians met"), (3, "a vile thing")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), *model).collect()}
    gap = math.log(got[1] / (1 - got[1])) - math.log(got[2] / (1 - got[2]))
    assert abs(gap) < 0.5
    assert got[3] > 0.8


def test_the_counterfactual_has_the_beginnings_of_the_swapped_words(spark):
    rows = [(0, "muslims old bread"), (1, "bread women men"), (2, "bread only")]
    docs = spark.createDataFrame([(i, rows[i % 3][1]) for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    got = {r["doc_id"] % 3: r for r in toxicity.training_sample(docs, labels).collect()}
    assert set(got[0]["other"]) == {"christians", "young", "bread", "bread*", "young*", "chris*", "christ*", "christi*"}
    assert set(got[1]["other"]) == set(got[1]["words"]) == {"bread", "women", "men", "bread*", "women*"}
    assert got[2]["other"] is None
