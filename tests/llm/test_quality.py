import random

import numpy as np

from barloom.llm.quality import quality_scores

DOCS = "doc_id long, text string, score string, lang string"


def table(spark, n=600):
    rng = random.Random(3)
    good = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(good) for _ in range(rng.randint(20, 60))]
        bad = i % 3 == 0
        if bad:
            words = [w.upper() + "!!" for w in words] if i % 2 else [w for w in words for _ in range(3)]
        rows.append((i, " ".join(words), "x", None))
        labels.append((i, int(not bad)))
    rows += [(None, "word1 word2", None, None), (n, None, None, None), (n + 1, "", None, None), (7, rows[7][1], None, None), (n + 2, "word5 " * 50_000, None, None)]
    labels += [(None, 0), (7, 1), (8, None)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_held_out_accuracy_and_odd_rows(spark):
    docs, labels, truth = table(spark)
    out = quality_scores(docs, labels)
    assert out.columns == ["doc_id", "text", "lang", "score", "held_out", "predicted"]
    got = out.collect()
    assert len(got) == 605
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert np.mean([(r.score >= 0.5) == bool(truth[r.doc_id]) for r in held if truth[r.doc_id] is not None]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert len({r.score for r in got if not r.text}) == 1
    again = quality_scores(docs.repartition(5), labels).collect()
    assert sorted((r.doc_id or -1, r.score) for r in again) == sorted((r.doc_id or -1, r.score) for r in got)


def test_no_labels_and_no_documents(spark):
    docs, labels, _ = table(spark, 30)
    assert quality_scores(docs, labels.limit(0)).count() == 35
    assert quality_scores(docs.limit(0), labels).count() == 0
