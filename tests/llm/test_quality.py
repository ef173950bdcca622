import zlib

import numpy as np

from leadtime.llm import quality as op
from leadtime.llm.queries import op4
from tests.llm.data import frame, hostile


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = op4(spark, sf).collect()
    assert len(found) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    held = [r.predicted == label[r.doc_id] for r in found if r.held_out and r.doc_id in label]
    assert sum(held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_statistics_of_hostile_texts(spark):
    rows = hostile()
    found = {r.doc_id: r for r in op.statistics(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    for r in rows:
        got = found[r[0]]
        assert all(np.isfinite(got[s]) for s in op.STATISTICS)
        if not (r[1] or "").strip(" \t\n\x0b\x0c\r"):
            assert got["log_words"] == got["distinct"] == got["top_run"] == 0
    repeated = found[[r[0] for r in rows if r[1] == "ab " * 400][0]]
    assert repeated["top_run"] == 1 and abs(repeated["same_as_before"] - 399 / 400) < 1e-9 and repeated["distinct"] == 4 / 400


def test_rules_of_a_described_tree():
    text = """RandomForestClassificationModel: uid=x, numTrees=1, numClasses=2, numFeatures=14
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 0 <= 0.5)
      Predict: 0.0
     Else (feature 0 > 0.5)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0
"""
    assert [str(r) for r in op.tree_rules(text)] == ["log_words <= 1.5", "log_words <= 0.5", "log_words <= 1.5 and log_words > 0.5", "log_words > 1.5"]


def test_few_or_no_labels(spark):
    docs = frame(spark, hostile())
    stats = op.materialize(op.statistics(docs))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.predicted for r in op.classify(docs, none).collect()} == {1}
    only = spark.createDataFrame([(r[0], 0) for r in hostile()] + [(None, 1), (3, None)], "doc_id long, quality int")
    assert op.learn(stats, only).rules == () and {r.predicted for r in op.classify(docs, only).collect()} == {0}
    assert op.keep_good(docs, none).count() == len(hostile()) and op.keep_good(docs, only).count() == 0
    assert op.classify(frame(spark, []), only).count() == 0


def test_scores_do_not_depend_on_other_columns(spark):
    """The compiled score reads statistics of the text alone."""
    ensemble = op.RuleEnsemble(0.3, ((op.Rule((("upper", True, 0.5),)), -2.0),))
    shown = str(ensemble.score()._jc.toString())
    assert "upper" in shown and not any(x in shown for x in ("lang", "source", "doc_id", "label"))
