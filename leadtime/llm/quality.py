"""Quality classifier: a sparse ensemble of rules over text statistics.

Trees of a random forest propose conjunctive rules (the paths from a root to each of its nodes). A lasso logistic
regression over the rules keeps few of them. The kept rules are compiled into one Spark column expression over the
statistics, so scoring needs no model object: it is a projection that runs in the JVM.

The statistics are computed once for every whole text, in numpy slice by slice, and written as a narrow table. The fit
reads at most about FIT_ROWS labelled rows of it, chosen by a hash of the id.

Nulls: a null text counts as empty and has statistics 0; rows without a label teach nothing; a null doc_id is scored but
never learned from. Repeated rows are scored alike. Without any label the score is 0.5, with labels of one kind only it
is that label. Empty tables give an empty result. Columns beside those asked for are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadtime.llm.common import IS_SPACE, Fingerprints, byte_table, crc_mod3, slices, word_spans
from leadtime.plans.lineage import materialize

#: Labelled rows in the fit, trees, their depth, lasso penalty, weights below this are left out.
FIT_ROWS, TREES, DEPTH, PENALTY, LEAST_WEIGHT = 20_000, 24, 3, 0.0005, 1e-4
#: Words of a stretch in which distinct words are counted, so that long texts compare with short ones.
STRETCH = 100
STATISTICS = ("log_words", "word_bytes", "upper", "marks", "stops", "digits", "spaces", "wide", "same_as_before", "distinct", "bare_marks",
              "ends_in_mark", "top_run", "same_lines")

_UPPER, _LETTER = byte_table(bytes(range(65, 91))), byte_table(bytes([*range(65, 91), *range(97, 123)]))
_DIGIT, _STOP = byte_table(b"0123456789"), byte_table(b".,;:?'\"()-")
_MARK = byte_table(bytes(x for x in range(33, 127) if not chr(x).isalnum())) & ~_STOP
_WIDE = np.arange(256) >= 128


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(whole)), where=whole > 0)


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Statistics of all rows, shape (rows, len(STATISTICS)); all 0 for an empty text."""
    n, size = len(offsets) - 1, np.diff(offsets).astype(float)

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)

    starts, ends, row = word_spans(~IS_SPACE[data], offsets)
    words = np.bincount(row, minlength=n).astype(float)
    first = np.searchsorted(row, np.arange(n))
    prints = Fingerprints(data).of(starts, ends)
    per = lambda flags: np.bincount(row, flags, n)
    same = np.zeros(len(starts), bool)
    same[1:] = (prints[1:] == prints[:-1]) & (row[1:] == row[:-1])
    run_heads = np.flatnonzero(~same)
    run = np.diff(np.r_[run_heads, len(starts)])
    longest = np.zeros(n)
    np.maximum.at(longest, row[run_heads], run)
    stretch = (np.arange(len(starts)) - first[row]) // STRETCH
    by = np.lexsort((prints, stretch, row))
    new = np.ones(len(by), bool)
    new[1:] = (prints[by][1:] != prints[by][:-1]) | (stretch[by][1:] != stretch[by][:-1]) | (row[by][1:] != row[by][:-1])
    distinct = np.bincount(row[by], new, n)
    anything = np.concatenate([[0], np.cumsum(_LETTER[data] | _DIGIT[data] | _WIDE[data])])
    bare = (anything[ends] == anything[starts]) if len(starts) else np.zeros(0, bool)
    mark_end = _MARK[data[ends - 1]] if len(starts) else np.zeros(0, bool)
    l_start, l_end, l_row = word_spans(data != 10, offsets)
    lines = np.bincount(l_row, minlength=n).astype(float)
    l_print = Fingerprints(data).of(l_start, l_end)
    by = np.lexsort((l_print, l_row))
    again = np.zeros(len(by), bool)
    again[1:] = (l_print[by][1:] == l_print[by][:-1]) & (l_row[by][1:] == l_row[by][:-1])
    letters = count(_LETTER) + count(_WIDE) / 2
    return np.stack([np.log1p(words), _share(per(ends - starts), words), _share(count(_UPPER), letters), _share(count(_MARK), size), _share(count(_STOP), size),
                     _share(count(_DIGIT), size), _share(count(IS_SPACE), size), _share(count(_WIDE), size), _share(per(same), words),
                     _share(distinct, words), _share(per(bare), words), _share(per(mark_end), words), _share(longest, words),
                     _share(np.bincount(l_row[by], again, n), lines)], axis=1)


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text."""
    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                table = measure(data, offsets)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(table[:, i]) for i in range(len(STATISTICS)))],
                                                 names=["doc_id", *STATISTICS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        work, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """A conjunction of conditions (statistic, is it above, threshold)."""

    conditions: tuple[tuple[str, bool, float], ...]

    def column(self, prefix: str = "") -> Column:
        out = None
        for name, above, threshold in self.conditions:
            one = F.col(prefix + name) > threshold if above else F.col(prefix + name) <= threshold
            out = one if out is None else out & one
        return out.cast("double")

    def __str__(self) -> str:
        return " and ".join(f"{n} {'>' if above else '<='} {t:.6g}" for n, above, t in self.conditions)


_LINE = re.compile(r"^( *)(If|Else|Predict|Tree)\b(?: \(feature (\d+) (<=|>) ([^)]+)\))?")


def tree_rules(description: str) -> list[Rule]:
    """Rules for all nodes of all trees, from the public description of a Spark forest."""
    path: list[tuple[int, tuple[str, bool, float]]] = []
    rules: dict[Rule, None] = {}
    for line in description.splitlines():
        m = _LINE.match(line)
        if not m or m[2] in ("Predict", "Tree"):
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, (STATISTICS[int(m[3])], m[4] == ">", float(m[5])))]
        tightest: dict[tuple[str, bool], float] = {}
        for _, (name, above, t) in path:
            old = tightest.get((name, above))
            tightest[name, above] = t if old is None else max(old, t) if above else min(old, t)
        rules[Rule(tuple(sorted((n, a, t) for (n, a), t in tightest.items())))] = None
    return list(rules)


@dataclass(frozen=True)
class RuleEnsemble:
    """Kept rules with their weights; ``score`` is the compiled expression."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, prefix: str = "") -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + rule.column(prefix) * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(table: DataFrame, label: str = "label") -> RuleEnsemble:
    """table: doc_id, STATISTICS and a 0/1 label (null: not learned from)."""
    labelled = table.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    n, ones = labelled.agg(F.count("*"), F.sum(F.col(label).cast("long"))).first()
    if not n or ones in (0, n):
        return RuleEnsemble(0.0 if not n else (40.0 if ones else -40.0), ())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    sample = labelled.where(place < int(min(1.0, FIT_ROWS / n) * (1 << 30))).select(*STATISTICS, F.col(label).cast("double").alias("label"))
    sample = materialize(sample.repartition(4), "labelled")
    counts = [r["label"] for r in sample.groupBy("label").count().collect()]
    if len(counts) < 2:
        sample = materialize(labelled.select(*STATISTICS, F.col(label).cast("double").alias("label")), "labelled")
    inputs = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="0.5", seed=7, labelCol="label").fit(inputs)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleEnsemble(math.log(ones / (n - ones)), ())
    flags = sample.select("label", *(r.column().alias(f"r{i}") for i, r in enumerate(rules)))
    flags = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(flags)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=100, labelCol="label").fit(flags)
    kept = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if abs(w) > LEAST_WEIGHT)
    return RuleEnsemble(float(lasso.intercept), kept)


def learn(stats: DataFrame, labels: DataFrame) -> RuleEnsemble:
    """Learn from the labelled documents whose crc32 of the id is not 1 modulo 3."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("label IN (0, 1)")
    return fit(stats.where(crc_mod3("doc_id") != 1).join(known, "doc_id"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    stats = materialize(statistics(docs), "statistics")
    scored = stats.select("doc_id", (crc_mod3("doc_id") == 1).alias("held_out"), learn(stats, labels).score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the texts that the classifier rejects, all columns kept. The texts aren't shuffled: their
    statistics are measured again beside them, and the compiled rules filter."""
    model = learn(materialize(statistics(docs), "statistics"), labels)
    name = "statistics"
    while name in docs.columns:
        name += "_"
    kinds = pa.struct([(s, pa.float64()) for s in STATISTICS])

    def work(batches):
        for batch in batches:
            for part, data, offsets in slices(batch, "text"):
                table = measure(data, offsets)
                struct = pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(STATISTICS))], fields=list(kinds))
                yield pa.RecordBatch.from_arrays([*part.columns, struct], names=[*part.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))])
    return docs.mapInArrow(work, schema).where(model.score(f"{name}.") >= threshold).drop(name)
