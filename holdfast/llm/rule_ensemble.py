"""Quality classifier as a sparse ensemble of rules.

Method. Statistics are taken of every whole text. A forest of shallow trees is grown on labelled rows, and every path from a
root to a node becomes a rule: a conjunction of bounds on statistics. A logistic model with a lasso penalty on the rules sets
most weights to zero. The rules that are left are compiled to one Spark column expression over the statistics, so scoring runs
inside generated code and the model can be read as text (``RuleModel.describe``).

Trees and weights are fitted on at most ``SAMPLE`` labelled rows, those whose ids have the lowest hashes, and only on ids whose
crc32 leaves a remainder by 4 other than 2; the others are held out. Statistics never see ids, labels, languages or sources.

Defined results: null and empty texts have all statistics zero and are scored like any other. Labels that are null or that
disagree for an id are not used. With no labelled rows every score is 0.5; with one class only, its share with one row of each
class added. Repeated rows and ids give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import as_bytes, by_crc, stored, windows_of_three, word_ids

SAMPLE = 20_000
TREES, DEPTH, PENALTY = 20, 3, 0.002
THRESHOLD = 0.7

STATISTICS = (
    "log_words", "word_length", "upper_share", "symbol_share", "pipe_share", "exclaim_share", "stop_share", "comma_share", "digit_share",
    "other_share", "distinct_share", "top_word_share", "repeat_share", "same_next_share", "dup_line_share", "words_a_line",
)


def _letters(text: str) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(text.encode(), np.uint8))


_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_SYMBOL, _STOP, _OTHER = _letters("#*$%&<>@^~=+_"), _letters(".?"), _letters("()[]{}\"'/\\:;-`")


def statistics(text: bytes) -> tuple[float, ...]:
    """The values of ``STATISTICS``; shares are of bytes, of words or of lines."""
    words = text.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n = sum(map(len, words)), len(words)
    ids, distinct = word_ids(words)
    times = np.bincount(ids)
    windows = windows_of_three(ids, distinct)
    repeated = 0.0
    if len(windows):
        _, again = np.unique(windows, return_counts=True)
        repeated = float(again[again > 1].sum()) / len(windows)
    lines = [x for x in text.split(b"\n") if x.strip()]
    cased = count[_UPPER].sum() + count[_LOWER].sum()
    return (
        float(np.log1p(n)),
        size / n,
        float(count[_UPPER].sum() / cased) if cased else 0.0,
        float(count[_SYMBOL].sum() / size),
        float(count[ord("|")] / size),
        float(count[ord("!")] / size),
        float(count[_STOP].sum() / size),
        float(count[ord(",")] / size),
        float(count[_DIGIT].sum() / size),
        float(count[_OTHER].sum() / size),
        distinct / n,
        float(times.max() / n),
        repeated,
        float(np.count_nonzero(ids[1:] == ids[:-1]) / n),
        1 - len(set(lines)) / len(lines),
        n / len(lines),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([statistics(t) for t in as_bytes(batch.column(1))], dtype=np.float64).reshape(-1, len(STATISTICS))
        yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, np.ascontiguousarray(values.T))], names=["doc_id", *STATISTICS])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, statistics) per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS))


Rule = tuple[tuple[int, float, float], ...]  # (statistic, above, at most), in order of the statistics


def rules_of(forest: str) -> list[Rule]:
    """All distinct paths in the printed form of a tree ensemble."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, int, bool, float]] = []
    for line in forest.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+\d.eE]+)\)", line)
        if not m:
            if line.strip().startswith("Tree"):
                path = []
            continue
        indent = len(m[1])
        path = [p for p in path if p[0] < indent]
        path.append((indent, int(m[2]), m[3] == ">", float(m[4])))
        bounds: dict[int, list[float]] = {}
        for _, feature, above, value in path:
            lo, hi = bounds.setdefault(feature, [-np.inf, np.inf])
            bounds[feature] = [max(lo, value), hi] if above else [lo, min(hi, value)]
        found.setdefault(tuple((f, lo, hi) for f, (lo, hi) in sorted(bounds.items())))
    return list(found)


def condition(rule: Rule) -> F.Column:
    parts = []
    for feature, above, most in rule:
        column = F.col(STATISTICS[feature])
        if above > -np.inf:
            parts.append(column > F.lit(above))
        if most < np.inf:
            parts.append(column <= F.lit(most))
    out = parts[0]
    for part in parts[1:]:
        out = out & part
    return out


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> F.Column:
        """Probability of label 1 as a column over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))

    def describe(self) -> list[str]:
        def bounds(rule: Rule) -> str:
            return " and ".join(f"{lo:g} < {STATISTICS[f]} <= {hi:g}" for f, lo, hi in rule)

        return [f"{w:+.3f} if {bounds(r)}" for r, w in sorted(self.rules, key=lambda x: -abs(x[1]))]


def labelled(stats: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Statistics and label of the rows to learn from, at most ``most``."""
    agreed = (
        labels.groupBy(F.col("doc_id").alias("label_id"))
        .agg(F.min("quality").alias("q"), F.max("quality").alias("p"))
        .where("q = p AND q IN (0, 1)")
        .where(by_crc("label_id") != 2)
    )
    chosen = agreed.orderBy(F.xxhash64("label_id"), "label_id").limit(most)
    return stats.join(chosen, F.col("doc_id") == F.col("label_id")).select(*STATISTICS, F.col("q").cast("double").alias("label"))


def fit(rows: DataFrame) -> RuleModel:
    """Rules and weights from rows of statistics and label, a bounded sample. The rows are put in order in one partition, because
    bagging draws per partition: the same rows give the same model, however they are stored."""
    rows = rows.repartition(1).sortWithinPartitions(*STATISTICS, "label")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        n = sum(counts.values())
        share = (counts.get(1.0, 0) + 1) / (n + 2)
        return RuleModel(float(np.log(share / (1 - share))), [])
    whole = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows).select("features", "label", *STATISTICS)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=7)
    rules = rules_of(forest.fit(whole).toDebugString)
    if not rules:
        share = counts[1.0] / sum(counts.values())
        return RuleModel(float(np.log(share / (1 - share))), [])
    names = [f"rule_{k}" for k in range(len(rules))]
    fires = whole.select("label", *[condition(r).cast("double").alias(n) for r, n in zip(rules, names)])
    fires = VectorAssembler(inputCols=names, outputCol="features").transform(fires).select("features", "label")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False).fit(fires)
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w])


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    stats = stored(measured(docs), "statistics")
    model = fit(stored(labelled(stats, labels, most), "labelled"))
    return stats.select(
        "doc_id", F.coalesce(by_crc("doc_id") == 2, F.lit(False)).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
