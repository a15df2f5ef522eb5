"""Quality classifier: a sparse rule ensemble (operator 3).

Shallow trees over text statistics give conjunctive rules, one for each node below a root.  A logistic regression with a
lasso penalty weighs them and sets most weights to zero.  The rest, as a Spark column expression over the statistics, is
the model; scoring is a projection.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import arrow_schema, batches, spark_schema, stage
from podelta.llm.textstats import SPACE, SYMBOLS, count_of, duplicate_lines, repeated_words, words_of
from podelta.llm.trees import condition, paths, read_tree

STATISTICS = ("words", "word_length", "symbols", "repeated", "duplicate_lines", "distinct", "capitals", "digits", "stops",
              "bangs", "bars", "lines", "longest_run", "longest_word", "wide")
#: Bound on the labelled rows that train the model; trees and penalty of the ensemble; score from which 1 is predicted.
TRAIN_ROWS, TREES, DEPTH, PENALTY, SEED, LIMIT = 20_000, 20, 3, 0.001, 3, 0.3


def statistics_of(text: str | None) -> list[float]:
    """The statistics of one whole text, shares of words or bytes; a text without words has zeros."""
    raw = (text or "").encode()
    words = words_of(raw)
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    size = len(raw)
    letters = size - count_of(raw, SPACE)
    lines = sum(1 for x in raw.split(b"\n") if x.strip())
    share = lambda chars: count_of(raw, chars) / letters
    return [float(n), letters / n, share(SYMBOLS), repeated_words(words) / n, duplicate_lines(raw) / lines, len(set(words)) / n,
            share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share(b"0123456789"), count_of(raw, b".?") / n, raw.count(b"!!") / n,
            count_of(raw, b"|") / n, lines / n, max(sum(1 for _ in g) for _, g in groupby(words)) / n,
            float(max(map(len, words))), count_of(raw, bytes(range(128, 256))) / letters]


def _rows(key, text) -> Iterator[tuple]:
    yield key, statistics_of(text)


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    schema = arrow_schema(docs, key, stats=pa.list_(pa.float64()))
    return docs.select(key, text).mapInArrow(batches(_rows, schema), spark_schema(schema))


def held_out(key: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the key as text is divisible by 5 (a null key counts as empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple  # ((conditions, weight), ...), weights not zero

    def score(self, stats: Column) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(condition(rule, lambda i: F.get(stats, F.lit(i))), F.lit(float(weight))).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[i]} {sign} {t:g}" for i, sign, t in rule) for rule, w in self.rules]


def _all_rules(trees) -> list[tuple]:
    """Every node below a root as the sorted conjunction that leads to it, without repeats, in a fixed order."""
    found = {tuple(sorted(set(rule[:k]))) for tree in trees for rule, _ in paths(tree) for k in range(1, len(rule) + 1)}
    return sorted(found)


def train(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", train_rows: int = TRAIN_ROWS,
          trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY, seed: int = SEED) -> RuleModel:
    """Fit on at most about ``train_rows`` labelled rows (drawn by hash) that are not held out.

    Null labels and keys teach nothing.  With one class only, or no label, the score is a constant: the smoothed share of
    label 1.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(F.col(key))).select(
        F.col(key).alias("label_key"), F.col(label).cast("double").alias("label"))
    n = known.count()
    share = min(1.0, train_rows / max(1, n))
    picked = known.where(F.pmod(F.xxhash64("label_key", F.lit(seed)), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    rows = stage(stats.select(F.col(key).alias("label_key"), "stats").join(picked, "label_key").select("stats", "label"), "training")
    seen = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("ones")).first()
    if seen["ones"] in (0.0, float(seen["n"])):
        from math import log
        return RuleModel(log((seen["ones"] + 0.5) / (seen["n"] - seen["ones"] + 0.5)), ())
    forest = RandomForestClassifier(featuresCol="features", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=seed,
                                    minInstancesPerNode=10).fit(rows.select(array_to_vector("stats").alias("features"), "label"))
    rules = _all_rules([read_tree(t) for t in forest.trees])
    if not rules:
        from math import log
        return RuleModel(log(seen["ones"] / (seen["n"] - seen["ones"])), ())
    hits = F.array(*(F.when(condition(r, lambda i: F.get(F.col("stats"), F.lit(i))), 1.0).otherwise(0.0) for r in rules))
    lasso = LogisticRegression(featuresCol="features", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(
        stage(rows.select(hits.alias("hits"), "label"), "hits").select(array_to_vector("hits").alias("features"), "label"))
    weights = lasso.coefficients.toArray()
    return RuleModel(float(lasso.intercept), tuple((r, float(w)) for r, w in zip(rules, weights) if w != 0.0))


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
             limit: float = LIMIT, **options) -> DataFrame:
    """(key, held_out, score, predicted) for every input row.

    Only statistics of the text enter a score.  Null and empty texts score like a text of zero statistics, null keys stay
    (they count as the empty key for held_out), repeated rows score alike, an empty table gives no rows; other columns are
    neither read nor returned.
    """
    stats = stage(statistics(docs, key, text), "statistics")
    model = train(stats, labels, key, label, **options)
    scored = stats.select(F.col(key), held_out(F.col(key)).alias("held_out"), model.score(F.col("stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= limit).cast("int"))
