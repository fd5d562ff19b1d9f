"""Quality classifier: a sparse rule ensemble over text statistics, scored by column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stage
from ordermill.llm.language import held_out

Condition = tuple[str, bool, float]  # statistic, at most (else above), bound


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]]  # conditions that all hold, weight


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a whole text; all 0 for a null or empty one."""
    body = F.coalesce(text, F.lit(""))
    chars = F.length(body)
    words = F.array_remove(F.split(body, r"\s+", -1), "")
    lines = F.split(body, "\n", -1)
    n_words = F.size(words)

    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0).cast("double")

    def of_class(pattern: str) -> Column:
        return chars - F.length(F.regexp_replace(body, pattern, ""))

    def of_chars(listed: str) -> Column:
        return chars - F.length(F.translate(body, listed, ""))

    return {
        "log_chars": F.log1p(chars.cast("double")),
        "mean_word": share(chars, n_words),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "words_per_line": share(n_words, F.size(lines)),
        "upper": share(of_class(r"\p{Lu}+"), chars),
        "digits": share(of_class("[0-9]+"), chars),
        "signs": share(of_class(r"[^\p{L}\p{M}0-9\s.,;:'\"()-]+"), chars),
        "stops": share(of_class(r"[.,;:?]+"), n_words),
    }


def with_statistics(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumns(statistics(F.col(text)))


def _holds(conditions: tuple[Condition, ...]) -> Column:
    holds = F.lit(True)
    for name, at_most, bound in conditions:
        holds = holds & (F.col(name) <= bound if at_most else F.col(name) > bound)
    return holds


def _paths(node, names: list[str], above: tuple[Condition, ...] = ()) -> list[tuple[Condition, ...]]:
    """The path to every node below the root, as the conditions along it."""
    if not node.getClass().getSimpleName().startswith("InternalNode"):
        return []
    split = node.split()
    name, bound = names[split.featureIndex()], float(split.threshold())
    found = []
    for child, at_most in ((node.leftChild(), True), (node.rightChild(), False)):
        here = (*above, (name, at_most, bound))
        found += [tuple(sorted(here)), *_paths(child, names, here)]
    return found


def train(rows: DataFrame, names: list[str], label: str, trees: int = 24, depth: int = 3, lasso: float = 2e-3) -> RuleModel:
    """Fit the ensemble on `rows`, which hold the statistics `names` and a 0/1 column `label`.

    A random forest of shallow trees proposes rules: the conditions on the path to each node.  A
    logistic regression with lasso penalty weighs them, and most get weight 0.  Both are Spark ML
    jobs over all rows.  With one class only, the model is a constant.
    """
    found = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    ones, zeros = found.get(1, 0), found.get(0, 0)
    if not ones or not zeros:
        return RuleModel(math.log((ones + 1) / (zeros + 1)), [])
    data = rows.select(
        F.col(label).cast("double").alias("label"), *names, array_to_vector(F.array(*names)).alias("features")
    )
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=5, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=42
    ).fit(data)
    paths = sorted({path for tree in forest.trees for path in _paths(tree._call_java("rootNode"), names)})
    if not paths:
        return RuleModel(math.log((ones + 1) / (zeros + 1)), [])
    fired = F.array(*[_holds(path).cast("double") for path in paths])
    fitted = LogisticRegression(
        featuresCol="rules", regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=60
    ).fit(stage(data.select("label", fired.alias("fired")), "quality-rules").select("label", array_to_vector("fired").alias("rules")))
    weights = fitted.coefficients.toArray()
    return RuleModel(float(fitted.intercept), [(path, float(w)) for path, w in zip(paths, weights) if w != 0])


def score(model: RuleModel) -> Column:
    """The chance of label 1 as a column expression over the statistics."""
    total = F.lit(model.intercept)
    for conditions, weight in model.rules:
        total = total + F.when(_holds(conditions), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = 0.7,
    sample: int = 50_000,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> DataFrame:
    """Every row of `docs` with doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    Learns from at most about `sample` labelled rows outside the held-out quarter, chosen by a hash
    of the id; labels that are neither 0 nor 1 and null ids are not learned from, and neither is an
    id with both labels.  predicted is 1 from `threshold` on.  Null and empty texts have statistics 0
    and are scored like any other.  Without usable labels every score is the same: the prior of what
    there is, or 0.5.  Repeated rows are rows of their own; an empty table gives an empty result;
    other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_body"))
    names = list(statistics(F.col("_body")))
    measured = stage(with_statistics(rows, "_body").drop("_body"), "quality-statistics")
    marked = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(F.col(doc_id)))
    marked = marked.groupBy(F.col(doc_id).alias("doc_id")).agg(F.min(label).alias("_label"), F.max(label).alias("_most"))
    marked = stage(marked.where("_label = _most").drop("_most"), "quality-labels")
    share = min(1.0, sample / max(marked.count(), 1))
    order = F.shiftrightunsigned(F.xxhash64(F.lit("quality"), F.col("doc_id")), 11) / F.lit(float(1 << 53))
    training = stage(measured.join(marked.where(order < share), "doc_id"), "quality-training")
    model = train(training, names, "_label")
    return measured.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        score(model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
