"""Quality classifier: a sparse ensemble of rules over text statistics.

Tree paths become conjunctive rules, a lasso logistic regression weighs them, and the rules with a
weight are compiled into one Spark column expression.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as X
from .work import free_name

STATISTICS = ["_" + k for k in "log_words symbols upper bars shouts digits stops word_length distinct top_word line_words same_lines".split()]
#: Trees, their depth and bins; strength of the lasso; score from which a document counts as good.
TREES, DEPTH, BINS, LASSO, CUT = 12, 3, 48, 0.0008, 0.3
#: Most labelled documents learned from, those of least hash.
SAMPLE = 50_000

# Classes of ASCII characters.
CLASSES = {"symbols": b"#*$%&|<>~^=_{}[]\\", "bars": b"|", "shouts": b"!", "digits": b"0123456789", "stops": b".,;:?"}


def _member(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def _measured(texts: pa.Array) -> pa.Array:
    """A struct of STATISTICS for each text; null texts count as empty."""
    tables = {k: _member(v) for k, v in CLASSES.items()}
    upper_table, newline = _member(bytes(range(65, 91))), 10
    out: dict[str, list[np.ndarray]] = {k: [np.zeros(0)] for k in STATISTICS}
    for lo, hi, data, offs in X.pieces(pa.RecordBatch.from_arrays([texts], ["text"])):
        n = hi - lo
        total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])[offs]).astype(float)
        w = X.split(data, offs)
        hashes = X.word_hashes(w)
        solid = np.maximum(1.0, total(X.IS_WORD[data] & ((data & 0xC0) != 0x80)))
        after = np.zeros(len(data), bool)
        after[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        words = np.diff(w.first).astype(float)
        some = np.maximum(1.0, words)
        cols = {k: total(t[data]) / solid for k, t in tables.items()}
        cols["upper"] = total(upper_table[data] | after) / solid
        cols["log_words"] = np.log1p(words)
        cols["word_length"] = np.where(words > 0, solid / some, 0.0)
        cols["line_words"] = words / (1.0 + total(data == newline))
        distinct, top, same = np.ones(n), np.zeros(n), np.zeros(n)
        # a line is known by its first and last word and its number of words
        breaks = np.flatnonzero(data == newline)
        line = np.searchsorted(breaks, w.starts)
        head = np.ones(len(w.starts), bool)
        head[1:] = line[1:] != line[:-1]
        head[w.first[:-1][w.first[:-1] < len(head)]] = True
        heads = np.flatnonzero(head)
        ends = np.append(heads[1:], len(w.starts))
        key = X.gram_hashes(hashes, heads, ends) if len(heads) else np.zeros(0, np.uint64)
        line_first = np.searchsorted(heads, w.first)
        for i in range(n):
            a, b = w.first[i], w.first[i + 1]
            if b > a:
                _, counts = np.unique(hashes[a:b], return_counts=True)
                distinct[i], top[i] = len(counts) / (b - a), counts.max() / (b - a)
                a, b = line_first[i], line_first[i + 1]
                same[i] = 1 - len(np.unique(key[a:b])) / (b - a)
        cols |= {"distinct": distinct, "top_word": top, "same_lines": same}
        for k in STATISTICS:
            out[k].append(cols[k[1:]])
    return pa.StructArray.from_arrays([pa.array(np.concatenate(out[k])) for k in STATISTICS], STATISTICS)


def with_statistics(docs: DataFrame, name: str) -> DataFrame:
    """docs with a struct of STATISTICS under a free name: only texts go to Python, only numbers come back."""
    measured = F.arrow_udf(_measured, ", ".join(f"{k} double" for k in STATISTICS)).asNondeterministic()  # so that it runs once a row
    return docs.withColumn(name, measured(F.col("text").cast("string")))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and STATISTICS of every row; read in one pass, nothing shuffled.

    Null and empty texts have no words: their counts and shares are 0, the share of distinct words is 1.
    Repeated rows and null ids stay; other columns are not looked at; an empty table gives none.
    """
    return with_statistics(docs.select("doc_id", "text"), "_all").select("doc_id", "_all.*")


Rule = tuple[tuple[str, bool, float], ...]


def paths(model) -> list[Rule]:
    """Every path from a root to another node, as (statistic, at most?, threshold) terms; each rule once."""
    found: dict[Rule, None] = {}

    def walk(node, terms):
        if terms:
            tightest: dict[tuple[str, bool], float] = {}
            for k, low, t in terms:
                tightest[k, low] = t if (k, low) not in tightest else min(tightest[k, low], t) if low else max(tightest[k, low], t)
            found[tuple(sorted((k, low, t) for (k, low), t in tightest.items()))] = None
        if node.subtreeDepth() > 0:
            k, t = STATISTICS[node.split().featureIndex()], node.split().threshold()
            walk(node.leftChild(), [*terms, (k, True, t)])
            walk(node.rightChild(), [*terms, (k, False, t)])

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), [])
    return list(found)


def holds(rule: Rule, of: str = "") -> Column:
    """The rule over statistics in columns, or in the struct ``of``."""
    return reduce(lambda a, b: a & b, [F.col(of + k) <= t if low else F.col(of + k) > t for k, low, t in rule])


class Ensemble:
    """rules with weights, and the intercept; score() is one column expression."""

    def __init__(self, rules: list[tuple[Rule, float]], intercept: float):
        self.rules, self.intercept = rules, intercept

    def score(self, of: str = "") -> Column:
        total = reduce(lambda a, b: a + b, [F.when(holds(r, of), w).otherwise(0.0) for r, w in self.rules], F.lit(float(self.intercept)))
        return 1.0 / (1.0 + F.exp(-total))


def fit(rows: DataFrame, label: str, seed: int = 7) -> Ensemble:
    """Fit to a bounded sample of rows with STATISTICS and a 0/1 label.  Without rows the score is 0.5; with one class its smoothed share."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector

    rows = rows.select(F.col(label).cast("double").alias("label"), *STATISTICS).persist()
    counts = rows.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    n, ones = counts.n, counts.ones or 0.0
    try:
        if ones in (0.0, n):
            return Ensemble([], math.log((ones + 1) / (n - ones + 1)))
        vectors = VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(rows)
        forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, featureSubsetStrategy="0.6", seed=seed).fit(vectors)
        rules = paths(forest)
        flags = rows.select("label", array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("features")).coalesce(1)  # a bounded sample
        lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60).fit(flags)
        weights = [float(w) for w in lasso.coefficients.toArray()]
        return Ensemble([(r, w) for r, w in zip(rules, weights) if w], float(lasso.intercept))
    finally:
        rows.unpersist()


def learn(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, sample: int = SAMPLE) -> Ensemble:
    """The ensemble from the ``sample`` labelled documents of least hash among those not held out.

    Rows that share a doc_id count as one, the one with the least statistics.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
    known = known.where(~held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most SAMPLE ids
    rows = with_statistics(rows, "_all").groupBy("doc_id").agg(F.max("_label").alias("_label"), F.min("_all").alias("_all"))
    return fit(rows.select("_label", "_all.*"), "_label")


def classify(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs, then STATISTICS.

    labels: doc_id and the 0/1 label; null labels and ids without a document are passed over, of
    repeated labels the largest counts.  held_out is an expression over doc_id; labels of held-out
    documents are never read.  Null or empty texts have no words and are scored like others;
    a null doc_id is scored, its held_out is null and it is not learned from.  Columns other than doc_id
    and text are not looked at; an empty table gives none.  Rows in = rows out, in one pass.
    """
    score = learn(docs, labels, label, held_out).score()
    scored = statistics(docs).select("doc_id", held_out.alias("held_out"), score.alias("score"), *STATISTICS)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= cut).cast("int").alias("predicted"), *STATISTICS)


def accepted(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, cut: float = CUT) -> DataFrame:
    """The rows of docs that classify() predicts as 1, whole and unchanged, with all their columns.

    Nothing is joined back, so rows that share a doc_id, or have none, are judged each by its own text.
    """
    name = free_name("_statistics", docs.columns)
    score = learn(docs, labels, label, held_out).score(f"{name}.")
    return with_statistics(docs, name).where(score >= cut).select(docs.columns)
