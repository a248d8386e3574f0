"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Shards of a bounded sample of labelled texts are learned side by side, each coordinate with its own
rate; L1 keeps the averaged weights few, so that they can be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as X

#: log2 of the number of coordinates: what is broadcast has at most this many weights.
BITS = 20
#: Most labelled documents learned from, those of least hash; documents a shard; passes over a shard.
SAMPLE, SHARD, PASSES = 16_000, 4_000, 4
#: FTRL: rate, its offset, and the two penalties; score from which a document counts as toxic.
ALPHA, BETA, L1, L2, CUT = 0.3, 1.0, 3.0, 0.5, 0.3
#: Lengths in bytes of the word stems that join the whole words.
STEMS = (4, 5, 6, 7, 8)

_table = np.zeros(256, bool)
_table[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_table[128:] = True


def _lower(data: np.ndarray) -> np.ndarray:
    """a-z for A-Z and, in UTF-8, small letters for the capitals of Latin-1."""
    out = X.LOWER[data]
    two = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[two] += 0x20
    return out


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text number, coordinate) of every word, stem, pair of neighbours and pair with one word between."""
    w = X.split(_lower(data), offs, table=_table)
    h = X.word_hashes(w)
    owner = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
    out = [(owner, h)]
    for n in STEMS:
        long = np.flatnonzero(w.ends - w.starts > n)
        out.append((owner[long], X.byte_hashes(w.data, w.starts[long], w.starts[long] + n) ^ np.uint64(n)))
    for gap in (1, 2):
        same = np.flatnonzero(owner[:-gap] == owner[gap:])
        out.append((owner[same], X.mix(h[same] * np.uint64(3) + h[same + gap] + np.uint64(gap))))
    return np.concatenate([a for a, _ in out]), (np.concatenate([b for _, b in out]) >> np.uint64(64 - BITS)).astype(np.int64)


def _lists(docs: DataFrame) -> DataFrame:
    """Each row's own columns but text, and its distinct coordinates."""
    kept = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in kept) + ", coords array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in X.pieces(batch):
                owner, coord = features(data, offs)
                both = np.unique((owner << BITS) | coord)
                bounds = np.searchsorted(both, np.arange(hi - lo + 1) << BITS)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array((both & ((1 << BITS) - 1)).astype(np.int32)))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in kept] + [lists], [*kept, "coords"])

    return docs.mapInArrow(run, schema)


def ftrl(rows: list[tuple[np.ndarray, int]], size: int, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and intercept after ``passes`` over rows of (coordinates, label) in their order."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    weight = lambda zi, ni: np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
    for _ in range(passes):
        for coords, label in rows:
            at = np.append(coords, size)
            zi, ni = z[at], n[at]
            wi = weight(zi, ni)
            p = 1.0 / (1.0 + np.exp(-np.clip(wi.sum(), -30, 30)))
            g = p - label
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[at] = ni + g * g
    w = weight(z, n)
    return w[:size], float(w[size])


def fit(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, intercept) from rows of doc_id, text, label; the mean of the shards' weights."""
    count = rows.count()
    shards = max(1, count // SHARD)
    dealt = _lists(rows.select("doc_id", "label", "text")).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("order", kind="stable")
        w, bias = ftrl([(np.asarray(c, np.int64), int(y)) for c, y in zip(pdf.coords, pdf.label)], 1 << BITS)
        at = np.flatnonzero(w)
        return pd.DataFrame({"coord": np.append(at, 1 << BITS), "weight": np.append(w[at], bias)})

    dealt = dealt.withColumn("order", F.xxhash64("doc_id", F.lit(1)))
    learned = dealt.groupBy("shard").applyInPandas(learn, "coord long, weight double")
    got = learned.groupBy("coord").agg((F.sum("weight") / shards).alias("weight")).toPandas().sort_values("coord")  # at most 2 ** BITS + 1 rows
    own = got.coord < 1 << BITS
    return got.coord[own].to_numpy(np.int64), got.weight[own].to_numpy(np.float64), float(got.weight[~own].sum())


def classify(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, cut: float = CUT, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs.

    labels: doc_id and the 0/1 label; nulls are passed over, of repeated labels the largest counts.
    Learned from are the ``sample`` labelled documents of least hash among those not held out; labels of
    held-out documents are never read.  A null or empty text gets the intercept's score; a null doc_id
    is scored, its held_out is null.  Without labels every score is 0.5.  Rows that share a doc_id are
    learned from once, by the least text; all are scored.  Rows in = rows out.
    """
    spark = docs.sparkSession
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.where(~held_out).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most SAMPLE ids
    coords, weights, bias = fit(rows.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text")))
    table = np.zeros(1 << BITS, np.float32)
    table[coords] = weights
    shipped = spark.sparkContext.broadcast((table, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table, bias = shipped.value
            for lo, hi, data, offs in X.pieces(batch):
                owner, coord = features(data, offs)
                hit = np.flatnonzero(table[coord])
                both = np.unique((owner[hit] << BITS) | coord[hit])
                total = bias + np.bincount(both >> BITS, table[both & ((1 << BITS) - 1)], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -60, 60))))], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
