"""Substring dedup on a sparse de Bruijn graph of word k-mers.

Nodes are the k-mers that are least in some window of LENGTH words, so that every window has an own
node, and equal windows have equal ones; edges are the words from one node to the next.  A node all of whose
occurrences have the same edge in and the same edge out doesn't branch: joins on node hashes find these, and
runs of them along a document compact into one path.  Every document that holds a path is then read again at
the path's source coordinates: the repeated span of a path is verified as a whole, by a cryptographic digest of
128 bits of all its words.  Where paths branch, windows are first verified by the stretch from the node before them to the node
after them, all windows of a stretch at once, and only those of stretches that no smaller document has one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as X
from .work import free_name, possible, release, saved

#: Words of a window; words of a node.
LENGTH, NODE = 50, 8


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every run of ``width`` values: len(values) - width + 1 results."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, 0xFFFFFFFFFFFFFFFF, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


class Nodes:
    """The nodes of a piece of texts, and the windows that they stand for.

    place, owner, key, into, out: each node's first word, text number, hash, and the hashes of the edges
    to it and from it (0 at the ends of a text).  start, text, node: each window's first word, text
    number and its own node, the first of its least k-mers; equal windows have equal own nodes at equal places.
    """

    def __init__(self, h: np.ndarray, first: np.ndarray, length: int = LENGTH, k: int = NODE):
        counts = np.diff(first)
        n, low = len(h), np.uint64((1 << 24) - 1)
        empty = np.zeros(0, np.int64)
        if n < length or counts.max() < length:
            self.place = self.owner = self.start = self.text = self.node = empty
            self.key = self.into = self.out = np.zeros(0, np.uint64)
            return
        at = np.arange(n - k + 1)
        grams = X.gram_hashes(h, at, at + k, 0x51ED2701)
        owner = np.repeat(np.arange(len(counts)), counts)
        self.start = np.flatnonzero(owner[: n - length + 1] == owner[length - 1 :])
        self.text = owner[self.start]
        ranked = (grams & ~low) | (at.astype(np.uint64) & low)
        least = (_least(ranked, length - k + 1)[self.start] & low).astype(np.int64)
        own = self.start + ((least - self.start) & int(low))
        chosen = np.zeros(n - k + 1, bool)
        chosen[own] = True
        long = np.flatnonzero(counts >= length)
        chosen[first[long]] = True  # the ends of texts too, so that whole copies are whole paths
        chosen[first[long + 1] - k] = True
        place = np.flatnonzero(chosen)
        self.node = np.searchsorted(place, own)
        self.place, self.owner, self.key = place, owner[place], grams[place]
        same = self.owner[1:] == self.owner[:-1]
        edge = X.gram_hashes(h, place[:-1], place[1:] + k, 0x7A3D99E1) | np.uint64(1)
        self.into, self.out = np.zeros(len(place), np.uint64), np.zeros(len(place), np.uint64)
        self.into[1:] = np.where(same, edge, 0)
        self.out[:-1] = np.where(same, edge, 0)


def nodes(docs: DataFrame, length: int) -> DataFrame:
    """key, into, out, doc_id, tag, place (nodes before it in its text) of every node; none of rows without a doc_id, with a null or
    empty text or with few words; an empty table gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in X.pieces(batch):
                w = X.split(data, offs)
                got = Nodes(X.word_hashes(w), w.first, length)
                begin = np.searchsorted(got.owner, got.owner)
                rows = batch.slice(lo, hi - lo)
                take = pa.array(got.owner)
                yield pa.RecordBatch.from_arrays(
                    [X.longs(got.key), X.longs(got.into), X.longs(got.out), rows.column(0).take(take), rows.column(1).take(take), pa.array((np.arange(len(begin)) - begin).astype(np.int32))],
                    ["key", "into", "out", "doc_id", "tag", "place"],
                )

    return docs.select("doc_id", "tag", "text").where("doc_id is not null").mapInArrow(run, "key long, into long, out long, doc_id long, tag int, place int")


def compacted(shared: DataFrame) -> DataFrame:
    """doc_id, tag, runs: of each document the runs of nodes that don't branch, and its other shared nodes one by one.

    shared: doc_id, tag, place, inner.  A run has the same nodes wherever it occurs, so its ends are all that is kept.
    """
    dealt = shared.repartition("doc_id", "tag")  # one exchange for all three steps
    island = F.col("place") - F.dense_rank().over(Window.partitionBy("doc_id", "tag", "inner").orderBy("place"))
    rows = dealt.withColumn("island", F.when(F.col("inner"), island).otherwise(F.col("place")))
    rows = rows.groupBy("doc_id", "tag", "inner", "island").agg(F.min("place").alias("from"), F.max("place").alias("upto"))
    return rows.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("from", "upto", "inner")).alias("runs"))


def located(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """doc_id, tag, lo, hi, h1, h2, w1, w2: word ranges of consecutive windows, with a digest of what tells them.

    For the windows of a path this is a digest of their words, and w1, w2 are null; for windows where paths branch
    one of the words from the node before them to the node after, and w1, w2 are lists with the digest of each window.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offs in X.pieces(batch):
                part = batch.slice(a, b - a)
                w = X.split(data, offs)
                h = X.word_hashes(w)
                got = Nodes(h, w.first, length)
                if not len(got.start):
                    continue
                lists = part.column(3)
                begin, end = np.searchsorted(got.owner, np.arange(b - a)), np.searchsorted(got.owner, np.arange(b - a), "right")
                flat, row = lists.flatten(), np.repeat(np.arange(b - a), np.diff(lists.offsets.to_numpy()))
                first, last = begin[row] + flat.field(0).to_numpy(), begin[row] + flat.field(1).to_numpy()
                inner = flat.field(2).to_numpy(zero_copy_only=False)
                # a path reaches from the node before its run to the node after it
                left = got.place[np.maximum(first - 1, begin[row])]
                right = got.place[np.minimum(last + 1, end[row] - 1)] + NODE
                each = np.repeat(np.arange(len(first)), last - first + 1)  # run of every shared node
                index = first[each] + np.arange(len(each)) - np.searchsorted(each, each)
                run_of = np.full(len(got.place), -1)
                run_of[index] = each
                mine = run_of[got.node]  # run of each window's own node, or -1
                there = np.flatnonzero(mine >= 0)
                mine = mine[there]
                start = got.start[there]
                whole = inner[mine] & (start >= left[mine]) & (start + length <= right[mine])
                # windows that follow each other on one path, or on one stretch of nodes, make one row: a stretch reaches
                # over all shared nodes that follow each other, or around a window that looks out of these
                before = np.searchsorted(got.place, start, "right") - 1
                after = np.searchsorted(got.place + NODE, start + length)
                shared = run_of >= 0
                apart = np.flatnonzero(np.concatenate([[True], ~shared[1:] | ~shared[:-1] | (got.owner[1:] != got.owner[:-1])]))
                edge = np.searchsorted(apart, got.node[there], "right")
                from_, upto = apart[edge - 1], np.append(apart[1:], len(shared))[edge - 1] - 1
                inside = (from_ <= before) & (after <= upto)
                before, after = np.where(inside, from_, before), np.where(inside, upto, after)
                before, after = np.where(whole, mine, before), np.where(whole, -1, after)
                new = np.ones(len(start), bool)
                new[1:] = (before[1:] != before[:-1]) | (after[1:] != after[:-1]) | (start[1:] != start[:-1] + 1)
                head = np.flatnonzero(new)
                if not len(head):
                    continue
                bounds = np.append(head, len(start))
                lo, hi, path = start[head], start[bounds[1:] - 1] + length, whole[head]
                told = np.empty((len(head), 2), np.uint64)
                some, rest = np.flatnonzero(path), np.flatnonzero(~path)  # ranges rise within each kind
                told[some] = X.run_digests(w, lo[some], hi[some])
                told[rest] = X.run_digests(w, got.place[before[head[rest]]], got.place[after[head[rest]]] + NODE)
                text = np.searchsorted(w.first, lo, "right") - 1
                hashes = [X.longs(x) for x in told.T]
                open_ = np.flatnonzero(~whole)
                ends = np.concatenate([[0], np.cumsum(np.where(path, 0, np.diff(bounds)))])
                singly = X.run_digests(w, start[open_], start[open_] + length)
                each = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32), mask=np.append(path, False)), X.longs(x)) for x in singly.T]
                take, base = pa.array(text), w.first[text]
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), pa.array((lo - base).astype(np.int32)), pa.array((hi - base).astype(np.int32)), *hashes, *each], names)

    names = ["doc_id", "tag", "lo", "hi", "h1", "h2", "w1", "w2"]
    may = possible(runs.select("doc_id").distinct(), "doc_id")
    rows = docs.where(may(F.col("doc_id"))).join(runs.hint("merge"), ["doc_id", "tag"]).select("doc_id", "tag", "text", "runs")
    return rows.mapInArrow(run, "doc_id long, tag int, lo int, hi int, h1 long, h2 long, w1 array<long>, w2 array<long>")


def covered(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, tag, spans: the word ranges to remove, for the rows of docs (doc_id, tag, text) that have any.

    Tables between the steps are written, so that joins stand alone and a hot key's rows can be split.  Null ids, null and
    short texts have none; an empty table gives no rows.
    """
    found = saved(nodes(docs, length), "nodes")
    same = lambda c: F.min(c) == F.max(c)
    graph = found.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), (same("into") & same("out")).alias("inner"))
    graph = saved(graph.where("least < most").select("key", "inner"), "graph")
    shared = saved(found.select("key", "doc_id", "tag", "place").join(graph.hint("merge"), "key").drop("key"), "shared")
    rows = saved(located(docs, saved(compacted(shared), "runs"), length), "located")
    release(docs.sparkSession)
    first = _first(rows)
    again = F.col("doc_id") > F.col("least")
    found = rows.drop("w1", "w2").join(first.hint("merge"), ["h1", "h2"]).where(again).select("doc_id", "tag", "lo", "hi")
    # What a stretch that goes holds is held by the smallest document of that stretch too, whose windows are still here.
    left = rows.where("w1 is not null").alias("a").join(first.hint("merge").alias("b"), (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")) & again, "left_anti")
    left = saved(left.select("doc_id", "tag", "lo", "w1", "w2"), "windows")
    release(docs.sparkSession)
    each = left.select("doc_id", "tag", "lo", F.posexplode(F.arrays_zip("w1", "w2")).alias("i", "w"))
    each = each.select("doc_id", "tag", (F.col("lo") + F.col("i")).alias("lo"), F.col("w.w1").alias("h1"), F.col("w.w2").alias("h2"))
    singly = each.join(_first(each).hint("merge"), ["h1", "h2"]).where(again).select("doc_id", "tag", "lo", (F.col("lo") + length).alias("hi"))
    return found.union(singly).groupBy("doc_id", "tag").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))


def _first(rows: DataFrame) -> DataFrame:
    """h1, h2, least: the smallest document of all that more than one has."""
    first = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    return saved(first.select("h1", "h2", "least"), "first")


def _finish(rows: DataFrame, marks: str, text_out: bool) -> DataFrame:
    """Rows (doc_id, text, the spans under ``marks``, and others) with the counts, or with text cut down in place."""
    counts = "n_words long, n_removed long, kept_sha256 string"
    kept = [c for c in rows.columns if c != marks] if text_out else ["doc_id"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept) + ("" if text_out else ", " + counts)
    names = kept + ([] if text_out else [c.split()[0] for c in counts.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = lambda part, c: part.column(part.schema.get_field_index(c))
            for lo, hi, data, offs in X.pieces(batch):
                part, raw = batch.slice(lo, hi - lo), data.tobytes()
                out, total, removed = [], [], []
                for i, spans in enumerate(column(part, marks)):
                    words = raw[offs[i] : offs[i + 1]].split()
                    total.append(len(words))
                    cut = 0
                    if spans.is_valid:
                        keep, at = [], 0
                        for s, e in zip(spans.values.field(0).to_pylist(), spans.values.field(1).to_pylist()):
                            if e > at:
                                keep += words[at:s] if s > at else []
                                cut += e - max(s, at)
                                at = e
                        words = keep + words[at:]
                    removed.append(cut)
                    out.append(b" ".join(words))
                if text_out:  # texts that lose nothing stay as they are
                    whole = [t if not n else x.decode() for t, n, x in zip(column(part, "text").to_pylist(), removed, out)]
                    columns = [column(part, c) if c != "text" else pa.array(whole, pa.string()) for c in kept]
                else:
                    columns = [column(part, "doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select(*dict.fromkeys([*kept, "text", marks])).mapInArrow(run, schema)


def dedup_substrings(docs: DataFrame, length: int = LENGTH, text_out: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row; or, with text_out, docs with what is kept as text.

    A word goes if a window of ``length`` words that covers it also starts in a document with a smaller
    doc_id; windows are judged on the input.  kept_sha256 is of the kept words joined by one space, and
    so is the text of rows that lose words.  Words are compared unchanged.  A null text has no words; a
    row with a null doc_id neither loses words nor makes others lose them; rows that share a doc_id don't
    make each other lose words.  Texts shorter than ``length`` words are whole.  Rows in = rows out, and
    further columns are passed through with text_out, else left out.

    Nodes and edges, which only say where to look, are compared by 64-bit hashes, the words of spans by a
    cryptographic digest of 128 bits.  Only texts that may
    have shared nodes, and at the end those that may lose words, are shuffled.
    """
    tag = free_name("_tag", docs.columns)
    marks, of, of_tag = (free_name(c, [*docs.columns, tag]) for c in ("_spans", "_of", "_of_tag"))
    rows = docs if text_out else docs.select("doc_id", "text")
    tagged = rows.withColumn(tag, F.hash("text"))
    spans = covered(tagged.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(tag).alias("tag")), length)
    spans = saved(spans.select(F.col("doc_id").alias(of), F.col("tag").alias(of_tag), F.col("spans").alias(marks)), "spans")
    may = possible(spans.select(of).distinct(), of)
    hit = tagged.where(may(F.col("doc_id").cast("long")))
    hit = hit.join(spans.hint("merge"), (F.col("doc_id") == F.col(of)) & (F.col(tag) == F.col(of_tag)), "left").select(*rows.columns, marks)
    whole = rows.where(~may(F.col("doc_id").cast("long")))
    if text_out:
        return _finish(hit, marks, True).unionByName(whole)
    return _finish(hit, marks, False).unionByName(_finish(whole.withColumn(marks, F.lit(None).cast(spans.schema[marks].dataType)), marks, False))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 49), ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
m AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS least FROM g),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM m WHERE least < doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
k AS (SELECT x.doc_id, count(c.q) AS n_removed, string_agg(word, ' ' ORDER BY x.q) FILTER (c.q IS NULL) AS t FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.q = c.q GROUP BY x.doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
