"""LM scoring by a weighted backoff automaton over all n-grams of up to three words.

States are the histories of at most two words that training texts hold.  From a state an arc leads over every
word that has followed it; over other words the failure arc leads to the history's suffix.  Weights are those
of Dirichlet smoothing: with the history's count n and the strength a of its order, an arc over a word seen c
times weighs (c + a * p) / (n + a), the failure arc a / (n + a), where p is what the suffix gives the word.
Weights over a state add up to 1, whatever has been seen, so no n-gram has to be left out.

Texts are read once, into batches of tokens.  A batch sends its distinct n-grams, as sorted 64-bit hashes, to
the part of the hash range that counts them, and gets their counts in all training texts back in the same
order; then it is traversed.  No table of n-grams is gathered or broadcast at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text as X
from .work import release, saved

#: Tokens of a batch, and for each part of the hash range; strength of the smoothing of pairs and of triples.
BLOCK, PART = 1 << 22, 1 << 21
#: Tokens of a step of the traversal.
STEP = 1 << 18
#: Constants that held-out text of the given tables bears out; they are not estimated from a corpus.
STRENGTH = {2: 300.0, 3: 5.0}
#: The end of a text, as a word's hash.
END = np.uint64(0x0E0F0E0D0C0B0A09)

CORPUS = "batch long, size long, row array<long>, doc_id array<long>, held_out array<boolean>, cut array<boolean>, first array<int>, skip array<int>, word binary, token binary"
COUNTS = "batch long, n int, part int, counts binary, types long, once long, twice long, total long"
SCORES = "row long, doc_id long, held_out boolean, cut boolean, n_tokens long, n_known long, base_score double, score double"


def tokens(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes with the end of each text, index of each text's first and the end)."""
    w = X.split(data, offs, lower=True)
    return np.insert(X.word_hashes(w), w.first[1:], END), w.first + np.arange(len(w.first))


# -- numbers as bytes ----------------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of their bytes, those that are all 0 left out."""
    values = np.ascontiguousarray(values, np.uint64)
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return np.array([len(values), width], np.int64).tobytes() + (pa.compress(planes, "zstd", asbytes=True) if planes else b"")


def unpack(data: bytes) -> np.ndarray:
    n, width = np.frombuffer(data, np.int64, 2)
    out = np.zeros((n, 8), np.uint8)
    if n * width:
        out[:, :width] = np.frombuffer(pa.decompress(data[16:], int(n * width), "zstd"), np.uint8).reshape(width, n).T
    return out.view(np.uint64).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """As pack(), for numbers that rise: the steps are smaller than they are."""
    return values[:1].tobytes() + pack(np.diff(values))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(np.concatenate([np.frombuffer(data, np.uint64, 1), unpack(data[8:])]), dtype=np.uint64)


# -- n-grams of a batch --------------------------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    """X.mix() in place; the lowest bit is left free."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    x &= np.uint64(0xFFFFFFFFFFFFFFFE)
    return x


def grams(h: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, whether an n-gram ends at each token, its hash) of every run of n = 1, 2, 3 words of one text; begin flags first words."""
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    there = np.ones(len(h), bool)
    key = _mixed(h ^ np.uint64(0x5BD1E995))
    yield 1, there, key
    for n in (2, 3):
        # the hash of the n - 1 words before, and the last word
        there = np.concatenate([[False], there[:-1]]) & ~begin
        longer = h * b
        longer += np.uint64(n)
        longer[1:] += key[:-1] * a
        key = _mixed(longer)
        yield n, there, key[there]


class Batch:
    """One row of CORPUS: its words' hashes h, first words of stretches, and each stretch's tokens of context."""

    def __init__(self, row: dict):
        self.row = row
        self.first = np.array(row["first"], np.int64)
        self.skip = np.array(row["skip"], np.int64)
        word = np.frombuffer(row["word"], np.uint64)
        self.h = word[unpack(row["token"]).astype(np.int64)] if len(word) else np.zeros(0, np.uint64)
        self.begin = np.zeros(len(self.h), bool)
        self.begin[self.first[:-1]] = True
        self.own = np.ones(len(self.h), bool)  # not the context that a stretch of a long text repeats
        for k in np.flatnonzero(self.skip):
            self.own[self.first[k] : self.first[k] + self.skip[k]] = False

    def spread(self, values) -> np.ndarray:
        return np.repeat(np.array(values), np.diff(self.first))


def _stretches(first: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """(text, begin, end, tokens of context) of stretches of at most ``most`` tokens and context."""
    parts = np.maximum(1, -(-np.diff(first) // most))
    text = np.repeat(np.arange(len(parts)), parts)
    k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = first[text] + k * most
    skip = np.minimum(2, k * most)
    return text, begin - skip, np.minimum(begin + most, first[text + 1]), skip


def batches(docs: DataFrame) -> DataFrame:
    """CORPUS of docs (doc_id, text, held_out): tokens of consecutive rows of a task; long texts are cut into stretches.

    A null or empty text has its end alone, a null doc_id is a row as others; an empty table gives no batch.
    """
    block = BLOCK

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        number, made = task << 36, task << 28
        held: list[list] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h = np.concatenate([x.pop(0) for x in held])
            word = h.copy()
            word.sort()
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            rank = np.argsort(-np.diff(np.append(heads, len(word))), kind="stable")  # frequent words get small numbers
            word = word[heads]
            place = np.empty(len(rank), np.int32)
            place[rank] = np.arange(len(rank), dtype=np.int32)
            index = np.empty(len(h), np.int32)
            for at in range(0, len(h), STEP):
                index[at : at + STEP] = place[np.searchsorted(word, h[at : at + STEP])]
            first = np.cumsum(np.concatenate([[0], *[x[0] for x in held]]))
            lists = [np.concatenate([x[k] for x in held]) for k in (1, 4, 5)]
            ids, outs = (pa.concat_arrays([x[k] for x in held]) for k in (2, 3))
            row = [[made], [len(h)], [lists[0]], [ids.to_pylist()], [outs.to_pylist()], [lists[1]], [first], [lists[2]], [word[rank].tobytes()], [pack(index)]]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names)

        names = [c.split()[0] for c in CORPUS.split(", ")]
        kinds = [{"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_()), "array<int>": pa.list_(pa.int32())}[c.split()[1]] for c in CORPUS.split(", ")]
        for batch in rows:
            for lo, hi, data, offs in X.pieces(batch):
                h, first = tokens(data, offs)
                ids, out = batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo)
                text, begin, end, skip = _stretches(first, block)
                if len(text) == hi - lo:
                    parts = [[h, np.diff(first), number + text, ids, out, np.zeros(len(text), bool), skip]]
                else:
                    cut = np.bincount(text)[text] > 1
                    parts = [[h[a:b], np.array([b - a]), np.array([number + t]), ids.slice(t, 1), out.slice(t, 1), np.array([c]), np.array([s])] for t, a, b, s, c in zip(text, begin, end, skip, cut)]
                for part in parts:
                    size += len(part[0])
                    held.append(part)
                    if size >= block:
                        yield flush()
                        made, size = made + 1, 0
                        held.clear()
                number += hi - lo
        if held:
            yield flush()

    return docs.mapInArrow(run, CORPUS)


def sent(corpus: DataFrame, bits: int) -> DataFrame:
    """part, n, batch, grams, counts: every distinct n-gram of a batch, and how often its training texts hold it.

    A row for each part that a batch has n-grams of: so many that they grow with batches times parts, until a row has
    one n-gram.  No batch gives no rows; rows whose held_out is null or true are in no count.
    """

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = [i << (64 - bits) for i in range(1, 1 << bits)]
        edges = np.array(edges, np.uint64)
        for batch in rows:
            for i in range(batch.num_rows):
                b = Batch(batch.slice(i, 1).to_pylist()[0])
                learned = b.spread([x is False for x in b.row["held_out"]]) & b.own
                for n, there, key in grams(b.h, b.begin):
                    key = key | learned[there]  # in the free bit
                    key.sort()
                    found = key & np.uint64(0xFFFFFFFFFFFFFFFE)
                    heads = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])[: len(found)])
                    found = found[heads]
                    counts = np.add.reduceat((key & np.uint64(1)).astype(np.int32), heads) if len(heads) else heads
                    del key, heads
                    bounds = np.concatenate([[0], np.searchsorted(found, edges), [len(found)]])
                    parts = np.flatnonzero(np.diff(bounds))
                    for some in np.array_split(parts, -(-len(parts) // 32)) if len(parts) else []:
                        packed = [(pack_sorted(found[bounds[p] : bounds[p + 1]]), pack(counts[bounds[p] : bounds[p + 1]])) for p in some]
                        size = len(some)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(some.astype(np.int32)), pa.array(np.full(size, n, np.int32)), pa.array(np.full(size, b.row["batch"])), pa.array([g for g, _ in packed], pa.binary()), pa.array([x for _, x in packed], pa.binary())],
                            ["part", "n", "batch", "grams", "counts"],
                        )

    return corpus.mapInArrow(run, "part int, n int, batch long, grams binary, counts binary")


def counted(rows: DataFrame) -> DataFrame:
    """COUNTS: for each row of sent() the counts over all batches, in the order of its n-grams; and the sums over words.

    A group holds a bounded share of the hash range: a frequent n-gram has one entry in it for each batch.
    """

    def count(table: pa.Table) -> pa.Table:
        part, n = table["part"][0].as_py(), table["n"][0].as_py()
        keys = [unpack_sorted(x.as_py()) for x in table["grams"]]
        ends = np.cumsum([len(k) for k in keys])
        key, c = np.concatenate(keys), np.concatenate([unpack(x.as_py()) for x in table["counts"]]).astype(np.int64)
        order = np.argsort(key)
        key, c = key[order], c[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        totals = np.add.reduceat(c, np.flatnonzero(new))
        out = np.empty(len(key), np.int64)
        out[order] = totals[np.cumsum(new) - 1]
        answers = [pack(x) for x in np.split(out, ends[:-1])]
        batch = table["batch"].to_pylist()
        sums = [[None] * len(batch) for _ in range(4)]
        if n == 1:
            batch, answers = [*batch, None], [*answers, None]
            sums = [[*x, int(v)] for x, v in zip(sums, ((totals > 0).sum(), (totals == 1).sum(), (totals == 2).sum(), totals.sum()))]
        columns = [pa.array(batch, pa.int64()), pa.array([n] * len(batch), pa.int32()), pa.array([part] * len(batch), pa.int32()), pa.array(answers, pa.binary()), *[pa.array(x, pa.int64()) for x in sums]]
        return pa.Table.from_arrays(columns, [c.split()[0] for c in COUNTS.split(", ")])

    return rows.groupBy("part", "n").applyInArrow(count, COUNTS)


class Automaton:
    """What all states share: training tokens, words, and the share of the unseen word."""

    def __init__(self, total: int, types: int, once: int, twice: int):
        self.total, self.types = total, types
        #: Share of unseen words: what absolute discounting takes from seen ones.
        self.discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once and twice else 0.5

    def single(self, c: np.ndarray) -> np.ndarray:
        """Probability of words of count c in the state without history; 0 is the unseen word."""
        return np.where(c > 0, c - self.discount, self.discount * self.types) / self.total

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1.0) / (self.total + self.types + 1.0))

    def traverse(self, begin: np.ndarray, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray) -> np.ndarray:
        """log10 weight of each token; words, pairs, triples: counts of the n-grams that end at it, 0 where there is none.

        The state before a token is what the token before it has led to: its count as a word and as the end of a
        pair.  A state of count 0 isn't there, and its failure arc weighs 1.
        """
        state, state_of_pair = np.zeros(len(words)), np.zeros(len(words))
        state[1:], state_of_pair[1:] = np.where(begin[1:], 0, words[:-1]), np.where(begin[1:], 0, pairs[:-1])
        weight = self.single(words)
        for history, c, strength in ((state, pairs, STRENGTH[2]), (state_of_pair, triples, STRENGTH[3])):
            # the arc, or the failure arc where c is 0, and on from the suffix
            weight = (c + strength * weight) / (history + strength)
        return np.log10(weight)


def traversed(corpus: DataFrame, counts: DataFrame, made: Automaton) -> DataFrame:
    """SCORES of every stretch of every batch."""

    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        rows = own.to_pylist()
        if not rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names)
        b = Batch(rows[0])
        at_end = {n: np.zeros(len(b.h), np.int64) for n in (1, 2, 3)}
        answers = answers.sort_by([("n", "ascending"), ("part", "ascending")])
        orders = answers["n"].to_numpy()
        for n, there, key in grams(b.h, b.begin):
            if len(key):
                found = np.concatenate([unpack(answers["counts"][int(i)].as_py()) for i in np.flatnonzero(orders == n)])
                order = np.argsort(key)
                key = key[order]
                index = np.concatenate([[0], np.cumsum(key[1:] != key[:-1], dtype=np.int32)])
                of = np.empty(len(key), np.int64)
                of[order] = found[index]
                at_end[n][there] = of
                del found, order, key, index, of
        texts = len(b.first) - 1
        owner = b.spread(np.arange(texts))[b.own]
        add = lambda v: np.bincount(owner, v[b.own], texts)
        score, base = np.zeros(len(b.h)), np.zeros(len(b.h))
        for s in range(0, len(b.h) if made.total else 0, STEP):
            lo, hi = max(0, s - 1), s + STEP  # with the token that the state comes from
            score[s:hi] = made.traverse(b.begin[lo:hi], *[at_end[n][lo:hi] for n in (1, 2, 3)])[s - lo :]
            base[s:hi] = made.base(at_end[1][s:hi])
        known = add(at_end[1] > 0).astype(np.int64)
        columns = [b.row["row"], b.row["doc_id"], b.row["held_out"], b.row["cut"], np.bincount(owner, minlength=texts), known, add(base), add(score)]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = [c.split()[0] for c in SCORES.split(", ")]
    kinds = [{"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}[c.split()[1]] for c in SCORES.split(", ")]
    return corpus.groupBy("batch").cogroup(counts.select("batch", "n", "part", "counts").groupBy("batch")).applyInArrow(run, SCORES)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learned from are the rows where held_out, an expression over doc_id, is false.  Tokens are words with
    A-Z lower-cased and one end for each text; a null text is empty and has the end alone.  base_score
    adds log10((c + 1) / (N + V + 1)) over the tokens; score adds the automaton's weights, which sum to 1
    over the known words and the one unseen word after any history.  A null doc_id is scored, its held_out
    is null and it is not learned from.  With nothing to learn from both scores are 0.  Repeated rows are
    scored each; columns other than doc_id and text are not looked at; rows in = rows out.  Words and
    n-grams are compared by 64-bit hashes.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    corpus = saved(batches(rows), "lm-corpus")
    size = corpus.agg(F.sum("size")).first()[0] or 0
    counts = saved(counted(sent(corpus, max(0, size // PART).bit_length())), "lm-counts")
    release(docs.sparkSession)  # the n-grams sent are the largest part of what is written
    t = counts.where("batch is null").agg(*[F.sum(c).alias(c) for c in ("total", "types", "once", "twice")]).first()
    made = Automaton(*[int(x or 0) for x in t])
    done = saved(traversed(corpus, counts.where("batch is not null"), made), "lm-scores")
    columns = ["doc_id", "held_out", "n_tokens", "n_known", F.lit(made.total).cast("long").alias("train_tokens"), "base_score", "score"]
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    cut = done.where("cut").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"), *sums)
    return done.where("not cut").select(columns).unionByName(cut.select(columns))


# CRC-32 of an id as text is spelled out: 3988292384 is its polynomial.
ORACLE_SQL = r"""
WITH c256 AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END, i) AS c FROM range(256) r(i))),
d AS (SELECT doc_id, xor(list_reduce(list_transform(str_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b: xor(t[1 + (xor(a, b) & 255)], a >> 8), 4294967295), 4294967295) % 7 = 2 AS held_out,
        list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') || [' '] AS w FROM documents, c256),
x AS (SELECT doc_id, held_out, w[p] AS c, CASE WHEN p > 1 THEN w[p - 1] END AS b, CASE WHEN p > 2 THEN w[p - 2] END AS a FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM d)),
u AS (SELECT c, count(*) AS n FROM x WHERE NOT held_out GROUP BY c),
v AS (SELECT b, c, count(*) AS n FROM x WHERE NOT held_out AND b IS NOT NULL GROUP BY b, c),
t AS (SELECT a, b, c, count(*) AS n FROM x WHERE NOT held_out AND a IS NOT NULL GROUP BY a, b, c),
f AS (SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS types, CASE WHEN count(*) FILTER (n = 1) > 0 AND count(*) FILTER (n = 2) > 0 THEN least(0.9, greatest(0.1, count(*) FILTER (n = 1) / (count(*) FILTER (n = 1) + 2.0 * count(*) FILTER (n = 2)))) ELSE 0.5 END AS d FROM u),
p AS (SELECT x.doc_id, x.held_out, x.a, x.b, coalesce(u.n, 0) AS c1, coalesce(h.n, 0) AS h1, coalesce(v.n, 0) AS c2, coalesce(g.n, 0) AS h2, coalesce(t.n, 0) AS c3
        FROM x LEFT JOIN u ON u.c = x.c LEFT JOIN u h ON h.c = x.b LEFT JOIN v ON v.b = x.b AND v.c = x.c LEFT JOIN v g ON g.b = x.a AND g.c = x.b LEFT JOIN t ON t.a = x.a AND t.b = x.b AND t.c = x.c),
q AS (SELECT *, CAST(CASE WHEN c1 > 0 THEN c1 - d ELSE d * types END AS DOUBLE) / total AS p1 FROM p, f),
r AS (SELECT *, CASE WHEN b IS NULL THEN p1 ELSE (c2 + PAIRS * p1) / (h1 + PAIRS) END AS p2 FROM q)
SELECT doc_id, held_out, count(*) AS n_tokens, count(*) FILTER (c1 > 0) AS n_known, total AS train_tokens, round(sum(log10((c1 + 1.0) / CAST(total + types + 1 AS DOUBLE))), 6) AS base_score,
       round(sum(log10(CASE WHEN a IS NULL THEN p2 ELSE (c3 + TRIPLES * p2) / (h2 + TRIPLES) END)), 6) AS score
FROM r GROUP BY doc_id, held_out, total
""".replace("PAIRS", str(STRENGTH[2])).replace("TRIPLES", str(STRENGTH[3]))
