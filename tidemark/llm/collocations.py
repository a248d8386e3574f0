"""Phrase collocations by dynamic itemset counting over contiguous words.

The corpus lies in SHARDS shards that are scanned in turn, again and again.  Words are counted from the first scan on; a
longer phrase is activated once both phrases that it consists of but for its last or its first word have reached the
threshold in what has been scanned so far, and is counted for one full cycle of shards from then on.  So short and
long phrases are counted in the same scans, and phrases that can't be frequent are never counted.

A scan asks bitmaps of bounded size which phrases are active.  They let some others pass, which does no harm: a
phrase has one count in each shard, however often that is scanned, and reaches the threshold only if it really is frequent.

Frequent phrases are scored as numbers, by the keys of their parts.  Only those that come among a language's first, or
share the last place, are spelled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from . import text as X
from .lm_score import pack, pack_sorted, unpack, unpack_sorted
from .work import fresh_path, possible_natively, saved

#: Shards of the corpus; least count of a phrase; most words; phrases reported for each language.
SHARDS, LEAST, LONGEST, MOST = 4, 10, 3, 2000
#: A phrase is dropped if a longer one that holds it has so many percent of its count.
INSIDE = 50
#: Most bits of a bitmap, as a power of 2: 16 MB.
BITS = 27
#: Words whose phrases a task counts at once; bytes of text for each part of the hash range, four times as many once there are MANY.
BLOCK, PART, MANY = 1 << 21, 1 << 23, 64
#: Parts in which a language's phrases are ranked first.
SALTS = 64

# What ends a piece, and what lies between words.
ENDS, BETWEEN = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

_table = np.ones(256, bool)
_table[list(ENDS + BETWEEN)] = False
_end = np.zeros(256, bool)
_end[list(ENDS)] = True


# -- phrases of a shard --------------------------------------------------------------------------------


def _joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    out = a * np.uint64(0x9E3779B97F4A7C15)
    out += b
    out += np.uint64(n)
    return X.mixed(out)


class Phrases:
    """The phrases of a run of texts: words.starts and ends; key[n][i]: hash of the n words from word i, there[n][i]: whether
    they lie in one piece.  tongue: a hash of its language for each word, which is part of every key."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, tongue: np.ndarray):
        self.words = w = X.split(data, offs, lower=True, table=_table)
        self.tongue = np.repeat(tongue, np.diff(w.first))
        stops = np.flatnonzero(_end[w.data])
        piece = np.searchsorted(stops, w.starts)
        text = np.repeat(np.arange(len(offs) - 1), np.diff(w.first))
        next_ = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        self.key = {1: _joined(self.tongue, X.word_hashes(w), 1)}
        self.there = {1: np.ones(len(w.starts), bool)}
        for n in range(2, LONGEST + 1):
            before = self.key[n - 1]
            size = max(0, len(w.starts) - n + 1)
            self.key[n] = _joined(before[:size], self.key[1][n - 1 :], n)
            self.there[n] = self.there[n - 1][:size] & next_[n - 2 :][:size] if size else np.zeros(0, bool)

    def parts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of each phrase of n words without its last and without its first word."""
        size = len(self.key[n])
        return self.key[n - 1][:size], self.key[n - 1][1:][:size]


def dealt(docs: DataFrame) -> tuple[DataFrame, int]:
    """shard, row, tongue, lang, text of the rows with a text, written by shard, and their bytes; rows go to the shards in turn."""
    spark, path, seen = docs.sparkSession, fresh_path(docs.sparkSession, "shards"), Observation()
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").where("text <> ''")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.xxhash64("lang").alias("tongue"), "lang", "text").withColumn("shard", (F.col("row") % SHARDS).cast("int"))
    rows.observe(seen, F.sum(F.octet_length("text")).alias("bytes")).write.partitionBy("shard").parquet(path)
    return spark.read.schema("row long, tongue long, lang string, text string, shard int").parquet(path), int(seen.get["bytes"] or 0)


def split_bits(size: int) -> int:
    """How many of a key's first bits name its part of the hash range, for so many bytes of text.

    A batch has an entry for every part, so from MANY parts on these take four times as much text: else entries, which
    grow with batches times parts, hold few phrases each.
    """
    return max(min(size // PART, MANY - 1), size // (4 * PART)).bit_length()


class Bitmap(NamedTuple):
    """2 ** bits bits, in 2 ** top blocks by the first bits of a key."""

    bits: int
    top: int
    data: np.ndarray


def places(bits: int, top: int, keys: np.ndarray, home: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """The two places of every key, both in its block; at another home a key has others."""
    low = np.uint64(bits - top)
    block = keys >> np.uint64(64 - top) << low
    if home is not None:
        keys = keys ^ X.mix(home.astype(np.uint64) + np.uint64(1))
    for by in (0, 28):
        yield block | (keys >> np.uint64(by)) & np.uint64((1 << (bits - top)) - 1)


def bitmap(keys: DataFrame, count: int, split: int) -> Bitmap:
    """Of keys (key, and home if there is one): 16 bits for each of ``count``, up to 2 ** BITS in all; then it lets more pass.

    A task gives the blocks that it has keys of: few, where its keys are those of some parts of the hash range.
    """
    bits = min(BITS, max(10, (16 * count).bit_length()))
    top = max(1, min(split, bits - 6))
    low = bits - top

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.uint64)]
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64)
            held += places(bits, top, key, batch.column(1).to_numpy() if batch.num_columns > 1 else None)
        at = np.concatenate(held)
        at.sort()
        blocks, first = np.unique(at >> np.uint64(low), return_index=True)
        for block, own in zip(blocks.tolist(), np.split(at, first[1:])):
            flags = np.zeros(1 << low, bool)
            flags[own & np.uint64((1 << low) - 1)] = True
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary())], ["block", "bits"])

    found = keys.mapInArrow(run, "block long, bits binary").toArrow()
    data = np.zeros((1 << top, 1 << (low - 3)), np.uint8)
    for block, own in zip(found["block"].to_pylist(), found["bits"]):
        data[block] |= np.frombuffer(own.as_buffer(), np.uint8)
    return Bitmap(bits, top, data.ravel())


def passes(made: Bitmap, keys: np.ndarray, home: np.ndarray | None = None) -> np.ndarray:
    out = np.ones(len(keys), np.uint8)
    for p in places(made.bits, made.top, keys, home):
        out &= made.data[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)
    return (out & np.uint8(1)).astype(bool)


def homes(row: np.ndarray) -> np.ndarray:
    """The file of the corpus that each row lies in, as a number: the task that dealt it out, and its shard."""
    return (row >> np.uint64(33)) * np.uint64(SHARDS) + row % np.uint64(SHARDS)  # the upper bits of Spark's rising ids are the task


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Phrases]]:
    """The numbers and the phrases of some rows of a batch (tongue, text, row), all of one home."""
    for batch in batches:
        tongue, row = (batch.column(k).to_numpy(zero_copy_only=False).view(np.uint64) for k in (0, 2))
        cuts = [0, *(np.flatnonzero(np.diff(homes(row))) + 1).tolist(), len(row)]
        for a, b in zip(cuts, cuts[1:]):
            for lo, hi, data, offs in X.pieces(batch.slice(a, b - a)):
                yield row[a + lo : a + hi], Phrases(data, offs, tongue[a + lo : a + hi])


SCAN = "n int, home int, part int, grams binary, counts binary"


def scanned(shard: DataFrame, lengths: list[int], bits: int, active: Callable[[int, Phrases], np.ndarray]) -> DataFrame:
    """SCAN: the phrases of these lengths that active() marks and how often a batch of texts of one home holds them, for each part of the hash range.

    With length 1 also how many words a language has, under n 0 and its hash.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {n: [] for n in [0, *lengths]}
        edges = np.array([i << (64 - bits) for i in range(1, 1 << bits)], np.uint64)
        size, home = 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            for n, own in held.items():
                if not own:
                    continue
                key, c = np.unique(np.concatenate(own), return_counts=True)
                own.clear()
                bounds = np.concatenate([[0], np.searchsorted(key, edges), [len(key)]])
                parts = np.flatnonzero(np.diff(bounds))
                packed = [(pack_sorted(key[bounds[i] : bounds[i + 1]]), pack(c[bounds[i] : bounds[i + 1]])) for i in parts]
                columns = [*[pa.array(np.full(len(parts), x, np.int32)) for x in (n, home)], pa.array(parts.astype(np.int32)), *[pa.array([x[k] for x in packed], pa.binary()) for k in (0, 1)]]
                yield pa.RecordBatch.from_arrays(columns, ["n", "home", "part", "grams", "counts"])

        for row, p in _pieces(batches):
            at = int(homes(row[:1])[0])
            if size >= block or at != home:
                yield from flush()
                size, home = 0, at
            for n in lengths:
                held[n].append(p.key[n][active(n, p)])
            if 1 in lengths:
                held[0].append(p.tongue)
            size += len(p.tongue)
        yield from flush()

    block = BLOCK
    return shard.select("tongue", "text", "row").mapInArrow(run, SCAN)


# -- dynamic counting ----------------------------------------------------------------------------------


def totals(scans: dict[int, DataFrame], least: int, looks: list[int]) -> DataFrame:
    """key, f, reached, home of the phrases of scans (SCAN rows by number of the scan) that have come to ``least``.

    f: the count over all shards scanned so far; reached: the scan after which that was seen, of those in looks, which
    rise; home: one that holds the phrase.  A shard that two scans have counted, because a bitmap let a phrase pass, counts once.  A group is a
    part of the hash range, of a bounded share of the corpus; a frequent phrase has an entry for each batch in it.
    """
    rows, shards = None, SHARDS
    for t, own in scans.items():
        own = own.select("part", "home", "grams", "counts", F.lit(t).alias("t"))
        rows = own if rows is None else rows.unionByName(own)

    def count(table: pa.Table) -> pa.Table:
        grams = [unpack_sorted(x.as_py()) for x in table["grams"]]
        entry = np.repeat(np.arange(len(grams), dtype=np.int32), [len(k) for k in grams])
        key = np.concatenate(grams)
        grams.clear()
        c = np.concatenate([unpack(x.as_py()).astype(np.int64) for x in table["counts"]])
        # most phrases are rare: those whose low bits don't come to ``least`` together need no sort
        low = key & np.uint64((1 << max(10, len(key).bit_length() - 1)) - 1)
        may = np.flatnonzero(np.bincount(low.view(np.int64), c)[low] >= least)
        entry, c = entry[may], c[may]
        key, first, index = np.unique(key[may], return_index=True, return_inverse=True)
        home, at = table["home"].to_numpy()[entry[first]], table["t"].to_numpy()[entry]
        f, reached = np.zeros(len(key), np.int64), np.full(len(key), -1, np.int32)
        seen: dict[int, np.ndarray] = {}
        for t in np.unique(at).tolist():
            own = np.bincount(index[at == t], c[at == t], len(key)).astype(np.int64)
            shard = t % shards
            before = seen.get(shard)
            f += own if before is None else np.maximum(own - before, 0)
            seen[shard] = own if before is None else np.maximum(own, before)
            reached[(reached < 0) & (f >= least)] = t
        kept = np.flatnonzero(f >= least)
        seen_at = np.array(looks, np.int32)[np.searchsorted(looks, reached[kept])]
        return pa.Table.from_arrays([X.longs(key[kept]), pa.array(f[kept]), pa.array(seen_at), pa.array(home[kept])], ["key", "f", "reached", "home"])

    return rows.groupBy("part").applyInArrow(count, "key long, f long, reached int, home int")


def counted(corpus: DataFrame, split: int) -> dict[int, DataFrame]:
    """By length: key, f, reached, home of all phrases that come to LEAST; under 0: key, f of every language's words.

    A phrase is counted in scan t if what it is built on came to LEAST before, and one of the two in the last SHARDS scans.
    What has come to LEAST is looked up after each scan of the first cycle, then at the end of a cycle and of the
    length's last scan: what is seen later starts its cycle later.
    """
    spark = corpus.sparkSession
    scans: dict[int, dict[int, DataFrame]] = {n: {} for n in range(LONGEST + 1)}
    looks: dict[int, list[int]] = {n: [] for n in range(1, LONGEST)}
    found: dict[int, DataFrame] = {}
    count: dict[int, dict[int, int]] = {}  # by the scan after which they were seen
    ever: dict[int, Bitmap] = {}
    last: dict[int, int] = {}
    t = 0

    def goes_on(n: int, t: int) -> bool:
        return t < SHARDS if n == 1 else last.get(n - 1, -SHARDS - 1) >= t - SHARDS

    while True:
        lengths = [n for n in range(1, LONGEST + 1) if goes_on(n, t)]
        if not lengths:
            break
        late: dict[int, Bitmap | None] = {}
        for n in lengths:
            if n > 1:
                some = sum(c for at, c in count[n - 1].items() if at >= t - SHARDS)
                late[n] = bitmap(found[n - 1].where(F.col("reached") >= t - SHARDS).select("key"), some, split) if some < sum(count[n - 1].values()) else None
        shipped = spark.sparkContext.broadcast({n: (ever[n - 1], late[n]) for n in late})

        def active(n: int, p: Phrases, shipped=shipped) -> np.ndarray:
            if n == 1:
                return p.there[1]
            ever, late = shipped.value[n]
            out, shorter = p.there[n].copy(), p.there[n - 1]
            if late is None:
                here = np.zeros(len(shorter), bool)
                here[shorter] = passes(ever, p.key[n - 1][shorter])
                return out & here[: len(out)] & here[1:][: len(out)]
            here = np.zeros(len(shorter), bool)  # the smaller bitmap first
            here[shorter] = passes(late, p.key[n - 1][shorter])
            out &= here[: len(out)] | here[1:][: len(out)]
            for keys in p.parts(n):
                at = np.flatnonzero(out)
                out[at] = passes(ever, keys[at])
            return out

        path = fresh_path(spark, "scan")
        scanned(corpus.where(F.col("shard") == t % SHARDS), lengths, split, active).write.partitionBy("n").parquet(path)  # each length is read alone
        rows = spark.read.schema(SCAN).parquet(path)
        for n in [*lengths, 0] if 1 in lengths else lengths:
            scans[n][t] = rows.where(F.col("n") == n)
        for n in lengths:
            if n < LONGEST and (t < SHARDS or (t + 1) % SHARDS == 0 or not goes_on(n, t + 1)):
                looks[n].append(t)
                path, seen = fresh_path(spark, "frequent"), Observation()
                totals(scans[n], LEAST, looks[n]).observe(seen, *[F.count_if(F.col("reached") == at).alias(str(at)) for at in looks[n]]).write.parquet(path)
                count[n] = {at: seen.get[str(at)] for at in looks[n] if seen.get[str(at)]}
                if count[n]:
                    found[n], last[n] = spark.read.schema("key long, f long, reached int, home int").parquet(path), max(count[n])
                    ever[n] = bitmap(found[n].select("key"), sum(count[n].values()), split)
        t += 1
    if scans[LONGEST]:
        found[LONGEST] = saved(totals(scans[LONGEST], LEAST, [t]), "frequent")
    found[0] = totals(scans[0], 1, [t])
    none = spark.createDataFrame([], "key long, f long, reached int, home int")
    return {n: found.get(n, none) for n in range(LONGEST + 1)}


# -- scores and spelling -------------------------------------------------------------------------------

#: Phrases that a task remembers to have given out, a power of 2.
GIVEN = 1 << 17
PARTS = "key long, n int, home int, a long, tongue long, row long, lefts array<long>, rights array<long>"


def marked(candidates: DataFrame, split: int) -> dict[int, Bitmap]:
    """A bitmap a length of candidates (n, key, home): a key is looked for at its home alone."""
    count = {r["n"]: r["count"] for r in candidates.groupBy("n").count().collect()}  # a row a length
    return {n: bitmap(candidates.where(F.col("n") == n).select("key", "home"), count.get(n, 0), split) for n in range(2, LONGEST + 1)}


def _at_home(p: Phrases, row: np.ndarray, n: int, made: Bitmap, given: np.ndarray) -> np.ndarray:
    """The places of the phrases of n words of these rows that may be in a bitmap of marked(), the first of each; given: what has been
    given out lately, by low bits, is left out."""
    at = np.flatnonzero(p.there[n])
    key = p.key[n][at]
    low = (key & np.uint64(len(given) - 1)).astype(np.int64)
    new = np.flatnonzero(given[low] != key)
    new = new[passes(made, key[new], homes(row[:1]))]
    given[low[new]] = key[new]
    return at[new[np.unique(key[new], return_index=True)[1]]]


def taken_apart(corpus: DataFrame, candidates: DataFrame, split: int) -> DataFrame:
    """PARTS of candidates (n, key, home, a): a row of the corpus that holds the phrase, its home, and the keys of
    both parts of each cut.

    lefts and rights: of the cut after the first word, the second and so on.  The parts of the hash range meet their
    candidates as in totals(), so what a bitmap let pass goes no further.
    """
    shipped, limit = corpus.sparkSession.sparkContext.broadcast(marked(candidates, split)), BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {n: [] for n in range(2, LONGEST + 1)}
        given = {n: np.zeros(GIVEN, np.uint64) for n in held}
        edges = np.array([i << (64 - split) for i in range(1, 1 << split)], np.uint64)
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for n, own in held.items():
                if not own:
                    continue
                rows = np.concatenate(own, axis=1)
                own.clear()
                rows = rows[:, np.unique(rows[0], return_index=True)[1]]
                bounds = np.concatenate([[0], np.searchsorted(rows[0], edges), [rows.shape[1]]])
                parts = np.flatnonzero(np.diff(bounds))
                packed = [np.ascontiguousarray(rows[:, bounds[i] : bounds[i + 1]]).tobytes() for i in parts]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(parts), n, np.int32)), pa.array(parts.astype(np.int32)), pa.array(packed, pa.binary())], ["n", "part", "links"])

        for row, p in _pieces(batches):
            text = np.repeat(row, np.diff(p.words.first))
            for n in held:
                at = _at_home(p, row, n, shipped.value[n], given[n])
                lefts, rights = [p.key[k][at] for k in range(1, n)], [p.key[n - k][at + k] for k in range(1, n)]
                held[n].append(np.stack([p.key[n][at], p.tongue[at], text[at], *lefts, *rights]))
                size += held[n][-1].size
            if size >= limit:
                yield from flush()
                size = 0
        yield from flush()

    def meet(links: pa.Table, wanted: pa.Table) -> pa.Table:
        if not links.num_rows or not wanted.num_rows:
            return pa.Table.from_batches([], kinds)
        n = links["n"][0].as_py()
        rows = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64).reshape(2 * n + 1, -1) for x in links["links"]], axis=1)
        key, a = wanted["key"].to_numpy().view(np.uint64), wanted["a"].to_numpy()
        _, here, there = np.intersect1d(rows[0], key, return_indices=True)
        rows, cuts = rows[:, here], np.arange(len(here) + 1) * (n - 1)
        home = homes(rows[2]).astype(np.int32)  # a full bitmap lets a phrase pass elsewhere too
        columns = [X.longs(rows[0]), pa.array(np.full(len(here), n, np.int32)), pa.array(home), pa.array(a[there]), X.longs(rows[1]), X.longs(rows[2])]
        return pa.Table.from_arrays([*columns, X.long_lists(rows[3 : n + 2].T.ravel(), cuts), X.long_lists(rows[n + 2 :].T.ravel(), cuts)], schema=kinds)

    kinds = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}[c.split()[1]]) for c in PARTS.split(", ")])
    links = corpus.select("tongue", "text", "row").mapInArrow(run, "n int, part int, links binary")
    part = F.shiftrightunsigned("key", 64 - split).cast("int") if split else F.lit(0)
    return links.groupBy("n", "part").cogroup(candidates.withColumn("part", part).groupBy("n", "part")).applyInArrow(meet, PARTS)


def spelled(corpus: DataFrame, chosen: DataFrame) -> DataFrame:
    """key, phrase of what may be chosen (n, key, home, row), once; only texts that may be such a row are read by words."""
    shipped = corpus.sparkSession.sparkContext.broadcast(marked(chosen, 0))
    may = possible_natively(chosen.select(F.xxhash64("row").alias("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = {n: np.zeros(GIVEN, np.uint64) for n in shipped.value}
        for row, p in _pieces(batches):
            raw, w = p.words.data.tobytes(), p.words
            for n, made in shipped.value.items():
                at = _at_home(p, row, n, made, given[n])
                phrase = [b" ".join(raw[x:y].split()).decode() for x, y in zip(w.starts[at].tolist(), w.ends[at + n - 1].tolist())]
                yield pa.RecordBatch.from_arrays([X.longs(p.key[n][at]), pa.array(phrase, pa.string())], ["key", "phrase"])

    phrases = corpus.where(may(F.xxhash64("row"))).select("tongue", "text", "row").mapInArrow(run, "key long, phrase string")
    return phrases.dropDuplicates(["key"])


def ranked(rows: DataFrame, order: list[Column], most: int) -> DataFrame:
    """rows with their rank, the first ``most`` of each tongue; first those of each salt are found."""
    for by in (["tongue", "salt"], ["tongue"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= most)
    return rows


def collocations(docs: DataFrame, most: int = MOST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``most`` phrases of highest score.

    Texts, A-Z lower-cased, are split into pieces at ENDS, those into words at blanks and tabs.  A phrase is a run of 2 to
    LONGEST words of a piece that a language's texts hold LEAST times; a is its count, overlaps included, n the language's
    words.  l and r are the counts of the parts at the cut of lowest score floor(10^6 a a / (l r)), of equal ones the
    first.  A phrase inside a longer one that holds at least INSIDE percent of its count is left out.  Order is by score and
    a falling, then by the phrase's bytes.  A null language is `und`, with texts whose language is so called; null
    and empty texts hold nothing, repeated rows count each, languages without phrases and empty tables give no rows.
    Only lang and text are read.  Phrases are told apart by 64-bit hashes.
    """
    corpus, size = dealt(docs)
    split = split_bits(size)
    counts = counted(corpus, split)
    candidates = None
    for n in range(2, LONGEST + 1):
        own = counts[n].select(F.lit(n).alias("n"), "key", "home", F.col("f").alias("a"))
        candidates = own if candidates is None else candidates.unionByName(own)
    named = saved(taken_apart(corpus, candidates, split), "phrases")

    inside = named.where("n > 2").select(F.explode(F.array(F.element_at("lefts", -1), F.get("rights", F.lit(0)))).alias("key"), F.col("a").alias("longer"))
    inside = inside.groupBy("key").agg(F.max("longer").alias("longer"))
    kept = named.join(inside.hint("merge"), "key", "left").where(f"longer is null or 100 * longer < {INSIDE} * a")

    parts = None
    for n in range(1, LONGEST):
        own = counts[n].select("key", "f")
        parts = own if parts is None else parts.unionByName(own)
    of = lambda end: parts.select(F.col("key").alias(end), F.col("f").alias(f"f_{end}")).hint("merge")
    known = ["key", "n", "home", "tongue", "row", "a"]
    cuts = kept.select(*known, F.posexplode(F.arrays_zip("lefts", "rights")).alias("k", "cut"))
    cuts = cuts.select(*known, "k", F.col("cut.lefts").alias("left"), F.col("cut.rights").alias("right"))
    cuts = cuts.join(of("left"), "left").join(of("right"), "right")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    cuts = cuts.withColumns({"_above": wide("a") * wide("a") * F.lit(1_000_000), "_below": wide("f_left") * wide("f_right")}).withColumn("score", F.expr("_above div _below"))
    cuts = cuts.withColumn("lowest", F.col("score") * LONGEST + F.col("k"))  # numbers alone, which Spark aggregates in place; a score is 10^6 at most
    scored = cuts.groupBy(*known).agg(F.min_by("f_left", "lowest").alias("l"), F.min_by("f_right", "lowest").alias("r"), F.min("score").alias("score"))
    scored = saved(scored.withColumn("salt", F.pmod("key", F.lit(SALTS))), "scored")

    # a language's last place by score and count: what shares it is spelled too
    order = [F.desc("score"), F.desc("a")]
    least = ranked(scored.select("tongue", "salt", "score", "a"), order, most).groupBy("tongue").agg(F.min(F.struct("score", "a")).alias("least"))
    least = least.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    chosen = saved(scored.join(least, ["tongue", "salt"]).where(F.struct("score", "a") >= F.col("least")).drop("least"), "chosen")

    first = ranked(spelled(corpus, chosen).join(chosen, "key"), [*order, F.asc("phrase")], most)
    names = corpus.groupBy("tongue").agg(F.first("lang").alias("lang")).join(counts[0].select(F.col("key").alias("tongue"), F.col("f").alias("n")), "tongue")
    return first.drop("n").join(names, "tongue").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ 	]+'), lambda x: x <> '') AS w FROM d),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, list_slice(w, i, i + k - 1) AS s FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 4) r(k) WHERE len(w) >= k)),
f AS (SELECT lang, s, count(*) AS f FROM g GROUP BY lang, s HAVING count(*) >= 10),
c AS (SELECT * FROM f WHERE len(s) > 1),
h AS (SELECT lang, s, max(f) AS f FROM (SELECT lang, list_slice(s, 1, 2) AS s, f FROM c WHERE len(s) = 3 UNION ALL SELECT lang, list_slice(s, 2, 3), f FROM c WHERE len(s) = 3) GROUP BY ALL),
k AS (SELECT c.lang, c.s, c.f AS a FROM c LEFT JOIN h ON h.lang = c.lang AND h.s = c.s WHERE h.f IS NULL OR 100 * h.f < 50 * c.f),
x AS (SELECT k.lang, k.s, a, i, u.f AS l, v.f AS r, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(u.f AS HUGEINT) * v.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, len(s))) AS i FROM k) k JOIN f u ON u.lang = k.lang AND u.s = list_slice(k.s, 1, i) JOIN f v ON v.lang = k.lang AND v.s = list_slice(k.s, i + 1, len(k.s))),
y AS (SELECT lang, array_to_string(s, ' ') AS phrase, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, s ORDER BY score, i) AS o FROM x) WHERE o = 1),
z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM y)
SELECT lang, rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang) WHERE rank <= 2000
"""
