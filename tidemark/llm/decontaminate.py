"""Benchmark decontamination with DataFrame functions only.

Item-sized windows of the documents are fingerprinted by SimHash; blocks of the fingerprints find every
item within the Hamming radius; the weighted similarity of the shingles decides.

Only windows that begin at a shingle of the benchmark are looked at (or the last window of a text).  That
loses none: a window whose first shingle is not in the item never gets less similar by a step to the right.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .work import BLANK_RUN, BLANKS, possible_natively, saved

#: Words of a shingle; least weighted similarity, in percent.
SHINGLE, PERCENT = 5, 80
#: Hamming radius of 64-bit fingerprints: windows at similarity 0.8 differ in 10 bits, deviation 3.
RADIUS, BLOCKS = 23, 8
#: Rows of shingles and fingerprint blocks that are broadcast at once (about 40 bytes each); a larger benchmark is handled in blocks of items.
ROWS = 2_000_000
_LANES = 0x0001000100010001
_NEAR = [0] + [1 << i for i in range(8)] + [1 << i | 1 << j for i in range(8) for j in range(i)]


def _words(text: Column) -> Column:
    trimmed = F.trim(F.lower(F.coalesce(text, F.lit(""))), F.lit(BLANKS))
    return F.when(trimmed != "", F.split(trimmed, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def _grams(hashes: str, k: int) -> Column:
    """Hashes of every k words from an array of word hashes; none if there are fewer."""
    n = F.size(hashes)
    runs = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(k)]))
    return F.when(n >= k, runs).otherwise(F.array().cast("array<bigint>"))


def _once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is worked out once a row: no filter or projection is moved below a generator."""
    return rows.withColumn(name, F.explode(F.array(value)))


def with_fingerprint(rows: DataFrame, grams: str) -> DataFrame:
    """rows with fp, the SimHash of an array of shingle hashes: each bit is that of most shingles."""
    spread = lambda h, j: F.call_function("shiftright", h, j).bitwiseAND(F.lit(_LANES))
    lanes = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda j: F.aggregate(grams, F.lit(0).cast("long"), lambda a, h: a + spread(h, j)))
    rows = _once(rows, "_lanes", lanes)
    bits = [
        F.when(2 * F.shiftright(F.col("_lanes")[j], 16 * t).bitwiseAND(F.lit(0xFFFF)) > F.size(grams), F.lit(np.uint64(1 << (j + 16 * t)).astype(np.int64).item())).otherwise(F.lit(0).cast("long"))
        for j in range(16)
        for t in range(4)
    ]
    return _once(rows, "fp", reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("_lanes")


def _block(fp: Column, b: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * b).bitwiseAND(F.lit(0xFF)).cast("int")


def _one_block(docs: DataFrame, by: list[str], items: DataFrame, spread: DataFrame, sizes: list[int], percent: int) -> DataFrame:
    """The columns ``by`` of docs, item_id, start, similarity of windows of docs near one of the items of a block.

    items: item, item_id, k, grams, words; spread: h, df of every shingle of the whole benchmark; sizes: all k.
    """
    counts = items.select("item", F.explode("grams").alias("h")).groupBy("item", "h").agg(F.count("*").alias("c"))
    weighed = counts.join(spread, "h").groupBy("item").agg(F.collect_list(F.struct("h", (1.0 / F.col("df")).alias("w"), F.col("c").cast("double").alias("c"))).alias("shingles"))
    items = saved(with_fingerprint(items, "grams").join(weighed, "item"), "items")
    lengths = saved(items.select(F.explode("grams").alias("h"), "k", "words").distinct(), "item-grams")
    may = possible_natively(lengths.select("h").distinct())

    # one pass: the shingles of every size that an item has, and the places of those that may be the benchmark's
    rows = _once(docs.select(*by, "text"), "_h", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w))).drop("text")
    for k in sizes:
        rows = _once(rows, f"_g{k}", _grams("_h", k))
    rows = rows.drop("_h")
    place = lambda k: F.transform(F.filter(F.sequence(F.lit(0), F.size(f"_g{k}") - 1), lambda i: may(F.get(F.col(f"_g{k}"), i))), lambda i: F.struct(F.lit(k).alias("k"), i.alias("i")))
    places = [F.when(F.size(f"_g{k}") > 0, place(k)).otherwise(F.array().cast("array<struct<k:int,i:int>>")) for k in sizes]
    rows = _once(rows, "_places", F.concat(*places)).withColumn("_p", F.explode("_places")).drop("_places")
    grams = reduce(lambda rest, k: F.when(F.col("_p.k") == k, F.col(f"_g{k}")).otherwise(rest), sizes[1:], F.col(f"_g{sizes[0]}"))
    rows = rows.select(*by, F.col("_p.k").alias("k"), F.col("_p.i").alias("place"), grams.alias("grams")).withColumn("h", F.get("grams", F.col("place")))
    rows = rows.join(F.broadcast(lengths), ["h", "k"])
    rows = rows.withColumn("start", F.greatest(F.lit(0), F.least("place", F.size("grams") - 1 + F.col("k") - F.col("words"))))
    rows = _once(rows, "window", F.slice("grams", F.col("start") + 1, F.col("words") - F.col("k") + 1)).select(*by, "start", "k", "words", "window")
    rows = with_fingerprint(rows, "window")

    # the windows, which are few, ask for every block of bits within two flips: an item has one row a block
    blocks = F.explode(F.array(*[F.struct(F.lit(b).alias("b"), _block(F.col("fp"), b).alias("v")) for b in range(BLOCKS)])).alias("x")
    near = items.select("k", "words", "item", F.col("fp").alias("item_fp"), blocks).select("k", "words", "item", "item_fp", "x.*")
    probes = rows.select("*", blocks).withColumn("flip", F.explode(F.array(*map(F.lit, _NEAR)))).withColumns({"b": F.col("x.b"), "v": F.col("x.v").bitwiseXOR(F.col("flip"))})
    pairs = probes.drop("x", "flip").join(F.broadcast(near), ["k", "words", "b", "v"])
    unlike = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = reduce(lambda rest, b: F.when(F.bit_count(_block(unlike, b)) <= 2, b).otherwise(rest), reversed(range(BLOCKS)), F.lit(-1))
    pairs = pairs.where((F.bit_count(unlike) <= RADIUS) & (first == F.col("b"))).select(*by, "start", "window", "item")

    pairs = pairs.join(F.broadcast(items.select("item", "item_id", "shingles")), "item")
    times = F.transform("shingles", lambda g: F.struct(g["w"].alias("w"), g["c"].alias("c"), F.size(F.filter("window", lambda x: x == g["h"])).cast("double").alias("n")))
    pairs = _once(pairs, "times", times)
    total = lambda f: F.aggregate("times", F.lit(0.0), lambda a, g: a + f(g))
    both = total(lambda g: g["w"] * F.least(g["c"], g["n"]))
    any_ = total(lambda g: g["w"] * F.greatest(g["c"], g["n"])) + F.size("window") - total(lambda g: g["n"])
    pairs = _once(pairs, "similarity", F.round(both / any_, 9))  # so that equal windows tie
    return pairs.where(100 * F.col("similarity") >= percent - 1e-9).select(*by, "item_id", "start", "similarity")


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = SHINGLE, percent: int = PERCENT, by: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc_id, item_id, start, similarity: documents with a window near an item; of the best windows the first.

    Words are runs outside white space, in lower case.  A window has as many words as the item, or all
    words of a shorter text.  Similarity is the sum over shingles of weight * least count divided by that
    of weight * greatest count; a shingle of an item weighs 1 / the number of items that hold it, any other 1.
    Items of fewer than k words are found where all their words stand in a row.  Items or documents with
    null or blank text are near nothing; null ids are reported as null; repeated rows are reported once.
    by: the columns of docs that tell rows apart, reported for each find; others are not looked at.
    Documents are read whole and not shuffled, in one pass for all items; a benchmark of more than ROWS
    shingles (some 35,000 items of 50 words) is dealt into blocks of items, with a pass and equal results for each.
    """
    by = list(by)
    items = benchmark.select("item_id", "text").dropDuplicates()
    items = items.withColumn("_k", F.least(F.size(_words(F.col("text"))), F.lit(k))).where("_k > 0")
    sizes = sorted(r["_k"] for r in items.select("_k").distinct().collect())  # at most k
    none = docs.select(*by, F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("start"), F.lit(0.0).alias("similarity")).limit(0)
    if not sizes:
        return none
    rows = _once(items, "_h", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)))
    grams = reduce(lambda rest, n: F.when(F.col("_k") == n, _grams("_h", n)).otherwise(rest), sizes[1:], _grams("_h", sizes[0]))
    whole = _once(rows, "grams", grams).select("item_id", F.col("_k").alias("k"), "grams", F.size("_h").alias("words"))
    whole = saved(whole.withColumn("item", F.xxhash64("item_id", "k", "grams")).dropDuplicates(["item"]), "benchmark")
    # over all items, so that no weight depends on the blocks
    spread = saved(whole.select(F.explode(F.array_distinct("grams")).alias("h")).groupBy("h").agg(F.count("*").alias("df")), "spread")
    blocks = max(1, -(-whole.agg(F.sum(F.size("grams") + F.lit(BLOCKS))).first()[0] // ROWS))
    found = none
    for i in range(blocks):
        found = found.union(_one_block(docs, by, whole.where(F.pmod("item", F.lit(blocks)) == i), spread, sizes, percent))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("s")))
    return found.groupBy(*by, "item_id").agg(best.alias("b")).select(*by, "item_id", (-F.col("b.s")).alias("start"), F.col("b.similarity").alias("similarity"))


ORACLE_SQL = r"""
WITH i AS (SELECT row_number() OVER () AS item, * FROM (SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark) WHERE len(w) > 0),
g AS (SELECT item, k, n, s, count(*) AS c FROM (SELECT item, k, n, list_slice(w, p, p + k - 1) AS s FROM (SELECT item, w, len(w) AS n, least(len(w), 5) AS k, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM i)) GROUP BY ALL),
f AS (SELECT k, s, 1.0 / count(DISTINCT item) AS weight FROM g GROUP BY k, s),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
e AS (SELECT r, doc_id, k, p - 1 AS p, len(w) - k + 1 AS m, list_slice(w, p, p + k - 1) AS s FROM (SELECT r, doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
c AS (SELECT DISTINCT r, doc_id, k, n, m, greatest(0, least(p, m - 1 + k - n)) AS start FROM e JOIN (SELECT DISTINCT k, n, s FROM g) USING (k, s)),
v AS (SELECT c.r, c.doc_id, c.k, c.n, c.start, e.s, count(*) AS q FROM c JOIN e ON e.r = c.r AND e.k = c.k AND e.p BETWEEN c.start AND c.start + c.n - c.k GROUP BY ALL),
a AS (SELECT r, doc_id, k, n, start, sum(q) AS size FROM v GROUP BY ALL),
b AS (SELECT DISTINCT r, doc_id, k, n, start, item FROM v JOIN g USING (k, n, s)),
x AS (SELECT b.r, b.doc_id, b.k, b.n, b.start, b.item, sum(weight * least(g.c, coalesce(q, 0))) AS inside, sum(weight * greatest(g.c, coalesce(q, 0))) AS most, sum(coalesce(q, 0)) AS seen
        FROM b JOIN g USING (item) JOIN f ON f.k = g.k AND f.s = g.s LEFT JOIN v ON v.r = b.r AND v.k = b.k AND v.n = b.n AND v.start = b.start AND v.s = g.s GROUP BY ALL),
y AS (SELECT x.doc_id, item_id, x.start, round(CAST(inside AS DOUBLE) / (most + size - seen), 9) AS similarity FROM x JOIN a USING (r, k, n, start) JOIN i USING (item))
SELECT doc_id, item_id, CAST(min(start) AS INT) AS start, similarity FROM (SELECT *, max(similarity) OVER (PARTITION BY doc_id, item_id) AS best FROM y WHERE 100 * similarity >= 80 - 1e-9) WHERE similarity = best GROUP BY doc_id, item_id, similarity
"""
