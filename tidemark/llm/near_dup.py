"""Near-duplicates by b-bit MinHash: band candidates, packed low bits for estimates, exact links.

Inside a bucket members meet the most central text, and what isn't linked to it meets others only where
counts or shared words leave a link possible.  Where members lack much of the centre in many ways, that
is most of them: no link is lost, but the work of such a bucket grows with its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import minhash as M
from . import text as X
from .components import components
from .work import possible, saved

#: Permutations, rows of a band, low bits kept.  At similarity 0.8 a pair shares no band with probability 5e-8.
PERMUTATIONS, ROWS, BITS = 128, 4, 4
#: Pairs whose estimate is this far below the threshold are dropped: over 6 standard errors of an estimate.
SLACK = 0.25
#: A shingle that one in COMMON members of a group has is taken into the group's measure.
COMMON = 10

def signatures(docs: DataFrame, k: int, by: list[str]) -> DataFrame:
    """doc_id, the columns ``by``, n_shingles, key (128-bit digest of the word sequence), bands, planes of every row, whatever its text or id.

    Null and blank texts have 0 shingles and the digest of nothing; an empty table gives no rows.
    """
    own = ["doc_id", *by]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = M.seeds(PERMUTATIONS)
        for batch in batches:
            for lo, hi, data, offs in X.pieces(batch):
                w = X.split(data, offs, lower=True)
                h = X.word_hashes(w)
                start, end, bounds = X.shingle_ranges(w.first, k)
                grams = X.gram_hashes(h, start, end)
                sig = np.empty((hi - lo, PERMUTATIONS), np.uint32)
                count = np.empty(hi - lo, np.int64)
                for i in range(hi - lo):
                    shingles = np.unique(grams[bounds[i] : bounds[i + 1]])
                    count[i] = len(shingles)
                    sig[i] = M.minima(shingles, a, b)
                bands, planes = M.band_keys(sig, ROWS), M.planes(sig, BITS)
                lists = [X.long_lists(x.ravel(), np.arange(hi - lo + 1) * x.shape[1]) for x in (bands, planes)]
                passed = [batch.column(i + 1).slice(lo, hi - lo) for i in range(len(own))]
                yield pa.RecordBatch.from_arrays([*passed, pa.array(count), X.text_digests(w), *lists], [*own, "n_shingles", "key", "bands", "planes"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in own)
    return docs.select("text", *own).mapInArrow(run, f"{kinds}, n_shingles long, key binary, bands array<long>, planes array<long>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """key and sorted distinct shingle hashes, once for each of wanted (doc_id, key), from whole texts.

    Texts are not moved: a filter by doc_id comes before the shingles, and the sets are joined by key.
    Rows that only share a doc_id have another key; repeated texts give one set.  Null ids are in no set;
    nothing wanted gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in X.pieces(batch):
                w = X.split(data, offs, lower=True)
                h = X.word_hashes(w)
                start, end, bounds = X.shingle_ranges(w.first, k)
                grams = X.gram_hashes(h, start, end)
                own = [np.unique(grams[bounds[i] : bounds[i + 1]]) for i in range(hi - lo)]
                ends = np.concatenate([[0], np.cumsum([len(x) for x in own])])
                yield pa.RecordBatch.from_arrays([X.text_digests(w), X.long_lists(np.concatenate(own) if own else np.zeros(0, np.uint64), ends)], ["key", "grams"])

    may = possible(wanted.select("doc_id").distinct(), "doc_id")
    rows = docs.where(may(F.col("doc_id"))).select("text").mapInArrow(run, "key binary, grams array<long>")
    return rows.dropDuplicates(["key"]).join(wanted.select("key").hint("merge"), "key", "left_semi")


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two signatures' bit planes, corrected for low bits that agree by chance."""
    words = PERMUTATIONS // 64
    differ = F.lit(0)
    for w in range(words):
        unlike = F.lit(0).cast("long")
        for bit in range(BITS):
            unlike = unlike.bitwiseOR(F.get(a, F.lit(bit * words + w)).bitwiseXOR(F.get(b, F.lit(bit * words + w))))
        differ = differ + F.bit_count(unlike)
    chance = 0.5**BITS
    return (1 - differ / PERMUTATIONS - chance) / (1 - chance)


def _both(pairs: DataFrame, facts: DataFrame, a: str, b: str, columns: dict[str, str]) -> DataFrame:
    """pairs with facts of both ends, named after columns with 1 and 2.  The plan is the same at every size."""
    for end, key in ((1, a), (2, b)):
        pairs = pairs.join(facts.select(F.col("key").alias(key), *[F.col(c).alias(f"{n}{end}") for c, n in columns.items()]).hint("merge"), key)
    return pairs


def _needed(percent: int) -> Column:
    """The shingles beside a group's measure of which a link that goes by them must share one.

    n2: size of the set; beside: what it has beside the measure.  A link needs percent of n2 in common.
    """
    has = F.size("beside")
    least = F.greatest(F.lit(1), F.ceil(F.lit(percent / 100) * F.col("n2") - 1e-9) - (F.col("n2") - has))
    return F.slice(F.sort_array("beside"), 1, F.greatest(F.lit(0), has - least + 1).cast("int"))


def linked_keys(docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """node, component of keys: connected by pairs with 100 * intersection >= percent * union; no row for keys without one.

    reps: key, doc_id, n, bands, planes, one row per distinct word sequence.
    Every bucket of two or more has as centre its member with the most company.  Each member is
    compared with the centre exactly.  Two members of which one is not linked with the centre can only
    be linked if they share shingles outside the group's measure (any set will do), or if the counts of
    shingles that they lack of it and have beside it allow it; both kinds are found by equality joins
    and compared.
    """
    enough = lambda inter, n1, n2: 100 * inter >= percent * (n1 + n2 - inter)
    alike = lambda n1, n2: 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)
    near = lambda: estimate(F.col("p1"), F.col("p2")) >= percent / 100 - SLACK

    rows = reps.select("key", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.count("*").alias("company")).where("company > 1")
    rows = saved(rows.join(shared, "band"), "buckets")
    company = rows.groupBy("key").agg(F.sum("company").alias("all"))
    centre = rows.join(company, "key").groupBy("band").agg(F.max(F.struct("all", "key"))["key"].alias("centre"))
    star = rows.join(centre, "band").where("key <> centre").select("centre", "key").distinct()
    star = saved(_both(star, reps, "centre", "key", {"n": "n", "planes": "p"}).withColumn("near", near() & alike(F.col("n1"), F.col("n2"))).drop("p1", "p2"), "star")
    groups = saved(star.groupBy("centre").agg(F.count("*").alias("members")), "groups")
    star = saved(star.join(groups, "centre").where("near or members > 1"), "members")

    ends = star.select("key").union(star.select("centre")).distinct()
    sets = saved(shingle_sets(docs, saved(reps.select("key", "doc_id").join(ends, "key"), "ends"), k), "sets")
    # the only comparison with centres: what a member has beside the centre's set tells all that follows
    star = _both(star, sets, "centre", "key", {"grams": "g"}).withColumn("beside", F.array_except("g2", "g1"))
    star = star.withColumn("linked", enough(F.col("n2") - F.size("beside"), F.col("n1"), F.col("n2")))
    star = saved(star.select("centre", "key", "n1", "n2", "linked", "members", F.when(F.col("members") > 1, F.col("beside")).alias("beside")), "compared")
    found = saved(star.where("linked").select(F.col("centre").alias("a"), F.col("key").alias("b")), "found")

    # Groups with members that are not linked to the centre are measured by the centre's set first, then by that
    # and the shingles that COMMON of the group have beside it: what an edit took from the centre alone is no news.
    far = saved(star.where("not linked and members > 1").select("centre").distinct(), "far")
    rest = star.where("members > 1").join(far, "centre", "left_semi")
    news = rest.select("centre", "members", F.explode(_needed(percent)).alias("word"))
    common = news.groupBy("centre", "word").agg(F.count("*").alias("c"), F.first("members").alias("members")).where((F.col("c") >= 20) & (COMMON * F.col("c") >= F.col("members")))
    common = saved(common.groupBy("centre").agg(F.collect_set("word").alias("common")), "common")
    rest = rest.join(common, "centre", "left").withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
    rest = rest.withColumn("beside", F.array_except("beside", "common"))
    rest = rest.withColumns({"n1": F.col("n1") + F.size("common"), "has": F.size("beside").cast("long")}).withColumn("lacks", F.col("n1") - (F.col("n2") - F.col("has")))
    known = components(found)
    rest = rest.withColumn("beside", _needed(percent)).select("centre", "key", "linked", "n1", "lacks", "has", "beside")
    rest = rest.join(known.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    rest = saved(rest, "rest")
    side = lambda df, n: df.select("centre", *[F.col(c).alias(f"{c}{n}") for c in df.columns if c != "centre"])

    kinds = saved(rest.groupBy("centre", "n1", "lacks", "has", "linked").agg(F.count("*").alias("c")).drop("c"), "kinds")
    one, two = side(kinds.where("not linked"), "_1"), side(kinds, "_2")
    allowed = 100 * (F.col("n1_1") - F.greatest("lacks_1", "lacks_2")) >= percent * (F.col("n1_1") - F.least("lacks_1", "lacks_2") + F.col("has_1") + F.col("has_2"))
    kinds = one.join(two, "centre").where(allowed).select("centre", "lacks_1", "has_1", "lacks_2", "has_2", "linked_2")
    narrow = rest.drop("beside", "n1")
    x, y = side(narrow.where("not linked"), "_1"), side(narrow, "_2")
    by_count = kinds.join(x, ["centre", "lacks_1", "has_1"]).join(y, ["centre", "lacks_2", "has_2", "linked_2"]).where("component_1 <> component_2")
    word = lambda df, n: df.select("centre", F.col("key").alias(f"key_{n}"), F.col("component").alias(f"component_{n}"), F.explode("beside").alias("word"))
    by_word = word(rest.where("not linked"), 1).join(word(rest, 2), ["centre", "word"]).where("component_1 <> component_2")
    more = by_count.select("key_1", "key_2").union(by_word.select("key_1", "key_2"))
    more = saved(more.select(F.least("key_1", "key_2").alias("a"), F.greatest("key_1", "key_2").alias("b")).distinct(), "pairs")
    more = saved(_both(more, reps, "a", "b", {"n": "n", "planes": "p"}).where(alike(F.col("n1"), F.col("n2")) & near()).select("a", "b", "n1", "n2"), "likely")
    ends = more.select(F.col("a").alias("key")).union(more.select(F.col("b").alias("key"))).distinct()
    few = saved(sets.join(ends, "key", "left_semi"), "sets")
    more = _both(more, few, "a", "b", {"grams": "g"}).where(enough(F.size(F.array_intersect("g1", "g2")), F.col("n1"), F.col("n2")))
    # what these links tie together are components of the links found before
    of = lambda end: known.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
    ties = more.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left")
    ties = components(ties.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    first = known.union(ties.select("node", F.col("node").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
    tied = ties.select(F.col("node").alias("component"), F.col("component").alias("final"))
    return first.join(tied, "component", "left").select("node", F.coalesce("final", "component").alias("component"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, by: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row, and the columns ``by`` of docs.

    Words are runs outside white space with A-Z lower-cased; the set of a text is its distinct k-word
    shingles, or the whole sequence where it has fewer words.  Texts with
    100 * intersection >= percent * union are linked, confirmed on full sets; component_id is the
    smallest doc_id reachable.  A null or blank text has an empty set and is linked with nothing.  A
    null doc_id is linked with nothing, has a null component and is kept.  Rows that share a doc_id
    keep their own sets and components.  Equal word sequences form one class before anything is
    paired.  Only doc_id, text and by are read; rows in = rows out.

    Words and shingles are compared by 64-bit hashes, whole sequences by 128-bit digests of their words.
    """
    docs, by = docs.withColumn("doc_id", F.col("doc_id").cast("long")), list(by)
    rows = saved(signatures(docs, k, by), "signatures")
    some = rows.where("n_shingles > 0 and doc_id is not null")
    # equal word sequences have equal signatures: which row gives them is all the same
    reps = some.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("planes").alias("planes"))
    reps = saved(reps, "classes")
    known = linked_keys(docs, reps, k, percent).select(F.col("node").alias("key"), "component")
    labelled = saved(reps.select("key", "doc_id").join(known, "key", "left").withColumn("component", F.coalesce("component", "key")), "labelled")
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labelled = saved(labelled.join(least, "component").select("key", "component_id"), "components")
    alone = rows.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *by)
    grouped = some.select("doc_id", "n_shingles", "key", *by).join(labelled.hint("merge"), "key").select("doc_id", "n_shingles", "component_id", *by)
    return grouped.unionByName(alone).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), *by)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, s FROM (
        SELECT doc_id, list_slice(w, p, p + 2) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) >= 3)
        UNION ALL SELECT doc_id, w FROM d WHERE len(w) BETWEEN 1 AND 2)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""
