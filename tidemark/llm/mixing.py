"""Mix sources to target weights by min-cost flow over membership patterns.

A pattern is the set of sources that a document may serve.  Only the token sums of the patterns meet
on the driver; documents are picked on the executors from their place on a seeded line of tokens.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .work import BLANK_RUN, BLANKS, saved

#: Weights by rank of the source, repeating; most passes over one document; seed of the order of documents.
WEIGHTS, MOST_PASSES, SEED = (1, 2, 3), 3, 20_240_601
#: About so many documents lie in one part of the line of tokens, and most parts as a power of 2: one task orders a part of one
#: pattern, or adds up the parts of one pattern, so both must stay small.
PART_ROWS, PART_BITS = 2_000, 20
#: Most patterns that the driver routes (about a minute); more is refused, never cut.
MOST_PATTERNS = 200_000


def word_count(text: Column) -> Column:
    """Maximal runs outside white space; null has none."""
    solid = F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(solid == "", F.lit(0)).otherwise(F.size(F.split(solid, BLANK_RUN))).cast("long")


def by_code_point(sources: list[str | None]) -> list[str | None]:
    return sorted(sources, key=lambda s: (s is None, s or ""))


def capped_targets(sizes: dict[str | None, int], weights=WEIGHTS, most: int = MOST_PASSES) -> dict[str | None, Fraction]:
    """Shares of the sum of all sizes by weight; what is above ``most`` times a source's size is shared again."""
    weight = {s: weights[i % len(weights)] for i, s in enumerate(by_code_point(list(sizes)))}
    target: dict[str | None, Fraction] = {}
    rest, open_ = Fraction(sum(sizes.values())), set(sizes)
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        above = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not above:
            return target | {s: unit * weight[s] for s in open_}
        for s in above:
            target[s] = Fraction(most * sizes[s])
            rest -= target[s]
        open_ -= above
    return target


def _linked(patterns: list[tuple]) -> list[list[int]]:
    """Numbers of patterns by group: patterns of different groups have no source in common."""
    parent: dict[str | None, str | None] = {}

    def root(s):
        while parent.setdefault(s, s) != s:
            parent[s] = s = parent[parent[s]]
        return s

    for pattern in patterns:
        for s in pattern[1:]:
            parent[root(s)] = root(pattern[0])
    groups: dict[str | None, list[int]] = {}
    for i, pattern in enumerate(patterns):
        if pattern:
            groups.setdefault(root(pattern[0]), []).append(i)
    return list(groups.values())


def _path(start: np.ndarray, between: np.ndarray, end: np.ndarray) -> list[int] | None:
    """The shortest chain of sources from one with spare tokens to one with an open quota, each able to pass tokens on."""
    via = np.where(start > 0, -1, -2)  # -2: not reached
    level = np.flatnonzero(start > 0)
    while len(level):
        ends = level[end[level] > 0]
        if len(ends):
            chain = [int(ends[0])]
            while via[chain[-1]] >= 0:
                chain.append(int(via[chain[-1]]))
            return chain[::-1]
        following = []
        for s in level:
            fresh = np.flatnonzero((between[s] > 0) & (via == -2))
            via[fresh] = s
            following.append(fresh)
        level = np.concatenate(following)
    return None


def _flow(tokens: np.ndarray, member: np.ndarray, quota: np.ndarray, most: int) -> np.ndarray:
    """Tokens of each pattern (row) for each source (column) of one group.

    All patterns that can pass tokens along the same arc between two sources are moved together, so the
    number of augmenting paths follows the sources, not the patterns.
    """
    flow = np.zeros(member.shape, np.int64)
    open_ = quota.astype(np.int64)
    between = np.zeros((len(quota), len(quota)), np.int64)  # tokens of one source that another may hold instead
    spare = np.zeros(len(tokens), np.int64)

    def refresh(sources):
        for s in sources:
            between[s] = flow[:, s] @ member
            between[s, s] = 0

    def draw(room: np.ndarray, amount: int) -> np.ndarray:
        """amount, taken from the first patterns that have room."""
        upto = np.minimum(np.cumsum(room), amount)
        return np.diff(upto, prepend=0)

    for _ in range(most):  # pass r costs r - 1 a token, and only here: cheaper passes are used up first
        spare += tokens
        start = spare @ member
        while (chain := _path(start, between, open_)) is not None:
            arcs = list(zip(chain, chain[1:]))
            amount = int(min([start[chain[0]], open_[chain[-1]], *(between[a, b] for a, b in arcs)]))
            moved = draw(spare * member[:, chain[0]], amount)
            spare -= moved
            flow[:, chain[0]] += moved
            for a, b in arcs:
                # the tokens that have just come to a are as good as those that it had
                moved = draw(flow[:, a] * member[:, b], amount)
                flow[:, a] -= moved
                flow[:, b] += moved
            open_[chain[-1]] -= amount
            start = spare @ member
            refresh(chain)
    return flow


def route(supply: dict[tuple, int], quota: dict[str | None, int], most: int = MOST_PASSES) -> dict[tuple, dict[str | None, int]]:
    """Tokens that each pattern gives each source: a maximum flow of least cost.

    Pass r over a pattern's tokens costs r - 1 a token, so repetition is spread before it is piled up.
    Costs are on the arcs into patterns alone, so a path costs what its first arc does, and successive
    shortest paths are one maximum flow for each pass, on top of the one before.
    """
    patterns = list(supply)
    out: dict[tuple, dict[str | None, int]] = {p: {} for p in patterns}
    for group in _linked(patterns):
        sources = by_code_point(list({s for i in group for s in patterns[i]}))
        column = {s: j for j, s in enumerate(sources)}
        member = np.zeros((len(group), len(sources)), np.int64)
        for i, p in enumerate(group):
            member[i, [column[s] for s in patterns[p]]] = 1
        flow = _flow(np.array([supply[patterns[p]] for p in group], np.int64), member, np.array([quota[s] for s in sources], np.int64), most)
        for i, p in enumerate(group):
            out[patterns[p]] = {s: int(flow[i, column[s]]) for s in patterns[p]}
    return out


def mix(docs: DataFrame, members: Column, weights=WEIGHTS, most: int = MOST_PASSES, seed: int = SEED) -> DataFrame:
    """One row per document and source it serves: doc_id, members, source, size, source_size, target, taken.

    members: array<string> of the sources that a document may serve (one null stands for the null
    source).  taken is in words, repeats counted, and never above ``most`` times the size; the last
    document of a source's share may give a part of its words, so a source misses its target by less
    than a word when its patterns hold enough.  Documents without words take 0.  Order on the seeded
    line is by hash of seed and doc_id, then doc_id and size, so reruns agree; repeated rows are
    separate documents.  source_size is the words of all documents that may serve the source.  An
    empty table gives an empty result.  Only doc_id and text are read beside members.
    """
    sized = docs.select("doc_id", members.alias("members"), word_count(F.col("text")).alias("size"))
    sized = saved(sized.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id")), "mixing")
    # parts are ranges of the hash, so their number changes no order
    bits = min(PART_BITS, (sized.count() // PART_ROWS).bit_length())
    sized = sized.withColumn("_part", F.shiftright("_h", 64 - bits) if bits else F.lit(0).cast("long"))
    parts = sized.groupBy("members", "_part").agg(F.sum("size").alias("tokens"))
    parts = saved(parts, "mixing-parts")
    rows = parts.groupBy("members").agg(F.sum("tokens").alias("tokens")).limit(MOST_PATTERNS + 1).collect()
    if len(rows) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    supply = {tuple(r.members): int(r.tokens) for r in rows}
    sizes: dict[str | None, int] = {}
    for pattern, tokens in supply.items():
        for s in pattern:
            sizes[s] = sizes.get(s, 0) + tokens
    targets = capped_targets(sizes, weights, most)
    if len(supply) == len(sizes):  # without overlap the targets share out the tokens once
        quota = {s: round(t) for s, t in targets.items()}
    else:
        once = Fraction(sum(supply.values()), max(1, sum(sizes.values())))
        targets = {s: t * once for s, t in targets.items()}
        quota = {s: round(t) for s, t in targets.items()}
    plan = []
    for pattern, flows in route(supply, quota, most).items():
        at = 0
        for s in by_code_point(list(flows)):
            plan.append((list(pattern), supply[pattern], s, sizes[s], float(targets[s]), at, at + flows[s]))
            at += flows[s]
    spark = docs.sparkSession
    plan = spark.createDataFrame(plan, "members array<string>, _line long, source string, source_size long, target double, _lo long, _hi long")
    before = Window.partitionBy("members").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("members", "_part").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("members", "_part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("_start"))
    placed = sized.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, ["members", "_part"])
    placed = placed.withColumn("_at", F.col("_start") + F.col("_in")).join(F.broadcast(plan), "members")
    taken = sum(
        (F.greatest(F.lit(0), F.least(F.col("_at") + F.col("size") + r * F.col("_line"), "_hi") - F.greatest(F.col("_at") + r * F.col("_line"), "_lo")) for r in range(most)),
        F.lit(0),
    )
    return placed.select("doc_id", "members", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
