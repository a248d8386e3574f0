"""Every operator of the subpackage on small tables with nulls, blanks, ties, repeats and clashing names."""

import hashlib
import io
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare
from tidemark.llm import collocations, components, decontaminate, lm_score, mixing, near_dup, quality_model, quality_rules, queries, sharding, substring_dedup, text, token_counts, toxicity, warc, whitening, work
from tidemark.llm.work import fresh_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}" for a in "ba ce di fo gu ha".split() for b in "na re ti lo mu sha".split()]


HELPERS = ("score", "size", "key", "tag", "spans", "grams", "held_out", "row", "batch", "label", "coords", "component", "_h", "_upper", "_all", "_statistics", "_tag", "_spans", "_text_key", "_of", "_gone_id", "_places", "_p", "_g5", "_part", "_at", "rank", "phrase", "tongue", "shard", "slot", "law", "arc", "bin", "x", "n", "component")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + ("." if r.random() < 0.1 else "") for _ in range(n)) + "."


def table(spark, texts, extra=True):
    rows = [(i, t, "en", None if i is None or i % 5 == 0 else f"s{i % 3}", len(t or "")) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    # columns whose names the operators use themselves
    return df.withColumns({c: F.lit("x") for c in HELPERS}) if extra else df


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, blanks, repeats, copies, near copies, one long text, one long word."""
    base = prose(1, 120)
    near = base.split()
    near[100] = "other"
    texts = [(0, base), (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, " \n\t\x0b"), (6, "one"), (7, "ONE"), (8, prose(2, 6000)), (9, "w" * 50_000), (10, prose(3, 80) + "\n" + base), (None, base), (6, "one"), (11, "Der " * 300), (12, "É à b — " * 20)]
    return table(spark, texts)


EMPTY = "doc_id long, text string, source string"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    compare(queries.QUERIES[name](spark, sf_dir), queries.ORACLE_SQL[name], sf_dir)


# -- 1, 9: classifiers --------------------------------------------------------------------------------


@pytest.mark.parametrize("name,label,modulus,rest", [("op1_quality", "quality", 5, 0), ("op9_toxicity", "toxic", 4, 2)])
def test_classifiers_on_held_out_rows(spark, name, label, modulus, rest):
    d = "/root/testdata/sf0.01"
    rows = queries.QUERIES[name](spark, d).collect()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    ones, zeros = [s for s, y in held if y], [s for s, y in held if not y]
    auc = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    assert auc > (0.95 if label == "quality" else 0.7)  # 300 labels can't show the words of four languages


@pytest.mark.parametrize("module,label", [(quality_model, "quality"), (toxicity, "toxic")])
def test_classifiers_on_odd_tables(spark, odd, module, label):
    held = queries.remainder(5) == 0
    labels = spark.createDataFrame([(0, 1), (0, 1), (2, 0), (3, None), (99, 1), (8, 1), (11, 0), (None, 1)], f"doc_id long, {label} int")
    assert module.classify(odd, labels, label, held).count() == odd.count()
    none = module.classify(odd, labels.limit(0), label, held).collect()
    assert all(abs(r.score - 0.5) < 1e-9 for r in none)
    one = module.classify(odd, labels.where(F.col(label) == 1), label, held).collect()
    assert all(0 <= r.score <= 1 for r in one)
    assert module.classify(spark.createDataFrame([], EMPTY), labels, label, held).count() == 0


def test_accepted_keeps_rows_whole(spark, odd):
    labels = spark.createDataFrame([(i, int(i != 11)) for i in range(12)], "doc_id long, quality int")
    kept = quality_model.accepted(odd, labels, "quality", F.lit(False))
    assert kept.columns == odd.columns and set(map(tuple, kept.collect())) <= set(map(tuple, odd.collect()))
    scored = quality_model.classify(odd, labels, "quality", F.lit(False))
    assert kept.count() == scored.where("predicted = 1").count()


def brute_statistics(text):
    t = text or ""
    words = [w.decode() for w in t.encode().split()]
    chars = "".join(words)
    solid = max(1, len(chars))
    share = lambda members: sum(c in members for c in chars) / solid
    lines = [x.split() for x in t.split("\n") if x.split()]
    count = Counter(words)
    out = {k: share(v.decode()) for k, v in quality_model.CLASSES.items()}
    out["upper"] = sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" or "\xc0" <= c <= "\xde" for c in chars) / solid
    out |= {"log_words": math.log1p(len(words)), "word_length": len(chars) / len(words) if words else 0.0, "line_words": len(words) / (1 + t.count("\n"))}
    out["distinct"] = len(count) / len(words) if words else 1.0
    out["top_word"] = max(count.values()) / len(words) if words else 0.0
    out["same_lines"] = 1 - len(set(map(tuple, lines))) / len(lines) if lines else 0.0
    return out


def test_statistics_equal_brute_force(spark, odd):
    more = spark.createDataFrame([(30, "A #tag | x\n\n A  #tag | x\nB! 12\n"), (31, "x\ny\nx"), (32, "\n\n")], "doc_id long, text string")
    rows = odd.select("doc_id", "text").union(more)
    texts = defaultdict(list)
    for r in rows.collect():
        texts[r.doc_id].append(r.text)
    for r in quality_model.statistics(rows).collect():
        want = brute_statistics(texts[r.doc_id][0])
        assert {k: round(r["_" + k], 9) for k in want} == {k: round(v, 9) for k, v in want.items()}


def test_scores_are_the_sum_of_the_rules_that_hold(spark, odd):
    labels = spark.createDataFrame([(i, i % 2) for i in range(13)], "doc_id long, quality int")
    ensemble = quality_model.learn(odd, labels, "quality", F.lit(False))
    for r in quality_model.statistics(odd).withColumn("s", ensemble.score()).collect():
        total = ensemble.intercept + sum(w for rule, w in ensemble.rules if all(r[k] <= t if low else r[k] > t for k, low, t in rule))
        assert abs(r.s - 1 / (1 + math.exp(-total))) < 1e-12


def test_rule_paths_hold_where_trees_lead(spark):
    rows = spark.createDataFrame([(i, prose(i, 30) if i % 2 else "### " * 30) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    ensemble = quality_model.learn(rows, labels, "quality", F.lit(False))
    assert ensemble.rules and all(w for _, w in ensemble.rules)
    assert {r.doc_id % 2 == 1 for r in quality_model.statistics(rows).where(ensemble.score() >= 0.3).collect()} == {True}


def test_ftrl_equals_a_loop_over_coordinates():
    r = random.Random(8)
    rows = [(np.array(sorted(r.sample(range(30), r.randint(0, 6))), np.int64), r.randint(0, 1)) for _ in range(120)]
    w, bias = toxicity.ftrl(rows, 30, 3)
    z, n = [0.0] * 31, [0.0] * 31

    def weight(i):
        if abs(z[i]) <= toxicity.L1:
            return 0.0
        return -(z[i] - math.copysign(toxicity.L1, z[i])) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(3):
        for coords, y in rows:
            at = [*coords.tolist(), 30]
            own = [weight(i) for i in at]
            g = 1 / (1 + math.exp(-sum(own))) - y
            for i, wi in zip(at, own):
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / toxicity.ALPHA * wi
                n[i] += g * g
    assert np.allclose(w, [weight(i) for i in range(30)], atol=1e-12) and abs(bias - weight(30)) < 1e-12
    assert w.any()


# -- 2: archives ----------------------------------------------------------------------------------------


def test_archives(spark):
    big = "<p>" + "é" * 1200 + "</p>\r\n\r\nWARC/1.0\r\n"
    rows = [(1, "http://a/", big), (7, "http://b/ c\nd", big), (7, "http://b2/", big), (3, None, big), (4, "", "x"), (5, "u", "x"), (6, "u", None), (None, "n", big), (8, "e", "\n\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("x"))
    got = sorted(map(tuple, warc.archive_pages(pages).collect()), key=str)
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = []
    for i, _, t in rows:
        again = t == big and i != 7
        want.append((i, len((t or "").encode()), digest(t), "revisit" if again else "response", 7 if again else None))
    assert got == sorted(want, key=str)
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_every_record_has_its_own_identifier(spark):
    pages = spark.createDataFrame([(1, "http://a/", "x" * 2000)] * 3 + [(2, "http://a/", "x")] * 4, "page_id long, url string, html string")
    arc, out = fresh_path(spark, "arc"), fresh_path(spark, "warc")
    warc.write_arc(pages, arc)
    warc.convert(spark, arc, out)
    rows = warc.read_warc(spark, out).collect()
    assert len({r.record_id for r in rows}) == 7 and all(r.record_type == "response" for r in rows)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    data = warc.arc_opening(version, "x.arc") + b"\n" + warc.arc_record(version, "x.arc", 5, "http://a b/", "hi") + b"\n" + warc.arc_record(version, "x.arc", None, None, None) + b"\n"
    (a, block), (b, empty) = warc.arc_records(io.BytesIO(data))
    assert a["URL"] == "http://a%20b/" and int(a["Archive-length"]) == len(block) and block.endswith(b"\r\n\r\nhi")
    assert b["URL"] == "urn:unknown" and empty.endswith(b"\r\n\r\n")
    with pytest.raises(ValueError):
        list(warc.arc_records(io.BytesIO(data[:-30])))
    with pytest.raises(ValueError):
        list(warc.arc_records(io.BytesIO(data.replace(b"\n%d 0 conv" % version, b"\n9 0 conv"))))
    assert warc.warc_date("19990203") == "1999-02-03T00:00:00Z"


# -- 3: line rules ----------------------------------------------------------------------------------------


def test_line_rules(spark, odd):
    got = quality_rules.line_first_clean(odd)
    assert got.count() == odd.count()
    by = {r.doc_id: r for r in got.collect()}
    for i, t in ((3, ""), (4, ""), (5, "")):
        assert (by[i].n_words, by[i].n_repeat_words, by[i].kept) == (0, 0, False)
    assert by[11].n_repeat_words == 300 and by[11].base_failed
    assert by[0].kept and by[8].kept and by[9].n_words == 1
    lines = "Home | About | Help | More\n" + prose(4, 30) + "\nBUY!! NOW!! HERE!!\nLicensed under the Apache License."
    text = spark.createDataFrame([(1, lines), (2, None)], "doc_id long, text string")
    assert [r.text for r in quality_rules.cleaned_text(text).orderBy("doc_id").collect()] == [prose(4, 30), None]
    assert quality_rules.line_first_clean(spark.createDataFrame([], EMPTY)).count() == 0


# -- 4: mixing ---------------------------------------------------------------------------------------------


def test_mixing(spark, odd):
    one = sorted(map(tuple, mixing.mix(odd, F.array("source")).select("doc_id", "source", "size", "target", "taken").collect()), key=str)
    two = sorted(map(tuple, mixing.mix(odd.repartition(7), F.array("source")).select("doc_id", "source", "size", "target", "taken").collect()), key=str)
    assert one == two and len(one) == odd.count()
    taken, target = Counter(), {}
    for _, s, size, t, n in one:
        assert 0 <= n <= 3 * size
        taken[s] += n
        target[s] = t
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert mixing.mix(spark.createDataFrame([], EMPTY), F.array("source")).count() == 0


def test_targets_and_flow():
    t = mixing.capped_targets({"a": 10, "b": 1000, None: 5})
    assert t["a"] == 30 and t[None] == 15 and t["b"] == 970
    flow = mixing.route({("a",): 10, ("a", "b"): 20, ("b",): 5}, {"a": 35, "b": 15})
    assert sum(f.get("a", 0) for f in flow.values()) == 35 and sum(f.get("b", 0) for f in flow.values()) == 15
    assert sum(flow[("a", "b")].values()) <= 60 and flow[("a",)]["a"] <= 30


def least_cost(supply, quota, most):
    """The greatest flow and its least cost, by trying all totals of the patterns; Hall's condition says what can be delivered."""
    patterns, sources = list(supply), list(quota)
    subsets = [set(t) for k in range(len(sources) + 1) for t in itertools.combinations(sources, k)]
    flow = lambda x: min(sum(quota[s] for s in sources if s not in t) + sum(v for p, v in zip(patterns, x) if set(p) & t) for t in subsets)
    full = flow([most * supply[p] for p in patterns])
    costs = [sum(sum(max(0, v - k * supply[p]) for k in range(1, most)) for p, v in zip(patterns, x)) for x in itertools.product(*[range(most * supply[p] + 1) for p in patterns]) if sum(x) == full == flow(x)]
    return full, min(costs)


def test_flow_has_least_cost():
    r = random.Random(1)
    for _ in range(80):
        sources = "abc"[: r.randint(1, 3)]
        subsets = [tuple(c) for k in range(1, len(sources) + 1) for c in itertools.combinations(sources, k)]
        supply = {p: r.randint(0, 3) for p in r.sample(subsets, min(len(subsets), r.randint(1, 4)))}
        quota = {s: r.randint(0, 9) for s in {s for p in supply for s in p}}
        flow = mixing.route(supply, quota, 3)
        given = {p: sum(f.values()) for p, f in flow.items()}
        assert all(given[p] <= 3 * n and set(flow[p]) <= set(p) and min(flow[p].values()) >= 0 for p, n in supply.items())
        assert all(sum(f.get(s, 0) for f in flow.values()) <= q for s, q in quota.items())
        cost = sum(sum(max(0, v - k * supply[p]) for k in (1, 2)) for p, v in given.items())
        assert (sum(given.values()), cost) == least_cost(supply, quota, 3)


def test_flow_over_many_patterns():
    r = random.Random(2)
    names, supply = [f"s{i}" for i in range(60)], {}
    while len(supply) < 20_000:
        supply[tuple(sorted(r.sample(names, r.randint(1, 6))))] = r.randint(1, 10**6)
    weights = [r.choice((1, 2, 3)) for _ in names]
    quota = {s: sum(supply.values()) * w // sum(weights) for s, w in zip(names, weights)}
    began = time.perf_counter()
    flow = mixing.route(supply, quota)
    assert time.perf_counter() - began < 60 and sum(sum(f.values()) for f in flow.values()) == sum(quota.values())


def test_parts_do_not_change_the_mix(spark, odd, monkeypatch):
    take = lambda: sorted(map(tuple, mixing.mix(odd, F.array("source")).select("doc_id", "size", "taken").collect()), key=str)
    one = take()
    monkeypatch.setattr(mixing, "PART_ROWS", 1)
    assert take() == one


def test_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, prose(i, 10)) for i in range(40)], "doc_id long, text string")
    both = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    rows = mixing.mix(docs, both).collect()
    by = defaultdict(int)
    for r in rows:
        by[r.source] += r.taken
    assert all(abs(by[r.source] - r.target) <= 1 for r in rows)


# -- 5: token counts ---------------------------------------------------------------------------------------


def test_token_counts_equal_the_library(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    ranks = token_counts.Tokenizer(queries.vocabulary("byte_bpe_50k.json"))
    more = odd.select("doc_id", "text").union(spark.createDataFrame([(20, "a<|endoftext|>b <|endoftext|"), (21, "x" * 3000 + "\r\n \n  y"), (22, "᠎\u0085  naïve 😀 ١٢ Ⅷ")], "doc_id long, text string"))
    cache = fresh_path(spark, "cache")
    want = sorted([(r.doc_id, len((r.text or "").encode()), len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)) for r in more.collect()], key=str)
    for _ in range(2):
        got = token_counts.token_counts(more, ranks, cache).collect()
        assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=str) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
        stored = spark.read.parquet(cache)
        assert stored.count() == more.select(F.coalesce("text", F.lit(""))).distinct().count()  # one a distinct text, none twice
    assert token_counts.token_counts(spark.createDataFrame([], EMPTY), ranks).count() == 0


def test_token_counts_of_long_blank_runs(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.vocabulary("byte_bpe_50k.json"))
    ranks = token_counts.Tokenizer(queries.vocabulary("byte_bpe_50k.json"))
    texts = [" " * 1_200_000 + "x", "A naïve 😀 text's<|endoftext|>  12 " + "\n" * 1_200_000 + "a b", "short"]
    got = token_counts.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), ranks).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_random_strings_count_as_in_the_library():
    from tokenizers import Tokenizer

    pieces = ["a", "th", "ing", "Q", " ", "  ", "\n", "\t", "\r\n", "1", "23", "'s", "'ll", "é", "ß", "中", "文", "😀", ".", "!!", "--", "<|endoftext|>", "<|endo", "ſ", "١"]
    for name, n in (("byte_bpe_50k.json", 10_000), ("word_bpe_49k.json", 500)):
        with open(queries.vocabulary(name), "rb") as f:
            raw = f.read()
        assert (token_counts.byte_ranks(__import__("json").loads(raw)) is not None) == name.startswith("byte")
        count, library, r = token_counts.counter(raw), Tokenizer.from_str(raw.decode()), random.Random(4)
        for _ in range(n):
            code = lambda: chr(r.choice((r.randrange(1, 0x250), r.randrange(0x250, 0xD7FF), r.randrange(0xE000, 0x1FFFF))))
            text = "".join(r.choice(pieces) if r.random() < 0.8 else code() for _ in range(r.randint(0, 40)))
            assert count(text) == len(library.encode(text, add_special_tokens=False).ids), repr(text)


# -- 6: language model --------------------------------------------------------------------------------------


def brute_lm(rows, held):
    """doc_id, n_tokens, n_known, train_tokens, base_score, score by plain counting."""
    c, texts = Counter(), []
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        texts.append(w)
        if i is not None and not held(i):
            c.update(tuple(w[p : p + n]) for n in (1, 2, 3) for p in range(len(w) - n + 1))
    words = [v for k, v in c.items() if len(k) == 1]
    made = lm_score.Automaton(sum(words), len(words), words.count(1), words.count(2))
    out = []
    for (i, _), w in zip(rows, texts):
        score = base = 0
        for p, x in enumerate(w):
            q = float(made.single(np.array([c[(x,)]]))[0])
            for n in (2, 3):
                if p >= n - 1:
                    history = tuple(w[p - n + 1 : p])
                    q = (c[(*history, x)] + lm_score.STRENGTH[n] * q) / (c[history] + lm_score.STRENGTH[n])
            score, base = score + math.log10(q), base + math.log10((c[(x,)] + 1) / (made.total + made.types + 1))
        out.append((i, len(w), sum(c[(x,)] > 0 for x in w), made.total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block,part,step", [(1 << 22, 1 << 21, 1 << 18), (50, 100, 16), (7, 10, 3)])
def test_lm_scores_equal_brute_force(spark, odd, monkeypatch, block, part, step):
    """Also where texts are cut into stretches and n-grams dealt over many parts."""
    monkeypatch.setattr(lm_score, "STEP", step)
    monkeypatch.setattr(lm_score, "BLOCK", block)
    monkeypatch.setattr(lm_score, "PART", part)
    r = random.Random(3)
    rows = [(100 + i, " ".join(r.choice(WORDS) for _ in range(r.choice([0, 1, 2, 5, 40, 200])))) for i in range(60)]
    rows += [(i, t) for i, t in odd.select("doc_id", "text").collect() if t is None or len(t) < 5000]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(x.doc_id, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 6), round(x.score, 6)) for x in lm_score.score(df, queries.remainder(7) == 2).collect()]
    assert sorted(got, key=str) == brute_lm(rows, lambda i: zlib.crc32(str(i).encode()) % 7 == 2)


def test_lm_weights_sum_to_one():
    r = random.Random(6)
    text = [r.randrange(12) for _ in range(400)]
    c = Counter(tuple(text[p : p + n]) for n in (1, 2, 3) for p in range(len(text) - n + 1))
    words = [v for k, v in c.items() if len(k) == 1]
    made = lm_score.Automaton(len(text), len(words), words.count(1), words.count(2))
    for history in ((text[0], text[1]), (text[5], 99), (98, text[7])):
        mass = 0.0
        for w in [*range(12), 77]:  # 77 is the unseen word
            if w in text or w == 77:
                tokens = (*history, w)
                at = lambda n: np.array([c[tokens[p - n + 1 : p + 1]] if p >= n - 1 else 0 for p in range(3)], float)
                # the count of a history is that of its continuations
                words_, pairs = at(1), at(2)
                words_[1] = sum(v for k, v in c.items() if len(k) == 2 and k[0] == tokens[1])
                pairs[1] = sum(v for k, v in c.items() if len(k) == 3 and k[:2] == tokens[:2])
                mass += 10 ** made.traverse(np.array([True, False, False]), words_, pairs, at(3))[2]
        assert abs(mass - 1) < 1e-9


def test_packed_numbers():
    r = np.random.default_rng(1)
    for values in (np.zeros(0, np.uint64), np.zeros(5, np.uint64), r.integers(0, 300, 1000).astype(np.uint64), r.integers(0, 1 << 63, 50).astype(np.uint64) * np.uint64(2)):
        assert (lm_score.unpack(lm_score.pack(values)) == values).all()
        values = np.unique(values)
        assert not len(values) or (lm_score.unpack_sorted(lm_score.pack_sorted(values)) == values).all()


def test_lm_scores(spark, odd):
    rows = lm_score.score(odd, queries.remainder(7) == 2).collect()
    assert len(rows) == odd.count()
    train = [r.text or "" for r in odd.collect() if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t.encode().lower().split())
    c[None] = len(train)
    n, v = sum(c.values()), len(c)
    texts = defaultdict(list)
    for r in odd.collect():
        texts[r.doc_id].append(r.text or "")
    for r in rows:
        words = texts[r.doc_id][0].encode().lower().split() + [None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(c[w] > 0 for w in words), n)
        assert abs(r.base_score - sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words)) < 1e-6 * abs(r.base_score)
        assert r.score < 0
    nothing = lm_score.score(odd, F.lit(True)).collect()
    assert all(r.base_score == 0 and r.score == 0 and r.n_known == 0 for r in nothing)
    assert lm_score.score(spark.createDataFrame([], EMPTY), queries.remainder(7) == 2).count() == 0


# -- 7: substrings --------------------------------------------------------------------------------------------


def brute_substrings(rows, length):
    first = {}
    for i, t in rows:
        if i is not None:
            w = (t or "").encode().split()
            for p in range(len(w) - length + 1):
                k = tuple(w[p : p + length])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = {q for p in range(len(w) - length + 1) if i is not None and first[tuple(w[p : p + length])] < i for q in range(p, p + length)}
        kept = b" ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [12, 50])
def test_substrings(spark, odd, length):
    got = sorted(map(tuple, substring_dedup.dedup_substrings(odd, length).collect()), key=str)
    assert got == brute_substrings([(r.doc_id, r.text) for r in odd.collect()], length)


def test_substrings_where_passages_branch(spark):
    r = random.Random(5)
    passages = [prose(100 + i, r.randint(15, 70)).split() for i in range(12)]
    rows = []
    for i in range(150):
        w = []
        for _ in range(r.randint(1, 5)):
            p = list(r.choice(passages))
            a, b = sorted((r.randint(0, len(p)), r.randint(0, len(p))))
            p = p[a:b] if r.random() < 0.5 else p
            if p and r.random() < 0.4:
                p[r.randrange(len(p))] = "edit"
            w += p + [prose(1000 + i, 3)] * r.randint(0, 1)
        rows.append((r.randint(0, 99) if i % 20 == 0 else 100 + i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for length in (10, 25):
        assert sorted(map(tuple, substring_dedup.dedup_substrings(df, length).collect()), key=str) == brute_substrings(rows, length)


def test_substrings_pass_columns_through(spark, odd):
    out = substring_dedup.dedup_substrings(odd, text_out=True)
    assert sorted(out.columns) == sorted(odd.columns) and out.count() == odd.count()
    by = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    assert by[1] == "" and by[3] is None and by[8] == prose(2, 6000)
    assert substring_dedup.dedup_substrings(spark.createDataFrame([], EMPTY)).count() == 0


def test_results_do_not_depend_on_the_filter(spark, odd, monkeypatch):
    """A filter so small that it lets every row pass gives the same rows."""
    monkeypatch.setattr(work, "FILTER_BITS", 6)
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted(map(tuple, substring_dedup.dedup_substrings(odd).collect()), key=str) == brute_substrings(rows, 50)
    assert sorted(map(tuple, near_dup.near_duplicates(odd, 3, 85).collect()), key=str) == brute_near(rows, 3, 85)


@pytest.mark.parametrize("bits,native", [(6, False), (27, False), (0, True)])
def test_without_drops_rows_by_id_and_text(spark, monkeypatch, bits, native):
    monkeypatch.setattr(work, "FILTER_BITS", bits)
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (None, "c"), (2, None), (3, None), (4, "a"), (4, "a")], "doc_id long, text string").withColumn("_text_key", F.lit(1)).withColumn("_gone_id", F.lit(2))
    keyed, key = work.text_key(docs)
    gone = keyed.where("(doc_id = 1 and text = 'a') or (doc_id is null and text = 'c') or doc_id = 3 or doc_id = 4")
    left = work.without(keyed, gone, key, native)
    assert left.columns == docs.columns and sorted([(r.doc_id, r.text) for r in left.collect()], key=str) == sorted([(1, "b"), (None, "a"), (2, None)], key=str)
    assert work.without(keyed, gone.limit(0), key, native).count() == 8


# -- 8: decontamination ------------------------------------------------------------------------------------------


def brute_leaks(docs, items, k=5):
    grams = lambda w: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    words = {i: t.lower().split() for i, t in items if t and t.split()}
    df = Counter(g for w in words.values() for g in set(grams(w)))
    out = {}
    for d, t in docs:
        w = (t or "").lower().split()
        own = set(grams(w))
        for i, b in words.items():
            if len(b) < k:
                if any(w[p : p + len(b)] == b for p in range(len(w))):
                    out[d, i] = 1.0
                continue
            c, best = Counter(grams(b)), 0
            if not own & c.keys():
                continue
            for p in range(max(1, len(w) - len(b) + 1)):
                n = Counter(grams(w[p : p + len(b)]))
                weigh = lambda g: 1 / df[g] if g in c else 1
                both = sum(weigh(g) * min(c[g], n[g]) for g in set(c) | set(n))
                any_ = sum(weigh(g) * max(c[g], n[g]) for g in set(c) | set(n))
                best = max(best, both / any_)
            if best >= 0.8 - 1e-9:
                out[d, i] = round(best, 9)
    return out


def test_leaks(spark, monkeypatch):
    items = [(i, prose(500 + i, 12 + 4 * i)) for i in range(8)] + [(20, None), (21, " "), (22, "Very Short"), (23, prose(500, 12) + " tail"), (0, prose(500, 12))]
    docs = [(i, prose(i, 40) + " " + " ".join(prose(500 + i % 8, 12 + 4 * (i % 8)).split()[i // 8 :]) + " " + prose(i, 20)) for i in range(40)]
    docs += [(100, None), (101, ""), (102, "a very short text"), (103, prose(507, 40)), (103, prose(507, 40)), (104, " ".join(prose(507, 40).split()[:36])), (105, prose(9, 3000))]
    d = table(spark, docs)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("grams", F.lit("x"))
    want = brute_leaks(docs, dict(items).items())
    for most in (1_000_000, 90):
        monkeypatch.setattr(decontaminate, "ROWS", most)
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.leaks(d, b).collect()} == want
    assert decontaminate.leaks(d.limit(0), b).count() == 0 and decontaminate.leaks(d, b.limit(0)).count() == 0


def test_leaks_do_not_depend_on_blocks(spark, monkeypatch):
    # eight items share a passage: its shingles weigh 1/8 in every block, whichever items are handled with it
    shared = prose(900, 24)
    items = [(i, shared + " " + prose(700 + i, 22)) for i in range(8)] + [(i, shared.upper() + "  " + prose(700 + i, 22)) for i in range(2)]
    docs = [(i, prose(i, 30) + " " + prose(800 + i, 12) + " " + " ".join(t.split()[j:])) for i, (j, (_, t)) in enumerate((j, x) for j in (0, 2, 4) for x in items)]
    want = brute_leaks(docs, items[:8])
    assert any(v < 1 for v in want.values())
    for most in (1_000_000, 150):
        monkeypatch.setattr(decontaminate, "ROWS", most)
        rows = decontaminate.leaks(table(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
        assert {(r.doc_id, r.item_id): round(r.similarity, 9) for r in rows} == want


def test_leaks_of_a_large_benchmark_take_one_scan(spark, tmp_path):
    items = [(i, prose(i, 40)) for i in range(30_000)]
    docs = [(i, prose(50_000 + i, 30) + " " + items[i * 97][1] + " " + prose(60_000 + i, 9)) for i in range(20)] + [(90, prose(70_000, 200))]
    table(spark, docs).write.parquet(str(tmp_path / "d"))
    found = decontaminate.leaks(spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.start, r.similarity) for r in found.collect()} == {(i, i * 97, 30, 1.0) for i in range(20)}
    assert found._jdf.queryExecution().sparkPlan().toString().count(str(tmp_path / "d")) == 1


# -- 10: near-duplicates ---------------------------------------------------------------------------------------------


def brute_near(rows, k, percent):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[p : p + k]) for p in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and rows[a][0] is not None and rows[b][0] is not None and 100 * n >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[find(x)] = min(least.get(find(x), i), i) if i is not None else None
    return sorted([(i, len(s), least[find(x)], i is None or least[find(x)] == i) for x, ((i, _), s) in enumerate(zip(rows, sets))], key=str)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, odd, k, percent):
    got = sorted(map(tuple, near_dup.near_duplicates(odd, k, percent).collect()), key=str)
    assert got == brute_near([(r.doc_id, r.text) for r in odd.collect()], k, percent)


def test_near_duplicates_in_a_cloud(spark):
    """Edits of one text that isn't there itself, from close to far, with shared edits and chains."""
    r = random.Random(3)
    base = prose(77, 150).split()
    rows = [(i, prose(2000 + i, 30)) for i in range(40)]
    for i in range(100, 320):
        w = list(base)
        for _ in range(r.choice([1, 2, 3, 5, 7, 9])):
            p = r.randrange(len(w))
            w[p] = r.choice(["edit", f"e{r.randrange(30)}", "the"])
        if r.random() < 0.2:
            del w[r.randrange(len(w))]
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, percent in ((3, 85), (3, 93)):
        got = sorted(map(tuple, near_dup.near_duplicates(df, k, percent).collect()), key=str)
        assert got == brute_near(rows, k, percent)


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (5, 5), (200, 200), (102, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}


# -- very long texts -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op11", "op13"])
def test_text_of_20_megabytes(spark, name):
    r = random.Random(9)
    passage = prose(5, 60)
    words = [*WORDS, "MiXed", "ünder", "x" * 3000]
    long = " ".join(r.choice(words) for _ in range(60_000)) + "\n"
    long = (long * (1 + (20 << 20) // len(long.encode())))[: 20 << 20] + " " + passage
    docs = spark.createDataFrame([(1, passage), (2, long), (3, None), (4, prose(6, 40))], "doc_id long, text string")
    n = len(long.split())
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, 1)], "doc_id long, y int")
    if name == "op1":
        got = {x.doc_id: x for x in quality_model.statistics(docs).collect()}
        assert abs(math.expm1(got[2]._log_words) - n) < 0.5 and abs(got[2]._distinct - len(set(long.split())) / n) < 1e-12
        assert quality_model.classify(docs, labels, "y", F.lit(False)).count() == 4
    elif name == "op6":
        got = {x.doc_id: x for x in lm_score.score(docs, F.col("doc_id") == 4).collect()}
        assert got[2].n_tokens == got[2].n_known == n + 1 and got[2].train_tokens == n + 1 + 61 + 1 and got[2].score < 0
    elif name == "op7":
        got = {x.doc_id: x for x in substring_dedup.dedup_substrings(docs).collect()}
        assert (got[2].n_words, got[2].n_removed) == (n, 60) and got[2].kept_sha256 == hashlib.sha256(" ".join(long.split()[:-60]).encode()).hexdigest()
    elif name == "op9":
        assert toxicity.classify(docs, labels, "y", F.lit(False)).where("score between 0 and 1").count() == 4
    elif name == "op2":
        got = {x.page_id: x for x in warc.archive_pages(docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a/").alias("url"), F.col("text").alias("html"))).collect()}
        assert got[2].payload_bytes == len(long.encode()) and got[2].payload_digest == hashlib.sha1(long.encode()).hexdigest()
    elif name == "op3":
        got = {x.doc_id: x for x in quality_rules.line_first_clean(docs).collect()}
        assert got[2].n_words == n and got[2].word_chars == len("".join(long.split())) and got[2].n_dup_lines > 0
    elif name == "op4":
        got = {x.doc_id: x for x in mixing.mix(docs, F.array(F.lit("s"))).collect()}
        assert got[2].size == n and sum(x.taken for x in got.values()) == got[2].source_size == n + 60 + 40
    elif name == "op5":
        made = token_counts.Tokenizer(queries.vocabulary("byte_bpe_50k.json"))
        got = {x.doc_id: x for x in token_counts.token_counts(docs, made).collect()}
        assert got[2].n_bytes == len(long.encode()) and got[2].over_limit and got[2].n_tokens > n
    elif name == "op8":
        items = spark.createDataFrame([(7, passage)], "item_id long, text string")
        assert {(x.doc_id, x.start, x.similarity) for x in decontaminate.leaks(docs, items).collect()} == {(1, 0, 1.0), (2, n - 60, 1.0)}
    elif name == "op11":
        got = {x.phrase: x for x in collocations.collocations(docs.withColumn("lang", F.lit("en"))).collect()}
        assert got and all(x.n == n + 60 + 40 for x in got.values())
    elif name == "op13":
        got = {x.doc_id: x for x in sharding.shard(docs, 2).collect()}
        assert got[2].size == len(long.encode()) + 1 and got[2].text_crc32 == zlib.crc32(long.encode())
    else:
        w = long.lower().split()
        got = {x.doc_id: x for x in near_dup.near_duplicates(docs, 3, 85).collect()}
        assert got[2].n_shingles == len(set(zip(w, w[1:], w[2:]))) and all(x.kept for x in got.values())


# -- words and sequences that linear hashes confuse -------------------------------------------------------


def thue_morse(n):
    return [bin(i).count("1") & 1 for i in range(n)]


TWINS = ["".join("ab"[x] for x in thue_morse(1024)), "".join("ba"[x] for x in thue_morse(1024))]
SEQUENCES = [" ".join(f"{w}{x}" for x in thue_morse(1024)) for w in ("a",)] + [" ".join(f"a{1 - x}" for x in thue_morse(1024))]


def test_hashes_tell_thue_morse_words_apart():
    for texts in (TWINS, SEQUENCES):
        batch = text.pa.RecordBatch.from_arrays([text.pa.array(texts)], ["text"])
        ((_, _, data, offs),) = text.pieces(batch)
        w = text.split(data, offs)
        h = text.word_hashes(w)
        for salt in (0, 0x51ED2701, 0x7A3D99E1):
            a, b = text.gram_hashes(h, w.first[:-1], w.first[1:], salt)
            assert a != b
        assert len(set(text.text_digests(w).to_pylist())) == 2 and len(set(h.tolist())) == 2


def test_runs_hash_alike_wherever_they_stand():
    r = np.random.default_rng(3)
    v = r.integers(0, 1 << 63, 5000).astype(np.uint64)
    lo = np.sort(r.integers(0, 4000, 300))
    hi = lo + r.integers(0, 900, 300)
    whole = text.run_hashes(v, lo, hi)
    for i in range(0, 300, 7):
        part = v[lo[i] : hi[i]]
        assert text.run_hashes(part, np.zeros(1, int), np.array([len(part)]))[0] == whole[i]
    assert len(set(whole.tolist())) == len({v[a:b].tobytes() for a, b in zip(lo, hi)})


def test_operators_tell_thue_morse_words_apart(spark):
    docs = table(spark, [(0, TWINS[0]), (1, TWINS[1]), (2, SEQUENCES[0]), (3, SEQUENCES[1])])
    held = F.col("doc_id") % 2 == 1
    assert {r.doc_id: r.n_known for r in lm_score.score(docs, held).collect()}[1] == 1  # the end alone
    assert all(r.kept for r in near_dup.near_duplicates(docs.where("doc_id < 2"), k=3, percent=85).collect())
    got = {(r.doc_id, r.n_removed) for r in substring_dedup.dedup_substrings(docs).collect()}
    want = brute_substrings([(r.doc_id, r.text) for r in docs.collect()], 50)
    assert got == {(i, n) for i, _, n, _ in want}
    rows = {r.doc_id: r for r in quality_model.statistics(docs.select("doc_id", F.concat_ws(" ", F.lit(TWINS[0]), "text").alias("text"))).collect()}
    assert rows[0]["_distinct"] == 0.5 and rows[1]["_distinct"] == 1.0
    a, b = (toxicity.features(*(lambda t: (np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)])))(t))[1] for t in TWINS)
    assert sorted(a.tolist()) != sorted(b.tolist())


def test_features_equal_brute_force():
    """Words, stems, neighbours and pairs with a word between, each hashed alone."""
    t = "Abc def's, ghijklmno!  Abc\nüber-x 12"
    data = np.frombuffer(t.encode(), np.uint8)
    owner, got = toxicity.features(np.concatenate([data, data]), np.array([0, len(data), 2 * len(data)]))
    low = bytes(toxicity._lower(data))
    words = re.findall(b"[" + re.escape(bytes(np.flatnonzero(toxicity._table).astype(np.uint8))) + b"]+", low)
    one = lambda w: text.byte_hashes(np.frombuffer(w, np.uint8), np.zeros(1, int), np.array([len(w)]))
    h = [one(w) for w in words]
    want = h + [one(w[:k]) ^ np.uint64(k) for k in toxicity.STEMS for w in words if len(w) > k]
    want += [text.mix(h[i] * np.uint64(3) + h[i + gap] + np.uint64(gap)) for gap in (1, 2) for i in range(len(h) - gap)]
    want = Counter(int(x[0] >> np.uint64(64 - toxicity.BITS)) for x in want)
    assert len(words) > 5 and all(Counter(got[owner == i].tolist()) == want for i in (0, 1))


# -- 11: collocations ---------------------------------------------------------------------------------------


def brute_collocations(rows, least, most=2000, longest=3):
    f, n = defaultdict(Counter), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        c = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in c.items():
            if any(100 * b >= 50 * a for q, b in c.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:most])]
    return sorted(out)


@pytest.mark.parametrize("least,bits,block,part", [(2, 27, 1 << 20, 1 << 23), (3, 10, 7, 99), (10, 27, 50, 5000)])
def test_collocations(spark, odd, monkeypatch, least, bits, block, part):
    """Also where bitmaps let nearly everything pass, and with batches of a few words."""
    for name, value in (("LEAST", least), ("BITS", bits), ("BLOCK", block), ("PART", part)):
        monkeypatch.setattr(collocations, name, value)
    r = random.Random(5)
    small = ["ab", "Cd", "é", "ß-x", "ab"]
    more = [(100 + i, "".join(r.choice(small) + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ! "]) for _ in range(r.randint(0, 60)))) for i in range(40)]
    docs = odd.unionByName(table(spark, more)).withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "en").when(F.col("doc_id") % 3 == 1, "und"))
    rows = [(r.lang, r.text) for r in docs.collect()]
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    want = brute_collocations(rows, least)
    assert got == want and len(want) > 20
    few = sorted(map(tuple, collocations.collocations(docs, most=3).collect()))
    assert few == [w for w in want if w[1] <= 3]


def test_late_phrases_are_counted_for_a_whole_cycle(spark, monkeypatch):
    """A phrase whose words come to the threshold only in the last shard is counted in every shard."""
    monkeypatch.setattr(collocations, "LEAST", 4)
    texts = [(i, f"x y z filler{i}") for i in range(4)] + [(9, "x y y z")]
    docs = table(spark, texts).coalesce(1)
    got = {r.phrase: r.a for r in collocations.collocations(docs).collect()}
    assert got == {"x y z": 4}
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_only_first_phrases_are_spelled(spark, monkeypatch):
    """Of all frequent phrases those of a language's first places, and what shares the last by score and count."""
    monkeypatch.setattr(collocations, "LEAST", 2)
    asked, spelled = [], collocations.spelled
    monkeypatch.setattr(collocations, "spelled", lambda corpus, some: asked.append(some.count()) or spelled(corpus, some))
    r = random.Random(8)
    pool = [f"{r.choice(WORDS)}{r.choice(WORDS)}" for _ in range(60)]
    texts = [" ".join(r.choice(pool) for _ in range(80)) for _ in range(60)]
    tied = [f"z{x} y{x}." for x in "dbeac"]  # a score of 10^6 and a count of 3 each
    docs = table(spark, [(i, t) for i, t in enumerate([*texts, *tied, *tied, *tied])]).withColumn("lang", F.lit("en"))
    want = brute_collocations([("en", r.text) for r in docs.collect()], 2)
    got = sorted(map(tuple, collocations.collocations(docs, most=3).collect()))
    assert got == want[:3] and [x[2] for x in got] == ["za ya", "zb yb", "zc yc"]
    assert asked == [5] and len(want) > 500


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases_seen_between_looks(spark, monkeypatch, seed):
    """Words and pairs that come to the threshold in any scan of either cycle are looked up later, and lose no count."""
    monkeypatch.setattr(collocations, "LEAST", 3)
    r = random.Random(seed)
    texts = [" ".join(f"{'abcd'[i % 4] if r.random() < 0.3 else ''}{r.choice('klmnop')}" for _ in range(12)) for i in range(24)]
    docs = table(spark, list(enumerate(texts))).coalesce(1)
    got = sorted(map(tuple, collocations.collocations(docs).collect()))
    assert got == brute_collocations([("en", t) for t in texts], 3) and len(got) > 20


def test_a_phrase_is_given_out_by_one_file(spark):
    """Its home: else every task of a shard that holds a phrase would give it out."""
    docs = table(spark, [(i, prose(i, 30)) for i in range(60)]).repartition(3)
    corpus, _ = collocations.dealt(docs.withColumn("lang", F.lit("en")))
    rows = [(int(collocations.homes(np.array([r.row], np.uint64))[0]), r.file, r.shard) for r in corpus.select("row", "shard", F.input_file_name().alias("file")).collect()]
    assert len(set(rows)) == len({x[0] for x in rows}) == len({x[1] for x in rows}) == 3 * collocations.SHARDS


def test_entries_of_large_texts_hold_many_phrases():
    """A batch has an entry for each part of the hash range: few parts, but none of more than a bounded share of the texts."""
    for size in (1 << 20, 1 << 25, 1 << 28, 1 << 30, 3 << 30, 12 << 30, 1 << 40):
        parts = 1 << collocations.split_bits(size)
        assert size / parts < 4 * collocations.PART and parts <= max(collocations.MANY, size / (2 * collocations.PART))
    assert 1 << collocations.split_bits(12 << 30) == 512  # 2,048 before


# -- 12: whitening -------------------------------------------------------------------------------------------


def brute_whitening(rows, components=4):
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    keep = e > 1e-9
    e, u = e[keep], u[:, keep]
    trace = np.trace(c.T @ c / n)
    return {(i, k + 1): (n, int(((n * a - s) ** 2).sum()), float((a - s / n) @ u[:, k] / math.sqrt(e[k])), e[k] / trace) for (i, _), a in zip(rows, x) for k in range(len(e))}


VECTORS = "vec_id long, embedding array<float>, label int"


def check_whitening(got, want, columns=None):
    assert len(got) == len(want)
    sign = {}
    for r in got:
        n, deviation, w, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and abs(r.explained - explained) <= 1e-4 * explained and r.identity_error <= 1e-4
        if abs(w) > 1e-3:
            assert sign.setdefault(r.component, np.sign(w * r.whitened)) == np.sign(w * r.whitened)
        assert abs(abs(r.whitened) - abs(w)) < 1e-7


@pytest.mark.parametrize("n,d", [(60, 7), (400, 24), (5, 6), (2, 3)])
def test_whitening(spark, n, d):
    r = np.random.default_rng(n)
    rows = [(i, (r.standard_normal(d) * (3 + np.arange(d))).tolist()) for i in range(n)]
    rows += [(1000, rows[0][1]), (1001, rows[1][1]), (1002, None), (1003, [None] * d), (1004, [float("nan")] * d), (1005, [float("inf")] + [0.0] * (d - 1)), (1006, []), (1007, rows[0][1][:-1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumns({"x": F.lit(1), "n": F.lit("n"), "component": F.lit(2)})
    check_whitening(whitening.whiten(df).collect(), brute_whitening([(i, v) for i, v in rows if i != 1007]))


def test_whitening_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (None, None, 1)], VECTORS)
    assert whitening.whiten(df).count() == 0 and whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.where("vec_id is null")).count() == 0
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (None, [2.0, 2.0], 0), (None, [2.0, 2.0], 0)], VECTORS).transform(whitening.whiten).collect()
    assert [(r.component, round(abs(r.whitened), 9), r.n) for r in one] == [(1, 1.0, 2)] * 3
    huge = spark.createDataFrame([(1, [3e15, 2.0], 0), (2, [-3e15, 2.0], 0)], VECTORS).transform(whitening.whiten).collect()
    assert all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-9 for r in huge)


def test_feast_against_eigh():
    r = np.random.default_rng(2)
    close = np.diag([1.0] * 5 + [0.999] * 5 + [0.5] * 20)
    turn = np.linalg.qr(r.standard_normal((30, 30)))[0]
    for v in (np.eye(9), turn @ close @ turn.T, np.diag([1e9, 1.0, 1e-3]), (lambda a: a.T @ a)(r.standard_normal((40, 33))), np.zeros((4, 4))):
        e, u = whitening.leading(v, 4)
        want = np.linalg.eigvalsh(v)[::-1][:4]
        want = want[want > 1e-12 * np.trace(v)]
        scale = max(1e-300, np.trace(v))
        assert len(e) == len(want) and np.abs(e - want).max(initial=0) < 1e-13 * scale
        assert np.abs(v @ u - u * e).max(initial=0) < 1e-13 * scale and np.abs(u.T @ u - np.eye(len(e))).max(initial=0) < 1e-12
        t = whitening.tridiagonal(v)
        assert all(whitening.inertia(*t, s) == (np.linalg.eigvalsh(v) > s).sum() for s in r.uniform(0, scale, 5))


def test_feast_refuses_a_wrong_count():
    with pytest.raises(ArithmeticError):
        whitening.feast(np.diag([3.0, 2.0, 1.0]), 1.5, 2.5, 2)


# -- 13: sharding --------------------------------------------------------------------------------------------


def brute_shards(keys, points, shards):
    """shard of every key (position, tie): key after key in the order of the ring, then those that found their shard full."""
    keys = sorted(keys)
    room = [len(keys) // shards + (s < len(keys) % shards) for s in range(shards)]
    owners = [s for _, s in points]
    out, late = {}, []
    for k in keys:
        at = next((i for i, (p, _) in enumerate(points) if p >= k[0]), 0)
        if room[owners[at]]:
            room[owners[at]] -= 1
            out[k] = owners[at]
        else:
            late.append((k, at))
    for k, at in late:
        while not room[owners[at]]:
            at = (at + 1) % len(owners)
        room[owners[at]] -= 1
        out[k] = owners[at]
    return out


@pytest.mark.parametrize("shards,points", [(16, 256), (5, 3), (1, 4)])
def test_sharding(spark, odd, shards, points):
    docs = odd.unionByName(table(spark, [(100 + i, prose(i, i % 7)) for i in range(300)] + [(7, "hot") for _ in range(150)]))
    got = sharding.shard(docs, shards, points).collect()
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", F.lit(sharding.KEY_SEED)).alias("h")).collect()
    facts = lambda i, t: (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(facts(r.doc_id, r.text) for r in rows)
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(shards)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = brute_shards([(r.h, i) for i, r in enumerate(rows)], sharding.ring(spark, shards, points), shards)
    h = {r.doc_id: r.h for r in rows}
    assert Counter((h[r.doc_id], r.shard) for r in got) == Counter((k[0], s) for k, s in want.items())
    again = sharding.shard(docs.repartition(3), shards, points).collect()
    assert Counter((r.doc_id, r.shard) for r in again) == Counter((r.doc_id, r.shard) for r in got)


def test_a_further_shard_moves_few_rows(spark):
    docs = table(spark, [(i, "t") for i in range(6000)])
    place = lambda n: {r.doc_id: r.shard for r in sharding.shard(docs, n).collect()}
    a, b = place(16), place(17)
    assert sum(a[i] != b[i] for i in a) < 0.15 * len(a)  # a remainder of doc_id would move 94 %
    assert sharding.shard(docs.limit(0)).count() == 0
