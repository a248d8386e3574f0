"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import collocations, decontaminate, lm_score, mixing, near_dup, quality_model, quality_rules, sharding, substring_dedup, token_counts, toxicity, warc, whitening
from .work import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(modulus: int):
    """crc32 of doc_id as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op1_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_model.classify(docs, labels, "quality", remainder(5) == 0)


def op2_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark, sf_dir):
    return quality_rules.line_first_clean(table(spark, sf_dir, "documents"))


def op4_mixing(spark, sf_dir):
    rows = mixing.mix(table(spark, sf_dir, "documents"), F.array("source"))
    return rows.select("doc_id", "size", "source_size", "target", "taken")


def op5_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.Tokenizer(vocabulary("byte_bpe_50k.json")))


def op6_lm_score(spark, sf_dir):
    rows = lm_score.score(table(spark, sf_dir, "documents"), remainder(7) == 2)
    return rows.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})  # sums of any order agree


def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.classify(docs, labels, "toxic", remainder(4) == 2)


def op10_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_sharding(spark, sf_dir):
    return sharding.shard(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_warc, op3_quality_rules, op4_mixing, op5_token_counts, op6_lm_score, op7_substring_dedup, op8_decontaminate, op9_toxicity, op10_near_dup, op11_collocations, op12_whitening, op13_sharding)}
ORACLE_SQL = {"op2_warc": warc.ORACLE_SQL, "op3_quality_rules": quality_rules.ORACLE_SQL, "op6_lm_score": lm_score.ORACLE_SQL, "op7_substring_dedup": substring_dedup.ORACLE_SQL, "op8_decontaminate": decontaminate.ORACLE_SQL, "op10_near_dup": near_dup.ORACLE_SQL, "op11_collocations": collocations.ORACLE_SQL}
