"""Token counts through a cache of digests.

Content and tokenizer-version digests are looked up; only distinct misses are encoded, and their
counts are appended to the cache.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import fresh_path, saved

#: Texts of more tokens are over the limit.
LIMIT = 1024

# Fixed value: how byte-level tokenizers split a text before merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHE = "content_digest string, tokenizer_digest string, n_tokens long"


class Tokenizer:
    """A tokenizer file of the tokenizers library; special strings inside texts are special tokens, as its default is."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.raw = f.read()

    def digest(self) -> str:
        return hashlib.sha256(self.raw).hexdigest()


def byte_ranks(made: dict) -> dict[bytes, int] | None:
    """Tokens as bytes with their ids, if the file is plain byte-level BPE whose ids follow its merges; else None."""
    model, split = made["model"], made["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and split.get("type") == "ByteLevel" and not split["add_prefix_space"] and split["use_regex"] and not made["normalizer"] and not made["post_processor"]
    merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]] if plain else []
    if not plain or merged != list(range(256, 256 + len(merged))) or len(model["vocab"]) != 256 + len(merged):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the library writes these bytes as themselves, the others from 256 on
    byte = {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}}
    return {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}


def counter(raw: bytes):
    """A function from a text to its number of tokens.

    Plain byte-level BPE is counted by tiktoken over the file's own vocabulary: equal counts in a fifth of
    the time.  Other files, and texts that tiktoken refuses (about a million blanks in a row), go to the library.
    """
    import tiktoken

    made = json.loads(raw)
    ranks = byte_ranks(made)
    special = {t["content"]: t["id"] for t in made["added_tokens"]}
    fast = ranks and tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    @functools.cache
    def library():
        from tokenizers import Tokenizer as Library

        out = Library.from_str(raw.decode())
        out.no_truncation()
        out.no_padding()
        return out

    def count(text: str) -> int:
        if fast:
            try:
                return len(fast.encode_to_numpy(text, allowed_special="all"))
            except ValueError:
                pass
        return len(library().encode(text, add_special_tokens=False).ids)

    return count


def encode(misses: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """content_digest, n_tokens of each row's whole text."""
    shipped = misses.sparkSession.sparkContext.broadcast(tokenizer.raw)  # a vocabulary file of about 2 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or counter(shipped.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([count(x.as_py()) for x in batch.column(1)], pa.int64())], ["content_digest", "n_tokens"]
            )

    return misses.select("content_digest", "text").mapInArrow(run, "content_digest string, n_tokens long")


def token_counts(docs: DataFrame, tokenizer: Tokenizer, cache_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; a null text counts as empty.

    cache_path: a Parquet folder that later calls reuse; None: a new one in the shared folder.  Equal
    texts are encoded once however many rows hold them: the exchange of texts is by digest after a
    partial distinct in each task, and the join back moves digests only.  Rows in = rows out, with
    repeated and null ids as they are; other columns are not looked at.  An empty table gives none.
    """
    spark = docs.sparkSession
    cache_path = cache_path or fresh_path(spark, "token-cache")
    version = tokenizer.digest()
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache_path)
    known = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer_digest") == version).drop("tokenizer_digest")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.withColumn("content_digest", F.sha2("text", 256))
    misses = keyed.select("content_digest", "text").dropDuplicates(["content_digest"]).join(known, "content_digest", "left_anti")
    found = encode(misses, tokenizer).select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens")
    found.write.mode("append").parquet(cache_path)
    known = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer_digest") == version)
    # two calls at once may both append; written, so that the join stands alone and the rows of a hot digest can be split
    known = saved(known.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")), "token-counts")
    rows = keyed.select("doc_id", "content_digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.join(known.hint("merge"), "content_digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
