"""Token counts through a digest cache: only texts that the cache lacks are encoded, once each."""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakesteps.llm.bpe import byte_letters, vocabulary_path
from lakesteps.llm.common import per_text, text_or_empty
from lakesteps.session import materialize, run_dir

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
CACHE_SCHEMA = "digest binary, version string, n_tokens long"
#: Pieces a byte-level vocabulary is applied to: contractions, then words, numbers and signs with
#: the space before them, then white space.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def counter(name: str):
    """A function text -> number of tokens, as the tokenizer file gives them.

    The vocabulary runs in the faster of two libraries that agree on it; texts that one refuses go
    to the other.
    """
    import tiktoken
    from tokenizers import Tokenizer

    path = vocabulary_path(name)
    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    spec = json.load(open(path, encoding="utf-8"))
    byte = {c: b for b, c in enumerate(byte_letters())}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    fast = tiktoken.Encoding(name, pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)

    def count(text: str) -> int:
        if len(text) > 1_000_000:  # a long run of one sign can exhaust the faster one's matcher
            return len(whole.encode(text, add_special_tokens=False))
        return len(fast.encode(text, allowed_special="all"))

    return count


def vocabulary_version(name: str) -> str:
    """Digest of the tokenizer file; counts of another file are never used."""
    with open(vocabulary_path(name), "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def open_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one version; empty while nothing is stored at ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("version") == version)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, id: str = "doc_id", text: str = "text", name: str = VOCABULARY,
                 limit: int = LIMIT, cache: str | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit.

    Texts are known by the digest of their content (null made empty, otherwise unchanged, as any
    other change could change the count) and the digest of the tokenizer file. Only the digests
    are compared with the cache; of the texts it lacks one row each is encoded and appended to
    ``cache``, a folder of Parquet files. Without ``cache`` one is made in the shared folder.
    Repeated rows get the same answer each; other columns are ignored.
    """
    spark = docs.sparkSession
    version = vocabulary_version(name)
    cache = cache or f"{run_dir(spark)}/token-cache-{uuid.uuid4().hex}"
    rows = docs.select(F.col(f"`{id}`").alias("id"), text_or_empty(text).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keys = materialize(rows.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes")),
                       "token-keys")
    first = keys.groupBy("digest").agg(F.min("id").alias("first"))
    misses = first.join(open_cache(spark, cache, version), "digest", "left_anti")
    wanted = misses.withColumnRenamed("digest", "miss").hint("shuffle_hash")
    todo = rows.join(wanted, (F.col("digest") == F.col("miss")) & F.col("id").eqNullSafe(F.col("first")),
                     "left_semi").select("digest", "text")

    def work(texts: list[str]) -> list[tuple]:
        count = counter(name)
        return [(count(t),) for t in texts]

    made = per_text(todo, work, "n_tokens long").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    made.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    known = keys.join(open_cache(spark, cache, version), "digest")
    return known.select(F.col("id").alias(id), "n_bytes", "n_tokens",
                        (F.col("n_tokens") > limit).alias("over_limit"))
