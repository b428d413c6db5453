"""Exact deduplication: combine copies locally, then by salted digest, then over all salts.

Every stage groups by the whole text beside its digest, so equal digests of unlike texts never
merge. A text with any number of copies reaches the last stage as one row per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakesteps.llm.common import free_name, text_or_empty
from lakesteps.session import materialize

SALTS = 16


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def text_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", digest=sha256,
                salts: int = SALTS) -> DataFrame:
    """One row per text: digest, text, keep_id (largest id; null only if all are), group_size.

    The result is partitioned by digest. Null texts count as empty.
    """
    rows = docs.select(
        text_or_empty(text).alias("text"), F.col(f"`{id}`").alias("keep_id"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    rows = rows.withColumn("digest", digest(F.col("text")))
    # All rows of a task share a salt, so the map side of this grouping is the local stage.
    salted = rows.groupBy("digest", "salt", "text").agg(
        F.max("keep_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return (salted.repartition("digest").groupBy("digest", "text")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))


def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", digest=sha256,
                     salts: int = SALTS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after no change; null counts as empty. Of equal texts the row
    with the largest id stays (a null id is smaller than any). Rows that repeat both id and text
    are one document: they count in group_size, and each reports the same verdict. Other columns
    of ``docs`` are ignored. An empty table gives no rows.
    """
    groups = materialize(
        text_groups(docs, id, text, digest, salts).groupBy("digest").agg(
            F.count(F.lit(1)).alias("n_texts"), F.max("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size")), "exact-groups")
    rows = docs.select(F.col(f"`{id}`").alias("id"), text_or_empty(text).alias("text"))
    rows = rows.withColumns({"digest": digest(F.col("text")), "text_sha256": sha256(F.col("text"))})
    found = rows.drop("text").join(groups.where("n_texts = 1").drop("n_texts"), "digest")
    shared = groups.where("n_texts > 1").select("digest")
    if not shared.isEmpty():  # one digest for several texts: those rows are joined by text
        clash = rows.join(shared, "digest", "left_semi")
        exact = text_groups(clash, "id", "text", digest, salts)
        found = found.unionByName(clash.join(exact, ["digest", "text"]).drop("text"))
    return found.select(
        F.col("id").alias(id), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one_copy(docs: DataFrame, id: str = "doc_id", text: str = "text",
                  salts: int = SALTS) -> DataFrame:
    """``docs`` with one row per text, that of the largest id; columns stay as they are.

    Of rows that repeat both id and text, the one whose other columns are largest as JSON text
    stays. A null text is kept as null only if no empty text has a larger id.
    """
    names = {k: free_name(docs, f"__exact_{k}") for k in ("digest", "id", "text", "null", "rest")}
    others = docs.select(
        sha256(text_or_empty(text)).alias(names["digest"]), F.col(f"`{id}`").alias(names["id"]),
        F.struct(F.col(f"`{text}`").isNull().alias(names["null"]),
                 *(F.col(f"`{c}`") for c in docs.columns if c != text)).alias(names["rest"]))
    others = others.groupBy(names["digest"], names["id"]).agg(
        F.max_by(names["rest"], F.to_json(names["rest"])).alias(names["rest"]))
    kept = text_groups(docs, id, text, salts=salts).select(
        F.col("digest").alias("__d"), F.col("text").alias(names["text"]), F.col("keep_id").alias("__k"))
    joined = kept.join(others, (F.col("__d") == F.col(names["digest"]))
                       & F.col("__k").eqNullSafe(F.col(names["id"])))
    rest = F.col(names["rest"])
    return joined.select(*(
        F.when(~rest[names["null"]], F.col(names["text"])).alias(c) if c == text
        else rest[c].alias(c) for c in docs.columns))
