"""Exact dedup by progressive refinement: length, prefix hash, full digest.

Equality is of the normalised text (each run of ASCII white space becomes one
blank, null is empty). One pass over the texts yields three keys per row, and
only those keys move: lengths that occur once leave first, then prefixes that
occur once within their length, and only the rest is grouped by the whole text's
SHA-256. All steps are DataFrame operations.

Edge cases: a null text equals an empty one; a null ``doc_id`` loses against any
id and groups made of nulls only keep one row; rows that repeat both id and text
keep exactly one of them; an empty table gives an empty result; columns other
than the two named are not read, so clashing names cannot matter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesrel.llm.text import unused
from seriesrel.session import scratch_path

PREFIX_CHARS = 64
SALTS = 32
_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACE, " ")


def content_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, length, prefix_hash, digest)`` for each row of ``docs``."""
    norm = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    return norm.select("doc_id", F.char_length("norm").alias("length"),
                       F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("prefix_hash"),
                       F.sha2("norm", 256).alias("digest"))


def surviving(keys: DataFrame, by: list[str]) -> DataFrame:
    """The rows whose ``by`` values occur more than once.

    Counts combine before the exchange; the rows of one value are salted by id for the
    join, and the few repeated values are copied to each salt.
    """
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS).cast("long"))
    many = keys.groupBy(*by).count().where("count > 1").select(
        *by, F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    return keys.withColumn("salt", salt).join(many, [*by, "salt"], "left_semi").drop("salt")


def exact_groups(keys: DataFrame) -> DataFrame:
    """``(length, prefix_hash, digest, keep_id, group_size)`` of texts that occur more than once."""
    same_length = surviving(keys.select("doc_id", "length", "prefix_hash", "digest"), ["length"])
    same_prefix = surviving(same_length, ["length", "prefix_hash"])
    return (same_prefix.groupBy("length", "prefix_hash", "digest")
            .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .where("group_size > 1"))


def decided_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct (id, text): ``doc_id, digest, copies, keep_id, group_size, stays``.

    The keys are written to the shared folder once, so the text is read once and a
    lost executor costs a re-read of small rows. The groups are written too: the join
    then has two plain exchanges, and the adaptive plan splits a digest of many copies.
    """
    by = ["length", "prefix_hash", "digest"]
    keys = _written(content_keys(docs, id_col, text_col), "exact-keys")
    groups = _written(exact_groups(keys), "exact-groups")
    joined = keys.join(groups, by, "left")
    single = F.col("group_size").isNull()
    keep = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    rows = joined.select("doc_id", "digest", keep.alias("keep_id"),
                         F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"))
    return (rows.groupBy("doc_id", "digest", "keep_id", "group_size").agg(F.count("*").alias("copies"))
            .withColumn("stays", F.col("doc_id").eqNullSafe(F.col("keep_id"))))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    flat = decided_pairs(docs, id_col, text_col).select(
        "doc_id", "keep_id", "group_size", "stays", "digest", each)
    return flat.select("doc_id", "keep_id", "group_size",
                       (F.col("stays") & (F.col("copy") == 1)).alias("kept"),
                       F.col("digest").alias("text_sha256"))


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that :func:`exact_dedup` drops; all columns stay, whatever their names.

    The ids that go are written before the join, so that the plan knows their size and
    moves the texts only if they are many. An id that names several rows does not say
    which of them goes; such rows are told apart by their digest.
    """
    pairs = _written(decided_pairs(docs, id_col, text_col), "exact-decided")
    several = _written(pairs.groupBy("doc_id").agg(F.sum("copies").alias("n")).where("n > 1").select("doc_id"), "exact-several")
    cols, name, sha = docs.columns, unused(docs, "id"), unused(docs, "sha")
    gone = pairs.where(~F.col("stays")).select(F.col("doc_id").alias(name)).distinct()
    same = F.col(id_col).eqNullSafe(F.col(name))
    if several.isEmpty():
        return docs.join(_written(gone, "exact-gone"), same, "left_anti")
    odd = several.select(F.col("doc_id").alias(name))
    once = docs.join(_written(gone.join(odd, gone[name].eqNullSafe(odd[name]), "left_anti"), "exact-gone"), same, "left_anti")
    rest = once.join(odd, same, "left_anti")
    keyed = docs.join(odd, same, "left_semi").withColumn(sha, F.sha2(normalised(F.col(text_col)), 256))
    stay = pairs.where("stays").select(F.col("doc_id").alias(name), F.col("digest").alias(name + "d"))
    ones = keyed.join(stay, same & (F.col(sha) == F.col(name + "d")), "left_semi").dropDuplicates([id_col, sha])
    return rest.unionByName(ones.select(*cols))
