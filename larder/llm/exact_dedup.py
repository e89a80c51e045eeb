"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import saved, small, text_of, without

PREFIX = 64
OUTPUT = ("keep_id", "group_size", "kept", "listings")


def normalised(text: Column) -> Column:
    """The text without spaces, tabs and line breaks (code points 9 to 13 and 32)."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def surviving(df: DataFrame, text_col: str) -> DataFrame:
    """The (length, prefix hash) pairs that more than one row has.

    One scan counts the pairs; the lengths' counts are the sums of theirs. Pairs of lengths that
    occur once are left out first, then pairs that occur once.
    """
    norm = normalised(text_of(text_col))
    sized = saved(
        df.select(F.length(norm).alias("size"), F.xxhash64(F.substring(norm, 1, PREFIX)).alias("prefix"))
        .groupBy("size", "prefix")
        .agg(F.count("*").alias("n")),
        "dedup-sizes",
    )
    lengths = saved(sized.groupBy("size").agg(F.sum("n").alias("rows")).where("rows > 1"), "dedup-lengths")
    return sized.where("n > 1").join(small(lengths), "size", "left_semi").select("size", "prefix")


def grouped(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows with their group's figures, and the stored table of groups."""
    text = text_of(text_col)
    norm = normalised(text)
    sized = df.withColumns(
        {
            "larder_size": F.length(norm),
            "larder_prefix": F.xxhash64(F.substring(norm, 1, PREFIX)),
            "larder_chars": F.length(text),
        }
    )
    again = saved(surviving(df, text_col), "dedup-prefixes")
    again = small(again.select(F.col("size").alias("larder_size"), F.col("prefix").alias("larder_prefix")))
    keys = ["larder_size", "larder_prefix"]
    flagged = sized.join(again.withColumn("larder_again", F.lit(True)), keys, "left")
    hashed = flagged.withColumn("larder_hash", F.when(F.col("larder_again"), F.sha2(norm, 256)))
    rows = saved(
        hashed.where("larder_hash is not null")
        .groupBy("larder_hash", "larder_chars", column(id_col).cast("bigint").alias("id"))
        .agg(F.count("*").alias("n")),
        "dedup-hashes",
    )
    order = F.struct(
        (-F.col("larder_chars")).alias("less"), F.col("id").isNull().alias("no_id"), "id", "n"
    )
    groups = saved(
        rows.groupBy("larder_hash")
        .agg(F.sum("n").alias("group_size"), F.min(order).alias("best"))
        .where("group_size > 1")
        .select(
            F.col("larder_hash"),
            "group_size",
            F.col("best.id").alias("keep_id"),
            F.col("best.n").alias("listings"),
            (-F.col("best.less")).alias("keep_chars"),
        ),
        "dedup-groups",
    ).withColumnsRenamed(
        {"larder_hash": "larder_group", **{name: f"larder_{name}" for name in ("group_size", "keep_id", "listings", "keep_chars")}}
    )
    # a row without copies needs a key of its own, or all of them would meet in one partition
    key = F.coalesce("larder_hash", F.hex(F.xxhash64(column(id_col), F.col("larder_prefix"))))
    joined = hashed.withColumn("larder_key", key).join(
        small(groups), F.col("larder_key") == F.col("larder_group"), "left"
    )
    return joined, groups


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Mark the copies of every text: the input's columns and ``keep_id``, ``group_size``,
    ``kept``, ``listings``.

    Texts are equal if they are so without spaces, tabs and line breaks. Of equal texts the
    row with the most code points in its own text stays, then the one with the least id.
    Null texts count as empty, and empty texts are copies of one another. A null id comes
    last among equals; its row's ``keep_id`` is null only if no row of the group has an id.
    A row listed twice with the same id and text is one document: if it stays, each listing
    is ``kept``, and ``listings`` says how many there are (else 1). An empty table gives an
    empty table. An input column with the name of an output, in whatever case, is replaced; names that begin
    with ``larder_`` are reserved.

    Whole texts are hashed only where length and prefix occur twice. Groups are counted by
    hash before they are shuffled, so a group that holds a third of all rows is one row per
    task. The groups are broadcast if a count shows that they are few; beyond, the join that
    hands them out shuffles the rows and can be split.
    """
    names = [column(field.name) for field in without(df, OUTPUT)]
    joined, _ = grouped(df, id_col, text_col)
    return joined.select(*names, *decisions(id_col))


def decisions(id_col: str) -> list[Column]:
    own = column(id_col).cast("bigint")
    alone = F.col("larder_group").isNull()
    mine = alone | (
        (F.col("larder_keep_chars") == F.col("larder_chars")) & F.col("larder_keep_id").eqNullSafe(own)
    )
    one = F.lit(1).cast("bigint")
    return [
        F.when(alone, own).otherwise(F.col("larder_keep_id")).alias("keep_id"),
        F.coalesce("larder_group_size", one).alias("group_size"),
        mine.alias("kept"),
        F.when(mine, F.coalesce("larder_listings", one)).otherwise(one).alias("listings"),
    ]


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that :func:`exact_dedup` keeps, a document that is listed twice only once."""
    joined, groups = grouped(df, id_col, text_col)
    names = [column(name) for name in df.columns]
    kept, listings = (found.alias(f"larder_{i}") for i, found in enumerate(decisions(id_col)[2:]))
    rows = joined.select(*names, "larder_hash", kept, listings).where("larder_0")
    if groups.where("larder_listings > 1").isEmpty():
        return rows.select(*names)
    once = rows.where("larder_1 = 1")
    often = rows.where("larder_1 > 1").dropDuplicates(["larder_hash"])
    return once.unionByName(often).select(*names)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return exact_dedup(docs).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.sha2(normalised(text_of("text")), 256).alias("text_sha256"),
    )


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id)
"""
