"""Mixing sources to target weights by systematic sampling, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import durable, n_words

SALTS = 64


def _source_key(source: Column) -> Column:
    """Never null, in code point order with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def mixed_documents(docs: DataFrame, **mixing) -> DataFrame:
    """The mix itself: each document as often as mix_sources takes it, in its own columns."""
    taken = mix_sources(docs, carry=True, **mixing).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def source_targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """(key, source_size, target) for each source of (key, size).

    The sources, in order of key, have the weights in turn, repeating. share times all sizes is
    dealt out by weight; a target stops at `most` times its source's size and the rest is dealt
    again, so that in the end target = min(most * size, weight * level) with one level for all.
    Sorted by size for weight, the sources that stop come first: the level follows from prefix sums.
    These windows see one row a source.
    """
    sums = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sums.select(
        "*",
        F.element_at(cycle, (((F.row_number().over(W.orderBy("key")) - 1) % len(weights)) + 1).cast("int")).alias("weight"),
    )
    before = W.orderBy("ratio", "key").rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy("ratio", "key").rowsBetween(0, W.unboundedFollowing)
    levels = (
        ranked.withColumn("ceiling", F.col("source_size") * most)
        .withColumn("ratio", F.col("ceiling") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(W.partitionBy()) * F.lit(float(share)))
        .withColumn("level", (F.col("budget") - F.coalesce(F.sum("ceiling").over(before), F.lit(0))) / F.sum("weight").over(rest))
        .withColumn("open", F.col("ceiling") > F.col("weight") * F.col("level"))
    )
    final = F.min_by("level", F.when(F.col("open"), F.struct("ratio", "key"))).over(W.partitionBy())
    return levels.withColumn("final", final).select(
        "key",
        "source_size",
        F.when(F.col("final").isNull() | (F.col("ceiling") <= F.col("weight") * F.col("final")), F.col("ceiling").cast("double"))
        .otherwise(F.col("weight") * F.col("final"))
        .alias("target"),
    )


def mix_sources(
    docs: DataFrame,
    weights=(3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: bool = False,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for each document.

    Size is the number of words (null text: 0), taken is copies * size. Within a source every
    document expects target / source_size copies; these are summed along the source from one
    random offset, and a document is taken once for each integer that the sum crosses in it. In
    order of size (two leading digits, salt, then size and id) the error of a source's words stays
    about one document. The position of a document is its rank among those of its size class and
    salt plus the counts of the classes before, so that no source is sorted in one task.

    A source of size 0 has target 0 and nothing is taken. Null source: a source of its own, last.
    Null ids count as equal; repeated rows are documents of their own. Reruns agree, as offset and
    salt are hashes of source and id. With carry, a column `row` holds the whole document.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.col(f"`{source_col}`").alias("source"),
        _source_key(F.col(f"`{source_col}`")).alias("key"),
        n_words(F.col(f"`{text_col}`")).alias("size"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    sized = durable(rows.drop("row"), "sizes")
    targets = source_targets(sized, weights, share, most)
    digits = F.col("size").cast("string")

    def dealt(df: DataFrame) -> DataFrame:
        return df.select(
            "*",
            (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).alias("class"),
            (_hex(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 2) % SALTS).alias("salt"),
        )

    cells = dealt(sized).groupBy("key", "class", "salt").agg(F.count(F.lit(1)).alias("n"))
    along = W.partitionBy("key").orderBy("class", "salt").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        cells.withColumn("start", F.coalesce(F.sum("n").over(along), F.lit(0)))
        .join(targets, "key")
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("offset", _hex(F.concat(F.lit(f"{seed}:"), "key"), 6) / F.lit(16777216.0))
        .drop("n")
    )
    place = F.row_number().over(W.partitionBy("key", "class", "salt").orderBy("size", "doc_id"))
    at = F.col("start") + F.col("place")
    copies = F.floor(at * F.col("rate") + F.col("offset")) - F.floor((at - 1) * F.col("rate") + F.col("offset"))
    return (
        dealt(rows if carry else sized)
        .withColumn("place", place)
        .join(starts, ["key", "class", "salt"])
        .withColumn("copies", F.least(copies, F.lit(most)).cast("long"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["row"] if carry else []))
    )


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sums AS (SELECT k, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY k),
ranked AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY k) - 1) % 3) + 1] AS weight FROM sums),
levels AS (
  SELECT *, source_size * 2 AS ceiling, CAST(source_size * 2 AS DOUBLE) / weight AS ratio,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS budget FROM ranked),
leveled AS (
  SELECT *, (budget - CAST(coalesce(sum(ceiling) OVER (ORDER BY ratio, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / CAST(sum(weight) OVER (ORDER BY ratio, k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level FROM levels),
final AS (SELECT level AS final FROM leveled WHERE ceiling > weight * level ORDER BY ratio, k LIMIT 1),
targets AS (
  SELECT k, source_size, CASE WHEN final IS NULL OR ceiling <= weight * final THEN CAST(ceiling AS DOUBLE) ELSE weight * final END AS target
  FROM leveled LEFT JOIN final ON true),
dealt AS (
  SELECT *, length(CAST(size AS VARCHAR)) * 100 + CAST(substr(CAST(size AS VARCHAR), 1, 2) AS INT) AS class,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS BIGINT) % 64 AS salt FROM sized),
placed AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY class, salt, size, doc_id NULLS FIRST) AS pos FROM dealt),
rated AS (
  SELECT p.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         CAST('0x' || substr(md5('mix:' || p.k), 1, 6) AS BIGINT) / 16777216.0::DOUBLE AS off
  FROM placed p JOIN targets t ON p.k = t.k),
copied AS (SELECT *, CAST(least(floor(pos * rate + off) - floor((pos - 1) * rate + off), 2) AS BIGINT) AS copies FROM rated)
SELECT doc_id, source, size, source_size, target, copies, copies * size AS taken FROM copied
"""
