"""Shards of bounded size by extendible hashing: a bucket splits on one more hash bit only while it is too large."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import durable

BITS = 48


def shard_documents(docs: DataFrame, limit_bytes: int, id_col: str = "doc_id", text_col: str = "text", broadcast_cells: int = 1 << 16) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes, shard_rows, oversize) for each document.

    shard is the shortest prefix of the document's hash bits under which all texts, in UTF-8, have
    limit_bytes together; its length is the depth. Bytes are summed by cells of a few bits more
    than an even split would need and rolled up to every prefix, so the directory is found from sums
    alone; what is still too large goes on with eight bits more, alone. The hash is of id and text,
    so only rows equal in both share all bits: where these exceed the limit they are counted
    off into chunks that fit, numbered after a dot. A text longer than the limit is alone in its
    shard and marked oversize. Null text has 0 bytes, null ids are equal, an empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    name = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit("/"), F.md5(text))
    sized = durable(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.conv(F.substring(F.md5(name), 1, BITS // 4), 16, 10).cast("long").alias("hash"),
        ),
        "sizes",
    )
    total = sized.agg(F.sum("n_bytes")).first()[0] or 0
    done, pending, low = [], sized, 0
    high = min(BITS, max(1, math.ceil(math.log2(max(2, total / limit_bytes)))) + 3)
    while True:
        cell = F.shiftright("hash", BITS - high)
        cells = pending.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"))
        prefix = F.expr(f"shiftright(cell, cast({high} - depth AS int))")
        rolled = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high))))
        rolled = rolled.groupBy("depth", prefix.alias("prefix")).agg(F.sum("bytes").alias("shard_bytes"), F.sum("n").alias("shard_rows"))
        # Sums only grow towards the root, so a cell's shard is the shallowest of its prefixes that fits.
        chosen = (
            cells.select("cell").withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn("prefix", prefix)
            .join(rolled, ["depth", "prefix"]).where(F.col("shard_bytes") <= limit_bytes)
            .groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("x")).select("cell", "x.*")
        )
        chosen = F.broadcast(chosen) if 1 << high <= broadcast_cells else chosen
        placed = pending.withColumn("cell", cell).join(chosen, "cell", "left").drop("cell")
        done.append(placed.where("depth is not null"))
        rest = placed.where("depth is null").select("doc_id", "n_bytes", "hash")
        if high == BITS or rest.isEmpty():
            break
        pending, low, high = durable(rest, "oversize"), high + 1, min(BITS, high + 8)
    fitted = done[0]
    for more in done[1:]:
        fitted = fitted.unionByName(more)
    shard = F.expr("lpad(conv(prefix, 10, 2), depth, '0')")
    out = fitted.select("doc_id", "n_bytes", shard.alias("shard"), F.col("depth").cast("int").alias("depth"), "shard_bytes", "shard_rows", F.lit(False).alias("oversize"))
    each = F.greatest(F.lit(1), F.expr(f"{int(limit_bytes)} div greatest(n_bytes, 1)"))
    nth = F.row_number().over(W.partitionBy("hash").orderBy("doc_id")) - 1
    chunks = rest.withColumn("each", each).withColumn("chunk", F.floor(nth / F.col("each")))
    held = F.count(F.lit(1)).over(W.partitionBy("hash", "chunk"))
    equal = chunks.withColumn("shard_rows", held).select(
        "doc_id", "n_bytes", F.expr(f"concat(lpad(conv(hash, 10, 2), {BITS}, '0'), '.', chunk)").alias("shard"), F.lit(BITS).alias("depth"),
        (F.col("shard_rows") * F.col("n_bytes")).alias("shard_bytes"), "shard_rows", (F.col("n_bytes") > limit_bytes).alias("oversize"),
    )
    return out.unionByName(equal)


def shard_sql(limit_bytes: int) -> str:
    return f"""
WITH h AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes,
                  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/' || md5(coalesce(text, ''))), 1, {BITS // 4}) AS BIGINT) AS hash FROM documents),
d AS (SELECT unnest(range({BITS + 1})) AS depth),
p AS (SELECT depth, hash >> CAST({BITS} - depth AS INT) AS prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_rows
      FROM h, d GROUP BY ALL HAVING sum(n_bytes) <= {limit_bytes}),
b AS (SELECT hash, min(p.depth) AS depth FROM (SELECT DISTINCT hash FROM h) x, d JOIN p ON p.depth = d.depth AND p.prefix = x.hash >> CAST({BITS} - d.depth AS INT) GROUP BY hash),
c AS (SELECT h.*, b.depth AS fit, floor((row_number() OVER (PARTITION BY h.hash ORDER BY doc_id) - 1) / greatest(1, {limit_bytes} // greatest(n_bytes, 1))) AS chunk
      FROM h LEFT JOIN b ON h.hash = b.hash)
SELECT doc_id, n_bytes, CASE WHEN fit IS NULL THEN lpad(bin(c.hash), {BITS}, '0') || '.' || CAST(CAST(chunk AS BIGINT) AS VARCHAR)
                             ELSE lpad(bin(prefix), CAST(fit AS INT), '0') END AS shard,
       CAST(coalesce(fit, {BITS}) AS INT) AS depth,
       CASE WHEN fit IS NULL THEN n_bytes * count(*) OVER (PARTITION BY c.hash, chunk) ELSE shard_bytes END AS shard_bytes,
       CASE WHEN fit IS NULL THEN count(*) OVER (PARTITION BY c.hash, chunk) ELSE shard_rows END AS shard_rows,
       fit IS NULL AND n_bytes > {limit_bytes} AS oversize
FROM c LEFT JOIN p ON p.depth = fit AND p.prefix = c.hash >> CAST({BITS} - fit AS INT)
"""
