"""Exact dedup by composable polynomial fingerprints.

A text is cut into chunks of bytes. A chunk ``b`` that ends ``e`` bytes before the end of its text adds
``B**e * sum(b[i] * B**(len(b) - 1 - i))`` modulo a prime; the sum over the chunks is the polynomial
fingerprint of the whole text, so chunks can be hashed anywhere, in any order. Two primes below 2**31 make 62
bits; together with the length they form the key of a group. Groups of several rows are then compared chunk by chunk: the
smallest and the largest content of each chunk position must agree. Both are plain aggregates, combined before
the shuffle, so a group of any size costs one row per map task and chunk, and no task ever holds a group or a
whole huge text. Members of a group whose chunks disagree (a collision) are told apart by SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ebbtide.session import materialise

from .common import ROW, likely, stored_rows, text_of, travels

CHUNK = 1 << 16
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 69_069_069)


def chunk_hash(chunk: bytes, after: int, prime: int, base: int, powers: np.ndarray) -> int:
    """What a chunk adds to the fingerprint of a text that goes on for ``after`` bytes."""
    if not chunk:
        return 0
    # 1..256 times a power below 2**31, at most 2**16 of them: the sum stays below 2**56
    symbols = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    inside = int(symbols @ powers[: len(chunk)][::-1]) % prime
    return inside * pow(base, after, prime) % prime


def power_tables(size: int) -> list[np.ndarray]:
    tables = []
    for prime, base in zip(PRIMES, BASES):
        table = np.ones(size, dtype=np.uint64)
        for i in range(1, size):
            table[i] = int(table[i - 1]) * base % prime
        tables.append(table)
    return tables


def hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Appends h1, h2 to rows with ``chunk`` and ``after``."""
    tables = power_tables(CHUNK)
    for batch in batches:
        chunks, after = batch.column("chunk").to_pylist(), batch.column("after").to_pylist()
        columns = list(batch.columns)
        for prime, base, powers in zip(PRIMES, BASES, tables):
            columns.append(pa.array([chunk_hash(c, a, prime, base, powers) for c, a in zip(chunks, after)], pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "h1", "h2"])


def chunks(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per chunk with its part of the fingerprint; an empty text has one empty chunk.

    Chunks are cut on bytes, where a substring starts in constant time, so a huge text is read once.
    """
    cut = rows.select(ROW, *columns, F.encode(text_of(), "UTF-8").alias("bytes")).withColumn(
        "n_bytes", F.octet_length("bytes").cast("long"))
    last = F.greatest(F.lit(0), F.floor((F.col("n_bytes") - 1) / CHUNK)).cast("int")
    cut = cut.select(ROW, *columns, "bytes", "n_bytes", F.explode(F.sequence(F.lit(0), last)).alias("position"))
    start = F.col("position") * F.lit(CHUNK) + 1
    cut = cut.select(
        ROW, *columns, "n_bytes", "position",
        F.substring("bytes", start, F.lit(CHUNK)).alias("chunk"),
        F.greatest(F.lit(0), F.col("n_bytes") - (F.col("position") + 1) * F.lit(CHUNK)).cast("long").alias("after"),
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return cut.mapInArrow(hash_chunks, f"{fields}, h1 long, h2 long")


def by_length(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of one chunk, and of several. They part before they are hashed, so that each chunk is hashed once."""
    short = F.octet_length(text_of()) <= CHUNK
    return rows.filter(short), rows.filter(~short)


def fingerprints(rows: DataFrame, *columns: str) -> DataFrame:
    """The fingerprints of whole texts from those of their chunks; only texts of several chunks are shuffled."""
    keys = [ROW, *columns, "n_bytes"]
    one, many = (chunks(part, *columns).drop("chunk") for part in by_length(rows))
    return one.select(*keys, F.col("h1").alias("f1"), F.col("h2").alias("f2")).unionByName(many.groupBy(*keys).agg(
        (F.sum("h1") % PRIMES[0]).alias("f1"), (F.sum("h2") % PRIMES[1]).alias("f2")))


def colliding(rows: DataFrame, prints: DataFrame) -> DataFrame:
    """Keys (f1, f2, n_bytes) under which different texts meet, by comparing chunk after chunk.

    Only texts whose key some other row has too are read again, and the few that the map of those rows lets through
    beside them.
    """
    key = ["f1", "f2", "n_bytes"]
    again = materialise(prints.groupBy(*key).count().filter("count > 1").select(key), "repeated")
    # stored, so that Spark can split a hot key
    again = materialise(prints.select(ROW, *key).join(again, key, "left_semi"), "again")
    short, long = by_length(likely(rows, F.col(ROW), again.select(ROW), "_near").filter("_near"))
    one = chunks(short).withColumnsRenamed({"h1": "f1", "h2": "f2"})
    many = chunks(long).drop("h1", "h2").join(again.filter(F.col("n_bytes") > CHUNK).select(ROW, "f1", "f2"), ROW)
    columns = ["f1", "f2", "n_bytes", "position", "chunk"]
    compared = one.select(columns).unionByName(many.select(columns)).groupBy("f1", "f2", "n_bytes", "position").agg(
        F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    return compared.filter(F.col("least") != F.col("most")).select("f1", "f2", "n_bytes").distinct()


def exact_groups(rows: DataFrame) -> DataFrame:
    """One row per row of ``rows``: doc_id, keep_id, group_size, kept, text_sha256 and the row id.

    ``rows`` comes from ``stored_rows``. Texts are equal when identical byte for byte; null counts as empty.
    The row with the largest doc_id stays, null being smaller than any; among repeated rows of that doc_id
    exactly one stays. Other columns are not looked at. No rows give no rows.
    """
    named = rows.select(ROW, "doc_id", "text", F.sha2(F.encode(text_of(), "UTF-8"), 256).alias("text_sha256"))
    prints = materialise(fingerprints(named, "doc_id", "text_sha256"), "fingerprints")
    key = ["f1", "f2", "n_bytes"]
    # stored, like the groups below, so that the join reads two plain shuffles, of which Spark can split a hot key
    apart = materialise(colliding(rows, prints), "collisions").withColumn("apart", F.lit(True))
    prints = prints.join(apart, key, "left").withColumn(
        "told", F.when(F.col("apart"), F.col("text_sha256")).otherwise(F.lit(""))).drop("apart")
    prints = materialise(prints, "classes")
    key.append("told")
    groups = prints.groupBy(*key).agg(
        F.max(F.struct("doc_id", ROW)).alias("keep"), F.count("*").alias("group_size"))
    groups = materialise(groups.filter("group_size > 1"), "groups")
    found = prints.join(groups, key, "left")
    return found.select(
        ROW, "doc_id",
        F.when(F.col("keep").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("keep").isNull() | (F.col(f"keep.{ROW}") == F.col(ROW))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` drops; all columns stay."""
    rows = stored_rows(docs, "documents")
    gone = exact_groups(rows).filter(~F.col("kept")).select(ROW)
    return rows.join(materialise(gone, "dropped"), ROW, "left_anti").drop(ROW)


travels(__name__)
