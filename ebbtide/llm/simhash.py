"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a common variant that differs from each in at most
half of them; so every distinct fingerprint emits all such variants (2,081 for a radius of 4), and fingerprints
that share a variant are linked. Variants of one fingerprint share their leading bits with few others: what is
shuffled is the fingerprint once per variant of its leading bits (about a hundred rows), and the variants of the
remaining bits are made where these rows arrive, in blocks of bounded size. Leading bits that too many
fingerprints share are not held by one task; their variants are shuffled in full and combined by Spark.

All members of a variant's bucket lie within the radius of each other, so a star around the smallest member
keeps every component whole without emitting pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from ebbtide.session import materialise

from .common import ROW, bounded_batches, stored_rows, text_of, travels
from .components import components

WORDS = 4
RADIUS = 4
SEED = 42
#: Variants that a task makes at once, and half of those that a partition is planned for.
BLOCK = 1 << 21
#: Partitions at most; a larger input has larger ones, which are read block by block.
PARTITIONS = 50_000
#: Variants under the same leading bits beyond which they are shuffled one by one: a task holds no more at once.
HOT = 4 * BLOCK


def fingerprint(text: str, n: int = WORDS) -> int:
    """The 64-bit fingerprint of a text, as a signed number; zero for a text without words."""
    # bytes.lower folds A-Z alone and bytes.split cuts at \x20 and \x09-\x0D alone
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    n = min(n, len(words))
    starts, stops = [0, *ends], ends[n - 1:]
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(stops), 1 << 16):
        hashes = [xxhash.xxh64_intdigest(joined[a : b - 1], SEED)
                  for a, b in zip(starts[at : at + (1 << 16)], stops[at : at + (1 << 16)])]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(stops), bitorder="little").view("<i8")[0])


def fingerprints(text: Column, n: int = WORDS) -> Column:
    @F.pandas_udf(LongType())
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, n) for t in texts], dtype="int64")

    return column(text)


def masks(bits: int, most: int) -> list[int]:
    """All numbers of ``bits`` bits with at most ``most`` of them set."""
    return [sum(1 << b for b in chosen) for k in range(most + 1) for chosen in combinations(range(bits), k)]


def links_of_block(prefix: np.ndarray, prints: np.ndarray, lead: int, half: int) -> pd.DataFrame:
    """Links among fingerprints that meet in a variant with one of the given leading bits.

    ``prefix`` holds variants of the leading bits; what is left of ``half`` is spent on the other bits.
    """
    rest = 64 - lead
    tops = prints >> np.uint64(rest) if lead else np.zeros_like(prints)
    spent = np.bitwise_count(prefix ^ tops).astype(int)
    variants, owners = [], []
    for used in range(half + 1):
        own = prints[spent == used]
        if not len(own):
            continue
        low = np.array(masks(rest, half - used), dtype=np.uint64)
        # the leading bits are those of the variant, the others those of the fingerprint, then flipped
        shift = np.uint64(rest)
        base = (prefix[spent == used] << shift) | (own & ((np.uint64(1) << shift) - np.uint64(1)))
        variants.append((base[:, None] ^ low[None, :]).ravel())
        owners.append(np.repeat(own, len(low)))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variants)
    variants, owners = variants[order], owners[order]
    same = variants[1:] == variants[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    variants, owners = variants[shared], owners[shared].view(np.int64)
    if not len(owners):
        return pd.DataFrame({"u": owners, "v": owners})
    first = np.concatenate([[True], variants[1:] != variants[:-1]])
    hubs = np.minimum.reduceat(owners, np.flatnonzero(first))[np.cumsum(first) - 1]
    links = pd.DataFrame({"u": owners[owners != hubs], "v": hubs[owners != hubs]}).drop_duplicates()
    close = np.bitwise_count(links["u"].to_numpy().view(np.uint64) ^ links["v"].to_numpy().view(np.uint64))
    return links[close <= 2 * half]


def _meet(lead: int, half: int):
    """Rows sorted by prefix -> links, from whole prefixes that together make about a block of variants."""
    rest = 64 - lead
    width = np.array([sum(math.comb(rest, k) for k in range(half - used + 1)) for used in range(half + 1)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, made = [], 0
        for batch in batches:
            if not len(batch):
                continue
            prefix, prints = (batch[c].to_numpy().view(np.uint64) for c in ("prefix", "fingerprint"))
            if made > BLOCK:
                # the last prefix may go on in the next batch
                last = int(np.searchsorted(prefix, prefix[-1]))
                if last or held[-1][0][-1] != prefix[0]:
                    held.append((prefix[:last], prints[:last]))
                    yield links_of_block(*map(np.concatenate, zip(*held)), lead, half)
                    held, made, prefix, prints = [], 0, prefix[last:], prints[last:]
            held.append((prefix, prints))
            made += int(width[np.bitwise_count(prefix ^ (prints >> np.uint64(rest))).astype(int)].sum())
        if held:
            yield links_of_block(*map(np.concatenate, zip(*held)), lead, half)

    return run


def _variants(of: Column, width: int, most: int) -> Column:
    """An array of numbers that differ from the low ``width`` bits of ``of`` in at most ``most``."""
    flips = F.array(*[F.lit(m).cast("long") for m in masks(width, most)])
    return F.transform(flips, lambda m: of.bitwiseXOR(m))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect all distinct ``fingerprint`` values within ``radius`` bits of each other.

    Pairs at most ``radius`` apart end up in one component, and no link spans more. Few leading bits suffice
    for few fingerprints; their number follows from the count.
    """
    distinct = materialise(prints.select("fingerprint").distinct(), "distinct")
    n = distinct.count()
    # an odd radius splits into unequal halves; the larger one is verified against the radius
    half = (radius + 1) // 2
    lead = min(40, max(8, math.ceil(math.log2(max(n, 2))) - 4))
    top = F.shiftrightunsigned("fingerprint", 64 - lead)
    spread = distinct.select("fingerprint", F.explode(_variants(top, lead, half)).alias("prefix"))
    # variants of the remaining bits that a row makes, by what its leading bits have spent
    widths = F.array(*[F.lit(sum(math.comb(64 - lead, k) for k in range(half - used + 1))).cast("long")
                       for used in range(half + 1)])
    spent = F.bit_count(F.col("prefix").bitwiseXOR(top))
    made = spread.groupBy("prefix").agg(F.sum(F.get(widths, spent)).alias("made"))
    hot = materialise(made.filter(F.col("made") > HOT).select("prefix"), "hot")
    total = n * sum(math.comb(64, k) for k in range(half + 1))
    parts = min(PARTITIONS, max(1, math.ceil(total / (2 * BLOCK))))
    cold = spread.join(hot, "prefix", "left_anti").repartition(parts, "prefix").sortWithinPartitions("prefix")
    found = cold.mapInPandas(_meet(lead, half), "u long, v long")
    if hot.take(1):
        found = found.unionByName(_hot_links(spread.join(hot, "prefix", "left_semi"), lead, half))
    if radius % 2:
        found = found.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    return found.distinct()


def _hot_links(rows: DataFrame, lead: int, half: int) -> DataFrame:
    """Links under leading bits that very many fingerprints share: one shuffled row per variant."""
    rest = 64 - lead
    top = F.shiftrightunsigned("fingerprint", rest)
    spent = F.bit_count(F.col("prefix").bitwiseXOR(top))
    base = F.shiftleft("prefix", rest).bitwiseOR(F.col("fingerprint").bitwiseAND((1 << rest) - 1))
    made = None
    for used in range(half + 1):
        part = rows.filter(spent == used).select("fingerprint", F.explode(_variants(base, rest, half - used)).alias("variant"))
        made = part if made is None else made.unionByName(part)
    hubs = materialise(made.groupBy("variant").agg(F.min("fingerprint").alias("v"), F.count("*").alias("n"))
                       .filter("n > 1").drop("n"), "hubs")
    return made.join(hubs, "variant").select(F.col("fingerprint").alias("u"), "v").filter("u <> v")


def near_groups(rows: DataFrame, n: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """Row id, doc_id, fingerprint, component_id and kept for every row of ``rows``.

    ``rows`` has the row id, doc_id and text. Null and empty texts have fingerprint zero and link like others.
    component_id is the smallest doc_id within reach (null only if all are); one row of each component is kept,
    that of the smallest doc_id, null last, exactly one if rows repeat. No rows give no rows.
    """
    bounded_batches(rows.sparkSession)
    prints = materialise(rows.select(ROW, "doc_id", fingerprints(text_of(), n).alias("fingerprint")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", ROW)).alias("first")
    roots = components(links(prints, radius)).withColumnRenamed("node", "fingerprint")
    nodes = materialise(prints.groupBy("fingerprint").agg(first), "nodes")
    linked = materialise(nodes.join(materialise(roots, "roots"), "fingerprint"), "linked")
    heads = materialise(linked.groupBy("root").agg(F.min("first").alias("head")), "heads")
    linked = linked.join(heads, "root").select("fingerprint", "head")
    alone = nodes.join(linked.select("fingerprint"), "fingerprint", "left_anti").select(
        "fingerprint", F.col("first").alias("head"))
    every = materialise(linked.unionByName(alone), "components")
    return prints.join(every, "fingerprint").select(
        ROW, "doc_id", "fingerprint", F.col("head.doc_id").alias("component_id"),
        (F.col(f"head.{ROW}") == F.col(ROW)).alias("kept"))


def keep_one(docs: DataFrame, n: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group of near copies; all columns stay."""
    rows = stored_rows(docs, "documents")
    gone = near_groups(rows, n, radius).filter(~F.col("kept")).select(ROW)
    return rows.join(materialise(gone, "dropped"), ROW, "left_anti").drop(ROW)


travels(__name__)
