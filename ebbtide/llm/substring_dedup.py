"""Substring dedup by suffix arrays of groups that share a prefix.

Words of which 50 in a row also start in a document with a smaller id are removed. Only suffixes that can repeat
are entered: of each window of 50 words, its eight-word gram with the least hash is the key under which the window
is filed (a sample of the suffixes, and not the first words of each), and consecutive windows with the same one make
a row that carries their words once. Equal windows have equal keys, so a key seen in one document only is not moved,
and those that occur in several split the suffixes into groups that fit in memory. A group's suffixes are sorted
into a suffix array with the common prefixes of neighbours; runs of neighbours that share 50 words are the deep
internal nodes of its suffix tree, and stretches of such windows are maximal repeats. A key with too many windows is
made longer, to all 50 words of each: then a node is a row per distinct window, known by 128 bits of its words and
combined before the shuffle.

Whole copies are found first, by the hash of all words, and enter no tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegralType

from ebbtide.session import materialise

from .common import bounded_batches, text_of, travels

WINDOW = 50
GRAM = 8
#: Suffixes under one prefix beyond which the prefix is made longer.
CROWDED = 20_000
#: Words that a task sorts at once.
BLOCK = 1 << 18
#: Windows that a task hands on at once.
HANDED = 1 << 16
NOTHING = hashlib.sha256(b"").hexdigest()
_LAST = (1 << 63) - 1
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class WordHashes(dict):
    """word -> 64-bit hash. Nothing is kept: hashing a word takes less than finding it in a large table."""

    def __missing__(self, word: bytes) -> int:
        return xxhash.xxh64_intdigest(word)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(_ODD[1])
    return values ^ (values >> np.uint64(29))


def _rolled(hashes: np.ndarray, width: int, odd: int) -> np.ndarray:
    """A hash of each run of ``width`` words."""
    out = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for j in range(width):
        out = out * np.uint64(odd) + hashes[j : j + len(out)]
    return _mixed(out)


def prefixes(words: list[bytes], known: WordHashes | None = None, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """For each window its prefix: the least hash among the grams in it, as a signed number."""
    if len(words) < window:
        return np.zeros(0, dtype=np.int64)
    hash_of = xxhash.xxh64_intdigest if known is None else known.__getitem__
    hashes = np.fromiter(map(hash_of, words), dtype=np.uint64, count=len(words))
    least, width, span = _rolled(hashes, gram, _ODD[0]), 1, window - gram + 1
    while 2 * width <= span:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width:])
    return least.view(np.int64)


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of equal values."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.concatenate([[0], cuts]), np.concatenate([cuts - 1, [len(values) - 1]])


def described(docs: DataFrame, window: int) -> DataFrame:
    """place (order of documents), mark (of the text), n_words, kept_sha256 and the prefixes of each row, stored.

    ``windows`` are the numbers of windows under each of ``prefixes``.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["text"]:
                words = text.encode().split()
                found = prefixes(words, window=window)
                out.append((len(words), hashlib.sha256(b" ".join(words)).hexdigest(),
                            *np.unique(found, return_counts=True)))
            made = pd.DataFrame(out, columns=["n_words", "kept_sha256", "prefixes", "windows"])
            yield pd.concat([batch.drop(columns="text"), made], axis=1)

    return materialise(docs.mapInPandas(
        rows, "place long, mark long, missing boolean, n_words long, kept_sha256 string, prefixes array<long>, "
        "windows array<long>"), "described")


def shared_prefixes(filed: DataFrame, crowded: int) -> DataFrame:
    """prefix and crowded of the prefixes in several places, from rows (place, prefix, windows)."""
    found = filed.groupBy("prefix").agg(
        F.min("place").alias("least"), F.max("place").alias("most"), F.sum("windows").alias("n")).filter("least < most")
    return found.select("prefix", (F.col("n") > crowded).alias("crowded"))


def suffix_array(words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes sorted by their first ``depth`` words, and what each shares with the one before it.

    ``words`` are numbers; common prefixes count up to ``depth``. Suffixes are ranked by 1, 2, 4 ... words.
    """
    n = len(words)
    ranks, spans = [words], [1]
    while spans[-1] < depth:
        by = min(spans[-1], depth - spans[-1])
        after = np.full(n, -1, dtype=np.int64)
        after[: n - by] = ranks[-1][by:]
        ranks.append(np.unique(ranks[-1] * (int(ranks[-1].max()) + 2) + after + 1, return_inverse=True)[1].astype(np.int64))
        spans.append(spans[-1] + by)
    order = np.argsort(ranks[-1], kind="stable")
    common = np.zeros(n, dtype=np.int64)
    one, two = order[:-1], order[1:]
    same = ranks[-1][one] == ranks[-1][two]
    common[1:][same] = depth
    # the others differ within depth: add up the largest spans that agree
    left = np.flatnonzero(~same)
    shared = np.zeros(len(left), dtype=np.int64)
    for level in range(len(ranks) - 2, -1, -1):
        i, j = one[left] + shared, two[left] + shared
        inside = np.maximum(i, j) + spans[level] <= n
        agree = inside & (ranks[level][np.where(inside, i, 0)] == ranks[level][np.where(inside, j, 0)])
        shared += agree * spans[level]
    common[1:][left] = np.minimum(shared, depth - 1)
    return order, common


def repeats(texts: list[str], places: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """(row, first word, word after the last) of what also starts in a row of a smaller place.

    Runs of the suffix array with ``window`` words in common are nodes, each with the smallest place it is seen in.
    """
    split = [t.split(" ") for t in texts]
    sizes = np.array([len(s) for s in split])
    ends = np.cumsum(sizes)
    words = pd.factorize(np.array([w for s in split for w in s], dtype=object))[0].astype(np.int64)
    del split
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words)) - (ends - sizes)[row]
    if not (at + window <= sizes[row]).any():
        return []
    order, common = suffix_array(words, window)
    node = np.empty(len(words), dtype=np.int64)
    node[order] = np.cumsum(common < window)
    # suffixes that leave their row are in no window
    whole = np.flatnonzero(at + window <= sizes[row])
    node = node[whole]
    least = np.full(node.max() + 1, _LAST, dtype=np.int64)
    np.minimum.at(least, node, places[row[whole]])
    taken = whole[places[row[whole]] > least[node]]
    if not len(taken):
        return []
    # windows that touch or overlap make one stretch
    new = np.concatenate([[True], (row[taken[1:]] != row[taken[:-1]]) | (taken[1:] - taken[:-1] > window)])
    first = taken[new]
    last = taken[np.concatenate([new[1:], [True]])]
    return [(int(r), int(a), int(b) + window) for r, a, b in zip(row[first], at[first], at[last])]


def _grow(window: int):
    """Rows sorted by prefix -> stretches, group by group, a block of words at a time."""

    def settle(held: list[pd.DataFrame]) -> pd.DataFrame:
        block = pd.concat(held, ignore_index=True)
        found = repeats(block["words"].tolist(), block["place"].to_numpy(), window)
        rows = block.iloc[[r for r, _, _ in found]]
        return pd.DataFrame({
            "place": rows["place"].to_numpy(), "mark": rows["mark"].to_numpy(),
            "start": rows["start"].to_numpy() + np.array([a for _, a, _ in found], dtype=np.int64),
            "stop": rows["start"].to_numpy() + np.array([b for _, _, b in found], dtype=np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            lengths = batch["words"].str.count(" ").to_numpy() + 1
            if size + lengths.sum() > BLOCK and held:
                # the block ends with a group, which may go on into this batch
                same = int((batch["prefix"] == held[-1]["prefix"].iloc[-1]).sum())
                if same < len(batch):
                    yield settle([*held, batch.iloc[:same]])
                    held, size = [], 0
                    batch, lengths = batch.iloc[same:], lengths[same:]
            held.append(batch)
            size += int(lengths.sum())
        if held:
            yield settle(held)

    return run


def suffixes(candidates: DataFrame, window: int) -> DataFrame:
    """Stored rows of two kinds, by ``crowded``, for the windows under shared keys.

    A run of windows under one key is a row (prefix, place, mark, start, words). Under a crowded key each window is a
    row (one, two, place, mark, start), known by 128 bits of its words.
    """
    columns = ["crowded", "prefix", "one", "two", "place", "mark", "start", "words"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, each, held = [], [], 0
            for place, mark, text, shared in zip(batch["place"], batch["mark"], batch["text"], batch["shared"]):
                words = text.encode().split()
                found = prefixes(words, window=window)
                wanted = {s["prefix"]: s["crowded"] for s in shared}
                joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
                for a, b in zip(*runs(found)):
                    key = int(found[a])
                    if key not in wanted:
                        continue
                    if not wanted[key]:
                        out.append((False, key, None, None, place, mark, int(a), b" ".join(words[a : b + window]).decode()))
                        continue
                    for at in range(a, b + 1, HANDED):
                        last = min(at + HANDED, b + 1)
                        first = np.concatenate([[0], ends])[at:last].tolist()
                        names = b"".join([xxhash.xxh3_128_digest(joined[x : y - 1])
                                          for x, y in zip(first, ends[at + window - 1 : last + window - 1].tolist())])
                        one, two = np.frombuffer(names, dtype="<i8").reshape(-1, 2).T
                        each.append(pd.DataFrame({"crowded": True, "prefix": None, "one": one, "two": two, "place": place,
                                                  "mark": mark, "start": np.arange(at, last), "words": None}))
                        held += last - at
                        if held >= HANDED:
                            yield pd.concat(each, ignore_index=True)
                            each, held = [], 0
            if each:
                yield pd.concat(each, ignore_index=True)
            yield pd.DataFrame(out, columns=columns)

    return materialise(candidates.mapInPandas(
        rows, "crowded boolean, prefix long, one long, two long, place long, mark long, start long, words string"), "suffixes", ("crowded",))


def places(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with ``place``, a number that sorts like doc_id, null last; and the stored (doc_id, place), if numbered.

    Whole numbers are their own place. Ids of other types, or up to the largest number, are numbered in order,
    range by range.
    """
    kind = docs.schema["doc_id"].dataType
    if isinstance(kind, IntegralType) and docs.agg(F.max("doc_id")).first()[0] != _LAST:
        return docs.withColumn("place", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))), None
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct().repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    numbered = materialise(ids.withColumn("place", F.monotonically_increasing_id()), "places")
    return docs.join(numbered, "doc_id", "left").withColumn("place", F.coalesce("place", F.lit(_LAST))), numbered


def shortened(candidates: DataFrame) -> DataFrame:
    """n_removed and the hash of the words that remain, from texts with their stretches."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, stretches in zip(batch["text"], batch["stretches"]):
                words = text.encode().split()
                keep = np.ones(len(words), dtype=bool)
                for s in stretches:
                    keep[s["start"] : s["stop"]] = False
                left = b" ".join([w for w, k in zip(words, keep) if k])
                out.append((int((~keep).sum()), left.decode()))
            made = pd.DataFrame(out, columns=["n_removed", "kept_text"])
            yield pd.concat([batch[["place", "mark"]], made], axis=1)

    return candidates.mapInPandas(rows, "place long, mark long, n_removed long, kept_text string")


def deduplicate(docs: DataFrame, window: int = WINDOW, crowded: int = CROWDED, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``; with ``texts`` also kept_text.

    kept_text holds the remaining words joined by a space; it is null where nothing is removed, so that only
    changed texts move. Null and empty texts, and texts under ``window`` words, lose nothing. Rows that share a
    doc_id are one document: they don't shorten each other. A null doc_id comes after all others, such rows don't
    shorten each other either. Ids may be of any type that sorts. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    # rows are known by place and text: equal ones have equal results
    given, numbered = places(docs.select("doc_id", "text"))
    named = given.select("place", F.xxhash64(text_of()).alias("mark"), text_of().alias("text"),
                        F.col("doc_id").isNull().alias("missing"))
    every = described(named.select("place", "mark", "missing", "text"), window)
    firsts = materialise(every.filter(F.col("n_words") >= window).groupBy("kept_sha256").agg(
        F.min("place").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"), "firsts")
    every = materialise(every.join(firsts, "kept_sha256", "left").withColumn(
        "copy", F.coalesce(F.col("first") < F.col("place"), F.lit(False))).drop("first"), "copies")

    filed = every.filter(~F.col("copy")).select("place", "mark", F.inline(F.arrays_zip(
        F.col("prefixes").alias("prefix"), F.col("windows").alias("windows"))))
    filed = filed.toDF("place", "mark", "prefix", "windows")
    shared = materialise(shared_prefixes(filed, crowded), "shared")
    hits = filed.drop("windows").join(shared, "prefix").distinct().groupBy("place", "mark").agg(
        F.collect_list(F.struct("prefix", "crowded")).alias("shared"))
    candidates = materialise(named.select("place", "mark", "text").join(
        materialise(hits, "hits"), ["place", "mark"]).dropDuplicates(["place", "mark"]), "candidates")

    entered = suffixes(candidates, window)
    apart = entered.filter(~F.col("crowded")).select("prefix", "place", "mark", "start", "words")
    grown = apart.repartition("prefix").sortWithinPartitions("prefix").mapInPandas(
        _grow(window), "place long, mark long, start long, stop long")
    if shared.filter("crowded").take(1):
        each = entered.filter("crowded").select("one", "two", "place", "mark", "start")
        seen = materialise(each.groupBy("one", "two").agg(F.min("place").alias("least"), F.max("place").alias("most"))
                           .filter("least < most").drop("most"), "seen")
        grown = grown.unionByName(each.join(seen, ["one", "two"]).filter("place > least").select(
            "place", "mark", "start", (F.col("start") + window).alias("stop")))
    stretches = materialise(grown.groupBy("place", "mark").agg(
        F.collect_set(F.struct("start", "stop")).alias("stretches")), "stretches")

    changed = shortened(candidates.join(stretches, ["place", "mark"]).select("place", "mark", "text", "stretches"))
    changed = changed.withColumn("changed_sha256", F.sha2(F.encode("kept_text", "UTF-8"), 256))
    if not texts:
        changed = changed.drop("kept_text")
    found = every.drop("prefixes", "windows").join(materialise(changed, "changed"), ["place", "mark"], "left")
    kept = [F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if texts else []
    if numbered is None:
        found = found.withColumn("doc_id", F.when(~F.col("missing"), F.col("place")).cast(docs.schema["doc_id"].dataType))
    else:
        found = found.join(numbered, "place", "left")
    return found.select(
        "doc_id", "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(NOTHING)).otherwise(F.coalesce("changed_sha256", "kept_sha256")).alias("kept_sha256"),
        *kept)


travels(__name__)
