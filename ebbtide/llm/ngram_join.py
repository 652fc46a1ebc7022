"""Similarity join of documents on word shingles: a grouped prefix join.

Two sets whose Jaccard similarity reaches the threshold share one of their first shingles, in any order that is the
same for all sets. Here rare shingles come first: a count per hash bucket tells the frequent ones. Equal sets are
one class; classes whose prefixes and sizes are the same form one group, and only groups are listed under the
shingles of their prefixes. Groups that meet are filtered by size and place in the prefix, then expanded into members,
which are filtered by the parities of their shingles in a bit map: bits that differ are a lower bound of shingles
that differ. Short maps travel with the prefixes, whole ones with the pairs these let through. What passes is verified
on the words.

Components need no list of all pairs. In the first round each member asks for the earliest member it may link with;
in the second all pairs that pass and are not yet connected are asked for, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ebbtide.session import materialise

from .common import ROW, bounded_batches, text_of, travels
from .components import components

WORDS = 3
#: A link needs NUM hundredths of similarity.
NUM = 90
#: Counters of the frequency sketch and bits of the map of wanted classes; both are of this size for any corpus.
BUCKETS = 1 << 18
WANTED = 1 << 23
#: Parity bits of a set: the power of two that is over this many times its size, at least LEAST_BITS.
BITS = 2
LEAST_BITS = 256
#: Members listed under one shingle beyond which they are dealt to several tasks, and members of a row of a group.
CROWDED = 4096
MEMBERS = 64
#: Rows of prefixes that a task compares at once, unless one shingle has more.
BLOCK = 1 << 15
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def words_of(text: str) -> list[bytes]:
    # bytes.lower folds A-Z alone and bytes.split cuts at \x20 and \x09-\x0D alone
    return text.encode().lower().split()


def _stirred(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


def shingle_set(words: list[bytes], n: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles, sorted; all words are one shingle if they are fewer than ``n``."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    n = min(n, len(words))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    out, odd = np.full(len(words) - n + 1, n, dtype=np.uint64), np.uint64(1)
    for k in range(n):
        odd *= _ODD[k % 3]
        out += hashes[k : k + len(out)] * odd
    out = np.sort(_stirred(out))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def name_of(found: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed numbers."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), dtype="<i8").tolist())


def prefix_length(size, num: int = NUM):
    return size - (-(-num * size // 100)) + 1


def overlap(one, two, num: int = NUM):
    """The least number of common shingles of sets of these sizes that are similar enough."""
    return -(-num * (one + two) // (100 + num))


def width_of(size: int) -> int:
    return max(LEAST_BITS, 1 << (BITS * size - 1).bit_length())


def parities(found: np.ndarray) -> bytes:
    """For each rest of the hashes modulo the width, whether an odd number of shingles has it."""
    width = width_of(len(found))
    rests = (found & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(rests, minlength=width) & 1, bitorder="little").tobytes()


def shortened(bits: bytes) -> bytes:
    """The map of a quarter of the width, LEAST_BITS at least: halves of a map add up to the map of half its width."""
    for _ in range(2):
        if len(bits) * 8 > LEAST_BITS:
            half = np.frombuffer(bits, dtype=np.uint8).reshape(2, -1)
            bits = (half[0] ^ half[1]).tobytes()
    return bits


class BitMaps:
    """Parities of many sets. Sets of like size have widths that differ by a factor of two at most."""

    def __init__(self, maps: list[bytes]):
        widths = np.fromiter(map(len, maps), dtype=np.int64, count=len(maps))
        self.widths, self.rows, self.maps = widths, {}, {}
        for width in np.unique(widths).tolist():
            own, wider = np.flatnonzero(widths == width), np.flatnonzero(widths == 2 * width)
            table = np.frombuffer(b"".join([maps[i] for i in own]), dtype=np.uint64).reshape(len(own), width // 8)
            # halves of a wider map add up to the map of half its width
            halves = np.frombuffer(b"".join([maps[i] for i in wider]), dtype=np.uint64).reshape(len(wider), 2, width // 8)
            self.rows[width] = np.zeros(len(maps), dtype=np.int64)
            self.rows[width][np.concatenate([own, wider])] = np.arange(len(own) + len(wider))
            self.maps[width] = np.concatenate([table, halves[:, 0] ^ halves[:, 1]]) if len(wider) else table

    def differ(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair the bits that differ: no more than the shingles that do."""
        widths, out = np.minimum(self.widths[a], self.widths[b]), np.zeros(len(a), dtype=np.int64)
        for width in np.unique(widths).tolist():
            own = np.flatnonzero((widths == width) & (np.maximum(self.widths[a], self.widths[b]) <= 2 * width))
            rows, maps = self.rows[width], self.maps[width]
            out[own] = np.bitwise_count(maps[rows[a[own]]] ^ maps[rows[b[own]]]).sum(axis=1, dtype=np.int64)
        return out


def _described(docs: DataFrame, n: int) -> DataFrame:
    """Stored rows of two kinds: a document with the name of its set, and how many shingles a task has per bucket."""
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())
    of_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            sizes, names = [], []
            for text in batch["text"]:
                found = shingle_set(words_of(text), n)
                np.add.at(counts, (found >> shift).astype(np.int64), 1)
                sizes.append(len(found))
                names.append(name_of(found))
            one, two = zip(*names) if names else ((), ())
            yield batch.drop(columns="text").assign(kind="document", n=sizes, one=one, two=two)
        full = np.flatnonzero(counts)
        for at in range(0, len(full), 1 << 16):
            own = full[at : at + (1 << 16)]
            yield pd.DataFrame({"kind": "bucket", ROW: None, "doc_id": None, "mark": None, "second": None, "n": counts[own], "one": own, "two": 0})

    rows = docs.select(F.monotonically_increasing_id().alias(ROW), "doc_id", *_marks(), text_of().alias("text"))
    return materialise(rows.mapInPandas(
        run, f"kind string, {ROW} long, doc_id {of_id}, mark long, second long, n long, one long, two long"), "sets", ("kind",))


def _marks() -> list:
    """128 bits that stand for a text."""
    return [F.xxhash64(text_of()).alias("mark"), F.xxhash64(F.lit(1), text_of()).alias("second")]


def _frequency(buckets: DataFrame) -> bytes:
    """For each bucket the binary logarithm of its count: one byte each, whatever the size of the corpus."""
    out = np.zeros(BUCKETS, dtype=np.uint8)
    for bucket, n in buckets.groupBy("one").agg(F.sum("n").alias("n")).toLocalIterator():
        out[bucket] = n.bit_length()
    return out.tobytes()


def _prefixes(docs: DataFrame, frequency: bytes, n: int, num: int) -> DataFrame:
    """one, two, n, key (of group), prefix, bits and shortened bits of each distinct set."""
    shift = np.uint64(64 - (BUCKETS - 1).bit_length())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = np.frombuffer(frequency, dtype=np.uint8)
        for batch in batches:
            out, seen = [], set()
            for text in batch["text"]:
                found = shingle_set(words_of(text), n)
                name = name_of(found)
                if not len(found) or name in seen:
                    continue
                seen.add(name)
                # stable: equally frequent ones stay in the order of their hashes
                order = np.argsort(often[(found >> shift).astype(np.int64)], kind="stable")
                first = found[order[: prefix_length(len(found), num)]]
                out.append((*name, len(found), xxhash.xxh3_128_digest(first.tobytes(), seed=len(found)), first.view(np.int64), bits := parities(found), shortened(bits)))
            yield pd.DataFrame(out, columns=["one", "two", "n", "key", "prefix", "bits", "short"])

    return docs.select(text_of().alias("text")).mapInPandas(
        run, "one long, two long, n long, key binary, prefix array<long>, bits binary, short binary").dropDuplicates(["one", "two"])


def _grouped(sets: DataFrame) -> DataFrame:
    """Groups of sets of one size and prefix: part (names a row), n, prefix, members (id and shortened bits).

    A group with many members has several rows.
    """
    many = materialise(sets.groupBy("key").count().filter(F.col("count") > MEMBERS).select(
        "key", F.ceil(F.col("count") / MEMBERS).cast("int").alias("parts")), "many")
    parts = sets.join(many, "key", "left").withColumn("deal", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))))
    return parts.groupBy("key", "deal").agg(
        F.min("id").alias("part"), F.first("n").alias("n"), F.first("prefix").alias("prefix"),
        F.collect_list(F.struct("id", F.col("short").alias("bits"))).alias("members")).select("part", F.xxhash64("key").alias("key"), "n", "prefix", "members")


def candidate_pairs(rows: pd.DataFrame, num: int, stars: bool) -> pd.DataFrame:
    """Pairs (u, v) of members to verify, from rows (token, i, j, side, n, place, members, roots) sorted by (token, i, j).

    With ``stars`` each member has one pair, with the first it may link with.
    """
    lists = rows["members"].tolist()
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    flat = np.repeat(np.arange(len(rows)), sizes)
    ids = np.fromiter((m["id"] for own in lists for m in own), dtype=np.int64, count=len(flat))
    bits = [m["bits"] for own in lists for m in own]
    roots = np.fromiter((m["root"] for own in lists for m in own), dtype=np.int64, count=len(flat))
    keys = rows[["token", "i", "j"]].to_numpy()
    same = np.concatenate([[False], (keys[1:] == keys[:-1]).all(axis=1)])
    run = (np.cumsum(~same) - 1)[flat]
    n, place, side, cross = (rows[c].to_numpy()[flat] for c in ("n", "place", "side", "cross"))
    order = np.lexsort((ids, run))
    run, n, place, side, cross, ids, roots = (x[order] for x in (run, n, place, side, cross, ids, roots))
    maps = BitMaps([bits[i] for i in order])
    u, v = [], []
    best = np.full(len(ids), -1, dtype=np.int64)
    first = np.arange(len(ids))
    step = 0
    while len(first):
        step += 1
        first = first[first + step < len(ids)]
        first = first[run[first] == run[first + step]]
        if not len(first):
            break
        a, b = first, first + step
        ok = (roots[a] != roots[b]) & (~cross[a] | (side[a] != side[b])) & (ids[a] != ids[b])
        least = overlap(n[a], n[b], num)
        ok &= 100 * np.minimum(n[a], n[b]) >= num * np.maximum(n[a], n[b])
        ok &= 1 + np.minimum(n[a] - place[a], n[b] - place[b]) - 1 >= least
        a, b, least = a[ok], b[ok], least[ok]
        near = maps.differ(a, b) <= n[a] + n[b] - 2 * least
        if stars:
            # later steps reach further back
            best[b[near]] = a[near]
        else:
            u.append(ids[a[near]])
            v.append(ids[b[near]])
    if stars:
        u, v = [ids[best[best >= 0]]], [ids[best >= 0]]
    pairs = pd.DataFrame({"u": np.concatenate([np.zeros(0, np.int64), *u]), "v": np.concatenate([np.zeros(0, np.int64), *v])})
    return pairs.drop_duplicates()


def _meet(num: int, stars: bool):
    """Sorted rows -> pairs, whole shingles at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            if size > BLOCK:
                # the last shingle may go on in this batch
                last = held[-1].iloc[-1]
                here = ((batch["token"] == last["token"]) & (batch["i"] == last["i"]) & (batch["j"] == last["j"])).to_numpy()
                stop = len(batch) if here.all() else int(np.argmin(here))
                if stop < len(batch):
                    yield candidate_pairs(pd.concat([*held, batch.iloc[:stop]], ignore_index=True), num, stars)
                    held, size, batch = [], 0, batch.iloc[stop:]
            held.append(batch)
            size += len(batch)
        if held:
            yield candidate_pairs(pd.concat(held, ignore_index=True), num, stars)

    return run


def _places(groups: DataFrame, num: int) -> DataFrame:
    """Stored (token, part, n, place, count of members) of the prefixes, where another row of the token is near in size."""
    every = groups.select("part", "n", F.size("members").alias("count"), F.posexplode("prefix").alias("place", "token"))
    by_size = Window.partitionBy("token").orderBy("n", "part")
    before, after = F.lag("n").over(by_size), F.lead("n").over(by_size)
    near = (100 * before >= num * F.col("n")) | (100 * F.col("n") >= num * after)
    met = every.withColumn("near", near).filter("near").drop("near")
    # members of one group meet under a token of their own
    inside = groups.groupBy("key").agg(F.sum(F.size("members")).alias("count")).filter("count > 1").select("key")
    own = groups.join(inside, "key").select(
        "part", "n", F.size("members").alias("count"), F.lit(0).alias("place"), F.col("key").alias("token"))
    return materialise(met.unionByName(own), "places")


def _pairs(places: DataFrame, groups: DataFrame, num: int, stars: bool) -> DataFrame:
    """Stored distinct pairs (u, v) of members that may link, from the rows of ``_places`` and groups."""
    counts = materialise(places.groupBy("token").agg(F.sum("count").alias("count")).filter(F.col("count") > CROWDED).select(
        "token", F.ceil(F.col("count") / (CROWDED // 2)).cast("int").alias("parts")), "crowded")
    parts = F.coalesce("parts", F.lit(1))
    dealt = places.drop("count").join(counts, "token", "left").withColumn("side", F.pmod(F.xxhash64("part"), parts).cast("int"))
    # the rows of a crowded shingle meet in all pairs of sides
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "token", "part", "n", "place", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    rows = dealt.withColumn("cross", F.col("i") < F.col("j")).join(groups.select("part", "members"), "part")
    rows = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return materialise(rows.mapInPandas(_meet(num, stars), "u long, v long").distinct(), "pairs")


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("u").alias("id")).unionByName(pairs.select(F.col("v").alias("id"))).distinct()


def _narrowed(pairs: DataFrame, sets: DataFrame, num: int) -> DataFrame:
    """The pairs that may link by their whole bit maps, stored.

    Only shortened maps travel with the prefixes, once per shingle; whole ones meet the pairs that are left, once.
    """
    maps = materialise(sets.join(_ids(pairs), "id").select("id", "n", "bits"), "maps")
    both = pairs.join(maps.toDF("u", "one", "left"), "u").join(maps.toDF("v", "two", "right"), "v")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            one, two, at = batch["one"].to_numpy(), batch["two"].to_numpy(), np.arange(len(batch))
            apart = BitMaps([*batch["left"], *batch["right"]]).differ(at, at + len(batch))
            yield batch.loc[apart <= one + two - 2 * overlap(one, two, num), ["u", "v"]]

    return materialise(both.mapInPandas(run, "u long, v long"), "narrowed")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id and text of the wanted (id, mark, second), stored.

    A bit map of bounded size spares most other texts the way to the join.
    """
    words = np.zeros(WANTED // 64, dtype=np.int64)
    bit = F.col("mark").bitwiseAND(WANTED - 1)
    for at, bits in wanted.select(F.shiftright(bit, 6).alias("at"), F.expr(f"shiftleft(1L, cast(mark & {WANTED - 1} & 63 as int))").alias(
            "bits")).groupBy("at").agg(F.bit_or("bits")).toLocalIterator():
        words[at] = bits
    packed = words.tobytes()

    @F.pandas_udf("boolean")
    def marked(mark: pd.Series) -> pd.Series:
        own = mark.to_numpy() & (WANTED - 1)
        return pd.Series(((np.frombuffer(packed, dtype=np.uint8)[own >> 3] >> (own & 7)) & 1).astype(bool))

    found = docs.select(*_marks(), text_of().alias("text")).filter(marked("mark")).dropDuplicates(["mark", "second"])
    return materialise(found.join(wanted, ["mark", "second"]).select("id", "text"), "texts")


def exact_set(text: str, n: int = WORDS) -> set:
    words = words_of(text)
    if not words:
        return set()
    n = min(n, len(words))
    return set(zip(*[words[k : len(words) - n + 1 + k] for k in range(n)]))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, num: int) -> DataFrame:
    """The pairs whose words are similar enough, stored."""
    texts = _texts(docs, materialise(_ids(pairs).join(classes.select("id", "mark", "second"), "id"), "wanted"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, set()
        for batch in batches:
            keep = []
            for u, left, right in zip(batch["u"], batch["left"], batch["right"]):
                if u != last:
                    last, held = u, exact_set(left, n)
                other = exact_set(right, n)
                common = len(held & other)
                keep.append(100 * common >= num * (len(held) + len(other) - common))
            yield batch.loc[keep, ["u", "v"]]

    both = pairs.join(texts.select(F.col("id").alias("v"), F.col("text").alias("right")), "v").join(
        texts.select(F.col("id").alias("u"), F.col("text").alias("left")), "u")
    return materialise(both.mapInPandas(run, "u long, v long"), "links")


def similar_groups(docs: DataFrame, n: int = WORDS, num: int = NUM) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    Documents link where their sets of ``n``-word shingles have a Jaccard similarity of ``num`` hundredths or more.
    With fewer words the whole sequence is the one shingle; null and empty texts have none and link with
    nothing. component_id is the smallest doc_id within reach, null only if all are. Rows with one doc_id, or
    without, are documents of their own; other columns are not read. No rows give no rows.
    """
    bounded_batches(docs.sparkSession)
    stored = _described(docs, n)
    every = stored.filter("kind = 'document'").drop("kind")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id")).alias("first")
    own = F.min(F.struct(ROW, "mark", "second")).alias("own")
    classes = materialise(every.filter("n > 0").groupBy("one", "two").agg(own, first).select(
        "one", "two", F.col(f"own.{ROW}").alias("id"), "own.mark", "own.second", "first"), "classes")

    frequency = _frequency(stored.filter("kind = 'bucket'"))
    sets = _prefixes(docs, frequency, n, num).join(classes.select("one", "two", "id"), ["one", "two"]).drop("one", "two")
    sets = materialise(sets, "prefixes")
    groups = materialise(_grouped(sets), "groups")
    places = _places(groups, num)
    alone = F.transform("members", lambda m: F.struct(m["id"].alias("id"), m["bits"].alias("bits"), m["id"].alias("root")))
    firsts = _pairs(places, groups.withColumn("members", alone), num, True)
    links = _verified(_narrowed(firsts, sets, num), docs, classes, n, num)
    roots = materialise(components(links), "roots")

    rooted = groups.select("part", "n", F.explode("members").alias("m")).select("part", "n", "m.id", "m.bits").join(
        roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    rooted = materialise(rooted.groupBy("part").agg(
        F.first("n").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"),
        F.collect_list(F.struct("id", "bits", "root")).alias("members")), "rooted")
    # what is connected already needs no second look
    open_ = places.join(rooted.select("part", "least", "most"), "part").groupBy("token").agg(
        F.min("least").alias("least"), F.max("most").alias("most")).filter("least < most").select("token")
    left = materialise(places.join(materialise(open_, "open"), "token", "left_semi"), "left")
    asked = materialise(_pairs(left, rooted, num, False).join(links, ["u", "v"], "left_anti"), "asked")
    roots = materialise(components(links.unionByName(_verified(_narrowed(asked, sets, num), docs, classes, n, num))), "roots")

    reached = classes.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    reached = materialise(reached.select("one", "two", "first", "root"), "reached")
    heads = materialise(reached.groupBy("root").agg(F.min("first").alias("head")), "heads")
    named = materialise(reached.join(heads, "root").select("one", "two", F.col("head.doc_id").alias("component_id")), "named")
    count = F.col("n").alias("n_shingles")
    linked = every.filter("n > 0").join(named, ["one", "two"]).select("doc_id", count, "component_id")
    return linked.unionByName(every.filter("n = 0").select("doc_id", count, F.col("doc_id").alias("component_id")))


travels(__name__)
