"""Packing token sequences by shortest-pack-first over the length histogram.

Documents become token ids in Python workers and are cut into pieces; only what describes a piece is kept. The
histogram of piece lengths has at most as many entries as a sequence has tokens. On the driver, lengths are
placed longest first, each into the shortest packs that still have room, for all pieces of a length at once by
updating the counts of packing patterns. Every pattern then owns a range of ranks of each of its lengths, and a
piece finds its sequence by its rank among the pieces of its length. Ranks come from running counts inside a
task and one offset per task and length, so no task sees all pieces of a length.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ebbtide.session import materialise

from .common import bounded_batches, text_of, travels

LENGTH = 1024
END = 0


def _ordinary_bytes(vocabulary: str) -> Callable[[str], bytes]:
    """text -> ids of ordinary text as little-endian 32-bit numbers, see ``byte_pair_encoder``."""
    import base64

    import tiktoken
    import public_tokenizers

    with open(os.path.splitext(vocabulary)[0] + ".tiktoken", "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.array(encoding.encode_ordinary(text), dtype="<u4").tobytes()


def byte_pair_encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """text -> ids of ordinary text, for the vocabulary of a ``.json`` tokenizer file.

    The rank file beside it holds the same vocabulary in the form the faster library reads; tests compare the
    two. Texts are encoded whole: a memory of the words seen costs more than it spares once words are many.
    """
    encode = _ordinary_bytes(vocabulary)
    return lambda text: np.frombuffer(encode(text), "<u4").tolist()


def bytes_encoder(vocabulary: str) -> Callable[[str], bytes]:
    """What ``encoder`` gives, as little-endian 32-bit numbers: ids never become objects of their own."""
    with open(vocabulary, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    if odd := [t["content"] for t in added if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]:
        raise ValueError(f"added tokens that match other than as they stand: {odd}")
    ordinary = _ordinary_bytes(vocabulary)
    ids = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in added}
    if not ids:
        return ordinary
    standing = re.compile("(" + "|".join(map(re.escape, sorted(ids, key=len, reverse=True))) + ")")

    def encode(text: str) -> bytes:
        parts = standing.split(text)
        if len(parts) == 1:
            return ordinary(text)
        return b"".join(ids[p] if i % 2 else ordinary(p) for i, p in enumerate(parts))

    return encode


def encoder(vocabulary: str) -> Callable[[str], list[int]]:
    """text -> the ids that the ``.json`` tokenizer gives without adding special tokens.

    Added tokens that stand in the text, the longest where several start, have their own ids; what lies between
    is ordinary text.
    """
    encode = bytes_encoder(vocabulary)
    return lambda text: np.frombuffer(encode(text), "<u4").tolist()


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece, stored, with its rank inside its task.

    A document's ids end with id 0, so a null or empty text is one piece of that id. Pieces are cut every
    ``length`` ids. ``with_ids`` adds the ids as little-endian 32-bit numbers. Repeated rows are documents of
    their own; other columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = bytes_encoder(vocabulary), np.array([END], dtype="<u4").tobytes()
        part, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = encode(text) + end
                tokens = len(ids) // 4
                for start in range(0, tokens, length):
                    own = ids[4 * start : 4 * (start + length)]
                    size = len(own) // 4
                    rows.append((doc_id, start, size, zlib.crc32(own), tokens, part, seen[size], own))
                    seen[size] += 1
            frame = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "local", "ids"])
            # ids of documents may be null; they must not turn into floats on the way
            frame["doc_id"] = pd.Series([r[0] for r in rows], dtype=batch["doc_id"].dtype)
            yield frame if with_ids else frame.drop(columns="ids")

    kind = docs.schema["doc_id"].dataType
    schema = ("doc_id string, start long, length long, ids_crc32 long, doc_tokens long, part int, local long"
              + (", ids binary" if with_ids else ""))
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"))
    cut_up = named.mapInPandas(cut, schema)
    return materialise(cut_up.withColumn("doc_id", F.col("doc_id").cast(kind)), "pieces")


def patterns(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of packing patterns that use up the histogram; no pattern exceeds ``length``.

    Longest lengths first, each into the shortest packs with room: a pattern of which there are fewer packs than
    pieces left is extended whole, else as many of its packs as there are pieces.
    """
    done: list[tuple[int, tuple[int, ...]]] = []
    packs: list[tuple[int, int, int, tuple[int, ...]]] = []  # filled, order, count, lengths
    order = 0

    def put(filled: int, count: int, lengths: tuple[int, ...]) -> None:
        nonlocal order
        if filled == length:
            done.append((count, lengths))
        elif count:
            order += 1
            heapq.heappush(packs, (filled, order, count, lengths))

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left and packs and packs[0][0] + size <= length:
            filled, _, count, lengths = heapq.heappop(packs)
            used = min(left, count)
            left -= used
            put(filled, count - used, lengths)
            put(filled + size, used, (*lengths, size))
        # no pack has room: new ones, each with as many pieces of this length as it holds
        per_pack = length // size
        full, rest = divmod(left, per_pack)
        if full:
            put(size * per_pack, full, (size,) * per_pack)
        if rest:
            put(size * rest, 1, (size,) * rest)
    return done + [(count, lengths) for _, _, count, lengths in packs]


def places(found: list[tuple[int, tuple[int, ...]]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, pieces per pack, first sequence, first offset), by first rank."""
    next_rank, sequence = Counter(), 0
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    for count, lengths in found:
        offset = 0
        for size, times in Counter(lengths).items():  # equal lengths stand together, longest first
            table.setdefault(size, []).append((next_rank[size], times, sequence, offset))
            next_rank[size] += count * times
            offset += size * times
        sequence += count
    return {size: np.array(rows, dtype=np.int64) for size, rows in table.items()}


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``pieces`` with sequence_id and offset; each sequence is filled from 0 without gaps.

    The plan depends on the histogram alone; no pieces give no rows.
    """
    by_task = materialise(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "by_task")
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(patterns(histogram, length))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(materialise(first, "offsets"), ["part", "length"])

    @F.pandas_udf("sequence_id long, offset long")
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(sizes), 2), dtype=np.int64)
        size_of, rank_of = sizes.to_numpy(), ranks.to_numpy()
        for size in np.unique(size_of):
            here = size_of == size
            rank, rows = rank_of[here], table[int(size)]
            row = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
            inside = rank - row[:, 0]
            out[here, 0] = row[:, 2] + inside // row[:, 1]
            out[here, 1] = row[:, 3] + inside % row[:, 1] * size
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = ranked.withColumn("place", place("length", F.col("before") + F.col("local")))
    return placed.select(*[c for c in cut.columns if c not in ("part", "local")], "place.*")


def pack_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """All documents cut, packed and placed: see ``pieces`` and ``pack``."""
    return pack(pieces(docs, vocabulary, length, with_ids), length)


travels(__name__)
