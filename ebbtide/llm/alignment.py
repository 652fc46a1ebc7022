"""Cross-tokenizer alignment, Arrow-native.

Both tokenizers cut the same bytes, so token ends are byte offsets in one document. Lists of ids are flattened
with their parent indices, ends are cumulative sums per document, and one Acero join on (document, end) brings
together where tokens end: ends of both tokenizers close a group, and between two neighbouring ends lies the
overlap of exactly one token of each, a link. ``Table.group_by`` counts links per document and, in chunks of
documents, the documents of each id pair; Spark merges these partial counts.

A document's links are kept as small numbers into its chunk's table of pairs. When corpus-wide counts are known,
each chunk gets the counts of its own pairs and nothing else: neither texts nor token ids move, and no worker
holds the pairs of the corpus.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ebbtide.session import materialise

from .common import bounded_batches, travels

#: Bytes of text aligned at once, and per chunk; a longer document is one of its own.
STEP = 1 << 20
CHUNK = 8 << 20
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Vocabularies:
    """The two tokenizers of a worker, with the bytes and the written form of each id."""

    def __init__(self, byte_pairs: str, pieces: str):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(os.path.splitext(byte_pairs)[0] + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # no special tokens: their strings inside of a text are text
        self.encode_a = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.encode_b = lambda texts: model.encode(texts, num_threads=1)
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(map(model.id_to_piece, range(model.get_piece_size())))]
        self.sizes_a, self.sizes_b = (pa.array([len(b) for b in own], pa.int64()) for own in (self.bytes_a, self.bytes_b))
        # what follows an id in the written groups: of A a comma or a bar, of B a comma, a semicolon or nothing
        na, nb = map(str, range(len(self.bytes_a))), map(str, range(len(self.bytes_b)))
        na, nb = list(na), list(nb)
        self.written = pa.array([i + s for own, ends in ((na, ",|"), (nb, (",", ";", ""))) for s in ends for i in own])

    def encode(self, texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
        """Ids by both tokenizers as list arrays; empty where the joined bytes are not those of space and text."""
        a = [self.encode_a(" " + t) if t else [] for t in texts]
        b = self.encode_b([t or "" for t in texts])
        for i, text in enumerate(texts):
            whole = (" " + text).encode() if text else b""
            if any(b"".join([table[k] for k in own[i]]) != whole for own, table in ((a, self.bytes_a), (b, self.bytes_b))):
                a[i], b[i] = [], []
        return pa.array(a, pa.list_(pa.int32())), pa.array(b, pa.list_(pa.int32()))


def token_ends(ids: pa.ListArray, sizes: pa.Array, name: str) -> pa.Table:
    """doc, end and id of each token: the flattened lists, with sums of sizes that start anew in each document."""
    flat, doc = ids.flatten(), pc.list_parent_indices(ids)
    total = pc.cumulative_sum(sizes.take(flat)).to_numpy()
    offsets = np.asarray(ids.offsets)
    before = np.where(offsets[:-1] > 0, np.concatenate([[0], total])[offsets[:-1]], 0)
    return pa.table({"doc": doc, "end": total - before[doc.to_numpy()], name: flat})


def joined_ends(a: pa.ListArray, b: pa.ListArray, words: Vocabularies) -> pa.Table:
    """A row for each (doc, end) in order, with the ids of the tokens that end there, null where none does."""
    left, right = token_ends(a, words.sizes_a, "a"), token_ends(b, words.sizes_b, "b")
    found = left.join(right, keys=["doc", "end"], join_type="full outer", use_threads=False)
    return found.sort_by([("doc", "ascending"), ("end", "ascending")]).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table[name]
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks or [pa.array([], column.type)])


def links_of(ends: pa.Table) -> pa.Table:
    """doc, a, b of each pair of overlapping tokens: the ids of the next ends of both sides."""
    return pa.table({"doc": _column(ends, "doc"), "a": pc.fill_null_backward(_column(ends, "a")),
                     "b": pc.fill_null_backward(_column(ends, "b"))})


def written_groups(ends: pa.Table, n_docs: int, words: Vocabularies) -> list[str]:
    """For each document its groups as text, "" without tokens."""
    a, b = _column(ends, "a"), _column(ends, "b")
    is_a, is_b = (pc.is_valid(x).to_numpy(zero_copy_only=False) for x in (a, b))
    both, doc = is_a & is_b, _column(ends, "doc").to_numpy()
    seen_a, seen_b, group = np.cumsum(is_a), np.cumsum(is_b), np.cumsum(both) - both
    until_a, until_b = seen_a[both], np.concatenate([[0], seen_b[both]])
    last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, dtype=bool)
    # a token comes after all tokens of earlier groups, one of B also after those of A in its own
    at_a = seen_a[is_a] - 1 + until_b[group[is_a]]
    at_b = seen_b[is_b] - 1 + until_a[group[is_b]]
    n_a, n_b = len(words.bytes_a), len(words.bytes_b)
    order = np.empty(len(at_a) + len(at_b), dtype=np.int32)
    order[at_a] = a.drop_null().to_numpy() + n_a * both[is_a]
    order[at_b] = 2 * n_a + b.drop_null().to_numpy() + n_b * (both.astype(np.int32) + (last & both))[is_b]
    tokens = np.bincount(doc, weights=is_a.astype(np.int64) + is_b, minlength=n_docs).astype(np.int64)
    offsets = pa.array(np.concatenate([[0], np.cumsum(tokens)]), pa.int32())
    lists = pa.ListArray.from_arrays(offsets, words.written.take(pa.array(order)))
    return pc.binary_join(lists, "").to_pylist()


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers below 2**32 as bytes, equal places together."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 4 * n, codec="zstd", asbytes=True), dtype=np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


class Chunk:
    """Documents that share a table of pairs."""

    def __init__(self, n_b: int):
        self.n_b, self.bytes, self.docs, self.links = n_b, 0, [], []

    def add(self, ids: list, ends: pa.Table, a: pa.ListArray, b: pa.ListArray, written: list[str], size: int) -> None:
        n, links = len(ids), links_of(ends)
        pair = pc.add(pc.multiply(links["a"].cast(pa.int64()), self.n_b), links["b"].cast(pa.int64()))
        each = pa.table({"doc": links["doc"], "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        doc = links["doc"].to_numpy()
        valid = pc.and_(pc.is_valid(ends["a"]), pc.is_valid(ends["b"])).to_numpy()
        counts = [pc.list_value_length(a).to_numpy(), pc.list_value_length(b).to_numpy(),
                  np.bincount(doc[valid], minlength=n), np.bincount(doc, minlength=n)]
        sha = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
        self.links.append((each["doc"].to_numpy().astype(np.int64) + len(self.docs), each["pair"].to_numpy(), each["count_all"].to_numpy()))
        self.docs += [(i, *map(int, c), s) for i, *c, s in zip(ids, *counts, sha)]
        self.bytes += size

    def closed(self) -> tuple[pa.Table, dict]:
        """The table of pairs with the documents that hold each, and the documents with numbers into it."""
        doc, pair, times = (np.concatenate(x) for x in zip(*self.links))
        found = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
        # frequent pairs get small numbers
        found = found.sort_by([("count_all", "descending"), ("pair", "ascending")]).rename_columns(["pair", "n"])
        pairs = found["pair"].to_numpy()
        by_pair = np.argsort(pairs)
        number = by_pair[np.searchsorted(pairs, pair, sorter=by_pair)]
        order = np.lexsort((number, doc))
        doc, number, times = doc[order], number[order], times[order]
        sizes = np.bincount(doc, minlength=len(self.docs))
        steps = np.diff(number, prepend=0)
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[starts] = number[starts]
        return found, {"docs": self.docs, "sizes": _squeezed(sizes), "steps": _squeezed(steps),
                       "times": _squeezed(times), "n_steps": len(steps)}


def encoded(docs: DataFrame, byte_pairs: str, pieces: str) -> DataFrame:
    """Stored rows of two kinds: a chunk with its documents, and each pair of a chunk with its number ``at`` there."""
    bounded_batches(docs.sparkSession)
    of_id = docs.schema["doc_id"].dataType
    fields = ", ".join(f"{c}: long" for c in COUNTS)
    schema = (f"kind string, chunk long, at long, pair long, n long, docs array<struct<doc_id: {of_id.simpleString()}, {fields}, "
              "sha: string>>, sizes binary, steps binary, times binary, n_steps long")
    doc_type = pa.struct([("doc_id", to_arrow_type(of_id)), *((c, pa.int64()) for c in COUNTS), ("sha", pa.string())])
    types = {"kind": pa.string(), "chunk": pa.int64(), "at": pa.int64(), "pair": pa.int64(), "n": pa.int64(),
             "docs": pa.list_(doc_type), "sizes": pa.binary(), "steps": pa.binary(), "times": pa.binary(), "n_steps": pa.int64()}

    def batch(n: int, /, **own) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [own[c].cast(t) if c in own else pa.nulls(n, t) for c, t in types.items()], names=list(types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number = Vocabularies(byte_pairs, pieces), TaskContext.get().partitionId() << 32
        chunk = Chunk(len(words.bytes_b))

        def close() -> Iterator[pa.RecordBatch]:
            found, row = chunk.closed()
            for at in range(0, found.num_rows, 1 << 16):
                part = found.slice(at, 1 << 16).combine_chunks()
                n = part.num_rows
                yield batch(n, kind=pa.array(["pair"] * n), chunk=pa.array([number] * n), at=pa.array(np.arange(at, at + n)),
                            pair=_column(part, "pair"), n=_column(part, "n"))
            rows = [dict(zip(["doc_id", *COUNTS, "sha"], d)) for d in row.pop("docs")]
            yield batch(1, kind=pa.array(["chunk"]), chunk=pa.array([number]), docs=pa.array([rows], types["docs"]),
                        **{k: pa.array([v]) for k, v in row.items()})

        for given in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(given.column("text")), 0))
            first = 0
            while first < given.num_rows:
                stop = first + 1
                while stop < given.num_rows and sizes[first : stop + 1].sum() <= STEP:
                    stop += 1
                part = given.slice(first, stop - first)
                size = int(sizes[first:stop].sum())
                if chunk.docs and chunk.bytes + size > CHUNK:
                    yield from close()
                    chunk, number = Chunk(chunk.n_b), number + 1
                a, b = words.encode(part.column("text").to_pylist())
                ends = joined_ends(a, b, words)
                chunk.add(part.column("doc_id").to_pylist(), ends, a, b, written_groups(ends, len(a), words), size)
                first = stop
        if chunk.docs:
            yield from close()

    text = F.col("text").cast("string").alias("text")
    return materialise(docs.select("doc_id", text).mapInArrow(run, schema), "aligned", ("kind",))


def pair_counts(pairs: DataFrame, n_b: int) -> DataFrame:
    """a, b, n_docs of each linked id pair of the corpus and whether n_docs is the highest of its a."""
    totals = materialise(pairs.groupBy("pair").agg(F.sum("n").alias("n_docs")).withColumn(
        "a", F.expr(f"pair div {n_b}")), "totals")
    best = materialise(totals.groupBy("a").agg(F.max("n_docs").alias("most")), "best")
    return totals.join(best, "a").select(
        "pair", "a", (F.col("pair") % n_b).alias("b"), "n_docs", (F.col("n_docs") == F.col("most")).alias("is_best"))


def _scored(left: pa.Table, right: pa.Table) -> Iterator[dict]:
    """The documents of one chunk with the counts of its pairs put in."""
    n = right.num_rows
    count, best = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    at = right["at"].to_numpy()
    count[at], best[at] = right["n_docs"].to_numpy(), right["is_best"].to_numpy()
    for row in left.to_pylist():
        docs = row["docs"]
        sizes = _unsqueezed(row["sizes"], len(docs))
        steps, times = (_unsqueezed(row[c], row["n_steps"]) for c in ("steps", "times"))
        first, total = np.cumsum(sizes) - sizes, np.cumsum(steps)
        before = np.where(sizes > 0, np.concatenate([[0], total])[first], 0)
        number = total - np.repeat(before, sizes)
        doc = np.repeat(np.arange(len(docs)), sizes)
        n_best, count_sum = np.zeros(len(docs), dtype=np.int64), np.zeros(len(docs), dtype=np.int64)
        np.add.at(n_best, doc, times * best[number])
        np.add.at(count_sum, doc, times * count[number])
        for d, x, y in zip(docs, n_best, count_sum):
            yield d | {"n_best": int(x), "count_sum": int(y)}


def align(docs: DataFrame, byte_pairs: str, pieces: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of ``docs``.

    ``byte_pairs`` is the file of a byte-level tokenizer (A) with its rank file beside it, ``pieces`` a model of
    byte-fallback pieces (B). Null and empty texts, and those whose tokens don't add up to a space and the text,
    have zeros and an empty digest. Rows with one doc_id, or without, are documents of their own; other columns
    are not read. No rows give no rows. A document is aligned as a whole in one task.
    """
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=pieces).get_piece_size()
    rows = encoded(docs, byte_pairs, pieces)
    pairs = rows.filter("kind = 'pair'").select("chunk", "at", "pair", "n")
    counted = materialise(pair_counts(pairs, n_b).select("pair", "n_docs", "is_best"), "pair_counts")
    known = pairs.drop("n").join(counted, "pair").select(F.col("chunk").alias("of"), "at", "n_docs", "is_best")
    chunks = rows.filter("kind = 'chunk'").select("chunk", "docs", "sizes", "steps", "times", "n_steps")

    of_id = docs.schema["doc_id"].dataType
    out = pa.schema([("doc_id", to_arrow_type(of_id)), *((c, pa.int64()) for c in (*COUNTS, "n_best", "count_sum")),
                     ("groups_sha256", pa.string())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([d | {"groups_sha256": d["sha"]} for d in _scored(left, right)], schema=out)

    kinds = ", ".join(f"{c} long" for c in (*COUNTS, "n_best", "count_sum"))
    return chunks.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(
        run, f"doc_id {of_id.simpleString()}, {kinds}, groups_sha256 string")


travels(__name__)
