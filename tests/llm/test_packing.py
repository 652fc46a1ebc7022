import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ebbtide.llm import packing

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_agrees_with_the_tokenizer(reference, odd_rows, spark):
    encode = packing.byte_pair_encoder(VOCABULARY)
    texts = [t or "" for _, t, *_ in odd_rows] + [
        "a  b", " lead", "trail ", "x \n y", "it's we'll 12 34  <|endoftext|> a\tb \t c", " a  b 　 c", "a\x0b b\x1c c"]
    texts += [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert [encode(t) for t in texts] == [reference(t) for t in texts]


def test_ids_are_bytes_from_the_start_and_words_are_not_kept(reference):
    """What an encoder holds does not grow with the distinct words it meets."""
    encode = packing.bytes_encoder(VOCABULARY)
    encode("warm up")
    tracemalloc.start()
    for i in range(20):
        text = " ".join(f"word{i}x{j}" for j in range(1000))
        assert encode(text) == np.array(reference(text), "<u4").tobytes()
    kept, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert kept < 500_000


def test_added_tokens_have_their_ids(documents, odd_rows, prose):
    """As the tokenizer is used, without its special tokens turned into ordinary text."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = [t or "" for _, t, *_ in odd_rows] + [
        "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>a", "x\n<|endoftext|>\n y", "<|endoftext|", " <|endoftext|>  "]
    texts += [prose(i, 40).replace(" a", "<|endoftext|>") for i in range(20)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[len(odd_rows)] == [64, 220, 50256, 275]
    encode = packing.encoder(VOCABULARY)
    assert [encode(t) for t in texts] == want
    found = packing.pieces(documents(list(enumerate(texts))), VOCABULARY).collect()
    assert {(r.doc_id, r.ids_crc32, r.doc_tokens) for r in found} == {
        (i, zlib.crc32(np.array([*ids, 0], "<u4").tobytes()), len(ids) + 1) for i, ids in enumerate(want)}


def test_every_id_has_its_place(documents, odd_rows, prose, reference):
    rows = odd_rows + [(50 + i, prose(i, 3 * i + 1)) for i in range(60)] + [(200, prose(5, 4000))]
    found = packing.pack_documents(documents(rows), VOCABULARY, 128, with_ids=True).collect()
    streams = defaultdict(list)
    for r in found:
        ids = np.frombuffer(r.ids, "<u4")
        assert (len(ids), zlib.crc32(ids.tobytes())) == (r.length, r.ids_crc32) and 0 < r.length <= 128
        streams[r.sequence_id].append((r.offset, r.length))
    for parts in streams.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    assert sorted(streams) == list(range(len(streams)))
    # ids of each document, put together again
    want = Counter((i, tuple([*reference(t or ""), 0])) for i, t, *_ in rows)
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id, r.doc_tokens].append((r.start, tuple(np.frombuffer(r.ids, "<u4").tolist())))
    for (i, ids), times in want.items():
        for start in range(0, len(ids), 128):
            assert pieces[i, len(ids)].count((start, ids[start : start + 128])) == times
    assert sum(map(len, pieces.values())) == sum(-(-len(ids) // 128) * n for (_, ids), n in want.items())


def test_patterns_use_up_the_histogram():
    dice = np.random.default_rng(3)
    for top in (1, 7, 64, 1024):
        for _ in range(20):
            sizes = dice.integers(1, top + 1, dice.integers(0, 60))
            histogram = {int(s): int(dice.integers(1, 500)) for s in sizes}
            found, used = packing.patterns(histogram, top), Counter()
            for count, lengths in found:
                assert count > 0 and sum(lengths) <= top
                for size in lengths:
                    used[size] += count
            assert used == Counter(histogram)


def test_padding_is_small():
    dice = np.random.default_rng(4)
    histogram = Counter(int(s) for s in dice.integers(1, 1025, 50_000))
    found = packing.patterns(histogram)
    filled = sum(s * n for s, n in histogram.items())
    assert filled / (1024 * sum(c for c, _ in found)) > 0.95


def test_no_documents(documents):
    assert packing.pack_documents(documents([]), VOCABULARY).count() == 0
