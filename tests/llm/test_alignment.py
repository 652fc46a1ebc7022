import hashlib
from collections import Counter

import numpy as np
import pytest

from ebbtide.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokens():
    """text -> token bytes and ids of both sides, by the libraries that the contract names."""
    import sentencepiece
    from tokenizers import Tokenizer

    byte_pairs = Tokenizer.from_file(A)
    byte_pairs.encode_special_tokens = True
    # the written form of a byte: printable ones stand for themselves, the others follow from 256 on
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)

    def make(text):
        found = byte_pairs.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(back[c] for c in byte_pairs.id_to_token(i))) for i in found.ids]
        b = []
        for i in pieces.encode(text):
            p = pieces.id_to_piece(i)
            b.append((i, bytes([int(p[1:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = all(b"".join(x for _, x in side) == whole for side in (a, b))
        return (a, b) if text and same else ([], [])

    return make


def plain(rows, tokens):
    described, held = [], Counter()
    for doc_id, text, *_ in rows:
        a, b = tokens(text or "")
        spans = []
        for side in (a, b):
            at, own = 0, []
            for i, x in side:
                own.append((at, at + len(x), i))
                at += len(x)
            spans.append(own)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        cuts = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups = [[",".join(str(i) for s, e, i in own if low <= s < high) for own in spans]
                  for low, high in zip([0, *cuts], cuts)]
        text = ";".join("|".join(g) for g in groups)
        described.append((doc_id, len(a), len(b), len(cuts), links, hashlib.sha256(text.encode()).hexdigest() if a else ""))
        held.update(set(links))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(n, most.get(i, 0))
    return sorted(((d, na, nb, ng, len(ls), sum(held[x] == most[x[0]] for x in ls), sum(held[x] for x in ls), sha)
                   for d, na, nb, ng, ls, sha in described), key=repr)


HARD = ["<|endoftext|> and <s></s><unk>", " leading space", "trailing ", "two  spaces   three", "▁ piece sign", "x▁y", "a\tb\nc\r\n\nd",
        "<0x41>", "é combining ﬁ ligature ①", " no-break", "日本語のテキスト", "\x00 zero", "🙂🙂 faces", "don't WON'T it's", "1234567 89.10", "abc" * 400]


@pytest.mark.parametrize("step, chunk", [(1 << 20, 8 << 20), (200, 900), (1, 1)])
def test_against_plain_version(documents, odd_rows, prose, tokens, rows, monkeypatch, step, chunk):
    monkeypatch.setattr(alignment, "STEP", step)
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    given = odd_rows + [(100 + i, t) for i, t in enumerate(HARD)] + [(200 + i, prose(i, 5 + 3 * i)) for i in range(30)]
    given += [(300, given[-1][1])] * 3
    found = alignment.align(documents(given), A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(found) == plain(given, tokens)


def test_no_rows_and_none_with_tokens(documents, rows):
    assert alignment.align(documents([]), A, B).count() == 0
    assert rows(alignment.align(documents([(1, None), (2, ""), (2, "")]), A, B)) == [(1, *[0] * 6, ""), *[(2, *[0] * 6, "")] * 2]


def test_ids_of_another_type_and_long_text(spark, prose, tokens, rows):
    given = [("x", prose(1, 4000)), (None, "short"), ("y", "")]
    docs = spark.createDataFrame([(t, i, 5) for i, t in given], "text string, doc_id string, n_a int")
    assert rows(alignment.align(docs, A, B)) == plain(given, tokens)


def test_numbers_survive_squeezing():
    for values in ([], [0], [1, 2**32 - 1, 70_000, 3]):
        values = np.array(values, dtype=np.int64)
        assert alignment._unsqueezed(alignment._squeezed(values), len(values)).tolist() == values.tolist()
