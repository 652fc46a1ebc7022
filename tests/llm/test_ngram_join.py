import random

import numpy as np
import pandas as pd
import pytest

from ebbtide.llm import ngram_join as join


def plain(rows, n=3, num=90):
    sets = [join.exact_set(text or "", n) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for k in range(i):
            common = len(sets[i] & sets[k])
            if sets[i] and sets[k] and 100 * common >= num * (len(sets[i]) + len(sets[k]) - common):
                root[find(i)] = find(k)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if find(k) == find(i) and rows[k][0] is not None]
        out.append((doc_id, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=repr)


def changed(text, dice, edits):
    words = text.split()
    for _ in range(edits):
        words[dice.randrange(len(words))] = f"x{dice.randrange(10**6)}"
    return " ".join(words)


def corpus(prose):
    """Copies, near copies in chains, copies but for case and white space, texts about the threshold."""
    dice = random.Random(4)
    rows = [(i, prose(i, dice.randint(1, 150))) for i in range(60)]
    for k in range(12):
        text = rows[k][1] if len(rows[k][1].split()) > 40 else prose(700 + k, 120)
        rows.append((100 + 20 * k, text))
        for i in range(15):
            text = changed(text, dice, dice.choice([0, 1, 1, 2, 3]))
            rows.append((101 + 20 * k + i, text.upper() if i % 5 == 0 else text.replace(" ", " \n") if i % 7 == 0 else text))
    base = prose(5000, 200)
    rows += [(1000 + i, changed(base, dice, 2)) for i in range(60)]
    rows += [(2000 + i, "same words again " * (20 + i)) for i in range(6)] + [(2100, "a b"), (2101, "A B"), (2102, "a b c"), (2103, "b a")]
    return rows


@pytest.mark.parametrize("crowded, members, block, bits", [(4096, 64, 1 << 15, 256), (10, 2, 8, 64)])
def test_against_all_pairs(documents, odd_rows, prose, rows, monkeypatch, crowded, members, block, bits):
    for name, value in (("CROWDED", crowded), ("MEMBERS", members), ("BLOCK", block), ("LEAST_BITS", bits)):
        monkeypatch.setattr(join, name, value)
    given = odd_rows + [(9000 + i, *r[1:]) for i, r in enumerate(odd_rows)] + corpus(prose)
    assert rows(join.similar_groups(documents(given))) == plain(given)


def test_other_thresholds(documents, prose, rows):
    given = corpus(prose)[:150]
    assert rows(join.similar_groups(documents(given), 5, 80)) == plain(given, 5, 80)


def test_no_rows_none_with_words_and_none_alike(documents, prose, rows):
    assert join.similar_groups(documents([])).collect() == []
    assert rows(join.similar_groups(documents([(2, None), (1, " "), (None, "")]))) == sorted([(2, 0, 2), (1, 0, 1), (None, 0, None)], key=repr)
    given = [(i, prose(i, 100)) for i in range(5)]
    assert rows(join.similar_groups(documents(given))) == [(i, len(join.exact_set(t)), i) for i, t in given]


def test_members_of_one_group_and_more_than_a_task_takes(documents, rows, monkeypatch):
    """Sets with one prefix and size: the common shingle is made frequent, so that it isn't in the prefix."""
    monkeypatch.setattr(join, "MEMBERS", 2)
    texts = [" ".join(f"w{k}" for k in range(60))]
    texts += [" ".join([*(f"w{k}" for k in range(58)), f"v{i}", "z"]) for i in range(12)]
    given = list(enumerate(texts))
    assert rows(join.similar_groups(documents(given))) == plain(given)


def test_equal_shingles_have_equal_hashes_and_bits_bound_the_difference(prose):
    a, b = (join.shingle_set(join.words_of(prose(1, 90) + tail)) for tail in (" one two", " THREE"))
    assert len(a) == len(join.exact_set(prose(1, 90) + " one two"))
    differ = len(np.setxor1d(a, b))
    bits = [np.unpackbits(np.frombuffer(join.parities(x), dtype=np.uint8)) for x in (a, b)]
    assert 0 < (bits[0] != bits[1]).sum() <= differ
    maps = join.BitMaps([join.parities(x) for x in (a, b, a[:40], b[: len(b) - 9])])
    for i, x in enumerate((a, b, a[:40], b[: len(b) - 9])):
        for k, y in enumerate((a, b, a[:40], b[: len(b) - 9])):
            assert maps.differ(np.array([i]), np.array([k]))[0] <= len(np.setxor1d(x, y))
    assert join.width_of(128) == 256 and join.width_of(129) == 512
    assert len(join.shingle_set([b"a", b"b"])) == 1 and not set(join.shingle_set([b"a", b"b"])) & set(join.shingle_set([b"a", b"b", b""]))


def test_a_star_has_one_pair_for_each_member():
    bits = b"\0" * (join.width_of(100) // 8)
    rows = pd.DataFrame({"token": 1, "i": 0, "j": 0, "side": 0, "cross": False, "n": 100, "place": 0,
                         "members": [[{"id": k, "bits": bits, "root": k}] for k in range(50)]})
    stars = join.candidate_pairs(rows, 90, True)
    assert sorted(map(tuple, stars.to_numpy())) == [(0, k) for k in range(1, 50)]
    assert len(join.candidate_pairs(rows, 90, False)) == 50 * 49 // 2
