import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from ebbtide.llm import mixing


def fill(sizes, weights=(5, 2, 1), most=3):
    """Share, cap, share the rest again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, total = {}, Fraction(sum(sizes.values()))
    while len(target) < len(order):
        free = [s for s in order if s not in target]
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] >= most * sizes[s]]
        target |= {s: Fraction(most * sizes[s]) for s in over} if over else {s: level * weight[s] for s in free}
    return target


def plain(rows):
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, s in rows]
    sizes = Counter()
    for _, s, n in sized:
        sizes[s] += n
    target, out = fill(sizes), []
    for i, s, n in sized:
        rate = target[s] / sizes[s] if sizes[s] else Fraction(0)
        digest = hashlib.md5(f"17:{'' if i is None else i}".encode()).hexdigest()
        chance = Fraction(int(digest[:13], 16), 1 << 52)
        out.append((i, s, n, sizes[s], pytest.approx(float(target[s])), int(rate) + (chance < rate - int(rate))))
    return out


def key(row):
    return repr(row[:4])


def test_plan_and_mix(documents, odd_rows, prose):
    rows = odd_rows + [(100 + i, prose(i, 20 + i), "en", f"src{i % 7}" if i % 5 else "hot") for i in range(200)]
    rows += [(999, "", "en", "blank")]
    docs = documents(rows)
    found = sorted(map(tuple, mixing.plan(docs).collect()), key=key)
    want = sorted(plain(rows), key=key)
    assert found == want
    left = mixing.mix(docs)
    assert left.columns == docs.columns
    times = Counter((r.doc_id, r.source) for r in left.collect())
    due = defaultdict(int)
    for i, s, *_, n in want:
        due[i, s] += n
    assert times == Counter(due) - Counter()
    assert Counter((r.doc_id, r.source) for r in mixing.mix(docs.repartition(7)).collect()) == times


def test_caps_cascade(documents):
    rows = [(i, "w " * n, "en", s) for i, (s, n) in enumerate([("a", 1), ("b", 10), ("c", 200), ("d", 5), ("e", 400), ("f", 90)])]
    found = {r.source: r.target for r in mixing.plan(documents(rows)).collect()}
    assert found == pytest.approx({k: float(v) for k, v in fill({"a": 1, "b": 10, "c": 200, "d": 5, "e": 400, "f": 90}).items()})
    assert sum(found.values()) == pytest.approx(706)


def test_nothing_to_mix(documents):
    assert mixing.plan(documents([])).count() == 0
    assert [(r.size, r.target, r.n_copies) for r in mixing.plan(documents([(1, None), (2, " ")])).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mix(documents([(1, None), (2, " ")])).count() == 0
