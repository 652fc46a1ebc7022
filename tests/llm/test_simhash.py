import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from ebbtide.llm import simhash
from ebbtide.llm.common import ROW
from ebbtide.llm.components import components


def plain_fingerprint(text, n=4):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, ids, radius):
    """Smallest id within reach of each value, by looking at all pairs."""
    reach = list(range(len(values)))

    def root(i):
        while reach[i] != i:
            i = reach[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                reach[root(i)] = root(j)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[root(i)] = min(own, least.get(root(i), own))
    return [least.get(root(i)) for i in range(len(values))], len({root(i) for i in range(len(values))})


def near(docs, **more):
    rows = docs.select("doc_id", "text").withColumn(ROW, F.monotonically_increasing_id())
    return simhash.near_groups(rows, **more)


def test_fingerprints_and_groups(documents, odd_rows, prose):
    rows = [*odd_rows, *[(1000 + i, prose(i // 3, 200) + (" end" if i % 3 else "") + (" x" if i % 3 == 2 else "")) for i in range(60)]]
    found = near(documents(rows)).collect()
    values = [plain_fingerprint(t) for _, t, *_ in rows]
    least, groups = classes(values, [r[0] for r in rows], 4)
    want = sorted(zip([r[0] for r in rows], values, least), key=repr)
    got = sorted(((r.doc_id, r.fingerprint % 2**64, r.component_id) for r in found), key=repr)
    assert got == want
    assert sum(r.kept for r in found) == groups


def test_a_very_long_text():
    text = " ".join(str(i) for i in range(150_000))
    assert simhash.fingerprint(text) % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize("radius, hot", [(4, 50_000), (4, 3), (3, 50_000), (2, 3)])
def test_links_keep_components_whole(spark, monkeypatch, radius, hot):
    """Chains and balls of random flips, against all pairs; also where every prefix counts as crowded."""
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 5000)
    dice = np.random.default_rng(7)
    values = [int(x) for x in dice.integers(0, 2**63, 40)]
    for _ in range(160):
        value = values[dice.integers(len(values))]
        for bit in dice.choice(64, dice.integers(1, 7), replace=False):
            value ^= 1 << int(bit)
        values.append(value)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = simhash.links(frame, radius).collect()
    assert all(((r.u ^ r.v) % 2**64).bit_count() <= radius for r in found)
    roots = {r.node: r.root for r in components(spark.createDataFrame(found or [], "u long, v long")).collect()}
    want, _ = classes(values, signed, radius)
    assert [roots.get(v, v) for v in signed] == want


@pytest.mark.parametrize("size", [1, 7, 100])
def test_links_do_not_depend_on_batches(monkeypatch, size):
    """Blocks end between prefixes, wherever batches end; one prefix here is longer than any batch."""
    dice = np.random.default_rng(3)
    prints = np.sort(np.unique(dice.integers(0, 2**20, 500))) | (np.sort(dice.integers(0, 40, 1)) << 56)
    prefix = np.sort(np.where(dice.random(len(prints)) < 0.5, prints >> 56, (prints >> 56) ^ (1 << dice.integers(0, 8, len(prints)))))
    rows = pd.DataFrame({"prefix": prefix, "fingerprint": prints})

    def found(step, block):
        monkeypatch.setattr(simhash, "BLOCK", block)
        parts = simhash._meet(8, 2)(rows.iloc[at : at + step] for at in range(0, len(rows), step))
        made = pd.concat(parts)
        return set(zip(made["u"], made["v"]))

    whole = found(len(rows), 1 << 30)
    assert whole and found(size, 5000) == whole
    assert list(simhash._meet(8, 2)(iter([rows.iloc[:0]]))) == []


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 200)]
    star = [(1000, 1000 + i) for i in range(1, 50)] + [(1000, 1000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + star, "u long, v long")).collect()}
    assert found == {i: 1 for i in range(1, 201)} | {1000 + i: 1000 for i in range(50)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_of_a_group_stays(documents, prose):
    rows = [(5, prose(1, 300)), (4, prose(1, 300) + " end"), (4, prose(1, 300) + " end"), (9, prose(2, 300)), (None, ""), (7, None)]
    docs = documents(rows)
    left = simhash.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [4, 7, 9]
    assert simhash.keep_one(documents([])).count() == 0
