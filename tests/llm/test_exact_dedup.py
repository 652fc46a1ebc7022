import hashlib
from collections import defaultdict

import numpy as np

from ebbtide.llm import exact_dedup
from ebbtide.llm.common import ROW, stored_rows


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def result(docs):
    found = exact_dedup.exact_groups(stored_rows(docs, "t")).drop(ROW).collect()
    kept = [(r.doc_id, r.text_sha256) for r in found if r.kept]
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr), kept


def test_groups_of_odd_rows(documents, odd_rows, prose):
    long = prose(1, 60_000)  # several chunks
    rows = odd_rows + [(100, long), (101, long), (102, long + "x"), (103, prose(2, 30)), (90, prose(2, 30)), (None, "null id")]
    found, kept = result(documents(rows))
    assert found == brute(rows)
    # one row of each text stays
    assert len(kept) == len(set(kept)) == len({r[1] or "" for r in rows})


def test_no_rows(documents):
    assert result(documents([])) == ([], [])


def test_chunks_combine_to_the_fingerprint_of_the_whole(monkeypatch):
    data = bytes(range(256)) * 3
    for prime, base, table in zip(exact_dedup.PRIMES, exact_dedup.BASES, exact_dedup.power_tables(800)):
        whole = sum((b + 1) * pow(base, len(data) - 1 - i, prime) for i, b in enumerate(data)) % prime
        parts = [(data[a : a + 100], max(0, len(data) - a - 100)) for a in range(0, len(data), 100)]
        assert sum(exact_dedup.chunk_hash(c, e, prime, base, table) for c, e in parts) % prime == whole


def test_colliding_fingerprints_are_told_apart(documents, monkeypatch):
    """With a base of zero only the last byte of a chunk counts."""
    monkeypatch.setattr(exact_dedup, "BASES", (0, 0))
    monkeypatch.setattr(exact_dedup, "power_tables", lambda size: [np.eye(1, size, dtype=np.uint64)[0]] * 2)
    rows = [(1, "ax"), (2, "bx"), (3, "ax"), (4, "cx")]
    assert result(documents(rows))[0] == brute(rows)


def test_columns_and_one_row_of_repeats_stay(documents):
    rows = [(1, "t", "en", "s"), (1, "t", "en", "s"), (None, "t", "de", "s"), (2, "u", "en", None)]
    docs = documents(rows)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(1, "t"), (2, "u")]
