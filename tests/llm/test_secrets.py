import re

import pytest

from ebbtide.llm import secrets

ODD_SECRETS = [
    "token=token: abcdefgh", "password = 'abcdef' Secret: \"x.y/z=1\" API_KEY:abcdef apikey=12345", "tokentoken==abc=def",
    "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 11 + " AKIAAKIA" + "C" * 12 + " AKIA" * 3, "é漢\U0001f600 secret= abcdef " + "0123456789abcdef" * 2 + "é",
    "a" * 23 + "g" + "f" * 24 + "A" + "0" * 50, "pass word passwd=x passwd:abcdefg\npasswd\n=abcdefg", "token:" + "f" * 30,
    "ghp_" + "a1" * 18 + " xoxb-1234567890-x eyJabcdefgh.eyJabcdefgh.abcdefgh1 AIza" + "x" * 35,
    "-----BEGIN RSA PRIVATE KEY----- -----BEGIN PRIVATE KEY-----", "to ken sec ret api key AKI A", "TOKEN=secret=password=abcdef",
]


def plain(text, rules=secrets.BASE + secrets.MORE):
    found = []
    for rank, rule in enumerate(rules):
        # the whole run first, its length after
        pattern = "[0-9a-f]+" if rule.name == "hex" else rule.pattern
        found += [(m.start(), rank, m.end(), rule.name) for m in re.finditer(pattern, text) if len(m.group(rule.group)) >= rule.least]
    return sorted(found)


def test_spans_of_every_text(documents, odd_rows, prose):
    rows = odd_rows + [(100 + i, t) for i, t in enumerate(ODD_SECRETS)]
    rows += [(200 + i, prose(i, 50) + " " + ODD_SECRETS[i % len(ODD_SECRETS)] + " " + prose(i, 50)) for i in range(24)]
    rows += [(300, " ".join(ODD_SECRETS * 40) + prose(1, 5000)), (None, "token = 'abcdefgh'"), (100, "no such thing")]
    found = secrets.scan(documents(rows)).collect()
    got = sorted(((r.doc_id, [(s.start, s.rank, s.stop, s.kind) for s in r.found]) for r in found), key=repr)
    assert got == sorted(((i, plain(t or "")) for i, t, *_ in rows), key=repr)


def test_no_rows_and_no_index(documents):
    assert secrets.scan(documents([])).count() == 0
    only = (secrets.Rule("digits", r"[0-9]{3}"),)
    assert [len(r.found) for r in secrets.scan(documents([(1, "123456 78 901")]), only).collect()] == [3]


@pytest.mark.parametrize("pattern, query", [
    ("AKIA[A-Z0-9]+", [[{"aki", "kia"}]]),
    ("[0-9a-f]{24,}", []),
    ("(?i:ab|cde)x", [[{"abx"}, {"cde", "dex"}]]),
    ("(?i:ab|cde)+", []),
    ("a[bc]d.efg", [[{"abd"}, {"acd"}], [{"efg"}]]),
    ("(xyz)+", []),
    ("ab?cd", [[{"abc", "bcd"}, {"acd"}]]),
])
def test_trigram_queries(pattern, query):
    got = secrets.trigram_query(pattern)
    assert [sorted(map(sorted, run)) for run in got] == [sorted(map(sorted, run)) for run in query]


def test_queries_never_lose_a_match():
    """What a rule matches holds its trigrams, whatever the case."""
    for rule in secrets.BASE + secrets.MORE:
        query = secrets.trigram_query(rule.pattern)
        assert query or rule.name == "hex"
        for text in ODD_SECRETS:
            for match in re.finditer(rule.pattern, text):
                folded = match.group().lower()
                assert all(any(all(t in folded for t in alternative) for alternative in run) for run in query)
