import re

from ebbtide.llm import licenses


def plain(text):
    units = text.split("\n") + [p for p in re.split(r"\n[\x20\x09-\x0D]*\n", text) if "\n" in p]
    found = {}
    for unit in units:
        own = set(licenses.bigrams_of(re.sub(r"(?im)^[^a-z0-9]*copyright\b[^\n]*$", "", unit)))
        for name, template in licenses.TEMPLATES.items():
            other = set(licenses.bigrams_of(template))
            score = 2 * len(own & other) / (len(own) + len(other))
            if score >= licenses.LEAST:
                n, best = found.get(name, (0, 0))
                found[name] = (n + 1, max(best, score))
    return sorted((name, n, round(s, 9)) for name, (n, s) in found.items())


def test_licenses_of_every_text(documents, odd_rows, prose):
    t = licenses.TEMPLATES
    rows = odd_rows + [
        (100, t["mit"]), (101, "Copyright (c) 2020 Somebody\n" + t["mit"].replace(". ", ".\n").replace(", to", ",\n to")),
        (102, prose(1, 100) + "\nreleased under the MIT license!\n" + prose(2, 50) + "\nReleased under the MIT License."),
        (103, prose(1, 30) + " " + t["mit-line"]), (104, t["gpl-3.0-line"].upper() + "\n\n" + t["cc-by-nc-4.0-line"]),
        (105, t["apache-2.0-notice"] + " and some more words that change little"), (106, "word"), (107, prose(5, 20_000)),
        (None, t["unlicense"]), (100, "nothing of the kind")]
    rows += [(200 + i, text) for i, text in enumerate(t.values())]
    found = licenses.scan(documents(rows)).collect()
    got = sorted(((r.doc_id, [(x.license, x.units, round(x.score, 9)) for x in r.licenses]) for r in found), key=repr)
    assert got == sorted(((i, plain(text or "")) for i, text, *_ in rows), key=repr)
    assert licenses.scan(documents([])).count() == 0


def test_templates_are_told_apart():
    for name, text in licenses.TEMPLATES.items():
        assert max(plain(text), key=lambda found: found[2])[0] == name


def runs(text, template):
    """The best score over all runs of words, by trying each."""
    words = re.findall("[a-z0-9]+", re.sub(r"(?im)^[^a-z0-9]*copyright\b[^\n]*$", "", text).lower())
    pairs, other = [f"{a} {b}" for a, b in zip(words, words[1:])], set(licenses.bigrams_of(template))
    longest = int(len(other) * (2 - licenses.LEAST) / licenses.LEAST + 1e-9)
    return max((2 * len(other & set(pairs[i:j])) / (len(other) + len(set(pairs[i:j])))
                for i in range(len(pairs)) for j in range(i + 1, min(len(pairs), i + longest) + 1)), default=0)


def test_passages_over_lines_and_paragraphs(documents, odd_rows, prose):
    t = licenses.TEMPLATES
    gpl = t["gpl-3.0-notice"].replace(" This program is dist", "\n\n    This program is dist").replace(" See the", "\n\n See the")
    bsd = t["bsd-2-clause"].replace(" 1. ", "\n\n1. ").replace(" 2. ", "\n\n2. ")
    apache = t["apache-2.0-notice"].replace(" You may", "\nYou may").replace(" http", "\n\n    http").replace(" Unless", "\n\nUnless")
    rows = odd_rows + [
        (100, gpl), (101, "Copyright (c) 2020, Jane Doe\n\n" + bsd), (102, prose(1, 300) + "\n" + apache + "\n" + prose(2, 300)),
        (103, "This project was written by Jane Doe in 2019. Released under the MIT License."), (104, prose(1, 30) + " " + t["mit-line"]),
        (105, t["isc"].replace("software", "program").replace("fee", "any fee")), (106, prose(3, 500)), (100, gpl)]
    rows += [(107, "Copyright (c) 2021 Jane Doe\n\n" + t["mit-text"].replace(" THE SOFT", "\n\nTHE SOFT") + "\n\n" + prose(4, 200))]
    found = sorted((r.doc_id, r.license, round(r.score, 9)) for r in licenses.passages(documents(rows)).collect())
    every = licenses.in_texts(documents(rows)).collect()
    assert sorted((r.doc_id for r in every), key=repr) == sorted((i for i, *_ in rows), key=repr)
    assert sorted((r.doc_id, x.license, round(x.score, 9)) for r in every for x in r.licenses) == found
    assert licenses.in_texts(documents([])).collect() == []
    want = [(i, name, round(runs(text, t[name]), 9)) for i, text, *_ in rows if i is not None and text for name in t]
    assert found == sorted(w for w in want if w[2] >= licenses.LEAST)
    assert {(100, "gpl-3.0-notice", 1.0), (101, "bsd-2-clause", 1.0), (102, "apache-2.0-notice", 1.0), (103, "mit-line", 1.0),
            (104, "mit-line", 1.0), (107, "mit-text", 1.0), (107, "mit", 1.0)} <= set(found)
