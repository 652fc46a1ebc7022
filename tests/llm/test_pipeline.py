"""The stages one after the other, each against a plain version of what it does to its own input."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ebbtide.llm import mixing, toxicity

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, score double"


def folder_of(spark, tmp_path, rows):
    """A folder with these documents and the labels of the test data."""
    folder = str(tmp_path)
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def fingerprint(text):
    words = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values):
    """The classes of values within four bits of each other, by looking at all pairs."""
    left, found = set(values), []
    while left:
        ring, own = [left.pop()], set()
        while ring:
            one = ring.pop()
            own.add(one)
            near = {v for v in left if (v ^ one).bit_count() <= 4}
            left -= near
            ring += near
        found.append(own)
    return found


def as_rows(df):
    return Counter(tuple(r) for r in df.select([c.split()[0] for c in COLUMNS.split(", ")]).collect())


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage; odd texts, null ids, repeated rows and clashing names among the input."""
    given = [(*r, "mine", 7, 0.5) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    odd = [None, "", " \n\t", "one", "a b\x0bc\x0cd", "é ß 漢字 \U0001f600 x", "#*$%&|<>", "The the THE the the"]
    given += [(5000 + i, t, "en", "s" if i % 2 else None, None, "mine", i, None) for i, t in enumerate(odd)]
    given += [(None, "a text without an id", None, None, None, None, None, None), given[3], given[3]]
    given += [(6000 + i, given[i][1] + " tail", *given[i][2:]) for i in range(10)]
    given += [(7000, "word " * 5000, "en", "s", 1, "mine", 7, 0.5)]
    folder = folder_of(spark, tmp_path_factory.mktemp("docs"), given)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        out[name] = docs, (docs := spark.read.parquet(path))
    return folder, out


def test_only_documents_called_toxic_go(spark, stages):
    folder, out = stages
    before, after = out["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{folder}/labels.parquet"))
    ids = before.withColumn("row", F.monotonically_increasing_id())
    verdicts = {r["row"]: r.predicted for r in toxicity.score(ids, model, "row").collect()}
    kept = Counter(tuple(r)[:-1] for r in ids.collect() if not verdicts[r["row"]])
    assert as_rows(after) == kept and after.columns == before.columns
    # the model learns from six toxic rows here, too few for a claim about its accuracy
    assert 0 < after.count() < before.count()


def test_one_of_equal_texts_stays(stages):
    before, after = stages[1]["exact_dedup"]
    best = defaultdict(lambda: -1)
    for row in before.collect():
        best[row.text or ""] = max(best[row.text or ""], -1 if row.doc_id is None else row.doc_id)
    left = [(r.text or "", -1 if r.doc_id is None else r.doc_id) for r in after.collect()]
    assert sorted(left) == sorted(best.items()) and after.columns == before.columns
    assert not as_rows(after) - as_rows(before)


def test_one_of_near_copies_stays(stages):
    before, after = stages[1]["simhash_near_dedup"]
    classes = groups([fingerprint(r.text) for r in before.collect()])
    left = [fingerprint(r.text) for r in after.collect()]
    assert len(left) == len(classes) < before.count() and all(sum(v in c for v in left) == 1 for c in classes)
    assert not as_rows(after) - as_rows(before) and after.columns == before.columns


def test_rows_are_repeated_as_planned(stages):
    before, after = stages[1]["mixing"]
    times = {r.doc_id: r.n_copies for r in mixing.plan(before).collect()}
    want = Counter({row: n * times[row[0]] for row, n in as_rows(before).items() if times[row[0]]})
    assert as_rows(after) == want and after.columns == before.columns and max(times.values()) <= 3


def test_every_token_lies_in_one_piece(stages):
    before, after = stages[1]["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for row in before.collect():
        want[row.doc_id] += len(tokenizer.encode(row.text or "", add_special_tokens=False).ids) + 1
    pieces, got, sequences = after.collect(), Counter(), defaultdict(list)
    for piece in pieces:
        got[piece.doc_id] += piece.length
        sequences[piece.sequence_id].append((piece.offset, piece.length))
    assert got == want
    for own in sequences.values():
        ends = 0
        for offset, length in sorted(own):
            assert offset == ends
            ends += length
        assert ends <= 1024


def test_no_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder_of(spark, tmp_path, [])).count() == 0
