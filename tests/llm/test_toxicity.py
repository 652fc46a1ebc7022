import zlib

from ebbtide.llm import toxicity
from ebbtide.llm.common import read


def test_features_of_odd_texts(odd_rows):
    for _, text, *_ in odd_rows:
        assert len(toxicity.row_features(text or "", frozenset())) == len(toxicity.FEATURES)
    names = dict(zip(toxicity.FEATURES, toxicity.row_features("You IDIOT!! st*pid id1ot sooo bad", frozenset({"badl", "bad"}))))
    assert names["insult_count"] == 1 and names["learned_count"] == 1 and names["second_person_near"] == 1
    assert names["masked_insults"] == 2 and names["stretched"] > 0 and names["shouted"] > 0


def test_learns_words_and_scores_all_rows(spark, documents, odd_rows, prose):
    rows = [(i, prose(i, 40) + (" thou vexling art vexlous" if i % 5 == 0 else "")) for i in range(600)]
    docs = documents(rows + odd_rows)
    labels = spark.createDataFrame(
        [(i, int(i % 5 == 0)) for i in range(600)] + [(5, 0), (77777, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert "vexl" in model.learned
    found = toxicity.score(docs, model, "doc_id", "kept").collect()
    assert len(found) == len(rows) + len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)
    by_id = {r.doc_id: r.predicted for r in found if r.doc_id is not None and r.doc_id > 9}
    held = [i for i in range(10, 600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(by_id[i] == int(i % 5 == 0) for i in held) / len(held) > 0.97


def test_labels_held_out_are_not_learned_from(spark, documents):
    docs = documents([(i, "some text") for i in range(90)])
    labels = spark.createDataFrame([(i, 1) for i in range(90)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels).collect()
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 for r in rows)
    assert len(toxicity.training_rows(docs, labels, 7).collect()) == 7


def test_nothing_to_learn_from(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents([(1, "a"), (2, None)])
    assert [(r.score, r.predicted) for r in toxicity.score(docs, toxicity.fit(docs, none), "doc_id").collect()] == [(0.0, 0)] * 2
    empty = documents([])
    assert toxicity.score(empty, toxicity.fit(empty, none), "doc_id").count() == 0


def test_accuracy_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), "doc_id").join(labels, "doc_id").filter(toxicity.held_out()).collect()
    positive = [r.score for r in scored if r.toxic]
    negative = [r.score for r in scored if not r.toxic]
    auc = sum((p > n) + (p == n) / 2 for p in positive for n in negative) / (len(positive) * len(negative))
    assert auc > 0.75
