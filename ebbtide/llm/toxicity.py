"""Toxicity by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features: densities of a lexicon of insults, of word beginnings learned from labelled rows, second-person words
near either, capitals, punctuation, and rates of obfuscated words. Labelled rows are dealt by a hash into three
folds: one for the learned lexicon, the first two for the trees, the last for the calibration, so the
calibration sees neither. Training uses a bounded sample of the labels; scoring is one pass over the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, functions as F

from ebbtide.session import materialise

from .common import bounded_batches, text_of, travels

#: Labelled rows that the model is fitted on at most, those with the smallest hashes.
SAMPLE = 20_000
#: Entries of the learned lexicon at most: the size of the model.
ENTRIES = 600
THRESHOLD = 0.7
SEED = 42

INSULTS = frozenset(
    "idiot idiots moron morons stupid stupidity dumb dumbass loser losers scum trash clown clowns pathetic worthless "
    "disgusting filthy garbage vermin imbecile cretin retard bastard bitch asshole shit fuck fucking whore slut pig "
    "hate kill die ugly useless shut freak jerk fool "
    "dumm dummkopf arschloch scheisse scheiße wichser hurensohn abschaum versager trottel "
    "connard connasse merde salope putain enculé crétin débile ordure abruti "
    "idiota estúpido imbécil mierda puta gilipollas cabrón basura pendejo asqueroso".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti usted ustedes vosotros vuestro".split()
)
PREFIXES = (4, 5, 6)
NEAR = 5
FEATURES = ["insults", "insult_count", "learned", "learned_count", "second_person", "second_person_near", "capitals",
            "shouted", "exclaimed", "questioned", "punctuation", "obfuscated", "masked_insults", "stretched", "words"]

WORDS = re.compile(r"[^\W\d_]+")
#: A word with signs or digits among its letters, as in id1ot, st*pid, i.d.i.o.t.
MASKED = re.compile(r"(?<![^\W_])[^\W\d_]+(?:[\d@$!*.|_-]+[^\W\d_]+)+(?![^\W_])")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
LEET = str.maketrans("013457@$!|", "oieastasil")
SIGNS = re.compile(r"[*._-]")


def row_features(text: str, learned: frozenset[str]) -> tuple[float, ...]:
    """The features of one text in the order of ``FEATURES``; an empty text has zeros."""
    lower = text.lower()
    words = WORDS.findall(lower)
    n, size = len(words), max(1, len(text))
    per = 100.0 / max(1, n)
    insults, found, person = [], [], []
    for i, word in enumerate(words):
        if word in INSULTS:
            insults.append(i)
        if word[:4] in learned or word[:5] in learned or word[:6] in learned or word in learned:
            found.append(i)
        if word in SECOND_PERSON:
            person.append(i)
    marks = set()
    for i in insults + found:
        marks.update(range(i - NEAR, i + NEAR + 1))
    masked = MASKED.findall(lower)
    unmasked = 0
    for word in masked:
        plain = word.translate(LEET)
        bare = SIGNS.sub("", plain)
        holes = SIGNS.split(plain)
        unmasked += bare in INSULTS or len(holes) > 1 and any(
            len(w) == len(plain) and w.startswith(holes[0]) and w.endswith(holes[-1]) for w in INSULTS)
    capitals = sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper())
    signs = sum(map(text.count, "!?.,;:'\"()-"))
    return (
        len(insults) * per, float(min(20, len(insults))), len(found) * per, float(min(20, len(found))),
        len(person) * per, float(min(20, sum(i in marks for i in person))), capitals / size, shouted * per,
        text.count("!") * per, text.count("?") * per, signs / size, len(masked) * per,
        float(min(20, unmasked)), len(STRETCHED.findall(lower)) * per, float(n),
    )


def features(docs: DataFrame, learned: frozenset[str], *columns: str) -> DataFrame:
    """``columns`` of ``docs`` and the features of its text."""
    # names of our own, so that no column of the caller meets a feature
    named = docs.select(*columns, text_of().alias("_text"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = pd.DataFrame([row_features(t, learned) for t in batch["_text"]], columns=[f"_f_{f}" for f in FEATURES])
            yield pd.concat([batch.drop(columns="_text"), made], axis=1)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in named.schema if f.name != "_text")
    made = ", ".join(f"_f_{f} double" for f in FEATURES)
    return named.mapInPandas(rows, f"{kept}, {made}" if kept else made)


def held_out(doc_id="doc_id"):
    """True for rows whose labels are never learned from."""
    number = F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8"))
    return number % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, label and fold of at most ``sample`` labelled rows that are not held out, stored.

    The labels drawn are those with the smallest hashes of doc_id; a document labelled twice is toxic if one
    label says so; labels that are null or lack a document don't count.
    """
    drawn = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    drawn = drawn.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    order = F.xxhash64(F.lit(SEED), "doc_id")
    drawn = drawn.select("doc_id", "label", order.alias("order")).orderBy("order", "doc_id").limit(sample)
    drawn = drawn.withColumn("fold", F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(5)))
    # at most ``sample`` rows of three numbers: this side is small by construction
    return materialise(docs.select("doc_id", text_of().alias("text")).join(
        F.broadcast(materialise(drawn, "labels")), "doc_id"), "training")


def learn_lexicon(rows: DataFrame, entries: int = ENTRIES) -> frozenset[str]:
    """Word beginnings of four to six letters, and whole words, that occur almost only in toxic rows."""
    toxic = rows.agg(F.sum("label")).first()[0] or 0
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    longer = F.filter(words, lambda w: F.length(w) >= min(PREFIXES))

    def beginnings(size: int):
        return F.transform(longer, lambda w: F.substring(w, 1, size))

    keys = [beginnings(size) for size in PREFIXES]
    keyed = rows.select("label", F.explode(F.array_distinct(F.concat(longer, *keys))).alias("key"))
    counts = keyed.groupBy("key").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
    sure = counts.filter((F.col("toxic") >= max(3, 0.01 * toxic)) & (F.col("toxic") / (F.col("n") + 0.5) >= 0.8))
    best = sure.orderBy(F.desc("toxic"), F.length("key"), "key").limit(entries).select("key").collect()
    return frozenset(r["key"] for r in best)


@dataclass
class Model:
    """What scoring needs; without trees (no rows of both labels) every score is ``prior``."""

    learned: frozenset[str]
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float


def assembled(table: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_f_{f}" for f in FEATURES], outputCol="_vector").transform(table)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, trees: int = 20, depth: int = 4) -> Model:
    """The model for ``docs``; with no usable labels the prior is 0."""
    bounded_batches(docs.sparkSession)
    rows = training_rows(docs, labels, sample)
    classes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    prior = classes.get(1.0, 0) / max(1, sum(classes.values()))
    learned = learn_lexicon(rows.filter("fold < 3"))
    table = materialise(assembled(features(rows, learned, "label", "fold")).select(
        "label", "fold", "_vector"), "features")
    fitted, checked = table.filter("fold < 4"), table.filter("fold = 4")
    if fitted.select("label").distinct().count() < 2:
        return Model(learned, None, None, prior)
    booster = GBTClassifier(featuresCol="_vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=SEED)
    model = booster.fit(fitted.coalesce(2))
    calibration = None
    if checked.select("label").distinct().count() == 2:
        raw = model.transform(checked).select("label", vector_to_array("probability")[1].alias("_raw"))
        calibration = IsotonicRegression(featuresCol="_raw", labelCol="label").fit(raw)
    return Model(learned, model, calibration, prior)


def score(docs: DataFrame, model: Model, *columns: str) -> DataFrame:
    """``columns`` of ``docs``, score and predicted; a row for every row, empty and null texts too.

    The calibrated value is a step function; a thousandth of the trees' own value orders rows on a step.
    """
    bounded_batches(docs.sparkSession)
    if model.trees is None:
        return docs.select(*columns, F.lit(model.prior).alias("score"),
                           F.lit(int(model.prior >= THRESHOLD)).alias("predicted"))
    made = model.trees.transform(assembled(features(docs, model.learned, *columns)))
    made = made.select(*columns, vector_to_array("probability")[1].alias("_raw"))
    value = F.col("_raw")
    if model.calibration is not None:
        made = model.calibration.setPredictionCol("_step").transform(made)
        value = 0.999 * F.col("_step") + 0.001 * F.col("_raw")
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), value))
    return made.select(*columns, value.alias("score"), (value >= THRESHOLD).cast("int").alias("predicted"))


travels(__name__)
