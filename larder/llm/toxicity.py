"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled."""

from __future__ import annotations

import math
import re
import warnings
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from larder.functions import column
from larder.llm.common import bounded_batches, map_batches, release, saved, slices, small, text_of, without

FEATURES = 20_000
LEAST_DOCUMENTS = 5
ROUNDS = 100
LEAST_CHANGE = 2e-4
LEAST_WORDS = 6
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")
MEMO_WORDS = 200_000
COUNTED = 300_000


def features_of(word: str) -> tuple[str, ...]:
    """A word and its stems, so that forms never seen in a labelled text count too."""
    return (word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n))


def remembered(function, most: int = MEMO_WORDS):
    """The function of a word, looked up for words met before."""
    memo: dict = {}

    def look(word: str):
        found = memo.get(word)
        if found is None:
            if len(memo) >= most:
                memo.clear()
            found = memo[word] = function(word)
        return found

    return look


def sentences_of(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and lower-case words of each sentence.

    Sentences of fewer than six words are read together with those after them, or thousands
    of one-word exclamations would each add a little to a document's score.
    """
    found: list[tuple[int, int, list[str]]] = []
    start, words = -1, []
    for match in SENTENCE.finditer(text):
        more = WORD.findall(match.group().lower())
        if more:
            start = match.start() if start < 0 else start
            end = match.end()
            words += more
            if len(words) >= LEAST_WORDS:
                found.append((start, end, words))
                start, words = -1, []
    if words:
        found.append((start, end, words))
    return found


def count_features():
    """A function for ``mapInArrow``: a task's document counts of each feature, by label.

    Counts are passed on whenever there are many, which bounds a task's memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = remembered(features_of, MEMO_WORDS // 4)
        clean, toxic = Counter(), Counter()

        def passed_on() -> pa.RecordBatch:
            names = list(clean.keys() | toxic.keys())
            counts = [pa.array([found[name] for name in names], pa.int64()) for found in (clean, toxic)]
            clean.clear()
            toxic.clear()
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *counts], ["feature", "clean", "toxic"])

        for batch in (part for whole in batches for part in slices(whole, 1 << 20)):
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist()):
                words = set(WORD.findall(text.lower()))
                (toxic if label else clean).update({*chain.from_iterable(map(features, words))})
            if len(clean) + len(toxic) > COUNTED:
                yield passed_on()
        yield passed_on()
        del features
        release()

    return run


def informative(train: DataFrame, n_clean: int, n_toxic: int, limit: int) -> DataFrame:
    """At most ``limit`` features that tell the labels apart best (G test), with their log odds.

    Grades, 64 to a doubling of the gain, are counted first, so that no more reach the driver.
    """
    counts = (
        train.select("text", "toxic")
        .mapInArrow(count_features(), "feature string, clean bigint, toxic bigint")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS)
    )
    share = n_toxic / (n_clean + n_toxic)
    seen = F.col("clean") + F.col("toxic")
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    gain = part(F.col("toxic"), seen * share) + part(F.col("clean"), seen * (1 - share))
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    graded = F.floor(F.log2("gain") * 64).cast("int").alias("grade")
    rows = counts.select("feature", gain.alias("gain"), odds.alias("odds")).where("gain > 4")
    rows = saved(rows.select("feature", "odds", graded), "toxic-odds")
    least, found = 0, 0
    for row in rows.groupBy("grade").agg(F.count("*").alias("n")).orderBy(F.desc("grade")).collect():
        found += row["n"]
        if found > limit:
            least = row["grade"] + 1
            break
    return rows.where(F.col("grade") >= least).orderBy("feature")


def sentence_features(index: dict[str, int]):
    """Per document: the chosen features of the distinct words of each sentence, sentence
    after sentence, and how many each has."""

    def make():
        ids = remembered(lambda word: tuple(index[f] for f in features_of(word) if f in index), MEMO_WORDS // 4)

        def work(batch: pa.RecordBatch) -> list:
            lists, sizes = [], []
            for text in batch["text"].to_pylist():
                per = [[*chain.from_iterable(map(ids, dict.fromkeys(words)))] for _, _, words in sentences_of(text)]
                lists.append([*chain.from_iterable(per)])
                sizes.append([len(one) for one in per])
            return [batch["toxic"], lists, sizes]

        return work

    return make


def gradient(weights: np.ndarray, bias: float):
    """A function for ``mapInArrow``: a task's loss gradient, one row per feature it met.

    A document is toxic unless every sentence is clean: P = 1 - prod(1 - p). The loss is the
    log loss of P; index -1 is the bias, -2 the loss itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights))
        at_bias = loss = 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.asarray(batch["sizes"].flatten(), np.int64)
            per_doc = np.diff(np.asarray(batch["sizes"].offsets)).astype(np.int64)
            ids = np.asarray(batch["ids"].flatten(), np.int64)
            sentence = np.repeat(np.arange(len(sizes)), sizes)
            doc = np.repeat(np.arange(batch.num_rows), per_doc)
            z = bias + np.bincount(sentence, weights[ids], len(sizes))
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            clean = np.bincount(doc, np.log1p(-p), batch.num_rows)  # log(1 - P)
            toxic = np.asarray(batch["toxic"], np.int64) == 1
            whole = np.maximum(-np.expm1(clean), 1e-9)
            loss += float(np.where(toxic, -np.log(whole), -clean).sum())
            pull = np.where(toxic, -np.exp(clean) / whole, 1.0)
            step = pull[doc] * p
            total += np.bincount(ids, step[sentence], len(weights))
            at_bias += float(step.sum())
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(np.concatenate([met, [-1, -2]]).astype(np.int32)),
                "g": pa.array(np.concatenate([total[met], [at_bias, loss]])),
            }
        )

    return run


def fit_toxicity(
    labelled: DataFrame,
    text_col: str = "text",
    label_col: str = "toxic",
    features: int = FEATURES,
    rounds: int = ROUNDS,
    least_change: float = LEAST_CHANGE,
) -> dict[str, float]:
    """Weights of words and stems, and the bias under the empty name, from labelled documents.

    All labelled rows are used. At most ``features`` features are kept, so that is all the
    driver ever holds; each gradient step is one pass over the rows' chosen features. Steps end
    when one changes the mean loss by less than ``least_change``, or after ``rounds``, with a
    warning. Rows with a null label are left out, null texts are empty. Without both
    labels there is nothing to learn, and every score is 0.
    """
    bounded_batches(labelled.sparkSession)
    label = column(label_col).cast("int")
    train = labelled.select(text_of(text_col).alias("text"), label.alias("toxic")).where("toxic in (0, 1)")
    train = saved(train, "toxic-train")
    by_label = {row["toxic"]: row["n"] for row in train.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(by_label) < 2:
        return {"": -30.0}
    n = sum(by_label.values())
    chosen = informative(train, by_label[0], by_label[1], features).collect()
    names = [row["feature"] for row in chosen]
    if not names:
        return {"": -30.0}
    index = {name: i for i, name in enumerate(names)}
    schema = "toxic int, ids array<int>, sizes array<int>"
    rows = saved(map_batches(train, schema, sentence_features(index)), "toxic-features")
    weights = np.array([row["odds"] for row in chosen]) * 0.5
    bias = -6.0
    speed, at_bias = np.zeros(len(names)), 0.0
    before = math.inf
    for _ in range(rounds):
        parts = rows.mapInArrow(gradient(weights, bias), "i int, g double").groupBy("i").agg(F.sum("g").alias("g"))
        slope = {row["i"]: row["g"] for row in parts.collect()}
        loss = slope.get(-2, 0.0) / n
        if abs(before - loss) < least_change:
            break
        before = loss
        g = np.zeros(len(names))
        for i, value in slope.items():
            if i >= 0:
                g[i] = value / n
        g += 1e-5 * weights
        b = slope.get(-1, 0.0) / n
        speed += g * g
        at_bias += b * b
        weights = weights - 0.4 * g / (np.sqrt(speed) + 1e-8) * (np.abs(g) > 1e-7)
        bias = bias - 0.3 * b / (math.sqrt(at_bias) + 1e-8)
    else:
        warnings.warn(f"the mean loss still moves after {rounds} steps", stacklevel=2)
    return dict(zip(names, weights.tolist())) | {"": bias}


def scorer(model: dict[str, float], names: list[str]):
    """Score, and the start, end and score of every sentence that alone would be called toxic."""

    def make():
        bias = model[""]
        weight = remembered(lambda word: sum(model.get(f, 0.0) for f in features_of(word)))

        def work(batch: pa.RecordBatch) -> list:
            scores, spans = [], []
            for text in batch["larder_text"].to_pylist():
                clean, found = 0.0, []
                for start, end, words in sentences_of(text):
                    z = bias + sum(map(weight, dict.fromkeys(words)))
                    p = 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))
                    clean += math.log1p(-p)
                    if p >= 0.5:
                        found.append({"start": start, "end": end, "score": p})
                scores.append(min(1.0, max(0.0, -math.expm1(clean))))
                spans.append(found)
            return [*[batch[name] for name in names], scores, spans]

        return work

    return make


def score_toxicity(df: DataFrame, model: dict[str, float], text_col: str = "text") -> DataFrame:
    """Add ``score``, the noisy-or of all sentences' scores, and ``sentences``, the offending
    ones as code point spans with scores.

    Whole texts are read. A text without words, empty or null, has no sentence: score 0.
    Every row is scored by itself, so repeated rows give repeated results and an empty table
    an empty one. Input columns named ``score`` or ``sentences``, in whatever case, are replaced; the name
    ``larder_text`` is reserved.
    """
    added = "score double, sentences array<struct<start: int, end: int, score: double>>"
    fields = without(df, ("score", "sentences"))
    schema = T.StructType([*fields, *T.StructType.fromDDL(added).fields])
    names = [field.name for field in fields]
    return map_batches(df.withColumn("larder_text", text_of(text_col)), schema, scorer(model, names))


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; a null id is held out."""
    rest = F.crc32(column(id_col).cast("string").cast("binary")) % 5
    return F.coalesce(rest == 0, F.lit(True))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Text and label of the rows that may be learnt from.

    A document that ``labels`` lists twice with different labels is left out.
    """
    marks = (
        labels.where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("larder_most"))
        .where("toxic = larder_most")
        .select(F.col("doc_id").alias("larder_id"), F.col("toxic").alias("larder_toxic"))
    )
    marks = small(saved(marks.where(~held_out("larder_id")), "toxic-labels"))
    joined = docs.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("larder_id"))
    return joined.select("text", F.col("larder_toxic").alias("toxic"))


def learnt(spark: SparkSession, docs: DataFrame, sf_dir: str) -> dict[str, float]:
    return fit_toxicity(labelled_rows(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_toxicity(docs, learnt(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "sentences",
    )
