"""Repeated passages: runs of consecutive sentences that occur in more than one place."""

from __future__ import annotations

import re
from itertools import accumulate
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import key_of, map_batches, saved, text_of

RUN = 3
RUN_WORDS = 15
LONGEST = 16
NEAR = 3
# Scripts written without spaces, a character of which counts as a word
WIDE = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
STOPS = ".!?\u3002\uff01\uff1f\uff61"
SENTENCE = re.compile(rf"[^\s{STOPS}][^{STOPS}\n]*[{STOPS}]*|[{STOPS}]+")
WORD = re.compile(rf"[{WIDE}]|[^\s{WIDE}]+")
IS_WIDE = re.compile(f"[{WIDE}]")


def pieces_of(words: list[str]) -> list[int]:
    """Where the pieces of a long sentence begin: at its start, at each word whose hash is the
    least among its ``NEAR`` neighbours on either side, and 16 words after another piece at
    the latest. The words around decide, not their number from the start, so a passage has
    the same pieces wherever it stands."""
    import xxhash

    code = xxhash.xxh32_intdigest
    past = [1 << 32] * NEAR
    codes = [*past, *map(code, words), *past]
    shifted = [codes[k : k + len(words)] for k in range(2 * NEAR + 1)]
    starts = [0]
    for i, around in enumerate(zip(*shifted)):
        if i and (around[NEAR] == min(around) or i - starts[-1] == LONGEST):
            starts.append(i)
    return starts


def sentences_of(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, words, normal form) of each sentence.

    A sentence ends at a full stop, exclamation or question mark or at the end of the line.
    One of more than 16 words counts as several, cut by its content, so that a passage
    without full stops or one that begins within a sentence has sentences too. The normal
    form is in lower case with single spaces.
    """
    found = []
    words_of = WORD.findall if not text.isascii() and IS_WIDE.search(text) else str.split
    for match in SENTENCE.finditer(text):
        words = words_of(match.group().lower())
        if len(words) <= LONGEST:
            found.append((match.start(), match.end(), len(words), " ".join(words)))
            continue
        places = [m.span() for m in WORD.finditer(text, match.start(), match.end())]
        words = [text[start:end].lower() for start, end in places]
        starts = pieces_of(words)
        for i, end in zip(starts, [*starts[1:], len(words)]):
            found.append((places[i][0], places[end - 1][1], end - i, " ".join(words[i:end])))
    return found


def runs_of(sentences: list[tuple[int, int, int, str]], run: int, run_words: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, sentence after the last, hash) of each run.

    From every sentence on, the shortest run of at least ``run`` sentences and ``run_words``
    words; a few very short sentences are no passage.
    """
    import xxhash

    n = len(sentences)
    before = [0, *accumulate(map(itemgetter(2), sentences))]
    digest = xxhash.xxh3_128_digest
    hashes = [digest(s[3]) for s in sentences]
    found = []
    end = 0
    for i in range(n):
        end = max(end, i + run)
        while end <= n and before[end] - before[i] < run_words:
            end += 1
        if end > n:
            break
        found.append((i, end, digest(b"".join(hashes[i:end]))))
    return found


def repeated(df: DataFrame, id_col: str, text_col: str, run: int, run_words: int) -> DataFrame:
    """``(doc, part, firsts)``: the runs of each document that an earlier document has.

    ``part`` is the checksum of the text, ``firsts`` are the numbers of the runs' first
    sentences, sorted. Runs are counted by hash before they are shuffled, so a passage that
    a third of all documents share is one row per task; the join that finds its other
    places again can be split.
    """
    import zlib

    def make():
        def work(batch: pa.RecordBatch) -> list:
            highs, lows, docs, parts, firsts = [], [], [], [], []
            for doc, text in zip(batch["doc"].to_pylist(), batch["text"].to_pylist()):
                seen = set()
                part = zlib.crc32(text.encode("utf-8", "surrogatepass"))
                for first, _, code in runs_of(sentences_of(text), run, run_words):
                    if code not in seen:
                        seen.add(code)
                        highs.append(int.from_bytes(code[:8], "little", signed=True))
                        lows.append(int.from_bytes(code[8:], "little", signed=True))
                        docs.append(doc)
                        parts.append(part)
                        firsts.append(first)
            return [highs, lows, docs, parts, firsts]

        return work

    rows = df.select(key_of(id_col, text_of(text_col)).alias("doc"), text_of(text_col).alias("text"))
    spans = map_batches(rows, "high bigint, low bigint, doc bigint, part bigint, first int", make)
    spans = saved(spans, "spans")
    again = saved(
        spans.groupBy("high", "low")
        .agg(F.count("*").alias("n"), F.min("doc").alias("owner"))
        .where("n > 1")
        .drop("n"),
        "spans-again",
    )
    hits = spans.join(again, ["high", "low"]).where("doc > owner")
    return hits.groupBy("doc", "part").agg(F.sort_array(F.collect_set("first")).alias("firsts"))


def without_repeats(text: str, firsts: list[int], run: int, run_words: int) -> tuple[str, list[tuple[int, int]]]:
    """The text without the covered sentences, and the stretches that were taken out."""
    sentences = sentences_of(text)
    gone, seen = set(), set()
    earlier = set(firsts)
    for first, end, code in runs_of(sentences, run, run_words):
        if first in earlier or code in seen:
            gone.update(range(first, end))
        seen.add(code)
    if not gone:
        return text, []
    cut: list[tuple[int, int]] = []
    for i in sorted(gone):
        start = sentences[i][0]
        end = sentences[i + 1][0] if i + 1 < len(sentences) else len(text)
        if cut and cut[-1][1] == start:
            cut[-1] = (cut[-1][0], end)
        else:
            cut.append((start, end))
    kept, at = [], 0
    for start, end in cut:
        kept.append(text[at:start])
        at = end
    kept.append(text[at:])
    return "".join(kept), cut


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    run: int = RUN,
    run_words: int = RUN_WORDS,
) -> DataFrame:
    """``(doc_id, text, removed, n_removed)``: texts without the sentences that any repeated
    run covers, unless it is the run's first place.

    A run is ``run`` consecutive sentences, or more if they have fewer than ``run_words``
    words. Its first place is in the document with the least id, there the first one.
    ``removed`` lists the code point stretches taken out, with the white space after them.
    Texts too short for a run stay as they are; null and empty texts give empty texts. Rows
    listed twice with the same id and text are one document and give equal rows; texts that
    share an id are parts of one document, which keep what only they share; a row without an
    id comes before all others. An empty table gives an empty table.
    """
    firsts = repeated(df, id_col, text_col, run, run_words)
    text = text_of(text_col)
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(column(id_col).alias("id"), text.alias("text"), key_of(id_col, text).alias("key"))
    rows = rows.withColumn("sum", F.crc32(F.col("text").cast("binary")))
    joined = rows.join(firsts, (F.col("key") == F.col("doc")) & (F.col("sum") == F.col("part")), "left")

    def make():
        def work(batch: pa.RecordBatch) -> list:
            texts, cuts, sizes = [], [], []
            for text, firsts in zip(batch["text"].to_pylist(), batch["firsts"].to_pylist()):
                left, cut = without_repeats(text, firsts or [], run, run_words)
                texts.append(left)
                cuts.append([{"start": a, "end": b} for a, b in cut])
                sizes.append(len(text) - len(left))
            return [batch["id"], texts, cuts, sizes]

        return work

    schema = f"{id_col} {kind}, text string, removed array<struct<start: int, end: int>>, n_removed bigint"
    return map_batches(joined.select("id", "text", "firsts"), schema, make)


def op10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs)
