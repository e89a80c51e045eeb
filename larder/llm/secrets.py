"""Secrets in texts: known formats, and values in credential contexts that are hard to guess."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import map_batches, saved, text_of

# The formats searched for
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CONTEXT = re.compile(
    r"""(?ai:(?<![a-z])(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|login|api[_-]?key|private[_-]?key))"""
    r"""["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*["']?([^\s"'<>,;]{6,})"""
)
KINDS = ("assign", "access", "hex", "guess")

# Keyboard rows and frequent passwords, most frequent first
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
COMMON = (
    "password", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "master", "login",
    "abc", "iloveyou", "sunshine", "princess", "football", "baseball", "shadow", "secret", "test",
    "guest", "root", "user", "changeme", "default", "example", "sample", "dummy", "none", "null",
    "true", "false", "your", "token", "key", "value", "pass", "word", "hello", "super", "love",
)

WORDS = 20_000
LONGEST_WORD = 20
LONGEST_PERIOD = 1000
MONTH, DAY, SEP = r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])", r"[-/._]?"
DATE = re.compile(
    rf"(?:19|20)\d\d(?:{SEP}{MONTH}(?:{SEP}{DAY})?)?|(?:{DAY}{SEP}{MONTH}|{MONTH}{SEP}{DAY}|{MONTH}){SEP}(?:19|20)\d\d"
)
LEET = str.maketrans("4301578$@", "aeoistbsa")
LEAST_LOG_GUESSES = 8.0


def keyboard() -> dict[str, set[str]]:
    """Which keys lie side by side."""
    near: dict[str, set[str]] = {}
    for y, row in enumerate(ROWS):
        for x, key in enumerate(row):
            around = row[max(0, x - 1) : x] + row[x + 1 : x + 2]
            for other in ROWS[max(0, y - 1) : y] + ROWS[y + 1 : y + 2]:
                around += other[max(0, x - 1) : x + 2]
            near[key] = set(around)
    return near


def brute(text: str) -> float:
    """The logarithm of the number of strings of this length and these kinds of character."""
    size = 26 * any("a" <= c <= "z" for c in text) + 26 * any("A" <= c <= "Z" for c in text)
    size += 10 * any("0" <= c <= "9" for c in text) + 33 * any(not (c.isascii() and c.isalnum()) for c in text)
    return len(text) * math.log10(max(1, size))


def log_guesses(value: str, ranks: dict[str, int], near: dict[str, set[str]] | None = None) -> float:
    """The logarithm of the fewest guesses that reach ``value``.

    ``best[i]`` is the cheapest way to write the first i characters as words, dates, repeats,
    keyboard walks and single characters tried one by one; each segment multiplies the
    guesses, and a further segment costs a factor of 2 for its place. Walks and runs of one
    character may begin anywhere, dates be written in any order, and repeats have any period
    up to 1,000, which keeps the work in proportion to the length.
    """
    near = near or keyboard()
    n = len(value)
    lower = value.lower()
    plain = lower.translate(LEET)
    per_char = brute(value) / max(1, n)
    best = [0.0] + [math.inf] * n
    walk = same = 0
    walked = math.inf  # the cheapest way whose last segment is a walk that ends here
    codes = np.array([ord(c) for c in lower], np.int32)
    periods = np.arange(1, min(n, LONGEST_PERIOD) + 1)
    repeats = np.zeros(len(periods), np.int64)  # characters up to here that equal the one a period before
    reached = np.full(n + 1, math.inf)  # best, as an array
    reached[0] = 0.0
    for i in range(1, n + 1):
        best[i] = best[i - 1] + per_char
        for size in range(3, min(i, LONGEST_WORD) + 1):
            start = i - size
            for text, more in ((lower, 0.0), (plain, math.log10(2))):
                rank = ranks.get(text[start:i])
                if rank is not None:
                    upper = value[start:i] != lower[start:i]
                    best[i] = min(best[i], best[start] + math.log10(2 * (rank + 1)) + more + upper * math.log10(4))
        for size in (10, 9, 8, 7, 6, 4):
            if size <= i and DATE.fullmatch(lower, i - size, i):
                ways = 1 if lower[i - size : i - size + 4].startswith(("19", "20")) else 2  # day or month first
                best[i] = min(best[i], best[i - size] + math.log10(2 * 100 * ways * (12 if size > 5 else 1) * (31 if size > 7 else 1)))
        same = same + 1 if i > 1 and lower[i - 1] == lower[i - 2] else 0
        # a segment before can end at most a word's length into the run
        for run in range(max(2, same - LONGEST_WORD), same + 1):
            best[i] = min(best[i], best[i - run - 1] + math.log10(2 * 36 * (run + 1)))
        step = i > 1 and (lower[i - 1] in near.get(lower[i - 2], ()) or abs(ord(lower[i - 1]) - ord(lower[i - 2])) == 1)
        walk = walk + 1 if step else 0
        walked = walked + math.log10(3) if walk > 3 else math.inf
        if walk >= 3:
            walked = min(walked, best[i - 4] + math.log10(2 * 36) + 3 * math.log10(3))
            best[i] = min(best[i], walked)
        many = min(i - 1, len(periods))
        repeats[:many] = (repeats[:many] + 1) * (codes[i - 1 - many : i - 1][::-1] == codes[i - 1])
        twice = periods[1:many][repeats[1:many] >= periods[1:many]]
        if len(twice):
            best[i] = min(best[i], float(reached[i - twice].min()) + math.log10(2))
        reached[i] = best[i]
    return best[n]


def spans_of(text: str, ranks: dict[str, int], near: dict[str, set[str]], least: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every span, in order."""
    found = []
    low = text.lower()
    if any(word in low for word in ("passw", "secret", "token", "api_key", "apikey")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base = list(found)
    if ("=" in text or ":" in text) and any(
        word in low for word in ("pass", "pwd", "secret", "token", "credential", "auth", "login", "key")
    ):
        for match in CONTEXT.finditer(text):
            start, end = match.span(1)
            if any(start < b and a < end for a, _, b in base):
                continue
            if log_guesses(match.group(1), ranks, near) >= least:
                found.append((start, 3, end))
    return sorted(found)


def frequent_words(df: DataFrame, text_col: str = "text", words: int = WORDS) -> dict[str, int]:
    """At most ``words`` of the most frequent words of 3 to 20 letters a-z, with their ranks.

    How many words occur how often is counted first; only words above the frequency at which
    there are few enough reach the driver.
    """
    split = F.explode(F.split(F.lower(text_of(text_col)), "[^a-z]+")).alias("word")
    counts = df.select(split).where(f"length(word) between 3 and {LONGEST_WORD}").groupBy("word")
    counts = saved(counts.agg(F.count("*").alias("n")).where("n > 1"), "word-counts")
    least, found = 2, 0
    for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).toLocalIterator():
        found += row["words"]
        if found > words:
            least = row["n"] + 1
            break
    top = counts.where(F.col("n") >= least).collect()
    corpus = [row["word"] for row in sorted(top, key=lambda row: (-row["n"], row["word"]))]
    return {word: rank for rank, word in reversed(list(enumerate([*COMMON, *corpus])))}


def find_secrets(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = LEAST_LOG_GUESSES,
    words: int = WORDS,
) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans)`` of every row.

    ``spans`` lists kind:start:end (code points) by start, then kind. ``assign``, ``access``
    and ``hex`` are known formats; ``guess`` is a value after a word such as "password" that
    lies in none of those spans and whose cheapest segmentation takes at least 10 ** ``least``
    guesses. Words cost their rank among the corpus's ``words`` most frequent ones. Whole
    texts are read; a null or empty text has no spans (and the hash of the empty string).
    Rows are treated one by one, repeated ones too.
    """
    ranks = frequent_words(df, text_col, words)
    kind = df.schema[id_col].dataType.simpleString()

    def make():
        near = keyboard()

        def work(batch: pa.RecordBatch) -> list:
            counts: list[list[int]] = [[], [], [], []]
            hashes, joined = [], []
            for text in batch["larder_text"].to_pylist():
                spans = spans_of(text, ranks, near, least)
                for i, column_of in enumerate(counts):
                    column_of.append(sum(1 for span in spans if span[1] == i))
                named = [(k, f"{KINDS[k]}:{a}:{b}") for a, k, b in spans]
                base = ",".join(name for k, name in named if k < 3)
                hashes.append(hashlib.sha256(base.encode()).hexdigest())
                joined.append(",".join(name for _, name in named))
            return [batch["larder_id"], *counts, hashes, joined]

        return work

    texts = df.select(column(id_col).alias("larder_id"), text_of(text_col).alias("larder_text"))
    schema = f"{id_col} {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, base_sha256 string, spans string"
    return map_batches(texts, schema, make)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_secrets(docs)
