"""Best-fit packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import map_batches, ranked, saved, text_of

CAPACITY = 4096
END_ID = 1
MEMO_WORDS = 600_000
BATCH_BYTES = 3 << 20
LATIN = re.compile(r"^([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,!?;:]*)$", re.M)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every stretch, one stretch after another."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def word_encoder(path: str):
    """A function from distinct words to ``(ids, starts, counts)`` with two stretches a word.

    Words met before are looked up in Arrow arrays.

    The tokenizer lowers case, drops white space and splits at it, and splits letters from
    punctuation, so texts are encoded word by word: each distinct word once, and of words of
    Latin letters the trailing punctuation apart. Such letters in lower case need none of
    the tokenizer's normalising, so many of them go through its model in one call; if that
    doesn't mark where each word ends, or gives other ids for a sample, they go through the
    whole tokenizer one by one, as all other words do.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    encoder = Tokenizer.from_file(path)
    lean = Tokenizer(encoder.model)  # the model is shared, not loaded twice
    for token in encoder.get_added_tokens_decoder().values():
        (lean.add_special_tokens if token.special else lean.add_tokens)([token])
    steps = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    lean.pre_tokenizer = pre_tokenizers.Sequence(steps)
    closes = np.zeros(encoder.get_vocab_size(), bool)
    closes[[token for text, token in encoder.get_vocab().items() if text.endswith("</w>")]] = True

    def plain(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [one.ids for one in encoder.encode_batch_fast(words, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(coded), "<u4")
        return ids, np.fromiter(map(len, coded), np.int64, len(coded))

    def latin(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        parts = []
        for first in range(0, len(words), 4096):
            part = words[first : first + 4096]
            lines = [" ".join(part[i : i + 64]) for i in range(0, len(part), 64)]
            coded = lean.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(line.ids for line in coded), "<u4")
            counts = np.diff(np.flatnonzero(closes[ids]), prepend=-1)
            sample = plain(part[:16])
            size = len(sample[0])
            if (
                len(counts) != len(part)
                or not np.array_equal(counts[:16], sample[1])
                or not np.array_equal(ids[:size], sample[0])
            ):
                ids, counts = plain(part)
            parts.append((ids, counts))
        if not parts:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*parts))

    state: dict = {}

    def start_over() -> None:
        state["words"] = state["stems"] = pa.array([], pa.string())
        state["ids"] = np.zeros(0, "<u4")
        state["stem"] = np.zeros((0, 2), np.int64)  # start and count of each stem
        state["word"] = np.zeros((0, 4), np.int64)  # both of a word's first stretch, then of its second

    def added(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        begins = len(state["ids"]) + np.cumsum(counts) - counts
        state["ids"] = np.concatenate([state["ids"], ids])
        return np.stack([begins, counts], axis=1).reshape(-1, 2)

    def located(words: pa.Array, store: str) -> tuple[np.ndarray, pa.Array]:
        """The words' places in a store, to which those that it lacks are appended."""
        found = pc.index_in(words, value_set=state[store])
        lacking = np.asarray(pc.is_null(found))
        place = np.array(pc.fill_null(found, 0), np.int64)
        place[lacking] = len(state[store]) + np.arange(lacking.sum())
        new = words.filter(pa.array(lacking))
        state[store] = pa.concat_arrays([state[store], new])
        return place, new

    def learn(words: pa.Array) -> np.ndarray:
        split = LATIN.findall("\n".join(words.to_pylist()))
        at = np.asarray(pc.index_in(pa.array(map("".join, split), pa.string()), value_set=words), np.int64)
        stems = pa.array("\n".join([stem for stem, _ in split]).lower().split("\n") if split else [], pa.string())
        ends = pa.array([end for _, end in split], pa.string()).dictionary_encode()
        stems = stems.dictionary_encode()
        place, new = located(stems.dictionary, "stems")
        state["stem"] = np.concatenate([state["stem"], added(*latin(new.to_pylist()))])
        rest = np.ones(len(words), bool)
        rest[at] = False
        found = np.zeros((len(words), 4), np.int64)
        found[at, :2] = state["stem"][place[np.asarray(stems.indices)]]
        found[at, 2:] = added(*plain(ends.dictionary.to_pylist()))[np.asarray(ends.indices)]
        found[rest, :2] = added(*plain(words.filter(pa.array(rest)).to_pylist()))
        return found

    def encode(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(state["words"]) > MEMO_WORDS:
            start_over()
        place, new = located(words, "words")
        state["word"] = np.concatenate([state["word"], learn(new)])
        found = state["word"][place]
        return state["ids"], found[:, ::2], found[:, 1::2]

    start_over()
    return encode


def tokenised(tokenizer: str | None, capacity: int, end_id: int):
    """Pieces of each text: their starts, lengths and checksums."""

    def make():
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        encode = word_encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        step = capacity * 4

        def work(batch: pa.RecordBatch) -> list:
            split = pc.split_pattern(pc.replace_substring(batch["larder_text"], "\n", " "), " ")
            words = split.flatten().dictionary_encode()
            known, starts, counts = encode(words.dictionary)
            at = np.asarray(words.indices)
            per_word = counts.sum(axis=1)[at]
            ids = known[ragged(starts[at].ravel(), counts[at].ravel())]
            before = np.concatenate([[0], np.cumsum(per_word)])
            bounds = before[np.asarray(split.offsets) - split.offsets[0].as_py()].tolist()
            first, lengths, sums = [], [], []
            for a, b in zip(bounds, bounds[1:]):
                raw = ids[a:b].tobytes() + end
                cuts = range(0, len(raw), step)
                first.append([cut // 4 for cut in cuts])
                lengths.append([len(raw[cut : cut + step]) // 4 for cut in cuts])
                sums.append([zlib.crc32(raw[cut : cut + step]) for cut in cuts])
            return [batch["larder_id"], first, lengths, sums]

        return work

    return make


def pieces_of(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: every document cut into pieces."""
    kind = df.schema[id_col].dataType.simpleString()
    texts = df.select(column(id_col).alias("larder_id"), text_of(text_col).alias("larder_text"))
    schema = f"id {kind}, starts array<bigint>, lengths array<bigint>, sums array<bigint>"
    cut = map_batches(texts, schema, tokenised(tokenizer, capacity, end_id), BATCH_BYTES)
    zipped = F.posexplode(F.arrays_zip("starts", "lengths", "sums")).alias("piece", "p")
    return cut.select("id", zipped).select(
        F.col("id").alias(id_col),
        "piece",
        F.col("p.starts").alias("start"),
        F.col("p.lengths").alias("length"),
        F.col("p.sums").alias("ids_crc32"),
    )


def best_fit(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where the pieces of each length go: ``(length, rank, sequence, per sequence, offset)``.

    One superstep per length, longest first. All pieces of that length seek their successor,
    the smallest gap that holds them, at once; gaps of one size are runs of consecutive
    sequences, the pieces get them by rank, and each gap takes as many as it holds, which is
    what one piece after another would choose too. The gaps shrink, and what is left opens
    new sequences. The state has at most ``capacity`` sizes, however many pieces there are.
    """
    gaps: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
    steps: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = []
            last = runs[gap][-1] if runs[gap] else None
            if last and last[0] + last[1] == first:
                runs[gap][-1] = (last[0], last[1] + many)
            else:
                runs[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fit = capacity // length
                many = -(-left // fit)
                put(capacity, opened, many)
                opened += many
                continue
            gap = gaps[at]
            first, many = runs[gap].pop(0)
            if not runs[gap]:
                del runs[gap]
                gaps.pop(at)
            fit = gap // length
            full = min(many, left // fit)
            rest = left - full * fit if full < many and left - full * fit < fit else 0
            steps.append((length, rank, first, fit, capacity - gap))
            put(gap - fit * length, first, full)
            if rest:
                put(gap - rest * length, first + full, 1)
            used = full + (rest > 0)
            put(gap, first + used, many - used)
            rank += full * fit + rest
            left -= full * fit + rest
    return steps, opened


def pack(
    pieces: DataFrame, length_col: str = "length", capacity: int = CAPACITY
) -> DataFrame:
    """Add ``sequence_id`` and ``offset``: pieces of at most ``capacity`` tokens, packed by
    best fit, longest first, into sequences without gaps inside.

    Pieces are counted by length; the bulk steps of :func:`best_fit` give each length's
    ranks their places; a range sort by length ranks the pieces, and each looks its place
    up. Only the counts by length, at most ``capacity`` of them, reach the driver, and the
    steps go back to the tasks as four short arrays. A length that a third of all pieces
    have is spread over partitions by the pieces' numbers.
    """
    stored = saved(pieces.withColumn("larder_row", F.monotonically_increasing_id()), "pieces")
    counts = {row[0]: row[1] for row in stored.groupBy(length_col).agg(F.count("*")).collect()}
    if any(length is None or not 0 < length <= capacity for length in counts):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    steps, _ = best_fit(counts, capacity)
    steps.sort()
    before, total = {}, 0
    for length in sorted(counts):
        before[length] = total
        total += counts[length]
    where = np.array([before[step[0]] + step[1] for step in steps], np.int64)
    length_of, _, first, fit, offset = (np.array(x, np.int64) for x in zip(*steps)) if steps else [np.zeros(0, np.int64)] * 5

    def make():
        def work(batch: pa.RecordBatch) -> list:
            place = np.asarray(batch["larder_rank"], np.int64)
            step = np.searchsorted(where, place, side="right") - 1
            n = place - where[step]
            sequence = first[step] + n // fit[step]
            at = offset[step] + (n % fit[step]) * length_of[step]
            return [*[batch[name] for name in names], sequence, at]

        return work

    names = [name for name in pieces.columns if name not in ("sequence_id", "offset")]
    order = ranked(stored, [length_col, "larder_row"], "larder_rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields if f.name in names)
    return map_batches(order, f"{fields}, sequence_id bigint, offset bigint", make)


def pack_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of all documents.

    Null texts are empty and still have their end id, so every row has a piece; a null id
    stays null. Repeated rows are packed as often as they occur; equal lengths are told
    apart by the order in which their rows were stored. An empty table gives an empty one.
    """
    return pack(pieces_of(df, id_col, text_col, tokenizer, capacity, end_id), "length", capacity)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs)
