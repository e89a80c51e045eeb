"""Token ids in files of entropy-coded blocks: canonical Huffman codes of bounded length.

A dataset of token files is a folder with three Parquet tables:

``codebook``  ``(id, bits)``: the code length of every id that occurs. Codes are canonical:
              shorter ones first, ids of one length in ascending order, each code one more
              than the last, so the lengths say it all.
``blocks``    ``(part, block, first, size, ids, counts, marks, bits)``: a run of whole
              documents in ascending order of their id. ``ids`` and ``counts`` name the
              documents and how many token ids each has, ``first`` the token ids of the part
              before this block. ``bits`` is the bit stream, ``marks`` the bit at which every
              256th token id begins, so a block is decoded from all its marks at once and
              needs no other block.
``parts``     ``(part, start)``: the token ids of all documents before each part.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import bounded_batches, slices, small, text_of
from larder.session import new_run_dir

END_ID = 2
MAX_BITS = 18
BLOCK_IDS = 1 << 16
MARK_IDS = 256
MEMO_STEMS = 800_000
BATCH_BYTES = 1 << 20
CHUNK_BYTES = 12 << 20
NAMES = ["doc", "ids", "width", "met", "times"]
LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
STOPS = ".,!?;:$%#&*()"


def stretches(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every stretch, one stretch after another."""
    before = np.cumsum(counts)
    shift = (starts - (before - counts)).astype(starts.dtype)
    return np.repeat(shift, counts) + np.arange(before[-1] if len(before) else 0, dtype=starts.dtype)


def binaries(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of ``values``, cut at ``ends``, as an array of binary values."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(ends), buffers)


class StemEncoder:
    """The token ids of words, each distinct stem put through the tokenizer once.

    The tokenizer composes characters, lowers case, drops white space, and splits at it and
    between letters and punctuation, so words are encoded apart. A word of Latin-1 letters with
    trailing stops is two pieces to it, and its lowered letters are already composed: such
    stems go through the model many at a time, without the tokenizer's normalising. All other
    words go through the whole tokenizer, each by itself. Stems are forgotten all together
    when there are ``MEMO_STEMS`` of them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole, self.lean = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.lean.normalizer = None
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.lean.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), byte_level])
        self.size = self.whole.get_vocab_size()
        self.kind = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.closes = np.zeros(self.size, bool)
        self.closes[[i for text, i in self.whole.get_vocab().items() if text.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids, self.n_ids = np.zeros(1 << 16, self.kind), 0
        self.spans = np.zeros((0, 2), np.int32)

    def whole_ids(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        coded = [one.ids for one in self.whole.encode_batch_fast(words.to_pylist(), add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(coded), self.kind), np.fromiter(map(len, coded), np.int64, len(coded))

    def stem_ids(self, stems: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        cuts = pa.array([*range(0, len(stems), 64), len(stems)], pa.int32())
        lines = pc.binary_join(pa.ListArray.from_arrays(cuts, stems), " ").to_pylist()
        coded = self.lean.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(line.ids for line in coded), self.kind)
        counts = np.diff(np.flatnonzero(self.closes[ids]), prepend=-1)
        # a stem has one token that closes a word, its last, or none if the vocabulary lacks that
        return (ids, counts) if len(counts) == len(stems) else self.whole_ids(stems)

    def places(self, pieces: pa.Array, encode) -> np.ndarray:
        """Where the spans of distinct pieces are; those not met before are learnt."""
        found = pc.index_in(pieces, value_set=self.known)
        lacking = np.asarray(pc.is_null(found))
        new = pieces.filter(pa.array(lacking))
        place = np.array(pc.fill_null(found, 0))
        place[lacking] = len(self.spans) + np.arange(len(new), dtype=np.int32)
        spans = [self.spans]
        for first in range(0, len(new), 16_384):
            part = new.slice(first, 16_384)
            ids, counts = encode(part)
            while self.n_ids + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.n_ids : self.n_ids + len(ids)] = ids
            spans.append(np.stack([self.n_ids + np.cumsum(counts) - counts, counts], axis=1).astype(np.int32))
            self.n_ids += len(ids)
        self.known, self.spans = pa.concat_arrays([self.known, new]), np.concatenate(spans)
        return place

    def encode(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """``(starts, counts)`` into ``ids``, two stretches for each of some distinct words."""
        if len(self.known) > MEMO_STEMS:
            self.forget()
        plain = np.asarray(pc.match_substring_regex(words, f"^{LETTERS}[{STOPS}]*$"))
        stemmed = words.filter(pa.array(plain))
        stems = pc.utf8_lower(pc.utf8_rtrim(stemmed, STOPS)).dictionary_encode()
        tails = pc.replace_substring_regex(stemmed, f"^{LETTERS}", "").dictionary_encode()
        where = np.zeros((len(words), 2), np.int32)
        # no word is a stem and something else, and tails are words to the tokenizer
        where[plain, 0] = self.places(stems.dictionary, self.stem_ids)[np.asarray(stems.indices)]
        where[plain, 1] = self.places(tails.dictionary, self.whole_ids)[np.asarray(tails.indices)]
        where[~plain, 0] = self.places(words.filter(pa.array(~plain)), self.whole_ids)
        where[~plain, 1] = self.places(pa.array([""]), self.whole_ids)
        spans = self.spans[where]
        return spans[:, :, 0], spans[:, :, 1]


def tokenised(tokenizer: str | None, end_id: int):
    """For ``mapInArrow``: the ids of every text with the end id, as bytes; and, as the last
    row of a task, how often it met each id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        coder = StemEncoder(path)
        kind = coder.kind if end_id < 1 << 16 else np.dtype("<u4")
        met = np.zeros(max(coder.size, end_id + 1), np.int64)
        doc = None

        def coded(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = pa.concat_arrays([batch["text"] for batch in held])
            split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
            first_word = np.asarray(split.offsets)
            words = split.flatten().dictionary_encode()
            del texts, split
            starts, counts = coder.encode(words.dictionary)
            row = 0
            for batch in held:
                bounds = first_word[row : row + batch.num_rows + 1]
                at = np.asarray(words.indices)[bounds[0] : bounds[-1]]
                row += batch.num_rows
                ends = np.concatenate([[0], np.cumsum(counts.sum(axis=1)[at])])
                ids = coder.ids[stretches(starts[at].ravel(), counts[at].ravel())]
                met[:] += np.bincount(ids, minlength=len(met))
                met[end_id] += batch.num_rows
                cuts = ends[bounds[1:] - bounds[0]]
                ids = np.insert(ids.astype(kind, copy=False), cuts, end_id)  # in front of each cut
                cuts = (cuts + np.arange(1, len(cuts) + 1)) * kind.itemsize
                none = pa.nulls(len(cuts), pa.list_(pa.int32())), pa.nulls(len(cuts), pa.list_(pa.int64()))
                width = pa.array(np.full(len(cuts), kind.itemsize, np.int32))
                yield pa.RecordBatch.from_arrays([batch["doc"], binaries(ids, cuts), width, *none], names=NAMES)

        held, size = [], 0
        for batch in (part for whole in batches for part in slices(whole, BATCH_BYTES)):
            if not batch.num_rows:
                continue
            doc = batch["doc"].type
            held.append(batch)
            size += batch["text"].nbytes
            if size >= CHUNK_BYTES:
                yield from coded(held)
                held, size = [], 0
        if held:
            yield from coded(held)
            held = []
        if doc is not None:
            seen = np.flatnonzero(met)
            last = [pa.nulls(1, doc), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32())]
            last += [pa.array([seen], pa.list_(pa.int32())), pa.array([met[seen]], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(last, names=NAMES)
        del coder
        pa.default_memory_pool().release_unused()

    return run


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """The lengths of an optimal prefix code of at most ``max_bits`` for positive ``counts``.

    Package-merge: on every level, pairs of the level below are packages, merged with the
    symbols by weight; a symbol's length is the number of levels on which it is among those
    taken, of which the last level takes 2n - 2. A limit too small for the number of
    symbols is raised to the least that suffices. Equal counts are ordered by place.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    levels = max(max_bits, int(n - 1).bit_length())
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    row, is_leaf = weights, [np.ones(n, bool)]
    for _ in range(levels - 1):
        packages = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, packages])
        by_weight = np.argsort(both, kind="stable")
        row = both[by_weight]
        is_leaf.append(by_weight < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(is_leaf):
        leaves = int(leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of every symbol, given the lengths of the symbols in ascending order of id."""
    codes, code, before = np.zeros(len(lengths), np.int64), 0, 0
    for at in np.lexsort((np.arange(len(lengths)), lengths)).tolist():
        code <<= int(lengths[at]) - before
        before = int(lengths[at])
        codes[at] = code
        code += 1
    return codes


def encoder_of(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A table from id to ``code * 32 + length``."""
    table = np.zeros(int(ids.max(initial=0)) + 1, np.uint64)
    table[ids] = canonical_codes(lengths) * 32 + lengths
    return table


def pack_bits(entries: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The codes of table entries one after another, highest bit first, and the bit at which each begins.

    A code is put at its place in a 64-bit window that begins with a 32-bit word of the
    stream. As no code is longer than a word, one begins in every word, so the windows of a
    word's codes are summed in one run.
    """
    lengths = (entries & 31).astype(np.int64)
    ends = np.cumsum(lengths)
    at = ends - lengths
    word = at >> 5
    window = (entries >> 5) << (64 + (word << 5) - ends).astype(np.uint64)
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    sums = np.add.reduceat(window, firsts)
    stream = np.zeros(len(firsts) + 1, np.uint32)
    stream[:-1] = sums >> 32
    stream[1:] |= (sums & 0xFFFFFFFF).astype(np.uint32)
    return stream.astype(">u4").tobytes()[: -(-int(ends[-1]) // 8)], at


def decoder_of(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """A table from the next ``bits`` bits of a stream to ``id * 32 + length``; and ``bits``."""
    bits = int(lengths.max(initial=1))
    table = np.zeros(1 << bits, np.uint32)
    codes = canonical_codes(lengths)
    spread = (1 << (bits - lengths)).astype(np.int64)
    table[stretches(codes << (bits - lengths), spread)] = np.repeat(ids.astype(np.int64) * 32 + lengths, spread)
    return table, bits


def unpack_bits(stream: np.ndarray, marks: np.ndarray, steps: int, table: np.ndarray, bits: int) -> np.ndarray:
    """The ``steps`` ids from each mark on, one row a mark; where a stretch ends before, what
    follows it has no meaning."""
    padded = np.concatenate([stream, np.zeros(8, np.uint8)]).astype(np.uint32)
    window = (padded[:-3] << 24) | (padded[1:-2] << 16) | (padded[2:-1] << 8) | padded[3:]
    at, last = marks.astype(np.int64), len(stream) * 8
    out = np.zeros((steps, len(marks)), np.uint32)
    mask = np.uint32((1 << bits) - 1)
    for step in range(steps):
        np.minimum(at, last, out=at)
        shift = (32 - bits - (at & 7)).astype(np.uint32)
        entry = table[(window[at >> 3] >> shift) & mask]
        out[step] = entry >> 5
        at += entry & 31
    return out.T


def block_writer(ids: np.ndarray, lengths: np.ndarray, schema: pa.Schema, block_ids: int):
    """For ``mapInArrow`` over partitions of documents in order: one row a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        table = encoder_of(ids, lengths)
        docs, counts, tokens = [], [], []  # of the block that is not yet full
        block = first = size = 0

        def row() -> pa.RecordBatch:
            bits, at = pack_bits(table[np.concatenate(tokens)])
            held = pa.concat_arrays(docs)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int64()),
                    pa.array([first], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), held),
                    pa.array([np.concatenate(counts)], pa.list_(pa.int64())),
                    pa.array([at[::MARK_IDS]], pa.list_(pa.int64())),
                    pa.array([bits], pa.binary()),
                ],
                schema=schema,
            )

        for batch in (x for x in batches if x.num_rows):
            coded, width = batch["ids"], batch["width"][0].as_py()
            bounds = np.frombuffer(coded.buffers()[1], np.int32)[coded.offset : coded.offset + len(coded) + 1]
            found = np.frombuffer(coded.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].view(f"<u{width}")
            ends = ((bounds - bounds[0]) // width).astype(np.int64)
            done = 0
            while done < len(coded):
                # the document that fills the block, or the last one
                full = int(np.searchsorted(ends[1:], ends[done] + block_ids - size))
                upto = min(full + 1, len(coded))
                docs.append(batch["doc"].slice(done, upto - done))
                counts.append(np.diff(ends[done : upto + 1]))
                tokens.append(found[ends[done] : ends[upto]])
                size += int(ends[upto] - ends[done])
                done = upto
                if size >= block_ids:
                    yield row()
                    docs, counts, tokens = [], [], []
                    block, first, size = block + 1, first + size, 0
        if docs:
            yield row()

    return run


def write_token_files(
    df: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    max_bits: int = MAX_BITS,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the token ids of every text, each with ``end_id`` behind it, in ascending order
    of ``id_col``, as token files under ``path`` (see the head of this module).

    Texts are tokenised once and their ids staged in the shared folder; each task adds a row
    with its counts. The counts, one a distinct id and so bounded by the vocabulary, make the
    code on the driver. The staged ids are dealt out by ranges of the document's id and of
    their place in the stage, so an id that a third of all rows share is several parts, and
    each part is sorted by Spark and written block by block. A block is closed at
    ``block_ids`` token ids; a longer document is a block by itself. One number a part
    goes to the driver, for the parts' starts.

    Null texts count as empty: they have the end id alone. Null ids stay null and come
    first; rows of one id stay rows of their own, in the order of the stage. An empty table
    writes empty tables. Only ``id_col`` and ``text_col`` are read, whatever other columns
    are named.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    doc_type = df.select(column(id_col)).schema[0].dataType.simpleString()
    schema = f"doc {doc_type}, ids binary, width int, met array<int>, times array<bigint>"
    stage = new_run_dir(spark, "token-ids")
    texts = df.select(column(id_col).alias("doc"), text_of(text_col).alias("text"))
    texts.mapInArrow(tokenised(tokenizer, end_id), schema).write.option("compression", "zstd").parquet(stage)
    staged = spark.read.schema(schema).parquet(stage)
    met = staged.where("met is not null").select(F.explode(F.arrays_zip("met", "times")).alias("m"))
    counts = met.groupBy(F.col("m.met").alias("id")).agg(F.sum("m.times").alias("n")).orderBy("id").collect()
    ids = np.array([row["id"] for row in counts], np.int64)
    lengths = code_lengths(np.array([row["n"] for row in counts], np.int64), max_bits)
    book = [(int(i), int(n)) for i, n in zip(ids, lengths)]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = staged.where("ids is not null").select("doc", "width", "ids")
    docs = docs.withColumn("larder_row", F.monotonically_increasing_id())
    dealt = docs.repartitionByRange(parts, "doc", "larder_row").sortWithinPartitions("doc", "larder_row")
    schema = (
        f"part int, block bigint, first bigint, size bigint, ids array<{doc_type}>, counts array<bigint>, "
        "marks array<bigint>, bits binary"
    )
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    writer = block_writer(ids, lengths, to_arrow_schema(StructType.fromDDL(schema)), block_ids)
    dealt.drop("larder_row").mapInArrow(writer, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    totals = blocks.groupBy("part").agg(F.sum("size").alias("n")).orderBy("part").collect()
    starts = np.cumsum([0, *[row["n"] for row in totals]])
    rows = [(row["part"], int(start)) for row, start in zip(totals, starts)]
    spark.createDataFrame(rows, "part int, start bigint").coalesce(1).write.parquet(f"{path}/parts")


def block_reader(ids: np.ndarray, lengths: np.ndarray):
    """For ``mapInArrow`` over blocks: their documents with the decoded ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bits = decoder_of(ids, lengths)
        for batch in (part for whole in batches for part in slices(whole, 1 << 20)):
            if not batch.num_rows:
                continue
            streams = [np.frombuffer(x, np.uint8) for x in batch["bits"].to_pylist()]
            offsets = np.cumsum([0, *map(len, streams)])[:-1] * 8
            marks = batch["marks"]
            per_block = np.diff(np.asarray(marks.offsets))
            at = np.asarray(marks.flatten()) + np.repeat(offsets, per_block)
            sizes = np.asarray(batch["size"])
            # of each mark's stretch, what belongs to its block
            nth = np.arange(len(at)) - np.repeat(np.cumsum(per_block) - per_block, per_block)
            held = np.minimum(MARK_IDS, np.repeat(sizes, per_block) - nth * MARK_IDS)
            found = unpack_bits(np.concatenate(streams), at, int(held.max()), table, bits)
            tokens = found[np.arange(found.shape[1]) < held[:, None]].astype("<u4")
            counts = np.asarray(batch["counts"].flatten())
            cuts = np.concatenate([[0], np.cumsum(counts)])
            docs_per_block = np.diff(np.asarray(batch["counts"].offsets))
            base = np.asarray(batch["first"]) + np.asarray(batch["start"]) - (np.cumsum(sizes) - sizes)
            starts = cuts[:-1] + np.repeat(base, docs_per_block)
            yield pa.RecordBatch.from_arrays(
                [batch["ids"].flatten(), pa.array(starts), pa.array(counts), binaries(tokens, cuts[1:] * 4)],
                names=["doc", "start", "n_tokens", "ids"],
            )
        pa.default_memory_pool().release_unused()

    return run


def read_token_files(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """The documents of token files: ``(doc_id, start, n_tokens, ids)``, ``ids`` being their
    token ids as little-endian unsigned 32-bit integers and ``start`` the number of token
    ids of all documents before.

    Each task decodes its blocks by itself with a table over the next bits of the stream,
    all marks of a batch side by side. The code, bounded by the vocabulary, goes to every
    task; the parts' starts are joined.
    """
    bounded_batches(spark)
    book = spark.read.schema("id int, bits int").parquet(f"{path}/codebook").orderBy("id").collect()
    ids = np.array([row["id"] for row in book], np.int64)
    lengths = np.array([row["bits"] for row in book], np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    parts = spark.read.schema("part int, start bigint").parquet(f"{path}/parts")
    doc_type = blocks.schema["ids"].dataType.elementType.simpleString()
    rows = blocks.join(small(parts), "part").select("first", "size", "start", "ids", "counts", "marks", "bits")
    out = rows.mapInArrow(block_reader(ids, lengths), f"doc {doc_type}, start bigint, n_tokens bigint, ids binary")
    return out.withColumnRenamed("doc", id_col)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = new_run_dir(spark, "token-files")
    write_token_files(docs, path)
    read = read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
