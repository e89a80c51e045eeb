"""Ranked search for words: an inverted index in shards, searched by Block-Max MaxScore.

The index is one Parquet table. A shard holds some megabytes of documents, numbered by ascending id:
one row without a term names them and their lengths, and one row for each term has its list,
cut into blocks of 128 documents. A block's document gaps and occurrences are packed in the
fewest whole bytes. Beside it, uncompressed, stand the block's last document and its best (occurrences, length)
pairs: no document of the block has more occurrences in a shorter text than one of those. Bounds follow
from them with the statistics of all documents, which the index itself need not know.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from larder.functions import column
from larder.llm.common import bounded_batches, map_batches, saved, slices, small, text_of
from larder.session import new_run_dir

TOP = 10
BLOCK = 128
SHARD_BYTES = 8 << 20
SHARD_DOCS = 1 << 16
SHARDS_PER_LANE = 4
QUERY_TERMS = 50_000
BATCH_BYTES = 2 << 20

#: Bytes that belong to terms (digits, letters, all beyond ASCII), capitals in lower case; others become spaces.
TERM_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms_of(texts: pa.StringArray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The terms of all texts, one after another, and the place of the text that each is in."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2] or pa.py_buffer(b"")
    raw = bytes(memoryview(data)[ends[0] : ends[-1]]).translate(TERM_BYTES)
    plain = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(raw)])
    split = pc.split_pattern(plain, " ")
    text = np.repeat(np.arange(len(texts)), np.diff(np.asarray(split.offsets)))
    words = split.flatten()
    real = pc.not_equal(words, "")
    return text[np.asarray(real)], words.filter(real).dictionary_encode()


def counted(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """``(text, term, times)``, one each for every term of every text, and the terms by number."""
    text, words = terms_of(texts)
    n_terms = max(1, len(words.dictionary))
    key, times = np.unique(text * n_terms + np.asarray(words.indices), return_counts=True)
    return key // n_terms, key % n_terms, times, words.dictionary


def byte_width(values: np.ndarray) -> np.ndarray:
    return np.where(values < 1 << 8, 1, np.where(values < 1 << 16, 2, 4))


def put_bytes(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    """Write each value at its place in so many bytes, the lowest first."""
    for byte in range(4):
        wide = width > byte
        out[at[wide] + byte] = (values[wide] >> (8 * byte)) & 255


def lists_of(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(kind.to_pandas_dtype())))


def posting_lists(doc: np.ndarray, term: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> dict:
    """The lists of a shard's terms, in the order of the terms' numbers, as Arrow columns."""
    order = np.argsort(term * len(lengths) + doc, kind="stable")
    doc, term, times = doc[order], term[order], times[order]
    n = len(doc)
    opens = np.flatnonzero(np.diff(term, prepend=-1))  # of lists
    place = np.arange(n) - np.repeat(opens, np.diff(opens, append=n))
    first = place % BLOCK == 0
    starts = np.flatnonzero(first)  # of blocks
    sizes = np.diff(starts, append=n)
    block = np.cumsum(first) - 1
    gaps = np.diff(doc, prepend=0)
    gaps[opens] = doc[opens]
    gap_bytes = byte_width(np.maximum.reduceat(gaps, starts))
    time_bytes = byte_width(np.maximum.reduceat(times, starts))
    block_end = np.cumsum(sizes * (gap_bytes + time_bytes))
    block_at = block_end - sizes * (gap_bytes + time_bytes)
    inside = np.arange(n) - starts[block]
    body = np.zeros(block_end[-1], np.uint8)
    put_bytes(body, block_at[block] + inside * gap_bytes[block], gaps, gap_bytes[block])
    times_at = block_at + sizes * gap_bytes
    put_bytes(body, times_at[block] + inside * time_bytes[block], times, time_bytes[block])

    # from the most occurrences down, each document shorter than all before it in its block
    length = lengths[doc]
    best = np.lexsort((length, -times, block))
    shortest = length[best] - block[best] * (1 << 32)
    before = np.concatenate([[1 << 62], np.minimum.accumulate(shortest)[:-1]])
    best = best[shortest < before]
    list_blocks = np.append(np.searchsorted(starts, opens[1:]), len(starts))  # blocks up to each list's end
    list_pairs = np.searchsorted(block[best], list_blocks)
    block_zero = np.concatenate([[0], list_blocks[:-1]])
    pair_blocks = block[best] - np.repeat(block_zero, np.diff(list_pairs, prepend=0))
    list_bytes = block_end[list_blocks - 1]
    offsets = np.concatenate([[0], list_bytes]).astype(np.int32)
    return {
        "term": term[opens],
        "df": pa.array(np.diff(opens, append=n)),
        "ends": lists_of(doc[starts + sizes - 1], list_blocks, pa.int32()),
        "widths": lists_of(gap_bytes * 8 + time_bytes, list_blocks, pa.int32()),
        "best_block": lists_of(pair_blocks, list_pairs, pa.int32()),
        "best_times": lists_of(times[best], list_pairs, pa.int64()),
        "best_length": lists_of(length[best], list_pairs, pa.int64()),
        "body": pa.Array.from_buffers(pa.binary(), len(opens), [None, pa.py_buffer(offsets), pa.py_buffer(body)]),
    }


INDEX = (
    "shard bigint, term string, df bigint, ends array<int>, widths array<int>, best_block array<int>, "
    "best_times array<bigint>, best_length array<bigint>, body binary, ids array<{doc}>, lengths array<bigint>, "
    "tokens bigint"
)


def index_writer(schema: pa.Schema, shard_bytes: int):
    """For ``mapInArrow`` over ``(doc, text)``: the rows of the index, shard by shard."""

    def shard_rows(shard: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids = pa.concat_arrays([x[0] for x in held])
        rank = np.empty(len(ids), np.int64)
        order = pc.array_sort_indices(ids, order="ascending", null_placement="at_end")
        rank[np.asarray(order)] = np.arange(len(ids))
        first = np.cumsum([0, *[len(x[0]) for x in held]])
        doc = rank[np.concatenate([x[1] + at for x, at in zip(held, first)])]
        words = pa.concat_arrays([x[4] for x in held]).dictionary_encode()
        number = np.asarray(words.indices)
        first = np.cumsum([0, *[len(x[4]) for x in held]])
        term = number[np.concatenate([x[2] + at for x, at in zip(held, first)])]
        times = np.concatenate([x[3] for x in held])
        lengths = np.bincount(doc, times, minlength=len(ids)).astype(np.int64)
        rows = {
            "shard": [shard],
            "df": [int((lengths > 0).sum())],
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(order)),
            "lengths": [lengths.tolist()],
            "tokens": [int(lengths.sum())],
        }
        yield with_nulls(rows, 1)
        if len(doc):
            lists = posting_lists(doc, term, times, lengths)
            lists["term"] = words.dictionary.take(pa.array(lists["term"]))
            count = len(lists["term"])
            lists["shard"] = pa.array(np.full(count, shard))
            whole = with_nulls(lists, count)
            yield from (whole.slice(at, 10_000) for at in range(0, count, 10_000))

    def with_nulls(columns: dict, count: int) -> pa.RecordBatch:
        arrays = []
        for field in schema:
            value = columns.get(field.name)
            if value is None:
                value = pa.nulls(count, field.type)
            arrays.append(value.cast(field.type) if isinstance(value, pa.Array) else pa.array(value, field.type))
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        held, size, docs = [], 0, 0
        for batch in (part for whole in batches for part in slices(whole, BATCH_BYTES)):
            if not batch.num_rows:
                continue
            held.append((batch["doc"], *counted(batch["text"])))
            size, docs = size + batch["text"].nbytes, docs + batch.num_rows
            if size >= shard_bytes or docs >= SHARD_DOCS:
                yield from shard_rows(shard, held)
                held, size, docs, shard = [], 0, 0, shard + 1
        if held:
            yield from shard_rows(shard, held)
        del held
        pa.default_memory_pool().release_unused()

    return run


def build_index(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Write the index of all rows under ``path`` and return it.

    One narrow pass: each task makes shards of about ``shard_bytes`` of its own texts, so a term
    that a third of all documents have is a bounded list in each shard, and nothing is
    shuffled. Every row is a document of its own, whatever its id; null ids come last in their
    shard. Null and empty texts have no terms. A longer text is a shard with what was
    before it. Only the two named columns are read.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    texts = df.select(column(id_col).alias("doc"), text_of(text_col).alias("text"))
    schema = INDEX.format(doc=texts.schema["doc"].dataType.simpleString())
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    writer = index_writer(to_arrow_schema(StructType.fromDDL(schema)), shard_bytes)
    texts.mapInArrow(writer, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def impacts(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score, but for the term's weight: more for more
    occurrences, less for a longer text."""
    return 1_000_000_000 * times // (1000 * times + 8 * m)


class PostingList:
    """A term's list in one shard; its blocks are unpacked when first asked for."""

    def __init__(self, shard: "Shard", row: dict):
        self.shard = shard
        self.ends = np.array(row["ends"], np.int64)
        widths = np.array(row["widths"], np.int64)
        self.gap_bytes, self.time_bytes = widths >> 3, widths & 7
        sizes = np.full(len(widths), BLOCK)
        sizes[-1] = row["df"] - BLOCK * (len(widths) - 1)
        self.sizes = sizes
        self.at = np.cumsum(sizes * (self.gap_bytes + self.time_bytes)) - sizes * (self.gap_bytes + self.time_bytes)
        self.body = row["body"]
        length = np.array(row["best_length"], np.int64)
        best = impacts(np.array(row["best_times"], np.int64), shard.m_of(length))
        pair_block = np.array(row["best_block"])
        self.bounds = np.maximum.reduceat(best, np.flatnonzero(np.diff(pair_block, prepend=-1)))
        self.top = int(self.bounds.max())
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.all: tuple[np.ndarray, np.ndarray] | None = None

    def block(self, index: int) -> tuple[np.ndarray, np.ndarray]:
        """A block's documents and what the term adds to each."""
        if index not in self.unpacked:
            size, at = int(self.sizes[index]), int(self.at[index])
            gap, time = int(self.gap_bytes[index]), int(self.time_bytes[index])
            gaps = np.frombuffer(self.body, f"<u{gap}", size, at)
            times = np.frombuffer(self.body, f"<u{time}", size, at + size * gap).astype(np.int64)
            docs = np.cumsum(gaps, dtype=np.int64) + (self.ends[index - 1] if index else 0)
            self.unpacked[index] = docs, impacts(times, self.shard.m[docs])
            self.shard.blocks_unpacked += 1
        return self.unpacked[index]

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self.all is None:
            blocks = [self.block(index) for index in range(len(self.ends))]
            self.all = blocks[0] if len(blocks) == 1 else tuple(np.concatenate(x) for x in zip(*blocks))
        return self.all


class Shard:
    """The documents of a shard, and the lists of some terms."""

    def __init__(self, ids: list, lengths: list, n_docs: int, n_tokens: int):
        self.ids, self.n_docs, self.n_tokens = ids, n_docs, max(1, n_tokens)
        self.m = self.m_of(np.array(lengths, np.int64))
        self.lists: dict[str, PostingList] = {}
        self.scores = np.zeros(len(ids), np.int64)
        self.blocks_unpacked = 0

    def m_of(self, length: np.ndarray) -> np.ndarray:
        return 25 + 75 * length * self.n_docs // self.n_tokens

    def best(self, terms: list[tuple[str, int]], least: int, top: int) -> list[tuple[int, int]]:
        """``(score, document)`` of the ``top`` best documents with a score of ``least`` or more, but for
        documents that others of this shard push out.

        The lists, each with its weight, stand in the order of their bounds. As many as cannot reach
        ``least`` all together are not essential: a document must be on one of the others.
        Those are added up; then the rest is taken from the greatest bound down, and for each document
        the maximum of its block comes first. Who cannot reach ``least`` even so is rejected,
        and only blocks that someone is left for are unpacked.
        """
        found = [(weight, self.lists[term]) for term, weight in terms if weight and term in self.lists]
        found.sort(key=lambda x: x[0] * x[1].top)
        bounds = np.cumsum([weight * one.top for weight, one in found]).tolist()
        essential = sum(bound < least for bound in bounds)
        if essential == len(found):
            return []
        scores = self.scores
        for weight, one in found[essential:]:
            docs, adds = one.whole()
            scores[docs] += weight * adds
        left = np.flatnonzero(scores)
        reached = scores[left]
        scores[left] = 0
        for index in range(essential - 1, -1, -1):
            weight, one = found[index]
            rest = bounds[index - 1] if index else 0
            keep = reached + bounds[index] >= least
            left, reached = left[keep], reached[keep]
            block = np.searchsorted(one.ends, left)
            most = np.append(one.bounds, 0)[block] * weight
            keep = reached + most + rest >= least
            left, reached, block = left[keep], reached[keep], block[keep]
            for at in np.unique(block[block < len(one.ends)]).tolist():
                docs, adds = one.block(at)
                mine = np.flatnonzero(block == at)
                place = np.minimum(np.searchsorted(docs, left[mine]), len(docs) - 1)
                hit = docs[place] == left[mine]
                reached[mine[hit]] += weight * adds[place[hit]]
        keep = reached >= least
        left, reached = left[keep], reached[keep]
        order = np.lexsort((left, -reached))[:top]
        return list(zip(reached[order].tolist(), left[order].tolist()))


def searcher(n_docs: int, n_tokens: int, top: int, schema: pa.Schema):
    """For ``mapInArrow`` over lanes: a block of queries, then shard after shard of the index.

    Each query's best documents so far are kept from shard to shard of a lane, so the score that a
    document has to reach rises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = shard = shard_id = None
        queries: list[tuple] = []
        best: list[list[tuple]] = []

        def search() -> None:
            if shard is None:
                return
            for number, (_, _, terms) in enumerate(queries):
                held = best[number]
                least = -held[-1][0] if len(held) == top else 1
                new = shard.best(terms, least, top)
                if new:
                    more = [(-score, shard.ids[doc] is None, shard.ids[doc]) for score, doc in new]
                    best[number] = sorted(held + more, key=lambda x: (x[:2], x[2] if not x[1] else 0))[:top]

        def results() -> pa.RecordBatch:
            rows = [
                (query, item, doc, -score) for (query, item, _), held in zip(queries, best) for score, _, doc in held
            ]
            columns = list(zip(*rows)) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, schema)], schema=schema)

        for batch in (part for whole in batches for part in slices(whole, 1 << 20)):
            for row in batch.to_pylist():
                if (row["queries"], row["lane"]) != lane:
                    search()
                    if queries:
                        yield results()
                    lane, shard, shard_id, queries, best = (row["queries"], row["lane"]), None, None, [], []
                if row["shard"] is None:
                    queries.append((row["query"], row["item"], list(zip(row["terms"], row["weights"]))))
                    best.append([])
                elif row["term"] is None:
                    search()
                    shard = Shard(row["ids"], row["lengths"], n_docs, n_tokens)
                    shard_id = row["shard"]
                else:
                    assert row["shard"] == shard_id, "a list without its shard"
                    shard.lists[row["term"]] = PostingList(shard, row)
        search()
        if queries:
            yield results()
        pa.default_memory_pool().release_unused()

    return run


def query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(query, item, term, times)``: the distinct terms of every row of ``items``."""

    def make():
        def work(batch: pa.RecordBatch) -> list:
            text, term, times, words = counted(batch["text"])
            where = pa.array(text)
            return [batch["query"].take(where), batch["item"].take(where), words.take(pa.array(term)), pa.array(times)]

        return work

    numbered = items.select(
        F.monotonically_increasing_id().alias("query"), column(id_col).alias("item"), text_of(text_col).alias("text")
    )
    kind = numbered.schema["item"].dataType.simpleString()
    return map_batches(numbered, f"query bigint, item {kind}, term string, times bigint", make)


def search_index(
    index: DataFrame,
    items: DataFrame,
    top: int = TOP,
    item_col: str = "item_id",
    text_col: str = "text",
    id_col: str = "doc_id",
    query_terms_a_block: int = QUERY_TERMS,
    shards_per_lane: int = SHARDS_PER_LANE,
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` best documents of the index for each item.

    Exactly those that scoring all documents gives; scores above 0 only, equal ones by ascending
    id, null ids last, and equal ids (repeated rows) each with a rank of its own. Every row of
    ``items`` is a query; null texts and texts without terms that the index has give no rows,
    as do empty tables.

    Items are taken in blocks of about ``query_terms_a_block`` distinct terms. A lane is
    some shards, and a task searches the lists of a block's terms in the shards of a lane; only those lists
    are shuffled, packed as they are. Each lane gives ``top`` rows an item, which Spark ranks.
    """
    spark = index.sparkSession
    bounded_batches(spark)
    documents = index.where("term is null")
    n_docs, n_tokens, shards = documents.agg(
        F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("tokens"), F.lit(0)), F.count("*")
    ).first()
    terms = saved(query_terms(items, item_col, text_col), "query-terms")
    asked = small(saved(terms.select("term").distinct(), "asked-terms"))
    lists = index.where("term is not null").join(asked, "term", "left_semi")
    found = lists.groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = saved(terms.join(found, "term").withColumn("weight", F.col("times") * weight), "weighted-terms")
    blocks = max(1, math.ceil(weighted.count() / query_terms_a_block))
    lanes = max(1, min(math.ceil(shards / shards_per_lane), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("queries")
    lane = F.pmod(F.xxhash64("shard"), F.lit(lanes)).cast("int").alias("lane")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    questions = (
        weighted.groupBy("query", "item")
        .agg(F.collect_list(F.struct("term", "weight")).alias("t"))
        .select(block, every(lanes).alias("lane"), "query", "item", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights"))
    )
    needed = small(saved(weighted.select("term", block).distinct(), "needed-terms"))
    wanted = lists.join(needed, "term").select("queries", lane, "shard", "term", "df", *PACKED)
    heads = documents.select(every(blocks).alias("queries"), lane, "shard", "ids", "lengths")
    rows = questions.unionByName(heads, True).unionByName(wanted, True)
    dealt = rows.repartition(min(lanes * blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))), "queries", "lane")
    dealt = dealt.sortWithinPartitions("queries", "lane", "shard", "term")
    item_type = terms.schema["item"].dataType.simpleString()
    doc_type = index.schema["ids"].dataType.elementType.simpleString()
    schema = f"query bigint, item {item_type}, doc {doc_type}, score bigint"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    search = searcher(n_docs, n_tokens, top, to_arrow_schema(StructType.fromDDL(schema)))
    hits = dealt.mapInArrow(search, schema)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(
        F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_col), "score"
    )


PACKED = ["ends", "widths", "best_block", "best_times", "best_length", "body"]


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    index = build_index(docs, new_run_dir(spark, "search-index"))
    return search_index(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
OP11_SQL = rf"""
    WITH terms AS MATERIALIZED (
      SELECT doc_id, term, count(*) AS tf
      FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
      GROUP BY doc_id, term),
    lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM terms GROUP BY doc_id),
    totals AS (SELECT count(*) AS all_docs, sum(n)::BIGINT AS all_terms FROM lengths),
    asked AS (
      SELECT item_id, term, count(*) AS qtf
      FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'),
                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
      GROUP BY item_id, term),
    weights AS (
      SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM terms, totals GROUP BY term),
    scored AS (
      SELECT item_id, doc_id,
             sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms))))::BIGINT AS score
      FROM asked JOIN weights USING (term) JOIN terms USING (term) JOIN lengths USING (doc_id), totals
      GROUP BY item_id, doc_id)
    SELECT item_id, rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank
          FROM scored WHERE score > 0)
    WHERE rank <= {TOP}
"""
