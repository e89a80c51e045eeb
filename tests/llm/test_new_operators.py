"""Ranked search, vector codes and token files against brute force, and on awkward rows."""

from __future__ import annotations

import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import count, product

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from larder.llm import search, token_files, vector_codes
from larder.session import new_run_dir

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


def sql_rows(sql: str, columns: list[str], *tables: str) -> list[tuple]:
    db = duckdb.connect()
    for name in tables:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return sorted(db.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())


# ---- ranked search


def best_documents(docs: list[tuple], items: list[tuple], top: int) -> dict:
    """By scoring every document for every item."""
    bags = [(doc, Counter(TERM.findall((text or "").translate(CAPITALS)))) for doc, text in docs]
    n_docs = sum(bool(bag) for _, bag in bags)
    total = sum(bag.total() for _, bag in bags)
    df = Counter(term for _, bag in bags for term in bag)
    found = defaultdict(list)
    for item, text in items:
        scores = []
        for doc, bag in bags:
            m = 25 + (75 * bag.total() * n_docs) // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in TERM.findall((text or "").translate(CAPITALS))
                if bag[t]
            )
            if score > 0:
                scores.append((score, doc))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        found[item] += [(rank, doc, score) for rank, (score, doc) in zip(count(1), scores[:top])]
    return dict(found)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    vocabulary = [f"{rng.choice('abcéß')}{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = [(i, " ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 40)))) for i in range(700)]
    rows += [(700, None), (701, ""), (702, " ,;-_\n"), (None, rows[3][1]), (None, None), rows[5], rows[5]]
    rows += [(703, " ".join(rng.choices(vocabulary, weights, k=50_000))), (704, "ÀB-c C_c\tC"), (705, rows[9][1])]
    return rows


def frame(spark, rows, partitions):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(partitions)


@pytest.mark.parametrize(("partitions", "shard_bytes", "block_terms"), [(1, 1 << 20, 50_000), (5, 4_000, 40)])
def test_search_equals_scoring_every_document(spark, texts, partitions, shard_bytes, block_terms):
    rng = random.Random(4)
    items = [(i, " ".join(rng.choices([t for _, x in texts if x for t in x.split()[:3]], k=rng.randint(1, 9)))) for i in range(25)]
    items += [(25, None), (26, "never seen"), (27, "àb c C a0 a0 A0"), (None, "a1 b1"), (28, texts[0][1])]
    index = search.build_index(frame(spark, texts, partitions), new_run_dir(spark, "index"), shard_bytes=shard_bytes)
    given = spark.createDataFrame(items, "item_id int, text string")
    found = defaultdict(list)
    for row in search.search_index(index, given, query_terms_a_block=block_terms, shards_per_lane=2).collect():
        found[row["item_id"]].append((row["rank"], row["doc_id"], row["score"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: v for k, v in best_documents(texts, items, 10).items() if v}


def test_search_on_empty_tables_and_clashing_names(spark, texts):
    none = spark.createDataFrame([], "doc_id bigint, text string, shard string, TERM string, ids int")
    one = spark.createDataFrame([(1, texts[3][1], "x", "y", 3)], "item_id int, text string, query string, Rank string, doc_id int")
    empty = search.build_index(none, new_run_dir(spark, "index"))
    assert search.search_index(empty, one).collect() == []
    full = frame(spark, texts[:50], 2).withColumns({"shard": F.lit("x"), "TERM": F.lit("y"), "Ids": F.lit(1)})
    index = search.build_index(full, new_run_dir(spark, "index"))
    found = search.search_index(index, one)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 10
    assert search.search_index(index, one.limit(0)).collect() == []


def test_blocks_are_rejected_unread():
    rng = np.random.default_rng(0)
    n = 20_000
    lengths = rng.integers(5, 60, n)
    common = np.arange(n)
    rare = np.sort(rng.choice(n, 60, replace=False))
    doc, term = np.concatenate([common, rare]), np.concatenate([np.zeros(n, int), np.ones(60, int)])
    columns = search.posting_lists(doc, term, np.concatenate([rng.integers(1, 4, n), np.full(60, 3)]), lengths)
    shard = search.Shard(list(range(n)), lengths.tolist(), n, int(lengths.sum()))
    rows = [{k: v[i].as_py() for k, v in columns.items() if k != "term"} for i in range(2)]
    shard.lists = {"common": search.PostingList(shard, rows[0]), "rare": search.PostingList(shard, rows[1])}
    terms = [("common", 10), ("rare", 5000)]
    everything = shard.best(terms, 1, 10)
    assert shard.blocks_unpacked == len(rows[0]["ends"]) + 1
    shard.lists = {"common": search.PostingList(shard, rows[0]), "rare": search.PostingList(shard, rows[1])}
    shard.blocks_unpacked = 0
    assert shard.best(terms, everything[-1][0], 10) == everything
    assert shard.blocks_unpacked <= 25


def test_posting_lists_round_trip():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 1 << 20, 70_000)
    expected, docs, terms, times = [], [], [], []
    for term, size in enumerate([1, 2, 127, 128, 129, 5000, 66_000]):
        doc = np.sort(rng.choice(70_000, size, replace=False))
        tf = rng.choice([1, 2, 255, 256, 70_000], size)
        expected.append((doc, tf))
        docs.append(doc), terms.append(np.full(size, term)), times.append(tf)
    order = rng.permutation(sum(map(len, docs)))
    columns = search.posting_lists(*(np.concatenate(x)[order] for x in (docs, terms, times)), lengths)
    shard = search.Shard(list(range(70_000)), lengths.tolist(), 70_000, int(lengths.sum()))
    for i, (doc, tf) in enumerate(expected):
        one = search.PostingList(shard, {k: v[i].as_py() for k, v in columns.items() if k != "term"})
        found, adds = one.whole()
        assert np.array_equal(found, doc) and np.array_equal(adds, search.impacts(tf, shard.m[doc]))
        bounds = [search.impacts(tf, shard.m[doc])[at : at + search.BLOCK].max() for at in range(0, len(doc), search.BLOCK)]
        assert one.bounds.tolist() == bounds


def test_search_query_equals_sql(spark):
    columns = ["item_id", "rank", "doc_id", "score"]
    found = sorted(tuple(r) for r in search.op11_search(spark, SMALL).select(*columns).collect())
    assert found == sql_rows(search.OP11_SQL, columns, "documents", "benchmark")


# ---- vector codes


def lloyd(vectors: list[tuple], parts=8, entries=16, rounds=6):
    """The codes by plain rounds over Python numbers."""
    whole = [
        (i, label, [math.floor(4096 * x) for x in v])
        for i, v, label in vectors
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(whole[0][2]) // parts
    first = sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, _, v in first] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda x, book: min((far(x, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, _, v in whole:
                members[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for e, xs in members.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for i, label, v in whole:
        best = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    sums = Counter()
    for _, label, _, error in out:
        sums[label] += error
    return [(i, code, error, sums[label]) for i, label, code, error in out], books


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(9)
    rows = [(i, [rng.gauss(i % 5, 0.3) for _ in range(16)], i % 3) for i in range(300)]
    hot = rows[7][1]
    rows += [(300 + i, hot, None) for i in range(150)]
    rows += [(500, None, 1), (501, [], 1), (502, [None, *hot[1:]], 1), (503, [math.nan, *hot[1:]], 1)]
    rows += [(504, [math.inf, *hot[1:]], 1), (None, rows[4][1], 2), rows[9], rows[9], (-5, [0.0] * 16, None)]
    return rows


@pytest.mark.parametrize(("partitions", "owner_rows"), [(1, 200_000), (7, 40)])
def test_codes_equal_plain_rounds(spark, vectors, partitions, owner_rows):
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>, label int").repartition(partitions)
    expected, books = lloyd(vectors)
    whole = vector_codes.whole_numbers(df, "embedding", [F.col("vec_id")])
    fitted = vector_codes.fit_codebooks(whole, "vec_id", owner_rows=owner_rows)
    assert fitted.tolist() == books
    found = [tuple(r)[:4] for r in vector_codes.compress_vectors(df).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(found, key=order) == sorted(expected, key=order)


def test_only_movers_are_shuffled_and_owners_update_in_place(spark, vectors):
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>, label int")
    whole = vector_codes.whole_numbers(df, "embedding", [F.col("vec_id")])
    books = np.array(lloyd(vectors, rounds=1)[1])
    members = vector_codes.Residents(spark, 4)
    members.store(vector_codes.place_parts(whole, books, 2).repartition(4, *vector_codes.OWNER))
    try:
        own = members.read().groupBy(*vector_codes.OWNER).agg(F.count("*"))
        assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()
        assert vector_codes.marked(members.read(), books).where("moved").count() == 0
    finally:
        members.drop()


def test_codes_of_few_and_no_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, label int, code string, Error string, larder_of int"
    assert vector_codes.compress_vectors(spark.createDataFrame([], schema)).collect() == []
    few = spark.createDataFrame([(2, [1.0] * 8, None, "x", "y", 1), (1, [0.5] * 8, None, "x", "y", 1)], schema)
    rows = {r["vec_id"]: r for r in vector_codes.compress_vectors(few).collect()}
    assert rows[1]["code"] == "00" * 8 and rows[2]["code"] == "01" * 8 and rows[1]["label_error"] == 0
    with pytest.raises(ValueError):
        vector_codes.compress_vectors(spark.createDataFrame([(1, [1.0] * 9, 1, "", "", 1)], schema))


def test_codes_are_decoded():
    books = np.arange(8 * 3 * 2).reshape(8, 3, 2)
    assert vector_codes.decode_codes(["0001020001020001"], books, 1).tolist() == [
        [x for p, e in enumerate([0, 1, 2, 0, 1, 2, 0, 1]) for x in books[p, e].tolist()]
    ]


def test_vector_query_equals_sql(spark):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    found = sorted(tuple(r) for r in vector_codes.op12_vector_codes(spark, SMALL).select(*columns).collect())
    assert found == sql_rows(vector_codes.OP12_SQL, columns, "embeddings")


# ---- token files


def huffman_cost(counts: list[int]) -> int:
    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("n", [2, 3, 50, 700])
def test_code_lengths_are_optimal(n):
    counts = np.random.default_rng(n).zipf(1.4, n).clip(1, 10**7)
    free = token_files.code_lengths(counts, 40)
    assert (counts * free).sum() == huffman_cost(counts.tolist())
    for limit in (int(n - 1).bit_length(), 11):
        lengths = token_files.code_lengths(counts, limit)
        assert lengths.max() <= max(limit, int(n - 1).bit_length()) and sum(2.0**-x for x in lengths) <= 1
        assert (counts * lengths).sum() >= (counts * free).sum()


def test_limited_code_is_the_best_of_all_small_ones():
    counts = np.array([1, 1, 2, 7, 30])
    best = min(
        sum(c * x for c, x in zip(counts, lengths))
        for lengths in product((1, 2, 3), repeat=5)
        if sum(2.0**-x for x in lengths) <= 1
    )
    assert (counts * token_files.code_lengths(counts, 3)).sum() == best


@pytest.mark.parametrize("size", [1, 255, 256, 257, 5000])
def test_bits_round_trip(size):
    rng = np.random.default_rng(size)
    ids = np.sort(rng.choice(50_000, 3000, replace=False))
    lengths = token_files.code_lengths(rng.zipf(1.3, 3000).clip(1, 10**9))
    tokens = rng.choice(ids, size)
    bits, at = token_files.pack_bits(token_files.encoder_of(ids, lengths)[tokens])
    table, width = token_files.decoder_of(ids, lengths)
    found = token_files.unpack_bits(np.frombuffer(bits, np.uint8), at[::256], 256, table, width)
    assert np.array_equal(found.ravel()[:size], tokens)


ODD = [
    None, "", " ", "\n\t ", "Hello, World!!", "it's we're DON'T 'tis", "a" * 5000, "ÀÉÎ ßtraße ﬁ ½ ²x x²", "é ́e Σας ΟΔΟΣ",
    "<|endoftext|> a<|startoftext|>b", "12 3.4,5 $$$ a$$$ b%%% c### d*** e(&)", "日本語 текст مرحبا 👍🏽", " x y​z", "İı ªº ×÷",
    "x\r\ny\x0bz\x0c.", "under_score a_b", "\x00\x01", "word. " * 20_000, "(a) [b] {c} a)b a(b) --c-- d&e",
]


@pytest.mark.parametrize(("partitions", "block_ids"), [(1, 1 << 16), (6, 300)])
def test_token_files_equal_the_tokenizer(spark, partitions, block_ids):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(1)
    rows = [(i * 3 % 101, text) for i, text in enumerate(ODD)]
    rows += [(200 + i, " ".join(rng.choices([w for t in ODD if t for w in t.split()[:9]], k=rng.randint(1, 50)))) for i in range(80)]
    rows += [(None, "no id"), (None, None), rows[4], rows[4]]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(partitions)
    df = df.withColumns({"ids": F.lit("x"), "START": F.lit(1), "part": F.lit(2)})
    path = new_run_dir(spark, "token-files")
    token_files.write_token_files(df, path, block_ids=block_ids)
    found = token_files.read_token_files(spark, path).orderBy("start").collect()
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded = lambda text: [*whole.encode(text or "", add_special_tokens=False).ids, 2]
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    start = 0
    for row in found:
        ids = np.frombuffer(row["ids"], "<u4")
        assert row["start"] == start and row["n_tokens"] == len(ids)
        start += len(ids)
    expected = Counter((doc, tuple(coded(text))) for doc, text in rows)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found) == expected


def test_no_documents_give_empty_token_files(spark):
    path = new_run_dir(spark, "token-files")
    token_files.write_token_files(spark.createDataFrame([], "doc_id bigint, text string"), path)
    assert token_files.read_token_files(spark, path).collect() == []


def test_token_query_equals_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, []
    for doc, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = token_files.op13_token_files(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, found.collect())) == expected


def test_word_encoder_loads_the_tokenizer_once(monkeypatch):
    import public_tokenizers
    import pyarrow as pa
    import tokenizers

    from larder.llm.packing import word_encoder

    class Counted:
        loads = 0

        def __new__(cls, model):
            return whole(model)

        @staticmethod
        def from_file(path):
            Counted.loads += 1
            return whole.from_file(path)

    whole, path = tokenizers.Tokenizer, public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    words = ["Hello", "world,", "naïve", "übergrößen!", "x1", "<|endoftext|>", ""]
    known, starts, counts = word_encoder(path)(pa.array(words))
    assert Counted.loads == 1
    plain = whole.from_file(path)
    for word, start, many in zip(words, starts, counts):
        found = [int(x) for a, n in zip(start, many) for x in known[a : a + n]]
        assert found == plain.encode(word, add_special_tokens=False).ids
