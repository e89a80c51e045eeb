"""A similarity join on word shingles with Bayesian pruning of candidate pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from larder.functions import column
from larder.llm.common import key_of, map_batches, rounds_of_components, saved, small, text_of

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
HASHES = 128
STEP = 16
TOLERANCE = 1e-5
BLOCK = 512
MEMO_WORDS = 200_000


def shingle_reader(size: int):
    """A function from texts to all their distinct shingle hashes, sorted, and their counts.

    Words are what white space parts, in lower case; a text of fewer than ``size`` words is
    one shingle, a text without words has none. Words are hashed once, shingles by mixing
    their words' hashes, 64 bits wide.
    """
    import xxhash

    memo: dict[str, int] = {}
    code = xxhash.xxh3_64_intdigest
    odd = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]

    def mixed(x: np.ndarray) -> np.ndarray:
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(32)
        return x

    def read(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [text.lower().split() for text in texts]
        new = {word for words in split for word in words}.difference(memo)
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            new = {word for words in split for word in words}
        for word in new:
            memo[word] = code(word)
        parts = []
        for words in split:
            hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
            many = max(1, len(words) - size + 1) if words else 0
            total = np.zeros(many, np.uint64)
            for k in range(size):
                part = hashes[k : k + many]
                total[: len(part)] = (total[: len(part)] + np.uint64(k + 1)) * np.uint64(odd[k % 5]) ^ part
                total = mixed(total)
            parts.append(np.unique(total))
        sizes = np.array([len(part) for part in parts], np.int64)
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes

    return read


def signer(hashes: int):
    """A function from shingles and counts to a MinHash signature per text (32 bits each)."""
    rng = np.random.default_rng(20)
    factors = rng.integers(0, 1 << 63, hashes, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, hashes, np.uint64)

    def sign(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.full((len(sizes), hashes), 0xFFFFFFFF, np.uint32)
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            for i in range(hashes):
                value = shingles * factors[i] + shifts[i]
                value ^= value >> np.uint64(31)
                value *= np.uint64(0x9FB21C651E98DF25)
                out[full, i] = np.minimum.reduceat((value >> np.uint64(32)).astype(np.uint32), starts)
        return out

    return sign


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """``(doc, given, hash, code, n, bands, signature)``: the set's hash, its size, band hashes, MinHashes."""
    import xxhash

    def make():
        read, sign = shingle_reader(size), signer(HASHES)

        def work(batch: pa.RecordBatch) -> list:
            codes, counts, bands, signatures = [], [], [], []
            texts = batch["text"].to_pylist()
            for first in range(0, len(texts), 200):
                shingles, sizes = read(texts[first : first + 200])
                ends = np.cumsum(sizes)
                signed = sign(shingles, sizes)
                for end, n, row in zip(ends.tolist(), sizes.tolist(), signed):
                    codes.append(xxhash.xxh3_128_digest(shingles[end - n : end].tobytes()))
                    counts.append(n)
                    raw = row.tobytes()
                    signatures.append(raw)
                    step = ROWS * 4
                    bands.append(
                        [
                            xxhash.xxh3_64_intdigest(raw[b * step : (b + 1) * step], seed=b) - (1 << 63)
                            for b in range(BANDS)
                        ]
                    )
            return [batch["doc"], batch["given"], batch["hash"], codes, counts, bands, signatures]

        return work

    schema = "doc bigint, given boolean, hash bigint, code binary, n int, bands array<bigint>, signature binary"
    return map_batches(docs, schema, make)


def tail(matches: int, seen: int, threshold: float) -> float:
    """The chance that a similarity is at least ``threshold`` if ``matches`` of ``seen``
    MinHashes agree, all similarities being equally likely before: a beta distribution's
    upper tail, as a binomial sum."""
    n = seen + 1
    return sum(math.comb(n, j) * threshold**j * (1 - threshold) ** (n - j) for j in range(matches + 1))


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """After 16, 32, ... MinHashes: the fewest matches with which a pair goes on."""
    return [
        next(m for m in range(seen + 2) if m > seen or tail(m, seen, threshold) >= tolerance)
        for seen in range(STEP, HASHES + 1, STEP)
    ]


def surviving_pairs(left: np.ndarray, right: np.ndarray, least: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of two signature matrices that the comparison does not drop.

    MinHashes are compared 16 at a time; a pair whose chance of reaching the threshold has
    fallen below the tolerance is not looked at again.
    """
    first = (left[:, None, :STEP] == right[None, :, :STEP]).sum(axis=2, dtype=np.int16)
    i, j = np.nonzero(first >= least[0])
    matches = first[i, j]
    for step, needed in enumerate(least[1:], 1):
        part = slice(step * STEP, (step + 1) * STEP)
        matches = matches + (left[i, part] == right[j, part]).sum(axis=1, dtype=np.int16)
        stay = matches >= needed
        i, j, matches = i[stay], j[stay], matches[stay]
    return i, j


def forest(n: int, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a graph on 0..n-1, as (member, root) pairs, by spreading the least label."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    return [(x, int(label[x])) for x in range(n) if label[x] != x]


def in_blocks(members: DataFrame, group: str, sizes: DataFrame, node: str) -> DataFrame:
    """Rows of a group, dealt out to pairs of blocks: ``x`` and ``y`` are the pair, ``own``
    says which of the two a row is in.

    ``sizes`` has the groups' ``m``. A group of up to ``BLOCK`` rows is one block with itself;
    in a larger one a row goes to as many tasks as the group has blocks.
    """
    joined = members.join(sizes, group)
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64(node, F.lit(3)), blocks).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = joined.withColumn("blocks", blocks).withColumn("own", mine).select("*", others)
    return dealt.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("other", "m", "blocks")


def grouped(run):
    """For ``mapInArrow`` over partitions sorted by (group, x, y): calls ``run`` per block pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch[name]).astype(np.int64) for name in ("group", "x", "y")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                key = tuple(keys[:, a].tolist())
                if key != now and held:
                    yield from run(pa.Table.from_batches(held))
                    held = []
                now = key
                held.append(batch.slice(a, b - a))
        if held:
            yield from run(pa.Table.from_batches(held))

    return work


def candidate_edges(reps: DataFrame, least: list[int]) -> DataFrame:
    """``(a, b)``: for each bucket, a spanning forest of the pairs that pruning left.

    A bucket holds the texts that agree in one band. Buckets with the same members are
    looked at once. No pair is sent anywhere: a task compares the signatures of a block with
    those of another and passes on at most one edge per member.
    """
    entries = saved(
        reps.select("node", F.posexplode("bands").alias("band", "hash")).select(
            F.xxhash64("band", "hash").alias("key"), "node"
        ),
        "bands",
    )
    buckets = (
        entries.groupBy("key")
        .agg(
            F.count("*").alias("m"),
            F.bit_xor(F.xxhash64("node")).alias("one"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
        )
        .where("m > 1")
        .groupBy("m", "one", "two")
        .agg(F.min("key").alias("group"))
        .select("group", "m")
    )
    buckets = saved(buckets, "buckets")
    members = entries.withColumnRenamed("key", "group").join(small(buckets.select("group")), "group", "left_semi")
    members = saved(in_blocks(members, "group", small(buckets), "node"), "members")
    near = small(saved(members.select("node").distinct(), "near"))
    rows = members.join(reps.join(near, "node", "left_semi").select("node", "signature"), "node")

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nodes = np.asarray(table["node"])
        signed = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint32).reshape(-1, HASHES)
        own, x, y = (np.asarray(table[name]) for name in ("own", "x", "y"))
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        found = []
        for first in range(0, len(left), 128):
            i, j = surviving_pairs(signed[left[first : first + 128]], signed[right], least)
            found.append((left[first + i], right[j]))
        i, j = (np.concatenate(part) for part in zip(*found)) if found else (left, left)
        off = i != j
        edges = forest(len(nodes), i[off], j[off])
        yield pa.RecordBatch.from_pydict(
            {"a": pa.array(nodes[[a for a, _ in edges]]), "b": pa.array(nodes[[b for _, b in edges]])}
        )

    dealt = dealt_out(rows.select("group", "x", "y", "own", "node", "signature"))
    return dealt.mapInArrow(grouped(run), "a bigint, b bigint")


def dealt_out(rows: DataFrame) -> DataFrame:
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(count, "group", "x", "y").sortWithinPartitions("group", "x", "y")


def verified(rows: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, n)``: exact links within block pairs of candidate groups.

    A row (a, a, n) says that text a has n links in that pair of blocks; the others are a
    spanning forest of the links. Overlaps are counted for whole blocks at once, as products
    of 0/1 matrices over a few thousand shingles at a time.
    """

    def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        names, at = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        often = np.bincount(at, minlength=len(names)) > 1
        number = np.cumsum(often) - 1
        keep = often[at]
        at, row = number[at[keep]], row[keep]
        order = np.argsort(at, kind="stable")
        at, row = at[order], row[order]
        out = np.zeros((len(left), len(right)), np.float32)
        for first in range(0, int(often.sum()), 4096):
            a, b = np.searchsorted(at, [first, first + 4096])
            hits = np.zeros((len(sets), min(4096, int(often.sum()) - first)), np.float32)
            hits[row[a:b], at[a:b] - first] = 1
            out += hits[left] @ hits[right].T
        return out

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nodes = np.asarray(table["node"])
        sets = [np.frombuffer(raw, np.uint64) for raw in table["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets], np.float64)
        own, x, y = (np.asarray(table[name]) for name in ("own", "x", "y"))
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        both = overlaps(sets, left, right)
        linked = both >= threshold * (sizes[left][:, None] + sizes[right][None, :] - both) - 1e-6
        linked &= left[:, None] != right[None, :]
        i, j = np.nonzero(linked)
        counts = np.bincount(left[i], minlength=len(nodes))
        if len(x) and x[0] != y[0]:
            counts += np.bincount(right[j], minlength=len(nodes))
        edges = forest(len(nodes), left[i], right[j])
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {
                "a": pa.array(np.concatenate([nodes[met], nodes[[a for a, _ in edges]]]).astype(np.int64)),
                "b": pa.array(np.concatenate([nodes[met], nodes[[b for _, b in edges]]]).astype(np.int64)),
                "n": pa.array(np.concatenate([counts[met], np.zeros(len(edges), np.int64)]).astype(np.int64)),
            }
        )

    return rows.mapInArrow(grouped(run), "a bigint, b bigint, n bigint")


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(node, shingles)`` of the wanted texts, read again from the documents."""

    def make():
        read = shingle_reader(size)
        import xxhash

        def work(batch: pa.RecordBatch) -> list:
            nodes, sets = [], []
            for node, code, text in zip(*(batch[name].to_pylist() for name in ("node", "code", "text"))):
                raw = read([text])[0].tobytes()
                if xxhash.xxh3_128_digest(raw) == code:
                    nodes.append(node)
                    sets.append(raw)
            return [nodes, sets]

        return work

    rows = docs.join(small(wanted), "doc").select("node", "code", "text")
    return map_batches(rows, "node bigint, shingles binary", make).dropDuplicates(["node"])


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``(doc_id, class_id, rep_id, copies, n_links)`` of every row.

    Two texts are linked if the Jaccard similarity of their sets of ``size`` words in a row is
    at least ``threshold``. ``rep_id`` is the least id among texts with the same set,
    ``copies`` how many rows have it, ``n_links`` how many other sets the text is linked
    with, and ``class_id`` the least id of all texts that links lead to.

    Rows with the same set become one text first, counted before they are shuffled. MinHash
    bands propose candidates (a pair at 0.8 shares no band with a chance of 3e-6); within a
    bucket signatures are compared 16 hashes at a time, and a pair is dropped once its chance
    of reaching the threshold is below ``tolerance``. Texts joined by what is left form
    groups, in which all pairs are verified on the full sets. No pairs are written: tasks pass
    on each text's number of links and a spanning forest of them.

    Ids are whole numbers. Null and empty texts have no shingles; they are copies of one another and linked with
    nothing. A null id stays null; its text is known by a number of its own, and a class with
    no id at all has a null ``class_id``. Rows listed twice count as copies. An empty table
    gives an empty table.
    """
    kind = df.schema[id_col].dataType.simpleString()
    joined = joined_rows(df, id_col, text_col, threshold, size, tolerance)
    return joined.select(
        F.when(F.col("given"), F.col("doc")).cast(kind).alias(id_col),
        F.col("class_id").cast(kind).alias("class_id"),
        F.col("rep").cast(kind).alias("rep_id"),
        "copies",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def joined_rows(
    df: DataFrame, id_col: str, text_col: str, threshold: float, size: int, tolerance: float
) -> DataFrame:
    """Per row: its key and text hash, its set's and class's figures, and the class's number."""
    text = text_of(text_col)
    given = column(id_col).isNotNull().alias("given")
    docs = df.select(key_of(id_col, text).alias("doc"), given, F.xxhash64(text).alias("hash"), text.alias("text"))
    signed = signatures(docs, size).withColumn("row", F.monotonically_increasing_id())
    signed = saved(signed, "signatures")
    sets = saved(
        signed.groupBy("code").agg(F.min("row").alias("node"), F.min(F.when(F.col("given"), F.col("doc"))).alias("rep"), F.count("*").alias("copies")),
        "sets",
    )
    copies = saved(sets.where("copies > 1").select("code", "node"), "copies")
    other = signed.select("code", "row").join(small(copies), "code").where("row != node").select("row")
    reps = signed.where("n > 0").join(small(saved(other, "others")), "row", "left_anti").withColumnRenamed("row", "node")
    least = least_matches(threshold, tolerance)
    near = saved(rounds_of_components(candidate_edges(reps, least)), "candidates")
    near = near.withColumnRenamed("component", "group")
    sizes = saved(near.groupBy("group").agg(F.count("*").alias("m")), "group-sizes")
    wanted = saved(reps.join(near.select("node"), "node").select("node", "doc", "code"), "wanted")
    members = in_blocks(near, "group", small(sizes), "node")
    rows = shingle_sets(docs, wanted, size).join(members, "node")
    dealt = dealt_out(rows.select("group", "x", "y", "own", "node", "shingles"))
    links = saved(verified(dealt, threshold), "links")
    counts = links.where("a = b").groupBy("a").agg(F.sum("n").alias("n_links"))
    classes = rounds_of_components(links.where("a != b").select("a", "b"))
    known = classes.join(counts, F.col("node") == F.col("a")).select("node", "component", "n_links")
    named = saved(
        sets.join(known, "node", "left").withColumn("component", F.coalesce("component", "node")),
        "named",
    )
    least_id = saved(named.groupBy("component").agg(F.min("rep").alias("class_id")), "classes")
    named = saved(named.join(least_id, "component").select("code", "component", "class_id", "rep", "copies", "n_links"), "members")
    return signed.select("doc", "given", "hash", "code").join(named, "code")


def drop_near_copies(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row of each class of :func:`near_duplicates`: the one with the least id, and of
    texts with that id the one with the least hash. Rows without an id come last.

    What goes is joined to the rows, not what stays, as that is the smaller part. The rows keep all
    their columns; names that begin with ``larder_`` are reserved.
    """
    rows = saved(joined_rows(df, id_col, text_col, threshold, size, tolerance).select("doc", "given", "hash", "component"), "near-rows")
    order = F.struct((~F.col("given")).alias("no_id"), "doc", "hash")
    classes = rows.groupBy("component").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    classes = saved(classes.select(F.col("component").alias("class"), "first.doc", "first.hash"), "near-classes")
    keeper = small(classes.withColumnsRenamed({"doc": "first_doc", "hash": "first_hash"}))
    stays = (F.col("doc") == F.col("first_doc")) & (F.col("hash") == F.col("first_hash"))
    inside = rows.join(keeper, F.col("component") == F.col("class")).withColumn("stays", stays)
    marked = saved(inside.groupBy("doc", "hash", "stays").agg(F.count("*").alias("n")), "near-marked")
    marked = marked.withColumnsRenamed({"doc": "larder_doc", "hash": "larder_hash"})
    text = text_of(text_col)
    same = (key_of(id_col, text) == F.col("larder_doc")) & (F.xxhash64(text) == F.col("larder_hash"))
    names = [column(name) for name in df.columns]
    keyed = df.select(*names)
    left = keyed.join(small(marked.where("not stays").select("larder_doc", "larder_hash")), same, "left_anti")
    twice = marked.where("stays and n > 1").select("larder_doc", "larder_hash")
    if twice.isEmpty():
        return left
    once = left.join(small(twice), same, "left_anti")
    often = left.join(small(twice), same).dropDuplicates(["larder_doc", "larder_hash"]).select(*names)
    return once.unionByName(often)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs)
