"""Benchmark items in documents: latent semantic search, then a check of the wording."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from larder.functions import column
from larder.llm.common import bounded_batches, map_batches, release, saved, slices, text_of, without

BUCKETS = 1 << 16
DIMENSIONS = 256
WINDOW, STRIDE = 32, 16
GROUP = 12  # windows whose words are counted together
MARGIN = (64 - GROUP - 1) // 2  # blocks of ``STRIDE`` words on either side of them that have a bit of their own
RUN = 3  # words in a row that make an item a candidate; the windows' overlap must hold them
LEAST_COSINE = 0.3
LEAST_OVERLAP = 0.6
PARAPHRASE_OVERLAP, ANSWER_OVERLAP = 0.45, 0.8
MAX_ITEMS = 100_000
WORD = re.compile(r"\w+")
#: ASCII letters in lower case, digits, the underscore and all bytes beyond ASCII; the rest become spaces.
ROUGH_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() or b == 0x5F else 32 for b in range(256))


def numbered(words: set[str]) -> dict[str, int]:
    """A number from 1 for each word; 0 stands for all others. At most ``BUCKETS`` numbers:
    beyond, words share them."""
    return {word: 1 + i % BUCKETS for i, word in enumerate(sorted(words))}


def word_codes(numbers: dict[str, int]):
    """A function from texts to the numbers of their words, one text after another, and how
    many words each has: those that ``WORD`` finds in the lowered text.

    Texts are cut at ASCII characters that no word holds, and each distinct stretch of a
    batch is looked up once. One beyond ASCII is lowered and searched for words, which may be none or
    several. A capital sigma is lowered by what is around it, so texts with one are read whole.
    """
    known = pa.array(sorted(numbers), pa.string())
    code_of = np.array([*(numbers[word] for word in sorted(numbers)), 0], np.int32)

    def codes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        sigma = pc.match_substring(texts, "Σ")
        whole = np.flatnonzero(np.asarray(sigma))
        if len(whole):
            read = [[numbers.get(w, 0) for w in WORD.findall(text.lower())] for text in texts.filter(sigma).to_pylist()]
            texts = pc.if_else(sigma, "", texts)
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2] or pa.py_buffer(b"")
        raw = bytes(memoryview(data)[ends[0] : ends[-1]]).translate(ROUGH_BYTES)
        rough = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(ends - ends[0]), pa.py_buffer(raw)])
        split = pc.split_pattern(rough, " ")
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary
        found = np.asarray(pc.fill_null(pc.index_in(distinct, value_set=known), len(known)))
        code, many = code_of[found], np.asarray(pc.not_equal(distinct, "")).astype(np.int32)
        first = np.arange(len(distinct), dtype=np.int32)
        beyond = np.flatnonzero(~np.asarray(pc.string_is_ascii(distinct)))
        lowered = [word.lower() for word in distinct.take(pa.array(beyond)).to_pylist()]
        single = np.fromiter(map(str.isalnum, lowered), bool, len(lowered))  # letters and digits alone are a word
        found = np.asarray(pc.fill_null(pc.index_in(pa.array(lowered, pa.string()), value_set=known), len(known)))
        code[beyond[single]] = code_of[found[single]]
        more = []
        for i in np.flatnonzero(~single).tolist():
            parts = WORD.findall(lowered[i])
            first[beyond[i]], many[beyond[i]] = len(code) + len(more), len(parts)
            more += [numbers.get(part, 0) for part in parts]
        code = np.concatenate([code, np.array(more, np.int32)])
        at = np.asarray(words.indices)
        counts = many[at]
        before = np.cumsum(counts)
        out = code[np.repeat(first[at] - (before - counts), counts) + np.arange(before[-1] if len(before) else 0)]
        sizes = np.diff(np.concatenate([[0], before])[np.asarray(split.offsets) - split.offsets[0].as_py()])
        if len(whole):
            starts = np.concatenate([[0], np.cumsum(sizes)])
            parts = np.split(out, starts[whole])
            out = np.concatenate([x for pair in zip(parts, [*(np.array(r, np.int32) for r in read), []]) for x in pair])
            sizes[whole] = [len(r) for r in read]
        return out.astype(np.int32), sizes.astype(np.int64)

    return codes


def document_counts(docs: DataFrame, numbers: dict[str, int]) -> tuple[np.ndarray, int]:
    """In how many documents each numbered word occurs, and the number of documents."""
    size = 1 + min(BUCKETS, len(numbers))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = word_codes(numbers)
        total = np.zeros(size, np.int64)
        rows = 0
        for batch in (part for whole in batches for part in slices(whole, 1 << 20)):
            rows += batch.num_rows
            at, sizes = codes(batch["larder_text"])
            doc = np.repeat(np.arange(batch.num_rows), sizes)
            each = np.unique(doc[at > 0] * size + at[at > 0])
            total += np.bincount(each % size, minlength=size)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(np.concatenate([met, [-1]]).astype(np.int32)),
                "n": pa.array(np.concatenate([total[met], [rows]]).astype(np.int64)),
            }
        )
        release()

    bounded_batches(docs.sparkSession)
    parts = docs.select("larder_text").mapInArrow(count, "i int, n bigint").groupBy("i").agg(F.sum("n").alias("n"))
    found = {row["i"]: row["n"] for row in parts.collect()}
    rows = found.pop(-1, 0)
    out = np.zeros(size, np.int64)
    for i, n in found.items():
        out[i] = n
    return out, rows


def passages_of(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(item, passage, words)``: items cut into windows of at most 64 words, half overlapping."""

    def make():
        def work(batch: pa.RecordBatch) -> list:
            ids, numbers, words = [], [], []
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist()):
                found = WORD.findall(text.lower())
                for number, start in enumerate(range(0, max(1, len(found) - WINDOW), WINDOW)):
                    if found:
                        ids.append(item)
                        numbers.append(number)
                        words.append(found[start : start + 2 * WINDOW])
            return [ids, numbers, words]

        return work

    rows = items.select(column(id_col).cast("bigint").alias("item"), text_of(text_col).alias("text")).where("item is not null")
    return map_batches(rows, "item bigint, passage int, words array<string>", make)


def sketch(numbers: dict[str, int], idf: np.ndarray, basis: np.ndarray | None, dims: int, seed: int):
    """A function for ``mapInArrow``: a task's part of A'G, or of A'(A basis).

    A has a row per passage, of length 1, and a column per word number. G is drawn per
    passage from its own seed, so no task needs another's rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for item, passage, words in zip(*(batch[name].to_pylist() for name in ("item", "passage", "words"))):
                at = np.array([numbers[word] for word in words], np.int64)
                value = idf[at] / np.sqrt(np.square(idf[at]).sum())
                if basis is None:
                    right = np.random.default_rng([seed, item & 0xFFFFFFFF, passage]).standard_normal(dims)
                else:
                    right = value @ basis[at]
                for i, v in zip(at.tolist(), value.tolist()):
                    total[i] = total.get(i, 0.0) + v * right
        yield pa.RecordBatch.from_pydict(
            {
                "i": pa.array(list(total), pa.int32()),
                "v": pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64())),
            }
        )

    return run


def latent_space(
    passages: DataFrame, numbers: dict[str, int], idf: np.ndarray, dims: int, seed: int = 7, powers: int = 2
) -> np.ndarray:
    """An orthonormal basis (words x dims) of the passages' leading right singular vectors.

    Randomised SVD: a random sketch of the passages' tf-idf matrix, sharpened by power
    iterations, each one pass over the passages in which a task adds up at most ``BUCKETS``
    rows of ``dims`` numbers. Only their sum reaches the driver.
    """

    def gathered(basis: np.ndarray | None) -> np.ndarray:
        parts = passages.mapInArrow(sketch(numbers, idf, basis, dims, seed), "i int, v array<double>")
        summed = parts.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
        out = np.zeros((len(idf), dims))
        table = summed.toArrow()
        out[np.asarray(table["i"]), np.asarray(table["j"])] = np.asarray(table["x"])
        return out

    def orthonormal(matrix: np.ndarray) -> np.ndarray:
        left, size, _ = np.linalg.svd(matrix, full_matrices=False)
        out = np.zeros_like(matrix)
        out[:, : left.shape[1]] = left * (size > 1e-9 * size[:1].sum())
        return out

    basis = orthonormal(gathered(None))
    for _ in range(powers):
        basis = orthonormal(gathered(basis))
    return basis


def common_words(left: list[str], right: list[str]) -> int:
    """The length of the longest common subsequence, by bit vectors: one step per word."""
    places: dict[str, int] = {}
    for i, word in enumerate(left):
        places[word] = places.get(word, 0) | 1 << i
    full = (1 << len(left)) - 1
    row = full
    for word in right:
        met = row & places.get(word, 0)
        row = (row + met | row - met) & full
    return len(left) - row.bit_count()


def answer_of(text: str) -> list[str]:
    """The words of an item's last sentence, which stands for its answer."""
    parts = [WORD.findall(part.lower()) for part in re.split(r"[.!?\n]+", text)]
    parts = [part for part in parts if part]
    return parts[-1] if parts else []


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    dims: int = DIMENSIONS,
    least_cosine: float = LEAST_COSINE,
    least_overlap: float = LEAST_OVERLAP,
) -> DataFrame:
    """Add ``contaminated``, ``items`` and ``overlap`` to every document.

    Every window of 32 words, each half overlapping the next, is compared by the cosine in the
    latent space with every passage of the items that have enough of their words, in any order,
    around it; the others can't be found there, whatever their cosine. Where it is at least
    ``least_cosine``, or where the window holds three words in a row that an item has, the
    words around are compared with the item's. An item is found if the
    longest common subsequence holds ``least_overlap`` of its words, or as a paraphrase if it
    holds 0.45 of them and 0.8 of its answer, the item's last sentence. ``items`` lists the
    found items' ids, ``overlap`` is the largest share.

    Word weights are inverse document frequencies over all documents. The space is fitted on
    the benchmark's passages, all of them, as only what they hold can tell an item from
    another. Words outside the benchmark count nowhere, and both sides of the cosine are
    normalised in the space, so neither the number of documents nor what the space leaves out
    of a large benchmark lowers the cosine of a copy. An item of fewer than three words is
    found by the cosine alone. The benchmark goes to every task and
    must have at most 100,000 items, else an error is raised.

    Null and empty texts and items without words or ids match nothing; equal items are all
    listed; repeated rows give repeated results; an empty benchmark finds nothing. Input
    columns with the names of the outputs, in whatever case, are replaced; ``larder_text`` is reserved.
    """
    fields = without(docs, ("contaminated", "items", "overlap"))
    added = T.StructType.fromDDL("contaminated boolean, items array<bigint>, overlap double").fields
    names = [field.name for field in fields]
    rows = docs.withColumn("larder_text", text_of(text_col))
    items = saved(
        benchmark.select(column(item_col).cast("bigint").alias("item"), text_of("text").alias("text")).where("item is not null"),
        "bench",
    )
    if items.limit(MAX_ITEMS + 1).count() > MAX_ITEMS:
        raise ValueError(f"more than {MAX_ITEMS} benchmark items")
    passages = saved(passages_of(items, "item", "text"), "bench-passages")
    plain = passages.orderBy("item", "passage").collect()
    if not plain:
        nothing = F.lit(False).alias("contaminated"), F.array().cast("array<bigint>").alias("items")
        return docs.select(*[column(name) for name in names], *nothing, F.lit(0.0).alias("overlap"))
    numbers = numbered({word for row in plain for word in row["words"]})
    counts, n_docs = document_counts(rows, numbers)
    idf = np.log((1 + n_docs) / (1 + counts)) + 0.05
    dims = max(1, min(dims, len(plain)))
    basis = latent_space(passages, numbers, idf, dims)
    basis[0] = 0
    at = [np.array([numbers[word] for word in row["words"]]) for row in plain]
    latent = np.stack([idf[x] @ basis[x] for x in at])
    latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    texts: dict[int, list[tuple[list[str], list[str]]]] = {}
    for row in items.collect():
        texts.setdefault(row["item"], []).append((WORD.findall(row["text"].lower()), answer_of(row["text"])))
    search = searcher(
        numbers, (idf[:, None] * basis).astype(np.float32), latent, [row["item"] for row in plain], texts,
        least_cosine, least_overlap, names,
    )
    return map_batches(rows, T.StructType([*fields, *added]), search)


def word_runs(codes: np.ndarray) -> np.ndarray:
    """A number for each ``RUN`` words in a row, or -1 where one of them is outside the benchmark."""
    many = max(0, len(codes) - RUN + 1)
    key, known = np.zeros(many, np.int64), np.ones(many, bool)
    for k in range(RUN):
        part = codes[k : k + many].astype(np.int64)
        key = key * (BUCKETS + 1) + part
        known &= part > 0
    return np.where(known, key, -1)


def runs_of_items(numbers, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The items' runs, sorted and each once, where each one's items begin, and those items."""
    pairs = []
    for item, versions in texts.items():
        for words, _ in versions:
            runs = np.unique(word_runs(np.array([numbers[word] for word in words], np.int64)))
            pairs.append((runs, np.full(len(runs), item, np.int64)))
    runs, items = (np.concatenate(x) for x in zip(*pairs))  # -1 too, which no document's run equals
    runs, items = np.append(runs, -1), np.append(items, -1)
    order = np.lexsort((items, runs))
    runs, first = np.unique(runs[order], return_index=True)
    return runs, np.append(first, len(items)), items[order]


def block_bits(longest: int) -> np.ndarray:
    """The bit of each place around a stretch of windows, from ``longest`` words before its first.

    Blocks of ``STRIDE`` words have one bit each; all that lie farther off share the first or the last.
    """
    block = np.arange(-longest, (GROUP - 1) * STRIDE + WINDOW + longest) // STRIDE
    return np.uint64(1) << np.clip(block + MARGIN, 0, 63).astype(np.uint64)


def bits_around(lengths: np.ndarray) -> np.ndarray:
    """For each window of a stretch and each length of an item, the bits of all blocks that hold a word around the window."""
    start = STRIDE * np.arange(GROUP)[:, None]
    low, high = (np.clip(x // STRIDE + MARGIN, 0, 63).astype(np.uint64) for x in (start - lengths, start + WINDOW + lengths - 1))
    full = np.uint64(2**64 - 1)
    return full << low & full >> np.uint64(63) - high


def searcher(numbers, vectors, latent, owners, texts, least_cosine, least_overlap, names):
    """For :func:`map_batches`: found items and the largest overlap of each document."""
    block = max(16, min(2048, (4 << 20) // max(1, len(latent))))  # of windows, at most 16 MB of cosines
    runs, run_first, run_items = runs_of_items(numbers, texts)
    least = min(least_overlap, PARAPHRASE_OVERLAP) - 1e-9
    known = sorted(texts)
    places = {item: place for place, item in enumerate(known)}
    owners = np.array([places[item] for item in owners], np.int64)
    known = np.array(known, np.int64)
    versions = [(places[item], words) for item in texts for words, _ in texts[item] if words]
    version_of = np.array([place for place, _ in versions], np.int64)
    spelt = np.array([numbers[word] for _, words in versions for word in words], np.intp)
    lengths = np.array([len(words) for _, words in versions], np.int64)
    spelt_first = np.cumsum(lengths) - lengths
    longest, needed = int(lengths.max()), least * lengths
    bits, touched = block_bits(longest), bits_around(lengths)

    def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, start and end of every window over texts that lie one after another, and
        each document's first window."""
        ends = np.cumsum(sizes)
        many = np.where(sizes > 0, np.maximum(1, -(-(sizes - STRIDE) // STRIDE)), 0)
        doc = np.repeat(np.arange(len(sizes)), many)
        first = np.cumsum(many) - many
        number = np.arange(len(doc)) - np.repeat(first, many)
        start = (ends - sizes)[doc] + STRIDE * number
        return doc, start, np.minimum(start + WINDOW, ends[doc]), first

    unique = len(numbers) <= BUCKETS  # then numbers do for words
    if unique:
        texts = {
            item: [([numbers[w] for w in words], [numbers[w] for w in answer]) for words, answer in texts[item]]
            for item in texts
        }
        coded = {item: [np.array(words, np.int64) for words, _ in texts[item]] for item in texts}
        wanted_here = {item: [np.array([*words, *answer], np.int64) for words, answer in texts[item]] for item in texts}
    else:
        coded = {item: [np.array([numbers[w] for w in words], np.int64) for words, _ in texts[item]] for item in texts}
    here = np.zeros(BUCKETS + 1, bool)

    def matched(read, codes: np.ndarray, start: int, end: int, item: int) -> float:
        """The share of an item's words that lie around a window in the item's order, or 0."""
        best = 0.0
        for version, ((wanted, answer), spelling) in enumerate(zip(texts[item], coded[item])):
            around = slice(max(0, start - len(wanted)), end + len(wanted))
            here[codes[around]] = True
            met = np.count_nonzero(here[spelling])
            here[codes[around]] = False
            if met < least * len(wanted):
                continue  # too few even in any order
            if unique:  # other words than the item's are in no common subsequence
                near, own = codes[around], wanted_here[item][version]
                here[own] = True
                around = near[here[near]].tolist()
                here[own] = False
            else:
                around = read()[around]
            share = common_words(wanted, around) / max(1, len(wanted))
            enough = share >= least_overlap or (
                share >= PARAPHRASE_OVERLAP and common_words(answer, around) >= ANSWER_OVERLAP * len(answer)
            )
            if enough:
                best = max(best, share)
        return best

    def folds(padded, start, end) -> np.ndarray:
        """The sum of the words' vectors of each window: its first half and the second."""
        def half(first: np.ndarray) -> np.ndarray:
            places = first[:, None] + np.arange(STRIDE)
            codes = np.where(places < end[:, None], padded[np.minimum(places, len(padded) - 1)], 0)
            out = np.zeros((len(first), vectors.shape[1]), np.float32)
            for k in range(STRIDE):
                out += vectors[codes[:, k]]
            return out

        return half(start) + half(start + STRIDE)

    def possible(at, doc, start, text_start, text_end) -> tuple[np.ndarray, np.ndarray]:
        """(window, item's place) wherever enough of an item's words, in any order, lie around a
        window: no other item can be found there.

        Words are counted for stretches of at most ``GROUP`` windows of one text first, then, of the
        items that have enough there, for each window, by the blocks that hold each word.
        """
        new = np.append(True, doc[1:] != doc[:-1])
        since = np.arange(len(doc)) - np.maximum.accumulate(np.where(new, np.arange(len(doc)), 0))
        heads = np.flatnonzero(since % GROUP == 0)
        many = np.diff(np.append(heads, len(doc)))
        from_here = start[heads]
        low = np.maximum(text_start[doc[heads]], from_here - longest)
        high = np.minimum(text_end[doc[heads]], from_here + (many - 1) * STRIDE + WINDOW + longest)
        where = np.zeros(BUCKETS + 1, np.uint64)
        hits, held = [], []
        for first, end, begin in zip(low.tolist(), high.tolist(), (from_here - longest).tolist()):
            around = at[first:end]
            np.bitwise_or.at(where, around, bits[first - begin : end - begin])
            where[0] = 0
            blocks = where[spelt]
            where[around] = 0
            hit = np.flatnonzero(np.add.reduceat((blocks != 0).view(np.int8), spelt_first, dtype=np.int32) >= needed)
            hits.append(hit)
            if len(hit):
                sizes = lengths[hit]
                held.append(blocks[np.repeat(spelt_first[hit] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())])
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        stretch, version, blocks = np.repeat(np.arange(len(heads)), [len(x) for x in hits]), np.concatenate(hits), np.concatenate(held)
        sizes = lengths[version]
        begins = np.cumsum(sizes) - sizes
        out = []
        for k in range(GROUP):
            met = (blocks & np.repeat(touched[k, version], sizes) != 0).view(np.int8)
            enough = (np.add.reduceat(met, begins, dtype=np.int32) >= needed[version]) & (k < many[stretch])
            out.append((heads[stretch[enough]] + k, version_of[version[enough]]))
        window, place = (np.concatenate(x) for x in zip(*out))
        return window, place

    def make():
        codes = word_codes(numbers)
        maybe = np.zeros(1 << 22, bool)
        maybe[(runs * 0x9E3779B1 >> 16) & (1 << 22) - 1] = True

        def with_runs(at, doc_of, base, first, windows_of) -> tuple[np.ndarray, np.ndarray]:
            """(window, item) wherever a document has a run of the item's."""
            key = word_runs(at)
            place = np.flatnonzero((key > 0) & maybe[(key * 0x9E3779B1 >> 16) & (1 << 22) - 1])
            where = np.searchsorted(runs[:-1], key[place])
            real = (runs[where] == key[place]) & (doc_of[place] == doc_of[place + RUN - 1])
            place, where, doc = place[real], where[real], doc_of[place[real]]
            window = first[doc] + np.minimum((place - base[doc]) // STRIDE, windows_of[doc] - 1)
            many = run_first[where + 1] - run_first[where]
            offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            return np.repeat(window, many), run_items[np.repeat(run_first[where], many) + offset]

        def work(batch: pa.RecordBatch) -> list:
            at, sizes = codes(batch["larder_text"])
            read: dict[int, list[str]] = {}

            def words_of(i: int) -> list[str]:
                if i not in read:
                    read[i] = WORD.findall(batch["larder_text"][i].as_py().lower())
                return read[i]

            doc, start, end, first = windows(sizes)
            base = np.cumsum(sizes) - sizes
            doc_of = np.repeat(np.arange(len(sizes)), sizes)
            found = [with_runs(at, doc_of, base, first, np.bincount(doc, minlength=len(sizes)))]
            padded = np.concatenate([at, np.zeros(WINDOW, np.int32)])
            likely = []
            for low in range(0, len(doc), block):
                part = slice(low, low + block)
                window, place = possible(at, doc[part], start[part], base, base + sizes)
                likely.append((low + window) * len(known) + place)
                window, row = np.unique(window, return_inverse=True)
                enough = np.zeros((len(window), len(known)), bool)
                enough[row, place] = True
                folded = folds(padded, start[low + window], end[low + window])
                cosine = folded @ latent.T
                length = np.sqrt(np.einsum("ij,ij->i", folded, folded))
                w, p = np.nonzero((cosine >= least_cosine * length[:, None]) & (length[:, None] > 1e-6))
                real = enough[w, owners[p]]
                pairs = np.unique((low + window[w[real]]) * len(known) + owners[p[real]])
                found.append((pairs // len(known), known[pairs % len(known)]))
            window, item = (np.concatenate(x) for x in zip(*found))
            overlap = np.zeros(batch.num_rows)
            items: list[set[int]] = [set() for _ in range(batch.num_rows)]
            pairs = np.unique(window * len(known) + np.searchsorted(known, item))
            pairs = pairs[np.isin(pairs, np.concatenate([np.zeros(0, np.int64), *likely]))]
            for w, one in zip((pairs // len(known)).tolist(), known[pairs % len(known)].tolist()):
                i = int(doc[w])
                if one in items[i]:
                    continue
                own = at[base[i] : base[i] + sizes[i]]
                share = matched(lambda: words_of(i), own, int(start[w] - base[i]), int(end[w] - base[i]), one)
                if share:
                    items[i].add(one)
                    overlap[i] = max(overlap[i], share)
            lists = [sorted(x) for x in items]
            return [*[batch[name] for name in names], [bool(x) for x in lists], lists, overlap]

        return work

    return make


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "contaminated", "items", "overlap")
