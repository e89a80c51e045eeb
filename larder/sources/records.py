"""CSV whose quoted fields hold line ends, read by splits of a file."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from larder.session import shared_dir
from larder.sources.files import infer_types

BROADCAST_SPLITS = 200_000
EFFECTS = "file bigint, start bigint, length bigint, from_out boolean, from_in boolean"
RECORDS = "file bigint, start bigint, part int, header boolean, record binary"
# what a piece of a record is to its split
WHOLE, THROUGH, END, BEGIN = range(4)


def quote_state(sep: bytes):
    """A function ``(line, quoted) -> quoted``: whether a quoted field is open after a line.

    A field is quoted if its first character is a quote; ``""`` inside is one quote, and what
    follows the closing quote belongs to the field up to the separator. Quotes elsewhere are
    ordinary characters.
    """
    inside = re.compile(rb'[^"]*(?:""[^"]*)*')

    def after(line: bytes, quoted: bool) -> bool:
        at = 0
        while True:
            if quoted:
                at = inside.match(line, at).end()
                if at == len(line):
                    return True
                quoted = False
            # outside quotes, or behind a closing one: the field ends at the separator
            at = line.find(sep, at)
            if at < 0:
                return False
            at += len(sep)
            if line[at : at + 1] == b'"':
                quoted, at = True, at + 1

    return lambda line, quoted: after(line, True) if quoted else after(sep + line, False)


def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """The stretches of a batch's rows that come from one split."""
    file, start = batch["file"].to_numpy(), batch["start"].to_numpy()
    cuts = [0, *((file[1:] != file[:-1]) | (start[1:] != start[:-1])).nonzero()[0] + 1, batch.num_rows]
    yield from ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def split_effects(sep: bytes):
    """A function for ``mapInArrow``: the state after each split, for both states before it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = quote_state(sep)
        key, ends = None, (False, True)

        def result() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    **{name: pa.array([value], pa.int64()) for name, value in zip(("file", "start", "length"), key)},
                    "from_out": pa.array([ends[0]]),
                    "from_in": pa.array([ends[1]]),
                }
            )

        for batch in batches:
            for a, b in runs(batch):
                here = tuple(batch[name][a].as_py() for name in ("file", "start", "length"))
                if here != key:
                    if key is not None:
                        yield result()
                    key, ends = here, (False, True)
                for line in batch["line"].slice(a, b - a).drop_null().to_pylist():
                    if ends[0] == ends[1]:
                        ends = (state(line, ends[0]),) * 2
                    else:
                        ends = state(line, ends[0]), state(line, ends[1])
        if key is not None:
            yield result()

    return work


def split_records(sep: bytes):
    """A function for ``mapInArrow``: the records of a split, and the pieces at its two ends."""
    names = ["file", "start", "part", "header", "record"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = quote_state(sep)
        key, quoted, part, held, first = None, False, WHOLE, [], False
        found: list[tuple] = []  # records of this batch

        def close(kind: int) -> None:
            nonlocal held, part, first
            record = b"\n".join(held)
            header = first and record not in (b"", b"\r")
            found.append((*key, kind, header, record))
            held, part, first = [], WHOLE, first and not header

        def flush() -> pa.RecordBatch:
            nonlocal found
            columns = list(zip(*found)) or [()] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            found = []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            marked = pc.greater(pc.count_substring(batch["line"], b'"'), 0).to_pylist()
            for a, b in runs(batch):
                here = batch["file"][a].as_py(), batch["start"][a].as_py()
                if here != key:
                    if held:
                        close(THROUGH if part == END else BEGIN)
                    known = batch["quoted"][a].as_py()
                    if known is None:
                        raise ValueError("the file's splits changed between two readings of it; read it again")
                    key, quoted, first = here, known, here[1] == 0
                    part = END if quoted else WHOLE
                for line, has in zip(batch["line"].slice(a, b - a).to_pylist(), marked[a:b]):
                    held.append(line)
                    if has:
                        quoted = state(line, quoted)
                    if not quoted:
                        close(part)
            yield flush()
        if held:
            close(THROUGH if part == END else BEGIN)
        yield flush()

    return work


def split_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(file, start, length, line)``: every line with the split it begins in, in order."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("value").cast("binary").alias("line"),
        F.col("value").contains('"').alias("marked"),
    )


def states_before(effects: DataFrame) -> DataFrame:
    """Add ``quoted``: whether a quoted field is open where a split begins.

    A split either fixes the state behind it, keeps it or turns it round. So the state is that
    of the last split that fixed one, turned round as often as later splits do: running
    functions over one small row per split.
    """
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("from_out") == F.col("from_in")
    turns = F.sum(F.when(~fixed & F.col("from_out"), 1).otherwise(0)).over(order)
    counted = effects.withColumn("turns", turns)
    last = F.last(F.when(fixed, F.struct("from_out", "turns")), ignorenulls=True).over(before)
    seen = counted.withColumn("last", last).withColumn("so_far", F.coalesce(F.lag("turns").over(order), F.lit(0)))
    turned = (F.col("so_far") - F.coalesce(F.col("last.turns"), F.lit(0))) % 2 == 1
    state = F.coalesce(F.col("last.from_out"), F.lit(False)) != turned
    return seen.select("file", "start", "length", "from_out", "from_in", state.alias("quoted"))


def with_states(lines: DataFrame, states: DataFrame, how: str, splits: int) -> DataFrame:
    """Lines with the state before their split, in order, by a join on the split."""
    keys = ["file", "start", "length"]
    states = states.select(*keys, "quoted")
    if splits <= BROADCAST_SPLITS:
        return lines.join(F.broadcast(states), keys, how)
    numbered = lines.withColumn("nth", F.monotonically_increasing_id())
    return numbered.join(states, keys, how).repartition(*keys).sortWithinPartitions(*keys, "nth")


def read_records(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """``(header, record)``: the text of each CSV record, line ends in quoted fields included.

    Every file is read by splits, so one big file is many tasks. The first pass follows the
    quotes of each split from both states, inside a quoted field and outside; running
    functions over the splits then say which of the two it was, and the second pass cuts
    records. A record that reaches over splits is joined from its pieces; they are read in a
    third pass over the splits that have any, left out where none has. Memory: one batch and
    one record a task. Records end with ``\\n`` or ``\\r\\n``; empty lines between records are none.
    """
    shared_dir(spark)
    width = sep.encode()
    lines = split_lines(spark, path)
    quotes = lines.select("file", "start", "length", F.when(F.col("marked"), F.col("line")).alias("line"))
    states = states_before(quotes.mapInArrow(split_effects(width), EFFECTS)).checkpoint()
    splits = states.count()
    ends_in = F.when(F.col("quoted"), F.col("from_in")).otherwise(F.col("from_out"))
    broken = states.where(F.col("quoted") | ends_in)
    lines = lines.select("file", "start", "length", "line")
    cut = split_records(width)
    found = with_states(lines, states, "left", splits).mapInArrow(cut, RECORDS)
    whole = found.where(F.col("part") == WHOLE).select("header", "record")
    n_broken = broken.count()
    if n_broken:
        pieces = with_states(lines, broken, "inner", n_broken).mapInArrow(cut, RECORDS).where(F.col("part") != WHOLE)
        order = Window.partitionBy("file").orderBy("start", "part")
        group = F.sum((F.col("part") == BEGIN).cast("int")).over(order)
        joined = pieces.withColumn("group", group).groupBy("file", "group")
        listed = F.array_sort(F.collect_list(F.struct("start", "part", F.col("record").cast("string").alias("text"))))
        joined = joined.agg(F.max("header").alias("header"), listed.alias("pieces"))
        record = F.array_join(F.col("pieces.text"), "\n").cast("binary")
        whole = whole.union(joined.select("header", record.alias("record")))
    text = F.regexp_replace(F.col("record").cast("string"), "\r$", "")
    text = F.when(F.col("header"), F.ltrim(text, F.lit("\ufeff"))).otherwise(text)
    return whole.select("header", text.alias("record")).where("header or record <> ''")


def read_quoted_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    infer: bool = False,
    sep: str = ",",
) -> DataFrame:
    """The rows that ``read_csv(..., multiline=True)`` gives, with many tasks for a big file.

    Files have a header line; files whose headers differ, or differ from ``schema``, are an
    error when the rows are read. Without a schema every column is a string, or has the type
    that :func:`~larder.sources.files.infer_types` finds. See :func:`read_records` for the way.
    """
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    reader = spark.read.options(**options)
    first = reader.option("header", False).csv(path).first()
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if first is None:
        return spark.createDataFrame([], schema or T.StructType())
    titles = [title or "" for title in first]
    if schema is None:
        names = reader.option("header", True).csv(path).columns
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    elif [name.lower() for name in schema.names] != [title.lower() for title in titles]:
        raise ValueError(f"the header {titles} does not name the columns of the schema, {schema.names}")
    else:
        infer = False
    records = read_records(spark, path, sep)
    listed = ", ".join(f"`t{i}` string" for i in range(len(titles) + 1))
    header = F.from_csv("record", F.lit(listed), options)
    same = F.lit(True)
    for i, title in enumerate([*titles, ""]):
        same = same & (F.coalesce(header[f"t{i}"], F.lit("")) == title)
    error = F.raise_error(F.concat(F.lit("the header of a file differs from that of the first: "), "record"))
    row = F.when(~F.col("header"), True).when(same, False).otherwise(error.cast("boolean"))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    fields = records.where(row).select(F.from_csv("record", F.lit(ddl), options).alias("row"))
    rows = fields.select([F.col("row")[name].alias(name) for name in schema.names])
    return infer_types(rows) if infer else rows
