"""CSV records whose quoted cells hold line breaks, read by as many tasks as the file has splits.

A split cannot tell whether it begins inside a quoted cell. So a first pass says of every
split where it would end from either beginning; the table of splits, one row each, is run
through in order; a second pass then puts the lines of each record together. Only the records
that cross the border of two splits are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..errors import DataLoadError
from ..functions.storage import cut_lineage

# A quoted cell: the quote opens it at its very start. Any other quote is plain text.
QUOTED = r'(?<![^,\r\n])"[^"]*+(?:""[^"]*+)*+"'
_OPENING = r'(?<![^,\r\n])"'
# Up to so many splits that begin inside a cell are sent to the tasks, one narrow row each.
BROADCAST_SPLITS = 200_000


def left_open(text: Column) -> Column:
    """Whether a quoted cell begins in the text and does not end there."""
    return F.regexp_replace(text, QUOTED, "q").rlike(_OPENING)


def states_after(from_outside: np.ndarray, from_inside: np.ndarray, inside: bool) -> np.ndarray:
    """For each line, whether its end lies in a cell, if the first begins ``inside`` one.

    The two arrays say so of each line alone, for either beginning. A line on which both
    agree forgets what was before; after it only the lines that swap the two count.
    """
    places = np.arange(len(from_outside))
    sure = np.maximum.accumulate(np.where(from_outside == from_inside, places, -1))
    swaps = np.cumsum(from_outside & ~from_inside)
    start = np.where(sure >= 0, from_outside[sure], inside)
    return start ^ ((swaps - np.where(sure >= 0, swaps[sure], 0)) % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """``(file, block), from, to`` of the stretches of one split in a batch."""
    files = batch.column("file").dictionary_encode()
    codes, blocks = files.indices.to_numpy(zero_copy_only=False), batch.column("block").to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
    for low, high in zip([0, *cuts], [*cuts, len(codes)]):
        yield (files.dictionary[int(codes[low])].as_py(), int(blocks[low])), int(low), int(high)


def _flags(batch: pa.RecordBatch, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False)[low:high].astype(bool) for c in ("s0", "s1"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split: where it ends from either beginning, and whether a record begins in
    it even if it begins inside a cell."""
    rows, states = [], [False, True]
    for batch in batches:
        if not batch.num_rows:
            continue
        for key, low, high in _runs(batch):
            if not rows or rows[-1][:2] != key:
                rows.append((*key, False, True, False))
                states = [False, True]
            flags = _flags(batch, low, high)
            after = [states_after(*flags, s) for s in states]
            begins = not (states[1] and after[1][:-1].all())
            states = [bool(a[-1]) for a in after]
            rows[-1] = (*key, *states, rows[-1][4] or begins)
    if rows:
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        yield pa.RecordBatch.from_arrays(columns, ["file", "block", "end0", "end1", "begins"])


def _splits(lines: DataFrame) -> DataFrame:
    """``file, block, inside, origin, unclosed`` of every split that has lines.

    ``origin`` is the split in which the record begins that the split begins inside of. The
    table has a row a split; those of one file are run through by one task.
    """
    ends = lines.select("file", "block", "s0", "s1").mapInArrow(
        _ends, "file string, block bigint, end0 boolean, end1 boolean, begins boolean"
    )
    order = Window.partitionBy("file").orderBy("block")
    so_far, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("end0") & ~F.col("end1")).cast("int")
    sure = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").cast("int").alias("s"), F.col("swaps").alias("n")))
    last = F.last("sure", ignorenulls=True).over(before)
    begun = F.coalesce(F.col("last.s"), F.lit(0)) + F.col("swaps") - swap - F.coalesce(F.col("last.n"), F.lit(0))
    table = ends.withColumn("swaps", F.sum(swap).over(so_far)).withColumn("sure", sure).withColumn("last", last)
    table = table.withColumn("inside", begun % 2 == 1)
    with_record = F.when(~F.col("inside") | F.col("begins"), F.col("block"))
    return table.select(
        "file", "block", "inside", F.last(with_record, ignorenulls=True).over(before).alias("origin"),
        (F.lead("block").over(order).isNull() & F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0"))).alias("unclosed"),
    )


def _assembled(carried: list[str]):
    """Function over batches of lines: one row a record, or the part of it that lies in the split."""
    names = ["text", "file", "block", "origin", "header", "part"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, origin, first, open_lines, from_before, fixed = None, False, None, False, [], False, []

        def rest() -> pa.RecordBatch:
            """What the split holds of the record that goes on in the next one."""
            begun = origin if from_before else key[1]
            row = ["\n".join(open_lines), key[0], key[1], begun, first and not from_before, True, *fixed]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()] + [pa.string()] * len(carried)
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names + carried)

        for batch in batches:
            if not batch.num_rows:
                continue
            for split, low, high in _runs(batch):
                lines = batch.slice(low, high - low)
                if split != key:
                    if open_lines:
                        yield rest()
                    key, origin, open_lines = split, lines.column("origin")[0].as_py(), []
                    inside = from_before = origin is not None
                    first, fixed = split[1] == 0, [lines.column(c)[0].as_py() for c in carried]
                after = states_after(*_flags(batch, low, high), inside)
                before = np.concatenate([[inside], after[:-1]])
                inside = bool(after[-1])
                whole, parts = {}, set()
                for i in np.flatnonzero(before | after):
                    open_lines.append(lines.column("value")[int(i)].as_py())
                    if not after[i]:
                        whole[int(i)] = "\n".join(open_lines)
                        parts.update({int(i)} if from_before else ())
                        open_lines, from_before = [], False
                done = np.flatnonzero(~after)
                texts = lines.column("value").take(pa.array(done))
                if whole:
                    texts = pa.array([whole.get(int(i), t) for i, t in zip(done, texts.to_pylist())], pa.string())
                header = np.zeros(len(done), bool)
                if first:
                    for place, i in enumerate(done):
                        if int(i) not in parts and texts[place].as_py().strip():
                            header[place], first = True, False
                            break
                n = len(done)
                yield pa.RecordBatch.from_arrays(
                    [
                        texts.cast(pa.string()), pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()),
                        pa.array([origin] * n, pa.int64()), pa.array(header), pa.array([int(i) in parts for i in done], pa.bool_()),
                        *[pa.array([v] * n, pa.string()) for v in fixed],
                    ],
                    names + carried,
                )
        if open_lines:
            yield rest()

    return assemble


def quoted_records(spark: SparkSession, path: str, encoding: str) -> tuple[DataFrame, list[str]]:
    """The text of every record but the headers, as ``text`` beside the folder columns, and those
    columns' names.

    The first record of each file is its header; blank records are left out. A carriage return
    outside of quoted cells ends a record too. Records of one split keep their order; those that
    cross a border come last.
    """
    rows = spark.read.option("lineSep", "\n").text(path)
    folders = rows.columns[1:]
    carried = [f"folder{i}" for i in range(len(folders))]
    value = F.col("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = rows.select(
        value.alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        *[F.col("`" + f.replace("`", "``") + "`").cast("string").alias(c) for f, c in zip(folders, carried)],
    )
    lines = lines.withColumns({"s0": left_open(F.col("value")), "s1": left_open(F.concat(F.lit('"'), "value"))})
    splits = cut_lineage(_splits(lines))
    seen = splits.agg(F.count_if("unclosed").alias("unclosed"), F.count_if("inside").alias("inside")).first()
    if seen["unclosed"]:
        raise DataLoadError("The CSV text is malformed: a quoted cell is never closed.")
    begun = splits.filter("inside").select("file", "block", "origin")
    if not seen["inside"]:
        lines = lines.withColumn("origin", F.lit(None).cast("bigint"))
    elif seen["inside"] <= BROADCAST_SPLITS:
        lines = lines.join(F.broadcast(begun), ["file", "block"], "left")
    else:
        # The lines of a split stay together and in order.
        lines = lines.withColumn("place", F.monotonically_increasing_id()).repartition("file", "block")
        lines = lines.join(begun, ["file", "block"], "left").sortWithinPartitions("file", "block", "place").drop("place")
    kinds = "text string, file string, block bigint, origin bigint, header boolean, part boolean"
    order = ["value", "file", "block", "origin", "s0", "s1", *carried]
    out = lines.select(*order).mapInArrow(_assembled(carried), ", ".join([kinds, *[f"{c} string" for c in carried]]))
    records = out.filter("NOT part").select("text", "header", *carried)
    if seen["inside"]:
        pieces = F.array_sort(F.collect_list(F.struct("block", "text")))  # the parts of one record
        crossing = out.filter("part").groupBy("file", "origin", *carried).agg(
            F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text"), F.max("header").alias("header")
        )
        records = records.unionByName(cut_lineage(crossing.select("text", "header", *carried)))
    single = F.when(
        F.col("text").contains("\r"), F.regexp_extract_all("text", F.lit(rf"(?:{QUOTED}|[^\r])++"), F.lit(0))
    ).otherwise(F.array("text"))
    records = records.select("header", *carried, F.posexplode(single).alias("place", "text"))
    records = records.filter("NOT (header AND place = 0) AND text RLIKE '[^\\\\s]'")
    return records.select("text", *[F.col(c).alias(f) for f, c in zip(folders, carried)]), folders
