"""CSV records with line breaks inside quotes, read in many tasks a file.

A file is read as lines, each split of it by its own task. What a line does to the state "inside a quoted field" has one of
four forms (keep it, turn it, end outside, end inside), which two patterns tell without knowing the state the line is met
in. The forms of a split's lines compose to one such form, and those of a file's splits, one row each, to the state in
which every split begins. A second pass joins lines to records within a split; the ends of
records that cross from one split into the next are at most two rows a split and are joined by a grouping. The records go through
Spark's own CSV parser (`from_csv`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# What a line does to the state outside (0) or inside (1) of a quoted field.
END_OUTSIDE, TURN, KEEP, END_INSIDE = range(4)

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_FIELD = rf'(?:{_QUOTED}"[^,]*+|[^",][^,]*+)?+'
#: Met outside, the line ends within a quoted field; met inside, it does.
OPENS = rf"\A(?:{_FIELD},)*+{_QUOTED}\z"
STAYS_OPEN = rf'\A[^"]*+(?:""[^"]*+)*+(?:\z|"[^,]*+,(?:{_FIELD},)*+{_QUOTED}\z)'

# A row that leaves a split: a whole record, one that begins in it, one that ends in it, or a part between.
WHOLE, HEAD, PART = range(3)


def line_form(line: Column) -> Column:
    """The form of a line, as END_OUTSIDE, TURN, KEEP or END_INSIDE."""
    quotes = F.when(line.rlike(OPENS), 1).otherwise(0) + F.when(line.rlike(STAYS_OPEN), 2).otherwise(0)
    return F.when(F.contains(line, F.lit('"')), quotes).otherwise(KEEP).cast("int")


def pin_splits(spark: SparkSession) -> None:
    """Keep the way in which files are cut into splits from following the number of executors, which may change between scans."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(max(spark.sparkContext.defaultParallelism, 1)))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    pin_splits(spark)
    # a carriage return stays at the end of its line: inside quotes it belongs to the text
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def _split_key() -> Column:
    return F.xxhash64("file", "block")


def split_starts(lines: DataFrame) -> pa.Table:
    """`split, file, block, inside, ends_inside`: the state in which each split of the files begins and ends.

    The driver composes the forms of the splits, one short row for each.
    """
    lines = lines.select("file", "block", "row", line_form(F.col("value")).alias("form"))
    form = F.col("form")
    fixed = F.when(form.isin(END_OUTSIDE, END_INSIDE), F.struct("row", (form == END_INSIDE).alias("state")))
    # turning lines are few: they open or close a field over several lines
    split = lines.groupBy("file", "block").agg(
        F.max(fixed).alias("fixed"), F.collect_list(F.when(form == TURN, F.col("row"))).alias("turned")
    )
    turns = F.size(F.filter("turned", lambda r: r > F.coalesce(F.col("fixed.row"), F.lit(-1))))
    found = split.select(
        _split_key().alias("split"), "file", "block", F.col("fixed.state").alias("state"), (turns % 2 == 1).alias("turns")
    ).toArrow().sort_by([("file", "ascending"), ("block", "ascending")])
    file, inside, ends, now = None, [], [], False
    for path, state, turned in zip(*(found.column(c).to_pylist() for c in ("file", "state", "turns"))):
        if path != file:
            file, now = path, False
        inside.append(now)
        now = (now if state is None else state) != turned
        ends.append(now)
    return found.select(["split", "file", "block"]).append_column("inside", pa.array(inside, pa.bool_())).append_column("ends_inside", pa.array(ends, pa.bool_()))


def _states(forms: np.ndarray, first: bool) -> np.ndarray:
    """The state after each line, when that before the first one is `first`."""
    turns = np.cumsum(forms == TURN)
    place = np.arange(len(forms))
    fixed = np.maximum.accumulate(np.where((forms == END_OUTSIDE) | (forms == END_INSIDE), place, -1))
    state = np.where(fixed >= 0, forms[fixed] == END_INSIDE, first)
    return state ^ ((turns - np.where(fixed >= 0, turns[fixed], 0)) % 2 == 1)


_RECORD = "split long, row long, text string, part int, top boolean"


def _join_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines `value, split, row, form, inside, top` to rows of `_RECORD`; a split's lines come one after the other."""
    names = ["split", "row", "text", "part", "top"]
    split, inside, open_lines, open_row, open_part, at_top = None, False, None, 0, HEAD, False

    def rows(records: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*records)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for batch in batches:
        if not len(batch):
            continue
        splits, numbers = batch.column("split").to_numpy(), batch.column("row").to_numpy()
        forms, values = batch.column("form").to_numpy(), batch.column("value")
        cuts = np.append(np.flatnonzero(np.diff(splits, prepend=splits[0] + 1) != 0), len(splits))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            done: list[tuple] = []
            if split != splits[lo]:
                if open_lines is not None:
                    done.append((split, open_row, "\n".join(open_lines), open_part, at_top))
                split, inside, at_top = int(splits[lo]), batch.column("inside")[lo].as_py(), batch.column("top")[lo].as_py()
                open_lines, open_row, open_part = ([], int(numbers[lo]), PART) if inside else (None, 0, HEAD)
            after = _states(forms[lo:hi], inside)
            before = np.append(inside, after[:-1])
            begins = np.flatnonzero(~before)
            if open_lines is not None:  # of the record that the lines before left open
                stop = int(begins[0]) if len(begins) else hi - lo
                open_lines += values.slice(lo, stop).to_pylist()
                if len(begins):
                    done.append((split, open_row, "\n".join(open_lines), WHOLE if open_part == HEAD else PART, at_top and open_part == HEAD))
                    at_top = at_top and open_part != HEAD
                    open_lines = None
            ends = np.append(begins[1:], hi - lo)
            several = np.flatnonzero((ends - begins > 1) | after[ends - 1] if len(begins) else begins)
            single = np.setdiff1d(np.arange(len(begins)), several)
            header = -1
            if at_top:  # blank lines before the header are skipped
                header = next((i for i, at in enumerate(begins.tolist()) if values[lo + at].as_py() not in ("", "\r")), -1)
            for i in several.tolist():
                text = values.slice(lo + int(begins[i]), int(ends[i] - begins[i])).to_pylist()
                if i == len(begins) - 1 and after[-1]:
                    open_lines, open_row, open_part = text, int(numbers[lo + begins[i]]), HEAD
                else:
                    done.append((split, int(numbers[lo + begins[i]]), "\n".join(text), WHOLE, i == header))
            if len(single):
                at = pa.array(lo + begins[single])
                n = len(single)
                top = single == header
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, split, np.int64)), pa.array(numbers[lo + begins[single]]), values.take(at),
                     pa.array(np.full(n, WHOLE, np.int32)), pa.array(top)], names,
                )
            if header >= 0 and not (header == len(begins) - 1 and open_lines is not None):
                at_top = False
            inside = bool(after[-1])
            if done:
                yield rows(done)
    if open_lines is not None:
        yield rows([(split, open_row, "\n".join(open_lines), open_part, at_top)])


def read_records(spark: SparkSession, path: str, ordered: bool = True) -> DataFrame:
    """`text, top` of the records of the CSV files at `path`, blank ones left out; `top` marks the first record of a file.

    `ordered` adds `file, block, row`, a unique key in the order of the files. The states in which splits begin are found when
    this is called, in a pass over the lines.
    """
    lines = _lines(spark, path)
    found = split_starts(lines)
    starts = spark.createDataFrame(found)
    changed = F.raise_error(F.lit("the files were split in another way while they were read; read them again"))
    known = (
        lines.withColumn("split", _split_key())
        # one row for each split of the files
        .join(F.broadcast(starts.select("split", "inside", "ends_inside")), "split", "left")
        .withColumn("inside", F.when(F.col("inside").isNull(), changed.cast("boolean")).otherwise(F.col("inside")))
    )
    crosses = pc.any(pc.or_(found.column("inside"), found.column("ends_inside"))).as_py()

    def joined(table: DataFrame, named: bool) -> DataFrame:
        columns = ["value", "split", "row", line_form(F.col("value")).alias("form"), "inside", (F.col("block") == 0).alias("top")]
        records = table.select(*columns).mapInArrow(_join_lines, _RECORD)
        return records.join(F.broadcast(starts.select("split", "file", "block")), "split") if named else records

    columns = ["text", "top", "file", "block", "row"] if ordered else ["text", "top"]
    records = joined(known, ordered).where(F.col("part") == WHOLE).select(*columns)
    if crosses:
        # a split has two parts at most, of the records that cross its ends
        parts = joined(known.where(F.col("inside") | F.col("ends_inside")), True).where(F.col("part") != WHOLE)
        number = F.sum(F.when(F.col("part") == HEAD, 1).otherwise(0)).over(Window.partitionBy("file").orderBy("block", "row"))
        pieces = F.array_sort(F.collect_list(F.struct("block", "row", "text")))
        crossing = parts.withColumn("number", number).groupBy("file", "number").agg(pieces.alias("pieces"), F.bool_or("top").alias("top"))
        records = records.unionByName(crossing.select(
            F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").alias("text"), "top", "file",
            F.col("pieces")[0]["block"].alias("block"), F.col("pieces")[0]["row"].alias("row"),
        ).select(*columns))
    return records.withColumn("text", F.regexp_replace("text", r"\r\z", "")).where(F.col("text") != "")
