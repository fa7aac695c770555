"""CSV records by the state of their quotes: a line feed within quotes is data, and so is a doubled quote.

Files are read as lines, in as many tasks as they have splits. A line's effect on the state of quotes is a function of the state it
begins in, and there are four: it sets it, clears it, keeps it, or turns it over. Running through the lines of a split composes
them; only what a split does as a whole goes on to the next one. Records are put together in the task that reads their lines, and only the parts
of those that go on over the end of a split are shuffled. What comes out are the rows that
Python's csv.DictReader gives: a quote counts only at the start of a cell, short rows end in NULLs, cells beyond the header and blank lines are
dropped, of columns of one name the last counts, and quotes that never close reach to the end of the file.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portflow.sources.folders import head_of, shared_dir, visible

#: Within quotes; a whole cell; and a line that ends within quotes. Everything repeats without looking back.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:{_QUOTED}"[^,]*+|[^",][^,]*+|)'
_OPEN = rf"(?s)\A(?:{_CELL},)*+{_QUOTED}\z"
_CELLS = rf'(?s),((?:{_QUOTED}"?+)?+[^,]*+)'
#: The same in Python, for the line that a file's mark is taken off, and that mark.
_OPEN_AGAIN, _MARK = re.compile(_OPEN.replace(r"\z", r"\Z")), "\ufeff".encode()
_HEAD_BYTES = 1 << 16


def normal(header: str) -> str:
    """A header cell as a column name: outer blanks off, blanks to underscores."""
    return header.strip().replace(" ", "_").lower()


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The cells of a file's first record. Only the start of the file is read, more of it while the record goes on."""
    size = _HEAD_BYTES
    while True:
        raw, whole = head_of(spark, path, size)
        text = raw.decode("utf-8-sig", "ignore" if not whole else "replace")
        rows = csv.reader(io.StringIO(text, newline=""))
        first = next(rows, [])
        if whole or next(rows, None) is not None:
            return first
        size *= 4


def _lines(spark: SparkSession, paths: list[str], known: DataFrame | None = None) -> DataFrame:
    """(file, block, piece, o0, o1, blank): lines with their ends, in the order of a split; whether each leaves quotes open if none, or one, was open.

    known: what is known of each split, joined to its lines; splits that it lacks are left out. file is as it stands in an address.
    """
    # a line may end in \r alone; what ends a line inside quotes stays as it is
    lines = spark.read.text(paths, lineSep="\n").select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.concat("value", F.lit("\n")).alias("value"))
    if known is not None:
        lines = lines.join(F.broadcast(known), ["file", "block"])  # a row a split, as the driver has for its tasks
    cut = F.filter(F.split("value", r"(?<=\n)|(?<=\r)(?!\n)"), lambda x: x != "")
    split = lines.withColumn("piece", F.explode(F.when(F.contains(F.col("value"), F.lit("\r")), cut).otherwise(F.array("value")))).drop("value")
    quoted = F.contains(F.col("piece"), F.lit('"'))
    left_open = lambda c, plain: F.coalesce(F.when(quoted, c.rlike(_OPEN)), F.lit(plain))
    return split.withColumns({"o0": left_open(F.col("piece"), False), "o1": left_open(F.concat(F.lit('"'), "piece"), True), "blank": F.col("piece").isin("\n", "\r\n", "\r")})


def _after(o0: np.ndarray, o1: np.ndarray, start: bool) -> np.ndarray:
    """Whether quotes are open after each of some lines: as the last line that sets or clears it says, turned over by those since."""
    turned = np.cumsum(o0 & ~o1)
    at = np.maximum.accumulate(np.where(o0 == o1, np.arange(len(o0)), -1))
    return np.where(at >= 0, o0[at], start) ^ ((turned - np.where(at >= 0, turned[at], 0)) % 2 == 1)


def _begins(after: np.ndarray, start: bool, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line begins within quotes, and whether it begins a record: not within quotes, and not with a blank line."""
    before = np.concatenate([[start], after[:-1]])
    return before, ~before & ~blank


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(lines, o0, o1, blank, new): the lines of each batch by split, and whether a split begins with them. A file's first line loses its mark, and is not blank."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block")
        other = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(block[1:], block[:-1])).to_numpy(zero_copy_only=False)
        ends = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        for a, b in zip(ends, ends[1:], strict=False):
            part, key = batch.slice(a, b - a), (file[a].as_py(), block[a].as_py())
            o0, o1, blank = (np.array(part.column(c).to_numpy(zero_copy_only=False), bool) for c in ("o0", "o1", "blank"))
            new, last = key != last, key
            if new and key[1] == 0:
                first = part.column("piece")[0].as_buffer().to_pybytes()
                if first.startswith(_MARK):
                    first = first[len(_MARK) :]
                    text = first.decode("utf-8", "replace")
                    o0[0], o1[0] = (('"' in text and bool(_OPEN_AGAIN.match(text))), ('"' not in text or bool(_OPEN_AGAIN.match('"' + text))))
                    kept = pa.concat_arrays([_strings([first]), part.column("piece")[1:]])
                    part = part.set_column(part.schema.get_field_index("piece"), "piece", kept)
                blank[0] = False
            yield part, o0, o1, blank, new


def _strings(texts: list[bytes]) -> pa.Array:
    """Bytes as text, looked at by nobody."""
    return pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(np.cumsum([0, *map(len, texts)]).astype(np.int32)), pa.py_buffer(b"".join(texts))])


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, e0, e1, n0, n1): whether each split leaves quotes open, and how many records begin in it, for either state that it may begin in."""
    found: list[list] = []
    for part, o0, o1, blank, new in _stretches(batches):
        if new:
            found.append([part.column("file")[0].as_py(), part.column("block")[0].as_py(), False, True, 0, 0])
        for s in (0, 1):
            after = _after(o0, o1, found[-1][2 + s])
            found[-1][4 + s] += int(_begins(after, found[-1][2 + s], blank)[1].sum())
            found[-1][2 + s] = bool(after[-1])
    if found:  # a row a split
        kinds = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], ["file", "block", "e0", "e1", "n0", "n1"])


def _joined(want_parts: bool):
    """Lines of splits to (file, rec, block, record): records that are whole within their split, or the parts of those that are not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, start, state, rec, text = "", 0, False, False, 0, []  # of the split at work; text: what there is of the record `rec`, which may go on
        head = False  # whether that record began in an earlier split

        def out(recs: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays([pa.array([unquote(file)] * n, pa.string()), pa.array(recs, pa.int64()), pa.array(np.full(n, block), pa.int64()), texts], ["file", "rec", "block", "record"])

        def ended(goes_on: bool) -> Iterator[pa.RecordBatch]:
            if text and want_parts == (head or goes_on):
                yield out(np.array([rec]), _strings([b"".join(text)]))

        for part, o0, o1, blank, new in _stretches(batches):
            if new:
                yield from ended(state)
                file, block, start, rec = (part.column(c)[0].as_py() for c in ("file", "block", "start", "earlier"))
                state, text, head = start, [], start
            after = _after(o0, o1, state)
            before, begins = _begins(after, state, blank)
            state, keep = bool(after[-1]), begins | before
            kept = part.column("piece").filter(pa.array(keep))
            at = np.flatnonzero(begins[keep])
            if not len(kept):
                continue
            offsets, data = np.frombuffer(kept.buffers()[1], np.int32, len(kept) + 1), kept.buffers()[2]
            bounds = [*offsets[at], offsets[-1]]
            if bounds[0] > 0:
                text.append(data[: int(bounds[0])].to_pybytes())
            if not len(at):
                continue
            yield from ended(False)
            head = False
            if len(at) > 1 and not want_parts:
                yield out(rec + 1 + np.arange(len(at) - 1), pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(np.array(bounds[:-1], np.int32)), data]))
            rec, text = rec + len(at), [data[int(bounds[-2]) : int(bounds[-1])].to_pybytes()]
        yield from ended(state)

    return run


def records(spark: SparkSession, paths: list[str], splits: bool = True) -> DataFrame:
    """(file, rec, record): the records of each file from 1 on. splits: whether a file may have several.

    Lines stay in the task that reads them, where records are put together. What each split does to the state of quotes is found by a
    pass of its own; records that go on over the end of a split are put together from a part of each split, and nothing else is shuffled.
    """
    shape, trimmed = "file string, rec long, block long, record string", F.regexp_replace("record", r"(?:\r\n|\r|\n)\z", "").alias("record")
    if not splits:
        lines = _lines(spark, paths).withColumns({"start": F.lit(False), "earlier": F.lit(0).cast("long")})
        return lines.mapInArrow(_joined(False), shape).select("file", "rec", trimmed)
    found = _lines(spark, paths).mapInArrow(_effects, "file string, block long, e0 boolean, e1 boolean, n0 long, n1 long")
    order = Window.partitionBy("file").orderBy("block")  # a row a split
    # the state that each split begins in: as the last split says that sets or clears it, turned over by those since
    turns = F.sum((F.col("e0") & ~F.col("e1")).cast("int")).over(order)
    last = F.last(F.when(F.col("e0") == F.col("e1"), F.struct("e0", "turned")), ignorenulls=True).over(order)
    end = F.coalesce("last.e0", F.lit(False)) != ((F.col("turned") - F.coalesce("last.turned", F.lit(0))) % 2 == 1)
    blocks = found.withColumn("turned", turns).withColumn("last", last).withColumn("end", end).withColumn("start", F.coalesce(F.lag("end").over(order), F.lit(False)))
    n = F.when(F.col("start"), F.col("n1")).otherwise(F.col("n0"))
    shared_dir(spark)
    blocks = blocks.select("file", "block", "start", "end", (F.sum(n).over(order) - n).alias("earlier")).checkpoint()
    whole = _lines(spark, paths, blocks.drop("end")).mapInArrow(_joined(False), shape).select("file", "rec", trimmed)
    cut = blocks.where("start or end").drop("end")
    if cut.isEmpty():
        return whole
    parts = _lines(spark, paths, cut).mapInArrow(_joined(True), shape)
    put = parts.groupBy("file", "rec").agg(F.array_join(F.sort_array(F.collect_list(F.struct("block", "record")))["record"], "").alias("record"))  # a part a split
    return whole.unionByName(put.select("file", "rec", trimmed))


def cells(record: Column) -> Column:
    """The cells of a record, their quotes taken off."""

    def unquoted(cell: Column) -> Column:
        inner = rf'(?s)\A"([^"]*+(?:""[^"]*+)*+)"?+(.*)\z'
        body = F.substring(cell, F.lit(2), F.length(cell) - 2)  # of a cell that is closed at its end and has no other single quote
        plain = (F.length(cell) > 1) & cell.endswith('"') & ~F.contains(F.replace(body, F.lit('""'), F.lit("")), F.lit('"'))
        return F.when(cell.startswith('"') & plain, F.replace(body, F.lit('""'), F.lit('"'))).when(cell.startswith('"'), F.concat(F.replace(F.regexp_extract(cell, inner, 1), F.lit('""'), F.lit('"')), F.regexp_extract(cell, inner, 2))).otherwise(cell)

    found = F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELLS), F.lit(1)), unquoted)
    return F.when(F.contains(record, F.lit('"')), found).otherwise(F.split(record, ",", -1))


def read_files(spark: SparkSession, files: dict[str, str], columns: list[str]) -> DataFrame:
    """(source_name, row_no and columns) as text of files (name -> path), each by its own header; row_no counts a file's records after it."""
    shape = "source_name string, row_no long, " + ", ".join(f"{c} string" for c in columns)
    if not files:
        return spark.createDataFrame([], shape)
    seen, sizes = visible(spark, files)
    places = []
    for name, path in seen.items():
        at = {normal(h): i for i, h in enumerate(header_of(spark, path))}
        places.append((path.rsplit("/", 1)[1], name, [at.get(c, -1) for c in columns]))
    heads = spark.createDataFrame(places, "file string, source_name string, places array<int>")
    rows = records(spark, list(seen.values()), any(s >= _split_bytes(spark) for s in sizes.values())).where("rec > 1")
    rows = rows.join(F.broadcast(heads), "file").withColumn("cells", cells(F.col("record")))  # a short row a file, as the list of files that the driver has
    cell = lambda i: F.when(F.col("places")[i] >= 0, F.get("cells", F.col("places")[i]))
    return rows.select("source_name", (F.col("rec") - 1).alias("row_no"), *(cell(i).alias(c) for i, c in enumerate(columns)))


def _split_bytes(spark: SparkSession) -> int:
    """No file below this has more than one split: Spark's splits may be as small as this."""
    return min(int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(f"spark.sql.files.{k}"))) for k in ("openCostInBytes", "maxPartitionBytes"))
