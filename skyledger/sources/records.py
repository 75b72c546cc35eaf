"""Records of delimited files, whatever line breaks their quoted fields hold, with files read in many splits.

A split of a file may begin inside a quoted field, which no task can tell from its own bytes. So each line is seen as a
function of the state before it (outside or inside quotes) to the state after it, and such functions compose:

1. *Blocks.* One scan aggregates each file block: lines, blank lines, whether a line opens a field that it does not close,
   and the first line that would close one. Only blocks with open or blank lines are read again, to compose the functions
   of their lines in order for both states that they may begin in.
2. *Prefix.* A running composition over the blocks of a file gives the state at the start of each block, the number of
   records before it, and the record that is still open. There is one short row per block; they are written, so Spark
   knows their size when it joins them to the lines.
3. *Records.* In a block that begins outside quotes and has neither open nor blank lines every line is a record, numbered
   by its position: nothing is shuffled. Lines of the other blocks are gathered by block, cut at the starts that are known
   now and put together; only the pieces of records that cross the border of a block meet by record.

Records end at ``\\n`` or ``\\r\\n``; blank lines outside quotes are no records. A quote opens a field only at its start and
two of them stand for one; anywhere else it is text. A field that is never closed makes one record of the rest of a file.
Both passes must cut the files alike, so ``spark.sql.files`` settings must stay as they are until the rows are read; a
block that the first pass did not see fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import written

#: A quoted field from its start to its end; the possessive marks keep the search linear.
_QUOTED = r'(?:^|,)"[^"]*+(?:""[^"]*+)*+"'
_FIELD = r'("[^"]*+(?:""[^"]*+)*+(?:"[^,]*+|\z)|[^,]*+)(?:,|\z)'
_BLOCK = ["path", "block"]


def plain_path(c: str) -> Column:
    """One spelling for ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(c, "^file:/+", "file:/")


def _lines(spark: SparkSession, path: str | list[str], glob: str) -> DataFrame:
    reader = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.text(path).select(
        "value",
        plain_path("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )


def _opens(text: Column) -> Column:
    """Whether text that starts a field ends inside a quoted one."""
    return F.regexp_replace(text, _QUOTED, "_").rlike('(?:^|,)"')


def _functions(lines: DataFrame) -> DataFrame:
    """``out`` and ``ins``: whether a line ends inside quotes if it starts outside, or inside them."""
    quoted, value = F.contains("value", F.lit('"')), F.col("value")
    bare = F.regexp_replace(value, "^\\x{FEFF}", "")
    return lines.withColumns(
        {
            "out": F.when(quoted, _opens(bare)).otherwise(False),
            "ins": F.when(quoted, _opens(F.concat(F.lit('"'), value))).otherwise(True),
            "blank": value.isin("", "\r"),
        }
    )


def _states(lines: DataFrame) -> DataFrame:
    """``from_out`` and ``from_in``: the state before each line if its block begins outside, or inside quotes."""
    before = Window.partitionBy(*_BLOCK).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    constant, swap = F.col("out") == F.col("ins"), F.col("out") & ~F.col("ins")
    swaps = F.coalesce(F.count_if(swap).over(before), F.lit(0))
    counted = lines.withColumn("swaps", swaps)
    fixed = F.last(F.when(constant, F.struct("out", (F.col("swaps") % 2 == 1).alias("odd"))), ignorenulls=True).over(before)
    odd = F.col("swaps") % 2 == 1
    counted = counted.withColumn("fixed", fixed)
    known = F.col("fixed.out") != (F.col("fixed.odd") != odd)
    return counted.withColumns(
        {
            "from_out": F.when(F.col("fixed").isNull(), odd).otherwise(known),
            "from_in": F.when(F.col("fixed").isNull(), ~odd).otherwise(known),
        }
    ).drop("fixed", "swaps")


def _after(state: str) -> Column:
    return F.when(F.col(state), F.col("ins")).otherwise(F.col("out"))


def _ends(lines: DataFrame) -> DataFrame:
    """What becomes of a block for both states it may begin in: its end, its records, and its last start."""
    found = []
    for state, name in (("from_out", "out"), ("from_in", "in")):
        start = ~F.col(state) & ~F.col("blank")
        found += [
            F.max_by(_after(state), "pos").alias(f"end_{name}"),
            F.count_if(start).alias(f"records_{name}"),
            F.max(F.when(start, F.col("pos"))).alias(f"last_{name}"),
        ]
    return _states(lines).groupBy(*_BLOCK).agg(*found)


def blocks(lines: DataFrame) -> DataFrame:
    """One row per file block: where it begins, its state there, the records before it, and the one that is open."""
    seen = written(
        lines.groupBy(*_BLOCK).agg(
            F.count(F.lit(1)).alias("n"),
            F.min("pos").alias("first"),
            F.bool_or(F.col("out") | F.col("blank")).alias("rough"),
            F.min(F.when(~F.col("ins"), F.col("pos"))).alias("close"),
        ),
        "blocks",
    )
    # without open and blank lines the functions follow from the first line that closes a quote
    end = F.col("first") + F.col("n") - 1
    smooth = seen.where("not rough").select(
        *_BLOCK,
        F.lit(False).alias("end_out"),
        F.col("n").alias("records_out"),
        end.alias("last_out"),
        F.col("close").isNull().alias("end_in"),
        F.coalesce(end - F.col("close"), F.lit(0)).alias("records_in"),
        F.when(F.col("close") < end, end).alias("last_in"),
    )
    rough = _ends(lines.join(seen.where("rough").select(*_BLOCK), _BLOCK, "left_semi")) if seen.where("rough").head(1) else smooth.limit(0)
    ends = seen.join(smooth.unionByName(rough), _BLOCK)

    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    constant, swap = F.col("end_out") == F.col("end_in"), F.col("end_out") & ~F.col("end_in")
    counted = ends.withColumn("swaps", F.coalesce(F.count_if(swap).over(before), F.lit(0)))
    fixed = F.last(F.when(constant, F.struct("end_out", (F.col("swaps") % 2 == 1).alias("odd"))), ignorenulls=True).over(before)
    odd = F.col("swaps") % 2 == 1
    inside = F.when(F.col("fixed").isNull(), odd).otherwise(F.col("fixed.end_out") != (F.col("fixed.odd") != odd))
    known = counted.withColumn("fixed", fixed).withColumn("inside", inside)
    chosen = {name: F.when(F.col("inside"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out")) for name in ("end", "records", "last")}
    known = known.withColumns(chosen)
    # the record that is open where a block begins is the last one that started and did not end
    known = known.withColumns(
        {
            "records_before": F.coalesce(F.sum("records").over(before), F.lit(0)),
            "open": F.when(F.col("inside"), F.last(F.when(F.col("end"), F.col("last")), ignorenulls=True).over(before)),
            "whole": ~F.col("rough") & ~F.col("inside"),
        }
    )
    return written(known.select(*_BLOCK, "first", "inside", "end", "last", "records_before", "open", "whole"), "block-states")


def split_records(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """(path, number, record): every record of the files as text; the header is number 1 of its file."""
    lines = _functions(_lines(spark, path, glob))
    table = blocks(lines)
    plain = ["value", "path", "block", "pos"]
    unseen = F.raise_error(F.lit("file blocks changed between the two passes")).cast("bigint")
    number = F.when(F.col("whole").isNull(), unseen).otherwise(F.col("records_before") + F.col("pos") - F.col("first") + 1)
    straight = lines.select(*plain).join(table, _BLOCK, "left").where("whole is null or whole").select("path", number.alias("number"), F.col("value").alias("record"))
    done = straight
    if table.where("not whole").head(1):
        done = done.unionByName(_assembled(lines, table))
    text = F.regexp_replace("record", "\r\\z", "")
    return done.select("path", "number", F.when(F.col("number") == 1, F.regexp_replace(text, "^\\x{FEFF}", "")).otherwise(text).alias("record"))


def _assembled(lines: DataFrame, table: DataFrame) -> DataFrame:
    """Records of the blocks in which lines are not records."""
    states = _states(lines.join(table.where("not whole"), _BLOCK))
    state = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out"))
    start = ~state & ~F.col("blank")
    upto = Window.partitionBy(*_BLOCK).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = states.where(state | ~F.col("blank")).select(
        *_BLOCK, "pos", "value", "end", "last", "open",
        F.when(start, F.col("pos")).alias("start"),
        F.when(start, F.col("records_before") + F.count_if(start).over(upto)).alias("number"),
    )
    owned = marked.withColumn("key", F.coalesce(F.last("start", ignorenulls=True).over(upto), "open"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]), "\n")
    pieces = owned.groupBy(*_BLOCK, "key").agg(
        text.alias("record"),
        F.max("number").alias("number"),
        (F.bool_and(F.col("number").isNull()) | F.bool_or(F.col("end") & (F.col("key") == F.col("last")))).alias("cut"),
    )
    inner = pieces.where("not cut").select("path", "number", "record")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "record"))), lambda x: x["record"]), "\n")
    crossing = pieces.where("cut").groupBy("path", "key").agg(F.max("number").alias("number"), joined.alias("record"))
    return inner.unionByName(crossing.select("path", "number", "record"))


def fields(record: Column | str) -> Column:
    """The fields of a record as an array: quotes around a field go, doubled ones inside become one."""
    found = F.regexp_extract_all(record, F.lit(_FIELD), F.lit(1))

    def text(c: Column) -> Column:
        parts = F.regexp_extract(c, r'^"([^"]*+(?:""[^"]*+)*+)"?', 1)
        rest = F.regexp_replace(c, r'^"[^"]*+(?:""[^"]*+)*+"?', "")
        return F.when(F.startswith(c, F.lit('"')), F.concat(F.replace(parts, F.lit('""'), F.lit('"')), rest)).otherwise(c)

    return F.transform(found, text)
