"""Records of separated text files, read in pieces wherever the files can be cut.

A quoted cell may hold line breaks, so where a record begins is not known to a task
that starts in the middle of a file.  Every piece (`block`) is therefore read for
both cases, and the right one is chosen afterwards:

1. ``text_lines``  Spark splits the files at line feeds; a line keeps its file, its
   block and its place.
2. A line without a quote leaves the state (inside or outside a quoted cell) as it
   is.  A line with quotes is judged twice, from outside and from inside.
3. ``block_states``  These two-state functions compose: along a block over its
   quoted lines, along a file over one row per block.  That gives the state at
   each block's begin.
4. ``records``  In a block that no quoted cell is open in, each line is a record
   on its own.  Only in the others are lines put in order, and joined to the
   record that the last line from outside has begun, also across blocks.

All of it is built-in functions.  Nothing is gathered but the lines of one record;
windows run over one block's lines or over one file's blocks.  A file that ends
its lines with carriage returns only is one line to Spark, and not split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEPARATOR = ";"
PLACE = ["path", "block", "at", "pos"]

# A cell opens with a quote or is plain; what follows a closing quote belongs to
# the cell, and a quote inside a plain cell is a character like others.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:"{_INSIDE}"[^{SEPARATOR}]*+|[^"{SEPARATOR}][^{SEPARATOR}]*+|)'
_REST = rf"(?:{SEPARATOR}{_CELL})*+\z"
_ENDS_OUTSIDE = rf"\A{_CELL}{_REST}"
_CLOSES = rf'\A{_INSIDE}"[^{SEPARATOR}]*+{_REST}'
# The same for a whole record; a quote that never closes runs to the record's end.
_ANY_CELL = rf'{SEPARATOR}("{_INSIDE}(?:"[^{SEPARATOR}]*+)?|[^"{SEPARATOR}][^{SEPARATOR}]*+|)'
_QUOTED_CELL = rf'\A"({_INSIDE})(?:"([^{SEPARATOR}]*+))?\z'


# --- lines -----------------------------------------------------------------------

def text_lines(spark: SparkSession, directory: str, chosen: Column, encoding: str) -> DataFrame:
    """Lines of the CSV files of a folder: path, block, at, pos, line, ending.

    ``chosen`` is a predicate on ``_metadata``: files that fail it are left out when
    the scan is planned, and never opened.
    """
    read = (
        spark.read.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("lineSep", "\n")
        .load(directory)
        .filter(chosen)
    )
    text = F.decode(F.col("value").cast("binary"), encoding)
    return cut_lines(
        read.select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            text.alias("text"),
        )
    )


def cut_lines(texts: DataFrame) -> DataFrame:
    """Cut what stands between line feeds at lone carriage returns, which end lines too."""
    returned = F.endswith("text", F.lit("\r"))
    body = F.when(returned, F.left("text", F.length("text") - 1)).otherwise(F.col("text"))
    parts = F.when(F.contains(body, F.lit("\r")), F.split(body, "\r", -1)).otherwise(F.array(body))
    rows = texts.select("path", "block", "at", returned.alias("returned"), F.size(parts).alias("n"), F.posexplode(parts).alias("pos", "line"))
    ending = F.when(F.col("pos") < F.col("n") - 1, "\r").when(F.col("returned"), "\r\n").otherwise("\n")
    return rows.select(*PLACE, "line", ending.alias("ending"))


# --- states ----------------------------------------------------------------------

def _quoted(line: Column) -> Column:
    return F.contains(line, F.lit('"'))


def _functions(lines: DataFrame) -> DataFrame:
    """Add, per line, whether a quoted cell is open at its end: begun ``outside``, begun ``inside``."""
    line = F.col("line")
    outside = _quoted(line) & ~line.rlike(_ENDS_OUTSIDE)
    inside = F.when(_quoted(line), ~line.rlike(_CLOSES)).otherwise(True)
    return lines.withColumns({"outside": outside, "inside": inside})


def _composed(rows: DataFrame, over: list[str], order: list[str]) -> DataFrame:
    """Compose the functions (``outside``, ``inside``) of rows that follow each other.

    A function is constant, or keeps the state, or flips it; so the state ahead of
    a row is that of the last constant, or else the first state, flipped as often
    as flips have followed.  Adds ``known`` (NULL: the first state decides) and
    ``odd``, both ahead of the row, and the same through it.
    """
    constant, flip = F.col("outside") == F.col("inside"), (F.col("outside") & ~F.col("inside")).cast("int")
    through = Window.partitionBy(*over).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*over).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("flips", F.sum(flip).over(through))
    fixed = F.when(constant, F.struct(F.col("outside").alias("state"), "flips"))
    rows = rows.withColumns({"last": F.last(fixed, ignorenulls=True).over(ahead), "own": F.last(fixed, ignorenulls=True).over(through)})
    since = {"ahead": F.col("flips") - flip, "through": F.col("flips")}
    at = {"ahead": F.col("last"), "through": F.col("own")}
    added = {}
    for name in ("ahead", "through"):
        added[f"known_{name}"] = at[name]["state"]
        added[f"odd_{name}"] = (since[name] - F.coalesce(at[name]["flips"], F.lit(0))) % 2 == 1
    return rows.withColumns(added).drop("flips", "last", "own")


def _state(where: str, first: Column) -> Column:
    """State there, if the first one is ``first``."""
    return F.coalesce(F.col(f"known_{where}"), first) != F.col(f"odd_{where}")


def block_states(lines: DataFrame) -> DataFrame:
    """Blocks in which a quoted cell is open at some line end: path, block, begins_inside."""
    marks = _composed(_functions(lines.where(_quoted(F.col("line")))), ["path", "block"], ["at", "pos"])
    ends = {first: _state("through", F.lit(first)) for first in (False, True)}
    opens = {first: F.max(ends[first]).alias(f"opens_{first}") for first in (False, True)}
    newest = F.max_by(F.struct(ends[False].alias("outside"), ends[True].alias("inside")), F.struct("at", "pos"))
    quoted = marks.groupBy("path", "block").agg(newest.alias("f"), *opens.values())
    blocks = lines.select("path", "block").distinct().join(quoted, ["path", "block"], "left")
    whole = blocks.select(
        "path", "block",
        F.coalesce("f.outside", F.lit(False)).alias("outside"), F.coalesce("f.inside", F.lit(True)).alias("inside"),
        F.coalesce("opens_False", F.lit(False)).alias("opens"),
    )
    begun = _composed(whole, ["path"], ["block"]).withColumn("begins_inside", _state("ahead", F.lit(False)))
    return begun.where(F.col("begins_inside") | F.col("opens")).select("path", "block", "begins_inside")


# --- records ---------------------------------------------------------------------

def _joined_lines(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Records of the blocks in which some cell is open: path, block, at, pos of their first line, and text."""
    inside = _composed(_functions(lines.join(states, ["path", "block"])), ["path", "block"], ["at", "pos"])
    begins = ~_state("ahead", F.col("begins_inside"))
    upto = Window.partitionBy("path", "block").orderBy("at", "pos").rowsBetween(Window.unboundedPreceding, 0)
    place = F.struct(*[c for c in PLACE if c != "path"])
    marked = inside.withColumn("start", F.when(begins, place)).withColumn("own", F.last("start", ignorenulls=True).over(upto))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    newest = marked.where("start IS NOT NULL").groupBy("path", "block").agg(F.max("start").alias("newest"))
    carried = states.join(newest, ["path", "block"], "left").select("path", "block", F.last("newest", ignorenulls=True).over(earlier).alias("carried"))
    named = marked.join(carried, ["path", "block"]).withColumn("record", F.coalesce("own", "carried"))
    parts = F.array_sort(F.collect_list(F.struct("block", "at", "pos", "line", "ending")))
    gathered = named.groupBy("path", "record").agg(parts.alias("parts"))
    last = F.size("parts") - 1
    text = F.array_join(F.transform("parts", lambda p, i: F.when(i < last, F.concat(p["line"], p["ending"])).otherwise(p["line"])), "")
    return gathered.select("path", "record.*", text.alias("text"))


def record_texts(lines: DataFrame, states: DataFrame) -> DataFrame:
    """One row per record that is not blank: the place of its first line, and its text."""
    alone = lines.join(states, ["path", "block"], "left_anti").select(*PLACE, F.col("line").alias("text"))
    return alone.unionByName(_joined_lines(lines, states)).where("text <> ''")


def cells_of(text: Column) -> Column:
    """Cells of a record's text."""

    def cell(raw: Column) -> Column:
        inner = F.replace(F.regexp_extract(raw, _QUOTED_CELL, 1), F.lit('""'), F.lit('"'))
        return F.when(F.startswith(raw, F.lit('"')), F.concat(inner, F.regexp_extract(raw, _QUOTED_CELL, 2))).otherwise(raw)

    found = F.regexp_extract_all(F.concat(F.lit(SEPARATOR), text), F.lit(_ANY_CELL), F.lit(1))
    return F.when(_quoted(text), F.transform(found, cell)).otherwise(F.split(text, SEPARATOR, -1))


def records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """path, block, at, pos and cells of every record."""
    return record_texts(lines, states).select(*PLACE, cells_of(F.col("text")).alias("cells"))


def first_records(lines: DataFrame, states: DataFrame) -> DataFrame:
    """The first record of every file."""
    firsts = record_texts(lines.where("block = 0"), states.where("block = 0"))
    lowest = firsts.groupBy("path").agg(F.min("at").alias("at"))
    near = firsts.join(lowest, ["path", "at"]).groupBy("path").agg(F.min_by(F.struct("block", "at", "pos", "text"), "pos").alias("r"))
    return near.select("path", "r.block", "r.at", "r.pos", cells_of(F.col("r.text")).alias("cells"))
