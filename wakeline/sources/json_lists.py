"""Lists of objects inside large JSON files, read by many tasks.

A file is cut wherever ``},`` stands, by the text reader, which splits files at byte ranges whatever the file
system. Such a cut may lie inside a string or deep inside an element. Whether it does is known from what came
before: each fragment flips the quote state or not, and changes the depth of brackets by one of two numbers,
for a start outside and inside a string. A byte range adds these up to a map of its own (a pass of its own, all ranges side by
side); the maps of a file's ranges are composed in order, one row for each range; then every fragment knows its state
and elements are put together again. An element moves, a file does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wakeline.session import stored

CUT = "},"

#: A byte range is placed in blocks of up to 2^this many fragments, so a sort holds a block, not a range.
BLOCK_BITS = 14

#: What a JSON string holds; a string, and what is left of one at the begin and the end of a fragment.
_BODY = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_STRING, _REST, _OPEN = f'"{_BODY}"', f'(?s)^{_BODY}(?:"|$)', r'(?s)".*$'


def _brackets(text: Column, inside: bool) -> Column:
    """Brackets outside strings, in order; ``inside``: the text begins inside a string."""
    text = F.regexp_replace(text, _REST, "") if inside else text
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "(?s)" + _STRING, ""), _OPEN, ""), r"[^\[\]{}]", "")


def _steps(brackets: Column) -> Column:
    return F.length(F.regexp_replace(brackets, r"[\]}]", "")) - F.length(F.regexp_replace(brackets, r"[\[{]", ""))


def _lowest(brackets: Column) -> Column:
    """The least depth reached, 0 at the begin."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("low"))
    moved = F.transform(F.split(brackets, ""), lambda c: F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0))
    return F.aggregate(moved, zero, lambda s, d: F.struct((s["at"] + d).alias("at"), F.least(s["low"], s["at"] + d).alias("low")), lambda s: s["low"])


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, text, flips, out_*, in_*); ``text`` has its cut back, but for the last fragment of a file."""
    raw = spark.read.option("lineSep", CUT).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        (F.col("_metadata.file_block_start") + F.col("_metadata.file_block_length") >= F.col("_metadata.file_size")).alias("last_block"),
        F.monotonically_increasing_id().alias("seq"), "value").withColumn("block", F.struct(F.col("block").alias("start"), F.shiftright("seq", BLOCK_BITS).alias("nth")))
    quotes = F.length(F.regexp_replace(F.regexp_replace("value", r"(?s)\\.", ""), '[^"]', ""))
    ended = F.col("flips") == 1  # of a start outside: the cut is inside a string
    parts = raw.withColumn("flips", quotes % 2)
    for side, inside, cut_inside in (("out", False, ended), ("in", True, ~ended)):
        brackets = F.concat(_brackets(F.col("value"), inside), F.when(cut_inside, "").otherwise("}"))
        parts = parts.withColumn(f"{side}_brackets", brackets)
    return parts.withColumns({"out_steps": _steps(F.col("out_brackets")), "in_steps": _steps(F.col("in_brackets"))})


def _placed(parts: DataFrame) -> DataFrame:
    """Adds ``inside`` (begins in a string), ``depth`` (at its begin) and ``brackets`` to every fragment."""
    here = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("flipped", F.coalesce(F.sum("flips").over(here), F.lit(0)) % 2)
    # Steps of the fragment if the range begins outside a string, and if it begins inside one.
    parts = parts.withColumns({"steps_0": F.when(F.col("flipped") == 0, F.col("out_steps")).otherwise(F.col("in_steps")),
                               "steps_1": F.when(F.col("flipped") == 1, F.col("out_steps")).otherwise(F.col("in_steps"))})
    parts = parts.withColumns({f"depth_{s}": F.coalesce(F.sum(f"steps_{s}").over(here), F.lit(0)) for s in (0, 1)})
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ranges = parts.groupBy("file", "block").agg(F.sum("flips").alias("flips"), F.sum("steps_0").alias("s0"), F.sum("steps_1").alias("s1"))
    ranges = ranges.withColumn("starts_in", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    ranges = ranges.withColumn("steps", F.when(F.col("starts_in") == 0, F.col("s0")).otherwise(F.col("s1")))
    ranges = ranges.select("file", "block", "starts_in", F.coalesce(F.sum("steps").over(before), F.lit(0)).alias("starts_at"))
    inside = (F.col("flipped") + F.col("starts_in")) % 2 == 1
    return parts.join(ranges, ["file", "block"]).select(
        "file", "block", "seq", "value", inside.alias("inside"),
        (F.col("starts_at") + F.when(F.col("starts_in") == 0, F.col("depth_0")).otherwise(F.col("depth_1"))).alias("depth"),
        F.when(inside, F.col("in_brackets")).otherwise(F.col("out_brackets")).alias("brackets"),
        (inside != (F.col("flips") == 1)).alias("cut_inside"))


def _list_start(name: str | None) -> tuple[Column, int]:
    """(where the list's first element begins in a fragment, 0 if it does not; depth of the elements)."""
    if name is None:
        opened = F.regexp_extract("value", r"(?s)^[\s\uFEFF]*\[", 0)
        return F.when((F.col("depth") == 0) & ~F.col("inside") & (F.length(opened) > 0), F.length(opened) + 1).otherwise(0), 1
    opening = rf'"{name}"\s*+:\s*+\['
    found, between = F.regexp_extract_all("value", F.lit(opening), 0), F.split("value", opening)

    def before(k: Column) -> Column:
        """What stands before the k-th of the members with that name, which may lie at any depth."""
        return F.concat(F.array_join(F.transform(F.slice(found, 1, k - 1), lambda m, i: F.concat(F.get(between, i), m)), ""), F.get(between, k - 1))

    def begin(k: Column) -> Column:
        brackets = F.when(F.col("inside"), _brackets(before(k), True)).otherwise(_brackets(before(k), False))
        return F.when(F.col("depth") + _steps(brackets) == 1, F.length(before(k)) + F.length(F.get(found, k - 1)) + 1).otherwise(0)

    begins = F.filter(F.transform(F.sequence(F.lit(1), F.size(found)), begin), lambda at: at > 0)
    return F.when(F.size(found) > 0, F.coalesce(F.get(begins, F.lit(0)), F.lit(0))).otherwise(0), 2


def read_lists(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """(file, index, record): the objects (JSON text) of a list at the top of each file, or of its first member in
    ``names`` that is a list. Files without such a list give no rows. ``index`` counts objects from 0.

    An element that is no object is skipped. ``record`` may be followed by what stands behind the object in the
    file; parsers stop at its end. A list is cut only where ``},`` stands without white space between.
    """
    # What follows looks at the fragments several times, each time at a few columns; what is small for each file or block is joined by its measured size.
    placed = stored(_placed(_fragments(spark, path)))
    order = F.struct("block", "seq")
    found = []
    for rank, name in enumerate([None, *names]):
        start, depth = _list_start(name)
        found.append(F.when(start > 0, F.struct(F.lit(rank).alias("rank"), order.alias("at"), start.alias("begin"), F.lit(depth).alias("level"))))
    marked = placed.withColumn("starts", F.array_compact(F.array(*found)))
    lists = stored(marked.select("file", F.explode("starts").alias("s")).groupBy("file").agg(F.min("s").alias("list")))
    rows = placed.join(lists, "file").withColumn("order", order).where(F.col("order") >= F.col("list.at"))
    first = F.col("order") == F.col("list.at")
    level = F.col("list.level")
    # In the first fragment only what follows the list's begin counts.
    own = F.when(first, F.concat(_brackets(F.expr("substring(value, list.begin)"), False), F.when(F.col("cut_inside"), "").otherwise("}"))).otherwise(F.col("brackets"))
    rows = rows.withColumn("own", own).withColumn("from", F.when(first, level).otherwise(F.col("depth")))
    rows = rows.withColumns({"closes": F.col("from") + _lowest(F.col("own")) < level,
                             "ends": ~F.col("cut_inside") & (F.col("from") + _steps(F.col("own")) == level)})
    last = stored(rows.where("closes").groupBy("file").agg(F.min("order").alias("stop")))
    rows = rows.join(last, "file", "left").where(F.col("stop").isNull() | (F.col("order") <= F.col("stop")))
    # Numbers of the elements: within a byte range, then over the ranges.
    here = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    done = (F.col("ends") & ~F.col("closes")).cast("bigint")
    ranges = stored(rows.groupBy("file", "block").agg(F.sum(done).alias("n")).select(
        "file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    numbered = rows.withColumn("k", F.coalesce(F.sum(done).over(here), F.lit(0))).join(ranges, ["file", "block"])
    text = F.when(first, F.expr("substring(value, list.begin)")).otherwise(F.col("value"))
    pieces = numbered.groupBy("file", (F.col("k") + F.col("offset")).alias("index")).agg(
        F.sort_array(F.collect_list(F.struct("order", text.alias("text")))).alias("parts"))
    record = F.concat(F.array_join(F.col("parts.text"), CUT), F.lit("}"))
    out = pieces.select("file", "index", F.regexp_replace(record, r"(?s)^[^{\]]*", "").alias("record"))
    return out.where(F.substring("record", 1, 1) == "{")
