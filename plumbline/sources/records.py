"""Records of ``;`` text, whatever stands in quotes, and the ones that are broken.

A line ends a record unless a quote is open there. Whether one is open behind a line depends on whether one was open
before it, so a line is a map of two states: it may keep the state, turn it, or set it. Lines that open a quote are
looked for first, in one splittable scan. Files without such a line are read line by line, in splits of any size. Only the
lines of the others are ordered, each split by itself; the map of a split is that of its lines after one another, and a
row per split, in order, tells each split in which state it begins. So a file is never read by one task from its start to
its end. Numbers of records are sums of the same kind.

A quote that is never closed would make the rest of the file one value. Its line is rejected, and from there on each line
is a record by itself. Where a later line has a quote of its own, that one ends the value; what lies between can't be told
apart, and is rejected as one record if more text than a separator follows that quote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.runtime import bounded

FILE, SPLIT, PLACE = "_file", "_split", "_place_in_split"
REASON, RAW = "_reason", "_raw"
CORRUPT = "_corrupt_record"
# Why a record is rejected.
UNCLOSED, RAGGED, UNDECODABLE = "unclosed_quote", "ragged", "undecodable"

_QUOTED = '"[^"]*+(?:""[^"]*+)*+'
# Whole fields, then one whose quote is still open. Text behind a closing quote belongs to its field.
_OPENS = f'^(?:(?:{_QUOTED}"[^;]*+|(?!")[^;]*+);)*+{_QUOTED}$'
# From inside quotes to the end of that field.
_CLOSES = '^[^"]*+(?:""[^"]*+)*+"[^;]*+;?'
# A quote that closes a value which began on an earlier line, with more text before the separator: it closes what it shouldn't.
_ASTRAY = '^[^"]*+(?:""[^"]*+)*+"[^;]'
_EMPTY = r"^\s*$"


def _opens(line: Column) -> Column:
    """Is a quote open behind a line that begins outside of quotes?"""
    return line.contains('"') & line.rlike(_OPENS)


def _stays_open(line: Column) -> Column:
    """Is a quote open behind a line that begins inside of quotes?"""
    return ~line.rlike(_CLOSES) | _opens(F.regexp_replace(line, _CLOSES, ""))


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw lines and where they stand; not decoded, which quotes and separators don't need."""
    return spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT), F.monotonically_increasing_id().alias(PLACE)
    )


def files_with_breaks(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The files that have a line behind which a quote is open: a value with a line break, or a quote that is never closed."""
    return _lines(spark, paths).where(_opens(F.col("value"))).select(F.col(FILE).alias("_f")).distinct()


def _running(window, opens: Column, stays: Column) -> dict[str, Column]:
    """What the lines (or splits) of a window, in order, make of a state: ``sets`` (null: nothing sets it) and ``turns``."""
    sets = F.when(opens == stays, opens)
    turned = F.sum(F.when(opens & ~stays, 1).otherwise(0)).over(window)
    return {"sets": F.last(sets, ignorenulls=True).over(window), "at_set": F.last(F.when(sets.isNotNull(), turned), ignorenulls=True).over(window), "turned": turned}


def _after(sets: Column, at_set: Column, turned: Column, start: Column) -> Column:
    """The state behind a line: what was set last, or else the first, turned as often as it was since."""
    since = turned - F.coalesce(at_set, F.lit(0))
    return F.coalesce(sets, start) != (since % 2 == 1)


def _single(lines: DataFrame) -> DataFrame:
    """Each line that isn't empty is a record: value, file, number (from 1) and whether its quote is never closed."""
    ahead = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(FILE, SPLIT).orderBy(PLACE)
    filled = lines.where(~F.col("value").rlike(_EMPTY)).withColumn("nth", F.row_number().over(inside))
    sums = filled.groupBy(FILE, SPLIT).agg(F.max("nth").alias("n"))
    sums = sums.select(F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    both = filled.join(sums, (F.col(FILE) == F.col("_f")) & (F.col(SPLIT) == F.col("_s")))
    return both.select("value", FILE, (F.col("nth") + F.col("ahead")).alias("record"), _opens(F.col("value")).alias("unclosed"))


def _numbered_lines(lines: DataFrame) -> DataFrame:
    """``lines`` of files with breaks, with the number of their record (from 1), and whether their quote is never closed."""
    ahead = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(FILE)
    inside = Window.partitionBy(FILE, SPLIT).orderBy(PLACE)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    mapped = lines.withColumns({"opens": _opens(F.col("value")), "stays": _stays_open(F.col("value")), "filled": ~F.col("value").rlike(_EMPTY)})
    run = mapped.withColumns(_running(upto, F.col("opens"), F.col("stays")))
    run = run.withColumns({f"{c}_before": F.lag(c).over(inside) for c in ("sets", "at_set", "turned")})
    run = run.withColumn("filled_upto", F.count_if("filled").over(upto))

    # A split is a map as well: behind its last line, from either state.
    last = F.max_by(F.struct("sets", "at_set", "turned", "filled_upto"), PLACE).alias("last")
    ends = run.groupBy(FILE, SPLIT).agg(last).select(
        FILE, SPLIT, F.col("last.filled_upto").alias("n"),
        *[_after(F.col("last.sets"), F.col("last.at_set"), F.col("last.turned"), F.lit(s)).alias(c) for c, s in (("opens", False), ("stays", True))],
    )
    states = ends.withColumns(_running(ahead, F.col("opens"), F.col("stays")))
    start = _after(F.col("sets"), F.col("at_set"), F.coalesce("turned", F.lit(0)), F.lit(False))
    begins = states.select(
        F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s"), start.alias("start"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("filled_ahead"),
        F.last(F.when(start, F.col("stays")).otherwise(F.col("opens"))).over(Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("ends_open"),
    )
    on = (F.col(FILE) == F.col("_f")) & (F.col(SPLIT) == F.col("_s"))
    known = run.join(begins, on).drop("_f", "_s")
    within = _after(F.col("sets_before"), F.col("at_set_before"), F.coalesce("turned_before", F.lit(0)), F.col("start"))
    known = known.withColumns({"within": within, "filled_upto": F.col("filled_upto") + F.col("filled_ahead")})
    known = known.withColumn("begins", ~F.col("within") & F.col("filled")).withColumn("begun", F.count_if("begins").over(upto))

    # The record that is never closed is the last that begins.
    sums = known.groupBy(FILE, SPLIT).agg(
        F.max("begun").alias("begun"), F.max(F.when(F.col("begins"), F.struct("filled_upto", "begun"))).alias("latest"), F.first("ends_open").alias("ends_open")
    )
    sums = sums.withColumn("begun_ahead", F.coalesce(F.sum("begun").over(ahead), F.lit(0)))
    rest = F.max("latest.filled_upto").over(whole)
    sums = sums.select(F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s"), "begun_ahead", F.when(F.col("ends_open"), rest).alias("rest"))
    counted = known.drop("ends_open").join(sums, on).drop("_f", "_s")
    alone = F.coalesce(F.col("filled_upto") >= F.col("rest"), F.lit(False))
    record = F.col("begun") + F.col("begun_ahead") + F.when(alone, F.col("filled_upto") - F.col("rest")).otherwise(0)
    counted = counted.withColumns({"alone": alone, "record": record})
    unclosed = F.when(F.col("alone"), F.col("opens")).otherwise(F.col("within") & F.col("value").rlike(_ASTRAY))
    # Between records empty lines are none; in the rest every line is by itself.
    stays = F.when(F.col("alone"), F.col("filled")).otherwise(F.col("begins") | F.col("within"))
    return counted.where(stays).select("value", FILE, SPLIT, PLACE, "record", unclosed.alias("unclosed"))


def _assembled(lines: DataFrame) -> DataFrame:
    """One row per record: its lines joined. A record is as large as it is, a file is not held."""
    numbered = _numbered_lines(lines)
    parts = F.array_sort(F.collect_list(F.struct(SPLIT, PLACE, "value")))
    whole = numbered.groupBy(FILE, "record").agg(parts.alias("p"), F.bool_or("unclosed").alias("unclosed"))
    return whole.select(F.array_join("p.value", "\n").alias("value"), FILE, "record", "unclosed")


# The bytes that windows-1252 leaves undefined.
UNDEFINED_1252 = "[\u0081\u008d\u008f\u0090\u009d]"
REPLACED = "�"


def decoded(raw: Column, encoding: str) -> Column:
    """Text of raw bytes; what the encoding leaves undefined becomes the replacement sign."""
    name = encoding.lower().replace("_", "-")
    if name in ("utf-8", "utf8"):
        return F.make_valid_utf8(raw)
    signs = F.decode(raw.cast("binary"), "ISO-8859-1")
    if name in ("iso-8859-1", "latin-1", "latin1"):
        return signs
    if name not in ("windows-1252", "cp1252"):
        raise ValueError(f"Encoding {encoding} is not read record by record")
    # Undefined bytes pass through the decoder as a control sign.
    broken = F.decode(F.encode(F.regexp_replace(signs, UNDEFINED_1252, "\u001a"), "ISO-8859-1"), "windows-1252")
    return F.when(signs.rlike(UNDEFINED_1252), F.replace(broken, F.lit("\u001a"), F.lit(REPLACED))).otherwise(F.decode(raw.cast("binary"), "windows-1252"))


_OPTIONS = {"sep": ";", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _parsed(records: DataFrame, names: list[str], encoding: str, checked: bool) -> DataFrame:
    """The columns of numbered records; the first of a file is its header, which must name the columns if it is ``checked``."""
    text = F.when(F.col("record") == 1, F.regexp_replace(decoded(F.col("value"), encoding), "^\ufeff", "")).otherwise(decoded(F.col("value"), encoding))
    quoted = ["`" + c.replace("`", "``") + "`" for c in [*names, CORRUPT]]
    parsed = records.withColumn("value", text).withColumn("p", F.from_csv("value", ", ".join(f"{c} string" for c in quoted), _OPTIONS))
    fields = [F.col(f"p.{c}") for c in quoted]
    if checked:
        same = F.transform(F.array(*fields[:-1]), F.lower).eqNullSafe(F.array(*[F.lit(c.lower()) for c in names])) & fields[-1].isNull()
        wrong = F.raise_error(F.concat(F.lit("The header doesn't name the columns asked for: "), F.col(FILE)))
        parsed = parsed.where(F.when((F.col("record") == 1) & ~same, wrong.cast("boolean")).otherwise(F.col("record") > 1))
    else:
        parsed = parsed.where("record > 1")
    raw = F.when(F.col("unclosed"), F.col("value")).otherwise(fields[-1])
    return parsed.select(*[f.alias(c) for f, c in zip(fields, names)], raw.alias(CORRUPT), FILE, F.lit(0).cast("bigint").alias(SPLIT), F.col("record").alias(PLACE), F.col("unclosed").alias("_unclosed"))


def read_records(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None, encoding: str = "windows-1252", breaks: bool = True) -> DataFrame:
    """Every record of ``;`` files with a header: its columns as text, ``_file``, ``_split`` and ``_place_in_split``, and for a
    broken one ``_reason`` and ``_raw`` (null otherwise).

    A broken record is ``ragged`` (too few values, then null, or too many, then cut), ``undecodable`` (a value holds the replacement
    sign) or the line of an ``unclosed_quote``. Nothing is left out: the records without a reason and those with one are all.
    In a source that is declared free of line breaks (``breaks=False``) a quote that is open at the end of its line is never closed.
    Where ``columns`` are given, each file's header must name them; otherwise the first file's header does. Empty lines are no records.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    reader = spark.read.options(**_OPTIONS).option("header", True).option("encoding", encoding).option("multiLine", False).option("enforceSchema", columns is None)
    names = columns or reader.csv(paths).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    data = [F.col(f"`{c}`") for c in names]
    records = reader.schema(schema).csv(paths).select(
        *data, CORRUPT, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(SPLIT), F.monotonically_increasing_id().alias(PLACE), F.lit(False).alias("_unclosed")
    )
    opened = bounded(files_with_breaks(spark, paths))
    if opened.take(1):
        mine = F.col(FILE) == F.col("_f")
        lines = _lines(spark, paths).join(opened, mine).drop("_f")
        whole = _parsed(_assembled(lines) if breaks else _single(lines), names, encoding, columns is not None)
        # No error may be told of a line here whose file is put together: the mark comes with the join, so checks stay behind it.
        apart = records.join(opened, mine, "left").withColumn(CORRUPT, F.when(F.col("_f").isNull(), F.col(CORRUPT)))
        records = apart.where("_f is null").drop("_f").unionByName(whole)
    # Tied to the row's place, the reason is no fact about its columns that the optimizer could restate: after renaming n columns
    # it would do so in 2**n ways.
    garbled = F.exists(F.array(*data), lambda v: F.coalesce(v.contains(REPLACED), F.lit(False))) & (F.monotonically_increasing_id() >= 0)
    reason = F.when(F.col("_unclosed"), UNCLOSED).when(F.col(CORRUPT).isNotNull(), RAGGED).when(garbled, UNDECODABLE)
    told = records.withColumn(REASON, reason)
    raw = F.when(F.col(REASON).isNotNull(), F.coalesce(F.col(CORRUPT), F.array_join(F.array(*[F.coalesce(c, F.lit("")) for c in data]), ";")))
    raw = F.when(F.monotonically_increasing_id() >= 0, raw)
    return told.select(*data, FILE, SPLIT, PLACE, REASON, raw.alias(RAW))


def accepted(records: DataFrame) -> DataFrame:
    """The records without a reason against them."""
    return records.where(F.col(REASON).isNull()).drop(REASON, RAW)


def rejected(records: DataFrame) -> DataFrame:
    """The records that are kept for review (SNK-07): file, number in it, reason and raw text."""
    return records.where(F.col(REASON).isNotNull())


def checked(records: DataFrame) -> DataFrame:
    """All records, or an error that names the first broken one that is met."""
    told = F.concat(F.lit("Malformed record ("), F.col(REASON), F.lit(") in "), F.col(FILE), F.lit(": "), F.substring(RAW, 1, 200))
    return records.where(F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))).drop(REASON, RAW)
