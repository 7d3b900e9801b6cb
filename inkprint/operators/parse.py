"""Exported chat text to message rows.

Two ways in. A column of whole texts (one row per export) is parsed in place. A folder of
exports is read line by line, so that one export of any size is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkprint.constants import ANDROID_STAMP, INFO_AUTHOR, IOS_STAMP, PLACEHOLDER, SPACE_CLASS
from inkprint.functions.text import col
from inkprint.operators.joins import lookup, lookup_or

_STAMPS = {"ios": f"(?U){IOS_STAMP}", "android": f"(?U){ANDROID_STAMP}"}
UNSUPPORTED = "Format not supported"


def dialect_of(text: str | Column) -> Column:
    """``ios``, ``android`` or null, by the stamp at the very start of the text."""
    out = None
    for name, stamp in _STAMPS.items():
        starts = col(text).rlike(rf"\A(?:{stamp})")
        out = F.when(starts, name) if out is None else out.when(starts, name)
    return out


def detect_dialect(df: DataFrame, value: str = "value", strict: bool = False) -> DataFrame:
    """Add ``dialect``; a text of neither dialect is null, or an error when ``strict``."""
    found = dialect_of(value)
    if strict:
        found = F.coalesce(found, F.raise_error(F.lit(UNSUPPORTED)))
    return df.withColumn("dialect", found)


def _by_dialect(make) -> Column:
    out = None
    for name, stamp in _STAMPS.items():
        here = F.col("dialect") == name
        out = F.when(here, make(stamp)) if out is None else out.when(here, make(stamp))
    return out


def split_records(df: DataFrame, value: str = "value", line_start: bool = False) -> DataFrame:
    """One row per stamp: ``pos``, ``stamp`` and the raw ``record`` up to the next stamp.

    A stamp counts wherever it stands; ``line_start`` accepts it only at the start of a line.
    """
    anchor = "(?m)^" if line_start else ""
    stamps = _by_dialect(lambda s: F.regexp_extract_all(col(value), F.lit(anchor + s), F.lit(0)))
    bodies = _by_dialect(lambda s: F.slice(F.split(col(value), anchor + s, -1), 2, 1 << 30))
    zipped = df.withColumn("_records", F.arrays_zip(stamps.alias("stamp"), bodies.alias("record")))
    kept = [c for c in df.columns if c != value]
    return zipped.select(*kept, F.posexplode("_records").alias("pos", "_r")).select(
        *kept, F.col("pos").cast("long").alias("pos"), "_r.stamp", "_r.record")


def parse_stamp(stamp: str | Column, strict: bool = True) -> Column:
    """Day/month/year stamp to a timestamp of the session time zone; seconds are dropped.

    Years 10 to 99 are of this century. An impossible date is an error, or null if not strict.
    """
    pattern = r"(?U)(\d{1,2})/(\d{1,2})/(\d{2,4}), (\d{2}):(\d{2})"
    day, month, year, hour, minute = (F.regexp_extract(col(stamp), pattern, i).cast("int") for i in range(1, 6))
    year = F.when(year.between(10, 99), year + 2000).otherwise(year)
    make = F.make_timestamp if strict else F.try_make_timestamp
    return make(year, month, day, hour, minute, F.lit(0).cast("decimal(16,6)"))


def split_author(record: str | Column, compat: bool = False) -> tuple[Column, Column]:
    """(author, body) at the first colon followed by white space; without one, (info, record).

    ``compat`` empties a body that itself holds a colon followed by white space.
    """
    record = col(record)
    head = rf"\A[\s\S]+?:[{SPACE_CLASS}]"
    owned = record.rlike(head)
    author = F.when(owned, F.regexp_extract(record, rf"\A([\s\S]+?):[{SPACE_CLASS}]", 1)).otherwise(INFO_AUTHOR)
    rest = F.regexp_replace(record, head, "")
    text = strip(F.regexp_replace(rest, "\n", " "))
    if compat:
        text = F.when(rest.rlike(head), "").otherwise(text)
    return author, F.when(owned, text).otherwise(record)


def strip(text: str | Column) -> Column:
    return F.regexp_replace(col(text), rf"\A[{SPACE_CLASS}]+|[{SPACE_CLASS}]+\z", "")


def resolve_aliases(msgs: DataFrame, aliases: DataFrame | None, placeholder: str = PLACEHOLDER,
                    compat: bool = False) -> DataFrame:
    """Author to canonical name, anyone not listed to the placeholder; no aliases, no change.

    Authorless records keep their marker unless ``compat``.
    """
    if aliases is None or aliases.isEmpty():
        return msgs
    dim = aliases.select(F.col("alias").alias("author"), "canonical")
    default = F.lit(placeholder)
    if not compat:
        default = F.when(F.col("author") == INFO_AUTHOR, INFO_AUTHOR).otherwise(placeholder)
    order = msgs.columns
    return (
        lookup_or(msgs, dim, "author", "canonical", default, "_author")
        .withColumn("author", F.col("_author")).select(*order)
    )


def messages_of(records: DataFrame, strict: bool = True, compat: bool = False) -> DataFrame:
    """chat_id, pos, stamp, record to chat_id, pos, ts, author, body."""
    author, body = split_author("record", compat)
    return records.select("chat_id", "pos", parse_stamp("stamp", strict).alias("ts"),
                          author.alias("author"), body.alias("body"))


def extract_messages(chats: DataFrame, aliases: DataFrame | None = None, placeholder: str = PLACEHOLDER,
                     strict: bool = True, compat: bool = False, line_start: bool = False) -> DataFrame:
    """``chats(chat_id, value)`` with one export per row to chat_id, pos, ts, author, body.

    ``strict`` makes an unsupported export or an impossible date an error; otherwise the
    export is left out and the date is null.
    """
    found = detect_dialect(chats.select("chat_id", "value"), strict=strict).filter("dialect IS NOT NULL")
    records = split_records(found, line_start=line_start)
    return resolve_aliases(messages_of(records, strict, compat), aliases, placeholder, compat)


def split_lines(lines: DataFrame, strict: bool = True, line_start: bool = False) -> DataFrame:
    """``lines(chat_id, block, slot, value)`` to chat_id, pos, stamp, record.

    Lines carry their place: the input split (``block``) and the order in it (``slot``).
    Records are numbered by a running count per split plus the counts of earlier splits,
    and pieces meet by record number, so no task ever holds more than one split or record.
    """
    first = lines.groupBy("chat_id").agg(F.min_by("value", F.struct("block", "slot")).alias("_first"))
    dialects = first.select("chat_id", dialect_of("_first").alias("dialect"))
    if strict:
        dialects = dialects.withColumn("dialect", F.coalesce("dialect", F.raise_error(F.lit(UNSUPPORTED))))
    known = lookup(lines, dialects.filter("dialect IS NOT NULL"), "chat_id", "inner")
    anchor = r"\A" if line_start else ""
    stamps = _by_dialect(lambda s: F.regexp_extract_all(F.col("value"), F.lit(anchor + s), F.lit(0)))
    parts = _by_dialect(lambda s: F.split(F.col("value"), anchor + s, -1))
    pieces = (
        known.withColumn("_stamps", stamps).withColumn("_parts", parts)
        .select("chat_id", "block", "slot", "_stamps", F.size("_parts").alias("_n"),
                F.posexplode("_parts").alias("piece", "_text"))
        .select("chat_id", "block", "slot", "piece",
                F.when(F.col("piece") > 0, F.get("_stamps", F.col("piece") - 1)).alias("stamp"),
                F.when(F.col("piece") == F.col("_n") - 1, F.concat("_text", F.lit("\n")))
                .otherwise(F.col("_text")).alias("text"))
        .filter("piece > 0 OR text != ''")
    )
    opened = F.col("stamp").isNotNull().cast("long")
    in_split = Window.partitionBy("chat_id", "block").orderBy("slot", "piece").rowsBetween(
        Window.unboundedPreceding, 0)
    before = Window.partitionBy("chat_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        pieces.groupBy("chat_id", "block").agg(F.sum(opened).alias("_opened"))
        .select("chat_id", "block", F.coalesce(F.sum("_opened").over(before), F.lit(0)).alias("_before"))
    )
    numbered = (
        pieces.withColumn("_local", F.sum(opened).over(in_split))
        .join(offsets, ["chat_id", "block"])
        .withColumn("pos", F.col("_before") + F.col("_local") - 1)
        .filter("pos >= 0")
    )
    text = F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "slot", "piece", "text"))), lambda p: p["text"]), "")
    return numbered.groupBy("chat_id", "pos").agg(F.max("stamp").alias("stamp"), text.alias("record"))


def extract_folder(spark: SparkSession, path: str, aliases: DataFrame | None = None,
                   placeholder: str = PLACEHOLDER, strict: bool = True, compat: bool = False,
                   line_start: bool = False) -> DataFrame:
    """All exports of a folder to chat_id, pos, ts, author, body, reading lines."""
    from inkprint.sources.chats import read_chat_lines
    records = split_lines(read_chat_lines(spark, path), strict, line_start)
    return resolve_aliases(messages_of(records, strict, compat), aliases, placeholder, compat)


def render_export(ts: str | Column, author: str | Column, body: str | Column, dialect: str | Column) -> Column:
    """One message as a line of an export; the inverse of the parsing above."""
    ios = F.concat(F.lit("["), F.date_format(col(ts), "d/M/yyyy, HH:mm"), F.lit(":00] "))
    android = F.concat(F.date_format(col(ts), "dd/MM/yyyy, HH:mm"), F.lit(" - "))
    stamp = F.when(col(dialect) == "ios", ios).otherwise(android)
    return F.concat(stamp, col(author), F.lit(": "), col(body))


