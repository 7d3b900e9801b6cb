"""Message rows to the clean, balanced table."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkprint.constants import ATTACHED_MARKER, EDITED_MARKERS, INFO_AUTHOR, NOTICE_PATTERNS, PLACEHOLDER, SEED
from inkprint.functions.text import col
from inkprint.operators.joins import lookup
from inkprint.operators.order import blocked_lag, dense_index, dimension_index, dimension_lag
from inkprint.operators.sampling import undersample
from inkprint.session import materialize


def responsiveness(df: DataFrame, scope: str = "chat", chat: str = "chat_id", pos: str = "pos",
                   ts: str = "ts") -> DataFrame:
    """Add the whole seconds since the previous message, never negative, 0 for the first.

    ``corpus`` scope lets the first message of a chat follow the last one of the chat
    before it (in chat order); ``chat`` scope starts each chat anew.
    """
    if scope not in ("chat", "corpus"):
        raise ValueError(f"unknown scope: {scope}")
    timed = df.withColumn("_sec", F.unix_seconds(col(ts).cast("timestamp")))
    prior = blocked_lag(timed, [chat], pos, "_sec", "_before")
    if scope == "corpus":
        ends = timed.groupBy(chat).agg(F.max_by("_sec", pos).alias("_end"))
        links, size = dimension_lag(ends, chat, "_end", "_link")
        prior = lookup(prior, links.select(chat, "_link"), chat, known_bytes=size).withColumn("_before", F.coalesce("_before", "_link")).drop("_link")
    gap = F.coalesce(F.greatest(F.col("_sec") - F.col("_before"), F.lit(0)), F.lit(0)).cast("long")
    return prior.withColumn("responsiveness", gap).drop("_sec", "_before")


def drop_info(df: DataFrame) -> DataFrame:
    return df.filter(F.col("author") != INFO_AUTHOR)


class Users(NamedTuple):
    """Dimension of the authors (author, user) and its stored size."""

    table: DataFrame
    size: int


def user_dimension(df: DataFrame, author: str = "author") -> Users:
    names, size = dimension_index(df.select(F.col(author).alias("author")).distinct(), "author", "user")
    return Users(names.select("author", F.col("user").cast("int").alias("user")), size)


def index_users(df: DataFrame, author: str = "author") -> DataFrame:
    """The distinct authors with their rank: author, user."""
    return user_dimension(df, author).table


def attach_users(df: DataFrame, users: DataFrame | Users) -> DataFrame:
    """Author to class index; every author is in the dimension."""
    table, size = users if isinstance(users, Users) else (users.select("author", "user"), None)
    return lookup(df, table, "author", "inner", known_bytes=size)


def strip_edited(body: str | Column) -> Column:
    return F.regexp_replace(col(body), "|".join(EDITED_MARKERS), "")


def is_notice(body: str | Column, patterns: Iterable[str] | None = None) -> Column:
    """Whether the whole body matches one of the patterns."""
    patterns = NOTICE_PATTERNS if patterns is None else [p.strip() for p in patterns if p.strip()]
    if not patterns:
        return F.lit(False)
    return col(body).rlike(rf"\A(?:{'|'.join(f'(?:{p})' for p in patterns)})\z")


def drop_notices(df: DataFrame, patterns: Iterable[str] | None = None, body: str = "body") -> DataFrame:
    return df.filter(~is_notice(body, patterns))


def drop_attached(df: DataFrame, body: str = "body") -> DataFrame:
    return df.filter(~F.contains(col(body), F.lit(ATTACHED_MARKER)))


def drop_placeholder(df: DataFrame, users: DataFrame, name: str = PLACEHOLDER) -> DataFrame:
    """Remove the placeholder's messages; an error if there is no such author."""
    row = users.filter(F.col("author") == name).select("user").first()
    if row is None:
        raise ValueError(f"no author named {name!r}")
    return df.filter(F.col("user") != row["user"])


def drop_blank(df: DataFrame, body: str = "body") -> DataFrame:
    """Trim bodies and leave out blank ones."""
    trimmed = F.regexp_replace(col(body), r"\A\s+|\s+\z", "")
    return df.withColumn(body, trimmed).filter(F.col(body) != "")


def with_message_id(df: DataFrame, chat: str = "chat_id", pos: str = "pos", dense: bool = False,
                    keys: DataFrame | None = None) -> DataFrame:
    """Add a stable key from chat and position, or (``dense``) 0..n-1 in that order.

    The key is the chat's number times 2^32 plus the position. A chat's number is its id where all ids are
    integers below 2^31, and its place among the sorted ids otherwise. Positions must lie in
    [0, 2^32), else two messages could share a key: that is an error. ``keys`` may name a cheaper table with the
    same chats and positions.
    """
    if dense:
        return dense_index(df, [chat, pos], "message_id")
    keys = df if keys is None else keys
    whole = dict(df.dtypes)[chat] in ("bigint", "int", "smallint", "tinyint")
    number = F.col(chat).cast("long") if whole else F.lit(None).cast("long")
    low, high, first, last = keys.agg(F.min(number), F.max(number), F.min(pos), F.max(pos)).first()
    if first is not None and (first < 0 or last >= 1 << 32):
        raise ValueError("positions must be in [0, 2^32)")
    if whole and (low is None or (low >= 0 and high < 1 << 31)):
        return df.withColumn("message_id", F.shiftleft(number, 32) + F.col(pos))
    chats, size = dimension_index(keys.select(chat).distinct(), chat, "_chat_no")
    return (
        lookup(df, chats, chat, known_bytes=size)
        .withColumn("message_id", F.shiftleft(F.col("_chat_no"), 32) + F.col(pos)).drop("_chat_no")
    )


def class_counts(df: DataFrame, users: DataFrame | None = None, user: str = "user") -> DataFrame:
    """user, n; with the dimension given, users without rows show 0."""
    counts = df.groupBy(user).agg(F.count("*").alias("n"))
    if users is None:
        return counts
    return users.select(user).join(counts, user, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def class_names(df: DataFrame, user: str = "user") -> DataFrame:
    """Distinct classes in order, with their number from 0 and how many there are."""
    names, _ = dimension_index(df.select(F.col(user).alias("class_name")).distinct(), "class_name", "class_index")
    return names.withColumn("n_classes", names.agg(F.count("*")).scalar())


class Clean(NamedTuple):
    messages: DataFrame
    users: DataFrame


def check_messages(msgs: DataFrame) -> None:
    """Missing columns, or a null stamp, author or body, are errors."""
    missing = {"chat_id", "pos", "ts", "author", "body"} - set(msgs.columns)
    if missing:
        raise KeyError(f"missing columns: {sorted(missing)}")
    if not msgs.filter("ts IS NULL OR author IS NULL OR body IS NULL").isEmpty():
        raise ValueError("messages need a stamp, an author and a body")


def clean_messages(msgs: DataFrame, patterns: Iterable[str] | None = None, placeholder: str = PLACEHOLDER,
                   remove_placeholder: bool = False, scope: str = "corpus", seed: int = SEED,
                   balance: bool = True) -> Clean:
    """The whole chain; message columns are message_id, responsiveness, user, message.

    Gaps are taken before authorless rows leave, and the placeholder takes part in the
    balancing before its messages leave. The unbalanced table is written once: the
    balancing then reads its narrow key columns twice and its rows once.
    """
    check_messages(msgs)
    dimension = user_dimension(drop_info(msgs))
    users = dimension.table
    timed = drop_info(responsiveness(msgs, scope))
    rows = with_message_id(attach_users(timed, dimension), keys=msgs.select("chat_id", "pos"))
    rows = drop_attached(drop_notices(rows.withColumn("body", strip_edited("body")), patterns))
    rows = materialize(rows.select("message_id", "responsiveness", "user", F.col("body").alias("message")), "clean")
    if balance:
        rows = undersample(rows, "user", "message_id", seed, classes=users)
    if remove_placeholder:
        rows = drop_placeholder(rows, users, placeholder)
    return Clean(rows, users)


def renumber(df: DataFrame) -> DataFrame:
    """Dense message ids in class order, as the balanced table numbers its rows."""
    old = df.withColumnRenamed("message_id", "_old")
    return dense_index(old, ["user", "_old"], "message_id").drop("_old")
