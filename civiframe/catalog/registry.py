"""Registration of queries and small helpers shared by them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The provided tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``function(tables)`` under ``name``, with its SQL if there is one."""

    def register(function: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def seconds_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall-clock timestamp, whatever the session zone."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def iso_text(ts: Column) -> Column:
    return F.replace(seconds_text(ts), F.lit(" "), F.lit("T"))


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def sql_paris_epoch(ts: str) -> str:
    """Epoch seconds of a Paris wall-clock time: summer time runs from the last Sunday
    of March to the last Sunday of October (of September until 1995)."""
    end_month = f"case when year({ts}) < 1996 then make_date(year({ts}), 9, 30) else make_date(year({ts}), 10, 31) end"
    start = f"make_date(year({ts}), 3, 31)"

    def last_sunday(day: str) -> str:
        return f"(({day}) - cast(dayofweek({day}) as integer))"

    return (
        f"(cast(epoch({ts}) as bigint) - case when {ts} >= {last_sunday(start)} + interval 3 hour"
        f" and {ts} < {last_sunday(end_month)} + interval 3 hour then 7200 else 3600 end)"
    )


def sql_surrogate_key(text: str) -> str:
    """64-bit key of an ASCII text: Murmur3 of the text and of its reverse."""
    mask = 4294967295

    def scramble(k: str) -> str:
        a = f"(({k} * 3432918353::ubigint) & {mask})"
        r = f"((({a} << 15) | ({a} >> 17)) & {mask})"
        return f"(({r} * 461845907::ubigint) & {mask})"

    def murmur(t: str) -> str:
        pairs = (
            f"list_transform(range(0, length({t}) // 2), lambda i: "
            f"(unicode({t}[2*i+1])::ubigint * 65536 + unicode({t}[2*i+2])::ubigint))"
        )
        x = f"xor(h, {scramble('k')})"
        rot = f"((({x} << 13) | ({x} >> 19)) & {mask})"
        mixed = (
            f"list_reduce(list_prepend({0xF7CA7FD2}::ubigint, {pairs}), "
            f"lambda h, k: (({rot} * 5 + 3864292196::ubigint) & {mask}))"
        )
        tail = f"case when length({t}) % 2 = 1 then {scramble(f'unicode({t}[length({t})])::ubigint')} else 0::ubigint end"
        h0 = f"xor(xor({mixed}, {tail}), length({t})::ubigint)"
        steps = (
            f"list_reduce([{h0}, 16::ubigint, 2246822507::ubigint, 13::ubigint, 3266489909::ubigint, 16::ubigint], "
            f"lambda h, p: case when p < 32 then xor(h, h >> p) else ((h * p) & {mask}) end)"
        )
        return steps

    high, low = murmur(text), murmur(f"reverse({text})")
    as_signed = f"(case when {high} >= 2147483648 then {high}::bigint - 4294967296 else {high}::bigint end)"
    return f"({as_signed} * 4294967296 + {low}::bigint)"
