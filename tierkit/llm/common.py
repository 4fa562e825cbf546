"""Helpers shared by the operators: tables, scratch tables, column names, package shipping."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.session import scratch_path, scratch_root

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text"):
    """The text column, a null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while base.lower() in have:
        base = f"_{base}"
    return base


def let(value, body):
    """``body(value)`` with the column ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def folded(items, state, none, step, block: int = 512):
    """What ``step`` gives for each item of an array, in one array, carrying a state along.

    ``step(state, out, item)`` returns the next state and ``out`` with what the item adds, as a pair or a struct of both; ``state`` is a
    struct column, ``none`` an empty array.  An array that grows by an item is copied each time, so items are folded
    ``block`` at a time and the blocks' arrays put together at the end: no copy is longer than a block.
    Returns a struct of ``state`` and ``out``.
    """
    pair = lambda s, out: F.struct(s.alias("state"), out.alias("out"))

    def one(a, item):
        got = step(a["state"], a["out"], item)
        return pair(*got) if isinstance(got, tuple) else got

    def blocks(every):
        n = F.size(every)
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(n, F.lit(1)) - 1) / block).cast("int")),
                            lambda i: F.slice(every, i * block + 1, F.lit(block)))
        lists = F.array(none)
        return F.aggregate(parts, pair(state, F.slice(lists, 1, 0)), lambda a, part: let(
            F.aggregate(part, pair(a["state"], none), one), lambda x: pair(x["state"], F.concat(a["out"], F.array(x["out"])))),
            lambda a: pair(a["state"], F.flatten(a["out"])))

    return let(items, blocks)


def characters(text):
    """The characters of a text as an array: a piece of it is then taken without walking over what stands before."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def cut_out(chars, start, end):
    """The text of an array of characters from ``start`` to ``end`` (exclusive)."""
    return F.array_join(F.slice(chars, start + 1, F.greatest(end - start, F.lit(0))), "")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder of the session and read it back.

    Cuts the lineage at a table that every executor can read again, so a lost
    executor costs only its running tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, wherever the job was started."""
    sc = spark.sparkContext
    scratch_root(spark)
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="tierkit-ship-"), "tierkit-package.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(d, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(top)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
