"""Id ranges that writers claim, so that two runs at once never give the same id and none scans its target for the maximum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.numbering import number_rows
from millrace.sources.snapshots import ATTEMPTS, Conflict, _create, _path, _read
from millrace.session import cut_lineage


def _claims(spark: SparkSession, folder: str) -> list[int]:
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(int(n) for n in (s.getPath().getName() for s in fs.listStatus(path)) if n.isdigit())


def claim_range(spark: SparkSession, root: str, name: str, count: int, start: int = 1) -> int:
    """The first of ``count`` numbers that are this caller's alone, in the sequence ``name``; the first claim begins at ``start``.

    A claim is a file named by its first number, created where no file is; it holds the number behind its last, which names the
    next claim's file, so two callers want the same file and one of them gets it. Numbers claimed and not used are gaps. Older claims
    are removed: the last one says all.
    """
    if count < 1:
        raise ValueError("a claim has at least one number")
    folder = f"{root}/{name}"
    for _ in range(ATTEMPTS):
        known = _claims(spark, folder)
        first = start
        if known:
            line = _read(spark, f"{folder}/{known[-1]}")
            if not line.endswith("\n"):  # the other caller is just writing it
                continue
            first = int(line)
        try:
            _create(spark, f"{folder}/{first}", f"{first + count}\n")
        except Conflict:
            continue
        for old in known[:-1]:
            fs, path = _path(spark, f"{folder}/{old}")
            fs.delete(path, False)
        return first
    raise Conflict(f"{folder}: {ATTEMPTS} claims lost against other callers")


def number_claimed(df: DataFrame, order_by: Sequence[str], out: str, root: str, name: str, start: int = 1) -> DataFrame:
    """``number_rows`` with numbers of a claimed range: rows are ordered and counted first, and the claim is as long as they are.

    The numbered rows are written to the checkpoint folder before, so that the claim fits however often the result is read.
    An empty table claims nothing.
    """
    numbered = cut_lineage(number_rows(df, order_by, out))
    count = numbered.count()
    if not count:
        return numbered
    first = claim_range(df.sparkSession, root, name, count, start)
    return numbered.withColumn(out, F.col(out) + F.lit(first - 1))
