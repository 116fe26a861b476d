"""Replication status text, as column expressions over whole texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U32 = 2**32 - 1
#: The names under which a status tells its file, its place and its lag.
FILE_FIELDS = ("binlog_file_num", "binlog_filenum", "binlog_file")
PLACE_FIELD, LAG_FIELD, LAGS_MARK = "binlog_offset", "master_lag", "lag=("


def _numbers(text: Column, pattern: str, group: int = 1) -> Column:
    """All matches of one group, as numbers."""
    return F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: x.try_cast("bigint"))


def _last(values: Column) -> Column:
    return F.try_element_at(values, F.lit(-1))


def replication_status(text: Column) -> Column:
    """Struct ``filenum, offset, lag`` of a status text; null if it tells neither a place
    nor a lag, or a file number above 32 bits.

    A place is a pair of numbers after ``binlog_offset``, or a lone number there beside
    a file field; the last of each counts. The lag is the server's own, or else the
    largest of those of its replicas. Comment lines say nothing.
    """
    told = F.regexp_replace(text, r"(?m)^[ \t]*#.*$", "")
    pair = rf"(?im)\b{PLACE_FIELD}[ \t]*[:=][^\d\r\n]*(\d+)[^\d\r\n]+(\d+)"
    file = F.coalesce(_last(_numbers(told, pair, 1)), _last(_numbers(told, rf"(?im)^[ \t]*(?:{'|'.join(FILE_FIELDS)})[ \t]*:[^\d\r\n]*(\d+)")))
    offset = F.coalesce(_last(_numbers(told, pair, 2)), _last(_numbers(told, rf"(?im)\b{PLACE_FIELD}[ \t]*[:=][^\d\r\n]*(\d+)")))
    of_replicas = F.flatten(F.transform(F.regexp_extract_all(told, F.lit(r"(?im)lag=\((.*)$"), F.lit(1)), lambda rest: _numbers(rest, r"(\d+)")))
    lag = F.coalesce(_last(_numbers(told, rf"(?im)^[ \t]*{LAG_FIELD}[ \t]*:[^\d\r\n]*(\d+)")), F.array_max(of_replicas))
    said = (offset.isNotNull() | lag.isNotNull()) & (F.coalesce(file, F.lit(0)) <= U32)
    return F.when(said, F.struct(F.when(offset.isNotNull(), file).alias("filenum"), offset.alias("offset"), lag.alias("lag")))


def anchor_of(text: str) -> tuple[int, int]:
    """Position at which a dump was taken: fourth and fifth line of its info file."""
    lines = text.splitlines()
    if len(lines) < 5:
        raise ValueError("the info file has fewer than five lines")
    filenum, offset = int(lines[3]), int(lines[4])
    if filenum > U32:
        raise ValueError("the file number exceeds 32 bits")
    return filenum, offset
