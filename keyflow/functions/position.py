"""Log positions: (file number, offset), compared in that order.

An unset position is null, never zero: file 0, offset 0 is a valid place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET_BITS = 40


def position(filenum: Column | str = "filenum", offset: Column | str = "offset") -> Column:
    """Struct of the two; Spark compares structs field by field, null fields are unset."""
    filenum, offset = (F.col(c) if isinstance(c, str) else c for c in (filenum, offset))
    both = F.struct(filenum.cast("bigint").alias("filenum"), offset.cast("bigint").alias("offset"))
    return F.when(filenum.isNotNull() & offset.isNotNull(), both)


def literal_position(filenum: int, offset: int) -> Column:
    return position(F.lit(filenum), F.lit(offset))


def sequence_number(filenum: Column | str = "filenum", offset: Column | str = "offset") -> Column:
    """One number that orders as positions do while offsets stay below 2**40."""
    filenum, offset = (F.col(c) if isinstance(c, str) else c for c in (filenum, offset))
    return F.shiftleft(filenum.cast("bigint"), OFFSET_BITS).bitwiseOR(offset.cast("bigint"))


#: Fixed values of the 32-bit FNV-1a hash.
FNV_OFFSET, FNV_PRIME = 2166136261, 16777619


def fnv1a(data: Column) -> Column:
    """32-bit FNV-1a hash of a binary or text column, as a non-negative number."""
    data = data.cast("binary")
    steps = F.slice(F.sequence(F.lit(1), F.greatest(F.octet_length(data), F.lit(1))), F.lit(1), F.octet_length(data))
    byte = lambda i: F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("bigint")
    return F.aggregate(steps, F.lit(FNV_OFFSET).cast("bigint"), lambda acc, i: F.pmod(acc.bitwiseXOR(byte(i)) * FNV_PRIME, F.lit(2**32)))


def route(key: Column, partitions: int) -> Column:
    """Partition of a key, by its FNV-1a hash read as a signed number, without sign."""
    h = fnv1a(key)
    return F.pmod(F.abs(F.when(h >= 2**31, h - 2**32).otherwise(h)), F.lit(partitions)).cast("int")
