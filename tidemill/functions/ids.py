"""Deterministic identifiers of chunks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the name space of point ids.
POINT_NAMESPACE = "e7b2c4a0-5d1f-4c8e-9a3b-6f2d8e1c4b7a"


def _name(tenant: Column, table: Column, pk: Column, chunk: Column) -> Column:
    return F.concat(tenant, F.lit(":"), table, F.lit(":"), pk.cast("string"), F.lit(":"), chunk.cast("string"))


def vector_id(tenant: Column, table: Column, pk: Column, chunk: Column) -> Column:
    """Hex SHA-256 of tenant:table:pk:chunk; null if any part is."""
    return F.sha2(_name(tenant, table, pk, chunk), 256)


def point_id(tenant: Column, table: Column, pk: Column, chunk: Column) -> Column:
    """Version 5 UUID of the same name, without a Python function."""
    h = F.sha1(F.concat(F.unhex(F.lit(POINT_NAMESPACE.replace("-", ""))), F.encode(_name(tenant, table, pk, chunk), "utf-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
