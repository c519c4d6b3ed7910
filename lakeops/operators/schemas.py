"""Schema growth: new columns are added, types only widen where old Parquet files can still be read."""

from __future__ import annotations

from pyspark.sql import types as T

_WIDER = {
    (T.IntegerType, T.LongType),
    (T.ShortType, T.LongType),
    (T.ByteType, T.LongType),
    (T.ShortType, T.IntegerType),
    (T.ByteType, T.IntegerType),
    (T.IntegerType, T.DoubleType),
    (T.FloatType, T.DoubleType),
}


def can_widen(old: T.DataType, new: T.DataType) -> bool:
    """Whether files of the old type can be read as the new one."""
    return (type(old), type(new)) in _WIDER


def _merge_types(old: T.DataType, new: T.DataType, where: str) -> T.DataType:
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_schemas(old, new, where)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merge_types(old.elementType, new.elementType, where), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        if old.keyType == new.keyType:
            return T.MapType(old.keyType, _merge_types(old.valueType, new.valueType, where), True)
    if (type(old), type(new)) in _WIDER:
        return new
    if (type(new), type(old)) in _WIDER:
        return old
    if old.simpleString() == new.simpleString():
        return old
    raise ValueError(f"column {where} is {old.simpleString()} and cannot take {new.simpleString()}")


def merge_schemas(old: T.StructType, new: T.StructType, where: str = "") -> T.StructType:
    """Old columns in their order, then the new ones; names are compared without case."""
    incoming = {f.name.lower(): f for f in new.fields}
    fields = []
    for f in old.fields:
        other = incoming.pop(f.name.lower(), None)
        data_type = f.dataType if other is None else _merge_types(f.dataType, other.dataType, f"{where}{f.name}")
        fields.append(T.StructField(f.name, data_type, True, f.metadata))
    fields += [T.StructField(f.name, f.dataType, True, f.metadata) for f in new.fields if f.name.lower() in incoming]
    return T.StructType(fields)
