from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def holds_map(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(holds_map(f.dataType) for f in kind)
    return isinstance(kind, MapType) or isinstance(kind, ArrayType) and holds_map(kind.elementType)


def orderable(value: Column, kind: DataType) -> Column:
    """`value` in a form that can be sorted: a map, which Spark does not order, stands as its entries in order of their keys."""
    if not holds_map(kind):
        return value
    if isinstance(kind, MapType):
        return F.array_sort(F.transform(
            F.map_entries(value), lambda e: F.struct(e["key"].alias("key"), orderable(e["value"], kind.valueType).alias("value"))
        ))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda e: orderable(e, kind.elementType))
    fields = [orderable(value.getField(f.name), f.dataType).alias(f.name) for f in kind]
    return F.when(value.isNotNull(), F.struct(*fields))
