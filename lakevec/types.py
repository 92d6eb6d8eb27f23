"""Field types and schemas of collections, and their Spark equivalents."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace
from enum import IntEnum

from pyspark.sql import types as T


class FieldType(IntEnum):
    # fixed values: type codes of the stored format
    BOOL = 1
    INT8 = 2
    INT16 = 3
    INT32 = 4
    INT64 = 5
    FLOAT = 10
    DOUBLE = 11
    STRING = 20
    VARCHAR = 21
    ARRAY = 22
    JSON = 23
    BINARY_VECTOR = 100
    FLOAT_VECTOR = 101
    FLOAT16_VECTOR = 102
    BFLOAT16_VECTOR = 103
    SPARSE_FLOAT_VECTOR = 104


    @property
    def is_integer(self) -> bool:
        return FieldType.INT8 <= self <= FieldType.INT64

    @property
    def is_floating(self) -> bool:
        return self in (FieldType.FLOAT, FieldType.DOUBLE)

    @property
    def is_numeric(self) -> bool:
        return self.is_integer or self.is_floating

    @property
    def is_text(self) -> bool:
        return self in (FieldType.STRING, FieldType.VARCHAR)

    @property
    def is_vector(self) -> bool:
        return self >= FieldType.BINARY_VECTOR


VECTORS = frozenset(t for t in FieldType if t >= FieldType.BINARY_VECTOR)
#: System columns of a segment.
ROW_ID_FIELD, TS_FIELD = 0, 1
MAX_VARCHAR = 65535

_SCALARS = {
    FieldType.BOOL: T.BooleanType(),
    FieldType.INT8: T.ByteType(),
    FieldType.INT16: T.ShortType(),
    FieldType.INT32: T.IntegerType(),
    FieldType.INT64: T.LongType(),
    FieldType.FLOAT: T.FloatType(),
    FieldType.DOUBLE: T.DoubleType(),
    FieldType.STRING: T.StringType(),
    FieldType.VARCHAR: T.StringType(),
    FieldType.JSON: T.StringType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: FieldType
    field_id: int = -1
    dim: int = 0
    max_length: int = 0
    element: FieldType | None = None
    primary: bool = False
    auto_id: bool = False
    nullable: bool = True
    partition_key: bool = False

    def spark_type(self) -> T.DataType:
        if self.type in _SCALARS:
            return _SCALARS[self.type]
        if self.type == FieldType.ARRAY:
            return T.ArrayType(_SCALARS[self.element or FieldType.INT64])
        if self.type == FieldType.BINARY_VECTOR:
            return T.BinaryType()
        if self.type == FieldType.SPARSE_FLOAT_VECTOR:
            return T.MapType(T.LongType(), T.FloatType())
        return T.ArrayType(T.FloatType())

    def struct_field(self) -> T.StructField:
        meta = {"field_id": self.field_id, "type_code": int(self.type), "dim": self.dim, "max_length": self.max_length, "primary": self.primary, "auto_id": self.auto_id}
        return T.StructField(self.name, self.spark_type(), self.nullable, meta)


@dataclass(frozen=True)
class CollectionSchema:
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) < len(names):
            raise ValueError("a field is named twice")

    @property
    def primary(self) -> Field:
        for f in self.fields:
            if f.primary:
                return f
        raise ValueError(f"collection {self.name} has no primary key")

    def by_name(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def to_struct(self) -> T.StructType:
        return T.StructType([f.struct_field() for f in self.fields])

    def dumps(self) -> str:
        return json.dumps({"name": self.name, "fields": [asdict(f) for f in self.fields]})

    @classmethod
    def loads(cls, text: str) -> CollectionSchema:
        raw = json.loads(text)
        return cls(raw["name"], tuple(_field(f) for f in raw["fields"]))

    @classmethod
    def from_struct(cls, name: str, schema: T.StructType, primary: str, vector: str = "", dim: int = 32, auto_id: bool = False) -> CollectionSchema:
        """The schema that a new collection gets for a DataFrame: integer keys become 64-bit, the vector field gets ``dim``."""
        fields = tuple(_of_spark(f, 100 + i, f.name == primary, vector, dim) for i, f in enumerate(schema.fields))
        if primary and primary not in schema.names:
            raise ValueError(f"no column is named {primary}")
        return cls(name, tuple(replace(f, auto_id=auto_id, nullable=False) if f.primary else f for f in fields))


def _field(raw: dict) -> Field:
    element = raw.get("element")
    return Field(**raw | {"type": FieldType(raw["type"]), "element": FieldType(element) if element else None})


def _of_spark(f: T.StructField, field_id: int, primary: bool, vector: str, dim: int) -> Field:
    kind = f.dataType
    make = lambda t, **more: Field(f.name, t, field_id, primary=primary, nullable=f.nullable, **more)
    if code := (f.metadata or {}).get("type_code"):  # it came from a collection
        element = next((k for k, v in _SCALARS.items() if isinstance(kind, T.ArrayType) and v == kind.elementType), None)
        return make(FieldType(code), dim=f.metadata.get("dim", 0), max_length=f.metadata.get("max_length", 0), element=element if FieldType(code) == FieldType.ARRAY else None)
    if f.name == vector:
        if isinstance(kind, T.BinaryType):
            return make(FieldType.BINARY_VECTOR, dim=dim)
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
            return make(FieldType.FLOAT_VECTOR, dim=dim)
        if isinstance(kind, T.MapType):
            return make(FieldType.SPARSE_FLOAT_VECTOR)
        raise ValueError(f"Unsupported data type of a vector: {kind.simpleString()}")
    if isinstance(kind, (T.ShortType, T.IntegerType, T.ByteType)) and primary:
        return make(FieldType.INT64)
    if isinstance(kind, T.VarcharType):
        return make(FieldType.VARCHAR, max_length=kind.length)
    if isinstance(kind, T.StringType):
        return make(FieldType.VARCHAR, max_length=MAX_VARCHAR)
    for code, known in _SCALARS.items():
        if kind == known:
            return make(code)
    if isinstance(kind, T.ArrayType):
        for code, known in _SCALARS.items():
            if kind.elementType == known:
                return make(FieldType.ARRAY, element=FieldType.VARCHAR if code == FieldType.STRING else code)
    raise ValueError(f"Unsupported data type: {kind.simpleString()}")
