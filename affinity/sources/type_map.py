"""External type maps (S1, T4): a JSON file that names the column types of the entity tables.

``src_entity`` and ``tar_entity`` map columns to types, ``pkeys`` the two keys
to theirs, the customer's first. The map turns into explicit schemas, derived
columns are merged into it where they are attached, and a finished table is
held against it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: fixed values: the type names of the map; a category is text unless the column is known as a number
TYPES = {"Int64": T.LongType(), "int64": T.LongType(), "float64": T.DoubleType(), "bool": T.BooleanType(),
         "datetime64[ns]": T.DateType(), "object": T.StringType(), "string": T.StringType(), "category": T.StringType()}
#: fixed values: categories over numbers, which have to sort as numbers
NUMBER_CATEGORIES = {"FN": T.DoubleType(), "active_status": T.DoubleType(),
                     "idx_group_no": T.LongType(), "garment_group_no": T.LongType()}


def _type(table: str, column: str, name: str) -> T.DataType:
    if name not in TYPES:
        raise ValueError(f"{table}: column {column} has the unknown type {name!r}")
    return NUMBER_CATEGORIES.get(column, TYPES[name]) if name == "category" else TYPES[name]


def read_type_map(spark: SparkSession, path: str) -> tuple[T.StructType, T.StructType]:
    """Schemas of the customer and the product table, each with its key first."""
    found = spark.read.text(path, wholetext=True).first()
    said = json.loads(found[0]) if found else {}
    missing = [k for k in ("src_entity", "tar_entity", "pkeys") if not isinstance(said.get(k), dict)]
    if missing or len(said["pkeys"]) != 2:
        raise ValueError(f"{path}: needs {', '.join(missing) or 'two pkeys'}")
    schemas = []
    for table, key in zip(("src_entity", "tar_entity"), said["pkeys"]):
        if key in said[table]:
            raise ValueError(f"{path}: key {key} is also a column of {table}")
        fields = [T.StructField(key, _type("pkeys", key, said["pkeys"][key]), False)]
        schemas.append(T.StructType(fields + [T.StructField(c, _type(table, c, t)) for c, t in said[table].items()]))
    return schemas[0], schemas[1]


def merged(schema: T.StructType, derived: T.StructType) -> T.StructType:
    """``schema`` and the columns of ``derived`` that it lacks; a column of both must have one type."""
    types = {f.name: f.dataType for f in schema}
    clash = [f"{f.name} ({types[f.name].simpleString()}, {f.dataType.simpleString()})" for f in derived
             if f.name in types and types[f.name] != f.dataType]
    if clash:
        raise ValueError(f"columns with two types: {', '.join(clash)}")
    return T.StructType(schema.fields + [f for f in derived if f.name not in types])


def asserted(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """``df`` if its columns are those of ``schema`` in order and type (whether they may be null is not compared)."""
    want, have = ([(f.name, f.dataType.simpleString()) for f in s] for s in (schema, df.schema))
    if want != have:
        raise ValueError(f"{table}: {sorted(set(have) - set(want))} in place of {sorted(set(want) - set(have))}"
                         if set(want) != set(have) else f"{table}: columns in another order")
    return df
