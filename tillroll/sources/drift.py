"""Fields that change between batches of documents.

Inference per file takes what it sees: a field that appears later is lost, one
that changes its type breaks the load or becomes NULL. Here every batch is
inferred from all of its documents, the schemas are compared, and one schema is
chosen that holds the values of all batches: whole and decimal numbers become
decimal ones, structs are merged field by field, lists element by element, and
whatever else disagrees becomes text. Only schemas reach the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, LongType, NullType, StringType, StructField, StructType

#: What a report says of a field in a batch, against the batch before.
KEPT, NEW, VANISHED, RETYPED = "kept", "new", "vanished", "retyped"


def batch_schemas(spark: SparkSession, paths: Sequence[str], multiline: bool = False) -> list[StructType]:
    """The schema of the documents under each path, from all of them; a batch
    without documents has no fields."""
    read = spark.read.option("multiLine", multiline)
    return [StructType([]) if spark.read.text(p).isEmpty() else read.json(p).schema for p in paths]


def widened(a: DataType, b: DataType) -> DataType:
    """A type that holds the values of both."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        types = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            types[f.name] = widened(types[f.name], f.dataType) if f.name in types else f.dataType
        return StructType([StructField(name, t) for name, t in types.items()])
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(widened(a.elementType, b.elementType))
    if {type(a), type(b)} == {LongType, DoubleType}:
        return DoubleType()
    return StringType()


def merged_schema(schemas: Sequence[StructType]) -> StructType:
    return functools.reduce(widened, schemas, StructType([]))


def fields(schema: StructType, before: str = "") -> dict[str, DataType]:
    """Path and type of every field that isn't a struct of others; a list is one field."""
    out: dict[str, DataType] = {}
    for f in schema.fields:
        if isinstance(f.dataType, StructType):
            out |= fields(f.dataType, f"{before}{f.name}.")
        else:
            out[before + f.name] = f.dataType
    return out


def _changes(schemas: Sequence[StructType]) -> list[tuple[int, str, str, str | None]]:
    """(batch, field, change, type) of every field known so far; batches from 1."""
    out, known, last = [], {}, {}
    for number, schema in enumerate(schemas, 1):
        now = fields(schema)
        for name in sorted(known | now):
            if name not in now:
                if name in last:
                    out.append((number, name, VANISHED, None))
                continue
            kind = now[name].simpleString()
            change = NEW if name not in known else KEPT if known[name] == kind else RETYPED
            out.append((number, name, change, kind))
            known[name] = kind
        last = now
    return out


def drift_report(spark: SparkSession, paths: Sequence[str], multiline: bool = False) -> DataFrame:
    """What each batch does to the fields: batch, field, change, type, filled.

    ``change`` is against the last batch that had the field; ``filled`` counts
    the batch's documents with a value (0 where the field has vanished).
    """
    schemas = batch_schemas(spark, paths, multiline)
    rows = spark.createDataFrame(_changes(schemas), "batch int, field string, change string, type string")
    counts = []
    for number, (path, schema) in enumerate(zip(paths, schemas), 1):
        names = list(fields(schema))
        if not names:
            continue
        quoted = [".".join(f"`{part}`" for part in name.split(".")) for name in names]
        docs = spark.read.schema(schema).option("multiLine", multiline).json(path)
        one = docs.agg(F.array(*[F.struct(F.lit(n).alias("name"), F.count(F.col(q)).alias("filled")) for n, q in zip(names, quoted)]).alias("all"))
        counts.append(one.select(F.lit(number).alias("of"), F.inline("all")))
    if not counts:
        return rows.withColumn("filled", F.lit(0).cast("long"))
    filled = functools.reduce(DataFrame.unionAll, counts)
    same = (rows["batch"] == filled["of"]) & (rows["field"] == filled["name"])
    return rows.join(filled, same, "left").select("batch", "field", "change", "type", F.coalesce("filled", F.lit(0)).cast("long").alias("filled"))


def read_batches(spark: SparkSession, paths: Sequence[str], multiline: bool = False, known: StructType | None = None) -> DataFrame:
    """The documents of all batches under their merged schema; a field that a
    batch lacks is NULL there. ``known``: fields that are there in any case."""
    schema = merged_schema([known or StructType([]), *batch_schemas(spark, paths, multiline)])
    return spark.read.schema(schema).option("multiLine", multiline).json(list(paths))
