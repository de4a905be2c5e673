"""Schemas that change between batches."""

import json
import os

from pyspark.sql.types import ArrayType, DoubleType, LongType, NullType, StringType, StructField, StructType

from tillroll.sources.drift import drift_report, fields, merged_schema, read_batches, widened


def _write(scratch, batches):
    paths = []
    for i, docs in enumerate(batches):
        paths.append(os.path.join(scratch, f"b{i}.json"))
        with open(paths[-1], "w") as f:
            f.write("\n".join(json.dumps(d) for d in docs))
    return paths


def test_changes_are_reported_and_all_values_kept(spark, scratch):
    batches = [
        [{"id": 1, "p": 2, "n": {"a": 1}, "l": [1]}, {"id": 2, "p": None, "n": {"a": 2}}],
        [{"id": 3, "p": 2.5, "n": {"a": 3, "b": "x"}, "l": [1.5]}],
        [],
        [{"id": 4, "p": "$3", "l": ["q"]}, {"id": 5, "p": "4"}],
        [{"id": 6, "n": {"a": 9}}],
    ]
    paths = _write(scratch, batches)
    got = {(r.batch, r.field): (r.change, r.type, r.filled) for r in drift_report(spark, paths).collect()}
    assert got[1, "p"] == ("new", "bigint", 1) and got[2, "p"] == ("retyped", "double", 1) and got[4, "p"] == ("retyped", "string", 2)
    assert got[3, "p"] == ("vanished", None, 0) and got[5, "p"] == ("vanished", None, 0)
    assert got[2, "n.b"] == ("new", "string", 1) and got[5, "n.a"] == ("kept", "bigint", 1) and (4, "n.a") not in got
    assert got[2, "l"] == ("retyped", "array<double>", 1) and got[4, "l"] == ("retyped", "array<string>", 1) and got[1, "l"][2] == 1
    rows = {r.id: (r.p, r.n and (r.n.a, r.n.b), r.l) for r in read_batches(spark, paths).collect()}
    assert rows == {
        1: ("2", (1, None), ["1"]), 2: (None, (2, None), None), 3: ("2.5", (3, "x"), ["1.5"]),
        4: ("$3", None, ["q"]), 5: ("4", None, None), 6: (None, (9, None), None),
    }
    known = StructType([StructField("n", StructType([StructField("z", StringType())]))])
    assert {r.n and r.n.z for r in read_batches(spark, paths[:1], known=known).collect()} == {None}
    assert drift_report(spark, _write(scratch, [[]])).count() == 0


def test_widening():
    long, double, text = LongType(), DoubleType(), StringType()
    one = StructType([StructField("a", long)])
    assert widened(long, double) == widened(double, long) == double
    assert widened(NullType(), long) == widened(long, NullType()) == long
    assert widened(one, text) == widened(ArrayType(long), one) == text
    assert widened(ArrayType(long), ArrayType(double)) == ArrayType(double)
    both = merged_schema([one, StructType([StructField("b", one)]), StructType([StructField("a", text)])])
    assert fields(both) == {"a": text, "b.a": long}
    assert merged_schema([]) == StructType([])
