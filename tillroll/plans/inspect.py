"""Read a query's physical plan: what runs, what shuffles, what reaches the scan."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

# Physical operators that must not appear in the registered queries.
CROSS_JOINS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON_EVAL = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_text(df: DataFrame, mode: str = "simple") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def pushed_filters(df: DataFrame) -> list[str]:
    """The full ``PushedFilters`` list of every file scan, in plan order."""
    return re.findall(r"^PushedFilters: \[(.*)\]$", plan_text(df, "formatted"), re.MULTILINE)


def read_schemas(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of every file scan (the columns actually read)."""
    return re.findall(r"^ReadSchema: (struct<.*>)$", plan_text(df, "formatted"), re.MULTILINE)


def _distinct_nodes(text: str, marker: str) -> int:
    """Plan nodes starting with ``marker``, counted once per ``plan_id``.

    The text repeats a shared subquery under every operator that uses it;
    the id identifies one physical node.
    """
    ids = set()
    anonymous = 0
    for line in text.splitlines():
        if marker not in line:
            continue
        m = re.search(r"plan_id=(\d+)", line)
        if m:
            ids.add(m.group(1))
        else:
            anonymous += 1
    return len(ids) + anonymous


def summary(df: DataFrame) -> dict[str, int]:
    """Counts of the operators that matter for scale (shared subqueries once)."""
    text = plan_text(df)
    out = {
        "exchanges": _distinct_nodes(text, "Exchange "),
        "single_partition_exchanges": _distinct_nodes(text, "Exchange SinglePartition"),
        "broadcasts": _distinct_nodes(text, "BroadcastExchange"),
        "sort_merge_joins": text.count("SortMergeJoin"),
        "broadcast_hash_joins": text.count("BroadcastHashJoin"),
        "window_group_limits": text.count("WindowGroupLimit"),
    }
    out["cross_joins"] = sum(text.count(op) for op in CROSS_JOINS)
    out["python"] = sum(text.count(op) for op in PYTHON_EVAL)
    return out
