"""Read files that hold one JSON array each, in parallel.

A JSON array has no line ends to split at: ``{`` may open a document, a nested
one, or stand in a string, and which of these it is depends on all text before
it. So the file is read twice in byte ranges of Spark's choosing, as text cut
after every ``}``:

1. Each range is scanned under both assumptions about where it begins, outside
   or inside a string. For each the scan tells how much deeper the nesting is at
   the end, how much less deep it becomes in between, and whether the end lies in
   a string. These answers compose: run through in order, one line a range, they
   give the state with which every range really begins.
2. Each range is scanned again from its true state and cut into documents, the
   elements of the outermost array (or the outermost objects of a file that
   isn't an array: one document, or documents one after another). A document
   that crosses ranges comes in torn parts, which are put together by the range
   in which it begins.

A file that can't be read from the middle on (compressed as a whole) is one range
whose state is known, and is read once.

The documents are parsed as they are cut, and the parsed ones are staged in the
shared folder, so the second scan and the parse run once whatever is read from
them. Text between documents that is no comma or white space (a number, a cut
file's rest) is a document that can't be parsed; unlike in a whole-file read it
leaves its neighbours alone.

The scan runs in Arrow batches with array operations; a task holds a batch and
the document it is in.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.documents import CORRUPT, path_exists

_BETWEEN = b" \t\r\n,[]\xef\xbb\xbf"
_BEFORE = b" \t\r\n\xef\xbb\xbf"
# Kinds of bytes; any other is 0.
_QUOTE, _OPENS, _CLOSES = 1, 2, 3
_KINDS = bytes({ord('"'): _QUOTE, ord("{"): _OPENS, ord("["): _OPENS, ord("}"): _CLOSES, ord("]"): _CLOSES}.get(b, 0) for b in range(256))
#: Longer runs of backslashes are counted in one pass over the text.
_SHORT_RUN = 16


class Marks(NamedTuple):
    """The brackets of a text: where they stand, +1 or -1, and whether an odd
    number of quotes stands before each; and whether the text has an odd number."""

    at: np.ndarray
    step: np.ndarray
    odd: np.ndarray
    flips: bool


def _plain(data: np.ndarray, quotes: np.ndarray) -> np.ndarray:
    """Those quotes that don't stand behind an odd number of backslashes: such a
    quote belongs to its string."""
    behind = np.flatnonzero((quotes > 0) & (data[quotes - 1] == ord("\\")))
    if not len(behind):
        return quotes
    runs, live = np.ones(len(behind), int), np.arange(len(behind))
    for n in range(2, _SHORT_RUN):
        before = quotes[behind[live]] - n
        live = live[(before >= 0) & (data[before] == ord("\\"))]
        if not len(live):
            break
        runs[live] += 1
    else:
        last = np.maximum.accumulate(np.where(data == ord("\\"), -1, np.arange(len(data))))
        before = quotes[behind] - 1
        runs = before - last[before]
    return np.delete(quotes, behind[runs % 2 == 1])


def marks(data: np.ndarray | bytes) -> Marks:
    text = data if isinstance(data, bytes) else data.tobytes()
    kinds = np.frombuffer(text.translate(_KINDS), np.uint8)
    places = np.flatnonzero(kinds)
    kinds = kinds[places]
    quotes = places[kinds == _QUOTE]
    if b'\\"' in text:
        quotes = _plain(np.frombuffer(text, np.uint8), quotes)
    brackets = kinds != _QUOTE
    at = places[brackets]
    step = np.where(kinds[brackets] == _OPENS, 1, -1)
    return Marks(at, step, np.searchsorted(quotes, at) % 2 == 1, len(quotes) % 2 == 1)


def _unsplit(text: DataFrame) -> tuple[str, ...]:
    """The endings of those files that Spark reads as one range whatever their
    size: compressed ones that can't be read from the middle on."""
    spark = text.sparkSession
    factory = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    found = []
    for ending in sorted({os.path.splitext(name)[1] for name in text.inputFiles()} - {""}):
        codec = factory.getCodec(spark._jvm.org.apache.hadoop.fs.Path(f"f{ending}"))
        if codec is not None and not is_instance_of(spark.sparkContext._gateway, codec, "org.apache.hadoop.io.compress.SplittableCompressionCodec"):
            found.append(ending)
    return tuple(found)


def _texts(text: DataFrame) -> DataFrame:
    """(path, start, size, value): the text of every range, in pieces that lack
    their last ``}``; size: of the file."""
    place = {"path": "file_path", "start": "file_block_start", "size": "file_size"}
    return text.select(*[F.col(f"_metadata.{field}").alias(name) for name, field in place.items()], "value")


def _ranges(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, bytes]]:
    """(path, start, size, text) of neighbouring pieces of one range, each with a
    ``}`` at its end (also the last one of a file, which may have had none)."""
    for part in parts:
        paths, starts = part.column("path"), part.column("start").to_numpy()
        names = paths.dictionary_encode().indices.to_numpy() if part.num_rows else np.empty(0, int)
        cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(names) != 0)) + 1 if part.num_rows else []
        for first, last in zip([0, *cuts], [*cuts, part.num_rows]):
            if last > first:
                pieces = part.column("value").slice(first, last - first).cast(pa.binary()).to_pylist()
                yield paths[int(first)].as_py(), int(starts[first]), part.column("size")[int(first)].as_py(), b"}".join([*pieces, b""])


def _summaries(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: dict | None = None

    def line() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([now])

    for path, start, size, text in _ranges(parts):
        if now is None or (now["path"], now["start"]) != (path, start):
            if now is not None:
                yield line()
            now = {"path": path, "start": start, "size": size, "read": 0, "first": "", "flips": False, "end0": 0, "least0": 0, "end1": 0, "least1": 0}
        now["read"] += len(text)
        found = marks(text)
        if not now["first"]:
            now["first"] = text.lstrip(_BEFORE)[:1].decode("ascii", "replace")
        for inside in (0, 1):
            # Brackets count where the assumption puts them outside of strings.
            depth = np.cumsum(np.where(found.odd == bool(inside ^ now["flips"]), found.step, 0))
            if len(depth):
                now[f"least{inside}"] = min(now[f"least{inside}"], now[f"end{inside}"] + int(depth.min()))
                now[f"end{inside}"] += int(depth[-1])
        now["flips"] ^= found.flips
    if now is not None:
        yield line()


class State(NamedTuple):
    """How a range begins: in a string, how deep, the depth between documents,
    and the range in which the document it begins in has begun (-1: in none);
    and whether its file ends here, without the ``}`` that was added to it."""

    inside: bool
    depth: int
    base: int
    begun: int
    bare: bool = False


def _is_bare(base: int, read: int, size: int, depth: int) -> bool:
    """Whether the last ``}`` of a file was added to it. ``read``: with that one,
    ``depth``: behind it. A compressed file's size tells nothing; an array never
    ends with a document."""
    return base == 1 or read == size + 1 or (read != size and depth < 0)


def compose(lines: list[dict]) -> dict[tuple[str, int], State]:
    """The state of every range from the summaries of all, one line each."""
    states, bare, path, read = {}, {}, None, 0
    for line in sorted(lines, key=lambda r: (r["path"], r["start"])):
        if line["path"] != path:
            path, inside, depth, begun, read = line["path"], False, 0, -1, 0
            base = 1 if line["first"] == "[" else 0
        states[path, line["start"]] = State(inside, depth, base, begun)
        own = depth + line[f"least{int(inside)}"] <= base  # a document ends or may begin here
        depth += line[f"end{int(inside)}"]
        inside ^= line["flips"]
        begun = -1 if depth <= base else line["start"] if own else begun
        last, read = (path, line["start"]), read + line["read"]
        bare[path] = (last, _is_bare(base, read, line["size"], depth))
    for last, is_bare in bare.values():
        states[last] = states[last]._replace(bare=is_bare)
    return states


class _Cutter:
    """Cuts one range into documents. ``rows``: (text, range it has begun in or
    None for a whole one). Without a ``state`` the range is a whole file of
    ``size`` bytes, which tells by itself how it begins and ends."""

    def __init__(self, state: State | None, start: int, size: int = 0):
        self.whole, self.size, self.read = state is None, size, 0
        state = state or State(False, 0, 0, -1)
        self.state, self.start = state, start
        self.inside, self.depth = state.inside, state.depth
        self.open = state.begun >= 0  # in a document
        self.key = state.begun
        self.last = b""
        self.parts: list[bytes] = []
        self.rows: list[tuple[bytes, int | None]] = []

    def add(self, text: bytes) -> None:
        """The range's text goes on; its last character waits for what follows."""
        if self.whole and not self.read:
            self.state = self.state._replace(base=int(text.lstrip(_BEFORE)[:1] == b"["))
        self.read += len(text)
        text, self.last = self.last + text[:-1], text[-1:]
        self._add(text)

    def _add(self, text: bytes) -> None:
        base = self.state.base
        found = marks(text)
        counts = found.odd == self.inside
        at, step = found.at[counts], found.step[counts]
        depth = self.depth + np.cumsum(step)
        first = at[(step > 0) & (depth == base + 1)]
        last = at[(step < 0) & (depth == base)] + 1
        done = 0  # up to here the text is dealt with
        if self.open and len(last):
            self.parts.append(text[: last[0]])
            self._close()
            done, last = int(last[0]), last[1:]
        if not self.open:
            for a, b in zip(first.tolist(), last.tolist()):
                self._between(text[done:a])
                self.rows.append((text[a:b], None))
                done = b
            if len(first) > len(last):
                self._between(text[done : first[len(last)]])
                self.open, self.key, done = True, -1, int(first[len(last)])
            else:
                self._between(text[done:])
        if self.open:
            self.parts.append(text[done:])
        if len(depth):
            self.depth = int(depth[-1])
        self.inside ^= found.flips

    def _between(self, text: bytes) -> None:
        if text != b"," and (rest := text.strip(_BETWEEN)):
            self.rows.append((rest, None))

    def _close(self) -> None:
        self.rows.append((b"".join(self.parts), self.key if self.key >= 0 else None))
        self.parts, self.open, self.key = [], False, -1

    def end(self) -> None:
        """The range is over: an open document goes on in the next one."""
        if self.whole:
            # The last character is a bracket, or it stands in a string.
            depth = self.depth - (not self.inside)
            self.state = self.state._replace(bare=_is_bare(self.state.base, self.read, self.size, depth))
        if not self.state.bare:
            self._add(self.last)
        if self.open and self.parts:
            self.rows.append((b"".join(self.parts), self.key if self.key >= 0 else self.start))
            self.parts = []


def _strings(texts: list[bytes]) -> pa.Array:
    try:
        return pa.array(texts, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        return pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())


def _cuts(states: dict[tuple[str, int], State], unsplit: tuple[str, ...]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cutter = None, None

        def out() -> pa.RecordBatch:
            rows, cutter.rows = cutter.rows, []
            torn = [begun is not None for _, begun in rows]
            return pa.RecordBatch.from_arrays(
                [
                    _strings([t for t, _ in rows]),
                    pa.array([key[0] if t else None for t in torn], pa.string()),
                    pa.array([b for _, b in rows], pa.int64()),
                    pa.array([key[1] if t else None for t in torn], pa.int64()),
                ],
                ["value", "path", "begun", "part"],
            )

        for path, start, size, text in _ranges(parts):
            if (path, start) != key:
                if cutter is not None:
                    cutter.end()
                    yield out()
                key = (path, start)
                whole = path.endswith(unsplit)
                if key not in states and not (whole and start == 0):
                    raise RuntimeError(f"{path} was split differently the second time, at {start}")
                cutter = _Cutter(None if whole else states[key], start, size)
            cutter.add(text)
            yield out()
        if cutter is not None:
            cutter.end()
            yield out()

    return run


def array_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, path, begun, part): the text of every document, and of the torn
    parts of those that cross ranges (``path`` is NULL for whole ones)."""
    text = spark.read.option("lineSep", "}").text(path)
    unsplit = _unsplit(text)
    kinds = "path string, start long, size long, read long, first string, flips boolean, end0 long, least0 long, end1 long, least1 long"
    split = text
    for ending in unsplit:
        split = split.where(~F.col("_metadata.file_name").endswith(ending))
    lines = [r.asDict() for r in _texts(split).mapInArrow(_summaries, kinds).collect()]  # one a range
    return _texts(text).mapInArrow(_cuts(compose(lines), unsplit), "value string, path string, begun long, part long")


def read_arrays(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    on_missing: str = "error",
    on_corrupt: str = "fail",
) -> tuple[DataFrame, str]:
    """The documents of files with one JSON array each, and the folder of their
    staged copy, which the caller removes when it is done with it.

    ``on_missing`` and ``on_corrupt`` as in
    :func:`tillroll.sources.documents.read_documents`, but each malformed
    document counts by itself.
    """
    if on_corrupt not in ("fail", "drop", "keep"):
        raise ValueError("on_corrupt must be one of ['drop', 'fail', 'keep']")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tillroll-stage/arrays-{uuid.uuid4().hex}"
    marked = StructType(schema.fields + [StructField(CORRUPT, StringType())])
    paths = [path] if isinstance(path, str) else list(path)
    if on_missing == "empty":
        paths = [p for p in paths if path_exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], marked if on_corrupt == "keep" else schema), folder

    def parsed(text):
        return F.from_json(text, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})

    whole = F.col("path").isNull()
    cut = array_documents(spark, paths)
    cut.select(F.when(whole, parsed(F.col("value"))).alias("doc"), "path", "begun", "part", F.when(~whole, F.col("value")).alias("value")).write.option("compression", "zstd").parquet(folder)
    staged = spark.read.parquet(folder)
    parts = F.array_sort(F.collect_list(F.struct("part", "value")))
    torn = staged.where(~whole).groupBy("path", "begun").agg(F.concat_ws("", F.transform(parts, lambda p: p["value"])).alias("value"))
    docs = staged.where(whole).select("doc").unionByName(torn.select(parsed(F.col("value")).alias("doc"))).select("doc.*")
    if on_corrupt == "keep":
        return docs, folder
    if on_corrupt == "drop":
        return docs.where(F.col(CORRUPT).isNull()).drop(CORRUPT), folder
    bad = docs.where(F.col(CORRUPT).isNotNull()).select(CORRUPT).first()
    if bad is not None:
        raise ValueError(f"malformed document: {bad[0][:200]}")
    return docs.drop(CORRUPT), folder
