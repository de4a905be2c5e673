"""Byte-level BPE by a local rank file: encoding, raw-byte decoding, digests.

Texts go through the tiktoken library inside Arrow batches, one text at a
time, so a batch needs memory for its longest text and no more. A long text is
first cut at *safe boundaries*: a place between a non-space and a white-space
character. Every alternative of the split pattern that takes in a non-space
ends before white space, and none looks back, so each match of the pattern
lies on one side of the cut and the ids of the pieces, put together, are the
ids of the text. A run without white space stays whole. A long run of white
space is one match but for its last character, which belongs to the word behind
it, if there is one: it goes to the byte-pair merge as it is, since the library's
pattern matcher takes a stack frame for each of its characters.

Defined results: a null text counts as empty and has no ids; repeated rows are
encoded each on their own; an empty table gives an empty result; only ``doc_id``
(any value, null too) and ``text`` are read. There is no shuffle.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import tidy

#: Texts above this many characters are cut at safe boundaries.
PIECE_CHARS = 1 << 16
#: White space of both Python and the pattern's library, behind a character that is none for either.
_SAFE = re.compile(r"(?<=\S)(?=[ \t-\r])")
#: A long run of what the library calls white space (U+001C to U+001F are that to Python alone).
_LONG_SPACE = re.compile(r"[^\S\x1c-\x1f]{%d,}" % PIECE_CHARS)


def default_ranks() -> str:
    """The rank file of the 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.lru_cache(maxsize=4)
def encoder(rank_file: str):
    """The encoder of a rank file, made once in each Python worker."""
    import public_tokenizers
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` cut at safe boundaries into pieces of ``size`` characters or,
    where no boundary follows in time, more."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(enc, text: str | None) -> np.ndarray:
    """The ids of one text as unsigned 32-bit integers."""
    if not text:
        return np.empty(0, np.uint32)
    if len(text) <= PIECE_CHARS:
        return np.array(enc.encode_ordinary(text), np.uint32)
    out, at = [], 0
    for run in _LONG_SPACE.finditer(text):
        end = run.end() - (run.end() < len(text))
        out += [enc.encode_ordinary(p) for p in pieces(text[at : run.start()])]
        out.append(enc._encode_single_piece(text[run.start() : end]))
        at = end
    out += [enc.encode_ordinary(p) for p in pieces(text[at:])]
    return np.concatenate([np.array(ids, np.uint32) for ids in out])


def decode(enc, ids: np.ndarray) -> bytes:
    return enc.decode_bytes(ids.tolist())


def encoded(docs: DataFrame, rank_file: str | None = None) -> DataFrame:
    """``doc_id`` and the ids of its text as little-endian bytes (uint32)."""
    path = rank_file or default_ranks()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids = [encode(enc, t).astype("<u4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decoded(tokens: DataFrame, rank_file: str | None = None) -> DataFrame:
    """``doc_id`` and the raw bytes its ``ids`` stand for."""
    path = rank_file or default_ranks()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            raw = [decode(enc, np.frombuffer(x or b"", "<u4")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {tokens.schema['doc_id'].dataType.simpleString()}, bytes binary")


def digests(docs: DataFrame, rank_file: str | None = None) -> DataFrame:
    """Encode every text, decode its ids, and give the digests of both.

    One pass over the rows: the ids of a text are decoded where they were made.
    """
    path = rank_file or default_ranks()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            n, ids_hash, raw_hash = [], [], []
            for text in batch.column(1):
                ids = encode(enc, text.as_py())
                n.append(len(ids))
                ids_hash.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                raw_hash.append(hashlib.sha256(decode(enc, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash), pa.array(raw_hash)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
