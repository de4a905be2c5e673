"""Token ids of a byte-level BPE, through the tokenizers library.

The library cuts a text into pieces and encodes each by itself. Some places are
always between two pieces, whatever stands around them, so the stretches from
one such place to the next have the same ids wherever they stand:

- before a blank, if no white space follows it;
- between two ASCII characters of different kinds (letters, digits, marks, and
  behind one of these white space), but for an apostrophe before a letter;
- behind a line feed between two ASCII characters that aren't white space.

Each Python worker keeps the stretches it has met lately and their ids as
arrays, finds equal stretches by Arrow and asks the library for new ones only.
New stretches are asked for many at a time: the only token of a stretch with the
blank's byte is its first, so the ids fall apart where such tokens stand. Blanks
and letters below U+0250 are one piece and go to the library's merges directly.

That way is taken for files whose pieces are those of the byte-level pattern,
with no blank put in front and no normalisation; any other file goes through
the library whole. Long texts are taken in windows cut before white space.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tillroll.llm.hashing import batches
from tillroll.llm.wordbpe import ASKED, REMEMBERED, bytes_of, direct, kind, windows

#: Stretches (as Arrow's patterns) that are one piece, that begin a piece behind
#: any other, and that stand by themselves between line feeds.
_LETTERS = rf"\A [{kind('L')}]+\z"
_BEHIND_ANY = r"\A [^\s\v\x1c-\x1f\x{85}\p{Z}][^ ]*\z"
_BETWEEN_FEEDS = r"\A[!-~]+\z"
#: First bytes of Python's white space, which holds all of the library's, and
#: its longer characters as numbers of two and three bytes.
_SPACE = [c.encode() for c in map(chr, range(sys.maxunicode + 1)) if c.isspace()]
_SPACE_FIRST = np.isin(np.arange(256), [c[0] for c in _SPACE])
_SPACE_WIDE = [int.from_bytes(c) for c in _SPACE if len(c) > 1]
#: Kinds of ASCII bytes: letters 1, digits 2, marks 3, white space 4; control characters and others 0.
_LETTER, _WHITE = 1, 4
_KIND = np.array([1 if c.isalpha() else 2 if c.isdigit() else 4 if c in " \t\n\v\f\r" else 3 * c.isprintable() for c in map(chr, range(128))] + [0] * 128, np.uint8)
#: Stretches of ASCII letters merged in one go: a token of several would hold a blank behind a letter.
_ACROSS = re.compile("[A-Za-z]Ġ")
#: Texts are cut, and their ids put together, about this many bytes at a time.
CUT_BYTES = 1 << 21
#: Fixed value: how byte-level vocabularies write the blank.
BLANK = "Ġ"


class Lately:
    """The stretches used lately and their ids: number i has ``sizes[i]`` ids from ``ids[at[i]]``.

    A table of more than twice ``limit`` entries is cut to those used last, by lists of texts."""

    def __init__(self, limit: int = REMEMBERED):
        self.limit, self.lists = limit, 0
        self.numbers: dict[str, int] = {}  # in the order of the numbers
        self.ids, self.at, self.sizes, self.last = np.empty(0, "<u4"), *np.empty((3, 0), np.int64)

    def turn(self) -> None:
        """Keep the entries used last."""
        if len(self.last) <= 2 * self.limit:
            return
        kept = np.zeros(len(self.last), bool)
        kept[np.argsort(-self.last, kind="stable")[: self.limit]] = True
        self.numbers = {s: i for i, s in enumerate(itertools.compress(self.numbers, kept.tolist()))}
        self.sizes, self.last = self.sizes[kept], self.last[kept]
        place, ends = _runs(self.at[kept], self.sizes)
        self.ids, self.at = self.ids[place], ends[:-1]

    def found(self, stretches: pa.LargeStringArray, learn: Callable[[pa.LargeStringArray], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """The number of each stretch; ``learn`` gives ids, places in them and sizes of those that are not here."""
        self.turn()
        coded = stretches.dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.numbers.get, different, itertools.repeat(-1)), np.int64, len(different))
        missing = numbers < 0
        if missing.any():
            ids, at, sizes = learn(coded.dictionary.filter(pa.array(missing)))
            known = len(self.last)
            numbers[missing] = np.arange(known, known + len(at))
            self.numbers.update(zip(itertools.compress(different, missing.tolist()), itertools.count(known)))
            self.at, self.sizes = np.append(self.at, at + len(self.ids)), np.append(self.sizes, sizes)
            self.ids, self.last = np.append(self.ids, ids), np.append(self.last, np.zeros(len(at), np.int64))
        self.lists += 1
        self.last[numbers] = self.lists
        return numbers[coded.indices.to_numpy()]


def _some(stretches: list[str]) -> Iterator[list[str]]:
    return (stretches[at : at + ASKED] for at in range(0, len(stretches), ASKED))


def _flat(found: list[list[int]]) -> np.ndarray:
    return np.fromiter(itertools.chain.from_iterable(found), "<u4")


def _runs(at: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of runs of ``sizes`` from ``at``, one after another, and where each run begins (at last, their end)."""
    ends = np.concatenate([[0], np.cumsum(sizes)])
    place = np.repeat(at - ends[:-1], sizes)
    place += np.arange(ends[-1])
    return place, ends


def _starts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the stretches of texts begin that begin at ``begins`` of their bytes."""
    starts = np.zeros(len(data) + 4, bool)  # with the end's, and room to look ahead
    starts[begins] = True
    ahead = np.concatenate([data, np.zeros(4, np.uint8)])
    kinds = _KIND[data]
    here, then = kinds[:-1], kinds[1:]
    seen = (here - np.uint8(1)) < _WHITE - 1  # letters, digits and marks
    ends = (here != then) & seen & (then > 0)
    quote = np.flatnonzero(data[:-1] == ord("'"))
    ends[quote[then[quote] == _LETTER]] = False
    starts[1 : len(data)] |= ends
    feed = np.flatnonzero(data[1:-1] == ord("\n")) + 1
    starts[feed[seen[feed - 1] & (then[feed] > 0) & (then[feed] < _WHITE)] + 1] = True
    # A blank begins a stretch if no white space follows in the same text.
    blank = data[:-1] == ord(" ")
    blank &= ~starts[1 : len(data)]
    starts[: len(blank)] |= blank & (then > 0) & (then < _WHITE)
    at = np.flatnonzero(blank & (then == 0)) + 1
    a, b, c = (ahead[at + i].astype(np.int32) for i in range(3))
    doubtful = _SPACE_FIRST[a] & ((a < 0x80) | np.isin(a << 8 | b, _SPACE_WIDE) | np.isin(a << 16 | b << 8 | c, _SPACE_WIDE))
    starts[at[~doubtful] - 1] = True
    return np.flatnonzero(starts[: len(data)])


class Encoder:
    """The tokenizer of one file. Ids come as bytes, little-endian uint32."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        cut = rules["pre_tokenizer"] or {}
        self.by_stretch = (
            rules["normalizer"] is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
            and not rules["model"].get("ignore_merges")
        )
        vocabulary = self.library.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self.feed = self.library.encode("\n", add_special_tokens=False).ids
        self.stretches = Lately()
        self.merges, names = direct(self.library)
        self.names = {**names, ord(" "): f" {BLANK}"}
        self.at_once = None if any(map(_ACROSS.search, vocabulary)) else Tokenizer(self.library.model)

    def _asked(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _merged(self, texts: list[str]) -> list[list[int]]:
        out = []
        for ascii, some in itertools.groupby(texts, str.isascii):
            if ascii and self.at_once:
                merges, named = self.at_once, [t.replace(" ", BLANK) for t in some]
            else:
                merges, named = self.merges, [t.encode().decode("latin-1").translate(self.names) for t in some]
            out += [e.ids for e in merges.encode_batch_fast(named, add_special_tokens=False)]
        return out

    def _learn(self, new: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of new stretches, where each one's begin, and their number."""
        letters, behind, between = (pc.match_substring_regex(new, k).to_numpy(zero_copy_only=False) for k in (_LETTERS, _BEHIND_ANY, _BETWEEN_FEEDS))
        between &= len(self.feed) == 1
        at, sizes = np.zeros((2, len(new)), np.int64)
        ids, known = [], 0
        for many, ask in (
            (letters, self._begun(self._merged)), (behind & ~letters, self._begun(self._asked)),
            (between, self._fed), (~(letters | behind | between), self._alone),
        ):
            if many.any():
                own, first, size = ask(new.filter(pa.array(many)).to_numpy(zero_copy_only=False).tolist())
                at[many], sizes[many] = first + known, size
                ids.append(own)
                known += len(own)
        return np.concatenate(ids), at, sizes

    def _begun(self, ask: Callable[[list[str]], list[list[int]]]):
        """Asks for stretches with a blank first and nowhere else."""

        def begun(stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            ids = _flat(ask(["".join(some) for some in _some(stretches)]))
            first = np.flatnonzero(self.begins[ids])
            if len(first) != len(stretches):
                raise ValueError("the ids do not fall apart by stretches")
            return ids, first, np.diff(first, append=len(ids))

        return begun

    def _fed(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = _flat(self._asked(["\n".join([*some, ""]) for some in _some(stretches)]))
        ends = np.flatnonzero(ids == self.feed[0])
        if len(ends) != len(stretches):
            raise ValueError("the ids do not fall apart by stretches")
        first = np.append(0, ends[:-1] + 1)
        return ids, first, ends - first

    def _alone(self, stretches: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = self._asked(stretches)
        size = np.array([len(x) for x in found], np.int64)
        return _flat(found), np.cumsum(size) - size, size

    def _by_stretch(self, texts: list[str]) -> list[bytes]:
        data, begins = bytes_of(texts)
        parts = list(batches(np.diff(begins).tolist(), CUT_BYTES))
        cuts = [begins[first] + _starts(data[begins[first] : begins[last]], begins[first:last] - begins[first]) for first, last in parts]
        at = np.concatenate([*cuts, begins[-1:]])
        del cuts
        memory = self.stretches
        which = memory.found(pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)), self._learn)
        of_text, out = np.searchsorted(at, begins), []
        for first, last in parts:
            own = which[of_text[first] : of_text[last]]
            place, ends = _runs(memory.at[own], memory.sizes[own])
            raw = memory.ids[place].tobytes()
            out += [raw[a:b] for a, b in itertools.pairwise((4 * ends[of_text[first : last + 1] - of_text[first]]).tolist())]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the texts together should be a few megabytes."""
        if not self.by_stretch:
            return [np.array(ids, "<u4").tobytes() for ids in self._asked(texts)]
        parts = [list(windows(t)) for t in texts]
        if all(len(p) == 1 for p in parts):
            return self._by_stretch(texts)
        return [b"".join(self._by_stretch([w])[0] for w in p) for p in parts]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """Made once in each Python worker."""
    return Encoder(path)
