"""Token ids of a BPE with word ends, through the tokenizers library.

The library splits a text into words and encodes each by itself, so a word has
the same ids wherever it stands. Each Python worker keeps the ids of words, and
of whole stretches between white space, that it has met lately, and asks the
library for new ones only; most stretches of a corpus come again and again.
Texts are cut as arrays of bytes and equal stretches found by Arrow, so Python
handles each different stretch of a list of texts once (``looked_up``). New words
go to the library's merges without its pattern, which would find the same words
in them (``direct``).

That way is taken for texts of letters below U+0250, where Python's classes of
letters, numbers and white space, its lower case and NFC are those of the
library (a test goes through all of them). Any other text, and any tokenizer
file with other rules, goes through the library whole. Texts of more than
``WINDOW`` characters are taken in stretches cut before white space, which
never lies within a word; a stretch without white space stays whole.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20
#: Texts of about this many characters are looked up together.
TOGETHER = 1 << 22
#: Entries of each generation of remembered stretches and words.
REMEMBERED = 200_000
#: New words in one call's text.
ASKED = 100

#: The rules of a tokenizer file that the short way stands for.
WORD_END = "</w>"
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]

#: Some lower cases lie elsewhere or are longer; U+001C to U+001F are white space to Python alone.
PLAIN = [c for c in map(chr, range(0x250)) if len(c.lower()) == 1 and c.lower() < "\u0250" and not "\x1c" <= c <= "\x1f"]
_SPACE = [c for c in PLAIN if c.isspace()]


def direct(library):
    """A tokenizer with the model of ``library`` that takes words between blanks
    as they are, and the names it has for the bytes of characters below U+0250."""
    from tokenizers import Tokenizer, pre_tokenizers

    named = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    names = {b: name for c in map(chr, range(0x250)) for b, name in zip(c.encode(), named.pre_tokenize_str(c)[0][0])}
    merges = Tokenizer(library.model)
    merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
    return merges, names


def _ranges(chars: Iterable[str]) -> str:
    """The inside of a character class."""
    points = sorted(map(ord, chars))
    starts = [p for i, p in enumerate(points) if i == 0 or points[i - 1] != p - 1]
    ends = [p for i, p in enumerate(points) if i + 1 == len(points) or points[i + 1] != p + 1]
    return "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(starts, ends))


def kind(letter: str) -> str:
    return _ranges(c for c in PLAIN if unicodedata.category(c)[0] == letter)


WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{kind('L')}]+|[{kind('N')}]|[^{_ranges(_SPACE)}{kind('L')}{kind('N')}]+")
_OTHER = re.compile(f"[^{_ranges(PLAIN)}]")
#: White space among PLAIN: bytes by themselves, and second bytes behind U+0080's first byte.
_BLANKS = np.isin(np.arange(256), [ord(c) for c in _SPACE if c < "\x80"])
_WIDE_FIRST = 0xC2
_WIDE_BLANKS = np.isin(np.arange(256), [c.encode()[1] for c in _SPACE if c >= "\x80"])
_BEFORE_SPACE = re.compile(r"(?<=[^ \t\r\n])(?=[ \t\r\n])")


class Lately(dict):
    """The entries used lately: a full table becomes the older generation, from
    which entries come back when they are used again."""

    def __init__(self, limit: int = REMEMBERED):
        super().__init__()
        self.limit, self.older = limit, {}

    def turn(self) -> None:
        """Make a full table the older generation."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()

    def found(self, keys: list[str], learn: Callable[[list[str]], None]) -> list[bytes]:
        """The values of ``keys``, which differ; ``learn`` enters those of keys that are not here."""
        self.turn()
        values = list(map(self.get, keys))
        missing = [i for i, v in enumerate(values) if v is None]
        if not missing:
            return values
        wanted = [keys[i] for i in missing]
        if self.older:
            back = list(map(self.older.get, wanted))
            self.update((k, v) for k, v in zip(wanted, back) if v is not None)
            new = [k for k, v in zip(wanted, back) if v is None]
        else:
            new = wanted
        if new:
            learn(new)
        for i, key in zip(missing, wanted):
            values[i] = self[key]
        return values


def bytes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and where each begins (at last, their end)."""
    _, offsets, data = pa.array(texts, pa.large_string()).buffers()
    begins = np.frombuffer(offsets, np.int64, len(texts) + 1)
    return np.frombuffer(data or b"", np.uint8)[: begins[-1]], begins


def looked_up(memory: Lately, learn: Callable[[list[str]], None], data: np.ndarray, cuts: np.ndarray, texts: np.ndarray) -> list[bytes]:
    """The ids of each text, put together from those of its stretches.

    Stretch i lies in ``data`` from ``cuts[i]`` to ``cuts[i + 1]``, text i holds
    the stretches from ``texts[i]`` to ``texts[i + 1]``. ``learn`` puts the ids of
    stretches that are not in ``memory`` there.
    """
    n = len(cuts) - 1
    if n < 1:
        return [b""] * (len(texts) - 1)
    stretches = pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(cuts, np.int64)), pa.py_buffer(data)).dictionary_encode()
    different, which = stretches.dictionary.to_numpy(zero_copy_only=False).tolist(), stretches.indices.to_numpy()
    found = memory.found(different, learn)
    table = np.frombuffer(b"".join(found), "<u4")
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    size = sizes[which]
    ends = np.concatenate([[0], np.cumsum(size)])
    kind = np.int32 if ends[-1] < 1 << 31 else np.int64
    place = np.repeat(((np.cumsum(sizes) - sizes)[which] - ends[:-1]).astype(kind), size)
    place += np.arange(ends[-1], dtype=kind)
    raw = table[place].tobytes()
    places = (4 * ends[texts]).tolist()
    return [raw[a:b] for a, b in itertools.pairwise(places)]


def windows(text: str, size: int = WINDOW) -> Iterator[str]:
    """``text`` in stretches of ``size`` characters or, where no white space follows, more."""
    at = 0
    while len(text) - at > size:
        cut = _BEFORE_SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


class Encoder:
    """The tokenizer of one file. Ids come as bytes, little-endian uint32."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        parts = (rules["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.by_word = (
            [n["type"] for n in (rules["normalizer"] or {}).get("normalizers", [])] == NORMALIZERS
            and parts[0].get("pattern", {}).get("Regex") == SPLIT
            and rules["model"].get("end_of_word_suffix") == WORD_END
            and [(p["type"], p.get("add_prefix_space", True), p.get("use_regex", True)) for p in parts[1:]] == [("ByteLevel", False, False)]
        )
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.stretches, self.words = Lately(), Lately()
        self.merges, names = direct(self.library)
        self.names = {**names, ord(" "): " "}

    def whole(self, text: str) -> bytes:
        return b"".join(np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch_fast(list(windows(text)), add_special_tokens=False))

    def _learn_words(self, new: list[str]) -> None:
        texts = [" ".join(new[at : at + ASKED]).encode().decode("latin-1").translate(self.names) for at in range(0, len(new), ASKED)]
        found = self.merges.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in found), "<u4")
        ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
        raw = ids.tobytes()
        firsts = [0, *ends[:-1].tolist()]
        self.words.update(zip(new, map(raw.__getitem__, map(slice, firsts, ends.tolist())), strict=True))

    def _learn(self, stretches: list[str]) -> None:
        single = list(filter(str.isalpha, stretches))  # one word each
        mixed = list(itertools.filterfalse(str.isalpha, stretches))
        words = list(map(WORDS.findall, mixed))
        different = list(set(single).union(itertools.chain.from_iterable(words)))
        known = dict(zip(different, self.words.found(different, self._learn_words))).__getitem__
        self.stretches.update(zip(single, map(known, single)))
        self.stretches.update((stretch, b"".join(map(known, own))) for stretch, own in zip(mixed, words))

    def _by_word(self, texts: list[str]) -> list[bytes]:
        data, begins = bytes_of([t.lower() for t in texts])
        blank = _BLANKS[data]
        wide = np.flatnonzero(data[:-1] == _WIDE_FIRST)
        wide = wide[_WIDE_BLANKS[data[wide + 1]]]
        blank[wide] = blank[wide + 1] = True
        # A stretch begins at a text's first byte and behind white space.
        first = np.empty(len(data) + 1, bool)
        first[0], first[1:] = True, blank
        first[begins] = True
        first = first[:-1] & ~blank
        stays = np.concatenate([[0], np.cumsum(~blank)])  # bytes that are left before each
        at = np.flatnonzero(first)
        cuts = np.append(stays[at], stays[-1])
        return looked_up(self.stretches, self._learn, data[~blank], cuts, np.searchsorted(at, begins))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the texts together should be about ``TOGETHER`` characters."""
        if not self.by_word:
            return [self.whole(t) for t in texts]
        out = [b""] * len(texts)
        plain = [i for i, t in enumerate(texts) if not _OTHER.search(t)]
        short = [i for i in plain if len(texts[i]) <= WINDOW]
        for i, ids in zip(short, self._by_word([texts[i] for i in short])):
            out[i] = ids
        for i in set(plain).difference(short):
            out[i] = b"".join(self._by_word([part])[0] for part in windows(texts[i]))
        for i in set(range(len(texts))).difference(plain):
            out[i] = self.whole(texts[i])
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """Made once in each Python worker."""
    return Encoder(path)
