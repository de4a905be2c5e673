"""Line-first quality rules, in DataFrame functions only.

Every line that has a word is judged on its own:

* *punctuation*: the line has no sentence mark (``. ! ?`` and the like at the
  end of a word, the marks of other scripts anywhere), or symbol characters or
  doubled exclamation marks make up more than a tenth of it;
* *navigation*: the line has at least ``MIN_SEPARATORS`` menu separators
  standing alone between blanks;
* *boilerplate*: the line is short (at most ``MAX_BOILERPLATE_CHARS``) and has
  one of ``BOILERPLATE``.

Failing lines are removed. A document is rejected when the base rules fail
(fewer than 50 words, or over half of its words in repeated 3-word windows),
or when the lines that are left hold less than ``MIN_KEPT_SHARE`` of the
characters of its lines.

Defined results: a null or empty text has no words and is rejected; repeated
rows are judged each on their own; an empty table gives an empty result; other
columns are never read, so their names may clash with the results'. Scripts
that write no sentence mark at all (Thai, Lao) fail the punctuation rule, and so
does a Greek line whose only mark is the ``;`` of a question. Everything
happens within a row, without a shuffle, so a hot source or group of copies
makes no difference, and a long text costs ``n log n``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import SPACES, fresh, word_array

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_SHARE = 0.5
MAX_SYMBOL_SHARE = 0.1
MAX_SHOUT_SHARE = 0.1
MIN_SEPARATORS = 3
MAX_BOILERPLATE_CHARS = 200
#: Menu separators; they count where they stand between blanks.
SEPARATORS = "|\u00bb\u2022"
SYMBOLS = "#*$%&|<>"
#: Phrases of notices, menus and licences; matched in lower case.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "lorem ipsum",
    "powered by",
    "privacy policy",
    "released under the",
    "sign up for our newsletter",
    "terms of service",
    "terms of use",
)
#: Marks that also stand within words and numbers; they count at a word's end.
_WORD_END_MARKS = r".!?\x{2026}\x{FE52}\x{FF0E}"
#: The other sentence marks of Unicode (Sentence_Terminal, the Greek question
#: mark and the Tibetan shads); many of these scripts put no blank after them.
_OTHER_MARKS = "".join(
    rf"\x{{{first}}}" + (rf"-\x{{{last}}}" if last else "")
    for first, _, last in (
        x.partition("-")
        for x in (
            "37E 589 61D-61F 6D4 700-702 7F9 837 839 83D-83E 964-965 F0D-F12 104A-104B 1362 1367-1368 166E 1735-1736 "
            "17D4-17D5 1803 1809 1944-1945 1AA8-1AAB 1B5A-1B5B 1B5E-1B5F 1B7D-1B7E 1C3B-1C3C 1C7E-1C7F 203C-203D "
            "2047-2049 2CF9-2CFB 2E2E 2E3C 2E53-2E54 3002 A4FF A60E-A60F A6F3 A6F7 A876-A877 A8CE-A8CF A92F A9C8-A9C9 "
            "AA5D-AA5F AAF0-AAF1 ABEB FE12 FE15-FE16 FE56-FE57 FF01 FF1F FF61 10A56-10A57 10F55-10F59 10F86-10F89 "
            "11047-11048 110BE-110C1 11141-11143 111C5-111C6 111CD 111DE-111DF 11238-11239 1123B-1123C 112A9 "
            "1144B-1144C 115C2-115C3 115C9-115D7 11641-11642 1173C-1173E 11944 11946 11A42-11A43 11A9B-11A9C "
            "11C41-11C42 11EF7-11EF8 11F43-11F44 16A6E-16A6F 16AF5 16B37-16B38 16B44 16E98 1BC9F 1DA88"
        ).split()
    )
)
_CLOSERS = r"'\x22)\]\x{00BB}\x{201D}\x{2019}\x{3009}\x{300B}\x{300D}\x{300F}\x{3011}\x{FF09}"
#: The second is only tried on lines without the first; its range check comes
#: first, so Latin letters don't run through the whole list.
_SENTENCE_MARK = rf"[{_WORD_END_MARKS}][{_CLOSERS}]*([ \t-\r]|$)"
_OTHER_MARK = rf"[\x{{37E}}-\x{{1DA88}}&&[{_OTHER_MARKS}]]"


def _symbols(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _count(text: Column, part: str) -> Column:
    """Occurrences of a fixed string."""
    return (F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)


def line_passes(line: Column) -> Column:
    """Whether a line that has a word keeps its place."""

    def judged(chars: Column) -> Column:
        menu = sum((_count(line, f" {mark} ") for mark in SEPARATORS[1:]), _count(line, f" {SEPARATORS[0]} "))
        notice = (chars <= MAX_BOILERPLATE_CHARS) & F.lower(line).rlike("|".join(BOILERPLATE))
        return (
            (line.rlike(_SENTENCE_MARK) | line.rlike(_OTHER_MARK))
            & (menu < MIN_SEPARATORS)
            & (2 * _count(line, "!!") <= MAX_SHOUT_SHARE * chars)
            & (_symbols(line) <= MAX_SYMBOL_SHARE * chars)
            & ~notice
        )

    return _let(F.length(line), judged)


def _covered(hashes: Column) -> Column:
    """Words covered by the windows whose hash occurs twice or more.

    Sorting (hash, place) pairs brings equal windows together; the places of
    repeated windows, sorted again, cover three words each, less what the next
    one covers.
    """

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def places(pairs: Column) -> Column:
        marked = F.transform(
            pairs,
            lambda p, i: F.when(
                ((i > 0) & same(p, F.get(pairs, i - 1))) | same(p, F.get(pairs, i + 1)), p["i"]
            ),
        )
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def total(at: Column) -> Column:
        steps = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(pairs, lambda p: _let(places(p), total))


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array; windows
    are compared by a 64-bit hash of their words."""
    n = F.size(words)
    hashes = F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        1,
        F.greatest(n - 2, F.lit(0)),
    )
    # Most texts have no repeated window: a hash set settles them without a sort.
    counted = _let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)),
    )
    return F.when(n < 4, F.lit(0)).otherwise(counted).cast("long")


def _once(df: DataFrame, name: str, **fields: Column) -> DataFrame:
    """``df`` with a struct of the fields. It is made by a generator, whose row
    is computed once, whatever reads or filters it above."""
    one = F.explode(F.array(F.struct(*(c.alias(n) for n, c in fields.items()))))
    return df.select("*", one.alias(name))


def quality(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column of everything the rules measure.

    The struct's name is ``quality``, lengthened while ``docs`` has such a
    column; it is always the last column. Fields: n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, n_bad_lines,
    kept, cleaned (the text without its failed lines).
    """
    name = fresh(docs, "quality")
    step = [fresh(docs, f"_{name}{i}") for i in range(3)]
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.trim(F.translate(x, SPACES[1:], " "))) > 0)
    parts = _once(docs, step[0], text=text, words=word_array(text), lines=lines)
    text, words, lines = (F.col(step[0])[c] for c in ("text", "words", "lines"))
    counted = _once(
        parts,
        step[1],
        n_words=F.size(words).cast("long"),
        word_chars=F.length(F.array_join(words, "")).cast("long"),
        n_symbols=_symbols(text).cast("long"),
        n_dup_lines=(F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        n_repeat_words=_repeat_words(words),
        good=F.filter(lines, line_passes),
    )
    m = F.col(step[1])
    n_lines, n_good = F.size(lines), F.size(m["good"])
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    enough = F.length(F.array_join(m["good"], "")) >= MIN_KEPT_SHARE * F.length(F.array_join(lines, ""))
    judged = _once(
        counted,
        step[2],
        **{c: m[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")},
        base_failed=failed,
        n_lines=n_lines.cast("long"),
        n_bad_lines=(n_lines - n_good).cast("long"),
        kept=~failed & enough,
        cleaned=F.when(n_good == n_lines, text).otherwise(F.array_join(m["good"], "\n")),
    )
    return judged.select(*docs.columns, F.col(step[2]).alias(name))


def verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: its id, counts and verdict."""
    q = quality(docs)
    s = F.col(q.columns[-1])
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_bad_lines")
    return q.select("doc_id", *(s[f].alias(f) for f in fields))


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents, failed lines removed, in the columns of ``docs``."""
    q = quality(docs)
    s = F.col(q.columns[-1])
    renewed = {"text": s["cleaned"], "n_chars": F.length(s["cleaned"]).cast("long")}
    return q.where(s["kept"]).select(
        *(renewed[c].alias(c) if c in renewed else F.col(c) for c in docs.columns)
    )
