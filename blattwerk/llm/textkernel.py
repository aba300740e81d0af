"""Vectorised tokens of a whole Arrow batch of texts.

Scanned texts hold misread letters, so tokens are compared by their *glyph
skeleton*: letters that are mistaken for one another share a representative, and
letters that are mistaken for two (``m`` for ``rn``) are written as the two. All
steps run over the bytes of the whole batch at once; what remains per token is
one dictionary lookup.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import xxhash

# Glyphs that scanners confuse. First those that look like two
# letters, then the classes of single letters; the first of a class stands for it.
WIDE_GLYPHS = {"m": "rn", "d": "cl", "w": "vv"}
GLYPH_CLASSES = ("ce", "ft", "nuü", "lir1", "gq", "oaäö0", "bh8", "sß5", "vy")
#: Readings that the skeleton does not join; tried for forms that it leaves alone.
RARE_GLYPHS = (("h", "li"), ("ii", "ü"), ("b", "ß"), ("li", "h"))

#: Hyphens at the end of a line that part a word, and words after which a line-end hyphen stays.
HYPHENS = "-­¬‐"
CONJUNCTIONS = ("und", "oder", "bzw", "sowie", "noch", "als", "bis", "beziehungsweise", "and", "or")

# a number in skeleton letters: also with letters read for digits and with a trailing letter (12a)
_NUMBER = re.compile(rb"[lo]{0,2}[0-9][0-9lo]*[a-z]?")
_JOIN = re.compile(rf"[{HYPHENS}][ \t]*\n(?!(?:{'|'.join(CONJUNCTIONS)})\b)(?=[a-zäöüß])")

NUMBER, LINE, BLOCK = (np.int64(x) for x in (1, 2, 3))
_MARKS = {b";": int(LINE), b"!": int(BLOCK)}


def _table() -> bytes:
    t = bytearray(b" " * 128 + bytes(range(128, 256)))  # letters of other scripts stay as they are (see fold)
    for c in b"abcdefghijklmnopqrstuvwxyz0123456789;!":
        t[c] = c
    for group in GLYPH_CLASSES:
        for c in group:
            if c.isascii() and c.isalpha():
                t[ord(c)] = ord(group[0])
    return bytes(t)


_TABLE = _table()
_DIGITS = bytes.maketrans(b"1058", bytes(ord(next(g[0] for g in GLYPH_CLASSES if c in g)) for c in "1058"))
_UMLAUTS = tuple((c.encode(), group[0].encode()) for group in GLYPH_CLASSES for c in group if ord(c) > 127)
_WIDE = tuple((a.encode(), b.encode()) for a, b in WIDE_GLYPHS.items())
_ODD = re.compile(r"[^\x00-\x7fäöüß]")


class _Folded(dict):
    """Character beyond ASCII -> what it counts as: its base letter or digit, itself if it is a letter of another script, else a blank."""

    def __missing__(self, c: str) -> str:
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        if c.isalpha():
            out = plain if plain.isascii() and plain.isalpha() else c
        elif c.isdecimal():
            out = str(unicodedata.decimal(c))
        else:
            out = c if unicodedata.category(c)[0] == "M" else " "
        self[c] = out
        return out


_folded = _Folded()


def composed(text: str) -> str:
    """``text`` with letters and their marks as one character where there is one."""
    return text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)


def fold(text: str) -> str:
    """Lower-cased text without accents (German umlauts stay) and without symbols beyond ASCII."""
    if text.isascii():
        return text
    for c in set(_ODD.findall(text)):
        if (r := _folded[c]) != c:
            text = text.replace(c, r)
    return text


def skeleton_bytes(text: str) -> bytes:
    """Skeleton of lower-cased text: letters and digits (as they are), the marks ``;!``, all else blank."""
    b = fold(text).encode("utf-8", "replace")
    for a, r in _UMLAUTS:
        b = b.replace(a, r)
    for a, r in _WIDE:
        b = b.replace(a, r)
    return b.translate(_TABLE)


def skeleton(word: str) -> str:
    """Glyph skeleton of one word."""
    return skeleton_bytes(word.lower()).translate(_DIGITS, b" ").decode()


class _Hashes(dict):
    """Token -> 63-bit hash; single letters are 0, numbers and the marks have codes of their own."""

    def __missing__(self, token: bytes) -> int:
        if token in _MARKS:
            h = _MARKS[token]
        elif _NUMBER.fullmatch(token):
            h = int(NUMBER)
        else:
            h = 0 if len(token) < 2 else (xxhash.xxh3_64_intdigest(token.translate(_DIGITS)) >> 1) | 4
        if len(self) > 200_000:  # keeps a worker's memory bounded
            self.clear()
        self[token] = h
        return h


_WIDE_LETTERS = tuple(WIDE_GLYPHS)
_hashes = _Hashes()


def word_hash(word: str) -> int:
    """The hash that ``tokens`` gives for a word."""
    return _hashes[skeleton_bytes(word.lower()).strip()]


@dataclass
class Tokens:
    """Tokens of a batch: ``h`` without marks and single letters, with the line and block of each.

    ``line_block`` has the block of each line, ``line_letters`` the number of single letters in it, ``goes_on``
    whether it is a part of a long line whose rest follows.
    """

    h: np.ndarray
    line: np.ndarray
    block: np.ndarray
    n_lines: int
    n_blocks: int
    line_block: np.ndarray
    line_letters: np.ndarray
    goes_on: np.ndarray
    text: str


def prepare(texts: list[str], join_hyphens: bool, drop: re.Pattern | None = None, long_line: int = 0) -> str:
    """``texts`` in lower case, parted by NUL; ``join_hyphens`` puts words together that are parted at line ends,
    ``drop`` (a pattern over lower-cased text, within lines, that has a bracket) is left out first. With ``long_line`` lines
    that are longer are parted (by ``\\x01``) at the first blank after each so many characters, wherever the text is cut later."""
    texts = [t.replace("\x00", " ").replace("\x01", " ") if "\x00" in t or "\x01" in t else t for t in texts]
    if drop is not None:
        texts = [drop.sub("", t.lower()) if "[" in t else t for t in texts]
    s = composed("\x00".join(texts).lower())
    if join_hyphens:
        s = _JOIN.sub("", s)
    if long_line and max(map(len, texts), default=0) > long_line:
        s = "\x00".join("\n".join(_parted(x, long_line) for x in t.split("\n")) if len(t) > long_line else t for t in s.split("\x00"))
    return s


def _parted(line: str, size: int) -> str:
    out, at = [], 0
    while len(line) - at > size:
        cut = line.find(" ", at + size)
        if cut < 0 or not line[cut:].strip():
            break
        out.append(line[at:cut])
        at = cut + 1
    return "\x01".join([*out, line[at:]])


def tokens(texts: list[str], join_hyphens: bool, drop: re.Pattern | None = None, long_line: int = 0) -> Tokens:
    """Tokens of ``texts`` (see :func:`prepare`)."""
    return tokenised(prepare(texts, join_hyphens, drop, long_line), len(texts))


def tokenised(text: str, n_blocks: int) -> Tokens:
    """Tokens of prepared text, whose lines ``line`` counts."""
    s = text.replace(";", " ").replace("!", " ").replace("\x01", "\n")
    s = f" {s} ".replace("\n", " ; ").replace("\x00", " ! ")
    for c in _WIDE_LETTERS * 2:  # a letter on its own is not what looks like it (rn); twice, for blanks that two share
        s = s.replace(f" {c} ", " x ")
    toks = skeleton_bytes(s).split()
    a = np.fromiter(map(_hashes.__getitem__, toks), dtype=np.int64, count=len(toks))
    new_block = a == BLOCK
    new_line = (a == LINE) | new_block
    line_of = np.cumsum(new_line)
    block_of = np.cumsum(new_block)
    n_lines = int(new_line.sum()) + 1
    line_block = np.zeros(n_lines, np.int64)
    line_block[1:] = block_of[new_line]
    letters = np.bincount(line_of[a == 0], minlength=n_lines)
    goes_on = np.zeros(n_lines, bool)
    if "\x01" in text:
        buf = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        goes_on[: n_lines - 1] = buf[(buf == 10) | (buf <= 1)] == 1
    keep = (a != 0) & ~new_line
    return Tokens(a[keep], line_of[keep], block_of[keep], n_lines, n_blocks, line_block, letters, goes_on, text)


def segment_sum(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=n)[:n]


def line_keys(t: Tokens) -> np.ndarray:
    """Per line a hash of its words in order; numbers count as equal, single letters not at all."""
    size = np.bincount(t.line, minlength=t.n_lines)[: t.n_lines]
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    key = np.zeros(t.n_lines, np.int64)
    if len(t.h):
        place = 2 * (np.arange(len(t.h)) - start[t.line]) + 1
        with np.errstate(over="ignore"):
            mixed = (t.h ^ (t.h >> 31)) * (place * np.int64(0x2127599BF4325C37))
            total = np.cumsum(mixed ^ (mixed >> 29))
            end = np.cumsum(size)
            some = size > 0
            key[some] = total[end[some] - 1] - np.where(start[some] > 0, total[start[some] - 1], 0)
    return key


def slices(texts: list[str], most: int = 1_000_000):
    """(first, end) ranges of ``texts`` of about ``most`` characters, so that memory stays bounded."""
    first = size = 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= most:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def line_starts(t: Tokens) -> np.ndarray:
    """Index of the first line of each text."""
    return np.searchsorted(t.line_block, np.arange(t.n_blocks))
