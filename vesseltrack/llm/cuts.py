"""Places at which a text may be cut without changing its byte-level BPE tokens.

The pre-tokenizer pattern of byte-level BPE gives every piece at most one
blank, in front. So a blank between two visible characters always starts a
piece, no piece before it looks past the visible character on its left, and
merges never cross pieces: what stands left and right of such a *stable
boundary* is encoded independently. "Visible" is Unicode category L, M, N, P or
S: no white space, control or unassigned character of any Unicode version.

A *class border* is another place where a piece always starts: a piece without
its blank is letters only, numbers only, or neither. So a piece ends between a
letter and a number, and between either and a character that is neither and no
white space, unless an apostrophe is near, which may begin a piece of letters
('s). Only characters assigned long ago count, so that no library's tables
differ: letters and numbers of ASCII, Latin, Greek, Cyrillic, kana, Hangul and
the common ideographs, and the punctuation of ASCII, of the general block and of
the ideographs. Between two ideographs there is no border, but their punctuation
makes them.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache


@lru_cache(maxsize=4096)
def visible(c: str) -> bool:
    return unicodedata.category(c)[0] in "LMNPS"


def stable(text: str, p: int) -> bool:
    """Whether ``text`` may be cut before its character ``p``."""
    return 0 < p < len(text) - 1 and text[p] == " " and visible(text[p - 1]) and visible(text[p + 1])


_LETTERS = ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x24F), (0x391, 0x3A1), (0x3A3, 0x3CE), (0x410, 0x44F),
            (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3), (0xE01, 0xE30))
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~«»“”„…、。「」『』【】《》！，．：；？（）"


@lru_cache(maxsize=4096)
def letter_class(c: str) -> str:
    """L (letter), N (number) or P (neither, nor white space); nothing for what is not on the lists."""
    if "0" <= c <= "9":
        return "N"
    if c in _MARKS:
        return "P"
    return "L" if any(lo <= ord(c) <= hi for lo, hi in _LETTERS) else ""


def class_border(text: str, p: int) -> bool:
    """Whether a piece starts at character ``p`` because the characters around it are of two classes."""
    if not 0 < p < len(text):
        return False
    a, b = letter_class(text[p - 1]), letter_class(text[p])
    return a != "" and b != "" and a != b


def all_blanks_stable(text: str) -> bool:
    """Whether every blank of a text stands between visible characters (a quick test that may say no too often)."""
    return (" " != text[:1] and " " != text[-1:] and "  " not in text and "\n " not in text and " \n" not in text
            and text.replace("\n", "").isprintable())


def pieces(text: str) -> list[str]:
    """The text cut at its stable boundaries."""
    if not text:
        return []
    parts = text.split(" ")
    out = [parts[0]]
    for before, part in zip(parts, parts[1:]):
        if before and part and visible(before[-1]) and visible(part[0]):
            out.append(" " + part)
        else:
            out[-1] += " " + part
    return out if out[0] else out[1:]
