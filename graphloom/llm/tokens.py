"""Token ids of whole texts with the public tokenizers, quickly.

A tokenizer whose pre-tokenizer never joins characters across a word gap gives
the same ids for a text as for its gap-separated units one after another.  So
each unit is encoded once per Python worker and kept (a bounded table from unit
to its ids as bytes); a document's ids are those bytes joined.  Texts holding a
special token's string, or a control character on which the two regular
expression engines differ, are encoded whole.  ``tests/llm`` checks equality
with whole-text encoding.
"""

from __future__ import annotations

import os
import re
import struct
import sys
from array import array

from graphloom.llm.worker import only

#: White space other than the blank and the line feed; \x1c-\x1f are space to
#: Python's expressions only.
_OTHER, _ODD = re.compile(r"[^\S \n]"), re.compile("[\x1c-\x1f]")
_CUT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: A unit of letters, then ASCII marks without the apostrophe: every
#: pre-tokenizer here cuts it between the two and nowhere else, and no
#: normaliser but lower-casing changes it.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
#: Units of a generation that are kept (about 170 bytes each), and runs of marks.
UNITS_KEPT, MARKS_KEPT = 250_000, 10_000
LONGEST_KEPT = 64


def cut_words(text: str) -> list[bytes]:
    """For a tokenizer that drops white space: the words (a unit may hold other
    white space than ASCII's; the tokenizer sees it)."""
    return text.encode().split()


def cut_spaced(text: str) -> list[str]:
    """For byte-level BPE: a unit keeps the one blank before it.  The common
    case by plain splitting: a unit without its blank, the first one marked by
    \x00, one that starts a line by its line feed."""
    if not _OTHER.search(text):
        units = text.replace("\n", " \n").split(" ")
        if "" not in units and "\n" not in units:
            units[0] = "\x00" + units[0]
            return units
    return ["\x00" + u for u in _CUT.findall(text)]


def spelt(unit: str | bytes) -> str:
    """The text of a unit."""
    if isinstance(unit, bytes):
        return unit.decode()
    return unit[1:] if unit[0] == "\x00" else unit if unit[0] == "\n" else " " + unit


class _Chars(dict):
    """character -> the characters that stand for its bytes."""

    def __missing__(self, c: str) -> str:
        from tokenizers.pre_tokenizers import ByteLevel

        self[c] = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
        return self[c]


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids (bytes).  ``units``:
    "words" or "spaced", as above."""

    def __init__(self, path: str, units: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.spaced = units == "spaced"
        self.cut = cut_spaced if self.spaced else cut_words
        special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda text: None
        self.width = 2 if self.tok.get_vocab_size() <= 65536 else 4
        self.lower = "Lowercase" in str(self.tok.normalizer)
        self.model = self.tok.model
        self.chars = _Chars()
        self.marks: dict[str, bytes] = {}
        self.kept: dict[str | bytes, bytes] = {}
        self.older: dict[str | bytes, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(texts, add_special_tokens=False)
        if sys.byteorder == "little":
            return [array("I", e.ids).tobytes() for e in got]
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in got]

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token, by the tokenizer's model alone."""
        ids = [t.id for t in self.model.tokenize("".join(map(self.chars.__getitem__, piece)))]
        return array("I", ids).tobytes() if sys.byteorder == "little" else struct.pack(f"<{len(ids)}I", *ids)

    def core(self, text: str, blank: bool) -> bytes:
        """Ids of a run of letters, kept under the unit that it is by itself."""
        key = (text if blank else "\x00" + text) if self.spaced else text.encode()
        ids = self.kept.get(key) or self.older.get(key) or self.piece(" " + text if blank else text)
        self.kept[key] = ids
        return ids

    def mark(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            if len(self.marks) > MARKS_KEPT:
                self.marks.clear()
            ids = self.marks[marks] = self.piece(marks)
        return ids

    def unit(self, unit: str | bytes) -> bytes | None:
        """Ids of a plain unit; None where the whole tokenizer has to look."""
        first, text = unit[:1], unit
        if not self.spaced:
            text = unit.decode()
        elif first in "\x00\n":
            text = unit[1:]
        got = _PLAIN(text)
        if not got or len(text) > LONGEST_KEPT:
            return None
        core, marks = got.groups()
        ids = self.core(core.lower() if self.lower else core, self.spaced and first not in "\x00\n")
        if marks:
            ids += self.mark(marks)
        return self.mark("\n") + ids if first == "\n" else ids

    def encode(self, text: str | None) -> bytes:
        """Ids of one text; a null text is empty."""
        if not text:
            return b""
        if self.special(text) or self.spaced and (_ODD.search(text) or "\x00" in text):
            return self.whole([text])[0]
        units, kept = self.cut(text), self.kept
        new = set(units).difference(kept)
        if new:
            # two generations: a unit in use moves from the older to the newer one
            if len(kept) + len(new) > UNITS_KEPT:
                self.older, self.kept = kept, {}
                kept, new = self.kept, set(units)
            older = self.older
            kept.update([(u, older[u]) for u in new if u in older])
            new = list(new.difference(kept))
            rest = []
            for u in new:
                ids = self.unit(u)
                if ids is None:
                    rest.append(u)
                else:
                    kept[u] = ids
            kept.update(zip(rest, self.whole([spelt(u) for u in rest])))
        out = b"".join(map(kept.__getitem__, units))
        for u in new:
            if len(u) > LONGEST_KEPT:
                del kept[u]
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, units: str) -> Encoder:
    """One encoder per Python worker, file and way of cutting."""
    key = (path, units)
    only(f"tokens {key}", lambda: _ENCODERS.pop(key, None))
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, units)
    return _ENCODERS[key]
