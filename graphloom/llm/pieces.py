"""Operator 11: SentencePiece encoding and decoding of merge-type vocabularies.

A text is normalised (blank to U+2581, one in front), cut into characters, and
an agenda of adjacent symbol pairs, ordered by the merged piece's score and then
by place, merges the best pair until none is left in the vocabulary.  Characters
without a piece become their UTF-8 bytes.  Decoding joins the pieces again.

No merge crosses a blank mark's front or a line feed (both tested on the
vocabulary when it is loaded), so the agenda runs on the units between such
places, and a bounded table keeps the ids of units already met.  The agendas of
many short units are the rows of one array, each row's best pair merged at once;
a long unit has a heap.  A vocabulary without that property gets one agenda a text.

Every Arrow batch is held against the sentencepiece library: the units that the
batch adds to the table, or whole texts (``check="texts"``), are encoded by it
too, and all ids decoded by it.  ``library_agrees`` says of each row whether its
ids and its decoded text are the library's.

Defined results: a null text is empty and has no ids; texts of any length are
encoded whole; repeated rows are encoded alike; an empty table gives no rows;
null ids stay null; further columns are ignored.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.worker import only
from graphloom.session import ship_package

BLANK = "▁"
#: Units are kept in a table of about so many, of at most so many characters.
UNITS_KEPT, LONGEST_KEPT = 500_000, 48
#: Units up to this length share an array of agendas, so many at a time.
SHORT, ROWS = 40, 8192
#: Texts worked on at once: so many, or so many characters.
SLICE_ROWS, SLICE_CHARS = 500, 2_000_000

ENCODED = "doc_id long, ids array<int>, decoded string, library_agrees boolean"
_PLACE, _NEVER = (1 << 40) - 1, 1 << 62
_UNITS = re.compile(f"\n[^{BLANK}\n]*|{BLANK}+[^{BLANK}\n]*").findall

codecs.register_error("graphloom-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


class MergeVocabulary:
    """Pieces, ranks and ids of a merge-type SentencePiece model file.

    ValueError for what the agenda does not cover: another model type, a
    normaliser with character rules, user-defined or unused pieces, no bytes."""

    def __init__(self, path: str):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            raw = f.read()
        model = pb.ModelProto()
        model.ParseFromString(raw)
        kinds = pb.ModelProto.SentencePiece
        norm, spec = model.normalizer_spec, model.trainer_spec
        if spec.model_type != spec.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces \
                or not norm.escape_whitespaces or spec.treat_whitespace_as_suffix:
            raise ValueError("a merge-type vocabulary with the identity normaliser is needed")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.library = spm.SentencePieceProcessor(model_proto=raw)
        self.prefix = norm.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.bytes = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        if len(self.bytes) != 256:
            raise ValueError("byte pieces are needed")
        # equal scores share a rank: the agenda then goes by place
        order = {s: r for r, s in enumerate(sorted({p.score for p in model.pieces}, reverse=True))}
        self.ranks = {p.piece: order[p.score] << 40 for p in model.pieces if p.type == kinds.NORMAL and len(p.piece) > 1}
        self.surface = [self._surface(p, kinds, spec) for p in model.pieces]
        self.apart = self.prefix and not any(map(re.compile(f"[^{BLANK}]{BLANK}|\n").search, self.ranks))
        self.control = {i for i, p in enumerate(model.pieces) if p.type == kinds.CONTROL}
        self.wrong: set[str] = set()
        self._pairs()
        self.kept: dict[str, bytes] = {}

    @staticmethod
    def _surface(p, kinds, spec) -> bytes:
        if p.type == kinds.BYTE:
            return bytes([int(p.piece[3:-1], 16)])
        if p.type == kinds.UNKNOWN:
            return spec.unk_surface.encode()
        return b"" if p.type == kinds.CONTROL else p.piece.replace(BLANK, " ").encode()

    def _pairs(self) -> None:
        """The pairs that make a piece, as sorted keys with rank and result; a
        symbol is the id of its piece or, for a character without one, lies
        beyond all ids."""
        import numpy as np

        self.top = len(self.surface)
        symbol = lambda t: self.ids.get(t, self.top + ord(t) if len(t) == 1 else None)
        found = []
        for piece, rank in self.ranks.items():
            for k in range(1, len(piece)):
                x, y = symbol(piece[:k]), symbol(piece[k:])
                if x is not None and y is not None:
                    found.append((x << 32 | y, rank >> 40, self.ids[piece]))
        found.sort()
        self.keys, self.key_ranks, self.made = (np.array(c, np.int64) for c in zip(*found))
        self.chars = np.arange(0x110000, dtype=np.int64) + self.top
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i

    def _rank(self, x, y):
        """Rank and resulting symbol of pairs of symbols (no piece: _NEVER)."""
        import numpy as np

        key = x << 32 | y
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], _NEVER), self.made[at]

    def _merge_rows(self, units: list[str]) -> list[bytes]:
        """Ids of short units: one row of symbols and one of pair ranks each."""
        import numpy as np

        n, width = np.array(list(map(len, units))), max(map(len, units))
        inside = np.arange(width) < n[:, None]
        sym = np.full(inside.shape, -1, np.int64)
        sym[inside] = self.chars[np.frombuffer("".join(units).encode("utf-32-le"), "<u4")]
        ranks = np.full((len(units), width), _NEVER, np.int64)  # the last column stays without a pair
        both = inside[:, 1:]
        ranks[:, :-1][both] = self._rank(sym[:, :-1][both], sym[:, 1:][both])[0]
        cols, live = np.arange(width), np.arange(len(units))
        while len(live):
            best = ranks[live].argmin(1)  # of equal ranks the leftmost
            going = ranks[live, best] < _NEVER
            live, best = live[going], best[going]
            if not len(live):
                break
            made = self._rank(sym[live, best], sym[live, best + 1])[1]
            # what stands behind the pair moves up by one
            source = np.minimum(cols + (cols > best[:, None]), width - 1)
            s, r = np.take_along_axis(sym[live], source, 1), np.take_along_axis(ranks[live], source, 1)
            s[:, -1], r[:, -1] = -1, _NEVER
            at = np.arange(len(live))
            s[at, best] = made
            after = np.where(best + 1 < width, s[at, np.minimum(best + 1, width - 1)], -1)
            r[at, best] = np.where(after >= 0, self._rank(made, after)[0], _NEVER)
            some = np.flatnonzero(best > 0)
            r[some, best[some] - 1] = self._rank(s[some, best[some] - 1], made[some])[0]
            sym[live], ranks[live] = s, r
        used = sym >= 0
        ends = np.cumsum(used.sum(1)) * 4
        flat = sym[used].astype(np.int32).tobytes()
        out = [flat[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
        for i in np.flatnonzero((sym >= self.top).any(1)).tolist():  # characters without a piece
            ids = array("i")
            for x in sym[i][used[i]].tolist():
                ids.extend([x] if x < self.top else map(self.bytes.__getitem__, chr(x - self.top).encode()))
            out[i] = ids.tobytes()
        return out

    def merge(self, unit: str) -> list[str]:
        """The agenda of one unit of any length, as a heap: the pieces (or
        single characters) that it ends as."""
        rank, sym = self.ranks.get, list(unit)
        n = len(sym)
        agenda = []
        for i in range(n - 1):
            r = rank(sym[i] + sym[i + 1])
            if r is not None:
                agenda.append((r | i, i + 1, 2))
        heapify(agenda)
        # neighbours by place; a merged-away symbol is the empty string
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            key, right, size = heappop(agenda)
            left = key & _PLACE
            a, b = sym[left], sym[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one side has changed since
            sym[left], sym[right] = a + b, ""
            nxt = after[left] = after[right]
            if nxt < n:
                before[nxt] = left
                piece = a + b + sym[nxt]
                r = rank(piece)
                if r is not None:
                    heappush(agenda, (r | left, nxt, len(piece)))
            prev = before[left]
            if prev >= 0:
                piece = sym[prev] + a + b
                r = rank(piece)
                if r is not None:
                    heappush(agenda, (r | prev, left, len(piece)))
        return [s for s in sym if s]

    def _long(self, unit: str) -> bytes:
        out = array("i")
        for piece in self.merge(unit):
            i = self.ids.get(piece)
            out.extend(map(self.bytes.__getitem__, piece.encode()) if i is None else (i,))
        return out.tobytes()

    def _cut(self, text: str) -> list[str]:
        """Units: a line feed and what follows it, or what follows a blank mark
        (which is left out)."""
        if not self.apart:
            return [text]
        units = text.replace("\n", " \n").split(" ")
        if BLANK in text or "" in units:
            units = [u if u[0] == "\n" else u[1:] for u in _UNITS(BLANK + text.replace(" ", BLANK))]
        elif units[0][0] == "\n":
            units.insert(0, "")  # the blank mark in front stands alone
        return units

    def _spelt(self, unit: str) -> str:
        if not self.apart:
            return (BLANK if self.prefix else "") + unit.replace(" ", BLANK)
        return unit if unit[:1] == "\n" else BLANK + unit

    def _learn(self, units: list[str]) -> None:
        """Ids of new units into the table."""
        units.sort(key=len)
        short = [u for u in units if len(u) < SHORT]
        for k in range(0, len(short), ROWS):
            part = short[k:k + ROWS]
            self.kept.update(zip(part, self._merge_rows([self._spelt(u) for u in part])))
        for u in units[len(short):]:
            self.kept[u] = self._long(self._spelt(u))

    def _differing(self, units: list[str]) -> list[str]:
        """Units that the library encodes otherwise.  It puts its own blank mark
        in front: a unit without one follows a line feed, which stays apart."""
        skip = len(self.library.encode("\n")) - 1
        theirs = self.library.encode([u.replace(BLANK, " ") for u in units], num_threads=1)
        starts = [skip if self.apart and u[:1] == "\n" else 0 for u in units]
        return [u for u, t, k in zip(units, theirs, starts) if array("i", t[k:]).tobytes() != self.kept[u] and (u or not self.apart)]

    def encode(self, texts: list[str | None], check: bool = False) -> list[array]:
        """Ids of whole texts; ``check``: units met for the first time are held
        against the library (those that differ are kept in ``wrong``)."""
        cut = [self._cut(t) if t else [] for t in texts]
        kept = self.kept
        if len(kept) > UNITS_KEPT:
            kept.clear()
            self.wrong.clear()
        new = list(set().union(*cut).difference(kept))
        if new:
            self._learn(new)
            if check:
                self.wrong.update(self._differing(new))
        out = []
        for units in cut:
            ids = array("i")
            ids.frombytes(b"".join(map(kept.__getitem__, units)))
            out.append(ids)
        self.last_cut = cut if self.wrong else []
        for u in new:
            if len(u) > LONGEST_KEPT:
                del kept[u]
        return out

    def agreed(self, n: int) -> list[bool]:
        """Of the texts last encoded with ``check``: whether all units agreed."""
        return [not self.wrong.intersection(c) for c in self.last_cut] if self.wrong else [True] * n

    def decode(self, ids) -> str:
        """The text of ids: bytes that are no UTF-8 become U+FFFD one by one;
        a control piece has no text and ends a run of bytes."""
        if self.control.isdisjoint(ids):
            raw = b"".join(map(self.surface.__getitem__, ids))
            out = raw.decode("utf-8", "graphloom-each-byte")
        else:
            runs: list[list[bytes]] = [[]]
            for i in ids:
                runs.append([]) if i in self.control else runs[-1].append(self.surface[i])
            out = "".join(b"".join(r).decode("utf-8", "graphloom-each-byte") for r in runs)
        if self.prefix and out[:1] == " ":
            first = next(i for i in ids if self.surface[i])
            if first not in (self.bytes[32], self.library.unk_id()):  # a blank, but no blank mark
                out = out[1:]
        return out


_VOCABULARIES: dict[str, MergeVocabulary] = {}


def vocabulary(path: str) -> MergeVocabulary:
    """One vocabulary per Python worker and file."""
    only(f"pieces {path}", lambda: _VOCABULARIES.pop(path, None))
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = MergeVocabulary(path)
    return _VOCABULARIES[path]


def _slices(column) -> Iterator[tuple[int, list]]:
    """The texts of an Arrow column in bounded slices, with their first row."""
    first, rows, chars = 0, [], 0
    for text in column:
        rows.append(text.as_py())
        chars += len(rows[-1] or "")
        if len(rows) >= SLICE_ROWS or chars >= SLICE_CHARS:
            yield first, rows
            first, rows, chars = first + len(rows), [], 0
    if rows:
        yield first, rows


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     check: str = "units") -> DataFrame:
    """-> doc_id, ids, decoded (the ids' text), library_agrees, for every row."""
    if check not in ("units", "texts"):
        raise ValueError("check: units or texts")
    ship_package(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        v = vocabulary(model_path)
        whole = check == "texts" or not v.apart
        for b in batches:
            for first, texts in _slices(b.column(1)):
                ids = v.encode(texts, not whole)
                decoded = list(map(v.decode, ids))
                if whole:
                    theirs = v.library.encode([t or "" for t in texts], num_threads=1)
                    agrees = [array("i", t) == i for t, i in zip(theirs, ids)]
                else:
                    agrees = v.agreed(len(texts))
                again = v.library.decode([i.tolist() for i in ids], num_threads=1)
                agrees = [a and t == d for a, t, d in zip(agrees, again, decoded)]
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.frombuffer(b"".join(i.tobytes() for i in ids), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(texts)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                     pa.array(decoded, pa.string()), pa.array(agrees, pa.bool_())],
                    names=["doc_id", "ids", "decoded", "library_agrees"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, ENCODED)


def decode_ids(rows: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Rows with an array of ids -> the same rows with their text (null ids: null)."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        v = vocabulary(model_path)
        return ids.map(lambda i: None if i is None else v.decode([int(x) for x in i]))

    return rows.withColumn(out_col, text(F.col(ids_col)))
