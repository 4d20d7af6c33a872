"""Operator 5: secrets, with a guess-cost dynamic programme for values that
stand in a credential context.

Base patterns find assignments, access keys and long hex strings.  The method
looks at every other value that a credential word introduces ("pwd: ...",
"user_auth=...", "Kennwort: ...", "mot de passe est ..."), that follow "Bearer"
or stand as a URL's password, whole, up to a space or the closing quote,
however long: the cheapest way to segment the value into known words, dates,
repeats, keyboard walks and brute-force stretches is its guess cost (log10 of
the number of guesses), and a value that takes ``HARD`` or more is reported as
kind ``guess``.  Known words are all words of 3 to ``LONGEST_WORD`` letters, in
any script, ranked by their count over the whole corpus outside such values (a
secret is not known by having been given away); a placeholder such as
"password: changeme" is cheap, a random one is not.

Most values are decided without the words: too cheap by themselves, or too dear
even if every run of letters were the most frequent word.  Only the others
travel: their runs of letters are joined with the ranked words.

Defined results: a null text is empty; an empty or clean text has no spans; base
spans are never removed; repeated rows give repeated results; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import lookup
from graphloom.llm.spans import digest, joined, ordered
from graphloom.operators.ranking import global_rank
from graphloom.session import ship_package, stored

KINDS = ("assign", "access", "hex", "guess")
#: Log10 guesses from which a value is reported.
HARD = 8.0

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
# a run too short holds no longer match, so the least length can stand in the pattern
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Words that introduce a credential (English, German, French, Spanish), then how a value follows.
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "key", "credential", "login", "auth", "pin", "kennwort", "zugang", "schl", "mot", "mdp", "jeton",
                 "contrase", "clave", "secreto")
_INTRODUCES = (r"(?:pass(?:[ _-]?word|wd|phrase|code|wort)?|pwd|secret|token|(?:api|access|private|secret)[_ -]?key|credentials?|login|auth|pin"
               r"|kennwort|zugangs(?:code|daten|schl\u00fcssel)|geheim(?:nis|wort)|schl\u00fcssel|mot[ _-]de[ _-]passe|mdp|jeton|cl[e\u00e9] (?:secr[e\u00e8]te|priv[e\u00e9]e)"
               r"|contrase(?:\u00f1|n)a|clave|secreto)")
CONTEXT = re.compile(
    rf"""(?i:(?<![^\W_]){_INTRODUCES})"""
    # a quoted value ends at its own quote, another one at any quote or markup; <...> is a blank to fill in
    r"""["']?\x20*(?:[:=]>?|->|\x20(?:is|ist|est|es)\x20)\x20*(?:"(?!<)([^\s"]{4,})|'(?!<)([^\s']{4,})|([^\s"'<>]{4,}))""")
#: Schemes of an authorization header, and the password of a URL.
SCHEMES = re.compile(r"(?i:(?<![^\W_])(?:bearer|basic|digest|authorization:\x20*token))\x20+([A-Za-z0-9+/_.~=-]{4,})")
URL_PASSWORD = re.compile(r"://[^\s/@:?#\"'<>]*:([^\s/@?#\"'<>]{4,})@")

ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
WALKS = "\n".join(ROWS + tuple(r[::-1] for r in ROWS))
YEAR = re.compile(r"(?:19|20)\d\d$")
DATE = re.compile(r"(?:\d{1,2}([-/._]?)\d{1,2}\1(?:19|20)\d\d|(?:19|20)\d\d([-/._]?)\d{1,2}\2\d{1,2})$")
LONGEST_WORD = 24
NOT_LETTERS = r"[^\p{L}\p{M}]+"
#: The longest segment but for repeats.
REACH = 26


def base_spans(text: str) -> list[tuple[str, int, int]]:
    low = text.lower()
    out = []
    if any(k in low for k in ("passw", "secret", "token", "api")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def alphabet(value: str) -> int:
    """Size of the character classes a brute-force search would try."""
    return max(10, 26 * bool(re.search("[a-z]", value)) + 26 * bool(re.search("[A-Z]", value))
               + 10 * bool(re.search("[0-9]", value)) + 33 * bool(re.search(r"[!-/:-@\[-`{-~]", value))
               + 100 * (not value.isascii()))


def is_letter(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c)[0] == "M"


class AnyWord:
    """Ranks by which every run of letters is the most frequent word: a cost by
    these is never above the true one."""

    def get(self, word: str) -> int | None:
        return 1 if len(word) >= 3 and all(map(is_letter, word)) else None


def word_cost(word: str, ranks: dict[str, int] | AnyWord) -> float | None:
    low = word.lower()
    rank = ranks.get(low)
    if rank is None:
        return None
    upper = sum(c.isupper() for c in word)
    cases = 1 if not upper else 2 if upper == len(word) or word[0].isupper() and upper == 1 else math.comb(len(word), min(upper, len(word) - upper)) + 1
    return math.log10(rank) + math.log10(cases)


def _repeat_end(c1: float, i1: int, c2: float, i2: int, unit: int) -> float:
    """Up to which end a repeat begun at ``i2`` for ``c2`` is cheaper than one
    begun before it, at ``i1`` for ``c1``: the logarithm of the number of times
    levels out, so the earlier one wins from some end on if it starts cheaper."""
    if c2 <= c1:
        return math.inf
    more = 10 ** min(c2 - c1, 300.0) - 1
    return i2 + (i2 - i1) / more if more else math.inf


def prefix_costs(value: str, ranks: dict[str, int] | AnyWord, hard: float = math.inf) -> list[float]:
    """Guess cost of each prefix of ``value``.  Only costs under ``hard`` matter:
    the rest stays infinite once no prefix within a segment's reach is under it
    (a repeat may be longer, but each of its times is a prefix of its own)."""
    n, per_char = len(value), math.log10(alphabet(value))
    low = value.lower()
    best = [0.0] + [math.inf] * n
    last = 0  # the last prefix under hard
    runs: dict[tuple[int, int], list] = {}  # (unit, end modulo unit) -> [first start, cost of the unit, starts worth keeping]
    for i in range(n + 1):
        for unit in range(1, min(8, i // 2) + 1):  # repeats that end here, by the cheapest start
            block, key = value[i - unit:i], (unit, i % unit)
            if not value.startswith(block, i - 2 * unit):
                runs.pop(key, None)
                continue
            run = runs.get(key)
            if run is None:
                cost = word_cost(block, ranks)
                run = runs[key] = [i - 2 * unit, unit * per_char if cost is None else cost, []]
            first, cost, starts = run
            new = i - (3 if unit == 1 else 2) * unit
            if new >= first and best[new] < hard:
                c = best[new] + (math.log10(2) if new else 0) + cost
                # a start that is beaten by the one below it before the new one is beaten by it, is never the cheapest
                while len(starts) > 1 and _repeat_end(*starts[-2], *starts[-1], unit) <= _repeat_end(*starts[-1], c, new, unit):
                    starts.pop()
                starts.append((c, new))
            while len(starts) > 1 and _repeat_end(*starts[-2], *starts[-1], unit) <= i:
                starts.pop()
            if starts:
                best[i] = min(best[i], starts[-1][0] + math.log10((i - starts[-1][1]) // unit))
        if best[i] < hard:
            last = i
        elif i - last > REACH:
            break
        if i == n or best[i] >= hard:
            continue
        start = best[i] + (math.log10(2) if i else 0)  # one more segment

        def reach(j: int, cost: float, start=start) -> None:
            best[j] = min(best[j], start + cost)

        # brute force: extending a stretch costs its characters, so one at a time will do
        best[i + 1] = min(best[i + 1], best[i] + per_char)
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            cost = word_cost(value[i:j], ranks)
            if cost is not None:
                reach(j, cost)
        for j in range(i + 3, min(n, i + REACH) + 1):  # a walk along keys or letters
            if low[i:j] not in WALKS:
                break
            reach(j, math.log10(len(WALKS) * (j - i)))
        for j in range(i + 4, min(n, i + 10) + 1):
            if j - i == 4 and YEAR.match(value[i:j]):
                reach(j, math.log10(120))
            elif DATE.match(value[i:j]):
                reach(j, math.log10(365 * 120) + (math.log10(4) if not value[i:j].isdigit() else 0))
    return best


def guess_cost(value: str, ranks: dict[str, int] | AnyWord, hard: float = math.inf) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes;
    from ``hard`` on only that it is not less."""
    return prefix_costs(value, ranks, hard)[-1]


def context_values(text: str) -> Iterator[tuple[int, int]]:
    """Values that a credential word introduces, that follow the scheme of an
    authorization header, or stand as the password in a URL; each once, in order."""
    low, out = text.lower(), set()
    if any(k in low for k in CONTEXT_WORDS):
        out.update(m.span(m.lastindex) for m in CONTEXT.finditer(text))
    if any(k in low for k in ("bearer", "basic", "digest", "authorization")):
        out.update(m.span(1) for m in SCHEMES.finditer(text))
    if "@" in text and "://" in text:
        out.update(m.span(1) for m in URL_PASSWORD.finditer(text))
    reach = -1
    for s, e in sorted(out):
        e = s + len(text[s:e].rstrip(".,;:!?)]}"))
        if e - s >= 4 and e > reach:  # not inside a value before it
            yield s, e
            reach = e


class Within:
    """Base spans, for asking whether one of them holds a span."""

    def __init__(self, base: list):
        spans = sorted((s, e) for _, s, e in base)
        self.starts, self.reach = [s for s, _ in spans], list(accumulate((e for _, e in spans), max))

    def __contains__(self, span: tuple[int, int]) -> bool:
        at = bisect_right(self.starts, span[0])
        return at > 0 and self.reach[at - 1] >= span[1]


def find_secrets(text: str, ranks: dict[str, int], hard: float = HARD) -> tuple[list, list]:
    """-> base spans, all spans, each in order."""
    base = base_spans(text)
    held = Within(base)
    more = [("guess", s, e) for s, e in context_values(text) if (s, e) not in held and guess_cost(text[s:e], ranks, hard) >= hard]
    return ordered(base, KINDS), ordered(base + more, KINDS)


def without_words(value: str, hard: float) -> bool | None:
    """Is the value reported, whatever the known words are?  None: they decide."""
    if guess_cost(value, AnyWord(), hard) >= hard:
        return True
    return False if guess_cost(value, {}, hard) < hard else None


def letter_runs(value: str, hard: float) -> set[str]:
    """What could be a word of a segmentation under ``hard``, in lower case."""
    out = set()
    for i, cost in enumerate(prefix_costs(value, AnyWord(), hard)):
        if cost < hard:
            for j in range(i + 1, min(len(value), i + LONGEST_WORD) + 1):
                if not is_letter(value[j - 1]):
                    break
                if j >= i + 3:
                    out.add(value[i:j].lower())
    return out


def word_ranks(docs: DataFrame, values: DataFrame) -> DataFrame:
    """(w, rank) of all words by their count over all texts without ``values``
    (column value, as often as they occur); ties by word."""
    def words(t: DataFrame, sign: int) -> DataFrame:
        return t.select(F.explode(F.split(F.lower(t.columns[0]), NOT_LETTERS)).alias("w"), F.lit(sign).alias("k"))

    w = words(docs.select("text"), 1).unionByName(words(values, -1)).where(f"length(w) between 3 and {LONGEST_WORD}")
    counts = stored(w.groupBy("w").agg(F.sum("k").alias("n")).where("n > 0"), "word-counts")
    return global_rank(counts, [F.desc("n"), F.asc("w")]).select("w", "rank")


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"


def _scan(hard: float):
    """Texts -> result by what needs no words, the values left open and all
    values in credential context."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        place = pa.struct([("s", pa.int64()), ("e", pa.int64()), ("value", pa.string())])
        for b in batches:
            found, left, own = [], [], []
            for t in b.column(1):
                text = t.as_py() or ""
                base, more, todo, values = base_spans(text), [], [], list(context_values(text))
                held = Within(base)
                for s, e in values:
                    if (s, e) not in held:
                        sure = without_words(text[s:e], hard)
                        if sure:
                            more.append(("guess", s, e))
                        elif sure is None:
                            todo.append({"s": s, "e": e, "value": text[s:e]})
                found.append((ordered(base, KINDS), ordered(base + more, KINDS)))
                left.append(todo)
                own.append([text[s:e] for s, e in values])
            n = {k: pa.array([sum(x[0] == k for x in every) for _, every in found], pa.int64()) for k in KINDS}
            yield pa.RecordBatch.from_arrays(
                [b.column(0), n["assign"], n["access"], n["hex"], pa.array([digest(base) for base, _ in found], pa.string()),
                 pa.array([joined(every) for _, every in found], pa.string()), n["guess"], pa.array(left, pa.list_(place)),
                 pa.array(own, pa.list_(pa.string()))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess", "left", "own"])

    return run


def _hard_values(values: DataFrame, docs: DataFrame, own: DataFrame, hard: float) -> DataFrame:
    """Those of ``values`` (vid, value; each once) that take ``hard`` or more by the ranked words."""
    def runs(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for vid, value in zip(b.column(0), b.column(1)):
                w = sorted(letter_runs(value.as_py(), hard))
                yield pa.RecordBatch.from_arrays([pa.array([vid.as_py()] * len(w), pa.int64()), pa.array(w, pa.string())], names=["vid", "part"])

    def decide(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            out = [v for v, known in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                   if guess_cost(v, {k["w"]: k["rank"] for k in known or ()}, hard) >= hard]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["hard_value"])

    parts = stored(values.select("vid", "value").mapInArrow(runs, "vid long, part string"), "value-parts")
    ranked = stored(word_ranks(docs, own).join(parts.select(F.col("part").alias("w")).distinct(), "w", "left_semi"), "value-words")
    known = lookup(parts, ranked, F.col("part") == F.col("w"), F.col("vid")).where("w is not null") \
        .groupBy("vid").agg(F.collect_list(F.struct("w", "rank")).alias("known"))
    return stored(values.join(known, "vid", "left").select("value", "known").mapInArrow(decide, "hard_value string"), "hard-values")


def _add_guesses(batches: Iterator) -> Iterator:
    """Result columns and ``more`` -> result columns."""
    import pyarrow as pa

    for b in batches:
        spans, n = [], []
        for old, more in zip(b.column(5).to_pylist(), b.column(7).to_pylist()):
            parts = [x.split(":") for x in old.split(",") if x]
            every = ordered([(k, int(s), int(e)) for k, s, e in parts] + [("guess", m["s"], m["e"]) for m in more or ()], KINDS)
            spans.append(joined(every))
            n.append(sum(x[0] == "guess" for x in every))
        yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(spans, pa.string()), pa.array(n, pa.int64())], names=b.schema.names[:7])


def scan_documents(docs: DataFrame, hard: float = HARD) -> DataFrame:
    """-> doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInArrow(_scan(hard), f"{RESULT}, left array<struct<s: long, e: long, value: string>>, own array<string>")
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "secret-rows")  # rid is fixed by being stored
    names = rows.columns[:7]
    left = rows.where(F.size("left") > 0)
    places = left.select("rid", F.explode("left").alias("_p")).select("rid", "_p.*")
    values = stored(places.select("value").distinct().withColumn("vid", F.monotonically_increasing_id()), "open-values")
    if values.isEmpty():
        return rows.select(*names)
    found = _hard_values(values, docs, rows.select(F.explode("own").alias("value")), hard)
    more = lookup(places, found, F.col("value") == F.col("hard_value"), F.col("rid")).where("hard_value is not null") \
        .groupBy("rid").agg(F.collect_list(F.struct("s", "e")).alias("more"))
    added = left.join(more, "rid", "left").select(*names, "more").mapInArrow(_add_guesses, RESULT)
    return rows.where(F.size("left") == 0).select(*names).unionByName(added)
