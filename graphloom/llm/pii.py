"""Operator 9: personal data by candidate gradient boosting.

Base patterns with their checks (octets, Luhn, digit counts) find e-mail
addresses, IP addresses, card and phone numbers; those always stay.  High-recall
generators propose further, overlapping spans (spelt-out addresses, any grouped
or long number and the single numbers of a longer run, dotted numbers, account
numbers, hardware addresses).  Boosted trees score each
candidate on its format and context; a threshold calibrated on held-out rows for
``PRECISION`` selects which are redacted, as kind ``learned``.

The classifier is fitted on the candidates of a bounded sample of documents
(``SAMPLE_DOCS``, by hash order), at most ``PER_LABEL`` of each label in the hash
order of document and span, and applied to every whole text.  What the base
patterns decide by (@, +, check digits, octets) is not among the features, or
the trees would only learn the patterns again.  Positive are candidates that a
checked pattern covers, the same in an unchecked spelling, and generated ones of
each kind that no pattern knows (spelt-out addresses, national phone numbers,
IBANs, account, social security and device numbers).  An uncovered candidate counts as negative only where
neither its form nor its context speaks for personal data; ``doubtful`` ones are
not in the fit at all, so that however many there are, they are not taken for
clean.  Generated negatives (dates, versions, amounts, times after the same
words) keep the context alone from deciding.

Defined results: a null text is empty; clean texts have no spans and are
returned unchanged by ``redact``; repeated rows give repeated results; an empty
table gives no rows; further columns are ignored by ``scan_documents`` and kept
by ``redact_documents``.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm import worker
from graphloom.llm.spans import digest, joined, ordered, replaced
from graphloom.session import ship_package, stored

KINDS = ("email", "ip", "card", "phone", "learned")
SAMPLE_DOCS = 20_000
#: Examples of the sample in the fit, of each label.
PER_LABEL = 25_000
PRECISION = 0.98

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match starts at the first digit of a run: where that fails, later digits of the run fail too
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

GENERATORS = (
    re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]{1,64})*"),
    re.compile(r"\+?\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,}"),
    re.compile(r"[0-9]{1,4}(?:[.:][0-9]{1,4}){2,}"),
    re.compile(r"\b[A-Z]{2}[0-9]{2}\x20?(?:[A-Z0-9]{4}\x20?){2,7}[A-Z0-9]{1,4}\b"),
    re.compile(r"\b[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}\b"),  # hardware addresses
    re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Za-z:])"),  # long IP addresses
)
#: A run of more digits is several numbers: its groups are proposed each by itself.
ONE_NUMBER = 19
#: Words of a candidate's context; those of four letters and more also as the start of a word.
CONTEXT = (("mail", "email", "contact", "write", "correo", "courriel"), ("phone", "tel", "telephone", "telefon", "call", "fax", "mobile", "ruf"),
           ("card", "visa", "credit", "iban", "account", "konto", "carte"), ("ip", "host", "server", "addr", "ssn", "id"))
DATE = re.compile(r"(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}")
DOMAIN_END = re.compile(r"(?:\.|\((?:dot)\)|\[dot\])\x20?[A-Za-z]{2,}$")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses, from each @ outwards."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        free = m.end() if m else at + 1
        if m:
            yield start, free
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def only_digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", s, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15]
    return out


HAS_CANDIDATE = re.compile(r"[0-9][0-9\x20()./:-]|@|\(at\)|\[at\]|[0-9A-Fa-f]{2}[:-][0-9A-Fa-f]{2}[:-]")


def candidates(text: str) -> list[tuple[int, int]]:
    """Overlapping spans that might be personal data."""
    if not HAS_CANDIDATE.search(text):
        return []
    found = {m.span() for g in GENERATORS for m in g.finditer(text)}
    for s, e in list(found):
        if e - s > ONE_NUMBER and len(only_digits(text[s:e])) > ONE_NUMBER:
            found.update(parts(text, s, e))
    return sorted(found)


def parts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The numbers that a long run may hold: unbroken ones, and four groups of four."""
    groups = [m.span() for m in re.compile("[0-9]+").finditer(text, start, end)]
    yield from ((s, e) for s, e in groups if 9 <= e - s <= ONE_NUMBER)
    fours = [e - s == 4 for s, e in groups]
    yield from ((groups[k][0], groups[k + 3][1]) for k in range(len(groups) - 3) if all(fours[k:k + 4]))


def valid_iban(s: str) -> bool:
    t = s.replace(" ", "")
    return bool(IBAN.fullmatch(t)) and int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def context_flags(text: str, start: int) -> list[float]:
    """Which groups of ``CONTEXT`` the whole words of the 40 characters before have."""
    at = max(0, start - 40)
    while 0 < at < start and text[at - 1].isalnum() and text[at].isalnum():  # a word that the edge cuts
        at += 1
    found = re.findall(r"\w+", text[at:start].lower())
    return [float(any(w == k or len(k) > 3 and w.startswith(k) for w in found for k in group)) for group in CONTEXT]


#: Places of features that are asked for by name.
DIGITS, CARD_BESIDE, DATED, FLAGS = 1, -7, -6, slice(-4, None)


def features(text: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate, without what the base patterns decide by."""
    s, before, after = text[start:end], text[max(0, start - 1):start], text[end:end + 1]
    d = only_digits(s)
    groups = re.findall("[0-9]+", s)
    return [
        len(s), len(d), len(d) / max(1, len(s)), sum(c.isalpha() for c in s), s.count("."), s.count("-"),
        s.count(" "), s.count("(") + s.count("["), s.count("/") + s.count(":"), len(groups),
        max(map(len, groups), default=0), min(map(len, groups), default=0), float(bool(DOMAIN_END.search(s))),
        float(before.isalnum()), float(after.isalnum()), float(before in tuple(".-/=_")), float(card_in_run(text, start, end, d)),
        float(bool(DATE.search(s))), float(valid_iban(s)), *context_flags(text, start)]


def card_in_run(text: str, start: int, end: int, digits: str) -> bool:
    """Does the form of a card number (first digit, length, check digit) stand
    beside another number?  The base patterns take such a run as one number."""
    if len(digits) not in (15, 16) or digits[0] not in "3456" or not luhn(digits):
        return False
    return text[max(0, start - 2):start].strip()[-1:].isdigit() or text[end:end + 2].strip()[:1].isdigit()


def doubtful(text: str, start: int, end: int, x: list[float]) -> bool:
    """Does form or context speak for personal data, though no pattern covers it?"""
    s = text[start:end]
    if x[DATED] or x[DIGITS] < 9 and not s[:2].isalpha() and "at" not in s and "@" not in s:
        return False  # neither a date nor a short number is personal in any context
    return any(x[FLAGS]) or valid_iban(s) or bool(DOMAIN_END.search(s))


def disguised(text: str, start: int, end: int, turn: int) -> tuple[str, int, int]:
    """The text with a covered candidate in a spelling that no pattern covers."""
    s = text[start:end]
    if "@" in s:
        s = s.replace("@", SPELT_AT[turn % len(SPELT_AT)])
    s = s.lstrip("+")
    return text[:start] + s + text[end:], start, start + len(s)


SPELT_AT = (" (at) ", "(at)", " [at] ", "[at]", " @ ")
FILLER = "the of and with for is see this our new der die und mit para con les des pour total code order number part from today".split()
FEWEST = 300


def generated(kind: str, n: int) -> list[tuple[list[float], bool]]:
    """Features and label of ``n`` texts with a candidate of a kind, the same for every run."""
    rng = random.Random(kind)

    def digits(k: int) -> str:
        return "".join(rng.choices("0123456789", k=k))

    def word(low: int = 3, high: int = 9) -> str:
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(low, high)))

    def grouped(s: str, by: int, gap: str) -> str:
        return gap.join(s[i:i + by] for i in range(0, len(s), by))

    def iban() -> str:
        head = rng.choice(("DE", "FR", "GB", "ES", "IT", "NL", "AT", "CH", "PL"))
        body = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=rng.choice((0, 0, 4)))) + digits(rng.randint(11, 22))
        check = 98 - int("".join(str(int(c, 36)) for c in body + head + "00")) % 97
        return grouped(f"{head}{check:02d}{body}", *rng.choice(((4, " "), (99, ""))))

    def card() -> str:
        body = rng.choice("3456") + digits(14)
        return next(body + c for c in "0123456789" if luhn(body + c))

    def spelt() -> str:
        dot = rng.choice((".", ".", " (dot) ", "(dot)", "[dot]"))
        user = word() + rng.choice(("", "." + word(), digits(2), digits(5)))
        return user + rng.choice(SPELT_AT) + dot.join([word(), *([word()] if rng.random() < .5 else []), rng.choice(("com", "org", "net", "de", "fr", "example"))])

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"0{a} {b}{digits(rng.randint(3, 5))}", f"0{a}/{b}{digits(rng.randint(3, 5))}", f"{a}{b}{c}", f"1 ({a}) {b}-{c}"))

    def date() -> str:
        y, m, d = f"20{digits(2)}", f"{rng.randint(1, 12):02d}", f"{rng.randint(1, 28):02d}"
        gap = rng.choice("./-")
        day = gap.join(rng.choice(((y, m, d), (d, m, y))))
        return day + rng.choice(("", "", f" {rng.randrange(24):02d}:{digits(2)}", f" {rng.randrange(24):02d}:{digits(2)}:{digits(2)}", f" - {y}"))

    makers = {
        "spelt": (spelt, (0, None)), "phone": (phone, (1,)), "iban": (iban, (2, None)),
        "cards": (lambda: f"{card()} {rng.choice((card(), digits(4)))}", (2, None, None)),
        "no cards": (lambda: f"{digits(16)} {digits(16)}", (None,)),
        "ssn": (lambda: f"{digits(3)}-{digits(2)}-{digits(4)}", (3, 3, None)),
        "device": (lambda: rng.choice((":".join(f"{rng.randrange(256):02x}" for _ in range(6)), "-".join(f"{rng.randrange(256):02X}" for _ in range(6)),
                                       ":".join(f"{rng.randrange(65536):x}" for _ in range(8)))), (3, None)),
        "account": (lambda: grouped(digits(rng.randint(9, 18)), *rng.choice(((4, " "), (3, " "), (99, ""), (4, "-")))), (2,)),
        "no date": (date, (0, 1, 2, 3, None)),
        "no number": (lambda: rng.choice((f"{digits(1)} {digits(3)} {digits(3)}", f"{digits(2)}:{digits(2)}:{digits(2)}", ".".join(digits(rng.randint(1, 2)) for _ in range(3)),
                                          digits(rng.randint(7, 8)))), (0, 1, 2, 3, None)),
        "no address": (lambda: f"{word()}{rng.choice((' @ ', '@', ' (at) '))}{rng.choice((word(), digits(1)))}", (0, 1, 2, None)),
        "no account": (lambda: rng.choice((digits(rng.randint(9, 18)), f"{word(2, 2).upper()}{digits(2)} {grouped(digits(13), 4, ' ')}")), (None,)),
    }
    make, groups = makers[kind]
    out = []
    for _ in range(n):
        group = rng.choice(groups)
        said = [] if group is None else [rng.choice(CONTEXT[group])] + rng.choices(FILLER, k=rng.randint(0, 2))
        before = " ".join(rng.choices(FILLER, k=rng.randint(0, 4)) + said) + rng.choice((" ", " ", ": "))
        value = make()
        text = before + value + rng.choice((" ", ".", ", ", "")) + " ".join(rng.choices(FILLER, k=2))
        for s, e in candidates(text):
            if s >= len(before) - 1 and (2 * (e - s) > len(value) or kind == "cards"):
                x = features(text, s, e)
                if kind.endswith("cards") and (kind == "cards") != bool(x[CARD_BESIDE]):
                    continue  # other parts of such a run, and numbers that pass by chance, are in no label
                out.append((x, not kind.startswith("no ")))
    return out


class Cover:
    """Base spans by start, for asking what they cover."""

    def __init__(self, base: list):
        self.spans = sorted((s, e) for _, s, e in base)
        self.starts, self.reach = [s for s, _ in self.spans], []
        for _, e in self.spans:
            self.reach.append(max(e, self.reach[-1]) if self.reach else e)

    def __contains__(self, span: tuple[int, int]) -> bool:
        """Is half of the span or more inside one base span?"""
        s, e = span
        j = bisect_left(self.starts, e) - 1
        while j >= 0 and self.reach[j] > s:
            a, b = self.spans[j]
            if 2 * (min(e, b) - max(s, a)) >= e - s:
                return True
            j -= 1
        return False


class Model:
    """Boosted trees and the calibrated threshold; plain arrays, sent to tasks."""

    def __init__(self, trees, threshold: float):
        self.trees, self.threshold = trees, threshold


def fit(x, y, precision: float = PRECISION) -> Model | None:
    """Fit on three quarters of the rows, calibrate on the others."""
    import numpy as np

    from graphloom.llm.boosting import BoostedTrees, calibrated_threshold

    x, y = np.asarray(x, float), np.asarray(y, float)
    if len(y) < 8 or y.min() == y.max():
        return None
    held = np.arange(len(y)) % 4 == 3
    if y[~held].min() == y[~held].max():
        return None
    trees = BoostedTrees(trees=80).fit(x[~held], y[~held])
    return Model(trees, calibrated_threshold(trees.score(x[held]), y[held], precision))


def examples(text: str) -> list[tuple[list[float], bool, int, int]]:
    """Features, label and span of a text's candidates, as far as they have a label."""
    base, out, doubt, clean = Cover(base_spans(text)), [], [], []
    for turn, c in enumerate(candidates(text)):
        x = features(text, *c)
        if c in base:
            near = max(0, c[0] - 100)  # all of the context
            out += [(x, True, *c), (features(*disguised(text[near:c[1] + 1], c[0] - near, c[1] - near, turn)), True, *c)]
        elif doubtful(text, *c, x):
            doubt.append(c)
        else:
            clean.append((c, x))
    starts, reach = [s for s, _ in doubt], [0]
    for _, e in doubt:
        reach.append(max(reach[-1], e))
    # a part of a doubtful candidate is no sure negative
    return out + [(x, False, s, e) for (s, e), x in clean if reach[bisect_right(starts, e - 1)] <= s]


def fit_examples(x: list, y: list) -> Model | None:
    """Fit on the sample's examples and the generated ones."""
    out = list(zip(x, y))
    for k, (row, label) in enumerate(zip(x, y)):
        if not label and (row[DIGITS] < 9 or row[DATED]):  # negative after the words of any group
            flags = [0.0] * len(CONTEXT)
            flags[k % len(CONTEXT)] = 1.0
            out.append(([*row[:FLAGS.start], *flags], False))
    most = max(FEWEST, (len(out) - sum(y)) // 10)  # positives keep a share beside any number of negatives
    for kind in ("spelt", "phone", "iban", "account", "ssn", "device", "cards"):
        out += generated(kind, most)
    for kind in ("no date", "no number", "no address", "no account", "no cards"):
        out += generated(kind, FEWEST)
    return fit([r for r, _ in out], [v for _, v in out])


def train(docs: DataFrame) -> Model | None:
    """The model of a bounded sample of documents, the same for every run."""
    ship_package(docs.sparkSession)
    order = F.xxhash64("doc_id", F.length("text"))
    pick = docs.select(order.alias("h")).orderBy("h").limit(SAMPLE_DOCS)
    last = pick.agg(F.max("h")).first()[0]
    if last is None:
        return None

    def rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        worker.none()
        for b in batches:
            out = [(key, *e) for key, t in zip(b.column(0).to_pylist(), b.column(1)) for e in examples(t.as_py() or "")]
            h, x, y, start, end = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.bool_()),
                                              pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["h", "x", "y", "s", "e"])

    sample = docs.select(order.alias("h"), "text").where(F.col("h") <= last)
    found = sample.mapInArrow(rows, "h long, x array<double>, y boolean, s long, e long")
    found = stored(found.select("x", "y", F.xxhash64("h", "s", "e").alias("o")), "pii-examples")
    got = [r for label in (True, False) for r in found.where(F.col("y") == label).orderBy("o", "x").limit(PER_LABEL).collect()]
    return fit_examples([r["x"] for r in got], [r["y"] for r in got])


def find_personal(text: str, model: Model | None) -> tuple[list, list]:
    """-> base spans, all spans, each in order."""
    base, more = base_spans(text), []
    if model:
        import numpy as np

        cover = Cover(base)
        todo = [c for c in candidates(text) if c not in cover]
        if todo:
            good = model.trees.score(np.array([features(text, *c) for c in todo])) >= model.threshold
            more = [("learned", *c) for c, g in zip(todo, good) if g]
    return ordered(base, KINDS), ordered(base + more, KINDS)


def scan_documents(docs: DataFrame) -> DataFrame:
    """-> doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_learned, n_spans (all kinds)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def scan(batches: Iterator) -> Iterator:
        import pyarrow as pa

        worker.none()
        for b in batches:
            found = [find_personal(t.as_py() or "", model.value) for t in b.column(1)]
            n = {k: pa.array([sum(x[0] == k for x in every) for _, every in found], pa.int64()) for k in KINDS}
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(n[k] for k in KINDS[:4]), pa.array([digest(base) for base, _ in found], pa.string()),
                 pa.array([joined(every) for _, every in found], pa.string()), n["learned"],
                 pa.array([len(every) for _, every in found], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS[:4]), "base_sha256", "spans", "n_learned", "n_spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_learned long, n_spans long")


def placeholder(kind: str) -> str:
    return "<PII>" if kind == "learned" else f"<{kind.upper()}>"


def redact_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced by placeholders; all columns
    stay, ``n_chars`` follows the text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))
    names = docs.columns
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        worker.none()
        for b in batches:
            cols = list(b.columns)
            texts = cols[at].to_pylist()
            new = list(texts)
            for k, t in enumerate(texts):
                spans = find_personal(t, model.value)[1] if t else []
                if spans:
                    new[k] = replaced(t, spans, placeholder)
            cols[at] = pa.array(new, cols[at].type)
            if chars is not None:
                n = cols[chars].to_pylist()
                cols[chars] = pa.array([len(y) if y != x else c for x, y, c in zip(texts, new, n)], cols[chars].type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
