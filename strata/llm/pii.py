"""Personal data by candidate gradient boosting (operator 3).

Base spans are fixed patterns with checks (digits, Luhn, octets). On top,
high-recall generators propose overlapping spans: looser spellings
(``name [at] host [dot] org``, ``name at host dot org``, phones without a plus or
any separator, cards with dots, defanged addresses), and a second look at base
matches that failed their check (a card or address inside a longer run, a phone
before further numbers). Boosted trees score each by format and context, a threshold per
kind calibrated for precision selects, and a chosen span that overlaps a base
or better span is left out. Base spans always stay.

The trees learn without hand labels: respelled base spans of the corpus in
their own context are positives; look-alikes (a digit or octet spoilt, dates,
identifiers, runs of unlike numbers), and proposals of the corpus in which no
check holds, are negatives; other proposals of the corpus have no label. All
texts give rows: trees learn from one half of them and thresholds are
calibrated on the other.

Of a run of more than 19 digits, cards are looked for at the edges of its groups
of digits, not in the middle of one group.

Defined results: NULL text is empty; a text without a candidate has no spans;
equal texts have equal spans; fitted on one text only, nothing is added.
Positions are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import boosting
from strata.llm.common import free_name

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
# Possessive runs: equal to the plain pattern, but linear on long digit runs.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Implied by every base pattern and every proposal: texts without it are skipped.
_ANY = re.compile(r"[0-9@]|[\[({] ?(?:at|AT|dot|DOT) ?[\])}]| (?:dot|DOT) ")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches, found from each @ outwards (linear in the text)."""
    floor, at = 0, text.find("@")
    while at >= 0:
        host = _HOST.match(text, at)
        start = at
        if host:
            while start > floor and text[start - 1] in _LOCAL_CHARS:
                start -= 1
        if host and start < at:
            yield "email", start, host.end()
            floor = host.end()
        at = text.find("@", max(at + 1, floor))


def base_spans(text: str) -> list[Span]:
    spans = list(_emails(text))
    spans += [("ip", *m.span()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                     for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        d = digits_of(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text)
              if 9 <= len(digits_of(m.group())) <= 15]
    return spans


# High-recall proposals; each may overlap others.
_LOOSE = [
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]{0,63} ?(?:@|[\[({] ?(?:at|AT) ?[\])}]) ?"
                         r"[A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[A-Za-z0-9-]{1,63}){1,4}")),
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]{0,63}(?: (?:dot|DOT) [A-Za-z0-9]{1,63}){0,2} (?:at|AT) "
                         r"[A-Za-z0-9-]{1,63}(?:(?:\.| (?:dot|DOT) )[A-Za-z0-9-]{1,63}){0,3} (?:dot|DOT) [A-Za-z]{2,24}(?!\w)")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:00|\+ ?)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9A-Za-z])")),
    ("phone", re.compile(r"(?<![0-9A-Za-z])(?:00|\+)?[0-9]{10,11}(?![0-9A-Za-z])")),
]
# Addresses may overlap, so that each group of a longer run starts one.
_LOOSE_IP = re.compile(r"(?<![0-9A-Za-z])(?=([0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)| \. )[0-9]{1,3}){3})(?![0-9A-Za-z]))")
_LOOSE_CARD = re.compile(r"[0-9](?:[\x20._/-]{0,2}[0-9]){12,}")
_GROUP = re.compile(r"[0-9]+")
_DIGITS = frozenset("0123456789")
# Words that tend to stand before personal data, or before numbers that are not.
_HINTS = {
    "email": ("mail", "email", "contact", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "account"), "phone": ("phone", "tel", "call", "fax", "mobile"),
}
_ARTICLES = ("the", "a", "an", "this", "that", "each", "every", "its", "their", "our")
_AGAINST = ("version", "license", "isbn", "order", "page", "section", "token", "id", "no")


def _cards(text: str) -> Iterator[Span]:
    """Whole runs of 13 to 19 digits, and windows at group edges that pass Luhn."""
    for m in _LOOSE_CARD.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, m.start(), m.end())]
        places = np.concatenate([np.arange(a, b) for a, b in groups])
        total = len(places)
        if total <= 19:
            yield "card", *m.span()
        digits = np.frombuffer("".join(text[a:b] for a, b in groups).encode(), np.uint8).astype(np.int64) - 48
        twice = 2 * digits - 9 * (digits > 4)
        even = np.arange(total) % 2 == 0
        # Luhn sums of prefixes, by whether digits at odd or at even places count twice.
        sums = [np.concatenate([[0], np.cumsum(np.where(even == bool(k), twice, digits))]) for k in (0, 1)]
        edges = np.concatenate([[0], np.cumsum([b - a for a, b in groups])])
        found = set()
        for n in range(13, min(19, total - 1) + 1):
            first = np.unique(np.concatenate([edges[edges + n <= total], edges[edges >= n] - n]))
            last = first + n
            check = np.where(last % 2 == 1, sums[0][last] - sums[0][first], sums[1][last] - sums[1][first])
            for k in first[check % 10 == 0].tolist():
                found.add((int(places[k]), int(places[k + n - 1]) + 1))
        yield from (("card", a, b) for a, b in sorted(found))


def _failed_phones(text: str) -> Iterator[Span]:
    """Beginnings of base phone matches with too many digits, cut after a group."""
    for m in _PHONE.finditer(text):
        n = len(digits_of(m.group()))
        if n > 15:
            n = 0
            for g in _GROUP.finditer(text, m.start(), m.end()):
                n += g.end() - g.start()
                if n > 15:
                    break
                if n >= 9:
                    yield "phone", m.start(), g.end()


def proposals(text: str) -> list[Span]:
    """Distinct loose spans of a text, in a fixed order."""
    spans = [(k, *m.span()) for k, p in _LOOSE for m in p.finditer(text)]
    spans += [("ip", *m.span(1)) for m in _LOOSE_IP.finditer(text)]
    return list(dict.fromkeys([*spans, *_cards(text), *_failed_phones(text)]))


def passes(span: Span, text: str) -> bool:
    """Whether a proposal holds the check of its kind."""
    kind, a, b = span
    s = text[a:b]
    d = digits_of(s)
    if kind == "email":
        return bool(re.search(r"[A-Za-z]{2,}\Z", s))
    if kind == "ip":
        return all(int(g) <= 255 for g in _GROUP.findall(s))
    return luhn(d) if kind == "card" else 9 <= len(d) <= 15


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span."""
    kind, a, b = span
    s = text[a:b]
    host = re.split(r"@|[\[({ ]at[\])} ]", s.lower())[-1].strip(" [](){}") if kind == "email" else ""
    # Digits say nothing of an address but in its last label.
    form = re.split(r"\.|[\[({ ]dot[\])} ]", host)[-1] if kind == "email" else s
    d = digits_of(form)
    groups = _GROUP.findall(form)
    before, after = text[max(0, a - 24):a].lower(), text[b:b + 1]
    words = re.findall(r"[a-z]+", before)
    last = words[-1] if words else ""
    return [
        float(KINDS.index(kind)), len(s) if kind != "email" else 0, len(d), len(groups), max(map(len, groups), default=0),
        min(map(len, groups), default=0), float(luhn(d)) if d else 0.0,
        float(bool(groups) and all(len(g) <= 3 and int(g) <= 255 for g in groups)),
        s.count("."), s.count("-"), s.count(" "), s.count("(") + s.count("["),
        float(s.startswith(("+", "00"))), float("@" in s), float("at" in s.lower()),
        float("dot" in s.lower()), len(set(d)), float(d[:1] in ("3", "4", "5", "6")),
        float(before[-1:].isspace() or not before), float(after.isspace() or after in "" or after in ".,;:)"),
        float(any(h in words[-2:] for h in _HINTS[kind])), float(last in _AGAINST),
        len(set(map(len, groups))), float(bool(re.search(r"[A-Za-z]{2,}\Z", s))),
        # Further digits beside the span: right there, or after a separator.
        float(before[-1:] in _DIGITS) + float(bool(re.search(r"[0-9][\x20._/-]{0,2}\Z", before))),
        float(after in _DIGITS) + float(bool(re.match(r"[\x20._/-]{0,2}[0-9]", text[b:b + 3]))),
        float(re.split(r"[ .\[({]", host)[0] in _ARTICLES),
    ]


class Taken:
    """Disjoint stretches of a text; asking and adding cost a bisection."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1:]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def overlaps(self, span: Span) -> bool:
        k = bisect.bisect_left(self.starts, span[2]) - 1
        return k >= 0 and self.ends[k] > span[1]

    def add(self, span: Span):
        k = bisect.bisect_left(self.starts, span[1])
        self.starts.insert(k, span[1])
        self.ends.insert(k, span[2])


def _named(local: str, salt: int) -> str:
    """The local part, or a shorter one without digits, or one word of it: all occur."""
    plain = re.sub(r"[._+-]?[0-9]+", "", local) or local
    return (local, plain, plain[:3 + salt % 7], re.split(r"[._+-]", plain)[0] or plain)[(salt >> 3) % 4]


def _respell(kind: str, s: str, salt: int) -> str:
    """A looser spelling of a base span."""
    if kind == "email":
        at, dot = ((" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", "."), (" at ", " dot "))[salt % 4]
        local, host = s.rsplit("@", 1)
        if " dot " in dot and not re.search(r"[A-Za-z]{2,}\Z", host):
            at, dot = "[at]", "."
        return _named(local, salt) + at + host.replace(".", dot)
    if kind == "ip":
        return (s.replace(".", ("[.]", " . ", "(.)")[salt % 4]) if salt % 4 < 3
                else f"{300 + salt % 600}.{s}")            # a failed base match with an address in it
    if kind == "card":
        d = digits_of(s)
        grouped = [d[k:k + 4] for k in range(0, len(d), 4)]
        # Grouped loosely; among other numbers; beside another long number.
        return ((".", "  ", "_")[salt % 5].join(grouped) if salt % 5 < 3 else
                (" ".join([f"{1 + salt % 97}", *grouped, f"{10 + salt % 83}"]), f"{d} {d[::-1]}")[salt % 5 - 3])
    d = digits_of(s)
    local = f"{d[-10:-7]}-{d[-7:-4]}-{d[-4:]}"
    return (local, "00" + d[:-10] + " " + local.replace("-", " "), local.replace("-", "."),
            d[-10:], f"{s} {1950 + salt % 90}-{1 + salt % 12:02d}-{1 + salt % 28:02d} {salt % 24:02d}")[salt % 5]


def _spoil(kind: str, s: str, salt: int) -> str:
    """What looks like the loose spelling but is not personal data."""
    if kind == "email":
        name = _named(re.split(r"[@+]", s)[0], salt)
        if salt % 4 == 3:
            return f"{name} at {_ARTICLES[salt % len(_ARTICLES)]} dot {('com', 'org', 'net')[salt % 3]}"
        return name + (" (at) ", "@", "[at]")[salt % 3] + f"{salt % 97}.{salt % 7}"
    if kind == "ip":
        parts = s.split(".")
        parts[salt % 4] = str(256 + salt % 700)
        return _respell(kind, ".".join(parts), salt % 3)
    if kind == "card":
        d = digits_of(s)
        if salt % 4 == 3:                                  # a row of unlike numbers
            return " ".join(d[k:k + 1 + (salt >> k) % 5] for k in range(0, len(d), 3)) + f" {salt} {salt % 9973}"
        k = salt % len(d)
        d = d[:k] + str((int(d[k]) + 1 + salt % 8) % 10) + d[k + 1:]
        return d if salt % 4 == 2 else _respell(kind, d, salt % 3)
    year, month, day = 1950 + salt % 90, 1 + salt % 12, 1 + salt % 28
    return (f"{year}-{month:02d}-{day:02d} {salt % 24:02d}", f"{day:02d}.{month:02d}.{year}",
            f"{day}/{month:02d}/{year}", f"{salt % 90}.{salt % 40:02d}.{salt % 60:02d}",
            f"{year}-{year + 1}-{salt % 99:02d}", f"{day:02d} {month:02d} {year}",
            f"978-{salt % 10}-{10 + salt % 90}-{100000 + salt % 900000}-{salt % 10}",
            f"{_AGAINST[salt % len(_AGAINST)]} {10 ** 9 + salt * 7 % (9 * 10 ** 9)}")[salt % 8]


#: Respellings and look-alikes that each base span is learned from.
TURNS = 8


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Training rows that one text gives."""
    base = base_spans(text)
    for kind, a, b in base:
        for salt in (zlib.crc32(f"{text[a:b]}{turn}".encode()) for turn in range(TURNS)):
            for how, label in ((_respell, 1), (_spoil, 0)):
                new = how(kind, text[a:b], salt)
                around = text[max(0, a - 30):a] + new + text[b:b + 10]
                at = min(a, 30)
                of = digits_of(text[a:b])
                for s in proposals(around):
                    if s[0] == kind and s[1] < at + len(new) and at < s[2]:
                        # With other digits than the respelled span has, its edges are wrong.
                        whole = kind == "email" or digits_of(around[s[1]:s[2]]) in (of, of[-10:], "00" + of)
                        yield features(around, s), label * whole
    taken = Taken(base)
    for s in proposals(text):
        if not taken.overlaps(s) and not passes(s, text):
            yield features(text, s), 0


@dataclass
class Detector:
    model: boosting.Boosted
    thresholds: dict[str, float]


def calibrate(p: np.ndarray, y: np.ndarray, precision: float, n: np.ndarray | None = None) -> float:
    """The least threshold whose selection on held-out rows (row k ``n[k]`` times, or
    once) reaches ``precision`` (with one assumed mistake); above 1 if none does."""
    n = np.ones(len(y)) if n is None else n
    order = np.argsort(-p, kind="stable")
    p, count, hits = p[order], np.cumsum(n[order]), np.cumsum((n * y)[order])
    # Equal probabilities are selected together; the threshold lies right above the next ones.
    below = np.append(p[1:], 0.0)
    good = (hits / (count + 1) >= precision) & (below < p)
    return float(np.nextafter(below[good][-1], 1.0)) if good.any() else 2.0


@dataclass
class Rows:
    """Training rows, equal ones together: features, label, whether trees (or else
    thresholds) learn from them, and how many there are."""
    x: np.ndarray
    y: np.ndarray
    trains: np.ndarray
    n: np.ndarray

    @classmethod
    def of(cls, rows) -> Rows:
        x, y, h, n = zip(*((*r[:3], r[3] if len(r) > 3 else 1) for r in rows))
        return cls(np.array(x, float), np.array(y, float), np.array(h) % 2 == 0, np.array(n, float))

    def __len__(self) -> int:
        return int(self.n.sum())

    def __iter__(self) -> Iterator[tuple[list[float], int, int]]:
        for x, y, trains, n in zip(self.x.tolist(), self.y, self.trains, self.n):
            yield from ((x, int(y), int(not trains)) for _ in range(int(n)))


def fit(rows: Rows | list[tuple[list[float], int, int]], precision: float = 0.97) -> Detector:
    """Trees on the rows of one half of the texts, thresholds per kind on the other;
    a row is features, label and a number of its text."""
    if not len(rows):
        return Detector(boosting.Boosted(), dict.fromkeys(KINDS, 2.0))
    r = rows if isinstance(rows, Rows) else Rows.of(rows)
    held = ~r.trains
    model = boosting.fit(r.x[r.trains], r.y[r.trains], r.n[r.trains])
    p = model.probability(r.x[held]) if held.any() else np.zeros(0)
    cut = {}
    for k, kind in enumerate(KINDS):
        of = r.x[held][:, 0] == k
        cut[kind] = max(0.5, calibrate(p[of], r.y[held][of], precision, r.n[held][of])) if of.any() else 2.0
    return Detector(model, cut)


def fit_spread(rows: DataFrame, precision: float = 0.97) -> Detector:
    """``fit`` for any number of rows, which stay on the executors."""
    model = boosting.fit_spread(rows.where("trains"))

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = np.stack(b["x"].to_list())
                yield pd.DataFrame({"kind": x[:, 0].astype(int), "p": model.probability(x),
                                    "n": b["n"], "hits": b["n"] * b["y"]})

    by_p = (rows.where("not trains").select("x", "y", "n")
            .mapInPandas(scores, "kind int, p double, n long, hits long")
            .groupBy("kind", "p").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
            .withColumn("level", F.floor(1000 * F.log(F.col("p") / (1 - F.col("p"))))))
    # Running totals, likeliest first: over whole levels of log odds, then within one level.
    levels = by_p.groupBy("kind", "level").agg(F.sum("n").alias("level_n"), F.sum("hits").alias("level_hits"))
    above = Window.partitionBy("kind").orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    levels = levels.select("kind", "level", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(c)
                                              for c in ("level_n", "level_hits")])
    within = Window.partitionBy("kind", "level").orderBy(F.desc("p"))
    good = (F.sum("hits").over(within) + F.col("level_hits")) / (F.sum("n").over(within) + F.col("level_n") + 1)
    least = (by_p.join(levels, ["kind", "level"]).select("kind", "p", good.alias("good"))
             .where(F.col("good") >= precision).groupBy("kind").agg(F.min("p").alias("least")))
    below = by_p.join(F.broadcast(least), "kind").groupBy("kind").agg(
        F.max(F.when(F.col("p") < F.col("least"), F.col("p"))))
    cut = dict.fromkeys(KINDS, 2.0)
    cut.update((KINDS[k], max(0.5, float(np.nextafter(p or 0.0, 1.0)))) for k, p in below.collect())
    return Detector(model, cut)


#: Unlike training rows that the driver fits itself; of more it gets sums only.
IN_MEMORY = 1 << 16


def training(docs: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The training rows of all different texts, equal ones together: ``x, y, trains, n``."""
    # A digit or an at sign is in each base span and each proposal that gives rows.
    some = docs.where(F.col("text").rlike(r"[0-9@]")).select("text", F.xxhash64("text").alias("h"))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for b in batches:
            for t, h in zip(b["text"], b["h"]):
                for (x, y), n in Counter((tuple(x), y) for x, y in examples(t)).items():
                    out.append((h, x, y, n))
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=["h", "x", "y", "n"])
                        out = []
        yield pd.DataFrame(out, columns=["h", "x", "y", "n"])

    # Equal texts have equal rows, which count once; the texts themselves are not moved.
    rows = (some.mapInPandas(counted, "h long, x array<double>, y int, n long")
            .groupBy("h", "x", "y").agg(F.max("n").alias("n")))
    if max_rows is not None:
        rows = (rows.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).withColumn("n", F.lit(1))
                .orderBy(F.xxhash64("h", "x", "y", "k"), "h", "x", "y", "k").limit(max_rows))
    return rows.groupBy("x", "y", (F.col("h") % 2 == 0).alias("trains")).agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, max_rows: int | None = None, **settings) -> Detector:
    """Fit on all training rows of all texts (or on the ``max_rows`` of smallest hash,
    where that is asked for). Equal rows are fitted as one with their number."""
    rows = training(docs, max_rows).persist()
    try:
        if rows.count() > IN_MEMORY:
            return fit_spread(rows, **settings)
        found = [(r.x, r.y, int(not r.trains), r.n) for r in rows.collect()]
        return fit(Rows.of(found) if found else [], **settings)
    finally:
        rows.unpersist()


def added_spans(text: str, base: list[Span], detector: Detector) -> list[Span]:
    """Chosen proposals that overlap neither a base span nor a likelier one."""
    taken = Taken(base)
    spans = [s for s in proposals(text) if not taken.overlaps(s)]
    if not spans:
        return []
    p = detector.model.probability(np.array([features(text, s) for s in spans], float))
    chosen: list[Span] = []
    for k in sorted(range(len(spans)), key=lambda k: (-p[k], spans[k][1], -spans[k][2])):
        if p[k] >= detector.thresholds[spans[k][0]] and not taken.overlaps(spans[k]):
            chosen.append(spans[k])
            taken.add(spans[k])
    return chosen


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in
                    sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def detect(text, detector: Detector) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a text."""
    if not isinstance(text, str) or not _ANY.search(text):
        return [], []
    base = base_spans(text)
    return base, added_spans(text, base, detector)


RESULT = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [
    T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
    T.StructField("n_added", T.LongType())])


def spans_column(detector: Detector):
    """A text -> RESULT column function; ``n_email`` and the like count base spans."""

    @F.pandas_udf(RESULT)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for t in texts:
                base, more = detect(t, detector)
                kinds = [s[0] for s in base]
                out.append((*[kinds.count(k) for k in KINDS],
                            hashlib.sha256(listed(base).encode()).hexdigest(),
                            listed(base + more), len(more)))
            yield pd.DataFrame(out, columns=RESULT.names)

    return find


def redact(text, detector: Detector):
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans become one, named after the first. Where what is left of a
    base match that failed its check becomes one that holds, that goes, too."""
    base, more = detect(text, detector)
    while base or more:                                    # each round takes digits or an at sign away
        out, at = [], 0
        for kind, a, b in sorted(base + more, key=lambda s: (s[1], -s[2])):
            if a >= at:
                out += [text[at:a], f"<{kind.upper()}>"]
            at = max(at, b)
        text = "".join(out) + text[at:]
        base, more = base_spans(text), []
    return text


def redacted(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` with its texts redacted (and ``n_chars``, where there is one, counted anew)."""

    @F.pandas_udf(T.StringType())
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([redact(t, detector) for t in texts], dtype=object)

    name = free_name(docs, "_redacted")
    new = {"text": F.col(name)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(name) == F.col("text"), F.col("n_chars")).otherwise(
            F.length(name).cast(docs.schema["n_chars"].dataType))
    return docs.withColumn(name, clean(F.col("text"))).withColumns(new).select(*docs.columns)
