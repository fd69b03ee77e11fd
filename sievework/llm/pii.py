"""Personal data by candidates and boosted trees, on top of exact base rules.

The base rules find emails, IPv4 addresses, payment cards and phone numbers and always
stand. Generators with high recall then propose overlapping spans: the same kinds where
the base rules give up (a number glued to another, written-out at and dot, missing plus,
groups), and kinds without a base rule (secret, ssn, iban). Each candidate is described
by its format and its surroundings and scored by gradient-boosted trees; scores are
calibrated per kind on examples held out from the fit, and the lowest threshold with the
wanted precision selects. Of selected spans that overlap the likelier wins; none may
touch a base span.

No table labels personal data, so the trees are fitted on examples that `examples` makes
from a fixed seed: formats and look-alikes in random surroundings, a fixed number of them.

A pattern that can only match around digits, or colons, or where some literal stands,
is tried there and nowhere else; what it finds is what a search of the whole text finds.

Offsets are code points, ends exclusive. Null text is empty. Texts of any length are
searched whole, in time linear in their length. Repeated rows are searched alike; columns
other than those named play no part, or stay as they are; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees
from .common import slices

#: Base kinds in the order they are listed, then kinds of the method (fixed values).
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "ssn", "iban")
#: Examples of each kind for the fit, and precision wanted of added spans.
EXAMPLES = 2000
PRECISION = 0.97

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


#: Digits that stand within 56 characters of one another, and colons within hexadecimal groups.
_DIGIT_ZONE = re.compile(r"[0-9](?:[^0-9]{0,56}[0-9])*")
_COLON_ZONE = re.compile(r":(?:[0-9A-Fa-f]{1,4}:){3,}")


def zones(text: str, core: re.Pattern, before: int, after: int) -> list[tuple[int, int]]:
    """Stretches of text around the matches of core, so many characters wider, those that overlap in one; look-behinds see what is before them."""
    out: list[tuple[int, int]] = []
    for m in core.finditer(text):
        begin, end = max(0, m.start() - before), min(len(text), m.end() + after)
        if out and begin < out[-1][1]:
            begin = out.pop()[0]
        out.append((begin, end))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """The base rules' spans: leftmost, not overlapping within a kind; matches that fail a check are dropped."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            out.append(("email", begin, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    for begin, end in zones(text, _DIGIT_ZONE, 8, 48):  # no gap between digits of a match is as wide as those between zones
        for m in _IP.finditer(text, begin, end):
            if octets(m[0]):
                out.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text, begin, end):
            digits = _DIGITS.sub("", m[0]) if m.end() - m.start() < 64 else ""
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


#: High-recall patterns by kind, with what any match has in it; every repeat is bounded, so a search stays linear.
GENERATORS = [
    ("email", r"(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{2,24}){1,4}", ("@", "(at)", "[at]", " at ")),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?: ?[.] ?[0-9]{1,3}){3}(?![0-9.])", _DIGIT_ZONE),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", _COLON_ZONE),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])", _DIGIT_ZONE),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ .-][0-9]{4}){3}(?![0-9])", _DIGIT_ZONE),
    ("card", r"(?<![0-9])3[0-9]{3}[ .-][0-9]{6}[ .-][0-9]{5}(?![0-9])", _DIGIT_ZONE),
    ("phone", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}(?![0-9])", _DIGIT_ZONE),
    ("phone", r"(?<![0-9+])(?:1[ .-])?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", _DIGIT_ZONE),
    ("phone", r"\b00[0-9]{2}[ .-]?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])", _DIGIT_ZONE),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _DIGIT_ZONE),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b", _DIGIT_ZONE),
    ("secret", r"(?ai:\b(?:pass(?:word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth))[\"']?\s{0,3}[:=]\s{0,3}[\"']?[^\s\"',;]{6,200}", ("pass", "pwd", "secret", "token", "key", "auth")),
    ("secret", r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", ("akia", "asia")),
    ("secret", r"\b(?:gh[pousr]_|sk-|xox[abp]-)[A-Za-z0-9_-]{16,200}", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xoxa-", "xoxb-", "xoxp-")),
    ("secret", r"\b[0-9a-f]{32,128}\b", None),
]
_COMPILED = [(kind, re.compile(p), needs) for kind, p, needs in GENERATORS]
_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "address", "server"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "call", "tel", "fax", "mobile"),
    "secret": ("password", "passwd", "pwd", "token", "secret", "key", "auth"),
    "ssn": ("ssn", "social"),
    "iban": ("iban", "bank", "account"),
}


#: Words before numbers that are no one's, and marks that passwords have and words have not (fixed values).
_NUMBERED = ("order", "invoice", "ticket", "isbn", "part", "serial", "no.")
_PUNCTUATION = re.compile(r"[!$%&*#?@^~]")


def proposals(text: str, whole: bool = False) -> Iterator[tuple[int, re.Match]]:
    """(generator, match) of every pattern; whole: without looking for what a match needs."""
    low, everywhere = text.lower(), [(0, len(text))]
    near = {_DIGIT_ZONE: None, _COLON_ZONE: None}
    for g, (_, pattern, needs) in enumerate(_COMPILED):
        where = everywhere
        if isinstance(needs, re.Pattern) and not whole:
            if near[needs] is None:
                near[needs] = zones(text, needs, 8, 48)
            where = near[needs]
        elif needs and not whole and not any(x in low for x in needs):
            continue
        for begin, end in where:
            for m in pattern.finditer(text, begin, end):
                yield g, m


def candidates(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, generator) of every proposal; proposals overlap."""
    out = []
    for g, m in proposals(text):
        kind, begin = _COMPILED[g][0], m.start()
        if kind == "email":  # the pattern begins at the sign: up to 64 characters of a name stand before it
            head = begin - (text[begin - 1 : begin] == " ")
            begin = head
            while begin > max(0, head - 64) and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin == head:
                continue
        out.append((kind, begin, m.end(), g))
    return out


def _iban(text: str) -> bool:
    t = text.replace(" ", "")
    return t.isalnum() and 15 <= len(t) <= 34 and int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def _entropy(text: str) -> float:
    return -sum(n / len(text) * math.log2(n / len(text)) for n in (text.count(c) for c in set(text)))


def describe(text: str, span: tuple[str, int, int, int]) -> list[float]:
    """Format and context features of a candidate."""
    kind, start, end, generator = span
    s = text[start:end]
    digits = _DIGITS.sub("", s)
    before, after = text[max(0, start - 24) : start].lower(), text[end : end + 12].lower()
    left, right = text[start - 1 : start], text[end : end + 1]
    value = re.split(r"[:=]\s*[\"']?", s, maxsplit=1)[-1]
    runs = [len(r) for r in re.findall(r"[0-9]+", s)]
    return [
        KINDS.index(kind),
        generator,
        len(s),
        len(digits),
        len(digits) / len(s),
        float(luhn(digits)) if digits else 0.0,
        len(set(digits)),
        float(kind == "ip" and "." in s and octets(s.replace(" ", ""))),
        float(kind == "iban" and _iban(s)),
        sum(c in " .-()" for c in s),
        float(s.startswith("+")),
        float("(" in s),
        float("@" in s),
        float("-" in s),
        float("." in s),
        float(" dot " in s),
        float("[" in s or "(at)" in s),
        max(runs, default=0),
        len(runs),
        _entropy(value),
        len(value),
        sum(c.isupper() for c in value) / len(value) if value else 0.0,
        sum(c in "aeiouAEIOU" for c in value) / len(value) if value else 0.0,
        max((len(r) for r in re.findall(r"[b-df-hj-np-tv-xz]+", value.lower())), default=0),
        sum(a.isupper() != b.isupper() for a, b in itertools.pairwise(value)),
        float(bool(_PUNCTUATION.search(value))),
        float(any(w in before for w in _NUMBERED)),
        float(any(c.isdigit() for c in value) and any(c.isalpha() for c in value)),
        float(left.isalnum()),
        float(left in ".-/:$#"),
        float(right.isalnum()),
        float(right in "-/:%"),
        float(any(w in before or w in s.lower()[:12] for w in _WORDS[kind])),
        float("version" in before or "license" in before or before.endswith(" v")),
        float(digits[:3] in ("000", "666") or digits[:1] == "9") if kind == "ssn" else 0.0,
        float(len(after.strip()) == 0),
    ]


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random, good: bool) -> str:
    body = rng.choice("3456") + _digits(rng, 14)
    last = next(d for d in "0123456789" if luhn(body + d))
    return body + (last if good else str((int(last) + rng.randint(1, 9)) % 10))


def examples(seed: int = 11, each: int = EXAMPLES) -> list[tuple[str, str, int, int, bool]]:
    """(text, kind, start, end, personal): formats and look-alikes in random surroundings."""
    rng = random.Random(seed)
    syllables = "an er in on re th ou la de le que en es tion ver ing au ch".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    hexed = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    quad = lambda most: ".".join(str(rng.randint(1, most)) for _ in range(4))

    def iban() -> str:
        body = "".join(rng.choice("0123456789") for _ in range(18))
        country = rng.choice(["DE", "FR", "ES"])
        rest = int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        return f"{country}{98 - rest:02d}{body}"

    def grouped(number: str, by: str) -> str:
        return by.join(number[i : i + 4] for i in range(0, 16, 4))

    letters, capitals, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    drawn = lambda of, low, high: "".join(rng.choice(of) for _ in range(rng.randint(low, high)))
    said = lambda low, high: "".join(word() for _ in range(rng.randint(low, high)))
    name = lambda: rng.choice(["password", "Passwd", "pwd", "secret", "auth", "token", "api_key", "access_key"]) + rng.choice(["=", " = ", ": "])
    key = lambda: rng.choice(["ghp_", "gho_", "sk-", "xoxb-", "xoxp-"])
    alternating = lambda: "".join(c.upper() if k % 2 == 0 else c for k, c in enumerate(drawn(letters, 8, 16)))

    def numbered(number: str) -> str:
        return f"{rng.choice(_NUMBERED)} {number}"

    makers = {
        "email": ([lambda: f"{word()}.{rng.randint(1, 99)}@{word()}.com", lambda: f"{word()} at {word()} dot com", lambda: f"{word()}(at){word()}.org", lambda: f"{word()} [at] {word()} [dot] net", lambda: f"{word()}[at]{word()}.{rng.choice(['org', 'com', 'net'])}", lambda: f"{word()} (at) {word()} (dot) org"], [lambda: f"{word()} at {word()}-{word()}.{word()}", lambda: f"{word()} at {word()}. {word()}", lambda: f"{word()} at {word()}.{word()}", lambda: f"{word()} at {word()} . {word()}"]),
        "ip": ([lambda: quad(255), lambda: quad(255).replace(".", " . ", 1), lambda: ":".join(hexed(4) for _ in range(8))], [lambda: f"{rng.randint(256, 999)}.{quad(255).split('.', 1)[1]}", lambda: ".".join(str(rng.randint(300, 999)) for _ in range(4)), lambda: ":".join(f"{rng.randint(0, 59):02d}" for _ in range(5))]),
        "card": ([lambda: _card(rng, True), lambda: grouped(_card(rng, True), rng.choice(" -.")), lambda: _card(rng, True)], [lambda: _card(rng, False), lambda: _digits(rng, rng.randint(17, 19)), lambda: grouped(_card(rng, False), rng.choice(" -."))]),
        "phone": ([lambda: f"+1 ({_digits(rng, 3)}) {_digits(rng, 3)}-{_digits(rng, 4)}", lambda: f"({_digits(rng, 3)}) {_digits(rng, 3)}-{_digits(rng, 4)}", lambda: f"{_digits(rng, 3)}-{_digits(rng, 3)}-{_digits(rng, 4)}", lambda: f"+{rng.randint(20, 99)} {_digits(rng, 3)} {_digits(rng, 3)} {_digits(rng, 4)}", lambda: f"0049 {_digits(rng, 3)} {_digits(rng, 4)} {_digits(rng, 3)}"], [lambda: numbered(f"{_digits(rng, 3)}-{_digits(rng, 3)}-{_digits(rng, 4)}"), lambda: numbered(f"({_digits(rng, 3)}) {_digits(rng, 3)}-{_digits(rng, 4)}"), lambda: f"{_digits(rng, 3)}.{_digits(rng, 3)}.{_digits(rng, 4)}", lambda: f"{_digits(rng, 3)} {_digits(rng, 3)} {_digits(rng, 4)}"]),
        "secret": ([lambda: f'{rng.choice(["token", "secret", "api_key"])} = "{hexed(40)}"', lambda: f"password={hexed(rng.randint(12, 24))}", lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)), lambda: key() + drawn(letters + capitals + digits, 20, 36), lambda: hexed(40)]
            # letters alone: keys of an exact form, and passwords that are no words
            + [lambda: rng.choice(["AKIA", "ASIA"]) + drawn(capitals, 16, 16), lambda: key() + drawn(letters + capitals, 16, 30), lambda: name() + alternating(), lambda: name() + drawn(letters + capitals, 8, 20), lambda: name() + drawn(letters, 9, 16), lambda: name() + said(1, 2) + drawn("!$%&*#?", 1, 2) + drawn(digits, 1, 3)],
            [lambda: f"{name()}{said(2, 4)}", lambda: f"token: {said(2, 4)}", lambda: f"password = {said(2, 4).title()}", lambda: f"auth: {said(2, 4)}", lambda: rng.choice("01") * 40, lambda: key() + (said(8, 12) * 2)[: rng.randint(16, 30)], lambda: key() + "-".join(said(1, 3) for _ in range(6)) if rng.random() < 0.8 else "ASIA" + (said(8, 9) * 3).upper()[:16]]),
        "ssn": ([lambda: f"{rng.randint(100, 665)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"], [lambda: f"{rng.choice(['000', '666'])}-{_digits(rng, 2)}-{_digits(rng, 4)}", lambda: f"9{_digits(rng, 2)}-{_digits(rng, 2)}-{_digits(rng, 4)}"]),
        "iban": ([iban], [lambda: rng.choice(["DE", "FR", "AB"]) + _digits(rng, 20), lambda: f"AB12 {_digits(rng, 4)} CDEF {_digits(rng, 4)}"]),
    }
    out = []
    for kind, (good, bad) in makers.items():
        for k in range(each):
            personal = k % 2 == 0
            body = rng.choice(good if personal else bad)()
            cue = rng.choice(_WORDS[kind]) + rng.choice([" ", ": "]) if rng.random() < 0.15 else ""
            lead = " ".join(word() for _ in range(rng.randint(0, 6)))
            head = f"{lead} {cue}" if lead else cue
            joint = rng.choice([" ", " ", " ", ", ", ". ", "\n", ""])
            tail = rng.choice([word(), _digits(rng, 4), word().title()]) if joint else ""
            text = head + body + joint + tail
            for c_kind, start, end, _ in candidates(text):
                # half a number or a stretch over its neighbour is no finding
                exact = personal and c_kind == kind and len(head) <= start and end <= len(head) + len(body)
                near = exact and (kind in ("email", "secret") or end - start >= 0.9 * len(body))
                out.append((text, c_kind, start, end, bool(near)))
    rng.shuffle(out)
    return out


class Selector:
    """Boosted trees over candidates, calibrated, with a threshold per kind."""

    def __init__(self, seed: int = 11, each: int = EXAMPLES, precision: float = PRECISION):
        made = examples(seed, each)
        x, y = [], []
        for text, kind, start, end, personal in made:
            g = next(g for k, s, e, g in candidates(text) if (k, s, e) == (kind, start, end))
            x.append(describe(text, (kind, start, end, g)))
            y.append(personal)
        features, target = np.array(x), np.array(y, float)
        fit = np.arange(len(y)) % 3 > 0
        self.trees = BoostedTrees().fit(features[fit], target[fit])
        score, held = self.trees.decision(features[~fit]), target[~fit]
        # Platt scaling by Newton steps
        a, b = 1.0, 0.0
        for _ in range(25):
            p = 1 / (1 + np.exp(-(a * score + b)))
            w = p * (1 - p) + 1e-6
            g = np.array([((p - held) * score).sum() + 1e-3 * (a - 1), (p - held).sum()])
            h = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum()]])
            step = np.linalg.solve(h, g)
            a, b = a - step[0], b - step[1]
        self.scale = float(a), float(b)
        kinds, p = features[~fit][:, 0].astype(int), self.probability(features[~fit])
        self.least = np.full(len(KINDS), 0.5)
        for k in range(len(KINDS)):
            order = np.argsort(-p[kinds == k])
            right = np.cumsum(held[kinds == k][order]) / np.arange(1, len(order) + 1)
            good = np.flatnonzero(right >= precision)
            if len(good):
                self.least[k] = max(0.5, p[kinds == k][order][good[-1]])

    def probability(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale[0] * self.trees.decision(features) + self.scale[1])))

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Selected candidates, none overlapping another or a base span."""
        proposed = [c for c in candidates(text) if not any(c[1] < e and s < c[2] for _, s, e in base)]
        if not proposed:
            return []
        p = self.probability(np.array([describe(text, c) for c in proposed]))
        taken: list[Span] = []
        for i in sorted(range(len(proposed)), key=lambda i: (-p[i], proposed[i][1], -proposed[i][2])):
            kind, start, end, _ = proposed[i]
            if p[i] >= self.least[KINDS.index(kind)] and not any(start < e and s < end for _, s, e in taken):
                taken.append((kind, start, end))
        return taken


@lru_cache(maxsize=1)
def selector() -> Selector:
    return Selector()


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]))))


def find(text: str | None, model: Selector) -> tuple[list[Span], list[Span]]:
    """(base spans, added spans) of a whole text."""
    if not text:
        return [], []
    base = base_spans(text)
    return base, model.added(text, base)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): counts and digest of base spans, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(selector())
    names = ["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            counts, sha, spans = [], [], []
            for text in batch.column(1).to_pylist():
                base, more = find(text, model)
                kinds = [k for k, _, _ in base]
                counts.append([kinds.count(k) for k in BASE_KINDS])
                sha.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(base + more))
            made = [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(BASE_KINDS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, pa.array(sha, pa.string()), pa.array(spans, pa.string())], names=names)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span in text replaced by its kind in brackets.

    Null texts stay null; other columns stay as they are, but n_chars, where there is
    one, follows the text. Base spans of two kinds may overlap: the first takes both.
    """
    shared = docs.sparkSession.sparkContext.broadcast(selector())
    columns = docs.columns
    at = columns.index("text")

    def clean(text: str | None, model: Selector) -> str | None:
        base, more = find(text, model)
        if not base and not more:
            return text
        parts, done = [], 0
        for kind, start, end in sorted(base + more, key=lambda x: (x[1], -x[2])):
            if start >= done:
                parts += [text[done:start], f"[{kind.upper()}]"]
            done = max(done, end)
        return "".join([*parts, text[done:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, "text"):
            texts = pa.array([clean(t, model) for t in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], names=columns)

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
