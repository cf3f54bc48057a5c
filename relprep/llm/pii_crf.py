"""Personal data by a semi-Markov conditional random field (operator 3).

Base spans: fixed patterns for email, ip, card and phone, leftmost and
non-overlapping per kind, with number checks.  They always stay.

The method: a window of text around digits, ``@`` or an "at ... dot" spelling
is cut into atoms (runs of letters, of digits, of white space, single other
characters).  A semi-Markov CRF scores whole segments of at most
``MAX_ATOMS`` atoms by features of the span as one string (digit count and
grouping, separators, check sums, number ranges, spelling of @ and dots, the
characters and words around it) and pairs of neighbouring kinds, and
dynamic programming over bounded segments picks boundaries and kinds
jointly.  Its spans are added where they touch no base span.

Training: maximum likelihood by forward-backward on ``TRAINING`` labelled
windows, a documented bound of the model alone.  No labelled table exists for
personal data, so the windows are drawn from a seeded generator of usual
spellings and of look-alikes (dates, prices, versions, order numbers, failed
check sums); ``train`` takes any other (text, spans) sample.

Scale: one pass over the documents without a shuffle; texts are scanned
whole, a window's table holds atoms times MAX_ATOMS cells, and long
windows are decoded in linear time.

Defined results: a null text is empty and has no spans; equal rows give equal
rows; a null doc_id stays null; no rows give no rows; other columns are
ignored.
"""

from __future__ import annotations

import bisect
import functools
import math
import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 28
TRAINING = 500
EPOCHS = 6
AROUND = 48

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits: its first digit would match as well.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by the fixed patterns, by start, then kind."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        begin = at
        while begin > end and (c := text[begin - 1]) and c.isascii() and (c.isalnum() or c in "._%+-"):
            begin -= 1
        if begin < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append(("email", begin, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# ---- windows, atoms, segments

_TRIGGER = re.compile(r"[0-9](?:[^\n]{0,40}[0-9])*|@|[\[({]\s?at\s?[\])}]|\sat\s(?:[^\s]+\s+dot\s|(?=[^\n]{1,40}\sdot\s))", re.I)
_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
_AT = r"(?:\s?@\s?|\s?[\[({]\s?at\s?[\])}]\s?|\sat\s)"
_DOT = r"(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s)"
#: What a segment of each kind must look like at least; the model judges the rest.
_LOOSE = {
    "email": re.compile(rf"[a-z0-9][a-z0-9._%+-]*{_AT}[a-z0-9-]+(?:{_DOT}[a-z0-9-]+)+", re.I),
    "ip": re.compile(rf"[0-9]{{1,3}}(?:(?:{_DOT}|\s\.\s|-)[0-9]{{1,3}}){{3}}", re.I),
    "card": re.compile(r"[0-9](?:[ .\-]?[0-9]){12,18}"),
    "phone": re.compile(r"(?:\+|\()?[0-9](?:[ ().\-/]{0,2}[0-9]){6,14}"),
}
_WORDS = {
    "email": {"mail", "email", "contact", "write", "reach"},
    "ip": {"ip", "host", "server", "address", "ping"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "cc"},
    "phone": {"phone", "tel", "telephone", "call", "fax", "mobile", "cell", "dial"},
}
_NOT = {"order", "invoice", "version", "release", "isbn", "serial", "id", "ref", "date", "page", "item", "ticket"}


def windows(text: str) -> list[tuple[int, int]]:
    """Merged ranges of ``text`` around what may belong to personal data; none ends inside a token."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        a, b = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        done = out[-1][1] if out else 0
        while a > done and not text[a].isspace() and not text[a - 1].isspace():
            a -= 1
        while done < b < len(text) and not text[b - 1].isspace() and not text[b].isspace():
            b += 1
        if out and a <= done:
            out[-1][1] = max(done, b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _side(c: str) -> str:
    return "edge" if not c else "space" if c.isspace() else "letter" if c.isalpha() else "digit" if c.isdigit() else c if c in ".,-+:/=#@$%" else "other"


def features(kind: str, span: str, left: str, right: str, before: list[str]) -> list[str]:
    """Names of the features of a whole segment."""
    digits, out = _digits(span), ["any", "left " + _side(left[-1:]), "right " + _side(right[:1])]
    if right[:1] in ".," and right[1:2].isalnum():
        out.append("goes on")
    if left[-1:] in ".,-:/" and left[-2:-1].isalnum():
        out.append("comes from")
    near = {w.lower() for w in before}
    out += ["named"] * bool(near & _WORDS[kind]) + ["named otherwise"] * bool(near & (set().union(*_WORDS.values()) - _WORDS[kind])) + ["other number"] * bool(near & _NOT)
    if kind == "email":
        out += ["plain @" if "@" in span else "spelt at", "spelt dot" if re.search(r"dot", span, re.I) else "plain dot", f"last {min(6, len(re.split(r'[^A-Za-z0-9-]+', span)[-1]))}"]
        out += ["bare at"] * bool(re.search(r"\sat\s", span, re.I))
    elif kind == "ip":
        parts = [int(x) for x in re.findall("[0-9]+", span)]
        out += ["range" if all(x <= 255 for x in parts) else "no range", "dots" if span.count(".") == 3 else "no dots", "small" if max(parts) < 32 else "large"]
    else:
        groups = [len(x) for x in re.findall("[0-9]+", span)]
        seps = set(re.sub("[0-9]", "", span))
        out += [f"digits {len(digits)}", "groups " + "-".join(map(str, groups)) if len(groups) <= 5 else "many groups", f"separators {len(seps)}"]
        out += ["plus"] * span.startswith("+") + ["bracket"] * ("(" in span) + ["open bracket"] * (span.count("(") != span.count(")")) + ["one run"] * (len(groups) == 1)
        if kind == "card":
            out += ["luhn" if luhn(digits) else "no luhn", "first " + digits[0]]
    return [f"{kind} {x}" for x in out]


def segments(text: str) -> tuple[list[int], list[list[tuple[int, str, list[str]]]]]:
    """(atom bounds, for each end the candidate (start, kind, features))."""
    cut = [0, *[m.end() for m in _ATOM.finditer(text)]]
    ends: list[list[tuple[int, str, list[str]]]] = [[] for _ in cut]
    for i in range(len(cut) - 1):
        first = text[cut[i]]
        if not (first.isalnum() or first in "+("):
            continue
        if first.isalpha() and not re.search(r"@|\bat\b", text[cut[i] : cut[min(len(cut) - 1, i + MAX_ATOMS)]], re.I):
            continue
        for j in range(i + 1, min(len(cut), i + MAX_ATOMS + 1)):
            if not text[cut[j] - 1].isalnum():
                continue
            span = text[cut[i] : cut[j]]
            for kind in KINDS:
                if _LOOSE[kind].fullmatch(span):
                    before = re.findall(r"[^\W\d_]+", text[max(0, cut[i] - 40) : cut[i]])[-3:]
                    ends[j].append((i, kind, features(kind, span, text[max(0, cut[i] - 2) : cut[i]], text[cut[j] : cut[j] + 2], before)))
    return cut, ends


# ---- the model

_ALL = ("out", *KINDS)


def _score(weights: dict[str, float], names: list[str]) -> float:
    return sum(weights.get(n, 0.0) for n in names)


def _arcs(ends, j):
    """Segments that end at ``j``: the single atom outside, and the candidates."""
    return [(j - 1, "out", []), *ends[j]]


def decode(text: str, weights: dict[str, float]) -> list[tuple[str, int, int]]:
    """The best segmentation's (kind, start, end)."""
    cut, ends = segments(text)
    if not any(ends):
        return []
    best: list[dict[str, tuple[float, int, str]]] = [{"out": (0.0, 0, "")}]
    for j in range(1, len(cut)):
        row: dict[str, tuple[float, int, str]] = {}
        for i, kind, names in _arcs(ends, j):
            own = _score(weights, names)
            for last, (value, *_) in best[i].items():
                total = value + own + weights.get(f"{last}>{kind}", 0.0)
                if kind not in row or total > row[kind][0]:
                    row[kind] = (total, i, last)
        best.append(row)
    out, j, kind = [], len(cut) - 1, max(best[-1], key=lambda k: best[-1][k][0])
    while j:
        _, i, last = best[j][kind]
        if kind != "out":
            out.append((kind, cut[i], cut[j]))
        j, kind = i, last
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def _expected(cut, ends, weights) -> dict[str, float]:
    """Expected feature counts by forward-backward over segments."""
    n = len(cut) - 1
    arcs = [[]] + [[(i, k, f, _score(weights, f)) for i, k, f in _arcs(ends, j)] for j in range(1, n + 1)]
    step = {(a, b): weights.get(f"{a}>{b}", 0.0) for a in _ALL for b in _ALL}
    fore: list[dict[str, float]] = [{"out": 0.0}]
    for j in range(1, n + 1):
        into: dict[str, list[float]] = {}
        for i, k, _, s in arcs[j]:
            into.setdefault(k, []).extend(v + s + step[p, k] for p, v in fore[i].items())
        fore.append({k: _log_sum(v) for k, v in into.items()})
    back: list[dict[str, list[float]]] = [{} for _ in range(n + 1)]
    done: list[dict[str, float]] = [{} for _ in range(n + 1)]
    done[n] = dict.fromkeys(fore[n], 0.0)
    for j in range(n, 0, -1):
        if j < n:
            done[j] = {k: _log_sum(v) for k, v in back[j].items()}
        for i, k, _, s in arcs[j]:
            if k in done[j]:
                for p in fore[i]:
                    back[i].setdefault(p, []).append(done[j][k] + s + step[p, k])
    total, out = _log_sum(list(fore[n].values())), {}
    for j in range(1, n + 1):
        for i, k, names, s in arcs[j]:
            if k not in done[j]:
                continue
            for p, v in fore[i].items():
                chance = math.exp(v + s + step[p, k] + done[j][k] - total)
                if chance > 1e-9:
                    for f in [*names, f"{p}>{k}"]:
                        out[f] = out.get(f, 0.0) + chance
    return out


def _observed(cut, ends, spans) -> dict[str, float] | None:
    at, out, j, last = {c: i for i, c in enumerate(cut)}, {}, 0, "out"
    want = {at.get(a): (at.get(b), kind) for kind, a, b in spans}
    while j < len(cut) - 1:
        if j in want:
            to, kind = want[j]
            names = next((f for i, k, f in ends[to] if i == j and k == kind), None) if to else None
            if names is None:
                return None  # not a candidate
        else:
            to, kind, names = j + 1, "out", []
        for f in [*names, f"{last}>{kind}"]:
            out[f] = out.get(f, 0.0) + 1
        j, last = to, kind
    return out


def train(sample: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3) -> dict[str, float]:
    """Weights by adaptive gradient ascent on the regularised log-likelihood."""
    ready = []
    for text, spans in sample:
        cut, ends = segments(text)
        if any(ends) and (seen := _observed(cut, ends, spans)) is not None:
            ready.append((cut, ends, seen))
    weights: dict[str, float] = {}
    power: dict[str, float] = {}
    for _ in range(epochs):
        for cut, ends, seen in ready:
            want = _expected(cut, ends, weights)
            for f in {*seen, *want}:
                g = seen.get(f, 0.0) - want.get(f, 0.0) - decay * weights.get(f, 0.0)
                power[f] = power.get(f, 1e-6) + g * g
                weights[f] = weights.get(f, 0.0) + rate * g / math.sqrt(power[f])
    return weights


def generated(n: int, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled windows: usual spellings of the kinds, and look-alikes, between made-up words."""
    r = random.Random(seed)
    word = lambda a=2, b=9: "".join(r.choice("abcdefghiklmnoprstuvw") for _ in range(r.randint(a, b)))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def card(good: bool) -> str:
        while True:
            d = r.choice("3456") + num(r.choice((14, 15, 15, 15)))
            if luhn(d) == good:
                s = r.choice(("", "", " ", "-", "."))
                return s.join(d[i : i + 4] for i in range(0, len(d), 4))

    def phone() -> str:
        a, b, c = num(3), num(3), num(4)
        return r.choice((f"+{r.randint(1, 99)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"+{r.randint(1, 99)} {a} {b} {c}", f"+{r.randint(1, 99)}{a}{b}{c}"))

    def email() -> str:
        name, host, top = r.choice((word(), f"{word()}.{word()}", f"{word()}{num(2)}", f"{word()}.{num(2)}")), r.choice((word(), f"{word()}.{word()}")), r.choice(("com", "org", "net", "de", "info"))
        at, dot = r.choice((("@", "."), ("@", "."), (" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), (" @ ", ".")))
        return name + at + host.replace(".", dot) + dot + top

    def ip() -> str:
        return r.choice((".", ".", ".", ".", " dot ")).join(str(r.randint(0, 255) if k else r.randint(11, 255)) for k in range(4))

    noise = (
        lambda: f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}", lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1990, 2030)}",
        lambda: f"${num(3)}.{num(2)}", lambda: f"version {r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}", lambda: "order " + num(r.choice((7, 8, 9, 10, 12))),
        lambda: num(r.choice((1, 2, 3, 4, 5, 6, 16))) if r.random() < 0.7 else card(False), lambda: f"{num(3)}.{r.randint(256, 999)}.{num(3)}.{num(3)}", lambda: f"{r.randint(0, 23)}:{num(2)}:{num(2)}",
        lambda: f"at {word()}", lambda: f"isbn {num(3)}-{num(1)}-{num(2)}-{num(6)}-{num(1)}", lambda: f"pages {num(3)}-{num(3)}", lambda: word() + num(8), lambda: f"{num(3)},{num(3)},{num(3)}", lambda: f"v{num(1)}.{num(1)}.{num(1)}.{num(1)}",
        lambda: f"@{word()}", lambda: num(r.choice((20, 24, 30))), lambda: f"{word()} at {word()} dot", lambda: "".join(r.choice("0123456789abcdef") for _ in range(32)),
    )
    make = {"email": email, "ip": ip, "card": lambda: card(True), "phone": phone}
    out = []
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(r.randint(1, 4))), []
        for _ in range(r.randint(1, 3)):
            text += r.choice((" ", " ", ", ", ": ", "\n"))
            if r.random() < 0.55:
                kind = r.choice(KINDS)
                if r.random() < 0.3:
                    text += r.choice(sorted(_WORDS[kind])) + r.choice((" ", ": "))
                s = make[kind]()
                spans.append((kind, len(text), len(text) + len(s)))
                text += s
            else:
                text += r.choice(noise)()
            text += r.choice((" ", ". ", ", ", "\n")) + word()
        out.append((text, spans))
    return out


@functools.cache
def default_weights(seed: int = 11, size: int = TRAINING) -> dict[str, float]:
    return train(generated(size, seed))


def find(text: str, weights: dict[str, float]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, added spans)."""
    base = base_spans(text)
    held: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if held and a < held[-1][1]:
            held[-1][1] = max(held[-1][1], b)
        else:
            held.append([a, b])
    more = []
    for a, b in windows(text):
        for kind, s, e in decode(text[a:b], weights):
            k = bisect.bisect_left(held, [a + e]) - 1  # the last range that starts before the span's end
            if k < 0 or held[k][1] <= a + s:
                more.append((kind, a + s, a + e))
    return base, more


def written_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))


def scan(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, base, added) for every row: arrays of (kind, start, stop), places in code points."""
    model = weights or default_weights()
    span = "array<struct<kind:string,start:long,stop:long>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [find(t, model) for t in batch["text"].tolist()]
            rows = [[[{"kind": k, "start": a, "stop": b} for k, a, b in part] for part in both] for both in found]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "base": [x[0] for x in rows], "added": [x[1] for x in rows]})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInPandas(run, f"doc_id long, base {span}, added {span}")

