"""Personal data: fixed patterns, and gradient boosted trees over candidates that they miss.

Generators propose overlapping spans with high recall: addresses in plain or spelled-out form,
every run of digit groups that could be a number, groups of four, account numbers with a country. Boosted trees score a span's
format and context, a threshold calibrated on held-out texts selects. The trees are trained at the
start of each run on a bounded sample of texts: what the patterns find there and made-up personal
data of other formats, against all other candidates and made-up harmless numbers.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_batch, keyed_texts, made_up_texts, sample_texts, ship, texts_of

# Fixed patterns and their order.
KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: The training sample: texts at most, characters of a text at most.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 20_000
#: Fewer texts are not enough to train on: made-up ones are added.
LEAST_TEXTS = 40
SEED = 7
#: Pieces of each sample text that training puts made-up items into.
PIECES = 6
TREES = 100
DEPTH = 3
BINS = 24
RATE = 0.3
CERTAINTY = 0.95
SCORED = 50_000


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @: what stands before it cannot match without it."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            spans.append((start, end))
        at = text.find("@", max(at + 1, end))
    return spans


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind in the order of ``KINDS``, then start."""
    spans = [("email", s, e) for s, e in emails(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() < 16:
            continue
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return spans


SPELLED = re.compile(
    r"[\w.+-]{1,64}(?:(?:\s{1,2}dot\s{1,2}|\s{0,2}[(\[{]\s?dot\s?[)\]}]\s{0,2})[\w.+-]{1,64}){0,3}\s{0,2}(?:@|[(\[{]\s?at\s?[)\]}]|\sat\s)\s{0,2}[\w-]{1,63}"
    r"(?:(?:\.|\s{0,2}[(\[{]\s?dot\s?[)\]}]\s{0,2}|\s{1,2}dot\s{1,2})[\w-]{1,63}){1,4}", re.I)
MAY_SPELL = re.compile(r"@|[(\[{]\s?at\s?[)\]}]|\sdot\s", re.I)
CHAIN = re.compile(r"[+(]{0,2}[0-9]++(?:[ ().\-/]{1,2}[0-9]++)*+")
GROUP = re.compile(r"[0-9]+")
FOURS = re.compile(r"(?<![0-9])[0-9]{1,3}(?:[\[({ ]{0,2}[.:][\])} ]{0,2}[0-9]{1,3}){3}(?![0-9])")
LEAST_DIGITS, MOST_DIGITS = 7, 19
ACCOUNT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ -]?+[A-Z0-9]{1,4}+){3,8}+(?![A-Za-z0-9])")
GENERATORS = ("gb_email", "gb_number", "gb_ip", "gb_account")


def candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(generator, start, end); spans overlap."""
    if MAY_SPELL.search(text):
        for m in SPELLED.finditer(text):
            yield 0, *m.span()
    for m in CHAIN.finditer(text):
        if m.end() - m.start() < LEAST_DIGITS:
            continue
        groups = [g.span() for g in GROUP.finditer(text, *m.span())]
        for i, (first, _) in enumerate(groups):
            n = 0
            for s, e in groups[i:]:
                n += e - s
                if n > MOST_DIGITS:
                    break
                if n >= LEAST_DIGITS:
                    start = first
                    while start > m.start() and text[start - 1] in "+(":
                        start -= 1
                    yield 1, start, e
    for m in FOURS.finditer(text):
        yield 2, *m.span()
    for m in ACCOUNT.finditer(text):
        yield 3, *m.span()


def checked_account(text: str) -> bool:
    """The check digits of an international account number: its letters as numbers, remainder 1 by 97."""
    plain = "".join(c for c in text if c.isalnum())
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


CONTEXT = [re.compile(p, re.I) for p in (
    r"\b(?:tel|phone|call|mobile|cell|fax|whatsapp|sms|dial)", r"\b(?:e-?mail|mail|contact|reach|write)",
    r"\b(?:card|visa|credit|debit|payment|mastercard|amex|iban|account)", r"\b(?:ip|host|server|address|addr|client|login)\b",
    r"\b(?:order|invoice|no|nr|number|isbn|version|ver|build|page|total|price|id|ref|serial)\b|[#$€£]\s?$",
    r"\b(?:ssn|social|passport|licen[cs]e|insurance|tax|born|birth)")]


# Common ends of host names.
TOP_LEVELS = ("com", "org", "net", "edu", "gov", "info", "io", "co", "uk", "de", "fr", "es", "it", "eu", "ch")
SIGNS_BEFORE = re.compile(r"[0-9]([ ().\-/]{1,2})$")
SIGNS_AFTER = re.compile(r"([ ().\-/]{1,2})[0-9]")


def border(match: re.Match | None, signs: set[str]) -> int:
    """Whether more digits stand beside a span: none, past a sign that it has inside too, past another."""
    return 0 if match is None else 2 if match[1] in signs else 1


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span = text[start:end]
    groups = [g for g in GROUP.findall(span)]
    sizes = [len(g) for g in groups] or [0]
    digits = "".join(groups)
    before, after = text[max(0, start - 24):start], text[end:end + 12]
    left, right = before[-1:], after[:1]
    signs = set(re.findall(r"[^0-9]+", span.strip("+(")))
    date = len(groups) == 3 and sorted(sizes) in ([2, 2, 4], [1, 2, 4], [1, 1, 4]) and (
        sizes[0] == 4 or sizes[2] == 4) and all(int(g) <= 31 for g in groups if len(g) < 4)
    return [
        kind, len(span), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        span.startswith("+") or span.startswith("(+"), "(" in span, "@" in span, span.count("."), span.count("-"),
        span.count(" "), span.count("/"), len(digits) >= 12 and luhn(digits),
        sizes[len(sizes) // 2], max(sizes) == min(sizes), len(signs),
        span.lower().endswith(TOP_LEVELS), digits.startswith("00"), digits.startswith("0"), kind == 3 and checked_account(span),
        len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups), int(digits[:1] or 0), date,
        *[bool(c.search(before)) for c in CONTEXT],
        left.isalnum() or left in "._-/@" and bool(left), right.isalnum() or right in "_/@" and bool(right),
        border(SIGNS_BEFORE.search(before), signs), border(SIGNS_AFTER.match(after), signs), "(" in signs or ")" in signs,
        left in "$€£#" and bool(left), bool(re.match(r"\s?[%€$£]", after)), " at " in span.lower() or "(at)" in span.lower() or "[at]" in span.lower()]


class BoostedTrees:
    """Binary boosting on binned features; a tree of depth ``DEPTH`` is two lists of inner nodes and one of leaves."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
        binned = self._bin(x)
        self.start = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        self.trees: list[tuple[list[int], list[int], list[float]]] = []
        score = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += np.array(tree[2])[leaf]

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, column, side="left") for e, column in zip(self.edges, x.T, strict=True)], axis=1)

    def _grow(self, binned: np.ndarray, gradient: np.ndarray, curve: np.ndarray):
        column, cut = [], []
        place = np.zeros(len(binned), int)
        for depth in range(DEPTH):
            for node in range(1 << depth):
                rows = np.flatnonzero(place == node)
                best = 0.0, 0, BINS
                for f in range(binned.shape[1]):
                    g = np.cumsum(np.bincount(binned[rows, f], gradient[rows], BINS + 1))
                    c = np.cumsum(np.bincount(binned[rows, f], curve[rows], BINS + 1))
                    gain = g ** 2 / (c + 1) + (g[-1] - g) ** 2 / (c[-1] - c + 1) - g[-1] ** 2 / (c[-1] + 1)
                    at = int(gain[:-1].argmax())
                    if gain[at] > best[0] + 1e-9:
                        best = float(gain[at]), f, at
                column.append(best[1])
                cut.append(best[2])
            first = (1 << depth) - 1
            node = first + place
            place = 2 * place + (binned[np.arange(len(binned)), np.array(column)[node]] > np.array(cut)[node])
        leaves = 1 << DEPTH
        g, c = np.bincount(place, gradient, leaves), np.bincount(place, curve, leaves)
        return (column, cut, (RATE * g / (c + 1)).tolist()), place

    def score(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self._bin(x), np.arange(len(x))
        out = np.full(len(x), self.start)
        for column, cut, leaves in self.trees:
            column, cut, place = np.array(column), np.array(cut), np.zeros(len(x), int)
            for depth in range(DEPTH):
                node = (1 << depth) - 1 + place
                place = 2 * place + (binned[rows, column[node]] > cut[node])
            out += np.array(leaves)[place]
        return out


def calibrated_threshold(scores: np.ndarray, labels: np.ndarray, certainty: float = CERTAINTY) -> float:
    """The least score whose calibrated probability (isotonic, on held-out labels) is ``certainty``."""
    order = np.argsort(scores, kind="stable")
    pools: list[list[float]] = []  # hits, rows, least score
    for s, y in zip(scores[order], labels[order], strict=True):
        pools.append([float(y), 1.0, float(s)])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            hits, rows, _ = pools.pop()
            pools[-1][0] += hits
            pools[-1][1] += rows
    good = [least for hits, rows, least in pools if hits >= certainty * rows]
    return min(good) if good else float("inf")


class Detector:
    """Trees and the threshold of each generator."""

    def __init__(self, texts: list[str]):
        rng = random.Random(SEED)
        x, y, fold = [], [], []
        for n, text in enumerate(texts):
            for shown, planted in _planted(rng, text):
                real = {(s, e) for _, s, e in base_spans(shown)} | planted
                for kind, s, e in candidates(shown):
                    x.append(features(shown, kind, s, e))
                    y.append((s, e) in real)
                    fold.append(n % 4 == 3)
        self.trees, self.limits = None, [float("inf")] * len(GENERATORS)
        if not any(y) or all(y):
            return
        x, y, held = np.array(x, float), np.array(y, float), np.array(fold)
        if not y[~held].any() or not held.any():
            return
        self.trees = BoostedTrees(x[~held], y[~held])
        scores = self.trees.score(x[held])
        for kind in range(len(GENERATORS)):
            own = x[held][:, 0] == kind
            if own.any():
                self.limits[kind] = calibrated_threshold(scores[own], y[held][own])

    def found(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """Spans selected in each text: the best of overlapping ones, without what fixed patterns cover."""
        out: list[list[tuple[float, int, int, int]]] = [[] for _ in texts]
        held: list[tuple[int, int, int, int]] = []

        def score() -> None:
            if held:
                x = np.array([features(texts[n], k, s, e) for n, k, s, e in held], float)
                for (n, k, s, e), value in zip(held, self.trees.score(x).tolist(), strict=True):
                    if value >= self.limits[k]:
                        out[n].append((-value, s - e, s, k))
                held.clear()

        for n, text in enumerate(texts if self.trees else []):
            for k, s, e in candidates(text):
                held.append((n, k, s, e))
                if len(held) >= SCORED:
                    score()
        score()
        return [_best(chosen, text) for chosen, text in zip(out, texts, strict=True)]


def _best(chosen: list[tuple[float, int, int, int]], text: str) -> list[tuple[str, int, int]]:
    """Spans in order of their scores, without those that overlap a better one.

    Of a span that reaches beyond fixed patterns, only what these leave is given: patterns and
    spans stay apart, and together they cover all of it.
    """
    if not chosen:
        return []
    taken = sorted((s, e) for _, s, e in base_spans(text))
    fixed: list[tuple[int, int]] = []
    for s, e in taken:
        if fixed and s <= fixed[-1][1]:
            fixed[-1] = fixed[-1][0], max(e, fixed[-1][1])
        else:
            fixed.append((s, e))
    fixed_starts, fixed_ends = [s for s, _ in fixed], [e for _, e in fixed]
    held: list[tuple[int, int]] = []
    starts: list[int] = []
    spans = []
    for _, size, s, k in sorted(chosen):
        e = s - size
        place = bisect.bisect_left(starts, s)
        if place and held[place - 1][1] > s or place < len(held) and held[place][0] < e:
            continue
        at, left = s, []
        for n in range(bisect.bisect_right(fixed_ends, s), bisect.bisect_left(fixed_starts, e)):
            a, b = fixed[n]
            if a > at:
                left.append((at, a))
            at = max(at, b)
        if at < e:
            left.append((at, e))
        left = [(a, b) for a, b in left if any(c.isalnum() for c in text[a:b])]
        if left:
            held.insert(place, (s, e))
            starts.insert(place, s)
            spans += [(GENERATORS[k], a, b) for a, b in left]
    return spans


def _text(rng: random.Random, n: int, chars: str = "abcdeghilmnorstu") -> str:
    return "".join(rng.choice(chars) for _ in range(n))


def _digit_text(rng: random.Random, n: int) -> str:
    return _text(rng, n, "0123456789")


def _checked(rng: random.Random, n: int, good: bool = True) -> str:
    """``n`` digits whose last one does or does not fulfil the check of card numbers."""
    body = _digit_text(rng, n - 1)
    return next(body + c for c in rng.sample("0123456789", 10) if luhn(body + c) == good)


def _grouped(rng: random.Random, digits: str, sizes: list[int] | None = None) -> str:
    """Digits in groups of the sizes, or of two to four, with one separator."""
    parts, at = [], 0
    for size in sizes or [rng.randint(2, 4) for _ in digits]:
        if at < len(digits):
            parts.append(digits[at:at + size])
            at += size
    return rng.choice([" ", "-", ".", "/"]).join(parts)


def _phone(rng: random.Random) -> str:
    """A number in one of many national ways: groups of two to four, a code in front, brackets."""
    rest = _grouped(rng, _digit_text(rng, rng.randint(6, 9)))
    return rng.choice([
        lambda: rest, lambda: "0" + rest, lambda: rng.choice("1378") + rng.choice(" -.") + rest, lambda: f"({_digit_text(rng, rng.randint(2, 4))}) {rest}",
        lambda: f"00{_digit_text(rng, 2)} {rest}", lambda: f"00{_digit_text(rng, 2)} (0) {rest}", lambda: f"+{_digit_text(rng, 2)} (0) {rest}",
        lambda: f"0{_digit_text(rng, rng.randint(1, 4))}{rng.choice('/- ')}{_digit_text(rng, rng.randint(5, 8))}"])()


def _account(rng: random.Random, good: bool = True) -> str:
    """An international account number with right or wrong check digits."""
    country = _text(rng, 2, "ABCDEFGHIKLMNPRST")
    body = _text(rng, rng.choice([0, 4]), "ABCDEFGHIKLMNPRST") + _digit_text(rng, rng.randint(12, 20))
    checks = [f"{n:02}" for n in range(2, 99) if checked_account(f"{country}{n:02}{body}") == good]
    plain = country + rng.choice(checks) + body
    return plain if rng.random() < 0.5 else " ".join(plain[i:i + 4] for i in range(0, len(plain), 4))


def _made_up(rng: random.Random) -> tuple[str, str]:
    """(lead, personal data) of formats that the fixed patterns do not have."""
    d, w = lambda n: _digit_text(rng, n), lambda n: _text(rng, n)
    card = _checked(rng, 16)
    short = _checked(rng, rng.randint(13, 19))
    return rng.choice([
        lambda: (rng.choice(["call ", "tel. ", "phone: ", ""]), f"({d(3)}) {d(3)}-{d(4)}"),
        lambda: (rng.choice(["mobile ", "fax ", "phone "]), f"{d(3)}-{d(3)}-{d(4)}"),
        lambda: (rng.choice(["mobile ", "tel ", "call "]), f"0{d(2)} {d(3)} {d(2)} {d(2)}"),
        *[lambda: (rng.choice(["mobile ", "tel ", "call ", "phone ", "fax: ", "dial ", "call me on ", "my phone is "]), _phone(rng))] * 3,
        lambda: ("", f"({d(3)}) {d(3)}-{d(4)}"), lambda: ("", f"+{d(2)} {d(3)} {d(6)}"), lambda: ("", f"+1 ({d(3)}) 555-{d(4)}"),
        lambda: (rng.choice(["mail ", "contact ", ""]), f"{w(6)} (at) {w(5)} (dot) com"),
        lambda: (rng.choice(["write to ", "", "e-mail: "]), f"{w(4)}.{w(5)}[at]{w(6)}[dot]org"),
        lambda: (rng.choice(["", "reach "]), f"{w(5)} at {w(6)} dot net"), lambda: ("", f"{w(5)}.{d(2)}@{w(5)}.example.com"),
        lambda: (rng.choice(["", "reach "]), f"{w(6)} dot {w(rng.randint(1, 7))} at {w(6)} dot org"),
        lambda: (rng.choice(["card ", "visa ", ""]), f"{card[:4]} {card[4:8]} {card[8:12]} {card[12:]}"),
        lambda: (f"{card} ", card), lambda: ("", card), lambda: (rng.choice(["card ", "visa: "]), f"{card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]}"),
        lambda: (rng.choice(["card ", "credit card: ", "debit card no. "]), rng.choice([short, _grouped(rng, short, [4, 4, 4, 4, 4])])),
        lambda: (rng.choice(["ip ", "host ", "server "]), "[.]".join(str(rng.randint(1, 255)) for _ in range(4))),
        lambda: ("", ".".join(str(rng.randint(1, 255)) for _ in range(4))),
        lambda: (rng.choice(["ssn ", "social security "]), f"{d(3)}-{d(2)}-{d(4)}"),
        lambda: (rng.choice(["ssn ", "social security number ", "tax number ", "insurance number "]), _grouped(rng, d(rng.randint(8, 11)))),
        lambda: (rng.choice(["", "account ", "iban: "]), _account(rng))])()


def _harmless(rng: random.Random) -> str:
    d, w = lambda n: _digit_text(rng, n), lambda n: _text(rng, n)
    wrong = _checked(rng, 16, False)
    return rng.choice([
        lambda: f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}",
        lambda: f"{rng.randint(1, 28):02}/{rng.randint(1, 12):02}/{rng.randint(1900, 2030)}",
        lambda: f"order {d(rng.randint(7, 12))}", lambda: f"invoice no. {d(5)}-{d(4)}", lambda: f"# {d(8)}", lambda: f"${d(3)},{d(3)}.{d(2)}",
        lambda: f"version {d(1)}.{d(2)}.{d(3)}.{d(4)}", lambda: f"ISBN {d(3)}-{d(1)}-{d(4)}-{d(4)}-{d(1)}", lambda: d(rng.randint(7, 11)),
        lambda: wrong, lambda: f"{wrong[:4]} {wrong[4:8]} {wrong[8:12]} {wrong[12:]}", lambda: f"{rng.randint(1, 99)}.{d(6)}, {rng.randint(1, 99)}.{d(6)}",
        lambda: f"{rng.randint(256, 999)}.{d(3)}.{d(3)}.{d(3)}", lambda: f"{d(2)}:{d(2)}:{d(2)} {d(4)}", lambda: f"{d(4)} {d(4)}",
        *[lambda: f"{rng.choice(['order', 'invoice', 'serial', 'ref', 'part no.', 'page', 'build', 'total'])} {_grouped(rng, d(rng.randint(7, 14)))}"] * 2,
        lambda: _account(rng, False),
        lambda: f"{w(4)} at {w(5)} {w(6)}", lambda: f"{w(5)} at {w(4)} dot {w(rng.randint(2, 7))}", lambda: f"{w(4)} dot {w(5)}", lambda: f"{w(5)} @ {w(4)}. {w(6)}", lambda: f"pages {d(3)}-{d(3)}, {d(4)}",
        lambda: " ".join(d(rng.randint(1, 3)) for _ in range(6))])()


def _planted(rng: random.Random, text: str) -> Iterator[tuple[str, set[tuple[int, int]]]]:
    """The text as it is, and pieces of it with made-up personal data and harmless numbers put in."""
    yield text, set()
    words = text.split()
    for _ in range(PIECES):
        at = rng.randrange(len(words)) if words else 0
        parts = [(w, False) for w in words[at:at + 40]]
        for _ in range(2):
            lead, data = _made_up(rng)
            place = rng.randint(0, len(parts))
            parts[place:place] = [(p, False) for p in lead.split()] + [(data, True)]
            parts.insert(rng.randint(0, len(parts)), (_harmless(rng), False))
        shown, planted = "", set()
        for part, real in parts:
            if real:
                planted.add((len(shown), len(shown) + len(part)))
            shown += part + " "
        yield shown, planted


def training_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_TEXTS) -> list[str]:
    """A bounded sample of the texts, made up to ``LEAST_TEXTS`` where there are fewer."""
    texts = sample_texts(docs, doc_id, text, most, SAMPLE_CHARS)
    return texts + made_up_texts(LEAST_TEXTS - len(texts), SEED)


def shown(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


FOUND = pa.schema([
    ("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])
RUN_CHARS = 2_000_000


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", detector: Detector | None = None) -> DataFrame:
    """doc_id, pattern matches per kind, a digest of them, and all spans (code points, end exclusive) by kind, then start.

    Spans of the trees are of kinds ``gb_email``, ``gb_number``, ``gb_ip`` and ``gb_account`` and overlap no other
    span; of what reaches beyond a fixed pattern, the parts around it are given. A null text counts
    as empty; null ids and repeated rows stay; other columns are not read; an empty table gives no
    rows.
    """
    ship(docs.sparkSession)
    detector = detector or Detector(training_texts(docs, doc_id, text))
    order = (*KINDS, *GENERATORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, str]] = []

        def out() -> pa.RecordBatch:
            rows = []
            for (key, value), more in zip(held, detector.found([t for _, t in held]), strict=True):
                base = base_spans(value)
                spans = sorted(base + more, key=lambda s: (order.index(s[0]), s[1]))
                rows.append((key, *[sum(s[0] == k for s in base) for k in KINDS],
                             hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans)))
            held.clear()
            return as_batch(rows, FOUND)

        for batch in batches:
            size = 0
            for key, value in texts_of(batch):
                held.append((key, value))
                size += len(value)
                if size >= RUN_CHARS:
                    yield out()
                    size = 0
            yield out()

    return keyed_texts(docs, doc_id, text).mapInArrow(run, "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, "
                                                           "n_phone bigint, base_sha256 string, spans string")
