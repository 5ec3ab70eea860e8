"""Secret scan: fixed patterns, and a linear-chain conditional random field for what they miss.

Tokens are tagged as the begin of a secret, its inside or outside. A token's score comes from its
own shape and length, how often its characters change class, the kinds of its neighbours and a
feature of the whole text; transitions tie neighbouring tags, and Viterbi finds the best tags. The field is trained at the start of each run
on a bounded sample of texts: their pattern matches are labels, and made-up secrets of many formats
are put between their words. Texts in which no run of tokens can outweigh "all outside" are proven
clean by a bound over their summed scores and need no Viterbi.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import as_batch, keyed_texts, made_up_texts, sample_texts, ship, texts_of

# Fixed patterns and their order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

OUT, BEGIN, INSIDE = range(3)
TOKEN = re.compile(r"[\w+/-][\w+/.-]*={0,2}|[^\w\s]")
KEYWORDS = re.compile(r"pass(?:word|wd|phrase)?|secret|token|api_?key|access_?key|auth(?:orization)?|bearer|credential|private_?key", re.I)
#: The training sample: texts at most, characters of a text at most.
SAMPLE_TEXTS = 400
SAMPLE_CHARS = 20_000
#: Fewer texts are not enough to train on: made-up ones are added.
LEAST_TEXTS = 40
SEQUENCE = 100
SEED = 11
ROUNDS = 100
RATE = 0.3
RIDGE = 1e-3
KEPT_WORDS = 400_000


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, by start, then kind in the order of ``KINDS``."""
    spans = []
    if "k" in text or "K" in text or any(c in text for c in "pPsStT"):
        low = text.lower()
        if any(w in low for w in ASSIGN_WORDS):
            spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


SHAPES = ("lower", "title", "upper", "letters", "digits", "hex", "lower_digits", "upper_digits", "all_digits",
          "joined", "coded", "foreign", "quote", "equals", "other")
LENGTHS = (1, 3, 7, 11, 15, 19, 23, 31, 39, 63)
KIND_NAMES = (*SHAPES, "keyword", "long", "edge")
FILE_CLASSES = 4
RUN = re.compile(r"[A-Za-z0-9]+")
#: Changes of character class in a run, and characters of that run, from which the next class of grain begins.
GRAIN_CHANGES = (1, 3, 5, 8)
GRAIN_LENGTHS = (8, 14, 20)
GRAINS = (len(GRAIN_CHANGES) + 1) * (len(GRAIN_LENGTHS) + 1)


def grain_of(word: str) -> int:
    """How mixed a token's most mixed run of letters and digits is, with the run's length.

    Dashes and low lines are left out, as keys hold them among their characters. Random strings change between capitals, small letters and digits every other character;
    names and numbers joined by signs do so at most once a part.
    """
    best = 0
    for run in RUN.findall(word.replace("-", "").replace("_", "")):
        classes = ["d" if c.isdigit() else "u" if c.isupper() else "l" for c in run]
        # One capital and small letters after it are a word.
        changes = sum(a != b and (a, b) != ("u", "l") for a, b in zip(classes, classes[1:]))
        changes = bisect.bisect_right(GRAIN_CHANGES, changes)
        best = max(best, changes * (len(GRAIN_LENGTHS) + 1) + bisect.bisect_right(GRAIN_LENGTHS, len(run)))
    return best


def shape_of(word: str) -> int:
    """What a token is made of; a full stop at its end does not count."""
    bare = word.rstrip("=").rstrip(".")
    if not bare or not any(c.isalnum() for c in bare):
        name = "quote" if word in "\"'`" else "equals" if word in "=:" else "other"
    elif not bare.isascii():
        name = "foreign"
    elif bare.isalnum():
        if bare.isdigit():
            name = "digits"
        elif bare.isalpha():
            name = "lower" if bare.islower() else "upper" if bare.isupper() else "title" if bare[1:].islower() else "letters"
        elif bare.islower():
            name = "hex" if all(c in "0123456789abcdef" for c in bare) else "lower_digits"
        else:
            name = "upper_digits" if bare.isupper() else "all_digits"
    else:
        digits = any(c.isdigit() for c in bare)
        name = "coded" if digits and any(c.isalpha() for c in bare) else "joined"
    return SHAPES.index(name)


def traits(word: str) -> int:
    """Shape and length as one number, the grain, and the kind that neighbours see, packed together."""
    shape = shape_of(word)
    size = len(word.rstrip("."))
    length = next((i for i, most in enumerate(LENGTHS) if size <= most), len(LENGTHS))
    if KEYWORDS.search(word):
        kind = KIND_NAMES.index("keyword")
    elif size > 15 and shape not in (SHAPES.index("lower"), SHAPES.index("foreign")):
        kind = KIND_NAMES.index("long")
    else:
        kind = shape
    return ((shape * (len(LENGTHS) + 1) + length) * 32 + grain_of(word)) * 32 + kind


OWN = len(SHAPES) * (len(LENGTHS) + 1)
EDGE = KIND_NAMES.index("edge")
_known: dict[str, int] = {}


def trait_array(words: list[str]) -> np.ndarray:
    found = list(map(_known.get, words))
    if None in found:
        if len(_known) > KEPT_WORDS:
            _known.clear()
        for i, t in enumerate(found):
            if t is None:
                found[i] = _known[words[i]] = traits(words[i])
    return np.array(found, np.int32)


def file_class(text: str) -> int:
    """How much the text looks like code: its share of assignment and bracket characters."""
    marks = sum(map(text.count, "={};"))
    share = marks / max(1, len(text))
    return int(np.searchsorted([0.0001, 0.005, 0.02], share))


class Field:
    """Weights of the random field and what is done with them."""

    #: Neighbours by their distance.
    AROUND = (-1, -2, -3, 1)

    def __init__(self):
        self.own = np.zeros((OWN, 3))
        self.grain = np.zeros((GRAINS, 3))
        self.around = [np.zeros((len(KIND_NAMES), 3)) for _ in self.AROUND]
        self.file = np.zeros((FILE_CLASSES, 3))
        self.moves = np.zeros((3, 3))

    def parameters(self) -> list[np.ndarray]:
        return [self.own, self.grain, *self.around, self.file, self.moves]

    @staticmethod
    def neighbours(kinds: np.ndarray, distance: int) -> np.ndarray:
        out = np.full(len(kinds), EDGE)
        if distance < 0:
            out[-distance:] = kinds[:distance]
        else:
            out[:-distance] = kinds[distance:]
        return out

    def scores(self, traits: np.ndarray, file: int) -> np.ndarray:
        kinds = traits & 31
        out = self.own[traits >> 10] + self.grain[traits >> 5 & 31] + self.file[file]
        for distance, weights in zip(self.AROUND, self.around, strict=True):
            out += weights[self.neighbours(kinds, distance)]
        return out

    def may_hold_secret(self, scores: np.ndarray) -> bool:
        """False if no tags beat "all outside".

        A run of tokens that are not outside gains at most its tokens' gains and one move each,
        plus the move back, so the best sum of neighbouring tokens decides.
        """
        gains = self.moves - self.moves[OUT, OUT]
        gains[OUT, OUT] = -np.inf
        move = gains.max()
        gain = scores[:, 1:].max(axis=1) - scores[:, OUT] + move
        if gain.max() <= min(0, -move):
            return False
        sums = np.concatenate([[0.0], np.cumsum(gain)])
        return bool((sums[1:] - np.minimum.accumulate(sums[:-1])).max() + move > 0)

    def viterbi(self, scores: np.ndarray) -> list[int]:
        """The best tags; before the first and after the last token stands "outside"."""
        moves = self.moves.tolist()
        best, back = [0.0, -1e18, -1e18], []
        for row in scores.tolist():
            now, came = [], []
            for tag in range(3):
                ways = [best[b] + moves[b][tag] for b in range(3)]
                b = ways.index(max(ways))
                now.append(ways[b] + row[tag])
                came.append(b)
            best = now
            back.append(came)
        last = [best[t] + moves[t][OUT] for t in range(3)]
        tag = last.index(max(last))
        tags = []
        for came in reversed(back):
            tags.append(tag)
            tag = came[tag]
        return tags[::-1]

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Start and end of each secret that the tags show."""
        words = TOKEN.findall(text)
        if not words:
            return []
        scores = self.scores(trait_array(words), file_class(text))
        if not self.may_hold_secret(scores):
            return []
        found: list[tuple[int, int]] = []
        before = OUT
        for m, tag in zip(TOKEN.finditer(text), self.viterbi(scores), strict=True):
            end = m.start() + len(m[0].rstrip("."))
            if tag == BEGIN or tag == INSIDE and before == OUT:
                found.append((m.start(), end))
            elif tag == INSIDE:
                found[-1] = found[-1][0], end
            before = tag
        return found


def _some(rng: random.Random, chars: str, n: int) -> str:
    return "".join(rng.choice(chars) for _ in range(n))


def _secret(rng: random.Random) -> str:
    """A made-up key of one of several families; issuers' own prefixes are few, most are random letters."""
    letters = string.ascii_letters + string.digits
    prefix = _some(rng, string.ascii_letters, rng.randint(2, 6))
    return rng.choice([
        lambda: _some(rng, "0123456789abcdef", rng.choice([24, 32, 40, 64])),
        lambda: "AKIA" + _some(rng, string.ascii_uppercase + string.digits, 16),
        lambda: _some(rng, letters + "+/", rng.randint(32, 110)) + rng.choice(["", "=", "=="]),
        lambda: "sk_live_" + _some(rng, letters, 24), lambda: "ghp_" + _some(rng, letters, 36),
        lambda: "xoxb-" + _some(rng, string.digits, 12) + "-" + _some(rng, letters, 24),
        lambda: ".".join(["eyJ" + _some(rng, letters, 17), "eyJ" + _some(rng, letters, 40), _some(rng, letters + "_-", 43)]),
        lambda: _some(rng, letters, rng.randint(20, 44)),
        lambda: prefix + rng.choice("-_.") + _some(rng, letters + rng.choice(["", "-_"]), rng.randint(16, 64)),
        lambda: prefix + rng.choice("-_.") + _some(rng, string.ascii_lowercase + string.digits, rng.randint(20, 40)),
        lambda: f"//{prefix.lower()}.example.com/{_some(rng, string.ascii_lowercase, 5)}/{_some(rng, letters, rng.randint(18, 40))}",
        ])()


def _password(rng: random.Random) -> str:
    """A chosen password: a word with digits, or ten mixed characters."""
    word = _some(rng, "abcdeghilmnorstu", rng.randint(5, 9))
    return rng.choice([
        lambda: word + _some(rng, string.digits, rng.randint(2, 4)), lambda: word.capitalize() + _some(rng, string.digits, 2),
        lambda: _some(rng, string.ascii_letters + string.digits, rng.randint(8, 14))])()


#: What stands around a chosen password, which nothing but its place tells from a name.
PASSWORD_LEADS = ("password is {}", "passphrase is {}", "the password: {}", "passwd {}", "pass: {}", "my password is {}",
                  "amqp://{user}:{}@{host}", "redis://{user}:{}@{host}", "ftp://{user}:{}@{host}", "https://{user}:{}@{host}")


def _harmless(rng: random.Random) -> str:
    digits = lambda n: _some(rng, string.digits, n)
    word = lambda n: _some(rng, "aeinorst", n)
    return rng.choice([
        lambda: digits(rng.randint(1, 19)), lambda: word(rng.randint(14, 40)), lambda: f"{digits(4)}-{digits(2)}-{digits(2)}",
        lambda: ".".join(digits(rng.randint(1, 3)) for _ in range(4)), lambda: f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}",
        lambda: f"{word(8)}.{digits(2)}@{word(5)}.example.com", lambda: f"https://www.{word(9)}.com/{word(7)}/{digits(5)}.html",
        lambda: "-".join(word(rng.randint(2, 9)) for _ in range(4)), lambda: word(9).upper(), lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}",
        lambda: f"{word(5)}_{word(8)}_{word(4)}", lambda: f"{word(6)} = {digits(3)}", lambda: f"{word(6)}: {word(11)}",
        lambda: f"{word(3).upper()}_{digits(8)}_{digits(6)}.jpg", lambda: word(4) + "".join(word(rng.randint(3, 7)).title() for _ in range(3)),
        lambda: f"{word(2).upper()}-{digits(4)}{word(1).upper()}", lambda: f"{word(6)}{digits(2)}",
        lambda: f"https://{word(5)}.org/{word(6)}-{word(5)}-{digits(4)}/{word(8)}?{word(4)}={digits(6)}",
        lambda: f"password {word(6)}", lambda: f"the secret {word(3)} {word(7)}", lambda: f"{word(4)}://{word(6)}.{word(4)}:{digits(4)}/{word(5)}"])()


def _sequences(texts: list[str]) -> list[tuple[list[str], list[int], int]]:
    """Tokens, tags and file class of training sequences made from sample texts."""
    rng = random.Random(SEED)
    lead = ["{}", "{}", "key {}", "Bearer {}", 'api_key = "{}"', "password: {}", "secret={}", "token = '{}'",
            "Authorization: Bearer {}", "AWS_SECRET_ACCESS_KEY={}", '"private_key": "{}"', "credential {}"]
    made = []
    for text in texts:
        words = text.split()
        for _ in range(3):
            at = rng.randrange(len(words)) if words else 0
            piece = words[at:at + 60]
            marks: list[str] = []
            for _ in range(rng.randint(0, 2)):
                chosen = rng.random() < 0.2
                marks.append(_password(rng) if chosen else _secret(rng))
                names = {n: _some(rng, "abcdeghilmnorstu", rng.randint(3, 8)) for n in ("user", "host")}
                piece.insert(rng.randint(0, len(piece)), rng.choice(PASSWORD_LEADS if chosen else lead).format(marks[-1], **names))
            for _ in range(rng.randint(0, 3)):
                piece.insert(rng.randint(0, len(piece)), _harmless(rng))
            shown = " ".join(piece)
            held = [(shown.index(m), shown.index(m) + len(m)) for m in marks]
            held += [(s, e) for kind, s, e in base_spans(shown) if kind != "assign"]
            tokens, tags, before = [], [], None
            for m in list(TOKEN.finditer(shown))[:SEQUENCE]:
                inside = next(((s, e) for s, e in held if m.start() < e and m.end() > s), None)
                tokens.append(m[0])
                tags.append(OUT if inside is None else INSIDE if inside == before else BEGIN)
                before = inside
            if tokens:
                made.append((tokens, tags, file_class(text)))
    return made


def train(texts: list[str]) -> Field:
    """Weights of highest likelihood on sequences from the texts, by gradient steps of own size per weight."""
    field, data = Field(), _sequences(texts)
    if not data:
        return field
    longest = max(len(tokens) for tokens, _, _ in data)
    shape = len(data), longest
    used, own, grain, tags = np.zeros(shape, bool), np.zeros(shape, int), np.zeros(shape, int), np.zeros(shape, int)
    files = np.array([f for _, _, f in data])
    near = [np.full(shape, EDGE) for _ in Field.AROUND]
    for s, (tokens, gold, _) in enumerate(data):
        t, n = trait_array(tokens), len(tokens)
        used[s, :n], own[s, :n], grain[s, :n], tags[s, :n] = True, t >> 10, t >> 5 & 31, gold
        for d, distance in enumerate(Field.AROUND):
            near[d][s, :n] = Field.neighbours(t & 31, distance)
    lengths = used.sum(axis=1)
    every = np.arange(len(data))
    parameters = field.parameters()
    mean, square = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    gold = np.eye(3)[tags] * used[:, :, None]
    for step in range(1, ROUNDS + 1):
        scores = field.own[own] + field.grain[grain] + field.file[files][:, None, :]
        for weights, at in zip(field.around, near, strict=True):
            scores = scores + weights[at]
        scores = scores * used[:, :, None]
        moves = field.moves
        forward = np.zeros((*shape, 3))
        forward[:, 0] = scores[:, 0] + moves[OUT]
        for i in range(1, longest):
            ways = forward[:, i - 1, :, None] + moves
            forward[:, i] = np.logaddexp.reduce(ways, axis=1) + scores[:, i]
        backward = np.zeros((*shape, 3))
        backward[:] = moves[:, OUT]
        for i in range(longest - 2, -1, -1):
            ways = moves + (scores[:, i + 1] + backward[:, i + 1])[:, None, :]
            backward[:, i] = np.where((lengths > i + 1)[:, None], np.logaddexp.reduce(ways, axis=2), moves[:, OUT])
        total = np.logaddexp.reduce(forward[every, lengths - 1] + moves[:, OUT], axis=1)
        belief = np.exp(np.minimum(0, forward + backward - total[:, None, None])) * used[:, :, None]
        miss = belief - gold
        gradient = [np.zeros_like(p) for p in parameters]
        for g, at in zip(gradient, [own, grain, *near, np.broadcast_to(files[:, None], shape)], strict=False):
            for tag in range(3):
                g[:, tag] = np.bincount(at.ravel(), miss[:, :, tag].ravel(), len(g))
        both = used[:, 1:]
        pair = forward[:, :-1, :, None] + moves + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]
        pair = np.exp(np.minimum(0, pair))
        gradient[-1] += (pair * both[:, :, None, None]).sum(axis=(0, 1))
        gradient[-1] -= np.einsum("sia,sib->ab", gold[:, :-1] * both[:, :, None], gold[:, 1:] * both[:, :, None])
        gradient[-1][OUT] += miss[:, 0].sum(axis=0)
        gradient[-1][:, OUT] += miss[every, lengths - 1].sum(axis=0)
        for p, g, m, v in zip(parameters, gradient, mean, square, strict=True):
            g = g / len(data) + RIDGE * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return field


def training_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE_TEXTS) -> list[str]:
    """A bounded sample of the texts, made up to ``LEAST_TEXTS`` where there are fewer."""
    texts = sample_texts(docs, doc_id, text, most, SAMPLE_CHARS)
    return texts + made_up_texts(LEAST_TEXTS - len(texts), SEED)


def _joined(spans: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order."""
    out: list[tuple[int, int]] = []
    for _, s, e in sorted(spans, key=lambda s: s[1:]):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def all_spans(field: Field, text: str) -> list[tuple[str, int, int]]:
    """Pattern matches, and secrets of the field that reach beyond them, by start, then kind ("crf" last)."""
    spans = base_spans(text)
    taken = _joined(spans)
    starts = [a for a, _ in taken]
    for s, e in field.spans(text):
        before = bisect.bisect_right(starts, s) - 1
        if before < 0 or taken[before][1] < e:
            spans.append(("crf", s, e))
    order = (*KINDS, "crf")
    return sorted(spans, key=lambda s: (s[1], order.index(s[0])))


def shown(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


FOUND = pa.schema([
    ("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
    ("base_sha256", pa.string()), ("spans", pa.string()), ("n_crf", pa.int64())])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """doc_id, counts per kind, a digest of the pattern matches and all spans (code points, end exclusive).

    A null text counts as empty; null ids and repeated rows stay; other columns are not read; an
    empty table gives no rows.
    """
    ship(docs.sparkSession)
    field = field or train(training_texts(docs, doc_id, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, value in texts_of(batch):
                spans = all_spans(field, value)
                base = [s for s in spans if s[0] != "crf"]
                count = [sum(s[0] == k for s in spans) for k in (*KINDS, "crf")]
                rows.append((key, *count[:3], hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans), count[3]))
            yield as_batch(rows, FOUND)

    return keyed_texts(docs, doc_id, text).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_crf bigint")


def cover(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with each stretch that spans cover replaced by the mark."""
    out, at = [], 0
    for _, s, e in sorted(spans, key=lambda s: s[1:]):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", mark: str = "[SECRET]",
           field: Field | None = None) -> DataFrame:
    """``docs`` with every secret in the text replaced; a null text stays null."""
    ship(docs.sparkSession)
    field = field or train(training_texts(docs, doc_id, text))
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = []
            for value in batch.column(place):
                value = value.as_py()
                clean.append(value and cover(value, all_spans(field, value), mark))
            yield batch.set_column(place, batch.schema.field(place), pa.array(clean, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)
