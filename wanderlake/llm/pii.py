"""Personal data: fixed patterns, and a conditional random field for what they miss.

E-mail addresses, internet addresses, card and phone numbers of the usual form are found by
patterns with exact checks. Other spellings (``jane at site dot org``, ``10[.]0[.]0[.]1``, a card
number with dots, a phone number without its plus) are tagged by a linear-chain conditional
random field over word shapes: runs of letters, runs of digits and single signs, each known by
its shape, its neighbours' shapes and whether a blank stands before it. It is trained from a
small labelled table by the exact gradient of its likelihood, and decoded by Viterbi over many
chains at once.

Every span of the model holds a digit, an at sign or a spelled one near it. So chains are the
runs of tokens near such a signal (``REACH`` tokens, ``WIDTH`` characters); all other tokens are
outside of any span.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.llm.common import scored

KINDS = ("email", "ip", "card", "phone")
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))  # B of kind k is 1 + 2k, I is 2 + 2k
REACH, WIDTH = 8, 160
BLOCK, CONTEXT = 65_536, 256
BATCH_TOKENS = 200_000
FORBIDDEN = -50.0

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("base", T.BooleanType()),
        ]
    )
)

Span = tuple[str, int, int]
Labelled = tuple[str, list[Span]]

# --- patterns -------------------------------------------------------------------------

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can begin inside a run of digits only where it could begin at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in one pass from sign to sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _only_digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[Span]:
    """What the fixed patterns find, leftmost and without overlap for each kind."""
    found: list[Span] = [("email", *span) for span in emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return found
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _only_digits(m[0])) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return found


# --- word shapes ----------------------------------------------------------------------

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_SIGNAL = re.compile(r"[0-9]+|@")
_SPELLED = re.compile(r"\bdot\b|\bpunkt\b|\bpunto\b|\bpoint\b|[(\[{] ?(?:at|dot) ?[)\]}]", re.I)
_SPELLED_HINTS = ("dot", "punkt", "punto", "point", "at)", "at]", "at}", "at )", "at ]", "at }")
_WORDS = {
    "at": "at", "arroba": "at", "dot": "dot", "punkt": "dot", "punto": "dot", "point": "dot",
    "tel": "tel", "phone": "tel", "telefon": "tel", "fon": "tel", "telefono": "tel", "téléphone": "tel", "call": "tel", "fax": "tel", "mobil": "tel",
    "mail": "mail", "email": "mail", "card": "card", "karte": "card", "visa": "card", "tarjeta": "card", "carte": "card",
    "ip": "ip", "host": "ip", "server": "ip", "com": "tld", "org": "tld", "net": "tld", "edu": "tld", "info": "tld", "de": "tld", "fr": "tld", "es": "tld",
}
_SIGNS = set("+-().@_[]{}/:,;#%&*=|\"'<>$")


def _shape(token: str) -> str:
    if token[0].isascii() and token[0].isdigit():
        n = len(token)
        if n == 3:
            return "d3" if token <= "255" else "d3+"
        return f"d{n}" if n < 12 else "d12" if n < 16 else "d16" if n == 16 else "d17" if n < 20 else "d20"
    if token.isalpha():
        known = _WORDS.get(token.lower()) if len(token) < 12 else None
        case = "x" if token.islower() else "X" if token.isupper() else "Xx" if token[1:].islower() else "xX"
        return known or case + ("1" if len(token) == 1 else "2" if len(token) < 4 else "4")
    return token if token in _SIGNS else "?"


@dataclass
class Chain:
    """Tokens of one stretch of a text: places in the text and shapes."""

    starts: list[int]
    ends: list[int]
    shapes: list[str]


def chains(text: str) -> list[Chain]:
    """The stretches of a text around its signals: ``REACH`` tokens and ``WIDTH`` characters on either side."""
    marks = [m.span() for m in _SIGNAL.finditer(text)]
    lowered = text.lower()
    if any(hint in lowered for hint in _SPELLED_HINTS):
        marks = sorted({*marks, *(m.span() for m in _SPELLED.finditer(text))})
    windows: list[list[int]] = []
    for start, end in marks:
        low, high = max(start - WIDTH, 0), min(end + WIDTH, len(text))
        if windows and low <= windows[-1][1]:
            windows[-1][1] = max(high, windows[-1][1])
        else:
            windows.append([low, high])
    out, places = [], np.array([start for start, _ in marks])
    for low, high in windows:
        pieces = [m.span() for m in _TOKEN.finditer(text, low, high)]
        # What a window's edge may have cut is no whole token; no signal stands there.
        if pieces and low and pieces[0][0] == low:
            del pieces[0]
        if pieces and high < len(text) and pieces[-1][1] == high:
            del pieces[-1]
        if not pieces:
            continue
        ends = np.searchsorted(places, np.array(pieces))
        signals = np.flatnonzero(ends[:, 1] > ends[:, 0])
        change = np.zeros(len(pieces) + 1, np.int64)
        np.add.at(change, np.maximum(signals - REACH, 0), 1)
        np.add.at(change, np.minimum(signals + REACH + 1, len(pieces)), -1)
        inside = np.r_[0, np.cumsum(change)[:-1] > 0, 0]
        edges = np.flatnonzero(np.diff(inside))
        out += [_shaped(text, pieces[i:j]) for i, j in zip(edges[::2], edges[1::2], strict=True)]
    return out


def _shaped(text: str, pieces: list[tuple[int, int]]) -> Chain:
    shapes, before = [], None
    for start, end in pieces:
        blank = before is None or start > before
        shapes.append(_shape(text[start:end]) + ("_" if blank else ""))
        before = end
    # Digits that make up 12 to 19 together, with one sign between them, and pass the check digit.
    i = 0
    while i < len(pieces):
        if not "0" <= text[pieces[i][0]] <= "9":
            i += 1
            continue
        run, j = [i], i
        while j + 1 < len(pieces):
            k = j + 1 if text[pieces[j + 1][0]] not in ".-/" else j + 2
            if k < len(pieces) and "0" <= text[pieces[k][0]] <= "9" and pieces[k][0] - pieces[j][1] <= 1:
                run.append(k)
                j = k
            else:
                break
        digits = "".join(text[pieces[k][0] : pieces[k][1]] for k in run) if len(run) < 20 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            for k in run:
                shapes[k] += "L"
        i = j + 1
    return Chain([s for s, _ in pieces], [e for _, e in pieces], shapes)


# --- the random field -----------------------------------------------------------------


def allowed() -> np.ndarray:
    """Which tag may follow which: I of a kind only B or I of it."""
    out = np.ones((len(TAGS), len(TAGS)), bool)
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = False
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = True
    return out


@dataclass
class Field:
    """Weights of shapes around a token, of pairs of neighbouring shapes, and of tags in a row."""

    shapes: dict[str, int]  # 0 is any other shape
    around: np.ndarray  # (5, shapes, tags): shapes of the tokens at -2 to 2
    pair_of: np.ndarray  # (shapes * shapes): number of a pair, 0 for one never seen
    pairs: np.ndarray  # (2, pairs, tags): with the token before, with the token after
    follow: np.ndarray  # (tags, tags)

    def numbers(self, names: Sequence[str]) -> np.ndarray:
        return np.array([self.shapes.get(s, 0) for s in names], np.int64)

    def features(self, chains_: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Shape numbers (5 a token) and pair numbers (2 a token) of all chains, one after another."""
        edge = len(self.shapes) + 1  # stands beyond both ends
        two = np.full(2, edge)
        padded = np.concatenate([np.concatenate([two, c, two]) for c in chains_])
        inside = np.concatenate([np.r_[False, False, np.ones(len(c), bool), False, False] for c in chains_])
        at = np.flatnonzero(inside)
        shapes = padded[at[:, None] + np.arange(-2, 3)]
        width = edge + 1
        pairs = np.stack([shapes[:, 1] * width + shapes[:, 2], shapes[:, 2] * width + shapes[:, 3]], axis=1)
        return shapes, self.pair_of[pairs]

    def scores(self, chains_: list[np.ndarray]) -> np.ndarray:
        shapes, pairs = self.features(chains_)
        return sum(self.around[k][shapes[:, k]] for k in range(5)) + sum(self.pairs[k][pairs[:, k]] for k in range(2))

    def decode(self, chains_: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of every chain, by Viterbi; longer chains first, so a step works on a prefix."""
        if not chains_:
            return []
        order = sorted(range(len(chains_)), key=lambda i: -len(chains_[i]))
        scores = self.scores([chains_[i] for i in order])
        lengths = np.array([len(chains_[i]) for i in order])
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        back = np.zeros((len(scores), len(TAGS)), np.uint8)
        best = scores[first] + self.follow[0]  # as if an outside token stood before
        for t in range(1, lengths[0]):
            n = int(np.searchsorted(-lengths, -t))  # chains longer than t
            ways = best[:n, :, None] + self.follow
            rows = first[:n] + t
            back[rows] = ways.argmax(axis=1)
            best[:n] = ways.max(axis=1) + scores[rows]
        tags = np.zeros(len(scores), np.uint8)
        tags[first + lengths - 1] = best.argmax(axis=1)
        for t in range(lengths[0] - 1, 0, -1):
            rows = first[: int(np.searchsorted(-lengths, -t))] + t
            tags[rows - 1] = back[rows, tags[rows]]
        out: list[np.ndarray] = [np.empty(0, np.uint8)] * len(chains_)
        for i, start, n in zip(order, first, lengths, strict=True):
            out[i] = tags[start : start + n]
        return out


def _tagged(chain: Chain, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(len(chain.starts), np.int64)
    for kind, start, end in spans:
        inside = [i for i, (s, e) in enumerate(zip(chain.starts, chain.ends, strict=True)) if s >= start and e <= end]
        if inside:
            tags[inside] = 2 + 2 * KINDS.index(kind)
            tags[inside[0]] -= 1
    return tags


@dataclass(frozen=True)
class Fit:
    steps: int = 150
    rate: float = 0.1
    ridge: float = 1e-3
    most_rows: int = 5_000  # the labelled table is small


def train(rows: Sequence[Labelled], fit: Fit = Fit()) -> Field:
    """A field fitted to labelled texts: Adam on the exact gradient of the penalised likelihood."""
    if len(rows) > fit.most_rows:
        raise ValueError(f"the labelled table has more than {fit.most_rows} rows")
    parts = [(c, _tagged(c, spans)) for text, spans in rows for c in chains(text) if c.starts]
    seen = sorted({s for c, _ in parts for s in c.shapes})
    shapes = {s: i + 1 for i, s in enumerate(seen)}
    width = len(shapes) + 2
    field = Field(shapes, np.zeros((5, width, len(TAGS))), np.zeros(width * width, np.int64), np.zeros((2, 1, len(TAGS))), np.where(allowed(), 0.0, FORBIDDEN))
    if not parts:
        return field
    numbered = [field.numbers(c.shapes) for c, _ in parts]
    order = sorted(range(len(parts)), key=lambda i: -len(numbered[i]))
    numbered, truth = [numbered[i] for i in order], np.concatenate([parts[i][1] for i in order])
    field.pair_of = np.arange(width * width)
    _, raw = field.features(numbered)
    kinds, places = np.unique(raw, return_inverse=True)
    field.pair_of = np.zeros(width * width, np.int64)
    field.pair_of[kinds] = np.arange(len(kinds)) + 1
    field.pairs = np.zeros((2, len(kinds) + 1, len(TAGS)))
    shape_at, pair_at = field.features(numbered)
    lengths = np.array([len(c) for c in numbered])
    params = [field.around, field.pairs, field.follow]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, fit.steps + 1):
        _, by_token, by_follow = gradient(field, shape_at, pair_at, lengths, truth)
        grads = [np.zeros_like(p) for p in params]
        for y in range(len(TAGS)):
            for k in range(5):
                grads[0][k, :, y] = np.bincount(shape_at[:, k], by_token[:, y], width)
            for k in range(2):
                grads[1][k, :, y] = np.bincount(pair_at[:, k], by_token[:, y], len(kinds) + 1)
        grads[1][:, 0] = 0
        grads[2] = np.where(allowed(), by_follow, 0.0)
        for i, p in enumerate(params):
            g = grads[i] / len(lengths) + fit.ridge * np.where(p > FORBIDDEN, p, 0)
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.99 * second[i] + 0.01 * g**2
            p -= fit.rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-8)
    field.pairs[:, 0] = 0
    return field


def gradient(field: Field, shape_at, pair_at, lengths: np.ndarray, truth: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Minus log-likelihood of the tags, and its slope by token scores and by tags in a row.

    Forward and backward over all chains at once (longest first), each step scaled to sum one.
    """
    scores = sum(field.around[k][shape_at[:, k]] for k in range(5)) + sum(field.pairs[k][pair_at[:, k]] for k in range(2))
    top = scores.max(axis=1, keepdims=True)
    e, a = np.exp(scores - top), np.exp(field.follow)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty(len(e))
    alpha[begin] = e[begin] * a[0]
    scale[begin] = alpha[begin].sum(axis=1)
    alpha[begin] /= scale[begin, None]
    actives = [int(np.searchsorted(-lengths, -t)) for t in range(lengths[0])]
    for t in range(1, lengths[0]):
        rows = begin[: actives[t]] + t
        alpha[rows] = (alpha[rows - 1] @ a) * e[rows]
        scale[rows] = alpha[rows].sum(axis=1)
        alpha[rows] /= scale[rows, None]
    for t in range(lengths[0] - 1, 0, -1):
        rows = begin[: actives[t]] + t
        beta[rows - 1] = ((e[rows] * beta[rows]) @ a.T) / scale[rows, None]
    chance = alpha * beta
    chance /= chance.sum(axis=1, keepdims=True)
    inner = np.ones(len(e), bool)
    inner[begin] = False
    rows = np.flatnonzero(inner)
    expected = (alpha[rows - 1].T @ (e[rows] * beta[rows] / scale[rows, None])) * a
    expected[0] += chance[begin].sum(axis=0)
    by_token = chance.copy()
    by_token[np.arange(len(truth)), truth] -= 1
    np.subtract.at(expected, (truth[rows - 1], truth[rows]), 1)
    np.subtract.at(expected, (0, truth[begin]), 1)
    own = scores[np.arange(len(truth)), truth].sum() + field.follow[truth[rows - 1], truth[rows]].sum() + field.follow[0, truth[begin]].sum()
    return float(np.log(scale).sum() + top.sum() - own), by_token, expected


# --- the labelled table ---------------------------------------------------------------


def labelled_examples(rows: int = 600, seed: int = 17) -> list[Labelled]:
    """The small labelled table: sentences with one filled-in item, some of them no personal data.

    Items are drawn by rule: usual and unusual spellings of the four kinds, and look-alikes
    (dates, prices, versions, keys, numbers that fail their check) that carry no label.
    """
    rng = random.Random(seed)
    return [_example(rng) for _ in range(rows)]


_NAMES = ("jane", "thion", "von", "maria", "le", "erst", "paul", "news", "info", "und", "able", "lopez", "claire", "haus")
_SITES = ("example", "mail7", "site", "post2", "company", "web", "uni")
_ENDS = ("com", "org", "net", "de", "fr", "es", "example.com", "co.uk")
_FRAMES = (
    "write to {} for it", "{}", "reach me: {}.", "the and {} of thion", "contact {} or wait", "zu {} und der", "que {} la mente", "le {} est",
    "In. {} The edan", "| {} | other |", "please use {}, thanks", "\"{}\" was there", "from {} to all", "{}!! now", "see {};", "end {}",
)
_HINTS = {"phone": ("tel ", "call ", "Telefon: ", "phone "), "card": ("card ", "visa: ", "Karte "), "ip": ("host ", "server ", "ip "), "email": ("mail ", "email: ")}


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card_number(rng: random.Random, valid: bool) -> str:
    body = rng.choice("3456") + _digits(rng, 14)
    return next(body + c for c in "0123456789" if luhn(body + c) == valid)


def _item(rng: random.Random, kind: str | None) -> str:
    if kind == "email":
        name, site, end = rng.choice(_NAMES) + rng.choice(("", "." + rng.choice(_NAMES), str(rng.randint(1, 99)), f".{rng.randint(1, 99)}")), rng.choice(_SITES), rng.choice(_ENDS)
        at = rng.choice(("@", "@", " at ", " (at) ", " [at] ", " @ ", "(at)", "[at]"))
        dot = rng.choice((".", " dot ", " [dot] ", "[dot]", " . ")) if at != "@" else rng.choice((".", ".", "[.]", " dot "))
        return name + at + site + dot + end.replace(".", dot)
    if kind == "ip":
        return rng.choice((".", ".", "[.]", " . ", " dot ", "(.)")).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        n = _card_number(rng, True)
        return rng.choice(("", " ", "-", ".", ".", " . ", "/")).join((n[:4], n[4:8], n[8:12], n[12:]))
    if kind == "phone":
        area, mid, last = f"{rng.randint(0, 999):03d}", _digits(rng, 3), _digits(rng, 4)
        return rng.choice((f"+1 ({area}) {mid}-{last}", f"({area}) {mid}-{last}", f"{area}-{mid}-{last}", f"{area}.{mid}.{last}", f"0049 {rng.randint(30, 99)} {_digits(rng, 7)}", f"+49 {rng.randint(30, 99)} {_digits(rng, 7)}", f"({area}) {mid} {last}", f"1-{area}-{mid}-{last}"))
    n = rng.randint(1, 99)
    return rng.choice(
        (
            f"{rng.randint(1800, 2099)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{n}.{rng.randint(0, 99)}", f"{n}.{n}.{n}", f"{n}:{rng.randint(10, 59)}",
            f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1900, 2099)}", f"${n},{_digits(rng, 3)}.00", f"{n} %", _card_number(rng, False), _card_number(rng, False),
            f"{_digits(rng, 3)} {_digits(rng, 3)}", str(rng.randint(1, 99_999)), f"token = \"{rng.getrandbits(160):040x}\"", f"{rng.getrandbits(64):016x}", f"@{rng.choice(_NAMES)}{n}",
            f"{n} at {rng.choice(_SITES)}", f"the dot on {n}", f"point {n}", f"{n}-{n + 3}", f"{rng.randint(256, 999)}.{rng.randint(0, 255)}.{rng.randint(256, 999)}.{n}",
            f"v{n}.{n}.{n}-{n}", f"{n}/{n}", f"978-{n}-{_digits(rng, 6)}-{n}", f"§ {n}.{n}", f"{n} + {n} = {2 * n}", f"{_digits(rng, 20)}", f"{n}.0.", f"{n}°{n}'", "at the dot", "dot point",
        )
    )


def _example(rng: random.Random) -> Labelled:
    kind = rng.choice((*KINDS, None, None))
    item = _item(rng, kind)
    hint = rng.choice(_HINTS[kind]) if kind and rng.random() < 0.3 else ""
    before, after = rng.choice(_FRAMES).split("{}")
    start = len(before) + len(hint)
    return before + hint + item + after, [(kind, start, start + len(item))] if kind else []


# --- both together --------------------------------------------------------------------

_DATE = re.compile(r"\d{4}[-./]\d{1,2}[-./]\d{1,2}|\d{1,2}[-./]\d{1,2}[-./]\d{2,4}")


def _plausible(kind: str, text: str) -> bool:
    """Exact checks that a span of the model has to pass."""
    digits = _DIGITS.findall(text)
    count = sum(map(len, digits))
    if kind == "card":
        return 12 <= count <= 19 and luhn("".join(digits))
    if kind == "ip":
        return len(digits) == 4 and all(map(_byte, digits))
    if kind == "phone":
        return 7 <= count <= 15 and len(digits) > 1 and not _DATE.fullmatch(text)
    lowered = text.lower()
    return ("@" in text or " at " in lowered or "at)" in lowered or "at]" in lowered) and ("." in text or "dot" in lowered)


class Finder:
    """Spans of many texts: patterns one by one, the field over all their chains."""

    def __init__(self, field: Field):
        self.field = field

    def find(self, texts: Sequence[str | None]) -> list[list[tuple[str, int, int, bool]]]:
        base = [base_spans(t or "") for t in texts]
        added: list[list[Span]] = [[] for _ in texts]
        waiting: list[tuple[int, Chain, int, int]] = []
        held = 0
        for i, text in enumerate(texts):
            for chain in chains(text or ""):
                for low in range(0, max(len(chain.starts), 1), BLOCK):
                    waiting.append((i, chain, low, min(low + BLOCK, len(chain.starts))))
                    held += waiting[-1][3] - low
                    if held >= BATCH_TOKENS:
                        self._decode(waiting, texts, added)
                        waiting, held = [], 0
        self._decode(waiting, texts, added)
        out = []
        for own, more in zip(base, added, strict=True):
            taken = sorted((s, e) for _, s, e in own)
            starts = [s for s, _ in taken]
            highest = np.maximum.accumulate([e for _, e in taken]) if taken else []
            spans = [(*span, True) for span in own]
            for kind, start, end in more:
                n = bisect_left(starts, end)
                if not n or highest[n - 1] <= start:
                    spans.append((kind, start, end, False))
            out.append(sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))
        return out

    def _decode(self, waiting, texts, added) -> None:
        """A block is decoded with some tokens of context; a span belongs to the block where it starts."""
        parts = [(i, c, low, high, max(low - CONTEXT, 0)) for i, c, low, high in waiting if high > low]
        numbers = [self.field.numbers(c.shapes[at : high + CONTEXT]) for _, c, _, high, at in parts]
        for (i, chain, low, high, at), tags in zip(parts, self.field.decode(numbers), strict=True):
            for n in np.flatnonzero((tags > 0) & (tags % 2 == 1)):
                if not low <= at + n < high:
                    continue
                end = n + 1
                while end < len(tags) and tags[end] == tags[n] + 1:
                    end += 1
                kind, start, stop = KINDS[(tags[n] - 1) // 2], chain.starts[at + n], chain.ends[at + end - 1]
                if _plausible(kind, texts[i][start:stop]):
                    added[i].append((kind, start, stop))


def find_personal_data(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Add ``pii_spans``: kind, start, end (in characters, end exclusive) and whether a pattern found it.

    Spans of the patterns all stay; spans of the field are added where they overlap none of
    them. Sorted by start, then kind (e-mail, internet address, card, phone), then end. Null and
    empty texts have none. Whole texts are read; long chains are decoded in blocks of
    ``BLOCK`` tokens with ``CONTEXT`` more on either side. Rows are independent: repeated rows
    stay, an empty table stays empty. The field is broadcast, some hundred kilobytes.
    """
    shared = df.sparkSession.sparkContext.broadcast(field)

    def scorer():
        finder = Finder(shared.value)
        return lambda texts: [finder.find(texts)]

    return scored(df, text, [T.StructField("pii_spans", SPANS)], scorer)


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span of ``pii_spans`` by its kind in brackets; overlapping spans by the first one's.

    A null text stays null.
    """
    kept = F.aggregate(
        "pii_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda done, s: F.when(s["start"] < done["at"], F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out"))).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(done["out"], F.substring(F.col(f"`{text}`"), done["at"] + 1, s["start"] - done["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
            )
        ),
    )
    whole = F.concat(kept["out"], F.substring(F.col(f"`{text}`"), kept["at"] + 1, F.length(f"`{text}`")))
    return df.withColumn(text, whole)
