"""Secrets in texts: fixed patterns and a linear-chain conditional random field.

The patterns name what can be told by its form alone. The random field tags
every token of a whole text as the beginning of a secret, inside one, or
outside, from the token's shape, the tokens around it and features of the file,
and Viterbi decoding gives the likeliest tagging. What it finds beyond the
patterns is added as spans of kind ``crf``; spans that touch a pattern's are
that pattern's already.

The field is fitted once per run, on the driver, to at most ``SAMPLE`` texts:
stretches of them as they are, with the patterns' finds as labels, and the same
stretches with made-up secrets and made-up harmless codes put in. It is trained
by gradient ascent on the conditional log-likelihood (forward-backward).

Tagging is exact and cheap because most tokens can be decided alone: if outside
beats the two other tags at a token by more than the transitions can ever make
good, an optimal tagging has it outside. Only the stretches between such tokens
go through Viterbi's recursion.

Edge cases: NULL is an empty text, without spans; offsets count code points of
the whole text; rows that agree are scanned each; texts of which none holds a
letter give no spans of kind ``crf``; a table without rows gives none.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ship_package
from marquee.llm.tokens import release

# fixed values: the patterns and the least lengths of their matches
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "crf")
LEAST_ADDED = 6

#: words one of which every match of ASSIGN holds, lower-cased
_NAMES = ("password", "passwd", "secret", "token", "api")
#: the others' matches lie in one token of at least so many characters
_LONG = 20

Span = tuple[int, int, int]  # start, place in KINDS, end

#: what stands between words: ASCII but for digits, letters and ``_+/-``, and
#: the signs and spaces of the blocks that common punctuation is from
_SIGN = r"\x00-\x2A\x2C\x2E\x3A-\x40\x5B-\x5E\x60\x7B-\xA0\u2000-\u206F\u3000-\u303F"
TOKEN = re.compile(f"[^{_SIGN}]+|[^ ]")
OUTSIDE, BEGIN, INSIDE = 0, 1, 2
#: stands between texts; always outside
EDGE = "\0"
#: how far around a token its neighbours count
AROUND = (-3, -2, -1, 1)

#: at most so many texts are fitted to
SAMPLE = 400
#: stretches per text, and their tokens
STRETCHES, STRETCH = 6, 24
STEPS, RATE, DECAY = 80, 0.3, 2e-4
#: tokens that are tagged together, and codes whose class is remembered
TOKENS_AT_ONCE = 1 << 15
REMEMBERED = 100_000


def base_spans(text: str, long_token: bool = True) -> list[Span]:
    """The patterns' spans. ``long_token``: whether any token of the text is
    long enough for an access key or a hex string."""
    out: list[Span] = []
    lower = text.lower()
    if any(n in lower for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if long_token:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return sorted(out)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


# --- features ---------------------------------------------------------------------


def _step(n: int, steps: tuple[int, ...]) -> int:
    return sum(n >= s for s in steps)


_LENGTHS = (2, 3, 4, 6, 8, 12, 16, 20, 24, 32, 40, 64)


def canonical(token: str, known: frozenset[str]) -> str:
    """One token for all that are described alike: plain words that have no
    weight of their own, and numbers, differ by case and length only."""
    if token.isalpha():
        if token.lower() in known:
            return token
        n = min(len(token), 64)
        if token.islower():
            return "a" * n
        if token.isupper():
            return "A" * n
        return "A" + "a" * (n - 1) if token[1:].islower() else token
    return "9" * min(len(token), 64) if token.isdigit() else token


def _runs(token: str) -> str:
    """Character classes with repeats taken together."""
    out = []
    for c in token[:64]:
        kind = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


def _charset(token: str) -> str:
    if token.isdigit():
        return "digits"
    if token.isalpha():
        return "letters"
    for name, allowed in (("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"),
                          ("UPPER", string.ascii_uppercase + string.digits), ("lower", string.ascii_lowercase + string.digits),
                          ("alnum", string.ascii_letters + string.digits)):
        if set(token) <= set(allowed):
            return name
    return "signs" if not any(c.isalnum() for c in token) else "mixed"


def described(token: str, known: frozenset[str]) -> tuple[list[str], list[str]]:
    """Features of a (canonical) token for itself and for its neighbours."""
    if token == EDGE:
        return ["edge"], ["edge"]
    n, charset, runs = _step(len(token), _LENGTHS), _charset(token), _runs(token)
    lower = token.lower()
    named = lower in known or len(token) == 1
    around = [f"w:{lower}"] if named else [f"{charset}{min(n, 6)}"]
    own = [f"n{n}", charset, f"{charset}{n}", f"{runs[:6]}", f"r{_step(len(runs), (2, 3, 4, 6, 9, 13))}"]
    if named:
        own.append(f"w:{lower}")
    if len(token) >= 8 and not (token.isalpha() or token.isdigit()):
        counts = Counter(token).values()
        entropy = -sum(c / len(token) * math.log2(c / len(token)) for c in counts)
        digits = sum(c.isdigit() for c in token) / len(token)
        own += [f"h{int(2 * entropy)}", f"d{int(5 * digits)}", f"h{int(2 * entropy)}{charset}"]
        own.append(f"parts{min(3, len(re.findall('[_/+-]', token)))}{charset}")
        # of the words between the signs, the longest that mixes letters and digits
        mixed = max((len(p) for p in re.split(r"[_/+\-]", token) if not p.isalpha() and not p.isdigit()), default=0)
        own.append(f"mix{_step(mixed, _LENGTHS)}")
    return own, around


def file_features(signs: np.ndarray, digits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Per text three features as places in a table of 12: its share of signs,
    its share of tokens with digits, and its length."""
    share = np.maximum(tokens, 1)
    a = np.searchsorted([0.12, 0.25, 0.4], signs / share, "right")
    b = np.searchsorted([0.01, 0.05, 0.2], digits / share, "right")
    c = np.searchsorted([20, 200, 2000], tokens, "right")
    return np.stack([a, 4 + b, 8 + c], axis=-1)


# --- the field --------------------------------------------------------------------


class Classes:
    """Numbers of token classes with their features as padded rows."""

    def __init__(self, known: frozenset[str], features: dict[str, int] | None = None) -> None:
        """``features``: numbers of the features that have weights; without it
        every feature met gets one."""
        self.known, self.grow = known, features is None
        self.features: dict[str, int] = {} if features is None else features
        self.rows: list[tuple[list[int], list[int]]] = []
        self.flags: list[tuple[bool, bool, bool]] = []  # sign, with digits, long
        self.of: dict[str, int] = {}

    def _number(self, name: str) -> int:
        if self.grow:
            return self.features.setdefault(name, len(self.features))
        return self.features.get(name, -1)

    def number(self, token: str) -> int:
        """The class of a token."""
        token = canonical(token, self.known)
        found = self.of.get(token)
        if found is None:
            own, around = described(token, self.known)
            row = [self._number("o:" + f) for f in own], [self._number("a:" + f) for f in around]
            found = self.of[token] = len(self.rows)
            self.rows.append(([f for f in row[0] if f >= 0], [f for f in row[1] if f >= 0]))
            sign = not any(c.isalnum() for c in token)
            self.flags.append((sign, any(c.isdigit() for c in token), len(token) >= _LONG))
        return found


@dataclass
class Field:
    """A fitted field. ``own`` and ``around`` hold weights by feature (and, for
    the latter, by distance), ``file`` by file feature; each for three tags."""

    known: frozenset[str]
    features: dict[str, int]
    own: np.ndarray  # feature x tag
    around: np.ndarray  # distance x feature x tag
    file: np.ndarray  # file feature x tag
    move: np.ndarray  # tag x next tag

    def margin(self) -> np.ndarray:
        """By how much outside must lead each other tag to be sure of it."""
        through = self.move[:, :, None] + self.move[None, :, :]  # before, here, after
        return (through - through[:, [OUTSIDE], :]).max((0, 2))


def _gathered(table: np.ndarray, rows: list[list[int]]) -> np.ndarray:
    """Sum of the table's rows per list."""
    out = np.zeros((len(rows), table.shape[1]))
    flat = np.array([f for r in rows for f in r], np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    for tag in range(table.shape[1]):
        out[:, tag] = np.bincount(owner, table[flat, tag], len(rows))
    return out


def _marginals(score: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over sequences x places x tags: tag and move
    probabilities, and the log-partition's sum."""
    top = score.max(2, keepdims=True)
    local, step = np.exp(score - top), np.exp(move)
    n, places, _ = score.shape
    forward, scale = np.empty_like(local), np.empty((n, places))
    state = local[:, 0]
    for t in range(places):
        if t:
            state = (state @ step) * local[:, t]
        scale[:, t] = state.sum(1)
        state = forward[:, t] = state / scale[:, t, None]
    backward = np.ones((n, 3))
    tags, moves = np.empty_like(local), np.zeros((3, 3))
    for t in range(places - 1, -1, -1):
        tags[:, t] = forward[:, t] * backward
        if t:
            weighted = local[:, t] * backward / scale[:, t, None]
            moves += np.einsum("ni,ij,nj->ij", forward[:, t - 1], step, weighted)
            backward = weighted @ step.T
    return tags, moves, float((np.log(scale) + top[:, :, 0]).sum())


def _beside(values: np.ndarray, distance: int, edge: int) -> np.ndarray:
    """Each place's neighbour at a distance, along the last axis."""
    out = np.full_like(values, edge)
    if distance < 0:
        out[..., -distance:] = values[..., :distance]
    else:
        out[..., :-distance] = values[..., distance:]
    return out


def fit(texts: list[str], seed: int = 5, steps: int = STEPS) -> Field:
    """A field fitted to stretches of ``texts`` (see ``_examples``)."""
    examples = _examples(texts, random.Random(seed))
    near: Counter = Counter()
    for tokens, tags, _ in examples:
        for i, tag in enumerate(tags):
            if tag == BEGIN:
                near.update(t.lower() for t in tokens[max(0, i - 3) : i] if t.isalpha())
    known = frozenset(w for w, n in near.items() if n >= 3)
    classes = Classes(known)
    edge = classes.number(EDGE)
    places = STRETCH + 16
    ids = np.full((len(examples), places), edge)
    gold = np.zeros((len(examples), places), np.int64)
    for i, (tokens, tags, _) in enumerate(examples):
        ids[i, 1 : len(tokens) + 1] = [classes.number(t) for t in tokens]
        gold[i, 1 : len(tags) + 1] = tags
    files = np.array([f for _, _, f in examples], np.int64).reshape(-1, 3)
    own_rows, around_rows = [r[0] for r in classes.rows], [r[1] for r in classes.rows]
    n_classes, n_features = len(classes.rows), len(classes.features)
    field = Field(known, classes.features, np.zeros((n_features, 3)), np.zeros((len(AROUND), n_features, 3)),
                  np.zeros((12, 3)), np.zeros((3, 3)))
    beside = [_beside(ids, d, edge) for d in AROUND]
    one_hot = np.eye(3)[gold]
    gold_moves = np.zeros((3, 3))
    np.add.at(gold_moves, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    flat = {kind: (np.repeat(np.arange(n_classes), [len(r) for r in rows]), np.array([f for r in rows for f in r], np.int64))
            for kind, rows in (("own", own_rows), ("around", around_rows))}

    def by_feature(kind: str, places_: np.ndarray, wrong: np.ndarray) -> np.ndarray:
        owner, feature = flat[kind]
        out = np.empty((n_features, 3))
        for tag in range(3):
            per_class = np.bincount(places_.ravel(), wrong[..., tag].ravel(), n_classes)
            out[:, tag] = np.bincount(feature, per_class[owner], n_features)
        return out

    weights = [field.own, field.around, field.file, field.move]
    seen = [np.full_like(w, 1e-2) for w in weights]
    for _ in range(steps if examples else 0):
        score = _gathered(field.own, own_rows)[ids]
        for d, b in enumerate(beside):
            score += _gathered(field.around[d], around_rows)[b]
        score += field.file[files].sum(1)[:, None, :]
        tags, moves, _ = _marginals(score, field.move)
        wrong = one_hot - tags
        file_wrong = np.zeros((12, 3))
        np.add.at(file_wrong, files, wrong.sum(1)[:, None, :])
        slopes = [by_feature("own", ids, wrong), np.stack([by_feature("around", b, wrong) for b in beside]),
                  file_wrong, gold_moves - moves]
        for w, s, total in zip(weights, slopes, seen):
            slope = s / len(examples) - DECAY * w
            total += slope * slope
            w += RATE * slope / np.sqrt(total)
    return field


def viterbi(score: np.ndarray, move: np.ndarray) -> list[int]:
    """The best tags of a stretch whose neighbours on both sides are outside."""
    best, back = score[0] + move[OUTSIDE], []
    for row in score[1:]:
        ways = best[:, None] + move
        back.append(ways.argmax(0))
        best = ways.max(0) + row
    tag = int((best + move[:, OUTSIDE]).argmax())
    out = [tag]
    for ways in reversed(back):
        tag = int(ways[tag])
        out.append(tag)
    return out[::-1]


class Tagger:
    """Tags texts, remembering the classes of words up to a bound."""

    def __init__(self, field: Field) -> None:
        self.field = field
        self.margin = field.margin()
        self._fresh()

    def _fresh(self) -> None:
        known = self.field.known
        self.classes = Classes(known, self.field.features)
        self.edge = self.classes.number(EDGE)
        # words with a weight of their own and single signs, looked up as they are
        fixed = {v for w in known for v in (w, w.title(), w.upper())} | {*string.punctuation, "\n", "\t", EDGE}
        self.fixed = {t: self.classes.number(t) for t in fixed}
        self.plain = np.array([self.classes.number("a" * n) for n in range(1, 65)])
        self.codes: dict[str, int] = {}
        self.scores = np.empty((len(AROUND) + 1, 0, 3), np.float32)
        self.flags = np.empty((0, 3), bool)

    def _ids(self, tokens: list[str]) -> np.ndarray:
        n = len(tokens)
        ids = np.fromiter(map(self.fixed.get, tokens, repeat(-1)), np.int64, n)
        # a plain word's class follows from its length
        plain = np.fromiter(map(str.isalpha, tokens), bool, n) & np.fromiter(map(str.islower, tokens), bool, n) & (ids < 0)
        ids[plain] = self.plain[np.minimum(np.fromiter(map(len, tokens), np.int64, n)[plain], 64) - 1]
        for i in np.flatnonzero(ids < 0).tolist():
            token = tokens[i]
            found = self.codes.get(token)
            if found is None:
                found = self.classes.number(token)
                if len(token) <= 64:
                    self.codes[token] = found
            ids[i] = found
        have = self.scores.shape[1]
        new = self.classes.rows[have:]
        if new:
            own, around = [r[0] for r in new], [r[1] for r in new]
            tables = [_gathered(self.field.own, own), *[_gathered(self.field.around[d], around) for d in range(len(AROUND))]]
            self.scores = np.concatenate([self.scores, np.stack(tables).astype(np.float32)], axis=1)
            self.flags = np.concatenate([self.flags, np.array(self.classes.flags[have:])])
        return ids

    def tag(self, texts: list[list[str]]) -> tuple[list[dict[int, int]], np.ndarray]:
        """Per text its tokens that aren't outside, with their tags, and whether
        it has a long token."""
        gap = [EDGE] * (max(map(abs, AROUND)) + 1)
        tokens: list[str] = list(gap)
        starts, ends = [], []
        for text in texts:
            starts.append(len(tokens))
            tokens += text
            ends.append(len(tokens))
            tokens += gap
        ids = self._ids(tokens)
        a, b = np.array(starts, np.int64), np.array(ends, np.int64)
        sums = [np.concatenate(([0], np.cumsum(f[ids]))) for f in self.flags.T]
        signs, digits, long = [s[b] - s[a] for s in sums]
        score = self.scores[0][ids]
        for d, distance in enumerate(AROUND):
            score += self.scores[d + 1][_beside(ids, distance, self.edge)]
        per_text = self.field.file[file_features(signs, digits, b - a)].sum(1)
        for start, end, bias in zip(starts, ends, per_text.astype(np.float32)):
            score[start:end] += bias
        lead = score[:, [OUTSIDE]] - score[:, 1:]
        open_ = (lead[:, 0] <= self.margin[BEGIN]) | (lead[:, 1] <= self.margin[INSIDE])
        open_[ids == self.edge] = False
        out: list[dict[int, int]] = [{} for _ in texts]
        at = np.flatnonzero(open_)
        if len(at):
            cuts = np.flatnonzero(np.diff(at) > 1) + 1
            for run in np.split(at, cuts):
                tags = viterbi(score[run[0] : run[-1] + 1], self.field.move)
                if any(tags):
                    text = int(np.searchsorted(a, run[0], "right")) - 1
                    out[text].update({int(p) - starts[text]: t for p, t in zip(run, tags) if t})
        if len(self.codes) > REMEMBERED or self.scores.shape[1] > REMEMBERED:
            self._fresh()
        return out, long > 0


def _spans(text: str, tags: dict[int, int]) -> list[tuple[int, int]]:
    """Code-point spans of tagged tokens; a secret begins at a begin or at an
    inside after an outside, and goes on as long as its tokens touch. Signs at
    its ends aren't part of it, and below ``LEAST_ADDED`` it is none."""
    out: list[list[int]] = []
    last = -2
    for i, m in enumerate(TOKEN.finditer(text)):
        tag = tags.get(i)
        if tag:
            if tag == INSIDE and last == i - 1 and out[-1][1] == m.start():
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            last = i
    for span in out:
        while span[0] < span[1] and not text[span[0]].isalnum():
            span[0] += 1
        while span[0] < span[1] and not text[span[1] - 1].isalnum() and text[span[1] - 1] != "=":
            span[1] -= 1
    return [(a, b) for a, b in out if b - a >= LEAST_ADDED]


def found_spans(texts: list[str], tagger: Tagger) -> Iterator[tuple[list[Span], list[Span]]]:
    """Per text the patterns' spans, and those that the field adds."""
    tags, long = tagger.tag([TOKEN.findall(t) for t in texts])
    for text, tagged, is_long in zip(texts, tags, long.tolist()):
        base = base_spans(text, is_long)
        added = [(a, 3, b) for a, b in _spans(text, tagged) if not any(a < e and s < b for s, _, e in base)] if tagged else []
        yield base, added


# --- examples to fit to -----------------------------------------------------------

_HEX, _ALNUM = "0123456789abcdef", string.ascii_letters + string.digits


def _made(rng: random.Random, alphabet: str, low: int, high: int) -> str:
    return "".join(rng.choices(alphabet, k=rng.randint(low, high)))


def _secret(rng: random.Random) -> str:
    """A made-up secret."""
    return rng.choice([
        lambda: _made(rng, _HEX, 24, 64),
        lambda: _made(rng, _HEX.upper(), 24, 64),
        lambda: _made(rng, _ALNUM, 16, 48),
        lambda: _made(rng, _ALNUM + "+/", 24, 64) + rng.choice(["", "=", "=="]),
        lambda: _made(rng, _ALNUM + "_-", 24, 48),
        lambda: "AKIA" + _made(rng, string.ascii_uppercase + string.digits, 16, 16),
        lambda: _made(rng, string.ascii_lowercase, 2, 5) + rng.choice("_-") + _made(rng, _ALNUM, 20, 40),
        lambda: _made(rng, string.ascii_lowercase, 2, 4) + "_" + rng.choice(["live", "test", "prod"]) + "_" + _made(rng, _ALNUM, 20, 32),
        lambda: ".".join(_made(rng, _ALNUM + "_-", low, 60) for low in (20, 30, 30)),
        lambda: "-".join(_made(rng, string.digits, 9, 12) for _ in range(2)) + "-" + _made(rng, _ALNUM, 20, 32),
    ])()


def _harmless(rng: random.Random, words: list[str]) -> str:
    """A made-up code that is no secret."""
    word = lambda: rng.choice(words)
    digits = lambda n: _made(rng, string.digits, n, n)
    return rng.choice([
        lambda: digits(rng.randint(1, 19)),
        lambda: f"({digits(3)}) {digits(3)}-{digits(4)}",
        lambda: f"{word()}.{digits(2)}@{word()}{digits(1)}.com",
        lambda: f"https://{word()}.org/{word()}/{word()}-{word()}-{digits(4)}.html",
        lambda: f"20{digits(2)}-{digits(2)}-{digits(2)}T{digits(2)}:{digits(2)}:{digits(2)}Z",
        lambda: "-".join(_made(rng, _HEX, n, n) for n in (8, 4, 4, 4, 12)),
        lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}-rc{digits(1)}",
        lambda: "_".join(word().lower() for _ in range(rng.randint(2, 5))) + rng.choice(["", "_id", "2", "_v10"]),
        lambda: "".join(word().title() for _ in range(rng.randint(2, 5))) + rng.choice(["", "Id", "64"]),
        lambda: f"{word().upper()}-{digits(4)}",
        lambda: f"/{word()}/{word()}/{word()}{digits(1)}/{word()}.txt",
        lambda: f"{word()}{rng.choice('#*$%&|') * 3} {word()}",
        lambda: f"#{_made(rng, _HEX, 6, 6)}",
        lambda: f"{digits(3)}.{digits(2)}.{digits(2)}.{digits(3)}:{digits(4)}",
        lambda: f"{word()}-{word()}-{word()}",
    ])()


_CALLED = ("password", "passwd", "pwd", "secret", "client_secret", "token", "access_token", "auth_token", "api_key",
           "apikey", "API_KEY", "SECRET_KEY", "key", "credential", "private_key", "bearer", "Authorization: Bearer")
_JOINED = ("=", " = ", ": ", ":", " := ", " => ", " is ", " ")


def _examples(texts: list[str], rng: random.Random) -> list[tuple[list[str], list[int], list[int]]]:
    """(tokens, tags, file features) of stretches of the texts, as they are and
    with something put in. Tags come from the patterns and from what was put in."""
    out = []
    for text in texts:
        tokens = list(TOKEN.finditer(text))
        if not tokens:
            continue
        found = [t[0] for t in tokens]
        words = [t for t in found if t.isalpha()] or ["word"]
        signs = sum(not any(c.isalnum() for c in t) for t in found)
        digits = sum(any(c.isdigit() for c in t) for t in found)
        (files,) = file_features(np.array([signs]), np.array([digits]), np.array([len(found)])).tolist()
        secret = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 16 or (len(m[2]) >= 6 and re.search(r"\d", m[2]))]
        secret += [(s, e) for s, kind, e in base_spans(text) if kind]
        starts = [max(0, i - STRETCH // 2) for i, t in enumerate(tokens) if any(s <= t.start() < e for s, e in secret)][:4]
        for n in range(STRETCHES):
            first = starts[n] if n < len(starts) else rng.randrange(max(1, len(tokens) - STRETCH + 1))
            part = tokens[first : first + STRETCH]
            low, high = part[0].start(), part[-1].end()
            piece = text[low:high]
            here = [(max(s, low) - low, min(e, high) - low) for s, e in secret if s < high and low < e]
            if n >= len(starts) and n % 4:
                at = rng.choice([m.start() - low for m in part])
                put = (_secret if n % 4 < 3 else lambda r: _harmless(r, words))(rng)
                before = ""
                if rng.random() < 0.7:
                    before = rng.choice(_CALLED) if n % 4 < 3 or rng.random() < 0.3 else rng.choice(words)
                    before += rng.choice(_JOINED)
                mark = rng.choice(["", "", '"', "'"])
                piece = piece[:at] + before + mark + put + mark + " " + piece[at:]
                begin, grown = at + len(before) + len(mark), len(before) + 2 * len(mark) + len(put) + 1
                here = [(s + grown, e + grown) if s >= at else (s, e) for s, e in here]
                if n % 4 < 3:
                    here.append((begin, begin + len(put)))
            made = list(TOKEN.finditer(piece))[: STRETCH + 14]
            tags = []
            for m in made:
                inside = next((s for s, e in here if s <= m.start() < e), None)
                tags.append(OUTSIDE if inside is None else BEGIN if m.start() == inside or not tags or not tags[-1] else INSIDE)
            out.append(([m[0] for m in made], tags, files))
    return out


# --- the scan ---------------------------------------------------------------------


def sample_texts(docs: DataFrame, key: str, text: str, most: int) -> list[str]:
    """At most ``most`` texts, those whose key has the smallest hashes."""
    rows = docs.count()
    if not rows:
        return []
    hashed = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(1 << 32))
    share = min(1.0, 2.0 * most / rows)
    chosen = docs.select(hashed.alias("h"), F.col(text).alias("t")).where(F.col("h") < F.lit(math.ceil(share * (1 << 32))))
    return [r.t for r in chosen.orderBy("h", "t").limit(most).collect() if r.t]


def scan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None, sample: int = SAMPLE
) -> DataFrame:
    """Per document: its key, n_assign, n_access, n_hex and n_added (spans by
    kind), base_sha256 (of the patterns' spans as text) and spans (all of them)."""
    spark = docs.sparkSession
    ship_package(spark)
    field = field or fit(sample_texts(docs, key, text, sample))
    shared = spark.sparkContext.broadcast(field)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(shared.value)
        for batch in batches:
            counts: list[list[int]] = []
            hashes, all_spans, held, size = [], [], [], 0

            def flush() -> None:
                for base, added in found_spans(held, tagger):
                    kinds = Counter(kind for _, kind, _ in base)
                    counts.append([kinds[0], kinds[1], kinds[2], len(added)])
                    hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                    all_spans.append(joined(sorted(base + added)))
                held.clear()

            for value in batch.column(1):
                held.append(value.as_py() or "")
                size += len(held[-1])
                if size > 4 * TOKENS_AT_ONCE:
                    flush()
                    size = 0
            flush()
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(hashes, pa.string()), pa.array(all_spans, pa.string())],
                names=["_key", "n_assign", "n_access", "n_hex", "n_added", "base_sha256", "spans"],
            )
        release()

    (kind,) = (f.dataType.simpleString() for f in docs.select(key).schema.fields)
    schema = f"_key {kind}, n_assign long, n_access long, n_hex long, n_added long, base_sha256 string, spans string"
    rows = docs.select(F.col(key), F.col(text)).mapInArrow(find, schema)
    return rows.withColumnRenamed("_key", key)
