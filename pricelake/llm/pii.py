"""Personal data by base patterns and a semi-Markov conditional random field.

Base spans are the pattern matches that pass their checks; they stay. In the gaps between
them, a semi-Markov conditional random field looks for what the patterns miss (a phone
number without its plus sign, an address whose signs are spelled out, a card number in
unusual groups). A segmentation cuts a stretch of tokens into entities of bounded length
and single tokens outside; its score sums whole-span features (digit groups, shape,
checksum, what stands before and after) and the transitions between segments' kinds. The
weights maximise the conditional likelihood of segmentations that a seeded generator
annotates: the log-partition and the expected features come from a forward and a backward
pass over bounded segments. Decoding is the same dynamic programme with the maximum, so
boundaries and kinds are chosen jointly. Every gap is decoded; stretches without a digit or
an at-mark within reach are passed over, as they hold no candidate, and so are lists of ten
or more figures with one separator. Spans of figures that look the same are scored once.

Defined cases: a null text is the empty text, without spans; whole texts are read, of any
length; spans count code points, end exclusive; equal texts give equal spans; an empty
table gives an empty result; other columns, whatever their names, are ignored or, where
texts are redacted, stay.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.common import Memo, batch_of, releasing, text_of

#: Kinds in the order of results.
KINDS = ("email", "ip", "card", "phone")
SPACE_OR_HYPHEN = r"[\x20-]"

LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# possessive: a run of digits either ends where the pattern goes on, or no start inside it matches
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
DIGITS, NEITHER = re.compile(r"[0-9]+"), re.compile(r"[^A-Za-z0-9]")
NOT_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(int(d) if k % 2 == 0 else (2 * int(d) - 9 if d > "4" else 2 * int(d)) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from the at sign: linear in the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL_SIGNS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    out: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(y := x.lstrip("0")) < 4 and int(y or "0") <= 255 for x in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(digits := NOT_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(NOT_DIGITS.sub("", m[0])) <= 15]
    return out


# ---------------------------------------------------------------------------
# The semi-Markov model

#: Training: step size, and penalty on squared weights for each line.
RATE, PENALTY = 0.35, 2e-4
#: Most tokens of an entity.
MOST_TOKENS = 24
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|[^A-Za-z0-9\s]")
#: A candidate of digits has no letter, line break or tab, at most so many digits in groups, and at most
#: so many other signs between two groups, a plus sign only in front. Fewer digits than a phone number or card has are a candidate
#: only as four groups, as in an IP address. Any other candidate is written like a mail address.
MOST_DIGITS, MOST_GROUPS, MOST_BETWEEN, LEAST_DIGITS = 19, 7, 3, 7
#: Ten or more short figures with one separator, or in rows of cells, hold no candidate.
FIGURES = re.compile(r"(?<![0-9])[0-9]{1,6}+(?:([\x20,;|/\t.:-]{1,3})[0-9]{1,6}+(?:\1[0-9]{1,6}+){8,}+|[,;|\t]\x20?[0-9]{1,6}+(?:(?:[,;|\t]\x20?|\r?\n)[0-9]{1,6}+){8,}+)(?![0-9])")
#: Groups of digits with no more than MOST_BETWEEN signs between two: each candidate of digits lies in one.
RUN = re.compile(r"[0-9]++(?:[^\w\n\r\t\v\f]{1,3}[0-9]++)*+")
MARK = re.compile(r"@|\bat\b", re.IGNORECASE)
#: What a mark of a candidate has behind it: the first part of a domain, and a dot.
_DOT = r"[\w-]+\x20?(?:\.\x20?[\w-]|[\[({<]\x20?dot|dot\b)"
DOMAIN_AHEAD = re.compile(rf"@\x20?{_DOT}|at\x20?[\])}}>]\x20?{_DOT}|at\x20?[\w-]+(?:\.[\w-]|\x20?[\[({{<]\x20?dot|\x20?dot\b)", re.IGNORECASE)
SPELLED_EMAIL = re.compile(r"[\w.%+-]+\x20?(?:@|[\[({<]\x20?at\x20?[\])}>]|\bat\b)\x20?[\w-]+(?:\x20?(?:\.|[\[({<]\x20?dot\x20?[\])}>]|\bdot\b)\x20?[\w-]+)+", re.IGNORECASE)
#: With a bare "at" and plain dots: no web address, and an end like a domain's.
PLAIN_DOMAIN = re.compile(r"(?i:.*\bat\b)\x20?(?!(?i:www)\.)[\w-]+(?:\.[\w-]+)*\.(?:[a-z]{2,}|[A-Z]{2,})", re.DOTALL)
BARE_AT = re.compile(r"\w\x20?at\x20?\w", re.IGNORECASE)
#: Words that stand before a place more often than they name a person.
COMMON = frozenset("was is are were be been am you me us him her it them we they he she look looking meet met stay stayed live lives lived work works worked arrive arrived sit stop stopped found available".split())
SENTENCE_END = re.compile(r"[A-Za-z0-9][.,]\x20")
OCTETS = re.compile(r"[0-9]{1,3}(?:[.,\x20\[\]()]+[0-9]{1,3}){3}")
#: Words that announce a kind.
CUES = {
    "email": ("mail", "email", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address", "ping", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "pay"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "cell", "number"),
}
CUE_KIND = {word: kind for kind, words in CUES.items() for word in words}
LAST_WORDS = re.compile(r"[A-Za-z]+")


def _bucket(n: int) -> str:
    for limit in (0, 3, 6, 7, 9, 11, 15, 16, 19):
        if n <= limit:
            return str(limit)
    return "more"


def span_features(text: str, start: int, end: int) -> list[str]:
    """What the whole span, and its two sides, look like."""
    span = text[start:end]
    groups = DIGITS.findall(span)
    digits = "".join(groups)
    separators = "".join(sorted(set(NEITHER.findall(span))))
    letters = any(c.isalpha() for c in span)
    out = [
        "bias",
        "digits:" + _bucket(len(digits)),
        "groups:" + ",".join(str(len(g)) for g in groups[:6]),
        "n_groups:" + str(min(6, len(groups))),
        "separators:" + separators[:6],
        f"letters:{letters}",
        "first:" + ("9" if span[0].isdigit() else "a" if span[0].isalpha() else span[0]),
        "last:" + ("9" if span[-1].isdigit() else "a" if span[-1].isalpha() else span[-1]),
    ]
    before, after = text[start - 1 : start], text[end : end + 1]
    out += [f"glued_before:{before.isalnum() or before in '.-/+@:'}" if before else "at_start", f"glued_after:{after.isalnum() or after in '-/@:'}" if after else "at_end"]
    if before and before in "$€£#":
        out.append("amount")
    if SENTENCE_END.search(span):
        out.append("sentence_end")
    if letters and SPELLED_EMAIL.fullmatch(span):
        bare = "@" not in span and BARE_AT.search(span)
        out += ["address", "address:" + ("plain" if "@" in span else "bare" if bare else "spelled")]
        if bare:
            local = span.split()[0]
            out.append("local:common" if local.lower() in COMMON else "local:plain" if local.isalpha() else "local:dotted")
    if OCTETS.fullmatch(span):
        out.append(f"octets:{all(int(g) <= 255 for g in groups)}")
    if 13 <= len(digits) <= 19 and not letters:
        out.append(f"luhn:{luhn(digits)}")
    for word in LAST_WORDS.findall(text[max(0, start - 20) : start])[-2:]:
        if word.lower() in CUE_KIND:
            out.append("cue:" + CUE_KIND[word.lower()])
    return out


#: Kinds of segments: OUTSIDE is a single token that is in no entity.
OUTSIDE, STATES = len(KINDS), len(KINDS) + 1
Weights = tuple[dict[str, tuple[float, ...]], tuple[tuple[float, ...], ...]]


def spelled_address(text: str, start: int, end: int) -> bool:
    """Whether the span is written like a mail address, its signs spelled out or not."""
    if not SPELLED_EMAIL.fullmatch(text, start, end):
        return False
    span = text[start:end]
    return "@" in span or not BARE_AT.search(span) or "dot" in span.lower() or bool(PLAIN_DOMAIN.fullmatch(span))


def candidates(text: str, tokens: list[tuple[int, int]], marks: list[int]) -> Iterator[tuple[int, list[int]]]:
    """(end token, first tokens) of the runs of tokens that may be an entity."""
    kinds = [("9" if "0" <= c <= "9" else "a" if c.isalnum() else "\n" if c in "\n\r\t\v\f" else c) for c in (text[a] for a, _ in tokens)]
    sizes, met = [b - a for a, b in tokens], 0
    for j in range(1, len(tokens) + 1):
        end = tokens[j - 1][1]
        while met < len(marks) and marks[met] < end:
            met += 1
        starts = []
        if kinds[j - 1] == "9":
            digits = groups = widest = between = 0
            for i in range(j - 1, max(-1, j - 1 - MOST_TOKENS), -1):
                kind = kinds[i]
                if kind == "9":
                    digits, groups, widest, between = digits + sizes[i], groups + 1, max(widest, sizes[i]), 0
                    if digits > MOST_DIGITS or groups > MOST_GROUPS:
                        break
                elif kind in "a\n" or between == MOST_BETWEEN:
                    break
                else:
                    between += 1
                    if kind not in "+(":
                        continue
                if digits >= LEAST_DIGITS or groups == 4 and widest <= 3:
                    starts.append(i)
                if kind == "+":
                    break
        last_mark = marks[met - 1] if met else -1
        if kinds[j - 1] in "9a" and tokens[max(0, j - MOST_TOKENS)][0] < last_mark:
            for i in range(j - 1, max(-1, j - 1 - MOST_TOKENS), -1):
                if tokens[i][0] < last_mark and kinds[i] in "9a" and i not in starts and spelled_address(text, tokens[i][0], end):
                    starts.append(i)
        if starts:
            yield j, starts


NINES = str.maketrans("012345678", "9" * 9)


class SemiMarkov:
    """Weights of features by kind and of transitions, and the best segmentation of a stretch."""

    def __init__(self, weights: Weights | None = None):
        self.features, self.moves = weights or ({}, ((0.0,) * STATES,) * STATES)
        self.known = Memo(lambda key: None, 100_000)  # scores of spans without letters, by all that their features depend on

    def scores(self, features: list[str]) -> list[float]:
        """Of a span with these features, as an entity of each kind."""
        known = self.features
        return [sum(x) for x in zip(*[known[f] for f in features if f in known])] or [0.0] * len(KINDS)

    def span_scores(self, text: str, start: int, end: int) -> list[float]:
        """``scores`` of a span, computed once for all spans of figures that look the same."""
        span = text[start:end]
        if not span.isascii() or any(map(str.isalpha, span)):
            return self.scores(span_features(text, start, end))
        shape = span.translate(NINES)
        digits = shape.count("9")
        check = luhn(NOT_DIGITS.sub("", span)) if 13 <= digits <= 19 else all(len(g) <= 3 and int(g) <= 255 for g in DIGITS.findall(span)) if digits <= 12 else None
        cues = tuple(CUE_KIND.get(w.lower()) for w in LAST_WORDS.findall(text[max(0, start - 20) : start])[-2:])
        key = (shape, check, text[start - 1 : start] if start else "", text[end : end + 1], cues)
        if (found := self.known[key]) is None:
            found = self.known[key] = self.scores(span_features(text, start, end))
        return found

    def decode(self, text: str, low: int, high: int) -> list[Span]:
        """The entities of the most probable segmentation of text[low:high], without lists of figures."""
        out: list[Span] = []
        for a, b in between_figures(text, low, high):
            for start, end, marks in _stretches(text, a, b):
                out += self._decode(text, start, end, marks)
        return out

    def _decode(self, text: str, low: int, high: int, marks: list[int]) -> list[Span]:
        tokens = [m.span() for m in TOKEN.finditer(text, low, high)]
        ends = dict(candidates(text, tokens, marks))
        if not ends:
            return []
        moves, never = self.moves, float("-inf")
        into = [[moves[y][z] for y in range(STATES)] for z in range(STATES)]
        best: list[list[float]] = [[never] * OUTSIDE + [0.0]]
        back: list[list[tuple[int, int] | None]] = [[None] * STATES]
        arrive = lambda i, z: max(zip(map(float.__add__, best[i], into[z]), range(STATES)))
        entering = Memo(lambda i: [arrive(i, kind) for kind in range(len(KINDS))])
        stay, none = into[OUTSIDE][OUTSIDE], [None] * OUTSIDE
        entity_before = False
        for j in range(1, len(tokens) + 1):
            if entity_before:
                outside, y = arrive(j - 1, OUTSIDE)
            else:
                outside, y = best[-1][OUTSIDE] + stay, OUTSIDE
            here, origin, entity_before = [never] * OUTSIDE + [outside], [*none, (j - 1, y)], False
            for i in ends.get(j, ()):
                start, end = tokens[i][0], tokens[j - 1][1]
                scores = self.span_scores(text, start, end)
                for kind, (before, y) in enumerate(entering[i]):
                    if before + scores[kind] > here[kind]:
                        here[kind], origin[kind], entity_before = before + scores[kind], (i, y), True
            best.append(here)
            back.append(origin)
        out, j = [], len(tokens)
        state = max(range(STATES), key=best[j].__getitem__)
        while j:
            i, before = back[j][state]
            if state != OUTSIDE:
                out.append((KINDS[state], tokens[i][0], tokens[j - 1][1]))
            j, state = i, before
        return out[::-1]


def between_figures(text: str, low: int, high: int) -> Iterator[tuple[int, int]]:
    """What is left of text[low:high] without its lists of figures."""
    for m in FIGURES.finditer(text, low, high):
        yield low, m.start()
        low = m.end()
    yield low, high


def _tokens_back(text: str, low: int, at: int, most: int = MOST_TOKENS) -> int:
    """The start of the token ``most`` before ``at``, or low."""
    size = 8 * most
    while True:
        start = max(low, at - size)
        tokens = [m.start() for m in TOKEN.finditer(text, start, at)][start > low :]  # the first may be cut
        if len(tokens) >= most:
            return tokens[-most]
        if start == low:
            return low
        size *= 4


def _tokens_on(text: str, at: int, high: int, most: int = MOST_TOKENS) -> int:
    """The end of the token ``most`` after ``at``, or high."""
    for k, token in enumerate(TOKEN.finditer(text, at, high), 1):
        if k == most:
            return token.end()
    return high


def _stretches(text: str, low: int, high: int) -> list[tuple[int, int, list[int]]]:
    """Disjoint stretches, with their marks, that hold all candidates of text[low:high] and at least
    one more token on either side: runs of digit groups that are enough for a candidate, and
    what lies within reach of marks with something like a domain behind them."""
    spans = []
    for m in RUN.finditer(text, low, high):
        groups = DIGITS.findall(m[0])
        if len(groups) >= 4 or sum(map(len, groups)) >= LEAST_DIGITS:
            spans.append((_tokens_back(text, low, m.start(), MOST_BETWEEN + 1), _tokens_on(text, m.end(), high, 1), []))
    for m in MARK.finditer(text, low, high):
        if DOMAIN_AHEAD.match(text, m.start(), high):
            spans.append((_tokens_back(text, low, m.start()), _tokens_on(text, m.end(), high), [m.start()]))
    out: list[list] = []
    for start, end, marks in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
            out[-1][2] += marks
        else:
            out.append([start, end, marks])
    return [(start, end, sorted(marks)) for start, end, marks in out]


def _line(rng: random.Random) -> tuple[str, list[Span]]:
    """A line of invented words with annotated entities and look-alikes."""
    syllables = ("an", "er", "the", "ou", "re", "ti", "os", "de", "la", "ie", "ment", "che", "ra", "no")
    word = lambda: "".join(rng.choices(syllables, k=rng.randrange(1, 4)))
    number = lambda n: "".join(rng.choices("0123456789", k=n))

    def email() -> str:
        at = rng.choice(["@", " at ", " at ", " (at) ", "[at]", " [at] ", "(at)"])
        dot = "." if at == "@" or rng.random() < (0.5 if at == " at " else 0.3) else rng.choice([" dot ", "[dot]", " (dot) "])
        return f"{word()}{rng.choice(['', '.', '_'])}{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'example' + dot + 'com'])}"

    def ip() -> str:
        sep = rng.choice([".", ".", "[.]", " . ", ","])
        return sep.join(str(rng.randrange(1, 256)) for _ in range(4))

    def card() -> str:
        stem = rng.choice("345") + number(rng.choice([14, 14, 13]))
        digits = next(stem + c for c in "0123456789" if luhn(stem + c))
        sep = rng.choice(["", " ", "-", ".", "/"])
        return sep.join(digits[i : i + 4] for i in range(0, len(digits), 4)) if sep else digits

    def phone() -> str:
        a, b, c = str(rng.randrange(200, 990)), str(rng.randrange(200, 990)), number(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{rng.randrange(1, 99)} ({a}) {b}-{c}", f"+{rng.randrange(1, 99)} {a} {b} {c}", f"001 {a} {b} {c}", f"1-{a}-{b}-{c}"])

    def other() -> str:
        return rng.choice(
            [
                f"{rng.randrange(1990, 2030)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}",
                f"{rng.randrange(1, 29):02}/{rng.randrange(1, 13):02}/{rng.randrange(1990, 2030)}",
                f"{rng.randrange(1, 999)},{number(3)},{number(3)}.{number(2)}",
                f"{rng.randrange(9)}.{rng.randrange(20)}.{rng.randrange(30)}",
                f"{rng.randrange(300, 999)}.{number(3)}.{number(3)}.{number(3)}",
                "".join(next(str(9 - int(x[-1])) + x for x in [number(15)])),
                f"978-{number(1)}-{number(2)}-{number(6)}-{number(1)}",
                number(rng.choice([4, 5, 6, 8, 9, 12, 20, 24])),
                f"{number(5)}-{number(4)}",
                f"{number(2)}:{number(2)}:{number(2)}",
                f"{word()} at {word()}",
                f"@{word()}",
                f"{word()} at the dot {word()}",
                f"{rng.choice(common)} at {word()}.{rng.choice(['com', 'org', 'net', word()])}",
                f"{rng.choice(common)} at www.{word()}.com",
                f"{word()} at {word()}.{word().capitalize()}",
                f"{number(2)} {number(2)} {number(2)} {number(2)}",
                " ".join(number(rng.randrange(1, 4)) for _ in range(rng.randrange(3, 9))),
                ", ".join(number(rng.randrange(1, 5)) for _ in range(rng.randrange(3, 9))),
                f"#{number(7)}",
                f"${number(7)}.00",
                f"{number(3)} {number(3)} {number(3)} {number(3)} {number(3)} {number(3)}",
            ]
        )

    common = sorted(COMMON)
    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    text, spans = "", []
    for _ in range(rng.randrange(2, 5)):
        if text or rng.random() < 0.8:
            text += " ".join(word() for _ in range(rng.randrange(1, 5))) + " "
        if rng.random() < 0.55:
            kind = rng.choice(KINDS)
            if rng.random() < 0.4:
                text += rng.choice(CUES[kind]) + rng.choice([" ", ": ", " is "])
            value = makers[kind]()
            if kind == "card" and not luhn(NOT_DIGITS.sub("", value)):
                continue
            spans.append((kind, len(text), len(text) + len(value)))
        else:
            value = other()
            if value.isdigit() and len(value) >= 13 and luhn(value):
                value = value[:12]
        text += value + rng.choice([" ", ". ", ", ", "\n"])
    return text + word(), spans


def _total(x: np.ndarray, axis: int) -> np.ndarray:
    """log of the sum of exp."""
    top = x.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


class Lattice:
    """The candidate segments of one line, with their features as rows of the weights."""

    def __init__(self, text: str, gold: list[Span], names: dict[str, int]):
        tokens = [m.span() for m in TOKEN.finditer(text)]
        marks = [m.start() for m in MARK.finditer(text)]
        spans = {(a, b): kind for kind, a, b in gold}
        self.n, self.steps, features, self.gold = len(tokens), [], [], []
        for j, starts in candidates(text, tokens, marks):
            first = len(features)
            for i in starts:
                a, b = tokens[i][0], tokens[j - 1][1]
                if (a, b) in spans:
                    self.gold.append((len(features), i, j, KINDS.index(spans.pop((a, b)))))
                features.append([names.setdefault(f, len(names)) for f in span_features(text, a, b)])
            self.steps.append((j, np.array(starts), slice(first, len(features))))
        self.whole = not spans  # every annotated entity is among the candidates
        self.rows = np.array([f for x in features for f in x], np.int64)
        self.segment = np.repeat(np.arange(len(features)), [len(x) for x in features])
        self.n_segments = len(features)

    def gradient(self, weights: np.ndarray, moves: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """log-likelihood; its derivative by segment and kind; and by transition."""
        n, never = self.n, -np.inf
        scores = np.zeros((self.n_segments, len(KINDS)))
        np.add.at(scores, self.segment, weights[self.rows])
        alpha, beta = np.full((n + 1, STATES), never), np.full((n + 1, STATES), never)
        alpha[0, OUTSIDE], beta[n] = 0.0, 0.0
        ends = {j: (starts, at) for j, starts, at in self.steps}
        for j in range(1, n + 1):
            alpha[j, OUTSIDE] = _total(alpha[j - 1] + moves[:, OUTSIDE], 0)
            if j in ends:
                starts, at = ends[j]
                alpha[j, :OUTSIDE] = _total(_total(alpha[starts][:, :, None] + moves[None, :, :OUTSIDE], 1) + scores[at], 0)
        whole = _total(alpha[n], 0)
        # backwards: what can follow position i in state y, and the expected counts on the way
        expected, crossed = np.zeros_like(scores), np.zeros_like(moves)
        for j in range(n, 0, -1):
            out = moves[:, OUTSIDE] + beta[j, OUTSIDE]
            crossed[:, OUTSIDE] += np.exp(alpha[j - 1] + out - whole)
            if j in ends:
                starts, at = ends[j]
                step = moves[None, :, :OUTSIDE] + (scores[at] + beta[j, :OUTSIDE])[:, None, :]
                share = np.exp(alpha[starts][:, :, None] + step - whole)
                expected[at] += share.sum(axis=1)
                crossed[:, :OUTSIDE] += share.sum(axis=0)
                np.logaddexp.at(beta, starts, _total(step, 2))
            beta[j - 1] = np.logaddexp(beta[j - 1], out)
        found, by_segment, by_move, state, at = -whole, -expected, -crossed, OUTSIDE, 0
        for segment, i, j, kind in [*self.gold, (None, n, n, None)]:
            for _ in range(i - at):
                found += moves[state, OUTSIDE]
                by_move[state, OUTSIDE] += 1
                state = OUTSIDE
            if segment is not None:
                found += scores[segment, kind] + moves[state, kind]
                by_segment[segment, kind] += 1
                by_move[state, kind] += 1
                state, at = kind, j
        return found, by_segment, by_move


@lru_cache(maxsize=1)
def trained(lines: int = 1000, rounds: int = 5, seed: int = 5) -> Weights:
    """Weights of most conditional likelihood, with a slight penalty, by AdaGrad over small
    batches of lines; deterministic."""
    rng, names = random.Random(seed), {}
    data = [Lattice(*_line(rng), names) for _ in range(lines)]
    data = [x for x in data if x.whole]
    weights, moves = np.zeros((len(names), len(KINDS))), np.zeros((STATES, STATES))
    squares = [np.full_like(weights, 1e-6), np.full_like(moves, 1e-6)]
    for _ in range(rounds):
        rng.shuffle(data)
        for start in range(0, len(data), 8):
            batch = data[start : start + 8]
            slopes = [-PENALTY * len(batch) * weights, -PENALTY * len(batch) * moves]
            for line in batch:
                _, by_segment, by_move = line.gradient(weights, moves)
                np.add.at(slopes[0], line.rows, by_segment[line.segment])
                slopes[1] += by_move
            for x, slope, square in zip((weights, moves), slopes, squares):
                square += slope**2
                x += RATE * slope / np.sqrt(square)
    kept = {f: tuple(np.round(weights[k], 4).tolist()) for f, k in names.items()}
    return kept, tuple(map(tuple, np.round(moves, 4).tolist()))


def all_spans(text: str, model: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """(base, added): what the model adds never touches a base span."""
    base = base_spans(text)
    added: list[Span] = []
    low = 0
    for a, b in [*sorted((a, b) for _, a, b in base), (len(text), len(text))]:
        if a > low:
            added += model.decode(text, low, a)
        low = max(low, b)
    return base, sorted(set(added), key=lambda s: (KINDS.index(s[0]), s[1]))


FOUND = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))])


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, base), by kind and start."""
    weights = docs.sparkSession.sparkContext.broadcast(trained())

    @releasing
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(weights.value)
        for batch in batches:
            out = []
            for text in batch["text"]:
                base, added = all_spans(text_of(text.as_py()), model)
                spans = [(*s, True) for s in base] + [(*s, False) for s in added]
                spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                out.append([dict(zip(("kind", "start", "end", "base"), s)) for s in spans])
            yield batch_of(FOUND, batch["doc_id"], out)

    return docs.select("doc_id", "text").mapInArrow(find, "doc_id long, spans array<struct<kind:string,start:long,end:long,base:boolean>>")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span, or union of overlapping spans, replaced by its kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """docs with personal data in ``text`` replaced; all columns stay, a null text stays null."""
    weights = docs.sparkSession.sparkContext.broadcast(trained())

    @releasing
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SemiMarkov(weights.value)
        for batch in batches:
            texts = []
            for t in batch["text"].to_pylist():
                if t:
                    base, added = all_spans(t, model)
                    t = redacted(t, base + added) if base or added else t
                texts.append(t)
            k = batch.schema.get_field_index("text")
            yield batch.set_column(k, batch.schema.field(k), pa.array(texts, batch.schema.field(k).type))

    return docs.mapInArrow(replace, docs.schema)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["base"])
    of_kind = lambda k: F.filter(base, lambda s: s["kind"] == k)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
