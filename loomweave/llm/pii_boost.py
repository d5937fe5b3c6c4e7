"""Personal data: candidate spans, boosted trees, calibrated thresholds.

Base spans (email, ip, card, phone) follow fixed rules and always stay.  High-
recall generators propose more spans, which may overlap: spelled-out mail
addresses, phone numbers without a plus, cards with other separators, IPv6
addresses (whole and with "::"), credentials.  Gradient boosted trees score each proposal by its
format and its surroundings; a threshold per kind, the least that keeps the
wanted precision on training data set aside, selects; of selected spans
that overlap the best score stays.  A secret runs to its value's end, whatever
its length: a selected one takes those inside it along, and where it overlaps
other spans the parts that they leave are still secret.

Trees are trained on seeds of every kind written in many ways (right and
spoiled) into surroundings from a bounded sample of the documents.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomweave.llm.io import sampled

KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the method finds come after the base kinds.
ALL_KINDS = (*KINDS, "secret")
#: Documents whose surroundings train the trees, at most; training spans made of them.
SAMPLE = 2000
MADE = 6000
PRECISION = 0.99
#: Characters of a span that its features look at; spans themselves have any length.
VIEW = 256
#: No span with a lower score is added, whatever its kind's threshold.
LEAST = 0.8

# ------------------------------------------------------------------ base spans (fixed rules)
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_ANY_DIGITS = re.compile(r"\d")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: linear in the text however long its runs are."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            last = m.end()
            out.append((start, last))
            at = text.find("@", last)
        else:
            # a failed @ cannot be in a later match's local part
            last = max(last, at + 1)
            at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 13 <= len(d := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


# ------------------------------------------------------------------ candidates
_CUES = {"email": ("mail", "contact", "write"), "ip": ("ip", "host", "addr", "server"), "card": ("card", "visa", "credit", "pay"),
         "phone": ("tel", "phone", "call", "mobile", "fax"), "secret": ("password", "passwd", "pwd", "token", "secret", "key", "auth")}
_G_SECRET = re.compile(r"(?i)(?:password|passwd|pwd|token|secret|api[_-]?key|key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"',;]{6,}+)")
_G_CODE = re.compile(r"(?<![0-9A-Za-z])(?=[A-Za-z]*+[0-9])[0-9A-Za-z_]{20,}+")
_G_EMAIL = re.compile(r"(?i)(?<![\w.+%-])[\w.+%-]++(?:\s?[(\[]\s?at\s?[)\]]\s?|\sat\s)[\w-]++(?:(?:\s?[(\[]\s?dot\s?[)\]]\s?|\sdot\s|\.)[\w-]{2,}+)++")
#: In every match of _G_EMAIL.
_AT = re.compile(r"(?i)[\s(\[]at[\s)\]]")
_G_PHONE = re.compile(r"(?<![\d+.(-])(?:00\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\d.-])")
_G_CARD = re.compile(r"(?<![\d.])\d{4}([./_])(?:\d{4}\1\d{4}\1\d{1,7}|\d{6}\1\d{4,5})(?![\d.])")
_G_KEY = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}KEY(?: BLOCK)?-----")
_KEY_BODY = re.compile(r"(?:\s*+[A-Za-z0-9+/]{16,}+)*+(?:[A-Za-z0-9+/]*+={1,2}|\s*+[A-Za-z0-9+/]++={1,2})?")
_G_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
#: Compressed IPv6: at most 7 groups, one of them at least, on both sides of the "::".
_G_IP_SHORT = re.compile(r"(?<![\w:.])((?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+)?+)::((?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}+)?+)(?![\w:])")


def key_blocks(text: str) -> list[tuple[int, int]]:
    """Key files set in a text, whole: to the end mark, or as far as the body goes where there is none."""
    out, at, ends = [], 0, True
    while m := _G_KEY.search(text, at):
        stop = text.find("-----END ", m.end()) if ends else -1
        ends = stop >= 0
        close = text.find("-----", stop + 9) if ends else -1
        at = close + 5 if close >= 0 else m.end() + len(_KEY_BODY.match(text, m.end()).group())
        out.append((m.start(), at))
    return out


def candidates(text: str) -> list[tuple[str, int, int]]:
    """High-recall proposals beside the base spans; they may overlap.

    What decides whether a generator runs holds wherever it has a match, so a
    span is proposed whatever else the text says.
    """
    out = []
    if _AT.search(text):
        out += [("email", *m.span()) for m in _G_EMAIL.finditer(text)]
    blocks = key_blocks(text) if "-----BEGIN " in text else []
    secrets = [m.span(1) for m in _G_SECRET.finditer(text)] if "=" in text or ":" in text else []
    secrets += [m.span() for m in _G_CODE.finditer(text)] if _DIGITS.search(text) else []
    if blocks:      # what lies in a key file is part of it
        starts = [a for a, _ in blocks]
        secrets = [(a, z) for a, z in secrets if not any(z > b[0] and a < b[1] for b in blocks[max(0, bisect.bisect_left(starts, a) - 1):bisect.bisect_left(starts, z)])]
    out += [("secret", a, z) for a, z in blocks + secrets]
    if _ANY_DIGITS.search(text):
        out += [("phone", *m.span()) for m in _G_PHONE.finditer(text)]
        out += [("card", *m.span()) for m in _G_CARD.finditer(text)]
    if ":" in text:
        out += [("ip", *m.span()) for m in _G_IP.finditer(text)]
    if "::" in text:
        for m in _G_IP_SHORT.finditer(text):
            if 1 <= sum(1 + side.count(":") for side in m.groups() if side) <= 7:
                out.append(("ip", *m.span()))
    return out


_ENDING = re.compile(r"(?i)(?:com|org|net|edu|gov|info|io|eu|uk|de|fr|es|it|nl|ch|at|us|ca|au)\Z")


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span (its first VIEW characters) and its surroundings (32 characters to either side)."""
    s, left, right = text[start:min(end, start + VIEW)], text[max(0, start - 32):start], text[end:end + 32]
    n = len(s)
    digits, letters = sum(map(str.isdigit, s)), sum(map(str.isalpha, s))
    share = [s.count(c) / n for c in set(s)]
    runs = [len(r) for r in re.findall(r"\d+", s)]
    only = re.sub(r"\D", "", s)
    cue = left.lower()
    return [float(kind == k) for k in ALL_KINDS] + [
        float(n), digits / n, letters / n, sum(map(str.isupper, s)) / n, float(len(re.findall(r"[^0-9A-Za-z]", s))),
        len(share) / n, -sum(p * math.log2(p) for p in share), len(re.findall(r"[0-9a-fA-F]", s)) / n,
        float(13 <= len(only) <= 19 and only.isascii() and luhn(only)), float(len(runs)), float(max(runs, default=0)), float(digits),
        float(any(c in cue for c in _CUES[kind])), float(bool(re.search(r"[:=]\s*[\"']?$", left))), float(not left or left[-1].isspace()),
        float(not right or right[0].isspace() or right[0] in ".,;\"')"), sum(map(str.isdigit, left + right)) / (len(left + right) + 1),
        float(bool(_ENDING.search(s))), float(any(c in s for c in "([")),
        float(bool(re.match(r"(?:19|20)\d\d\D|\d{1,2}\D\d{1,2}\D(?:19|20)\d\d", s)))]


# ------------------------------------------------------------------ boosted trees
@dataclass
class Trees:
    """Regression trees of depth 3 over quantile cuts, fitted to the logistic loss."""

    start: float
    nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]]       # per tree: feature and cut of 7 nodes, value of 8 leaves
    threshold: dict[str, float]

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, value in self.nodes:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(3):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += value[at - 7]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, ridge: float = 1.0) -> Trees:
    """Gradient boosting with second-order leaf values."""
    prior = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Trees(float(np.log(prior / (1 - prior))), [], {})
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.03, 0.97, 32))) for j in range(x.shape[1])]
    margin = np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, cut, value = np.zeros(7, dtype=np.int64), np.full(7, np.inf), np.zeros(8)
        at = np.zeros(len(x), dtype=np.int64)
        for node in range(7):
            own = np.flatnonzero(at == node)
            best = (1e-6, 0, np.inf)
            if len(own) > 8:
                gs, hs = g[own].sum(), h[own].sum()
                for j, c in enumerate(cuts):
                    right = x[own, j][:, None] > c[None, :]
                    gr, hr = g[own] @ right, h[own] @ right
                    gain = gr ** 2 / (hr + ridge) + (gs - gr) ** 2 / (hs - hr + ridge) - gs ** 2 / (hs + ridge)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), j, float(c[k]))
            feature[node], cut[node] = best[1], best[2]
            at[own] = 2 * node + 1 + (x[own, best[1]] > best[2])
        for leaf in range(8):
            own = at == 7 + leaf
            value[leaf] = -rate * g[own].sum() / (h[own].sum() + ridge) if own.any() else 0.0
        model.nodes.append((feature, cut, value))
        margin += value[at - 7]
    return model


# ------------------------------------------------------------------ training
def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random, good: bool) -> str:
    body = rng.choice("3456") + _digits(rng, 14)
    last = next(d for d in "0123456789" if luhn(body + d))
    return body + (last if good else str((int(last) + rng.randrange(1, 10)) % 10))


_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def made(rng: random.Random, word: str) -> tuple[str, bool]:
    """A text with one span, right or spoiled, in one of many spellings."""
    kind, good = rng.choice(ALL_KINDS), rng.random() < 0.5
    if kind == "email":
        at, dot = rng.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("(at)", "(dot)"), ("[at]", ".")])
        if good:
            return f"{word}{rng.choice(['.', '_', ''])}{_digits(rng, rng.randrange(3))}{at}{rng.choice(['mail', 'post', word])}{dot}{rng.choice(['com', 'org', 'net', 'de'])}", True
        return rng.choice([f"{word} at {word}.{word}", f"{word} at the dot {word}", f"look at {word} dot"]), False
    if kind == "ip":
        short = rng.random() < 0.5
        if short and good:
            net = rng.choice(["2001:db8", f"2001:{rng.randrange(1, 1 << 12):x}", f"2a0{_digits(rng, 1)}:{rng.randrange(1 << 16):x}", "fe80", f"fd{rng.randrange(256):02x}:{rng.randrange(1 << 16):x}"])
            return net + "::" + ":".join("%x" % rng.randrange(1, 1 << rng.choice([4, 8, 16])) for _ in range(rng.randrange(1, 5))), True
        if short:
            return rng.choice(["::".join(rng.choice(["add", "bad", "dead", "face", "fade", "feed", "cafe", "a", "b", "c", "de", "ed"]) for _ in range(2)),
                               f"{rng.choice(['a', 'b', 'c', 'd', 'f'])}::{rng.choice(['add', 'dec', 'a', 'b'])}", f"{_digits(rng, rng.randrange(1, 3))}::{_digits(rng, rng.randrange(1, 3))}"]), False
        if good:
            return ":".join("%x" % rng.randrange(1 << 16) for _ in range(8)), True
        return rng.choice([f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}", f"{_digits(rng, 1)}:{_digits(rng, 2)}:{_digits(rng, 2)}:{_digits(rng, 2)}"]), False
    if kind == "card":
        d, sep = _card(rng, good), rng.choice("./_")
        if rng.random() < 0.3:
            body = "3" + rng.choice("47") + _digits(rng, 12)
            d = body + next(x for x in "0123456789" if luhn(body + x) == good)
            return sep.join([d[:4], d[4:10], d[10:]]), good
        return sep.join(d[i:i + 4] for i in range(0, 16, 4)), good
    if kind == "phone":
        a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
        if good:
            return rng.choice(["", "tel ", "phone: ", "call "]) + rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"001 {a} {b} {c}", f"({a}){b}-{c}"]), True
        return rng.choice([f"{rng.randrange(1900, 2030)}-{_digits(rng, 3)}-{_digits(rng, 3)}", f"{a}.{b}.{_digits(rng, 3)}", f"{_digits(rng, 4)} {_digits(rng, 4)} {_digits(rng, 4)}", f"{_digits(rng, 2)} {b} {_digits(rng, 3)}"]), False
    if good:
        if rng.random() < 0.1:
            lines = "\n".join("".join(rng.choice(_BASE64) for _ in range(64)) for _ in range(rng.randrange(1, 5)))
            name = rng.choice(["", "RSA ", "EC ", "OPENSSH "]) + "PRIVATE KEY"
            return rng.choice(["", "key = ", "key: "]) + f"-----BEGIN {name}-----\n{lines}\n-----END {name}-----", True
        code = "".join(rng.choice("0123456789abcdef" if rng.random() < 0.8 else "ghijkXYZ0189") for _ in range(rng.choice([12, 16, 18, 24, 32, 40, 64])))
        name = rng.choice(["password", "token", "secret", "api_key", "key", "pwd"])
        return name + rng.choice(["=", " = ", ": ", ' = "', '="', ":"]) + code, True
    return rng.choice([f"{rng.choice(['key', 'token', 'password'])}: {word}{word[:4]}", f"key = {word}ing", word * 3 + _digits(rng, 1), f"secret: {word.upper()}ED"]), False


def surroundings(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> list[tuple[str, str]]:
    """Left and right sides from the middle of at most SAMPLE documents, by the hash of their id."""
    t = F.col(text_col).cast("string")
    mid = (F.length(t) / 2).cast("int")
    d = docs.filter(F.length(t) > 0).select(F.xxhash64(F.lit("pii"), F.col(id_col).cast("string")).alias("h"), F.substr(t, F.greatest(mid - 40, F.lit(1)), F.lit(80)).alias("s"))
    return [(r["s"][:40], r["s"][40:]) for r in sampled(d, F.col("h"), SAMPLE, docs.count()).collect()]


def train(sides: list[tuple[str, str]], seed: int = 23) -> Trees:
    """Trees and thresholds; the same surroundings give the same model."""
    rng = random.Random(seed)
    sides = [(a, b) for a, b in sides if not base_spans(a + b) and not candidates(a + b)] or [("", "")]
    words = [w for a, b in sides for w in re.findall(r"[A-Za-z]{3,12}", a + b)] or ["word"]
    rows, truth, kinds = [], [], []
    for _ in range(MADE):
        left, right = rng.choice(sides)
        if rng.random() < 0.3:       # numbers nearby say nothing about a span
            number = _digits(rng, rng.randrange(1, 6))
            left, right = rng.choice([(f"{left} {number} {rng.choice(words)}", right), (left, f"{rng.choice(words)} {number} {right}")])
        body, good = made(rng, rng.choice(words).lower())
        text = f"{left} {body}{rng.choice([' ', '. ', ', ', chr(34) + ' '])}{right}"
        lo, hi = len(left) + 1, len(left) + 1 + len(body)
        for kind, s, e in candidates(text):
            if s < hi and e > lo:
                rows.append(features(text, kind, s, e))
                truth.append(float(good))
                kinds.append(kind)
    x, y = np.array(rows), np.array(truth)
    aside = np.arange(len(y)) % 4 == 0
    model = boost(x[~aside], y[~aside])
    score = model.score(x[aside])
    for kind in ALL_KINDS:
        own = np.array([k == kind for k in kinds])[aside]
        s, t = score[own], y[aside][own]
        order = np.argsort(-s)
        right = np.cumsum(t[order]) / np.arange(1, len(t) + 1)
        ok = np.flatnonzero(right >= PRECISION)
        model.threshold[kind] = float(max(LEAST, s[order][ok[-1]])) if len(ok) else 1.1
    return model


# ------------------------------------------------------------------ selection
def _outermost(chosen: list[tuple[float, tuple[str, int, int]]]) -> list[tuple[float, tuple[str, int, int]]]:
    """Without the secrets that lie inside another secret; of equal ones the first stays."""
    out, reach = [], 0
    for p, (kind, s, e) in sorted(chosen, key=lambda c: (c[1][1], -c[1][2])):
        if kind != "secret" or e > reach:
            out.append((p, (kind, s, e)))
        if kind == "secret":
            reach = max(reach, e)
    return out


def _left_over(text: str, taken: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """The parts of a span that no taken span covers and that hold a letter or digit."""
    parts, at = [], start
    for s, e in taken[max(0, bisect.bisect_left(taken, (start, start)) - 4):bisect.bisect_left(taken, (end, end))]:
        if e > at:
            parts.append((at, min(s, end)))
            at = e
    parts.append((at, end))
    return [(s, e) for s, e in parts if s < e and any(map(str.isalnum, text[s:e]))]


def find(text: str, model: Trees) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and the added ones, which overlap neither a base span nor each other."""
    base = base_spans(text)
    proposed = candidates(text)
    if not proposed:
        return base, []
    taken = sorted((s, e) for _, s, e in base)
    scores = model.score(np.array([features(text, *c) for c in proposed]))
    added = []
    chosen = [(p, c) for p, c in zip(scores, proposed, strict=True) if p >= model.threshold[c[0]]]
    for _, (kind, s, e) in sorted(_outermost(chosen), key=lambda c: (-c[0], c[1][1], -c[1][2])):
        if kind == "secret":
            for part in _left_over(text, taken, s, e):
                bisect.insort(taken, part)
                added.append((kind, *part))
            continue
        i = bisect.bisect_left(taken, (s, s))
        if (i and max(x[1] for x in taken[max(0, i - 4):i]) > s) or (i < len(taken) and taken[i][0] < e):
            continue
        bisect.insort(taken, (s, e))
        added.append((kind, s, e))
    return base, added


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (ALL_KINDS.index(x[0]), x[1], x[2])))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans are merged under the first one's kind."""
    out, at = [], 0
    for kind, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, model: Trees | None = None, id_col: str = "doc_id", text_col: str = "text", redacted: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (and the redacted text).

    Counts and hash are of the base spans, ``spans`` lists all; offsets are
    code points, ends exclusive.  Null text counts as empty.  Rows that repeat
    are searched each.  Other columns are not read.  An empty table gives no rows.
    """
    model = model or train(surroundings(docs, text_col, id_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                counts, hashes, spans, texts = {k: [] for k in KINDS}, [], [], []
                for t in part.column(1):
                    text = t.as_py() or ""
                    base, added = find(text, trees)
                    for k in KINDS:
                        counts[k].append(sum(x[0] == k for x in base))
                    hashes.append(hashlib.sha256(written(base).encode()).hexdigest())
                    spans.append(written(base + added))
                    if redacted:
                        texts.append(redact(text, base + added))
                cols = [part.column(0), *[pa.array(counts[k], pa.int64()) for k in KINDS], pa.array(hashes, pa.string()), pa.array(spans, pa.string())]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(texts, pa.string())] * redacted, names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", *["redacted"] * redacted])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shape = "doc_id bigint, " + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, spans string"
    return src.mapInArrow(run, shape + (", redacted string" if redacted else ""))
