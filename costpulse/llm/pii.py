"""Personal data: exact base patterns and a semi-Markov conditional random field.

Base spans follow four patterns (email, ip, card, phone; leftmost, not overlapping per kind), found
from anchor characters in linear time whatever the text.

The CRF adds spans the patterns miss, such as ``name at host dot com``, ``10[.]0[.]0[.]1``, cards
grouped by dots or phone numbers without ``+``. Around every digit or at sign (and "at" written
in brackets or between words with a "dot" after it) a zone is cut out and tokenised. Every span of
up to ``MAX_TOKENS`` tokens that has one of the rough shapes is a candidate segment; its features
describe the whole span (strict and rough shape, Luhn, digit count, cut-off neighbours, key
words before it). A labelling of a zone is a sequence of segments, each a typed entity or a
single token outside; the score of a segment is the dot product of its type's weights and its
features. Viterbi over entity lengths bounded by ``MAX_TOKENS`` chooses boundaries and types
together. Weights maximise the conditional likelihood (forward-backward over segments) of the
base spans of a bounded sample of texts, plus two copies of them in which every span is rewritten
into a rough form under the same label.

Decoded spans that touch a base span are dropped, so base spans always stay as they are. Null
texts count as empty. Rows are handled one by one, whatever their ids.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costpulse.llm.common import bounded_sample

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
REACH = 48                 # characters a zone reaches over single spaces around an anchor
PER_LABEL = 150
MAX_BYTES = 2 << 20
EPOCHS = 30

_DIGITS = re.compile(r"[0-9]+")
_USER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    odd = [int(c) for c in digits[-1::-2]]
    even = [2 * int(c) for c in digits[-2::-2]]
    return (sum(odd) + sum(x - 9 * (x > 9) for x in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, by kind, then start."""
    out = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _USER:
            start -= 1
        m = _HOST.match(text, at) if start < at else None
        if m:
            end = m.end()
            out.append((0, start, end))
        at = text.find("@", max(at + 1, end if m else 0))
    ip_end = card_end = 0
    ips, cards = [], []
    for m in _DIGITS.finditer(text):
        at = m.start()
        if at >= ip_end and text[m.end():m.end() + 1] == "." and (x := _IP.match(text, at)):
            ip_end = x.end()
            if all(len(p) < 20 and int(p) <= 255 for p in _parts(x.group())):
                ips.append((1, at, ip_end))
        if at >= card_end and (x := _CARD.match(text, at)):
            card_end = x.end()
            digits = re.sub("[^0-9]", "", x.group()) if x.end() - at <= 40 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append((2, at, card_end))
    out += ips + cards
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, at, m.end()))
        at = text.find("+", m.end() if m else at + 1)
    return out


def _parts(ip: str) -> list[str]:
    return [p.lstrip("0") or "0" for p in ip.split(".")]


# ---- zones, tokens, candidate segments ---------------------------------------------------

_ANCHOR = re.compile(r"[0-9@]+|[\[(] ?at ?[\])]| at (?=\S{1,40} dot )")
_TOKEN = re.compile(r"[A-Za-z0-9_%]+|[^A-Za-z0-9_%]")
_AT = r"(?:@|\s?[\[(]\s?at\s?[\])]\s?|\sat\s)"
_DOT = r"(?:\.|\s?[\[(]\s?dot\s?[\])]\s?|\sdot\s)"
_ROUGH_EMAIL = re.compile(rf"[\w%+-]+(?:\.[\w%+-]+)*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
_ROUGH_IP = re.compile(r"[0-9]{1,3}(?:(?:\.|\s?\[\.\]\s?|\s?\(\.\)\s?|\sdot\s|\s\.\s)[0-9]{1,3}){3}")
_ROUGH_CARD = re.compile(r"[0-9]{4,6}(?:[ ./-]?[0-9]{3,6}){2,4}")
_ROUGH_PHONE = re.compile(r"(?:\+|00)?\(?[0-9]{1,4}\)?(?:[ ./-]{1,2}\(?[0-9]{2,4}\)?){2,5}")
_CUES = (re.compile(r"mail|contact|write", re.I), re.compile(r"\bip\b|host|server|address", re.I),
         re.compile(r"card|visa|credit|payment", re.I), re.compile(r"tel|phone|call|mobile|fax", re.I))
_STRICT = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), _IP, _CARD, _PHONE)
N_FEATURES = 17


def zones(text: str) -> list[tuple[int, int]]:
    """Non-overlapping stretches around anchors, ending at white space, in order."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        if out and m.end() <= out[-1][1]:
            continue
        lo, hi = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        lo = max(lo, text.rfind("\n", lo, m.start()) + 1)
        if lo > 0 and not text[lo - 1].isspace():
            cut = text.find(" ", lo, m.start())
            lo = cut + 1 if cut >= 0 else lo
        stop = text.find("\n", m.end(), hi)
        hi = stop if stop >= 0 else hi
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(a, b) for a, b in out]


def features(text: str, a: int, b: int) -> list[float] | None:
    """Whole-span features of text[a:b], or None if it has no entity's rough shape."""
    s = text[a:b]
    digits = [c for c in s if "0" <= c <= "9"]
    n = len(digits)
    strict = [bool(p.fullmatch(s)) for p in _STRICT]
    rough = [bool(_ROUGH_EMAIL.fullmatch(s)), n >= 4 and bool(_ROUGH_IP.fullmatch(s)),
             12 <= n <= 19 and bool(_ROUGH_CARD.fullmatch(s)),
             9 <= n <= 15 and bool(_ROUGH_PHONE.fullmatch(s))]
    if strict[1] or rough[1]:
        octets = all(len(x) < 20 and int(x) <= 255 for x in _DIGITS.findall(s))
        strict[1], rough[1] = strict[1] and octets, rough[1] and octets
    checked = 12 <= n <= 19 and luhn("".join(digits))
    strict[2] = strict[2] and 16 <= n <= 19 and checked
    rough[2] = rough[2] and checked
    strict[3] = strict[3] and 8 <= n <= 15
    if not any(strict) and not any(rough):
        return None
    before, after = text[max(0, a - 2):a], text[b:b + 2]
    cut_left = bool(before) and (before[-1].isalnum() or (
        before[-1] in "._%+-@(/" and len(before) > 1 and before[0].isalnum()) or before[-1] in "+("
        and s[0].isdigit())
    cut_right = bool(after) and (after[0].isalnum() or (
        after[0] in "._%+-@)/" and len(after) > 1 and after[1].isalnum()))
    cue = text[max(0, a - 24):a]
    return [1.0, *map(float, strict), *map(float, rough), float(cut_left), float(cut_right),
            float(checked), min(n, 20) / 20, *(float(bool(c.search(cue))) for c in _CUES)]


def lattice(text: str, lo: int, hi: int):
    """(number of tokens, [(first token, token after last, start, end)], feature matrix)."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, lo, hi)]
    spans, rows = [], []
    for i, (a, _) in enumerate(tokens):
        c = text[a]
        if not (c.isalnum() or c in "+("):
            continue
        seen = False                             # a span needs a digit or an at sign somewhere
        for j in range(i, min(i + MAX_TOKENS, len(tokens))):
            p, b = tokens[j]
            seen = seen or any("0" <= x <= "9" or x == "@" for x in text[p:b]) or text[p:b] == "at"
            if not seen or not (text[b - 1].isalnum() or text[b - 1] == ")") or b - a < 7:
                continue
            f = features(text, a, b)
            if f:
                spans.append((i, j + 1, a, b))
                rows.append(f)
    return len(tokens), spans, np.array(rows).reshape(len(spans), N_FEATURES)


def viterbi(n: int, spans, scores: np.ndarray) -> list[tuple[int, int]]:
    """(span number, type) of the best segmentation; ``scores`` is spans x types, tokens outside
    score 0, ties prefer fewer entities."""
    ends: dict[int, list[int]] = {}
    for k, s in enumerate(spans):
        ends.setdefault(s[1], []).append(k)
    best, back = [0.0] * (n + 1), [None] * (n + 1)
    for t in range(1, n + 1):
        best[t] = best[t - 1]
        for k in ends.get(t, ()):
            y = int(scores[k].argmax())
            value = best[spans[k][0]] + scores[k][y]
            if value > best[t] + 1e-12:
                best[t], back[t] = value, (k, y)
    out, t = [], n
    while t > 0:
        if back[t]:
            out.append(back[t])
            t = spans[back[t][0]][0]
        else:
            t -= 1
    return out[::-1]


def marginals(n: int, spans, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """(log partition function, probability of every (span, type))."""
    starts: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    for k, s in enumerate(spans):
        starts.setdefault(s[0], []).append(k)
        ends.setdefault(s[1], []).append(k)
    total = np.logaddexp.reduce(scores, axis=1) if len(spans) else np.zeros(0)
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    for t in range(1, n + 1):
        forward[t] = np.logaddexp.reduce([forward[t - 1], *(forward[spans[k][0]] + total[k]
                                                            for k in ends.get(t, ()))])
    for t in range(n - 1, -1, -1):
        backward[t] = np.logaddexp.reduce([backward[t + 1], *(backward[spans[k][1]] + total[k]
                                                              for k in starts.get(t, ()))])
    outer = np.array([forward[s[0]] + backward[s[1]] for s in spans]) - forward[n]
    return forward[n], np.exp(outer[:, None] + scores)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray        # types x features


def _rewritten(text: str, spans, form: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its base spans in rough form 0 or 1, and where they are now."""
    out, found, at = "", [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < at:
            continue
        s = text[a:b]
        if kind == 0:
            user, host = s.split("@")
            s = f"{user} at {host.replace('.', ' dot ')}" if form else f"{user} [at] {host}"
        elif kind == 1:
            s = s.replace(".", " dot " if form else "[.]")
        elif kind == 2:
            d = re.sub("[^0-9]", "", s)
            s = ("/" if form else ".").join(d[i:i + 4] for i in range(0, len(d), 4))
        else:
            s = (" " if form else "-").join(_DIGITS.findall(s))
        out += text[at:a]
        found.append((kind, len(out), len(out) + len(s)))
        out += s
        at = b
    return out + text[at:], found


def _train(texts: list[str], epochs: int) -> Model:
    cases = []
    for text in texts:
        spans = base_spans(text)
        for t, gold in ((text, spans), _rewritten(text, spans, 0), _rewritten(text, spans, 1)):
            want = {(a, b): k for k, a, b in gold}
            for lo, hi in zones(t):
                n, candidates, f = lattice(t, lo, hi)
                if not candidates:
                    continue
                target = np.zeros((len(candidates), len(KINDS)))
                taken = 0
                for i, (first, after, a, b) in enumerate(candidates):
                    if (a, b) in want and first >= taken:
                        target[i, want[a, b]] = 1
                        taken = after
                cases.append((n, candidates, f, target))
    w = np.zeros((len(KINDS), N_FEATURES))
    w[:, 0] = -1.0                               # without evidence, nothing is personal data
    memory = np.full_like(w, 1e-3)
    for _ in range(epochs):
        grad = -0.5 * w
        for n, candidates, f, target in cases:
            _, p = marginals(n, candidates, f @ w.T)
            grad += (target - p).T @ f
        memory += grad * grad
        w += 1.0 * grad / np.sqrt(memory)
    return Model(w)


def fit(docs: DataFrame, text: str = "text", per_label: int = PER_LABEL,
        max_bytes: int = MAX_BYTES) -> Model:
    """Train on a bounded sample of texts with digits or at signs; no ids or labels are used."""
    marked = docs.filter(F.col(text).rlike("[0-9@]")).select(
        F.when(F.col(text).contains("@"), "@").otherwise("0").alias("_kind"),
        F.col(text).cast("string").alias("_text"))
    return _train([t for _, _, t in bounded_sample(marked, "_kind", "_text", per_label, max_bytes)],
                  EPOCHS)


def added_spans(text: str, base, model: Model) -> list[tuple[int, int, int]]:
    """Decoded (kind, start, end) that touch no base span."""
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for lo, hi in zones(text):
        n, spans, f = lattice(text, lo, hi)
        if spans:
            out += [(y, spans[k][2], spans[k][3]) for k, y in viterbi(n, spans, f @ model.weights.T)]
    clear, i, reach = [], 0, 0
    for y, a, b in sorted(out, key=lambda s: (s[1], s[2])):
        while i < len(taken) and taken[i][0] < b:
            reach = max(reach, taken[i][1])
            i += 1
        if reach <= a:
            clear.append((y, a, b))
    return clear


def _text_of(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _scan(model: Model):
    def run(batches):
        for b in batches:
            counts, digests, alls = [[], [], [], []], [], []
            for text in b.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                for k in range(len(KINDS)):
                    counts[k].append(sum(1 for s in base if s[0] == k))
                digests.append(hashlib.sha256(_text_of(base).encode()).hexdigest())
                alls.append(_text_of(sorted(base + added_spans(text, base, model))))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(alls, pa.string())],
                [b.schema.names[0], *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def find(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row. The counts and the
    digest are those of the base spans; ``spans`` lists all, kind:start:end in code points."""
    slim = docs.select(F.col(key), F.col(text).cast("string").alias("_text"))
    kind = slim.schema[key].dataType.simpleString()
    return slim.mapInArrow(_scan(model), f"`{key}` {kind}, " + ", ".join(
        f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
