"""Personal data by weak supervision.

Patterns propose spans; labelers (checksums, gazetteers, context) vote on each, for, against or
not at all. Expectation-maximisation over the counts of vote patterns of all documents estimates
how reliable each labeler is, and its posterior trains the classifier that decides on the spans.
Spans of the base patterns stay whatever it decides.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.base import map_batches, table
from tidemark.session import materialize

KINDS = ("email", "ip", "card", "phone", "ssn", "iban", "ipv6")
BASE_KINDS = KINDS[:4]

# Patterns of the formats.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ip = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_national = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])")
_ssn = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_iban = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_ipv6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_written = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\[at\]|\(at\)|(?<= )at(?= )) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\[dot\]|\(dot\)|(?<= )dot(?= )) ?[A-Za-z0-9-]{2,63}){1,4}"
)

# Gazetteers and cue words.
TOP_DOMAINS = frozenset("com org net edu gov io co info biz dev app de fr es it uk nl eu us ca jp cn in br".split())
IBAN_COUNTRIES = frozenset(
    "AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT JO KW KZ "
    "LB LC LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SC SE SI SK SM TL TN TR UA VG XK".split()
)
CUES = {
    "email": "mail contact write reply correo".split(),
    "ip": "ip address host server client login".split(),
    "card": "card visa credit debit payment tarjeta karte carte".split(),
    "phone": "phone tel call mobile cell fax dial telefon".split(),
    "ssn": "ssn social security taxpayer".split(),
    "iban": "iban account bank konto compte cuenta".split(),
    "ipv6": "ip address host server client login".split(),
}
COUNTER_CUES = "order invoice version isbn issn serial part model build release ticket sku".split()
CONTEXT = 40
LABELERS = ("checksum", "gazetteer", "cue", "counter_cue", "edges")
#: What the classifier sees besides the votes.
SHAPES = 4


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds in order, each by start.

    Runs before an ``@`` are walked backwards from it, and addresses begin where a run of digits
    does, so that long runs are read once, not from each of their characters.
    """
    spans = []
    floor = at = 0
    while (at := text.find("@", at)) >= 0:
        found = _domain.match(text, at)
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        if found and start < at:
            spans.append(("email", start, found.end()))
            floor = at = found.end()
        else:
            at += 1
    if not _digit.search(text):
        return spans
    for m in _ip.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            spans.append(("ip", *m.span()))
    for m in _card.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := digits_of(m.group())) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in _phone.finditer(text):
        if 8 <= len(digits_of(m.group())) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def digits_of(text: str) -> str:
    return "".join(_digit.findall(text))


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in doubled)) % 10 == 0


def mod97(text: str) -> bool:
    moved = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def proposed_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans in other notations that overlap no base span and none of each other."""
    found = []
    if _digit.search(text):
        for kind, pattern in (("iban", _iban), ("ipv6", _ipv6), ("ssn", _ssn), ("phone", _national)):
            found += [(kind, *m.span()) for m in pattern.finditer(text)]
        for m in _card.finditer(text):
            if 13 <= m.end() - m.start() <= 30 and 13 <= len(digits_of(m.group())) <= 15:
                found.append(("card", *m.span()))
    if any(x in text for x in ("[at]", "(at)", " dot ", "[dot]", "(dot)")):
        found += [("email", *m.span()) for m in _written.finditer(text)]
    # Busy spans are apart from each other and in order, so a new one has two neighbours to look at.
    busy: list[tuple[int, int]] = []
    for start, end in sorted((s, e) for _, s, e in taken):
        if busy and start < busy[-1][1]:
            busy[-1] = busy[-1][0], max(busy[-1][1], end)
        else:
            busy.append((start, end))
    out: list[tuple[str, int, int]] = []
    for kind, start, end in found:
        at = bisect_left(busy, (start, end))
        if (at == 0 or busy[at - 1][1] <= start) and (at == len(busy) or end <= busy[at][0]):
            out.append((kind, start, end))
            insort(busy, (start, end))
    return out


def votes(text: str, kind: str, start: int, end: int) -> tuple[list[int], int]:
    """A vote of each labeler (1, 0, -1) and the shape of the span."""
    span, before = text[start:end], text[max(0, start - CONTEXT) : start].lower()
    digits = digits_of(span) if kind != "email" else ""
    compact = span.replace(" ", "").replace("-", "")
    checksum = gazetteer = 0
    if kind == "card":
        checksum = 1 if luhn(digits) else -1
        gazetteer = 1 if digits[0] in "3456" else -1
    elif kind == "iban":
        checksum = 1 if mod97(compact) else -1
        gazetteer = 1 if span[:2] in IBAN_COUNTRIES else -1
    elif kind == "ssn":
        area, group, serial = digits[:3], digits[3:5], digits[5:]
        checksum = 1 if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000" else -1
    elif kind == "phone":
        area = digits[:3] if len(digits) == 10 else digits[-10:-7]
        gazetteer = 1 if area[:1] > "1" and area[1:] != "11" else -1
    elif kind == "email":
        gazetteer = 1 if re.split(r"[^A-Za-z0-9]+", span.rstrip(")]"))[-1].lower() in TOP_DOMAINS else -1
    elif kind == "ip":
        gazetteer = -1 if span.split(".")[0] in ("0", "127", "255") else 1
    cue = 1 if any(c in before for c in CUES[kind]) else 0
    counter = -1 if any(c in before for c in COUNTER_CUES) else 0
    around = text[start - 1 : start] + text[end : end + 1]
    edges = -1 if any(c.isalnum() or c == "_" for c in around) else 1
    shape = (1 if " " in span else 0) + (2 if "-" in span or "." in span else 0)
    return [checksum, gazetteer, cue, counter, edges], shape


SCAN = (
    "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base array<string>, base_sha256 string, "
    "extra array<struct<kind: string, start: bigint, end: bigint, votes: array<int>, shape: int>>, "
    "seen array<struct<kind: string, votes: array<int>, shape: int>>"
)


def scan_text(text: str | None) -> dict:
    text = text or ""
    base = base_spans(text)
    extra = []
    for kind, start, end in proposed_spans(text, base):
        v, shape = votes(text, kind, start, end)
        extra.append({"kind": kind, "start": start, "end": end, "votes": v, "shape": shape})
    seen = []
    for kind, start, end in base:
        v, shape = votes(text, kind, start, end)
        seen.append({"kind": kind, "votes": v, "shape": shape})
    named = [f"{k}:{s}:{e}" for k, s, e in base]
    counts = {f"n_{k}": sum(b[0] == k for b in base) for k in BASE_KINDS}
    digest = hashlib.sha256(",".join(named).encode()).hexdigest()
    return {**counts, "base": named, "base_sha256": digest, "extra": extra, "seen": seen}


def scan(docs: DataFrame) -> DataFrame:
    def run(rows: dict) -> dict:
        found = [scan_text(t) for t in rows["text"]]
        out = {"doc_id": rows["doc_id"]}
        for c in ("n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256", "extra", "seen"):
            out[c] = [f[c] for f in found]
        return out

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), run, "doc_id bigint, " + SCAN)


def reliabilities(patterns: np.ndarray, counts: np.ndarray, kinds: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior of each vote pattern by expectation-maximisation.

    ``patterns`` has a column per labeler; votes are independent given the truth, with a
    probability of their own for each labeler, vote and truth, and a prior for each kind. The
    start is the share of votes in favour.
    """
    chance = (1 + (patterns == 1).sum(1)) / (2 + (patterns != 0).sum(1))
    known = sorted(set(kinds))
    for _ in range(rounds):
        log_yes, log_no = np.zeros(len(patterns)), np.zeros(len(patterns))
        for kind in known:
            at = kinds == kind
            prior = (1 + (counts * chance)[at].sum()) / (2 + counts[at].sum())
            log_yes[at] += np.log(prior)
            log_no[at] += np.log(1 - prior)
        for column in patterns.T:
            for weight, into in ((chance, log_yes), (1 - chance, log_no)):
                total = (counts * weight).sum()
                for vote in (-1, 0, 1):
                    at = column == vote
                    into[at] += np.log((1 + (counts * weight)[at].sum()) / (3 + total))
        chance = 1 / (1 + np.exp(np.clip(log_no - log_yes, -500, 500)))
    return chance


def features(kinds, patterns: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    parts = [np.ones((len(patterns), 1))]
    parts.append(np.array([[k == x for x in KINDS] for k in kinds], float).reshape(len(patterns), len(KINDS)))
    parts += [(patterns == v).astype(float) for v in (-1, 1)]
    parts.append((shapes[:, None] == np.arange(SHAPES)).astype(float))
    return np.hstack(parts)


def fit_logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by Newton steps."""
    w = np.zeros(x.shape[1])
    scale = weight / max(weight.sum(), 1) * min(weight.sum(), 1e6)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (scale * (target - p)) - ridge * w
        hessian = (x * (scale * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(scanned: DataFrame) -> np.ndarray:
    """Classifier weights from the spans of all documents.

    Only counts of (kind, votes, shape) reach the driver: at most 7 kinds x 3^5 votes x 4 shapes.
    Spans of the base patterns are known to be right and enter as such.
    """
    both = scanned.select(
        F.explode(
            F.concat(
                F.transform("extra", lambda s: F.struct(s["kind"], s["votes"], s["shape"], F.lit(False).alias("base"))),
                F.transform("seen", lambda s: F.struct(s["kind"], s["votes"], s["shape"], F.lit(True).alias("base"))),
            )
        ).alias("s")
    )
    table = both.groupBy("s.kind", "s.votes", "s.shape", "s.base").agg(F.count("*").alias("n")).collect()
    if not table:
        return np.zeros(1 + len(KINDS) + 2 * len(LABELERS) + SHAPES)
    table = sorted(table, key=lambda r: (r["kind"], r["votes"], r["shape"], r["base"]))
    patterns = np.array([r["votes"] for r in table])
    counts = np.array([r["n"] for r in table], float)
    kinds = np.array([r["kind"] for r in table])
    shapes = np.array([r["shape"] for r in table])
    target = reliabilities(patterns, counts, kinds)
    target[np.array([r["base"] for r in table])] = 1.0
    return fit_logistic(features(kinds, patterns, shapes), target, counts)


def accepted(weights: np.ndarray, extra: list[dict]) -> list[dict]:
    if not extra:
        return []
    x = features([e["kind"] for e in extra], np.array([e["votes"] for e in extra]), np.array([e["shape"] for e in extra]))
    return [e for e, s in zip(extra, x @ weights) if s > 0]


def find(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, for each row.

    A null text counts as empty; repeated rows are scanned each. A span's kind and place are
    code points, end exclusive; kinds in the order of ``KINDS``.
    """
    scanned = materialize(scan(docs), "pii")
    weights = train(scanned)

    def decide(rows: dict) -> dict:
        spans = []
        for base, extra in zip(rows["base"], rows["extra"]):
            every = [tuple(s.split(":")) for s in base] + [(e["kind"], e["start"], e["end"]) for e in accepted(weights, extra)]
            every.sort(key=lambda s: (KINDS.index(s[0]), int(s[1])))
            spans.append(",".join(f"{k}:{s}:{e}" for k, s, e in every))
        kept = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
        return {**{c: rows[c] for c in kept}, "spans": spans}

    return map_batches(
        scanned.drop("seen"),
        decide,
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    )


def masked(text: str, weights: np.ndarray) -> str:
    """The text with a mark in place of every span; of overlapping spans the earliest names it."""
    found = scan_text(text)
    spans = [tuple(s.split(":")) for s in found["base"]] + [(e["kind"], e["start"], e["end"]) for e in accepted(weights, found["extra"])]
    spans = sorted((int(s), int(e), k) for k, s, e in spans)
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The same rows with personal data masked in ``text``, and ``n_chars``, if there is one, brought up to date.

    A null text stays null, and other columns stay as they are.
    """
    weights = train(materialize(scan(docs).select("extra", "seen"), "pii"))

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            old = batch.column(names.index("text")).to_pylist()
            texts = [t if t is None else masked(t, weights) for t in old]
            new = {"text": texts}
            if "n_chars" in names:
                before = batch.column(names.index("n_chars")).to_pylist()
                new["n_chars"] = [n if t is None else len(t) for t, n in zip(texts, before)]
            for name, values in new.items():
                at = names.index(name)
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
