"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides.

1. Pattern finders propose spans in every text. The four base kinds (email, ip, card, phone) follow
   exact patterns and are always kept. Wider patterns propose more: spelled-out addresses, phone
   numbers without a plus sign, secrets after an assignment, long random strings.
2. Labelers vote +1, -1 or abstain (0) on every proposed span: its pattern's strictness
   (regular expressions), word lists around and inside it (gazetteers), and its surroundings (context).
3. Votes are counted over *all* documents by kind and pattern of votes, a table bounded by the
   number of patterns. Expectation-maximisation on these counts estimates each labeler's rates and
   the posterior of every pattern (labelers independent given the truth).
4. A logistic span classifier over shape and vote features is fitted to the posteriors, weighted by
   the counts; its verdict adds spans. Added spans never touch base spans or each other.

Defined results: null and empty texts have no spans; repeated rows are handled each; kinds without
any proposed span add none.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidestock.llm.rows import map_rows
from tidestock.session import staged

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds that only the classifier adds, in the order of the output.
MORE_KINDS = ("secret",)
KINDS = BASE_KINDS + MORE_KINDS

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")

#: The wider patterns take whole runs of any length; possessive repeats keep them linear.
AT = re.compile(r"(?i)[\[({] ?at ?[\])}]")
SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]++ ?[\[({] ?at ?[\])}] ?[\w-]++(?: ?(?:\.|[\[({] ?dot ?[\])}]) ?[\w-]++)+", re.I)
LOOSE_PHONE = re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3}[ .-][0-9]{4}(?![\w-])")
ASSIGNED = re.compile(r"(?i)\b(?:api[_-]?key|access[_-]?key|token|secret|passw(?:or)?d|auth)\b[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_\-+/.=]{8,}+)")
RANDOM = re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{24,}+")

#: Word lists of the gazetteer and context labelers.
TOP_DOMAINS = frozenset("com org net edu gov info io co de fr es uk it nl eu example test".split())
ABOUT = {
    "email": frozenset("mail email e-mail contact write reach address correo courriel kontakt".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax dial anruf telefon téléphone teléfono".split()),
    "card": frozenset("card visa mastercard amex credit debit payment karte carte tarjeta".split()),
    "ip": frozenset("ip host server address".split()),
    "secret": frozenset("token key secret password passwd auth bearer credential api".split()),
}
AGAINST = frozenset("isbn issn page pages version figure table commit sha md5 sha1 checksum uuid doi".split())


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain; linear however long a run of letters is."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The four exact kinds, each leftmost and non-overlapping; failing matches are dropped."""
    out: dict[str, list[tuple[int, int]]] = {"email": emails(text), "ip": [], "card": [], "phone": []}
    for m in IP.finditer(text):
        if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in m[0].split(".")):
            out["ip"].append(m.span())
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out["card"].append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out["phone"].append(m.span())
    return out


def proposals(text: str) -> list[tuple[str, int, int, int]]:
    """Wider candidates as ``(kind, pattern number, start, end)``."""
    out = []
    if AT.search(text):
        out += [("email", 1, *m.span()) for m in SPELLED.finditer(text)]
    out += [("phone", 2, *m.span()) for m in LOOSE_PHONE.finditer(text)]
    if "=" in text or ":" in text:
        out += [("secret", 3, *m.span(1)) for m in ASSIGNED.finditer(text)]
    out += [("secret", 4, *m.span()) for m in RANDOM.finditer(text)]
    return out


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def votes_of(text: str, kind: str, start: int, end: int, base: bool) -> tuple[int, ...]:
    """Votes of the six labelers, each -1, 0 or 1."""
    value = text[start:end]
    before = text[max(0, start - 40):start].lower()
    words = set(re.findall(r"[^\W\d_]+", before)[-4:])
    digits = sum(map(str.isdigit, value))
    if kind == "card":
        form = 1 if luhn(NOT_DIGIT.sub("", value)) else -1
    elif kind == "phone":
        form = 1 if 9 <= digits <= 15 else -1
    elif kind == "secret":
        form = 1 if entropy(value) >= 3.0 and digits >= 3 else -1
    else:
        form = 1
    listed = 0
    if kind == "email":
        listed = 1 if value.rsplit(".", 1)[-1].strip(" ])}").lower() in TOP_DOMAINS else -1
    elif kind == "secret":
        listed = 1 if re.fullmatch(r"[0-9a-f]{32,64}|(?:sk|pk|ghp|AKIA|xox)[A-Za-z0-9_-]{12,}", value) else 0
    elif kind == "phone":
        listed = 1 if "555" in value or value.startswith("+") else 0
    elif kind == "card":
        listed = 1 if value[0] in "3456" else -1
    context = 1 if words & ABOUT[kind] else -1 if words & AGAINST else 0
    assigned = (1 if re.search(r"[:=]\s{0,3}[\"']?$", before) else -1) if kind == "secret" else 0
    edge = -1 if (text[end:end + 1].isalnum() or text[start - 1:start].isalnum() and start > 0) else 1
    return (1 if base else 0, form, listed, context, assigned, edge)


CANDIDATES = "array<struct<kind: string, start: long, stop: long, base: boolean, votes: string, shape: string>>"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its base spans and further proposed spans, with votes and shape."""
    source = docs.select(id_col, text_col)

    def work(rows):
        for key, text in rows:
            text = text or ""
            spans = base_spans(text)
            found, seen = [], set()
            every = [(k, s, e, True) for k in BASE_KINDS for s, e in spans[k]]
            every += [(k, s, e, False) for k, _, s, e in proposals(text)]
            for kind, start, end, base in every:
                if (kind, start, end) in seen:
                    continue
                seen.add((kind, start, end))
                value = text[start:end]
                found.append({
                    "kind": kind, "start": start, "stop": end, "base": base,
                    "votes": ",".join(map(str, votes_of(text, kind, start, end, base))),
                    "shape": f"{min(len(value) // 8, 8)},{min(int(4 * sum(map(str.isdigit, value)) / len(value)), 3)}",
                })
            yield key, found

    return map_rows(source, work, f"{id_col} {dict(source.dtypes)[id_col]}, found {CANDIDATES}")


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior of each vote pattern by expectation-maximisation.

    ``votes``: patterns x labelers in -1, 0, 1; ``counts``: how often each pattern occurs. Every
    labeler has a rate for each of its three answers given truth and given error, smoothed by one
    virtual span each; the start is the majority vote.
    """
    posterior = 1 / (1 + np.exp(-votes.sum(axis=1)))
    answers = [(votes == a).astype(float) for a in (-1, 0, 1)]
    for _ in range(rounds):
        good, bad = counts * posterior, counts * (1 - posterior)
        share = (good.sum() + 1) / (counts.sum() + 2)
        score = np.full(len(counts), math.log(share / (1 - share)))
        for answer in answers:
            yes = (good @ answer + 1) / (good.sum() + 3)
            no = (bad @ answer + 1) / (bad.sum() + 3)
            score += answer @ np.log(yes / no)
        posterior = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return posterior


def features(votes: list[int], shape: str) -> list[float]:
    size, digits = map(int, shape.split(","))
    return [1.0, *[float(v == 1) for v in votes], *[float(v == -1) for v in votes], size / 8, digits / 3]


def fit_logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton steps; ``target`` may be any probability."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + w
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.eye(x.shape[1])
        w -= np.linalg.solve(hessian, gradient)
    return w


def train(found: DataFrame) -> dict[str, list[float]]:
    """Classifier weights by kind, from vote and shape counts over all candidates.

    The collected table has a row for each kind, vote pattern and shape: at most 5 x 3^6 x 36.
    """
    spans = found.select(F.explode("found").alias("s")).select("s.kind", "s.votes", "s.shape")
    rows = spans.groupBy("kind", "votes", "shape").count().orderBy("kind", "votes", "shape").collect()
    models = {}
    for kind in KINDS:
        own = [r for r in rows if r["kind"] == kind]
        if not own:
            continue
        votes = [[int(v) for v in r["votes"].split(",")] for r in own]
        counts = np.array([r["count"] for r in own], dtype=float)
        posterior = estimate(np.array(votes), counts)
        x = np.array([features(v, r["shape"]) for v, r in zip(votes, own)])
        models[kind] = fit_logistic(x, posterior, counts).tolist()
    return models


def accepted(found: list, models: dict[str, list[float]], threshold: float) -> list[tuple[str, int, int, bool]]:
    """Base spans, and added ones that the classifier is sure of, in kind and start order."""
    spans = [(s["kind"], s["start"], s["stop"], True) for s in found if s["base"]]
    rest = []
    for s in found:
        if not s["base"] and s["kind"] in models:
            x = features([int(v) for v in s["votes"].split(",")], s["shape"])
            score = 1 / (1 + math.exp(-max(-30, min(30, float(np.dot(models[s["kind"]], x))))))
            if score >= threshold:
                rest.append((-score, s["start"], s["stop"], s["kind"]))
    taken: list[tuple[int, int]] = []
    for start, stop in sorted((a, b) for _, a, b, _ in spans):
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(stop, taken[-1][1]))
        else:
            taken.append((start, stop))
    for _, start, stop, kind in sorted(rest):
        at = bisect_left(taken, (start, stop))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or stop <= taken[at][0]):
            taken.insert(at, (start, stop))
            spans.append((kind, start, stop, False))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_pii(docs: DataFrame, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``spans``: kind, start and stop in code points, and whether it is a base span."""
    found = staged(candidates(docs, id_col, text_col), "pii-candidates")
    models = train(found)

    def work(rows):
        for key, spans in rows:
            yield key, [dict(zip(("kind", "start", "stop", "base"), s)) for s in accepted(spans, models, threshold)]

    kind = dict(found.dtypes)[id_col]
    return map_rows(
        found, work,
        f"{id_col} {kind}, spans array<struct<kind: string, start: long, stop: long, base: boolean>>",
    )
