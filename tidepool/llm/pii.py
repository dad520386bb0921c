"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, extend, map_texts, plus, shield

#: Base kinds and their patterns, then the kinds that the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("secret", "number", "name")
KINDS = BASE_KINDS + ADDED_KINDS
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A start within a run of digits can't succeed where the run's own start failed, so it is not tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
DIGIT = re.compile("[0-9]")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Gazetteers: fixed values.
SECRET_WORDS = ("password", "passwort", "passwd", "pwd", "token", "secret", "api key", "api_key", "apikey", "access key", "credential", "bearer", "contraseña", "mot de passe", "kennwort")
NUMBER_WORDS = ("phone", "tel", "telefon", "téléphone", "teléfono", "mobile", "fax", "ssn", "social security", "passport", "account", "iban", "konto", "compte", "cuenta", "call")
NAME_WORDS = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sra", "name is", "heiße", "m'appelle", "me llamo")
PUBLIC_WORDS = ("license", "licence", "version", "copyright", "chapter", "section", "page", "isbn", "doi", "figure", "table")
NAME = re.compile(r"(?<!\w)(?:" + "|".join(NAME_WORDS) + r")\.?\x20+([^\W\d_a-z]\w+(?:\x20[^\W\d_a-z]\w+){0,2})")
TOKEN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/-")
KEY_SHAPE = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_\w{20,}|sk[-_]\w{16,}|[0-9a-f]{16,}|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[A-Z]{2}[0-9]{2}[0-9A-Z]{11,30}")
NUMBER_SHAPE = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3,5}\)?[ .-][0-9]{3}[ .-]?[0-9]{3,5}")
NUMBER = re.compile(r"(?<![\w+.,-])\(?[0-9][0-9 ().-]{5,18}[0-9](?!\w)")
PLAIN_NUMBER = re.compile(r"[0-9]{1,4}(?:[.,:/-][0-9]{1,4}){0,3}|[0-9]{1,3}(?:[ .,][0-9]{3})+")

LABELERS = ("shape", "plain", "gazetteer", "public", "context", "spread")
#: Characters before a span in which the labelers look.
BEFORE = 24


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base rules: leftmost matches of each pattern, those that fail its test dropped."""
    out = []
    at = text.find("@")
    free = 0
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if 13 <= len(digits := re.sub("[ -]", "", m[0])) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans that may be personal: names after a title, digit groups, and tokens of 12 or more characters with letters and digits. None overlaps `taken` or another."""
    found: list[tuple[str, int, int]] = []
    if any(w in text for w in NAME_WORDS):
        found += [("name", *m.span(1)) for m in NAME.finditer(text)]
    at = 0
    while m := DIGIT.search(text, at):
        start, end = m.span()
        while start > at and text[start - 1] in TOKEN_CHARS:
            start -= 1
        while end < len(text) and text[end] in TOKEN_CHARS:
            end += 1
        if end - start >= 12 and any(c.isalpha() for c in text[start:end]):
            found.append(("secret", start, end))
        elif n := NUMBER.match(text, max(0, start - (start > 0 and text[start - 1] == "("))):
            found.append(("number", *n.span()))
            end = max(end, n.end())
        at = end
    out: list[tuple[str, int, int]] = []
    end = 0  # of all spans so far, in order of their starts; taken ones come first
    for s, e, kind in sorted([(s, e, "") for _, s, e in taken] + [(s, e, kind) for kind, s, e in found]):
        if not kind:
            if out and out[-1][2] > s:  # a candidate that runs into a taken span
                out.pop()
        elif s >= end:
            out.append((kind, s, e))
        else:
            continue
        end = max(end, e)
    return out


def votes(kind: str, text: str, start: int, end: int) -> str:
    """One letter a labeler: p (personal), n (not), a (abstains)."""
    span, before = text[start:end], text[max(0, start - BEFORE) : start]
    low = before.lower()
    shape = {"secret": KEY_SHAPE, "number": NUMBER_SHAPE}.get(kind)
    words = {"secret": SECRET_WORDS, "number": NUMBER_WORDS, "name": NAME_WORDS}[kind]
    hints = (before.rstrip(" \"'")[-1:] in ("=", ":")) if before else False
    letters, digits = sum(c.isalpha() for c in span), sum(c.isdigit() for c in span)
    counts = [span.count(c) for c in set(span)]
    entropy = -sum(n / len(span) * math.log2(n / len(span)) for n in counts)
    return "".join((
        ("p" if shape.fullmatch(span) else "a") if shape else ("p" if " " in span else "a"),
        "n" if PLAIN_NUMBER.fullmatch(span) else "a",
        "p" if any(w in (before if kind == "name" else low) for w in words) else "a",
        "n" if any(w in low for w in PUBLIC_WORDS) else "a",
        "p" if hints else ("n" if kind == "number" else "a"),
        "p" if kind == "secret" and entropy >= 2.5 and 4 * min(letters, digits) >= len(span) else "n" if kind == "secret" and (entropy < 2 or 8 * min(letters, digits) < len(span)) else "a",
    ))


def features(kind: str, text: str, start: int, end: int) -> str:
    """A discrete description: kind, votes, and steps of length, share of digits and share of capitals."""
    span = text[start:end]
    n = len(span)
    parts = (min(n // 8, 5), 3 * sum(c.isdigit() for c in span) // n, 3 * sum(c.isupper() for c in span) // n)
    return f"{kind}|{votes(kind, text, start, end)}|{'|'.join(map(str, parts))}"


def _scan(names: list[str], text_col: str):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("features", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(names.index(text_col)).to_pylist():
                text = text or ""
                base = base_spans(text)
                spans = [{"kind": k, "start": s, "end": e, "features": None} for k, s, e in base]
                if "'" in text or DIGIT.search(text) or any(w in text for w in NAME_WORDS):
                    spans += [{"kind": k, "start": s, "end": e, "features": features(k, text, s, e)} for k, s, e in candidates(text, base)]
                rows.append(spans)
            yield pa.RecordBatch.from_arrays([*(c for c, n in zip(batch.columns, names) if n != text_col), pa.array(rows, kind)], [*(n for n in names if n != text_col), "_spans"])

    return run


class LabelModel:
    """Reliabilities of the labelers by expectation-maximisation over counts of vote patterns (two classes, votes independent given the class)."""

    def __init__(self, patterns: dict[str, float], rounds: int = 200):
        names = sorted(patterns)
        self.weights = np.array([patterns[n] for n in names], dtype=float)
        votes_ = np.array([[{"p": 1, "n": -1, "a": 0}[c] for c in n] for n in names], dtype=int).reshape(len(names), len(LABELERS))
        post = 1 / (1 + np.exp(-votes_.sum(axis=1)))  # majority vote to begin with
        for _ in range(rounds):
            # a labeler's rates of p, a and n in either class; as many pseudo-counts for the class it names keep the classes from swapping
            self.rates = np.zeros((2, len(LABELERS), 3))
            for c, mass in ((1, post), (0, 1 - post)):
                for v in (-1, 0, 1):
                    self.rates[c, :, v + 1] = ((votes_ == v) * (mass * self.weights)[:, None]).sum(axis=0) + 0.5 + (v == (1 if c else -1))
                self.rates[c] /= self.rates[c].sum(axis=1, keepdims=True)
            self.prior = ((post * self.weights).sum() + 1) / (self.weights.sum() + 2)
            new = self._posterior(votes_)
            if np.abs(new - post).max(initial=0) < 1e-9:
                break
            post = new
        self.posterior = dict(zip(names, post.tolist()))

    def _posterior(self, v: np.ndarray) -> np.ndarray:
        logs = np.log(self.rates)
        at = np.arange(len(LABELERS))
        score = [logs[c][at[None, :], v + 1].sum(axis=1) for c in (0, 1)]
        return 1 / (1 + np.exp(np.clip(score[0] - score[1] + math.log((1 - self.prior) / self.prior), -700, 700)))


def _vector(feature: str) -> list[str]:
    kind, v, size, digits, upper = feature.split("|")
    return ["bias", f"kind={kind}", *(f"{n}={c}" for n, c in zip(LABELERS, v)), f"size={size}", f"digits={digits}", f"upper={upper}"]


class SpanClassifier:
    """Logistic regression on discrete features, fitted to the label model's posteriors of all spans by Newton steps."""

    def __init__(self, counts: dict[str, float], ridge: float = 1.0, rounds: int = 30):
        pattern: dict[str, float] = {}
        for f, n in counts.items():
            pattern[f.split("|")[1]] = pattern.get(f.split("|")[1], 0) + n
        self.labels = LabelModel(pattern)
        self.names = sorted({x for f in counts for x in _vector(f)})
        place = {n: i for i, n in enumerate(self.names)}
        x = np.zeros((len(counts), len(self.names)))
        for r, f in enumerate(sorted(counts)):
            x[r, [place[n] for n in _vector(f)]] = 1
        n = np.array([counts[f] for f in sorted(counts)], dtype=float)
        y = np.array([self.labels.posterior[f.split("|")[1]] for f in sorted(counts)])
        self.w = np.zeros(len(self.names))
        for _ in range(rounds if len(n) else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ self.w, -30, 30)))
            slope = x.T @ (n * (p - y)) + ridge * self.w
            step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + ridge * np.eye(len(self.w)), slope)
            self.w -= step
            if np.abs(step).max() < 1e-8:
                break

    def probability(self, feature: str) -> float:
        known = dict(zip(self.names, self.w.tolist()))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(known.get(n, 0.0) for n in _vector(feature))))))


def find_personal_data(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """docs without its text and with `spans`, array of (kind, start, end, probability): base spans and those that the classifier adds, by kind and start.

    One pass over whole texts finds base spans (probability 1) and candidates,
    and writes them as small rows. Six labelers (shape and plain-number patterns,
    gazetteers of what stands before, context, character spread) vote on each
    candidate. Candidates are counted by their discrete features: the counts, of
    which there are at most a few thousand kinds however many spans there are, go
    to the driver, where EM estimates the labelers' reliabilities from all spans'
    votes and a logistic classifier is fitted to the posteriors. Then a second
    pass over the small rows decides. Positions are code points, end exclusive.

    Null and empty texts have no spans; equal texts have equal spans; an empty
    table stays empty; a column already named spans is replaced, others stay.
    Every pattern is tried in time linear in the text.
    """
    docs, (text_col,), back = shield(docs, text_col)
    kind = "_spans array<struct<kind: string, start: bigint, end: bigint, features: string>>"
    found = cut(map_texts(docs, _scan(docs.columns, text_col), plus(docs.drop(text_col).schema, kind)), "spans")
    rows = found.select(F.explode("_spans.features").alias("f")).where("f is not null").groupBy("f").count().collect()
    model = SpanClassifier({r["f"]: float(r["count"]) for r in rows})
    known = {r["f"]: model.probability(r["f"]) for r in rows}
    columns = found.columns
    out = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            lists = []
            for spans in batch.column(columns.index("_spans")).to_pylist():
                good = [{"kind": s["kind"], "start": s["start"], "end": s["end"], "probability": p} for s in spans if (p := 1.0 if s["features"] is None else known[s["features"]]) >= least]
                lists.append(sorted(good, key=lambda s: (order[s["kind"]], s["start"])))
            yield extend(batch, columns, {"spans": pa.array(lists, out)})

    done = found.mapInArrow(decide, plus(found.schema, "spans array<struct<kind: string, start: bigint, end: bigint, probability: double>>"))
    return back(done, "spans")


def span_text(base_only: bool):
    """A column expression: `spans` as kind:start:end, comma-joined."""
    spans = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS)) if base_only else F.col("spans")
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


