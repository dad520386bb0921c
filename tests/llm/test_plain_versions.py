"""Plain versions of the language distance and of the compression verdict."""

import re
from collections import Counter

import zstandard
from pyspark.sql import functions as F

from tidepool.llm import compression, langid

DOCS = "/root/testdata/sf0.001/documents.parquet"


def plain_grams(text):
    """1- to 3-grams of letters, words edged by '.', as counts. '.' itself is no letter."""
    # every run of other characters is one edge, and the text has an edge at both ends
    s = "." + re.sub(r"\0+", ".", "".join(c if c.isalpha() else "\0" for c in text.lower())) + "."
    if not any(c != "." for c in s):
        return Counter()
    out = Counter(c for c in s if c != ".")
    out.update(s[i : i + 2] for i in range(len(s) - 1))
    out.update(s[i : i + 3] for i in range(len(s) - 2) if s[i + 1] != ".")
    return out


def packed(gram):
    """The library's order of n-grams: ties in frequency go by it."""
    codes = [0 if c == "." else ord(c) for c in gram]
    return sum(v << (21 * i) for i, v in enumerate(reversed([0x1FFFFF] * (3 - len(codes)) + codes)))


def signed(v):
    return v - (1 << 64) if v >= 1 << 63 else v


def ranked(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], signed(packed(x[0]))))][: langid.RANKS]


def test_language_and_score_equal_the_plain_distance(spark, edges):
    docs = spark.read.parquet(DOCS)
    taught = docs.where(~langid.held_out(F.col("doc_id")))
    profiles = langid.learn_profiles(taught)
    totals = {}
    for r in taught.where("lang is not null and text is not null").collect():
        totals.setdefault(r.lang, Counter()).update(plain_grams(r.text))
    place = {lang: {g: i for i, g in enumerate(ranked(c))} for lang, c in totals.items()}
    assert profiles.count() == sum(len(p) for p in place.values())
    rows = docs.select("doc_id", "text").unionByName(edges.select("doc_id", "text"))
    for r in langid.identify(rows, profiles).collect():
        own = ranked(plain_grams(r.text or ""))
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        away = {lang: sum(abs(p[g] - i) if g in p else langid.RANKS for i, g in enumerate(own)) for lang, p in place.items()}
        best = min(sorted(away), key=away.get)
        assert r.lang_pred == best and abs(r.score - (1 - away[best] / (langid.RANKS * len(own)))) < 1e-9


def plain_verdict(raw, base_failed):
    z = zstandard.ZstdCompressor(level=3, write_checksum=False)

    def ratio(part):
        return len(z.compress(part)) / len(part)

    def band(n):
        for below, low, high in compression.BANDS:
            if n < below:
                return low, high

    parts = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
    if len(parts) > 1 and len(parts[-1]) < 100:
        parts[-2:] = [parts[-2] + parts[-1]]
    bad = 0
    for p in parts:
        low, high = (0.22, 0.70) if len(p) >= 4096 else band(len(p))
        bad += not low <= ratio(p) <= high
    low, high = band(len(raw))
    return len(parts), bad, low <= ratio(raw) <= high and bad <= len(parts) / 4 and not base_failed


def test_verdict_equals_the_plain_version(spark, edges):
    noise = [(500 + i, "".join(chr(33 + (i * 7919 + k * k * 31 + k) % 90) + (" " if k % 6 == 5 else "") for k in range(n))) for i, n in enumerate((90, 500, 5000, 4200, 8230, 12500))]
    docs = spark.read.parquet(DOCS).select("doc_id", "text").unionByName(edges.select("doc_id", "text")).unionByName(spark.createDataFrame(noise, "doc_id long, text string"))
    seen = set()
    for r in compression.quality_rules(docs).select("text", "quality.*").collect():
        raw = (r.text or "").encode()
        if not raw:
            assert (r.n_chunks, r.n_bad_chunks, r.kept) == (0, 0, False)
            continue
        chunks, bad, kept = plain_verdict(raw, r.base_failed)
        assert (r.n_chunks, r.n_bad_chunks, r.kept) == (chunks, bad, kept)
        seen.add((kept, bad > 0, bool(re.search(r"\S", r.text))))
    assert {(True, False, True), (False, True, True)} <= seen
