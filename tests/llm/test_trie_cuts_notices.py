"""Conversation prefix trie, fill-in-middle cuts, license notices."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import notices, prefix_trie, queries, rank_index
from tidepool.llm.common import WORD

from .conftest import EDGES, prose

SF = "/root/testdata/sf0.001"


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


# 11: the prefix trie


def brute_sequences(rows):
    turns = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            turns.setdefault(c, []).append((t is not None, t or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}


def brute_heads(seqs):
    def rebuilt(c):
        h = zlib.crc32(str(c).encode()) % 4
        return seqs.get(c - c % 20, [])[:h] + seqs[c][h:]

    return {c: rebuilt(c) for c in seqs}


def brute_trie(seqs):
    nodes = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        children = [p for p in nodes if len(p) == len(path) + 1 and p[: len(path)] == path]
        leaf = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes)]
        saved = sum((len(nodes[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in members if len(seqs[c]) == len(path))))
        above = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), above, len(members), len(children), len(leaf), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


CONVERSATION = "conv_id long, turn long, role string, text string"


def talk(seed, n, words="ab"):
    """Short conversations over few turns, so that prefixes are shared; a third of them are one conversation."""
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(4 * n), n):
        if r.random() < 0.33:
            rows += [(c, k, "user", x) for k, x in enumerate(("a b", "b", "a b c"))]
        else:
            rows += [(c, k, r.choice(["user", None]), r.choice([*words, "a b", "", None])) for k in range(r.randint(1, 5))]
    return rows


@pytest.mark.parametrize("shard_rows", [3, 40, 100_000])
def test_trie_equals_brute_force(spark, shard_rows):
    rows = talk(shard_rows, 90)
    sequences = prefix_trie.encode_turns(spark.createDataFrame(rows, CONVERSATION))
    seqs = brute_sequences(rows)
    assert as_rows(prefix_trie.prefix_trie(sequences, shard_rows)) == sorted(brute_trie(seqs), key=repr)
    rebuilt = prefix_trie.with_shared_heads(sequences)
    assert as_rows(prefix_trie.prefix_trie(rebuilt, shard_rows)) == sorted(brute_trie(brute_heads(seqs)), key=repr)


def test_trie_with_salted_parents(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BROADCAST_NODES", 0)
    rows = talk(5, 60)
    sequences = prefix_trie.encode_turns(spark.createDataFrame(rows, CONVERSATION))
    assert as_rows(prefix_trie.prefix_trie(sequences, 5)) == sorted(brute_trie(brute_sequences(rows)), key=repr)


def test_trie_of_odd_rows(spark):
    long = " ".join(["x"] * 30_000)
    rows = [(1, None, "user", "a"), (1, 0, None, None), (1, 0, "", ""), (1, 0, "", long), (None, 0, "user", "lost"), (-7, 1, "user", "a"), (-7, 1, "user", "a")]
    rows += [(20, k, "user", f"turn {k % 3}") for k in range(300)] + [(21, 0, "user", "late"), (45, 0, "x", "y")]
    frame = spark.createDataFrame(rows, CONVERSATION).withColumns({c: F.lit("own") for c in ("seq", "words", "digest", "id", "depth", "n", "_base")})
    seqs = brute_sequences(rows)
    done = prefix_trie.prefix_trie(prefix_trie.with_shared_heads(prefix_trie.encode_turns(frame)), 30)
    assert as_rows(done) == sorted(brute_trie(brute_heads(seqs)), key=repr)
    # h is 3 for 45, whose base conversation is absent: a member of the root alone
    assert zlib.crc32(b"45") % 4 and brute_heads(seqs)[45] == []


def test_trie_of_no_rows(spark):
    assert prefix_trie.prefix_trie(prefix_trie.encode_turns(spark.createDataFrame([], CONVERSATION))).count() == 0


def test_siblings_are_balanced():
    trie = prefix_trie.TernaryTrie()
    seqs = [[k] for k in range(1000)]
    assert len(set(trie.insert_sorted(seqs, seqs))) == 1000

    def height(node):
        return 0 if node < 0 else 1 + max(height(trie.low[node]), height(trie.high[node]))

    assert height(trie.down[0]) == 10


# 12: fill-in-middle

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_fim(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    assert "".join(units) == text
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_cuts_equal_brute_force(spark, edges):
    odd = [(100 + k, t) for k, t in enumerate([" a", "a ", "\n", "é ü\t\U0001f600  x", "a <M> b", "a<", "P> <P", "\xa0 \x1c b", "w" * 700 + " " + "v" * 300, " " * 5000 + "x y"])]
    docs = docs_of(spark).unionByName(edges.select("doc_id", "text")).unionByName(spark.createDataFrame(odd * 3, "doc_id long, text string").withColumn("doc_id", (F.col("doc_id") + 10 * F.floor(F.rand(1) * 40)).cast("long")))
    docs = docs.cache()
    done = rank_index.restored(rank_index.fill_in_middle(docs)).collect()
    assert len(done) == docs.count() and {r.form for r in done} == {"plain", "psm", "spm"}
    for r in done:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_fim(r.doc_id, r.text)
        assert r.restored == (r.text or "")


def test_cuts_with_other_columns_and_no_rows(spark, clashing, nothing):
    wide = clashing.withColumns({c: F.lit("own") for c in ("n", "form", "output", "restored")})
    done = rank_index.restored(rank_index.fill_in_middle(wide))
    assert done.count() == len(EDGES) and done.columns.count("form") == 1 and done.where("size = 'own size'").count() == len(EDGES)
    assert rank_index.fill_in_middle(nothing).count() == 0


@pytest.mark.parametrize("error", [8, 127])
def test_index_is_within_its_bound_and_exact(error):
    r = np.random.default_rng(error)
    for offsets in (np.cumsum(r.integers(1, 12, 50_000)), np.cumsum(r.choice([1, 2, 900], 5_000, p=[0.6, 0.39, 0.01])), np.zeros(100, np.int64), np.array([5]), np.zeros(0, np.int64)):
        index = rank_index.RankIndex(offsets, error)
        ranks = np.arange(len(offsets))
        assert np.array_equal(index.offset(ranks), offsets)
        assert not len(offsets) or np.abs(index.predict(ranks) - offsets).max() <= error
    line = rank_index.RankIndex(np.arange(100_000) * 7, error)
    assert len(line.start) == 1 and not line.residual.any()


# 13: license notices


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    places = [(k, label) for phrase, label in notices.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [p[0] for p in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({p[1] for p in places}))


def least_edits(pattern, text):
    """Least edit distance of the pattern to any part of the text, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for k, p in enumerate(pattern):
            new.append(min(row[k] + (p != c), row[k + 1] + 1, new[k] + 1))
        row = new
        best = min(best, row[-1])
    return best


def mangle(r, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = r.randrange(1, len(chars) - 1)
        kind = r.choice("sid")
        if kind == "s":
            chars[at] = r.choice("qxz ")
        elif kind == "i":
            chars.insert(at, r.choice("qxz "))
        else:
            del chars[at]
    return "".join(chars)


TEXTS = [
    None,
    "",
    "Released under the MIT License.",
    "UNDER THE\tMIT-License; under the mit license under the mit license",
    "cc by nc cc by nc, CC-BY-NC 4.0 ccc by nc",
    "Apache License, Version 2.0. Apache License Version 21",
    "unter the mit licence",
    "é Under The Mit License é",
    "Kunder the mit license",
]


def test_base_places_equal_brute_force(spark, edges):
    docs = docs_of(spark).unionByName(edges.select("doc_id", "text")).unionByName(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))
    done = notices.scan_licenses(docs).collect()
    assert len(done) == docs.count() and sum(r.n_base for r in done) > 8
    for r in done:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(r.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1) == any(not n.edits for n in r.notices) and (r.score == 0) == (r.labels == "")


def test_bounded_error_search_equals_the_plain_table():
    r = random.Random(3)
    scanner = notices.Scanner()
    found = 0
    for n in range(300):
        notice = scanner.notices[n % len(scanner.notices)]
        text, _ = notices.fold(f"{prose(n, 6)} {mangle(r, notice.text, r.randint(0, notice.edits + 2))} {prose(n + 1, 6)}")
        by_notice = {}
        for start, end, i, edits in scanner.matches(text):
            assert least_edits(scanner.notices[i].text, text[start:end]) == edits
            by_notice[i] = min(edits, by_notice.get(i, 99))
        expected = {i: e for i, s in enumerate(scanner.notices) if (e := least_edits(s.text, text)) <= s.edits}
        assert by_notice == expected
        found += len(expected)
    assert found > 200


def test_planted_notices(spark):
    rows = [
        (1, "x y\n  Licenced under the Apache-License, version 2.0!! z", "apache-2"),
        (2, "This work is licensed under the GNU General Publik License, version 3.", "gpl-3"),
        (3, "gnu general public license version 4", ""),
        (4, "GNU Lesser General Public License, version 2.1", "lgpl-2.1"),
        (5, "All rigths reserve", ""),
        (6, "All right reserved. " * 3, "proprietary"),
        (7, "Licensed under CC BY-SA 4.0", "cc-by-sa"),
        (8, "released under the mpl license", ""),
        (9, prose(1, 400), ""),
    ]
    done = {r.doc_id: r for r in notices.scan_licenses(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()}
    for k, text, labels in rows:
        assert done[k].labels == labels, text
    (apache,) = (n for n in done[1].notices if not n.base)
    assert rows[0][1][apache.start : apache.end] == "Licenced under the Apache-License, version 2.0" and (apache.first_word, apache.last_word, apache.edits) == (2, 9, 1)
    assert [(n.first_word, n.edits) for n in done[6].notices] == [(0, 1), (3, 1), (6, 1)]


def test_scan_with_other_columns_and_no_rows(spark, clashing, nothing):
    done = notices.scan_licenses(clashing.withColumn("labels", F.lit("own")))
    assert done.count() == len(EDGES) and done.columns.count("score") == 1 and done.where("labels = 'own'").count() == 0
    assert notices.scan_licenses(nothing).count() == 0


def test_registered_queries_over_whole_tables(spark):
    docs = docs_of(spark).count()
    for name in ("op12_fim_rank_index", "op13_license_notices"):
        assert queries.QUERIES[name](spark, SF).count() == docs
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(queries.op11_prefix_trie(spark, SF)) == sorted(brute_trie(brute_heads(brute_sequences(rows))), key=repr)
