"""Operators on whole corpora against brute force: links of vectors and lines, windows, near copies, mixing, and the pipeline."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import cap_filters, icws, line_dedup, mixing, queries, superkmer
from tidepool.llm.common import WORD, Words, grouped, local_components
from tidepool.llm.components import connected_components

from .conftest import EDGES, prose

DOCS = "/root/testdata/sf0.001/documents.parquet"


def key(i):
    return (i is None, i or 0)


def planted(n=40):
    """Documents with copies, near copies and shared passages in various surroundings."""
    r = random.Random(4)
    passage = prose(77, 70)
    base = prose(78, 150)
    docs = []
    for i in range(n):
        w = base.split()
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = f"zz{r.randint(0, 999)}"
        docs.append((100 + i, " ".join(w)))
        docs.append((200 + i, prose(300 + i, r.randint(0, 60)) + " " + passage + " " + prose(400 + i, 30)))
        docs.append((300 + i, prose(i % 5, 90)))
    return docs


@pytest.fixture(scope="module")
def corpus(spark, edges):
    docs = spark.read.parquet(DOCS).select(F.col("doc_id") + 1000, "text").unionByName(edges.select(F.col("doc_id").alias("(doc_id + 1000)"), "text")).toDF("doc_id", "text")
    return docs.unionByName(spark.createDataFrame(planted(), "doc_id long, text string")).repartition(6).cache()


# components


def test_components(spark):
    r = random.Random(0)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    linked = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


# 2: vectors


def brute_links(rows):
    ok = {}
    for n, (i, v, label) in enumerate(rows):
        if i is not None and v and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[n] = np.array(v, dtype=float) / math.sqrt(sum(x * x for x in v))
    links = defaultdict(set)
    for a in ok:
        for b in ok:
            if a != b and rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b]) and float(ok[a] @ ok[b]) >= 0.98:
                links[a].add(b)
    out = []
    for n, (i, _, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for m in links[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        out.append((i, len(links[n]), None if i is None else min(rows[m][0] for m in seen)))
    return Counter(out)


@pytest.mark.parametrize("dim", [3, 64])
def test_vectors_equal_brute_force(spark, dim, monkeypatch):
    monkeypatch.setattr(cap_filters, "CHUNK", 16)  # crowded filters are dealt to blocks
    r = np.random.default_rng(dim)
    rows = []
    for c in range(12):
        centre = r.standard_normal(dim)
        for _ in range(c * 4):
            x = centre + r.standard_normal(dim) * 0.12 * r.random()
            rows.append((len(rows), [float(np.float32(v)) for v in x], int(c % 3)))
    rows += [(5000, rows[-1][1], rows[-1][2]), (5001, rows[-1][1], rows[-1][2]), (5001, rows[-1][1], rows[-1][2]), (5002, rows[-1][1], None), (5003, None, 1), (5004, [0.0] * dim, 1)]
    rows += [(5005, [None] + [1.0] * (dim - 1), 1), (5006, [float("nan")] * dim, 1), (5007, [], 1), (5008, [1.0] * (dim + 8), 1), (5009, [2.0] * (dim + 8), 1), (None, rows[0][1] if rows else None, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit("own")).repartition(4)
    got = cap_filters.link_vectors(df).collect()
    exact = brute_links(rows)
    assert Counter((x.vec_id, x.n_links, x.component_id) for x in got) == exact
    assert all(x.kept == (x.vec_id == x.component_id or x.vec_id is None) for x in got)
    assert cap_filters.link_vectors(df.limit(0)).count() == 0


def test_list_decoding_is_complete():
    code = cap_filters.ProductCode(64, 2000)
    x = np.random.default_rng(1).standard_normal((20, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    b = [x[:, blk] @ c.T for blk, c in zip(code.blocks, code.code)]
    every = (b[0][:, :, None, None, None] + b[1][:, None, :, None, None] + b[2][:, None, None, :, None] + b[3][:, None, None, None, :]).reshape(20, -1)
    for got, all_ in zip(code.decode(x), every):
        over = set(np.flatnonzero(all_ >= code.alpha).tolist())
        assert over <= set(got.tolist())
        assert set(got.tolist()) == over or len(got) == cap_filters.LEAST_FILTERS


# 3: lines


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_and_keys():
    r = random.Random(3)
    for _ in range(4000):
        a = "".join(r.choice("abc") for _ in range(r.randint(0, 12)))
        b = list(a)
        for _ in range(r.randint(0, 4)):
            at = r.randint(0, len(b))
            b[at : at + r.randint(0, 1)] = r.choice(["", "a", "b", "c"])
        b = "".join(b)
        for most in (0, 1, 2, 3):
            exact = min(levenshtein(a, b), most + 1)
            assert line_dedup.edit_distance(a, b, most) == exact
            if exact <= most < min(len(a), len(b)):
                short, long = sorted((a, b), key=len)
                index, (own, probe) = line_dedup.segment_keys(short, most)[0], line_dedup.segment_keys(long, most)
                assert set(index) & {*own, *probe}


def brute_lines(rows, most=2, least=20):
    seen, by, out = set(), defaultdict(list), {}
    for i, t in sorted(set(rows), key=lambda x: (key(x[0]), x[1] is not None, x[1] or "")):
        if t is None:
            out[i, t] = (0, 0, 0, None)
            continue
        kept, near, lines = [], 0, t.split("\n")
        for x in lines:
            if len(x) >= least:
                if x in seen:
                    continue
                seen.add(x)
                hit = any(line_dedup.edit_distance(x, y, most) <= most for n in range(len(x) - most, len(x) + most + 1) for y in by[n])
                by[len(x)].append(x)
                if hit:
                    near += 1
                    continue
            kept.append(x)
        out[i, t] = (len(lines), len(lines) - len(kept), near, "\n".join(kept))
    return out


def test_lines_equal_brute_force(spark, edges, clashing, nothing, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK", 8)  # crowded segments are dealt to blocks
    r = random.Random(8)
    template = "this line of the template has number 000 and goes on for a while yet"
    rows = [(i, t) for i, t, _, _ in EDGES if i != 7]
    for i in range(60):
        line = template.replace("000", f"{r.randint(0, 999):03}")
        words = prose(900 + i % 20, 12)
        at = r.randrange(len(words))
        rows.append((2000 + i, f"{line}\nshort\n{words[:at]}{r.choice(['', 'q', 'qq', 'qqq'])}{words[at + 1:]}\n\n{prose(950 + i, 9)}"))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_id", F.lit("own")).repartition(5)
    exact = brute_lines(rows)
    got = line_dedup.dedup_lines(df).collect()
    assert len(got) == len(rows)
    for x in got:
        assert (x.n_lines, x.n_removed, x.n_near, x.kept_text) == exact[x.doc_id, x.text], x
        assert x._id == "own"
    plain = line_dedup.dedup_lines(df.select("doc_id", "text")).collect()
    assert Counter((x.doc_id, x.n_removed, x.kept_text) for x in plain) == Counter((x.doc_id, x.n_removed, x.kept_text) for x in got)
    assert line_dedup.dedup_lines(clashing).count() == len(EDGES)
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_short_lines_go_if_equal(spark, edges, clashing, nothing):
    rows = [(i, t) for i, t, _, _ in EDGES if i != 7]
    for i in range(30):
        rows.append((3000 + i, f"Menu\n \t\n{prose(970 + i, 9)}\n\n短い行です。\nMenus {i % 3}\nMenu\nown {i}"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    seen, exact = set(), {}
    for i, t in sorted(set(rows), key=lambda x: (key(x[0]), x[1] is not None, x[1] or "")):
        kept = [] if t is None else t.split("\n")
        own = kept
        kept = [x for x in own if not (len(x) < 20 and WORD.search(x)) or not (x in seen or seen.add(x))]
        exact[i, t] = len(own) - len(kept)
    long = {(x.doc_id, x.text): x.n_removed for x in line_dedup.dedup_lines(df).collect()}
    got = line_dedup.dedup_lines(df, short=True).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.n_removed == long[x.doc_id, x.text] + exact[x.doc_id, x.text], x
    lines = [y for x in got for y in (x.kept_text or "").split("\n")]
    assert lines.count("Menu") == lines.count("短い行です。") == 1 and lines.count(" \t") == 30 + 1
    assert line_dedup.dedup_lines(clashing, short=True).count() == len(EDGES)
    assert line_dedup.dedup_lines(nothing, short=True).count() == 0


def test_registered_line_dedup_takes_short_lines(spark, tmp_path):
    docs = spark.read.parquet(DOCS)
    extra = docs.limit(6).withColumn("text", F.concat(F.lit("Home | About\n"), "text")).withColumn("doc_id", F.col("doc_id") + 10_000)
    extra.write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op3_line_dedup(spark, str(tmp_path)).where("n_removed > 0").count() >= 5


# 4: mixing


def test_mix_comes_near_its_targets(spark, edges, clashing, nothing):
    docs = spark.read.parquet(DOCS).select((F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source").unionByName(edges)
    got = mixing.mix_sources(docs)
    rows = got.collect()
    assert Counter((x.doc_id, x["size"]) for x in rows) == Counter((x.doc_id, len(WORD.findall(x.text or ""))) for x in docs.collect())
    assert all(x.taken <= 2 * x["size"] for x in rows)
    per = {x.source_size: (x.target, x.n, x.most) for x in got.groupBy("source_size", "target").agg(F.sum("taken").alias("n"), F.max("size").alias("most")).collect()}
    assert all(abs(n - t) <= most for t, n, most in per.values())
    total = sum(per)
    assert sum(t for t, _, _ in per.values()) == pytest.approx(1.5 * total)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, mixing.mix_sources(docs.repartition(7)).collect()))
    assert mixing.mix_sources(nothing).count() == 0
    assert mixing.apply_mix(nothing).count() == 0
    taken = mixing.apply_mix(clashing)
    assert taken.columns == clashing.columns
    decided = mixing.mix_sources(edges).agg(F.sum("copies")).first()[0]
    assert taken.count() == decided and taken.where("size <> 'own size'").count() == 0


def test_thresholds_are_nested(spark):
    docs = spark.read.parquet(DOCS)
    less = {x.doc_id: x.copies for x in mixing.mix_sources(docs, share=0.4).collect()}
    more = {x.doc_id: x.copies for x in mixing.mix_sources(docs, share=1.1).collect()}
    assert all(more[i] >= c for i, c in less.items())


def test_targets_are_reshared(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 0), ("d", 500)], "source string, source_size long")
    got = {x.source: x.target for x in mixing.source_targets(sizes).collect()}
    # weights 3, 1, 2, 3, 1 (null last); 1.5 * 1610 = 2415; a and c and d are capped
    assert got["a"] == 20 and got["c"] == 200 and got["d"] == 1000 and got[None] == 0
    assert got["b"] == pytest.approx(2415 - 1220)


# 6: substrings


def brute_windows(rows, size=50):
    first, out = {}, {}
    words = {(i, t): WORD.findall(t or "") for i, t in set(rows)}
    for (i, _), w in words.items():
        for k in range(len(w) - size + 1):
            x = tuple(w[k : k + size])
            first[x] = min(first.get(x, (True, 0)), key(i))
    for (i, t), w in words.items():
        gone = {j for k in range(len(w) - size + 1) if first[tuple(w[k : k + size])] < key(i) for j in range(k, k + size)}
        out[i, t] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize("hot", [2000, 1])
def test_windows_equal_brute_force(corpus, hot):
    exact = brute_windows([(x.doc_id, x.text) for x in corpus.collect()])
    got = superkmer.dedup_substrings(corpus, hot=hot).collect()
    assert len(got) == corpus.count()
    assert [x for x in got if (x.n_words, x.n_removed, x.kept_text) != exact[x.doc_id, x.text]] == []
    assert sum(x.n_removed for x in got) > 5000


def test_windows_edges(clashing, nothing):
    got = superkmer.dedup_substrings(clashing)
    assert got.count() == len(EDGES) and got.where("_th <> 'own _th'").count() == 0
    assert superkmer.dedup_substrings(nothing).count() == 0


def test_super_kmers_cover_every_window_once():
    text = " ".join(prose(i, 200) for i in range(3)).encode()
    data, cut = np.frombuffer(text, dtype=np.uint8), 3000
    words = Words(data, np.array([0, cut, cut, len(data)]))
    owner, first, count, _, _ = superkmer.super_kmers(words)
    got = Counter((t, i) for t, f, n in zip(owner, first, count) for i in range(f, f + n))
    sizes = np.diff(words.first)
    assert got == Counter((t, i) for t in range(3) for i in range(sizes[t] - 49))


# 8: near copies


def brute_classes(rows):
    n, df, sets = len(rows), Counter(), {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for _, w in split:
        df.update(set(w))
    for i, w in split:
        if i is None or not w:
            continue
        idf = {x: 1 + math.log((1 + n) / (1 + df[x])) / math.log(1 + n) for x in w}
        tf = Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
        sets[i, tuple(w)] = {s: (1 + math.log(c)) * sum(idf[x] for x in s) / len(s) for s, c in tf.items()}
    where, parent = defaultdict(set), {i: i for i, _ in split if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in sets.items():
        for x in s:
            where[x].add(k)
    for a, b in {(a, b) for v in where.values() for a in v for b in v if a < b}:
        common = sum(min(x, sets[b][s]) for s, x in sets[a].items() if s in sets[b])
        if common / (sum(sets[a].values()) + sum(sets[b].values()) - common) >= 0.8:
            x, y = find(a[0]), find(b[0])
            parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


@pytest.mark.parametrize("chunk", [192, 8])
def test_classes_equal_brute_force(corpus, chunk):
    rows = [(x.doc_id, x.text) for x in corpus.collect()]
    exact = brute_classes(rows)
    got = icws.near_duplicates(corpus, chunk=chunk).collect()
    assert len(got) == len(rows)
    assert {x.doc: x.class_id for x in got} == exact | {None: None}
    assert len(set(exact.values())) < len(exact) - 50


def test_document_frequencies_are_exact_and_the_floor_is_a_rule(spark, corpus, monkeypatch):
    texts = [set(WORD.findall(x.text or "")) for x in corpus.collect()]
    df, n = Counter(w for t in texts for w in t), len(texts)
    words = sorted(df)
    blob = " ".join(words).encode()
    hashes = Words(np.frombuffer(blob, np.uint8), np.array([0, len(blob)])).hash
    monkeypatch.setattr(icws, "FLUSH", 500)  # counts pass on in parts
    for most in (icws.TABLE_WORDS, sum(v > 1 for v in df.values()) // 3):
        idf = icws.inverse_frequencies(corpus, table_words=most)
        assert len(idf.hashes) <= most and len(idf.hashes) == sum(v > idf.floor for v in df.values())
        expected = [1 + math.log((1 + n) / (1 + max(df[w], idf.floor))) / math.log(1 + n) for w in words]
        assert np.allclose(idf.of(hashes), expected, atol=1e-6)
    assert idf.floor > 1


def test_pairs_of_one_shared_band_are_compared():
    codes = np.arange(1, 1 + 3 * icws.BANDS * icws.ROWS, dtype=np.uint32).reshape(3, -1)
    codes[1:, : icws.ROWS] = codes[0, : icws.ROWS]  # one band of all
    near = prose(31, 200).split()
    texts = [" ".join(near), " ".join([*near[:-1], "other"]), prose(32, 200)]
    columns = {"group": [1] * 3, "_a": [0] * 3, "_b": [0] * 3, "_c": [0] * 3, "node": [5, 6, 7], "codes": [c.tobytes() for c in codes], "text": texts}
    idf = SimpleNamespace(value=icws.InverseFrequencies(10, 1, np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    out = [x.to_pydict() for x in icws._verify(idf, icws.SIMILARITY)(iter([pa.RecordBatch.from_pydict(columns)]))]
    assert [x for o in out for x in zip(o["node"], o["root"])] == [(5, 5), (6, 5), (7, 7)]


def test_one_of_each_class_stays(corpus, clashing, nothing):
    exact = brute_classes([(x.doc_id, x.text) for x in corpus.collect()])
    kept = icws.keep_one(corpus).collect()
    assert Counter(x.doc_id for x in kept) == Counter(set(exact.values())) | Counter({None: corpus.where("doc_id is null").count()})
    assert icws.keep_one(clashing).columns == clashing.columns
    assert icws.near_duplicates(nothing).count() == 0 and icws.keep_one(nothing).count() == 0


def test_samples_agree_as_often_as_similarity_says():
    r = np.random.default_rng(0)
    sample = icws.Sampler()
    for share in (0.5, 0.8, 0.95):
        got = []
        for _ in range(60):
            n = 300
            c = int(2 * share / (1 + share) * n)
            e, w = r.integers(0, 1 << 62, 2 * n - c).astype(np.uint64), r.uniform(1, 2, 2 * n - c)
            a, b = np.arange(n), np.concatenate((np.arange(c), np.arange(n, 2 * n - c)))
            a, b = a[np.argsort(e[a])], b[np.argsort(e[b])]
            codes = sample(np.repeat([0, 1], n), np.concatenate((e[a], e[b])), np.concatenate((w[a], w[b])), 2)
            got.append(((codes[0] == codes[1]).mean(), w[:c].sum() / w.sum()))
        agree, exact = np.mean(got, axis=0)
        assert abs(agree - exact) < 0.02


# helpers and the pipeline


def test_groups_stay_whole_across_batches():
    import pyarrow as pa

    r = random.Random(1)
    keys = sorted(r.randrange(40) for _ in range(500))
    batches = [pa.RecordBatch.from_pydict({"k": keys[i : i + 7]}) for i in range(0, 500, 7)]
    got = [g.column("k").to_pylist() for g in grouped(batches, ["k"], 20)]
    assert sum(got, []) == keys
    assert all(set(a).isdisjoint(b) for a, b in zip(got, got[1:]))


def test_local_components():
    linked = np.zeros((6, 6), dtype=bool)
    for a, b in ((5, 3), (3, 4), (1, 2)):
        linked[a, b] = linked[b, a] = True
    assert local_components(linked).tolist() == [0, 1, 1, 3, 3, 3]


def brute_pipeline(spark, rows):
    from tidepool.llm import compression

    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    good = {(x.doc_id, x.text) for x in compression.quality_rules(frame).where("quality.kept").collect()}
    rows = [x for x in rows if (x[0], x[1]) in good]
    lines = brute_lines([(i, t) for i, t, _, _ in rows])
    rows = [(i, lines[i, t][3], la, s) for i, t, la, s in rows]
    classes = brute_classes([(i, t) for i, t, _, _ in rows])
    rows = [x for x in rows if x[0] is None or classes[x[0]] == x[0]]
    size = lambda t: len(WORD.findall(t or ""))
    frame = spark.createDataFrame([(s, sum(size(t) for _, t, _, o in rows if o == s)) for s in {x[3] for x in rows}], "source string, source_size long")
    out = Counter()
    for x in mixing.source_targets(frame).collect():
        own = [(i, t) for i, t, _, s in rows if s == x.source]
        budget, total = int(x.target + 0.5), x.source_size
        whole = budget // total if total else 0
        left, upto = budget - whole * total, 0
        place = lambda d: hashlib.md5(f"{'' if d[0] is None else d[0]}:{hashlib.md5(d[1].encode()).hexdigest()}".encode()).hexdigest()[:15]
        for d in sorted(own, key=place):
            more = upto + size(d[1]) <= left or (upto <= left and 2 * upto + size(d[1]) <= 2 * left)
            out[d[0], x.source] += whole + more
            upto += size(d[1])
    return +out


def test_pipeline_equals_its_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(DOCS).select((F.col("doc_id") + 1000).alias("doc_id"), "text", "lang", "source")
    extra = [(i, t, "en", f"src{i % 3}") for i, t in planted(12)] + [x for x in EDGES if x[0] != 7]
    every = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("n_chars", F.length("text").cast("long"))
    every.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(x.round_trip for x in got)
    assert Counter((x.doc_id, x.source) for x in got) == brute_pipeline(spark, [tuple(x)[:4] for x in every.select("doc_id", "text", "lang", "source").collect()])


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(DOCS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
        assert stage(spark, docs.limit(0), "").count() == 0
