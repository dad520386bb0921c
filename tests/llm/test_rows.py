"""Operators that judge each text by itself: codec, language, quality, personal data, token files."""

import base64
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidepool.llm import bitplane, compression, langid, pii, queries, sentencepiece_codec
from tidepool.llm.common import WORD

from .conftest import EDGES, prose

DOCS = "/root/testdata/sf0.001/documents.parquet"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def rows(df):
    return [tuple(r) for r in df.collect()]


# 1: SentencePiece


def test_codec_equals_the_library_on_every_text(spark, edges):
    docs = spark.read.parquet(DOCS).select("doc_id", "text").unionByName(edges.select("doc_id", "text"))
    done = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, MODEL, verify_every=1), MODEL).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert len(done) == docs.count()
    for r in done:
        if r.text is None:
            assert (r.ids, r.n_tokens, r.parity, r.round_trip, r.decoded) == (None, None, None, None, None)
        else:
            assert r.ids == sp.encode(r.text) and r.n_tokens == len(r.ids) and r.parity
            assert r.decoded == sp.decode(r.ids) and r.round_trip == (r.decoded == r.text)


def test_codec_with_other_columns_and_no_rows(clashing, nothing):
    done = sentencepiece_codec.encode(clashing, MODEL)
    assert done.count() == len(EDGES) and done.columns.count("ids") == 1
    assert sentencepiece_codec.encode(nothing, MODEL).count() == 0


def test_registered_uses_compare_every_text(spark):
    docs = spark.read.parquet(DOCS)
    texts = docs.where("text is not null").count()
    for done in (queries.op1_sentencepiece(spark, DOCS.rpartition("/")[0]), corpus_pipeline.tokens(spark, docs, "")):
        assert done.where("parity").count() == texts


def _field(number, value):
    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(byte_fallback, trim):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else []
    pieces += [(c, -9.0 - i / 10, 1) for i, c in enumerate("▁abcdeghinorst")]
    pieces += [("▁the", -3.1, 1), ("ing", -3.3, 1), ("▁a", -2.9, 1), ("on", -4.0, 1), ("▁on", -3.7, 1), ("ti", -4.1, 1), ("tion", -3.9, 1), ("an", -4.3, 1)]
    data = b"".join(_field(1, _field(1, p.encode()) + _field(2, s) + _field(3, k)) for p, s, k in pieces)
    trainer = _field(3, 1) + (_field(35, 1) if byte_fallback else b"")
    normal = _field(1, b"identity") + _field(3, 1) + _field(4, int(trim)) + _field(5, 1)
    return data + _field(2, trainer) + _field(3, normal)


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("trim", [True, False])
def test_unigram_model(byte_fallback, trim):
    data = unigram_model(byte_fallback, trim)
    sp = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = sentencepiece_codec.Codec(data)
    texts = ["the station", "a the  nation ", " on", "abc", "thing", "the onion ation", "", " "] + (["zebra é"] if byte_fallback else [])
    ids, sizes = codec.encode(texts)
    assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == sp.encode(texts[0])
    for t, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert own.tolist() == sp.encode(t), t
        assert codec.decode(own, np.array([len(own)])) == [sp.decode(sp.encode(t))]


def test_bytes_that_are_no_utf8_decode_as_the_library_does():
    codec = sentencepiece_codec.Codec(open(MODEL, "rb").read())
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = [sp.piece_to_id("<0xE4>"), sp.piece_to_id("▁the")]
    assert codec.decode(np.array(ids), np.array([2])) == [sp.decode(ids)]


# 5: language


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    away = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs.where(away), langid.learn_profiles(docs.where(~away)))
    right, n, low, high = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 200 and right / n > 0.98 and 0 <= low <= high <= 1


def test_profile_ranks_equal_plain_counting(spark):
    texts = ["Abba ba", "ab"]
    expected = Counter()
    for t in texts:
        for w in re.findall(r"[a-z]+", t.lower()):
            p = f" {w} "
            expected.update(w)
            expected.update(p[i : i + 2] for i in range(len(p) - 1))
            expected.update(p[i : i + 3] for i in range(len(p) - 2))
    docs = spark.createDataFrame([(t, "x") for t in texts], "text string, lang string")
    got = {r.gram: r["rank"] for r in langid.learn_profiles(docs).collect()}

    def name(g):
        cs = [(g >> s) & 0x1FFFFF for s in (42, 21, 0)]
        return "".join(" " if c == 0 else chr(c) for c in cs if c != 0x1FFFFF)

    names = {name(g): r for g, r in got.items()}
    assert set(names) == set(expected)
    by_rank = sorted(names, key=names.get)
    assert [expected[x] for x in by_rank] == sorted(expected.values(), reverse=True)


def test_language_edges(spark, edges, clashing, nothing):
    profiles = langid.learn_profiles(edges)
    got = langid.identify(clashing, profiles).select("doc_id", "text", "lang_pred", "score").collect()
    assert len(got) == len(EDGES)
    for r in got:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("de", "en", "es", "fr")
    assert {r.lang_pred for r in langid.identify(edges, langid.learn_profiles(nothing)).collect()} == {"und"}
    assert langid.identify(nothing, profiles).count() == 0


# 9: quality


def brute_quality(text):
    words = WORD.findall(text or "")
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit), failed


def test_quality_base_counts(spark, clashing, nothing):
    own = spark.read.parquet(DOCS).select("doc_id", "text").unionByName(clashing.select("doc_id", "text"))
    got = compression.quality_rules(own).select("text", "quality.*").collect()
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_quality(r.text)
        assert not (r.kept and r.base_failed)
    assert compression.quality_rules(nothing).count() == 0
    kept = compression.reject_low_quality(clashing)
    assert kept.columns == clashing.columns


def test_compression_rejects_repetition_and_noise(spark):
    r = random.Random(5)
    noise = " ".join("".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(8)) for _ in range(400))
    once = prose(9, 200)
    many = " ".join(f"{i % 7} {once}" for i in range(40))
    clean = prose(11, 400)
    half = prose(12, 2000) + " " + " ".join(str(i) + " row" for i in range(3000))
    docs = spark.createDataFrame([(1, noise), (2, many), (3, clean), (4, half)], "doc_id long, text string")
    got = {x.doc_id: x.quality for x in compression.quality_rules(docs).collect()}
    assert not got[1].kept and got[1].ratio > 0.7
    assert not got[2].kept
    assert got[3].kept
    assert got[4].n_bad_chunks > 0 and not got[4].kept


def test_the_remainder_is_judged(spark):
    full = prose(21, 1000)[: compression.CHUNK_BYTES].encode().decode("ascii", "ignore").ljust(compression.CHUNK_BYTES, "e")
    coded = base64.b64encode(random.Random(6).randbytes(3100)).decode()[:4095]
    docs = spark.createDataFrame([(1, full + coded), (2, full + prose(22, 9)[:14]), (3, prose(23, 60)), (4, full)], "doc_id long, text string")
    got = {x.doc_id: x.quality for x in compression.quality_rules(docs).collect()}
    assert compression.band_of(8191)[0] <= got[1].ratio <= compression.band_of(8191)[1]
    assert (got[1].n_chunks, got[1].n_bad_chunks, got[1].kept) == (2, 1, False)
    assert [(got[i].n_chunks, got[i].n_bad_chunks, got[i].kept) for i in (2, 3, 4)] == [(1, 0, True)] * 3
    for size in [1, 99, 4095, 4096, 4195, 4196, 8191, 8192, 20_000]:
        edges = compression._chunks(size)
        assert edges[0][0] == 0 and edges[-1][1] == size and all(a[1] == b[0] for a, b in zip(edges, edges[1:]))


# 10: personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_spans_equal_plain_matching():
    r = random.Random(0)
    for alphabet in ("a@.-1 2+50(%", "0123456789 -", "1.2 3+()4567", "a@b.é @"):
        for _ in range(4000):
            text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
            assert pii.base_spans(text) == brute_spans(text), text
    assert pii.base_spans("4111 1111 1111 1111 x 4111111111111112")[0] == ("card", 0, 19)
    assert pii.base_spans("0" * 6000 + ".1.2.3") == [("ip", 0, 6006)]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@a" * 150_000, "1 " * 150_000):
        pii.candidates(text, pii.base_spans(text))


def test_added_spans_find_planted_secrets_and_leave_numbers(spark):
    r = random.Random(3)
    docs, secrets = [], {}
    for i in range(400):
        text = prose(i, 30)
        if i % 4 == 0:
            key = "".join(r.choice("0123456789abcdef") for _ in range(24))
            text += f" password={key} "
            secrets[i] = (len(text) - 25, len(text) - 1)
        elif i % 4 == 1:
            text += f" version {r.randint(1, 30)}.{r.randint(0, 9)} of page {r.randint(100, 999)} "
        docs.append((i, text + prose(i + 1000, 20)))
    got = {x.doc_id: x.spans for x in pii.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for i in range(400):
        assert [(s.kind, s.start, s.end) for s in got[i]] == ([("secret", *secrets[i])] if i in secrets else [])


def test_personal_data_edges(spark, clashing, nothing):
    more = spark.createDataFrame([(50, "mail a.b@c.de and +1 (203) 555-8282, 10.0.0.255"), (51, None)], "doc_id long, text string")
    got = {x.doc_id: x.spans for x in pii.find_personal_data(more).collect()}
    assert [(s.kind, s.start, s.end, s.probability) for s in got[50]] == [("email", 5, 13, 1.0), ("ip", 37, 47, 1.0), ("phone", 18, 35, 1.0)]
    assert got[51] == []
    done = pii.find_personal_data(clashing)
    assert done.count() == len(EDGES) and "text" not in done.columns
    assert pii.find_personal_data(nothing).count() == 0


def test_label_model_learns_reliabilities():
    r = random.Random(1)
    counts = Counter()
    for _ in range(20_000):
        y = r.random() < 0.3
        vote = lambda right: ("p" if y == (r.random() < right) else "n")  # noqa: E731, B023
        counts[vote(0.95) + vote(0.9) + vote(0.85) + vote(0.6) + "aa"] += 1
    model = pii.LabelModel(dict(counts))
    right = [model.rates[1, k, 2] for k in range(4)]
    assert right[0] > right[1] > right[2] > right[3] and abs(right[0] - 0.95) < 0.03 and abs(model.prior - 0.3) < 0.03


# 7: token files


def test_blocks_round_trip():
    import zstandard

    z, d = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    for planes in ("bit", "byte"):
        for ids in ([], [0], [7, 0, 4_294_967_295], list(range(70_000))):
            a = np.array(ids, dtype=np.uint32)
            assert bitplane.unpack_block(bitplane.pack_block(a, planes, z), len(a), planes, d).tolist() == ids


@pytest.mark.parametrize("planes", ["bit", "byte"])
def test_files_hold_what_the_library_encodes(spark, edges, planes):
    docs = spark.read.parquet(DOCS).select("doc_id", "text").unionByName(edges.select("doc_id", "text")).repartition(5)
    got = bitplane.ids_digest(bitplane.encode_to_files(docs, WORD_BPE, as_bytes=True, planes=planes)).orderBy("start").collect()
    t = Tokenizer.from_file(WORD_BPE)
    own = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in got] == [r.doc_id for r in own]
    at, sums = 0, Counter()
    for r in got:
        assert r.start == at
        at += r.n_tokens
        sums[r.doc_id, r.n_tokens, r.ids_crc32] += 1
    expected = Counter()
    for r in own:
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [2]
        expected[r.doc_id, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())] += 1
    assert sums == expected
    arrays = {tuple(r.ids) for r in bitplane.encode_to_files(edges.select("doc_id", "text"), WORD_BPE).collect()}
    assert arrays == {(*t.encode(r.text or "", add_special_tokens=False).ids, 2) for r in edges.collect()}


def test_no_documents_make_no_files(nothing):
    assert bitplane.encode_to_files(nothing, WORD_BPE).count() == 0


def test_word_encoder_equals_whole_texts():
    t, encode = Tokenizer.from_file(WORD_BPE), bitplane.word_encoder(open(WORD_BPE, encoding="utf-8").read())
    r = random.Random(2)
    signs = ["Don't", "STOP.,,.", "\x1c", "a\x85b", "é́", "<|endoftext|>", "x<|endoftext|>y<", "İ", "Σς", "12ab", "a,b", "你好", "!!", "Ander", "onin,", "%%%x", "ǅ", "ª", "it's"]
    texts = ["".join(r.choice(signs) + r.choice([" ", "\n", "  ", "\t", " "]) for _ in range(30)) for _ in range(200)]
    ids, sizes = encode(pa.array(texts))
    for text, own in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert own.tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_memo_that_forgets_rare_words_gives_the_same_ids():
    encode = bitplane.word_encoder(open(WORD_BPE, encoding="utf-8").read())
    texts = pa.array([prose(k, 400) for k in range(40)])
    whole = encode(texts)
    encode.limit = 50
    for k in range(0, 40, 5):
        ids, sizes = encode(texts.slice(k, 5))
        first = int(whole[1][:k].sum())
        assert np.array_equal(ids, whole[0][first : first + len(ids)]) and np.array_equal(sizes, whole[1][k : k + 5])
        encode._drop()
        assert len(encode.size) == len(encode.hash) == len(encode.uses) <= 25
        assert np.array_equal(encode.hash, np.sort(encode.hash))


def test_words_of_equal_hash_stay_apart(monkeypatch):
    from tidepool.llm import memo

    class Same(memo.Words):
        def __init__(self, *a):
            super().__init__(*a)
            self.hash = self.hash & np.uint64(1)

    encode = bitplane.word_encoder(open(WORD_BPE, encoding="utf-8").read())
    expected = [encode(pa.array([w]))[0].tolist() for w in WORDS_ALIKE]
    monkeypatch.setattr(memo, "Words", Same)
    crowded = bitplane.word_encoder(open(WORD_BPE, encoding="utf-8").read())
    for _ in range(2):
        assert [crowded(pa.array([w]))[0].tolist() for w in WORDS_ALIKE] == expected


WORDS_ALIKE = ["ander", "onin", "the", "wh", "reat", "lys", "öst", "x.", "ion"]


def test_other_tokenizers_encode_whole_texts():
    import json

    told = json.load(open(WORD_BPE, encoding="utf-8"))
    assert bitplane.word_bound(json.dumps(told))
    told["normalizer"] = {"type": "Lowercase"}
    other = json.dumps(told)
    assert not bitplane.word_bound(other)
    texts = ["Don't  STOP", "", "é́ x", None]
    ids, sizes = bitplane.word_encoder(other)(pa.array(texts))
    own = [Tokenizer.from_str(other).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(own, []) and sizes.tolist() == [len(o) for o in own]


def test_ids_of_rows_with_other_columns(clashing):
    wide = clashing.withColumns({c: F.lit("own") for c in ("start", "n_tokens", "part", "path", "text_hash")})
    done = bitplane.ids_digest(bitplane.encode_to_files(wide, WORD_BPE, as_bytes=True))
    assert done.count() == len(EDGES) and done.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
