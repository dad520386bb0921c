"""SentencePiece encoding and decoding with the tokenizers library, from the model file's own protobuf."""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import extend, map_texts, plus
from .memo import Memo, decoded, per_process, spread

MARK = "▁"
#: Fixed values of the model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields in order."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


class SentencePieceModel:
    """What a model file says: pieces (text, score, type), model type, byte fallback, normaliser."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback, self.suffix = UNIGRAM, False, False
        self.charsmap, self.dummy_prefix, self.trim, self.escape = b"", True, True, True
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                self.pieces.append((f.get(1, b"").decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
            elif number == 2:
                f = dict(_fields(value))
                self.kind, self.byte_fallback, self.suffix = f.get(3, UNIGRAM), bool(f.get(35, 0)), bool(f.get(24, 0))
            elif number == 3:
                f = dict(_fields(value))
                self.charsmap, self.dummy_prefix, self.trim, self.escape = f.get(2, b""), bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if self.suffix:
            raise ValueError("white space as a suffix is not supported")
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), None)

    def tokenizer(self):
        """The same model as a tokenizers.Tokenizer, without special handling of control pieces in texts."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        if self.kind == UNIGRAM:
            model = models.Unigram([(t, s) for t, s, _ in self.pieces], self.unknown, self.byte_fallback)
        else:
            number = {t: i for i, (t, _, _) in enumerate(self.pieces)}
            plain = {t for t, _, k in self.pieces if k in (NORMAL, USER_DEFINED, UNUSED)}
            merges = sorted((-s, number[t[:k]], number[t[k:]], t[:k], t[k:]) for t, s, kind in self.pieces if kind in (NORMAL, USER_DEFINED, UNUSED) for k in range(1, len(t)) if t[:k] in plain and t[k:] in plain)
            model = models.BPE(vocab=number, merges=[m[3:] for m in merges], unk_token=self.pieces[self.unknown][0], fuse_unk=True, byte_fallback=self.byte_fallback)
        t = Tokenizer(model)
        rules: list = []
        if self.charsmap:
            rules.append(normalizers.Precompiled(self.charsmap))
        if self.trim:
            rules += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if self.dummy_prefix:
            rules.append(normalizers.Prepend(MARK if self.escape else " "))
        if self.escape:
            rules.append(normalizers.Replace(" ", MARK))
        t.normalizer = normalizers.Sequence(rules)
        t.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if self.dummy_prefix else [])])
        t.add_tokens([AddedToken(p, normalized=True) for p, _, k in self.pieces if k == USER_DEFINED])
        return t

    def word_bound(self) -> bool:
        """True if no piece reaches past the end of a word, so that words can be encoded one by one."""
        own = self.dummy_prefix and self.escape and not self.charsmap and not any(k == USER_DEFINED for _, _, k in self.pieces)
        return own and not any(MARK in p.lstrip(MARK) for p, _, _ in self.pieces)


class Codec:
    """Encodes and decodes batches of texts as the sentencepiece library does."""

    def __init__(self, data: bytes):
        self.model = SentencePieceModel(data)
        self.t = self.model.tokenizer()
        opens = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces], dtype=bool)

        def parts(blob: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            words = decoded(blob, starts, ends)
            groups = [" ".join(words[i : i + 64]) for i in range(0, len(words), 64)]
            ids = np.concatenate([np.array(e.ids, dtype=np.uint32) for e in self.t.encode_batch_fast(groups, add_special_tokens=False)])
            return ids, np.diff(np.flatnonzero(opens[ids]), append=len(ids))

        self.words = Memo(parts, b" ") if self.model.word_bound() else None
        surface = {UNKNOWN: " \u2047 ", CONTROL: ""}  # fixed values: what unknown and control pieces decode to
        as_bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else surface.get(k, p.replace(MARK, " ")).encode() for p, _, k in self.model.pieces]
        self.size = np.array([len(b) for b in as_bytes], dtype=np.int64)
        self.start, self.bytes = np.cumsum(self.size) - self.size, np.frombuffer(b"".join(as_bytes), dtype=np.uint8)
        self.shown = np.array([k not in surface for _, _, k in self.model.pieces], dtype=bool)

    @staticmethod
    def _simple(text: str) -> bool:
        """Words parted by single spaces: each begins with the mark, and only there is one."""
        return bool(text) and "  " not in text and MARK not in text and text[0] != " " and text[-1] != " "

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and how many each has. Words that repeat are encoded once; texts with other spacing go whole."""
        simple = np.array([bool(self.words) and self._simple(t) for t in texts], dtype=bool)
        ids, sizes = self.words(pa.array([t for t, s in zip(texts, simple) if s], pa.large_string())) if simple.any() else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        if simple.all():
            return ids, sizes
        whole = [np.array(e.ids, dtype=np.uint32) for e in self.t.encode_batch_fast([t for t, s in zip(texts, simple) if not s], add_special_tokens=False)]
        size = np.concatenate((sizes, [len(w) for w in whole])).astype(np.int64)
        place = np.empty(len(texts), dtype=np.int64)
        place[np.argsort(~simple, kind="stable")] = np.arange(len(texts))
        return spread(place, np.cumsum(size) - size, size, np.concatenate((ids, *whole))), size[place]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of ids laid end to end. Where byte pieces don't make up UTF-8, the library's decoder has the word."""
        data = spread(ids, self.start, self.size, self.bytes).tobytes()
        run = np.concatenate(([0], np.cumsum(self.size[ids])))
        edge = np.concatenate(([0], np.cumsum(sizes)))
        out = []
        for a, b, i, j in zip(run[edge[:-1]].tolist(), run[edge[1:]].tolist(), edge[:-1].tolist(), edge[1:].tolist()):
            try:
                text = data[a:b].decode()
                out.append(text[1:] if self.model.dummy_prefix and text[:1] == " " else text)
            except UnicodeDecodeError:
                own = ids[i:j]
                out.append(self.t.decode(own[self.shown[own]].tolist(), skip_special_tokens=False))
        return out


def _use_threads(threads: int) -> None:
    os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"


def _codec(model: bytes, threads: int) -> Codec:
    _use_threads(threads)
    return per_process(f"codec-{crc32(model)}", lambda: Codec(model))


def encode(docs: DataFrame, model_path: str, text_col: str = "text", threads: int = 2, verify_every: int = 16, rows: int = 1000) -> DataFrame:
    """All columns of docs with `ids` (array of int), `n_tokens`, `round_trip` and `parity`.

    Whole texts are encoded in batches of `rows`. `round_trip` says whether the
    ids decode to the text. `parity` compares the ids of every `verify_every`-th
    text, by CRC of the text, with the sentencepiece library's own (null: not
    compared); verify_every=1 compares all.

    A null text has null ids, count, round trip and parity; an empty one has no ids. Equal
    texts get equal ids, the table may be empty, columns named like the new ones
    are replaced. Each row stands alone: one pass, no shuffle.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        codec = check = None
        for big in batches:
            if codec is None:
                codec, check = _codec(model.value, threads), sentencepiece.SentencePieceProcessor(model_proto=model.value)
            for at in range(0, big.num_rows, rows):
                batch = big.slice(at, rows)
                texts = batch.column(names.index(text_col)).to_pylist()
                flat, sizes = codec.encode([t or "" for t in texts])
                edge = np.concatenate(([0], np.cumsum(sizes)))
                parity: list[bool | None] = [None] * len(texts)
                picked = [i for i, t in enumerate(texts) if t is not None and crc32(t.encode()) % verify_every == 0]
                for i, other in zip(picked, check.encode([texts[i] for i in picked], num_threads=1)):
                    parity[i] = np.array_equal(flat[edge[i] : edge[i + 1]], other)
                missing = np.array([t is None for t in texts], dtype=bool)
                offsets = pa.array(edge.astype(np.int32), mask=np.append(missing, False))
                back = [None if t is None else t == d for t, d in zip(texts, codec.decode(flat, sizes))]
                yield extend(batch, names, {"ids": pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))), "n_tokens": pa.array(sizes, mask=missing), "round_trip": pa.array(back, pa.bool_()), "parity": pa.array(parity, pa.bool_())})

    return map_texts(docs, run, plus(docs.schema, "ids array<int>, n_tokens long, round_trip boolean, parity boolean"))


def decode(tokens: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded", threads: int = 2, rows: int = 1000) -> DataFrame:
    """All columns of tokens with the decoded text. Null ids decode to null, no ids to an empty text."""
    with open(model_path, "rb") as f:
        model = tokens.sparkSession.sparkContext.broadcast(f.read())
    names = tokens.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for big in batches:
            codec = codec or _codec(model.value, threads)
            for at in range(0, big.num_rows, rows):
                batch = big.slice(at, rows)
                ids = batch.column(names.index(ids_col))
                sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                texts = codec.decode(ids.flatten().to_numpy(zero_copy_only=False), sizes)
                yield extend(batch, names, {out_col: pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))})

    return map_texts(tokens, run, plus(tokens.schema, f"{out_col} string"))
