"""Token-id files: fixed-size id blocks, transposed into bit or byte planes, each compressed with zstandard."""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_texts, shared_dir
from .memo import Memo, decoded, per_process, spread

MAGIC = b"TIDPLN01"
BLOCK_IDS = 1 << 16
END_ID = 2


def pack_block(ids: np.ndarray, planes: str, z) -> list[bytes]:
    """The compressed planes of up to BLOCK_IDS ids, lowest plane first; as many as the greatest id needs."""
    ids = ids.astype("<u4")
    width = int(ids.max()).bit_length() if len(ids) else 0
    octets = ids.view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [z.compress(octets[:, i].tobytes()) for i in range((width + 7) // 8)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")[:, :width]
    return [z.compress(np.packbits(bits[:, i]).tobytes()) for i in range(width)]


def unpack_block(parts: list[bytes], n: int, planes: str, z) -> np.ndarray:
    out = np.zeros((n, 4), dtype=np.uint8)
    if planes == "byte":
        for i, p in enumerate(parts):
            out[:, i] = np.frombuffer(z.decompress(p), dtype=np.uint8)
    else:
        bits = np.zeros((n, 32), dtype=np.uint8)
        for i, p in enumerate(parts):
            bits[:, i] = np.unpackbits(np.frombuffer(z.decompress(p), dtype=np.uint8), count=n)
        out = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(out).view("<u4").reshape(-1)


class Writer:
    """One file: MAGIC, the planes of block after block, the index as compressed JSON, its length, MAGIC."""

    def __init__(self, sink, planes: str, level: int = 3):
        import zstandard

        self.sink, self.planes, self.z = sink, planes, zstandard.ZstdCompressor(level=level)
        self.at, self.blocks, self.held, self.n_held, self.n_ids = sink.write(MAGIC) and len(MAGIC), [], [], 0, 0
        self.doc_ids: list = []
        self.doc_sizes: list[int] = []

    def add(self, doc_ids: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.doc_sizes += sizes.tolist()
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        whole = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, whole, BLOCK_IDS):
            block = ids[i : min(i + BLOCK_IDS, whole)]
            parts = pack_block(block, self.planes, self.z)
            self.blocks.append([self.at, len(block), [len(p) for p in parts]])
            self.sink.write(b"".join(parts))
            self.at += sum(map(len, parts))
            self.n_ids += len(block)
        self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        index = {"planes": self.planes, "n_ids": self.n_ids, "blocks": self.blocks, "doc_ids": self.doc_ids, "doc_sizes": self.doc_sizes}
        tail = self.z.compress(json.dumps(index).encode())
        self.sink.write(tail + struct.pack("<Q", len(tail)) + MAGIC)


def read_index(source) -> dict:
    import zstandard

    size = source.size()
    source.seek(size - 8 - len(MAGIC))
    n, magic = struct.unpack("<Q", source.read(8))[0], source.read(len(MAGIC))
    if magic != MAGIC:
        raise ValueError("not a token-id file, or one that was not finished")
    source.seek(size - 8 - len(MAGIC) - n)
    return json.loads(zstandard.ZstdDecompressor().decompress(source.read(n)))


def read_blocks(source, index: dict) -> Iterator[np.ndarray]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    for at, n, sizes in index["blocks"]:
        source.seek(at)
        data, ends = source.read(sum(sizes)), np.cumsum([0, *sizes])
        yield unpack_block([data[ends[i] : ends[i + 1]] for i in range(len(sizes))], n, index["planes"], z)


#: Words a call encodes as one text: longer texts cost more a word.
TOGETHER = 64
#: What a tokenizer file must say for texts to be encoded by their words: fixed values of its format.
NORMAL_FORM = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
WORD_END = "</w>"


def word_bound(tokenizer_json: str) -> bool:
    """True if the tokenizer drops white space, never joins across it, folds case, and ends every run of letters or other signs with a piece in WORD_END."""
    t = json.loads(tokenizer_json)
    splits = (t.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    rest = [(p.get("type"), p.get("add_prefix_space"), p.get("use_regex")) for p in splits[1:]]
    model, added = t["model"], t.get("added_tokens") or []
    return (
        t.get("normalizer") == NORMAL_FORM
        and splits[0] == PIECES
        and rest == [("ByteLevel", False, False)]
        and model.get("type") == "BPE"
        and model.get("end_of_word_suffix") == WORD_END
        and not model.get("continuing_subword_prefix")
        and not model.get("dropout")
        and bool(added)
        and all(a["special"] and not (a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"]) and a["content"].startswith("<|") for a in added)
    )


def _plain(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of words laid end to end: which are letters that no normal form changes and then signs, and where each's signs start (or it ends); the byte classes."""
    kind = np.full(256, 2, dtype=np.uint8)  # 0 letter, 1 sign, 2 other
    kind[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 0
    kind[list(b".,!?;:%&*#$")] = 1
    of = kind[data]
    # U+00C0 to U+00FF but the signs in it: two bytes, the first of them C3
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    second = data[lead + 1]
    letter = lead[(second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)]
    of[letter] = of[letter + 1] = 0
    # a word is plain if it starts with a letter and no byte is less than the one before, or an other
    bad = of == 2
    bad[1:] |= of[1:] < of[:-1]
    bad[starts] = of[starts] != 0
    sums = np.concatenate(([0], np.cumsum(bad)))
    signs = np.concatenate(([0], np.cumsum(of == 1)))
    plain = sums[ends] == sums[starts]
    return plain, ends - (signs[ends] - signs[starts]), of


class WholeTexts:
    """Ids of texts encoded one by one, for tokenizers of any kind."""

    def __init__(self, tokenizer):
        self.t = tokenizer

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(e.ids, dtype=np.uint32) for e in self.t.encode_batch_fast([x or "" for x in texts.to_pylist()], add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(f) for f in found], dtype=np.int64)


def word_encoder(tokenizer_json: str) -> Memo | WholeTexts:
    """Ids of whole texts, from the ids of their different words where `word_bound` holds.

    Plain words are encoded together and cut after the pieces that end them;
    others are joined by a special token and cut at its id.
    """
    from tokenizers import Tokenizer, pre_tokenizers

    t = Tokenizer.from_str(tokenizer_json)
    if not word_bound(tokenizer_json):
        return WholeTexts(t)
    split_marker = max(json.loads(tokenizer_json)["added_tokens"], key=lambda a: a["id"])["content"]
    fast = Tokenizer.from_str(tokenizer_json)
    fast.normalizer = None
    fast.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    marker, vocab = t.token_to_id(split_marker), t.get_vocab()
    closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
    closes[[i for w, i in vocab.items() if w.endswith(WORD_END)]] = True

    def joined(tok, texts: list[str]) -> np.ndarray:
        return np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, dtype=np.uint32) for e in tok.encode_batch_fast(texts, add_special_tokens=False))])

    def encode(blob: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = ends - starts
        every = np.arange(len(starts))
        data = spread(every, starts, length, np.frombuffer(blob, dtype=np.uint8))
        to = np.cumsum(length)
        plain, signs, _ = _plain(data, to - length, to)
        signed = (signs < to)[plain]
        # the plain words' runs, a space after each: letters, then signs where there are some
        edges = np.stack([(to - length)[plain], signs[plain], signs[plain], to[plain]], axis=1).reshape(-1, 2)
        edges = edges[edges[:, 0] < edges[:, 1]]
        size = edges[:, 1] - edges[:, 0]
        spaced = np.insert(spread(np.arange(len(edges)), edges[:, 0], size, data), np.cumsum(size), 0x20).tobytes()
        runs = 1 + signed.astype(np.int64)
        last = np.cumsum(runs) - 1  # each word's last run
        word_end = (np.cumsum(size) + np.arange(1, len(size) + 1))[last]
        cuts = [0, *word_end[TOGETHER - 1 :: TOGETHER].tolist()]
        if cuts[-1] != len(spaced):
            cuts.append(len(spaced))
        ids = joined(fast, [spaced[a : b - 1].decode().lower() for a, b in zip(cuts, cuts[1:])])
        stops = np.flatnonzero(closes[ids])[last] + 1
        odd = decoded(blob, starts[~plain], ends[~plain])
        rare = np.array(["<|" in w for w in odd], dtype=bool)  # may hold a special token
        common = [w for w, r in zip(odd, rare) if not r]
        other = joined(t, [split_marker + split_marker.join(common[i : i + TOGETHER]) for i in range(0, len(common), TOGETHER)])
        marks = np.flatnonzero(other == marker)
        lone = [joined(t, [w]) for w, r in zip(odd, rare) if r]
        flat = np.concatenate([ids, other[other != marker], *lone])
        # where each word's ids lie in flat, in the order: plain, common, rare
        n = np.concatenate([np.diff(stops, prepend=0), np.diff(marks, append=len(other)) - 1, np.array([len(x) for x in lone], dtype=np.int64)]).astype(np.int64)
        where = np.concatenate([every[plain], every[~plain][~rare], every[~plain][rare]])
        place = np.empty(len(every), dtype=np.int64)
        place[where] = every
        return spread(place, np.cumsum(n) - n, n, flat), n[place]

    return Memo(encode)


def write_ids(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    planes: str = "byte",
    folder: str | None = None,
) -> DataFrame:
    """Encode every text, append end_id, write ids in ascending id order; the manifest (part, path, n_docs, n_ids, start).

    Rows are dealt by ranges of the id (nulls last, ties by text hash), so each
    task streams its texts to one file and no task holds a file's ids: at most a
    batch and one block. A file gets its name only when it is finished, and a
    task that runs again writes the same bytes, so lost executors leave no torn
    file. `start`, the ids in all files before, comes from the manifest, which
    has one row a file.

    Null texts are empty and have the end id alone; repeated rows are written
    each; an empty table gives an empty manifest; other columns are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = docs.sparkSession.sparkContext.broadcast(f.read())
    folder = folder or f"{shared_dir(docs.sparkSession)}/token-ids-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zlib import crc32

        from pyarrow.fs import FileSystem
        from pyspark import TaskContext

        context = TaskContext.get()
        writer = sink = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs, root = FileSystem.from_uri(folder)
                fs.create_dir(root, recursive=True)
                name, temp = f"{root}/part-{context.partitionId():06d}.ids", f"{root}/.{context.taskAttemptId()}.tmp"
                sink = fs.open_output_stream(temp)
                writer = Writer(sink, planes)
                encode = per_process(f"word-encoder-{crc32(tokenizer.value.encode())}", lambda: word_encoder(tokenizer.value))
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids, sizes = encode(some.column(1))
                writer.add(some.column(0).to_pylist(), np.insert(ids, np.cumsum(sizes), end_id), sizes + 1)
        if writer is not None:
            writer.close()
            sink.close()
            fs.move(temp, name)
            yield pa.RecordBatch.from_pydict({"part": [context.partitionId()], "path": [f"{folder}/{name.rsplit('/', 1)[1]}"], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.n_ids]})

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = F.col("doc_id").asc_nulls_last()
    dealt = own.repartitionByRange(order).sortWithinPartitions(order, F.xxhash64("text"))
    manifest = cut(map_texts(dealt, write, "part long, path string, n_docs long, n_ids long"), "token-manifest")
    before = Window.partitionBy().orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_ids(manifest: DataFrame, id_type: str = "long", as_bytes: bool = False) -> DataFrame:
    """(doc_id, start, ids) of every document in the files of a manifest; start counts the ids of all documents before.

    ids are an array of int or, as_bytes, little-endian unsigned 32-bit integers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        kind = {"long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = FileSystem.from_uri(path)
                with fs.open_input_file(at) as source:
                    index = read_index(source)
                    names, sizes, doc, rest = index["doc_ids"], np.array(index["doc_sizes"], dtype=np.int64), 0, np.zeros(0, np.uint32)
                    for block in read_blocks(source, index):
                        rest = np.concatenate((rest, block))
                        ends = np.cumsum(sizes[doc : doc + len(rest)])
                        n = int(np.searchsorted(ends, len(rest), "right"))
                        if n:
                            used = int(ends[n - 1])
                            offsets = np.concatenate(([0], ends[:n])).astype(np.int32)
                            if as_bytes:
                                ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets * 4), pa.py_buffer(rest[:used].astype("<u4").tobytes())])
                            else:
                                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rest[:used].astype(np.int32)))
                            yield pa.RecordBatch.from_arrays([pa.array(names[doc : doc + n], kind), pa.array(start + offsets[:-1].astype(np.int64)), ids], ["doc_id", "start", "ids"])
                            start, doc, rest = start + used, doc + n, rest[used:]

    # as many tasks as files, of which there are as many as the writing job had tasks
    files = manifest.select("path", "start").repartition(max(1, manifest.count()), "path")
    return files.mapInArrow(read, f"doc_id {id_type}, start long, ids {'binary' if as_bytes else 'array<int>'}")


def ids_digest(ids: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of ids read as bytes."""
    return ids.select("doc_id", "start", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def encode_to_files(docs: DataFrame, tokenizer_path: str, as_bytes: bool = False, **how) -> DataFrame:
    """write_ids, then read_ids of what was written."""
    kind = docs.schema[how.get("id_col", "doc_id")].dataType.simpleString()
    return read_ids(write_ids(docs, tokenizer_path, **how), kind, as_bytes)
