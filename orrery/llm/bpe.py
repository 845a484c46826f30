"""BPE encoding that encodes text shared between documents once.

Texts are cut where a rolling hash of their last bytes hits a value, moved on to the next blank, so equal
passages are cut alike wherever they stand. Spark counts in how many rows each chunk occurs. Chunks of two
rows or more are encoded once, by the task that owns their hash, and their ids are joined back; a document
without any is encoded where it is read and crosses no shuffle. So do all chunks that are not shared.

A join of two chunks is accepted if the text around it, encoded as one piece, gives the ids of both sides
put together. If not, the window grows, and chunks that still disagree as wholes are encoded as one.

Which chunks are shared is told by a Bloom filter of fixed size. One that passes by mistake is looked up in
vain and then encoded from the text that travels with it.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import settled, table

#: Bytes that the rolling hash sees, and the mean distance of its cuts (a power of two).
ROLL = 32
MEAN_CHUNK = 1024
FILTER_BITS = 25
#: Bytes of output after which a batch goes back to Spark; words after which a worker begins to forget older ones.
OUT_BYTES = 1 << 20
WORDS_KNOWN = 400_000
JOINS_KNOWN = 300_000
_GEAR = np.array([xxhash.xxh32_intdigest(bytes([i]), 7) for i in range(256)], np.uint32)


class _Known(dict):
    """Word to (ids, decoded). Words not asked for while ``WORDS_KNOWN`` others were are forgotten."""

    def __init__(self, library):
        self.library, self.old = library, {}

    def __missing__(self, word: bytes) -> tuple[bytes, str]:
        if len(self) >= WORDS_KNOWN:
            self.old = self.copy()
            self.clear()
        found = self.old.get(word)
        if found is None:
            e = self.library.encode(word.decode(), add_special_tokens=False)
            ids = e.ids
            found = struct.pack(f"<{len(ids)}I", *ids), " ".join(e.tokens)
        self[word] = found
        return found


class Encoder:
    """Ids of texts by the tokenizers library, word by word: ASCII white space never lies inside a token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.known = _Known(self.library)
        self.tokens = [self.library.id_to_token(i) for i in range(self.library.get_vocab_size())]

    def decoded(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def text(self, text: bytes) -> tuple[bytes, str]:
        """(ids, decoded) of a text."""
        found = list(map(self.known.__getitem__, text.split()))
        return b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[0]])

    def whole(self, text: bytes) -> bytes:
        """Ids of a piece given to the library as it is."""
        return np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def joins(self, left: bytes, right: bytes, kept: dict) -> bool:
        """Whether the two chunks' ids put together are those of their text; looks at ever more words around the join."""
        a, b, n = left.split(), right.split(), 1
        space = left[len(left.rstrip()) :]
        while True:
            x, y = b" ".join(a[-n:]) + space, b" ".join(b[:n])
            if (x, y) not in kept:
                apart = self.text(x)[0] + self.text(y)[0]
                if len(kept) > JOINS_KNOWN:
                    kept.clear()
                kept[x, y] = self.whole(x + y) == apart
            if kept[x, y]:
                return True
            if n >= max(len(a), len(b)):
                return False
            n *= 2


def encoder(path: str) -> tuple[Encoder, dict]:
    """The worker's encoder for a tokenizer file; it outlives the task, as loading takes a while."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_orrery_encoders", {})
    if path not in held:
        held[path] = (Encoder(path), {})
    return held[path]


def cuts(texts: list[bytes]) -> list[np.ndarray]:
    """Cut positions inside each text, ascending; behind a blank, and decided by the bytes before it alone."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    if not len(data):
        return [np.empty(0, np.int64) for _ in texts]
    h = _GEAR[data]
    span = 1
    while span < ROLL:  # sum of gear[byte] << distance, for twice as many bytes each time
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    hits = np.flatnonzero(h >> np.uint32(32 - MEAN_CHUNK.bit_length() + 1) == 0)
    blanks = np.flatnonzero((data == 0x20) | (data == 0x0A))
    if not len(hits) or not len(blanks):
        return [np.empty(0, np.int64) for _ in texts]
    owner = np.searchsorted(ends, hits, side="right")
    ok = hits - starts[owner] >= ROLL
    hits, owner = hits[ok], owner[ok]
    nxt = np.searchsorted(blanks, hits)
    ok = nxt < len(blanks)
    at, owner = blanks[nxt[ok]] + 1, owner[ok]
    ok = at < ends[owner]
    at, owner = at[ok] - starts[owner[ok]], owner[ok]
    return [np.unique(x) for x in np.split(at, np.searchsorted(owner, np.arange(1, len(texts))))]


def _chunks(texts: list[bytes]) -> list[list[bytes]]:
    out = []
    for text, at in zip(texts, cuts(texts), strict=True):
        edges = [0, *at.tolist(), len(text)]
        out.append([text[a:b] for a, b in zip(edges, edges[1:], strict=False)])
    return out


def _key(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _texts(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) for stretches of a few megabytes."""
    held, size, first = [], 0, 0
    for k, t in enumerate(column.cast(pa.binary()).to_pylist()):
        held.append(t or b"")
        size += len(held[-1])
        if size >= OUT_BYTES:
            yield first, held
            held, size, first = [], 0, k + 1
    if held:
        yield first, held


def chunk_counts(texts: DataFrame) -> DataFrame:
    """(key, n): in how many rows of ``texts`` (column text) each chunk occurs."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, part in _texts(b.column("text")):
                keys = [k for c in _chunks(part) for k in {_key(x) for x in c}]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary())], ["key"])

    return texts.select("text").mapInArrow(of_batches, "key binary").groupBy("key").agg(F.count("*").alias("n"))


def _filter(keys: DataFrame) -> np.ndarray:
    """Bloom filter, two bits per key; 2**FILTER_BITS bits whatever the input."""
    bits = F.xxhash64("key")
    low = (1 << FILTER_BITS) - 1
    each = F.explode(F.array(bits.bitwiseAND(low), F.shiftrightunsigned(bits, 32).bitwiseAND(low)))
    words = keys.select(each.alias("b")).groupBy(F.shiftright("b", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 31 as int))")).alias("m"))
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    got = words.toPandas()
    out[got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64).astype(np.uint32)
    return out


def _passes(words: np.ndarray, keys: list[bytes]) -> np.ndarray:
    """For each key, whether its bits are set; hashed as Spark's xxhash64 does."""
    h = np.fromiter((xxhash.xxh64_intdigest(k, 42) for k in keys), np.uint64, len(keys))
    low = np.uint64((1 << FILTER_BITS) - 1)
    has = lambda b: (words[b >> np.uint64(5)] >> (b & np.uint64(31)).astype(np.uint32)) & np.uint32(1)
    return (has(h & low) & has((h >> np.uint64(32)) & low)) > 0


def _shared_ids(texts: DataFrame, words, path: str) -> DataFrame:
    """(key, shared_ids): chunks that pass the filter, each encoded by one task."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for b in batches:
            for _, part in _texts(b.column("text")):
                chunks = {_key(c): c for x in _chunks(part) for c in x}
                keys = list(chunks)
                keys = [k for k, ok in zip(keys, _passes(words.value, keys), strict=True) if ok and k not in sent]
                if len(sent) > 1_000_000:
                    sent.clear()
                sent.update(keys)
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([chunks[k] for k in keys], pa.binary())], ["key", "chunk"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = encoder(path)
        last = None
        for b in batches:
            keys, chunks = b.column("key").to_pylist(), b.column("chunk").to_pylist()
            new = [k for k in range(len(keys)) if keys[k] != (keys[k - 1] if k else last)]
            last = keys[-1] if keys else last
            for at in range(0, len(new), 500):
                part = new[at : at + 500]
                ids = [own.text(chunks[k])[0] for k in part]
                yield pa.RecordBatch.from_arrays([pa.array([keys[k] for k in part], pa.binary()), pa.array(ids, pa.binary())], ["key", "shared_ids"])

    picked = texts.select("text").mapInArrow(pick, "key binary, chunk binary")
    return picked.repartition("key").sortWithinPartitions("key").mapInArrow(encode, "key binary, shared_ids binary")


def encoded(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): each text's ids (little-endian unsigned 32-bit numbers) and the text they decode to.

    ``tokenizer``: path of a tokenizers file that every executor can read; no special tokens are added,
    those in a text are recognised as the library does. Null texts are empty and have no ids. Rows with null
    or repeated ids stay, repeated rows too. An empty table gives an empty result; other columns are left out.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    shared = settled(chunk_counts(texts).where("n > 1").select("key"))
    words = spark.sparkContext.broadcast(_filter(shared))
    known = settled(_shared_ids(texts, words, tokenizer))

    out_schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])

    def split(part: list[bytes]) -> tuple[list[list[bytes]], list[list[bytes]], list[np.ndarray]]:
        chunks = _chunks(part)
        keys = [[_key(c) for c in x] for x in chunks]
        flat = _passes(words.value, [k for x in keys for k in x])
        return chunks, keys, np.split(flat, np.cumsum([len(x) for x in keys])[:-1])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = encoder(tokenizer)
        for b in batches:
            for first, part in _texts(b.column("text")):
                _, _, hit = split(part)
                rows = [k for k in range(len(part)) if not hit[k].any()]
                found = [own.text(part[k]) for k in rows]
                where = pa.array([first + k for k in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("id").take(where), pa.array([x[0] for x in found], pa.binary()), pa.array([x[1] for x in found], pa.string())], ["id", "ids", "decoded"])

    piece_schema = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("hash", T.BinaryType()), T.StructField("seq", T.IntegerType()), T.StructField("key", T.BinaryType()), T.StructField("chunk", T.BinaryType())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, agreed = encoder(tokenizer)
        for b in batches:
            for first, part in _texts(b.column("text")):
                chunks, keys, hit = split(part)
                rows, hashes, seqs, ks, cs = [], [], [], [], []
                for k in range(len(part)):
                    if not hit[k].any():
                        continue
                    merged = [chunks[k][0]]
                    names = [keys[k][0] if hit[k][0] else None]
                    for c, name, ok in zip(chunks[k][1:], keys[k][1:], hit[k][1:], strict=True):
                        if own.joins(merged[-1], c, agreed):
                            merged.append(c)
                            names.append(name if ok else None)
                        else:
                            merged[-1] += c
                            names[-1] = None
                    digest = _key(part[k])
                    for seq, (c, name) in enumerate(zip(merged, names, strict=True)):
                        rows.append(first + k)
                        hashes.append(digest)
                        seqs.append(seq)
                        ks.append(name or _key(c))
                        cs.append(c)
                cols = [b.column("id").take(pa.array(rows, pa.int64())), pa.array(hashes, pa.binary()), pa.array(seqs, pa.int32()), pa.array(ks, pa.binary()), pa.array(cs, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, piece_schema.names)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = encoder(tokenizer)
        key, held, done, size = None, [], [], 0
        kind = None

        def close() -> int:
            parts, copies, n = [], 0, 0
            for seq, ids, chunk in held:  # rows of copies of the same document lie together
                if seq == len(parts):
                    parts.append((ids, own.decoded(ids)) if ids is not None else own.text(chunk))
                copies += seq == 0
            ids, text = b"".join([x[0] for x in parts]), " ".join([x[1] for x in parts if x[0]])
            for _ in range(copies):
                done.append((key[0], ids, text))
                n += len(ids) + len(text)
            return n

        def out() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) or [(), (), ()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.string())], out_schema.names)

        for b in batches:
            kind = b.schema.field("id").type
            for row in zip(*(b.column(c).to_pylist() for c in ("id", "hash", "seq", "shared_ids", "chunk")), strict=True):
                if key != row[:2]:
                    if held:
                        size += close()
                    key, held = row[:2], []
                held.append(row[2:])
                if size > OUT_BYTES:
                    size = 0
                    yield out()
        if held:
            close()
        if done:
            yield out()

    met = texts.mapInArrow(pieces, piece_schema).join(known, "key", "left")
    met = met.select("id", "hash", "seq", "shared_ids", F.when(F.col("shared_ids").isNull(), F.col("chunk")).alias("chunk"))
    joined = met.repartition("id", "hash").sortWithinPartitions("id", "hash", "seq").mapInArrow(assemble, out_schema)
    return texts.mapInArrow(alone, out_schema).unionByName(joined).withColumnRenamed("id", id_col)


def op6(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
