"""Importance resampling: documents drawn by how much their hashed n-grams look like a target's.

A feature is a run of one to ``width`` words, its bucket the CRC-32 of its bytes modulo the number of buckets.
No n-gram is ever built as a string. Words are joined by one space and scanned once for the running CRC at
every word end; the CRC of any run of words then follows from the two running values around it:

    crc(run) = crc(all up to its end) xor shift(crc(all before it), length of the run)

where shift appends that many zero bytes, a linear map over GF(2) that tables hold. Many documents are
scanned as one string, since what stands before a run cancels.

The buckets of each document are written once; counts per bucket come from that table, are as many as there
are buckets whatever the input, and go back to the tasks as a table of gains.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import settled, table
from orrery.operators.keys import dense_key

WIDTH = 2
BUCKETS = 10_000
PERCENT = 25
SEED = 7
MIN_WORDS = 20
#: Bytes of text that are scanned as one string.
SCAN_BYTES = 1 << 20
#: Run lengths up to this are shifted by one look-up, longer ones with one more for each bit above.
SHORT_BITS = 6
ROWS_PER_BUCKET = 500_000

#: Every byte that is no part of a word becomes a space; A-Z are lower-cased before.
_SEPARATED = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _step_table() -> np.ndarray:
    """What a CRC-32 register becomes by a zero byte, for each value of its low byte."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_STEP = _step_table()


def _lookup(tables: np.ndarray, c: np.ndarray) -> np.ndarray:
    """A linear map given as four tables, one for each byte of the argument."""
    return tables[0][c & 255] ^ tables[1][(c >> 8) & 255] ^ tables[2][(c >> 16) & 255] ^ tables[3][c >> 24]


def _tables(images: np.ndarray) -> np.ndarray:
    """Tables of the linear map that sends bit i to ``images[i]``."""
    out = np.zeros((4, 256), np.uint32)
    values = np.arange(256)
    for byte in range(4):
        for bit in range(8):
            out[byte] ^= np.where(values >> bit & 1, images[8 * byte + bit], 0).astype(np.uint32)
    return out


class Shifts:
    """Maps that append n zero bytes to a CRC: one table for each short n, one for each higher bit of n."""

    def __init__(self) -> None:
        images = np.uint32(1) << np.arange(32, dtype=np.uint32)
        short = []
        for _ in range(1 << SHORT_BITS):
            short.append(_tables(images))
            images = _STEP[images & 255] ^ (images >> 8)
        self.short = np.stack(short)
        self.high = []
        for _ in range(32 - SHORT_BITS):
            self.high.append(_tables(images))
            images = _lookup(self.high[-1], images)

    def __call__(self, c: np.ndarray, n: np.ndarray) -> np.ndarray:
        low = n & ((1 << SHORT_BITS) - 1)
        out = self.short[low, 0, c & 255] ^ self.short[low, 1, (c >> 8) & 255] ^ self.short[low, 2, (c >> 16) & 255] ^ self.short[low, 3, c >> 24]
        rest = n >> SHORT_BITS
        for bit in range(int(rest.max(initial=0)).bit_length()):
            at = np.flatnonzero(rest >> bit & 1)
            out[at] = _lookup(self.high[bit], out[at])
        return out


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_SEPARATED).split()


def run_crcs(words: list[bytes], sizes: list[int], width: int, shifts: Shifts) -> tuple[np.ndarray, np.ndarray]:
    """(CRC, document) of every run of 1 to ``width`` words inside the documents of ``sizes`` words."""
    if not words:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    pieces = [words[0], *map(b" ".__add__, words[1:])]
    ends = np.fromiter(accumulate(pieces, lambda c, piece: crc32(piece, c), initial=0), np.uint32, len(words) + 1)[1:]
    long = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(long + 1) - 1
    begins = stops - long
    # The running value at a word's begin has one space more than that at the end before it.
    before = np.zeros(len(words), np.uint32)
    register = ~ends[:-1]
    before[1:] = ~(_STEP[(register ^ 0x20) & 255] ^ (register >> 8))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    crcs, owners = [], []
    for n in range(1, width + 1):
        first = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
        last = first + n - 1
        crcs.append(ends[last] ^ shifts(before[first], stops[last] - begins[first]))
        owners.append(owner[first])
    return np.concatenate(crcs), np.concatenate(owners)


def _scans(texts: list[str | None]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Words of stretches of whole texts, and how many each text has."""
    words: list[bytes] = []
    sizes: list[int] = []
    held = 0
    for text in texts:
        own = words_of(text)
        words += own
        sizes.append(len(own))
        held += len(text or "")
        if held >= SCAN_BYTES:
            yield words, sizes
            words, sizes, held = [], [], 0
    if sizes:
        yield words, sizes


def _bucketed(docs: DataFrame, id_col: str | None, text_col: str, width: int, buckets: int) -> DataFrame:
    """(id, n_words, buckets): the buckets of each row's features as unsigned numbers, little-endian."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    id_type = docs.schema[id_col].dataType if id_col else T.LongType()
    schema = T.StructType([T.StructField("id", id_type), T.StructField("tie", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shifts = Shifts()
        for b in batches:
            at = 0
            for words, sizes in _scans(b.column("text").to_pylist()):
                crcs, owner = run_crcs(words, sizes, width, shifts)
                order = np.argsort(owner, kind="stable")
                found = (crcs[order] % np.uint32(buckets)).astype(kind)
                parts = np.split(found, np.cumsum(np.bincount(owner, minlength=len(sizes)))[:-1])
                cols = [b.column("id").slice(at, len(sizes)), b.column("tie").slice(at, len(sizes)), pa.array(sizes, pa.int64()), pa.array([x.tobytes() for x in parts], pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, schema.names)
                at += len(sizes)

    text = F.col(text_col).cast("string")
    rows = docs.select((F.col(id_col) if id_col else F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    return rows.mapInArrow(of_batches, schema)


def bucket_counts(bucketed: DataFrame, buckets: int) -> list[int]:
    """How many features each bucket has: at most ``buckets`` rows leave a task, and as many reach the driver."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            for data in b.column("buckets").to_pylist():
                n += np.bincount(np.frombuffer(data, kind), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["bucket", "n"])

    out = [0] * buckets
    for row in bucketed.select("buckets").mapInArrow(of_batches, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Thousandths of the log ratio of target and corpus shares, each bucket counted once more."""
    k, s_all, t_all = len(corpus), sum(corpus), sum(target)
    return [math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k)))) for s, t in zip(corpus, target, strict=True)]


def noise(id_: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel variable that the id decides."""
    h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, width: int = WIDTH, buckets: int = BUCKETS, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``docs``; rows drawn have a rank, from 1.

    ``weight`` is the floored mean gain of a row's features (0 without any), ``score`` adds the noise of its id,
    and of the rows with ``min_words`` words ``percent`` in a hundred are drawn, highest scores first; ties go to
    the smaller id, null ids last, then to the text's hash. Null, empty and wordless texts have no feature and
    are never drawn unless ``min_words`` is 0. Repeated rows are drawn each for itself. ``target`` has the same
    text column. Both may be empty; other columns are left out.
    """
    marked = settled(_bucketed(docs, id_col, text_col, width, buckets))
    wanted = bucket_counts(_bucketed(target, None, text_col, width, buckets), buckets)
    gain = gains(bucket_counts(marked, buckets), wanted)
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    schema = T.StructType([marked.schema["id"], *T.StructType.fromDDL("tie long, n_words long, n_features long, weight long, score long").fields])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = np.array(gain, np.int64)
        for b in batches:
            found = [np.frombuffer(data, kind) for data in b.column("buckets").to_pylist()]
            weights = [int(each[x].sum()) // len(x) if len(x) else 0 for x in found]
            scores = [w + noise(i, seed) for w, i in zip(weights, b.column("id").to_pylist(), strict=True)]
            cols = [b.column("id"), b.column("tie"), b.column("n_words"), *(pa.array(x, pa.int64()) for x in ([len(x) for x in found], weights, scores))]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    rows = settled(marked.mapInArrow(of_batches, schema))
    able = rows.where(F.col("n_words") >= min_words)
    limit = percent * able.count() // 100
    able = able.withColumns({"low": -F.col("score"), "none": F.col("id").isNull()})
    ranked = dense_key(able, "low", "rank", ["none", "id", "tie"], keys_per_bucket=ROWS_PER_BUCKET, key_type="bigint")
    drawn = F.when(F.col("rank") <= limit, F.col("rank"))
    out = ["id", "n_features", "weight", "score"]
    found = ranked.select(*out, drawn.alias("rank")).unionByName(rows.where(F.col("n_words") < min_words).select(*out, F.lit(None).cast("long").alias("rank")))
    return found.withColumnRenamed("id", id_col)


def op13(spark, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 in SQL: its table by eight shifts of each byte value, and one look-up for each byte of a string.
CRC_SQL = """
bits AS (SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r FROM (SELECT unnest(range(256)) AS b)),
steps AS (SELECT list(r ORDER BY b) AS step FROM bits)
"""


def crc_sql(text: str) -> str:
    """The CRC-32 of a SQL string; ``step`` of ``CRC_SQL`` must be in scope."""
    digits = f"hex(encode({text}))"
    byte = f"('0x' || substr({digits}, 2 * i + 1, 2))::BIGINT"
    return f"xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode({text}))), lambda i: {byte})), lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295)"


OP13_SQL = rf"""
WITH {CRC_SQL.strip()},
words AS (SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM (SELECT 's' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark)),
runs AS (SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words),
named AS (SELECT f, {crc_sql("f")} % {BUCKETS} AS bucket FROM (SELECT DISTINCT f FROM runs), steps),
features AS (SELECT kind, id, bucket FROM runs JOIN named USING (f)),
counts AS (SELECT bucket, count_if(kind = 's') AS s, count_if(kind = 't') AS t FROM features GROUP BY bucket),
totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + {BUCKETS}) / ((s + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS g FROM counts, totals),
weights AS (SELECT id, count(*) AS n, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM features JOIN gain USING (bucket) WHERE kind = 's' GROUP BY id),
scored AS (SELECT id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM words LEFT JOIN weights USING (id) WHERE kind = 's'),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, id) AS k, {PERCENT} * count(*) OVER (PARTITION BY n_words >= {MIN_WORDS}) // 100 AS most FROM scored)
SELECT id AS doc_id, n_features, weight, score, (CASE WHEN n_words >= {MIN_WORDS} AND k <= most THEN k END)::BIGINT AS rank FROM ranked
"""
