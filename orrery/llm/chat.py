"""Chat formatting whose grammar can be read back exactly.

A turn is written as  OPEN role SEP text CLOSE . A deterministic parser reads it back: it expects OPEN,
takes the role up to SEP and the text up to CLOSE. A text that contains a control string is in conflict with
the grammar. Each turn is first written as it is and parsed; if the parser recovers other text, the control
strings are escaped, and the turn is parsed again until both agree.

Escaping puts one backslash before a control string and doubles the backslashes that stand before a control
string or the end of the text. A control string after an odd number of backslashes is text, after an even
number it is structure.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import table

OPEN, SEP, CLOSE = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that other chat templates use; escaped as well, so that no reader takes them for structure.
FOREIGN = ("[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<s>", "</s>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
CONTROLS = (OPEN, SEP, CLOSE, *FOREIGN)
TRAINED_ROLES = ("assistant",)
_CONTROL = "|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True)))
# A run of backslashes is looked at from its start only, which keeps long runs linear.
_ESCAPABLE = re.compile(rf"(?<!\\)(\\*+)({_CONTROL}|\Z)")
_TOKEN = re.compile(rf"(?<!\\)(\\*+)({_CONTROL})")


def escape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: m[1] * 2 + ("\\" + m[2] if m[2] else ""), text)


def unescape(text: str) -> str:
    return _ESCAPABLE.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


class Grammar:
    """Reads turns from a string; raises ValueError where the string is not of the grammar."""

    def __init__(self, text: str):
        self.text, self.at = text, 0

    def _expect(self, control: str) -> None:
        if not self.text.startswith(control, self.at):
            raise ValueError(f"{control} expected at {self.at}")
        self.at += len(control)

    def _upto(self, control: str) -> tuple[str, int, int]:
        """The unescaped field before ``control``, and its limits; other structure inside is an error."""
        start = at = self.at
        while m := _TOKEN.search(self.text, at):
            if len(m[1]) % 2 == 0:
                if m[2] != control:
                    raise ValueError(f"{m[2]} inside a field at {m.start(2)}")
                self.at = m.end()
                return unescape(self.text[start : m.start(2)]), start, m.start(2)
            at = m.end()
        raise ValueError(f"{control} missing after {start}")

    def turns(self) -> Iterator[tuple[str, str, int, int]]:
        """(role, text, start, end) of each turn; start and end of the written text."""
        while self.at < len(self.text):
            self._expect(OPEN)
            role, _, _ = self._upto(SEP)
            text, start, end = self._upto(CLOSE)
            yield role, text, start, end


def render(role: str, text: str) -> str:
    """A turn that parses back to exactly ``role`` and ``text``; escaped only where that is needed."""
    for r, t in ((role, text), (role, escape(text)), (escape(role), escape(text))):
        written = f"{OPEN}{r}{SEP}{t}{CLOSE}"
        try:
            if [x[:2] for x in Grammar(written).turns()] == [(role, text)]:
                return written
        except ValueError:
            pass
    raise ValueError("a turn could not be written reversibly")


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, piece): the written turns; joined in order of turn (then piece) they are the training text.

    Null roles and texts are empty. Rows with a null conv_id form one conversation, null turns come first,
    repeated rows are turns of their own. Roles may be any string. An empty table gives an empty result,
    other columns are left out. Writing a turn needs no other row, so nothing is grouped here.
    """
    schema = conversations.select("conv_id", "turn").schema.add("piece", "string")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            role, text = (b.column(c).to_pylist() for c in ("role", "text"))
            pieces = [render(r or "", t or "") for r, t in zip(role, text, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), b.column("turn"), pa.array(pieces, pa.string())], ["conv_id", "turn", "piece"])

    return conversations.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string")).mapInArrow(of_batches, schema)


def _ordered(pieces: DataFrame) -> DataFrame:
    # The order within a turn number is that of role and text, which the piece begins with.
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece")


class _Digest:
    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, piece: str) -> None:
        self.chars += len(piece)
        for role, text, _, _ in Grammar(piece).turns():
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role in TRAINED_ROLES:
                self.loss_chars += len(text)
                self.loss.update(text.encode())


def read_back(pieces: DataFrame) -> DataFrame:
    """One row per conversation, from the written turns alone: counts and digests of turns and of text under the loss mask.

    Rows of a conversation come sorted and are digested as they stream by, so a conversation of any length
    needs the memory of one turn.
    """
    schema = pieces.select("conv_id").schema
    for name, kind in (("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"), ("formatted_chars", "long")):
        schema = schema.add(name, kind)
    names = schema.names

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        key, now, kind = None, None, None

        def close() -> None:
            done.append((key, now.turns, now.all.hexdigest(), now.loss_chars, now.loss.hexdigest(), now.chars))

        def out() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            done.clear()
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        for b in batches:
            kind = b.schema.field("conv_id").type
            for conv, piece in zip(b.column("conv_id").to_pylist(), b.column("piece").to_pylist(), strict=True):
                if now is None or conv != key:
                    if now is not None:
                        close()
                    key, now = conv, _Digest()
                now.add(piece)
            if done:
                yield out()
        if now is not None:
            close()
            yield out()

    return _ordered(pieces).mapInArrow(of_batches, schema)


def training_text(pieces: DataFrame) -> DataFrame:
    """(conv_id, text, loss_spans): whole conversations as single strings, for those who need them so.

    loss_spans are (start, end) of the written assistant texts, in code points. A conversation must fit in memory.
    """
    rows = pieces.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "piece"))).alias("p"))
    texts = rows.select("conv_id", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text"))

    @F.udf("array<struct<start:int,end:int>>")
    def spans(text):
        return [(s, e) for role, _, s, e in Grammar(text).turns() if role in TRAINED_ROLES]

    return texts.withColumn("loss_spans", spans("text"))


#: A conversation whose texts are control strings themselves.
PLANTED = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame(PLANTED, turns.schema)
    return read_back(formatted(turns.unionByName(planted)))


_RE = "|".join(re.sub(r"([\[\]|])", r"\\\1", c) for c in sorted(CONTROLS, key=len, reverse=True))
#: The written length: a text in conflict grows by its escapes. That is one with a control string, or with an odd number of backslashes at its end, or an even one.
OP8_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
  SELECT *, regexp_replace(regexp_replace(text, '(\\*)({_RE})', '\1\1\\\2', 'g'), '(\\+)$', '\1\1') AS written FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(length(role) + length(written) + {len(OPEN) + len(SEP) + len(CLOSE)})::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
