"""Secret scans: fixed patterns, and strings whose characters are too evenly mixed to be words.

For every character class, candidate strings are maximal runs of its characters. A window slides over each
candidate; moving it by one character changes two counts, and the Shannon entropy of the window changes by
table values of the old and the new counts, kept as integers. A class's threshold lies ``MARGIN`` bits below the
mean entropy of random windows of its alphabet. A candidate with a window at or above it holds a span, from the
start of the first such window to the end of the last, unless the allow-list knows the candidate or that part
of it, or another span covers it that begins earlier, is longer or of a kind listed before.

Positions come from running sums, formed in as many rounds as the logarithm of their number, so a text with
ten thousand spans takes ten times as long as one with a thousand.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import free_name, table
from orrery.llm.quality import let

#: Fixed patterns in the order in which their kinds are listed; least length of the checked group; that group.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 1),
    "access": (r"AKIA[A-Z0-9]{16,}", 20, 0),
    "hex": (r"[0-9a-f]{24,}", 24, 0),
}
WINDOW = 16
MARGIN = 0.4


def expected_bits(letters: int, window: int) -> float:
    """Mean entropy of ``window`` random characters of an alphabet."""
    of_count = lambda c: math.comb(window, c) * letters**-c * (1 - 1 / letters) ** (window - c) * c * math.log2(c)
    return math.log2(window) - letters / window * sum(of_count(c) for c in range(2, window + 1))


def _class(alphabet: str, pattern: str, letters: int | None = None) -> tuple[str, str, int, float]:
    return alphabet, pattern, WINDOW, round(expected_bits(letters or len(alphabet), WINDOW) - MARGIN, 4)


_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Character classes: alphabet, its pattern, window, threshold in bits. Keys in hexadecimal digits use 16 letters in
#: one case, those in capitals 32 (base 32).
CLASSES = {
    "entropy_hex": _class(_DIGITS + "abcdefABCDEF", "[0-9a-fA-F]", 16),
    "entropy_lower": _class(_LOWER + _DIGITS, "[a-z0-9]"),
    "entropy_upper": _class(_UPPER + _DIGITS, "[A-Z0-9]", 32),
    "entropy_base64": _class(_UPPER + _LOWER + _DIGITS + "+/_-", "[A-Za-z0-9+/_-]", 64),
}
#: Candidates, or evenly mixed parts of them, that match one of these as a whole are not secrets: UUIDs; words, paths and
#: slugs, capitalised or not, with a short number; words in capitals; numbers; placeholders with little around them.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"([A-Z][a-z]|[a-z/_+-])+[0-9]{0,4}/?",
    r"[A-Z/_+-]+[0-9]{0,4}",
    r"[0-9/_+-]+",
    r"(?i)[a-z0-9_-]{0,16}(example|placeholder|changeme|xxxxxx)[a-z0-9_-]{0,16}",
)
_UNIT = 1 << 20
#: Characters of a block of text that is cut on its own.
_BLOCK = 1024


def _running(values: Column, merge) -> Column:
    """Running totals of an array under ``merge``, in about log2 of its size rounds."""
    rounds = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda j: F.pow(F.lit(2), j) < F.size(values))

    def doubled(acc: Column, j: Column) -> Column:
        back = F.pow(F.lit(2), j).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= back, merge(F.get(acc, i - back), x)).otherwise(x))

    return F.aggregate(rounds, values, doubled)


def _spans(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<s, e, v>> of leftmost matches whose group has ``least`` characters; code points, v the match.

    Splitting at a pattern leaves the text between its matches, so running sums of lengths give positions.
    """
    hit = F.lit(pattern)

    def placed(m: Column) -> Column:
        steps = F.transform(m["all"], lambda x, i: F.length(F.get(m["gaps"], i)) + F.length(x))
        ends = _running(steps, lambda a, b: a + b)
        found = F.transform(ends, lambda e, i: F.struct((e - F.length(F.get(m["all"], i))).alias("s"), e.alias("e"), F.get(m["all"], i).alias("v"), F.get(m["group"], i).alias("g")))
        return F.transform(F.filter(found, lambda x: F.length(x["g"]) >= least), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v")))

    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, hit, F.lit(0)).alias("all"), F.regexp_extract_all(text, hit, F.lit(group)).alias("group"))
    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(F.array().cast("array<struct<s:int,e:int,v:string>>"))


def _weights(window: int) -> list[int]:
    return [0] + [round(_UNIT * c * math.log2(c)) for c in range(1, window + 1)]


def even_stretch(candidate: Column, window: int, bits: float) -> Column:
    """struct<s, e> of the stretch from the first to the last window with at least ``bits`` of entropy; null without one."""
    table_ = F.array(*[F.lit(x) for x in _weights(window)])
    most = math.floor(_UNIT * window * (math.log2(window) - bits))

    def scanned(codes: Column) -> Column:
        zero = F.struct(F.array_repeat(F.lit(0), F.array_max(codes) + 1).alias("counts"), F.lit(0).alias("sum"), F.lit(-1).alias("first"), F.lit(-1).alias("last"))

        def move(acc: Column, i: Column) -> Column:
            new, old = F.get(codes, i), F.coalesce(F.get(codes, i - window), F.lit(-1))
            weight = lambda c: F.get(table_, c)
            gone = F.when(old < 0, F.lit(0)).otherwise(weight(F.get(acc["counts"], old) - 1) - weight(F.get(acc["counts"], old)))
            after = F.get(acc["counts"], new) - F.when(old == new, 1).otherwise(0)
            total = acc["sum"] + gone + weight(after + 1) - weight(after)
            counts = F.when(old == new, acc["counts"]).otherwise(F.transform(acc["counts"], lambda c, k: c + F.when(k == new, 1).when(k == old, -1).otherwise(0)))
            full = (i >= window - 1) & (total <= most)
            return F.struct(counts.alias("counts"), total.alias("sum"), F.when(full & (acc["first"] < 0), i - window + 1).otherwise(acc["first"]).alias("first"), F.when(full, i + 1).otherwise(acc["last"]).alias("last"))

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, move, lambda acc: F.when(acc["first"] >= 0, F.struct(acc["first"].alias("s"), acc["last"].alias("e"))))

    # A window of n different characters has log2(n) bits at most, so fewer than 2**bits rule a candidate out.
    def of(m: Column) -> Column:
        codes = F.transform(m["chars"], lambda x: F.array_position(m["letters"], x).cast("int") - 1)
        return F.when(F.size(m["letters"]) >= math.ceil(2**bits - 1e-9), let(codes, scanned))

    return let(F.split(candidate, ""), lambda c: let(F.struct(c.alias("chars"), F.array_distinct(c).alias("letters")), of))


def _with_kind(spans: Column, kind: str) -> Column:
    rank = [*BASE, *CLASSES].index(kind)
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(rank).alias("rank"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["v"].alias("v")))


def _candidates(text: Column, kind: str, known: str | None) -> Column:
    """Maximal runs of a class's characters that hold a window, other than those that the allow-list knows."""
    _, pattern, window, _ = CLASSES[kind]
    found = _spans(text, f"{pattern}{{{window},}}", 0, window)
    return _with_kind(F.filter(found, lambda x: ~x["v"].rlike(known)) if known else found, kind)


def _in_order(spans: Column) -> Column:
    """Spans by start, longer ones first: one is covered if some span before it ends with it or later."""
    return F.sort_array(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("back"), x["rank"].alias("rank"), x.alias("x"))))


def _uncovered(spans: Column, by_base_only: bool) -> Column:
    """Base spans, and the others that none before them in order (or no base span) covers."""

    def of(a: Column) -> Column:
        counted = lambda x: F.when(x["rank"] < len(BASE), -x["back"]).otherwise(F.lit(-1)) if by_base_only else -x["back"]
        ends = _running(F.transform(a, counted), F.greatest)
        free = lambda e: F.filter(a, lambda x, i: (x["rank"] < len(BASE)) | (i == 0) | (-x["back"] > F.get(e, i - 1)))
        return F.transform(let(ends, free), lambda x: x["x"])

    return let(_in_order(spans), of)


def _even_part(x: Column, known: str | None) -> Column:
    """A base span as it is; the evenly mixed part of a candidate, null if there is none or the allow-list knows it."""
    ranks = list(enumerate(CLASSES.values(), len(BASE)))
    stretch = F.when(x["rank"] == ranks[0][0], even_stretch(x["v"], *ranks[0][1][2:]))
    for rank, (_, _, window, bits) in ranks[1:]:
        stretch = stretch.when(x["rank"] == rank, even_stretch(x["v"], window, bits))

    def part(h: Column) -> Column:
        v = F.substring(x["v"], h["s"] + 1, h["e"] - h["s"])
        found = F.struct((x["s"] + h["s"]).alias("s"), x["rank"].alias("rank"), (x["s"] + h["e"]).alias("e"), x["kind"].alias("kind"), v.alias("v"))
        return F.when(h.isNotNull() & (~v.rlike(known) if known else F.lit(True)), found)

    return F.when(x["rank"] < len(BASE), x).otherwise(let(stretch, part))


def scanned(docs: DataFrame, text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with ``base`` and ``spans``, arrays of (s, rank, e, kind, v) by start, then kind as listed.

    s and e are code points of the whole text, e exclusive; v is the matched string. ``spans`` holds the base
    spans and those of the entropy method. Null and empty texts have none. Rows and other columns stay as
    they are; if a name is taken, the new column gets an underscore.
    """
    base, spans = free_name(docs, "base"), free_name(docs, "spans")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    known = "^(?:" + "|".join(f"(?:{a})" for a in allowed) + ")$" if allowed else None
    fixed = [_with_kind(_spans(text, p, g, n), kind) for kind, (p, n, g) in BASE.items()]
    # What a base span covers needs no window.
    free = _uncovered(F.concat(*fixed, *[_candidates(text, kind, known) for kind in CLASSES]), True)
    parts = F.array_compact(F.transform(free, lambda x: _even_part(x, known)))

    def joined(a: Column) -> Column:
        return F.struct(F.filter(a, lambda x: x["rank"] < len(BASE)).alias("base"), a.alias("spans"))

    both = free_name(docs, "both")
    found = docs.withColumn(both, let(F.sort_array(let(parts, lambda a: _uncovered(a, False))), joined))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{both}.base").alias(base), F.col(f"{both}.spans").alias(spans))


def written(spans: Column) -> Column:
    """kind:start:end, joined with commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def masked(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", allowed: tuple[str, ...] = ALLOWED, count_col: str | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark``; overlapping spans by one.

    All rows and columns stay. ``count_col``, if given, becomes the new length of a text that changed.
    """
    found = scanned(docs, text_col, allowed)
    spans = F.col(f"`{free_name(docs, 'spans')}`")
    text = F.col(f"`{text_col}`")

    size = F.length(text)

    def piece(blocks: Column, a: Column, n: Column) -> Column:
        """n characters from position a; looks at the blocks that hold them only."""
        first = F.floor(a / _BLOCK).cast("int")
        held = F.slice(blocks, first + 1, F.floor((a + n - 1) / _BLOCK).cast("int") - first + 1)
        return F.when(n > 0, F.substring(F.array_join(held, ""), a - first * _BLOCK + 1, n)).otherwise(F.lit(""))

    def cut(m: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(m["ends"], i - 1)).otherwise(F.lit(0))
        # Nothing is written for a span that begins inside those before it.
        parts = F.transform(m["spans"], lambda x, i: F.when((i == 0) | (x["s"] >= before(i)), F.concat(piece(m["blocks"], before(i), x["s"] - before(i)), F.lit(mark))).otherwise(F.lit("")))
        last = F.element_at(m["ends"], -1)
        return F.concat(F.array_join(parts, ""), piece(m["blocks"], last, size - last))

    ends = _running(F.transform(spans, lambda x: x["e"]), F.greatest)
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    new = F.when(F.size(spans) > 0, let(F.struct(spans.alias("spans"), ends.alias("ends"), blocks.alias("blocks")), cut)).otherwise(text)
    out = found.withColumn(text_col, new)
    if count_col:
        out = out.withColumn(count_col, F.when(F.size(spans) > 0, F.length(text).cast(docs.schema[count_col].dataType)).otherwise(F.col(f"`{count_col}`")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3(spark, sf_dir: str) -> DataFrame:
    found = scanned(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in BASE], F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def _op3_sql() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"

    def found(pattern: str, group: int, least: int) -> str:
        p = quoted(pattern)
        return f"""
  SELECT rid, list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[: i - 1], lambda x: length(x))), 0) AS s, hits[i] AS v
  FROM (SELECT rid, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}) AS hits, regexp_extract_all(t, {p}, {group}) AS checked, unnest(range(1, len(regexp_extract_all(t, {p})) + 1)) AS i FROM d)
  WHERE length(checked[i]) >= {least}"""

    base = " UNION ALL ".join(f"SELECT rid, s, {k} AS rank, s + length(v) AS e, '{kind}' AS kind FROM ({found(p, g, n)})" for k, (kind, (p, n, g)) in enumerate(BASE.items()))
    known = quoted("|".join(f"(?:{a})" for a in ALLOWED))
    more = []
    for k, (kind, (_, one, window, bits)) in enumerate(CLASSES.items(), len(BASE)):
        hits = f"list_filter(range(1, length(v) - {window} + 2), lambda i: list_entropy(string_split(substr(v, i, {window}), '')) >= {bits} - 1e-5)"
        more.append(f"SELECT rid, s + h[1] - 1 AS s, {k} AS rank, s + h[-1] + {window - 1} AS e, '{kind}' AS kind FROM (SELECT rid, s, {hits} AS h FROM ({found(f'{one}{{{window},}}', 0, window)}) c WHERE NOT regexp_full_match(v, {known}) AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = c.rid AND b.s <= c.s AND b.e >= c.s + length(c.v))) WHERE len(h) > 0 AND NOT regexp_full_match(substr(v, h[1], h[-1] + {window} - h[1]), {known})")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
base AS ({base}), mixed AS ({' UNION ALL '.join(more)}),
every AS (SELECT *, max(e) OVER (PARTITION BY rid ORDER BY s, e DESC, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT * FROM base UNION ALL SELECT * FROM mixed)),
spans AS (SELECT * FROM every WHERE rank < {len(BASE)} OR before IS NULL OR e > before),
b AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS joined FROM base GROUP BY rid),
a AS (SELECT rid, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) AS joined FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b.joined, '')) AS base_sha256, coalesce(a.joined, '') AS spans
FROM d LEFT JOIN b USING (rid) LEFT JOIN a USING (rid)
"""


OP3_SQL = _op3_sql()
