"""Secrets in texts, found and linked with built-in functions only.

Three kinds stand for themselves: ``assign`` (a value given to a password-like name), ``access`` (an access key id)
and ``hex`` (a long lower-case hexadecimal run). Parts that prove nothing alone are reported only beside what they
belong to: the candidates of a text are interval-joined, each finding its neighbours by halving in the others' sorted
places, and a pair is linked when at most ``SCOPE`` characters lie between its spans.

* ``identifier``, an upper-case identifier with a digit, and ``key``, a mixed run of 32 to 128 characters, need each
  other or the strong part they lack: an identifier needs a key, an assigned or a hexadecimal secret; a key needs an
  identifier, an access key id or an endpoint.
* ``endpoint``, an address, needs both an identifier or access key id and a secret or key. Those may stand inside the
  address itself, as in ``scheme://ID:KEY@host`` or ``?id=ID&key=KEY``, if they are not the same text.

A weak part does not start inside a run, but may follow the ``=`` of a name: padding only ends a run.

Offsets are code points, the end is exclusive. No row leaves its task: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.csvtext import let
from .store import free_name, require

SCOPE = 200
MASK = "[REDACTED]"
BITS = 8
PIECE = 1 << BITS

# The patterns of the base kinds, the group that is measured, and its least length.
BASE = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    # A run is matched whole from its start, so asking for its least length at once finds the same spans.
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
WEAK = {
    "identifier": (r"(?:(?<![A-Za-z0-9+/_-])|(?<=://))(?=[A-Z]*[0-9])[A-Z][A-Z0-9]{15,31}(?![A-Za-z0-9+/=_-])", 0, 16),
    "key": (r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])"
            r"[A-Za-z0-9+/_-]{32,128}={0,2}(?![A-Za-z0-9+/=_-])", 0, 32),
    "endpoint": (r"(?<![A-Za-z0-9])(?:https?|ftp|jdbc|amqp|redis|mongodb|postgres(?:ql)?|mysql|s3)://[^\s\"'<>]{4,}", 0, 4),
}
KINDS = [*BASE, *WEAK]
SPAN = "array<struct<start: int, rank: int, end: int>>"


def _running(values: Column, join) -> Column:
    """Running sums or maxima of an array, worked out in blocks of about the root of its size.

    Arrays can only be added to by copying them, so one pass over many values would take the square of their number.
    """
    def grown(done: Column, x: Column) -> Column:
        now = join(done["last"], x)
        return F.struct(now.alias("last"), F.concat(done["all"], F.array(now)).alias("all"))

    def plain(part: Column) -> Column:
        return F.aggregate(part, F.struct(F.lit(0).alias("last"), F.array().cast("array<int>").alias("all")), grown, lambda done: done["all"])

    def whole(values: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(values).cast("double"))), F.lit(1)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / width).cast("int") - 1), lambda k: plain(F.slice(values, k * width + 1, width)))
        return let(blocks, lambda blocks: let(plain(F.transform(blocks, lambda block: F.element_at(block, -1))), lambda upto: F.flatten(
            F.transform(blocks, lambda block, k: F.transform(block, lambda x: F.when(k == 0, x).otherwise(join(F.get(upto, k - 1), x)))))))

    return F.when(F.size(values) > 0, let(values, whole)).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, kind: str) -> Column:
    """Spans of all matches of a kind, left to right: matches and the pieces between them, summed up by length."""
    pattern, group, least = {**BASE, **WEAK}[kind]
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
                          F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    sizes = F.transform(F.filter(zipped, lambda x: x["whole"].isNotNull()), lambda x: F.struct(
        (F.length(x["gap"]) + F.length(x["whole"])).alias("step"), F.length(x["whole"]).alias("whole"), F.length(x["part"]).alias("part")))

    def placed(sizes: Column) -> Column:
        ends = _running(F.transform(sizes, lambda x: x["step"]), lambda a, x: a + x)
        spans = F.zip_with(sizes, ends, lambda x, end: F.when(x["part"] >= least, F.struct(
            (end - x["whole"]).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"))))
        return F.filter(spans, lambda s: s.isNotNull())

    return F.when(text.rlike(pattern), let(sizes, placed).cast(SPAN)).otherwise(F.array().cast(SPAN))


def _below(ordered: Column, value: Column) -> Column:
    """How many numbers of an ordered array are below a value, by halving."""
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(ordered) + F.lit(1.0))).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(ordered).alias("high"))

    def halved(done: Column, _: Column) -> Column:
        middle = F.shiftright(done["low"] + done["high"], 1)
        less = F.get(ordered, middle) < value
        narrow = F.struct(F.when(less, middle + 1).otherwise(done["low"]).alias("low"), F.when(less, done["high"]).otherwise(middle).alias("high"))
        return F.when(done["low"] < done["high"], narrow).otherwise(done)

    return F.when(F.size(ordered) > 0, F.aggregate(steps, start, halved, lambda done: done["low"])).otherwise(0)


def _table(spans: Column) -> Column:
    """Spans by start and by end, and those starts and ends alone, so that neighbours are found by halving."""
    by_end = F.array_sort(F.transform(spans, lambda s: F.struct(s["end"], s["start"])))
    return let(F.struct(F.array_sort(spans).alias("by_start"), by_end.alias("by_end")), lambda t: F.struct(
        t["by_start"].alias("by_start"), t["by_end"].alias("by_end"), F.transform(t["by_start"], lambda s: s["start"]).alias("starts"),
        F.transform(t["by_end"], lambda s: s["end"]).alias("ends")))


def _near(span: Column, table: Column) -> Column:
    """Whether a span of a table ends or starts within the scope of a span without overlapping it."""
    def some(ordered: Column, low: Column, high: Column) -> Column:
        return F.coalesce(let(_below(ordered, low), lambda k: F.get(ordered, k) <= high), F.lit(False))

    return some(table["ends"], span["start"] - SCOPE, span["start"]) | some(table["starts"], span["end"], span["end"] + SCOPE)


def _scope(span: Column, table: Column) -> Column:
    """Least end and greatest start of the spans of a table that are inside a span or near it; null without any."""
    def some(rows: Column, ordered: Column, low: Column, high: Column) -> Column:
        return let(_below(ordered, low), lambda k: F.slice(rows, k + 1, F.greatest(_below(ordered, high + 1) - k, F.lit(0))))

    before = F.transform(some(table["by_end"], table["ends"], span["start"] - SCOPE, span["start"]), lambda o: F.struct(o["start"], o["end"]))
    later = F.filter(some(table["by_start"], table["starts"], span["start"], span["end"] + SCOPE),
                     lambda o: (o["end"] <= span["end"]) | (o["start"] >= span["end"]))
    both = F.concat(before, F.transform(later, lambda o: F.struct(o["start"], o["end"])))
    return let(both, lambda both: F.struct(F.array_min(F.transform(both, lambda o: o["end"])).alias("end"),
                                           F.array_max(F.transform(both, lambda o: o["start"])).alias("start")))


def _complete(span: Column, who: Column, what: Column) -> Column:
    """Whether both parts of an endpoint are in its scope; where one is inside it, they must not be the same text."""
    # Two spans that do not overlap are there if the least end is not behind the greatest start.
    apart = let(F.struct(_scope(span, who).alias("who"), _scope(span, what).alias("what")), lambda s: (
        (s["who"]["end"] <= s["what"]["start"]) | (s["what"]["end"] <= s["who"]["start"])))
    return (_near(span, who) & _near(span, what)) | F.coalesce(apart, F.lit(False))


def _linked(found: Column) -> Column:
    """Weak spans that have their other parts in scope."""
    of = {k: found[k] for k in KINDS}
    who = F.concat(of["access"], of["identifier"])
    what = F.concat(of["assign"], of["hex"], of["key"])
    tables = F.struct(_table(who).alias("who"), _table(what).alias("what"), _table(F.concat(who, of["endpoint"])).alias("partner"))
    weak = let(tables, lambda t: F.concat(F.filter(of["identifier"], lambda span: _near(span, t["what"])),
                                          F.filter(of["key"], lambda span: _near(span, t["partner"])),
                                          F.filter(of["endpoint"], lambda span: _complete(span, t["who"], t["what"]))))
    return F.when(F.size(of["identifier"]) + F.size(of["key"]) + F.size(of["endpoint"]) > 0, weak).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """All rows and columns of a table, and a struct ``base, spans`` of the spans in each whole text.

    ``base`` has the spans of the kinds that stand for themselves, ``spans`` those and the linked ones; each span is
    ``start, rank, end`` with the kind's place in ``KINDS``, ordered by start, then kind. Null and empty texts have
    none; rows are worked on alone, so repeated rows and rows without id are nothing special. A column named ``out``
    is replaced.
    """
    require(docs, text)
    found, body = free_name(docs, "_found"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    parts = docs.withColumn(found, F.struct(*[_spans(body, k).alias(k) for k in KINDS]))
    base = F.array_sort(F.concat(*[F.col(found)[k] for k in BASE]))
    every = F.array_sort(F.concat(*[F.col(found)[k] for k in BASE], _linked(F.col(found))))
    return parts.withColumn(out, F.struct(base.alias("base"), every.alias("spans"))).drop(found)


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _cut(pieces: Column, low: Column, high: Column) -> Column:
    """Characters of a text from one place to another, from its pieces of ``PIECE`` characters.

    Characters of a text are counted from its beginning; in a short piece that takes no time.
    """
    first, last = F.shiftright(low, BITS), F.shiftright(high - 1, BITS)
    skipped, size = low.bitwiseAND(F.lit(PIECE - 1)), high - low
    ends = F.substring(F.get(pieces, last), F.lit(1), (high - 1).bitwiseAND(F.lit(PIECE - 1)) + 1)
    several = F.concat(F.substring(F.get(pieces, first), skipped + 1, F.lit(PIECE)),
                       F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), ends)
    return F.when(size <= 0, F.lit("")).when(first == last, F.substring(F.get(pieces, first), skipped + 1, size)).otherwise(several)


def redacted(text: Column, spans: Column) -> Column:
    """The text with a mask in place of every run of spans; a text without spans, or null, as it is."""
    def masked(t: Column) -> Column:
        reach = _running(F.transform(t["spans"], lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        return let(F.struct(reach.alias("reach"), t["spans"].alias("spans"), t["pieces"].alias("pieces")), lambda t: F.concat(F.array_join(F.transform(
            t["spans"], lambda s, k: let(F.when(k == 0, 0).otherwise(F.get(t["reach"], k - 1)), lambda before: F.when(
                (k == 0) | (s["start"] > before), F.concat(_cut(t["pieces"], before, s["start"]), F.lit(MASK))).otherwise(F.lit("")))), ""),
            _cut(t["pieces"], F.element_at(t["reach"], -1), F.length(text))))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.size(spans) > 0, let(F.struct(pieces.alias("pieces"), spans.alias("spans")), masked)).otherwise(text)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows with every found span masked in the text; nothing else changes."""
    out = free_name(docs, "_secrets")
    return scan(docs, text, out).withColumn(text, redacted(F.col(f"`{text}`"), F.col(out)["spans"])).drop(out)
