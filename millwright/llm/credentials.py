"""Secret scan with multipart credential linking, in DataFrame functions only.

Three base kinds are always reported. Further parts of credentials (account names, endpoints, bare key-like
tokens) are weak: by themselves they are ordinary text. An interval join links parts of one text whose scopes
overlap, and a weak part is reported only when a complementary part stands in its scope: a name or endpoint
needs a secret, a bare token needs a name, an access key or an endpoint.

Positions come from splitting: a text is the pieces between the matches and the matches in turn, so running
sums of their lengths in code points give each match's place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import ROW, with_row_id
from millwright.session import written

SCOPE = 200  # code points around a part in which its complement is sought

# The base patterns; ASCII letters only, whatever the case.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

# The same matches of access and hex without the runs that are too short: a run is one match in either form.
_ACCESS_LONG = r"AKIA[A-Z0-9]{16,}"
_HEX_LONG = r"(?<![0-9a-f])[0-9a-f]{24,}"

NAME = r"""(?i:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
ENDPOINT = r"""(?i:https?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[A-Za-z0-9_.:/@?=&%-]{4,}"""
BARE = r"[A-Za-z0-9+/_=-]{32,}"
_BARE_HAS = ("[0-9]", "[a-z]", "[A-Z]")

KINDS = ("assign", "access", "hex", "name", "endpoint", "bare")
BASE = KINDS[:3]
PATTERNS = {"assign": ASSIGN, "access": _ACCESS_LONG, "hex": _HEX_LONG, "name": NAME, "endpoint": ENDPOINT, "bare": BARE}
ROLES = {"assign": "secret", "hex": "secret", "bare": "secret", "access": "identifier", "name": "identifier", "endpoint": "endpoint"}
# A weak kind and the roles that confirm it; a bare token does not confirm another weak kind by itself.
CONFIRMED_BY = {"name": ("assign", "hex", "access"), "endpoint": ("assign", "hex", "access"), "bare": ("access", "name", "endpoint")}

_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _spans(text: Column, kind: str) -> Column:
    """The matches of a kind as structs (start, number of the kind, end), ends exclusive."""
    pattern = F.lit(PATTERNS[kind])
    between = F.split(text, PATTERNS[kind], -1)
    parts = F.arrays_zip(between.alias("gap"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("hit"))
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(seen: Column, part: Column) -> Column:
        start = (seen["at"] + F.length(part["gap"])).cast("bigint")
        end = (start + F.length(part["hit"])).cast("bigint")
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.alias("end"))
        kept = F.lit(True)
        if kind == "assign":
            kept = F.length(F.regexp_extract(part["hit"], ASSIGN, 2)) >= LEAST["assign"]
        elif kind in LEAST:
            kept = F.length(part["hit"]) >= LEAST[kind]
        elif kind == "bare":
            for has in _BARE_HAS:
                kept &= part["hit"].rlike(has)
        # the last piece has no match behind it
        out = F.when(part["hit"].isNull() | ~kept, seen["out"]).otherwise(F.concat(seen["out"], F.array(span)))
        return F.struct(F.coalesce(end, start).alias("at"), out.alias("out"))

    found = F.aggregate(parts, zero, step, lambda seen: seen["out"])
    return F.when(text.rlike(PATTERNS[kind]), found).otherwise(F.array().cast(_SPAN))


def parts(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``base`` and ``weak`` spans per row, each sorted by start and kind; null texts are empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(*keys, text.alias("text"))
    base = F.array_sort(F.concat(*(_spans(F.col("text"), k) for k in BASE)))
    weak = F.array_sort(F.concat(*(_spans(F.col("text"), k) for k in KINDS[len(BASE) :])))
    return found.select(*keys, base.alias("base"), weak.alias("weak"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per ROW the confirmed weak spans of a frame of :func:`parts`: an interval join within each row.

    Each weak part asks in every stretch of ``scope`` code points that its scope touches, from the last code point
    of a part that ends where the scope begins; parts with the same
    stretch of the same row meet, and the exact distance decides. Parts that overlap are within scope; a part
    that lies wholly inside another doesn't confirm it, being part of the same text.
    """
    each = found.where(F.size("weak") > 0).select(ROW, F.explode(F.concat("base", "weak")).alias("s")).select(ROW, "s.*")
    stretch = lambda c: F.floor(c / scope).cast("bigint")
    asking = each.where(F.col("kind") >= len(BASE)).withColumn(
        "at", F.explode(F.sequence(stretch(F.greatest(F.lit(0), F.col("start") - scope - 1)), stretch(F.col("end") + scope)))
    )
    here = each.withColumn("at", F.explode(F.sequence(stretch(F.col("start")), stretch(F.col("end") - 1))))
    here = here.groupBy(ROW, "at", "kind").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("there"))
    wanted = F.lit(False)
    for kind, by in CONFIRMED_BY.items():
        wanted |= (F.col("kind") == KINDS.index(kind)) & F.col("other").isin(*(KINDS.index(b) for b in by))
    near = F.exists(
        "there",
        lambda o: (o["start"] <= F.col("end") + scope)
        & (o["end"] >= F.col("start") - scope)
        & ~((o["start"] >= F.col("start")) & (o["end"] <= F.col("end")))
        & ~((o["start"] <= F.col("start")) & (o["end"] >= F.col("end"))),
    )
    return (
        asking.join(here.withColumnRenamed("kind", "other"), [ROW, "at"])
        .where(wanted & near)
        .select(ROW, F.struct("start", "kind", "end").alias("span"))
        .distinct()
        .groupBy(ROW)
        .agg(F.collect_list("span").alias("confirmed"))
    )


def scan(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), scope: int = SCOPE) -> DataFrame:
    """``keys``, ``base`` and ``spans`` (base and confirmed weak spans) per row, sorted by start, then kind.

    Every row gives one row, repeated rows too; null and empty texts have no spans. Spans are structs
    (start, kind, end) in code points, end exclusive; kind counts from 0 in the order of ``KINDS``.
    """
    docs = with_row_id(docs) if ROW not in docs.columns else docs
    inner = tuple(dict.fromkeys((*keys, ROW)))
    found = written(parts(docs, inner), "credential-parts")
    spans = F.array_sort(F.concat("base", F.coalesce("confirmed", F.array().cast(_SPAN))))
    return found.join(linked(found, scope), ROW, "left").select(*keys, "base", spans.alias("spans"))


def spelled(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with each union of overlapping spans replaced by ``mask``."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(seen: Column, span: Column) -> Column:
        gap = F.substr(text, (seen["at"] + 1).cast("int"), (span["start"] - seen["at"]).cast("int"))
        out = F.when(span["start"] >= seen["at"], F.concat(seen["out"], gap, F.lit(mask))).otherwise(seen["out"])
        return F.struct(F.greatest(seen["at"], span["end"]).alias("at"), out.alias("out"))

    end = lambda seen: F.concat(seen["out"], F.substr(text, (seen["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, zero, step, end)).otherwise(text)
