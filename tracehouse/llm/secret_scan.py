"""Secrets in texts: three fixed kinds, and strings whose characters look drawn at random.

Everything is built from column functions. Matches come from ``regexp_extract_all``, their places
from the lengths of what ``split`` leaves between them. For the fourth kind, each long run of
code characters is read once by a window of ENTROPY_WINDOW characters: counts of the characters in
it are updated as it moves, and with them the sum of c·log2(c), which gives the window's entropy. A
run is reported if its best window reaches the limit of its character class (hexadecimal, or mixed)
and it is on no allow-list: no digits, or digits only, or no letters, an identifier in UUID form, or a
run that touches a span of a fixed kind.

Defined results: a null or empty text has no spans; repeated rows, null ids and further columns are
kept; an empty table gives no rows. Places count code points, ends are exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracehouse.functions.columns import free_name

KINDS = ("assign", "access", "hex", "entropy")
BASE_KINDS = KINDS[:3]

# The patterns of the three base kinds. Matches are dropped if they are too short.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32
# a maximal run never contains another match, so the shortest length can stand in the pattern
ACCESS_LONG = r"AKIA[A-Z0-9]{12,}"
HEX_LONG = r"[0-9a-f]{32,}"

CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ENTROPY_WINDOW = 20
HEX_BITS = 3.0  # entropy of a window, in bits a character
MIXED_BITS = 4.0
ALL_CLASSES_BITS = 3.7  # of runs with capitals, small letters and digits, which names and paths seldom mix
UUID = r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"

SPAN = "array<struct<start:int,kind:int,end:int>>"
PLACED = "array<struct<start:int,end:int,found:string>>"
REDACTED = "[REDACTED]"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their places; most texts have none and cost one search."""

    def build(found: Column, gaps: Column) -> Column:
        lengths = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(found)),
            found,
            lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("size"), hit.alias("hit")),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(PLACED).alias("out"))

        def step(state: Column, x: Column) -> Column:
            begin = state["at"] + x["gap"]
            end = begin + x["size"]
            entry = F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("found"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(entry)).cast(PLACED).alias("out"))

        return F.aggregate(lengths, start, step, lambda state: state["out"])

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return F.when(F.rlike(text, F.lit(pattern)), build(found, gaps)).otherwise(F.array().cast(PLACED))


def _as_spans(placed: Column, kind: int) -> Column:
    return F.transform(
        placed, lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end"))
    )


def _bits(count: Column) -> Column:
    """c·log2(c), 0 for none."""
    return F.when(count > 0, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def window_entropy(run: Column) -> Column:
    """Highest entropy of a window of ENTROPY_WINDOW characters in a run, from incremental counts."""
    width = ENTROPY_WINDOW

    def over(chars: Column) -> Column:
        def counted(alphabet: Column) -> Column:
            start = F.struct(
                F.transform(alphabet, lambda _: F.lit(0)).alias("counts"),
                F.lit(0.0).cast("double").alias("sum"),
                F.lit(1e9).cast("double").alias("least"),
            )

            def step(state: Column, at: Column) -> Column:
                # slot of the character that enters, and of the one that leaves (0: none yet)
                slots = F.struct(
                    F.array_position(alphabet, F.get(chars, at)).alias("new"),
                    F.when(at >= width, F.array_position(alphabet, F.get(chars, at - width)))
                    .otherwise(F.lit(0).cast("long"))
                    .alias("old"),
                )

                def moved(s: Column) -> Column:
                    grown = F.coalesce(F.get(state["counts"], (s["new"] - 1).cast("int")), F.lit(0))
                    shrunk = F.coalesce(F.get(state["counts"], (s["old"] - 1).cast("int")), F.lit(0))
                    change = F.when(s["new"] == s["old"], F.lit(0.0)).otherwise(
                        _bits(grown + 1) - _bits(grown) + _bits(shrunk - 1) - _bits(shrunk)
                    )
                    total = state["sum"] + change
                    counts = F.transform(
                        state["counts"],
                        lambda c, k: c
                        + F.when(k == s["new"] - 1, F.lit(1)).otherwise(F.lit(0))
                        - F.when(k == s["old"] - 1, F.lit(1)).otherwise(F.lit(0)),
                    )
                    least = F.when(at >= width - 1, F.least(state["least"], total)).otherwise(state["least"])
                    return F.struct(counts.alias("counts"), total.alias("sum"), least.alias("least"))

                return _let(slots, moved)

            places = F.sequence(F.lit(0), F.size(chars) - 1)
            return F.aggregate(places, start, step, lambda s: F.lit(math.log2(width)) - s["least"] / width)

        return _let(F.array_distinct(chars), counted)

    return _let(F.filter(F.split(run, ""), lambda c: c != ""), over)


def _entropy_spans(text: Column, others: Column) -> Column:
    """Long runs with a window of high entropy, unless an allow-list names them or another span covers them wholly."""

    def suspicious(p: Column) -> Column:
        run = p["found"]
        free = ~F.exists(others, lambda o: (o["start"] <= p["start"]) & (p["end"] <= o["end"]))
        # runs of letters only are words or names, runs without letters numbers or rulers
        allowed = ~F.rlike(run, F.lit("[0-9]")) | ~F.rlike(run, F.lit("[A-Za-z]")) | F.rlike(run, F.lit(UUID))
        hexadecimal = F.rlike(run, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$"))
        every = F.rlike(run, F.lit("[0-9]")) & F.rlike(run, F.lit("[A-Z]")) & F.rlike(run, F.lit("[a-z]"))
        limit = (
            F.when(hexadecimal, F.lit(HEX_BITS)).when(every, F.lit(ALL_CLASSES_BITS)).otherwise(F.lit(MIXED_BITS))
        )
        # each test guards the dearer one behind it
        return F.when(allowed, F.lit(False)).when(~free, F.lit(False)).otherwise(window_entropy(run) >= limit)

    return _as_spans(F.filter(_placed(text, CANDIDATE), suspicious), 3)


def scan(docs: DataFrame, *, text: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with every text's spans (start, kind, end) in order; ``kind`` is an index into KINDS."""
    body = F.coalesce(F.col(text), F.lit(""))
    assigned = F.when(
        F.rlike(body, F.lit(ASSIGN)),
        F.transform(
            F.filter(
                F.arrays_zip(
                    _placed(body, ASSIGN).alias("place"),
                    F.regexp_extract_all(body, F.lit(ASSIGN), F.lit(2)).alias("value"),
                ),
                lambda z: F.length(z["value"]) >= MIN_ASSIGNED,
            ),
            lambda z: z["place"],
        ),
    ).otherwise(F.array().cast(PLACED))
    base = F.concat(
        _as_spans(assigned, 0), _as_spans(_placed(body, ACCESS_LONG), 1), _as_spans(_placed(body, HEX_LONG), 2)
    ).cast(SPAN)
    scanned = docs.withColumn(into, base)
    more = F.concat(F.col(into), _entropy_spans(body, F.col(into))).cast(SPAN)
    return scanned.withColumn(into, F.sort_array(more))


def count_kind(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )


def base_spans(spans: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] < len(BASE_KINDS))


def redacted(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by a mark; other texts, and null ones, stay as they are."""
    spans = free_name(docs.columns, "spans")
    found = scan(docs, text=text, into=spans)
    body = F.col(text)

    def step(state: Column, s: Column) -> Column:
        end = F.greatest(state["at"], s["end"])
        fresh = s["start"] >= state["at"]
        gap = F.concat(F.substring(body, state["at"] + 1, s["start"] - state["at"]), F.lit(REDACTED))
        return F.struct(
            end.alias("at"), F.when(fresh, F.concat(state["out"], gap)).otherwise(state["out"]).alias("out")
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda state: F.concat(state["out"], F.substring(body, state["at"] + 1, F.length(body)))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(body)
    return found.withColumn(text, clean).select(*docs.columns)
