"""Regular-expression matches with their positions, by built-in functions only.

A span is ``struct<start, rank, kind, end>``: code points, end exclusive. Sorting spans
sorts them by start and then by the order in which their kinds are listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


#: Elements that are added up one by one between two running totals.
_BLOCK = 64
#: Code points before a match that ``matches`` returns with it.
BEFORE = 80


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _placed(parts: Column, sizes: Column, blocks: Column) -> Column:
    """Matches with positions. ``blocks`` has the total size of every ``_BLOCK`` parts.

    A position is the total of the whole blocks before it plus that of the parts before it
    in its own block, so a text with very many matches takes little more than linear time.
    """

    def placed(totals: Column) -> Column:
        def place(part: Column, i: Column) -> Column:
            block = F.floor(i / _BLOCK).cast("int")
            start = (
                F.get(totals, block)
                + _total(F.slice(sizes, block * _BLOCK + 1, i - block * _BLOCK))
                + F.length(part["gap"])
            )
            earlier = F.when(i > 0, F.get(parts, i - 1)["whole"]).otherwise(F.lit(""))
            return F.struct(
                start.alias("start"), (start + F.length(part["whole"])).alias("end"), part["value"].alias("value"),
                F.substring(F.concat(earlier, part["gap"]), -BEFORE, BEFORE).alias("before"),
            )

        # The last gap has no match after it.
        return F.filter(F.transform(parts, place), lambda m: m["end"].isNotNull())

    return _let(F.transform(blocks, lambda b, k: _total(F.slice(blocks, F.lit(1), k))), placed)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches as ``array<struct<start, end, value, before>>``.

    value is the text of ``group``, before what stands in front of the match, back to the beginning of the
    match before it or for ``BEFORE`` code points. The text between matches comes from ``split`` and the matches from
    ``regexp_extract_all``; adding up their lengths gives the positions. Texts without a match cost one search.
    """
    kind = "array<struct<start:int,end:int,value:string,before:string>>"
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), value.alias("value"))

    def sized(parts: Column) -> Column:
        sizes = F.transform(parts, lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["whole"]), F.lit(0)))

        def blocked(sizes: Column) -> Column:
            starts = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int"))
            blocks = F.transform(starts, lambda b: _total(F.slice(sizes, b * _BLOCK + 1, F.lit(_BLOCK))))
            return _let(blocks, lambda b: _placed(parts, sizes, b))

        return _let(sizes, blocked)

    found = _let(zipped, sized).cast(kind)
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(kind))


def as_spans(found: Column, kind: str, rank: int) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")
        ),
    )


def in_order(*lists: Column) -> Column:
    return F.sort_array(F.concat(*lists))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def overlaps_any(span: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < span["end"]) & (span["start"] < s["end"]))


#: Pairs of spans that are compared one by one within a row.
FEW_PAIRS = 4096


def with_free(rows: DataFrame, keys: list[str], spans: str, others: str, few_pairs: int = FEW_PAIRS) -> DataFrame:
    """Leave in the sorted array ``spans`` those that overlap none of the array ``others``.

    Rows with few spans compare them directly. For the others the ends of ``spans`` and the starts of ``others`` are
    sorted, by ``keys`` of the row: a span overlaps one of the others if, of those that start before its end,
    the furthest ends after its start. So a text full of spans costs a sort, not every pair.
    """
    few = F.size(spans).cast("bigint") * F.size(others) <= few_pairs
    direct = F.filter(spans, lambda s: ~overlaps_any(s, F.col(others)))
    many = rows.where(~few)

    def events(of: str, at: str, other: bool) -> DataFrame:
        span = F.col("_span") if not other else F.lit(None).cast(rows.schema[spans].dataType.elementType)
        listed = many.select(*keys, F.explode(of).alias("_span"))
        return listed.select(*keys, F.col(f"_span.{at}").alias("_at"), F.lit(other).alias("_other"), F.col("_span.end").alias("_end"), span.alias("_span"))

    in_row = Window.partitionBy(*keys).orderBy("_at", "_other").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    furthest = F.max(F.when(F.col("_other"), F.col("_end"))).over(in_row)
    # Rows with the same keys are the same text.
    every = events(spans, "end", False).unionByName(events(others, "start", True)).distinct().withColumn("_furthest", furthest)
    free = every.where(~F.col("_other") & (F.coalesce("_furthest", F.lit(0)) <= F.col("_span.start")))
    free = free.groupBy(*[F.col(k).alias(f"_same_{k}") for k in keys]).agg(F.sort_array(F.collect_list("_span")).alias("_free"))
    same = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    left = F.coalesce("_free", F.slice(spans, F.lit(1), F.lit(0)))
    sorted_out = many.join(free, same, "left").withColumn(spans, left).select(*rows.columns)
    return rows.where(few).withColumn(spans, direct).unionByName(sorted_out)


def row_key(text: Column) -> Column:
    """Tells apart rows that share an id but not their text."""
    return F.xxhash64(text, F.length(text))
