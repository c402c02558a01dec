"""Finding and removing code in text, without user functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lekhani.functions.keywords import spans

# Patterns of tag pairs, script functions and style rules. In the
# first a dot excludes line feeds only; the other two span lines.
TAG_PAIR = r"(?d)<[^>]+?>.+?</[^>]+?>"
SCRIPT_FUNCTION = r"(?s)function\s*?\(.*?\)\s*?\{.*?\}"
STYLE_RULE = r"(?s)\..*?\{.*?\}"


def _spans_of(text: Column, pattern: str) -> Column:
    """[start, end) of every match."""
    return F.transform(spans(text, pattern), lambda x: F.array(x["start"], x["end"]))


def code_spans(text: Column) -> Column:
    """Spans of all three patterns, pattern after pattern, possibly overlapping; null if there are none.

    Without a brace the two brace patterns cannot match and are not tried.
    """
    none = F.array().cast("array<array<int>>")
    braces = F.instr(text, "{") > 0
    spans = F.concat(_spans_of(text, TAG_PAIR), F.when(braces, _spans_of(text, SCRIPT_FUNCTION)).otherwise(none), F.when(braces, _spans_of(text, STYLE_RULE)).otherwise(none))
    # bound once, so that no pattern is matched twice
    return F.element_at(F.transform(F.array(spans), lambda s: F.when(F.size(s) > 0, s)), 1)


def code_spans_checked(text: Column) -> Column:
    """struct(code_spans, code_spans_success): success is false for null texts."""
    return F.struct(code_spans(text).alias("code_spans"), text.isNotNull().alias("code_spans_success"))


def has_code(spans: Column) -> Column:
    """Whether there is any span."""
    return F.coalesce(F.size(spans) > 0, F.lit(False))


def remove_code(text: Column, spans: Column, merged: bool = False) -> Column:
    """The text between the spans.

    By default spans are taken in list order, and a span that begins before the
    end of the one ahead of it repeats text; ``merged`` sorts and unites them.
    """
    if merged:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        step = lambda a, s: F.struct(F.concat(a["out"], F.when(s[0] > a["at"], F.substring(text, a["at"] + 1, s[0] - a["at"])).otherwise("")).alias("out"), F.greatest(a["at"], s[1]).alias("at"))
        kept = F.aggregate(F.array_sort(spans), start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    else:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
        step = lambda a, s: F.struct(F.concat(a["out"], F.when(s[0] > a["at"], F.substring(text, a["at"] + 1, s[0] - a["at"])).otherwise("")).alias("out"), s[1].alias("at"))
        kept = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    return F.when(has_code(spans), kept).otherwise(text)
