"""Text expressions: sentence passages, prompts, model-output clean-up, fact patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, and the passage boundary,
# which is a run of whitespace that comes after a full stop or a line break.
_SPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(chr(code) for code in _SPACE_CODES)
_SPACE_CLASS = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
PASSAGE_BOUNDARY = rf"(?<=[.\n]){_SPACE_CLASS}+"

# The wording sent to a provider.
PROMPT_HEADER = (
    "Extract the following fields from this geological survey report as a single JSON object "
    "with keys exactly: mineral, depth_m, lat, lon, grade_g_t, hole_id.\n"
)
PROMPT_FOOTER = "\n\nReturn only the JSON object, nothing else."
HINT_START = "A previous extraction attempt failed validation: "
HINT_END = ". Be precise about field types and value ranges."

# How a report states its facts.
FACT_PATTERNS = {
    "mineral": r"g/t (\w+) at a depth of",
    "depth_m": r"at a depth of (-?[0-9]+(?:\.[0-9]+)?)m",
    "lat": r"at the collar: (-?[0-9]+(?:\.[0-9]+)?),",
    "lon": r"at the collar: -?[0-9.]+, (-?[0-9]+(?:\.[0-9]+)?)",
    "grade_g_t": r"intersected (-?[0-9]+(?:\.[0-9]+)?) g/t",
    "hole_id": r"Drill hole (\S+) intersected",
}


def strip(text: Column) -> Column:
    """Drop whitespace of any script from both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def passages(text: Column) -> Column:
    """Array of passages, each still carrying possible trailing whitespace.

    Stripping the whole text first means no element but that of a blank text can be
    empty, so positions are final and no per-element lambda is needed: callers
    explode and strip the single passage.
    """
    return F.split(strip(text), PASSAGE_BOUNDARY)


def prompt(report: Column, hint: Column) -> Column:
    """The request for one report, with a note when an earlier attempt failed."""
    note = F.when(hint != "", F.concat(F.lit("Note: "), hint, F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(
        F.lit(PROMPT_HEADER), note, F.lit("\nReport:\n"), report, F.lit(PROMPT_FOOTER)
    )


def retry_hint(reason: Column) -> Column:
    return F.concat(F.lit(HINT_START), reason, F.lit(HINT_END))


def without_reasoning(output: Column) -> Column:
    """Drop every ``<think>`` block of a model output, then strip."""
    return strip(F.regexp_replace(output, r"(?s)<think>.*?</think>", ""))


def json_block(output: Column) -> Column:
    """From the first ``{`` to the last ``}``; null if there is no such pair."""
    return F.nullif(F.regexp_extract(output, r"(?s)\{.*\}", 0), F.lit(""))


def stated_fact(text: Column, field: str) -> Column:
    """The first statement of ``field`` in a report, as text; null if not stated."""
    return F.nullif(F.regexp_extract(text, FACT_PATTERNS[field], 1), F.lit(""))
