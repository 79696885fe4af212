"""From model output to a typed record.

The boundary is lax in the way the declared record is: a number may arrive as a
number, a numeric string or a boolean; a text must arrive as a text; further keys
are ignored; a missing or null field is an error, never a default.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfacts.schemas import FIELD_ERROR, TEXT_FIELDS

ERRORS = T.ArrayType(FIELD_ERROR)

# What a numeric string may look like.
NUMBER_TEXT = (
    r"(?i)^\s*[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)(e[+-]?[0-9]+)?\s*$"
)
SPECIAL_NUMBER_TEXT = r"(?i)^\s*[+-]?(inf|infinity|nan)\s*$"

# Messages of a record that has no usable value for a field.
MISSING = "field required"
NOT_A_NUMBER = "input is not a valid number"
NOT_A_TEXT = "input is not a valid string"
NO_OBJECT = "no JSON object found in model output: "
BAD_JSON = "model output is not valid JSON"


def field_error(field: str, message: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), message.alias("message"))


def number_from_text(value: Column) -> Column:
    """A double from a numeric string; null where the string is anything else."""
    plain = F.regexp_replace(F.trim(value), "_", "")
    special = F.lower(F.regexp_replace(plain, r"^\+", ""))
    return F.when(value.rlike(NUMBER_TEXT), plain.try_cast("double")).when(
        value.rlike(SPECIAL_NUMBER_TEXT), special.try_cast("double")
    )


# Parsing ends at the first complete value, so a block is parsed as the first item of an
# array whose second item must then be this mark: text after the object is an error.
_END = "end of output"


def parsed_block(block: Column) -> Column:
    return F.try_parse_json(F.concat(F.lit("["), block, F.lit(f',"{_END}"]')))


def sole_object(parsed: Column) -> Column:
    """The object of a parsed block; null if the block held anything else beside it."""
    third = F.try_variant_get(parsed, "$[2]", "variant")
    whole = (F.try_variant_get(parsed, "$[1]", "string") == _END) & third.isNull()
    return F.when(whole, F.try_variant_get(parsed, "$[0]", "variant"))


def field_kind(variant: Column, field: str) -> Column:
    """Type name of one field, ``VOID`` for JSON null, null when the key is absent."""
    return F.schema_of_variant(F.try_variant_get(variant, f"$.{field}", "variant"))


def field_text(variant: Column, kind: Column, field: str) -> Column:
    return F.when(kind == "STRING", F.try_variant_get(variant, f"$.{field}", "string"))


def field_number(variant: Column, kind: Column, field: str) -> Column:
    """Numbers and booleans as they are, strings if numeric; null for anything else."""
    path = f"$.{field}"
    return F.when(
        kind == "STRING", number_from_text(F.try_variant_get(variant, path, "string"))
    ).otherwise(F.try_variant_get(variant, path, "double"))


def errors_where(cases: Sequence[tuple[Column, Column]]) -> Column:
    """Array of the error structs whose condition holds, in order.

    Joined from arrays of none or one, which unlike filtering out nulls needs no lambda
    and so stays in generated code; a row without errors builds nothing.
    """
    none = F.array().cast(ERRORS)
    any_holds = reduce(lambda a, b: a | b, [holds for holds, _ in cases])
    found = F.concat(*[F.when(holds, F.array(error)).otherwise(none) for holds, error in cases])
    return F.when(any_holds, found).otherwise(none)


def type_problem(field: str, kind: Column, value: Column) -> tuple[Column, Column]:
    """When ``field`` has no usable value, and the error to report then."""
    wrong = NOT_A_TEXT if field in TEXT_FIELDS else NOT_A_NUMBER
    why = F.when(kind.isNull(), F.lit(f"{field}: {MISSING}")).otherwise(F.lit(f"{field}: {wrong}"))
    return value.isNull(), field_error(field, why)


def no_object(output: Column) -> Column:
    """Errors of an output without a brace pair, quoting how it starts."""
    return F.array(field_error("output", F.concat(F.lit(NO_OBJECT), F.substring(output, 1, 200))))
