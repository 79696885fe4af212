"""Domain rules on typed records, with a reason for every field that fails."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docfacts.functions.records import MISSING, errors_where, field_error
from docfacts.schemas import RECORD_FIELDS

# The domain the records must lie in, and below, the messages.
VALID_MINERALS = ("Copper", "Gold", "Silver", "Zinc", "Lithium", "Nickel")
LAT_BOUNDS = (-30.0, -15.0)
LON_BOUNDS = (-75.0, -60.0)
MAX_DEPTH_M = 1000


@dataclass(frozen=True)
class Rule:
    """``holds`` and ``message`` map the column of ``field`` to an expression."""

    field: str
    holds: Callable[[Column], Column]
    message: Callable[[Column], Column]


def _bounded(field: str, bounds: tuple[float, float]) -> Rule:
    return Rule(
        field,
        lambda c: c.between(*bounds),
        lambda c: F.concat(
            F.lit(f"{field}="), c.cast("string"), F.lit(f" outside survey region bounds {bounds}")
        ),
    )


DOMAIN_RULES = (
    Rule(
        "mineral",
        lambda c: c.isin(*VALID_MINERALS),
        lambda c: F.concat(F.lit("'"), c, F.lit("' is not a recognized mineral")),
    ),
    Rule(
        "depth_m",
        lambda c: (c > 0) & (c <= MAX_DEPTH_M),
        lambda c: F.concat(
            F.lit("depth_m="),
            c.cast("string"),
            F.lit(f" is out of plausible range (0, {MAX_DEPTH_M}]"),
        ),
    ),
    _bounded("lat", LAT_BOUNDS),
    _bounded("lon", LON_BOUNDS),
)


def _source(record: str | None) -> Callable[[str], Column]:
    return (lambda f: F.col(record)[f]) if record else F.col


def rule_errors(rules: Sequence[Rule] = DOMAIN_RULES, record: str | None = None) -> Column:
    """Array of {field, message} for the present values that break a rule, in rule order."""
    value = _source(record)
    return errors_where(
        [
            (
                value(r.field).isNotNull() & ~r.holds(value(r.field)),
                field_error(r.field, r.message(value(r.field))),
            )
            for r in rules
        ]
    )


def check(
    df: DataFrame,
    rules: Sequence[Rule] = DOMAIN_RULES,
    record: str | None = None,
    required: Sequence[str] = RECORD_FIELDS,
) -> DataFrame:
    """Add ``errors`` and ``valid``.

    ``record`` names a struct column holding the fields; without it they are columns
    of ``df``. A ``type_errors`` column left by the parser comes first, and the domain
    rules then only look at values that are present; on plain typed columns an absent
    value of a ``required`` field is itself an error, and errors come in the fields' order.
    """
    value = _source(record)
    broken = rule_errors(rules, record)
    # Kept apart from the messages, so that filtering by it builds none.
    valid = F.lit(True)
    for rule in rules:
        valid = valid & F.coalesce(rule.holds(value(rule.field)), F.lit(False))
    if "type_errors" in df.columns:
        errors = F.concat(F.col("type_errors"), broken)
        valid = valid & (F.size("type_errors") == 0)
    else:
        cases = []
        for name in dict.fromkeys([*required, *(r.field for r in rules)]):
            absent = value(name).isNull()
            valid = valid & ~absent
            cases.append((absent, field_error(name, F.lit(f"{name}: {MISSING}"))))
            cases += [
                (~absent & ~r.holds(value(name)), field_error(name, r.message(value(name))))
                for r in rules
                if r.field == name
            ]
        errors = errors_where(cases)
    return df.withColumns({"errors": errors, "valid": valid})


def reason(errors: Column) -> Column:
    """The messages of one row as a single text."""
    return F.array_join(errors["message"], "; ")


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with a ``reason``) of a checked frame."""
    valid = checked.filter("valid").drop("errors", "valid", "type_errors")
    quarantined = checked.filter("NOT valid").withColumn("reason", reason(F.col("errors")))
    return valid, quarantined.drop("valid", "type_errors")
