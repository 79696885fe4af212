"""Model outputs to typed records, and the rule-based reading of a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docfacts.functions import records, text
from docfacts.schemas import RECORD, TEXT_FIELDS
from docfacts.session import computed_once


def parse_outputs(df: DataFrame, output: str, schema: T.StructType = RECORD) -> DataFrame:
    """Add ``record`` (null when there is no JSON object) and ``type_errors``.

    Reasoning blocks are dropped, the widest brace pair is read as one object and each
    field is coerced or reported.
    """
    fields = schema.fields
    clean, block, variant = F.col("_clean"), F.col("_block"), F.col("_variant")
    kind = {f.name: F.col(f"_kind_{f.name}") for f in fields}
    value = {f.name: F.col(f"_value_{f.name}") for f in fields}
    read = {
        f.name: records.field_text if isinstance(f.dataType, T.StringType) else records.field_number
        for f in fields
    }

    # Each step is evaluated once per row; apart, their generated code stays small enough to be compiled.
    blocks = computed_once(
        df.withColumn("_clean", text.without_reasoning(F.col(output))),
        {"_clean": clean, "_block": text.json_block(clean)},
    )
    objects = computed_once(
        blocks.withColumn("_parsed", records.parsed_block(block)), {"_variant": records.sole_object(F.col("_parsed"))}
    ).drop("_parsed")
    kinds = computed_once(objects, {f"_kind_{f.name}": records.field_kind(variant, f.name) for f in fields})
    parsed = computed_once(
        kinds, {f"_value_{n}": read[n](variant, kind[n], n) for n in (f.name for f in fields)}
    )
    unparsed = F.when(block.isNull(), records.no_object(clean)).when(
        variant.isNull(), F.array(records.field_error("output", F.lit(records.BAD_JSON)))
    )
    problems = [records.type_problem(n, kind[n], value[n]) for n in value]
    typed = F.struct(*[c.alias(n) for n, c in value.items()])
    return computed_once(
        parsed,
        {
            "record": F.when(variant.isNotNull(), typed),
            "type_errors": F.coalesce(unparsed, records.errors_where(problems)),
        },
    ).select(*df.columns, "record", "type_errors")


def stated_facts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the six fields as stated in the sentences of each report.

    A fact that is not stated, or not readable as its type, is null.
    """
    facts = {}
    for spec in RECORD.fields:
        found = text.stated_fact(F.col(text_col), spec.name)
        facts[spec.name] = found if spec.name in TEXT_FIELDS else found.try_cast("double")
    return computed_once(df, facts)
