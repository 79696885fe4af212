"""Schemas of the data sets passed between stages.

Everything read from files gets one of these, so no job pays for schema inference.
"""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


RECORD_FIELDS = ("mineral", "depth_m", "lat", "lon", "grade_g_t", "hole_id")
TEXT_FIELDS = ("mineral", "hole_id")
NUMBER_FIELDS = ("depth_m", "lat", "lon", "grade_g_t")

RECORD = T.StructType(
    [
        T.StructField(f, T.StringType() if f in TEXT_FIELDS else T.DoubleType())
        for f in RECORD_FIELDS
    ]
)

UPLOAD = _struct(("report_id", T.StringType()), ("text", T.StringType()))

REGISTRY = _struct(("content_hash", T.StringType()), ("report_id", T.StringType()))

LABELLED_REPORT = _struct(
    ("report_id", T.StringType()),
    ("text", T.StringType()),
    (
        "ground_truth",
        _struct(
            ("mineral", T.StringType()),
            ("depth_m", T.IntegerType()),
            ("lat", T.DoubleType()),
            ("lon", T.DoubleType()),
            ("grade_g_t", T.DoubleType()),
            ("hole_id", T.StringType()),
        ),
    ),
)

# A stored extraction keeps every value in a one-entry wrapper naming its type.
_S = _struct(("S", T.StringType()))
_N = _struct(("N", T.StringType()))
STORED_EXTRACTION = T.StructType(
    [T.StructField("report_id", _S)]
    + [T.StructField(f, _S if f in TEXT_FIELDS else _N) for f in RECORD_FIELDS]
)

FIELD_ERROR = _struct(("field", T.StringType()), ("message", T.StringType()))

OCCURRENCE = _struct(
    ("mineral", T.StringType()),
    ("lat_bucket", T.DoubleType()),
    ("lon_bucket", T.DoubleType()),
    ("n_reports", T.LongType()),
    ("avg_depth_m", T.DoubleType()),
    ("avg_grade_g_t", T.DoubleType()),
)

LINK = _struct(
    ("mineral", T.StringType()),
    ("lat_bucket", T.DoubleType()),
    ("lon_bucket", T.DoubleType()),
    ("report_id", T.StringType()),
)

ANSWER = _struct(("prompt_hash", T.StringType()), ("output", T.StringType()))

ATTEMPT = _struct(("report_id", T.StringType()), ("attempts", T.LongType()))

CHECK = _struct(
    ("dimension", T.StringType()),
    ("name", T.StringType()),
    ("measured", T.DoubleType()),
    ("threshold", T.DoubleType()),
    ("passed", T.BooleanType()),
    ("detail", T.StringType()),
    ("higher_is_better", T.BooleanType()),
)
