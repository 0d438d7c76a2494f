"""Schemas of the records that pass between the stages."""

from pyspark.sql import types as T

from riskloom import fixed_values as fixed

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Text form of every field a JSON line may carry; JSON scalars read as text keep their spelling.
RAW_LINE = T.StructType(
    [T.StructField(name, S) for name in (*fixed.CODE_FIELDS, *fixed.LABEL_FIELDS, *fixed.GROUP_FIELDS, "language", "owasp_category", "processed_func")]
)
FUNCTION = _struct(func_name=S, func_before=S, before=S, func_after=S, func=S, after=S)
CVE_TREE = _struct(
    cve_id=S,
    commits=T.ArrayType(
        _struct(
            commit_hash=S,
            id=S,
            files=T.ArrayType(
                _struct(
                    language=S, file_path=S, vulnerable_functions=T.ArrayType(FUNCTION), non_vulnerable_functions=T.ArrayType(_struct(func=S))
                )
            ),
        )
    ),
)
PAIRED = _struct(func_before=S, func=S)
CVEFIXES = _struct(code=S, safety=S, language=S)
STANDARD = _struct(raw_code=S, is_vulnerable=S, source=S, path=S, language=S, group_id=S)
CLEAN = _struct(
    raw_code=S, is_vulnerable=I, source=S, path=S, language=S, group_id=S, code_hash=S, code_length=L, line_count=L
)
METRICS = T.StructType([T.StructField(name, D if name == "test_coverage" else L) for name in fixed.METRIC_FIELDS])
SCAN_REQUEST = _struct(files=T.ArrayType(_struct(filename=S, code=S)))
ARRIVING_FILE = _struct(filename=S, code=S)
PREDICTION = _struct(
    is_vulnerable=B, risk_probability=D, risk_level=S, recommendation=S, vulnerability_types=T.ArrayType(S), cwe_ids=T.ArrayType(S)
)
