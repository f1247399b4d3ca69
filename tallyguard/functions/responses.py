"""Reading model responses: verdict, risk score, normalised score, parse errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.fixed_values import PARSE_ERROR_NOTE
from tallyguard.functions.columns import as_col

# fixed values: the two fallback patterns
VERDICT_PATTERN = r'(?i)"verdict"\s*:\s*"(FRAUD|LEGITIMATE)"'
RISK_PATTERN = r'"risk_score"\s*:\s*([1-5])'

RESPONSE_TYPE = T.StructType([
    T.StructField("verdict", T.StringType()),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("fraud_type", T.StringType()),
    T.StructField("aml_typology", T.StringType()),
    T.StructField("risk_indicators", T.ArrayType(T.StringType())),
    T.StructField("recommended_action", T.StringType()),
    T.StructField("confidence", T.StringType()),
])


def json_object(text: str | Column) -> Column:
    """The text as a variant if the whole text is one JSON object, else null.

    The parser ignores text after the first value. Wrapped once as a list and once as a member,
    anything after the object breaks at least one of the two. Texts without outer braces are not
    parsed at all.
    """
    t = F.btrim(as_col(text), F.lit(" \t\r\n"))
    listed = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"r":'), t, F.lit("}")))
    single = F.try_variant_get(listed, "$[1]", "variant").isNull()
    kind = F.schema_of_variant(F.try_variant_get(listed, "$[0]", "variant"))
    braced = t.startswith("{") & t.endswith("}")
    return F.when(braced, F.when(member.isNotNull() & single & kind.startswith("OBJECT"),
                                 F.try_variant_get(listed, "$[0]", "variant")))


def _kind(obj: Column, field: str) -> Column:
    """Schema text of a field: null if absent, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(obj, f"$.{field}", "variant"))


def verdict_from(obj: Column, text: str | Column) -> Column:
    """1 fraud, 0 legitimate or null, from a parsed object (or null) and the whole text."""
    t = as_col(text)
    verdict = F.try_variant_get(obj, "$.verdict", "string")
    pattern = F.upper(F.regexp_extract(t, VERDICT_PATTERN, 1))
    upper = F.upper(t)
    return (
        F.when(obj.isNotNull() & _kind(obj, "verdict").isNull(), F.lit(0))
        .when(obj.isNotNull() & (_kind(obj, "verdict") == "STRING"),
              (F.upper(verdict) == "FRAUD").cast("int"))
        .when(pattern != "", (pattern == "FRAUD").cast("int"))
        .when(upper.contains("LEGITIMATE"), F.lit(0))
        .when(upper.contains("FRAUD"), F.lit(1))
    )


def risk_score_from(obj: Column, text: str | Column) -> Column:
    """Whole risk score; -1 if the object has none; the pattern if it is no number; else null."""
    t = as_col(text)
    kind = _kind(obj, "risk_score")
    as_text = F.trim(F.try_variant_get(obj, "$.risk_score", "string"))
    number = F.try_variant_get(obj, "$.risk_score", "double")
    from_json = (
        F.when(kind == "STRING", F.when(as_text.rlike(r"^[+-]?\d{1,18}$"), as_text.cast("bigint")))
        .when(kind.isin("VOID") | kind.startswith("ARRAY") | kind.startswith("OBJECT"),
              F.lit(None).cast("bigint"))
        .when(kind.isNotNull() & (F.abs(number) < 9e18), number.cast("bigint"))
        .when(kind == "BOOLEAN",
              F.try_variant_get(obj, "$.risk_score", "boolean").cast("bigint"))
    )
    pattern = F.regexp_extract(t, RISK_PATTERN, 1)
    return (
        F.when(obj.isNotNull() & kind.isNull(), F.lit(-1).cast("bigint"))
        .otherwise(F.coalesce(from_json, F.when(pattern != "", pattern.cast("bigint"))))
    )


def parse_verdict(text: str | Column) -> Column:
    """Verdict of a response text: JSON field, then pattern, then keyword, then null."""
    return verdict_from(json_object(text), text)


def parse_risk_score(text: str | Column) -> Column:
    """Risk score of a response text; not range-checked."""
    return risk_score_from(json_object(text), text)


def score_normalize(risk: str | Column) -> Column:
    """Risk score 1-5 to 0-1; missing and 0 count as 2."""
    return (F.coalesce(F.nullif(as_col(risk), F.lit(0)), F.lit(2)) - 1) / F.lit(4.0)


def prediction_default(pred: str | Column) -> Column:
    """Prediction, with an unreadable verdict counted as legitimate."""
    return F.coalesce(as_col(pred), F.lit(0))


def parse_response_or_error(text: str | Column) -> Column:
    """Struct of the answer's fields, or ``PARSE_ERROR`` with the raw text and a note."""
    t = as_col(text)
    obj = json_object(t)
    ok = obj.isNotNull()
    parsed = F.from_json(t, RESPONSE_TYPE)
    fields = {f.name: F.when(ok, parsed[f.name]) for f in RESPONSE_TYPE}
    fields["verdict"] = F.when(ok, parsed["verdict"]).otherwise(F.lit("PARSE_ERROR"))
    fields["risk_score"] = F.try_variant_get(obj, "$.risk_score", "int")
    return F.struct(
        *[c.alias(name) for name, c in fields.items()],
        F.when(~ok, t).alias("raw_response"),
        F.when(~ok, F.lit(PARSE_ERROR_NOTE)).alias("note"),
        (~ok).alias("parse_error"),
    )
