"""Event encoding (T1, T8, E12, E13) and strict validation.

Bodies are JSON objects; validation needs no UDF.  A body is parsed once, to a
VARIANT, as the first element of an array whose second element is the body's
own digest: ``[body,"md5"]``.  If that parses and its second element is the
digest, the body was exactly one well-formed JSON value -- no trailing text
whichever bracket closes it, no bare NaN/Infinity, no single quotes.  It is an
object if its first non-blank character is ``{``.  The required fields, taken
from the variant as *strings* (so ``0``, ``""`` and ``false`` pass and types are
not checked), must be present and not null.

The variant parser refuses objects that repeat a name, which count as valid
here (the last value stands), and gives no reason.  Only the bodies it refuses
go through the longer checks, which tell:

1. ``json_array_length('[' || body || ']') = 1`` -- exactly one well-formed
   JSON value, no bare NaN/Infinity;
2. ``json_object_keys('{"w":' || body || '}')`` has one key -- together with 1
   this rules out trailing text whichever bracket closes it;
3. the value is an object and parses with single quotes / unquoted names / NaN
   refused; the required fields are read from it as strings.

The raw body is kept for the sink, so unknown fields survive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goalpost.functions.numeric import finite_or_null

# --- fixed values: rejection reasons ------------------------------------------
MALFORMED = "malformed"
INVALID_CONSTANT = "invalid constant"
NOT_OBJECT = "not an object"
MISSING_FIELD = "missing field"
# -------------------------------------------------------------------------------

_NON_FINITE_TOKEN = r"[\[:,]\s*-?(NaN|Infinity)\s*[,\]}]"


def encode(df: DataFrame, id_col: str) -> DataFrame:
    """``(message_id, body)`` with every column in the body, explicit nulls kept,
    and NaN / +-Infinity turned into null first (JSON has no such constants)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = finite_or_null(c)
        cols.append(c.alias(f.name))
    body = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return df.select(F.col(id_col).cast("string").alias("message_id"), body.alias("body"))


def is_strict_value(body: Column) -> Column:
    one_value = F.json_array_length(F.concat(F.lit("["), body, F.lit("]"))) == 1
    no_trailing = F.size(F.json_object_keys(F.concat(F.lit('{"w":'), body, F.lit("}")))) == 1
    return F.coalesce(one_value & no_trailing, F.lit(False))


def is_object(body: Column) -> Column:
    return F.coalesce(body.rlike(r"^[ \t\n\r]*\{"), F.lit(False))


def _parse(body: Column, required: Sequence[str]) -> Column:
    """One strict parse: the required fields as strings plus the corrupt-record marker."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in required]
                          + [T.StructField("_corrupt_record", T.StringType())])
    return F.from_json(body, schema, {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false",
                                      "allowUnquotedFieldNames": "false", "mode": "PERMISSIVE",
                                      "columnNameOfCorruptRecord": "_corrupt_record"})


def _slow_reason(b: Column, required: Sequence[str]) -> Column:
    """The reason by the longer checks, in the order of the reference's; null for a valid event."""
    parsed = _parse(b, required)
    obj = is_object(b)
    well_formed = is_strict_value(b) & (~obj | F.coalesce(parsed["_corrupt_record"].isNull(), F.lit(False)))
    present = F.lit(True)
    for c in required:
        present = present & parsed[c].isNotNull()
    return (F.when(~well_formed,
                   F.when(F.coalesce(b.rlike(_NON_FINITE_TOKEN), F.lit(False)), F.lit(INVALID_CONSTANT))
                    .otherwise(F.lit(MALFORMED)))
             .when(~obj, F.lit(NOT_OBJECT))
             .when(~F.coalesce(present, F.lit(False)), F.lit(MISSING_FIELD)))


def parsed_once(body: Column) -> Column:
    """VARIANT ``[body, digest]``; null where the body is not JSON text."""
    return F.try_parse_json(F.concat(F.lit("["), body, F.lit(',"'), F.md5(body.cast("binary")), F.lit('"]')))


def validate(messages: DataFrame, required: Sequence[str], body: str = "body") -> DataFrame:
    """Adds ``motivo`` (reason, null when valid) and ``valido``."""
    b, v = F.col(body), F.col("__variant")
    field = lambda c: F.try_variant_get(v, "$[0]['" + c.replace("'", "\\'") + "']", "string")
    present = F.lit(True)
    for c in required:
        present = present & field(c).isNotNull()
    whole = F.try_variant_get(v, "$[1]", "string") == F.md5(b.cast("binary"))
    reason = (F.when(F.coalesce(whole, F.lit(False)),
                     F.when(~is_object(b), F.lit(NOT_OBJECT)).when(~present, F.lit(MISSING_FIELD)))
               .otherwise(_slow_reason(b, required)))
    return (messages.withColumn("__variant", parsed_once(b)).withColumn("motivo", reason).drop("__variant")
                    .withColumn("valido", F.col("motivo").isNull()))
