"""Message sources built from the shared ``events`` table (FIXTURES.md §6).

Bodies are the JSON of each row; by ``event_id % 50`` a body is truncated (0),
wrapped in an array (1), has a required field set to null (2) or carries a
bare ``NaN`` (3).  Rows with ``event_id % 20 = 5`` are delivered twice.
The same function serves the batch table and the file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values of the message fixture --------------------------------------
REQUIRED = ("event_id", "user_id", "event_type")
STUDENT_REQUIRED = ("ano", "id_municipio", "id_aluno")      # of replayed student records
CORRUPT_MOD = 50
REDELIVER_MOD, REDELIVER_REST = 20, 5
# -------------------------------------------------------------------------------

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def _body(e: DataFrame) -> DataFrame:
    k = F.col("event_id") % CORRUPT_MOD
    fields = [F.col("event_id"), F.col("ts"), F.when(k == 2, F.lit(None).cast("bigint"))
              .otherwise(F.col("user_id")).alias("user_id"), F.col("event_type"),
              F.when(k == 3, F.lit("__nan__")).otherwise(F.col("value").cast("string")).alias("value_txt"),
              F.col("value"), F.col("props")]
    j = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    # the value field as a number, or a bare NaN for the invalid-constant case
    j = F.regexp_replace(j, r',"value_txt":("__nan__"|"[^"]*"|null),"value":', F.lit(',"value":'))
    j = F.when(k == 3, F.regexp_replace(j, r'"value":[^,}]*', F.lit('"value":NaN'))).otherwise(j)
    body = (F.when(k == 0, F.expr("substring(__j, 1, CAST(length(__j) / 2 AS INT))"))
             .when(k == 1, F.concat(F.lit("["), F.col("__j"), F.lit("]")))
             .otherwise(F.col("__j")))
    return (e.withColumn("__j", j)
             .select(F.col("event_id").cast("string").alias("message_id"), body.alias("body"),
                     F.col("ts").cast("timestamp").alias("sent_ts"), F.col("event_id")))


def messages_from(events: DataFrame) -> DataFrame:
    """(message_id, body, sent_ts, event_id) with the redelivered copies."""
    m = _body(events)
    again = m.filter(F.col("event_id") % REDELIVER_MOD == REDELIVER_REST)
    return m.unionByName(again)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from(spark.read.parquet(f"{sf_dir}/events.parquet"))


def message_stream(spark: SparkSession, sf_dir: str, max_files: int = 100) -> DataFrame:
    """The same messages as a file stream over the events table (``max_files`` bounds a micro-batch)."""
    events = (spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", max_files)
                   .parquet(f"{sf_dir}/{{events.parquet}}"))   # a glob: matches one file and a folder of files alike
    return messages_from(events)


def write_replay(df: DataFrame, id_col: str, n: int, path: str, seed: int = 42) -> str:
    """T8 as a batch job: a seeded sample of ``min(n, rows)`` rows, encoded as events
    (non-finite -> null), written as a message table a stream can replay."""
    from goalpost.operators.sampling import sample_exact
    from goalpost.streaming.events import encode
    msgs = encode(sample_exact(df, n, id_col, seed), id_col).withColumn("sent_ts", F.current_timestamp())
    msgs.write.mode("overwrite").parquet(path)
    return path
