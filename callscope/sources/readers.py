"""Tables and streams of raw input, always with an explicit schema."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope import schemas as S
from callscope.operators.delivery import with_response
from callscope.operators.envelopes import unpack_envelopes


def _load(spark, path, schema, fmt, streaming, files: int | None = None) -> DataFrame:
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(schema)
    if streaming and files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(path)


def read_messages(
    spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Message log, as a table or a stream of files, a bounded number in each micro-batch."""
    return _load(spark, path, S.MESSAGE_SCHEMA, fmt, streaming, files_per_trigger)


def read_calls(spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False) -> DataFrame:
    """Finished calls that were logged as one row each."""
    return _load(spark, path, S.CALL_SCHEMA, fmt, streaming)


def read_envelopes(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Events of envelope documents, one document per line of text."""
    lines = _load(spark, path, T.StructType([T.StructField("value", T.StringType())]), "text", streaming)
    return unpack_envelopes(lines.withColumn("document", F.xxhash64("value")), "value")


def read_responses(
    spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False
) -> DataFrame:
    """Delivery attempts with their parsed answer; NULL where the body is no answer."""
    return with_response(_load(spark, path, S.ATTEMPT_SCHEMA, fmt, streaming))


def read_catalog(
    spark: SparkSession, path: str, fmt: str = "parquet", streaming: bool = False
) -> DataFrame:
    """Snapshots of served tool lists."""
    return _load(spark, path, S.CATALOG_SCHEMA, fmt, streaming)


def explode_tool_list(snapshots: DataFrame, body: str = "body") -> DataFrame:
    """Catalog rows of `tools/list` answers, one per tool."""
    tools = F.from_json(
        body, "result struct<tools: array<struct<name: string, description: string, inputSchema: string>>>"
    )["result"]["tools"]
    return snapshots.select("server_id", "registered_at", F.explode(tools).alias("t")).select(
        "server_id", "registered_at",
        F.col("t.name").alias("tool_name"),
        F.col("t.description").alias("description"),
        F.col("t.inputSchema").alias("input_schema"),
    )
