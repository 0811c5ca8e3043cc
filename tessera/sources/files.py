"""File sources and sinks: example JSONL, CSV extracts, metric logs, JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INPUT_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("sku", T.StringType()),
    T.StructField("brand", T.StringType()), T.StructField("category", T.StringType()),
    T.StructField("material", T.StringType()), T.StructField("finish", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("length_cm", T.DoubleType()),
    T.StructField("breadth_cm", T.DoubleType()), T.StructField("height_cm", T.DoubleType()),
    T.StructField("weight_grams", T.DoubleType()), T.StructField("mrp", T.DoubleType()),
    T.StructField("short_description", T.StringType())])
EXAMPLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("input", INPUT_SCHEMA),
    T.StructField("output", T.StringType()), T.StructField("db_ai_description", T.StringType()),
    T.StructField("extras", T.MapType(T.StringType(), T.StringType()))])

# Union schema of the training metric log: train, eval and summary rows.
METRIC_SCHEMA = T.StructType([T.StructField(n, t) for n, t in [
    ("step", T.LongType()), ("epoch", T.DoubleType()), ("loss", T.DoubleType()),
    ("grad_norm", T.DoubleType()), ("learning_rate", T.DoubleType()), ("entropy", T.DoubleType()),
    ("mean_token_accuracy", T.DoubleType()), ("num_tokens", T.DoubleType()),
    ("eval_loss", T.DoubleType()), ("eval_runtime", T.DoubleType()),
    ("eval_samples_per_second", T.DoubleType()), ("eval_steps_per_second", T.DoubleType()),
    ("eval_entropy", T.DoubleType()), ("eval_mean_token_accuracy", T.DoubleType()),
    ("eval_num_tokens", T.DoubleType()), ("train_runtime", T.DoubleType()),
    ("train_samples_per_second", T.DoubleType()), ("train_steps_per_second", T.DoubleType()),
    ("total_flos", T.DoubleType()), ("train_loss", T.DoubleType())]])


def read_examples_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Nested example JSON lines with a fixed schema; blank lines are skipped, a malformed line raises."""
    return spark.read.schema(EXAMPLE_SCHEMA).option("mode", "FAILFAST").json(path)


def read_examples_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Examples, and the malformed lines (``line``) as a second frame."""
    schema = T.StructType([*EXAMPLE_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("e"))
    bad = F.col("e._corrupt_record").isNotNull() | F.col("e").isNull()
    names = [f.name for f in EXAMPLE_SCHEMA]
    return parsed.where(~bad).select(*[F.col("e")[n].alias(n) for n in names]), parsed.where(bad).select(F.col("value").alias("line"))


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV where NULL is an unquoted empty field and '' is a quoted empty string."""
    (df.write.mode("overwrite").option("header", "true").option("nullValue", "")
       .option("emptyValue", '""').option("escape", '"').csv(path))


# An unquoted empty field is parsed as this marker and then mapped to NULL, so
# a quoted empty field ("") can stay an empty string.
_NULL_MARK = "\u0001NULL\u0001"


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return (spark.read.schema(schema).option("header", "true").option("multiLine", "true")
            .option("escape", '"').option("nullValue", _NULL_MARK).option("emptyValue", "").csv(path))


def metric_rows(raw: DataFrame, whole_lines: bool = False) -> DataFrame:
    """``(file, line_no, metrics..., kind)`` of whole log files (one row per file, ``value``).

    With ``whole_lines`` a last line without its line end is left for later.
    """
    lines = F.split("value", "\n")
    if whole_lines:
        lines = F.slice(lines, 1, F.size(lines) - 1)
    rows = raw.select(F.col("_metadata.file_path").alias("file"), F.posexplode(lines).alias("line_no", "line"))
    parsed = rows.where(F.trim("line") != "").select("file", "line_no", F.from_json("line", METRIC_SCHEMA).alias("m"))
    kind = (F.when(F.col("train_runtime").isNotNull(), "summary")
             .when(F.col("eval_loss").isNotNull(), "eval").when(F.col("loss").isNotNull(), "train")
             .otherwise("other"))
    return parsed.select("file", "line_no", "m.*").withColumn("kind", kind)


def read_metric_log(spark: SparkSession, path: str, whole_lines: bool = False) -> DataFrame:
    """Heterogeneous JSON lines -> (file, line_no, metrics..., kind).

    ``line_no`` is the position within the file, so "last line wins"
    de-duplication has a total order without a global sort: each file is
    read whole by one task (``wholetext``), split into lines and posexploded. A
    log of a training run is some megabytes; many logs are many tasks.
    """
    return metric_rows(spark.read.text(path, wholetext=True), whole_lines)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower=None, upper=None, num_partitions: int = 8, predicates=None, **props) -> DataFrame:
    """Relational source. With a numeric partition column the read is split into
    ``num_partitions`` range queries; explicit ``predicates`` also work."""
    if predicates:
        if partition_column is not None:
            raise ValueError("give a partition column or predicates, not both")
        return spark.read.jdbc(url, table, predicates=predicates, properties=props)
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()
