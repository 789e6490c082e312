"""The canonical post: nested, with scores, a delivery status and lossless platform data; and the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..functions import rules
from ..functions.textops import is_blank
from ..sources.files import ordered_lines

SCORE = "struct<model_name:string,task:string,value:double>"

#: A canonical post as a line of JSON; what is a variant may hold anything.
POST = (
    f"id string, platform string, text string, url string, published_at timestamp, scoring array<{SCORE}>, status struct<state:string>, feedback int, "
    "metadata struct<source:struct<path:string,url:string,name:string>,user_id:string,parsed_at:timestamp,raw_file:string,platform_data:variant,schema_version:int>"
)


def unknown_keys(value: Column, kind: DataType, at: str = "") -> Column:
    """Paths, as a.b or list[].c, of the keys of a variant that the type hasn't, at any depth; what the type has as no struct, or the value as no object, isn't looked into. The walk is over the type, so it ends, and is one expression. Null gives none."""
    none = F.array().cast("array<string>")
    if isinstance(kind, ArrayType):
        if not isinstance(kind.elementType, ArrayType | StructType):
            return none
        each = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: unknown_keys(v, kind.elementType, f"{at}[]"))
        return F.coalesce(F.array_distinct(F.flatten(each)), none)
    if not isinstance(kind, StructType):
        return none
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    own = F.array_except(F.map_keys(fields), F.array(*map(F.lit, kind.names)))
    own = F.coalesce(F.transform(own, lambda k: F.concat(F.lit(f"{at}." if at else ""), k)), none)
    below = [unknown_keys(F.try_element_at(fields, F.lit(f.name)), f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields if isinstance(f.dataType, ArrayType | StructType)]
    return F.concat(own, *below)


def post_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, ordinal, line, the post's columns, unknown (paths of keys that a post hasn't; null where the line is no JSON object) and outcome: record, or what is wrong first: json, extra, or a field. Blank lines are skipped."""
    kind = spark.createDataFrame([], POST).schema
    lines = ordered_lines(spark, path).where(~is_blank(F.col("line"))).withColumn("_given", F.try_parse_json("line"))
    is_object = F.try_variant_get("_given", "$", "map<string,variant>").isNotNull()
    lines = lines.withColumn("unknown", F.when(is_object, unknown_keys(F.col("_given"), kind)))
    lines = lines.withColumn("_post", F.from_json("line", kind)).select("file", "ordinal", "line", "_post.*", "unknown")
    first = [rules.Rule("json", F.col("unknown").isNull()), rules.Rule("extra", F.size("unknown") > 0)]
    return lines.withColumn("outcome", F.coalesce(rules.first_failure([*first, *rules.envelope_rules()]), F.lit("record")))


def post_id(platform: Column, *identity: Column) -> Column:
    return F.concat(platform, F.lit(":"), F.sha2(F.concat_ws("\x1f", *(c.cast("string") for c in identity)), 256))


def score(model: str, task: str, value: Column) -> Column:
    return F.struct(F.lit(model).alias("model_name"), F.lit(task).alias("task"), value.cast("double").alias("value"))


def envelope(
    platform: Column, text: Column, identity: list[Column], source_path: Column, user_id: Column, parsed_at: Column, raw_file: Column, platform_data: Column,
    url: Column | None = None, published_at: Column | None = None, scoring: Column | None = None, source_url: Column | None = None, source_name: Column | None = None,
) -> list[Column]:
    """The columns of a canonical post; platform_data is JSON and kept as a variant."""
    none = F.lit(None).cast("string")
    source = F.struct(source_path.alias("path"), (none if source_url is None else source_url).alias("url"), (none if source_name is None else source_name).alias("name"))
    return [
        post_id(platform, *identity).alias("id"),
        platform.alias("platform"),
        text.alias("text"),
        (none if url is None else url).alias("url"),
        (F.lit(None) if published_at is None else published_at).cast("timestamp").alias("published_at"),
        (F.array().cast(f"array<{SCORE}>") if scoring is None else scoring).alias("scoring"),
        F.struct(F.lit("parsed").alias("state")).alias("status"),
        F.lit(None).cast("int").alias("feedback"),
        F.struct(
            source.alias("source"), user_id.alias("user_id"), parsed_at.cast("timestamp").alias("parsed_at"), raw_file.alias("raw_file"), F.try_parse_json(platform_data).alias("platform_data"),
            F.lit(1).alias("schema_version"),
        ).alias("metadata"),
    ]


def write_posts(posts: DataFrame, table: str) -> None:
    """Canonical posts as a Parquet table by platform, one row for each id: a post that is there already stays as it is."""
    new = posts.dropDuplicates(["id"])
    spark = posts.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(table)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        new = new.join(spark.read.parquet(table).select("id"), "id", "left_anti")
    new.write.mode("append").partitionBy("platform").parquet(table)


def source_type(path: Column) -> Column:
    return F.split_part(path, F.lit("/"), F.lit(1))


def best(scoring: Column, task: str) -> Column:
    """The highest value of a task's scores; null without any."""
    return F.array_max(F.transform(F.filter(scoring, lambda s: s["task"] == task), lambda s: s["value"]))


def outbox(posts: DataFrame, sent: DataFrame, task: str, threshold: float) -> DataFrame:
    """Posts at or above the threshold that sent (ids) doesn't have."""
    return posts.where(best(F.col("scoring"), task) >= threshold).join(sent.select("id").distinct(), "id", "left_anti")
