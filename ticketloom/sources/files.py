"""Readers of landed JSON and writers of results."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketloom.sources.json_array import read_json_array

ATTACHMENT = T.StructType([T.StructField("FileName", T.StringType()), T.StructField("Url", T.StringType()), T.StructField("Size", T.LongType())])
COMMENT = T.StructType([T.StructField("CommentDate", T.StringType()), T.StructField("Body", T.StringType()), T.StructField("UserName", T.StringType()), T.StructField("Attachments", T.ArrayType(ATTACHMENT))])
TICKET = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("ticket_id", "CategoryName", "IssueDate", "Subject", "Body", "Status", "Url")]
    + [T.StructField("Attachments", T.ArrayType(ATTACHMENT)), T.StructField("kommentare", T.ArrayType(COMMENT))]
)
ARTICLE = T.StructType(
    [T.StructField("ArticleId", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("Subject", "Body", "BodyMarkdown", "CategoryName", "TagString", "UrlId", "DateCreated", "LastUpdated", "Url")]
    + [T.StructField("ForTechsOnly", T.BooleanType()), T.StructField("CategoryID", T.IntegerType()), T.StructField("Tags", T.ArrayType(T.StringType())), T.StructField("Attachments", T.ArrayType(ATTACHMENT))]
)
CHAPTER = T.StructType([T.StructField("index", T.LongType()), T.StructField("title", T.StringType()), T.StructField("content", T.StringType()), T.StructField("char_count", T.LongType()), T.StructField("token_estimate", T.LongType())])


def _envelope(spark: SparkSession, path: str, keys: tuple[str, ...], item: T.StructType, strict: bool) -> DataFrame:
    """Items of files that hold {key: [...]} or a top-level array, in (file, position) order.

    Files are read whole, one task a file: land them as many files, and as Parquet after this."""
    info = T.StructType([T.StructField("api_base_url", T.StringType())])
    objects = T.StructType([T.StructField(k, T.ArrayType(item)) for k in keys] + [T.StructField("export_info", info)])
    text = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"))
    array = F.ltrim("value").startswith("[")
    parsed = text.select(
        "file",
        F.when(array, F.from_json("value", T.ArrayType(item))).alias("listed"),
        F.when(~array, F.from_json("value", objects)).alias("held"),
    )
    items = F.coalesce("listed", *[f"held.{k}" for k in keys])
    if strict:
        items = F.coalesce(items, F.raise_error(F.concat(F.lit("no list of items in "), F.col("file"))).cast(T.ArrayType(item)))
    rows = parsed.select("file", F.col("held.export_info.api_base_url").alias("api_base_url"), F.posexplode(items).alias("pos", "item"))
    return rows.select("file", "pos", "api_base_url", "item.*")


def read_tickets(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Tickets with ``ord``; other shapes are an error, or nothing where strict is off. Files of any size: each is
    read element by element, by as many tasks as it has splits."""
    from ticketloom.functions.columns import with_ordinal

    rows = read_json_array(spark, path, TICKET, ("tickets", "data"), strict)
    return with_ordinal(rows, ["file", "split", "pos"], "ord", slots=64).drop("file", "split", "pos")


def read_articles(spark: SparkSession, path: str, base_url: str = "") -> DataFrame:
    from ticketloom.functions.columns import with_ordinal

    rows = _envelope(spark, path, ("articles",), ARTICLE, True).withColumn("base_url", F.coalesce("api_base_url", F.lit(base_url))).drop("api_base_url")
    return with_ordinal(rows, ["file", "pos"], "ord", slots=64).drop("file", "pos")


def read_chapter_dir(spark: SparkSession, folder: str) -> DataFrame:
    """Chapters of all .json files of a folder by file name; files that cannot be read give none."""
    schema = T.StructType([T.StructField("source_file", T.StringType()), T.StructField("chapters", T.ArrayType(CHAPTER))])
    read = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json").option("ignoreCorruptFiles", True).json(folder)
    return read.select(F.col("_metadata.file_name").alias("file_name"), "source_file", F.explode("chapters").alias("c")).select("file_name", "source_file", "c.*").orderBy("file_name", "index")


def write_export(tickets: DataFrame, path: str, kind: str = "parquet") -> None:
    """The rows, and one row of totals beside them."""
    from ticketloom.operators.reports import export_stats

    tickets.write.format(kind).save(f"{path}/tickets")
    export_stats(tickets).withColumn("exported_at", F.current_timestamp().cast("string")).coalesce(1).write.json(f"{path}/export_info")


def write_review_csv(pairs: DataFrame, path: str) -> None:
    cols = ["ticket_id_A", "ticket_id_B", "similarity", "subject_A", "subject_B"]
    pairs.withColumn("similarity", F.format_string("%.4f", "similarity")).select(cols).write.option("sep", ";").option("header", True).option("encoding", "UTF-8").csv(path)


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Document blocks, one folder for each output document."""
    blocks.write.partitionBy("doc_file").parquet(path)


class PublishError(ValueError):
    """What was written is not what should be published."""


_POINTER = "CURRENT"


def _store(spark: SparkSession, path: str):
    """(file system, Path class, path) of a folder in any store that Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def publish_json(df: DataFrame, path: str) -> str:
    """Publish df as normalised JSON lines: written to a folder of its own under path, parsed back and counted
    there, and only then named in the pointer that readers follow, by one rename. Returns the version's name.
    Rows that do not come back as they were counted stop the publish; readers keep the version before."""
    from ticketloom.operators.replies import write_json_normalised

    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    seen = Observation("written")
    write_json_normalised(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{path}/{version}")
    rows = seen.get["rows"]
    check_published(spark, f"{path}/{version}", df.schema, rows)
    files, place = _store(spark, path)
    fresh = place(f"{path}/_next-{version}")
    out = files.create(fresh, True)
    out.write(json.dumps({"version": version, "rows": rows, "schema": df.schema.jsonValue()}).encode())
    out.close()
    jvm = spark._jvm
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(fresh).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(fresh), files.makeQualified(place(f"{path}/{_POINTER}")), overwrite)
    return version


def check_published(spark: SparkSession, folder: str, schema: T.StructType, rows: int) -> None:
    """Every line of a folder parses as the schema, and there are as many as were written; else an error."""
    corrupt = "_corrupt_line"
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])).option("columnNameOfCorruptRecord", corrupt).json(folder)
    # all columns are asked for, so that none is left unparsed
    size = F.length(F.to_json(F.struct(*[F.col(c) for c in schema.names])))
    found = read.agg(F.count(F.lit(1)).alias("rows"), F.count(corrupt).alias("bad"), F.sum(size)).first()
    if found["rows"] != rows or found["bad"]:
        raise PublishError(f"{folder}: {found['rows']} of {rows} rows, {found['bad']} of them not readable")


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The version that is published now; one that lost rows since is an error."""
    pointer = spark.read.option("wholetext", True).text(f"{path}/{_POINTER}").first()["value"]
    now = json.loads(pointer)
    schema = T.StructType.fromJson(now["schema"])
    check_published(spark, f"{path}/{now['version']}", schema, now["rows"])
    return spark.read.schema(schema).json(f"{path}/{now['version']}")
