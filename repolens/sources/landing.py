"""Readers for landed API JSON (SRC-01..06).

Landing layout (one folder per entity; page files hold a JSON array of
objects, as the API returns them; an empty page ``[]`` adds nothing):

    <landing>/repositories/*.json
    <landing>/commits/repo=<owner%2Fname>/*.json
    <landing>/pull_requests/repo=<owner%2Fname>/*.json
    <landing>/reviews/repo=<owner%2Fname>/*.json         (one object per pull request, see below)
    <landing>/reviews/repo=<owner%2Fname>/pr_number=<n>/*.json
    <landing>/languages/repo=<owner%2Fname>/*.json      (one object per file)

The repository and PR number come from the folder names (the request, not
the payload); Spark's partition discovery turns them into columns and
unescapes ``%2F`` to ``/``.  One ``read`` per entity covers all
repositories and pages: the file-level union of pages is the reader's.
An explicit schema ignores unknown fields and gives NULL for missing ones.

A reviews file directly below its repository holds the pages of many pull
requests, each in an envelope that names it:
``[{"pr_number": 7, "reviews": [...]}, ...]``.  So the number of files to list
follows the pages, not the pull requests; folders by number are read as well.

``read_files`` reads given files only and lets malformed ones through, marked:
a run (``plans.refresh.run_ingest``) fails their repository alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import instant_wallclock
from ..schemas import JSON_SCHEMAS, LANDED_AT, REVIEW_ENVELOPE

REPO_PARTITION = "repo"


def _entity_dir(landing: str, entity: str) -> str:
    return f"{landing.rstrip('/')}/{entity}"


def _with_path_columns(schema: T.StructType, *cols: tuple[str, T.DataType]) -> T.StructType:
    out = T.StructType(list(schema.fields))
    for name, dtype in cols:
        out = out.add(name, dtype)
    return out


def _read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # FAILFAST: a malformed page fails the entity step (as a parse error
    # fails the source step) instead of becoming a row of NULLs
    return (spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
            .option("basePath", path).option("recursiveFileLookup", False)
            .json(path))


def read_repositories_json(spark: SparkSession, landing: str) -> DataFrame:
    """SRC-01."""
    return _read_pages(spark, _entity_dir(landing, "repositories"), JSON_SCHEMAS["repositories"])


def read_commits_json(spark: SparkSession, landing: str, author_login: str | None = None) -> DataFrame:
    """SRC-02: optionally only one author's commits."""
    schema = _with_path_columns(JSON_SCHEMAS["commits"], (REPO_PARTITION, T.StringType()))
    df = _read_pages(spark, _entity_dir(landing, "commits"), schema).withColumnRenamed(REPO_PARTITION, "repo_full_name")
    return df if author_login is None else df.filter(F.col("author.login") == author_login)


def read_pull_requests_json(spark: SparkSession, landing: str) -> DataFrame:
    """SRC-03: every state (open, closed, merged)."""
    schema = _with_path_columns(JSON_SCHEMAS["pull_requests"], (REPO_PARTITION, T.StringType()))
    return _read_pages(spark, _entity_dir(landing, "pull_requests"), schema) \
        .withColumnRenamed(REPO_PARTITION, "repo_full_name")


def read_reviews_json(spark: SparkSession, landing: str) -> DataFrame:
    """SRC-04: reviews tagged with repository and PR number, from the envelope
    or from the path."""
    path = _entity_dir(landing, "reviews")
    raw = (spark.read.schema(REVIEW_ENVELOPE).option("multiLine", True).option("mode", "FAILFAST")
           .option("recursiveFileLookup", True).json(path).withColumn("_file", file_path()))
    return reviews_of_envelopes(raw).drop("_file")


def reviews_of_envelopes(pages: DataFrame) -> DataFrame:
    """One row a review, with repo_full_name and pr_number; an envelope without
    reviews gives none."""
    own = F.struct(*[F.col(f.name) for f in JSON_SCHEMAS["reviews"].fields])
    folder = F.regexp_extract("_file", r"/pr_number=(\d+)/", 1)
    each = F.when(F.col("reviews").isNotNull(), F.col("reviews")).when(F.col("id").isNotNull() | (folder != ""), F.array(own))
    rest = [c for c in pages.columns if c not in REVIEW_ENVELOPE.names and c != "repo_full_name"]
    return pages.select(
        repo_of("_file").alias("repo_full_name"),
        F.coalesce("pr_number", F.when(folder != "", folder).cast("bigint")).alias("pr_number"),
        F.explode(each).alias("_review"), *rest).select("repo_full_name", "pr_number", "_review.*", *rest)


def language_map(body: Column) -> Column:
    """language -> bytes of a body; an empty body or ``null`` is an empty map,
    a malformed one fails the step (as a malformed page does)."""
    parsed = F.from_json(body, T.MapType(T.StringType(), T.LongType()), {"mode": "FAILFAST"})
    given = ~F.trim(F.regexp_replace(body, r"\s+", " ")).isin("", "null")
    return F.coalesce(F.when(given, parsed), F.create_map().cast("map<string,bigint>"))


def read_languages_json(spark: SparkSession, landing: str) -> DataFrame:
    """SRC-05: one object per repository with dynamic keys (language ->
    bytes), parsed as a map."""
    path = _entity_dir(landing, "languages")
    raw = (spark.read.option("wholetext", True).option("basePath", path).text(path))
    return raw.select(F.col(REPO_PARTITION).cast("string").alias("repo_full_name"),
                      language_map(F.col("value")).alias("languages"))


READERS = {
    "repositories": read_repositories_json,
    "commits": read_commits_json,
    "pull_requests": read_pull_requests_json,
    "reviews": read_reviews_json,
    "languages": read_languages_json,
}


# ------------------------------------------------------------------ chosen files
BROKEN = "_broken"


def _unescaped(x: Column) -> Column:
    """%XX decoded, "+" left alone (paths are no forms)."""
    return F.url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))


def file_path() -> Column:
    """Path of a row's file as a listing gives it."""
    return _unescaped(F.col("_metadata.file_path"))


def repo_of(path: str) -> Column:
    """owner/name from the folder ``repo=<owner%2Fname>``; NULL without one."""
    name = F.regexp_extract(path, r"/repo=([^/]+)/", 1)
    return F.when(name != "", _unescaped(name))


def landed_files(spark: SparkSession, landing: str, entity: str) -> DataFrame:
    """The files of an entity: path, modified, repoFullName.  Names only, no
    content is read."""
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
              .load(_entity_dir(landing, entity)))
    return listed.select("path", F.col("modificationTime").alias("modified"), repo_of("path").alias("repoFullName"))


def files_schema(entity: str) -> T.StructType:
    """Columns of ``read_files``."""
    if entity == "languages":
        own = [T.StructField("languages", T.MapType(T.StringType(), T.LongType()))]
    else:
        own = (REVIEW_ENVELOPE if entity == "reviews" else JSON_SCHEMAS[entity]).fields
    return T.StructType([*own, T.StructField("_file", T.StringType()), T.StructField(LANDED_AT, T.TimestampNTZType()),
                         T.StructField(BROKEN, T.BooleanType()), T.StructField("repo_full_name", T.StringType())])


def read_files(spark: SparkSession, entity: str, files: list[str]) -> DataFrame:
    """Objects of the given files, with their file, when it landed, and
    whether it is malformed (``files_schema``)."""
    names = files_schema(entity).names
    if not files:
        return spark.createDataFrame([], files_schema(entity))
    if entity == "languages":
        text = spark.read.option("wholetext", True).text(files)
        body = F.col("value")
        given = ~F.trim(F.regexp_replace(body, r"\s+", " ")).isin("", "null")
        parsed = F.from_json(body, T.MapType(T.StringType(), T.LongType()))
        empty = F.create_map().cast("map<string,bigint>")
        df = text.withColumn("languages", F.when(given, parsed).otherwise(empty)).withColumn(BROKEN, F.col("languages").isNull())
    else:
        own = REVIEW_ENVELOPE if entity == "reviews" else JSON_SCHEMAS[entity]
        df = (spark.read.schema(T.StructType([*own.fields, T.StructField(BROKEN, T.StringType())]))
              .option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BROKEN)
              .json(files).withColumn(BROKEN, F.col(BROKEN).isNotNull()))
    df = df.withColumn("_file", file_path()).withColumn(
        LANDED_AT, instant_wallclock(F.col("_metadata.file_modification_time")))
    return df.withColumn("repo_full_name", repo_of("_file")).select(*names)


def objects(entity: str, pages: DataFrame) -> DataFrame:
    """Rows of ``read_files`` as the flattening functions take them."""
    return reviews_of_envelopes(pages) if entity == "reviews" else pages
