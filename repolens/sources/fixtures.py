"""Raw tables derived from the driver's tables (there is no landed GitHub data).

Role map: customer = repository, orders = pull request, lineitem = review,
events = commit, part.p_brand = language.  A ``snap`` column of 0/1 makes
repeated snapshots so that de-duplication has work to do; years of
order/line dates are shifted by 26 so that they fall inside the date
dimension.  Every function here is a narrow projection or an equi-join:
snapshots are generated with ``explode`` (no cross join), joins are left
to Catalyst/AQE (the inputs grow with scale, so nothing is forced to
broadcast).

What lands holds faulty rows (``LANDED_BUILDERS``): some have no REQUIRED key,
so the load rejects them and they are missing from the raw tables
(``RAW_BUILDERS``).  A rejected repository leaves commits and pull requests
without one, a rejected pull request its reviews.  Some steps of the run log
fail (``step_error``), and the repositories are older than the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ingest import split_valid
from .tables import TableSet

# Fixed values that define the derived fixture (they must equal the
# oracle's SQL text): base instants and the year shift.
REPO_CREATED_BASE = "2020-06-01 00:00:00"
REPO_UPDATED_BASE = "2024-01-01 00:00:00"
SNAPSHOT_BASE = "2024-02-01 02:00:00"
YEAR_SHIFT = 26
REPO_SNAPSHOT_BASE = "2024-01-31 02:00:00"
# A landed row whose source key is divisible by this has no REQUIRED column.
FAULTY = {"repositories": 89, "commits": 97, "pull_requests": 101, "reviews": 103, "languages": 107}
FAILING_ENTITIES, FAILING_SUFFIX, STEP_ERROR = ("commits", "pull_requests"), "7", "502 Bad Gateway"


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _shift_years(col: Column) -> Column:
    return col + F.make_ym_interval(F.lit(YEAR_SHIFT), F.lit(0))


def _snapshots(keep_second: Column) -> Column:
    """0 for every row, plus 1 for rows where ``keep_second`` holds."""
    return F.explode(F.when(keep_second, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))


def _snapshot_ts(snap: Column) -> Column:
    return F.timestamp_add("HOUR", snap * 24, _ts(SNAPSHOT_BASE))


def _unless_faulty(entity: str, key: Column, value: Column) -> Column:
    return F.when(key % FAULTY[entity] != 0, value)


def step_error(entity: Column, repo: Column) -> Column:
    """Message of the (entity, repository) steps that failed; NULL for others."""
    return F.when(entity.isin(*FAILING_ENTITIES) & repo.endswith(FAILING_SUFFIX),
                  F.concat(F.lit(STEP_ERROR + ": "), repo))


def _repo_name(nationkey: Column, name: Column) -> Column:
    return F.concat(F.lit("org"), nationkey.cast("string"), F.lit("/"), name)


def landed_repositories(t: TableSet) -> DataFrame:
    cust = t("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    s = cust.withColumn("snap", _snapshots(F.col("c_custkey") % 3 == 0))
    k = F.col("c_custkey")
    return s.select(
        _unless_faulty("repositories", k, k).alias("id"),
        F.col("c_name").alias("name"),
        _repo_name(F.col("c_nationkey"), F.col("c_name")).alias("full_name"),
        F.concat(F.lit("org"), F.col("c_nationkey").cast("string")).alias("owner_login"),
        F.col("c_mktsegment").alias("language"),
        F.timestamp_add("HOUR", (k % 1000).cast("int"), _ts(REPO_CREATED_BASE)).alias("created_at"),
        F.timestamp_add("HOUR", F.col("snap"), _ts(REPO_UPDATED_BASE)).alias("updated_at"),
        F.when(k % 4 == 0, "private").otherwise("public").alias("visibility"),
        (k % 7 == 0).alias("fork"),
        (F.floor(F.abs(F.col("c_acctbal"))).cast("bigint") + F.col("snap")).alias("stargazers_count"),
        F.timestamp_add("HOUR", F.col("snap") * 24, _ts(REPO_SNAPSHOT_BASE)).alias("ingestion_timestamp"),
    )


def landed_commits(t: TableSet) -> DataFrame:
    ev = t("events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    cust = t("customer").select("c_custkey", "c_name", "c_nationkey")
    j = ev.join(cust, ev.user_id == cust.c_custkey, "inner")
    s = j.withColumn("snap", _snapshots(F.col("event_id") % 5 == 0))
    e, u = F.col("event_id"), F.col("user_id")
    dev = F.concat(F.lit("dev"), (u % 20).cast("string"))
    return s.select(
        _unless_faulty("commits", e, F.md5(e.cast("string"))).alias("sha"),
        _repo_name(F.col("c_nationkey"), F.col("c_name")).alias("repo_full_name"),
        dev.alias("author_name"),
        F.concat(dev, F.lit("@example.com")).alias("author_email"),
        F.col("ts").alias("author_date"),
        F.repeat(F.concat(F.col("event_type"), F.lit(" "), F.col("props"), F.lit(" ")),
                 (e % 12).cast("int") + 1).alias("message"),
        F.when(e % 10 == 0, F.lit(None)).otherwise(F.floor(F.col("value")).cast("bigint")).alias("additions"),
        F.when(e % 15 == 0, F.lit(None)).otherwise(e % 40).alias("deletions"),
        (e % 9).alias("changed_files"),
        _snapshot_ts(F.col("snap")).alias("ingestion_timestamp"),
    )


def landed_pull_requests(t: TableSet) -> DataFrame:
    o = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cust = t("customer").select("c_custkey", "c_name", "c_nationkey")
    j = o.join(cust, o.o_custkey == cust.c_custkey, "inner")
    s = j.withColumn("snap", _snapshots(F.col("o_orderkey") % 4 == 0))
    k = F.col("o_orderkey")
    created = _shift_years(F.col("o_orderdate"))
    updated = F.timestamp_add("MINUTE", (k % 9000).cast("int"), created)
    finished = F.col("o_orderstatus") == "F"
    return s.select(
        _unless_faulty("pull_requests", k, k).alias("number"),
        _repo_name(F.col("c_nationkey"), F.col("c_name")).alias("repo_full_name"),
        F.concat(F.lit("PR "), k.cast("string"), F.lit(" v"), F.col("snap").cast("string")).alias("title"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("Closed").alias("state"),
        F.concat(F.lit("dev"), (k % 20).cast("string")).alias("user_login"),
        created.alias("created_at"),
        updated.alias("updated_at"),
        F.when(finished, updated).alias("merged_at"),
        F.when(finished, F.md5(k.cast("string"))).alias("merge_commit_sha"),
        _snapshot_ts(F.col("snap")).alias("ingestion_timestamp"),
    )


def _orders_of_customers(t: TableSet, *columns: str) -> DataFrame:
    """Orders with their customer's columns: joined before the line items, which
    are then shuffled once."""
    o = t("orders").select("o_orderkey", "o_custkey", *columns)
    cust = t("customer").select("c_custkey", "c_name", "c_nationkey")
    return o.join(cust, o.o_custkey == cust.c_custkey, "inner")


def landed_reviews(t: TableSet) -> DataFrame:
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              "l_returnflag", "l_linestatus", "l_shipdate")
    o = _orders_of_customers(t, "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    rf = F.col("l_returnflag")
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return j.select(
        _unless_faulty("reviews", key, key).alias("id"),
        _repo_name(F.col("c_nationkey"), F.col("c_name")).alias("repo_full_name"),
        F.col("l_orderkey").alias("pr_number"),
        F.concat(F.lit("dev"), F.col("l_suppkey").cast("string")).alias("user_login"),
        F.when(rf == "A", "approved").when(rf == "N", "COMMENTED").otherwise("Changes_Requested").alias("state"),
        F.timestamp_add("HOUR", (F.col("l_partkey") % 200).cast("int"),
                        _shift_years(F.col("o_orderdate"))).alias("submitted_at"),
        F.when(F.col("l_linestatus") == "O", F.lit(None))
         .otherwise(F.concat(F.lit("part "), F.col("l_partkey").cast("string"))).alias("body"),
        _shift_years(F.col("l_shipdate")).alias("ingestion_timestamp"),
    )


def landed_languages(t: TableSet) -> DataFrame:
    li = t("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    o = _orders_of_customers(t)
    p = t("part").select("p_partkey", "p_brand")
    # brands first: the repository's name is then shuffled once, with the sums
    j = (li.join(p, li.l_partkey == p.p_partkey, "inner").select("l_orderkey", "p_brand", "l_quantity", "l_shipdate")
           .join(o, F.col("l_orderkey") == o.o_orderkey, "inner"))
    g = j.groupBy("c_nationkey", "c_name", "p_brand", F.year("l_shipdate").alias("y")).agg(
        F.sum("l_quantity").alias("q"), F.max("l_shipdate").alias("last_ship"))
    return g.select(
        _repo_name(F.col("c_nationkey"), F.col("c_name")).alias("repo_full_name"),
        F.col("p_brand").alias("language_name"),
        F.col("q").cast("bigint").alias("byte_count"),
        _unless_faulty("languages", F.col("q").cast("bigint"), _shift_years(F.col("last_ship"))).alias("ingestion_timestamp"),
    )


LANDED_BUILDERS = {
    "raw_repositories": landed_repositories,
    "raw_commits": landed_commits,
    "raw_pull_requests": landed_pull_requests,
    "raw_reviews": landed_reviews,
    "raw_languages": landed_languages,
}


def accepted(landed: DataFrame, table: str) -> DataFrame:
    """The landed rows that the load accepts."""
    return split_valid(landed, table)[0]


RAW_BUILDERS = {table: (lambda t, _build=build, _table=table: accepted(_build(t), _table))
                for table, build in LANDED_BUILDERS.items()}


def raw_tables(t: TableSet) -> dict[str, DataFrame]:
    return {k: f(t) for k, f in RAW_BUILDERS.items()}
