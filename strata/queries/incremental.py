"""Layers that are followed row by row, batch by batch and part by part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.contracts import FLIGHTS_CONFORM, Column
from strata.functions import with_provenance
from strata.lake import DatasetRef
from strata.operators import (
    column_drift,
    conform_events,
    conform_flights,
    differing_rows,
    file_schemas,
    gold_lineage,
    lineage,
    merge_profiles,
    profile_parts,
    provenance,
    read_profile,
    require_lineage,
    rows_per_key,
    state_deviation,
    state_mean,
)
from strata.operators.sketches import TOP_ERROR
from strata.plans.events import EVENTS
from strata.plans.flights import FLIGHTS, FLIGHTS_GOLD, run_flights
from strata.plans.incremental import ingest_new, merged_gold, update_states
from strata.queries.base import (
    EVENTS_TABLE,
    FLIGHTS_CTE,
    LOADED_AT,
    events,
    flights,
    query,
    rounded,
    rounded_sql,
    sample_events,
    staged_flights,
    table,
)
from strata.queries.checks import TEXT_FLIGHTS
from strata.queries.layers import landed_events
from strata.sinks import compact, file_bins, read_batches, write_layer
from strata.sources import list_files, read_layer, read_partitioned
from strata.streaming import (
    corrected_throughput,
    run_available,
    run_throughput,
    stream_files,
    to_silver_or_quarantine,
)
from strata.workspace import scratch_lake

DELAYS = ("arr_delay_minutes", "dep_delay_minutes")

BY_FLAG = FLIGHTS_CTE.replace("FROM lineitem", ", 'staging/' || l_returnflag AS source_file FROM lineitem")


@query(
    """
WITH bronze AS (SELECT event_id, CAST(ts AS DATE) AS event_date FROM events),
silver AS (
  SELECT * FROM bronze WHERE event_id > (SELECT min(event_id) FROM bronze)
  UNION ALL SELECT * FROM bronze WHERE event_id = (SELECT max(event_id) FROM bronze))
SELECT event_id, event_date, count(*) AS left_rows, CAST(0 AS BIGINT) AS right_rows
FROM (SELECT * FROM bronze EXCEPT ALL SELECT * FROM silver) GROUP BY ALL
UNION ALL
SELECT event_id, event_date, count(*), count(*) + 1
FROM (SELECT * FROM silver EXCEPT ALL SELECT * FROM bronze) GROUP BY ALL
"""
)
def reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver that lost its first event and has its last one twice, so that counts agree.

    A doubled row is on the left once, so SQL sees it as one more on the right.
    """
    lake, landed = scratch_lake(spark, "rows"), landed_events(spark, sf_dir)
    bronze = conform_events(read_partitioned(spark, landed.path(EVENTS), {"dt": "string"}))
    bronze = bronze.drop("ingest_ts")
    first, last = bronze.agg(F.min("event_id"), F.max("event_id")).first()
    damaged = bronze.where(F.col("event_id") > first).unionByName(
        bronze.where(F.col("event_id") == last)
    )
    silver = lake.path(EVENTS.at("silver"))
    write_layer(damaged, silver, partition_by=["event_date"])
    found = differing_rows(
        bronze,
        read_layer(spark, silver),
        ["event_id", "event_date"],
        by=["event_date"],
        identity=["event_id"],
    )
    return found.drop("bucket").select(
        "event_id", "event_date", F.col("left_rows").cast("bigint"), F.col("right_rows").cast("bigint")
    )


def _flights_of_three_sources(spark: SparkSession, sf_dir: str, label: str):
    """Bronze and silver of flights that came from a source per flag, and gold's provenance."""
    lake = scratch_lake(spark, label)
    bronze, silver = lake.path(FLIGHTS), lake.path(FLIGHTS.at("silver"))
    source = F.concat(F.lit("staging/"), F.col("origin"))
    landed = with_provenance(flights(spark, sf_dir), "", LOADED_AT).withColumn("source_file", source)
    write_layer(landed, bronze)
    write_layer(conform_flights(read_layer(spark, bronze)), silver, reads=[bronze])
    gold = f"{lake.path(FLIGHTS_GOLD)}_sources"
    write_layer(provenance(read_layer(spark, silver), ["carrier"]), gold)
    return read_layer(spark, bronze), read_layer(spark, silver), read_layer(spark, gold)


@query(
    BY_FLAG
    + """
SELECT op_unique_carrier AS carrier, source_file, count(*) AS row_count FROM flights GROUP BY ALL
"""
)
def gold_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each source gave to each carrier's metrics."""
    return _flights_of_three_sources(spark, sf_dir, "provenance")[2].drop("last_ingest_ts")


@query(
    BY_FLAG
    + """
SELECT layer, source_file, count(*) AS row_count
FROM flights, (VALUES ('bronze'), ('silver'), ('gold')) l(layer) GROUP BY ALL
"""
)
def lineage_all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per source in every layer, gold's from its provenance; they must agree."""
    bronze, silver, sources = _flights_of_three_sources(spark, sf_dir, "lineage_all")
    report = lineage({"bronze": bronze, "silver": silver}).unionByName(gold_lineage(sources))
    require_lineage(report)
    return report.drop("last_ingest_ts")


@query(
    """
SELECT CAST(ts AS DATE) AS event_date, count(*) AS event_count
FROM events
GROUP BY 1
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY
"""
)
def stream_late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that arrive in three parts, the middle ones first and the first ones last.

    Windows and the corrections of what came late are together what a batch job counts.
    """
    lake = scratch_lake(spark, "late")
    rows = events(spark, sf_dir)
    low, high = rows.agg(F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first()
    third = F.floor((F.unix_seconds("ts") - low) * 3 / (high - low + 1))
    source, target = f"{lake.root}/arriving", lake.path(DatasetRef("gold", "demo", "throughput"))
    for part in (1, 2, 0):
        write_layer(rows.where(third == part), source, mode="append")
        arriving = stream_files(spark, source, EVENTS_TABLE)
        run_throughput(arriving, target, lake.checkpoint_path("corrected_throughput"))
    return corrected_throughput(read_layer(spark, target)).select("event_date", "event_count")


@query(
    """
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS carrier,
       count(*) FILTER (WHERE l_quantity >= 3) AS silver_rows,
       count(*) FILTER (WHERE l_quantity < 3) AS quarantine_rows
FROM lineitem GROUP BY 1
"""
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights with text among the delays as a stream; the second run finds nothing new."""
    lake = scratch_lake(spark, "quarantine")
    source = f"{lake.root}/arriving"
    dirty = table(spark, sf_dir, "lineitem").selectExpr(*TEXT_FLIGHTS)
    dirty = with_provenance(dirty, "arriving", LOADED_AT)
    write_layer(dirty, source)
    columns = [Column(f.name, f.dataType.simpleString()) for f in dirty.schema]
    silver, aside = lake.path(FLIGHTS.at("silver")), lake.quarantine_path(FLIGHTS)
    for _ in range(2):
        bronze = stream_files(spark, source, columns)
        checkpoint = lake.checkpoint_path("flights_gate")
        run_available(to_silver_or_quarantine(bronze, FLIGHTS_CONFORM, silver, aside, checkpoint))
    kept = read_layer(spark, silver).select("carrier", F.lit(1).alias("kept"))
    rejected = read_layer(spark, aside).select(
        F.col("op_unique_carrier").alias("carrier"), F.lit(0).alias("kept")
    )
    return kept.unionByName(rejected).groupBy("carrier").agg(
        F.count_if(F.col("kept") == 1).alias("silver_rows"),
        F.count_if(F.col("kept") == 0).alias("quarantine_rows"),
    )


@query(
    f"""
WITH f AS (SELECT *, strftime(l_shipdate, '%Y-%m') AS flight_month FROM lineitem),
changed AS (SELECT * FROM f
  WHERE flight_month > (SELECT min(flight_month) FROM f) OR l_linenumber = 1)
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS carrier, count(*) AS flight_count,
       {rounded_sql("avg(CASE WHEN l_quantity <= 45 THEN l_tax * 100 END)", 6)} AS avg_arr_delay,
       {rounded_sql("avg(CASE WHEN l_quantity <= 45 THEN l_quantity END)", 6)} AS avg_dep_delay,
       {rounded_sql("stddev_samp(CASE WHEN l_quantity <= 45 THEN l_tax * 100 END)", 6)} AS std_arr_delay,
       {rounded_sql("stddev_samp(CASE WHEN l_quantity <= 45 THEN l_quantity END)", 6)} AS std_dep_delay
FROM changed GROUP BY 1
"""
)
def gold_incremental_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay spread from stored monthly states, after one month's silver changed.

    Only that month is read again; the others come from their states.
    """
    lake = scratch_lake(spark, "states")
    silver, states = lake.path(FLIGHTS.at("silver")), lake.states_path(FLIGHTS_GOLD)
    month = F.date_format("l_shipdate", "yyyy-MM").alias("flight_month")
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("carrier"),
        F.expr("CASE WHEN l_quantity <= 45 THEN l_quantity END").alias("dep_delay_minutes"),
        F.expr("CASE WHEN l_quantity <= 45 THEN l_tax * 100 END").alias("arr_delay_minutes"),
        "l_linenumber",
        month,
    )
    write_layer(rows, silver, partition_by=["flight_month"])

    def update(parts=None):
        stored = read_partitioned(spark, silver, {"flight_month": "string"})
        update_states(stored, states, "flight_month", ["carrier"], DELAYS, parts)

    update()
    first = rows.agg(F.min("flight_month")).first()[0]
    changed = rows.where((F.col("flight_month") == first) & (F.col("l_linenumber") == 1))
    write_layer(changed, silver, partition_by=["flight_month"], dynamic=True)
    update([first])
    merged = merged_gold(spark, states, "flight_month", [Column("carrier", "string")], DELAYS)
    gold = merged.select(
        "carrier",
        F.col("row_count").alias("flight_count"),
        state_mean("arr_delay_minutes").alias("avg_arr_delay"),
        state_mean("dep_delay_minutes").alias("avg_dep_delay"),
        state_deviation("arr_delay_minutes").alias("std_arr_delay"),
        state_deviation("dep_delay_minutes").alias("std_dep_delay"),
    )
    return gold.select("carrier", "flight_count", *[rounded(c, 6) for c in gold.columns[2:]])


@query(
    """
SELECT CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS batch_id,
       l_returnflag AS origin, count(*) AS row_count
FROM lineitem GROUP BY ALL
"""
)
def ingest_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files that arrive in two drops: each is taken once, and a run in between takes none."""
    lake = scratch_lake(spark, "drops")
    rows, source = flights(spark, sf_dir), f"{lake.root}/staging/flights"
    for late in (False, True):
        drop = rows.where((F.col("origin") == "R") == F.lit(late))
        drop.write.mode("append").option("header", True).csv(source)
        for _ in range(2):
            ingest_new(spark, lake, FLIGHTS, source, LOADED_AT)
    return read_batches(spark, lake, FLIGHTS).groupBy("batch_id", "origin").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS row_count, TRUE AS fewer_files
FROM events GROUP BY 1
"""
)
def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that landed in eight drops, each with files of its own, become few files again."""
    lake = scratch_lake(spark, "compact")
    rows, path = sample_events(spark, sf_dir), lake.path(EVENTS)
    for k in range(8):
        part = rows.where(F.pmod("event_id", F.lit(8)) == k)
        write_layer(part, path, partition_by=["dt"], mode="append")
    before = file_bins(spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("n"))
    before = {r.folder: r.n for r in before.collect()}
    compact(spark, path, "dt")
    after = file_bins(spark, path).groupBy("folder").agg(F.count(F.lit(1)).alias("n")).collect()
    fewer = all(r.n < before[r.folder] or before[r.folder] == 1 for r in after)
    return rows_per_key(read_partitioned(spark, path, {"dt": "string"}), "dt").withColumn(
        "fewer_files", F.lit(fewer)
    )


@query(
    """
WITH early AS (SELECT * FROM lineitem
  WHERE year(l_shipdate) < (SELECT max(year(l_shipdate)) FROM lineitem)),
long AS (
  SELECT 'l_quantity' AS column_name, l_quantity AS v, CAST(l_quantity AS VARCHAR) AS t FROM early
  UNION ALL SELECT 'l_suppkey', l_suppkey, CAST(l_suppkey AS VARCHAR) FROM early
  UNION ALL SELECT 'l_returnflag', NULL, l_returnflag FROM early)
SELECT column_name, count(*) AS row_count, count(t) AS non_null_count, min(v) AS least,
       max(v) AS most, TRUE AS distinct_within, TRUE AS median_within, TRUE AS top_within
FROM long GROUP BY 1
"""
)
def profile_of_a_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years but the last, profiled from stored sketches; the estimates lie within their bounds.

    The exact counts beside them are what the bounds are checked against.
    """
    lake = scratch_lake(spark, "sketches")
    columns = ["l_quantity", "l_suppkey", "l_returnflag"]
    lines = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    path = f"{lake.root}/profiles"
    write_layer(profile_parts(lines, ["year"], columns), path, partition_by=["year"])
    last = lines.agg(F.max("year")).first()[0]
    merged = merge_profiles(read_layer(spark, path).where(F.col("year") < last))
    found = read_profile(merged, quantiles=[0.5], top=1)

    long = lines.where(F.col("year") < last).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(c).cast("string").alias("t"),
                        (F.lit(None) if c == "l_returnflag" else F.col(c)).cast("double").alias("v"),
                    )
                    for c in columns
                ]
            )
        )
    )
    asked = found.select(
        "column_name",
        F.col("quantile_values")[0].alias("median"),
        F.get("top_values", F.lit(0))["item"].alias("top"),
    )
    # Three rows of estimates meet every distinct value once.
    values = long.groupBy("column_name", "t", "v").agg(F.count(F.lit(1)).alias("n"))
    numbers = F.sum(F.when(F.col("v").isNotNull(), F.col("n")))

    def share(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0)) / numbers

    exact = values.join(F.broadcast(asked), "column_name").groupBy("column_name").agg(
        F.count("t").alias("exact_distinct"),
        share(F.col("v") < F.col("median")).alias("below"),
        share(F.col("v") <= F.col("median")).alias("up_to"),
        F.sum(F.when(F.col("t") == F.col("top"), F.col("n"))).alias("exact_top"),
        F.max(F.when(F.col("t").isNotNull(), F.col("n")).otherwise(0)).alias("most_often"),
    )
    distinct_within = F.abs(F.col("distinct_count") - F.col("exact_distinct")) <= F.greatest(
        F.lit(1), 0.08 * F.col("exact_distinct")
    )
    median_within = (F.col("below") <= 0.55) & (F.col("up_to") >= 0.45)
    # Where no value is frequent enough to be listed, the most frequent one must be below that.
    bound = TOP_ERROR * F.col("row_count")
    counted = F.get("top_values", F.lit(0))["count"]
    top_within = F.when(counted.isNull(), F.col("most_often") <= 2 * bound).otherwise(
        F.abs(counted - F.coalesce("exact_top", F.lit(0))) <= bound
    )
    return found.join(exact, "column_name").select(
        "column_name",
        "row_count",
        "non_null_count",
        "least",
        "most",
        distinct_within.alias("distinct_within"),
        F.coalesce(median_within, F.lit(True)).alias("median_within"),
        top_within.alias("top_within"),
    )


@query(
    """
WITH kinds(column_name, data_type, flags, flags_without) AS (VALUES
  ('l_orderkey', 'int64', 'ANR', ''), ('l_quantity', 'double', 'AN', ''),
  ('l_quantity', 'string', 'R', ''), ('l_tax', 'double', 'A', 'NR'))
SELECT column_name, data_type, count(*) AS row_count,
       flags_without <> '' AS missing_somewhere
FROM kinds JOIN lineitem ON contains(flags, l_returnflag) GROUP BY ALL
"""
)
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three producers in one folder, one with text for a number, one with a column more."""
    lake = scratch_lake(spark, "drift")
    lines, path = table(spark, sf_dir, "lineitem"), f"{lake.root}/mixed"
    text = F.col("l_quantity").cast("string").alias("l_quantity")
    for flag, columns in {
        "A": ["l_orderkey", "l_quantity", "l_tax"],
        "N": ["l_orderkey", "l_quantity"],
        "R": [text, "l_orderkey"],
    }.items():
        write_layer(lines.where(F.col("l_returnflag") == flag).select(*columns), path, mode="append")
    found = column_drift(file_schemas(spark, path))
    return found.select(
        "column_name", "data_type", "row_count", (F.col("files_without") > 0).alias("missing_somewhere")
    )


@query("SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, TRUE AS has_bytes FROM events")
def list_files_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file of the landing folders, by listing alone."""
    lake = landed_events(spark, sf_dir)
    files = list_files(spark, lake.path(EVENTS))
    day = F.regexp_extract("file_path", "/dt=([^/]*)/", 1)
    return files.groupBy(day.alias("dt")).agg((F.min("file_bytes") > 0).alias("has_bytes"))


@query(
    FLIGHTS_CTE
    + f"""
SELECT op_unique_carrier AS carrier, count(*) AS flight_count,
       {rounded_sql("avg(arr_delay_new)", 6)} AS avg_arr_delay_minutes
FROM flights GROUP BY 1
"""
)
def resumed_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights flow run twice: the second time every step is skipped, rows are compared too."""
    lake = scratch_lake(spark, "resumed")
    source = staged_flights(spark, sf_dir, lake)
    for _ in range(2):
        run_flights(spark, lake, source, "staging/flights", LOADED_AT, resume=True, check_rows=True)
    gold = read_layer(spark, lake.path(FLIGHTS_GOLD))
    return gold.select("carrier", "flight_count", rounded("avg_arr_delay_minutes", 6))
