"""Station and trip rows derived from the star-schema test tables.

The mapping reaches the branches clean input never does: padded and mixed-case ids, repeated and
missing keys, unknown and inactive stations, missing times, negative durations, re-sent events.
Ids are padded to a width that no scale factor exceeds, so distinct keys stay distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.lookup import BroadcastBudget
from tripmill.schemas import STATION_COLUMNS, TRIP_COLUMNS

# The columns used here, with the types the files have.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}
# A station lookup row is four columns: an id of 14 characters, two labels that the tables keep
# below 40 characters, and a number. A test holds the bound against the measured payload.
LOOKUP_ROW_BYTES = 128
# How many trips one task builds and keeps, where that takes more tasks than there are cores.
TRIPS_PER_TASK = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def padded(prefix: str, number: Column, suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 12, "0"), F.lit(suffix))


def station_budget(spark: SparkSession, sf_dir: str) -> BroadcastBudget:
    """Broadcast budget with the lookup's size bounded from the table's row count (file footers).

    A bound beyond the limit proves nothing, so such a lookup is measured.
    """
    bound = 2 * table(spark, sf_dir, "supplier").count() * LOOKUP_ROW_BYTES
    known = bound if bound <= BroadcastBudget.limit_bytes else None
    return BroadcastBudget(known_bytes=known)


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per supplier, a second version of every tenth, and two rejects per region."""
    supplier, nation = (table(spark, sf_dir, name) for name in ("supplier", "nation"))
    number = F.col("s_suppkey")
    launch = F.date_add(F.lit("2020-01-01").cast("date"), (number % 1500).cast("int"))

    def version(station_id, name, capacity, launch_date):
        return F.struct(
            station_id.alias("station_id"),
            name.alias("station_name"),
            (F.lit(49) + (number % 500) / F.lit(1000)).alias("latitude"),
            (F.lit(-123) + (number % 700) / F.lit(1000)).alias("longitude"),
            capacity.cast("int").alias("capacity"),
            F.concat("n_name", F.lit(" ")).alias("neighbourhood"),
            (F.col("s_acctbal") > 2000).alias("is_active"),
            launch_date.alias("launch_date"),
        )

    name = F.concat(F.lit(" "), F.col("s_name"))
    first = version(padded(" st", number, " "), name, 20 + number % 23, launch)
    second = version(
        padded("ST", number), F.concat(name, F.lit(" v2")), F.lit(99), F.date_sub(launch, 365)
    )
    versions = F.when(number % 10 == 0, F.array(first, second)).otherwise(F.array(first))
    stations = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.inline(versions)
    )
    blank = table(spark, sf_dir, "region").select(
        F.explode(F.array(F.lit("   "), F.lit(None).cast("string"))).alias("station_id")
    )
    return stations.unionByName(blank, allowMissingColumns=True).select(*STATION_COLUMNS)


def raw_station_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four versions of every station, launched nine days apart over the time of the trips.

    Some have no launch date, some are repeated with another name, some stations are closed by a
    version.
    """
    number = F.col("s_suppkey")

    def version(turn: int) -> Column:
        days = (number * 7 + turn * 9) % 36
        launch = F.date_add(F.lit("2023-12-27").cast("date"), days.cast("int"))
        if turn == 0:
            launch = F.when(number % 13 != 0, launch)
        return F.struct(
            padded(" st", number, " ").alias("station_id"),
            F.concat("s_name", F.lit(f" r{turn}")).alias("station_name"),
            (10 + (number + 5 * turn) % 30).cast("int").alias("capacity"),
            F.concat(F.lit(" N"), (number % 5).cast("string")).alias("neighbourhood"),
            ((number + turn) % 4 != 0).alias("is_active"),
            launch.alias("launch_date"),
        )

    versions = F.array(*[version(turn) for turn in range(4)])
    rows = table(spark, sf_dir, "supplier").select(F.inline(versions))
    renamed = rows.filter("capacity % 7 = 0").withColumn(
        "station_name", F.concat("station_name", F.lit(" b"))
    )
    return rows.unionByName(renamed).select(
        *[F.col(c) if c in rows.columns else F.lit(0.0).alias(c) for c in STATION_COLUMNS]
    )


def station_closures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two closures of every station, of 2 to 38 hours, by normalised station id."""
    number = F.col("s_suppkey")

    def closure(later: int) -> Column:
        hour = number * 5 % 28 * 24 + number % 24 + later
        start = F.timestamp_seconds(F.unix_seconds(F.lit("2024-01-01").cast("timestamp")) + hour * 3600)
        end = F.timestamp_seconds(F.unix_seconds(start) + (number % 7 * 6 + 2) * 3600)
        return F.struct(start.alias("closed_from"), end.alias("closed_to"))

    return table(spark, sf_dir, "supplier").select(
        padded("ST", number).alias("station_id"), F.inline(F.array(closure(0), closure(31)))
    )


def station_slots(spark: SparkSession, sf_dir: str) -> Column:
    """Number of station ids trips refer to: every supplier and two that do not exist."""
    return table(spark, sf_dir, "supplier").agg(F.count("*") + 2).scalar()


def build_tasks(spark: SparkSession, events: DataFrame) -> int:
    """Tasks that build trips: two a core, or more for many events (counted from file footers).

    The session's number of shuffle partitions would also be that of the tasks that write the next
    shuffle, each with a file for every one of its partitions.
    """
    return max(2 * spark.sparkContext.defaultParallelism, events.count() // TRIPS_PER_TASK)


def iso(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def raw_trips(spark: SparkSession, sf_dir: str, resent: str | None = None) -> DataFrame:
    """One trip per event as landed text rows.

    `resent` adds a second copy of every twentieth event: "later" an hour later with another user
    type, "exact" without any change.
    """
    started = F.col("ts").cast("timestamp")
    seconds = F.floor(F.col("value") * 60)
    signed = F.when(F.col("event_id") % 41 == 0, -seconds).otherwise(seconds)
    # A row group is read by one task; what follows costs far more than reading and is spread.
    stored = table(spark, sf_dir, "events")
    tasks = build_tasks(spark, stored)
    events = stored.repartition(tasks, "event_id", "ts", "user_id").select(
        F.col("event_id"),
        F.col("user_id"),
        F.col("event_type"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        started.alias("started"),
        iso(started).alias("created"),
        F.timestamp_micros(F.unix_micros(started) + signed * 1_000_000).alias("ended"),
        station_slots(spark, sf_dir).alias("slots"),
    )
    event, k, slots = F.col("event_id"), F.col("k"), F.col("slots")
    trip = [
        F.when(event % 97 != 0, F.concat(F.lit("trip_"), event.cast("string"))).alias("trip_id"),
        padded("bk", k).alias("bike_id"),
        padded("user_", F.col("user_id")).alias("user_id"),
        F.when(F.col("event_type").isin("purchase", "signup"), "Member ")
        .otherwise("casual")
        .alias("user_type"),
        F.when(k % 2 == 0, "Classic").otherwise("e-bike").alias("bike_type"),
        F.when(event % 89 != 0, padded("st", event * 7 % slots)).alias("start_station_id"),
        padded("st", (event * 7 + k % 5) % slots).alias("end_station_id"),
        F.col("created").alias("start_time"),
        F.when(event % 53 != 0, iso(F.col("ended"))).alias("end_time"),
        F.col("created").alias("event_created_at"),
    ]
    sent = F.array(F.struct(*trip))
    if resent is not None:
        later = {
            "user_type": F.lit("MEMBER"),
            "event_created_at": iso(F.col("started") + F.expr("INTERVAL 1 HOUR")),
        }
        changes = later if resent == "later" else {}
        copy = [
            changes[name].alias(name) if name in changes else column
            for name, column in zip(TRIP_COLUMNS, trip)
        ]
        sent = F.when(event % 20 == 0, F.array(F.struct(*trip), F.struct(*copy))).otherwise(sent)
    # Generated rows, like landed ones, are computed once and not again in pushed-down filters.
    return events.select(F.inline(sent))


def odd_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with some start times in far years and some unreadable creation times."""
    event = F.coalesce(F.regexp_extract("trip_id", r"([0-9]+)", 1).try_cast("long"), F.lit(1))
    rest = F.substring("start_time", 5, 40)
    far = (
        F.when(event % 31 == 0, F.concat(F.lit("12345"), rest))
        .when(event % 37 == 0, F.concat(F.lit("0000"), rest))
        .otherwise(F.col("start_time"))
    )
    created = F.when(event % 43 == 0, F.lit("unreadable")).otherwise(F.col("event_created_at"))
    return raw_trips(spark, sf_dir).withColumns({"start_time": far, "event_created_at": created})


def malformed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(F.concat(F.lit("{broken "), "r_name").alias("value"))


def raw_trips_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per line item; (order, line number) repeats, so trip ids have natural duplicates."""
    part = F.col("l_partkey")
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    shipped = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    start = shipped + part % 24 * 3600
    end = start + F.col("l_quantity").cast("long") * 60
    trip = [
        F.concat_ws("-", F.lit("line"), "l_orderkey", "l_linenumber").alias("trip_id"),
        padded("bk", part).alias("bike_id"),
        padded("user_", F.col("o_custkey")).alias("user_id"),
        F.when(F.col("l_returnflag") == "R", "Member ").otherwise("casual").alias("user_type"),
        F.when(F.col("l_linestatus") == "O", "Classic").otherwise("e-bike").alias("bike_type"),
        padded("st", F.col("l_suppkey")).alias("start_station_id"),
        padded("st", part % station_slots(spark, sf_dir)).alias("end_station_id"),
        iso(F.timestamp_seconds(start)).alias("start_time"),
        iso(F.timestamp_seconds(end)).alias("end_time"),
        iso(F.timestamp_seconds(shipped)).alias("event_created_at"),
    ]
    return lines.select(*trip)
