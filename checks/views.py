"""The given tables as flights, aircraft data and trajectories.

``*_SQL`` are the same views for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyload.operators.course import FlightRows
from skyload.operators.ordering import split_by_length
from skyload.session import configure
from skyload.settings import Course
from skyload.sources.aircraft import aircraft_table

COURSE = Course(ties=("event_id",))

AIRCRAFT_SQL = """
SELECT * FROM (VALUES
 (1,'B738',70530,162,3000,145),(2,'A333',230000,295,2000,145),(3,'B77W',351500,365,2000,149),
 (4,'B38M',82600,162,2500,145),(5,'A320',73900,150,2500,145),(6,'E190',45995,94,3400,138),
 (7,'CRJ9',38330,80,2500,140),(8,'A21N',97000,180,2000,145),(9,'A20N',79000,150,2200,145),
 (10,'B739',79015,177,3000,149),(11,'BCS3',69900,120,3100,165),(12,'E195',52290,100,3000,140),
 (13,'A321',83000,185,2500,145),(14,'A359',268000,314,3000,150),(15,'A319',64000,124,2500,135),
 (16,'A332',230000,253,2000,145),(17,'B788',228000,210,2700,165),(18,'B789',253000,406,3000,165),
 (19,'BCS1',63100,100,3500,140),(20,'B763',186880,269,3000,160),(21,'AT76',23000,78,1350,116),
 (22,'B772',247210,305,3000,170),(23,'B752',115680,200,3500,145)
) AS a(type_no, aircraft_type, mtow_kg, passengers, roc_initial_climb, v2_ias)
"""

FLIGHTS_SQL = """
SELECT o.o_orderkey AS flight_id,
       o.o_orderdate AS date,
       o.o_orderpriority AS callsign,
       cn.n_name AS adep, 'AP ' || cn.n_name AS name_adep, cr.r_name AS country_code_adep,
       sn.n_name AS ades, 'AP ' || sn.n_name AS name_ades, sr.r_name AS country_code_ades,
       o.o_orderdate AS actual_offblock_time,
       l.arrival_time AS arrival_time,
       coalesce(a.aircraft_type, 'ZZ' || substr(p.p_brand, 7)) AS aircraft_type,
       CASE o.o_orderstatus WHEN 'F' THEN 'H' WHEN 'O' THEN 'M' ELSE 'L' END AS wtc,
       c.c_mktsegment AS airline,
       l.qty * 10 AS flown_distance,
       o.o_totalprice + l.qty * 2000 AS tow
FROM orders o
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS arrival_time, sum(l_quantity) AS qty,
                  min(CASE WHEN l_linenumber = m THEN l_partkey END) AS partkey,
                  min(CASE WHEN l_linenumber = m THEN l_suppkey END) AS suppkey
           FROM (SELECT li.*, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS m FROM lineitem li) x
           GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON p.p_partkey = l.partkey
LEFT JOIN aircraft a ON a.type_no = CAST(substr(p.p_brand, 7) AS INT)
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey
LEFT JOIN region cr ON cr.r_regionkey = cn.n_regionkey
LEFT JOIN supplier s ON s.s_suppkey = l.suppkey
LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey
LEFT JOIN region sr ON sr.r_regionkey = sn.n_regionkey
"""

TRAJECTORY_SQL = """
SELECT user_id AS flight_id, event_id, ts AS "timestamp",
       600 * row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) + 10 * value - 1000 AS altitude,
       CAST(150 + event_id % 100 AS DOUBLE) AS groundspeed,
       CAST((event_id * 7) % 360 AS DOUBLE) AS track,
       CAST(500 + 20 * (event_id % 100) AS DOUBLE) AS vertical_rate,
       CAST(event_id % 21 - 10 AS DOUBLE) AS u_component_of_wind,
       CAST(event_id % 17 - 8 AS DOUBLE) AS v_component_of_wind,
       CAST(220 + event_id % 60 AS DOUBLE) AS temperature
FROM events
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# Type by brand number, 1 to 23; brands 24 and 25 have none.
TYPE_BY_BRAND = [
    "B738", "A333", "B77W", "B38M", "A320", "E190", "CRJ9", "A21N", "A20N", "B739", "BCS3", "E195",
    "A321", "A359", "A319", "A332", "B788", "B789", "BCS1", "B763", "AT76", "B772", "B752",
]


def aircraft(spark: SparkSession) -> DataFrame:
    """The built-in aircraft data, but for types that no brand stands for."""
    return aircraft_table(spark).where(F.col("aircraft_type").isin(TYPE_BY_BRAND))


def first_line(key: str) -> Column:
    """``key`` of the smallest line number: both as one number, as a hash aggregate cannot hold a struct."""
    shift = F.lit("100000000000000000000").cast("decimal(21,0)")
    both = (F.col("l_linenumber").cast("decimal(10,0)") * shift).cast("decimal(38,0)") + F.col(key).cast("decimal(19,0)")
    return F.pmod(F.min(both.cast("decimal(38,0)")), shift).cast("bigint")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a flight; its first line item tells aircraft and destination."""
    t = {n: table(spark, sf_dir, n) for n in "orders lineitem part customer supplier nation region".split()}
    lines = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("arrival_time"),
        F.sum("l_quantity").alias("qty"),
        first_line("l_partkey").alias("p_partkey"),
        first_line("l_suppkey").alias("s_suppkey"),
    )
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    brand = F.substring("p_brand", F.lit(7), F.length("p_brand"))
    known = F.try_element_at(F.array(*[F.lit(x) for x in TYPE_BY_BRAND]), brand.cast("int"))
    parts = t["part"].select("p_partkey", F.coalesce(known, F.concat(F.lit("ZZ"), brand)).alias("aircraft_type"))

    def port(role: str, key: str) -> DataFrame:
        return places.select(
            F.col("n_nationkey").alias(key),
            F.col("n_name").alias(role),
            F.concat(F.lit("AP "), "n_name").alias(f"name_{role}"),
            F.col("r_name").alias(f"country_code_{role}"),
        )

    customers = t["customer"].select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    joined = (
        t["orders"].join(lines, "o_orderkey", "left")
        .join(parts, "p_partkey", "left")
        .join(customers, "o_custkey", "left")
        .join(port("adep", "c_nationkey"), "c_nationkey", "left")
        .join(t["supplier"].select("s_suppkey", "s_nationkey"), "s_suppkey", "left")
        .join(port("ades", "s_nationkey"), "s_nationkey", "left")
    )
    status = F.col("o_orderstatus")
    return joined.select(
        F.col("o_orderkey").alias("flight_id"),
        F.col("o_orderdate").alias("date"),
        F.col("o_orderpriority").alias("callsign"),
        "adep", "name_adep", "country_code_adep",
        "ades", "name_ades", "country_code_ades",
        F.col("o_orderdate").alias("actual_offblock_time"),
        "arrival_time",
        "aircraft_type",
        F.when(status == "F", "H").when(status == "O", "M").otherwise("L").alias("wtc"),
        F.col("c_mktsegment").alias("airline"),
        (F.col("qty") * 10).alias("flown_distance"),
        (F.col("o_totalprice") + F.col("qty") * 2000).alias("tow"),
    )


def trajectory(spark: SparkSession, sf_dir: str, course: Course = COURSE) -> DataFrame:
    """An event is a point of its user's flight; altitude climbs with the point's number."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("flight_id"), "event_id", F.col("ts").alias("timestamp"), "value"
    )
    usual, long = split_by_length(events, course.key, course.long_rows)
    numbered = FlightRows.whole(usual, course).frame
    if long is not None:
        numbered = numbered.unionByName(FlightRows.numbered(long, course))
    event = F.col("event_id")
    return numbered.select(
        "flight_id", "event_id", "timestamp",
        (600 * (F.col("row_no") + 1) + 10 * F.col("value") - 1000).alias("altitude"),
        (150 + event % 100).cast("double").alias("groundspeed"),
        ((event * 7) % 360).cast("double").alias("track"),
        (500 + 20 * (event % 100)).cast("double").alias("vertical_rate"),
        (event % 21 - 10).cast("double").alias("u_component_of_wind"),
        (event % 17 - 8).cast("double").alias("v_component_of_wind"),
        (220 + event % 60).cast("double").alias("temperature"),
    )
