"""Registered queries over the supplied tables, with the SQL that they are held against.

Supplied tables stand for the domain's: events are series (a user is an item), orders are catalogue entries, customers
samples and nations projects, line items pattern nodes (an order is an image), embeddings spectra and images.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import chunks, exact, geometry, masks, text
from .functions import time as times
from .operators import align, laue, linking, ml, pattern, stats, symmetry
from .plans import rollup
from .plans.tables import dealt, folder
from .sources import catalogue, files, graphs, keywords, series, spectra
from .streaming import chunk_store, frames, items
from .streaming.poll import Poll

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- series and alignment -------------------------------------------------------------------------------------------


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as long rows, with a metric ``unit`` on which all items agree."""
    e = table(spark, sf_dir, "events")
    own = e.select(F.col("user_id").cast("string").alias("data_id"), F.lit("events").alias("domain"), F.col("user_id").alias("item_pos"), F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), F.explode(F.array(F.struct(F.col("event_type").alias("metric"), F.col("value")), F.struct(F.lit("unit").alias("metric"), F.lit(1.0).alias("value")))).alias("m"))
    return own.select("data_id", "domain", "item_pos", "seq", "time_us", "m.metric", "m.value")


def hourly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as long rows by the hour, one item a type: items that share many times."""
    hour = F.unix_micros(F.date_trunc("hour", F.col("ts").cast("timestamp")))
    metric = F.explode(F.array(F.struct(F.lit("v").alias("metric"), F.col("value")), F.struct(F.lit("unit").alias("metric"), F.lit(1.0).alias("value"))))
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("event_type").alias("data_id"), F.lit("events").alias("domain"), F.length("event_type").alias("item_pos"), F.col("event_id").alias("seq"), hour.alias("time_us"), metric.alias("m"))
    return rows.select("data_id", "domain", "item_pos", "seq", "time_us", "m.metric", "m.value")


_HOURLY = "e AS (SELECT event_type AS user_id, event_id, 'v' AS event_type, value, epoch_us(date_trunc('hour', ts)) AS t FROM events),"
_EVENTS = """
e AS (SELECT user_id, event_id, event_type, value, epoch_us(ts) AS t FROM events),
f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, t ORDER BY event_id) = 1),
gap AS (SELECT user_id, t - lag(t) OVER (PARTITION BY user_id ORDER BY t) AS gap FROM f),
med AS (SELECT user_id, median(gap) AS m FROM gap WHERE gap IS NOT NULL GROUP BY user_id),
step AS (SELECT CAST(floor(greatest((SELECT median(m) FROM med), 500000, (SELECT (max(t) - min(t)) / 1000000 FROM f))) AS BIGINT) AS step)"""

_BINNED = """
g AS (SELECT min(t) - min(t) % 86400000000 AS origin, (SELECT step FROM step) AS step FROM r),
b AS (SELECT user_id, metric, origin + ((t - origin) // step) * step AS bin_us, value FROM (
        SELECT user_id, event_type AS metric, t, value FROM r UNION ALL SELECT user_id, 'unit', t, 1.0 FROM r), g),
m AS (SELECT user_id, metric, bin_us, avg(value) AS value FROM b GROUP BY ALL)"""

_MERGED = """
n AS (SELECT metric, count(DISTINCT user_id) AS items FROM m GROUP BY metric),
c AS (SELECT metric, max(d) AS d FROM (SELECT metric, bin_us, count(DISTINCT value) AS d FROM m GROUP BY metric, bin_us) GROUP BY metric),
v AS (SELECT metric, items >= 2 AND d <= 1 AS ok FROM n JOIN c USING (metric))
SELECT user_id::VARCHAR AS data_id, 'events' AS domain, metric, bin_us, round(value, 6) AS value FROM m JOIN v USING (metric) WHERE NOT ok
UNION ALL
SELECT 'shared', 'events', metric, bin_us, round(arg_min(value, user_id), 6) FROM m JOIN v USING (metric) WHERE ok GROUP BY metric, bin_us"""


def _aligned(how: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = hourly_rows if how == "inner" else event_rows
        return align.align(rows(spark, sf_dir), how).withColumn("value", F.round("value", 6))

    return run


for _how, _kept in {
    "outer": "SELECT * FROM f",
    "inner": "SELECT * FROM f WHERE t IN (SELECT t FROM f GROUP BY t HAVING count(DISTINCT user_id) = (SELECT count(DISTINCT user_id) FROM f))",
    "left": "SELECT * FROM f WHERE t IN (SELECT t FROM f WHERE user_id = (SELECT min(user_id) FROM f))",
    "right": "SELECT * FROM f WHERE t IN (SELECT t FROM f WHERE user_id = (SELECT max(user_id) FROM f))",
}.items():
    _name = "align_merge" if _how == "outer" else f"align_{_how}"
    QUERIES[_name] = _aligned(_how)
    _first = _EVENTS.replace(_EVENTS.splitlines()[1], _HOURLY) if _how == "inner" else _EVENTS
    ORACLE_SQL[_name] = f"WITH {_first},\nr AS ({_kept}),{_BINNED},{_MERGED}"


def fraction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as long rows with metrics of ordinary fractions: on two of them all users agree, on one all but one user."""
    e = table(spark, sf_dir, "events")
    odd = F.when(F.col("user_id") == 1, 0.7000001).otherwise(0.7)
    metrics = [F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value")) for name, value in (("third", F.lit(0.34)), ("tenth", F.lit(0.1)), ("seventh", odd), ("own", F.col("value")))]
    rows = e.select(F.col("user_id").cast("string").alias("data_id"), F.lit("events").alias("domain"), F.col("user_id").alias("item_pos"), F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), F.explode(F.array(*metrics)).alias("m"))
    return rows.select("data_id", "domain", "item_pos", "seq", "time_us", "m.metric", "m.value")


@query(f"""
WITH {_EVENTS},
r AS (SELECT * FROM f),
g AS (SELECT min(t) - min(t) % 86400000000 AS origin, (SELECT step FROM step) AS step FROM r),
b AS (SELECT user_id, metric, origin + ((t - origin) // step) * step AS bin_us, value FROM (
        SELECT user_id, 'own' AS metric, t, value FROM r UNION ALL SELECT user_id, 'third', t, 0.34 FROM r UNION ALL SELECT user_id, 'tenth', t, 0.1 FROM r
        UNION ALL SELECT user_id, 'seventh', t, CASE WHEN user_id = 1 THEN 0.7000001 ELSE 0.7 END FROM r), g),
m AS (SELECT user_id, metric, bin_us, round(avg(value), 12) AS value FROM b GROUP BY ALL),{_MERGED}""")
def align_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users whose metrics agree, or nearly do, in values that no double holds; counts of rows in a bin differ by user."""
    return align.align(fraction_rows(spark, sf_dir)).withColumn("value", F.round("value", 6))


@query(f"""
WITH {_EVENTS},
g AS (SELECT min(t) - min(t) % 86400000000 AS origin, (SELECT step FROM step) AS step, min(t) AS lo, max(t) AS hi FROM f),
k AS (SELECT user_id, metric, unnest(generate_series(origin + ((lo - origin) // step) * step, origin + ((hi - origin) // step) * step, step)) AS bin_us FROM (SELECT DISTINCT user_id, event_type AS metric FROM f UNION SELECT DISTINCT user_id, 'unit' FROM f), g),
b AS (SELECT user_id, metric, origin + ((t - origin) // step) * step AS bin_us, value FROM (
        SELECT user_id, event_type AS metric, t, value FROM f UNION ALL SELECT user_id, 'unit', t, 1.0 FROM f), g),
a AS (SELECT user_id, metric, bin_us, avg(value) AS value FROM b GROUP BY ALL),
m AS (SELECT user_id, metric, bin_us, value FROM k LEFT JOIN a USING (user_id, metric, bin_us)),{_MERGED}""")
def align_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users on every bin of the common grid, empty ones as nulls; a merged metric has each bin once."""
    return align.align(event_rows(spark, sf_dir), dense=True).withColumn("value", F.round("value", 6))


@query(ORACLE_SQL["align_merge"])
def project_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of the samples of all projects, aligned together; users are spread over fifty samples and two projects."""
    rows = event_rows(spark, sf_dir)
    ids = table(spark, sf_dir, "events").select("user_id").distinct()
    entry = ids.select(F.col("user_id").cast("string").alias("data_id"), (F.col("user_id") % 50).alias("physical_sample_id"), F.lit("s").alias("physical_sample_name"), F.lit("rheed_rotating").alias("char_source_type"), F.col("user_id").alias("seq"))
    samples = entry.select("physical_sample_id").distinct().withColumn("name", F.lit("sample"))
    bridge = samples.select((F.col("physical_sample_id") % 2).alias("project_id"), "physical_sample_id")
    return rollup.project_series(bridge, samples, entry, rows).withColumn("value", F.round("value", 6))


@query(f"WITH {_EVENTS} SELECT step AS step_us FROM step")
def infer_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.step(align.first_at_each_time(event_rows(spark, sf_dir)))


@query(f"WITH {_EVENTS} SELECT user_id::VARCHAR AS data_id, count(*) AS n, sum(gap)::BIGINT AS total_us FROM gap WHERE gap IS NOT NULL GROUP BY user_id")
def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.gaps(event_rows(spark, sf_dir)).groupBy("data_id").agg(F.count("*").alias("n"), F.sum("gap").alias("total_us"))


@query("""
WITH f AS (SELECT event_type AS metric, epoch_us(ts) AS t, value FROM events),
g AS (SELECT min(t) - min(t) % 86400000000 AS origin, 7200000000 AS step, max(t) AS hi, min(t) AS lo FROM f),
k AS (SELECT metric, unnest(generate_series(origin + ((lo - origin) // step) * step, origin + ((hi - origin) // step) * step, step)) AS bin_us FROM (SELECT DISTINCT metric FROM f), g),
m AS (SELECT metric, origin + ((t - origin) // step) * step AS bin_us, avg(value) AS value FROM f, g GROUP BY ALL)
SELECT metric, bin_us, round(value, 6) AS value FROM k LEFT JOIN m USING (metric, bin_us)
""")
def resample_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = spark.range(1).select(F.lit(7_200_000_000).alias("step_us"))
    return align.resample(event_rows(spark, sf_dir).filter("metric != 'unit'"), steps, ("metric",), dense=True).withColumn("value", F.round("value", 6))


_LABELLED = """
WITH f AS (SELECT 'user ' || user_id || ' | ' || event_type AS signal, epoch_us(ts) AS t, value FROM events WHERE event_type <> 'Frame Number'),
g AS (SELECT min(t) - min(t) % 86400000000 AS origin, 10800000000 AS step, max(t) AS hi, min(t) AS lo FROM f),
k AS (SELECT signal, unnest(generate_series(origin + ((lo - origin) // step) * step, origin + ((hi - origin) // step) * step, step)) AS t FROM (SELECT DISTINCT signal FROM f), g),
m AS (SELECT signal, origin + ((t - origin) // step) * step AS t, avg(value) AS v FROM f, g GROUP BY ALL),
d AS (SELECT signal, t, v, count(v) OVER w AS known, last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER w AS t0, last_value(v IGNORE NULLS) OVER w AS v0,
        first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER a AS t1, first_value(v IGNORE NULLS) OVER a AS v1
      FROM k LEFT JOIN m USING (signal, t)
      WINDOW w AS (PARTITION BY signal ORDER BY t ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY signal ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
p AS (SELECT *, row_number() OVER (PARTITION BY signal, known ORDER BY t) - 1 AS place FROM d)
SELECT signal, t AS bin_us, round(CASE WHEN v IS NOT NULL THEN v WHEN known > 0 AND place <= 4 THEN coalesce(v0 + (v1 - v0) * ((t - t0)::DOUBLE / (t1 - t0)::DOUBLE), v0) END, 9) AS value FROM p
"""


@query(_LABELLED)
def align_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled users on a three-hour step, gaps of up to twelve hours filled, on the grid of all their times."""
    return labelled(event_rows(spark, sf_dir))


@query(_LABELLED)
def align_labelled_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from frames as items have them: rows by label with the time as epoch milliseconds."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.concat(F.lit("user "), "user_id").alias("label"), F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), F.col("event_type").alias("metric"), "value")
    return align.align_labelled(rows, 10_800_000_000, 43_200_000_000).withColumn("value", F.round("value", 9))


def labelled(rows: DataFrame) -> DataFrame:
    named = rows.filter("metric != 'unit'").withColumn("label", F.concat(F.lit("user "), "data_id"))
    return align.align_labelled(named, 10_800_000_000, 43_200_000_000).withColumn("value", F.round("value", 9))


def part_of(number: str) -> Column:
    """A payload's part: it holds at most 4096 consecutive numbers, so no row grows with an item."""
    return F.floor(F.col(number) / 4096).alias("part")


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as payloads: blocks by type, each with its series; a long series takes several rows."""
    e = table(spark, sf_dir, "events")
    point = F.struct((F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("bigint").alias("unix_timestamp_ms"), F.col("event_id").alias("frame_number"), F.col("value").alias("specular_intensity"), F.lit(None).cast("double").alias("tar_metric"))
    blocks = e.groupBy("user_id", part_of("event_id"), "event_type").agg(F.collect_list(point).alias("series"))
    block = F.struct(F.length("event_type").cast("double").alias("angle"), F.col("series"))
    return blocks.groupBy(F.col("user_id").cast("string").alias("data_id"), "part").agg(F.collect_list(block).alias("series_by_angle")).drop("part")


@query("""
SELECT user_id::VARCHAR AS data_id, length(event_type)::DOUBLE AS "Angle", epoch_us(ts) // 1000 AS "UNIX Timestamp", event_id AS "Frame Number", value AS "Specular Intensity" FROM events
""")
def rheed_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.rheed(nested_events(spark, sf_dir))


@query("""SELECT user_id::VARCHAR AS data_id, event_id AS "Frame Number", value AS "Edge Perimeter", value * 2 AS "Edge Perimeter Z Score" FROM events""")
def optical_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    point = F.struct(F.col("event_id").alias("frame_number"), F.col("value").alias("perimeter_px"), (F.col("value") * 2).alias("perimeter_px_z_score"))
    payload = table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("data_id"), part_of("event_id")).agg(F.struct(F.collect_list(point).alias("series")).alias("series")).drop("part")
    return series.optical(payload)


@query("""SELECT user_id::VARCHAR AS data_id, event_id AS "Frame Number", CASE WHEN event_id % 2 = 0 THEN value ELSE value + 1 END AS "Median Period" FROM events""")
def metrology_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both spellings of the median period fill one column."""
    even = F.col("event_id") % 2 == 0
    point = F.struct(F.col("event_id").alias("frame_number"), F.when(even, F.col("value")).alias("median_period"), F.when(~even, F.col("value") + 1).alias("median_period_seconds"))
    return series.metrology(table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("data_id"), part_of("event_id")).agg(F.collect_list(point).alias("series")).drop("part"))


@query("""
SELECT user_id::VARCHAR AS data_id, event_id, CASE user_id % 4 WHEN 3 THEN epoch_us(ts) // 1000000 * 1000000 WHEN 2 THEN epoch_us(ts) // 1000 * 1000 ELSE epoch_us(ts) END AS time_us FROM events
""")
def epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs in ns, us, ms and s, by item; the unit is told from the item's largest value."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    unit = F.col("user_id") % 4
    whole = F.when(unit == 0, us.cast("decimal(20,0)") * 1000).when(unit == 1, us).when(unit == 2, F.floor(us / 1000)).otherwise(F.floor(us / 1_000_000))
    rows = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("data_id"), "event_id", whole.cast("decimal(20,0)").cast("string").alias("timestamp"))
    return times.absolute_times(rows, ["data_id"], "timestamp").select("data_id", "event_id", "time_us")


@query("""
WITH e AS (SELECT user_id::VARCHAR AS data_id, event_id AS seq, epoch_us(ts) // 1000 * 1000 AS time_us, value, event_type FROM events)
SELECT data_id, seq, time_us, 'Intensity' AS metric, value FROM e UNION ALL SELECT data_id, seq, time_us, 'Steady', (event_type <> 'error')::INT::DOUBLE FROM e
""")
def item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of items, with an absolute and a relative time, text and a flag among their columns, as long rows."""
    e = table(spark, sf_dir, "events")
    ms = F.expr("unix_micros(cast(ts as timestamp)) div 1000")
    frame = e.select(F.col("user_id").cast("string").alias("data_id"), F.lit("events").alias("domain"), F.col("user_id").alias("item_pos"), F.col("event_id").alias("seq"), ms.alias("unix_timestamp_ms"), (F.col("event_id") % 60).cast("double").alias("Relative Time"), F.col("value").alias("Intensity"), (F.col("event_type") != "error").alias("Steady"), F.col("event_type").alias("note"))
    rows = align.item_rows(frame)
    return rows.filter(F.col("metric") != "unix_timestamp_ms").select("data_id", "seq", "time_us", "metric", "value")


@query("SELECT event_id, epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT) AS time_us FROM events WHERE value IS NOT NULL")
def relative_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumnRenamed("value", "Relative Time")
    return e.select("event_id", times.since_upload(F.col("ts").cast("timestamp"), times.relative_seconds(e.columns)).alias("time_us")).filter("time_us IS NOT NULL")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) <= 3")
def last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.last_rows(table(spark, sf_dir, "events"), ["user_id"], "ts", 3).select("user_id", "event_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR event_type <> before")
def changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").withColumn("new", align.changed("event_type", order)).filter("new").select("user_id", "event_id", "event_type")


@query("SELECT user_id::VARCHAR AS data_id, 'img-' || event_id AS image_uuid, value AS timestamp_seconds FROM events WHERE event_type <> 'error'")
def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = F.struct(F.when(F.col("event_type") != "error", F.concat(F.lit("img-"), F.col("event_id"))).alias("image_uuid"), F.col("value").alias("timestamp_seconds"))
    return series.snapshots(table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("data_id"), part_of("event_id")).agg(F.collect_list(frame).alias("frames")).drop("part"))


# ---- catalogue ------------------------------------------------------------------------------------------------------


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as catalogue rows."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    rows = o.join(c, o["o_custkey"] == c["c_custkey"]).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    # nation has 25 rows at any scale
    kinds = F.array(*map(F.lit, ("rheed_rotating", "xps", "recipe", "optical", "sem")))
    project = F.array(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name")))
    return rows.select(
        F.col("o_orderkey").cast("string").alias("data_id"),
        F.concat(F.lit("file-"), "o_orderpriority").alias("raw_name"),
        F.element_at(kinds, (F.col("o_orderkey") % 5 + 1).cast("int")).alias("char_source_type"),
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "pending").otherwise("error").alias("pipeline_status"),
        F.when(F.col("o_orderkey") % 3 == 0, F.round("o_totalprice").cast("bigint")).alias("growth_length"),
        F.col("o_custkey").cast("string").alias("physical_sample_id"),
        F.col("c_name").alias("physical_sample_name"),
        F.when(F.col("o_orderkey") % 4 == 0, "NaT").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("detail_note_last_updated"),
        F.when(F.col("c_nationkey") % 2 == 0, project).otherwise(F.array().cast("array<struct<id:string,name:string>>")).alias("projects"),
        F.lit("u").alias("user_id"),
        F.col("c_mktsegment").alias("name"),
        F.col("o_orderdate").cast("timestamp").alias("upload_datetime"),
        F.col("o_orderkey").alias("seq"),
    )


_ENTRIES = """e AS (SELECT o_orderkey::VARCHAR AS data_id, 'file-' || o_orderpriority AS raw_name, ['rheed_rotating', 'xps', 'recipe', 'optical', 'sem'][(o_orderkey % 5 + 1)::INT] AS char_source_type,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pending' ELSE 'error' END AS pipeline_status, CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice)::BIGINT END AS growth_length,
  o_custkey::VARCHAR AS physical_sample_id, c_name AS physical_sample_name, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate::DATE::VARCHAR END AS note, CASE WHEN c_nationkey % 2 = 0 THEN n_nationkey::VARCHAR END AS project_id,
  CASE WHEN c_nationkey % 2 = 0 THEN n_name END AS project_name, c_mktsegment AS owner, o_orderdate, o_orderkey AS seq
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


@query(f"""WITH {_ENTRIES} SELECT data_id AS "Data ID", raw_name AS "File Name", char_source_type AS "Type", pipeline_status AS "Status", physical_sample_id AS "Physical Sample ID", physical_sample_name AS "Physical Sample Name",
project_id AS "Project ID", project_name AS "Project Name", growth_length AS "Growth Length", note AS "Sample Notes Last Updated", owner AS "Owner", seq FROM e""")
def catalogue_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.catalogue(entries(spark, sf_dir).drop("upload_datetime"))


@query(f"WITH {_ENTRIES} SELECT data_id FROM e WHERE char_source_type = 'xps' AND pipeline_status = 'success' AND growth_length >= 50000 AND growth_length <= 250000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND (lower(raw_name) LIKE '%high%' OR lower(raw_name) LIKE '%urgent%' OR lower(owner) LIKE '%high%' OR lower(owner) LIKE '%urgent%')")
def search_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime

    return catalogue.search(entries(spark, sf_dir), keywords=["High", "urgent"], data_type="xps", status="success", growth_length=(50_000, 250_000), upload_datetime=(datetime.datetime(1996, 1, 1, tzinfo=datetime.UTC), None)).select("data_id")


@query(f"WITH {_ENTRIES} SELECT data_id FROM e WHERE contains(lower(project_name), 'nation_12') OR owner ILIKE '%machin%'")
def search_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword that stands in the name of a nested project, and one in the owner's."""
    return catalogue.search(entries(spark, sf_dir), keywords=["Nation_12", "MACHIN"]).select("data_id")


@query(f"WITH {_ENTRIES} SELECT data_id, physical_sample_name FROM e WHERE physical_sample_name LIKE '%#000000042%' OR contains(lower(project_name), 'nation_12')")
def keyword_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search through an index of blocks by sample: one sample's name, and the name of a project."""
    path = folder(spark, "keywords")
    keywords.build(entries(spark, sf_dir), path, "physical_sample_name", 2000)
    return keywords.search(spark, path, ["#000000042", "Nation_12"]).select("data_id", "physical_sample_name")


@query(f"WITH {_ENTRIES} SELECT data_id, owner FROM e WHERE project_id IN ('0', '2', '4', '6', '8', '10', '12', '14', '16', '18', '20', '22') AND physical_sample_id::BIGINT BETWEEN 1 AND 100 AND owner = 'BUILDING'")
def search_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = catalogue.search(entries(spark, sf_dir), project_ids=list(range(0, 24, 2)), physical_sample_ids=range(1, 101), owner="BUILDING", include_organization_data=False)
    return found.select("data_id", F.col("name").alias("owner"))


@query("""SELECT c_custkey::VARCHAR AS "Physical Sample ID", c_name AS "Physical Sample Name", c_nationkey::VARCHAR AS "Project ID", n_name AS "Project Name", c_mktsegment AS material, round(c_acctbal, 2)::VARCHAR AS "Sample Notes", NULL::VARCHAR AS "Sample Notes Last Updated" FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def samples_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    rows = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.struct(F.col("c_mktsegment").alias("substrate"), F.lit("s").alias("sample_name"), F.lit(1).alias("other")).alias("target_material"),
        F.struct(text.two_places(F.col("c_acctbal")).alias("content"), F.lit("NaT").alias("last_updated")).alias("detail_notes"),
        F.array(F.struct(F.col("c_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))).alias("projects"),
        F.lit(1).alias("version"),
    )
    shown = catalogue.physical_samples(rows)
    return shown.withColumn("material", F.col("`Target Material`.substrate")).drop("Target Material")


@query("""SELECT n_nationkey::VARCHAR AS "Project ID", n_name AS "Project Name", count(c_custkey) AS "Physical Sample Count", n_name || '!' AS "Project Notes", NULL::VARCHAR AS "Project Notes Last Updated" FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def projects_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, c = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    count = c.groupBy("c_nationkey").agg(F.count("*").alias("physical_sample_count"))
    rows = n.join(count, F.col("n_nationkey") == F.col("c_nationkey"), "left").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"), F.coalesce("physical_sample_count", F.lit(0)).alias("physical_sample_count"), F.struct(F.concat("n_name", F.lit("!")).alias("content"), F.lit("NaT").alias("last_updated")).alias("detail_note"), F.lit("o").alias("owner_id"))
    return catalogue.projects(rows)


@query(f"WITH {_ENTRIES} SELECT raw_name, pipeline_status, char_source_type, physical_sample_id FROM e WHERE char_source_type = 'sem'")
def unknown_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.summary(catalogue.unknown_types(entries(spark, sf_dir)).drop("upload_datetime"))


@query("SELECT n_regionkey AS project_id, n_nationkey AS physical_sample_id FROM nation WHERE n_nationkey % 3 <> 0")
def project_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = F.struct(F.when(F.col("n_nationkey") % 3 != 0, F.col("n_nationkey")).alias("id"))
    return catalogue.project_samples(table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("project_id")).agg(F.collect_list(sample).alias("samples")))


@query("WITH w AS (SELECT o_orderkey AS data_id, min(l_linenumber + 7 * l_orderkey % 1000) AS pos FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) SELECT data_id, pos FROM w")
def requested_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("data_id"), (F.col("l_linenumber") + 7 * F.col("l_orderkey") % 1000).alias("pos"))
    return catalogue.in_order(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("data_id")), ids).select("data_id", "pos")


@query(f"""WITH {_ENTRIES} SELECT n_regionkey AS project_id, sample_name, CASE WHEN char_source_type LIKE 'rheed%' THEN 'rheed' WHEN char_source_type = 'recipe' THEN 'metrology' ELSE char_source_type END AS domain, count(*) AS n
FROM (SELECT e.*, c.c_name AS sample_name, n_regionkey FROM e JOIN customer c ON physical_sample_id = c_custkey::VARCHAR JOIN nation ON c_nationkey = n_nationkey) GROUP BY ALL""")
def project_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    samples = c.select(F.col("c_custkey").cast("string").alias("physical_sample_id"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name"))
    bridge = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("project_id"), F.col("c_custkey").cast("string").alias("physical_sample_id"))
    return rollup.project_entries(bridge, samples, entries(spark, sf_dir)).groupBy("project_id", "sample_name", "domain").agg(F.count("*").alias("n"))


@query("""SELECT 'items' AS kind, o_custkey::VARCHAR AS id, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'samples', c_nationkey::VARCHAR, count(DISTINCT c_custkey) FROM customer GROUP BY ALL""")
def rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("project_id"), F.col("c_custkey").alias("physical_sample_id"))
    items, samples = rollup.counts(bridge, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("physical_sample_id")))
    return items.select(F.lit("items").alias("kind"), F.col("physical_sample_id").cast("string").alias("id"), F.col("num_data_items").alias("n")).unionByName(samples.select(F.lit("samples").alias("kind"), F.col("project_id").cast("string").alias("id"), F.col("physical_sample_count").alias("n")))


@query("SELECT user_id, CASE WHEN user_id IN (SELECT DISTINCT user_id FROM events WHERE event_type = 'error') THEN 'series' ELSE 'none' END AS part FROM (SELECT DISTINCT user_id FROM events)")
def split_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("data_id"), "event_type")
    yes, no = rollup.split_results(e.select("data_id").distinct(), e.filter("event_type = 'error'"))
    return yes.withColumn("part", F.lit("series")).unionByName(no.withColumn("part", F.lit("none"))).withColumnRenamed("data_id", "user_id")


# ---- files and spectra ----------------------------------------------------------------------------------------------


@query("""SELECT doc_id, p AS part, (p - 1) * 1000 AS "offset", least(1000, n - (p - 1) * 1000)::BIGINT AS size FROM (SELECT doc_id, n_chars AS n, unnest(generate_series(1, CAST(ceil(n_chars / 1000) AS BIGINT))) AS p FROM documents WHERE n_chars > 0)""")
def file_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.parts(table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("length")), 1000).select("doc_id", "part", "offset", "size")


@query("SELECT l_orderkey AS upload_id, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey")
def part_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = files.completion(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("upload_id"), F.col("l_linenumber").alias("part"), F.col("l_partkey").alias("etag")))
    return done.select("upload_id", F.array_join(F.transform("parts", lambda p: F.concat_ws(":", p["part"].cast("string"), p["etag"].cast("string"))), ",").alias("parts"))


@query("SELECT p_partkey AS data_id, 'raw' AS kind, CASE WHEN p_size % 2 = 0 THEN p_name ELSE p_partkey || '.' || coalesce(CASE WHEN p_size % 3 = 0 THEN 'avi' END, 'mp4') END AS name FROM part")
def export_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return files.export_names(p.select(F.col("p_partkey").alias("data_id"), F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("file_name"), F.when(F.col("p_size") % 3 == 0, F.lit("avi")).alias("file_format")))


def _spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    values = F.transform("embedding", lambda x: x.cast("double"))
    axis = F.transform(F.sequence(F.lit(0), F.size("embedding") - 1), lambda i: i.cast("double"))
    return e.select(F.col("vec_id").alias("data_id"), axis.alias("axis"), values.alias("values"), "label")


@query("SELECT vec_id AS data_id, (i - 1)::INT AS pos, (i - 1)::DOUBLE AS x, round(embedding[i]::DOUBLE, 6) AS intensity FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)")
def xps_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _spectra(spark, sf_dir).select("data_id", F.col("data_id").alias("xps_id"), F.col("axis").alias("binding_energies"), F.col("values").alias("intensities"), F.lit(None).cast("string").alias("detected_peaks"), F.create_map(F.lit("Ga"), F.lit(0.5)).alias("predicted_composition"), F.lit(False).alias("elements_manually_set"), F.lit(None).cast("string").alias("last_updated"))
    return spectra.points(spectra.xps(s)).withColumn("intensity", F.round("intensity", 6))


@query("SELECT vec_id AS data_id, 'raman' AS kind, vec_id::VARCHAR AS result_id, len(embedding)::INT AS n FROM embeddings UNION ALL SELECT vec_id, 'photoluminescence', CASE WHEN label % 2 = 0 THEN 'p' || vec_id ELSE vec_id::VARCHAR END, 0 FROM embeddings")
def spectra_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raman's axis falls back to wave numbers; photoluminescence's id to the plain one and its lists to empty ones."""
    s = _spectra(spark, sf_dir)
    none = F.lit(None).cast("string")
    r = spectra.raman(s.select("data_id", F.col("data_id").alias("id"), F.lit(None).cast("array<double>").alias("energies"), F.col("axis").alias("wavenumbers"), F.col("values").alias("intensities"), none.alias("detected_peaks"), none.alias("last_updated")))
    p = spectra.photoluminescence(s.select("data_id", F.when(F.col("label") % 2 == 0, F.concat(F.lit("p"), "data_id")).alias("photoluminescence_id"), F.col("data_id").alias("id"), F.lit(None).cast("array<double>").alias("energies"), none.alias("detected_peaks"), none.alias("last_updated")))
    return r.unionByName(p).select("data_id", "kind", "result_id", F.size("axis").alias("n"))


@query("SELECT p_partkey, p_name, p_size FROM part")
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return spectra.from_json(spectra.as_json(p), p.schema)


@query("SELECT DISTINCT p_name AS path, trim(regexp_replace(p_name, '[\"'']', '', 'g')) AS clean FROM part")
def clean_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("path")).distinct()
    return p.select("path", chunks.clean_path(F.concat(F.lit(" “"), "path", F.lit("\u0007’ "))).alias("clean"))


# ---- patterns -------------------------------------------------------------------------------------------------------


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as nodes of the image that is their order; repeated line numbers keep the first. An image's nodes lie together."""
    lines = table(spark, sf_dir, "lineitem")
    rows = dealt(lines, ["l_orderkey"], lines.count()).groupBy(F.col("l_orderkey").alias("data_id"), F.col("l_linenumber").cast("bigint").alias("node_id")).agg(F.min(F.struct("l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")).alias("r"))
    box = {"bbox_minc": F.col("r.l_quantity") - 5, "bbox_maxc": F.col("r.l_quantity") + 5, "bbox_minr": F.floor(F.col("r.l_extendedprice") / 1000) - 5, "bbox_maxr": F.floor(F.col("r.l_extendedprice") / 1000) + 5}
    return rows.select("data_id", "node_id", F.col("node_id").alias("seq"), (F.col("r.l_extendedprice") / 1000).alias("centroid_0"), F.col("r.l_quantity").alias("centroid_1"), F.col("r.l_discount").alias("area"), F.col("r.l_tax").alias("eccentricity"), *[c.cast("int").alias(n) for n, c in box.items()])


_NODES = """n AS (SELECT data_id, node_id, r.l_extendedprice / 1000 AS c0, r.l_quantity AS c1, r.l_discount AS area, r.l_tax AS ecc, (r.l_quantity - 5)::INT AS minc, (r.l_quantity + 5)::INT AS maxc, (floor(r.l_extendedprice / 1000) - 5)::INT AS minr, (floor(r.l_extendedprice / 1000) + 5)::INT AS maxr
FROM (SELECT l_orderkey AS data_id, l_linenumber::BIGINT AS node_id, min({'l_partkey': l_partkey, 'l_quantity': l_quantity, 'l_extendedprice': l_extendedprice, 'l_discount': l_discount, 'l_tax': l_tax}) AS r FROM lineitem GROUP BY ALL))"""


@query(f"""WITH {_NODES} SELECT a.data_id, a.node_id AS start_node, b.node_id AS end_node, round(sqrt((a.c0 - b.c0) ** 2 + (a.c1 - b.c1) ** 2), 6) AS weight, round(abs(a.c1 - b.c1), 6) AS horizontal_weight, round(abs(a.c0 - b.c0), 6) AS vertical_weight,
CASE WHEN a.minc < b.minc THEN a.maxc ELSE b.maxc END > CASE WHEN a.minc > b.minc THEN a.minc ELSE b.minc END AS horizontal_overlap FROM n a JOIN n b ON a.data_id = b.data_id AND a.node_id < b.node_id""")
def pattern_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern.edges(nodes(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("weight", "horizontal_weight", "vertical_weight")})


@query(f"WITH {_NODES} SELECT a.data_id, a.node_id AS a, b.node_id AS b FROM n a JOIN n b ON a.data_id = b.data_id AND a.minr <= b.maxr AND b.minr <= a.maxr AND a.minc <= b.maxc AND b.minc <= a.maxc")
def box_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = nodes(spark, sf_dir).withColumnsRenamed({f"bbox_{c}": c for c in ("minr", "minc", "maxr", "maxc")})
    return pattern.overlapping(boxes, cell=20)


_LONG = "l AS (SELECT data_id, 'area' AS feature, node_id, area AS value FROM n UNION ALL SELECT data_id, 'eccentricity', node_id, ecc FROM n)"


@query(f"""WITH {_NODES}, {_LONG}, s AS (SELECT feature, node_id, avg(value) AS m, stddev_samp(value) AS d FROM l GROUP BY ALL)
SELECT data_id, feature, node_id, round((value - m) / (d + 1e-6), 5) AS value FROM l JOIN s USING (feature, node_id)""")
def features_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pattern.features_long(nodes(spark, sf_dir), ("area", "eccentricity"))
    return pattern.normalised(rows).select("data_id", "feature", "node_id", F.round("value", 5).alias("value"))


@query("""WITH l AS (SELECT vec_id % 7 AS data_id, 'f' || i AS feature, label::BIGINT AS node_id, avg(embedding[i]::DOUBLE) AS value FROM (SELECT vec_id, label, embedding, unnest(generate_series(1, 64)) AS i FROM embeddings) GROUP BY ALL),
k AS (SELECT feature, node_id FROM l GROUP BY ALL HAVING count(DISTINCT data_id) = 7)
SELECT data_id, feature, node_id, round(value, 6) AS value FROM l SEMI JOIN k USING (feature, node_id)""")
def features_streamlined(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 7).alias("data_id"), F.col("label").cast("bigint").alias("node_id"), *[F.element_at("embedding", i).cast("double").alias(f"f{i}") for i in range(1, 65)])
    return pattern.streamlined(pattern.features_long(e, tuple(f"f{i}" for i in range(1, 65)))).select("data_id", "feature", "node_id", F.round("value", 6).alias("value"))


_WIDE = ", ".join(f"round(avg(CASE WHEN node_id = {i} THEN area END), 6) AS area_{i}" for i in range(1, 8))


@query(f"""WITH {_NODES} SELECT data_id, {_WIDE}, any_value(o_orderstatus) AS o_orderstatus FROM n JOIN orders ON data_id = o_orderkey GROUP BY data_id""")
def features_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column for each of the seven nodes that an order can have."""
    rows = pattern.features_long(nodes(spark, sf_dir), ("area",))
    extra = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("data_id"), "o_orderstatus")
    names = [f"area_{i}" for i in range(1, 8)]
    return pattern.with_extra(pattern.wide(rows, names), extra).withColumns({c: F.round(c, 6) for c in names})


_FEATURES = "[" + ", ".join(f"'{f}'" for f in pattern.FEATURES) + "]"


@query(f"""WITH l AS (SELECT vec_id % 7 AS data_id, {_FEATURES}[i] AS feature, label::BIGINT AS node_id, avg(embedding[i]::DOUBLE) AS value FROM (SELECT vec_id, label, embedding, unnest(generate_series(1, 16)) AS i FROM embeddings) GROUP BY ALL),
k AS (SELECT feature, node_id, avg(value) AS m, stddev_samp(value) AS d FROM l GROUP BY ALL HAVING count(DISTINCT data_id) = 7)
SELECT data_id, feature, node_id, round((value - m) / (d + 1e-6), 5) AS value FROM l JOIN k USING (feature, node_id)""")
def collection_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sixteen features of seven images, without those that some image lacks, normalised."""
    e = table(spark, sf_dir, "embeddings").select((F.col("vec_id") % 7).alias("data_id"), F.col("label").cast("bigint").alias("node_id"), *[F.element_at("embedding", i + 1).cast("double").alias(f) for i, f in enumerate(pattern.FEATURES)])
    return pattern.collection_features(e, True, True).select("data_id", "feature", "node_id", F.round("value", 5).alias("value"))


@query("SELECT p_size % 10 AS collection_id, max(p_size) AS image_width, max(p_partkey % 1000) AS image_height FROM part GROUP BY ALL")
def collection_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return pattern.largest_size(p.select((F.col("p_size") % 10).alias("collection_id"), F.col("p_size").alias("image_width"), (F.col("p_partkey") % 1000).alias("image_height")))


@query("SELECT DISTINCT o_custkey AS collection_id, unnest([o_orderpriority, o_orderstatus]) AS key FROM orders")
def collection_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return pattern.extra_keys(o.select(F.col("o_custkey").alias("collection_id"), F.create_map("o_orderpriority", F.lit("a"), "o_orderstatus", F.lit("b")).alias("extra")))


@query("SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'a') OR contains(p_name, 'B')")
def name_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.containing(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "a", "B")


@query(f"WITH {_NODES} SELECT data_id, CASE WHEN node_id = 0 THEN 0 ELSE coalesce(CASE WHEN node_id % 2 = 0 THEN node_id + 100 END, node_id) END AS node_id, round(area, 6) AS area FROM n")
def relabelled_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = nodes(spark, sf_dir).select("data_id", "node_id", F.round("area", 6).alias("area"))
    return pattern.relabelled(n, n.filter("node_id % 2 = 0").select("data_id", "node_id", (F.col("node_id") + 100).alias("linked_id")))


@query("SELECT o_custkey AS collection_id, o_orderkey AS data_id, (dense_rank() OVER (PARTITION BY o_custkey ORDER BY min(o_orderdate)) - 1)::INT AS frame FROM orders GROUP BY o_custkey, o_orderkey")
def frame_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern.first_seen_code(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("collection_id"), F.col("o_orderkey").alias("data_id"), F.col("o_orderdate").alias("seq")))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, round(sqrt((l_quantity - 1) ** 2 + (l_tax - 2) ** 2) / 3, 6) AS r, round(atan2(l_tax - 2, l_quantity - 1), 6) AS angle, round(l_quantity / 50, 6) AS nx, round(l_tax / 8, 6) AS ny,
round(2 * 10.5 - l_quantity, 6) AS mirrored, trunc(2 * 10.5 - l_quantity)::INT AS edge, round_even(l_extendedprice / 1000, 0)::INT AS px, round(sqrt(l_quantity ** 2 + l_linenumber ** 2) * 0.2, 6) AS reach, round((l_tax - 2) / 3, 6) AS s0, round((l_quantity - 1) / 3, 6) AS s1 FROM lineitem""")
def geometry_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y, one, two, three = F.col("l_quantity"), F.col("l_tax"), F.lit(1), F.lit(2), F.lit(3)
    r, angle = geometry.polar(x, y, one, two, three)
    s0, s1 = geometry.rescaled(x, y, one, two, three)
    nx, ny = geometry.normalised(x, y, F.lit(50), F.lit(8))
    plane = F.lit(10.5)
    out = {"r": r, "angle": angle, "nx": nx, "ny": ny, "mirrored": geometry.mirrored(x, plane), "reach": geometry.search_radius(x, F.col("l_linenumber"), 0.2), "s0": s0, "s1": s1}
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(c, 6).alias(n) for n, c in out.items()], geometry.mirrored_edge(x, plane).alias("edge"), geometry.pixel(F.col("l_extendedprice") / 1000).alias("px"))


@query("""WITH p AS (SELECT vec_id, i, embedding[i] > 0 AS on_, i - row_number() OVER (PARTITION BY vec_id, embedding[i] > 0 ORDER BY i) AS g FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings))
SELECT vec_id AS data_id, min(i) - 1 AS start, max(i) AS "end" FROM p WHERE on_ GROUP BY vec_id, g""")
def mask_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run lengths of embedding > 0 turned into runs, by way of an alternating list."""
    p = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("data_id"), F.posexplode(F.transform("embedding", lambda x: x > 0)).alias("i", "on"))
    order = Window.partitionBy("data_id").orderBy("i")
    p = p.withColumn("new", (F.col("on") != F.coalesce(F.lag("on").over(order), F.lit(False))).cast("int")).withColumn("g", F.sum("new").over(order))
    lists = p.groupBy("data_id", "g").agg(F.count("*").alias("n")).groupBy("data_id").agg(F.array_sort(F.collect_list(F.struct("g", "n"))).alias("l"))
    counts = F.when(F.col("l")[0]["g"] > 0, F.concat(F.array(F.lit(0).cast("bigint")), F.transform("l", lambda x: x["n"]))).otherwise(F.transform("l", lambda x: x["n"]))
    runs = masks.runs_of(lists.select("data_id", counts.alias("mask_rle"), F.lit(8).alias("mask_height"), F.lit(8).alias("mask_width")), ["data_id"])
    return runs.select("data_id", "start", "end")


_CELLS = "c AS (SELECT DISTINCT l_orderkey AS data_id, s FROM (SELECT l_orderkey, unnest(generate_series(l_quantity::BIGINT, l_quantity::BIGINT + l_linenumber - 1)) AS s FROM lineitem))"


@query(f"WITH {_CELLS}, g AS (SELECT data_id, s, s - row_number() OVER (PARTITION BY data_id ORDER BY s) AS g FROM c) SELECT data_id, min(s) AS start, max(s) + 1 AS \"end\" FROM g GROUP BY data_id, g")
def mask_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.union(_line_runs(spark, sf_dir), ["data_id"]).select("data_id", "start", "end")


@query(f"WITH {_CELLS}, m AS (SELECT data_id, (2 * 4 - s // 8) * 8 + s % 8 AS s FROM c WHERE 2 * 4 - s // 8 >= 0 AND 2 * 4 - s // 8 < 8), g AS (SELECT data_id, s, s - row_number() OVER (PARTITION BY data_id ORDER BY s) AS g FROM m) SELECT data_id, min(s) AS start, max(s) + 1 AS \"end\" FROM g GROUP BY data_id, g")
def mask_reflect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.reflect(_line_runs(spark, sf_dir).withColumn("origin", F.lit(4)), ["data_id"], "origin").select("data_id", "start", "end")


def _line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("data_id"), start.alias("start"), (start + F.col("l_linenumber")).alias("end"), F.lit(8).alias("mask_height"), F.lit(8).alias("mask_width"))


@query("SELECT vec_id AS data_id, ((i - 1) // 8)::INT AS y, ((i - 1) % 8)::INT AS x, round(embedding[i]::DOUBLE, 6) AS intensity FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)")
def pixel_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("data_id"), F.col("embedding").alias("image"))
    return graphs.pixels(e, 8).withColumn("intensity", F.round("intensity", 6))


@query("""WITH k AS (SELECT 1.03 + i * (5.17 / 19) AS radius, j * (2 * pi() / 15) AS theta FROM generate_series(0, 19) AS a(i), generate_series(0, 15) AS b(j)),
p AS (SELECT radius, round_even(radius * cos(theta) + 3.0, 0)::INT AS x, round_even(radius * sin(theta) + 3.0 - radius, 0)::INT AS y FROM k),
s AS (SELECT vec_id AS data_id, radius, quantile_cont(embedding[y * 8 + x + 1]::DOUBLE, 0.9) AS score FROM embeddings, p WHERE x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 7 GROUP BY vec_id, radius)
SELECT data_id, round(radius, 6) AS radius, round(score, 6) AS score FROM s""")
def laue_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("data_id"), F.col("embedding").alias("image"))
    points = e.select("data_id", F.lit(3.0).alias("cy"), F.lit(3.0).alias("cx"))
    scored = laue.scores(e.withColumn("width", F.lit(8)), points, 20, 16, 1.03, 6.2)
    return scored.select("data_id", F.round("radius", 6).alias("radius"), F.round("score", 6).alias("score"))


# ---- summaries ------------------------------------------------------------------------------------------------------


@query("SELECT quality, CASE WHEN n_chars > 300 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY ALL")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.confusion(_predicted(spark, sf_dir), "quality", "predicted")


@query("SELECT round(avg((quality = CASE WHEN n_chars > 300 THEN 1 ELSE 0 END)::INT), 6) AS accuracy, round(1 - avg((quality = CASE WHEN n_chars > 300 THEN 1 ELSE 0 END)::INT), 6) AS misclassified FROM labels JOIN documents USING (doc_id)")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.accuracy(_predicted(spark, sf_dir), "quality", "predicted").select(F.round("accuracy", 6).alias("accuracy"), F.round("misclassified", 6).alias("misclassified"))


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").withColumn("predicted", F.when(F.col("n_chars") > 300, 1).otherwise(0))


@query("SELECT 'f' || i AS feature, round(abs(corr(embedding[i]::DOUBLE, label::DOUBLE)), 5) AS correlation FROM (SELECT embedding, label, unnest(generate_series(1, 64)) AS i FROM embeddings) GROUP BY i")
def correlation_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("label").cast("double").alias("target"), F.posexplode("embedding").alias("i", "v"))
    ranked = stats.correlation_ranking(rows.select(F.concat(F.lit("f"), F.col("i") + 1).alias("feature"), F.col("v").cast("double").alias("value"), "target"))
    return ranked.select("feature", F.round("correlation", 5).alias("correlation"))


@query("""WITH v AS (SELECT vec_id, i, embedding[i] AS v FROM (SELECT vec_id, embedding, unnest(generate_series(1, 64)) AS i FROM embeddings)),
l AS (SELECT 'f' || lpad(i::VARCHAR, 2, '0') AS feature, vec_id, v FROM v UNION ALL SELECT 'g' || lpad(i::VARCHAR, 2, '0'), vec_id, v FROM v),
k AS (SELECT feature, list(v ORDER BY vec_id) AS own, count(*) AS n FROM l GROUP BY feature) SELECT min(feature) AS feature, any_value(n) AS n FROM k GROUP BY own""")
def duplicate_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature is there twice (as f.. and as g..); one of each pair stays."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("i", "value"))
    both = rows.withColumn("feature", F.explode(F.array(F.format_string("f%02d", F.col("i") + 1), F.format_string("g%02d", F.col("i") + 1)))).drop("i")
    return stats.without_duplicate_features(both).groupBy("feature").agg(F.count("*").alias("n"))


@query("SELECT round(1 - sum((value - m) ** 2) / sum((value - a) ** 2), 6) AS r2 FROM (SELECT value, avg(value) OVER (PARTITION BY event_type) AS m, avg(value) OVER () AS a FROM events)")
def r_squared(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", "value")
    means = e.groupBy("event_type").agg(F.avg("value").alias("m"))
    return stats.r_squared(e.join(means, "event_type"), "value", "m").select(F.round("r2", 6).alias("r2"))


# ---- streams and chunks ---------------------------------------------------------------------------------------------


@query("SELECT s_suppkey, round(CASE WHEN s_nationkey % 5 > 0 THEN (120 + s_nationkey) * 60.0 / (s_nationkey % 5) END, 6) AS rotational_period, s_nationkey % 5 > 0 AS is_rotating, s_name AS data_item_name, lower(s_name) AS sample FROM supplier")
def streams_opened(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    rows = s.select(F.col("s_suppkey").alias("data_id"), F.col("s_name").alias("name"), (F.col("s_nationkey") + 120).cast("double").alias("fps"), (F.col("s_nationkey") % 5).cast("double").alias("rpm"), F.lit(400).alias("chunk_size"), F.upper("s_name").alias("sample_name"))
    opened = frames.opened(rows, F.lit("2024-01-01 10:05:00").cast("timestamp"))
    linked, _ = frames.link_samples(opened, s.filter("s_suppkey % 2 = 0").select(F.lower("s_name").alias("id"), F.col("s_name").alias("name")))
    return linked.filter("physical_sample_id IS NOT NULL").select(F.col("data_id").alias("s_suppkey"), F.round("rotational_period", 6).alias("rotational_period"), "is_rotating", "data_item_name", F.lower("sample_name").alias("sample"))


@query("""WITH f AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS k FROM events),
c AS (SELECT user_id::VARCHAR AS data_id, (k // 16)::INT AS chunk_idx, count(*) AS n, min(ms) AS start FROM f GROUP BY ALL)
SELECT data_id, chunk_idx, 'frames.zarr/frames/c/' || chunk_idx || '/0/0' AS key, n || ',4,5' AS dims, start AS start_unix_ms_utc, start + CAST(floor(n / 8.0 * 1000) AS BIGINT) AS end_unix_ms_utc FROM c""")
def frame_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    shots = e.select(F.col("user_id").cast("string").alias("data_id"), number.alias("frame_number"), F.lit(4).alias("height"), F.lit(5).alias("width"), F.expr("unix_micros(cast(ts as timestamp)) div 1000").alias("start_ms"))
    streams = e.select(F.col("user_id").cast("string").alias("data_id")).distinct().select("data_id", F.lit(16).alias("chunk_size"), F.lit(8.0).alias("fps_capture_rate"))
    return frames.chunks(shots, streams)


@query("SELECT user_id AS data_id, event_id % 10 AS chunk_idx, max(event_id) AS pushed_at FROM events GROUP BY ALL")
def chunks_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.latest(table(spark, sf_dir, "events").select(F.col("user_id").alias("data_id"), (F.col("event_id") % 10).alias("chunk_idx"), F.col("event_id").alias("pushed_at")))


# ---- without SQL: iteration, assignment, streams, models --------------------------------------------------------------


def symmetrised_sql(passes: int = 8) -> str:
    """Passes written out for all images; of each image the first pass that leaves the number of its nodes counts."""
    sums = "avg(c0) AS c0, avg(c1) AS c1, avg(minr) AS minr, avg(minc) AS minc, avg(maxr) AS maxr, avg(maxc) AS maxc"
    steps, counts = "", "SELECT data_id, 0 AS k, count(*) AS n FROM p0 GROUP BY data_id"
    for k in range(1, passes + 1):
        last = f"p{k - 1}"
        steps += f"""f{k} AS (SELECT data_id, spot AS seq, min(node_id) AS node_id, {sums} FROM (SELECT a.seq AS spot, b.* FROM {last} a JOIN {last} b ON a.data_id = b.data_id AND a.minr <= b.maxr AND b.minr <= a.maxr AND a.minc <= b.maxc AND b.minc <= a.maxc) GROUP BY data_id, spot),
g{k} AS (SELECT data_id, node_id, min(seq) AS seq, {sums} FROM f{k} GROUP BY data_id, node_id),
p{k} AS (SELECT data_id, CASE WHEN node_id > 1000 THEN coalesce(max(node_id) FILTER (node_id < 1000) OVER (PARTITION BY data_id), -1) + row_number() OVER (PARTITION BY data_id, node_id > 1000 ORDER BY node_id DESC) ELSE node_id END AS node_id, seq, c0, c1, minr, minc, maxr, maxc FROM g{k}),
"""
        counts += f" UNION ALL SELECT data_id, {k}, count(*) FROM p{k} GROUP BY data_id"
    rows = " UNION ALL ".join(f"SELECT {k} AS k, * FROM p{k}" for k in range(1, passes + 1))
    return f"""WITH {_NODES},
s AS (SELECT *, node_id AS seq, sign(c1 - 25.5) AS side, max(node_id) OVER (PARTITION BY data_id) + 1 AS n FROM n),
p0 AS (SELECT data_id, node_id, seq, c0, c1, minr::DOUBLE AS minr, minc::DOUBLE AS minc, maxr::DOUBLE AS maxr, maxc::DOUBLE AS maxc FROM s
       UNION ALL SELECT data_id, node_id + CASE WHEN side < 0 THEN 1000 ELSE 2000 END, seq + n * CASE WHEN side < 0 THEN 1 ELSE 2 END, c0, 51 - c1, minr, trunc(51 - maxc), maxr, trunc(51 - minc) FROM s WHERE side <> 0),
{steps}c AS ({counts}),
settled AS (SELECT data_id, min(k) AS k FROM (SELECT data_id, k, n, lag(n) OVER (PARTITION BY data_id ORDER BY k) AS before FROM c) WHERE n = before GROUP BY data_id)
SELECT data_id, node_id, round(c0, 9) AS centroid_0, round(c1, 9) AS centroid_1 FROM ({rows}) JOIN settled USING (data_id, k)"""


@query(symmetrised_sql())
def symmetrised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All images' patterns mirrored about the middle of their boxes and merged until they settle."""
    rows = nodes(spark, sf_dir)
    rows = rows.withColumns({"specular_origin_1": F.lit(25.5), "intensity_centroid_1": F.col("centroid_1") - 25.5, "relative_centroid_1": F.col("centroid_1") - 25.5})
    found, _ = symmetry.symmetrised(rows, together=True)
    return found.select("data_id", "node_id", *(exact.rounded(F.col(c), 9).alias(c) for c in ("centroid_0", "centroid_1")))


@query()
def linked_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of each customer's orders linked from order to order."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    codes = F.dense_rank().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")) - 1
    framed = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey", F.col("o_custkey").alias("collection_id"), codes.alias("frame"))
    points = lines.join(framed, F.col("l_orderkey") == F.col("o_orderkey")).select("collection_id", F.col("l_orderkey").alias("data_id"), F.col("l_linenumber").cast("bigint").alias("node_id"), F.col("l_linenumber").alias("seq"), "frame", F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 2000).alias("y"))
    return linking.linked(points.withColumn("reach", geometry.search_radius(F.lit(50), F.lit(50), 0.1)))


@query("""WITH k AS (SELECT 1.0 + i * (5.0 / 59) AS radius, j * (2 * pi() / 89) AS theta FROM generate_series(0, 59) AS a(i), generate_series(0, 89) AS b(j)),
p AS (SELECT radius, round_even(radius * cos(theta) + 3.0, 0)::INT AS x, round_even(radius * sin(theta) + 3.0 - radius, 0)::INT AS y FROM k),
s AS (SELECT vec_id AS data_id, radius, round(quantile_cont(embedding[y * 8 + x + 1]::DOUBLE, 0.9), 6) AS score FROM embeddings, p WHERE x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 7 GROUP BY vec_id, radius),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY data_id ORDER BY score DESC, radius DESC) <= 30)
SELECT data_id, round(avg(radius), 6) AS radius, round(3.0 - avg(radius), 6) + 0.0 AS cy, 3.0::DOUBLE AS cx FROM t GROUP BY data_id""")
def laue_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty radii of ninety angles, the best thirty of them: as much as images of eight by eight pixels tell apart."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("data_id"), F.col("embedding").alias("image"))
    around = e.select("data_id", F.lit(0).alias("node_id"), *[F.lit(1.5).alias(c) for c in ("intensity_centroid_0", "intensity_centroid_1", "specular_origin_0", "specular_origin_1")])
    points = laue.centres(around)
    scored = laue.scores(e.withColumn("width", F.lit(8)), points, 60, 90, 1.0, 6.0)
    found = laue.best_radius(scored.withColumn("score", F.round("score", 6)), points)
    return found.select("data_id", F.round("radius", 6).alias("radius"), (F.round("cy", 6) + 0.0).alias("cy"), "cx")


@query("""WITH k AS (SELECT 1.0 + i * (5.0 / 59) AS radius, j * (2 * pi() / 89) AS theta FROM generate_series(0, 59) AS a(i), generate_series(0, 89) AS b(j)),
c AS (SELECT vec_id, embedding, 3.0 + (vec_id % 3) * 0.25 AS cy, 3.0 + (vec_id % 2) * 0.5 AS cx FROM embeddings),
p AS (SELECT DISTINCT cy, cx, radius, theta, round_even(radius * cos(theta) + cx, 0)::INT AS x, round_even(radius * sin(theta) + cy - radius, 0)::INT AS y FROM k, (SELECT DISTINCT cy, cx FROM c)),
s AS (SELECT vec_id AS data_id, cy, cx, radius, round(quantile_cont(embedding[y * 8 + x + 1]::DOUBLE, 0.9), 6) AS score FROM c JOIN p USING (cy, cx) WHERE x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 7 GROUP BY vec_id, cy, cx, radius),
t AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY data_id ORDER BY score DESC, radius DESC) <= 30)
SELECT data_id, round(avg(radius), 6) AS radius, round(cy - avg(radius), 6) + 0.0 AS cy, cx::DOUBLE AS cx FROM t GROUP BY data_id, cy, cx""")
def laue_zero_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From patterns of three nodes to the zone's circle: two nodes lie either side of the plane and meet their mirror images."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("data_id"), F.col("embedding").alias("image"), F.lit(8).alias("width"))
    spot = F.col("data_id") % 2 * 0.5
    kinds = F.array(*(F.struct(F.lit(i).cast("bigint").alias("seq"), F.lit(c).alias("centroid_1"), F.lit(r).alias("row")) for i, c, r in ((0, 0.0, 10), (1, -2.0, 20), (2, 2.0, 20))))
    n = e.select("data_id", F.explode(kinds).alias("k"), spot.alias("spot"))
    centre = F.lit(3.0) + F.col("spot")
    box = {"bbox_minr": F.col("k.row") - 1, "bbox_maxr": F.col("k.row") + 1, "bbox_minc": F.col("k.centroid_1") + centre - 1, "bbox_maxc": F.col("k.centroid_1") + centre + 1}
    points = n.select("data_id", "k.seq", F.col("k.seq").alias("node_id"), F.col("k.row").cast("double").alias("centroid_0"), (F.col("k.centroid_1") + centre).alias("centroid_1"), (1.0 + F.col("data_id") % 3 * 0.25).alias("intensity_centroid_0"), F.lit(0.0).alias("intensity_centroid_1"), F.lit(2.0).alias("specular_origin_0"), centre.alias("specular_origin_1"), *(c.cast("double").alias(k) for k, c in box.items()))
    found = laue.zero_radius(points, e, 60, 90, 1.0, 6.0, digits=6)
    return found.select("data_id", F.round("radius", 6).alias("radius"), (F.round("cy", 6) + 0.0).alias("cy"), "cx")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def poll_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events followed as a stream; what is emitted is written batch by batch and read back."""
    path = folder(spark, "poll")
    source = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    sink = frames.append_batch(f"{path}/out")
    Poll(sink).start(source, f"{path}/checkpoint", interval=None).awaitTermination()
    return spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count("*").alias("n"))


def followed(spark: SparkSession, sf_dir: str, name: str, make: Callable[[DataFrame], DataFrame], parts: int = 4) -> DataFrame:
    """What ``make`` gives of a stream of all events, which come in ``parts`` lots by time; the query starts anew for each, from
    its checkpoint."""
    path = folder(spark, name)
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), "event_type", "value")
    lo, hi = e.agg(F.min("time_us"), F.max("time_us")).first()
    place = F.least(F.floor((F.col("time_us") - F.lit(lo)) * parts / F.lit(max((hi or 0) - (lo or 0), 1))), F.lit(parts - 1))
    schema = f"{', '.join(f'{c} {kind}' for c, kind in e.dtypes)}, slice int"

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    for k in range(parts):
        e.filter(place == k).write.parquet(f"{path}/in/slice={k}")
        made = make(items.session(spark).readStream.schema(schema).parquet(f"{path}/in").drop("slice"))
        made.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/checkpoint").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(made.schema).parquet(f"{path}/out")


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5")
def poll_last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's last five events, kept as state by user over the batches of a stream; the last poll of each user."""
    found = followed(spark, sf_dir, "last", lambda s: items.follow(s, ["user_id"], ["time_us", "event_id"], 5))
    last = found.groupBy("user_id").agg(F.max("poll").alias("poll"))
    return found.join(last, ["user_id", "poll"]).select("user_id", "event_id", "event_type", "value")


@query("SELECT user_id, event_id, event_type FROM events QUALIFY event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id)")
def poll_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose type is not that of the user's event before, over the batches of a stream."""
    return followed(spark, sf_dir, "changes", lambda s: items.changes(s, ["user_id"], ["time_us", "event_id"], ["event_type"])).select("user_id", "event_id", "event_type")


@query("""
WITH p AS (SELECT user_id::VARCHAR AS data_id, (event_id % 50)::INT AS chunk_idx, (event_id // 50) % 3 AS push, event_id, epoch_us(ts) // 1000 AS ms FROM events),
o AS (SELECT *, row_number() OVER (PARTITION BY data_id, chunk_idx, push ORDER BY event_id DESC) AS k FROM p),
l AS (SELECT * FROM o WHERE k = 1 QUALIFY push = max(push) OVER (PARTITION BY data_id, chunk_idx))
SELECT data_id, chunk_idx, 'frames.zarr/frames/c/' || chunk_idx || '/0/0' AS key, '2,3,4' AS dims, 24 AS n_bytes, event_id % 256 AS first_pixel, ms AS start_unix_ms_utc, ms + 250 AS end_unix_ms_utc FROM l""")
def chunk_store_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of all users pushed in three versions, frames and all; of each chunk the last version stands."""
    e = table(spark, sf_dir, "events")
    push = e.select(F.col("user_id").cast("string").alias("data_id"), (F.col("event_id") % 50).cast("int").alias("chunk_idx"), (F.floor(F.col("event_id") / 50) % 3).alias("push"), "event_id", F.expr("unix_micros(cast(ts as timestamp)) div 1000").alias("start_unix_ms_utc"))
    one = push.groupBy("data_id", "chunk_idx", "push").agg(F.max_by(F.struct("event_id", "start_unix_ms_utc"), "event_id").alias("x"))
    pixel = F.lpad(F.hex(F.col("x.event_id") % 256), 2, "0")
    rows = one.select("data_id", "chunk_idx", "push", F.lit("2,3,4").alias("dims"), F.unhex(F.repeat(pixel, F.lit(24))).alias("frames"), F.col("x.start_unix_ms_utc").alias("start_unix_ms_utc"), F.lit(8.0).alias("fps"))
    store = chunk_store.ChunkStore(spark, folder(spark, "chunks"))
    for k in range(3):
        store.push(rows.filter(F.col("push") == k).drop("push"))
    found = store.read()
    return found.select("data_id", "chunk_idx", "key", "dims", F.octet_length("frames").alias("n_bytes"), F.conv(F.hex(F.substring("frames", 1, 1)), 16, 10).cast("bigint").alias("first_pixel"), "start_unix_ms_utc", "end_unix_ms_utc")


@query()
def bagged_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of documents by their length and source, from bootstrap samples; each is scored by models fitted without its fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") / 1000).alias("size"), F.length("source").cast("double").alias("name"))
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id").filter("quality IS NOT NULL")
    scored = ml.held_out_logistic(rows, ["size", "name"], "quality", "doc_id", 5, bags=3)
    return stats.confusion(scored.withColumn("predicted", (F.col("prediction") > 0.5).cast("int")), "quality", "predicted")


@query()
def bagged_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") / 9).alias("target"), *[F.element_at("embedding", i).cast("double").alias(f"f{i}") for i in range(1, 65)])
    names = [f"f{i}" for i in range(1, 65)]
    coefficients, intercept = ml.bagged_linear(ml.vectors(e, names), "target", bags=3)
    return stats.r_squared(ml.applied(e, names, coefficients, intercept), "target", "prediction")


@query()
def components_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Principal components before the classifier."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") < 5).cast("int").alias("low"), *[F.element_at("embedding", i).cast("double").alias(f"f{i}") for i in range(1, 65)])
    rows = ml.vectors(e, [f"f{i}" for i in range(1, 65)], components=4)
    coefficients, intercept = ml.bagged_logistic(rows, "low", bags=2)
    return spark.createDataFrame([(i, float(c)) for i, c in enumerate([*coefficients, intercept])], "component int, weight double")
