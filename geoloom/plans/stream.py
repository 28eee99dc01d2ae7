"""Messages, gauges, timings, listings, sinks: batch forms with twins, and the streaming operators run to completion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions.geometry import box
from ..functions.names import first_non_empty
from ..functions.metrics import progress_percent, stage_fraction
from ..operators.durable import shared_path, shuffle_tasks
from ..operators.running import running_sum
from ..operators.scene_match import flatten_json
from ..operators.scene_match import match_names
from ..operators.scene_match import scene_score as scene_rungs
from ..sources import readers as rd
from ..sources import writers as wr
from ..streaming import operators as st
from .grids import _DEPS, dependencies
from .matching import norm, signature
from .registry import query
from .views import Tables


@query("st2_message_ids", "SELECT event_id, CAST(scene AS VARCHAR) || CASE WHEN tile % 5 = 0 THEN '' ELSE '/' || CAST(tile AS VARCHAR) END || '/' || stage AS message_id FROM @messages")
def message_ids(t: Tables) -> DataFrame:
    tile = F.when(F.col("tile") % 5 == 0, F.lit("")).otherwise(F.col("tile").cast("string"))
    return t.messages.select("event_id", st.message_id(F.col("scene"), tile, F.col("stage")).alias("message_id"))


_QUEUES = "[" + ", ".join(f"'{q}'" for q in st.QUEUES) + "]"


@query(
    "st1_queue_topology",
    f"""WITH m AS (SELECT {_QUEUES}[CAST(event_id % 12 AS INT) + 1] AS q, (SELECT max(epoch_us(ts)) FROM @messages) - epoch_us(ts) > 604800000000 AS old FROM @messages),
    r AS (SELECT CASE WHEN old THEN 'ie.dead_letter' ELSE q END AS queue, old AND q <> 'ie.dead_letter' AS moved FROM m)
    SELECT u.queue, count(r.queue) AS messages, count(*) FILTER (moved) AS expired, CAST(CASE WHEN u.queue <> 'ie.dead_letter' THEN 604800 END AS BIGINT) AS ttl_sec FROM (SELECT unnest({_QUEUES}) AS queue) u LEFT JOIN r ON r.queue = u.queue GROUP BY 1""",
)
def queue_topology(t: Tables) -> DataFrame:
    """All queues with what is in them at the time of the last message: expired messages are in the dead-letter queue."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = t.messages.select(F.get(F.array(*(F.lit(q) for q in st.QUEUES)), (F.col("event_id") % 12).cast("int")).alias("queue"), us.alias("us"))
    age = (F.col("now") - F.col("us")) / 1_000_000
    held = rows.join(F.broadcast(rows.agg(F.max("us").alias("now")))).withColumn("to", st.dead_lettered(F.col("queue"), age))
    n = held.groupBy(F.col("to").alias("queue")).agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("to") != F.col("queue")).alias("expired"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return st.topology(t.spark).join(n, "queue", "left").select("queue", zero("messages"), zero("expired"), "ttl_sec")


@query("st3_deduplicated", "SELECT scene, tile, stage, min(event_id) AS event_id FROM @messages GROUP BY 1, 2, 3")
def deduplicated(t: Tables) -> DataFrame:
    return t.messages.groupBy("scene", "tile", "stage").agg(F.min("event_id").alias("event_id"))


@query("st8_retry_routes", "SELECT stage, CASE WHEN attempt + 1 < 3 THEN 'retry' ELSE 'dead_letter' END AS route, count(*) AS n FROM @messages GROUP BY 1, 2")
def retry_routes(t: Tables) -> DataFrame:
    return t.messages.groupBy("stage", st.retry_route(F.col("attempt"), 3).alias("route")).agg(F.count(F.lit(1)).alias("n"))


@query("st8_last_failures", "SELECT scene, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS last_ids FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY event_id DESC) AS p FROM @messages WHERE stage = 'error') q WHERE p <= 5 GROUP BY 1")
def last_failures(t: Tables) -> DataFrame:
    """The last five failures of each scene."""
    place = F.row_number().over(Window.partitionBy("scene").orderBy(F.desc("event_id")))
    rows = t.messages.filter("stage = 'error'").withColumn("p", place).filter("p <= 5")
    return rows.groupBy("scene").agg(F.array_join(F.transform(F.sort_array(F.collect_list("event_id")), lambda x: x.cast("string")), ",").alias("last_ids"))


_DONE = "done AS (SELECT scene, tile % 12 AS tile, min(event_id) AS ts FROM @messages GROUP BY 1, 2), needs AS (SELECT DISTINCT scene, tile % 12 AS tile, (tile % 12) // 4 AS block FROM (SELECT s.scene, u.tile FROM (SELECT DISTINCT scene FROM @messages) s, unnest(range(0, 12)) AS u(tile)) q)"


def _needs(t: Tables) -> DataFrame:
    rows = t.messages.select("scene").distinct().withColumn("tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(11).cast("bigint"))))
    return rows.withColumn("block", F.expr("tile div 4"))


@query("st4_ready_blocks", f"WITH {_DONE} SELECT n.scene, n.block, max(d.ts) AS ready_ts FROM needs n LEFT JOIN done d USING (scene, tile) GROUP BY 1, 2 HAVING count(d.ts) = count(*)")
def ready_blocks(t: Tables) -> DataFrame:
    done = t.messages.select("scene", (F.col("tile") % 12).alias("tile"), F.col("event_id").alias("ts"))
    return st.ready_blocks(done, _needs(t))


@query("st5_scene_merge_once", f"WITH {_DONE}, r AS (SELECT n.scene, n.block, max(d.ts) AS ready FROM needs n LEFT JOIN done d USING (scene, tile) GROUP BY 1, 2 HAVING count(d.ts) = count(*)) SELECT scene, max(ready) AS merge_ts FROM r GROUP BY 1 HAVING count(*) = 3")
def scene_merge_once(t: Tables) -> DataFrame:
    """A scene is merged when its last block is done; once."""
    return ready_blocks(t).groupBy("scene").agg(F.max("ready_ts").alias("merge_ts"), F.count(F.lit(1)).alias("n")).filter("n = 3").drop("n")


@query("st6_scenes_in_flight", "WITH e AS (SELECT scene, min(event_id) AS a, max(event_id) AS b FROM @messages GROUP BY 1), d AS (SELECT a AS pos, 1 AS s FROM e UNION ALL SELECT b, -1 FROM e), r AS (SELECT pos, sum(s) AS s FROM d GROUP BY 1) SELECT pos, sum(s) OVER (ORDER BY pos) AS in_flight FROM r")
def scenes_in_flight(t: Tables) -> DataFrame:
    ends = t.messages.groupBy("scene").agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    steps = ends.select(F.col("a").alias("pos"), F.lit(1).alias("s")).unionByName(ends.select(F.col("b").alias("pos"), F.lit(-1).alias("s"))).groupBy("pos").agg(F.sum("s").alias("s"))
    return running_sum(steps, "pos", "s").select("pos", F.col("total").alias("in_flight"))


@query("st7_micro_batches", "SELECT stage, batch, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM (SELECT *, (row_number() OVER (PARTITION BY stage, scene ORDER BY ts, event_id) - 1) // 8 AS batch, scene AS s FROM @messages) q GROUP BY stage, s, batch")
def micro_batches(t: Tables) -> DataFrame:
    return st.micro_batches(t.messages, ["stage", "scene"], ["ts", "event_id"], 8).select("stage", "batch", "n", "first_ts", "last_ts")


_SAID = "last_value(CASE WHEN {p} THEN 1 WHEN {r} THEN 0 END IGNORE NULLS) OVER (PARTITION BY scene ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("st9_backpressure", f"SELECT event_id, coalesce({_SAID.format(p='bytes > 6000', r='bytes <= 2000')} = 1, false) AS paused FROM @messages")
def backpressure(t: Tables) -> DataFrame:
    """Paused above the high mark, resumed at the low mark or below."""
    return st.hysteresis(t.messages, ["scene"], ["ts", "event_id"], F.col("bytes") > 6000, F.col("bytes") <= 2000).select("event_id", "paused")


@query("st10_producer_backpressure", f"SELECT event_id, coalesce({_SAID.format(p='bytes >= 6000', r='bytes <= 2000')} = 1, false) AS paused FROM @messages")
def producer_backpressure(t: Tables) -> DataFrame:
    """The producer pauses at the high mark already."""
    return st.hysteresis(t.messages, ["scene"], ["ts", "event_id"], F.col("bytes") >= 6000, F.col("bytes") <= 2000).select("event_id", "paused")


@query("st11_after_terminal", "SELECT event_id FROM @messages WHERE scene NOT IN (SELECT scene FROM @messages WHERE stage = 'purchase' AND bytes > 9000)")
def after_terminal(t: Tables) -> DataFrame:
    finished = t.messages.filter("stage = 'purchase' and bytes > 9000").select("scene").distinct()
    return st.after_terminal(t.messages, finished, ["scene"]).select("event_id")


@query("st12_job_status", "SELECT scene, arg_max(stage, ts) AS state, max(ts) AS at, count(*) AS events FROM @messages GROUP BY 1")
def job_status(t: Tables) -> DataFrame:
    return t.messages.groupBy("scene").agg(F.max_by("stage", "ts").alias("state"), F.max("ts").alias("at"), F.count(F.lit(1)).alias("events"))


@query("st13_streaming_accepted", f"WITH {_DEPS}, b AS (SELECT scene, bi, bj, max(index) AS ready FROM deps GROUP BY 1, 2, 3) SELECT scene, count(*) AS blocks, count(*) = 1 OR min(ready) < max(ready) AS accepted FROM b GROUP BY 1")
def streaming_accepted(t: Tables) -> DataFrame:
    ready = dependencies(t).groupBy("scene", "bi", "bj").agg(F.max("index").alias("ready"))
    n = F.count(F.lit(1))
    return ready.groupBy("scene").agg(n.alias("blocks"), ((n == 1) | (F.min("ready") < F.max("ready"))).alias("accepted"))


@query("st14_alerts", "WITH m AS (SELECT *, value > 5 AS on_ FROM @messages), r AS (SELECT *, sum(CASE WHEN on_ THEN 0 ELSE 1 END) OVER (PARTITION BY scene ORDER BY ts, event_id) AS run FROM m) SELECT scene, min(ts) AS start, max(ts) AS \"end\" FROM r WHERE on_ GROUP BY scene, run HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 3600000000")
def alerts(t: Tables) -> DataFrame:
    return st.alerts(t.messages, ["scene"], "ts", F.col("value") > 5, 3600)


@query("st15_rates", "SELECT event_id, round((bytes - lag(bytes) OVER w) / ((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000.0), 6) AS rate FROM @messages WINDOW w AS (PARTITION BY scene ORDER BY ts, event_id)")
def rates(t: Tables) -> DataFrame:
    w = Window.partitionBy("scene").orderBy("ts", "event_id")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    seconds = (us - F.lag(us).over(w)) / F.lit(1_000_000.0)
    return t.messages.select("event_id", F.round(F.try_divide(F.col("bytes") - F.lag("bytes").over(w), seconds), 6).alias("rate"))


@query("st16_staleness", "SELECT scene, (SELECT max(epoch_us(ts)) FROM @messages) - max(epoch_us(ts)) > 600000000 AS stale FROM @messages GROUP BY 1")
def staleness(t: Tables) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    now = t.messages.agg(F.max(us).alias("now"))
    return t.messages.groupBy("scene").agg(F.max(us).alias("last")).join(F.broadcast(now)).select("scene", (F.col("now") - F.col("last") > 600_000_000).alias("stale"))


def _drained(t: Tables, make, form: str = "parquet", runs: int = 1) -> DataFrame:
    """Runs a stream over the events file until it is read (and starts it anew, if so asked), and gives what came out."""
    spark = t.spark
    source = f"{t.sf_dir}/events.parquet"
    schema = t.events.schema
    base = shared_path(spark, "stream")
    folder, _, name = source.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name if not t.events.inputFiles()[0].rpartition("/")[0].endswith(name) else "*").parquet(folder if not t.events.inputFiles()[0].rpartition("/")[0].endswith(name) else source)
    out = make(st.event_time(stream))
    store = "spark.sql.streaming.stateStore.providerClass"
    was = spark.conf.get(store)
    spark.conf.set(store, st.STATE_STORE)
    for _ in range(runs):
        q = out.writeStream.format(form).option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        q.awaitTermination()
    spark.conf.set(store, was)
    return spark.read.schema(out.schema).format(form).load(f"{base}/out")


@query("st3_stream_deduplicated", "SELECT DISTINCT CAST(user_id AS VARCHAR) || '/' || event_type || '/' || CAST(event_id // 2 AS VARCHAR) AS message_id FROM @events")
def stream_deduplicated(t: Tables) -> DataFrame:
    """Structured streaming over the events file."""
    ident = st.message_id(F.col("user_id"), F.col("event_type"), F.expr("event_id div 2"))
    return _drained(t, lambda s: st.deduplicated(s.withColumn("message_id", ident)).select("message_id"))


@query(
    "st4_stream_ready_blocks",
    """WITH done AS (SELECT user_id AS scene, event_id % 97 % 12 AS tile, min(ts) AS ts FROM @events GROUP BY 1, 2)
    SELECT scene, tile // 4 AS block, max(ts) AS ready_ts FROM done GROUP BY 1, 2 HAVING count(*) = 4""",
)
def stream_ready_blocks(t: Tables) -> DataFrame:
    """The dependency tracker as a stateful stream: the blocks of the batch form, each once, with the time of the last tile."""
    needs = _needs(t).withColumn("n_tiles", F.lit(4))

    def make(stream: DataFrame) -> DataFrame:
        done = stream.select(F.col("user_id").alias("scene"), (F.col("event_id") % 97 % 12).alias("tile"), "ts")
        return st.ready_blocks_stream(done, needs)

    return _drained(t, make).withColumn("ready_ts", F.col("ready_ts").cast("timestamp_ntz"))


@query(
    "st7_stream_batches",
    """WITH RECURSIVE r AS (SELECT event_type AS stage, user_id % 5 AS scene, ts, epoch_ms(ts) AS ms, row_number() OVER (PARTITION BY event_type, user_id % 5 ORDER BY ts, event_id) AS k FROM @events),
    w AS (SELECT max(ms) - 600000 AS upto FROM r),
    e AS (SELECT a.stage, a.scene, a.k, a.ms, max(b.k) AS z, max(b.ms) AS last FROM r a JOIN r b ON b.stage = a.stage AND b.scene = a.scene AND b.k BETWEEN a.k AND a.k + 7 AND b.ms < a.ms + 14400000 GROUP BY 1, 2, 3, 4),
    f AS (SELECT stage, scene, 0 AS batch, k, z, ms, last FROM e WHERE k = 1 UNION ALL SELECT e.stage, e.scene, f.batch + 1, e.k, e.z, e.ms, e.last FROM f JOIN e ON e.stage = f.stage AND e.scene = f.scene AND e.k = f.z + 1)
    SELECT f.stage, f.scene, CAST(batch AS BIGINT) AS batch, z - f.k + 1 AS n, a.ts AS first_ts, b.ts AS last_ts FROM f JOIN w ON (z - f.k = 7 AND last < upto) OR f.ms + 14400000 <= upto
    JOIN r a ON a.stage = f.stage AND a.scene = f.scene AND a.k = f.k JOIN r b ON b.stage = f.stage AND b.scene = f.scene AND b.k = f.z""",
)
def stream_batches(t: Tables) -> DataFrame:
    """Micro-batches of eight rows, or of fewer after four hours: what the stream has settled when the file is read."""

    def make(stream: DataFrame) -> DataFrame:
        return st.micro_batches_stream(stream.select(F.col("event_type").alias("stage"), (F.col("user_id") % 5).alias("scene"), "ts", "event_id"), 8, 14_400_000)

    return _drained(t, make).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})


@query("st7_stream_windows", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM @events GROUP BY 1, 2")
def stream_windows(t: Tables) -> DataFrame:
    """Tumbling windows: the batch form of what the stream counts."""
    return t.events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour").start.cast("timestamp_ntz").alias("start"), "event_type").agg(F.count(F.lit(1)).alias("n"))


# Timings and gauges


@query("ag19_profile", "SELECT stage, count(*) AS n, round(sum(value), 3) AS total, round(avg(value), 9) AS mean, round(quantile_cont(value, 0.5), 9) AS p50, round(quantile_cont(value, 0.95), 9) AS p95 FROM @messages GROUP BY 1")
def profile(t: Tables) -> DataFrame:
    return t.messages.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 3).alias("total"), F.round(F.avg("value"), 9).alias("mean"),
        F.round(F.percentile("value", F.lit(0.5)), 9).alias("p50"), F.round(F.percentile("value", F.lit(0.95)), 9).alias("p95"),
    )


@query("ag20_nearest_rank", "SELECT scene, list_sort(list(bytes))[1 + CAST(round_even(0.95 * (count(*) - 1), 0) AS BIGINT)] AS p95 FROM @messages GROUP BY 1")
def nearest_rank(t: Tables) -> DataFrame:
    """The value at the rank nearest to q (n - 1), half to even; ranked by a window, so no list is gathered."""
    w = Window.partitionBy("scene")
    ranked = t.messages.withColumns({"k": F.row_number().over(w.orderBy("bytes")) - 1, "n": F.count(F.lit(1)).over(w)})
    return ranked.filter(F.col("k") == F.rint((F.col("n") - 1) * F.lit(0.95))).select("scene", F.col("bytes").alias("p95"))


@query("ag21_stage_timings", "SELECT stage, round(avg(value), 9) AS mean_ms, round(count(*) / (sum(bytes) / 100.0) * 1000, 9) AS per_sec, round(count(*) / (ceil(count(*) / 8.0) * 8), 9) AS fill FROM @messages GROUP BY 1")
def stage_timings(t: Tables) -> DataFrame:
    n = F.count(F.lit(1))
    return t.messages.groupBy("stage").agg(F.round(F.avg("value"), 9).alias("mean_ms"), F.round(n / (F.sum("bytes") / F.lit(100.0)) * 1000, 9).alias("per_sec"), F.round(n / (F.ceil(n / F.lit(8.0)) * 8), 9).alias("fill"))


@query("ag22_job_metrics", "SELECT key, sum(v) AS total FROM (SELECT 'bytes' AS key, bytes AS v FROM @messages UNION ALL SELECT 'attempts', attempt FROM @messages UNION ALL SELECT 'status_' || stage, 1 FROM @messages) q GROUP BY 1")
def job_metrics(t: Tables) -> DataFrame:
    """Sums of every numeric metric over all jobs, and counts of states."""
    entries = F.map_from_arrays(F.array(F.lit("bytes"), F.lit("attempts"), F.concat(F.lit("status_"), "stage")), F.array(F.col("bytes"), F.col("attempt"), F.lit(1).cast("bigint")))
    return t.messages.select(F.explode(entries).alias("key", "v")).groupBy("key").agg(F.sum("v").alias("total"))


@query("ag29_build_benchmark", "SELECT stage, attempt, count(*) AS records, round(count(*) / (max(epoch_us(ts)) - min(epoch_us(ts))) * 1000000, 9) AS per_sec FROM @messages GROUP BY 1, 2")
def build_benchmark(t: Tables) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    n = F.count(F.lit(1))
    return t.messages.groupBy("stage", "attempt").agg(n.alias("records"), F.round(n / (F.max(us) - F.min(us)) * 1_000_000, 9).alias("per_sec"))


@query("snk8_prometheus_text", "SELECT 'queue_messages{stage=\"' || stage || '\"} ' || CAST(count(*) AS VARCHAR) AS line FROM @messages GROUP BY stage")
def prometheus_text(t: Tables) -> DataFrame:
    return t.messages.groupBy("stage").agg(F.count(F.lit(1)).alias("n")).select(wr.prometheus_line("queue_messages", ["stage"], F.col("n")).alias("line"))


@query("snk9_retention", "SELECT CASE WHEN (SELECT max(epoch_us(ts)) FROM @messages) - epoch_us(ts) > 604800000000 THEN 'expired' WHEN bytes > 9000 THEN 'too_large' ELSE 'kept' END AS reason, count(*) AS n, sum(bytes) AS bytes FROM @messages GROUP BY 1")
def retention(t: Tables) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    now = t.messages.agg(F.max(us).alias("now"))
    reason = F.when(F.col("now") - us > 7 * 86400 * 1_000_000, "expired").when(F.col("bytes") > 9000, "too_large").otherwise("kept")
    return t.messages.join(F.broadcast(now)).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))


@query(
    "snk9_tail_compaction",
    """WITH l AS (SELECT scene, event_id, bytes + 1 AS n, sum(bytes + 1) OVER (PARTITION BY scene) AS size, sum(bytes + 1) OVER (PARTITION BY scene ORDER BY event_id DESC) AS tail FROM @messages)
    SELECT scene, CAST(max(size) AS BIGINT) AS original_bytes, max(size) > 60000 AS compacted, count(*) FILTER (size <= 60000 OR tail < 60000) AS kept_lines, min(event_id) FILTER (size <= 60000 OR tail < 60000) AS first_kept FROM l GROUP BY 1""",
)
def tail_compaction(t: Tables) -> DataFrame:
    """Event logs of scenes, of which whole lines from the end stay."""
    kept = wr.kept_tail(t.messages.select("scene", "event_id", "bytes"), ["scene"], "event_id", F.col("bytes"), 60_000)
    return kept.groupBy("scene").agg(F.max("log_bytes").alias("original_bytes"), F.bool_or("compacted").alias("compacted"), F.count_if("kept").alias("kept_lines"), F.min(F.when(F.col("kept"), F.col("event_id"))).alias("first_kept"))


# Listings, manifests, JSON


@query("src2_layout_status", "SELECT lower(regexp_extract(key, '(\\.[^./]+)$', 1)) AS ext, count(*) AS n, sum(size) AS bytes FROM @images GROUP BY 1")
def layout_status(t: Tables) -> DataFrame:
    return t.images.groupBy(rd.extension(F.col("key")).alias("ext")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


_PREFIXES = ("root/region0/", "root/region1/", "root/region3/Brand1", "layouts/")


@query("src2_prefix_status", "SELECT p.prefix, count(i.key) > 0 AS \"exists\", count(i.key) AS object_count, CAST(coalesce(sum(i.size), 0) AS BIGINT) AS total_size_bytes FROM (VALUES " + ", ".join(f"('{x}')" for x in _PREFIXES) + ") p(prefix) LEFT JOIN @images i ON starts_with(i.key, p.prefix) GROUP BY 1")
def prefix_status(t: Tables) -> DataFrame:
    """What lies under each prefix that a layout has to have."""
    return rd.prefix_status(t.images, _PREFIXES)


#: Listings of layouts, one for each region.
_LAYOUT_KEYS = "CASE WHEN image % 5 = 0 AND image % 7 <> 2 THEN replace(key, '.tif', '.GeoJSON') WHEN image % 14 = 6 THEN 'root/region' || CAST(image % 7 AS STRING) || '/' || CAST(image AS STRING) || '/Scenes.txt' ELSE key END"


@query(
    "src3_layout_choice",
    f"""WITH l AS (SELECT image % 7 AS layout, {_LAYOUT_KEYS} AS key FROM @images)
    SELECT layout, max(key) FILTER (lower(key) LIKE '%.geojson') AS annotation, max(key) FILTER (lower(regexp_extract(key, '[^/]*$')) = 'scenes.txt') AS scenes FROM l GROUP BY 1""",
)
def layout_choice(t: Tables) -> DataFrame:
    """The annotation and scene files of each layout: of several the last by name."""
    return rd.layout_files(t.images.select((F.col("image") % 7).alias("layout"), F.expr(_LAYOUT_KEYS).alias("key")), ["layout"])


@query("ag28_extensions", "SELECT lower(regexp_extract(key, '(\\.[^./]+)$', 1)) AS ext, count(*) AS n FROM @images GROUP BY 1")
def extensions(t: Tables) -> DataFrame:
    return t.images.groupBy(rd.extension(F.col("key")).alias("ext")).agg(F.count(F.lit(1)).alias("n"))


@query("src3_layout_files", "SELECT max(key) FILTER (lower(key) LIKE '%.tif') AS last_tif, max(key) FILTER (lower(key) LIKE '%.txt') AS last_list FROM @images")
def layout_files(t: Tables) -> DataFrame:
    last = lambda s: F.max(F.when(F.lower("key").endswith(s), F.col("key")))
    return t.images.agg(last(".tif").alias("last_tif"), last(".txt").alias("last_list"))


@query("src1_listing_order", "SELECT image, row_number() OVER (PARTITION BY size % 100 ORDER BY lower(key), image) AS place FROM @images WHERE regexp_matches(key, '(?i)\\.tiff?$')")
def listing_order(t: Tables) -> DataFrame:
    w = Window.partitionBy(F.col("size") % 100).orderBy(F.lower("key"), "image")
    return t.images.filter(F.col("key").rlike(r"(?i)\.tiff?$")).select("image", F.row_number().over(w).alias("place"))


@query("src5_geojson_features", "SELECT gid AS id, 0 AS idx, CAST(scene AS VARCHAR) AS scene FROM @annotations")
def geojson_features(t: Tables) -> DataFrame:
    """Boxes written as GeoJSON collections and read again."""
    texts = t.annotations.select("gid", F.concat(F.lit('{"type":"FeatureCollection","features":['), wr.geojson_feature(box(), ["scene"]), F.lit("]}")).alias("json"))
    return rd.geojson_features(texts, "gid", "json").select("id", "idx", F.col("properties")["scene"].alias("scene"))


@query("src10_manifest_scenes", "SELECT image AS id, 0 AS idx, 's' || CAST(image AS VARCHAR) AS scene, CASE WHEN image % 2 = 0 THEN 's3://bucket/' || key ELSE 'file:/' || key END AS uri FROM @images")
def manifest_scenes(t: Tables) -> DataFrame:
    scene = F.concat(F.lit("s"), F.col("image").cast("string"))
    one = F.to_json(F.struct(F.array(F.struct(scene.alias("scene_id"), F.lit("bucket").alias("bucket"), "key")).alias("scenes")))
    two = F.to_json(F.struct(F.array(F.struct(scene.alias("scene_id"), F.concat(F.lit("file:/"), "key").alias("uri"))).alias("scene_results")))
    return rd.manifest_scenes(t.images.select("image", F.when(F.col("image") % 2 == 0, one).otherwise(two).alias("json")), "image", "json")


@query("src11_tile_index", "SELECT scene, gid, row_number() OVER (PARTITION BY scene ORDER BY gid, x0, y0) - 1 AS idx FROM @annotations WHERE gid % 4 <> 0")
def tile_index(t: Tables) -> DataFrame:
    """Prediction tiles of a manifest; rows without a file are skipped, the others numbered."""
    files = t.annotations.withColumn("npz", F.when(F.col("gid") % 4 != 0, F.concat(F.lit("t"), F.col("gid").cast("string")))).filter("npz is not null")
    return files.select("scene", "gid", (F.row_number().over(Window.partitionBy("scene").orderBy("gid", "x0", "y0")) - 1).alias("idx"))


@query("fn13_flattened_json", "SELECT event_id AS id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM @events")
def flattened_json(t: Tables) -> DataFrame:
    return flatten_json(t.events, "event_id", "props").filter("key = 'k'")


@query("snk3_geojson_rows", "SELECT gid, x0 AS lon, y1 AS lat FROM @annotations")
def geojson_rows(t: Tables) -> DataFrame:
    """Collections of one feature written as gzipped text, and two coordinates read back from it."""
    path = _shared(t, "features")
    features = t.annotations.select("gid", F.array(wr.geojson_feature(box(), ["gid"])).alias("features"))
    wr.write_geojson_gz(features.select(wr.feature_collection(F.concat(F.lit("object_"), F.col("gid").cast("string")), F.col("features"), 3857).alias("text")), path)
    at = lambda p: F.get_json_object("value", "$.features[0]." + p).cast("double").cast("bigint")
    return t.spark.read.text(path).select(at("properties.gid").alias("gid"), at("geometry.coordinates[0][0][0]").alias("lon"), at("geometry.coordinates[0][2][1]").alias("lat"))


@query("snk6_not_committed", "SELECT doc_id FROM @documents WHERE doc_id % 3 <> 0")
def not_committed(t: Tables) -> DataFrame:
    """Documents whose checksum is not in the committed table; every third is."""
    work = wr.with_checksum(t.documents.select("doc_id", "text"), "text").select("doc_id", "sha256")
    return wr.not_committed(work, work.filter("doc_id % 3 = 0"), ["doc_id"]).select("doc_id")


@query("snk2_history_columns", "SELECT scene, string_agg(DISTINCT stage, ',' ORDER BY stage) AS columns FROM @messages GROUP BY 1")
def history_columns(t: Tables) -> DataFrame:
    """The sorted union of the metric names of a run."""
    return t.messages.groupBy("scene").agg(F.array_join(F.sort_array(F.collect_set("stage")), ",").alias("columns"))


@query("snk2_history_csv", "SELECT epochs_completed AS epoch, pixel_f1, CAST(run_id AS DOUBLE) AS run_id, CASE WHEN run_id % 2 = 0 THEN CAST(dataset_scenes AS DOUBLE) END AS train_scenes FROM @runs")
def history_csv(t: Tables) -> DataFrame:
    """Rows of metrics with different names as CSV with the sorted union of the names, read again."""
    entries = [("run_id", F.col("run_id")), ("train_scenes", F.when(F.col("run_id") % 2 == 0, F.col("dataset_scenes"))), ("epoch", F.col("epochs_completed")), ("pixel_f1", F.col("pixel_f1"))]
    metrics = F.map_filter(F.create_map(*(x for k, v in entries for x in (F.lit(k), v.cast("double")))), lambda k, v: v.isNotNull())
    path = _shared(t, "history")
    names = wr.write_history(t.runs.select(metrics.alias("metrics")), "metrics", path)
    return t.spark.read.schema(", ".join(f"`{c}` double" for c in names)).option("header", True).csv(path)


@query("snk7_event_log", "SELECT user_id AS job_id, '{\"event_id\":' || CAST(event_id AS VARCHAR) || '}' AS payload, epoch_us(ts) AS ts_us, event_type AS type FROM @events")
def event_log(t: Tables) -> DataFrame:
    """Events appended as lines of JSON by a stream, with sorted keys; a restart appends none twice."""
    line = lambda s: s.select(F.col("user_id").alias("job_id"), F.to_json(F.struct("event_id")).alias("payload"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), F.col("event_type").alias("type"))
    return _drained(t, line, "json", runs=2)


@query("jn5_first_property_match", f"WITH k AS (SELECT {norm('key')} AS name, min(image) AS image FROM @images GROUP BY 1) SELECT i.image, k.image AS scene FROM @images i JOIN k ON k.name = {norm('i.key')}")
def first_property_match(t: Tables) -> DataFrame:
    """Features to scenes by name; the first scene of a name wins."""
    from ..functions.names import norm_scene_name

    name = norm_scene_name(F.col("key"))
    firsts = t.images.groupBy(name.alias("name")).agg(F.min("image").alias("scene"))
    return t.images.select("image", name.alias("name")).join(firsts, "name").select("image", "scene")


_PROPERTY = "CASE image % 5 WHEN 0 THEN key WHEN 1 THEN lower(regexp_extract(key, '[^/]*$', 0)) WHEN 2 THEN regexp_replace(regexp_extract(key, '[^/]*$', 0), '[.][^.]*$', '') WHEN 3 THEN upper(key) ELSE 'no ' || key END"
_NAMES = ("regexp_extract({k}, '[^/]*$', 0)", "lower(regexp_extract({k}, '[^/]*$', 0))", "regexp_replace(regexp_extract({k}, '[^/]*$', 0), '[.][^.]*$', '')", "lower(regexp_replace(regexp_extract({k}, '[^/]*$', 0), '[.][^.]*$', ''))", norm("{k}"))


@query(
    "jn5_prioritized_names",
    f"""WITH f AS (SELECT image, key, {_PROPERTY} AS name FROM @images),
    s AS (SELECT n, min(image) AS scene FROM (""" + " UNION ALL ".join(f"SELECT {n.format(k='key')} AS n, image FROM @images" for n in _NAMES) + """) q GROUP BY 1),
    c AS (""" + " UNION ALL ".join(f"SELECT image, {p} AS p, {n.format(k='name')} AS n FROM f" for p, n in enumerate(_NAMES)) + """)
    SELECT f.image, arg_min(s.scene, c.p) AS scene FROM f LEFT JOIN c ON c.image = f.image LEFT JOIN s ON s.n = c.n WHERE s.scene IS NOT NULL GROUP BY 1""",
)
def prioritized_names(t: Tables) -> DataFrame:
    """Features to scenes by file name, stem or normalized name, the first of these that a scene has; the first scene of a name has it."""
    features = t.images.select("image", F.expr(_PROPERTY).alias("name"))
    return match_names(features, "image", "name", t.images.select(F.col("image").alias("scene"), "key"), "scene", "key").select("image", "scene")


@query("jn22_unfinished_tiles", f"WITH {_DONE} SELECT n.scene, n.tile FROM needs n WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.scene = n.scene AND d.tile = n.tile)")
def unfinished_tiles(t: Tables) -> DataFrame:
    done = t.messages.select("scene", (F.col("tile") % 12).alias("tile")).distinct()
    return _needs(t).join(done, ["scene", "tile"], "left_anti").select("scene", "tile")


@query("set1_union_sources", "SELECT scene, count(*) AS n FROM (SELECT scene, gid FROM @annotations UNION SELECT scene, abs(pid) FROM @predictions) q GROUP BY 1")
def union_sources(t: Tables) -> DataFrame:
    both = t.annotations.select("scene", "gid").union(t.predictions.select("scene", F.abs("pid").alias("gid"))).distinct()
    return both.groupBy("scene").agg(F.count(F.lit(1)).alias("n"))


@query("set4_required_minus_known", "SELECT scene FROM @annotations EXCEPT SELECT scene FROM @predictions WHERE pid % 2 = 0")
def required_minus_known(t: Tables) -> DataFrame:
    return t.annotations.select("scene").subtract(t.predictions.filter("pid % 2 = 0").select("scene"))


@query("set5_known_stages", "SELECT DISTINCT stage FROM @messages UNION SELECT 'report'")
def known_stages(t: Tables) -> DataFrame:
    return t.messages.select("stage").union(t.spark.createDataFrame([("report",)], "stage string")).distinct()


@query("set6_sorted_warnings", "SELECT scene, string_agg(DISTINCT stage || ':' || CAST(attempt AS VARCHAR), ';' ORDER BY stage || ':' || CAST(attempt AS VARCHAR)) AS warnings FROM @messages GROUP BY 1")
def sorted_warnings(t: Tables) -> DataFrame:
    w = F.concat("stage", F.lit(":"), F.col("attempt").cast("string"))
    return t.messages.groupBy("scene").agg(F.array_join(F.sort_array(F.collect_set(w)), ";").alias("warnings"))


@query("fn9_duration", "SELECT event_id, CASE WHEN attempt > 0 AND bytes * 3 > attempt * 1000 THEN round((bytes * 3 - attempt * 1000) / 1000.0, 3) END AS sec FROM @messages")
def duration(t: Tables) -> DataFrame:
    """Seconds between two marks in milliseconds; null unless the start is set and the end is later."""
    a, b = F.col("attempt") * 1000, F.col("bytes") * 3
    return t.messages.select("event_id", F.when((a > 0) & (b > a), F.round((b - a) / F.lit(1000.0), 3)).alias("sec"))


@query("fn10_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM @orders")
def dates(t: Tables) -> DataFrame:
    """Dates from milliseconds, ISO text with Z, and date-only text."""
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    iso, day = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format("o_orderdate", "yyyy-MM-dd")
    k = F.col("o_orderkey") % 3
    made = F.when(k == 0, F.to_date(F.timestamp_millis(ms))).when(k == 1, F.to_date(F.try_to_timestamp(iso))).otherwise(F.to_date(day))
    return t.orders.select("o_orderkey", made.alias("d"))


@query("fn12_params_summary", "SELECT l_orderkey, l_linenumber, l_partkey, array_to_string(list_filter([CASE WHEN l_tax > 0 THEN 'tax=' || CAST(CAST(round(l_tax * 100) AS INT) AS VARCHAR) END, 'flag=' || l_returnflag, 'line=' || CAST(l_linenumber AS VARCHAR)], lambda x: x IS NOT NULL), ', ') AS params FROM @lineitem")
def params_summary(t: Tables) -> DataFrame:
    """Up to six pieces that are set."""
    tax = F.when(F.col("l_tax") > 0, F.concat(F.lit("tax="), F.rint(F.col("l_tax") * 100).cast("int").cast("string")))
    pieces = F.filter(F.array(tax, F.concat(F.lit("flag="), "l_returnflag"), F.concat(F.lit("line="), F.col("l_linenumber").cast("string"))), lambda x: x.isNotNull())
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(F.slice(pieces, 1, 6), ", ").alias("params"))


_RUN_STAGES = ("prepare_dataset", "train_model", "predict_validation_scenes", "vectorize_validation_predictions", "compute_f1", "report")
_STAGE_PAYLOAD = """CASE run_id % 5 WHEN 0 THEN map('progress', '0.4') WHEN 1 THEN map('progress_fraction', '7') WHEN 2 THEN map('progress_percent', '25')
    WHEN 3 THEN map('fraction', 'soon', 'progress_percent', '50') END"""


@query(
    "fn31_progress",
    """WITH s AS (SELECT run_id, k, CASE k WHEN 1 THEN 5 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 2 ELSE 1 END AS w, CASE run_id % 5 WHEN 0 THEN 0.4 WHEN 1 THEN 1 WHEN 2 THEN 0.25 ELSE 0 END AS part
        FROM @runs, unnest(range(6)) AS u(k))
    SELECT run_id, CAST(round_even(100 * CAST(sum(CASE WHEN k < run_id % 7 THEN w WHEN k = run_id % 7 THEN w * part ELSE 0 END) AS DOUBLE) / 14, 0) AS INT) AS percent FROM s GROUP BY 1""",
)
def progress(t: Tables) -> DataFrame:
    """Percent of a run that is done: finished stages, and the one that it is in by its own account."""
    stages = F.posexplode(F.array(*(F.lit(s) for s in _RUN_STAGES))).alias("k", "stage")
    rows = t.runs.select("run_id", F.expr(_STAGE_PAYLOAD).alias("payload"), stages).withColumn("at", F.col("run_id") % 7)
    current = F.when(F.col("k") == F.col("at"), stage_fraction(F.col("payload"))).otherwise(0.0)
    return rows.groupBy("run_id").agg(progress_percent(F.col("stage"), F.col("k") < F.col("at"), current).alias("percent"))


_WARNINGS = ("12 TIFF/TIF images are available but not selected by scenes_file: a", "geometry fallback used with annotation CRS urn:ogc:def:crs:EPSG::3857", "geometry fallback used with annotation CRS local",
             "3 scenes have zero objects", "no 3 scenes have zero objects", "5 scenes from scenes_file were not matched", "No scenes were matched", "/etc/pipeline.server.yaml not found", "")
_WARNING = f"CASE event_id % {len(_WARNINGS) + 1} " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_WARNINGS)) + " END"


@query(
    "fn34_warning_classes",
    f"""SELECT event_id, CASE WHEN regexp_matches(m, '^\\d+ TIFF/TIF images are available but not selected by scenes_file|^geometry fallback used with annotation CRS .+$|^\\d+ scenes have zero objects') THEN 'info' ELSE 'warning' END AS kind,
    CASE WHEN regexp_matches(m, '^\\d+ TIFF/TIF images are available') THEN 'not_selected' WHEN regexp_matches(m, '^geometry fallback used with') THEN 'geometry_fallback' WHEN regexp_matches(m, '^\\d+ scenes have zero') THEN 'zero_objects' ELSE 'other' END AS code,
    CASE WHEN m LIKE 'geometry%EPSG::3857' THEN 'EPSG:3857' WHEN m LIKE 'geometry%' THEN 'local' WHEN m LIKE '12 TIFF%' THEN '12' WHEN m LIKE '3 scenes%' THEN '3' ELSE m END AS value,
    CASE WHEN m = '' THEN NULL WHEN m LIKE '%pipeline.server.yaml not found%' THEN 'config_missing' WHEN m LIKE '%No scenes were matched%' THEN 'no_scenes' WHEN m LIKE '5 scenes from%' THEN 'scenes_unmatched' WHEN m IS NOT NULL THEN 'technical' END AS error
    FROM (SELECT event_id, {_WARNING} AS m FROM @messages) w""",
)
def warning_classes(t: Tables) -> DataFrame:
    """What a message is as a warning, and as an error; the words to show for a class are the report's."""
    rows = t.messages.select("event_id", F.expr(_WARNING).alias("m")).select("event_id", N.warning_class(F.col("m")).alias("w"), N.error_class(F.col("m")).alias("e"))
    return rows.select("event_id", "w.kind", "w.code", "w.value", F.col("e.code").alias("error"))


@query("wn6_best_two", "SELECT scene, max(bytes) AS best, list_sort(list(bytes), 'DESC')[2] AS second FROM @messages GROUP BY 1")
def best_two(t: Tables) -> DataFrame:
    w = Window.partitionBy("scene").orderBy(F.desc("bytes"), "event_id")
    rows = t.messages.withColumns({"p": F.row_number().over(w), "second": F.lead("bytes").over(w)}).filter("p = 1")
    return rows.select("scene", F.col("bytes").alias("best"), "second")


_F1_KEYS = ("val_f1:0.35", "best_val_pixel_dice/threshold_0.5", "run.F1-t0.45", "loss_0.5", "F1_Pixel", "model_metrics.f1_pixel", "val dice", "Pixel-Dice", "metrics/pixel_f1", "accuracy")
_F1_ROWS = "(SELECT run_id, k, CASE WHEN (run_id + k) % 9 <> 0 THEN CAST((run_id * 7 + k * 13) % 100 AS DOUBLE) / 100 END AS value, CASE k " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(_F1_KEYS)) + " END AS metric FROM {source}) m WHERE (run_id * 3 + k * k) % 5 < 2 AND (k > 2 OR run_id % 3 = 0)"


@query(
    "wn7_best_metric_name",
    f"""WITH m AS (SELECT * FROM {_F1_ROWS.format(source=f"@runs, unnest(range({len(_F1_KEYS)})) AS u(k)")}),
    named AS (SELECT *, CASE WHEN k < 3 THEN CAST(regexp_extract(metric, '([01]\\.\\d+)$', 1) AS DOUBLE) END AS threshold,
        list_position(['f1_pixel', 'model_metrics_f1_pixel', 'best_val_pixel_f1', 'val_pixel_f1', 'pixel_f1', 'best_pixel_f1', 'val_dice', 'dice', 'f1', 'pixel_dice', 'metrics_pixel_f1'],
            regexp_replace(lower(metric), '[^a-z0-9]+', '_', 'g')) AS place FROM m),
    latest AS (SELECT * FROM named QUALIFY threshold IS NOT NULL OR row_number() OVER (PARTITION BY run_id, place ORDER BY threshold IS NOT NULL, k DESC) = 1)
    SELECT run_id, metric, value, threshold FROM latest WHERE value IS NOT NULL AND (threshold IS NOT NULL OR place IS NOT NULL)
    QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY threshold IS NULL, CASE WHEN threshold IS NOT NULL THEN -value END, place, k) = 1""",
)
def best_metric_name(t: Tables) -> DataFrame:
    """Of a run's metrics the largest F1 or Dice at a threshold; without one that of the most preferred name. Of equal names the last counts; without a value, nothing."""
    # dealt out once, by run, before a run becomes rows: both windows find its metrics together
    runs = t.runs.select("run_id").repartition(shuffle_tasks(t.spark), "run_id")
    runs.select("run_id", F.explode(F.sequence(F.lit(0), F.lit(len(_F1_KEYS) - 1))).alias("k")).createOrReplaceTempView("run_metric_places")
    rows = t.spark.sql(f"SELECT * FROM {_F1_ROWS.format(source='run_metric_places')}")
    rows = rows.withColumns({"threshold": N.metric_threshold(F.col("metric")), "rank": N.pixel_f1_place(F.col("metric"))}).filter("threshold is not null or rank is not null")
    later = F.row_number().over(Window.partitionBy("run_id", "rank").orderBy(F.col("threshold").isNotNull(), F.desc("k")))
    rows = rows.withColumn("later", later).filter("value is not null and (threshold is not null or later = 1)")
    order = [F.col("threshold").isNull(), F.when(F.col("threshold").isNotNull(), -F.col("value")), "rank", "k"]
    return rows.withColumn("p", F.row_number().over(Window.partitionBy("run_id").orderBy(*order))).filter("p = 1").select("run_id", "metric", "value", "threshold")


@query("rg14_manifest_choice", "SELECT image, row_number() OVER (PARTITION BY age ORDER BY size % 3 = 0, key DESC) AS place FROM @images")
def manifest_choice(t: Tables) -> DataFrame:
    """Scenes with objects first, then by falling name; of equal names, whose order the SQL leaves open, the first image."""
    return t.images.select("image", F.row_number().over(Window.partitionBy("age").orderBy(F.col("size") % 3 == 0, F.desc("key"), "image")).alias("place"))


#: Augmentation levels, with how often positive, hard negative and negative tiles are repeated, the factors of their
#: strides, and the largest share of empty tiles (none: any).
PRESETS = (
    (0, 1, 1, 1, 1.0, 1.0, 1.0, None),
    (1, 2, 1, 1, 1.0, 1.0, 1.0, 0.5),
    (2, 4, 2, 1, 0.5, 0.5, 1.0, 0.35),
    (3, 6, 3, 1, 0.25, 0.5, 1.0, 0.25),
)


@query(
    "rg17_presets",
    """SELECT level, kind, CAST(r AS INT) AS repeat_factor, CAST(s AS DOUBLE) AS stride_factor, CAST(share AS DOUBLE) AS max_empty_tile_share FROM (VALUES
    (0, 'positive', 1, 1, NULL), (0, 'hard_negative', 1, 1, NULL), (0, 'negative', 1, 1, NULL), (1, 'positive', 2, 1, 0.5), (1, 'hard_negative', 1, 1, 0.5), (1, 'negative', 1, 1, 0.5),
    (2, 'positive', 4, 0.5, 0.35), (2, 'hard_negative', 2, 0.5, 0.35), (2, 'negative', 1, 1, 0.35), (3, 'positive', 6, 0.25, 0.25), (3, 'hard_negative', 3, 0.5, 0.25), (3, 'negative', 1, 1, 0.25)) v(level, kind, r, s, share)""",
)
def presets(t: Tables) -> DataFrame:
    """What each augmentation level does with each kind of tile: a small table of parameters."""
    rows = [(level, kind, rest[k], rest[k + 3], rest[6]) for level, *rest in PRESETS for k, kind in enumerate(("positive", "hard_negative", "negative"))]
    return t.spark.createDataFrame(rows, "level int, kind string, repeat_factor int, stride_factor double, max_empty_tile_share double")


@query("fn3_scene_score")
def scene_score(t: Tables) -> DataFrame:
    """No twin, as of likeness: score and reason of each image's normalized name with the next one's."""
    names = t.images.select("image", N.norm_scene_name(F.col("key")).alias("a"))
    other = names.select((F.col("image") - 1).alias("image"), F.col("a").alias("b"))
    told = names.join(other, "image").withColumn("s", scene_rungs(F.col("a"), F.col("b")))
    return told.select("image", F.round("s.score", 6).alias("score"), "s.reason", first_non_empty(F.col("a"), F.lit("?")).alias("name"))


_ASKED = "CASE image % 5 WHEN 0 THEN upper(key) WHEN 1 THEN '???' WHEN 2 THEN 'long_prefix_of_sixteen_' || {name} WHEN 3 THEN replace(key, 'scn', 'part_scn0') ELSE 'other.tif' END"


@query(
    "fn3_scene_score_rungs",
    f"""WITH n AS (SELECT image, {norm('asked')} AS needle, name FROM (SELECT image, {_ASKED.format(name='name')} AS asked, name FROM (SELECT image, key, {norm('key')} AS name FROM @images) i) j),
    r AS (SELECT *, CASE WHEN needle = '' OR name = '' THEN 'empty' WHEN needle = name THEN 'normalized_exact' WHEN {signature('needle')} = {signature('name')} THEN 'kanopus_datetime_scn_signature'
        WHEN len(needle) >= 16 AND (contains(name, needle) OR contains(needle, name)) THEN 'normalized_substring' ELSE 'sequence_ratio' END AS reason FROM n)
    SELECT image, reason, CAST(CASE reason WHEN 'empty' THEN 0.0 WHEN 'normalized_exact' THEN 1.0 WHEN 'kanopus_datetime_scn_signature' THEN 0.995 WHEN 'normalized_substring' THEN 0.98 END AS DOUBLE) AS score FROM r""",
)
def scene_score_rungs(t: Tables) -> DataFrame:
    """All rungs on names in other spellings; the score of the last one, likeness, is left out for the twin."""
    rows = t.images.withColumn("name", N.norm_scene_name(F.col("key"))).withColumn("asked", F.expr(_ASKED.format(name="name")))
    told = rows.select("image", scene_rungs(N.norm_scene_name(F.col("asked")), F.col("name")).alias("s"))
    return told.select("image", "s.reason", F.when(F.col("s.reason") != "sequence_ratio", F.col("s.score")).alias("score"))


@query("src9_probability_artifacts", "SELECT CAST(scene AS VARCHAR) || '/' || CAST(y AS VARCHAR) AS key, CAST(0 AS BIGINT) AS y, row_number() OVER (PARTITION BY scene, o.y ORDER BY o.x, obs) - 1 AS x, prob8 AS value FROM @observations o")
def probability_artifacts(t: Tables) -> DataFrame:
    """Rows of pixels as arrays of bytes in npy form, read back as probabilities."""
    rows = t.observations.groupBy("scene", "y").agg(F.array_sort(F.collect_list(F.struct("x", "obs", "prob8"))).alias("row"))
    shape = F.concat(F.lit("{'descr': '|u1', 'fortran_order': False, 'shape': (1, "), F.size("row").cast("string"), F.lit("), }"))
    head = F.concat(F.lit("934E554D5059" + "0100" + "7600"), F.hex(F.rpad(shape, 117, " ")), F.lit("0A"))  # mark, version, length 118
    content = F.unhex(F.concat(head, F.array_join(F.transform("row", lambda r: F.lpad(F.hex(r["prob8"]), 2, "0")), "")))
    pixels = rd.probability_pixels(rows.select(F.concat_ws("/", "scene", "y").alias("key"), content.alias("content")))
    return pixels.select("key", "y", "x", F.rint(F.col("prob") * 255).cast("int").alias("value"))


@query("so10_simplified")
def simplified(t: Tables) -> DataFrame:
    """No twin: Douglas-Peucker over the polyline of each order's items. Tests give known lines."""
    from ..operators.raster import simplified as simplify

    points = t.lineitem.select(F.col("l_orderkey").alias("ring"), F.col("l_linenumber").cast("bigint").alias("k"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y")).repartition("ring").dropDuplicates(["ring", "k"])
    return simplify(points, 5.0)


def _shared(t: Tables, label: str) -> str:
    return shared_path(t.spark, label)


@query("snk1_tab_separated", "SELECT run_id, class_slug, pixel_f1 FROM @runs")
def tab_separated(t: Tables) -> DataFrame:
    """A report written as tab-separated text and read again."""
    rows, path = t.runs.select("run_id", "class_slug", "pixel_f1"), _shared(t, "report")
    wr.write_report(rows, path, "tsv")
    return t.spark.read.schema(rows.schema).option("sep", "\t").option("header", True).csv(path)


@query("snk4_match_csv", "SELECT gid, scene, x0, y0, x1, y1 FROM @annotations")
def match_csv(t: Tables) -> DataFrame:
    """Object rows written as CSV and read again."""
    rows, path = t.annotations.select("gid", "scene", "x0", "y0", "x1", "y1"), _shared(t, "objects")
    wr.write_report(rows, path, "csv")
    return t.spark.read.schema(rows.schema).option("header", True).csv(path)


@query("snk5_replaced_json", "SELECT scene, count(*) AS n FROM @messages GROUP BY 1")
def replaced_json(t: Tables) -> DataFrame:
    """A JSON table that is replaced as a whole: readers see the second version only."""
    rows, path = t.messages.groupBy("scene").agg(F.count(F.lit(1)).alias("n")), _shared(t, "state")
    wr.write_report(rows.withColumn("n", F.lit(0).cast("bigint")), path, "json")
    wr.write_report(rows, path, "json")
    return t.spark.read.schema(rows.schema).json(path)
