"""The registry report: admissible runs, version windows, the best run of each class and dataset version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query
from .views import Tables

#: What makes a run trustworthy.
FINAL_STATES = ("FINISHED", "SUCCEEDED", "SUCCESS", "OK", "KILLED")
CUTOFF = "1996-01-01"
LEAST_EPOCHS = 10


def version_windows(versions: DataFrame) -> DataFrame:
    """(dataset_version, start, end) for versions (dataset_version, start): a window ends where the next one starts."""
    order = Window.orderBy("start", "dataset_version")  # a row per version
    return versions.withColumn("end", F.lead("start").over(order))


def exclusion_reason(cutoff: str = CUTOFF, least_epochs: float = LEAST_EPOCHS) -> Column:
    """Why a run (joined with its version's window) is left out of the report; null for admissible ones."""
    f1 = F.col("pixel_f1")
    status = F.upper("run_status")
    return (
        F.when(F.col("report_exclude"), "report_excluded")
        .when(f1.isNull() | (f1 < 0) | (f1 >= 1), "invalid_pixel_f1")
        .when((status != "") & ~status.isin(*FINAL_STATES), "non_terminal_run_status")
        .when(F.col("train_date").isNull() | (F.col("train_date") < F.lit(cutoff).cast("date")), "train_date_before_cutoff")
        .when(F.col("epochs_completed").isNull() | (F.col("epochs_completed") < least_epochs), "insufficient_epochs")
        .when(F.lower("metric_name_source").contains("object"), "object_metric_source")
        .when(F.coalesce(F.col("dataset_version"), F.lit("")) == "", "missing_dataset_version")
        .when(F.col("train_date") < F.col("start"), "train_date_before_dataset_date")
        .when(F.col("train_date") >= F.col("end"), "train_date_after_next_dataset_version")
        .when(F.coalesce(F.col("dataset_scenes"), F.lit(0)) <= 0, "missing_dataset_scene_count")
        .when(F.coalesce(F.col("dataset_objects"), F.lit(0)) <= 0, "missing_dataset_object_count")
    )


def judged(t: Tables) -> DataFrame:
    """Runs with their window and the reason of exclusion. There are few versions: the join is broadcast by size at run time."""
    return t.runs.join(version_windows(t.versions), "dataset_version", "left").withColumn("reason", exclusion_reason())


def ranked(runs: DataFrame, *keys: str) -> DataFrame:
    """Adds place: by F1, largest first and null last, then earlier date, then run."""
    order = [F.col("pixel_f1").desc_nulls_last(), F.col("train_date").asc_nulls_first(), F.col("run_id")]
    return runs.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


_WINDOWS = "windows AS (SELECT dataset_version, start, lead(start) OVER (ORDER BY start, dataset_version) AS \"end\" FROM @versions)"
_JUDGED = (
    _WINDOWS
    + """,
    judged AS (SELECT r.*, v.start, v."end", CASE WHEN report_exclude THEN 'report_excluded'
        WHEN pixel_f1 IS NULL OR pixel_f1 < 0 OR pixel_f1 >= 1 THEN 'invalid_pixel_f1'
        WHEN run_status <> '' AND upper(run_status) NOT IN ('FINISHED', 'SUCCEEDED', 'SUCCESS', 'OK', 'KILLED') THEN 'non_terminal_run_status'
        WHEN train_date < DATE '1996-01-01' THEN 'train_date_before_cutoff'
        WHEN epochs_completed < 10 THEN 'insufficient_epochs'
        WHEN metric_name_source LIKE '%object%' THEN 'object_metric_source'
        WHEN train_date < v.start THEN 'train_date_before_dataset_date'
        WHEN train_date >= v."end" THEN 'train_date_after_next_dataset_version'
        WHEN dataset_scenes <= 0 THEN 'missing_dataset_scene_count'
        WHEN coalesce(dataset_objects, 0) <= 0 THEN 'missing_dataset_object_count' END AS reason
        FROM @runs r LEFT JOIN windows v USING (dataset_version))"""
)
_PLACE = "row_number() OVER (PARTITION BY {} ORDER BY pixel_f1 DESC NULLS LAST, train_date, run_id)"


@query("wn1_best_run_per_version", f"WITH {_JUDGED} SELECT * EXCLUDE (p) FROM (SELECT class_slug, dataset_version, run_id, pixel_f1, train_date, {_PLACE.format('class_slug, dataset_version')} AS p FROM judged WHERE reason IS NULL) q WHERE p = 1")
def best_run_per_version(t: Tables) -> DataFrame:
    """The flagship query: for each class and dataset version the best admissible run."""
    best = ranked(judged(t).filter("reason is null"), "class_slug", "dataset_version").filter("place = 1")
    return best.select("class_slug", "dataset_version", "run_id", "pixel_f1", "train_date")


@query("wn2_overall_best", f"WITH {_JUDGED} SELECT run_id, class_slug, dataset_version, pixel_f1, train_date FROM judged WHERE reason IS NULL ORDER BY pixel_f1 DESC NULLS LAST, train_date, run_id LIMIT 1")
def overall_best(t: Tables) -> DataFrame:
    rows = judged(t).filter("reason is null").orderBy(F.col("pixel_f1").desc_nulls_last(), "train_date", "run_id")
    return rows.select("run_id", "class_slug", "dataset_version", "pixel_f1", "train_date").limit(1)


@query("wn3_version_windows", f'WITH {_WINDOWS} SELECT dataset_version, start, "end" FROM windows')
def windows(t: Tables) -> DataFrame:
    return version_windows(t.versions)


@query("ag23_exclusion_reasons", f"WITH {_JUDGED} SELECT coalesce(reason, 'admitted') AS reason, count(*) AS n FROM judged GROUP BY 1")
def exclusion_reasons(t: Tables) -> DataFrame:
    return judged(t).groupBy(F.coalesce("reason", F.lit("admitted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("jn23_runs_in_window", f'WITH {_WINDOWS} SELECT r.run_id, r.dataset_version, v.start IS NOT NULL AND r.train_date >= v.start AND (v."end" IS NULL OR r.train_date < v."end") AS inside FROM @runs r LEFT JOIN windows v USING (dataset_version)')
def runs_in_window(t: Tables) -> DataFrame:
    inside = F.col("start").isNotNull() & (F.col("train_date") >= F.col("start")) & (F.col("end").isNull() | (F.col("train_date") < F.col("end")))
    return t.runs.join(version_windows(t.versions), "dataset_version", "left").select("run_id", "dataset_version", inside.alias("inside"))


@query(
    "jn17_merge_runs",
    """SELECT o.o_orderkey AS run_id, coalesce(l.ship, CAST(o.o_orderdate AS DATE)) AS train_date, coalesce(nullif(l.flag, ''), o.o_orderstatus) AS status
    FROM @orders o LEFT JOIN (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS ship, max(CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END) AS flag FROM @lineitem GROUP BY 1) l ON l.l_orderkey = o.o_orderkey""",
)
def merge_runs(t: Tables) -> DataFrame:
    """Runs from two readers: of each field the later reader's value, unless that is empty."""
    first = t.orders.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").cast("date").alias("train_date"), F.col("o_orderstatus").alias("status"))
    flag = F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(F.col("l_returnflag"))
    second = t.lineitem.groupBy(F.col("l_orderkey").alias("run_id")).agg(F.max("l_shipdate").cast("date").alias("ship"), F.max(flag).alias("flag"))
    return first.join(second, "run_id", "left").select("run_id", F.coalesce("ship", "train_date").alias("train_date"), F.coalesce(F.nullif("flag", F.lit("")), "status").alias("status"))


@query(
    "jn18_runs_of_inventory",
    """WITH inv AS (SELECT class_slug, 'v' || CAST(count(*) % 12 AS STRING) AS version, count(*) % 9 * 10 AS objects, count(*) % 7 AS scenes FROM @runs GROUP BY 1),
    m AS (SELECT r.run_id, r.class_slug, r.pixel_f1, r.train_date, CASE WHEN r.dataset_version = i.version THEN 1
        WHEN r.dataset_objects = i.objects AND r.dataset_scenes = i.scenes THEN 2 WHEN r.dataset_objects = i.objects THEN 3 END AS rule
        FROM @runs r JOIN inv i USING (class_slug)),
    b AS (SELECT *, min(rule) OVER (PARTITION BY class_slug) AS best FROM m WHERE rule IS NOT NULL)
    SELECT class_slug, run_id, rule, pixel_f1 FROM (SELECT *, row_number() OVER (PARTITION BY class_slug ORDER BY pixel_f1 DESC NULLS LAST, train_date, run_id) AS p FROM b WHERE rule = best) q WHERE p = 1""",
)
def runs_of_inventory(t: Tables) -> DataFrame:
    """For each class the best run on its present dataset: by version, else by both counts, else by the object count."""
    n = F.count(F.lit(1))
    inventory = t.runs.groupBy("class_slug").agg(F.concat(F.lit("v"), (n % 12).cast("string")).alias("version"), (n % 9 * 10).alias("objects"), (n % 7).alias("scenes"))
    objects = F.col("dataset_objects") == F.col("objects")
    rule = F.when(F.col("dataset_version") == F.col("version"), 1).when(objects & (F.col("dataset_scenes") == F.col("scenes")), 2).when(objects, 3)
    matched = t.runs.join(inventory, "class_slug").withColumn("rule", rule).filter("rule is not null")
    order = ["rule", F.col("pixel_f1").desc_nulls_last(), "train_date", "run_id"]
    best = matched.withColumn("place", F.row_number().over(Window.partitionBy("class_slug").orderBy(*order)))
    return best.filter("place = 1").select("class_slug", "run_id", "rule", "pixel_f1")


@query(
    "jn19_classes_with_runs",
    f"""WITH {_JUDGED}, c AS (SELECT DISTINCT class_slug FROM @runs UNION SELECT 'class_without_runs')
    SELECT c.class_slug, count(j.run_id) AS n_runs, max(j.pixel_f1) AS best_f1, CASE WHEN count(j.run_id) = 0 THEN 'no runs' END AS warning
    FROM c LEFT JOIN judged j ON j.class_slug = c.class_slug AND j.reason IS NULL GROUP BY 1""",
)
def classes_with_runs(t: Tables) -> DataFrame:
    """Every class keeps its row, also without admissible runs."""
    classes = t.runs.select("class_slug").union(t.spark.createDataFrame([("class_without_runs",)], "class_slug string")).distinct()
    counts = judged(t).filter("reason is null").groupBy("class_slug").agg(F.count(F.lit(1)).alias("n"), F.max("pixel_f1").alias("best_f1"))
    n = F.coalesce("n", F.lit(0))
    return classes.join(counts, "class_slug", "left").select("class_slug", n.alias("n_runs"), "best_f1", F.when(n == 0, "no runs").alias("warning"))


@query("wn4_leaderboard", f"SELECT run_id, class_slug, pixel_f1, {_PLACE.format('class_slug')} AS place FROM @runs")
def leaderboard(t: Tables) -> DataFrame:
    return ranked(t.runs, "class_slug").select("run_id", "class_slug", "pixel_f1", "place")


@query("src13_search_runs", "SELECT run_id, pixel_f1, train_date FROM @runs WHERE class_slug = '1-urgent' AND pixel_f1 > 0.5 ORDER BY pixel_f1 DESC, run_id LIMIT 50")
def search_runs(t: Tables) -> DataFrame:
    """Runs by filter, order and limit; the limit is the report's."""
    rows = t.runs.filter((F.col("class_slug") == "1-urgent") & (F.col("pixel_f1") > 0.5))
    return rows.select("run_id", "pixel_f1", "train_date").orderBy(F.desc("pixel_f1"), "run_id").limit(50)


@query(
    "rg16_tuning_status",
    """SELECT class_slug, CASE WHEN count(*) FILTER (run_status = '') > count(*) * 0.6 THEN 'stopped' WHEN max(CASE WHEN pixel_f1 >= 0 AND pixel_f1 < 1 THEN pixel_f1 END) IS NULL THEN 'not_started'
        WHEN max(CASE WHEN pixel_f1 >= 0 AND pixel_f1 < 1 THEN pixel_f1 END) >= 0.9 THEN 'done' ELSE 'running' END AS status,
        max(CASE WHEN pixel_f1 >= 0 AND pixel_f1 < 1 THEN pixel_f1 END) AS best_f1 FROM @runs GROUP BY 1""",
)
def tuning_status(t: Tables) -> DataFrame:
    valid = F.when((F.col("pixel_f1") >= 0) & (F.col("pixel_f1") < 1), F.col("pixel_f1"))
    told = t.runs.groupBy("class_slug").agg(F.max(valid).alias("best_f1"), (F.count_if(F.col("run_status") == "") > F.count(F.lit(1)) * 0.6).alias("stopped"))
    status = F.when(F.col("stopped"), "stopped").when(F.col("best_f1").isNull(), "not_started").when(F.col("best_f1") >= 0.9, "done").otherwise("running")
    return told.select("class_slug", status.alias("status"), "best_f1")


@query(
    "rg15_publication_date",
    "SELECT dataset_version, coalesce(min(CASE WHEN run_status = 'FINISHED' AND run_id % 2 = 0 THEN train_date END), max(train_date)) AS published FROM @runs GROUP BY 1",
)
def publication_date(t: Tables) -> DataFrame:
    """The date of a commit where there is one, else of the newest file."""
    commit = F.min(F.when((F.col("run_status") == "FINISHED") & (F.col("run_id") % 2 == 0), F.col("train_date")))
    return t.runs.groupBy("dataset_version").agg(F.coalesce(commit, F.max("train_date")).alias("published"))
