"""Domain tables derived from the star-schema test tables by integer arithmetic.

Each view is SQL that Spark and DuckDB read alike; `@name` stands for a base table or another
view. The Spark queries and their twins therefore start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    # A scene for each part; scenes lie on a grid of 500 units, 40 to a row, and are up to 599 wide, so neighbours overlap, touch or miss each other.
    "scenes": """
        SELECT p_partkey AS scene, 200 + (p_size * 13) % 400 AS w, 160 + (p_partkey * 7) % 300 AS h,
            (p_partkey % 40) * 500 AS ox, CAST(floor(p_partkey / 40) AS BIGINT) * 300 AS oy FROM @part""",
    # An image file for each part, named in one of seven ways.
    "images": """
        SELECT p_partkey AS image, 'root/region' || CAST(p_partkey % 7 AS STRING) || '/' || replace(p_brand, '#', '') || '/' ||
            CASE p_partkey % 7 WHEN 0 THEN 'scene_' || lpad(CAST(p_partkey AS STRING), 6, '0') || '_cog.tif'
                WHEN 1 THEN 'SCENE-' || lpad(CAST(p_partkey AS STRING), 6, '0') || '.TIF'
                WHEN 2 THEN 'Scene ' || lpad(CAST(p_partkey AS STRING), 6, '0') || '.tiff'
                WHEN 3 THEN 'kanopus-2024' || lpad(CAST(p_partkey % 1200 AS STRING), 4, '0') || '-' || lpad(CAST(p_partkey % 86400 AS STRING), 6, '0') || '-scn' || CAST(p_size % 12 AS STRING) || '.tif'
                WHEN 4 THEN 'scene_' || lpad(CAST(p_partkey AS STRING), 6, '0') || '.tif.aux.xml'
                WHEN 5 THEN 'ортофото_scene_' || lpad(CAST(p_partkey AS STRING), 6, '0') || '.tif'
                ELSE 'readme_' || CAST(p_partkey AS STRING) || '.txt' END AS key,
            CAST(floor(p_retailprice * 100) AS BIGINT) AS size, p_size AS age FROM @part""",
    # Lines of a scene list: names in other spellings, comments, blanks, folders.
    "scene_lines": """
        SELECT p_partkey AS seq, CASE p_partkey % 8 WHEN 0 THEN '  scene_' || lpad(CAST(p_partkey AS STRING), 6, '0') || '.tif  extra words'
                WHEN 1 THEN 'scene-' || lpad(CAST(p_partkey AS STRING), 6, '0') || '_COG.tif'
                WHEN 2 THEN '# ' || p_name
                WHEN 3 THEN ''
                WHEN 4 THEN 'KANOPUS_2024' || lpad(CAST(p_partkey % 1200 AS STRING), 4, '0') || lpad(CAST(p_partkey % 86400 AS STRING), 6, '0') || '_SCN0' || CAST(p_size % 9 AS STRING) || '_cog.tif'
                WHEN 5 THEN 'root' || chr(92) || 'region' || CAST(p_partkey % 7 AS STRING) || chr(92) || replace(p_brand, '#', '')
                WHEN 6 THEN 'SCENE_' || lpad(CAST(p_partkey AS STRING), 6, '0') || '.TIFF'
                ELSE 'missing_' || CAST(p_partkey AS STRING) || '.tif' END AS raw FROM @part""",
    # Annotation boxes in pixels of their scene, and predictions: annotations moved, some lost, some doubled.
    "annotations": """
        SELECT l_partkey AS scene, l_orderkey * 8 + l_linenumber AS gid, l_suppkey AS prop,
            (l_orderkey * 37 + l_linenumber * 101) % 500 AS x0, (l_orderkey * 53 + l_suppkey * 17) % 400 AS y0,
            (l_orderkey * 37 + l_linenumber * 101) % 500 + 4 + CAST(l_quantity AS BIGINT) AS x1,
            (l_orderkey * 53 + l_suppkey * 17) % 400 + 4 + CAST(l_quantity AS BIGINT) % 30 AS y1 FROM @lineitem""",
    "predictions": """
        SELECT scene, gid AS pid, x0 + gid % 5 AS x0, y0 + gid % 3 AS y0, x1 + gid % 5 AS x1, y1 + gid % 3 AS y1 FROM @annotations WHERE gid % 7 <> 0
        UNION ALL SELECT scene, -gid AS pid, x0, y0, x1 + 1, y1 FROM @annotations WHERE gid % 11 = 0""",
    # Corners of outlines: of every four, one is a ring that crosses itself, one a triangle, one an L, one a star of five points; every fifth ring has a hole of its own.
    "corners": """
        SELECT scene, gid, 0 AS ring, k, x0 + CASE gid % 4 WHEN 0 THEN CASE WHEN k IN (1, 2) THEN w ELSE 0 END WHEN 1 THEN CASE k WHEN 1 THEN w WHEN 2 THEN CAST(floor(w / 2) AS BIGINT) ELSE 0 END
                WHEN 2 THEN CASE WHEN k IN (1, 2) THEN w WHEN k IN (3, 4) THEN CAST(floor(w / 3) AS BIGINT) ELSE 0 END
                ELSE CAST(floor(w * CASE k WHEN 0 THEN 5 WHEN 1 THEN 8 WHEN 2 THEN 0 WHEN 3 THEN 10 ELSE 2 END / 10) AS BIGINT) END AS x,
            y0 + CASE gid % 4 WHEN 0 THEN CASE WHEN k IN (1, 3) THEN h ELSE 0 END WHEN 1 THEN CASE WHEN k IN (2, 3) THEN CASE k WHEN 2 THEN h ELSE 0 END ELSE 0 END
                WHEN 2 THEN CASE WHEN k IN (2, 3) THEN CAST(floor(h / 3) AS BIGINT) WHEN k IN (4, 5) THEN h ELSE 0 END
                ELSE CAST(floor(h * CASE k WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 4 WHEN 3 THEN 4 ELSE 10 END / 10) AS BIGINT) END AS y
        FROM (SELECT scene, gid, x0, y0, w, h, k FROM @outline_boxes JOIN @corner_numbers ON k < CASE gid % 4 WHEN 2 THEN 6 WHEN 3 THEN 5 ELSE 4 END) q
        UNION ALL SELECT scene, gid, 1 AS ring, k, x0 + 1 + CASE WHEN k IN (1, 2) THEN 2 ELSE 0 END AS x, y0 + 1 + CASE WHEN k IN (2, 3) THEN 2 ELSE 0 END AS y
        FROM @outline_boxes JOIN @corner_numbers ON k < 4 WHERE gid % 5 = 0""",
    "outline_boxes": """
        SELECT scene, gid, max(x0) AS x0, max(y0) AS y0, max(x1 - x0) AS w, max(y1 - y0) AS h FROM @annotations GROUP BY scene, gid""",
    "corner_numbers": """
        SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4 UNION ALL SELECT 5""",
    # Pixels seen by tiles: one row for each observation; ignore label 255.
    "observations": """
        SELECT l_partkey AS scene, l_orderkey % 64 AS y, (l_suppkey * 3 + l_linenumber) % 64 AS x, l_linenumber AS tile, l_orderkey * 8 + l_linenumber AS obs,
            CAST((l_orderkey * 31 + l_suppkey * 17 + l_linenumber) % 256 AS INT) AS prob8,
            CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 255 WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 1 ELSE 0 END AS INT) AS truth,
            1 + l_linenumber % 4 AS weight FROM @lineitem""",
    # Training runs.
    "runs": """
        SELECT o_orderkey AS run_id, lower(replace(o_orderpriority, ' ', '_')) AS class_slug, 'v' || CAST(o_custkey % 9 AS STRING) AS dataset_version,
            CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST((o_orderkey * 7919) % 1050 AS DOUBLE) / 1000 END AS pixel_f1,
            CAST(o_orderdate AS DATE) AS train_date, CAST((o_orderkey * 31) % 60 AS DOUBLE) AS epochs_completed,
            CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey % 9 * 10 END AS dataset_objects, o_custkey % 9 AS dataset_scenes,
            CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE '' END AS run_status,
            CASE WHEN o_orderkey % 19 = 0 THEN 'val/object_f1' ELSE 'val/pixel_f1' END AS metric_name_source,
            o_orderkey % 23 = 0 AS report_exclude, o_totalprice AS price FROM @orders""",
    "versions": """
        SELECT dataset_version, make_date(1994 + CAST(substr(dataset_version, 2) AS INT), 3, 1) AS start FROM @runs GROUP BY dataset_version""",
    # Queue messages and gauge samples.
    "messages": """
        SELECT event_id, ts, user_id AS scene, event_type AS stage, CAST(floor(value * 100) AS BIGINT) AS bytes, value, event_id % 4 AS attempt, event_id % 97 AS tile FROM @events""",
}


def _closure(names: list[str]) -> list[str]:
    """The views that names need, each after those that it needs itself."""
    out: list[str] = []
    for n in names:
        if n in VIEWS:
            for m in [*_closure(re.findall(r"@(\w+)", VIEWS[n])), n]:
                if m not in out:
                    out.append(m)
    return out


def duck(sql: str) -> str:
    """sql with its views as common table expressions in front; `@name` becomes `name`."""
    needed = _closure(re.findall(r"@(\w+)", sql))
    plain = lambda s: re.sub(r"@(\w+)", r"\1", s)
    heads = [f"{n} AS ({plain(VIEWS[n])})" for n in needed]
    body = plain(sql).strip()
    if not heads:
        return body
    if m := re.match(r"WITH\s+(RECURSIVE\s+)?", body, re.I):
        return m[0] + ", ".join(heads) + ", " + body[m.end() :]
    return "WITH " + ", ".join(heads) + " " + body


class Tables:
    """Base tables and views of one data folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def base(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.base(name)
        if name in VIEWS:
            return self.sql(f"SELECT * FROM @{name}")
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        """SQL over `@names`, by Spark."""
        needed = _closure(re.findall(r"@(\w+)", text))
        used: set[str] = set()

        def plain(s: str) -> str:
            def one(m: re.Match) -> str:
                if m[1] in BASE:
                    used.add(m[1])
                    return "{" + m[1] + "}"
                return m[1]

            return re.sub(r"@(\w+)", one, s)

        heads = [f"{n} AS ({plain(VIEWS[n])})" for n in needed]
        body = plain(text)
        return self.spark.sql(("WITH " + ", ".join(heads) + " " if heads else "") + body, **{n: self.base(n) for n in used})
