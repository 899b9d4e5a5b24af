"""Record-shaped views of the driver tables.

Each view is one SQL text that Spark and DuckDB both run, over whole tables. The CASE
arms only decide what a row looks like, never whether it takes part."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cairnbook.sources.readers import read_table

BRIDGES = {
    # events -> extraction records: repeated sources, missing keys, mixed case, score ties
    "bridge_artifacts": """
SELECT event_id AS record_id,
  concat('https://www.', event_type, '.example.com/a/', cast(user_id % 40 AS string)) AS source_url,
  ts AS extracted_at,
  CASE WHEN event_id % 7 = 0 THEN NULL
       WHEN event_id % 2 = 0 THEN concat('Mount ', cast(event_id % 11 AS string))
       ELSE concat('MOUNT ', cast(event_id % 11 AS string)) END AS mountain_name,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE cast(cast(ts AS date) AS string) END AS accident_date,
  CASE WHEN event_id % 15 = 0 THEN NULL ELSE cast(cast(ts AS date) + 1 AS string) END AS article_date_published,
  concat('Report ', CASE WHEN event_id % 17 = 0 THEN 'None ' ELSE '' END, cast(event_id % 300 AS string)) AS article_title,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast(event_id % 101 AS double) / 100 END AS extraction_confidence_score,
  cast(event_id % 5 AS int) AS num_people_involved,
  cast(user_id % 4 AS int) AS num_fatalities,
  CASE WHEN event_id % 3 = 0 THEN NULL
       ELSE split(concat('u', cast(event_id % 6 AS string), ',u', cast(user_id % 6 AS string)), ',') END AS photo_urls,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE concat('Summary ', repeat('x', cast(event_id % 9 AS int))) END AS accident_summary_text
FROM events""",
    # the same records as JSON documents
    "bridge_json": """
SELECT record_id, source_url, extracted_at, mountain_name, extraction_confidence_score,
  concat('{"source_url":"', source_url, '","extracted_at":"', substring(cast(extracted_at AS string), 1, 19),
    '","article_title":"', article_title, '","num_fatalities":', cast(num_fatalities AS string),
    ',"article_text":"line one  of ', cast(record_id AS string), '\\n line two"',
    CASE WHEN mountain_name IS NULL THEN '' ELSE concat(',"mountain_name":"', mountain_name, '"') END,
    CASE WHEN accident_date IS NULL THEN '' ELSE concat(',"accident_date":"', accident_date, '"') END,
    CASE WHEN extraction_confidence_score IS NULL THEN '' ELSE concat(',"extraction_confidence_score":', cast(extraction_confidence_score AS string)) END,
    ',"photo_urls":["p', cast(record_id % 6 AS string), '","p', cast(record_id % 4 AS string), '"]',
    ',"people":[{"name":"N', cast(record_id % 9 AS string), '"}]',
    CASE WHEN record_id % 8 = 0 THEN ',"video_urls":"none"' ELSE concat(',"video_urls":["v', cast(record_id % 3 AS string), '"]') END,
    ',"derived_metrics":{"m', cast(record_id % 3 AS string), '":', cast(record_id % 10 AS string), '}}') AS artifact_json
FROM bridge_artifacts""",
    # orders -> article texts that touch every extraction rule
    "bridge_articles": """
SELECT o_orderkey AS doc_id,
  concat(CASE WHEN o_orderkey % 6 = 0 THEN 'Story by ' WHEN o_orderkey % 6 = 1 THEN 'By AP\n' ELSE 'By ' END, 'Jane Doe | ',
    CASE o_orderkey % 4 WHEN 0 THEN 'Published: Oct ' WHEN 1 THEN 'Seen Sept. ' WHEN 2 THEN 'July ' ELSE 'Posted - March ' END,
    cast(o_orderkey % 28 + 1 AS string), CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE ', 2024' END, '. Climber Alan Reed, ',
    cast(o_orderkey % 60 + 18 AS string), ', fell ', cast(o_orderkey % 900 + 100 AS string),
    CASE o_orderkey % 3 WHEN 0 THEN ' feet' WHEN 1 THEN 'ft' ELSE ' meters' END, '. A ',
    cast(o_custkey % 60 + 18 AS string), CASE WHEN o_custkey % 2 = 0 THEN '-year-old woman' ELSE ' year old Man' END, ' was with them! ',
    CASE WHEN o_orderkey % 5 = 0 THEN 'Two people died' ELSE concat(cast(o_orderkey % 4 AS string), ' killed') END,
    ' and ', cast(o_custkey % 3 AS string), ' injured. Squamish Search and Rescue and RCMP came',
    CASE WHEN o_custkey % 3 = 0 THEN ' with police in Garibaldi Provincial Park' WHEN o_custkey % 3 = 1 THEN ' at Lake Louise Ski Area near Whistler' ELSE '' END,
    '. The route is 5.', cast(o_orderkey % 14 AS string), CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE '' END,
    ', class ', cast(o_custkey % 6 AS string), ', on a ', cast(o_orderkey % 80 AS string), ' degrees',
    CASE WHEN o_orderkey % 7 = 0 THEN ' NE facing' ELSE '' END, ' face. Rope and harness, ',
    CASE WHEN o_custkey % 4 = 0 THEN 'no bolt' ELSE 'one piton' END, '. See https://www.gripped.com/n/',
    cast(o_custkey % 50 AS string), '). Logged 2024-0', cast(o_orderkey % 9 + 1 AS string), '-1', cast(o_orderkey % 10 AS string), '.') AS text
FROM orders""",
    # orders -> loosely typed extraction results
    "bridge_raw": """
SELECT o_orderkey AS record_id,
  concat('{"source_url":" https://news.example.com/', cast(o_custkey AS string), ' ","region":',
    CASE o_orderkey % 4 WHEN 0 THEN '"  "' WHEN 1 THEN '7' WHEN 2 THEN 'null' ELSE '" BC "' END,
    ',"article_date_published":"', CASE o_orderkey % 5 WHEN 0 THEN '2025-10-01Z' WHEN 1 THEN 'Oct 3, 2025' WHEN 2 THEN '4 October 2025'
       WHEN 3 THEN 'n/a' ELSE '10/05/2025' END, '","num_people_involved":',
    CASE o_orderkey % 5 WHEN 0 THEN '"3"' WHEN 1 THEN '2' WHEN 2 THEN '3.9' WHEN 3 THEN '"x"' ELSE 'true' END,
    ',"num_fatalities":', CASE o_custkey % 3 WHEN 0 THEN '" 4 "' WHEN 1 THEN '1' ELSE '[]' END,
    ',"fall_height_meters_estimate":', CASE o_custkey % 4 WHEN 0 THEN '"30.5"' WHEN 1 THEN '12' WHEN 2 THEN '"tall"' ELSE '7.25' END,
    ',"self_rescue_boolean":', CASE o_custkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN '"Yes"' WHEN 2 THEN '"0"' WHEN 3 THEN '1' ELSE '"maybe"' END,
    ',"extraction_confidence_score":', CASE o_orderkey % 3 WHEN 0 THEN '"2.0"' WHEN 1 THEN '0.5' ELSE '"0.75"' END,
    ',"route_confidence_score":', CASE o_orderkey % 3 WHEN 0 THEN '1.5' WHEN 1 THEN '-0.5' ELSE '0.25' END,
    ',"photo_urls":', CASE o_orderkey % 4 WHEN 0 THEN '" one.jpg "' WHEN 1 THEN '[" a "," ","b","a"]' WHEN 2 THEN '[]' ELSE '5' END,
    ',"people":[{"name":" P', cast(o_custkey % 50 AS string), ' ","age":"', cast(o_orderkey % 70 AS string), '","outcome":" Minor "},"skip",{"name":"  ","age":"x"}]',
    ',"anchors":[{"kind":"bolt","note":" "},{"note":""},3]',
    ',"consensus_state":" ', o_orderpriority, ' ","weather_note":" cold ","missing_since":"',
    CASE WHEN o_orderkey % 2 = 0 THEN '2025/09/30' ELSE 'unknown' END, '","blank_note":"  ","odd_number":5}') AS raw
FROM orders""",
    # part -> Markdown reports
    "bridge_reports": """
SELECT CASE WHEN p_partkey % 50 = 7 THEN concat('zz', cast(p_partkey AS string)) ELSE substring(md5(cast(p_partkey AS string)), 1, 12) END AS id,
  concat(CASE WHEN p_partkey % 10 = 9 THEN '' ELSE concat('---\n',
      CASE WHEN p_partkey % 6 = 0 THEN '' ELSE concat('title: "', p_name, ' incident"\n') END,
      'date_of_event: ', CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '2024-05-0' WHEN 2 THEN 'Specific date known (month/day: May ' ELSE '2023-11-0' END,
      CASE WHEN p_partkey % 4 = 0 THEN '' ELSE cast(p_partkey % 9 + 1 AS string) END, '\n',
      CASE WHEN p_partkey % 5 = 0 THEN '' ELSE concat('region: ', p_brand, '\n') END,
      CASE WHEN p_partkey % 7 = 0 THEN 'odd line without colon mark\n' ELSE '' END,
      CASE WHEN p_partkey % 11 = 0 THEN 'colour: red\n' ELSE '' END,
      'audience: climbers\n', CASE WHEN p_partkey % 13 = 0 THEN '' ELSE concat('event_id: e', cast(p_partkey % 1900 AS string), '\n') END, '---\n') END,
    '\n# ', p_name, ' Report\n\n## Executive Summary\n- A ', p_type, ' fall was reported.\n- Nobody else was hurt.\n\n## Location and Context\n',
    CASE WHEN p_partkey % 3 = 0 THEN concat('- Peak/Area: ', p_brand, ' Peak\n') ELSE '' END,
    CASE WHEN p_partkey % 2 = 0 THEN concat('* Activity/Style - ', p_type, '\n') ELSE '' END,
    CASE WHEN p_partkey % 4 = 1 THEN '\n## Sources\n- old: http://old.example/x\n' ELSE '' END, '\n## Notes\nEnd.\n') AS markdown
FROM part""",
    # lineitem -> image candidates of pages
    "bridge_images": """
SELECT l_orderkey AS page_id, l_linenumber * 100000 + l_partkey AS pos,
  concat('https://www.site', cast(l_suppkey % 20 AS string), '.example.com/story') AS page_url,
  concat(CASE l_partkey % 5 WHEN 0 THEN 'https://cdn.example.net' ELSE concat('https://site', cast(l_suppkey % 20 AS string), '.example.com') END,
    CASE l_partkey % 4 WHEN 0 THEN '/uploads/' WHEN 1 THEN '/img/' WHEN 2 THEN '/wp-content/a/' ELSE '/media/' END,
    CASE WHEN l_partkey % 9 = 0 THEN 'logo' ELSE 'pic' END, cast(l_partkey % 70 AS string),
    CASE l_suppkey % 4 WHEN 0 THEN '.jpg' WHEN 1 THEN '.PNG' WHEN 2 THEN '.gif' ELSE '.webp' END) AS image_url,
  CASE l_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '   ' WHEN 2 THEN concat('The rescue  on the ridge | Image: ', l_returnflag)
       WHEN 3 THEN concat('A person ', l_linestatus) WHEN 4 THEN concat('Snow\n on the  peak ', l_returnflag) ELSE 'company logo' END AS caption_raw,
  CASE l_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'text/html' ELSE 'image/jpeg' END AS content_type,
  CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE cast(l_quantity * 300 AS bigint) END AS content_length,
  cast(l_quantity * 20 AS int) AS width, cast(l_partkey % 500 AS int) AS height
FROM lineitem""",
    # conversations -> batch items and answers
    "bridge_items": """
SELECT conv_id AS batch_id, cast(turn AS int) AS pos, concat('https://news.example.com/', cast(conv_id AS string), '/', cast(turn AS string)) AS url,
  text AS focused_text, CASE WHEN turn % 2 = 0 THEN '' ELSE concat('By Ann Lee | Published: Oct 3, 2024. ', text) END AS full_text
FROM conversations""",
    "bridge_answers": """
SELECT conv_id AS batch_id,
  concat(CASE conv_id % 4 WHEN 1 THEN 'Here you are: ' ELSE '' END,
    CASE conv_id % 7 WHEN 3 THEN 'no list' ELSE concat('[{"n":', cast(conv_id AS string), '},', CASE WHEN conv_id % 3 = 0 THEN '7' ELSE '{"b":2,"a":"x"}' END, ']') END,
    CASE conv_id % 4 WHEN 1 THEN ' Done.' ELSE '' END) AS raw
FROM (SELECT conv_id FROM conversations GROUP BY conv_id)""",
    # orders -> sidecar documents
    "bridge_sidecars": """
SELECT cast(o_orderkey AS string) AS run_dir,
  CASE o_orderkey % 5 WHEN 0 THEN '[{"image_url":"x"}]'
    WHEN 1 THEN concat('{"extraction_confidence_score":', cast(cast(o_custkey % 3 AS double) / 20 AS string), ',"events":[{"t":1}]}')
    WHEN 2 THEN '{"extraction_confidence_score":0.9,"derived_metrics":{}}'
    ELSE concat('{"extraction_confidence_score":"0.4","derived_metrics":{"m0":', cast(o_custkey % 9 AS string), '},"photo_urls":["side', cast(o_custkey % 4 AS string), '"]}') END AS sidecar_json
FROM orders""",
}


def _used(sql: str) -> list[str]:
    return re.findall(r"\bFROM ([a-z_]+)", sql)


def bridge(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view in Spark."""
    sql = BRIDGES[name]
    source = _used(sql)[0]
    base = bridge(spark, sf_dir, source) if source in BRIDGES else read_table(spark, f"{sf_dir}/{source}.parquet")
    view = f"cairnbook_{source}"
    base.createOrReplaceTempView(view)
    # A backslash is an escape character in Spark literals only.
    return spark.sql(sql.replace("\\", "\\\\").replace(f"FROM {source}", f"FROM {view}"))


def with_bridges(body: str, *names: str, **extra: str) -> str:
    """Oracle SQL: the named views (with what they read), then extra CTEs in the given order, then the body."""
    ctes: dict[str, str] = {}

    def need(name: str) -> None:
        for source in _used(BRIDGES[name]):
            if source in BRIDGES:
                need(source)
        ctes.setdefault(name, BRIDGES[name])

    for name in names:
        need(name)
    ctes.update(extra)
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" + body
