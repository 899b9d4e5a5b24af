"""Normalisation, scoring, answers."""

import json

from pyspark.sql import functions as F

from cairnbook.operators import normalize as N, responses as R

RAW = {
    "source_url": " https://example.com/x ", "article_date_published": "2025-10-01Z", "num_people_involved": "3",
    "num_fatalities": "1", "num_rescued": 0.0,
    "people": [{"name": " Jane Doe ", "age": "34", "outcome": " Minor "}, "ignore", {"name": "  ", "age": "x"}],
    "photo_urls": "https://img.example/x.jpg", "extraction_confidence_score": "2.0",
    "confidences": {"a": 1.5, "b": "0.25", "c": "bad", "d": -1}, "location": {"lat": 1}, "derived_metrics": {},
    "anchors": [{"kind": "bolt", "note": " "}, {"note": ""}, 4], "recovery_date": "someday", "custom": " kept ", "other": 5,
    "accident_causes": {
        "proximate_causes": ["Rockfall", "unknown", "ICEFALL"],
        "contributing_factors": ["Route_Finding_Error", "improper_knots", "zzz"],
        "anchor_system": {"anchor_type": "BOLT", "num_points": "2", "redundancy_present": True, "anchor_condition": "Weathered", "failure_mode": "Pulled"},
        "rope_system": {"num_people_on_rope": "2", "roped_for_descent": False, "rope_type": "SINGLE", "belay_method": "RAPPEL",
                        "failure_description": " Cut rope", "knots_used": ["overhand", " figure 8 "]},
        "decision_factors": {"objective_hazard_awareness": "HIGH", "time_pressure": True, "group_dynamics": "Leader_Follower"},
        "environmental_conditions": {"visibility_class": "Poor", "snowpack_instability_signs": ["whumphing", " shooting cracks "]},
        "human_factors": {"group_size": "3", "communication_method": ["radio", " Radio "]},
        "rescue_and_outcome": {"rescue_delay_minutes_est": "45", "body_recovery_difficulty": "Technical"},
        "investigation_notes": {"uncertainties_list": ["what failed?", " anchor age "]},
        "cause_classification": {"primary_cause_category": "Environmental", "secondary_cause_categories": ["HUMAN_FACTOR", "medical"]},
        "equipment_status": {"critical_gear_present": [" "]},
    },
}


def test_normalize(spark):
    df = spark.createDataFrame([(1, json.dumps(RAW)), (2, "{}"), (3, "no json")], "id int, raw string")
    r, empty, bad = sorted(N.normalize_artifacts(df).collect(), key=lambda x: x.id)
    assert r.source_url == "https://example.com/x" and r.article_date_published == "2025-10-01"
    assert (r.num_people_involved, r.num_fatalities, r.num_rescued) == (3, 1, 0)
    assert [tuple(p) for p in r.people] == [("Jane Doe", 34, "Minor", None)]
    assert r.photo_urls == ["https://img.example/x.jpg"] and r.extraction_confidence_score is None
    assert r.confidences == {"a": 1.0, "b": 0.25, "d": 0.0}
    assert r.route_confidence_score is None
    assert r.location == '{"lat":1}' and r.derived_metrics is None
    assert r.anchors == ['{"kind":"bolt"}'] and r.extras == {"custom": "kept"}
    c = r.accident_causes
    assert c.proximate_causes == ["rockfall", "icefall"] and c.contributing_factors == ["route_finding_error", "improper_knots"]
    assert (c.anchor_system.num_points, c.anchor_system.redundancy_present) == (2, True)
    assert c.rope_system.rope_type == "single" and c.rope_system.knots_used == ["overhand", "figure 8"]
    assert c.rope_system.failure_description == "Cut rope" and c.decision_factors.objective_hazard_awareness == "high"
    assert c.environmental_conditions.visibility_class == "poor" and c.human_factors.group_size == 3
    assert c.human_factors.communication_method == ["radio"]
    assert c.investigation_notes.uncertainties_list == ["what failed?", "anchor age"]
    assert c.cause_classification.secondary_cause_categories == ["human_factor", "medical"] and c.equipment_status is None
    assert empty.accident_causes is None and empty.people is None and bad.source_url is None


def test_confidence(spark):
    schema = ("h struct<pre_dates:array<string>,gazetteer_matches:array<string>,fall_height_feet_pre:int,num_fatalities_pre:int,people_pre:array<struct<age:int>>>, "
              "r struct<accident_date:string,article_date_published:string,mountain_name:string,fall_height_meters_estimate:double,num_fatalities:int,people:array<struct<age:int>>>")
    rows = [((["2025-10-01", "2024-01-01"], ["Mount Test"], 100, 1, [(28,), (40,)]), ("2025-10-01", None, "Mount Test North", 30.48, 1, [(28,), (33,)])),
            ((None, None, None, None, None), (None, None, None, None, None, None))]
    df = spark.createDataFrame(rows, schema)
    assert [x.s for x in df.select(N.confidence(F.col("h"), F.col("r")).alias("s")).collect()] == [1.0, 0.0]


def test_answers(spark):
    answers = spark.createDataFrame([(1, '[{"a":1}]'), (2, 'Sure: [{"a":1},{"a":2}] bye'), (3, "nothing"), (4, "[] x ["), (5, '[5,{"b":1},{"c":1}]')], "batch_id int, raw string")
    got = sorted((r.batch_id, r.pos, r.item_json) for r in R.parse_responses(answers).collect())
    assert got == [(1, 0, '{"a":1}'), (2, 0, '{"a":1}'), (2, 1, '{"a":2}'), (5, 0, "{}"), (5, 1, '{"b":1}'), (5, 2, '{"c":1}')]
    assert sorted(r.batch_id for r in R.unreadable(answers).collect()) == [3]
    items = spark.createDataFrame([(b, p, f"u{b}{p}", "By Jo Fox. fell", "") for b in (1, 3) for p in range(3)], "batch_id int, pos int, url string, focused_text string, full_text string")
    aligned = R.align(items, R.parse_responses(answers))
    assert aligned.count() == 6
    minimal = R.minimal_artifacts(aligned)
    assert minimal.count() == 5 and {r.report_author for r in minimal.collect()} == {"Jo Fox"}
    answered = aligned.where("item_json IS NOT NULL").select("url")
    assert answered.unionByName(minimal.select(F.col("source_url").alias("url"))).distinct().count() == 6


def test_admission(spark):
    items = spark.createDataFrame([(1,), (2,), (3,)], "batch_id int")
    assert [r.admitted for r in R.admit_batches(items, 2).orderBy("batch_id").collect()] == [True, True, False]
    assert all(r.admitted for r in R.admit_batches(items, 0).collect())


def test_single_object_answer(spark):
    df = spark.createDataFrame([('{"a":1}',), ('x {"a":2} y',), ("[1]",)], "raw string")
    assert [r.j for r in df.select(F.to_json(R.answer_object(F.col("raw"))).alias("j")).collect()] == ['{"a":1}', '{"a":2}', None]


def test_people_are_read_once_and_unknown_keys_stay(spark):
    from cairnbook.plans import records
    raw = '{"people":[{"name":" A "},7,{"name":" "}],"region":null,"odd":"x","num_fatalities":"2","num_fatalities":3}'
    row = normalize_rows(spark, [raw, "[1]", '{"people":[]}'])
    assert [p.name for p in row[0].people] == ["A"] and row[0].region is None and row[0].extras == {"odd": "x"}
    assert row[1].people is None and row[2].people is None
    plan = records.clean_people(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(" in plan and "Filter" not in plan.split("Generate", 1)[1]


def normalize_rows(spark, raws):
    from cairnbook.operators import normalize
    from cairnbook.sources.readers import last_key_wins
    with last_key_wins(spark):
        return normalize.normalize_artifacts(spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")).orderBy("i").collect()
