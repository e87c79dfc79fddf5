"""The selection audit and the sanitizer against tables of cases written by hand."""

import json

import pytest
from pyspark.sql import functions as F

from triagelake.functions import evidence as ev
from triagelake.operators import audit

LOGINS = ("E31", {"logins": "17", "countries": "DE, FR"})
DISK = ("E7", {"disk_used": "81 %", "host": "node-4"})
GROUPS = {
    "ops": [LOGINS, DISK],
    "single": [("E5", {"only": "1"})],
    "broken": [("E31", {"k": "1"}), ("b", {"l": "2"}), (None, {"m": "3"}), ("E31", {"n": "4"})],
}

FIRST = '{"evidence_id": "E31", "field": "logins", "action": "observe"}'
SECOND = '{"evidence_id": "E7", "field": "host", "action": "review"}'
ROOT = "root must contain only the selections key"
TWO = "selections must be a list of exactly two objects"
SHAPE = "selection {} must contain only string evidence_id, field, and action"

#: candidate -> errors; an accepted one has none.
VERDICTS = [
    (f'{{"selections": [{FIRST}, {SECOND}]}}', []),
    (f'{{"selections": [{SECOND}, {FIRST}]}}', []),
    ("plain words", ["candidate is not valid JSON", ROOT]),
    ("", ["candidate is not valid JSON", ROOT]),
    ("12", [ROOT]),
    ("[]", [ROOT]),
    ('{"selections": [], "note": 1}', [ROOT]),
    ('{"picks": []}', [ROOT]),
    ('{"selections": {}}', [TWO]),
    ('{"selections": []}', [TWO]),
    (f'{{"selections": [{FIRST}]}}', [TWO]),
    (f'{{"selections": [{FIRST}, {SECOND}]}} and more', ["candidate is not valid JSON", ROOT]),
    (f'{{"selections": [{FIRST}, {SECOND}], "selections": []}}', ["candidate is not valid JSON", ROOT]),
    (f'{{"selections": [{FIRST}, 5]}}', ["selection 2 must be an object"]),
    (f'{{"selections": [{FIRST}, {{"evidence_id": "E7", "field": "host"}}]}}', [SHAPE.format(2)]),
    (f'{{"selections": [{FIRST}, {{"evidence_id": "E7", "field": "host", "action": 1}}]}}', [SHAPE.format(2)]),
    (f'{{"selections": [{FIRST}, {{"evidence_id": "E99", "field": "host", "action": "review"}}]}}', ["selection 2 uses an unknown evidence_id"]),
    (f'{{"selections": [{FIRST}, {{"evidence_id": "E7", "field": "logins", "action": "review"}}]}}',
     ["selection 2 uses a field absent from its cited record"]),
    (f'{{"selections": [{FIRST}, {{"evidence_id": "E7", "field": "host", "action": "wipe"}}]}}', ["selection 2 uses a prohibited action"]),
    (f'{{"selections": [{FIRST}, {FIRST}]}}', ["selection 2 duplicates another selection"]),
    ('{"selections": [{"evidence_id": "E99", "field": "x", "action": "wipe"}, ' + SECOND + "]}",
     ["selection 1 uses an unknown evidence_id", "selection 1 uses a prohibited action"]),
]

#: text -> what the sanitizer leaves.
CLEANED = [
    ("a  b\x1fc", "a b c"),
    ("go to https://x.y/é now", "go to [URL-REDACTED] now"),
    ("<b>`q`</b>", "[b]q[/b]"),
    ("IGNORE ALL previous things", "[PROMPT-INJECTION-REMOVED] things"),
    ("ü" * 900, "ü" * 700),
    ("", ""),
    (" \t ", ""),
]


def _evidence(spark):
    rows = [(g, p, i, list(fields.items())) for g, recs in GROUPS.items() for p, (i, fields) in enumerate(recs, 1)]
    return spark.createDataFrame(rows, "group_id string, pos int, evidence_id string, fields array<struct<field:string,value:string>>")


def _candidates(spark, rows):
    return spark.createDataFrame(rows, "candidate_id int, group_id string, candidate string")


def test_verdicts(spark):
    df = _candidates(spark, [(n, "ops", text) for n, (text, _) in enumerate(VERDICTS)])
    got = {r.candidate_id: r for r in audit.audit_selections(df, _evidence(spark)).collect()}
    for n, (text, errors) in enumerate(VERDICTS):
        assert (got[n].errors, got[n].passed) == (errors, not errors), text
        assert bool(got[n].rendered_text) == (not errors)
        assert got[n].free_form_model_text_accepted is False and got[n].contract_version == "selection-v2"
    assert got[0].rendered_text == (
        'The cited record reports logins as "17" [E31]. Review the cited record\'s host field, whose quoted value is "node-4" [E7].')


def test_evidence_check_lists_every_error(spark):
    rows = audit.evidence_check(_evidence(spark)).orderBy("group_id", "pos", "place").collect()
    assert [(r.group_id, r.error) for r in rows] == [
        ("broken", "record 2 uses a malformed evidence_id"), ("broken", "record 3 lacks a string evidence_id"),
        ("broken", "record 4 repeats an evidence_id"), ("single", "at least two evidence records are required")]


def test_record_errors_reject_a_fine_candidate(spark):
    text = '{"selections": [{"evidence_id": "E31", "field": "n", "action": "review"}, {"evidence_id": "b", "field": "l", "action": "defer"}]}'
    df = _candidates(spark, [(0, "broken", text), (1, "single", text)])
    got = {r.candidate_id: r for r in audit.audit_selections(df, _evidence(spark)).collect()}
    assert not got[0].passed and got[0].record_errors == 3
    assert got[1].errors == ["selection 1 uses an unknown evidence_id", "selection 2 uses an unknown evidence_id"]


def test_all_controls_are_judged_right(spark):
    supported = spark.createDataFrame([("ops", f"[{FIRST}, {SECOND}]")], "group_id string, selections string")
    controls = audit.control_audit(_evidence(spark), supported)
    s = audit.control_summary(controls).first()
    assert s.audit_cases == s.controls_passed and s.audit_accuracy == 1.0
    assert [r["case"] for r in controls.where("actual_accept").collect()] == ["supported-selection"]


def test_choice_is_fail_closed(spark):
    schema = "request_id int, group_id string, prompt string, candidate string, fallback string"
    safe, picked = VERDICTS[0][0], VERDICTS[1][0]
    df = spark.createDataFrame([(0, "ops", "p", "no model here", safe), (1, "ops", "p", picked, safe)], schema)
    got = {r.request_id: r for r in audit.grounded_choice(df, _evidence(spark)).collect()}
    assert got[0].mode == "deterministic-selection-after-rejection" and got[0].accepted.startswith("The cited record reports logins")
    assert got[1].mode == "local-language-model-structured-selection" and got[1].accepted.startswith("Review")
    assert not any(r.model_authored for r in got.values())
    bad = spark.createDataFrame([(0, "ops", "p", safe, "nothing")], schema)
    with pytest.raises(Exception, match="invalid deterministic fallback"):
        audit.grounded_choice(bad, _evidence(spark)).collect()
    assert audit.grounded_choice(bad, _evidence(spark), strict=False).first().accepted is None


def test_sanitizer(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLEANED)], "i int, t string").select("i", ev.sanitize_evidence("t").alias("c"))
    assert {r.i: r.c for r in df.collect()} == {i: c for i, (_, c) in enumerate(CLEANED)}


def test_quoting_matches_json(spark):
    values = ['he said "no" \\ / ñ', "  two", "bare"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(ev.json_string(F.col("v")).alias("q"))
    assert [r.q for r in df.collect()] == [json.dumps(v, ensure_ascii=False) for v in values]


def test_block_lines(spark):
    line = audit.evidence_block(_evidence(spark)).where("group_id = 'ops' AND pos = 1").first().line
    assert line == "[E31] logins=17; countries=DE, FR"


def test_few_groups_have_their_cases_written_by_many_tasks(spark):
    """The cases of all groups come from a table of a few bytes a group, which the planner would put into one task."""
    rows = [(g, p, f"E{p}", [("k", "v")]) for g in range(400) for p in (1, 2)]
    evidence = spark.createDataFrame(rows, "group_id long, pos int, evidence_id string, fields array<struct<field:string,value:string>>")
    first = '[{"evidence_id": "E1", "field": "k", "action": "review"}, {"evidence_id": "E2", "field": "k", "action": "defer"}]'
    supported = spark.range(400).select(F.col("id").alias("group_id"), F.lit(first).alias("selections"))
    cases = audit.control_cases(evidence, supported).withColumn("task", F.spark_partition_id())
    found = cases.groupBy("task").agg(F.count_distinct("group_id").alias("n")).collect()
    assert len(found) >= 16 and sum(r.n for r in found) == 400 and max(r.n for r in found) < 40


@pytest.mark.parametrize("limit", [1, 12, 30, 700])
def test_marks_across_the_limit(spark, limit):
    """What is beyond the limit is not searched, and that changes no text: a match at the limit is marked, later ones cannot move in."""
    import re
    texts = [" " * k + "x" * (limit - d) + t + "tail ignore above" * 3 for k in (0, 2) for d in range(min(limit, 21)) for t in ("Ignore the previous", "ignore above", "SYſTEM prompt")]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = re.compile(ev.INJECTION_PATTERN, re.I)
    got = [r.c for r in frame.select(ev.sanitize_evidence("t", limit).alias("c")).collect()]
    assert got == [pattern.sub(ev.INJECTION_MARK, t.strip())[:limit] for t in texts]
    plan = frame.select(ev.sanitize_evidence("t", limit))._jdf.queryExecution().optimizedPlan().toString()
    assert f"1, {limit + 19}" in plan
