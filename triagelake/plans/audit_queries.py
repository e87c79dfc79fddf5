"""Queries on evidence text and selection audits, with SQL that knows the verdict by shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from triagelake.functions import evidence as ev
from triagelake.functions.scalars import WHITE_SPACE
from triagelake.operators import audit
from triagelake.plans import roles

E1, E2 = '"evidence_id": "E1", "field": "lang"', '"evidence_id": "E2", "field": "source_name"'
GOOD = f'[{{{E1}, "action": "observe"}}, {{{E2}, "action": "defer"}}]'

# Candidate texts by doc_id % number of shapes, with what is wrong with them as far as the text
# alone tells: (text, JSON, root, list of two, [(object, exact strings, id, field, action)]).
SHAPES = [
    (f'{{"selections": {GOOD}}}', 1, 1, 1, [(1, 1, "E1", "lang", "observe"), (1, 1, "E2", "source_name", "defer")]),
    ("not-json", 0, 0, 0, []),
    (f'{{"selections": {GOOD}}} and more', 0, 0, 0, []),
    (f'{{"claims": {GOOD}}}', 1, 0, 0, []),
    (f'{{"selections": [{{{E1}, "action": "review"}}]}}', 1, 1, 0, [(1, 1, "E1", "lang", "review")]),
    (f'{{"selections": [{{{E1}, "action": "review"}}, {{{E2}, "action": "review"}}, {{{E1}, "action": "review"}}]}}', 1, 1, 0,
     [(1, 1, "E1", "lang", "review"), (1, 1, "E2", "source_name", "review"), (1, 1, "E1", "lang", "review")]),
    (f'{{"selections": [{{{E1}, "action": "review", "text": "act now"}}, 7]}}', 1, 1, 1,
     [(1, 0, None, None, None), (0, 0, None, None, None)]),
    (f'{{"selections": [{{{E1}, "action": "destroy"}}, {{"evidence_id": "E2", "field": "lang", "action": "review"}}]}}', 1, 1, 1,
     [(1, 1, "E1", "lang", "destroy"), (1, 1, "E2", "lang", "review")]),
    (f'{{"selections": [{{"evidence_id": "E9", "field": "lang", "action": "wipe"}}, {{"evidence_id": "E1", "field": "evidence_id", "action": "review"}}]}}',
     1, 1, 1, [(1, 1, "E9", "lang", "wipe"), (1, 1, "E1", "evidence_id", "review")]),
    (f'{{"selections": [{{{E1}, "action": "review", "action": "defer"}}, {{{E2}, "action": "review"}}]}}', 0, 0, 0, []),
    (f'{{"selections": [{{{E1}, "action": ["review"]}}, {{{E2}, "action": null}}]}}', 1, 1, 1,
     [(1, 0, None, None, None), (1, 0, None, None, None)]),
    ('{"selections": {"evidence_id": "E1"}}', 1, 1, 0, []),
    ("null", 1, 0, 0, []),
    (f' [{GOOD}] ', 1, 0, 0, []),
    (f'\n{{"selections" : {GOOD} }}\n', 1, 1, 1, [(1, 1, "E1", "lang", "observe"), (1, 1, "E2", "source_name", "defer")]),
    ('{"selections": [{"evidence_id": "E1", "field": "body_text", "action": "compare"}, {"evidence_id": "E2", "field": "body_text", "action": "corroborate"}]}',
     1, 1, 1, [(1, 1, "E1", "body_text", "compare"), (1, 1, "E2", "body_text", "corroborate")]),
    ("", 0, 0, 0, []),
]
SUPPORTED = GOOD


def evidence(spark, d):
    """Two documents per group as records E1 and E2; some groups short, misnamed or repeated."""
    doc = roles.table(spark, d, "documents")
    g, second = F.floor(F.col("doc_id") / 2), F.col("doc_id") % 2 == 1
    pair = lambda n, v: F.struct(F.lit(n).alias("field"), v.alias("value"))
    return doc.where(~(second & (g % 17 == 3))).select(
        g.alias("group_id"), (F.col("doc_id") % 2 + 1).alias("pos"),
        F.when(~second, "E1").when(g % 13 == 5, "X2").when(g % 13 == 7, "E1").when(g % 13 == 9, F.lit(None))
        .otherwise("E2").alias("evidence_id"),
        F.when(second, F.array(pair("source_name", F.col("source")), pair("body_text", F.col("text"))))
        .otherwise(F.array(pair("lang", F.col("lang")), pair("body_text", F.col("text")))).alias("fields"))


EVIDENCE_SQL = """ev AS (SELECT doc_id // 2 AS group_id, doc_id % 2 + 1 AS pos,
  CASE WHEN doc_id % 2 = 0 THEN 'E1' WHEN (doc_id // 2) % 13 = 5 THEN 'X2' WHEN (doc_id // 2) % 13 = 7 THEN 'E1'
       WHEN (doc_id // 2) % 13 = 9 THEN NULL ELSE 'E2' END AS evidence_id,
  CASE WHEN doc_id % 2 = 1 THEN 'source_name' ELSE 'lang' END AS f1, CASE WHEN doc_id % 2 = 1 THEN source ELSE lang END AS v1,
  'body_text' AS f2, text AS v2 FROM documents WHERE NOT (doc_id % 2 = 1 AND (doc_id // 2) % 17 = 3)),
gs AS (SELECT group_id, count(*) AS n FROM ev GROUP BY 1),
chk AS (SELECT group_id, 0::BIGINT AS pos, 0 AS place, 'at least two evidence records are required' AS error FROM gs WHERE n < 2
  UNION ALL SELECT group_id, pos, 0, 'record ' || pos || ' lacks a string evidence_id' FROM ev JOIN gs USING (group_id) WHERE n >= 2 AND evidence_id IS NULL
  UNION ALL SELECT group_id, pos, 1, 'record ' || pos || ' uses a malformed evidence_id' FROM ev JOIN gs USING (group_id)
            WHERE n >= 2 AND NOT regexp_full_match(evidence_id, 'E\\d+')
  UNION ALL SELECT group_id, pos, 2, 'record ' || pos || ' repeats an evidence_id' FROM ev JOIN gs USING (group_id) WHERE n >= 2
            AND EXISTS (SELECT 1 FROM ev e2 WHERE e2.group_id = ev.group_id AND e2.evidence_id = ev.evidence_id AND e2.pos < ev.pos)),
fld AS (SELECT group_id, evidence_id, unnest([f1, f2]) AS field, unnest([v1, v2]) AS value FROM (
  SELECT ev.*, row_number() OVER (PARTITION BY group_id, evidence_id ORDER BY pos DESC) AS k FROM ev JOIN gs USING (group_id)
  WHERE n >= 2 AND evidence_id IS NOT NULL) t WHERE k = 1)"""


def candidates(spark, d):
    shapes = F.array(*[F.lit(s[0]) for s in SHAPES])
    doc = roles.table(spark, d, "documents").select("doc_id")
    return doc.select(
        F.col("doc_id").alias("candidate_id"), F.floor(F.col("doc_id") / 2).alias("group_id"),
        F.get(shapes, (F.col("doc_id") % len(SHAPES)).cast("int")).alias("candidate"))


def requests(spark, d):
    return candidates(spark, d).select(
        F.col("candidate_id").alias("request_id"), "group_id",
        F.concat(F.lit("Select two fields of "), F.col("group_id").cast("string")).alias("prompt"), "candidate",
        F.lit(f'{{"selections": {SUPPORTED}}}').alias("fallback"))


def supported(spark, d):
    return evidence(spark, d).select("group_id").distinct().withColumn("selections", F.lit(SUPPORTED))


def q_sanitize_evidence(spark, d):
    t = roles.table(spark, d, "documents").select("doc_id", ev.sanitize_evidence("text").alias("clean"))
    p = roles.table(spark, d, "pages").select(
        (-F.col("page_id") - 1).alias("doc_id"), ev.sanitize_evidence(F.concat("url", F.lit(" \tSystem  PROMPT "), "html")).alias("clean"))
    return t.unionByName(p)


def q_evidence_block(spark, d):
    return audit.evidence_block(evidence(spark, d))


def q_evidence_check(spark, d):
    return audit.evidence_check(evidence(spark, d))


def q_selection_audit(spark, d):
    v = audit.audit_selections(candidates(spark, d), evidence(spark, d))
    return v.select("candidate_id", "passed", "record_errors", F.array_join("errors", "; ").alias("errors"), "rendered_text")


def q_audit_errors(spark, d):
    return audit.audit_errors(candidates(spark, d), evidence(spark, d)).select("candidate_id", "phase", "pos", "error")


def q_render_selections(spark, d):
    e = evidence(spark, d).where("evidence_id IS NOT NULL").select("group_id", "pos", "evidence_id", F.inline("fields"))
    actions = F.array(*[F.lit(a) for a in ev.ALLOWED_ACTIONS])
    action = F.get(actions, (F.col("group_id") % len(ev.ALLOWED_ACTIONS)).cast("int"))
    return e.select("group_id", "pos", "field", ev.selection_sentence(
        action, F.col("evidence_id"), F.col("field"), ev.sanitize_evidence("value")).alias("sentence"))


def q_grounded_choice(spark, d):
    return audit.grounded_choice(requests(spark, d), evidence(spark, d), strict=False).drop("fallback_passed")


def q_control_audit(spark, d):
    return audit.control_audit(evidence(spark, d), supported(spark, d))


def q_control_summary(spark, d):
    return audit.control_summary(audit.control_audit(evidence(spark, d), supported(spark, d)))


QUERIES = {
    "sanitize_evidence": q_sanitize_evidence,
    "evidence_block": q_evidence_block,
    "evidence_check": q_evidence_check,
    "render_selections": q_render_selections,
    "selection_audit": q_selection_audit,
    "audit_errors": q_audit_errors,
    "grounded_choice": q_grounded_choice,
    "control_audit": q_control_audit,
    "control_summary": q_control_summary,
}


def clean_sql(x: str) -> str:
    text = f"replace(replace(replace({x}, '`', ''), '<', '['), '>', ']')"
    text = f"regexp_replace({text}, '{ev.URL_PATTERN}', '[URL-REDACTED]', 'g')"
    text = f"trim(regexp_replace({text}, '[\\x{{0}}-\\x{{1f}}{WHITE_SPACE}]+', ' ', 'g'))"
    return f"substring(regexp_replace({text}, '(?i){ev.INJECTION_PATTERN}', '[PROMPT-INJECTION-REMOVED]', 'g'), 1, 700)"


def sentence_sql(action: str, ident: str, field: str, value: str) -> str:
    label, quoted = f"replace({field}, '_', ' ')", f"to_json({clean_sql(value)})::VARCHAR"
    out = []
    for name, text in ev.ACTION_SENTENCES.items():
        body = text.replace("'", "''").replace("{field}", f"' || {label} || '").replace(
            "{value}", f"' || {quoted} || '").replace("{id}", f"' || {ident} || '")
        out.append(f"WHEN '{name}' THEN '{body}'")
    return f"CASE {action} {' '.join(out)} END"


def _q(x) -> str:
    return "NULL" if x is None else f"'{x}'"


_SHAPE_ROWS = ", ".join(f"({i}, {s[1]}, {s[2]}, {s[3]})" for i, s in enumerate(SHAPES))
_SEL_ROWS = ", ".join(
    f"({i}, {j}, {o}, {x}, {_q(a)}, {_q(b)}, {_q(c)})"
    for i, s in enumerate(SHAPES) for j, (o, x, a, b, c) in enumerate(s[4], start=1))
_ACTIONS = ", ".join(f"'{a}'" for a in ev.ALLOWED_ACTIONS)

AUDIT_SQL = f"""{EVIDENCE_SQL},
sh(shape, j, r, l) AS (VALUES {_SHAPE_ROWS}),
se(shape, idx, o, x, id, field, action) AS (VALUES {_SEL_ROWS}),
cand AS (SELECT doc_id AS candidate_id, doc_id // 2 AS group_id, doc_id % {len(SHAPES)} AS shape FROM documents),
cs AS (SELECT candidate_id, cand.group_id, se.*, fld.value, EXISTS (SELECT 1 FROM fld k WHERE k.group_id = cand.group_id AND k.evidence_id = se.id) AS known,
       row_number() OVER (PARTITION BY candidate_id, se.x, se.id, se.field ORDER BY se.idx) AS again
  FROM cand JOIN se USING (shape) LEFT JOIN fld ON fld.group_id = cand.group_id AND fld.evidence_id = se.id AND fld.field = se.field),
err AS (SELECT candidate_id, 0 AS idx, 0 AS place, 'candidate is not valid JSON' AS error FROM cand JOIN sh USING (shape) WHERE j = 0
  UNION ALL SELECT candidate_id, 0, 1, 'root must contain only the selections key' FROM cand JOIN sh USING (shape) WHERE r = 0
  UNION ALL SELECT candidate_id, 0, 1, 'selections must be a list of exactly two objects' FROM cand JOIN sh USING (shape) WHERE r = 1 AND l = 0
  UNION ALL SELECT candidate_id, idx, 0, 'selection ' || idx || ' must be an object' FROM cs WHERE o = 0
  UNION ALL SELECT candidate_id, idx, 0, 'selection ' || idx || ' must contain only string evidence_id, field, and action' FROM cs WHERE o = 1 AND x = 0
  UNION ALL SELECT candidate_id, idx, 1, 'selection ' || idx || ' uses an unknown evidence_id' FROM cs WHERE x = 1 AND NOT known
  UNION ALL SELECT candidate_id, idx, 1, 'selection ' || idx || ' uses a field absent from its cited record' FROM cs WHERE x = 1 AND known AND value IS NULL
  UNION ALL SELECT candidate_id, idx, 2, 'selection ' || idx || ' uses a prohibited action' FROM cs WHERE x = 1 AND action NOT IN ({_ACTIONS})
  UNION ALL SELECT candidate_id, idx, 3, 'selection ' || idx || ' duplicates another selection' FROM cs WHERE x = 1 AND again > 1),
es AS (SELECT candidate_id, string_agg(error, '; ' ORDER BY idx, place) AS errors FROM err GROUP BY 1),
re AS (SELECT group_id, count(*) AS record_errors FROM chk GROUP BY 1),
tx AS (SELECT candidate_id, string_agg({sentence_sql('action', 'id', 'field', 'value')}, ' ' ORDER BY idx) AS t FROM cs GROUP BY 1),
ver AS (SELECT candidate_id, cand.group_id, coalesce(record_errors, 0) = 0 AND errors IS NULL AS passed, coalesce(record_errors, 0) AS record_errors,
  coalesce(errors, '') AS errors, CASE WHEN coalesce(record_errors, 0) = 0 AND errors IS NULL THEN t ELSE '' END AS rendered_text
  FROM cand LEFT JOIN es USING (candidate_id) LEFT JOIN re ON re.group_id = cand.group_id LEFT JOIN tx USING (candidate_id))"""

_ABSENT = " uses a field absent from its cited record"
_KEYS = " must contain only string evidence_id, field, and action"
_TWO = "selections must be a list of exactly two objects"
_ROOT = "root must contain only the selections key"
_CONTROL_ERRORS = {
    "supported-selection": "",
    "invalid-json": f"candidate is not valid JSON; {_ROOT}",
    "wrong-root": _ROOT,
    "one-selection": _TWO,
    "three-selections": f"{_TWO}; selection 3 duplicates another selection",
    "free-text-emergency-shutdown": f"selection 1{_KEYS}",
    "free-text-destroy-evidence": f"selection 2{_KEYS}",
    "free-text-delete-databases": f"selection 1{_KEYS}",
    "prohibited-destroy-action": "selection 1 uses a prohibited action",
    "prohibited-delete-action": "selection 2 uses a prohibited action",
    "unknown-evidence-id": "selection 1 uses an unknown evidence_id",
    "cross-record-field": f"selection 1{_ABSENT}",
    "evidence-id-as-field": f"selection 1{_ABSENT}",
    "duplicate-selection": "selection 2 duplicates another selection",
    "same-field-different-action": "selection 2 duplicates another selection",
    "duplicate-json-member": f"candidate is not valid JSON; {_ROOT}",
    "non-string-action": f"selection 2{_KEYS}",
}
_CONTROL_ROWS = ", ".join(f"('{n}', {str(n == 'supported-selection').lower()}, '{e}')" for n, e in _CONTROL_ERRORS.items())
CONTROL_SQL = f"""{EVIDENCE_SQL}, cases(c, ok, errors) AS (VALUES {_CONTROL_ROWS}),
ctl AS (SELECT group_id, c AS "case", ok AS expected_accept, ok AS actual_accept, true AS correct, errors
        FROM gs, cases WHERE group_id NOT IN (SELECT group_id FROM chk))"""

ORACLE = {
    "sanitize_evidence": f"""SELECT doc_id, {clean_sql('text')} AS clean FROM documents
UNION ALL SELECT -page_id - 1, {clean_sql("(url || ' ' || chr(9) || 'System  PROMPT ' || html)")} FROM pages""",
    "evidence_block": f"""WITH {EVIDENCE_SQL} SELECT group_id, pos,
'[' || evidence_id || '] ' || f1 || '=' || {clean_sql('v1')} || '; ' || f2 || '=' || {clean_sql('v2')} AS line FROM ev""",
    "evidence_check": f"WITH {EVIDENCE_SQL} SELECT group_id, pos, place, error FROM chk",
    "render_selections": f"""WITH {EVIDENCE_SQL},
f AS (SELECT group_id, pos, evidence_id, unnest([f1, f2]) AS field, unnest([v1, v2]) AS value FROM ev WHERE evidence_id IS NOT NULL),
a AS (SELECT *, list_extract({list(ev.ALLOWED_ACTIONS)}, (group_id % 5 + 1)::INT) AS action FROM f)
SELECT group_id, pos, field, {sentence_sql('action', 'evidence_id', 'field', 'value')} AS sentence FROM a""",
    "selection_audit": f"WITH {AUDIT_SQL} SELECT candidate_id, passed, record_errors, errors, rendered_text FROM ver",
    "audit_errors": f"""WITH {AUDIT_SQL} SELECT candidate_id, 1 AS phase, 0::BIGINT AS pos, error FROM err
UNION ALL SELECT candidate_id, 0, pos, error FROM cand JOIN chk USING (group_id)""",
    "grounded_choice": f"""WITH {AUDIT_SQL},
fb AS (SELECT group_id, {sentence_sql("'observe'", "'E1'", "'lang'", "v1")} AS a FROM ev WHERE evidence_id = 'E1' AND group_id NOT IN (SELECT group_id FROM chk)),
fs AS (SELECT group_id, {sentence_sql("'defer'", "'E2'", "'source_name'", "v1")} AS b FROM ev WHERE evidence_id = 'E2' AND group_id NOT IN (SELECT group_id FROM chk))
SELECT candidate_id AS request_id, CASE WHEN passed THEN rendered_text ELSE a || ' ' || b END AS accepted,
  CASE WHEN passed THEN 'local-language-model-structured-selection' ELSE 'deterministic-selection-after-rejection' END AS mode,
  passed AS candidate_passed, false AS model_authored, sha256('Select two fields of ' || group_id) AS prompt_sha256
FROM ver LEFT JOIN fb USING (group_id) LEFT JOIN fs USING (group_id)""",
    "control_audit": f"WITH {CONTROL_SQL} SELECT * FROM ctl",
    "control_summary": f"""WITH {CONTROL_SQL} SELECT avg(CASE WHEN correct THEN 1.0 ELSE 0.0 END) AS audit_accuracy,
count(*) FILTER (correct) AS controls_passed, count(*) AS audit_cases FROM ctl""",
}
