"""Fail-closed audit of machine-made selections against an evidence table.

``evidence`` has (group_id, pos, evidence_id, fields): pos is the record's 1-based place in its
group, fields an ordered array of (field, value). ``candidates`` has (candidate_id, group_id,
candidate) with the JSON text to audit. Nothing of a group is gathered: records are looked up
one by one, and errors of records stay one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.functions.evidence import (
    ALLOWED_ACTIONS,
    CONTRACT_VERSION,
    evidence_line,
    json_string,
    sanitize_evidence,
    selection_sentence,
)

# Accepted-text modes.
MODE_ACCEPTED = "local-language-model-structured-selection"
MODE_REJECTED = "deterministic-selection-after-rejection"

# Control cases as (name, accepted, selections). A selection is (which base
# selection, changed or added members). The four cases with None are written out below.
CONTROLS = (
    ("supported-selection", True, None),
    ("invalid-json", False, None),
    ("wrong-root", False, None),
    ("one-selection", False, ((1, {}),)),
    ("three-selections", False, ((1, {}), (2, {}), (1, {}))),
    ("free-text-emergency-shutdown", False, ((1, {"text": "The tcp flow demands emergency shutdown."}), (2, {}))),
    ("free-text-destroy-evidence", False, ((1, {}), (2, {"text": "Destroy all retained forensic evidence."}))),
    ("free-text-delete-databases", False, ((1, {"rationale": "Delete every production database."}), (2, {}))),
    ("prohibited-destroy-action", False, ((1, {"action": "destroy"}), (2, {}))),
    ("prohibited-delete-action", False, ((1, {}), (2, {"action": "delete"}))),
    ("unknown-evidence-id", False, ((1, {"evidence_id": "E999"}), (2, {}))),
    ("cross-record-field", False, ((1, {"field": "field_not_in_record"}), (2, {}))),
    ("evidence-id-as-field", False, ((1, {"field": "evidence_id"}), (2, {}))),
    ("duplicate-selection", False, ((1, {}), (1, {}))),
    ("same-field-different-action", False, ((1, {}), (1, {"action": "corroborate"}))),
    ("duplicate-json-member", False, None),
    ("non-string-action", False, ((1, {}), (2, {"action": ["review"]}))),
)


def evidence_block(evidence: DataFrame) -> DataFrame:
    """The prompt block of every group, one line per record."""
    return evidence.select("group_id", "pos", evidence_line("evidence_id", "fields").alias("line"))


def evidence_check(evidence: DataFrame) -> DataFrame:
    """Errors of the evidence sets, one row per error: (group_id, pos, place, error).

    A group needs two records; each record a string id of the form E<digits>, used once.
    """
    sizes = evidence.groupBy("group_id").agg(F.count(F.lit(1)).alias("_n"))
    short = sizes.where("_n < 2").select(
        "group_id", F.lit(0).cast("long").alias("pos"), F.lit(0).alias("place"),
        F.lit("at least two evidence records are required").alias("error"))
    firsts = evidence.where("evidence_id IS NOT NULL").groupBy("group_id", "evidence_id").agg(
        F.min("pos").alias("_first"))
    full = evidence.select("group_id", F.col("pos").cast("long").alias("pos"), "evidence_id").join(
        sizes.where("_n >= 2"), "group_id", "left_semi")
    marked = full.join(firsts, ["group_id", "evidence_id"], "left")
    say = lambda text: F.concat(F.lit("record "), F.col("pos").cast("string"), F.lit(text))
    wrong = F.array(
        F.when(F.col("evidence_id").isNull(), say(" lacks a string evidence_id")),
        F.when(~F.col("evidence_id").rlike(r"\AE\p{Nd}+\z"), say(" uses a malformed evidence_id")),
        F.when(F.col("pos") > F.col("_first"), say(" repeats an evidence_id")),
    )
    listed = marked.select("group_id", "pos", F.posexplode(wrong).alias("place", "error")).where("error IS NOT NULL")
    return short.unionByName(listed)


def _record_map(evidence: DataFrame) -> DataFrame:
    """Last record of each id, in groups of at least two records (C-J5).

    Values are sanitized first, so only their short form is shuffled, never whole texts.
    """
    short = F.transform("fields", lambda f: F.struct(
        f["field"].alias("field"), sanitize_evidence(f["value"]).alias("value")))
    big = evidence.groupBy("group_id").agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2")
    return (
        evidence.where("evidence_id IS NOT NULL").select("group_id", "pos", "evidence_id", short.alias("fields"))
        .join(big, "group_id", "left_semi")
        .groupBy("group_id", "evidence_id").agg(F.max_by("fields", "pos").alias("fields"))
    )


def _is_json(text: Column) -> Column:
    """One JSON value and nothing else, no repeated member: it must fit both as item and member."""
    item = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.coalesce((F.size(item.cast("array<variant>")) == 1) & member.isNotNull(), F.lit(False))


def audit_selections(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """Verdict per candidate: (candidate_id, group_id, passed, record_errors, errors, rendered_text) (G1).

    ``errors`` lists what is wrong with the candidate, in order; ``record_errors`` counts errors
    of its evidence set, which :func:`evidence_check` lists. Either one rejects the candidate.
    """
    text = F.col("candidate")
    parsed = candidates.select("candidate_id", "group_id", text, _is_json(text).alias("_json"))
    root_ok = F.col("_json") & F.coalesce(F.json_object_keys(text) == F.array(F.lit("selections")), F.lit(False))
    parsed = parsed.withColumn("_root", root_ok).withColumn(
        "_list", F.when(F.col("_root"), F.try_variant_get(F.try_parse_json(text), "$.selections", "array<variant>")))
    head = parsed.select(
        "candidate_id", "group_id",
        F.array_compact(F.array(
            F.when(~F.col("_json"), "candidate is not valid JSON"),
            F.when(~F.col("_root"), "root must contain only the selections key")
            .when(F.col("_list").isNull() | (F.size("_list") != 2), "selections must be a list of exactly two objects"),
        )).alias("_head"),
        "_list",
    )
    picked = head.select("candidate_id", "group_id", "_head", F.posexplode_outer("_list").alias("_i", "_sel"))
    member = lambda k: F.try_variant_get("_sel", f"$.{k}", "variant")
    keys = F.array_sort(F.json_object_keys(F.to_json("_sel")))
    triple = ("action", "evidence_id", "field")
    is_object = F.coalesce(F.schema_of_variant("_sel").startswith("OBJECT<"), F.lit(False))
    strings = [F.coalesce(F.schema_of_variant(member(k)) == "STRING", F.lit(False)) for k in triple]
    exact = F.coalesce(keys == F.array(*[F.lit(k) for k in triple]), F.lit(False)) & strings[0] & strings[1] & strings[2]
    shaped = picked.select(
        "candidate_id", "group_id", "_head", "_i", is_object.alias("_object"), (is_object & exact).alias("_ok"),
        *[F.when(is_object & exact, F.try_variant_get("_sel", f"$.{k}", "string")).alias(k) for k in triple],
    )
    known = _record_map(evidence).withColumn("_known", F.lit(True))
    looked = shaped.join(known, ["group_id", "evidence_id"], "left")
    hit = F.get(F.filter("fields", lambda f: f["field"] == F.col("field")), F.lit(0))
    looked = looked.select(
        "candidate_id", "group_id", "_head", "_i", "_object", "_ok", *triple, "_known",
        F.when(F.col("field") != "evidence_id", hit).alias("_hit"),
    ).repartition("candidate_id")
    again = F.row_number().over(
        Window.partitionBy("candidate_id", "_ok", "evidence_id", "field").orderBy("_i")) > 1
    looked = looked.withColumn("_again", F.col("_ok") & again)
    say = lambda t: F.concat(F.lit("selection "), (F.col("_i") + 1).cast("string"), F.lit(t))
    own = F.array_compact(F.array(
        F.when(~F.col("_object"), say(" must be an object"))
        .when(~F.col("_ok"), say(" must contain only string evidence_id, field, and action")),
        F.when(F.col("_ok") & F.col("_known").isNull(), say(" uses an unknown evidence_id"))
        .when(F.col("_ok") & F.col("_hit").isNull(), say(" uses a field absent from its cited record")),
        F.when(F.col("_ok") & ~F.col("action").isin(*ALLOWED_ACTIONS), say(" uses a prohibited action")),
        F.when(F.col("_again"), say(" duplicates another selection")),
    ))
    sentence = selection_sentence(F.col("action"), F.col("evidence_id"), F.col("field"), F.col("_hit.value"))
    item = F.struct(
        "_i", own.alias("errors"), F.col("_ok").alias("ok"),
        F.struct("evidence_id", "field", "action").alias("selection"), sentence.alias("sentence"))
    # The list is as long as the candidate's own text says.
    regrouped = looked.groupBy("candidate_id").agg(
        F.first("group_id").alias("group_id"), F.first("_head").alias("_head"),
        F.array_sort(F.collect_list(F.when(F.col("_i").isNotNull(), item))).alias("_items"))
    bad = evidence_check(evidence).groupBy("group_id").agg(F.count(F.lit(1)).alias("record_errors"))
    errors = F.concat("_head", F.flatten(F.transform("_items", lambda x: x["errors"])))
    valid = F.filter("_items", lambda x: x["ok"])
    judged = regrouped.join(bad, "group_id", "left").select(
        "candidate_id", "group_id", F.coalesce("record_errors", F.lit(0)).alias("record_errors"),
        errors.alias("errors"), F.transform(valid, lambda x: x["selection"]).alias("selections"), "_items")
    passed = (F.col("record_errors") == 0) & (F.size("errors") == 0) & (F.size("selections") == 2)
    return judged.select(
        "candidate_id", "group_id", passed.alias("passed"), F.lit(CONTRACT_VERSION).alias("contract_version"),
        "record_errors", "errors", "selections",
        F.when(passed, F.array_join(F.transform("_items", lambda x: x["sentence"]), " ")).otherwise("").alias("rendered_text"),
        F.lit(False).alias("free_form_model_text_accepted"),
    )


def audit_errors(candidates: DataFrame, evidence: DataFrame) -> DataFrame:
    """All errors in order, one row each: (candidate_id, phase, pos, place, error) (G1)."""
    verdicts = audit_selections(candidates, evidence)
    own = verdicts.select("candidate_id", F.lit(1).alias("phase"), F.lit(0).cast("long").alias("pos"),
                          F.posexplode("errors").alias("place", "error"))
    records = candidates.select("candidate_id", "group_id").join(evidence_check(evidence), "group_id").select(
        "candidate_id", F.lit(0).alias("phase"), "pos", "place", "error")
    return records.unionByName(own)


def grounded_choice(requests: DataFrame, evidence: DataFrame, *, strict: bool = True) -> DataFrame:
    """Accepted text per request: the candidate's if it passes, else the fallback's.

    ``requests`` has (request_id, group_id, prompt, candidate, fallback). Both texts go through
    one audit. A fallback that does not pass fails the job, or leaves NULL text when not strict.
    """
    both = requests.select("request_id", "group_id", F.inline(F.array(
        F.struct(F.lit("c").alias("_kind"), F.col("candidate").alias("candidate")),
        F.struct(F.lit("f").alias("_kind"), F.col("fallback").alias("candidate")))))
    keyed = both.withColumn("candidate_id", F.struct("request_id", "_kind"))
    verdicts = audit_selections(keyed.select("candidate_id", "group_id", "candidate"), evidence)
    pick = lambda kind, c: F.max(F.when(F.col("candidate_id._kind") == kind, F.col(c)))
    paired = verdicts.groupBy(F.col("candidate_id.request_id").alias("request_id")).agg(
        pick("c", "passed").alias("candidate_passed"), pick("f", "passed").alias("fallback_passed"),
        pick("c", "rendered_text").alias("_c"), pick("f", "rendered_text").alias("_f"))
    fallback = F.col("_f")
    invalid = F.raise_error(F.lit("invalid deterministic fallback")) if strict else F.lit(None).cast("string")
    accepted = F.when(~F.col("fallback_passed"), invalid).when(F.col("candidate_passed"), F.col("_c")).otherwise(fallback)
    prompts = requests.select("request_id", F.sha2(F.encode("prompt", "UTF-8"), 256).alias("prompt_sha256"))
    return paired.join(prompts, "request_id").select(
        "request_id", accepted.alias("accepted"),
        F.when(F.col("candidate_passed"), MODE_ACCEPTED).otherwise(MODE_REJECTED).alias("mode"),
        "candidate_passed", "fallback_passed", F.lit(False).alias("model_authored"), "prompt_sha256",
    )


def _object(members: dict) -> Column:
    """JSON object text from columns, strings or lists of strings."""
    parts = []
    for key, value in members.items():
        if isinstance(value, list):
            shown = F.to_json(F.array(*[F.lit(v) for v in value]))
        else:
            shown = json_string(F.lit(value) if isinstance(value, str) else value)
        parts += [F.lit(f'"{key}": '), shown, F.lit(", ")]
    return F.concat(F.lit("{"), *parts[:-1], F.lit("}"))


def _selections(items: list[Column], root: str = "selections") -> Column:
    return F.concat(F.lit('{"' + root + '": ['), F.concat_ws(", ", *items), F.lit("]}"))


def control_cases(evidence: DataFrame, supported: DataFrame) -> DataFrame:
    """The adversarial cases of every group: (group_id, case, candidate, expected_accept).

    ``supported`` has (group_id, selections): the JSON list the group's evidence supports. Only
    the first two records of a group take part; groups with record errors have no cases.
    """
    first = F.get("fields", F.lit(0))["field"]
    at = lambda p, c: F.max(F.when(F.col("pos") == p, c))
    pairs = evidence.where("pos IN (1, 2)").groupBy("group_id").agg(
        at(1, F.col("evidence_id")).alias("_id1"), at(1, first).alias("_f1"),
        at(2, F.col("evidence_id")).alias("_id2"), at(2, first).alias("_f2"))
    wrong = evidence_check(evidence).select("group_id").distinct()
    # A group is a few bytes here, so its rows would be put into few tasks; writing and auditing its cases is the work.
    tasks = max(32, 2 * evidence.sparkSession.sparkContext.defaultParallelism)
    clean = pairs.join(wrong, "group_id", "left_anti").join(supported, "group_id").repartition(tasks)
    base = {
        1: {"evidence_id": F.col("_id1"), "field": F.col("_f1"), "action": "review"},
        2: {"evidence_id": F.col("_id2"), "field": F.col("_f2"), "action": "corroborate"},
    }
    listed = F.col("selections")
    twice = F.concat(F.regexp_replace(_object(base[1]), r"\}$", ""), F.lit(', "action": "defer"}'))
    written = {
        "supported-selection": F.concat(F.lit('{"selections": '), listed, F.lit("}")),
        "invalid-json": F.lit("not-json"),
        "wrong-root": F.concat(F.lit('{"claims": '), listed, F.lit("}")),
        "duplicate-json-member": _selections([twice, _object(base[2])]),
    }
    cases = []
    for name, accepted, parts in CONTROLS:
        shown = written[name] if parts is None else _selections([_object({**base[b], **edit}) for b, edit in parts])
        cases.append(F.struct(F.lit(name).alias("case"), shown.alias("candidate"), F.lit(accepted).alias("expected_accept")))
    return clean.select("group_id", F.inline(F.array(*cases)))


def control_audit(evidence: DataFrame, supported: DataFrame) -> DataFrame:
    """Run every control through the audit: (group_id, case, expected, actual, correct, errors)."""
    cases = control_cases(evidence, supported).withColumn("candidate_id", F.struct("group_id", "case", "expected_accept"))
    verdicts = audit_selections(cases.select("candidate_id", "group_id", "candidate"), evidence)
    return verdicts.select(
        "group_id", F.col("candidate_id.case").alias("case"),
        F.col("candidate_id.expected_accept").alias("expected_accept"), F.col("passed").alias("actual_accept"),
        (F.col("candidate_id.expected_accept") == F.col("passed")).alias("correct"),
        F.array_join("errors", "; ").alias("errors"))


def control_summary(controls: DataFrame, *keys: str) -> DataFrame:
    """Audit accuracy, passed and number of cases."""
    return controls.groupBy(*keys).agg(
        F.avg(F.col("correct").cast("double")).alias("audit_accuracy"),
        F.count_if("correct").alias("controls_passed"), F.count(F.lit(1)).alias("audit_cases"))
