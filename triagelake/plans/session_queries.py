"""Queries on sessions, logs and flows, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from triagelake.functions import scalars
from triagelake.operators import decide, sessions
from triagelake.plans import roles

WS = scalars.WHITE_SPACE
ORDER = ["ts", "event_id"]
QUEUES = {"surprise": "surprise", "volume": "event_count"}

STATE_CASE = "CASE " + " ".join(
    f"WHEN contains(eventid, '{needle}') THEN '{state}'" for needle, state in scalars.EVENT_STATE_RULES
) + " ELSE 'other' END"

TOKEN_SQL = (
    "coalesce(nullif(substring(regexp_replace(regexp_extract(regexp_replace(coalesce(message, ''), "
    f"'^[^:]*:[{WS}]*', ''), '^[^{WS};&|><]*', 0), '[^A-Za-z0-9_.-]', '', 'g'), 1, 32), ''), 'unknown')"
)

NAMES = [
    " Normal", *[n.upper() if i % 5 == 0 else n
                 for i, n in enumerate(sum(scalars.ATTACK_FAMILIES.values(), []))], "unlisted",
]

FAMILY_CASE = "CASE " + " ".join(
    f"WHEN nm IN ({', '.join(repr(x) for x in names)}) THEN '{family}'"
    for family, names in scalars.ATTACK_FAMILIES.items()
) + " ELSE 'other-attack' END"

MOVES_SQL = f"""{roles.SESSIONS_SQL},
seq AS (SELECT session_id, state, hit, row_number() OVER w - 1 AS pos, lead(state) OVER w AS nxt
        FROM sess WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id))"""

SURPRISE_SQL = f"""{MOVES_SQL},
states AS (SELECT unnest({list(roles.EVENT_TYPES)}) AS s),
grid AS (SELECT a.s AS f, b.s AS t FROM states a, states b),
cnt AS (SELECT state AS f, nxt AS t, count(*) AS n FROM seq WHERE nxt IS NOT NULL GROUP BY 1, 2),
model AS (SELECT f, t, (coalesce(n, 0) + 1.0::DOUBLE) / sum(coalesce(n, 0) + 1.0::DOUBLE) OVER (PARTITION BY f) AS p
          FROM grid LEFT JOIN cnt USING (f, t)),
surp AS (SELECT session_id, round(coalesce(avg(-ln(p)), 0.0), 6) AS surprise, count(*) AS event_count, max(hit) AS outcome
         FROM seq LEFT JOIN model ON seq.state = f AND seq.nxt = t GROUP BY session_id)"""


def recall_sql(frame: str, id_col: str, proxy: str, queues: dict[str, str], budgets) -> str:
    """CTEs ``ranked`` and ``recalls`` for the budget queries."""
    arms = " UNION ALL ".join(
        f"SELECT '{q}' AS queue, {i} AS queue_no, {id_col} AS id, {c}::DOUBLE AS score, {proxy} AS y FROM {frame}"
        for i, (q, c) in enumerate(queues.items())
    )
    values = ", ".join(f"({b}::DOUBLE)" for b in budgets)
    return f"""arms AS ({arms}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY score DESC NULLS LAST, id) AS rnk,
                  count(*) OVER (PARTITION BY queue) AS n FROM arms),
recalls AS (SELECT queue, queue_no, budget,
       sum(CASE WHEN rnk <= greatest(1, ceil(n::DOUBLE * budget)) THEN y ELSE 0 END)::DOUBLE
         / greatest(sum(y), 1) AS recall
     FROM ranked, (VALUES {values}) b(budget) GROUP BY queue, queue_no, budget)"""


def scored_sessions(spark, d):
    """Surprise, event count and purchase outcome per session."""
    e = roles.session_events(spark, d)
    surprise = sessions.markov_surprise(e, "session_id", ORDER, "state", states=roles.EVENT_TYPES)
    outcome = e.groupBy("session_id").agg(F.max("hit").alias("outcome"))
    return surprise.join(outcome, "session_id").select(
        "session_id", F.round("surprise", 6).alias("surprise"), "event_count", "outcome"
    )


def q_session_sequences(spark, d):
    e = roles.session_events(spark, d)
    return sessions.session_sequences(e, "session_id", ORDER, "state").select("session_id", "pos", "state")


def q_transitions(spark, d):
    e = roles.session_events(spark, d)
    moves = sessions.transitions(e, "session_id", ORDER, "state").where("to_state IS NOT NULL")
    return moves.groupBy("session_id", "from_state", "to_state").agg(F.count(F.lit(1)).alias("n"))


def q_session_features(spark, d):
    f = sessions.session_features(roles.honeypot_log(spark, d))
    return f.withColumn("telnet_fraction", F.round("telnet_fraction", 6)).withColumn(
        "duration_seconds", F.round("duration_seconds", 6))


def q_event_state(spark, d):
    log = sessions.log_states(roles.honeypot_log(spark, d))
    return log.select("session_id", "pos", "state")


def q_command_token(spark, d):
    log = sessions.log_states(roles.honeypot_log(spark, d))
    return log.where("command_token IS NOT NULL").select("session_id", "pos", "command_token")


def q_state_funnel(spark, d):
    return sessions.state_funnel(sessions.log_states(roles.honeypot_log(spark, d)), "state")


def q_family_map(spark, d):
    names = F.array(*[F.lit(n) for n in NAMES])
    e = roles.table(spark, d, "events").select(
        "event_id", F.get(names, (F.col("event_id") % len(NAMES)).cast("int")).alias("raw"))
    return e.select(
        "event_id", scalars.attack_family("raw").alias("attack_family"), scalars.binary_label("raw").alias("label"))


def q_recall_at_budget(spark, d):
    r = decide.recall_at_budget(scored_sessions(spark, d), "session_id", "outcome", QUEUES, decide.UTILITY_BUDGETS)
    return r.select("queue", "budget", F.round("recall", 6).alias("recall"))


def q_budget_curve(spark, d):
    r = decide.budget_curve(scored_sessions(spark, d), "session_id", "outcome", QUEUES)
    return r.select("queue", "budget", F.round("recall", 6).alias("recall"))


def q_decide_by_argmax(spark, d):
    r = decide.decide_by_argmax(scored_sessions(spark, d), "session_id", proxy="outcome", queues=QUEUES)
    return r.select("queue", F.round("utility", 6).alias("utility"), "place", "is_winner", "why")


def q_top_budget(spark, d):
    return decide.top_budget(scored_sessions(spark, d), "session_id", "event_count", 0.05).select("session_id", "rank")


def q_proxy_independence(spark, d):
    return decide.proxy_independence(scored_sessions(spark, d), "outcome", "event_count").withColumn(
        "correlation", F.round("correlation", 4))


QUERIES = {
    "session_features": q_session_features,
    "session_sequences": q_session_sequences,
    "transitions": q_transitions,
    "event_state": q_event_state,
    "command_token": q_command_token,
    "state_funnel": q_state_funnel,
    "family_map": q_family_map,
    "markov_surprise": scored_sessions,
    "top_budget": q_top_budget,
    "recall_at_budget": q_recall_at_budget,
    "budget_curve": q_budget_curve,
    "decide_by_argmax": q_decide_by_argmax,
    "proxy_independence": q_proxy_independence,
}

_UTILITY = recall_sql("surp", "session_id", "outcome", QUEUES, decide.UTILITY_BUDGETS)
_CURVE = recall_sql("surp", "session_id", "outcome", QUEUES, decide.CURVE_BUDGETS)

ORACLE = {
    "session_features": f"""WITH {roles.LOG_SQL}
SELECT session_id, count(*) AS event_count,
       round(coalesce(date_diff('microseconds', min(stamp), max(stamp)) / 1e6, 0.0), 6) AS duration_seconds,
       count(DISTINCT eventid) AS unique_event_types,
       count(*) FILTER (contains(eventid, 'login.failed')) AS login_failed,
       count(*) FILTER (contains(eventid, 'login.success')) AS login_success,
       count(*) FILTER (contains(eventid, 'command.success')) AS command_success,
       count(*) FILTER (contains(eventid, 'command.failed')) AS command_failed,
       count(*) FILTER (contains(eventid, 'file_download')) AS file_downloads,
       count(DISTINCT CASE WHEN contains(eventid, 'command.') THEN {TOKEN_SQL} END) AS unique_command_tokens,
       round(avg(CASE WHEN coalesce(protocol, 'unknown') = 'telnet' THEN 1.0 ELSE 0.0 END), 6) AS telnet_fraction,
       max(CASE WHEN contains(eventid, 'fingerprint') THEN 1 ELSE 0 END) AS has_client_fingerprint,
       count(*) FILTER (contains(eventid, 'direct-tcpip.request')) AS direct_tcpip_requests,
       CASE WHEN count(*) FILTER (contains(eventid, 'direct-tcpip.request')) > 0 THEN 1 ELSE 0 END AS pivot_escalation_outcome
FROM log GROUP BY session_id""",
    "session_sequences": f"WITH {MOVES_SQL} SELECT session_id, pos, state FROM seq",
    "transitions": f"""WITH {MOVES_SQL} SELECT session_id, state AS from_state, nxt AS to_state, count(*) AS n
FROM seq WHERE nxt IS NOT NULL GROUP BY 1, 2, 3""",
    "event_state": f"WITH {roles.LOG_SQL} SELECT session_id, pos, {STATE_CASE} AS state FROM log",
    "command_token": f"""WITH {roles.LOG_SQL} SELECT session_id, pos, {TOKEN_SQL} AS command_token
FROM log WHERE contains(eventid, 'command.')""",
    "state_funnel": f"""WITH {roles.LOG_SQL} SELECT {STATE_CASE} AS state, count(*) AS n FROM log GROUP BY 1""",
    "family_map": f"""WITH named AS (SELECT event_id, lower(trim(list_extract({NAMES}, (event_id % {len(NAMES)} + 1)::INT))) AS nm FROM events)
SELECT event_id, {FAMILY_CASE} AS attack_family, CASE WHEN nm = 'normal' THEN 0 ELSE 1 END AS label FROM named""",
    "markov_surprise": f"WITH {SURPRISE_SQL} SELECT session_id, surprise, event_count, outcome FROM surp",
    "top_budget": f"""WITH {SURPRISE_SQL}, r AS (SELECT session_id,
  row_number() OVER (ORDER BY event_count DESC, session_id) AS rank, count(*) OVER () AS n FROM surp)
SELECT session_id, rank FROM r WHERE rank <= greatest(1, ceil(n::DOUBLE * 0.05::DOUBLE))""",
    "recall_at_budget": f"WITH {SURPRISE_SQL}, {_UTILITY} SELECT queue, budget, round(recall, 6) AS recall FROM recalls",
    "budget_curve": f"WITH {SURPRISE_SQL}, {_CURVE} SELECT queue, budget, round(recall, 6) AS recall FROM recalls",
    "decide_by_argmax": f"""WITH {SURPRISE_SQL}, {_UTILITY},
u AS (SELECT queue, queue_no, avg(recall) AS utility FROM recalls GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (ORDER BY utility DESC, queue_no) AS place FROM u),
s AS (SELECT max(CASE WHEN place = 1 THEN queue END) AS lead, max(CASE WHEN place = 1 THEN utility END) AS u1,
             max(CASE WHEN place = 2 THEN utility END) AS u2 FROM p)
SELECT queue, round(utility, 6) AS utility, place::INT AS place, place = 1 AS is_winner,
       printf('Winner: ''%s'' queue — mean recall %.3f vs %.3f (+%.3f) over budgets (0.02, 0.05, 0.1, 0.2), measured against the held-out ''outcome'' outcome the scoring rule did not author.', lead, u1, u2, u1 - u2) AS why
FROM p, s""",
    "proxy_independence": f"""WITH {SURPRISE_SQL},
lv AS (SELECT event_count, avg(outcome) AS m FROM surp GROUP BY 1)
SELECT (SELECT bool_or(m > 0 AND m < 1) FROM lv) AS non_monotone, round(corr(event_count, outcome), 4) AS correlation FROM surp""",
}
