import math

import pytest
from pyspark.sql import functions as F

from triagelake.functions import scalars
from triagelake.operators import sessions
from triagelake.sources import documents

SEQUENCES = {
    "night": ["connect", "command", "command", "close", "connect"],
    "noon": ["auth-fail", "auth-success", "download"],
    "solo": ["close"],
    "loop": ["connect", "auth-fail"] * 4,
}


def _events(spark, sequences=SEQUENCES):
    rows = [(s, i, x) for s, states in sequences.items() for i, x in enumerate(states)]
    return spark.createDataFrame(rows, "session_id string, pos int, state string").repartition(5)


def _surprise(df):
    out = sessions.markov_surprise(df, "session_id", ["pos"], "state", states=scalars.EVENT_STATES)
    return {r.session_id: r.surprise for r in out.collect()}


def _brute(sequences, states, laplace=1.0):
    counts = {a: {b: laplace for b in states} for a in states}
    for seq in sequences.values():
        for a, b in zip(seq, seq[1:]):
            counts[a][b] += 1
    out = {}
    for s, seq in sequences.items():
        terms = [-math.log(counts[a][b] / sum(counts[a].values())) for a, b in zip(seq, seq[1:])]
        out[s] = sum(terms) / len(terms) if terms else 0.0
    return out


def test_markov_surprise_matches_brute_force_and_is_repeatable(spark):
    got = _surprise(_events(spark))
    assert got["solo"] == 0.0
    assert got == pytest.approx(_brute(SEQUENCES, scalars.EVENT_STATES))
    assert got == pytest.approx(_surprise(_events(spark).coalesce(1)))


def test_unknown_state_fails(spark):
    with pytest.raises(Exception, match="unknown state"):
        _surprise(_events(spark, {"a": ["connect", "nowhere"]}))


def test_transitions_cross_block_borders(spark, monkeypatch):
    monkeypatch.setattr(sessions, "BLOCK_ROWS", 3)
    long = {"hot": [scalars.EVENT_STATES[i * i % 8] for i in range(40)], "z": ["connect", "close"]}
    moves = sessions.transitions(_events(spark, long), "session_id", ["pos"], "state")
    got = [(r.session_id, r.from_state, r.to_state) for r in moves.orderBy("row_no").collect()]
    want = [(s, a, b) for s, seq in long.items() for a, b in zip(seq, [*seq[1:], None])]
    assert got == want


def test_session_sequences_keep_log_order(spark):
    out = sessions.session_sequences(_events(spark), "session_id", ["pos"], "state")
    got = {}
    for r in out.orderBy("session_id", "pos").collect():
        got.setdefault(r.session_id, []).append(r.state)
    assert got == SEQUENCES


def test_session_features_edge_cases(spark):
    log = """[
      {"s1": [{"eventid": "cowrie.session.connect", "timestamp": "2019-05-13T00:00:01Z", "protocol": "telnet"},
              {"eventid": "cowrie.command.success", "message": "CMD: /bin/ls -l", "timestamp": "not a time"},
              {"eventid": "cowrie.command.failed", "message": "; rm", "timestamp": "2019-05-13T00:00:03.5Z", "protocol": ""},
              {"eventid": "cowrie.direct-tcpip.request"}, {"eventid": "cowrie.client.fingerprint"}]},
      {"s2": []}]"""
    parsed = documents.parse_session_log(spark.createDataFrame([("d", log)], "doc_id string, value string"))
    rows = {r.session_id: r for r in sessions.session_features(parsed).collect()}
    a, b = rows["s1"], rows["s2"]
    assert (a.event_count, a.duration_seconds, a.unique_event_types, a.unique_command_tokens) == (5, 2.5, 5, 2)
    assert (a.telnet_fraction, a.has_client_fingerprint, a.pivot_escalation_outcome) == (0.2, 1, 1)
    assert (b.event_count, b.duration_seconds, b.telnet_fraction, b.pivot_escalation_outcome) == (0, 0.0, None, 0)


@pytest.mark.parametrize("message, token", [
    ("CMD: wget http://x", "wget"), ("CMD: ; ls", "unknown"), ("no colon here", "no"), (" lead", "unknown"),
    ("a:b:c d", "bc"), (None, "unknown"), ("CMD: " + "x" * 50, "x" * 32), ("CMD: ün-ame|y", "n-ame"),
])
def test_command_token(spark, message, token):
    df = spark.createDataFrame([(message,)], "m string").select(scalars.command_token("m").alias("t"))
    assert df.first().t == token


def test_families_and_labels(spark):
    names = [(" Normal ", "normal", 0), ("SMURF", "dos", 1), ("ps", "u2r", 1), ("what", "other-attack", 1)]
    df = spark.createDataFrame([(n,) for n, _, _ in names], "n string").select(
        scalars.attack_family("n").alias("f"), scalars.binary_label("n").alias("y"))
    assert [(r.f, r.y) for r in df.collect()] == [(f, y) for _, f, y in names]
    with pytest.raises(Exception, match="missing"):
        spark.createDataFrame([(None,)], "n string").select(scalars.attack_family("n")).collect()


def test_external_id_and_package_key(spark):
    df = spark.sql("""select array(named_struct('source_name', 'x', 'external_id', '1'),
        named_struct('source_name', 'mitre-attack', 'external_id', 'T0800')) as r, 'own' as id""")
    assert df.select(scalars.external_id("r", "id").alias("e")).first().e == "T0800"
    assert df.select(scalars.external_id(F.lit(None).cast(df.schema["r"].dataType), "id").alias("e")).first().e == "own"
    p = spark.createDataFrame([("pkg:npm/@a/b@1@2", "2"), ("pkg:npm/b", ""), ("npm/b", "1"), (None, "1")], "p string, v string")
    assert [r.k for r in p.select(scalars.package_key("p", "v").alias("k")).collect()] == ["pkg:npm/@a/b@1", None, None, None]
