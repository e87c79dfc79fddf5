"""Session operators: features, sequences, transitions, state funnel, transition surprise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triagelake.core import number_rows
from triagelake.functions.scalars import command_token, event_state, outcome_flag

# Rows per task when neighbours are compared; a session may span many blocks.
BLOCK_ROWS = 1 << 16


def session_features(log: DataFrame) -> DataFrame:
    """One row per session with 12 measures and the pivot outcome.

    ``log`` has session_id, pos, eventid, message, timestamp, protocol; a row with NULL ``pos``
    stands for a session without events. Everything is a map-side combinable aggregate.
    """
    real = F.col("pos").isNotNull()
    event = F.when(real, F.coalesce("eventid", F.lit("")))
    # A bare time of day would be cast to today's date.
    dated = F.when(F.col("timestamp").rlike(r"^\s*\d{4,}-"), F.col("timestamp"))
    stamp = F.unix_micros(dated.try_cast("timestamp"))
    protocol = F.when(real, F.coalesce(F.nullif("protocol", F.lit("")), F.lit("unknown")))
    count_of = lambda needle: F.count_if(event.contains(needle))
    seconds = (F.max(stamp) - F.min(stamp)) / F.lit(1e6)
    out = log.groupBy("session_id").agg(
        F.count("pos").alias("event_count"),
        F.coalesce(F.greatest(seconds, F.lit(0.0)), F.lit(0.0)).alias("duration_seconds"),
        F.count_distinct(event).alias("unique_event_types"),
        count_of("login.failed").alias("login_failed"),
        count_of("login.success").alias("login_success"),
        count_of("command.success").alias("command_success"),
        count_of("command.failed").alias("command_failed"),
        count_of("file_download").alias("file_downloads"),
        F.count_distinct(F.when(event.contains("command."), command_token("message")))
        .alias("unique_command_tokens"),
        F.avg((protocol == "telnet").cast("double")).alias("telnet_fraction"),
        F.coalesce(F.max(event.contains("fingerprint").cast("int")), F.lit(0))
        .alias("has_client_fingerprint"),
        count_of("direct-tcpip.request").alias("direct_tcpip_requests"),
    )
    return out.withColumn("pivot_escalation_outcome", outcome_flag("direct_tcpip_requests"))


def log_states(log: DataFrame) -> DataFrame:
    """State and command token of every logged event, one row per event."""
    command = F.coalesce("eventid", F.lit("")).contains("command.")
    return log.where("pos IS NOT NULL").select(
        "session_id", "pos",
        event_state("eventid").alias("state"),
        F.when(command, command_token("message")).alias("command_token"),
    )


def session_sequences(events: DataFrame, session: str, order: Sequence[str], state: str) -> DataFrame:
    """Long form (session, pos, state) of the state sequences.

    ``order`` columns must be total within a session. The rows are numbered by range
    partitioning, so one huge session is spread over many tasks.
    """
    numbered, _ = number_rows(
        events.select(session, *order, F.col(state).alias("state")),
        [F.col(session).asc(), *[F.col(c).asc() for c in order]],
    )
    first = numbered.groupBy(session).agg(F.min("row_no").alias("_first"))
    return numbered.join(first, session).select(
        session, (F.col("row_no") - F.col("_first")).alias("pos"), "state", "row_no"
    )


def transitions(events: DataFrame, session: str, order: Sequence[str], state: str) -> DataFrame:
    """Each event with the next state of its session, NULL after the last one.

    Neighbours are found in blocks of consecutive row numbers instead of per session; the first
    row of a block is also sent to the block before it, as the neighbour of its last row.
    """
    numbered, _ = number_rows(
        events.select(session, *order, F.col(state).alias("from_state")),
        [F.col(session).asc(), *[F.col(c).asc() for c in order]],
    )
    block = F.floor(F.col("row_no") / BLOCK_ROWS)
    starts = (F.col("row_no") % BLOCK_ROWS == 0) & (F.col("row_no") > 0)
    spread = numbered.select(
        session, "from_state", "row_no",
        F.explode(F.when(starts, F.array(block, block - 1)).otherwise(F.array(block))).alias("_block"),
    )
    w = Window.partitionBy("_block").orderBy("row_no")
    return (
        spread.withColumn("_next_session", F.lead(session).over(w))
        .withColumn("_next_state", F.lead("from_state").over(w))
        .where(F.col("_block") == block)
        .select(
            session, "row_no", "from_state",
            F.when(F.col("_next_session") == F.col(session), F.col("_next_state")).alias("to_state"),
        )
    )


def state_funnel(events: DataFrame, state: str) -> DataFrame:
    """Number of events per state."""
    return events.groupBy(F.col(state).alias("state")).agg(F.count(F.lit(1)).alias("n"))


def transition_model(moves: DataFrame, states: Sequence[str], laplace: float = 1.0) -> DataFrame:
    """Smoothed first-order model (from_state, to_state, p) over the whole state grid.

    Only states x states rows, a bound set by the caller's alphabet.
    """
    spark = moves.sparkSession
    listed = F.array(*[F.lit(s) for s in states])
    grid = spark.range(1).select(F.explode(listed).alias("from_state")).select(
        "from_state", F.explode(listed).alias("to_state")
    )
    counts = moves.where("to_state IS NOT NULL").groupBy("from_state", "to_state").agg(
        F.sum("n").alias("n") if "n" in moves.columns else F.count(F.lit(1)).alias("n")
    )
    smoothed = grid.join(counts, ["from_state", "to_state"], "left").withColumn(
        "w", F.coalesce("n", F.lit(0)) + F.lit(float(laplace))
    )
    row = Window.partitionBy("from_state")
    return smoothed.select("from_state", "to_state", (F.col("w") / F.sum("w").over(row)).alias("p"))


def markov_surprise(
    events: DataFrame,
    session: str,
    order: Sequence[str],
    state: str,
    *,
    states: Sequence[str],
    laplace: float = 1.0,
) -> DataFrame:
    """Mean -ln P of a session's transitions; 0.0 for fewer than two events.

    A state outside ``states`` fails the job. Transitions are first counted per (session, from,
    to), so both the model and the scores work on that much smaller table.
    """
    known = F.col("from_state").isin(*states)
    moves = (
        transitions(events, session, order, state)
        .withColumn("from_state", F.when(known, F.col("from_state")).otherwise(
            F.raise_error(F.concat(F.lit("unknown state: "), F.coalesce("from_state", F.lit("NULL"))))
        ))
        .groupBy(session, "from_state", "to_state")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    model = transition_model(moves, states, laplace)
    # The model has len(states)^2 rows, fixed by the argument, so the hint is safe.
    scored = moves.join(F.broadcast(model), ["from_state", "to_state"], "left")
    total = F.sum(F.when(F.col("p").isNotNull(), -F.log("p") * F.col("n")))
    n = F.sum(F.when(F.col("p").isNotNull(), F.col("n")))
    return scored.groupBy(session).agg(
        F.coalesce(total / n, F.lit(0.0)).alias("surprise"),
        F.sum("n").alias("event_count"),
    )
