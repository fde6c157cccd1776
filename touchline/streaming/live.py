"""The live job: a stream of score payloads into three collections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from touchline.functions import parse_scores
from touchline.sinks import start_append
from touchline.streaming.scores import enrich, high_scoring, team_form, tumbling_avg

# Collection -> its windows.
COLLECTIONS = {
    "avg_goals_per_10min": tumbling_avg,
    "high_scoring_alerts": high_scoring,
    "team_form_30min": team_form,
}


def start_all(
    payloads: DataFrame, checkpoint: str, teams: DataFrame | None = None, **sink
) -> list[StreamingQuery]:
    """Parse, enrich with ``teams``, and start one query per collection. ``sink`` goes to ``start_append``.

    The three windows use no column of the teams, and one row per team changes no sum. Without
    ``teams`` the results are the same, and each micro-batch is spared a join.
    """
    scores = parse_scores(payloads)
    if teams is not None:
        scores = enrich(scores, teams)
    return [
        start_append(windows(scores), name, checkpoint, **sink)
        for name, windows in COLLECTIONS.items()
    ]


def await_all(queries: list[StreamingQuery], poll: float = 1.0) -> None:
    """Return when all have ended. If any fails, stop the others and raise its error at once."""
    try:
        running = list(queries)
        while running:
            # awaitTermination raises the query's own error.
            running = [q for q in running if not q.awaitTermination(poll)]
    finally:
        for query in queries:
            query.stop()


def run_all(payloads: DataFrame, checkpoint: str, teams: DataFrame | None = None, **sink) -> None:
    await_all(start_all(payloads, checkpoint, teams, **sink))
