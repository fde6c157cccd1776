from touchline.streaming.live import await_all, run_all, start_all
from touchline.streaming.scores import (
    attach_player, enrich, high_scoring, one_per_key, team_form, tumbling_avg,
)

__all__ = [
    "attach_player", "await_all", "enrich", "high_scoring", "one_per_key", "run_all", "start_all",
    "team_form", "tumbling_avg",
]
