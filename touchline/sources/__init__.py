from touchline.sources.raw import (
    LAYOUT, read_competitions, read_events, read_lineups, read_matches, read_teams,
)
from touchline.sources.stream import read_stream, replay
from touchline.sources.views import register_views

__all__ = [
    "LAYOUT", "read_competitions", "read_events", "read_lineups", "read_matches", "read_stream",
    "read_teams", "register_views", "replay",
]
