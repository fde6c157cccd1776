from touchline.functions.flatten import competitions, events, lineups, matches, parse_scores, project
from touchline.functions.rates import change, flag, share

__all__ = [
    "change", "competitions", "events", "flag", "lineups", "matches", "parse_scores", "project", "share",
]
