"""A small raw zone, written by hand."""

from __future__ import annotations

import itertools

_ids = itertools.count(1)


def named(name, key=None):
    return None if name is None else {"id": key if key is not None else abs(hash(name)) % 1000, "name": name}


def event(kind, team="Reds", player="Ann", **fields):
    """A raw event; ``key`` sets its id."""
    return {
        "id": fields.pop("key", None) or f"e{next(_ids)}",
        "type": named(kind, 1),
        "team": named(team, 10),
        "player": named(player, 20),
        **fields,
    }


def shot(outcome="Goal", xg=0.1, **fields):
    return event("Shot", shot={"statsbomb_xg": xg, "outcome": {"name": outcome}}, **fields)


def passed(outcome=None, **fields):
    detail = {k: fields.pop(k) for k in ("assisted_shot_id", "goal_assist", "cross") if k in fields}
    if outcome is not None:
        detail["outcome"] = {"name": outcome}
    return event("Pass", **{"pass": detail}, **fields)


def dribble(outcome="Complete", **fields):
    return event("Dribble", dribble={"outcome": {"name": outcome}}, **fields)


def match(match_id, date="2020-01-01", season=1, competition=1):
    return {
        "match_id": match_id,
        "match_date": date,
        "kick_off": "20:45:00.000",
        "home_score": 2,
        "away_score": 1,
        "match_week": 3,
        "competition_stage": named("Final", 26),
        "competition": {"id": competition},
        "season": {"id": season},
        "home_team": named("Reds", 10),
        "away_team": named("Blues", 11),
        "stadium": named("The Park", 5),
        "referee": named("R. Fair", 6),
        "metadata": {"data_version": "1.1.0"},
    }


def competition(name="Cup", season=1, key=1):
    return {
        "competition_id": key,
        "season_id": season,
        "competition_name": name,
        "competition_gender": "female",
        "country_name": "Nowhere",
        "season_name": f"20{season:02d}",
    }
