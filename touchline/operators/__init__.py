from touchline.operators.aggregate import (
    completion_rate, count_by, diff_from_mean, mean_by, sum_through, top_n,
)
from touchline.operators.joins import linked_pairs, with_competition, with_match
from touchline.operators.window import growth, lagged, ranked, running

__all__ = [
    "completion_rate", "count_by", "diff_from_mean", "growth", "lagged", "linked_pairs", "mean_by",
    "ranked", "running", "sum_through", "top_n", "with_competition", "with_match",
]
