"""Game scoring: battle points per fight, mean per player/weapon session,
and running player/team counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flumen.functions import numeric
from flumen.operators import windows

# Battle-time tiers (inclusive), rank-gap steps, place bonus.
BATTLE_TIME_TIERS = [(10, 20, 4), (21, 30, 3), (31, 40, 2), (41, None, 1)]
RANK_GAP_STEPS = [(6, 3), (3, 2)]
RANK_GAP_DEFAULT = 1
OTHER_PLACE_BONUS = 3
SESSION_GAP_S = 30


def battle_points(battle_time: Column, my_rank: Column, opp_rank: Column,
                  my_place: Column, opp_place: Column) -> Column:
    """time tier (4/3/2/1, 0 below 10) + rank gap (3 if >= 6, 2 if >= 3, else 1)
    + 3 when the two fighters were in different places."""
    return (numeric.tiers(battle_time, BATTLE_TIME_TIERS)
            + numeric.steps(my_rank - opp_rank, RANK_GAP_STEPS, RANK_GAP_DEFAULT)
            + F.when(my_place != opp_place, OTHER_PLACE_BONUS).otherwise(0))


def mean_points_per_session(df: DataFrame, keys, ts: str, points: str, gap_s: int = SESSION_GAP_S) -> DataFrame:
    """Average points per key and session window (mean = sum / count, the
    combine function's accumulator)."""
    return windows.sessions(df, ts, gap_s, keys, {"battles": ("count", None), "mean_points": ("mean", points)})
