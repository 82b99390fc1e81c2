"""Declared record schemas (nothing is inferred) and a build-time schema check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, D, L, I, B, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Field names and types of the records the pipelines carry.
COMMON_LOG = struct(("ip", S), ("user_id", S), ("lat", D), ("lng", D), ("timestamp", S),
                    ("http_request", S), ("http_response", L), ("num_bytes", L), ("user_agent", S))
ENVELOPE = T.StructType([
    T.StructField("event_timestamp", TS, False),
    T.StructField("attributes", T.MapType(S, S), True),
    T.StructField("payload", struct(("user_id", S), ("ip", S), ("timestamp", S), ("http_request", S),
                                    ("lat", T.FloatType()), ("lng", T.FloatType()), ("http_response", I),
                                    ("user_agent", S), ("num_bytes", I)), True),
])
USERS = struct(("age_bracket", S), ("id", L), ("ip", S), ("lat", D), ("lng", D),
               ("opted_into_marketing", B), ("user_agent", S))
WEATHER = struct(("loc_id", S), ("lat", D), ("lng", D), ("date", S), ("low_temp", D),
                 ("high_temp", D), ("precip", D))
TAXI = struct(("ride_id", S), ("point_idx", L), ("latitude", D), ("longitude", D), ("timestamp", S),
              ("meter_reading", D), ("meter_increment", D), ("ride_status", S), ("passenger_count", L))
STORE_SALES = struct(("store_id", S), ("store_location", S), ("product_id", S), ("product_category", S),
                     ("number_of_pieces_sold", L), ("buy_rate", L), ("sell_price", L), ("unix_timestamp", L))
CARDS = struct(("customer_id", S), ("first_name", S), ("last_name", S), ("relationship_id", S),
               ("card_type", S), ("max_limit", L), ("spent", L), ("cash_withdrawn", L),
               ("payment_cleared", L), ("payment_date", S))
LOANS = struct(("customer_id", S), ("first_name", S), ("last_name", S), ("occupation", S), ("loan_id", S),
               ("category", S), ("due_date", S), ("amount", L), ("payment_date", S))
GAME = struct(("game_id", S), ("player_id", S), ("player_name", S), ("team_id", S), ("team_name", S),
              ("weapon", S), ("weapon_rank", L), ("map_place", S), ("opp_player_id", S), ("opp_name", S),
              ("opp_team_id", S), ("opp_team_name", S), ("opp_weapon", S), ("opp_rank", L),
              ("opp_place", S), ("battle_time", L), ("unix_timestamp", L))
FOOD_ORDER_FIELDS = ("customer_id", "date", "timestamp", "order_id", "items", "amount", "mode",
                     "restaurant", "status", "ratings", "feedback", "new_col")

# events.props carries one JSON object with exactly one key
PROPS = struct(("k", L))


class SchemaMismatch(TypeError):
    pass


def expect_schema(df: DataFrame, schema: T.StructType, exact: bool = False) -> DataFrame:
    """Check column names and types before any job runs (declared input types).

    Every field of ``schema`` must exist with the same type; ``exact`` also
    forbids extra columns. Returns ``df`` unchanged so it chains.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in schema.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    if exact:
        extra = set(have) - set(schema.fieldNames())
        problems += [f"unexpected {n}" for n in sorted(extra)]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df
