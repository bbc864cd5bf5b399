"""Table layouts, code lists and the rule tables used for validation."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "i": T.IntegerType(), "d": T.DoubleType(), "t": T.TimestampType(), "D": T.DateType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (p.split(":") for p in spec.split())])


GAME_RAW = _struct(
    "provider:s team_id_source:s team_id_master:s team_name:s club_name:s opponent_name:s opponent_id:s "
    "age_group:s gender:s state:s game_date:s home_away:s goals_for:s goals_against:s result:s "
    "competition:s venue:s city:s source_url:s scraped_at:s"
)
GAME_COLUMNS = GAME_RAW.fieldNames()
GAME_NORM = _struct(
    "team_id_master:s opponent_id_master:s team:s opponent:s club:s state:s gender:s age_group:s date:D gf:d ga:d"
)
MASTER_TEAM = _struct(
    "team_id:s provider_team_id:s team_name:s age_group:s age_u:i gender:s state:s provider:s club_name:s "
    "source_url:s created_at:s"
)
MASTER_SLICE = _struct(
    "team_id_master:s team_id_source:s team_name:s club_name:s state:s gender:s age_group:s provider:s"
)
CLUB_LOOKUP = _struct(
    "provider:s club_id:s club_name:s state:s city:s website:s first_seen_at:s last_seen_at:s source_url:s"
)
IDENTITY = T.StructType([
    T.StructField("canonical_name", T.StringType()),
    T.StructField("provider_ids", T.MapType(T.StringType(), T.StringType())),
    T.StructField("aliases", T.ArrayType(T.StringType())),
    T.StructField("club_history", T.ArrayType(T.StringType())),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])
HASH_STORE = T.StructType([
    T.StructField("slice_key", T.StringType()),
    T.StructField("build_id", T.StringType()),
    T.StructField("last_updated", T.StringType()),
    T.StructField("total_games", T.IntegerType()),
    T.StructField("games", T.MapType(T.StringType(), T.StringType())),
])
METADATA_ENTRY = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("teams_total", T.LongType()),
    T.StructField("states_total", T.LongType()),
    T.StructField("data_quality", T.DoubleType()),
    T.StructField("build_duration_seconds", T.LongType()),
    T.StructField("providers", T.ArrayType(T.StringType())),
    T.StructField("age_groups", T.ArrayType(T.StringType())),
    T.StructField("genders", T.ArrayType(T.StringType())),
    T.StructField("notes", T.StringType()),
])

REQUIRED_GAME = ("team_id_master", "opponent_id_master", "team", "opponent", "club", "state", "gender",
                 "age_group", "date", "gf", "ga")
# Raw game column -> normalized name.
GAME_RENAMES = {
    "team_name": "team", "goals_for": "gf", "goals_against": "ga", "game_date": "date",
    "opponent_name": "opponent", "opponent_id": "opponent_id_master", "club_name": "club",
}

# The 50 states and DC.
US_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY",
    "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND",
    "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
)
# Regional code -> state.
REGION_TO_STATE = {
    "CAS": "CA", "CAN": "CA", "TXN": "TX", "TXS": "TX", "PAE": "PA", "PAW": "PA", "NYE": "NY", "NYW": "NY",
}
# Codes that are not US states.
NON_US = (
    "CAN", "MEX", "GBR", "FRA", "JAM", "JPN", "IRL", "ARG", "COL", "PUR", "QC", "ON", "BC", "AB", "CND",
    "Surrey", "OTH",
)
# Words dropped from team names before they are compared.
NAME_STOPWORDS = (
    "fc", "sc", "academy", "united", "club", "soccer", "football", "athletic", "association",
    "organization", "team", "sports", "youth", "junior", "senior", "elite", "premier", "select", "travel",
    "competitive", "recreation", "recreational",
)
# Weight of each field in the completeness score.
COMPLETENESS_WEIGHTS = {
    "team_name": 0.25, "team_id": 0.20, "provider_team_id": 0.15, "age_group": 0.10, "age_u": 0.10,
    "gender": 0.10, "state": 0.10, "club_name": 0.05, "source_url": 0.05,
}
# Which feed wins between equally complete records, and the file-name mark of each feed.
PROVIDER_PREFERENCE = {"GotSport": 3, "Modular11": 2, "AthleteOne": 1}
PROVIDER_FILE_MARKS = {"gotsport": "GotSport", "modular11": "Modular11", "athleteone": "AthleteOne"}

# Text formats every record is checked against.
TEAM_ID_FORMAT = "^[a-f0-9]{12}$"
AGE_GROUP_FORMAT = "^U(1[0-8]|[0-9])$"
STATE_FORMAT = "^[A-Z]{2}$"
DATE_FORMAT = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_FORMAT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?Z?$"
