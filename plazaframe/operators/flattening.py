"""Maps and delimited lists to plain columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame

from plazaframe.functions.text import entry_count, flag, map_size, map_values, token_count

# The attributes of a place that become columns.
ATTRIBUTES = [
    "GoodForKids",
    "RestaurantsPriceRange2",
    "BikeParking",
    "WiFi",
    "BusinessParking",
    "Ambience",
    "RestaurantsGoodForGroups",
    "OutdoorSeating",
    "HasTV",
    "RestaurantsReservations",
    "Alcohol",
    "RestaurantsDelivery",
    "RestaurantsTakeOut",
    "GoodForMeal",
    "ByAppointmentOnly",
    "RestaurantsTableService",
    "Caters",
    "NoiseLevel",
    "RestaurantsAttire",
    "GoodForDancing",
    "DriveThru",
    "Smoking",
    "WheelchairAccessible",
    "AcceptCreditCards",
    "Open24Hours",
    "DogsAllowed",
    "BYOB",
    "Corkage",
    "BYOBCorkage",
    "HairSpecializesIn",
    "RestaurantsCounterService",
    "AgesAllowed",
    "Music",
]

# The days of the opening hours and the columns they become.
HOURS = {
    "Monday": "hours_mon",
    "Tuesday": "hours_tue",
    "Wednesday": "hours_wed",
    "Thursday": "hours_thu",
    "Friday": "hours_fri",
    "Saturday": "hours_sat",
    "Sunday": "hours_sun",
}

_NAME_SAFE = str.maketrans(". -", "___")


def key_columns(keys: Iterable[str], prefix: str) -> dict[str, str]:
    """Map key -> column name: the prefix and the key, with ``_`` for dots, spaces and hyphens.

    Of keys that would share a name the later ones get a number, so that every key has its column.
    """
    named: dict[str, str] = {}
    for key in dict.fromkeys(keys):
        name = wanted = prefix + key.translate(_NAME_SAFE)
        again = 2
        while name in named.values():
            name, again = f"{wanted}_{again}", again + 1
        named[key] = name
    return named


def map_to_columns(df: DataFrame, column: str, names: Mapping[str, str]) -> DataFrame:
    """Add one text column per map key, all in one projection."""
    return df.withColumns(map_values(column, names))


def flatten_places(df: DataFrame, placeholder: str = "Unknown") -> DataFrame:
    have = set(df.columns)
    if "attributes" not in have:
        return df
    new = map_values("attributes", key_columns(ATTRIBUTES, "attr_"))
    if "hours" in have:
        new |= {"open_days_count": map_size("hours"), **map_values("hours", HOURS)}
    if "categories" in have:
        new["category_count"] = token_count("categories", ["none", placeholder])
    return df.withColumns(new)


def flatten_users(df: DataFrame, placeholder: str = "Unknown") -> DataFrame:
    new = {}
    if "friends" in df.columns:
        new["friend_count"] = token_count("friends", ["none", placeholder])
    if "elite" in df.columns:
        new["elite_count"] = token_count("elite", ["none", placeholder])
        new["is_elite"] = flag(new["elite_count"] > 0)
    return df.withColumns(new) if new else df


def flatten_checkins(df: DataFrame, placeholder: str = "Unknown") -> DataFrame:
    if "date" not in df.columns:
        return df
    return df.withColumns({"checkin_count": entry_count("date")})


FLATTENERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {
    "business": flatten_places,
    "user": flatten_users,
    "checkin": flatten_checkins,
}


def flatten(df: DataFrame, table: str, placeholder: str = "Unknown") -> DataFrame:
    """Flatten by table name; tables with nothing nested come back unchanged."""
    return FLATTENERS.get(table, lambda same, _: same)(df, placeholder)
