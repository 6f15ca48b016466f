"""Every query over the sample tables, next to the SQL that must give the same rows."""

from plazaframe.plans.registered import edges, engagement, places, preparing, profiles, reviews, stored, storing, users
from plazaframe.plans.registered.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "edges", "engagement", "places", "preparing", "profiles", "reviews", "stored", "storing", "users"]
