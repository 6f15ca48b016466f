"""Six small tables with the awkward rows every operator has to cope with."""

from plazaframe.schemas import COMPLIMENTS, SCHEMAS


def _place(i, name, city, state, stars, reviews, is_open, categories="Food, Shops", attributes=None, hours=None):
    return (i, name, "1 Way", city, state, "1000", 40.0, -75.0, stars, reviews, is_open, attributes, categories, hours)


PLACES = [
    _place("b1", "Ann's", "Philadelphia", "PA", 4.5, 200, 1, "Restaurants, Pizza", {"WiFi": "free", "HasTV": "True"}, {"Monday": "9:0-17:0", "Friday": "9:0-17:0"}),
    _place("b2", "Bob's", "Philadelphia", "PA", 3.5, 150, 1, "Fast Food, Burgers", {}, {}),
    _place("b3", "Cat's", "Philadelphia", "PA", 5.0, 150, 0, "Food, Bakeries"),
    _place("b4", "Dan's", "Reno", "NV", 4.5, 100, 1, "Restaurants"),
    _place("b5", "Eve's", "Reno", "NV", 2.5, 90, 1, "Restaurants, Food"),
    _place("b6", "Fay's", "Reno", "NV", 5.0, 400, 1, None),
    _place("b7", "Gil's", None, None, 4.0, None, 1, ""),
    _place("b8", "Hal's", "Tampa", "FL", None, 10, 1, " a ,, b,"),
    _place("b9", "Ida's", "Tampa", "FL", 1.0, 10, None, "Unknown"),
]


def _review(i, user, place, stars, date, useful, funny=0, cool=0):
    return (i, user, place, stars, date, f"text {i}", useful, funny, cool)


REVIEWS = [
    _review("r1", "u1", "b1", 5.0, "2019-01-05 10:00:00", 9, 1, 1),
    _review("r2", "u2", "b1", 4.0, "2019-01-20 10:00:00", 5, 0, 0),
    _review("r3", "u3", "b1", 1.0, "2019-02-01 10:00:00", 30, 9, 9),
    _review("r4", "u1", "b2", 5.0, "2019-02-02 10:00:00", 5, 3, 3),
    _review("r5", "u1", "b5", 5.0, "2020-03-02 10:00:00", 7, None, 8),
    _review("r6", "u9", "b3", 5.0, "2020-03-02 10:00:00", 2, 0, 0),
    _review("r7", "u2", "b3", 4.0, "2020-03-02 10:00:00", 6, 6, 6),
    _review("r8", "u2", "b99", 4.0, "junk", 1, 0, 0),
    _review("r9", "u4", None, 3.0, None, 1, 0, 0),
]


def _user(i, name, reviews, since, friends, useful, fans, elite, stars, compliments):
    return (i, name, reviews, since, friends, useful, 0, 0, fans, elite, stars, *compliments)


def _spread(total):
    """Compliments of all kinds adding up to ``total``."""
    return [total - 10, *[1] * 10]


USERS = [
    _user("u1", "Kim", 900, "2010-05-01 00:00:00", "u2, u3", 50, 300, "2012,2013", 4.0, _spread(50)),
    _user("u2", "Lou", 600, "2010-07-01 00:00:00", "None", 50, 100, "2015", 3.0, _spread(20)),
    _user("u3", "Max", 700, "2010-08-01 00:00:00", "u1", 40, 500, "", 2.0, _spread(20)),
    _user("u4", "Ned", 500, "2011-08-01 00:00:00", None, 30, 300, None, 5.0, [None] + [5] * 10),
    _user("u5", "Oda", 499, "2011-09-01 00:00:00", " a ,, b,", 30, 400, "2016", 4.0, [0] * 11),
    _user("u6", "Pat", 800, "bad date", "", 10, 300, "2017,2018,2019", 4.0, _spread(10)),
]

TIPS = [
    ("try it", "2020-01-01 08:00:00", 3, "b1", "u1"),
    ("nice", "2020-01-11 08:00:00", 5, "b1", "u1"),
    ("ok", "2020-03-11 08:00:00", 4, "b2", "u1"),
    ("old", "2019-12-31 23:59:59", 9, "b2", "u2"),
    ("meh", "2021-01-01 00:00:00", 2, "b4", "u2"),
    ("fine", "2021-01-02 00:00:00", 3, "b4", "u3"),
    (None, "2021-01-03 00:00:00", None, "b4", "u9"),
    ("wow", None, 7, "b5", "u3"),
    ("hm", "2021-02-01 00:00:00", 0, "b99", "u4"),
]

PHOTOS = [("p1", "b1", "c", "food"), ("p2", "b1", None, "food"), ("p3", "b4", "c", "menu"), ("p4", "b6", "", "food"), ("p5", "b99", "", "x")]

CHECKINS = [
    ("b1", "2020-01-01 10:00:00, 2020-01-02 10:00:00,2020-01-03 10:00:00"),
    ("b1", "2020-02-01 10:00:00"),
    ("b2", ""),
    ("b4", None),
    ("b4", "2020-01-01 10:00:00, 2020-05-01 10:00:00"),
    ("b99", "2020-01-01 10:00:00"),
]

ROWS = {"business": PLACES, "review": REVIEWS, "user": USERS, "tip": TIPS, "photo": PHOTOS, "checkin": CHECKINS}


def frames(spark):
    return {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in ROWS.items()}


assert len(COMPLIMENTS) == 11
