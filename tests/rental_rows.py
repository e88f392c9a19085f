"""Synthetic rental rows that hold the awkward cases: missing and blank values, ties,
first and last instants, open rentals, rows without a partner."""

from datetime import datetime as t
from decimal import Decimal as d

LAST_MICRO = 999999
STAMP = t(2017, 1, 1)

ROWS = {
    "language": [(1, "English", STAMP), (2, "French", STAMP), (3, " english ", STAMP)],
    "film": [
        (1, "ALPHA RING", None, 2017, 1, None, 3, d("2.99"), 100, d("20.00"), "G", STAMP),
        (2, "BETA RING", None, 2018, 2, None, 5, d("0.99"), 90, d("15.00"), "PG", STAMP),
        (3, "GAMMA RING", None, None, 1, None, 7, d("4.99"), None, d("25.00"), "PG-13", STAMP),
        (4, "DELTA", None, 2019, 1, None, 3, d("4.99"), 80, d("19.99"), "R", STAMP),
        (5, "alpha low", None, 2012, 2, None, 3, d("3.99"), 120, d("9.99"), "NC-17", STAMP),
        (6, "OMEGA", None, 2015, 1, None, 4, d("1.99"), 60, d("9.99"), "X", STAMP),
    ],
    "category": [(1, "Animation"), (2, "Drama"), (3, "Travel"), (4, "Documentary")],
    "film_category": [(1, 1), (1, 2), (2, 1), (4, 2), (5, 3), (6, 4)],
    "actor": [(1, "Ann", "Zed", STAMP), (2, "Bob", "Yew", STAMP), (3, "Cat", "Xu", STAMP),
              (4, "Ann", "Zed", STAMP), (5, "Dan", "Wu", STAMP)],
    "film_actor": [(1, 1, STAMP), (1, 2, STAMP), (1, 5, STAMP), (2, 6, STAMP), (2, 4, STAMP),
                   (2, 3, STAMP), (4, 5, STAMP), (4, 1, STAMP), (5, 5, STAMP)],
    "store": [(1, 1), (2, 2), (3, 3)],
    "address": [(1, "1 Main", None, 1), (2, "2 Oak", "", 2), (3, "3 Elm", "Flat 2", 1),
                (4, "4 Fir", None, 1), (5, "5 Ash", None, 2)],
    "city": [(1, 1), (2, 2), (3, 3)],
    "country": [(1, "Norland"), (2, "Sudland"), (3, "Emptyland")],
    "customer": [(1, "Ida", "Moe", "ida@example.org", 4, STAMP),
                 (2, "Jan", "O'Poe", "jan@example.org", 5, STAMP),
                 (3, "Kit", "Roe", None, 4, STAMP)],
    "staff": [(1, "Sue", "Low", 1), (2, "Tom", "May", 2), (3, "Una", "Nix", 2),
              (4, "Vic", "Orr", 3)],
    "inventory": [(1, 1, 1, STAMP), (2, 1, 2, STAMP), (3, 2, 1, STAMP), (4, 4, 2, STAMP),
                  (5, 3, 1, STAMP), (6, 5, 2, STAMP)],
    "rental": [
        # kept exactly the agreed time; never came back; kept exactly twice the time
        (1, t(2017, 1, 1, 10), 1, 1, t(2017, 1, 4, 10), 1, STAMP),
        (2, t(2017, 2, 1, 10), 2, 2, None, 2, STAMP),
        (3, t(2017, 3, 31, 23, 59, 59), 3, 1, t(2017, 4, 10, 23, 59, 59), 1, STAMP),
        # one second past six days counts as seven; two open rentals of one copy
        (4, t(2017, 5, 1, 8), 1, 2, t(2017, 5, 7, 8, 0, 1), 1, STAMP),
        (5, t(2017, 6, 1, 8), 5, 1, None, 1, STAMP),
        (6, t(2017, 6, 2, 8), 5, 2, None, 1, STAMP),
    ],
    "payment": [
        (1, 1, 1, 1, d("2.99"), t(2017, 1, 1)),
        (2, 2, 2, 2, d("5.00"), t(2017, 3, 31, 23, 59, 59, LAST_MICRO)),
        (3, 1, 1, 3, d("0.99"), t(2017, 4, 1)),
        (4, 2, 1, 4, d("12.00"), t(2017, 12, 31, 23, 59, 59, LAST_MICRO)),
        (5, 1, 2, 5, d("4.99"), t(2018, 1, 1)),
        # without a rental; at the same instant as another payment
        (6, 1, 3, None, d("100.00"), t(2017, 7, 1)),
        (7, 2, 1, 2, d("1.00"), t(2017, 12, 31, 23, 59, 59, LAST_MICRO)),
    ],
}
