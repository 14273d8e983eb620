"""Code lists of the two countries' accident files."""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Published source code -> label.  They must equal the labels the
# warehouse is queried with.
# ---------------------------------------------------------------------------

FR_SEVERITY = {1: "Uninjured", 2: "Killed", 3: "Seriously injured", 4: "Slightly injured"}
FR_SEX = {-1: "Unknown", 1: "Male", 2: "Female"}
FR_USER = {1: "Driver", 2: "Passenger", 3: "Pedestrian", 4: "Cyclist"}
FR_VEHICLE = {
    1: "Bicycle",
    2: "Moped",
    3: "Motorcycle",
    4: "Motorcycle",
    5: "Motorcycle",
    6: "Motorcycle",
    7: "Car",
    10: "Car",
    13: "Heavy goods vehicle",
    14: "Heavy goods vehicle",
    15: "Heavy goods vehicle",
    16: "Tractor",
    17: "Agricultural vehicle",
    20: "Scooter",
    21: "Bicycle",
    30: "Electric scooter",
    31: "Electric bicycle",
    40: "Tram",
    41: "Bus",
    42: "Train",
    99: "Other",
}
FR_MANOEUVRE = {
    0: "Unknown",
    1: "Going ahead",
    2: "Going ahead",
    3: "Going ahead",
    4: "Going ahead",
    5: "Going ahead",
    6: "Going ahead",
    7: "Going ahead",
    8: "Going ahead",
    9: "Turning left",
    10: "Turning right",
    11: "U-turn",
    12: "Changing lane",
    13: "Overtaking",
    14: "Overtaking",
    15: "Overtaking",
    17: "Crossing median",
    18: "Reversing",
    19: "Parked",
    22: "Parked",
    24: "Avoiding obstacle",
    25: "Door opening",
    26: "Stopped",
}
FR_ENGINE = {
    -1: "Unknown",
    0: "Unknown",
    1: "Petrol",
    2: "Hybrid",
    3: "Electric",
    4: "Hydrogen",
    5: "Human powered",
    6: "Other",
}
FR_ROAD = {
    1: "Motorway",
    2: "National road",
    3: "Departmental road",
    4: "Municipal road",
    5: "Off-network",
    6: "Parking",
    7: "Urban road",
    9: "Other",
}
UK_SEVERITY = {1: "Killed", 2: "Seriously injured", 3: "Slightly injured"}
UK_SEX = {-1: "Unknown", 1: "Male", 2: "Female", 3: "Unknown"}
UK_CLASS = {1: "Driver", 2: "Passenger", 3: "Pedestrian"}
UK_VEHICLE = {
    1: "Bicycle",
    2: "Motorcycle",
    3: "Motorcycle",
    4: "Taxi",
    5: "Bus",
    8: "Motorcycle",
    9: "Car",
    10: "Minibus",
    11: "Bus",
    16: "Ridden horse",
    17: "Agricultural vehicle",
    18: "Tram",
    19: "Van",
    20: "Heavy goods vehicle",
    21: "Heavy goods vehicle",
    90: "Other",
    99: "Unknown",
    109: "Car",
}
UK_MANOEUVRE = {
    1: "Reversing",
    2: "Parked",
    3: "Waiting to go ahead",
    4: "Slowing or stopping",
    5: "Moving off",
    6: "U-turn",
    7: "Turning left",
    8: "Waiting to turn left",
    9: "Turning right",
    10: "Waiting to turn right",
    11: "Changing lane to left",
    12: "Changing lane to right",
    13: "Overtaking",
    14: "Overtaking",
    16: "Going ahead",
    17: "Going ahead",
    99: "Unknown",
}
UK_ENGINE = {
    -1: "Unknown",
    0: "Unknown",
    1: "Petrol",
    2: "Diesel",
    3: "Electric",
    4: "Steam",
    5: "Gas",
    6: "Petrol/Gas",
    7: "Gas/Bi-fuel",
    8: "Hybrid",
    9: "Gas diesel",
    10: "New fuel technology",
    11: "Fuel cells",
    12: "Electric diesel",
}
UK_ROAD = {
    1: "Motorway",
    2: "A road",
    3: "A road",
    4: "B road",
    5: "C road",
    6: "Unclassified",
}

# Words the source reader treats as missing.
NULL_WORDS_AT_READ = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
NULL_WORDS_AFTER_TRIM = ["nan", "None", "N/A"]

# Countries and the years the warehouse covers.
COUNTRIES = [(1, "FR", "France"), (2, "UK", "United Kingdom")]
WAREHOUSE_YEARS = [2005, 2007, 2009, 2011, 2013, 2015, 2017, 2019, 2021]

# French calendar words and season names.
DAY_NAMES = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]
MONTH_NAMES = [
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
]
SEASONS = {"Hiver": [12, 1, 2], "Printemps": [3, 4, 5], "Ete": [6, 7, 8], "Automne": [9, 10, 11]}

# All books by (country, book).
BOOKS = {
    ("FR", "severity"): FR_SEVERITY,
    ("FR", "sex"): FR_SEX,
    ("FR", "user"): FR_USER,
    ("FR", "vehicle"): FR_VEHICLE,
    ("FR", "manoeuvre"): FR_MANOEUVRE,
    ("FR", "engine"): FR_ENGINE,
    ("FR", "road"): FR_ROAD,
    ("UK", "severity"): UK_SEVERITY,
    ("UK", "sex"): UK_SEX,
    ("UK", "class"): UK_CLASS,
    ("UK", "vehicle"): UK_VEHICLE,
    ("UK", "manoeuvre"): UK_MANOEUVRE,
    ("UK", "engine"): UK_ENGINE,
    ("UK", "road"): UK_ROAD,
}
