"""Fixed values. They have to be exactly these for the results to be right."""

# Prefecture code -> political division id.
PREFECTURE_DIVISIONS = {
    1: 406, 2: 453, 3: 402, 4: 407, 5: 405, 6: 403, 7: 404,
    11: 409, 12: 410, 13: 413, 14: 414, 15: 408, 16: 411, 17: 412,
    21: 448, 22: 445, 23: 447, 24: 446,
    31: 422, 32: 420, 33: 419, 34: 421,
    41: 418, 42: 415, 43: 416, 44: 417,
    51: 426, 52: 435, 53: 430, 54: 427, 55: 436, 56: 423, 57: 428, 58: 425, 59: 429,
    61: 431, 62: 434, 63: 424, 64: 432,
    71: 437, 72: 439, 73: 438,
    81: 444, 82: 440, 83: 441, 84: 443, 85: 442,
    91: 451, 92: 452, 93: 450, 94: 449,
}

# Instrument type -> ids of the instruments of that type.
INSTRUMENT_TYPE_MEMBERS = {
    1: (1, 2, 11, 12, 21, 22, 40, 41, 50, 51, 60, 61, 70, 71, 82, 83, 92, 93, 102, 103),
    2: (3, 9, 17, 18, 27, 28, 46, 47, 56, 57, 66, 67, 77, 88, 89, 98, 99, 108, 109),
    3: (4, 19, 29, 48, 58, 68, 78, 90, 100, 110),
    4: (5, 13, 23, 42, 52, 62, 72, 84, 94, 104),
    5: (6, 14, 24, 43, 53, 63, 73, 85, 95, 105),
    6: (7, 15, 25, 44, 54, 64, 74, 86, 96, 106),
    7: (8, 16, 26, 45, 55, 65, 75, 87, 97, 107),
    8: (76,),
    9: (10, 20, 30, 49, 59, 69, 81, 91, 101, 111),
    10: (79,),
    11: (80,),
}

# Instrument types (id, descr).
INSTRUMENT_TYPES = [
    (1, "Rainfall sensor"),
    (2, "Solar radiation sensor"),
    (3, "Sunshine duration sensor"),
    (4, "Air temperature sensor"),
    (5, "Humidity sensor"),
    (6, "Wind velocity sensor"),
    (7, "Wind direction sensor"),
    (8, "Wind velocity and direction sensor"),
    (9, "Battery sensor"),
    (10, "Evaporation sensor"),
    (11, "Air pressure sensor"),
]

# Compass names -> degrees; the swapped spellings occur in the data.
COMPASS_DEGREES = {
    "N": 0, "NE": 45, "E": 90, "SE": 135, "S": 180, "SW": 225, "W": 270, "NW": 315,
    "EN": 45, "ES": 135, "WS": 225, "WN": 315,
}

# File type -> file name extension.
FILE_EXTENSIONS = {
    1: "jpg", 2: "mpg", 3: "mp3", 4: "avi", 5: "wmv", 6: "wav", 7: "png", 8: "bmp", 9: "gif",
}

# Variable type -> interval type (type 1 has none).
INTERVAL_TYPES = {2: 1, 3: 2, 4: 4, 5: 3, 6: 2}

# Time zone (id, code, utc_offset in minutes).
TIME_ZONES = [(1, "EET", 120)]

# Units (id, symbol, descr, descr_alt).
UNITS = [
    (1, "°", "", ""),
    (2, "m/s", "", ""),
    (3, "mm", "", ""),
    (4, "°C", "", ""),
    (5, "hPa", "", ""),
    (6, "gr/m³", "", ""),
    (7, "%", "", ""),
    (8, "m", "", ""),
    (9, "m³/s", "", ""),
    (10, "beaufort", "", ""),
    (11, "min", "", ""),
    (12, "n/a", "", "not applicable"),
    (13, "cm", "", ""),
    (14, "unknown", "", ""),
]

# Unit id -> variables measured in it (national network).
UNIT_VARIABLES = {
    1: (2,),
    2: (4, 5, 107),
    3: (7, 8, 12, 13, 14, 15, 52, 54, 55, 106),
    4: (10, 18, 19, 20, 21, 22, 23, 24, 25, 26, 28, 29, 30, 31, 32, 34, 35, 36, 37, 39, 56, 57),
    5: (44, 46),
    6: (48,),
    7: (50,),
    8: (88, 103),
    9: (101,),
    10: (1,),
    11: (9, 16),
    12: (11, 17, 40, 41, 108, 109, 110),
    13: (53,),
    14: (42, 43, 45, 47, 62, 102, 111),
}

# Unit id -> variables measured in it (local weather network).
LOCAL_UNIT_VARIABLES = {
    1: (1,), 2: (2,), 3: (3,), 4: (4, 9, 10), 5: (5,), 6: (6,), 7: (6,),
    8: (7,), 9: (8,), 10: (4, 9, 10),
}

# Unit given to a series that has none (id, descr, descr_alt, symbol).
UNIT_NOT_SET = (1001, "Χωρίς μονάδες", "Not set", "-")

# Time steps (id, descr, descr_alt, length_minutes, length_months).
EXTRA_TIME_STEPS = [
    (6, "Μηνιαία", "", 0, 1),
    (7, "Ετήσια", "", 0, 12),
]
LOCAL_TIME_STEPS = [
    (1, "10-minute", "", 10, 0),
    (2, "Hourly", "", 60, 0),
    (3, "Daily", "", 1440, 0),
    (4, "Monthly", "", 0, 1),
    (5, "Annual", "", 0, 12),
]
UTILITY_TIME_STEPS = [
    (1, "Δεκάλεπτο", "Ten-minute", 10, 0),
    (2, "Ωριαίο", "Hourly", 60, 0),
    (3, "Ημερήσιο", "Daily", 1440, 0),
    (4, "Μηνιαίο", "Monthly", 0, 1),
    (5, "Ετήσιο", "Annual", 0, 12),
    (6, "Πεντάλεπτο", "Five-minute", 5, 0),
]

# Time step id -> minutes, for the steps whose phase is set.
PHASE_STEP_MINUTES = {1: 10, 2: 60, 3: 1440, 6: 5}

# Alternate code type of the national network (id, descr, descr_alt).
BASIN_CODE_TYPE = [(1, "Κωδικός ΥΠΑΝ", "")]

# Curve document types (id, descr, descr_alt, file_extension).
RESERVOIR_CURVE_TYPES = [
    (2, "Καμπύλες στάθμης - επιφάνειας - όγκου", "Stage - Area - Storage curves", "txt"),
    (3, "Συντελεστές υπόγειων διαφυγών ταμιευτήρα", "Reservoir leakage coefficients", "txt"),
    (4, "Καμπύλη υπερχείλισης - παροχής ταμιευτήρα", "Reservoir spill - discharge curve", "txt"),
]
AQUEDUCT_CURVE_TYPES = [
    (5, "Καμπύλη πιεζ. φορτίου - παροχής υδραγωγείου", "Aqueduct head-discharge curve", "txt"),
]

# Labels in remarks (main language, alternate language).
LOCATION_LABELS = ("Τοποθεσία", "Location")
MUNICIPALITY_LABELS = ("Δήμος", "Municipality")
OBSERVER_LABELS = ("Παρατηρητής", "Observer")
KIND_LABELS = ("Τύπος", "Type")
RAW_KIND = ("Πρωτογενής", "Raw data")
PROCESSED_KIND = ("Επεξεργασμένη", "Processed data")

# Opening lines of a stage-discharge document.
CURVE_HEADER = 'Delimiter=","\nDecimalSeparator="."\nDateFormat="yyyy-mm-dd hh:nn"\n'

# Columns of a lookup table and of the 200/50 character names.
NAME_LENGTH = 200
SHORT_NAME_LENGTH = 50
