"""Fixed values that results must carry exactly."""

# Provenance of a reconciled club.
FROM_TRANSFER = "Latest Transfer"
FROM_APPEARANCE = "Latest Appearance"
FROM_RECORD = "Original Record"

# Data-quality texts.
STALE_NOTE_PREFIX = "Warning: No recent data available. Last record from "
FRESH_NOTE = "Data recent and reliable"

# Date bounds.
NO_RECORD_DATE = "1900-01-01"
STALE_AFTER_MONTHS = 6
NOTE_DATE_FORMAT = "yyyy-MM-dd"

# League points and side labels.
POINTS_PER_WIN = 3
POINTS_PER_DRAW = 1
HOME = "Home"
AWAY = "Away"

# Ordinals of the columns kept from the raw files.
CLUBS_POSITIONS = (0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 12, 14)
COMPETITIONS_POSITIONS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 10)
GAMES_POSITIONS = (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 19, 20, 22)

# Texts that pandas reads as missing by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
