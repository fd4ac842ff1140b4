"""Values that must be exactly these for results to be right."""

# Accepted members of each checked column.
USER_COUNTRIES = ["Germany", "United Kingdom", "United States"]
USER_COUNTRY_CODES = ["DE", "GB", "US", "GGB"]
STORE_COUNTRY_CODES = ["DE", "GB", "US"]
AVAILABILITY = ["Still_available", "Removed"]
TIME_PERIODS = ["Evening", "Morning", "Midday", "Late_Hours"]

# Spellings to repair and text that stands for "nothing".
COUNTRY_CODE_FIX = ("GGB", "GB")
AVAILABILITY_FIX = ("Still_avaliable", "Still_available")
CARD_NOISE = "?"
CONTINENT_NOISE = "ee"
CURRENCY_SIGN = "£"
MISSING_POSITION = "N/A"

# Units of weight, each with the factor and the divisor that make it
# kilograms; a millilitre counts as a gram, and `g .` is a misspelt gram.
WEIGHT_UNITS = [
    ("kg", 1.0, 1.0),
    ("ml", 1.0, 1000.0),
    ("oz", 0.0283495, 1.0),
    ("g .", 1.0, 1000.0),
    ("g", 1.0, 1000.0),
]

# Weight class limits in kilograms.
WEIGHT_CLASSES = [(2, "Light"), (40, "Mid_Sized"), (140, "Heavy")]
HEAVIEST_CLASS = "Truck_Required"

# The store type sold online and the two sales channels.
WEB_STORE_TYPE = "Web Portal"
WEB, OFFLINE = "Web", "Offline"

# The commonest date layouts, each with the shape of text it may read. `NAME` is
# a month name, whole or as its first three letters. Other dates are read by their parts.
DATE_LAYOUTS = [
    (r"\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"),
    (r"\d{4} NAME \d{1,2}", "yyyy MMMM d"),
    (r"NAME \d{4} \d{1,2}", "MMMM yyyy d"),
    (r"\d{4}/\d{1,2}/\d{1,2}", "yyyy/M/d"),
]

# Weekdays, whole or cut; a date may name one, which says nothing more.
WEEKDAY_NAMES = "mon(day)?|tue(s(day)?)?|wed(nesday)?|thu(rs(day)?)?|fri(day)?|sat(urday)?|sun(day)?"
# Words between the parts of a date, endings of a day's number among them.
DATE_FILLERS = "at|on|and|ad|m|t|of|st|nd|rd|th"
# A clock beside a date, with or without seconds, fractions, half of day and zone; and one of digits alone.
SHORT_CLOCK = r"([01]\d|2[0-3])[0-5]\d([0-5]\d)?"
CLOCK = r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d([.,]\d+)?)?( ?[ap]m)?( ?(z|utc|gmt|[+-]\d{2}:?\d{2}))?"
