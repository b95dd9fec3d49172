"""Fixed values.

Everything below is data that the reports depend on literally: names, phrases, code tables. The
wording and the case are part of the results; change them only together with the report owners.
"""

# Constants of the reports.
PLATFORM = "YouTube"
OWN_UPLOADER = "self"
HOME_COUNTRY = "US"
FOREIGN = "Non-US"
OTHER_BUCKET = "Other"
NO_SERIES_ID = "-1"
NO_SERIES_NAME = "other"
NO_BRAND = "other"
ALL_FORMS = "ALL"
INITIAL_DATE = "2024-10-01"
UPLOAD_TIME_FORMAT = "yyyy/MM/dd HH:mm:ss"
DATE_KEY_FORMAT = "yyyyMMdd"

# Device names by bucket.
HANDHELD_DEVICES = ["Mobile Phone", "Tablet"]
HANDHELD_BUCKET = "Mobile Phone & Tablet"
KEPT_DEVICES = ["Computer", "TV"]

# Traffic source names by category.
KEPT_TRAFFIC = [
    "Browse features",
    "YouTube search",
    "Suggested videos",
    "External",
    "YouTube advertising",
]
PLAYLIST_TRAFFIC = ["Playlists", "Playlist pages"]
PLAYLIST_BUCKET = "Playlists"

# Market flags. A place may carry several flags, or none.
AMER_CONTINENTS = ["North America", "South America"]
LATAM_SUB_CONTINENTS = ["LATIN NORTH", "LATIN SOUTH", "CARIBBEAN"]
EMEA_CONTINENTS = ["Africa", "Europe"]
AMEA_CONTINENTS = ["Asia", "Africa"]

# Age group code to midpoint.
AGE_MIDPOINTS = {
    "AGE_13_17": 15,
    "AGE_18_24": 21,
    "AGE_25_34": 30,
    "AGE_35_44": 40,
    "AGE_45_54": 50,
    "AGE_55_64": 60,
    "AGE_65_": 70,
}

# Genders with a percentage of their own.
GENDER_MALE = "MALE"
GENDER_FEMALE = "FEMALE"
GENDER_UNSPECIFIED = "USER_SPECIFIED"

# Video forms and the title phrases that lead to them.
FORM_MARATHON = "Marathon"
FORM_LONG = "Long Form"
FORM_COMPILATION = "Compilations"
FORM_VERTICAL = "Vertical Viewing"
FORM_SHORT = "Short Form"
SHORTS_TAG = "#shorts"
MARATHON_PHRASES = ["mega marathon", "marathon"]
LONG_PHRASES = [
    "full episode",
    "full episodes",
    "full movie",
    "full documentary",
    "ultimate guide",
    "full ep",
    "full length",
    "husband vanished after 37 years",
    "buried: knights templar and the holy grail",
    "wanda durant story",
    "college admissions scandal",
    "james van der beek",
    "14-year-old girl goes missing while walking dog",
    "he buried teen girl five feet under after night out",
    "real estate mom disappears during showing",
    "teen cheerleader is abducted by family friend",
]
LONG_EXCLUSIONS = ["part", "#shorts", "marathon"]
COMPILATION_PHRASES = [
    "compilation",
    "compilations",
    "top ",
    "most viewed moments",
    "best moments of all time",
    "moments of all time",
    "blow your mind",
    "jaw-dropping",
    "mind-boggling",
    "deadliest",
    "more super rare",
    "horrifying strange creatures",
    "rapid fire negotiations",
    "most iconic moments",
    "greatest hits",
    "best of",
    "of all time",
    "insanely high appraisals",
    "rare & patriotic us military items",
    "high value appraisals",
    "super rare high value items",
    "angry sellers lose their cool",
]
COMPILATION_MIN_SECONDS = 780
VERTICAL_PHRASES = ["shorts", "#shorts"]

# Channel names by brand.
CHANNELS_BY_BRAND = {
    "A&E Brand": [
        "Mobsters",
        "WWE on A&E",
        "Storage Wars on A&E",
        "Live Rescue on A&E",
        "Live PD on A&E",
        "A&E",
        "I Survived a Crime",
        "Parking Wars",
        "Hoarders on A&E",
        "Crime 360",
        "Wahlburgers on A&E",
        "Born This Way on A&E",
        "Cold Case Files",
        "Intervention",
        "Shipping Wars on A&E",
        "Fasten Your Seatbelt",
        "A&E True Crime",
        "Crime & Investigation",
        "Celebrity Ghost Stories",
        "Nightwatch",
        "Nature Gone Wild",
        "60 Days In on A&E",
        "Court Cam",
        "Psychic Kids",
        "Billy the Exterminator on A&E",
        "Damien on A&E",
        "Behind Bars: Rookie Year on A&E",
        "DOG The Bounty Hunter on TV",
        "The First 48",
    ],
    "Emerging": [
        "Duck Dynasty",
        "Home.Made.Nation",
        "LMN",
        "FYI Television Network",
        "Biography",
        "The UnXplained Zone",
        "Lifetime Movies",
        "The Unxplained Zone",
        "UnXplained Zone",
        "Tiny House Nation",
        "Unidentified: Inside America’s UFO Investigation",
    ],
    "History Brand": [
        "Forged In Fire",
        "Swamp People Serpent Invasion",
        "Alone on HISTORY",
        "HISTORY",
        "Ancient Aliens: Out of This World Moments",
        "Military Heroes",
        "Knightfall",
        "Ax Men on History",
        "The Legend of Shelby the Swamp Man",
        "American Pickers",
        "The Universe",
        "MonsterQuest",
        "Pawn Stars on History",
        "Ancient Aliens",
        "Mountain Men on The History Channel",
        "The Best of Pawn Stars",
        "History Shorts",
        "Kings of Pain",
        "The Curse of Oak Island",
        "Doomsday: 10 Ways The World Will End",
        "The Strongest Man In History",
        "Pawn Stars",
        "History Remade With Sabrina",
        "American Pickers on  The History Channel",
        "The Proof is Out There",
        "When Big Things Go Wrong",
        "Vikings",
        "Counting Cars",
        "Swamp People on History",
        "Ancient Workouts with Omar",
        "Forged in Fire",
        "Ice Road Truckers on HISTORY",
        "History NOW",
    ],
    "Lifetime Brand": [
        "Bring It: More Moves",
        "Little Women",
        "Dance Moms",
        "The Rap Game",
        "Cheerleader Generation",
        "Bring It",
        "Married at First Sight",
        "Married At First Sight",
        "Lifetime",
        "Dance Moms: Full Numbers",
        "Fall Into Me",
    ],
}
