"""Fixed values. They decide results, so they are stated as plain text and never derived."""

# ---- fixed values: accented letter -> ASCII letter ----
ACCENT_MAP = {
    "ï": "i", "Ü": "U", "Á": "A", "î": "i", "Ô": "O", "é": "e", "Ö": "O", "ä": "a", "ù": "u", "ë": "e",
    "À": "A", "è": "e", "ß": "S", "Â": "A", "ã": "a", "ý": "y", "ó": "o", "ớ": "o", "ò": "o", "ú": "u",
    "á": "a", "ì": "i", "ü": "u", "Ç": "C", "Ớ": "O", "í": "i", "ô": "o", "ê": "e", "û": "u", "ç": "c",
    "à": "a", "É": "E", "ñ": "n", "å": "a", "Ú": "U", "â": "a", "Å": "A", "ö": "o", "Î": "I",
}

# ---- fixed values: body of the character class that titles may contain ----
ALLOWED_CHARS = r"a-zA-Z0-9 ,°!?@#$%&:;+~_/\-\"\'\^\*\(\)\.\[\]"

# ---- fixed values: texts that stand for a missing value ----
SENTINELS = (r"\N", "NULL", "", "nan", "NaN")

# ---- fixed values: genre names with a column of their own ----
GENRES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family", "Fantasy",
    "History", "Horror", "Music", "Mystery", "Romance", "Science Fiction", "Thriller", "TV Movie", "War",
    "Western",
)

# ---- fixed values: document fields kept as they are ----
BASIC_FIELDS = (
    "imdb_id", "original_language", "popularity", "revenue", "runtime", "vote_average", "vote_count",
)

# ---- fixed values: defaults and bounds ----
DEFAULT_REGION = "World"
LAST_VALID_YEAR = 2022
DISCOUNT_RATE = 0.8
SERIES_PER_BATCH = 4
NEIGHBOURS = 5
