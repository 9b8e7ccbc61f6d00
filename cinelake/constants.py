"""Fixed values. Results depend on them, so they are stated plainly and in one place."""

# Columns removed and fills applied when the raw catalogue is cleaned.
UNUSED_COLUMNS = ("backdrop_path", "spoken_languages", "poster_path")
FILLS = {
    "budget": 0,
    "revenue": 0,
    "adult": "FALSE",
    "original_language": "en",
    "overview": "nan",
    "original_title": "nan",
    "production_companies": "nan",
    "production_countries": "nan",
    "keywords": "nan",
    "genres": "nan",
}
MISSING_TEXT = "nan"

# The first release year that is loaded.
FIRST_YEAR = 1920

# Number of hashed tag slots and the weight of each numeric feature, in vector order.
TAG_SLOTS = 20
FEATURE_WEIGHTS = {
    "popularity": 1.0,
    "release_year": 0.5,
    "vote_average": 1.2,
    "vote_count": 0.8,
}

# Fields kept from an API page, in output order.
PAGE_FIELDS = (
    "adult", "genre_ids", "id", "overview", "popularity",
    "release_date", "title", "vote_average", "vote_count",
)

# Lowest and highest whole rating that gets its own label; length of the ranking.
RATING_FLOOR_RANGE = (0, 9)
UNKNOWN_RATING = "unknown"
TOP_FILMS = 100
