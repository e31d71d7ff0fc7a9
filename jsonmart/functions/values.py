"""Names, formats and limits that results depend on."""

# Object key layout: <root>/<resource>/ingest_date=<date>/run_id=<id>/<name>.json
KEY_ROOT = "tmdb"
JSON_SUFFIX = ".json"
MANIFEST_NAME = "manifest.json"

# A run id keeps letters, digits, '.', '_' and '-', and at most 200 characters.
RUN_ID_UNSAFE = "[^A-Za-z0-9._-]+"
RUN_ID_LENGTH = 200

# Resources whose documents become payload rows.
ENTITY_RESOURCES = ("movie", "credits", "keywords", "person")
LISTING_RESOURCES = ("movie_popular", "movie_top_rated")
PAYLOAD_RESOURCES = ("genre", *LISTING_RESOURCES, *ENTITY_RESOURCES)

# Crawl limits.
LISTING_PAGES = 5
PEOPLE_CAP = 200

# Report limits.
MIN_VOTES = 500
TOP_TITLES = 20
TOP_PEOPLE = 25
TOP_CAST_POSITIONS = 3

# Decimal type standing in for an unbounded numeric.
NUMERIC = "decimal(28,10)"

# Parquet codec of written tables: as fast as the default on JSON text, at half the size.
COMPRESSION = "zstd"
