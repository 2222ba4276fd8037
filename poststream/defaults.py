"""Default parameters of the job-post workload.

Fixed values: these must stay as written so results equal the original
application's behaviour.
"""

# Posting keywords (plain lower-case substrings of title + body).
JOB_KEYWORDS = [
    "hire", "hiring", "for hire", "job opening",
    "position available", "looking for", "contract",
    "freelance",
]

# Sources polled by the ingest loop, in polling order.
JOB_SOURCES = ["techjobs", "programmingjobs", "sysadminjobs", "devopsjobs", "webdevjobs"]

# Age limit in days (documented as "a year", the constant is 356).
DAYS_BACK = 356

# Posts fetched per source on the first run and on later runs.
FIRST_RUN_LIMIT = 2000
LATER_RUN_LIMIT = 50

# Characters kept from the body and shown from the title.
BODY_CHARS = 5000
TITLE_PREVIEW_CHARS = 60

# Transport tag, its record suffix, topic and flush cadence.
TAG_PREFIX = "reddit.jobs"
TAG_SUFFIX = "post"
TOPIC = "redditjob"
FLUSH_EVERY = "5 seconds"
POLL_SECONDS = 60

# The category used when a post has no skill at all.
NO_SKILL_CATEGORY = "other"

# Classifier settings (hashing width, grid, folds, split).
NUM_FEATURES = 20000
GRID_MAX_ITER = [50, 100]
GRID_REG_PARAM = [0.01, 0.1]
BEST_MAX_ITER, BEST_REG_PARAM = 50, 0.01      # best point of the grid search
NUM_FOLDS = 3
TRAIN_PARTS, SPLIT_PARTS = 8, 10

# Dashboard panel sizes.
CATEGORY_PIE_SIZE = 8          # pie of categories, with rest bucket
SKILL_CLOUD_SIZE = 30          # tag cloud of skills, with rest bucket
TREEMAP_SIZES = (7, 20)        # categories x skills, rest buckets at both levels
BARS_SIZES = (7, 30)           # stacked bars categories x skills

# The rest bucket label.
OTHER_BUCKET = "__other__"

# Strings that pandas' CSV reader turns into missing values by
# default (pandas 2.x), so a lexicon loaded from CSV drops them.
CSV_MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
