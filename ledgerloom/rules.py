"""Business values of the onboarding flow. Every one can be overridden by an argument."""

from __future__ import annotations

from datetime import date

# ---- Fixed values -----------------------------------------------------------
# These decide which rows are accepted and what is written, so they are stated
# here plainly and used nowhere else as literals.

#: Source header -> name used after ingest.
SOURCE_COLUMNS = {
    "name": "name",
    "email": "email",
    "date_of_birth": "birthday",
    "mobile_no": "mobile",
}

#: Age is taken on this day.
REFERENCE_DATE = date(2022, 1, 1)

#: An applicant must be strictly older than this.
AGE_LIMIT = 18

#: Accepted birthday layouts, tried in this order (Spark date patterns).
BIRTHDAY_LAYOUTS = ("yyyy-MM-dd", "yyyy/MM/dd", "MM/dd/yyyy", "dd-MM-yyyy")

#: Layout of the birthday in outputs and in the hash input.
BIRTHDAY_OUT = "yyyyMMdd"

#: An e-mail is accepted when it ends with one of these.
EMAIL_SUFFIXES = (".com", ".net")

#: The literal reading of the same rule; pass it as ``email_suffixes`` to use it.
EMAIL_SUFFIXES_STRICT = ("@emailprovider.com", "@emailprovider.net")

#: Digits in a mobile number.
MOBILE_DIGITS = 8

#: Hex characters of the birthday hash kept in a membership id.
HASH_CHARS = 5

#: Leading titles dropped from a name (lower case, no trailing dot).
SALUTATIONS = ("mr", "mrs", "ms", "miss", "mx", "dr", "prof", "rev", "sir", "madam")

#: Trailing post-nominals dropped from a name (lower case, no trailing dot).
POST_NOMINALS = (
    "jr", "sr", "ii", "iii", "iv", "v", "md", "dds", "dvm", "phd", "esq", "do", "rn",
)

#: Rejection codes, in the order they are reported.
MISSING_NAME = "missing_name"
UNPARSEABLE_BIRTHDAY = "unparseable_birthday"
UNDER_18 = "under_18"
INVALID_MOBILE = "invalid_mobile"
INVALID_EMAIL = "invalid_email"
REASON_SEPARATOR = ";"

#: Run stamp in output folders and file names.
RUN_STAMP = "%Y%m%d_%H%M%S"

#: Batch files.
BATCH_GLOB = "*.csv"

#: Rows of the accepted output that seed the member table.
MEMBER_SEED_ROWS = 50

#: Days an image and its per-image metadata may be kept.
RETENTION_DAYS = 7

#: Failed attempts after which an image goes to the dead-letter output.
MAX_ATTEMPTS = 3

#: Unicode White_Space characters.
WHITESPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
