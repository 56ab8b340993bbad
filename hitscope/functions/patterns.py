"""Fixed values.

Everything in this module must equal the behaviour of the original access-log
jobs for results to match: request and page patterns, host patterns, the log's
timestamp layout, the session gap, the labels written into the insight
tables and the cipher settings of the host pseudonym.  The patterns are
written in a linear form (no alternation nested inside a star) so that the
JVM regex engine cannot overflow its stack on long URLs; they accept exactly
the same strings as the original nested forms.
"""

# --- fixed values: patterns -------------------------------------------------
# A well-formed request line ("METHOD /path[ PROTO/x.y]").
REQUEST_PATTERN = (
    r"^[A-Z]* (?:/[a-zA-Z0-9\-._?/+%~:]*|\.[a-z0-9]*)?"
    r"( [A-Z0-9]+/[0-9a-zA-Z|]+\.[0-9a-zA-Z|])?$"
)
# R2: a page (as opposed to an image or other resource) request URL.
PAGE_PATTERN = r"^/[a-zA-Z0-9/_|\-]*.?(?:html?|\?|[0-9]*,[0-9]*)?$"
# A dotted numeric IPv4 host.
NUMERIC_HOST_PATTERN = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+$"
# A lower-case host name with at least one dot.
HOST_NAME_PATTERN = r"^[a-z0-9\-_.]*\.[a-z]*$"

# --- fixed values: formats and constants ------------------------------------
TIMESTAMP_FORMAT = "dd/MMM/yyyy:HH:mm:ss"
TIMESTAMP_WITH_OFFSET_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"
SESSION_GAP_SECONDS = 30 * 60
DURATION_GAP_SECONDS = 30 * 60
UNKNOWN_SUFFIX_COUNTRY = "NA"
PAGE_HITS_LABEL = "Page_Hits"
EXIT_RATE_LABEL = "Exit_Rate"
SESSION_ID_SEPARATOR = "_"
CIPHER_MODE = "CBC"
CIPHER_PADDING = "PKCS"
CIPHER_IV_HEX = "00000000000000000000000000000000"
