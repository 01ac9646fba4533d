"""These must equal the original jobs' settings and formats for the
results to match. Every function takes them as overridable defaults."""

# --- fixed values (from the original jobs) ---------------------------------------
TOP_CATEGORIES = 10                 # categories kept by the category ranking
TOP_SESSIONS = 10                   # sessions kept per top category
TOP_ADS = 3                         # ads kept per (day, area)
BLACKLIST_THRESHOLD = 100           # clicks per (user, ad) that block a user
MICRO_BATCH = "5 seconds"           # streaming trigger interval
TREND_WINDOW = "60 seconds"         # click-trend window length
TREND_SLIDE = "10 seconds"          # click-trend window step
TREND_BUCKET_MS = 10_000            # click-trend bucket width, epoch milliseconds
TREND_KEEP = 6                      # buckets kept per trend window, earliest first
TREND_LABEL = "mm:ss"               # bucket label format in trend documents
DAY_FORMAT = "yyyy-MM-dd"           # day of an ad click and of an action
LINE_SEPARATOR = " "                # fields of an ad-click line: ts area city userid adid
ID_LIST_SEPARATOR = ","             # order / payment id lists, target page flow
FLOW_SEPARATOR = "-"                # "x-y" page jump labels
NOT_A_CLICK = -1                    # click category / product of a non-click action
