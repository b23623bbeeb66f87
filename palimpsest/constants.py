"""Fixed values. These must equal the behaviour being rebuilt; do not tune them."""

# --- fixed values -----------------------------------------------------------
# Edit distance above which a change counts as significant.
SIGNIFICANCE_THRESHOLD = 50
# Length-difference rule for paragraph noise (F12): below this difference a
# paragraph counts only when distance > difference + this margin.
LEVCHAR_LENGTH_LIMIT = 10
LEVCHAR_MARGIN = 10
# Paragraph noise (F4): drop paragraphs of length <= 1 or containing these.
NOISE_MARKERS = ["]>", "Previous page", "Next page"]
# Phrases that mark a withdrawn page.
WITHHELD_PHRASES = [
    "content has been withheld because of exemptions in the Freedom of Information Act",
    "Page Archived",
]
# Published markup: links to a document's pages, the change summary, a link's label.
CHAPTER_FOLDER = "chapters/"
VIEW_LINK = ('<a href="', '" target="_blank">View</a>')
DOWNLOAD_LINK = ('<a href="', '" target="_blank">Download</a>')
CHANGE_INFO = "Lev Distance: %d<br />CharCountDiff: %d<br />Changed paras: %d out of %d"
CLICK_TO_VIEW = "Click to view"
# Placeholders used when a field is missing.
NOT_FOUND = "not found"
NOT_AVAILABLE = "NA"
# Report date formats.
REPORT_DATE_FORMAT = "dd-MM-yyyy"
VERSION_DATE_FORMAT = "yyyyMMdd"
FEED_DATE_FORMAT = "d MMMM yyyy"
METRICS_DATE_FORMAT = "yyyy-MM-dd"
# --- end of fixed values ----------------------------------------------------

# Engine parameters (not reference values).
# Largest list (by the size of its files) that may be broadcast; bigger ones are joined as the run decides.
DIMENSION_BROADCAST_MAX_BYTES = 10 << 20
