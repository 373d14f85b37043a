"""Values that results depend on.  All of them are fixed values."""

# Texts that stand for "missing" after trimming and upper-casing.
NOISE = ["NAN", "NONE", "", "-", "NIL", "N/A", "NULL", "UNKNOWN"]

# Fixed value: label of an absent mark, grade, buyer or broker.
PLACEHOLDER = "N/A (Pending)"

# Data types of an input file.
OFFER, SALE, SUMMARY, COMMENTARY = "OFFER", "SALE", "SUMMARY", "COMMENTARY"

# Header spellings accepted for each lot column, compared trimmed and upper-cased.
LOT_ALIASES = {
    "broker": ["Broker"],
    "mark": ["Selling Mark", "Garden", "Mark", "Estate", "Factory", "Selling Mark - MF Mark"],
    "grade": ["Grade"],
    "lot_number": ["LotNo", "Lot No", "Lot", "Lot.No"],
    "invoice_number": ["Invoice", "Inv.No", "Invoice No"],
    "quantity_kgs": ["Net Weight", "Kilos", "Kgs", "Quantity (Kg)", "Total Weight", "Net Kgs", "Weight"],
    "package_count": ["Bags", "Pkgs", "Packages", "Package", "Pks", "No of Pkgs", "Units", "Count"],
    "price": ["Purchased Price", "Final Price", "Price", "Price (USD)", "Price (USc)"],
    "valuation_or_rp": ["Valuation", "Asking Price", "RP"],
    "buyer": ["Buyer", "Buyer Name", "Final Buyer"],
    "sale_date_internal": ["Selling End Time", "Sale Date"],
    "sale_number_internal": ["Sale Code", "Auction"],
}

# Words that give a header row away.
HEADER_KEYWORDS = [
    "LotNo", "Garden", "Grade", "Invoice", "Pkgs", "Kilos", "RP", "Valuation", "Price", "Buyer", "Mark", "Lot",
    "Broker", "Weight", "Bags",
]

# How far down a header is searched and how many keyword hits it needs.
HEADER_SEARCH_ROWS = 15
HEADER_MIN_HITS = 4

# Cell texts a delimited reader takes for a missing cell.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Colours of a rising and of a falling price.
RISE_COLOUR, FALL_COLOUR = "#34a853", "#ea4335"

# Sentences of the weekly report.
AWAITING_RESULTS = "Awaiting sales results. Offers published."
NO_CURRENT_DATA = "Awaiting current week data or missing key columns for trend analysis."
FIRST_SALE = "First sale recorded; no historical data for comparison."
NO_COMMON_ITEMS = "No common items sold between this week and the previous week for comparison."
STABLE_PRICES = "Prices across most compared gardens and grades remained relatively stable week-over-week."
RISERS_HEADING = "Notable price increases week-over-week (min 500kg):"
FALLERS_HEADING = "Significant price declines week-over-week (min 500kg):"
AWAITING_CATALOGUES = "Awaiting Catalogues"
WEATHER = (
    "Seasonal weather patterns are prevailing in the key growing regions supplying {location}. "
    "Production levels are reported as stable."
)
PREDICTION = (
    "Based on current demand trends, the market is expected to remain active. Buyers are advised to monitor global "
    "economic indicators and currency fluctuations which may impact pricing in the coming weeks."
)

# Limits of the ranked lists.
TOP_BUYERS = 15
TOP_MOVERS = 3
MIN_MOVER_KGS = 500
TOP_IMPORTERS = 10
NEWEST_ARTICLES = 500
SESSION_ARTICLES = 200
MAX_BINS = 50

# What file names and sale codes tell of a sale.
NUMBERED_FILE = r"(?i)Sale_No_(\d+)_"
NUMBERED_FILE_DAY = r"(?i)(\d{1,2}(st|nd|rd|th)?_.*?_\d{4})"
BRACKETED_FILE = r"(?i)Sale\s*(\d+)\s*\((.*?)\)"
REPORT_FILE = r"(?i)GeneralReport\s*\((\d+)\)"
SALE_CODE = r"(?i)Sale\s*(\d+)"

# What gives an advertisement away, and the type names of structured data.
SPONSORED = r"(?i)sponsored|advertisement|AD\s*\|"
PARTNER_NOTE = "In partnership with"
LIST_TYPE, ARTICLE_TYPE = "ItemList", "Article"

# Phrases of the one-sentence summary, with the change in percent above which the first ones hold, the
# change below which the next ones hold, and the sell-through rate from which the last ones hold.
PRICES_UP = [(1.5, "Prices significantly higher"), (0.5, "Prices firm to dearer")]
PRICES_DOWN = [(-1.5, "Prices significantly lower"), (-0.5, "Prices easier")]
PRICES_STEADY = "Prices generally steady"
DEMAND_ABOVE = (0.95, "Excellent absorption.")
DEMAND_FROM = [(0.85, "Good general demand."), (0.75, "Fair demand; selective buying.")]
DEMAND_LOW = "Low demand; significant withdrawals."

# Wording of a mover, and the viewer page with the folder it reads from.
ROSE, FELL, FROM, TO = ") rose by ", ") decreased by ", "% (from $", " to $"
VIEWER_PAGE, REPORT_FOLDER = "report_viewer.html", "report_data"
