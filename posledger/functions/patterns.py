"""Patterns and word lists of the filing texts. Data only."""

# --- fixed values: html to text, applied in this order ---
HTML_STEPS = (
    (r"(?is)<script[^>]*>.*?</script>", " "),
    (r"(?is)<style[^>]*>.*?</style>", " "),
    (r"(?i)<br\s*/?>", "\n"),
    (r"(?i)</p>", "\n"),
    (r"<[^>]+>", " "),
    (r"&nbsp;", " "),
    (r"&#\d+;", " "),
    (r"\s+", " "),
)
#: What a lower-cased page must have for a step to find anything.
HTML_MARKS = {
    r"(?is)<script[^>]*>.*?</script>": "<script", r"(?is)<style[^>]*>.*?</style>": "<style", r"(?i)<br\s*/?>": "<br",
    r"&nbsp;": "&nbsp;", r"&#\d+;": "&#",
}

# --- fixed values: inventory-method keywords ---
INVENTORY_KEYWORDS = (
    "lifo", "fifo", "last-in, first-out", "last-in, first out", "first-in, first-out",
    "costing method", "inventory accounting", "inventories are stated", "inventory is stated",
    "weighted-average", "weighted average cost", "international financial reporting standards",
    "u.s. generally accepted accounting principles", "ifrs", "u.s. gaap", "inventory", "inventories",
)
INVENTORY_PRIORITY_KEYWORDS = (
    "lifo", "fifo", "last-in, first-out", "last-in, first out", "first-in, first-out",
    "lifo reserve", "costing method", "inventory accounting",
    "international financial reporting standards", "ifrs", "u.s. gaap",
)

# --- fixed values: ownership disclosures ---
OWNERSHIP_PATTERNS = (
    r"newly issued \d+(?:\.\d+)?%\s+equity interest",
    r"we held\s+\d+(?:\.\d+)?%",
    r"held approximately\s+\d+(?:\.\d+)?%",
    r"ownership interest of approximately\s+\d+(?:\.\d+)?%",
    r"equity interest \(on a fully diluted basis\)",
)
OWNERSHIP_FALLBACK_PATTERNS = (r"investments in equity method", r"equity method investees")

# --- fixed values: ownership filings ---
COVER_NAME = r"(?i)([A-Za-z0-9][A-Za-z0-9 .,&'\-]{1,120}?)\s*\(\s*Name of Issuer\s*\)"
COVER_CUSIP = r"(?i)\b([0-9A-Z]{9})\s*\(\s*CUSIP"
COVER_PERCENT = (
    r"(?i)Percent of Class Represented by Amount in Row\s*\(\s*\d+\s*\)\s*:?\s*(\d+(?:\.\d+)?)\s*%"
)
COVER_PERCENT_LOOSE = r"(?i)Percent of Class Represented[^0-9%]{0,80}:?\s*(\d+(?:\.\d+)?)\s*%"
COVER_AMOUNT = r"(?i)Aggregate Amount Beneficially Owned by Each Reporting Person[^0-9]{0,40}([\d,]+)"
COVER_VOTING = r"(?i)Sole Voting Power[^0-9]{0,40}([\d,]{4,})"
COVER_SYMBOL = r"Trading Symbol[^A-Z]{0,20}([A-Z]{1,6})\b"
DISPOSAL = r"(?i)no longer owns?\s+any|are no longer beneficial owners?"
ITEM_FIVE_CHECKED = (
    r"(?is)ceased to be the beneficial owner of more than five percent"
    r"[^☒\[\]xX]{0,120}(?:☒|\[[\sxX]\])"
)
XML_ISSUER = ("issuerName", "nameOfIssuer")
XML_CUSIP = ("issuerCusipNumber", "cusip")
XML_PERCENT = ("classPercent", "percentOfClass")
XML_SYMBOL = ("issuerTradingSymbol", "tradingSymbol")
XML_SHARES = ("sharesBeneficiallyOwned", "aggregateAmountOwned")

# --- fixed values: investments tables ---
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")
_MONTH = "(" + "|".join(MONTHS) + ")"
TWO_DATES = (
    r"(?i)(?:As\s+of\s+)?" + _MONTH + r"\s+(\d{1,2}),\s+(\d{4})\s+" + _MONTH + r"\s+(\d{1,2}),\s+(\d{4})"
)
INVESTMENT_NAMES = (
    ("didi", "DIDIY"), ("grab", "GRAB"), ("aurora", "AUR"), ("delivery hero", "DHER.DE"),
    ("recursion", "RXRX"),
)
INVESTMENT_TABLE_HINT = r"(?i)Non-marketable equity securities|Investments\b|equity securities"

# --- fixed values: investment notes ---
INVESTMENT_IN = (
    r"(?i)Investment\s+in\s+([A-Za-z0-9][A-Za-z0-9 .,&'\-]{1,120}?)\s*\([“\"']([^”\"']+)[”\"']\)"
)
PERCENT_EQUITY = r"(?i)approximately\s+(\d+(?:\.\d+)?)\s*%\s+equity\s+interest"
USD_BILLION = r"(?is)(?:invested|investment).*?US\s*\$\s*(\d+(?:\.\d+)?)\s*billion"
USD_MILLION = r"(?is)(?:invested|investment).*?US\s*\$\s*(\d+(?:\.\d+)?)\s*million"
NEWLY_ISSUED = (
    r"(?is)newly\s+issued\s+(\d+(?:\.\d+)?)\s*%\s+equity\s+interest[^.]{0,120}?(Ant\s+Group[^.;,]{0,40})"
)
WE_HELD = r"(?is)we\s+held\s+(\d+(?:\.\d+)?)\s*%[^.]{0,120}?Ant\s+Group"
HELD_NAME = "Ant Group Co., Ltd."

# --- fixed values: annual-report aggregates ---
ANNUAL_BREAKDOWN = (
    r"(?is)Investments in associates\s*[–\-]?\s*Listed entities\s+([\d,]+)\s+[\d,]+"
    r".{0,60}?Unlisted entities\s+([\d,]+)"
)
ANNUAL_BREAKDOWN_LOOSE = (
    r"(?is)(?<!\()\bListed entities\s+([\d,]+)\s+([\d,]+)\s*[–\-]?\s*Unlisted entities\s+([\d,]+)\s+([\d,]+)"
)
ANNUAL_LISTED_VALUE = (
    r"(?is)fair value of (?:our )?shareholdings\s*\d*\s*in listed investee "
    r"companies[^0-9]{0,160}RMB\s*([\d.]+)\s*billion"
)
ANNUAL_UNLISTED_VALUE = (
    r"(?is)carrying book value of (?:our )?shareholdings\s+in unlisted\s+"
    r"investee companies[^0-9]{0,160}RMB\s*([\d.]+)\s*billion"
)

# --- fixed values: broker stake tables ---
_EXCHANGE = r"(?:\s+(?:US|HK|KS|JP|CH|LN|SS|SZ))?"
STAKE_ROW = (
    r"^(.+?)\s+((?:\d{3,6}|[A-Z][A-Z0-9.]{0,9})" + _EXCHANGE + r")\s+(\d+(?:\.\d+)?)\s+([\d,]+)\s+([\d,]+)\s*$"
)
STAKE_INLINE = (
    r"((?:[A-Z][\w&.'/-]+(?:\s+[A-Z][\w&.'/-]+){0,6}|Meituan|JD\.com Inc))"
    r"\s+((?:\d{3,6}|[A-Z][A-Z0-9.]{0,9})" + _EXCHANGE + r")\s+(\d+(?:\.\d+)?)\s+([\d,]+)\s+([\d,]+)"
)
STAKE_STOPS = (
    "listed investments", "unlisted investments", "total investment", "holdco discount",
    "valuation of strategic", "other listed entities", "source:", "note:", "figure ",
)
STAKE_NAMES = (
    ("meituan", "3690.HK"), ("jd.com inc", "JD"), ("jd.com", "JD"), ("kuaishou technology", "1024.HK"),
    ("pdd holdings inc", "PDD"), ("sea ltd", "SE"), ("spotify technology sa", "SPOT"),
    ("futu holdings ltd", "FUTU"), ("ke holdings inc", "BEKE"), ("reddit inc", "RDDT"),
    ("snap inc", "SNAP"), ("bilibili inc", "BILI"), ("vipshop holdings ltd", "VIPS"),
    ("kanzhun ltd", "BZ"), ("warner music group corp", "WMG"),
    ("tongcheng travel holdings ltd", "0780.HK"), ("yixin group ltd", "2858.HK"),
    ("j&t global express ltd", "1519.HK"), ("xtalpi holdings ltd", "2228.HK"),
    ("tuhu car inc", "9690.HK"), ("krafton inc", "259960.KS"), ("netmarble corp", "251270.KS"),
    ("kadokawa corp", "9468.T"), ("zhejiang century huatong group", "002602.SZ"),
)

# --- fixed values: index reconstitution lists ---
INDUSTRIES = (
    "Health Care", "Technology", "Industrials", "Consumer Discretionary", "Consumer Staples",
    "Basic Materials", "Utilities", "Financials", "Energy", "Real Estate", "Telecommunications",
)
RECONSTITUTION_ROW = (
    r"(?m)^\s*([A-Z0-9][A-Z0-9 .,()&'/-]*?)\s{2,}([A-Z]{1,6})\s{2,}(" + "|".join(INDUSTRIES) + r")\s*$"
)

# --- fixed values: report period of a filing header ---
REPORT_PERIOD = r"(?is)<(?:\w+:)?(?:periodOfReport|reportCalendarOrQuarter)[^>]*>\s*([^<]+?)\s*<"
