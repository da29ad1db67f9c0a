"""Lists, constants and patterns that results depend on. Data only."""

# --- fixed values: texts that mean "missing" ---
MISSING_TEXTS = ("nan", "none", "null", "<na>")

# --- fixed values: company suffixes that are not a name on their own ---
BARE_COMPANY_SUFFIXES = ("inc.", "inc", "ltd.", "ltd", "limited")

# --- fixed values: cover-page text in front of an issuer name ---
COVER_PAGE_PREFIX = (
    r"(?is)^(?:.*?(?:securities exchange act of 1934|schedule 13[dg](?:/a)?|"
    r"s and exchange commission(?:.*?20549)?)\s*)+"
)

# --- fixed values: exchange codes used in broker tables ---
EXCHANGE_CODES = ("US", "HK", "KS", "JP", "CH", "LN", "SS", "SZ")

# --- fixed values: public filing archive ---
FILING_INDEX_ROOT = "https://www.sec.gov/Archives/edgar/data/"

# --- fixed values: markers of overlay rows in a note (lower case) ---
OVERLAY_MARKERS = ("source=13g", "20f_note", "10k_note", "10q_note", "ticker=private_note")

# --- fixed values: markers of sources that disclose money ---
DISCLOSED_VALUE_MARKERS = (
    "investments_table", "20f_note", "10k_note", "10q_note", "filing_note",
)

# --- fixed values: aggregate tickers of annual-report portfolios ---
LISTED_INVESTEES = "PRIV_HK_LISTED_INVESTEES_FV"
UNLISTED_INVESTEES = "PRIV_HK_UNLISTED_INVESTEES"
LISTED_ASSOCIATES = "PRIV_HK_LISTED_ASSOCIATES"
UNLISTED_ASSOCIATES = "PRIV_HK_UNLISTED_ASSOCIATES"
AGGREGATE_TICKERS = (
    LISTED_INVESTEES, UNLISTED_INVESTEES, LISTED_ASSOCIATES, UNLISTED_ASSOCIATES,
)
LISTED_AGGREGATE_TICKERS = (LISTED_INVESTEES, LISTED_ASSOCIATES)

# --- fixed values: ownership filing forms ---
OWNERSHIP_FORMS = (
    "SC 13G", "SC 13G/A", "SC 13D", "SC 13D/A",
    "SCHEDULE 13G", "SCHEDULE 13G/A", "SCHEDULE 13D", "SCHEDULE 13D/A",
)

# --- fixed values: names gone from public markets without a closing filing ---
EXIT_CUTOFFS = (("GLUU", "2021-04-29"), ("FTCH", "2024-01-30"))

# --- fixed values: security id -> ticker seeds ---
CUSIP_TICKERS = (("98422D105", "XPEV"), ("948596101", "WB"))

# --- fixed values: parent aliases ---
PARENT_ALIASES = (
    ("tencent", "TCEHY"), ("tencent holdings", "TCEHY"), ("tctzf", "TCEHY"),
    ("0700", "TCEHY"), ("0700.hk", "TCEHY"), ("alibaba", "BABA"), ("alibaba group", "BABA"),
    ("berkshire", "BRK-B"), ("berkshire hathaway", "BRK-B"), ("brk.b", "BRK-B"),
    ("brkb", "BRK-B"), ("uber", "UBER"), ("uber technologies", "UBER"),
)
AGGREGATE_PARENTS = ("TCEHY", "TCTZF")
PARENT_CIKS = (
    ("TCEHY", "0001293451"), ("TCTZF", "0001293451"),
    ("UBER", "0001543151"), ("BABA", "0001577552"),
)
PARENT_NAME_HINTS = (
    ("UBER", "uber technologies"), ("BRK-B", "berkshire hathaway"), ("BABA", "alibaba"),
)

# --- fixed values: issuer-name hints, in match order ("" = private company) ---
ISSUER_HINTS = (
    ("kanzhun", "BZ"), ("ke holdings", "BEKE"), ("reddit", "RDDT"), ("cango", "CANG"),
    ("horizon quantum", "HQ"), ("horizon quantum holdings", "HQ"), ("pinduoduo", "PDD"),
    ("pdd holdings", "PDD"), ("sea limited", "SE"), ("spotify", "SPOT"),
    ("meituan", "3690.HK"), ("vipshop", "VIPS"), ("nio", "NIO"), ("bilibili", "BILI"),
    ("tencent music", "TME"), ("huya", "HUYA"), ("cheetah", "CMCM"), ("global blue", "GB"),
    ("cheche", "CCG"), ("didi", "DIDIY"), ("didi global", "DIDIY"),
    ("aurora innovation", "AUR"), ("grab holdings", "GRAB"), ("lucid group", "LCID"),
    ("weride", "WRD"), ("serve robotics", "SERV"), ("neutron holdings", ""),
    ("xpeng", "XPEV"), ("perfect corp", "PERF"), ("baozun", "BZUN"), ("momo", "MOMO"),
    ("hello group", "MOMO"), ("groupon", "GRPN"), ("smart share", "EM"), ("mariadb", "MRDB"),
    ("best inc", "BEST"), ("joby aviation", "JOBY"), ("marqeta", "MQ"), ("rivian", "RIVN"),
    ("jd.com", "JD"), ("jd com", "JD"), ("tuya", "TUYA"), ("waterdrop", "WDH"),
    ("douyu", "DOYU"), ("lilium", "LILM"), ("zhihu", "ZH"), ("zenvia", "ZENV"),
    ("missfresh", "MF"), ("farfetch", "FTCH"), ("qutoutiao", "QTT"),
    ("th international", "THCH"), ("mogu", "MOGU"), ("zkh", "ZKH"), ("yxt.com", "YXT"),
    ("yxt.com group", "YXT"), ("nu holdings", "NU"), ("sogou", "SOGO"),
    ("glu mobile", "GLUU"), ("amer sports", "AS"), ("futu", "FUTU"),
    ("futu holdings", "FUTU"), ("warner music", "WMG"), ("warner music group", "WMG"),
)

# --- fixed values: rates and thresholds ---
RMB_PER_USD = 7.1884
HKD_PER_USD_FALLBACK = 7.8

# --- fixed values: provenance notes ---
NOTE_ESTIMATE = (
    "estimated; period-end price proxy (not tax/GAAP); "
    "mtm primary; avg-cost disposal primary; fifo=sensitivity"
)
NOTE_RECONCILIATION = (
    "reconciliation only — residual expected (Ant, private marks, equity-method, FX, "
    "interest income); fiscal Mar-31 vs calendar 13F; not an equality claim"
)
NOTE_FILING_MARK = "value_estimate=eod_at_filing; not_fv_allocation; excluded_from_portfolio_mv"
NOTE_COMPOSITION = "composition=13g_overlay; not_fv_allocation"
NOTE_RESIDUAL = (
    "residual_of_aggregate; excluded_from_portfolio_mv; "
    "parent_aggregate_market_value_usd is Note 22 SoT — not a child mark"
)
