"""Fixed values that decide results.

Everything here is data, not logic: limits, label vocabularies, cue words and
seed lists whose exact text must be kept for outputs to be comparable.
"""

# --- fixed values: limits -------------------------------------------------
ITEMS_PER_FEED = 3
DISCOVERY_BUDGET = 20
CONTENT_MAX_CHARS = 8000
CONTENT_MIN_CHARS = 200
LANGUAGE_SAMPLE_CHARS = 500
ADS_PER_TERM = 5
ADS_PER_PAGE = 5
AD_MIN_CHARS = 50
AD_NODE_MIN_CHARS = 20
HEADLINE_CHARS = 200
CLAIM_LIMIT = 80
COST_PER_SCAN = 0.006

# --- fixed values: version stamps ----------------------------------------
ANALYZER_VERSION = "vnext_haiku_2026_03"
TAXONOMY_VERSION = "v1.0"
PROMPT_VERSION = "crawler_v1.0"
LEGACY_VERSION = "1.0"

# --- fixed values: language cues (language, cues, cues needed), by precedence
LANGUAGE_CUES = (
    ("ar", ("ال", "من", "إلى"), 2),
    ("af", ("die ", "van ", "het ", "wat ", "nie ", "dat ", "met ", "vir "), 3),
    ("fr", (" les ", " des ", " une ", " que ", " est ", " par "), 3),
)
DEFAULT_LANGUAGE = "en"

# --- fixed values: severity weights --------------------------------------
SEVERITY_WEIGHT = {"critical": 3, "warning": 2, "note": 1}
DEFAULT_WEIGHT = 1

# --- fixed values: credibility vocabulary --------------------------------
BIAS_LABELS = (
    "Left", "Left-Center", "Least Biased", "Right-Center", "Right",
    "Extreme Right", "Extreme Left", "Conspiracy-Pseudoscience",
    "Pro-Science", "Satire",
)
FACTUALITY_LABELS = (
    "Very High", "High", "Mostly Factual", "Mixed", "Low", "Very Low", "N/A",
)
DISPUTED_BIAS = ("Conspiracy-Pseudoscience", "Extreme Right", "Extreme Left")
LOW_FACTUALITY = ("Very Low", "Low")
HIGH_FACTUALITY = ("Very High", "High")
CREDIBILITY_TIERS = ("HIGH", "MIXED", "LOW", "DISPUTED")

# --- fixed values: enumerations ------------------------------------------
SCAN_STATUSES = ("success", "skipped", "feed_error", "analysis_error")
QUEUE_STATUSES = ("pending", "processing", "done", "error")
SEVERITIES = ("critical", "warning", "note")

# --- fixed values: pattern id prefixes -----------------------------------
PATTERN_PREFIXES = ("F", "M", "B", "R", "S", "P", "A", "C", "I", "O")

# --- fixed values: discovery themes (theme, any of these phrases, required word)
THEMES = (
    ("Manipulation", ("manipulation", "propaganda", "disinformation"), None),
    ("Disinfo", ("conspiracy", "misinformation", "fake news"), None),
    ("Election", ("election", "voter fraud", "stolen election"), None),
    ("Health Disinfo", ("vaccine", "COVID", "pandemic"), "misinformation"),
)

# --- fixed values: ad search terms (term, category), each run per country --
AD_COUNTRIES = ("US", "GB")
AD_TERMS = (
    ("weight loss supplement", "health_commercial"),
    ("financial freedom", "self_improvement"),
    ("work from home", "self_improvement"),
    ("debt relief", "financial_services"),
    ("make money online", "self_improvement"),
    ("limited time offer", "ecommerce"),
    ("anti-aging", "health_commercial"),
    ("donate now", "charity"),
    ("apply now university", "higher_education"),
    ("investment opportunity", "financial_services"),
    ("natural cure", "health_commercial"),
    ("join our team", "recruitment"),
    ("exclusive membership", "self_improvement"),
    ("last chance", "ecommerce"),
)

# --- fixed values: feeds (url, name, domain, country, media class, topic class)
FEEDS = (
    ("https://feeds.24.com/articles/news24/TopStories/rss", "News24", "news24.com", "ZA", "Mainstream", "General"),
    ("https://www.dailymaverick.co.za/dmrss", "Daily Maverick", "dailymaverick.co.za", "ZA", "Mainstream", "General"),
    ("https://www.businessinsider.co.za/feed", "BusinessInsider ZA", "businessinsider.co.za", "ZA", "Business", "Finance"),
    ("https://allafrica.com/tools/headlines/rdf/africa/headlines.rdf", "AllAfrica", "allafrica.com", "INTL", "Mainstream", "General"),
    ("https://feeds.theguardian.com/theguardian/world/rss", "The Guardian", "theguardian.com", "GB", "Broadsheet", "General"),
    ("https://www.telegraph.co.uk/rss.xml", "The Telegraph", "telegraph.co.uk", "GB", "Broadsheet", "General"),
    ("https://www.dailymail.co.uk/articles.rss", "Daily Mail", "dailymail.co.uk", "GB", "Tabloid", "General"),
    ("https://rss.nytimes.com/services/xml/rss/nyt/World.xml", "NYT World", "nytimes.com", "US", "Broadsheet", "General"),
    ("https://feeds.washingtonpost.com/rss/world", "Washington Post", "washingtonpost.com", "US", "Broadsheet", "General"),
    ("https://moxie.foxnews.com/google-publisher/latest.xml", "Fox News", "foxnews.com", "US", "Cable News", "Politics"),
    ("https://www.breitbart.com/feed", "Breitbart", "breitbart.com", "US", "Far Right", "Politics"),
    ("https://www.rt.com/rss/", "RT", "rt.com", "RU", "State Media", "General"),
    ("https://www.globaltimes.cn/rss/outbrain.xml", "Global Times", "globaltimes.cn", "CN", "State Media", "General"),
    ("https://www.aljazeera.com/xml/rss/all.xml", "Al Jazeera", "aljazeera.com", "QA", "State Media", "General"),
    ("https://www.voanews.com/api/zqboml-vomx-tpeivmy", "VOA News", "voanews.com", "US", "State Media", "General"),
    ("https://www.naturalnews.com/rss.xml", "Natural News", "naturalnews.com", "US", "Alt Health", "Health"),
    ("https://childrenshealthdefense.org/feed/", "Children's Health Defense", "childrenshealthdefense.org", "US", "Alt Health", "Health"),
    ("https://cms.zerohedge.com/fullrss2.xml", "ZeroHedge", "zerohedge.com", "US", "Alt Finance", "Finance"),
    ("https://rss.dw.com/rdf/rss-en-all", "DW English", "dw.com", "DE", "Broadsheet", "General"),
    ("https://www.france24.com/en/rss", "France24", "france24.com", "FR", "Mainstream", "General"),
)

# --- fixed values: feeds of the older crawler, same columns ----------------
LEGACY_FEEDS = (
    ("https://www.news24.com/rss", "News24", "news24.com", "ZA", "Mainstream", "General"),
    ("https://www.dailymaverick.co.za/feed", "Daily Maverick", "dailymaverick.co.za", "ZA", "Mainstream", "General"),
    ("https://ewn.co.za/RSS", "EWN", "ewn.co.za", "ZA", "Mainstream", "General"),
    ("https://www.businessinsider.co.za/feed", "BusinessInsider ZA", "businessinsider.co.za", "ZA", "Business", "Finance"),
    ("https://www.politicsweb.co.za/rss", "PoliticsWeb", "politicsweb.co.za", "ZA", "Political", "Politics"),
    ("https://allafrica.com/tools/headlines/rdf/africa/headlines.rdf", "AllAfrica", "allafrica.com", "INTL", "Mainstream", "General"),
    ("https://www.theafricareport.com/feed", "Africa Report", "theafricareport.com", "INTL", "Mainstream", "General"),
    ("https://feeds.theguardian.com/theguardian/world/rss", "The Guardian", "theguardian.com", "GB", "Broadsheet", "General"),
    ("https://www.telegraph.co.uk/rss.xml", "The Telegraph", "telegraph.co.uk", "GB", "Broadsheet", "General"),
    ("https://www.dailymail.co.uk/articles.rss", "Daily Mail", "dailymail.co.uk", "GB", "Tabloid", "General"),
    ("https://rss.nytimes.com/services/xml/rss/nyt/World.xml", "NYT World", "nytimes.com", "US", "Broadsheet", "General"),
    ("https://feeds.washingtonpost.com/rss/world", "Washington Post", "washingtonpost.com", "US", "Broadsheet", "General"),
    ("https://moxie.foxnews.com/google-publisher/latest.xml", "Fox News", "foxnews.com", "US", "Cable News", "Politics"),
    ("https://www.breitbart.com/feed", "Breitbart", "breitbart.com", "US", "Far Right", "Politics"),
    ("https://www.rt.com/rss/", "RT", "rt.com", "RU", "State Media", "General"),
    ("https://www.globaltimes.cn/rss/outbrain.xml", "Global Times", "globaltimes.cn", "CN", "State Media", "General"),
    ("https://english.aljazeera.net/xml/rss/all.xml", "Al Jazeera", "aljazeera.com", "QA", "State Media", "General"),
    ("https://www.voanews.com/api/zkyiqkemii", "VOA News", "voanews.com", "US", "State Media", "General"),
    ("https://www.naturalnews.com/rss.xml", "Natural News", "naturalnews.com", "US", "Alt Health", "Health"),
    ("https://childrenshealthdefense.org/feed/", "Children's Health Defense", "childrenshealthdefense.org", "US", "Alt Health", "Health"),
    ("https://www.zerohedge.com/fullrss2.xml", "ZeroHedge", "zerohedge.com", "US", "Alt Finance", "Finance"),
    ("https://www.dw.com/rss/rss/eng-top.xml", "DW English", "dw.com", "DE", "Broadsheet", "General"),
    ("https://rss.france24.com/rss/en/news", "France24", "france24.com", "FR", "Mainstream", "General"),
)

# --- fixed values: audience routing of pattern id ranges (prefix, low, high, audiences)
AUDIENCE_RANGES = (
    ("A", 11, 13, ("data product", "media ratings")),
    ("A", 18, 18, ("data product", "media ratings")),
    ("A", 16, 17, ("consumer",)),
    ("A", 20, 20, ("consumer",)),
    ("A", 14, 15, ("compliance", "procurement")),
    ("A", 19, 19, ("compliance", "procurement")),
    ("C", 1, 25, ("aggregate",)),
    ("C", 3, 4, ("regulatory trigger",)),
    ("C", 6, 6, ("regulatory trigger",)),
    ("C", 9, 10, ("regulatory trigger",)),
    ("C", 14, 14, ("regulatory trigger",)),
    ("C", 21, 22, ("regulatory trigger",)),
    ("I", 1, 15, ("government", "data product", "media ratings")),
    ("O", 1, 7, ("financial services",)),
    ("O", 8, 11, ("procurement",)),
    ("O", 12, 15, ("compliance", "media ratings", "securities regulation")),
)
