"""Rule tables of the models.

FIXED VALUES. Everything in this module must equal the reference's values for right results:
patterns are kept in their original (Postgres ARE) dialect and in their original order; they are
translated to Java regex at use by ``text.pg_regex``. Order matters: every list is first-match-wins.
"""

# ---------------------------------------------------------------------------------------------
# Sessions model: device classes (first test on the raw user agent, the next two on lower())
# ---------------------------------------------------------------------------------------------
DEVICE_RULES = [
    # (label, pattern, apply lower() first)
    ("Desktop", "Windows NT|X11|Macintosh", False),
    ("Mobile", "android|phone|ipad|mobile", True),
    ("Bot", "compatible|crawler|bot|amazon-qbusiness", True),
]

# Internal traffic: referrer host of the company's own client area.
INTERNAL_REFERRER = "korys.cherryservers.com"

# ---------------------------------------------------------------------------------------------
# Sessions model: marketing channel grouping
# ---------------------------------------------------------------------------------------------
PAID_MEDIUM = "cpc|ppc"
PAID_SEARCH_CAMPAIGN = r"^\[S\].+"
PAID_DISPLAY_CAMPAIGN = r"^\[D(G)?\].+"
PAID_VIDEO_CAMPAIGN = r"^\[V\].+"
SOCIAL_MEDIUM = "social|linkedin"
SOCIAL_SOURCE = "linkedin|facebook|social media|twitter"
EMAIL_MEDIUM_SOURCE = "email|newsletter"
AI_SOURCE = ("openai|chatgpt|gpt|gemini|bard|copilot|perplexity|neeva|writesonic|copy\\.ai|astastic|"
             "outrider|nimble|bnngpt|edgeservices|claude|grok")
AI_REFERRER = ("(^|[./])(openai|chatgpt|gpt|gemini|bard|copilot|perplexity|neeva|writesonic|copy\\.ai|"
               "astastic|outrider|nimble|bnngpt|edgeservices|claude|grok)([./]|$)")
ORGANIC_SEARCH_REFERRER = ("(^|[./])(syndicatedsearch.goog|google|bing|yandex|duckduckgo|search\\.brave\\.com|"
                           "startpage\\.com|yahoo|presearch.com|baidu.com|ya.ru|ecosia|qwant|coccoc|kagi.com)"
                           "([./]|$)")
ORGANIC_SOCIAL_REFERRER = "(^|[./])(facebook|linkedin|twitter|t.co|instagram|telegram|skype|reddit)([./]|$)"
ORGANIC_VIDEO_REFERRER = "(^|[./])(youtube|tiktok)([./]|$)"
DIRECT_ACS_REFERRER = "^(acs|acs2|3ds)([./-]|$)"
DIRECT_PAYMENT_REFERRER = ("(^|[./])(accounts.google|sandbox.bvnk.com|stripe.com|translate.goog|cherryservers.com|"
                           "coingate|paypal|paysera|idenfy|3dsecure|cardinalcommerce|wibmo|proxify|"
                           "shareasale-analytics|rsa3dsauth)([./]|$)")

CHANNELS = [
    "Paid Search", "Paid Display", "Paid Video", "Paid Social", "Email", "Paid Other", "AI",
    "Organic Search", "Organic Social", "Organic Video", "Affiliate", "Direct", "Referral", "Not set",
]

# ---------------------------------------------------------------------------------------------
# Lead funnel
# ---------------------------------------------------------------------------------------------
DO_ORDER_TYPES = ["order_complete", "choose_payment", "proceed_to_merchant", "add_to_cart", "proceed_to_cart"]
DO_FORMS = ["custom_server", "gpu_pre_order", "test_server"]
THINK_FORM_PATTERN = "waiting|interest|consultation|contact"
DO_SALE_STATES = ["new_new"]
CARE_SALE_STATES = ["new_old", "renewal"]
CHURN_GRACE_MONTHS = 6

# ---------------------------------------------------------------------------------------------
# ROI
# ---------------------------------------------------------------------------------------------
PAID_INVOICE_STATES = ["paid", "confirm", "invoice"]
ROI_PAID_MEDIUM = "cpc|ppc"
AFFILIATE_CHANNEL = "Affiliate"
ROI_SINCE = "2024-01-01"

# ---------------------------------------------------------------------------------------------
# Price plans: CPU vendor (case-insensitive), first match wins
# ---------------------------------------------------------------------------------------------
VENDOR_AMD = r"\m(AMD|EPYC|Ryzen|Threadripper)\M"
VENDOR_INTEL = r"\m(Intel|Xeon|Core|Pentium|Celeron)\M"
VENDOR_INTEL_SKU_E = r"\mE[3457]?-[0-9]{3,4}"
VENDOR_INTEL_SKU_I = r"\m[Ii][3579]-[0-9]{4,5}"

# CPU family and model number share their guards. Each entry:
# (guard, guard case-insensitive, vendor condition, family, model-number extraction)
# family: ("lit", text) | ("xeon_e57",) | ("core_ultra",) | ("core_i",)
# number: (pattern, case-insensitive) or None
CPU_E57 = r"\mE[57]-[0-9]"
CPU_E57_FAMILY = r"\m(E[57])-"
CPU_E57_NUMBER = r"\mE[57]-([0-9]+[A-UW-Z]*)"
CPU_E3 = r"\mE3[\s-]?[0-9]|Xeon-?E3\M"
CPU_E3_NUMBER = r"\mE3[\s-]?([0-9]+[A-UW-Z]*)"
CPU_XEON_E = r"Xeon[\s-]E\M[\s-]+[0-9]{4}|\mE-[0-9]{4}"
CPU_XEON_E_NUMBER = r"(?:Xeon[\s-]E\M[\s-]+|\mE-)([0-9]+[A-Z]*)"
CPU_XEON_D = r"Xeon[\s-]D\M"
CPU_XEON_D_NUMBER = r"Xeon[\s-]D[\s-]+([0-9]+[A-Z]*)"
CPU_SCALABLE_TIERS = [("platinum", "Xeon Platinum"), ("gold", "Xeon Gold"),
                      ("silver", "Xeon Silver"), ("bronze", "Xeon Bronze")]
CPU_SCALABLE_ANY = "platinum|gold|silver|bronze"
CPU_SCALABLE_NUMBER = r"(?:platinum|gold|silver|bronze)\s+([0-9]+[A-Z+]*)"
CPU_CORE_ULTRA = r"core[\s-]+ultra[\s-]+[3579]"
CPU_CORE_ULTRA_TIER = r"core[\s-]+ultra[\s-]+([3579])"
CPU_CORE_ULTRA_NUMBER = r"core[\s-]+ultra[\s-]+[3579][\s-]+([0-9]{3}[A-Z]*)"
CPU_CORE_I_A = r"\mcore\M.*\mi[3579]\M"
CPU_CORE_I_B = r"\mi[3579]-[0-9]{4,5}"
CPU_CORE_I_TIER = r"\m([Ii][3579])"
CPU_CORE_I_NUMBER = r"\mi[3579]-([0-9]+[A-Z]*)"
CPU_XEON6 = r"\m6[0-9]{3}[A-Z]?\M"
CPU_XEON5 = r"\m5[0-9]{3}[A-Z]?\M"
CPU_XEON56_GUARD = r"\m[56][0-9]{3}[A-Z]?\M"
CPU_XEON56_NUMBER = r"\m([56][0-9]{3}[A-Z]?)\M"
CPU_THREADRIPPER = "threadripper"
CPU_RYZEN = r"\mryzen\M"
CPU_EPYC = r"\mepyc\M"
CPU_EPYC_BARE = r"\m[479][0-9]{3}[A-Z]*\M"
CPU_AMD_NUMBER = r"\m([0-9]{4,5}[A-Z0-9]*)\M"

# CPU generation
GEN_VERSION_SUFFIX = r"v([0-9]+)\s*$"
GEN_MARKER = r"\(Gen\s+([0-9]+)\)"
GEN_SCALABLE_FAMILIES = ["Xeon Bronze", "Xeon Silver", "Xeon Gold", "Xeon Platinum", "Xeon 5", "Xeon 6"]
GEN_XEON6_SKU = "^6[0-9]{3}[PE]$"
GEN_SCALABLE_DIGIT = [("^[3-9]1[0-9]{2}", 1), ("^[3-9]2[0-9]{2}", 2), ("^[3-9]3[0-9]{2}", 3),
                      ("^[3-9]4[0-9]{2}", 4), ("^[3-9]5[0-9]{2}", 5)]
GEN_XEON_D = [("^15", 1), ("^2[12]", 2), ("^(17|27)", 3), ("^(18|28)", 4)]
GEN_XEON_E = [("^21", 1), ("^22", 2), ("^23", 3), ("^24", 4)]
GEN_CORE_I_FAMILY = "^Core i[3579]$"
GEN_CORE_I_5DIGIT = ("^1[0-9]{4}", "^(1[0-9])")
GEN_CORE_I_4DIGIT = ("^[2-9][0-9]{3}", "^([2-9])")
GEN_CORE_ULTRA_FAMILY = "^Core Ultra"
GEN_LEADING_DIGIT = "^([0-9])"
GEN_EPYC = [("^7[0-9]{2}1[a-z]*$", 1), ("^7[0-9]{2}2[a-z]*$", 2), ("^7[0-9]{2}3[a-z]*$", 3),
            ("^8[0-9]{3}[a-z]*$", 4), ("^9[0-9]{2}4[a-z]*$", 4), ("^9[0-9]{2}5[a-z]*$", 5),
            ("^4[0-9]{2}4[a-z]*$", 4), ("^4[0-9]{2}5[a-z]*$", 5)]
GEN_RYZEN_FAMILIES = ["Ryzen", "Threadripper PRO"]
GEN_RYZEN_THOUSANDS = [("1", 1), ("2", 1), ("3", 2), ("4", 2), ("5", 3), ("6", 3), ("7", 4), ("8", 4), ("9", 5)]

# Market region
REGION_EU_US = ("Europe", "United States")
REGION_AMERICAS = "Americas"

# ---------------------------------------------------------------------------------------------
# Page extraction
# ---------------------------------------------------------------------------------------------
MIN_PAGE_CHARS = 1000
CATALOG_REQUIRED_KEY = "plans"
GROUPS_MARKER = "window.PLANS_PRICING_DATA = "
GROUPS_KEY = "plansGroups"
ARRAY_MARKERS = ('"servers":[', '"virtualMachines":[')
TRADEMARK_CHARS = "[™®©]"
HTML_VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input",
                  "link", "meta", "param", "source", "track", "wbr"]
CORE_WORDS = [("single", 1), ("dual", 2), ("quad", 4), ("hexa", 6), ("octa", 8), ("deca", 10), ("dodeca", 12)]
VIRTUALISATION_FLAGS = ["AMD-V", "INTEL-VT", "VT-X", "VT-D"]
CARD_CLASSES = ("product", "product-type-HetznerProduct")
CARD_NAME_CLASS = "product-text-name"
MONTHLY_PRICE_TAG = "ho-split-price-container"
HOURLY_PRICE_TAG = "ho-price-container"
HOURLY_PRICE_TYPE = "hourly"
PRODUCT_KEY_ATTR = "product-key"
GPU_GRID_CLASS = "gpu-information-grid"
GPU_GRID_NAME_CLASS = "grid-header-name"
GPU_GRID_CELLS = [("item-a", "cpu_model"), ("item-b", "cpu_cores_raw"), ("item-c", "ram"),
                  ("item-d", "gpu"), ("item-e", "gpu_tflops"), ("item-f", "gpu_vram")]
STORAGE_KINDS = [("nvme", "NVMe"), ("ssd", "SSD"), ("hdd", "HDD")]
OPTIONALLY_WORD = r"(?iU)\boptionally\b"
UPGRADE_CLAUSE = r"(?is)\s*Upgradeable.*\z"
CORE_WORD = r"(?iU)^\s*([A-Za-z]+)\s*-\s*Core\b"
CORE_DIGITS = r"(?iU)^\s*(\d+)\s*[-\s]*Core\b"
GPU_CORES_PE = r"(?iU)^(\d+)\s+Performance\s+Cores\s+(\d+)\s+Efficient\s+Cores"
GPU_CORES_PLAIN = r"(?iU)^\s*(\d+)\s*[-\s]*Cores?\b"
GPU_CORES_LEADING = r"(?U)^\s*(\d+)\b"
IN_PARENTHESES = r"\(([^)]+)\)"
# table row labels (lower case) in rule order; a rule whose attribute is taken is skipped
SPEC_LABEL_RULES = [
    ("cpu", "startswith({label}, 'cpu') AND NOT contains({label}, 'detail')"),
    ("cpu_detail", "contains({label}, 'cpu') AND contains({label}, 'detail')"),
    ("ram", "startswith({label}, 'ram')"),
    ("nvme", "contains({label}, 'nvme')"),
    ("ssd", "(contains({label}, 'sata ssd') OR startswith({label}, 'ssd ') OR {label} = 'ssd')"),
    ("hdd", "contains({label}, 'hdd') AND NOT contains({label}, 'ssd')"),
    ("bandwidth", "(contains({label}, 'guaranteed bandwidth') OR {label} = 'connection')"),
    ("traffic", "startswith({label}, 'traffic')"),
]
