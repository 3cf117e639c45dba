"""Fixed values of the review domain: patterns, word lists, labels and cut points.

Everything here is a default; every operator takes its own table or list instead.
"""

from __future__ import annotations

# Title classes in priority order, first match wins.
TITLE_CLASSES = (
    (
        "desktop",
        r"\b(desktop|imac|mac\s+mini|mac\s+pro|mac\s+studio|all[\s\-]in[\s\-]one"
        r"|tower\s+pc|mini\s+pc|nuc)\b",
    ),
    (
        "laptop",
        r"\b(laptop|notebook|macbook|chromebook|surface\s+pro|thinkpad"
        r"|ideapad|inspiron|pavilion|spectre|envy|zenbook|vivobook)\b",
    ),
    (
        "tablet",
        r"\b(ipad|kindle|fire\s+tablet|galaxy\s+tab|tab[\s\-]?[ae]\d"
        r"|lenovo\s+tab|surface\s+go)\b",
    ),
    (
        "phone",
        r"\b(iphone|galaxy[\s\-]?[sz]\d|pixel[\s\-]?\d|oneplus[\s\-]?\d"
        r"|smartphone|android\s+phone)\b",
    ),
)
NO_CLASS = "other"
DROPPED_CLASSES = ("other", "phone")

# Brand words and the brand each alias stands for.
BRAND_PATTERN = (
    r"\b(apple|iphone|ipad|macbook|imac"
    r"|samsung|galaxy"
    r"|dell|alienware|xps"
    r"|hp|hewlett[\s\-]?packard|omen|spectre|pavilion|envy|elitebook|probook"
    r"|lenovo|thinkpad|ideapad|yoga"
    r"|asus|zenbook|vivobook|rog|tuf"
    r"|acer|aspire|nitro|predator|swift"
    r"|microsoft|surface"
    r"|amazon|kindle|fire|echo"
    r"|google|pixel|chromebook"
    r"|lg|sony|toshiba|razer)\b"
)
BRAND_ALIASES = {
    "hewlettpackard": "hp",
    "iphone": "apple", "ipad": "apple", "macbook": "apple", "imac": "apple",
    "galaxy": "samsung",
    "alienware": "dell", "xps": "dell",
    "thinkpad": "lenovo", "ideapad": "lenovo", "yoga": "lenovo",
    "zenbook": "asus", "vivobook": "asus", "rog": "asus", "tuf": "asus",
    "aspire": "acer", "nitro": "acer", "predator": "acer", "swift": "acer",
    "kindle": "amazon", "fire": "amazon", "echo": "amazon",
    "pixel": "google", "chromebook": "google",
    "omen": "hp", "spectre": "hp", "pavilion": "hp",
    "envy": "hp", "elitebook": "hp", "probook": "hp",
    "surface": "microsoft",
}
NO_BRAND = "unknown"

# Words of a trade-off.
CONTRAST_PATTERN = (
    r"\b(but|however|although|though|despite|unfortunately|except|yet|still|while|whereas)\b"
)

# Keyword topics of the period comparison.
PERIOD_KEYWORDS = {
    "webcam": r"\bwebcam\b",
    "zoom / video": r"\b(?:zoom|teams|meet|video\s+call|video\s+conference)\b",
    "battery life": r"\bbatter(?:y\s+life|y\s+drain|ies?)\b",
    "work from home": r"\b(?:work\s+from\s+home|wfh|remote\s+work)\b",
    "display": r"\b(?:screen|display|monitor)\b",
    "speaker": r"\bspeaker\b",
    "keyboard": r"\bkeyboard\b",
    "performance": r"\b(?:performance|fast|slow|lag)\b",
    "price / value": r"\b(?:price|value|worth|expensive|cheap)\b",
    "delivery": r"\b(?:shipping|delivery|arrived|package)\b",
}
# The study form of the same topics (no delivery, narrower battery).
STUDY_KEYWORDS = {
    "webcam": r"\bwebcam\b",
    "zoom/video call": r"\b(zoom|teams|meet|video\s+call|video\s+conference)\b",
    "battery life": r"\bbatter(y\s+life|y\s+drain)",
    "work from home": r"\b(work\s+from\s+home|wfh|remote\s+work)\b",
    "display/screen": r"\b(screen|display|monitor)\b",
    "speaker": r"\bspeaker\b",
    "keyboard": r"\bkeyboard\b",
    "performance": r"\b(performance|fast|slow|lag)\b",
    "price/value": r"\b(price|value|worth|expensive|cheap)\b",
}

# Period labels, half-open cuts.
PERIODS = ("pre-COVID", "during-COVID", "post-COVID")
PERIOD_CUTS = ("2020-03-01", "2021-07-01")
NO_PERIOD = "unknown"

# Price tiers by quantile of the known prices.
TIER_QUANTILES = {"q50": 0.5, "q75": 0.75, "q975": 0.975}
TIERS = ("Low", "Medium", "High", "Premium")
NO_TIER = "Unknown"

EXCLUDED_MAIN_CATEGORY = "Office Products"
CATALOGUE_CATEGORIES = ("Computers", "All Electronics", "Amazon Devices", "Office Products")
UNUSED_REVIEW_COLUMNS = ("timestamp", "pred_label", "rn")

LENGTH_EDGES = (0, 100, 300, 600, 1000, 99999)
LENGTH_LABELS = ("<100", "100-300", "300-600", "600-1000", ">1000")
QUARTILE_LABELS = ("Q1 (Budget)", "Q2 (Low-Mid)", "Q3 (High-Mid)", "Q4 (Premium)")

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

SENTENCE_TYPES = ("unrelated", "general", "technical")
EXCLUDED_ASPECTS = ("general", "unrelated")
SENTIMENT_LABELS = ("Negative", "Positive")
