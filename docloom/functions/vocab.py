"""Closed vocabularies, default rules and default lexicons."""

from __future__ import annotations

# --- fixed values: labels, names and thresholds that results must carry -----
AI_CATEGORIES = ["AI Infrastructure", "AI Products & Services", "AI Partnerships", "Not AI-related"]
MANAGEMENT_TONES = ["Positive", "Neutral", "Cautious", "Negative"]
BUILTIN_SENTIMENTS = ["positive", "negative", "neutral", "mixed"]

COMPANIES = [
    "Amazon.com, Inc.",
    "Apple Inc.",
    "Meta Platforms, Inc.",
    "Microsoft Corporation",
    "NVIDIA Corporation",
]

COMPANY_ALIASES = {
    "amazon": "Amazon.com, Inc.",
    "amzn": "Amazon.com, Inc.",
    "apple": "Apple Inc.",
    "aapl": "Apple Inc.",
    "meta": "Meta Platforms, Inc.",
    "facebook": "Meta Platforms, Inc.",
    "microsoft": "Microsoft Corporation",
    "msft": "Microsoft Corporation",
    "nvidia": "NVIDIA Corporation",
    "nvda": "NVIDIA Corporation",
}

ENTITY_TYPES = ["Company", "Person", "Product", "Technology", "Market", "Regulation"]
UNKNOWN = "Unknown"
BACKFILL_DESCRIPTION = "Identified through relationships"
PREDICATES = [
    "partners_with",
    "competes_with",
    "invests_in",
    "acquires",
    "uses_technology",
    "supplies_to",
    "mentions",
]
FIELD_LABELS = ["company", "fiscal_period", "document_type", "revenue", "net_income"]
MIN_CONTENT_CHARS = 200
RAW_ROOT = "financial_docs_raw"
# ---------------------------------------------------------------------------

NOT_AI = AI_CATEGORIES[-1]
NEUTRAL_TONE = MANAGEMENT_TONES[1]

# Tokens that say nothing about which company a name means.
COMPANY_SUFFIXES = ["inc", "corp", "corporation", "platforms", "com"]

# Per label, (pattern, group) pairs tried in order; the first non-empty hit wins.
_MONEY = r"(\$\s?[0-9]+(?:[.,][0-9]+)*(?:\s?(?:trillion|billion|million)|[TBM](?![a-z]))?)"
FIELD_RULES = {
    "company": [
        (r"(Amazon(?:\.com)?(?:, Inc\.)?|Apple(?: Inc\.)?|Meta(?: Platforms(?:, Inc\.)?)?"
         r"|Facebook|Microsoft(?: Corporation)?|NVIDIA(?: Corporation)?|Nvidia(?: Corp)?)", 1),
        (r"[(:\s](AMZN|AAPL|META|MSFT|NVDA)[)\s,.]", 1),
    ],
    "fiscal_period": [
        (r"(FY\s?[0-9]{2,4}\s?Q[1-4])", 1),
        (r"(Q[1-4]\s(?:FY\s?)?[0-9]{2,4})", 1),
        (r"(?i)((?:first|second|third|fourth) quarter (?:of )?(?:fiscal )?(?:year )?[0-9]{4})", 1),
        (r"(?i)(?:fiscal )?(?:year|quarter) end(?:ed|ing) (?:on )?([A-Z][a-z]+(?: [0-9]{1,2})?,? [0-9]{4})", 1),
        (r"(?i)(fiscal (?:year )?[0-9]{4})", 1),
    ],
    "document_type": [
        (r"(?i)form (10-?[KQ]|8-?K)", 1),
        (r"(?i)(annual report|quarterly report|earnings call|earnings release)", 1),
    ],
    "revenue": [
        (r"(?i)(?:net sales|revenues?|sales|took in)[^.$]{0,60}" + _MONEY, 1),
        (r"(?i)" + _MONEY + r" (?:in|of) (?:net sales|revenues?|sales)", 1),
    ],
    "net_income": [
        (r"(?i)(?:net income|net earnings|net profit|a net)[^.$]{0,60}" + _MONEY, 1),
        (r"(?i)" + _MONEY + r" (?:in|of) net (?:income|earnings|profit)", 1),
    ],
}

# label -> {token: weight}
AI_CATEGORY_LEXICON = {
    "AI Infrastructure": {
        "datacenter": 3, "datacenters": 3, "gpu": 3, "gpus": 3, "accelerator": 2, "accelerators": 2,
        "compute": 2, "cluster": 1, "clusters": 1, "capacity": 1, "chips": 2, "silicon": 2, "networking": 1,
        "infrastructure": 2, "hopper": 3, "blackwell": 3, "cuda": 2, "trainium": 3, "tpu": 2,
    },
    "AI Products & Services": {
        "copilot": 3, "assistant": 2, "assistants": 2, "chatbot": 2, "generative": 2, "subscription": 1,
        "app": 1, "apps": 1, "siri": 2, "alexa": 2, "bedrock": 2, "feature": 1, "features": 1, "agent": 2,
        "agents": 2, "model": 1, "models": 1, "recommendation": 1,
    },
    "AI Partnerships": {
        "partner": 2, "partners": 2, "partnership": 3, "partnerships": 3, "collaboration": 3, "alliance": 3,
        "jointly": 2, "agreement": 1, "openai": 2, "anthropic": 2, "ecosystem": 1,
    },
}

TONE_LEXICON = {
    "Positive": {
        "growth": 1, "record": 2, "strong": 2, "momentum": 2, "exceeded": 2, "improved": 1, "confident": 2,
        "excited": 2, "gains": 1, "outperformed": 2,
    },
    "Cautious": {
        "uncertain": 2, "uncertainty": 2, "headwinds": 2, "volatility": 2, "cautious": 3, "may": 1, "could": 1,
        "risk": 1, "risks": 1, "constraints": 1, "prudent": 2,
    },
    "Negative": {
        "decline": 2, "declined": 2, "loss": 2, "losses": 2, "impairment": 3, "weak": 2, "decreased": 1,
        "shortfall": 3, "restructuring": 2, "layoffs": 2, "litigation": 1,
    },
}

POSITIVE_WORDS = sorted(TONE_LEXICON["Positive"])
NEGATIVE_WORDS = sorted(TONE_LEXICON["Negative"])

# (predicate, pattern with two groups, subject type, object type)
_NAME = r"([A-Z][A-Za-z0-9&.\-]*[A-Za-z0-9](?: [A-Z][A-Za-z0-9&\-]*){0,3})"
TRIPLET_PATTERNS = [
    ("partners_with", _NAME + r" (?:partners|partnered|is partnering|collaborates) with " + _NAME, "Company", "Company"),
    ("competes_with", _NAME + r" (?:competes|competed|is competing) with " + _NAME, "Company", "Company"),
    ("invests_in", _NAME + r" (?:invests|invested|is investing) in " + _NAME, "Company", "Company"),
    ("acquires", _NAME + r" (?:acquires|acquired|is acquiring) " + _NAME, "Company", "Company"),
    ("uses_technology", _NAME + r" (?:uses|used|adopts|adopted|deploys|deployed) " + _NAME, "Company", "Technology"),
    ("supplies_to", _NAME + r" (?:supplies to|supplied to|ships to|sells to) " + _NAME, "Company", "Company"),
    ("mentions", _NAME + r" (?:mentions|mentioned|highlighted|discussed) " + _NAME, "Person", "Product"),
]
