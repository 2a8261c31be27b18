"""Domain rule sets, as data.

A rule set maps a domain to the keywords that speak for it; the order of the
domains is part of the rule, since the first match or the first of equal scores wins.
"""

from __future__ import annotations

Rules = dict[str, list[str]]

DEFAULT_DOMAIN = "general"

# First-match rule sets of the question, full, typed and smoke loads.
QUESTION_RULES: Rules = {
    "financial": ["bank", "finance", "trading", "stock"],
    "healthcare": ["hospital", "medical", "patient", "health"],
    "education": ["school", "student", "university", "college"],
    "retail": ["store", "shop", "retail", "customer"],
    "sports": ["game", "sport", "team", "player"],
    "technology": ["software", "tech", "computer", "system"],
}

FULL_RULES: Rules = {
    "financial": ["bank", "finance", "trading", "stock", "money", "credit"],
    "healthcare": ["hospital", "medical", "patient", "health", "doctor", "clinic"],
    "education": ["school", "student", "university", "college", "academic", "course"],
    "retail": ["store", "shop", "retail", "customer", "product", "sales"],
    "sports": ["game", "sport", "team", "player", "match", "league"],
    "technology": ["software", "tech", "computer", "system", "app", "web"],
    "entertainment": ["movie", "film", "music", "artist", "show", "concert"],
    "transportation": ["car", "flight", "train", "transport", "airline", "vehicle"],
    "government": ["government", "public", "city", "county", "state", "federal"],
    "real_estate": ["property", "house", "building", "real_estate", "apartment"],
}

TYPED_RULES: Rules = {
    "financial": ["bank", "finance", "money", "credit", "loan", "account"],
    "education": ["school", "student", "university", "college", "course"],
    "retail": ["store", "shop", "retail", "customer", "product", "order"],
    "healthcare": ["hospital", "medical", "patient", "health", "doctor"],
    "sports": ["game", "sport", "team", "player", "match", "league"],
}

SMOKE_RULES: Rules = {
    "financial": ["bank", "finance", "money"],
    "healthcare": ["hospital", "medical", "health"],
    "education": ["school", "student", "university"],
    "retail": ["store", "shop", "retail"],
    "sports": ["sport", "game", "team"],
}

# Keywords of the scored rule set, 21 domains.
SCORED_KEYWORDS: Rules = {
    "financial": ["bank", "finance", "trading", "stock", "money", "credit", "loan", "payment", "investment"],
    "healthcare": ["hospital", "medical", "patient", "health", "doctor", "clinic", "medicine", "treatment"],
    "education": ["school", "student", "university", "college", "academic", "course", "class", "grade"],
    "retail": ["store", "shop", "retail", "customer", "product", "sales", "order", "purchase"],
    "sports": ["game", "sport", "team", "player", "match", "league", "tournament", "athlete"],
    "technology": ["software", "tech", "computer", "system", "app", "web", "platform", "network"],
    "entertainment": ["movie", "film", "music", "artist", "show", "concert", "media", "theater"],
    "transportation": ["car", "flight", "train", "transport", "airline", "vehicle", "shipping", "logistics"],
    "government": ["government", "public", "city", "county", "state", "federal", "municipal", "civic"],
    "real_estate": ["property", "house", "building", "real_estate", "apartment", "rent", "lease"],
    "human_resources": ["employee", "hr", "payroll", "staff", "personnel", "workforce", "hiring"],
    "manufacturing": ["factory", "production", "manufacturing", "supply", "warehouse", "inventory"],
    "telecom": ["telecom", "phone", "mobile", "network", "communication", "cellular"],
    "insurance": ["insurance", "policy", "claim", "coverage", "premium", "risk"],
    "food_service": ["restaurant", "food", "menu", "dining", "cafe", "recipe", "nutrition"],
    "energy": ["energy", "power", "utility", "electric", "gas", "solar", "renewable"],
    "agriculture": ["farm", "agriculture", "crop", "livestock", "farming", "rural"],
    "legal": ["legal", "law", "court", "justice", "attorney", "police", "crime"],
    "nonprofit": ["nonprofit", "charity", "social", "volunteer", "donation", "community"],
    "tourism": ["travel", "tourism", "hotel", "vacation", "booking", "destination"],
    "research": ["research", "science", "laboratory", "experiment", "study", "academic"],
}

# Table-name patterns of the scored rule set.
SCORED_TABLE_PATTERNS: Rules = {
    "financial": ["account", "transaction", "payment", "balance", "credit", "debit"],
    "healthcare": ["patient", "doctor", "diagnosis", "treatment", "medical_record"],
    "education": ["student", "course", "grade", "enrollment", "teacher", "class"],
    "retail": ["customer", "order", "product", "inventory", "sale", "purchase"],
    "sports": ["player", "team", "game", "score", "match", "season"],
    "transportation": ["flight", "passenger", "route", "schedule", "vehicle"],
    "entertainment": ["movie", "actor", "artist", "album", "song", "show"],
    "government": ["citizen", "permit", "license", "department", "official"],
    "real_estate": ["property", "listing", "agent", "buyer", "seller", "mortgage"],
}

# What each scored domain stands for.
DOMAIN_DESCRIPTIONS = {
    "financial": "Banking, trading, investments, financial services",
    "healthcare": "Hospitals, medical records, patient management",
    "education": "Schools, universities, student management systems",
    "retail": "Retail stores, e-commerce, sales management",
    "sports": "Sports leagues, games, player statistics",
    "technology": "Software systems, technology platforms",
    "entertainment": "Movies, music, entertainment industry",
    "transportation": "Airlines, transportation, logistics",
    "government": "Government agencies, public services",
    "real_estate": "Real estate, property management",
    "human_resources": "Human resources, employee management",
    "manufacturing": "Manufacturing, supply chain management",
    "telecom": "Telecommunications, mobile networks",
    "insurance": "Insurance companies, policy management",
    "food_service": "Restaurants, food service industry",
    "energy": "Energy companies, utilities",
    "agriculture": "Agriculture, farming operations",
    "legal": "Legal systems, law enforcement",
    "nonprofit": "Non-profit organizations, social services",
    "tourism": "Tourism, travel booking, hospitality",
    "research": "Scientific research, laboratories",
}

# Points a match is worth.
ID_KEYWORD_POINTS = 10
TABLE_PATTERN_POINTS = 5
TABLE_KEYWORD_POINTS = 3
COLUMN_KEYWORD_POINTS = 1
