"""Domain constants of the FoodData-Central binding.

Fixed values that must equal the reference's for right results: the
canonical nutrient names in order, their target units and name patterns, the
unit synonyms and conversion factors, and the liquid keywords.
"""

from __future__ import annotations

# Canonical nutrients in order, with target unit and the name
# patterns tried in order (case-insensitive regular expressions).
CANONICAL_NUTRIENTS = [
    ("energy_kcal", "kcal", [r"\benergy\b", r"\bcalories?\b", r"kilocalorie"]),
    ("protein_g", "g", [r"\bprotein\b"]),
    ("total_fat_g", "g", [r"\btotal\b.*\bfat\b", r"^fat$", r"\btotal\b.*fatty acids\b"]),
    ("sat_fat_g", "g", [r"\bsaturated\b.*\bfat\b", r"sat\.?\s*fat", r"fatty.*saturated"]),
    ("mono_fat_g", "g", [r"\bmono.*fat\b", r"monounsaturated"]),
    ("poly_fat_g", "g", [r"\bpoly.*fat\b", r"polyunsaturated"]),
    ("carbs_g", "g", [r"\bcarbo(?:hydrate)?s?\b"]),
    ("fiber_g", "g", [r"\bfiber\b", r"\bfibre\b"]),
    ("sugar_g", "g", [r"\bsugars?\b(?!.*added)"]),
    ("added_sugar_g", "g", [r"\badded\s+sugars?\b", r"sugars?,\s*added", r"added.*sugar"]),
    ("sodium_mg", "mg", [r"\bsodium\b"]),
    ("potassium_mg", "mg", [r"\bpotassium\b"]),
]
CANONICAL_ORDER = [name for name, _, _ in CANONICAL_NUTRIENTS]

# Unit synonyms (trimmed, lower-cased key -> unit).
UNIT_SYNONYMS = {
    "µg": "ug",
    "μg": "ug",
    "mcg": "ug",
    "ug": "ug",
    "mg": "mg",
    "g": "g",
    "kg": "kg",
    "kcal": "kcal",
    "calorie": "kcal",
    "kilocalorie": "kcal",
    "kj": "kj",
    "unit": "unit",
}

# Conversion factors (from, to) -> multiplier.
CONVERSION_FACTORS = {
    ("ug", "mg"): 1 / 1000.0,
    ("ug", "g"): 1 / 1_000_000.0,
    ("mg", "g"): 1 / 1000.0,
    ("mg", "ug"): 1000.0,
    ("g", "mg"): 1000.0,
    ("g", "ug"): 1_000_000.0,
    ("kj", "kcal"): 0.239005736,
    ("kcal", "kj"): 4.184,
}

# Substrings that tag a food as liquid.
LIQUID_KEYWORDS = [
    "milk", "juice", "smoothie", "water", "soda", "tea", "coffee", "soup", "broth", "drink", "yogurt drink", "oil",
]

# The per-100 g features of the neighbour index, in order.
NEIGHBOUR_FEATURES = [
    "protein_g_per100g", "fiber_g_per100g", "potassium_mg_per100g", "added_sugar_g_per100g", "sugar_g_per100g",
    "sodium_mg_per100g", "sat_fat_g_per100g", "total_fat_g_per100g", "carbs_g_per100g", "energy_kcal_per100g",
    "mono_fat_g_per100g", "poly_fat_g_per100g",
]

# Feature names of the model frame and their source columns.
BASE_FEATURE_MAP = [
    ("protein_g", "protein_g_per100g"),
    ("fiber_g", "fiber_g_per100g"),
    ("potassium_mg", "potassium_mg_per100g"),
    ("added_sugar_g", "added_sugar_g_per100g"),
    ("sugar_g", "sugar_g_per100g"),
    ("sodium_mg", "sodium_mg_per100g"),
    ("sat_fat_g", "sat_fat_g_per100g"),
    ("total_fat_g", "total_fat_g_per100g"),
    ("carbs_g", "carbs_g_per100g"),
    ("energy_kcal", "energy_kcal_per100g"),
    ("mono_fat_g", "mono_fat_g_per100g"),
    ("poly_fat_g", "poly_fat_g_per100g"),
]
DERIVED_FEATURES = ["unsat_sat_ratio", "energy_density"]

# Recommender defaults.
RECO_DEFAULTS = {
    "min_features_present": 6,
    "n_neighbors": 50,
    "form_match": True,
    "group_match": True,
    "min_score_gain": 10.0,
    "max_kcal_delta": 100.0,
    "sodium_cap": 500.0,
    "w_similarity": 0.6,
    "w_gain": 0.4,
}
