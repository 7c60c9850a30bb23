"""Fixed values that must equal the reference's for identical results.

FIXED VALUES — copied as data, in the reference's natural order: the tag →
cuisine map, the allergen keyword lists, the diet tags, the macro conversion
factors, the feature contract, the drift feature list and the default goals.
"""

from __future__ import annotations

# ---- FIXED VALUES: tag -> cuisine (first tag found in this map wins) --------
CUISINE_MAP: dict[str, str] = {
    "italian": "italian", "sicilian": "italian", "tuscan": "italian",
    "american": "american", "north-american": "american",
    "southern-united-states": "american", "southwestern-united-states": "american",
    "northeastern-united-states": "american", "midwestern": "american",
    "californian": "american", "pacific-northwest": "american",
    "native-american": "american",
    "mexican": "mexican", "tex-mex": "mexican",
    "central-american": "latin_american", "brazilian": "latin_american",
    "argentine": "latin_american", "chilean": "latin_american",
    "peruvian": "latin_american", "ecuadorean": "latin_american",
    "venezuelan": "latin_american", "cuban": "latin_american",
    "caribbean": "latin_american", "baja": "latin_american",
    "european": "european", "greek": "greek", "french": "french",
    "spanish": "spanish", "german": "german", "scandinavian": "scandinavian",
    "irish": "irish", "english": "british", "scottish": "british",
    "swiss": "european", "dutch": "european", "portuguese": "european",
    "polish": "european", "hungarian": "european", "russian": "european",
    "austrian": "european", "belgian": "european", "czech": "european",
    "finnish": "european",
    "asian": "asian", "indian": "indian", "chinese": "chinese",
    "szechuan": "chinese", "cantonese": "chinese", "japanese": "japanese",
    "korean": "korean", "thai": "thai", "vietnamese": "asian",
    "indonesian": "asian", "malaysian": "asian", "filipino": "asian",
    "laotian": "asian", "mongolian": "asian", "cambodian": "asian",
    "pakistani": "asian", "hunan": "chinese", "beijing": "chinese",
    "middle-eastern": "middle_eastern", "lebanese": "middle_eastern",
    "moroccan": "middle_eastern", "turkish": "middle_eastern",
    "saudi-arabian": "middle_eastern", "iranian-persian": "middle_eastern",
    "egyptian": "middle_eastern", "palestinian": "middle_eastern",
    "african": "african", "south-african": "african", "ethiopian": "african",
    "nigerian": "african", "angolan": "african", "somalian": "african",
    "hawaiian": "pacific", "polynesian": "pacific",
    "micro-melanesia": "pacific", "new-zealand": "pacific",
    "australian": "pacific",
}

# The closed cuisine vocabulary (21 mapped values + "unknown"), sorted.
CUISINES: list[str] = sorted(set(CUISINE_MAP.values()) | {"unknown"})

# ---- FIXED VALUES: allergen -> keywords (substring match on ingredients) ----
ALLERGEN_KEYWORDS: dict[str, list[str]] = {
    "milk": ["milk", "butter", "cream", "cheese", "yogurt", "mozzarella",
             "parmesan", "gouda", "cheddar", "buttermilk", "whey"],
    "egg": ["egg", "egg yolk", "egg white", "mayonnaise"],
    "nuts": ["almond", "walnut", "hazelnut", "cashew", "pistachio",
             "pecan", "macadamia", "brazil nut"],
    "peanut": ["peanut", "peanut butter"],
    "fish": ["salmon", "tuna", "cod", "trout", "halibut", "anchovy", "sardine"],
    "shellfish": ["shrimp", "prawn", "lobster", "crab", "scallop",
                  "mussel", "clam", "oyster"],
    "wheat": ["wheat", "flour", "bread", "pasta", "noodles", "semolina"],
    "soy": ["soy", "soybean", "tofu", "tempeh", "edamame", "soy sauce"],
    "sesame": ["sesame", "tahini"],
}
ALLERGENS_SORTED: list[str] = sorted(ALLERGEN_KEYWORDS)

# ---- FIXED VALUES: user diet flag -> recipe tag ------------------------------
DIET_TAGS: dict[str, str] = {
    "user_vegetarian": "vegetarian",
    "user_vegan": "vegan",
    "user_gluten_free": "gluten-free",
    "user_dairy_free": "dairy-free",
    "user_low_sodium": "low-sodium",
    "user_low_fat": "low-fat",
}
DIET_FLAG_SHARE = 0.8

# ---- FIXED VALUES: nutrition list layout and %DV -> absolute factors --------
NUTRITION_FIELDS: list[str] = ["calories", "total_fat", "sugar", "sodium", "protein",
                               "saturated_fat", "carbohydrate"]
PDV_TO_ABS: dict[str, int] = {
    "total_fat": 78, "sugar": 50, "sodium": 2300, "protein": 50,
    "saturated_fat": 20, "carbohydrate": 275,
}

# ---- FIXED VALUES: the 45-feature train/serve contract, in order ------------
FEATURE_COLUMNS: list[str] = [
    "rating",
    "minutes", "n_ingredients", "n_steps", "avg_rating", "n_reviews",
    "cuisine",
    "calories", "total_fat", "sugar", "sodium", "protein",
    "saturated_fat", "carbohydrate",
    "total_fat_g", "sugar_g", "sodium_g", "protein_g",
    "saturated_fat_g", "carbohydrate_g",
    "has_egg", "has_fish", "has_milk", "has_nuts", "has_peanut",
    "has_sesame", "has_shellfish", "has_soy", "has_wheat",
    "daily_calorie_target", "protein_target_g", "carbs_target_g", "fat_target_g",
    "user_vegetarian", "user_vegan", "user_gluten_free", "user_dairy_free",
    "user_low_sodium", "user_low_fat",
    "history_pc1", "history_pc2", "history_pc3", "history_pc4",
    "history_pc5", "history_pc6",
]
NON_FEATURE_COLUMNS: list[str] = ["user_id", "recipe_id", "date", "label", "name",
                                  "request_id", "recommendation_id"]

# ---- FIXED VALUES: features watched by the drift monitor --------------------
DRIFT_FEATURES: list[str] = [
    "minutes", "n_ingredients", "n_steps", "avg_rating", "n_reviews",
    "calories", "total_fat", "sugar", "sodium", "protein",
    "saturated_fat", "carbohydrate",
    "daily_calorie_target", "protein_target_g", "carbs_target_g", "fat_target_g",
    "history_pc1", "history_pc2", "history_pc3",
]

# ---- FIXED VALUES: fairness groups and allergen safety pairs ----------------
FAIRNESS_DIET_FLAGS: list[str] = ["user_vegetarian", "user_vegan", "user_gluten_free",
                                  "user_dairy_free", "user_low_sodium", "user_low_fat"]
ALLERGEN_SAFETY_PAIRS: list[tuple[str, str]] = [
    ("user_dairy_free", "has_milk"),
    ("user_gluten_free", "has_wheat"),
    ("user_vegan", "has_egg"),
    ("user_vegan", "has_milk"),
]

# ---- FIXED VALUES: thresholds -------------------------------------------------
POSITIVE_RATING = 4
MIN_USER_INTERACTIONS = 5
HISTORY_PCA_COMPONENTS = 6
MINUTES_QUANTILE = 0.99
MIN_REVIEWS = 3
MIN_GROUP_USERS = 50
MAX_DEGRADATION = 0.20
ALLERGEN_VIOLATION_LIMIT = 0.01
KS_P_THRESHOLD = 0.01
KS_MIN_STATISTIC = 0.1
DRIFT_SHARE = 0.3

# ---- FIXED VALUES: goal defaults ---------------------------------------------
# Web side (goals table): calories, protein, carbs, fat.
GOAL_DEFAULTS = {"calories": 2000.0, "protein": 50.0, "carbs": 250.0, "fat": 65.0}
# Online feature path fallback for unknown users.
ONLINE_DEFAULT_TARGETS = {"daily_calorie_target": 2000.0, "protein_target_g": 50.0,
                          "carbs_target_g": 275.0, "fat_target_g": 65.0}

# ---- FIXED VALUES: display names for explanations (feature name otherwise) ---
FEATURE_DISPLAY_NAMES: dict[str, str] = {
    "minutes": "Cooking time (min)",
    "n_ingredients": "Number of ingredients",
    "n_steps": "Number of steps",
    "avg_rating": "Average community rating",
    "n_reviews": "Number of reviews",
    "cuisine": "Cuisine type",
    "calories": "Calories",
    "protein": "Protein content",
    "carbohydrate": "Carbohydrates",
    "total_fat": "Total fat",
    "sugar": "Sugar",
    "sodium": "Sodium",
    "daily_calorie_target": "Your calorie target",
    "protein_target_g": "Your protein target",
    "carbs_target_g": "Your carbs target",
    "fat_target_g": "Your fat target",
    "user_vegetarian": "Vegetarian preference",
    "user_vegan": "Vegan preference",
    "user_gluten_free": "Gluten-free preference",
    "user_dairy_free": "Dairy-free preference",
    "user_low_sodium": "Low sodium preference",
    "user_low_fat": "Low fat preference",
    "has_egg": "Contains eggs",
    "has_fish": "Contains fish",
    "has_milk": "Contains dairy",
    "has_nuts": "Contains nuts",
    "has_wheat": "Contains gluten",
    "history_pc1": "Your cooking history (style 1)",
    "history_pc2": "Your cooking history (style 2)",
    "history_pc3": "Your cooking history (style 3)",
}

# ---- FIXED VALUES: synthetic expansion and replay -----------------------------
EXPAND_FACTOR = 2
NOISE_STD = 0.05
REPLAY_DAYS = 7
CANDIDATE_POOL_SIZE = 12

# FIXED VALUES: defaults of requests, and of users without features.
DEFAULT_CALORIE_TARGET = 600.0
DEFAULT_TIME_LIMIT = 120.0
TARGET_DEFAULTS: dict[str, float] = {
    "daily_calorie_target": 2000.0, "protein_target_g": 50.0, "carbs_target_g": 275.0, "fat_target_g": 65.0}
