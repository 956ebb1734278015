"""Vocabularies, limits and thresholds. They are default arguments, never hidden state."""

# The label vocabularies a result must be spelled with, in match order.
COOKING_METHODS = [
    "Baking", "Boiling", "Frying", "Grilling", "Steaming", "Stewing",
    "Blending", "Raw Food", "Sous Vide", "Freezing", "Smoking", "Microwave",
]
INGREDIENT_GROUPS = [
    "Vegetables", "Fruits", "Meat", "Seafood", "Mushrooms", "Dairy", "Grains", "Nuts",
]
CATEGORIES = [
    "Main Dish", "Appetizer", "Salad", "Dinner", "BBQ & Grilled", "Dessert",
    "Dressing", "Sandwich", "Side Dish", "Soup", "Lunch", "Breakfast",
]
MEALS = ["Breakfast", "Snack", "Lunch", "Brunch", "Dinner", "Supper"]
COURSES = ["Dessert", "Side Dish", "Salad", "Soup", "Main Dish", "Appetizer"]
DIETS = ["Vegan", "Vegetarian"]

# Thresholds, limits and defaults of the searches.
LABEL_CONFIDENCE = 0.6
CLASSIFIER_BATCH = 32
RESTRICTED_DUPLICATE = 0.98
BLEND_DUPLICATE = 0.95
BLEND_SIMILARITY = 0.8
BLEND_WEIGHT = 0.6
DEFAULT_K = 10
USER_K_DEFAULT, USER_K_MIN, USER_K_MAX = 5, 1, 50
MIN_CANDIDATES = 100
CALORIES_LIMITS = (0, 1000)
PROTEIN_LIMITS = (0, 40)
FAT_LIMITS = (0, 50)
CARBS_LIMITS = (0, 100)
MAX_DF = 0.8
MAX_CHAR_FEATURES = 5000
WORD_NGRAMS = (1, 2)
CHAR_NGRAMS = (2, 4)

# The columns of a facet table and their order.
FLAG_COLUMNS = [g.lower() for g in INGREDIENT_GROUPS]
LABEL_COLUMNS = ["meal", "course", "special_nutrition", "cooking_methods"]
NUTRIENT_COLUMNS = ["calories", "protein", "fat", "carbs"]
FACET_ORDER = [
    *NUTRIENT_COLUMNS, "meal", "course", "healthy", "special_nutrition",
    "cooking_methods", "time_mins", *FLAG_COLUMNS,
]
EVALUATION_FACETS = ["meal", "course", "cooking_methods", *FLAG_COLUMNS]

# The common English stop-word list (179 words). Only the entries
# without an apostrophe can ever equal a token; the others are kept for completeness.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours
yourself yourselves he him his himself she she's her hers herself it it's its
itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all
any both each few more most other some such no nor not only own same so than too
very s t can will just don don't should should've now d ll m o re ve y ain aren
aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven
haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't
shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# Plural forms the suffix rules would get wrong, and words that only look plural.
NOUN_EXCEPTIONS = {
    "pies": "pie", "cookies": "cookie", "brownies": "brownie", "smoothies": "smoothie",
    "veggies": "veggie", "calories": "calorie", "movies": "movie", "ties": "tie",
    "leaves": "leaf", "loaves": "loaf", "halves": "half", "knives": "knife",
    "calves": "calf", "shelves": "shelf", "lives": "life", "wives": "wife",
    "men": "man", "women": "woman", "children": "child", "people": "person",
    "feet": "foot", "teeth": "tooth", "geese": "goose", "mice": "mouse",
    "molasses": "molasses", "hummus": "hummus", "couscous": "couscous",
    "asparagus": "asparagus", "citrus": "citrus", "swiss": "swiss",
    "series": "series", "species": "species", "christmas": "christmas",
}

# Keywords behind the offline default classifier (see functions/models.py).
COOKING_LEXICON = {
    "Baking": ["bake", "baked", "baking", "oven", "roast", "roasted", "preheat", "dough"],
    "Boiling": ["boil", "boiled", "boiling", "simmer", "poach", "blanch"],
    "Frying": ["fry", "fried", "frying", "saute", "skillet", "sear"],
    "Grilling": ["grill", "grilled", "grilling", "barbecue", "charcoal"],
    "Steaming": ["steam", "steamed", "steaming", "steamer"],
    "Stewing": ["stew", "stewed", "stewing", "braise", "braised"],
    "Blending": ["blend", "blended", "blender", "puree", "smoothie"],
    "Raw Food": ["raw", "uncooked", "toss", "salad"],
    "Sous Vide": ["sous", "vide", "vacuum"],
    "Freezing": ["freeze", "freezer", "frozen", "chill"],
    "Smoking": ["smoke", "smoked", "smoker", "smoking"],
    "Microwave": ["microwave", "microwaved", "nuke"],
}
INGREDIENT_LEXICON = {
    "Vegetables": ["onion", "onions", "carrot", "carrots", "tomato", "tomatoes", "potato",
                   "potatoes", "garlic", "spinach", "celery", "lettuce", "vegetable"],
    "Fruits": ["apple", "apples", "lemon", "orange", "banana", "berry", "berries", "fruit"],
    "Meat": ["beef", "pork", "chicken", "turkey", "bacon", "ham", "lamb", "sausage", "meat"],
    "Seafood": ["fish", "salmon", "tuna", "shrimp", "crab", "cod", "lobster", "seafood"],
    "Mushrooms": ["mushroom", "mushrooms", "portobello", "shiitake"],
    "Dairy": ["milk", "butter", "cheese", "cream", "yogurt", "egg", "eggs"],
    "Grains": ["flour", "rice", "oats", "pasta", "bread", "wheat", "noodles"],
    "Nuts": ["almond", "almonds", "walnut", "walnuts", "pecan", "pecans", "peanut", "nuts"],
}
