"""Fixed values. They must equal the catalogue's own lists; order decides where the first match wins."""

# name parts that stand for a canonical product, in matching order
BUILDER_NAMES = (
    ("bananen", "banana"), ("apfel", "apple"), ("heidelbeeren", "blueberries"), ("himbeeren", "raspberries"),
    ("brombeeren", "blackberries"), ("erdbeeren", "strawberries"), ("avocado", "avocado"), ("ananas", "pineapple"),
    ("birne", "pear"),
)
DEDUP_NAMES = (
    ("bananen", "banana"), ("äpfel", "apple"), ("apfel", "apple"), ("avocados", "avocado"), ("erdbeeren", "strawberry"),
    ("himbeeren", "raspberry"), ("heidelbeeren", "blueberry"), ("brombeeren", "blackberry"), ("birnen", "pear"),
    ("birne", "pear"), ("ananas", "pineapple"),
)
SIMPLE_NAMES = (*BUILDER_NAMES, ("obst", "fruit"), ("süsse", "sweet"))
FRUITS = ("banana", "apple", "blueberries", "strawberries", "avocado", "pineapple", "pear")
BIO_WORDS = ("bio", "organic", "öko", "naturland", "demeter")
OCR_BRANDS = (
    "REWE", "YoPRO", "HEIMATGUT", "Vivera", "Oatly", "Feine Welt", "ja!", "EDEKA", "Netto", "Lidl", "Aldi", "Danone",
    "Nestlé", "Unilever", "Coca-Cola", "Pepsi", "Dr. Oetker", "Knorr", "Bio", "Organic", "GRAN RESERVA", "BLACK ANGUS",
)
UNITS = (
    ("stk", "Stk"), ("STK", "Stk"), ("Stk", "Stk"), ("stück", "Stk"), ("piece", "Stk"), ("kg", "kg"), ("KG", "kg"),
    ("Kg", "kg"), ("kilogram", "kg"), ("kilo", "kg"), ("g", "kg"), ("G", "kg"), ("gram", "kg"), ("grams", "kg"), ("l", "l"),
    ("L", "l"), ("liter", "l"), ("litre", "l"), ("lt", "l"), ("ml", "l"), ("ML", "l"), ("milliliter", "l"), ("millilitre", "l"),
)
BRANDS = (
    ("ja!", "Ja!"), ("ja", "Ja!"), ("rewe", "REWE"), ("aurora", "Aurora"), ("mondamin", "Mondamin"), ("iglo", "Iglo"),
    ("alnatura", "Alnatura"), ("edeka", "EDEKA"), ("maggi", "Maggi"), ("knorr", "Knorr"), ("dr. oetker", "Dr. Oetker"),
    ("dr oetker", "Dr. Oetker"), ("rewe beste wahl", "REWE Beste Wahl"), ("rewe best wahl", "REWE Beste Wahl"),
    ("beste wahl", "Beste Wahl"), ("edeka gut & günstig", "EDEKA Gut & Günstig"), ("wagner", "Original Wagner"),
    ("original wagner", "Original Wagner"), ("uncle ben", "Uncle Ben's"), ("uncle ben's", "Uncle Ben's"),
    ("uncle bens", "Uncle Ben's"), ("kellogg's", "Kellogg's"), ("kelloggs", "Kellogg's"),
)
BRAND_VARIANTS = (
    ("snyders", "Snyder's of Hanover"), ("sndyers", "Snyder's of Hanover"), ("snyder", "Snyder's of Hanover"),
    ("snyders of hanover", "Snyder's of Hanover"), ("milka", "Milka"), ("kitkat", "KitKat"), ("kit kat", "KitKat"),
    ("nutella", "Nutella"), ("ferrero", "Ferrero"), ("nestle", "Nestlé"), ("coca cola", "Coca-Cola"), ("pepsi", "PepsiCo"),
)
CATEGORY_WORDS = (
    ("Obst", ("obst", "fruit", "früchte", "bananen", "äpfel", "birnen", "beeren")),
    ("Gemüse", ("gemüse", "vegetables", "vegetable")),
    ("Joghurt & Desserts", ("joghurt", "dessert", "yogurt", "pudding", "quark", "desserts")),
    ("Milch & Butter", ("milch", "butter", "käse", "sahne", "milk", "cheese")),
    ("Backwaren", ("backwaren", "brot", "bakery", "bread")),
    ("Kinder", ("kinder", "baby", "kids", "children")),
    ("Fleisch & Wurst", ("fleisch", "wurst", "meat", "sausage", "schinken")),
    ("Tiefkühl", ("tiefkühl", "frozen", "tk", "gefroren")),
    ("Getränke", ("getränke", "drinks", "wasser", "saft", "beverages")),
)
ALLERGENS_DE = (
    "gluten", "weizen", "milch", "eier", "nüsse", "erdnüsse", "soja", "fisch", "schalentiere", "sellerie", "senf", "sesam",
)
ALLERGENS_EN = (
    ("milk", ("milk", "whey", "lactose")), ("nuts", ("nuts", "hazelnuts", "almonds", "peanuts")),
    ("gluten", ("wheat", "gluten", "barley", "rye")), ("soy", ("soy", "soja")),
)
#: pattern, least and greatest value that counts
NUTRITION = {
    "calories": (
        (
            r"(\d+)\s*(?:k?cal|calories?)\s*(?:per\s*)?(?:100\s*g|100g)", r"(?:100\s*g|100g)[:\s]*(\d+)\s*(?:k?cal|calories?)",
            r"energie[:\s]*(\d+)\s*(?:k?cal|kcal)", r"brennwert[:\s]*(\d+)\s*(?:k?cal|kcal)",
        ), 50, 900,
    ),
    "protein": ((r"(?:protein|eiweiß)[:\s]*(\d+(?:\.\d+)?)\s*g", r"(\d+(?:\.\d+)?)\s*g\s*(?:protein|eiweiß)"), 0, 100),
    "carbs": (
        (r"(?:carbohydrates?|kohlenhydrate)[:\s]*(\d+(?:\.\d+)?)\s*g", r"(\d+(?:\.\d+)?)\s*g\s*(?:carbs?|kohlenhydrate)"), 0, 100,
    ),
    "fat": ((r"(?:fat|fett)[:\s]*(\d+(?:\.\d+)?)\s*g", r"(\d+(?:\.\d+)?)\s*g\s*(?:fat|fett)"), 0, 100),
}
PRICE_PATTERNS = ((r"€(\d+[.,]\d+)", "EUR"), (r"\$(\d+[.,]\d+)", "USD"), (r"(\d+[.,]\d+)\s*€", "EUR"), (r"(\d+[.,]\d+)\s*USD", "USD"))
IMAGE_SKIP_WORDS = ("logo", "icon", "banner", "header", "footer", "button", "sprite", "background", "thumb", "avatar", "profile")
IMAGE_SOURCES = (
    ("wikipedia_main", 90), ("wikipedia_gallery", 80), ("chiquita_official", 85), ("brand_official", 85),
    ("open_food_facts", 70), ("google_images", 60),
)
NUTRIENT_IDS = (
    (203, "protein"), (204, "total_fat"), (205, "total_carbs"), (208, "calories"), (269, "sugars"), (291, "dietary_fiber"),
    (307, "sodium"), (601, "cholesterol"), (606, "saturated_fat"), (605, "trans_fat"), (306, "potassium"), (301, "calcium"),
    (303, "iron"), (318, "vitamin_a"), (401, "vitamin_c"),
)
REFUSALS = ("i'm sorry", "i can't", "i cannot", "i'm not able", "unable to", "sorry", "error:", "http", "timeout")
PREAMBLES = ("the product name is:", "product name:", "the product is:", "product:", "name:")
BADGES = ("best value", "sale", "new", "aktuelle", "aktion", "angebot")
STATUSES = ("pending", "processing", "completed", "failed", "skipped")
QUALITY_TIERS = ((90, "excellent"), (75, "good"), (60, "acceptable"), (40, "fair"))
SEARCH_TERMS = (
    ("banana", "banana raw"), ("apple", "apple raw with skin"), ("avocado", "avocado raw"), ("strawberry", "strawberries raw"),
    ("blueberry", "blueberries raw"), ("raspberry", "raspberries raw"), ("blackberry", "blackberries raw"),
)
BRAND_SPELLINGS = (
    ("coc cola", "Coca-Cola"), ("coca cola", "Coca-Cola"), ("budweser", "Budweiser"), ("budwieser", "Budweiser"),
    ("mcdonal", "McDonald's"), ("mcdonalds", "McDonald's"), ("nestel", "Nestlé"), ("nestle", "Nestlé"), ("kellogs", "Kellogg's"),
    ("kelloggs", "Kellogg's"), ("heinze", "Heinz"), ("snyders", "Snyder's of Hanover"), ("snydrs", "Snyder's of Hanover"), ("milka", "Milka"),
)
PRODUCT_TYPES = (
    ("cola", "beverage"), ("beer", "beverage"), ("chocolate", "confectionery"), ("choc", "confectionery"), ("cereal", "breakfast"),
    ("flakes", "breakfast"), ("pretzel", "snack"), ("pretzl", "snack"), ("chips", "snack"), ("crisps", "snack"),
)
FOOD_WORDS = ("food", "snack", "chocolate", "bread", "cheese", "meat", "fruit", "vegetable")
DRINK_WORDS = ("drink", "beverage", "water", "juice", "soda", "beer", "wine", "coffee", "tea")
DESCRIPTION_BRANDS = ("chiquita", "bio", "organic", "pink lady", "driscoll", "dole", "del monte")
HEADER_WORDS = (
    "fleisch", "fisch", "rind", "kalb", "schwein", "hähnchen", "pute", "obst", "gemüse", "bananen", "äpfel", "birnen", "beeren",
    "joghurt", "dessert", "milch", "butter", "käse", "sahne", "backwaren", "brot", "brötchen", "kuchen", "getränke", "wasser",
    "saft", "limonade", "bier", "wein", "tiefkühl", "eis", "pizza", "fertig", "categories", "vegan",
)
MEAT_WORDS = ("fleisch", "fisch", "rind", "kalb", "schwein", "hähnchen", "pute")
# category, subcategory and pattern, in the order in which they are tried
CATEGORY_PATTERNS = (
    ("Aufschnitt & Brotaufstriche", "Fruchtaufstriche", r"\b(marmelade|konfitüre|gelee|fruchtaufstrich)\b"),
    ("Aufschnitt & Brotaufstriche", "Fruchtaufstriche", r"\b(samt|extra|weniger zucker|bio)\b.*\b(himbeere|erdbeere|aprikose|kirsche|pflaume|orange|zitrone)\b"),
    ("Aufschnitt & Brotaufstriche", "Fruchtaufstriche", r"\b(himbeere|erdbeere|aprikose|kirsche|pflaume|orange|zitrone)\b.*\b(aufstrich|jam|preserve)\b"),
    ("Aufschnitt & Brotaufstriche", "Fruchtaufstriche", r"\bschwartau\b"),
    ("Aufschnitt & Brotaufstriche", "Fruchtaufstriche", r"\bschwarzer?\w*\b.*\b(frucht|beere)\b"),
    ("Aufschnitt & Brotaufstriche", "Fruchtaufstriche", r"samt.*\b(himbeere|erdbeere|aprikose)\b"),
    ("Aufschnitt & Brotaufstriche", "Fruchtaufstriche", r"extra.*weniger zucker.*\b(himbeere|erdbeere|aprikose|kirsche)\b"),
    ("Aufschnitt & Brotaufstriche", "Nuss- & Schokoaufstriche", r"\b(nutella|nuss|haselnuss|erdnuss|mandel)\b.*\b(aufstrich|creme)\b"),
    ("Aufschnitt & Brotaufstriche", "Nuss- & Schokoaufstriche", r"\b(schoko|schokoladen|kakao)\b.*\b(aufstrich|creme)\b"),
    ("Aufschnitt & Brotaufstriche", "Nuss- & Schokoaufstriche", r"\b(nougat|praline)\b"),
    ("Aufschnitt & Brotaufstriche", "Wurst & Fleischaufstriche", r"\b(leberwurst|mettwurst|teewurst|salami)\b"),
    ("Aufschnitt & Brotaufstriche", "Wurst & Fleischaufstriche", r"\b(fleisch|wurst)\b.*\b(aufstrich|paste)\b"),
    ("Käse", "Käse", r"\b(käse|cheese|gouda|cheddar|camembert|brie|mozzarella)\b"),
    ("Käse", "Käse", r"\b(frischkäse|schmelzkäse|hartkäse|weichkäse)\b"),
    ("Fleisch & Fisch", "Fleisch", r"\b(fleisch|meat|rind|schwein|huhn|hähnchen|pute|kalb)\b"),
    ("Fleisch & Fisch", "Fleisch", r"\b(steak|schnitzel|hackfleisch|bratwurst)\b"),
    ("Fleisch & Fisch", "Fisch", r"\b(fisch|fish|lachs|thunfisch|forelle|kabeljau|hering)\b"),
    ("Fleisch & Fisch", "Fisch", r"\b(salmon|tuna|cod|herring)\b"),
    ("Obst & Gemüse", "Obst", r"\b(apfel|apple|banane|orange|birne|traube|kiwi|mango)\b"),
    ("Obst & Gemüse", "Obst", r"\b(beeren|erdbeere|himbeere|blaubeere|brombeere)\b"),
    ("Obst & Gemüse", "Gemüse", r"\b(gemüse|vegetable|tomate|gurke|paprika|zwiebel|karotte)\b"),
    ("Obst & Gemüse", "Gemüse", r"\b(salat|spinat|brokkoli|blumenkohl|zucchini)\b"),
)
CATEGORY_BRANDS = (
    ("schwartau", "Aufschnitt & Brotaufstriche", "Fruchtaufstriche"), ("schwarzwald", "Aufschnitt & Brotaufstriche", "Fruchtaufstriche"),
    ("schwartzau", "Aufschnitt & Brotaufstriche", "Fruchtaufstriche"), ("nutella", "Aufschnitt & Brotaufstriche", "Nuss- & Schokoaufstriche"),
)
JAM_TERMS = r"\b(samt|extra|weniger zucker)\b"
JAM_FRUITS = r"\b(himbeere|erdbeere|aprikose|kirsche)\b"
# an issue that holds one of these words is critical
CRITICAL_ISSUES = ("missing header", "missing content", "too small", "too large", "not portrait", "overlaps header", "poor ui coverage")
SHORT_REFUSALS = ("can't", "cannot", "error", "http", "timeout")
EXPLANATIONS = ("**", "- **", "extraction rules", "to extract", "follow these steps", "brand prefix", "quantity information", "ignore price")
QUALITY_BRANDS = ("Dr. Oetker", "Mondamin", "Aurora", "Barebells", "BE-KIND", "Edeka", "Rewe", "Knorr", "Maggi", "Alnatura")
QUALITY_UNITS = ("g", "kg", "ml", "l", "stk", "/kg", "/stk", "pack")
# product pages: ladders of selectors, the first that has an element counts
PAGE_TITLE = ("h1", ".product-title", '[data-testid="product-name"]', ".pdp-product-name", ".product-name")
PAGE_PRICE = (".price", ".product-price", '[data-testid="price"]', ".current-price", ".price-current")
PAGE_INGREDIENTS = ('[data-testid="ingredients"]', ".ingredients", ".product-ingredients", ".ingredient-list")
PAGE_INGREDIENT_WORDS = ("zutaten", "ingredients", "inhaltsstoffe")
PAGE_NUTRITION = ("nutrition", "nährwert", "energy", "calories", "protein", "fat", "carbs")
VOID_TAGS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
# breaks of screens: expected places as shares of the height, how far off, and what counts as a jump
HEADER_AT, FOOTER_AT, BREAK_TOLERANCE, BREAK_PERCENTILE = 0.1903, 0.9113, 0.03, 0.95
EDGE_DEVIATIONS, HEADER_MARGIN, FOOTER_LIMIT = 2.0, 0.05, 0.95
# image providers: name, cost in cents, speed and quality of ten, in the order in which equals are taken
IMAGE_PROVIDERS = (("local", 0, 8, 7), ("remove_bg", 20, 5, 9), ("photoroom", 10, 6, 8), ("removal_ai", 15, 6, 8))
