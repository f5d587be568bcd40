"""Fixed reference values: shelf life, bank holidays, supplier cities, capacities."""

from __future__ import annotations

from datetime import date

# Typical shelf life in days by category, with subcategory overrides.
SHELF_LIFE_DEFAULT = {"Fresh Food": 7, "Chilled Food": 10, "Bakery": 3, "Food Cupboard": 365, "Food": 90}
SHELF_LIFE_OTHER = 30
SHELF_LIFE = {
    "Fresh Food": {"Vegetables": 7, "Fruit": 7, "Herbs & Spices": 10, "Salad": 5, "Fresh Soup": 3},
    "Chilled Food": {
        "Chilled Meats": 5, "Poultry": 3, "Beef": 5, "Pork": 5, "Lamb": 5, "Fish & Seafood": 2,
        "Cheese": 21, "Milk & Cream": 14, "Yogurt & Desserts": 14, "Chilled Desserts": 7,
        "Ready Meals": 5, "Food To Go": 3, "Party Food, Pies & Salads": 5, "Eggs": 28,
        "Butter & Spreads": 30, "Dips & Pâté": 7, "Fresh Pasta & Sauce": 7, "Cooked Meats": 5,
    },
    "Bakery": {"Bread & Rolls": 3, "Cakes & Treats": 5, "Pastries": 2, "Fresh Bakery": 2, "Part Baked": 7},
    "Food Cupboard": {
        "Chocolate & Sweets": 365, "Biscuits & Crackers": 180, "Crisps & Snacks": 120,
        "Cereals & Snack Bars": 365, "Tins, Cans & Packets": 730, "Rice, Pasta & Noodles": 730,
        "Sauces, Oils & Dressings": 365, "Jams, Spreads & Syrups": 365,
        "Seeds, Nuts & Dried Fruits": 180, "Tea & Coffee": 365, "Soft Drinks": 270, "Alcohol": 1095,
        "Baby Food": 365, "Pet Food": 365, "Flour & Baking": 365, "Sugar & Sweeteners": 730,
        "Herbs & Spices": 730, "Condiments": 365, "Cooking Sauces": 365, "Stock & Gravy": 365,
    },
}
TEMPERATURE_SENSITIVE = ["Fresh Food", "Chilled Food", "Bakery"]
REFRIGERATED = ["Chilled Food"]
STORAGE_NOTES = {
    "Milk & Cream": "Use within 3 days of opening",
    "Fish & Seafood": "Consume on day of purchase for best quality",
    "Bread & Rolls": "Can be frozen to extend shelf life",
    "Beef": "Can be frozen before use-by date",
    "Pork": "Can be frozen before use-by date",
    "Lamb": "Can be frozen before use-by date",
    "Poultry": "Can be frozen before use-by date",
    "Eggs": "Best before date typically 28 days from laying",
}

# UK bank holidays 2025.
UK_HOLIDAYS_2025 = [
    date(2025, 1, 1), date(2025, 4, 18), date(2025, 4, 21), date(2025, 5, 5),
    date(2025, 5, 26), date(2025, 8, 25), date(2025, 12, 25), date(2025, 12, 26),
]

# Supplier lead times in business days and the share of suppliers, in percent.
LEAD_TIME_SHARES = {1: 10, 2: 23, 3: 33, 4: 23, 5: 11}
PO_CUTOFF_TIME = "17:00:00"

# Supplier cities, used in rotation.
SUPPLIER_CITIES = [
    "London", "Manchester", "Birmingham", "Leeds", "Glasgow",
    "Liverpool", "Bristol", "Sheffield", "Edinburgh", "Cardiff",
]

# Units a day that each temperature zone can take in.
ZONE_CAPACITY = {"CHILLED": 15000, "FROZEN": 10000, "AMBIENT": 25000}

# Share of items per price tier by popularity band
# (upper rank fraction; budget, standard, premium, luxury).
TIER_WEIGHTS = [
    (0.2, (0.50, 0.35, 0.12, 0.03)),
    (0.5, (0.40, 0.35, 0.20, 0.05)),
    (1.0, (0.35, 0.35, 0.25, 0.05)),
]
