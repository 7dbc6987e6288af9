"""Column types of the entities; columns not named here are text."""

from __future__ import annotations

from pyspark.sql import types as T

# Boolean attributes of a business whose cells are mixed with missing ones.
BUSINESS_FLAGS = (
    "attributes.DietaryRestrictions.gluten-free",
    "attributes.DietaryRestrictions.vegan",
    "attributes.DietaryRestrictions.dairy-free",
    "attributes.DietaryRestrictions.halal",
    "attributes.DietaryRestrictions.soy-free",
    "attributes.DietaryRestrictions.vegetarian",
    "attributes.RestaurantsCounterService",
    "attributes.DietaryRestrictions.kosher",
    "attributes.Open24Hours",
)

# Types that differ from text, per entity. Ids stay text even when they hold digits only.
ENTITY_TYPES: dict[str, dict[str, str]] = {
    "business": {"stars": "double"},
    "review": {},
    "tip": {},
    "checkin": {},
    "photo": {},
    "photo_dataset": {"stars": "double", "stars_num": "int", "width": "int", "height": "int"},
}

ENTITY_FLAGS: dict[str, tuple[str, ...]] = {"business": BUSINESS_FLAGS}

CATEGORY = T.StructType([
    T.StructField("alias", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("parent_aliases", T.ArrayType(T.StringType())),
    T.StructField("country_whitelist", T.ArrayType(T.StringType())),
    T.StructField("country_blacklist", T.ArrayType(T.StringType())),
])

CATEGORY_DOCUMENT = T.StructType([T.StructField("categories", T.ArrayType(CATEGORY))])

PHOTO_DATASET_COLUMNS = (
    "business_id", "stars", "stars_cat", "stars_ord", "stars_num",
    "photo_id", "photo_file", "format", "width", "height", "mode",
)
