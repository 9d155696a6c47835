"""Fixed values the results depend on.

Everything in this module must stay exactly as written: changing any entry
changes query results.
"""

# --- fixed values -----------------------------------------------------------

# Item table: column names in their fixed output order.
ITEM_COLUMNS = (
    "timestamp", "storeId",
    "code", "title", "brand", "subTitle", "description",
    "regularPrice", "discountPrice", "imageUrl", "webUrl",
    "groupName", "categoryName", "subcategoryName",
)

# Categories sold by weight or volume that the price aggregates keep.
PRICED_CATEGORIES = (
    "Сыр", "Курица", "Мясо охлажденное", "Овощи", "Фрукты",
    "Ягоды", "Молочная продукция", "Яйца", "Вино",
)

# The one category whose unit price is kept in thousandths (price per litre).
WINE_CATEGORY = "Вино"

# Unit hints a subtitle must contain (case-sensitive): Cyrillic "г" (U+0433),
# Cyrillic "мл" (U+043C U+043B), Latin capital "L" (U+004C).
UNIT_HINTS = ("г", "мл", "L")

# Pack size: (digits followed by one space) or (space, digit, any one
# character, digits); group 0 of the first match.  "." is any character.
PACK_SIZE_PATTERN = r"\d+ | \d.\d+"

# Store id -> city.  Ids keep their leading zeros; any other id has no city.
STORE_CITY = {
    "0124": "Moscow",
    "0210": "St.Petersburg",
    "0203": "Ekaterinburg",
    "0179": "Krasnodar",
    "0238": "Kazan",
    "0091": "Tumen",
    "0209": "Tumen",
}

# Time zone of the ingest stamp.
STAMP_TIME_ZONE = "Europe/Moscow"

# One listing page holds at most this many items.
PAGE_SIZE = 24

# Whitespace run -> one space.  Java's "\s" is ASCII only, so the class also
# lists U+001C-U+001F, U+0085 and every Unicode separator (\p{Z}); together
# that is the set Python's str.isspace() accepts.  DuckDB (RE2) spelling adds
# \x0b, which RE2's "\s" lacks.
WHITESPACE_RUN_JAVA = r"[\s\x1c-\x1f\x85\p{Z}]+"
WHITESPACE_RUN_RE2 = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"

# --- end of fixed values ------------------------------------------------------
