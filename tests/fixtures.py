"""Small normalised reference data and hand-written sales lines.

Fixed values: a subset of the source system's seed rows (names, ids and
prices as published there) and the sales-line cases listed in FIXTURES.md.
"""

from pyspark.sql import SparkSession

COUNTRY = [(1, "Deutschland")]
REGION = [(2, 1, "Bayern"), (15, 1, "Schleswig-Holstein"), (5, 1, "Bremen")]
CITY = [(2, 2, "München"), (15, 15, "Kiel"), (5, 5, "Bremen")]
SHOP = [(2, 2, "Superstore München"), (15, 15, "Superstore Kiel"), (5, 5, "Superstore Bremen")]
CATEGORY = [(1, "Heimelektronik"), (2, "Großgeräte")]
FAMILY = [(2, 1, "Audio"), (4, 2, "Gartengeräte")]
GROUP = [(3, 2, "CD-Player"), (8, 4, "Vertikutierer")]
ARTICLE = [(9, 3, "Onkyo DX-7355", 139.99000549316406),
           (30, 8, "Güde GV 2400 SL", 249.0),
           (31, 8, "Brill 28 VE/RL", 139.0)]

# (line, expected reject reason or None)
SALES_LINES = [
    (("01.01.2019", "Superstore München", "Güde GV 2400 SL", "2", "498,00"), None),
    (("1.2.2019", "Superstore Kiel", "Brill 28 VE/RL", "1", "139,00"), None),
    (("03.04.2019", "Superstore Kiel", "Brill 28 VE/RL", " 5 ", "695,00"), None),
    (("03.04.2019", "Superstore Kiel", "Brill 28 VE/RL", "1", "10,005"), None),
    (("03.04.2019", "Superstore Kiel", "Brill 28 VE/RL", "0", "10,00"), None),
    (("31.02.2019", "Superstore Kiel", "Brill 28 VE/RL", "1", "1,00"), "bad_date"),
    (("03.04.2019", "Superstore Köln", "Brill 28 VE/RL", "1", "1,00"), "unknown_shop"),
    (("03.04.2019", "Superstore Kiel", "X", "1", "1,00"), "unknown_article"),
    (("03.04.2019", "Superstore Köln", "Brill 28 VE/RL", "1", "x"), "unknown_shop"),
    (("03.04.2019", "Superstore Kiel", "Brill 28 VE/RL", "1", "1.234,56"), "bad_revenue"),
    (("03.04.2019", "Superstore Kiel", "Brill 28 VE/RL", "", "1,00"), "bad_sold"),
    (("03.04.2021", "Superstore Kiel", "Brill 28 VE/RL", "1", "1,00"), "date_out_of_range"),
    (("15.11.2020", "Superstore Bremen", "Onkyo DX-7355", "3", "419,97"), None),
    (("15.11.2020", "Superstore München", "Onkyo DX-7355", "1", "139,99"), None),
]


def base_tables(spark: SparkSession) -> dict:
    mk = spark.createDataFrame
    return {
        "country": mk(COUNTRY, "CountryID int, Name string"),
        "region": mk(REGION, "RegionID int, CountryID int, Name string"),
        "city": mk(CITY, "CityID int, RegionID int, Name string"),
        "shop": mk(SHOP, "ShopID int, CityID int, Name string"),
        "category": mk(CATEGORY, "ProductCategoryID int, Name string"),
        "family": mk(FAMILY, "ProductFamilyID int, ProductCategoryID int, Name string"),
        "group": mk(GROUP, "ProductGroupID int, ProductFamilyID int, Name string"),
        "article": mk(ARTICLE, "ArticleID int, ProductGroupID int, Name string, Price double"),
    }


def sales_text(spark: SparkSession):
    return spark.createDataFrame([line for line, _ in SALES_LINES],
                                 "Date string, Shop string, Article string, Sold string, "
                                 "Revenue string")
