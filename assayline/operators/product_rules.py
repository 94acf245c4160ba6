"""Which reporting group a product falls into, by type of release and place in the hierarchy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names in the product hierarchies that the rules look at.
ALL_LISTS = "all lists"
FOOD = "food"
FEED = "feed"
PLANTS = "plant commodities (rpcs)"
ANIMAL_PRODUCTS = "animal products"
CEREALS = "cereals"
FRUIT_AND_VEGETABLES = "fruits and nuts, vegetables and other plant products"
VMPR_AS_IS = ("feed", "facets", "non-food matrices")
VMPR_OTHER = "Other VMPR"


def _other(level: Column) -> Column:
    """``Other <level>``; a missing level is spelled ``None``."""
    return F.concat(F.lit("Other "), F.coalesce(level, F.lit("None")))


def product_group(kind: Column, lev2: Column, lev3: Column, lev4: Column, lev5: Column) -> Column:
    """Reporting group, one small decision tree per type; null for any other type.

    ``when`` treats a comparison with null as "no", so each ``otherwise`` is also the branch
    of a missing level.
    """
    # Plant commodities are always reported at the fifth level, even where it is missing.
    food = F.when(lev4 == PLANTS, lev5).otherwise(F.coalesce(lev5, _other(lev4)))

    new_list = F.when(lev3 == FOOD, food).when(lev3 == FEED, lev3).otherwise(_other(lev3))
    pesticides = (
        F.when(lev2 == ALL_LISTS, new_list)
        .when(lev2 == ANIMAL_PRODUCTS, lev3)
        .when(lev2 == CEREALS, F.coalesce(lev3, lev2))
        .when(lev2 == FRUIT_AND_VEGETABLES, F.coalesce(lev4, _other(lev2)))
        .otherwise(lev2)
    )
    chemical = F.when(lev3 == FOOD, food).when(lev3 == FEED, lev3).otherwise(_other(lev4))
    vmpr = (
        F.when(lev3 == FOOD, F.coalesce(lev5, lev4))
        .when(lev3.isin(*VMPR_AS_IS), lev3)
        .otherwise(F.lit(VMPR_OTHER))
    )
    return F.when(kind == "pesticides", pesticides).when(kind == "chemical", chemical).when(kind == "vmpr", vmpr)
