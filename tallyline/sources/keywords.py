"""Ordered keyword maps: category -> words, the first category with a matching word wins."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallyline.schemas import DEFAULT_CATEGORY


@dataclass(frozen=True)
class KeywordMap:
    categories: dict[str, list[str]]
    default: str = DEFAULT_CATEGORY


# ---- fixed values -------------------------------------------------------------------------
# Keyword map of the sales pipeline.
PIPELINE_KEYWORDS = KeywordMap({
    "Electrónica": ["LIGHT", "LAMP", "BULB", "BATTERY", "WIRE", "CABLE", "PHONE", "RADIO", "CLOCK",
                    "TIMER"],
    "Hogar": ["CANDLE", "HOLDER", "CUSHION", "FRAME", "MIRROR", "VASE", "BASKET", "BOX", "STORAGE",
              "SHELF", "HOOK", "HANGER", "MAT", "TOWEL", "PILLOW", "BLANKET", "BOTTLE", "JAR", "TIN",
              "CAN"],
    "Cocina": ["CUP", "MUG", "BOWL", "PLATE", "GLASS", "SPOON", "FORK", "KNIFE", "TRAY", "CAKE",
               "BAKING", "KITCHEN", "COOK", "PAN", "POT"],
    "Ropa": ["BAG", "PURSE", "WALLET", "SCARF", "HAT", "GLOVE", "SHOE", "BOOT", "DRESS", "SHIRT",
             "SKIRT", "WRAP", "APRON"],
    "Deportes": ["BALL", "GAME", "SPORT", "FITNESS", "SWIM", "GOLF", "TENNIS"],
    "Papelería": ["PEN", "PENCIL", "PAPER", "CARD", "NOTE", "BOOK", "DIARY", "RULER", "STAMP",
                  "STICKER", "TAG", "LABEL"],
    "Fiesta": ["PARTY", "CHRISTMAS", "BIRTHDAY", "WEDDING", "BALLOON", "BANNER", "RIBBON",
               "DECORATION", "ADVENT", "EASTER", "HALLOWEEN"],
    "Juguetes": ["TOY", "DOLL", "PUPPET", "GAME", "PUZZLE", "PLAY"],
})
# Keyword map of the product catalogue: fewer words, labels without accents.
CATALOGUE_KEYWORDS = KeywordMap({
    "Electronica": ["LIGHT", "LAMP", "BULB", "BATTERY", "WIRE", "CABLE", "CLOCK", "TIMER"],
    "Hogar": ["CANDLE", "HOLDER", "CUSHION", "FRAME", "MIRROR", "VASE", "BASKET", "BOX", "STORAGE",
              "HOOK", "HANGER", "MAT", "BOTTLE", "JAR", "TIN"],
    "Cocina": ["CUP", "MUG", "BOWL", "PLATE", "GLASS", "SPOON", "FORK", "KNIFE", "TRAY", "CAKE",
               "BAKING", "KITCHEN", "PAN", "POT"],
    "Ropa": ["BAG", "PURSE", "WALLET", "SCARF", "HAT", "GLOVE", "APRON", "WRAP"],
    "Deportes": ["BALL", "SPORT", "FITNESS", "SWIM", "GOLF", "TENNIS"],
    "Papeleria": ["PEN", "PENCIL", "PAPER", "CARD", "NOTE", "BOOK", "DIARY", "RULER", "STAMP",
                  "STICKER", "TAG", "LABEL"],
    "Fiesta": ["PARTY", "CHRISTMAS", "BIRTHDAY", "WEDDING", "BALLOON", "BANNER", "RIBBON",
               "DECORATION", "ADVENT", "EASTER", "HALLOWEEN"],
    "Juguetes": ["TOY", "DOLL", "PUPPET", "PUZZLE", "PLAY"],
})
# -------------------------------------------------------------------------------------------


def read_keyword_map(spark: SparkSession, path: str) -> KeywordMap:
    """Read ``{"categories": {name: [words]}, "default": name}``; the order of names is kept.

    Read as a map and returned as its entries: schema inference would sort the names, and a map
    value loses its order on the way to Python. One small object.
    """
    schema = "categories map<string,array<string>>, `default` string"
    parsed = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("config"))
    config = parsed.select(F.map_entries("config.categories").alias("entries"), "config.default").first()
    return KeywordMap({e["key"]: e["value"] for e in config["entries"]}, config["default"] or DEFAULT_CATEGORY)
