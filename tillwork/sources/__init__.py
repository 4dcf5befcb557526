"""Where the relations come from."""
from tillwork.sources.shop import CsvShop, Shop, StarShop

__all__ = ["CsvShop", "Shop", "StarShop"]
