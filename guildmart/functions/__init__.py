from guildmart.functions.dates import days_between, month_of, whole_years
from guildmart.functions.money import commission, mean_price, money
from guildmart.functions.text import building, building_digits, street, word

__all__ = [
    "building",
    "building_digits",
    "commission",
    "days_between",
    "mean_price",
    "money",
    "month_of",
    "street",
    "whole_years",
    "word",
]
