"""Table specifications: what the standardiser does to each table, as data.

A new table is a new ``TableSpec`` value; ``larder.operators.clean.standardize`` interprets it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    text: dict[str, str] = field(default_factory=dict)          # column -> default text
    numeric: dict[str, int | float] = field(default_factory=dict)  # column -> default number
    timestamps: tuple[str, ...] = ()                             # text -> timestamp, + _date, _hour
    accents: tuple[str, ...] = ()                                # accent / symbol removal
    ids: tuple[str, ...] = ()                                    # identifiers, never touched
    schema: T.StructType | None = None                           # raw (on-disk) schema


def _raw(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


_S, _L = T.StringType(), T.LongType()

# The five tables of the order star and their cleaning rules.
DISH = TableSpec(
    name="dish",
    text={"dish_name": "unknown"},
    numeric={"price": 0},
    accents=("dish_name",),
    ids=("dish_id",),
    schema=_raw(("dish_id", _L), ("dish_name", _S), ("price", _S)),
)

DISH_DETAIL = TableSpec(
    name="dish_detail",
    text={"ingredient_name": "unknown", "unit": "unknown"},
    numeric={"quantity": 0},
    accents=("ingredient_name",),
    ids=("id", "dish_id", "ingredient_id"),
    schema=_raw(("id", _L), ("dish_id", _L), ("ingredient_id", _L), ("ingredient_name", _S),
                ("quantity", _S), ("unit", _S)),
)

INGREDIENT = TableSpec(
    name="ingredient",
    text={"ingredient_name": "unknown"},
    accents=("ingredient_name",),
    ids=("id", "ingredient_id"),
    schema=_raw(("id", _L), ("ingredient_id", _L), ("ingredient_name", _S)),
)

ORDER = TableSpec(
    name="order",
    numeric={"total_price": 0, "quantity": 0},
    timestamps=("time",),
    ids=("order_id",),
    schema=_raw(("order_id", _L), ("time", _S), ("total_price", _S), ("quantity", _S)),
)

ORDER_DETAIL = TableSpec(
    name="order_detail",
    text={"dish_name": "unknown"},
    numeric={"quantity": 0, "price": 0},
    accents=("dish_name",),
    ids=("id", "order_id", "dish_id"),
    schema=_raw(("id", _L), ("order_id", _L), ("dish_id", _L), ("dish_name", _S),
                ("quantity", _S), ("price", _S)),
)
