"""Reports answered from stored cubes instead of the order lines.

Each gives the rows of the report it is named after, so it shares that report's
SQL.  The cubes are stored by the first query that needs them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tillweave.operators.cube import Cube, write_cube
from tillweave.operators.star import Star
from tillweave.plans import shaped
from tillweave.plans.catalogue import CATALOGUE
from tillweave.plans.report import run_report
from tillweave.registered import base as R
from tillweave.session import ON_CLEAR, folder_state, scratch_path
from tillweave.sources.sample_tables import DEFAULT_SELECTION as PICK

MEASURES = ("order_total_cost", "profit", "quantity", "menu_price")
#: Keys and sets of each dataset's cubes: by site, and on the projected dataset by product.
BASE = ((("chain", "restaurant_id"), ("order_number", "customer_id")),)
PROJECTED = (
    ((*PICK, "restaurant_id"), ("order_number",)),
    ((*PICK, "item_description", "item_category"), ()),
)

_CUBES: dict[tuple, tuple[Cube, ...]] = {}
ON_CLEAR.append(_CUBES.clear)


def cubed_star(spark: SparkSession, sf_dir: str, projected: bool = False) -> Star:
    """The dataset with its cubes, which are stored once per application and state of the tables."""
    key = (spark.sparkContext.applicationId, sf_dir, projected, folder_state(spark, sf_dir))
    plans = PROJECTED if projected else BASE
    columns = {*MEASURES, *(c for keys, members in plans for c in (*keys, *members))}
    star = R.dataset(spark, sf_dir, columns, projected, located=True)
    if key not in _CUBES:
        _CUBES[key] = tuple(
            write_cube(star.orders, keys, MEASURES, members, scratch_path(spark, "cube"))
            for keys, members in plans
        )
    return replace(star, cubes=_CUBES[key])


def _register(
    name: str, like: str, projected: bool, answer: Callable[[Star], DataFrame]
) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return answer(cubed_star(spark, sf_dir, projected))

    R.registered(name, R.SQL[like].removeprefix(R.PRELUDE))(run)


def _picked(name: str) -> Callable[[Star], DataFrame]:
    return lambda star: run_report(CATALOGUE[name], star, PICK)


_register(
    "cube_summary_stats",
    "report_summary_stats",
    False,
    lambda star: run_report(CATALOGUE["report_summary_stats"], star),
)
for _name in ("kpis", "chain", "category_chain", "top_products", "product_table", "top_states"):
    _register(f"cube_{_name}", f"dash_{_name}", True, _picked(f"dash_{_name}"))
_register("cube_kpi_cards", "dash_kpi_cards", True, lambda star: shaped.kpi_cards(star, PICK))
_register("cube_season", "dash_season", True, lambda star: shaped.dash_season(star, PICK))
_register("cube_state_table", "dash_state_table", True, lambda star: shaped.dash_state_table(star, PICK))
_register(
    "cube_state_answers", "qa_state", True, lambda star: run_report(CATALOGUE["qa_state"], star)
)
