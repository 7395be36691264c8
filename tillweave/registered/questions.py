"""Keyword routing of questions and the reports behind each intent."""

from __future__ import annotations

from tillweave.operators import routing
from tillweave.plans import facts
from tillweave.registered import base as R
from tillweave.registered.base import count_of, mean, registered, total
from tillweave.sources import sample_tables as B

_REV, _PROFIT = "order_total_cost", "profit"

_QUESTIONS = """(SELECT 'turn-' || conv_id || '-' || turn AS question_id, text AS question
   FROM conversations WHERE role = 'user'
   UNION ALL
   SELECT 'part-' || p_partkey,
     replace(CASE p_partkey % 7
       WHEN 0 THEN 'Which state buys the %s most?'
       WHEN 1 THEN 'How many units of %s did we sell in Spring?'
       WHEN 2 THEN 'Was Fall good for the %s?'
       WHEN 3 THEN 'What kind of %s pays best?'
       WHEN 4 THEN 'Do women or men order the %s?'
       WHEN 5 THEN 'Is the %s on the menu for men?'
       ELSE 'How much did the %s bring in?' END, '%s', p_name)
   FROM part)"""


def _any(words: list[str]) -> str:
    return " OR ".join(f"contains(lower(question), '{w}')" for w in words)


# The keywords of each intent.
_INTENT = f"""CASE WHEN {_any(["state", "region", "where"])} THEN 'state'
     WHEN {_any(["item", "product", "food", "menu", "popular", "sell"])} THEN 'item'
     WHEN {_any(["season", "spring", "summer", "fall", "winter"])} THEN 'season'
     WHEN {_any(["category", "type", "kind"])} THEN 'category'
     WHEN {_any(["gender", "male", "female", "women", "men"])} THEN 'gender'
     ELSE 'default' END"""


@registered("qa_route", f"SELECT question_id, {_INTENT} AS intent FROM {_QUESTIONS}")
def qa_route(spark, sf_dir):
    return routing.route(B.questions(spark, sf_dir)).select("question_id", "intent")


def _report(name: str, sql: str) -> None:
    R.register_report(name, sql, projected=True)


_STATE_SQL = f"""SELECT r.restaurant_state, {total("o.profit", 3, 1)} AS profit_k,
          {total("o.order_total_cost", 3, 1)} AS revenue_k, {count_of("o.order_number")} AS orders
        FROM scen o JOIN places r ON o.restaurant_id = r.restaurant_id
        GROUP BY r.restaurant_state"""
_report("qa_state", _STATE_SQL + " ORDER BY profit_k DESC, restaurant_state LIMIT 10")

_ITEM_SQL = f"""SELECT item_description, chain, MIN(item_category) AS item_category,
          {R.UNITS} AS units_sold, {total(_PROFIT, 3, 1)} AS profit_k
        FROM scen GROUP BY item_description, chain"""
_report("qa_item", _ITEM_SQL + " ORDER BY units_sold DESC, item_description, chain LIMIT 10")

_SEASON_SQL = f"""SELECT season, chain, {total(_REV, 6)} AS revenue_m, {total(_PROFIT, 6)} AS profit_m
        FROM scen WHERE season IS NOT NULL GROUP BY season, chain"""
_report("qa_season", _SEASON_SQL)

_CATEGORY_SQL = f"""SELECT item_category, {total(_PROFIT, 6)} AS profit_m,
          {mean(_PROFIT)} AS avg_profit, {R.UNITS} AS units_sold
        FROM scen GROUP BY item_category"""
_report("qa_category", _CATEGORY_SQL)

_GENDER_SQL = f"""SELECT gender, chain, {total(_REV, 6)} AS revenue_m, {mean(_REV)} AS avg_order,
          COUNT(*) AS orders
        FROM scen GROUP BY gender, chain"""
_report("qa_gender", _GENDER_SQL)

_DEFAULT_SQL = f"""SELECT chain, {total(_REV, 6)} AS revenue_m, {total(_PROFIT, 6)} AS profit_m,
          {count_of("order_number")} AS orders, {mean(_REV)} AS avg_order
        FROM scen GROUP BY chain"""
_report("qa_default", _DEFAULT_SQL)


def _first(
    intent: str, source: str, label: str, name: str, detail: str, order: str, limit: int = 10**9
) -> str:
    return f"""SELECT '{intent}' AS intent, {label} AS top_label, '{name}' AS detail_name,
      {detail} AS detail_value,
      (SELECT least(COUNT(*), {limit}) FROM ({source})) AS shown_rows FROM (SELECT * FROM ({source}) ORDER BY {order} LIMIT 1)"""


_ANSWERS = "(" + " UNION ALL ".join(
    [
        _first("state", _STATE_SQL, "restaurant_state", "Profit K",
               "CAST(CAST(profit_k AS DECIMAL(28,1)) AS VARCHAR)", "profit_k DESC, restaurant_state", 10),
        _first("item", _ITEM_SQL, "item_description", "Category", "item_category",
               "units_sold DESC, item_description, chain", 10),
        _first("season", _SEASON_SQL, "season", "Chain", "chain", "revenue_m DESC, season, chain"),
        _first("category", _CATEGORY_SQL, "item_category", "Profit M",
               "CAST(CAST(profit_m AS DECIMAL(28,2)) AS VARCHAR)", "profit_m DESC, item_category"),
        _first("gender", _GENDER_SQL, "gender", "Chain", "chain", "gender, chain"),
        _first("default", _DEFAULT_SQL, "chain", "Revenue M",
               "CAST(CAST(revenue_m AS DECIMAL(28,2)) AS VARCHAR)", "chain"),
    ]
) + ")"


@registered(
    "qa_insight",
    f"""SELECT q.question_id, q.intent,
          'Top ' || q.intent || ': ' || a.top_label || ' (' || a.detail_name || ' '
            || a.detail_value || ')' AS insight,
          a.shown_rows, (SELECT COUNT(*) FROM scen) AS total_rows
        FROM (SELECT question_id, {_INTENT} AS intent FROM {_QUESTIONS}) q
        LEFT JOIN {_ANSWERS} a ON a.intent = q.intent""",
)
def qa_insight(spark, sf_dir):
    columns = ["restaurant_id", "item_description", "chain", "item_category", "season", "gender",
               "quantity", _REV, _PROFIT]
    star = R.dataset(spark, sf_dir, columns, projected=True, located=True)
    routed = routing.route(B.questions(spark, sf_dir))
    answered = routing.answer(routed, facts.top_answers(star))
    return answered.select("question_id", "intent", "insight", "shown_rows", "total_rows")
