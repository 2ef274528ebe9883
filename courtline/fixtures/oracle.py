"""The registered queries as plain SQL over the same tables.

Written separately from the DataFrame code: row-level windows and CASE chains
in place of pre-aggregation, JSON and joins of documents.
"""

from __future__ import annotations

from courtline import wording as w
from courtline.fixtures import tpch

_N = "(SELECT count(*) FROM supplier)"

_TEAM_STATS = """
fx_team_stats AS (
  SELECT s_name AS team_name, s_suppkey AS team_id, count(*) AS n,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 500 AS pts,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 2500 AS opp_pts,
         CAST(count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) / count(*) AS w_pct,
         CAST(count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS DOUBLE) / count(*) AS fg_pct,
         CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / count(*) * 7 AS fg3_pct,
         CAST(count(CASE WHEN l_linestatus = 'O' THEN 1 END) AS DOUBLE) / count(*) AS opp_fg_pct,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS assists,
         CAST(sum(l_linenumber) AS DOUBLE) / count(*) * 4 AS opp_tov
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY s_name, s_suppkey),
fx_rated AS (
  SELECT *, 10 * (pts - opp_pts - 5) AS plus_minus,
         pts * 0.4E0 + fg_pct * 100 * 0.3E0 + fg3_pct * 100 * 0.15E0 + assists * 2 * 0.15E0 AS off_rating,
         100 - opp_pts * 0.4E0 + (1 - opp_fg_pct) * 100 * 0.4E0 + opp_tov * 3 * 0.2E0 AS def_rating
  FROM fx_team_stats),
ratings AS (
  SELECT *, w_pct * 100 * 0.25E0 + plus_minus * 2 * 0.2E0 + off_rating * 0.3E0 + def_rating * 0.25E0 AS power
  FROM fx_rated)"""

_PRICES = """
         CASE WHEN l_returnflag <> 'R' THEN (l_quantity - 25) / 2.5E0 END AS spread,
         CASE WHEN l_linestatus = 'O' THEN (l_discount * 100 - 5) * 40 END AS away_moneyline,
         CASE WHEN l_linenumber % 3 <> 0 THEN (5 - l_discount * 100) * 40 END AS home_moneyline,
         CASE WHEN NOT (l_returnflag = 'A' AND l_linestatus = 'F') THEN 180 + l_tax * 500 END AS total"""

_BEST = f"""
fx_offers AS (
  SELECT l_orderkey AS event_id, l_linenumber, l_partkey, l_suppkey,{_PRICES}
  FROM lineitem),
fx_counted AS (
  SELECT *, CASE WHEN spread IS NULL THEN 0 ELSE 1 END + CASE WHEN away_moneyline IS NULL THEN 0 ELSE 1 END
         + CASE WHEN home_moneyline IS NULL THEN 0 ELSE 1 END + CASE WHEN total IS NULL THEN 0 ELSE 1 END AS n_fields
  FROM fx_offers),
fx_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY event_id
           ORDER BY n_fields DESC, l_linenumber, l_partkey, l_suppkey) AS choice
  FROM fx_counted),
best AS (SELECT * FROM fx_numbered WHERE choice = 1)"""

_GAMES = f"""{_BEST},
games AS (
  SELECT o_orderkey AS event_id, 'NBA' AS sport, CAST(o_orderdate AS DATE) AS event_date,
         CASE WHEN o_orderkey % 23 = 0 THEN 'Unknown'
              ELSE concat('Supplier#', lpad(CAST((o_custkey + o_orderkey) % {_N} AS VARCHAR), 9, '0')) END AS away_team,
         concat('Supplier#', lpad(CAST(o_custkey % {_N} AS VARCHAR), 9, '0')) AS home_team,
         spread, away_moneyline, home_moneyline, total
  FROM orders JOIN best ON o_orderkey = event_id)"""

_PREDICTIONS = f"""{_TEAM_STATS},{_GAMES},
matchups AS (
  SELECT g.*,
         a.power AS away_power_rating, a.off_rating AS away_offensive, a.def_rating AS away_defensive,
         a.pts AS away_avg_pts, a.opp_pts AS away_avg_opp_pts,
         h.power AS home_power_rating, h.off_rating AS home_offensive, h.def_rating AS home_defensive,
         h.pts AS home_avg_pts, h.opp_pts AS home_avg_opp_pts
  FROM games g LEFT JOIN ratings a ON g.away_team = a.team_name
               LEFT JOIN ratings h ON g.home_team = h.team_name),
margins AS (
  SELECT *, (home_power_rating - away_power_rating) / 10 + 3.0E0 AS predicted_point_diff,
         (away_avg_pts + home_avg_opp_pts) / 2 + (home_avg_pts + away_avg_opp_pts) / 2 AS predicted_total_points
  FROM matchups),
chances AS (
  SELECT *, 1 / (1 + exp(-predicted_point_diff / 10)) AS home_win_probability,
         1 - 1 / (1 + exp(-predicted_point_diff / 10)) AS away_win_probability
  FROM margins),
priced AS (
  SELECT *,
         CASE WHEN home_win_probability > 0.5 THEN -100 * home_win_probability / nullif(1 - home_win_probability, 0)
              ELSE 100 * (1 - home_win_probability) / nullif(home_win_probability, 0) END AS predicted_home_moneyline,
         CASE WHEN away_win_probability > 0.5 THEN -100 * away_win_probability / nullif(1 - away_win_probability, 0)
              ELSE 100 * (1 - away_win_probability) / nullif(away_win_probability, 0) END AS predicted_away_moneyline,
         predicted_point_diff + spread AS spread_difference,
         total - predicted_total_points AS total_difference
  FROM chances),
flagged AS (
  SELECT *, home_moneyline - predicted_home_moneyline AS home_ml_difference,
         away_moneyline - predicted_away_moneyline AS away_ml_difference,
         CASE WHEN spread_difference > 3 THEN '{w.SPREAD_HOME}'
              WHEN spread_difference < -3 THEN '{w.SPREAD_AWAY}' ELSE 'NO VALUE' END AS spread_recommendation,
         CASE WHEN total_difference > 5 THEN '{w.TOTAL_UNDER}'
              WHEN total_difference < -5 THEN '{w.TOTAL_OVER}' ELSE 'NO VALUE' END AS total_recommendation,
         CASE WHEN home_win_probability > 0.55 AND home_moneyline > 0 THEN '{w.MONEYLINE_HOME}'
              WHEN away_win_probability > 0.55 AND away_moneyline > 0 THEN '{w.MONEYLINE_AWAY}'
              ELSE 'NO VALUE' END AS moneyline_recommendation
  FROM priced)"""


def _r(expression: str, digits: int, name: str | None = None) -> str:
    """Rounded, without a negative zero."""
    return f"round({expression}, {digits}) + 0.0E0 AS {name or expression}"


_PUBLISHED_COLUMNS = ", ".join([
    "sport", "away_team", "home_team", _r("spread", 1, "sportsbook_spread"), "away_moneyline", "home_moneyline",
    _r("total", 1, "sportsbook_total"), _r("predicted_point_diff", 1, "predicted_spread"),
    _r("predicted_away_moneyline", 0, "predicted_away_ml"), _r("predicted_home_moneyline", 0, "predicted_home_ml"),
    _r("predicted_total_points", 1, "predicted_total"), _r("away_win_probability", 3, "away_win_prob"),
    _r("home_win_probability", 3, "home_win_prob"), _r("away_power_rating", 1, "away_power"),
    _r("home_power_rating", 1, "home_power"), _r("spread_difference", 1, "spread_diff"),
    _r("total_difference", 1, "total_diff"), *w.FLAG_COLUMNS,
])

_ANY_VALUE = " OR ".join(f"{c} <> 'NO VALUE'" for c in w.FLAG_COLUMNS)

# Team names of the mapping are single words, so nickname = name.
_PUBLISHED = f"""{_PREDICTIONS},
published AS (
  SELECT event_id, {_PUBLISHED_COLUMNS} FROM flagged),
labelled AS (
  SELECT *, away_team AS away_short, home_team AS home_short, away_team || ' @ ' || home_team AS matchup
  FROM published)"""

_GAME_LOG = """
log AS (
  SELECT c_nationkey AS team_id, o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date,
         CASE o_orderstatus WHEN 'F' THEN 'W' WHEN 'O' THEN 'L' END AS wl,
         o_totalprice / 2500 AS pts, (o_totalprice - 250000) / 10000 AS plus_minus
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

_DOC_LOG = """
doc_log AS (
  SELECT o_custkey % 25 AS team_id, o_orderkey * 2 AS game_id,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS game_date,
         CASE o_orderstatus WHEN 'F' THEN 'W' WHEN 'O' THEN 'L' END AS wl,
         o_totalprice / 2500 AS pts,
         CASE WHEN o_orderkey % 7 <> 0 THEN (o_totalprice - 250000) / 10000 END AS plus_minus
  FROM orders
  UNION ALL
  SELECT o_custkey % 25, o_orderkey * 2 + 1, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER),
         CASE o_orderstatus WHEN 'F' THEN 'L' WHEN 'O' THEN 'W' END,
         o_totalprice / 2500,
         CASE WHEN o_orderkey % 7 <> 0 THEN -((o_totalprice - 250000) / 10000) END
  FROM orders)"""


def _rested(log: str, order: str = "game_date") -> str:
    return f"""
gaps AS (
  SELECT *, game_date - lag(game_date) OVER (PARTITION BY team_id ORDER BY {order}, game_id) - 1 AS days_rest
  FROM {log} WHERE game_date IS NOT NULL),
rested AS (
  SELECT *, CASE WHEN days_rest IN (0, 1, 2, 3) THEN CAST(days_rest AS VARCHAR)
                 WHEN days_rest IS NOT NULL THEN '4+' END AS rest_bucket
  FROM gaps)"""


_DAYS_REST = """
SELECT CAST(team_id AS BIGINT) AS team_id, game_id, CAST(days_rest AS DOUBLE) AS days_rest, rest_bucket
FROM rested"""

_TEXT_DAY = "upper(strftime(game_date, '%b %d, %Y'))"

_REST_AGGREGATES = {
    "GP": "count({x})", "W": "count(CASE WHEN wl = 'W' THEN {x} END)",
    "L": "count({x}) - count(CASE WHEN wl = 'W' THEN {x} END)",
    "W_PCT": "round(CAST(count(CASE WHEN wl = 'W' THEN {x} END) AS DOUBLE) / nullif(count({x}), 0), 4) + 0.0E0",
    "PTS": "round(sum(CASE WHEN {x} = 1 THEN coalesce(pts, 0) END) / nullif(count({x}), 0), 4) + 0.0E0",
    "PLUS_MINUS": "round(sum(CASE WHEN {x} = 1 THEN coalesce(plus_minus, 0) END) / nullif(count({x}), 0), 4) + 0.0E0",
}


def _pivot() -> str:
    columns = []
    for bucket in w.REST_BUCKETS:
        inside = f"CASE WHEN rest_bucket = '{bucket}' THEN 1 END"
        for metric, sql in _REST_AGGREGATES.items():
            columns.append(f"coalesce({sql.format(x=inside)}, 0) AS {w.rest_column(bucket, metric)}")
    return ",\n".join(columns)


_DOC_OUTCOME = f"""{_BEST},
listed AS (
  SELECT o.*, CAST(CAST(o_orderdate AS DATE) + (o_orderkey % 24) * INTERVAL 1 HOUR - INTERVAL 5 HOUR AS DATE) AS local_day,
         o_custkey % 25 AS home_id, (o_custkey + 1 + o_orderkey % 24) % 25 AS away_id, b.choice,
         b.spread, b.away_moneyline, b.home_moneyline, b.total
  FROM orders o LEFT JOIN best b ON o_orderkey = b.event_id)"""


def _outcome(wrong_date: str) -> str:
    return f"""CASE WHEN o_orderkey % 41 = 0 THEN 'no_competition'
              WHEN o_orderkey % 43 = 0 THEN 'no_date'
              WHEN {wrong_date} THEN 'wrong_date'
              WHEN o_orderkey % 47 = 0 THEN 'error'
              WHEN o_orderkey % 37 = 0 OR choice IS NULL THEN 'no_odds'
              ELSE 'game' END"""


_OTHER_DATE = "local_day < DATE '1996-01-01' OR local_day > DATE '1999-12-31'"


def _text(sql: str) -> str:
    """A constant text template as an SQL literal."""
    return "'" + sql.replace("'", "''") + "'"


def _points(value: str, signed: bool = False) -> str:
    plus = "+" if signed else ""
    return f"CASE WHEN {value} IS NULL THEN '{plus}nan' ELSE printf('%{plus}.1f', {value}) END"


def _whole(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '+nan' ELSE printf('%+.0f', {value}) END"


def _percent(value: str, digits: int) -> str:
    return f"CASE WHEN {value} IS NULL THEN 'nan%' ELSE printf('%.{digits}f%%', {value} * 100) END"


def _fmt(template: str, *arguments: str) -> str:
    return f"printf({_text(template)}, {', '.join(arguments)})"


_SHEET = f"""{_PUBLISHED},
sheet AS (
  SELECT *, away_team || ' @ ' || home_team AS full_matchup,
         CASE spread_recommendation WHEN '{w.SPREAD_HOME}' THEN home_short WHEN '{w.SPREAD_AWAY}' THEN away_short
              ELSE 'No Value' END AS spread_bet,
         CASE spread_recommendation WHEN '{w.SPREAD_HOME}' THEN sportsbook_spread
              WHEN '{w.SPREAD_AWAY}' THEN -sportsbook_spread END AS spread_line,
         CASE WHEN spread_recommendation = 'NO VALUE' THEN '' WHEN abs(spread_diff) > 10 THEN 'STRONG'
              ELSE 'VALUE' END AS spread_strength,
         CASE WHEN spread_recommendation <> 'NO VALUE' THEN abs(spread_diff) END AS spread_edge,
         CASE total_recommendation WHEN '{w.TOTAL_OVER}' THEN 'OVER' WHEN '{w.TOTAL_UNDER}' THEN 'UNDER'
              ELSE 'No Value' END AS total_bet,
         CASE WHEN total_recommendation <> 'NO VALUE' THEN sportsbook_total END AS total_line,
         CASE WHEN total_recommendation = 'NO VALUE' THEN '' WHEN abs(total_diff) > 8 THEN 'STRONG'
              ELSE 'VALUE' END AS total_strength,
         CASE WHEN total_recommendation <> 'NO VALUE' THEN abs(total_diff) END AS total_edge,
         CASE moneyline_recommendation WHEN '{w.MONEYLINE_HOME}' THEN home_short
              WHEN '{w.MONEYLINE_AWAY}' THEN away_short ELSE 'No Value' END AS moneyline_bet,
         CASE moneyline_recommendation WHEN '{w.MONEYLINE_HOME}' THEN home_moneyline
              WHEN '{w.MONEYLINE_AWAY}' THEN away_moneyline END AS moneyline_price,
         CASE moneyline_recommendation WHEN '{w.MONEYLINE_HOME}' THEN home_win_prob
              WHEN '{w.MONEYLINE_AWAY}' THEN away_win_prob END AS moneyline_win_prob,
         CASE WHEN moneyline_recommendation <> 'NO VALUE' THEN 'VALUE' ELSE '' END AS moneyline_strength
  FROM labelled)"""

_IMPLIED = "CASE WHEN {ml} < 0 THEN -{ml} / nullif(100 - {ml}, 0) ELSE 100.0E0 / nullif({ml} + 100, 0) END"
_PAYOUT = "100 + CASE WHEN {ml} > 0 THEN {ml} ELSE 10000.0E0 / nullif(abs({ml}), 0) END"

_VALUE_BETS = f"""{_PUBLISHED},
bets AS (
  SELECT event_id, matchup, 'spread' AS bet_type, spread_recommendation AS recommendation,
         round(abs(spread_diff), 1) AS edge FROM labelled
  UNION ALL
  SELECT event_id, matchup, 'total', total_recommendation, round(abs(total_diff), 1) FROM labelled
  UNION ALL
  SELECT event_id, matchup, 'moneyline', moneyline_recommendation,
         round((CASE moneyline_recommendation WHEN '{w.MONEYLINE_HOME}'
                THEN home_win_prob - {_IMPLIED.format(ml="home_moneyline")}
                ELSE away_win_prob - {_IMPLIED.format(ml="away_moneyline")} END) * 100, 1) + 0.0E0
  FROM labelled),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY bet_type ORDER BY edge DESC NULLS LAST, event_id) AS rank
  FROM bets WHERE recommendation <> 'NO VALUE')"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _select(ctes: str, table: str, *columns: str) -> str:
    return _with(ctes, f"SELECT {', '.join(columns)} FROM {table}")


_CARD_SPREAD_LINE = f"{_points('spread_line', True)}"
_BOOK_SPREAD, _BOOK_TOTAL = _points("sportsbook_spread", True), _points("sportsbook_total")
_CHOSEN = _whole("moneyline_price")

_CARDS = {
    "info": _fmt(w.CARD_INFO, "away_short", _points("away_power"), "home_short", _points("home_power"),
                 "away_short", _percent("away_win_prob", 1), "home_short", _percent("home_win_prob", 1)),
    "spread": f"""CASE spread_recommendation
      WHEN '{w.SPREAD_HOME}' THEN {_fmt(
        w.CARD_SPREAD_HOME, "home_short", _CARD_SPREAD_LINE, "home_short", _points("abs(spread_line)"),
        "home_short", _BOOK_SPREAD, "home_short", _points("predicted_spread"), _points("abs(spread_diff)"),
        "home_short")}
      WHEN '{w.SPREAD_AWAY}' THEN {_fmt(
        w.CARD_SPREAD_AWAY, "away_short", _CARD_SPREAD_LINE, "away_short", _points("abs(spread_line)"),
        "away_short", _CARD_SPREAD_LINE, "home_short", _BOOK_SPREAD, "home_short", _points("predicted_spread"),
        _points("abs(spread_diff)"), "away_short")}
      ELSE {_fmt(w.CARD_SPREAD_NONE, "home_short", _BOOK_SPREAD, "home_short",
                 _points("predicted_spread", True), _points("abs(spread_diff)"))} END""",
    "total": f"""CASE WHEN total_recommendation <> 'NO VALUE' THEN {_fmt(
        w.CARD_TOTAL_BET, "total_bet", _BOOK_TOTAL,
        "CASE total_bet WHEN 'OVER' THEN 'MORE' ELSE 'LESS' END", _BOOK_TOTAL, _BOOK_TOTAL,
        _points("predicted_total"), _points("abs(total_diff)"),
        "CASE total_bet WHEN 'OVER' THEN 'higher-scoring' ELSE 'lower-scoring' END")}
      ELSE {_fmt(w.CARD_TOTAL_NONE, _BOOK_TOTAL, _points("predicted_total"), _points("abs(total_diff)"))} END""",
    "moneyline": f"""CASE WHEN moneyline_recommendation <> 'NO VALUE' THEN {_fmt(
        w.CARD_MONEYLINE_BET, "moneyline_bet", _CHOSEN, "moneyline_bet", _CHOSEN,
        f"printf('$%.0f on a $100 bet', {_PAYOUT.format(ml='moneyline_price')})",
        _percent("moneyline_win_prob", 1), "moneyline_bet")}
      ELSE {_fmt(w.CARD_MONEYLINE_NONE, "away_short", _whole("away_moneyline"), _percent("away_win_prob", 1),
                 "home_short", _whole("home_moneyline"), _percent("home_win_prob", 1))} END""",
}


def oracle_sql() -> dict[str, str]:
    predicted, published = _PREDICTIONS, _PUBLISHED
    nickname = r"regexp_extract(trim({x}), '(\S+)$', 1)"
    team_sql = ", ".join(f"{sql} AS {c}" for c, sql in tpch.BASE_FORMULAS.items())
    opponent_sql = ", ".join(
        f"CASE WHEN team_id % 6 <> 5 THEN {sql if c != 'OPP_FT_PCT' else f'CASE WHEN team_id % 4 = 1 THEN 0 ELSE {sql} END'} "
        f"END AS {c}" for c, sql in tpch.OPPONENT_FORMULAS.items())
    return {
        "latest_snapshot": """
            WITH s AS (SELECT event_id, event_type AS sport, date_trunc('day', ts) AS snapshot_ts, value FROM events)
            SELECT event_id, sport, CAST(CAST(snapshot_ts AS TIMESTAMP) AS VARCHAR) AS snapshot_ts, value FROM s
            WHERE (sport, snapshot_ts) IN (SELECT sport, max(snapshot_ts) FROM s GROUP BY sport)""",
        "json_header_rowset": _with(_DOC_LOG, """
            SELECT team_id AS TEAM_ID, game_id,
                   CASE WHEN game_date IS NULL THEN ''
                        ELSE upper(strftime(game_date, '%b ')) || CAST(day(game_date) AS VARCHAR)
                             || strftime(game_date, ', %Y') END AS game_date_text,
                   wl, pts, plus_minus FROM doc_log"""),
        "json_row_map": _with(_DOC_LOG, """
            SELECT 'Team_ID' AS key, count(*) AS n, count(team_id) AS n_values FROM doc_log
            UNION ALL SELECT 'Game_ID', count(*), count(game_id) FROM doc_log
            UNION ALL SELECT 'GAME_DATE', count(*), count(*) FROM doc_log
            UNION ALL SELECT 'WL', count(*), count(wl) FROM doc_log
            UNION ALL SELECT 'PTS', count(*), count(pts) FROM doc_log
            UNION ALL SELECT 'PLUS_MINUS', count(plus_minus), count(plus_minus) FROM doc_log"""),
        "json_nested_defaults": """
            SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS INTEGER), 0) AS k,
                   coalesce(json_extract_string(props, '$.name'), 'Unknown') AS name,
                   CASE WHEN json_extract(props, '$.odds.moneyLine') IS NULL THEN 1 ELSE 0 END AS no_moneyline
            FROM events""",
        "power_rating": _select(_TEAM_STATS, "ratings", "team_name AS TEAM_NAME",
                                _r("off_rating", 6, "offensive_rating"), _r("def_rating", 6, "defensive_rating"),
                                _r("power", 6, "power_rating")),
        "top_teams": _with(_TEAM_STATS, f"""
            SELECT team_name AS TEAM_NAME, {_r("power", 1, "power_rating")} FROM ratings
            ORDER BY round(power, 1) DESC NULLS LAST, team_name LIMIT 5"""),
        "matchup_join": _select(predicted, "matchups", "event_id", "away_team", "home_team", *(
            _r(f"{side}_{c}", 6) for side in ("away", "home")
            for c in ("power_rating", "offensive", "defensive", "avg_pts", "avg_opp_pts"))),
        "matchup_predictions": _select(predicted, "flagged", "event_id", *(_r(c, 6) for c in (
            "predicted_point_diff", "predicted_total_points", "home_win_probability", "away_win_probability",
            "spread_difference", "total_difference"))),
        "american_odds": _select(predicted, "flagged", "event_id", _r("predicted_home_moneyline", 4),
                                 _r("predicted_away_moneyline", 4)),
        "moneyline_difference": _select(predicted, "flagged", "event_id", _r("home_ml_difference", 4),
                                        _r("away_ml_difference", 4)),
        "value_flags": _select(predicted, "flagged", "event_id", *w.FLAG_COLUMNS),
        "ponderations": _select(predicted, "flagged", _PUBLISHED_COLUMNS),
        "ponderations_round_trip": _select(predicted, "flagged", _PUBLISHED_COLUMNS),
        "odds_table_round_trip": _with(_GAMES, """
          SELECT CASE event_id % 4 WHEN 0 THEN 'NBA' WHEN 1 THEN 'WNBA' WHEN 2 THEN 'a+b' ELSE 'a b' END AS sport,
                 away_team, home_team, spread, away_moneyline, home_moneyline, total,
                 CASE WHEN event_id % 4 < 2 THEN '20251109_1200' ELSE '20251108_1200' END AS snapshot
          FROM games"""),
        "team_stats_round_trip": _with(_TEAM_STATS, f"""
            SELECT team_name AS TEAM_NAME, team_id AS TEAM_ID, {_r("pts", 6, "PTS")}, {_r("w_pct", 6, "W_PCT")},
                   CAST(NULL AS DOUBLE) AS REB FROM fx_team_stats"""),
        "value_games": _with(published, f"SELECT * FROM published WHERE {_ANY_VALUE}"),
        "opportunity_summary": _with(predicted, f"""
            SELECT count(*) AS total_games, count(CASE WHEN {_ANY_VALUE} THEN 1 END) AS value_games,
                   count(CASE WHEN spread_recommendation <> 'NO VALUE' THEN 1 END) AS spread_opportunities,
                   count(CASE WHEN total_recommendation <> 'NO VALUE' THEN 1 END) AS total_opportunities,
                   count(CASE WHEN moneyline_recommendation <> 'NO VALUE' THEN 1 END) AS moneyline_opportunities
            FROM flagged"""),
        "recommendation_summary": _select(predicted, "flagged", "event_id", "away_team", "home_team",
                                          _r("predicted_point_diff", 1, "predicted_spread"),
                                          _r("spread", 1, "sportsbook_spread"), *w.FLAG_COLUMNS),
        "row_counts": _with(_TEAM_STATS + "," + _GAMES, """
            SELECT 'teams' AS name, count(*) AS n FROM fx_team_stats
            UNION ALL SELECT 'games', count(*) FROM games"""),
        "best_provider": _select(_BEST, "best", "event_id", "l_linenumber", "l_partkey", "l_suppkey", "spread",
                                 "away_moneyline", "home_moneyline", "total", "CAST(n_fields AS BIGINT) AS n_fields"),
        "home_away_roles": """
            SELECT '/competitions/' || o_orderkey AS url,
                   '/teams/' || ((o_custkey + 1 + o_orderkey % 24) % 25) AS away_ref,
                   '/teams/' || (o_custkey % 25) AS home_ref
            FROM orders WHERE o_orderkey % 47 <> 0""",
        "ref_dereference": _with(_DOC_OUTCOME, f"""
            SELECT 'NBA' AS sport, '/events/' || o_orderkey AS event_url, CAST(local_day AS VARCHAR) AS event_date,
                   CASE WHEN away_id = 13 THEN 'Unknown' ELSE a.n_name END AS away_team,
                   CASE WHEN home_id = 13 THEN 'Unknown' ELSE h.n_name END AS home_team,
                   spread, away_moneyline, home_moneyline, total
            FROM listed JOIN nation a ON away_id = a.n_nationkey JOIN nation h ON home_id = h.n_nationkey
            WHERE {_outcome("false")} = 'game'"""),
        "event_disposition": _with(_DOC_OUTCOME, f"""
            SELECT {_outcome(_OTHER_DATE)} AS disposition,
                   count(*) AS n
            FROM listed GROUP BY 1"""),
        "landed_window": _with(_DOC_OUTCOME, f"""
            SELECT 'NBA' AS sport, '/events/' || o_orderkey AS event_url, CAST(local_day AS VARCHAR) AS event_date,
                   CASE WHEN away_id = 13 THEN 'Unknown' ELSE a.n_name END AS away_team,
                   CASE WHEN home_id = 13 THEN 'Unknown' ELSE h.n_name END AS home_team,
                   spread, away_moneyline, home_moneyline, total
            FROM listed JOIN nation a ON away_id = a.n_nationkey JOIN nation h ON home_id = h.n_nationkey
            WHERE {_outcome(_OTHER_DATE)} = 'game'"""),
        "outcomes_round_trip": _with(_DOC_OUTCOME, f"""
            SELECT '/events/' || o_orderkey AS event_url, {_outcome(_OTHER_DATE)} AS disposition,
                   CASE {_outcome(_OTHER_DATE)}
                     WHEN 'no_competition' THEN 'event without competitions' WHEN 'no_date' THEN 'event without date'
                     WHEN 'wrong_date' THEN 'event of another date' WHEN 'error' THEN 'competition missing or unreadable'
                     WHEN 'no_odds' THEN CASE WHEN o_orderkey % 37 = 0 THEN 'competition without odds'
                                              ELSE 'odds without offers' END END AS reason,
                   CASE WHEN {_outcome(_OTHER_DATE)} IN ('game', 'no_odds')
                        THEN CASE WHEN away_id = 13 THEN 'Unknown' ELSE a.n_name END END AS away_team,
                   CASE WHEN {_outcome(_OTHER_DATE)} IN ('game', 'no_odds')
                        THEN CASE WHEN home_id = 13 THEN 'Unknown' ELSE h.n_name END END AS home_team,
                   CASE WHEN {_outcome(_OTHER_DATE)} = 'game' THEN spread END AS spread,
                   CASE WHEN {_outcome(_OTHER_DATE)} = 'game' THEN total END AS total
            FROM listed JOIN nation a ON away_id = a.n_nationkey JOIN nation h ON home_id = h.n_nationkey"""),
        "quarantine_round_trip": _with(_DOC_OUTCOME, f"""
            SELECT '/events/' || o_orderkey AS event_url, 'competition missing or unreadable' AS reason,
                   '/competitions/' || o_orderkey AS document_url, '{{"competitors": [' AS body
            FROM listed WHERE {_outcome(_OTHER_DATE)} = 'error'"""),
        "events_on_local_date": """
            SELECT event_id, event_type, CAST(CAST(ts - INTERVAL 5 HOURS AS DATE) AS VARCHAR) AS local_date
            FROM events WHERE CAST(ts - INTERVAL 5 HOURS AS DATE) = DATE '2024-01-15'""",
        "event_date_range": """
            SELECT CAST(min(CAST(ts - INTERVAL 5 HOURS AS DATE)) AS VARCHAR) AS first_date,
                   CAST(max(CAST(ts - INTERVAL 5 HOURS AS DATE)) AS VARCHAR) AS last_date
            FROM events""",
        "next_game_day": """
            WITH e AS (SELECT event_id, event_type AS sport, CAST(ts - INTERVAL 5 HOURS AS DATE) AS d FROM events),
            near AS (SELECT * FROM e WHERE d BETWEEN DATE '2023-12-30' AND DATE '2024-01-01')
            SELECT event_id, sport, CAST(d AS VARCHAR) AS event_date FROM near
            WHERE d = (SELECT min(d) FROM near n WHERE n.sport = near.sport)""",
        "days_rest": _with(_GAME_LOG + "," + _rested("log"), _DAYS_REST),
        "days_rest_text_order": _with(_GAME_LOG + "," + _rested("log", _TEXT_DAY), _DAYS_REST),
        "rest_splits": _with(_GAME_LOG + "," + _rested("log"), f"""
            SELECT CAST(team_id AS BIGINT) AS team_id, rest_bucket,
                   {", ".join(f"{sql.format(x='CASE WHEN rest_bucket IS NOT NULL THEN 1 END')} AS {m}"
                              for m, sql in _REST_AGGREGATES.items())}
            FROM rested WHERE rest_bucket IS NOT NULL GROUP BY team_id, rest_bucket"""),
        "rest_splits_kept": _with(_GAME_LOG + "," + _rested("log"), f"""
            SELECT CAST(team_id AS BIGINT) AS team_id, rest_bucket,
                   {", ".join(f"{sql.format(x='CASE WHEN rest_bucket IS NOT NULL THEN 1 END')} AS {m}"
                              for m, sql in _REST_AGGREGATES.items())}
            FROM rested WHERE rest_bucket IS NOT NULL GROUP BY team_id, rest_bucket"""),
        "rest_splits_pivot": _with(_GAME_LOG + "," + _rested("log"), f"""
            SELECT CAST(team_id AS BIGINT) AS team_id, {_pivot()} FROM rested GROUP BY team_id"""),
        "team_stats_union": _with(_TEAM_STATS, f"""
            SELECT team_name AS TEAM_NAME, CAST(team_id AS DOUBLE) AS TEAM_ID, {_r("w_pct", 6, "W_PCT")},
                   {_r("pts", 6, "PTS")}, CAST(NULL AS DOUBLE) AS AST, CAST(NULL AS DOUBLE) AS OPP_PTS
            FROM fx_team_stats
            UNION ALL SELECT c_name, NULL, NULL, NULL, NULL, c_acctbal / 100 FROM customer
            UNION ALL SELECT n_name, CAST(n_nationkey AS DOUBLE), NULL, NULL, CAST(n_regionkey AS DOUBLE), NULL
            FROM nation"""),
        "team_stats_wide": _with(_DOC_LOG + "," + _rested("doc_log") + f""",
            rest AS (SELECT team_id, {_pivot()} FROM rested GROUP BY team_id),
            team AS (SELECT o_custkey % 25 AS team_id, count(*) AS n,
                            count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS won,
                            CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS price
                     FROM orders GROUP BY 1)""",
            f"""SELECT 'NATION_' || team_id AS TEAM_NAME, team_id AS TEAM_ID, {team_sql}, {opponent_sql},
                       {", ".join(w.REST_COLUMNS)}
                FROM team LEFT JOIN rest USING (team_id)"""),
        "team_preview": _with(_TEAM_STATS, f"""
            SELECT team_name AS TEAM_NAME, {_r("w_pct", 6, "W_PCT")}, {_r("pts", 6, "PTS")},
                   {_r("opp_pts", 6, "OPP_PTS")}, {_r("plus_minus", 6, "PLUS_MINUS")}
            FROM fx_rated ORDER BY team_name LIMIT 10"""),
        "matchup_label": f"""
            WITH p AS (SELECT p_partkey, p_brand || ' ' || p_name AS away_team, p_name || '  ' || p_type AS home_team
                       FROM part),
            s AS (SELECT *, {nickname.format(x="away_team")} AS away_short,
                         {nickname.format(x="home_team")} AS home_short FROM p)
            SELECT *, away_short || ' @ ' || home_short AS matchup FROM s""",
        "bet_sheet": _select(_SHEET, "sheet", "event_id", "full_matchup", "matchup", "spread_bet", "spread_line",
                             "spread_strength", "spread_edge", "total_bet", "total_line", "total_strength",
                             "total_edge", "moneyline_bet", "moneyline_price", "moneyline_win_prob",
                             "moneyline_strength"),
        "bet_sheet_text": _with(_SHEET, f"""
            SELECT event_id, full_matchup AS header,
                   {_fmt(w.POWER_TEXT, "away_short", _points("away_power"), "home_short", _points("home_power"))}
                     AS power_line,
                   spread_strength,
                   CASE WHEN spread_bet <> 'No Value' THEN 'Bet ' || spread_bet ELSE 'No Value' END AS spread_label,
                   CASE WHEN spread_bet <> 'No Value' THEN {_points("spread_line", True)}
                        ELSE 'Book: ' || {_points("sportsbook_spread", True)} END AS spread_text,
                   CASE WHEN spread_bet <> 'No Value' THEN 'Edge: ' || {_points("spread_edge")} || ' pts' ELSE '' END
                     AS spread_edge_text,
                   total_strength,
                   CASE WHEN total_bet <> 'No Value' THEN 'Bet ' || total_bet ELSE 'No Value' END AS total_label,
                   CASE WHEN total_bet <> 'No Value' THEN {_points("total_line")}
                        ELSE 'Book: ' || {_points("sportsbook_total")} END AS total_text,
                   CASE WHEN total_bet <> 'No Value' THEN 'Edge: ' || {_points("total_edge")} || ' pts' ELSE '' END
                     AS total_edge_text,
                   moneyline_strength, moneyline_bet AS moneyline_label,
                   CASE WHEN moneyline_bet <> 'No Value' THEN {_whole("moneyline_price")} ELSE '' END
                     AS moneyline_text,
                   CASE WHEN moneyline_bet <> 'No Value' THEN {_percent("moneyline_win_prob", 0)} || ' win prob'
                        ELSE '' END AS moneyline_prob_text
            FROM sheet"""),
        "value_overview": _with(published, " UNION ALL ".join(f"""
            SELECT event_id, matchup, '{b}' AS bet_type, {b}_diff AS value,
                   {b}_recommendation <> 'NO VALUE' AS has_value,
                   CASE WHEN {b}_recommendation <> 'NO VALUE'
                        THEN {_points(f"abs({b}_diff)")} || ' edge' ELSE '' END AS edge_label,
                   CAST({threshold} AS DOUBLE) AS threshold
            FROM labelled""" for b, threshold in (("spread", 3), ("total", 5)))),
        "guide_cards": _with(_SHEET, " UNION ALL ".join(
            f"SELECT event_id, full_matchup, '{name}' AS card, {text} AS text FROM sheet"
            for name, text in _CARDS.items())),
        "moneyline_payout": _with(_GAMES, f"""
            SELECT event_id, away_moneyline, {_r(_PAYOUT.format(ml="away_moneyline"), 4, "away_payout")},
                   home_moneyline, {_r(_PAYOUT.format(ml="home_moneyline"), 4, "home_payout")}
            FROM games"""),
        "ranked_value_bets": _with(_VALUE_BETS, "SELECT * FROM ranked WHERE rank <= 10"),
        "implied_vs_model_prob": _with(published, "SELECT event_id, away_team, home_team, " + ", ".join(
            f"{_r(_IMPLIED.format(ml=f'{s}_moneyline'), 6, f'{s}_implied_prob')}, {s}_win_prob, "
            f"{_r(f'{s}_win_prob - ' + _IMPLIED.format(ml=f'{s}_moneyline'), 6, f'{s}_prob_edge')}"
            for s in ("away", "home")) + " FROM published"),
        "edge_histogram": _with(published, " UNION ALL ".join(f"""
            SELECT '{b}' AS bet_type, CAST(floor({b}_diff / 2) * 2 AS DOUBLE) AS bin_start, count(*) AS n
            FROM published WHERE {b}_diff IS NOT NULL GROUP BY 1, 2""" for b in ("spread", "total"))),
        "prediction_error": _with(published, """
            SELECT count(sportsbook_spread + predicted_spread) AS spread_games,
                   round(avg(abs(predicted_spread + sportsbook_spread)), 4) AS mean_abs_spread_error,
                   count(predicted_total - sportsbook_total) AS total_games,
                   round(avg(abs(predicted_total - sportsbook_total)), 4) AS mean_abs_total_error
            FROM published"""),
        "prediction_pairs": _with(published, f"""
            SELECT event_id, matchup, predicted_spread, -sportsbook_spread AS book_margin,
                   {_r("predicted_spread + sportsbook_spread", 4, "spread_error")},
                   predicted_total, sportsbook_total,
                   {_r("predicted_total - sportsbook_total", 4, "total_error")}
            FROM labelled"""),
        "best_bets": _with(published, f"""
            , e AS (SELECT *, CASE WHEN spread_recommendation <> 'NO VALUE' THEN abs(spread_diff) END AS s,
                           CASE WHEN total_recommendation <> 'NO VALUE' THEN abs(total_diff) END AS t
                    FROM labelled WHERE {_ANY_VALUE})
            SELECT event_id, matchup, greatest(s, t) AS best_edge,
                   CASE WHEN s IS NOT NULL AND (t IS NULL OR s >= t) THEN spread_recommendation
                        WHEN t IS NOT NULL THEN total_recommendation ELSE moneyline_recommendation END AS recommendation
            FROM e ORDER BY best_edge DESC NULLS LAST, event_id LIMIT 10"""),
    }
