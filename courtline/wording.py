"""Flag strings, column names and report wording.

Downstream consumers compare these strings literally, so they must stay exactly
as they are.  Text templates use printf placeholders.
"""

from __future__ import annotations

# --- recommendation flags (closed set) -------------------------------------
NO_VALUE = "NO VALUE"
SPREAD_HOME = "BET HOME TEAM (better than spread)"
SPREAD_AWAY = "BET AWAY TEAM (better than spread)"
TOTAL_UNDER = "BET UNDER (predicted lower)"
TOTAL_OVER = "BET OVER (predicted higher)"
MONEYLINE_HOME = "VALUE: BET HOME TEAM"
MONEYLINE_AWAY = "VALUE: BET AWAY TEAM"

FLAG_COLUMNS = ["spread_recommendation", "total_recommendation", "moneyline_recommendation"]

# --- bet sheet labels -------------------------------------------------------
NO_BET = "No Value"
STRONG = "STRONG"
VALUE = "VALUE"

# --- names ------------------------------------------------------------------
UNKNOWN_TEAM = "Unknown"

# --- rest buckets -----------------------------------------------------------
REST_BUCKETS = ["0", "1", "2", "3", "4+"]
REST_METRICS = ["GP", "W", "L", "W_PCT", "PTS", "PLUS_MINUS"]

# --- team-stats columns -----------------------------------------------------
ID_COLUMNS = ["TEAM_NAME", "TEAM_ID"]
RECORD_COLUMNS = ["GP", "W", "L", "W_PCT", "MIN"]
OFFENCE_COLUMNS = [
    "PTS", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT",
    "OREB", "DREB", "REB", "AST", "TOV", "STL", "BLK", "PLUS_MINUS",
]
OPPONENT_COLUMNS = [
    "OPP_PTS", "OPP_FG_PCT", "OPP_FG3_PCT", "OPP_FT_PCT", "OPP_REB", "OPP_AST", "OPP_TOV",
]

# --- odds snapshot columns --------------------------------------------------
PRICE_COLUMNS = ["spread", "away_moneyline", "home_moneyline", "total"]
ODDS_COLUMNS = ["sport", "away_team", "home_team", *PRICE_COLUMNS]

# --- date formats -----------------------------------------------------------
GAME_DATE_FORMAT = "MMM d, yyyy"
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][.SSS]XXX"
ZONELESS_TIME = r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?$"
SNAPSHOT_FORMAT = "yyyyMMdd_HHmm"

# --- sheet texts ------------------------------------------------------------
MATCHUP_TEXT = "%s @ %s"
POWER_TEXT = "Power Ratings: %s %s | %s %s"
EDGE_TEXT = "Edge: %s pts"
BOOK_TEXT = "Book: %s"
BET_TEXT = "Bet %s"
WIN_PROBABILITY_TEXT = "%s win prob"
EDGE_LABEL = "%s edge"

# --- guide cards ------------------------------------------------------------
CARD_INFO = (
    "Power Ratings: %s (%s) vs %s (%s)\n"
    "Win Probabilities: %s %s | %s %s"
)
CARD_SPREAD_HOME = (
    "📊 SPREAD BET RECOMMENDATION\n\n"
    "✓ Bet %s %s\n\n"
    "What this means:\n"
    "• Bet on %s with a %s point cushion\n"
    "• Sportsbook line: %s %s\n"
    "• Our prediction: %s wins by %s\n"
    "• Your edge: %s points\n\n"
    "Why it's value: We predict this game to be closer than the sportsbook thinks,\n"
    "giving %s a better chance to cover the spread."
)
CARD_SPREAD_AWAY = (
    "📊 SPREAD BET RECOMMENDATION\n\n"
    "✓ Bet %s %s\n\n"
    "What this means:\n"
    "• Bet on %s with a %s point cushion\n"
    "• Sportsbook line: %s %s / %s %s\n"
    "• Our prediction: %s wins by %s\n"
    "• Your edge: %s points\n\n"
    "Why it's value: We predict this game to be closer than the sportsbook thinks,\n"
    "giving %s a better chance to cover the spread."
)
CARD_SPREAD_NONE = (
    "📊 SPREAD BET\n\n"
    "✗ No Value Found\n\n"
    "• Sportsbook line: %s %s\n"
    "• Our prediction: %s %s\n"
    "• Difference: %s points\n\n"
    "Our prediction is too close to the sportsbook line to recommend a bet."
)
CARD_TOTAL_BET = (
    "🎯 TOTAL BET RECOMMENDATION\n\n"
    "✓ Bet %s %s\n\n"
    "What this means:\n"
    "• Bet that both teams will score %s than %s combined points\n"
    "• Sportsbook total: %s\n"
    "• Our prediction: %s total points\n"
    "• Your edge: %s points\n\n"
    "Why it's value: We predict a %s game than the sportsbook expects."
)
CARD_TOTAL_NONE = (
    "🎯 TOTAL BET\n\n"
    "✗ No Value Found\n\n"
    "• Sportsbook total: %s\n"
    "• Our prediction: %s\n"
    "• Difference: %s points\n\n"
    "Our prediction is too close to the sportsbook line to recommend a bet."
)
CARD_MONEYLINE_BET = (
    "💰 MONEYLINE BET RECOMMENDATION\n\n"
    "✓ Bet %s to win straight up (%s)\n\n"
    "What this means:\n"
    "• Simple bet: %s just needs to WIN the game\n"
    "• Odds: %s (payout: %s)\n"
    "• Our win probability: %s\n\n"
    "Why it's value: Our model gives %s a better chance to win\n"
    "than what the odds suggest, making this a value bet."
)
CARD_MONEYLINE_NONE = (
    "💰 MONEYLINE BET\n\n"
    "✗ No Value Found\n\n"
    "• %s: %s (%s win prob)\n"
    "• %s: %s (%s win prob)\n\n"
    "The odds accurately reflect the win probabilities."
)
PAYOUT_TEXT = "$%s on a $%s bet"


def rest_column(bucket: str, metric: str) -> str:
    """``('4+', 'GP')`` -> ``REST_4plus_GP``."""
    return f"REST_{bucket.replace('+', 'plus')}_{metric}"


REST_COLUMNS = [rest_column(b, m) for b in REST_BUCKETS for m in REST_METRICS]
TEAM_STATS_COLUMNS = ID_COLUMNS + RECORD_COLUMNS + OFFENCE_COLUMNS + OPPONENT_COLUMNS + REST_COLUMNS
