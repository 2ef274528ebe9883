"""Report tables over the published predictions.

All of them read the published, rounded numbers.  They are plain projections of
a game row (long forms come from `inline`, not from a self-join or a shuffle),
except for the ranked, counted and averaged ones at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline import wording as w
from courtline.config import ReportConfig
from courtline.functions.odds import implied_probability, payout
from courtline.functions.text import fill, has_side, is_value, matchup, nickname, number_text
from courtline.operators.value import any_value, value_games

SPREAD, TOTAL, MONEYLINE = "spread", "total", "moneyline"


def with_labels(published: DataFrame) -> DataFrame:
    """Add nicknames and the short ``away @ home`` label."""
    return published.withColumns({
        "away_short": nickname(F.col("away_team")),
        "home_short": nickname(F.col("home_team")),
    }).withColumn("matchup", matchup(F.col("away_short"), F.col("home_short")))


def _side(flag: str, first: str, then: str) -> tuple[Column, Column]:
    one = has_side(F.col(flag), first)
    return one, ~one & has_side(F.col(flag), then)


def _strength(bet: Column, edge: Column, strong_above: float | None) -> Column:
    tier = F.lit(w.VALUE)
    if strong_above is not None:
        tier = F.when(edge > strong_above, w.STRONG).otherwise(w.VALUE)
    return F.when(bet, tier).otherwise("")


def bet_sheet(published: DataFrame, cfg: ReportConfig = ReportConfig()) -> DataFrame:
    """The published row plus, per bet type, what to bet, at which line, how strong and by what edge."""
    home, away = _side("spread_recommendation", "HOME", "AWAY")
    over, under = _side("total_recommendation", "OVER", "UNDER")
    home_win, away_win = _side("moneyline_recommendation", "HOME", "AWAY")
    spread_edge, total_edge = F.abs("spread_diff"), F.abs("total_diff")
    return with_labels(published).withColumns({
        "full_matchup": matchup(F.col("away_team"), F.col("home_team")),
        "spread_bet": F.when(home, F.col("home_short")).when(away, F.col("away_short")).otherwise(w.NO_BET),
        "spread_line": F.when(home, F.col("sportsbook_spread")).when(away, -F.col("sportsbook_spread")),
        "spread_strength": _strength(home | away, spread_edge, cfg.strong_spread),
        "spread_edge": F.when(home | away, spread_edge),
        "total_bet": F.when(over, "OVER").when(under, "UNDER").otherwise(w.NO_BET),
        "total_line": F.when(over | under, F.col("sportsbook_total")),
        "total_strength": _strength(over | under, total_edge, cfg.strong_total),
        "total_edge": F.when(over | under, total_edge),
        "moneyline_bet": F.when(home_win, F.col("home_short")).when(away_win, F.col("away_short"))
        .otherwise(w.NO_BET),
        "moneyline_price": F.when(home_win, F.col("home_moneyline")).when(away_win, F.col("away_moneyline")),
        "moneyline_win_prob": F.when(home_win, F.col("home_win_prob")).when(away_win, F.col("away_win_prob")),
        "moneyline_strength": _strength(home_win | away_win, F.lit(None), None),
    })


def bet_sheet_text(sheet: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The printed fields of a :func:`bet_sheet`."""
    def points(column: str, signed: bool = False) -> Column:
        return number_text(F.col(column), 1, signed=signed)

    def edge(column: str) -> Column:
        return fill(w.EDGE_TEXT, points(column))

    spread, total, moneyline = (F.col(f"{b}_bet") != w.NO_BET for b in (SPREAD, TOTAL, MONEYLINE))
    return sheet.select(
        *keys,
        F.col("full_matchup").alias("header"),
        fill(w.POWER_TEXT, "away_short", points("away_power"), "home_short", points("home_power"))
        .alias("power_line"),
        "spread_strength",
        F.when(spread, fill(w.BET_TEXT, "spread_bet")).otherwise(w.NO_BET).alias("spread_label"),
        F.when(spread, points("spread_line", signed=True))
        .otherwise(fill(w.BOOK_TEXT, points("sportsbook_spread", signed=True))).alias("spread_text"),
        F.when(spread, edge("spread_edge")).otherwise("").alias("spread_edge_text"),
        "total_strength",
        F.when(total, fill(w.BET_TEXT, "total_bet")).otherwise(w.NO_BET).alias("total_label"),
        F.when(total, points("total_line"))
        .otherwise(fill(w.BOOK_TEXT, points("sportsbook_total"))).alias("total_text"),
        F.when(total, edge("total_edge")).otherwise("").alias("total_edge_text"),
        "moneyline_strength",
        F.col("moneyline_bet").alias("moneyline_label"),
        F.when(moneyline, number_text(F.col("moneyline_price"), 0, signed=True)).otherwise("")
        .alias("moneyline_text"),
        F.when(moneyline, fill(
            w.WIN_PROBABILITY_TEXT, number_text(F.col("moneyline_win_prob"), 0, percent=True)))
        .otherwise("").alias("moneyline_prob_text"),
    )


def value_overview(published: DataFrame, cfg: ReportConfig = ReportConfig(),
                   keys: Sequence[str] = ()) -> DataFrame:
    """One row per game and bet type (spread, total): the gap, whether it is value, its threshold."""
    def series(bet_type: str, threshold: float) -> Column:
        gap, flagged = F.col(f"{bet_type}_diff"), is_value(F.col(f"{bet_type}_recommendation"))
        label = fill(w.EDGE_LABEL, number_text(F.abs(gap), 1))
        return F.struct(
            F.lit(bet_type).alias("bet_type"),
            gap.alias("value"),
            flagged.alias("has_value"),
            F.when(flagged, label).otherwise("").alias("edge_label"),
            F.lit(threshold).alias("threshold"),
        )

    return with_labels(published).select(*keys, "matchup", F.inline(F.array(
        series(SPREAD, cfg.value.spread_threshold), series(TOTAL, cfg.value.total_threshold),
    )))


def payout_text(price: Column, stake: float = 100.0) -> Column:
    """``$250 on a $100 bet``: both signs of the price are for the same stake."""
    stake_text = F.lit(f"{stake:.0f}")
    return fill(w.PAYOUT_TEXT, number_text(payout(price, stake), 0), stake_text)


def guide_cards(published: DataFrame, cfg: ReportConfig = ReportConfig(),
                keys: Sequence[str] = ()) -> DataFrame:
    """Explanatory text per game: one row each for info, spread, total and moneyline."""
    home, away = _side("spread_recommendation", "HOME", "AWAY")
    over, under = _side("total_recommendation", "OVER", "UNDER")

    # Every number text is used by several cards: computed once, in a projection of its own.
    points = {
        "t_away_power": "away_power", "t_home_power": "home_power", "t_model_spread": "predicted_spread",
        "t_spread_gap": F.abs("spread_diff"), "t_cushion": F.abs("spread_line"),
        "t_book_total": "sportsbook_total", "t_model_total": "predicted_total",
        "t_total_gap": F.abs("total_diff"),
    }
    signed_points = {
        "t_line": "spread_line", "t_book_spread": "sportsbook_spread", "t_signed_model": "predicted_spread",
    }
    shares = {f"t_{c}": c for c in ("away_win_prob", "home_win_prob", "moneyline_win_prob")}
    prices = {f"t_{c}": c for c in ("away_moneyline", "home_moneyline", "moneyline_price")}

    def texts(sources: dict, decimals: int, **how: bool) -> dict[str, Column]:
        return {
            name: number_text(F.col(c) if isinstance(c, str) else c, decimals, **how)
            for name, c in sources.items()
        }

    sheet = bet_sheet(published, cfg).withColumns({
        **texts(points, 1), **texts(signed_points, 1, signed=True),
        **texts(shares, 1, percent=True), **texts(prices, 0, signed=True),
    })

    spread = (
        F.when(home, fill(
            w.CARD_SPREAD_HOME, "spread_bet", "t_line", "spread_bet", "t_cushion", "home_short",
            "t_book_spread", "home_short", "t_model_spread", "t_spread_gap", "spread_bet"))
        .when(away, fill(
            w.CARD_SPREAD_AWAY, "spread_bet", "t_line", "spread_bet", "t_cushion", "away_short", "t_line",
            "home_short", "t_book_spread", "home_short", "t_model_spread", "t_spread_gap", "spread_bet"))
        .otherwise(fill(
            w.CARD_SPREAD_NONE, "home_short", "t_book_spread", "home_short", "t_signed_model", "t_spread_gap"))
    )
    total = F.when(over | under, fill(
        w.CARD_TOTAL_BET, "total_bet", "t_book_total", F.when(over, "MORE").otherwise("LESS"),
        "t_book_total", "t_book_total", "t_model_total", "t_total_gap",
        F.when(over, "higher-scoring").otherwise("lower-scoring"),
    )).otherwise(fill(w.CARD_TOTAL_NONE, "t_book_total", "t_model_total", "t_total_gap"))
    moneyline = F.when(is_value(F.col("moneyline_recommendation")), fill(
        w.CARD_MONEYLINE_BET, "moneyline_bet", "t_moneyline_price", "moneyline_bet", "t_moneyline_price",
        payout_text(F.col("moneyline_price"), cfg.stake), "t_moneyline_win_prob", "moneyline_bet",
    )).otherwise(fill(
        w.CARD_MONEYLINE_NONE, "away_short", "t_away_moneyline", "t_away_win_prob",
        "home_short", "t_home_moneyline", "t_home_win_prob"))
    info = fill(
        w.CARD_INFO, "away_short", "t_away_power", "home_short", "t_home_power",
        "away_short", "t_away_win_prob", "home_short", "t_home_win_prob")

    cards = {"info": info, SPREAD: spread, TOTAL: total, MONEYLINE: moneyline}
    return sheet.select(*keys, "full_matchup", F.inline(F.array(*(
        F.struct(F.lit(name).alias("card"), text.alias("text")) for name, text in cards.items()
    ))))


def moneyline_payouts(games: DataFrame, keys: Sequence[str] = (), stake: float = 100.0) -> DataFrame:
    """What each side's moneyline pays on the stake."""
    return games.select(*keys, *(
        column
        for side in ("away", "home")
        for column in (
            F.col(f"{side}_moneyline"),
            payout(F.col(f"{side}_moneyline"), stake).alias(f"{side}_payout"),
        )
    ))


def implied_vs_model_probability(games: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Win probability the book implies against the model's, per side."""
    columns = []
    for side in ("away", "home"):
        implied, model = implied_probability(F.col(f"{side}_moneyline")), F.col(f"{side}_win_prob")
        columns += [
            implied.alias(f"{side}_implied_prob"),
            model,
            (model - implied).alias(f"{side}_prob_edge"),
        ]
    return games.select(*keys, "away_team", "home_team", *columns)


def value_bets(published: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per flagged bet.

    The edge of a spread or total is in points; that of a moneyline is the
    model's probability over the book's, in percentage points.
    """
    by_home = has_side(F.col("moneyline_recommendation"), "HOME")
    model = F.when(by_home, F.col("home_win_prob")).otherwise(F.col("away_win_prob"))
    price = F.when(by_home, F.col("home_moneyline")).otherwise(F.col("away_moneyline"))
    edges = {
        SPREAD: F.abs("spread_diff"),
        TOTAL: F.abs("total_diff"),
        MONEYLINE: (model - implied_probability(price)) * 100,
    }
    bets = F.array(*(
        F.struct(
            F.lit(bet_type).alias("bet_type"),
            F.col(f"{bet_type}_recommendation").alias("recommendation"),
            F.round(edge, 1).alias("edge"),
        )
        for bet_type, edge in edges.items()
    ))
    long = with_labels(published.filter(any_value())).select(*keys, "matchup", F.inline(bets))
    return long.filter(is_value(F.col("recommendation")))


def ranked_value_bets(published: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` bets with the largest edge per bet type, ties by ``keys``.

    Spark cuts every task down to ``k`` rows per type before the shuffle.
    """
    order = Window.partitionBy("bet_type").orderBy(F.desc_nulls_last("edge"), *keys)
    return value_bets(published, keys).withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= k
    )


def best_bets(published: DataFrame, keys: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` value games with the largest flagged point edge, and which bet that is.

    Games flagged on the moneyline alone have no point edge and come last.
    """
    flagged = {
        b: F.when(is_value(F.col(f"{b}_recommendation")), F.abs(f"{b}_diff")) for b in (SPREAD, TOTAL)
    }
    spread, total = flagged[SPREAD], flagged[TOTAL]
    take_spread = spread.isNotNull() & (total.isNull() | (spread >= total))
    return (
        with_labels(value_games(published))
        .select(
            *keys, "matchup",
            F.greatest(spread, total).alias("best_edge"),
            F.when(take_spread, F.col("spread_recommendation"))
            .when(total.isNotNull(), F.col("total_recommendation"))
            .otherwise(F.col("moneyline_recommendation")).alias("recommendation"),
        )
        .orderBy(F.desc_nulls_last("best_edge"), *keys)
        .limit(k)
    )


def edge_histogram(published: DataFrame, width: float = 2.0) -> DataFrame:
    """Games per bet type and fixed-width bin of the gap between model and book."""
    gaps = F.array(*(
        F.struct(F.lit(b).alias("bet_type"), F.col(f"{b}_diff").alias("gap")) for b in (SPREAD, TOTAL)
    ))
    return (
        published.select(F.inline(gaps)).filter(F.col("gap").isNotNull())
        .groupBy("bet_type", (F.floor(F.col("gap") / width) * width).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def prediction_errors(published: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Model against book, per game: home margin and total."""
    book_margin = -F.col("sportsbook_spread")
    return with_labels(published).select(
        *keys, "matchup", "predicted_spread", book_margin.alias("book_margin"),
        (F.col("predicted_spread") - book_margin).alias("spread_error"),
        "predicted_total", "sportsbook_total",
        (F.col("predicted_total") - F.col("sportsbook_total")).alias("total_error"),
    )


def prediction_error_summary(errors: DataFrame) -> DataFrame:
    """Mean absolute gap for spread and total over the games that have one."""
    return errors.agg(*(
        agg for b in (SPREAD, TOTAL) for agg in (
            F.count(f"{b}_error").alias(f"{b}_games"),
            F.avg(F.abs(f"{b}_error")).alias(f"mean_abs_{b}_error"),
        )
    ))
