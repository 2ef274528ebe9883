"""The given star-schema tables seen as odds data.

A supplier plays the team, an order the game, its line items the provider
offers; for rest days and landed documents a nation is the team.  Multipliers
only bring the numbers into a realistic range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.operators.bounds import small_side

ZONE = "-05:00"


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def row_count(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Rows of a table as it is now, from its file footers."""
    return table(spark, sf_dir, name).count()


def _cents(column: str) -> Column:
    """A two-decimal amount as a whole number, so that its sum is exact."""
    return F.rint(F.col(column) * 100).cast("long")


def _mean(total: Column, n: str = "n") -> Column:
    """A whole sum over a count."""
    return total.cast("double") / F.col(n)


def _mean_cents(total: str) -> Column:
    return _mean(F.col(total) / 100)


def _share(condition: Column) -> Column:
    return F.count_if(condition)


def team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier with line items.

    Sums are exact, so the result does not depend on how the input is split.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    per_supplier = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(_cents("l_extendedprice")).alias("price"),
            F.sum(_cents("o_totalprice")).alias("order_price"),
            F.sum(_cents("l_discount")).alias("discount"),
            F.sum(_cents("l_quantity")).alias("quantity"),
            F.sum("l_linenumber").alias("line_numbers"),
            _share(F.col("o_orderstatus") == "F").alias("finished"),
            _share(F.col("l_returnflag") == "N").alias("kept"),
            _share(F.col("l_linestatus") == "O").alias("open"),
        )
    )
    suppliers = small_side(
        table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey"),
        row_count(spark, sf_dir, "supplier"))
    pts = _mean_cents("price") / 500
    opp_pts = _mean_cents("order_price") / 2500
    return (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("s_name").alias("TEAM_NAME"),
            F.col("s_suppkey").alias("TEAM_ID"),
            F.col("n").alias("GP"),
            pts.alias("PTS"),
            opp_pts.alias("OPP_PTS"),
            _mean(F.col("finished")).alias("W_PCT"),
            (10 * (pts - opp_pts - 5)).alias("PLUS_MINUS"),
            _mean(F.col("kept")).alias("FG_PCT"),
            (_mean_cents("discount") * 7).alias("FG3_PCT"),
            _mean(F.col("open")).alias("OPP_FG_PCT"),
            _mean_cents("quantity").alias("AST"),
            (_mean(F.col("line_numbers")) * 4).alias("OPP_TOV"),
        )
    )


def offer_prices() -> dict[str, Column]:
    quantity, discount = F.col("l_quantity"), F.col("l_discount")
    return {
        "spread": F.when(F.col("l_returnflag") != "R", (quantity - 25) / 2.5),
        "away_moneyline": F.when(F.col("l_linestatus") == "O", (discount * 100 - 5) * 40),
        "home_moneyline": F.when(F.col("l_linenumber") % 3 != 0, (5 - discount * 100) * 40),
        "total": F.when(
            ~((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")), 180 + F.col("l_tax") * 500),
    }


OFFER_ORDER = ["l_linenumber", "l_partkey", "l_suppkey"]


def offer_position() -> Column:
    """``OFFER_ORDER`` as one whole number; keys have at most 12 digits."""
    line, part, supplier = (F.col(c).cast("decimal(12,0)") for c in OFFER_ORDER)
    return (line * 10 ** 12 + part).cast("decimal(24,0)") * 10 ** 12 + supplier


def odds_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per offer; offers of a game are ordered by ``OFFER_ORDER``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("event_id"), *OFFER_ORDER,
        *(price.alias(name) for name, price in offer_prices().items()))


def events(spark: SparkSession, sf_dir: str, n_suppliers: int) -> DataFrame:
    """One row per order.  Every 23rd away team is unknown."""
    def supplier(number: Column) -> Column:
        return F.concat(F.lit("Supplier#"), F.lpad((number % n_suppliers).cast("string"), 9, "0"))

    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("event_id"),
        F.lit("NBA").alias("sport"),
        F.col("o_orderdate").cast("date").alias("event_date"),
        F.when(key % 23 == 0, "Unknown").otherwise(supplier(F.col("o_custkey") + key)).alias("away_team"),
        supplier(F.col("o_custkey")).alias("home_team"))


def game_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order, its customer's nation being the team; dates as raw text."""
    customers = small_side(
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
        row_count(spark, sf_dir, "customer"))
    day = F.date_format(F.col("o_orderdate").cast("date"), "MMM dd, yyyy")
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("c_nationkey").cast("long").alias("team_id"),
            F.col("o_orderkey").alias("game_id"),
            F.upper(day).alias("game_date_text"),
            F.when(F.col("o_orderstatus") == "F", "W").when(F.col("o_orderstatus") == "O", "L").alias("wl"),
            (F.col("o_totalprice") / 2500).alias("pts"),
            ((F.col("o_totalprice") - 250000) / 10000).alias("plus_minus"))
    )


def _page(kind: str, url: Column, page: Column, body: Column) -> list[Column]:
    return [
        F.lit("nba").alias("sport"), F.lit(kind).alias("kind"), url.alias("url"),
        page.cast("decimal(38,0)").alias("page"), F.to_json(body).alias("body"),
    ]


def _url(path: str, key: Column) -> Column:
    return F.concat(F.lit(f"/{path}/"), key.cast("string"))


def _ref(url: Column) -> Column:
    return F.struct(url.alias("$ref"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed odds documents.

    An order gives an event, a competition and an empty first odds page, each of
    its line items a further odds page with one offer, a nation a team.  Some
    parts are missing so that every disposition occurs:

    ===========================  ==========================================
    competitions absent          o_orderkey % 41 = 0
    date absent                  o_orderkey % 43 = 0
    competition unreadable       o_orderkey % 47 = 0
    one role undeclared          o_orderkey % 5 = 0 (away still comes first)
    odds reference absent        o_orderkey % 37 = 0
    name of team 13 absent       -> Unknown
    ===========================  ==========================================

    Home and away are declared in reversed order for odd keys.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    key = F.col("o_orderkey")
    zero = F.lit(0)

    lists = orders.select(*_page(
        "events", F.lit("/events"), key, F.struct(F.array(_ref(_url("events", key))).alias("items"))))

    hour = F.lpad((key % 24).cast("string"), 2, "0")
    start = F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T"), hour, F.lit(":00Z"))
    event = F.struct(
        F.when(key % 43 != 0, start).alias("date"),
        F.when(key % 41 != 0, F.array(_ref(_url("competitions", key)))).alias("competitions"))
    event_docs = orders.select(*_page("event", _url("events", key), zero, event))

    def competitor(role: str, team: Column) -> Column:
        undeclared = (key % 5 == 0) if role == "home" else F.lit(False)
        return F.struct(
            F.when(~undeclared, role).alias("homeAway"),
            _ref(_url("teams", team)).alias("team"))

    home = competitor("home", F.col("o_custkey") % 25)
    away = competitor("away", (F.col("o_custkey") + 1 + key % 24) % 25)
    swapped = (key % 2 == 1) & (key % 5 != 0)
    competition = F.struct(
        F.when(swapped, F.array(home, away)).otherwise(F.array(away, home)).alias("competitors"),
        F.when(key % 37 != 0, _ref(_url("odds", key))).alias("odds"))
    sport, kind, url, page, body = _page("competition", _url("competitions", key), zero, competition)
    torn = F.when(key % 47 == 0, F.lit('{"competitors": [')).otherwise(body).alias("body")
    competition_docs = orders.select(sport, kind, url, page, torn)

    nation = F.col("n_nationkey")
    team_docs = table(spark, sf_dir, "nation").select(*_page(
        "team", _url("teams", nation), zero,
        F.struct(F.when(nation != 13, F.col("n_name")).alias("displayName"))))

    no_items = F.from_json(F.lit("[]"), "array<struct<spread: double>>")
    empty_pages = orders.select(*_page("odds", _url("odds", key), F.lit(-1), F.struct(no_items.alias("items"))))

    prices = offer_prices()
    offer = F.struct(
        F.struct(F.concat(F.lit("book "), F.col("l_suppkey").cast("string")).alias("name")).alias("provider"),
        prices["spread"].alias("spread"),
        prices["total"].alias("overUnder"),
        F.struct(prices["away_moneyline"].alias("moneyLine")).alias("awayTeamOdds"),
        F.struct(prices["home_moneyline"].alias("moneyLine")).alias("homeTeamOdds"))
    offer_pages = table(spark, sf_dir, "lineitem").select(*_page(
        "odds", _url("odds", F.col("l_orderkey")), offer_position(), F.struct(F.array(offer).alias("items"))))

    pages = lists
    for part_docs in (event_docs, competition_docs, team_docs, empty_pages, offer_pages):
        pages = pages.unionAll(part_docs)
    return pages


N_TEAMS = 25


def _team_columns() -> list[Column]:
    team = F.col("o_custkey") % N_TEAMS
    return [team.alias("TEAM_ID"), F.concat(F.lit("NATION_"), team.cast("string")).alias("TEAM_NAME")]


def _result_set(headers: Column, rows: Column) -> Column:
    """Body text of a statistics document; ``rows`` is the text inside the outer brackets."""
    return F.concat(F.lit('{"resultSets":[{"headers":'), F.to_json(headers),
                    F.lit(',"rowSet":['), rows, F.lit("]}]}"))


def _row(*cells: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *cells), F.lit("]"))


def log_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A game-log document of two games per order.

    The second game is 0..4 days after the first.  Every 7th order's document
    lacks the PLUS_MINUS column, every 11th's first game has a blank date.
    """
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    full = key % 7 != 0
    names = ["Team_ID", "Game_ID", "GAME_DATE", "WL", "PTS"]
    headers = F.when(full, F.array(*map(F.lit, [*names, "PLUS_MINUS"]))).otherwise(
        F.array(*map(F.lit, names)))

    def date_text(day: Column) -> Column:
        return F.concat(F.lit('"'), F.upper(F.date_format(day, "MMM d, yyyy")), F.lit('"'))

    def game(number: int, day: Column, won: Column, plus_minus: Column) -> Column:
        return _row(
            (F.col("o_custkey") % N_TEAMS).cast("string"),
            (key * 2 + number).cast("string"), day,
            F.when(won, '"W"').when(~won, '"L"').otherwise("null"),
            (price / 2500).cast("string"),
            F.when(full, plus_minus.cast("string")))

    day = F.col("o_orderdate").cast("date")
    won = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")
    margin = (price - 250000) / 10000
    first = game(0, F.when(key % 11 == 0, F.lit('""')).otherwise(date_text(day)), won, margin)
    second = game(1, date_text(F.date_add(day, (key % 5).cast("int"))), ~won, -margin)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return orders.select(*_team_columns(), _result_set(headers, F.concat_ws(",", first, second)).alias("body"))


# Portable SQL over `n` (orders), `won` and `price` (mean order price).
BASE_FORMULAS = {
    "GP": "n", "W": "won", "L": "n - won", "W_PCT": "CAST(won AS DOUBLE) / n", "MIN": "48.5E0",
    "PTS": "price / 2500", "FGM": "price / 6000", "FGA": "price / 3000", "FG_PCT": "price / 500000",
    "FG3M": "price / 20000", "FG3A": "price / 7000", "FG3_PCT": "price / 700000",
    "FTM": "price / 14000", "FTA": "price / 11000", "FT_PCT": "price / 320000",
    "OREB": "price / 25000", "DREB": "price / 7500", "REB": "price / 5700", "AST": "price / 9500",
    "TOV": "price / 18000", "STL": "price / 32000", "BLK": "price / 50000",
    "PLUS_MINUS": "price / 2500 - 100",
}
OPPONENT_FORMULAS = {
    "OPP_PTS": "price / 2600", "OPP_FG_PCT": "price / 510000", "OPP_FG3_PCT": "price / 710000",
    "OPP_FT_PCT": "price / 330000", "OPP_REB": "price / 5800", "OPP_AST": "price / 9600",
    "OPP_TOV": "price / 17000",
}


def nation_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Base and opponent documents, one per team.

    The opponent document has no row for teams 5, 11, 17 and 23, and no
    OPP_FT_PCT header for teams 1, 5, 9, ...
    """
    teams = (
        table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
        .groupBy(*_team_columns())
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("won"),
             F.sum(_cents("o_totalprice")).alias("total"))
        .withColumn("price", _mean_cents("total"))
    )

    def document(names: list[str], formulas: dict[str, str]) -> tuple[Column, Column]:
        return F.array(*map(F.lit, names)), _row(*(F.expr(formulas[c]).cast("string") for c in names))

    base = teams.select("TEAM_ID", "TEAM_NAME", _result_set(
        *document(list(BASE_FORMULAS), BASE_FORMULAS)).alias("body"))
    full_headers, full_row = document(list(OPPONENT_FORMULAS), OPPONENT_FORMULAS)
    short_headers, short_row = document([c for c in OPPONENT_FORMULAS if c != "OPP_FT_PCT"], OPPONENT_FORMULAS)
    team = F.col("TEAM_ID")
    opponent = teams.select("TEAM_ID", "TEAM_NAME", _result_set(
        F.when(team % 4 == 1, short_headers).otherwise(full_headers),
        F.when(team % 6 == 5, "").when(team % 4 == 1, short_row).otherwise(full_row)).alias("body"))
    return base, opponent
