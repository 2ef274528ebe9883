"""Personal data: fixed forms as seeds, contexts learned from them for the rest.

E-mail addresses, IP addresses, card and telephone numbers of fixed form are the
seeds.  The words around them are lexical patterns.  Patterns and the values seen
in them form a graph that Spark scores in rounds: a pattern is as good as the share
of its values known to be of a kind, a value as good as its best pattern.  What
stands in a good pattern is found too, whatever its form.  Everything is column
functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import look_up, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")

# The forms, each leftmost and non-overlapping.  Look-behinds (or the end of the match before) allow a start
# only where a run of its characters begins, and possessive repeats never go back: both
# leave the matches as they are, and keep the time linear in the text and the stack flat.
_LOCAL, _NAME = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
FORMS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for its form to be looked for at all.
_NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# A token with a digit or an at sign: what may be an identifier of another form.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
_BLOCK = 64
_CONTEXT = 80


@dataclass(frozen=True)
class Settings:
    """Rounds of scoring, known values that a pattern needs, and the share of them among its values."""

    rounds: int = 3
    least_known: float = 5.0
    least_share: float = 0.8
    least_digits: int = 4


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))

    def value(i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        doubled = d * 2
        return F.when(i % 2 == 1, d).otherwise(F.when(doubled > 9, doubled - 9).otherwise(doubled))

    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        def small(part: Column) -> Column:
            short = F.ltrim(part, F.lit("0"))
            return (F.length(short) <= 3) & (F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(F.when(F.length(digits).between(13, 19), digits).otherwise("0"))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` or its own lambdas name it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _add(a: Column, b: Column) -> Column:
    return a + b


def _starts(parts: Column, found: Column) -> Column:
    """Start of each match, given the texts between the matches and the matches themselves.

    Sums of lengths up to a match, by blocks, so that a text with very many
    matches costs little more than one with few.
    """
    def by_blocks(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), _add))
        before = _let(sums, lambda s: F.transform(s, lambda _, i: F.aggregate(F.slice(s, F.lit(1), i), F.lit(0), _add)))
        return _let(before, lambda start: F.flatten(F.transform(blocks, lambda b, k: F.transform(
            b, lambda _, i: F.get(start, k) + F.aggregate(F.slice(b, F.lit(1), i), F.lit(0), _add)))))

    def cut(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(sizes, k * _BLOCK + 1, _BLOCK))

    sizes = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(parts, i)))
    ends = _let(sizes, lambda x: _let(cut(x), by_blocks))
    return F.transform(ends, lambda s, i: s + F.length(F.get(parts, i)))


def _left(part: Column) -> Column:
    return F.regexp_extract(F.right(part, F.lit(_CONTEXT)), r"(\S+)\s+$", 1)


def _right(part: Column) -> Column:
    return F.regexp_extract(F.left(part, F.lit(_CONTEXT)), r"^\S*\s+(\S+)", 1)


def _matches(rows: DataFrame, name: str, form: str, needed: str | None) -> DataFrame:
    """Adds the array ``name`` of ``start``, ``end``, ``value`` and the words on either side of a form's matches."""
    here = F.col("text").contains(needed) if needed else F.lit(True)
    none = F.array().cast("array<struct<start:int,end:int,value:string,left:string,right:string>>")

    def located(found: Column, parts: Column, starts: Column) -> Column:
        return F.transform(found, lambda m, i: F.struct(
            F.get(starts, i).alias("start"), (F.get(starts, i) + F.length(m)).alias("end"), m.alias("value"),
            _left(F.get(parts, i)).alias("left"), _right(F.get(parts, i + 1)).alias("right")))

    def split(found: Column) -> Column:
        return _let(F.split("text", form, -1), lambda parts: _let(
            _starts(parts, found), lambda starts: located(found, parts, starts)))

    matches = _let(F.regexp_extract_all("text", F.lit(form), F.lit(0)),
                   lambda found: F.when(F.size(found) > 0, split(found)).otherwise(none))
    return rows.withColumn(name, F.when(here & F.col("has_any"), matches).otherwise(none))


def _tested(k: int, kind: str) -> Column:
    """The matches of a form that pass its test, with the kind's number."""
    def numbered(s: Column) -> Column:
        return F.struct(F.lit(k).alias("kind"), *(s[c].alias(c) for c in ("start", "end", "value", "left", "right")))

    return F.transform(F.filter(kind, lambda s: _valid(kind, s["value"])), numbered)


def _covered(spans: Column) -> Column:
    """One byte for each place up to the end of the last of a form's matches: 1 within a match, else 0."""
    def piece(s: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0)
        return F.concat(F.repeat(F.lit("0"), s["start"] - before), F.repeat(F.lit("1"), s["end"] - s["start"]))

    # As binary, whose parts are cut out in constant time.
    return F.array_join(F.transform(spans, piece), "").cast("binary")


def _free(tokens: Column, base: Column) -> Column:
    """The tokens that overlap no base span, in time linear in the text."""
    def free(masks: Column) -> Column:
        def covers(mask: Column, s: Column) -> Column:
            return F.substring(mask, s["start"] + 1, s["end"] - s["start"]).cast("string").contains("1")

        return F.filter(tokens, lambda s: ~F.exists(masks, lambda mask: covers(mask, s)))

    def of_kind(k: int) -> Column:
        return F.filter(base, lambda s: s["kind"] == k)

    return _let(F.array(*(_covered(of_kind(k)) for k in range(len(KINDS)))), free)


def forms(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          settings: Settings = Settings()) -> DataFrame:
    """``id``, ``row_key``, ``base`` and ``others`` of every row.

    ``base`` holds the spans of the fixed forms (``kind`` as its place in ``KINDS``)
    that pass their tests, by kind and start, ``others`` the tokens that may be
    identifiers and overlap no base span; places are in code points.  Null texts are empty.
    """
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    rows = rows.withColumns({"row_key": F.xxhash64("id", "text"), "has_any": F.col("text").rlike("[0-9@]")})
    for kind in KINDS:
        rows = _matches(rows, kind, FORMS[kind], _NEEDED[kind])
    rows = _matches(rows, "tokens", TOKEN, None)
    base = F.concat(*(_tested(k, kind) for k, kind in enumerate(KINDS)))
    other = F.filter("tokens", lambda s: s["value"].contains("@") | (F.length(_digits(s["value"])) >= settings.least_digits))
    rows = rows.select("id", "row_key", base.alias("base"), other.alias("others"))
    return rows.withColumn("others", F.when((F.size("base") > 0) & (F.size("others") > 0), _free(
        F.col("others"), F.col("base"))).otherwise(F.col("others")))


def _contexts(left: Column, right: Column) -> Column:
    """The patterns of a place: the words before and after it, alone and together, in lower case, digits as 0."""
    def word(c: Column) -> Column:
        return F.regexp_replace(F.lower(c), "[0-9]", "0")

    left, right = word(left), word(right)
    return F.array_compact(F.array(
        F.when(left != "", F.concat(left, F.lit(" _"))),
        F.when(right != "", F.concat(F.lit("_ "), right)),
        F.when((left != "") & (right != ""), F.concat_ws(" ", left, F.lit("_"), right))))


def good_patterns(found: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``pattern``, ``kind``, ``share`` and ``n`` (its values) of the patterns that the rounds leave as good.

    Edges are distinct pairs of pattern and value.  Each round sums what is known
    of a pattern's values, pre-aggregated by pattern, and passes the best pattern's
    share on to its values; look-ups split hot patterns and values.
    """
    seeds = found.select(F.explode("base").alias("s")).select(
        F.col("s.kind").alias("kind"), F.col("s.value").alias("value"), _contexts(F.col("s.left"), F.col("s.right")).alias("p"))
    others = found.select(F.explode("others").alias("s")).select(
        F.col("s.value").alias("value"), _contexts(F.col("s.left"), F.col("s.right")).alias("p"))
    known = written(seeds.groupBy("value").agg(F.min("kind").alias("seed_kind")), "seeds")
    pairs = seeds.select("value", F.explode("p").alias("pattern")).unionByName(
        others.select("value", F.explode("p").alias("pattern"))).distinct()
    edges = written(pairs.join(known, "value", "left"), "edges")
    total = edges.count()
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    degree = edges.groupBy("value").agg(F.count(F.lit(1)).alias("degree"))
    belief = edges.select("pattern", "value", F.col("seed_kind").alias("kind"), F.when(
        F.col("seed_kind").isNotNull(), 1.0).alias("weight"))
    good = None
    for _ in range(settings.rounds):
        scores = belief.filter("weight > 0").groupBy("pattern", "kind").agg(F.sum("weight").alias("known"))
        scores = scores.join(sizes, "pattern").withColumn("share", F.col("known") / (F.col("n") + 1)).filter(
            (F.col("known") >= settings.least_known) & (F.col("share") >= settings.least_share))
        best = scores.groupBy("pattern").agg(F.max(F.struct("share", -F.col("kind"), "n")).alias("b")).select(
            "pattern", (-F.col("b.col2")).alias("kind"), F.col("b.share").alias("share"), F.col("b.n").alias("n"))
        good = written(best, "patterns")
        if good.isEmpty():
            return good
        lifted = look_up(edges, good, "pattern", ["kind", "share"], None, total, F.col("value"))
        values = lifted.filter("kind is not null and seed_kind is null").groupBy("value").agg(
            F.max(F.struct("share", -F.col("kind"))).alias("b")).select(
            "value", (-F.col("b.col2")).alias("kind"), F.col("b.share").alias("weight")).join(degree, "value")
        learned = look_up(edges.select("pattern", "value", "seed_kind"), values, "value", ["kind", "weight"], None,
                          total, F.col("pattern"))
        belief = written(learned.select(
            "pattern", "value", F.coalesce("seed_kind", "kind").alias("kind"),
            F.when(F.col("seed_kind").isNotNull(), 1.0).otherwise(F.col("weight")).alias("weight")), "beliefs")
    return good


def spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          settings: Settings = Settings()) -> DataFrame:
    """``id``, ``base`` and ``found`` of every row.

    ``base`` are the spans of the fixed forms, ``found`` those that good patterns
    add (``kind``, ``start``, ``end``, ``value``); a found span never overlaps a base
    span.  Texts without any give empty arrays, repeated rows the same result each.
    """
    rows = written(forms(docs, id_column, text_column, settings), "forms")
    good = good_patterns(rows, settings)
    places = rows.select("row_key", F.explode("others").alias("s")).select(
        "row_key", "s.start", "s.end", "s.value", F.explode(_contexts(F.col("s.left"), F.col("s.right"))).alias("pattern"))
    total = max(1, places.count())
    hits = look_up(places, good, "pattern", ["kind", "share"], None, total, F.col("row_key")).filter("kind is not null")
    best = hits.groupBy("row_key", "start", "end", "value").agg(F.max(F.struct("share", -F.col("kind"))).alias("b"))
    found = best.groupBy("row_key").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("b.col2")).alias("kind"), "start", "end", "value"))).alias("found"))
    joined = rows.join(found, "row_key", "left")
    empty = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    return joined.select("id", "base", F.coalesce("found", empty).alias("found"))
