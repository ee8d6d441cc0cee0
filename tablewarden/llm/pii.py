"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Base spans come from four patterns and their checks. Their values are the seeds of a graph: every identifier-like run of
characters (an instance: an address, a number in groups, a colon-separated address) stands in lexical patterns, which are
the two words before it, the word before it, and the words on both sides. A pattern's confidence for a kind is the share of its
distinct instances that are known to be of that kind; an unseen instance takes the best confidence of its patterns; both
are computed in turn ROUNDS times, in whole millionths, so that any order of summing gives the same. Patterns with SEEDS seeds
of a kind and a confidence of SURE or more name the unseen instances in them, if their form can be of that kind.

The graph is two tables of edges, distinct by pattern and instance, so copies of a document add nothing. Every step is
an aggregate that sums before it shuffles, or a join whose hot side adaptive execution splits. Patterns that start a match
at the beginning of a run of characters only, and possessive repeats, keep the base patterns' own matches in linear time.
Places of a text's matches come from running sums in blocks of BLOCK.

Nulls: a null text is the empty text. Very long texts: see above. Ties: of kinds with the same confidence the first in
KINDS holds. Repeated rows are read each for itself. Empty tables give empty tables. Further columns are left alone.
doc_id is an integer; it may be null or repeat, rows have a number of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import narrow, scratch

KINDS = ("email", "ip", "card", "phone")
#: Seeds of a kind that a pattern needs, confidence in millionths that it needs, and rounds of scoring.
SEEDS, SURE, ROUNDS = 3, 600_000, 3
ONE = 1_000_000
#: Code points before and after an instance in which its words stand.
BEFORE, AFTER = 64, 32
BLOCK = 256

#: The contract's patterns, as they stand.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The same matches without starts inside a run and without giving back.
QUICK = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PLAIN["phone"],
}
#: What a text must hold to have a match.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
IP_PARTS = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
#: Identifier-like runs: addresses, colon-separated addresses, numbers in groups.
INSTANCE = r"[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*|[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){2,7}|\+?\(?[0-9](?:[ ().-]{0,2}[0-9])+"
QUICK_INSTANCE = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+|[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){2,7}|\+?\(?[0-9](?:[ ().-]{0,2}[0-9])++"
WORD = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
ASCII = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once a row."""
    return F.transform(F.array(value), body)[0]


def _length(x: Column) -> Column:
    return F.char_length(x).cast("long")


def _running(values: Column) -> Column:
    """Sums of the array up to and with each element; the array is copied for each, so it must be short."""
    return F.aggregate(values, F.array().cast("array<long>"), lambda done, x: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0).cast("long")) + x)))


def running_sums(values: Column) -> Column:
    """Sums of an array<long> up to and with each element, in blocks."""

    def whole(a: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / BLOCK).cast("int")), lambda b: _running(F.slice(a, b * BLOCK + 1, BLOCK)))
        before = lambda rows: F.concat(F.array(F.lit(0).cast("long")), _running(F.transform(rows, lambda r: F.element_at(r, F.lit(-1)))))
        return F.when(F.size(a) == 0, F.array().cast("array<long>")).otherwise(
            let(blocks, lambda rows: F.flatten(F.zip_with(rows, F.slice(before(rows), F.lit(1), F.size(rows)), lambda r, b: F.transform(r, lambda x: x + b))))
        )

    return let(values, whole)


def matches(text: Column, pattern: str) -> Column:
    """All matches in order: array of (start, end, value, before, after), before and after being the text up to the next match."""

    def place(p: Column) -> Column:
        steps = F.zip_with(F.slice(p["gaps"], F.lit(1), F.size(p["found"])), F.slice(F.concat(F.array(F.lit("")), p["found"]), F.lit(1), F.size(p["found"])), lambda g, m: _length(g) + _length(m))
        gaps = F.zip_with(F.slice(p["gaps"], F.lit(1), F.size(p["found"])), F.slice(p["gaps"], F.lit(2), F.size(p["found"])), lambda a, b: F.struct(F.right(a, F.lit(BEFORE)).alias("before"), F.left(b, F.lit(AFTER)).alias("after")))
        placed = F.zip_with(running_sums(steps), p["found"], lambda at, m: F.struct(at.alias("start"), (at + _length(m)).alias("end"), m.alias("value")))
        return F.zip_with(placed, gaps, lambda m, g: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), g["before"].alias("before"), g["after"].alias("after")))

    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return let(found, place)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: str, value: Column) -> Column:
    """Whether a match of the kind's pattern passes the kind's check."""
    n = F.char_length(_digits(value))
    return {"email": F.lit(True), "ip": value.rlike(IP_PARTS), "card": n.between(13, 19) & F.call_function("luhn_check", _digits(value)), "phone": n.between(9, 15)}[kind]


def base_spans(text: Column) -> Column:
    """array of (kind: place in KINDS, start, end), by kind and start; ends are exclusive, in code points."""
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")

    def of(i: int, kind: str) -> Column:
        held = F.filter(matches(text, QUICK[kind]), lambda m: _holds(kind, m["value"]))
        spans = F.transform(held, lambda m: F.struct(F.lit(i).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
        return F.when(text.rlike(HINTS[kind]), spans).otherwise(none)

    return F.concat(*(of(i, kind) for i, kind in enumerate(KINDS)))


def _instance(m: Column) -> Column:
    """Of a match: its normal form, the kind that it is a seed of (null: unseen), the kinds that its form can be of, its patterns."""
    value = m["value"]
    n, address, colons = F.char_length(_digits(value)), value.rlike(r"@|\(at\)|\[at\]"), value.contains(":")
    normal = F.when(address | colons, F.translate(F.regexp_replace(value, " ", ""), *ASCII)).otherwise(_digits(value))
    seed = F.coalesce(*[F.when(value.rlike(f"^(?:{QUICK[k]})$") & _holds(k, value), F.lit(i)) for i, k in enumerate(KINDS)])
    number = ~address & ~colons
    can = [address, colons, number & n.between(12, 19) & value.rlike("^[0-9 -]+$"), number & n.between(7, 15)]
    words = lambda x: F.regexp_extract_all(F.translate(x, *ASCII), F.lit(WORD), F.lit(0))

    def patterns(w: Column) -> Column:
        b, c = F.try_element_at(w["l"], F.lit(-1)), F.try_element_at(w["r"], F.lit(1))
        a = F.try_element_at(w["l"], F.lit(-2))
        return F.filter(F.array(F.concat(F.lit("2 "), a, F.lit(" "), b), F.concat(F.lit("1 "), b), F.concat(F.lit("r "), b, F.lit(" _ "), c)), lambda p: p.isNotNull())

    return F.struct(
        m["start"].alias("start"),
        m["end"].alias("end"),
        F.sha2(normal, 256).alias("value"),
        seed.alias("seed"),
        F.array(*can).alias("can"),
        let(F.struct(words(m["before"]).alias("l"), words(m["after"]).alias("r")), patterns).alias("patterns"),
    )


def instances(text: Column) -> Column:
    """The identifier-like runs of a text that stand apart from letters and digits, with what the graph needs of them."""
    apart = lambda m: ~F.right(m["before"], F.lit(1)).rlike("[A-Za-z0-9_]") & ~F.left(m["after"], F.lit(1)).rlike("[A-Za-z0-9_]")
    found = F.transform(F.filter(matches(text, QUICK_INSTANCE), apart), _instance)
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string,seed:int,can:array<boolean>,patterns:array<string>>>")
    return F.when(text.rlike("[0-9@]|[(\\[]at[)\\]]"), found).otherwise(none)


def read_texts(df: DataFrame) -> DataFrame:
    """row (a number of its own), doc_id, base, found of every document, written once."""
    own = narrow(df, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", base_spans(F.col("text")).alias("base"), instances(F.col("text")).alias("found"))
    return scratch(own, "pii_texts")


def learn_patterns(texts: DataFrame, seeds: int = SEEDS, sure: int = SURE, rounds: int = ROUNDS) -> DataFrame:
    """pattern and p0 to p3, its confidence in millionths for each of KINDS (0 where it is not sure enough)."""
    ks = range(len(KINDS))
    runs = texts.select(F.explode("found").alias("i")).select("i.value", "i.seed", "i.can", F.explode("i.patterns").alias("pattern"))
    edges = scratch(runs.groupBy("pattern", "value").agg(F.max("seed").alias("seed"), *[F.max(F.col("can")[k]).alias(f"can{k}") for k in ks]), "pii_edges")
    counts = edges.groupBy("pattern").agg(F.count("*").alias("n"), *[F.count(F.when(F.col("seed") == k, 1)).alias(f"known{k}") for k in ks])
    #: Only these can ever be sure: all others lack seeds.
    rich = counts.filter(F.greatest(*[F.col(f"known{k}") for k in ks]) >= seeds)
    unseen = scratch(edges.filter(F.col("seed").isNull()).join(rich.select("pattern"), "pattern", "left_semi"), "pii_unseen")
    rich = scratch(rich, "pii_patterns")

    def confident(sums: DataFrame | None) -> DataFrame:
        df = rich.withColumns({f"s{k}": F.lit(0) for k in ks}) if sums is None else rich.join(sums, "pattern", "left").fillna(0, [f"s{k}" for k in ks])
        p = {k: F.expr(f"(known{k} * {ONE}L + s{k}) div (n + 1)") for k in ks}
        return df.select("pattern", *[F.when((F.col(f"known{k}") >= seeds) & (p[k] >= sure), p[k]).otherwise(F.lit(0)).cast("long").alias(f"p{k}") for k in ks])

    now = scratch(confident(None), "pii_scores")
    for _ in range(rounds - 1):
        scored = unseen.join(now, "pattern").groupBy("value").agg(*[F.max(F.when(F.col(f"can{k}"), F.col(f"p{k}")).otherwise(0)).alias(f"s{k}") for k in ks])
        sums = unseen.select("pattern", "value").join(scored, "value").groupBy("pattern").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in ks])
        now = scratch(confident(sums), "pii_scores")
    return now.filter(F.greatest(*[F.col(f"p{k}") for k in ks]) > 0)


def discover(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """row, kind, start, end of unseen instances in sure patterns; what touches a base span is left to that."""
    ks = range(len(KINDS))
    unseen = texts.select("row", F.explode("found").alias("i")).filter(F.col("i.seed").isNull())
    places = unseen.select("row", "i.start", "i.end", "i.can", F.explode("i.patterns").alias("pattern")).join(patterns, "pattern")
    best = F.greatest(*[F.when(F.col("can")[k], F.struct(F.col(f"p{k}").alias("p"), F.lit(-k).alias("k"))) for k in ks])
    named = places.withColumn("best", best).filter(F.col("best.p") > 0).groupBy("row", "start", "end").agg(F.max("best").alias("best"))
    new = scratch(named.select("row", (-F.col("best.k")).alias("kind"), "start", "end"), "pii_new")
    base = texts.select("row", F.explode("base").alias("b")).join(new.select("row"), "row", "left_semi").select("row", "b.kind", "b.start", "b.end", F.lit(True).alias("base"))
    both = new.select("row", "kind", "start", "end", F.lit(False).alias("base")).unionByName(base)
    up = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumns({"until": F.max(F.when(F.col("base"), F.col("end"))).over(up), "since": F.min(F.when(F.col("base"), F.col("start"))).over(down)})
    free = ~F.col("base") & ~F.coalesce(F.col("until") > F.col("start"), F.lit(False)) & ~F.coalesce(F.col("since") < F.col("end"), F.lit(False))
    return near.filter(free).select("row", "kind", "start", "end")


def _said(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_private(df: DataFrame) -> DataFrame:
    """doc_id, base and spans (arrays of kind, start, end; spans with the discovered ones) of every document."""
    texts = read_texts(df)
    new = discover(texts, learn_patterns(texts)).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    joined = texts.select("row", "doc_id", "base").join(new, "row", "left")
    return joined.select("doc_id", "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more"))).alias("spans"))


def digest_private(df: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_found (spans that the patterns added)."""
    of = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    counted = [of(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return find_private(df).select("doc_id", *counted, F.sha2(_said(F.col("base")), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_found"))
