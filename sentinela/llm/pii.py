"""Personal data by bootstrapped contextual extraction, in native expressions.

Seeds are what the base patterns find (e-mail, IP, card and phone numbers, each
checked). The words around the seeds are lexical patterns; patterns and instances
form a graph, on which Spark scores both in turn: a pattern by the share of its
instances known to be of one kind, an instance by the patterns that surround it.
Patterns of high confidence then bring in identifiers that no base pattern has; these
count in the next round like seeds, and the words around them are patterns too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentinela.llm.common import written

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns, written so that each attempt is linear: an e-mail's local part
#: starts at its first character (or where the match before ended), and nothing that
#: could not match shorter is tried again.
_FIND = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "token": r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+",  # anything that could be an identifier
}
_NEEDS = {"email": "@", "phone": "+"}

#: Code points of context kept on either side of an instance.
CONTEXT = 64

#: Punctuation around a token is context, as it is around a seed.
_LEAD = r"^[^\p{L}\p{N}_+(:]*+(?:\((?!\+?[0-9]++\))|:(?!:))?[^\p{L}\p{N}_+(:]*+"
_TRAIL = r"(?<=[\p{L}\p{N}_])[^\p{L}\p{N}_]++$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    worth = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_valid(kind: Column, value: Column) -> Column:
    """The check behind each base pattern."""
    low = "25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?"
    part = f"(?:0++(?:{low})?|{low})"
    n = F.length(_digits(value))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(rf"^(?:{part}\.){{3}}{part}$"))
        .when(kind == "card", F.when(n.between(12, 19), _luhn(_digits(value))).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(False)
    )


def could_be(kind: str, value: Column) -> Column:
    """Shapes that a pattern of this kind may bring in."""
    n, v = F.length(_digits(value)), F.regexp_replace(value, r"[^\w)]+$", "")
    return {
        "email": v.rlike(r"^[^@]+@[^@]+$"),
        "ip": v.rlike(r"^(?:[0-9]+\.){2,}[0-9]+$") | v.rlike(r"^[0-9A-Fa-f]*:[0-9A-Fa-f:]*:[0-9A-Fa-f.]*$"),
        "card": v.rlike(r"^[0-9-]+$") & n.between(12, 19),
        "phone": v.rlike(r"^[(+]?[0-9][0-9().-]+$") & n.between(7, 15),
    }[kind]


def scan(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with ``found``: for every kind, its raw matches in order with the
    length of the gap before each, and the text on both sides."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    has_digit = t.rlike("[0-9@]")
    width = F.lit(CONTEXT)
    out = docs
    for kind, regex in _FIND.items():
        guard = has_digit & t.contains(_NEEDS[kind]) if kind in _NEEDS else has_digit
        none = F.array().cast("array<string>")
        out = out.withColumns({
            f"_hits_{kind}": F.when(guard, F.regexp_extract_all(t, F.lit(regex), F.lit(0))).otherwise(none),
            f"_gaps_{kind}": F.when(guard, F.split(t, regex, -1)).otherwise(none),
        })
    for kind in _FIND:
        hits, gaps = F.col(f"_hits_{kind}"), F.col(f"_gaps_{kind}")
        out = out.withColumns({
            # gaps and matches in turn are the text: what a match and the gap on either side add to a context
            f"_ahead_{kind}": F.transform(hits, lambda v, i: F.right(F.concat(F.get(gaps, i), v), width)),  # noqa: B023
            f"_behind_{kind}": F.transform(hits, lambda v, i: F.left(F.concat(v, F.get(gaps, i + 1)), width)),  # noqa: B023
        })

    # a match and its gap have two code points at least, so that so many of them fill a context
    most = CONTEXT // 2
    places = lambda a, b: F.sequence(F.lit(a), F.lit(b))

    def matches(kind: str) -> Column:
        gaps, ahead, behind = (F.col(f"_{x}_{kind}") for x in ("gaps", "ahead", "behind"))

        def one(v: Column, i: Column) -> Column:
            # by place: a slice would copy the whole array for every match
            left = F.concat(F.array_join(F.transform(places(-most, -1), lambda d: F.get(ahead, i + d)), ""), F.get(gaps, i))
            right = F.concat(F.get(gaps, i + 1), F.array_join(F.transform(places(1, most), lambda d: F.get(behind, i + d)), ""))
            lead, tail = F.lit(""), F.lit("")
            value = v
            if kind == "token":
                rest = F.regexp_replace(v, _LEAD, "")
                lead = F.when(rest == "", "").otherwise(F.left(v, F.length(v) - F.length(rest)))
                rest = F.when(rest == "", v).otherwise(rest)
                value = F.regexp_replace(rest, _TRAIL, "")
                tail = F.right(rest, F.length(rest) - F.length(value))
            return F.struct(
                F.lit(kind).alias("kind"),
                i.alias("nth"),
                (F.length(F.get(gaps, i)) + F.length(lead)).cast("long").alias("gap"),
                value.alias("value"),
                F.length(tail).cast("long").alias("tail"),
                F.right(F.concat(left, lead), width).alias("left"),
                F.left(F.concat(tail, right), width).alias("right"),
            )

        return F.transform(F.col(f"_hits_{kind}"), one)

    found = [matches(kind) for kind in _FIND]
    return out.withColumn("found", F.concat(*found)).drop(
        *[f"_{x}_{k}" for k in _FIND for x in ("hits", "gaps", "ahead", "behind")]
    )


def _instances(scanned: DataFrame) -> DataFrame:
    """Checked base matches (``base``) and the tokens that overlap none of them,
    with their places."""
    hits = scanned.select("rid", F.explode("found").alias("x")).select("rid", "x.*")
    order = Window.partitionBy("rid", "kind").orderBy("nth")
    length = F.length("value").cast("long")
    end = F.sum(F.col("gap") + length + F.col("tail")).over(order) - F.col("tail")
    hits = hits.withColumn("end", end).withColumn("start", F.col("end") - length)
    hits = hits.where((F.col("kind") == "token") | is_valid(F.col("kind"), F.col("value")))
    hits = hits.withColumn("base", F.col("kind") != "token")
    by = Window.partitionBy("rid").orderBy("start", "end")
    edge = lambda c: F.when(F.col("base"), F.col(c))
    before = F.max(edge("end")).over(by.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(edge("start")).over(by.rowsBetween(1, Window.unboundedFollowing))
    return (
        hits.withColumns({"before": before, "after": after})
        .where("base OR (coalesce(before <= start, true) AND coalesce(after >= end, true))")
        .drop("before", "after", "nth", "gap", "tail")
    )


def _patterns() -> Column:
    """Lexical patterns of an instance: the two words before it; the word before
    and the word after. A word is a run without white space, lower case."""
    words = lambda c: F.filter(F.split(F.lower(F.col(c)), r"\s+"), lambda w: w != "")
    left, right = words("left"), words("right")
    l1, l2 = F.get(left, F.size(left) - 1), F.get(left, F.size(left) - 2)
    r1 = F.get(right, F.lit(0))
    return F.filter(F.array(F.concat(F.lit("< "), l2, F.lit(" "), l1), F.concat(F.lit("<> "), l1, F.lit(" "), r1)), lambda p: p.isNotNull())


def bootstrap(
    spark: SparkSession,
    instances: DataFrame,
    rounds: int = 3,
    min_support: int = 3,
    min_pattern: float = 0.8,
    min_instance: float = 0.9,
) -> DataFrame:
    """(value, kind) of tokens that patterns of high confidence surround.

    Edges are distinct (instance, pattern) pairs, so one frequent value or
    pattern weighs once per partner; sums per pattern are combined before the
    shuffle. A pattern needs ``min_support`` distinct instances of its kind, seeds or
    tokens taken in the rounds before, and counts from a confidence of ``min_pattern``
    on; a token is taken if the chance that all its patterns are wrong is at most
    1 - ``min_instance``.
    """
    edges = instances.select("kind", "value", F.explode(_patterns()).alias("pattern")).distinct()
    shapes = F.array_compact(F.array(*[F.when(could_be(k, F.col("value")), F.lit(k)) for k in KINDS]))
    edges = written(spark, edges.withColumn("as", F.when(F.col("kind") == "token", shapes).otherwise(F.array("kind"))), "pattern_edges")
    # a pattern's support and confidence are at most those it has if all that could be of a kind are
    able = F.sum((F.size("as") > 0).cast("int"))
    total = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), able.alias("able"))
    total = total.where((F.col("able") >= min_support) & (F.col("able") / F.col("n") >= min_pattern)).drop("able")
    edges = edges.where(F.size("as") > 0).join(total, "pattern")
    edges = written(spark, edges.select("pattern", "n", "kind", "value", F.explode("as").alias("as")), "able_edges")
    known = edges.where("kind <> 'token'").select("as", "value", "kind", F.lit(1.0).alias("score")).distinct()
    tokens = edges.where("kind = 'token'")
    scores = None
    for _ in range(rounds):
        have = known if scores is None else known.unionByName(scores.select("as", "value", F.lit("token").alias("kind"), "score"))
        taken = (F.col("kind") != "token") | (F.col("score") >= min_instance)
        rated = (
            edges.join(have, ["kind", "value", "as"])
            .groupBy("pattern", "as", "n")
            .agg(F.sum("score").alias("good"), F.sum(taken.cast("int")).alias("support"))
            .withColumn("conf", F.col("good") / F.col("n"))
            .where((F.col("support") >= min_support) & (F.col("conf") >= min_pattern))
            .select("pattern", "as", F.least("conf", F.lit(0.999)).alias("conf"))
        )
        scores = written(
            spark,
            tokens.join(rated, ["pattern", "as"])
            .groupBy("as", "value")
            .agg((1 - F.exp(F.sum(F.log1p(-F.col("conf"))))).alias("score")),
            "instance_scores",
        )
    best = Window.partitionBy("value").orderBy(F.desc("score"), "as")
    return (
        scores.where(F.col("score") >= min_instance)
        .withColumn("r", F.row_number().over(best))
        .where("r = 1")
        .select("value", F.col("as").alias("found_kind"))
    )


def find_personal_data(
    spark: SparkSession, docs: DataFrame, text: str = "text", keep: list[str] | None = None, **bootstrapping
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``spans``: array of (start,
    kind_no, end, kind, base), code points, end exclusive, in order; kinds are
    numbered as in ``KINDS``; ``base`` tells base matches from added ones.

    Whole texts are scanned once, and the matches with their contexts written.
    Null and empty texts have no spans; repeated rows have their own; an empty
    table gives no rows; an input column named ``spans`` is replaced.
    """
    taken = {"spans", "found", "rid"}
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    source = docs.select(*dict.fromkeys([*names, text])).withColumn("rid", F.monotonically_increasing_id())
    scanned = written(spark, scan(source, text).select("rid", *names, "found"), "pii_scan")
    instances = written(spark, _instances(scanned), "pii_instances")
    added = bootstrap(spark, instances, **bootstrapping)
    base = instances.where("base").select("rid", "kind", "start", "end", "base")
    more = instances.where("NOT base").join(added, "value").select("rid", F.col("found_kind").alias("kind"), "start", "end", "base")
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    one = F.struct("start", number.alias("kind_no"), "end", "kind", "base")
    spans = base.unionByName(more).groupBy("rid").agg(F.sort_array(F.collect_list(one)).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return scanned.drop("found").join(spans, "rid", "left").withColumn("spans", F.coalesce("spans", empty)).drop("rid")


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span (overlapping ones together) as ``[KIND]``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))
        )

    done = F.aggregate(spans, start, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
