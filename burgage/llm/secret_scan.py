"""Secret scans: certain spans by pattern, weak ones only where complementary parts co-occur.

A credential has parts: an identifier, a secret and an endpoint. Certain spans (assignments,
access keys, long hex runs) are always reported. Weak candidates (user names, mixed tokens,
addresses) are kept only when a part of another role lies within REACH characters of the same
document and one of the two is a secret. That is an interval join: a part is put into the blocks
of text that it reaches, and a weak one looks for partners in its own block.

DataFrame functions only. No match of the patterns holds a line break, and none is empty, so the
pieces between matches and the matches themselves add up to the text; their running lengths are
the positions, in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

REACH = 200  # characters between parts of one credential

# Fixed by the contract: pattern, group to measure, least length of it.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
BASE = (("assign", ASSIGN, 2, 6),
        ("access", "AKIA[A-Z0-9]{16,}", 0, 20),   # a run of 20 or more from its first AKIA on
        ("hex", "[0-9a-f]{24,}", 0, 24))
# Weak candidates.
USER = (r"""(?i:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]"""
        r"""\x20*["']?[A-Za-z0-9_.@+-]{3,}""")
WEAK = (("user", USER, 0, 5),
        ("mixed", "[A-Za-z0-9+/=_-]{32,}", 0, 32),  # and upper case, lower case and a digit
        ("endpoint", r"(?i:https?|jdbc:[a-z]{2,20}|s3|postgres(?:ql)?|mysql|mongodb|redis|amqp)"
                     r"""://[^\x20\x09-\x0D"'<>]{4,}""", 0, 8))
LITERAL = {"access": "AKIA", "endpoint": "://"}  # what each match of these holds
KINDS = [k for k, *_ in BASE + WEAK]
AROUND = [KINDS.index(k) for k in ("access", "user", "endpoint")]
ROLES = {"assign": "secret", "access": "id", "hex": "secret", "user": "id", "mixed": "secret",
         "endpoint": "endpoint"}


MATCH = "array<struct<kind:int,at:int,gap:bigint,size:bigint,good:boolean>>"


def _matches(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Array of (kind, at, gap, size, good): the match's number, the piece before it, its length.

    Most texts have no match. One look tells, and only the others are taken apart.
    """
    p = F.lit(pattern)
    full = F.regexp_extract_all(text, p, F.lit(0))
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), full.alias("full"),
                          (F.regexp_extract_all(text, p, F.lit(group)) if group else full).alias("part"))

    def one(x, i):
        good = F.length(x["part"]) >= least
        if kind == "mixed":
            good = good & x["part"].rlike("[A-Z]") & x["part"].rlike("[a-z]") & x["part"].rlike("[0-9]")
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("at"),
                        F.length(x["piece"]).cast("long").alias("gap"),
                        F.length(x["full"]).cast("long").alias("size"), good.alias("good"))

    found = F.filter(F.transform(zipped, one), lambda x: x["size"].isNotNull()).cast(MATCH)
    may = text.rlike(pattern)
    if kind in LITERAL:
        may = text.contains(LITERAL[kind]) & may
    return F.when(may, found).otherwise(F.array().cast(MATCH))


def has_certain(text: Column) -> Column:
    """Whether a text holds a certain span; no positions needed. False for null."""
    found = F.lit(False)
    for kind in BASE:
        found = found | F.exists(_matches(text, *kind), lambda x: x["good"])
    return F.coalesce(text.isNotNull() & found, F.lit(False))


def _parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc, kind, start, stop): good matches, and a row without kind for each document.

    `row` tells documents apart whatever their ids are. It is made in the one pass over `docs`,
    whose matches are written, so all later steps see the same numbers.

    A weak secret inside an endpoint or an identifier is part of that, such as the path of an
    ordinary address, and is left out.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = written(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"),
        F.concat(*(_matches(text, *k) for k in BASE + WEAK)).alias("found")), "matches")
    each = rows.select("row", "doc", F.explode_outer("found").alias("m")).select("row", "doc", "m.*")
    before = Window.partitionBy("row", "kind").orderBy("at")
    stop = F.sum(F.col("gap") + F.col("size")).over(before)
    found = (each.where("kind is not null").withColumn("stop", stop).where("good")
             .select("row", "doc", "kind", (F.col("stop") - F.col("size")).alias("start"), "stop"))
    around = F.max(F.when(F.col("kind").isin(AROUND), F.col("stop"))).over(
        Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0))
    found = (found.withColumn("around", around)
             .where((F.col("kind") != KINDS.index("mixed")) | F.col("around").isNull()
                    | (F.col("around") < F.col("stop"))).drop("around"))
    none = rows.select("row", "doc", F.lit(None).cast("int").alias("kind"),
                       F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"))
    return none.union(found)


def _linked(parts: DataFrame, reach: int) -> DataFrame:
    """The weak parts that lie within `reach` of a part that completes them."""
    role = F.element_at(F.array(*(F.lit(ROLES[k]) for k in KINDS)), F.col("kind") + 1)
    p = parts.where("kind is not null").withColumn("role", role)
    weak = p.where(F.col("kind") >= len(BASE)).withColumn(
        "block", F.floor(F.col("start") / reach))
    # A weak part lies in the blocks from its start to its stop; others are offered to the blocks
    # within their reach. Where the two intervals meet, both have the block of that place.
    last = F.floor((F.col("stop") + reach) / reach)
    first = F.floor(F.greatest(F.col("start") - reach, F.lit(0)) / reach)
    offered = p.select(F.col("row").alias("row2"), F.explode(F.sequence(first, last)).alias("block2"),
                       F.col("role").alias("role2"), F.col("start").alias("start2"),
                       F.col("stop").alias("stop2"))
    wide = weak.select("row", "doc", "kind", "start", "stop", "role", F.explode(F.sequence(
        F.col("block"), F.floor(F.col("stop") / reach))).alias("block"))
    near = ((F.col("row") == F.col("row2")) & (F.col("block") == F.col("block2"))
            & (F.col("role") != F.col("role2"))
            & ((F.col("role") == "secret") | (F.col("role2") == "secret"))
            & (F.col("start2") <= F.col("stop") + reach) & (F.col("start") <= F.col("stop2") + reach))
    return (wide.join(offered, near, "left_semi")
            .select("row", "doc", "kind", "start", "stop").distinct())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         reach: int = REACH) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) for each row of `docs`.

    A null text counts as empty; rows without spans have zero counts, the hash of an empty text
    and empty spans. Rows with a null or repeated id stay apart. Spans are kind:start:end by
    start, then kind, weak kinds after the base ones. Other columns are not looked at.

    Texts never move: tasks find the matches, and only positions are shuffled. Spans of one text
    come together, which its length bounds.
    """
    parts = written(_parts(docs, id_col, text_col), "parts")
    certain = parts.where(F.col("kind").isNull() | (F.col("kind") < len(BASE)))
    both = certain.union(_linked(parts, reach))
    span = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "stop"))
    name = F.array(*map(F.lit, KINDS))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"),
            s["stop"].cast("string"))), ",")

    grouped = both.groupBy("row").agg(
        F.first("doc").alias("doc_id"),
        *(F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)),
        F.array_sort(F.collect_list(span)).alias("all"))
    return grouped.select(
        "doc_id", *(f"n_{k}" for k, *_ in BASE),
        F.sha2(text(F.filter("all", lambda s: s["kind"] < len(BASE))), 256).alias("base_sha256"),
        text(F.col("all")).alias("spans"))


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents in which `scan` finds nothing.

    Those with certain spans go by a filter on the text; those with linked weak spans alone go by
    their id: rows that share an id with one go with it, and one with a null id stays.
    """
    found = (scan(docs, id_col, text_col).where("spans <> ''")
             .select(F.col("doc_id").alias(id_col)).distinct())
    return docs.where(~has_certain(F.col(text_col))).join(found, id_col, "left_anti").select(docs.columns)
