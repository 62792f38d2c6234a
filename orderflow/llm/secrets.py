"""Secrets in whole texts, and credentials of several parts (operator 2), DataFrame functions only.

Base spans are the leftmost non-overlapping matches of each base pattern, those that are long
enough. Beside them stand weak candidates: account identifiers, random-looking strings and
endpoints. Alone they are too common to report. They are reported where parts complement each
other within ``scope`` characters:

- a random-looking string next to an identifier (weak, or a base access key) or an endpoint,
- an identifier next to a secret (random-looking, base assignment or hex),
- an endpoint that has both an identifier and a secret next to it.

A weak candidate that overlaps a base span is not one, and parts that overlap do not complement each other: they are one
value. The interval join sorts the begins and ends of a document's parts and looks at the nearest part of
the other kind before and behind, so it makes no pairs and sorts are all that it costs.

Positions count code points; the end is exclusive. Null and empty texts have no spans. Rows that
share id and text have the same spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.tables import kept_table

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"

IDENTIFIER = (
    r"""(?i:access_?key_?id|client_?id|account_?id|app_?id|user_?name|user|login)"""
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
)
RANDOM = "[A-Za-z0-9+/_-]{32,}={0,2}"
ENDPOINT = r"""(?:[a-z][a-z0-9+]{1,15}://[^\s"'<>]{4,}|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?)"""

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "identifier", "secret", "endpoint")
SPAN = "array<struct<start int, kind int, end int>>"


#: Matches whose starts share a sum of what is before them.
BLOCK = 256


def computed(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once, however often and wherever they are used: a generator's output isn't written out."""
    return rows.select("*", F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def summed(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda so_far, x: so_far + x)


def with_spans(docs: DataFrame, name: str, pattern: str, kind: str) -> DataFrame:
    """Add an array of the spans of a pattern's matches, from the lengths of matches and of the text between them.

    A start is what blocks of matches before its own sum up to, and what is before it in its block: time grows with the
    matches, not with their square. Texts without a match are scanned once.
    """
    docs = computed(docs, _hit=F.coalesce(F.col("text").rlike(pattern), F.lit(False)))
    when = lambda column: F.when(F.col("_hit"), column)
    matched = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    docs = computed(docs, _between=when(F.split("text", pattern, -1)), _matches=when(matched))
    docs = computed(docs, _lengths=F.transform("_matches", lambda x, k: F.length(F.get("_between", k)) + F.length(x)))
    last = F.shiftright(F.size("_lengths") - 1, 8)
    docs = computed(docs, _blocks=when(F.transform(F.sequence(F.lit(0), last), lambda b: summed(F.slice("_lengths", b * BLOCK + 1, F.lit(BLOCK))))))
    docs = computed(docs, _before=F.transform("_blocks", lambda _, b: summed(F.slice("_blocks", F.lit(1), b))))

    def span(match: Column, k: Column) -> Column:
        block = F.call_function("shiftright", k, F.lit(8))
        inside = summed(F.slice("_lengths", block * BLOCK + 1, k - block * BLOCK))
        start = F.get("_before", block) + inside + F.length(F.get("_between", k))
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), F.length(match).alias("length"))

    docs = computed(docs, _spans=F.transform("_matches", span))
    spans = F.transform("_spans", lambda x: F.struct(x["start"], x["kind"], (x["start"] + x["length"]).alias("end")))
    if kind == "assign":
        docs = computed(docs, _values=when(F.regexp_extract_all("text", F.lit(pattern), F.lit(2))))
        spans = F.filter(spans, lambda _, k: F.length(F.get("_values", k)) >= ASSIGN_LEAST)
    elif kind == "secret":
        match = lambda k: F.get("_matches", k)
        spans = F.filter(spans, lambda _, k: match(k).rlike("[0-9]") & match(k).rlike("[A-Z]") & match(k).rlike("[a-z]"))
    docs = docs.withColumn(name, F.coalesce(spans, F.array().cast(SPAN)))
    return docs.drop("_hit", "_between", "_matches", "_lengths", "_blocks", "_before", "_spans", "_values")


def linked_parts(parts: DataFrame, scope: int) -> DataFrame:
    """Weak parts that complementary parts stand next to, without overlapping them.

    parts: ``doc``, ``start``, ``kind``, ``end``, a row each. Begins and ends of all parts of a text are sorted. A begin looks at the
    nearest end before it, an end at the nearest begin behind it, of each kind; both are running sums.
    """
    is_a = {
        "identifier": F.col("kind").isin(KINDS.index("access"), KINDS.index("identifier")),
        "secret": F.col("kind").isin(*[KINDS.index(x) for x in ("assign", "hex", "secret")]),
        "endpoint": F.col("kind") == KINDS.index("endpoint"),
    }
    events = parts.select(
        "doc", "start", "kind", "end", F.inline(F.expr("array(struct(start as at, true as opens), struct(end as at, false as opens))"))
    )
    of_text, at, opens = Window.partitionBy("doc"), F.col("at"), F.col("opens")
    # An end counts for a begin at the same place, and a begin for an end there.
    forth = of_text.orderBy("at", "opens").rowsBetween(Window.unboundedPreceding, -1)
    back = of_text.orderBy(F.desc("at"), F.desc("opens")).rowsBetween(Window.unboundedPreceding, -1)
    near = {}
    for name, test in is_a.items():
        end_before = F.max(F.when(test & ~opens, at)).over(forth)
        begin_behind = F.min(F.when(test & opens, at)).over(back)
        close = F.when(opens, at - end_before <= scope).otherwise(begin_behind - at <= scope)
        near[f"near_{name}"] = F.coalesce(close, F.lit(False))
    kind = F.col("kind")
    return (
        events.withColumns(near)
        .groupBy("doc", "start", "kind", "end")
        .agg(*[F.max(x).alias(x) for x in near])
        .where(
            ((kind == KINDS.index("secret")) & (F.col("near_identifier") | F.col("near_endpoint")))
            | ((kind == KINDS.index("identifier")) & F.col("near_secret"))
            | ((kind == KINDS.index("endpoint")) & F.col("near_identifier") & F.col("near_secret"))
        )
        .select("doc", "start", "kind", "end")
    )


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(
        F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ","
    )


def secret_spans(docs: DataFrame, scope: int = 300) -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``added``, arrays of (start, kind, end), and ``doc``, its key."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("doc"), "text")
    patterns = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("identifier", IDENTIFIER), ("secret", RANDOM), ("endpoint", ENDPOINT))
    for kind, pattern in patterns:
        docs = with_spans(docs, f"_{kind}", pattern, kind)
    base = F.concat(*[F.col(f"_{x}") for x in BASE])
    weak = F.filter(
        F.concat("_identifier", "_secret", "_endpoint"),
        lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])),
    )
    spans = kept_table(docs.withColumn("base", base).select("doc_id", "doc", "base", weak.alias("weak")), "spans")
    parts = (
        spans.where(F.size("weak") > 0)
        .select("doc", F.concat("base", "weak").alias("parts"))
        .dropDuplicates(["doc"])
        .select("doc", F.inline("parts"))
    )
    added = linked_parts(parts, scope).groupBy("doc").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added"))
    return spans.join(added, "doc", "left").select(
        "doc_id", "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"), "doc"
    )


def secret_report(docs: DataFrame, scope: int = 300) -> DataFrame:
    """One row per document: counts of base spans, the digest of their list, and the list of all spans."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == KINDS.index(kind))).cast("long")
    return secret_spans(docs, scope).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
    )
