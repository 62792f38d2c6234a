"""URL verdicts by rules and by a path-template tree (operator 4), DataFrame functions only.

Rules (verdict, host, path) fit their host and its subdomains where a URL's path starts with
theirs; the longest wins. URLs that no rule fits are judged by the template of their path:

1. Per host, digits and long hexadecimal runs in path segments become wildcards, and URLs
   become shapes with counts; the tree is built on shapes.
2. From the root to the last segment, branches are compared with their siblings. A segment is variable where
   ``VARIABLE`` siblings or more have the same path behind them most of the time; these become ``*``, labelled or
   not, unless their labelled share of bad URLs is statistically not that of all siblings. So do branches
   without labels and of a small share of their parent's URLs. Where several have labels, those whose
   share of bad URLs is that of all siblings become ``*#``, which no path contains. Others stay as they are.
3. A template is rejected when its smoothed share of good labels is below a limit, and it has enough labels: some, and a
   share of its URLs, so that a few labels don't judge many URLs. Labels are the verdicts of rules
   unless a column gives others.

Null URLs and those without ``://`` have an empty host and
path and are allowed. Every row gets a row; a host of any number of rows is summed up before it is
shuffled, and joins carry one row a shape on their other side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.tables import kept_table, small_side

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Names of merged branches: values of a variable segment and small ones without labels, and labelled ones like their siblings.
UNLABELLED, ALIKE = "*", "*#"
VARIABLE = 8
#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def with_host_and_path(pages: DataFrame) -> DataFrame:
    rest = F.when(F.col("url").contains("://"), F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    host = F.regexp_extract("_rest", r"^[^/?#]*", 0)
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    return (
        pages.withColumn("_rest", F.coalesce(rest, F.lit("")))
        .withColumns({"host": F.translate(host, UPPER, UPPER.lower()), "path": path})
        .drop("_rest")
    )


def longest_rule(rules: tuple) -> Column:
    """The rule (text, verdict) that fits ``host`` and ``path``, null if none."""
    fitting = [
        F.when(
            ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path),
            F.struct(F.lit(f"{host}{path}").alias("text"), F.lit(verdict).alias("verdict")),
        )
        for verdict, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    ]
    return F.coalesce(*fitting) if fitting else F.lit(None).cast("struct<text:string,verdict:string>")


def shape(path: Column) -> Column:
    """A path with digits and hexadecimal runs generalised."""
    return F.regexp_replace(F.regexp_replace(path, "[0-9a-f]{16,}", "{h}"), "[0-9]+", "{n}")


def template_tree(shapes: DataFrame, least_share: float, z: float) -> DataFrame:
    """``host``, ``shape``, ``template`` of shapes with counts ``urls``, ``good``, ``bad``."""
    kept = ("host", "shape", "urls", "good", "bad")
    counts = [F.sum(c).alias(c) for c in ("urls", "good", "bad")]
    segments = F.split("shape", "/")
    rows = shapes.select(*kept, F.lit("").alias("template"), F.slice(segments, F.lit(2), F.size(segments)).alias("rest"))
    ended, open_rows = [rows.where(F.size("rest") == 0)], rows.where(F.size("rest") > 0)
    while not open_rows.isEmpty():
        # What all shapes under a template share has no branches and is taken in one step.
        ends = kept_table(
            open_rows.groupBy("host", "template").agg(F.min("rest").alias("low"), F.max("rest").alias("high")), "template-ends"
        )
        same = F.zip_with("low", "high", lambda x, y: x.eqNullSafe(y))
        first_unlike = F.array_position(same, F.lit(False))
        shared = ends.select("host", "template", F.when(first_unlike == 0, F.size(same)).otherwise(first_unlike - 1).cast("int").alias("shared"))
        rows = open_rows.join(small_side(kept_table(shared, "shared")), ["host", "template"]).select(
            *kept,
            F.concat("template", F.array_join(F.transform(F.slice("rest", F.lit(1), F.col("shared")), lambda x: F.concat(F.lit("/"), x)), "")).alias("template"),
            F.slice("rest", F.col("shared") + 1, F.size("rest")).alias("rest"),
        )
        rows = rows.withColumn("segment", F.get("rest", F.lit(0)))
        tail = F.array_join(F.slice("rest", F.lit(2), F.size("rest")), "/").alias("tail")
        tails = rows.where("segment is not null").groupBy("host", "template", "segment", tail).agg(*counts)
        most = F.max_by("tail", F.struct("urls", "tail")).alias("tail")
        branches = kept_table(tails.groupBy("host", "template", "segment").agg(*counts, most), "branches")
        # How many siblings have the same path behind them.
        alike = branches.groupBy("host", "template", "tail").agg(F.count("*").alias("alike")).where(F.col("alike") >= VARIABLE)
        parents = branches.groupBy("host", "template").agg(
            *[F.sum(c).alias(f"all_{c}") for c in ("urls", "good", "bad")], F.count(F.when(F.col("good") + F.col("bad") > 0, 1)).alias("labelled")
        )
        labels, all_labels = F.col("good") + F.col("bad"), F.col("all_good") + F.col("all_bad")
        pooled = (F.col("all_bad") + 0.5) / (all_labels + 1)
        differs = F.abs(F.col("bad") / labels - pooled) > z * F.sqrt(pooled * (1 - pooled) / labels)
        unlike = (labels > 0) & F.coalesce(differs, F.lit(True))
        name = (
            F.when(F.col("alike").isNotNull() & ~unlike, UNLABELLED)
            .when((labels == 0) & (F.col("urls") < least_share * F.col("all_urls")), UNLABELLED)
            .when((F.col("labelled") > 1) & (labels > 0) & ~F.coalesce(differs, F.lit(True)), ALIKE)
            .otherwise(F.col("segment"))
        )
        named = branches.join(parents, ["host", "template"]).join(alike, ["host", "template", "tail"], "left").select("host", "template", "segment", name.alias("name"))
        rows = kept_table(
            rows.join(named, ["host", "template", "segment"], "left").select(
                *kept,
                F.when(F.col("name").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "name")).alias("template"),
                F.slice("rest", F.lit(2), F.size("rest")).alias("rest"),
                F.col("name").isNull().alias("done"),
            ),
            "templates",
        )
        over = F.col("done") | (F.size("rest") == 0)
        ended.append(rows.where(over).drop("done"))
        open_rows = rows.where(~over).drop("done")
    return reduce(DataFrame.union, ended).drop("rest")


def url_verdicts(
    pages: DataFrame,
    rules: tuple = RULES,
    label: Column | None = None,
    least_share: float = 0.02,
    z: float = 2.0,
    least_labels: int = 5,
    labelled_share: float = 0.05,
    least_good: float = 0.5,
    weight: float = 2.0,
) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``good_share``.

    label: true for good, false for bad and null for unlabelled URLs. ``good_share`` is smoothed
    towards the share of all labels by ``weight`` further labels.
    """
    rows = with_host_and_path(pages.select("page_id", "url")).withColumn("_rule", longest_rule(rules))
    label = F.col("_rule.verdict") == "allow" if label is None else label
    rows = rows.withColumns({"shape": shape(F.col("path")), "_label": label})
    shapes = kept_table(
        rows.groupBy("host", "shape").agg(
            F.count("*").alias("urls"), F.count(F.when(F.col("_label"), 1)).alias("good"), F.count(F.when(~F.col("_label"), 1)).alias("bad")
        ),
        "shapes",
    )
    tree = kept_table(template_tree(shapes, least_share, z), "templates")
    all_labels = tree.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).first()
    labels = (all_labels["good"] or 0) + (all_labels["bad"] or 0)
    prior = (all_labels["good"] or 0) / labels if labels else 1.0
    own = F.col("good") + F.col("bad")
    purity = tree.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("urls", "good", "bad")]).select(
        "host",
        "template",
        ((F.col("good") + weight * prior) / (own + weight)).alias("good_share"),
        ((own >= least_labels) & (own >= labelled_share * F.col("urls"))).alias("known"),
    )
    judged = kept_table(
        tree.join(purity, ["host", "template"]).select("host", "shape", "template", "good_share", "known"), "judged"
    )
    rejected = F.col("known") & (F.col("good_share") < least_good) & (F.col("host") != "")
    return rows.join(small_side(judged), ["host", "shape"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("_rule.text").alias("rule"),
        F.coalesce("_rule.verdict", F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        "template",
        "good_share",
    )
