"""Near-duplicate lines by deletion neighbourhoods (operator 6), DataFrame functions only.

A line is dropped when an earlier line of the corpus, in the order of document id
and line number, has the same words or, for longer lines, words one edit away: one
word changed, left out or put in. A line is its words; blank lines and lines of
fewer than ``min_words`` words stay whatever they repeat.

1. Lines with the same words are one entry, at the earliest place they occur.
2. Lines one word apart share the words of their first or last half. Lines that
   share no half with another entry are done.
3. The others emit a hash for each variant with one word deleted. Equal variants
   with the gap at one place are a changed word; a variant equal to a whole line
   is a word put in. Each entry is tied to the earliest of its key only, so a
   template of any number of lines gives one tie a line.
4. Ties are verified on the words themselves before the later line goes.

Hashes of lines and variants have 64 bits. Null ids sort last. Rows that share id
and text lose the same lines. A null text stays null, an empty one stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.tables import WHITE, kept_table, small_side

BLANKS = " \t\v\f\r"
#: Null ids sort behind every other.
LAST = (1 << 63) - 1


def line_words(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(BLANKS)), f"{WHITE}+")


def half_keys(words: Column, n: Column) -> Column:
    """Hashes of the first and last half: two for an odd number of words, else four."""
    keys = []
    for half in (F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")):
        keys.append(F.xxhash64(F.lit("first"), half, F.slice(words, F.lit(1), half)))
        keys.append(F.xxhash64(F.lit("last"), half, F.slice(words, n - half + 1, half)))
    return F.array_distinct(F.array(*keys))


def lines_of(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """``doc``, ``body`` (hash of the text), ``line``, ``h`` (hash of the words), ``n``, ``halves``."""
    return (
        docs.where("text is not null")
        .select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("body"), "text")
        .select("doc", "body", F.posexplode(F.split("text", "\n")).alias("line", "string"))
        # As a generated column the words are split once, not again in the filter.
        .select("doc", "body", "line", F.explode(F.array(line_words(F.col("string")))).alias("words"))
        .withColumn("n", F.when(F.element_at("words", 1) == "", 0).otherwise(F.size("words")))
        .where(F.col("n") >= min_words)
        .select(
            "doc",
            "body",
            "line",
            F.xxhash64("words").alias("h"),
            "n",
            F.when(F.col("n") >= near_words, half_keys(F.col("words"), F.col("n"))).alias("halves"),
        )
    )


def may_be_near(entries: DataFrame) -> DataFrame:
    """Hashes of entries that share half their words with another entry."""
    halves = entries.where("halves is not null").select("h", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low != high")
    return halves.join(shared.select("half"), "half", "left_semi").select("h").distinct()


def candidate_words(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """The words of candidate lines, read at the earliest place of each."""
    near = entries.join(may_be_near(entries), "h", "left_semi").select("h", "n", "first")
    per_doc = kept_table(
        near.groupBy(F.col("first.doc").alias("doc"), F.col("first.body").alias("body")).agg(
            F.collect_list(F.struct("first.line", "h", "n")).alias("wanted")
        ),
        "candidates",
    )
    return (
        docs.where("text is not null")
        .select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("body"), "text"
        )
        .join(small_side(per_doc), ["doc", "body"])
        .withColumn("strings", F.split("text", "\n"))
        .select("doc", "body", "strings", F.inline("wanted"))
        .select("h", "n", "doc", "body", "line", line_words(F.element_at("strings", F.col("line") + 1)).alias("words"))
    )


def variants(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole-line keys (``h``, ``place``, ``key``), and for each deleted word ``gap`` and ``rest``.

    The hash of a line is the XOR of hashes of words with their place. Running
    XORs over the words before the gap, and over those behind it moved up by one,
    give the hash of every variant in time linear in the line.
    """
    one = (
        candidates.select("h", "n", "doc", "line", F.posexplode("words").alias("gap", "word"))
        .withColumn("here", F.xxhash64("word", "gap"))
        .withColumn("moved", F.xxhash64("word", F.col("gap") - 1))
        .drop("word")
    )
    line = Window.partitionBy("h", "doc", "line").orderBy("gap")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = (
        one.withColumn("left", F.coalesce(F.bit_xor("here").over(before), F.lit(0)))
        .withColumn("right", F.coalesce(F.bit_xor("moved").over(before), F.lit(0)))
        .withColumn("moved_all", F.bit_xor("moved").over(whole))
        .select(
            "h",
            "n",
            F.struct("doc", "line").alias("place"),
            "gap",
            F.col("left").bitwiseXOR(F.col("right")).bitwiseXOR(F.col("moved_all")).bitwiseXOR(F.col("moved")).alias("rest"),
        )
    )
    full = one.groupBy("h", "n", "doc", "line").agg(F.bit_xor("here").alias("rest")).select(
        "h", "n", F.struct("doc", "line").alias("place"), "rest"
    )
    return full, rest


def ties(full: DataFrame, rest: DataFrame) -> DataFrame:
    """``later``, ``earlier`` (line hashes) and ``gap`` in the longer or both."""
    same_gap = Window.partitionBy("n", "gap", "rest").orderBy("place")
    changed = (
        rest.withColumn("first", F.first(F.struct("place", "h")).over(same_gap))
        .where("h != first.h")
        .select(F.col("h").alias("later"), F.col("first.h").alias("earlier"), "gap", F.lit(True).alias("changed"))
    )
    put_in = (
        rest.select("h", "place", "gap", "rest", F.col("n").alias("long"))
        .join(full.select(F.col("h").alias("short"), F.col("place").alias("at"), "rest", (F.col("n") + 1).alias("long")), ["rest", "long"])
        .select(
            F.when(F.col("at") < F.col("place"), F.col("h")).otherwise(F.col("short")).alias("later"),
            F.when(F.col("at") < F.col("place"), F.col("short")).otherwise(F.col("h")).alias("earlier"),
            "gap",
            F.lit(False).alias("changed"),
        )
    )
    return changed.union(put_in).groupBy("later", "earlier", "changed").agg(F.min("gap").alias("gap"))


def near_lines(candidates: DataFrame) -> DataFrame:
    """Hashes of lines that have an earlier line one word away, verified."""
    # Rows that share id and text give a line once each; its XORs need every word once.
    found = ties(*variants(candidates.dropDuplicates(["h"])))
    words_of = lambda x: candidates.select(F.col("h").alias(x), F.col("words").alias(f"{x}_words"))
    without = lambda a: F.concat(F.slice(a, F.lit(1), F.col("gap")), F.slice(a, F.col("gap") + 2, F.size(a)))
    later, earlier = F.col("later_words"), F.col("earlier_words")
    return (
        found.join(words_of("earlier"), "earlier")
        .join(words_of("later"), "later")
        .where(
            F.when(F.col("changed"), without(later) == without(earlier))
            .when(F.size(later) > F.size(earlier), without(later) == earlier)
            .otherwise(without(earlier) == later)
        )
        .select(F.col("later").alias("h"))
        .distinct()
    )


def dropped_lines(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """``doc``, ``body``, ``exact`` and ``near``: numbers of the lines to drop, of documents that have any."""
    lines = kept_table(lines_of(docs, min_words, near_words), "lines")
    entries = lines.groupBy("h").agg(
        F.min(F.struct("doc", "body", "line")).alias("first"), F.min("n").alias("n"), F.first("halves").alias("halves"),
        F.count("*").alias("times"),
    )
    entries = kept_table(entries, "entries")
    candidates = kept_table(candidate_words(docs, entries), "candidate-words")
    near = near_lines(candidates).withColumn("near", F.lit(True))
    going = entries.join(near, "h", "left").where("times > 1 or near").select("h", "first", "near")
    return (
        lines.select("doc", "body", "line", "h")
        .join(going, "h")
        .withColumn("repeat", F.struct("doc", "body", "line") != F.col("first"))
        .where("repeat or near")
        .groupBy("doc", "body")
        .agg(
            F.collect_set(F.when(F.col("repeat"), F.col("line"))).alias("exact"),
            F.collect_set(F.when(~F.col("repeat"), F.col("line"))).alias("near"),
        )
    )


def line_dedup(docs: DataFrame, min_words: int = 5, near_words: int = 10) -> DataFrame:
    """The documents with their columns, duplicate lines taken out of ``text``.

    Adds ``n_lines`` (lines of the text, 0 if null), ``n_exact`` and ``n_near``,
    the lines dropped as equal to, or one word away from, an earlier line.
    """
    drops = kept_table(dropped_lines(docs, min_words, near_words), "drops")
    drops = drops.select(*[F.col(c).alias(f"_{c}") for c in drops.columns])
    strings = F.split("text", "\n")
    gone = F.array_union("_exact", "_near")
    kept = F.expr("array_join(filter(_strings, (x, i) -> not array_contains(_gone, i)), '\n')")
    joined = docs.join(
        small_side(drops),
        (F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)) == F.col("_doc")) & (F.xxhash64("text") == F.col("_body")),
        "left",
    )
    counts = {
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(strings)).cast("long"),
        "n_exact": F.coalesce(F.size("_exact"), F.lit(0)).cast("long"),
        "n_near": F.coalesce(F.size("_near"), F.lit(0)).cast("long"),
    }
    others = [c for c in docs.columns if c not in counts]
    new_text = F.when(F.col("_exact").isNull(), F.col("text")).otherwise(kept)
    return (
        joined.withColumns({"_strings": F.when(F.col("_exact").isNotNull(), strings), "_gone": gone})
        .withColumns(counts)
        .withColumn("_kept", new_text)
        .select(*[F.col("_kept").alias("text") if c == "text" else F.col(c) for c in others], *counts)
    )
