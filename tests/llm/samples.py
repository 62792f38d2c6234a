"""Small documents with all that operators must stand: nulls, blanks, long texts, copies, clashing names."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, per_line: int = 12) -> str:
    rnd = random.Random(seed)
    out = [f"{rnd.choice('bcdfgklmnprst')}{rnd.choice('aeiouéü')}{rnd.choice('lmnrst')}{rnd.randrange(200)}" for _ in range(words)]
    return "\n".join(" ".join(out[k : k + per_line]) for k in range(0, words, per_line))


def edited(text: str, every: int, seed: int = 0) -> str:
    words = text.split(" ")
    for k in range(seed % every, len(words), every):
        words[k] = f"edit{seed}x{k}"
    return " ".join(words)


def awkward_rows() -> list[tuple]:
    base = prose(1, 120)
    return [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, base.upper(), "en", None, None),
        (4, None, "en", "a", None),
        (5, "", None, "b", 0),
        (6, " \t\n\r\n ", "en", "b", 5),
        (7, "one two\x0bthree", None, None, 3),
        (8, "one two three", None, None, 3),
        (None, edited(base, 60), "de", "c", 9),
        (None, None, None, None, None),
        (9, "x" * 300_000, "de", "c", 9),
        (10, " ".join(["so"] * 30_000), "de", "c", 9),
        (11, edited(base, 50, 7), "de", "😀", 9),
        (12, edited(base, 6, 3), "de", "Z", 9),
        (13, "été 漢字 ÀB 😀" + prose(5, 70), "fr", "Z", 9),
        (-14, "#$%&|<> " + prose(5, 70), "fr", "Z", 9),
        (15, "\n".join(["same line of five words"] * 3), "fr", "a", 9),
    ]


def documents(spark, rows=None):
    """Documents with further columns whose names operators use inside."""
    frame = spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)
    names = ("n", "h", "doc", "line", "words", "kind", "bits", "size", "position", "n_lines", "kept", "start", "term", "a", "node")
    return frame.withColumns({name: F.lit("other") for name in names})


def empty(spark):
    return documents(spark).limit(0)
