"""Tables with everything that must not upset an operator."""

from pyspark.sql import functions as F

LONG = "wanderung " * 30_000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. " * 4, "en", "a", 10),
    (1, "The quick brown fox jumps over the lazy dog. " * 4, "en", "a", 10),  # a repeated row
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \n\t ", "de", None, 4),
    (None, "a row without an id", "en", "b", 19),
    (None, None, None, "b", None),
    (5, LONG, "de", "b", len(LONG)),
    (6, "ünïcode   und \U0001f600 mehr", "de", "c", 20),
    (7, "İstanbul Straße ΣΑΣ <|endoftext|> q", "tr", "c", 30),
    (8, "***", "xx", "c", 3),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd_docs(spark):
    """With extra columns whose names clash with columns that operators add."""
    clash = ["fp", "shard", "slot", "id", "cell", "kept", "spans", "n", "component_id", "n_words", "th", "start", "size"]
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).withColumns({c: F.lit("x") for c in clash})


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
