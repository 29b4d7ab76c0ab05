"""Small odd inputs that every operator must take."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"wort{i % 977} und" for i in range(30_000))
ROWS = [
    (1, "The cat sat on the mat.\nThe cat sat on the mat.", "en", "a", 47),
    (2, "The cat sat on the mat.\nThe cat sat on the mat.", "en", "a", 47),
    (2, "The cat sat on the mat.\nThe cat sat on the mat.", "en", "a", 47),
    (3, None, "en", "a", None),
    (4, "", None, "b", 0),
    (5, " \t\n ", "de", None, 4),
    (6, LONG, "de", "b", len(LONG)),
    (7, "!!! 123 ###", None, None, 11),
    (None, "no id here", "en", "c", 10),
    (8, "école  ÉCOLE l'été d’une　fin. don't <|endoftext|> İ H̱\x1c x", "fr", "c", 40),
]


def documents(spark, rows=ROWS):
    return spark.createDataFrame(rows, DOCUMENTS)


def empty(spark):
    return documents(spark, [])


def crowded(df, *names):
    """The frame with extra columns whose names clash with what operators add."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
