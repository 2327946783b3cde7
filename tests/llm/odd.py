"""A table with the cases every operator has to define."""

LONG = "lorem ipsum dolor sit amet consectetur " * 4000

ROWS = [
    (1, "The cat sat on the mat and it was happy to be there with a dog.", "en", 5),
    (1, "The cat sat on the mat and it was happy to be there with a dog.", "en", 5),
    (2, None, "en", None),
    (3, "", None, 0),
    (None, "El gato que se sienta con la puerta y los perros de una casa.", "es", 1),
    (4, "1234 !!! --- 🙂", "en", 2),
    (5, LONG, None, 3),
    (6, " \n\t  \x0b \n", "es", 4),
    (7, "The cat sat on the mat and it was happy to be there with a dog!", None, 9),
]
SCHEMA = "doc_id long, text string, lang string, n_words long"


def table(spark):
    """With columns whose names operators use themselves."""
    rows = spark.createDataFrame(ROWS, SCHEMA)
    return rows.selectExpr("*", "1 as key", "2 as h", "3 as fp", "'x' as score", "4 as length", "5 as n_lines", "6 as part")
