"""What the tests of the text operators share."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Null, empty, blank, short, ties, repeated rows.
ODD = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "one"), (5, "one"), (6, "a b c d"), (None, "of no id")]


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    width = len(schema.split(","))
    return spark.createDataFrame([(*r, *[None] * (width - len(r))) for r in rows], schema)


def rows(df):
    return [tuple(r) for r in df.collect()]
