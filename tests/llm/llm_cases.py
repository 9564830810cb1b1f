"""Documents and odd rows shared by the tests of the document operators. The
``spark`` fixture is the one of the folder above."""

from __future__ import annotations

SF001 = "/root/testdata/sf0.001"


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows of (doc_id, text[, lang[, source]])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, r[3] if len(r) > 3 else None,
             None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


#: Null id and text, blank and long texts, repeated rows, odd characters.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "one two three four"),
       (5, "A b c \x1c d e. Été, İz Σας 中文 1⁄2."),
       (6, "word " * 30000), (7, "x" * 50000), (None, None), (8, "a b c d e f g h i j k l m n " * 40)]
