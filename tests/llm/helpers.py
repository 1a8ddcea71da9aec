"""Shared rows of the operator tests: nulls, empty, long and repeated texts, ties, and clashing column names."""

import re

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")

ODD_ROWS = [(None, None, "x"), (None, "", None), (1, "", "x"), (1, "one", "x"), (2, "one two three four", "y"), (2, "one two three four", "y"),
            (3, "é漢 😀   naïve\n\n\tA B c", "y"), (4, " ".join(f"w{i}" for i in range(20000)), "z"), (5, "a" * 30000, "z"), (6, " \n\t ", "z")]


def frame(spark, rows, extra="n long, words string, key long, row long, raw string, kept long, place long, score double"):
    """doc_id, text, lang and columns whose names the operators use inside."""
    width = len(extra.split(","))
    return spark.createDataFrame([(*r, *[None] * width) for r in rows], "doc_id long, text string, lang string, " + extra)


def data(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
