"""Given tables and hand-made cases shared by the tests of the text operators."""

import pyarrow.parquet as pq

FOLDER = "/root/testdata/sf0.001"


def documents(folder=FOLDER):
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{folder}/documents.parquet").to_pylist()]


#: Null, empty, blank, control strings, many spaces, ties, repeated rows and a very long text.
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (5, "one two three"), (5, "one two three"),
    (6, "É\u2003ß\xa0x\x1cy <|im_end|> <|endoftext|> \u2581 \u2581a"), (7, "word " * 20_000 + "x" * 50_000),
    (None, "no id"), (8, "\x00 nul \U0001F600 emoji \u0e01\u0e02"),
]


def edge_frame(spark, rows=EDGE, extra=True):
    """The cases with columns of clashing names."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        frame = frame.selectExpr("doc_id", "text", "'en' as lang", "'s' as n_words", "1 as spans", "2L as size", "0 as _text0")
    return frame


def thue_morse(n):
    """The word of ``n`` letters a and b, and its complement: polynomials modulo powers of two can't tell them apart."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate({97: "b", 98: "a"})
