"""Tables with the awkward cases that every operator must bear."""

WORD = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, n long, digest string, spans string, copies int"


def docs(spark, rows=()):
    """doc_id, text, lang, source rows with columns whose names clash with operators' own."""
    return spark.createDataFrame([(*r, 1, 7, 8, "x", "y", 9) for r in rows], SCHEMA)


def awkward():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    long_text = " ".join(WORD[(k * k + k // 7) % 20] + str(k % 97) for k in range(6000))
    return [
        (1, "The first text is written here in plain words and has a few more of them.", "en", "a"),
        (2, None, "en", "a"),
        (3, "", None, None),
        (4, long_text, "en", "b"),
        (5, "The first text is written here in plain words and has a few more of them.", "en", "a"),
        (5, "The first text is written here in plain words and has a few more of them.", "en", "a"),
        (None, "A row without an id still has a text of its own, which is kept as it is.", "en", None),
        (7, "… 123 !!!", "de", "c"),
        (8, "Two\nlines\tand é à ü", None, "c"),
    ]
