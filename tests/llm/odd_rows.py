"""Small tables with what real ones hold: nulls, empty and long texts, copies, odd columns."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, row string, row_id long, `key0` string"

LONG = "the quick brown fox jumps over the lazy dog 12 times and more " * 4000


def documents(spark):
    rows = [
        (1, "One two three four five six seven.", "en", "a"),
        (2, "One two  three\tfour five six seven.", "en", "a"),
        (3, "One two three four five six seven.", "en", "b"),
        (3, "One two three four five six seven.", "en", "b"),
        (4, "", "en", "a"),
        (5, None, "en", None),
        (6, " \n\t ", None, "b"),
        (7, "Un deux trois quatre cinq", "fr", "c"),
        (8, LONG, "en", "a"),
        (9, LONG + "end", "en", "a"),
        (None, "no id here at all", "en", "a"),
        (None, "no id here at all", "en", "a"),
        (None, None, None, None),
        (10, "é日本語 😀 ünïcödé", "fr", "c"),
        (11, "12345 !!! ---", None, "c"),
    ]
    full = [(*r, None if r[1] is None else len(r[1]), "clash", i, "k") for i, r in enumerate(rows)]
    return spark.createDataFrame(full, DOCUMENTS)


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def collect(df):
    return [row.asDict() for row in df.collect()]
