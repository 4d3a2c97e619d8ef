"""Rows with awkward cases, shared by the tests of the training-data operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names clash with what the operators call things inside.
CLASH = "row long, node string, key long, size long, `drop` string, position double, t string, `first` long, bands string"


def docs_frame(spark, rows, extra=False):
    """(doc_id, text, lang, source) rows as a documents table."""
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    if not extra:
        return spark.createDataFrame(full, SCHEMA)
    return spark.createDataFrame([(*r, 1, "n", 2, 3, "d", 0.5, "t", 4, "b") for r in full], f"{SCHEMA}, {CLASH}")


WORDS = "amber basin cedar delta ember fjord grove harbor island jungle knoll lagoon meadow nectar orchid prairie".split()


def prose(seed, n):
    """n pseudo-random words by a fixed rule."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2 ** 31
        out.append(WORDS[x >> 8 & 15] + WORDS[x >> 16 & 15][:3])
    return " ".join(out)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)
