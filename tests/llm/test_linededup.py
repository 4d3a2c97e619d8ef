from helpers import docs_frame, sorted_rows

from riverlens.llm import linededup

A, B, C = "a line of words", "another line of words", "x y"


def brute(rows, min_sites=2, min_words=1):
    import collections
    sites, first = collections.defaultdict(set), {}
    for i, text, _, source in rows:
        for k, raw in enumerate((text or "").split("\n") if text is not None else []):
            line = raw.strip(" \t\r")
            if source is not None:
                sites[line].add(source)
            place = (i is not None, i or 0, k)
            first[line] = min(first.get(line, place), place)
    out = []
    for i, text, _, source in rows:
        if text is None:
            out.append((i, None))
            continue
        kept = []
        for k, raw in enumerate(text.split("\n")):
            line = raw.strip(" \t\r")
            if len(line.split()) >= min_words and len(sites[line]) >= min_sites and (i is not None, i or 0, k) != first[line]:
                continue
            kept.append(raw)
        out.append((i, "\n".join(kept)))
    return sorted(out, key=str)


ROWS = [
    (1, f"{A}\n{B}\n{C}", "en", "s1"),
    (2, f" {A}\t\nown words of two\n{C}", "en", "s2"),
    (3, f"{A}\n{A}\n{B}", "en", "s1"),           # B only on s1: stays
    (4, None, None, None), (5, "", "en", "s3"), (6, "\n\n", "en", "s3"),
    (7, A, "en", None), (None, A, "en", "s4"), (8, C, "en", "s5"),
    (9, f"{B}\r\n{A}", "en", "s1"),
    (10, "\n".join(f"line number {k} here" for k in range(30000)), "en", "s6"),
    (11, "\n".join(f"line number {k} here" for k in range(0, 60000, 2)), "en", "s7"),
]


def test_matches_brute_force(spark):
    out = linededup.remove_boilerplate(docs_frame(spark, ROWS), removed="n_removed")
    assert sorted_rows(out.select("doc_id", "text")) == brute(ROWS)
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()}[11] == 15000
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in out.collect())


def test_higher_threshold_uses_estimates_and_exact_counts(spark):
    rows = [(k, f"common to all of us\nshared by {k % 3} of us", "en", f"s{k % 20}") for k in range(200)]
    out = linededup.remove_boilerplate(docs_frame(spark, rows), min_sites=12)
    assert sorted_rows(out.select("doc_id", "text")) == brute(rows, min_sites=12)


def test_short_lines_count_and_a_minimum_can_be_asked_for(spark):
    rows = [(k, "Les.\n\nAnd ornd.\nown words of two", "en", f"s{k}") for k in range(1, 4)]
    got = {min_words: sorted_rows(linededup.remove_boilerplate(docs_frame(spark, rows), min_words=min_words).select("doc_id", "text"))
           for min_words in (1, 3)}
    assert got[1] == brute(rows) and got[1][1] == (2, "")
    assert got[3] == brute(rows, min_words=3) and got[3][1] == (2, "Les.\n\nAnd ornd.")


def test_clashing_columns_pass_and_empty_table(spark):
    df = docs_frame(spark, ROWS[:3], extra=True)
    out = linededup.remove_boilerplate(df)
    assert out.columns == df.columns and out.schema == df.schema
    assert sorted_rows(out.select("doc_id", "text")) == brute(ROWS[:3])
    assert linededup.remove_boilerplate(df.limit(0)).count() == 0


def test_repeated_rows_keep_one_first_occurrence_each(spark):
    rows = [(1, A, "en", "s1"), (1, A, "en", "s1"), (2, A, "en", "s2")]
    out = sorted_rows(linededup.remove_boilerplate(docs_frame(spark, rows)).select("doc_id", "text"))
    assert out == [(1, A), (1, A), (2, "")]
