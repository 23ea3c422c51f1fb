import duckdb
import pyarrow as pa
import pytest

# Names that operators use inside; a table may have them too.
CLASHING = ("row", "size", "kept", "doc", "tag", "ids", "rank", "bucket", "words", "key", "cls", "part")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with clashing extra columns."""

    def make(rows):
        full = [
            (i, t, "en", r[0] if r else "s", None if t is None else len(t), *range(len(CLASHING)))
            for i, t, *r in rows
        ]
        extra = ", ".join(f"{name} int" for name in CLASHING)
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def in_duckdb():
    """Rows of a SQL text over the first four columns of documents."""

    def run(sql, rows):
        columns = list(zip(*[(i, t, r[0] if r else "s") for i, t, *r in rows])) or [(), (), ()]
        types = (pa.int64(), pa.string(), pa.string())
        table = pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "text", "source"])
        con = duckdb.connect()
        con.register("documents", table)
        relation = con.sql(sql)
        return relation.columns, relation.fetchall()

    return run


@pytest.fixture(scope="session")
def same(in_duckdb):
    """Whether a result and a SQL text agree on the given documents, whatever the order."""

    def check(df, sql, rows):
        names, expected = in_duckdb(sql, rows)
        got = [tuple(r) for r in df.select(*names).collect()]
        key = lambda row: tuple((v is not None, v) for v in row)
        assert sorted(got, key=key) == sorted(expected, key=key)

    return check


LONG = " ".join(f"w{i % 977}" for i in range(4_000))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, ties, null ids, one very long text."""
    line = "This line stands in several documents."
    return [
        (1, None), (2, ""), (3, " \n\t\n"), (4, "word"), (5, f"{line}\nown line of five"),
        (6, f"  {line.upper()}  \nother words here\n\n{line}"), (6, f"{line}\nsame id, other text"),
        (7, f"{line}\nrepeated row"), (7, f"{line}\nrepeated row"), (None, f"{line}\nno id"),
        (8, LONG), (9, LONG + " more"), (10, "a b c d e f g h i j " * 12), (11, "# $ % * & | < > " * 9),
        (12, "É é\x0b\x0c words\r\nwith ümlauts\x85and\xa0spaces 漢字 🙂"), (13, "short\nshort\nshort"),
        (14, None, None), (15, "one two three four", None), (16, "x" * 30_000), (17, "\n" * 5_000),
    ]
