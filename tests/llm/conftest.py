import pytest

LONG = " ".join(f"word{i % 97}" for i in range(30_000))

#: NULLs, empty and blank texts, ties, repeats, odd spaces, very long texts and words.
ODD = [
    (None, None, None),
    (None, "a text without an id", "s1"),
    (1, "", "s1"),
    (2, " \t\n\x0b\x0c\r ", None),
    (3, "one", "s2"),
    (4, "one", "s2"),
    (4, "one", "s2"),
    (5, "one two three", ""),
    (6, LONG, "s1"),
    (7, LONG + " end", "s1"),
    (8, "x" * 50_000, "s3"),
    (9, "line\nline\n\n line\r\nline\r\nother    spaces　here\x1c\x1d\x85 é́ 😀😀 it's we'll", "s3"),
    (10, "<|endoftext|> mid <|endoftext|><|endoftext|>end  two   three<|endoftext", "s4"),
    (11, "Password = \"abcdefGHIJKL\" token:secret=abcdefghijklmn é api_key='AAAA' AKIA" + "Z9" * 9, "s4"),
    (12, "token: secret= abcdefghijklmnop 0123456789abcdef0 deadbeefdeadbeeF AKIAAKIA1234", "s4"),
    (13, "ghp_" + "a1" * 20 + " -----BEGIN RSA PRIVATE KEY----- xoxb-123456789012", "s4"),
    (14, " ".join(["password=abcdefghijkl0"] * 700), "s4"),
    (15, " ".join(f"w{i}" for i in range(40)), "s5"),
    (16, " ".join(f"w{i}" for i in range(39)), "s5"),
    (17, "#*$%&|<> " * 30, "s5"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with columns whose names the operators use themselves."""
    rows = [(i, t, "en", s, -1, "k", 5, 6, "p") for i, t, s in ODD]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, key string, "
        "size long, cell int, path string",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def sorted_rows(rows):
    return sorted(rows, key=lambda row: [(x is not None, str(x)) for x in row])
