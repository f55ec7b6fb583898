import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))


def base_rows():
    prose = "the quick brown fox jumps over the lazy dog while nine grey cats watch it from a wall"
    near = " ".join(f"token{i}" for i in range(60))
    changed = near.replace("token59", "other59")          # one shingle of 56 differs
    far = near.replace("token30", "other30").replace("token10", "other10")
    return [
        (1, prose, "en", "a", 1), (2, prose.upper(), "en", "a", 1), (3, None, None, None, None),
        (4, "", "en", "b", 0), (5, "short text", "en", None, 1), (6, "short text", "en", None, 1),
        (7, near, "de", "b", 1), (8, changed, "de", "b", 1), (9, far, "de", "c", 1), (10, LONG, "en", "c", 1),
        (11, LONG, "en", "c", 1), (12, "!!! ???", None, "a", 1), (13, "!!! ???", None, "a", 1),
        (14, "Ünïcode TEXT ÄÖ", "de", "c", 1), (14, "Ünïcode TEXT ÄÖ", "de", "c", 1), (None, "no id here at all", "en", "a", 1),
    ]


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    """The tables are small: fewer tasks, the same plans."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="session")
def prepared(spark):
    from tapflow.llm.common import prepare
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def docs(prepared):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns."""
    return prepared.createDataFrame([(*r, "x", "y") for r in base_rows()], DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(prepared):
    return prepared.createDataFrame([], DOC_SCHEMA)
