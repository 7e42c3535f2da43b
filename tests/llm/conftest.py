import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_TINY = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from skywave.session import BASE_CONF, checkpoint_root, ensure_utc
    b = SparkSession.builder.master("local[4]").appName("skywave-llm-tests").config("spark.sql.shuffle.partitions", "6")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_utc(s)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skywave-llm-ckpt-"))
    checkpoint_root(s)
    return s


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    import random
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


def edge_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls in any column, empty and long
    texts, exact, white-space and near copies, repeated rows."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    long = prose(2, 9000)
    rows = [(1, base, "en", "a", len(base)), (2, base, "en", "b", len(base)), (3, base.replace(" ", "  \n\t", 5), None, "a", None),
            (4, " ".join(near), "en", "a", 1), (5, None, "en", None, None), (6, "", None, "a", 0), (7, long, "en", "a", len(long)),
            (8, "x " + long, "en", "a", 1), (9, "one two", "en", "a", 7), (10, "one two", "en", "a", 7), (11, "Ünï ▁ cödé 漢字 😀\x00", "de", "a", 3),
            (12, "a" * 5000, "en", "a", 5000), (13, "   \n\t ", "en", "a", 6), (14, prose(3, 40) + "\n" + base, "en", "a", 2),
            (15, prose(4, 300), "en", "a", 3), (15, prose(4, 300), "en", "a", 3), (None, "no id here at all", "en", "a", 5)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edges(spark):
    """The edge rows with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(7) for c in ("v", "n", "key", "doc", "crc", "score", "digest", "run", "size", "shard", "variant", "kept",
                                              "n_hit", "n_words", "hits", "items", "others", "all", "id", "k_id", "k_sha", "k_digest",
                                              "gone_id", "many_id", "of_id", "component_id", "row", "a.b")}).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
