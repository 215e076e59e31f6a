import pytest

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score double, shard int, key string, "
          "row_hash string, n_removed string, held_out string, length string, kept string, bucket string, offset string")
LONG = " ".join(f"word{i % 977} stone{i % 13}" for i in range(40_000))
BODY = "the quick brown fox jumps over the lazy dog while seven wizards quietly boil their morning tea again today"
ROWS = [
    (1, BODY, "en"), (2, BODY, "en"), (2, BODY, "en"), (3, None, "en"), (4, "", None), (5, "   \n\t\n", "de"),
    (6, "!!! 123 ***", None), (7, LONG, "en"), (None, BODY + " x", "en"), (None, None, None), (9, "ÄÖÜ straße é ñ", "de"),
    (10, "a", "fr"), (11, BODY.upper(), "en"), (12, BODY + "\n" + BODY, "en"), (13, "zero\x00byte and \u2028 odd\r\nends", None)]


def frame(spark, rows):
    """Documents with nulls in every other column and extra columns whose names clash."""
    return spark.createDataFrame([(*r, *[None] * (15 - len(r))) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ROWS)


@pytest.fixture(scope="session")
def none(spark):
    return frame(spark, [])
