import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers import SCHEMA, edited, prose  # noqa: E402


#: Names that results, helpers and intermediate tables use.
CLASHING = (
    "score lang_pred row cls place slot component_id kept start length w hash pos removed key _gone _gone_id _gone_key _gone_row _key _keep _id _row "
    "maybe text_key doubtful_id doubtful_row once gone_id gone_row gone_lines found_row bitmap_word bitmap_bits bitmap_slot word bits draw chosen holds "
    "root rep n odd bands leader bucket hits sketch shingles token wanted prefix first goes sequence_id doc_tokens n_words quality log_weight"
).split()


@pytest.fixture(scope="session")
def rows():
    """Prose, copies, near copies, and every odd text the operators must take."""
    base = [prose(i, 30 + 7 * (i % 20)) for i in range(60)]
    texts = base + base[:10] + [edited(t, i, 0.04) for i, t in enumerate(base[:25])] + [edited(base[3], 100 + i, 0.05) for i in range(12)]
    odd = [None, "", "   \n\t", "!!! ###", "one", "one two", "One TWO", "a  b\n\n c", " lead", "tail ", "x y   z", "É É é 한글 😀", "<|endoftext|> x", prose(9, 9000), "w" * 5000, "the " * 300, "line\nline\nline\nother"]
    found = [(i, t, "en" if i % 3 else None, f"s{i % 4}", len(t or "")) for i, t in enumerate(texts + odd)]
    return found + [found[2], found[2], (None, base[5], None, None, None), (None, None, None, None, None)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(docs):
    """Extra columns with the names that results and helpers use."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("x").alias(n) for n in CLASHING])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
