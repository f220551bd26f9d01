"""Tables that the operator tests share."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 900
PASSAGE = ("Of the harbour lights that burned along the northern quay that winter only three were ever traced to a keeper, and "
           "of those three the second had been extinguished by order of the council before the first ship came home. ") * 3
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.\nAll rights reserved.", "en", "s0"),
    (2, None, "en", "s0"),
    (3, "", None, "s1"),
    (4, "   \n\t ", "en", None),
    (5, "one two", "de", "s1"),
    (6, LONG, "en", "s0"),
    (7, LONG, "en", "s0"),
    (8, PASSAGE, "en", "s2"),
    (9, "Prefix words here. " + PASSAGE + " and a suffix.", None, None),
    (9, "Prefix words here. " + PASSAGE + " and a suffix.", None, None),
    (10, "x " * 50 + "Éà ß 漢字 \U0001F600 " + "licensed under the MIT License and CC BY-NC 4.0 or GNU General Public License", "fr", "s1"),
    (None, "no id here but five words", "en", "s0"),
    (11, "one two", "de", "s1"),
    (12, "<|endoftext|> a  b c  \r\n#$% %% & | <b> ** #", "en", "s2"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, long, repeated and tied rows, with clashing extra columns."""
    rows = [(*r, 0 if r[1] is None else len(r[1]), "x", 7, True, "k") for r in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, "
                                       "n_words int, base_failed boolean, t_symbol_ratio string").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
