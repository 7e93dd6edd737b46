import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    base = "the quick brown fox jumps over the lazy dog while seven wizards brew strange potions near old towers"
    texts = [
        None, "", " ", base, base, base + " again", base.upper(), "a", "\n\n", f"{base}\nshared line", f"other\nshared line\n{base}",
        " ".join(f"w{k}" for k in range(30_000)), "same " * 500, "same " * 700, f"x {base} y {base} z",
    ]
    rows = [(k, t, "en" if k % 3 else None, "s", 1, f"c{k}", k) for k, t in enumerate(texts)]
    rows += [(None, base, None, None, None, None, None), (3, base, "en", "s", 1, "c3", 3), (7, "another text", "de", "s", 1, "c", 0)]
    columns = "doc_id long, text string, lang string, source string, n_chars long, row string, mark long"
    return spark.createDataFrame(rows, columns)
