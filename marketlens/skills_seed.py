"""The skill dimension: name, category, other spellings, relevance per role.

The seed rows are fixed values; they lie beside this module as JSON lines.
"""

import json
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketlens.schemas import SKILLS_MASTER

SEED = Path(__file__).with_name("skills.jsonl")


def skill_rows() -> list[tuple[str, str, list[str], dict[str, float]]]:
    return [tuple(json.loads(line)[name] for name in SKILLS_MASTER.names) for line in SEED.read_text().splitlines()]


def skills_master(spark: SparkSession) -> DataFrame:
    """The seed rows as a DataFrame.

    An Arrow table of this size becomes a local relation with known statistics, so joins to its
    118 rows broadcast by size and without a hint.
    """
    names = ("skill", "category", "aliases", "role_relevance")
    text = pa.string()
    kinds = (text, text, pa.list_(text), pa.map_(text, pa.float64()))
    columns = zip(*skill_rows())
    arrays = [
        pa.array([list(v.items()) if isinstance(v, dict) else v for v in column], kind)
        for column, kind in zip(columns, kinds)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names), SKILLS_MASTER)
