"""Small CSV assets: feature dictionaries, feature lists, bins, training samples.

Assets with a row per feature or per bin are configuration and are read to the
driver; their size is bounded by the number of columns a table can have.
Training samples stay distributed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURE_DICTIONARY = T.StructType(
    [T.StructField("variables", T.StringType()), T.StructField("Type", T.StringType())]
)
FEATURE_LIST = T.StructType([T.StructField("variables", T.StringType())])
ZERO_FILL_LIST = T.StructType([T.StructField("Features", T.StringType())])
MODEL_VARIABLES = T.StructType(
    [
        T.StructField("Model_no", T.IntegerType()),
        T.StructField("variable", T.StringType()),
        T.StructField("coefficient", T.DoubleType()),
    ]
)
WOE_BINS = T.StructType(
    [
        T.StructField("variable", T.StringType()),
        T.StructField("bin", T.StringType()),
        T.StructField("woe", T.DoubleType()),
    ]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header and a stated schema; nothing is inferred."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


@dataclass(frozen=True)
class Roles:
    """Which columns are numbers and which are categories; the rest is carried."""

    numerical: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()

    def of(self, column: str) -> str:
        if column in self.categorical:
            return "Categorical"
        return "Numerical" if column in self.numerical else "Others"

    def within(self, columns: Sequence[str]) -> Roles:
        """The part of the dictionary that these columns cover."""
        return Roles(
            tuple(c for c in self.numerical if c in columns),
            tuple(c for c in self.categorical if c in columns),
        )

    def plus_numerical(self, *columns: str) -> Roles:
        return Roles((*self.numerical, *columns), self.categorical)


def feature_roles(dictionary: DataFrame) -> Roles:
    """Roles from a feature dictionary (one row per feature)."""
    rows = dictionary.select("variables", "Type").collect()
    return Roles(
        tuple(r["variables"] for r in rows if r["Type"] == "Numerical"),
        tuple(r["variables"] for r in rows if r["Type"] == "Categorical"),
    )


def listed(asset: DataFrame, column: str = "variables") -> list[str]:
    """A feature list (one row per feature) as Python strings."""
    return [r[0] for r in asset.select(column).collect()]


def model_variables(asset: DataFrame, model_no: int) -> list[tuple[str, float]]:
    """(variable, coefficient) of one model; its first row is the intercept."""
    rows = asset.where(F.col("Model_no") == model_no).select("variable", "coefficient").collect()
    return [(r["variable"], r["coefficient"]) for r in rows]


def woe_bins(asset: DataFrame) -> dict[str, list[tuple[str, float]]]:
    """(bin label, woe) of each variable (one row per bin)."""
    bins: dict[str, list[tuple[str, float]]] = {}
    for r in asset.select("variable", "bin", "woe").collect():
        bins.setdefault(r["variable"], []).append((r["bin"], r["woe"]))
    return bins
