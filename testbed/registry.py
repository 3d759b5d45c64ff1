"""Names, Spark callables and SQL texts of all queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from testbed import proxies as P
from testbed.storage import stored_locally

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL_TEXTS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = stored_locally(f)
        if sql is not None:
            SQL_TEXTS[name] = sql
        return f

    return register


# Extra inputs in SQL, beside the proxies; later ones may use earlier ones.
CTES: dict[str, str] = dict(P.SQL)


def with_ctes(body: str, *names: str) -> str:
    """The body after the named inputs, in the given order."""
    if not names:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names) + "\n" + body


def r6(x: Column | str) -> Column:
    return F.round(x, 6)


def s6(x: str) -> str:
    return f"(round({x}, 6) + 0.0)"


def logit_sql(p: str) -> str:
    return f"ln(({p}) / (1 - ({p})))"


def sigmoid_sql(x: str) -> str:
    return f"(1e0 / (1e0 + exp(-({x}))))"


def text_day(name: str) -> Column:
    return F.col(name).cast("date").cast("string").alias(name)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, dates as text."""
    out = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind == "double":
            out.append(F.round(f.name, 6).alias(f.name))
        elif kind == "date":
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
