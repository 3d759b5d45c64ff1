"""Boosted decision trees as plain data, applied as column expressions.

A tree is ``{"weight": w, "root": node}``.  A node is one of

* ``{"value": v}``, a leaf;
* ``{"feature": name, "threshold": t, "low": node, "high": node}``: rows at or
  below the threshold go to ``low``, with ``"strict": true`` those below it;
* ``{"feature": name, "categories": [...], "low": node, "high": node}``: rows
  whose category is listed go to ``low``.

``"missing": "low"`` or ``"high"`` says where a row without the feature goes;
a node without it makes the leaf NULL.  A fitted model is exported to this form
once; applying it needs no model object, no vectors, no filled-in markers and
no Python.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import Column
from pyspark.sql import functions as F

from loanlens.functions import sigmoid


def exported(model: GBTClassificationModel, features: Sequence[str]) -> list[dict]:
    """The trees of a fitted classifier of two classes, numeric features only."""

    def node(x) -> dict:
        if x.subtreeDepth() == 0:
            return {"value": x.prediction()}
        split = x.split()
        return {
            "feature": features[split.featureIndex()],
            "threshold": split.threshold(),
            "low": node(x.leftChild()),
            "high": node(x.rightChild()),
        }

    return [
        {"weight": weight, "root": node(tree._call_java("rootNode"))}
        for weight, tree in zip(model.treeWeights, model.trees)
    ]


def from_dump(trees: Sequence[Mapping]) -> list[dict]:
    """Trees from a JSON model dump, whose nodes name their children by number.

    A split there has ``nodeid``, ``split`` (the feature), ``split_condition``
    (a number, or a list of categories), ``yes``, ``no``, ``missing`` and
    ``children``; a leaf has ``leaf``.  Numbers below the condition go to
    ``yes``, and so do categories that are not listed.
    """

    def node(x: Mapping) -> dict:
        if "leaf" in x:
            return {"value": x["leaf"]}
        children = {c["nodeid"]: node(c) for c in x["children"]}
        yes, no, condition = children[x["yes"]], children[x["no"]], x["split_condition"]
        if isinstance(condition, (list, tuple)):
            out = {"feature": x["split"], "categories": list(condition), "low": no, "high": yes}
        else:
            out = {"feature": x["split"], "threshold": condition, "strict": True, "low": yes, "high": no}
        if "missing" in x:
            out["missing"] = "low" if (children[x["missing"]] is out["low"]) else "high"
        return out

    return [{"weight": 1.0, "root": node(t)} for t in trees]


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _goes_low(node: Mapping) -> str:
    if "categories" in node:
        if not node["categories"]:
            return f"{_name(node['feature'])} is null and false"
        return f"{_name(node['feature'])} in ({', '.join(map(_text, node['categories']))})"
    return f"{_name(node['feature'])} {'<' if node.get('strict') else '<='} double('{float(node['threshold'])!r}')"


def tree_sql(node: Mapping) -> str:
    """One tree as a SQL expression: the leaf a row falls into."""
    if "value" in node:
        return f"double('{float(node['value'])!r}')"
    low, high, missing = tree_sql(node["low"]), tree_sql(node["high"]), node.get("missing")
    if missing not in (None, "low", "high"):
        raise ValueError(f"missing rows go low or high, not {missing!r}")
    absent, test = f"{_name(node['feature'])} is null", _goes_low(node)
    if missing == "low":
        return f"case when {absent} or {test} then {low} else {high} end"
    if missing == "high":  # a comparison with NULL is not true
        return f"case when {test} then {low} else {high} end"
    return f"case when {absent} then null when {test} then {low} else {high} end"


def tree_value(node: Mapping) -> Column:
    """The leaf a row falls into; NULL where a missing feature has no direction."""
    return F.expr(tree_sql(node))


def tree_margin(trees: Sequence[Mapping], bias: float = 0.0) -> Column:
    """The weighted sum of the trees; NULL when one of them is.

    The trees are elements of an array: Spark compiles those one by one, where a
    sum of hundreds of trees would be too long for one compiled method.
    """
    values = F.array(*[F.lit(float(t["weight"])) * tree_value(t["root"]) for t in trees])
    return F.aggregate(values.cast("array<double>"), F.lit(float(bias)), lambda total, x: total + x)


def tree_probability(trees: Sequence[Mapping], scale: float = 2.0, bias: float = 0.0) -> Column:
    """P(class 1): the logistic of the margin, twice it by default, as boosting on a label of -1 and 1 has it.

    Trees of logistic boosting (see ``from_dump``) take ``scale=1``, and the
    log-odds of their base score as ``bias``.
    """
    return sigmoid(scale * tree_margin(trees, bias))
