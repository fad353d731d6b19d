"""Column expressions shared by alerts and reports."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CLASS_IDS, HIGH_FROM, MEDIUM_FROM
from ..storage import literal_map


def severity(confidence: Column) -> Column:
    """HIGH, MEDIUM or LOW by the unrounded confidence."""
    return F.when(confidence >= HIGH_FROM, "HIGH").when(confidence >= MEDIUM_FROM, "MEDIUM").otherwise("LOW")


def class_name(class_id: Column) -> Column:
    """Name of a class id; an unknown id reads CLS_n."""
    names = literal_map({v: k for k, v in CLASS_IDS.items()})
    return F.coalesce(
        F.try_element_at(names, class_id), F.concat(F.lit("CLS_"), class_id.cast("string"))
    )


def class_id(name: Column) -> Column:
    """Id of a class name, NULL when unknown."""
    return F.try_element_at(literal_map(CLASS_IDS), name)


def lead_feature(contributions: Column, top_features: Column) -> Column:
    """``name (+0.42)`` of the first contribution, else the first top feature, else a dash.

    Both arguments are arrays of (feature, value) in logged order.
    """
    first = F.try_element_at(contributions, F.lit(1))
    return F.coalesce(
        F.when(first.isNotNull(), F.format_string("%s (%+.2f)", first["feature"], first["value"])),
        F.try_element_at(top_features, F.lit(1))["feature"],
        F.lit("—"),
    )


def percent_text(confidence: Column) -> Column:
    """``97.0%``, or a dash when there is no positive confidence."""
    return F.when(confidence > 0, F.format_string("%.1f%%", confidence * 100)).otherwise("—")
